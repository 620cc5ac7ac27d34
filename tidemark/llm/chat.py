"""Operator 1: format conversations and expand every assistant turn into its own training example."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle

START, END = "<|im_start|>", "<|im_end|>"
EXAMPLE = "conv_id long, slice long, block long, example long, first_turn long, n_turns long, text string, loss_start long, loss_end long, closes boolean"


KINDS = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    """Rows as a batch of the schema's types, so that whole numbers stay whole beside nulls."""
    columns = [part.split() for part in schema.split(", ")]
    return pa.record_batch({name: pa.array([row[i] for row in rows], KINDS[kind]) for i, (name, kind) in enumerate(columns)})


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns], strict=True)


def escape(text: str) -> str:
    """Make a text free of control strings, which all begin with <|; undone by ``unescape``."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def opening(role: str) -> str:
    return f"{START}{escape(role)}\n"


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted text."""
    turns = []
    for part in text.split(START)[1:]:
        role, _, body = part.partition("\n")
        turns.append((unescape(role), unescape(body[: body.rindex(END)])))
    return turns


def in_order(turns: DataFrame, rows_per_slice: int) -> DataFrame:
    """The turns with their ordinal's slice: rows are ranked over all tasks, so a conversation may have any number.

    Rows are dealt out by range, ranked where they lie and moved up by the rows that the conversation has in
    earlier ranges. Equal turn numbers are ordered by role and text; rows equal in all are interchangeable.
    """
    order = ["conv_id", "turn", "role", "text"]
    rows = turns.select(F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order, "_row").drop("_row")
    dealt = settle(dealt.withColumn("_range", F.spark_partition_id()), "turns")
    counts = dealt.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("conv_id").alias("_c"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "_range").orderBy("turn", "role", "text")) - 1
    counts = settle(counts, "turn-counts")
    placed = dealt.withColumn("_inside", inside).join(counts, dealt["conv_id"].eqNullSafe(counts["_c"]) & (F.col("_range") == F.col("_r")))
    ordinal = (F.col("_before") + F.col("_inside")).cast("long")
    return placed.select("conv_id", ordinal.alias("ordinal"), F.floor(ordinal / rows_per_slice).alias("slice"), "role", "text")


def expand(turns: DataFrame, *, trained_role: str = "assistant", block_chars: int = 1 << 18, rows_per_slice: int = 4096) -> DataFrame:
    """Training examples: for each assistant turn, all earlier turns as context and only that reply under the loss.

    ``text`` is the formatted context and reply, and [loss_start, loss_end) its code points that are trained.
    Contexts are prefixes of one another, so those of a very long conversation would grow with the square of its
    turns. A conversation is therefore written in blocks: an example's text begins at its block, with the turn whose
    place in the conversation, counted from 0, is ``first_turn``. The blocks of the conversation that begin before
    ``first_turn`` are the rest of its context; ``whole_contexts`` puts them in front. A block ends after ``block_chars``
    characters or ``rows_per_slice`` turns; a conversation below both, as nearly all are, is one block, and each of
    its examples holds the whole context. The last row of a block has ``closes`` true and holds all its turns, so the
    closing rows hold each turn once; where the turns after the last reply need it, that row has no loss (loss_start null).

    ``n_turns`` counts the turns in ``text``. Null role or text count as empty; a null conv_id is a conversation of
    its own; turns are ordered by turn (nulls first), ties by role and text; repeated rows are turns of their own; a conversation
    without assistant turns gives rows without loss; no rows give none. Other columns are ignored.
    """
    rows = in_order(turns, rows_per_slice)

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        out: list[tuple] = []
        held = 0

        def close() -> None:
            # turns since the last reply, or a block's end: the row that completes the block
            if state.get("turns"):
                if state["pending"] and state["pending"][5] == state["turns"]:
                    out.append((*state["pending"], True))
                else:
                    flush()
                    out.append((state["conv"], state["slice"], state["block"], state["example"], state["first"], state["turns"], "".join(state["parts"]), None, None, True))
            state["pending"] = None

        def flush() -> None:
            if state["pending"]:
                out.append((*state["pending"], False))
            state["pending"] = None

        def fresh(conv, slice_, block, example, first) -> None:
            state.update(conv=conv, slice=slice_, block=block, example=example, first=first, turns=0, parts=[], size=0, pending=None)

        for batch in batches:
            for conv, slice_, role, text in rows_of(batch):
                if not state or state["conv"] != conv or state["slice"] != slice_:
                    close() if state else None
                    fresh(conv, slice_, 0, 0, slice_ * rows_per_slice)
                elif state["size"] > block_chars:
                    close()
                    fresh(conv, slice_, state["block"] + 1, state["example"], state["first"] + state["turns"])
                head, body = opening(role), escape(text)
                begin = state["size"] + len(head)
                state["parts"] += [head, body, END, "\n"]
                state["size"] = begin + len(body) + len(END) + 1
                state["turns"] += 1
                if role == trained_role:
                    flush()
                    whole = "".join(state["parts"])
                    state["parts"] = [whole]
                    state["pending"] = (conv, slice_, state["block"], state["example"], state["first"], state["turns"], whole, begin, begin + len(body))
                    state["example"] += 1
                    held += len(whole)
                if held > 1 << 24 or len(out) >= 5000:
                    yield batch_of(out, EXAMPLE)
                    out, held = [], 0
        if state:
            close()
        if out:
            yield batch_of(out, EXAMPLE)

    dealt = rows.repartition("conv_id", "slice").sortWithinPartitions("conv_id", "slice", "ordinal").select("conv_id", "slice", "role", "text")
    return dealt.mapInArrow(format_rows, EXAMPLE)


def whole_contexts(wanted: DataFrame, examples: DataFrame) -> DataFrame:
    """The wanted rows of ``examples`` with their whole context: ``text`` begins at the conversation's first turn.

    The blocks before a row's own are joined from the closing rows, once for each block that the wanted rows begin
    in, and put in front; ``first_turn`` becomes 0, and ``n_turns`` and the loss move with the text. ``examples``
    holds at least all closing rows of the conversations that are asked for; it should be a settled table. What
    comes back grows with the contexts asked for: all examples of a conversation of many blocks are as many long texts.
    """
    blocks = examples.where("closes").select(F.col("conv_id").alias("_conv"), F.col("first_turn").alias("_at"), F.col("text").alias("_block"))
    starts = wanted.where("first_turn > 0").select(F.col("conv_id").alias("_of"), F.col("first_turn").alias("_start")).distinct()
    parts = starts.join(blocks, F.col("_of").eqNullSafe(F.col("_conv")) & (F.col("_at") < F.col("_start")))
    ordered = F.sort_array(F.collect_list(F.struct("_at", "_block")))
    before = parts.groupBy("_of", "_start").agg(F.array_join(F.transform(ordered, lambda part: part["_block"]), "").alias("_before"))
    found = wanted.join(before, F.col("conv_id").eqNullSafe(F.col("_of")) & (F.col("first_turn") == F.col("_start")), "left")
    moved = F.coalesce(F.length("_before"), F.lit(0)).cast("long")
    whole = {
        "n_turns": F.col("first_turn") + F.col("n_turns"), "first_turn": F.lit(0).cast("long"), "text": F.concat(F.coalesce("_before", F.lit("")), "text"),
        "loss_start": F.col("loss_start") + moved, "loss_end": F.col("loss_end") + moved,
    }
    return found.select(*[whole[name].alias(name) if name in whole else name for name in wanted.columns])


def reduced(examples: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Each example's length, formatted characters of context in its text, reply and, if it closes a block, text."""
    schema = "conv_id long, slice long, block long, example long, first_turn long, n_turns long, length long, context long, reply string, text string"

    head = len(opening(trained_role))

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for *place, text, start, end, closes in rows_of(batch):
                reply = None if start is None else unescape(text[start:end])
                out.append((*place, len(text), None if start is None else start - head, reply, text if closes else None))
            yield batch_of(out, schema)

    columns = ["conv_id", "slice", "block", "example", "first_turn", "n_turns", "text", "loss_start", "loss_end", "closes"]
    return examples.select(*columns).mapInArrow(reduce_rows, schema)


def digests(examples: DataFrame, *, trained_role: str = "assistant") -> DataFrame:
    """Per conversation, read back from its examples: turns, their digest, trained characters, their digest, formatted characters.

    ``context_turns`` and ``context_chars`` are summed over the replies: the turns before each by its ``first_turn`` and
    ``n_turns``, and the formatted characters before each in the blocks before its own and in its text;
    ``contexts_whole`` says that the blocks read before each example hold exactly the turns before its ``first_turn``. Each
    example is reduced where it lies to its length, its reply and, if it closes a block, its text, so a conversation's
    characters move about twice and not once for each reply. Blocks are read in order and nothing but the running
    digests is kept of them.
    """
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, context_turns long, context_chars long, contexts_whole boolean"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv = False, None
        out: list[tuple] = []

        def done() -> None:
            out.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, context_turns, context_chars, whole))

        for batch in batches:
            for key, first_turn, turns_here, length, context, reply, block in rows_of(batch):
                if not begun or key != conv:
                    if begun:
                        done()
                    begun, conv, n_turns, loss_chars, chars, turns, loss = True, key, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                    context_turns = context_chars = closed = 0
                    whole = True
                chars += length
                whole = whole and first_turn == n_turns
                if context is not None:
                    loss_chars += len(reply)
                    loss.update(reply.encode("utf-8", "surrogatepass"))
                    context_turns += first_turn + turns_here - 1
                    context_chars += closed + context
                if block is not None:
                    closed += length
                    for role, text in parse(block):
                        n_turns += 1
                        turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if out:
                yield batch_of(out, schema)
                out = []
        if begun:
            done()
            yield batch_of(out, schema)

    dealt = reduced(examples, trained_role).repartition("conv_id").sortWithinPartitions("conv_id", "slice", "block", "example", "n_turns")
    return dealt.select("conv_id", "first_turn", "n_turns", "length", "context", "reply", "text").mapInArrow(read, schema)
