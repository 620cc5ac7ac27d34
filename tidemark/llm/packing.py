"""Operator 10: pack tokenized documents into sequences by bin completion with branch and bound."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import running_start, settle, spread_key

PIECES = "array<struct<piece:int,start:long,length:long,ids_crc32:long>>"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def plain_byte_level(model: dict) -> bool:
    """Whether a tokenizer's file says byte-level merges over the usual split and nothing else, merges in the order of their tokens' ids."""
    split, bpe = model.get("pre_tokenizer") or {}, model["model"]
    if model.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
        return False
    if bpe.get("type") != "BPE" or any(bpe.get(name) for name in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
        return False
    made = [bpe["vocab"].get("".join(pair.split(" ") if isinstance(pair, str) else pair), -1) for pair in bpe["merges"]]
    return all(a < b for a, b in zip([0, *made], made))


def encoder(path: str):
    """A function from texts to token ids of the tokenizer in the file, without added special tokens.

    The vocabulary of a plain byte-level file is run by tiktoken, which gives the same ids several times faster; any
    other file, and texts that hold a special token's string or that tiktoken refuses, go through the tokenizers library itself.
    """
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    plain = plain_byte_level(model)
    # byte-level vocabularies write each byte as a printable character: itself, or the next free one from U+0100
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}
    specials = [token["content"] for token in model["added_tokens"]]
    ranks = {bytes(shown[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in specials} if plain else {}
    # the parsed file is several times larger than what is kept of it
    del model
    whole = Tokenizer.from_file(path)
    if not plain:
        return lambda text: whole.encode(text, add_special_tokens=False).ids
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> list[int]:
        if not any(special in text for special in specials):
            try:
                return fast.encode_ordinary(text)
            except Exception:  # a text that its pattern matcher gives up on
                pass
        return whole.encode(text, add_special_tokens=False).ids

    return encode


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: one up to the capacity, else full pieces after a first one of the rest."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def tokenized_pieces(docs: DataFrame, path: str, capacity: int, end: int) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of each piece of each whole text; null text is empty, so it is only the end token."""

    @F.pandas_udf(PIECES)
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path)
        for texts in batches:
            rows = []
            for text in texts:
                ids = np.array([*encode(text or ""), end], dtype="<u4")
                rows.append([(i, start, n, zlib.crc32(ids[start : start + n].tobytes())) for i, (start, n) in enumerate(cut(len(ids), capacity))])
            yield pd.Series(rows)

    return docs.select("doc_id", F.inline(pieces("text")))


@dataclass(frozen=True)
class Filling:
    """A sequence's lengths in falling order and the number of sequences filled so."""

    lengths: tuple[int, ...]
    times: int


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: the best of the bounds by total length with the small ones left out."""
    best = 0
    sizes = sorted(counts)
    for least in [0, *(s for s in sizes if s <= capacity // 2)]:
        alone = sum(counts[s] for s in sizes if s > capacity - least)
        large = [s for s in sizes if capacity // 2 < s <= capacity - least]
        n_large = sum(counts[s] for s in large)
        spare = n_large * capacity - sum(counts[s] * s for s in large)
        small = sum(counts[s] * s for s in sizes if least <= s <= capacity // 2)
        best = max(best, alone + n_large + max(0, -(-(small - spare) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best fit by falling length, on counts: all sequences with equal contents are handled at once."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in open_ if r >= size), default=None)
            if room is None:
                contents, n, room = (), -(-left // (capacity // size)), capacity
            else:
                contents, n = open_[room].popitem()
                if not open_[room]:
                    del open_[room]
            fit = min(room // size, left)
            used = min(n, left // fit)
            if n - used and room != capacity:
                open_.setdefault(room, {})[contents] = n - used
            held = open_.setdefault(room - size * fit, {})
            held[contents + (size,) * fit] = held.get(contents + (size,) * fit, 0) + used
            left -= used * fit
    return [Filling(contents, n) for held in open_.values() for contents, n in held.items()]


def completions(counts: dict[int, int], largest: int, capacity: int, waste: int) -> Iterator[tuple[int, ...] | None]:
    """All undominated fillings of the room beside the largest length, of any number of lengths, fullest first.

    For each waste from 0 to ``waste``, lengths are taken depth first in falling order; sums that the lengths
    still to come can't reach are not entered, so without dominance every path would end in a filling. A filling is
    dominated if a length left out could take the place of some of its lengths (or of none) that sum to no more,
    and still fit: the sequence gets fuller, or has fewer lengths, and what it gave up fits where the other was. None
    is yielded every few thousand steps without a filling, so that the caller can count them.
    """
    room = capacity - largest
    held = {s: n - (s == largest) for s, n in counts.items() if s <= room and n > (s == largest)}
    sizes = sorted(held, reverse=True)
    # bit t of reach[i]: the lengths from i on can sum to t
    reach = [1] * (len(sizes) + 1)
    for i in range(len(sizes) - 1, -1, -1):
        bits, copies, part = reach[i + 1], min(held[sizes[i]], room // sizes[i]), 1
        while copies:
            part = min(part, copies)
            bits |= bits << part * sizes[i] & (1 << room + 1) - 1
            copies, part = copies - part, 2 * part
        reach[i] = bits
    steps = 0

    def spread(sums: int, by: int) -> int:
        """Each sum and the next ``by`` numbers."""
        done = 0
        while done < by:
            step = min(done + 1, by - done)
            sums, done = sums | sums << step, done + step
        return sums

    def longer(i: int, rest: int, taken: tuple[int, ...], single: int, several: int, free: int, over: int):
        """The states after the next length taken, a bit per length taken, sum of several taken, and length left out."""
        nonlocal steps
        # a length left out from rest to rest + over would dominate any two or more lengths that sum to rest
        alone = free >> rest & (1 << over + 1) - 1
        for j in range(max(i, bisect_left(sizes, -rest, key=int.__neg__)), len(sizes)):
            size = sizes[j]
            steps += 1
            if steps % 4096 == 0:
                yield None
            if alone and size < rest or not reach[j] >> rest & 1:
                return
            for n in range(min(held[size], rest // size), 0, -1):
                if reach[j + 1] >> rest - n * size & 1:
                    sums, ones = several, single
                    for _ in range(n):
                        sums, ones = sums | (sums | ones) << size, ones | 1 << size
                    out = free & ~(1 << size) if n == held[size] else free
                    if not (spread(sums, over) | spread(ones << 1, over - 1) * (over > 0)) & out:
                        yield j + 1, rest - n * size, taken + (size,) * n, ones, sums, out, over

    every = sum(1 << size for size in sizes)
    for over in range(min(waste, room) + 1):
        if sum(size * held[size] for size in sizes if size <= over) > room - over:
            return  # a length left out fits into the waste
        if not reach[0] >> room - over & 1:
            continue
        state = (0, room - over, (), 0, 0, every, over)
        stack = [iter([state])]
        while stack:
            state = next(stack[-1], stack)
            if state is stack:
                stack.pop()
            elif state is None:
                yield None
            elif state[1]:
                stack.append(longer(*state))
            elif not state[5] & (1 << over + 1) - 1:
                yield state[2]


def branches(counts: dict[int, int], capacity: int, waste: int) -> Iterator[Filling | None]:
    """Each completion of the largest length as often as its lengths last and the waste allows, then less often."""
    largest, found = max(counts), []
    for filling in completions(counts, largest, capacity, waste):
        if filling is None:
            yield None
            continue
        lengths = (largest, *filling)
        most = min(counts[s] // lengths.count(s) for s in set(lengths))
        if sum(lengths) < capacity:
            most = min(most, waste // (capacity - sum(lengths)))
        yield Filling(lengths, most)
        found.append(Filling(lengths, most))
    for filling in found:
        for times in range(filling.times - 1, 0, -1):
            yield Filling(filling.lengths, times)


def bin_completion(counts: dict[int, int], capacity: int, *, nodes: int = 3000) -> tuple[list[Filling], int]:
    """Fillings for all lengths and the lower bound on their number.

    Depth first: the largest length left is completed by each undominated filling in turn, fullest first, and a
    filling is used as often as its lengths last (equal documents are interchangeable), on going back less often. A
    branch ends when the waste so far leaves no room to beat the incumbent, which starts as the best-fit packing. The
    search stops at the lower bound, or after ``nodes`` branches (4,096 steps without a filling count as one) with the
    best packing found; every length is always packed. Without that limit the packing has the least sequences.
    """
    counts = {s: n for s, n in counts.items() if n}
    bound = lower_bound(counts, capacity) if counts else 0
    best = best_fit(counts, capacity)
    total = sum(s * n for s, n in counts.items())
    fewest = sum(f.times for f in best)
    # a frame: counts left, untried branches, fillings so far, waste so far
    stack: list[list] = [[dict(counts), None, [], 0]]
    tried = 0
    while stack and fewest > bound and tried < nodes:
        left, untried, chosen, waste = stack[-1]
        if not left:
            n = sum(f.times for f in chosen)
            if n < fewest:
                best, fewest = list(chosen), n
            stack.pop()
            continue
        # waste that a better packing may still have
        spare = (fewest - 1) * capacity - total - waste
        if spare < 0:
            stack.pop()
            continue
        if untried is None:
            untried = stack[-1][1] = branches(left, capacity, spare)
        filling = next(untried, stack)
        if filling is stack:
            stack.pop()
            continue
        tried += 1
        if filling is None:
            continue
        rest = dict(left)
        for s in set(filling.lengths):
            rest[s] -= filling.times * filling.lengths.count(s)
            if not rest[s]:
                del rest[s]
        stack.append([rest, None, [*chosen, filling], waste + filling.times * (capacity - sum(filling.lengths))])
    return best, bound


def runs(fillings: list[Filling]) -> pd.DataFrame:
    """Which ranks of a length go where: rows (length, from_rank, each, first_sequence, first_offset), in rank order."""
    rows, used, sequence = [], {}, 0
    for filling in sorted(fillings, key=lambda f: f.lengths, reverse=True):
        offset = 0
        for size in dict.fromkeys(filling.lengths):
            each = filling.lengths.count(size)
            rows.append((size, used.get(size, 0), each, sequence, offset))
            used[size] = used.get(size, 0) + each * filling.times
            offset += each * size
        sequence += filling.times
    return pd.DataFrame(rows, columns=["length", "from_rank", "each", "sequence", "offset"]).astype("int64")


def pack(pieces: DataFrame, capacity: int, **search) -> DataFrame:
    """Add sequence_id and offset to a settled table of pieces (doc_id, piece, length and more, length <= capacity).

    Only counts by length, at most ``capacity`` numbers, reach the driver, where the search works on them. Pieces
    of a length are ranked by hash over all tasks (a length may be that of a third of all rows) and find their
    sequence by rank. The plan sent to the tasks is bounded by the number of fillings, not by the documents.
    """
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = runs(bin_completion(counts, capacity, **search)[0])
    columns = pieces.columns
    keyed = pieces.withColumn("_spread", spread_key(F.col("doc_id"), F.col("piece"), F.col("start"))).withColumn("_one", F.lit(1))
    ranked = running_start(settle(keyed, "pieces"), "length", ["_spread", "doc_id", "piece"], "_one", "_rank")
    by_length = {int(length): part.sort_values("from_rank").to_numpy() for length, part in plan.groupby("length")}

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sizes, at = lengths.to_numpy(), ranks.to_numpy()
        out = np.empty((len(sizes), 2), dtype="int64")
        for size in np.unique(sizes):
            here = sizes == size
            table = by_length[int(size)]
            row = table[np.searchsorted(table[:, 1], at[here], side="right") - 1]
            past = at[here] - row[:, 1]
            out[here, 0] = row[:, 3] + past // row[:, 2]
            out[here, 1] = row[:, 4] + past % row[:, 2] * size
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    return ranked.withColumn("_place", place("length", "_rank")).select(*columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, *, path: str | None = None, capacity: int = 1024, end: int = 2, **search) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    Each text becomes its ids and the end token; only longer ones are cut, into full pieces after a first one of
    the rest. Null and empty texts are the end token alone; repeated rows are packed as often as they come; other
    columns are ignored; no rows give no rows.
    """
    path = path or tokenizer_file("byte_bpe_50k.json")
    return pack(settle(tokenized_pieces(docs.select("doc_id", "text"), path, capacity, end), "tokenized"), capacity, **search)


