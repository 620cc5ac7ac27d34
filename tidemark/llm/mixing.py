"""Operator 2: mix sources to target weights with a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import running_start, settle, spread_key, words_in

#: Fractional part of the golden ratio: its multiples fill the unit interval most evenly.
GOLDEN = 0.6180339887498949


def repeating_weights(rank: Column) -> Column:
    """Weights 1, 2, 3, 1, ... for the sources in code point order (rank from 0)."""
    return (F.pmod(rank, F.lit(3)) + 1).cast("double")


def source_targets(sizes: DataFrame, weigh=repeating_weights, cap: float = 3.0) -> DataFrame:
    """One row per source: sid, source, source_size, weight and target words.

    Targets share the total of all sizes by weight, none above ``cap`` times its source's size; what is cut off
    goes to the others by weight. In order of cap per weight, the sources before the first one that its share
    does not fill are capped and all others get the same words per unit of weight. Null is a source, the last.
    The mix's configuration has one row per source, so its windows hold sources, never documents.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    rows = sums.select(rank.alias("sid"), "source", "source_size").withColumn("weight", weigh(F.col("sid")))
    rows = rows.withColumn("limit", cap * F.col("source_size")).withColumn("ratio", F.col("limit") / F.col("weight"))
    everything = Window.partitionBy()
    earlier = Window.orderBy("ratio", "sid").rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(earlier), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    rows = rows.withColumn("level", left_words / left_weight)
    level = F.min_by(F.when(F.col("ratio") > F.col("level"), F.col("level")), F.when(F.col("ratio") > F.col("level"), F.col("ratio"))).over(everything)
    target = F.least(F.col("limit"), F.coalesce(F.col("weight") * level, F.col("limit")))
    return rows.select("sid", "source", "source_size", "weight", target.alias("target"))


def slots(targets: DataFrame, block: int, *, chunk: int = 4096, cells: int = 4096) -> DataFrame:
    """The schedule: rows (slot, sid, rank), where rank numbers a source's slots in schedule order.

    Slot i takes the point frac((i + 1/2) * golden ratio); the source whose interval of cumulative slot shares
    holds it is drawn. Points and intervals meet on a grid of cells, so many sources stay cheap. Ranks are
    counted inside chunks of slots and carried over the chunks, so a source with a third of all slots is not
    ranked in one task. Each source gets just the slots that its target needs: draws beyond them lapse, and
    missing ones (a point set is even but not exact) close the schedule.
    """
    per_epoch = F.ceil(F.col("source_size") / block)
    whole = F.round("target").cast("long")
    rows = targets.where("source_size > 0").withColumn("words", whole).withColumn("epochs", F.expr("words div source_size"))
    rows = rows.withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
    rows = rows.select("sid", "source_size", "epochs", "rest", per_epoch.alias("blocks"), (F.col("epochs") * per_epoch + F.ceil(F.col("rest") / block)).alias("need"))
    high = F.sum("need").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0))
    rows = settle(rows.withColumn("high", high).withColumn("low", F.col("high") - F.col("need")), "shares")
    total = rows.agg(F.coalesce(F.sum("need"), F.lit(0)).alias("n")).first()["n"]
    width = max(total, 1) / cells
    grid = rows.where("need > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / width), F.floor(F.col("high") / width))))
    draws = rows.sparkSession.range(total).withColumn("turn", (F.col("id") + 0.5) * GOLDEN)
    draws = draws.withColumn("point", (F.col("turn") - F.floor("turn")) * total).withColumn("cell", F.floor(F.col("point") / width))
    drawn = draws.join(grid, "cell").where("point >= low and point < high")
    drawn = drawn.select(F.col("id").alias("slot"), "sid", "need", F.floor(F.col("id") / chunk).alias("chunk"))
    counts = drawn.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = settle(counts.select("sid", "chunk", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "slot-counts")
    ranked = drawn.withColumn("inside", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(counts, ["sid", "chunk"]).withColumn("rank", (F.col("before") + F.col("inside")).cast("long"))
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    short = rows.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < need")
    closing = short.select("sid", F.explode(F.sequence("got", F.col("need") - 1)).alias("rank"))
    closing = closing.select((F.lit(total) + F.col("rank")).alias("slot"), "sid", "rank")
    return ranked.where("rank < need").select("slot", "sid", "rank").unionByName(closing).join(rows.drop("need", "high", "low"), "sid")


def mix_sources(docs: DataFrame, *, weigh=repeating_weights, cap: float = 3.0, block: int = 256, seed: int = 11) -> DataFrame:
    """Words that a mix of the documents' sources takes from each document.

    Each source's documents are shuffled by hash and cut as one stream into blocks of ``block`` words; the
    schedule's slots of a source take its blocks in order, starting again after the last, until its target is
    filled (a last slot takes part of a block). Returns one row per document: doc_id, source, order_key, size,
    source_size, target, taken, and start (its place in its source's stream, null without words).

    ``docs`` needs doc_id, text and source; other columns are ignored. Null or empty text has size 0 and is never
    taken; null is a source of its own; repeated rows count as often as they come; no rows give no rows.
    """
    sizes = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("order_key"))
    sizes = settle(sizes, "sizes")
    targets = settle(source_targets(sizes, weigh, cap), "targets")
    known = targets.select("sid", F.col("source").alias("s"), "source_size", "target")
    keyed = sizes.join(known, sizes["source"].eqNullSafe(known["s"])).drop("s")
    full = settle(keyed.where("size > 0").withColumn("spread", spread_key(F.col("order_key"), F.col("doc_id"))), "keyed")
    placed = settle(running_start(full, "sid", ["spread", "order_key", "doc_id", "size"], "size", "start"), "placed")

    schedule = slots(targets, block)
    schedule = schedule.withColumn("epoch", F.expr("rank div blocks")).withColumn("block", F.pmod("rank", "blocks"))
    # in the last, partial epoch a block may be cut short by the target
    cut = F.when(F.col("epoch") == F.col("epochs"), F.least(F.lit(block), F.col("rest") - F.col("block") * block)).otherwise(F.lit(block))
    uses = schedule.withColumn("cut", cut.cast("long")).groupBy("sid", "block").agg(
        F.count_if(F.col("cut") == block).alias("whole"), F.max(F.when(F.col("cut") < block, F.col("cut"))).alias("part")
    )
    last = F.col("start") + F.col("size") - 1
    pieces = placed.select("sid", "start", "size", F.explode(F.sequence(F.expr(f"start div {block}"), F.floor(last / block))).alias("block"))
    base = F.col("block") * block
    low, high = F.greatest(F.col("start") - base, F.lit(0)), F.least(F.col("start") + F.col("size") - base, F.lit(block))
    words = F.col("whole") * (high - low) + F.greatest(F.lit(0), F.least(high, F.coalesce("part", F.lit(0))) - low)
    taken = pieces.join(uses, ["sid", "block"]).groupBy("sid", "start").agg(F.sum(words).alias("taken"))
    columns = ["doc_id", "source", "order_key", "size", "source_size", "target"]
    mixed = placed.join(taken, ["sid", "start"], "left").select(*columns, F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "start")
    empty = keyed.where("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("start"))
    return mixed.unionByName(empty)


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``: each as often as its words were taken, rounded.

    Only documents at the two ends of a source's cut are taken in part. Equal rows share their copies evenly; a
    document without words is never taken; no rows give no rows.
    """
    seed = options.get("seed", 11)
    copies = F.floor(F.col("taken") / F.col("size") + 0.5)
    wanted = mix_sources(docs, **options).where("size > 0").groupBy(F.col("doc_id").alias("_id"), F.col("order_key").alias("_key"))
    wanted = settle(wanted.agg(F.ceil(F.sum(copies) / F.count(F.lit(1))).cast("int").alias("_copies")).where("_copies > 0"), "copies")
    # the row travels as one struct, so its columns may have any names
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("key"))
    # merged at every size, so that small inputs show how large ones run
    matched = keyed.join(wanted.hint("merge"), keyed["doc_id"].eqNullSafe(wanted["_id"]) & (keyed["key"] == wanted["_key"])).select("row", "_copies")
    return matched.select("row", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("row.*")
