"""Operator 11: ranked lexical search through hashed max-sketches, with exact rescoring in descending order of bounds."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import settle
from tidemark.llm.terms import terms

#: Impacts are below 1,000,000; a sketch holds them in steps of 16, rounded up, as 16 bits.
IMPACT, STEP = 1_000_000_000, 16


class Digests:
    """64-bit digests of terms, the latest ones held."""

    def __init__(self, held: int = 300_000):
        self.held, self.known = held, {}

    def __call__(self, found: list[bytes]) -> np.ndarray:
        if len(self.known) > self.held:
            self.known.clear()
        known, out = self.known, np.empty(len(found), dtype=np.int64)
        for i, term in enumerate(found):
            value = known.get(term)
            if value is None:
                value = known[term] = int.from_bytes(hashlib.blake2b(term, digest_size=8).digest(), "little", signed=True)
            out[i] = value
        return out


def coordinate(digests: np.ndarray, coordinates: int) -> np.ndarray:
    return ((digests.view(np.uint64) >> np.uint64(20)) % np.uint64(coordinates)).astype(np.int64)


def impacts(tf: np.ndarray, m: np.ndarray | int) -> np.ndarray:
    return IMPACT * tf // (1000 * tf + 20 * m)


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's documents with a term, and their terms with repeats."""
    holding = length = 0
    for batch in batches:
        for text in batch["text"]:
            n = sum(len(piece) for piece in terms(text.as_py()))
            holding, length = holding + (n > 0), length + n
    yield pa.record_batch({"holding": pa.array([holding], pa.int64()), "length": pa.array([length], pa.int64())})


def build_index(docs: DataFrame, holding: int, length: int, coordinates: int) -> DataFrame:
    """doc_id, m, its terms' digests (rising) and frequencies, and the sketch: for each coordinate the largest impact that falls there."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = Digests()
        for batch in batches:
            rows: list[tuple] = []
            for text in batch["text"]:
                counts: Counter = Counter()
                for piece in terms(text.as_py()):
                    counts.update(piece)
                numbers = digest(list(counts))
                tf = np.fromiter(counts.values(), np.int64, len(counts))
                order = np.argsort(numbers)
                numbers, tf = numbers[order], tf[order]
                m = 50 + 50 * int(tf.sum()) * holding // max(1, length)
                sketch = np.zeros(coordinates, dtype=np.uint16)
                np.maximum.at(sketch, coordinate(numbers, coordinates), (-(-impacts(tf, m) // STEP)).astype(np.uint16))
                rows.append((m, numbers.tobytes(), tf.tobytes(), sketch.tobytes()))
            m, numbers, tf, sketch = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "m": pa.array(m, pa.int64()), "terms": pa.array(numbers, pa.binary()), "tfs": pa.array(tf, pa.binary()), "sketch": pa.array(sketch, pa.binary()),
            })

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(index, "doc_id long, m long, terms binary, tfs binary, sketch binary")


def item_terms(items: DataFrame) -> DataFrame:
    """row, item_id, the digests of the item's different terms and their number."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = Digests()
        for batch in batches:
            found = [np.sort(digest(list({term for piece in terms(text.as_py()) for term in piece}))) for text in batch["text"]]
            yield pa.record_batch({
                "row": batch["row"], "item_id": batch["item_id"],
                "terms": pa.array([f.tobytes() for f in found], pa.binary()), "n": pa.array([len(f) for f in found], pa.int64()),
            })

    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("row"), "item_id", "text")
    return numbered.mapInArrow(read, f"row long, item_id {kind}, terms binary, n long").where("n > 0")


class Queries:
    """A block of items: its different terms, the weights of each item's terms, and these by coordinate of the sketch."""

    def __init__(self, found: list[np.ndarray], coordinates: int):
        self.vocabulary = np.unique(np.concatenate(found))
        self.terms = [np.searchsorted(self.vocabulary, f) for f in found]
        self.coordinates = coordinates

    def weigh(self, df: np.ndarray, holding: int) -> None:
        self.weight = np.array([math.floor(1000 * math.log((2 * holding + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64)
        at = coordinate(self.vocabulary, self.coordinates)
        self.by_coordinate = np.zeros((self.coordinates, len(self.terms)))
        for q, mine in enumerate(self.terms):
            np.add.at(self.by_coordinate[:, q], at[mine], self.weight[mine] * STEP)

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """No document's score is above its bound; sums of whole numbers, exact in doubles."""
        return sketches.astype(np.float64) @ self.by_coordinate

    def occurring(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the digests are terms of the block, and their places in its vocabulary."""
        at = np.minimum(np.searchsorted(self.vocabulary, numbers), len(self.vocabulary) - 1)
        known = np.flatnonzero(self.vocabulary[at] == numbers)
        return known, at[known]


class Best:
    """The k best documents of one item so far: score, whether the id is null, id."""

    def __init__(self, k: int):
        self.k, self.score, self.null, self.id = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    def least(self) -> int:
        """A document below this score can't be among the best any more."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        score, null, ids = (np.concatenate(pair) for pair in ((self.score, score), (self.null, null), (self.id, ids)))
        order = np.lexsort((ids, null, -score))
        order = order[score[order] > 0][: self.k]
        self.score, self.null, self.id = score[order], null[order], ids[order]


def search(queries: Queries, k: int, chunk: int = 64):
    """A function of the index's batches that gives each task's k best documents of each item."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries.terms]
        width = len(queries.vocabulary)
        slice_rows = max(1, min(512, (1 << 22) // width))
        for batch in batches:
            for begin in range(0, batch.num_rows, slice_rows):
                part = batch.slice(begin, slice_rows)
                null = np.asarray(part["doc_id"].is_null())
                ids = np.asarray(part["doc_id"].fill_null(0))
                sketches = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint16).reshape(len(ids), -1)
                bounds = queries.bounds(sketches)
                least = np.array([b.least() for b in best])
                hopeful = bounds >= least
                chosen = np.flatnonzero(hopeful.any(axis=1))
                if not len(chosen):
                    continue
                exact = exact_impacts(queries, part.take(pa.array(chosen)))
                bounds, null, ids, hopeful = bounds[chosen], null[chosen], ids[chosen], hopeful[chosen]
                for q in np.flatnonzero(hopeful.any(axis=0)):
                    falling = np.flatnonzero(hopeful[:, q])
                    falling = falling[np.argsort(-bounds[falling, q], kind="stable")]
                    for at in range(0, len(falling), chunk):
                        # the threshold rises with every chunk; the first bound below it ends the item's search
                        some = falling[at : at + chunk]
                        some = some[bounds[some, q] >= best[q].least()]
                        if not len(some):
                            break
                        mine = queries.terms[q]
                        best[q].add(exact[np.ix_(some, mine)].astype(np.int64) @ queries.weight[mine], null[some], ids[some])
        number = np.repeat(np.arange(len(best)), [len(b.score) for b in best])
        joined = [np.concatenate([getattr(b, name) for b in best]) if best else [] for name in ("score", "id", "null")]
        yield pa.record_batch({"number": pa.array(number, pa.int64()), "doc_id": pa.array(joined[1], pa.int64(), mask=joined[2]), "score": pa.array(joined[0], pa.int64())})

    return read


def exact_impacts(queries: Queries, part: pa.RecordBatch) -> np.ndarray:
    """The impact of each of the block's terms in each of the documents."""
    lengths = np.array([len(t) // 8 for t in part["terms"].to_pylist()])
    numbers = np.frombuffer(b"".join(part["terms"].to_pylist()), np.int64)
    tfs = np.frombuffer(b"".join(part["tfs"].to_pylist()), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    known, place = queries.occurring(numbers)
    out = np.zeros((len(lengths), len(queries.vocabulary)), dtype=np.int32)
    out[owner[known], place] = impacts(tfs[known], np.asarray(part["m"])[owner[known]])
    return out


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = 50, coordinates: int = 1024, block_terms: int = 8192) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item_id, rank (from 1), doc_id and score.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased, over whole texts; of N
    documents with a term, L terms in all and df documents that hold a term, its weight is floor(1000 ln((2N + 2) / (2 df + 1))),
    a document of n terms has m = 50 + (50 n N) div L, and scores the sum over an item's different terms of weight times
    impact, (10^9 tf) div (1000 tf + 20 m). Equal scores are ranked by ascending doc_id, null last.

    The index has a row for every document: its terms and frequencies, and a sketch of ``coordinates`` numbers, to
    which the impacts are folded by hashed maxima. Items come in blocks of about ``block_terms`` terms, the only thing
    broadcast. A task takes a slice of the index at a time, looks all items of the block up in the sketches, which gives
    upper bounds, and rescores exactly by falling bound until the bounds fall below the k-th best score. The tasks'
    best are merged in two steps. Terms are known by 64-bit digests.

    A null or empty text has no terms; an item without terms has no rows; rows of equal item_id are ranked apart;
    repeated documents are documents of their own; a null item_id stays; other columns are ignored; no documents or no
    items give no rows.
    """
    sizes = docs.select("text").mapInArrow(add_up, "holding long, length long")
    holding, length = sizes.agg(F.coalesce(F.sum("holding"), F.lit(0)), F.coalesce(F.sum("length"), F.lit(0))).first()
    index = settle(build_index(docs, holding, length, coordinates), "index")
    wanted = settle(item_terms(items), "items")
    blocks = -(-(wanted.agg(F.sum("n")).first()[0] or 0) // block_terms)
    kind = items.schema["item_id"].dataType.simpleString()
    found = None
    for block in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).orderBy("row").collect()
        if not rows:
            continue
        queries = Queries([np.frombuffer(bytes(row["terms"]), np.int64) for row in rows], coordinates)
        queries.weigh(document_frequencies(index, queries), holding)
        names = docs.sparkSession.createDataFrame([(i, row["row"], row["item_id"]) for i, row in enumerate(rows)], f"number long, row long, item_id {kind}")
        best = index.mapInArrow(search(queries, k), "number long, doc_id long, score long").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(64)))
        named = best.join(F.broadcast(names), "number").drop("number")
        found = named if found is None else found.unionByName(named)
    if found is None:
        return items.where(F.lit(False)).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = found.withColumn("_near", F.row_number().over(Window.partitionBy("row", "part").orderBy(*order))).where(F.col("_near") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("row").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def document_frequencies(index: DataFrame, queries: Queries) -> np.ndarray:
    """For each term of the block, the number of documents that hold it, over the whole index."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding = np.zeros(len(queries.vocabulary), np.int64)
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                numbers = np.frombuffer(b"".join(batch["terms"].slice(begin, 512).to_pylist()), np.int64)
                holding += np.bincount(queries.occurring(numbers)[1], minlength=len(holding))
        met = np.flatnonzero(holding)
        yield pa.record_batch({"term": pa.array(met, pa.int64()), "n": pa.array(holding[met], pa.int64())})

    df = np.zeros(len(queries.vocabulary), np.int64)
    for row in index.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[row["term"]] = row["n"]
    return df
