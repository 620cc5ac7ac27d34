"""Operator 13: benchmark decontamination by a prefix-filtered join of documents with the windows of benchmark items."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle
from tidemark.llm.terms import mixed, ranges, terms


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """The different (window, item): each run of ``window`` words of an item, or all its words if it has fewer but some."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = [word for piece in terms(text) for word in piece]
                size = min(window, len(words))
                starts = range(len(words) - size + 1) if words else range(0)
                for i in range(0, len(starts), 8192):
                    found = [b" ".join(words[s : s + size]) for s in starts[i : i + 8192]]
                    yield pa.record_batch({"window": pa.array(found, pa.binary()), "item": pa.array([item] * len(found), pa.string())})

    slim = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    return slim.mapInArrow(cut, "window binary, item string").distinct()


class Windows:
    """One block of windows as arrays: words as codes, the shingles of each window, the items that hold it."""

    def __init__(self, pairs: list[tuple[bytes, str]], shingle: int):
        pairs = sorted(pairs)
        self.items = np.array([item for _, item in pairs], dtype=object)
        first = [i for i, pair in enumerate(pairs) if i == 0 or pair[0] != pairs[i - 1][0]]
        texts = [pairs[i][0].split(b" ") for i in first]
        self.item_begin = np.array([*first, len(pairs)])
        self.known = {word: code for code, word in enumerate(sorted({word for words in texts for word in words}))}
        self.length = np.array([len(words) for words in texts], dtype=np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.codes = np.array([self.known[word] for words in texts for word in words], dtype=np.int32)
        self.size = np.minimum(self.length, shingle)
        #: by size, the hashes of all shingles of that size in order; ``at`` is where they begin among all
        self.hashes, self.at, count = {}, {}, 0
        self.owner, self.offset, self.number = [], [], []
        for size in np.unique(self.size):
            wide = np.flatnonzero(self.size == size)
            runs = self.length[wide] - size + 1
            where = ranges(self.begin[wide], runs)
            found = mixed(self.codes, int(size))[where]
            self.hashes[int(size)], number = np.unique(found, return_inverse=True)
            self.at[int(size)] = count
            self.owner.append(np.repeat(wide, runs))
            self.offset.append(where - np.repeat(self.begin[wide], runs))
            self.number.append(number.ravel() + count)
            count += len(self.hashes[int(size)])
        self.shingles = count
        self.owner, self.offset, self.number = (np.concatenate(part) for part in (self.owner, self.offset, self.number))

    def encode(self, text: str | None) -> np.ndarray:
        """The text's words as codes, -1 for a word of no window."""
        get = self.known.get
        parts = [np.fromiter(map(get, piece, repeat(-1)), np.int32, len(piece)) for piece in terms(text)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def shingles_in(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places in a document and the numbers of the shingles that begin there."""
        for size, hashes in self.hashes.items():
            found = mixed(codes, size)
            number = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            place = np.flatnonzero(hashes[number] == found)
            yield place, number[place] + self.at[size]

    def keep_prefixes(self, rarity: np.ndarray) -> None:
        """Order each window's shingles by rarity and index the window by its necessary prefix.

        A window that a document contains shares all its shingles with it, so a prefix of one, the rarest, is
        enough; a window whose rarest shingle is in no document is in none and isn't indexed.
        """
        order = np.lexsort((self.offset, self.number, rarity[self.number], self.owner))
        _, rarest = np.unique(self.owner[order], return_index=True)
        rarest = order[rarest]
        rarest = rarest[rarity[self.number[rarest]] > 0]
        rarest = rarest[np.argsort(self.number[rarest], kind="stable")]
        self.owner, self.offset = self.owner[rarest], self.offset[rarest]
        self.listed = np.searchsorted(self.number[rarest], np.arange(self.shingles + 1))

    def occurrences(self, codes: np.ndarray, chunk: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(windows, places): where windows occur in a document, each checked word by word."""
        for place, number in self.shingles_in(codes):
            many = self.listed[number + 1] - self.listed[number]
            busy = np.flatnonzero(many)
            until = np.cumsum(many[busy])
            cuts = np.searchsorted(until, np.arange(chunk, until[-1] + chunk, chunk)) + 1 if len(busy) else []
            for part in np.split(busy, cuts):
                entry = ranges(self.listed[number[part]], many[part])
                window, start = self.owner[entry], np.repeat(place[part], many[part]) - self.offset[entry]
                # bounds of place and length: the whole window must lie in the document
                fits = (start >= 0) & (start + self.length[window] <= len(codes))
                window, start = window[fits], start[fits]
                for length in np.unique(self.length[window]):
                    same = self.length[window] == length
                    w, s = window[same], start[same]
                    along = np.arange(length)
                    equal = (codes[s[:, None] + along] == self.codes[self.begin[w][:, None] + along]).all(axis=1)
                    yield w[equal], s[equal]


def union(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rows (begin, end) of the union of the given spans."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order]) if len(end) else end
    fresh = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]])) if len(begin) else np.zeros(0, np.int64)
    last = np.concatenate([fresh[1:] - 1, [len(begin) - 1]]) if len(begin) else fresh
    return np.stack([begin[fresh], end[last]], axis=1).astype(np.int64)


STATE = "n_words long, spans binary, items array<string>"


def find_benchmark(docs: DataFrame, items: DataFrame, *, window: int = 10, shingle: int = 3, block_bytes: int = 1 << 23) -> DataFrame:
    """One row per document: doc_id, n_words, spans (word places [begin, end) that item windows cover) and items (whose windows occur).

    Windows of ``window`` words of the items are sets of ``shingle``-word shingles. The shingles are ordered by the
    number of documents that hold them, counted over all documents; a window is joined with the documents that hold
    its necessary prefix, where it lies wholly inside the document, and its words are compared one by one.

    Documents stay where they are: the windows come to them in blocks of about ``block_bytes``, each broadcast with
    that bound, and a benchmark of several blocks takes one pass of all documents for each. No group of documents is
    gathered, so a passage that a third of them share is no different from one in a single document.

    A null or empty text has no words; an item without words has no window; a null item_id reads as an empty string,
    rows of equal item_id are one item; repeated documents are rows of their own and a null doc_id stays; other
    columns are ignored; no items give rows without spans, no documents no rows.
    """
    pairs = settle(item_windows(items, window), "windows")
    held = pairs.agg(F.sum(F.length("window") + F.length("item") + 64)).first()[0] or 0
    blocks = -(-held // block_bytes)
    kind = docs.schema["doc_id"].dataType.simpleString()
    empty = [F.lit(None).cast(part.split(" ", 1)[1]).alias(part.split(" ", 1)[0]) for part in STATE.split(", ")]
    state = docs.select("doc_id", "text", *empty)

    def counter(index: Windows):
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            holding = np.zeros(index.shingles, np.int64)
            for batch in batches:
                for text in batch["text"]:
                    for _, number in index.shingles_in(index.encode(text.as_py())):
                        holding[np.unique(number)] += 1
            met = np.flatnonzero(holding)
            yield pa.record_batch({"number": met, "n": holding[met]})

        return count

    def marker(index: Windows | None, last: bool):
        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words, spans, found = [], [], []
                for text, before, had in zip(batch["text"], batch["spans"], batch["items"], strict=True):
                    known = np.frombuffer(before.as_py() or b"", "<i8").reshape(-1, 2)
                    here, names, n = [known], set(had.as_py() or ()), 0
                    if index is None:
                        n = sum(len(piece) for piece in terms(text.as_py()))
                    else:
                        codes = index.encode(text.as_py())
                        n = len(codes)
                        for w, s in index.occurrences(codes):
                            here.append(union(s, s + index.length[w]))
                            seen = np.unique(w)
                            counts = index.item_begin[seen + 1] - index.item_begin[seen]
                            names.update(index.items[ranges(index.item_begin[seen], counts)])
                    joined = np.concatenate(here)
                    words.append(n)
                    spans.append(union(joined[:, 0], joined[:, 1]).astype("<i8").tobytes())
                    found.append(sorted(names))
                yield pa.record_batch({
                    "doc_id": batch["doc_id"], "text": pa.nulls(len(words), pa.string()) if last else batch["text"],
                    "n_words": pa.array(words, pa.int64()), "spans": pa.array(spans, pa.binary()), "items": pa.array(found, pa.list_(pa.string())),
                })

        return mark

    for block in range(max(1, blocks)):
        index = None
        if blocks:
            here = pairs.where(F.pmod(F.xxhash64("window", "item"), F.lit(blocks)) == block).collect()
            index = Windows([(bytes(row["window"]), row["item"]) for row in here], shingle) if here else None
        if index:
            counts = docs.select("text").mapInArrow(counter(index), "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
            rarity = np.zeros(index.shingles, np.int64)
            for row in counts.collect():
                rarity[row["number"]] = row["n"]
            index.keep_prefixes(rarity)
        last = block + 1 >= blocks
        state = state.mapInArrow(marker(index, last), f"doc_id {kind}, text string, {STATE}")
        state = state if last else settle(state, "marked")
    return state.select("doc_id", "n_words", "spans", "items")


def digests(found: DataFrame) -> DataFrame:
    """Of ``find_benchmark``'s rows: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [np.frombuffer(span, "<i8").reshape(-1, 2) for span in batch["spans"].to_pylist()]
            items = batch["items"].to_pylist()
            hit = pa.array([int((span[:, 1] - span[:, 0]).sum()) for span in spans], pa.int64())
            digest = [hashlib.sha256(",".join(sorted(names)).encode("utf-8", "surrogatepass")).hexdigest() for names in items]
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "n_words": batch["n_words"], "n_hit": hit, "n_items": pa.array([len(names) for names in items], pa.int64()),
                "items_sha256": pa.array(digest, pa.string()), "contaminated": pa.array([bool(len(span)) for span in spans], pa.bool_()),
            })

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(read, f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
