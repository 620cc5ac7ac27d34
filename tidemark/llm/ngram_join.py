"""Operator 8: join documents whose sets of word n-grams are alike, through a MinHash LSH forest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, settle

TREES, DEEPEST, SHALLOWEST = 32, 8, 3


class Shingler:
    """Sorted 64-bit hashes of a text's runs of ``n`` words; a text of fewer words is one run, one without words none.

    A word's hash is the value of the polynomial of its bytes at an odd number, modulo 2^64, taken for all words of
    a piece of the text at once from running sums.
    """

    BASE = 0x9E3779B97F4A7C15
    SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])

    def __init__(self, n: int, piece: int = 1 << 18):
        self.n, self.piece = n, piece
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            back = pow(self.BASE, -1, 1 << 64)
            self.up, self.down = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(2 * n, base, np.uint64)])) for base in (self.BASE, back))

    def _words(self, data: np.ndarray) -> np.ndarray:
        self._powers(len(data))
        blank = np.concatenate([[True], self.SPACE[data], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        begin, end = edges[0::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data + np.uint64(1)) * self.up[: len(data)], out=sums[1:])
        words = (sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64)
        words = (words ^ (words >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return words ^ (words >> np.uint64(29))

    def __call__(self, text: str | None) -> np.ndarray:
        raw, parts, begin = (text or "").encode("utf-8", "surrogatepass"), [], 0
        while begin < len(raw):
            end = min(len(raw), begin + self.piece)
            # a piece ends before a blank, however far that is
            while end < len(raw) and raw[end] not in b" \t\n\r\x0b\x0c":
                end += 1
            parts.append(self._words(np.frombuffer(raw, np.uint8, end - begin, begin)))
            begin = end
        codes = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
        if not len(codes):
            return codes
        n = min(self.n, len(codes))
        mixed = np.full(len(codes) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            mixed = (mixed ^ codes[i : len(codes) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def matched_depth(similarity: float, trees: int, deepest: int, recall: float) -> int:
    """The length of prefix to match: from the deepest, shortened until pairs of the similarity meet in some tree with the wanted recall."""
    for depth in range(deepest, 1, -1):
        if 1 - (1 - similarity**depth) ** trees >= recall:
            return depth
    return 1


class Signer:
    """A set's ordered signature in each tree: ``DEEPEST`` MinHash values of a byte each, the first one leading, as one non-negative number."""

    def __init__(self, trees: int, seed: int):
        draw = np.random.default_rng(seed)
        n = trees * DEEPEST
        self.turn = draw.integers(1 << 32, size=(n, 1), dtype=np.uint64).astype(np.uint32)
        self.times = draw.integers(1 << 31, size=(n, 1), dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.turn), np.iinfo(np.uint32).max, dtype=np.uint32)
        narrow = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
        for i in range(0, len(narrow), 2048):
            np.minimum(least, ((narrow[i : i + 2048] ^ self.turn) * self.times).min(axis=1), out=least)
        least = (least ^ (least >> np.uint32(15))) * np.uint32(0x9E3779B1)
        found = (least >> np.uint32(24)).astype(np.uint8).reshape(-1, DEEPEST)
        found[:, 0] &= 127
        return found.copy().view(">i8").ravel().astype(np.int64)


def shared_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the leading values two signatures share."""
    apart = a ^ b
    return sum(((apart >> np.int64(8 * (DEEPEST - k))) == 0).astype(np.int64) for k in range(1, DEEPEST + 1))


def prefix(signature: Column, depth: int) -> Column:
    return F.shiftright(signature, 8 * (DEEPEST - depth))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and text_key. Ids stay in columns that Python passes on as they are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_key", F.xxhash64("text"))


def signatures(docs: DataFrame, n: int, trees: int, seed: int) -> DataFrame:
    """doc_id, text_key, set_key (digest of the n-gram set), n_grams and the signature in each tree."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, signer = Shingler(n), Signer(trees, seed)
        for batch in batches:
            keys, sizes, found = [], [], []
            for text in batch["text"]:
                grams = shingle(text.as_py())
                keys.append(hashlib.md5(grams.tobytes()).hexdigest())
                sizes.append(len(grams))
                found.append(signer(grams))
            yield pa.record_batch({
                "doc_id": batch["doc_id"], "text_key": batch["text_key"], "set_key": pa.array(keys, pa.string()), "n_grams": pa.array(sizes, pa.int64()),
                "signature": pa.array(found, pa.list_(pa.int64())),
            })

    return keyed_texts(docs).mapInArrow(sign, "doc_id long, text_key long, set_key string, n_grams long, signature array<long>")


def tries(sets: DataFrame) -> DataFrame:
    """The forest: for each tree the signatures in order, as rows (rep, tree, signature, depth).

    Signatures are dealt out by range and sorted, so that equal prefixes lie side by side, and ``depth`` is the longest prefix
    that a row shares with the one before or after it. Rows that share fewer than ``SHALLOWEST`` values are left out.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, first = TaskContext.get().partitionId(), None, True

        def out(rows: np.ndarray, up: np.ndarray, down: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
            keep = (np.maximum(up, down) >= SHALLOWEST) | (edge > 0)
            columns = {"rep": rows[0], "tree": rows[1], "signature": rows[2], "up": up, "down": down, "edge": edge, "part": np.full(len(up), part)}
            return pa.record_batch({name: pa.array(values[keep], pa.int64()) for name, values in columns.items()})

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([np.asarray(batch[name]).astype(np.int64) for name in ("rep", "tree", "signature")])
            if last is not None:
                rows = np.concatenate([last[0], rows], axis=1)
            beside = np.where(rows[1, 1:] == rows[1, :-1], shared_prefix(rows[2, 1:], rows[2, :-1]), 0)
            up = np.concatenate([[0 if last is None else last[1]], beside])
            edge = np.zeros(len(up), np.int64)
            edge[0] = 1 if first else 0
            # the last row waits for its next neighbour
            if len(up) > 1:
                yield out(rows[:, :-1], up[:-1], beside, edge[:-1])
                first = False
            last = (rows[:, -1:], up[-1])
        if last is not None:
            yield out(last[0], np.array([last[1]]), np.array([0]), np.array([3 if first else 2]))

    every = sets.select("rep", F.posexplode("signature").alias("tree", "signature"))
    dealt = every.repartitionByRange("tree", "signature", "rep").sortWithinPartitions("tree", "signature", "rep")
    names = "rep long, tree long, signature long, up long, down long, edge long, part long"
    walked = settle(dealt.mapInArrow(walk, names), "tries")
    # two rows of each range at most lack a neighbour, which is in the next range
    ends = sorted(walked.where("edge > 0").collect(), key=lambda row: (row["part"], row["edge"] == 2))
    up, down = {}, {}
    for a, b in zip(ends, ends[1:], strict=False):
        if a["part"] != b["part"] and a["tree"] == b["tree"]:
            down[a["rep"], a["tree"]] = up[b["rep"], b["tree"]] = int(shared_prefix(np.array([a["signature"]]), np.array([b["signature"]]))[0])
    mended = [(r["rep"], r["tree"], r["signature"], max(r["up"], r["down"], up.get((r["rep"], r["tree"]), 0), down.get((r["rep"], r["tree"]), 0))) for r in ends]
    inner = walked.where("edge = 0").select("rep", "tree", "signature", F.greatest("up", "down").alias("depth"))
    outer = docs_of(walked, mended, "rep long, tree long, signature long, depth long")
    return inner.unionByName(outer).where(F.col("depth") >= SHALLOWEST)


def docs_of(like: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    return like.sparkSession.createDataFrame(rows, schema)


def audited_depths(docs: DataFrame, sets: DataFrame, forest: DataFrame, n: int, trees: int, seed: int, threshold: float, audit: int, audit_grams: int) -> list[int]:
    """Links of the audited documents with all others, found by comparing each with every text, by the longest prefix that its ends share in any tree.

    Audited are the ``audit`` sets of smallest digest among those with a neighbour in the forest, of ``audit_grams`` n-grams together at most.
    """
    near = forest.select("rep").distinct()
    first = sets.join(near, "rep", "left_semi").where(F.col("n_grams") <= audit_grams // 4).orderBy("set_key").limit(audit).select("least.text_key", "n_grams").collect()
    chosen, held = [], 0
    for row in first:
        held += row["n_grams"]
        if held <= audit_grams:
            chosen.append(row["text_key"])
    if not chosen:
        return [0] * (DEEPEST + 1)

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            yield pa.record_batch({"grams": pa.array([shingle(text.as_py()).tobytes() for text in batch["text"]], pa.binary())})

    wanted = keyed_texts(docs).where(F.col("text_key").isin(chosen)).select("text").distinct()
    audited = sorted({bytes(row["grams"]) for row in wanted.mapInArrow(grams_of, "grams binary").collect()})
    theirs = [np.frombuffer(grams, dtype=np.uint64) for grams in audited]
    signer = Signer(trees, seed)
    signed = np.stack([signer(grams) for grams in theirs])
    owner = np.repeat(np.arange(len(theirs)), [len(g) for g in theirs])
    order = np.argsort(np.concatenate(theirs), kind="stable")
    grams, owner = np.concatenate(theirs)[order], owner[order]
    sizes = np.array([len(g) for g in theirs])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, sign = Shingler(n), Signer(trees, seed)
        counts = np.zeros(DEEPEST + 1, np.int64)
        for batch in batches:
            for text in batch["text"]:
                mine = shingle(text.as_py())
                begin, end = np.searchsorted(grams, mine, "left"), np.searchsorted(grams, mine, "right")
                if not (end > begin).any():
                    continue
                met = np.concatenate([owner[b:e] for b, e in zip(begin, end, strict=True) if e > b])
                shared = np.bincount(met, minlength=len(sizes))
                linked = np.flatnonzero((shared >= threshold * (sizes + len(mine) - shared) - 1e-9) & (shared > 0) & ~((shared == sizes) & (shared == len(mine))))
                if len(linked):
                    np.add.at(counts, shared_prefix(signed[linked], sign(mine)).max(axis=1), 1)
        yield pa.record_batch({"depth": pa.array(range(DEEPEST + 1), pa.int64()), "n": pa.array(counts, pa.int64())})

    found = [0] * (DEEPEST + 1)
    for row in keyed_texts(docs).select("text").mapInArrow(compare, "depth long, n long").groupBy("depth").agg(F.sum("n").alias("n")).collect():
        found[row["depth"]] = row["n"]
    return found


def shortened(found: list[int], threshold: float, trees: int, recall: float) -> int:
    """The depth to match: shortened until a pair at the threshold is expected to meet, and the audited links do meet, with the wanted recall."""
    depth = matched_depth(threshold, trees, DEEPEST, recall)
    while depth > SHALLOWEST and sum(found[depth:]) < recall * sum(found):
        depth -= 1
    return depth


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of each left with each right set of hashes."""
    a, b = (np.concatenate(side) if side else np.zeros(0, dtype=np.uint64) for side in (left, right))
    owner_a, owner_b = (np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right))
    common = np.intersect1d(a, b)
    out = np.zeros(len(left) * len(right))
    code_a, code_b = np.searchsorted(common, a), np.searchsorted(common, b)
    keep_a, keep_b = (code < len(common) for code in (code_a, code_b))
    keep_a[keep_a] = common[code_a[keep_a]] == a[keep_a]
    keep_b[keep_b] = common[code_b[keep_b]] == b[keep_b]
    code_a, owner_a, code_b, owner_b = code_a[keep_a], owner_a[keep_a], code_b[keep_b], owner_b[keep_b]
    count_a, count_b = np.bincount(code_a, minlength=len(common)), np.bincount(code_b, minlength=len(common))
    # a hash in few sets is counted pair by pair, one in many by a matrix product
    often = count_a * count_b > 4096
    order = np.argsort(code_b, kind="stable")
    sorted_b, begins = owner_b[order], np.cumsum(count_b) - count_b
    rare = ~often[code_a]
    codes, owners = code_a[rare], owner_a[rare]
    for i in range(0, len(codes), 20_000):
        part, times = codes[i : i + 20_000], count_b[codes[i : i + 20_000]]
        place = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pairs = np.repeat(owners[i : i + 20_000], times) * len(right) + sorted_b[np.repeat(begins[part], times) + place]
        if len(pairs) * 8 > len(out):
            out += np.bincount(pairs, minlength=len(out))
        else:
            at, n = np.unique(pairs, return_counts=True)
            out[at] += n
    out = out.reshape(len(left), len(right))
    number = np.cumsum(often) - 1
    busy_a, busy_b = often[code_a], often[code_b]
    columns_a, rows_a, columns_b, rows_b = number[code_a[busy_a]], owner_a[busy_a], number[code_b[busy_b]], owner_b[busy_b]
    for i in range(0, int(often.sum()), 2048):
        here_a, here_b = (columns_a >= i) & (columns_a < i + 2048), (columns_b >= i) & (columns_b < i + 2048)
        x, y = np.zeros((len(left), 2048), dtype=np.float32), np.zeros((len(right), 2048), dtype=np.float32)
        x[rows_a[here_a], columns_a[here_a] - i] = 1
        y[rows_b[here_b], columns_b[here_b] - i] = 1
        out += x @ y.T
    return out


def roots(n: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The smallest member of each of n nodes' components, by hooking and shortcuts on arrays."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[first], root[second])
        before = root.copy()
        np.minimum.at(root, root[first], low)
        np.minimum.at(root, root[second], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return root


def similar(left: list[np.ndarray], right: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of non-empty sets have at least the threshold's Jaccard similarity."""
    shared = overlaps(left, right)
    union = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - shared
    return (shared >= threshold * union - 1e-9) & (shared > 0)


def compared(left: list[np.ndarray], right: list[np.ndarray], threshold: float, same: bool, met: np.ndarray | None, chunk: int = 1024):
    """(first, second) places of linked pairs, a chunk of each side at a time; ``met`` marks pairs that are compared elsewhere."""
    for i in range(0, len(left), chunk):
        for j in range(i if same else 0, len(right), chunk):
            if met is not None and met[i : i + chunk, j : j + chunk].all():
                continue
            linked = similar(left[i : i + chunk], right[j : j + chunk], threshold)
            if met is not None:
                linked &= ~met[i : i + chunk, j : j + chunk]
            if same and i == j:
                linked = np.triu(linked, 1)
            first, second = np.nonzero(linked)
            yield first + i, second + j


def units(forest: DataFrame, sets: DataFrame, depth: int, crowd: int, block_docs: int, block_grams: int) -> DataFrame:
    """Where candidates are compared: rows (rep, tree, node, low, high, block, codes, group), each a set's part in one unit.

    A unit is a node of a tree whose prefix at least two sets share, or two blocks of a group. Nodes of more than
    ``crowd`` sets that have sets in common are one group, whose pairs are compared by blocks once for all its nodes.
    Two sets may share several nodes: they are compared in the first of their group and the trees in order, which each
    row's ``codes`` tell, and a node whose sets have all met before is left out.
    """
    nodes = forest.where(F.col("depth") >= depth).select("rep", F.col("tree").cast("int").alias("tree"), prefix(F.col("signature"), depth).alias("node"))
    sized = nodes.groupBy("tree", "node").agg((F.count(F.lit(1)) > crowd).alias("crowded"), F.min("rep").alias("centre"))
    nodes = settle(nodes.join(sized, ["tree", "node"]), "tree-nodes")
    in_crowds, own = nodes.where("crowded").select(F.col("rep").alias("a"), F.col("centre").alias("b")), nodes.where("not crowded")
    groups = components(in_crowds) if in_crowds.take(1) else docs_of(forest, [], "node long, root long")
    groups = groups.select(F.col("node").alias("rep"), F.col("root").alias("group"))
    placed = own.groupBy("rep").agg(*[F.max(F.when(F.col("tree") == i, F.col("node"))).alias(f"_c{i}") for i in range(TREES)])
    # a set that has no node in a tree, or no group, has a number there that no other has
    alone = -1 - F.col("rep")
    placed = placed.join(groups, "rep", "left").select("rep", F.coalesce("group", alone).alias("group"), *[F.coalesce(f"_c{i}", alone).alias(f"_c{i}") for i in range(TREES)])
    coded = settle(placed.select("rep", "group", F.array(*[f"_c{i}" for i in range(TREES)]).alias("codes")), "codes")
    each = coded.select("rep", "group", "codes", F.posexplode("codes").alias("tree", "node")).where("node >= 0")
    alike = [F.min("group").alias("_g"), F.max("group").alias("_h"), F.count(F.lit(1)).alias("size")]
    for i in range(TREES):
        alike += [F.min(F.col("codes")[i]).alias(f"_a{i}"), F.max(F.col("codes")[i]).alias(f"_b{i}")]
    spans = each.groupBy("tree", "node").agg(*alike)
    before = F.col("_g") == F.col("_h")
    for i in range(TREES):
        before = before | ((F.col("tree") > i) & (F.col(f"_a{i}") == F.col(f"_b{i}")))
    needed = settle(spans.where((F.col("size") > 1) & ~before).select("tree", "node"), "nodes")
    zero = F.lit(0).alias
    small = each.join(needed, ["tree", "node"]).select("rep", F.col("tree").cast("int").alias("tree"), "node", zero("low"), zero("high"), zero("block"), "codes", "group")
    counted = groups.join(sets.select("rep", "n_grams"), "rep")
    blocks = counted.groupBy("group").agg(F.ceil(F.greatest(F.count(F.lit(1)) / block_docs, F.sum("n_grams") / block_grams)).cast("int").alias("blocks"))
    dealt = counted.join(settle(blocks, "blocks"), "group").withColumn("block", F.pmod(F.xxhash64("rep"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    large = dealt.select("rep", "group", "block", other).select(
        "rep", F.lit(-1).alias("tree"), F.col("group").alias("node"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
        F.array().cast("array<bigint>").alias("codes"), "group",
    )
    return settle(small.unionByName(large), "units")


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of ``wanted`` (rep, _w, _t), by doc_id and text_key.

    A map of 2^24 bits, 2 MB, of the keys' hashes goes to all tasks first, so that texts that can't be wanted aren't shuffled.
    """
    bit = lambda key: F.pmod(key, F.lit(1 << 24))
    maps = wanted.groupBy(F.bitmap_bucket_number(bit(F.col("_t"))).alias("_number")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit(F.col("_t")))).alias("_map"))
    texts = keyed_texts(docs)
    at = F.bitmap_bit_position(bit(F.col("text_key"))).cast("int")
    byte = F.conv(F.hex(F.substring("_map", F.shiftright(at, 3) + 1, F.lit(1))), 16, 10).cast("int")
    held = texts.join(F.broadcast(settle(maps, "key-maps")), F.bitmap_bucket_number(bit(F.col("text_key"))) == F.col("_number"))
    held = held.where(F.getbit(byte, at.bitwiseAND(7)) == 1).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "text")
    # merged at every size, so that small inputs show how large ones run
    found = held.join(wanted.hint("merge"), held["_id"].eqNullSafe(wanted["_w"]) & (held["_key"] == wanted["_t"]))
    return found.dropDuplicates(["rep"]).select("rep", "text")


def join_ngrams(
    docs: DataFrame, *, n: int = 5, threshold: float = 0.8, recall: float = 0.9999, audit: int = 256, audit_grams: int = 1 << 20, seed: int = 7,
    crowd: int = 64, block_docs: int = 4096, block_grams: int = 6_000_000,
) -> DataFrame:
    """One row per document: doc_id, text_key, copy_id, class_id, n_links and keep.

    Documents link when their sets of ``n``-word runs have a Jaccard similarity of at least ``threshold``.
    ``copy_id`` is the smallest doc_id with the same set, ``class_id`` the smallest one reachable by links,
    ``n_links`` the number of other documents linked directly and ``keep`` marks one row's identity (smallest
    doc_id, then text_key) per class.

    Equal sets are one representative from the start, so copies are never paired. Each representative's ordered
    MinHash signatures stand sorted in the tries of a forest, where sets with a prefix in common are neighbours. Matching
    begins with the longest prefix and shortens it until a pair at the threshold is expected to meet in some tree
    with the wanted recall, and links of up to ``audit`` documents with all others, found by comparing each with every
    text, do so too. Sets that share a node at that depth are compared exactly, each pair in one place (``units``);
    only counts and one edge per set leave a task.

    Null or empty texts have no runs and link with nothing, texts of fewer than ``n`` words are one run of all
    their words; white space and its kind don't matter; repeated rows are documents of their own; a null doc_id counts
    as an id that is never the smallest; other columns are ignored; no rows give no rows.
    """
    slim = settle(signatures(docs, n, TREES, seed), "signatures")
    sets = slim.where("n_grams > 0").groupBy("set_key").agg(
        F.count(F.lit(1)).alias("members"), F.first("n_grams").alias("n_grams"), F.first("signature").alias("signature"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("least"),
    )
    sets = settle(sets.withColumn("rep", F.monotonically_increasing_id()), "sets")
    forest = tries(sets)
    depth = shortened(audited_depths(docs, sets, forest, n, TREES, seed, threshold, audit, audit_grams), threshold, TREES, recall)
    rows = units(forest, sets, depth, crowd, block_docs, block_grams)

    chosen = rows.select("rep").distinct()
    wanted = settle(sets.join(chosen, "rep").select("rep", "members", F.col("least.doc_id").alias("_w"), F.col("least.text_key").alias("_t")), "wanted")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(n)
        for batch in batches:
            yield pa.record_batch({"rep": batch["rep"], "grams": pa.array([shingle(text.as_py()).tobytes() for text in batch["text"]], pa.binary())})

    grams = settle(wanted_texts(docs, wanted).mapInArrow(hashes, "rep long, grams binary"), "grams")
    rows = rows.join(wanted.select("rep", "members"), "rep").join(grams, "rep")
    by = ["tree", "node", "low", "high"]
    dealt = rows.repartition(*by).sortWithinPartitions(*by).select(*by, "rep", "members", "block", "codes", "group", "grams")
    links = settle(dealt.mapInArrow(verifier(threshold), "rep long, links long, root long"), "links")
    counts = links.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = sets.select("rep", "set_key", "members", "least").join(classes.withColumnRenamed("node", "rep"), "rep", "left").join(counts, "rep", "left")
    named = settle(named.withColumn("root", F.coalesce("root", "rep")), "classes")
    class_least = named.groupBy("root").agg(F.min("least").alias("class_least"))
    named = named.join(class_least, "root").select("set_key", "least", "class_least", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    joined = slim.drop("signature").join(named, "set_key", "left")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    with_runs = F.col("n_grams") > 0
    return joined.select(
        "doc_id", "text_key", F.when(with_runs, F.col("least.doc_id")).otherwise(F.col("doc_id")).alias("copy_id"),
        F.when(with_runs, F.col("class_least.doc_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(with_runs, own.eqNullSafe(F.col("class_least"))).otherwise(F.lit(True)).alias("keep"),
    )


def verifier(threshold: float):
    """A function of batches sorted by unit that compares the sets of each and gives (rep, links, root) of those that link."""

    def verify(unit: tuple, held: pa.Table) -> pa.RecordBatch | None:
        tree, low, high = unit[0], unit[2], unit[3]
        block, reps, members = (np.asarray(held[name]) for name in ("block", "rep", "members"))
        sides = [np.flatnonzero(block == low)]
        sides.append(sides[0] if low == high else np.flatnonzero(block == high))
        met = None
        if tree >= 0:
            codes, group = np.array(held["codes"].to_pylist(), dtype=np.int64), np.asarray(held["group"])
            met = group[:, None] == group[None, :]
            for i in range(tree):
                met |= codes[:, i][:, None] == codes[:, i][None, :]
        grams = [np.frombuffer(g.as_py(), dtype=np.uint64) for g in held["grams"]]
        counts, edges = np.zeros(len(reps), np.int64), []
        for first, second in compared([grams[i] for i in sides[0]], [grams[i] for i in sides[1]], threshold, low == high, met):
            first, second = sides[0][first], sides[1][second]
            np.add.at(counts, first, members[second])
            np.add.at(counts, second, members[first])
            root = roots(len(reps), first, second)
            moved = np.flatnonzero(root != np.arange(len(reps)))
            edges.append((moved, root[moved]))
        linked = np.flatnonzero(counts)
        if not len(linked):
            return None
        root = roots(len(reps), *(np.concatenate(side) for side in zip(*edges, strict=True)))
        return pa.record_batch({"rep": reps[linked], "links": counts[linked], "root": reps[root[linked]]})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            keys = np.stack([np.asarray(batch[name]).astype(np.int64) for name in ("tree", "node", "low", "high")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for begin, end in zip(cuts, cuts[1:], strict=False):
                if begin == end:
                    continue
                here = tuple(keys[:, begin].tolist())
                if here != unit:
                    found = verify(unit, pa.Table.from_batches(held)) if held else None
                    if found:
                        yield found
                    unit, held = here, []
                held.append(batch.slice(begin, end - begin))
        found = verify(unit, pa.Table.from_batches(held)) if held else None
        if found:
            yield found

    return read


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """One document of each class of near copies, with the columns of ``docs``; documents without words all stay.

    Of rows equal in doc_id and text one stays.
    """
    kept = join_ngrams(docs, **options).where("keep").select("text_key", F.xxhash64("doc_id").alias("id_key"))
    kept = settle(kept.distinct().select(F.col("text_key").alias("_text_key"), F.col("id_key").alias("_id_key")), "kept")
    # the row travels as one struct, so its columns may have any names; rows with words are one per key, others stand for themselves
    alone = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
    keyed = docs.select(
        F.struct("*").alias("row"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text_key"), F.xxhash64(F.col("doc_id").cast("long")).alias("_id_key"), alone.alias("_alone")
    )
    matched = keyed.join(kept.hint("merge"), ["_text_key", "_id_key"])
    return matched.dropDuplicates(["_text_key", "_id_key", "_alone"]).select("row.*")
