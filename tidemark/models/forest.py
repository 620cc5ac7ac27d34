"""Random forests on rows kept as blocks of binned columns: trees are grown and kept by the tasks, never by the driver."""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext, cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.models.blocks import BINS, EPSILON, bin_limits, binary_columns, stacked
from tidemark.skew import settle

# executors need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows up to which Spark's own forest is fitted, whose draws depend on how its rows are dealt.
PLAIN = 4_000
#: Rows from which one task grows a tree or a part of one.
UNIT = 4_000_000
#: Trees times rows that are worth a task of their own, when they are grown and when they score.
GROWN_PER_TASK, SCORED_PER_TASK = 500_000, 2_000_000
#: Bytes of trees, and rows, with which one task scores.
TREE_BYTES, SCORED_ROWS = 16_000_000, 2_000_000
#: Nodes and rows whose statistics are worked out together.
NODES, STEP = 1024, 1 << 18
#: As many classes as Spark's forests take.
CLASSES = 100
#: In place of a leaf's column.
LEAF = (1 << 16) - 1
TREES = "unit int, tree int, node long, columns binary, cuts binary, children binary, shares binary, gains array<double>, totals array<double>"

#: Block number, bins by row and column, classes and weights of some rows.
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]


class BlockForest(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Grows the kind of forest that Spark's RandomForestClassifier grows on all rows: its bins, impurity, stops, Poisson draws of the rows and samples of the columns.

    Up to ``PLAIN`` rows it is Spark's own fit. Above, the draws are of another generator and do not depend on how the rows are
    dealt. The tops of trees over more than ``unit`` rows are grown from the tasks' added-up statistics; below, the rows of
    a node come to one task, which grows that part of the tree to its end. Grown parts are written to the shared
    folder and never come to the driver, which holds the tops and a few numbers for each part.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class numbers from 0", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weights, if any", TypeConverters.toString)
    trees = Param(Params._dummy(), "trees", "trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    plain = Param(Params._dummy(), "plain", "rows up to which it is Spark's own fit", TypeConverters.toInt)
    unit = Param(Params._dummy(), "unit", "rows that come to one task", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "of the draws", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str = "", trees: int = 100, depth: int = 30,
        plain: int = PLAIN, unit: int = UNIT, seed: int = 42,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", weightCol="", trees=100, depth=30, plain=PLAIN, unit=UNIT, seed=42)
        self._set(**self._input_kwargs)

    def spark_forest(self) -> RandomForestClassifier:
        get = {param.name: self.getOrDefault(param) for param in self.params}
        # each row's place in each tree is kept beside it, or Spark sends all trees to the tasks for every level
        model = RandomForestClassifier(
            featuresCol=get["featuresCol"], labelCol=get["labelCol"], numTrees=get["trees"], maxDepth=get["depth"], minInstancesPerNode=1, cacheNodeIds=True, seed=get["seed"]
        )
        return model.setWeightCol(get["weightCol"]) if get["weightCol"] else model

    def _fit(self, df: DataFrame):
        get = {param.name: self.getOrDefault(param) for param in self.params}
        if df.limit(get["plain"] + 1).count() <= get["plain"]:
            return self.spark_forest().fit(df)
        weight = F.col(get["weightCol"]).cast("double") if get["weightCol"] else F.lit(1.0)
        rows = df.select(vector_to_array(get["featuresCol"]).alias("x"), F.col(get["labelCol"]).cast("double").alias("y"), weight.alias("w"))
        limits = bin_limits(rows, binary_columns(df, get["featuresCol"]), get["seed"], CLASSES)
        if len(limits) >= LEAF:
            raise ValueError(f"forests take fewer than {LEAF} columns")

        def packed(batches):
            return pack(batches, limits)

        # settled, a block holds the same rows in every task that draws from it
        held = settle(rows.mapInArrow(packed, "block long, n long, classes int, bins binary, y binary, w binary"), "blocks")
        state = held.agg(F.sum("n").alias("n"), F.max("classes").alias("classes")).first()
        blocks = held.rdd.map(lambda row: opened(row, len(limits)))
        grower = Grower(get["seed"], len(limits), state["classes"], get["depth"], math.ceil(math.sqrt(len(limits))) if get["trees"] > 1 else len(limits))
        if state["n"] <= get["unit"]:
            tops, leaves, units = {}, {}, [(tree, 1) for tree in range(get["trees"])]
            grown = _whole_trees(blocks, grower, units, state["n"])
        else:
            tops, leaves, units = _grow_tops(blocks, grower, get["trees"], get["unit"])
            grown = _parts(blocks, grower, tops, units)
        table = settle(df.sparkSession.createDataFrame(grown, TREES), "trees")
        gains, sizes = np.zeros((get["trees"], len(limits))), {}
        size = sum(F.length(name) for name in ("columns", "cuts", "children", "shares"))
        # a few numbers for each part
        for row in table.select("unit", "tree", "node", F.length("cuts").alias("nodes"), size.alias("bytes"), "gains", "totals").collect():
            gains[row["tree"]] += row["gains"]
            if row["nodes"] == 1:
                leaves[row["tree"], row["node"]] = np.array(row["totals"])
            else:
                sizes[row["unit"]] = (row["unit"], row["tree"], row["node"], row["bytes"])
        _prune_tops(tops, leaves)
        for (tree, _), (column, _, gain) in tops.items():
            gains[tree, column] += gain
        about = {
            "path": table.inputFiles()[0].rsplit("/", 1)[0], "classes": state["classes"], "limits": [limit.tolist() for limit in limits], "trees": get["trees"], "gains": gains.tolist(),
            "tops": [[tree, node, column, cut] for (tree, node), (column, cut, _) in sorted(tops.items())], "units": sorted(sizes.values()),
            "leaves": [[tree, node, *_shares(totals).tolist()] for (tree, node), totals in sorted(leaves.items())],
        }
        return BlockForestModel(featuresCol=get["featuresCol"], forest=json.dumps(about))


class BlockForestModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted ``BlockForest``: adds the trees' votes, as Spark's forests do. Its trees lie under ``spark.checkpoint.dir``, or where it was saved."""

    featuresCol = BlockForest.featuresCol
    forest = Param(Params._dummy(), "forest", "where the trees are, and what is known of them, as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", forest: str = "{}"):
        super().__init__()
        self._setDefault(featuresCol="features", forest="{}")
        self._set(**self._input_kwargs)

    @property
    def about(self) -> dict:
        return json.loads(self.getOrDefault(self.forest))

    @property
    def featureImportances(self) -> DenseVector:
        """Gains of the splits by column, each tree's summing to 1 and then all."""
        gains = np.array(self.about["gains"])
        whole = gains.sum(axis=1, keepdims=True)
        mean = np.divide(gains, whole, out=np.zeros_like(gains), where=whole > 0).sum(axis=0)
        return DenseVector(mean / mean.sum() if mean.sum() else mean)

    def first(self, n: int) -> BlockForestModel:
        """The forest of the first n trees."""
        about = self.about
        kept = {"trees": n, "gains": about["gains"][:n]} | {name: [row for row in about[name] if row[place] < n] for name, place in (("tops", 0), ("units", 1), ("leaves", 0))}
        return BlockForestModel(featuresCol=self.getOrDefault(self.featuresCol), forest=json.dumps(about | kept))

    def _transform(self, df: DataFrame) -> DataFrame:
        about = self.about
        limits = [np.array(limit) for limit in about["limits"]]
        # settled, a row keeps its number
        rows = settle(df.withColumn("_tm_row", F.monotonically_increasing_id()), "scored")
        n = rows.count()
        if n == 0:
            return self._voted(rows.withColumn("_tm_votes", F.array().cast("array<double>")))

        def packed(batches):
            for ids, x in stacked(batches, ["_tm_row", "x"]):
                yield pa.RecordBatch.from_pydict({"rows": [ids.tobytes()], "bins": [binned(x, limits).tobytes()]})

        blocks = rows.select("_tm_row", vector_to_array(self.getOrDefault(self.featuresCol)).alias("x")).mapInArrow(packed, "rows binary, bins binary")
        trees = df.sparkSession.read.schema(TREES).parquet(about["path"]).where(F.col("tree") < about["trees"])
        votes = df.sparkSession.createDataFrame(_votes(blocks.rdd, trees.rdd, about, n, df.sparkSession.sparkContext.defaultParallelism), "rows binary, votes binary")
        classes = about["classes"]

        def one_by_one(batches):
            for batch in batches:
                for ids, sums in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                    offsets = np.arange(0, len(sums) // 8 + 1, classes, dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, np.int64)), pa.ListArray.from_arrays(offsets, np.frombuffer(sums))], ["_tm_row", "_tm_votes"])

        by_row = settle(votes.mapInArrow(one_by_one, "_tm_row long, _tm_votes array<double>"), "votes")
        return self._voted(rows.join(by_row, "_tm_row"))

    def _voted(self, df: DataFrame) -> DataFrame:
        whole = F.aggregate("_tm_votes", F.lit(0.0), lambda total, x: total + x)
        made = {
            "rawPrediction": array_to_vector("_tm_votes"),
            "probability": array_to_vector(F.transform("_tm_votes", lambda x: F.when(F.col("_tm_whole") > 0, x / F.col("_tm_whole")).otherwise(x))),
            "prediction": (F.array_position("_tm_votes", F.array_max("_tm_votes")) - 1).cast("double"),
        }
        return df.withColumn("_tm_whole", whole).withColumns(made).drop("_tm_row", "_tm_votes", "_tm_whole")

    def write(self):
        return ForestWriter(self)

    @classmethod
    def read(cls):
        return ForestReader(cls)


class ForestWriter(DefaultParamsWriter):
    """Saves the trees beside the parameters."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.sparkSession.read.schema(TREES).parquet(self.instance.about["path"]).write.parquet(f"{path}/trees")


class ForestReader(DefaultParamsReader):
    def load(self, path: str) -> BlockForestModel:
        model = super().load(path)
        return model._set(forest=json.dumps(model.about | {"path": f"{path}/trees"}))


def binned(x: np.ndarray, limits: Sequence[np.ndarray]) -> np.ndarray:
    """Bins by row and column."""
    return np.stack([np.searchsorted(limit, x[:, i]).astype(np.uint8) for i, limit in enumerate(limits)], axis=1)


def pack(batches: Iterable[pa.RecordBatch], limits: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    for i, (x, y, w) in enumerate(stacked(batches, ["x", "y", "w"])):
        made = {"block": [(part << 32) + i], "n": [len(y)], "classes": pa.array([int(y.max()) + 1], pa.int32())}
        yield pa.RecordBatch.from_pydict(made | {"bins": [binned(x, limits).tobytes()], "y": [y.astype(np.uint8).tobytes()], "w": [w.tobytes()]})


def opened(row, columns: int) -> Block:
    return row["block"], np.frombuffer(row["bins"], np.uint8).reshape(-1, columns), np.frombuffer(row["y"], np.uint8), np.frombuffer(row["w"])


def places(bins: np.ndarray, splits: dict) -> np.ndarray:
    """The node of a tree's top in which each row has come to lie. Node i has the children 2i and 2i + 1."""
    at = np.ones(len(bins), np.int64)
    for node, (column, cut) in sorted(splits.items()):
        at = np.where(at == node, 2 * node + (bins[:, column] > cut), at)
    return at


def mixed(x: np.ndarray) -> np.ndarray:
    """Hashed 64-bit numbers, those of SplitMix64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def impurity(totals: Sequence[np.ndarray], whole: np.ndarray) -> np.ndarray:
    """Gini impurity from the weights of each class and of all, worked out in Spark's order."""
    found = np.ones(whole.shape)
    with np.errstate(divide="ignore", invalid="ignore"):
        for of_class in totals:
            share = of_class / whole
            found -= share * share
    return np.where(whole > 0, found, 0.0)


class Grower:
    """How trees are grown; all draws follow from the seed, the tree, and the block or node."""

    def __init__(self, seed: int, columns: int, classes: int, depth: int, tried: int):
        self.seed, self.columns, self.classes, self.depth, self.tried = seed, columns, classes, depth, tried

    def drawn(self, tree: int, block: int, n: int) -> np.ndarray:
        """How often the tree has each row of the block."""
        return np.random.default_rng([self.seed, tree, block]).poisson(1.0, n).astype(np.uint8)

    def sampled(self, tree: int, nodes: np.ndarray) -> np.ndarray:
        """The columns tried at each node."""
        of_node = mixed(nodes.astype(np.uint64) + mixed(np.array([self.seed * 1_000_003 + tree], np.uint64)))
        chosen = np.argsort(mixed(of_node[:, None] ^ np.arange(self.columns, dtype=np.uint64)), axis=1)[:, : self.tried]
        # of equal gains the first column's counts
        return np.sort(chosen, axis=1).astype(np.uint16)

    def added_up(self, flat: np.ndarray, rows: np.ndarray, slots: np.ndarray, y: np.ndarray, w: np.ndarray, sampled: np.ndarray) -> np.ndarray:
        """Weights by tried column, class, node and bin of rows whose nodes are ``slots``; ``flat`` holds the bins row by row."""
        nodes = len(sampled)
        size = self.classes * nodes * BINS
        sums = np.zeros((self.tried, size))
        for begin in range(0, len(rows), STEP):
            part = slice(begin, begin + STEP)
            at, slot = rows[part] * self.columns, slots[part]
            tried, cell = sampled[slot], (y[part] * nodes + slot) * BINS
            for j in range(self.tried):
                sums[j] += np.bincount(cell + flat[at + tried[:, j]], w[part], size)
        return sums.reshape(self.tried, self.classes, nodes, BINS)

    def best(self, sums: np.ndarray, sampled: np.ndarray) -> tuple[np.ndarray, ...]:
        """(gain, column, cut, classes' weights of the left part, of all) of each node's first split of the largest gain."""
        until = np.cumsum(sums, axis=3)
        left, whole = [np.moveaxis(part, 1, 0) for part in (until[..., :-1], until[..., -1:])]
        right = whole - left
        n_left, n_right, n = (sum(part) for part in (left, right, whole))
        with np.errstate(divide="ignore", invalid="ignore"):
            both = n_left + n_right
            gain = impurity(whole, n) - n_left / both * impurity(left, n_left) - n_right / both * impurity(right, n_right)
        gain = np.where((n_left > 0) & (n_right > 0) & (gain > 0), gain, 0.0)
        nodes = np.arange(sums.shape[2])
        cuts = np.argmax(gain, axis=2)
        gains = np.take_along_axis(gain, cuts[:, :, None], axis=2)[:, :, 0]
        j = np.argmax(gains, axis=0)
        cut = cuts[j, nodes]
        return gains[j, nodes], sampled[nodes, j], cut, left[:, j, nodes, cut].T, whole[:, j, nodes, 0].T

    def grow(self, bins: np.ndarray, rows: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, node: int) -> tuple[bytes, bytes, bytes, bytes, list[float], list[float]]:
        """The part of a tree below a node, grown from its rows and pruned.

        By node its column (``LEAF`` in a leaf), its cut, and the place of its left child, which the right one follows, or of a
        leaf's class shares; the shares; the splits' gains by column; the classes' weights of all.
        """
        flat, level, made = bins.reshape(-1), node.bit_length() - 1, 1
        levels: list[tuple[np.ndarray, ...]] = []
        totals, ids = np.bincount(y, w, self.classes)[None].astype(float), np.array([node], np.int64)
        tried, sizes = np.ones(1, bool), np.array([len(rows)])
        y = y.astype(np.int64)
        while True:
            m = len(totals)
            column, cut, child = np.full(m, LEAF, np.uint16), np.zeros(m, np.uint8), np.zeros(m, np.int32)
            left, gains = np.zeros((m, self.classes)), np.zeros(m)
            places_tried = np.flatnonzero(tried)
            slots = np.repeat(np.arange(len(places_tried)), sizes)
            ends = np.cumsum(sizes)
            for a, b in _runs(ends):
                s, e = (ends[a - 1] if a else 0), ends[b - 1]
                sampled = self.sampled(tree, ids[places_tried[a:b]])
                gain, of, at, lefts, whole = self.best(self.added_up(flat, rows[s:e], slots[s:e] - a, y[s:e], w[s:e], sampled), sampled)
                split = gain > 0
                where = places_tried[a:b][split]
                column[where], cut[where], left[where] = of[split], at[split], lefts[split]
                gains[where] = (gain * whole.sum(axis=-1))[split]
            split = column != LEAF
            n_split = int(split.sum())
            child[split] = made + 2 * np.arange(n_split)
            made += 2 * n_split
            levels.append((column, cut, child, totals, gains))
            if not n_split:
                break
            # a tried node's place among the split ones
            number = (np.cumsum(split) - 1)[places_tried]
            stay = split[places_tried][slots]
            rows, y, w, slots = rows[stay], y[stay], w[stay], number[slots[stay]]
            right = flat[rows * self.columns + column[split][slots]] > cut[split][slots]
            totals = np.stack([left[split], totals[split] - left[split]], axis=1).reshape(-1, self.classes)
            ids = np.stack([2 * ids[split], 2 * ids[split] + 1], axis=1).reshape(-1)
            level += 1
            tried = (impurity(totals.T, totals.sum(axis=1)) >= EPSILON) if level < self.depth else np.zeros(2 * n_split, bool)
            order, sizes = _parted(slots, right, n_split)
            stay = np.repeat(tried, sizes)
            order, sizes = order[stay], sizes[tried]
            rows, y, w = rows[order], y[order], w[order]
        return self.pruned(levels)

    def pruned(self, levels: Sequence[tuple[np.ndarray, ...]]) -> tuple[bytes, bytes, bytes, bytes, list[float], list[float]]:
        """Two leaves of one parent that call the same class become one, from the bottom up, as in Spark's trees."""
        ends = np.cumsum([len(level[0]) for level in levels])
        column, cut, child, totals, gains = (np.concatenate(parts) for parts in zip(*levels, strict=True))
        called, kept = totals.argmax(axis=1), np.ones(len(column), bool)
        for begin, end in reversed([*zip([0, *ends[:-1]], ends, strict=True)]):
            nodes = begin + np.flatnonzero(column[begin:end] != LEAF)
            left = child[nodes]
            same = (column[left] == LEAF) & (column[left + 1] == LEAF) & (called[left] == called[left + 1])
            column[nodes[same]] = LEAF
            kept[left[same]] = kept[left[same] + 1] = False
        place = (np.cumsum(kept) - 1).astype(np.int32)
        column, cut, child, gains, whole = column[kept], cut[kept], child[kept], gains[kept], totals[0].tolist()
        split = column != LEAF
        child[split] = place[child[split]]
        child[~split] = np.arange(len(column) - split.sum())
        parts = (column, cut, child, _shares(totals[kept][~split]))
        return *(part.tobytes() for part in parts), np.bincount(column[split], gains[split], self.columns).astype(float).tolist(), whole


def _shares(totals: np.ndarray) -> np.ndarray:
    whole = totals.sum(axis=-1, keepdims=True)
    return np.divide(totals, whole, out=np.zeros_like(totals), where=whole > 0)


def _runs(ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of nodes of about ``STEP`` rows, or one node, and at most ``NODES``."""
    a = 0
    while a < len(ends):
        begin = ends[a - 1] if a else 0
        b = min(max(int(np.searchsorted(ends, begin + STEP, "right")), a + 1), a + NODES, len(ends))
        yield a, b
        a = b


def _parted(slots: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows, which are ordered by node, that puts each node's left rows before its right ones, and the rows of each child."""
    sizes = np.bincount(2 * slots + right, minlength=2 * n)
    begins = np.cumsum(sizes) - sizes
    target = np.empty(len(slots), np.int64)
    for side in (0, 1):
        of = np.flatnonzero(right == side)
        before = np.cumsum(sizes[side::2]) - sizes[side::2]
        target[of] = np.arange(len(of)) - before[slots[of]] + begins[side::2][slots[of]]
    order = np.empty(len(slots), np.int64)
    order[target] = np.arange(len(slots))
    return order, sizes


def _joined(blocks: Iterable[Block]) -> list[np.ndarray]:
    ordered = sorted(blocks, key=lambda block: block[0])
    return [np.concatenate(part) for part in list(zip(*ordered, strict=True))[1:]]


def _whole_trees(blocks: RDD, grower: Grower, units: Sequence[tuple[int, int]], n: int) -> RDD:
    """All rows come to each task, which grows some of the trees."""
    tasks = max(1, min(blocks.context.defaultParallelism, len(units), len(units) * n // GROWN_PER_TASK))

    def grown(part):
        for task, held in part:
            ordered = sorted(held, key=lambda block: block[0])
            bins, y, w = _joined(ordered)
            for unit in range(task, len(units), tasks):
                tree, node = units[unit]
                times = np.concatenate([grower.drawn(tree, block[0], len(block[2])) for block in ordered])
                rows = np.flatnonzero(times)
                yield unit, tree, node, *grower.grow(bins, rows, y[rows], w[rows] * times[rows], tree, node)

    return blocks.flatMap(lambda block: [(task, block) for task in range(tasks)]).groupByKey(tasks, int).mapPartitions(grown)


#: (tree, node) -> (column, cut, gain times weight) of the split nodes that the driver holds, and -> classes' weights of leaves.
Tops = dict[tuple[int, int], tuple[int, int, float]]
Leaves = dict[tuple[int, int], np.ndarray]


def _by_tree(tops: Iterable[tuple[int, int, int, int]]) -> dict[int, dict]:
    found: dict[int, dict] = {}
    for tree, node, column, cut in tops:
        found.setdefault(tree, {})[node] = (column, cut)
    return found


def _grow_tops(blocks: RDD, grower: Grower, trees: int, most: int) -> tuple[Tops, Leaves, list[tuple[int, int]]]:
    """The splits of all nodes of more than ``most`` rows, grown level by level, the leaves among their children, and the nodes left to grow."""
    tops: Tops = {}
    leaves: Leaves = {}
    units: list[tuple[int, int]] = []
    open_nodes = {tree: [1] for tree in range(trees)}
    level = 0
    while open_nodes:

        def add_up(part, splits=_by_tree((*key, *top[:2]) for key, top in tops.items()), open_nodes=open_nodes):  # noqa: B008
            total = None
            for number, bins, y, w in part:
                sums = []
                for tree, nodes in open_nodes.items():
                    times, at = grower.drawn(tree, number, len(y)), places(bins, splits.get(tree, {}))
                    slots = np.minimum(np.searchsorted(nodes, at), len(nodes) - 1)
                    rows = np.flatnonzero((times > 0) & (np.array(nodes)[slots] == at))
                    sampled = grower.sampled(tree, np.array(nodes))
                    weighted, counted = (grower.added_up(bins.reshape(-1), rows, slots[rows], y[rows].astype(np.int64), by, sampled) for by in (w[rows] * times[rows], np.ones(len(rows))))
                    # by class, and the rows of all classes
                    sums.append(np.concatenate([weighted, counted.sum(axis=1, keepdims=True)], axis=1))
                sums = np.concatenate(sums, axis=2)
                total = sums if total is None else total + sums
            return [] if total is None else [total]

        # an array for each task, of tried columns x classes x nodes x bins
        sums = blocks.mapPartitions(add_up).treeReduce(np.add)
        further: dict[int, list[int]] = {}
        begin = 0
        for tree, nodes in open_nodes.items():
            of_tree = sums[:, :, begin : begin + len(nodes)]
            begin += len(nodes)
            sampled = grower.sampled(tree, np.array(nodes))
            for slot, (node, gain, column, cut, left, whole) in enumerate(zip(nodes, *grower.best(of_tree[:, :-1], sampled), strict=True)):
                if not gain > 0:
                    leaves[tree, node] = whole
                    continue
                tops[tree, node] = (int(column), int(cut), float(gain * whole.sum()))
                rows = of_tree[int(np.flatnonzero(sampled[slot] == column)[0]), -1, slot]
                n_left = rows[: cut + 1].sum()
                for child, totals, n in ((2 * node, left, n_left), (2 * node + 1, whole - left, rows.sum() - n_left)):
                    if level + 1 == grower.depth or impurity(totals, totals.sum()) < EPSILON:
                        leaves[tree, child] = totals
                    elif n > most:
                        further.setdefault(tree, []).append(child)
                    else:
                        units.append((tree, child))
        open_nodes = {tree: sorted(nodes) for tree, nodes in further.items()}
        level += 1
    return tops, leaves, units


def _prune_tops(tops: Tops, leaves: Leaves) -> None:
    for tree, node in sorted(tops, key=lambda key: -key[1]):
        pair = (tree, 2 * node), (tree, 2 * node + 1)
        if all(child in leaves for child in pair) and leaves[pair[0]].argmax() == leaves[pair[1]].argmax():
            del tops[tree, node]
            leaves[tree, node] = leaves.pop(pair[0]) + leaves.pop(pair[1])


def _parts(blocks: RDD, grower: Grower, tops: Tops, units: Sequence[tuple[int, int]]) -> RDD:
    """The rows of each unit come to one task, which grows it."""
    splits = _by_tree((*key, *top[:2]) for key, top in tops.items())
    by_tree: dict[int, list[tuple[int, int]]] = {}
    for unit, (tree, node) in enumerate(units):
        by_tree.setdefault(tree, []).append((unit, node))

    def pieces(block):
        number, bins, y, w = block
        for tree, some in by_tree.items():
            times, at = grower.drawn(tree, number, len(y)), places(bins, splits.get(tree, {}))
            for unit, node in some:
                rows = np.flatnonzero((times > 0) & (at == node))
                if len(rows):
                    yield unit, (number, bins[rows], y[rows], w[rows] * times[rows])

    def grown(part):
        for unit, held in part:
            bins, y, w = _joined(held)
            yield unit, *units[unit], *grower.grow(bins, np.arange(len(y)), y, w, *units[unit])

    return blocks.flatMap(pieces).groupByKey(max(1, len(units)), int).mapPartitions(grown)


def _votes(blocks: RDD, trees: RDD, about: dict, n: int, parallelism: int) -> RDD:
    """(row numbers, sums of the trees' class shares) by block. Each task has some of the trees and some of the blocks."""
    classes, columns = about["classes"], len(about["limits"])
    tops = _by_tree(about["tops"])
    size = sum(unit[3] for unit in about["units"])
    groups = max(math.ceil(size / TREE_BYTES), min(parallelism, about["trees"], about["trees"] * n // SCORED_PER_TASK), 1)
    chunks = math.ceil(n / SCORED_ROWS)
    group_of: dict[int, int] = {}
    held = [0] * groups
    for unit, _, _, size in sorted(about["units"], key=lambda unit: -unit[3]):
        least = held.index(min(held))
        group_of[unit], held[least] = least, held[least] + size

    def scored(part):
        for key, held in part:
            units, some_blocks = [Leaf(*leaf[:2], np.array(leaf[2:])) for leaf in about["leaves"] if key < chunks], []
            for kind, row in held:
                if kind == "block":
                    some_blocks.append(row)
                else:
                    units.append(Tree(row, classes))
            units.sort(key=lambda unit: (unit.tree, unit.node))
            for ids, bins in some_blocks:
                x = np.frombuffer(bins, np.uint8).reshape(-1, columns)
                sums = np.zeros((len(x), classes))
                for tree, parts in groupby(units, key=lambda unit: unit.tree):
                    at = places(x, tops.get(tree, {}))
                    for unit in parts:
                        unit.vote(x, np.flatnonzero(at == unit.node), sums)
                yield int.from_bytes(ids[:8], "little"), (ids, sums)

    def of_chunk(row):
        chunk = int(mixed(np.frombuffer(row["rows"][:8], np.uint64))[0] % np.uint64(chunks))
        return [(group * chunks + chunk, ("block", (bytes(row["rows"]), bytes(row["bins"])))) for group in range(groups)]

    def of_group(row):
        # parts that were pruned to a leaf are known without
        return [(group_of[row["unit"]] * chunks + chunk, ("tree", tuple(row))) for chunk in range(chunks)] if row["unit"] in group_of else []

    sums = blocks.flatMap(of_chunk).union(trees.flatMap(of_group)).groupByKey(groups * chunks, int).mapPartitions(scored)
    if groups > 1:
        sums = sums.reduceByKey(lambda a, b: (a[0], a[1] + b[1]), min(parallelism, groups * chunks))
    return sums.map(lambda pair: (bytearray(pair[1][0]), bytearray(pair[1][1].tobytes())))


class Tree:
    """A grown part of a tree."""

    def __init__(self, row: tuple, classes: int):
        _, self.tree, self.node, columns, cuts, children, shares, *_ = row
        self.column, self.cut = np.frombuffer(columns, np.uint16), np.frombuffer(cuts, np.uint8)
        self.child, self.shares = np.frombuffer(children, np.int32), np.frombuffer(shares).reshape(-1, classes)

    def vote(self, bins: np.ndarray, rows: np.ndarray, sums: np.ndarray) -> None:
        """Adds the shares of the leaves in which the given rows come to lie."""
        flat, columns = bins.reshape(-1), bins.shape[1]
        at = np.zeros(len(rows), np.int64)
        while len(rows):
            column = self.column[at]
            ended = column == LEAF
            if ended.any():
                sums[rows[ended]] += self.shares[self.child[at[ended]]]
                rows, at, column = rows[~ended], at[~ended], column[~ended]
            at = self.child[at] + (flat[rows * columns + column] > self.cut[at])


class Leaf:
    """A leaf that is known without the trees' table."""

    def __init__(self, tree: int, node: int, shares: np.ndarray):
        self.tree, self.node, self.shares = tree, node, shares

    def vote(self, bins: np.ndarray, rows: np.ndarray, sums: np.ndarray) -> None:
        sums[rows] += self.shares
