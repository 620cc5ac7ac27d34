"""Binary boosting on rows kept as blocks of binned columns, for tables of many rows."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import RDD, SparkContext, StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# executors need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a column, and rows at most drawn to find their limits, as in Spark's trees.
BINS = 32
DRAWN = 10_000
#: Rows of a block.
BLOCK = 32_768
#: Rows up to which one task does all rounds, faster than tasks start for each level.
ALONE = 4 * BLOCK
#: Rounds after which the margins are worked out from the first blocks again, so that their lineage stays short.
ANEW = 10
EPSILON = np.finfo(float).eps

#: A grown tree: node -> (column, bin) that splits it, leaf -> value, node -> (rows, weight, sum, sum of squares, gain). Node i has the children 2i and 2i + 1.
Tree = tuple[dict, dict, dict]
#: Bins by column, labels as -1 and 1, weights and margins of some rows.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


class BlockBoosting(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the model of Spark's GBTClassifier on all rows and columns: its bins, loss, gains and stops, and so its trees but for rounding.

    Each task adds up its blocks' statistics by node, column and bin with numpy; only those sums, whose size does not depend
    on the rows, are added up over the tasks and come to the driver, once for every level. Up to ``ALONE`` rows one task
    does the same with all blocks. Fitting returns Spark's own model.
    """

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weights, if any", TypeConverters.toString)
    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of each step taken", TypeConverters.toFloat)
    minGain = Param(Params._dummy(), "minGain", "least gain of a split", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "of the rows drawn for the bins", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str = "", rounds: int = 100, depth: int = 3, rate: float = 0.1,
        minGain: float = 0.0, seed: int = 42,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", weightCol="", rounds=100, depth=3, rate=0.1, minGain=0.0, seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> GBTClassificationModel:
        get = {param.name: self.getOrDefault(param) for param in self.params}
        weight = F.col(get["weightCol"]).cast("double") if get["weightCol"] else F.lit(1.0)
        rows = df.select(vector_to_array(get["featuresCol"]).alias("x"), F.col(get["labelCol"]).cast("double").alias("y"), weight.alias("w"))
        limits = bin_limits(rows, binary_columns(df, get["featuresCol"]), get["seed"])

        def packed(batches):
            return pack(batches, limits)

        first = rows.mapInArrow(packed, "bins binary, y binary, w binary").rdd.map(lambda row: opened(row, len(limits))).persist(StorageLevel.MEMORY_AND_DISK)
        if first.map(lambda block: len(block[1])).sum() <= ALONE:
            trees = first.coalesce(1).mapPartitions(lambda part: boosted_alone(list(part), limits, get)).collect()
            first.unpersist()
        else:
            trees = _boosted_apart(first, limits, get)
        return spark_model(trees, limits, get["rate"]).setFeaturesCol(get["featuresCol"])


def _boosted_apart(first: RDD, limits: Sequence[np.ndarray], get: dict) -> list[Tree]:
    trees: list[Tree] = []
    held = first
    for turn in range(get["rounds"]):
        if turn:
            source, steps = (first, trees) if turn % ANEW == 0 else (held, trees[-1:])
            last, held = held, _moved(source, steps, turn - len(steps), get["rate"]).persist(StorageLevel.MEMORY_AND_DISK)

        def add_up(splits: dict, nodes: Sequence[int], held=held, first=turn == 0):
            def of_task(part):
                total = statistics(part, splits, nodes, first)
                return [] if total is None else [total]

            # one array for each task, of nodes x columns x bins
            return held.mapPartitions(of_task).reduce(np.add)

        trees.append(grown(add_up, limits, get["depth"], get["minGain"]))
        if turn and last is not first:
            last.unpersist()
    for each in (held, first):
        each.unpersist()
    return trees


def boosted_alone(blocks: Sequence[Block], limits: Sequence[np.ndarray], get: dict) -> list[Tree]:
    trees: list[Tree] = []
    for turn in range(get["rounds"]):
        if turn:
            blocks = [moved(block, [_step(trees[-1], turn - 1, get["rate"])]) for block in blocks]
        trees.append(grown(partial(statistics, blocks, first=turn == 0), limits, get["depth"], get["minGain"]))
    return trees


def binary_columns(df: DataFrame, features: str) -> set[int]:
    attributes = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    if any(a.get("vals") is None or len(a["vals"]) > 2 for a in attributes.get("nominal", [])):
        raise ValueError("codes of more than two levels are not split by their order; encode them as columns")
    return {a["idx"] for kind in ("binary", "nominal") for a in attributes.get(kind, [])}


def bin_limits(rows: DataFrame, binary: set[int], seed: int, classes: int = 2) -> list[np.ndarray]:
    """The places at which each column may be split, from about ``DRAWN`` rows as in Spark's trees: the bins hold about equal weights."""
    x, y, w = F.col("x"), F.col("y"), F.col("w")
    wrong_x = x.isNull() | F.exists("x", lambda v: F.isnan(v) | (F.abs(v) == float("inf")))
    wrong = wrong_x | y.isNull() | ~(y.between(0, classes - 1) & (y == F.floor(y))) | w.isNull() | F.isnan(w) | (w < 0) | (w == float("inf"))
    state = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("wrong")).first()
    if not state["n"] or state["wrong"]:
        raise ValueError(f"trees need rows whose labels are numbers from 0 to {classes - 1}, whose weights are not negative, and without null, NaN or infinity")
    drawn = (rows.sample(False, DRAWN / state["n"], seed) if state["n"] > DRAWN else rows).select("x", "w").collect()
    values, weights = np.array([row["x"] for row in drawn]), np.array([row["w"] for row in drawn])
    most = min(BINS, state["n"]) - 1
    return [np.array([0.5]) if i in binary else _limits(values[:, i], weights, most) for i in range(values.shape[1])]


def _limits(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    found, where = np.unique(values, return_inverse=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    until = np.cumsum(np.bincount(where, weights))
    step = until[-1] / (most + 1)
    chosen, aim = [], step
    for i in range(len(between)):
        # the value whose weights up to it come closest to the aim ends a bin
        if abs(until[i] - aim) < abs(until[i + 1] - aim):
            chosen.append(between[i])
            aim += step
    return np.array(chosen)


def stacked(batches: Iterable[pa.RecordBatch], names: Sequence[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """The named columns of ``BLOCK`` rows or a few more; x is an array for each row."""
    waiting, n = [], 0
    for batch in batches:
        if batch.num_rows:
            columns = {name: (batch.column(name).flatten() if name == "x" else batch.column(name)).to_numpy(zero_copy_only=False) for name in names}
            waiting.append([values.reshape(batch.num_rows, -1) if name == "x" else values for name, values in columns.items()])
            n += batch.num_rows
        if n >= BLOCK:
            yield tuple(np.concatenate(part) for part in zip(*waiting, strict=True))
            waiting, n = [], 0
    if waiting:
        yield tuple(np.concatenate(part) for part in zip(*waiting, strict=True))


def pack(batches: Iterable[pa.RecordBatch], limits: Sequence[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for x, y, w in stacked(batches, ["x", "y", "w"]):
        bins = np.stack([np.searchsorted(limit, x[:, i]).astype(np.uint8) for i, limit in enumerate(limits)])
        yield pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "y": [(2 * y - 1).astype(np.int8).tobytes()], "w": [w.tobytes()]})


def opened(row, columns: int) -> Block:
    y, w = np.frombuffer(row["y"], np.int8), np.frombuffer(row["w"])
    return np.frombuffer(row["bins"], np.uint8).reshape(columns, len(y)), y, w, np.zeros(len(y))


def places(bins: np.ndarray, splits: dict) -> np.ndarray:
    """The node of the tree in which each row has come to lie."""
    at = np.ones(bins.shape[1], np.int32)
    for node, (column, cut) in sorted(splits.items()):
        at = np.where(at == node, 2 * node + (bins[column] > cut), at)
    return at


def _step(tree: Tree, turn: int, rate: float) -> tuple[dict, dict, float]:
    splits, leaves, _ = tree
    # the first tree counts in full
    return splits, leaves, 1.0 if turn == 0 else rate


def moved(block: Block, steps: Sequence[tuple[dict, dict, float]]) -> Block:
    bins, y, w, margin = block
    for splits, leaves, share in steps:
        values = np.zeros(max(leaves) + 1)
        values[list(leaves)] = list(leaves.values())
        margin = margin + share * values[places(bins, splits)]
    return bins, y, w, margin


def _moved(blocks: RDD, trees: Sequence[Tree], before: int, rate: float) -> RDD:
    steps = [_step(tree, before + i, rate) for i, tree in enumerate(trees)]
    return blocks.map(lambda block: moved(block, steps))


def statistics(blocks: Iterable[Block], splits: dict, nodes: Sequence[int], first: bool) -> np.ndarray | None:
    """Rows, weights, weighted targets and their squares by node, column and bin."""
    total = None
    slots = np.full(2 * max(nodes) + 2, len(nodes))
    slots[list(nodes)] = range(len(nodes))
    for bins, y, w, margin in blocks:
        # the target of the first tree is the label, then the loss's negative gradient; beyond the doubles exp gives infinity, and so 0
        with np.errstate(over="ignore"):
            target = y.astype(float) if first else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
        by, squared = w * target, w * target * target
        start = slots[places(bins, splits)] * BINS
        size = (len(nodes) + 1) * BINS
        sums = np.empty((4, len(nodes), len(bins), BINS))
        for i, column in enumerate(bins):
            cell = start + column
            for k, values in enumerate((None, w, by, squared)):
                sums[k, :, i] = np.bincount(cell, values, size)[:-BINS].reshape(len(nodes), BINS)
        total = sums if total is None else total + sums
    return total


def _impurity(stats: np.ndarray) -> np.ndarray:
    _, w, s, ss = stats
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(w == 0, 0.0, (ss - s * s / w) / w)


def best_split(sums: np.ndarray, parent: np.ndarray | None, limits: Sequence[np.ndarray], min_gain: float):
    """(gain, column, bin, statistics of the left part, of the right part) of the first split of the largest gain; the statistics of all rows."""
    until = np.cumsum(sums, axis=2)
    left, right = until[:, :, :-1], until[:, :, -1:] - until[:, :, :-1]
    whole = until[:, 0, -1] if parent is None else parent
    with np.errstate(divide="ignore", invalid="ignore"):
        share = left[1] / (left[1] + right[1])
        gain = _impurity(whole) - share * _impurity(left) - (1 - share) * _impurity(right)
    listed = np.arange(BINS - 1) < np.array([len(limit) for limit in limits])[:, None]
    gain = np.where(listed & (left[0] >= 1) & (right[0] >= 1) & (gain >= min_gain), gain, -np.inf)
    column, cut = np.unravel_index(np.argmax(gain), gain.shape)
    return (gain[column, cut], int(column), int(cut), left[:, column, cut], right[:, column, cut]), whole


def grown(add_up: Callable[[dict, Sequence[int]], np.ndarray], limits: Sequence[np.ndarray], depth: int, min_gain: float) -> Tree:
    """A tree from what ``add_up`` finds of the open nodes after the splits so far."""
    splits: dict = {}
    leaves: dict = {}
    about: dict = {}
    open_nodes: dict = {1: None}
    for level in range(depth):
        nodes = sorted(open_nodes)
        sums = add_up(dict(splits), nodes)
        further: dict = {}
        for slot, node in enumerate(nodes):
            (gain, column, cut, *parts), whole = best_split(sums[:, slot], open_nodes[node], limits, min_gain)
            about[node] = (*map(float, whole), max(float(gain), 0.0))
            if not gain > 0:
                leaves[node] = _mean(whole)
                continue
            splits[node] = (column, cut)
            for child, part in zip((2 * node, 2 * node + 1), parts, strict=True):
                if level + 1 == depth or abs(float(_impurity(part))) < EPSILON:
                    leaves[child] = _mean(part)
                    about[child] = (*map(float, part), 0.0)
                else:
                    further[child] = part
        open_nodes = further
        if not open_nodes:
            break
    return splits, leaves, about


def _mean(stats: np.ndarray) -> float:
    return float(stats[2] / stats[1]) if stats[1] else 0.0


def spark_model(trees: Sequence[Tree], limits: Sequence[np.ndarray], rate: float) -> GBTClassificationModel:
    """Spark's own model of the trees."""
    context = SparkContext.getOrCreate()
    gateway, ml = context._gateway, context._jvm.org.apache.spark.ml
    # looked up once: each step of a name is a call
    kind, leaf, internal, continuous = ml.regression.DecisionTreeRegressionModel, ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    calculator = context._jvm.org.apache.spark.mllib.tree.impurity.VarianceAggregator().getCalculator
    # the sums of all nodes are sent at once
    place = {key: 4 * i for i, key in enumerate((t, node) for t, (_, _, about) in enumerate(trees) for node in about)}
    sums = _py2java(context, DenseVector([x for t, node in place for x in (*trees[t][2][node][1:4], trees[t][2][node][0])])).toArray()

    def node(t: int, i: int):
        splits, leaves, about = trees[t]
        held, impurity = calculator(sums, place[t, i]), float(_impurity(np.array(about[i][:4])))
        if i in leaves:
            return leaf(leaves[i], impurity, held)
        column, cut = splits[i]
        split = continuous(column, float(limits[column][cut]))
        return internal(_mean(np.array(about[i][:4])), impurity, about[i][4], node(t, 2 * i), node(t, 2 * i + 1), split, held)

    made, weights = gateway.new_array(kind, len(trees)), gateway.new_array(context._jvm.double, len(trees))
    for t in range(len(trees)):
        made[t], weights[t] = kind(f"dtr_{uuid.uuid4().hex[:12]}", node(t, 1), len(limits)), rate if t else 1.0
    return wrapped(GBTClassificationModel, ml.classification.GBTClassificationModel(f"gbtc_{uuid.uuid4().hex[:12]}", made, weights, len(limits), 2))


def wrapped(kind: type, java):
    """The Python model of one of Spark's ensembles. Made plainly it lists its parameters by looking at all its attributes, and so makes a model of every tree."""
    model = kind.__new__(kind)
    model.__dict__["trees"] = []
    model.__init__(java)
    del model.__dict__["trees"]
    return model
