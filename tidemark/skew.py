"""Finding keys too heavy for one task, and joining without piling them up."""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpoint_folder

T = TypeVar("T")

HOT = "_tm_hot"
TASKS = "_tm_tasks"
ROWS = "_tm_rows"
SALT = "_tm_salt"


@dataclass(frozen=True)
class SkewPolicy:
    """How many rows of one key a task takes.

    A task takes ``min_rows`` rows of a key, or 1/``max_hot`` of the table if that is more. A key with more rows
    is hot and is dealt over as many tasks as it has times that many rows, so there are never more than
    ``max_hot`` hot keys, nor twice as many tasks for them, and their list is safe to broadcast. A table without hot
    keys needs nothing of the sort, so its plans hold nothing of it.
    """

    min_rows: int = 1_000_000
    max_hot: int = 4096


DEFAULT = SkewPolicy()


def names(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


#: Of a key's rows one in this many times ``min_rows`` is counted, so that a full task's rows are known to about 1 %.
COUNTED = 16_384
KEPT = 256
_known: OrderedDict[tuple, tuple] = OrderedDict()


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a bounded list to the cluster's shared folder and read it back, so that every use sees the same rows."""
    path = f"{checkpoint_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def known_once(df: DataFrame, what: tuple, make: Callable[[], T]) -> T:
    """The result of ``make``, worked out once in a session for tables that are read and pruned alike.

    Only for what balances work and changes no result, as a table may have grown since.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    name = (df.sparkSession.sparkContext.applicationId, plan.semanticHash(), *what)
    held = _known.get(name)
    if held is None or not plan.sameResult(held[0]):
        held = _known[name] = (plan, make())
    _known.move_to_end(name)
    while len(_known) > KEPT:
        _known.popitem(last=False)
    return held[1]


def hot_keys(df: DataFrame, keys: Sequence[str], policy: SkewPolicy = DEFAULT) -> DataFrame | None:
    """At most ``max_hot`` keys, each with its rows and the tasks these need; None if there is none.

    The list is made once for a table and its keys, by one column-pruned count with map-side combining, settled, and
    shared by all operators on them. Where ``min_rows`` is large the count takes a fixed share of the rows: no result
    depends on the list, only who does the work. Without keys the whole table is one key.
    """
    slim = df.select(*keys) if keys else df.select(F.lit(1).alias(ROWS))
    return known_once(slim, ("hot", *keys, policy.min_rows, policy.max_hot), lambda: _hot_keys(slim, keys, policy))


def _hot_keys(slim: DataFrame, keys: Sequence[str], policy: SkewPolicy) -> DataFrame | None:
    every = max(1, policy.min_rows // COUNTED)
    drawn = slim.where(F.rand(11) < 1 / every) if every > 1 else slim
    counts = drawn.groupBy(*keys).agg((F.count(F.lit(1)) * every).alias(ROWS))
    # at most one key for each min_rows rows of the table is looked at here, one number each
    state = counts.agg(F.sum(ROWS).alias("total"), F.collect_list(F.when(F.col(ROWS) > policy.min_rows, F.col(ROWS))).alias("heavy")).first()
    share = max(float(policy.min_rows), (state["total"] or 0) / policy.max_hot)
    if not any(rows > share for rows in state["heavy"]):
        return None
    tasks = F.ceil(F.col(ROWS) / share).cast("bigint")
    return settle(counts.where(F.col(ROWS) > share).select(*keys, F.lit(True).alias(HOT), tasks.alias(TASKS), ROWS), "hot-keys")


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & left[key].eqNullSafe(right[f"_tm_h_{key}"])
    return match


def with_listed(df: DataFrame, listed: DataFrame, keys: Sequence[str], added: Sequence[str]) -> DataFrame:
    """Add columns of a list made from hot keys (bounded, so broadcast); null where the row's key isn't in it."""
    if not keys:
        row = listed.select(F.struct(*added)).scalar()
        return df.withColumns({name: row[name] for name in added})
    renamed = listed.select(*[F.col(k).alias(f"_tm_h_{k}") for k in keys], *added)
    return df.join(F.broadcast(renamed), _null_safe(df, renamed, keys), "left").drop(*[f"_tm_h_{k}" for k in keys])


def mark_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame | None, *, tasks: bool = False) -> DataFrame:
    """Add a boolean saying whether the row's key is in the hot list, or the tasks its key needs (1 if it isn't)."""
    if hot is None:
        return df.withColumn(*(TASKS, F.lit(1).cast("bigint")) if tasks else (HOT, F.lit(False)))
    added, otherwise = (TASKS, F.lit(1).cast("bigint")) if tasks else (HOT, F.lit(False))
    return with_listed(df, hot, keys, [added]).withColumn(added, F.coalesce(added, otherwise))


def spread_join(
    big: DataFrame,
    small: DataFrame,
    keys: str | Sequence[str],
    spread_by: str | Sequence[str],
    policy: SkewPolicy = DEFAULT,
    *,
    how: str = "inner",
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Inner or left equi-join in which a hot key of ``big`` is dealt over the tasks that its rows need.

    Only the rows of ``small`` that match a hot key are copied, once per task. ``spread_by`` tells the rows
    of a key apart. ``hot_from`` is a table to count the keys in when ``big`` itself is costly. Spark's own
    skew handling does not split a join whose other side is an aggregate, which is the usual case here.
    """
    keys = names(keys)
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can be spread")
    hot = hot_keys(big if hot_from is None else hot_from, keys, policy)
    if hot is None:
        return big.join(small, keys, how)
    dealt = F.pmod(F.xxhash64(*names(spread_by)), F.col(TASKS))
    left = mark_hot(big, keys, hot, tasks=True).withColumn(SALT, dealt).drop(TASKS)
    copies = F.sequence(F.lit(0).cast("bigint"), F.col(TASKS) - 1)
    right = mark_hot(small, keys, hot, tasks=True).withColumn(SALT, F.explode(copies)).drop(TASKS)
    return left.join(right, [*keys, SALT], how).drop(SALT)
