"""Operator 9: near-duplicate embeddings through navigable small-world graphs per shard, with audited recall."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, settle
from tidemark.llm.ngram_join import roots


@dataclass(frozen=True)
class Graph:
    """A hierarchy of neighbour tables over unit vectors: layer 0 has every vector, each higher one a part of them.

    ``links[k][i]`` holds the neighbours of vector i in layer k, -1 where there are fewer.
    """

    links: list[np.ndarray]
    entry: int

    def pack(self) -> bytes:
        head = np.array([len(self.links), self.entry, *(table.shape[1] for table in self.links), len(self.links[0])], dtype="<i4")
        return head.tobytes() + b"".join(np.ascontiguousarray(table, dtype="<i4").tobytes() for table in self.links)

    @staticmethod
    def unpack(data: bytes) -> Graph:
        values = np.frombuffer(data, dtype="<i4")
        layers, n = int(values[0]), int(values[2 + values[0]])
        tables, at = [], 3 + layers
        for width in values[2 : 2 + layers].tolist():
            tables.append(values[at : at + n * width].reshape(n, width))
            at += n * width
        return Graph(tables, int(values[1]))


def beam_search(vectors: np.ndarray, table: np.ndarray, queries: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For all queries at once, the ``width`` nearest vectors met while expanding the best ones left: numbers (-1: none) and cosines.

    A query ends when none of its beam is left to expand.
    """
    n_queries = len(queries)
    beam = np.full((n_queries, width), -1, dtype=np.int64)
    near = np.full((n_queries, width), -np.inf, dtype=np.float32)
    open_ = np.zeros((n_queries, width), dtype=bool)
    seen = np.zeros((n_queries, len(vectors)), dtype=bool)
    k = min(width, starts.shape[1])
    first = np.where(starts >= 0, np.einsum("qkd,qd->qk", vectors[starts], queries), -np.inf)
    best = np.argsort(-first, axis=1, kind="stable")[:, :k]
    beam[:, :k], near[:, :k] = np.take_along_axis(starts, best, 1), np.take_along_axis(first, best, 1)
    open_[:, :k] = near[:, :k] > -np.inf
    rows = np.arange(n_queries)
    seen[rows[:, None], np.where(starts >= 0, starts, starts[:, :1])] = True
    active = rows
    while len(active):
        ready = np.where(open_[active], near[active], -np.inf)
        # expanding several of the best at a time keeps the steps few
        chosen = np.argpartition(-ready, min(4, width - 1), axis=1)[:, :4]
        usable = np.take_along_axis(ready, chosen, 1) > -np.inf
        going = usable.any(axis=1)
        active, chosen, usable = active[going], chosen[going], usable[going]
        if not len(active):
            break
        open_[active[:, None], chosen] = False
        found = table[np.where(usable, beam[active[:, None], chosen], 0)].astype(np.int64)
        found[~usable] = -1
        found = found.reshape(len(active), -1)
        found.sort(axis=1)
        fresh = found >= 0
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        fresh &= ~seen[active[:, None], np.maximum(found, 0)]
        at, column = np.nonzero(fresh)
        numbers = found[at, column]
        seen[active[at], numbers] = True
        cosines = np.full(found.shape, -np.inf, dtype=np.float32)
        cosines[at, column] = np.einsum("kd,kd->k", vectors[numbers], queries[active[at]])
        all_near = np.concatenate([near[active], cosines], axis=1)
        best = np.argpartition(-all_near, width - 1, axis=1)[:, :width]
        near[active] = np.take_along_axis(all_near, best, 1)
        beam[active] = np.take_along_axis(np.concatenate([beam[active], found], axis=1), best, 1)
        open_[active] = np.take_along_axis(np.concatenate([open_[active], cosines > -np.inf], axis=1), best, 1)
    beam[near == -np.inf] = -1
    return beam, near


def descend(vectors: np.ndarray, graph: Graph, queries: np.ndarray, layer: int = 0) -> np.ndarray:
    """Starting points in a layer, found by narrow beams from the entry through the layers above."""
    starts = np.full((len(queries), 1), graph.entry, dtype=np.int64)
    for table in graph.links[:layer:-1]:
        starts, _ = beam_search(vectors, table, queries, starts, 4)
    return starts


def nearest(vectors: np.ndarray, graph: Graph, queries: np.ndarray, width: int, chunk: int = 512) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for i in range(0, len(queries), chunk):
        part = queries[i : i + chunk]
        parts.append(beam_search(vectors, graph.links[0], part, descend(vectors, graph, part), width))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def spread_out(vectors: np.ndarray, own: np.ndarray, numbers: np.ndarray, cosines: np.ndarray, keep: int) -> np.ndarray:
    """The neighbours to link to: nearest first, a candidate nearer to a chosen one than to the point waits until the others are in."""
    order = np.argsort(-cosines, axis=1, kind="stable")[:, : 2 * keep]
    numbers, cosines = np.take_along_axis(numbers, order, 1), np.take_along_axis(cosines, order, 1)
    real = (cosines > -np.inf) & (numbers >= 0) & (numbers != own[:, None])
    points = vectors[np.maximum(numbers, 0)]
    between = np.einsum("qkd,qjd->qkj", points, points)
    chosen = np.zeros_like(real)
    for k in range(numbers.shape[1]):
        hidden = (chosen & (between[:, k] > cosines[:, k, None])).any(axis=1)
        chosen[:, k] = real[:, k] & ~hidden
    rank = np.where(chosen, 0, np.where(real, 1, 2)) * numbers.shape[1] + np.arange(numbers.shape[1])
    order = np.argsort(rank, axis=1)[:, :keep]
    out = np.where(np.take_along_axis(real, order, 1), np.take_along_axis(numbers, order, 1), -1)
    return np.pad(out, ((0, 0), (0, keep - out.shape[1])), constant_values=-1)


def build(vectors: np.ndarray, degree: int = 16, width: int = 48, seed: int = 3) -> Graph:
    """Insert the vectors in rounds that double the graph (at most 512 a round); a round's points also see one another."""
    n = len(vectors)
    draw = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - draw.random(n)) / np.log(degree)).astype(int), 6)
    order = np.arange(n)
    top = int(level.max()) if n else 0
    entry = int(np.flatnonzero(level == top)[0]) if n else 0
    order = np.concatenate([[entry], order[order != entry]])
    tables = [np.full((n, degree * (2 if k == 0 else 1)), -1, dtype=np.int32) for k in range(top + 1)]
    done = 1
    while done < n:
        batch = order[done : done + min(512, max(16, done))]
        graph = Graph(tables, entry)
        for k in range(top + 1):
            points = batch[level[batch] >= k]
            if not len(points):
                continue
            queries = vectors[points]
            known, cosines = beam_search(vectors, tables[k], queries, descend(vectors, graph, queries, k), width)
            among = queries @ queries.T
            np.fill_diagonal(among, -np.inf)
            numbers = np.concatenate([known, np.broadcast_to(points, (len(points), len(points)))], axis=1)
            cosines = np.concatenate([cosines, among], axis=1)
            keep = tables[k].shape[1]
            tables[k][points] = spread_out(vectors, points, numbers, cosines, keep)
            # links back, each neighbour keeping the best spread of old and new
            source, column = np.nonzero(tables[k][points] >= 0)
            target = tables[k][points][source, column]
            sort = np.argsort(target, kind="stable")
            target, source = target[sort], points[source[sort]]
            hubs, begins, counts = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(begins, counts)
            extra = np.full((len(hubs), min(int(counts.max()), 4 * keep)), -1, dtype=np.int64)
            fits = place < extra.shape[1]
            extra[np.repeat(np.arange(len(hubs)), counts)[fits], place[fits]] = source[fits]
            extra[(extra[:, :, None] == tables[k][hubs][:, None, :]).any(axis=2)] = -1
            joined = np.concatenate([tables[k][hubs], extra], axis=1)
            nearness = np.where(joined >= 0, np.einsum("qkd,qd->qk", vectors[np.maximum(joined, 0)], vectors[hubs]), -np.inf)
            tables[k][hubs] = spread_out(vectors, hubs, joined, nearness, keep)
        done += len(batch)
    return Graph(tables, entry)


def links_of(vectors: np.ndarray, graph: Graph, queries: np.ndarray, threshold: float, *, width: int, audit: int, recall: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, vector) whose cosine is about the threshold or more, searched until a recall audit passes.

    A query whose whole beam is that near may have more such neighbours: its beam grows fourfold until it isn't full of
    them. Then ``audit`` evenly spread queries are compared with every vector; while they found less than
    ``recall`` of their links and nearest neighbours, all beams double. A beam of an eighth of the shard or more
    is widened to the whole shard, that is every vector is compared.
    """
    n, floor = len(vectors), threshold - 1e-4
    # a small shard begins with a beam that is small beside it, so its graph is searched too
    width = max(4, min(width, n // 16))
    sample = np.unique(np.linspace(0, len(queries) - 1, min(audit, len(queries))).astype(int))
    truth = queries[sample] @ vectors.T
    peak = truth.max(axis=1)
    while True:
        if 8 * width >= n:
            return all_pairs(vectors, queries, np.arange(len(queries)), floor)
        numbers, cosines = nearest(vectors, graph, queries, width)
        met = cosines[sample].max(axis=1) >= peak - 1e-5
        wanted = (truth >= floor).sum(axis=1)
        got = np.where(cosines[sample].min(axis=1) >= floor, wanted, (cosines[sample] >= floor).sum(axis=1))
        if met.mean() >= recall and got.sum() >= recall * wanted.sum():
            break
        width *= 2
    full = np.flatnonzero(cosines.min(axis=1) >= floor)
    at, column = np.nonzero(cosines >= floor)
    keep = ~np.isin(at, full)
    pairs = [(at[keep], numbers[at[keep], column[keep]])]
    while len(full):
        width *= 4
        if 8 * width >= n:
            pairs.append(all_pairs(vectors, queries, full, floor))
            break
        numbers, cosines = nearest(vectors, graph, queries[full], width)
        still = cosines.min(axis=1) >= floor
        at, column = np.nonzero((cosines >= floor) & ~still[:, None])
        pairs.append((full[at], numbers[at, column]))
        full = full[still]
    return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def all_pairs(vectors: np.ndarray, queries: np.ndarray, chosen: np.ndarray, floor: float, chunk: int = 512) -> tuple[np.ndarray, np.ndarray]:
    parts = []
    for i in range(0, len(chosen), chunk):
        at, number = np.nonzero(queries[chosen[i : i + chunk]] @ vectors.T >= floor)
        parts.append((chosen[i : i + chunk][at], number))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


class Shard:
    """A shard's representatives: numbers, members, vectors in double precision and the graph over them."""

    def __init__(self, row):
        self.reps, self.members = np.frombuffer(row.reps, "<i8"), np.frombuffer(row.members, "<i8")
        self.vectors = np.frombuffer(row.vectors, "<f8").reshape(len(self.reps), -1)
        self.units, self.graph, self.norms = unit(self.vectors), Graph.unpack(row.graph), np.linalg.norm(self.vectors, axis=1)


def join_embeddings(
    embeddings: DataFrame, *, threshold: float = 0.98, shard_rows: int = 4096, query_rows: int = 1024, width: int = 64, audit: int = 128, recall: float = 0.995,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept.

    Vectors link when their labels are equal and not null and their cosine in double precision is at least
    ``threshold``. Vectors that are null, empty, zero or hold null or non-finite components, and vectors of
    different lengths, don't link. Equal vectors of a label are one representative, so copies are never paired.
    Representatives of a label are dealt over shards of about ``shard_rows``, each with a graph, and query every
    shard of the label, ``query_rows`` at a time: a task takes two shards, whose vectors query each other's graph. Found
    pairs are verified in double precision and count for both ends, whichever found the other; tasks return counts
    and one edge per vector. A null vec_id is never the smallest; repeated rows are vectors of their
    own; other columns are ignored; no rows give no rows.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    # the square of a component may overflow or vanish, not the ratio to the largest one
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long"), "label", F.when(F.coalesce(sound, F.lit(False)), doubles).alias("embedding"))
    rows = rows.withColumn("copy_key", F.when(F.col("embedding").isNotNull(), F.sha2(F.to_json(F.struct("embedding", "label")), 256)))
    copies = rows.where("embedding is not null").groupBy("copy_key").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.count(F.lit(1)).alias("members"), F.min("vec_id").alias("least")
    )
    copies = settle(copies.withColumn("dim", F.size("embedding")).withColumn("rep", F.monotonically_increasing_id()), "vectors")
    counts = settle(copies.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).alias("shards")), "shards")
    placed = copies.join(counts, ["label", "dim"])
    placed = placed.select("label", "dim", "rep", "members", "embedding", F.pmod(F.xxhash64("rep"), "shards").alias("shard"))

    def matrix(part: pd.DataFrame) -> np.ndarray:
        return np.stack(part["embedding"].to_list()).astype(np.float64)

    def build_shard(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rep")
        values = matrix(part)
        values /= np.abs(values).max(axis=1, keepdims=True)
        graph = build(unit(values)).pack()
        row = [*key[:2], key[2], part["rep"].to_numpy("<i8").tobytes(), part["members"].to_numpy("<i8").tobytes(), values.astype("<f8").tobytes(), graph]
        return pd.DataFrame([row], columns=["label", "dim", "shard", "reps", "members", "vectors", "graph"])

    kinds = copies.schema["label"].dataType.simpleString()
    graphs = placed.select("label", "dim", "shard", "rep", "members", "embedding").groupBy("label", "dim", "shard").applyInPandas(
        build_shard, f"label {kinds}, dim int, shard long, reps binary, members binary, vectors binary, graph binary")
    graphs = settle(graphs, "graphs")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("other")
    each = graphs.join(counts, ["label", "dim"]).select("label", "dim", "shard", "reps", "members", "vectors", "graph", other)
    each = each.select("*", F.least("shard", "other").alias("low"), F.greatest("shard", "other").alias("high")).drop("other")

    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        sides = [Shard(row) for row in part.sort_values("shard").itertuples(index=False)]
        left, right = sides[0], sides[-1]
        linked = np.zeros((len(left.reps), len(right.reps)), dtype=bool)
        # each side's vectors query the other's graph, so a pair that one of them finds counts for both
        for queries, shard, seen in ((left, right, linked), (right, left, linked.T))[: len(sides)]:
            for i in range(0, len(queries.reps), query_rows):
                first, second = links_of(shard.units, shard.graph, queries.units[i : i + query_rows], threshold, width=width, audit=audit, recall=recall)
                seen[first + i, second] = True
        if len(sides) == 1:
            linked |= linked.T
            np.fill_diagonal(linked, False)
        every = np.concatenate([side.reps for side in sides])
        apart = len(left.reps) if len(sides) > 1 else 0
        counts, edges = np.zeros(len(every), dtype=np.int64), [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i in range(0, len(left.reps), 256):
            first, second = np.nonzero(linked[i : i + 256])
            first += i
            exact = np.concatenate([np.einsum("kd,kd->k", left.vectors[first[k : k + 65536]], right.vectors[second[k : k + 65536]]) for k in range(0, len(first), 65536)] or [np.zeros(0)])
            near = exact / (left.norms[first] * right.norms[second]) >= threshold
            first, second = first[near], second[near] + apart
            np.add.at(counts, first, right.members[second - apart])
            if apart:
                np.add.at(counts, second, left.members[first])
            root = roots(len(every), first, second)
            moved = np.flatnonzero(root != np.arange(len(every)))
            edges.append((moved, root[moved]))
        root = roots(len(every), *(np.concatenate(side) for side in zip(*edges, strict=True)))
        met = np.flatnonzero(counts)
        return pd.DataFrame({"rep": every[met], "links": counts[met], "root": every[root[met]]})

    found = settle(each.groupBy("label", "dim", "low", "high").applyInPandas(search, "rep long, links long, root long"), "embedding-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "rep")
    named = copies.select("rep", "copy_key", "members", "least").join(links, "rep", "left").join(classes, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    named = settle(named, "vector-classes")
    least = settle(named.groupBy("root").agg(F.min("least").alias("component_id")), "vector-least")
    named = settle(named.join(least, "root").select("copy_key", "component_id", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "vectors-named")
    joined = rows.select("vec_id", "copy_key").join(named, "copy_key", "left")
    component = F.when(F.col("copy_key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
