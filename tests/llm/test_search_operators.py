"""Operators 11 to 13 against plain versions, and on odd rows."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import connect, spark_rows, sql_rows
from tests.llm.helpers import documents
from tidemark.llm import decontamination, queries, ranked_search, whitening

BIG = (1 << 53) + 1
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def made_texts(n, seed, words="the of and in a b c d e f É Ü x1 Y2"):
    draw, pool = random.Random(seed), words.split()
    texts = [None, "", " \n", "--", "the of", "a " * 3000 + "b", *["the of and " * 5] * 3]
    while len(texts) < n:
        texts.append(draw.choice([" ", ", ", "\n"]).join(draw.choices(pool, k=draw.randint(1, 60))))
    return texts


def doc_table(spark, texts, **extra):
    """Documents with ids above 2^53, a null one beside them, a repeated row and columns with clashing names."""
    rows = [(BIG + i if i != 3 else None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[-1]], "doc_id long, text string").withColumns({c: F.lit("x") for c in ("n", "score", "rank", "items", "spans", "term")} | extra)


def item_table(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string").withColumn("row", F.lit(1))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, folder, name):
    assert spark_rows(queries.QUERIES[name](spark, folder)) == sql_rows(connect(folder), queries.SQL[name])


def plain_hits(text, items, window):
    words = plain_terms(text)
    hit, found = set(), set()
    for item, other in items:
        wanted = plain_terms(other)
        size = min(window, len(wanted))
        runs = {tuple(wanted[i : i + size]) for i in range(len(wanted) - size + 1)} if wanted else set()
        for s in range(len(words) - size + 1):
            if tuple(words[s : s + size]) in runs:
                hit |= set(range(s, s + size))
                found.add("" if item is None else str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1 << 23, 2000])
def test_windows_found_are_those_of_all_pairs(spark, block_bytes):
    texts = made_texts(60, 1)
    wanted = [None, "", "the, OF", "é ü", *made_texts(25, 2, "the of and a b É")[6:], texts[-1] + " x", "a " * 30]
    wanted[-3] = " ".join(plain_terms(texts[20])[:12]) or "x"
    items = item_table(spark, wanted).withColumn("item_id", F.when(F.col("item_id") != 5, F.col("item_id")))
    docs = doc_table(spark, texts)
    found = decontamination.find_benchmark(docs, items, window=4, block_bytes=block_bytes)
    pairs = [(i if i != 5 else None, t) for i, t in enumerate(wanted)]
    got = sorted(tuple(row) for row in decontamination.digests(found).fillna(-1, ["doc_id"]).collect())
    ids = [*[BIG + i if i != 3 else -1 for i in range(len(texts))], BIG + len(texts) - 1]
    assert got == sorted((i, *plain_hits(t, pairs, 4)) for i, t in zip(ids, [*texts, texts[-1]], strict=True))


def test_decontamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = item_table(spark, ["one two three"])
    assert decontamination.digests(decontamination.find_benchmark(none, items)).count() == 0
    row = decontamination.digests(decontamination.find_benchmark(doc_table(spark, ["one two three"]).limit(1), items.limit(0))).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)


def test_decontamination_of_odd_documents(spark, folder):
    docs, items = documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    assert decontamination.digests(decontamination.find_benchmark(docs, items)).count() == docs.count()


def plain_ranks(texts, wanted, k):
    """Rows (item, rank, document's place, score) by the formula, one pair after the other."""
    found = [plain_terms(t) for t in texts]
    holding, length = sum(1 for t in found if t), sum(map(len, found))
    df = {}
    for t in found:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item, text in enumerate(wanted):
        scores = []
        for d, t in enumerate(found):
            m = 100 - 50 + (50 * len(t) * holding) // length
            score = 0
            for term in set(plain_terms(text)) & set(t):
                w = math.floor(1000 * math.log((2 * holding + 2) / (2 * df[term] + 1)))
                score += w * ((1_000_000_000 * t.count(term)) // (1000 * t.count(term) + 20 * m))
            if score > 0:
                scores.append((-score, d))
        out += [(item, rank, d, -score) for rank, (score, d) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize(("coordinates", "block_terms"), [(1024, 8192), (4, 20)])
def test_ranks_are_those_of_all_pairs(spark, coordinates, block_terms):
    texts = [t for i, t in enumerate(made_texts(150, 3, "the of and in a b c d e f g h i j k l É Ü")) if i != 3]
    wanted = [None, "", "THE the of", "é j", "nowhere", *made_texts(20, 4)[6:]]
    docs = spark.createDataFrame([(BIG + i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(5)
    found = ranked_search.rank_documents(docs, item_table(spark, wanted), k=7, coordinates=coordinates, block_terms=block_terms)
    assert sorted(tuple(row) for row in found.collect()) == sorted((i, r, BIG + d, s) for i, r, d, s in plain_ranks(texts, wanted, 7))


def test_bounds_hold_every_score():
    draw = np.random.default_rng(1)
    queries_ = ranked_search.Queries([np.unique(draw.integers(-(1 << 62), 1 << 62, 40)) for _ in range(5)], 16)
    queries_.weigh(draw.integers(0, 100, len(queries_.vocabulary)), 100)
    for _ in range(50):
        held = np.unique(draw.choice(queries_.vocabulary, 20))
        found = ranked_search.impacts(draw.integers(1, 9, len(held)), 60)
        sketch = np.zeros(16, np.uint16)
        np.maximum.at(sketch, ranked_search.coordinate(held, 16), (-(-found // 16)).astype(np.uint16))
        at = np.searchsorted(queries_.vocabulary, held)
        scores = [sum(int(queries_.weight[a] * i) for a, i in zip(at, found, strict=True) if a in mine) for mine in queries_.terms]
        assert (queries_.bounds(sketch[None])[0] >= scores).all()


def test_search_takes_null_ids_ties_and_empty_tables(spark):
    docs = doc_table(spark, ["one two"] * 5)
    found = ranked_search.rank_documents(docs, item_table(spark, ["one", None]), k=4).orderBy("rank").collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in found] == [(0, 1, BIG), (0, 2, BIG + 1), (0, 3, BIG + 2), (0, 4, BIG + 4)]
    docs = docs.unionByName(spark.createDataFrame([(1, "three")], "doc_id long, text string"), allowMissingColumns=True)
    found = ranked_search.rank_documents(docs, item_table(spark, ["one three"]), k=6).orderBy("rank").collect()
    assert [(r.rank, r.doc_id) for r in found] == [(1, 1), (2, BIG), (3, BIG + 1), (4, BIG + 2), (5, BIG + 4), (6, BIG + 4)]
    assert ranked_search.rank_documents(docs.limit(0), item_table(spark, ["one"])).count() == 0
    assert ranked_search.rank_documents(docs, item_table(spark, ["one"]).limit(0)).count() == 0


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"n": F.lit(1), "width": F.lit("x"), "whitened": F.lit(2)})


def plain_whitening(c):
    x = np.floor(64 * np.asarray(c, np.float32).astype(np.float64)) + 1_000_000
    y = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(y.T @ y / len(x))
    deviation = ((len(x) * x - x.sum(axis=0)) ** 2).sum(axis=1).astype(np.int64)
    return values[::-1], y @ directions[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), deviation


def test_whitening_equals_a_dense_eigensolver(spark):
    c = np.random.default_rng(2).standard_normal((700, 40)) @ np.diag(np.linspace(1, 3, 40))
    odd = [(1, None), (2, []), (3, [None] * 40), (4, [float("nan")] * 40), (5, [float("inf")] + [0.0] * 39)]
    rows = [(BIG + i if i else None, v.tolist()) for i, v in enumerate(c)]
    found = whitening.whiten(vectors(spark, rows + odd).repartition(7), block_rows=64)
    # row 0 has no id, the others' are too large for a double
    found = found.withColumn("place", F.coalesce(F.col("vec_id") - F.lit(BIG), F.lit(0))).drop("vec_id").toPandas()
    values, whitened, deviation = plain_whitening(c)
    assert len(found) == 700 * 32 and set(found.component) == set(range(1, 33)) and set(found.n) == {700}
    place = found.place.to_numpy()
    assert (found.deviation.to_numpy() == deviation[place]).all()
    got = np.zeros((700, 32))
    got[place, found.component.to_numpy() - 1] = found.whitened
    signs = np.sign((got * whitened[:, :32]).sum(axis=0))
    assert np.abs(got * signs - whitened[:, :32]).max() < 1e-9
    shares = found.groupby("component").explained.first().to_numpy()
    assert np.abs(shares / (values[:32] / values.sum()) - 1).max() < 1e-10 and found.identity_error.max() < 1e-9


def test_whitening_of_ties_lengths_and_few_vectors(spark):
    corners = [(i, [float(a), float(b), 0.0]) for i, (a, b) in enumerate([(1, 1), (1, -1), (-1, 1), (-1, -1)] * 3)]
    found = whitening.whiten(vectors(spark, corners)).collect()
    assert {r.component for r in found} == {1, 2} and all(abs(abs(r.explained) - 0.5) < 1e-12 for r in found)
    assert max(r.identity_error for r in found) < 1e-9
    both = whitening.whiten(vectors(spark, corners + [(90, [1.0]), (91, [3.0]), (92, [3.0])])).collect()
    assert len(both) == len(found) + 3 and {r.n for r in both} == {12, 3}
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None)])).count() == 0
    huge = whitening.whiten(vectors(spark, [(1, [1e30, 0.0]), (2, [-1e30, 0.0])])).collect()
    assert [r.deviation for r in huge] == [None, None]


@pytest.mark.parametrize("kind", ["plain", "few rows", "equal columns", "graded", "identity", "multiple", "orthogonal", "one", "zero"])
def test_spectrum_of_hard_matrices(kind):
    draw = np.random.default_rng(3)
    q = np.linalg.qr(draw.standard_normal((48, 48)))[0]
    matrix = {
        "plain": draw.standard_normal((300, 48)),
        "few rows": draw.standard_normal((9, 48)),
        "equal columns": np.repeat(draw.standard_normal((300, 8)), 6, axis=1),
        "graded": draw.standard_normal((300, 48)) * np.logspace(0, -9, 48),
        "identity": np.eye(48),
        "multiple": q @ np.diag(np.repeat([5.0, 3, 2, 1], 12)) @ q.T,
        "orthogonal": q,
        "one": draw.standard_normal((20, 1)),
        "zero": np.zeros((5, 4)),
    }[kind]
    r = whitening.triangular(matrix)
    values, directions = whitening.spectrum(np.concatenate([r, np.zeros((matrix.shape[1] - len(r), matrix.shape[1]))]), 48)
    expected = np.linalg.svd(matrix, compute_uv=False)[: len(values)] ** 2
    assert len(values) == np.linalg.matrix_rank(matrix)
    assert np.allclose(values, expected, rtol=1e-9, atol=0)
    assert np.abs(directions.T @ directions - np.eye(len(values))).max(initial=0) < 1e-11
    assert np.abs(matrix.T @ (matrix @ directions) - directions * values).max(initial=0) <= 1e-12 * max(1, expected.max(initial=1))


def test_states_are_merged_in_rounds(spark):
    parts = spark.range(50).select("id", F.encode(F.col("id").cast("string"), "UTF-8").alias("state"))
    merge = lambda states: str(sum(int(s) for s in states)).encode()
    assert [whitening.folded(parts, merge, "sums", held) for held in (1, 1000)] == [b"1225", b"1225"]
    assert whitening.folded(parts.limit(0), merge, "sums") is None
