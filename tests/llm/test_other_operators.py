"""Operators on conversations, pages and embeddings against plain versions, with odd rows; and the pipeline."""

import gzip
import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents
from tidemark.llm import chat, embedding_join, ngram_join, queries, url_filter, warc


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def turns(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    odd = [
        (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (None, 1, None, None), (None, None, "assistant", "a\\<|x\\n"),
        (-2, 1, "user", "no reply"), (-3, 1, "assistant", None), (-3, 1, "assistant", None), (-4, 1, "assistant", "é" * 300_000), (-4, 2, "user", "x"), (-4, 3, "assistant", "y"),
    ]
    long_one = [(-5, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(400)]
    return table.unionByName(spark.createDataFrame(odd + long_one, table.schema)).withColumns({"block": F.lit(1), "slice": F.lit("s"), "example": F.lit(None)}).cache()


@pytest.mark.parametrize("options", [{}, {"block_chars": 500, "rows_per_slice": 64}])
def test_conversations_read_back(turns, options):
    by = {}
    for r in turns.collect():
        by.setdefault(r["conv_id"], []).append(r)
    out = {r["conv_id"]: r for r in chat.digests(chat.expand(turns, **options)).collect()}
    assert set(out) == set(by)
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
        trained = "".join(r["text"] or "" for r in rows if r["role"] == "assistant")
        got = out[conv]
        assert (got["n_turns"], got["turns_sha256"]) == (len(rows), sha("".join(f"{r['role'] or ''}\n{r['text'] or ''}\n" for r in rows)))
        assert (got["loss_chars"], got["loss_sha256"]) == (len(trained), sha(trained)) and got["formatted_chars"] > 0 and got["contexts_whole"]


def test_each_reply_has_all_earlier_turns(turns):
    rows = sorted(chat.expand(turns.where("conv_id = -5"), rows_per_slice=1000).collect(), key=lambda r: r["n_turns"])
    assert len(rows) == 200 and [r["closes"] for r in rows] == [False] * 199 + [True]
    for k, r in enumerate(rows):
        assert chat.parse(r["text"]) == [(("user", "assistant")[i % 2], f"turn {i}") for i in range(2 * k + 2)]
        assert r["text"][r["loss_start"] : r["loss_end"]] == f"turn {2 * k + 1}"
    assert chat.expand(turns.limit(0)).count() == 0 and chat.digests(chat.expand(turns.limit(0))).count() == 0


LARGE = [None, (1 << 53), (1 << 53) + 1, -(1 << 63), (1 << 63) - 1, 5]


def test_large_ids_stay_whole_beside_null_ones(spark):
    table = spark.createDataFrame([(i, k, ("user", "assistant")[k], f"{i} says {k}") for i in LARGE for k in range(2)], "conv_id long, turn long, role string, text string").coalesce(1)
    got = chat.digests(chat.expand(table)).collect()
    assert Counter((r["conv_id"], r["n_turns"], r["loss_sha256"]) for r in got) == Counter((i, 2, sha(f"{i} says 1")) for i in LARGE)
    docs = spark.createDataFrame([(i, f"a text of its own for {i} " * 3) for i in LARGE], "doc_id long, text string").coalesce(1)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in ngram_join.join_ngrams(docs).collect()) == Counter((i, i, 0) for i in LARGE)
    assert Counter(r["doc_id"] for r in ngram_join.one_of_each(docs).collect()) == Counter(LARGE)
    alike = spark.createDataFrame([(i, "the same words for all of them") for i in LARGE], "doc_id long, text string").coalesce(1)
    assert {(r["class_id"], r["n_links"]) for r in ngram_join.join_ngrams(alike).collect()} == {(-(1 << 63), 5)}
    assert [r["doc_id"] for r in ngram_join.one_of_each(alike).collect()] == [-(1 << 63)]


def formatted(rows):
    return "".join(f"{chat.opening(r['role'] or '')}{chat.escape(r['text'] or '')}{chat.END}\n" for r in rows)


@pytest.mark.parametrize("options", [{}, {"block_chars": 500, "rows_per_slice": 64}])
def test_contexts_over_blocks_and_slices_are_whole(turns, options):
    table = turns.select("conv_id", "turn", "role", "text").where("conv_id < 0 OR conv_id IS NULL OR conv_id < 20")
    long_turn = [(-6, 0, "user", "ü<|" * 100_000), (-6, 1, "assistant", "short"), (-6, 2, "user", "again"), (-6, 3, "assistant", "\\")]
    long_talk = [(-7, i, ("user", "assistant")[i % 2], f"turn {i}") for i in range(4500)]
    table = table.unionByName(table.sparkSession.createDataFrame(long_turn + long_talk, table.schema)).cache()
    by = {}
    for r in table.collect():
        by.setdefault(r["conv_id"], []).append(r)
    examples = chat.settle(chat.expand(table, **options), "examples")
    wanted = examples.where("loss_start IS NOT NULL AND (conv_id IS NULL OR conv_id <> -7 OR n_turns = 2 OR first_turn > 4400)")
    out = chat.whole_contexts(wanted, examples).collect()
    assert len(out) == wanted.count() and {-6, -7, None} <= {r["conv_id"] for r in out}
    for rows in by.values():
        rows.sort(key=lambda r: (r["turn"] is not None, r["turn"] or 0, r["role"] or "", r["text"] or ""))
    for r in out:
        rows = by[r["conv_id"]][: r["n_turns"]]
        reply = chat.escape(rows[-1]["text"] or "")
        assert rows[-1]["role"] == "assistant" and r["first_turn"] == 0 and r["text"] == formatted(rows)
        assert (r["text"][r["loss_start"] : r["loss_end"]], r["loss_end"]) == (reply, len(r["text"]) - len(chat.END) - 1)
    read = {r["conv_id"]: r for r in chat.digests(examples).collect()}
    for conv, rows in by.items():
        places = [i for i, r in enumerate(rows) if r["role"] == "assistant"]
        before = [0]
        for r in rows:
            before.append(before[-1] + len(formatted([r])))
        assert (read[conv]["context_turns"], read[conv]["context_chars"]) == (sum(places), sum(before[i] for i in places))


def test_digests_do_not_shuffle_repeated_contexts(spark):
    table = spark.createDataFrame([(1, i, ("user", "assistant")[i % 2], hashlib.sha256(b"%d" % i).hexdigest() * 4) for i in range(400)], "conv_id long, turn long, role string, text string")
    examples = chat.settle(chat.expand(table), "examples")
    moved = chat.reduced(examples).selectExpr("sum(length(reply))", "sum(length(text))").first()
    whole = formatted(table.collect())
    assert moved[0] == 200 * 256 and moved[1] == len(whole)


@pytest.mark.parametrize("text", ["", "\\", "<|", "\\<|", "<\\|im_end|>", "<<||", "\n", "<|im_start|>user\n\\n"])
def test_escapes_are_undone(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host_end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[host_end:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:host_end]), path[:end]


def plain_rule(host, path):
    fits = [(n + p, v) for v, n, p in url_filter.RULES if (host == n or host.endswith("." + n)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


def test_urls(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    odd = [None, "", "x", "http://", "http://EXAMPLE.net/en/a?b#c", "a://b://c.net/x", "http://example.com/de", "http://example.com/de/", "http://xexample.net/en/", "ftp://É.NET?q=/", "http://a.org#/fr/", "http://h.net/" + "p/" * 5000]
    pages = pages.unionByName(spark.createDataFrame([(10**6 + i % 11, u, None) for i, u in enumerate(odd)], pages.schema)).withColumns({"host": F.lit(1), "label": F.lit("l"), "suffix": F.lit("s")})
    rows = pages.select("page_id", "url").collect()
    out = url_filter.judge_urls(pages, trees=3)
    want = Counter()
    for r in rows:
        host, path = plain_url(r["url"])
        want[(r["page_id"], host, path, *plain_rule(host, path))] += 1
    got = out.collect()
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in got) == want
    assert {r["verdict"] for r in got} <= {"allow", "block"} and all(0 <= r["score"] <= 1 for r in got)
    assert url_filter.judge_urls(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in url_filter.judge_urls(pages.where("url like '%org%'"), rules=(("allow", "org", "/"),)).collect()} == {"allow"}


def test_url_trees_learn_from_given_labels(spark):
    urls = [(f"http://site{i}.example.org/page/{i}", 0.0) for i in range(150)] + [(f"http://x{i * 7919 % 10007}{i * 104729 % 1009}.biz/a/b/c/{i}?p={i}&q=1&r=2", 1.0) for i in range(150)]
    labelled = spark.createDataFrame(urls, "url string, label double")
    pages = spark.createDataFrame([(1, "http://other.example.org/page/9999", ""), (2, "http://x5551234.biz/z/y/x/1?p=1&q=2&r=3", "")], "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge_urls(pages, (), labelled, trees=5).collect()} == {1: "allow", 2: "block"}


def test_copies_of_a_url_take_one_place_in_the_sample(spark):
    good = [(f"http://site{i}.example.org/page/{i}", 0.0) for i in range(150)]
    bad = [(f"http://x{i * 7919 % 10007}{i * 104729 % 1009}.biz/a/b/c/{i}?p={i}&q=1&r=2", 1.0) for i in range(150)]
    # the hot url is the one that comes first in the order of the draw
    first = spark.createDataFrame(good, "url string, label double").orderBy(F.xxhash64("url")).first()["url"]
    kinds = spark.createDataFrame(good + bad, "url string, label double")
    labelled = kinds.unionByName(spark.createDataFrame([(first, 0.0)] * 900, kinds.schema))
    pages = spark.createDataFrame([(1, "http://other.example.org/page/9999", ""), (2, "http://x5551234.biz/z/y/x/1?p=1&q=2&r=3", "")], "page_id long, url string, html string")
    ahead = kinds.where("label = 1").where(F.xxhash64("url") < F.xxhash64(F.lit(first))).count()
    out = url_filter.judge_urls(pages, (), labelled, trees=5, training_rows=200).collect()
    assert ahead < 10 and {r["page_id"]: r["verdict"] for r in out} == {1: "allow", 2: "block"}


def test_archives_round_trip(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet").limit(20)
    body = "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n" * 5
    odd = [(None, None, None), (501, "u\r\nv", body), (502, "u", body), (502, "u", body), (None, "n", body), (503, "u", "é"), (504, "u", "é"), (505, "http://long", "x" * 3_000_000)]
    pages = pages.unionByName(spark.createDataFrame(odd, pages.schema)).withColumns({"digest": F.lit(1), "type": F.lit("t"), "bytes": F.lit(2)})
    rows = pages.select("page_id", "html").collect()
    payload = {}
    for r in rows:
        payload.setdefault(r["html"] or "", []).append(r["page_id"])
    want = Counter()
    for r in rows:
        data = (r["html"] or "").encode()
        first = min((i for i in payload[r["html"] or ""] if i is not None), default=None)
        revisit = len(data) >= 100 and first is not None and r["page_id"] != first
        want[(r["page_id"], len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert Counter(tuple(r)[:5] for r in warc.round_trip(pages, file_bytes=2000).collect()) == want
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_records_are_read_by_length():
    record = lambda kind, body: f"WARC/1.0\r\nWARC-Type: {kind}\r\nContent-Length: {len(body)}\r\n\r\n".encode() + body + b"\r\n\r\n"
    plain = record("a", b"x\r\n\r\nWARC/1.0\r\n") + record("b", b"")
    for data in (plain, gzip.compress(plain), gzip.compress(plain[:30] + plain[30:]) + gzip.compress(record("c", b"1"))):
        found = [(f["warc-type"], block) for _, f, block in warc.records_of(data)]
        assert found[:2] == [("a", b"x\r\n\r\nWARC/1.0\r\n"), ("b", b"")]
    with pytest.raises(ValueError):
        list(warc.records_of(plain[:-20]))


def plain_links(rows):
    linked = {}
    for i, (_, label, vector) in enumerate(rows):
        linked[i] = set()
        if label is None or vector is None or not vector or any(x is None or not np.isfinite(x) for x in vector) or not any(vector):
            continue
        for j in range(i):
            other = rows[j][2]
            if j in sound and rows[j][1] == label and len(other) == len(vector):
                a, b = np.array(vector, float), np.array(other, float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                    linked[i].add(j)
                    linked[j].add(i)
        sound.add(i)
    return linked


sound: set[int] = set()


def test_embeddings_link_as_all_pairs_do(spark):
    draw = np.random.default_rng(6)
    rows = []
    for centre in draw.normal(size=(40, 16)):
        for _ in range(int(draw.integers(1, 12))):
            rows.append((len(rows), int(len(rows) % 2), (centre + draw.normal(size=16) * 0.06).astype("float32").tolist()))
    rows += [(i, 0, rows[0][2]) for i in (1000, 1001, 1001)]
    rows += [(1002, None, rows[0][2]), (1003, 0, None), (1004, 0, [0.0] * 16), (1005, 0, [float("nan")] * 16), (1006, 0, [None] * 16), (1007, 0, []), (1008, 0, [1.0, 2.0]), (1009, 0, [2.0, 4.0]), (None, 1, rows[1][2]), (1010, 0, [float("inf")] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int".replace("embedding array<float>, label int", "label int, embedding array<float>")).withColumns({"rep": F.lit(1), "shard": F.lit(2), "dim": F.lit(3)})
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in frame.collect()]
    sound.clear()
    linked = plain_links(rows)
    component = {}
    for i in linked:
        reach, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        component[i] = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
    want = Counter((rows[i][0], len(linked[i]), component[i], rows[i][0] == component[i]) for i in linked)
    for options in ({}, {"shard_rows": 40, "query_rows": 25, "width": 4}):
        assert Counter(map(tuple, embedding_join.join_embeddings(frame, **options).collect())) == want
    assert embedding_join.join_embeddings(frame.limit(0)).count() == 0


def test_several_shards_are_searched_through_their_graphs(spark, monkeypatch):
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(700, 24))
    vectors = (centres[draw.integers(700, size=3000)] + draw.normal(size=(3000, 24)) * 0.09).astype("float32")
    frame = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, label int, embedding array<float>")
    got = {r["vec_id"]: r for r in embedding_join.join_embeddings(frame, shard_rows=1000, query_rows=300).collect()}
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    want = (units @ units.T >= 0.98).sum(axis=1) - 1
    found = np.array([got[i]["n_links"] for i in range(3000)])
    assert want.sum() > 3000 and (found <= want).all() and found.sum() >= 0.999 * want.sum()
    # links count for both ends: their sum is even and no vector of a component is without one
    assert found.sum() % 2 == 0
    sizes = Counter(r["component_id"] for r in got.values())
    assert all((r["n_links"] > 0) == (sizes[r["component_id"]] > 1) for r in got.values())


def test_small_shards_use_their_graph(monkeypatch):
    draw = np.random.default_rng(10)
    vectors = embedding_join.unit(draw.normal(size=(400, 16)))
    compared = []
    monkeypatch.setattr(embedding_join, "all_pairs", lambda *args, real=embedding_join.all_pairs: compared.append(1) or real(*args))
    first, second = embedding_join.links_of(vectors, embedding_join.build(vectors), vectors, 0.98, width=64, audit=50, recall=0.9)
    assert (first == second).all() and len(first) == 400 and not compared


def test_graph_recall_against_all_vectors():
    draw = np.random.default_rng(8)
    vectors = embedding_join.unit(draw.normal(size=(3000, 32)))
    graph = embedding_join.Graph.unpack(embedding_join.build(vectors).pack())
    queries_ = embedding_join.unit(vectors[:300] + draw.normal(size=(300, 32)).astype("float32") * 0.02)
    numbers, cosines = embedding_join.nearest(vectors, graph, queries_, 32)
    assert np.mean(numbers[np.arange(300), cosines.argmax(axis=1)] == np.arange(300)) >= 0.98
    crowd = embedding_join.unit(np.concatenate([vectors[:1] + draw.normal(size=(1500, 32)) * 0.001, vectors[1:1500]]))
    graph = embedding_join.build(crowd)
    first, second = embedding_join.links_of(crowd, graph, crowd[:50], 0.98, width=16, audit=50, recall=0.99)
    assert len(first) == 50 * 1500 and second.max() < 1500


def test_every_query_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.settle(stage(spark, kept, folder), "stage")
        assert kept.columns == docs.columns and 0 < kept.count()
    packed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in kept.select("doc_id").distinct().collect()}
    assert packed.count() >= kept.count()


def test_pipeline_of_odd_and_empty_tables(spark, folder):
    odd = documents(spark, folder)
    for docs in (odd, odd.limit(0), odd.where("text IS NULL")):
        kept = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.settle(stage(spark, kept, folder), "stage")
            assert kept.columns == docs.columns, name
        packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
        assert (packed.count() > 0) == (kept.count() > 0)
