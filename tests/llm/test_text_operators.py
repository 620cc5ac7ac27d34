"""Operators on documents against plain versions, on the smallest tables with odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import LONG, documents, words
from tidemark.llm import common, license_scan, mixing, ngram_join, packing, quality, toxicity


@pytest.fixture(scope="module")
def docs(spark, folder):
    return documents(spark, folder).cache()


@pytest.fixture(scope="module")
def rows(docs):
    return docs.select("doc_id", "text", "source").collect()


def plain_targets(sizes, cap=3.0):
    """Cut the targets above their cap and share the excess by weight, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest, share = total - sum(capped.values()), sum(weight[s] for s in free)
        now = {s: rest * weight[s] / share for s in free}
        over = {s: cap * sizes[s] for s in free if now[s] > cap * sizes[s]}
        if not over:
            return capped | now
        capped |= over


def test_mix_meets_its_targets(docs, rows):
    mixed = mixing.mix_sources(docs, block=64).collect()
    assert Counter(r["doc_id"] for r in mixed) == Counter(r["doc_id"] for r in rows)
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += len(words(r["text"]))
    targets = plain_targets(sizes)
    taken = Counter()
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - targets[s]) <= 1 for s in targets)
    assert sorted(map(tuple, mixed), key=str) == sorted(map(tuple, mixing.mix_sources(docs, block=64).collect()), key=str)


def test_each_document_is_taken_as_its_place_says(docs):
    by = {}
    for r in mixing.mix_sources(docs, block=64).where("size > 0").collect():
        by.setdefault(r["source"], []).append(r)
    for rows in by.values():
        rows.sort(key=lambda r: (r["start"], r["size"]))
        assert [r["start"] for r in rows] == [sum(r["size"] for r in rows[:k]) for k in range(len(rows))]
        epochs, rest = divmod(round(rows[0]["target"]), rows[0]["source_size"])
        for r in rows:
            assert r["taken"] == epochs * r["size"] + min(max(rest - r["start"], 0), r["size"])


def test_mix_slots_follow_the_weights_evenly(spark, docs):
    targets = spark.createDataFrame([(0, "a", 6400, 1.0, 6400.0), (1, "b", 6400, 2.0, 12800.0), (2, "c", 0, 3.0, 0.0)], "sid long, source string, source_size long, weight double, target double")
    slots = sorted(mixing.slots(targets, 64, chunk=16).collect(), key=lambda r: r["slot"])
    assert [r["rank"] for r in slots if r["sid"] == 1] == list(range(200)) and sum(r["sid"] == 0 for r in slots) == 100
    early = [r["sid"] for r in slots if r["slot"] < 30]
    assert 8 <= early.count(0) <= 12


def test_mixed_documents_keep_the_columns(docs):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns and out.count() > 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0 and mixing.mix_sources(docs.limit(0)).count() == 0


def test_running_start_of_a_hot_key(spark):
    table = spark.range(5000).selectExpr("id", "if(id < 4000, 1, id) AS k", "2 AS n").withColumn("spread", common.spread_key(common.F.col("id")))
    out = common.running_start(common.settle(table, "hot"), "k", ["spread", "id"], "n", "start", rows_per_bucket=50).where("k = 1").collect()
    assert [r["start"] for r in sorted(out, key=lambda r: r["spread"])] == list(range(0, 8000, 2))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 140)] + [(7, 7), (60, 50), (50, 55)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)} | {50: 50, 55: 50, 60: 50}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_quality(text):
    found, lines = words(text), (text or "").split("\n")
    seen, copies = set(), 0
    for line in lines:
        if words(line):
            copies += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:]))
    repeated = {i + k for i in range(len(found) - 2) if windows[tuple(found[i : i + 3])] > 1 for k in range(3)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(found), sum(map(len, found)), symbols, copies, len(repeated)


def test_quality_counts(rows):
    for text in [r["text"] for r in rows] + ["a b a b a b", "x\nx\n \n \nx", "é ü\u00a0x\x1c\u2028y", "#*$ %&|<>", "a a a a"]:
        assert quality.measure(text)[0] == plain_quality(text)


def test_quality_decodes_the_best_labels():
    draw = np.random.default_rng(0)
    for _ in range(20):
        model = quality.LineModel(np.zeros(1), draw.normal(size=(2, 2)), draw.normal(size=2))
        scores = draw.normal(size=5)

        def total(labels):
            return model.first[labels[0]] + sum(scores[i] for i, y in enumerate(labels) if y) + sum(model.moves[a, b] for a, b in zip(labels, labels[1:]))

        best = max((tuple(n >> i & 1 for i in range(5)) for n in range(32)), key=total)
        assert tuple(quality.decode(scores, model)) == best
        posterior, expected, _ = quality.marginals(scores[None], np.ones((1, 5), dtype=bool), model.moves, model.first)
        each = {y: np.exp(total(y)) for y in (tuple(n >> i & 1 for i in range(5)) for n in range(32))}
        assert posterior[0] == pytest.approx([sum(v for y, v in each.items() if y[i]) / sum(each.values()) for i in range(5)])
        assert expected.sum() == pytest.approx(4)


def test_quality_verdicts(spark, docs, rows, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train_quality(docs, labels)
    out = quality.judge_quality(docs, model).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in rows)
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    judged = [r["kept"] for r in out if r["doc_id"] in good and not r["base_failed"]]
    assert sum(judged) > 0.9 * len(judged)
    assert quality.good_documents(docs, model).columns == docs.columns
    assert quality.judge_quality(docs.limit(0), model).count() == 0
    assert not quality.train_quality(docs, labels.limit(0)).weights.any()


def test_network_gradients():
    shape = toxicity.Shape(word_buckets=64, char_buckets=64, width=3, hidden=3, window=6, stride=3)
    trainer = toxicity.Trainer(["a bb ccc idiot dd e f g", "x y"], shape, 0)
    weights = {name: w.astype("float64") for name, w in trainer.weights.items()}
    ids = trainer.windows[0]
    projected = np.random.default_rng(0).normal(size=(ids.max() + 1, 18))
    projected[0] = 0
    slope = np.arange(1.0, len(ids) + 1)
    value = lambda: float((toxicity.forward(weights, projected, ids) * slope).sum())
    _, kept = toxicity.forward(weights, projected, ids, keep=True)
    used, d_rows, grads = toxicity.backward(weights, projected, ids, kept, slope)
    for array, gradient in [(weights["state"], grads["state"]), (weights["attend"], grads["attend"]), (weights["out"], grads["out"]), (projected[2], d_rows[list(used).index(2)])]:
        at = tuple(0 for _ in array.shape)
        old = array[at]
        array[at] = old + 1e-2
        high = value()
        array[at] = old - 1e-2
        low = value()
        array[at] = old
        assert (high - low) / 2e-2 == pytest.approx(gradient[at], rel=0.05, abs=1e-3)


def plain_score(weights, shape, text):
    """The network written out word by word: the highest probability of any window."""
    logistic = lambda x: 1 / (1 + np.exp(-x))
    words, h, highest = text.lower().split(), shape.hidden, 0.0
    inputs = {}
    for word in words:
        one = toxicity.Words(shape)
        one.number([word])
        inputs[word] = toxicity.word_inputs(weights, *one.inputs())[0].astype(float) @ weights["input"] + weights["bias"]
    starts = [0]
    while starts[-1] + shape.window < len(words):
        starts.append(starts[-1] + shape.stride)
    for start in starts:
        window = words[start : start + shape.window]
        states = np.zeros((len(window), 2 * h))
        for side, order in ((0, range(len(window))), (1, reversed(range(len(window))))):
            state = np.zeros(h)
            for t in order:
                given, past = inputs[window[t]][side * 3 * h : (side + 1) * 3 * h], state @ weights["state"][side]
                update, reset = logistic(given[:h] + past[:h]), logistic(given[h : 2 * h] + past[h : 2 * h])
                state = state + update * (np.tanh(given[2 * h :] + reset * past[2 * h :]) - state)
                states[t, side * h : (side + 1) * h] = state
        share = np.exp(states @ weights["attend"])
        pooled = (share[:, None] * states).sum(axis=0) / share.sum() if len(window) else np.zeros(2 * h)
        highest = max(highest, logistic(pooled @ weights["out"] + weights["offset"][0]))
    return highest


def test_scores_are_those_of_the_network_written_out():
    shape = toxicity.Shape(word_buckets=64, char_buckets=64, width=4, hidden=5, window=8, stride=4)
    weights = toxicity.new_weights(shape, 3)
    draw = np.random.default_rng(4)
    texts = ["", "one", *[" ".join(draw.choice(["Idiot!", "a", "bb", "ccc", "née", "dd-e"], size=n)) for n in (7, 8, 9, 12, 13, 40, 41, 300)]]
    want = [plain_score(weights, shape, text) for text in texts]
    for options in ({}, {"stretch": 16}, {"stretch": 4, "held": 2}):
        assert toxicity.Scorer(weights, shape, **options).scores(texts) == pytest.approx(want, rel=1e-4)


def test_training_rows_are_bounded(spark):
    rows = [(i, f"text {i} " * 3) for i in range(40)] + [(0, "x " * 50_000), (1, "again")]
    docs = spark.createDataFrame([*rows, (None, None), (2, None)], "doc_id long, text string").withColumns({"toxic": F.lit("x"), "quality": F.lit(9), "draw": F.lit(1)})
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(0, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    seen = []
    real = toxicity.train
    toxicity.train = lambda texts, toxic, shape, **options: seen.append((texts, toxic)) or real(texts, toxic, shape, steps=1, **options)
    try:
        toxicity.train_toxicity(docs, labels, chars=300)
        toxicity.train_toxicity(docs, labels.limit(0))
    finally:
        toxicity.train = real
    assert 5 < len(seen[0][0]) and sum(map(len, seen[0][0])) <= 300 and len(seen[0][0]) == len(seen[0][1]) and seen[1] == ([], [])
    assert quality.train_quality(docs, labels, bad_lines=5, good_lines=5) is not None


def test_windows_overlap_and_cover_the_text():
    shape = toxicity.Shape()
    for n in (0, 1, 31, 32, 33, 48, 49, 1000):
        w = toxicity.windows(np.arange(1, n + 1, dtype=np.int32), shape)
        assert set(w.ravel()) - {0} == set(range(1, n + 1)) and len(w) == max(1, -(-(n - 32) // 16) + 1)


def test_toxicity_learns_and_ignores_where_the_word_stands(spark):
    draw = np.random.default_rng(5)
    common_words = [f"w{i}" for i in range(300)]
    texts = [list(draw.choice(common_words, size=draw.integers(5, 150))) for _ in range(400)]
    toxic = [i % 2 == 0 for i in range(400)]
    for text, bad in zip(texts, toxic):
        if bad:
            text[draw.integers(len(text))] = str(draw.choice(["nastyone", "vileness", "scumbag"]))
    weights = toxicity.train([" ".join(t) for t in texts[:300]], toxic[:300])
    scores = toxicity.Scorer(weights, toxicity.Shape()).scores([" ".join(t) for t in texts[300:]])
    assert np.mean((scores >= 0.5) == np.array(toxic[300:])) > 0.95
    late = " ".join(draw.choice(common_words, size=3000)) + " scumbag"
    frame = spark.createDataFrame([(1, late), (2, None), (3, ""), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_documents(frame, weights).collect()}
    assert got[1]["predicted"] == 1 and got[2]["score"] == got[3]["score"] and 0 <= got[2]["score"] <= 1
    assert got[1]["held_out"] == (zlib.crc32(b"1") % 5 == 0)
    assert toxicity.score_documents(frame.limit(0), weights).count() == 0


def test_toxicity_of_one_kind_of_label():
    assert toxicity.Scorer(toxicity.train(["a"], [False]), toxicity.Shape()).scores(["b c"])[0] < 0.1
    assert toxicity.Scorer(toxicity.train([], []), toxicity.Shape()).scores([""])[0] < 0.1


def test_licenses_and_their_spans():
    index = license_scan.Index(license_scan.TEMPLATES)
    text = "Intro é text.\nReleased under the  MIT License. More. licensed under the Apache license version 2.0, yes"
    found = license_scan.scan(text, index, 0.8)
    assert [(name, text[a:b]) for name, _, _, a, b in found] == [("MIT", "Released under the  MIT License"), ("Apache-2.0", "licensed under the Apache license version 2.0")]
    for name, template in license_scan.TEMPLATES.items():
        # four words in a row must stay for the index to promise a match: five-word notices come as they are
        parts = template.split()
        if len(parts) >= 9:
            parts.insert(len(parts) // 2, "extra")
        noisy = "zz " * 300 + " ".join(parts) + " zz" * 50
        (best,) = license_scan.scan(noisy, index, 0.8)
        assert best[0] == name and best[1] > 0.9
    assert license_scan.scan(None, index, 0.8) == [] == license_scan.scan("the license", index, 0.8)


def plain_alignment(template, text):
    best = np.zeros((len(template) + 1, len(text) + 1))
    for i in range(len(template)):
        for j in range(len(text)):
            best[i + 1, j + 1] = max(best[i, j] + 1 if template[i] == text[j] else 0, best[i, j + 1], best[i + 1, j])
    return best[-1, -1]


def test_alignment_matches_no_more_than_can_be():
    draw = np.random.default_rng(2)
    for _ in range(30):
        template = list(range(1, 13))
        text = [w for w in template if draw.random() > 0.1]
        text.insert(int(draw.integers(len(text) + 1)), 99)
        met = license_scan.align(template, text, 0, 4)
        assert met[0] == plain_alignment(template, text)
        assert text[met[1]] == min(w for w in text if w in template)


def test_scan_rows(docs):
    out = license_scan.scan_licenses(docs)
    assert out.columns == ["doc_id", "license", "coverage", "matched", "start", "end"] and out.where("coverage < 0.8").count() == 0
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0


def test_joined_ngrams_are_those_of_all_pairs(docs, rows):
    out = ngram_join.join_ngrams(docs)
    got = out.collect()
    assert len(got) == len(rows)
    shingle = ngram_join.Shingler(5)
    plain = {}
    for r in rows:
        w = words(r["text"])
        plain[(r["doc_id"], r["text"])] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
        assert len(shingle(r["text"])) == len(plain[(r["doc_id"], r["text"])])
    keys = [(r["doc_id"], r["text"]) for r in rows]
    links = Counter()
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = plain[a], plain[b]
            if x and len(x & y) >= 0.8 * len(x | y):
                links[a] += 1
                links[b] += 1
    want = Counter((r["doc_id"], links[(r["doc_id"], r["text"])] // Counter(keys)[(r["doc_id"], r["text"])]) for r in rows)
    assert Counter((r["doc_id"], r["n_links"]) for r in got) == want
    assert {r["class_id"] for r in got if r["doc_id"] in (900_005, 900_006)} == {900_005}
    one = ngram_join.one_of_each(docs)
    assert one.columns == docs.columns
    kept = Counter(r["doc_id"] for r in one.collect())
    assert kept[900_005] == 1 and not kept[900_006] and all(kept[i] for i in (900_001, 900_002, 900_003))
    assert ngram_join.join_ngrams(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("crowd", "block_docs"), [(64, 4096), (2, 7), (5, 7)])
def test_blocks_of_a_large_group_lose_no_link(spark, crowd, block_docs):
    draw = np.random.default_rng(3)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(60):
        text = list(base)
        for at in draw.integers(200, size=i % 5):
            text[at] = f"x{i}{at}"
        texts.append((i, " ".join(text)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r["doc_id"]: r for r in ngram_join.join_ngrams(frame, crowd=crowd, block_docs=block_docs).collect()}
    sets = [ngram_join.Shingler(5)(t) for _, t in texts]
    linked = ngram_join.similar(sets, sets, 0.8)
    assert [got[i]["n_links"] for i in range(60)] == (linked.sum(axis=1) - 1).tolist()


def test_depth_meets_the_recall():
    depth = ngram_join.matched_depth(0.8, 32, 8, 0.99999)
    assert 1 - (1 - 0.8**depth) ** 32 >= 0.99999 > 1 - (1 - 0.8 ** (depth + 1)) ** 32


def test_tries_know_each_rows_nearest_neighbours(spark):
    draw = np.random.default_rng(2)
    values = draw.integers(3, size=(300, 2, 8)).astype(np.uint8)
    values[:100] = values[0]
    signed = values.copy().view(">i8")[..., 0].astype(np.int64)
    sets = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(signed)], "rep long, signature array<long>").repartition(3)
    got = {(r["rep"], r["tree"]): r["depth"] for r in ngram_join.tries(sets).collect()}
    for tree in range(2):
        for i in range(300):
            others = np.delete(np.arange(300), i)
            depth = ngram_join.shared_prefix(signed[others, tree], signed[i, tree]).max()
            assert got.get((i, tree), 0) == (depth if depth >= ngram_join.SHALLOWEST else 0)


def test_audit_counts_the_links_by_depth(spark):
    draw = np.random.default_rng(5)
    texts = []
    for i in range(40):
        base = [f"w{i // 4}x{k}" for k in range(100)]
        for at in draw.integers(100, size=i % 4):
            base[at] = f"y{i}{at}"
        texts.append((i, " ".join(base)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    slim = ngram_join.signatures(docs, 5, 32, 7).cache()
    sets = slim.select(F.monotonically_increasing_id().alias("rep"), "set_key", "n_grams", "signature", F.struct("doc_id", "text_key").alias("least")).cache()
    found = ngram_join.audited_depths(docs, sets, ngram_join.tries(sets), 5, 32, 7, 0.8, 1000, 1 << 20)
    grams, signed = ([f(t) for _, t in texts] for f in (ngram_join.Shingler(5), lambda t: ngram_join.Signer(32, 7)(ngram_join.Shingler(5)(t))))
    want = [0] * 9
    for i in range(40):
        for j in range(40):
            shared = len(np.intersect1d(grams[i], grams[j]))
            if shared >= 0.8 * (len(grams[i]) + len(grams[j]) - shared) and not np.array_equal(grams[i], grams[j]):
                want[ngram_join.shared_prefix(signed[i], signed[j]).max()] += 1
    assert found == want and sum(found) > 20
    assert ngram_join.shortened([0, 0, 0, 0, 1, 0, 0, 0, 1000], 0.8, 32, 0.9999) == 4


def test_overlaps_are_exact():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(300, size=draw.integers(1, 200))).astype(np.uint64) for _ in range(150)]
    got = ngram_join.overlaps(sets[:90], sets)
    assert (got == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:90]]).all()


def fewest(sizes, capacity):
    """The least number of sequences, by trying all."""
    best = len(sizes)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for k in range(len(rooms)):
            if rooms[k] >= sizes[i] and rooms[k] not in rooms[:k]:
                place(i + 1, [r - sizes[i] * (j == k) for j, r in enumerate(rooms)])
        place(i + 1, rooms + [capacity - sizes[i]])

    place(0, [])
    return best


def test_packing_is_as_good_as_trying_all():
    draw = np.random.default_rng(4)
    over = 0
    for _ in range(40):
        sizes = sorted(draw.integers(10, 70, size=9).tolist(), reverse=True)
        fillings, bound = packing.bin_completion(dict(Counter(sizes)), 100)
        used = Counter(s for f in fillings for s in f.lengths * f.times)
        assert used == Counter(sizes) and all(sum(f.lengths) <= 100 for f in fillings)
        n = sum(f.times for f in fillings)
        assert bound <= fewest(sizes, 100) <= n <= sum(f.times for f in packing.best_fit(dict(Counter(sizes)), 100))
        over += n - fewest(sizes, 100)
    assert over <= 1


def test_packing_short_lengths():
    for n in (1, 15, 3000):
        fillings, bound = packing.bin_completion({300: n, 200: 2 * n, 162: 2 * n}, 1024)
        assert sum(f.times for f in fillings) == bound == n
    # sequences of about ten lengths each, all full
    draw = np.random.default_rng(9)
    for _ in range(10):
        counts = Counter()
        for _ in range(8):
            ends = [0, *sorted(draw.choice(np.arange(1, 64), size=9, replace=False)), 64]
            counts.update({int(s): n * 7 for s, n in Counter(16 * np.diff(ends)).items()})
        fillings, bound = packing.bin_completion(dict(counts), 1024)
        assert sum((Counter({s: f.lengths.count(s) * f.times for s in f.lengths}) for f in fillings), Counter()) == counts
        assert sum(f.times for f in fillings) == bound == 56


def test_completions_are_all_undominated_fillings():
    draw = np.random.default_rng(6)

    def fillings(sizes, room):
        """All sets of at most the given copies that fit."""
        if not sizes:
            return [()]
        (size, n), *rest = sizes
        return [(size,) * k + f for k in range(min(n, room // size), -1, -1) for f in fillings(rest, room - k * size)]

    def dominated(filling, held, room):
        out = [x for x, n in held.items() if n > filling.count(x)]
        for picked in range(1 << len(filling)):
            gone = [s for i, s in enumerate(filling) if picked >> i & 1]
            if any(sum(gone) <= x <= sum(gone) + room - sum(filling) and gone != [x] for x in out):
                return True
        return False

    for _ in range(60):
        counts = dict(Counter(draw.integers(3, 30, size=11).tolist()))
        held = {s: n - (s == max(counts)) for s, n in counts.items()}
        room = 60 - max(counts)
        want = {f for f in fillings(sorted(held.items(), reverse=True), room) if not dominated(f, held, room)}
        found = [f for f in packing.completions(counts, max(counts), 60, 60) if f is not None]
        assert len(found) == len(set(found)) and set(found) == want
        assert [sum(f) for f in found] == sorted((sum(f) for f in found), reverse=True)


def test_packed_pieces(docs, rows):
    from tokenizers import Tokenizer

    path = packing.tokenizer_file("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    out = packing.pack_documents(docs).collect()
    want = Counter()
    for r in rows:
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        first = len(ids) if len(ids) <= 1024 else (len(ids) % 1024 or 1024)
        starts = [0, *range(first, len(ids), 1024)]
        for piece, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            want[(r["doc_id"], piece, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= sum(r["length"] for r in out) / 1024 * 1.02 + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_special_strings_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = packing.tokenizer_file("byte_bpe_50k.json")
    encode, whole = packing.encoder(path), Tokenizer.from_file(path)
    for text in ["a <|endoftext|> b", "", "  \n\n x\t", "é ü 中文 🎉", LONG[:5000], "x" * 3000, " " * 5000 + "y"]:
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_left_to_the_library(tmp_path):
    import json

    from tokenizers import Tokenizer

    path = packing.tokenizer_file("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    assert packing.plain_byte_level(model)
    lowered = model | {"normalizer": {"type": "Lowercase"}}
    swapped = model | {"model": model["model"] | {"merges": [*model["model"]["merges"][1:50], model["model"]["merges"][0], *model["model"]["merges"][50:]]}}
    for other in (lowered, swapped):
        assert not packing.plain_byte_level(other)
        (tmp_path / "other.json").write_text(json.dumps(other))
        text = "The Quick brown fox, 1234 Ünïcode\n\n the end"
        assert packing.encoder(str(tmp_path / "other.json"))(text) == Tokenizer.from_file(str(tmp_path / "other.json")).encode(text, add_special_tokens=False).ids
