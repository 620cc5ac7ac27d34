"""Operator 5: mark lines as content or boilerplate with a linear-chain conditional random field and judge texts by it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
SPACE = b" \t\n\r\x0b\x0c"
FEATURES = ["one", "symbols", "bars", "upper", "shouts", "closed", "short", "long", "repeated", "copied", "digits", "word_length", "prose"]
VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, content_share double, kept boolean"


@dataclass(frozen=True)
class LineModel:
    """Weights of the boilerplate label (content is the zero point), moves between labels and the share that keeps a text."""

    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray
    least_share: float = 0.5


def repeated_words(words: list[bytes]) -> np.ndarray:
    """Which words lie in a three-word window that the text has twice or more."""
    marked = np.zeros(len(words), dtype=bool)
    if len(words) < 4:
        return marked
    ids: dict[bytes, int] = {}
    codes = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    if len(ids) == len(words):
        return marked
    # pairs are numbered first, so that a window's code fits 64 bits in any text
    pair = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1].astype(np.int64)
    _, which, counts = np.unique(pair[:-1] * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    twice = np.flatnonzero(counts[which] > 1)
    for shift in range(3):
        marked[twice + shift] = True
    return marked


def measure(text: str | None) -> tuple[tuple[int, int, int, int, int], np.ndarray, list[int]]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; features and word characters of the lines that have a word."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    marked = repeated_words(words)
    rows, sizes, seen, copies, at = [], [], set(), 0, 0
    for line in data.split(b"\n"):
        parts = line.split()
        if not parts:
            continue
        copied = line in seen
        copies += copied
        seen.add(line)
        solid = b"".join(parts)
        n = len(solid)
        last = solid.rstrip(SYMBOLS)[-1:]
        signs, again = n - len(solid.translate(None, SYMBOLS)), float(marked[at : at + len(parts)].mean())
        rows.append((
            1.0, 4 * signs / n, 4 * parts.count(b"|") / len(parts), 2 * (n - len(solid.translate(None, UPPER))) / n,
            2 * solid.count(b"!!") / len(parts), 1.0 if last and last in b".!?" else 0.0, 1.0 if len(parts) < 4 else 0.0, math.log1p(len(parts)) / 5,
            again, float(copied), (n - len(solid.translate(None, b"0123456789"))) / n, n / len(parts) / 10,
            1.0 if len(parts) >= 10 and 20 * signs < n and again < 0.2 and b"!!" not in solid else 0.0,
        ))
        sizes.append(n if solid.isascii() else len(solid.decode("utf-8", "surrogatepass")))
        at += len(parts)
    n_symbols = len(data) - len(data.translate(None, SYMBOLS))
    base = (len(words), sum(sizes), n_symbols, copies, int(marked.sum()))
    return base, np.array(rows, dtype=np.float64).reshape(-1, len(FEATURES)), sizes


def decode(scores: np.ndarray, model: LineModel) -> list[int]:
    """The most likely labels of a text's lines (1 boilerplate); scores are those of label 1 against 0. Ties go to content."""
    (stay0, to1), (to0, stay1) = model.moves.tolist()
    best0, best1 = model.first.tolist()
    back: list[tuple[bool, bool]] = []
    for i, s in enumerate(scores.tolist()):
        if i:
            from1_0, from1_1 = best1 + to0 > best0 + stay0, best1 + stay1 > best0 + to1
            best0, best1 = (best1 + to0 if from1_0 else best0 + stay0), (best1 + stay1 if from1_1 else best0 + to1)
            back.append((from1_0, from1_1))
        best1 += s
    label = int(best1 > best0)
    labels = [label]
    for step in reversed(back):
        label = int(step[label])
        labels.append(label)
    return labels[::-1] if len(scores) else []


def judge(text: str | None, model: LineModel) -> tuple:
    base, features, sizes = measure(text)
    n_words, repeats = base[0], base[4]
    failed = n_words < 50 or 100 * repeats > 50 * n_words
    labels = decode(features @ model.weights, model)
    total = sum(sizes)
    share = sum(n for n, label in zip(sizes, labels) if not label) / total if total else 0.0
    return (*base, failed, share, not failed and share >= model.least_share)


def quality_verdict(text: Column, model: LineModel) -> Column:
    """A struct of the counts, base_failed, content_share and kept for each whole text.

    Null counts as empty; a text without words has no content, fails the base rules and is not kept.
    """

    @F.pandas_udf(VERDICT)
    def verdicts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in VERDICT.split(", ")]
        for texts in batches:
            yield pd.DataFrame([judge(text, model) for text in texts], columns=names)

    return verdicts(text)


def marginals(scores: np.ndarray, mask: np.ndarray, moves: np.ndarray, first: np.ndarray):
    """Posterior of label 1 per line, expected moves and first labels of padded sequences (rows: texts), by forward and backward sums."""
    n, length = scores.shape
    emit = np.stack([np.zeros_like(scores), scores], axis=2)
    forward = np.empty((n, length, 2))
    forward[:, 0] = first + emit[:, 0]
    for t in range(1, length):
        step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
        forward[:, t] = np.where(mask[:, t, None], step, forward[:, t - 1])
    norm = np.logaddexp.reduce(forward[:, -1], axis=1)
    backward = np.zeros((n, length, 2))
    expected = np.zeros((2, 2))
    for t in range(length - 2, -1, -1):
        onward = emit[:, t + 1] + backward[:, t + 1]
        joint = forward[:, t, :, None] + moves + onward[:, None, :] - norm[:, None, None]
        expected += np.exp(joint[mask[:, t + 1]]).sum(axis=0)
        backward[:, t] = np.where(mask[:, t + 1, None], np.logaddexp.reduce(moves + onward[:, None, :], axis=2), 0.0)
    posterior = np.exp(forward + backward - norm[:, None, None])
    return posterior[:, :, 1] * mask, expected, posterior[:, 0].sum(axis=0)


def fit_lines(texts: list[np.ndarray], bad: list[bool], *, rounds: int = 3, steps: int = 100, rate: float = 0.15, penalty: float = 1e-5, stretch: int = 16) -> LineModel:
    """Fit the field by gradient ascent on the likelihood of line labels.

    Only whole texts are labelled. Lines of good texts are content; lines of bad texts start as boilerplate and
    are labelled anew by the fitted field before each later round. Long texts are fitted in stretches of lines.
    """
    pieces = [(text[i : i + stretch], is_bad) for text, is_bad in zip(texts, bad) for i in range(0, len(text), stretch)]
    width = len(FEATURES)
    model = LineModel(np.zeros(width), np.zeros((2, 2)), np.zeros(2))
    if not any(is_bad for _, is_bad in pieces) or all(is_bad for _, is_bad in pieces):
        return model
    length = max(len(f) for f, _ in pieces)
    x, mask = np.zeros((len(pieces), length, width)), np.zeros((len(pieces), length), dtype=bool)
    for i, (f, _) in enumerate(pieces):
        x[i, : len(f)], mask[i, : len(f)] = f, True
    is_bad = np.array([b for _, b in pieces])
    labels = np.where(is_bad[:, None], 1, 0) * mask
    lines = mask.sum()
    for _ in range(rounds):
        theta, first_moment, second_moment = np.zeros(width + 6), np.zeros(width + 6), np.zeros(width + 6)
        moved = mask[:, 1:]
        seen = np.zeros((2, 2))
        np.add.at(seen, (labels[:, :-1][moved], labels[:, 1:][moved]), 1)
        start = np.array([(labels[:, 0] == 0).sum(), (labels[:, 0] == 1).sum()])
        for t in range(1, steps + 1):
            moves, first = theta[width : width + 4].reshape(2, 2), theta[width + 4 :]
            posterior, expected, begun = marginals(x @ theta[:width], mask, moves, first)
            gap = np.einsum("nt,ntk->k", labels - posterior, x)
            gradient = np.concatenate([gap, (seen - expected).ravel(), start - begun]) / lines - penalty * theta
            first_moment = 0.9 * first_moment + 0.1 * gradient
            second_moment = 0.999 * second_moment + 0.001 * gradient**2
            theta += rate * (first_moment / (1 - 0.9**t)) / (np.sqrt(second_moment / (1 - 0.999**t)) + 1e-8)
        model = LineModel(theta[:width], theta[width : width + 4].reshape(2, 2), theta[width + 4 :])
        for i, (f, b) in enumerate(pieces):
            if b:
                labels[i, : len(f)] = decode(f @ model.weights, model)
        if not labels.any():
            break
    return model


def train_quality(docs: DataFrame, labels: DataFrame, *, rows_per_class: int = 2000, bad_lines: int = 8_000, good_lines: int = 32_000) -> LineModel:
    """Fit the field to whole labelled texts: at most ``rows_per_class`` of either quality, those of the smallest hashes.

    Of each quality, texts are used until their lines exceed ``bad_lines`` or ``good_lines``; good ones prevail,
    as they do among documents. Of rows with one doc_id and label one text is used; a text of more lines than the limit is passed over. Features are taken where the rows are; only they reach the driver. Rows without a label or text are left out; without both kinds of labels every line
    is content.
    """
    draw = F.xxhash64(F.lit(3), "doc_id")
    known = labels.select("doc_id", "quality").where("quality in (0, 1)").distinct()
    chosen = [known.where(f"quality = {kind}").orderBy(draw, "doc_id").limit(rows_per_class) for kind in (0, 1)]

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [measure(text)[1] for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "features": [f.astype("<f8").tobytes() for f in found]})

    # the chosen ids are bounded, so each task may hold them all
    picked = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    found = picked.mapInPandas(features, "doc_id long, quality int, features binary")
    # of rows with one doc_id and label, one text
    one = settle(found.groupBy("doc_id", "quality").agg(F.min("features").alias("features")), "labelled-lines")
    sizes = one.select("doc_id", "quality", (F.length("features") / (8 * len(FEATURES))).cast("int").alias("n")).collect()
    kept: dict[int, list[int]] = {0: [], 1: []}
    most = {0: bad_lines, 1: good_lines}
    left = dict(most)
    for row in sorted(sizes, key=lambda r: (r["quality"], hash_order(r["doc_id"]))):
        if 0 < row["n"] <= most[row["quality"]] and left[row["quality"]] > 0:
            kept[row["quality"]].append(row["doc_id"])
            left[row["quality"]] -= row["n"]
    wanted = [F.col("doc_id").isin(kept[kind]) & (F.col("quality") == kind) for kind in (0, 1)]
    rows = one.where(wanted[0] | wanted[1]).collect()
    texts, bad = [], []
    for row in sorted(rows, key=lambda r: (r["quality"], hash_order(r["doc_id"]))):
        texts.append(np.frombuffer(bytes(row["features"]), dtype="<f8").reshape(-1, len(FEATURES)))
        bad.append(row["quality"] == 0)
    return fit_lines(texts, bad)


def hash_order(value: int) -> int:
    """A fixed scattered order of ids on the driver."""
    return value * 0x9E3779B97F4A7C15 & (1 << 64) - 1


def judge_quality(docs: DataFrame, model: LineModel) -> DataFrame:
    """doc_id and the verdict on each document's whole text; other columns are ignored, repeated rows stay repeated.

    Null and empty texts have no words and fail the base rules; a null doc_id stays; no rows give no rows.
    """
    return docs.select("doc_id", quality_verdict(F.col("text"), model).alias("v")).select("doc_id", "v.*")


def good_documents(docs: DataFrame, model: LineModel) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    return docs.where(quality_verdict(docs["text"], model)["kept"])
