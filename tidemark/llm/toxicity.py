"""Operator 4: toxicity scores from a bidirectional gated recurrent network over words and their characters."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle

PAD = 0


@dataclass(frozen=True)
class Shape:
    """Sizes of the network; a window is ``window`` words long and begins ``stride`` words after the one before."""

    word_buckets: int = 1 << 13
    char_buckets: int = 1 << 14
    width: int = 8
    hidden: int = 8
    window: int = 32
    stride: int = 16


class Words:
    """Numbers for words (0 is padding) with their two kinds of input: a bucket of the word, buckets of its character runs.

    Lower case; a word is what white space separates, its edges without signs count only for the inputs.
    """

    def __init__(self, shape: Shape):
        self.shape, self.ids, self.fresh = shape, {}, []

    def number(self, words: list[str]) -> np.ndarray:
        ids, known = self.ids, self.ids.get
        found = list(map(known, words))
        if None in found:
            for i, number in enumerate(found):
                if number is None:
                    word = words[i]
                    if word not in ids:
                        ids[word] = len(ids) + 1
                        self.fresh.append(word)
                    found[i] = ids[word]
        return np.array(found, dtype=np.int32)

    @staticmethod
    def split(text: str) -> list[str]:
        return text.lower().split()

    def inputs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the words numbered since the last call: word buckets, all character buckets, where each word's begin."""
        bare = [w.strip(".,;:!?()[]{}\"'#*$%&|<>-_/") for w in self.fresh]
        self.fresh = []
        buckets = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % self.shape.word_buckets for w in bare], dtype=np.int64)
        letters = np.frombuffer("".join(f"\x02{w}\x03" for w in bare).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        lengths = np.array([len(w) + 2 for w in bare], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, dtype=np.int64)
        # a run of n letters begins at each letter that has n - 1 more in its word; runs of 4 and 5 letters
        left = np.repeat(starts + lengths, lengths) - np.arange(len(letters))
        runs, owners = [], []
        owner = np.repeat(np.arange(len(bare)), lengths)
        code = letters.copy()
        for n in range(2, 6):
            code = code[: len(letters) - n + 1] * np.uint64(1_000_003) + letters[n - 1 :]
            if n > 3:
                inside = left[: len(code)] >= n
                mixed = (code ^ code >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
                runs.append((mixed[inside] % np.uint64(self.shape.char_buckets)).astype(np.int64))
                owners.append(owner[: len(code)][inside])
        runs, owners = np.concatenate(runs), np.concatenate(owners)
        order = np.argsort(owners, kind="stable")
        counts = np.bincount(owners, minlength=len(bare))
        return buckets, runs[order], counts


def new_weights(shape: Shape, seed: int) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    d, h = 2 * shape.width, shape.hidden
    scale = lambda *size, by: (draw.standard_normal(size) * by).astype(np.float32)
    return {
        "word": scale(shape.word_buckets, shape.width, by=0.3), "char": scale(shape.char_buckets, shape.width, by=0.3),
        "input": scale(d, 6 * h, by=1 / np.sqrt(d)), "bias": np.zeros(6 * h, dtype=np.float32), "state": scale(2, h, 3 * h, by=1 / np.sqrt(h)),
        "attend": scale(2 * h, by=0.5), "out": scale(2 * h, by=0.5), "offset": np.full(1, -1.0, dtype=np.float32),
    }


def word_inputs(weights: dict, buckets: np.ndarray, runs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Word embedding beside the mean embedding of the word's character runs."""
    mean = np.zeros((len(counts), weights["char"].shape[1]), dtype=np.float32)
    some = counts > 0
    if some.any():
        mean[some] = np.add.reduceat(weights["char"][runs], (np.cumsum(counts) - counts)[some], axis=0) / counts[some, None]
    return np.concatenate([weights["word"][buckets], mean * 2], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def forward(weights: dict, projected: np.ndarray, ids: np.ndarray, keep: bool = False):
    """Logits of windows of word numbers, (windows, words), whose inputs are projected (a row per number, row 0 padding)."""
    n, length = ids.shape
    h = weights["state"].shape[1]
    states = np.empty((length, n, 2 * h), dtype=np.float32)
    saved = []
    for side in (0, 1):
        rows, mix = projected[:, side * 3 * h : (side + 1) * 3 * h], weights["state"][side]
        state = np.zeros((n, h), dtype=np.float32)
        for t in range(length) if side == 0 else range(length - 1, -1, -1):
            now = ids[:, t]
            given, past = rows[now], state @ mix
            gates = given[:, : 2 * h] + past[:, : 2 * h]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            update, reset = gates[:, :h], gates[:, h:]
            fresh = np.tanh(given[:, 2 * h :] + reset * past[:, 2 * h :])
            fresh_gap = fresh - state
            # padding leaves the state as it is
            moved = update * (now != PAD)[:, None]
            if keep:
                saved.append((side, t, state, update, reset, fresh, past[:, 2 * h :], now))
            state = state + moved * fresh_gap
            states[t, :, side * h : (side + 1) * h] = state
    real = (ids != PAD).T
    energy = np.where(real, states @ weights["attend"], -1e9)
    energy -= energy.max(axis=0)
    share = np.exp(energy) * real
    share /= np.maximum(share.sum(axis=0), 1e-9)
    pooled = np.einsum("tn,tnk->nk", share, states)
    logits = pooled @ weights["out"] + weights["offset"][0]
    return (logits, (states, share, pooled, saved)) if keep else logits


def backward(weights: dict, projected: np.ndarray, ids: np.ndarray, kept: tuple, slope: np.ndarray):
    """Gradients of sum(slope * logits): of the projected rows and of the weights above them."""
    states, share, pooled, saved = kept
    h = weights["state"].shape[1]
    grads = {"out": pooled.T @ slope, "offset": np.array([slope.sum()], dtype=np.float32), "state": np.zeros_like(weights["state"])}
    d_pooled = slope[:, None] * weights["out"]
    d_share = np.einsum("tnk,nk->tn", states, d_pooled)
    d_energy = share * (d_share - (share * d_share).sum(axis=0))
    grads["attend"] = np.einsum("tn,tnk->k", d_energy, states)
    d_states = share[:, :, None] * d_pooled + d_energy[:, :, None] * weights["attend"]
    rows, numbers, d_state, last = [], [], None, None
    for side, t, state, update, reset, fresh, past, now in reversed(saved):
        mix = weights["state"][side]
        if side != last:
            d_state, last = np.zeros_like(state), side
        d_state = d_state + d_states[t, :, side * h : (side + 1) * h]
        real = (now != PAD)[:, None]
        d_fresh = d_state * update * real * (1 - fresh**2)
        d_update = d_state * (fresh - state) * real * update * (1 - update)
        d_reset = d_fresh * past * reset * (1 - reset)
        d_past = np.concatenate([d_update, d_reset, d_fresh * reset], axis=1)
        grads["state"][side] += state.T @ d_past
        part = np.zeros((len(now), 6 * h), dtype=np.float32)
        part[:, side * 3 * h : (side + 1) * 3 * h] = np.concatenate([d_update, d_reset, d_fresh], axis=1)
        rows.append(part)
        numbers.append(now)
        d_state = d_state * (1 - update * real) + d_past @ mix.T
    rows, numbers = np.concatenate(rows), np.concatenate(numbers)
    order = np.argsort(numbers, kind="stable")
    used, begins = np.unique(numbers[order], return_index=True)
    return used, np.add.reduceat(rows[order], begins, axis=0), grads


def windows(numbers: np.ndarray, shape: Shape) -> np.ndarray:
    """All overlapping windows of a text's word numbers; the last is padded, a text without words is one empty window."""
    n = max(1, -(-(len(numbers) - shape.window) // shape.stride) + 1)
    padded = np.zeros((n - 1) * shape.stride + shape.window, dtype=np.int32)
    padded[: len(numbers)] = numbers
    return np.lib.stride_tricks.sliding_window_view(padded, shape.window)[:: shape.stride]


def summed(rows: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the values by row number, for n rows."""
    return np.stack([np.bincount(rows, values[:, k], n) for k in range(values.shape[1])], axis=1).astype(np.float32)


class Trainer:
    """Adam on the network's weights; a text is as toxic as its most toxic window."""

    def __init__(self, texts: Sequence[str], shape: Shape, seed: int):
        self.shape, self.weights = shape, new_weights(shape, seed)
        words = Words(shape)
        self.windows = [windows(words.number(words.split(text)), shape) for text in texts]
        self.buckets, self.runs, self.counts = words.inputs()
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.moments = {name: (np.zeros_like(w), np.zeros_like(w)) for name, w in self.weights.items()}
        self.steps = 0

    def project(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows for the given word numbers after a padding row, with what the backward pass needs."""
        words = numbers - 1
        counts = self.counts[words]
        begins = np.repeat(self.starts[words] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        runs = self.runs[begins + np.arange(counts.sum())]
        inputs = word_inputs(self.weights, self.buckets[words], runs, counts)
        rows = inputs @ self.weights["input"] + self.weights["bias"]
        return np.concatenate([np.zeros((1, rows.shape[1]), dtype=np.float32), rows.astype(np.float32)]), inputs, runs, counts

    def step(self, chosen: Sequence[int], labels: np.ndarray, top: int, sharp: float, rate: float) -> None:
        """One step on some texts: slopes go to each text's ``top`` most toxic windows, by their softmax."""
        ids = np.concatenate([self.windows[i] for i in chosen])
        owner = np.repeat(np.arange(len(chosen)), [len(self.windows[i]) for i in chosen])
        numbers, local = np.unique(ids, return_inverse=True)
        local = local.reshape(ids.shape)
        if numbers[0] != PAD:
            numbers, local = np.concatenate([[PAD], numbers]), local + 1
        projected, inputs, runs, counts = self.project(numbers[1:])
        logits = forward(self.weights, projected, local)
        order = np.lexsort((-logits, owner))
        first = np.searchsorted(owner, np.arange(len(chosen)))
        place = np.arange(len(owner)) - first[owner]
        picked = order[place < top]
        logits, kept = forward(self.weights, projected, local[picked], keep=True)
        owner = owner[picked]
        peak = np.full(len(chosen), -np.inf)
        np.maximum.at(peak, owner, logits)
        share = np.exp(sharp * (logits - peak[owner]))
        share /= np.bincount(owner, share, len(chosen))[owner]
        slope = ((sigmoid(peak) - labels[chosen])[owner] * share / len(chosen)).astype(np.float32)
        used, d_rows, grads = backward(self.weights, projected, local[picked], kept, slope)
        d_rows, used = d_rows[used != PAD], used[used != PAD] - 1
        grads["input"], grads["bias"] = inputs[used].T @ d_rows, d_rows.sum(axis=0)
        d_inputs = np.zeros_like(inputs)
        d_inputs[used] = d_rows @ self.weights["input"].T
        width = self.shape.width
        active = np.zeros(len(inputs), dtype=bool)
        active[used] = True
        shares = (d_inputs[:, width:] * (2 / np.maximum(counts, 1))[:, None])[active]
        runs, counts = runs[np.repeat(active, counts)], counts[active]
        grads["word"] = summed(self.buckets[numbers[1:] - 1][active], d_inputs[active, :width], self.shape.word_buckets)
        grads["char"] = summed(runs, np.repeat(shares, counts, axis=0), self.shape.char_buckets)
        self.steps += 1
        for name, gradient in grads.items():
            first_moment, second_moment = self.moments[name]
            first_moment += 0.1 * (gradient - first_moment)
            second_moment += 0.01 * (gradient**2 - second_moment)
            scale = rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
            self.weights[name] -= (scale * first_moment / (np.sqrt(second_moment) + 1e-7)).astype(np.float32)


def train(texts: Sequence[str], toxic: Sequence[bool], shape: Shape = Shape(), *, steps: int = 240, batch: int = 48, rate: float = 0.01, seed: int = 1) -> dict[str, np.ndarray]:
    """Fit the network: a third of the steps on the shorter half of the texts, where toxic words are found soonest, then on all."""
    labels = np.array(toxic, dtype=np.float32)
    trainer = Trainer(texts, shape, seed)
    if labels.all() or not labels.any():
        trainer.weights["offset"][0] = 4.0 if len(labels) and labels.all() else -4.0
        trainer.weights["out"][:] = 0
        return trainer.weights
    sizes = np.array([len(w) for w in trainer.windows])
    draw = np.random.default_rng(seed)
    short, every = np.flatnonzero(sizes <= np.median(sizes)), np.arange(len(texts))
    order: list[int] = []
    for step in range(steps):
        if not order or step == steps // 3:
            order = draw.permutation(short if step < steps // 3 else every).tolist()
        chosen, order = order[:batch], order[batch:]
        if step < steps // 3:
            trainer.step(chosen, labels, 8, 1.0, rate)
        else:
            # the rate falls to a third towards the end
            trainer.step(chosen, labels, 3, 2.0, rate / (1 + 3 * (step - steps // 3) / steps))
    return trainer.weights


class Scorer:
    """Scores whole texts: the highest probability of any of their windows.

    A text is read in stretches of ``stretch`` words, a multiple of the stride, and inputs are held of at most
    ``held`` words and one stretch, however many different words a text has.
    """

    def __init__(self, weights: dict[str, np.ndarray], shape: Shape, held: int = 150_000, stretch: int = 1 << 16):
        self.weights, self.shape, self.held, self.stretch = weights, shape, held, stretch - stretch % shape.stride
        self.forget()

    def forget(self) -> None:
        self.words, self.filled = Words(self.shape), 1
        self.projected = np.zeros((1 << 14, 6 * self.shape.hidden), dtype=np.float32)

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        ids, owners, pending = [], [], 0
        logits = np.full(len(texts), -np.inf)
        for i, text in enumerate(texts):
            words = self.words.split(text)
            for begin in range(0, max(1, len(words)), self.stretch):
                # windows of one stretch reach over its end, so a rest that they cover has none of its own
                if begin and len(words) - begin <= self.shape.window - self.shape.stride:
                    break
                part = words[begin : begin + self.stretch + self.shape.window - self.shape.stride]
                rows = windows(self.words.number(part), self.shape)
                ids.append(rows)
                owners.append(np.full(len(rows), i))
                pending += len(rows)
                full = len(self.words.ids) > self.held
                if pending >= 4096 or full:
                    self.run(np.concatenate(ids), np.concatenate(owners), logits)
                    ids, owners, pending = [], [], 0
                if full:
                    self.forget()
        if pending:
            self.run(np.concatenate(ids), np.concatenate(owners), logits)
        return sigmoid(logits)

    def run(self, ids: np.ndarray, owners: np.ndarray, logits: np.ndarray) -> None:
        if self.words.fresh:
            rows = (word_inputs(self.weights, *self.words.inputs()) @ self.weights["input"] + self.weights["bias"]).astype(np.float32)
            while self.filled + len(rows) > len(self.projected):
                self.projected = np.concatenate([self.projected, np.zeros_like(self.projected)])
            self.projected[self.filled : self.filled + len(rows)] = rows
            self.filled += len(rows)
        for i in range(0, len(ids), 2048):
            np.maximum.at(logits, owners[i : i + 2048], forward(self.weights, self.projected, ids[i : i + 2048]))


def toxicity(text: Column, weights: dict[str, np.ndarray], shape: Shape = Shape()) -> Column:
    """Score from 0 to 1 of each whole text; null counts as empty, and an empty text gets the network's score for no words."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(weights, shape)
        for texts in batches:
            yield pd.Series(scorer.scores([text or "" for text in texts]), dtype="float64")

    return score(text)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train_toxicity(docs: DataFrame, labels: DataFrame, *, toxic_rows: int = 1000, clean_rows: int = 1500, chars: int = 1 << 26, shape: Shape = Shape(), seed: int = 1) -> dict[str, np.ndarray]:
    """Fit the network to whole labelled texts that aren't held out, at most so many of each kind, of the smallest hashes.

    Only text and label are used. Of rows with one doc_id and label the text of the smallest hash is taken; texts that
    would bring the chosen ones over ``chars`` characters are passed over. Rows without text or label are left out; of
    one kind alone, or without rows, every score says clean or toxic alike; other columns are ignored.
    """
    known = labels.select("doc_id", "toxic").where("toxic in (0, 1)").distinct().where(~held_out(F.col("doc_id")))
    draw = F.xxhash64(F.lit(4), "doc_id")
    chosen = [known.where(f"toxic = {kind}").orderBy(draw, "doc_id").limit(rows) for kind, rows in ((1, toxic_rows), (0, clean_rows))]
    # the chosen rows are bounded
    picked = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
    one = picked.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), F.col("text").alias("text"))).alias("t"))
    one = settle(one.select("doc_id", "toxic", "t.text", draw.alias("draw")), "labelled")
    kept, left = [], chars
    for row in one.select("doc_id", "toxic", F.length("text").alias("n")).orderBy("draw", "doc_id", "toxic").collect():
        if row["n"] <= left:
            left -= row["n"]
            kept.append((row["doc_id"], row["toxic"]))
    ids = [F.col("doc_id").isin([doc for doc, toxic in kept if toxic == kind]) & (F.col("toxic") == kind) for kind in (0, 1)]
    rows = sorted(one.where(ids[0] | ids[1]).collect(), key=lambda r: (r["doc_id"], r["text"], r["toxic"]))
    return train([r["text"] for r in rows], [r["toxic"] == 1 for r in rows], shape, seed=seed)


def score_documents(docs: DataFrame, weights: dict[str, np.ndarray], shape: Shape = Shape()) -> DataFrame:
    """doc_id, held_out, score and predicted per row; other columns are ignored, repeated rows stay repeated.

    Null text counts as empty; an empty text has the network's score for no words; a null doc_id isn't held out and stays; no rows give no rows.
    """
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxicity(F.col("text"), weights, shape).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def clean_documents(docs: DataFrame, weights: dict[str, np.ndarray], shape: Shape = Shape()) -> DataFrame:
    """The documents that aren't predicted toxic, with the columns of ``docs``, whatever their names; null text counts as empty, repeated rows stay, no rows give no rows."""
    return docs.where(toxicity(docs["text"], weights, shape) < 0.5)
