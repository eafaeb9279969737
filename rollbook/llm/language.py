"""Language ID by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions, gives every byte a distribution over the languages, and
the mean over all bytes of a text is the text's. It is trained in numpy by backpropagation through time, with windows of
a bounded sample of labelled rows: about ``DOCS_PER_LANG`` documents of each language, chosen by a digest of their
ids, ``WINDOWS_PER_DOC`` windows each. Only these windows reach the driver.

Prediction reads whole texts where they are, a few hundred kilobytes at a time. Nothing is shuffled for it, so
hot sources and long texts cost what their bytes cost.

Defined results: ``UNKNOWN`` with score 0 for null texts, texts without a letter, and if there is nothing to learn from;
rows that repeat are judged alike; rows with a null id are held out; an empty table gives an empty result. Input
columns are passed on, those called like a result column are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.llm.common import text_of
from rollbook.llm.words import pieces

UNKNOWN = "und"
WINDOW, HIDDEN = 64, 8
DOCS_PER_LANG, WINDOWS_PER_DOC = 250, 6
EPOCHS, BATCH, RATE = 14, 256, 0.01
#: Windows that are read side by side when predicting.
SIDE = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.multiply(x, 0.5, out=x)
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Network:
    """Input weights (one row per byte), recurrent weights and output weights; gates are update, reset, candidate."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 11):
        random = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        scaled = lambda *shape: (random.standard_normal(shape) * 0.3).astype(np.float32)
        self.weights = {
            name: scaled(*shape) for name, shape in
            {"in0": (256, 3 * hidden), "in1": (256, 3 * hidden), "re0": (hidden, 3 * hidden), "re1": (hidden, 3 * hidden), "out": (2 * hidden, len(labels)), "bias": (1, len(labels))}.items()
        }

    def _step(self, side: int, state: np.ndarray, read: np.ndarray):
        h = self.hidden
        given, own = self.weights[f"in{side}"][read], state @ self.weights[f"re{side}"]
        gates = _sigmoid(given[:, : 2 * h] + own[:, : 2 * h])
        candidate = np.tanh(given[:, 2 * h :] + gates[:, h:] * own[:, 2 * h :])
        return candidate + gates[:, :h] * (state - candidate), gates, candidate, own[:, 2 * h :]

    def _order(self, side: int, length: int):
        return range(length) if side == 0 else range(length - 1, -1, -1)

    def labelled(self, read: np.ndarray) -> np.ndarray:
        """Distribution over the labels for every position: (positions, windows) bytes give (labels, positions, windows)."""
        length, count = read.shape
        logits = np.empty((len(self.labels), length, count), np.float32)
        for side in (0, 1):
            out = np.ascontiguousarray(self.weights["out"][side * self.hidden : (side + 1) * self.hidden].T)
            state = np.zeros((count, self.hidden), np.float32)
            for t in self._order(side, length):
                state = self._step(side, state, read[t])[0]
                if side == 0:
                    logits[:, t] = out @ state.T
                else:
                    logits[:, t] += out @ state.T
        logits += self.weights["bias"].T[:, :, None]
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits

    def gradients(self, read: np.ndarray, inside: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over all positions that are ``inside``."""
        length, count = read.shape
        h, kept = self.hidden, {}
        states = np.zeros((2, length, count, h), np.float32)
        for side in (0, 1):
            state = np.zeros((count, h), np.float32)
            for t in self._order(side, length):
                before = state
                state, gates, candidate, own = self._step(side, state, read[t])
                kept[side, t] = before, gates, candidate, own
                states[side, t] = state
        both = np.concatenate([states[0], states[1]], axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        wrong = np.exp(logits - logits.max(axis=2, keepdims=True))
        wrong /= wrong.sum(axis=2, keepdims=True)
        wrong[:, np.arange(count), label] -= 1
        wrong *= (inside / max(inside.sum(), 1)).astype(np.float32)[:, :, None]
        flat = wrong.reshape(-1, wrong.shape[2])
        out = {"out": both.reshape(-1, 2 * h).T @ flat, "bias": flat.sum(axis=0, keepdims=True)}
        back = wrong @ self.weights["out"].T
        bytes_read = read.ravel()
        order = np.argsort(bytes_read, kind="stable")
        values, starts = np.unique(bytes_read[order], return_index=True)
        for side in (0, 1):
            recurrent = self.weights[f"re{side}"]
            to_re, to_in, ahead = np.zeros_like(recurrent), np.empty((length, count, 3 * h), np.float32), np.zeros((count, h), np.float32)
            for t in reversed(self._order(side, length)):
                before, gates, candidate, own = kept[side, t]
                d = back[t, :, side * h : (side + 1) * h] + ahead
                update, reset = gates[:, :h], gates[:, h:]
                d_candidate = d * (1 - update) * (1 - candidate**2)
                d_gates = np.concatenate([d * (before - candidate) * update * (1 - update), d_candidate * own * reset * (1 - reset)], axis=1)
                d_own = np.concatenate([d_gates, d_candidate * reset], axis=1)
                ahead = d * update + d_own @ recurrent.T
                to_re += before.T @ d_own
                to_in[t, :, : 2 * h], to_in[t, :, 2 * h :] = d_gates, d_candidate
            out[f"re{side}"], out[f"in{side}"] = to_re, np.zeros_like(self.weights[f"in{side}"])
            out[f"in{side}"][values] = np.add.reduceat(to_in.reshape(-1, 3 * h)[order], starts)
        return out

    def train(self, read: np.ndarray, inside: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Network:
        """Adam over shuffled batches; ``read`` is (positions, windows)."""
        random, step = np.random.default_rng(seed), 0
        mean = {k: np.zeros_like(w) for k, w in self.weights.items()}
        square = {k: np.zeros_like(w) for k, w in self.weights.items()}
        for epoch in range(epochs):
            order = random.permutation(len(label))
            rate = RATE * (1 - epoch / epochs) + 1e-4
            for start in range(0, len(order), BATCH):
                at, step = order[start : start + BATCH], step + 1
                for k, g in self.gradients(read[:, at], inside[:, at], label[at]).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    self.weights[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def pooled(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean distribution of each text, and how many of its positions have each label."""
        sizes = np.diff(offsets)
        n = -(-sizes // WINDOW)
        of = np.repeat(np.arange(len(sizes)), n)
        first = offsets[:-1][of] + (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * WINDOW
        used = np.minimum(WINDOW, offsets[1:][of] - first)
        sums, counts = np.zeros((len(sizes), len(self.labels))), np.zeros((len(sizes), len(self.labels)), np.int64)
        position = np.arange(WINDOW)[:, None]
        for start in range(0, len(of), SIDE):
            part = slice(start, start + SIDE)
            inside = position < used[part]
            read = np.where(inside, data[np.minimum(first[part] + position, len(data) - 1)], 0)
            odds = self.labelled(read)
            best = odds.max(axis=0)
            for k, own in enumerate(odds):
                np.add.at(sums[:, k], of[part], (own * inside).sum(axis=0))
                np.add.at(counts[:, k], of[part], ((own == best) & inside).sum(axis=0))
        return sums / np.maximum(sizes, 1)[:, None], counts


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sample_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, docs_per_lang: int = DOCS_PER_LANG) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(windows, their lengths, their labels) of the sample; windows lie evenly over each text."""
    share = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 8), 16, 10).cast("double") / 2**32
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), text_of(text_col).cast("binary").alias("text"), share.alias("share"))
    rows = rows.filter(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    chosen = F.lit(False)
    for r in sorted(rows.groupBy("lang").count().collect(), key=lambda r: r.lang):  # one row per language
        chosen = chosen | ((F.col("lang") == r.lang) & (F.col("share") * r["count"] <= docs_per_lang))
    gap = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS_PER_DOC - 1)), lambda k: F.substring(F.col("text"), (gap * k / (WINDOWS_PER_DOC - 1)).cast("int") + 1, F.lit(WINDOW)))
    found = sorted((r.lang, bytes(w)) for r in rows.filter(chosen).select("lang", F.array_distinct(cut).alias("cut")).collect() for w in r.cut)
    windows = np.zeros((len(found), WINDOW), np.uint8)
    for k, (_, w) in enumerate(found):
        windows[k, : len(w)] = np.frombuffer(w, np.uint8)
    return windows, np.array([len(w) for _, w in found], np.int64), [lang for lang, _ in found]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> Network | None:
    """A network trained on a sample of the labelled rows; None if there are none."""
    windows, lengths, langs = sample_windows(docs, id_col, text_col, lang_col)
    if not langs:
        return None
    labels = sorted(set(langs))
    inside = np.arange(WINDOW)[:, None] < lengths
    return Network(labels).train(np.ascontiguousarray(windows.T), inside, np.array([labels.index(x) for x in langs]), **how)


def predict(docs: DataFrame, network: Network | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, and position_share: the share of positions that have that label."""
    result = ("lang_pred", "score", "position_share")
    kept = [f for f in docs.schema.fields if f.name not in result]
    width = len(kept)
    text = F.when(F.col(text_col).rlike(r"\p{L}"), text_of(text_col)).otherwise("")
    df = docs.select(*[F.col(f"`{f.name}`") for f in kept], text.alias("__text"))
    schema = T.StructType([*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("position_share", T.DoubleType())])

    def run(batches):
        for batch in batches:
            langs, scores, shares = [], [], []
            for first, last, data, offsets in pieces(batch.column(width), SIDE * WINDOW):
                if network is None or not len(data):
                    langs += [UNKNOWN] * (last - first)
                    scores += [0.0] * (last - first)
                    shares += [0.0] * (last - first)
                    continue
                odds, counts = network.pooled(data, offsets)
                best, sizes = odds.argmax(axis=1), np.diff(offsets)
                for k, b in enumerate(best):
                    known = sizes[k] > 0
                    langs.append(network.labels[b] if known else UNKNOWN)
                    scores.append(min(1.0, float(odds[k, b])) if known else 0.0)
                    shares.append(float(counts[k, b] / sizes[k]) if known else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())], names=schema.names)

    return df.mapInArrow(run, schema)
