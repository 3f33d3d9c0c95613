"""Text quality by a factorisation machine.

Method
------
A document is a sparse vector x: hashed words (share of the document's distinct words per bucket), structure
statistics cut into steps, and metadata (the stored number of characters, cut into steps, and whether it
agrees with the text). The score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

whose second part holds all pairwise interactions in time linear in the features. Weights are fitted by Adam
on a bounded sample of labelled rows; scoring runs over whole texts in Arrow batches, on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled, map_arrow
from tidemark.llm.words import LOWER, SPACE, PrefixHash, Run, runs, shingles

BUCKETS = 2048
STEPS = 10
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?.,;:")] = True
_BANG = np.zeros(256, bool)
_BANG[list(b"!")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NEWLINE = np.zeros(256, bool)
_NEWLINE[10] = True

#: Statistic and the largest value that its steps tell apart; steps are even in the square root.
STATISTICS = (
    ("upper", 1.0),
    ("symbols", 0.5),
    ("marks", 0.3),
    ("bangs", 0.3),
    ("digits", 0.3),
    ("letters", 1.0),
    ("distinct_words", 1.0),
    ("distinct_pairs", 1.0),
    ("adjacent_repeats", 1.0),
    ("distinct_lines", 1.0),
    ("word_length", 20.0),
    ("line_words", 100.0),
    ("words", 4000.0),
)
#: After the statistics: stored length in steps, whether it is missing, whether it disagrees with the text.
META = STEPS + 2
SIZE = BUCKETS + len(STATISTICS) * STEPS + META


def _distinct(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys per text: the keys, their text, how many each text has."""
    n = len(first) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    return keys[new], text[new], np.bincount(text[new], minlength=n)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def features(run: Run, stored: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows as (text, feature, value), ordered by text. ``stored``: the table's own length, NaN for null."""
    n, data = run.n, run.data
    size = np.maximum(np.diff(run.offsets), 1)
    starts, ends, first = run.spans(~SPACE[data])
    words = PrefixHash(LOWER[data]).of(starts, ends)
    n_words = np.diff(first)
    some = np.maximum(n_words, 1)
    keys, text, distinct = _distinct(words, first)
    pair_first = np.minimum(first, max(len(words) - 1, 0))
    pairs = shingles(words, 2)
    inner = np.ones(len(pairs), bool)
    inner[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(words))] - 1] = False
    pair_count = _per_text(inner, pair_first)
    bounds = np.r_[0, np.cumsum(pair_count)]
    _, _, distinct_pairs = _distinct(pairs[inner], bounds)
    same = (words[1:] == words[:-1]) & inner if len(words) > 1 else np.zeros(0, bool)
    line_starts, line_ends, line_first = run.spans(data != 10)
    _, _, distinct_lines = _distinct(PrefixHash(data).of(line_starts, line_ends), line_first)
    lines = np.maximum(np.diff(line_first), 1)
    chars = _per_text((data & 0xC0) != 0x80, run.offsets)
    share = [_per_text(x[data], run.offsets) / size for x in (_UPPER, _SYMBOL, _MARK, _BANG, _DIGIT, _LETTER)]
    statistics = [
        *share,
        distinct / some,
        distinct_pairs / np.maximum(pair_count, 1),
        _per_text(same, pair_first) / some,
        distinct_lines / lines,
        chars / some,
        n_words / lines,
        n_words,
    ]
    dense = []
    for k, ((_, top), value) in enumerate(zip(STATISTICS, statistics, strict=True)):
        step = np.minimum(np.sqrt(np.clip(value / top, 0, 1)) * STEPS, STEPS - 1).astype(np.int64)
        dense.append(BUCKETS + k * STEPS + step)
    base = BUCKETS + len(STATISTICS) * STEPS
    known = ~np.isnan(stored)
    step = np.minimum(np.log2(1 + np.maximum(np.where(known, stored, 0), 0)) / 2, STEPS - 1).astype(np.int64)
    dense.append(np.where(known, base + step, base + STEPS))
    dense.append(np.where(known & (stored != chars), base + STEPS + 1, -1))
    dense = np.stack(dense, axis=1)
    # a word's weight is its share of the distinct words, scaled to a norm of about one
    rows = np.r_[text, np.repeat(np.arange(n), dense.shape[1])]
    cols = np.r_[(keys % np.uint64(BUCKETS)).astype(np.int64), dense.ravel()]
    values = np.r_[(1 / np.sqrt(np.maximum(distinct, 1)))[text], np.full(dense.size, 0.5)]
    ok = cols >= 0
    order = np.argsort(rows[ok], kind="stable")
    return rows[ok][order], cols[ok][order], values[ok][order].astype(np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, n: int, rows: np.ndarray, cols: np.ndarray, values: np.ndarray) -> np.ndarray:
        linear = np.bincount(rows, self.weights[cols] * values, n)
        out = self.bias + linear
        for f in range(self.factors.shape[1]):
            z = self.factors[cols, f] * values
            out += 0.5 * (np.bincount(rows, z, n) ** 2 - np.bincount(rows, z * z, n))
        return out

    def probabilities(self, *sparse) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(*sparse), -30, 30)))


def fit(documents: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 6, epochs: int = 8, least_steps: int = 500, batch: int = 64, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> FactorisationMachine:
    """Adam on the logistic loss, ``epochs`` times over the rows or more, so that few rows give ``least_steps``. ``documents``: (features, values) per row."""
    rng = np.random.default_rng(seed)
    prior = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    # column 0 holds w, the others v
    theta = np.c_[np.zeros(SIZE), rng.normal(0, 0.05, (SIZE, rank))]
    bias = np.log(prior / (1 - prior))
    m, s, steps = np.zeros_like(theta), np.zeros_like(theta), 0
    epochs = max(epochs, -(-least_steps * batch // max(len(documents), 1)))
    for _ in range(epochs if len(set(labels.tolist())) > 1 else 0):
        order = rng.permutation(len(documents))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            cols = np.concatenate([documents[i][0] for i in chosen])
            values = np.concatenate([documents[i][1] for i in chosen]).astype(np.float64)
            rows = np.repeat(np.arange(len(chosen)), [len(documents[i][0]) for i in chosen])
            bounds = np.searchsorted(rows, np.arange(len(chosen)))
            v = theta[cols, 1:]
            xv = v * values[:, None]
            total = np.add.reduceat(xv, bounds, axis=0)
            margin = bias + np.bincount(rows, theta[cols, 0] * values, len(chosen)) + 0.5 * (total**2 - np.add.reduceat(xv**2, bounds, axis=0)).sum(axis=1)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[chosen]) / len(chosen)
            bias -= rate * error.sum()
            e = (error[rows] * values)[:, None]
            touched, place = np.unique(cols, return_inverse=True)
            grad = np.zeros((len(touched), rank + 1))
            np.add.at(grad, place, np.c_[e, e * (total[rows] - xv)])
            grad += decay * theta[touched]
            steps += 1
            m[touched] = 0.9 * m[touched] + 0.1 * grad
            s[touched] = 0.99 * s[touched] + 0.01 * grad**2
            theta[touched] -= rate * (m[touched] / (1 - 0.9**steps)) / (np.sqrt(s[touched] / (1 - 0.99**steps)) + 1e-6)
    return FactorisationMachine(float(bias), theta[:, 0].astype(np.float32), theta[:, 1:].astype(np.float32))


def _stored(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).astype(np.float64)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", rows: int = 4000) -> FactorisationMachine:
    """Fit on at most ``rows`` labelled rows outside the held-out fold; only their features reach the driver."""
    length = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")
    sample = labelled(docs, labels, label, id_col, {"text": F.col(text_col), "length": length}, rows).where("text is not null")

    def of(batch: pa.RecordBatch):
        y, stored = batch.column(0).to_pylist(), _stored(batch, 2)
        for run in runs(batch.column(1)):
            r, c, v = features(run, stored[run.first : run.first + run.n])
            cut = np.searchsorted(r, np.arange(run.n + 1))
            yield pa.record_batch(
                [
                    pa.array(y[run.first : run.first + run.n], pa.int32()),
                    pa.array([c[a:b].astype(np.int16).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    pa.array([v[a:b].astype(np.float32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                ],
                names=["y", "features", "values"],
            )

    # in an order of their own, so that the fit does not depend on how rows arrive
    got = map_arrow(sample, of, "y int, features binary, values binary").sort(F.crc32("features"), F.crc32("values"), "y").collect()
    documents = [(np.frombuffer(r.features, np.int16).astype(np.int64), np.frombuffer(r["values"], np.float32)) for r in got]
    return fit(documents, np.array([r.y for r in got], np.float64))


def score_quality(docs: DataFrame, model: FactorisationMachine, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.3) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    Null, empty and blank texts are scored like any other, from their statistics (0 words), and so below
    the threshold: they are given score 0. A null id is kept and not held out. Repeated rows are scored each.
    Further columns are ignored; an empty table gives no rows. ``length_col`` None: no metadata.
    """
    length = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        stored = _stored(batch, 2)
        scores = [np.zeros(0)]
        for run in runs(batch.column(1)):
            sparse = features(run, stored[run.first : run.first + run.n])
            has_word = np.diff(run.spans(~SPACE[run.data])[2]) > 0
            scores.append(np.where(has_word, model.probabilities(run.n, *sparse), 0.0))
        return pa.record_batch([batch.column(0), pa.array(np.concatenate(scores), pa.float64())], names=["id", "score"])

    scored = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), length.alias("length")), of, f"id {docs.schema[id_col].dataType.simpleString()}, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
