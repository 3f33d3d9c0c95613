"""Language of texts, and of spans of mixed texts, by script ranges and a Viterbi path over words.

Method
------
The script of a word's first letter narrows the candidates to the languages that training texts write in
it. A word's score for each candidate is the sum of log shares of its hashed byte 2- to 4-grams and of the
word itself, centred over the languages. Viterbi finds the best label sequence of the words with a
penalty for each switch. A text whose best single language is nowhere beaten by more than half the penalty over
any stretch of words has a constant best path, which is found without stepping; only the others are
stepped through, many texts at once. The text's language is the one that labels most of its letters.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, held_out, map_arrow
from tidemark.llm.words import LOWER, PrefixHash, Run, runs

BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
UNKNOWN = "und"
_RUN_BYTES = 1 << 19

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

#: First code points of Unicode ranges and the script they begin (fixed values of the Unicode blocks).
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "indic"),
    (0x0E00, "thai"),
    (0x0E80, "other"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "latin"),
    (0xFB13, "other"),
    (0x20000, "han"),
    (0x30000, "other"),
)
_BOUNDS = np.array([a for a, _ in SCRIPTS])
_NAMES = sorted({b for _, b in SCRIPTS})
_OF_RANGE = np.array([_NAMES.index(b) for _, b in SCRIPTS])


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals (two bytes, the first 0xC3) in lower case."""
    out = LOWER[data]
    if len(data) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][capital] += 0x20
    return out


def _scripts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Script of the character at each start."""
    if not len(starts):
        return np.zeros(0, np.int64)
    b = [data[np.minimum(starts + k, len(data) - 1)].astype(np.int64) & (0xFF if not k else 0x3F) for k in range(4)]
    point = np.where(b[0] < 0x80, b[0], np.where(b[0] < 0xE0, (b[0] & 0x1F) << 6 | b[1], np.where(b[0] < 0xF0, (b[0] & 0x0F) << 12 | b[1] << 6 | b[2], (b[0] & 7) << 18 | b[1] << 12 | b[2] << 6 | b[3])))
    return _OF_RANGE[np.searchsorted(_BOUNDS, point, "right") - 1]


def grams(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a run (starts, ends, first word of each text, script) and its grams (word, bucket)."""
    data = _lowered(run.data)
    starts, ends, first = run.spans(_LETTER[data])
    hashes = PrefixHash(data)
    length = ends - starts
    words, buckets = [np.arange(len(starts))], [hashes.of(starts, ends)]
    for n in ORDERS:
        count = np.maximum(length - n + 1, 0)
        word = np.repeat(np.arange(len(starts)), count)
        at = np.arange(len(word)) - np.repeat(np.cumsum(count) - count, count) + starts[word]
        words.append(word)
        buckets.append(hashes.of(at, at + n))
    return starts, ends, first, _scripts(data, starts), np.concatenate(words), (np.concatenate(buckets) % np.uint64(BUCKETS)).astype(np.int64)


@dataclass
class LanguageModel:
    """``weights``: bucket by language; ``allowed``: script by language."""

    languages: list[str]
    weights: np.ndarray
    allowed: np.ndarray
    penalty: float = 12.0

    def word_scores(self, words: np.ndarray, buckets: np.ndarray, scripts: np.ndarray) -> np.ndarray:
        n, k = len(scripts), len(self.languages)
        ok = self.allowed[scripts]
        none = ~ok.any(axis=1)
        out = np.full((n, k), -50.0)
        for j in range(k):
            # only words whose script the language uses
            mine = ok[:, j]
            if mine.all():
                out[:, j] = np.bincount(words, self.weights[buckets, j], n)
            elif mine.any():
                own = mine[words]
                out[mine, j] = np.bincount(words[own], self.weights[buckets[own], j], n)[mine]
        out[none] = 0.0  # a script that no training text uses says nothing
        return out


def _segment_excess(gain: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest sum of consecutive gains within each text; 0 if none is positive."""
    n = len(first) - 1
    top = np.zeros(n)
    if not len(gain):
        return top
    total = np.cumsum(gain)
    before = np.r_[0.0, total[:-1]]
    sizes = np.diff(first)
    text = np.repeat(np.arange(n), sizes)
    span = 1.0 + 2 * max(float(np.abs(total).max()), 1.0)
    least = np.minimum.accumulate(before - text * span) + text * span
    some = sizes > 0
    top[some] = np.maximum(np.maximum.reduceat(total - least, first[:-1][some]), 0)
    return top


def _viterbi(scores: np.ndarray, first: np.ndarray, chosen: np.ndarray, penalty: float) -> dict[int, np.ndarray]:
    """Best label path of the chosen texts, stepped through together, longest first."""
    order = chosen[np.argsort(-(first[chosen + 1] - first[chosen]), kind="stable")]
    base, length = first[order], first[order + 1] - first[order]
    steps, k = int(length[0]), scores.shape[1]
    back = np.zeros((int(length.sum()), k), np.int16)
    at = np.cumsum(length) - length
    value = scores[base].copy()
    stay = np.arange(k, dtype=np.int16)
    active = np.searchsorted(-length, -np.arange(steps), "left")  # texts with more than t words
    for t in range(1, steps):
        a = active[t]
        v = value[:a]
        best = v.argmax(axis=1)
        moved = v[np.arange(a), best] - penalty
        switch = moved[:, None] > v
        back[at[:a] + t] = np.where(switch, best[:, None], stay)
        value[:a] = np.where(switch, moved[:, None], v) + scores[base[:a] + t]
    label = value.argmax(axis=1)
    path = np.zeros(len(back), np.int16)
    for t in range(steps - 1, -1, -1):
        a = active[t]
        path[at[:a] + t] = label[:a]
        label[:a] = back[at[:a] + t, label[:a]]
    return {int(i): path[s : s + n] for i, s, n in zip(order, at, length, strict=True)}


def label_words(model: LanguageModel, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a run and the language index of each, -1 in a script that no training text uses."""
    starts, ends, first, scripts, words, buckets = grams(run)
    scores = model.word_scores(words, buckets, scripts)
    counts = np.diff(first)
    sums = np.zeros((run.n, scores.shape[1]))
    filled = np.flatnonzero(counts)
    if len(filled):
        sums[filled] = np.add.reduceat(scores, first[filled], axis=0)
    best = sums.argmax(axis=1)
    labels = np.repeat(best, counts)
    mine = scores[np.arange(len(labels)), labels]
    excess = np.zeros(run.n)
    for j in range(scores.shape[1]):
        excess = np.maximum(excess, _segment_excess(scores[:, j] - mine, first))
    # m stretches gain at most m times the excess and pay for m - 1 switches
    mixed = np.flatnonzero((2 * excess > model.penalty) & (counts > 1))
    if len(mixed):
        for i, path in _viterbi(scores, first, mixed, model.penalty).items():
            labels[first[i] : first[i + 1]] = path
    labels[_unlearned(model, run, starts, ends, scripts)] = -1
    return starts, ends, first, labels


def _unlearned(model: LanguageModel, run: Run, starts: np.ndarray, ends: np.ndarray, scripts: np.ndarray) -> np.ndarray:
    """Words whose first letter is of a script that no training text uses; marks and symbols are none."""
    known = model.allowed.any(axis=1)
    out = []
    for w in np.flatnonzero(~known[scripts]).tolist():
        letter = next((c for c in run.data[starts[w] : ends[w]].tobytes().decode("utf-8", "replace") if c.isalpha()), None)
        if letter is not None and not known[_OF_RANGE[np.searchsorted(_BOUNDS, ord(letter), "right") - 1]]:
            out.append(w)
    return np.array(out, np.int64)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 600, penalty: float = 12.0) -> LanguageModel:
    """Count grams over about ``per_language`` texts of each language, outside the held-out fold.

    The texts are those whose hash falls below the language's rate, so they are the same however the rows
    lie. Only counts by bucket reach the driver, ``BUCKETS`` rows a language at most.
    """
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = known.where("id is not null and text is not null and lang is not null").where(fold("id") != 0)
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((BUCKETS, 1)), np.ones((len(_NAMES), 1), bool), penalty)
    rate: Column = F.lit(1.0)
    for lang in languages:
        rate = F.when(F.col("lang") == lang, min(1.0, per_language / sizes[lang])).otherwise(rate)
    drawn = known.where(F.pmod(F.xxhash64("id", F.lit(23)), F.lit(1_000_000)) < rate * 1_000_000)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = {x: i for i, x in enumerate(languages)}
        of_text = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
        counts = np.zeros((len(languages), BUCKETS + len(_NAMES)))
        for run in runs(batch.column(1)):
            _, _, first, scripts, words, buckets = grams(run)
            mine = np.repeat(of_text[run.first : run.first + run.n], np.diff(first))
            width = counts.shape[1]
            counts += np.bincount(np.r_[mine[words] * width + buckets, mine * width + BUCKETS + scripts], minlength=counts.size).reshape(counts.shape)
        lang, bucket = np.nonzero(counts)
        return pa.record_batch([pa.array(lang, pa.int32()), pa.array(bucket, pa.int32()), pa.array(counts[lang, bucket], pa.float64())], names=["lang", "bucket", "n"])

    counted = map_arrow(drawn.select("lang", "text"), of, "lang int, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), BUCKETS + len(_NAMES)))
    counts[counted["lang"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    seen = counts[:, :BUCKETS] + 0.5
    logs = np.log(seen / seen.sum(axis=1, keepdims=True))
    weights = np.clip(logs - logs.mean(axis=0), -4, 4).T / len(ORDERS)
    scripts = counts[:, BUCKETS:]
    allowed = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1) > 0.002
    return LanguageModel(languages, weights.astype(np.float32), allowed.T, penalty)


def _predictions(texts: pa.Array, model: LanguageModel, spans: bool) -> tuple[list[str], list[float], list[list[dict]]]:
    """Language, score and, if asked for, stretches of each text."""
    names, scores, stretches = [], [], []
    for run in runs(texts, _RUN_BYTES):
        starts, ends, first, labels = label_words(model, run)
        length = ends - starts
        for i in range(run.n):
            lo, hi = int(first[i]), int(first[i + 1])
            own = run.data[run.offsets[i] : run.offsets[i + 1]]
            if lo == hi or (not (LOWER[own] - np.uint8(97) < 26).any() and not any(c.isalpha() for c in own.tobytes().decode("utf-8", "replace"))):
                names.append(UNKNOWN), scores.append(0.0), stretches.append([])
                continue
            sure = labels[lo:hi] >= 0
            weight = np.bincount(labels[lo:hi][sure], length[lo:hi][sure], len(model.languages))
            best = int(weight.argmax())
            names.append(model.languages[best])
            scores.append(float(weight[best] / length[lo:hi].sum()))
            if spans:
                cut = np.flatnonzero(np.diff(labels[lo:hi])) + 1
                base = int(run.offsets[i])
                stretches.append([{"start": int(starts[lo + a]) - base, "end": int(ends[lo + b - 1]) - base, "lang": model.languages[labels[lo + a]]} for a, b in zip(np.r_[0, cut], np.r_[cut, hi - lo], strict=True) if labels[lo + a] >= 0])
    return names, scores, stretches


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", spans: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred``, ``score`` and, if asked for, ``spans``.

    ``score`` is the share of the text's letters (bytes of its words) that carry the predicted label;
    ``spans`` are stretches (start, end, lang) in bytes of the UTF-8 text. Words in a script that no training text
    uses carry no label; a text of such words alone gets the first language by name and 0. A null text or one without a letter
    gets ``und`` and 0. Ties go to the language first in order of name. A null id is kept and not held out;
    repeated rows are labelled each; further columns are ignored; an empty table gives no rows.
    """
    kind = "array<struct<start: int, end: int, lang: string>>"

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores, stretches = _predictions(batch.column(1), model, spans)
        columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        if spans:
            columns.append(pa.array(stretches, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))))
        return pa.record_batch(columns, names=["id", "lang_pred", "score", *["spans"] * spans])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double" + f", spans {kind}" * spans
    out = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of, schema)
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "lang_pred", "score", *["spans"] * spans)


def keep_language(docs: DataFrame, model: LanguageModel, least: float, text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, all columns, whose predicted language carries more than ``least`` of the text's letters.

    Decided within one pass over the rows. Null texts and those without a letter go. Repeated rows are decided each, alike;
    columns of any name are kept as they are; an empty table gives no rows.
    """
    at = docs.columns.index(text_col)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, scores, _ = _predictions(batch.column(at), model, False)
        return batch.filter(pa.array([n != UNKNOWN and s > least for n, s in zip(names, scores, strict=True)], pa.bool_()))

    return map_arrow(docs, of, docs.schema)
