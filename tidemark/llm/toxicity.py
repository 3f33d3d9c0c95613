"""Toxicity by a weighted finite-state grammar over clauses.

Method
------
Words become tags: insult and threat stems are learned (whole words and word beginnings that occur far more
often in toxic training texts), with small fixed lists of threat verbs, targets, negations and
verbs of reported speech in four languages. A clause with an insult or a threat runs through the composition of
three transducers: the first marks what follows a verb of speech as reported, the second marks what stands
within three words after a negation as negated, the third marks insults near a target as directed. What
comes out are events (a plain, directed, negated or reported insult or threat), each weighted by the
strength of its stem. A document's score is the logistic of its weighted events; the weights of the events
are fitted on the same bounded sample of labelled rows, so a grammar mark counts for as much as the labels say.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, labelled, map_arrow
from tidemark.llm.transducers import Transducer
from tidemark.llm.words import PrefixHash, Run, hash_bytes, letters_and_small, runs

PREFIXES = (3, 4, 5, 6, 7)
_STOP = np.zeros(256, bool)
_STOP[list(b".!?;:\n")] = True

# Fixed word lists of the grammar, in English, German, French and Spanish; of short forms the part before the apostrophe.
THREATS = "kill hurt destroy murder stab shoot töten umbringen verletzen tuer frapper matar golpear".split()
TARGETS = "you your yourself they them he she him her people du dich dein ihr sie er tu te toi vous ton votre il elle ils usted tú él ella ellos ustedes".split()
NEGATIONS = "not no never isn aren wasn weren doesn didn nicht kein keine nie pas jamais non nunca jamás ni".split()
REPORTS = "said says wrote claimed called quoted reported sagte sagt schrieb behauptete dit écrit affirme dijo dice escribió afirmó".split()

KINDS = ("plain", "directed", "negated", "reported", "reported_negated")
HITS = ("insult", "threat", "hint")
EVENTS = tuple(f"{what}_{kind}" for what in HITS for kind in KINDS)
_TAGS = ("other", "insult", "threat", "target", "negation", "report", "hint")


def grammar() -> Transducer:
    """Reported speech, then negation, then target; the outputs are events or ``-``."""
    reported = Transducer("open")
    for tag in _TAGS:
        reported.add("open", tag, "said" if tag == "report" else "open", "other" if tag == "report" else tag)
        reported.add("said", tag, "said", f"reported_{tag}" if tag in HITS else "other" if tag == "report" else tag)
    middle = ("other", "target", *HITS, *(f"reported_{what}" for what in HITS))
    negated = Transducer(0)
    for left in range(4):
        negated.add(left, "negation", 3, "other")
        for tag in middle:
            hit = tag.endswith(HITS)
            negated.add(left, tag, 0 if hit else max(0, left - 1), f"negated_{tag}" if hit and left else tag)
    directed = Transducer("far")
    for state in ("far", "near", "ahead"):
        for tag in (*middle, *(f"negated_{m}" for m in middle if m.endswith(HITS))):
            what = next((x for x in HITS if tag.endswith(x)), "")
            kind = "reported_negated" if "negated_reported" in tag else "negated" if "negated" in tag else "reported" if "reported" in tag else "directed" if state == "near" else "plain"
            out = f"{what}_{kind}" if what else "-"
            if state == "ahead":  # an insult was taken as directed at a target that has yet to come: within four words, or it does not pay
                directed.add(state, tag, "near" if tag == "target" else "ahead", out, 1.0 if tag == "target" else -0.1)
                continue
            directed.add(state, tag, "near" if tag == "target" or state == "near" else "far", out)
            if what and kind == "plain":
                directed.add(state, tag, "ahead", f"{what}_directed", -0.55)
    return reported.compose(negated).compose(directed)


@dataclass
class Lexicon:
    """Stems by their number of letters' bytes (0: whole words), as hashes with their strength."""

    entries: list[tuple[str, bool, float]]  # text, whole word, strength

    def __post_init__(self) -> None:
        by: dict[int, dict[int, float]] = {}
        for text, whole, strength in self.entries:
            raw = text.encode()
            by.setdefault(0 if whole else len(raw), {})[hash_bytes(raw)] = strength
        self.tables = []
        for size, found in sorted(by.items()):
            keys = np.array(sorted(found), np.uint64)
            seen = np.zeros(1 << 16, bool)
            seen[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.tables.append((size, keys, np.array([found[int(k)] for k in keys]), seen))

    def strengths(self, hashes: PrefixHash, starts: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Of each word; 0 for words that no stem begins."""
        out = np.zeros(len(starts))
        for size, keys, values, seen in self.tables:
            if size:
                fits = np.flatnonzero(ends - starts >= size)
                own = hashes.of(starts[fits], starts[fits] + size)
            else:
                fits, own = np.arange(len(starts)), whole
            maybe = seen[(own & np.uint64(0xFFFF)).astype(np.int64)]
            fits, own = fits[maybe], own[maybe]
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            hit = keys[at] == own
            out[fits[hit]] = np.maximum(out[fits[hit]], values[at[hit]])
        return out


#: From this strength on a stem is an insult, below it a hint.
STRONG = 1.8
_HINTS = [k for k, e in enumerate(EVENTS) if e.startswith("hint")]

_FIXED = {hash_bytes(w.encode()): k for k, words in ((2, THREATS), (3, TARGETS), (4, NEGATIONS), (5, REPORTS)) for w in words}
_FIXED_KEYS = np.array(sorted(_FIXED), np.uint64)
_FIXED_TAGS = np.array([_FIXED[int(k)] for k in _FIXED_KEYS])


def _words(run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes in small letters; starts and ends of the runs of letters in them, first one of each text.

    Learning and scoring both cut words here: quotes, apostrophes and dashes end a word, so an elided article is one of its own.
    """
    inside, data = letters_and_small(run.data)
    return data, *run.spans(inside)


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    bias: float
    weights: np.ndarray

    def __post_init__(self) -> None:
        self.machine = grammar()

    def events(self, run: Run) -> tuple[np.ndarray, list[list[tuple[int, int, str, float]]]]:
        """Summed strength of each event per text, the rate of hints, and the matches (start, end in bytes, event, strength)."""
        data, starts, ends, first = _words(run)
        hashes = PrefixHash(data)
        whole = hashes.of(starts, ends)
        strength = self.lexicon.strengths(hashes, starts, ends, whole)
        at = np.minimum(np.searchsorted(_FIXED_KEYS, whole), len(_FIXED_KEYS) - 1)
        tags = np.where(_FIXED_KEYS[at] == whole, _FIXED_TAGS[at], 0)
        tags[strength > 0] = 6
        tags[strength >= STRONG] = 1
        sums, matches = np.zeros((run.n, len(EVENTS) + 1)), [[] for _ in range(run.n)]
        hits = np.flatnonzero((tags == 1) | (tags == 2) | (tags == 6))
        if not len(hits):
            return sums, matches
        stops = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_STOP[data], out=stops[1:])
        clause = stops[starts]
        text = np.searchsorted(first, hits, "right") - 1
        done = -1
        for h, i in zip(hits.tolist(), text.tolist(), strict=True):
            if h < done:
                continue
            lo = max(int(first[i]), int(np.searchsorted(clause, clause[h], "left")))
            done = hi = min(int(first[i + 1]), int(np.searchsorted(clause, clause[h], "right")))
            for k, out in enumerate(self.machine.best([_TAGS[t] for t in tags[lo:hi]])[1]):
                if out != "-":
                    value = float(strength[lo + k]) or 1.0
                    sums[i, EVENTS.index(out)] += value
                    matches[i].append((int(starts[lo + k] - run.offsets[i]), int(ends[lo + k] - run.offsets[i]), out, value))
        # hints count by their share of the words as well: clean texts hold some
        sums[:, -1] = 30 * sums[:, _HINTS].sum(axis=1) / np.maximum(np.diff(first), 15)
        return sums, matches

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + np.log1p(sums) @ self.weights, -30, 30)))


def learn_lexicon(sample: DataFrame, positives: int, negatives: int, most: int = 2000) -> Lexicon:
    """Stems of a labelled sample (y, text) whose document counts differ beyond chance; at most ``most``.

    A stem must occur in at least four toxic texts, eight times as often there as elsewhere (smoothed), with a
    log-likelihood ratio above 18. Of stems that contain one another the best stays, the longer one in a tie.
    """

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}
        marks = batch.column(0).to_pylist()
        for run in runs(batch.column(1)):
            data, starts, ends, first = _words(run)
            raw = data.tobytes()
            for i in range(run.n):
                own = slice(first[i], first[i + 1])
                words = {raw[s:e].decode() for s, e in zip(starts[own], ends[own], strict=True)}
                counts[1 if marks[run.first + i] else 0].update({w + "$" for w in words if len(w) > 2} | {w[:n] for w in words for n in PREFIXES if len(w) >= n})
        stems = sorted(set(counts[0]) | set(counts[1]))
        return pa.record_batch([pa.array(stems, pa.string()), pa.array([counts[1][s] for s in stems], pa.int64()), pa.array([counts[0][s] for s in stems], pa.int64())], names=["stem", "toxic", "clean"])

    counted = map_arrow(sample.select("y", "text"), of, "stem string, toxic long, clean long").groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    p, n = float(max(positives, 1)), float(max(negatives, 1))
    # five texts of each kind stand behind every stem, so that a rare one is never a strong one
    rate = (F.col("toxic") + 5) / (p + 5)
    other = (F.col("clean") + 5) / (n + 5)
    total = F.col("toxic") + F.col("clean")
    expected = total * F.lit(p / (p + n))
    ratio = 2 * (F.col("toxic") * F.log(F.col("toxic") / expected) + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (total - expected))).otherwise(0.0))
    good = counted.where(F.col("toxic") >= 4).withColumn("odds", rate / other).withColumn("g", ratio).where("odds >= 8 and g > 18")
    rows = good.orderBy(F.desc("g"), F.desc(F.length("stem")), "stem").limit(4 * most).collect()
    chosen: list[tuple[str, bool, float]] = []
    for r in rows:
        whole = r.stem.endswith("$")
        text = r.stem.rstrip("$")
        if any((text.startswith(t) and not w) or t.startswith(text) for t, w, _ in chosen):
            continue
        chosen.append((text, whole, min(3.0, float(np.log(r.odds)) - 1.9)))
        if len(chosen) == most:
            break
    return Lexicon(chosen)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.002, steps: int = 60) -> tuple[float, np.ndarray]:
    """Newton steps on the ridge logistic loss; weights below zero are set to zero at the end."""
    theta = np.zeros(x.shape[1] + 1)
    full = np.c_[np.ones(len(x)), x]
    penalty = np.diag([1e-6] + [ridge] * x.shape[1]) * len(x)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(full @ theta, -30, 30)))
        grad = full.T @ (p - y) + penalty @ theta
        step = np.linalg.solve((full * (p * (1 - p) + 1e-6)[:, None]).T @ full + penalty, grad)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(theta[0]), np.maximum(theta[1:], 0)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", rows: int = 6000) -> ToxicityModel:
    """Learn stems and event weights from at most ``rows`` labelled rows outside the held-out fold."""
    sample = labelled(docs, labels, label, id_col, {"text": F.col(text_col)}, rows).where("text is not null").dropDuplicates(["text"])
    counts = {r["y"]: r["n"] for r in sample.groupBy((F.col("y") > 0).alias("y")).agg(F.count("*").alias("n")).collect()}
    lexicon = learn_lexicon(sample, counts.get(True, 0), counts.get(False, 0))
    blank = ToxicityModel(lexicon, 0.0, np.zeros(len(EVENTS) + 1))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = np.concatenate([np.zeros((0, len(EVENTS) + 1)), *[blank.events(run)[0] for run in runs(batch.column(1))]])
        return pa.record_batch([batch.column(0), pa.array(list(sums), pa.list_(pa.float64()))], names=["y", "x"])

    got = map_arrow(sample.select("y", "text"), of, "y int, x array<double>").collect()
    if not got:
        return ToxicityModel(lexicon, -4.0, np.ones(len(EVENTS) + 1))
    y = np.array([float(r.y > 0) for r in got])
    bias, weights = _logistic(np.log1p(np.array([r.x for r in got])), y)
    for what in HITS:  # an insult aimed at someone is no weaker than one at large
        plain_at, aimed = EVENTS.index(f"{what}_plain"), EVENTS.index(f"{what}_directed")
        weights[aimed] = max(weights[aimed], weights[plain_at])
    # an event that the sample hardly shows keeps the weight of the plain insult, halved if negated or reported
    shown = (np.array([r.x for r in got]) > 0).sum(axis=0)
    plain = max(float(weights[0]), 1.0)
    for k, event in enumerate(EVENTS):
        if shown[k] < 5:
            like = float(weights[_HINTS[0]]) if k in _HINTS else plain
            weights[k] = like * (0.5 if "negated" in event or "reported" in event else 1.0)
    return ToxicityModel(lexicon, bias, weights)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, matches: bool = False) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score``, ``predicted`` and, if asked for, ``matches``.

    ``matches`` are (start, end, event, strength), positions in bytes of the UTF-8 text. Null and empty texts
    have no clause and get the score of a text without events. A null id is kept and not held out; repeated rows are scored each; further
    columns are ignored; an empty table gives no rows.
    """
    kept = matches
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("event", pa.string()), ("strength", pa.float64())]))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, found = [np.zeros(0)], []
        for run in runs(batch.column(1)):
            sums, own = model.events(run)
            scores.append(model.score(sums))
            if kept:
                found += [[dict(zip(("start", "end", "event", "strength"), m, strict=True)) for m in x] for x in own]
        columns = [batch.column(0), pa.array(np.concatenate(scores), pa.float64())] + ([pa.array(found, kind)] if kept else [])
        return pa.record_batch(columns, names=["id", "score", *["matches"] * kept])

    schema = f"id {docs.schema[id_col].dataType.simpleString()}, score double" + ", matches array<struct<start: int, end: int, event: string, strength: double>>" * matches
    out = map_arrow(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), of, schema)
    return out.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *["matches"] * matches)
