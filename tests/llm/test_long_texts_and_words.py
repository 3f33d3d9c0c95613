"""Words of the toxicity grammar, pseudonyms of dates, base secrets by plain patterns, blended fences, and time in long texts."""

import hashlib
import itertools
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import pii, quality_rules, secrets, toxicity
from tidemark.llm.quality_model import FactorisationMachine
from tidemark.llm.words import runs

FOLDER = "/root/testdata/sf0.001"
KEY = hashlib.blake2b(b"k", digest_size=32).digest()


def small(text):
    return "".join(c.lower() if len(c.lower()) == 1 and len(c.lower().encode()) == len(c.encode()) < 3 else c for c in text)


def test_words_are_runs_of_letters():
    rng = np.random.default_rng(0)
    alphabet = list("abzAZ'_09 ’“”«»éÉÀßЖжΣσς中文१²Ⱥİ𝐀😀-.")
    texts = ["".join(rng.choice(alphabet, int(rng.integers(0, 20)))) for _ in range(500)]
    run = next(runs(pa.array(texts)))
    data, starts, ends, first = toxicity._words(run)
    raw = data.tobytes()
    for i, text in enumerate(texts):
        own = slice(first[i], first[i + 1])
        assert [raw[s:e].decode() for s, e in zip(starts[own], ends[own], strict=True)] == re.findall(r"[^\W\d_]+", small(text))


@pytest.mark.parametrize("text", ["tu es l'idiot", "tu es l’idiot", "tu es “idiot”", "tu es «idiot»", "tu es IDIOT"])
def test_quotes_and_elisions_hide_no_insult(text):
    model = toxicity.ToxicityModel(toxicity.Lexicon([("idiot", True, 2.5)]), -4.0, np.full(len(toxicity.EVENTS) + 1, 2.0))
    score = lambda t: model.score(model.events(next(runs(pa.array([t]))))[0])[0]
    assert score(text) == score("tu es idiot") > score("tu es")


def test_short_negations_still_negate():
    model = toxicity.ToxicityModel(toxicity.Lexicon([("idiot", True, 2.5)]), -4.0, np.ones(len(toxicity.EVENTS) + 1))
    for text in ("this isn't an idiot", "this isn’t an idiot", "ce n'est pas un idiot"):
        assert [m[2] for m in model.events(next(runs(pa.array([text]))))[1][0]] == ["insult_negated"]


def test_grammar_equals_its_rules_in_words():
    """Every sequence of four tags with one hit and no target, against the rules in words."""
    machine = toxicity.grammar()
    for tags in itertools.product(("other", "negation", "report", "insult"), repeat=4):
        if tags.count("insult") != 1:
            continue
        at = tags.index("insult")
        kind = "reported" * ("report" in tags[:at]) + "_" * ("report" in tags[:at] and "negation" in tags[:at]) + "negated" * ("negation" in tags[:at])
        assert [x for x in machine.best(list(tags))[1] if x != "-"] == [f"insult_{kind or 'plain'}"], tags


def test_a_date_has_one_pseudonym_in_every_order():
    one = lambda text: pii.pseudonymise(f"on {text} at", KEY)[0][3:-3]
    seen = set()
    for month, day in itertools.product(range(1, 13), range(13, 29)):
        year, m, d = one(f"2024-{month:02d}-{day:02d}").split("-")
        assert one(f"{day:02d}/{month:02d}/2024") == f"{d}/{m}/{year}" and one(f"{month:02d}/{day:02d}/2024") == f"{m}/{d}/{year}"
        assert int(d) > 12
        seen.add((year, m, d))
    assert len(seen) == 12 * 16


def test_base_secrets_equal_plain_patterns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assign = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    for r in docs.select("doc_id", "text").collect():
        text = r.text or ""
        spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[1]) >= 8]
        spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        base = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
        g = got[r.doc_id]
        assert g.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(filter(None, base.split(","))) <= set(g.spans.split(","))
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(x[3] == k for x in spans) for k in ("assign", "access", "hex"))


def test_spans_never_overlap_what_patterns_found():
    words = [hashlib.sha1(str(i).encode()).hexdigest()[:24].upper() + "xQz" for i in range(300)]
    text = " ".join(f"token={w}" if i % 3 else w for i, w in enumerate(words))
    base, added = secrets.secret_spans(text)
    assert len(base) == 200 and len(added) >= 90
    ends = [0]
    for s, e, _ in sorted(base + added):
        assert s >= ends[-1]
        ends.append(e)


@pytest.mark.parametrize("scan", [lambda t: pii.pseudonymise(t, KEY), secrets.secret_spans])
def test_time_grows_with_the_text(scan):
    def seconds(n):
        text = " ".join(f"10.{i % 250}.{i // 250 % 250}.7 {hashlib.sha1(str(i).encode()).hexdigest()[:24].upper()}xQz" for i in range(n))
        best = []
        for _ in range(2):
            start = time.perf_counter()
            scan(text)
            best.append(time.perf_counter() - start)
        return min(best)

    assert seconds(8_000) < 10 * seconds(2_000)  # sixteen times if every span were compared with all


def test_fences_blend_and_names_may_clash(spark):
    """Extra columns named like the operator's own, a group of one, and a junk text in a small group beside clean ones."""
    text = lambda i, n: " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + i % 26)}" for k in range(n))
    rows = [(i, text(i, 60 + 7 * (i % 20)), "en", "a", 1, "x") for i in range(300)]
    rows += [(1000, text(3, 80), "en", "lonely", 1, "x"), (1001, text(3, 80) + " ###### " * 40, "en", "lonely", 1, "x"), (1002, text(5, 90), None, None, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, _lang int, _source string")
    got = {r.doc_id: r.kept for r in quality_rules.apply_rules(docs).collect()}
    assert not got[1001] and all(kept for i, kept in got.items() if i != 1001) and len(got) == len(rows)


def test_sum_of_squares_equals_explicit_pairs():
    """The linear-time margins of three sparse rows against a sum over all pairs of their features."""
    rng = np.random.default_rng(5)
    weights, factors = rng.normal(size=12), rng.normal(size=(12, 4))
    model = FactorisationMachine(0.25, weights, factors)
    rows, cols, values = np.repeat(np.arange(3), 6), np.concatenate([rng.permutation(12)[:6] for _ in range(3)]), rng.normal(size=18)
    for row, margin in enumerate(model.margins(3, rows, cols, values)):
        own = [(c, x) for r, c, x in zip(rows, cols, values, strict=True) if r == row]
        plain = 0.25 + sum(weights[c] * x for c, x in own) + sum(float(factors[a] @ factors[b]) * x * y for (a, x), (b, y) in itertools.combinations(own, 2))
        assert np.isclose(margin, plain)
