"""Stages on odd rows and tables, and what the last changes to operators 1 and 6 promise."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language_id, near_dedup, queries
from tidemark.llm.components import merge_components
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.words import runs

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _row long, id string, component int"
LONG = " ".join(f"word{i % 997} the and" for i in range(9_000))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return language_id.train(docs)


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", None, None, 7, "x", 3) for i, t in texts], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark, docs):
    real = [(1000 + r.doc_id, r.text) for r in docs.orderBy("doc_id").limit(40).collect()]
    return table(spark, [*real, (1, None), (2, ""), (3, " \n"), (4, LONG), (5, LONG), (6, "the cat"), (6, "the cat"), (None, "the house and the garden"), (None, None), (7, "123 456")])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_and_take_odd_rows(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    none = stage(spark, odd.limit(0), FOLDER)
    assert none.count() == 0 and none.schema.names == odd.columns
    out = stage(spark, odd, FOLDER)
    assert out.columns == odd.columns and [f.dataType for f in out.schema] == [f.dataType for f in odd.schema]
    got = out.collect()
    assert all((r["_row"], r["id"], r["component"], r["lang"]) == (7, "x", 3, "en") for r in got)
    ids = [r.doc_id for r in got]
    if name == "language":
        assert 1 not in ids and 2 not in ids and 3 not in ids and 7 not in ids and ids.count(6) in (0, 2)
        assert len([r for r in got if r.doc_id is None]) <= 1
    elif name == "near_duplicates":
        # copies: the smaller id stays; a repeated row stays once; rows without id or words stay
        assert 4 in ids and 5 not in ids and ids.count(6) == 1 and ids.count(None) == 2 and {1, 2, 3} <= set(ids)
    elif name == "decontamination":
        assert {1, 2, 3, 4, 5, 7} <= set(ids) and ids.count(6) == 2 and ids.count(None) == 2
    else:
        assert len(got) == odd.count()


def test_leaks_without_an_id_go_too(spark, docs):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    passage = max((r.text for r in bench.collect()), key=len)
    rows = table(spark, [(None, passage), (None, "a text of its own that nobody asked about"), (11, passage), (12, None)])
    kept = queries.drop_contaminated(spark, rows, FOLDER).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == [(0, "a text of its own that nobody asked about"), (12, "")]


def test_the_least_text_of_an_id_counts(spark):
    base = [f"w{i}" for i in range(60)]
    a, other = " ".join(base), " ".join(f"z{i}" for i in range(60))
    rows = spark.createDataFrame([(1, a), (2, other), (2, a), (3, other), (3, other), (4, "q r s t u"), (None, a), (None, "a set of no other row here")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.n_shingles, r.kept) for r in near_duplicates(rows).collect())
    assert got == [(0, 0, 3, True), (0, 0, 56, True), (1, 1, 56, True), (2, 1, 56, False), (2, 1, 56, False), (3, 3, 56, True), (3, 3, 56, True), (4, 4, 1, True)]


def test_only_similarities_that_the_tables_find_are_taken(docs):
    with pytest.raises(ValueError, match="80"):
        near_duplicates(docs, percent=60)
    for percent in (80, 85, 90, 95):
        values, ranges = near_dedup.least_agreement(percent)
        p = percent / 100
        sd = (p * (1 - p) / near_dedup.VALUES) ** 0.5
        assert near_dedup.VALUES * (p - 5 * sd) < values <= near_dedup.VALUES * (p - 3.9 * sd) and ranges < p
    assert near_dedup.least_agreement(80)[0] == 16


def _brute(rows, percent, size=5):
    sets = {i: {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if (w := t.split()) else set() for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("percent", "block"), [(80, 16), (90, 16), (80, 512)])
def test_a_group_of_copies_edited_again_and_again(spark, percent, block):
    """Every copy is an edit of some earlier one: many pairs lie just above and just below the limit."""
    rng = np.random.default_rng(percent)
    texts = [[f"b{i}" for i in range(120)]]
    for _ in range(160):
        t = list(texts[rng.integers(len(texts))])
        for _ in range(int(rng.integers(1, 5))):
            t[int(rng.integers(len(t)))] = f"n{rng.integers(10**6)}"
        texts.append(t)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent, block=block).collect()}
    assert got == _brute(rows, percent)


def test_texts_too_long_to_carry_are_told_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "CARRIED", 40)
    sets = [np.arange(30, dtype=np.uint32), None, np.arange(2, 32, dtype=np.uint32), np.arange(500, 530, dtype=np.uint32)]
    i, j = np.array([0, 0, 0, 1, 2]), np.array([1, 2, 3, 3, 3])
    kept = near_dedup._similar(i, j, np.arange(4), sets, 80)
    # pairs with the set that isn't carried stay for the texts to tell; of the others only similar ones do
    assert kept.tolist() == [True, True, False, True, False]


def test_components_grow_by_links_between_them(spark):
    link = lambda *pairs: spark.createDataFrame(list(pairs), "a long, b long")
    first = merge_components(None, link((5, 6), (6, 7), (1, 2)))
    assert {r.id: r.component for r in merge_components(first, link((5, 7))).collect()} == {1: 1, 2: 1, 5: 5, 6: 5, 7: 5}
    more = merge_components(first, link((7, 2), (9, 8), (8, 10), (2, 1)))
    assert {r.id: r.component for r in more.collect()} == {1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 8: 8, 9: 8, 10: 8}
    grown = merge_components(more, link((10, 0)))
    assert {r.id: r.component for r in grown.collect()} == {0: 0, 1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 8: 0, 9: 0, 10: 0}


def test_two_hundred_languages():
    """More labels than a byte holds: every one is given."""
    rng = np.random.default_rng(2)
    k = 200
    weights = rng.normal(size=(language_id.BUCKETS, k)).astype(np.float32)
    model = language_id.LanguageModel([f"l{i:03d}" for i in range(k)], weights, np.ones((len(language_id._NAMES), k), bool), penalty=0.1)
    texts = pa.array([" ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(40)) for _ in range(20)])
    seen = set()
    for run in runs(texts):
        labels = language_id.label_words(model, run)[3]
        assert labels.min() >= 0 and labels.max() < k
        seen |= set(labels.tolist())
    assert max(seen) > 128


def test_scripts_limit_the_languages_that_are_scored():
    """A language that doesn't use a word's script scores nothing there, and the rest as ever."""
    rng = np.random.default_rng(4)
    weights = rng.normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    allowed = np.ones((len(language_id._NAMES), 3), bool)
    texts = pa.array(["the house ключ слово garden", "ключ", "house"])
    free = language_id.LanguageModel(["a", "b", "c"], weights, allowed)
    latin_only = allowed.copy()
    (run,) = runs(texts)
    _, _, _, scripts, words, buckets = language_id.grams(run)
    latin_only[scripts[1 + 1], 2] = False  # language c doesn't use the script of the third word
    limited = language_id.LanguageModel(["a", "b", "c"], weights, latin_only)
    one, two = free.word_scores(words, buckets, scripts), limited.word_scores(words, buckets, scripts)
    there = scripts == scripts[2]
    assert (two[there, 2] == -50).all() and np.allclose(one[~there], two[~there]) and np.allclose(one[:, :2], two[:, :2])


def test_language_by_another_way_through_the_table(docs, model):
    """Labels of whole texts by plain dynamic programming, word by word."""
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    for r in docs.orderBy("doc_id").limit(60).collect():
        for run in runs(pa.array([r.text])):
            starts, ends, first, scripts, words, buckets = language_id.grams(run)
            scores = model.word_scores(words, buckets, scripts)
            value, back = scores[0].copy(), []
            for row in scores[1:]:
                best = int(value.argmax())
                move = value[best] - model.penalty > value
                back.append(np.where(move, best, np.arange(len(value))))
                value = np.where(move, value[best] - model.penalty, value) + row
            path = [int(value.argmax())]
            for step in reversed(back):
                path.append(int(step[path[-1]]))
            weight = np.bincount(path[::-1], ends - starts, len(model.languages))
            assert got[r.doc_id].lang_pred == model.languages[int(weight.argmax())]
            assert abs(got[r.doc_id].score - weight.max() / (ends - starts).sum()) < 1e-9


def test_toxicity_finds_held_out_texts(spark):
    """Recall and precision on held-out toxic texts, about a hundred; accuracy alone would be high for a model that marks nothing."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    held = queries.op4_toxicity(spark, folder).where("held_out").join(labels.where("toxic is not null"), "doc_id")
    hit, marked, toxic = held.agg(*[F.count_if(F.expr(c)) for c in ("toxic = 1 and predicted = 1", "predicted = 1", "toxic = 1")]).first()
    assert toxic > 50 and hit >= 0.85 * toxic and hit >= 0.95 * marked
