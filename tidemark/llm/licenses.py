"""License notices by a positional index of rare words, in DataFrame functions only.

Method
------
Templates of license notices are indexed by word and position. Each text is split once; of its words only those
of the index that are rare in language at large are kept, with their positions, and the places of key
phrases. Document frequencies over the whole table give the inverse document frequency of each
licence word. In texts with a key phrase, licence words look up the postings; postings that agree on the
relative position (text position less template position) vote for a template there. Each template counts the rarest
words that vote for it, whatever other notices the text holds. A template is found when
its votes carry enough of the weight of its rarest words, and its mandatory key phrase stands where that
alignment puts it. Nothing is shuffled but the few texts with licence words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that name a license wherever they stand, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Label, words of a notice, and the key phrase it must hold.
TEMPLATES = (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("gpl", "licensed under the gnu general public license version 3", "general public license"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    ("bsd", "licensed under the bsd license", "bsd license"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by", "licensed under cc by 4 0", "cc by 4"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc0", "licensed under cc0 1 0", "cc0"),
)
#: Words of the templates that say nothing about licenses; they are matched inside phrases only.
COMMON = set("the is of to any a and or it as by in use with are that this for at on be from under other 0 1 2 3 4 v".split())


def _phrase_places(places: Column, words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand one after another. Its first rare word is looked up in ``places``."""
    parts = phrase.split()
    rare = next(k for k, w in enumerate(parts) if w not in COMMON)
    starts = F.transform(places, lambda i: i - rare)

    def stands(i: Column) -> Column:
        ok = i >= 0
        for k, w in sorted(enumerate(parts), key=lambda x: x[1] in COMMON):
            ok = ok & F.coalesce(F.get(words, i + k) == w, F.lit(False))
        return ok

    return F.filter(starts, stands)


def _named_places(places: Column, words: Column, phrase: str) -> Column:
    return F.transform(_phrase_places(places, words, phrase), lambda i: F.struct(i.alias("i"), F.lit(phrase).alias("p")))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rarest: int = 8, coverage: float = 0.6) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score``.

    ``rarest``: words that a template counts. ``coverage``: share of their weight that its votes must carry. ``score`` is the best
    coverage of a template that is found, else 0; a base phrase alone gives ``coverage``. Null and empty texts have no words: counts 0, no
    labels (empty strings), no places (null). A null id is kept as a row; repeated rows
    are scanned each; further columns are ignored; an empty table gives no rows.
    """
    phrases = sorted({p for p, _ in BASE} | {key for _, _, key in TEMPLATES})
    vocabulary = sorted({w for _, t, _ in TEMPLATES for w in t.split()} - COMMON)
    words = F.filter(F.split(F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _UPPER.lower()), _SPLIT), lambda w: w != "")
    split = docs.select(F.col(id_col).alias("id"), words.alias("words"))
    places = F.filter(F.transform("words", lambda w, i: F.when(w.isin(vocabulary), i)), lambda i: i.isNotNull())
    placed = split.select("id", "words", places.alias("places"))
    hits = F.transform("places", lambda i: F.struct(i.alias("i"), F.get("words", i).alias("w")))
    found = F.concat(*[_named_places(F.col("places"), F.col("words"), p) for p in phrases])
    none = F.size("places") == 0
    rows = placed.select(
        "id",
        F.size("words").cast("long").alias("n_words"),
        F.when(~none, hits).alias("hits"),
        F.when(~none, found).alias("phrases"),
    )
    rows = stage(rows.withColumn("uid", F.monotonically_increasing_id()), "licence_words")

    texts = rows.where("hits is not null")
    total = rows.count()
    seen = texts.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n")).collect()
    often = {r["w"]: r["n"] for r in seen}
    rarity = {w: math.log((total + 1) / (often.get(w, 0) + 0.5)) for w in vocabulary}
    weight = F.create_map(*[F.lit(x) for w in vocabulary for x in (w, rarity[w])])
    rows_of = [(t, words_.split(), key) for t, (_, words_, key) in enumerate(TEMPLATES)]
    postings = {w: [(t, p) for t, ws, _ in rows_of for p, x in enumerate(ws) if x == w] for w in vocabulary}
    index = F.create_map(*[x for w in vocabulary for x in (F.lit(w), F.array(*[F.struct(F.lit(t).alias("t"), F.lit(p).alias("p")) for t, p in postings[w]]))])
    mass = {t: sum(sorted((rarity[w] for w in set(ws) - COMMON), reverse=True)[:rarest]) for t, ws, _ in rows_of}

    # only a template whose key phrase stands in the text can be found
    voting = texts.where(F.size("phrases") > 0).select("uid", F.explode("hits").alias("h"))
    votes = voting.select("uid", "h.i", "h.w", weight[F.col("h.w")].alias("weight"), F.explode(index[F.col("h.w")]).alias("at")).select("uid", F.col("at.t").alias("t"), (F.col("i") - F.col("at.p")).alias("shift"), "w", "weight")
    carried = votes.groupBy("uid", "t", "shift", "w").agg(F.max("weight").alias("weight")).groupBy("uid", "t", "shift").agg(F.sort_array(F.collect_list("weight"), asc=False).alias("weights"))
    carried = carried.withColumn("weight", F.aggregate(F.slice("weights", 1, rarest), F.lit(0.0), lambda total, x: total + x))
    masses = F.create_map(*[F.lit(x) for t, m in mass.items() for x in (t, m)])
    label_of = F.create_map(*[F.lit(x) for t, (name, _, _) in enumerate(TEMPLATES) for x in (t, name)])
    key_of = F.create_map(*[F.lit(x) for t, _, key in rows_of for x in (t, key)])
    key_at = F.create_map(*[F.lit(x) for t, ws, key in rows_of for x in (t, next(p for p in range(len(ws)) if ws[p : p + len(key.split())] == key.split()))])
    carried = carried.withColumn("share", F.least(F.col("weight") / masses[F.col("t")], F.lit(1.0))).where(F.col("share") >= coverage)
    aligned = carried.join(texts.select("uid", F.explode("phrases").alias("f")), "uid").where((F.col("f.p") == key_of[F.col("t")]) & (F.col("f.i") == F.col("shift") + key_at[F.col("t")]))
    named = aligned.groupBy("uid").agg(F.collect_set(label_of[F.col("t")]).alias("named"), F.max("share").alias("share"))

    base_words = [p for p, _ in BASE]
    hits_of = F.filter("phrases", lambda f: f["p"].isin(base_words))
    base_of = F.create_map(*[F.lit(x) for pair in BASE for x in pair])
    out = rows.join(named, "uid", "left").withColumn("base", F.coalesce(hits_of, F.array().cast("array<struct<i: int, p: string>>")))
    base_names = F.array_sort(F.array_distinct(F.transform("base", lambda f: base_of[f["p"]])))
    both = F.array_sort(F.array_union(base_names, F.coalesce("named", F.array().cast("array<string>"))))
    starts = F.transform("base", lambda f: f["i"].cast("long"))
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_names, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.coalesce("share", F.when(F.size("base") > 0, F.lit(coverage)).otherwise(0.0)).alias("score"),
    )

