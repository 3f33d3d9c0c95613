"""Quality rules with thresholds that each language and source sets for itself.

Method
------
Fixed counts per text (words, symbols, repeated lines and word windows) give ratios. Mergeable KLL quantile
sketches of every ratio are built per language and source in one aggregation and merged per language and over all. A
group's upper fence for a ratio is its ninth decile plus a multiple of that decile's distance from the median, and no
higher than a ceiling, so that a group that is mostly junk does not set its own standard. Where the two are equal, since
most texts have no such symbol or line, a second sketch serves in which a count of zero stands as one: what a single one
makes of texts of that length. Only where that shows no spread either, a fixed guard stands in. The fence of a group of n
texts counts with weight n / (n + ``enough``) and that of its parent (the language, then the whole table) with the rest,
so a few texts never decide and no number of texts switches the rule. Texts are joined to their group's fences; one above any is not kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_arrow
from tidemark.llm.words import SPACE, PrefixHash, runs, shingles
from tidemark.session import stage

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True

#: Ratio, fence where a group shows no spread, highest fence. Elsewhere the data decides.
RATIOS = (("symbol_ratio", 0.02, 0.10), ("repeat_ratio", 0.30, 0.50), ("upper_ratio", 0.20, 0.40), ("line_ratio", 0.50, 0.70))


def measures(docs: DataFrame, id_col: str, text_col: str, groups: list[str]) -> DataFrame:
    """Per row: id, groups, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper"]

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = np.zeros((len(batch), len(names)), np.int64)
        for run in runs(batch.column(len(batch.columns) - 1)):
            data, cut = run.data, run.offsets
            rows = out[run.first : run.first + run.n]
            inside = ~SPACE[data]
            starts, ends, first = run.spans(inside)
            rows[:, 0] = np.diff(first)
            for k, flags in ((1, inside & ((data & 0xC0) != 0x80)), (2, _SYMBOL[data]), (6, _UPPER[data])):
                sums = np.zeros(len(data) + 1, np.int64)
                np.cumsum(flags, out=sums[1:])
                rows[:, k] = sums[cut[1:]] - sums[cut[:-1]]
            hashes = PrefixHash(data)
            windows = shingles(hashes.of(starts, ends), 3)
            line_starts, line_ends, line_first = run.spans(data != 10)
            lines = hashes.of(line_starts, line_ends)
            full = np.zeros(len(data) + 1, np.int64)
            np.cumsum(inside, out=full[1:])
            wordy = full[line_ends] > full[line_starts]
            for i in range(run.n):
                own = lines[line_first[i] : line_first[i + 1]][wordy[line_first[i] : line_first[i + 1]]]
                rows[i, 5] = len(own)
                if len(own) > 1:
                    rows[i, 3] = len(own) - len(np.unique(own))
                lo, hi = int(first[i]), int(first[i + 1])
                if hi - lo > 3:
                    h = windows[lo : hi - 2]
                    order = np.argsort(h)
                    same = h[order[1:]] == h[order[:-1]]
                    if same.any():
                        again = np.zeros(len(h) + 2, bool)
                        for k in range(3):
                            again[order[1:][same] + k] = True
                            again[order[:-1][same] + k] = True
                        rows[i, 4] = again.sum()
        return pa.record_batch([*batch.columns[:-1], *(pa.array(out[:, k]) for k in range(len(names)))], names=["id", *groups, *names])

    kinds = ", ".join(f"{c} {docs.schema[g].dataType.simpleString()}" for c, g in zip(["id", *groups], [id_col, *groups], strict=True))
    return map_arrow(docs.select(F.col(id_col).alias("id"), *groups, text_col), of, kinds + "".join(f", {n} long" for n in names))


def _ratio(name: str, least: int = 0) -> Column:
    """A ratio of a text, its count taken as ``least`` or more."""
    count, size = {"symbol_ratio": ("n_symbols", "word_chars"), "repeat_ratio": ("n_repeat_words", "n_words"), "upper_ratio": ("n_upper", "word_chars"), "line_ratio": ("n_dup_lines", "n_lines")}[name]
    return F.greatest(F.col(count), F.lit(least)) / F.greatest(F.col(size), F.lit(1))


def _fence(name: str, guard: float, high: float, spread: float) -> Column:
    def of(sketch: str, otherwise: Column) -> Column:
        middle = F.kll_sketch_get_quantile_double(sketch, F.lit(0.5))
        upper = F.kll_sketch_get_quantile_double(sketch, F.lit(0.9))
        return F.when(upper > middle, F.least(upper + spread * (upper - middle), F.lit(high))).otherwise(otherwise)

    return of(name, of(f"{name}_one", F.lit(guard)))


def apply_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", spread: float = 4.0, enough: int = 20) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``, ``kept``.

    ``base_failed``: fewer than 50 words, or over half of the words in repeated windows. ``spread``: how many
    times the distance from the median to the ninth decile a ratio may lie above that decile; ``enough``: at
    so many texts a group's own fences and its parent's count half each. Null, empty and blank texts have no words and fail. A null
    language or source is a group of its own. A null id is kept as a row; repeated rows are judged each; further
    columns are ignored; an empty table gives no rows.
    """
    rows = measures(docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), F.col(text_col).alias("text")), "id", "text", ["_lang", "_source"])
    rows = stage(rows.withColumns({"base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))} | {name: _ratio(name) for name, _, _ in RATIOS}), "measures")
    names = [name for name, _, _ in RATIOS]
    sketches = stage(rows.groupBy("_lang", "_source").agg(F.count("*").alias("n"), *[F.kll_sketch_agg_double(_ratio(name, least)).alias(f"{name}{tag}") for name in names for least, tag in ((0, ""), (1, "_one"))]), "sketches")
    merged = [F.sum("n").alias("n"), *[F.kll_merge_agg_double(f"{name}{tag}").alias(f"{name}{tag}") for name in names for tag in ("", "_one")]]
    by_lang = sketches.groupBy("_lang").agg(*merged)
    overall = by_lang.agg(*merged)

    def fences(sketch: DataFrame, tag: str) -> list[Column]:
        return [_fence(name, guard, high, spread).alias(f"{name}_{tag}") for name, guard, high in RATIOS]

    own = sketches.select("_lang", "_source", F.col("n").alias("_n_own"), *fences(sketches, "own"))
    of_lang = by_lang.select("_lang", F.col("n").alias("_n_lang"), *fences(by_lang, "lang"))
    general = overall.where("n > 0").select(*fences(overall, "all")).first()
    # one row for each language and source that occurs: small beside the texts, and joined to them last
    level = own.join(of_lang.withColumnRenamed("_lang", "_l"), F.col("_lang").eqNullSafe(F.col("_l")), "left")

    def fence(name: str) -> Column:
        part = [F.col(f"_n_{tag}") / (F.col(f"_n_{tag}") + enough) for tag in ("own", "lang")]
        of = part[1] * F.col(f"{name}_lang") + (1 - part[1]) * F.lit(general[f"{name}_all"] if general else None)
        return part[0] * F.col(f"{name}_own") + (1 - part[0]) * of

    level = level.select("_lang", "_source", *[fence(n).alias(f"{n}_fence") for n in names])
    both = rows.join(level, rows["_lang"].eqNullSafe(level["_lang"]) & rows["_source"].eqNullSafe(level["_source"]), "left")
    above = F.lit(False)
    for name in names:
        above = above | (F.col(name) > F.col(f"{name}_fence"))
    return both.select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~above).alias("kept"))
