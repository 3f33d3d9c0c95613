"""Data-quality rules, compiled to as few jobs as the tables allow."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import count_where
from tidemark.operators.cleanse import union_all
from tidemark.operators.combine import orphan_keys, orphan_rows
from tidemark.operators.dedup import duplicate_keys
from tidemark.operators.star import table_audit

OK, ALERT, INFO, FAIL = "OK", "ALERTA", "INFO", "FALHA"

RESULT_SCHEMA = (
    "camada string, tabela string, dimensao string, regra string, metrica string, valor string, "
    "valor_num double, esperado string, status string, acao string, evidencia string"
)

Verdict = Callable[[Column], Column]


def info() -> Verdict:
    """Record the value, judge nothing."""
    return lambda v: F.lit(INFO)


def at_most(limit: float, otherwise: str = FAIL) -> Verdict:
    return lambda v: F.when(v <= F.lit(limit), OK).otherwise(otherwise)


def below(limit: float, otherwise: str = ALERT) -> Verdict:
    return lambda v: F.when(v < F.lit(limit), OK).otherwise(otherwise)


def at_least(limit: float, otherwise: str = ALERT) -> Verdict:
    return lambda v: F.when(v >= F.lit(limit), OK).otherwise(otherwise)


def zero(otherwise: str = FAIL) -> Verdict:
    return lambda v: F.when(v == 0, OK).otherwise(otherwise)


@dataclass(frozen=True)
class Rule:
    """What one check measures and how its value is judged; ``value`` is an aggregate or a column of one row."""

    dimension: str
    rule: str
    metric: str
    value: Column
    verdict: Verdict
    expected: str = "0"
    action: str = ""
    shown: Column | None = None  # text to record, when it is not the number itself
    evidence: Column | None = None  # text to record beside the value: what offends


def count_rule(
    dimension: str, rule: str, metric: str, condition: Column, verdict: Verdict, expected: str = "0", action: str = ""
) -> Rule:
    return Rule(dimension, rule, metric, count_where(condition), verdict, expected, action)


def offending_values(code: Column | str, offends: Column, k: int = 5, tracked: int = 10_000) -> Column:
    """The ``k`` commonest values of the offending rows with their counts, as text: an aggregate of bounded size.

    It is a sketch of frequent values, so it goes with the other rules of a table through one scan, whatever the number of
    values. It is exact while the offending rows hold at most three quarters of ``tracked`` distinct values. NULL counts as a
    value; equal counts are listed by value.
    """
    value = F.coalesce((F.col(code) if isinstance(code, str) else code).cast("string"), F.lit("NULL"))
    found = F.call_function("approx_top_k", F.when(offends, value), F.lit(tracked // 4), F.lit(tracked))
    ranked = F.array_sort(F.transform(F.filter(found, lambda x: x["item"].isNotNull()), lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("v"))))
    return F.array_join(F.transform(F.slice(ranked, 1, k), lambda x: F.concat(x["v"], F.lit(": "), (-x["n"]).cast("string"))), ", ")


def domain_rule(
    dimension: str, rule: str, metric: str, code: Column | str, offends: Column, verdict: Verdict, expected: str = "0", action: str = "", k: int = 5
) -> Rule:
    """Counts the rows whose code is not allowed and names the commonest of these codes."""
    return Rule(dimension, rule, metric, count_where(offends), verdict, expected, action, evidence=offending_values(code, offends, k))


class QualityFailure(ValueError):
    """At least one rule ended in FALHA."""


@dataclass
class DQSuite:
    """Collects rules per table and evaluates them together.

    All row rules given the same frame become one aggregate over one scan, whatever table each is
    reported under, and all relation rules given the same one-row frame read it once. :meth:`audit` tests a
    table's key, references and totals in one scan. Nothing runs until the results are used.
    """

    spark: SparkSession
    layer: str
    _rows: dict[int, tuple[DataFrame, list[tuple[str, Rule]]]] = field(default_factory=dict)
    _relations: dict[int, tuple[DataFrame, list[tuple[str, Rule]]]] = field(default_factory=dict)
    _known: list[tuple[str, Rule]] = field(default_factory=list)

    def row(self, table: str, df: DataFrame, *rules: Rule) -> DQSuite:
        """Rules whose values are aggregates over the rows of ``df``."""
        self._rows.setdefault(id(df), (df, []))[1].extend((table, rule) for rule in rules)
        return self

    def relation(self, table: str, one_row: DataFrame, *rules: Rule) -> DQSuite:
        """Rules whose values are columns of a frame that already is one row per verdict."""
        self._relations.setdefault(id(one_row), (one_row, []))[1].extend((table, rule) for rule in rules)
        return self

    def known(self, table: str, *rules: Rule) -> DQSuite:
        """Rules whose values the run has already worked out, as literals."""
        self._known.extend((table, rule) for rule in rules)
        return self

    @staticmethod
    def _key_rule(keys: Sequence[str], value: Column, verdict: Verdict | None, action: str) -> Rule:
        return Rule("Unicidade", f"uma linha por {', '.join(keys)}", "linhas a mais", value, verdict or zero(), "0", action)

    @staticmethod
    def _reference_rule(column: str, target: str, value: Column, verdict: Verdict | None, action: str) -> Rule:
        return Rule("Integridade referencial", f"{column} consta em {target}", "linhas sem correspondência", value, verdict or zero(), "0", action)

    def audit(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        references: Mapping[str, tuple[DataFrame, str]] | None = None,
        totals: Mapping[str, Rule] | None = None,
        before: DataFrame | None = None,
        action: str = "",
    ) -> DQSuite:
        """Key, references ``{column: (dimension, its name)}`` and totals of a table from one scan of it.

        ``totals``: a rule for each measure, over ``total_<measure>`` and the columns of the one-row frame ``before``.
        """
        references, totals = references or {}, totals or {}
        found = table_audit(df, keys, {c: (dimension, c) for c, (dimension, _) in references.items()}, list(totals))
        if before is not None:
            both = found.unionByName(before, allowMissingColumns=True)
            found = both.agg(*[F.max(c).alias(c) for c in both.columns])
        rules = [self._key_rule(keys, F.col("duplicadas"), None, action)]
        rules += [self._reference_rule(c, target, F.col(f"orfaos_{c}"), None, action) for c, (_, target) in references.items()]
        return self.relation(table, found, *rules, *totals.values())

    def key(self, table: str, df: DataFrame, keys: Sequence[str], verdict: Verdict | None = None, action: str = "") -> DQSuite:
        return self.relation(table, duplicate_keys(df, keys), self._key_rule(keys, F.col("duplicadas"), verdict, action))

    def counted_key(self, table: str, keys: Sequence[str], duplicates: int, verdict: Verdict | None = None, action: str = "") -> DQSuite:
        """The key rule of a table whose duplicates a gate has counted."""
        return self.known(table, self._key_rule(keys, F.lit(duplicates), verdict, action))

    def foreign_key(
        self, table: str, df: DataFrame, dimension: DataFrame, key: str, target: str, verdict: Verdict | None = None, action: str = ""
    ) -> DQSuite:
        return self.relation(table, orphan_rows(df, dimension, key), self._reference_rule(key, target, F.col("orfaos"), verdict, action))

    def orphan_entities(
        self, table: str, df: DataFrame, dimension: DataFrame, key: str, target: str, verdict: Verdict | None = None, action: str = ""
    ) -> DQSuite:
        counted = orphan_keys(df, dimension, key).agg(F.count(F.lit(1)).alias("orfaos"))
        rule = Rule("Integridade referencial", f"{key} consta em {target}", "códigos sem correspondência", F.col("orfaos"), verdict or zero(), "0", action)
        return self.relation(table, counted, rule)

    def _record(self, table: str, rule: Rule, value: Column, shown: Column, evidence: Column) -> Column:
        number = value.try_cast("double")
        fields = {
            "camada": F.lit(self.layer),
            "tabela": F.lit(table),
            "dimensao": F.lit(rule.dimension),
            "regra": F.lit(rule.rule),
            "metrica": F.lit(rule.metric),
            "valor": shown.cast("string"),
            "valor_num": number,
            "esperado": F.lit(rule.expected),
            "status": rule.verdict(value),
            "acao": F.lit(rule.action),
            "evidencia": evidence.cast("string"),
        }
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    def _records(self, rules: Sequence[tuple[str, Rule]]) -> Column:
        """The results of rules over one row, as rows."""
        none = F.lit(None)
        records = [
            self._record(table, r, r.value, r.value if r.shown is None else r.shown, none if r.evidence is None else r.evidence) for table, r in rules
        ]
        return F.inline(F.array(*records))

    def results(self) -> DataFrame:
        """One row per rule, in the layout of ``RESULT_SCHEMA`` plus the time of the run."""
        frames = []
        for df, rules in self._rows.values():
            columns, read = [], []
            for i, (table, r) in enumerate(rules):
                parts = {part: getattr(r, part) for part in ("value", "shown", "evidence")}
                columns += [c.alias(f"{part}{i}") for part, c in parts.items() if c is not None]
                read.append((table, replace(r, **{part: F.col(f"{part}{i}") for part, c in parts.items() if c is not None})))
            frames.append(df.agg(*columns).select(self._records(read)))
        frames += [one_row.select(self._records(rules)) for one_row, rules in self._relations.values()]
        if self._known:
            frames.append(self.spark.range(1).select(self._records(self._known)))
        return union_all(frames, self.spark, RESULT_SCHEMA).withColumn("ts_execucao", F.current_timestamp())

    @staticmethod
    def enforce(results: DataFrame) -> None:
        """Raise when a stored result failed; the list is as long as the rule set at most."""
        failed = results.filter(F.col("status") == FAIL).select("tabela", "regra", "valor").collect()
        if failed:
            raise QualityFailure("; ".join(f"{r.tabela}: {r.regra} = {r.valor}" for r in failed))
