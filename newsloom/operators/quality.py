"""Declarative data-quality rules, evaluated in as few passes as possible.

All row-level rules of a suite share one aggregation. Each uniqueness rule is
one grouped count. The result is a small table, one row per rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.constants import COMBINED_COLUMNS
from newsloom.session import stage

RESULT_SCHEMA = (
    "index int, expectation string, column string, success boolean, unexpected bigint, total bigint, error string"
)


@dataclass(frozen=True)
class Rule:
    """Base: a rule on one column; ``mostly`` is the share of values that must comply."""

    column: str
    mostly: float = 1.0

    @property
    def name(self) -> str:
        return type(self).__name__

    def violated(self, c: Column) -> Column | None:
        """Condition of an unexpected, non-null value; None if not row-level."""
        return None


@dataclass(frozen=True)
class ColumnExists(Rule):
    pass


@dataclass(frozen=True)
class NotNull(Rule):
    pass


@dataclass(frozen=True)
class Unique(Rule):
    pass


@dataclass(frozen=True)
class MatchesRegex(Rule):
    regex: str = ""

    def violated(self, c: Column) -> Column:
        return ~c.cast("string").rlike(self.regex)


@dataclass(frozen=True)
class LengthBetween(Rule):
    low: int = 0
    high: int = 1 << 31

    def violated(self, c: Column) -> Column:
        return ~F.length(c.cast("string")).between(self.low, self.high)


@dataclass(frozen=True)
class InSet(Rule):
    values: Sequence[Any] = field(default_factory=tuple)

    def violated(self, c: Column) -> Column:
        return ~c.isin(*self.values)


def _unique_counts(df: DataFrame, column: str) -> DataFrame:
    per_value = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return per_value.agg(
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("unexpected"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total"))


ERROR_LENGTH = 300


def _counts(df: DataFrame, totals: dict[str, Column]) -> tuple[dict[str, int], dict[str, str]]:
    """All counts in one pass; if one of them raises, each by itself, with the errors by name."""
    if len(totals) == 1:
        return {}, {}
    try:
        return df.agg(*[v.alias(k) for k, v in totals.items()]).first().asDict(), {}
    except Exception:  # noqa: BLE001
        counts, broken = {}, {}
        for name, total in totals.items():
            try:
                counts[name] = df.agg(total.alias(name)).first()[0]
            except Exception as e:  # noqa: BLE001
                broken[name] = str(e)[:ERROR_LENGTH]
        return counts, broken


def _row_totals(known: set[str], rules: Sequence[Rule]) -> dict[str, Column]:
    """What the row-level rules count, by name."""
    totals: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for i, rule in enumerate(rules, 1):
        if rule.column not in known or isinstance(rule, (ColumnExists, Unique)):
            continue
        c = F.col(rule.column)
        totals[f"n_{rule.column}"] = F.count(c)
        totals[f"u_{i}"] = F.count_if(c.isNull() if isinstance(rule, NotNull) else rule.violated(c))
    return totals


def _report(df: DataFrame, rules: Sequence[Rule], counts: Mapping[str, int], broken: Mapping[str, str]) -> DataFrame:
    known, lines = set(df.columns), []
    for i, rule in enumerate(rules, 1):
        error, bad, n = None, 0, 0
        if isinstance(rule, ColumnExists):
            ok = rule.column in known
        elif rule.column not in known:
            ok, error = False, f"column '{rule.column}' does not exist"
        else:
            if isinstance(rule, Unique):
                try:
                    bad, n = _unique_counts(df, rule.column).first()
                except Exception as e:  # noqa: BLE001
                    error = str(e)[:ERROR_LENGTH]
            else:
                bad, n = counts.get(f"u_{i}", 0), counts.get("rows" if isinstance(rule, NotNull) else f"n_{rule.column}", 0)
                error = broken.get(f"u_{i}")
            ok = error is None and (bad == 0 or (n - bad) / n >= rule.mostly)
        lines.append((i, rule.name, rule.column, ok, bad, n, error))
    return df.sparkSession.createDataFrame(lines, RESULT_SCHEMA)


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: index, expectation, column, success, unexpected, total, error.

    ``total`` counts non-null values (all rows for NotNull). A value rule on a
    column the frame lacks counts as failed, and so does a rule that raises: the
    others are then counted one by one. Only counts reach the driver: one row for
    all row-level rules and one row per uniqueness rule.
    """
    counts, broken = _counts(df, _row_totals(set(df.columns), rules))
    return _report(df, rules, counts, broken)


def stage_checked(df: DataFrame, label: str, rules: Sequence[Rule], **more: Column) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
    """Write ``df`` and count its row-level rules in the same pass.

    Gives the written table, what ``run_suite`` would say of it, and the values of
    ``more``, further aggregates of the frame. Uniqueness still reads its column
    once. If a rule raises, the frame is written without any, and all are counted
    on the written table.
    """
    totals = _row_totals(set(df.columns), rules)
    seen = Observation(f"{label}-{uuid.uuid4().hex}")
    try:
        written = stage(df.observe(seen, *[c.alias(k) for k, c in totals.items()], *[c.alias(f"more_{k}") for k, c in more.items()]), label)
        found, broken = seen.get, {}
    except Exception:  # noqa: BLE001
        written = stage(df, label)
        found, broken = _counts(written, totals)
        if more:
            rest = written.agg(*[c.alias(f"more_{k}") for k, c in more.items()]).first().asDict()
            found = {**found, **rest}
    return written, _report(written, rules, found, broken), {k: found[f"more_{k}"] for k in more}


def failed_rules(columns: Sequence[str], rules: Sequence[Rule]) -> Column:
    """Names of the row-level rules that a row breaks and that allow no exception, as ``expectation (column)``."""
    found = []
    for rule in rules:
        if rule.column not in columns or isinstance(rule, (ColumnExists, Unique)) or rule.mostly < 1:
            continue
        c = F.col(rule.column)
        bad = c.isNull() if isinstance(rule, NotNull) else F.coalesce(rule.violated(c), F.lit(False))
        found.append(F.when(bad, F.lit(f"{rule.name} ({rule.column})")))
    return F.array_distinct(F.array_compact(F.array(*found))) if found else F.array().cast("array<string>")


def summarise(results: DataFrame) -> DataFrame:
    """One row: rules passed, failed and in total, and the success rate in percent."""
    return results.agg(
        F.count_if("success").alias("passed"), F.count_if(~F.col("success")).alias("failed"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("success_rate", F.when(F.col("total") > 0, F.col("passed") * 100.0 / F.col("total")).otherwise(0.0))


def failures(results: DataFrame, n: int | None = None) -> DataFrame:
    """Failed rules in suite order, the first ``n`` if given."""
    failed = results.filter(~F.col("success")).orderBy("index")
    return failed if n is None else failed.limit(n)


def enforce(results: DataFrame) -> None:
    """Raise with one line per failed rule; a suite bounds how many there are."""
    failed = failures(results).collect()
    if failed:
        lines = [
            f"[{r['index']}] {r['expectation']} ({r['column']}): "
            + (r["error"] or f"{r['unexpected']} of {r['total']} unexpected")
            for r in failed
        ]
        raise ValueError("validation failed:\n" + "\n".join(lines))


def failing_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows (for Unique: the repeated values) that break a rule; empty means passed."""
    c = F.col(rule.column)
    if isinstance(rule, NotNull):
        return df.filter(c.isNull())
    if isinstance(rule, Unique):
        return df.filter(c.isNotNull()).groupBy(rule.column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return df.filter(rule.violated(c))


# --- engine-style checks --------------------------------------------------------------

def null_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold at least one null, found in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c] > 0]


def duplicate_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows minus distinct keys (null keys count as keys), as one row."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def type_mismatches(df: DataFrame, expected: Mapping[str, str]) -> list[str]:
    """Columns whose type is not the expected one."""
    actual = dict(df.dtypes)
    return [c for c, kind in expected.items() if actual.get(c) != kind]


# --- suites -----------------------------------------------------------------------------

URL_START = r"^https?://"
URL_FULL = r"^https?://.+"
DATE_START = r"^\d{4}-\d{2}-\d{2}"


def bronze_suite() -> list[Rule]:
    return [
        *[ColumnExists(c) for c in ("id", "url", "title", "published", "language")],
        *[NotNull(c) for c in ("id", "url", "title")],
        MatchesRegex("url", 0.9, URL_START),
        MatchesRegex("published", 0.9, DATE_START),
    ]


def silver_suite(source_system: str = "currentsapi") -> list[Rule]:
    required = (
        "id", "url", "title", "published_at", "sf_id", "language", "layer", "source_system", "source_news")
    return [
        *[ColumnExists(c) for c in required],
        *[NotNull(c) for c in ("id", "url", "published_at", "sf_id")],
        MatchesRegex("url", regex=URL_FULL),
        MatchesRegex("published_at", regex=DATE_START),
        Unique("url"),
        LengthBetween("title", low=1, high=5000),
        InSet("layer", values=("silver",)),
        InSet("source_system", values=(source_system,)),
    ]


def combined_suite() -> list[Rule]:
    return [
        *[ColumnExists(c) for c, _ in COMBINED_COLUMNS],
        *[NotNull(c) for c in ("url", "published_at", "sf_id", "layer")],
        MatchesRegex("url", regex=URL_FULL),
        MatchesRegex("published_at", regex=DATE_START),
        Unique("url"),
        LengthBetween("title", low=1, high=5000),
        InSet("layer", values=("silver",)),
        InSet("activedata", values=(True, False)),
    ]


# model tests of the combined layer, by model
MODEL_TESTS: dict[str, list[Rule]] = {
    "combined": [
        NotNull("url"), Unique("url"), NotNull("published_at"), NotNull("source_name"),
        InSet("activedata", values=(True, False)),
    ],
    "currentsapi": [Unique("url"), NotNull("url")],
    "mediastack": [Unique("url"), NotNull("url")],
    "newsapi": [Unique("url"), NotNull("url")],
    "staging": [NotNull("url")],
}


def validate(spark: SparkSession, source: Any, rules: Sequence[Rule]) -> DataFrame:
    """Run a suite on a frame, a Parquet path or a SQL text."""
    from newsloom.sources.readers import as_frame

    return run_suite(as_frame(spark, source), rules)
