"""Expectations on rows and checks on tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REPORT = "check_name string, passed boolean, failing_rows bigint, detail string"


@dataclass(frozen=True)
class Expectation:
    """A row predicate and what to do where it is not true: ``warn``, ``drop`` or ``fail``."""

    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ("warn", "drop", "fail"):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# Names and predicates of the checks on cleaned comments.
VALID_COMMENT_ID = Expectation("valid_comment_id", "comment_id IS NOT NULL")
HAS_TEXT = Expectation("has_text", "LENGTH(text) > 0")
SILVER_EXPECTATIONS = (VALID_COMMENT_ID, HAS_TEXT)


def apply_expectations(df: DataFrame, expectations: Sequence[Expectation], observe_as: str | None = None) -> DataFrame:
    """Count violations in the same pass that produces the rows, then drop or fail as asked.

    With ``observe_as`` the counts (one per expectation, plus ``rows``) appear under that name in an
    ``Observation``, or in the progress of a streaming query.
    """
    if observe_as:
        df = df.observe(
            observe_as,
            F.count(F.lit(1)).alias("rows"),
            *[F.count_if(~e.holds).alias(e.name) for e in expectations],
        )
    for e in expectations:
        if e.action == "drop":
            df = df.filter(e.holds)
        elif e.action == "fail":
            stop = F.raise_error(F.lit(f"expectation {e.name} violated: {e.predicate}")).cast("boolean")
            df = df.filter(F.when(e.holds, F.lit(True)).otherwise(stop))
    return df


def quarantine(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The rows that some expectation rejects, with the names of those expectations."""
    broken = F.array_compact(F.array(*[F.when(~e.holds, F.lit(e.name)) for e in expectations]))
    return df.withColumn("violated", broken).filter(F.size("violated") > 0)


def expectation_report(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """``expectation, action, passed_rows, failed_rows``, all from one pass."""
    total = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(e.holds).alias(e.name) for e in expectations]
    )
    rows = [
        F.struct(
            F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action"),
            F.col(e.name).alias("passed_rows"), (F.col("_rows") - F.col(e.name)).alias("failed_rows"),
        )
        for e in expectations
    ]
    return total.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@dataclass(frozen=True)
class TableChecks:
    """Checks of one table, evaluated in one aggregate.

    ``none_where``: the predicate must be true for no row (NULL is no proof, so it passes).
    ``all_where``: the predicate must be true for every row (so NULL fails).
    ``columns``: must exist.  ``not_empty``: at least one row.
    """

    not_empty: bool = True
    none_where: Mapping[str, str] | None = None
    all_where: Mapping[str, str] | None = None
    columns: Sequence[str] = ()


def check_table(name: str, df: DataFrame, checks: TableChecks) -> DataFrame:
    """Report rows ``check_name, passed, failing_rows, detail`` of one table."""
    none = list((checks.none_where or {}).items())
    every = list((checks.all_where or {}).items())
    facts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.expr(p)).alias(f"_bad{i}") for i, (_, p) in enumerate(none)],
        *[F.count_if(F.expr(p)).alias(f"_ok{i}") for i, (_, p) in enumerate(every)],
    )

    def row(label: str, passed: Column, failing: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(f"{name}: {label}").alias("check_name"), passed.alias("passed"),
            failing.cast("bigint").alias("failing_rows"), detail.cast("string").alias("detail"),
        )

    rows = []
    if checks.not_empty:
        some = F.col("_rows") > 0
        rows.append(row("has rows", some, F.lit(0), F.when(~some, F.lit("table empty"))))
    for c in checks.columns:
        here = c in df.columns
        rows.append(row(f"has {c}", F.lit(here), F.lit(0), F.lit(None if here else f"missing column {c}")))
    for label, bad in [(label, F.col(f"_bad{i}")) for i, (label, _) in enumerate(none)] + [
        (label, F.col("_rows") - F.col(f"_ok{i}")) for i, (label, _) in enumerate(every)
    ]:
        rows.append(row(label, bad == 0, bad, F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" rows")))))
    return facts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_tables(
    spark: SparkSession, tables: Mapping[str, tuple[Callable[[], DataFrame], TableChecks]]
) -> DataFrame:
    """One report over several tables.  A table that cannot be found or read becomes a failed row.

    Every table is looked at here, in one aggregate; its few report rows come back to the driver, so that
    a broken file of one table does not take the report of the others with it.
    """
    rows: list[tuple] = []
    for name, (load, checks) in tables.items():
        try:
            rows += [tuple(r) for r in check_table(name, load(), checks).collect()]
        except (PySparkException, Py4JJavaError) as e:
            rows.append((f"{name}: accessible", False, 0, str(e).splitlines()[0]))
    return spark.createDataFrame(rows, REPORT)


def report_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
    )


def coverage(expected: DataFrame, present: DataFrame, key: str, minimum: float = 0.5) -> DataFrame:
    """Share of ``expected`` keys that ``present`` holds, and whether it is above ``minimum``."""
    found = present.select(key).distinct().withColumn("_found", F.lit(1))
    ratio = F.col("covered") / F.nullif(F.col("expected"), F.lit(0))
    return (
        expected.select(key).distinct().join(found, key, "left")
        .agg(F.count(F.lit(1)).alias("expected"), F.count("_found").alias("covered"))
        .select("expected", "covered", F.round(ratio, 4).alias("coverage"),
                F.coalesce(ratio > minimum, F.lit(False)).alias("passed"))
    )
