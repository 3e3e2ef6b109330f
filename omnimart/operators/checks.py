"""Declarative table checks, evaluated with as few passes as possible."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from omnimart.operators.keysets import missing_keys

RESULT = ("check", "kind", "table", "violations")


@dataclass(frozen=True)
class RowCheck:
    """Counts rows for which ``fails`` is true."""

    table: str
    name: str
    kind: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class UniqueCheck:
    """Counts values that occur more than once; nulls are left out."""

    table: str
    column: str


@dataclass(frozen=True)
class ParentCheck:
    """Counts rows whose non-null key has no parent."""

    table: str
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class FrameCheck:
    """Counts the rows of a query over the tables."""

    table: str
    name: str
    rows: Callable[[Mapping[str, DataFrame]], DataFrame]


Check = RowCheck | UniqueCheck | ParentCheck | FrameCheck


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(table, f"not_null.{table}.{column}", "not_null", lambda: F.col(column).isNull())


def accepted(table: str, column: str, values: Sequence) -> RowCheck:
    return RowCheck(
        table,
        f"accepted_values.{table}.{column}",
        "accepted_values",
        lambda: ~F.col(column).isin(*values),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One row per check: name, kind, table, violations, status.

    All row checks of a table share one aggregation; a key check is one grouping
    or one anti join on keys that were counted before their shuffle.
    """
    by_table: dict[str, list[RowCheck]] = {}
    parts: list[DataFrame] = []
    for check in checks:
        if isinstance(check, RowCheck):
            by_table.setdefault(check.table, []).append(check)
        elif isinstance(check, UniqueCheck):
            parts.append(_unique(tables[check.table], check))
        elif isinstance(check, ParentCheck):
            parts.append(_parents(tables[check.table], tables[check.parent], check))
        else:
            found = check.rows(tables).agg(F.count("*").alias("violations"))
            parts.append(_labelled(found, f"expression.{check.name}", "expression", check.table))
    parts = [_row_checks(tables[t], found) for t, found in by_table.items()] + parts
    results = reduce(DataFrame.unionByName, parts)
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return results.select(*RESULT, status.alias("status"))


def _labelled(one_row: DataFrame, name: str, kind: str, table: str) -> DataFrame:
    return one_row.select(
        F.lit(name).alias("check"),
        F.lit(kind).alias("kind"),
        F.lit(table).alias("table"),
        F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"),
    )


def _row_checks(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    counted = df.agg(*[F.count_if(c.fails()).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.name).alias("check"),
            F.lit(c.kind).alias("kind"),
            F.lit(c.table).alias("table"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _unique(df: DataFrame, check: UniqueCheck) -> DataFrame:
    found = (
        df.filter(F.col(check.column).isNotNull())
        .groupBy(check.column)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("violations"))
    )
    return _labelled(found, f"unique.{check.table}.{check.column}", "unique", check.table)


def _parents(child: DataFrame, parent: DataFrame, check: ParentCheck) -> DataFrame:
    found = missing_keys(child, check.column, parent, check.parent_column).agg(
        F.sum("row_count").alias("violations")
    )
    return _labelled(
        found, f"relationships.{check.table}.{check.column}", "relationships", check.table
    )


def summary(results: DataFrame) -> DataFrame:
    """Checks per kind and status with the failed names, in one row per kind."""
    return results.groupBy("kind").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "fail").alias("failed"),
        F.array_join(
            F.array_sort(F.collect_list(F.when(F.col("status") == "fail", F.col("check")))), ","
        ).alias("failed_checks"),
    )


def score(results: DataFrame) -> DataFrame:
    """Totals, score in percent at one decimal and overall status, in one row."""
    totals = results.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "pass").alias("passed")
    )
    return totals.select(
        "total",
        "passed",
        (F.col("total") - F.col("passed")).alias("failed"),
        F.round(100.0 * F.col("passed") / F.col("total"), 1).alias("score"),
        F.when(F.col("passed") == F.col("total"), "PASS").otherwise("FAIL").alias("status"),
    )
