"""Declarative table checks.

Every check yields rows of one shape (table, check, column, failing_rows,
status), so a whole run is one unioned DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions.time import Moment, instant, width

RESULT_COLUMNS = ("table", "check", "column", "failing_rows", "status")


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class TableChecks:
    not_null: Sequence[str] = ()
    unique: Sequence[str] = ()
    accepted: Mapping[str, Sequence] | None = None
    relationships: Sequence[Relationship] = ()


def _result(table: str, check: str, column: str, failing: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.lit(column).alias("column"),
        failing.cast("bigint").alias("failing_rows"),
        F.when(failing > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("status"),
    )


def check_rows(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    accepted: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """All row-wise checks of a table in one scan and one aggregate.

    A NULL passes ``accepted_values``; that is what ``not_null`` is for.
    """
    accepted = accepted or {}
    counts, results = [], []
    for column in not_null:
        name = f"n{len(counts)}"
        counts.append(F.count_if(F.col(column).isNull()).alias(name))
        results.append(_result(table, "not_null", column, F.col(name)))
    for column, values in accepted.items():
        name = f"n{len(counts)}"
        counts.append(F.count_if(~F.col(column).isin(list(values))).alias(name))
        results.append(_result(table, "accepted_values", column, F.col(name)))
    return df.agg(*counts).select(F.inline(F.array(*results)))


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    return check_rows(df, table, not_null=columns)


def check_accepted(df: DataFrame, table: str, accepted: Mapping[str, Sequence]) -> DataFrame:
    return check_rows(df, table, accepted=accepted)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def check_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Failing rows are the duplicated key values; NULLs are ignored."""
    repeated = duplicate_keys(df.filter(F.col(column).isNotNull()), [column])
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        F.inline(F.array(_result(table, "unique", column, F.col("n"))))
    )


def check_relationship(
    child: DataFrame, parent: DataFrame, table: str, column: str, parent_column: str
) -> DataFrame:
    """Child rows whose non-NULL reference has no parent.

    References are counted per value first, so a hot orphan crosses the join
    once instead of once per row.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_ref"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    members = parent.select(F.col(parent_column).alias("_ref"))
    orphans = used.join(members, "_ref", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")).select(
        F.inline(F.array(_result(table, "relationships", column, F.col("n"))))
    )


def check_freshness(
    df: DataFrame,
    table: str,
    as_of: Moment,
    warn_after: str,
    error_after: str,
    column: str = "_ingested_at",
) -> DataFrame:
    """One row ``pass``, ``warn`` or ``error`` by the age of the newest row.

    An empty table has no newest row and counts as an error.
    """
    newest = F.col("newest")
    status = (
        F.when(newest.isNull() | (newest < instant(as_of) - width(error_after)), "error")
        .when(newest < instant(as_of) - width(warn_after), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(column).alias("newest")).select(
        F.lit(table).alias("table"),
        F.lit("freshness").alias("check"),
        F.lit(column).alias("column"),
        F.when(status == "pass", 0).otherwise(1).cast("bigint").alias("failing_rows"),
        status.alias("status"),
    )


def run_checks(tables: Mapping[str, DataFrame], checks: Mapping[str, TableChecks]) -> DataFrame:
    """Result rows of every check of every table."""
    parts: list[DataFrame] = []
    for name, spec in checks.items():
        df = tables[name]
        if spec.not_null or spec.accepted:
            parts.append(check_rows(df, name, spec.not_null, spec.accepted))
        parts.extend(check_unique(df, name, column) for column in spec.unique)
        parts.extend(
            check_relationship(df, tables[r.parent], name, r.column, r.parent_column)
            for r in spec.relationships
        )
    return reduce(DataFrame.unionByName, parts)


class QualityError(RuntimeError):
    """A table does not keep its promises."""


def require_passing(results: DataFrame) -> None:
    """Stop a job whose tables fail a check; one result row per check is read."""
    failed = results.filter(F.col("status") != "pass").collect()
    if failed:
        raise QualityError(
            "; ".join(
                f"{r['table']}.{r['column']} {r['check']}: {r['failing_rows']}" for r in failed
            )
        )


def missing_periods(
    observed: DataFrame, ts: str, start: Moment, end: Moment, step: str
) -> DataFrame:
    """Periods of a regular series, ``start`` to ``end`` inclusive, that no row has."""
    spark = observed.sparkSession
    spine = spark.range(1).select(
        F.explode(
            F.sequence(
                instant(start).cast("timestamp"), instant(end).cast("timestamp"), width(step)
            )
        ).alias("period")
    )
    seen = observed.select(F.col(ts).cast("timestamp").alias("period")).distinct()
    return spine.join(seen, "period", "left_anti")


def orphan_rate(df: DataFrame, column: str) -> DataFrame:
    """Share of rows whose dimension lookup found nothing."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(column).isNull()).alias("orphan_rows"),
        F.try_divide(
            F.count_if(F.col(column).isNull()).cast("double"), F.count(F.lit(1))
        ).alias("orphan_rate"),
    )
