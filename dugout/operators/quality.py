"""Data checks. Each returns a small table; ``require`` turns failures into an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType


class CheckFailed(ValueError):
    """Raised by strict checks; the message lists every failure."""


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, n_rows, n_nulls, null_pct`` for all listed columns, in one aggregation."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)],
    )
    entries = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col("n_rows"), F.col(f"n{i}").alias("n_nulls"))
            for i, c in enumerate(columns)
        ]
    )
    return counts.select(F.explode(entries).alias("e")).select(
        "e.*", F.try_divide(F.col("e.n_nulls") * F.lit(100.0), F.col("e.n_rows")).alias("null_pct")
    )


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only the columns that have missing values."""
    return null_profile(df, columns).filter("n_nulls > 0")


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows that break the not-null rule, per column."""
    return null_profile(df, columns).select(
        F.lit(table).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        F.col("column").alias("column_name"),
        F.col("n_nulls").alias("failures"),
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-NULL keys that occur more than once, with their count."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .filter("n > 1")
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of keys that break the uniqueness rule."""
    return repeated_keys(df, column).agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit("unique").alias("check_name"),
        F.lit(column).alias("column_name"),
        F.col("failures"),
    )


def contracts(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, Sequence[str]]]
) -> DataFrame:
    """Run ``{table: {"not_null": [...], "unique": [...]}}`` and report every rule."""
    reports = []
    for table, rule in rules.items():
        df = tables[table]
        if rule.get("not_null"):
            reports.append(not_null(df, table, rule["not_null"]))
        reports.extend(unique(df, table, column) for column in rule.get("unique", ()))
    report = reduce(DataFrame.unionByName, reports)
    return report.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


def freshness(
    df: DataFrame, column: str, as_of: datetime, warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """Age of the newest ``column`` at ``as_of``; an empty table is an error."""
    newest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("newest"))
    moment = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", F.col("newest"), moment)
    age = (seconds / F.lit(3600.0)).alias("age_hours")
    return newest.select(
        "newest",
        age,
        F.when(F.col("newest").isNull() | (seconds > error_hours * 3600), "error")
        .when(seconds > warn_hours * 3600, "warn")
        .otherwise("pass")
        .alias("status"),
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows`` for every table."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def volume(tables: Mapping[str, DataFrame], floors: Mapping[str, int]) -> DataFrame:
    """Row counts against their floors: ``ok`` from the floor on, else ``FAIL``."""
    from ..functions.lookups import lookup

    counted = row_counts({name: tables[name] for name in floors})
    floor = lookup(F.col("table_name"), {k: int(v) for k, v in floors.items()}).cast("bigint")
    return counted.withColumn("min_rows", floor).withColumn(
        "status", F.when(F.col("n_rows") >= F.col("min_rows"), "ok").otherwise("FAIL")
    )


def require(report: DataFrame, failed: Column, text: Column, title: str) -> None:
    """Raise with all failing lines of a check report (one line per rule, so few)."""
    lines = [row[0] for row in report.filter(failed).select(text).collect()]
    if lines:
        raise CheckFailed(title + "\n" + "\n".join(sorted(lines)))


def require_columns(df: DataFrame, name: str, columns: Sequence[str]) -> None:
    """Fail before any job runs if a column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise CheckFailed(f"{name}: missing expected columns {missing}")


def input_report(df: DataFrame, name: str, required: Sequence[str]) -> DataFrame:
    """One line about an input: rows, columns, status and the required columns with NULLs.

    An empty input is reported as ``empty`` and passes, as does one with NULLs
    (``nulls``); a missing column raises.
    """
    require_columns(df, name, required)
    rates = F.map_from_entries(F.collect_list(F.struct("column", "null_pct")))
    profile = null_profile(df, required)
    flagged = F.filter(
        F.map_entries(F.col("rates")), lambda entry: entry["value"] > 0
    )
    return (
        profile.groupBy("n_rows")
        .agg(rates.alias("rates"))
        .select(
            F.lit(name).alias("input_name"),
            "n_rows",
            F.lit(len(df.columns)).alias("n_columns"),
            F.map_from_entries(flagged).alias("null_pct"),
        )
        .withColumn(
            "status",
            F.when(F.col("n_rows") == 0, "empty")
            .when(F.size("null_pct") > 0, "nulls")
            .otherwise("ok"),
        )
    )


def volume_anomalies(
    df: DataFrame, group: str, day: Column, history: int = 7, width: float = 2.0
) -> DataFrame:
    """Rows per group and day against the ``history`` days before it.

    Flagged where the count is more than ``width`` standard deviations from their mean.
    Days without a full history have no mean and no flag. The window runs on daily
    counts, so a group is as long as the calendar, not as its data.
    """
    daily = df.groupBy(F.col(group), day.alias("day")).agg(F.count("*").alias("n"))
    past = Window.partitionBy(group).orderBy("day").rowsBetween(-history, -1)
    full = F.count("*").over(past) == history
    mean = F.when(full, F.avg("n").over(past))
    spread = F.when(full, F.stddev_samp("n").over(past))
    return daily.select(group, "day", "n", mean.alias("mean_n"), spread.alias("std_n")).withColumn(
        "is_anomaly", F.abs(F.col("n") - F.col("mean_n")) > F.lit(width) * F.col("std_n")
    )


def schema_changes(before: StructType, after: StructType) -> list[tuple[str, str, str]]:
    """``(column, change, detail)`` for every column added, removed or retyped."""
    old = {f.name: f.dataType.simpleString() for f in before.fields}
    new = {f.name: f.dataType.simpleString() for f in after.fields}
    changes = [(c, "removed", old[c]) for c in old if c not in new]
    changes += [(c, "added", new[c]) for c in new if c not in old]
    changes += [
        (c, "retyped", f"{old[c]} -> {new[c]}") for c in old if c in new and old[c] != new[c]
    ]
    return sorted(changes)
