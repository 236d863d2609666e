"""Data-quality checks. Each returns rows ``check, status, observed, expected``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelake.functions.events import before
from tidelake.operators.dimensions import orphans

CHECK_COLUMNS = "check string, status string, observed string, expected string"


def _verdict(name: str, ok: Column, observed: Column, expected: Column) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        F.when(ok, "OK").otherwise("FAIL").alias("status"),
        observed.cast("string").alias("observed"),
        expected.cast("string").alias("expected"),
    ]


def check_types(df: DataFrame, expected: dict[str, tuple[str, ...]], name: str = "types") -> DataFrame:
    """One row per column: is its type among the expected ones?"""
    found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        (f"{name}:{c}", "OK" if found.get(c) in allowed else "FAIL", found.get(c), "|".join(allowed))
        for c, allowed in expected.items()
    ]
    return df.sparkSession.createDataFrame(rows, CHECK_COLUMNS)


def check_count(df: DataFrame, expected: int, name: str = "count") -> DataFrame:
    n = F.count(F.lit(1))
    return df.agg(n.alias("n")).select(*_verdict(name, F.col("n") == expected, F.col("n"), F.lit(expected)))


def check_values(df: DataFrame, column: str, expected: list[str], name: str = "values") -> DataFrame:
    """One row per expected value: does the column contain it?"""
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], "_wanted string")
    present = df.filter(F.col(column).isin(expected)).select(F.col(column).alias("_found")).distinct()
    seen = F.col("_found").isNotNull()
    return wanted.join(present, F.col("_wanted") == F.col("_found"), "left").select(
        F.concat(F.lit(f"{name}:"), "_wanted").alias("check"),
        F.when(seen, "OK").otherwise("FAIL").alias("status"),
        F.when(seen, "present").otherwise("missing").alias("observed"),
        F.lit("present").alias("expected"),
    )


def check_fk(child: DataFrame, parent: DataFrame, key: str, name: str = "fk") -> DataFrame:
    missing = orphans(child, parent, key).agg(F.count(F.lit(1)).alias("n"))
    return missing.select(*_verdict(name, F.col("n") == 0, F.col("n"), F.lit(0)))


def check_unique(df: DataFrame, key: str, name: str = "unique") -> DataFrame:
    """Does every key value come once? A repeated key of a catalog would multiply the facts joined with it."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").agg(F.count(F.lit(1)).alias("n"))
    return repeated.select(*_verdict(name, F.col("n") == 0, F.col("n"), F.lit(0)))


def check_sequence(df: DataFrame, part: str, order: str) -> DataFrame:
    """One row per partition: does ``order`` run 1..n? Duplicates are reported before gaps.

    Counting happens per (part, order) first, so a dominant partition is spread
    over its values before the per-partition summary.
    """
    counted = df.groupBy(part, order).agg(F.count(F.lit(1)).alias("_n"))
    summary = counted.groupBy(part).agg(
        F.sum("_n").alias("n"),
        F.count(order).alias("n_distinct"),
        F.min(order).alias("first"),
        F.max(order).alias("last"),
    )
    problem = (
        F.when(F.col("n") != F.col("n_distinct"), "duplicate")
        .when((F.col("first") != 1) | (F.col("last") != F.col("n")), "gap")
        .otherwise("none")
    )
    return summary.select(part, "n", "first", "last", problem.alias("problem"))


def sequence_offenders(df: DataFrame, part: str, order: str) -> DataFrame:
    """Repeated values and values whose predecessor is missing.

    Both are found by (part, order) keys; no partition is ever sorted in one task.
    """
    counted = df.groupBy(part, order).agg(F.count(F.lit(1)).alias("times"))
    repeated = counted.filter("times > 1").select(part, order, F.lit("duplicate").alias("problem"))
    following = counted.filter(F.col(order) != 1).select(part, order, (F.col(order) - 1).alias("_previous"))
    known = counted.select(F.col(part).alias("_part"), F.col(order).alias("_order"))
    jumps = following.join(
        known, (F.col(part) == F.col("_part")) & (F.col("_previous") == F.col("_order")), "left_anti"
    )
    return repeated.unionByName(jumps.select(part, order, F.lit("gap_before").alias("problem")))


def check_fresh(df: DataFrame | None, ts_col: str, seconds: int, as_of: Column | str, name: str,
                spark: SparkSession | None = None) -> DataFrame:
    """Status of the newest time: OK, STALE, EMPTY, NO_TS, or MISSING for an absent table."""
    if df is None:
        return spark.createDataFrame([(name, "MISSING", None)], "table string, status string, newest timestamp")
    newest = df.agg(F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("newest"))
    status = (
        F.when(F.col("n") == 0, "EMPTY")
        .when(F.col("newest").isNull(), "NO_TS")
        .when(F.col("newest") >= before(as_of, seconds), "OK")
        .otherwise("STALE")
    )
    return newest.select(F.lit(name).alias("table"), status.alias("status"), "newest")


def check_exists(df: DataFrame | None, ts_col: str, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Row count and newest time of a table that may rightly be old."""
    if df is None:
        return spark.createDataFrame(
            [(name, "MISSING", 0, None)], "table string, status string, n bigint, newest timestamp"
        )
    found = df.agg(F.count(F.lit(1)).alias("n"), F.max(ts_col).alias("newest"))
    status = F.when(F.col("n") > 0, "OK_EXISTS").otherwise("EMPTY")
    return found.select(F.lit(name).alias("table"), status.alias("status"), "n", "newest")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of every table."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table"), "n") for t, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def check_nonempty(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: has it any rows?"""
    return row_counts(tables).select(
        F.concat(F.lit("nonempty:"), "table").alias("check"),
        F.when(F.col("n") > 0, "OK").otherwise("FAIL").alias("status"),
        F.col("n").cast("string").alias("observed"),
        F.lit(">0").alias("expected"),
    )


def validate_schema(df: DataFrame, rules: dict) -> DataFrame:
    """Violations of document rules, as warnings: nothing is rejected.

    ``field, violation, rows`` with one row per absent or wrongly typed field and
    per required field that is NULL somewhere; all NULL counts come from one pass.
    """
    spark = df.sparkSession
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found: list[tuple[str, str, int | None]] = []
    for field, allowed in rules["types"].items():
        if field in types and types[field] not in allowed:
            found.append((field, f"type {types[field]}", None))
    found += [(f, "absent", None) for f in rules["required"] if f not in types]
    static = spark.createDataFrame(found, T.StructType.fromDDL("field string, violation string, rows bigint"))
    required = [f for f in rules["required"] if f in types]
    if not required:
        return static
    nulls = df.agg(*[F.count_if(F.col(f).isNull()).alias(f) for f in required])
    missing = nulls.unpivot([], required, "field", "rows").filter("rows > 0")
    return static.unionByName(missing.select("field", F.lit("null").alias("violation"), "rows"))


def report(checks: list[DataFrame]) -> DataFrame:
    """All checks in one table."""
    return reduce(DataFrame.unionByName, checks)


def report_totals(results: DataFrame) -> DataFrame:
    return results.agg(
        F.count_if(F.col("status") == "OK").alias("passed"), F.count_if(F.col("status") != "OK").alias("failed")
    )
