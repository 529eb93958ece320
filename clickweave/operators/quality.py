"""Data-quality checks. All value checks of a table run in one aggregation pass."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clickweave.session import written

# What makes a person record acceptable, in the order the rules are tried.
PERSON_RULES = {
    "missing id": "id IS NOT NULL",
    "age out of range": "age >= 0 AND age <= 150",
    "bad email": r"email RLIKE '^[^@]+@[^@]+\\.[^@]+$'",
}

# Values as JSON text that differs wherever they do: microseconds, era and the seconds of an offset included.
EXACT_JSON = {
    "timestampFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
    "timestampNTZFormat": "G yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "G yyyy-MM-dd",
}


REPORT = "check_name string, column_name string, violations bigint, row_count bigint"


# Types whose values differ as text wherever they differ.
PLAIN = ("string", "tinyint", "smallint", "int", "bigint", "boolean", "date")


class QualityError(ValueError):
    """A table does not meet its declared expectations."""


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise QualityError(f"missing columns: {missing}")
    return df


def require_schema(df: DataFrame, schema: StructType) -> DataFrame:
    if df.schema != schema:
        raise QualityError(f"schema is {df.schema.simpleString()}, not {schema.simpleString()}")
    return df


def require_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    require_columns(df, list(types))
    actual = {name: df.schema[name].dataType.simpleString() for name in types}
    wrong = {n: (actual[n], expected) for n, expected in types.items() if actual[n] != expected}
    if wrong:
        raise QualityError(f"column types (found, expected): {wrong}")
    return df


def quality_report(
    df: DataFrame,
    min_rows: int | None = None,
    not_null: list[str] = (),
    ranges: dict[str, dict[str, Any]] | None = None,
    allowed: dict[str, list[Any]] | None = None,
) -> DataFrame:
    """One row per check: its name, column, number of violations and the rows looked at."""
    checks = _checks(min_rows, not_null, ranges, allowed)
    row = F.array(
        *[
            F.struct(
                F.lit(check).alias("check_name"),
                F.lit(name).alias("column_name"),
                violations.cast("bigint").alias("violations"),
                F.count(F.lit(1)).alias("row_count"),
            )
            for check, name, violations in checks
        ]
    )
    return df.agg(row.alias("checks")).select(F.inline("checks"))


def _checks(min_rows, not_null=(), ranges=None, allowed=None) -> list[tuple[str, str, Column]]:
    """Name, column and number of violations of each check."""
    checks: list[tuple[str, str, Column]] = []
    if min_rows is not None:
        checks.append(("min_rows", "*", F.greatest(F.lit(min_rows) - F.count(F.lit(1)), F.lit(0))))
    for name in not_null:
        checks.append(("not_null", name, F.count_if(F.col(name).isNull())))
    for name, bounds in (ranges or {}).items():
        checks.append(("range", name, F.count_if(_outside(F.col(name), bounds))))
    for name, values in (allowed or {}).items():
        # A null is not one of the allowed values unless the list says so.
        in_list = F.coalesce(F.col(name).isin([v for v in values if v is not None]), F.lit(None in values))
        checks.append(("allowed", name, F.count_if(~in_list)))
    return checks


def _outside(value: Column, bounds: dict[str, Any]) -> Column:
    """True for a value beyond a bound; nulls are the business of the null check."""
    if not bounds.keys() & {"min", "max"}:
        raise ValueError("a range needs a min, a max or both")
    tests = [value < bounds["min"]] if "min" in bounds else []
    tests += [value > bounds["max"]] if "max" in bounds else []
    return tests[0] | tests[1] if len(tests) == 2 else tests[0]


def checked_writer(
    write: Callable[[DataFrame, int], bool | None], reports: str, most_share: float | None = None, **expectations
) -> Callable[[DataFrame, int], None]:
    """A function for ``foreachBatch`` that writes with ``write`` and reports on what it has written.

    The checks are metrics that ride along with the write, so a batch is read once. ``write`` has to write all rows in one
    action, or return False if it has the batch already. Each batch leaves its report under ``reports``, which a batch that runs again replaces; ``stream_report``
    adds them up. If more than ``most_share`` of a batch's rows break a check, the report is kept and the batch fails with a
    ``QualityError``, which stops the stream before it takes the next one; with a ``batch_writer`` the rows are there once however
    often the stream is started again.
    """
    checks = _checks(None, **expectations)
    if not checks:
        raise ValueError("nothing to check")

    def checked(batch: DataFrame, batch_id: int) -> None:
        path, spark = f"{reports}/batch={batch_id}", batch.sparkSession
        seen = Observation()
        metrics = [violations.cast("bigint").alias(f"check_{i}") for i, (_, _, violations) in enumerate(checks)]
        again = write(batch.observe(seen, F.count(F.lit(1)).alias("row_count"), *metrics), batch_id) is False
        if again and written(spark, path):
            rows = [tuple(r) for r in spark.read.schema(REPORT).parquet(path).collect()]
        elif again:
            # It broke off between the rows and their report.
            rows = [tuple(r) for r in quality_report(batch, **expectations).collect()]
        else:
            found = seen.get
            rows = [(name, column, found[f"check_{i}"], found["row_count"]) for i, (name, column, _) in enumerate(checks)]
        spark.createDataFrame(rows, REPORT).coalesce(1).write.mode("overwrite").parquet(path)
        wrong = [f"{name}({column}): {n} of {total}" for name, column, n, total in rows if most_share is not None and n > most_share * total]
        if wrong:
            raise QualityError(f"batch {batch_id}: {'; '.join(wrong)}")

    return checked


def stream_report(spark: SparkSession, reports: str, min_rows: int | None = None) -> DataFrame:
    """The report of everything that a ``checked_writer`` has written so far, in the columns of ``quality_report``."""
    batches = spark.read.schema(REPORT).parquet(f"{reports}/batch=*")
    found = batches.groupBy("check_name", "column_name").agg(F.sum("violations").alias("violations"), F.sum("row_count").alias("row_count"))
    if min_rows is not None:
        few = F.greatest(F.lit(min_rows) - F.max("row_count"), F.lit(0)).cast("bigint")
        total = found.agg(F.lit("min_rows").alias("check_name"), F.lit("*").alias("column_name"), few.alias("violations"), F.max("row_count").alias("row_count"))
        found = total.unionByName(found)
    return found


def enforce(df: DataFrame, **expectations) -> DataFrame:
    """Run ``quality_report`` now and raise if any check is violated."""
    failed = quality_report(df, **expectations).filter("violations > 0").collect()
    if failed:
        raise QualityError("; ".join(f"{r.check_name}({r.column_name}): {r.violations}" for r in failed))
    return df


def uniqueness_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: rows, different values (null counts as one) and surplus rows."""
    # One scan: each row is taken apart into (column, value), and values are counted before they are shuffled.
    def text(name: str) -> Column:
        value, kind = F.col(name), dict(df.dtypes)[name]
        if kind in ("float", "double"):
            # Adding zero makes -0.0 and 0.0 the same.
            value = value + 0.0
        elif kind == "timestamp":
            value = F.unix_micros(value)
        elif kind not in PLAIN and not kind.startswith("decimal"):
            # A null field is left out of the JSON.
            return F.to_json(F.struct(value.alias("v")), EXACT_JSON)
        return F.coalesce(F.concat(F.lit("v"), value.cast("string")), F.lit("null"))

    cells = F.array(*[F.struct(F.lit(name).alias("column_name"), text(name).alias("value")) for name in columns])
    values = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    found = values.groupBy("column_name").agg(F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_count"))
    # An empty table has no cells, but a report.
    names = df.sparkSession.createDataFrame([(name,) for name in columns], "column_name string")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("row_count", "distinct_count")]
    return (
        names.join(found, "column_name", "left")
        .select(*counts, "column_name")
        .select("row_count", "distinct_count", (F.col("row_count") - F.col("distinct_count")).alias("duplicates"), "column_name")
    )


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """The values that occur more than once, with their counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


def disallowed_values(df: DataFrame, column: str, allowed: list[Any]) -> DataFrame:
    """Values outside a list, with their counts; the table's values never reach the driver."""
    in_list = F.coalesce(F.col(column).isin(allowed), F.lit(False))
    return df.filter(~in_list).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


def first_failure(rules: dict[str, str]) -> Column:
    """The name of the first rule a row breaks, null for a good row. An unknown result fails."""
    return F.coalesce(
        *[F.when(~F.coalesce(F.expr(test), F.lit(False)), F.lit(name)) for name, test in rules.items()]
    )


def clean_rows(df: DataFrame, rules: dict[str, str] = PERSON_RULES) -> DataFrame:
    """Rows that satisfy every rule; each predicate reaches the scan as a plain filter."""
    for test in rules.values():
        df = df.filter(test)
    return df


def rejected_rows(df: DataFrame, rules: dict[str, str] = PERSON_RULES) -> DataFrame:
    """The other rows, with the first rule each one breaks in ``reject_reason``."""
    return df.withColumn("reject_reason", first_failure(rules)).filter("reject_reason IS NOT NULL")


def cleanse(df: DataFrame, timestamp_column: str | None = None, stamp: bool = True) -> DataFrame:
    """Drop rows with any null and exact duplicates, format the time, trim all text columns."""
    result = df.dropna(how="any").dropDuplicates()
    if timestamp_column:
        text = F.date_format(timestamp_column, "yyyy-MM-dd HH:mm:ss")
        result = result.withColumn(f"{timestamp_column}_formatted", text)
    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    if strings:
        result = result.withColumns({name: F.trim(F.col(name)) for name in strings})
    return result.withColumn("processing_timestamp", F.current_timestamp()) if stamp else result


def dataset_info(df: DataFrame) -> DataFrame:
    """One row: column count, schema text, row count and non-empty partitions."""
    return (
        df.withColumn("_partition", F.spark_partition_id())
        .groupBy("_partition")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
            F.count(F.lit(1)).alias("partition_count"),
        )
        .withColumn("column_count", F.lit(len(df.columns)))
        .withColumn("schema_text", F.lit(df.schema.simpleString()))
    )
