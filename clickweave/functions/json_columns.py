"""JSON text columns: typed parsing and field extraction, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.schema import to_schema


def parse_json(
    df: DataFrame,
    schema,
    value_column: str = "value",
    keep_value: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Parse a JSON column by a declared schema and lift its fields to the top level.

    An envelope column called ``timestamp`` becomes ``kafka_timestamp`` so that it cannot clash
    with a field of the message. Malformed text gives null fields; with ``corrupt_column`` the
    text itself is kept in a column of that name. ``from_json`` does not enforce
    ``nullable=False``: filter the required fields explicitly.
    """
    fields = to_schema(schema)
    options = {}
    if corrupt_column:
        fields = fields.add(corrupt_column, "string") if corrupt_column not in fields.names else fields
        options["columnNameOfCorruptRecord"] = corrupt_column
    if "timestamp" in df.columns:
        df = df.withColumnRenamed("timestamp", "kafka_timestamp")
    kept = [c for c in df.columns if keep_value or c != value_column]
    parsed = F.from_json(F.col(value_column).cast("string"), fields, options)
    # As a generator, the text is parsed once per row. In a projection, each later filter on a
    # field would be pushed below it together with another copy of the parser.
    return df.select(*kept, F.inline(F.array(parsed)))


def extract_fields(df: DataFrame, names: list[str], value_column: str = "value") -> DataFrame:
    """Pull named top-level fields out of a JSON column as strings, without a schema."""
    return df.withColumns(
        {name: F.get_json_object(F.col(value_column).cast("string"), f"$.{name}") for name in names}
    )


def parse_variant(df: DataFrame, value_column: str = "value", name: str = "variant") -> DataFrame:
    """Add a JSON column as a VARIANT, for messages whose fields nobody has declared. Malformed text gives null.

    The text is parsed once per row, whatever is read from the variant later.
    """
    parsed = F.struct(F.try_parse_json(F.col(value_column).cast("string")).alias(name))
    # As a generator, for the reason given in ``parse_json``.
    return df.select("*", F.inline(F.array(parsed)))


def variant_fields(df: DataFrame, fields: dict[str, tuple[str, str]], variant: str = "variant") -> DataFrame:
    """Columns from a VARIANT: ``fields`` gives a path such as ``$.a.b[0]`` and a type for each name.

    A path that is not there, or a value that is not of the type, gives null.
    """
    return df.withColumns({name: F.try_variant_get(variant, path, kind) for name, (path, kind) in fields.items()})


def found_schema(df: DataFrame, value_column: str = "value") -> DataFrame:
    """One row: the ``schema`` that holds all JSON texts of a column, and how many there are, malformed ones apart.

    Schemas of rows are merged like counts are, before and after the shuffle, so nothing but one schema per task moves.
    """
    parsed = parse_variant(df.select(value_column), value_column, "parsed")
    malformed = F.col("parsed").isNull() & F.col(value_column).isNotNull()
    return parsed.agg(
        F.schema_of_variant_agg("parsed").alias("schema"),
        F.count("parsed").alias("parsed"),
        F.count_if(malformed).alias("malformed"),
    )


def with_processing_time(df: DataFrame, column: str = "processing_time") -> DataFrame:
    """Stamp every row with the time the query started."""
    return df.withColumn(column, F.current_timestamp())
