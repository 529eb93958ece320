"""Declared schemas: four ways to write one, all ending in a Spark ``StructType``."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql.types import DataType, StructField, StructType

# Short type names used in job files, and the Spark type each one means.
TYPE_ALIASES = {
    "integer": "int",
    "float": "double",
    "bool": "boolean",
}


def spark_type(name: str) -> DataType:
    """A type from its name; anything Spark's own DDL parser accepts, and nothing else."""
    text = name.strip()
    ddl = TYPE_ALIASES.get(text.lower(), text)
    try:
        return StructType.fromDDL(f"c {ddl}")["c"].dataType
    except ParseException as error:
        raise ValueError(f"unknown column type {name!r}") from error


def to_schema(spec: StructType | str | dict[str, Any] | list[dict[str, Any]]) -> StructType:
    """Turn any accepted schema description into a ``StructType``.

    Accepted: a ``StructType``; Spark schema JSON as a string or dict; a DDL string; a flat
    ``{name: type}`` dict; a list of ``{name, type, nullable, fields}`` dicts.
    """
    if isinstance(spec, StructType):
        return spec
    if isinstance(spec, str):
        if spec.lstrip().startswith("{"):
            return StructType.fromJson(json.loads(spec))
        return StructType.fromDDL(spec)
    if isinstance(spec, dict):
        if spec.get("type") == "struct" and isinstance(spec.get("fields"), list):
            return StructType.fromJson(spec)
        return StructType([StructField(name, spark_type(kind)) for name, kind in spec.items()])
    return StructType([_field(entry) for entry in spec])


def read_schema(path: str) -> StructType:
    """A schema from a small JSON file holding any of the accepted descriptions."""
    return to_schema(json.loads(Path(path).read_text()))


def _field(entry: dict[str, Any]) -> StructField:
    kind = entry.get("type", "string")
    nested = kind == "struct" and "fields" in entry
    data_type = to_schema(entry["fields"]) if nested else spark_type(kind)
    return StructField(entry["name"], data_type, entry.get("nullable", True))
