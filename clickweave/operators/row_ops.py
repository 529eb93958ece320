"""The list-of-steps language: small row operators applied in order.

A step is a dict with one operator (``groupBy`` comes with ``agg``), or text of the form
``"filter: ..."``, ``"select: a, b"`` or ``"distinct"``. Every step is a plain DataFrame call, so
the whole list is one logical plan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The aggregates a groupBy step may name; the result column is <column>_<name>.
AGGREGATES = ("count", "sum", "avg", "max", "min")


def filter_rows(df: DataFrame, predicate: str) -> DataFrame:
    return df.filter(predicate)


def select_columns(df: DataFrame, expressions: Iterable[str]) -> DataFrame:
    return df.selectExpr(*expressions)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Names the table does not have are ignored."""
    return df.drop(*names)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def distinct_rows(df: DataFrame) -> DataFrame:
    """On a stream, duplicates are recognised as long as the watermark keeps them."""
    return df.dropDuplicatesWithinWatermark() if df.isStreaming else df.distinct()


def first_rows(df: DataFrame, count: int, order_by: Iterable[str] = ()) -> DataFrame:
    """The first rows; with ``order_by`` each task keeps only its own best ``count``."""
    order = [_order_item(item) for item in order_by]
    return (df.orderBy(*order) if order else df).limit(count)


ORDER_ITEM = re.compile(
    r"(?is)(?P<expr>.*?)(?:\s+(?P<direction>asc|desc))?(?:\s+nulls\s+(?P<nulls>first|last))?\s*"
)


def _order_item(item: str) -> Column:
    """``expression [ASC | DESC] [NULLS FIRST | NULLS LAST]``; without the last part nulls go first when ascending."""
    found = ORDER_ITEM.fullmatch(item.strip())
    falling = (found["direction"] or "asc").lower() == "desc"
    nulls = (found["nulls"] or ("last" if falling else "first")).lower()
    return getattr(F.expr(found["expr"]), f"{'desc' if falling else 'asc'}_nulls_{nulls}")()


def split_list(text: str) -> list[str]:
    """Items of a comma-separated list; commas within brackets or quotes do not count."""
    items, start, depth, quote, skip = [], 0, 0, None, False
    for at, char in enumerate(text):
        if skip:
            skip = False
        elif quote:
            if char == "\\" and quote != "`":
                skip = True
            elif char == quote:
                quote = None
        elif char in "'\"`":
            quote = char
        elif char in "([{":
            depth += 1
        elif char in ")]}":
            depth -= 1
        elif char == "," and depth == 0:
            items.append(text[start:at].strip())
            start = at + 1
    return [*items, text[start:].strip()]


def group_rows(df: DataFrame, keys: Iterable[str], aggregates: dict[str, str | list[str]]) -> DataFrame:
    """Group by column names or expressions such as ``window(ts, '30 minutes')``."""
    columns = []
    for name, functions in aggregates.items():
        for function in [functions] if isinstance(functions, str) else functions:
            if function not in AGGREGATES:
                raise ValueError(f"unknown aggregate {function!r}; choose from {AGGREGATES}")
            columns.append(getattr(F, function)(name).alias(f"{name}_{function}"))
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*columns)


def watermark(df: DataFrame, setting: str) -> DataFrame:
    """``"column, delay"``; has no effect on a bounded table."""
    column, delay = (part.strip() for part in setting.split(",", 1))
    return df.withWatermark(column, delay)


def create_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def run_sql(df: DataFrame, query: str) -> DataFrame:
    """SQL over registered views; ``{df}`` in the text stands for the incoming table."""
    spark = df.sparkSession
    return spark.sql(query, df=df) if "{df}" in query else spark.sql(query)


STEPS: dict[str, Callable[[DataFrame, Any], DataFrame]] = {
    "filter": filter_rows,
    "select": select_columns,
    "drop": drop_columns,
    "rename": rename_columns,
    "watermark": watermark,
    "create_view": create_view,
    "sql_query": run_sql,
}


def apply_steps(df: DataFrame, steps: Iterable[dict[str, Any] | str | Callable]) -> DataFrame:
    """Apply steps in order; a callable step is any ``DataFrame -> DataFrame`` function."""
    for step in steps:
        df = df.transform(_step(step))
    return df


def _step(step) -> Callable[[DataFrame], DataFrame]:
    if callable(step):
        return step
    if isinstance(step, str):
        return _step(_from_text(step))
    if "type" in step:
        step = {step["type"]: step.get("query", step.get("name"))}
    if "groupBy" in step:
        return lambda df: group_rows(df, step["groupBy"], step["agg"])
    if "limit" in step:
        return lambda df: first_rows(df, step["limit"], step.get("order_by", ()))
    if step.get("distinct"):
        return distinct_rows
    if len(step) != 1 or next(iter(step)) not in STEPS:
        raise ValueError(f"unknown step {step!r}")
    name, argument = next(iter(step.items()))
    return lambda df: STEPS[name](df, argument)


def _from_text(text: str) -> dict[str, Any]:
    name, _, rest = text.partition(":")
    name, rest = name.strip(), rest.strip()
    if name == "distinct":
        return {"distinct": True}
    if name == "select":
        return {"select": split_list(rest)}
    if name == "filter" and rest:
        return {"filter": rest}
    raise ValueError(f"unknown step {text!r}")
