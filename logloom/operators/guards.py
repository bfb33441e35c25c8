"""Checks on the input of the report operators."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def require_columns(table: DataFrame, *names: str) -> None:
    missing = [name for name in names if name not in table.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def or_empty(table: DataFrame, schema: T.StructType) -> DataFrame:
    """The table's columns of that schema, or an empty table of it if one is missing or of another type."""
    types = {field.name: field.dataType for field in table.schema}
    if any(types.get(field.name) != field.dataType for field in schema):
        return table.sparkSession.createDataFrame([], schema)
    return table.select([table[f"`{field.name}`"] for field in schema])


def require_values(values: Sequence[str], what: str) -> None:
    if not values:
        raise ValueError(f"pick at least one {what}")
