"""Adding result columns to a table that may hold columns of the same names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores before them as it takes for none to be a column."""
    taken = {name.lower() for name in df.columns}
    lead = "__"
    while taken & {lead + name for name in names}:
        lead += "_"
    return [lead + name for name in names]


def with_struct(df: DataFrame, result: Column, names: list[str] | dict[str, str]) -> DataFrame:
    """Add the fields of one struct result, under new names if a mapping says so.

    Columns of the input with such a name, in whatever case, give way.
    """
    names = names if isinstance(names, dict) else {name: name for name in names}
    taken = {name.lower() for name in names.values()}
    rest = [F.col(quoted(name)) for name in df.columns if name.lower() not in taken]
    (held,) = unused(df, "result")
    made = [F.col(f"{held}.{field}").alias(name) for field, name in names.items()]
    return df.select("*", result.alias(held)).select(*rest, *made)
