"""Keep costly columns from being computed more than once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], columns: Mapping[str, Column]) -> DataFrame:
    """Project to the kept and the given columns so that later filters stay above them.

    The optimizer pushes a filter below a projection by repeating the projected
    expressions inside the filter; on decoded JSON that means decoding again for
    every mention. It does not push filters below a generator, so the columns are
    generated as the one element of an array.
    """
    one = F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))
    return df.select(*keep, F.inline(one))
