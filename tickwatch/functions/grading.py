"""Price move arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Grade and the absolute change in percent from which it holds.
GRADES = (("danger", 3.0), ("warning", 1.0), ("caution", 0.5))
CALM = "normal"


def change_percent(start: Column, end: Column) -> Column:
    """Change from start to end in percent, null for a zero start."""
    return F.try_divide(end - start, start) * 100.0


def grade(change: Column) -> Column:
    """Grade of an unrounded change; no number is no move."""
    graded = F.when(change.isNull() | F.isnan(change), CALM)
    for name, limit in GRADES:
        graded = graded.when(F.abs(change) >= limit, name)
    return graded.otherwise(CALM)
