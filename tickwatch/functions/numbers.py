"""Number handling that has to agree with the producers' and consumers' rules.

Wire numbers may arrive as JSON numbers, as text or as flags. They are decoded
to VARIANT, so their JSON kind is still known when they are turned into numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the texts that count as a decimal number.
_FLOAT_TEXT = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"

# The spellings that count as a flag.
_TRUE_TEXT = ("true", "True", "t", "1")
_FALSE_TEXT = ("false", "False", "f", "0")

# Texts that a JSON value that counts as false is decoded to.
_FALSE_LOOKING = r"^(-?0(\.0+)?([eE][+-]?\d+)?|false|\[\]|\{\})$"


def is_given(value: Column) -> Column:
    """The field is there and is not JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def as_float(value: Column) -> Column:
    """Number, numeric text or flag to DOUBLE; anything else is null.

    The JVM also reads ``1.5d`` and hex floats, so text is held to a pattern;
    plain numbers never reach it.
    """
    number = F.try_variant_get(value, "$", "double")
    text = F.try_variant_get(value, "$", "string")
    return F.when(F.schema_of_variant(value) == "STRING", F.when(text.rlike(_FLOAT_TEXT), number)).otherwise(number)


def is_negative(value: Column) -> Column:
    """Below zero, never null; the closer look that text needs is taken only then."""
    below = F.coalesce(F.try_variant_get(value, "$", "double") < 0, F.lit(False))
    return below & F.coalesce(as_float(value) < 0, F.lit(False))


def as_int(value: Column) -> Column:
    """Number (fraction cut off), whole-number text or flag to BIGINT, else null."""
    return F.try_variant_get(value, "$", "bigint")


def as_decimal(value: Column, kind: str) -> Column:
    """Number or numeric text to DECIMAL(p,s), null if it does not fit."""
    return F.try_variant_get(value, "$", kind)


def as_flag(value: Column) -> Column:
    """Flag in one of the accepted spellings, else null."""
    text = F.try_variant_get(value, "$", "string")
    return F.when(text.isin(*_TRUE_TEXT), F.lit(True)).when(text.isin(*_FALSE_TEXT), F.lit(False))


def first_text(*candidates: Column, default: str | None = None) -> Column:
    """First candidate that is neither null nor empty.

    Without a default the last candidate is taken as it is, so an empty last
    candidate stays empty.
    """
    *front, last = candidates
    chosen = [F.nullif(c, F.lit("")) for c in front]
    if default is None:
        return F.coalesce(*chosen, last)
    return F.coalesce(*chosen, F.nullif(last, F.lit("")), F.lit(default))


def truthy_text(text: Column, source: Column, field: str) -> Column:
    """A decoded text, null where the JSON value behind it counts as false: 0, false, [] or {}.

    Only texts that look so are looked up again in the source, to tell ``0`` from ``"0"``.
    """
    kind = F.schema_of_variant(F.from_json(source, f"{field} VARIANT", {"allowSingleQuotes": "false"})[field])
    return F.when(text.rlike(_FALSE_LOOKING), F.when(kind == "STRING", text)).otherwise(text)


def _rounded_below(value: Column, scale: float) -> tuple[Column, Column]:
    """The floor of the scaled value, and whether the value rounds up from there, ties to even."""
    down = F.floor(value * F.lit(scale)).cast("double")
    odd = down * 2.0 + 1.0
    middle = odd / F.lit(2 * scale)
    spread = middle * 134217729.0
    high = spread - (spread - middle)
    low = middle - high
    error = (odd - high * F.lit(2 * scale)) - low * F.lit(2 * scale)
    up = (value > middle) | ((value == middle) & ((error < 0) | ((error == 0) & (down % 2 != 0))))
    return down, F.when(up, 1.0).otherwise(0.0)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round the binary value itself, ties to even, as IEEE-correct printing does.

    Spark's ``round`` and ``bround`` round the shortest decimal text instead:
    0.015 is stored below the tie, yet both give 0.02. Here the value is compared
    with the midpoint above ``floor``. Where it equals the stored midpoint, the
    sign of that midpoint's own error decides; the error is found exactly by
    splitting the midpoint into two halves whose products do not round.

    Where twice the scaled value has no room for a last bit, whole and fraction are
    rounded apart. From 2**53 / scale on, neighbouring doubles lie so far apart that
    the value is its own nearest; infinities and NaN land there too.
    """
    scale = float(10**digits)
    down, up = _rounded_below(value, scale)
    whole = F.floor(value).cast("double")
    part_down, part_up = _rounded_below(value - whole, scale)
    return (
        F.when(F.abs(value) < 2.0**51 / scale, (down + up) / F.lit(scale))
        .when(F.abs(value) < 2.0**53 / scale, whole + (part_down + part_up) / F.lit(scale))
        .otherwise(value)
    )
