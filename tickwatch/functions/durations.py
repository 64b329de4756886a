"""Window lengths written as Spark writes them, such as ``5 minutes``."""

from __future__ import annotations

from math import gcd

_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(length: str) -> int:
    """Seconds in ``"<n> <unit>"``."""
    count, unit = length.split()
    return int(count) * _SECONDS[unit.lower().rstrip("s")]


def label(length: str) -> str:
    """Short form of a length: ``1 second`` is ``1s``."""
    count, unit = length.split()
    return f"{int(count)}{unit[0].lower()}"


def common_step(size: str, slide: str) -> str:
    """The longest step that divides both the size and the slide."""
    return f"{gcd(seconds(size), seconds(slide))} seconds"
