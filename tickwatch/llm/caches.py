"""A cache whose size does not grow with the data."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

ENTRIES = 400_000
LONGEST_KEY = 64


class BoundedCache(dict):
    """Results by key, in two generations of at most ``entries`` each.

    When the younger is full it becomes the older one, whose entries move up again
    when they are asked for. Very long keys are never kept. What is looked up is the
    same whether it was kept or computed anew.
    """

    def __init__(self, compute: Callable[[str], Any], entries: int = ENTRIES):
        super().__init__()
        self.compute, self.entries, self.older = compute, entries, {}

    def __missing__(self, key: str) -> Any:
        value = self.older.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_KEY:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value

    def forget(self) -> None:
        """Let go of all results, of both generations."""
        self.clear()
        self.older = {}
