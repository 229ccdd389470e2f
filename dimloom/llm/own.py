"""A caller's columns under neutral names, so that an operator's own names never clash with them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Own:
    """``df`` is the caller's frame with columns ``in0``, ``in1``, ...; ``back`` selects them under their names again."""

    def __init__(self, docs: DataFrame):
        self.names = docs.columns
        self.inner = [f"in{k}" for k in range(len(self.names))]
        self.df = docs.toDF(*self.inner)

    def __getitem__(self, name: str) -> Column:
        return F.col(self.inner[self.names.index(name)])

    def back(self, without: Collection[str] = (), changed: dict[str, Column] | None = None) -> list[Column]:
        """The columns but ``without``, some ``changed``."""
        changed = changed or {}
        return [changed.get(n, F.col(i)).alias(n) for n, i in zip(self.names, self.inner) if n not in without]
