"""Columns for releases, key ranges and identifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def release(date) -> Column:
    """Quarterly release in force on a date, as ``YYYYMM``: months 2, 5, 8 and 11; January is last November's."""
    d = F.col(date) if isinstance(date, str) else date
    m, y = F.month(d), F.year(d)
    quarter = (
        F.when(m == 1, "11").when(m < 5, "02").when(m < 8, "05").when(m < 11, "08").otherwise("11")
    )
    return F.concat((y - (m == 1).cast("int")).cast("string"), quarter)


@dataclass(frozen=True)
class KeyRanges:
    """Half-open ranges ``(lo, hi]`` that cut the keys ``low..high`` into roughly ``n`` chunks of at least ten."""

    low: int
    step: int
    count: int

    @classmethod
    def plan(cls, low: int, high: int, n: int) -> "KeyRanges":
        span = high - low
        if span / n < 10:
            return cls(low, 10, span // 10 + 1)
        return cls(low, span // n + 1, n)

    def bucket(self, key) -> Column:
        k = F.col(key) if isinstance(key, str) else key
        return F.floor((k - F.lit(self.low)) / F.lit(self.step)).cast("int")

    def jdbc_options(self, column: str) -> dict[str, str]:
        """The same chunks as partition bounds of a JDBC read."""
        return {
            "partitionColumn": column,
            "lowerBound": str(self.low),
            "upperBound": str(self.low + self.step * self.count),
            "numPartitions": str(self.count),
        }


def row_key(*cols) -> Column:
    """Stable 64-bit identifier from content; the same on every run and for every partitioning."""
    return F.xxhash64(*cols)
