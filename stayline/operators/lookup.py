"""Value lookups against a small table whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Size of a lookup side that may be broadcast, and rows that surely stay below it.
BROADCAST_BYTES = 32 << 20
BROADCAST_ROWS = 200_000

# Copies of a lookup side that is too large for that.
SALTS = 64


def lookup(frame: DataFrame, key: str, table: DataFrame, output: str, *,
           small: bool, spread_by: str, salts: int = SALTS) -> DataFrame:
    """Add ``output`` from a ``(key, value)`` table, null when unknown.

    ``key`` is SQL over ``frame``.  A small table is broadcast.  A large one is
    shuffled, and since a single key may own most rows of ``frame`` (the empty
    category usually does), each of its rows is copied ``salts`` times and the
    rows of ``frame`` are spread over the copies.

    Helper columns start with an underscore; the caller selects what it keeps.
    """
    table = table.select(F.col("key").alias(f"_key_{output}"), F.col("value").alias(output))
    same = F.expr(key) == F.col(f"_key_{output}")
    if small:
        return frame.join(F.broadcast(table), same, "left")
    salt = f"_salt_{output}"
    copies = table.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = F.pmod(F.xxhash64(spread_by), F.lit(salts)) == F.col(salt)
    return frame.join(copies, same & spread, "left")


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether the table has at most ``rows`` rows; stops counting beyond them."""
    return table.limit(rows + 1).count() <= rows
