"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .caching import cached

# Row bound under which a narrow bookkeeping table (one row per input split,
# per file or per distinct key) is shipped to every task instead of shuffling
# the large side.  The driver builds every broadcast of every plan that uses it: at some
# 100 bytes a row, collected, hashed and sent, each stays under some 30 MB of its memory.
BROADCAST_ROW_LIMIT = 100_000


def bounded_broadcast(small: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Return ``broadcast(small)`` if it has at most ``limit`` rows, else ``small``.

    The count runs one small job over an already-aggregated table, which is
    cached so the join reuses it; above the bound the caller's join falls back
    to a shuffle join chosen by Catalyst/AQE.
    """
    small = cached(small)
    n = small.limit(limit + 1).count()
    return F.broadcast(small) if n <= limit else small


def shuffled(keys: DataFrame) -> DataFrame:
    """``keys`` for a join that shuffles them, whatever size Spark takes them for.

    Spark takes a column's share of a file by the width of its type.  Of a wide table that
    holds literals beside its ids, as placeholder rows do, the ids are nearly the whole file, so
    millions of them count as a few megabytes and would be broadcast through the driver.
    """
    return keys.hint("merge")


def is_broadcast(df: DataFrame) -> bool:
    """Did :func:`bounded_broadcast` find the table small enough?"""
    return df._jdf.queryExecution().analyzed().nodeName() == "ResolvedHint"
