"""Joins on a key of which a few values may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one in HOT rows is broadcast: there are at most HOT of them.
HOT = 1000


def join_by_key(rows: DataFrame, table: DataFrame, key: str, size: str) -> DataFrame:
    """rows with the columns of table, one row for each key and `size` how many rows the key has (dropped).

    Frequent keys are broadcast, at most HOT by construction; the rest shuffles, with no key above a share of 1 / HOT.
    Null keys have no match."""
    total = table.agg(F.sum(size)).first()[0] or 0
    large = F.col(size) * HOT >= total
    hot = table.filter(large).drop(size)
    frequent = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(frequent, key, "left_anti").join(table.filter(~large).drop(size), key))
