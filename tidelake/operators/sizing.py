"""Deciding on a broadcast by looking at the data, not at the planner's guess.

The planner multiplies the file sizes of joined inputs, so it takes even a 57-row catalog joined from two files for a large
table and would shuffle the facts to meet it. Adaptive execution notices only after that shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that every executor and the driver can hold of one catalog.
MAX_BROADCAST_BYTES = 64 << 20
#: What a row and a field cost in memory beside their text.
ROW_BYTES, FIELD_BYTES = 24, 16


class RepeatedKeyError(ValueError):
    """A catalog has a key more than once, so a join with it would multiply the facts."""


def held_bytes(df: DataFrame, key: str | None = None) -> int:
    """About the memory that the rows take: fixed parts, and the length of every text.

    One aggregate with a partial sum in each task, so each task sends one row. Meant for catalogs: it reads ``df``
    once, which for a table of facts would be a pass of its own. With ``key`` the same pass counts the rows of each key, and
    fails if one comes more than once, before anything is joined. NULL keys join nothing and may repeat.
    """
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    row = F.lit(ROW_BYTES + FIELD_BYTES * len(df.columns))
    width = sum(text, row) if text else row
    if key is None:
        return df.agg(F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("n")).first()["n"]
    by_key = df.groupBy(key).agg(F.sum(width.cast("long")).alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    repeated = (F.col("_rows") > 1) & F.col(key).isNotNull()
    found = by_key.agg(
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("n"), F.count_if(repeated).alias("repeated"), F.min(F.when(repeated, F.col(key))).alias("first")
    ).first()
    if found["repeated"]:
        raise RepeatedKeyError(f"{found['repeated']} values of {key} come more than once, the first is {found['first']!r}")
    return found["n"]


def is_small(df: DataFrame, most: int = MAX_BROADCAST_BYTES, key: str | None = None) -> bool:
    """Does exactly this table fit the bound? With ``key``, also check that it comes once."""
    return held_bytes(df, key) <= most


def broadcast_if_small(df: DataFrame, most: int = MAX_BROADCAST_BYTES, key: str | None = None) -> DataFrame:
    """Mark a catalog for broadcast if it is measured small; otherwise it comes back as it is, and the join sorts and
    merges, where adaptive execution splits dominant keys. With ``key``, a repeated key is an error."""
    return F.broadcast(df) if is_small(df, most, key) else df
