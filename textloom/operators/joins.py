"""Joins of corpus-sized rows with a lookup table of distinct keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.session import stored_small as stored

# A lookup up to this size is copied to every executor; beyond it both sides are shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key is hot if it holds more than one row in so many; at most as many keys can be.
HOT_SHARE = 1000


def lookup_bytes(lookup: DataFrame) -> int:
    """Bytes held by a lookup, measured by reading it."""
    fixed = 16 * len(lookup.columns)
    sizes = [
        F.coalesce(F.octet_length(f.name), F.lit(0))
        if isinstance(f.dataType, T.StringType)
        else F.lit(0)
        if isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DatetimeType))
        else F.coalesce(F.octet_length(F.to_json(F.struct(f.name))), F.lit(0))
        for f in lookup.schema.fields
    ]
    per_row = F.lit(fixed).cast("long")
    for size in sizes:
        per_row = per_row + size
    return lookup.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("bytes")).first()["bytes"]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    key_counts: DataFrame | None = None,
    keys_distinct: bool = False,
) -> DataFrame:
    """Join with a lookup that is cheap to read, such as a stored table or literal rows.

    The lookup is measured first. A small one is broadcast, so ``rows`` never move. Beyond that the keys of ``rows``
    are counted, with map-side combining. Rows of hot keys, of which there are at most HOT_SHARE, stay where they are
    and meet a broadcast of just the lookup rows of these keys; all other rows are shuffled by key once.
    ``rows`` is read twice then, so it should be cheap to read as well or stored. Lookup keys are distinct.
    Callers that know the rows of each key pass them as ``key_counts``, with the number in ``_n``; no key is hot with
    ``keys_distinct``. The lookup is the side that is hashed, so the shuffled rows are not sorted.
    """
    on = [on] if isinstance(on, str) else list(on)
    if lookup_bytes(lookup) <= max_bytes:
        return rows.join(F.broadcast(lookup), on, how)
    if keys_distinct:
        return rows.join(lookup, on, how)
    counts = key_counts
    if counts is None:
        counts = stored(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = counts.where(F.col("_n") * HOT_SHARE > total).drop("_n").na.drop()
    if hot.isEmpty():
        return rows.join(lookup.hint("shuffle_hash"), on, how)
    hot = F.broadcast(stored(hot, "hot-keys"))
    at_hand = rows.join(hot, on, "left_semi").join(F.broadcast(lookup.join(hot, on, "left_semi")), on, how)
    return at_hand.unionByName(rows.join(hot, on, "left_anti").join(lookup.hint("shuffle_hash"), on, how))
