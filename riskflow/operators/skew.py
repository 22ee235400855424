"""Left joins that survive a key holding a large share of all rows.

A lookup with one row per key is attached to rows in three regimes:

* the lookup fits a checked size: broadcast, no shuffle of the rows;
* it does not fit: shuffle join on the key, in which
* the *hot* keys, those with more than ``hot_rows`` rows, take their lookup row from a
  broadcast and are spread over all partitions. Where more than ``HOT_KEYS`` keys pass
  that mark it is raised until no more do, which bounds the broadcast whatever the data
  looks like; the others go through the shuffle, so the result is the same.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.sources.tables import written

#: A key with more rows than this is kept out of the shuffle on the key.
HOT_ROWS = 1_000_000
#: Largest lookup, in rows, that is broadcast whole.
BROADCAST_ROWS = 1_000_000
#: Largest lookup, in bytes of its values, that is broadcast whole.
BROADCAST_BYTES = 256 << 20
#: Most keys that are hot at a time.
HOT_KEYS = 10_000

_SPREAD = 1 << 30


def fits(lookup: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most ``max_rows`` rows and ``BROADCAST_BYTES`` of values.

    Runs one job that counts in all partitions; only their sums meet in one task.
    """
    if max_rows <= 0:
        return False
    texts = [name for name, kind in lookup.dtypes if kind == "string"]
    fixed = F.lit(8 * (len(lookup.columns) - len(texts)))
    size = reduce(add, (F.coalesce(F.octet_length(name), F.lit(0)) for name in texts), fixed)
    rows, held = lookup.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return rows <= max_rows and (held or 0) <= BROADCAST_BYTES


def hottest(counts: DataFrame, hot_rows: int, count: str = "count", most: int = HOT_KEYS) -> DataFrame:
    """Rows of ``counts`` (one per key) above ``hot_rows``, at most ``most`` of them.

    Runs one job over ``counts``, a written table, which gives at most 64 numbers: the
    keys by the power of two of their count. The mark is raised to the least power of two
    above which no more than ``most`` keys lie.
    """
    power = F.length(F.bin(F.col(count))).alias("power")
    above = counts.where(F.col(count) > hot_rows)
    mark, keys = hot_rows, 0
    for row in sorted(above.groupBy(power).agg(F.count(F.lit(1)).alias("keys")).collect(), reverse=True):
        keys += row["keys"]
        if keys > most:
            mark = (1 << row["power"]) - 1
            break
    return counts.where(F.col(count) > max(mark, hot_rows))


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hottest keys with more than ``hot_rows`` rows, counted with map-side partial sums."""
    counts = rows.groupBy(key).count().where(F.col("count") > hot_rows)
    return hottest(written(counts, "hot-keys"), hot_rows).select(key)


def hot_part(lookup: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """Lookup rows of the hot keys, null-filled for hot keys the lookup lacks."""
    found = lookup.join(F.broadcast(hot), key, "left_semi")
    return hot.join(F.broadcast(found), key, "left")


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    hot_lookup: DataFrame,
    spread_by: list[str],
) -> DataFrame:
    """Left join of ``lookup`` by shuffle, with the keys of ``hot_lookup`` broadcast.

    The key is text. ``hot_lookup`` has the columns of ``lookup`` and one row per hot key, nulls where
    the lookup has none. ``spread_by`` are row columns that vary within a hot key; equal
    rows are told apart by their input partition, which a repeated task does not change.
    """
    values = [name for name in lookup.columns if name != key]
    # The key of a moved row is its route, or stands with the values of a hot one: it does not travel twice.
    hot = F.broadcast(hot_lookup.select(key, F.struct(key, *values).alias("_hot")))
    rest = lookup.select(F.col(key).alias("_route"), F.struct(*values).alias("_rest"))

    # Hot rows are routed by a salted key. It matches nothing that counts: their values
    # come from the broadcast. (A constant salt column would be optimized out of the join
    # keys, and with it the spreading.)
    is_hot = F.col("_hot").isNotNull()
    salt = F.pmod(F.xxhash64(*spread_by, F.spark_partition_id()), F.lit(_SPREAD)).cast("string")
    route = F.when(is_hot, F.concat_ws("#", F.col(key), salt)).otherwise(F.col(key))

    def chosen(name: str) -> Column:
        return F.when(is_hot, F.col("_hot")[name]).otherwise(F.col("_rest")[name]).alias(name)

    written_key = F.when(is_hot, F.col("_hot")[key]).otherwise(F.col("_route")).alias(key)
    return (
        rows.join(hot, key, "left")
        .withColumn("_route", route)
        .drop(key)
        .join(rest, "_route", "left")
        .select(
            *[written_key if name == key else F.col(name) for name in rows.columns], *[chosen(name) for name in values]
        )
    )


def attach_checked(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    hot_lookup: Callable[[], DataFrame],
    spread_by: list[str],
    broadcast_rows: int,
) -> DataFrame:
    """Left join by broadcast if the lookup fits ``broadcast_rows``, else :func:`attach`."""
    if fits(lookup, broadcast_rows):
        return rows.join(F.broadcast(lookup), key, "left")
    return attach(rows, lookup, key, hot_lookup(), spread_by)
