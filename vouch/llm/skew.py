"""Joins and running sums over keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vouch.llm.frames import partitions
from vouch.sources.staging import settle

#: Keys that are joined by broadcast: at most this many can each hold so large a share of the rows.
HOT_KEYS = 1024


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], weight: Column, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key; null where it has none.

    ``weight`` is the number of rows that look a key up, ``total`` the sum of it. Keys with
    more than a share of 1 / ``HOT_KEYS`` of all rows, fewer than ``HOT_KEYS`` by that, are
    broadcast, so their rows stay where they are; all others are joined by a shuffle, in which
    no key is large. Null keys find nothing.
    """
    values = [c for c in table.columns if c not in keys]
    heavy = weight > F.lit(max(1, total // HOT_KEYS))
    hot = table.where(heavy).select(*keys, F.struct(*values, F.lit(True).alias("__hot")).alias("__found"))
    cold = table.where(~F.coalesce(heavy, F.lit(False)))
    marked = rows.join(F.broadcast(hot), keys, "left")
    found = marked.where("__found.__hot").select(*rows.columns, *[F.col(f"__found.{c}").alias(c) for c in values])
    rest = marked.where("__found.__hot is null").drop("__found").join(cold, keys, "left")
    return found.unionByName(rest.select(*rows.columns, *values))


def in_segments(rows: DataFrame, key: str, *order: Column) -> DataFrame:
    """``rows`` with ``seg``: ranges of a key's rows in order, none larger than a partition by range.

    A segment number is higher than that of every earlier segment of the key. Kept in the
    shared folder, as ranges are drawn by sampling.
    """
    ranged = rows.repartitionByRange(partitions(rows.sparkSession), F.col(key), *order)
    return settle(ranged.withColumn("seg", F.spark_partition_id()))


def running(rows: DataFrame, key: str, order: list[Column], sums: dict[str, Column], backwards: bool = False) -> DataFrame:
    """``rows`` with running sums within each ``key`` along ``seg`` and, inside it, ``order``.

    Each segment is summed in a window of its own. Sums of whole segments, of which a key has
    no more than there are partitions, are carried over. ``backwards``: the last segment is first.
    """
    inside = Window.partitionBy(key, "seg").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    total = rows.groupBy(key, "seg").agg(*[F.sum(value).alias(name) for name, value in sums.items()])
    along = F.col("seg").desc() if backwards else F.col("seg")
    before = Window.partitionBy(key).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    carried = total.select(key, "seg", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"__{n}") for n in sums])
    within = rows.withColumns({n: F.sum(value).over(inside) for n, value in sums.items()})
    summed = within.join(carried, [key, "seg"])
    return summed.withColumns({n: F.col(n) + F.col(f"__{n}") for n in sums}).drop(*[f"__{n}" for n in sums])
