"""Jump consistent hashing: rows to shards without a ring table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The generator of the published jump hash (Lamping and Veach): fixed values.
MULTIPLIER = 2862933555777941757
WORD = 1 << 64
HIGH_BITS = 1 << 33
RANGE = 1 << 31

#: Rows of a shard that are numbered together.
ROWS_PER_RUN = 20_000


def stable_key(column: Column) -> Column:
    """A number below 2^60 that depends on the value's text alone; null counts as the text ``null``."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")


def jump(key: Column, shards: int) -> tuple[Column, Column]:
    """The shard of a key among ``shards``, and its shard among one more.

    Each step jumps ahead in the sequence of shard counts to the next one at which the key
    moves. A step advances by one shard at least, so ``shards`` steps always reach the end;
    a key that has arrived skips the rest.
    """
    if shards < 1:
        raise ValueError("at least one shard")

    def step(s: Column, _: Column) -> Column:
        return F.when(s["next"] >= shards, s).otherwise(
            F.get(
                F.transform(
                    F.array((s["key"] * F.lit(MULTIPLIER).cast("decimal(19,0)") + 1) % F.lit(str(WORD)).cast("decimal(20,0)")),
                    lambda k: state(
                        s["next"],
                        F.floor((s["next"] + 1) * (F.lit(float(RANGE)) / (F.call_function("div", k, F.lit(HIGH_BITS)) + 1).cast("double"))),
                        k,
                    ),
                ),
                F.lit(0),
            )
        )

    def state(at: Column, following: Column, k: Column) -> Column:
        return F.struct(
            at.cast("bigint").alias("at"), following.cast("bigint").alias("next"), k.cast("decimal(38,0)").alias("key")
        )

    end = F.aggregate(
        F.sequence(F.lit(1), F.lit(shards)),
        state(F.lit(-1), F.lit(0), key),
        step,
        lambda s: F.struct(s["at"].alias("at"), F.when(s["next"] == shards, shards).otherwise(s["at"]).alias("grown")),
    )
    return end["at"].cast("int"), end["grown"].cast("int")


def assign_shards(df: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """The frame with ``shard`` and ``grown_shard``, the shard if one more were appended.

    Rows of equal keys share a shard, whatever else they hold; null keys share one too. Of
    all keys 1 / (shards + 1) move when a shard is appended, all of them into it.
    """
    shard, grown = jump(stable_key(F.col(key)), shards)
    return df.withColumns({"shard": shard, "grown_shard": grown})


def write_shards(df: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """All columns of the frame, in a folder for each shard."""
    assign_shards(df, shards, key).drop("grown_shard").write.partitionBy("shard").parquet(path)


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """A manifest of all documents: their shard and their place in it.

    One row per input row: doc_id, size (UTF-8 bytes and 16), text_crc32, law, shard, slot,
    grown_shard. A null text has no bytes and checksum 0. Slots of a shard run from 0 without
    gaps. Rows that are alike in every column are counted before the shuffle and laid out
    again at the end, so a key that holds a third of all rows costs one row per task; a shard
    is numbered in runs whose number grows with the input, never in one task: the different texts
    of one doc_id are dealt over the runs too.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    runs = max(1, -(-docs.count() // (shards * ROWS_PER_RUN)))
    run = F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(runs)).alias("run")
    shard, grown = jump(stable_key(F.col("doc_id")), shards)
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    placed = alike.select("*", shard.alias("shard"), grown.alias("grown_shard"), run)
    counted = placed.groupBy("shard", "run").agg(F.sum("copies").alias("rows"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("shard", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = (
        Window.partitionBy("shard", "run")
        .orderBy("doc_id", "text_crc32", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("start") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    numbered = placed.join(starts, ["shard", "run"]).withColumn("first", first)
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)).alias("slot"),
        "grown_shard",
    )
