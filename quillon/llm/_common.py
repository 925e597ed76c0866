"""Helpers shared by the corpus operators: shared scratch tables, Arrow mapping and hashing in numpy."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below spark.checkpoint.dir, the folder that driver and executors share.

    Where the setting is absent, jobs stop unless Spark runs in local mode, where any folder is shared.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        top = "file:///tmp/quillon-shared"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table in the shared folder and read it again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    to = scratch(spark, name)
    df.write.parquet(to)
    return spark.read.schema(df.schema).parquet(to)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`: bounds what is turned into Python objects at once."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), element by element."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def drawn(df: DataFrame, group: str, place: DataFrame, sample: int, hash_col: str) -> DataFrame:
    """At most `sample` rows of each group, those with the least hash_col (a long, different for different rows).

    place: group and n, the rows a group has (a few rows). Hashes above what about twice the sample lie below are left
    out first, so that no task orders more than that of a group.
    """
    share = F.least(F.lit(1.0), F.lit(2.0 * sample + 40) / F.col("n"))
    bars = place.select(F.col(group).alias("_group"), (share * 2.0**64 - 2.0**63).alias("_bar"))
    near = df.join(F.broadcast(bars), (F.col(group) == F.col("_group")) & (F.col(hash_col).cast("double") <= F.col("_bar"))).drop("_group", "_bar")
    order = Window.partitionBy(group).orderBy(hash_col)
    return near.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= sample).drop("_place")


#: Bits of the bitmap of may_be_in: 4 MB, whatever the tables.
BITS = 1 << 25


def may_be_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows with a boolean _likely: false for none of the rows whose `key` (a long) is among keys (one column of that name),
    and true for few others while there are far fewer keys than BITS. The keys' bits are broadcast, 4 MB at most."""
    slot = F.pmod(F.col(key), F.lit(BITS))
    bits = keys.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    placed = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_bit": F.bitmap_bit_position(slot)}).join(F.broadcast(bits), "_bucket", "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    return placed.withColumn("_likely", likely).drop("_bucket", "_bit", "_bits")


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text leaves no remainder modulo 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))

