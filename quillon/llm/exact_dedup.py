"""Exact deduplication by content; DataFrame functions only.

1. One pass writes a narrow row for each document: id, 128-bit content hash (MD5), the text's SHA-256 and a row number.
2. Rows are counted by hash, pre-aggregated before the shuffle: the size of each group, the id that stays, and the one row
   that stays where several have this id.
3. Bytes are compared inside the groups of two rows or more: (hash, text) pairs are grouped again, which is an exact
   comparison of texts, and pre-aggregated, so that a task sends one copy of a text however many it met. A bitmap of
   2^25 slots (4 MB, always) of the hashes with two rows or more keeps most other texts out of that shuffle; those it lets
   through by chance are groups of one text and change nothing.
4. Hashes with two different texts are collisions; their rows are grouped by the texts themselves instead.
5. Group sizes go back to the rows by a join on the hash. Groups with a thousandth of all rows or more, a thousand at most,
   are broadcast; no other key of the join holds more than a thousandth of the rows.

Results for odd input: null text is an empty text; empty texts equal each other; texts of any length are compared whole; of
rows equal in id and text exactly one stays; a null id stays only if its group has no other; an empty table gives no
rows; further columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, stored

SLOTS = 1 << 25
#: A group of at least one in HOT rows is broadcast: there are at most HOT of them.
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null is empty. ASCII texts take the quicker function."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text.cast("binary")))


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(SLOTS))


def _grouped(rows: DataFrame, *keys: str, keep: str) -> DataFrame:
    """keys, group_size, keep_id and keep_row (the row number of the row that stays)."""
    best, by = (F.max, F.max_by) if keep == "greatest" else (F.min, F.min_by)
    return rows.groupBy(*keys).agg(F.count("*").alias("group_size"), best("id").alias("keep_id"), F.coalesce(by("row", "id"), F.max("row")).alias("keep_row"))


def _maybe_repeated(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of texts whose hash may be one of repeated: those whose bit is set in a bitmap of fixed size."""
    slot = _slot(F.col("hash"))
    bitmaps = repeated.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    place = texts.withColumn("bucket", F.bitmap_bucket_number(slot)).withColumn("bit", F.bitmap_bit_position(slot))
    byte = F.conv(F.hex(F.substring(F.col("bits"), (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = place.join(F.broadcast(bitmaps), "bucket").filter(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1)
    return met.select(*texts.columns)


def groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: str = "least", hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """For each row of docs: id, keep_id, group_size, kept and text_sha256. keep: the least or the greatest id stays."""
    if keep not in ("least", "greatest"):
        raise ValueError(f"keep is 'least' or 'greatest', not {keep!r}")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), normalised(F.col(f"`{text_col}`")).alias("text"))
    texts = texts.withColumn("hash", hashed(F.col("text")))
    sha = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("sha")
    rows = stored(texts.select("id", "hash", sha, F.monotonically_increasing_id().alias("row")), "rows")
    sizes = stored(_grouped(rows, "hash", keep=keep).filter("group_size > 1"), "sizes")
    alike = _maybe_repeated(texts.select("hash", "text"), sizes).groupBy("hash", "text").agg(F.lit(1).alias("one"))
    collided = stored(alike.groupBy("hash").agg(F.count("*").alias("texts")).filter("texts > 1").select("hash"), "collided")
    if not collided.isEmpty():
        mixed = texts.join(collided, "hash", "left_semi").select("id", "text", sha, F.monotonically_increasing_id().alias("row"))
        mixed = stored(mixed, "mixed")
        apart = _labelled(mixed, _grouped(mixed, "text", keep=keep).filter("group_size > 1"), "text")
        rows, sizes = rows.join(collided, "hash", "left_anti"), sizes.join(collided, "hash", "left_anti")
        return _labelled(rows, sizes, "hash").unionByName(apart)
    return _labelled(rows, sizes, "hash")


def _labelled(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """rows with what sizes says of their group; rows without are alone."""
    n = rows.count()
    large = F.col("group_size") * HOT >= n
    small = sizes.filter(~large)
    hot = sizes.filter(large).select(F.col(key).alias("hot"), F.struct("group_size", "keep_id", "keep_row").alias("of"))
    seen = rows.join(F.broadcast(hot), F.col(key) == F.col("hot"), "left")
    told = seen.filter("hot IS NOT NULL").select("id", "sha", "row", "of.*")
    rest = seen.filter("hot IS NULL").drop("hot", "of").join(small, key, "left").select("id", "sha", "row", "group_size", "keep_id", "keep_row")
    every = rest.unionByName(told)
    alone = F.col("group_size").isNull()
    return every.select(
        "id",
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(read(spark, sf_dir, "documents"), keep="greatest").withColumnRenamed("id", "doc_id")


OP11_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d
"""
