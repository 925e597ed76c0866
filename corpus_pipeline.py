"""The corpus pipeline: five stages, each on all that its predecessor kept.

Stages but the last return the columns of documents. Language identification drops what it rejects; near-duplicate
detection keeps one row of each class, that of the least doc_id; decontamination drops documents with an occurring benchmark window; the
secret scan replaces every span by a mark; the last stage encodes and decodes what is left.

Results for odd input, for every stage: rows are told apart by id (null-safe) and text digest, so null, repeated and shared
ids are decided row by row; an empty table gives an empty table; further columns, whatever their names, are kept as they
are. Null and empty texts: language identification drops them (no letters); the other stages keep them, near-duplicate
detection one row of those equal in id and text. Very long texts are treated whole. Ties: of rows equal in id and text the
one with the least other columns stays; nothing else depends on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm import decontamination, language, near_dedup, secrets, word_bpe
from quillon.llm._common import held_out, may_be_in, read, stored
from quillon.llm.tokens import definition_of, vocabulary_path

ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that language identification rejects; it learns from the same rows as the query does."""
    model = language.fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return language.predict(rows, model, keep=("row",)).filter(~F.col("rejected")).select("row.*")


def _apart(docs: DataFrame, named: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of docs that named (_id, _digest: id and text digest) cannot have, and the others, by a bitmap that is
    broadcast: a join with named then shuffles the texts of the latter alone."""
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64("doc_id", F.xxhash64("text")).alias("_key"))
    told = may_be_in(keyed, named.select(F.xxhash64("_id", "_digest").alias("_key")), "_key")
    return told.filter(~F.col("_likely")).select("row.*"), told.filter("_likely").select("row.*")


def _same(docs: DataFrame, named: DataFrame) -> Column:
    return docs["doc_id"].eqNullSafe(named["_id"]) & (F.xxhash64(docs["text"]) == named["_digest"])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate class: the one with the least doc_id (null last), then the least text digest.

    Of rows equal in both the one with the least other columns stays; texts without words are equal to copies only."""
    classes = near_dedup.row_classes(docs).groupBy("doc_id", "digest").agg(F.min("class_id").alias("class_id"), F.min("class_digest").alias("class_digest"), F.count("*").alias("n"))
    least = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("digest") == F.col("class_digest"))
    marked = classes.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), least.alias("_least"), "n")
    marked = stored(marked.filter(~F.col("_least") | (F.col("n") > 1)).drop("n"), "classes")
    clear, likely = _apart(docs, marked)
    single = clear.unionByName(likely.join(marked, _same(likely, marked), "left_anti"))
    repeated = stored(marked.filter("_least"), "repeated")
    _, copies = _apart(docs, repeated)
    others = [f"`{c}`" for c in docs.columns if c not in ("doc_id", "text")]
    row = F.min(F.struct(*others, "text")).alias("row")  # of types that have an order
    one = copies.join(repeated, _same(copies, repeated), "left_semi").groupBy("doc_id", F.xxhash64("text").alias("digest")).agg(row)
    return single.unionByName(one.select("doc_id", "row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which a benchmark window occurs."""
    found = decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    hit = stored(found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct(), "hit")
    clear, likely = _apart(docs, hit)
    return clear.unionByName(likely.join(hit, _same(likely, hit), "left_anti"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; n_chars follows."""
    return secrets.redact(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode every text: doc_id, n_tokens and the digests of ids and decoded text."""
    return word_bpe.digests(docs, definition_of(vocabulary_path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents, each written as Parquet in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
