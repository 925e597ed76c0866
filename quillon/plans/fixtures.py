"""Deterministic inputs derived from the given tables: entities, labels, three pseudo-descriptors, signals, versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions.selection import quantiles
from quillon.functions.shared import kept
from quillon.operators.metrics import percentile_rank

DESCRIPTORS = ["digit", "len", "space"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def labels(spark: SparkSession, sf_dir: str, column: str = "quality") -> DataFrame:
    return read(spark, sf_dir, "labels").filter(F.col(column).isNotNull()).groupBy(F.col("doc_id").alias("compound_id")).agg(F.max(column).cast("int").alias("y"))


def _counted(docs: DataFrame) -> DataFrame:
    """compound_id, n_chars and how many blanks and digits a text has: all that scores need, without the text.

    A blank is one byte, so bytes are told apart instead of characters."""
    text = F.coalesce("text", F.lit(""))
    blanks = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))
    return docs.select(F.col("doc_id").alias("compound_id"), "n_chars", blanks.alias("_blanks"), F.regexp_count(text, F.lit("[0-9]")).alias("_digits"))


def _inlined(counted: DataFrame, *more: str) -> DataFrame:
    c = F.col("n_chars").cast("double")
    share = lambda n: F.when(c > 0, F.least(F.greatest(n / c, F.lit(0.0)), F.lit(1.0))).otherwise(0.0)
    values = {"len": 1 / (1 + F.exp(-(F.ln(c + 1) - 7))), "space": share(F.col("_blanks")), "digit": share(F.col("_digits"))}
    rows = F.array(*(F.struct(F.lit(n).alias("descriptor"), v.alias("p")) for n, v in values.items()))
    return counted.select("compound_id", *more, F.inline(rows))


def scores(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """compound_id, descriptor, p over documents: length, share of blanks, share of digits."""
    return _inlined(_counted(docs or read(spark, sf_dir, "documents")), "n_chars")


def ranked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scores with rank_q and ad."""
    s = scores(spark, sf_dir)
    mean = read(spark, sf_dir, "documents").agg(F.avg(F.ln(F.col("n_chars").cast("double") + 1)).alias("_m"))
    r = percentile_rank(s, ["descriptor"], "p", "compound_id").withColumnRenamed("pct", "rank_q")
    return r.join(F.broadcast(mean)).select("compound_id", "descriptor", "p", "rank_q", (-F.abs(F.ln(F.col("n_chars").cast("double") + 1) - F.col("_m"))).alias("ad"))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """compound_id, descriptor, p, y of labelled documents; labels meet counts, so no join shuffles a text."""
    known = labels(spark, sf_dir)
    return _inlined(_counted(read(spark, sf_dir, "documents")).join(known, "compound_id"), "y").select("compound_id", "descriptor", "p", "y")


def scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Scores of all documents and, with y, of the labelled ones, both stored: texts are read once for the two."""
    whole = kept(scores(spark, sf_dir).drop("n_chars"), "scores")
    return whole, kept(whole.join(labels(spark, sf_dir), "compound_id"), "labelled")


def labelled_ranks(spark: SparkSession, sf_dir: str, ranked: DataFrame | None = None) -> DataFrame:
    """compound_id, descriptor, p, rank_q, ad, y of labelled documents; ranks are those among all documents."""
    return (ranked or ranked_scores(spark, sf_dir)).join(labels(spark, sf_dir), "compound_id")


def signals(spark: SparkSession, sf_dir: str, ranked: DataFrame | None = None) -> DataFrame:
    """Pool signals of the labelled documents; ranked: a stored table of ranked scores."""
    from quillon.operators.estimate import pool_signals

    ranked = kept(ranked_scores(spark, sf_dir), "ranked") if ranked is None else ranked
    rows = labelled_ranks(spark, sf_dir, ranked)
    cuts = quantiles(ranked, ["descriptor"], "ad", [0.05]).select("descriptor", F.col("q")[0].alias("ad_cutoff"))
    return pool_signals(rows, cuts)


SQL = """d AS (SELECT doc_id, n_chars, CAST(n_chars AS DOUBLE) AS c, coalesce(text, '') AS t FROM documents),
s0 AS (SELECT doc_id AS compound_id, c, 'len' AS descriptor, 1 / (1 + exp(-(ln(c + 1) - 7))) AS p FROM d
  UNION ALL SELECT doc_id, c, 'space', CASE WHEN c > 0 THEN least(1, greatest(0, (length(t) - length(replace(t, ' ', ''))) / c)) ELSE 0 END FROM d
  UNION ALL SELECT doc_id, c, 'digit', CASE WHEN c > 0 THEN least(1, greatest(0, length(regexp_replace(t, '[^0-9]', '', 'g')) / c)) ELSE 0 END FROM d),
ps AS (SELECT compound_id, descriptor, p, (row_number() OVER (PARTITION BY descriptor ORDER BY p, compound_id) - 1) / greatest(1, count(*) OVER (PARTITION BY descriptor) - 1) AS rank_q,
  -abs(ln(c + 1) - (SELECT avg(ln(c + 1)) FROM d)) AS ad FROM s0),
lab AS (SELECT doc_id AS compound_id, CAST(max(quality) AS INTEGER) AS y FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
sl AS (SELECT ps.*, y FROM ps JOIN lab USING (compound_id)),
sc AS (SELECT descriptor, p, count(*) AS n, sum(y) AS n1 FROM sl GROUP BY ALL),
cum AS (SELECT *, sum(n) OVER w AS cn, sum(n1) OVER w AS cn1, sum(n) OVER (PARTITION BY descriptor) AS t, sum(n1) OVER (PARTITION BY descriptor) AS t1 FROM sc WINDOW w AS (PARTITION BY descriptor ORDER BY p DESC)),
auc AS (SELECT descriptor, (sum(CASE WHEN y = 1 THEN r END) - any_value(n1) * (any_value(n1) + 1) / 2) / (any_value(n1) * (count(*) - any_value(n1))) AS auroc
  FROM (SELECT *, rank() OVER (PARTITION BY descriptor ORDER BY p) + (count(*) OVER (PARTITION BY descriptor, p) - 1) / 2 AS r, sum(y) OVER (PARTITION BY descriptor) AS n1 FROM sl) GROUP BY descriptor),
cut AS (SELECT descriptor, quantile_cont(ad, 0.05) AS ad_cutoff FROM ps GROUP BY descriptor),
sk0 AS (SELECT descriptor, greatest(0, auroc - 0.5) AS s FROM auc),
sk AS (SELECT descriptor, CASE WHEN (SELECT max(s) FROM sk0) > 0 THEN s ELSE 1 END AS skill FROM sk0)"""
