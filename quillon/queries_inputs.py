"""Registered queries of sources, sinks, preparation and the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions import text as tx
from quillon.functions.shared import shared_path
from quillon.operators import features, prep
from quillon.plans.fixtures import read
from quillon.registry import query
from quillon.sources import tables


# Sources and sinks; what is written goes to the shared folder and is read back


@query("SELECT p_partkey AS id, p_name AS structure, p_retailprice AS value FROM part")
def read_table(spark, sf_dir):
    """A CSV whose structure and value columns are told from its first rows."""
    at = shared_path(spark, "csv")
    read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_brand", F.col("p_name").alias("Smiles"), "p_retailprice").write.csv(at, header=True)
    df = tables.read_table(spark, at)
    head = tables.sniff(df)
    structure = tables.find_structure_column(head, tx.is_lexical_structure)
    value = tables.find_value_column(head, structure)
    return df.select(F.col("id").cast("long").alias("id"), F.col(f"`{structure}`").alias("structure"), F.col(f"`{value}`").cast("double").alias("value"))


@query("SELECT p_brand, sum(p_size) AS total FROM part GROUP BY 1")
def match_value_column(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return part.groupBy("p_brand").agg(F.sum(tables.resolve_columns(part, " P_SIZE ")).alias("total"))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS orig_idx, o_orderkey FROM orders")
def snapshot_input(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return tables.snapshot_input(orders, shared_path(spark, "snapshot"), order="o_orderkey").select("orig_idx", "o_orderkey")


def _matrix(spark, sf_dir) -> DataFrame:
    v = read(spark, sf_dir, "embeddings")
    id_ = F.col("vec_id").cast("string")
    return v.select(tx.store_key(id_).alias("key"), id_.alias("input"), F.transform("embedding", lambda x: F.greatest(x, F.lit(0.0).cast("float"))).alias("features"), F.concat(F.lit("d"), F.col("vec_id") % 3).alias("descriptor"), F.concat(F.lit("v"), F.col("vec_id") % 2 + 1).alias("version"))


MX = "mx AS (SELECT md5(CAST(vec_id AS VARCHAR)) AS key, CAST(vec_id AS VARCHAR) AS input, embedding AS e, 'd' || (vec_id % 3) AS descriptor, 'v' || (vec_id % 2 + 1) AS version FROM embeddings)"


@query(f"WITH {MX} SELECT descriptor, version, key, input FROM mx")
def write_read_features(spark, sf_dir):
    """Every descriptor and version of the store, each read from its own folder."""
    at = shared_path(spark, "features")
    tables.write_features(_matrix(spark, sf_dir), at)
    out = None
    for d in ("d0", "d1", "d2"):
        for v in ("v1", "v2"):
            one = tables.read_features(spark, at, d, v, keys_only=True)
            out = one if out is None else out.unionByName(one)
    return out


NEG = "[x FOR x IN {} IF x <= 0]"


@query(f"WITH z AS (SELECT CAST(sum(len({NEG.format('embedding')})) AS BIGINT) AS zeros, CAST(sum(len(embedding)) AS BIGINT) AS \"values\" FROM embeddings) SELECT *, zeros > 0.8 * \"values\" AS is_sparse FROM z")
def sparsity(spark, sf_dir):
    return tables.sparsity(_matrix(spark, sf_dir), rows=None)


@query(f"WITH {MX} SELECT descriptor, count(*) AS inputs, sum(len({NEG.format('e')})) > 0.8 * sum(len(e)) AS is_sparse, CAST(max(len(e)) AS BIGINT) AS features FROM mx GROUP BY 1")
def feature_info(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    columns = m.select("descriptor", F.posexplode("features").alias("column", "x")).select("descriptor", "column").distinct()
    return tables.feature_info(m, columns)


@query("SELECT 'part' AS name, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part UNION ALL SELECT 'orders', count(*), round(sum(o_totalprice), 2) FROM orders")
def write_results(spark, sf_dir):
    at = shared_path(spark, "results")
    value = {"part": "p_retailprice", "orders": "o_totalprice"}
    tables.write_results({n: read(spark, sf_dir, n) for n in value}, at)
    back = [tables.read_table(spark, f"{at}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n"), F.round(F.sum(F.col(c).cast("double")), 2).alias("total")) for n, c in value.items()]
    return back[0].unionByName(back[1])


@query("SELECT p_name, count(*) AS n FROM part GROUP BY 1")
def write_keys(spark, sf_dir):
    at = shared_path(spark, "keys")
    tables.write_keys(read(spark, sf_dir, "part"), at, "p_name")
    return tables.read_table(spark, at).groupBy("p_name").agg(F.count("*").alias("n"))


@query("SELECT vec_id AS compound_id, 'first' AS name, round(CAST(embedding[1] AS DOUBLE), 6) AS x, round(CAST(embedding[2] AS DOUBLE), 6) AS y FROM embeddings")
def write_projections(spark, sf_dir):
    at = shared_path(spark, "projections")
    points = _points(spark, sf_dir)
    tables.write_projections(points, points.groupBy("name").agg(F.count("*").alias("n")), at)
    return spark.read.schema(points.schema).parquet(f"{at}/projections")


def _points(spark, sf_dir):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("compound_id"), F.lit("first").alias("name"), at(0).alias("x"), at(1).alias("y"))


@query("SELECT event_id, 2::BIGINT AS records, CAST(regexp_extract(props, '\"k\": (\\d+)', 1) AS DOUBLE) AS k, true AS missing FROM events")
def decode_records(spark, sf_dir):
    """A list of two JSON records an event, the second without a value."""
    e = read(spark, sf_dir, "events")
    got = e.select("event_id", tables.decode_records(F.concat(F.lit("["), "props", F.lit(', {"k": null}]')), ["k"]).alias("r"))
    return got.select("event_id", F.size("r").cast("long").alias("records"), F.col("r")[0][0].alias("k"), F.isnan(F.col("r")[1][0]).alias("missing"))


@query("SELECT source AS descriptor, count(*) AS n FROM documents WHERE source IN (SELECT source FROM documents GROUP BY 1 HAVING count(*) % 2 = 0) GROUP BY 1")
def effective_descriptors(spark, sf_dir):
    done = read(spark, sf_dir, "documents").select(F.col("source").alias("descriptor"))
    selected = done.groupBy("descriptor").agg(F.count("*").alias("n")).filter("n % 2 = 0")
    return tables.effective_descriptors(done, selected).groupBy("descriptor").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN grouping(o_orderstatus) = 0 THEN 'o_orderstatus=' || o_orderstatus END AS dir, CAST(sum(strlen(o_orderpriority) + 1) AS BIGINT) AS bytes FROM orders GROUP BY ROLLUP (o_orderstatus)")
def store_size(spark, sf_dir):
    """A store of text files, whose bytes are known: a line and its end a row."""
    at = shared_path(spark, "sized")
    read(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").write.partitionBy("o_orderstatus").text(at)
    return tables.store_size(spark, at)


# Preparation


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END AS bin FROM orders")
def binarize_predict(spark, sf_dir):
    value = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "P", 0.5).otherwise(1.0)
    return prep.binarize(read(spark, sf_dir, "orders").select("o_orderkey", value.alias("value")), strict=False).select("o_orderkey", "bin")


@query("SELECT doc_id, quality FROM labels WHERE quality IS NOT NULL")
def labelled_only(spark, sf_dir):
    return prep.labelled_only(read(spark, sf_dir, "labels"), "quality").select("doc_id", "quality")


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN upper(p_name) ELSE p_name END AS standard_smiles FROM part")
def standardize(spark, sf_dir):
    part = read(spark, sf_dir, "part").withColumnRenamed("p_name", "smiles")
    return prep.standardize(part, lambda c: F.when(F.col("p_size") > 25, F.upper(c))).select("p_partkey", "standard_smiles")


@query("""WITH d AS (SELECT 'p' || p_partkey AS c FROM part WHERE p_size > 25),
r AS (SELECT c, row_number() OVER (ORDER BY CAST('0x' || substr(md5(c), 1, 8) AS BIGINT), c) - 1 AS uniq_idx FROM d)
SELECT l_orderkey * 10 + l_linenumber AS orig_idx, CAST(uniq_idx AS VARCHAR) AS uniq_idx, 'p' || l_partkey AS compound_id FROM lineitem LEFT JOIN r ON c = 'p' || l_partkey""")
def remap(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("orig_idx"), F.lit(0).alias("uniq_idx"), F.concat(F.lit("p"), "l_partkey").alias("compound_id"))
    data = read(spark, sf_dir, "part").filter("p_size > 25").select(F.concat(F.lit("p"), "p_partkey").alias("compound_id"))
    return prep.remap(lines, data).withColumn("uniq_idx", F.col("uniq_idx").cast("string"))


def _grams(text: str) -> str:
    return f"list_distinct([CAST('0x' || substr(md5(substr({text}, i, 3)), 1, 8) AS BIGINT) % 2048 FOR i IN range(1, greatest(length({text}) - 2, 1) + 1)])"


@query(f"""WITH g AS (SELECT {_grams("p_name")} AS a, {_grams("p_name || ' ' || p_type")} AS b FROM part ORDER BY md5(CAST(p_partkey AS VARCHAR)) LIMIT 10000)
SELECT count(*) AS n, count(CASE WHEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) < 0.6 THEN 1 END) AS discrepancies,
count(*) = 0 OR count(CASE WHEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) < 0.6 THEN 1 END) < 0.25 * count(*) AS ok FROM g""")
def check_structures(spark, sf_dir):
    part = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("smiles"), F.concat_ws(" ", "p_name", "p_type").alias("standard_smiles"))
    return prep.check_structures(part, tx.hashed_ngrams)


@query("SELECT event_id, user_id, event_type, props FROM events")
def drop_matching(spark, sf_dir):
    return prep.drop_matching(read(spark, sf_dir, "events").drop("ts"))


# The feature store


def _texts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("smiles"))


def _rows(df, extra):
    n = F.length("smiles").cast("double") + extra
    return df.select(tx.store_key(F.col("smiles")).alias("key"), F.col("smiles").alias("input"), F.array(n).alias("features"), F.lit("length").alias("descriptor"), F.lit("v1").alias("version"))


@query("SELECT doc_id, CASE WHEN text IN (SELECT text FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL) THEN length(text) ELSE length(text) + 0.5 END::DOUBLE AS value FROM documents")
def read_through(spark, sf_dir):
    """Texts of even ids are stored; the others are computed (with half a point more, to tell them apart)."""
    store = _rows(_texts(spark, sf_dir).filter("doc_id % 2 = 0 AND smiles IS NOT NULL"), 0.0)
    got, _ = features.read_through(_texts(spark, sf_dir), store, lambda df: _rows(df.filter("smiles IS NOT NULL"), 0.5))
    return got.select("doc_id", F.get("features", F.lit(0)).alias("value"))


@query("SELECT doc_id, CASE WHEN text IN (SELECT text FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL) THEN length(text) END::DOUBLE AS value FROM documents")
def read_subset(spark, sf_dir):
    store = _rows(_texts(spark, sf_dir).filter("doc_id % 3 = 0 AND smiles IS NOT NULL"), 0.0)
    return features.read_subset(store, _texts(spark, sf_dir).withColumnRenamed("smiles", "input")).select("doc_id", F.get("features", F.lit(0)).alias("value"))


@query("SELECT 'length' AS descriptor, 'v1' AS version, md5(text) AS key FROM documents WHERE text IS NOT NULL")
def contribute(spark, sf_dir):
    """Two appends to a store, even ids first, and all keys of it."""
    at = shared_path(spark, "store")
    for rest in (0, 1):
        features.contribute(_rows(_texts(spark, sf_dir).filter(f"doc_id % 2 = {rest} AND smiles IS NOT NULL"), 0.0), at)
    return tables.read_features(spark, at, keys_only=True).select("descriptor", "version", "key")


@query("SELECT md5(p_name) AS key, p_name NOT LIKE '%ring%' AS ok, CASE WHEN p_name NOT LIKE '%ring%' THEN length(p_name) END::DOUBLE AS width FROM part")
def featurize(spark, sf_dir):
    """Batches with rows that fail: only those rows are lost."""

    def lengths(values: list[str]) -> list:
        if any("ring" in v for v in values):
            raise ValueError("a structure that fails")
        return [[len(v)] for v in values]

    part = read(spark, sf_dir, "part").select(F.col("p_name").alias("smiles"))
    out = features.featurize(part, lengths, width=1, descriptor="length", version="v1")
    return out.select("key", "ok", F.get("features", F.lit(0)).cast("double").alias("width"))


@query("SELECT c_custkey AS descriptor, CASE WHEN c_custkey % 3 = 0 THEN 'v9' WHEN c_custkey % 2 = 0 THEN 'v2' ELSE 'v1' END AS version FROM customer")
def pin_versions(spark, sf_dir):
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("descriptor"))
    return features.pin_versions(c, c.filter("descriptor % 3 = 0").withColumn("version", F.lit("v9")), c.filter("descriptor % 2 = 0").withColumn("version", F.lit("v2")))


def _declared(spark, sf_dir):
    kind = F.element_at(F.array(F.lit("int"), F.lit("Float"), F.lit("integer"), F.lit("string")), F.when(F.col("p_size") % 10 == 0, 4).otherwise(F.col("p_size") % 3 + 1).cast("int"))
    return read(spark, sf_dir, "part").select(F.concat_ws(" ", "p_brand", "p_type", "p_name").alias("descriptor"), F.col("p_partkey").alias("column"), kind.alias("type"))


DC = "dc AS (SELECT concat_ws(' ', p_brand, p_type, p_name) AS descriptor, CASE WHEN p_size % 10 = 0 THEN 'string' WHEN p_size % 3 = 1 THEN 'Float' WHEN p_size % 3 = 0 THEN 'int' ELSE 'integer' END AS type FROM part)"


@query(f"WITH {DC} SELECT descriptor, CASE WHEN bool_or(type = 'Float') THEN 'float' ELSE 'int' END AS dtype, count(*) AS width FROM dc GROUP BY 1")
def matrix_dtype(spark, sf_dir):
    return features.matrix_dtype(_declared(spark, sf_dir))


@query(f"WITH {DC} SELECT descriptor, bool_and(type <> 'string') AND count(*) % 2 = 0 AS ok FROM dc GROUP BY 1")
def check_roles(spark, sf_dir):
    return features.check_roles(_declared(spark, sf_dir), "projections")


@query(f"WITH {MX} SELECT (SELECT count(*) FROM mx) AS n, (SELECT sum(w)::BIGINT FROM (SELECT max(len(e)) AS w FROM mx GROUP BY descriptor)) AS width")
def matrix_extent(spark, sf_dir):
    m = _matrix(spark, sf_dir)
    columns = m.select("descriptor", F.posexplode("features").alias("column", "x")).select("descriptor", "column").distinct()
    return features.matrix_extent(m, m, columns)


@query("SELECT DISTINCT l_partkey AS descriptor, 'v' || (l_linenumber % 2) AS version FROM lineitem EXCEPT SELECT l_partkey, 'v' || (l_linenumber % 2) FROM lineitem WHERE l_returnflag = 'A' AND l_quantity > 45")
def missing_transformers(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").withColumns({"descriptor": F.col("l_partkey"), "version": F.concat(F.lit("v"), F.col("l_linenumber") % 2)})
    return features.missing_transformers(lines.select("descriptor", "version").distinct(), lines.filter("l_returnflag = 'A' AND l_quantity > 45"))


@query("""SELECT vec_id AS compound_id, unnest(['a', 'b']) AS name, round(CAST(unnest([embedding[1], embedding[3]]) AS DOUBLE), 6) AS x, round(CAST(unnest([embedding[2], embedding[4]]) AS DOUBLE), 6) AS y FROM embeddings""")
def pair_projections(spark, sf_dir):
    """Columns a_1, a_2, b_1, b_2 and a single c_1, which is left out."""
    names = ["a_1", "a_2", "b_1", "b_2", "c_1"]
    wide = read(spark, sf_dir, "embeddings").select("vec_id", *(F.get("embedding", F.lit(i)).alias(n) for i, n in enumerate(names)))
    return features.pair_projections(wide, "vec_id")
