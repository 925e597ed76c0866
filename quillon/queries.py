"""Registered queries over the given tables, each with the same rows in DuckDB SQL where SQL can express them.

Measures are rounded to six digits in both, for sums add up in different orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.functions import text as tx
from quillon.functions.curves import logit, sigmoid
from quillon.functions.shared import kept, shared_path
from quillon.operators import bagging, calibrate, estimate, features, logistic, metrics, outputs, pooling, prep, ranking, scaling, splits, telemetry
from quillon.plans import fixtures as fx
from quillon.plans.fixtures import DESCRIPTORS, labelled, ranked_scores, read
from quillon.operators.subsets import PRIME
from quillon.operators.subsets import factors as subset_factors
from quillon.registry import query, rounded

BY = ["descriptor"]


# Preparation


def _entities(spark, sf_dir):
    """Rows with compound_id, valid and, as value, the text's length: what is needed of texts is taken where they are read."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("orig_idx"), "text", F.length("text").cast("string").alias("value"))
    return prep.normalize(prep.validate(docs, _valid, "text"), "text", "value", more=["valid"])


IDS = """d AS (SELECT doc_id, text FROM documents), f AS (SELECT text, min(doc_id) AS first_idx FROM d WHERE text IS NOT NULL GROUP BY text),
i AS (SELECT text, first_idx, 'CID' || lpad(CAST(row_number() OVER (ORDER BY first_idx) - 1 AS VARCHAR), CAST(length(CAST((SELECT count(*) FROM f) AS VARCHAR)) AS INTEGER), '0') AS compound_id FROM f)"""


@query(f"WITH {IDS} SELECT first_idx, compound_id FROM i")
def assign_ids(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("orig_idx"), "text")
    return prep.assign_ids(docs, "text").select("first_idx", "compound_id")


def _valid(c):
    return F.length(c) >= 100


@query(f"""WITH {IDS}, u AS (SELECT compound_id, row_number() OVER (ORDER BY first_idx) - 1 AS uniq_idx FROM i WHERE length(text) >= 100)
SELECT d.doc_id AS orig_idx, CAST(uniq_idx AS VARCHAR) AS uniq_idx, u.compound_id FROM d LEFT JOIN i ON d.text = i.text LEFT JOIN u ON i.compound_id = u.compound_id""")
def dedupe_mapping(spark, sf_dir):
    return prep.dedupe(_entities(spark, sf_dir))[0].withColumn("uniq_idx", F.col("uniq_idx").cast("string"))


@query(f"""WITH {IDS} SELECT d.doc_id AS orig_idx, i.compound_id, CAST(length(i.text) AS VARCHAR) AS value FROM d LEFT JOIN i ON d.text = i.text AND length(i.text) >= 100""")
def map_to_original(spark, sf_dir):
    mapping, entities = prep.dedupe(_entities(spark, sf_dir), ("value",))
    return outputs.map_to_original(entities.select("compound_id", "value"), mapping)


def _part_labels(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("compound_id"), (F.col("l_returnflag") == "R").cast("double").alias("value"))


@query("SELECT l_partkey AS compound_id, CASE WHEN median(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM lineitem GROUP BY l_partkey")
def reconcile_labels(spark, sf_dir):
    return prep.reconcile_labels(_part_labels(spark, sf_dir))


@query("SELECT l_suppkey AS compound_id, median(CAST(l_quantity AS DOUBLE)) AS value FROM lineitem GROUP BY l_suppkey")
def reconcile_values(spark, sf_dir):
    return prep.reconcile_labels(read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("compound_id"), F.col("l_quantity").cast("double").alias("value")), "regression")


@query("""WITH m AS (SELECT l_partkey AS k, CASE WHEN median(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0 END) >= 0.5 THEN 1 ELSE 0 END AS v FROM lineitem GROUP BY 1)
SELECT l_partkey AS compound_id, count(*) AS conflicts FROM lineitem JOIN m ON k = l_partkey WHERE abs(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END - v) > 0.01 GROUP BY 1""")
def label_conflicts(spark, sf_dir):
    rows = _part_labels(spark, sf_dir)
    return prep.label_conflicts(rows, prep.reconcile_labels(rows)).groupBy("compound_id").agg(F.count("*").alias("conflicts"))


@query("SELECT count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, CAST(count(*) - sum(y) AS BIGINT) AS n_neg FROM (SELECT doc_id, CASE WHEN max(quality) > 0 THEN 1 ELSE 0 END AS y FROM labels GROUP BY doc_id)")
def binarize_counts(spark, sf_dir):
    values = fx.labels(spark, sf_dir).select("compound_id", F.col("y").cast("double").alias("value"))
    return prep.class_counts(prep.binarize(values, min_class=None))


@query()
def lexical_validity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word"))
    return words.select("doc_id", tx.is_lexical_structure(F.col("word")).alias("ok")).groupBy("doc_id").agg(F.count_if("ok").alias("valid"), F.count("*").alias("words"))


def _labelled_docs(spark, sf_dir):
    standard = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("compound_id"), F.lower("text").alias("standard_smiles"))
    return standard, fx.labels(spark, sf_dir).withColumnRenamed("y", "bin")


@query("SELECT doc_id AS compound_id, md5(lower(text)) AS smiles, CAST(q AS INTEGER) AS bin FROM documents JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id)")
def merge_fit(spark, sf_dir):
    return prep.merge_fit(*_labelled_docs(spark, sf_dir)).withColumn("smiles", F.md5("smiles"))


@query("SELECT doc_id AS compound_id, md5(lower(text)) AS smiles, CAST(q AS VARCHAR) AS bin FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id)")
def merge_predict(spark, sf_dir):
    return prep.merge_predict(*_labelled_docs(spark, sf_dir)).withColumns({"smiles": F.md5("smiles"), "bin": F.col("bin").cast("string")})


@query(f"""SELECT doc_id, len(list_intersect(list_distinct(s), [{", ".join(f"'{m}'" for m in prep.METALS)}])) > 0 OR len(list_filter(s, lambda x: x = 'B')) > 7 AS excluded
FROM (SELECT doc_id, regexp_extract_all(text, '[A-Z][a-z]?') AS s FROM documents)""")
def element_exclusion(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", prep.exclude_by_tokens(F.col("text")).alias("excluded"))


@query("""WITH w AS (SELECT doc_id, string_split(text, '.') AS p FROM documents), r AS (SELECT doc_id, p, list_filter(p, lambda x: NOT list_contains(['', ' '], x)) AS q FROM w)
SELECT doc_id, CAST(len(list_distinct(CASE WHEN len(q) = 0 THEN p ELSE q END)) AS INTEGER) AS parts FROM r""")
def strip_components(spark, sf_dir):
    banned = F.array(F.lit(""), F.lit(" "))
    kept = prep.strip_components(F.col("text"), [banned])
    return read(spark, sf_dir, "documents").select("doc_id", F.size(F.split(kept, r"\.")).alias("parts"))


@query("SELECT l_orderkey, l_linenumber, greatest(2000.0::DOUBLE, least(50000.0::DOUBLE, CAST(l_extendedprice AS DOUBLE))) AS value FROM lineitem")
def clip_label(spark, sf_dir):
    from quillon.functions.curves import clip

    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", clip(F.col("l_extendedprice").cast("double"), 2000.0, 50000.0).alias("value"))


@query("SELECT l_quantity AS value, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > greatest(0.01 * (SELECT count(*) FROM lineitem), 3)")
def repeat_values(spark, sf_dir):
    return prep.repeated_values(read(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("value")), "value")


@query("""WITH k AS (SELECT quantile_cont(CAST(p_retailprice AS DOUBLE), [i / 100 FOR i IN range(0, 101)]) AS k FROM part),
x AS (SELECT p_partkey, CAST(p_retailprice AS DOUBLE) AS v, k, len(list_filter(k, lambda q: q <= CAST(p_retailprice AS DOUBLE))) AS b FROM part, k)
SELECT p_partkey, round(CASE WHEN b = 0 THEN 0 WHEN b > 100 THEN 1 ELSE (b - 1 + (v - k[b]) / (k[b + 1] - k[b])) / 100 END, 6) AS u FROM x""")
def quantile_uniform(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("v"))
    return part.select("p_partkey", prep.apply_quantiles(F.col("v"), prep.fit_quantiles(part, "v")).alias("u"))


@query("""WITH v AS (SELECT p_partkey, p_retailprice AS x FROM part), y AS (SELECT p_partkey, l, CASE WHEN abs(l) < 1e-9 THEN ln(1 + x) ELSE (pow(1 + x, l) - 1) / l END AS y FROM v, (SELECT round(-4 + 8 * i / 80.0::DOUBLE, 6) AS l FROM range(81) t(i))),
g AS (SELECT l, var_pop(y) AS s, avg(y) AS m, count(*) AS n FROM y GROUP BY l), b AS (SELECT l, m, sqrt(s) AS s FROM g ORDER BY -0.5 * n * ln(greatest(s, 1e-300)) + (l - 1) * (SELECT sum(ln(1 + x)) FROM v) DESC LIMIT 1)
SELECT p_partkey, round((y - m) / s, 6) AS z FROM y JOIN b USING (l)""")
def power_transform(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("double").alias("v"))
    return part.select("p_partkey", prep.apply_power(F.col("v"), prep.fit_power(part, "v")).alias("z"))


@query("""WITH r AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_quantity AS value, l_extendedprice AS e FROM lineitem), c AS (SELECT value, count(*) AS n FROM r GROUP BY 1),
nb AS (SELECT value, n, lag(value) OVER (ORDER BY value) AS lo, lead(value) OVER (ORDER BY value) AS hi FROM c), e AS (SELECT quantile_cont(value, 0.01) AS p1, quantile_cont(value, 0.99) AS p99 FROM r),
h AS (SELECT * FROM nb WHERE n > greatest(0.01 * (SELECT sum(n) FROM c), 3)),
s AS (SELECT id, r.value, n, greatest((coalesce(lo, r.value) + r.value) / 2, least(p1, r.value)) AS a, least((coalesce(hi, r.value) + r.value) / 2, greatest(p99, r.value)) AS b, row_number() OVER (PARTITION BY r.value ORDER BY e, id) AS k FROM r LEFT JOIN h USING (value), e)
SELECT id, value, round(CASE WHEN n IS NULL THEN value ELSE a + (b - a) * (k - 0.5) / n END, 6) AS smoothed FROM s""")
def smooth_repeats(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), F.col("l_quantity").cast("double").alias("value"), "l_extendedprice")
    return prep.smooth_repeats(rows, "value", "l_extendedprice", "id").select("id", "value", "smoothed")


@query("SELECT doc_id, md5(text) AS key, sha256(lower(text)) AS structure_key FROM documents")
def store_key(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", tx.store_key(F.col("text")).alias("key"), tx.structure_key(F.lower("text")).alias("structure_key"))


@query("""WITH a AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(lower(url), '[^a-z0-9.-]', '-', 'g'), '-{2,}', '-', 'g'), '^[-.]+|[-.]+$', '', 'g') AS s FROM pages)
SELECT page_id, substr(CASE WHEN s = '' THEN 'unnamed-store' WHEN length(s) < 3 THEN s || '-store' ELSE s END, 1, 63) AS name FROM a""")
def sanitize_name(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", tx.sanitize_name(F.col("url")).alias("name"))


@query("SELECT doc_id, 'NA' AS smiles, 'NA' AS inchikey, n_chars AS clf FROM documents")
def anonymize(spark, sf_dir):
    """A row a document; the structure, its key and two property columns go."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("smiles"), F.md5("text").alias("inchikey"), F.col("n_chars").alias("MolWt"), F.col("lang").alias("sim_lang"), F.col("n_chars").alias("clf"))
    return prep.anonymize(docs)


# Feature store


def _keyed(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(F.md5("text").alias("key"), "doc_id", F.col("source").alias("descriptor")).filter(F.col("key").isNotNull())


@query("SELECT source AS descriptor, count(*) AS n FROM documents WHERE md5(text) IN (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0) GROUP BY 1")
def store_semi(spark, sf_dir):
    rows = _keyed(spark, sf_dir)
    return features.stored(rows, rows.filter("doc_id % 2 = 0")).groupBy("descriptor").agg(F.count("*").alias("n"))


@query("SELECT source AS descriptor, count(*) AS n FROM documents WHERE text IS NOT NULL AND md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL) GROUP BY 1")
def store_anti(spark, sf_dir):
    rows = _keyed(spark, sf_dir)
    return features.absent(rows, rows.filter("doc_id % 2 = 0")).groupBy("descriptor").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT DISTINCT source AS d, md5(text) AS k FROM documents WHERE text IS NOT NULL), p AS (SELECT DISTINCT source AS d, md5(text) AS k, 1 AS p FROM documents WHERE doc_id % 2 = 0),
l AS (SELECT DISTINCT source AS d, md5(text) AS k, 1 AS l FROM documents WHERE doc_id % 3 = 0)
SELECT d AS descriptor, count(*) AS n, count(p) AS in_project, count(CASE WHEN p IS NULL AND l = 1 THEN 1 END) AS in_lake, count(CASE WHEN p IS NULL AND l IS NULL THEN 1 END) AS to_compute,
round(100.0 * count(CASE WHEN p = 1 OR l = 1 THEN 1 END) / count(*), 6) AS pct_stored FROM k LEFT JOIN p USING (d, k) LEFT JOIN l USING (d, k) GROUP BY 1""")
def coverage(spark, sf_dir):
    rows = _keyed(spark, sf_dir)
    return features.coverage(rows, rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 3 = 0"))


@query("""SELECT source AS descriptor, count(DISTINCT md5(text)) AS n FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL
AND (source, md5(text)) NOT IN (SELECT (source, md5(text)) FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL) GROUP BY 1""")
def migrate(spark, sf_dir):
    rows = _keyed(spark, sf_dir)
    return features.migrate(rows, rows.filter("doc_id % 3 = 0"), rows.filter("doc_id % 2 = 0")).groupBy("descriptor").agg(F.count("*").alias("n"))


def _tags(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    tags = o.select(F.col("o_custkey").alias("descriptor"), F.concat(F.lit("v"), (F.col("o_orderkey") % 7).cast("string"), F.lit(".0."), (F.col("o_orderkey") % 3).cast("string")).alias("tag"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("last_updated"), (F.col("o_orderkey") % 2).alias("digest"))
    local = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("descriptor"), (F.col("c_custkey") % 2).alias("digest"))
    return tags, local


@query("""WITH t AS (SELECT o_custkey AS k, o_orderkey % 7 AS m, strftime(o_orderdate, '%Y-%m-%d') AS u, o_orderkey % 2 AS g FROM orders),
l AS (SELECT c_custkey AS k, c_custkey % 2 AS g FROM customer), x AS (SELECT l.k, max(t.u) AS u FROM l JOIN t ON t.k = l.k AND t.g = l.g GROUP BY 1)
SELECT l.k AS descriptor, 'v' || CAST(coalesce((SELECT arg_max(m, (t.u, m)) FROM t WHERE t.k = l.k AND t.u <= x.u), 1) AS VARCHAR) AS version FROM l LEFT JOIN x ON x.k = l.k""")
def version_as_of(spark, sf_dir):
    return features.version_as_of(*_tags(spark, sf_dir))


@query("""WITH w AS (SELECT c_custkey AS d, 'v' || CAST(c_custkey % 3 AS VARCHAR) AS v FROM customer), s AS (SELECT o_custkey AS d, list_sort(list_distinct(list('v' || CAST(o_orderkey % 4 AS VARCHAR)))) AS o FROM orders GROUP BY 1)
SELECT d AS descriptor, v AS version, array_to_string(o, ',') AS others FROM w JOIN s USING (d) WHERE NOT list_contains(o, v)""")
def version_mismatch(spark, sf_dir):
    wanted = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("descriptor"), F.concat(F.lit("v"), (F.col("c_custkey") % 3).cast("string")).alias("version"))
    store = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("descriptor"), F.concat(F.lit("v"), (F.col("o_orderkey") % 4).cast("string")).alias("version"))
    return features.version_mismatch(wanted, store).withColumn("others", F.array_join("others", ","))


@query("""SELECT source AS descriptor, CAST(count(*) AS BIGINT) AS n_total, CAST(count(CASE WHEN doc_id % 3 = 0 THEN 1 END) AS BIGINT) AS n_from_store, CAST(count(CASE WHEN doc_id % 3 <> 0 THEN 1 END) AS BIGINT) AS n_computed,
round(100.0 * count(CASE WHEN doc_id % 3 = 0 THEN 1 END) / count(*), 6) AS pct_reused FROM documents GROUP BY ROLLUP (source)""")
def provenance(spark, sf_dir):
    d = read(spark, sf_dir, "documents")
    return features.provenance(d.groupBy(F.col("source").alias("descriptor")).agg(F.count("*").alias("n_total"), F.count_if(F.col("doc_id") % 3 == 0).alias("n_from_store"), F.count_if(F.col("doc_id") % 3 != 0).alias("n_computed")))


def _tri_sets(spark, sf_dir):
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("compound_id"), tx.hashed_ngrams(F.lower("p_name")).alias("bits"))


TRI = "t AS (SELECT p_partkey AS k, list_distinct([CAST('0x' || substr(md5(substr(lower(p_name), i, 3)), 1, 8) AS BIGINT) % 2048 FOR i IN range(1, greatest(length(p_name) - 2, 1) + 1)]) AS s FROM part)"


@query(f"WITH {TRI} SELECT k AS compound_id, CAST(len(s) AS INTEGER) AS n, CAST(list_sum(s) AS BIGINT) AS total FROM t")
def hashed_ngrams(spark, sf_dir):
    return _tri_sets(spark, sf_dir).select("compound_id", F.size("bits").alias("n"), F.aggregate("bits", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query(f"""WITH {TRI}, g AS (SELECT list_reduce(list(s ORDER BY k), lambda a, b: a) AS z FROM t)
SELECT t.k AS compound_id, round(CAST(len(list_intersect(t.s, g.z)) AS DOUBLE) / len(list_distinct(list_concat(t.s, g.z))), 6) AS similarity FROM t, g""")
def shingle_jaccard(spark, sf_dir):
    sets = _tri_sets(spark, sf_dir)
    first = sets.agg(F.min_by("bits", "compound_id").alias("z"))
    return sets.join(F.broadcast(first)).select("compound_id", tx.tanimoto(F.col("bits"), F.col("z")).alias("similarity"))


@query(f"WITH {TRI} SELECT k AS id, max(k) OVER w AS rep, count(*) OVER w AS n FROM t WINDOW w AS (PARTITION BY list_sort(s))")
def set_classes(spark, sf_dir):
    return splits.set_classes(_tri_sets(spark, sf_dir))


@query(f"""WITH {TRI}, u AS (SELECT max(k) AS k, list_sort(s) AS s FROM t GROUP BY list_sort(s)) SELECT a.k AS a, b.k AS b, round(CAST(len(list_intersect(a.s, b.s)) AS DOUBLE) / len(list_distinct(list_concat(a.s, b.s))), 6) AS similarity
FROM u a JOIN u b ON a.k < b.k WHERE CAST(len(list_intersect(a.s, b.s)) AS DOUBLE) / len(list_distinct(list_concat(a.s, b.s))) >= 0.7 - 1e-9""")
def similar_pairs(spark, sf_dir):
    return splits.similar_pairs(_tri_sets(spark, sf_dir), 0.3)


# Scaling


def _vectors(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("compound_id"), F.col("embedding").alias("features"), (F.col("label") % 2).alias("y"))


STATS = "e AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), f AS (SELECT pos, median(x) AS m, quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS s FROM e GROUP BY pos)"


@query(f"WITH {STATS} SELECT CAST(pos AS INTEGER) AS pos, 'f' || CAST(pos AS VARCHAR) AS feature, round(m, 6) AS center, round(s, 6) AS scale, round(m, 6) AS fill, s = 0 AS is_constant FROM f")
def feature_stats(spark, sf_dir):
    return scaling.fit_transformer(_vectors(spark, sf_dir))


@query(f"WITH {STATS} SELECT vec_id AS compound_id, round(sum(abs(CAST((x - m) / s AS FLOAT)::DOUBLE)), 3) AS total FROM e JOIN f USING (pos) GROUP BY 1")
def scale_features(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    out = scaling.apply_transformer(v, scaling.fit_transformer(v))
    return out.select("compound_id", F.round(F.aggregate("features", F.lit(0.0), lambda a, x: a + F.abs(x.cast("double"))), 3).alias("total"))


# Splits


def _fold_data(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("compound_id"), F.col("doc_id").alias("orig_idx"), F.col("source").alias("group"))
    return d.join(fx.labels(spark, sf_dir).withColumnRenamed("y", "bin"), "compound_id")


FD = "fd AS (SELECT d.doc_id AS compound_id, source AS grp, CAST(q AS INTEGER) AS bin FROM documents d JOIN (SELECT doc_id, max(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1) l USING (doc_id))"


@query(f"WITH {FD} SELECT compound_id, bin, row_number() OVER (PARTITION BY bin ORDER BY md5(CAST(compound_id AS VARCHAR) || '-7'), compound_id) <= round(0.2 * count(*) OVER (PARTITION BY bin)) AS is_test FROM fd")
def split_random(spark, sf_dir):
    return splits.split_random(_fold_data(spark, sf_dir), 7)


@query(f"""WITH {FD}, g AS (SELECT grp, count(*) AS n FROM fd GROUP BY 1)
SELECT grp AS "group", n, coalesce(sum(n) OVER (ORDER BY md5(grp || '-7') ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < (SELECT round(0.2 * sum(n)) FROM g) AS is_test FROM g""")
def assign_groups(spark, sf_dir):
    return splits.assign_groups(_fold_data(spark, sf_dir), 7)


@query(f"""WITH RECURSIVE {FD}, g AS (SELECT grp, count(*) AS n, min(compound_id) AS f FROM fd GROUP BY 1), o AS (SELECT *, row_number() OVER (ORDER BY n DESC, f) AS r FROM g),
room AS (SELECT CAST(floor(0.8 * sum(n)) AS BIGINT) AS m FROM g),
w AS (SELECT CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS used, CAST(NULL AS BOOLEAN) AS t UNION ALL SELECT o.r, CASE WHEN w.used + o.n <= m THEN w.used + o.n ELSE w.used END, w.used + o.n > m FROM w JOIN o ON o.r = w.r + 1, room)
SELECT o.grp AS "group", o.n, w.t AS is_test FROM o JOIN w USING (r)""")
def split_deterministic(spark, sf_dir):
    return splits.split_deterministic(_fold_data(spark, sf_dir))


def _memberships(spark, sf_dir):
    data = _fold_data(spark, sf_dir)
    out = None
    for seed in (1, 2, 3):
        one = splits.split_random(data, seed).withColumn("fold", F.lit(f"random_{seed:02d}"))
        out = one if out is None else out.unionByName(one)
    return out


MB = FD + ", m AS (SELECT 'random_0' || s AS fold, compound_id, bin, row_number() OVER (PARTITION BY s, bin ORDER BY md5(CAST(compound_id AS VARCHAR) || '-' || s), compound_id) <= round(0.2 * count(*) OVER (PARTITION BY s, bin)) AS is_test FROM fd, (SELECT unnest(['1', '2', '3']) AS s))"


@query(f"WITH {MB} SELECT fold, count(CASE WHEN NOT is_test THEN 1 END) AS n_train, count(CASE WHEN is_test THEN 1 END) AS n_test, round(avg(CASE WHEN is_test THEN bin END), 6) AS test_rate, round(avg(CASE WHEN NOT is_test THEN bin END), 6) AS train_rate FROM m GROUP BY fold")
def fold_balance(spark, sf_dir):
    return splits.fold_balance(_memberships(spark, sf_dir))


@query(f"""WITH {MB}, t AS (SELECT fold, compound_id FROM m WHERE is_test), n AS (SELECT fold, count(*) AS n FROM t GROUP BY 1), x AS (SELECT a.fold AS a, b.fold AS b, count(*) AS c FROM t a JOIN t b ON a.compound_id = b.compound_id AND a.fold < b.fold GROUP BY ALL)
SELECT p.fold AS a, q.fold AS b, round(coalesce(c, 0) / (p.n + q.n - coalesce(c, 0)), 6) AS jaccard FROM n p JOIN n q ON p.fold < q.fold LEFT JOIN x ON x.a = p.fold AND x.b = q.fold""")
def fold_jaccard(spark, sf_dir):
    return splits.fold_jaccard(_memberships(spark, sf_dir))


@query(f"WITH {MB} SELECT fold, bool_and(k = 2) AND count(*) = 2 AS ok FROM (SELECT fold, is_test, count(DISTINCT bin) AS k FROM m GROUP BY ALL) GROUP BY fold")
def both_classes(spark, sf_dir):
    return splits.both_classes(_memberships(spark, sf_dir))


def _grouped(data, strategy):
    """The three kinds of units: entities, sources, and openings (many small groups)."""
    opening = F.substring(F.md5(F.substring(F.coalesce("text", F.lit("")), 1, 2)), 1, 4)
    return data if strategy != "opening" else data.withColumn("group", opening)


@query(f"""WITH {FD.replace("d.doc_id AS compound_id,", "d.doc_id AS compound_id, substr(md5(substr(coalesce(text, ''), 1, 2)), 1, 4) AS opening,")}, s AS (SELECT unnest(range(50)) AS seed),
r AS (SELECT 'random' AS strategy, seed, compound_id, bin, row_number() OVER (PARTITION BY seed, bin ORDER BY md5(compound_id || '-' || seed)) <= round(0.2 * count(*) OVER (PARTITION BY seed, bin)) AS t FROM fd, s),
k AS (SELECT 'source' AS strategy, grp AS k, compound_id, bin FROM fd UNION ALL SELECT 'opening', opening, compound_id, bin FROM fd), g AS (SELECT strategy, k, count(*) AS n FROM k GROUP BY ALL),
gs AS (SELECT strategy, seed, k, coalesce(sum(n) OVER (PARTITION BY strategy, seed ORDER BY md5(k || '-' || seed) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < round(0.2 * sum(n) OVER (PARTITION BY strategy, seed)) AS t FROM g, s),
m AS (SELECT * FROM r UNION ALL SELECT strategy, seed, compound_id, bin, t FROM k JOIN gs USING (strategy, k)),
q AS (SELECT strategy, seed, abs(avg(CASE WHEN NOT t THEN bin END) - avg(bin)) + abs(avg(CASE WHEN t THEN bin END) - avg(bin)) AS balance, abs(avg(CASE WHEN t THEN 1 ELSE 0 END) - 0.2) AS off, count(CASE WHEN t THEN 1 END) AS n
  FROM m GROUP BY ALL HAVING count(DISTINCT CASE WHEN t THEN bin END) = 2 AND count(DISTINCT CASE WHEN NOT t THEN bin END) = 2),
b AS (SELECT x.strategy, x.seed AS a, y.seed AS b, count(*) AS c FROM m x JOIN m y ON x.strategy = y.strategy AND x.compound_id = y.compound_id AND x.t AND y.t GROUP BY ALL),
j AS (SELECT q.strategy, q.seed AS a, z.seed AS b, coalesce(c, 0) / (q.n + z.n - coalesce(c, 0)) AS j FROM q JOIN q z USING (strategy) LEFT JOIN b ON b.strategy = q.strategy AND b.a = q.seed AND b.b = z.seed),
one AS (SELECT strategy, arg_min(seed, (round(balance + off, 12), seed)) AS s1 FROM q GROUP BY 1),
two AS (SELECT strategy, s1, arg_min(seed, (round(balance + off + j, 12), seed)) AS s2 FROM one JOIN q USING (strategy) JOIN j ON j.strategy = one.strategy AND j.a = s1 AND j.b = seed WHERE seed <> s1 GROUP BY ALL),
three AS (SELECT two.strategy, s1, s2, arg_min(seed, (round(balance + off + greatest(x.j, y.j), 12), seed)) AS s3 FROM two JOIN q USING (strategy) JOIN j x ON x.strategy = two.strategy AND x.a = s1 AND x.b = seed JOIN j y ON y.strategy = two.strategy AND y.a = s2 AND y.b = seed WHERE seed NOT IN (s1, s2) GROUP BY ALL),
c AS (SELECT strategy, 0 AS place, s1 AS seed FROM three UNION ALL SELECT strategy, 1, s2 FROM three UNION ALL SELECT strategy, 2, s3 FROM three)
SELECT strategy, strategy || '_0' || place AS fold, CAST(seed AS INTEGER) AS seed, round(balance, 6) AS balance, q.n AS n_test, round((SELECT sum(j.j) / 2 FROM j JOIN c o ON o.strategy = j.strategy AND o.seed = j.b WHERE j.strategy = c.strategy AND j.a = c.seed AND o.seed <> c.seed), 6) AS mean_jaccard
FROM c JOIN q USING (strategy, seed)""")
def select_folds(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("compound_id"), F.col("source").alias("group"), "text")
    data = kept(docs.join(fx.labels(spark, sf_dir).withColumnRenamed("y", "bin"), "compound_id"), "data")
    out = None
    for strategy in ("random", "source", "opening"):
        member, meta = splits.select_folds(_grouped(data, strategy), strategy, 3)
        table = spark.createDataFrame([(strategy, m["fold"], m["seed"], m["balance"], m["mean_jaccard"]) for m in meta], "strategy string, fold string, seed int, balance double, mean_jaccard double")
        one = table.join(member.groupBy("fold").agg(F.count_if("is_test").alias("n_test")), "fold")
        out = one if out is None else out.unionByName(one)
    return out


@query()
def fold_menu(spark, sf_dir):
    data = kept(_fold_data(spark, sf_dir), "data")
    clusters = splits.groups_butina(_tri_sets(spark, sf_dir), 0.4).withColumnRenamed("id", "compound_id")
    member, _ = splits.build_folds(data, 2, groups={"scaffold": data.select("compound_id", "group"), "butina": clusters})
    return splits.fold_balance(member)


@query()
def butina(spark, sf_dir):
    return splits.groups_butina(_tri_sets(spark, sf_dir), 0.4)


# Metrics


@query("SELECT descriptor, count(*) AS n, CAST(sum(y) AS BIGINT) AS n1, CAST(count(*) - sum(y) AS BIGINT) AS n0, round(100 * avg(y), 6) AS pct1, round(100 - 100 * avg(y), 6) AS pct0 FROM sl GROUP BY 1", scores=True)
def class_counts(spark, sf_dir):
    return metrics.class_counts(labelled(spark, sf_dir), BY)


@query("SELECT descriptor, round(auroc, 6) AS auroc FROM auc", scores=True)
def auroc(spark, sf_dir):
    return metrics.auroc(labelled(spark, sf_dir), BY)


@query("SELECT descriptor, round(p, 6) AS threshold, round((cn - cn1) / (t - t1), 6) AS fpr, round(cn1 / t1, 6) AS tpr FROM cum UNION ALL SELECT DISTINCT descriptor, NULL, 0.0, 0.0 FROM cum", scores=True)
def roc_points(spark, sf_dir):
    return metrics.roc_curve(labelled(spark, sf_dir), BY)


@query('SELECT descriptor, round(p, 6) AS threshold, round(cn1 / cn, 6) AS "precision", round(cn1 / t1, 6) AS recall FROM cum UNION ALL SELECT DISTINCT descriptor, NULL, 1.0, 0.0 FROM cum', scores=True)
def pr_points(spark, sf_dir):
    return metrics.pr_curve(labelled(spark, sf_dir), BY)


@query("SELECT descriptor, round(sum(n1 / t1 * (CASE WHEN cn - n > 0 THEN (cn1 - n1) / (cn - n) ELSE 1 END + cn1 / cn) / 2), 6) AS aupr FROM cum GROUP BY 1", scores=True)
def aupr_trapezoid(spark, sf_dir):
    return metrics.aupr_trapezoid(labelled(spark, sf_dir), BY)


@query("SELECT descriptor, round(sum(n1 / t1 * cn1 / cn), 6) AS ap FROM cum GROUP BY 1", scores=True)
def average_precision(spark, sf_dir):
    return metrics.average_precision(labelled(spark, sf_dir), BY)


CF = ", cf AS (SELECT descriptor, count(CASE WHEN p >= {t} AND y = 1 THEN 1 END) AS tp, count(CASE WHEN p < {t} AND y = 0 THEN 1 END) AS tn, count(CASE WHEN p >= {t} AND y = 0 THEN 1 END) AS fp, count(CASE WHEN p < {t} AND y = 1 THEN 1 END) AS fn FROM {s} GROUP BY {g})"
PM = 'round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS "precision", round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1, round(coalesce((CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / nullif(sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 6) AS mcc'


@query(CF.format(t="0.15", s="sl", g="1") + " SELECT * FROM cf", scores=True)
def confusion(spark, sf_dir):
    return metrics.confusion(labelled(spark, sf_dir), BY, 0.15)


@query(CF.format(t="0.15", s="sl", g="1") + " SELECT *, " + PM + " FROM cf", scores=True)
def point_metrics(spark, sf_dir):
    return metrics.point_metrics(labelled(spark, sf_dir), BY, 0.15)


@query(CF.format(t="0.15", s="sl", g="1") + """ SELECT descriptor, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS row_tp, round(coalesce(fn / nullif(tp + fn, 0), 0), 6) AS row_fn, round(coalesce(tn / nullif(tn + fp, 0), 0), 6) AS row_tn, round(coalesce(fp / nullif(tn + fp, 0), 0), 6) AS row_fp,
round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS col_tp, round(coalesce(fp / nullif(tp + fp, 0), 0), 6) AS col_fp, round(coalesce(tn / nullif(tn + fn, 0), 0), 6) AS col_tn, round(coalesce(fn / nullif(tn + fn, 0), 0), 6) AS col_fn FROM cf""", scores=True)
def confusion_shares(spark, sf_dir):
    return metrics.normalized_confusion(labelled(spark, sf_dir), BY, 0.15)


PK = ", ".join(f"round(avg(CASE WHEN r <= {k} THEN y END), 6) AS precision_at_{k}" for k in metrics.TOP)


@query(f"SELECT descriptor, {PK} FROM (SELECT *, row_number() OVER (PARTITION BY descriptor ORDER BY p DESC, compound_id) AS r FROM sl) GROUP BY 1", scores=True)
def precision_at_k(spark, sf_dir):
    return metrics.precision_at_k(labelled(spark, sf_dir), BY, "compound_id")


def drawn_sql(rows: str, subsets: int = 100, size: float = 0.2) -> str:
    """Tables for the threshold search on `rows` (descriptor, compound_id, p, y): dr holds the rows of each subset, kp the
    cells of each threshold that a descriptor's prevalence allows, cu the cutoffs."""
    lists = [[subset_factors(s)[i] for s in range(subsets)] for i in (0, 1)]
    part = lambda at: f"CAST('0x' || substr(md5(compound_id || '-42'), {at}, 8) AS BIGINT) % {PRIME}"
    return f""", su AS (SELECT unnest(range({subsets})) AS subset, unnest({lists[0]}) AS f0, unnest({lists[1]}) AS f1),
hs AS (SELECT descriptor, compound_id, p, y, {part(1)} AS a, {part(9)} AS b, count(*) OVER (PARTITION BY descriptor, y) AS n FROM {rows}),
dr AS (SELECT descriptor, subset, p, y FROM hs, su QUALIFY row_number() OVER (PARTITION BY descriptor, y, subset ORDER BY (a * f0 + b * f1) % {PRIME}, a, b, CAST(compound_id AS VARCHAR)) <= round({size} * n)),
th AS (SELECT descriptor, threshold FROM (SELECT descriptor, greatest(avg(y), 0.6) AS top FROM {rows} GROUP BY 1), (SELECT unnest({metrics.GRID})::DOUBLE AS threshold) WHERE threshold < top - 1e-9),
kp AS (SELECT descriptor, subset, threshold, CAST(count(CASE WHEN p >= threshold AND y = 1 THEN 1 END) AS DOUBLE) AS tp, CAST(count(CASE WHEN p < threshold AND y = 0 THEN 1 END) AS DOUBLE) AS tn, CAST(count(CASE WHEN p >= threshold AND y = 0 THEN 1 END) AS DOUBLE) AS fp, CAST(count(CASE WHEN p < threshold AND y = 1 THEN 1 END) AS DOUBLE) AS fn FROM dr JOIN th USING (descriptor) GROUP BY ALL),
kc AS (SELECT *, tp + tn + fp + fn AS n, ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / ((tp + tn + fp + fn) * (tp + tn + fp + fn)) AS e FROM kp),
ka AS (SELECT descriptor, threshold, round(median(CASE WHEN e >= 1 THEN 0 ELSE ((tp + tn) / n - e) / (1 - e) END), 6) AS kappa FROM kc GROUP BY ALL),
cu AS (SELECT descriptor, arg_max(threshold, (kappa, -threshold)) AS cutoff FROM ka GROUP BY 1)"""


_TEST = "substr(md5(CAST(compound_id AS VARCHAR)), 1, 1) < '4'"


@query(f""", tr AS (SELECT * FROM sl WHERE NOT {_TEST}), te AS (SELECT * FROM sl WHERE {_TEST}){drawn_sql("tr")},
tc AS (SELECT descriptor, count(*) AS num_train, CAST(count(*) - sum(y) AS BIGINT) AS num_train_0, CAST(sum(y) AS BIGINT) AS num_train_1 FROM tr GROUP BY 1),
tn AS (SELECT descriptor, count(*) AS num_test, CAST(count(*) - sum(y) AS BIGINT) AS num_test_0, CAST(sum(y) AS BIGINT) AS num_test_1 FROM te GROUP BY 1),
tx AS (SELECT te.*, cutoff FROM te JOIN cu USING (descriptor)){CF.format(t="cutoff", s="tx", g="1")},
pk AS (SELECT descriptor, {PK} FROM (SELECT *, row_number() OVER (PARTITION BY descriptor ORDER BY p DESC, compound_id) AS r FROM te) GROUP BY 1),
tcu AS (SELECT *, sum(n) OVER w AS cn, sum(n1) OVER w AS cn1, sum(n1) OVER (PARTITION BY descriptor) AS t1 FROM (SELECT descriptor, p, count(*) AS n, sum(y) AS n1 FROM te GROUP BY ALL) WINDOW w AS (PARTITION BY descriptor ORDER BY p DESC)),
tz AS (SELECT descriptor, round(sum(n1 / t1 * (CASE WHEN cn - n > 0 THEN (cn1 - n1) / (cn - n) ELSE 1 END + cn1 / cn) / 2), 6) AS aupr FROM tcu GROUP BY 1),
ta AS (SELECT descriptor, round((sum(CASE WHEN y = 1 THEN r END) - any_value(n1) * (any_value(n1) + 1) / 2) / (any_value(n1) * (count(*) - any_value(n1))), 6) AS auroc
  FROM (SELECT *, rank() OVER (PARTITION BY descriptor ORDER BY p) + (count(*) OVER (PARTITION BY descriptor, p) - 1) / 2 AS r, sum(y) OVER (PARTITION BY descriptor) AS n1 FROM te) GROUP BY descriptor)
SELECT *, {PM} FROM tc JOIN tn USING (descriptor) JOIN cu USING (descriptor) JOIN cf USING (descriptor) JOIN pk USING (descriptor) JOIN tz USING (descriptor) JOIN ta USING (descriptor)""", scores=True)
def performance_row(spark, sf_dir):
    rows = kept(labelled(spark, sf_dir), "labelled")
    test = F.substring(F.md5(F.col("compound_id").cast("string")), 1, 1) < "4"
    return metrics.performance(rows.filter(test), BY, "compound_id", train=rows.filter(~test))


@query(", th AS (SELECT unnest([" + ", ".join(map(str, metrics.SWEEP)) + "])::DOUBLE AS threshold)" + ", cf AS (SELECT descriptor, threshold, count(CASE WHEN p >= threshold AND y = 1 THEN 1 END) AS tp, count(CASE WHEN p < threshold AND y = 0 THEN 1 END) AS tn, count(CASE WHEN p >= threshold AND y = 0 THEN 1 END) AS fp, count(CASE WHEN p < threshold AND y = 1 THEN 1 END) AS fn FROM sl, th GROUP BY ALL)"
       + 'SELECT descriptor, threshold, "precision", recall, f1, mcc FROM (SELECT *, ' + PM + " FROM cf)", scores=True)
def threshold_sweep(spark, sf_dir):
    return metrics.threshold_sweep(labelled(spark, sf_dir), BY)


@query(drawn_sql("sl") + " SELECT descriptor, threshold, kappa FROM ka", scores=True)
def threshold_kappa(spark, sf_dir):
    return metrics.threshold_kappa(labelled(spark, sf_dir), BY, "compound_id")


@query(drawn_sql("sl") + """, rs AS (SELECT descriptor, threshold, median(coalesce(tp / nullif(tp + fn, 0), 0)) AS a, median(coalesce(tn / nullif(tn + fp, 0), 0)) AS b FROM kp GROUP BY ALL)
SELECT descriptor, threshold, round(a, 6) AS sensitivity, round(b, 6) AS specificity, round(coalesce(2 * a * b / nullif(a + b, 0), 0), 6) AS harmonic FROM rs""", scores=True)
def threshold_roc(spark, sf_dir):
    return metrics.threshold_roc(labelled(spark, sf_dir), BY, "compound_id")


@query()
def threshold_draws(spark, sf_dir):
    return metrics.threshold_roc(labelled(spark, sf_dir), BY, "compound_id", replacement=True)


@query(drawn_sql("sl") + " SELECT * FROM cu", scores=True)
def cutoffs(spark, sf_dir):
    return metrics.cutoffs(labelled(spark, sf_dir), BY, "compound_id")


GRID = metrics.threshold_grid(0.0)


@query(", th AS (SELECT unnest([" + ", ".join(map(str, GRID)) + "])::DOUBLE AS threshold), c AS (SELECT descriptor, threshold, CAST(count(CASE WHEN p >= threshold AND y = 1 THEN 1 END) AS DOUBLE) AS tp, CAST(count(CASE WHEN p < threshold AND y = 0 THEN 1 END) AS DOUBLE) AS tn, CAST(count(CASE WHEN p >= threshold AND y = 0 THEN 1 END) AS DOUBLE) AS fp, CAST(count(CASE WHEN p < threshold AND y = 1 THEN 1 END) AS DOUBLE) AS fn FROM sl, th GROUP BY ALL),"
       + "k AS (SELECT *, tp + tn + fp + fn AS n, ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / ((tp + tn + fp + fn) * (tp + tn + fp + fn)) AS e FROM c), v AS (SELECT descriptor, threshold, round(CASE WHEN e >= 1 THEN 0 ELSE ((tp + tn) / n - e) / (1 - e) END, 3) AS value FROM k) SELECT descriptor, arg_max(threshold, (value, threshold)) AS threshold, max(value) AS value FROM v GROUP BY 1", scores=True)
def threshold_oob(spark, sf_dir):
    return metrics.threshold_oob(labelled(spark, sf_dir), BY, GRID)


@query(", v AS (SELECT descriptor, p, cn1 / t1 AS a, 1 - (cn - cn1) / (t - t1) AS b FROM cum), w AS (SELECT descriptor, p, round(coalesce(2 * a * b / nullif(a + b, 0), 0), 6) AS value FROM v) SELECT descriptor, round(arg_max(p, (value, p)), 6) AS threshold, max(value) AS value FROM w GROUP BY 1", scores=True)
def threshold_oob_roc(spark, sf_dir):
    return metrics.threshold_oob(labelled(spark, sf_dir), BY, [], "roc")


@query("SELECT descriptor, round((min(CASE WHEN rank_q > 0.5 THEN p END) + max(CASE WHEN NOT rank_q > 0.5 THEN p END)) / 2, 6) AS threshold FROM sl GROUP BY 1", scores=True)
def operating_point(spark, sf_dir):
    return metrics.operating_point(fx.labelled_ranks(spark, sf_dir), BY, F.col("rank_q") > 0.5)


EDGES = ", ".join(f"{e!r}::DOUBLE" for e in metrics.CALIBRATION_EDGES)


@query(f"SELECT descriptor, CAST(least(9, greatest(0, len(list_filter([{EDGES}], lambda e: p >= e)) - 1)) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 6) AS mean_p, round(avg(y), 6) AS rate FROM sl GROUP BY ALL", scores=True)
def calibration(spark, sf_dir):
    return metrics.calibration(labelled(spark, sf_dir), BY)


@query("SELECT descriptor, round(avg((p - y) ** 2), 6) AS brier FROM sl GROUP BY 1", scores=True)
def brier(spark, sf_dir):
    return metrics.brier(labelled(spark, sf_dir), BY)


RK = ", rk AS (SELECT descriptor, compound_id, row_number() OVER w AS k, sum(y) OVER (PARTITION BY descriptor ORDER BY p DESC, compound_id ROWS UNBOUNDED PRECEDING) AS f, count(*) OVER (PARTITION BY descriptor) AS n, sum(y) OVER (PARTITION BY descriptor) AS n1 FROM sl WINDOW w AS (PARTITION BY descriptor ORDER BY p DESC, compound_id))"


@query(RK + " SELECT descriptor, k, round(k / n, 6) AS screened, round(f / n1, 6) AS gain, round(least(k / n1, 1), 6) AS ideal, round(k / n, 6) AS random FROM rk", scores=True)
def cumulative_gain(spark, sf_dir):
    return metrics.cumulative_gain(labelled(spark, sf_dir), BY, "compound_id").withColumn("k", F.col("k").cast("long"))


@query(RK + " SELECT descriptor, k, round((f / k) / (n1 / n), 6) AS ef FROM rk WHERE k >= greatest(1, round_even(0.005 * n, 0))", scores=True)
def enrichment(spark, sf_dir):
    return metrics.enrichment(labelled(spark, sf_dir), BY, "compound_id").withColumn("k", F.col("k").cast("long"))


@query("SELECT descriptor, compound_id, round(rank_q, 6) AS rank_q FROM ps", scores=True)
def percentile_rank(spark, sf_dir):
    return ranked_scores(spark, sf_dir).select("descriptor", "compound_id", "rank_q")


@query(", pv AS (SELECT descriptor, avg(y) AS v FROM sl GROUP BY 1) SELECT descriptor, compound_id, round(p, 6) AS probability, round(ln(least(1 - 1e-6, greatest(1e-6, p)) / (1 - least(1 - 1e-6, greatest(1e-6, p)))), 6) AS log_odds, round((row_number() OVER (PARTITION BY descriptor ORDER BY p, compound_id) - 1) / (count(*) OVER (PARTITION BY descriptor) - 1), 6) AS rank, round(p / v, 6) AS lift, round(p, 6) AS raw FROM sl JOIN pv USING (descriptor)", scores=True)
def score_lens(spark, sf_dir):
    return metrics.score_lens(labelled(spark, sf_dir).select("compound_id", "descriptor", "p", "y"), BY, "compound_id")


@query("SELECT descriptor, y, " + ", ".join(f"round(quantile_cont(p, {q / 100}), 6) AS p{q}" for q in (5, 25, 50, 75, 95)) + " FROM sl GROUP BY ALL", scores=True)
def five_number(spark, sf_dir):
    return metrics.five_number(labelled(spark, sf_dir), "p", ["descriptor", "y"])


@query("SELECT l_returnflag, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs(y - p)), 6) AS mae FROM (SELECT l_returnflag, CAST(l_extendedprice AS DOUBLE) AS y, CAST(p_retailprice AS DOUBLE) * CAST(l_quantity AS DOUBLE) * 0.9 AS p FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1")
def regression_metrics(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return metrics.regression_metrics(rows.select("l_returnflag", F.col("l_extendedprice").cast("double").alias("y"), (F.col("p_retailprice").cast("double") * F.col("l_quantity").cast("double") * 0.9).alias("p")), ["l_returnflag"])


# Pooling


@query("SELECT descriptor, round(skill, 6) AS skill FROM sk", scores=True)
def base_scores(spark, sf_dir):
    return pooling.fit_pool(fx.signals(spark, sf_dir)).select("descriptor", "skill")


CURVE = """, re AS (SELECT descriptor, rank_q, abs(p - y) AS e, row_number() OVER (PARTITION BY descriptor ORDER BY rank_q, compound_id) - 1 AS i, count(*) OVER (PARTITION BY descriptor) AS n FROM sl),
kn AS (SELECT descriptor, n, k, round_even(j * (n - 1) / (k - 1), 0) AS pos, greatest(1, n // (2 * k)) AS hw, j FROM (SELECT DISTINCT descriptor, n, least(20, n) AS k FROM re) q, range(0, 20) r(j) WHERE j < k),
cu AS (SELECT kn.descriptor, j, max(CASE WHEN i = pos THEN rank_q END) AS r, avg(e) AS e FROM kn JOIN re ON re.descriptor = kn.descriptor AND i BETWEEN pos - hw AND pos + hw GROUP BY kn.descriptor, j)"""


@query(CURVE + " SELECT descriptor, CAST(j AS INTEGER) AS knot, round(r, 6) AS r, round(e, 6) AS e FROM cu", scores=True)
def rank_error_curve(spark, sf_dir):
    c = estimate.rank_error_curve(fx.labelled_ranks(spark, sf_dir), BY)
    return c.select("descriptor", F.posexplode("curve").alias("knot", "k")).select("descriptor", "knot", "k.r", "k.e")


POOL = CURVE + """, cv AS (SELECT descriptor, list({'r': r, 'e': e} ORDER BY r) AS c FROM cu GROUP BY 1),
b AS (SELECT ps.*, c, skill, ad_cutoff, list_filter(c, lambda x: x.r <= rank_q) AS lo, list_filter(c, lambda x: x.r > rank_q) AS hi FROM ps JOIN cv USING (descriptor) JOIN sk USING (descriptor) JOIN cut USING (descriptor)),
rl AS (SELECT *, CASE WHEN len(lo) = 0 THEN hi[1].e WHEN len(hi) = 0 THEN lo[-1].e ELSE lo[-1].e + (hi[1].e - lo[-1].e) * (rank_q - lo[-1].r) / (hi[1].r - lo[-1].r) END AS er FROM b),
w0 AS (SELECT *, ad < ad_cutoff AS v, CASE WHEN ad < ad_cutoff THEN 0 ELSE 0.5 * skill + 0.5 * least(1, greatest(0, 1 - er)) END AS w FROM rl),
w1 AS (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY compound_id) > 0 THEN w ELSE skill END AS w) FROM w0),
w2 AS (SELECT * REPLACE (w / sum(w) OVER (PARTITION BY compound_id) AS w), least(1 - 1e-7, greatest(1e-7, p)) AS q FROM w1)"""


def _weighted(spark, sf_dir):
    ranked = kept(ranked_scores(spark, sf_dir), "ranked")
    return pooling.weights(ranked, pooling.fit_pool(fx.signals(spark, sf_dir, ranked)))


def _pooled(spark, sf_dir):
    return pooling.pool(_weighted(spark, sf_dir))


# the isotonic rate of a score is the greatest, over first scores up to it, of the least rate over last scores from it on
ISO = """, ix AS (SELECT descriptor, p, n, n1, row_number() OVER w AS i, sum(n) OVER w AS cn, sum(n1) OVER w AS c1 FROM sc WINDOW w AS (PARTITION BY descriptor ORDER BY p)),
jk AS (SELECT a.descriptor, a.i AS j, b.i AS k, (b.c1 - a.c1 + a.n1) / (b.cn - a.cn + a.n) AS m FROM ix a JOIN ix b ON a.descriptor = b.descriptor AND b.i >= a.i),
mn AS (SELECT descriptor, j, k AS i, min(m) OVER (PARTITION BY descriptor, j ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS v FROM jk),
iso AS (SELECT descriptor, p, rate FROM (SELECT descriptor, i, max(v) AS rate FROM mn GROUP BY ALL) JOIN ix USING (descriptor, i)),
bl AS (SELECT descriptor, round(rate, 12) AS rate, min(p) AS lo, max(p) AS hi FROM iso GROUP BY ALL), kk AS (SELECT descriptor, lo AS x, rate FROM bl UNION SELECT descriptor, hi, rate FROM bl),
kz AS (SELECT descriptor, x AS x0, rate AS r0, lead(x) OVER w AS x1, lead(rate) OVER w AS r1, min(rate) OVER (PARTITION BY descriptor) AS least FROM kk WINDOW w AS (PARTITION BY descriptor ORDER BY x))"""


@query(ISO + " SELECT descriptor, round(lo, 6) AS lo, round(hi, 6) AS hi, round(rate, 6) AS rate FROM bl", scores=True)
def isotonic(spark, sf_dir):
    return calibrate.fit_isotonic(labelled(spark, sf_dir), BY, "p").select("descriptor", "lo", "hi", "rate")


@query(POOL + ISO + """, cl AS (SELECT w2.compound_id, w2.w, s.p, CASE WHEN x0 IS NULL THEN (SELECT min(least) FROM kz z WHERE z.descriptor = s.descriptor) WHEN x1 IS NULL THEN r0 ELSE r0 + (r1 - r0) * (s.p - x0) / (x1 - x0) END AS c
  FROM w2 JOIN ps s USING (compound_id, descriptor) ASOF LEFT JOIN kz ON kz.descriptor = s.descriptor AND s.p >= kz.x0), cq AS (SELECT compound_id, w, least(1 - 1e-7, greatest(1e-7, p)) AS a, least(1 - 1e-7, greatest(1e-7, c)) AS b FROM cl)
SELECT compound_id, round(1 / (1 + exp(-sum(w * ln(b / (1 - b))))), 5) AS clf, round(1 / (1 + exp(-sum(w * ln(a / (1 - a))))), 5) AS clf_raw FROM cq GROUP BY 1""", scores=True)
def pool_raw(spark, sf_dir):
    """Calibrated scores pooled beside the raw ones."""
    knots = calibrate.knots_of(calibrate.fit_isotonic(labelled(spark, sf_dir), BY, "p"), BY)
    rows = calibrate.calibrated(_weighted(spark, sf_dir).withColumnRenamed("p", "p_raw"), knots, BY)
    return pooling.pool(rows, raw=True).select("compound_id", F.round("clf", 5).alias("clf"), F.round("clf_raw", 5).alias("clf_raw"))


@query(POOL + " SELECT descriptor, compound_id, round(least(1, greatest(0, 1 - er)), 6) AS reliability FROM rl", scores=True)
def reliability(spark, sf_dir):
    ranked = kept(ranked_scores(spark, sf_dir), "ranked")
    rows = ranked.join(F.broadcast(pooling.fit_pool(fx.signals(spark, sf_dir, ranked))), "descriptor")
    return rows.select("descriptor", "compound_id", pooling.reliability(F.col("rank_q"), F.col("curve"), F.col("has_curve")).alias("reliability"))


@query(POOL + " SELECT compound_id, round(1 / (1 + exp(-sum(w * ln(q / (1 - q))))), 6) AS clf, round(sum(w * rank_q), 6) AS clf_rank, round(1 - avg(CASE WHEN v THEN 1 ELSE 0 END), 6) AS clf_ad, CAST(1 / (1 + exp(-sum(w * ln(q / (1 - q))))) > 0.5 AS INTEGER) AS clf_bin FROM w2 GROUP BY 1", scores=True)
def pool(spark, sf_dir):
    return _pooled(spark, sf_dir)


@query(POOL + " SELECT descriptor, count(CASE WHEN v THEN 1 END) AS vetoes, round(avg(w), 6) AS mean_weight, count(*) AS entities FROM w2 GROUP BY 1 UNION ALL SELECT NULL, CAST(sum(CASE WHEN a THEN 1 ELSE 0 END) AS BIGINT), NULL, count(*) FROM (SELECT compound_id, bool_and(v) AS a FROM w2 GROUP BY 1)", scores=True)
def pool_summary(spark, sf_dir):
    return pooling.pool_summary(_weighted(spark, sf_dir)).withColumns({"vetoes": F.col("vetoes").cast("long")})


@query(POOL + " SELECT compound_id, round(1 - avg(CASE WHEN v THEN 1 ELSE 0 END), 6) AS domain FROM w2 GROUP BY 1", scores=True)
def domain_fraction(spark, sf_dir):
    return pooling.domain_fraction(_weighted(spark, sf_dir))


@query("SELECT compound_id, round(median(p), 6) AS clf FROM ps GROUP BY 1", scores=True)
def bag_median(spark, sf_dir):
    return pooling.bag_median(fx.scores(spark, sf_dir))


@query("SELECT descriptor, round(1 - abs((SELECT quantile_cont(auroc, 0.66) FROM auc) - auroc), 6) AS w FROM auc", scores=True)
def weights_leads(spark, sf_dir):
    return pooling.w_leads(metrics.auroc(labelled(spark, sf_dir), BY), "auroc")


@query(""", qd AS (SELECT descriptor, quantile_cont(p, 0.25) AS a, median(p) AS m, quantile_cont(p, 0.75) AS b FROM ps GROUP BY 1), qa AS (SELECT quantile_cont(p, 0.25) AS a, median(p) AS m, quantile_cont(p, 0.75) AS b FROM ps),
ld AS (SELECT descriptor, 1 - abs((SELECT quantile_cont(auroc, 0.66) FROM auc) - auroc) AS w FROM auc), z AS (SELECT compound_id, w, (p - qd.m) / (CASE WHEN qd.b = qd.a THEN 1 ELSE qd.b - qd.a END) * (qa.b - qa.a) + qa.m AS z FROM ps JOIN qd USING (descriptor) JOIN ld USING (descriptor), qa)
SELECT compound_id, round(sum(w * z) / sum(w), 6) AS reg FROM z GROUP BY 1""", scores=True)
def bag_scaling(spark, sf_dir):
    whole, rows = fx.scored(spark, sf_dir)
    return pooling.bag_scaling(whole, [pooling.w_leads(metrics.auroc(rows, BY), "auroc")])


@query(", ln AS (SELECT descriptor, regr_slope(y, p) AS s, regr_intercept(y, p) AS i FROM sl GROUP BY 1) SELECT compound_id, round(avg(s * p + i), 6) AS reg FROM ps JOIN ln USING (descriptor) GROUP BY 1", scores=True)
def bag_reg_model(spark, sf_dir):
    whole, rows = fx.scored(spark, sf_dir)
    return bagging.apply_bag(whole, bagging.fit_bag(rows, "model", "regression"))


@query("SELECT compound_id, " + ", ".join(f"round(CAST(max(CASE WHEN descriptor = '{d}' THEN p END) AS FLOAT)::DOUBLE, 5) AS \"model-{d}-clf\"" for d in DESCRIPTORS) + " FROM ps GROUP BY 1", scores=True)
def stack(spark, sf_dir):
    return rounded(pooling.stack(fx.scores(spark, sf_dir)), 5)


@query(", q AS (SELECT ps.descriptor, compound_id, p FROM ps) SELECT q.descriptor, compound_id, round(coalesce((SELECT sum(n) FROM sc WHERE sc.descriptor = q.descriptor AND sc.p <= q.p), 0) / (SELECT sum(n) FROM sc WHERE sc.descriptor = q.descriptor), 6) AS rank_q FROM q", scores=True)
def rank_quantile(spark, sf_dir):
    got = estimate.rank_quantile(fx.scores(spark, sf_dir).drop("n_chars"), labelled(spark, sf_dir).select("descriptor", "p"), BY)
    return got.select("descriptor", "compound_id", "rank_q")


# Ranking and outputs


def _avg_pool(spark, sf_dir):
    """The plain logit mean: enough for tables that only need a pooled column."""
    s = fx.scores(spark, sf_dir).groupBy("compound_id").agg(sigmoid(F.avg(logit(F.col("p")))).alias("clf"), F.avg("p").alias("clf_rank"), F.min("p").alias("clf_ad"))
    return s.withColumn("clf_bin", (F.col("clf") > 0.5).cast("int"))


AP = ", ap AS (SELECT compound_id, 1 / (1 + exp(-avg(ln(least(1 - 1e-7, greatest(1e-7, p)) / (1 - least(1 - 1e-7, greatest(1e-7, p))))))) AS clf, avg(p) AS clf_rank, min(p) AS clf_ad, stddev_pop(p) AS sd, avg(p) AS mean FROM ps GROUP BY 1)"


@query(AP + " SELECT CAST(row_number() OVER (ORDER BY round(clf, 9) DESC, compound_id) AS INTEGER) AS rank, compound_id, round(clf, 4) AS clf, CAST(clf > 0.5 AS INTEGER) AS clf_bin, round(sd, 6) AS std, round(clf_ad, 6) AS clf_ad FROM ap ORDER BY 1 LIMIT 25", scores=True)
def hit_list(spark, sf_dir):
    pooled = _avg_pool(spark, sf_dir).withColumn("clf", F.round("clf", 9))
    return ranking.hit_list(pooled, fx.scores(spark, sf_dir)).withColumn("clf", F.round("clf", 4))


@query(AP + " SELECT compound_id, round(clf, 4) AS clf, round(100 * row_number() OVER (ORDER BY round(clf, 9) DESC, compound_id) / count(*) OVER (), 6) AS pct FROM ap", scores=True)
def rank_curve(spark, sf_dir):
    return ranking.rank_curve(_avg_pool(spark, sf_dir).withColumn("clf", F.round("clf", 9))).withColumn("clf", F.round("clf", 4))


@query(AP + " SELECT compound_id, round(clf, 6) AS clf, round(sd, 6) AS std, round(mean, 6) AS mean FROM ap", scores=True)
def consensus(spark, sf_dir):
    return ranking.consensus(fx.scores(spark, sf_dir), _avg_pool(spark, sf_dir))


@query(""", r AS (SELECT compound_id, descriptor, rank() OVER (PARTITION BY descriptor ORDER BY p) + (count(*) OVER (PARTITION BY descriptor, p) - 1) / 2 AS r FROM ps)
SELECT a.descriptor AS a, b.descriptor AS b, round(corr(a.r, b.r), 6) AS rho FROM r a JOIN r b ON a.compound_id = b.compound_id AND a.descriptor < b.descriptor GROUP BY ALL""", scores=True)
def spearman(spark, sf_dir):
    return ranking.spearman_matrix(fx.scores(spark, sf_dir), DESCRIPTORS)


@query(""", pl AS (SELECT compound_id, descriptor, row_number() OVER (PARTITION BY descriptor ORDER BY p DESC, compound_id) AS r FROM s0),
pr AS (SELECT a.descriptor AS x, b.descriptor AS y, greatest(a.r, b.r) AS d FROM pl a JOIN pl b ON a.compound_id = b.compound_id AND a.descriptor < b.descriptor),
lo AS (SELECT n, greatest(1, round_even(0.005 * n, 0)) AS lo FROM (SELECT CAST(count(DISTINCT compound_id) AS DOUBLE) AS n FROM s0)),
ks AS (SELECT DISTINCT CAST(least(n, greatest(1, round_even(lo * pow(n / lo, i / 39.0::DOUBLE), 0))) AS INTEGER) AS k FROM lo, range(40) t(i)),
sh AS (SELECT k, x, y, sum(CASE WHEN d <= k THEN 1 ELSE 0 END) / k AS share FROM ks, pr GROUP BY k, x, y)
SELECT k, round(avg(share), 6) AS mean, round(quantile_cont(share, 0.1), 6) AS p10, round(quantile_cont(share, 0.9), 6) AS p90 FROM sh GROUP BY k""", scores=True)
def topk_overlap(spark, sf_dir):
    return ranking.topk_overlap(fx.scores(spark, sf_dir), DESCRIPTORS)


@query(", h AS (SELECT descriptor, CAST(least(floor(p * 24), 23) AS INTEGER) AS bin, count(*) AS n FROM ps WHERE p BETWEEN 0 AND 1 GROUP BY ALL) SELECT descriptor, bin, n, round(n / sum(n) OVER (PARTITION BY descriptor) * 24, 6) AS density FROM h", scores=True)
def histogram(spark, sf_dir):
    return ranking.histogram(fx.scores(spark, sf_dir), "p", BY, bins=24)


@query("SELECT CAST(round_even(100 * avg(y), 0) AS INTEGER) AS active, CAST(100 - round_even(100 * avg(y), 0) AS INTEGER) AS inactive FROM lab", scores=True)
def class_percent(spark, sf_dir):
    return ranking.class_percent(fx.labels(spark, sf_dir).withColumnRenamed("y", "bin"))


@query(AP + ", wd AS (SELECT compound_id, " + ", ".join(f"max(CASE WHEN descriptor = '{d}' THEN p END) AS {d}" for d in DESCRIPTORS) + """ FROM ps GROUP BY 1)
SELECT doc_id AS orig_idx, compound_id, sha256(lower(t)) AS key, CAST(y AS VARCHAR) AS true_value, round(clf, 6) AS clf, """ + ", ".join(f"round({d}, 6) AS {d}" for d in DESCRIPTORS) + " FROM d JOIN ap ON compound_id = doc_id JOIN wd USING (compound_id) LEFT JOIN lab USING (compound_id)", scores=True)
def output_table(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    inputs = docs.select(F.col("doc_id").alias("orig_idx"), F.col("text").alias("smiles"))
    mapping = docs.select(F.col("doc_id").alias("orig_idx"), F.col("doc_id").alias("compound_id"))
    standard = docs.select(F.col("doc_id").alias("compound_id"), F.lower("text").alias("standard_smiles"))
    truth = fx.labels(spark, sf_dir).withColumnRenamed("y", "bin")
    out = outputs.output_table(inputs, mapping, standard, _avg_pool(spark, sf_dir).select("compound_id", "clf"), fx.scores(spark, sf_dir), DESCRIPTORS, truth=truth)
    return out.drop("input_smiles", "smiles").withColumn("true_value", F.col("true_value").cast("string"))


@query(", ck AS (SELECT descriptor, sum(n1 / t1 * cn1 / cn) AS ap FROM cum GROUP BY 1) SELECT descriptor, round(auroc, 6) AS auroc, round(ap, 6) AS ap, round(auroc + 0.06, 6) AS train_auroc, 0.5::DOUBLE AS cutoff, 0.06::DOUBLE AS gap, 'medium' AS gap_level FROM auc JOIN ck USING (descriptor)", scores=True)
def cv_table(spark, sf_dir):
    rows = labelled(spark, sf_dir)
    train = metrics.auroc(rows, BY).select("descriptor", (F.col("auroc") + 0.06).alias("train_auroc"))
    return metrics.cv_table(rows, train, train.select("descriptor", F.lit(0.5).alias("cutoff")))


@query(f""", {MB}, h AS (SELECT fold, bin AS y, p FROM m JOIN s0 USING (compound_id) WHERE is_test AND descriptor = 'len'),
ra AS (SELECT *, rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2 AS r FROM h),
ha AS (SELECT fold, sum(y) AS n1, count(*) - sum(y) AS n0, (sum(CASE WHEN y = 1 THEN r END) - n1 * (n1 + 1) / 2) / (n1 * n0) AS auroc FROM ra GROUP BY 1),
hp AS (SELECT fold, p, count(*) AS n, sum(y) AS n1 FROM h GROUP BY 1, 2), hc AS (SELECT *, sum(n) OVER w AS cn, sum(n1) OVER w AS cn1, sum(n1) OVER (PARTITION BY fold) AS t1 FROM hp WINDOW w AS (PARTITION BY fold ORDER BY p DESC)),
hv AS (SELECT fold, sum(n1 / t1 * (CASE WHEN cn - n > 0 THEN (cn1 - n1) / (cn - n) ELSE 1 END + cn1 / cn) / 2) AS aupr FROM hc GROUP BY 1),
b AS (SELECT fold, count(CASE WHEN NOT is_test THEN 1 END) AS num_train, count(CASE WHEN is_test THEN 1 END) AS num_test, CAST(sum(CASE WHEN is_test THEN bin END) AS BIGINT) AS num_test_1, round(avg(CASE WHEN is_test THEN bin END), 6) AS test_ratio FROM m GROUP BY 1)
SELECT 'random' AS strategy, fold, CAST(right(fold, 2) AS INTEGER) AS seed, round(auroc, 6) AS auroc, round(aupr, 6) AS aupr, num_train, num_test, num_test_1, test_ratio FROM b JOIN ha USING (fold) JOIN hv USING (fold)""", scores=True)
def validation_table(spark, sf_dir):
    member = _memberships(spark, sf_dir)
    test = member.filter("is_test").join(fx.scores(spark, sf_dir).filter("descriptor = 'len'"), "compound_id").select("fold", "compound_id", F.col("bin").alias("y"), "p")
    quality = metrics.auroc(test, ["fold"]).join(metrics.aupr_trapezoid(test, ["fold"]), "fold")
    meta = member.select("fold").distinct().select(F.lit("random").alias("strategy"), "fold", F.regexp_extract("fold", r"(\d+)$", 1).cast("int").alias("seed"))
    return outputs.validation_table(quality, meta, splits.fold_balance(member))


# Telemetry on events: a user is a run, an event type a step


def _log(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("run"), F.col("event_type").alias("name"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"), F.col("value").cast("double").alias("cpu"), (F.col("value") / 10).cast("double").alias("ram_used_gb"), F.lit(64.0).alias("ram_total_gb"))


LG = "lg AS (SELECT user_id AS run, event_type AS name, epoch_us(ts) / 1e6 AS t, CAST(value AS DOUBLE) AS cpu FROM events), st AS (SELECT run, name, min(t) AS f, max(t) AS t FROM lg WHERE name NOT IN ('report', 'finish') GROUP BY ALL), sd AS (SELECT run, name, f, greatest(0, t - coalesce(lag(t) OVER (PARTITION BY run ORDER BY f, name), f)) AS s FROM st)"


@query(f"WITH {LG} SELECT run, name, round(s, 3) AS seconds FROM sd")
def step_durations(spark, sf_dir):
    return telemetry.step_durations(_log(spark, sf_dir)).select("run", "name", F.round("seconds", 3).alias("seconds"))


@query(f"WITH {LG} SELECT run, round(max(cpu), 6) AS cpu, round(max(cpu) / 10, 6) AS ram_used_gb, 64.0::DOUBLE AS ram_total_gb FROM lg GROUP BY 1")
def peaks(spark, sf_dir):
    return telemetry.peaks(_log(spark, sf_dir))


def _phased(spark, sf_dir):
    steps = telemetry.step_durations(_log(spark, sf_dir))
    place = F.pmod(F.length("name"), F.lit(3)) + 1
    return steps.withColumns({"phase": F.element_at(F.array(*map(F.lit, telemetry.PHASES)), place), "cpu": F.lit(1.0), "ram_used_gb": F.lit(2.0)})


@query(f"WITH {LG} SELECT run, ['setup', 'describe', 'projections'][length(name) % 3 + 1] AS phase, CAST(length(name) % 3 + 1 AS INTEGER) AS place, round(sum(s), 3) AS seconds FROM sd GROUP BY run, length(name) % 3 HAVING sum(s) > 0")
def phase_totals(spark, sf_dir):
    return telemetry.phase_totals(_phased(spark, sf_dir)).withColumn("seconds", F.round("seconds", 3))


@query(f"""WITH {LG}, x AS (SELECT run, CASE WHEN length(name) % 3 = 0 AND count(*) FILTER (WHERE length(name) % 3 = 0) OVER (PARTITION BY run) > 1 THEN 'other-setup' ELSE name END AS name, s FROM sd)
SELECT run, name, round(sum(s), 3) AS seconds FROM x GROUP BY ALL""")
def collapse_phase(spark, sf_dir):
    return telemetry.collapse_phase(_phased(spark, sf_dir)).select("run", "name", F.round("seconds", 3).alias("seconds"))


@query("SELECT event_id, CASE WHEN value IS NULL THEN NULL WHEN value < 50 THEN 'low' WHEN value < 80 THEN 'medium' ELSE 'high' END AS level FROM events")
def load_level(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", telemetry.load_level(F.col("value")).alias("level"))


# Models (rows only)


@query()
def fit_estimator(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return estimate.predict(estimate.fit_estimator(v), v).select("compound_id", "y", "p")


@query()
def oof_scores(spark, sf_dir):
    return estimate.oof_scores(_vectors(spark, sf_dir))


@query()
def domain_pca(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return estimate.score_domain(estimate.fit_domain(v), v).select("compound_id", "ad")


@query()
def screen(spark, sf_dir):
    from quillon.operators import screen as sc

    v = _vectors(spark, sf_dir)
    member = kept(splits.select_folds(v.select("compound_id", F.col("y").alias("bin")), "random", 2)[0], "folds")
    tables = {f"part{i}": v.select("compound_id", F.slice("features", 16 * i + 1, 16).alias("features")) for i in range(4)}
    preds = sc.proxy_scores(tables, member)
    chosen, solo = sc.select_descriptors(kept(preds, "preds"), sorted(tables))
    return sc.screen_table(spark, solo, chosen)


def _newton_sql(points: str, rounds: int = 25) -> str:
    """Tables n0 to n<rounds> (descriptor, s, b): a logistic fit of each descriptor of points (descriptor, x, y), penalty 1."""
    out = [f"n0 AS (SELECT descriptor, CAST(0 AS DOUBLE) AS s, ln(avg(y) / (1 - avg(y))) AS b FROM {points} GROUP BY 1)"]
    for k in range(rounds):
        out.append(f"""n{k + 1} AS (SELECT descriptor, s + (h0 * g1 - h1 * g0) / (h0 * h2 - h1 * h1) AS s, b + (h2 * g0 - h1 * g1) / (h0 * h2 - h1 * h1) AS b
  FROM (SELECT descriptor, any_value(s) AS s, any_value(b) AS b, sum(y - q) AS g0, sum((y - q) * x) - any_value(s) AS g1, sum(q * (1 - q)) AS h0, sum(q * (1 - q) * x) AS h1, sum(q * (1 - q) * x * x) + 1 AS h2
  FROM (SELECT p.descriptor, x, y, s, b, 1 / (1 + exp(-(s * x + b))) AS q FROM {points} p JOIN n{k} USING (descriptor)) GROUP BY descriptor))""")
    return ",\n".join(out)


@query(", pt AS (SELECT descriptor, p AS x, y FROM sl), " + _newton_sql("pt") + " SELECT descriptor, round(s, 5) AS slope, round(b, 5) AS intercept FROM n25", scores=True)
def logistic_lines(spark, sf_dir):
    lines = logistic.fit_lines(labelled(spark, sf_dir), BY, "p", "y")
    return lines.select("descriptor", F.round("slope", 5).alias("slope"), F.round("intercept", 5).alias("intercept"))


@query(", pt AS (SELECT descriptor, p AS x, y FROM sl), " + _newton_sql("pt") + " SELECT compound_id, round(median(1 / (1 + exp(-(s * p + b)))), 6) AS clf, CAST(median(1 / (1 + exp(-(s * p + b)))) > 0.5 AS INTEGER) AS clf_bin FROM s0 JOIN n25 USING (descriptor) GROUP BY 1", scores=True)
def bag_model(spark, sf_dir):
    whole, rows = fx.scored(spark, sf_dir)
    return bagging.apply_bag(whole, bagging.fit_bag(rows, "model"))


_POWER = "CASE WHEN abs(l) < 1e-9 THEN ln(1 + p) ELSE (pow(1 + p, l) - 1) / l END"
_POWERS = f"""pw AS (SELECT descriptor, arg_max({{'l': l, 'm': m, 'v': v}}, (round(-0.5 * n * ln(greatest(v, 1e-300)) + (l - 1) * logs, 6), l)) AS f FROM (SELECT descriptor, l, var_pop(t) AS v, avg(t) AS m, sum(ln(1 + p)) AS logs, count(*) AS n
  FROM (SELECT descriptor, p, l, {_POWER} AS t FROM sl, (SELECT unnest({bagging.LAMBDAS})::DOUBLE AS l)) GROUP BY ALL) GROUP BY 1),
pf AS (SELECT descriptor, f.l AS l, f.m AS m, CASE WHEN f.v > 0 THEN sqrt(f.v) ELSE 1 END AS d FROM pw)"""


@query(f", {_POWERS} SELECT descriptor, l AS lambda, round(m, 6) AS mean, round(d, 6) AS std FROM pf", scores=True)
def power_by_descriptor(spark, sf_dir):
    return bagging.fit_powers(labelled(spark, sf_dir), BY, "p")


@query(f""", {_POWERS}, pt AS (SELECT descriptor, ({_POWER} - m) / d AS x, y FROM sl JOIN pf USING (descriptor)), """ + _newton_sql("pt") + f""",
ld AS (SELECT descriptor, 1 - abs((SELECT quantile_cont(auroc, 0.66) FROM auc) - auroc) AS w FROM auc),
qs AS (SELECT compound_id, w, 1 / (1 + exp(-(s * (({_POWER} - m) / d) + b))) AS q FROM s0 JOIN pf USING (descriptor) JOIN n25 USING (descriptor) JOIN ld USING (descriptor)),
mw AS (SELECT compound_id, (avg(q) + sum(w * q) / sum(w)) / 2 AS clf FROM qs GROUP BY 1) SELECT compound_id, round(clf, 6) AS clf, CAST(clf > 0.5 AS INTEGER) AS clf_bin FROM mw""", scores=True)
def bag_weighting(spark, sf_dir):
    """The forest's weights, which no SQL has, are left out here; see bag_forest."""
    whole, rows = fx.scored(spark, sf_dir)
    return bagging.apply_bag(whole, bagging.fit_bag(rows, "weighting", schemes=[bagging.lead_weights(rows)]))


@query()
def bag_forest(spark, sf_dir):
    whole, rows = fx.scored(spark, sf_dir)
    return bagging.apply_bag(whole, bagging.fit_bag(rows, "weighting"))


@query()
def run_folds(spark, sf_dir):
    from quillon.plans import jobs

    v = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("compound_id"), F.array_join("embedding", ",").alias("smiles"), (F.col("label") % 2).alias("bin"))
    member, _ = splits.select_folds(v.select("compound_id", "bin"), "random", 2)
    part = lambda i: jobs.Descriptor(f"part{i}", lambda c: F.slice(F.split(c, ",").cast("array<double>"), 32 * i + 1, 32))
    return jobs.run_folds(v, member, [part(0), part(1)])


@query()
def fit_predict(spark, sf_dir):
    """The jobs end to end: documents with quality labels, three column functions as descriptors."""
    from quillon.plans import jobs

    docs = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    rows = docs.select(F.col("doc_id").alias("orig_idx"), "text", F.col("quality").alias("value"))
    share = lambda n, c: n.cast("double") / (F.length(c) + 1)
    of = lambda c, char: share(F.length(c) - F.length(F.replace(c, F.lit(char), F.lit(""))), c)
    descriptors = [
        jobs.Descriptor("shape", lambda c: F.array(F.ln(F.length(c) + 1.0), of(c, " "), of(c, "\n"))),
        jobs.Descriptor("symbols", lambda c: F.array(share(F.regexp_count(c, F.lit("[0-9]")), c), share(F.length(F.regexp_replace(c, "[A-Za-z0-9 ]+", "")), c))),
    ]
    s = jobs.Settings(is_valid=lambda c: F.length(c) > 0, min_class=None)
    run = jobs.fit(rows.filter("value IS NOT NULL"), "text", "value", descriptors, s)
    return jobs.predict(rows.drop("value"), "text", None, descriptors, run, s).tables["pooled"].select("compound_id", "clf", "clf_bin", "clf_ad")


@query("SELECT doc_id AS compound_id, round(1 / (1 + exp(-(ln(n_chars + 1.0::DOUBLE) - 7))), 6) AS p FROM documents")
def score_stream(spark, sf_dir):
    """documents as a stream, scored batch by batch into a table."""
    from pyspark.sql.types import StructType

    from quillon.streaming import streams

    schema: StructType = read(spark, sf_dir, "documents").schema
    at = shared_path(spark, "stream")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/documents.parquet*")
    score = lambda df: df.select(F.col("doc_id").alias("compound_id"), (1 / (1 + F.exp(-(F.ln(F.col("n_chars") + 1.0) - 7)))).alias("p"))
    streams.score_stream(stream, score, lambda df, n: df.write.mode("overwrite").parquet(f"{at}/out/batch={n}"), f"{at}/state").awaitTermination()
    return spark.read.schema("compound_id long, p double").parquet(f"{at}/out").select("compound_id", "p")


def _event_stream(spark, sf_dir):
    return spark.readStream.schema(read(spark, sf_dir, "events").schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


def _windows(df: DataFrame) -> DataFrame:
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return df.select(*(text(c) if c in ("start", "end") else c for c in df.columns))


STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


@query(f"""WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, opens DESC ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, {STAMP.format('min(ts)')} AS start, {STAMP.format('max(ts) + INTERVAL 30 MINUTE')} AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def session_stream(spark, sf_dir):
    from quillon.streaming import streams

    return _windows(streams.run_to_end(_event_stream(spark, sf_dir), streams.session_stream, shared_path(spark, "stream")))


@query(f"""SELECT event_type, {STAMP.format("date_trunc('day', ts)")} AS start, {STAMP.format("date_trunc('day', ts) + INTERVAL 1 DAY")} AS "end", count(*) AS n, round(sum(value), 6) AS total, max(value) AS peak FROM events GROUP BY event_type, date_trunc('day', ts)""")
def telemetry_stream(spark, sf_dir):
    from quillon.streaming import streams

    build = lambda rows: streams.telemetry_stream(rows, window="1 day")
    return _windows(streams.run_to_end(_event_stream(spark, sf_dir), build, shared_path(spark, "stream")))


@query("SELECT DISTINCT md5(event_type || '-' || user_id) AS key FROM events")
def dedupe_stream(spark, sf_dir):
    from quillon.streaming import streams

    rows = _event_stream(spark, sf_dir).withColumn("smiles", F.concat_ws("-", "event_type", "user_id"))
    at = shared_path(spark, "stream")
    stream = streams.dedupe_stream(rows, late="3650 days").select("key")
    stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string").parquet(f"{at}/out")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with labels, three pseudo-descriptors pooled by skill and reliability, and their quality in one table."""
    pooled = _pooled(spark, sf_dir).select("compound_id", F.lit("pooled").alias("descriptor"), F.col("clf").alias("p"))
    rows = pooled.unionByName(fx.scores(spark, sf_dir).select("compound_id", "descriptor", "p")).join(fx.labels(spark, sf_dir), "compound_id")
    return rounded(metrics.performance(rows, BY, "compound_id", 0.5))
