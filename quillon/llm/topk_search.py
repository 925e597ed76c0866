"""Exact top-k inner products by a three-phase uniform threshold.

Each vector is cut into two slices of its dimensions. A slice is a list of partial scores of every candidate for every query;
a score is the sum over the slices, whose rows lie in different blocks and are worked on apart.

1. Gather: each block of each slice reports its k + 1 best partial scores a query. The candidates best in some slice are
   scored exactly, and the (k + 1)-th best of their different ids is a bound that the answer reaches whichever id is the query's.
2. Half the bound is the uniform cutoff, which goes out with the queries: a candidate below it in both slices cannot reach the
   bound. A block reports the entries that reach it. Rows too short to reach the cutoff (Cauchy-Schwarz) are not multiplied at all.
3. The entries of a pair of blocks visit the other slice's block, where their missing scores alone are fetched and added;
   those that reach the bound are left (an entry that both slices report is left to the first). The k best are taken.

Cutoffs are safe for scores of any sign. Equal vectors share one row, as query and as candidate, and are expanded only for
the k + 1 smallest ids, which are all that ties can need. Query blocks are dealt to the blocks of vectors by number. All joins
are shuffled: the copies of query blocks grow with the square of the table, and Spark would estimate and broadcast them as one.

Results for odd input: vectors that are null, empty, or hold null or non-finite values take no part, nor do rows without an
id; vectors of another length than the query's are not its candidates; rows that repeat an id are candidates each, and rows
with the query's id are its own; queries with equal id and vector are answered once; fewer candidates than k give fewer
rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm._common import read, stored

K, SLICES = 5, 2
ROWS_A_BLOCK, QUERIES_A_BLOCK = 8_192, 512
#: Times k + 1 candidates of a slice are scored for the bound. The higher the bound, the fewer entries reach the cutoff.
DEPTH = 4
#: The bound of a query with so few candidates that all are its answer.
LOWEST = -(2**60)


def integer_vector(c: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as double, as long integers."""
    return F.transform(c, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(c: Column) -> Column:
    """Whether a vector has components and all are finite."""
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(c) > 0) & ~bad, F.lit(False))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Integer inner products; as floats where these are exact, which is faster."""
    most = np.abs(q.astype(float)).max(initial=0) * np.abs(v.astype(float)).max(initial=0) * q.shape[1]
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
    return q.astype(kind) @ v.astype(kind).T


def _limits(scores: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Integer limits in the scores' type, which need not hold those that no score is near."""
    most = {4: 2**24, 8: 2**53}[scores.itemsize]
    return limits if scores.dtype == np.int64 else np.clip(limits, -most, most).astype(scores.dtype)


def _cuts(width: int) -> list[int]:
    return np.linspace(0, width, min(SLICES, width) + 1).astype(int).tolist()


def _cutoffs(bounds: np.ndarray, width: int) -> np.ndarray:
    """The least partial score that some slice of a candidate must have to reach the bound."""
    return -(-bounds // min(SLICES, width))


def _pack(key: tuple, table: pa.Table) -> pa.Table:
    """One row for a block of a slice, in the order of its keys: keys and bounds as bytes, parts in integers of `size` bytes."""
    keys, bounds = (table.column(c).to_numpy() for c in ("key", "bound"))
    parts = table.column("part").combine_chunks().flatten().to_numpy().reshape(len(keys), -1)
    size = next(n for n in (2, 4, 8) if n == 8 or (parts.min() >= -(2 ** (8 * n - 1)) and parts.max() < 2 ** (8 * n - 1)))
    order = np.argsort(keys)
    columns = [pa.array([x.as_py()], t) for x, t in zip(key, (pa.int32(), pa.int32(), pa.int64()))]
    columns += [pa.array([x[order].astype(t).tobytes()], pa.binary()) for x, t in ((keys, "<i8"), (parts, f"<i{size}"), (bounds, "<i8"))]
    return pa.table([*columns, pa.array([size], pa.int32())], ["width", "slice", "block", "keys", "parts", "bounds", "size"])


def _packed(parts: DataFrame, cells: int) -> DataFrame:
    """width, slice, block, keys, parts, bounds, size of (width, slice, key, part, bound)."""
    keyed = parts.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(cells)))
    return keyed.groupBy("width", "slice", "block").applyInArrow(_pack, "width int, slice int, block long, keys binary, parts binary, bounds binary, size int")


def _pairs(batches):
    """Of each pair of blocks its row, the queries' keys, parts (of the row's slice) and bounds, the candidates' keys and parts."""
    for b in batches:
        for at in range(b.num_rows):
            r = b.slice(at, 1).to_pylist()[0]
            lo, hi = _cuts(r["width"])[r["slice"] :][:2]
            q = np.frombuffer(r["q_parts"], f"<i{r['q_size']}").reshape(-1, r["width"])[:, lo:hi].astype(np.int64)
            v = np.frombuffer(r["parts"], f"<i{r['size']}").reshape(-1, hi - lo).astype(np.int64)
            yield r, np.frombuffer(r["q_keys"], "<i8"), q, np.frombuffer(r["q_bounds"], "<i8"), np.frombuffer(r["keys"], "<i8"), v


def _entries(number: int, q: np.ndarray, c: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(c, pa.int64()), pa.array(np.full(len(q), number), pa.int32()), pa.array(score.astype(np.int64))], ["query", "class", "slice", "score"])


def _gather(k: int):
    """Phase 1: each query's k + 1 best entries of the block."""

    def run(batches):
        for r, q_keys, q, _, keys, v in _pairs(batches):
            score = _scores(q, v)
            m = min(k + 1, len(keys))
            best = np.argpartition(score, len(keys) - m, axis=1)[:, len(keys) - m :]
            row, col = np.repeat(np.arange(len(q)), m), best.ravel()
            yield _entries(r["slice"], q_keys[row], keys[col], score[row, col])

    return run


def _collect(batches):
    """Phase 2: the entries of the block that reach their query's cutoff, as places (query's times number of keys plus key's)
    and partial scores, on their way to the other slice. A vector of one slice has no other; its entries stay at home."""
    for r, _, q, bounds, keys, v in _pairs(batches):
        cutoff = _cutoffs(bounds, r["width"])
        length, own = (np.sqrt((x.astype(float) ** 2).sum(1)) for x in (v, q))
        need = np.where(cutoff > 0, cutoff / np.maximum(own, 1e-9), 0).min()
        near = np.flatnonzero(length >= need * (1 - 1e-9))  # the rest is too short for any of these queries
        score = _scores(q, v[near])
        row, col = np.nonzero(score >= _limits(score, cutoff)[:, None])
        if len(row):
            out = {c: r[c] for c in ("width", "block", "q_keys", "q_parts", "q_bounds", "q_size")}
            out |= {"home": r["slice"], "slice": (r["slice"] + 1) % min(SLICES, r["width"]), "places": (row * len(keys) + near[col]).astype("<i8").tobytes(), "sums": score[row, col].astype("<i8").tobytes()}
            yield pa.RecordBatch.from_pylist([out], _UNDERWAY)


_PACKED_ENTRIES = "width int, slice int, block long, home int, q_keys binary, q_parts binary, q_bounds binary, q_size int, places binary, sums binary"
_UNDERWAY = pa.schema([(name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind]) for name, kind in map(str.split, _PACKED_ENTRIES.split(", "))])


def _visit(batches):
    """Phase 3: entries that reach the bound once the other slice's score is added."""
    for r, q_keys, q, bounds, keys, v in _pairs(batches):
        places, sums = np.frombuffer(r["places"], "<i8"), np.frombuffer(r["sums"], "<i8")
        cutoff = _cutoffs(bounds, r["width"])
        for at in range(0, len(places), 1 << 16):
            row, col = np.divmod(places[at : at + (1 << 16)], len(keys))
            part = np.einsum("ij,ij->i", q[row], v[col]) * (r["slice"] != r["home"])
            score = sums[at : at + (1 << 16)] + part
            keep = (score >= bounds[row]) & ((r["slice"] >= r["home"]) | (part < cutoff[row]))
            yield _entries(r["home"], q_keys[row[keep]], keys[col[keep]], score[keep])


_ENTRY = "query long, class long, slice int, score long"


def _joined(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by shuffle whatever Spark estimates: stored arrays and blocks are far larger in memory than their files."""
    return left.join(right.hint("merge"), on, how)


def _met(q_blocks: DataFrame, v_blocks: DataFrame, cells: int) -> DataFrame:
    """Every query block with every block of each slice, dealt out by slice and block."""
    names = {"width": "width", "keys": "q_keys", "parts": "q_parts", "bounds": "q_bounds", "size": "q_size"}
    slices = F.sequence(F.lit(0), F.least("width", F.lit(SLICES)) - 1)
    dealt = q_blocks.select(*(F.col(c).alias(to) for c, to in names.items()), F.explode(slices).alias("slice"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))
    return _joined(dealt, v_blocks, ["width", "slice", "block"])


def top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k highest integer inner products, ties to smaller ids."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("x"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("x"))).select("vec_id", "is_query", integer_vector(F.col("x"), scale).alias("v"))
    rows = stored(rows.groupBy("v", "vec_id").agg(F.count("*").alias("n"), F.max("is_query").alias("is_query")), "vectors")
    # a class for each different vector; of its ids only the k + 1 smallest can be in an answer
    order = Window.partitionBy("v").orderBy("vec_id")
    members = rows.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1)
    members = members.groupBy("v").agg(F.array_sort(F.collect_list(F.struct("vec_id", "n"))).alias("ids"))
    classes = stored(members.withColumn("class", F.monotonically_increasing_id()), "classes")
    queries = stored(_joined(rows.filter("is_query").select("v", F.col("vec_id").alias("query_id")), classes.select("v", "class"), "v"), "queries")
    asked = stored(queries.select("class", "v").dropDuplicates(["class"]), "asked")

    widths = [r.w for r in classes.select(F.size("v").alias("w")).distinct().collect()]  # a row for each length of vector
    if not widths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cuts = F.create_map(*(x for w in widths for x in (F.lit(w), F.array(*map(F.lit, _cuts(w))))))
    at = F.element_at(cuts, F.size("v"))
    pieces = F.transform(F.sequence(F.lit(1), F.size(at) - 1), lambda i: F.struct((i - 1).cast("int").alias("slice"), F.slice("v", F.get(at, i - 1) + 1, F.get(at, i) - F.get(at, i - 1)).alias("part")))
    parts = classes.select(F.col("class").alias("key"), F.size("v").alias("width"), F.lit(LOWEST).alias("bound"), F.inline(pieces))
    cells, q_cells = (max(1, -(-df.count() // a_block)) for df, a_block in ((classes, ROWS_A_BLOCK), (asked, QUERIES_A_BLOCK)))
    v_blocks = stored(_packed(parts, cells).drop("bounds"), "vector-blocks")
    q_whole = asked.select(F.col("class").alias("key"), F.size("v").alias("width"), F.lit(0).alias("slice"), F.col("v").alias("part"))

    # phase 1
    gathered = _met(stored(_packed(q_whole.withColumn("bound", F.lit(LOWEST)), q_cells), "query-blocks"), v_blocks, cells).mapInArrow(_gather(k), _ENTRY)
    down = Window.partitionBy("query", "slice").orderBy(F.desc("score"), "class")
    best = gathered.withColumn("place", F.row_number().over(down)).filter(F.col("place") <= DEPTH * (k + 1)).select("query", "class").distinct()
    whole = _joined(_joined(best, classes.select("class", "v", "ids"), "class"), asked.select(F.col("class").alias("query"), F.col("v").alias("q")), "query")
    score = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    by_id = whole.select("query", score.alias("score"), F.explode("ids.vec_id").alias("vec_id")).groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    bounds = stored(by_id.withColumn("place", place).filter(F.col("place") == k + 1).select(F.col("query").alias("key"), F.col("score").alias("bound")), "bounds")
    # phases 2 and 3
    limited = _joined(q_whole, bounds, "key", "left").withColumn("bound", F.coalesce("bound", F.lit(LOWEST)))
    underway = _met(stored(_packed(limited, q_cells), "query-blocks"), v_blocks, cells).mapInArrow(_collect, _PACKED_ENTRIES)
    exact = stored(_joined(underway, v_blocks, ["width", "slice", "block"]).mapInArrow(_visit, _ENTRY), "survivors")
    # of an id's rows k are enough, and 2 k rows hold k of other ids than any one
    expanded = _joined(exact, classes.select("class", "ids"), "class").select("query", "score", F.inline("ids"))
    in_id = F.row_number().over(Window.partitionBy("query", "vec_id").orderBy(F.desc("score")))
    in_all = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    top = expanded.withColumn("place", in_id).filter(F.col("place") <= k).withColumn("place", in_all).filter(F.col("place") <= 2 * k).drop("place")
    answers = _joined(queries.select(F.col("class").alias("query"), "query_id"), top, "query").filter("vec_id <> query_id")
    copies = answers.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return copies.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP4_SQL = """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT DISTINCT vec_id, e FROM v WHERE vec_id % 50 = 0),
s AS (SELECT q.vec_id AS query_id, q.e, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM q, v c WHERE len(q.e) = len(c.e) AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 5
"""
