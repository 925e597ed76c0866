"""Token counts of whole documents by overlap resynchronisation.

A document of up to `chunk` characters is encoded at once. A longer one is dealt out as chunks that overlap; the chunks
are encoded anywhere in the cluster, each with the character offsets of its pieces. Two neighbours are spliced at a
boundary that both report and that is proven stable: a space between two characters that are not white space begins a new
match of the vocabulary's pattern whatever stands around it. Where an overlap has no such boundary, the document is taken
again with chunks and overlaps twice as long, until all of it is one chunk.

Results for odd input: null and empty texts have no bytes and no tokens; repeated rows and repeated or null ids each give
a row; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, sliced, stored
from quillon.llm.tokens import byte_level, definition_of, vocabulary_path

CHUNK, OVERLAP = 32_768, 2_048
COUNTS = "doc_id long, n_bytes long, n_tokens long"
CHUNKS = "doc_id long, digest long, n_bytes long, k int, at long, last boolean, text string"
SEAMS = "doc_id long, digest long, n_bytes long, seam int, side string, total long, at array<long>, before array<long>"


def chunks_of(text: str, chunk: int, overlap: int) -> Iterator[tuple[int, int, bool, str]]:
    """(number, first character, whether it is the last, text) of overlapping chunks."""
    k = 0
    while True:
        at = k * chunk
        last = at + chunk + overlap >= len(text)
        yield k, at, last, text[at : at + chunk + overlap]
        if last:
            return
        k += 1


def _count(definition: str):
    def run(batches):
        coder = byte_level(definition)
        for b in sliced(batches, 1024):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(coder.encode(b.column(2)).counts(), pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return run


def _cut(chunk: int, overlap: int):
    def run(batches):
        for b in sliced(batches, 16):
            for doc, digest, size, text in zip(*(c.to_pylist() for c in b.columns)):
                rows = [[doc, digest, size, *c] for c in chunks_of(text, chunk, overlap)]
                yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "digest", "n_bytes", "k", "at", "last", "text"), r)) for r in rows], _arrow(CHUNKS))

    return run


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def boundaries(pieces, k: int, at: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Proven stable boundaries of an encoded chunk: their characters in the document, and the tokens before each."""
    begin = np.cumsum(pieces.chars) - pieces.chars
    before = np.cumsum(pieces.n) - pieces.n
    # the chunk's own ends are left out: what stands beyond them isn't seen
    ok = (begin > 0) & (begin < length - 1) & (pieces.chars > 1)
    return begin[ok] + at, before[ok]


def _seams(definition: str, chunk: int, overlap: int):
    def run(batches):
        coder = byte_level(definition)
        for b in sliced(batches, 64):
            out = []
            coded = coder.encode(b.column(6))
            counts = coded.counts()
            for r, (doc, digest, size, k, at, last) in enumerate(zip(*(b.column(i).to_pylist() for i in range(6)))):
                own = type(coded)(None, coded.n[coded.texts[r] : coded.texts[r + 1]], coded.chars[coded.texts[r] : coded.texts[r + 1]], None, None)
                where, before = boundaries(own, k, at, int(own.chars.sum()))
                rows = []
                if k:
                    left = where < at + overlap
                    rows.append((k - 1, "right", 0, where[left], before[left]))
                if last:
                    rows.append((k, "end", int(counts[r]), where[:0], before[:0]))
                else:
                    right = where >= at + chunk
                    rows.append((k, "left", 0, where[right], before[right]))
                out += [dict(zip(("doc_id", "digest", "n_bytes", "seam", "side", "total", "at", "before"), (doc, digest, size, *x))) for x in rows]
            yield pa.RecordBatch.from_pylist(out, _arrow(SEAMS))

    return run


def _spliced(long_docs: DataFrame, definition: str, chunk: int, overlap: int) -> DataFrame:
    """Counts of the long documents; null where some overlap has no common boundary."""
    cut = long_docs.mapInArrow(_cut(chunk, overlap), CHUNKS)
    dealt = cut.repartition(F.col("doc_id"), F.col("digest"), F.col("k"))
    key = ["doc_id", "digest", "n_bytes"]
    side = lambda name: F.max(F.when(F.col("side") == name, F.struct("at", "before", "total"))).alias(name)
    copies = F.count(F.when(F.col("side") == "end", 1)).alias("copies")
    seams = dealt.mapInArrow(_seams(definition, chunk, overlap), SEAMS).groupBy(*key, "seam").agg(side("left"), side("right"), side("end"), copies)
    common = F.array_min(F.array_intersect("left.at", "right.at"))
    tokens_to = lambda s: F.element_at(f"{s}.before", F.array_position(F.col(f"{s}.at"), common).cast("int"))
    spliced = seams.withColumn("n", F.when(F.col("end").isNotNull(), F.col("end.total")).when(common.isNotNull(), tokens_to("left") - tokens_to("right")))
    per_doc = spliced.groupBy(*key).agg(F.when(F.count("*") == F.count("n"), F.sum("n")).alias("n_tokens"), F.sum("copies").alias("copies"))
    return per_doc.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")


def token_counts(docs: DataFrame, definition: str, *, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row; see the module's text for the method and for odd input."""
    if not 0 < overlap <= chunk:
        raise ValueError("overlap must be positive and at most chunk")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    is_long = F.coalesce(F.char_length("text"), F.lit(0)) > chunk + overlap
    short = rows.filter(~is_long).select("doc_id", size, "text").mapInArrow(_count(definition), COUNTS)
    todo = rows.filter(is_long).select("doc_id", F.xxhash64("text").alias("digest"), size, "text")
    done = short
    while True:
        got = stored(_spliced(todo, definition, chunk, overlap), "token-counts")
        done = done.unionByName(got.filter(F.col("n_tokens").isNotNull()).select("doc_id", "n_bytes", "n_tokens"))
        open_ = got.filter(F.col("n_tokens").isNull()).select("doc_id", "digest").distinct()
        if open_.isEmpty():
            return done
        chunk, overlap = 2 * chunk, 2 * overlap
        same = (F.col("todo.digest") == F.col("open.digest")) & F.col("todo.doc_id").eqNullSafe(F.col("open.doc_id"))
        todo = todo.alias("todo").join(open_.alias("open"), same, "left_semi")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(read(spark, sf_dir, "documents"), definition_of(vocabulary_path("byte_bpe_50k.json")))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)
