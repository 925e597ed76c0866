"""Language identification by nearest centroid.

A text is a vector of hashed character n-grams (n = 2, 3 over lower-cased letters, every other run of characters one
blank), weighted tf-idf with tf = 1 + ln(count) and scaled to length 1. Each language has several centroids, found by
spherical k-means on a bounded sample of labelled training texts. The nearest centroid by cosine gives the language. A
text is rejected when it has no letter, or when its cosine is below what windows of its length from the training sample
reach: distance-based rejection, since short texts lie farther from any centroid.

Document frequencies are counted over all training texts. The sample for k-means is at most `sample` texts a language
(of the 2 * `sample` with the least hash of id and text the first with letters); only centroids and frequencies, of fixed size, reach the driver.

Results for odd input: null text and text without letters are `und`, score 0 and rejected; without any training text all
are; ties go to the first language by name; repeated rows and null ids each give a row; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quillon.llm._common import drawn, held_out, read, sliced, stored

BUCKETS = 8_192
SAMPLE = 400
CENTROIDS = 3
CELL = 1 << 18
#: Numbers of different n-grams that part the length classes of rejection, the share of training windows a class may reject, and a
#: further allowance on the cosine.
LENGTHS = (0, 16, 32, 64, 128, 256, 512, 1024)
QUANTILE, SLACK = 0.002, 0.75


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Code point -> its lower case if it is a letter, else 32."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def grams(text: str) -> np.ndarray:
    """The buckets of a text's n-grams; none if it has no letter."""
    out = []
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(codes), CELL):  # bounded memory for very long texts; cells share two characters
        c = _letters()[codes[max(at - 2, 0) : at + CELL]]
        c = c[(c != 32) | np.concatenate([[True], c[:-1] != 32])]
        if (c == 32).all():
            continue
        c = np.concatenate([[32], c, [32]]).astype(np.uint32)
        c = c[(c != 32) | np.concatenate([[True], c[:-1] != 32])]
        two = c[:-1] * np.uint32(0x9E3779B1) ^ c[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] * np.uint32(0xC2B2AE3D) ^ c[2:] * np.uint32(0x27D4EB2F)
        for h in (two, three):
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out.append((h >> np.uint32(19)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def counts(texts: list[str | None]) -> np.ndarray:
    """A row of n-gram counts for each text."""
    out = np.zeros((len(texts), BUCKETS), np.float32)
    for k, t in enumerate(texts):
        if t:
            out[k] = np.bincount(grams(t), minlength=BUCKETS)
    return out


def vectors(c: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf-idf rows of length 1 (0 for texts without letters)."""
    v = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0).astype(np.float32) * idf
    norm = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.maximum(norm, 1e-9)


def _frequencies(batches):
    total, n = np.zeros(BUCKETS, np.int64), 0
    for b in sliced(batches, 64):
        c = counts(b.column(0).to_pylist())
        total += (c > 0).sum(0)
        n += len(c)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BUCKETS), pa.int32()), pa.array(np.concatenate([[n], total]), pa.int64())], ["bucket", "df"])


def inverse_frequencies(train: DataFrame) -> np.ndarray:
    """ln((1 + texts) / (1 + texts with the n-gram)) + 1 over all training texts."""
    got = train.select("text").mapInArrow(_frequencies, "bucket int, df long").groupBy("bucket").agg(F.sum("df").alias("df")).collect()  # 8,193 rows
    df = np.zeros(BUCKETS + 1)
    for r in got:
        df[r.bucket] = r.df  # bucket -1, the number of texts, is the last
    return (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)


def spherical_kmeans(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k unit centroids, begun at the first k different rows (the sample's order is random)."""
    chosen: list[int] = []
    for i in range(len(v)):
        if len(chosen) < k and (not chosen or (v[chosen] @ v[i]).max() < 0.999):
            chosen.append(i)
    centres = v[chosen]
    for _ in range(rounds):
        owner = (v @ centres.T).argmax(1)
        sums = np.stack([v[owner == j].sum(0) if (owner == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres.astype(np.float32)


def _windows(texts: list[str]) -> tuple[list[str], list[int]]:
    """Windows of each length from the texts of the sample, for the cosines that each length reaches."""
    out, owner = [], []
    for k, t in enumerate(texts):
        for n in (8, 12, 24, 48, 96, 192, 384):
            at = (k * 7919 + n * 104729) % max(len(t) - n, 1)
            out.append(t[at : at + n])
            owner.append(k)
        out.append(t)
        owner.append(k)
    return out, owner


def fit(train: DataFrame, *, sample: int = SAMPLE, centroids: int = CENTROIDS, id_col: str = "doc_id") -> dict | None:
    """Learn from the columns text and lang (and an id to draw the sample by); null languages and texts are left out."""
    train = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    idf = inverse_frequencies(train)
    # equal rows count once; the sizes of the languages bound what the draw has to order
    hashed = train.select("lang", "text", F.xxhash64(F.col(id_col).cast("string"), "text").alias("h"))
    sampled = drawn(hashed, "lang", stored(hashed.groupBy("lang").agg(F.count("*").alias("n")), "languages"), 2 * sample, "h")
    sampled = sampled.groupBy("lang", "h").agg(F.min("text").alias("text"))

    def learn(key, table):
        texts = table.sort_by("h").column("text").to_pylist()
        texts = [t for t in texts if len(grams(t))][:sample]
        if not texts:
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.list_(pa.float32())), "bars": pa.array([], pa.list_(pa.float64()))})
        centres = spherical_kmeans(vectors(counts(texts), idf), centroids)
        cut, _ = _windows(texts)
        cosines, sizes = [], []
        for at in range(0, len(cut), 256):
            c = counts(cut[at : at + 256])
            cosines.append((vectors(c, idf) @ centres.T).max(1))
            sizes.append((c > 0).sum(1))
        cosine, size = np.concatenate(cosines), np.concatenate(sizes)
        size_class = np.searchsorted(LENGTHS, size, "right") - 1
        bars, lowest = [], 0.0
        for k in range(len(LENGTHS)):
            own = cosine[(size_class == k) & (size > 0)]
            lowest = max(lowest, SLACK * float(np.quantile(own, QUANTILE))) if len(own) else lowest
            bars.append(lowest)
        return pa.table({"lang": [key[0].as_py()] * len(centres), "centre": pa.array(list(centres), pa.list_(pa.float32())), "bars": [bars] * len(centres)})

    rows = sampled.groupBy("lang").applyInArrow(learn, "lang string, centre array<float>, bars array<double>").collect()  # a few rows a language
    if not rows:
        return None
    rows.sort(key=lambda r: (r.lang, r.centre))
    return {"idf": idf, "langs": [r.lang for r in rows], "centres": np.array([r.centre for r in rows], np.float32), "bars": np.array([r.bars for r in rows])}


def predict(docs: DataFrame, model: dict | None, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id (and the columns in keep), lang_pred, score (cosine, 0 to 1) and rejected of every row."""
    rows = docs.select(F.col(text_col).alias("_text"), F.col(id_col).alias("doc_id"), *[c for c in keep if c != "doc_id"])
    kept = rows.columns[1:]
    schema = StructType([f for f in rows.schema if f.name != "_text"])
    schema = schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches):
        for b in sliced(batches, 128):
            c = counts(b.column(0).to_pylist())
            size = (c > 0).sum(1)
            if model is None:
                lang, score, rejected = ["und"] * len(c), np.zeros(len(c)), np.ones(len(c), bool)
            else:
                cosine = vectors(c, model["idf"]) @ model["centres"].T
                best = cosine.argmax(1)
                score = np.clip(cosine[np.arange(len(c)), best].astype(float), 0, 1)
                size_class = np.searchsorted(LENGTHS, size, "right") - 1
                rejected = (size == 0) | (score < model["bars"][best, size_class])
                lang = ["und" if not s else model["langs"][k] for s, k in zip(size.tolist(), best.tolist())]
                score = np.where(size == 0, 0, score)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)], [*kept, "lang_pred", "score", "rejected"])

    return rows.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return predict(docs, model).withColumn("held_out", held_out()).select("doc_id", "held_out", "lang_pred", "score", "rejected")
