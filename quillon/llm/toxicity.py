"""Toxicity by multiple-instance learning: only documents have labels, only sentences have scores.

A sentence's score is a logistic function of its words and of the words' first letters (both hashed). A document's is the
noisy-or of its sentences': 1 - prod(1 - p), in which a sentence counts only by what exceeds the background, the p of a
sentence without weights. One without a weighted feature, or whose weights sum to 0 or less, adds exactly 0, however many there
are. The weights maximise the likelihood of the documents' labels, so what offends
is learned without a labelled sentence; the background is fitted with them, and how far from chance a feature must be to have
a weight is chosen by cross-validation within the training rows. `locate` returns the sentences that score at least one half.

Weights are fitted on at most `sample` labelled texts of each class (those with the least hash of their id; of several
texts of an id the one with the least hash); the fit runs in one task, whose input that bound limits. Every document is scored whole, by the sentence; a sentence of more than CELL
characters is scored in parts.

Results for odd input: null and empty texts and texts without words score 0; if the training rows lack a class all scores
are 0; several labels for an id count as toxic if one is; repeated rows and null ids each give a row; an empty table gives
no rows; further columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import drawn, held_out, read, sliced
from quillon.llm.language import _letters

BITS = 18
BUCKETS = 1 << BITS
STEM = 4
SAMPLE = 2_000
CELL = 1 << 18
ROUNDS, RATE, DECAY = 250, 0.25, 2e-4
#: How far from chance, in deviations, the share of toxic documents with a feature must be for it to have a weight: the
#: choice among these is made by cross-validation within the training rows, in so many parts.
LEAST_Z, PARTS = (2.0, 2.75, 3.5), 3
#: Where the fit of the background begins.
BIAS = -6.0
_STOPS = np.zeros(0x110000, bool)
_STOPS[[ord(c) for c in ".!?\n"]] = True
_POWERS = np.array([pow(0x01000193, i, 1 << 32) for i in range(64)], np.uint32)


def _excess(z: np.ndarray, bias: float) -> np.ndarray:
    """-ln(1 - p) of sentences whose weights sum to z, beyond the background's."""
    bias = float(bias)
    return np.logaddexp(0, np.maximum(z, 0) + bias) - np.logaddexp(0, bias)


def _cells(text: str):
    """Parts of at most CELL characters, cut after a sentence's end, else at a blank, where there is one."""
    at = 0
    while len(text) - at > CELL:
        part = text[at : at + CELL]
        cut = max(part.rfind(c) for c in ".!?\n") + 1 or part.rfind(" ") + 1 or CELL
        yield at, text[at : at + cut]
        at += cut
    yield at, text[at:]


def features(part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, bucket) of every word and stem of a text, and where each sentence ends (after its stop)."""
    codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
    stops = _STOPS[codes]
    low = _letters()[codes]
    letter = low != 32
    begin = letter & ~np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(begin)
    ends = np.append(np.flatnonzero(stops) + 1, len(codes))
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), ends
    sentence = np.searchsorted(ends, starts, "right")
    at = np.flatnonzero(letter)
    word = np.cumsum(begin)[at] - 1
    place = at - starts[word]
    value = low[at] * _POWERS[place % 64]
    first = np.searchsorted(word, np.arange(len(starts)))
    whole = np.add.reduceat(value, first, dtype=np.uint32)
    stem = np.add.reduceat(np.where(place < STEM, value, 0).astype(np.uint32), first, dtype=np.uint32) ^ np.uint32(0x5BD1E995)
    h = np.concatenate([whole, stem])
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return np.concatenate([sentence, sentence]), ((h ^ (h >> np.uint32(12))) >> np.uint32(32 - BITS)).astype(np.int64), ends


def sentence_scores(text: str, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, p) of each sentence with words."""
    out = []
    for at, part in _cells(text):
        sentence, bucket, ends = features(part)
        z = np.bincount(sentence, weights[bucket], len(ends))
        has = np.bincount(sentence, minlength=len(ends)) > 0
        begins = np.concatenate([[0], ends[:-1]])
        p = -np.expm1(-_excess(z, weights[-1]))
        out += [(int(at + i), int(at + j), float(x)) for i, j, x in zip(begins[has], ends[has], p[has])]
    return out


def noisy_or(text: str | None, weights: np.ndarray | None) -> float:
    if not text or weights is None:
        return 0.0
    log = 0.0
    for _, part in _cells(text):
        sentence, bucket, ends = features(part)
        if len(sentence):
            log -= float(_excess(np.bincount(sentence, weights[bucket], len(ends)), weights[-1]).sum())
    return float(-np.expm1(log))


def _instances(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The text of each sentence; and the sentence and bucket of each feature, once a sentence."""
    docs, sents, buckets, n = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for d, t in enumerate(texts):
        for _, part in _cells(t or ""):
            s, b, _ = features(part)
            if len(s):
                pair = np.unique(s * BUCKETS + b)
                own, s = np.unique(pair // BUCKETS, return_inverse=True)
                sents.append(s + n)
                buckets.append(pair % BUCKETS)
                docs.append(np.full(len(own), d))
                n += len(own)
    return np.concatenate(docs), np.concatenate(sents), np.concatenate(buckets)


def _maximise(doc_of: np.ndarray, sent: np.ndarray, bucket: np.ndarray, labels: np.ndarray, use_doc: np.ndarray, least_z: float) -> np.ndarray:
    """Weights and, last, the background that maximise the likelihood of the labels of the texts in use."""
    weights = np.zeros(BUCKETS + 1)
    weights[-1] = BIAS
    # features that occur in several documents and more often in one class than chance allows
    held = use_doc[doc_of[sent]]
    seen = np.unique(doc_of[sent[held]] * BUCKETS + bucket[held])
    toxic = labels[seen // BUCKETS] == 1
    a = np.bincount(seen[toxic] % BUCKETS, minlength=BUCKETS)
    b = np.bincount(seen[~toxic] % BUCKETS, minlength=BUCKETS)
    share = (labels[use_doc] == 1).mean()
    z = (a - (a + b) * share) / np.sqrt(np.maximum((a + b) * share * (1 - share), 1e-9))
    ok = held & ((a + b >= 2) & (np.abs(z) >= least_z))[bucket]
    sent, bucket = sent[ok], bucket[ok]
    active, at = np.unique(bucket, return_inverse=True)
    w, g2, bias, b2 = np.zeros(len(active)), np.full(len(active), 1e-8), BIAS, 1e-8
    y = labels.astype(float)
    # each class weighs the same, and texts not in use nothing
    weight = np.where(y == 1, 0.5 / max((y * use_doc).sum(), 1), 0.5 / max(((1 - y) * use_doc).sum(), 1)) * use_doc
    # sentences without such a feature have the background's score, so it is enough to count them
    used, sent = np.unique(sent, return_inverse=True)
    plain = np.bincount(doc_of, minlength=len(y)) - np.bincount(doc_of[used], minlength=len(y))
    own = doc_of[used]
    for _ in range(ROUNDS):
        score = np.bincount(sent, w[at], len(used)) + bias
        p, base = 1 / (1 + np.exp(-score)), 1 / (1 + np.exp(-bias))
        keep = np.exp(-np.bincount(own, np.logaddexp(0, score), len(y)) - plain * np.logaddexp(0, bias))  # prod(1 - p)
        pull = np.where(y == 1, keep / np.maximum(1 - keep, 1e-12), -1.0) * weight
        grad = pull[own] * p
        step = np.bincount(at, grad[sent], len(active)) - DECAY * w
        g2 += step * step
        w += RATE * step / np.sqrt(g2)
        slope = grad.sum() + (pull * plain).sum() * base
        b2 += slope * slope
        bias += RATE * slope / np.sqrt(b2)
    weights[active], weights[-1] = w, bias
    return weights


def learn(texts: list[str], labels: np.ndarray) -> np.ndarray:
    """Weights for each bucket (most are 0) and, last, the background. The least deviation of a feature is the one of LEAST_Z
    with the best mean share of right answers a class on the parts left out, of equals the smallest."""
    found = _instances(texts)
    doc_of, sent, bucket = found
    part = np.arange(len(labels)) % PARTS
    best, cut = -1.0, LEAST_Z[0]
    for least_z in LEAST_Z if len(labels) >= 10 * PARTS else ():
        said = np.zeros(len(labels), bool)
        for k in range(PARTS):
            w = _maximise(*found, labels, part != k, least_z)
            excess = np.bincount(doc_of, _excess(np.bincount(sent, w[bucket], len(doc_of)), w[-1]), len(labels))
            said |= (part == k) & (excess >= np.log(2))
        right = sum((said == labels)[labels == c].mean() for c in (0, 1))
        if right > best + 1e-9:
            best, cut = right, least_z
    return _maximise(*found, labels, np.ones(len(labels), bool), cut)


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, label: str = "toxic") -> np.ndarray | None:
    """Weights and the background from docs (doc_id, text) and labels (doc_id and a 0/1 column); None if a class has no row."""
    truth = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("y"))
    truth = truth.withColumn("h", F.xxhash64(F.col("doc_id").cast("string")))
    picked = drawn(truth, "y", truth.groupBy("y").agg(F.count("*").alias("n")), sample, "h").select(F.col("doc_id").alias("_id"), "y")
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one text an id

    def run(table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        y = np.array(table.column("y").to_pylist(), int)
        if len(set(y.tolist())) < 2:
            return pa.table({"bucket": pa.array([], pa.int32()), "weight": pa.array([], pa.float64())})
        w = learn(table.column("text").to_pylist(), y)
        at = np.flatnonzero(w)
        return pa.table({"bucket": pa.array(at, pa.int32()), "weight": w[at]})

    got = rows.groupBy().applyInArrow(run, "bucket int, weight double").toPandas()  # at most BUCKETS + 1 rows
    if not len(got):
        return None
    weights = np.zeros(BUCKETS + 1, np.float32)
    weights[got["bucket"].to_numpy()] = got["weight"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray | None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row."""

    def run(batches):
        for b in sliced(batches, 256):
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([noisy_or(t, weights) for t in b.column(1).to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def locate(docs: DataFrame, weights: np.ndarray | None, *, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """doc_id, start, end (code points), p and the text of each sentence with p of at least `least`."""

    def run(batches):
        for b in sliced(batches, 256):
            rows = [(d, i, j, p, t[i:j]) for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t and weights is not None for i, j, p in sentence_scores(t, weights) if p >= least]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string()))], ["doc_id", "start", "end", "p", "sentence"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, start int, end int, p double, sentence string")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    weights = fit(docs.filter(~held_out()), read(spark, sf_dir, "labels").filter(~held_out()))
    return score(docs, weights).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
