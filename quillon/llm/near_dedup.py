"""Near-duplicate classes by order MinHash, verified by banded alignment.

Similarity. A text is the sequence of its words (lower-cased runs of letters and digits). Two texts are linked if m of their
words align in order and m / (n1 + n2 - m) >= 0.8: edit similarity, so one changed word costs one word and not five
shingles. The alignment begins with the longest chain of common 5-word shingles (equal ones told apart by their occurrence
number) inside a band as wide as the unmatched words that this similarity allows; between two links of the chain words are
aligned one by one if the gap is at most GAP words on both sides, for a longer gap without a common shingle has nothing in
common. Texts of which less than SHARED of all shingles are common are not similar. Classes are the connected components of
links.

Candidates. For each of 48 hash functions a text's key is its 6 least occurrence-labelled shingles in text order, so both
what is shared and its order count; texts of at most 32 shingles have keys of 3 shingles as well, for there 6 are too many of
all. Texts that share a key are candidates: with a share s of common shingles about 1 - (1 - s^6)^48 of the links share one,
and links reach each other through third texts.

1. Texts that share a key form candidate components: every text is joined with the least of each of its buckets (no pairs
   within a bucket are made), and the stars are contracted until the labels stand.
2. A component of up to `block` shingles is resolved in one group. A larger one is cut into blocks, and each pair of
   blocks is a group, so that every pair of texts meets somewhere whatever the component's size. Inside a group exact shingle
   intersections come from an inverted index in numpy; the most alike pairs are aligned first and pairs linked already not
   at all; a group returns a spanning forest of its links, never all pairs.
3. The components of these links are the classes.

Results for odd input: null texts and texts without words are classes of their own; equal texts are one class; rows
without an id have no class (null); repeated rows each give a row; a class is named by its least doc_id, which is the one
to keep; an empty table gives no rows; very long texts are compared whole; further columns are ignored. Where ids are null,
shared or repeated, `row_classes` tells the rows apart by id and text digest, and rows without an id take part. Texts are
told apart by a digest of 64 bits.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import U64, mix, read, sliced, stored

WORDS, LEAST = 5, 0.8
KEYS, SIZE, SHORT_SIZE, SHORT = 48, 6, 3, 32
#: Longest gap that is aligned word by word, and the least share of common shingles.
GAP, SHARED = 64, 0.3
BLOCK = 200_000
SLOTS = 1 << 19
_RNG = np.random.default_rng(20240601)
_ODD = _RNG.integers(0, 2**63, 2 * KEYS, dtype=np.uint64) * U64(2) + U64(1)
_SEED = _RNG.integers(0, 2**63, 2 * KEYS, dtype=np.uint64)
_POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
_PLACES = _RNG.integers(0, 2**63, 16, dtype=np.uint64) * U64(2) + U64(1)


@lru_cache(maxsize=1)
def _alphanumeric() -> np.ndarray:
    """Code point -> its lower case if it is a letter or digit, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalnum():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, in order."""
    low = _alphanumeric()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    inside = low != 0
    begin = inside & ~np.concatenate([[False], inside[:-1]])
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, U64)
    starts = np.flatnonzero(begin)
    first = np.flatnonzero(begin[at])
    word = np.cumsum(begin[at]) - 1
    return mix(np.add.reduceat(low[at].astype(U64) * _POWERS[(at - starts[word]) % 64], first))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the occurrence-labelled shingles of a text, in order; all differ."""
    return labelled_shingles(word_hashes(text) if text else np.zeros(0, U64), words)


def labelled_shingles(w: np.ndarray, words: int = WORDS) -> np.ndarray:
    if not len(w):
        return w
    k = min(words, len(w))
    n = len(w) - k + 1
    h = np.full(n, U64(k))
    for i in range(k):
        h += w[i : i + n] * _PLACES[i]
    h = mix(h)
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.concatenate([[True], s[1:] != s[:-1]])
    if not new.all():
        run = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
        occurrence = np.empty(n, U64)
        occurrence[order] = run.astype(U64)
        h = np.where(occurrence > 0, mix(h + occurrence * _PLACES[15]), h)
    return h


def sketch(labelled: np.ndarray) -> np.ndarray:
    """The order MinHash keys of a text."""
    n = len(labelled)
    if not n:
        return np.zeros(0, np.int64)
    sizes = [(SIZE, 0)] + ([(SHORT_SIZE, KEYS)] if n <= SHORT else [])
    out = []
    step = max(1, min(KEYS, 2_000_000 // n))
    for size, first in sizes:
        size = min(size, n)
        for j in range(first, first + KEYS, step):
            odd, seed = _ODD[j : min(j + step, first + KEYS), None], _SEED[j : min(j + step, first + KEYS), None]
            h = (labelled[None, :] ^ seed) * odd
            least = np.argpartition(h, size - 1, axis=1)[:, :size] if size < n else np.tile(np.arange(n), (len(h), 1))
            least.sort(axis=1)  # back in text order
            taken = labelled[least]
            key = seed[:, 0].copy()
            for i in range(size):
                key = key * U64(0x100000001B3) + taken[:, i]
            out.append(mix(key))
    return np.concatenate(out).view(np.int64)


def _chain(path: np.ndarray) -> np.ndarray:
    """Places of a longest increasing subsequence."""
    if (np.diff(path) > 0).all():
        return np.arange(len(path))
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(path)
    for i, x in enumerate(path.tolist()):
        k = bisect_left(tails, x)
        before[i] = ends[k - 1] if k else -1
        tails[k : k + 1], ends[k : k + 1] = [x], [i]
    out, i = [], ends[-1]
    while i >= 0:
        out.append(i)
        i = before[i]
    return np.array(out[::-1])


def _common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence of two short sequences (by bits of an integer)."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & where.get(x, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


class Text:
    """Words and shingles of a text; at is the shingles' order by value."""

    def __init__(self, text: str | None):
        self.words = word_hashes(text) if text else np.zeros(0, U64)
        self.shingles = labelled_shingles(self.words)
        self.order = np.argsort(self.shingles)
        self.sorted = self.shingles[self.order]


def aligned_words(a: Text, b: Text, need: float = 0.0) -> int:
    """How many words of a and b align; 0 if it cannot be `need`."""
    n1, n2, k = len(a.words), len(b.words), min(WORDS, len(a.words), len(b.words))
    if not k or min(n1, n2) < need:
        return 0
    if (n1 < WORDS or n2 < WORDS) and n1 != n2:
        return 0  # a shorter text is one shingle
    at = np.searchsorted(a.sorted, b.sorted)
    at[at == len(a.sorted)] = 0
    same = np.flatnonzero(a.sorted[at] == b.sorted)
    if need and len(same) < SHARED * (len(a.sorted) + len(b.sorted) - len(same)):
        return 0
    i, j = a.order[at[same]], b.order[same]
    near = np.abs(i - j) <= n1 + n2 - 2 * need + 1
    i, j = i[near], j[near]
    if not len(i):
        return 0
    by = np.argsort(i)
    i, j = i[by], j[by]
    take = _chain(j)
    i, j = i[take], j[take]
    # each shingle adds the words beyond those the chain has covered in both texts; what lies between is a gap
    end_a, end_b = np.concatenate([[0], i[:-1] + k]), np.concatenate([[0], j[:-1] + k])
    gap_a, gap_b = i - end_a, j - end_b
    m = int(k * len(i) + np.minimum(np.minimum(gap_a, gap_b), 0).sum())
    gaps = [(x, i[t], y, j[t]) for t, x, y in zip(np.flatnonzero((gap_a > 0) & (gap_b > 0)).tolist(), end_a[(gap_a > 0) & (gap_b > 0)], end_b[(gap_a > 0) & (gap_b > 0)])]
    gaps.append((i[-1] + k, n1, j[-1] + k, n2))
    gaps = [(p, q, r, t) for p, q, r, t in gaps if 0 < q - p <= GAP and 0 < t - r <= GAP]
    if m + sum(min(q - p, t - r) for p, q, r, t in gaps) < need - 1e-9:
        return 0
    return m + sum(_common(a.words[p:q].tolist(), b.words[r:t].tolist()) for p, q, r, t in gaps)


def aligned(a: Text, b: Text, least: float = LEAST) -> bool:
    """Whether so many words of a and b align that the similarity is reached."""
    need = least * (len(a.words) + len(b.words)) / (1 + least)
    return aligned_words(a, b, need) >= need - 1e-9 if need else False


def links(nodes: list[int], texts: list[Text], side: np.ndarray | None, least: float = LEAST) -> list[tuple[int, int]]:
    """A spanning forest of the links among these texts; side keeps apart two blocks, whose own links other groups find
    (None: one block)."""
    size = np.array([len(t.shingles) for t in texts])
    owner = np.repeat(np.arange(len(texts)), size)
    _, ids = np.unique(np.concatenate([t.shingles for t in texts]), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    posting, count = owner[order], np.bincount(ids)
    begin = np.cumsum(count) - count
    ends = np.cumsum(size)
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    members, done = [1] * len(texts), [False] * len(texts)

    def compare(a: int):
        own = ids[ends[a] - size[a] : ends[a]]
        n = count[own]
        total = np.cumsum(n)
        if not len(total):
            return
        shared = np.bincount(posting[np.repeat(begin[own] - total + n, n) + np.arange(total[-1])], minlength=len(texts))
        ratio = shared / (size[a] + size - shared)
        ratio[a] = 0
        if side is not None:
            ratio[side == side[a]] = 0
        alike = np.flatnonzero(ratio >= SHARED)
        for b in alike[np.argsort(-ratio[alike], kind="stable")].tolist():
            i, j = root(a), root(b)
            if i != j and aligned(texts[a], texts[b], least):
                parent[max(i, j)] = min(i, j)
                members[min(i, j)] += members[max(i, j)]
                yield nodes[a], nodes[b]

    # each text that is not in the largest component is compared with all; two texts of that component need not be
    out, largest, changed = [], 0, True
    while changed:
        changed = False
        for a in range(len(texts)):
            if not done[a] and (members[largest] == 1 or root(a) != root(largest)):
                done[a] = changed = True
                out += compare(a)
                if members[root(a)] > members[root(largest)]:
                    largest = root(a)
                largest = root(largest)
    return out


def _roots(hooks: DataFrame) -> DataFrame:
    """node and label, the root its chain of hooks (node, label, each label less than its node) ends in: by jumps."""
    while True:
        onward = hooks.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = stored(hooks.join(onward, "label", "left").select("node", F.coalesce("further", "label").alias("label"), F.col("further").isNotNull().alias("moved")), "hooks")
        hooks = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            return hooks


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """node, label (the least node of its component) of every node but those least ones, after edges (u, v) are added to what
    labels hold. In each round every component hooks itself to its least neighbour and chains of hooks are shortened; each
    is written to the shared folder."""
    while True:
        if labels is not None:
            of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
            joined = edges.join(of("u"), "u", "left").join(of("v"), "v", "left")
            edges = joined.select(F.coalesce("u_label", "u").alias("u"), F.coalesce("v_label", "v").alias("v"))
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
        edges = edges if labels is None else stored(edges.distinct(), "edges")
        if labels is not None and edges.isEmpty():
            return labels
        roots = _roots(edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")))
        if labels is None:
            labels = roots
        else:
            onward = roots.select(F.col("node").alias("label"), F.col("label").alias("further"))
            labels = stored(labels.join(onward, "label", "left").select("node", F.coalesce("further", "label").alias("label")).unionByName(roots), "labels")


def _sketches(batches):
    for b in sliced(batches, 512):
        labelled = [shingles(t) for t in b.column(1).to_pylist()]
        keys = [sketch(x) for x in labelled]
        at = np.concatenate([[0], np.cumsum(list(map(len, keys)))]).astype(np.int32)
        size = pa.array(list(map(len, labelled)), pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), size, pa.ListArray.from_arrays(at, np.concatenate([np.zeros(0, np.int64), *keys]))], ["node", "doc_id", "size", "keys"])


def _resolve(least: float):
    def run(batches):
        key, nodes, texts, sides = None, [], [], []

        def done():
            if len(nodes) > 1:
                side = np.array(sides) if key[1] != key[2] else None
                return links(nodes, texts, side, least)
            return []

        out: list[tuple[int, int]] = []
        for b in sliced(batches, 256):
            for group, i, j, side, node, text in zip(*(c.to_pylist() for c in b.columns)):
                if (group, i, j) != key:
                    out += done()
                    key, nodes, texts, sides = (group, i, j), [], [], []
                if not nodes or nodes[-1] != node:  # copies of a text follow each other
                    nodes.append(node), texts.append(Text(text)), sides.append(side)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "v"])
                out = []
        out += done()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["u", "v"])

    return run


def row_classes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, block: int = BLOCK, unnamed: bool = True) -> DataFrame:
    """doc_id, digest, class_id, class_digest of every row: its key and the key of the row that its class keeps.

    The kept key is the least, null ids last; a text without words has its own. Rows without an id take part in the
    classes only if `unnamed`."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("node", F.xxhash64("text"))
    sketched = stored(rows.select("node", "text", "doc_id").mapInArrow(_sketches, "node long, doc_id long, size long, keys array<long>"), "sketches")
    taking_part = sketched if unnamed else sketched.filter(F.col("doc_id").isNotNull())
    keys = taking_part.select("node", F.explode("keys").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("v"), F.max("node").alias("w")).filter("v <> w").select("key", "v")
    stars = keys.join(buckets, "key").filter("node <> v").select(F.col("node").alias("u"), "v")
    groups = components(stars)
    groups = groups.unionByName(groups.select(F.col("label").alias("node"), "label").distinct())
    reps = taking_part.groupBy("node").agg(F.min("doc_id").alias("rep"), F.max("size").alias("size"))
    placed = groups.join(reps, "node")
    sized = placed.join(placed.groupBy("label").agg(F.sum("size").alias("n")), "label")
    parts = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.col("node"), F.lit(7)), parts).cast("int")
    placed = stored(sized.select("node", "rep", "label", parts.alias("parts"), own.alias("own")), "groups")
    # before texts are shuffled, most that are in no component are left out by a hash of their node: at most SLOTS numbers
    slot = lambda c: F.pmod(c, F.lit(SLOTS)).cast("int").alias("slot")
    slots = placed.select(slot(F.xxhash64("node", "rep"))).distinct()
    likely = rows.select("doc_id", "node", "text", slot(F.xxhash64("node", "doc_id"))).join(F.broadcast(slots), "slot", "left_semi")
    texts = likely.drop("slot").withColumnRenamed("node", "_node").join(placed, F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("_node") == F.col("node")))
    met = texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = met.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).alias("side"), "node", "text")
    dealt = pairs.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j", "side", "node")
    found = stored(dealt.mapInArrow(_resolve(least), "u long, v long"), "links")
    linked = components(found)
    # a linked node is not alone; its class is named by the least document of all its nodes
    classes = reps.drop("size").join(linked, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = classes.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("unnamed"), "rep", "node")).alias("least"))
    by_node = classes.join(named, "label").select("node", F.col("least.rep").alias("class_id"), F.col("least.node").alias("class_digest"))
    out = sketched.select("doc_id", "node", (F.col("size") > 0).alias("worded")).join(by_node, "node", "left")
    kept = lambda found, own: F.when(F.col("worded"), F.col(found)).otherwise(F.col(own)).alias(found)
    return out.select("doc_id", F.col("node").alias("digest"), kept("class_id", "doc_id"), kept("class_digest", "node"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, class_id (the least doc_id of the class) of every row."""
    out = row_classes(docs, id_col=id_col, text_col=text_col, least=least, block=block, unnamed=False)
    return out.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicates(read(spark, sf_dir, "documents"))
    return classes.withColumn("keep", F.col("doc_id") == F.col("class_id"))
