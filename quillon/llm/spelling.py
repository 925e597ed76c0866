"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by Bloom-guided neighbourhoods.

1. Words are counted over all texts, pre-aggregated; the vocabulary is every word of enough code points and occurrences.
2. It is entered in blocked Bloom filters, one shard for each length (one for all lengths from LONGEST on): a word sets one
   bit in each of the eight 32-bit cells of one block. Cells are united in Spark and broadcast; all shards together have
   at most `filter_blocks` blocks of 32 bytes (32 MB), whatever the vocabulary. Beyond about 16 million words more probes
   are positive by chance; results do not change.
3. Each word probes its edits: every deletion against the shard of the length below, every replacement by a larger letter
   against its own. An insertion is the deletion of the other word, and a replacement is seen from the smaller letter, so
   each pair is met once. Edits are not spelled out: a word's hash is a sum over its places, so that of an edit follows by
   a few operations, array by array. Letters are those that the vocabulary has.
4. Only edits found in a filter are spelled and shuffled, to a join with the vocabulary, which removes the false positives.
5. A word's form is the near word of largest count (ties: smallest in code-point order) if it occurs `ratio` times as often.
   Forms are followed by pointer doubling: a count grows by that factor at each step, which bounds the number of rounds.

Neighbourhoods are bounded by a word's length and the letters, not by the table, so no key of the join is hot.

Results for odd input: null or empty text has no words; a word may be as long as a text; repeated rows count each; a null id
is the empty string in the check sum that garbles words; an empty table, or one without frequent words, gives no rows;
further columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import MULTIPLIER, U64, mix, read, stored

#: Maximal runs of these are words; only A-Z are lower-cased.
_BETWEEN = r"[^A-Za-z\x{C0}-\x{FF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONGEST = 64
#: Blocks of eight 32-bit cells: 8 bits a cell, 16 bits a word at least while blocks last.
FILTER_BLOCKS = 1 << 20
WORDS_A_BLOCK = 12
#: Probes that one step of the numpy code makes at once.
STEP = 1 << 18
#: The factor of the place sums and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def runs(text: Column) -> Column:
    """The maximal runs of letters, A-Z lower-cased; none for null."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(lowered, _BETWEEN), "")


def garbled(doc_id: Column, run: Column, one_in: int) -> Column:
    """The run without the code point h % length where one_in divides h, the check sum of id and run."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % one_in == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, *, least_length: int = 6, least_count: int = 5, one_in: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word and n (occurrences) of every frequent word; `one_in` garbles about one run in so many."""
    words = docs.select(F.col(f"`{id_col}`").alias("id"), F.explode(runs(F.col(f"`{text_col}`"))).alias("run")).filter(F.char_length("run") >= least_length)
    word = F.col("run") if one_in is None else garbled(F.col("id"), F.col("run"), one_in)
    counted = words.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter((F.col("n") >= least_count) & (F.char_length("word") >= least_length))


def code_points(words: list[str]) -> np.ndarray:
    """One row a word; all words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    """_BASE ** 0 ... _BASE ** n modulo 2^64."""
    out = np.ones(n + 1, dtype=U64)
    out[1:] = MULTIPLIER
    return np.multiply.accumulate(out)


def _marks(codes: np.ndarray) -> np.ndarray:
    """A random 64-bit number for each code point."""
    return mix(codes.astype(U64) * MULTIPLIER + U64(1))


def word_hash(codes: np.ndarray) -> np.ndarray:
    """The place sum of each row, before it is mixed."""
    return (_marks(codes) * _powers(codes.shape[1] - 1)).sum(axis=1, dtype=U64)


def _cells(sums: np.ndarray) -> list[np.ndarray]:
    """The bit of each of the eight cells, as 32-bit masks."""
    h = mix(sums ^ U64(0xD6E8FEB86659FD93))
    return [np.uint32(1) << ((h >> U64(5 * k)) & U64(31)).astype(np.uint32) for k in range(8)]


def _block(sums: np.ndarray, blocks: int) -> np.ndarray:
    return (mix(sums) >> U64(32)) * U64(blocks) >> U64(32)


class Filters:
    """Blocked Bloom filters by length; a few arrays that are broadcast."""

    def __init__(self, shards: dict[int, np.ndarray], letters: np.ndarray):
        self.shards, self.letters = shards, letters

    def has(self, sums: np.ndarray, length: int) -> np.ndarray:
        cells = self.shards.get(min(length, LONGEST))
        if cells is None:
            return np.zeros(sums.shape, dtype=bool)
        block = _block(sums, len(cells)).astype(np.int64)
        found = np.ones(sums.shape, dtype=bool)
        for k, bit in enumerate(_cells(sums)):
            found &= (cells[block, k] & bit) != 0
        return found


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """The places of the words of each length."""
    lengths = np.fromiter((len(w) for w in words), dtype=np.int64, count=len(words))
    for n in np.unique(lengths):
        yield int(n), np.flatnonzero(lengths == n).tolist()


def build_filters(vocab: DataFrame, filter_blocks: int = FILTER_BLOCKS) -> Filters:
    """Filters of the words of vocab (column word). What is collected has at most filter_blocks rows, and a row a letter."""
    shard = F.least(F.char_length("word"), F.lit(LONGEST)).alias("shard")
    counts = {r["shard"]: r["count"] for r in vocab.groupBy(shard).count().collect()}
    total = sum(counts.values())
    each = max(WORDS_A_BLOCK, total / max(filter_blocks - LONGEST, 1))
    blocks = {k: max(1, int(n / each)) for k, n in counts.items()}

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column("word").to_pylist()
            for n, at in _by_length(words):
                of = min(n, LONGEST)
                sums = word_hash(code_points([words[i] for i in at]))
                cells = {f"c{k}": pa.array(bit.astype(np.int64)) for k, bit in enumerate(_cells(sums))}
                block = pa.array(_block(sums, blocks[of]).astype(np.int64))
                yield pa.RecordBatch.from_pydict({"shard": pa.array([of] * len(at), pa.int64()), "block": block} | cells)

    columns = [f"c{k}" for k in range(8)]
    rows = vocab.select("word").mapInArrow(entries, "shard long, block long, " + ", ".join(f"{c} long" for c in columns))
    united = rows.groupBy("shard", "block").agg(*(F.bit_or(c).alias(c) for c in columns)).toArrow().to_pydict()
    shards = {k: np.zeros((n, 8), dtype=np.uint32) for k, n in blocks.items()}
    of, block = np.array(united["shard"], dtype=np.int64), np.array(united["block"], dtype=np.int64)
    cells = np.array([united[c] for c in columns], dtype=np.uint32).T
    for k, table in shards.items():
        table[block[of == k]] = cells[of == k]
    letters = vocab.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).filter("letter <> ''").distinct().collect()
    return Filters(shards, np.array(sorted(ord(r["letter"]) for r in letters), dtype=np.uint32))


def positive_edits(words: list[str], filters: Filters) -> Iterator[tuple[int, str]]:
    """(place of the word, edit) of all edits that the filters know; words of one length."""
    n = len(words[0])
    codes = code_points(words)
    powers = _powers(n)
    terms = _marks(codes) * powers[:n]
    total = terms.sum(axis=1, dtype=U64)
    if n > 1:
        ahead = np.cumsum(terms, axis=1, dtype=U64)
        # what stands behind place i moves one place to the front
        sums = ahead - terms + (total[:, None] - ahead) * U64(_INVERSE)
        new = np.ones(codes.shape, dtype=bool)
        new[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of equal neighbours one deletion is enough
        for w, i in zip(*np.nonzero(filters.has(sums, n - 1) & new), strict=True):
            yield int(w), words[w][:i] + words[w][i + 1 :]
    marks = _marks(filters.letters)
    width = max(1, STEP // max(len(words) * len(marks), 1))
    for at in range(0, n, width):
        here = slice(at, at + width)
        rest = total[:, None] - terms[:, here]
        sums = rest[:, :, None] + marks[None, None, :] * powers[:n][here][None, :, None]
        known = filters.has(sums, n) & (filters.letters[None, None, :] > codes[:, here][:, :, None])
        for w, i, a in zip(*np.nonzero(known), strict=True):
            yield int(w), words[w][: at + i] + chr(filters.letters[a]) + words[w][at + i + 1 :]


def near_pairs(vocab: DataFrame, filters: Filters) -> DataFrame:
    """word, n, near, near_n of each unordered pair of words one edit apart, once."""
    shared = vocab.sparkSession.sparkContext.broadcast(filters)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            words, counts = b.column("word").to_pylist(), b.column("n").to_pylist()
            for length, at in _by_length(words):
                step = max(1, STEP // max(length, len(known.letters), 1))
                for k in range(0, len(at), step):
                    some = at[k : k + step]
                    found = list(positive_edits([words[i] for i in some], known))
                    yield pa.RecordBatch.from_pydict(
                        {
                            "word": pa.array([words[some[w]] for w, _ in found], pa.string()),
                            "n": pa.array([counts[some[w]] for w, _ in found], pa.int64()),
                            "edit": pa.array([e for _, e in found], pa.string()),
                        }
                    )

    positives = vocab.select("word", "n").mapInArrow(probe, "word string, n long, edit string")
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return positives.join(known, F.col("edit") == F.col("near")).drop("edit")


def roots(forms: DataFrame, ratio: int = 5) -> DataFrame:
    """word and root for the rows of forms (word, form): forms followed to the last, by pointer doubling."""
    links = stored(forms.select("word", F.col("form").alias("root")), "links")
    steps = 1
    while ratio**steps < 2**63:  # a chain of so many forms would need a larger count
        onward = links.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        moved = links.join(onward, F.col("root") == F.col("_word"), "left")
        moved = stored(moved.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "links")
        done = moved.filter("moved").isEmpty()
        links = moved.select("word", "root")
        if done:
            break
        steps *= 2
    return links


def variants(vocab: DataFrame, *, ratio: int = 5, filter_blocks: int = FILTER_BLOCKS) -> DataFrame:
    """For each row of vocab (word, n): word, form, root, n, n_near, form_n. ratio: an integer of 2 or more."""
    vocab = stored(vocab, "vocabulary")
    pairs = stored(near_pairs(vocab, build_filters(vocab, filter_blocks)), "pairs")
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = vocab.join(near, "word", "left")
    form_n = -F.col("best.less")
    formed = form_n >= F.col("n") * ratio
    told = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, form_n).alias("form_n")), "forms")
    last = roots(told.filter("form IS NOT NULL"), ratio)
    return told.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(read(spark, sf_dir, "documents"), one_in=199))


#: Steps of the check sum's table, one bit each.
_POLYNOMIAL = 0xEDB88320


def _check_table() -> str:
    """The 256 entries of the check sum's table as a SQL list, from its polynomial."""
    values = list(range(256))
    for _ in range(8):
        values = [(v >> 1) ^ (_POLYNOMIAL * (v & 1)) for v in values]
    return "CAST([" + ",".join(map(str, values)) + "] AS BIGINT[])"


OP12_SQL = rf"""
WITH RECURSIVE d AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS r FROM documents),
c AS (SELECT id, r, count(*) AS n FROM d WHERE length(r) >= 6 GROUP BY ALL),
b AS (SELECT r, n, flatten(list_transform(string_split(id || ':' || r, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [195::BIGINT, ord(x)::BIGINT - 64] END)) AS bytes FROM c),
h AS (SELECT r, n, xor(list_reduce(bytes, lambda a, x: xor(list_extract({_check_table()}, xor(a & 255, x) + 1), a >> 8), 4294967295::BIGINT), 4294967295::BIGINT) AS h FROM b),
g AS (SELECT CASE WHEN h % 199 = 0 THEN r[:(h % length(r))] || r[(h % length(r)) + 2:] ELSE r END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM g WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
e AS (SELECT DISTINCT word, n, p, word[:p - 1] || word[p + 1:] AS cut FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM v)),
near AS (SELECT x.word, y.word AS other, y.n AS other_n FROM e x JOIN e y ON x.cut = y.cut AND x.p = y.p AND x.word <> y.word
         UNION SELECT e.word, v.word, v.n FROM e JOIN v ON e.cut = v.word
         UNION SELECT v.word, e.word, e.n FROM e JOIN v ON e.cut = v.word),
m AS (SELECT word, count(*) AS n_near, max(other_n) AS top, arg_min(other, (-other_n, other)) AS best FROM near GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 5 * v.n THEN best END AS form, CASE WHEN top >= 5 * v.n THEN top END AS form_n FROM v LEFT JOIN m USING (word)),
walk AS (SELECT word, word AS at, form AS next FROM f UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN f ON walk.next = f.word)
SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM f JOIN walk ON f.word = walk.word AND walk.next IS NULL
"""
