"""Benchmark decontamination with a distributed positional inverted index; DataFrame functions only.

1. Store the postings (word, document, position) of every word that the benchmark uses, over all documents, and a row for
   each document with its number of words. One pass reads the texts; the rest works on the index.
2. Order the words of each window (consecutive words of an item) by how often they occur; a window with a word that no
   document has cannot occur.
3. The list of a window's rarest word, its positions shifted by the word's offset, gives the places where the window may
   begin. They are intersected with the shifted list of its second rarest word and, in the documents that are left, with
   those of all its other words. What stays is an exact phrase match. For proximity matches all words of a window must stand
   within `slop` more places than it has, in any order.

A posting is a few numbers, so no row holds a text or its neighbours. The benchmark's words and windows are broadcast only
while there are at most `broadcast_windows` windows; beyond that the same joins shuffle. Intersections are semi joins on word, document
and position, which no frequent word makes uneven.

Results for odd input: null text has no words; a document without words has none hit; an item without words has no
windows; equal items each count; repeated rows each give a row; null item ids are left out of the lists; empty tables give
no rows, or no hits; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, stored

WINDOW = 10
BROADCAST_WINDOWS = 100_000
#: Documents are told apart by so many hash slots before an index is shuffled; the set of slots is broadcast.
SLOTS = 1 << 19
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every run of these characters parts two words; letters A-Z count as words here and are lower-cased after.
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def raw_words(text: Column) -> Column:
    """The words of a text, A-Z not yet lower-cased; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def lowered(text: Column) -> Column:
    """A-Z lower-cased and nothing else; `lower` is quicker and is right where it changes nothing."""
    return F.when(F.lower(text) == text, text).otherwise(F.translate(text, UPPER, LOWER))


def item_windows(benchmark: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item, phrase (its words joined by a space) and n of each window; an item of fewer words is one window."""
    words = F.split(lowered(F.array_join(raw_words(F.col(text_col)), " ")), " ")
    items = benchmark.select(F.col(id_col).alias("item"), words.alias("words")).filter(F.col("words")[0] != "")
    n = F.least(F.size("words"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - n + 1)).alias("s")
    return items.select("item", "words", n.alias("n"), starts).select("item", F.array_join(F.slice("words", F.col("s"), F.col("n")), " ").alias("phrase"), "n").distinct()


def _sized(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def positional_index(docs: DataFrame, words: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", small: bool = True) -> tuple[DataFrame, DataFrame]:
    """The stored postings (word, doc_id, digest, pos from 1) of the words given, and the documents (doc_id, digest, n_words,
    copies: rows that are equal in id and text)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), raw_words(F.col(text_col)).alias("words"))
    # position 0 is the document itself; its word holds the number of words
    rows = keyed.select("doc_id", "digest", F.posexplode(F.concat(F.array(F.size("words").cast("string")), "words")).alias("pos", "raw"))
    rows = rows.select("doc_id", "digest", "pos", F.when(F.col("pos") == 0, F.col("raw")).otherwise(lowered(F.col("raw"))).alias("word"))
    known = words.select(F.col("word").alias("known"))
    if small:
        kept = rows.join(F.broadcast(known.distinct()), F.col("word") == F.col("known"), "left").filter((F.col("pos") == 0) | F.col("known").isNotNull()).drop("known")
    else:
        kept = rows.filter("pos > 0").join(known, F.col("word") == F.col("known"), "left_semi").unionByName(rows.filter("pos = 0"))
    index = stored(kept, "index")
    postings = index.filter("pos > 0").select("word", "doc_id", "digest", "pos")
    documents = index.filter("pos = 0").groupBy("doc_id", "digest").agg(F.max(F.col("word").cast("int")).alias("n_words"), F.count("*").alias("copies"))
    return postings, documents


def ordered_terms(phrases: DataFrame, postings: DataFrame, small: bool) -> DataFrame:
    """phrase_id, n, place (0: the rarest word, of equals the first), at (its offset) and word; only if all words occur."""
    frequencies = postings.groupBy("word").agg(F.count("*").alias("df"))
    terms = phrases.select("phrase_id", "n", F.posexplode(F.split("phrase", " ")).alias("at", "word")).join(_sized(frequencies, small), "word")
    lists = terms.groupBy("phrase_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "at", "word"))).alias("terms")).filter(F.size("terms") == F.col("n"))
    return lists.select("phrase_id", "n", F.posexplode("terms").alias("place", "t")).select("phrase_id", "n", "place", "t.at", "t.word")


def _in_documents(postings: DataFrame, places: DataFrame) -> DataFrame:
    """The postings of the documents that places name, and a few others."""
    slot = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(SLOTS)).cast("int").alias("slot")
    return postings.withColumn("slot", slot).join(F.broadcast(places.select(slot).distinct()), "slot", "left_semi").drop("slot")


def _standing(places: DataFrame, postings: DataFrame) -> DataFrame:
    """The rows of places whose word stands at start + at."""
    here = postings.select(F.col("word").alias("_word"), F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), F.col("pos").alias("_pos"))
    same = (F.col("word") == F.col("_word")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")) & (F.col("start") + F.col("at") == F.col("_pos"))
    return places.join(here, same, "left_semi")


def phrase_matches(postings: DataFrame, phrases: DataFrame, *, slop: int | None = None, small: bool = True) -> DataFrame:
    """Where phrases (columns phrase_id, phrase, n) occur: doc_id, digest, phrase_id, start (from 1), n. With `slop`, start is
    the place of the rarest word and all words lie within n + slop places around it."""
    terms = stored(ordered_terms(phrases, postings, small), "terms")
    key = ["doc_id", "digest", "phrase_id", "n", "start"]
    of = lambda place: _sized(terms.filter(F.col("place") == place), small)
    start = F.col("pos") - (F.col("at") if slop is None else F.lit(0))
    places = postings.join(of(0), "word").select("doc_id", "digest", "phrase_id", "n", start.alias("start")).filter("start > 0").distinct()
    if slop is not None:
        return _around(stored(places, "places"), postings, terms, slop).select(*key)
    places = stored(places, "places")
    single, longer = places.filter("n = 1"), places.filter("n > 1")
    second = longer.join(_sized(terms.filter("place = 1").drop("n", "place"), small), "phrase_id")
    words = _sized(terms.filter("place = 1").select("word").distinct(), small)
    places = stored(_standing(second, _in_documents(postings, longer).join(words, "word", "left_semi")).select(*key), "places")
    # few places are left: all other words at once
    left = stored(_in_documents(postings, places), "postings")
    rest = places.join(_sized(terms.filter("place > 1").drop("n"), small), "phrase_id")
    found = _standing(rest, left).groupBy(*key).agg(F.count("*").alias("found")).filter(F.col("found") == F.col("n") - 2)
    return single.select(*key).unionByName(places.filter("n = 2").select(*key)).unionByName(found.select(*key))


def _around(places: DataFrame, postings: DataFrame, terms: DataFrame, slop: int) -> DataFrame:
    """The places with all other words of their phrase within n + slop places, by bins of positions."""
    rest = terms.filter("place > 0").groupBy("phrase_id").agg(F.collect_set("word").alias("words"))
    anchors = terms.filter("place = 0").select("phrase_id", F.col("word").alias("anchor"))
    span = F.col("n") + slop
    asked = places.join(anchors, "phrase_id").join(rest, "phrase_id", "left").withColumn("words", F.array_except(F.coalesce("words", F.array().cast("array<string>")), F.array("anchor")))
    alone, others = asked.filter(F.size("words") == 0), asked.filter(F.size("words") > 0)
    width = 64
    low, high = F.floor((F.col("start") - span) / width), F.floor((F.col("start") + span) / width)
    looked = others.withColumn("word", F.explode("words")).withColumn("bin", F.explode(F.sequence(low, high)))
    here = postings.select(F.col("word").alias("_word"), F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "pos", F.floor(F.col("pos") / width).alias("_bin"))
    same = (F.col("word") == F.col("_word")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest")) & (F.col("bin") == F.col("_bin"))
    met = looked.join(here, same).filter(F.abs(F.col("pos") - F.col("start")) < span)
    sets = met.groupBy("doc_id", "digest", "phrase_id", "n", "start", F.size("words").alias("needed")).agg(F.collect_set(F.struct("word", "pos")).alias("seen"))
    inside = lambda s: F.size(F.array_distinct(F.transform(F.filter("seen", lambda g: (g["pos"] >= s) & (g["pos"] < s + span)), lambda g: g["word"])))
    found = sets.filter(F.exists(F.sequence(F.greatest(F.col("start") - span + 1, F.lit(1)), F.col("start")), lambda s: inside(s) == F.col("needed")))
    return found.unionByName(alone, allowMissingColumns=True)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """For each row of docs: doc_id, digest (of the text), n_words, spans (array of start and end words, from 1, end
    included, of all occurrences) and items (ids of benchmark items with an occurring window, as sorted strings)."""
    items = stored(item_windows(benchmark, window), "items")
    small = items.limit(broadcast_windows + 1).count() <= broadcast_windows
    phrases = stored(items.select("phrase", "n").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    words = stored(phrases.select(F.explode(F.split("phrase", " ")).alias("word")).distinct(), "words")
    postings, documents = positional_index(docs, words, id_col=id_col, text_col=text_col, small=small)
    matches = stored(phrase_matches(postings, phrases, small=small), "matches")
    key = ["doc_id", "digest"]
    span = F.struct("start", (F.col("start") + F.col("n") - 1).alias("end"))
    spans = matches.groupBy(*key).agg(F.array_sort(F.collect_set(span)).alias("spans"))
    named = items.join(phrases.drop("n"), "phrase").select("phrase_id", F.col("item").cast("string").alias("item"))
    hit = matches.select(*key, "phrase_id").distinct().join(_sized(named, small), "phrase_id")
    ids = hit.groupBy(*key).agg(F.array_sort(F.collect_set("item")).alias("items"))
    same = lambda a, b: (F.col(f"{a}.digest") == F.col(f"{b}.digest")) & F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id"))
    joined = documents.alias("d").join(spans.alias("s"), same("d", "s"), "left").join(ids.alias("i"), same("d", "i"), "left")
    none = lambda kind: F.array().cast(kind)
    out = joined.select("d.*", F.coalesce("s.spans", none("array<struct<start:int,end:int>>")).alias("spans"), F.coalesce("i.items", none("array<string>")).alias("items"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies", "copy")


def covered(spans: Column) -> Column:
    """How many places a sorted array of spans covers."""
    begin = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(s["end"] - F.greatest(s["start"] - 1, acc["end"]), F.lit(0))).alias("n"),
        F.greatest(acc["end"], s["end"]).alias("end"),
    )
    return F.aggregate(spans, begin, step, lambda acc: acc["n"])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        covered(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP10_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM bs),
ds AS (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
occ AS (SELECT DISTINCT k, s, x.n, item_id FROM (SELECT k, s, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM ds) x JOIN bw ON x.g = bw.g AND x.n = bw.n),
hits AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(s, s + n)) AS p FROM occ) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (k) LEFT JOIN its USING (k)
"""
