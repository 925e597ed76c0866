import hashlib
import random
import re
import zlib

import brute
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillon.llm import secrets
from quillon.llm._common import read, stored
from quillon.llm.language import op1_language_id
from quillon.llm.token_files import op8_token_files
from quillon.llm.toxicity import op2_toxicity
from quillon.llm.tokens import definition_of, vocabulary_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def windows(text):
    w = words(text)
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The rows after each stage."""
    docs, out = read(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        out.append(docs.collect())
    return [read(spark, sf_dir, "documents").collect(), *out]


def test_stages_keep_the_columns(stages):
    for rows in stages[1:-1]:
        assert rows[0].__fields__ == stages[0][0].__fields__


def test_language_stage_keeps_clean_documents(stages):
    assert {r.doc_id for r in stages[0]} - {r.doc_id for r in stages[1]} <= {r.doc_id for r in stages[0] if not any(c.isalpha() for c in r.text or "")}


def test_dedup_stage_keeps_the_least_of_each_class(stages):
    rows = sorted(stages[1], key=lambda r: r.doc_id)
    label = brute.classes(len(rows), brute.links([r.text for r in rows]))
    assert {r.doc_id for r in stages[2]} == {rows[k].doc_id for k in label}


def test_decontamination_stage_drops_hit_documents(stages, spark, sf_dir):
    banned = set().union(*(windows(r.text) for r in read(spark, sf_dir, "benchmark").collect()))
    sizes = {len(w) for w in banned}
    hit = lambda t: any(tuple(w[i : i + n]) in banned for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))
    assert {r.doc_id for r in stages[3]} == {r.doc_id for r in stages[2] if not hit(r.text)}


def test_secret_stage_masks_and_changes_nothing_else(stages):
    before = {r.doc_id: r for r in stages[3]}
    assert len(stages[4]) == len(before)
    for r in stages[4]:
        assert r.n_chars == len(r.text)
        spans = secrets.base_spans(before[r.doc_id].text)
        assert not any(before[r.doc_id].text[i:j] in r.text for i, k, j in spans if k == 2)
        if "[SECRET]" not in r.text:
            assert r.text == before[r.doc_id].text and not spans


def test_last_stage_equals_the_library(stages):
    library = Tokenizer.from_str(definition_of(vocabulary_path("word_bpe_49k.json")))
    texts = {r.doc_id: r.text for r in stages[4]}
    assert len(stages[5]) == len(texts)
    for r in stages[5]:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_language_query_on_held_out_rows(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in read(spark, sf_dir, "documents").collect()}
    got = op1_language_id(spark, sf_dir).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_toxicity_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in read(spark, sf_dir, "labels").collect()}
    held = [r for r in op2_toxicity(spark, sf_dir).collect() if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.9 * len(held)


def test_token_file_query_by_brute_force(spark, sf_dir):
    library = Tokenizer.from_str(definition_of(vocabulary_path("byte_bpe_50k.json")))
    start = 0
    got = {r.doc_id: r for r in op8_token_files(spark, sf_dir).collect()}
    for d in sorted(read(spark, sf_dir, "documents").collect(), key=lambda d: d.doc_id):
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, 2]
        r = got[d.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)


def test_stages_tell_rows_with_null_repeated_and_shared_ids_apart(spark, sf_dir):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(500)]
    x, y, z = ([*rng.choices(vocabulary, k=120)] for _ in range(3))
    near = lambda words: " ".join([*words, "more"])
    x, y, z, x2, y2, z2 = *map(" ".join, (x, y, z)), near(x), near(y), near(z)
    rows = [(1, x, "a"), (5, x2, "a"), (5, y, "b"), (5, y, "a"), (9, y2, "a"), (None, z, "a"), (None, z, "a"), (None, z2, "a"), (None, x2, "a"), (5, None, "a"), (5, None, "a"), (6, None, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.dedup_stage(spark, docs, sf_dir).collect()]
    of_z = [r for r in kept if r[0] is None]
    assert len(of_z) == 1 and of_z[0] in [(None, z, "a"), (None, z2, "a")]
    assert sorted(map(str, kept)) == sorted(map(str, [(1, x, "a"), (5, y, "a"), (5, None, "a"), (6, None, "a"), *of_z]))

    item = read(spark, sf_dir, "benchmark").filter("text is not null").first().text
    texts = [item, "clean words only", "hold password=abcdefgh1 here", "a much longer head, then token: zyxwvut98 here", "clean text that has no such thing, long enough"]
    rows = [(k, t, "a") for k in (None, 4) for t in texts] + [(4, texts[2], "a"), (None, texts[3], "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clean = [tuple(r) for r in corpus_pipeline.decontamination_stage(spark, docs, sf_dir).collect()]
    assert sorted(map(str, clean)) == sorted(str(r) for r in rows if r[1] != item)
    masked = {texts[2]: "hold [SECRET] here", texts[3]: "a much longer head, then [SECRET] here"}
    got = [tuple(r) for r in corpus_pipeline.secrets_stage(spark, docs, sf_dir).collect()]
    assert sorted(map(str, got)) == sorted(str((k, masked.get(t, t), s)) for k, t, s in rows)
    named = read(spark, sf_dir, "documents")
    nameless = named.withColumn("doc_id", F.lit(None).cast("long"))
    found = corpus_pipeline.language_stage(spark, named.union(nameless).union(nameless), sf_dir).collect()
    ours = sorted(r.text for r in found if r.doc_id is not None)
    assert ours and sorted(r.text for r in found if r.doc_id is None) == sorted(ours + ours)
    assert corpus_pipeline.encoding_stage(spark, docs, sf_dir).count() == len(rows)


def test_stages_keep_columns_of_any_name_and_empty_tables(spark, sf_dir):
    names = ["score", "rejected", "lang_pred", "spans", "digest", "row", "node", "label", "_copy", "n", "text_", "a.b"]
    docs = read(spark, sf_dir, "documents").select("*", *(F.col("doc_id").cast("string").alias(c) for c in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), sf_dir) if name != "language_id" else None
        assert empty is None or (empty.columns == docs.columns and empty.count() == 0)
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns[-len(names) :] == names
    assert all(r[c] == str(r.doc_id) for r in docs.collect() for c in names)
