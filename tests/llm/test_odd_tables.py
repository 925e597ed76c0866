"""Registered queries and stages on tables with null ids, repeated rows, clashing names, or no rows at all."""

import hashlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillon.llm import near_dedup, token_files, word_bpe
from quillon.llm._common import read, scratch
from quillon.llm.queries import QUERIES
from quillon.llm.tokens import definition_of, vocabulary_path

EMPTY = ["op1_language_id", "op2_toxicity", "op3_near_dedup", "op7_bpe", "op8_token_files", "op9_token_counts", "op11_exact_dedup", "op12_spelling_variants", "op13_embedding_whitening"]


def table(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


@pytest.fixture(scope="module")
def odd_dir(spark, sf_dir, tmp_path_factory):
    """Documents with repeated rows, null ids, null texts and further columns; the other tables as they are."""
    folder = str(tmp_path_factory.mktemp("odd"))
    docs = read(spark, sf_dir, "documents")
    nameless = docs.filter("doc_id < 40").withColumn("doc_id", F.lit(None).cast("long"))
    textless = docs.filter("doc_id < 20").withColumn("text", F.lit(None).cast("string"))
    more = docs.unionByName(docs.filter("doc_id < 60")).unionByName(nameless).unionByName(textless)
    clash = ["score", "held_out", "predicted", "n_tokens", "keep_id", "kept", "word", "id", "row", "hash", "a.b"]
    table(more.select("*", *(F.lit("x").alias(c) for c in clash)), folder, "documents")
    table(read(spark, sf_dir, "labels").unionByName(read(spark, sf_dir, "labels")), folder, "labels")
    return folder


@pytest.mark.parametrize("name", EMPTY)
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for t in ("documents", "labels", "embeddings", "benchmark", "pages"):
        table(read(spark, sf_dir, t).limit(0), str(tmp_path), t)
    whole = QUERIES[name](spark, sf_dir)
    got = QUERIES[name](spark, str(tmp_path))
    assert got.collect() == [] and got.columns == whole.columns


def test_language_stage_on_no_rows(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").limit(0).withColumn("lang_pred", F.lit("x"))
    got = corpus_pipeline.language_stage(spark, docs, sf_dir)
    assert got.columns == docs.columns and got.collect() == []


@pytest.mark.parametrize("name", ["op1_language_id", "op2_toxicity"])
def test_classifiers_on_odd_rows(spark, odd_dir, name):
    """Every row has an answer; equal texts have equal ones; rows without an id are not held out."""
    docs = read(spark, odd_dir, "documents")
    got = QUERIES[name](spark, odd_dir).collect()
    assert len(got) == docs.count() and all(r["held_out"] is not None for r in got)
    assert not any(r["held_out"] for r in got if r["doc_id"] is None)
    answers = {}
    for r in got:
        if r["doc_id"] is not None:
            answers.setdefault(r["doc_id"], set()).add(tuple(r[c] for c in got[0].__fields__ if c != "doc_id"))
    texts = {r["doc_id"]: r["n"] for r in docs.groupBy("doc_id").agg(F.count_distinct(F.coalesce("text", F.lit(""))).alias("n")).collect()}
    assert all(len(a) <= texts[i] for i, a in answers.items())


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_spelling_variants"])
def test_new_queries_on_odd_rows(spark, odd_dir, name):
    import duckdb

    from quillon.llm.queries import ORACLE_SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{odd_dir}/documents.parquet/*.parquet')")
    wanted = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in wanted.description]
    got = QUERIES[name](spark, odd_dir).collect()
    assert sorted(map(str, (tuple(r[c] for c in columns) for r in got))) == sorted(map(str, wanted.fetchall()))


def test_encoders_with_clashing_names(spark, odd_dir):
    docs = read(spark, odd_dir, "documents").filter("doc_id < 30")
    path = vocabulary_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    wanted = sorted((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect())
    assert sorted((r["doc_id"], r["n_tokens"]) for r in word_bpe.digests(docs, definition_of(path)).collect()) == wanted
    folder = scratch(spark, "token-files")
    path = vocabulary_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    manifest = token_files.write_token_files(docs, folder, definition_of(path), end_id=2)
    found = token_files.read_token_files(spark, folder, manifest).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in found) == sorted((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in docs.collect())


def test_very_long_texts_are_compared_whole(spark):
    """Two texts of 30,000 words that differ at both ends are near copies; a third shares only its first half."""
    words = [hashlib.md5(str(i).encode()).hexdigest()[:6] for i in range(30_000)]
    other = [hashlib.md5(f"o{i}".encode()).hexdigest()[:6] for i in range(15_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["new", *words[1:-1], "end"])), (3, " ".join(words[:15_000] + other))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {1: 1, 2: 1, 3: 3}
