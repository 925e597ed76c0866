import random
import zlib

import numpy as np
import pytest

from quillon.llm.token_counts import token_counts
from quillon.llm.token_files import TokenFile, encode_file, read_token_files, write_token_files
from quillon.llm.tokens import definition_of, vocabulary_path

ODD = ["", " a", "a ", "  a", "a  b", "a \n b", "x<|endoftext|> y", "x <|endoftext|>y", "don't 'real 'rex", "\t a", "a\xa0 b", "a\x1c b", "  ", " ", "\n\n a", "日本語 テスト 12 ab", "a,b c.", "É. ñ,", None, "x" * 900 + " " + "y" * 5]


@pytest.fixture(scope="module")
def definition():
    return definition_of(vocabulary_path("byte_bpe_50k.json"))


def library_ids(definition, text):
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition).encode(text or "", add_special_tokens=False).ids


def texts():
    rng = random.Random(5)
    words = ["the", "then", "über", "x1", "a,", "b.", "don't", "\nline", "日本", "<|endoftext|>", "  ", "\t", "word" * 30]
    return ODD + [" ".join(rng.choices(words, k=n)) for n in (1, 40, 400, 900)] + ["z" * 700, "q" * 300 + " " + "r" * 500]


def test_counts_equal_the_library_for_any_chunk(spark, definition):
    rows = [(k, t, "x") for k, t in enumerate(texts())] + [(0, "", "x"), (None, "null id", "x"), (30, texts()[-4], "x"), (30, texts()[-4], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    want = sorted((str(k), len((t or "").encode()), len(library_ids(definition, t))) for k, t, _ in rows)
    for chunk, overlap in ((100, 30), (64, 64), (32_768, 2_048)):
        got = token_counts(docs, definition, chunk=chunk, overlap=overlap).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want


def test_counts_of_an_empty_table(spark, definition):
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), definition).count() == 0


def test_token_files_round_trip(spark, definition, tmp_path):
    rows = [(k * 3 % 17, t) for k, t in enumerate(texts())] + [(None, "null id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = f"file://{tmp_path}/ids"
    manifest = write_token_files(docs, folder, definition, end_id=2, file_ids=200)
    got = read_token_files(spark, folder, manifest).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (doc, text) in zip(got, ordered, strict=True):
        ids = np.array([*library_ids(definition, text), 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    empty = write_token_files(docs.limit(0), folder + "0", definition, end_id=2)
    assert read_token_files(spark, folder + "0", empty).count() == 0


def test_any_token_is_read_directly():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 2**k, 700) for k in (8, 16, 24, 31)]).astype(np.uint32)
    rng.shuffle(ids)
    f = TokenFile(encode_file([4, None], np.array([1000, len(ids) - 1000]), ids))
    assert f.doc_ids == [4, None] and f.starts.tolist() == [0, 1000, len(ids)]
    assert [f.token(i) for i in range(len(ids))] == ids.tolist()
    for i, j in ((0, 5), (511, 513), (999, 2400), (7, 7), (0, len(ids))):
        assert f.tokens(i, j).tolist() == ids[i:j].tolist()
    with pytest.raises(ValueError):
        TokenFile(encode_file([1], np.array([3]), ids[:3])[:-1])
