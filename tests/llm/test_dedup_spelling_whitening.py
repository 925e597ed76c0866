"""Exact copies, spelling variants and whitening against brute force, and their defined results for odd input."""

import hashlib
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quillon.llm import exact_dedup, spelling, whitening
from quillon.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, hash string, `row` int, `a.b` string"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_spelling_variants"])
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
    wanted = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in wanted.description]
    assert rows_of(QUERIES[name](spark, sf_dir), *columns) == sorted(wanted.fetchall(), key=str)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def dedup_brute(rows, keep):
    by = defaultdict(list)
    for doc_id, text in rows:
        by[lowered(text)].append(doc_id)
    out = []
    for text, ids in by.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "greatest" else min)(known) if known else None
        left = 1
        for i in ids:
            kept = i == best and left > 0
            left -= kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ODD = [(1, "Same Text"), (2, "same text"), (9, "SAME TEXT"), (3, None), (4, ""), (None, ""), (5, "É"), (6, "é"), (None, "only"), (None, "only"), (7, "x" * 300_000), (8, "X" * 300_000), (9, "SAME TEXT"), (10, "K"), (11, "k"), (12, "a\0b"), (13, "A\0B")]


@pytest.mark.parametrize("keep", ["least", "greatest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_copies(spark, keep, weak):
    """Also with a hash of four values, where nearly all groups are collisions."""
    docs = spark.createDataFrame([(i, t, "x", 7, "y") for i, t in ODD], DOCS)
    hashed = (lambda t: F.unhex(F.lpad(F.hex(F.crc32(t.cast("binary")) % 4), 2, "0"))) if weak else exact_dedup.content_hash
    found = rows_of(exact_dedup.groups(docs, keep=keep, hashed=hashed), "id", "keep_id", "group_size", "kept", "text_sha256")
    assert found == dedup_brute(ODD, keep)


def test_exact_copies_hot_group(spark):
    """A group of a third of the rows, among it one row many times, and small groups."""
    rows = [(i, "Hot") for i in range(600)] + [(5000, "hot")] * 400 + [(i, f"pair {i // 2}") for i in range(1000, 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = rows_of(exact_dedup.groups(docs, keep="greatest"), "id", "keep_id", "group_size", "kept", "text_sha256")
    assert found == dedup_brute(rows, "greatest")


def test_exact_copies_of_nothing(spark):
    assert exact_dedup.groups(spark.createDataFrame([], DOCS)).collect() == []
    one = exact_dedup.groups(spark.createDataFrame([("b", "t"), ("a", "t")], "doc_id string, text string")).collect()
    assert {(r["id"], r["keep_id"], r["kept"]) for r in one} == {("a", "a", True), ("b", "a", False)}


def test_unknown_side(spark):
    with pytest.raises(ValueError, match="keep"):
        exact_dedup.groups(spark.createDataFrame([], DOCS), keep="first")


def words_brute(rows, one_in):
    counts = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "\xc0" <= c <= "\xff":
                run += c
                continue
            if run:
                word = lowered(run)
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if one_in and h % one_in == 0:
                    word = word[: h % len(word)] + word[h % len(word) + 1 :]
                counts[word] += 1
            run = ""
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_brute(vocab, ratio=5):
    forms, n_near = {}, {}
    for w, n in vocab.items():
        others = [v for v in vocab if near(v, w)]
        n_near[w] = len(others)
        best = min(others, key=lambda v: (-vocab[v], v), default=None)
        forms[w] = best if best is not None and vocab[best] >= ratio * n else None
    out = []
    for w, n in vocab.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, n_near[w], vocab.get(forms[w])))
    return sorted(out, key=str)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def spelled():
    rng = np.random.default_rng(5)
    letters = list("abcdefgé\xdf")
    words = []
    for _ in range(60):
        base = "".join(rng.choice(letters, rng.integers(6, 12)))
        words += [base] * int(rng.integers(5, 400))
        for _ in range(6):
            at = int(rng.integers(len(base)))
            kind = rng.integers(3)
            middle = "" if kind == 0 else str(rng.choice(letters)) + (base[at] if kind == 1 else "")
            words += [base[:at] + middle + base[at + 1 :]] * int(rng.integers(3, 30))
    long = "abcdef" * 40
    chain = {"zzzzzza": 5, "zzzzzzb": 25, "zzzzzzbb": 125, "zzzzzbbb": 700}
    words += [long] * 30 + [long[:100] + long[101:]] * 6 + [long[:100] + "z" + long[101:]] * 5 + ["tiesaa"] * 5 + ["tiesab", "tiesac"] * 30
    words += [w for w, n in chain.items() for _ in range(n)] + ["Straße", "STRAße"] * 4 + ["strasse", "short", "\xd7\xf7\xd7\xf7\xd7\xf7"] * 6
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::50])) for i in range(50)]
    return rows + [(None, "Garbled garbled " * 20), (None, None), (60, ""), (61, "1 2, ."), (7, rows[7][1])]


@pytest.mark.parametrize(("one_in", "blocks"), [(None, spelling.FILTER_BLOCKS), (3, spelling.FILTER_BLOCKS), (None, spelling.LONGEST + 1)])
def test_variants(spark, one_in, blocks):
    """Also with filters so small that nearly every probe is positive."""
    rows = spelled()
    docs = spark.createDataFrame([(i, t, "x", 1, None) for i, t in rows], "doc_id long, text string, word string, n int, `a.b` string")
    vocab = words_brute(rows, one_in)
    found = spelling.variants(spelling.vocabulary(docs, one_in=one_in), filter_blocks=blocks)
    assert rows_of(found, *COLUMNS) == variants_brute(vocab)
    assert len(vocab) > 100


def test_variants_of_nothing(spark):
    for rows in ([], [(1, None)], [(1, "a few rare words here")]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        assert spelling.variants(spelling.vocabulary(docs)).collect() == []


def test_very_long_words(spark):
    long = "qwertz" * 2_000
    rows = [(i, long if i % 2 else long[:5000] + "y" + long[5001:]) for i in range(12)]
    found = spelling.variants(spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string"), one_in=None))
    assert [(len(r["word"]), r["n"], r["n_near"], r["form"]) for r in found.collect()] == [(12_000, 6, 1, None)] * 2


def test_edits_meet_each_pair_once():
    class All(spelling.Filters):
        def has(self, sums, length):
            return np.ones(sums.shape, dtype=bool)

    words = ["aabbca", "abcabc"]
    letters = "abcd"
    found = list(spelling.positive_edits(words, All({}, np.array([ord(c) for c in letters], dtype=np.uint32))))
    wanted = {(w, x[:i] + x[i + 1 :]) for w, x in enumerate(words) for i in range(6)}
    wanted |= {(w, x[:i] + c + x[i + 1 :]) for w, x in enumerate(words) for i in range(6) for c in letters if c > x[i]}
    assert len(found) == len(set(found)) and set(found) == wanted


def quantised(rows):
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    return good, np.floor(64.0 * np.array([v for _, v in good], dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000


def whiten_brute(rows, k):
    """Values for each (row, component), of components up to sign."""
    good, x = quantised(rows)
    fit = np.unique(x, axis=0)
    n, totals = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    white = (x - fit.mean(axis=0)) @ vectors / np.sqrt(values)
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(v, totals, strict=True)) for v in x]
    return [i for i, _ in good], n, deviation, white, values / np.trace(covariance)


def compare(found, rows, k):
    ids, n, deviation, white, explained = whiten_brute(rows, k)
    found = found.collect()
    assert len(found) == len(ids) * k
    places = defaultdict(lambda: defaultdict(list))
    for r in found:
        places[str(r[0]), r["deviation"]][r["component"]].append(r["whitened"])
    # repeated rows, of one id and vector, have their values as often
    times = Counter((str(i), d) for i, d in zip(ids, deviation, strict=True))
    assert {key: {c: len(v) for c, v in of.items()} for key, of in places.items()} == {key: {c + 1: m for c in range(k)} for key, m in times.items()}
    assert all(len(set(v)) == 1 for of in places.values() for v in of.values())
    got = np.array([[places[str(i), d][c + 1][0] for c in range(k)] for i, d in zip(ids, deviation, strict=True)])
    assert {r["n"] for r in found} == {n}
    shares = {r["component"]: r["explained"] for r in found}
    assert np.allclose([shares[c + 1] for c in range(k)], explained, rtol=1e-9)
    assert np.allclose(got * np.sign((got * white).sum(axis=0)), white, atol=1e-6)
    assert {r["identity_error"] for r in found}.pop() < 1e-8


def test_whitening_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(QUERIES["op13_embedding_whitening"](spark, sf_dir), rows, 16)


def test_whitening_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=5) * [9, 5, 3, 2, 1]]) for i in range(300)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (400, None), (401, [1.0, None, 1.0, 1.0, 1.0]), (402, [float("nan")] * 5), (403, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (404, [])] + [(500 + i, rows[1][1]) for i in range(200)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, x string, n int")
    usable, dims = whitening.usable(df)
    assert dims == 5
    compare(whitening.whiten(usable, whitening.fit(usable, dims, 3), dims), rows, 3)


def test_whitening_of_little(spark):
    def run(rows):
        usable, dims = whitening.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        return whitening.whiten(usable, whitening.fit(usable, dims), dims).collect()

    assert run([]) == [] and run([(1, None)]) == [] and run([(1, [1.0, 2.0])] * 3) == []
    flat = run([(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 4.0])])
    assert sorted((r["id"], r["component"], round(abs(r["whitened"]), 9)) for r in flat) == [(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)]
    assert {r["id"] for r in run([(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0]), (4, [3e38, 1.0])])} == {1, 2}
    huge = run([(1, [1e10]), (2, [-1e10]), (3, [0.0])])
    assert {(r["id"], r["deviation"]) for r in huge} == {(1, None), (2, None), (3, 0)}


@pytest.mark.parametrize("size", [1, 2, 3, 40])
def test_eigenvectors(size):
    rng = np.random.default_rng(size)
    q = np.linalg.qr(rng.normal(size=(size, size)))[0]
    for wanted in (np.arange(size, 0, -1.0), np.full(size, 2.0), np.where(np.arange(size) < size // 2, 3.0, 1.0) + 1e-10 * np.arange(size)[::-1]):
        a = (q * wanted) @ q.T
        values, vectors = whitening.leading_components((a + a.T) / 2, 16)
        assert np.allclose(values, np.sort(wanted)[::-1][:16], rtol=1e-12)
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-12 * size)
