"""Secret scans: fixed patterns, and a battery of randomness tests on long tokens.

Patterns (kinds `assign`, `access`, `hex`) are matched leftmost and without overlap in the whole text.

Tokens are the longest runs of 16 or more characters of [A-Za-z0-9+/_-] with trailing padding (up to six '=') that are not
digits alone. Any other '=' parts two runs, so the value of NAME=VALUE is tested by itself, whatever its name. Of a run that
a pattern covers in part the uncovered parts of 16 or more characters are tokens; shorter parts are not tested. The encoding
is inferred from the characters that occur. The battery is chi-squared uniformity over that alphabet, Wald-Wolfowitz runs
around the middle symbol and lag-1 serial correlation. For a random token the chi-squared statistic and the squares of the
other two's deviations add up to a chi-squared of k + 1 degrees; a token passes if the sum's upper tail is at least ALPHA.
Its p-value as a discovery is the chance that ordinary text of its length scores a sum so low: the lower tail of the
non-central chi-squared with the encoding's DIVERGENCE a character, so short tokens need a better fit than long ones.
Benjamini-Hochberg at level q holds the false discoveries within each length class, over all tokens of all documents; its
input is a count for each class and p-value bin, so nothing that grows with the corpus reaches the driver.

Results for odd input: null and empty texts have no spans and the digest of no text; repeated rows and null or repeated
ids each give a row; an empty table gives no rows; further columns are ignored by `find_secrets` and kept by `redact`, which
scans and cuts each row by itself, whatever its id.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, sliced, stored

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{10,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?")
SHORTEST = 16
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

ALPHA = 0.001
LEVEL = 0.01
BINS_A_DECADE, LAST_BIN = 20, 400
KEPT_BIN = 20
LENGTHS = (16, 20, 28, 40, 64)
#: encoding: alphabet, and k * sum((q - 1/k)^2) of ordinary text's symbol shares q over that alphabet of k
DIGITS, UPPERS, LOWERS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": (DIGITS + "abcdef", 0.6),
    "HEX": (DIGITS + "ABCDEF", 0.6),
    "base32": (UPPERS + "234567", 1.2),
    "lower": (LOWERS, 0.95),
    "upper": (UPPERS, 0.95),
    "lower36": (DIGITS + LOWERS, 1.5),
    "upper36": (DIGITS + UPPERS, 1.5),
    "letters": (UPPERS + LOWERS, 2.6),
    "base62": (DIGITS + UPPERS + LOWERS, 3.3),
    "base64": (UPPERS + LOWERS + DIGITS + "+/", 3.5),
    "base64url": (UPPERS + LOWERS + DIGITS + "-_", 3.5),
    "mixed64": (UPPERS + LOWERS + DIGITS + "+/-_", 3.7),
}
NAMES_OF = list(ENCODINGS)
_TABLES = np.full((len(ENCODINGS), 128), -1, np.int64)
for _i, (_alphabet, _) in enumerate(ENCODINGS.values()):
    for _j, _c in enumerate(_alphabet):
        _TABLES[_i, ord(_c)] = _j

SPAN = "struct<start:int,kind:int,end:int>"
TOKENS = "array<struct<start:int,end:int,length_class:int,bin:int>>"
SCANNED = f"doc_id long, digest long, base array<{SPAN}>, tokens {TOKENS}, tests array<long>"


def base_spans(text: str, long_runs: list[tuple[int, int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in order."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    runs = long_runs if long_runs is not None else [(0, len(text))]
    out += [(m.start(), 2, m.end()) for i, j in runs if j - i >= 32 for m in HEX.finditer(text, i, j)]
    return sorted(out)


def uncovered(run: tuple[int, int], found: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a run, of SHORTEST characters at least, that none of the spans covers."""
    out, at = [], run[0]
    for s, _, e in found:
        if e > at and s < run[1]:
            out.append((at, s))
            at = e
    return [(i, j) for i, j in [*out, (at, run[1])] if j - i >= SHORTEST]


def encoding_of(token: str) -> str | None:
    """The smallest known alphabet that holds the token; none for digits alone."""
    body = token.rstrip("=")
    lower, upper, digit = any("a" <= c <= "z" for c in body), any("A" <= c <= "Z" for c in body), any(c.isdigit() for c in body)
    plus, dash = "+" in body or "/" in body, "-" in body or "_" in body
    if "=" in body or not (lower or upper):
        return None
    if plus or dash:
        return "mixed64" if plus and dash else "base64" if plus else "base64url"
    if lower and upper:
        return "base62" if digit else "letters"
    if digit and lower:
        return "hex" if all(c in "0123456789abcdef" for c in body) else "lower36"
    if digit:
        return "HEX" if all(c in "0123456789ABCDEF" for c in body) else "base32" if not any(c in "0189" for c in body) else "upper36"
    return "lower" if lower else "upper"


def _phi(z: np.ndarray) -> np.ndarray:
    """The normal distribution function."""
    return np.fromiter((0.5 * math.erfc(-x / math.sqrt(2)) for x in z.tolist()), float, len(z))


def battery(tokens: list[str], encodings: list[str]) -> dict[str, np.ndarray]:
    """For each token the statistics `chi` (of k - 1 degrees), `runs` and `serial` (deviations), and the p-values of their
    combination: `random` that of a random token, `ordinary` that of ordinary text of its length."""
    bodies = [t.rstrip("=") for t in tokens]
    n = np.array(list(map(len, bodies)))
    kind = np.array([NAMES_OF.index(e) for e in encodings])
    k = np.array([len(a) for a, _ in ENCODINGS.values()])[kind].astype(float)
    divergence = np.array([d for _, d in ENCODINGS.values()])[kind]
    which = np.repeat(np.arange(len(n)), n)
    symbols = _TABLES[kind[which], np.frombuffer("".join(bodies).encode("ascii"), np.uint8)]
    counts = np.bincount(which * 80 + symbols, minlength=80 * len(n)).reshape(len(n), 80)
    chi = (counts.astype(float) ** 2).sum(1) * k / n - n
    high = symbols >= (k / 2)[which]
    edge = np.concatenate([[True], which[1:] != which[:-1]])
    change = np.concatenate([[False], high[1:] != high[:-1]]) & ~edge
    runs = 1 + np.bincount(which, change, len(n))
    up = np.bincount(which, high, len(n))
    down = n - up
    mean = 1 + 2 * up * down / n
    var = np.maximum((mean - 1) * (mean - 2) / np.maximum(n - 1, 1), 1e-9)
    z = np.where((up == 0) | (down == 0), 9.0, (runs - mean) / np.sqrt(var))
    x = symbols - (np.bincount(which, symbols, len(n)) / n)[which]
    square = np.bincount(which, x * x, len(n))
    product = np.bincount(which[1:], np.where(edge[1:], 0, x[1:] * x[:-1]), len(n))
    r = np.where(square > 0, product / np.maximum(square, 1e-9), 1.0)
    serial = (r + 1 / n) * np.sqrt(n)
    total, degrees, shift = chi + z * z + serial * serial, k + 1, divergence * n
    # Wilson and Hilferty's cube root makes the sum nearly normal
    random = 1 - _phi(((total / degrees) ** (1 / 3) - (1 - 2 / (9 * degrees))) / np.sqrt(2 / (9 * degrees)))
    ordinary = _phi((total - degrees - shift) / np.sqrt(2 * (degrees + 2 * shift)))
    return {"chi": chi, "runs": z, "serial": serial, "random": random, "ordinary": ordinary}


_TOKEN = pa.struct([(c, pa.int32()) for c in ("start", "end", "length_class", "bin")])
_SPAN = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])


def scan(texts: list[str | None]) -> tuple[list, list, np.ndarray]:
    """For each text its base spans (start, kind, end) and its likely tokens (start, end, length class, bin); and the number
    of tokens tested in each (text, length class)."""
    base, owner, spans, tokens, encodings = [], [], [], [], []
    for d, text in enumerate(texts):
        text = text or ""
        runs = [m.span() for m in TOKEN.finditer(text) if m.end() - m.start() >= SHORTEST]
        found = base_spans(text, runs)
        base.append(found)
        for i, j in [part for run in runs for part in (uncovered(run, found) if found else [run])]:
            if e := encoding_of(text[i:j]):
                owner.append(d), spans.append((i, j)), tokens.append(text[i:j]), encodings.append(e)
    tested, likely = np.zeros((len(texts), len(LENGTHS)), int), [[] for _ in texts]
    if tokens:
        p = battery(tokens, encodings)
        level = np.where(p["random"] >= ALPHA, np.minimum(-np.log10(np.maximum(p["ordinary"], 1e-300)) * BINS_A_DECADE, LAST_BIN), 0).astype(int)
        length = np.searchsorted(LENGTHS, [j - i for i, j in spans], "right") - 1
        np.add.at(tested, (owner, length), 1)
        for x in np.flatnonzero(level >= KEPT_BIN):
            likely[owner[x]].append((*spans[x], int(length[x]), int(level[x])))
    return base, likely, tested


def _scan(batches):
    for b in sliced(batches, 512):
        base, likely, tested = scan(b.column(1).to_pylist())
        spans = [[dict(zip(("start", "kind", "end"), x)) for x in found] for found in base]
        tokens = [[dict(zip(("start", "end", "length_class", "bin"), x)) for x in found] for found in likely]
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2), pa.array(spans, pa.list_(_SPAN)), pa.array(tokens, pa.list_(_TOKEN)), pa.array(tested.tolist(), pa.list_(pa.int64()))], ["doc_id", "digest", "base", "tokens", "tests"])


def _tally(batches):
    """tests and likely tokens of a task, counted by length class and bin (-1: all tests)."""
    counts: dict[tuple[int, int], int] = {}
    for b in sliced(batches, 512):
        _, likely, tested = scan(b.column(0).to_pylist())
        for found in likely:
            for _, _, c, level in found:
                counts[c, level] = counts.get((c, level), 0) + 1
        for c, n in enumerate(tested.sum(0).tolist()):
            counts[c, -1] = counts.get((c, -1), 0) + n
    rows = [(*k, n) for k, n in counts.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64()))], ["length_class", "bin", "n"])


def discovery_bins(counts: DataFrame, level: float) -> list[int]:
    """For each length class the least bin whose tokens are discoveries by Benjamini-Hochberg at this level; from columns
    length_class, bin (-1: the tests made) and n."""
    rows = {(r.length_class, r.bin): r.n for r in counts.groupBy("length_class", "bin").agg(F.sum("n").alias("n")).collect()}  # at most 5 * 401 rows
    out = []
    for c in range(len(LENGTHS)):
        least, above = LAST_BIN + 1, 0
        for b in range(LAST_BIN, KEPT_BIN - 1, -1):
            above += rows.get((c, b), 0)
            if above and rows.get((c, -1), 0) * 10 ** (-b / BINS_A_DECADE) / above <= level:
                least = b
        out.append(least)
    return out


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", level: float = LEVEL) -> DataFrame:
    """doc_id, digest (of the text), base and spans (arrays of start, kind number, end in code points, end exclusive, in
    order) of every row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("digest"))
    scanned = stored(rows.mapInArrow(_scan, SCANNED), "secrets")
    tests = scanned.select(F.posexplode("tests").alias("length_class", "n")).groupBy("length_class").agg(F.sum("n").alias("n")).select("length_class", F.lit(-1).alias("bin"), "n")
    found = scanned.select(F.explode("tokens").alias("t")).groupBy("t.length_class", "t.bin").agg(F.count("*").alias("n"))
    least = discovery_bins(tests.unionByName(found), level)
    bar = F.array(*map(F.lit, least))
    added = F.transform(F.filter("tokens", lambda t: t["bin"] >= F.get(bar, t["length_class"])), lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return scanned.select("doc_id", "digest", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]", level: float = LEVEL) -> DataFrame:
    """docs with every span of each row's own text replaced by the mark; all columns stay, and n_chars, where present,
    follows the text. One pass counts for the discovery bins, a second scans again and cuts; no row is shuffled."""
    counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_tally, "length_class int, bin int, n long")
    least = discovery_bins(counts, level)
    at, columns = docs.columns.index(text_col), docs.columns
    names = [f"c{i}" for i in range(len(columns))]
    length = columns.index("n_chars") if "n_chars" in columns else None

    def cut(batches):
        for b in sliced(batches, 512):
            texts = b.column(at).to_pylist()
            base, likely, _ = scan(texts)
            for k, (found, tokens) in enumerate(zip(base, likely)):
                spans = sorted([*found, *((i, 3, j) for i, j, c, x in tokens if x >= least[c])])
                if spans:
                    parts, end = [], 0
                    for i, _, j in spans:
                        if i >= end:
                            parts += [texts[k][end:i], mark]
                        end = max(end, j)
                    texts[k] = "".join(parts) + texts[k][end:]
            out = list(b.columns)
            out[at] = pa.array(texts, pa.string())
            if length is not None:
                out[length] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(b.column(length).type)
            yield pa.RecordBatch.from_arrays(out, names)

    # by place, for names may hold dots
    plain = docs.toDF(*names)
    return plain.mapInArrow(cut, plain.schema).toDF(*columns)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
