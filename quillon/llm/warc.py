"""WARC archives in Zstandard with a shared dictionary, one frame a record.

An archive (`.warc.zst`) begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary, itself compressed;
then each record is one frame, compressed with it, so any record can be read alone. The reader loads the dictionary from
the leading frame, decodes frame by frame and checks each record: version line, required and well-formed headers, declared
length against the block, the closing blank lines, and payload digests of responses.

Of pages with equal payloads of at least `least` bytes the one with the largest page_id is the response and the others
are revisits that refer to it. Digests are grouped with a partial maximum before the shuffle; only digests that occur more
than once are joined back, each SALTS times, so the rows of a payload shared by a third of all pages go to many tasks.

Results for odd input: null html is an empty payload; pages without an id are written with an empty id and stay null, and
they are revisits where a page of the same payload has an id; of rows that repeat the largest id of a payload the one with
the least url is the response and the others revisit it, so each payload has one response; where no page of a payload has an
id, one is the response and the others revisit it with a null reference; null urls are written as `urn:page:<id>`; an empty
table gives no archives and no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, scratch, sliced, stored
from quillon.llm.files import attempt_name, make_folder, write_bytes

MAGIC = struct.pack("<I", 0x184D2A5D)
ARCHIVE_BYTES = 16 << 20
DICTIONARY_BYTES, DICTIONARY_SAMPLE = 64 << 10, 400
#: Bytes given to the decoder at once, and the parts into which the rows of each repeated payload are dealt.
STEP, SALTS = 8 << 10, 32
DATE = "2024-01-01T00:00:00Z"
_HEADER = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+):[ \t]*(.*)")
REQUIRED = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "Content-Length")


class WarcError(ValueError):
    """An archive or record that does not keep to the format."""


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one decoded record, or WarcError."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not sep or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise WarcError("no version line or no end of headers")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        m = _HEADER.fullmatch(line)
        if not m or m[1].decode() in headers:
            raise WarcError(f"bad header line: {line[:80]!r}")
        headers[m[1].decode()] = m[2].decode("utf-8")
    if missing := [k for k in REQUIRED if k not in headers]:
        raise WarcError(f"headers missing: {missing}")
    if not headers["Content-Length"].isascii() or not headers["Content-Length"].isdigit():
        raise WarcError("bad Content-Length")
    size = int(headers["Content-Length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise WarcError(f"declared length {size}, found {len(rest) - 4}")
    return headers, rest[:size]


def dictionary_frame(dictionary: bytes) -> bytes:
    import zstandard

    body = zstandard.ZstdCompressor(level=3).compress(dictionary)
    return MAGIC + struct.pack("<I", len(body)) + body


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive."""
    import zstandard

    if content[:4] != MAGIC or len(content) < 8:
        raise WarcError("no dictionary frame leads the archive")
    (size,) = struct.unpack_from("<I", content, 4)
    if len(content) < 8 + size:
        raise WarcError("the dictionary frame is cut off")
    body = content[8 : 8 + size]
    if body[:4] == b"\x28\xb5\x2f\xfd":
        body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body) if body else None)
    view, at = memoryview(content), 8 + size
    while at < len(view):
        # fed in steps, so that what follows a frame is copied a step at most
        one, parts = frames.decompressobj(), []
        try:
            while not one.eof and at < len(view):
                parts.append(one.decompress(view[at : at + STEP]))
                at += min(STEP, len(view) - at)
        except zstandard.ZstdError as e:
            raise WarcError(f"bad frame: {e}") from e
        if not one.eof:
            raise WarcError("the last frame is cut off")
        at -= len(one.unused_data)
        yield parse_record(b"".join(parts))


def train_dictionary(pages: DataFrame, html_col: str) -> bytes:
    """A dictionary from at most DICTIONARY_SAMPLE different payloads (those with the least hash, 64 KB of each), trained in
    one task; empty if there are too few. It changes how well records compress and nothing else."""

    def run(table):
        import zstandard

        samples = [x.encode("utf-8", "replace")[: 64 << 10] for x in table.column("html").to_pylist()]
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
        except zstandard.ZstdError:
            trained = b""
        return pa.table({"dictionary": pa.array([trained], pa.binary())})

    hashed = pages.filter(F.length(html_col) > 0).select(F.xxhash64(html_col).alias("h"), F.substring(html_col, 1, 64 << 10).alias("html"))
    # the hashes alone are ordered; then the texts that have them are fetched, one a hash
    least = [r.h for r in hashed.select("h").distinct().orderBy("h").limit(DICTIONARY_SAMPLE).collect()]
    if not least:
        return b""
    drawn = hashed.filter(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html"))
    got = drawn.orderBy("h").select("html").groupBy().applyInArrow(run, "dictionary binary").first()
    return bytes(got.dictionary) if got else b""


def _headers(page_id, url, kind: str, digest: str, refers) -> list[tuple[str, str]]:
    name = "" if page_id is None else str(page_id)
    clean = re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url is not None else f"urn:page:{name}"
    out = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}:{kind}>"), ("WARC-Date", DATE), ("WARC-Target-URI", clean), ("X-Page-ID", name), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "text/html")]
    if kind == "revisit":
        refers = "" if refers is None else refers
        out += [("WARC-Refers-To", f"<urn:page:{refers}:response>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return out


def _write(folder: str, dictionary: bytes, archive_bytes: int):
    def run(batches):
        import zstandard

        coder = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        lead = dictionary_frame(dictionary)
        held, size, n, number = [lead], len(lead), 0, 0

        def flush():
            nonlocal held, size, n, number
            name = attempt_name("pages", number, "warc.zst")
            write_bytes(folder, name, b"".join(held))
            row = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], ["name", "records"])
            held, size, n, number = [lead], len(lead), 0, number + 1
            return row

        for b in sliced(batches, 128):
            for page_id, url, payload, digest, kind, refers in zip(*(c.to_pylist() for c in b.columns)):
                headers = _headers(page_id, url, kind, digest, refers)
                # a revisit keeps no payload, only its length
                block = payload if kind == "response" else b""
                if kind == "revisit":
                    headers.append(("X-Payload-Length", str(len(payload))))
                frame = coder.compress(record_bytes(headers, block))
                held.append(frame)
                size, n = size + len(frame), n + 1
                if size >= archive_bytes:
                    yield flush()
        if n:
            yield flush()

    return run


def described(pages: DataFrame, *, id_col: str, html_col: str, url_col: str = "url", least: int) -> DataFrame:
    """page_id, url, payload (binary), sha1, record_type and refers_to of every page."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumn("sha1", F.sha1("payload"))
    slim = rows.filter(F.octet_length("payload") >= least).groupBy("sha1", "page_id").agg(F.count("*").alias("n"), F.min(F.struct(F.col("url").isNotNull(), "url")).alias("first"))
    # nulls are the least in a struct, so the largest id wins over none
    top = F.max(F.struct("page_id", "n", "first")).alias("top")
    shared = slim.groupBy("sha1").agg(F.sum("n").alias("copies"), top).filter("copies > 1").select("sha1", F.col("top.page_id").alias("top"), (F.col("top.n") > 1).alias("repeated"), F.col("top.first.url").alias("first"))
    shared = stored(shared, "repeated-payloads")
    salted = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["sha1", "salt"], "left")
    is_shared = F.col("repeated").isNotNull() & (F.octet_length("payload") >= least)
    leads = F.col("page_id").eqNullSafe(F.col("top"))
    kind = F.when(is_shared & ~leads, "revisit").when(is_shared & F.col("repeated") & ~F.col("url").eqNullSafe(F.col("first")), "revisit").otherwise("response")
    names = ["page_id", "url", "payload", "sha1", "record_type", "refers_to"]
    marked = joined.withColumn("record_type", kind).withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("top")))
    if shared.filter("repeated").isEmpty():
        return marked.select(*names)
    # rows equal in payload, id and url: the first is the response, the rest revisit it
    twins = is_shared & F.col("repeated") & (F.col("record_type") == "response")
    marked = marked.withColumn("twins", F.coalesce(twins, F.lit(False)))
    counted = marked.filter("twins").groupBy("page_id", "url", "payload", "sha1").agg(F.count("*").alias("n")).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    again = counted.withColumn("record_type", F.when(F.col("i") == 1, "response").otherwise("revisit")).withColumn("refers_to", F.when(F.col("i") > 1, F.col("page_id")))
    return marked.filter(~F.col("twins")).select(*names).unionByName(again.select(*names))


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", html_col: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each page; returns the manifest (name, records) of the archives."""
    make_folder(folder)
    dictionary = train_dictionary(pages, html_col)

    def digest(batches):
        for b in sliced(batches, 1024):
            text = pa.array([base64.b32encode(bytes.fromhex(x)).decode() for x in b.column(3).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], text, *b.columns[4:]], [*b.schema.names[:3], "payload_digest", *b.schema.names[4:]])

    rows = described(pages, id_col=id_col, html_col=html_col, least=least)
    rows = rows.mapInArrow(digest, "page_id long, url string, payload binary, payload_digest string, record_type string, refers_to long")
    return stored(rows.mapInArrow(_write(folder, dictionary, archive_bytes), "name string, records long"), "archives")


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and html of each record; html of responses only."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")

    def run(batches):
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "html")
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        for b in batches:
            for content, expected in zip(b.column(0), b.column(1).to_pylist()):
                rows, n = [], 0
                for h, block in read_archive(content.as_py()):
                    kind, digest = h["WARC-Type"], h["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest32(block) != digest:
                        raise WarcError(f"payload of page {h['X-Page-ID']} does not match its digest")
                    refers = re.fullmatch(r"<urn:page:(-?\d+):response>", h.get("WARC-Refers-To", ""))
                    size = len(block) if kind == "response" else int(h["X-Payload-Length"])
                    rows.append((int(h["X-Page-ID"]) if h["X-Page-ID"] else None, h["WARC-Target-URI"], size, digest, kind, int(refers[1]) if refers else None, block.decode() if kind == "response" else None))
                    n += 1
                    if len(rows) == 512:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows = []
                if n != expected:
                    raise WarcError(f"{n} records, {expected} expected")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, html string"
    return files.join(manifest, "name").select("content", "records").mapInArrow(run, schema)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "warc")
    manifest = write_archives(read(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
