"""Token ids in directly addressable codes: any token can be read without decoding a block.

An id is cut into chunks of 8 bits. Level 0 holds every id's lowest chunk; a bitmap tells which ids continue; level 1
holds the next chunk of those only, and so on. A rank directory with the set bits before each block of 512 gives the
place of a continuing id in the next level, so token i is found with one look-up a level.

A file (`QDAC1`): magic, then as little-endian unsigned 64-bit numbers: documents, ids, levels; document ids (signed), a
byte each that is 1 for a null id, the places where documents begin (one more than documents); then for each level: its
length, chunks, bitmap (least bit first, padded to 8 bytes), rank directory (unsigned 64 bits a block, one more at the end).

Results for odd input: null and empty texts hold the end id alone; rows with equal doc_id follow each other by text; null
ids come first; an empty table gives no files and no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillon.llm._common import read, scratch, sliced, stored
from quillon.llm.files import attempt_name, make_folder, write_bytes
from quillon.llm.tokens import byte_level, definition_of, vocabulary_path

MAGIC = b"QDAC1\x00\x00\x00"
BLOCK = 512
FILE_IDS = 2_000_000
MANIFEST = "part int, number int, name string, n_docs long, n_ids long"


def _level(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    more = ids > 0xFF
    bits = np.packbits(more, bitorder="little")
    bits = np.pad(bits, (0, -len(bits) % 8))
    ones = np.concatenate([[0], np.cumsum(np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else [])]).astype("<u8")
    return struct.pack("<Q", len(ids)) + (ids & 0xFF).astype(np.uint8).tobytes() + bits.tobytes() + ones.tobytes(), ids[more] >> 8


def encode_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    levels, rest = [], ids.astype(np.uint32)
    while True:
        level, rest = _level(rest)
        levels.append(level)
        if not len(rest):
            break
    docs = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + np.array([d is None for d in doc_ids], np.uint8).tobytes()
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<u8").tobytes()
    return MAGIC + struct.pack("<QQQ", len(doc_ids), len(ids), len(levels)) + docs + starts + b"".join(levels)


class TokenFile:
    """A file's documents and tokens; `token(i)` reads one token, `tokens(i, j)` a range, both without decoding the rest."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a token file")
        n, self.n_ids, depth = struct.unpack_from("<QQQ", content, 8)
        at = 32
        values = np.frombuffer(content, "<i8", n, at)
        null = np.frombuffer(content, np.uint8, n, at + 8 * n)
        self.doc_ids = [None if x else d for d, x in zip(values.tolist(), null.tolist())]
        self.starts = np.frombuffer(content, "<u8", n + 1, at + 9 * n).astype(np.int64)
        at += 9 * n + 8 * (n + 1)
        self.levels = []
        for _ in range(depth):
            (m,) = struct.unpack_from("<Q", content, at)
            chunks = np.frombuffer(content, np.uint8, m, at + 8)
            at += 8 + m
            size = -(-m // 64) * 8
            bits = np.frombuffer(content, np.uint8, size, at)
            ranks = np.frombuffer(content, "<u8", -(-m // BLOCK) + 1, at + size)
            at += size + 8 * len(ranks)
            self.levels.append((chunks, bits, ranks))
        if len(self.levels[0][0]) != self.n_ids or self.starts[-1] != self.n_ids or at != len(content):
            raise ValueError("lengths in a token file disagree")

    def _rank(self, level: int, i: int) -> int:
        """Continuing ids before i in a level."""
        _, bits, ranks = self.levels[level]
        block = i // BLOCK
        part = np.unpackbits(bits[block * BLOCK // 8 : i // 8 + 1], bitorder="little")[: i - block * BLOCK]
        return int(ranks[block]) + int(part.sum())

    def token(self, i: int) -> int:
        value = 0
        for k, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[i]) << (8 * k)
            if not bits[i // 8] >> (i % 8) & 1:
                break
            i = self._rank(k, i)
        return value

    def tokens(self, i: int, j: int) -> np.ndarray:
        out = np.zeros(j - i, "<u4")
        at = np.arange(j - i)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks[i:j].astype(np.uint32) << (8 * k)
            more = np.unpackbits(bits[i // 8 : -(-j // 8)], bitorder="little")[i % 8 : i % 8 + j - i].astype(bool)
            at = at[more]
            if not len(at):
                break
            i = self._rank(k, i)
            j = i + len(at)
        return out


def _write(folder: str, definition: str, end_id: int, file_ids: int):
    def run(batches):
        coder, number = byte_level(definition), 0
        docs, lengths, held, n = [], [], [], 0

        def flush():
            nonlocal docs, lengths, held, n, number
            name = attempt_name("ids", number, "qdac")
            write_bytes(folder, name, encode_file(docs, np.concatenate(lengths), np.concatenate(held)))
            from pyspark import TaskContext

            row = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((TaskContext.get().partitionId(), number, name, len(docs), n), (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["part", "number", "name", "n_docs", "n_ids"])
            docs, lengths, held, n, number = [], [], [], 0, number + 1
            return row

        for b in sliced(batches, 1024):
            coded = coder.encode(b.column(1))
            counts = coded.counts()
            ids = np.insert(coded.ids(), np.cumsum(counts), end_id)
            docs += b.column(0).to_pylist()
            lengths.append(counts + 1)
            held.append(ids)
            n += len(ids)
            if n >= file_ids:
                yield flush()
        if docs:
            yield flush()

    return run


def write_token_files(docs: DataFrame, folder: str, definition: str, *, end_id: int, id_col: str = "doc_id", text_col: str = "text", file_ids: int = FILE_IDS) -> DataFrame:
    """Write the ids of all texts, each closed by end_id, in ascending id order; returns the manifest with each file's start.

    The order comes from range partitioning, so that no task holds more than its share; a task closes a file after file_ids.
    """
    make_folder(folder)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    manifest = stored(ordered.mapInArrow(_write(folder, definition, end_id, file_ids), MANIFEST), "manifest")
    before = F.sum("n_ids").over(Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))  # a row a file, not a row a document


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files that the manifest names.

    Each document is read by itself at its place, and its last token once more alone."""
    kind = "name string, content binary, start long"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.qdac").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")

    def run(batches):
        for b in batches:
            for content, start in zip(b.column(1), b.column(2).to_pylist()):
                f = TokenFile(content.as_py())
                at, crc = f.starts.tolist(), []
                for i, j in zip(at, at[1:]):
                    ids = f.tokens(i, j)  # the rank directories lead to the document; nothing else of the file is decoded
                    if j > i and f.token(j - 1) != ids[-1]:
                        raise ValueError(f"token {j - 1} read alone differs")
                    crc.append(zlib.crc32(ids.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(f.doc_ids, pa.int64()), pa.array(f.starts[:-1] + start, pa.int64()), pa.array(np.diff(f.starts), pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.join(manifest.select("name", "start"), "name").select(*(c.split()[0] for c in kind.split(", "))).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "token-files")
    manifest = write_token_files(read(spark, sf_dir, "documents"), folder, definition_of(vocabulary_path("byte_bpe_50k.json")), end_id=2)
    return read_token_files(spark, folder, manifest)
