"""Exact byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

The vocabulary is a tokenizers file of the kind `word_bpe_49k.json`: text is brought to NFC, white space is dropped,
letters are lower-cased, the rest is split into words, and the last symbol of a word carries the word-end mark. A word's
bytes become symbols (the last byte a symbol of its own kind), so that every token is a string over 512 symbols.

A word is encoded left to right without merging: an Aho-Corasick automaton of all tokens gives the longest token at each
place; the next token must be compatible with the one before, that is, the pair alone would be encoded as just these two.
If it is not, the longest shorter prefix that is a token is tried; if none is left, the last token is taken back. Places
found to lead nowhere are marked, so no place is extended twice with the same token and the time is linear in the word.
Pair compatibility is found by undoing merges along the seam and is remembered in a bounded table.

Decoding looks up each id's place in one array of bytes: the tokens as written in the vocabulary, joined by a space.

Results for odd input: null counts as empty; empty text has no ids and decodes to empty; special tokens that occur in a
text become their ids; repeated rows and null ids each give a row; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.llm._common import read, sliced
from quillon.llm.tokens import definition_of, vocabulary_path

CACHE_ENTRIES = 250_000
PAIRS = 1_000_000
LONG_PIECE = 64
#: White space of the vocabulary's pattern (Unicode White_Space); Python's split() would add U+001C to U+001F.
_SPACE = re.compile("[\t\n\x0b\x0c\r \x85\xa0  -     　]+")
_UNLIKE = re.compile("[\x1c-\x1f]")
#: Text beyond Latin letters is normalised and split by the library, whose Unicode tables may be of another version.
_BEYOND_LATIN = re.compile("[^\x00-\u024f\u1e00-\u1eff\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


class WordBPE:
    def __init__(self, definition: str):
        import ahocorasick
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(definition)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = self.byte_of = {c: b for b, c in enumerate(byte_symbols())}
        pair = lambda m: tuple(m) if isinstance(m, list) else tuple(m.split(" "))
        merges = [pair(m) for m in model["merges"]]

        def symbols(token: str) -> str:
            """A token as a string over chr(byte), and chr(256 + byte) for a word's last."""
            last = token.endswith(self.end) and token not in byte_of
            body = [byte_of[c] for c in (token[: -len(self.end)] if last else token)]
            return "".join(chr(b + 256 * (last and i == len(body) - 1)) for i, b in enumerate(body))

        # rank order: single symbols first, then merges as listed
        made = {a + b: r for r, (a, b) in enumerate(merges)}
        singles = [t for t in vocab if t not in made and t not in self.special and len(symbols(t)) == 1]
        self.rank_tokens = singles + [a + b for a, b in merges]
        rank = {t: r for r, t in enumerate(self.rank_tokens)}
        if len(rank) != len(self.rank_tokens):
            raise ValueError("a token of this vocabulary has two merges")
        self.ids = [vocab[t] for t in self.rank_tokens]
        self.parts = [(r, r) for r in range(len(singles))] + [(rank[a], rank[b]) for a, b in merges]
        self.merged = {p: r for r, p in enumerate(self.parts) if r >= len(singles)}
        strings = [symbols(t) for t in self.rank_tokens]
        self.length = list(map(len, strings))
        by_string = {s: r for r, s in enumerate(strings)}
        self.shorter = []
        for s in strings:
            n = next((n for n in range(len(s) - 1, 0, -1) if s[:n] in by_string), 0)
            self.shorter.append(by_string[s[:n]] if n else -1)
        self.automaton = ahocorasick.Automaton()
        for s, r in by_string.items():
            self.automaton.add_word(s, r)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # the offset table: each token as written, and a space
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        written = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(written), np.uint8)
        self.offset = np.concatenate([[0], np.cumsum(list(map(len, written)))])

    def compatible(self, a: int, b: int) -> bool:
        """Whether the tokens a, b in a row are what merging their joined symbols would give.

        Undo the later of the two merges that touch the seam, step by step: at every step a merge across the seam that
        comes before all those undone so far would have been made first, and the pair would not stand."""
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        x, y, limit, answer = a, b, len(self.parts), None
        while answer is None:
            across = self.merged.get((x, y))
            if across is not None and across < limit:
                answer = False
            elif x > y or self.parts[y][0] == y:
                if self.parts[x][1] == x and self.parts[x][0] == x:
                    if self.parts[y][0] == y and self.parts[y][1] == y:
                        answer = True
                    else:
                        limit, y = y + 1, self.parts[y][0]
                else:
                    limit, x = x, self.parts[x][1]
            else:
                limit, y = y + 1, self.parts[y][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[a, b] = answer
        return answer

    def encode_word(self, raw: bytes) -> list[int]:
        """Ids of one word (its bytes)."""
        text = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
        n = len(text)
        longest = [-1] * (n + 1)
        length = self.length
        for end, r in self.automaton.iter(text):
            start = end + 1 - length[r]
            if longest[start] < 0 or length[longest[start]] < length[r]:
                longest[start] = r
        out: list[int] = []
        open_ = [True] * (n + 1)
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                to = at + length[token]
                if open_[to] and (not out or self.compatible(out[-1], token)):
                    out.append(token)
                    at, token = to, longest[to]
                    break
                token = self.shorter[token]
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a symbol")
                open_[at] = False
                token = out.pop()
                at -= length[token]
        return [self.ids[r] for r in out]

    def _word(self, word: bytes) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            ids = np.array(self.encode_word(word), "<u4").tobytes()
            if len(word) <= LONG_PIECE:
                if len(self.words) >= CACHE_ENTRIES:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        return b"".join([self._word(w.encode("utf-8", "surrogatepass")) for w in self.pattern.findall(piece)])

    def _segment(self, text: str) -> bytes:
        if _BEYOND_LATIN.search(text):
            words = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(text))
            return b"".join([self._word(bytes(map(self.byte_of.__getitem__, w))) for w, _ in words])
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.lower()
        parts = _SPACE.split(text) if _UNLIKE.search(text) else text.split()
        found = list(map(self.pieces.get, parts))
        if None in found:
            for k, x in enumerate(found):
                if x is None:
                    found[k] = self._piece(parts[k])
                    if len(parts[k]) <= LONG_PIECE:
                        if len(self.pieces) >= CACHE_ENTRIES:
                            self.pieces.clear()
                        self.pieces[parts[k]] = found[k]
        return b"".join(found)

    def encode(self, text: str | None) -> np.ndarray:
        """All ids of a text."""
        if not text:
            return np.zeros(0, "<u4")
        if self.special_split and any(s in text for s in self.special):
            parts = self.special_split.split(text)
            got = b"".join(np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._segment(p) for p in parts if p)
        else:
            got = self._segment(text)
        return np.frombuffer(got, "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids as UTF-8: the tokens as written, joined by one space."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        begin, size = self.offset[ids], self.offset[ids + 1] - self.offset[ids]
        total = np.cumsum(size)
        return self.blob[np.repeat(begin - total + size, size) + np.arange(total[-1])].tobytes()[:-1]


@lru_cache(maxsize=4)
def _word_bpe(digest: str, definition: str) -> WordBPE:
    return WordBPE(definition)


def word_bpe(definition: str) -> WordBPE:
    """One coder for each definition and worker process."""
    return _word_bpe(hashlib.md5(definition.encode()).hexdigest(), definition)


def encode_documents(docs: DataFrame, definition: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row."""

    def run(batches):
        coder = word_bpe(definition)
        for b in sliced(batches, 128):
            ids = [coder.encode(t) for t in b.column(1).to_pylist()]
            at = np.concatenate([[0], np.cumsum(list(map(len, ids)))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.ListArray.from_arrays(at, np.concatenate([np.zeros(0, "<u4"), *ids]).astype(np.int32))], ["doc_id", "ids"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, definition: str) -> DataFrame:
    """doc_id and text of every row of ids."""

    def run(batches):
        coder = word_bpe(definition)
        for b in sliced(batches, 128):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([coder.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, definition: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by a space) and of the text decoded from them."""

    def run(batches):
        coder = word_bpe(definition)
        decimal = [str(i) for i in range(len(coder.offset) - 1)]
        for b in sliced(batches, 256):
            n, a, t = [], [], []
            for text in b.column(1).to_pylist():
                ids = coder.encode(text)
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids.tolist())).encode()).hexdigest())
                t.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(t, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"), definition_of(vocabulary_path("word_bpe_49k.json")))
