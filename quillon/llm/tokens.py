"""Tokenizing whole texts with a public byte-level vocabulary, one remembered piece at a time.

A space between two characters that are not white space always begins a new match of the byte-level pattern
(` ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`), and the pattern's matches never look back. The tokens of a
text are therefore the tokens of the pieces between such spaces, one after the other. Pieces repeat far more often than
texts: each Arrow batch is split and dictionary-encoded in C++, and the tokenizers library encodes only pieces that a
worker has not met yet. The memory of pieces is bounded.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_CLEAN = re.compile(r"(?<=\S) (?=\S)")
#: Texts with white space beside a space, or with white space other than space and line feed, take the slower split.
_ODD = "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|  | \\n|\\n "

CACHE_ENTRIES = 800_000
LONG_PIECE = 64
MARKS = frozenset(",.;:")


class _Pieces(dict):
    """piece -> ids of a space and the piece, as little-endian uint32 bytes."""

    def __init__(self, tokenizer, begins: np.ndarray):
        super().__init__()
        self.tokenizer, self.begins = tokenizer, begins
        self.marks = {m: self.alone(m) for m in MARKS}

    def alone(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        return self.alone(" " + piece)

    def all(self, pieces: list[str]) -> list[bytes]:
        out = list(map(self.get, pieces))
        if None in out:
            self.learn([p for p, x in zip(pieces, out) if x is None])
            out = [self[p] if x is None else x for p, x in zip(pieces, out)]
        return out

    def learn(self, new: list[str]) -> None:
        """Encode new pieces in one call: each begins at the only tokens of it that begin with a space."""
        new = [p for p in new if len(p) <= LONG_PIECE]
        if len(self) + len(new) > CACHE_ENTRIES:
            self.clear()
        # a word of letters and one closing mark are two matches of the pattern, each with its own tokens
        closed = [p for p in new if p[-1:] in MARKS and p[:-1].isalpha()]
        done = set(closed)
        wanted = [p for p in new if p and " " not in p and p not in done]
        known = set(wanted)
        wanted += [p for p in {p[:-1] for p in closed} if p not in self and p not in known]
        if wanted:
            ids = np.asarray(self.tokenizer.encode_batch_fast([" " + " ".join(wanted)], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(self.begins[ids])
            if len(at) == len(wanted):
                raw, ends = ids.tobytes(), (np.append(at[1:], len(ids)) * 4).tolist()
                for p, i, j in zip(wanted, (at * 4).tolist(), ends):
                    self[p] = raw[i:j]
            else:
                for p in wanted:
                    self[p] = self.alone(" " + p)
        for p in closed:
            self[p] = self[p[:-1]] + self.marks[p[-1]]


class Encoded:
    """A batch of texts as pieces: text k has the pieces texts[k]:texts[k + 1]; `n` and `chars` are a piece's tokens and
    characters (with the space before it); `ids` of piece j are flat[begin[j]:begin[j] + n[j]]."""

    def __init__(self, texts, n, chars, begin, flat):
        self.texts, self.n, self.chars, self.begin, self.flat = texts, n, chars, begin, flat

    def counts(self) -> np.ndarray:
        """Tokens of each text."""
        total = np.concatenate([[0], np.cumsum(self.n)])
        return total[self.texts[1:]] - total[self.texts[:-1]]

    def ids(self) -> np.ndarray:
        """The ids of all texts in a row."""
        total = np.cumsum(self.n)
        if not len(total):
            return np.zeros(0, "<u4")
        return self.flat[np.repeat(self.begin - total + self.n, self.n) + np.arange(total[-1])]


class ByteLevel:
    """The byte-level vocabulary; equal to the library's encode(text, add_special_tokens=False) for every text."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        begins = np.zeros(max(vocab.values()) + 1, bool)
        begins[[i for t, i in vocab.items() if t.startswith("Ġ")]] = True
        self.pieces = _Pieces(self.tokenizer, begins)

    def encode(self, texts: pa.Array) -> Encoded:
        """Null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        lists = pc.split_pattern(texts, " ")
        for k in np.flatnonzero(pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)):
            lists = None  # a few odd texts: split all of this batch text by text
            break
        if lists is None:
            lists = pa.array([_CLEAN.split(t) for t in texts.to_pylist()], pa.large_list(pa.large_string()))
        at = np.asarray(lists.offsets, np.int64)
        coded = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at = at - at[0]
        index = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = self.pieces.all(words)
        chars = np.array(list(map(len, words)), np.int64)[index] + 1
        # no space stands before a text's first piece
        first = [words[i] for i in index[at[:-1]].tolist()]
        index[at[:-1]] = len(words) + np.arange(len(first))
        chars[at[:-1]] -= 1
        found += [self.pieces.alone(p) if p else b"" for p in first]
        n = np.array(list(map(len, found)), np.int64) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        return Encoded(at, n[index], chars, (np.cumsum(n) - n)[index], flat)


@lru_cache(maxsize=4)
def _byte_level(digest: str, definition: str) -> ByteLevel:
    return ByteLevel(definition)


def byte_level(definition: str) -> ByteLevel:
    """One encoder for each definition and worker process."""
    return _byte_level(hashlib.md5(definition.encode()).hexdigest(), definition)


def vocabulary_path(name: str) -> str:
    """Where the installed public vocabulary file of this name is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def definition_of(path: str) -> str:
    """The vocabulary file, read once on the driver; tasks get its text (about 2 MB whatever the input)."""
    with open(path, encoding="utf-8") as f:
        return f.read()
