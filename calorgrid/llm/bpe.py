"""Byte-pair encoding of a corpus by a public tokenizer, in linear time.

Bytes are mapped to Latin-1 letters, so that one automaton over letters finds every vocabulary token that begins at each
position. An encoding is built from the longest tokens on; a token may follow another only if merging the two tokens'
letters anew would give the same pair, which is memoised for adjacent tokens. Where no token fits, the last one is taken
back and replaced by the next shorter one; a position found hopeless is not tried again.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterable

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_FILE = "byte_bpe_50k.json"
#: fixed values: how byte-level vocabularies part a text before merging
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_file(name: str = DEFAULT_FILE, folder: str | None = None) -> str:
    """Path of a public tokenizer's file: in ``folder``, else where the installed package says, else /opt/tokenizers."""
    if folder is None:
        try:
            return importlib.import_module("public_tokenizers").path(name)
        except ImportError:
            folder = "/opt/tokenizers"
    return os.path.join(folder, name)


def _letters_to_bytes() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Encoder of one vocabulary file (JSON with ``model.vocab`` and ``model.merges``); special tokens are not known."""

    def __init__(self, path: str, remembered: int = 200_000):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        back = _letters_to_bytes()
        latin = lambda t: bytes(back[c] for c in t).decode("latin-1")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = {t: i for t, i in model["vocab"].items() if all(c in back for c in t)}
        parts = {}
        for a, b in merges:
            parts.setdefault(a + b, (a, b))
        # merges are compared by the numbers of what they make
        made = [model["vocab"][t] for t in parts]
        if any(x >= y for x, y in zip(made, made[1:])):
            raise ValueError("the tokens' numbers don't rise with the merges")
        vocab = {t: i for t, i in vocab.items() if len(t) == 1 or t in parts}
        size = max(vocab.values()) + 1
        self.length, self.shorter, self.halves = [0] * size, [-1] * size, [(-1, -1)] * size
        self.joined: dict[tuple[int, int], int] = {}
        self.finder = ahocorasick.Automaton()
        names = {}
        for t, i in vocab.items():
            names[latin(t)] = i
            self.length[i] = len(t)
            self.halves[i] = (i, i)
            if t in parts:
                a, b = parts[t]
                self.halves[i] = (vocab[a], vocab[b])
                self.joined[vocab[a], vocab[b]] = i
        for t, i in names.items():
            self.finder.add_word(t, i)
            self.shorter[i] = next((names[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in names), -1)
        self.finder.make_automaton()
        self.pieces = regex.compile(PIECES)
        self.known: dict[str, list[int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.remembered = remembered

    def _fit(self, left: int, right: int) -> bool:
        """True if encoding the letters of both tokens anew gives these two.

        The merges that made them are undone from the latest on; at no point may a merge across the seam come before."""
        bound = 1 << 62
        while True:
            across = self.joined.get((left, right))
            if across is not None and across < bound:
                return False
            outer, inner = (left, self.halves[left][1]), (right, self.halves[right][0])
            if outer[0] == outer[1] and inner[0] == inner[1]:
                return True
            if inner[0] == inner[1] or (left > right and outer[0] != outer[1]):
                bound, left = left, outer[1]
            else:
                bound, right = right + 1, inner[1]

    def fit(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= 4 * self.remembered:
                self.fits.clear()
            known = self.fits[key] = self._fit(left, right)
        return known

    def encode_piece(self, piece: str) -> list[int]:
        s = piece.encode("utf-8").decode("latin-1")
        n, length, shorter = len(s), self.length, self.shorter
        longest, reach = [-1] * n, [0] * n
        for end, token in self.finder.iter(s):
            size = length[token]
            if size > reach[end + 1 - size]:
                reach[end + 1 - size], longest[end + 1 - size] = size, token
        hopeless = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while True:
            if token < 0:
                hopeless[at] = 1
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                continue
            end = at + length[token]
            if not hopeless[end] and (not out or self.fit(out[-1], token)):
                out.append(token)
                if end == n:
                    return out
                at, token = end, longest[end]
            else:
                token = shorter[token]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; an empty and a null text have none."""
        ids: list[int] = []
        known = self.known
        for piece in self.pieces.findall(text or ""):
            got = known.get(piece)
            if got is None:
                got = self.encode_piece(piece)
                if len(piece) <= 48:
                    if len(known) >= self.remembered:
                        known.clear()
                    known[piece] = got
            ids += got
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a file, built once in a process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode_all(texts: Iterable[str | None], path: str) -> list[list[int]]:
    e = encoder(path)
    return [e.encode(t) for t in texts]


def token_ids(df: DataFrame, text: str = "text", path: str | None = None, name: str = "ids") -> DataFrame:
    """``df`` with the ids of ``text`` (array of int) as column ``name``; every worker reads the file at ``path``."""
    file = path or tokenizer_file()

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(encode_all(texts, file), dtype=object)

    return df.withColumn(name, ids(F.col(text)))


def token_counts(df: DataFrame, text: str = "text", path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """``df`` with the number of tokens of ``text`` as column ``name``; 0 for an empty or null text."""
    file = path or tokenizer_file()

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        e = encoder(file)
        return pd.Series([len(e.encode(t)) for t in texts], dtype="int32")

    return df.withColumn(name, count(F.col(text)))
