"""Encoding a corpus with a byte-level BPE vocabulary in linear time (problem 8).

A sequence of tokens is what BPE gives if and only if each neighbouring pair
is *compatible*: merging inside their joint bytes, in rank order, never crosses
their border. So no merges are replayed. An Aho-Corasick automaton gives the
longest token that starts at each byte; the encoder takes it if it is
compatible with its predecessor, else the next shorter prefix token, and steps
back where none fits; a byte position once left is never entered again, which
keeps the work linear. Decoding joins slices of one byte string by an offset
table.

Defined results: null and empty texts give an empty list of ids.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from folioloom.llm.arrow import local, map_rows

#: Where the vocabulary files lie on the driver; the executors get the tables from there.
TOKENIZERS = "/opt/tokenizers"
#: Fixed value: the public split pattern of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Remembered pieces in a worker; when full, it starts anew. Only speed depends on it.
MEMO = 1 << 16
#: Longer pieces aren't remembered: they rarely come again.
MEMO_CHARS = 24


@dataclass
class Vocabulary:
    """``blob[offsets[i]:offsets[i + 1]]`` are the bytes of token i; ``left``, ``right`` its last merge (itself, if none)."""

    blob: bytes
    offsets: np.ndarray
    left: np.ndarray
    right: np.ndarray


def load(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Vocabulary:
    """The tables of a rank file: each line has a token in base 64 and its id, which is its rank."""
    ranks = {}
    with open(f"{folder}/{name}.tiktoken", "rb") as f:
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tables(ranks)


def tables(ranks: dict[bytes, int]) -> Vocabulary:
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ids must be the ranks 0, 1, 2, ...")
    left, right = np.arange(len(tokens), dtype=np.int32), np.arange(len(tokens), dtype=np.int32)
    for i, token in enumerate(tokens):
        if len(token) > 1:
            parts = [token[k : k + 1] for k in range(len(token))]
            while len(parts) > 2:
                rank, k = min((ranks.get(parts[k] + parts[k + 1], i), k) for k in range(len(parts) - 1))
                if rank >= i:
                    raise ValueError(f"token {i} isn't made of lower ones")
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            left[i], right[i] = ranks[parts[0]], ranks[parts[1]]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    return Vocabulary(b"".join(tokens), offsets, left, right)


class Encoder:
    """Encodes and decodes with the tables of a vocabulary."""

    def __init__(self, v: Vocabulary):
        import ahocorasick
        import regex

        self.split = regex.compile(PATTERN)
        self.left, self.right = v.left.tolist(), v.right.tolist()
        ends = v.offsets.tolist()
        self.blob, self.ends = v.blob, ends
        self.length = [b - a for a, b in zip(ends, ends[1:], strict=False)]
        n = self.n = len(self.length)
        self.merged = {l * n + r: i for i, (l, r) in enumerate(zip(self.left, self.right, strict=True)) if l != i}
        # bytes as characters 0..255: the automaton works on strings
        keys = [v.blob[ends[i] : ends[i + 1]].decode("latin-1") for i in range(n)]
        ids = {k: i for i, k in enumerate(keys)}
        self.shorter = [next((ids[k[:m]] for m in range(len(k) - 1, 0, -1) if k[:m] in ids), -1) for k in keys]
        self.automaton = ahocorasick.Automaton()
        for i, k in enumerate(keys):
            self.automaton.add_word(k, i)
        self.automaton.make_automaton()
        self.fits: dict[int, bool] = {}
        self.memo: dict[str, list[int]] = {}

    def compatible(self, a: int, b: int) -> bool:
        """No merge of rank lower than those that made ``a`` and ``b`` crosses their border."""
        key = a * self.n + b
        known = self.fits.get(key)
        if known is not None:
            return known
        bound, fit = self.n, True
        while True:
            crossing = self.merged.get(a * self.n + b)
            if crossing is not None and crossing < bound:
                fit = False
                break
            # undo the later of the two merges: what it joined was apart before
            if a > b and self.left[a] != a or self.left[b] == b:
                if self.left[a] == a:
                    break
                bound, a = a, self.right[a]
            else:
                bound, b = b + 1, self.left[b]
        if len(self.fits) >= MEMO:
            self.fits.clear()
        self.fits[key] = fit
        return fit

    def piece(self, text: str) -> list[int]:
        """Ids of one piece that the pattern split off."""
        raw = text.encode().decode("latin-1")
        size, length, shorter = len(raw), self.length, self.shorter
        longest = [-1] * size
        for end, token in self.automaton.iter(raw):
            start = end + 1 - length[token]
            if longest[start] < 0 or length[token] > length[longest[start]]:
                longest[start] = token
        if longest[0] >= 0 and length[longest[0]] == size:
            return [longest[0]]
        open_ = [True] * (size + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            end = at + length[token]
            if open_[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < size:
                    token = longest[at]
                continue
            token = shorter[token]
            if token < 0:
                open_[at] = False
                token = out.pop()
                at -= length[token]
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        memo = self.memo
        for piece in self.split.findall(text or ""):
            ids = memo.get(piece)
            if ids is None:
                ids = self.piece(piece)
                if len(piece) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text again; bytes that are no whole character become U+FFFD."""
        return b"".join(self.blob[self.ends[i] : self.ends[i + 1]] for i in ids).decode("utf-8", "replace")


def encode(texts: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """(id, ids): the token ids of each text, without special tokens; one row per input row."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary or load())
    schema = T.StructType([T.StructField(id_col, texts.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def rows(columns: list[list]) -> Iterator[tuple]:
        coder = local(shared, Encoder)
        return ((i, coder.encode(t)) for i, t in zip(*columns, strict=True))

    return map_rows(texts, {"id": id_col, "text": text_col}, schema, rows)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: Vocabulary | None = None) -> DataFrame:
    """(id, text): the inverse of ``encode``; null ids give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(vocabulary or load())
    schema = T.StructType([T.StructField(id_col, tokens.schema[id_col].dataType), T.StructField("text", T.StringType())])

    def rows(columns: list[list]) -> Iterator[tuple]:
        coder = local(shared, Encoder)
        return ((i, None if t is None else coder.decode(t)) for i, t in zip(*columns, strict=True))

    return map_rows(tokens, {"id": id_col, "ids": ids_col}, schema, rows)


def count_tokens(texts: DataFrame, keep: list[str], text_col: str = "text", vocabulary: Vocabulary | None = None) -> DataFrame:
    """The kept columns and n_tokens, the number of ids of the text (0 for null)."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary or load())
    schema = T.StructType([texts.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType())])

    def rows(columns: list[list]) -> Iterator[tuple]:
        coder = local(shared, Encoder)
        return ((*r[:-1], len(coder.encode(r[-1]))) for r in zip(*columns, strict=True))

    return map_rows(texts, {**{c: c for c in keep}, "\x00text": text_col}, schema, rows)
