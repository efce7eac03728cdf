"""BPE encoding and decoding by dynamic programming over prefixes (operator 13).

A text's pieces (matches of the byte-level pattern, and special tokens, which
are found first) are encoded one by one. In a piece every prefix has exactly
one encoding and so exactly one last token:

* an Aho-Corasick automaton over the vocabulary lists, for each position, the
  tokens that end there (its suffix links lead from a match to the next shorter
  one);
* a token t may close the prefix if it can stand behind the last token s of the
  prefix it starts from: merging s and t's bytes must give (s, t) again. That is
  a test of two spines: the tokens that were the right edge of s and the left
  edge of t while they were merged, each with the rank that ended it. A merge
  across the border that comes before either edge is used up forbids the pair;
* the one token that passes is stored for the prefix; following the stored
  tokens back from the end gives the ids.

Linear in a piece's matches, whatever its length. Each distinct piece is
encoded once and remembered as packed ids (MEMO pieces a worker, then the
memory is emptied). Decoding joins the ids' bytes and replaces what is no
UTF-8, as the library's byte-level decoder does.

Edge cases: a null or empty text has no ids and decodes to the empty text;
texts and pieces of any length are encoded whole; other columns of any name are
untouched; empty tables give empty results; repeated rows are encoded like any
other; null ids in a list to decode are left out, unknown ids raise.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .op6_bpe import byte_alphabet
from .textscan import slices

VOCABULARY = "byte_bpe_50k.json"
MEMO = 500_000
PAIRS = 1_000_000
SLICE = 1 << 19
NEVER = 1 << 62
_LOADED: dict = {}


class PrefixCodec:
    """One vocabulary file of the ``tokenizers`` format (byte-level BPE)."""

    def __init__(self, path: str):
        import ahocorasick
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = size = max([*vocab.values(), *self.special.values()]) + 1
        self.rank = [-1] * size
        self.halves: list[tuple[int, int] | None] = [None] * size
        self.merged: dict[tuple[int, int], int] = {}
        for r, (a, b) in enumerate(merges):
            pair, made = (vocab[a], vocab[b]), vocab[a + b]
            self.rank[made], self.halves[made], self.merged[pair] = r, pair, r
        self.bytes_of = [b""] * size
        self.automaton = ahocorasick.Automaton()
        for token, i in vocab.items():
            raw = bytes(byte[c] for c in token)
            self.bytes_of[i] = raw
            if len(raw) == 1 or self.halves[i] is not None and self.stands_alone(i):
                self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.lengths = np.array([len(b) for b in self.bytes_of], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.all_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.pairs: dict[int, bool] = {}  # left * size + right
        self.memo: dict[str, bytes] = {}
        self.assigned: set[str] = set()

    # --- pair compatibility ------------------------------------------------------

    def _edge(self, token: int, side: int, until: int) -> list[tuple[int, int]]:
        """The tokens that were this edge of ``token``, and the rank of the
        merge that ended each (``until`` for the token itself)."""
        out = [(token, until)]
        while (halves := self.halves[token]) is not None:
            out.append((halves[side], self.rank[token]))
            token = halves[side]
        return out

    def _border_holds(self, left: int, right: int, until: int) -> bool:
        """No merge across the border of ``left`` and ``right`` comes before
        the merges that build them (nor before rank ``until``). Of equal ranks
        the one further left comes first."""
        merged = self.merged
        right_edge = self._edge(right, 0, until)
        for a, a_until in self._edge(left, 1, until):
            for b, b_until in right_edge:
                rank = merged.get((a, b))
                if rank is not None and rank < a_until and rank <= b_until and rank < until:
                    return False
        return True

    def stands_alone(self, token: int) -> bool:
        """The token's own bytes are encoded as this one token."""
        halves = self.halves[token]
        return halves is None or (
            self.stands_alone(halves[0]) and self.stands_alone(halves[1])
            and self._border_holds(*halves, self.rank[token]))

    def compatible(self, left: int, right: int) -> bool:
        """``right`` can stand behind ``left`` (remembered, PAIRS at most)."""
        if len(self.pairs) > PAIRS:
            self.pairs.clear()
        held = self.pairs[left * self.size + right] = self._border_holds(left, right, NEVER)
        return held

    # --- encoding ------------------------------------------------------------------

    def piece_ids(self, piece: str) -> list[int]:
        raw = piece.encode().decode("latin-1")
        size, known = self.size, self.pairs.get
        last, width = [-1] * (len(raw) + 1), [0] * (len(raw) + 1)
        for end, (token, length) in self.automaton.iter(raw):
            end += 1
            if last[end] >= 0:
                continue
            start = end - length
            if start:
                held = known(last[start] * size + token)
                if held is None:
                    held = self.compatible(last[start], token)
                if not held:
                    continue
            last[end], width[end] = token, length
        ids, at = [], len(raw)
        while at:
            ids.append(last[at])
            at -= width[at]
        ids.reverse()
        return ids

    def _unsure(self, pieces: set[str]) -> bool:
        """The library's pattern engine and ``regex`` know different versions
        of Unicode: some of the characters that Python's tables call unassigned
        are letters or digits to one of them only."""
        letters = set("".join(pieces))
        new = letters - self.assigned
        self.assigned |= {c for c in new if unicodedata.category(c) != "Cn"}
        return not letters <= self.assigned

    def _pieces(self, text: str) -> list[bytes]:
        """Packed ids of the pattern's matches. A text with a character that
        may be read differently is split by the library and not remembered
        (so such a character is always found among the new pieces)."""
        memo = self.memo
        pieces = self.pattern.findall(text)
        packed = list(map(memo.get, pieces))
        if None not in packed:
            return packed
        new = {p for p, ids in zip(pieces, packed) if ids is None}
        if self._unsure(new):
            spans = [o for _, o in self.splitter.pre_tokenize_str(text)]
            return [struct.pack(f"<{len(ids)}I", *ids) for ids in (self.piece_ids(text[a:b]) for a, b in spans)]
        for piece in new:
            ids = self.piece_ids(piece)
            memo[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return list(map(memo.get, pieces))

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        out = []
        for n, part in enumerate(self.specials.split(text) if self.special else [text]):
            if n % 2:
                out.append(struct.pack("<I", self.special[part]))
            else:
                out += self._pieces(part)
        return b"".join(out)

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1])
        return self.all_bytes[at].tobytes().decode("utf-8", "replace")


def codec(name: str = VOCABULARY) -> PrefixCodec:
    """Built once per Python worker. ``name``: a vocabulary of the installed
    public tokenizers, or a path."""
    if name not in _LOADED:
        import public_tokenizers
        _LOADED[name] = PrefixCodec(name if os.path.isabs(name) else public_tokenizers.path(name))
    return _LOADED[name]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ids (array<int>)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in slices(batches, 1, SLICE):
            ids = [np.frombuffer(use.encode(t or ""), "<i4") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row (doc_id, ids): doc_id, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in batches:
            texts = [use.decode([i for i in ids or [] if i is not None]) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def round_trips(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256 (of the decoded
    text in UTF-8): ``encode`` and ``decode`` in one pass, batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in slices(batches, 1, SLICE):
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                packed = use.encode(text or "")
                counts.append(len(packed) // 4)
                of_ids.append(hashlib.sha256(packed).hexdigest())
                of_text.append(hashlib.sha256(use.decode(np.frombuffer(packed, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))
