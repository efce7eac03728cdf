"""Byte-level BPE encoding and decoding (operator 6).

``mapInArrow`` over batches of whole texts: the pattern splits, the
``tokenizers`` library merges by the ranks, each distinct piece once; the rank
file becomes its vocabulary (bytes written as the byte-level alphabet's
characters) and its merge list (all splits of a token into two tokens, by the
token's rank). Decoding goes through a table of each id's bytes, so characters
split between tokens come back whole. Offsets are the tokens' byte ranges, mapped
to characters by counting the bytes that begin one; a character split between
tokens belongs to all of them.

Edge cases: a null or empty text has no ids and decodes to nothing; text of
any length is encoded whole; other columns of any name are untouched; empty
tables give empty results; repeated rows are encoded like any other.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .textscan import slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
MEMO = 100_000
SLICE = 1 << 19
_LOADED: dict = {}


def byte_alphabet() -> list[str]:
    """Character of each byte: printable Latin-1 stands for itself, the other
    bytes take the code points from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table_ = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table_:
            table_[b] = chr(256 + len(table_) - len(plain))
    return [table_[b] for b in range(256)]


class Codec:
    """One vocabulary: encode texts to ids and character offsets, decode ids."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        from public_tokenizers import PATTERN

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        letters = byte_alphabet()
        name = {t: "".join(letters[b] for b in t) for t in ranks}
        merges = []
        for t, _ in sorted(ranks.items(), key=lambda x: x[1]):
            halves = [(t[:i], t[i:]) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
            halves.sort(key=lambda p: (ranks[p[0]], ranks[p[1]]))
            merges += [(name[a], name[b]) for a, b in halves]
        model = models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges,
                           ignore_merges=True, cache_capacity=10_000)
        self.memo: dict[str, bytes] = {}
        self.pattern = regex.compile(PATTERN)
        self.tokenizer = Tokenizer(model)
        # Pieces come one by one; whole texts (for offsets) are split here first.
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.split = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(PATTERN), "isolated"), self.letters])
        self.tokenizer.pre_tokenizer = self.letters
        size = max(ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        pieces = [b""] * size
        for t, r in ranks.items():
            self.lengths[r], pieces[r] = len(t), t
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.text = np.array([str(i) for i in range(size)], object)

    def _learn(self, pieces: list[str]) -> None:
        """The ids of new pieces: one call of the library, each piece a word of
        its own (pieces never merge across the pattern's matches)."""
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(found.word_ids, minlength=len(pieces)))).tolist()
        a = 0
        for piece, b in zip(pieces, ends):
            self.memo[piece] = ids[a:b]
            a = b

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text. A piece (match of the pattern) is encoded by the
        library once and remembered as packed ids; the memory is emptied at
        MEMO pieces."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        out, known = [], self.memo.get
        split = [self.pattern.findall(t) for t in texts]
        packed = [list(map(known, pieces)) for pieces in split]
        new = {p for ids, pieces in zip(packed, split) if None in ids for p, i in zip(pieces, ids) if i is None}
        if new:
            self._learn(list(new))
        for ids, pieces in zip(packed, split):
            out.append(np.frombuffer(b"".join(map(known, pieces) if None in ids else ids), np.int32))
        return out

    def encode_with_offsets(self, texts: list[str]) -> list[tuple[list[int], list[tuple[int, int]]]]:
        """ids and, for each, the [start, end) of the characters it touches; a
        character split between tokens belongs to all of them."""
        self.tokenizer.pre_tokenizer = self.split
        found = [(e.ids, e.offsets) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        self.tokenizer.pre_tokenizer = self.letters
        return found

    def spans(self, text: str, ids) -> tuple[np.ndarray, np.ndarray]:
        """[start, end) of the characters (code points) that each of a text's
        ids touches, from the lengths of the ids' bytes."""
        ids = np.asarray(ids, np.int64)
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        if not (len(ids) and text.isascii()):
            begun = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80, dtype=np.int32)
            starts, ends = begun[starts] - 1, begun[ends - 1]
        return starts.astype("<i4"), ends.astype("<i4")

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        at = np.repeat(self.starts[ids] - (ends - n), n) + np.arange(ends[-1])
        return self.bytes[at].tobytes()


def codec(name: str = VOCABULARY) -> Codec:
    """Built once per Python worker. ``name``: a vocabulary of the installed
    public tokenizers, or a path."""
    if name not in _LOADED:
        import os

        import public_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        _LOADED[name] = Codec(name if os.path.isabs(name) else public_tokenizers.path(name))
    return _LOADED[name]


def _texts(column) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, offsets: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, ids (array<int>), and with
    ``offsets`` the character span of each id (starts, ends: array<int>)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in slices(batches, 1, SLICE):
            texts = _texts(batch.column(1))
            ids, starts, ends = use.encode(texts), [], []
            if offsets:
                starts, ends = zip(*map(use.spans, texts, ids)) if texts else ([], [])
            kind = pa.list_(pa.int32())
            columns = [batch.column(0), pa.array(ids, kind)]
            if offsets:
                columns += [pa.array(list(starts), kind), pa.array(list(ends), kind)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "starts", "ends"][:len(columns)])

    schema = "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Per row (doc_id, ids): doc_id, bytes (binary), text (null if the bytes
    are no UTF-8)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in batches:
            out = [use.decode(i or []) for i in batch.column(1).to_pylist()]
            texts = []
            for b in out:
                try:
                    texts.append(b.decode())
                except UnicodeDecodeError:
                    texts.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), pa.array(texts, pa.string())],
                ["doc_id", "bytes", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, bytes binary, text string")


def encoded_corpus(docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = True, offsets: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids (unless ``with_ids`` is
    false), ids_sha256 (of the decimal ids joined by commas), decoded_sha256
    (of the bytes the ids decode to), and with ``offsets`` offsets_sha256 (of
    all starts, then all ends, as little-endian 32-bit integers). One pass,
    batch by batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = codec(vocabulary)
        for batch in slices(batches, 1, SLICE):
            counts, all_ids, of_ids, of_bytes, of_spans = [], [], [], [], []
            texts = _texts(batch.column(1))
            for text, ids in zip(texts, use.encode(texts)):
                counts.append(len(ids))
                if with_ids:
                    all_ids.append(ids)
                of_ids.append(hashlib.sha256(",".join(use.text[ids]).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(use.decode(ids)).hexdigest())
                if offsets:
                    of_spans.append(hashlib.sha256(b"".join(a.tobytes() for a in use.spans(text, ids))).hexdigest())
            columns = {"doc_id": batch.column(0), "n_tokens": pa.array(counts, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(all_ids, pa.list_(pa.int32()))
            columns |= {"ids_sha256": pa.array(of_ids, pa.string()), "decoded_sha256": pa.array(of_bytes, pa.string())}
            if offsets:
                columns["offsets_sha256"] = pa.array(of_spans, pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    ids, spans = "ids array<int>, " * with_ids, ", offsets_sha256 string" * offsets
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, f"doc_id long, n_tokens long, {ids}ids_sha256 string, decoded_sha256 string{spans}"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded_corpus(table(spark, sf_dir, "documents"), with_ids=False, offsets=True)
