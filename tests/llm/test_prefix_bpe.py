"""Operator 13 against the tokenizers library; edges."""

import hashlib
import random
import struct
import sys

import public_tokenizers
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cabgrid.llm import op13_prefix_bpe as op
from conftest import SF_SMALL
from edge_rows import edges, empty  # noqa: F401


LIBRARY = Tokenizer.from_file(public_tokenizers.path(op.VOCABULARY))


def digests(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def ids_of(text):
    packed = op.codec().encode(text)
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {tuple(r) for r in op.op13_prefix_bpe(spark, SF_SMALL).collect()}
    assert got == {(d.doc_id, *digests(d.text)) for d in docs}


def test_edges(spark, edges, empty):  # noqa: F811
    got = sorted(map(tuple, op.round_trips(edges).collect()), key=str)
    assert got == sorted(((d.doc_id, *digests(d.text)) for d in edges.collect()), key=str)
    assert op.round_trips(empty).count() == op.encode(empty).count() == 0


def test_encode_and_decode_are_inverse(spark, edges):  # noqa: F811
    back = op.decode(op.encode(edges)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in edges.collect())
    odd = spark.createDataFrame([(1, None), (2, []), (3, [220, None, 50256])], "doc_id long, ids array<int>")
    assert {tuple(r) for r in op.decode(odd).collect()} == {(1, ""), (2, ""), (3, " <|endoftext|>")}


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60) | st.text("ab \n't<|endofx>é中🙂", max_size=80))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "<|endoftext|>", " <|endoftext|><|endoftext|> x", "a  <|endoftext|>  b", "<|endoftext", "'ll we'LL don't",
    "a" * 50_000, " " * 50_000, "ab" * 20_000, "中" * 10_000, "‍" * 2_000, "\t \n" * 5_000,
    "x\U0003d000y \U00012550\U00012551 1\U00011de0", "՘a ࢏", "x\x00y\x7f\x80"])
def test_specials_long_pieces_and_new_characters(text):
    assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids_of("known " + text) == LIBRARY.encode("known " + text, add_special_tokens=False).ids


def test_decode_of_any_ids():
    random.seed(3)
    for _ in range(50):
        ids = [random.randrange(50_257) for _ in range(100)]
        assert op.codec().decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_split_differs_only_at_unassigned_characters():
    """Every code point next to a letter: where the two pattern engines split
    differently, the text goes to the library's splitter."""
    use, split = op.codec(), LIBRARY.pre_tokenizer.pre_tokenize_str
    points = [chr(c) for c in range(0xA0, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(points), 8_000):
        block = points[k:k + 8_000]
        text = "".join(f"a{c}" for c in block)
        if [o for _, o in split(text)] != [m.span() for m in use.pattern.finditer(text)]:
            for c in block:
                if [o for _, o in split(f"a{c}")] != [m.span() for m in regex.finditer(use.pattern, f"a{c}")]:
                    assert use._unsure({c}), hex(ord(c))


def test_memory_is_emptied(monkeypatch):
    monkeypatch.setattr(op, "MEMO", 3)
    monkeypatch.setattr(op, "PAIRS", 3)
    for n in range(30):
        text = f"words number{n} of many{n * n} kinds"
        assert ids_of(text) == LIBRARY.encode(text, add_special_tokens=False).ids
