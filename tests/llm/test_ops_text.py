"""Operators 1, 5, 6, 9, 10: against brute force, DuckDB and tiktoken; edges."""

import hashlib
import tempfile
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from cabgrid.llm import op1_mix, op5_near_dedup, op6_bpe, op9_lines, op10_language
from cabgrid.llm.common import Scratch
from cabgrid.llm.components import connected_components
from cabgrid.llm.queries import LLM_ORACLE, LLM_QUERIES
from conftest import SF_SMALL, TABLES
from edge_rows import edges, empty  # noqa: F401
from scripts.check_oracle import compare


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    got = LLM_QUERIES[name](spark, SF_SMALL).toPandas()
    assert len(got) and compare(got, con.execute(LLM_ORACLE[name]).df()) == "OK"


# --- 1: mix -------------------------------------------------------------------

def test_mix_edges(edges):
    got = {(r.doc_id, r.size): r for r in op1_mix.mix_sources(edges).collect()}
    exp = brute.copies([(r.doc_id, r.source, r.text) for r in edges.collect() if r.doc_id != 4])
    assert got[None, 5].copies <= 3 and len(got) == 12 - 1
    assert {r.source_size for r in got.values()} >= {0, exp[6][1]}
    emitted = op1_mix.emit_mix(edges)
    assert emitted.columns == edges.columns
    assert sum(r.copies for r in op1_mix.mix_sources(edges).collect()) == emitted.count()


def test_mix_targets_hold_cap_and_total(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), ("d", 700), (None, 60), ("e", 0)], "source string, size long")
    got = {r.source: r for r in op1_mix.source_targets(sizes).collect()}
    assert got["a"].target == 30.0 and got["e"].target == 0.0
    assert all(r.target <= 3 * r.source_size + 1e-9 for r in got.values())
    assert sum(r.target for r in got.values()) == pytest.approx(1775)


def test_mix_matches_brute(docs, rows):
    got = {r.doc_id: r for r in op1_mix.mix_sources(docs).collect()}
    for d, (size, source, target, copies) in brute.copies([(d, s, t) for d, t, _, s in rows]).items():
        r = got[d]
        assert (r.size, r.source_size, r.copies, r.taken) == (size, source, copies, size * copies)
        assert r.target == pytest.approx(target)


def test_mix_rows_without_an_id_or_with_one_id(spark):
    """Half the rows have no doc_id, a third share one: each has its own coin,
    so the sources come near their targets."""
    rows = [(None if i % 2 else 7 if i % 3 else i, f"s{i % 4 // 2}", "two words") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(7)
    got = op1_mix.mix_sources(df).groupBy("target").agg(F.sum("taken").alias("taken"), F.count("*").alias("n")).collect()
    assert sum(r.n for r in got) == len(rows) and len(got) == 2
    assert all(abs(r.taken - r.target) < 0.05 * r.target for r in got)
    nameless = df.filter("doc_id is null")
    emitted = dict(op1_mix.emit_mix(nameless).groupBy("source").count().collect())
    for r in op1_mix.source_targets(nameless.select("source", F.lit(2).alias("size"))).collect():
        assert abs(2 * emitted[r.source] - r.target) < 0.05 * r.target


def test_mix_empty(empty):
    assert op1_mix.mix_sources(empty).count() == 0 and op1_mix.emit_mix(empty).count() == 0


# --- 5: near-dedup --------------------------------------------------------------

@pytest.mark.parametrize("words", [4, 5])
def test_near_dedup_matches_brute(docs, rows, words):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in op5_near_dedup.near_duplicates(docs, words).collect()}
    exp = {d: (n, c, c == d) for d, (n, c) in brute.near_dup([(d, t) for d, t, _, _ in rows], words).items()}
    assert got == exp and any(not kept for _, _, kept in got.values())


@pytest.mark.parametrize("hubs, block", [(8, 512), (1, 16)])
def test_near_dedup_hot_group(spark, monkeypatch, hubs, block):
    """Also with nearly everything left to the block comparison. One group of copies holds most rows, near copies of it another share,
    and a passage that many share links nothing."""
    monkeypatch.setattr(op5_near_dedup, "HUBS", hubs)
    monkeypatch.setattr(op5_near_dedup, "BLOCK", block)
    base = [f"a{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(base)) for i in range(100, 400)]
    for i in range(400, 520):
        text = list(base)
        text[(7 * i) % 120] = f"x{i}"
        text[(11 * i) % 120] = f"y{i}"
        rows.append((i, " ".join(text)))
    # Prefixes of one text: each links with the next ones only.
    rows += [(i, " ".join(f"s{j}" for j in range(40 + 3 * (i - 700)))) for i in range(700, 780)]
    rows += [(i, " ".join(passage + [f"z{i}q{j}" for j in range(40)])) for i in range(520, 620)]
    exp = brute.near_dup(rows, 4)
    got = op5_near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == exp
    assert len({c for _, c in exp.values()}) > 100


def test_near_dedup_edges(edges, empty):
    got = {(r.doc_id, r.n_shingles): r for r in op5_near_dedup.near_duplicates(edges).collect()}
    assert got[1, 0].component_id == 1 and got[2, 0].component_id == 2
    assert got[4, 1].component_id == 3 and not got[4, 1].kept
    assert got[5, 1].kept and got[None, 2].component_id is None and got[None, 2].kept
    kept = op5_near_dedup.keep_one(edges)
    assert kept.columns == edges.columns and kept.count() == len(edges.collect()) - 1
    assert op5_near_dedup.near_duplicates(empty).count() == 0


def test_superminhash_estimates_jaccard():
    rng = np.random.default_rng(1)
    for share in (0.3, 0.8, 0.95):
        a = rng.integers(0, 2 ** 63, 1500).astype(np.uint64)
        k = int(1000 * share / (1 + share) * 2)
        x, y = a[:1000], a[1000 - k:2000 - k]
        s = op5_near_dedup.signatures([np.unique(x), np.unique(y)])
        true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
        assert abs((s[0] == s[1]).mean() - true) < 0.15
    one = op5_near_dedup.signatures([np.array([5], np.uint64)])[0]
    assert sorted(one >> 24) == list(range(op5_near_dedup.M))  # a lone element's ranks are a permutation


def test_components_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 300)] + [(1000, 999), (5, 5)], "u long, v long")
    with Scratch(spark, "chain") as scratch:
        got = dict(connected_components(edges, scratch).collect())
    assert got == {**{i: 1 for i in range(1, 301)}, 999: 999, 1000: 999}


# --- 6: BPE ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tiktoken():
    return brute.tiktoken_encoding()


def test_bpe_matches_tiktoken(docs, rows, tiktoken):
    got = {r.doc_id: r for r in op6_bpe.encoded_corpus(docs).collect()}
    for d, t, _, _ in rows:
        ids = tiktoken.encode_ordinary(t or "")
        assert got[d].ids == ids and got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == brute.sha(",".join(map(str, ids))) and got[d].decoded_sha256 == brute.sha(t or "")


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab '\n\t=-é中🙂１"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_bpe_any_text(tiktoken, text):
    codec = op6_bpe.codec()
    ids = codec.encode([text])[0]
    assert list(ids) == tiktoken.encode_ordinary(text) and codec.decode(ids) == text.encode()
    (again, spans), = codec.encode_with_offsets([text])
    starts, ends = codec.spans(text, codec.encode([text])[0])
    assert list(zip(starts.tolist(), ends.tolist())) == spans
    assert again == list(ids) and all(0 <= a < b <= len(text) for a, b in spans)


def test_bpe_query_gives_offsets(docs, spark):
    """The query's digest is of the library's own offsets."""
    docs.write.mode("overwrite").parquet((folder := tempfile.mkdtemp(prefix="bpe-")) + "/documents.parquet")
    got = {r.doc_id: r.offsets_sha256 for r in op6_bpe.op6_byte_bpe(spark, folder).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    for (d, text), (_, spans) in zip(texts.items(), op6_bpe.codec().encode_with_offsets(list(texts.values()))):
        packed = np.array([a for a, _ in spans] + [b for _, b in spans], "<i4").tobytes()
        assert got[d] == hashlib.sha256(packed).hexdigest()


def test_bpe_edges(edges, empty):
    got = op6_bpe.encode(edges, offsets=True)
    back = {(r.doc_id, r.text) for r in op6_bpe.decode(got).collect()}
    assert back == {(r.doc_id, r.text or "") for r in edges.collect()}
    assert op6_bpe.encode(empty).count() == 0 and op6_bpe.encoded_corpus(empty).count() == 0


# --- 9: lines --------------------------------------------------------------------------

def test_lines_match_brute(docs, rows):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in op9_lines.dedup_lines(docs).collect()}
    assert got == brute.line_dedup([(d, t) for d, t, _, _ in rows])


def test_lines_hot_line(spark, monkeypatch):
    """A line of every document goes the hot way, rarer ones through the shards."""
    monkeypatch.setattr(op9_lines, "HOT", 3)
    rows = [(i, f"the same hot line everywhere\nline of pair {i // 2} is here\nonly {i} has this line") for i in range(300)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in op9_lines.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.line_dedup(rows)


def test_lines_shards_grow_with_the_repeated_lines(spark, monkeypatch):
    assert op9_lines.shard_count(0, 8) == 32 and op9_lines.shard_count(1 << 40, 8) == 1 << 20
    monkeypatch.setattr(op9_lines, "SHARD_KEYS", 2)
    rows = [(i, f"line of pair {i // 2} is here\nand of three {i // 3} as well\nonly {i} has this line") for i in range(300)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in op9_lines.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.line_dedup(rows)


def test_lines_edges(edges, empty):
    out = op9_lines.dedup_lines(edges)
    assert out.columns == edges.columns + ["n_lines_", "n_dropped"]
    got = {(r.doc_id, r.text): (r["n_lines_"], r.n_dropped) for r in out.collect()}
    assert got[2, None] == (1, 0) and got[1, ""] == (1, 0)
    assert got[8, "\n\nother"] == (4, 1)
    assert got[None, "A shared line of text"] == (1, 0)
    assert op9_lines.without_repeated_lines(edges).columns == edges.columns
    assert op9_lines.dedup_lines(empty).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2 ** 64 - 1), max_size=400), st.integers(0, 2 ** 64 - 1))
def test_perfect_hash_is_minimal(keys, other):
    keys = np.array(sorted(keys), np.uint64)
    index = op9_lines.PerfectHash(keys).index(keys)
    assert sorted(index) == list(range(len(keys)))
    op9_lines.PerfectHash(keys).index(np.array([other], np.uint64))


# --- 10: language ID ------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = op10_language.fit(docs)
    got = (op10_language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
           .filter(op10_language.held_out(F.col("doc_id"))).collect())
    assert len(got) > 150 and np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_held_out_rows(docs):
    got = {r.doc_id: r.h for r in docs.select("doc_id", op10_language.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in got}


def test_language_training_skips_held_out_and_is_bounded(docs):
    t = op10_language.training_rows(docs, per_language=7)
    assert not t.filter(op10_language.held_out(F.col("doc_id"))).count()
    assert all(r["count"] <= 7 for r in t.groupBy("lang").count().collect())


def test_language_kernel_is_presence_kernel():
    """The batch kernel equals set intersections over the n-gram sets."""
    texts = ["the cat sat", "die katze sass", "le chat"]
    model = op10_language.Model(texts, ["en", "de", "fr"], [True, True, True])
    grams = [op10_language.distinct_slots(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    k = op10_language.Scorer(model).kernel(pa.array(texts))
    for i, a in enumerate(grams):
        for j, b in enumerate(grams):
            assert k[i, j] == pytest.approx(len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)), rel=1e-5)


def test_language_edges(edges, empty):
    model = op10_language.fit(edges)
    got = {(r.doc_id, r.lang_pred) for r in op10_language.predict(edges, model).collect()}
    assert {(1, "und"), (2, "und"), (9, "und")} <= got and (3, "und") not in got
    kept = op10_language.keep_identified(edges, model)
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 7, 8, 10, None}
    assert op10_language.fit(empty) is None
    assert {r.lang_pred for r in op10_language.predict(edges, None).collect()} == {"und"}
    assert op10_language.predict(empty, model).count() == 0


def test_language_prediction_takes_effect(spark, monkeypatch):
    words = {"en": "the house and the garden of the old man", "fr": "le jardin et la maison du vieux monsieur"}
    rows = [(i, f"{words[x]} {i}", None if i > 35 else x, "a") for i in range(40) for x in [("en", "fr")[i % 2]]]
    rows += [(100, "12 34", "en", "a"), (101, None, "en", "a"), (102, f"{words['en']} 7 {words['fr']} 7", "en", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = op10_language.fit(df.filter("doc_id < 100"))
    got = {r.doc_id: r.lang for r in op10_language.keep_identified(df, model).collect()}
    assert {i: got.get(i) for i in range(40)} == {i: ("en", "fr")[i % 2] for i in range(40)} and not {100, 101} & set(got)
    score = {r.doc_id: r.score for r in op10_language.predict(df, model).collect()}
    least = (score[102] + min(score[i] for i in range(40))) / 2
    assert score[102] < least
    assert {r.doc_id for r in op10_language.keep_identified(df, model, least_score=least).collect()} == set(range(40))
    monkeypatch.setattr(corpus_pipeline, "LANGUAGES", ["fr"])
    kept = corpus_pipeline.identify_language(spark, df.filter("doc_id < 100"), "")
    assert {r.doc_id for r in kept.collect()} == set(range(1, 40, 2))


def test_language_nothing_learnt_keeps_texts(spark, edges):
    bare = edges.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, bare, "")
    assert kept.columns == edges.columns and {r.doc_id for r in kept.collect()} == {3, 4, 5, 6, 7, 8, 10, None}


def test_language_learns_every_label_and_long_texts(spark):
    """90 languages of their own words, one of them in long texts only."""
    word = lambda i, j: chr(97 + i % 26) * 2 + chr(97 + i // 26) + chr(97 + j)
    text = lambda i, k: " ".join(word(i, (k + j) % 9) for j in range(12))
    rows = [(100 * i + k, text(i, k), f"l{i:02}") for i in range(90) for k in range(12 if i < 60 else 6)]
    rows += [(20_000 + k, "12 " * 9_000 + "žluťoučký kůň " * 3_000, "cs") for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = op10_language.training_rows(df).collect()
    assert {r.lang for r in sample} == {f"l{i:02}" for i in range(90)} | {"cs"}
    assert max(len(r.text) for r in sample) == op10_language.SAMPLE_CHARS
    assert all(r.text.startswith("žlu") for r in sample if r.lang == "cs")
    model = op10_language.fit(df)
    got = op10_language.predict(df, model).collect()
    said = {r.doc_id: r.lang_pred for r in got}
    assert np.mean([said[d] == x for d, _, x in rows]) > 0.95 and said[20_000] == "cs"
    assert op10_language.shares(64, 300, 16) == (300, 16) and op10_language.shares(10_000, 300, 16) == (8, 1)
