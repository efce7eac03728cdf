"""Near-dedup by SuperMinHash, banding, verification and union-find (operator 5).

Set of a text: its distinct word shingles (A-Z lower-cased), 64-bit hashes.
1. One Arrow pass over the texts gives each row its set's size, a 128-bit key
   of the whole set, BANDS band hashes and a one-bit-per-component sketch of
   its SuperMinHash signature (ranks of each element's own permutation, so an
   element stops as soon as its rank cannot lower any component).
2. Rows of equal sets are one class; only its smallest doc_id goes on. Groups
   of exact copies, however large, are one row from here.
3. Band buckets of two classes or more propose links. Not all pairs: first
   each class is tested against one hub, the smallest id met in its buckets.
   In buckets that then hold several components, classes leave that can link
   with nobody there, as too many of their shingles are theirs alone (an exact
   bound, from one count over the shingles of such buckets); the others are
   tested against the bucket's HUBS smallest ids outside their component. What
   larger buckets still hold is compared in blocks, two blocks a task, giving
   links only. So no proposed link that could change a component is left out.
4. Proposed links whose sizes, own shingles or sketches already exclude the
   similarity are dropped; the others are confirmed on the full sets of the
   whole texts.
5. Components of the confirmed links give component_id.

A link at the threshold meets in a band with probability above 0.999997
(ROWS 5, BANDS 32 at 0.8), and passes the sketch with one above 0.99999998.

Edge cases: null, empty or wordless texts have an empty set and no link; fewer
words than the shingle: the whole sequence is the one shingle; rows sharing a
doc_id are one document with several texts; a null doc_id is linked with
nothing, kept, its component null; texts of any length are whole; other
columns of any name are ignored; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh, table
from .components import connected_components
from .textscan import bytes_of, chunks, mix64, shingle_sets, slices

WORDS = 4
BANDS, ROWS = 32, 5
M = BANDS * ROWS
NUMERATOR, DENOMINATOR = 80, 100
#: Of M one-bit components, links at 0.8 agree in 0.9 M on average; fewer than this never happens to them.
LEAST_EQUAL_BITS = 120
HUBS = 8
BLOCK, COLUMNS = 512, 8192
#: Bits of the map of ids that texts are let through by before a join (a broadcast of 262,144 rows at most).
FILTER_BITS = 1 << 24
#: Pairs of a hub, or rows of a class, beyond which they are dealt over more tasks (classes: over SALTS).
SALTED, SALTS = 1024, 64
U = np.uint64


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """SuperMinHash of each set: M values rank << 24 | 24 random bits."""
    n = np.array([len(s) for s in sets], np.int64)
    sig = np.full(len(sets) * M, 0xFFFFFFFF, np.uint32)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, U)
    row = np.repeat(np.arange(len(sets)), n)
    order = np.tile(np.arange(M, dtype=np.uint8), (len(element), 1))
    for rank in range(M):
        if not len(element):
            break
        noise = mix64(element + U((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        swap = rank + ((noise & U(0xFFFFFFFF)) * U(M - rank) >> U(32)).astype(np.int64)
        at = np.arange(len(element))
        place = order[at, swap].astype(np.int64)
        order[at, swap] = order[:, rank]
        np.minimum.at(sig, row * M + place, np.uint32(rank << 24) | (noise >> U(40)).astype(np.uint32))
        going = sig.reshape(-1, M).max(1) >= np.uint32(min(rank + 1, M) << 24)
        stay = going[row]
        if stay.sum() < 0.7 * len(stay):
            element, row, order = element[stay], row[stay], order[stay]
    return sig.reshape(-1, M)


def scan(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (key of the set), bands, s1, s2, s3 (sketch)
    of each row; null keys for an empty set."""
    seeds = mix64(np.arange(1, BANDS + 1, dtype=U))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            for a, b in chunks(offsets):
                sets = shingle_sets(data, offsets[a:b + 1], words)
                n = np.array([len(s) for s in sets], np.int64)
                sig = signatures(sets)
                bands = np.tile(seeds, (len(sets), 1))
                for i in range(ROWS):
                    bands = mix64(bands + sig.reshape(-1, BANDS, ROWS)[:, :, i])
                bits = np.zeros((len(sets), 192), bool)
                bits[:, :M] = sig & 1
                sketch = np.packbits(bits, axis=1).view(np.int64)
                keys = [np.array([x(s) for s in sets], U).view(np.int64) for x in (
                    lambda s: mix64(s ^ U(0x51)).sum(dtype=U), lambda s: mix64(s + U(0x7F4A7C15)).sum(dtype=U))]
                none = n == 0
                flat = pa.array(bands.view(np.int64).ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n), *(pa.array(k, mask=none) for k in keys),
                     pa.ListArray.from_arrays(pa.array(np.arange(0, len(n) + 1, dtype=np.int32) * BANDS), flat),
                     *(pa.array(sketch[:, i].copy()) for i in range(3))],
                    ["doc_id", "n_shingles", "k1", "k2", "bands", "s1", "s2", "s3"])

    return (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>, s1 long, s2 long, s3 long"))


def _possible(a: str, b: str, own: bool = False):
    """Can the sets of rows a and b reach the similarity, by sizes, sketches
    and (with ``own``) the shingles that nobody shares?"""
    x, y = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    differ = sum((F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("s1", "s2", "s3")), F.lit(0))
    fits = (DENOMINATOR * F.least(x, y) >= NUMERATOR * F.greatest(x, y)) & (differ <= M - LEAST_EQUAL_BITS)
    if own:
        both = F.least(x - F.col(f"{a}.own"), y - F.col(f"{b}.own"))
        fits = fits & ((NUMERATOR + DENOMINATOR) * both >= NUMERATOR * (x + y))
    return fits


def own_shingles(reps: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """rep, own: how many of its shingles no other of ``reps`` has (one
    partial aggregation over their shingle hashes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            ids = batch.column(0).to_numpy()
            for a, b in chunks(offsets):
                sets = shingle_sets(data, offsets[a:b + 1], words)
                n = [len(s) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids[a:b], n)), pa.array(np.concatenate(sets).view(np.int64))], ["rep", "h"])

    hashes = texts.join(reps.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi").mapInArrow(run, "rep long, h long")
    alone = hashes.groupBy("h").agg(F.count("*").alias("n"), F.min("rep").alias("rep")).filter("n = 1")
    return alone.groupBy("rep").agg(F.count("*").alias("own"))


def confirmed(pairs: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """pairs (u, v) + linked: compared on the full sets of ``texts`` (doc_id, text).

    A pair carries the text of its u. The texts of v go once to each group of
    about SALTED of its pairs, ahead of them, so a hub of any number of pairs is
    spread over tasks and its sets are made once a group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hub = None, []
        for batch in slices(batches, 3):
            us, groups = batch.column(0).to_pylist(), list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            data, offsets = bytes_of(batch.column(3))
            linked = np.zeros(len(us), bool)
            for a, b in chunks(offsets):
                for i, mine in enumerate(shingle_sets(data, offsets[a:b + 1], words), a):
                    if groups[i] != group:
                        group, hub = groups[i], []
                    if us[i] is None:
                        hub.append(mine)
                        continue
                    for other in hub:
                        both = len(np.intersect1d(mine, other, assume_unique=True))
                        linked[i] |= both > 0 and DENOMINATOR * both >= NUMERATOR * (len(mine) + len(other) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked)], ["u", "v", "linked"])

    sizes = pairs.groupBy("v").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("salts"))
    hubs = sizes.join(texts, F.col("v") == F.col("doc_id")).select(
        F.lit(None).cast("long").alias("u"), "v", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "text")
    own = pairs.join(sizes, "v").join(texts, F.col("u") == F.col("doc_id")).select(
        "u", "v", F.pmod(F.xxhash64("u"), "salts").cast("int").alias("salt"), "text")
    rows = own.unionByName(hubs).repartition("v", "salt").sortWithinPartitions("v", "salt", F.col("u").asc_nulls_first())
    return (rows.mapInArrow(run, "u long, v long, linked boolean").filter("u is not null")
            .groupBy("u", "v").agg(F.max("linked").alias("linked")))


def classes(known: DataFrame) -> DataFrame:
    """doc_id, rep of rows with a set: the smallest id with an equal set. Rows
    of classes of more than SALTED are dealt over SALTS tasks."""
    key = ["k1", "k2", "n_shingles"]
    rows = known.select("doc_id", *key, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    least = rows.groupBy(*key).agg(F.min("doc_id").alias("rep"), F.count("*").alias("size"))
    large = least.filter(F.col("size") > SALTED).select(*key, F.col("rep").alias("far"), F.explode(
        F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    split = rows.join(large, [*key, "salt"], "left")
    small = split.filter("far is null").join(least.filter(F.col("size") <= SALTED), key).select("doc_id", "rep")
    return split.filter("far is not null").select("doc_id", F.col("far").alias("rep")).unionByName(small)


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    with Scratch(docs.sparkSession, "near-dup") as scratch:
        return scratch.result(_near_duplicates(docs, words, scratch))


def _near_duplicates(docs: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    rows = scratch.keep(scan(docs, words))
    known = rows.filter("doc_id is not null and n_shingles > 0")
    of = scratch.keep(classes(known))

    # Rows of one doc_id in several classes make them one document.
    least = of.groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("last")).filter("v < last")
    stars = scratch.keep(of.join(least, "doc_id").filter("rep <> v").select(F.col("rep").alias("u"), "v").distinct())

    # Of each class the row(s) of its smallest id: they alone are compared.
    reps = known.join(of.filter("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    # Dealt by bucket once: the counts and the rows they are joined to read the same shuffle.
    banded = reps.select(F.col("doc_id").alias("rep"), F.explode("bands").alias("bucket")).repartition("bucket")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("size"), F.min("rep").alias("hub")).filter("size > 1")
    members = scratch.keep(
        banded.join(shared, "bucket").select("bucket", "rep", "hub")
        .join(reps.select(F.col("doc_id").alias("rep"), "n_shingles", "s1", "s2", "s3"), "rep"))
    texts = scratch.keep(texts_of(docs, members, scratch))

    m, h = members.alias("m"), members.filter("rep = hub").alias("h")
    pairs = scratch.keep(m.join(h, F.col("m.bucket") == F.col("h.bucket"))
                         .filter((F.col("m.rep") != F.col("h.rep")) & _possible("m", "h"))
                         .groupBy(F.col("m.rep").alias("u")).agg(F.min("h.rep").alias("v")))

    def joined(stars: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = connected_components(stars.unionByName(links), scratch)
        return found, found.filter("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))

    first = scratch.keep(confirmed(pairs, texts, words))
    found, stars = joined(stars, first.filter("linked").select("u", "v"))
    linkable = _linkable(_unsettled(members, found, 0), texts, words, scratch)
    scratch.drop(members, pairs)
    open_ = scratch.keep(_unsettled(linkable, found, 0))
    by_id = Window.partitionBy("bucket").orderBy("rep")
    hubs = open_.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= HUBS)
    m, h = open_.alias("m"), hubs.alias("h")
    pairs = scratch.keep(m.join(h, F.col("m.bucket") == F.col("h.bucket"))
                         .filter((F.col("m.component") != F.col("h.component")) & _possible("m", "h", own=True))
                         .select(F.greatest("m.rep", "h.rep").alias("u"), F.least("m.rep", "h.rep").alias("v")).distinct()
                         .join(first.select("u", "v"), ["u", "v"], "left_anti"))
    second = scratch.keep(confirmed(pairs, texts, words))
    found, stars = joined(stars, second.filter("linked").select("u", "v"))
    rest = scratch.keep(_unsettled(linkable, found, HUBS))
    scratch.drop(linkable, open_, pairs, first, second)
    found, stars = joined(stars, block_links(rest, texts, words, scratch))

    labels = (of.join(found, F.col("rep") == F.col("node"), "left")
              .select("doc_id", F.coalesce("component", "rep").alias("component_id")).distinct())
    return (rows.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def texts_of(docs: DataFrame, members: DataFrame, scratch: Scratch) -> DataFrame:
    """doc_id, text of the rows of ``docs`` that are a rep of ``members``.

    A bitmap of FILTER_BITS hashed ids, at most FILTER_BITS / 64 rows however
    many members there are, lets most other texts out before the exact join
    shuffles them.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    word, bit = F.shiftright(slot, 6).alias("word"), F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(doc_id), {FILTER_BITS}) % 64 AS INT))")
    ids = scratch.keep(members.select(F.col("rep").alias("doc_id")).distinct())
    bitmap = ids.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    likely = (rows.withColumn("word", word).join(F.broadcast(bitmap), "word")
              .filter(F.col("bits").bitwiseAND(bit) != 0).select("doc_id", "text"))
    # Not a semi join, which the optimizer would move below the bitmap's join; ids are distinct.
    return likely.join(ids, "doc_id").select("doc_id", "text")


def _unsettled(members: DataFrame, found: DataFrame, tested: int) -> DataFrame:
    """``members`` with their component, of the buckets that hold several
    components and more members than ``tested``."""
    placed = (members.drop("component").join(found, F.col("rep") == F.col("node"), "left")
              .withColumn("component", F.coalesce("component", "rep")).drop("node"))
    mixed = (placed.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("size"))
             .filter((F.col("a") < F.col("b")) & (F.col("size") > tested)).select("bucket"))
    return placed.join(mixed, "bucket")


def _linkable(members: DataFrame, texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """``members`` + own, without those that can reach the similarity with
    nobody in their bucket: their shared shingles are too few even for its
    smallest set. Exact: what is own here is shared with no possible partner."""
    members = scratch.keep(members)
    known = members.join(own_shingles(members, texts, words), "rep", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    for _ in range(2):  # the smallest sets may go first
        least = known.groupBy("bucket").agg(F.min("n_shingles").alias("least"))
        known = known.join(least, "bucket").filter(
            (NUMERATOR + DENOMINATOR) * (F.col("n_shingles") - F.col("own")) >= NUMERATOR * (F.col("n_shingles") + F.col("least"))).drop("least")
    out = scratch.keep(known)
    scratch.drop(members)
    return out


def block_links(members: DataFrame, texts: DataFrame, words: int, scratch: Scratch) -> DataFrame:
    """u, v: links between components of ``members`` that share a bucket,
    enough of them to join all that are linked.

    Buckets that share members are one cluster; its members are dealt over
    blocks of about BLOCK, and a task compares two blocks on their full sets
    (intersections of all rows at once, as matrix products over chunks of the
    vocabulary) and gives at most one link less than it has rows. So a group
    of any size is split over tasks, and its pairs are never rows.
    """
    hubs = members.groupBy("bucket").agg(F.min("rep").alias("v"))
    clusters = connected_components(members.join(hubs, "bucket").select(F.col("rep").alias("u"), "v"), scratch)
    sizes = clusters.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = clusters.join(sizes, "component").select(
        F.col("node").alias("rep"), F.col("component").alias("cluster"), "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("own_block"))
    known = members.select("rep", F.col("component").alias("was")).distinct().join(dealt, "rep")
    rows = known.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = rows.select("rep", "was", "text", "cluster", "own_block", other).select(
        "rep", "was", "text", "cluster", F.least("own_block", "other").alias("a"), F.greatest("own_block", "other").alias("b"))

    def compare(pdf):
        import pandas as pd
        return pd.DataFrame(linked_rows(pdf["rep"].to_numpy(), pdf["was"].to_numpy(), pa.array(pdf["text"]), words), columns=["u", "v"])

    return tasks.groupBy("cluster", "a", "b").applyInPandas(compare, "u long, v long")


def linked_rows(ids: np.ndarray, was: np.ndarray, texts: pa.Array, words: int) -> list[tuple[int, int]]:
    """Links between rows of different components, a spanning forest of them."""
    data, offsets = bytes_of(texts)
    sets = [s for a, b in chunks(offsets) for s in shingle_sets(data, offsets[a:b + 1], words)]
    n = np.array([len(s) for s in sets])
    every, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, len(every), COLUMNS):
        cut = slice(*np.searchsorted(place, [start, start + COLUMNS]))
        part = np.zeros((len(sets), min(COLUMNS, len(every) - start)), np.float32)
        part[row[cut], place[cut] - start] = 1
        part = part[:, part.sum(0) > 1]
        both += part @ part.T
    sizes = n[:, None] + n[None, :]
    u, v = np.nonzero(np.triu(DENOMINATOR * both.astype(np.int64) >= NUMERATOR * (sizes - both.astype(np.int64)), 1))
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(u.tolist(), v.tolist()):
        a, b = root(int(was[i])), root(int(was[j]))
        if a != b:
            parent[a] = b
            out.append((int(ids[i]), int(ids[j])))
    return out


def keep_one(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` less every document that is not the smallest of its component."""
    ident = fresh(docs, "gone_id")
    gone = near_duplicates(docs, words).filter(~F.col("kept")).select(F.col("doc_id").alias(ident)).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(ident), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
