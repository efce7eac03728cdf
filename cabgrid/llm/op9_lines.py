"""Line dedup by sharded minimal perfect hashes (operator 9).

1. Documents are scanned once for the distinct 128-bit hashes of their line
   keys; (hash, doc_id) rows are written to the shared folder.
2. A partial aggregation gives each hash its document count and smallest
   document; hashes of one document are done.
3. The repeated hashes are sharded, at most about SHARD_KEYS a shard however
   many there are. Per shard a minimal perfect hash indexes three compact
   arrays: fingerprint, document count, smallest document.
4. Line rows stream past their shard's arrays, one shard in memory at a time,
   and give the lines each document loses.
5. Documents are rewritten without them.

Hashes in more than 1/HOT of the repeated (hash, document) rows, at most HOT
by that count, have arrays of their own which every task gets; so no shard
receives more than that share of the rows for one line.

Edge cases: a null or empty text is one empty line; rows sharing a doc_id are
one document for counting and lose the same lines; rows with a null doc_id
neither count nor lose lines; a document may lose every line (empty text);
texts of any length are whole; other columns of any name are untouched;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh, materialise, table
from .textscan import LOWER, WHITE, Hasher, bytes_of, chunks, mix64, slices

MIN_KEY = 10
HOT = 2000
SHARDS_PER_PARTITION, SHARD_KEYS = 4, 1 << 20
U = np.uint64


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: per level a bit array of
    GAMMA slots a key; a key alone in its slot stays, the others go on to the
    next level. A key's index is the rank of its bit."""

    GAMMA = 2

    def __init__(self, keys: np.ndarray):
        bits, self.sizes = [], []
        while len(keys):
            size = int(self.GAMMA * len(keys)) + 8
            at = self._slot(keys, len(self.sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            self.sizes.append(size)
            keys = keys[~alone[at]]
        self.packed = np.packbits(np.concatenate(bits)) if bits else np.zeros(0, np.uint8)
        self._open()

    def _open(self) -> None:
        self.bits = np.unpackbits(self.packed)[:sum(self.sizes)].astype(bool)
        self.rank = np.cumsum(self.bits, dtype=np.int32) - 1

    def __getstate__(self):
        return self.sizes, self.packed

    def __setstate__(self, state):
        self.sizes, self.packed = state
        self._open()

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + U((level + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) % U(size)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; a key never given gets any index or -1."""
        found = np.full(len(keys), -1, np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._slot(keys[todo], level, size)
            hit = self.bits[at]
            found[todo[hit]] = self.rank[at[hit]]
            todo, base = todo[~hit], base + size
        return found


class LineIndex:
    """Perfect hash + arrays over line hashes (h1 indexes, h2 is the fingerprint)."""

    def __init__(self, h1, h2, n_docs, first_doc):
        h1 = np.asarray(h1, np.int64).view(U)
        order = np.argsort(h1, kind="stable")
        alone = np.ones(len(h1), bool)  # one key per h1: of several (2**-64) the first is indexed
        alone[1:] = h1[order][1:] != h1[order][:-1]
        order = order[alone]
        self.hash = PerfectHash(h1[order])
        at = self.hash.index(h1[order])
        self.prints, self.counts, self.first = (np.zeros(len(order), np.int64) for _ in range(3))
        for array, values in ((self.prints, h2), (self.counts, n_docs), (self.first, first_doc)):
            array[at] = np.asarray(values, np.int64)[order]

    def first_doc(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(is it indexed, smallest document) of each hash."""
        if not len(self.prints) or not len(h1):
            return np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
        at = self.hash.index(np.asarray(h1, np.int64).view(U))
        there = (at >= 0) & (self.prints[at] == h2)
        return there, self.first[at]


def line_keys(data: np.ndarray, offsets: np.ndarray):
    """Lines of a chunk of rows: (row, start, end, eligible, h1, h2), bytes
    relative to the chunk; hashes are of the key, 0 where not eligible."""
    base = offsets[0]
    data = data[base:offsets[-1]]
    starts, ends = offsets[:-1] - base, offsets[1:] - base
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([starts, breaks + 1])
    row = np.concatenate([np.arange(len(starts)), np.searchsorted(starts, breaks, "right") - 1])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.append(start[1:] - 1, 0)
    last = np.append(row[1:] != row[:-1], True)
    end[last] = ends[row[last]]
    dark = np.flatnonzero(~WHITE[data])
    if not len(dark):
        zero = np.zeros(len(row), np.int64)
        return row, start, end, np.zeros(len(row), bool), zero, zero
    a = np.searchsorted(dark, start)
    b = np.searchsorted(dark, end)
    some = b > a
    key_start = np.where(some, dark[np.minimum(a, len(dark) - 1)], 0)
    key_end = np.where(some, dark[b - 1] + 1, 0)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    eligible = some & (chars[key_end] - chars[key_start] >= MIN_KEY)
    h1, h2 = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
    low = LOWER[data]
    for h, seed in ((h1, 11), (h2, 12)):
        h[eligible] = Hasher(low, seed)(key_start[eligible], key_end[eligible]).view(np.int64)
    return row, start, end, eligible, h1, h2


def line_hashes(docs: DataFrame) -> DataFrame:
    """doc_id, h1, h2: the distinct eligible line hashes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(1))
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b in chunks(offsets):
                row, _, _, ok, h1, h2 = line_keys(data, offsets[a:b + 1])
                found = np.rec.fromarrays([row[ok], h1[ok], h2[ok]])
                order = np.lexsort((found.f2, found.f1, found.f0))
                found = found[order]
                keep = np.ones(len(found), bool)
                keep[1:] = found[1:] != found[:-1]
                found = found[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[a + found.f0].astype(np.int64)), pa.array(found.f1), pa.array(found.f2)],
                    ["doc_id", "h1", "h2"])

    return (docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "doc_id long, h1 long, h2 long"))


def shard_count(keys: int, partitions: int) -> int:
    """Enough shards for every partition, and for SHARD_KEYS hashes in each
    (some 30 MB of arrays)."""
    return max(SHARDS_PER_PARTITION * partitions, -(-keys // SHARD_KEYS))


def shard_arrays(repeated: DataFrame, shards: int) -> DataFrame:
    """(shard, arrays): one row per shard of the repeated hashes."""
    def build(key, pdf):
        import pandas as pd
        index = LineIndex(pdf["h1"], pdf["h2"], pdf["n_docs"], pdf["first_doc"])
        return pd.DataFrame({"shard": [key[0]], "arrays": [pickle.dumps(index)]})

    return (repeated.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
            .groupBy("shard").applyInPandas(build, "shard int, arrays binary"))


def dropped_lines(docs: DataFrame) -> DataFrame:
    """doc_id, lost: the h1 of the line keys each document loses."""
    spark = docs.sparkSession
    lines = materialise(line_hashes(docs))
    repeated = materialise(
        lines.groupBy("h1", "h2").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"),
                                      F.count("*").alias("n_docs"))
        .filter("first_doc < last_doc").drop("last_doc"))
    total, keys = repeated.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.count("*")).first()
    top = repeated.filter(F.col("n_docs") > total / HOT).collect()  # at most HOT rows, by their sum
    hot = LineIndex(*[np.array([r[c] for r in top], np.int64) for c in ("h1", "h2", "n_docs", "first_doc")])
    shards = shard_count(keys, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hot lines are answered here; the others go to their shard."""
        for batch in batches:
            ids, h1, h2 = (batch.column(i).to_numpy() for i in range(3))
            there, first = hot.first_doc(h1, h2)
            lost = there & (first != ids)
            keep = lost | ~there
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (ids, h1, h2)] + [pa.array(lost[keep])], ["doc_id", "h1", "h2", "lost"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard, its arrays first."""
        shard, index = None, None
        for batch in batches:
            of = batch.column(0).to_numpy()
            for a, b in zip(*_runs(of)):
                part = batch.slice(a, b - a)
                if of[a] != shard:
                    shard, index = of[a], None
                arrays = part.column(4)
                if arrays.null_count < len(arrays):
                    index = pickle.loads(arrays.drop_null()[0].as_py())
                    part = part.filter(arrays.is_null())
                if index is None or not len(part):
                    continue
                ids, h1, h2 = (part.column(i).to_numpy() for i in (1, 2, 3))
                there, first = index.first_doc(h1, h2)
                lost = there & (first != ids)
                yield pa.RecordBatch.from_arrays([pa.array(ids[lost]), pa.array(h1[lost])], ["doc_id", "h1"])

    routed = lines.mapInArrow(split, "doc_id long, h1 long, h2 long, lost boolean")
    queue = (
        routed.filter(~F.col("lost"))
        .select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), "doc_id", "h1", "h2", F.lit(None).cast("binary").alias("arrays"))
        .unionByName(shard_arrays(repeated.filter(F.col("n_docs") <= total / HOT), shards), allowMissingColumns=True)
        .repartition("shard").sortWithinPartitions("shard", F.col("arrays").isNull())
    )
    lost = queue.mapInArrow(probe, "doc_id long, h1 long").unionByName(
        routed.filter("lost").select("doc_id", "h1"))
    return lost.groupBy("doc_id").agg(F.collect_set("h1").alias("lost"))  # at most a document's lines


def _runs(values: np.ndarray):
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.append(0, cuts).tolist() if len(values) else [], np.append(cuts, len(values)).tolist() if len(values) else []


def dedup_lines(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``docs`` with each text less its dropped lines, and the columns n_lines,
    n_dropped behind the input's; with ``digest``: doc_id, n_lines, n_dropped,
    kept_sha256 only (texts are hashed where they are rewritten)."""
    lost = fresh(docs, "lost")
    n_lines, n_dropped = (fresh(docs, c) for c in ("n_lines", "n_dropped"))
    by = dropped_lines(docs).select(F.col("doc_id").alias(fresh(docs, "lost_id")), F.col("lost").alias(lost))
    rows = docs.select("doc_id", "text") if digest else docs
    joined = rows.join(by, F.col("doc_id") == F.col(by.columns[0]), "left").drop(by.columns[0])
    fields = list(joined.columns)
    text_at, lost_at, id_at = fields.index("text"), fields.index(lost), fields.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_at):
            kept, lines, drops = rewrite(batch.column(text_at), batch.column(lost_at))
            counts = [pa.array(lines, pa.int64()), pa.array(drops, pa.int64())]
            if digest:
                sha = [hashlib.sha256(t.encode() if t else b"").hexdigest() for t in kept]
                yield pa.RecordBatch.from_arrays([batch.column(id_at), *counts, pa.array(sha, pa.string())],
                                                 ["doc_id", "n_lines", "n_dropped", "kept_sha256"])
            else:
                columns = [pa.array(kept, batch.column(i).type) if i == text_at else batch.column(i)
                           for i in range(len(fields)) if i != lost_at]
                yield pa.RecordBatch.from_arrays(columns + counts, [f for f in fields if f != lost] + [n_lines, n_dropped])

    if digest:
        return joined.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
    schema = joined.drop(lost).schema.add(n_lines, "long").add(n_dropped, "long")
    return joined.mapInArrow(run, schema)


def rewrite(texts: pa.Array, lost: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
    """(kept texts, number of lines, number dropped) of a batch; only rows
    that lose lines are taken apart."""
    kept = texts.to_pylist()
    lines = np.array([1 + (t.count("\n") if t else 0) for t in kept], np.int64)
    drops = np.zeros(len(kept), np.int64)
    some = np.flatnonzero(~lost.is_null().to_numpy(zero_copy_only=False))
    data, offsets = bytes_of(texts.take(pa.array(some))) if len(some) else (None, np.zeros(1, np.int64))
    for a, b in chunks(offsets):
        base = offsets[a]
        row, start, end, ok, h1, _ = line_keys(data, offsets[a:b + 1])
        cut = np.searchsorted(row, np.arange(b - a + 1))
        for r in range(b - a):
            of = slice(cut[r], cut[r + 1])
            gone = ok[of] & np.isin(h1[of], np.array(lost[int(some[a + r])].as_py(), np.int64))
            drops[some[a + r]] = gone.sum()
            kept[some[a + r]] = b"\n".join(
                data[base + s:base + e].tobytes() for s, e in zip(start[of][~gone], end[of][~gone])).decode()
    return kept, lines, drops


def without_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the rewritten texts (and n_chars, where there is one)."""
    columns = [F.char_length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`")
               for c in docs.columns]
    return dedup_lines(docs).select(*columns)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents"), digest=True)


def lines_sql(docs: str = "documents") -> str:
    """The CTEs of line dedup in DuckDB; ends with ``deduped`` (doc_id,
    n_lines, n_dropped, kept)."""
    return f"""
split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM {docs}),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM split),
twice AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
deduped AS (
  SELECT k.doc_id, count(*) AS n_lines,
    count(*) FILTER (WHERE t.key IS NOT NULL AND t.first_doc <> k.doc_id) AS n_dropped,
    coalesce(string_agg(k.line, chr(10) ORDER BY k.n) FILTER (WHERE t.key IS NULL OR t.first_doc = k.doc_id), '') AS kept
  FROM keyed k LEFT JOIN twice t ON k.key = t.key GROUP BY k.doc_id)"""


SQL = f"""WITH {lines_sql()}
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM deduped"""
