"""Conversation prefix trie by truncation peeling (operator 12).

Every distinct sequence of first d turns is a node of depth d. Peeling descends
from the maximum depth: conversations that end at depth d are merged with the
nodes that survived from depth d + 1, each node found is complete and leaves
with its totals, then the last turn is stripped and what is left is regrouped.

Distribution. A conversation is a path of turn digests (PATH_STEP bytes a turn);
texts are read once, where the digests are made, and not shuffled. Equal paths
become one item first. Items are dealt by ranges of their paths, so a subtree is
one stretch of consecutive items, whatever its size: a run peels its items and
closes every node that lies inside it. Only prefixes of its first and last path
may go on in its neighbours; their totals so far stay on these two paths, which
are all that a run leaves to the next round. So no run grows with a key (a
prefix that all conversations share costs each run one entry), and rounds
number the logarithm of the items. A closed node whose parent is still open
learns the parent's smallest member from a join on (run, parent).

Bounds: a run holds about RUN_BYTES of paths; one conversation's digests (24
bytes a turn) are one row; the SHA-256 of a node's ids is one sequential stream
over blocks of up to ID_BLOCK ids, one block in memory at a time.

Edge cases: rows without a conv_id belong to no conversation and are left out;
a null role or text is empty; turns of equal number are ordered by role, then by
digest, null turns come first; repeated rows are turns of their own; turnless
conversations (see ``rebuilt_paths``) are members of the root; texts of any
length are digested whole; other columns of any name are untouched; an empty
table gives no node, not even the root.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_path
from .common import sql_crc32, stored, table

KEY, PATH_STEP = 16, 24  # a turn in a path: the prefix's digest, the bytes of its text
RUN_BYTES = 1 << 20
LEAST_ITEMS = 8  # a run has at least so many items (on average), so rounds shrink
ID_BLOCK = 4096
FAMILY, MOST_SHARED = 5, 9
ROOT = b""
NO_IDS = hashlib.sha256(b"").hexdigest()

ENTRY = pa.struct([("depth", pa.int32()), ("n_convs", pa.int64()), ("conv_id", pa.int64()), ("n_children", pa.int64()),
                   ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())])
ENTRY_SQL = "struct<depth:int,n_convs:long,conv_id:long,n_children:long,n_leaves:long,saved:long,ends:string>"
ITEM_SQL = f"path binary, entries array<{ENTRY_SQL}>"

Turn = tuple[bytes, int]


# --- conversations to paths -----------------------------------------------------------

def path_of(turns: list[Turn]) -> bytes:
    """The chain of prefix digests of (digest, bytes of the text)."""
    out, key = [], ROOT
    for digest, size in turns:
        key = hashlib.blake2b(key + digest, digest_size=KEY).digest()
        out.append(key + size.to_bytes(PATH_STEP - KEY, "big"))
    return b"".join(out)


def shared_turns(conv_id: int) -> int:
    """How many first turns a rebuilt conversation takes from its family's first."""
    return zlib.crc32(str(conv_id).encode()) % MOST_SHARED


def families(conversations: DataFrame, first_of: Callable | None) -> DataFrame:
    """(turns): the digested turns of one conversation, or of all that
    ``first_of`` gives the same conv_id, collected in no order."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    turn = F.struct(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                    F.substring(digest, 1, KEY).alias("digest"), F.octet_length(text).cast("long").alias("size"))
    c = F.col("conv_id").cast("long")
    return (conversations.filter(c.isNotNull()).select((first_of(c) if first_of else c).alias("family"), turn.alias("turn"))
            .groupBy("family").agg(F.collect_list("turn").alias("turns")).select("turns"))


def _paths(collected: DataFrame, rebuild: Callable[[dict], dict] | None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, paths, lists = [], [], batch.column(0)
            turns = list(zip(*(field.to_pylist() for field in lists.flatten().flatten())))
            bounds = (lists.offsets.to_numpy() - lists.offsets[0].as_py()).tolist()
            for a, b in zip(bounds, bounds[1:]):
                found: dict[int, list[Turn]] = {}
                rows = sorted(turns[a:b], key=lambda t: (t[0], t[1] is not None, t[1] or 0, t[2], t[3]))
                for conv_id, _, _, digest, size in rows:
                    found.setdefault(conv_id, []).append((digest, size))
                for conv_id, own in (rebuild(found) if rebuild else found).items():
                    ids.append(conv_id)
                    paths.append(path_of(own))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(paths, pa.binary())], ["conv_id", "path"])

    return collected.mapInArrow(run, "conv_id long, path binary")


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) of each conversation as it is."""
    return _paths(families(conversations, None), None)


def rebuilt_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path) where conversation c begins with the first h turns of
    conversation ``c - c % 5`` (all, if it has fewer; none, if there is none)
    and goes on with its own turns after its first h; h = crc32(c) % 9. One
    that has no turn left stays, with an empty path."""
    def rebuild(found: dict[int, list[Turn]]) -> dict[int, list[Turn]]:
        out = {}
        for c, own in found.items():
            h = shared_turns(c)
            first = c - (abs(c) % FAMILY) * (1 if c >= 0 else -1)
            out[c] = found.get(first, [])[:h] + own[h:]
        return out

    return _paths(families(conversations, lambda c: c - c % FAMILY), rebuild)


# --- items: one per distinct path -----------------------------------------------------

def items_of(conv_paths: DataFrame) -> DataFrame:
    """One item per distinct path: how many conversations have it, the smallest
    one, and the SHA-256 of their ids in order. Copies meet map-side in blocks
    of ID_BLOCK consecutive ids."""
    key = F.substring("path", F.length("path") - PATH_STEP + 1, KEY)
    blocks = (conv_paths.select(F.when(F.length("path") == 0, F.lit(b"")).otherwise(key).alias("end"),
                                F.floor(F.col("conv_id") / ID_BLOCK).alias("block"), "conv_id", "path")
              .groupBy("end", "block").agg(
                  F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"),
                  F.count("*").alias("n"), F.min("conv_id").alias("least"), F.min("path").alias("path")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = None  # end, path, n, least, running hash

        def done() -> tuple[bytes, list[dict]]:
            _, path, n, least, digest = open_
            return path, [{"depth": len(path) // PATH_STEP, "n_convs": n, "conv_id": least, "n_children": 0,
                           "n_leaves": 0, "saved": 0, "ends": digest.hexdigest()}]

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if open_ and open_[0] == row["end"]:
                    open_[2] += row["n"]
                    open_[4].update(b"," + row["ids"].encode())
                    continue
                if open_:
                    out.append(done())
                open_ = [row["end"], row["path"], row["n"], row["least"], hashlib.sha256(row["ids"].encode())]
            yield _items(out)
        if open_:
            yield _items([done()])

    return blocks.repartition("end").sortWithinPartitions("end", "block").mapInArrow(run, ITEM_SQL)


def _items(rows: list[tuple[bytes, list[dict]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.binary()),
                                       pa.array([e for _, e in rows], pa.list_(ENTRY))], ["path", "entries"])


# --- peeling ----------------------------------------------------------------------------

#: What a run gives: nodes (0), nodes whose parent is open (1), paths left to the
#: next round (2), the open keys of those paths (3).
NODE, ORPHAN, LEFT, OPEN = range(4)
OUT = pa.schema([("kind", pa.int32()), ("run", pa.int32()), ("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                 ("parent_conv_id", pa.int64()), ("parent_key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
                 ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends", pa.string()),
                 ("path", pa.binary()), ("entries", pa.list_(ENTRY))])
OUT_SQL = ("kind int, run int, key binary, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, "
           f"n_children long, n_leaves long, saved_tokens long, ends string, {ITEM_SQL}")


def key_at(path: bytes, depth: int) -> bytes:
    return path[(depth - 1) * PATH_STEP:(depth - 1) * PATH_STEP + KEY] if depth else ROOT


def size_at(path: bytes, depth: int) -> int:
    return int.from_bytes(path[(depth - 1) * PATH_STEP + KEY:depth * PATH_STEP], "big") if depth else 0


class Node:
    """Totals of a prefix so far; ``path``: any path that begins with it."""

    __slots__ = ("path", "n_convs", "conv_id", "n_children", "n_leaves", "saved", "ends")

    def __init__(self, path: bytes):
        self.path, self.conv_id, self.ends = path, None, None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0

    def add(self, n_convs: int, conv_id: int, n_children: int, n_leaves: int, saved: int) -> None:
        self.n_convs += n_convs
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n_children += n_children
        self.n_leaves += n_leaves
        self.saved += saved


def peel(items: list[tuple[bytes, list[dict]]], last: bool) -> Iterator[dict]:
    """All records of one run; with ``last`` no prefix is open."""
    ends: dict[int, list[tuple[bytes, dict]]] = {}
    for path, entries in items:
        for e in entries:
            ends.setdefault(e["depth"], []).append((path, e))
    edges = [] if last else sorted({min(p for p, _ in items), max(p for p, _ in items)})
    open_keys = [{key_at(p, d) for p in edges if d * PATH_STEP <= len(p)} for d in range(max(map(len, edges), default=-1) // PATH_STEP + 1)]
    left: dict[tuple[int, bytes], dict] = {}
    survivors: dict[bytes, Node] = {}
    waiting: list[tuple[bytes, dict]] = []  # the level below, waiting for its parents' smallest members
    for depth in range(max(ends), -1, -1):
        level = survivors
        for path, e in ends.pop(depth, ()):
            node = level.setdefault(key_at(path, depth), Node(path))
            node.add(e["n_convs"], e["conv_id"], e["n_children"], e["n_leaves"], e["saved"])
            node.ends = node.ends or e["ends"]
        for parent, record in waiting:
            if depth < len(open_keys) and parent in open_keys[depth]:
                yield record | {"kind": ORPHAN, "parent_key": parent}
            else:
                yield record | {"parent_conv_id": level[parent].conv_id}
        survivors, waiting = {}, []
        for key, node in level.items():
            if depth < len(open_keys) and key in open_keys[depth]:
                left[depth, key] = {"depth": depth, "n_convs": node.n_convs, "conv_id": node.conv_id, "n_children": node.n_children,
                                    "n_leaves": node.n_leaves, "saved": node.saved, "ends": node.ends}
                continue
            leaves = node.n_leaves if node.n_children else 1
            saved = node.saved + (node.n_convs - 1) * size_at(node.path, depth)
            record = {"kind": NODE, "key": key, "conv_id": node.conv_id, "depth": depth, "n_convs": node.n_convs,
                      "n_children": node.n_children, "n_leaves": leaves, "saved_tokens": saved, "ends": node.ends or NO_IDS}
            if not depth:
                yield record
                continue
            parent = key_at(node.path, depth - 1)
            waiting.append((parent, record))
            survivors.setdefault(parent, Node(node.path)).add(node.n_convs, node.conv_id, 1, leaves, saved)
    for path in edges:
        mine = [left.pop((d, k)) for d in range(len(path) // PATH_STEP + 1) if (d, k := key_at(path, d)) in left]
        if mine:
            yield {"kind": LEFT, "path": path, "entries": mine}
    for keys in open_keys:
        yield from ({"kind": OPEN, "key": k} for k in keys)


def peeled(items: DataFrame, last: bool) -> DataFrame:
    """Each partition of ``items`` peeled as one run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        if not held:
            return
        number, rows = TaskContext.get().partitionId(), []
        for record in peel(held, last):
            rows.append(record | {"run": number})
            if len(rows) == 5_000:
                yield pa.RecordBatch.from_pylist(rows, schema=OUT)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=OUT)

    return items.mapInArrow(run, OUT_SQL)


def prefix_trie(conv_paths: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Per node: conv_id (its smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    name = f"trie-{uuid.uuid4().hex[:8]}"
    items, rounds = stored(items_of(conv_paths), f"{name}-items"), []
    while True:
        n, size = items.agg(F.count("*"), F.coalesce(F.sum(F.length("path") + 64 * F.size("entries")), F.lit(0))).first()
        runs = min(-(-size // run_bytes), n // LEAST_ITEMS)
        last = runs < 2
        dealt = items.repartition(1) if last else items.repartitionByRange(runs, "path")
        rounds.append(stored(peeled(dealt, last), f"{name}-round"))
        if last:
            break
        items = rounds[-1].filter(F.col("kind") == LEFT).select("path", "entries")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
               F.col("ends").alias("ends_sha256")]
    nodes = None
    later = None  # key and smallest member of the nodes closed in later rounds
    for found in reversed(rounds):
        parts = [found.filter(F.col("kind") == NODE).select(*columns)]
        if later is not None:
            opened = found.filter(F.col("kind") == OPEN).select("run", F.col("key").alias("parent_key")).join(
                later.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found_parent")), "parent_key")
            orphans = found.filter(F.col("kind") == ORPHAN).drop("parent_conv_id").join(opened, ["run", "parent_key"])
            parts.append(orphans.withColumnRenamed("found_parent", "parent_conv_id").select(*columns))
        own = found.filter(F.col("kind") <= ORPHAN).select("key", "conv_id")
        later = own if later is None else later.unionByName(own)
        for part in parts:
            nodes = part if nodes is None else nodes.unionByName(part)
    return nodes


SQL = f"""WITH placed AS (
  SELECT conv_id AS c, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS v,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(v ORDER BY i) AS p, {sql_crc32("c::VARCHAR")} % {MOST_SHARED} AS h FROM placed GROUP BY c),
rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.p[1:o.h], []), o.p[o.h + 1:]) AS p
  FROM own o LEFT JOIN own b ON b.c = o.c - o.c % {FAMILY}),
prefixes AS (
  SELECT c, d, sha256(to_json(p[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN sha256(to_json(p[1:d - 1])::VARCHAR) END AS up,
         CASE WHEN d > 0 THEN strlen(p[d].x) ELSE 0 END AS size, d = len(p) AS ends
  FROM (SELECT c, p, unnest(range(0, len(p) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT k, d, any_value(up) AS up, any_value(size) AS size, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY k, d),
children AS (SELECT up, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT a.k, count(*) FILTER (c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved_tokens
  FROM nodes n JOIN prefixes a ON a.c = n.conv_id AND a.d <= n.d LEFT JOIN children c ON c.up = n.k GROUP BY a.k)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b USING (k) LEFT JOIN children c ON c.up = n.k LEFT JOIN nodes p ON p.k = n.up"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt_paths(table(spark, sf_dir, "conversations")))
