"""Conversation structure repair by target alignment (operator 11).

The turns of a conversation are aligned with every feasible length of the
grammar ``(s?(ua)+)?`` (an optional system turn, then user and assistant in
turn), Wagner-Fischer with these edits: Keep 0, Rerole 1, Delete 2 (a must for
blank and duplicate turns), Insert an empty turn 5; a truncated turn that stays
costs 5 more. All lengths share one matrix: what is left of a target is
"..ua" of some length r, so cell (i, r) holds the cost of turning turns i.. into
the last r roles, and a target's cost is read at (0, r), or behind the turn kept
as system. Ukkonen bands: with an incumbent cost U (a script made greedily),
only r in [n - i - U/2, n - i + U/5] can matter. The audits (initials of the
edits) of all cheapest targets are then traced side by side and compared letter
by letter; the ASCII-least stays.

Distribution. Each turn becomes a narrow row (flags and a digest) and a wide one
(the text). They are dealt by conversation, narrow rows before wide ones: a task
reads a conversation's flags, aligns, and then lets the texts stream past the
audit. So of a conversation, however long its texts, a task holds some 100 bytes
a turn, and the matrix by blocks of rows (CELLS at most for short conversations,
else about sqrt(n) rows, made again when the trace comes to them). Small
patterns of flags are remembered.

Edge cases: nulls in role or text are one space, and so are those of conv_id and
turn where they are spelt out (``damaged``); rows with a null conv_id are one
conversation; null turns come first, turns of equal number are ordered by role,
then by digest; exact repetitions are duplicates; conversations without turns
keep their summary row (see ``copies`` in ``repaired``); columns of other names
are untouched; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import sql_crc32, table
from .textscan import slices

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
FINE, BLANK, DUPLICATE, CUT = range(4)
WHITE = " \t\n\x0b\x0c\r"
CELLS = 1 << 21
MEMO, MEMO_TURNS = 100_000, 64
OUT_BYTES = 4 << 20
FAR = 1 << 40
ROLES = {0: "user", 1: "assistant"}
CODES = {"u": 0, "a": 1, "s": 2}
LEGAL = {"su", "ua", "au"}
_KNOWN: dict[tuple[bytes, bytes], tuple[int, str]] = {}


# --- alignment ------------------------------------------------------------------------

def greedy_cost(roles: np.ndarray, faults: np.ndarray) -> int:
    """The cost of one valid script: every faulty turn goes, roles are rewritten
    to alternate, an odd turn at the end goes."""
    kept = roles[faults == FINE]
    cost = DELETE * (len(roles) - len(kept))
    head = int(len(kept) > 2 and kept[0] == 2)
    rest = kept[head:]
    even = len(rest) // 2 * 2
    cost += DELETE * (len(rest) - even) + REROLE * int((rest[:even] != np.arange(even) % 2).sum())
    return min(cost, DELETE * len(roles))


class Matrix:
    """Rows of the alignment matrix inside the band, from the last turn up."""

    def __init__(self, roles: np.ndarray, faults: np.ndarray):
        self.n, bound = len(roles), greedy_cost(roles, faults)
        self.below, self.above = bound // DELETE, bound // INSERT
        stay = np.where(faults == CUT, TRUNCATED, 0) + np.where((faults == BLANK) | (faults == DUPLICATE), FAR, 0)
        self.keep = (stay + KEEP).tolist()
        self.cost = [np.where(roles == role, stay + KEEP, stay + REROLE).tolist() for role in (0, 1)]
        self.system = (roles == 2).tolist()
        # Cost of the rest if nothing has been put out yet and a system turn is to come.
        self.pending = [FAR] * (self.n + 1)
        width = self.below + self.above + 1
        self.step = self.n + 1 if (self.n + 1) * width <= CELLS else isqrt(self.n) + 1
        self.marks: dict[int, tuple[int, np.ndarray]] = {}
        self.block: dict[int, tuple[int, np.ndarray]] = {}
        row = self._first()
        for i in range(self.n, -1, -1):
            if i < self.n:
                self.pending[i] = self._pending(i, row)
                row = self._row(i, row)
            if self.step > self.n:
                self.block[i] = row
            elif i % self.step == 0:
                self.marks[i] = row

    def _bounds(self, i: int) -> tuple[int, int]:
        return max(0, self.n - i - self.below), self.n - i + self.above

    def _first(self) -> tuple[int, np.ndarray]:
        low, high = self._bounds(self.n)
        return low, INSERT * np.arange(low, high + 1, dtype=np.int64)

    def _row(self, i: int, under: tuple[int, np.ndarray]) -> tuple[int, np.ndarray]:
        low, high = self._bounds(i)
        r = np.arange(low, high + 1)
        change = np.where(r % 2 == 0, self.cost[0][i], self.cost[1][i])
        best = np.minimum(at(under, low, high) + DELETE, at(under, low - 1, high - 1) + change)
        return low, np.minimum.accumulate(best - INSERT * r) + INSERT * r

    def _pending(self, i: int, under: tuple[int, np.ndarray]) -> int:
        """``under``: row i + 1."""
        gone = DELETE + self.pending[i + 1]
        if not self.system[i] or self.keep[i] >= FAR:
            return gone
        return min(gone, self.keep[i] + least_even(under, 2))

    def __getitem__(self, i: int) -> tuple[int, np.ndarray]:
        if i not in self.block:  # rows down from the next mark, made again
            base = i // self.step * self.step
            top = min(base + self.step, self.n)
            row = self.marks[top] if top in self.marks else self._first()
            self.block = {top: row}
            for k in range(top - 1, base - 1, -1):
                row = self.block[k] = self._row(k, row)
        return self.block[i]


def at(row: tuple[int, np.ndarray], low: int, high: int) -> np.ndarray:
    """A row's cells low..high; what lies outside its band is FAR."""
    start, cells = row
    out = np.full(high - low + 1, FAR, np.int64)
    a, b = max(low, start), min(high, start + len(cells) - 1)
    if a <= b:
        out[a - low:b - low + 1] = cells[a - start:b - start + 1]
    return out


def least_even(row: tuple[int, np.ndarray], least: int) -> int:
    """The least cell of an even length of at least ``least``."""
    first = max(least, row[0] + row[0] % 2)
    return int(row[1][first - row[0]::2].min(initial=FAR))


def align(roles: np.ndarray, faults: np.ndarray) -> tuple[int, str]:
    """(cost, audit): the cheapest script over all feasible lengths, of equally
    cheap ones that with the ASCII-least audit."""
    n, matrix = len(roles), Matrix(roles, faults)
    low, cells = matrix[0]
    total = min(matrix.pending[0], least_even(matrix[0], 0))
    pending = matrix.pending[0] == total
    live = (cells == total) & (np.arange(low, low + len(cells)) % 2 == 0)  # the cheapest lengths
    audit: list[str] = []
    i = 0
    while True:
        low, cells = matrix[i]
        r = np.arange(low, low + len(cells))
        if i < n:
            under = matrix[i + 1]
            high = low + len(cells) - 1
            gone = live & (cells == at(under, low, high) + DELETE)
            held = pending and matrix.pending[i] == DELETE + matrix.pending[i + 1]
            if held or gone.any():
                audit.append("D")
                live, pending, i = moved(gone, low, under), held, i + 1
                continue
        elif live[0]:  # r = 0: nothing is left to add
            return total, "".join(audit)
        added = live & (cells == at((low, cells), low - 1, low + len(cells) - 2) + INSERT)
        if added.any():
            audit.append("I")
            live, pending = np.append(added[1:], False), False
            continue
        change = np.where(r % 2 == 0, matrix.cost[0][i], matrix.cost[1][i])
        taken = live & (cells == at(under, low - 1, low + len(cells) - 2) + change)
        kept = taken & (r % 2 == roles[i])
        first = pending and matrix.system[i] and matrix.keep[i] < FAR
        if first:
            rest = matrix.pending[i] - matrix.keep[i]
            even = np.arange(under[0], under[0] + len(under[1]))
            starts = (under[1] == rest) & (even % 2 == 0) & (even >= 2)
        if kept.any() or first and starts.any():
            audit.append("K")
            live = moved(kept, low - 1, under)
            if first:
                live |= starts
        else:
            audit.append("R")
            live = moved(taken, low - 1, under)
        pending, i = False, i + 1


def moved(live: np.ndarray, low: int, row: tuple[int, np.ndarray]) -> np.ndarray:
    """Marks of lengths low.. in the band of another row."""
    out = np.zeros(len(row[1]), bool)
    hit = np.flatnonzero(live) + low - row[0]
    out[hit[(hit >= 0) & (hit < len(out))]] = True
    return out


def aligned(roles: list[int], faults: list[int]) -> tuple[int, str]:
    """``align``, short patterns remembered."""
    key = (bytes(roles), bytes(faults))
    if key in _KNOWN:
        return _KNOWN[key]
    found = align(np.array(roles, np.int64), np.array(faults, np.int64))
    if len(roles) <= MEMO_TURNS:
        if len(_KNOWN) >= MEMO:
            _KNOWN.clear()
        _KNOWN[key] = found
    return found


# --- conversations --------------------------------------------------------------------

class Conversation:
    """One conversation's flags, then its audit and the place reached in it."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.roles, self.faults, self.seen = [], [], set()
        self.turns: list[int] = []  # least, latest, distinct
        self.illegal, self.before = 0, None
        self.audit: str | None = None
        self.at = self.made = 0
        self.system = False

    def note(self, turn: int | None, initial: str, digest: bytes, blank: bool, cut: bool, copies: int) -> None:
        if copies and turn is not None:
            if not self.turns:
                self.turns = [turn, turn, 1]
            elif turn != self.turns[1]:
                self.turns[1:] = [turn, self.turns[2] + 1]
        for _ in range(copies):
            self.faults.append(BLANK if blank else DUPLICATE if digest in self.seen else CUT if cut else FINE)
            self.seen.add(digest)
            self.roles.append(CODES.get(initial, 3))
            self.illegal += self.before is not None and self.before + initial not in LEGAL
            self.before = initial

    def solve(self) -> None:
        if self.audit is None:
            self.cost, self.audit = aligned(self.roles, self.faults)
            self.seen = set()

    def _role(self) -> str:
        return ROLES[(self.made - self.system) % 2]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The (edit, role, text) of the turns that come in here."""
        self.solve()
        while self.audit[self.at:self.at + 1] == "I":
            yield "I", self._role(), ""
            self.at, self.made = self.at + 1, self.made + 1

    def turn(self, role: str, text: str) -> tuple[str, str, str]:
        """The (edit, role, text) of the next turn."""
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            if edit == "R":
                role = self._role()
            self.system |= not self.made and role[:1] == "s"
            self.made += 1
        return edit, role, text

    def summary(self) -> tuple:
        gaps = self.turns[1] - self.turns[0] + 1 - self.turns[2] if self.turns else 0
        return (self.conv_id, gaps, *(self.faults.count(f) for f in (BLANK, DUPLICATE, CUT)), self.illegal, self.cost, self.audit)


def _dealt(turns: DataFrame) -> DataFrame:
    """The narrow and the wide rows, by conversation, narrow ones first."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    bare = F.rtrim(text, F.lit(WHITE))
    number = F.col("turn").cast("long")
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    nothing = F.lit(None).cast("string")
    d = turns.select(F.col("conv_id").cast("long").alias("conv_id"), number.alias("turn"), role.alias("role"), text.alias("text"),
                     digest.alias("digest"), bare.alias("bare"), copies.alias("copies"))
    d = d.select("conv_id", "turn", "role", "digest", "copies", F.explode(F.array(
        F.struct(F.lit(0).alias("phase"), (F.length("bare") == 0).alias("blank"),
                 (~F.right("bare", F.lit(1)).isin(".", "!", "?")).alias("cut"), nothing.alias("text")),
        F.struct(F.lit(1).alias("phase"), F.lit(False).alias("blank"), F.lit(False).alias("cut"), F.col("text")))).alias("is"))
    return (d.select("conv_id", "is.phase", "turn", "role", "digest", "copies", "is.blank", "is.cut", "is.text")
            .filter((F.col("phase") == 0) | (F.col("copies") > 0)).repartition("conv_id")
            .sortWithinPartitions("conv_id", "phase", F.asc_nulls_first("turn"), "role", "digest"))


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Conversation, tuple | None]]:
    """Of each conversation in turn: every edit as (edit, turn, role, text),
    then None when it is over."""
    c = None
    for batch in slices(batches, 8):
        for conv_id, phase, turn, role, digest, copies, blank, cut, text in zip(*(x.to_pylist() for x in batch.columns)):
            if c is None or c.conv_id != conv_id:
                if c is not None:
                    yield from _last(c)
                c = Conversation(conv_id)
            if not phase:
                c.note(turn, role[:1], digest, blank, cut, copies)
                continue
            for _ in range(copies):
                for edit, *rest in c.inserted():
                    yield c, (edit, None, *rest)
                edit, *rest = c.turn(role, text)
                yield c, (edit, turn, *rest)
        yield c, ()  # a slice is over: results may go
    if c is not None:
        yield from _last(c)


def _last(c: Conversation) -> Iterator[tuple[Conversation, tuple | None]]:
    for edit, *rest in c.inserted():
        yield c, (edit, None, *rest)
    yield c, None


def repaired(turns: DataFrame) -> DataFrame:
    """Per edit of each conversation, in order: conv_id, step (from 0), edit
    (K, R, D, I), turn (null where inserted), role and text (after the edit; of
    a deleted turn its own). ``turns``: conv_id, turn, role, text, and maybe
    ``copies`` (how often a row counts; 0: not at all)."""
    names = ["conv_id", "step", "edit", "turn", "role", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, before, step = [], 0, None, 0
        for c, edit in _edits(batches):
            if edit:
                step = step + 1 if c is before else 0
                before = c
                rows.append((c.conv_id, step, *edit))
                size += len(edit[3])
            if rows and (size > OUT_BYTES or edit == () or len(rows) >= 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    return _dealt(turns).mapInArrow(run, "conv_id long, step long, edit string, turn long, role string, text string")


def audits(turns: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, and repaired_sha256 of the turns that ``repaired`` leaves
    (``role:text``, joined by newlines)."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    types = [pa.int64()] * 7 + [pa.string()] * 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, digest, some = [], hashlib.sha256(), False
        for c, edit in _edits(batches):
            if edit is None:
                rows.append((*c.summary(), digest.hexdigest()))
                digest, some = hashlib.sha256(), False
            elif edit and edit[0] != "D":
                digest.update(f"{chr(10) * some}{edit[2]}:{edit[3]}".encode())
                some = True
            if len(rows) >= 2_000 or rows and edit == ():
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)
                rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names)

    return _dealt(turns).mapInArrow(run, ", ".join(f"{n} {'long' if t == pa.int64() else 'string'}" for n, t in zip(names, types)))


# --- the query --------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies: of 20 values of
    ``crc32(conv_id:turn)`` 0 drops a row (no copies), 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 makes its role user."""
    def spelt(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(spelt("conv_id"), F.lit(":"), spelt("turn"))) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))


#: The automaton of the grammar, turn by turn: B nothing put out yet, S a system
#: turn, A an assistant turn is due, U a user turn or the end; the cheapest
#: (cost, audit) of each.
SQL = f"""WITH fates AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {sql_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
  FROM conversations),
spoilt AS (
  SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fates),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM spoilt),
flagged AS (
  SELECT *, CASE WHEN bare = '' THEN 1
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM placed),
seen AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal,
         list({{'c': left(role, 1), 'f': fault}} ORDER BY i) AS turns
  FROM flagged GROUP BY conv_id),
states AS (
  SELECT *, list_reduce(list_concat([{{'c': '', 'f': -1, 'b': {{'n': 0, 'e': ''}}, 's': {{'n': {FAR}, 'e': ''}},
                                      'a': {{'n': {FAR}, 'e': ''}}, 'u': {{'n': {FAR}, 'e': ''}}}}],
      list_transform(list_concat(turns, [{{'c': '', 'f': 9}}]), lambda t: {{'c': t.c, 'f': t.f, 'b': {{'n': 0, 'e': ''}}, 's': {{'n': 0, 'e': ''}},
                                      'a': {{'n': 0, 'e': ''}}, 'u': {{'n': 0, 'e': ''}}}})),
    lambda x, t: list_transform([{{
        'b': x.b, 's': x.s,
        'a': list_sort([x.a, {{'n': x.b.n + 5, 'e': x.b.e || 'I'}}, {{'n': x.s.n + 5, 'e': x.s.e || 'I'}}, {{'n': x.u.n + 5, 'e': x.u.e || 'I'}}])[1],
        'u': list_sort([x.u, {{'n': x.a.n + 5, 'e': x.a.e || 'I'}}, {{'n': x.b.n + 10, 'e': x.b.e || 'II'}}, {{'n': x.s.n + 10, 'e': x.s.e || 'II'}}])[1],
        'k': CASE t.f WHEN 0 THEN 0 WHEN 3 THEN 5 ELSE {FAR} END}}],
      lambda y: CASE WHEN t.f = 9 THEN {{'c': '', 'f': 9, 'b': y.b, 's': y.s, 'a': y.a, 'u': y.u}} ELSE {{
        'c': '', 'f': 0,
        'b': {{'n': y.b.n + 2, 'e': y.b.e || 'D'}},
        's': list_sort([{{'n': y.s.n + 2, 'e': y.s.e || 'D'}}, {{'n': CASE WHEN t.c = 's' THEN y.b.n + y.k ELSE {FAR} END, 'e': y.b.e || 'K'}}])[1],
        'a': list_sort([{{'n': y.a.n + 2, 'e': y.a.e || 'D'}}, {{'n': y.b.n + y.k + CASE WHEN t.c = 'u' THEN 0 ELSE 1 END, 'e': y.b.e || CASE WHEN t.c = 'u' THEN 'K' ELSE 'R' END}},
             {{'n': y.s.n + y.k + CASE WHEN t.c = 'u' THEN 0 ELSE 1 END, 'e': y.s.e || CASE WHEN t.c = 'u' THEN 'K' ELSE 'R' END}},
             {{'n': y.u.n + y.k + CASE WHEN t.c = 'u' THEN 0 ELSE 1 END, 'e': y.u.e || CASE WHEN t.c = 'u' THEN 'K' ELSE 'R' END}}])[1],
        'u': list_sort([{{'n': y.u.n + 2, 'e': y.u.e || 'D'}}, {{'n': y.a.n + y.k + CASE WHEN t.c = 'a' THEN 0 ELSE 1 END, 'e': y.a.e || CASE WHEN t.c = 'a' THEN 'K' ELSE 'R' END}}])[1]
      }} END)[1]) AS z
  FROM seen),
solved AS (SELECT *, list_sort([z.b, z.u])[1] AS best FROM states),
steps AS (
  SELECT conv_id, step, best.e[step] AS edit,
         count(*) FILTER (best.e[step] <> 'I') OVER (PARTITION BY conv_id ORDER BY step) AS i,
         count(*) FILTER (best.e[step] <> 'D') OVER (PARTITION BY conv_id ORDER BY step) - 1 AS made
  FROM (SELECT conv_id, best, unnest(range(1, length(best.e) + 1)) AS step FROM solved)),
put AS (
  SELECT s.conv_id, s.step, s.edit, s.made, CASE s.edit WHEN 'I' THEN '' ELSE f.text END AS text, f.role,
         max(CASE WHEN s.edit = 'K' AND s.made = 0 AND left(f.role, 1) = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS head
  FROM steps s LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i
  WHERE s.edit <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (made - head) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || text,
                             chr(10) ORDER BY step) AS repaired
  FROM put GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.n, 0)::BIGINT AS cost,
       coalesce(best.e, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM c.conv_id"""


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits(damaged(table(spark, sf_dir, "conversations")))
