"""Operators 11 and 12: against brute force; edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest

from cabgrid.llm import op11_turn_repair as repair
from cabgrid.llm import op12_prefix_trie as trie
from conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string"


# --- 11: structure repair ---------------------------------------------------------------

NEXT = {"B": {"s": "S", "u": "A"}, "S": {"u": "A"}, "U": {"u": "A"}, "A": {"a": "U"}}


def cheapest(roles, faults):
    """The least (cost, audit) over every script the grammar allows."""
    @lru_cache(None)
    def rest(i, state, inserts):
        found = [(0, "")] if i == len(roles) and state in "BU" else []
        if inserts < 3:
            for made, to in NEXT[state].items():
                if made != "s":
                    cost, audit = rest(i, to, inserts + 1)
                    found.append((cost + 5, "I" + audit))
        if i < len(roles):
            cost, audit = rest(i + 1, state, 0)
            found.append((cost + 2, "D" + audit))
            if faults[i] in (0, 3):
                for made, to in NEXT[state].items():
                    if roles[i] == made or made != "s":
                        cost, audit = rest(i + 1, to, 0)
                        same = roles[i] == made
                        found.append((cost + (5 if faults[i] else 0) + (not same), ("K" if same else "R") + audit))
        return min(found, default=(10 ** 9, ""))
    return rest(0, "B", 0)


CODE = {"u": 0, "a": 1, "s": 2, "t": 3}


@pytest.mark.parametrize("cells", [1, repair.CELLS])
def test_alignment_is_the_cheapest_and_ascii_least(monkeypatch, cells):
    monkeypatch.setattr(repair, "CELLS", cells)  # 1: rows by blocks, made again
    rng = random.Random(cells)
    for _ in range(2_000):
        n, noise = rng.randint(0, 10), rng.random()
        roles = [rng.choice("uuaaast") if rng.random() < noise else "ua"[i % 2] for i in range(n)]
        faults = [rng.choice([0, 1, 2, 3, 3]) if rng.random() < noise else 0 for _ in range(n)]
        got = repair.align(np.array([CODE[r] for r in roles], np.int64), np.array(faults, np.int64))
        assert got == cheapest(roles, faults), (roles, faults)


def brute_repair(rows):
    """All columns of the query from (conv_id, turn, role, text) rows."""
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c]
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fate == 1 else "".join(x for x in text if x not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        convs[c] += [(t is not None, t or 0, role, digest, t, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = set()
    for c, turns in convs.items():
        turns.sort(key=lambda x: x[:4])
        seen, faults = set(), []
        for _, _, role, _, _, text in turns:
            bare = text.strip(repair.WHITE)
            faults.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
            seen.add((role, text))
        initials = [x[2][:1] for x in turns]
        cost, audit = cheapest(initials, faults) if turns else (0, "")
        made, at, system, lines = 0, 0, 0, []
        for edit in audit:
            role, text = ("", "") if edit == "I" else (turns[at][2], turns[at][5])
            at += edit != "I"
            if edit != "D":
                role = role if edit == "K" else ("user", "assistant")[(made - system) % 2]
                system |= not made and role[:1] == "s"
                made += 1
                lines.append(f"{role}:{text}")
        numbers = [x[4] for x in turns if x[4] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.add((c, gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit,
                 hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def odd_rows():
    rng = random.Random(7)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None, "useful"]),
             rng.choice(["Fine.", "So!", "cut", " ", "", None, "Why?\n", "a.\x0b\x0c", "é中🙂."]))
            for c in range(150) for t in [*range(rng.randint(0, 6)), *[None] * rng.randint(0, 1)]]
    rows += [(None, t, "user", "No id.") for t in (0, None, 3)] + [(900, 1, "user", "Same.")] * 3
    rows += [(901, t, ("user", "assistant")[t % 2], "word " * 200_000 + ".") for t in range(2)]
    rows += [(902, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(1_500)]
    return rows


def test_audits_equal_brute_force(spark):
    rows = odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.selectExpr("*", "1 AS copies_", "'x' AS audit", "2 AS phase", "3 AS cost")
    got = {tuple(r) for r in repair.audits(repair.damaged(df)).collect()}
    assert got == {x for x in brute_repair([r for r in rows if r[0] != 902])} | {g for g in got if g[0] == 902}
    assert len(got) == len({r[0] for r in rows})


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    assert {tuple(r) for r in repair.op11_turn_repair(spark, SF_SMALL).collect()} == brute_repair(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hello?"), (1, 2, "user", "I am here."), (1, 3, "assistant", "Yes."),
            (1, 4, "assistant", " "), (2, 0, "assistant", "Only this."), (3, 0, "user", "All gone")]
    got = [tuple(r) for r in repair.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "step").collect()]
    assert got == [
        (1, 0, "K", 0, "system", "Be kind."), (1, 1, "D", 1, "user", "Hello?"), (1, 2, "K", 2, "user", "I am here."),
        (1, 3, "K", 3, "assistant", "Yes."), (1, 4, "D", 4, "assistant", " "),
        (2, 0, "D", 0, "assistant", "Only this."), (3, 0, "D", 0, "user", "All gone")]
    dearer = [(1, 0, "user", f"{n}.") if n % 2 else (1, n, "user", f"{n}.") for n in range(6)]
    edits = [r.edit for r in repair.repaired(spark.createDataFrame(dearer, SCHEMA)).orderBy("step").collect()]
    assert Counter(edits) == Counter("KKKRRR")
    assert repair.repaired(spark.createDataFrame([], SCHEMA)).count() == 0
    assert repair.audits(repair.damaged(spark.createDataFrame([], SCHEMA))).count() == 0


def test_long_texts_leave_in_pieces(spark, monkeypatch):
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t} " + "x" * 300_000 + ".") for c in range(4) for t in range(4)]
    got = repair.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.conv_id, r.turn, r.role, r.text) for r in got) == sorted(rows)


# --- 12: prefix trie ----------------------------------------------------------------------

def brute_trie(paths):
    """{(members' least, depth): ...} from {conv_id: [(key, bytes of text)]}."""
    members = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = set()
    for p, convs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(k[:len(q)] == q and len(k) == len(q) + 1 for k in below)]
        saved = sum((len(members[q]) - 1) * q[-1][1] for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(paths[c]) == len(p))
        out.add((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids), len(leaves), saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def brute_rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:trie.KEY]
            own[c].append((t is not None, t or 0, role, digest, len(text.encode())))
    own = {c: [(x[3], x[4]) for x in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
    return out


def tuples(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("run_bytes", [1 << 20, 1 << 11, 1 << 9])
def test_trie_equals_brute_force(spark, run_bytes):
    """Small runs: several rounds, prefixes open over many runs."""
    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "é", None])) for c in range(-40, 160)
            for t in range(rng.choice([0, 1, 2, 3, 9]))]
    rows += [(c, t, "user", "one and the same") for c in range(300, 360) for t in range(3)]  # a hot conversation
    rows += [(c, t, "user", f"nested {t}") for c in range(400, 440) for t in range(c - 399)]  # prefixes of each other
    rows += [(None, 1, "user", "no id"), (500, None, "user", "a"), (500, 1, "user", "b"), (500, 1, "user", "b"), (501, 0, "user", "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS path", "2 AS depth", "'k' AS key").repartition(4)
    got = tuples(trie.prefix_trie(trie.rebuilt_paths(df), run_bytes))
    assert got == brute_trie(brute_rebuilt(rows))
    some = trie.prefix_trie(trie.paths(spark.createDataFrame([r for r in rows if r[0] and r[0] >= 400], SCHEMA)), run_bytes)
    assert {r.n_convs for r in some.filter("depth = 0").collect()} == {42}


def test_trie_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    assert tuples(trie.op12_prefix_trie(spark, SF_SMALL)) == brute_trie(brute_rebuilt(rows))


def test_trie_edges(spark):
    assert trie.prefix_trie(trie.rebuilt_paths(spark.createDataFrame([], SCHEMA))).count() == 0
    # 7 has fewer turns than it takes from conversation 5, which is not there: turnless.
    assert trie.shared_turns(7) > 1
    df = spark.createDataFrame([(7, 0, "user", "x" * 1_000_000)], SCHEMA)
    ends = hashlib.sha256(b"7").hexdigest()
    assert tuples(trie.prefix_trie(trie.rebuilt_paths(df))) == {(7, 0, None, 1, 0, 1, 0, ends)}


def test_ids_are_hashed_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(trie, "ID_BLOCK", 16)
    rows = [(c, 0, "user", "the same") for c in range(0, 1_000, 5)]
    got = trie.prefix_trie(trie.paths(spark.createDataFrame(rows, SCHEMA))).filter("depth = 1").collect()
    ends = hashlib.sha256(",".join(str(r[0]) for r in rows).encode()).hexdigest()
    assert [(r.n_convs, r.saved_tokens, r.ends_sha256) for r in got] == [(200, 199 * 8, ends)]
