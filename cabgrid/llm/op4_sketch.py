"""Document fingerprints by invertible Bloom lookup sketches (operator 4,
DataFrame functions only).

A text's paragraphs are its lines, cut after every twelfth word; their 64-bit
digests form a set. A sketch has three subtables of 2**level cells; each
digest goes to one cell of each. A cell holds the count, the xor of the
digests and the xor of their checks. Sketches subtract cell by cell, so what
two versions share vanishes; cells with a count of one and a valid check are
peeled, which leaves others with one, until the differing digests are known.
If cells remain, the pair is sketched again, larger and with other hashes.

``fingerprint`` is the sketch of the whole set with seed 0, its level fitting the
set's size, as text: the level, then the cells in use (``packed``). It peels
alone (rare collisions apart), so it is all that a comparison needs: ``likeness``
reads nothing else.
``near_edited`` and ``near_next`` are shared / all paragraphs, from the two
sketches subtracted at the larger one's level and peeled; a pair that does not
peel (rare) is sketched again, larger and with other hashes.

Order: documents by descending doc_id (null last), equal ids by a hash of the
text, then by text; the last one's next is the first. Texts are shuffled once,
by ranges of that order (bounds from approximate percentiles; an id that fills
several ranges is dealt to them by the hash); each range also gets the first
document of the range that follows it. Peeling runs inside the same partitions, a grouped sum per subtable; a range's counts are an array by place.

Edge cases: null text is empty; an empty text has no paragraphs, and two of
them are alike (1.0); a single document is its own next; repeated rows are
documents of their own (only rows equal in doc_id and text are sure to share a
range); texts of any length are whole; other columns of any name are ignored; empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

PIECE = r"[^\x20\x09-\x0D]++(?:[\x20\x09\x0B-\x0D]++[^\x20\x09-\x0D]++){0,11}+"
LEAST_LEVEL = 4
PASSES = 6
RANGES_PER_PARTITION = 16
NO_ID = -(1 << 63)
MARK = -3
STATE = ["part", "place", "pair", "level"]


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PIECE), 0), lambda p: F.xxhash64(p)))


def check(key: str) -> str:
    return f"xxhash64({key}, 'check')"


def cell(key: str, sub: int | str, seed: int, level: str = "level") -> str:
    """Number of the key's cell in a subtable: subtable * 2**48 + place."""
    return f"({sub}L << 48) + (xxhash64({key}, {seed}L, {sub}L) & ((1L << {level}) - 1))"


def level_of(n: Column) -> Column:
    """Level of the sketch of n digests: 12 cells and more for each, so that
    two such sets without a common digest have six."""
    return F.greatest(F.lit(LEAST_LEVEL), F.ceil(F.log2(4.0 * n + 1)).cast("int"))


def packed(keys: Column) -> Column:
    """The sketch of a digest set (seed 0) as text: ``level;cell,cell,...``, all
    in hex, the cells in use in order, each ``subtable place:count:digests:checks``
    (no space after the subtable's digit)."""
    def write(keys, level):
        each = F.flatten(F.transform(keys, lambda d: F.transform(F.array(*[F.lit(s).cast("long") for s in range(3)]), lambda s: F.struct(
            (F.shiftleft(s, 48) + F.xxhash64(d, F.lit(0).cast("long"), s).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)).alias("cell"),
            d.alias("key")))))
        return _bind(F.sort_array(each), lambda e: _bind(
            # Where a cell's entries begin, and the end of them all.
            F.concat(F.filter(F.sequence(F.lit(1), F.size(e)), lambda i: (i == 1) | (F.get(e, i - 1)["cell"] != F.get(e, i - 2)["cell"])),
                     F.array(F.size(e) + 1)),
            lambda at: F.array_join(F.transform(F.slice(at, F.lit(1), F.size(at) - 1), lambda a, i: one(e, a, F.get(at, i + 1) - a)), ",")))

    def one(e, first, n):
        xor = lambda of: F.when(n == 1, of(F.get(e, first - 1)["key"])).otherwise(
            F.aggregate(F.slice(e, first, n), F.lit(0).cast("long"), lambda t, x: t.bitwiseXOR(of(x["key"]))))
        where = F.get(e, first - 1)["cell"]
        return F.concat(F.shiftright(where, 48).cast("string"), F.hex(where.bitwiseAND(F.lit((1 << 48) - 1))), F.lit(":"), F.hex(n), F.lit(":"),
                        F.hex(xor(lambda k: k)), F.lit(":"), F.hex(xor(lambda k: F.xxhash64(k, F.lit("check")))))

    return _bind(level_of(F.size(keys)), lambda level: F.concat(F.hex(level), F.lit(";"), F.when(F.size(keys) > 0, write(keys, level)).otherwise("")))


def unpacked(fingerprint: Column) -> tuple[Column, Column]:
    """Level and cells (cell, n, key, sum) of a fingerprint."""
    number = lambda text: F.conv(text, 16, -10).cast("long")
    parts = F.split(fingerprint, ";")

    def one(text):
        c = F.split(text, ":")
        place = F.shiftleft(F.substring(c[0], F.lit(1), F.lit(1)).cast("long"), 48) + number(F.substring(c[0], F.lit(2), F.length(c[0])))
        return F.struct(place.alias("cell"), number(c[1]).alias("n"), number(c[2]).alias("key"), number(c[3]).alias("sum"))

    return number(parts[0]).cast("int"), F.transform(F.filter(F.split(parts[1], ","), lambda t: t != ""), one)


def likeness(pairs: DataFrame) -> DataFrame:
    """place, near: shared / all paragraphs of pairs of fingerprints, from these
    alone (``pairs``: place, unique; left, right). Of unlike levels the smaller
    sketch is peeled and its digests sketched at the larger level. Null if a
    fingerprint is null or does not peel."""
    def side(name: str, n: int) -> Column:
        level, found = unpacked(F.col(name))
        return F.struct(F.lit(n).alias("sign"), level.alias("own"), found.alias("cells"))

    sides = (pairs.withColumn("s", F.array(side("left", 1), side("right", -1)))
             .select(F.lit(0).alias("part"), "place", F.greatest(F.col("s")[0]["own"], F.col("s")[1]["own"]).alias("level"), F.explode("s").alias("s"))
             .select("part", "place", "level", F.col("s.sign").alias("pair"), "s.own", F.explode_outer("s.cells").alias("c")))
    size = F.coalesce(F.sum(F.when(F.shiftright("c.cell", 48) == 0, F.col("c.n"))), F.lit(0))
    sizes = sides.filter("pair = 1").groupBy("place").agg(size.alias("mine"))
    used = sides.filter("c is not null")
    low = peel(used.filter("own < level").select("part", "place", "pair", F.col("own").alias("level"), "c.*"), 0, keep=True)
    high = used.filter("own = level").select("part", "place", F.lit(0).alias("pair"), "level", "c.cell", (F.col("c.n") * F.col("pair")).alias("n"), "c.key", "c.sum")
    stuck = low.filter("cell >= 0").select("place").distinct()
    levels = sides.select("place", F.col("level").alias("goal")).distinct()
    again = (low.filter("cell = -1").join(levels, "place").select("part", "place", F.lit(0).alias("pair"), F.col("goal").alias("level"), F.col("pair").cast("long").alias("n"), "key", "sum")
             .select("part", "place", "pair", "level", F.explode(F.array(*[F.expr(cell("key", s, 0)) for s in range(3)])).alias("cell"), "n", "key", "sum"))
    end = peel(_summed(high.unionByName(again)), 0)
    found = end.groupBy("place").agg(*[F.coalesce(F.sum(F.when(F.col("cell") == c, F.col("n"))), F.lit(0)).alias(name) for c, name in ((-1, "l"), (-2, "r"))],
                                     F.sum((F.col("cell") >= 0).cast("long")).alias("open"))
    none = stuck.withColumn("stuck", F.lit(True))
    rows = pairs.join(sizes, "place", "left").join(found, "place", "left").join(none, "place", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("l", "r", "open")})
    near = F.when(F.col("mine") + F.col("r") == 0, F.lit(1.0)).otherwise((F.col("mine") - F.col("l")).cast("double") / (F.col("mine") + F.col("r")))
    ok = F.col("left").isNotNull() & F.col("right").isNotNull() & (F.col("open") == 0) & F.col("stuck").isNull()
    return rows.select("place", F.when(ok, near).alias("near"))


def _bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cells(pairs: DataFrame, seed: int) -> DataFrame:
    """The subtracted sketches of pairs: STATE, cell, n, key, sum, and a row of
    cell MARK for every pair. ``pairs``: part, place, pair, level, left, right
    (digest arrays)."""
    signed = F.concat(F.transform("left", lambda d: F.struct(F.lit(1).alias("n"), d.alias("key"))),
                      F.transform("right", lambda d: F.struct(F.lit(-1).alias("n"), d.alias("key"))))
    signed = F.concat(signed, F.array(F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("key"))))
    each = pairs.select(*STATE, F.explode(signed).alias("e")).select(*STATE, "e.n", "e.key")
    rows = each.select(*STATE, "n", "key", F.expr(check("key")).alias("sum"),
                       F.explode(F.expr(f"if(n = 0, array({MARK}L), array({', '.join(cell('key', s, seed) for s in range(3))}))")).alias("cell"))
    return _summed(rows)


def _summed(rows: DataFrame, keep: bool = False) -> DataFrame:
    """Rows of one cell become one; with ``keep`` found digests stay apart."""
    apart = [F.when(F.col("cell").isin(-1, -2), F.col("key")).alias("digest")] if keep else []
    return (rows.groupBy(*STATE, "cell", *apart).agg(F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("sum").alias("sum"))
            .filter("cell < 0 or n <> 0 or key <> 0 or sum <> 0"))


def peel(state: DataFrame, seed: int, passes: int = PASSES, keep: bool = False) -> DataFrame:
    """Peels subtable after subtable. In one subtable a key has one cell, so a
    pass takes each key once: a pure cell is replaced by the key's removal from
    the two other subtables and by a found row, of cell -1 (left only) or -2
    (right only): n of them, or with ``keep`` one for each ``key``."""
    for p in range(passes):
        sub = p % 3
        pure = f"cell >= 0 and cell >> 48 = {sub} and abs(n) = 1 and sum = {check('key')}"
        away = [f"named_struct('cell', {cell('key', s, seed)}, 'n', -n, 'key', key, 'sum', sum)" for s in range(3) if s != sub]
        found = "named_struct('cell', if(n > 0, -1L, -2L), 'n', 1L, 'key', key, 'sum', sum)"
        kept = "named_struct('cell', cell, 'n', n, 'key', key, 'sum', sum)"
        rows = state.select(*STATE, F.explode(F.expr(f"if({pure}, array({found}, {', '.join(away)}), array({kept}))")).alias("e"))
        state = _summed(rows.select(*STATE, "e.cell", "e.n", "e.key", "e.sum"), keep)
    return state


def recovered(left: Column, right: Column, pairs: DataFrame, seed: int = 0) -> DataFrame:
    """place, digest, n (1: only in ``left``, -1: only in ``right``) of the
    differing paragraphs of version pairs, peeled; pairs whose cells do not all
    peel away are sketched again, larger and with other hashes, until they do.
    ``pairs``: place (unique), and what the columns read."""
    rows = pairs.select(F.lit(0).alias("part"), "place", F.lit(0).alias("pair"), left.alias("left"), right.alias("right"))
    out = None
    while True:
        state = stored(peel(cells(_levelled(rows, seed), seed), seed, keep=True), "peeled")
        open_ = state.filter("cell >= 0").select("place").distinct()
        found = (state.filter("cell in (-1, -2)").join(open_, "place", "left_anti")
                 .select("place", F.col("key").alias("digest"), F.when(F.col("cell") == -1, 1).otherwise(-1).alias("n")))
        out = found if out is None else out.unionByName(found)
        if open_.isEmpty():
            return out
        rows, seed = rows.join(open_, "place", "left_semi"), seed + 1


def _levelled(pairs: DataFrame, more: int = 0) -> DataFrame:
    """+ level: that of the larger one's fingerprint."""
    return pairs.withColumn("level", level_of(F.greatest(F.size("left"), F.size("right"))) + more)


def differences(pairs: DataFrame, seed: int = 0) -> DataFrame:
    """part, place, pair, only_left, only_right, open (cells left) of every pair."""
    state = peel(cells(_levelled(pairs, seed), seed), seed)
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return state.groupBy("part", "place", "pair").agg(
        count(F.col("cell") == -1).alias("only_left"), count(F.col("cell") == -2).alias("only_right"),
        F.sum((F.col("cell") >= 0).cast("long")).alias("open"))


def _likeness(left: Column, right: Column, only_left: Column, only_right: Column) -> Column:
    all_ = F.size(left) + only_right
    return F.when(all_ == 0, F.lit(1.0)).otherwise((F.size(left) - only_left).cast("double") / all_)


def _longs(values: list[int]) -> Column:
    """A constant array (one literal, however long)."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def in_order(docs: DataFrame) -> DataFrame:
    """part, place (unique in part), doc_id, text, next: each document with
    the text of the next one."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({"id": F.coalesce("doc_id", F.lit(NO_ID)), "tie": F.shiftrightunsigned(F.xxhash64("text"), 1)})
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    depth = max(1, (ranges - 1).bit_length())
    ranges = 1 << depth
    shares = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("id", shares, 20 * ranges)).first()[0]
    if bounds is None:
        bounds = [0] * (ranges - 1)
    # Binary search in the sorted bounds: how many are at most the id, how many below it.
    # (Plain steps: a lambda here would keep the two readers of the shuffle from sharing it.)
    table_ = _longs(bounds)
    rows = rows.withColumns({"own": F.lit(0), "least": F.lit(0)})
    for step in (1 << i for i in reversed(range(depth))):
        rows = rows.withColumns({c: F.when(under(F.element_at(table_, F.col(c) + step)), F.col(c) + step).otherwise(F.col(c))
                                 for c, under in (("own", lambda b: b <= F.col("id")), ("least", lambda b: b < F.col("id")))})
    # An id that is a bound (a frequent one: many) has the ranges from least to own, dealt by the hash.
    at = F.floor(F.shiftrightunsigned("tie", 10) / float(1 << 53) * (F.col("own") - F.col("least") + 1)).cast("int")
    rows = rows.withColumn("own", F.col("least") + F.least(at, F.col("own") - F.col("least")))
    # One row per range: its first document, and the range before it.
    tops = {r["own"]: r["top"] for r in rows.groupBy("own").agg(F.max(F.struct("id", "tie")).alias("top")).collect()}
    order = sorted(tops, reverse=True)
    before = {p: order[i - 1] for i, p in enumerate(order)}
    top, top_tie = (_longs([tops[p][c] if p in tops else NO_ID for p in range(ranges)]) for c in ("id", "tie"))
    goal = _longs([before.get(p, -1) for p in range(ranges)]).cast("array<int>")
    here = F.array(F.struct(F.col("own").alias("part"), F.lit(0).alias("guest")))
    there = F.array(F.struct(F.element_at(goal, F.col("own") + 1).alias("part"), F.lit(1).alias("guest")))
    first = (F.element_at(top, F.col("own") + 1) == F.col("id")) & (F.element_at(top_tie, F.col("own") + 1) == F.col("tie"))
    # What is shuffled is what every reader of it needs, so it is shuffled once.
    dealt = rows.select("doc_id", "text", "tie", F.explode(F.when(first, F.concat(here, there)).otherwise(here)).alias("p"))
    along = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc(), "text")
    return (dealt.filter("p.part is not null")  # as the optimizer puts it on a join's other side
            .select(F.col("p.part").alias("part"), F.col("p.guest").alias("guest"), "doc_id", "text", "tie")
            .select("part", "guest", "doc_id", "text", F.row_number().over(along).alias("place"), F.lead("text").over(along).alias("next"))
            .filter("guest = 0").drop("guest"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next."""
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half), F.substring(F.col("next"), F.lit(1), half))
    versions = (in_order(docs).withColumn("edited", edited)
                .select("part", "place", "doc_id", F.char_length("text").cast("long").alias("n_chars"),
                        F.sha2("edited", 256).alias("edited_sha256"),
                        digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), digests(F.col("next")).alias("b")))
    def pairs(rows: DataFrame) -> DataFrame:
        return rows.select("part", "place", F.explode(F.array(
            F.struct(F.lit(0).alias("pair"), F.col("a").alias("left"), F.col("e").alias("right")),
            F.struct(F.lit(1).alias("pair"), F.col("a").alias("left"), F.col("b").alias("right")))).alias("p")).select("part", "place", "p.*")

    def merged(rows: DataFrame, found: DataFrame) -> DataFrame:
        """The two pairs' counts beside each document, which keeps the digests
        that its fingerprints are packed from."""
        names = [f"{c}_{p}" for p in (0, 1) for c in ("only_left", "only_right", "open")]
        per = found.groupBy("part", "place").agg(*[
            F.coalesce(F.sum(F.when(F.col("pair") == int(c[-1]), F.col(c[:-2]))), F.lit(0)).alias(c) for c in names])
        # One array per range, in order of place (1, 2, ...): the join keeps the partitioning by range on both sides.
        per = per.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", *names))).alias("counts"))
        full = rows.join(per, "part").withColumn("c", F.element_at("counts", F.col("place")))
        full = full.withColumns({c: F.col("c")[c] for c in names})
        ok = (F.col("open_0") + F.col("open_1")) == 0
        near = [F.when(ok, _likeness(F.col("a"), F.col(r), F.col(f"only_left_{p}"), F.col(f"only_right_{p}"))) for p, r in ((0, "e"), (1, "b"))]
        return full.select("part", "place", "doc_id", "n_chars", "edited_sha256", near[0].alias("near_edited"), near[1].alias("near_next"),
                           (~ok).alias("open"), "a", "e", F.when(~ok, F.col("b")).alias("b"))

    out = stored(merged(versions, differences(pairs(versions))), "sketches")
    done, seed = out.filter("not open"), 0
    while not (left := out.filter("open")).isEmpty():
        seed += 1
        left = left.withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy("place")))
        out = stored(merged(left, differences(pairs(left), seed)), "sketches")
        done = done.unionByName(out.filter("not open"))
    return done.select("doc_id", "n_chars", "edited_sha256", packed(F.col("a")).alias("fingerprint"), packed(F.col("e")).alias("edited_fingerprint"),
                       "near_edited", "near_next")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
