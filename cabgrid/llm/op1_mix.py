"""Mixing sources to target weights (operator 1, DataFrame functions only).

Per source: size = words, repetition rate = target / source size. A document
is emitted floor(rate) times plus one hash-seeded Bernoulli copy whose
probability is the rate's fraction, so reruns agree and no order matters.

Edge cases: null text has size 0; a null source is a source of its own, last
in order; sources without words get target 0 and no copies; rows that share a
doc_id (or have none) are numbered in the order they are read and each has a coin
of its own in ``mix_sources`` (in ``emit_mix``, which shuffles no texts, rows
without a doc_id have, rows that repeat one share its coin); empty tables give
empty results; other columns of any name are untouched.

Bound: the targets are windows over one row per source, sorted (with spilling)
by one task; a million sources are some 50 MB there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, stored, table, with_row

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(doc_id: Column, seed: str = SEED, turn: Column | None = None) -> Column:
    """Uniform in [0, 1) from the id: 48 bits of a keyed md5. ``turn``: of rows
    that share an id all but the first (0) have other coins."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    if turn is not None:
        text = F.concat(text, F.when(turn > 0, F.concat(F.lit(":"), turn.cast("string"))).otherwise(""))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, target from rows (source, size).

    Water filling over one row per source: with the sources in order of
    cap / weight, one is capped when its cap is at most its share of what the
    sources before it leave; the others get weight * level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_repeats
    capped = F.col("cap").cast("double") * F.col("w_left") <= F.col("w").cast("double") * F.col("t_left")
    level = F.max(F.when(~capped, F.col("t_left").cast("double") / F.col("w_left"))).over(whole)
    return (
        per.withColumn("w", weight.cast("long"))
        .withColumn("cap", cap)
        .withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
        .withColumn("t_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .select("source", "source_size",
                F.when(capped, F.col("cap").cast("double")).otherwise(F.col("w") * level).alias("target"))
    )


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` (doc_id, at) + turn: how many rows with the same doc_id were read
    before. Counted by (doc_id, part of the input), so that an id (or null) that
    many rows share is spread over the parts."""
    parts = rows.withColumn("part", F.shiftright("at", 33))
    by_part = Window.partitionBy("doc_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = (parts.groupBy("doc_id", "part").agg(F.count("*").alias("n"))
              .select(F.col("doc_id").alias("b_id"), F.col("part").alias("b_part"), F.coalesce(F.sum("n").over(by_part), F.lit(0)).alias("before"))
              .filter("before > 0"))
    own = F.row_number().over(Window.partitionBy("doc_id", "part").orderBy("at")) - 1
    return (parts.withColumn("own", own)
            .join(before, F.col("doc_id").eqNullSafe(F.col("b_id")) & (F.col("part") == F.col("b_part")), "left")
            .withColumn("turn", F.col("own") + F.coalesce("before", F.lit(0))).drop("part", "own", "b_id", "b_part", "before"))


def _with_copies(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """rows (doc_id, source, turn, ...) + source_size, target, copies.

    The targets, one row per source, are written first: Spark then knows their
    size, and below its broadcast threshold no row of ``rows`` is shuffled;
    beyond it they are joined by source (skewed partitions are split)."""
    targets = stored(targets, "targets")
    rate = F.col("target") / F.col("source_size")
    targets = targets.withColumnRenamed("source", "t_source")
    return (
        rows.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
        .withColumn("rate", F.when(F.col("source_size") > 0, rate).otherwise(F.lit(0.0)))
        .withColumn("copies", F.floor("rate")
                    + (coin(F.col("doc_id"), seed, F.col("turn")) < F.col("rate") - F.floor("rate")).cast("long"))
    )


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, text): doc_id, size, source_size,
    target, rate, copies, taken. Text is read once: the narrow (id, source,
    size) rows are written to the shared folder and used twice."""
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("at")))
    mixed = _with_copies(numbered(sizes), source_targets(sizes, weights, max_repeats), seed)
    return mixed.select("doc_id", "size", "source_size", "target", "rate", "copies",
                        (F.col("size") * F.col("copies")).alias("taken"))


def emit_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS,
             max_repeats: int = MAX_REPEATS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it,
    with the columns of ``docs``."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    turn = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()).otherwise(0)
    rows = with_row(docs, F.col("doc_id"), F.col("source"), turn.alias("turn"))
    mixed = _with_copies(rows, source_targets(sizes, weights, max_repeats), seed)
    return (mixed.filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
            .select("row.*"))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def mix_sql(docs: str = "documents") -> str:
    """The CTEs of the mix in DuckDB; ends with ``mixed`` (all columns)."""
    return f"""
sized AS (SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM {docs}),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER b, 0))::DOUBLE AS t_left,
    (sum(w) OVER () - coalesce(sum(w) OVER b, 0))::DOUBLE AS w_left
  FROM per_source
  WINDOW b AS (ORDER BY (3 * source_size)::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    CASE WHEN cap::DOUBLE * w_left <= w * t_left THEN cap::DOUBLE
         ELSE w * max(CASE WHEN NOT cap::DOUBLE * w_left <= w * t_left THEN t_left / w_left END) OVER () END AS target
  FROM filled),
rated AS (
  SELECT s.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS coin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
mixed AS (
  SELECT *, floor(rate)::BIGINT + CASE WHEN coin < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM rated)"""


SQL = f"""WITH {mix_sql()}
SELECT doc_id, size, source_size, target, rate, copies, size * copies AS taken FROM mixed"""
