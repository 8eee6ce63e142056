"""Exact percentiles (linear interpolation) in bounded memory, one path for all sizes.

Spark's exact `percentile` keeps every distinct value of a group in one
aggregation buffer; with one group holding a third of the data that buffer
is the data.  Here a sketch only says where to look, and counting decides:

1. `percentile_approx` brackets every wanted rank of every group: its answers
   for ranks a few error bounds below and above it.  The sketch has a fixed size.
2. One aggregate counts, per group and bracket, the rows below it; another the
   rows at each distinct value inside.  The inside holds a small share of the
   group (a few times 1 / ACCURACY) besides ties, which are one row.
3. While a bracket holds more than `most` distinct values, they are cut into PIECES
   of about equal depth and counted; only the pieces that hold the wanted ranks stay
   apart, and what lies below becomes one entry.  So the largest task of the next step
   has about `most` values however many rows there are.
4. A running sum over those values gives the values at the floor and the ceiling
   of the position h = (n - 1) p, and the result
   (ceil h - h) lower + (h - floor h) higher.

Null groups are groups.  NaN and null values are skipped (as pandas does);
infinities are values like others, and a result between -inf and inf is NaN.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.session import materialize

#: Rank error of the sketch is at most 1 / ACCURACY of the rows.
ACCURACY = 1000
#: Distinct values of one bracket that a running sum takes, and the pieces that larger brackets are cut into.
MOST_VALUES, PIECES = 1 << 20, 64


def _narrowed(counted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Entries of the pieces that hold the ranks at the floor and the ceiling of `_pos`; the rest below as one entry."""
    at = [*keys, "_i"]
    cuts = counted.groupBy(*at).agg(
        F.percentile_approx("_x", [k / PIECES for k in range(1, PIECES)], 16 * PIECES).alias("_cuts"))
    # one row per bracket: groups and probabilities, few beside values
    cuts = cuts.select(*[F.col(c).alias(f"_b{c}") for c in at], "_cuts")
    cond = F.col("_i") == F.col("_b_i")
    for c in keys:
        cond = cond & F.col(c).eqNullSafe(F.col(f"_b{c}"))
    # entries without a value come before the first piece
    piece = F.when(F.col("_x").isNull(), F.lit(-1)).otherwise(F.size(F.filter("_cuts", lambda b: b < F.col("_x"))))
    cut = counted.join(cuts, cond).withColumn("_piece", piece).drop("_cuts", *[f"_b{c}" for c in at])
    sums = cut.groupBy(*at, "_pos", "_piece").agg(F.sum("_c").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*at).orderBy("_piece"))  # PIECES + 1 rows at most
    state = (sums.withColumn("_upto", upto).select(
        *[F.col(c).alias(f"_b{c}") for c in at], F.col("_piece").alias("_b_piece"),
        (F.col("_upto") <= F.floor("_pos")).alias("_below"), (F.col("_upto") - F.col("_n") > F.ceil("_pos")).alias("_above")))
    placed = cut.join(state, cond & (F.col("_piece") == F.col("_b_piece"))).where("not _above")
    return (placed.groupBy(*at, "_pos", F.when(~F.col("_below"), F.col("_x")).alias("_x")).agg(F.sum("_c").alias("_c"))
            .select(*counted.columns))


def _refined(counted: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """`counted` with at most `most` entries per bracket, as far as cutting gets there."""
    spark, before = counted.sparkSession, None
    counted = materialize(spark, counted, "percentile-values")
    while True:
        size = counted.groupBy(*keys, "_i").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
        if size <= most or size == before:
            return counted
        counted, before = materialize(spark, _narrowed(counted, keys), "percentile-values"), size


def exact_percentiles(df: DataFrame, group_cols: Sequence[str], value: str,
                      probs: Sequence[float], names: Sequence[str] | None = None,
                      extra_aggs: Sequence[Column] = (), accuracy: int = ACCURACY,
                      most: int = MOST_VALUES) -> DataFrame:
    """One row per group: n (non-NaN values) and one column per probability.

    `extra_aggs` are further aggregate columns over *all* rows of each group
    (means, counts, ...), computed in the same pass as the sketch; every group of
    `df` then has a row (n = 0 when it has no valid value).  Without group columns there is one
    row, of an empty `df` too.  The counted values are stored, and their number decides how often brackets are narrowed.
    """
    g = list(group_cols)
    names = list(names or [f"p{int(round(p * 100))}" for p in probs])
    x = F.col(value).cast("double")
    valid = x.isNotNull() & ~F.isnan(x)
    slack = 2.0 / accuracy
    around = [min(1.0, max(0.0, float(p) + d)) for p in probs for d in (-slack, slack)]
    source = df if extra_aggs else df.where(valid)
    sketch = source.groupBy(*g).agg(
        F.count_if(valid).alias("n"),
        F.percentile_approx(F.when(valid, x), around, accuracy).alias("_s"), *extra_aggs)
    extras = [c for c in sketch.columns if c not in (*g, "n", "_s")]

    # one row per group and probability: its bracket and its position
    wanted = F.array(*[F.struct(
        F.lit(i).alias("i"), ((F.col("n") - 1) * F.lit(float(p))).alias("pos"),
        # open where the order ends, and where a group is so small that the slack is
        # less than a rank (then at most 4 x accuracy values lie inside)
        F.when((F.lit(around[2 * i]) <= 0) | (F.col("n") < 4 * accuracy), F.lit(float("-inf"))).otherwise(F.col("_s")[2 * i]).alias("lo"),
        F.when((F.lit(around[2 * i + 1]) >= 1) | (F.col("n") < 4 * accuracy), F.lit(float("inf"))).otherwise(F.col("_s")[2 * i + 1]).alias("hi"))
        for i, p in enumerate(probs)])
    keys = [f"_g{k}" for k in range(len(g))]
    brackets = sketch.where("n > 0").select(*[F.col(c).alias(k) for c, k in zip(g, keys)], wanted.alias("_w"))

    # groups are few beside rows: the join's size is known to the planner at run time
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(g, keys)]
    rows = df.where(valid).select(*g, x.alias("_x"))
    cond = same[0] if same else None
    for c in same[1:]:
        cond = cond & c
    # equal values meet before the join, map-side, so a hot value is one row
    values = rows.groupBy(*g, "_x").agg(F.count(F.lit(1)).alias("_c"))
    # without groups the brackets are one value, no join
    near = values.join(brackets, cond) if g else values.withColumn("_w", brackets.scalar())
    met = near.select(*keys, "_x", "_c", F.explode("_w").alias("_w"))
    inside = (F.col("_x") >= F.col("_w.lo")) & (F.col("_x") <= F.col("_w.hi"))
    # rows below a bracket become one entry without a value
    counted = (met.where(F.col("_x") <= F.col("_w.hi"))
               .groupBy(*keys, F.col("_w.i").alias("_i"), F.col("_w.pos").alias("_pos"),
                        F.when(inside, F.col("_x")).alias("_x")).agg(F.sum("_c").alias("_c")))
    counted = _refined(counted, keys, most)
    upto = Window.partitionBy(*keys, "_i").orderBy(F.asc_nulls_first("_x"))
    ranked = (counted.withColumn("_upto", F.sum("_c").over(upto))
              .withColumn("_from", F.col("_upto") - F.col("_c")))
    at = lambda r: F.max(F.when((r >= F.col("_from")) & (r < F.col("_upto")), F.col("_x")))
    low, high = F.floor("_pos"), F.ceil("_pos")
    found = (ranked.groupBy(*keys, "_i", "_pos").agg(at(low).alias("_lo"), at(high).alias("_hi"))
             .withColumn("_q", F.when((low == high) | (F.col("_lo") == F.col("_hi")), F.col("_lo"))
                         .otherwise((high - F.col("_pos")) * F.col("_lo") + (F.col("_pos") - low) * F.col("_hi"))))
    picked = [F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(n) for i, n in enumerate(names)]
    if not g:
        one = found.agg(F.struct(*picked)).scalar()
        return sketch.withColumn("_p", one).select("n", *[F.col(f"_p.{n}").alias(n) for n in names], *extras)
    return sketch.join(found.groupBy(*keys).agg(*picked), cond, "left").select(*g, "n", *names, *extras)
