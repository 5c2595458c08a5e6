"""Exact continuous percentiles, narrowed down to parts of a group.

Spark's ``percentile`` merges a value->count map of every distinct value of
a group in one task, which does not hold for a billion-row group with
microsecond-precision values. This operator computes the same
``percentile_cont`` (linear interpolation between the order statistics at
``floor(p*(n-1))`` and ``ceil(p*(n-1))``) by narrowing down:

1. a value's interval is a fixed, monotone function of the value alone
   (``steps`` intervals for each factor of e, so their width is relative);
   rows per (group, interval) are counted with map-side combine;
2. running sums over a group's intervals place each wanted rank in exactly
   one of them;
3. only the values of those intervals are ordered, and the ranks picked.

Intervals depend on values alone, never on partition ids or a sketch, so the
result is the same however Spark plans, reuses or re-runs an exchange. Values
are counted before they are shuffled: one value that a third of all rows hold
is one row per mapper. A task holds the distinct values of one (group,
interval): all of them, if a group's values lie within 1/``steps`` of each
other (epoch seconds, large offsets). The result is right then too; ``steps``
is a parameter for such columns that no registered query changes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Intervals for each factor of e; below 1, for each unit.
STEPS = 256
LAST = (1 << 63) - 1


def interval(value: Column, steps: int = STEPS) -> Column:
    """Number of the value's interval: never falls as the value grows (NaN last, as in sorting)."""
    x = value.cast("double")
    size = F.floor(F.log1p(F.abs(x)) * steps)
    return F.when(F.isnan(x), F.lit(LAST)).when(x < 0, -size).otherwise(size).cast("long")


def exact_percentiles(df: DataFrame, group_cols, value_col: str, ps, prefix: str = "p",
                      weight_col: str | None = None, steps: int = STEPS) -> DataFrame:
    """One row per group: ``<prefix>0 .. <prefix>{k-1}`` = percentile_cont of
    ``value_col`` at each of ``ps`` (NULL values ignored), and ``n``. With
    ``weight_col`` each input row stands for that many rows (input already
    aggregated to value counts)."""
    g = list(group_cols)
    if not g:
        # a global percentile: one constant group; the global aggregate over
        # the (at most one-row) result yields exactly one row, also when empty
        out = exact_percentiles(df.withColumn("_all", F.lit(0)), ["_all"], value_col, ps, prefix, weight_col, steps)
        return out.agg(*[F.max(f"{prefix}{i}").alias(f"{prefix}{i}") for i in range(len(ps))],
                       F.coalesce(F.max("n"), F.lit(0)).alias("n"))
    keys = [f"_g{i}" for i in range(len(g))]
    weight = F.col(weight_col).cast("long") if weight_col else F.lit(1).cast("long")
    rows = (df.where(F.col(value_col).isNotNull())
            .select(*[F.col(c).alias(k) for k, c in zip(keys, g)], F.col(value_col).alias("_v"), weight.alias("_w"))
            .where("_w > 0").withColumn("_i", interval(F.col("_v"), steps)))

    # rank at which each interval starts, and the wanted ranks inside it
    sums = rows.groupBy(*keys, "_i").agg(F.sum("_w").alias("_in"))
    of_group = Window.partitionBy(*keys)
    sums = (sums.withColumn("_start", F.sum("_in").over(of_group.orderBy("_i")) - F.col("_in"))
                .withColumn("_n", F.sum("_in").over(of_group)))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(ps)])
    places = (sums.select("*", F.explode(wanted).alias("_t"))
              .withColumn("_pos", F.col("_t.p") * (F.col("_n") - 1))
              .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_pos"), F.ceil("_pos")))))
              .where("_rank >= _start and _rank < _start + _in")
              .groupBy(*keys, "_i", "_start", "_n")
              .agg(F.collect_list(F.struct(F.col("_t.i").alias("t"), F.col("_pos").alias("pos"), F.col("_rank").alias("rank"))).alias("_ranks"))
              .select(*[F.col(c).alias(f"{c}_at") for c in [*keys, "_i"]], "_start", "_n", "_ranks"))

    counts = rows.groupBy(*keys, "_i", "_v").agg(F.sum("_w").alias("_c"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_at")) for c in [*keys, "_i"]])
    upto = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(places, same).withColumn("_hi", F.col("_start") + F.sum("_c").over(upto))
    hit = F.filter("_ranks", lambda r: (r["rank"] < F.col("_hi")) & (r["rank"] >= F.col("_hi") - F.col("_c")))
    picked = ranked.select(*keys, "_n", "_v", F.explode(hit).alias("_r"))

    per_p = (picked.groupBy(*keys, "_n", F.col("_r.t").alias("_t"), F.col("_r.pos").alias("_pos"))
             .agg(F.min_by("_v", "_r.rank").alias("_lo"), F.max_by("_v", "_r.rank").alias("_up"))
             .withColumn("_val", F.col("_lo") + (F.col("_up") - F.col("_lo")) * (F.col("_pos") - F.floor("_pos"))))
    wide = per_p.groupBy(*keys, "_n").agg(
        *[F.max(F.when(F.col("_t") == i, F.col("_val"))).alias(f"{prefix}{i}") for i in range(len(ps))])
    return wide.select(*[F.col(k).alias(c) for k, c in zip(keys, g)],
                       *[f"{prefix}{i}" for i in range(len(ps))], F.col("_n").alias("n"))
