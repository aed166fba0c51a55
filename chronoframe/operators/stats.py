"""Exact order statistics and robust aggregates per key.

Ranks come from sorted windows, which spill, rather than from lists collected per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """Rows with ``rn`` (from 0, by x) and ``cnt`` per key; nulls of x are left out."""
    w = Window.partitionBy(*keys)
    return df.where(F.col(x).isNotNull()).withColumns({"rn": F.row_number().over(w.orderBy(x)) - 1, "cnt": F.count("*").over(w)})


def at_rank(x: str, rank: Column) -> Column:
    return F.max(F.when(F.col("rn") == rank, F.col(x)))


def upper_median(df: DataFrame, keys: Sequence[str], x: str, name: str = "med") -> DataFrame:
    return ranked(df, keys, x).groupBy(*keys).agg(at_rank(x, F.floor(F.col("cnt") / 2)).alias(name))


def with_upper_median(df: DataFrame, keys: Sequence[str], x: Column, name: str) -> DataFrame:
    """``df`` with its key's upper median of x, nulls left out, in a column: two windows over one exchange by key, no join back."""
    w = Window.partitionBy(*keys)
    ranked_rows = df.withColumn("__x", x).withColumns({"__rn": F.row_number().over(w.orderBy(F.col("__x").asc_nulls_last())) - 1, "__cnt": F.count("__x").over(w)})
    return ranked_rows.withColumn(name, F.max(F.when(F.col("__rn") == F.floor(F.col("__cnt") / 2), F.col("__x"))).over(w)).drop("__x", "__rn", "__cnt")


def with_mad(df: DataFrame, keys: Sequence[str], x: Column, name: str, med: str = "__med") -> DataFrame:
    """``df`` with its key's upper median of x (``med``) and the upper median of deviations from it."""
    return with_upper_median(with_upper_median(df, keys, x, med), keys, F.abs(x - F.col(med)), name)


def nearest_rank(df: DataFrame, keys: Sequence[str], x: str, quantiles: dict[str, float]) -> DataFrame:
    """Sorted value at min(n - 1, int(n q)) for each named quantile."""
    r = ranked(df, keys, x)
    return r.groupBy(*keys).agg(*(at_rank(x, F.least(F.col("cnt") - 1, F.floor(F.col("cnt") * F.lit(q)))).alias(n) for n, q in quantiles.items()))


#: Keys whose brackets are sent to all tasks: some tens of megabytes.
FEW_KEYS = 100_000


def selected(df: DataFrame, keys: Sequence[str], x: str, quantiles: dict[str, float]) -> DataFrame:
    """``nearest_rank`` for few keys of many rows: no key is sorted.

    A mergeable sketch brackets each rank, counts place the bracket exactly, and only the distinct values within it (some
    thousandths of the rows) are ordered. Three passes over ``df``, each counted within tasks before rows move.
    """
    rows = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).alias("__v"))
    names, margin = list(quantiles), 0.001
    at = [min(1.0, max(0.0, q + d)) for q in quantiles.values() for d in (-margin, margin)]
    brackets = rows.groupBy(*keys).agg(F.count("*").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.percentile_approx("__v", at, 10_000).alias("__at"))
    if keys and brackets.count() > FEW_KEYS:
        return nearest_rank(df, keys, x, quantiles)

    def end(j: int, side: int):
        """An end of a bracket; the least or the greatest value where the margin goes past it."""
        q = list(quantiles.values())[j]
        past = q - margin <= 0 if side == 0 else q + margin >= 1
        return F.col("__lo" if side == 0 else "__hi") if past else F.col("__at")[2 * j + side]

    rank = [F.least(F.col("__n") - 1, F.floor(F.col("__n") * F.lit(q))) for q in quantiles.values()]
    told = F.broadcast(brackets.select(*keys, *(e.alias(f"__{k}{j}") for j in range(len(names)) for k, e in (("a", end(j, 0)), ("b", end(j, 1)), ("k", rank[j])))))
    near = rows.join(told, list(keys)) if keys else rows.join(told)
    v = F.col("__v")
    below = near.groupBy(*keys).agg(*(F.sum((v < F.col(f"__a{j}")).cast("long")).alias(f"__below{j}") for j in range(len(names))))
    which = F.array_compact(F.array(*(F.when(v.between(F.col(f"__a{j}"), F.col(f"__b{j}")), F.lit(j)) for j in range(len(names)))))
    inside = near.select(*keys, "__v", F.explode(which).alias("__j")).groupBy(*keys, "__j", "__v").agg(F.count("*").alias("__m"))
    running = F.sum("__m").over(Window.partitionBy(*keys, "__j").orderBy("__v"))
    both = inside.withColumn("__upto", running).join(F.broadcast(below), list(keys)) if keys else inside.withColumn("__upto", running).join(F.broadcast(below))
    both = both.join(told, list(keys)) if keys else both.join(told)

    def value(j: int):
        upto = F.col("__upto") + F.col(f"__below{j}")
        return F.max(F.when((F.col("__j") == j) & (upto > F.col(f"__k{j}")) & (upto - F.col("__m") <= F.col(f"__k{j}")), v))

    return both.groupBy(*keys).agg(*(value(j).alias(n) for j, n in enumerate(names)))


def mad(df: DataFrame, keys: Sequence[str], x: str, name: str = "mad") -> DataFrame:
    """Upper median of deviations from the upper median."""
    some = df.where(F.col(x).isNotNull()).select(*keys, x)
    return with_mad(some, keys, F.col(x), "__dev").groupBy(*keys).agg(F.first("__dev").alias(name))


def frame_stats(df: DataFrame, keys: Sequence[str], x: str, full: float, few: bool = False) -> DataFrame:
    """black, med, p99, p999, max over full scale; shares lit and saturated.

    Ranks come from one sort within each key, or, where keys are ``few`` and have many rows, from sketches and counts.
    """
    quantiles = {"black": 0.05, "med": 0.5, "p99": 0.99, "p999": 0.999, "max": 1.0}
    if few:
        base = selected(df, keys, x, quantiles)
        rows = df.where(F.col(x).isNotNull()).select(*keys, F.col(x).alias("__v")).join(F.broadcast(base), list(keys))
    else:
        w = Window.partitionBy(*keys)
        rank = lambda q: F.max(F.when(F.col("rn") == F.least(F.col("cnt") - 1, F.floor(F.col("cnt") * F.lit(q))), F.col(x))).over(w)
        rows = ranked(df, keys, x).withColumns({n: rank(q) for n, q in quantiles.items()}).withColumn("__v", F.col(x))
    floor = F.col("black") + F.greatest(F.lit(full / 2048), F.col("black") / 8)
    lit, satfrac = F.avg((F.col("__v") > floor).cast("int")), F.avg((F.col("__v") >= full * 63 / 64).cast("int"))
    return rows.groupBy(*keys).agg(*((F.first(c) / full).alias(c) for c in quantiles), lit.alias("lit"), satfrac.alias("satfrac"))


def robust_intercept(df: DataFrame, keys: Sequence[str], x: str) -> DataFrame:
    """Upper median after one cut at max(3 MAD, 2), and the number cut."""
    cut = with_mad(df, keys, F.col(x), "d0", "m0").withColumn("keep", F.abs(F.col(x) - F.col("m0")) <= F.greatest(3 * F.col("d0"), F.lit(2.0)))
    told = with_upper_median(cut, keys, F.when(F.col("keep"), F.col(x)), "intercept")
    return told.groupBy(*keys).agg(F.first("intercept").alias("intercept"), F.sum((~F.col("keep")).cast("long")).alias("rejected"))


def lag1(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Lag-1 autocorrelation; 0 under 8 rows or without variance."""
    mean = df.groupBy(*keys).agg(F.avg(x).alias("__m"), F.count("*").alias("__n"))
    d = df.join(mean, list(keys)).withColumn("__d", F.col(x) - F.col("__m"))
    d = d.withColumn("__p", F.lag("__d").over(Window.partitionBy(*keys).orderBy(order)))
    r = F.sum(F.col("__d") * F.col("__p")) / F.sum(F.col("__d") * F.col("__d"))
    return d.groupBy(*keys).agg(F.when((F.first("__n") < 8) | (F.sum(F.col("__d") * F.col("__d")) <= 0), 0.0).otherwise(r).alias("lag1"))


def difference_noise(df: DataFrame, keys: Sequence[str], order: str, x: str) -> DataFrame:
    """Noise from second differences: upper median of their size over 0.6745 and the root of 6."""
    w = Window.partitionBy(*keys).orderBy(order)
    d2 = F.abs(F.lead(x).over(w) - 2 * F.col(x) + F.lag(x).over(w))
    return upper_median(df.withColumn("__d2", d2), keys, "__d2", "__m").select(*keys, (F.col("__m") / 0.6745 / F.sqrt(F.lit(6.0))).alias("sigma"))


def mode(df: DataFrame, keys: Sequence[str], x: Column, first: str, name: str = "mode") -> DataFrame:
    """Most frequent value; of equally frequent ones, that seen first in the order of ``first``."""
    c = df.groupBy(*keys, x.alias(name)).agg(F.count("*").alias("n"), F.min(first).alias("__f"))
    return c.groupBy(*keys).agg(F.max_by(F.struct(name, "n"), F.struct("n", (-F.col("__f")).alias("f"))).alias("s")).select(*keys, "s.*")


def mean_of_means(df: DataFrame, keys: Sequence[str], inner: str, x: str, least: int, clamp: float) -> DataFrame:
    """Mean over inner groups of at least ``least`` rows of their means, clamped."""
    m = df.groupBy(*keys, inner).agg(F.avg(x).alias("m"), F.count("*").alias("n")).where(F.col("n") >= least)
    return m.groupBy(*keys).agg(F.least(F.greatest(F.avg("m"), F.lit(-clamp)), F.lit(clamp)).alias("bias"), F.count("*").alias("groups"))


def counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def slot_medians(df: DataFrame, keys: Sequence[str], xs: str) -> DataFrame:
    """Upper median of each slot of an array, over the rows of a key."""
    return upper_median(df.select(*keys, F.posexplode(xs).alias("slot", "__x")), [*keys, "slot"], "__x", "med")


def pedestal(df: DataFrame, keys: Sequence[str], x: str, percent: float, share: float) -> DataFrame:
    """The additive level of a plane: a share of a low percentile, interpolated."""
    return df.groupBy(*keys).agg((F.percentile(x, percent / 100) * share).alias("pedestal"))
