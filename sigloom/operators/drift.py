"""Drift of ordered signals: cumulative sums, weighted means, distances of distributions, and baselines that can be merged.

The methods are only named where signals like these are described; the formulas below are ours, and the checks' SQL says
the same. Scans go in two steps, inside blocks of BLOCK positions and over one row per block, so that no task needs a
whole signal.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.operators.joins import attach
from sigloom.operators.numbering import number_rows
from sigloom.operators.upsert import upsert_by_key
from sigloom.shared_storage import written

BLOCK = 65_536
#: Natural logarithm of the largest growth inside a block.
_LARGEST_POWER = 600


def _blocked(rows: DataFrame, keys: Sequence[str], pos: str, block: int) -> tuple[DataFrame, list[str]]:
    return rows.withColumn("__block", F.expr(f"{pos} DIV {block}")), [*keys, "__block"]


def running_sums(rows: DataFrame, keys: Sequence[str], sums: dict[str, Column], pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Adds the sums of ``sums`` up to and with each row, in order of ``pos`` among the rows of its keys."""
    rows, group = _blocked(rows.withColumns({f"__{n}": c for n, c in sums.items()}), keys, pos, block)
    totals = rows.groupBy(*group).agg(*[F.sum(f"__{n}").alias(f"__all_{n}") for n in sums])
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*group, *[F.coalesce(F.sum(f"__all_{n}").over(earlier), F.lit(0)).alias(f"__before_{n}") for n in sums])
    inside = Window.partitionBy(*group).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumns({n: F.sum(f"__{n}").over(inside) for n in sums})
    joined = attach(local, before, group)
    summed = joined.withColumns({n: F.col(n) + F.col(f"__before_{n}") for n in sums})
    return summed.drop("__block", *[f"__{n}" for n in sums], *[f"__before_{n}" for n in sums])


def running_minimum(rows: DataFrame, keys: Sequence[str], value: str, name: str, pos: str = "pos", block: int = BLOCK) -> DataFrame:
    """Adds the smallest ``value`` up to and with each row."""
    rows, group = _blocked(rows, keys, pos, block)
    least = rows.groupBy(*group).agg(F.min(value).alias("__least"))
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = least.select(*group, F.min("__least").over(earlier).alias("__before"))
    inside = Window.partitionBy(*group).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    joined = attach(rows.withColumn(name, F.min(value).over(inside)), before, group)
    return joined.withColumn(name, F.least(name, "__before")).drop("__block", "__before")


def cusum(samples: DataFrame, keys: Sequence[str], slack: float, threshold: float, block: int = BLOCK) -> DataFrame:
    """Both one-sided cumulative sums of every signal (``keys, pos, value``) about its own mean.

    high(t) = max(0, high(t - 1) + value - mean - slack), and low(t) with the sign turned. Either is a running sum minus
    the smallest running sum so far (0 at the start), which is how they are reckoned. ``cusum_high`` and ``cusum_low`` are
    their largest values, ``first_alarm`` the first position where one of them exceeds ``threshold``, null where none
    does. Null values count as the mean. Null keys are a signal like others; no rows give none.
    """
    keys = list(keys)
    means = samples.groupBy(*keys).agg(F.avg("value").alias("__mean"))
    centred = attach(samples.select(*keys, "pos", "value"), means, keys)
    # The block of a row and its sums are read twice below.
    centred = written(centred.select(*keys, "pos", F.coalesce(F.col("value") - F.col("__mean"), F.lit(0.0)).alias("off")), "centred")
    sums = running_sums(centred, keys, {"up": F.col("off") - slack, "down": -F.col("off") - slack}, block=block)
    sums = written(sums.drop("off"), "sums")
    low = running_minimum(running_minimum(sums, keys, "up", "least_up", block=block), keys, "down", "least_down", block=block)
    high = F.col("up") - F.least(F.lit(0.0), F.col("least_up"))
    fall = F.col("down") - F.least(F.lit(0.0), F.col("least_down"))
    return low.select(*keys, "pos", high.alias("high"), fall.alias("fall")).groupBy(*keys).agg(
        F.max("high").alias("cusum_high"),
        F.max("fall").alias("cusum_low"),
        F.min(F.when((F.col("high") > threshold) | (F.col("fall") > threshold), F.col("pos"))).alias("first_alarm"),
    )


def ewma(samples: DataFrame, keys: Sequence[str], weight: float, limit: float, block: int = BLOCK) -> DataFrame:
    """Exponentially weighted means of every signal (``keys, pos, value``, positions without gaps) about its own mean.

    e(t) = (1 - weight) e(t - 1) + weight (value - mean), e before the first sample being 0. ``ewma_high`` and ``ewma_low``
    are the largest and smallest e, ``ewma_last`` the last one, ``first_alarm`` the first position where |e| exceeds
    ``limit`` times its own deviation, sigma sqrt(weight / (2 - weight) (1 - (1 - weight)^(2t + 2))) with the signal's
    population deviation sigma; null where none does. Null values count as the mean. Null keys are a signal like others.

    Inside a block e is a sum of values that grow by 1 / (1 - weight) each; blocks are cut short enough for that to stay
    a number. What enters a block is made of as many blocks before it as weigh more than 2^-120 of it.
    """
    if not 0 < weight < 1:
        raise ValueError("weight must be between 0 and 1")
    keys, keep = list(keys), 1 - weight
    block = max(1, min(block, int(_LARGEST_POWER / -math.log(keep))))
    reach = max(1, math.ceil(120 * math.log(2) / (block * -math.log(keep))))
    whole = samples.groupBy(*keys).agg(F.avg("value").alias("__mean"), F.stddev_pop("value").alias("__sigma"))
    off = F.coalesce(F.col("value") - F.col("__mean"), F.lit(0.0))
    rows, group = _blocked(attach(samples.select(*keys, "pos", "value"), whole, keys).select(*keys, "pos", "__sigma", off.alias("off")), keys, "pos", block)
    place = F.pmod(F.col("pos"), F.lit(block))
    scaled = F.col("off") * F.lit(weight) * F.pow(F.lit(keep), -place)
    inside = Window.partitionBy(*group).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = written(rows.withColumn("own", F.sum(scaled).over(inside) * F.pow(F.lit(keep), place)), "ewma")

    # One row per block; all but the last one of a signal have the same length, so their weight is one number.
    ends = rows.groupBy(*group).agg(F.max_by("own", "pos").alias("__end"))
    near = Window.partitionBy(*keys).orderBy("__block").rowsBetween(-reach, -1)
    carried = F.aggregate(F.collect_list("__end").over(near), F.lit(0.0), lambda e, end: e * F.lit(keep**block) + end)
    joined = attach(rows, ends.select(*group, carried.alias("__before")), group)
    e = F.col("own") + F.col("__before") * F.pow(F.lit(keep), place + 1)
    spread = F.lit(weight / (2 - weight)) * (1 - F.pow(F.lit(keep), 2 * F.col("pos") + 2))
    alarm = F.abs("e") > limit * F.col("__sigma") * F.sqrt(spread)
    return joined.withColumn("e", e).groupBy(*keys).agg(
        F.max("e").alias("ewma_high"),
        F.min("e").alias("ewma_low"),
        F.max_by("e", "pos").alias("ewma_last"),
        F.min(F.when(alarm, F.col("pos"))).alias("first_alarm"),
    )


def ks_distance(samples: DataFrame, keys: Sequence[str], first: Column, block: int = BLOCK) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per signal: values where ``first`` holds against the others.

    The largest difference of the two distribution functions, taken after all samples of a value, so ties don't matter.
    Samples become counts per value before anything is sorted. ``ks`` is null where one side has no samples. Null values
    are left out; a signal of null values only gives no row.
    """
    keys = list(keys)
    known = samples.filter("value IS NOT NULL AND NOT isnan(value)")
    counts = known.groupBy(*keys, "value").agg(F.count_if(first).alias("one"), F.count_if(~first).alias("two"))
    counts = written(number_rows(counts, keys, ["value"]).drop("n"), "counts")
    sums = running_sums(counts, keys, {"ones": F.col("one"), "twos": F.col("two")}, block=block)
    totals = counts.groupBy(*keys).agg(F.sum("one").alias("n_first"), F.sum("two").alias("n_second"))
    both = attach(sums, totals, keys)
    gap = F.abs(F.try_divide(F.col("ones").cast("double"), F.col("n_first")) - F.try_divide(F.col("twos").cast("double"), F.col("n_second")))
    return both.groupBy(*keys).agg(F.max("n_first").alias("n_first"), F.max("n_second").alias("n_second"), F.max(gap).alias("ks"))


def moments(samples: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A baseline per signal or product: ``n, mean, m2`` (sum of squared deviations), which can be merged."""
    n = F.count("value")
    return samples.groupBy(*keys).agg(n.alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * n).alias("m2"))


def merged_moments(baselines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One baseline for each key of any number of partial ones. Those without samples add nothing."""
    n, weighted = F.sum("n"), F.sum(F.col("n") * F.col("mean"))
    # The square of the means, about a mean of the key, so that large means lose no digits.
    means = attach(baselines, baselines.groupBy(*keys).agg(F.try_divide(weighted, n).alias("__mean")), keys)
    off = F.col("mean") - F.col("__mean")
    return means.groupBy(*keys).agg(
        n.alias("n"), F.max("__mean").alias("mean"), F.sum(F.coalesce(F.col("m2") + F.col("n") * off * off, F.lit(0.0))).alias("m2")
    )


def updated_baselines(known: DataFrame, run: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table of baselines after a run: keys of the run are merged with what is known, others stay."""
    touched = attach(known, run.select(*keys).distinct(), keys, "left_semi")
    return upsert_by_key(known, merged_moments(touched.unionByName(run), keys), list(keys))
