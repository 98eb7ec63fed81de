"""Change points of the mean of ordered signals: exact penalised segmentation of each signal's cells.

A signal is cut into at most ``cells`` cells of equal width, one sample each where it has no more samples. A cell is known
by its moments, which are merged on the way to the shuffle, so only they reach the search, however long the signal is. The
search is optimal partitioning over cell borders; a border from which no later piece can be the best one any more is
given up, which loses nothing. The formulas are ours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions.values import once
from sigloom.operators.columns import settled
from sigloom.operators.joins import attach

CELLS = 256
#: Keeps rounding from cutting a signal of equal values.
LEAST_PENALTY = 1e-9


def _cells(samples: DataFrame, keys: list[str], penalty: float, cells: int) -> DataFrame:
    """One row per signal: ``m`` cells, ``first`` positions, ``count``, ``total`` and ``square`` up to each border, ``fine`` of a cut."""
    whole = samples.groupBy(*keys).agg(F.avg("value").alias("__mean"), (F.max("pos") + 1).alias("__n"), F.var_pop("value").alias("__var"))
    off = F.coalesce(F.col("value") - F.col("__mean"), F.lit(0.0))
    rows = attach(samples.select(*keys, "pos", "value"), whole, keys).withColumn("__off", off)
    width = F.expr(f"(__n + {cells - 1}) DIV {cells}")
    one = rows.withColumn("__width", width).groupBy(*keys, F.expr("pos DIV __width").alias("__cell"))
    moments = one.agg(
        F.min("pos").alias("first"), F.count("*").alias("count"), F.sum("__off").alias("total"), F.sum(F.col("__off") * F.col("__off")).alias("square"),
        F.max("__mean").alias("mean"), F.max("__var").alias("var"),
    )
    upto = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    sums = moments.withColumns({name: F.sum(name).over(upto) for name in ("count", "total", "square")})
    ordered = sums.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("first", "count", "total", "square"))).alias("cell"), F.max("mean").alias("mean"), F.max("var").alias("var")
    )
    border = lambda name, zero: F.concat(F.array(F.lit(zero)), F.col(f"cell.{name}"))
    # The search reads these many times for each cell, so they must not be made anew each time.
    return settled(
        ordered.withColumn("m", F.size("cell")),
        first=F.col("cell.first"), count=border("count", 0), total=border("total", 0.0), square=border("square", 0.0),
        fine=F.coalesce(F.lit(penalty) * F.col("var") * F.ln("m"), F.lit(0.0)) + LEAST_PENALTY,
    ).drop("cell", "var")


def _cost(start: Column, end: Column) -> Column:
    """Sum of squared deviations from the mean of the piece between two borders."""
    between = lambda name: F.get(F.col(name), end) - F.get(F.col(name), start)
    total = between("total")
    return F.greatest(F.lit(0.0), between("square") - total * total / between("count"))


def pieces(samples: DataFrame, keys: Sequence[str], penalty: float = 3.0, cells: int = CELLS) -> DataFrame:
    """The pieces of every signal (``keys, pos, value``, positions from 0 without gaps) that cost least:

    ``keys, piece, start_pos, n, mean``, pieces from 0, each but the first starting at a change point. The cost is the sum
    of squared deviations from the pieces' means plus, for every change point, ``penalty`` times the signal's population
    variance times the logarithm of its number of cells. Null values count as the mean of the signal; a signal of nothing
    else is one piece without a mean. Null keys are a signal like others; no rows give none.
    """
    if cells < 1:
        raise ValueError("cells must be >= 1")
    keys = list(keys)
    known = _cells(samples, keys, penalty, cells)
    start = F.struct(
        F.array(-F.col("fine")).alias("best"), F.array(F.lit(0)).alias("last"), F.array(F.lit(0)).alias("open")
    )

    def step(state: Column, end: Column) -> Column:
        options = F.transform(state["open"], lambda s: F.struct((F.get(state["best"], s) + _cost(s, end)).alias("cost"), s.alias("start")))

        def chosen(o: Column) -> Column:
            return once(F.array_min(o), lambda least: _next(state, o, least, end))

        return once(options, chosen)

    def _next(state: Column, options: Column, least: Column, end: Column) -> Column:
        reached = least["cost"] + F.col("fine")
        still = F.transform(F.filter(options, lambda o: o["cost"] <= reached), lambda o: o["start"])
        return F.struct(
            F.concat(state["best"], F.array(reached)).alias("best"),
            F.concat(state["last"], F.array(least["start"])).alias("last"),
            F.concat(still, F.array(end)).alias("open"),
        )

    borders = F.sequence(F.lit(1), F.col("m"))
    searched = settled(known, last=F.aggregate(borders, start, step)["last"])

    # From the last border back to the first one, at most one step per cell.
    back = F.struct(F.col("m").alias("at"), F.array().cast("array<int>").alias("cuts"))
    backward = lambda s, _: F.when(s["at"] <= 0, s).otherwise(
        F.struct(F.get(F.col("last"), s["at"]).alias("at"), F.concat(F.array(F.get(F.col("last"), s["at"])), s["cuts"]).alias("cuts"))
    )
    cuts = F.aggregate(borders, back, backward)["cuts"]
    found = settled(searched, cuts=cuts).select("*", F.posexplode("cuts").alias("piece", "from"))
    to = F.coalesce(F.get(F.col("cuts"), F.col("piece") + 1), F.col("m"))
    between = lambda name: F.get(F.col(name), to) - F.get(F.col(name), F.col("from"))
    return found.select(
        *keys,
        F.col("piece").cast("bigint").alias("piece"),
        F.get(F.col("first"), F.col("from")).alias("start_pos"),
        between("count").alias("n"),
        (F.col("mean") + between("total") / between("count")).alias("mean"),
    )
