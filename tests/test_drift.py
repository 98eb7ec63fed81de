"""Drift operators against plain loops, with blocks far smaller than the signals."""

import bisect
import random
import statistics

import pytest
from pyspark.sql import functions as F

from sigloom.operators import drift

SAMPLES = "k string, pos bigint, n bigint, value double"


@pytest.fixture(scope="module")
def signals():
    rng = random.Random(4)
    made = {"hot": [rng.gauss(0, 1) + (k > 700) for k in range(900)], "flat": [2.0] * 40, "one": [5.0], None: [rng.choice((1.0, 2.0)) for _ in range(70)]}
    return made | {"gap": [1.0, None, 9.0, None, 1.0]}


@pytest.fixture(scope="module")
def samples(spark, signals):
    rows = [(k, p, len(v), x) for k, v in signals.items() for p, x in enumerate(v)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SAMPLES)


@pytest.mark.parametrize("block", [1, 7, 64, 65_536])
def test_cusum(samples, signals, block):
    got = {r.k: r for r in drift.cusum(samples, ["k"], 0.25, 6.0, block).collect()}
    assert set(got) == set(signals)
    for k, values in signals.items():
        mean = statistics.fmean(v for v in values if v is not None)
        high = fall = top = deep = 0.0
        alarm = None
        for p, v in enumerate(values):
            off = 0.0 if v is None else v - mean
            high, fall = max(0.0, high + off - 0.25), max(0.0, fall - off - 0.25)
            top, deep = max(top, high), max(deep, fall)
            if alarm is None and max(high, fall) > 6.0:
                alarm = p
        assert got[k].cusum_high == pytest.approx(top, abs=1e-9) and got[k].cusum_low == pytest.approx(deep, abs=1e-9)
        assert got[k].first_alarm == alarm
    assert got["hot"].first_alarm is not None and got["flat"].first_alarm is None


@pytest.mark.parametrize("block", [1, 5, 65_536])
def test_ks_with_ties(samples, signals, block):
    got = {r.k: r for r in drift.ks_distance(samples, ["k"], F.col("pos") % 3 == 0, block).collect()}
    assert set(got) == set(signals)
    for k, values in signals.items():
        sides = [sorted(v for p, v in enumerate(values) if v is not None and (p % 3 == 0) == s) for s in (True, False)]
        assert (got[k].n_first, got[k].n_second) == tuple(map(len, sides))
        if all(sides):
            gaps = [abs(bisect.bisect_right(sides[0], x) / len(sides[0]) - bisect.bisect_right(sides[1], x) / len(sides[1])) for x in sides[0] + sides[1]]
            assert got[k].ks == pytest.approx(max(gaps))
        else:
            assert got[k].ks is None


def test_running_sums_of_a_hot_key(samples, signals):
    rows = drift.running_sums(samples.filter("k = 'hot'"), ["k"], {"s": F.col("value")}, block=10).orderBy("pos").collect()
    total = 0.0
    for r, v in zip(rows, signals["hot"]):
        total += v
        assert r.s == pytest.approx(total)
    assert len(rows) == 900


def test_baselines_of_parts_equal_the_whole(spark, samples):
    shifted = samples.withColumn("value", F.col("value") + 1e9)
    known = drift.moments(shifted.filter("pos % 4 = 0"), ["k"])
    for part in (1, 2, 3):
        known = drift.updated_baselines(known, drift.moments(shifted.filter(f"pos % 4 = {part}"), ["k"]), ["k"])
    whole = {r.k: r for r in drift.moments(shifted, ["k"]).collect()}
    merged = {r.k: r for r in known.collect()}
    assert set(whole) == set(merged)
    for k, r in merged.items():
        assert r.n == whole[k].n and r.mean == pytest.approx(whole[k].mean, rel=1e-14)
        assert r.m2 == pytest.approx(whole[k].m2, rel=1e-4, abs=1e-4)


def test_empty(samples):
    none = samples.limit(0)
    assert drift.cusum(none, ["k"], 1.0, 1.0).collect() == [] and drift.ks_distance(none, ["k"], F.lit(True)).collect() == []
    assert drift.merged_moments(drift.moments(none, ["k"]), ["k"]).collect() == []


@pytest.mark.parametrize("block, weight", [(1, 0.2), (7, 0.05), (64, 0.97), (65_536, 0.2)])
def test_ewma(samples, signals, block, weight):
    got = {r.k: r for r in drift.ewma(samples, ["k"], weight, 2.7, block).collect()}
    assert set(got) == set(signals)
    for k, values in signals.items():
        known = [v for v in values if v is not None]
        mean, sigma = statistics.fmean(known), statistics.pstdev(known)
        e, seen, alarm = 0.0, [], None
        for p, v in enumerate(values):
            e = (1 - weight) * e + weight * (0.0 if v is None else v - mean)
            seen.append(e)
            if alarm is None and abs(e) > 2.7 * sigma * (weight / (2 - weight) * (1 - (1 - weight) ** (2 * p + 2))) ** 0.5:
                alarm = p
        assert (got[k].ewma_high, got[k].ewma_low, got[k].ewma_last) == pytest.approx((max(seen), min(seen), e), abs=1e-12)
        assert got[k].first_alarm == alarm
    assert got["flat"].first_alarm is None
