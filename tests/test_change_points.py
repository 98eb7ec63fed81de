"""Change points against the optimum over all segmentations, found without giving up any border."""

import math
import random
import statistics

import pytest

from sigloom.operators.change_points import LEAST_PENALTY, pieces

SAMPLES = "k string, pos bigint, value double"


def plain(values, penalty, cells):
    """``start, n, mean`` of the best pieces by the full recursion."""
    known = [v for v in values if v is not None]
    mean = statistics.fmean(known) if known else None
    off = [0.0 if v is None else v - mean for v in values]
    width = -(-len(off) // cells)
    borders = [*range(0, len(off), width), len(off)]
    fine = LEAST_PENALTY + (penalty * statistics.pvariance(known) * math.log(len(borders) - 1) if known else 0.0)

    def cost(a, b):
        part = off[a:b]
        return sum((x - statistics.fmean(part)) ** 2 for x in part)

    best, last = [-fine], [0]
    for t in range(1, len(borders)):
        options = [(best[s] + cost(borders[s], borders[t]) + fine, s) for s in range(t)]
        least = min(options)
        best.append(least[0])
        last.append(least[1])
    cuts, at = [], len(borders) - 1
    while at > 0:
        cuts.insert(0, last[at])
        at = last[at]
    ends = [borders[c] for c in cuts[1:]] + [len(off)]
    return [(borders[c], e - borders[c], None if mean is None else mean + statistics.fmean(off[borders[c] : e])) for c, e in zip(cuts, ends)]


@pytest.fixture(scope="module")
def signals():
    rng = random.Random(8)
    made = {"steps": [rng.gauss(level, 1) for level in (0, 4, 4, -3, 1) for _ in range(17)], "noise": [rng.gauss(0, 1) for _ in range(60)]}
    made |= {"flat": [2.37] * 30, "one": [5.0], None: [rng.choice((0.0, 9.0)) for _ in range(25)], "gone": [None, None]}
    return made | {"gaps": [0.0, None, 0.0, 0.1, 8.0, None, 8.0, 8.1] * 2, "two": [1.0, 100.0]}


@pytest.mark.parametrize("cells, penalty", [(1, 3.0), (7, 0.4), (40, 0.0), (256, 0.4), (256, 3.0)])
def test_the_best_pieces(spark, signals, cells, penalty):
    rows = [(k, p, x) for k, v in signals.items() for p, x in enumerate(v)]
    random.Random(1).shuffle(rows)
    got = {}
    for r in pieces(spark.createDataFrame(rows, SAMPLES), ["k"], penalty, cells).orderBy("piece").collect():
        got.setdefault(r.k, []).append((r.start_pos, r.n, r["mean"]))
        assert r.piece == len(got[r.k]) - 1
    assert set(got) == set(signals)
    for k, values in signals.items():
        expected = plain(values, penalty, cells)
        assert [p[:2] for p in got[k]] == [p[:2] for p in expected], k
        assert [p[2] for p in got[k]] == [None if p[2] is None else pytest.approx(p[2]) for p in expected]
    assert len(got["flat"]) == 1


def test_steps_are_found(spark, signals):
    rows = [("steps", p, x) for p, x in enumerate(signals["steps"])]
    found = pieces(spark.createDataFrame(rows, SAMPLES), ["k"])
    assert [abs(r.start_pos - at) <= 1 for r, at in zip(found.orderBy("piece").collect(), (0, 17, 51, 68))] == [True] * 4
    assert "Python" not in found._jdf.queryExecution().toString()


def test_empty(spark):
    assert pieces(spark.createDataFrame([], SAMPLES), ["k"]).collect() == []
