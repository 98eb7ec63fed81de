"""Slices, statistics, scores and decisions."""

import pytest
from pyspark.sql import functions as F

from sigloom.functions import segments as seg
from sigloom.operators.segments import segment_stats, signal_summary
from sigloom.sources.tables import samples_from_arrays, samples_from_rows


def samples(spark, values):
    df = spark.createDataFrame([("s", list(map(float, values)))], "sig STRING, v ARRAY<DOUBLE>")
    return samples_from_arrays(df, {"sig": F.col("sig")}, F.col("v"))


def stats(spark, values, k):
    return segment_stats(samples(spark, values), ["sig"], k).orderBy("segment_index").collect()


def summary(spark, values, k=16, threshold=0.35):
    return signal_summary(segment_stats(samples(spark, values), ["sig"], k), ["sig"], threshold).first()


def test_sixteen_ordered_segments(spark):
    rows = stats(spark, range(32), 16)
    assert [(r.segment_index, r.parity_group, r.parity_order) for r in rows] == [
        (i, "odd" if i % 2 else "even", (i + 1) // 2) for i in range(1, 17)
    ]
    assert [r.mean_value for r in rows] == [2 * i + 0.5 for i in range(16)]
    assert {(r.sample_count, r.std_value, r.max_value - r.min_value) for r in rows} == {(2, 0.5, 1.0)}


def test_remainder_goes_to_the_first_segments(spark):
    assert [r.sample_count for r in stats(spark, range(10), 4)] == [3, 3, 2, 2]


def test_short_signal_keeps_empty_segments(spark):
    rows = stats(spark, [5, 6, 7], 5)
    assert [(r.sample_count, r.mean_value, r.std_value, r.min_value, r.max_value) for r in rows] == [
        (1, 5.0, 0.0, 5.0, 5.0), (1, 6.0, 0.0, 6.0, 6.0), (1, 7.0, 0.0, 7.0, 7.0),
        (0, None, None, None, None), (0, None, None, None, None),
    ]
    assert summary(spark, [5, 6, 7], 5).record_count == 5


def test_segments_must_be_positive(spark):
    with pytest.raises(ValueError):
        stats(spark, [1], 0)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 31, 100, 257])
@pytest.mark.parametrize("k", [1, 2, 7, 16])
def test_closed_form_is_ntile(spark, n, k):
    sizes = [n // k + (i < n % k) for i in range(k)]
    want = [i + 1 for i, size in enumerate(sizes) for _ in range(size)]
    got = spark.range(n).select(seg.segment_index(F.col("id"), F.lit(n).cast("bigint"), k).alias("s"), "id")
    assert [r.s for r in got.orderBy("id").collect()] == want


def test_score(spark):
    row = summary(spark, range(32))
    assert (row.odd_pattern_mean, row.even_pattern_mean, row.odd_even_gap) == (14.5, 16.5, 2.0)
    assert row.cpd_score == pytest.approx(2 / 31)
    assert (row.quality_decision, row.total_samples, row.record_count) == ("PASS", 32, 16)


def test_threshold_is_inclusive(spark):
    assert summary(spark, [3, 1], 2, 0.5).quality_decision == "REVIEW"
    assert summary(spark, [3, 1], 2, 0.500001).quality_decision == "PASS"


def test_missing_side_passes(spark):
    row = summary(spark, [4])
    assert (row.odd_pattern_mean, row.even_pattern_mean, row.odd_even_gap, row.cpd_score) == (4.0, None, None, None)
    assert row.quality_decision == "PASS"


def test_all_zero_scores_zero(spark):
    row = summary(spark, [0] * 20)
    assert (row.cpd_score, row.quality_decision) == (0.0, "PASS")


def test_quality_gate(spark):
    scores = spark.createDataFrame([(None,), (0.1,), (0.2,), (0.6,)], "s DOUBLE")
    got = [r.g for r in scores.select(seg.quality_gate(F.col("s"), 0.2, 0.6).alias("g")).collect()]
    assert got == ["PASS", "PASS", "WARNING", "HOLD"]
    with pytest.raises(ValueError):
        seg.quality_gate(F.col("s"), 0.6, 0.2)


def test_hot_signals_give_the_same_statistics(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = F.when(F.col("user_id") < 6, F.lit(0)).otherwise(F.col("user_id"))

    def of(max_rows):
        rows = samples_from_rows(events, {"u": hot}, [F.col("event_id")], F.col("value"), max_rows)
        columns = [F.round(c, 9).alias(c) for c in ("mean_value", "std_value", "min_value", "max_value")]
        table = segment_stats(rows, ["u"]).select("u", "segment_index", "sample_count", *columns)
        return sorted(map(tuple, table.collect()))

    assert of(50) == of(10_000_000)


def test_non_finite_values_are_not_samples(spark):
    rows = [(i, v) for i, v in enumerate([1.0, float("nan"), None, float("inf"), float("-inf"), 2.0])]
    df = spark.createDataFrame(rows, "i BIGINT, v DOUBLE").withColumn("k", F.lit("a"))
    got = samples_from_rows(df, {"k": F.col("k")}, [F.col("i")], F.col("v")).collect()
    assert sorted((r.pos, r.n, r.value) for r in got) == [(0, 2, 1.0), (1, 2, 2.0)]
    assert [r.value for r in samples(spark, [1.0, float("nan"), float("inf"), 2.0]).collect()] == [1.0, 2.0]


def test_summary_of_a_table_takes_one_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    rows = samples_from_rows(events, {"user_id": F.col("user_id")}, [F.col("event_id")], F.col("value"))
    plan = signal_summary(segment_stats(rows, ["user_id"]), ["user_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan
    assert "PushedFilters: [IsNotNull(value)" in plan
