"""The daily table kept up to date against one made anew."""

import pytest

from sigloom.operators import daily
from sigloom.operators.upsert import upsert_by_key

SUMMARY = "run_id string, source_file string, channel int, event_date string, line_number int, processed_at timestamp_ntz, cpd_score double, quality_decision string"


def judged(spark, *rows):
    values = ", ".join(f"({', '.join('NULL' if v is None else repr(v) for v in r)})" for r in rows)
    names = [f.split()[0] for f in SUMMARY.split(", ")]
    frame = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return frame.selectExpr(*[f"CAST({f.split()[0]} AS {f.split()[1]}) AS {f.split()[0]}" for f in SUMMARY.split(", ")])


def rows(frame):
    return {(r.event_date, r.line_number): (r.files, r.reviews, r.review_share, r.mean_score, r.max_score) for r in frame.collect()}


def test_append_and_upsert(spark):
    t1, t2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    first = judged(spark, ("a", "f", 0, "d1", 1, t1, 0.5, "REVIEW"), ("a", "g", 0, "d1", 1, t1, None, "PASS"), ("a", "h", 1, None, None, t1, 0.1, "PASS"))
    second = judged(spark, ("b", "f", 0, "d1", 1, t2, 0.1, "PASS"), ("b", "i", 0, "d2", 1, t2, 0.3, "PASS"))
    known = daily.daily_summary(first)
    assert rows(known) == {("d1", 1): (2, 1, 0.5, 0.5, 0.5), (None, None): (1, 0, 0.0, 0.1, 0.1)}
    both = first.unionByName(second)
    touched = daily.touched_days(second)
    assert {(r.event_date, r.line_number) for r in touched.collect()} == {("d1", 1), ("d2", 1)}
    known = daily.updated_daily(known, both, touched)
    assert rows(known) == rows(daily.daily_summary(both))
    assert rows(known)["d1", 1] == (2, 0, 0.0, pytest.approx(0.1), 0.1)
    # The only signal of a day moves to another one.
    moved = judged(spark, ("b", "i", 0, "d3", 1, t2, 0.9, "REVIEW"))
    after = upsert_by_key(both, moved, ["run_id", "source_file", "channel"])
    known = daily.updated_daily(known, after, daily.touched_days(moved, both))
    assert rows(known) == rows(daily.daily_summary(after)) and ("d2", 1) not in rows(known)


def test_empty(spark):
    none = judged(spark, ("a", "f", 0, "d1", 1, "2024-01-01 00:00:00", 0.5, "REVIEW")).limit(0)
    known = daily.daily_summary(none)
    assert rows(known) == {} and rows(daily.updated_daily(known, none, daily.touched_days(none, none))) == {}
