"""Listing, choosing and reading signal files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sigloom.functions import paths, values
from sigloom.sources.files import FileChoice, SignalFiles, choose_files, list_files


def names(df):
    return sorted(r.source_file.rsplit("/", 1)[1] for r in df.collect())


def test_metadata_of_a_prefixed_file(spark, tmp_path, write_signal):
    write_signal(tmp_path / "20220417" / "out" / "3_20220417_battery_10_laser_a.csv", [0.1, 0.2])
    meta = paths.source_columns(F.col("source_file"), F.col("modified"))
    row = list_files(spark, str(tmp_path)).select(*[c.alias(n) for n, c in meta.items()]).first()
    assert (row.line_number, row.line_id, row.channel) == (3, "LINE_03", 1)
    assert (row.product_id, row.event_date) == ("battery_10", dt.date(2022, 4, 17))
    assert row.source_file == str(tmp_path / "20220417" / "out" / "3_20220417_battery_10_laser_a.csv")


@pytest.mark.parametrize(
    "path, line, product, channel, date",
    [
        ("/d/20220417_battery_10_laser_b.csv", 20220417, "battery_10", 0, "2022-04-17"),
        ("/d/20220417_battery_10_CH1.csv", 20220417, "battery_10", 0, "2022-04-17"),
        ("/data_lake/x.csv", 1, "x", 1, None),
        ("/d/battery_010.csv", 1, "battery_10", 0, None),
        ("/d/2_seam_LA.csv", 2, "seam", 1, None),
        ("/d/concat_out_0/2_seam_ch0.csv", 2, "seam", 1, None),
        ("/d/20229999_battery_1_laser_a.csv", 20229999, "battery_1", 1, None),
        ("/d/20220417/20230101/123_Battery_007.csv", 123, "battery_7", 0, "2022-04-17"),
    ],
)
def test_metadata_rules(spark, path, line, product, channel, date):
    meta = paths.source_columns(F.lit(path))
    row = spark.range(1).select(*[c.alias(n) for n, c in meta.items()]).first()
    assert (row.line_number, row.product_id, row.channel) == (line, product, channel)
    assert row.line_id == f"LINE_{line:02d}"
    assert row.event_date == (dt.date.fromisoformat(date) if date else None)


@pytest.mark.parametrize(
    "text, value",
    [
        ("value", None), ("", None), ("1,2", 2.0), ("3,", None), ("nan", None), ("inf", None), ("1e400", None),
        ("1.0d", None), ("1.0f", None), ("1_000", 1000.0), ("1__0", None), ("_1", None), (" 4 ", 4.0), ("\t5\t", 5.0),
        (".5", 0.5), ("5.", 5.0), (".", None), ("+1e-3", 0.001), ("1e", None), ("0x1p3", None), ("0.1 # note", None),
        ("5,7", 7.0), ("-0", 0.0), ("1 2", None), ("\x0b6\x0c", 6.0),
    ],
)
def test_sample_grammar(spark, text, value):
    assert spark.range(1).select(values.parse_sample(F.lit(text)).alias("v")).first().v == value


def test_single_precision(spark):
    row = spark.range(1).select(values.single_precision(F.lit(0.1)).alias("v")).first()
    assert row.v == 0.10000000149011612


def test_cap_is_in_path_part_order(spark, tmp_path, write_signal):
    for name in ("a/b.csv", "a-b/c.csv", "a/d.csv", "z.csv"):
        write_signal(tmp_path / name, [1])
    (tmp_path / "A.CSV").write_text("1\n")
    choice = choose_files(spark, str(tmp_path), max_files=2)
    assert names(list_files(spark, str(tmp_path), choice)) == ["b.csv", "d.csv"]
    assert SignalFiles(spark, str(tmp_path), choice).samples.count() == 2
    assert list_files(spark, str(tmp_path), choose_files(spark, str(tmp_path), max_files=0)).count() == 4


def test_cap_comes_before_the_oldest_date(spark, tmp_path, write_signal):
    for name in ("a/20230101_x.csv", "a/20230102_x.csv", "b/20220101_x.csv"):
        write_signal(tmp_path / name, [1])
    assert names(list_files(spark, str(tmp_path), choose_files(spark, str(tmp_path), 2, True))) == ["20230101_x.csv"]
    assert names(list_files(spark, str(tmp_path), choose_files(spark, str(tmp_path), 0, True))) == ["20220101_x.csv"]


def test_choice_prunes_files_at_planning(spark, tmp_path, write_signal):
    for day in ("20220101", "20220102", "20220103"):
        write_signal(tmp_path / day / "x.csv", [1])
    source = SignalFiles(spark, str(tmp_path), FileChoice(event_date=dt.date(2022, 1, 2)))
    scanned = source._lines().select("value")
    assert len(scanned.collect()) == 1
    leaf = scanned._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().get("numFiles").get().value() == 1


def test_order_survives_many_blocks(spark, tmp_path, write_signal):
    write_signal(tmp_path / "big.csv", range(20000))
    write_signal(tmp_path / "small one+.csv", range(5))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        source = SignalFiles(spark, str(tmp_path))
        assert source._blocks.count() > 20
        rows = source.named(source.samples).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 20005
    assert all(r.pos == r.value for r in rows)
    assert {(r.source_file, r.n) for r in rows} == {
        (str(tmp_path / "big.csv"), 20000), (str(tmp_path / "small one+.csv"), 5)
    }


def test_blocks_found_by_path_where_hashes_collide(spark, tmp_path, write_signal, monkeypatch):
    write_signal(tmp_path / "a.csv", range(5))
    write_signal(tmp_path / "b.csv", range(3))
    monkeypatch.setattr("sigloom.sources.files._block_key", lambda: F.lit(1).cast("bigint"))
    source = SignalFiles(spark, str(tmp_path))
    assert sorted((r.n, r.pos, r.value) for r in source.samples.collect()) == [(3, i, float(i)) for i in range(3)] + [
        (5, i, float(i)) for i in range(5)
    ]


def test_many_blocks_join_by_shuffle(spark, tmp_path, write_signal, monkeypatch):
    for name in "abc":
        write_signal(tmp_path / f"{name}.csv", range(50))
    monkeypatch.setattr("sigloom.sources.files.BLOCK_TABLE_BYTES", 0)
    monkeypatch.setattr("sigloom.operators.joins.BROADCAST_BYTES", 0)
    source = SignalFiles(spark, str(tmp_path))
    assert all(r.pos == r.value and r.n == 50 for r in source.named(source.samples).collect())


@pytest.mark.parametrize("lines", [20, 60])
def test_a_file_that_changes_later_changes_nothing(spark, tmp_path, write_signal, lines):
    write_signal(tmp_path / "a.csv", range(50))
    source = SignalFiles(spark, str(tmp_path))
    assert source._blocks.count() == 1
    (tmp_path / "a.csv").write_text("\n".join(["7"] * lines))
    assert sorted((r.pos, r.n, r.value) for r in source.samples.collect()) == [(i, 50, float(i)) for i in range(50)]


def test_the_cut_of_a_scan_may_change_between_passes(spark, tmp_path, write_signal):
    write_signal(tmp_path / "big.csv", range(30_000))
    source = SignalFiles(spark, str(tmp_path))
    name = "spark.sql.leafNodeDefaultParallelism"
    options = {"spark.sql.files.openCostInBytes": "1024", "spark.sql.files.maxPartitionBytes": "16384"}
    old = {k: spark.conf.get(k) for k in options}
    try:
        spark.conf.set(name, "2")
        assert source._blocks.count() >= 1
        for k, v in options.items():
            spark.conf.set(k, v)
        spark.conf.set(name, "16")
        rows = source.samples.collect()
    finally:
        spark.conf.unset(name)
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted((r.pos, r.n, r.value) for r in rows) == [(i, 30_000, float(i)) for i in range(30_000)]


def test_numbering_needs_no_shuffle_of_samples(spark, tmp_path, write_signal):
    write_signal(tmp_path / "a.csv", range(100))
    plan = SignalFiles(spark, str(tmp_path)).samples._jdf.queryExecution().executedPlan().toString()
    sample_side = plan.split("BroadcastExchange")[0]
    assert "FileScan parquet" in sample_side and "Exchange hashpartitioning" not in sample_side


def test_impossible_dates_are_quarantined_and_used(spark, tmp_path, write_signal):
    write_signal(tmp_path / "20229999_battery_1_laser_a.csv", [1, 2])
    write_signal(tmp_path / "20220101_battery_1_laser_a.csv", [])
    source = SignalFiles(spark, str(tmp_path))
    assert sorted((r.source_file.rsplit("/", 1)[1], r.reason) for r in source.quarantine.collect()) == [
        ("20220101_battery_1_laser_a.csv", "no finite numeric samples"), ("20229999_battery_1_laser_a.csv", "impossible date")
    ]
    assert source.samples.count() == 2


def test_bad_files_are_skipped_with_a_reason(spark, tmp_path, write_signal):
    write_signal(tmp_path / "20220417" / "a+b c.csv", [1, 2])
    write_signal(tmp_path / "header_only.csv", [])
    (tmp_path / "broken.csv").write_bytes(b"1\n\xff2\n3\n")
    (tmp_path / "replacement.csv").write_text("�\n1\n", encoding="utf-8")
    source = SignalFiles(spark, str(tmp_path))
    assert {(r.source_file.rsplit("/", 1)[1], r.reason) for r in source.skipped.collect()} == {
        ("header_only.csv", "no finite numeric samples"),
        ("broken.csv", "not valid UTF-8"),
    }
    assert {r.source_file.rsplit("/", 1)[1] for r in source.named(source.samples).collect()} == {"a+b c.csv", "replacement.csv"}
