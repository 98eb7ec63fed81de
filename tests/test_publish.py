"""Instances, pairing, replay, chunks and messages from file trees."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sigloom.functions import instances as inst
from sigloom.operators import instances as ops
from sigloom.operators.chunks import (
    arrival_counts,
    chunk_completeness,
    chunk_samples,
    incomplete_signals,
    is_complete,
    missing_chunks,
    reassemble,
    samples_of_chunks,
)
from sigloom.operators.messages import build_messages, by_key_in_order, in_key_order, keyed_json
from sigloom.operators.replay import dry_run_summary, in_publish_order, replay_items, seeded_order
from sigloom.plans import publish_job
from sigloom.plans.publish_job import InstanceScan, plan_items, plan_messages
from sigloom.sinks.external import KAFKA_OPTIONS, write_message_files
from sigloom.sources.messages import read_message_files


def laser_pair(root, write_signal, battery=31, b=(1.5, 2.5), a=(3.5, 4.5)):
    write_signal(root / f"20220417_battery_{battery}_laser_b.csv", b)
    write_signal(root / f"20220417_battery_{battery}_laser_a.csv", a)


def test_laser_files_form_one_instance(spark, tmp_path, write_signal):
    write_signal(tmp_path / "laser_b" / "20220417" / "20220417_battery_31_laser_b.csv", [0.1])
    write_signal(tmp_path / "laser_a" / "20220417" / "20220417_battery_31_laser_a.csv", [0.3])
    scan = InstanceScan(spark, str(tmp_path))
    [row] = scan.instances().collect()
    assert (row.instance_id, row.line_id, row.product_id) == ("20220417_battery_31", "LINE_01", "battery_31")
    assert (row.batch_id, row.sequence_id, row.event_time) == ("20220417", "31", dt.datetime(2022, 4, 17))
    [pair] = scan.pairs.collect()
    assert pair.lead_num == 1
    assert pair.channel_0_path.endswith("laser_b.csv") and pair.channel_1_path.endswith("laser_a.csv")


def test_folders_decide_the_channel(spark, tmp_path, write_signal):
    for folder in ("reflect", "OUT"):
        write_signal(tmp_path / "20220417" / folder / "battery_31.csv", [0.1])
    # The folder beats the name: this is a second file of channel 1, later in path order.
    write_signal(tmp_path / "20220417" / "out" / "20220417_battery_31_laser_b.csv", [0.1])
    scan = InstanceScan(spark, str(tmp_path))
    [row] = scan.instances().collect()
    # The first file in path order is in OUT and gives the sequence id.
    assert (row.instance_id, row.sequence_id) == ("20220417_battery_31", "battery_31")
    [pair] = scan.pairs.collect()
    assert pair.channel_0_path.endswith("reflect/battery_31.csv")
    assert pair.channel_1_path.endswith("out/20220417_battery_31_laser_b.csv")
    assert pair.duplicates == 1


@pytest.mark.parametrize(
    "path, fields",
    [
        (
            "20220417_000442_1_WLINE_01_04_PROD_001_01_LB.csv",
            ("20220417_000442_1_WLINE_01_04_PROD_001", "04_PROD_001", "WLINE", "01", "1", 1, 0, "2022-04-17 00:04:42"),
        ),
        (
            "20220417_000442_2_L7_03_P-1_16_CH1.csv",
            ("20220417_000442_2_L7_03_P-1", "P-1", "L7", "03", "2", 16, 1, "2022-04-17 00:04:42"),
        ),
        (
            "20220417_battery_031_CH1.csv",
            ("20220417_battery_31", "battery_31", "LINE_01", "20220417", "031", 1, 1, "2022-04-17 00:00:00"),
        ),
        (
            "x/20220417/concat_out_0/seam_3_laser_A.csv",
            ("20220417_seam_3", "seam_3", "LINE_01", "20220417", "seam_3", 1, 1, "2022-04-17 00:00:00"),
        ),
        ("3_20220417_battery_31_laser_b.csv", None),
        ("20220417/seam.csv", None),
        ("out/seam.csv", None),
    ],
)
def test_three_ways_to_name_a_file(spark, path, fields):
    df = spark.createDataFrame([(path,)], "path STRING")
    row = ops.parse_instances(df, F.col("path")).drop("path").first()
    got = tuple(str(v) if isinstance(v, dt.datetime) else v for v in row)
    assert got == (fields or (None,) * 8)


def test_unusable_files_are_listed(spark, tmp_path, write_signal):
    for name in ("20229999_battery_1_laser_a.csv", "notes.csv", "20220417_battery_1_laser_a.csv"):
        write_signal(tmp_path / name, [1])
    scan = InstanceScan(spark, str(tmp_path))
    assert {(r.path.rsplit("/", 1)[1], r.reason) for r in scan.ignored.collect()} == {
        ("20229999_battery_1_laser_a.csv", "impossible date or time"),
        ("notes.csv", "not a signal file name"),
    }
    assert scan.instances().count() == 1


def test_complete_means_sixteen_pairs(spark, tmp_path, write_signal):
    for product, leads in (("A", 16), ("B", 15)):
        for lead in range(1, leads + 1):
            for laser in ("LA", "LB"):
                write_signal(tmp_path / f"20220417_000000_1_L1_01_{product}_{lead:02d}_{laser}.csv", [1])
    write_signal(tmp_path / "20220417_000000_1_L1_01_B_16_LA.csv", [1])
    scan = InstanceScan(spark, str(tmp_path))
    assert [r.product_id for r in scan.instances(only_complete=True).collect()] == ["A"]
    assert [tuple(r) for r in ops.missing_channels(scan.pairs).collect()] == [("20220417_000000_1_L1_01_B", 16, 0)]
    done = {r.instance_id[-1]: (r.leads_present, r.channel_pairs) for r in ops.completeness(scan.pairs).collect()}
    assert done == {"A": (16, 16), "B": (16, 15)}


def test_oldest_date_comes_before_the_cap(spark, tmp_path, write_signal):
    for day in ("20220418", "20220417"):
        for battery in (1, 2):
            write_signal(tmp_path / f"{day}_battery_{battery}_CH0.csv", [1])
    scan = InstanceScan(spark, str(tmp_path))
    items = plan_items(scan, oldest_date_only=True, max_products=3)
    assert sorted(r.product_instance_id for r in items.collect()) == ["20220417_battery_1", "20220417_battery_2"]


def test_items_for_several_lines(spark, tmp_path, write_signal):
    for battery in (31, 32):
        laser_pair(tmp_path, write_signal, battery)
    items = in_publish_order(plan_items(InstanceScan(spark, str(tmp_path)), lines=3, max_products=2)).collect()
    assert [r.line_id for r in items] == ["LINE_01", "LINE_02", "LINE_03"] * 2
    assert [r.line_number for r in items] == [1, 2, 3] * 2
    first = items[0].event_time
    assert [(r.event_time - first).total_seconds() for r in items] == [0, 0, 0, 10, 10, 10]
    assert [r.is_duplicate for r in items] == [False, True, True] * 2
    assert items[1].product_instance_id == "20220417_battery_31_LINE_02_R00000"
    report = dry_run_summary(plan_items(InstanceScan(spark, str(tmp_path)), lines=3)).first()
    assert tuple(report) == (6, 2, 4, "LINE_01, LINE_02, LINE_03")


def instances(spark, n):
    return spark.range(n).select(
        F.format_string("i%02d", "id").alias("instance_id"),
        F.lit("p").alias("product_id"),
        F.lit("LINE_01").alias("line_id"),
        F.lit("b").alias("batch_id"),
        F.lit("s").alias("sequence_id"),
        F.lit(dt.datetime(2022, 4, 17)).alias("event_time"),
    )


def test_target_wraps_around(spark):
    rows = replay_items(instances(spark, 3), target=7, interval_seconds=0.5).orderBy("event_time").collect()
    assert [r.product_instance_id for r in rows] == [
        "i00", "i01", "i02", "i00_LINE_01_R00001", "i01_LINE_01_R00001", "i02_LINE_01_R00001", "i00_LINE_01_R00002"
    ]
    assert [r.replay_iteration for r in rows] == [0, 0, 0, 1, 1, 1, 2]
    assert rows[-1].event_time - rows[0].event_time == dt.timedelta(seconds=3)
    assert {r.original_product_instance_id for r in rows} == {"i00", "i01", "i02"}


def test_replay_limits(spark):
    assert replay_items(instances(spark, 0), lines=0).count() == 0
    with pytest.raises(ValueError):
        replay_items(instances(spark, 2), lines=0)
    assert replay_items(instances(spark, 5), max_products=0).count() == 5


def test_replay_is_the_same_when_instances_span_tasks(spark):
    def of(max_rows, seeds):
        rows = replay_items(instances(spark, 30).repartition(4), lines=3, target=150, seeds=seeds, max_rows=max_rows)
        return sorted(map(tuple, rows.collect()))

    for seeds in (None, [5, 9]):
        assert of(7, seeds) == of(1000, seeds)


def test_seeds_give_each_line_its_own_order(spark):
    def order(seeds):
        rows = seeded_order(instances(spark, 20), seeds, 3).orderBy("line_index", "slot").collect()
        return [[r.instance_id for r in rows if r.line_index == line] for line in range(3)]

    first, second, third = order([1, 2])
    assert first != second and first == third and sorted(first) == sorted(second)
    assert order([1, 2]) == [first, second, third]


def test_messages_of_a_pair(spark, tmp_path, write_signal):
    laser_pair(tmp_path, write_signal, 31, [2.5, 1.5, 0.5, 3.1, 4.5], [6.5, 7.5, 5.5, 9.5, 8.5])
    scan = InstanceScan(spark, str(tmp_path))
    messages = plan_messages(scan, plan_items(scan), chunk_size=3)
    rows = in_key_order(keyed_json(messages, "raw")).collect()
    by_channel = sorted(rows, key=lambda r: (json.loads(r.value)["channel"], r.chunk_index))
    assert [r.key for r in by_channel] == ["LINE_01_20220417_battery_31_L01_LB"] * 2 + [
        "LINE_01_20220417_battery_31_L01_LA"
    ] * 2
    second = json.loads(by_channel[1].value)
    assert list(second) == messages.columns
    assert second | {"samples": None, "metadata": None} == {
        "message_id": "20220417_battery_31:L01:LB:000001",
        "product_instance_id": "20220417_battery_31",
        "product_id": "battery_31",
        "line_id": "LINE_01",
        "batch_id": "20220417",
        "sequence_id": "31",
        "lead_num": 1,
        "lead_type": "AL_CU",
        "channel": 0,
        "channel_name": "LaserB",
        "chunk_index": 1,
        "total_chunks": 2,
        "is_last_chunk": True,
        "sample_rate_hz": 25000,
        "start_sample": 3,
        "end_sample": 5,
        "samples": None,
        "event_time": "2022-04-17T00:00:00Z",
        "metadata": None,
    }
    assert second["samples"] == [3.0999999046325684, 4.5]
    assert second["metadata"] == {
        "source": "file_replay_producer",
        "version": "v1",
        "file_name": "1_20220417_battery_31_laser_b.csv",
        "original_product_instance_id": "20220417_battery_31",
        "is_duplicate": False,
        "replay_iteration": 0,
    }
    out = str(tmp_path / "out")
    write_message_files(messages, out, "raw")
    assert read_message_files(spark, out).count() == 4


def test_replayed_messages_share_the_samples(spark, tmp_path, write_signal):
    laser_pair(tmp_path, write_signal, 10, [1, 2, 3], [4])
    write_signal(tmp_path / "20220417_battery_11_laser_b.csv", [9])
    scan = InstanceScan(spark, str(tmp_path))
    messages = plan_messages(scan, plan_items(scan, lines=2, max_products=1), chunk_size=2)
    got = sorted((r.line_id, r.channel, r.chunk_index, r.samples, r.metadata.is_duplicate) for r in messages.collect())
    assert got == [
        ("LINE_01", 0, 0, [1.0, 2.0], False), ("LINE_01", 0, 1, [3.0], False), ("LINE_01", 1, 0, [4.0], False),
        ("LINE_02", 0, 0, [1.0, 2.0], True), ("LINE_02", 0, 1, [3.0], True), ("LINE_02", 1, 0, [4.0], True),
    ]
    assert messages.select("message_id").distinct().count() == 6


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_chunks_join_up_to_the_signal(spark, size):
    samples = spark.range(23).select(
        F.lit("s").alias("sig"), F.col("id").alias("pos"), F.lit(23).cast("bigint").alias("n"), (F.col("id") * 0.5).alias("value")
    )
    chunks = chunk_samples(samples, ["sig"], size)
    assert chunks.count() == -(-23 // size)
    whole = sorted(map(tuple, samples.select("sig", "pos", "value").collect()))
    assert sorted(map(tuple, samples_of_chunks(chunks, ["sig"]).collect())) == whole
    for stored in (chunks, chunks.withColumn("start_sample", F.lit(None).cast("int"))):
        got = reassemble(stored, ["sig"], bucket=2).select("sig", "pos", "value")
        assert sorted(map(tuple, got.collect())) == whole


def test_missing_chunks_across_buckets(spark):
    chunks = spark.range(50).filter("id NOT IN (0, 8, 9, 10, 11, 12, 13, 14, 15, 49)").select(
        F.lit("s").alias("sig"), F.col("id").alias("chunk_index"), F.lit(50).alias("total_chunks"), F.array(F.lit(1.0)).alias("samples")
    )
    got = missing_chunks(chunks, ["sig"], bucket=4)
    assert sorted(r.chunk_index for r in got.collect()) == [0, 8, 9, 10, 11, 12, 13, 14, 15, 49]


CASES = {
    "whole": ([0, 1, 2], 3), "repeat": ([0, 1, 1, 2], 3), "repeat for a gap": ([0, 0, 2], 3), "outside": ([0, 7], 2),
    "beside": ([0, 1, 5], 2), "pairs": ([0, 0, 3, 3], 4), "negative": ([-1, 0], 2), "one": ([0], 1),
}


def arrived(spark):
    rows = [(k, i, n, [1.0, 2.0]) for k, (indexes, n) in CASES.items() for i in indexes]
    rows += [("disagree", 0, 2, [1.0]), ("disagree", 1, 3, [1.0])]
    return spark.createDataFrame(rows, "sig string, chunk_index int, total_chunks int, samples array<double>")


def test_complete_is_every_index_once(spark):
    got = {r.sig: (r.is_complete, r.received_chunks) for r in chunk_completeness(arrived(spark), ["sig"]).collect()}
    assert got == {
        "whole": (True, 3), "repeat": (True, 3), "repeat for a gap": (False, 2), "outside": (False, 1), "beside": (True, 2),
        "pairs": (False, 2), "negative": (False, 1), "one": (True, 1), "disagree": (False, 2),
    }
    # A stream has no list of indexes; extra rows make a signal incomplete there.
    streamed = arrived(spark).groupBy("sig").agg(*arrival_counts()).withColumn("done", is_complete())
    assert {r.sig for r in streamed.filter("done").collect()} == {"whole", "one"}


def test_incomplete_signals_name_what_is_missing(spark):
    rows = incomplete_signals(arrived(spark), ["sig"], bucket=2).collect()
    got = sorted((r.sig, sorted(r.missing)) for r in rows)
    assert got == [("disagree", []), ("disagree", [2]), ("negative", [1]), ("outside", [1]), ("pairs", [1]), ("pairs", [2]), ("repeat for a gap", [1])]


def test_a_key_is_sent_by_one_task_in_order(spark):
    rows = spark.range(400).select(F.format_string("k%d", F.col("id") % 3).alias("key"), (F.lit(400) - F.col("id")).alias("chunk_index"))
    sent = by_key_in_order(rows.repartition(4)).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    for _, group in sent.toPandas().groupby("key"):
        assert group.part.nunique() == 1 and list(group.sort_values("at").chunk_index) == sorted(group.chunk_index)


def test_publishing_scans_only_its_dates(spark, tmp_path, write_signal):
    for day in ("20220415", "20220416", "20220417"):
        write_signal(tmp_path / day / "out" / f"{day}_battery_1_laser_a.csv", [1, 2])
    scan = InstanceScan(spark, str(tmp_path))
    wanted = plan_items(scan, oldest_date_only=True).join(
        ops.signal_files(scan.pairs).withColumnRenamed("instance_id", "original_product_instance_id"), "original_product_instance_id"
    )
    choice = publish_job._choice(wanted)
    assert choice.event_dates == (dt.date(2022, 4, 15),)
    lines = publish_job.SignalFiles(spark, str(tmp_path), choice)._lines().select("value")
    assert len(lines.collect()) == 2
    leaf = lines._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().get("numFiles").get().value() == 1


def test_often_replayed_files_are_spread(spark, tmp_path, write_signal, monkeypatch):
    laser_pair(tmp_path, write_signal, b=(1, 2, 3), a=(4,))
    scan = InstanceScan(spark, str(tmp_path))

    def published():
        rows = plan_messages(scan, plan_items(scan, lines=2, target=12), chunk_size=2).collect()
        return sorted((r.message_id, r.samples) for r in rows)

    whole = published()
    monkeypatch.setattr(publish_job, "ITEMS_PER_TASK", 3)
    assert published() == whole and len(whole) == 36


def test_iso_fraction_only_when_present(spark):
    times = spark.createDataFrame(
        [(dt.datetime(2022, 4, 17, 0, 4, 42),), (dt.datetime(2022, 4, 17, 0, 4, 42, 500000),)], "t TIMESTAMP"
    )
    assert [r.s for r in times.select(inst.iso_utc(F.col("t")).alias("s")).collect()] == [
        "2022-04-17T00:04:42Z", "2022-04-17T00:04:42.500000Z"
    ]


def test_line_numbers_of_line_ids(spark):
    ids = spark.createDataFrame([("LINE_07",), ("WLINE",), ("L120",), (None,)], "l STRING")
    assert [r.n for r in ids.select(inst.line_number(F.col("l")).alias("n")).collect()] == [7, 1, 120, 1]


def test_kafka_settings_keep_the_delivery_guarantee():
    assert KAFKA_OPTIONS["kafka.acks"] == "all" and KAFKA_OPTIONS["kafka.compression.type"] == "gzip"


def test_build_messages_needs_only_chunk_and_item_columns(spark):
    row = spark.range(1).select(
        F.lit("i").alias("product_instance_id"), F.lit("i").alias("original_product_instance_id"), F.lit("p").alias("product_id"),
        F.lit("LINE_02").alias("line_id"), F.lit(2).alias("line_number"), F.lit(None).cast("string").alias("batch_id"),
        F.lit("s").alias("sequence_id"), F.lit(2).alias("lead_num"), F.lit(1).alias("channel"), F.lit("f.csv").alias("file_name"),
        F.lit(0).alias("chunk_index"), F.lit(1).alias("total_chunks"), F.lit(True).alias("is_last_chunk"), F.lit(0).alias("start_sample"),
        F.lit(1).alias("end_sample"), F.array(F.lit(1e-5)).alias("samples"), F.lit(dt.datetime(2022, 1, 1)).alias("event_time"),
        F.lit(False).alias("is_duplicate"), F.lit(0).alias("replay_iteration"),
    )
    message = json.loads(keyed_json(build_messages(row), "raw").first().value)
    assert message["batch_id"] is None and message["samples"] == [1e-05] and message["lead_type"] == "CU_CU"


def test_run_publish_hands_over_all_messages_once(spark, tmp_path, write_signal):
    laser_pair(tmp_path, write_signal)
    sent = []
    result = publish_job.run_publish(spark, str(tmp_path), lambda m: sent.append(m.collect()), chunk_size=1, lines=2)
    assert (result.product_instances, result.originals, result.duplicates, result.lines) == (2, 1, 1, "LINE_01, LINE_02")
    assert len(sent) == 1 and len(sent[0]) == 2 * 2 * 2
    assert publish_job.run_publish(spark, str(tmp_path), lines=2) == result
    (tmp_path / "none").mkdir()
    assert publish_job.run_publish(spark, str(tmp_path / "none"), sent.append).product_instances == 0 and len(sent) == 1
