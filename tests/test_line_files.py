"""Files that tasks write under names of their own."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sigloom.plans import table_queries
from sigloom.shared_storage import fresh_path, qualified_path, shared_folder
from sigloom.sinks.external import write_line_files


def found(root: str) -> dict[str, str]:
    base = Path(root.removeprefix("file:"))
    return {str(p.relative_to(base)): p.read_text() for p in base.rglob("*") if p.is_file()}


@pytest.mark.parametrize("qualified", [False, True])
def test_each_file_is_written_once_in_order(spark, qualified):
    root = fresh_path(spark, "lines")
    root = qualified_path(spark, root) if qualified else root
    rows = spark.createDataFrame([("a/x.csv", 2, "two"), ("a/x.csv", 1, "one"), ("b c/y.csv", 1, "ä"), ("a/z.csv", None, "")], "file string, place int, line string")
    write_line_files(rows, root, ["place"], "head")
    assert found(root) == {"a/x.csv": "head\none\ntwo\n", "b c/y.csv": "head\nä\n", "a/z.csv": "head\n\n"}
    write_line_files(rows.limit(0), root + "none", ["place"], "head")


def test_the_product_tree_has_a_file_and_no_folder_per_signal(spark, tmp_path):
    events = spark.range(90).select(
        F.col("id").alias("event_id"), F.when(F.col("id") < 88, F.col("id") % 44).alias("user_id"), (F.col("id") / 8).alias("value")
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    before = set(Path(shared_folder(spark)).rglob("*"))
    tree = table_queries._product_tree(spark, str(tmp_path))
    made = set(Path(shared_folder(spark)).rglob("*")) - before
    assert len([p for p in made if p.is_dir()]) <= 12
    files = found(tree)
    assert len(files) == 45 and files["20240103/out/battery_2.csv"] == "event_id,value\n5,0.625\n49,6.125\n"
    assert files["2024010null/out/battery___HIVE_DEFAULT_PARTITION__.csv"] == "event_id,value\n88,11.0\n89,11.125\n"
