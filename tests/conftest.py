import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parent.parent), str(Path(__file__).resolve().parent)]
os.environ["TZ"] = "UTC"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(base / "checkpoints"))
        .config("spark.sql.warehouse.dir", str(base / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_signal():
    def write(path: Path, values, header: str = "value") -> Path:
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join([header, *map(str, values)]) + "\n", encoding="utf-8")
        return path

    return write


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
