"""Databases and brokers. Executors write; nothing passes the driver."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigloom import fixed_values as fixed
from sigloom.functions.messages import broker_partition
from sigloom.operators.messages import by_key_in_order, in_key_order, keyed_json
from sigloom.shared_storage import qualified_path

KAFKA_OPTIONS = fixed.KAFKA_WRITE_OPTIONS
SEGMENT_BATCH_ROWS = 2000
SUMMARY_BATCH_ROWS = 1000
POSTGRES_TYPES = {
    "string": "TEXT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE PRECISION",
    "date": "DATE",
    "timestamp": "TIMESTAMPTZ",
}
# The segment table of a database leaves out the file name, which the path ends with.
DATABASE_TABLES = {
    "segments": ([c for c in fixed.SEGMENT_COLUMNS if c != "file_name"], fixed.SEGMENT_KEY, (), SEGMENT_BATCH_ROWS),
    "summary": (list(fixed.SUMMARY_COLUMNS), fixed.SUMMARY_KEY, (), SUMMARY_BATCH_ROWS),
    "runs": (list(fixed.RUN_COLUMNS), fixed.RUN_KEY, ("started_at", "details"), SUMMARY_BATCH_ROWS),
}


def create_table_sql(table: str, columns: dict[str, str], keys: list[str], types: dict[str, str]) -> str:
    fields = [f"{name} {types[kind]}{' NOT NULL' if name in keys else ''}" for name, kind in columns.items()]
    return f"CREATE TABLE {table} ({', '.join(fields)}, PRIMARY KEY ({', '.join(keys)}))"


def merge_sql(target: str, staging: str, columns: list[str], keys: list[str], keep: tuple[str, ...] = ()) -> str:
    """Insert or replace from a staging table, in standard SQL. ``keep`` names columns a match leaves alone."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    updates = ", ".join(f"{c} = s.{c}" for c in columns if c not in keys and c not in keep)
    values = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {staging} s ON {on} WHEN MATCHED THEN UPDATE SET {updates} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({values})"
    )


def run_sql(spark: SparkSession, url: str, statements: list[str], user: str = "", password: str = "") -> None:
    """Run statements in the database, in one transaction."""
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, user, password)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().execute(statement)
        connection.commit()
    finally:
        connection.rollback()
        connection.close()


def write_jdbc(df: DataFrame, url: str, table: str, batch_rows: int = SUMMARY_BATCH_ROWS, mode: str = "append", **options):
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize=batch_rows, **options).mode(mode).save()


def table_exists(spark: SparkSession, url: str, table: str, user: str = "", password: str = "") -> bool:
    """By the database's own catalog; names are compared as it stores them."""
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url, user, password)
    try:
        facts = connection.getMetaData()
        stored = table.upper() if facts.storesUpperCaseIdentifiers() else table.lower() if facts.storesLowerCaseIdentifiers() else table
        schema, _, name = stored.rpartition(".")
        return bool(facts.getTables(None, schema or None, name, None).next())
    finally:
        connection.close()


def ensure_tables(
    spark: SparkSession, url: str, prefix: str = "", types: dict[str, str] = POSTGRES_TYPES, user: str = "", password: str = ""
) -> None:
    """Create those of the three result tables that the database lacks."""
    contracts = {"segments": fixed.SEGMENT_COLUMNS, "summary": fixed.SUMMARY_COLUMNS, "runs": fixed.RUN_COLUMNS}
    for name, (columns, keys, _, _) in DATABASE_TABLES.items():
        if not table_exists(spark, url, f"{prefix}{name}", user, password):
            fields = {c: contracts[name][c] for c in columns}
            run_sql(spark, url, [create_table_sql(f"{prefix}{name}", fields, keys, types)], user, password)


def upsert_database(df: DataFrame, url: str, name: str, table: str, user: str = "", password: str = "", **options) -> None:
    """Upsert ``segments``, ``summary`` or ``runs`` rows into a database table.

    Executors fill a staging table; the database then merges it by key in one statement. The staging table goes, also
    when the write or the merge fails.
    """
    columns, keys, keep, batch_rows = DATABASE_TABLES[name]
    staging = f"{table}_staging_{uuid.uuid4().hex}"
    login = {"user": user, "password": password} if user else {}
    empty = f"CREATE TABLE {staging} AS SELECT {', '.join(columns)} FROM {table} WITH NO DATA"
    run_sql(df.sparkSession, url, [empty], user, password)
    try:
        write_jdbc(df.select(*columns), url, staging, batch_rows, **login, **options)
        run_sql(df.sparkSession, url, [merge_sql(table, staging, columns, keys, keep)], user, password)
    finally:
        run_sql(df.sparkSession, url, [f"DROP TABLE {staging}"], user, password)


def write_kafka(messages: DataFrame, servers: str, topic: str, partitions: int | None = None, **options) -> None:
    """Publish a batch of messages, keyed per signal, each key's in order.

    With the topic's number of ``partitions``, each row names its own: the one that producers in any language choose.
    """
    settings = KAFKA_OPTIONS | {"kafka.bootstrap.servers": servers} | options
    rows = by_key_in_order(keyed_json(messages, topic)).drop("chunk_index")
    if partitions is not None:
        rows = rows.withColumn("partition", broker_partition(F.col("key"), partitions))
    rows.write.format("kafka").options(**settings).save()


def stream_to_kafka(rows: DataFrame, servers: str, checkpoint: str, **options) -> StreamingQuery:
    """Publish a stream of ``topic``, ``key``, ``value`` rows; the topic may differ from row to row."""
    settings = KAFKA_OPTIONS | {"kafka.bootstrap.servers": servers} | options
    return rows.writeStream.format("kafka").options(**settings).option("checkpointLocation", checkpoint).start()


def write_message_files(messages: DataFrame, path: str, topic: str) -> None:
    """The same rows as JSON files, ordered within each key."""
    in_key_order(keyed_json(messages, topic)).select("topic", "key", "value").write.mode("append").json(path)


def write_line_files(rows: DataFrame, root: str, order: Sequence[str], header: str) -> None:
    """Text files below ``root``, one for each ``file`` of ``rows``, of its ``line`` values in ``order``.

    Spark's own writer gives files no names, and a folder for each that someone must list and rename them out of. Here
    the task that holds a file's rows writes it under its name, row by row, and shows it once it is whole.
    """
    base = qualified_path(rows.sparkSession, root)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import posixpath
        import uuid

        from pyarrow import fs

        # Hadoop names a local folder file:/, Arrow by its path.
        system, folder = (fs.LocalFileSystem(), base[5:]) if base.startswith("file:/") else fs.FileSystem.from_uri(base)
        name = stream = hidden = None
        files = 0

        def close() -> None:
            if stream is not None:
                stream.close()
                system.move(hidden, posixpath.join(folder, name))

        made = set()
        for batch in batches:
            for file, line in zip(batch["file"].to_pylist(), batch["line"].to_pylist()):
                if file != name:
                    close()
                    name, files = file, files + 1
                    parent = posixpath.dirname(posixpath.join(folder, name))
                    if parent not in made:
                        system.create_dir(parent, recursive=True)
                        made.add(parent)
                    hidden = posixpath.join(parent, f"_{uuid.uuid4()}")
                    stream = system.open_output_stream(hidden)
                    stream.write(header.encode() + b"\n")
                stream.write(line.encode() + b"\n")
        close()
        yield pa.RecordBatch.from_arrays([pa.array([files], pa.int64())], names=["files"])

    ordered = rows.repartition("file").sortWithinPartitions("file", *order).select("file", "line")
    ordered.mapInArrow(write, "files long").write.format("noop").mode("overwrite").save()
