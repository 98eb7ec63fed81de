"""Results are only right when these equal the data contract, so they are stated as they are."""

# Defaults of the two jobs.
SEGMENT_COUNT = 16
DRIFT_THRESHOLD = 0.35
CHUNK_SIZE = 5000
SAMPLE_RATE_HZ = 25000
LEADS_WHEN_COMPLETE = 16
LINE_INTERVAL_SECONDS = 10.0
SCORE_FLOOR = 1e-9

# File-name and path patterns of the batch job.
LINE_PREFIX_PATTERN = r"^([0-9]+)_"
BATTERY_PATTERN = r"(?i)battery_([0-9]+)"
PATH_DATE_PATTERN = r"20[0-9]{6}"
TRAILING_CHANNEL_PATTERN = r"(?i)_(CH[01]|laser_[ab]|L[AB])$"
CHANNEL_0_PATH_TOKENS = ["concat_reflected", "laser_b", "/reflect/", "_lb"]
CHANNEL_1_PATH_TOKENS = ["concat_out", "laser_a", "/out/", "_la"]

# File-name and path patterns of the publish job.
# Groups: date, time, sequence, line, batch, product, lead, channel digit, laser id.
FORMAL_NAME_PATTERN = (
    r"^([0-9]{8})_([0-9]{6})_([0-9]+)_([A-Za-z0-9]+)_([0-9]{2})_([A-Za-z0-9_-]+)_([0-9]{2})_(?:CH([01])|(L[AB]))\.csv$"
)
# Groups: date, battery digits, channel digit, laser name.
SIMPLE_NAME_PATTERN = r"^([0-9]{8})_battery_([0-9]+)_(?:CH([01])|(laser_[ab]))\.csv$"
FOLDER_DATE_PATTERN = r"^[0-9]{8}$"
TRAILING_DIGITS_PATTERN = r"([0-9]+)$"
LASER_CHANNELS = {"laser_b": 0, "laser_a": 1, "LB": 0, "LA": 1}
FOLDER_CHANNELS = {
    "concat_out_0": 1,
    "concat_reflected_1": 0,
    "reflect": 0,
    "laser_b": 0,
    "out": 1,
    "laser_a": 1,
}
DEFAULT_LINE_ID = "LINE_01"

# Message contents and formats.
LINE_ID_FORMAT = "LINE_%02d"
MESSAGE_ID_FORMAT = "%s:L%02d:%s:%06d"
PARTITION_KEY_FORMAT = "%s_%s_L%02d_%s"
REPLAY_ID_FORMAT = "%s_%s_R%05d"
MESSAGE_SOURCE = "file_replay_producer"
MESSAGE_VERSION = "v1"
LEAD_TYPES = ["AL_CU", "CU_CU"]
CHANNEL_CODES = ["LB", "LA"]
CHANNEL_NAMES = ["LaserB", "LaserA"]
MESSAGE_FIELDS = {
    "message_id": "STRING",
    "product_instance_id": "STRING",
    "product_id": "STRING",
    "line_id": "STRING",
    "batch_id": "STRING",
    "sequence_id": "STRING",
    "lead_num": "INT",
    "lead_type": "STRING",
    "channel": "INT",
    "channel_name": "STRING",
    "chunk_index": "INT",
    "total_chunks": "INT",
    "is_last_chunk": "BOOLEAN",
    "sample_rate_hz": "INT",
    "start_sample": "INT",
    "end_sample": "INT",
    "samples": "ARRAY<DOUBLE>",
    "event_time": "STRING",
    "metadata": "STRUCT<source: STRING, version: STRING, file_name: STRING, original_product_instance_id: STRING, "
    "is_duplicate: BOOLEAN, replay_iteration: INT>",
}
DATE_TIME_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
REQUIRED_MESSAGE_FIELDS = [
    "message_id",
    "product_instance_id",
    "product_id",
    "line_id",
    "lead_num",
    "lead_type",
    "channel",
    "chunk_index",
    "total_chunks",
    "is_last_chunk",
    "sample_rate_hz",
    "samples",
    "event_time",
    "metadata",
]
REQUIRED_METADATA_FIELDS = [
    "source",
    "version",
    "file_name",
    "original_product_instance_id",
    "is_duplicate",
    "replay_iteration",
]

# Kafka writer settings.
KAFKA_WRITE_OPTIONS = {
    "kafka.acks": "all",
    "kafka.retries": "10",
    "kafka.retry.backoff.ms": "500",
    "kafka.request.timeout.ms": "30000",
    "kafka.max.in.flight.requests.per.connection": "1",
    "kafka.compression.type": "gzip",
    "kafka.linger.ms": "20",
    "kafka.batch.size": "65536",
    "kafka.max.request.size": "5242880",
}

# The hash by which a broker's own clients choose a partition for a key.
KEY_HASH_SEED = 0x9747B28C
KEY_HASH_FACTOR = 0x5BD1E995
KEY_HASH_SHIFTS = (24, 13, 15)

# Output columns and their order.
SEGMENT_COLUMNS = {
    "run_id": "string",
    "processed_at": "timestamp",
    "source_file": "string",
    "file_name": "string",
    "event_date": "date",
    "line_number": "int",
    "line_id": "string",
    "product_id": "string",
    "channel": "int",
    "segment_index": "int",
    "parity_group": "string",
    "parity_order": "int",
    "sample_count": "int",
    "mean_value": "double",
    "std_value": "double",
    "min_value": "double",
    "max_value": "double",
}
SUMMARY_COLUMNS = {
    "run_id": "string",
    "line_id": "string",
    "line_number": "int",
    "event_date": "date",
    "product_id": "string",
    "source_file": "string",
    "channel": "int",
    "record_count": "bigint",
    "total_samples": "bigint",
    "odd_pattern_mean": "double",
    "even_pattern_mean": "double",
    "odd_even_gap": "double",
    "cpd_score": "double",
    "quality_decision": "string",
    "window_start": "timestamp",
    "window_end": "timestamp",
    "processed_at": "timestamp",
}
RUN_COLUMNS = {
    "run_id": "string",
    "status": "string",
    "started_at": "timestamp",
    "finished_at": "timestamp",
    "total_files": "bigint",
    "total_segment_rows": "bigint",
    "total_summary_rows": "bigint",
    "output_dir": "string",
    "details": "string",
}
SEGMENT_KEY = ["run_id", "source_file", "channel", "segment_index"]
SUMMARY_KEY = ["run_id", "source_file", "channel"]
RUN_KEY = ["run_id"]
