"""Group parsed signal files into product instances and pair their two channels per lead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigloom import fixed_values as fixed
from sigloom.functions import instances as inst
from sigloom.functions import paths
from sigloom.operators.columns import settled

INSTANCE_FIELDS = [
    "instance_id", "product_id", "line_id", "batch_id", "sequence_id", "lead_num", "channel", "event_time"
]
INSTANCE_ATTRIBUTES = ["product_id", "line_id", "batch_id", "sequence_id", "event_time"]


def _fields(**columns: Column) -> Column:
    return F.struct(*[columns[name].alias(name) for name in INSTANCE_FIELDS])


def parse_instances(files: DataFrame, relative_path: Column) -> DataFrame:
    """Add INSTANCE_FIELDS: from the formal file name, else the simple one, else the folders; all NULL if none fits.

    A channel named by a folder beats the one in the file name.
    """
    located = settled(files, __relative=relative_path)
    name = paths.file_name(F.col("__relative"))
    matched = settled(
        located,
        __formal=inst.name_groups(name, fixed.FORMAL_NAME_PATTERN, 9),
        __simple=inst.name_groups(name, fixed.SIMPLE_NAME_PATTERN, 4),
        __channel=inst.folder_channel(F.col("__relative")),
        __date=inst.folder_date(F.col("__relative")),
        __stem=paths.without_channel_suffix(paths.file_stem(name)),
    )
    by_folder = F.col("__channel")

    def channel(groups: Column, digit: int, laser: int) -> Column:
        by_laser = inst.lookup(fixed.LASER_CHANNELS, groups[laser])
        return F.coalesce(by_folder, by_laser, groups[digit].try_cast("int"))

    formal = F.col("__formal")
    by_formal_name = F.when(
        formal.isNotNull(),
        _fields(
            instance_id=F.concat_ws("_", F.slice(formal, 1, 6)),
            product_id=formal[5],
            line_id=formal[3],
            batch_id=formal[4],
            sequence_id=formal[2],
            lead_num=formal[6].cast("int"),
            channel=channel(formal, 7, 8),
            event_time=inst.event_time(formal[0], formal[1]),
        ),
    )
    simple = F.col("__simple")
    battery = paths.battery_id(simple[1])
    by_simple_name = F.when(
        simple.isNotNull(),
        _fields(
            instance_id=F.concat_ws("_", simple[0], battery),
            product_id=battery,
            line_id=F.lit(fixed.DEFAULT_LINE_ID),
            batch_id=simple[0],
            sequence_id=simple[1],
            lead_num=F.lit(1),
            channel=channel(simple, 2, 3),
            event_time=inst.event_time(simple[0]),
        ),
    )
    date, stem = F.col("__date"), F.col("__stem")
    by_folders = F.when(
        date.isNotNull() & by_folder.isNotNull(),
        _fields(
            instance_id=F.concat_ws("_", date, stem),
            product_id=stem,
            line_id=F.lit(fixed.DEFAULT_LINE_ID),
            batch_id=date,
            sequence_id=stem,
            lead_num=F.lit(1),
            channel=by_folder,
            event_time=inst.event_time(date),
        ),
    )
    best = settled(matched, __i=F.coalesce(by_formal_name, by_simple_name, by_folders))
    return best.select(*files.columns, "__i.*")


def product_instances(files: DataFrame) -> DataFrame:
    """One row per instance; on conflict the first file in path order says what the instance is."""
    first = F.min_by(F.struct(*INSTANCE_ATTRIBUTES), paths.path_parts(F.col("path")))
    return files.groupBy("instance_id").agg(first.alias("__first")).select("instance_id", "__first.*")


def lead_pairs(files: DataFrame) -> DataFrame:
    """One row per (instance, lead) with the path of each channel.

    When several files claim the same channel of a lead, the last in path order is used; ``duplicates`` counts the
    others.
    """

    def chosen(channel: int):
        parts = paths.path_parts(F.col("path"))
        return F.max_by("path", F.when(F.col("channel") == channel, parts))

    def claims(channel: int):
        return F.count_if(F.col("channel") == channel)

    def surplus(channel: int):
        return F.greatest(claims(channel) - 1, F.lit(0))

    return files.groupBy("instance_id", "lead_num").agg(
        chosen(0).alias("channel_0_path"),
        chosen(1).alias("channel_1_path"),
        (surplus(0) + surplus(1)).alias("duplicates"),
    )


def signal_files(pairs: DataFrame) -> DataFrame:
    """Long form of the pairs: (instance_id, lead_num, channel, path) of the files in use."""
    both = F.array(
        *[F.struct(F.lit(c).alias("channel"), F.col(f"channel_{c}_path").alias("path")) for c in (0, 1)]
    )
    return (
        pairs.select("instance_id", "lead_num", F.explode(both).alias("f"))
        .select("instance_id", "lead_num", "f.*")
        .filter("path IS NOT NULL")
    )


def missing_channels(pairs: DataFrame) -> DataFrame:
    """Leads that lack one of the two channels, and which."""
    missing = F.when(F.col("channel_0_path").isNull(), 0).when(F.col("channel_1_path").isNull(), 1)
    return pairs.select("instance_id", "lead_num", missing.alias("missing_channel")).filter("missing_channel IS NOT NULL")


def completeness(pairs: DataFrame) -> DataFrame:
    """Leads and channel pairs per instance; complete from 16 pairs on."""
    paired = F.col("channel_0_path").isNotNull() & F.col("channel_1_path").isNotNull()
    return (
        pairs.groupBy("instance_id")
        .agg(
            F.count("*").alias("leads_present"),
            F.count_if(paired).alias("channel_pairs"),
            F.sum("duplicates").alias("duplicates"),
        )
        .withColumn("is_complete", F.col("channel_pairs") >= fixed.LEADS_WHEN_COMPLETE)
    )


def only_complete(instances: DataFrame, pairs: DataFrame) -> DataFrame:
    complete = completeness(pairs).filter("is_complete").select("instance_id")
    return instances.join(complete, "instance_id", "left_semi")
