"""The hash of message keys against published values and a loop over bytes."""

import random

from pyspark.sql import functions as F

from sigloom.functions.messages import broker_partition, key_hash

PUBLISHED = {
    "21": -973932308,
    "foobar": -790332482,
    "a-little-bit-long-string": -985981536,
    "a-little-bit-longer-string": -1486304829,
    "lkjh234lh9fiuh90y23oiuhsafujhadof229phr9h19h89h8": -58897971,
    "abc": 479470107,
}


def plain(key):
    data, low, factor = key.encode(), 0xFFFFFFFF, 0x5BD1E995
    h = 0x9747B28C ^ len(data)
    whole = len(data) // 4 * 4
    for at in range(0, whole, 4):
        k = int.from_bytes(data[at : at + 4], "little") * factor & low
        h = (h * factor & low) ^ ((k ^ k >> 24) * factor & low)
    if data[whole:]:
        h = (h ^ int.from_bytes(data[whole:], "little")) * factor & low
    h = (h ^ h >> 13) * factor & low
    return h ^ h >> 15


def test_published_values_and_random_keys(spark):
    rng = random.Random(3)
    keys = [*PUBLISHED, "", *["".join(rng.choices("aZ9_é😀\x00", k=rng.randrange(40))) for _ in range(300)]]
    frame = spark.createDataFrame([(k,) for k in keys] + [(None,)], "key string")
    rows = frame.select("key", key_hash(F.col("key")).alias("h"), broker_partition(F.col("key"), 7).alias("p")).collect()
    for r in rows:
        if r.key is None:
            assert (r.h, r.p) == (None, None)
        else:
            assert (r.h, r.p) == (plain(r.key), (plain(r.key) & 0x7FFFFFFF) % 7)
    found = {r.key: r.h - (1 << 32) * (r.h >> 31) for r in rows if r.key is not None}
    assert {k: found[k] for k in PUBLISHED} == PUBLISHED
