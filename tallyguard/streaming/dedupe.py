"""Copies of a message: a producer that retries sends it twice, each time with its own offset."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tallyguard.session import ship_package
from tallyguard.streaming.ingest import TRIGGER_SECONDS, triggered

#: A filter has so many bits and sets so many of them per message: one message in five million passes by mistake.
BITS, HASHES = 32, 22
#: Messages of a segment of a filter, and of a batch up to which folders are sought by their filters.
SEGMENT = 1 << 18
MOST_SOUGHT = 1 << 21

FILTERS = "_filters"
FILTER_SCHEMA = "depth int, segment bigint, bits binary"
STORED = "kafka_ts timestamp, kafka_partition int, kafka_offset bigint, key string, raw_json string, digest string"


def dedupe_messages(bronze: DataFrame) -> DataFrame:
    """One row per (key, raw_json): the first by time, partition and offset.

    Copies within a task merge before the shuffle.
    """
    place = F.struct("kafka_ts", "kafka_partition", "kafka_offset")
    return (
        bronze.groupBy("key", "raw_json")
        .agg(F.min(place).alias("first"))
        .select("first.kafka_ts", "first.kafka_partition", "first.kafka_offset", "key", "raw_json")
    )


def places(hashes: np.ndarray, size: int):
    """The bits of each hash in a filter of ``size`` bits, a power of two: one array per hash function."""
    step = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    for i in range(HASHES):
        yield (hashes + np.uint64(i) * step) >> np.uint64(20) & np.uint64(size - 1)


def made_filter(hashes: np.ndarray) -> bytes:
    size = max(64, 1 << int(BITS * max(len(hashes), 1) - 1).bit_length())
    bits = np.zeros(size // 8, "uint8")
    for at in places(hashes, size):
        np.bitwise_or.at(bits, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype("uint8"))
    return bits.tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """The hashes that a filter may hold; it holds none of the others."""
    table = np.frombuffer(bits, "uint8")
    held = np.ones(len(hashes), bool)
    for at in places(hashes, 8 * len(table)):
        held &= table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype("uint8") & 1 > 0
    return hashes[held]


def write_filter(new: DataFrame, path: str, batch: int) -> None:
    """The filter of a folder's messages, in segments by the first bits of their hashes, beside the folder."""
    ship_package(new.sparkSession)
    depth = max(0, (new.count() - 1) // SEGMENT).bit_length()

    def build(key, group):
        hashes = group["hash"].to_numpy().astype("uint64")
        row = {"depth": depth, "segment": key[0].as_py(), "bits": made_filter(hashes)}
        return pa.Table.from_pylist([row], pa.schema([("depth", pa.int32()), ("segment", pa.int64()), ("bits", pa.binary())]))

    segment = F.shiftrightunsigned("hash", 64 - depth) if depth else F.lit(0).cast("bigint")
    hashed = new.select("hash").withColumn("segment", segment)
    rows = hashed.groupBy("segment").applyInArrow(build, FILTER_SCHEMA)
    rows.write.mode("overwrite").parquet(f"{path}/{FILTERS}/batch={batch}")


def folders_to_open(spark: SparkSession, path: str, hashes: np.ndarray | None, before: int) -> list[int]:
    """Earlier batches whose folders may hold one of the hashes; all of them where the hashes are not given."""
    try:
        filters = spark.read.schema(f"{FILTER_SCHEMA}, batch bigint").parquet(f"{path}/{FILTERS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    filters = filters.where(F.col("batch") < before)
    if hashes is not None:
        ship_package(spark)
        shared = spark.sparkContext.broadcast(np.sort(hashes))

        def hit(batches):
            for rows in batches:
                out = []
                for depth, segment, bits, batch in zip(*[c.to_pylist() for c in rows.columns]):
                    own = shared.value
                    if depth:
                        low = np.uint64(segment << (64 - depth))
                        high = np.uint64((segment + 1 << 64 - depth) - 1)
                        own = own[np.searchsorted(own, low) : np.searchsorted(own, high, "right")]
                    if len(may_hold(bits, own)):
                        out.append(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["batch"])

        filters = filters.mapInArrow(hit, "batch bigint")
    return sorted(r["batch"] for r in filters.select("batch").distinct().collect())


def dedupe_into(
    bronze: DataFrame,
    path: str,
    checkpoint: str,
    trigger_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
) -> StreamingQuery:
    """Append every message whose (key, raw_json) was never written before, however late it comes.

    Copies within a batch merge before the shuffle. Each batch writes one folder and, beside it, a Bloom filter of
    its messages (four to eight bytes each). A batch tests its hashes against the filters of earlier folders and
    opens only folders that may hold one of them, to compare key and digest; ordinarily that's none but those with
    copies. A backlog of more than ``MOST_SOUGHT`` messages opens all folders. A repeated batch replaces its folder
    and its filter and never looks into them.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        digest = F.sha2(F.coalesce("raw_json", F.lit("")), 256)
        digest = F.when(F.col("raw_json").isNull(), "").otherwise(digest)
        fresh = dedupe_messages(batch).withColumn("digest", digest).withColumn("hash", F.xxhash64("key", "digest"))
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            hashes = None
            if fresh.count() <= MOST_SOUGHT:
                hashes = fresh.select("hash").toArrow()["hash"].to_numpy().astype("uint64")
            opened = folders_to_open(spark, path, hashes, batch_id)
            new = fresh
            if opened:
                names = [f"{path}/batch={n}" for n in opened]
                seen = spark.read.schema(STORED).parquet(*names).select("key", "digest")
                same = (F.col("f.digest") == F.col("s.digest")) & F.col("f.key").eqNullSafe(F.col("s.key"))
                new = fresh.alias("f").join(seen.alias("s"), same, "left_anti")
            new.drop("hash").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
            written = spark.read.schema(STORED).parquet(f"{path}/batch={batch_id}")
            write_filter(written.withColumn("hash", F.xxhash64("key", "digest")), path, batch_id)
        finally:
            fresh.unpersist()

    writer = bronze.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger_seconds, available_now).start()
