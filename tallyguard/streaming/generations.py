"""Tables that a stream adds to batch by batch, merged into ever larger generations.

A batch writes a folder of its own, ``<path>/g0-<batch>-<batch>``. Whenever a level holds FAN_OUT folders, they're
merged into one of the next level, which covers all their batches: ``<path>/g1-<first>-<last>``. Which folders
count is told by a manifest, a file per batch that is put in place by one rename, so a reader sees the folders of
before or those of after, never both. A batch that runs again finds its number in the manifest that it wrote and
starts from the one before. Merged folders stay until ``MANIFESTS_KEPT`` further batches are through, for readers
that began earlier.

A partitioned table has a folder per value of a column within each generation, and a reader may name the values it
wants: the files of all others are neither listed nor opened.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Collection
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FAN_OUT = 8
MANIFESTS_KEPT = 4


@dataclass(frozen=True, order=True)
class Folder:
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"g{self.level}-{self.first:010d}-{self.last:010d}"


class Store:
    """The Hadoop file system of a path, for names and small files only."""

    def __init__(self, spark: SparkSession, path: str):
        jvm = spark.sparkContext._jvm
        self.path_of, self.path = jvm.org.apache.hadoop.fs.Path, path
        self.system = self.path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path_of(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path_of(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """Write beside, then rename: the file is there as a whole or not at all."""
        target, beside = self.path_of(f"{self.path}/{name}"), self.path_of(f"{self.path}/{name}.new")
        stream = self.system.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self.system.exists(target):
            self.system.delete(target, False)
        self.system.rename(beside, target)

    def remove(self, name: str) -> None:
        self.system.delete(self.path_of(f"{self.path}/{name}"), True)


MANIFESTS = "_manifests"
#: The folders of a partitioned generation; the column itself stays in the files.
PART = "generation_part"


def _manifest(batch: int) -> str:
    return f"{MANIFESTS}/{batch:012d}"


def current(store: Store, before: int | None = None) -> list[Folder]:
    """The folders that count, by the newest manifest (of a batch before ``before``)."""
    known = [n for n in store.names(MANIFESTS) if n.isdigit() and (before is None or int(n) < before)]
    return [Folder(*f) for f in json.loads(store.read(f"{MANIFESTS}/{known[-1]}"))] if known else []


def write_generation(
    rows: DataFrame,
    path: str,
    batch: int,
    merge: Callable[[DataFrame], DataFrame],
    after_write: Callable[[str], None] | None = None,
    partition: str | None = None,
) -> None:
    """Add a batch's rows and merge full levels. A repeated batch replaces what it had added.

    With ``partition``, a column without NULLs, every value gets a folder; skewed ones are split into files of the
    usual size.
    """
    spark, store = rows.sparkSession, Store(rows.sparkSession, path)
    folders = current(store, before=batch)

    def write(df: DataFrame, folder: Folder) -> None:
        if partition:
            dealt = df.hint("rebalance", F.col(partition)).withColumn(PART, F.col(partition).cast("string"))
            dealt.write.mode("overwrite").partitionBy(PART).parquet(f"{path}/{folder.name}")
        else:
            df.write.mode("overwrite").parquet(f"{path}/{folder.name}")
        if after_write:
            after_write(folder.name)

    own = Folder(0, batch, batch)
    write(rows, own)
    folders.append(own)
    level = 0
    while len(full := sorted(f for f in folders if f.level == level)) >= FAN_OUT:
        above = Folder(level + 1, full[0].first, full[-1].last)
        write(merge(_read(spark, store, full, rows.schema, bool(partition))), above)
        folders = [f for f in folders if f.level != level] + [above]
        level += 1
    store.put(_manifest(batch), json.dumps([(f.level, f.first, f.last) for f in folders]))
    _clean(store, batch)


def _clean(store: Store, batch: int) -> None:
    """Remove manifests that are old, and folders that none of those left names."""
    known = [n for n in store.names(MANIFESTS) if n.isdigit()]
    for name in known[: -MANIFESTS_KEPT - 1]:
        store.remove(f"{MANIFESTS}/{name}")
    named = {Folder(*f).name for n in known[-MANIFESTS_KEPT - 1 :] for f in json.loads(store.read(f"{MANIFESTS}/{n}"))}
    for name in store.names("."):
        if name.startswith("g") and name not in named and int(name.split("-")[2]) <= batch:
            store.remove(name)


def _read(
    spark: SparkSession,
    store: Store,
    folders: list[Folder],
    schema: str | StructType,
    partitioned: bool = False,
    parts: Collection[str] | None = None,
) -> DataFrame:
    paths = []
    for folder in sorted(folders):
        if not partitioned:
            paths.append(f"{store.path}/{folder.name}")
            continue
        there = {n.removeprefix(f"{PART}=") for n in store.names(folder.name) if n.startswith(f"{PART}=")}
        wanted = there if parts is None else there & set(parts)
        if wanted:
            listed = "*" if parts is None else f"{{{','.join(sorted(wanted))}}}"
            paths.append(f"{store.path}/{folder.name}/{PART}={listed}")
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_generations(
    spark: SparkSession,
    path: str,
    schema: str | StructType,
    before: int | None = None,
    partitioned: bool = False,
    parts: Collection[str] | None = None,
) -> DataFrame:
    """All rows of the folders that count (before a batch); none before the first one.

    Of a partitioned table, ``parts`` names the values to read, as text.
    """
    store = Store(spark, path)
    return _read(spark, store, current(store, before), schema, partitioned, parts)
