"""Shared steps: written tables, global row numbers, connected components, shipping the package to workers."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.session import stage

#: monotonically_increasing_id keeps the partition above this bit and the row within it below.
PART_BIT = 33
#: Sums of all partitions meet in so many groups before they reach the driver.
GROUPS = 32


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session (functions there import it by name)."""
    context = spark.sparkContext
    if getattr(context, "_tallyguard_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="package-")
    copy = Path(folder, "copy", "tallyguard")
    shutil.copytree(root / "tallyguard", copy, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(str(Path(folder, "tallyguard_workers")), "zip", copy.parent, "tallyguard"))
    context._tallyguard_shipped = True


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text, NULL as no bytes."""
    return F.encode(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "UTF-8")


def remainder(column: str, divisor: int) -> Column:
    """crc32 of a number's decimal digits, modulo ``divisor``; NULL counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def numbered(df: DataFrame, order: list[Column | str], number: str = "row_no") -> DataFrame:
    """All rows with a gapless number from 0 in ``order``, written once.

    The rows are written first, since a sort by range reads them twice, then sorted across the cluster; each
    keeps its partition and its place there, and the counts of the partitions (as many as there are
    partitions, never more) give the offsets.
    """
    placed = stage(df, "unsorted").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", PART_BIT)
    offsets = part_offsets(placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size")))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(number, F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << PART_BIT) - 1)))
        .drop("_part", "_place", "_offset")
    )


def part_offsets(sizes: DataFrame) -> DataFrame:
    """(_part, _offset) from (_part, _size): what lies before each partition. One row a partition."""
    at, out = 0, []
    for row in sizes.orderBy("_part").collect():
        out.append((row["_part"], at))
        at += row["_size"]
    return sizes.sparkSession.createDataFrame(out, "_part bigint, _offset bigint")


def integer_names(df: DataFrame, keys: list[str], name: str = "name") -> DataFrame:
    """One row a distinct key with an integer name; names follow the sort order of the keys. Written once."""
    distinct = df.select(*keys).distinct()
    ranked = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(ranked.withColumn(name, F.monotonically_increasing_id()), "names")


def components(links: DataFrame, limit: int = 100) -> DataFrame:
    """(node, root): every node of ``links`` (a, b) with the smallest node it can reach.

    Alternating large-star and small-star rounds: nodes hook onto the smallest neighbour until only stars are
    left, in about log(diameter) rounds. Minima are aggregates with a partial step, and are dealt out anew
    before they are joined, so that both sides of the join are plain shuffles whose hot partitions adaptive
    execution can split: the centre of a large star isn't one task. Every round is a written table.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct(),
        "links",
    )
    before = None
    for _ in range(limit):
        edges = stage(_small_star(_large_star(edges)), "star")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())
        if now == before:
            return edges
        before = now
    raise RuntimeError(f"no fixed point after {limit} rounds")


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    dealt = least.repartition("u", "m")
    return edges.join(dealt, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (or itself)."""
    both = edges.select(F.col("node").alias("u"), F.col("root").alias("v")).union(
        edges.select(F.col("root").alias("u"), F.col("node").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = _with_least(both, least).where("v > u")
    return tied.select(F.col("v").alias("node"), F.col("m").alias("root")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.col("node").alias("u"), F.col("root").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = _with_least(down, least).where("v <> m").select(F.col("v").alias("node"), F.col("m").alias("root"))
    return tied.union(least.select(F.col("u").alias("node"), F.col("m").alias("root"))).distinct()


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def summed(rows: DataFrame, size: int, make) -> np.ndarray:
    """The sum of one array per partition. Partitions meet in a bounded number of groups, one array reaches the
    driver from each."""

    def partial(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += make(batch).ravel()
        group = pa.array([TaskContext.get().partitionId() % GROUPS], pa.int32())
        yield pa.RecordBatch.from_arrays([group, pa.array([total], pa.list_(pa.float64()))], ["part", "total"])

    def together(group: pa.Table) -> pa.Table:
        total = np.zeros(size)
        for chunk in group["total"].chunks:
            total += matrix(chunk).sum(axis=0)
        return pa.Table.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["total"])

    partials = rows.mapInArrow(partial, "part int, total array<double>")
    groups = partials.groupBy("part").applyInArrow(together, "total array<double>").collect()
    return np.sum([g["total"] for g in groups], axis=0) if groups else np.zeros(size)
