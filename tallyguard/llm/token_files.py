"""Token files: blocks of ids coded by a shared table, with checkpoints and checksums, in document order."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.llm import rans
from tallyguard.llm.base import part_offsets, ship, stage
from tallyguard.llm.tokens import encoder
from tallyguard.session import scratch_path

END_ID = 1
BLOCK_IDS = 1 << 18

BLOCKS = (
    "block_start bigint, n_ids bigint, words binary, places binary, states binary, ids_crc32 bigint, "
    "words_crc32 bigint, pieces array<struct<id: {kind}, document_start: bigint, n_tokens: bigint, length: bigint>>"
)


def encode_in_order(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Rows (part, part_start, id, n_tokens, ids, counts) sorted by id within parts that are ranges of ids.

    ``counts`` is NULL but in one more row at the end of each part, without ids, which counts the part's ids.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    source = source.withColumn("size", F.octet_length("text"))
    order = ["id", "size"]
    ranged = source.repartitionByRange(*order).sortWithinPartitions("id", "size", "text").drop("size")
    kind = source.schema["id"].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")

    def tokens(batches):
        encode, part, at = encoder(path), TaskContext.get().partitionId(), 0
        found = np.zeros(0, "int64")
        for batch in batches:
            ids = [encode(text.as_py()) + end for text in batch.column(1)]
            counts = np.array([len(x) // 4 for x in ids], "int64")
            found = added(found, ids)
            starts = at + np.cumsum(counts) - counts
            at += int(counts.sum())
            narrow = [np.frombuffer(x, "<u4") for x in ids]
            narrow = [x.astype("<u2").tobytes() if len(x) and x.max() < 65536 else b"\0" + x.tobytes() for x in narrow]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), part, "int64")),
                    pa.array(starts),
                    batch.column(0),
                    pa.array(counts),
                    pa.array(narrow, pa.binary()),
                    pa.nulls(len(ids), counted),
                ],
                names,
            )
        ids = np.flatnonzero(found)
        last = [{"token": t, "count": n} for t, n in zip(ids.tolist(), found[ids].tolist())]
        row = [[part], [at], None, [0], None, [last]]
        kinds = [pa.int64(), pa.int64(), id_type, pa.int64(), pa.binary(), counted]
        yield pa.RecordBatch.from_arrays([pa.nulls(1, t) if v is None else pa.array(v, t) for v, t in zip(row, kinds)], names)

    names = ["part", "part_start", "id", "n_tokens", "ids", "counts"]
    id_type = arrow_fields(docs.sparkSession, f"id {kind}").field("id").type
    counted = pa.list_(pa.struct([("token", pa.int64()), ("count", pa.int64())]))
    ddl = f"part bigint, part_start bigint, id {kind}, n_tokens bigint, ids binary, counts array<struct<token: bigint, count: bigint>>"
    return ranged.mapInArrow(tokens, ddl)


def added(total: np.ndarray, ids: list[bytes]) -> np.ndarray:
    """Counts by id, with those of some more documents."""
    found = np.bincount(np.frombuffer(b"".join(ids), "<u4")) if ids else np.zeros(0, "int64")
    if len(found) < len(total):
        found, total = total, found
    found[: len(total)] += total
    return found


def widen(data: bytes) -> np.ndarray:
    """Ids from their stored bytes: 16 bits each, or 32 bits each after a zero byte (odd length)."""
    return np.frombuffer(data, "<u4", offset=1) if len(data) % 2 else np.frombuffer(data, "<u2").astype("<u4")


def count_ids(rows: DataFrame) -> list:
    """(token, count) over all documents, at most one row per id of the vocabulary.

    The counts of the parts that a task reads are added up before they are shuffled.
    """

    def added_up(batches):
        total = np.zeros(0, "int64")
        for batch in batches:
            pairs = batch.column(0).flatten()
            tokens, counts = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if len(tokens):
                total = np.concatenate([total, np.zeros(max(0, int(tokens.max()) + 1 - len(total)), "int64")])
                np.add.at(total, tokens, counts)
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["token", "count"])

    counted = rows.where("counts IS NOT NULL").select("counts").mapInArrow(added_up, "token bigint, count bigint")
    return counted.groupBy("token").agg(F.sum("count").alias("count")).collect()


def write_token_files(
    docs: DataFrame,
    path: str,
    folder: str,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode all documents, append the end id, and write the ids in ascending order of ``id_col``.

    Texts are sorted by range of id, encoded once into a written table and their ids counted on the way; the
    table of frequencies stands beside the blocks (``folder``/table). A block in ``folder``/blocks holds up to
    ``block_ids`` ids of neighbouring documents, coded on its own, with checkpoints every CHECKPOINT_ROWS rows
    of lanes and checksums of its ids and of its words; a longer document goes on in further blocks. NULL and
    empty texts are the end id alone, NULL ids come first, repeated rows are written each, other columns are
    not read. Spark's writer commits the blocks, so a lost executor only repeats its tasks.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = stage(encode_in_order(docs, path, end_id, id_col, text_col), "ids")
    offsets = part_offsets(rows.groupBy(F.col("part").alias("_part")).agg(F.sum("n_tokens").alias("_size")))
    counts = [(r["token"], r["count"]) for r in count_ids(rows)]
    spark.createDataFrame(counts, "token bigint, count bigint").coalesce(1).write.parquet(f"{folder}/table")
    shared = spark.sparkContext.broadcast(counts)
    kind = rows.schema["id"].dataType.simpleString()

    def block(table, parts):
        ids = np.concatenate([p[4] for p in parts])
        words, places, states = rans.encode(table, ids)
        words = words.astype("<u4").tobytes()
        first = parts[0]
        return {
            "block_start": first[1] + first[3],
            "n_ids": len(ids),
            "words": words,
            "places": places.astype("<i8").tobytes(),
            "states": states.astype("<u8").tobytes(),
            "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()),
            "words_crc32": zlib.crc32(words),
            "pieces": [{"id": p[0], "document_start": p[1], "n_tokens": p[2], "length": len(p[4])} for p in parts],
        }

    def blocks(batches):
        table, parts, size, reach = make_table(shared.value), [], 0, None
        for batch in batches:
            out = []
            for id_, start, n, data in zip(*[c.to_pylist() for c in batch.columns]):
                ids = widen(data)
                if parts and reach != start:
                    out.append(block(table, parts))
                    parts, size = [], 0
                reach = start + n
                at = 0
                while at < n:
                    piece = ids[at : at + block_ids - size]
                    parts.append((id_, start, n, at, piece))
                    at, size = at + len(piece), size + len(piece)
                    if size == block_ids:
                        out.append(block(table, parts))
                        parts, size = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if parts:
            yield pa.RecordBatch.from_pylist([block(table, parts)], schema)

    placed = rows.where("counts IS NULL").withColumnRenamed("part", "_part").join(F.broadcast(offsets), "_part")
    placed = placed.select("id", (F.col("_offset") + F.col("part_start")).alias("start"), "n_tokens", "ids")
    ddl = BLOCKS.format(kind=kind)
    schema = pa.schema(arrow_fields(spark, ddl))
    placed.mapInArrow(blocks, ddl).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def arrow_fields(spark: SparkSession, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def make_table(counts: list[tuple[int, int]]) -> rans.Table:
    pairs = np.array(counts or [(0, 1)], "int64")
    return rans.Table(pairs[:, 0], pairs[:, 1])


def read_blocks(spark: SparkSession, folder: str, use):
    """The blocks with a function that decodes and checks one; ``use`` makes a map over Arrow batches of it."""
    counts = [(r["token"], r["count"]) for r in spark.read.parquet(f"{folder}/table").collect()]
    shared = spark.sparkContext.broadcast(counts)

    def ids_of(table, row) -> np.ndarray:
        if zlib.crc32(row["words"]) != row["words_crc32"]:
            raise ValueError(f"words of the block at {row['block_start']} are damaged")
        words, places = np.frombuffer(row["words"], "<u4"), np.frombuffer(row["places"], "<i8")
        states = np.frombuffer(row["states"], "<u8").reshape(len(places), -1)
        ids = rans.decode(table, words, places, states, row["n_ids"])
        if zlib.crc32(ids.tobytes()) != row["ids_crc32"]:
            raise ValueError(f"ids of the block at {row['block_start']} are damaged")
        return ids

    def mapped(batches):
        table = make_table(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield use(row, ids_of(table, row))

    return spark.read.parquet(f"{folder}/blocks"), mapped


def read_documents(spark: SparkSession, folder: str, id_col: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Read token files back: ``id_col``, start, n_tokens, ids_crc32, and ids where ``with_ids``.

    Blocks are decoded and checked independently. A document that goes over several blocks comes out of each
    as a piece with its checksum; the pieces, written once, are put together by its start, and their checksums
    combined.
    """
    def use(row, ids):
        pieces = row["pieces"]
        ends = np.cumsum([p["length"] for p in pieces])
        own = [ids[e - p["length"] : e] for e, p in zip(ends, pieces)]
        fields = [
            pa.array([p["id"] for p in pieces], id_type),
            pa.array([p["document_start"] for p in pieces], pa.int64()),
            pa.array([p["n_tokens"] for p in pieces], pa.int64()),
            pa.array([row["block_start"] + e - p["length"] for e, p in zip(ends, pieces)], pa.int64()),
            pa.array([p["length"] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
        ]
        names = ["id", "start", "n_tokens", "place", "length", "crc"]
        if with_ids:
            fields.append(pa.array([x.astype("int32") for x in own], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(fields, names)

    blocks, mapped = read_blocks(spark, folder, use)
    kind = blocks.schema["pieces"].dataType.elementType["id"].dataType.simpleString()
    id_type = arrow_fields(spark, f"id {kind}").field("id").type
    ddl = f"id {kind}, start bigint, n_tokens bigint, place bigint, length bigint, crc bigint"
    pieces = stage(blocks.mapInArrow(mapped, ddl + (", ids array<int>" if with_ids else "")), "pieces")
    whole = F.col("length") == F.col("n_tokens")
    columns = ["id", "start", "n_tokens", F.col("crc").alias("ids_crc32"), *(["ids"] if with_ids else [])]
    done = pieces.where(whole).select(*columns)
    parts = F.array_sort(F.collect_list(F.struct("place", "length", "crc", *(["ids"] if with_ids else []))))
    grouped = pieces.where(~whole).groupBy("start").agg(
        F.first("id").alias("id"), F.first("n_tokens").alias("n_tokens"), parts.alias("parts")
    )

    @F.udf("bigint")
    def combined(parts):
        crc = 0
        for part in parts:
            crc = crc32_combine(crc, part["crc"], 4 * part["length"])
        return crc

    long_ = grouped.withColumn("crc", combined("parts"))
    if with_ids:
        long_ = long_.withColumn("ids", F.flatten(F.transform("parts", lambda p: p["ids"])))
    return done.union(long_.select(*columns)).withColumnRenamed("id", id_col)


def crc32_combine(first: int, second: int, length: int) -> int:
    """Checksum of two byte strings together, from theirs and the length of the second.

    Appending a zero byte is a linear map of the 32 bits of a checksum; its powers by squaring carry the first
    checksum over ``length`` zero bytes.
    """
    step = [0xEDB88320] + [1 << i for i in range(31)]
    for _ in range(3):
        step = [_apply(step, column) for column in step]
    while length:
        if length & 1:
            first = _apply(step, first)
        step = [_apply(step, column) for column in step]
        length >>= 1
    return first ^ second


def _apply(columns: list[int], vector: int) -> int:
    out, i = 0, 0
    while vector:
        if vector & 1:
            out ^= columns[i]
        vector >>= 1
        i += 1
    return out


def round_trip(docs: DataFrame, path: str, **options) -> DataFrame:
    """Write token files into a fresh folder and read the documents back from them."""
    folder = scratch_path(docs.sparkSession, "token_files")
    write_token_files(docs, path, folder, **options)
    return read_documents(docs.sparkSession, folder, options.get("id_col", "doc_id"))
