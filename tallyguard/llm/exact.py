"""Exact dedup by deterministic block naming, built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import integer_names, stage

BLOCK_CHARS = 4096


def normal_text(text: str = "text") -> Column:
    """Runs of blanks, tabs and line ends as one space; NULL as the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    block_key=lambda block: F.xxhash64(block),
) -> DataFrame:
    """Groups of texts that are identical after normalising blanks.

    Each text is cut into blocks of ``block_chars`` letters, in one pass over it. The distinct blocks, sorted by their key, get integer
    names; adjacent names are paired and the sorted distinct pairs named again, until every text has one
    name: (level, name) is its identity, and two texts share it exactly if they are equal. Blocks meet under
    a 64-bit key, and one aggregate over the bytes proves that no two different blocks share a key; if some
    do, blocks are sorted and joined by their bytes instead. Text is shuffled once.

    Returns one row per input row: ``id_col``, row_no (a row's own key), keep_id (smallest id of its group,
    NULL ids last), keep_row, group_size, kept, text_sha256. NULL text counts as empty, an empty text is one
    empty block. Rows repeated with the same id are a group like any other: one of them is kept. Other
    columns are not read, and an empty table gives no rows.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(id_col).alias("id"),
        normal_text(text_col).alias("text"),
    )
    # One expression that yields all blocks: a lambda over block numbers would make Spark normalise the text for each.
    found = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    blocks = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(found)
    cut = rows.select(F.explode(blocks).alias("block")).select(block_key(F.col("block")).alias("key"), "block")
    keys = stage(cut.groupBy("key").agg((F.min("block") != F.max("block")).alias("shared")), "block_keys")
    by_bytes = not keys.where("shared").isEmpty()
    on = ["key", "block"] if by_bytes else ["key"]
    pieces = F.transform(blocks, lambda b: F.struct(block_key(b).alias("key"), *([b.alias("block")] if by_bytes else [])))
    table = stage(rows.select("row_no", "id", F.sha2("text", 256).alias("sha"), pieces.alias("pieces")), "documents")
    at = table.select("row_no", "id", F.size("pieces").alias("left"), F.posexplode("pieces").alias("pos", "piece"))
    at = at.select("row_no", "id", "left", "pos", *[F.col(f"piece.{c}").alias(c) for c in on])
    names = integer_names(at if by_bytes else keys, on)
    at = stage(at.join(names, on).select("row_no", "id", "left", "pos", "name"), "named")
    level, found = 0, at.where("left = 1").select("row_no", "id", F.lit(0).alias("level"), "name")
    more = at.where("left > 1")
    while not more.isEmpty():
        level += 1
        pairs = more.groupBy("row_no", "id", "left", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("first"),
            F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("second"),
        )
        pairs = stage(pairs.withColumn("second", F.coalesce("second", F.lit(-1))), "pairs")
        names = integer_names(pairs, ["first", "second"])
        halved = F.ceil(F.col("left") / 2).cast("int").alias("left")
        at = stage(pairs.join(names, ["first", "second"]).select("row_no", "id", halved, "pos", "name"), "named")
        found = found.union(at.where("left = 1").select("row_no", "id", F.lit(level).alias("level"), "name"))
        more = at.where("left > 1")
    first = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("row_no")))
    groups = found.groupBy("level", "name").agg(first.alias("first"), F.count("*").alias("size"))
    groups = stage(groups.where("size > 1"), "groups")
    joined = found.join(groups, ["level", "name"], "left").join(table.select("row_no", "sha"), "row_no")
    alone = F.col("size").isNull()
    keep_row = F.when(alone, F.col("row_no")).otherwise(F.col("first.row_no"))
    return joined.select(
        F.col("id").alias(id_col),
        "row_no",
        F.when(alone, F.col("id")).otherwise(F.col("first.id")).alias("keep_id"),
        keep_row.alias("keep_row"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("row_no") == keep_row).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
