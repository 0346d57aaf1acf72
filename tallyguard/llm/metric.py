"""Near-dedup of vectors: exact metric range join over pivot cells."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.base import components, ship, stage

THRESHOLD = 0.95
#: Vectors a cell is meant to hold, most pivots, and the rows of a block that a task compares.
CELL_ROWS = 4096
MAX_PIVOTS = 1024
BLOCK_ROWS = 4096
#: Widens the radius so that rounding never hides a pair: distances are roots of 2 - 2 cos, whose rounding they enlarge.
SLACK = 1e-6


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), "float64").reshape(-1, dim)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt(np.einsum("ij,ij->i", flat, flat))[:, None]


def by_dimension(column: pa.Array):
    """(dim, positions) of each vector length in a column."""
    sizes = np.asarray(pc.list_value_length(column).to_numpy(zero_copy_only=False), "int64")
    for dim in np.unique(sizes):
        yield int(dim), np.flatnonzero(sizes == dim)


class Pivots:
    """Pivot vectors, and which cells a vector belongs to and visits."""

    def __init__(self, vectors: list[list[float]], threshold: float):
        self.radius = np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
        self.of: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        lengths = np.array([len(v) for v in vectors])
        for dim in np.unique(lengths):
            at = np.flatnonzero(lengths == dim)
            unit = unit_rows(pa.array([vectors[i] for i in at]), int(dim))
            gap = np.sqrt(np.maximum(0, 2 - 2 * unit @ unit.T))
            self.of[int(dim)] = (at, unit, gap)

    def homes(self, unit: np.ndarray, dim: int) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its pivot): the nearest pivot; cell -1 where no pivot has this length."""
        if dim not in self.of:
            return np.full(len(unit), -1, "int64"), np.zeros(len(unit))
        at, pivots, _ = self.of[dim]
        cos = unit @ pivots.T
        near = cos.argmax(axis=1)
        return at[near].astype("int64"), np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(unit)), near]))

    def visits(
        self, unit: np.ndarray, dim: int, cell: np.ndarray, inner: np.ndarray, outer: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for all cells of higher number than ``cell`` that may hold a vector within the radius.

        ``cell`` is the home that was written: where pivots tie up to rounding, another batch may find another one.

        A vector y of cell j lies between the cell's inner and outer radius of pivot j, so by the triangle
        inequality x must lie within the join radius of that ring; and y is nearer to pivot j than to x's own,
        so the step from x to y must cross the plane halfway between the two pivots.
        """
        if dim not in self.of:
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        at, pivots, gap = self.of[dim]
        cos = unit @ pivots.T
        home = np.searchsorted(at, cell)
        apart = np.sqrt(np.maximum(0, 2 - 2 * cos))
        ring = (apart <= outer[at] + self.radius) & (apart >= inner[at] - self.radius)
        plane = cos[np.arange(len(unit)), home][:, None] - cos <= self.radius * gap[home] + SLACK
        rows, cells = np.nonzero(ring & plane & (np.arange(len(at)) > home[:, None]))
        return rows, at[cells].astype("int64")


def linked(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of at least the threshold; those at its very edge by a plain sum."""
    cos = left @ right.T
    out = cos >= threshold
    for i, j in zip(*np.nonzero(np.abs(cos - threshold) < 1e-12)):
        out[i, j] = float(np.dot(left[i], right[j])) >= threshold
    return out


def block_links(ids_a, w_a, a, ids_b, w_b, b, same: bool, threshold: float):
    """(id, weight of its links, smallest id tied to it) over one pair of blocks; ids without a link are left out."""
    ties = linked(a, b, threshold)
    if same:
        np.fill_diagonal(ties, False)
    some_a, some_b = ties.any(axis=1), ties.any(axis=0)
    if same:
        some_b = np.zeros_like(some_b)
    rows = np.flatnonzero(some_a)
    ties = ties[rows]
    root_a, root_b = ids_a[rows], ids_b.copy()
    top = np.iinfo("int64").max
    changed = len(rows) > 0
    while changed:
        changed = False
        for at in range(0, len(rows), 256):
            part = ties[at : at + 256]
            least = np.minimum(root_a[at : at + 256], np.where(part, root_b, top).min(axis=1))
            onto = np.where(part, least[:, None], top).min(axis=0)
            lower = np.minimum(root_b, onto)
            changed |= bool((least < root_a[at : at + 256]).any() or (lower < root_b).any())
            root_a[at : at + 256], root_b = least, lower
        if same:
            merged = np.minimum(root_a, root_b[rows])
            changed |= bool((merged < root_a).any())
            root_a = merged
            root_b[rows] = merged
    ids = np.concatenate([ids_a[rows], ids_b[some_b]])
    weight = np.concatenate([ties @ w_b, w_a[rows] @ ties[:, some_b]])
    root = np.concatenate([root_a, root_b[some_b]])
    return ids, weight.astype("int64"), root


def near_vectors(
    table: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cell_rows: int = CELL_ROWS,
    max_pivots: int = MAX_PIVOTS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``id_col``, n_links (other rows with a cosine of at least ``threshold``), component_id, kept. Exact.

    Equal vectors become one weighted vector. Each belongs to the cell of its nearest pivot; pivots are up to
    ``max_pivots`` of the distinct vectors, the first by hash. A pair of cells meets in the one of higher
    number, which the vectors of the other visit if the triangle inequality lets them have a partner there.
    Cells are cut into blocks of about ``block_rows`` and a task compares two blocks, so that a cell of any
    size is spread; a block pair gives one row per linked vector (weight and a spanning tie), never pairs.

    A vector that is NULL, empty, zero or holds a NULL or non-finite component links with nothing: n_links 0,
    its own component. Vectors of different lengths never link. Rows with one id twice count as two vectors;
    a NULL id never names a component (component_id NULL where there is no other). An empty table gives no
    rows; other columns are not read. ``threshold`` must be above 0.
    """
    spark = table.sparkSession
    ship(spark)
    rows = table.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = stage(
        rows.select("id", F.when(usable, F.col("v")).alias("v"), F.monotonically_increasing_id().alias("row_no")), "rows"
    )
    found = rows.where("v IS NOT NULL").groupBy("v")
    distinct = stage(
        found.agg(F.min("row_no").alias("rep"), F.min("id").alias("first"), F.count("*").alias("weight")), "distinct"
    )
    count = distinct.count()
    wanted = min(max_pivots, max(1, count // cell_rows))
    chosen = distinct.select("v").orderBy(F.xxhash64("v"), "v").limit(wanted).collect()
    pivots = Pivots([r["v"] for r in chosen], threshold)

    def at_home(batches):
        for batch in batches:
            cell, apart = np.full(batch.num_rows, -1, "int64"), np.zeros(batch.num_rows)
            for dim, at in by_dimension(batch.column(2)):
                unit = unit_rows(batch.column(2).take(pa.array(at)), dim)
                cell[at], apart[at] = pivots.homes(unit, dim)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(apart)], ["rep", "weight", "v", "cell", "apart"])

    kind = distinct.schema["v"].dataType.simpleString()
    ddl = f"rep bigint, weight bigint, v {kind}, cell bigint"
    homes = stage(distinct.select("rep", "weight", "v").mapInArrow(at_home, ddl + ", apart double"), "homes")
    rings = homes.groupBy("cell").agg(F.min("apart").alias("inner"), F.max("apart").alias("outer"), F.count("*").alias("n"))
    sizes = {r["cell"]: r for r in rings.collect()}
    inner, outer = np.full(wanted, np.inf), np.full(wanted, -np.inf)
    for cell, ring in sizes.items():
        if cell >= 0:
            inner[cell], outer[cell] = ring["inner"], ring["outer"]

    def visiting(batches):
        for batch in batches:
            for dim, at in by_dimension(batch.column(2)):
                unit = unit_rows(batch.column(2).take(pa.array(at)), dim)
                home = batch.column(3).to_numpy(zero_copy_only=False)[at]
                who, cells = pivots.visits(unit, dim, home, inner, outer)
                taken = batch.select([0, 1, 2]).take(pa.array(at[who]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells)], ["rep", "weight", "v", "cell"])

    visitors = stage(homes.select("rep", "weight", "v", "cell").mapInArrow(visiting, ddl), "visitors")
    crowds = {r["cell"]: r["count"] for r in visitors.groupBy("cell").count().collect()}
    cells = [(c, -(-r["n"] // block_rows), -(-crowds.get(c, 0) // block_rows)) for c, r in sizes.items()]
    plan = F.broadcast(spark.createDataFrame(cells, "cell bigint, blocks bigint, crowd bigint"))
    members = homes.drop("apart").join(plan, "cell")
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    inside = members.select("*", own.alias("own"), other).select(
        "cell", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        F.lit(False).alias("visit"), (F.col("own") <= F.col("other")).alias("left"), "rep", "weight", "v",
    )
    crowd = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("crowd") - 1)).alias("y")
    hosting = members.where("crowd > 0").select("*", own.alias("x"), crowd).select(
        "cell", "x", "y", F.lit(True).alias("visit"), F.lit(True).alias("left"), "rep", "weight", "v"
    )
    guests = visitors.join(plan, "cell")
    turn = F.pmod(F.xxhash64("rep"), F.col("crowd")).alias("y")
    guests = guests.select("*", turn, F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("x"))
    guests = guests.select("cell", "x", "y", F.lit(True).alias("visit"), F.lit(False).alias("left"), "rep", "weight", "v")

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        same = not group["visit"][0].as_py() and group["x"][0].as_py() == group["y"][0].as_py()
        reps, weights = group["rep"].to_numpy(), group["weight"].to_numpy()
        left = np.asarray(group["left"].to_numpy(zero_copy_only=False), bool)
        vectors = group["v"].combine_chunks()
        out = [[], [], []]
        for dim, at in by_dimension(vectors):
            a = at[left[at]]
            b = a if same else at[~left[at]]
            if not len(a) or not len(b):
                continue
            unit_a = unit_rows(vectors.take(pa.array(a)), dim)
            unit_b = unit_a if same else unit_rows(vectors.take(pa.array(b)), dim)
            found = block_links(reps[a], weights[a], unit_a, reps[b], weights[b], unit_b, same, threshold)
            for column, values in zip(out, found):
                column.append(values)
        columns = [pa.array(np.concatenate(c) if c else np.zeros(0, "int64"), pa.int64()) for c in out]
        return pa.Table.from_arrays(columns, ["rep", "links", "root"])

    units = inside.union(hosting).union(guests).groupBy("cell", "x", "y", "visit")
    ties = stage(units.applyInArrow(compare, "rep bigint, links bigint, root bigint"), "ties")
    roots = components(ties.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    linked_weight = ties.groupBy("rep").agg(F.sum("links").alias("links"))
    known = distinct.join(linked_weight, "rep", "left").join(roots, distinct["rep"] == roots["node"], "left")
    known = stage(
        known.select("v", "first", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("root", "rep").alias("root")),
        "known",
    )
    least = stage(known.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    known = stage(known.join(least, "root").select(F.xxhash64("v").alias("h"), "v", "n_links", "component_id"), "components")
    joined = rows.withColumn("h", F.xxhash64("v")).join(known, ["h", "v"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
