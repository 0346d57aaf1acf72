"""A whole profile from one table of (column, value, rows), made in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard.functions.dates import month_bucket, parse_date
from tallyguard.functions.labels import fraud_flag
from tallyguard.functions.numeric import numeric_columns
from tallyguard.functions.text import strip
from tallyguard.operators.profile import IQR_REACH, value_text
from tallyguard.operators.quantiles import EDGE_ROWS, running_counts
from tallyguard.session import stage
from tallyguard.sources.schemas import LABEL

QUARTILES = (0.25, 0.5, 0.75)


class ValueCounts:
    """Every column's distinct values as text, with their rows, labelled rows and frauds, written once.

    One scan makes an entry per row and column; entries merge before the one shuffle. The tables below read the
    written counts only and equal the functions of the same name over the rows: text gives every number back
    exactly, −0.0 counts as 0.0. What reaches the driver is one row per column.
    """

    def __init__(self, df: DataFrame, label: str = LABEL):
        self.schema, self.label, self.spark = df.schema, label, df.sparkSession
        self.place = {c: i for i, c in enumerate(df.columns)}
        entries = F.array(*[F.struct(F.lit(i).alias("i"), value_text(df, c).alias("value")) for c, i in self.place.items()])
        labelled = F.col(f"`{label}`").isNotNull().cast("bigint") if label in self.place else F.lit(0).cast("bigint")
        fraud = fraud_flag(F.col(f"`{label}`"), "strip") if label in self.place else F.lit(0).cast("bigint")
        counted = (
            df.select(labelled.alias("labelled"), fraud.alias("fraud"), F.inline(entries))
            .groupBy("i", "value")
            .agg(F.count("*").alias("n"), F.sum("labelled").alias("labelled"), F.sum("fraud").alias("frauds"))
        )
        self.made_from = counted
        self.table = stage(counted.sortWithinPartitions("i"), "value_counts")
        self._numbers = numeric_columns(df)
        self._facts = self._collect_facts()

    def of(self, column: str) -> DataFrame:
        """(value, n, labelled, frauds) of a column, the missing value included."""
        return self.table.where(F.col("i") == self.place[column]).drop("i")

    def _number(self) -> Column:
        """The value as a double, by way of the column's own type where that is narrower."""
        narrow = [self.place[f.name] for f in self.schema.fields if isinstance(f.dataType, T.FloatType)]
        value = F.col("value")
        return F.when(F.col("i").isin(*narrow), value.try_cast("float").cast("double")).otherwise(value.try_cast("double"))

    def _numeric(self, columns: Sequence[str]) -> DataFrame:
        """(i, x, c) of the values present in some number columns."""
        chosen = self.table.where(F.col("i").isin(*[self.place[c] for c in columns]) & F.col("value").isNotNull())
        return chosen.select("i", self._number().alias("x"), F.col("n").alias("c"))

    def _collect_facts(self) -> dict[str, Row]:
        present = F.col("value").isNotNull()
        is_number = F.col("i").isin(*[self.place[c] for c in self._numbers]) & present
        x = F.when(is_number, self._number())
        rows = self.table.groupBy("i").agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(present, F.col("n")).otherwise(0)).alias("non_null"),
            F.count("*").alias("n_unique"),
            F.try_divide(F.sum(x * F.col("n")), F.sum(F.when(is_number, F.col("n")))).alias("mean"),
            F.min(x).alias("min"),
            F.max(x).alias("max"),
        )
        names = list(self.place)
        return {names[r["i"]]: r for r in rows.collect()}

    def _table(self, rows: list[tuple], schema: str) -> DataFrame:
        return self.spark.createDataFrame(rows, schema)

    def shape(self) -> DataFrame:
        out = []
        for f in self.schema.fields:
            found = self._facts.get(f.name)
            counts = (found["non_null"], found["rows"]) if found else (0, 0)
            out.append((f.name, f.dataType.simpleString(), *counts, len(self.place)))
        return self._table(out, "column string, dtype string, non_null bigint, n_rows bigint, n_columns bigint")

    def missing(self) -> DataFrame:
        gaps = [(c, r["rows"] - r["non_null"]) for c, r in self._facts.items() if r["rows"] > r["non_null"]]
        return self._table(sorted(gaps, key=lambda g: (-g[1], g[0])), "column string, n_missing bigint")

    def cardinality(self) -> DataFrame:
        found = sorted(((c, r["n_unique"]) for c, r in self._facts.items()), key=lambda g: (-g[1], g[0]))
        return self._table(found, "column string, n_unique bigint")

    def quantiles(self, columns: Sequence[str], probs: Sequence[float] = QUARTILES) -> dict[str, tuple[float, ...]]:
        """Exact quantiles, linear between neighbours; a column without values is left out."""
        filled = [c for c in columns if c in self._facts and self._facts[c]["non_null"]]
        if not filled:
            return {}
        distinct = max(self._facts[c]["n_unique"] for c in filled)
        counted = self._numeric(filled).groupBy("i", "x").agg(F.sum("c").alias("c"))
        upto = running_counts(counted, ["i"], distinct > EDGE_ROWS)
        sizes = F.create_map(*[F.lit(v) for c in filled for v in (self.place[c], self._facts[c]["non_null"])])
        ends = []
        for k, p in enumerate(probs):
            rank = (F.element_at(sizes, F.col("i")) - 1) * F.lit(float(p))
            for side, at in (("a", F.floor(rank)), ("b", F.ceil(rank))):
                here = (at >= F.col("upto") - F.col("c")) & (at < F.col("upto"))
                ends.append(F.max(F.when(here, F.col("x"))).alias(f"{side}{k}"))
        names, out = list(self.place), {}
        for r in upto.groupBy("i").agg(*ends).collect():
            ranks = [(self._facts[names[r["i"]]]["non_null"] - 1) * float(p) for p in probs]
            pairs = [(r[f"a{k}"], r[f"b{k}"], rank % 1) for k, rank in enumerate(ranks)]
            out[names[r["i"]]] = tuple(a + (b - a) * part for a, b, part in pairs)
        return out

    def numbers(self, quartiles: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
        quartiles = self.quantiles(self._numbers) if quartiles is None else quartiles
        filled = [c for c in self._numbers if c in self._facts and self._facts[c]["non_null"]]
        squares: dict[int, float] = {}
        if filled:
            means = F.create_map(*[F.lit(v) for c in filled for v in (self.place[c], self._facts[c]["mean"])])
            gap = F.col("x") - F.element_at(means, F.col("i"))
            sums = self._numeric(filled).groupBy("i").agg(F.sum(gap * gap * F.col("c")).alias("s"))
            squares = {r["i"]: r["s"] for r in sums.collect()}
        out = []
        for c in self._numbers:
            r = self._facts.get(c)
            if not (r and r["non_null"]):
                out.append((c, 0, *[None] * 7))
                continue
            n = r["non_null"]
            std = (squares[self.place[c]] / (n - 1)) ** 0.5 if n > 1 else None
            out.append((c, n, r["mean"], std, r["min"], *quartiles[c], r["max"]))
        fields = ", ".join(f"{c} double" for c in ("mean", "std", "min", "q25", "q50", "q75", "max"))
        return self._table(out, f"column string, count bigint, {fields}")

    def labels(self) -> DataFrame:
        counts = self._label_counts()
        total = counts.agg(F.sum("n")).first()[0]
        share = F.round(F.col("n") * 100 / F.lit(total), 2).alias("pct")
        return counts.select("label", "n", share).orderBy(F.desc("n"), "label")

    def _label_counts(self) -> DataFrame:
        present = self.of(self.label).where("value IS NOT NULL")
        return present.groupBy(strip(F.col("value")).alias("label")).agg(F.sum("n").alias("n"))

    def imbalance(self) -> DataFrame:
        return self._label_counts().agg(
            F.count("*").alias("n_classes"), F.when(F.count("*") >= 2, F.min("n") / F.max("n")).alias("ratio")
        )

    def rates(self, columns: Sequence[str]) -> DataFrame:
        names = F.create_map(*[F.lit(v) for c in columns for v in (self.place[c], c)])
        rate = F.col("frauds") / F.col("labelled")
        return (
            self.table.where(F.col("i").isin(*[self.place[c] for c in columns]))
            .where("value IS NOT NULL AND labelled > 0")
            .select(F.element_at(names, F.col("i")).alias("column"), "value", rate.alias("rate"), F.col("labelled").alias("n"))
            .withColumn("rate_pct", F.round(F.col("rate") * 100, 2))
            .orderBy("column", F.desc("rate"), "value")
        )

    def outliers(self, column: str, quartiles: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
        found = (self.quantiles([column]) if quartiles is None else quartiles).get(column)
        low = high = None
        if found:
            reach = (found[2] - found[0]) * IQR_REACH
            low, high = found[0] - reach, found[2] + reach
        ends = [F.lit(e).cast("double") for e in (low, high)]
        outside = F.coalesce(F.sum(F.when((F.col("x") < ends[0]) | (F.col("x") > ends[1]), F.col("c"))), F.lit(0))
        every = F.coalesce(F.sum("c"), F.lit(0))
        return self._numeric([column]).agg(
            ends[0].alias("low"),
            ends[1].alias("high"),
            every.alias("n"),
            outside.alias("n_outliers"),
            F.try_divide(outside * 100, every).alias("pct_outliers"),
        )

    def trend(self, date: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
        """Rows without a label count as not fraud."""
        return (
            self.of(date)
            .select(month_bucket(parse_date(F.col("value"), fmt)).alias("month"), "n", "frauds")
            .where("month IS NOT NULL")
            .groupBy("month")
            .agg(F.sum("n").alias("n"), (F.sum("frauds") / F.sum("n") * 100).alias("rate_pct"))
            .orderBy("month")
        )

    def crosstab(self, column: str) -> DataFrame:
        share = F.col("frauds") / F.col("labelled") * 100
        return (
            self.of(column)
            .where("value IS NOT NULL AND labelled > 0")
            .select(
                F.col("value").try_cast(self.schema[column].dataType).alias("value"),
                F.round(100 - share, 2).alias("pct_normal"),
                F.round(share, 2).alias("pct_fraud"),
            )
            .orderBy("value")
        )
