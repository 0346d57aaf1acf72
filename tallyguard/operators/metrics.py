"""Scores of a binary classifier."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: accuracy, and precision, recall and F1 of class 1, 0 where undefined."""
    actual, said = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count("*").alias("n"),
        F.count_if(actual & said).alias("tp"),
        F.count_if(~actual & said).alias("fp"),
        F.count_if(actual & ~said).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        _ratio(F.col("n") - fp - fn, F.col("n")).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def roc_auc_value(df: DataFrame, label: str = "label", score: str = "score") -> float | None:
    """Exact area under the ROC curve, ties counted half; None with a single class.

    The built-in evaluator without binning sorts the distinct scores across the cluster. Adding zero
    makes a negative zero tie with zero.
    """
    value = F.col(score).cast("double") + F.lit(0.0)
    scored = df.select(F.col(label).cast("double").alias("label"), value.alias("score"))
    positives, rows = scored.agg(F.count_if(F.col("label") == 1), F.count("*")).first()
    if positives in (0, rows):
        return None
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="score", labelCol="label", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    value = roc_auc_value(df, label, score)
    return df.sparkSession.createDataFrame([(value,)], "roc_auc double")


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(name, precision, recall, f1, support) per class, then accuracy, macro and weighted means.

    The accuracy stands in the F1 column, as usual for such a report.
    """
    confusion = df.groupBy(F.col(label).cast("int").alias("a"), F.col(prediction).cast("int").alias("p")).agg(
        F.count("*").alias("c")
    )
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("a") == F.col("p"), F.col("c")).otherwise(zero)
    sides = F.array(
        F.struct(F.col("a").alias("class"), F.col("c").alias("support"), zero.alias("said"), hit.alias("tp")),
        F.struct(F.col("p").alias("class"), zero.alias("support"), F.col("c").alias("said"), zero.alias("tp")),
    )
    classes = (
        confusion.select(F.inline(sides))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("said").alias("said"), F.sum("tp").alias("tp"))
        .select(
            F.col("class").cast("string").alias("name"),
            _ratio(F.col("tp"), F.col("said")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
            _ratio(F.col("tp") * 2, F.col("said") + F.col("support")).alias("f1"),
            "support",
            "tp",
        )
    )
    measures = ("precision", "recall", "f1")
    total = classes.agg(
        F.sum("support").alias("support"),
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}") for m in measures],
    )
    nothing = F.lit(None).cast("double")
    summary = total.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("name"),
                    nothing.alias("precision"),
                    nothing.alias("recall"),
                    F.col("accuracy").alias("f1"),
                    "support",
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("name"),
                        *[F.col(f"{kind}_{m}").alias(m) for m in measures],
                        F.col("support"),
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.drop("tp").unionByName(summary)
