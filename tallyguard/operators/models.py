"""Preprocessing, the candidate classifiers, the leaderboard, saving and scoring."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tallyguard.operators.boosting import HistogramBoosting, Settings
from tallyguard.operators.forest import RandomForest
from tallyguard.operators.metrics import binary_metrics, roc_auc_value
from tallyguard.operators.prepare import SEED, category_codes, fit_scale, with_class_weights
from tallyguard.operators.quantiles import column_quantiles
from tallyguard.operators.random_trees import RandomisedTrees
from tallyguard.operators.stochastic import StochasticLogistic
from tallyguard.session import checkpoint_folder, stage
from tallyguard.sources.schemas import LABEL

FEATURES = "features"
WEIGHT = "weight"
ERROR_LENGTH = 240
# A string index lives on the driver. Columns with more values than this are encoded by a join with a
# dictionary table instead, with the same codes.
MAX_CATEGORIES = 10_000
# Every task of a fit sends sums of all open nodes and costs its start in each of hundreds of jobs: rows are spread
# over the cores from so many a task on, and over more tasks than that only beyond so many rows a task.
ROWS_PER_TASK = 50_000
MOST_ROWS_PER_TASK = 1_000_000
FITS_AT_ONCE = 4

PARAMETERS_SCHEMA = "hour_fill double, wide array<string>"
CODES_SCHEMA = "i int, value string, code int"
LEADERBOARD_SCHEMA = (
    "model string, accuracy double, precision double, recall double, f1 double, roc_auc double, error string"
)


def _present(train: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns with at least one value."""
    if not columns:
        return []
    row = train.agg(*[F.count(F.col(f"`{c}`")) for c in columns]).first()
    return [c for c, n in zip(columns, row) if n]


def _wide_columns(train: DataFrame, columns: Sequence[str]) -> list[str]:
    if not columns:
        return []
    row = train.agg(*[F.approx_count_distinct(F.col(f"`{c}`")) for c in columns]).first()
    return [c for c, n in zip(columns, row) if n > MAX_CATEGORIES]


@dataclass
class Preprocess:
    """Fitted stages, and the dictionary (i, value, code) of the columns too wide for a string index."""

    pipeline: PipelineModel
    wide: list[str]
    codes: DataFrame | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(encode_wide(df, self.wide, self.codes))


def encode_wide(df: DataFrame, wide: Sequence[str], codes: DataFrame | None) -> DataFrame:
    """Adds ``_o_<column>`` with the code of each wide column, −1 for an unseen or missing value."""
    for i, c in enumerate(wide):
        side = codes.where(F.col("i") == i).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        code = F.coalesce(F.col("_code").cast("double"), F.lit(-1.0))
        df = df.join(side, F.col(f"`{c}`") == F.col("_value"), "left").withColumn(f"_o_{c}", code)
        df = df.drop("_value", "_code")
    return df


def _scaled_numbers(train: DataFrame, numeric: Sequence[str]) -> dict[str, str]:
    """SQL of every number: a missing one takes the exact median; centred, in units of the population deviation."""
    filled = {}
    for c, (median,) in column_quantiles(train, numeric, [0.5]).items():
        filled[c] = f"coalesce(CAST(`{c}` AS DOUBLE), {median!r}D)"
    scale = fit_scale(train.select(*[F.expr(text).alias(c) for c, text in filled.items()]), list(filled))
    return {c: f"(({filled[c]} - ({mean!r}D)) / {(deviation or 1.0)!r}D)" for c, (mean, deviation) in scale.items()}


def fit_preprocess(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Preprocess:
    """Scaled numbers and ordinal categories in one vector.

    A missing number takes the exact training median, and numbers are scaled by their population
    deviation; an unseen or missing category is −1. The ordinal columns carry no category metadata, so trees split them as numbers.
    """
    numeric, categorical = _present(train, numeric), _present(train, categorical)
    wide = _wide_columns(train, categorical)
    codes = stage(category_codes(train, wide)[0], "dictionary") if wide else None
    narrow = [c for c in categorical if c not in wide]

    steps = []
    if numeric:
        scaled = ", ".join(f"{text} AS `_s_{c}`" for c, text in _scaled_numbers(train, numeric).items())
        steps.append(SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__"))
    if narrow:
        steps.append(
            StringIndexer(
                inputCols=narrow,
                outputCols=[f"_i_{c}" for c in narrow],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )

    fitted = []
    current = train
    for step in steps:
        model = step.fit(current) if isinstance(step, Estimator) else step
        fitted.append(model)
        current = model.transform(current)
    if narrow:
        mapped = ", ".join(
            f"CASE WHEN `_i_{c}` >= {len(labels)} THEN -1.0 ELSE `_i_{c}` END AS `_o_{c}`"
            for c, labels in zip(narrow, fitted[-1].labelsArray)
        )
        fitted.append(SQLTransformer(statement=f"SELECT *, {mapped} FROM __THIS__"))
    inputs = [f"_s_{c}" for c in numeric] + [f"_o_{c}" for c in categorical]
    fitted.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES))
    return Preprocess(PipelineModel(fitted), wide, codes)


def candidates(rows: int, seed: int = SEED) -> dict[str, Callable[[], Estimator]]:
    """The shortlist by name.

    Spark ML gives the logistic regression and the plain boosting; the forest, extremely randomised trees, boosting
    over histograms and the linear model by stochastic gradient are those of this package.
    """
    # The settings of the estimators, here and below.
    common = {"featuresCol": FEATURES, "labelCol": LABEL}
    balanced = {**common, "weightCol": WEIGHT}
    # The longest first: a leaderboard begins fits in this order, some at once.
    return {
        "hist_gbt": lambda: HistogramBoosting(**balanced, settings=Settings(rounds=200, depth=10)),
        "extra_trees": lambda: RandomisedTrees(**balanced, trees=100, depth=18, seed=seed),
        "gbt": lambda: GBTClassifier(
            **common, maxDepth=4, maxIter=100, stepSize=0.08, seed=seed, maxMemoryInMB=1024
        ),
        "forest": lambda: RandomForest(**balanced, trees=100, depth=18, seed=seed),
        "logistic": lambda: LogisticRegression(
            **balanced, maxIter=2000, regParam=1.0 / max(rows, 1), elasticNetParam=0.0, standardization=False
        ),
        "sgd_logistic": lambda: StochasticLogistic(**balanced, alpha=1e-4, most=2000, tol=1e-3, seed=seed),
    }


@dataclass
class Matrices:
    """Preprocessed, weighted training rows and preprocessed test rows, held for several fits."""

    preprocess: Preprocess
    train: DataFrame
    test: DataFrame
    rows: int

    def release(self) -> None:
        self.train.unpersist()
        self.test.unpersist()


def fit_tasks(rows: int, cores: int) -> int:
    return max(1, -(-rows // MOST_ROWS_PER_TASK), min(-(-rows // ROWS_PER_TASK), cores))


def prepare_matrices(
    train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str = LABEL
) -> Matrices:
    preprocess = fit_preprocess(train, numeric, categorical)
    target = F.col(label).cast("double").alias(LABEL)
    ready = with_class_weights(preprocess.transform(train).select(FEATURES, target), LABEL, WEIGHT)
    context = train.sparkSession.sparkContext
    tasks = fit_tasks(train.count(), context.defaultParallelism)
    # On disk: every fit holds the rows in a form of its own, and the heap is for that.
    ready = ready.coalesce(tasks).persist(StorageLevel.DISK_ONLY)
    checked = preprocess.transform(test).select(FEATURES, target).persist(StorageLevel.DISK_ONLY)
    checkpoint_folder(train.sparkSession)
    return Matrices(preprocess, ready, checked, ready.count())


def scored(predictions: DataFrame) -> DataFrame:
    return predictions.select(
        F.col(LABEL).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("score"),
    )


def evaluate(name: str, make: Callable[[], Estimator], data: Matrices) -> tuple:
    """One leaderboard row; a failure gives NULL scores and the start of its message."""
    try:
        model = make().fit(data.train)
        result = scored(model.transform(data.test)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            metrics = binary_metrics(result).first()
            return (name, *metrics, roc_auc_value(result), "")
        finally:
            result.unpersist()
    except Exception as error:  # noqa: BLE001 - any failing candidate keeps its row
        return (name, None, None, None, None, None, str(error)[:ERROR_LENGTH])


def leaderboard(data: Matrices, shortlist: dict[str, Callable[[], Estimator]]) -> DataFrame:
    """Every candidate fitted and scored, by AUC, then F1, best first, NULL last.

    Candidates are fitted side by side over the rows that are held, so that the jobs of one fill the cores that
    another's leave idle; the order of the shortlist doesn't matter.
    """
    spark = data.train.sparkSession
    fit = inheritable_thread_target(spark)(lambda item: evaluate(*item, data))
    with ThreadPoolExecutor(max(1, min(FITS_AT_ONCE, len(shortlist)))) as pool:
        rows = list(pool.map(fit, shortlist.items()))
    board = spark.createDataFrame(rows, LEADERBOARD_SCHEMA)
    return board.orderBy(F.col("roc_auc").desc_nulls_last(), F.col("f1").desc_nulls_last(), "model")


def best_candidate(board: DataFrame) -> str:
    best = board.where("error = ''").orderBy(
        F.col("roc_auc").desc_nulls_last(), F.col("f1").desc_nulls_last(), "model"
    ).first()
    if best is None:
        raise RuntimeError("no candidate was fitted without an error")
    return best["model"]


@dataclass
class FraudModel:
    """A fitted pipeline, the fill value that its features need, and the dictionary of wide columns."""

    pipeline: PipelineModel
    hour_fill: float | None = None
    wide: Sequence[str] = ()
    codes: DataFrame | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(encode_wide(df, self.wide, self.codes))

    def save(self, path: str) -> None:
        """Write a new version beside earlier ones, then name it the current one.

        A model that was loaded from ``path`` reads its dictionary from there, so nothing is overwritten.
        """
        spark = SparkSession.active()
        version = uuid.uuid4().hex
        self.pipeline.write().save(f"{path}/{version}/pipeline")
        if self.wide:
            self.codes.write.parquet(f"{path}/{version}/dictionary")
        parameters = spark.createDataFrame([(self.hour_fill, list(self.wide))], PARAMETERS_SCHEMA)
        parameters.write.parquet(f"{path}/{version}/parameters")
        now = spark.createDataFrame([(version,)], "version string").withColumn("saved", F.current_timestamp())
        now.coalesce(1).write.mode("append").parquet(f"{path}/versions")

    @classmethod
    def load(cls, path: str) -> "FraudModel":
        spark = SparkSession.active()
        versions = spark.read.schema("version string, saved timestamp").parquet(f"{path}/versions")
        folder = f"{path}/{versions.orderBy(F.desc('saved')).first()['version']}"
        hour_fill, wide = spark.read.schema(PARAMETERS_SCHEMA).parquet(f"{folder}/parameters").first()
        codes = spark.read.schema(CODES_SCHEMA).parquet(f"{folder}/dictionary") if wide else None
        return cls(PipelineModel.load(f"{folder}/pipeline"), hour_fill, wide, codes)


def fit_final(
    board: DataFrame,
    data: Matrices,
    shortlist: dict[str, Callable[[], Estimator]],
    hour_fill: float | None = None,
) -> FraudModel:
    """The winner, fitted anew on the training rows, behind its preprocessing."""
    winner = shortlist[best_candidate(board)]().fit(data.train)
    ready = data.preprocess
    return FraudModel(PipelineModel([*ready.pipeline.stages, winner]), hour_fill, ready.wide, ready.codes)


def score_batch(model: FraudModel, df: DataFrame) -> DataFrame:
    """The rows with ``fraud_probability`` and ``predicted``; for batch and stream."""
    return model.transform(df).select(
        *[F.col(f"`{c}`") for c in df.columns],
        vector_to_array("probability")[1].alias("fraud_probability"),
        F.col("prediction").cast("int").alias("predicted"),
    )
