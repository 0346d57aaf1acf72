import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array

from tallyguard.operators import models
from tallyguard.operators.metrics import classification_report
from tallyguard.plans.catalog.learning import MESSAGE_PLANTED_SQL, PLANTED_SQL, one_model
from tallyguard.plans.flows import TrainingSet


def quick():
    """Small ensembles under the names of the shortlist."""
    common = {"featuresCol": models.FEATURES, "labelCol": "fraud_label"}
    forest = {**common, "numTrees": 10, "maxDepth": 6, "seed": 1}
    return {
        "logistic": lambda: LogisticRegression(**common, maxIter=100),
        "forest": lambda: RandomForestClassifier(**forest),
        "gbt": lambda: GBTClassifier(**common, maxDepth=4, maxIter=5, seed=1),
    }


@pytest.fixture(scope="module")
def split(spark):
    """Fraud follows the amount and the type, with some noise."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(600):
        amount, kind = float(rng.normal()), str(rng.choice(["ATM", "POS", "Online"]))
        signal = amount * 2 + (kind == "Online") * 2 - 1.5 + rng.normal() * 0.5
        rows.append((i, amount if i % 29 else None, kind if i % 31 else None, int(signal > 0)))
    df = spark.createDataFrame(rows, "id int, amount double, kind string, fraud_label int")
    return df.where("id % 5 <> 0").cache(), df.where("id % 5 = 0").cache()


@pytest.fixture(scope="module")
def data(split):
    ready = models.prepare_matrices(*split, ["amount"], ["kind"])
    yield ready
    ready.release()


def test_preprocess_codes_and_missing(spark, split):
    fitted = models.fit_preprocess(split[0], ["amount"], ["kind"])
    rows = spark.createDataFrame(
        [(None, None, 0), (None, "new", 1), (None, "ATM", 0), (None, "POS", 0)],
        "amount double, kind string, fraud_label int",
    )
    vector = vector_to_array("features")
    got = [tuple(r) for r in fitted.transform(rows).select(vector[0], vector[1]).collect()]
    assert [r[1] for r in got] == [-1.0, -1.0, 0.0, 2.0]
    assert len({r[0] for r in got}) == 1 and abs(got[0][0]) < 0.2


def test_candidates_beat_the_constant_guess(data):
    shortlist = quick()
    board = models.leaderboard(data, shortlist).collect()
    assert {r["model"] for r in board} == set(shortlist)
    assert all(r["error"] == "" and r["roc_auc"] > 0.8 for r in board)
    assert [r["roc_auc"] for r in board] == sorted((r["roc_auc"] for r in board), reverse=True)


def test_full_settings():
    full = {name: make() for name, make in models.candidates(1000).items()}
    assert full["forest"].getNumTrees() == 100 and full["forest"].getMaxDepth() == 18
    assert full["gbt"].getMaxIter() == 100 and full["gbt"].getStepSize() == 0.08
    assert full["hist_gbt"].settings.rounds == 200 and full["hist_gbt"].settings.depth == 10
    assert full["extra_trees"].trees == 100 and full["extra_trees"].depth == 18
    assert full["logistic"].getRegParam() == 0.001 and full["logistic"].getMaxIter() == 2000


def test_a_failing_candidate_keeps_its_row(data):
    def broken():
        raise RuntimeError("x" * 500)

    board = models.leaderboard(data, {"broken": broken, "logistic": models.candidates(data.rows)["logistic"]})
    rows = board.collect()
    assert [r["model"] for r in rows] == ["logistic", "broken"]
    assert rows[1]["roc_auc"] is None and rows[1]["error"] == "x" * 240
    assert models.best_candidate(board) == "logistic"
    with pytest.raises(RuntimeError):
        models.best_candidate(board.where("model = 'broken'"))


def test_save_load_and_score(spark, split, data, tmp_path):
    shortlist = {"forest": quick()["forest"]}
    board = models.leaderboard(data, shortlist)
    model = models.fit_final(board, data, shortlist, 12.5)
    model.save(str(tmp_path / "m"))
    model.save(str(tmp_path / "m"))
    loaded = models.FraudModel.load(str(tmp_path / "m"))
    assert loaded.hour_fill == 12.5
    before = models.score_batch(model, split[1])
    after = models.score_batch(loaded, split[1])
    assert before.columns == [*split[1].columns, "fraud_probability", "predicted"]
    assert before.count() == 120 and before.exceptAll(after).count() == 0
    report = classification_report(after, "fraud_label", "predicted")
    assert report.where("name = 'accuracy'").first()["f1"] > 0.7


def test_wide_columns_get_the_same_codes_by_a_join(spark, split, monkeypatch, tmp_path):
    rows = spark.createDataFrame([(0.5, "POS", 0), (0.5, "new", 1), (0.5, None, 0)], "amount double, kind string, fraud_label int")
    vector = vector_to_array("features")
    narrow = models.fit_preprocess(split[0], ["amount"], ["kind"])
    monkeypatch.setattr(models, "MAX_CATEGORIES", 2)
    data = models.prepare_matrices(*split, ["amount"], ["kind"])
    assert narrow.wide == [] and data.preprocess.wide == ["kind"]
    assert sorted(map(str, narrow.transform(rows).select(vector).collect())) == sorted(
        map(str, data.preprocess.transform(rows).select(vector).collect())
    )
    shortlist = {"logistic": quick()["logistic"]}
    model = models.fit_final(models.leaderboard(data, shortlist), data, shortlist)
    model.save(str(tmp_path / "m"))
    loaded = models.FraudModel.load(str(tmp_path / "m"))
    assert loaded.wide == ["kind"]
    assert models.score_batch(model, rows).exceptAll(models.score_batch(loaded, rows)).count() == 0
    assert models.score_batch(loaded, rows).columns == ["amount", "kind", "fraud_label", "fraud_probability", "predicted"]
    data.release()


def test_a_loaded_model_saved_to_its_own_path_stays_whole(spark, split, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "MAX_CATEGORIES", 2)
    data = models.prepare_matrices(*split, ["amount"], ["kind"])
    shortlist = {"logistic": quick()["logistic"]}
    models.fit_final(models.leaderboard(data, shortlist), data, shortlist).save(str(tmp_path / "m"))
    before = models.FraudModel.load(str(tmp_path / "m"))
    before.save(str(tmp_path / "m"))
    after = models.FraudModel.load(str(tmp_path / "m"))
    assert models.score_batch(before, split[1]).exceptAll(models.score_batch(after, split[1])).count() == 0
    data.release()


def test_numbers_take_the_exact_median_and_the_population_deviation(spark):
    values = [float(v) for v in range(1001)] + [1e6, None]
    df = spark.createDataFrame([(v, 3.0) for v in values], "x double, same double")
    vector = vector_to_array("features")
    got = [tuple(r) for r in models.fit_preprocess(df, ["x", "same"], []).transform(df).select(vector[0], vector[1]).collect()]
    filled = np.array([v if v is not None else 500.5 for v in values])
    assert np.allclose([g[0] for g in got], (filled - filled.mean()) / filled.std(), atol=1e-12)
    assert {g[1] for g in got} == {0.0}


def test_a_broken_candidate_turns_its_query_red(spark, monkeypatch):
    from __spark_entry__ import queries

    def broken(rows, seed=0):
        raise RuntimeError("broken")

    monkeypatch.setattr(models, "candidates", broken)
    with pytest.raises(RuntimeError, match="broken"):
        queries()["clf_logistic"](spark, "/root/testdata/sf0.001")


def test_one_model_without_names_is_the_logistic_regression(split):
    train, test = split
    model = one_model(TrainingSet(train, test, ["amount"], ["kind"], 12.5))
    assert type(model.pipeline.stages[-1]).__name__ == "LogisticRegressionModel" and model.hour_fill == 12.5
    assert models.score_batch(model, test).where("fraud_probability BETWEEN 0 AND 1").count() == test.count()


def test_messages_carry_the_sign_that_the_model_was_trained_with(spark):
    rows = [(5.0, " FRAUD ", 1), (6.0, "Normal", 0), (7.0, None, 0), (8.0, "fraud", 1)]
    df = spark.createDataFrame(rows, "transaction_id double, fraud_label string, label int")
    signs = df.selectExpr(f"{MESSAGE_PLANTED_SQL} AS a", "transaction_id", "label AS fraud_label").selectExpr("a", f"{PLANTED_SQL} AS b")
    assert [(r["a"], r["b"]) for r in signs.collect()] == [(2 + 5 / 3, 2 + 5 / 3), (2.0, 2.0), (0.0, 0.0), (2 + 1 / 3, 2 + 1 / 3)]
