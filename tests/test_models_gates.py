import json

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark.operators import gates as G
from riskspark.operators import models as ML
from riskspark.operators import prep as P
from riskspark.operators.metrics import roc_auc
from riskspark.operators.scoring import alert_count, prediction_columns, score_batch, with_score
from riskspark.plans.training import Scorer, prepare, scorer, train_and_evaluate
from riskspark.schema import Gate, Split
from riskspark.sources.readers import read_results
from riskspark.sources.synth import synthetic_appointments

SPLIT = Split("2016-04-15", "2016-05-10")


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    raw = synthetic_appointments(spark.range(3000), "id")
    prepared, builder, preprocessor = prepare(raw, SPLIT)
    path = str(tmp_path_factory.mktemp("prepared") / "rows")
    prepared.write.parquet(path)
    kept = spark.read.parquet(path)
    return raw, kept, builder, preprocessor, ML.fit_logistic(kept.where("split = 'train'"))


def test_synthetic_rows_do_not_depend_on_partitioning(spark):
    a = synthetic_appointments(spark.range(0, 500, 1, 1), "id")
    b = synthetic_appointments(spark.range(0, 500, 1, 7), "id")
    assert a.exceptAll(b).count() == 0
    rate = synthetic_appointments(spark.range(4000), "id").agg(
        F.avg((F.col("no_show") == "Yes").cast("double"))
    ).first()[0]
    assert 0.40 < rate < 0.53  # mean of 0.1 + lead / 40


def test_fill_values(spark):
    df = spark.createDataFrame(
        [("b", 1.0), ("a", 2.0), ("a", 4.0), ("b", 10.0), (None, None)], "c string, x double"
    )
    assert P.modes(df, ["c"]).first()["fill"] == "a"
    assert P.medians(df, ["x"]).first()["fill"] == 3.0
    filled = P.impute_median(df, P.impute_mode(df, df, ["c"]), ["x"])
    assert filled.where("c = 'a' AND x = 3.0").count() == 1
    scaled = [r["x"] for r in P.standardize(df, df.where("x IS NOT NULL"), ["x"]).collect()]
    x = np.array([1.0, 2.0, 4.0, 10.0])
    assert scaled == pytest.approx(list((x - x.mean()) / x.std()))


def test_unseen_category_is_all_zeros(spark):
    train = spark.createDataFrame([("b",), ("a",)], "c string")
    rows = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    hot = P.one_hot(["c"]).fit(train).transform(rows).select(vector_to_array("c_hot"))
    assert [list(r[0]) for r in hot.collect()] == [[1.0, 0.0], [0.0, 1.0], [0.0, 0.0]]


def test_quotes_in_fill_values(spark):
    df = spark.createDataFrame([("L'or",), ("L'or",), (None,)], "c string").withColumn("x", F.lit(1.0))
    found = P.fit_preprocessor(df, ["c"], ["x"]).transform(df)
    assert found.where("c_filled = \"L'or\"").count() == 3
    assert P.feature_names(found) == ["c_filled_hot_L'or", "x_scaled"]


def test_balanced_weights_sum_to_rows(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "target int")
    assert sorted(r["weight"] for r in P.balanced_weight(df).collect()) == pytest.approx([2 / 3] * 3 + [2.0])


def test_logistic_is_the_minimum_of_the_penalised_loss(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2)) * [1.0, 5.0]
    y = (rng.random(300) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, target int")
    model = ML.fit_logistic(P.assemble(["a", "b"]).transform(df))
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (300 - y.sum())))
    error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    gradient = np.r_[w + x.T @ error, error.sum()]
    assert np.abs(gradient).max() < 0.05 * np.abs(x.T @ (weight * (0.5 - y))).max()


def test_logistic_learns(fitted):
    _, rows, _, _, model = fitted
    scored = with_score(rows.where("split = 'test'"), model)
    assert roc_auc(scored, "target", "score").first()[0] > 0.65


def test_importance_puts_lead_time_first(fitted):
    _, rows, _, _, model = fitted
    val = rows.where("split = 'val'")
    linear = ML.linear_importance(val, model).collect()
    assert linear[0]["feature"] == "lead_time_days_scaled" and len(linear) == len(P.feature_names(rows))
    permuted = ML.permutation_importance(val, model, "appointment_id", bucket=100).collect()
    assert permuted[0]["feature"] == "lead_time_days"
    assert {r["feature"] for r in permuted} == {ML.source_column(n) for n in P.feature_names(rows)}


def test_boosted_learns_and_predictions_have_their_columns(fitted):
    _, rows, _, _, _ = fitted
    model = ML.fit_boosted(rows.where("split = 'train'"), trees=3)
    found = score_batch(rows.where("split = 'test'"), model, 0.5, "9", keep=("appointment_id", "target"))
    assert found.columns[2:] == ["patient_id", "score", "alert", "threshold", "model_version"]
    assert roc_auc(found, "target", "score").first()[0] > 0.6
    assert alert_count(found).first()["n_alerts"] == found.where("alert").count()


def test_alert_uses_the_unrounded_score(spark):
    df = spark.createDataFrame([(1.0, 0.4999999)], "p double, s double")
    row = df.select(prediction_columns(F.col("s"), 0.5, "1", F.col("p"))).first()
    assert row["score"] == 0.5 and not row["alert"]


def test_saved_scorer_gives_the_same_scores(spark, fitted, tmp_path):
    raw, rows, builder, preprocessor, model = fitted
    whole = scorer(builder, preprocessor, model, 0.5, "1")
    check = ML.save_load_check(whole.model, whole.features.transform(raw), str(tmp_path / "model")).first()
    assert (check["rows"], check["max_difference"]) == (3000, 0.0)
    size = ML.artifact_size_mb(spark, str(tmp_path / "model"))
    assert G.gate_size(size).first()["passed"]
    assert not G.gate_size(size, Gate(max_model_size_mb=0.0)).first()["passed"]
    whole.save(str(tmp_path / "scorer"))
    loaded = Scorer.load(spark, str(tmp_path / "scorer"), 0.5, "1")
    test = raw.where("appointment_id < 40")
    keep = ("appointment_id",)
    assert whole.score(test, keep).exceptAll(loaded.score(test, keep)).count() == 0
    with pytest.raises(ValueError):
        Scorer(builder, preprocessor, 1.5, "1")


def test_training_run_and_bad_data(spark):
    raw = synthetic_appointments(spark.range(1500), "id")
    runs = [ML.Experiment("fixed", ML.fit_logistic), ML.Experiment("tuned", ML.fit_logistic, None)]
    metrics, models, _, _ = train_and_evaluate(raw, SPLIT, runs)
    found = {(r["experiment"], r["metric"]): r["value"] for r in metrics.collect()}
    assert set(models) == {"fixed", "tuned"} and len(found) == 16
    assert found[("fixed", "val_threshold")] == 0.5
    assert found[("tuned", "val_recall")] >= 0.6
    with pytest.raises(ValueError, match="invalid table"):
        train_and_evaluate(raw.withColumn("gender", F.lit("X")), SPLIT, runs)
    with pytest.raises(ValueError, match="both classes"):
        train_and_evaluate(raw.withColumn("no_show", F.lit("No")), SPLIT, runs)


def results(spark, folder, pr_auc, recall):
    document = {
        "selected_model": "boosted", "selected_threshold": 0.5, "data_sha256": "abc",
        "experiments": {"boosted": {"val_pr_auc": pr_auc, "val_recall": recall}},
    }
    path = folder / "results.json"
    path.write_text(json.dumps(document, indent=2))
    return read_results(spark, str(path))


@pytest.mark.parametrize(
    "pr_auc, recall, model, data, failures",
    [
        (0.34, 0.80, "boosted", "abc", []),
        (0.25, 0.55, "boosted", "abc", ["PR-AUC below minimum", "recall below minimum"]),
        (0.34, 0.80, "other", "abc", ["not the selected model"]),
        (0.34, 0.80, "boosted", "xyz", ["other data version"]),
    ],
)
def test_absolute_gate(spark, tmp_path, pr_auc, recall, model, data, failures):
    found = G.gate_absolute(results(spark, tmp_path, pr_auc, recall), "boosted", "abc", model, data).first()
    assert found["failures"] == failures and found["passed"] == (not failures)


def test_absolute_gate_without_metrics(spark, tmp_path):
    found = G.gate_absolute(results(spark, tmp_path, 0.3, 0.6), "absent", "abc", "absent", "abc").first()
    assert found["failures"] == ["no metrics recorded"]


def test_relative_gate_is_strict(spark):
    rows = [(1, 0.9, 0.9, 0.1), (1, 0.4, 0.4, 0.9), (0, 0.8, 0.1, 0.1)]
    df = spark.createDataFrame(rows, "y int, a double, b double, c double")
    assert not G.gate_relative(df, "y", "a", 0.5, "b").first()["passed"]
    assert G.gate_relative(df, "y", "a", 0.3, "b").first()["passed"]
    assert G.gate_relative(df, "y", "a", 0.5).first()["passed"]


def test_alias_log(spark):
    log = spark.createDataFrame(
        [("m", "champion", "1", 0.4, "2024-01-01"), ("m", "champion", "2", None, "2024-01-02"),
         ("m", "challenger", "3", 0.7, "2024-01-01")],
        "name string, alias string, version string, threshold double, ts string",
    )
    found = {r["alias"]: (r["version"], r["threshold"]) for r in G.resolve_alias(log).collect()}
    assert found == {"champion": ("2", 0.5), "challenger": ("3", 0.7)}
    assert G.resolve_alias(log, override=0.2).first()["threshold"] == 0.2


def test_score_parity_sees_every_kind_of_difference(spark):
    schema = "k int, score double, alert boolean, model_version string"
    served = spark.createDataFrame([(1, 0.2, False, "1"), (2, 0.7, True, "1")], schema)
    local = spark.createDataFrame([(1, 0.2), (2, 0.7)], "k int, score double")
    assert G.score_parity(served, local, "k", 0.5).first()["parity"]
    shifted = local.withColumn("score", F.col("score") + 1e-3)
    assert not G.score_parity(served, shifted, "k", 0.5).first()["parity"]
    assert G.score_parity(served, local, "k", 0.1).first()["alert_mismatches"] == 1
    assert G.score_parity(served.where("k = 1"), local, "k", 0.5).first()["unmatched"] == 1
    nan = served.withColumn("score", F.when(F.col("k") == 1, float("nan")).otherwise(F.col("score")))
    row = G.score_parity(nan, local, "k", 0.5).first()
    assert row["missing_scores"] == 1 and not row["parity"] and row["versions"] == "1"


def test_preparation_takes_all_labelled_rows(spark, monkeypatch):
    """However few rows a model is fitted on, means, deviations and categories are of all."""
    from conftest import SF

    from riskspark.plans.queries import modelling

    want = sorted(map(tuple, modelling.assembled_vectors(spark, SF).collect()))
    monkeypatch.setattr(modelling, "FIT_ROWS", 5)
    assert sorted(map(tuple, modelling.assembled_vectors(spark, SF).collect())) == want
