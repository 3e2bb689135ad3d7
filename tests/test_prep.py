import pytest
from pyspark.sql import functions as F

from featuremart.operators import modelling, prep

SCHEMA = "k int, n double, c double, cat string, items string"


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [(1, 1.0, 3.0, "b", "x|y"), (2, None, 3.0, "a", " y |"), (3, 3.0, 3.0, None, None), (4, 8.0, 3.0, "a", "z|z"),
         (5, float("nan"), 3.0, "b", "")], SCHEMA)


def column(frame, c):
    return [r[c] for r in frame.orderBy("k").collect()]


def test_imputation(df):
    assert column(prep.impute_median(df, ["n"]), "n") == [1, 3, 3, 8, 3]
    assert column(prep.impute_mode(df, ["cat"]), "cat") == ["b", "a", "a", "a", "b"]  # tie: smallest
    assert column(prep.impute_constant(df, ["items"]), "items")[2] == "Unknown"


def test_scaling(df):
    scaled = prep.standard_scale(prep.impute_median(df, ["n"]), ["n", "c"])
    values = column(scaled, "n")
    assert sum(values) == pytest.approx(0) and sum(v * v for v in values) / 5 == pytest.approx(1)
    assert column(scaled, "c") == [0] * 5
    assert column(prep.min_max_scale(prep.impute_median(df, ["n"]), ["n", "c"]), "n") == pytest.approx(
        [0, 2 / 7, 2 / 7, 1, 2 / 7])
    assert column(prep.min_max_scale(df, ["c"]), "c") == [0] * 5


def test_one_hot_ignores_unknown(df):
    got = prep.one_hot(df, "cat", ["b", "q"])
    assert column(got, "cat_b") == [1, 0, 0, 0, 1] and column(got, "cat_q") == [0] * 5
    assert [c for c in prep.one_hot(df, "cat").columns if c.startswith("cat_")] == ["cat_a", "cat_b"]


def test_multi_hot(df):
    got = prep.multi_hot(df, "items")
    assert [c for c in got.columns if c.startswith("items__")] == ["items__x", "items__y", "items__z"]
    assert column(got, "items__y") == [1, 1, 0, 0, 0]
    assert column(prep.multi_hot(df, "items", ["y"]), "items__y") == [1, 1, 0, 0, 0]


def test_vocabularies_have_no_limit(spark):
    many = spark.range(2_500).select("id", F.col("id").cast("string").alias("c"),
                                     F.concat("id", F.lit("|x|"), "id").alias("items"))
    assert len(prep.categories(many, "c")) == 2_500
    values = sorted(str(i) for i in range(2_500))
    assert {(r["id"], r["index"]) for r in prep.one_hot_entries(many, "c", ["id"]).collect()} == {
        (int(v), i) for i, v in enumerate(values)}
    tokens = {v: i for i, v in enumerate(sorted([*values, "x"]))}
    assert {(r["id"], r["index"]) for r in prep.multi_hot_entries(many, "items", ["id"]).collect()} == {
        (i, tokens[t]) for i in range(2_500) for t in (str(i), "x")}
    steps = prep.Preprocessor([], ["c"], ["items"]).fit(many)
    vector = steps.assemble(many, ["id"]).first()["features"]
    assert vector.size == 5_001 and len(vector.indices) == 3


def test_preprocessor_survives_saving(spark, df, tmp_path):
    steps = prep.Preprocessor(["n"], ["cat"], ["items"]).fit(df)
    steps.save(spark, str(tmp_path / "steps"))
    again = prep.Preprocessor.load(spark, str(tmp_path / "steps"))
    assert again.feature_names == steps.feature_names and again.modes_ == steps.modes_
    assert again.transform(df, ["k"]).collect() == steps.transform(df, ["k"]).collect()


def test_preprocessor_is_fixed_at_fit(spark, df):
    steps = prep.Preprocessor(["n"], ["cat"], ["items"]).fit(df)
    assert steps.feature_names == ["n", "cat_a", "cat_b", "items__x", "items__y", "items__z"]
    new = spark.createDataFrame([(9, None, None, "zz", "y|new")], SCHEMA)
    row = steps.transform(new, ["k"]).first()
    assert tuple(row)[0] == 9 and list(row)[2:] == [0, 0, 0, 1, 0]
    assert steps.assemble(new, ["k"]).first()["features"].size == 6
    matrix = steps.transform(df, ["k"])
    assert matrix.columns == ["k", *steps.feature_names]
    alone = prep.standard_scale(prep.impute_median(df, ["n"]), ["n"])
    assert column(matrix, "n") == pytest.approx(column(alone, "n"))


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "label int")
    sums = {r["label"]: r["w"] for r in modelling.with_class_weights(df).groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums == {0: pytest.approx(2), 1: pytest.approx(2)}


def test_parameter_draws():
    a = modelling.draw_parameters(modelling.TREE_SEARCH, 15)
    assert a == modelling.draw_parameters(modelling.TREE_SEARCH, 15) and len(a) == 15
    for values in a:
        for name, (low, high, _) in modelling.TREE_SEARCH.items():
            assert low <= values[name] <= high


def test_train_score_and_save(spark, tmp_path):
    from datetime import date

    from pyspark.ml.classification import LogisticRegressionModel

    day = date(2024, 1, 1)
    df = spark.range(400).select(
        F.col("id").cast("string").alias("Customer_ID"), F.lit(day).alias("label_snapshot_date"),
        (F.col("id") % 100).cast("double").alias("n"), F.when(F.col("id") % 3 > 0, "u").alias("cat"),
        ((F.col("id") % 100) > 60).cast("int").alias("label"))
    steps = prep.Preprocessor(["n"], ["cat"]).fit(df)
    model = modelling.logistic_regression(maxIter=30).fit(
        modelling.with_class_weights(steps.assemble(df, ["label"])))
    scored = modelling.score_snapshot(model, steps, df, day, model_version="3", model_stage="Production")
    assert scored.columns == ["Customer_ID", "label_snapshot_date", "default_proba", "default", "snapshot_date",
                              "scored_at", "model_uri", "model_version", "model_stage"]
    assert scored.count() == 400 and 0 < scored.filter("default = 1").count() < 400
    with pytest.raises(ValueError, match="no features"):
        modelling.score_snapshot(model, steps, df, date(2024, 2, 1))
    model.write().overwrite().save(str(tmp_path / "m"))
    again = LogisticRegressionModel.load(str(tmp_path / "m"))
    a = modelling.score_rows(model, steps, df, ["Customer_ID"]).collect()
    assert sorted(a) == sorted(modelling.score_rows(again, steps, df, ["Customer_ID"]).collect())
