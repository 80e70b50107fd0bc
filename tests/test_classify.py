import pytest
from pyspark.sql import functions as F

from inspecta.operators.classify import (
    class_weights, fit_pass_fail, lookup_score, score, what_if, what_if_score,
)


@pytest.fixture(scope="module")
def train(spark):
    rows = []
    for i in range(200):
        passed = i % 4 != 0          # imbalanced: 150 PASSED, 50 FAILED
        mileage = 20000 + i * 10 if passed else 150000 + i * 10
        rows.append(("PASSED" if passed else "FAILED", mileage, 5 if passed else 15,
                     "FORD" if passed else "ROVER", "FIESTA", "RED"))
    return spark.createDataFrame(rows, "last_test_result string, mileage bigint, vehicle_age bigint, "
                                       "make string, model string, primaryColour string")


@pytest.fixture(scope="module")
def model(train):
    return fit_pass_fail(train)


def test_weights_balance_classes(train):
    w = {r.last_test_result: r.weight for r in class_weights(train).collect()}
    assert w["FAILED"] == pytest.approx(2.0) and w["PASSED"] == pytest.approx(200 / 300)


def test_binary_model_and_probabilities(model, train):
    assert model.stages[-1].numClasses == 2
    out = score(model, train.drop("last_test_result"))
    s = out.select(F.aggregate("predicted_last_test_result_probs", F.lit(0.0), lambda a, p: a + p.prob).alias("s"))
    assert all(abs(r.s - 1) < 1e-9 for r in s.collect())
    acc = (score(model, train).where(F.col("predicted_last_test_result") == F.col("last_test_result")).count()
           / train.count())
    assert acc > 0.95


def test_case_of_categories_is_irrelevant(model, spark):
    a = what_if_score(model, what_if(spark, 30000, 5, "FORD", "FIESTA", "RED")).first()
    b = what_if_score(model, what_if(spark, 30000, 5, "ford", "Fiesta", "red")).first()
    assert a.pass_probability == pytest.approx(b.pass_probability)
    assert a.predicted_last_test_result == "PASSED"
    unseen = what_if_score(model, what_if(spark, 30000, 5, "TESLA", "X", "BLUE")).first()
    assert unseen.pass_probability is not None


def test_lookup_score_one_row_per_key(model, spark, train):
    df = train.withColumn("registration", F.concat(F.lit("R"), (F.monotonically_increasing_id() % 3).cast("string")))
    keys = spark.createDataFrame([("R1",), ("R1",), ("NOPE",)], "registration string")
    out = lookup_score(model, df, keys).collect()
    assert len(out) == 1 and out[0].registration == "R1"
    assert "predicted_last_test_result_probs" not in out[0].asDict()


def test_save_load_round_trip(model, train, tmp_path):
    from inspecta.operators.classify import load_model, save_model
    path = save_model(model, str(tmp_path / "m"))
    save_model(model, path)   # replace in place
    a = score(model, train.limit(20)).select("pass_probability").collect()
    b = score(load_model(path), train.limit(20)).select("pass_probability").collect()
    assert [r[0] for r in a] == pytest.approx([r[0] for r in b])


def test_lookup_one_parameterised(spark):
    from inspecta.operators.classify import lookup_one
    from inspecta.schema import VEHICLE
    df = spark.createDataFrame([{"registration": "K1", "make": "A"}, {"registration": "K2", "make": "B"}],
                               VEHICLE)
    df.createOrReplaceTempView("vehicles_t")
    rows = lookup_one(spark, "vehicles_t", "K2").collect()
    assert len(rows) == 1 and rows[0].make == "B" and "motTests" not in rows[0].asDict()


def test_null_numbers_are_imputed(model, spark, train):
    rows = train.limit(5).withColumn("mileage", F.lit(None).cast("bigint")).withColumn("vehicle_age", F.lit(None).cast("bigint"))
    got = [r.pass_probability for r in score(model, rows).collect()]
    assert len(got) == 5 and all(p == p and 0 <= p <= 1 for p in got)
    mean = train.agg(F.avg("mileage"), F.avg("vehicle_age")).first()
    at_mean = train.limit(5).withColumn("mileage", F.lit(mean[0])).withColumn("vehicle_age", F.lit(mean[1]))
    assert got == pytest.approx([r.pass_probability for r in score(model, at_mean).collect()])


def test_features_argument(spark, train):
    from inspecta.operators.classify import fit_pass_fail
    one = fit_pass_fail(train, features=["make"], max_iter=100, tol=1e-10, balance=False)
    shares = {r.make: r.p for r in train.groupBy("make").agg(F.avg((F.col("last_test_result") == "PASSED").cast("int")).alias("p")).collect()}
    for r in score(one, train).select("make", "pass_probability").distinct().collect():
        assert r.pass_probability == pytest.approx(shares[r.make], abs=1e-4)
    with pytest.raises(ValueError):
        fit_pass_fail(train, features=["colour"])
