"""Pass/fail classifier on Spark ML (logistic regression with class weights).

Training and serving share one PipelineModel whose first stage upper-cases
the categorical features, so raw (mixed-case) serving inputs see the same
encoding as training.  A NULL number is scored with the training mean.
Categorical features keep unseen values in an extra bucket; the label keeps a
fixed alphabetical order (FAILED, PASSED).  The values of a categorical feature
are collected to the driver (``StringIndexer``), so a feature whose vocabulary
grows with the data should be left out of ``features`` or bucketed before.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inspecta.functions.columns import pass_probability
from inspecta.operators.merge import DEFAULT_MAX_BROADCAST_KEYS, maybe_broadcast
from inspecta.schema import FAILED, PASSED

LABEL = "last_test_result"
CATEGORICAL = ["make", "model", "primaryColour"]
NUMERIC = ["mileage", "vehicle_age"]
FEATURES = NUMERIC + CATEGORICAL


def pass_fail_training(enriched: DataFrame) -> DataFrame:
    """Label + features of vehicles whose last result is PASSED or FAILED."""
    return (enriched.where(F.col(LABEL).isin(PASSED, FAILED)
                           & F.col("mileage").isNotNull() & F.col("vehicle_age").isNotNull())
            .select(LABEL, "mileage", "vehicle_age",
                    *[F.upper(c).alias(c) for c in CATEGORICAL]))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Inverse-frequency weights n / (k * n_c) per class (k classes)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    n = counts.agg(F.sum("n_class")).scalar()          # scalar subqueries over k rows
    k = counts.agg(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_class", (n / (k * F.col("n_class"))).cast("double").alias("weight"))


def with_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    # one row per class: a broadcast of k rows
    return df.join(F.broadcast(class_weights(df, label).select(label, "weight")), label)


def slot(col: str, buckets: int) -> str:
    """SQL of the slot that a category value is hashed to."""
    return f"pmod(xxhash64('{col}', upper({col})), {buckets})"


def _pipeline(reg_param: float, max_iter: int, features: list[str], tol: float, buckets: int | None) -> Pipeline:
    unknown = set(features) - set(FEATURES)
    if unknown or not features:
        raise ValueError(f"features must be some of {FEATURES}")
    cats, nums = ([f for f in group if f in features] for group in (CATEGORICAL, NUMERIC))
    stages, inputs = [], []
    if cats:
        if buckets:
            # no vocabulary comes to the driver: values share slots of a hash
            stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
                f"CAST({slot(c, buckets)} AS DOUBLE) AS {c}_i" for c in cats) + " FROM __THIS__"))
        else:
            stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
                f"upper({c}) AS {c}_u" for c in cats) + " FROM __THIS__"))
            stages.append(StringIndexer(inputCols=[f"{c}_u" for c in cats], outputCols=[f"{c}_i" for c in cats],
                                        handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=[f"{c}_i" for c in cats], outputCols=[f"{c}_v" for c in cats],
                                    handleInvalid="keep"))
        inputs += [f"{c}_v" for c in cats]
    if nums:
        stages.append(SQLTransformer(statement="SELECT *, " + ", ".join(
            f"CAST({c} AS DOUBLE) AS {c}_d" for c in nums) + " FROM __THIS__"))
        stages.append(Imputer(inputCols=[f"{c}_d" for c in nums], outputCols=[f"{c}_f" for c in nums], strategy="mean"))
        inputs = [f"{c}_f" for c in nums] + inputs
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="error"))
    stages.append(StringIndexer(inputCol=LABEL, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="error"))
    stages.append(LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="binomial",
                                     regParam=reg_param, maxIter=max_iter, tol=tol, standardization=True))
    return Pipeline(stages=stages)


def fit_pass_fail(training: DataFrame, reg_param: float = 0.0, max_iter: int = 20, balance: bool = True,
                  features: list[str] = FEATURES, tol: float = 1e-6, buckets: int | None = None) -> PipelineModel:
    """Fit the classifier on some ``features``; ``balance`` adds inverse-frequency class weights.

    Categories are indexed by a vocabulary that comes to the driver, or, with
    ``buckets``, hashed to so many slots each, for vocabularies of any size."""
    # the class counts and several estimators scan the set: keep it
    # materialised for the fit (recomputable from lineage if lost)
    training = training.persist()
    try:
        df = with_class_weights(training) if balance else training.withColumn("weight", F.lit(1.0))
        return _without_summary(_pipeline(reg_param, max_iter, features, tol, buckets).fit(df))
    finally:
        training.unpersist()


def _without_summary(model: PipelineModel) -> PipelineModel:
    """A model as it is when loaded.  The training summary holds on to the session, which
    can't be sent to executors once a query of it has been observed (``Observation``)."""
    jvm = SparkSession.active().sparkContext._jvm
    for stage in model.stages:
        if isinstance(stage, LogisticRegressionModel):
            stage._java_obj.setSummary(jvm.scala.Option.empty())
    return model


def _labels(model: PipelineModel) -> list[str]:
    for st in model.stages:
        if st.hasParam("outputCol") and st.isDefined("outputCol") and st.getOutputCol() == "label":
            return list(st.labelsArray[0])
    raise ValueError("no label indexer in model")


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns + predicted label, per-label probabilities and pass probability."""
    labels = _labels(model)
    out = model.transform(df)
    probs = vector_to_array("probability")
    arr = F.array(*[F.struct(F.lit(lab).alias("label"), probs[i].alias("prob"))
                    for i, lab in enumerate(labels)])
    pred = F.array(*[F.lit(v) for v in labels])[F.col("prediction").cast("int")]
    res = out.select(*df.columns, pred.alias("predicted_last_test_result"),
                     arr.alias("predicted_last_test_result_probs"))
    return res.withColumn("pass_probability", pass_probability("predicted_last_test_result_probs"))


def model_weights(model: PipelineModel) -> DataFrame:
    """(feature, slot, value, weight): what the model adds up.  ``intercept`` is added as it
    is; a number's ``value`` is the mean that stands for NULL; a category has a weight
    per ``slot`` (hashed) or ``value`` (of the vocabulary)."""
    stages = {type(s).__name__: s for s in model.stages if type(s).__name__ != "StringIndexerModel"}
    names = next((s for s in model.stages if type(s).__name__ == "StringIndexerModel" and s.isSet("inputCols")), None)
    coefficients = [float(w) for w in stages["LogisticRegressionModel"].coefficients]
    rows = [("intercept", None, None, float(stages["LogisticRegressionModel"].intercept))]
    if "ImputerModel" in stages:
        means = stages["ImputerModel"].surrogateDF.first().asDict()
        for c in stages["ImputerModel"].getInputCols():
            rows.append((c.removesuffix("_d"), None, str(means[c]), coefficients.pop(0)))
    if "OneHotEncoderModel" in stages:
        enc = stages["OneHotEncoderModel"]
        for k, (c, size) in enumerate(zip(enc.getInputCols(), enc.categorySizes)):
            feature = c.removesuffix("_i")
            values = list(names.labelsArray[k]) if names else [None] * size
            # a vocabulary has one more place for values that training didn't have
            for i in range(size):
                rows.append((feature, i, values[i] if i < len(values) else None, coefficients.pop(0)))
    if coefficients:
        raise ValueError(f"{len(coefficients)} weights belong to no feature")
    return SparkSession.active().createDataFrame(rows, "feature string, slot int, value string, weight double")


def score_by_weights(weights: DataFrame, df: DataFrame, buckets: int, key: str = "registration") -> DataFrame:
    """(key, pass_probability) from the weights of a model with hashed categories, by
    plain joins and sums: a check of the pipeline, and a way to score without it."""
    one = {r["feature"]: r for r in weights.where("slot is null").collect()}      # intercept and numbers
    total = F.lit(one["intercept"]["weight"])
    for f in NUMERIC:
        if f in one:
            total = total + one[f]["weight"] * F.coalesce(F.col(f).cast("double"), F.lit(float(one[f]["value"])))
    rows = df.select(key, *FEATURES).withColumn("_id", F.monotonically_increasing_id())
    slots = F.array(*[F.struct(F.lit(c).alias("feature"), F.expr(slot(c, buckets)).cast("int").alias("slot")) for c in CATEGORICAL])
    cats = (rows.select("_id", key, total.alias("base"), F.inline(slots)).join(F.broadcast(weights.where("slot is not null")), ["feature", "slot"], "left")
            .groupBy("_id", key, "base").agg(F.sum(F.coalesce("weight", F.lit(0.0))).alias("w")))
    return cats.select(key, (1 / (1 + F.exp(-(F.col("base") + F.col("w"))))).alias("pass_probability"))


def lookup(df: DataFrame, keys: DataFrame, key: str = "registration",
           max_broadcast_keys: int = DEFAULT_MAX_BROADCAST_KEYS) -> DataFrame:
    """At most one row per requested key (semi join with the size-checked keys)."""
    hits = df.join(maybe_broadcast(keys.select(key).distinct(), max_broadcast_keys), key, "left_semi")
    return hits.dropDuplicates([key])


def lookup_score(model: PipelineModel, df: DataFrame, keys: DataFrame,
                 key: str = "registration") -> DataFrame:
    """Score the looked-up vehicles; the probability array is replaced by pass_probability."""
    rows = lookup(df, keys, key).select(key, *FEATURES)
    return score(model, rows).drop("predicted_last_test_result_probs")


def what_if(spark: SparkSession, mileage: int, vehicle_age: int, make: str, model: str,
            primaryColour: str) -> DataFrame:
    """One scenario row from parameters."""
    return spark.createDataFrame(
        [(int(mileage), int(vehicle_age), make, model, primaryColour)],
        "mileage bigint, vehicle_age bigint, make string, model string, primaryColour string")


def what_if_score(model: PipelineModel, scenarios: DataFrame) -> DataFrame:
    """Score scenarios; keeps the probability array and adds pass_probability."""
    return score(model, scenarios.select(*FEATURES))


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def lookup_one(spark: SparkSession, view: str, registration: str, key: str = "registration") -> DataFrame:
    """Single-key lookup through parameterised SQL (at most one row, no order)."""
    return spark.sql(
        f"SELECT * EXCEPT (motTests) FROM IDENTIFIER(:t) WHERE {key} = :reg LIMIT 1",
        args={"t": view, "reg": registration})
