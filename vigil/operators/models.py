"""Training, scoring and stacking; all models are MLlib's."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import curves
from vigil.operators.boosting import BoostedTrees, Rules
from vigil.operators.curves import running_totals
from vigil.operators.labels import class_weights
from vigil.schema import HOUR, KEY, LABEL, model_inputs
from vigil.session import settings, written

POSITIVE_WEIGHT = 10.0
#: A task of the training holds its rows unpacked in memory: it reads so many bytes of a file at most, in row groups of
#: that size, whatever the size of the table.
TASK_BYTES = 16 << 20
ROW_GROUPS = {"parquet.block.size": str(TASK_BYTES)}
MISSING = -1.0e6  # below any recorded value: trees send missing values to the lowest side


def numeric_inputs(df: DataFrame, skip=(KEY, HOUR, LABEL)) -> list[str]:
    """Every numeric column but keys and label, sorted by name."""
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return sorted(n for n, t in df.dtypes if t in kinds and n not in skip)


def prepared(df: DataFrame, inputs) -> DataFrame:
    filled = {f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in inputs}
    weight = F.when(F.col(LABEL) == 1, POSITIVE_WEIGHT).otherwise(1.0) if LABEL in df.columns else F.lit(1.0)
    return df.withColumns({**filled, "_weight": weight})


def train_trees(
    train: DataFrame, inputs, val: DataFrame | None = None, rounds=2000, depth=5, rate=0.05, min_leaf=500,
    fraction=0.8, seed=42, patience=100, l1=0.5, l2=0.5, bins=255,
) -> PipelineModel:
    """Boosted trees; with a validation table, rounds stop once its AUROC has not risen for ``patience`` rounds, and the
    trees up to the best round are kept."""
    data = train.withColumn("_held", F.lit(False))
    if val is not None:
        data = data.unionByName(val.withColumn("_held", F.lit(True)))
    rules = Rules(rounds, depth, rate, min_leaf, fraction, seed, patience, l1, l2, bins)
    learner = BoostedTrees(LABEL, rules, MISSING)
    assembler = VectorAssembler(inputCols=[f"_x_{c}" for c in inputs], outputCol="_features")
    with settings(train.sparkSession, {"spark.sql.files.maxPartitionBytes": str(TASK_BYTES)}):
        return Pipeline(stages=[assembler, learner]).fit(prepared(data, inputs))


def score(model: PipelineModel, df: DataFrame, inputs, name="proba") -> DataFrame:
    scored = model.transform(prepared(df, inputs)).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*[c for c in df.columns if c != name], name)


def feature_importance(spark: SparkSession, model: PipelineModel, inputs) -> DataFrame:
    """Importance by gain and number of splits, highest first."""
    trees = model.stages[-1]
    gains = trees.featureImportances.toArray()
    splits = [0] * len(inputs)
    for tree in trees.trees:
        for line in tree.toDebugString.splitlines():
            if line.strip().startswith("If (feature "):
                splits[int(line.split("feature ")[1].split(" ")[0])] += 1
    rows = [(c, float(g), int(n)) for c, g, n in zip(inputs, gains, splits)]
    table = spark.createDataFrame(rows, "feature string, gain double, split int")
    return table.orderBy(F.desc("gain"), "feature")


def shuffled(df: DataFrame, columns, key: str, seed: int, prefix="_dealt_") -> DataFrame:
    """The table with a further column for each of ``columns``: its values dealt out anew in a seeded order that no task
    sees whole. The order is the same for all of them, so rows are shuffled once."""
    def ranked(salt, *kept):
        out = df.withColumn("_draw", F.md5(F.concat(F.lit(f"{seed}|{salt}|"), F.col(key).cast("string"))))
        out = out.select(*kept, key, "_draw", F.lit(1).cast("long").alias("_one"))
        out = out.withColumn("_cell", F.conv(F.substring("_draw", 1, 4), 16, 10).cast("long"))
        return running_totals(out, [], "_cell", ["_draw", key], {"_one": "_turn"}).drop("_draw", "_one", "_cell")

    dealt = ranked("values", *columns).select("_turn", *[F.col(c).alias(f"{prefix}{c}") for c in columns])
    rows = ranked("rows", *[c for c in df.columns if c != key])
    return rows.join(dealt, "_turn").select(*df.columns, *[f"{prefix}{c}" for c in columns])


def permutation_importance(model, df: DataFrame, inputs, columns, key="event_id", seed=42) -> DataFrame:
    """How much the AUROC falls when a column is shuffled, one row per column. Each row comes once for every column, with
    that column's value dealt anew; all of them are scored in one pass and one curve per column is taken of them together."""
    base = curves.auroc(curves.score_steps(score(model, df, inputs))).select(F.col("auroc").alias("base"))
    table = shuffled(df.select(*dict.fromkeys([key, LABEL, *inputs, *columns])), columns, key, seed)
    put = table.withColumn("_column", F.explode(F.array(*[F.lit(k) for k in range(len(columns))])))
    put = put.withColumns({c: F.when(F.col("_column") == k, F.col(f"_dealt_{c}")).otherwise(F.col(c)) for k, c in enumerate(columns)})
    probas = written(score(model, put.select("_column", LABEL, *inputs), inputs).select("_column", LABEL, "proba"), "permuted")
    parts = curves.score_steps(probas, keys=("_column",)).groupBy("_column").agg(curves.auroc_of_steps().alias("auroc"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "_column int, feature string")
    parts = names.join(F.broadcast(parts), "_column", "left").orderBy("_column")
    return parts.select("feature", (base.scalar() - F.col("auroc")).alias("auroc_drop"))


def stack(val: DataFrame, columns=("proba", "second_proba"), strength=1.0) -> PipelineModel:
    """Logistic regression on two probabilities with balanced class weights."""
    weights = class_weights(val).select(LABEL, F.col("weight").alias("_w"))
    data = val.join(F.broadcast(weights), LABEL)
    # Balanced weights add up to the number of rows, and MLlib averages the loss over that sum.
    n = data.count()
    learner = LogisticRegression(
        labelCol=LABEL, featuresCol="_features", weightCol="_w", standardization=False, regParam=1.0 / (strength * n),
        elasticNetParam=0.0, maxIter=1000,
    )
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_features")
    return Pipeline(stages=[assembler, learner]).fit(data)


def apply_stack(model: PipelineModel, df: DataFrame, name="ensemble_proba") -> DataFrame:
    return model.transform(df).withColumn(name, vector_to_array("probability")[1]).select(*df.columns, name)


def calibrate(df: DataFrame, on: str = "proba", name="calibrated") -> DataFrame:
    """Isotonic calibration fitted on distinct scores, which carry their share of positives as label."""
    steps = df.groupBy(F.col(on)).agg(F.avg(LABEL).alias("_share"), F.count(F.lit(1)).cast("double").alias("_n"))
    model = IsotonicRegression(featuresCol=on, labelCol="_share", weightCol="_n", predictionCol=name).fit(steps)
    return model.transform(df)


def save_bundle(model: PipelineModel, inputs, params: dict, path: str) -> None:
    """Model, feature order and decision parameters side by side."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    row = [(json.dumps(list(inputs)), json.dumps(params))]
    spark.createDataFrame(row, "inputs string, params string").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_bundle(spark: SparkSession, path: str):
    """(model, inputs, params); refuses a bundle whose feature order is unknown."""
    meta = spark.read.schema("inputs string, params string").json(f"{path}/meta").first()
    if meta is None or not meta["inputs"] or not json.loads(meta["inputs"]):
        raise ValueError("the bundle has no feature order")
    return PipelineModel.load(f"{path}/model"), json.loads(meta["inputs"]), json.loads(meta["params"] or "{}")


def default_inputs(drop=()) -> list[str]:
    return model_inputs(drop)
