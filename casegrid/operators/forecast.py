"""Random-forest case forecast.

Training and scoring are Spark ML jobs: the forest is fitted by
``pyspark.ml.regression.RandomForestRegressor`` (distributed tree induction
over partitioned data), the encoders are part of one ``PipelineModel`` so
scoring reuses the fitted encoding, and the model is saved natively.

Encoding matches ``get_dummies(drop_first=True)``: ``StringIndexer`` with
``alphabetDesc`` order puts the alphabetically first level last, and
``OneHotEncoder(dropLast=True)`` drops it. A level that training never had has
no column, so its encoding is that of the dropped (baseline) level (R6).

The scoring grid (districts x diseases x weeks 1..52) is generated from the
fitted indexer labels (model metadata, bounded by the category counts) with
``explode`` generators, not a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.dims import Dims, literal_table
from casegrid.functions.calendar import week_to_month
from casegrid.functions.numbers import clip_zero_int
from casegrid.operators.cleaning import lookup_district
from casegrid.session import materialize

NUMERIC = ["year", "week_number", "month", "avg_annual_rainfall_mm", "national_avg_rainfall_mm"]
CATEGORICAL = ["area_reported", "disease"]
LABEL = "cases_reported"
WEEKS = 52
MAX_SPARK_DEPTH = 30  # Spark's tree depth limit; "unlimited" maps to it
MAX_BINS = 128  # more than the 53 week numbers, so every week can be split on


def training_frame(cases: DataFrame, annual: DataFrame, national: DataFrame, dims: Dims) -> DataFrame:
    """Training rows (C5): cleaned cases (blank counts dropped) with the area's
    annual rainfall and the month's national mean; rows with any gap dropped."""
    df = cases.select(
        "year", "week_number", "month", F.col("district").alias("area_reported"), "disease", LABEL
    )
    df = lookup_district(df, "area_reported", dims, rainfall_area="area_key")
    df = df.join(annual, "area_key", "left").join(F.broadcast(national), "month", "left")  # national: 12 rows
    return df.select(*NUMERIC, *CATEGORICAL, LABEL).na.drop("any")


def build_pipeline(num_trees: int = 300, max_depth: int | None = None, seed: int = 42) -> Pipeline:
    """Encoders + assembler + forest."""
    idx = [f"{c}_idx" for c in CATEGORICAL]
    ohe = [f"{c}_ohe" for c in CATEGORICAL]
    if max_depth is not None and max_depth > MAX_SPARK_DEPTH:
        raise ValueError(f"Spark's trees have a depth of {MAX_SPARK_DEPTH} at most")
    depth = MAX_SPARK_DEPTH if max_depth is None else max_depth
    return Pipeline(stages=[
        StringIndexer(inputCols=CATEGORICAL, outputCols=idx, stringOrderType="alphabetDesc",
                      handleInvalid="error"),
        OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
        VectorAssembler(inputCols=NUMERIC + ohe, outputCol="features"),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, predictionCol="prediction",
                              numTrees=num_trees, maxDepth=depth, featureSubsetStrategy="all",
                              maxBins=MAX_BINS, bootstrap=True, subsamplingRate=1.0, seed=seed,
                              # node-id cache checkpointed to the reliable checkpoint
                              # folder, so deep trees survive lost executors
                              cacheNodeIds=True, checkpointInterval=10),
    ])


def error_metrics(scored: DataFrame) -> DataFrame:
    """MAE and RMSE of ``prediction`` vs the label in one aggregate."""
    err = F.col("prediction") - F.col(LABEL)
    return scored.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def train(
    data: DataFrame,
    num_trees: int = 300,
    max_depth: int | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    checkpoint: bool = True,
    split: str = "random",
) -> tuple[PipelineModel, DataFrame]:
    """Hold-out split, fit, evaluate (M2-M4). Returns (model, metrics frame).

    ``split="random"``: a seeded random split, as the source does.
    ``split="hash"``: rows go to the test side by a seeded hash of their
    identifying columns (year, week, area, disease), so the split is the same
    on every run and cluster size.

    The training rows are written once to the session's checkpoint folder
    (``materialize``): the indexer fit, the forest's passes and the evaluation
    then read those files instead of re-deriving the rows.
    """
    if checkpoint:
        data = materialize(data, "training-rows")
    train_df, test_df = split_holdout(data, test_size, seed, split)
    model = build_pipeline(num_trees, max_depth, seed).fit(train_df)
    return model, error_metrics(transform(model, test_df))


def split_holdout(data: DataFrame, test_size: float, seed: int, split: str = "random") -> tuple[DataFrame, DataFrame]:
    """Train / test frames for a hold-out split (M2)."""
    if split == "random":
        train_df, test_df = data.randomSplit([1.0 - test_size, test_size], seed=seed)
        return train_df, test_df
    if split != "hash":
        raise ValueError("split must be 'random' or 'hash'")
    test = in_holdout(test_size, seed)
    return data.filter(~test), data.filter(test)


def in_holdout(test_size: float, seed: int) -> Column:
    """True on the test side of the hash split: the first 8 hex digits of the MD5 of a row's
    seed, year, week, area and disease, modulo 10,000."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ("year", "week_number", "area_reported", "disease")])
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(10000)) < F.lit(int(round(test_size * 10000)))


def labels(model: PipelineModel) -> tuple[list[str], list[str]]:
    """Sorted area and disease categories the model was fitted on."""
    indexer = model.stages[0]
    areas, diseases = (sorted(x) for x in indexer.labelsArray)
    return list(areas), list(diseases)


def prediction_grid(
    spark: SparkSession,
    areas: list[str],
    diseases: list[str],
    year: int,
    annual: DataFrame,
    national: DataFrame,
    dims: Dims,
) -> DataFrame:
    """Every (area, disease, week 1..52) for ``year`` with rainfall lookups."""
    schema = T.StructType([T.StructField("area_reported", T.StringType())])
    grid = literal_table(spark, [(a,) for a in areas], schema)
    # one generator per projection: diseases first, then the weeks
    grid = grid.withColumn("disease", F.explode(F.array(*[F.lit(d) for d in diseases])))
    grid = grid.select(
        F.lit(int(year)).alias("year"),
        F.explode(F.sequence(F.lit(1), F.lit(WEEKS))).alias("week_number"),
        "area_reported",
        "disease",
    )
    grid = grid.withColumn("month", week_to_month("week_number"))
    grid = lookup_district(grid, "area_reported", dims, rainfall_area="area_key")
    grid = grid.join(annual, "area_key", "left").join(F.broadcast(national), "month", "left")  # national: 12 rows
    return grid.select(*NUMERIC, *CATEGORICAL)


def feature_columns(model: PipelineModel) -> list[str]:
    """Names of the assembled features, in their order: numbers, then ``<column>_<level>`` without the baseline level."""
    names = list(NUMERIC)
    for column, levels in zip(CATEGORICAL, model.stages[0].labelsArray, strict=True):
        names += [f"{column}_{level}" for level in levels[:-1]]  # the encoder drops the last index
    return names


def categories_from_features(columns: Sequence[str], diseases: Sequence[str]) -> tuple[list[str], list[str]]:
    """Areas and diseases to score when only the feature names are known: areas that have a column, and all known diseases.

    The baseline area has no column and so is not among them.
    """
    prefix = f"{CATEGORICAL[0]}_"
    return sorted({c[len(prefix):] for c in columns if c.startswith(prefix)}), list(diseases)


def align_levels(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Rows with levels that training never had (or none) set to the baseline level."""
    for column, levels in zip(CATEGORICAL, model.stages[0].labelsArray, strict=True):
        known = F.col(column).isin(list(levels))  # as many as training had categories
        rows = rows.withColumn(column, F.when(known, F.col(column)).otherwise(F.lit(levels[-1])))
    return rows


def transform(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """``model.transform`` that takes unseen levels as the baseline; the given names stay."""
    given = [F.col(c).alias(f"{c}_given") for c in CATEGORICAL]
    scored = model.transform(align_levels(model, rows.select("*", *given)))
    return scored.withColumns({c: F.col(f"{c}_given") for c in CATEGORICAL}).drop(*[f"{c}_given" for c in CATEGORICAL])


def predict(model: PipelineModel, grid: DataFrame) -> DataFrame:
    """Score the grid; ``predicted_cases`` = rounded half-even, clipped at 0, int.

    An area or disease that training never had is scored as the baseline level, under its own name.
    """
    scored = transform(model, grid)
    return scored.select(
        "year", "week_number", "month", "avg_annual_rainfall_mm", "national_avg_rainfall_mm",
        "area_reported", "disease", clip_zero_int("prediction").alias("predicted_cases"),
    )


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the fitted pipeline."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
