"""Assembly of features, forest, metrics, importances and grids."""

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse import schemas
from tallyhouse.functions.hashing import order_hash
from tallyhouse.operators import trees
from tallyhouse.operators.stages import (
    DaysSinceLatest,
    ModeFiller,
    PlainNumber,
    TermWeights,
    ZeroFiller,
)
from tallyhouse.plans.ranks import with_places
from tallyhouse.plans.shared import checkpointed, shuffles_freed, written

# The default forest.
DEFAULT_FOREST = {
    "numTrees": 100,
    "maxDepth": 15,
    "minInstancesPerNode": 3,
    "minInstancesToSplit": 4,
    "impurity": "variance",
    "featureSubsetStrategy": "0.5",
    "bootstrap": True,
    "exactThresholds": False,
}


@dataclass(frozen=True)
class FeatureSpec:
    """Which columns play which part. The defaults are those of the listing table."""

    ordinal: str = schemas.ORDINAL
    category: str = schemas.CATEGORY
    zero_filled: Sequence[str] = schemas.ZERO_FILLED
    date: str = schemas.DATE
    text: str = schemas.TEXT
    label: str = schemas.LABEL
    key: str = schemas.KEY
    max_terms: int = 5
    reference_date: str = "batch"

    @property
    def columns(self) -> list[str]:
        return [self.ordinal, self.category, *self.zero_filled, self.date, self.text]


def preprocessor(spec: FeatureSpec) -> Pipeline:
    """Code, fill, one-hot, zero-fill, date and text steps, assembled in declared order."""
    numbers = list(spec.zero_filled)
    return Pipeline(
        stages=[
            StringIndexer(
                inputCol=spec.ordinal,
                outputCol="_ordinal_code",
                stringOrderType="alphabetAsc",
                handleInvalid="error",
            ),
            PlainNumber(inputCol="_ordinal_code", outputCol="_ordinal"),
            ModeFiller(inputCol=spec.category, outputCol="_category"),
            StringIndexer(
                inputCol="_category",
                outputCol="_category_code",
                stringOrderType="alphabetAsc",
                handleInvalid="error",
            ),
            OneHotEncoder(inputCol="_category_code", outputCol="_one_hot", dropLast=False),
            ZeroFiller(inputCols=numbers),
            DaysSinceLatest(
                inputCol=spec.date, outputCol="_days", referenceDate=spec.reference_date
            ),
            TermWeights(inputCol=spec.text, outputCol="_terms", maxFeatures=spec.max_terms),
            VectorAssembler(
                inputCols=["_ordinal", "_one_hot", *numbers, "_days", "_terms"],
                outputCol="features",
            ),
        ]
    )


def slots(fitted: PipelineModel, spec: FeatureSpec) -> list[tuple[str, str]]:
    """Feature and name of every vector slot, in order."""
    _, _, _, categories, _, _, _, terms, _ = fitted.stages
    named = [(spec.ordinal, spec.ordinal)]
    named += [(spec.category, f"{spec.category}={label}") for label in categories.labels]
    named += [(column, column) for column in spec.zero_filled]
    named += [(spec.date, spec.date)]
    named += [(spec.text, f"{spec.text}:{t}") for t in terms.getOrDefault(terms.terms)]
    return named


def assemble(df: DataFrame, fitted: PipelineModel, keep: Sequence[str] = ()) -> DataFrame:
    """Kept columns and the feature vector; everything else is dropped."""
    return fitted.transform(df).select(*keep, "features")


@dataclass(frozen=True)
class Forest:
    """Trees as rows (see ``trees.NODES``), and the number of features they were grown on."""

    nodes: DataFrame
    numFeatures: int


@dataclass(frozen=True)
class PriceModel:
    """A fitted model of two steps, ``preprocessor`` and ``random_forest``."""

    preprocessor: PipelineModel
    forest: Forest
    spec: FeatureSpec
    parameters: Mapping[str, object] = field(default_factory=dict)

    @property
    def named_steps(self) -> dict[str, object]:
        return {"preprocessor": self.preprocessor, "random_forest": self.forest}

    def predict(self, df: DataFrame, keep: Sequence[str] = (), by_joins: bool = False) -> DataFrame:
        """Kept columns and the prediction; ``by_joins`` never takes the trees to the tasks whole."""
        features = self.preprocessor.transform(df).select(*keep, "features")
        score = trees.predict_by_joins if by_joins else trees.predict
        return score(features, self.forest.nodes, "features", "prediction").drop("features")

    def out_of_bag(self, train: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Training rows scored by the trees that were grown without them; null if there is none."""
        key = self.spec.key
        features = self.preprocessor.transform(train).select(*dict.fromkeys([key, *keep]), "features")
        grown = trees.trees_of(self.parameters, self.forest.numFeatures)
        scored = trees.out_of_bag(features, self.forest.nodes, grown, key, "features", "prediction")
        return scored.select(*keep, "prediction")

    def save(self, path: str) -> None:
        """Write preprocessing, nodes, spec and parameters once; an existing path is refused."""
        spark = SparkSession.active()
        self.preprocessor.write().save(f"{path}/preprocessor")
        self.forest.nodes.write.mode("errorifexists").parquet(f"{path}/nodes")
        record = json.dumps(
            {
                "spec": asdict(self.spec),
                "parameters": dict(self.parameters),
                "features": self.forest.numFeatures,
            }
        )
        spark.createDataFrame([(record,)], "record string").coalesce(1).write.text(f"{path}/record")


def load_model(path: str) -> PriceModel:
    """The model as it was saved, with its own spec and parameters."""
    spark = SparkSession.active()
    record = json.loads(spark.read.text(f"{path}/record").first()[0])
    nodes = spark.read.schema(trees.NODES).parquet(f"{path}/nodes")
    return PriceModel(
        PipelineModel.load(f"{path}/preprocessor"),
        Forest(nodes, record["features"]),
        FeatureSpec(**record["spec"]),
        record["parameters"],
    )


def fit_forests(
    train: DataFrame,
    seed: int,
    forests: Mapping[str, Mapping[str, object]],
    spec: FeatureSpec | None = None,
) -> dict[str, PriceModel]:
    """Fit one preprocessing and several named forests on the same training rows.

    The trees of all forests grow together, so passes follow the depth and not the number of
    forests. Row order, partitions and session settings do not change a forest. A forest seed,
    if given, must equal ``seed``, that of the split.
    """
    spec = spec or FeatureSpec()
    settings = {}
    for name, forest in forests.items():
        unknown = set(forest) - {*DEFAULT_FOREST, "seed"}
        if unknown:
            raise ValueError(f"Unknown forest settings {sorted(unknown)}")
        settings[name] = {**DEFAULT_FOREST, "seed": seed, **forest}
        if settings[name]["seed"] != seed:
            raise ValueError("The forest seed must equal the split seed")
    columns = train.select(spec.key, spec.label, *spec.columns).persist()
    try:
        with shuffles_freed(train.sparkSession):
            prepared = preprocessor(spec).fit(columns)
            vectors = assemble(columns, prepared, [spec.key, spec.label])
            rows = trees.prepared_rows(vectors, spec.key, spec.label, "features")
    finally:
        columns.unpersist()
    specs = {name: trees.trees_of(values, rows.width) for name, values in settings.items()}
    nodes = trees.grow(rows, [tree for own in specs.values() for tree in own])
    models, first = {}, 0
    for name, own in specs.items():
        mine = nodes.where(F.col("tree").between(first, first + len(own) - 1))
        mine = mine.withColumn("tree", (F.col("tree") - first).cast("int"))
        first += len(own)
        effective = {**settings[name], "max_terms": spec.max_terms}
        models[name] = PriceModel(prepared, Forest(mine, rows.width), spec, effective)
    return models


def fit_forest(
    train: DataFrame,
    seed: int,
    forest: Mapping[str, object] | None = None,
    spec: FeatureSpec | None = None,
) -> PriceModel:
    """Fit preprocessing and one forest, by default the default one."""
    return fit_forests(train, seed, {"forest": forest or {}}, spec)["forest"]


def regression_metrics(
    df: DataFrame, label: str | Column, prediction: str | Column, by: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute error and R2 in one aggregate, per group if asked.

    The spread of the label comes from ``var_pop``, which merges partial results stably, so
    the mean is not needed beforehand. A constant label gives a null R2.
    """
    y = F.col(label) if isinstance(label, str) else label
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    spread = F.var_pop(y) * F.count(y)
    return df.groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        (1.0 - F.sum((y - p) * (y - p)) / F.nullif(spread, F.lit(0.0))).alias("r2"),
    )


def bad_metrics(df: DataFrame, mae: str = "mae", r2: str = "r2") -> DataFrame:
    """Rows whose metrics are missing, not finite, or have a negative error."""

    def not_finite(name):
        c = F.col(name)
        return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))

    return df.where(not_finite(mae) | not_finite(r2) | (F.col(mae) < 0))


def require_finite(df: DataFrame) -> DataFrame:
    """Pass the metrics table on, or raise if any row is bad."""
    if not bad_metrics(df).isEmpty():
        raise ValueError("Metrics must be finite and the absolute error not negative")
    return df


def feature_importance(model: PriceModel) -> list[tuple[str, float]]:
    """Importance per source feature: all slots of a feature are summed."""
    totals = dict.fromkeys(model.spec.columns, 0.0)
    named = slots(model.preprocessor, model.spec)
    for slot in trees.slot_importance(model.forest.nodes).collect():
        totals[named[slot["feature"]][0]] += slot["importance"]
    return list(totals.items())


def permutation_importance(model: PriceModel, df: DataFrame, seed: int) -> DataFrame:
    """(feature, mse, increase): the error once one feature's values change places, and by how much
    it is above the error of the rows as they are.

    One permutation serves all features: the row that is i-th by one hash of the key takes its
    value from the row that is i-th by another. Places come from counts of leading digits, so
    no window holds more than a bucket. Keys must be unique; rows without a key or label are
    left out. Features are source columns; all slots of one change together.
    """
    spec = model.spec
    columns = list(dict.fromkeys(spec.columns))
    known = df.where(F.col(spec.key).isNotNull() & F.col(spec.label).isNotNull())
    rows = written(known.select(spec.key, spec.label, *columns), "permuted-rows")
    other = F.struct(*[F.col(c) for c in columns]).alias("_other")
    here = with_places(rows.withColumn("_order", order_hash(seed, spec.key)), "_order", 32, "_place")
    there = with_places(
        rows.select(order_hash(seed + 1, spec.key).alias("_order"), other), "_order", 32, "_place"
    ).select("_place", "_other")
    pairs = written(here.drop("_order").join(there, "_place"), "permuted-pairs")
    none = F.lit("").alias("_feature")
    variants = F.explode(F.array(none, *[F.lit(c) for c in columns])).alias("_feature")
    long = pairs.select(
        variants, spec.key, spec.label, "_other", *columns
    ).select(
        "_feature",
        spec.key,
        spec.label,
        *[
            F.when(F.col("_feature") == c, F.col(f"_other.{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ],
    )
    off = F.col(spec.label) - F.col("prediction")
    errors = model.predict(long, ["_feature", spec.label]).groupBy("_feature").agg(F.avg(off * off).alias("mse"))
    errors = checkpointed(errors)
    base = errors.where("_feature = ''").select("mse").scalar()
    return errors.where("_feature <> ''").select(
        F.col("_feature").alias("feature"), "mse", (F.col("mse") - base).alias("increase")
    )


def fit_grid(
    train: DataFrame,
    validation: DataFrame,
    seed: int,
    forests: Mapping[str, Mapping[str, object]],
    spec: FeatureSpec | None = None,
) -> tuple[dict[str, PriceModel], DataFrame]:
    """Fit several named settings on one fixed partition: models, and (run_id, mae, r2).

    The validation rows are prepared once and scored by all models in the same pass.
    """
    spec = spec or FeatureSpec()
    models = fit_forests(train, seed, forests, spec)
    prepared = next(iter(models.values())).preprocessor
    scored = assemble(validation, prepared, [spec.label])
    for i, model in enumerate(models.values()):
        scored = trees.predict(scored, model.forest.nodes, "features", f"_p{i}")
    predictions = F.array(
        *[
            F.struct(F.lit(name).alias("run_id"), F.col(f"_p{i}").alias("prediction"))
            for i, name in enumerate(models)
        ]
    )
    long = scored.select(spec.label, F.inline(predictions))
    return models, regression_metrics(long, spec.label, "prediction", ["run_id"])
