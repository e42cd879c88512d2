"""Pipeline stages with saved state: what Spark ML lacks for the feature steps.

The state of every stage is a few values, kept as params, so a fitted pipeline is saved and
loaded by Spark ML's own writer.
"""

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from tallyhouse.functions.text import ENGLISH_STOP_WORDS, tokens
from tallyhouse.operators import features


class _Saved(DefaultParamsReadable, DefaultParamsWritable):
    def _set_given(self, given):
        self._set(**{name: value for name, value in given.items() if value is not None})


class ModeFiller(Estimator, HasInputCol, HasOutputCol, _Saved):
    """Learns the commonest value of a text column; ties go to the smallest."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _fit(self, dataset):
        column = self.getInputCol()
        row = dataset.select(features.most_frequent(dataset, column).alias("v")).first()
        if row is None or row["v"] is None:
            raise ValueError(f"Column {column} has no value to fill with")
        return ModeFillerModel(
            inputCol=column, outputCol=self.getOutputCol(), fillValue=row["v"]
        )


class ModeFillerModel(Model, HasInputCol, HasOutputCol, _Saved):
    fillValue = Param(Params._dummy(), "fillValue", "value for nulls", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, fillValue=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _transform(self, dataset):
        fill = F.lit(self.getOrDefault(self.fillValue))
        return dataset.withColumn(
            self.getOutputCol(), F.coalesce(F.col(self.getInputCol()), fill)
        )


class ZeroFiller(Transformer, HasInputCols, _Saved):
    """Numeric columns as doubles with zero for null and NaN, in place."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _transform(self, dataset):
        columns = self.getInputCols()
        as_double = dataset.withColumns({c: F.col(c).cast("double") for c in columns})
        return features.impute_zero(as_double, columns)


class DaysSinceLatest(Estimator, HasInputCol, HasOutputCol, _Saved):
    """Days to the latest date, of the batch being transformed or of the fitted table."""

    referenceDate = Param(
        Params._dummy(), "referenceDate", "batch or fitted", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, referenceDate="batch"):
        super().__init__()
        self._setDefault(referenceDate="batch")
        self._set_given(self._input_kwargs)

    def _fit(self, dataset):
        mode = self.getOrDefault(self.referenceDate)
        latest = None
        if mode == "fitted":
            filled = F.coalesce(
                F.col(self.getInputCol()).cast("date"), F.lit(features.OLD_DATE).cast("date")
            )
            latest = str(dataset.agg(F.max(filled)).first()[0])
        elif mode != "batch":
            raise ValueError("referenceDate must be batch or fitted")
        return DaysSinceLatestModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), latest=latest
        )


class DaysSinceLatestModel(Model, HasInputCol, HasOutputCol, _Saved):
    latest = Param(
        Params._dummy(), "latest", "fixed latest date; unset: of the batch", TypeConverters.toString
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, latest=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _transform(self, dataset):
        column, output = self.getInputCol(), self.getOutputCol()
        if not self.isDefined(self.latest):
            counted = features.days_since_latest(dataset, column, output)
        else:
            latest = F.lit(self.getOrDefault(self.latest)).cast("date")
            filled = F.coalesce(F.col(column).cast("date"), F.lit(features.OLD_DATE).cast("date"))
            counted = dataset.withColumn(output, F.datediff(latest, filled))
        return counted.withColumn(output, F.col(output).cast("double"))


class TermWeights(Estimator, HasInputCol, HasOutputCol, _Saved):
    """Learns the top terms of a short text and weighs them by TF-IDF."""

    maxFeatures = Param(Params._dummy(), "maxFeatures", "terms kept", TypeConverters.toInt)
    stopWords = Param(Params._dummy(), "stopWords", "words left out", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, maxFeatures=5, stopWords=None):
        super().__init__()
        self._setDefault(maxFeatures=5, stopWords=list(ENGLISH_STOP_WORDS))
        self._set_given(self._input_kwargs)

    def _fit(self, dataset):
        stop_words = self.getOrDefault(self.stopWords)
        vocabulary = features.fit_vocabulary(
            dataset, self.getInputCol(), self.getOrDefault(self.maxFeatures), stop_words
        )
        rows = (
            vocabulary.terms.table.select(
                "term",
                features.smoothed_idf(vocabulary.documents, F.col("document_count")).alias("idf"),
            )
            .orderBy("term")
            .collect()
        )
        if not rows:
            raise ValueError(f"Column {self.getInputCol()} has no term to weigh")
        return TermWeightsModel(
            inputCol=self.getInputCol(),
            outputCol=self.getOutputCol(),
            terms=[row["term"] for row in rows],
            idf=[row["idf"] for row in rows],
        )


class TermWeightsModel(Model, HasInputCol, HasOutputCol, _Saved):
    terms = Param(Params._dummy(), "terms", "kept terms", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "weights of the terms", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, terms=None, idf=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _transform(self, dataset):
        # Counts, weights and norm as sparse vectors: the work follows the words of a row.
        counter = CountVectorizerModel.from_vocabulary(
            self.getOrDefault(self.terms), inputCol="_words", outputCol="_counts"
        )
        weigher = ElementwiseProduct(
            scalingVec=Vectors.dense(self.getOrDefault(self.idf)), inputCol="_counts", outputCol="_raw"
        )
        scaler = Normalizer(p=2.0, inputCol="_raw", outputCol=self.getOutputCol())
        counted = dataset.withColumn("_words", tokens(F.col(self.getInputCol())))
        for step in (counter, weigher, scaler):
            counted = step.transform(counted)
        return counted.drop("_words", "_counts", "_raw")


class PlainNumber(Transformer, HasInputCol, HasOutputCol, _Saved):
    """A code as a number: trees may then split it by order, and no limit on categories holds."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set_given(self._input_kwargs)

    def _transform(self, dataset):
        # A sum is a new column, without the note that its values are names of categories.
        return dataset.withColumn(self.getOutputCol(), F.col(self.getInputCol()) + F.lit(0.0))
