"""Toxicity scores: boosted trees over dense features, calibrated by isotonic regression.

The lexicon has a fixed part, words of insult in four languages, and a learned one: words whose
documents are far more often toxic than others. A training document's own label never reaches its
features: its lexicon is learned from the other folds.
"""

import re
from collections import Counter
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import map_texts, slices
from tallyhouse.llm.language_id import fold
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

# Words of insult and of address, English first, then German, French, Spanish.
INSULTS = frozenset(
    """
    idiot idiots moron morons loser losers stupid trash worthless disgusting scum clown
    clowns pathetic dumb imbecile jerk fool fools ugly filthy vermin garbage pig pigs retard
    retarded bastard bastards bitch whore slut crap shit bullshit asshole fuck fucking damn
    hate kill nasty creep coward liar
    dumm dummkopf trottel depp arschloch scheisse scheiße abschaum versager hure wichser
    connard connasse salaud salope imbécile débile merde ordure crétin pourriture
    estúpido estúpida imbécil basura mierda escoria inútil pendejo puta cabrón gilipollas
    """.split()
)
ADDRESS = frozenset(
    """
    you your yours yourself ya u ur du dich dir dein deine ihr euch tu te toi ton ta vous
    votre tú ti tus usted ustedes vosotros
    """.split()
)
NEAR_WORDS = 5

WORD = re.compile(r"[^\W\d_]+")
# A word with digits or marks inside it, or a letter three times in a row.
DISGUISED = re.compile(r"(?<![^\W_])[a-z]+[0-9@$!*|][a-z0-9@$!*|]*(?![^\W_])|[a-z]*([a-z])\1\1[a-z]*")
# Marks and the letters they stand for.
PLAIN = str.maketrans("013457@$!|", "oieastasil")
RUNS = re.compile(r"(.)\1{2,}")

FEATURES = (
    "insults per word", "log insults", "distinct insults", "address per word",
    "insults near address", "capitals per letter", "words in capitals", "marks per character",
    "exclamations per word", "repeated marks", "disguised words", "disguised insults",
    "digits per character", "log words", "learned per word", "log learned", "distinct learned",
    "largest log-odds", "summed log-odds",
)
CAPITAL_WORD = re.compile(r"\b[A-Z]{2,}\b")

ADDED = T.StructType([T.StructField("features", T.ArrayType(T.DoubleType()))])

MAX_FIT_ROWS = 40_000
TREES = 20
DEPTH = 3
SEED = 42
# A word is learned from so many toxic documents of the sample, from this log-odds on.
LEAST_DOCUMENTS = 4
LEAST_LOG_ODDS = 3.0
FOLDS = 4
HELD_WORDS = 300_000

Lexicon = Mapping[str, float]
WORDS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("fold", T.IntegerType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("n", T.LongType()),
    ]
)


def _features(text: str, lexicon: Lexicon) -> list[float]:
    lower = text.lower()
    words = WORD.findall(lower)
    distinct = set(words)
    n = max(len(words), 1)
    bad = [] if INSULTS.isdisjoint(distinct) else [i for i, w in enumerate(words) if w in INSULTS]
    address = [] if ADDRESS.isdisjoint(distinct) else [i for i, w in enumerate(words) if w in ADDRESS]
    near = 0
    if bad and address:
        at = np.searchsorted(address, bad)
        left = np.abs(np.take(address, np.maximum(at - 1, 0)) - bad)
        right = np.abs(np.take(address, np.minimum(at, len(address) - 1)) - bad)
        near = int((np.minimum(left, right) <= NEAR_WORDS).sum())
    disguised = [m.group() for m in DISGUISED.finditer(lower)]
    unmasked = 0
    for word in disguised:
        plain = RUNS.sub(r"\1", word.translate(PLAIN).replace("*", ""))
        unmasked += plain in INSULTS and word not in INSULTS
    learned = [lexicon[w] for w in distinct if w in lexicon]
    held = sum(w in lexicon for w in words) if learned else 0
    count = np.bincount(
        np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256
    )
    capitals, digits = int(count[65:91].sum()), int(count[48:58].sum())
    letters = capitals + int(count[97:123].sum())
    marks = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    size = max(len(text), 1)
    repeated = sum(text.count(mark * 2) for mark in "!?*#$%&")
    return [
        len(bad) / n,
        float(np.log1p(len(bad))),
        float(len({words[i] for i in bad})),
        len(address) / n,
        near / n,
        capitals / max(letters, 1),
        len(CAPITAL_WORD.findall(text)) / n,
        marks / size,
        int(count[33]) / n,
        repeated / n,
        len(disguised) / n,
        unmasked / n,
        digits / size,
        float(np.log1p(len(words))),
        held / n,
        float(np.log1p(held)),
        float(len(learned)),
        max(learned, default=0.0),
        float(np.sum(np.sort(learned))) if learned else 0.0,
    ]


def featurize(
    docs: DataFrame, text: str = "text", lexicons: tuple[Lexicon, ...] = ({},), fold: str | None = None
) -> DataFrame:
    """Add ``features`` of each whole text (see ``FEATURES``); a null text counts as empty.

    The last lexicon is used, or with ``fold`` that of the row's fold number. An empty table
    stays empty; a column ``features`` is replaced.
    """

    def compute(batch):
        texts = batch.column(text).to_pylist()
        folds = batch.column(fold).to_pylist() if fold else [-1] * len(texts)
        rows = [_features(t or "", lexicons[f]) for t, f in zip(texts, folds)]
        return [pa.array(rows, pa.list_(pa.float64()))]

    return map_texts(docs, ADDED, compute)


def sample_of(
    docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS, seed: int = SEED
) -> DataFrame:
    """Labelled documents to learn from, written: (key, text, label, fold).

    ``labels`` is (doc_id, label). Of labels that repeat an id the largest counts, nulls and others
    than 0 and 1 do not. Beyond ``max_rows`` a share is chosen by the hash of the id, before any
    text is read; it then fits a broadcast. Documents that repeat an id are all taken.
    """
    known = (
        labels.where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max(F.col("label").cast("int")).alias("label"))
    )
    most = 1 << 62
    place = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(most)) / F.lit(float(most))
    share = min(1.0, max_rows / max(known.count(), 1))
    chosen = written(known.where(place < share), "toxicity-labels")
    fold = F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(FOLDS)).cast("int")
    found = join_lookup(
        docs.select("doc_id", "text"), stored_lookup(chosen), ["doc_id"], "inner", spread_by=["text"]
    )
    return written(
        found.select(F.col("doc_id").alias("key"), "text", "label", fold.alias("fold")),
        "toxicity-sample",
    )


def learn_lexicons(sample: DataFrame) -> tuple[Lexicon, ...]:
    """The lexicon without each fold, and last that of the whole sample.

    Documents are counted by word, fold and label; a word's log-odds are those of its documents
    being toxic against all others, smoothed by one half.
    """

    def count(batches):
        held = Counter()

        def sent():
            if held:
                keys = list(held)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k[0] for k in keys], pa.string()),
                        pa.array([k[1] for k in keys], pa.int32()),
                        pa.array([k[2] for k in keys], pa.int32()),
                        pa.array([held[k] for k in keys], pa.int64()),
                    ],
                    names=WORDS.names,
                )
            held.clear()

        for batch in slices(batches):
            rows = (batch.column(c).to_pylist() for c in ("text", "fold", "label"))
            for text, fold, label in zip(*rows):
                held.update((w, fold, label) for w in set(WORD.findall((text or "").lower())))
                if len(held) > HELD_WORDS:
                    yield from sent()
        yield from sent()

    cells = [(f, label) for f in range(FOLDS) for label in (0, 1)]

    def of_cell(n, f, label):
        hit = (F.col("fold") == f) & (F.col("label") == label)
        return F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).alias(f"n{f}_{label}")

    totals = sample.agg(*[of_cell(F.lit(1), *c) for c in cells]).first()
    words = (
        sample.select("text", "fold", "label")
        .mapInArrow(count, WORDS)
        .groupBy("word")
        .agg(*[of_cell(F.col("n"), *c) for c in cells])
    )
    toxic = sum((F.col(f"n{f}_1") for f in range(FOLDS)), F.lit(0))
    clean = sum((F.col(f"n{f}_0") for f in range(FOLDS)), F.lit(0))
    # No fold's lexicon has a word that the whole sample shows too rarely, or as mostly clean.
    likely = words.where((toxic >= LEAST_DOCUMENTS) & (clean <= toxic)).collect()
    lexicons = []
    for left_out in (*range(FOLDS), None):
        kept = [f for f in range(FOLDS) if f != left_out]
        all_toxic, all_clean = (sum(totals[f"n{f}_{label}"] for f in kept) for label in (1, 0))
        lexicon = {}
        for row in likely:
            t, c = (sum(row[f"n{f}_{label}"] for f in kept) for label in (1, 0))
            odds = np.log((t + 0.5) / (all_toxic - t + 0.5)) - np.log((c + 0.5) / (all_clean - c + 0.5))
            if t >= LEAST_DOCUMENTS and odds >= LEAST_LOG_ODDS:
                lexicon[row["word"]] = float(odds)
        lexicons.append(lexicon)
    return tuple(lexicons)


class ToxicityModel:
    """Boosted trees, then the isotonic curve from their margin to a probability.

    Without both classes in the rows there are no trees, and every score is ``rate``.
    """

    def __init__(
        self,
        rate: float,
        trees: GBTClassificationModel | None = None,
        curve: IsotonicRegressionModel | None = None,
    ):
        self.rate, self.trees, self.curve = rate, trees, curve

    def margins(self, featured: DataFrame) -> DataFrame:
        vectors = featured.withColumn("_vector", array_to_vector("features"))
        return self.trees.transform(vectors).withColumn("_margin", vector_to_array("_raw")[1])

    def score(self, featured: DataFrame) -> DataFrame:
        """Add ``score``, 0 to 1, and ``predicted``, 1 from 0.5 on; such columns are replaced."""
        if self.trees is None:
            scored = featured.withColumn("score", F.lit(float(self.rate)))
        else:
            scored = self.margins(featured.drop("score"))
            if self.curve is None:
                scored = scored.withColumn("score", 1 / (1 + F.exp(-2 * F.col("_margin"))))
            else:
                scored = self.curve.transform(scored)
            scored = scored.drop("_vector", "_raw", "_probability", "_class", "_margin")
        score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
        return scored.withColumn("score", score).withColumn(
            "predicted", (F.col("score") >= 0.5).cast("int")
        )


def fit(rows: DataFrame, seed: int = SEED) -> ToxicityModel:
    """Fit on rows with ``key``, ``features`` and ``label`` (0 or 1; others are ignored).

    Meant for a bounded sample (``sample_of``). Three quarters of the keys, by hash, grow the
    trees; the rest bends the curve. Without rows of both classes every score is one rate.
    """
    most = 1 << 62
    place = F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(most)) / F.lit(float(most))
    known = rows.where("label in (0, 1) and features is not null").select(
        "features", F.col("label").cast("double").alias("label"), place.alias("_place")
    )
    chosen = known.persist()
    try:
        grown = F.col("_place") < 0.75
        counts = {
            (r["grown"], r["label"]): r["n"]
            for r in chosen.groupBy(grown.alias("grown"), "label").agg(F.count("*").alias("n")).collect()
        }
        positive = sum(n for (_, label), n in counts.items() if label == 1)
        rate = (positive + 0.5) / (sum(counts.values()) + 1)
        if not all(counts.get((True, label)) for label in (0.0, 1.0)):
            return ToxicityModel(rate)
        booster = GBTClassifier(
            featuresCol="_vector", labelCol="label", predictionCol="_class",
            maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=seed,
        )
        booster.setRawPredictionCol("_raw").setProbabilityCol("_probability")
        trees = booster.fit(chosen.where(grown).withColumn("_vector", array_to_vector("features")))
        model = ToxicityModel(rate, trees)
        if all(counts.get((False, label)) for label in (0.0, 1.0)):
            held = model.margins(chosen.where(~grown))
            model.curve = IsotonicRegression(
                featuresCol="_margin", labelCol="label", predictionCol="score"
            ).fit(held)
        return model
    finally:
        chosen.unpersist()


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document is scored; ids may be null or repeat."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = (
        table(spark, folder, "labels")
        .where(fold(F.col("doc_id"), 5) != 0)
        .select("doc_id", F.col("toxic").alias("label"))
    )
    sample = sample_of(docs, labels)
    lexicons = learn_lexicons(sample)
    out_of_fold = written(featurize(sample, lexicons=lexicons, fold="fold").drop("text"), "toxicity-features")
    model = fit(out_of_fold)
    return model.score(featurize(docs, lexicons=lexicons).drop("text")).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )
