"""Language identification: multinomial naive Bayes over hashed character n-grams."""

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import chunks, map_texts, mixed, slices
from tallyhouse.llm.registry import query, table

UNDETERMINED = "und"
SIZES = (1, 2, 3)
BUCKETS = 1 << 16
MAX_LANGUAGES = 1000
SMOOTHING = 0.5
PIECE_CHARS = 1 << 20
BLANK = ord(" ")
WORD = re.compile(r"[^\W\d_]+")

ADDED = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)


def _has_letter(text: str) -> bool:
    return any(any(c.isalpha() for c in m.group()) for m in WORD.finditer(text))


def _pieces(texts: list[str]):
    """(text number, piece, starts that belong to it): long texts in overlapping pieces."""
    most = max(SIZES) - 1
    for i, text in enumerate(texts):
        text = text.lower()
        for start in range(0, max(len(text), 1), PIECE_CHARS):
            yield i, text[start : start + PIECE_CHARS + most], PIECE_CHARS


def _buckets(texts: list[str]):
    """Yields (text numbers, first index of each, n-gram buckets) for texts in groups.

    Every piece ends with a separator; n-grams that hold one, or start with two blanks,
    get the bucket ``BUCKETS``.
    """
    pieces = list(_pieces(texts))
    for first, last in chunks([piece for _, piece, _ in pieces], PIECE_CHARS):
        group = pieces[first:last]
        codes = np.frombuffer(
            "".join(piece + "\0" for _, piece, _ in group).encode("utf-32-le", "surrogatepass"),
            dtype=np.uint32,
        ).astype(np.uint64)
        # Digits, marks and blanks of ASCII say nothing about a language: all count as one blank.
        codes[(codes > 0) & ((codes < ord("a")) | ((codes > ord("z")) & (codes < 128)))] = BLANK
        lengths = np.array([len(piece) + 1 for _, piece, _ in group])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        offset = np.arange(len(codes)) - np.repeat(starts, lengths)
        owned = offset < PIECE_CHARS
        numbers = np.array([i for i, _, _ in group])
        broken = codes == 0
        broken[:-1] |= (codes[:-1] == BLANK) & (codes[1:] == BLANK)
        value = np.zeros(len(codes), dtype=np.uint64)
        for k in range(max(SIZES)):
            # The n-gram that starts here, as far as it stays within the group.
            value = value * np.uint64(0x10FFFF + 1)
            value[: len(codes) - k] += codes[k:] + np.uint64(1)
            if k:
                broken[: len(codes) - k] |= codes[k:] == 0
                broken[len(codes) - k :] = True
            if k + 1 in SIZES:
                ids = (mixed(value + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int32)
                yield numbers, starts, np.where(broken | ~owned, np.int32(BUCKETS), ids)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in code point order and their log-probabilities.

    ``weights[l]`` has ``BUCKETS + 1`` entries; the last one, for broken n-grams, is 0.
    """

    languages: tuple[str, ...]
    priors: np.ndarray
    weights: np.ndarray

    def log_scores(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language."""
        total = np.tile(self.priors, (len(texts), 1))
        for numbers, starts, ids in _buckets(texts):
            for column, weight in enumerate(self.weights):
                np.add.at(total[:, column], numbers, np.add.reduceat(weight[ids], starts))
        return total


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from all rows with a text and a language.

    Every task counts n-grams of its own rows, so what is shuffled has at most
    ``BUCKETS`` rows per task and language. The driver gets the summed counts, at most
    ``MAX_LANGUAGES * BUCKETS`` numbers; more languages raise. No row at all gives a model
    without languages.
    """

    def count(batches):
        counts, rows = {}, {}
        for batch in slices(batches):
            by_language = {}
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_language.setdefault(name, []).append(value)
            for name, texts in by_language.items():
                total = counts.setdefault(name, np.zeros(BUCKETS + 1, dtype=np.int64))
                rows[name] = rows.get(name, 0) + len(texts)
                for _, _, ids in _buckets(texts):
                    total += np.bincount(ids, minlength=BUCKETS + 1)
        for name, total in counts.items():
            found = np.flatnonzero(total[:BUCKETS])
            # Bucket -1 carries the number of texts.
            buckets = np.concatenate(([-1], found)).astype(np.int32)
            values = np.concatenate(([rows[name]], total[found])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(buckets), pa.string()), pa.array(buckets), pa.array(values)],
                names=["lang", "bucket", "n"],
            )

    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        "lang is not null and text is not null"
    )
    counted = (
        known.mapInArrow(count, "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    try:
        names = [r[0] for r in counted.where("bucket = -1").select("lang").take(MAX_LANGUAGES + 1)]
        if len(names) > MAX_LANGUAGES:
            raise ValueError(f"More than {MAX_LANGUAGES} languages")
        languages = tuple(sorted(names))
        totals = counted.toArrow()
    finally:
        counted.unpersist()
    place = {name: i for i, name in enumerate(languages)}
    rows = np.array([place[x] for x in totals.column("lang").to_pylist()], dtype=np.int64)
    buckets = totals.column("bucket").to_numpy().astype(np.int64)
    n = totals.column("n").to_numpy()
    texts = np.zeros(len(languages))
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    head = buckets < 0
    texts[rows[head]] = n[head]
    counts[rows[~head], buckets[~head]] += n[~head]
    weights = np.zeros((len(languages), BUCKETS + 1))
    weights[:, :BUCKETS] = np.log(counts / counts.sum(axis=1, keepdims=True))
    priors = np.log(texts / texts.sum()) if len(languages) else texts
    return LanguageModel(languages, priors, weights)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the probability of that language, to every row.

    Whole texts are scored. A null text, a text without any letter, and every text under a
    model without languages give ``und`` and 0. Equal probabilities give the language that
    comes first by code point. Columns named like the two are replaced. The model is
    broadcast: 512 KB per language, of which there are at most ``MAX_LANGUAGES``.
    """
    # Plain values: a broadcast class would have to be importable on the executors.
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.priors, model.weights)
    )

    def compute(batch):
        model = LanguageModel(*shared.value)
        texts = batch.column(text).to_pylist()
        names: list[str] = [UNDETERMINED] * len(texts)
        scores = np.zeros(len(texts))
        known = [i for i, t in enumerate(texts) if t and model.languages and _has_letter(t)]
        if known:
            logs = model.log_scores([texts[i] for i in known])
            best = logs.argmax(axis=1)
            scores[known] = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
            for i, b in zip(known, best):
                names[i] = model.languages[b]
        return [pa.array(names, pa.string()), pa.array(scores)]

    return map_texts(docs, ADDED, compute)


def fold(key: Column, folds: int) -> Column:
    """Remainder of the CRC-32 of a key's text; null for a null key."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def fit_documents(docs: DataFrame) -> LanguageModel:
    """The model of the documents outside the held-out third. Null ids teach nothing."""
    return fit(docs.where(fold(F.col("doc_id"), 3) != 1))


@query("op6_language_id")
def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return identify(docs.select("doc_id", "text"), fit_documents(docs)).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
