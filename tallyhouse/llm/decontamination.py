"""Benchmark decontamination by templates: windows with typed slots, hash-joined."""

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tallyhouse.llm.batches import FACTOR, chunks, map_texts, mixed, rolling
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import BROADCAST_ROWS, stored_lookup

WINDOW = 10
# A window of slots alone fits everything; this share of its words must be literal for a
# match by template. Windows below it match word for word.
LITERAL_SHARE = 0.6
CACHED_WORDS = 300_000

# Units that stand for one another in a re-parameterised question.
UNITS = frozenset(
    """
    mm cm m km inch inches foot feet yard yards mile miles g kg mg gram grams kilogram
    kilograms pound pounds lb lbs oz ounce ounces l ml liter liters litre litres gallon
    gallons second seconds sec minute minutes min hour hours hr hrs day days week weeks month
    months year years percent % dollar dollars euro euros cent cents usd eur $ € £ mph kmh
    watt watts volt volts degree degrees
    """.split()
)
NUMBER_WORDS = frozenset(
    """
    one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
    sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety
    hundred thousand million half twice
    """.split()
)
NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,/:]*(?:%|st|nd|rd|th)?")
EDGES = re.compile(r"^[^\w$€£%]+|[^\w$€£%]+$")

SENTENCE_END = re.compile(r"[.!?:][\"')\]]*$")

# The two lowest bits of a word's code hold its kind, the next one whether a sentence ends
# with it, the fourth whether it is marks alone; the rest is a hash of the word.
LITERAL, NUMERIC, NAME, UNIT = range(4)
KIND, ENDS, MARKS = np.uint64(3), np.uint64(4), np.uint64(8)
FLAGS = 15
FLAG_BITS = np.uint64(4)

WINDOWS = T.ArrayType(
    T.StructType(
        [
            T.StructField("template", T.LongType()),
            T.StructField("slots", T.LongType()),
            T.StructField("at", T.IntegerType()),
            T.StructField("words", T.IntegerType()),
            T.StructField("counts", T.BooleanType()),
        ]
    )
)
ADDED = T.StructType([T.StructField("windows", WINDOWS)])


class _Codes(dict):
    """Codes of words, kept per task; marks around a word do not count."""

    def __missing__(self, word):
        plain = EDGES.sub("", word)
        lower = plain.lower()
        if NUMBER.fullmatch(lower) or lower in NUMBER_WORDS:
            kind = NUMERIC
        elif lower in UNITS:
            kind = UNIT
        elif plain[:1].isupper() and not plain.isupper():
            kind = NAME
        else:
            kind = LITERAL
        if len(self) >= CACHED_WORDS:
            self.clear()
        ends = 4 if SENTENCE_END.search(word) else 0
        marks = 0 if plain else 8
        hashed = xxh64_intdigest((lower or word).encode("utf-8", "surrogatepass"))
        self[word] = code = (hashed & ~FLAGS) | marks | ends | kind
        return code


def _slots(codes, literal, back, at, n, first):
    """Slot hashes of the windows at ``at``, by what their first word is taken for.

    ``first`` is a slot like any other ("as it is"), a literal word ("word") or a name ("name").
    """
    slots = np.zeros(len(at), dtype=np.uint64)
    for k in range(1, n):
        step = back[at + k]
        if first == "as it is":
            step = np.where(step <= k, step, 0)
        else:
            step = np.where(step < k, step, 0)
        if first == "name":
            again = (step == 0) & ~literal[at + k] & (codes[at + k] == codes[at])
            step = np.where(again, k, step)
        slots *= FACTOR
        slots += step.astype(np.uint64)
    return slots


def _windows(
    codes: np.ndarray, begins: np.ndarray, n: int, table: np.ndarray | None = None
) -> tuple[np.ndarray, ...]:
    """Key, slot hash, first word and whether it counts, of all windows of ``n`` words.

    The words are those of several texts; ``begins`` marks where a text begins, and no window
    reaches over two. Each window has the key of its words as they are, and, with enough literal
    words, that of its template, which sees literal words and kinds of slots. The slot hash sees
    which slots of the window hold equal values, so two windows with equal hashes have slots that
    map to each other one to one. A window without slots has the same key either way. What precedes
    a window has no say in its keys: one that begins with a capital has the templates of a literal
    word and of a name. With a ``table`` of known keys only windows with one of them are returned,
    and slots are looked at in these alone.
    """
    count = len(codes) - n + 1
    texts = np.cumsum(begins)
    inside = texts[:count] == texts[n - 1 :]
    kinds = codes & KIND
    name = kinds[:count] == NAME
    # The first word of a sentence has its capital for another reason.
    first = begins.copy()
    first[1:] |= codes[:-1] & ENDS != 0
    kinds[first & (kinds == NAME)] = LITERAL
    literal = kinds == LITERAL
    plain = literal & (codes & MARKS == 0)
    codes = codes >> FLAG_BITS
    words = mixed(codes)
    values = np.where(plain, words, kinds)
    tail = rolling(values[1:], n - 1) * FACTOR
    verbatim = mixed(words[:count] + rolling(words[1:], n - 1) * FACTOR)
    template = mixed(np.where(name, words[:count], values[:count]) + tail)
    # Literal words after the first one of each window.
    inner = np.cumsum(np.concatenate(([0], literal)))
    inner = inner[n:] - inner[1 : count + 1]
    least = LITERAL_SHARE * n
    counts = inner + literal[:count] >= least
    enough = np.where(name, inner + 1 >= least, counts)

    def known(keys):
        if table is None:
            return np.ones(len(keys), dtype=bool)
        return table[keys >> np.uint64(65 - len(table).bit_length())]

    exact = np.flatnonzero(inside & known(verbatim))
    at = np.flatnonzero(inside & enough & (template != verbatim) & known(template))
    named = np.flatnonzero(inside & name & (inner >= least))
    as_name = mixed(np.uint64(NAME) + tail[named])
    kept = known(as_name)
    named, as_name = named[kept], as_name[kept]
    # Words back to the last slot of the same value; 0 for none. Only texts that may match count.
    back = np.zeros(len(codes), dtype=np.int64)
    wanted = np.zeros(texts[-1] + 1, dtype=bool)
    wanted[texts[at]] = wanted[texts[named]] = True
    slot = np.flatnonzero(~literal & wanted[texts])
    if len(slot):
        order = slot[np.lexsort((slot, codes[slot]))]
        same = codes[order[1:]] == codes[order[:-1]]
        back[order[1:][same]] = (order[1:] - order[:-1])[same]
    slots = np.zeros(len(at), dtype=np.uint64)
    for of, kind in ((name[at], "word"), (~name[at], "as it is")):
        slots[of] = _slots(codes, literal, back, at[of], n, kind)
    return (
        np.concatenate((verbatim[exact], template[at], as_name)),
        np.concatenate(
            (np.zeros(len(exact), np.uint64), slots, _slots(codes, literal, back, named, n, "name"))
        ),
        np.concatenate((exact, at, named)),
        np.concatenate((counts[exact], counts[at], counts[named])),
    )


def _table(keys: np.ndarray) -> np.ndarray:
    """A table by the highest bits of keys: which of them any of ``keys`` has."""
    bits = max(16, (16 * len(keys)).bit_length())
    table = np.zeros(1 << bits, dtype=bool)
    table[keys >> np.uint64(64 - bits)] = True
    return table


def template_windows(
    rows: DataFrame,
    sizes: Sequence[int],
    shorter: bool = False,
    text: str = "text",
    known: np.ndarray | None = None,
) -> DataFrame:
    """Add ``windows`` of each whole text, for every number of words in ``sizes``.

    Words are split at blanks; numbers, units and names become typed slots. A name has a
    capital first letter, is not all in capitals and does not begin a sentence; other words
    are compared without regard to case. A capital that begins a window is taken both ways. A text with fewer words than a size has no window
    of that size, or with ``shorter`` one that is all of it. A null or empty text has none.
    Each window comes with the key of its words in lower case, and if enough of them are literal,
    with that of its template too; it ``counts`` if enough are where it stands. Windows that have none of the
    ``known`` keys may be left out.
    """
    table = None if known is None else _table(known)
    # Filled as the task goes on.
    codes = _Codes()

    def of_texts(texts):
        """(text, template, slots, place, words, counts) of the windows of some texts."""
        split = [t.split() for t in texts]
        lengths = np.array([len(words) for words in split])
        starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(texts)), lengths)
        coded = np.fromiter((codes[w] for words in split for w in words), np.uint64, len(owner))
        begins = np.zeros(len(owner), dtype=bool)
        begins[starts[lengths > 0]] = True
        for n in sizes:
            if n <= len(owner):
                template, slots, at, counts = _windows(coded, begins, n, table)
                yield owner[at], template, slots, at - starts[owner[at]], np.full(len(at), n), counts
            for i in np.flatnonzero((lengths > 0) & (lengths < n)) if shorter else ():
                own = slice(starts[i], starts[i] + lengths[i])
                found = _windows(coded[own], begins[own], lengths[i], table)
                size = len(found[0])
                yield np.full(size, i), *found[:3], np.full(size, lengths[i]), found[3]

    def compute(batch):
        texts = [t or "" for t in batch.column(text).to_pylist()]
        found = [(np.zeros(0, np.uint64),) * 6]
        for first, last in chunks(texts):
            found += [(f[0] + first, *f[1:]) for f in of_texts(texts[first:last])]
        kinds = (np.int64, np.int64, np.int64, np.int32, np.int32, np.bool_)
        columns = [np.concatenate([f[i] for f in found]).astype(k) for i, k in enumerate(kinds)]
        order = np.argsort(columns[0], kind="stable")
        ends = np.concatenate(([0], np.cumsum(np.bincount(columns[0], minlength=len(texts)))))
        structs = pa.StructArray.from_arrays(
            [pa.array(c[order]) for c in columns[1:]],
            names=["template", "slots", "at", "words", "counts"],
        )
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)]

    return map_texts(rows, ADDED, compute)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """One row per document and benchmark item that share a window.

    Columns: ``doc_id``, ``item_id``, ``n_windows`` (places in the document), ``first_word``,
    ``last_word`` (their smallest and largest start) and ``share`` of the item's windows that
    were found. Windows match if their templates are equal and their slots consistent: equal
    values stand at the same places of both. Windows match as well if all their words are
    equal without regard to case, whatever they are. An item shorter than the window is
    matched as a whole.

    Windows of the item with too few literal words match by their words only. They are left
    out of the figures, unless the document has no other window of the item: then the figures
    are of all windows.

    Rows with equal ids count together. Null texts and ids match nothing. Empty tables give
    no rows. The benchmark's windows are broadcast if they are within ``max_rows``, and only
    windows that may match one are taken from the documents; else all are joined by a shuffle.
    """
    items = (
        template_windows(
            benchmark.select("item_id", "text").where("item_id is not null"), [window], shorter=True
        )
        .select("item_id", F.explode("windows").alias("w"))
        .select(
            "item_id", "w.template", F.col("w.slots").alias("_slots"), "w.words",
            F.col("w.at").alias("_at"), F.when(F.col("w.counts"), F.col("w.at")).alias("_counted"),
        )
    )
    lookup = stored_lookup(items, max_rows)
    sizes = sorted({window} | {r[0] for r in items.select("words").distinct().collect()})
    known = None
    if lookup.fits:
        keys = [r[0] for r in items.select("template").distinct().collect()]
        known = np.array(keys, dtype=np.int64).astype(np.uint64)
    windows = (
        template_windows(
            docs.select("doc_id", "text").where("doc_id is not null"), sizes, known=known
        )
        .select("doc_id", F.explode("windows").alias("w"))
        .select("doc_id", "w.template", "w.slots", "w.words", "w.at")
    )
    matches = windows.join(
        F.broadcast(items) if lookup.fits else items, ["template", "words"]
    ).where("slots = _slots")

    def figures(at, ats):
        return F.struct(
            F.count(at).alias("n_windows"),
            F.min(at).cast("bigint").alias("first_word"),
            F.max(at).cast("bigint").alias("last_word"),
            F.size(F.array_distinct(F.flatten(F.collect_list(ats)))).alias("found"),
        )

    # Places, then windows, are counted in steps, so that no row is multiplied.
    places = matches.groupBy("doc_id", "item_id", "at").agg(
        F.collect_set("_at").alias("_ats"), F.collect_set("_counted").alias("_counted")
    )
    totals = items.groupBy("item_id").agg(
        F.countDistinct("_at").alias("_windows"), F.countDistinct("_counted").alias("_counting")
    )
    counted = F.col("_of_counted.n_windows") > 0
    return (
        places.groupBy("doc_id", "item_id")
        .agg(
            figures(F.col("at"), "_ats").alias("_of_all"),
            figures(F.when(F.size("_counted") > 0, F.col("at")), "_counted").alias("_of_counted"),
        )
        .join(F.broadcast(totals) if lookup.fits else totals, "item_id")
        .withColumn("_of", F.when(counted, F.col("_of_counted")).otherwise(F.col("_of_all")))
        .select(
            "doc_id", "item_id", "_of.n_windows", "_of.first_word", "_of.last_word",
            (F.col("_of.found") / F.when(counted, F.col("_counting")).otherwise(F.col("_windows")))
            .alias("share"),
        )
    )


@query("op4_decontamination")
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
