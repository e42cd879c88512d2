"""Substring deduplication: passages that an earlier document holds are removed.

References are the documents themselves, so an automaton over all of them is broadcast to
nobody. Reference text is dealt into shards by anchors instead: the least hashed run of
``ANCHOR`` words in a window. Equal windows have equal anchors, so a shard holds all text
that its streams can match, and its automaton stays small.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from tallyhouse.llm.automaton import SuffixAutomaton
from tallyhouse.llm.batches import CHUNK_CHARS, FACTOR, chunks, mixed, rolling, slices
from tallyhouse.llm.registry import query, table
from tallyhouse.llm.scratch import Scratch

WINDOW = 13
ANCHOR = 6
# An anchor in more places has too much different text around it for one automaton: its
# windows become shards of their own.
HOT_PLACES = 2000
HELD_SEGMENTS = 100_000

# Byte weights and powers for hashes of words, made by rule.
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
WEIGHTS = mixed(np.arange(1, 257, dtype=np.uint64))
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)

DECIDED = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
LISTS = "anchors array<bigint>, hot array<bigint>"


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int):
        while len(self.up) < n:
            self.up, self.down = (
                np.concatenate((known, known * np.uint64(pow(base, len(known), 1 << 64))))
                for known, base in ((self.up, BASE), (self.down, INVERSE))
            )
        return self.up[:n], self.down[:n]


class _Words:
    """Words of some texts: the words, the number of the text of each, and hashes."""

    def __init__(self, texts: list[bytes], powers: _Powers):
        data = b"\n".join(texts) + b"\n"
        self.pieces = data.split()
        codes = np.frombuffer(data, dtype=np.uint8)
        blank = BLANK[codes]
        edges = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
        starts, ends = edges[0::2], edges[1::2]
        lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        first = np.cumsum(lengths) - lengths
        self.owners = np.searchsorted(first, starts, side="right") - 1
        up, down = powers(len(codes) + 1)
        sums = np.zeros(len(codes) + 1, dtype=np.uint64)
        np.cumsum(WEIGHTS[codes] * up[: len(codes)], out=sums[1:])
        self.hashes = mixed((sums[ends] - sums[starts]) * down[starts])

    def text(self, first: int, last: int) -> bytes:
        """Words ``first`` to ``last`` (exclusive), joined by one space."""
        return b" ".join(self.pieces[first:last])

    def runs(self):
        """(first window, windows, anchor) of maximal runs of windows with one anchor place."""
        count = len(self.hashes) - WINDOW + 1
        if count <= 0:
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        hashed = rolling(self.hashes, ANCHOR)
        least = hashed[:count].copy()
        place = np.arange(count)
        for k in range(1, WINDOW - ANCHOR + 1):
            other = hashed[k : k + count]
            lower = other < least
            least[lower] = other[lower]
            place[lower] = np.flatnonzero(lower) + k
        whole = np.flatnonzero(self.owners[:count] == self.owners[WINDOW - 1 :])
        if not len(whole):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
        # A place lies in one text, so windows of two texts never share one.
        heads = np.flatnonzero(np.concatenate(([True], np.diff(place[whole]) != 0)))
        sizes = np.diff(np.concatenate((heads, [len(whole)])))
        return whole[heads], sizes, least[whole[heads]]


def _texts(batch, column: str):
    """Texts of a batch in groups: (row numbers, _Words)."""
    powers = _Powers()
    values = batch.column(column).to_pylist()
    rows = [i for i, t in enumerate(values) if t is not None]
    texts = [values[i].encode("utf-8", "surrogatepass") for i in rows]
    for first, last in chunks(texts, CHUNK_CHARS):
        yield rows[first:last], _Words(texts[first:last], powers)


def _anchors(batches):
    for batch in slices(batches):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for rows, words in _texts(batch, "text"):
            first, _, anchors = words.runs()
            owners = ids[np.asarray(rows)[words.owners[first]]] if len(first) else ids[:0]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors.view(np.int64)), pa.array(owners.astype(np.int64))],
                names=["anchor", "doc_id"],
            )


def _decided(doc_id, n_words, n_removed, kept) -> list:
    digest = hashlib.sha256(kept).hexdigest() if kept is not None else None
    return [doc_id, n_words, n_removed, digest]


def _sort_out(batches):
    """Documents without a repeated anchor are done; the others go on with their text."""
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "text", "anchors", "hot"]
    for batch in slices(batches):
        columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "anchors", "hot")]
        out = []
        for doc_id, text, anchors, hot in zip(*columns):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            if anchors:
                out.append([*_decided(doc_id, len(words), None, None), text, anchors, hot])
            else:
                out.append([*_decided(doc_id, len(words), 0, b" ".join(words)), None, None, None])
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, row)) for row in out], schema=_arrow(f"{DECIDED}, text string, {LISTS}")
        )


def _arrow(ddl: str) -> pa.Schema:
    """An Arrow schema for the few types used here."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
        "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in ddl.split(", "))])


def _marked(rows: np.ndarray, anchors: np.ndarray, lists: list) -> np.ndarray:
    """Which (row, anchor) pairs stand in the rows' lists. A false mark only costs time."""

    def keys(numbers, values):
        return mixed(values.astype(np.int64).view(np.uint64) ^ (numbers.astype(np.uint64) * FACTOR))

    sizes = [len(x or ()) for x in lists]
    known = np.fromiter((v for x in lists for v in x or ()), np.int64, sum(sizes))
    return np.isin(keys(rows, anchors), keys(np.repeat(np.arange(len(lists)), sizes), known))


def _segments(words: _Words, anchors: list, hot: list):
    """For each text, the (key, first window, windows) of its text at repeated anchors.

    Runs at a hot anchor are cut into single windows, keyed by their own hashes.
    """
    first, sizes, found = words.runs()
    found, rows = found.view(np.int64), words.owners[first] if len(first) else first
    wanted = np.flatnonzero(_marked(rows, found, anchors))
    first, sizes, found, rows = (x[wanted] for x in (first, sizes, found, rows))
    split = _marked(rows, found, hot)
    keys = rolling(words.hashes, WINDOW).view(np.int64) if split.any() else None
    out: list[list] = [[] for _ in anchors]
    columns = (rows, found, first, sizes, split)
    for row, key, start, size, cut in zip(*(c.tolist() for c in columns)):
        if cut:
            out[row] += [(int(keys[w]), w, 1) for w in range(start, start + size)]
        else:
            out[row].append((key, start, size))
    return out


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _opened(batch):
    """(position, doc_id, words, first and last word, segments) of each row."""
    powers = _Powers()
    ids, texts, anchors, hot = (
        batch.column(c).to_pylist() for c in ("doc_id", "text", "anchors", "hot")
    )
    texts = [t.encode("utf-8", "surrogatepass") for t in texts]
    for first, last in chunks(texts, CHUNK_CHARS):
        words = _Words(texts[first:last], powers)
        segments = _segments(words, anchors[first:last], hot[first:last])
        ends = np.searchsorted(words.owners, np.arange(last - first), side="right").tolist()
        for k, (start, end) in enumerate(zip([0, *ends], ends)):
            yield first + k, ids[first + k], words, start, end, segments[k]


def _references(batches):
    """Text of the segments, equal ones of a task only once, with the least document."""
    schema = _arrow("key bigint, words binary, doc_id bigint, others int")
    held: dict = {}

    def flushed():
        rows = [(k, w, lo, int(hi > lo)) for (k, w), (lo, hi) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], schema.field(i).type) for i in range(4)], schema=schema
        )

    for batch in slices(batches):
        for _, doc_id, words, _, _, segments in _opened(batch):
            for key, first, windows in segments:
                mark = (key, words.text(first, first + windows + WINDOW - 1))
                lo, hi = held.get(mark, (doc_id, doc_id))
                held[mark] = (min(lo, doc_id), max(hi, doc_id))
            if len(held) >= HELD_SEGMENTS:
                yield flushed()
    yield flushed()


def _places(batches):
    """Which document holds which segment."""
    schema = _arrow("key bigint, segment bigint, doc_id bigint")
    for batch in slices(batches):
        rows = []
        for _, doc_id, words, _, _, segments in _opened(batch):
            for key, first, windows in segments:
                text = words.text(first, first + windows + WINDOW - 1)
                rows.append((key, _signed(xxh64_intdigest(text)), doc_id))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], schema=schema
        )


def _streamed(group: list[tuple[int, bytes, int]]):
    """Rows (words, document, others) of one key, by document, to (segment, least, mask).

    Every text of a document is matched against the automaton of all earlier documents; a
    window is marked if the match at its end is as long as a window. ``mask`` is that of the
    least document with the segment; in later ones all of the segment repeats.
    """
    segments: dict[bytes, list] = {}
    for words, doc_id, others in group:
        known = segments.get(words)
        if known is None:
            segments[words] = [doc_id, 0, bool(others)]
        elif doc_id > known[0]:
            known[2] = True
    if len(segments) > 1:
        automaton = SuffixAutomaton()
        waiting: list[list[bytes]] = []
        current = None
        for words, entry in segments.items():
            if entry[0] != current:
                for text in waiting:
                    automaton.add(text)
                current, waiting = entry[0], []
            text = words.split()
            for window, length in enumerate(automaton.matches(text)[WINDOW - 1 :]):
                if length >= WINDOW:
                    entry[1] |= 1 << window
            waiting.append(text)
    for words, (least, mask, others) in segments.items():
        if mask or others:
            yield _signed(xxh64_intdigest(words)), least, mask


def _match(batches):
    """Rows sorted by key and document; one key is held at a time."""
    schema = _arrow("key bigint, segment bigint, least bigint, mask int")
    key, group, out = None, [], []

    def packed():
        batch = pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], schema.field(i).type) for i in range(4)], schema=schema
        )
        out.clear()
        return batch

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for k, words, doc_id, others in zip(*columns):
            if k != key:
                out += [(key, *row) for row in _streamed(group)]
                key, group = k, []
            group.append((words, doc_id, others))
        yield packed()
    out += [(key, *row) for row in _streamed(group)]
    yield packed()


def _remove(batches):
    """Drop the words of all marked windows; a negative mask marks the whole segment."""
    schema = _arrow(DECIDED)
    for batch in slices(batches):
        marks = [batch.column(c).to_pylist() for c in ("keys", "segments", "masks")]
        out = []
        for i, doc_id, words, start, end, segments in _opened(batch):
            marked = {(k, s): m for k, s, m in zip(*[column[i] or [] for column in marks])}
            n = end - start
            cover = np.zeros(n + 1, dtype=np.int64)
            for key, first, windows in segments:
                text = words.text(first, first + windows + WINDOW - 1)
                mask = marked.get((key, _signed(xxh64_intdigest(text))), 0)
                for window in range(windows):
                    if mask < 0 or mask >> window & 1:
                        cover[first - start + window] += 1
                        cover[first - start + window + WINDOW] -= 1
            kept = np.flatnonzero(np.cumsum(cover[:n]) == 0)
            text = b" ".join([words.pieces[start + k] for k in kept.tolist()])
            out.append(_decided(doc_id, n, n - len(kept), text))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], schema.field(i).type) for i in range(4)], schema=schema
        )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` for every row of ``docs``.

    Words are runs of characters other than ASCII blanks. A word goes if a window of 13
    words that covers it starts in a document with a smaller id as well, judged on the
    input. The digest is that of the kept words joined by one space. A null or empty text
    has no words. Rows without an id lose nothing and are no reference; rows of one id are
    judged one by one, and none of them takes words from another. An empty table gives no
    rows.

    Shuffled are one row per anchor (about one in four words), then texts and segments of
    documents with repeated anchors. Equal segments of a task are sent once, hot anchors are
    split into windows, so no key gathers more than ``HOT_PLACES`` different texts.
    """
    scratch = Scratch(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    anchors = docs.where("doc_id is not null").mapInArrow(_anchors, "anchor bigint, doc_id bigint")
    repeated = scratch.keep(
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
        .where("lo < hi")
        .select("anchor", (F.col("n") > HOT_PLACES).alias("is_hot")),
        "repeated-anchors",
    )
    listed = scratch.keep(
        anchors.join(repeated, "anchor")
        .groupBy("doc_id")
        .agg(
            F.collect_set("anchor").alias("anchors"),
            F.collect_set(F.when(F.col("is_hot"), F.col("anchor"))).alias("hot"),
        ),
        "anchors-by-document",
    )
    scratch.drop(repeated)
    sorted_out = scratch.keep(
        docs.join(listed, "doc_id", "left").mapInArrow(_sort_out, f"{DECIDED}, text string, {LISTS}"),
        "sorted-out",
    )
    scratch.drop(listed)
    open_ = sorted_out.where("text is not null").select("doc_id", "text", "anchors", "hot")
    matched = scratch.keep(
        open_.mapInArrow(_references, "key bigint, words binary, doc_id bigint, others int")
        .repartition("key")
        .sortWithinPartitions("key", "doc_id")
        .mapInArrow(_match, "key bigint, segment bigint, least bigint, mask int"),
        "matched-segments",
    )
    marks = (
        open_.mapInArrow(_places, "key bigint, segment bigint, doc_id bigint")
        .join(matched, ["key", "segment"])
        .withColumn("mask", F.when(F.col("doc_id") > F.col("least"), F.lit(-1)).otherwise(F.col("mask")))
        .where("mask <> 0")
        .groupBy("doc_id")
        .agg(F.collect_set(F.struct("key", "segment", "mask")).alias("marks"))
        .select(
            "doc_id",
            F.col("marks.key").alias("keys"),
            F.col("marks.segment").alias("segments"),
            F.col("marks.mask").alias("masks"),
        )
    )
    cut = open_.join(marks, "doc_id", "left").mapInArrow(_remove, DECIDED)
    done = sorted_out.where("text is null").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(cut)


@query("op2_substring_dedup")
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents"))
