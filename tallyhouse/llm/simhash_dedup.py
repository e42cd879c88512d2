"""SimHash near-duplicates: a grid join over bit counts, then exact bit distances."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import map_texts
from tallyhouse.llm.components import components
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Bits counted together. Two fields make the count of a pair of bits: 0, 1 or 2.
PAIR_BITS = np.uint64(0x55555555)
HALF = np.uint64(0xFFFFFFFF)
SEGMENTS = 16
SMALL_RUN = 32
BIT_ROWS = 1 << 15

ADDED = T.StructType([T.StructField("fingerprint", T.LongType())])


def simhash(text: str | None) -> int:
    """The unsigned 64-bit fingerprint of a whole text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    last = ends[min(SHINGLE_WORDS, len(words)) - 1 :].tolist()
    first = (ends - lengths)[: len(last)].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for k in range(0, len(last), BIT_ROWS):
        pairs = zip(first[k : k + BIT_ROWS], last[k : k + BIT_ROWS])
        data = b"".join([digest(joined[s:e], SEED) for s, e in pairs])
        bits = np.unpackbits(np.frombuffer(data, dtype=np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(last)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fingerprint``, the bits as a signed number; such a column is replaced.

    A-Z is lower-cased, words are runs of characters other than ASCII blanks, shingles are
    runs of four words with repeats. Fewer words make one shingle, no word gives 0.
    """

    def compute(batch):
        values = [simhash(t) for t in batch.column(text).to_pylist()]
        return [pa.array(np.array(values, dtype=np.uint64).view(np.int64))]

    return map_texts(docs, ADDED, compute)


def _cells(batches):
    """The cells around each fingerprint, once per half of its bits.

    A half is mapped to the bit counts of its 16 pairs. Four differing bits leave at most two
    in one half, and bit counts differ by no more than bits do (Manhattan distance). Two
    points of a grid within 2 of each other have a point within 1 of both, so a cell is such
    a point, and each fingerprint goes to all points within 1.
    """
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for half in (0, 1):
            bits = (values >> np.uint64(32 * half)) & HALF
            counts = (bits & PAIR_BITS) + ((bits >> np.uint64(1)) & PAIR_BITS)
            tag = np.uint64(half << 32)
            cells, owners = [counts | tag], [values]
            for segment in range(SEGMENTS):
                one = np.uint64(1 << (2 * segment))
                count = (counts >> np.uint64(2 * segment)) & np.uint64(3)
                for room, moved in ((count < 2, counts + one), (count > 0, counts - one)):
                    cells.append(moved[room] | tag)
                    owners.append(values[room])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(cells).view(np.int64)),
                    pa.array(np.concatenate(owners).view(np.int64)),
                ],
                names=["cell", "fingerprint"],
            )


def _forest(values: np.ndarray, max_bits: int):
    """Links that join all fingerprints of a large cell that can reach each other in it."""
    left = values
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            value = front.pop()
            near = np.bitwise_count(left ^ value) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                front.extend(found)
                yield np.full(len(found), value), found


def _linked(max_bits: int):
    def link(batches):
        """Sorted (cell, fingerprint) rows to links; only one cell is carried over."""
        rest_cells = rest_values = np.zeros(0, dtype=np.uint64)

        def links(cells, values):
            starts = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
            lengths = np.diff(np.concatenate((starts, [len(cells)])))
            small = np.repeat(lengths <= SMALL_RUN, lengths)
            for offset in range(1, min(SMALL_RUN, int(lengths.max(initial=1)))):
                a, b = values[:-offset], values[offset:]
                same = (cells[:-offset] == cells[offset:]) & small[offset:]
                at = np.flatnonzero(same)
                if not len(at):
                    break
                at = at[np.bitwise_count(a[at] ^ b[at]) <= max_bits]
                yield a[at], b[at]
            for k in np.flatnonzero(lengths > SMALL_RUN):
                yield from _forest(values[starts[k] : starts[k] + lengths[k]], max_bits)

        def packed(found):
            found = list(found)
            if found:
                sides = [np.concatenate(side).view(np.int64) for side in zip(*found)]
                yield pa.RecordBatch.from_arrays([pa.array(s) for s in sides], names=["a", "b"])

        for batch in batches:
            columns = [
                batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in (0, 1)
            ]
            cells = np.concatenate((rest_cells, columns[0]))
            values = np.concatenate((rest_values, columns[1]))
            if not len(cells):
                continue
            cut = int(np.searchsorted(cells, cells[-1]))
            rest_cells, rest_values = cells[cut:], values[cut:]
            if cut:
                yield from packed(links(cells[:cut], values[:cut]))
        if len(rest_cells):
            yield from packed(links(rest_cells, rest_values))

    return link


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints that keep all that can be reached.

    ``distinct`` has one column of different fingerprints. Up to four bits are found. Links
    repeat between cells. A cell with many fingerprints gives a forest instead of all pairs,
    so its output is no larger than the cell.
    """
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"Between 0 and {MAX_BITS} differing bits")
    cells = distinct.mapInArrow(_cells, "cell bigint, fingerprint bigint")
    dealt = cells.repartition("cell").sortWithinPartitions("cell")
    return dealt.mapInArrow(_linked(max_bits), "a bigint, b bigint")


def group(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (signed) and ``component_id`` for every row.

    Equal fingerprints are one node, so copies are never paired; a component is named by its
    smallest ``doc_id``. Null ids name no component unless they are alone: then it is null.
    Rows that repeat are returned as often. An empty table gives no rows.
    """
    marked = written(fingerprints(docs.select("doc_id", "text")).drop("text"), "simhash")
    nodes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    distinct = written(nodes, "simhash-nodes")
    roots = components(links(distinct.select("fingerprint"), max_bits))
    rooted = roots.withColumnRenamed("node", "fingerprint").join(distinct, "fingerprint")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root").select("fingerprint", "least")
    mapping = written(
        distinct.join(named, "fingerprint", "left").select(
            "fingerprint", F.coalesce("least", "first").alias("component_id")
        ),
        "simhash-components",
    )
    return join_lookup(marked, stored_lookup(mapping), ["fingerprint"], "inner", spread_by=["doc_id"])


@query("op7_simhash_dedup")
def op7_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return group(table(spark, folder, "documents")).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )
