"""Secret scans: layers of encoding are unwrapped until nothing new comes out."""

import base64
import re
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator, Sequence
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import map_texts
from tallyhouse.llm.registry import query, table

KINDS = ("assign", "access", "hex")
# The patterns of the base spans.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("passw", "secret", "token", "api")
VALUE_CHARS = 6
# A run is matched as a whole, so the least length can stand in the pattern.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});"
)
# The shortest secret has 12 characters, so 16 encoded ones.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Runs that go on after line breaks.
WRAPPED = re.compile(r"[A-Za-z0-9+/_-]+(?:[ \t]*\r?\n[ \t>]*[A-Za-z0-9+/_-]+)+={0,2}")
PIECE = re.compile(r"[A-Za-z0-9+/_-]+")
# Where compressed data may start in a run: gzip anywhere, zlib after a mark.
PACKED = re.compile(r"(?=H4sI)|(?:(?<=[/_-])|(?<=\n)|^)(?=e[A-P])")
# Decompressed data is scanned in pieces of this many bytes, which overlap.
MAX_UNPACKED = 16 << 20
OVERLAP = 1 << 20
REDACTED = "[SECRET]"
SHORTEST = 16
READABLE = 0.7
CHUNK = 1 << 20
STEP = 64
HEAD = 256
STANDARD = str.maketrans("-_", "+/")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
ADDED = T.StructType(
    [
        T.StructField("base_spans", T.ArrayType(SPAN)),
        T.StructField("spans", T.ArrayType(SPAN)),
    ]
)
ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def scan(text: str) -> Iterator[tuple[int, int, int]]:
    """(kind number, start, end) of the secrets that stand in a text as it is."""
    lower = text.lower()
    if any(word in lower for word in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m.group(2)) >= VALUE_CHARS:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


def _percent(match: re.Match) -> str:
    # Secrets are ASCII, so bytes that are not UTF-8 may become anything.
    return bytes.fromhex(match.group().replace("%", "")).decode("utf-8", "replace")


def _escape(match: re.Match) -> str | None:
    hexadecimal = match.group(1) or match.group(2) or match.group(3)
    code = int(hexadecimal, 16) if hexadecimal else int(match.group(4))
    return chr(code) if code <= 0x10FFFF and not 0xD800 <= code < 0xE000 else None


class Moved:
    """Places of the characters of a text made from another: by segment, not by character.

    A segment is either a part of the other text, found at another place, or a decoded match,
    all of which has one place.
    """

    def __init__(self, before):
        self.before, self.at, self.offset, self.place = before, array("q"), array("q"), array("q")

    def _add(self, at: int, size: int, offset: int, place: int) -> None:
        if size:
            self.at.append(at)
            self.offset.append(offset)
            self.place.append(place)

    def keep(self, at: int, first: int, last: int) -> None:
        self._add(at, last - first, first - at, -1)

    def fix(self, at: int, size: int, place: int) -> None:
        self._add(at, size, 0, place)

    def __getitem__(self, i: int) -> int:
        k = bisect_right(self.at, i) - 1
        return self.place[k] if self.place[k] >= 0 else self.before[i + self.offset[k]]


class Layer:
    """A text and, for each of its characters, the span of the document it came from.

    ``starts`` and ``ends`` are sequences, or one number each if all come from one blob.
    """

    def __init__(self, text, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return self.starts[start], self.ends[end - 1]

    def replaced(self, pattern: re.Pattern, decode) -> "Layer | None":
        """The whole layer with every match decoded; None if nothing changes."""
        blob = isinstance(self.starts, int)
        parts, last, length = [], 0, 0
        starts, ends = (self.starts, self.ends) if blob else (Moved(self.starts), Moved(self.ends))
        for match in pattern.finditer(self.text):
            plain = decode(match)
            if plain is None or plain == match.group():
                continue
            parts += [self.text[last : match.start()], plain]
            if not blob:
                for side, place in zip((starts, ends), self.origin(match.start(), match.end())):
                    side.keep(length, last, match.start())
                    side.fix(length + match.start() - last, len(plain), place)
            length += match.start() - last + len(plain)
            last = match.end()
        if not parts:
            return None
        parts.append(self.text[last:])
        if not blob:
            for side in (starts, ends):
                side.keep(length, last, len(self.text))
        return Layer("".join(parts), starts, ends)

    def unpacked(self) -> Iterator["Layer"]:
        """Layers for every base64 run, plain or compressed, over line breaks too."""
        done = []
        if "\n" in self.text:
            for match in WRAPPED.finditer(self.text):
                if match.end() - match.start() > SHORTEST:
                    pieces = [p.span() for p in PIECE.finditer(self.text, *match.span())]
                    # Lines of a blob are not blobs of their own.
                    if (yield from self._run(match.end(), pieces)):
                        done.append(match.span())
        done.append((len(self.text),) * 2)
        k = 0
        for match in BASE64.finditer(self.text):
            while done[k][1] <= match.start() and k + 1 < len(done):
                k += 1
            if match.start() < done[k][0]:
                yield from self._run(match.end(), [PIECE.match(self.text, match.start()).span()])

    def _run(self, end: int, pieces: list[tuple[int, int]]) -> Iterator["Layer"]:
        """Layers of one run; returns whether it holds nothing but text or one packed text.

        If it does not, text may start anywhere in it: it is decoded at all four alignments,
        and finds there come from the groups of four characters that hold them.
        """
        start = pieces[0][0]
        run = "".join(self.text[a:b] for a, b in pieces)
        clean = False
        for plain, is_text in _texts(run) if len(run) % 4 != 1 else ():
            clean = is_text
            # Most characters of a text with a few odd ones are printable.
            if is_text or sum(map(str.isprintable, plain)) >= READABLE * len(plain):
                yield Layer(plain, *self.origin(start, end))
        if clean:
            return True
        if len(pieces) == 1:
            places = range(*pieces[0])
        else:
            places = array("q", chain.from_iterable(range(*p) for p in pieces))
        marked = run if len(pieces) == 1 else "\n".join(self.text[a:b] for a, b in pieces)
        for match in PACKED.finditer(marked):
            at = match.start() - marked.count("\n", 0, match.start())
            for plain, _ in _texts(run[at:], packed=True):
                yield Layer(plain, *self.origin(places[at], end))
        for shift in range(4):
            # Secrets are ASCII, so any bytes may stand for one character each.
            data = _decoded(run[shift:]).decode("latin-1")
            if isinstance(self.starts, int):
                yield Layer(data, self.starts, self.ends)
            else:
                yield Layer(
                    data,
                    Quads(self.starts, places, shift, len(data)),
                    Quads(self.ends, places, shift + 3, len(data)),
                )
        return False

    def unwrapped(self) -> Iterator["Layer"]:
        if "%" in self.text and (layer := self.replaced(PERCENT, _percent)):
            yield layer
        if ("\\" in self.text or "&#" in self.text) and (layer := self.replaced(ESCAPE, _escape)):
            yield layer
        yield from self.unpacked()


class Quads(Sequence):
    """A bound of the group of four base64 characters that each decoded byte came from."""

    def __init__(self, bounds, places, shift, size):
        self.bounds, self.places, self.shift, self.size = bounds, places, shift, size

    def __len__(self):
        return self.size

    def __getitem__(self, at):
        if isinstance(at, slice):
            return [self[i] for i in range(*at.indices(self.size))]
        at += self.size if at < 0 else 0
        if not 0 <= at < self.size:
            raise IndexError(at)
        return self.bounds[self.places[min(self.shift + at // 3 * 4, len(self.places) - 1)]]


def _decoded(run: str) -> bytes:
    """The bytes of a base64 run without its padding; a single last character is left out."""
    run = run.translate(STANDARD)
    run = run[: len(run) - (len(run) % 4 == 1)]
    return base64.b64decode(run + "=" * (-len(run) % 4))


def _is_packed(data: bytes) -> bool:
    # Text may begin with the two bytes of a zlib header.
    if data[:64].isascii() and _text(data[:64])[1]:
        return False
    if data[:2] == b"\x1f\x8b":
        return True
    return data[:1] == b"\x78" and len(data) > 2 and (data[0] * 256 + data[1]) % 31 == 0


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """What comes out of zlib or gzip data, all members of it, up to a fault or its end."""
    unzip = zlib.decompressobj(wbits=47)
    for data in chunks:
        while data:
            try:
                plain = unzip.decompress(data, CHUNK)
            except zlib.error:
                return
            if plain:
                yield plain
            if unzip.eof:
                data = unzip.unused_data
                if data and not _is_packed(data):
                    return
                unzip = zlib.decompressobj(wbits=47)
            else:
                data = unzip.unconsumed_tail
    while plain := _tail(unzip):
        yield plain


def _tail(unzip) -> bytes:
    try:
        return b"" if unzip.eof else unzip.decompress(unzip.unconsumed_tail, CHUNK)
    except zlib.error:
        return b""


def _small(data: bytes) -> Iterator[bytes]:
    """Data in steps so small that a fault hides little of what comes before it."""
    return (data[i : i + STEP] for i in range(0, len(data), STEP))


def _unpacked(data: bytes) -> tuple[Iterator[bytes], bool]:
    """The data below all its compressed layers, in chunks, and whether there was one."""
    chunks, heads = iter([data]), set()
    while True:
        head = next(chunks, b"")
        while len(head) < HEAD and (more := next(chunks, b"")):
            head += more
        whole = chain([head], chunks)
        # Data that unpacks to itself has the same head again.
        if head[:HEAD] in heads or not _is_packed(head):
            return whole, bool(heads)
        probe = next(_inflated(_small(head)), b"")
        if not probe:
            return whole, bool(heads)
        heads.add(head[:HEAD])
        chunks = _inflated(step for part in whole for step in _small(part))


def _texts(run: str, packed: bool = False) -> Iterator[tuple[str, bool]]:
    """The texts in a base64 run and whether each is text throughout.

    With ``packed`` only those below a compressed layer. Long ones come in pieces.
    """
    chunks, was_packed = _unpacked(_decoded(run))
    if packed and not was_packed:
        return
    data = bytearray()
    for part in chunks:
        data += part
        if was_packed and len(data) >= MAX_UNPACKED:
            yield _text(data)[0], True
            data = data[-OVERLAP:]
    text, clean = _text(data)
    yield text, clean or was_packed


def _text(data: bytes | bytearray) -> tuple[str, bool]:
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace"), False
    return text, all(c.isprintable() or c.isspace() for c in text)


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans as (start, kind number, end), in that order, code points."""
    base = sorted((start, kind, end) for kind, start, end in scan(text))
    spans = set(base)
    work = deque()
    seen: set[tuple] = set()

    def add(layers):
        for layer in layers:
            place = layer.origin(0, len(layer.text)) if layer.text else ()
            # Equal text from the same place again is a cycle.
            if (mark := (hash(layer.text), len(layer.text), place)) not in seen:
                seen.add(mark)
                work.append(layer)

    add(Layer(text, range(len(text)), range(1, len(text) + 1)).unwrapped())
    while work:
        layer = work.popleft()
        for kind, start, end in scan(layer.text):
            start, end = layer.origin(start, end)
            spans.add((start, kind, end))
        add(layer.unwrapped())
    return base, sorted(spans)


def scan_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base_spans`` and ``spans``: arrays of (kind, start, end), by start, then kind.

    Whole texts are scanned, and every layer that unwraps from them: percent and Unicode
    escapes in place, base64 runs, and zlib or gzip data inside these. A find in a layer is
    mapped to the characters of the document that the layer came from. A null or empty text
    has none. Columns named like the two are replaced. Equal rows are scanned one by one.
    """

    def listed(spans):
        return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans]

    def compute(batch):
        found = [find(t) if t else ([], []) for t in batch.column(text).to_pylist()]
        return [pa.array([listed(side[i]) for side in found], ARROW_SPANS) for i in (0, 1)]

    return map_texts(docs, ADDED, compute)


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every stretch that spans cover replaced by ``[SECRET]``; null stays null."""
    state = "struct<at: bigint, out: array<string>>"
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(done, span):
        # Spans come by start; one that begins inside what is done only moves its end.
        gap = F.concat(F.substring(text, done.at + 1, span.start - done.at), F.lit(REDACTED))
        return F.struct(
            F.greatest(done.at, span.end).alias("at"),
            F.when(span.start >= done.at, F.concat(done.out, F.array(gap)))
            .otherwise(done.out)
            .alias("out"),
        ).cast(state)

    def finish(done):
        return F.concat(
            F.array_join(done.out, ""), F.substring(text, done.at + 1, F.length(text))
        )

    return F.when(F.size(spans) > 0, F.aggregate(spans, zero.cast(state), step, finish)).otherwise(text)


def span_texts(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    texts = F.transform(
        spans,
        lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s["end"].cast("string")),
    )
    return F.array_join(texts, ",")


@query("op8_secret_scan")
def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kinds = F.transform("base_spans", lambda s: s.kind)
    counts = [
        F.size(F.filter(kinds, lambda k: k == F.lit(kind))).cast("bigint").alias(f"n_{kind}")
        for kind in KINDS
    ]
    return scan_documents(docs).select(
        "doc_id",
        *counts,
        F.sha2(span_texts(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        span_texts(F.col("spans")).alias("spans"),
    )
