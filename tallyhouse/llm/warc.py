"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Archives are written by tasks into the shared folder and read back from there. A task that is run
again writes files of its own, and only the files that a finished task reports are ever read.
"""

import base64
import hashlib
import posixpath
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.batches import slices
from tallyhouse.llm.registry import query, table
from tallyhouse.plans.lookups import join_lookup, stored_lookup
from tallyhouse.plans.shared import new_folder, written

# Fixed values of the format: magic numbers of the dictionary's frame and of a packed dictionary.
DICTIONARY_FRAME = 0x184D2A5D
PACKED = b"\x28\xb5\x2f\xfd"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = re.compile(rb"WARC/1\.[01]\Z")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
END = b"\r\n\r\n"

# An archive is closed after so many bytes of records, and begins another.
ARCHIVE_BYTES = 256 << 20
# The dictionary of an archive is trained on its own first records, up to so many bytes of them.
SAMPLE_BYTES = 512 << 10
SAMPLE_OF_RECORD = 16 << 10
DICTIONARY_BYTES = 16 << 10
LEVEL = 3
READ_BYTES = 16 << 10
MAX_READERS = 10_000

ARCHIVES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("bytes", T.LongType()),
    ]
)
RECORDS = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("problem", T.StringType()),
    ]
)
OUT_BYTES = 4 << 20


class BadRecord(ValueError):
    """A record or archive that breaks the format."""


def _digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(row: int, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{row}')}>"


def _line(text: str) -> str:
    """A header value: blanks and control characters are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def build_record(
    row: int,
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    refers: tuple[int, int | None] | None,
    date: str,
) -> bytes:
    """One record. ``refers`` names the row and page of the response that has the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers else "response"),
        ("WARC-Record-ID", _record_id(row, page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{_digest(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _line(url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if refers:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(*refers))]
        if refers[1] is not None:
            fields.append(("Refers-To-Page-ID", str(refers[1])))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode("utf-8", "surrogatepass") + block + END


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise BadRecord("a header line has no name")
        found[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return found


def _number(fields: dict[str, str], name: str, what: str) -> int | None:
    value = fields.get(name)
    if value is None:
        return None
    if not re.fullmatch(r"-?[0-9]{1,19}", value):
        raise BadRecord(f"{what} is not a number")
    return int(value)


def parse_record(record: bytes) -> tuple:
    """The values of ``RECORDS`` but the last, once header, lengths and digests are right."""
    head, blank, rest = record.partition(END)
    if not blank:
        raise BadRecord("the header has no end")
    first, *lines = head.split(b"\r\n")
    if not VERSION.match(first):
        raise BadRecord("the record does not begin with a known version")
    fields = _fields(lines)
    missing = [name for name in REQUIRED if name not in fields]
    if missing:
        raise BadRecord(f"missing {', '.join(missing)}")
    length = _number(fields, "content-length", "the length")
    block, tail = rest[: max(length, 0)], rest[max(length, 0) :]
    if length < 0 or len(block) != length or tail != END:
        raise BadRecord("the block is not as long as the header says")
    stated = fields.get("warc-block-digest")
    if stated is not None and stated != f"sha1:{_digest(block)}":
        raise BadRecord("the block's digest differs")
    kind = fields["warc-type"]
    payload = size = None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind in ("response", "revisit"):
        http, blank, body = block.partition(END)
        if not blank or not http.startswith(b"HTTP/"):
            raise BadRecord("the block holds no HTTP header")
        size = _number(_fields(http.split(b"\r\n")[1:]), "content-length", "the payload's length")
        if kind == "response":
            payload = body
            if size is not None and size != len(body):
                raise BadRecord("the payload is not as long as its header says")
            actual, size = _digest(body), len(body)
            if digest is not None and digest != actual:
                raise BadRecord("the payload's digest differs")
            digest = actual
        elif body or "warc-refers-to" not in fields:
            raise BadRecord("a revisit has a payload or refers to nothing")
    return (
        kind,
        fields["warc-record-id"],
        fields.get("warc-target-uri"),
        _number(fields, "page-id", "the page"),
        size,
        digest,
        _number(fields, "refers-to-page-id", "the page referred to"),
        payload,
    )


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary for records like these; None if they are too few or too short for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=200, d=8)
    except zstandard.ZstdError:
        return None


def frames(stream: BinaryIO) -> Iterator[bytes]:
    """The records of an archive, each from one whole frame, with memory for one of them.

    The leading skippable frame, where there is one, gives the dictionary, packed or plain.
    """
    start = stream.read(8)
    dictionary = None
    if len(start) == 8 and struct.unpack("<I", start[:4])[0] == DICTIONARY_FRAME:
        length = struct.unpack("<I", start[4:])[0]
        data = stream.read(length)
        if len(data) != length:
            raise BadRecord("the dictionary's frame is cut")
        if data[:4] == PACKED:
            data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
        dictionary = zstandard.ZstdCompressionDict(data)
        start = b""
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    pending = start
    while pending or (pending := stream.read(READ_BYTES)):
        frame, parts = reader.decompressobj(), []
        while True:
            try:
                parts.append(frame.decompress(pending))
            except zstandard.ZstdError as error:
                raise BadRecord(f"a frame cannot be decoded: {error}") from error
            if frame.eof:
                pending = frame.unused_data
                break
            pending = stream.read(READ_BYTES)
            if not pending:
                raise BadRecord("the last frame is cut")
        record = b"".join(parts)
        if record:
            yield record


class _Archive:
    """An archive being written: held back until its dictionary is trained."""

    def __init__(self, path: str):
        self.path, self.waiting, self.records, self.size, self.out = path, [], 0, 0, None
        self.files, self.name = fs.FileSystem.from_uri(path)

    def add(self, record: bytes) -> None:
        self.records += 1
        self.size += len(record)
        if self.out is not None:
            self.out.write(self.packer.compress(record))
            return
        self.waiting.append(record)
        if self.size >= SAMPLE_BYTES:
            self._open()

    def _open(self) -> None:
        dictionary = train([r[:SAMPLE_OF_RECORD] for r in self.waiting])
        self.files.create_dir(posixpath.dirname(self.name), recursive=True)
        self.out = self.files.open_output_stream(self.name, compression=None)
        if dictionary is not None:
            data = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(data)) + data)
        self.packer = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True
        )
        for record in self.waiting:
            self.out.write(self.packer.compress(record))
        self.waiting = []

    def close(self) -> tuple[str, int, int]:
        if self.out is None:
            self._open()
        self.out.close()
        return self.path, self.records, self.size


def staged(pages: DataFrame, key: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """The pages written once, with a number for each row and the digests of each payload.

    A null text is an empty payload. Other columns are left out.
    """
    payload = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
    )
    return written(
        rows.withColumns(
            {"sha1": F.unhex(F.sha1("payload")), "same": F.unhex(F.sha2("payload", 256))}
        ),
        "warc-pages",
    )


def responses(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """For payloads that several rows have: (same, response_row, response_page).

    The response is the row with the largest page id; a null id comes last, and of rows that
    repeat an id the one with the larger number. Payloads below ``least_bytes`` stay apart.
    """
    row = F.struct("page_id", "row")
    return (
        rows.where(F.length("payload") >= least_bytes)
        .groupBy("same")
        .agg(F.count(F.lit(1)).alias("n"), F.max(row).alias("last"))
        .where("n > 1")
        .select(
            "same",
            F.col("last.row").alias("response_row"),
            F.col("last.page_id").alias("response_page"),
        )
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    text: str = "html",
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record for every row into archives below ``folder``: (path, records, bytes) of each.

    Of rows with equal payloads one is a response, the others are revisits of it without a
    payload (see ``responses``). Nulls in any column, repeated rows and empty tables pass; an
    empty table gives no archive. ``folder`` must be one that Arrow can write to (a shared path,
    HDFS, S3, ...). The archives stay until the caller removes the folder.
    """
    rows = staged(pages, key, url, text)
    repeated = stored_lookup(written(responses(rows, least_bytes), "warc-responses"))
    tagged = join_lookup(rows, repeated, ["same"], "left", spread_by=["row"]).select(
        "row",
        "page_id",
        "url",
        "payload",
        "sha1",
        F.when(F.col("row") != F.col("response_row"), F.col("response_row")).alias("response_row"),
        "response_page",
    )

    def run(batches):
        context = TaskContext.get()
        name = f"{folder.rstrip('/')}/part-{context.partitionId():05d}-{context.taskAttemptId()}"
        archive, closed = None, []
        for batch in slices(batches):
            for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
                number, page_id, page_url, payload, sha1, response, response_page = (
                    value.as_py() for value in row
                )
                if archive is None:
                    archive = _Archive(f"{name}-{len(closed):04d}.warc.zst")
                refers = None if response is None else (response, response_page)
                digest = base64.b32encode(sha1).decode()
                archive.add(build_record(number, page_id, page_url, payload, digest, refers, date))
                if archive.size >= ARCHIVE_BYTES:
                    closed.append(archive.close())
                    archive = None
        if archive is not None:
            closed.append(archive.close())
        columns = zip(*closed) if closed else ([], [], [])
        types = (pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)], names=ARCHIVES.names
        )

    return written(tagged.mapInArrow(run, ARCHIVES), "warc-archives")


def read_archives(
    archives: DataFrame, payloads: bool = True, report: bool = False, path: str = "path"
) -> DataFrame:
    """Every record of the archives, as ``RECORDS``; one archive is the work of one task.

    Header, lengths and digests of each record are checked. A bad record raises, or with
    ``report`` gives a row with its ``problem`` and nulls; a frame that cannot be decoded ends its
    archive there. ``payloads=False`` leaves payloads null. A path that repeats is read as often;
    null paths and empty tables give nothing.
    """
    paths = archives.select(path).where(F.col(path).isNotNull())
    readers = max(1, min(paths.count(), MAX_READERS))
    columns = [(f.name, t) for f, t in zip(RECORDS.fields, (
        pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
        pa.binary(), pa.string(),
    ))]

    def parsed(name):
        files, inner = fs.FileSystem.from_uri(name)
        with files.open_input_stream(inner, compression=None) as stream:
            try:
                for record in frames(stream):
                    try:
                        yield (*parse_record(record), None)
                    except BadRecord as bad:
                        if not report:
                            raise
                        yield (*[None] * 8, str(bad))
            except BadRecord as bad:
                if not report:
                    raise BadRecord(f"{name}: {bad}") from bad
                yield (*[None] * 8, str(bad))

    def batch_of(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), columns)],
            names=[n for n, _ in columns],
        )

    def run(batches):
        rows, size = [], 0
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for row in parsed(name):
                    if not payloads:
                        row = (*row[:7], None, row[8])
                    rows.append(row)
                    size += 200 + len(row[7] or b"")
                    if size >= OUT_BYTES:
                        yield batch_of(rows)
                        rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return paths.repartition(readers).mapInArrow(run, RECORDS)


# The digest in base 32: five hex digits of SHA-1 are four characters.
OP11_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h,
             row_number() OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS place,
             first_value(page_id) OVER (PARTITION BY payload ORDER BY page_id DESC NULLS LAST) AS response
      FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (((('0x' || substr(h, (i // 4 * 5 + 1)::INTEGER, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1)::INTEGER, 1)),
         '') AS payload_digest,
       CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN place > 1 THEN response END AS refers_to
FROM d
"""


@query("op11_warc", OP11_SQL)
def op11_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = write_archives(table(spark, folder, "pages"), new_folder(spark, "warc"))
    return read_archives(archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
