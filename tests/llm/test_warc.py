import io
import os
import struct

import pytest
import zstandard

from tallyhouse.llm import warc as op
from tallyhouse.plans.shared import new_folder
from tests.compare import compare, duck
from tests.llm import cases

SCHEMA = "page_id bigint, url string, html string"
ROWS = [
    (1, "https://a.example/ x\r\nInjected: 1", "<p>first</p>"),
    (2, None, "<p>first</p>"),
    (2, None, "<p>first</p>"),
    (3, "https://a.example/3", None),
    (4, "https://a.example/4", ""),
    (None, "https://a.example/n", "<p>first</p>"),
    (None, "https://a.example/n", "only null ids"),
    (None, "https://a.example/n", "only null ids"),
    (5, "https://ä.example/5", "straße \u0000 \r\n\r\nWARC/1.1\r\n\U0001f600"),
    (6, "", "long " * 400_000),
    (-7, "x", "<p>first</p>"),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, SCHEMA)


def written_and_read(spark, rows=ROWS, **options):
    archives = op.write_archives(pages(spark, rows), new_folder(spark, "warc-test"), **options)
    return archives, op.read_archives(archives).collect()


def frame(record, **options):
    return zstandard.ZstdCompressor(**options).compress(record)


def record(**changes):
    values = dict(row=1, page_id=7, url="u", payload=b"body", refers=None, date="2020-01-01T00:00:00Z")
    values |= changes
    return op.build_record(digest=op._digest(values["payload"]), **values)


def test_query_equals_its_twin(spark, medium):
    problems, n, _ = compare(spark, duck(medium), medium, op.op11_warc, op.OP11_SQL)
    assert not problems and n == cases.given(spark, medium, "pages").count()


def test_odd_rows_come_back(spark):
    _, rows = written_and_read(spark)
    assert len(rows) == len(ROWS) and not any(r.problem for r in rows)
    found = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in rows if r.payload_bytes == 12)
    assert found == [(-7, "revisit", 3 - 1), (0, "revisit", 2), (1, "revisit", 2), (2, "response", None), (2, "revisit", 2)]
    empty = {r.page_id: (r.record_type, r.refers_to) for r in rows if r.payload_bytes == 0}
    assert empty == {3: ("revisit", 4), 4: ("response", None)}
    nulls = [(r.record_type, r.refers_to) for r in rows if r.payload_bytes == 13]
    assert sorted(nulls) == [("response", None), ("revisit", None)]
    by_id = {r.page_id: r for r in rows if r.page_id in (1, 5, 6)}
    assert by_id[5].payload.decode() == ROWS[8][2] and by_id[6].payload_bytes == 2_000_000
    assert by_id[1].target_uri == "https://a.example/%20x%0D%0AInjected:%201"
    assert by_id[5].target_uri == "https://ä.example/5"
    assert len({r.record_id for r in rows}) == len(rows)


def test_small_payloads_stay_apart(spark):
    _, rows = written_and_read(spark, least_bytes=13)
    assert sum(r.record_type == "revisit" for r in rows) == 1


def test_empty_table_and_other_columns(spark):
    archives, rows = written_and_read(spark, [])
    assert rows == [] and archives.count() == 0
    more = pages(spark).selectExpr("*", "'x' as row", "'y' as payload", "1 as same", "2 as path")
    assert op.read_archives(op.write_archives(more, new_folder(spark, "warc-test"))).count() == len(ROWS)


def test_archives_hold_a_dictionary_and_a_frame_a_record(spark, medium):
    given = cases.given(spark, medium, "pages")
    archives = op.write_archives(given, new_folder(spark, "warc-test"))
    (path,) = [r.path for r in archives.collect()]
    data = open(path.removeprefix("file:"), "rb").read()
    magic, length = struct.unpack("<II", data[:8])
    assert magic == op.DICTIONARY_FRAME and data[8:12] == op.PACKED
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + length]))
    assert zstandard.get_frame_parameters(data[8 + length :]).dict_id == dictionary.dict_id() != 0
    assert len(list(op.frames(io.BytesIO(data)))) == given.count()
    texts = {r.page_id: r.html for r in given.collect()}
    read = op.read_archives(archives).where("record_type = 'response'").collect()
    assert all(r.payload.decode() == (texts[r.page_id] or "") for r in read)


def test_plain_packed_and_missing_dictionaries():
    records = [record(row=i, payload=f"body {i}".encode() * 9) for i in range(400)]
    dictionary = op.train(records)
    packed = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
    body = b"".join(frame(r, dict_data=dictionary) for r in records)
    for leading in (dictionary.as_bytes(), packed):
        head = struct.pack("<II", op.DICTIONARY_FRAME, len(leading)) + leading
        assert list(op.frames(io.BytesIO(head + body))) == records
    assert list(op.frames(io.BytesIO(b"".join(map(frame, records))))) == records
    with pytest.raises(op.BadRecord):
        list(op.frames(io.BytesIO(body)))
    assert op.train([b"x"]) is None


@pytest.mark.parametrize(
    "bad",
    [
        record()[:-1],
        record() + b"x",
        record().replace(b"body", b"badly"),
        record().replace(b"body", b"bode"),
        record().replace(b"WARC/1.1", b"WARC/9.1"),
        record().replace(b"WARC-Date", b"WARC-Nope"),
        record().replace(b"Content-Length: ", b"Content-Length: x", 1),
        record().replace(b"Content-Length: ", b"Content-Length: -", 1),
        record(refers=(2, 8)).replace(b"WARC-Refers-To:", b"WARC-Other:"),
        b"",
        b"nothing of the kind",
    ],
)
def test_bad_records_are_refused(bad):
    with pytest.raises(op.BadRecord):
        op.parse_record(bad)


def test_problems_are_reported(spark, tmp_path):
    path = os.path.join(tmp_path, "some.warc.zst")
    with open(path, "wb") as out:
        out.write(frame(record()) + frame(b"junk") + frame(record(row=2)) + frame(record(row=3))[:-6])
    paths = spark.createDataFrame([(path,), (None,)], "path string")
    rows = op.read_archives(paths, report=True).collect()
    assert [r.problem is None for r in rows] == [True, False, True, False]
    with pytest.raises(Exception, match="header has no end"):
        op.read_archives(paths).collect()
