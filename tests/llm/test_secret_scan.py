import base64
import gzip
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import secret_scan as op
from tests.llm import cases

PATTERN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    spans = []
    for m in re.finditer(PATTERN, text, re.I | re.A):
        if len(m.group(2)) >= 6:
            spans.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        spans += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return sorted(spans)


KEY = "AKIA" + "Q7" * 8
PLAIN = [
    'password = "hunter22"', "PassWD:abc", "token=token=abcdef12", "secret:token: abcdefgh", "password: a token: abcdef",
    "éé api_key='abcdef' apikey : zyxwvu", KEY + "AKIA" + "B" * 20, "AKIAAKIA" + "C" * 12, "ab" * 12, "ab" * 11 + "a",
    "x" + "0" * 60 + "G", "toKen=abcdef12", "ſecret=abcdef12", "secret" + " " * 50 + "=" + " " * 50 + "abcdef",
]


@pytest.mark.parametrize("text", PLAIN)
def test_base_spans(text):
    base, spans = op.find(text)
    assert base == brute(text) and set(base) <= set(spans)


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode().rstrip("=")


SECRET = "password=hunter2222"
LAYERS = {
    "percent": "".join(f"%{b:02X}" for b in SECRET.encode()),
    "twice": "".join(f"%25{b:02X}" for b in SECRET.encode()),
    "unicode": "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "entity": "".join(f"&#{ord(c)};" for c in SECRET),
    "base64": b64(SECRET + " and more"),
    "base64 in base64": b64(b64(SECRET + " and more")),
    "zlib": b64(zlib.compress(SECRET.encode())),
    "gzip in zlib": b64(zlib.compress(gzip.compress(SECRET.encode() * 3))),
    "percent in base64": b64("".join(f"%{b:02X}" for b in SECRET.encode())),
}


@pytest.mark.parametrize("name", LAYERS)
def test_layers_map_back(name):
    before, after = "über ", " after"
    base, spans = op.find(before + LAYERS[name] + after)
    assert base == []
    assert (len(before), 0, len(before) + len(LAYERS[name])) in spans


def test_partly_encoded_value():
    text = "see token%3Dabc%64ef99 there"
    assert op.find(text) == ([], [(4, 0, 22)])


def test_layers_end():
    assert op.find("%25" * 500 + "41")[0] == []
    assert op.find("%zz \\u12 &#99999999; " + "A" * 4001) == ([], [])
    nested = SECRET + " tail"
    for _ in range(8):
        nested = b64(nested)
    assert op.find(nested)[1] == [(0, 0, len(nested))]


@pytest.mark.parametrize("extra", [False, True])
def test_table(spark, extra):
    texts = [t for _, t, _, _ in cases.TEXTS] + PLAIN + list(LAYERS.values())
    docs = cases.documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts + texts[:1])], extra)
    rows = op.scan_documents(docs).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        expected = [(op.KINDS[k], s, e) for s, k, e in brute(r.text or "")]
        assert [tuple(s) for s in r.base_spans] == expected
        assert {tuple(s) for s in r.base_spans} <= {tuple(s) for s in r.spans}
    assert op.scan_documents(cases.empty(spark)).count() == 0


def test_redaction(spark):
    texts = ["a password=hunter22 b", "ü" + "ab" * 12 + " " + KEY, "nothing", None, "secret=" + "0a" * 20 + "!"]
    docs = cases.documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    out = op.scan_documents(docs).select("doc_id", op.redact(F.col("text"), F.col("spans")).alias("t"))
    assert [r.t for r in out.orderBy("doc_id").collect()] == [
        "a [SECRET] b", "ü[SECRET] [SECRET]", "nothing", None, "[SECRET]!",
    ]


@pytest.mark.parametrize("secret", ["token=abc123", "secret=abc123", "api_key=abc123"])
def test_shortest_secrets_in_base64(secret):
    blob = base64.b64encode(secret.encode()).decode()
    assert op.find("x " + blob + " y")[1] == [(2, 0, 2 + len(blob))]


LINES = "".join(f"line {i} of {i * i}, " for i in range(30)) + SECRET + " end"


@pytest.mark.parametrize("blob", [LINES.encode(), zlib.compress(LINES.encode()), gzip.compress(LINES.encode())])
@pytest.mark.parametrize("width", [64, 76])
@pytest.mark.parametrize("before", ["", "Content\n"])
def test_wrapped_base64(blob, width, before):
    plain = base64.b64encode(blob).decode()
    lines = "\n".join(plain[i : i + width] for i in range(0, len(plain), width))
    spans = op.find(before + lines + "\n")[1]
    assert spans and {k for _, k, _ in spans} == {0}
    if not before:
        assert spans == [(0, 0, len(lines))]


@pytest.mark.parametrize("path", ["https://x.io/cb/", "a_", "ab-", "abc/d/"])
@pytest.mark.parametrize("blob", [SECRET.encode() + b" and more", zlib.compress(SECRET.encode())])
def test_glued_base64(path, blob):
    text = path + b64(blob)
    spans = op.find(text + " " + text)[1]
    assert len(spans) == 2 and spans[0][0] >= len(path) - 3 and spans[1][0] > len(text)


ODD = {
    "mark": ("\ufeffA=1\n" + SECRET).encode(),
    "zero width": f"some\u200b text, {SECRET}".encode(),
    "nul": b"a line\0another line " + SECRET.encode(),
    "ansi": b"\x1b[31mred\x1b[0m " + SECRET.encode(),
    "latin-1": "caf\xe9 au lait, ".encode("latin-1") + SECRET.encode(),
    "binary": bytes(range(256)) + SECRET.encode() + bytes(range(256)),
    "zlib of latin-1": zlib.compress("caf\xe9 ".encode("latin-1") + SECRET.encode()),
    "two members": gzip.compress(b"first") + gzip.compress(SECRET.encode()),
    "truncated": gzip.compress((SECRET + " " + "".join(f"{i * i} " for i in range(500))).encode())[:-40],
}


@pytest.mark.parametrize("name", ODD)
def test_odd_bytes_hide_nothing(name):
    text = "x " + base64.b64encode(ODD[name]).decode() + " y"
    spans = op.find(text)[1]
    assert spans and all(k == 0 and 2 <= s < e <= len(text) - 2 for s, k, e in spans)


def test_percent_text_that_is_not_utf8():
    text = "".join(f"%{b:02X}" for b in b"caf\xe9 " + SECRET.encode())
    assert op.find(text)[1] == [(0, 0, len(text))]


def test_large_unpacked_data():
    filler = b"all is well " * (op.MAX_UNPACKED // 8)
    for data in (SECRET.encode() + b" " + filler, filler + SECRET.encode()):
        blob = b64(zlib.compress(data))
        assert (0, 0, len(blob)) in op.find(blob)[1]


def test_text_that_begins_like_packed_data():
    blob = b64("x^2 and x, " + SECRET)
    assert op.find(blob)[1] == [(0, 0, len(blob))]


def test_memory_of_a_long_text_with_one_escape():
    """Places are kept by segment: a long text costs no number for each of its characters."""
    import tracemalloc

    text = "plain words here " * 1_000_000 + "%74%6F%6B%65%6E=abc123def " + "and more " * 100_000
    tracemalloc.start()
    spans = op.find(text)[1]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans
    assert peak < 10 * len(text)


def test_places_of_layers_within_layers():
    moved = op.Moved(range(10))
    moved.keep(0, 0, 4)
    moved.fix(4, 3, 4)
    moved.keep(7, 8, 10)
    again = op.Moved(moved)
    again.keep(0, 2, 6)
    again.fix(4, 0, 5)
    again.fix(4, 1, moved[6])
    again.keep(5, 7, 9)
    assert [moved[i] for i in range(9)] == [0, 1, 2, 3, 4, 4, 4, 8, 9]
    assert [again[i] for i in range(7)] == [2, 3, 4, 4, 4, 8, 9]
