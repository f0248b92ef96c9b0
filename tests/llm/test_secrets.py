"""Secret scans against plain patterns on every text, and against layers wrapped by hand."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import time
import urllib.parse
import zlib

import pytest
import zstandard

from llm import secrets
from llm.common import given
from tests.llm.conftest import prose, tricky_rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KINDS = ["assign", "access", "hex"]


def plain(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def written(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_equals_plain_patterns(spark, small_folder, tricky, nothing):
    odd = ["PassWord = 'abcdef", "api_key:abcde", "apikey : \"abc.def==\" token=abcdefſecret=abcdef", "toKen=aaaaaaa", "AKIAAKIA" + "Q" * 15, "AKIA1234",
           "é" * 5 + "secret=" + "x" * 9, "g" + "0f" * 12 + "g" + "0f" * 11 + "g", "token==abcdef", "passwordpassword=abcdef", "token: token: abcdefgh"]
    docs = given(spark, small_folder, "documents").select("doc_id", "text").unionByName(tricky.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = secrets.scan_secrets(docs).collect()
    want = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert len(got) == len(want)
    expected = sorted(((key, hashlib.sha256(written(spans).encode()).hexdigest(), *[sum(k == x for _, k, _ in spans) for x in range(3)])
                       for key, text in want for spans in [plain(text)]), key=repr)
    assert sorted(((r.doc_id, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in got), key=repr) == expected
    for r in got:
        assert r.n_refused == 0 and r.spans.count(":") == 2 * (r.n_assign + r.n_access + r.n_hex + r.n_decoded)
    assert secrets.scan_secrets(nothing).count() == 0


def escaped(text):
    return "".join(f"%{b:02X}" for b in text.encode())


def as_unicode(text):
    return "".join(f"\\u{ord(c):04x}" for c in text)


def b64(data):
    return base64.b64encode(data if isinstance(data, bytes) else data.encode()).decode()


WRAPS = {
    "url": escaped, "unicode": as_unicode, "hexadecimal": lambda t: "".join(f"\\x{b:02x}" for b in t.encode()),
    "entities": lambda t: "".join(f"&#{ord(c)};" for c in t), "base64": b64,
    "urlsafe": lambda t: base64.urlsafe_b64encode(t.encode()).decode().rstrip("="), "gzip": lambda t: b64(gzip.compress(t.encode())),
    "zlib": lambda t: b64(zlib.compress(t.encode())), "bz2": lambda t: b64(bz2.compress(t.encode())), "xz": lambda t: b64(lzma.compress(t.encode())),
    "zstd": lambda t: b64(zstandard.ZstdCompressor().compress(t.encode())), "raw": lambda t: "".join(f"%{b:02x}" for b in gzip.compress(t.encode())),
}


@pytest.mark.parametrize("outer", WRAPS)
def test_two_wraps_map_back_to_the_outer_one(outer):
    for inner, wrap in WRAPS.items():
        core = "x password=Hunter22/y z"
        coded = WRAPS[outer](wrap(core))
        text = f"ünd davor {coded} dahinter"
        got = secrets.scan_text(text.encode())
        at = text.index(coded)
        spans = [x.split(":") for x in got["spans"].split(",")]
        hits = [(int(a), int(b)) for k, a, b in spans if k == "assign"]
        assert hits, (outer, inner)
        assert all(at <= a < b <= at + len(coded) for a, b in hits), (outer, inner, hits)


def test_spans_are_the_letters_that_hold_the_secret():
    secret = "token=abcdefgh"
    for lead in range(5):
        inner = "#" * lead + secret + "!!"
        text = "é " + escaped(inner)
        got = secrets.scan_text(text.encode())
        assert got["spans"] == f"assign:{2 + 3 * lead}:{2 + 3 * (lead + len(secret))}"
        text = "é " + b64(inner)
        start = 2 + lead // 3 * 4 + lead % 3
        last = lead + len(secret) - 1
        assert got["n_assign"] == 0 and secrets.scan_text(text.encode())["spans"] == f"assign:{start}:{2 + last // 3 * 4 + last % 3 + 2}"


def test_deep_nesting_in_any_order():
    rng = random.Random(3)
    names = [n for n in WRAPS if n not in ("raw", "hexadecimal", "entities", "unicode", "url")]
    for _ in range(20):
        text = "AKIA" + "ABCDEFGH12345678" + " "
        for _ in range(rng.randint(3, 6)):
            text = WRAPS[rng.choice(names)](text)
        got = secrets.scan_text(("<" + text + ">").encode())
        assert "access:" in got["spans"] and got["deepest"] >= 3


def test_cycles_bombs_and_long_texts_end(monkeypatch):
    start = time.time()
    assert secrets.scan_text(b"%25" * 3000)["n_layers"] == 1
    assert secrets.scan_text(b"%2525252525")["deepest"] == 5
    for text in (b"A" * 2_000_000, b"\\u0041" * 200_000, b"%41" * 400_000, prose(1, 200_000).encode(), b" " * 3_000_000, b"ab" * 1_000_000):
        secrets.scan_text(text)
    monkeypatch.setattr(secrets, "LAYER_BYTES", 1 << 20)
    for pack in (gzip.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress):
        bomb = b64(pack(b"token=abcdefgh " + b"0" * 60_000_000))
        got = secrets.scan_text(bomb.encode())
        assert got["n_refused"] >= 1 and "assign" in got["spans"]
    assert time.time() - start < 120


def test_same_blob_in_two_places_is_found_twice():
    blob = b64("secret=abcdefgh!")
    got = secrets.scan_text(f"{blob} and {blob}".encode())
    assert got["spans"].count("assign") == 2


def test_prose_stays_clean():
    assert all(secrets.scan_text((r[1] or "").encode())["n_decoded"] == 0 for r in tricky_rows())
