"""Secret scans: a worklist that unwraps nested encodings until nothing new appears, and scans every layer.

A text is the first layer. Each layer is searched with the base patterns; then its encodings are undone: all URL escapes
at once, all Unicode escapes at once, every run of base64 letters (both alphabets, at each of its four alignments), and
every stream that begins with the mark of a compressed format. What comes out is the next layer, unless the same bytes
were already seen for the same stretch of the text; this ends cycles, such as a stream that decompresses to itself. A
layer keeps how its bytes came about, so that what is found in it maps back, layer by layer, to code points of the text.

Decompression stops once a text's layers have taken ``LAYER_BYTES`` and sixty-four times its own length, a guard against
streams built to exhaust memory; ``n_refused`` counts the streams cut by it, and what was unwrapped until then is scanned.

Edge cases: a null or empty text has no spans; equal rows are judged alike; an empty table gives an empty result; other
columns of the input are not read; null keys stay null. Rows are independent, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import as_bytes, map_arrow

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
#: Whole runs of at least 24 digits; a shorter run fails and none begins inside a run.
_LONG_HEX = re.compile(rb"(?<![0-9a-f])[0-9a-f]{24,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

_URL = re.compile(rb"%([0-9A-Fa-f]{2})")
_UNICODE = re.compile(
    rb"(?:\\u[dD][89abAB][0-9A-Fa-f]{2}\\u[dD][c-fC-F][0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})|\\u\{([0-9A-Fa-f]{1,6})\}|\\U([0-9A-Fa-f]{8})"
    rb"|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});")
#: A secret in base64 takes at least sixteen letters.
_BASE64 = (re.compile(rb"[A-Za-z0-9+/]{16,}={0,2}"), re.compile(rb"[A-Za-z0-9_-]{16,}={0,2}"))
_STREAM = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|BZh[1-9]1AY&SY|\xfd7zXZ\x00|x[\x01\x5e\x9c\xda]")
#: Bytes that all decompressed layers of a text may take, besides 64 times its length.
LAYER_BYTES = 64 << 20
_CHUNK = 1 << 20

Back = Callable[[int, int], tuple[int, int]]
Span = tuple[int, int, int]  # start, kind, end


def scan(layer: bytes) -> Iterator[Span]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    for m in _ASSIGN.finditer(layer):
        if m.end(1) - m.start(1) >= LEAST["assign"]:
            yield m.start(), 0, m.end()
    for m in _ACCESS.finditer(layer):
        if m.end() - m.start() >= LEAST["access"]:
            yield m.start(), 1, m.end()
    for m in _LONG_HEX.finditer(layer):
        yield m.start(), 2, m.end()


def _unescaped(layer: bytes, pattern: re.Pattern[bytes], value: Callable[[re.Match[bytes]], bytes | None]) -> tuple[bytes, Back] | None:
    """The layer with all escapes undone, and the way back to it; None without escapes."""
    pieces: list[bytes] = []
    # For each escape: where its value begins and ends in the new layer, where it stood in the old one.
    places: list[tuple[int, int, int, int]] = []
    at = size = 0
    for m in pattern.finditer(layer):
        new = value(m)
        if new is None:
            continue
        pieces += [layer[at:m.start()], new]
        size += m.start() - at
        places.append((size, size + len(new), m.start(), m.end()))
        size += len(new)
        at = m.end()
    if not places:
        return None
    pieces.append(layer[at:])
    out_from, out_to, in_from, in_to = np.array(places, dtype=np.int64).T

    def source(x: int) -> tuple[int, int]:
        """The old bytes from which byte ``x`` came."""
        i = int(np.searchsorted(out_from, x, side="right")) - 1
        if i < 0:
            return x, x + 1
        if x < out_to[i]:
            return int(in_from[i]), int(in_to[i])
        old = int(in_to[i] + x - out_to[i])
        return old, old + 1

    return b"".join(pieces), lambda a, b: (source(a)[0], source(b - 1)[1])


def _code_point(m: re.Match[bytes]) -> bytes | None:
    if not m.lastindex:  # a pair of surrogates
        return m[0].decode("ascii").encode("ascii").decode("unicode_escape").encode("utf-16", "surrogatepass").decode("utf-16").encode()
    if m.lastindex == 4:
        return bytes([int(m[4], 16)])
    number = int(m[m.lastindex], 10 if m.lastindex == 5 else 16)
    return chr(number).encode() if number < 0x110000 and not 0xD800 <= number < 0xE000 else None


def _base64_layers(layer: bytes) -> Iterator[tuple[bytes, Back]]:
    for urlsafe, pattern in enumerate(_BASE64):
        for m in pattern.finditer(layer):
            run = m[0].rstrip(b"=")
            for skip in range(4):
                letters = run[skip:]
                letters = letters[:len(letters) - (len(letters) % 4 == 1)]
                if len(letters) < 16:
                    continue
                padded = letters + b"=" * (-len(letters) % 4)
                start, stop = m.start() + skip, m.end()
                new = base64.b64decode(padded, altchars=b"-_" if urlsafe else None)

                def back(a: int, b: int, start: int = start, stop: int = stop, size: int = len(new)) -> tuple[int, int]:
                    # Three bytes come from four letters; a find that takes the last byte takes the padding along.
                    end = stop if b == size else start + (b - 1) // 3 * 4 + (b - 1) % 3 + 2
                    return start + a // 3 * 4 + a % 3, end

                yield new, back


def _pieces(data: bytes) -> Iterator[tuple[bytes, int]]:
    """A stream's content in bounded pieces, each with the number of bytes taken so far."""
    if data.startswith(b"\x28\xb5\x2f\xfd"):
        reader = zstandard.ZstdDecompressor().stream_reader(data)
        while new := reader.read(_CHUNK):
            yield new, len(data)
    elif data.startswith((b"BZh", b"\xfd7zXZ")):
        tool = bz2.BZ2Decompressor() if data.startswith(b"BZh") else lzma.LZMADecompressor(memlimit=256 << 20)
        new = tool.decompress(data, _CHUNK)
        while new:
            yield new, len(data) - len(tool.unused_data)
            new = b"" if tool.eof else tool.decompress(b"", _CHUNK)
    else:
        tool = zlib.decompressobj(wbits=47)
        rest = data
        while not tool.eof:
            new, rest = tool.decompress(rest, _CHUNK), tool.unconsumed_tail
            if not new:
                break
            yield new, len(data) - len(rest) - len(tool.unused_data)


def _inflate(data: bytes, room: int) -> tuple[bytes, int, bool]:
    """What a stream holds, how many bytes it takes, and whether it was cut beyond ``room``; a damaged end is left out."""
    out: list[bytes] = []
    taken = 0
    try:
        for new, taken in _pieces(data):
            out.append(new)
            room -= len(new)
            if room < 0:
                return b"".join(out), taken, True
    except (zlib.error, OSError, ValueError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        pass
    return b"".join(out), taken, False


def unwrap(text: bytes) -> tuple[set[Span], int, int, int]:
    """Spans of all layers beyond the first in bytes of the text, and the numbers of layers, of the deepest and of cut streams."""
    found: set[Span] = set()
    whole = hashlib.blake2b(text, digest_size=16).digest()
    seen = {(whole, 0, len(text))}
    work: list[tuple[bytes, tuple[Back, ...], int]] = [(text, (), 0)]
    layers = deepest = refused = 0
    room = LAYER_BYTES + 64 * len(text)

    def origin(ways: tuple[Back, ...], a: int, b: int) -> tuple[int, int]:
        for way in reversed(ways):
            a, b = way(a, b)
        return a, b

    while work:
        layer, ways, depth = work.pop()
        if depth:
            layers += 1
            deepest = max(deepest, depth)
            for start, kind, end in scan(layer):
                a, b = origin(ways, start, end)
                found.add((a, kind, b))
        new: list[tuple[bytes, Back]] = []
        if b"%" in layer and (undone := _unescaped(layer, _URL, lambda m: bytes([int(m[1], 16)]))):
            new.append(undone)
        if (b"\\" in layer or b"&#" in layer) and (undone := _unescaped(layer, _UNICODE, _code_point)):
            new.append(undone)
        new += _base64_layers(layer)
        if depth:
            for m in _STREAM.finditer(layer):
                inflated, taken, cut = _inflate(layer[m.start():], room)
                refused += cut
                room -= len(inflated)
                if inflated:
                    new.append((inflated, lambda a, b, s=m.start(), e=m.start() + taken: (s, e)))
        for data, way in new:
            if not data:
                continue
            a, b = origin((*ways, way), 0, len(data))
            mark = (hashlib.blake2b(data, digest_size=16).digest(), a, b)
            if mark not in seen:
                seen.add(mark)
                work.append((data, (*ways, way), depth + 1))
    return found, layers, deepest, refused


def _code_points(text: bytes, spans: list[Span]) -> list[Span]:
    """Byte offsets as code points; a span that ends inside a code point takes all of it."""
    if text.isascii() or not spans:
        return spans
    starts = np.cumsum((np.frombuffer(text, dtype=np.uint8) & 0xC0) != 0x80)
    return [(int(starts[a]) - 1, k, int(starts[b - 1])) for a, k, b in spans]


def _written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan_text(text: bytes) -> dict[str, object]:
    base = sorted(scan(text))
    found, layers, deepest, refused = unwrap(text)
    base_points = sorted(_code_points(text, base))
    all_points = sorted(set(base_points) | set(_code_points(text, sorted(found))))
    counts = [sum(k == kind for _, k, _ in base) for kind in range(3)]
    return {"n_assign": counts[0], "n_access": counts[1], "n_hex": counts[2],
            "base_sha256": hashlib.sha256(_written(base_points).encode()).hexdigest(), "spans": _written(all_points),
            "n_decoded": len(all_points) - len(base_points), "n_layers": layers, "deepest": deepest, "n_refused": refused}


FIELDS = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
          ("spans", pa.string()), ("n_decoded", pa.int64()), ("n_layers", pa.int64()), ("deepest", pa.int64()), ("n_refused", pa.int64())]


def scan_secrets(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` (a long), base matches by kind, the digest of the base spans, all spans, and what was unwrapped.

    Spans are ``kind:start:end`` in code points of the text, in the order of start and kind; those of decoded layers
    cover the encoded stretch that gave the match.
    """
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            found = [scan_text(raw) for raw in as_bytes(batch.column(1))]
            yield {"key": batch.column(0), **{name: [x[name] for x in found] for name, _ in FIELDS}}

    arrow = pa.schema([("key", pa.int64()), *FIELDS])
    schema = "key long, " + ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in FIELDS)
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return map_arrow(narrow, schema, arrow, rows).withColumnRenamed("key", key)
