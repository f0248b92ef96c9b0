"""Substring deduplication by content-defined chunking with a gear rolling hash.

A gear hash over the last bytes picks chunk borders among the starts of words, so borders depend on nearby content
only and an insertion shifts no border beyond itself. A *window* is a run of neighboring chunks that just holds
``min_words`` words, or ``CHARS_A_WORD`` times as many code points where words are long: the shortest such run from every chunk on, and up to every chunk. Windows are known by a 64-bit
digest; the first occurrence (by document, then place) of a window stays, later ones go unless they overlap it. So a
passage goes if it stood as such before, and common phrases that were seen apart stay.

Edge cases: a null or empty text has no chunks; null keys come first; rows equal in key and text count as one and are
treated alike; an empty table gives an empty result; the names of other columns do not matter. A run of characters
without space is cut after 64 bytes by the hash alone, so texts without spaces are chunked
as well, and their passages count by code points.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm import blocks
from llm.blocks import BLOCK, BODY, KEY
from llm.common import as_bytes

WINDOW = 16
#: Gear values: outputs of a linear congruential generator, 0 for the byte that separates texts.
GEAR = np.array([0, *list(accumulate(range(255), lambda x, _: (x * 1664525 + 1013904223) % 2**32, initial=12345))[1:]], dtype=np.uint32)
MEAN_WORDS = 4
#: Code points that stand for a word where few spaces are: more than a word and its space take on average.
CHARS_A_WORD = 8
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SLICE = 2_000_000
_BASE = np.uint64(6364136223846793005 | 1)
_INVERSE = np.uint64(pow(6364136223846793005, -1, 2**64))


class Chunks:
    """Chunks of several texts: text number, first byte, end, words, code points and digest, in order."""

    def __init__(self, texts: list[bytes]) -> None:
        parts: list[tuple[np.ndarray, ...]] = []
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= _SLICE):
                size += len(texts[last])
                last += 1
            parts.append(self._cut(texts[first:last], first))
            first = last
        names = ("text", "start", "end", "words", "chars", "digest")
        kinds = (np.int64, np.int64, np.int64, np.int64, np.int64, np.int64)
        for i, (name, kind) in enumerate(zip(names, kinds, strict=True)):
            setattr(self, name, np.concatenate([p[i] for p in parts]).astype(kind) if parts else np.zeros(0, kind))

    @staticmethod
    def _cut(texts: list[bytes], number: int) -> tuple[np.ndarray, ...]:
        gap = b"\0" * WINDOW
        joined = gap + gap.join(texts) + gap
        sizes = np.array([len(x) for x in texts], dtype=np.int64)
        begins = WINDOW + np.concatenate([[0], np.cumsum(sizes + WINDOW)[:-1]])
        b = np.frombuffer(joined, np.uint8)
        h = GEAR[b]
        for k in (1, 2, 4, 8):  # the hash of a window from those of its halves
            h[k:] = h[k:] + (h[:-k] << np.uint32(k))
        space = _SPACE[b]
        word = ~space & (b != 0)
        starts = np.flatnonzero(word[1:] & ~word[:-1]) + 1
        before = np.where(starts >= 2, starts - 2, 0)  # the hash of what ends before the space
        picked = starts[h[before] < np.uint32(2**32 // MEAN_WORDS)]
        run = np.arange(len(b)) - np.maximum.accumulate(np.where(word, -1, np.arange(len(b))))
        within = np.flatnonzero((run > 64) & (h < np.uint32(2**26)) & ((b & 0xC0) != 0x80))
        edges = np.unique(np.concatenate([picked, within, begins[sizes > 0]]))
        of = np.searchsorted(begins, edges, side="right") - 1
        ends = np.minimum(np.append(edges[1:], len(b)), begins[of] + sizes[of])
        words = np.searchsorted(starts, ends) - np.searchsorted(starts, edges)
        points = np.concatenate([[0], np.cumsum((b & 0xC0) != 0x80)])
        chars = points[ends] - points[edges]
        digest = xxhash.xxh3_64_intdigest
        digests = np.array([digest(joined[i:j].rstrip()) for i, j in zip(edges.tolist(), ends.tolist(), strict=True)], dtype=np.uint64)
        return of + number, edges - begins[of], ends - begins[of], words, chars, digests.view(np.int64)


def windows(found: Chunks, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First chunk, end (exclusive) and digest of every window, those that hold enough words or code points and no chunk too many at one end."""
    n = len(found.text)
    until = np.searchsorted(found.text, found.text, side="right")
    since = np.searchsorted(found.text, found.text, side="left")
    at = np.arange(n)
    end, begin = np.full(n, n + 1), np.full(n, -1)
    for sizes, least in ((found.words, min_words), (found.chars, CHARS_A_WORD * min_words)):
        held = np.concatenate([[0], np.cumsum(sizes)])
        end = np.minimum(end, np.searchsorted(held, held[:-1] + least, side="left"))
        begin = np.maximum(begin, np.searchsorted(held, held[1:] - least, side="right") - 1)
    on, back = end <= until, begin >= since
    both = np.unique(np.concatenate([at[on] * (n + 1) + end[on], begin[back] * (n + 1) + at[back] + 1]))
    first, end = both // (n + 1), both % (n + 1)
    # A polynomial in the chunks' digests: the odd base has an inverse, so a window's value does not depend on its place.
    powers = np.cumprod(np.full(n + 1, _BASE, dtype=np.uint64))
    inverse = np.cumprod(np.full(n + 1, _INVERSE, dtype=np.uint64))
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.digest.view(np.uint64) * powers[:n])])
    digest = (summed[end] - summed[first]) * inverse[first] + (end - first).astype(np.uint64) * _INVERSE
    return first, end, digest.view(np.int64)


def find_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None,
                 min_words: int = 20, block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """The columns of ``carry``, then ``n_chunks, n_seen_chunks, n_words, n_removed_words, removed, kept_text``.

    A seen chunk is one of a window that occurred before. ``removed`` are the spans in code points (``start:end``, comma-joined); ``kept_text`` is the rest.
    """
    carry = carry or {key: F.col(key)}
    carried = [f"__c{i}" for i in range(len(carry))]
    dealt = blocks.deal(docs, key=key, text=text, carry={f"__c{i}": c for i, c in enumerate(carry.values())}, block_bytes=block_bytes)

    def asked(table: pa.Table) -> pa.Table:
        found = Chunks(as_bytes(table[BODY]))
        first, _, digest = windows(found, min_words)
        start = found.start[first]
        doc = table[KEY].to_numpy()[found.text[first]] if len(first) else first
        order = np.lexsort((start, doc, digest))
        digest, doc, start = digest[order], doc[order], start[order]
        new = np.append(True, digest[1:] != digest[:-1]) if len(digest) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        # rows equal in key and text are one occurrence
        other = (~new) & np.append(False, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])) if len(digest) else new
        times = 1 + np.add.reduceat(other.astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
        block = np.full(len(at), table[BLOCK][0].as_py() if table.num_rows else 0, dtype=np.int32)
        return pa.table({BLOCK: block, "digest": digest[at], "doc": doc[at], "start": start[at], "n": times})

    questions = blocks.ask(dealt, asked, f"{BLOCK} int, digest long, doc long, start long, n long")
    same = Window.partitionBy("digest")
    answers = questions.withColumns({"first": F.min(F.struct("doc", "start")).over(same), "all": F.sum("n").over(same)}).where(
        F.col("all") > 1).select(BLOCK, "digest", F.col("first.doc").alias("doc"), F.col("first.start").alias("start"))

    def applied(texts: pa.Table, known: pa.Table) -> pa.Table:
        raw = as_bytes(texts[BODY])
        found = Chunks(raw)
        doc = texts[KEY].to_numpy()
        order = np.argsort(known["digest"].to_numpy(), kind="stable")
        digest = known["digest"].to_numpy()[order]
        first, end, own = windows(found, min_words)
        place = np.minimum(np.searchsorted(digest, own), max(0, len(digest) - 1))
        step = np.zeros(len(found.text) + 1, np.int64)
        if len(digest) and len(own):
            first_doc, first_start = known["doc"].to_numpy()[order][place], known["start"].to_numpy()[order][place]
            over = found.start[first] - first_start >= found.end[end - 1] - found.start[first]  # in one text the first ended before
            again = (digest[place] == own) & ((first_doc != doc[found.text[first]]) | over)
            np.add.at(step, first[again], 1)
            np.add.at(step, end[again], -1)
        seen = np.cumsum(step)[:-1] > 0
        border = np.searchsorted(found.text, np.arange(len(raw) + 1))
        out: dict[str, list[object]] = {n: [] for n in ("n_chunks", "n_seen_chunks", "n_words", "n_removed_words", "removed", "kept_text")}
        for i, body in enumerate(raw):
            lo, hi = int(border[i]), int(border[i + 1])
            old = seen[lo:hi]
            spans: list[tuple[int, int, int]] = []
            if old.any():
                step = np.diff(np.concatenate([[0], old.astype(np.int8), [0]]))
                for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True):
                    spans.append((int(found.start[lo + a]), int(found.end[lo + b - 1]), int(found.words[lo + a:lo + b].sum())))
            kept, told, at, chars = [], [], 0, 0
            for start, end, _ in spans:
                kept.append(body[at:start])
                chars += len(body[at:start].decode("utf-8", "replace"))
                size = len(body[start:end].decode("utf-8", "replace"))
                told.append(f"{chars}:{chars + size}")
                chars, at = chars + size, end
            kept.append(body[at:])
            for name, value in zip(out, (hi - lo, int(old.sum()), int(found.words[lo:hi].sum()), sum(s[2] for s in spans),
                                         ",".join(told), b"".join(kept).decode("utf-8", "replace")), strict=True):
                out[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.table({c: texts[c] for c in carried} | {n: pa.array(v, type=k) for (n, v), k in zip(out.items(), kinds, strict=True)})

    types = dict(dealt.dtypes)
    schema = ", ".join([*[f"{c} {types[c]}" for c in carried], "n_chunks long, n_seen_chunks long",
                        "n_words long, n_removed_words long", "removed string, kept_text string"])
    found = blocks.answer(dealt, answers, applied, schema)
    return found.withColumnsRenamed(dict(zip(carried, carry, strict=True)))


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 20) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; documents of which no word or part of one is left go, untouched ones stay."""
    columns = {f"__in_{i}": F.col(c) for i, c in enumerate(docs.columns)}
    done = find_repeats(docs, key=key, text=text, carry=columns, min_words=min_words)
    cut = F.col("removed") != ""
    out = [F.when(cut, F.col("kept_text")).otherwise(F.col(f"__in_{i}")).alias(c) if c == text else F.col(f"__in_{i}").alias(c)
           for i, c in enumerate(docs.columns)]
    return done.where(~cut | F.col("kept_text").rlike(r"[^\x20\x09-\x0D]")).select(*out)
