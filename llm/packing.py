"""Best-fit packing: pattern packing by non-negative least squares.

Texts become token ids, over-long documents are cut, and the histogram of piece lengths (at most ``max_len`` bins) is
all the plan needs. Patterns of up to three lengths that fill a sequence are enumerated, non-negative least squares
fits how often each is repeated, counts are rounded down, and the pieces left over are packed best-fit with
decreasing length. Pieces of one length are interchangeable: a rank within the length, found in two levels so that
a frequent length spreads over many tasks, takes each piece to its slot.

Edge cases: a null or empty text is the end token alone; a null key keeps its pieces; repeated rows are packed as
often as they occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import map_arrow, materialize, whole_text

SPECIAL = "<|endoftext|>"
_LONG_BLANK = re.compile(r"\s{50000}")


class Encoder:
    """Token ids of the byte-level vocabulary, as little-endian unsigned 32-bit bytes.

    The rank file holds the tokenizer's own vocabulary and is several times faster; only texts that hold a special
    token's string, or a run of blanks that its pattern search cannot take, go to the tokenizer itself.
    """

    def __init__(self, folder: str | None = None) -> None:
        import public_tokenizers
        import tiktoken

        self.path = (lambda name: f"{folder}/{name}") if folder else public_tokenizers.path
        with open(self.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def encode(self, text: str) -> bytes:
        if SPECIAL not in text and not _LONG_BLANK.search(text):
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4").tobytes()
        from tokenizers import Tokenizer

        self.slow = self.slow or Tokenizer.from_file(self.path("byte_bpe_50k.json"))
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(folder: str | None) -> Encoder:
    return Encoder(folder)


def pieces(docs: DataFrame, *, key: str = "doc_id", text: str = "text", max_len: int = 1024, end_id: int = 2,
           vocabulary: str | None = None) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``; the first piece of a cut document is the short one."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        code, end = encoder(vocabulary), np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            out: list[tuple[object, int, int, int, int]] = []
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = code.encode(words) + end
                total = len(ids) // 4
                cut, n = 0, 0
                while cut < total:
                    stop = cut + max_len if cut else (total - 1) % max_len + 1
                    out.append((doc, n, cut, stop - cut, zlib.crc32(ids[4 * cut: 4 * stop])))
                    cut, n = stop, n + 1
            yield dict(zip(("doc_id", "piece", "start", "length", "ids_crc32"), map(list, zip(*out, strict=True)), strict=True)) if out else {
                c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32")}

    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                       ("ids_crc32", pa.int64())])
    narrow = docs.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    return map_arrow(narrow, "doc_id long, piece int, start long, length long, ids_crc32 long", arrow, rows)


def patterns(size: int, present: np.ndarray) -> np.ndarray:
    """All (a <= b <= c) of present lengths with a + b + c = size, and the pairs and singles (padded with 0)."""
    has = np.zeros(size + 1, bool)
    has[present] = True
    has[0] = True
    lengths = np.flatnonzero(has)
    a, b = (x.ravel() for x in np.meshgrid(lengths, lengths, indexing="ij"))
    c = size - a - b
    good = (a <= b) & (b <= c)
    a, b, c = a[good], b[good], c[good]
    good = has[c] & (c > 0)
    return np.stack([a[good], b[good], c[good]], axis=1)


def fit_repeats(pattern: np.ndarray, histogram: np.ndarray, rounds: int = 400, importance: np.ndarray | None = None) -> np.ndarray:
    """Non-negative least squares of pattern counts against the histogram, by accelerated projected gradient.

    The matrix has at most three entries per column, so products are gathers and scatters. ``importance`` weights the
    lengths' residuals.
    """
    n = len(pattern)
    if not n:
        return np.zeros(0)
    bins = len(histogram)
    important = np.ones(bins) if importance is None else np.sqrt(importance)
    target = histogram * important
    weight = (pattern > 0) * important[pattern]
    apply = lambda x: np.bincount(pattern.ravel(), (weight * x[:, None]).ravel(), bins)
    back = lambda r: (weight * r[pattern]).sum(1)
    probe = np.ones(n)
    for _ in range(30):
        probe = back(apply(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    step = 1 / (norm * 1.02)
    x = y = np.zeros(n)
    momentum = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(apply(y) - target))
        later = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        y = new + (momentum - 1) / later * (new - x)
        if np.abs(new - x).sum() <= 1e-7 * max(1.0, target.sum()):
            x = new
            break
        x, momentum = new, later
    return x


def plan(histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as (lengths, repeats) that hold exactly the histogram's pieces; work bounded by ``size``.

    Residuals are fitted twice, alike for all lengths and weighted by length (short pieces fill gaps anyway), and parts
    of the fitted counts are tried; the plan of fewest sequences is taken.
    """
    full = [((size,), int(histogram[size]))] if histogram[size] else []
    rest = histogram.astype(np.int64).copy()
    rest[size] = 0
    table = patterns(size, np.flatnonzero(rest))
    found: list[list[tuple[tuple[int, ...], int]]] = []
    for importance in (None, np.arange(size + 1) / size):
        fitted = fit_repeats(table, rest, importance=importance)
        found += [rounded_plan(table, share * fitted, rest, size) for share in (1.0, 0.8, 0.5)]
    return full + min(found, key=lambda made: sum(n for _, n in made))


def rounded_plan(table: np.ndarray, fitted: np.ndarray, histogram: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Pattern counts rounded down and held to what is there, and the pieces left over packed best-fit."""
    left = histogram.copy()
    out: list[tuple[tuple[int, ...], int]] = []
    counts = np.floor(fitted + 1e-9).astype(np.int64)
    for i in np.argsort(-counts, kind="stable"):
        if not counts[i]:
            break
        lengths, needs = np.unique(table[i][table[i] > 0], return_counts=True)
        repeats = int(min(counts[i], (left[lengths] // needs).min()))
        if repeats:
            left[lengths] -= needs * repeats
            out.append((tuple(int(x) for x in table[i] if x), repeats))
    return out + best_fit(left, size)


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing over counts: equal bins move together, so the work follows distinct lengths, not pieces."""
    bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}  # room -> bins
    rooms: list[int] = []
    present = np.zeros(size + 1, bool)

    def put(lengths: tuple[int, ...], count: int) -> None:
        room = size - sum(lengths)
        if not present[room]:
            present[room] = True
        bins.setdefault(room, []).append((lengths, count))

    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            fits = np.flatnonzero(present[length:])
            if len(fits):
                room = length + int(fits[0])
                lengths, there = bins[room].pop()
                if not bins[room]:
                    present[room] = False
                used = min(count, there)
                if there > used:
                    put(lengths, there - used)
                put((*lengths, length), used)
                count -= used
            else:  # as many as fit go together
                each = min(size // length, count)
                put((length,) * each, count // each)
                count -= count // each * each
    return [x for group in bins.values() for x in group]


def slots(made: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length the runs (first rank, first sequence, offset) in order of rank."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, repeats in made:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            runs.setdefault(length, []).append((first, sequence, offset))
            used[length] = first + repeats
            offset += length
        sequence += repeats
    return {k: np.asarray(v, dtype=np.int64) for k, v in runs.items()}


def pack(cut: DataFrame, *, max_len: int = 1024, buckets: int = 256) -> DataFrame:
    """``cut`` (from :func:`pieces`) with ``sequence_id`` and ``offset``.

    To the driver go at most ``max_len`` counts; back go the plan's runs, at most three per pattern plus the residual,
    so below ``max_len ** 2`` numbers whatever the data's size.
    """
    cut = materialize(cut, "pieces")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int")
    cut = cut.withColumn("bucket", bucket)
    counts = materialize(cut.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")  # at most max_len x buckets rows
    histogram = np.zeros(max_len + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[row["length"]] = row["n"]
    runs = slots(plan(histogram, max_len))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = cut.withColumn("rank", F.row_number().over(place)).join(F.broadcast(firsts), ["length", "bucket"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("rank") - 1).alias("rank"))
    shared = cut.sparkSession.sparkContext.broadcast(runs)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        table = shared.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                own, at = table[int(value)], np.flatnonzero(length == value)
                run = np.searchsorted(own[:, 0], rank[at], side="right") - 1
                sequence[at] = own[run, 1] + rank[at] - own[run, 0]
                offset[at] = own[run, 2]
            yield {n: batch.column(i) for i, n in enumerate(("doc_id", "piece", "start", "length", "ids_crc32"))} | {
                "sequence_id": sequence, "offset": offset}

    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *[(n, pa.int64()) for n in (
        "start", "length", "ids_crc32", "sequence_id", "offset")]])
    return map_arrow(ranked, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
                     arrow, rows)


def pack_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", max_len: int = 1024, end_id: int = 2,
                   vocabulary: str | None = None) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    return pack(pieces(docs, key=key, text=text, max_len=max_len, end_id=end_id, vocabulary=vocabulary), max_len=max_len).withColumnRenamed(
        "doc_id", key)
