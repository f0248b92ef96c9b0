"""Personal data: fixed patterns, and a skip-chain conditional random field that keeps labels consistent.

The patterns give base spans. Tokens with a digit or an at sign are nodes of a field over the labels none, email, ip,
card, phone. Neighbors in the text share a chain potential; tokens of a document that repeat, or are similar (the same
digits or the same text without punctuation), share a skip potential however far apart they stand. Loopy message
passing settles the labels; tokens outside base spans that take an entity's label become added spans. Potentials are
fitted to base labels over all documents: counts of token shapes and of label pairs, a table of fixed size.

Edge cases: a null or empty text has no spans; repeated rows are judged alike; an empty table gives an empty result
and flat potentials; other columns are not read. Very long texts cost in proportion to their length: patterns are
written so that no run of characters is scanned twice, and every token has at most two skip edges.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import map_arrow, whole_text

KINDS = ("email", "ip", "card", "phone")
SHAPES = 4096  # buckets of token shapes
Span = tuple[int, int, int]  # kind, start, end

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]++")
_PLAIN = re.compile(r"[^a-z0-9@]+")
_DIGITS = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Leftmost, non-overlapping matches per kind, by kind and start; matches that fail a check are dropped."""
    out: list[Span] = []
    at, floor = text.find("@"), 0
    while at >= 0:  # the local part is the run before the sign, so runs are read once
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out.append((0, start, match.end()))
            floor = match.end()
            at = text.find("@", floor)
        else:
            floor = at + 1
            at = text.find("@", floor)
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def shape(token: str) -> int:
    """Bucket of a token's shape: runs of letters and digits with their length up to 4, other characters as they are."""
    out: list[str] = []
    last, run = "", 0
    for c in token[:64]:
        kind = "d" if c.isdigit() else "a" if c.isalpha() else c
        run = run + 1 if kind == last else 1
        if kind not in "da" or run <= 4:
            out.append(kind)
        last = kind
    return zlib.crc32("".join(out).encode()) % SHAPES


class Tokens:
    """Candidate tokens of one text: places, shapes, base labels (0: none), chain and skip edges."""

    def __init__(self, text: str, spans: list[Span]) -> None:
        found = [m for m in _TOKEN.finditer(text) if _SIGN.search(m[0])]
        self.spans = [m.span() for m in found]
        self.shape = np.array([shape(m[0]) for m in found], dtype=np.int64)
        self.label = np.zeros(len(found), dtype=np.int64)
        starts = np.array([s for s, _ in self.spans], dtype=np.int64)
        ends = np.array([e for _, e in self.spans], dtype=np.int64)
        for kind, a, b in spans:  # the kind listed first wins where spans overlap
            at = slice(int(np.searchsorted(ends, a, side="right")), int(np.searchsorted(starts, b)))
            self.label[at] = np.where(self.label[at] == 0, kind + 1, self.label[at])
        self.chain = [(i, i + 1) for i in range(len(found) - 1) if ends[i] + 1 == starts[i + 1]]
        skip: set[tuple[int, int]] = set()
        last: dict[str, int] = {}
        for i, m in enumerate(found):
            plain = _PLAIN.sub("", m[0].lower())
            digits = _DIGITS.sub("", plain)
            for key in {plain if len(plain) >= 3 else "", "#" + digits if len(digits) >= 4 else ""} - {""}:
                if key in last and (last[key], i) not in self.chain[-1:]:
                    skip.add((last[key], i))
                last[key] = i
        self.skip = sorted(skip)

    def in_question(self) -> np.ndarray:
        """Unlabelled tokens that a path of skip edges connects to a base entity."""
        beside: dict[int, list[int]] = {}
        for a, b in self.skip:
            beside.setdefault(a, []).append(b)
            beside.setdefault(b, []).append(a)
        front = [i for i in beside if self.label[i]]
        reached = set(front)
        while front:
            new = [x for x in beside[front.pop()] if x not in reached]
            reached.update(new)
            front += new
        return np.array(sorted(i for i in reached if not self.label[i]), dtype=np.int64)


def fit(docs: DataFrame, *, text: str = "text", smooth: float = 1.0) -> dict[str, np.ndarray]:
    """Log potentials from base labels over all documents; the driver gets a table of fixed size."""
    n = len(KINDS) + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        unary = np.zeros((SHAPES, n), np.int64)
        pairs = np.zeros((2, n, n), np.int64)
        for batch in batches:
            for body in batch.column(0).to_pylist():
                if not _SIGN.search(body):
                    continue
                t = Tokens(body, base_spans(body))
                sure = np.ones(len(t.label), bool)
                sure[t.in_question()] = False  # whether these are entities is what the field decides
                np.add.at(unary, (t.shape[sure], t.label[sure]), 1)
                for k, edges in enumerate((t.chain, t.skip)):
                    if edges:
                        a, b = np.array([e for e in edges if sure[e[0]] and sure[e[1]]], dtype=np.int64).reshape(-1, 2).T
                        np.add.at(pairs[k], (t.label[a], t.label[b]), 1)
        counts = np.concatenate([unary.ravel(), pairs.ravel()])
        cell = np.flatnonzero(counts)
        yield {"cell": cell, "n": counts[cell]}

    arrow = pa.schema([("cell", pa.int64()), ("n", pa.int64())])
    parts = map_arrow(docs.select(whole_text(text).alias("text")), "cell long, n long", arrow, rows)
    got = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SHAPES * n + 2 * n * n)
    counts[got["cell"].to_numpy()] = got["n"].to_numpy()
    unary = counts[:SHAPES * n].reshape(SHAPES, n)
    prior = (unary.sum(axis=0) + smooth) / (unary.sum() + n * smooth)
    seen = (unary + smooth * prior) / (unary.sum(axis=1, keepdims=True) + smooth)
    pairs = counts[SHAPES * n:].reshape(2, n, n) + smooth
    pairs = pairs + pairs.transpose(0, 2, 1)
    joint = pairs / pairs.sum(axis=(1, 2), keepdims=True)
    alone = joint.sum(axis=2)
    chain, skip = np.clip(np.log(joint / (alone[:, :, None] * alone[:, None, :])), -4, 4)
    return {"unary": np.log(np.maximum(seen, 1e-6)), "chain": chain, "skip": skip}


def marginals(tokens: Tokens, model: dict[str, np.ndarray], passes: int = 12, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of every token by loopy sum-product; base labels are held."""
    unary = model["unary"][tokens.shape].copy()
    held = tokens.label > 0
    unary[held] = -20.0
    unary[held, tokens.label[held]] = 0.0
    edges = np.array(tokens.chain + tokens.skip, dtype=np.int64).reshape(-1, 2)
    table = np.concatenate([np.repeat(model["chain"][None], len(tokens.chain), axis=0),
                            np.repeat(model["skip"][None], len(tokens.skip), axis=0)])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    table = np.concatenate([table, table.transpose(0, 2, 1)])
    m = len(edges)
    back = np.concatenate([np.arange(m, 2 * m), np.arange(m)])
    message = np.zeros((2 * m, unary.shape[1]))
    for _ in range(passes):
        belief = unary.copy()
        np.add.at(belief, target, message)
        out = belief[source] - message[back]
        new = np.logaddexp.reduce(out[:, :, None] + table, axis=1)
        new -= new.max(axis=1, keepdims=True)
        message = damping * message + (1 - damping) * new
    belief = unary
    np.add.at(belief, target, message)
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief)


def added_spans(text: str, base: list[Span], model: dict[str, np.ndarray], sure: float = 0.9) -> list[Span]:
    """Spans the field adds: an unlabelled token that is linked over a skip edge to an entity and takes its label."""
    if not base:
        return []
    tokens = Tokens(text, base)
    open_ = tokens.in_question()
    if not len(open_):
        return []
    p = marginals(tokens, model)
    best = p.argmax(axis=1)
    out: list[Span] = []
    for i in open_.tolist():
        if best[i] and p[i, best[i]] >= sure:
            start, end = tokens.spans[i]
            kind = int(best[i]) - 1
            if out and out[-1][0] == kind and out[-1][2] + 1 == start:
                out[-1] = (kind, out[-1][1], end)
            else:
                out.append((kind, start, end))
    return out


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def digest_row(text: str, model: dict[str, np.ndarray]) -> dict[str, object]:
    base = base_spans(text) if _SIGN.search(text) or "+" in text else []
    count = [sum(1 for s in base if s[0] == k) for k in range(len(KINDS))]
    return {**{f"n_{name}": n for name, n in zip(KINDS, count, strict=True)},
            "base_sha256": hashlib.sha256(spelled(base).encode()).hexdigest(),
            "spans": spelled(base + added_spans(text, base, model))}


def masked(text: str, model: dict[str, np.ndarray]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are replaced as one."""
    base = base_spans(text) if _SIGN.search(text) or "+" in text else []
    if not base:
        return text
    out, at = [], 0
    spans = sorted(base + added_spans(text, base, model), key=lambda s: (s[1], -s[2]))
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _per_text(docs: DataFrame, key: Column, text: str, arrow: pa.Schema, schema: str, model: dict[str, np.ndarray],
              make: Callable[[str, dict[str, np.ndarray]], dict[str, object]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            made = [make(body, shared.value) for body in batch.column(1).to_pylist()]
            yield {"key": batch.column(0), **{f.name: [x[f.name] for x in made] for f in list(arrow)[1:]}}

    return map_arrow(docs.select(key.alias("key"), whole_text(text).alias("text")), schema, arrow, rows)


def find_personal_data(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, base counts per kind, the digest of the base spans, and all spans, for every row."""
    arrow = pa.schema([("key", pa.int64()), *[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string())])
    schema = "key long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"
    return _per_text(docs, F.col(key).cast("long"), text, arrow, schema, fit(docs, text=text), digest_row).withColumnRenamed("key", key)


def mask_personal_data(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``docs`` with spans masked in ``text``; null texts stay null, the other columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, text=text))
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(place)
            new = pa.array([None if x is None else masked(x, shared.value) for x in bodies.to_pylist()], type=bodies.type)
            yield pa.RecordBatch.from_arrays([new if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
