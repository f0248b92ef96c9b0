"""License scans: Aho-Corasick over notice phrases and identifier tags, and a parser of licence expressions.

Two automata run over every whole text: one over its words (notice phrases, which must stand word by word), one over
its lower-cased characters (tags such as ``SPDX-License-Identifier:``). What follows a tag on its line is read as an
expression with and/or/with and parentheses; a shunting-yard turns it into postfix order for evaluation.

Edge cases: a null or empty text has no words, no labels and score 0; repeated rows are judged alike; an empty table
gives an empty result; other columns of the input are not read. Rows are independent, so nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import as_bytes, map_arrow

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = {
    "lesser general public license": "lgpl", "affero general public license": "agpl", "bsd license": "bsd",
    "mozilla public license": "mpl", "eclipse public license": "epl", "isc license": "isc", "boost software license": "bsl",
    "creative commons attribution": "cc-by", "cc by": "cc-by", "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd", "cc0": "cc0", "public domain dedication": "cc0", "all rights reserved": "proprietary",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "license:", "licence:")
#: Identifier prefixes an expression may hold, the longest first, and their labels.
FAMILIES = ("cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by", "apache", "agpl", "lgpl", "gpl", "bsd", "mit", "mpl", "epl", "isc", "cc0")
#: How freely work under a label may be used; an expression takes the best of an ``or`` and the worst of an ``and``.
FREEDOM = {"cc0": 1.0, "mit": 0.95, "isc": 0.95, "bsd": 0.95, "apache": 0.9, "cc-by": 0.85, "mpl": 0.7, "epl": 0.65,
           "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "proprietary": 0.0}
WEIGHTS = {"tag": 0.95, "base": 0.8, "notice": 0.7}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(r"[()]|[a-z0-9.+-]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and anything beyond ASCII."""
    return raw.translate(_WORDS).split()


def postfix(tokens: list[str]) -> list[str] | None:
    """Shunting-yard over identifiers, and/or/with and parentheses; None if the expression is malformed."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # whether an operand must come next
    for token in tokens:
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif token in PRECEDENCE:
            if operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand = True
        else:
            if not operand:
                return None
            out.append(token)
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def family(identifier: str) -> str | None:
    return next((f for f in FAMILIES if identifier == f or identifier.startswith((f + "-", f + "+"))), None)


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels and freedom of the longest well-formed expression at the start of a lower-cased line."""
    tokens = _TOKEN.findall(expression)
    end = 0
    for i, token in enumerate(tokens):  # as far as it can be one: known names, operators, parentheses, exceptions
        if not (token in PRECEDENCE or token in "()" or family(token.rstrip(".")) or i and tokens[i - 1] == "with"):
            break
        end = i + 1
    tokens = [t if t in "()" else t.rstrip(".") for t in tokens[:end]]
    order = None
    while tokens and (order := postfix(tokens)) is None:
        tokens.pop()
    if not order:
        return None
    stack: list[tuple[set[str], float]] = []
    for token in order:
        if token in PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if token == "with":  # an exception keeps the licence's label
                stack.append(left)
            else:
                stack.append((left[0] | right[0], (max if token == "or" else min)(left[1], right[1])))
        else:
            label = family(token)
            stack.append(({label}, FREEDOM[label]) if label else (set(), 0.0))
    return stack[0] if stack[0][0] else None


@lru_cache(maxsize=1)
def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    phrases, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE_PHRASES}.items():
        phrases.add_word(f" {phrase} ", (phrase in BASE_PHRASES, label, len(phrase)))
    for tag in TAGS:
        tags.add_word(tag, tag)
    phrases.make_automaton()
    tags.make_automaton()
    return phrases, tags


def scan(raw: bytes) -> dict[str, object]:
    """Everything found in one text; word places count from 0, tag places are characters."""
    phrases, tags = automata()
    words = words_of(raw)
    line = " " + b" ".join(words).decode("utf-8", "replace") + " "
    base: list[int] = []
    base_labels: set[str] = set()
    labels: set[str] = set()
    kinds: set[str] = set()
    seen, at = 0, 0  # words before character ``at``
    for last, (is_base, label, length) in phrases.iter(line):
        start = last - length - 1  # of the space before the phrase
        seen += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
        at = start
        labels.add(label)
        kinds.add("base" if is_base else "notice")
        if is_base:
            base.append(seen)
            base_labels.add(label)
    lower = raw.translate(_LOWER).decode("utf-8", "replace")
    expressions: list[tuple[int, float]] = []
    for last, _ in tags.iter(lower):
        stop = lower.find("\n", last)
        found = evaluate(lower[last + 1: stop if stop >= 0 else len(lower)])
        if found:
            labels |= found[0]
            kinds.add("tag")
            expressions.append((last + 1, found[1]))
    miss = 1.0
    for kind in kinds:
        miss *= 1 - WEIGHTS[kind]
    return {"n_words": len(words), "n_base": len(base), "first_word": min(base, default=None), "last_word": max(base, default=None),
            "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)), "score": 1 - miss,
            "freedom": min((f for _, f in expressions), default=None), "n_expressions": len(expressions)}


FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
          ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("freedom", pa.float64()),
          ("n_expressions", pa.int64())]


def scan_licences(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` (a long), word count, base places, labels, score, the expressions' number and freedom, row by row."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        for batch in batches:
            found = [scan(raw) for raw in as_bytes(batch.column(1))]
            yield {"key": batch.column(0), **{name: [x[name] for x in found] for name, _ in FIELDS}}

    arrow = pa.schema([("key", pa.int64()), *FIELDS])
    spark_types = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = "key long, " + ", ".join(f"{n} {spark_types[t]}" for n, t in FIELDS)
    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return map_arrow(narrow, schema, arrow, rows).withColumnRenamed("key", key)
