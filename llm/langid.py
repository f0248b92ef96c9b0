"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all
its segmentations into pieces, found by the forward algorithm; a text's score adds its words' logarithms. Piece
probabilities are fitted by expectation-maximisation on the words' counts per language.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is everything if there is nothing to learn
from; rows with a null language are not learned from; ties go to the first language by name; repeated rows count as
often as they occur; an empty table gives an empty result; other columns are not read. Words of any length are
scored whole (rescaled on the way); for fitting, words are cut into slices of 32 characters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import as_bytes, map_arrow, materialize

MARK = "▁"
LONGEST = 16
UNKNOWN = 1e-7
#: Distinct words a task holds before it passes their counts on or drops its store of scores.
HELD_WORDS = 300_000
#: Anything of ASCII but letters separates words; beyond ASCII everything is taken as a letter of some script.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))


@lru_cache(maxsize=2)
def vocabulary(path: str | None) -> dict[str, int]:
    """The model file's ordinary pieces, numbered in order."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return {name: i for i, name in enumerate(n for n in names if len(n) <= LONGEST)}


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_LETTERS).split()


def spelled(word: bytes) -> str:
    return MARK + word.decode("utf-8", "replace").lower()


def edges(n: int) -> list[tuple[int, int]]:
    """(start, end) of every substring of bounded length of a word of ``n`` characters, by start."""
    return [(i, j) for i in range(n) for j in range(i + 1, min(n, i + LONGEST) + 1)]


def lattice(words: list[str], pieces: dict[str, int], spans: list[tuple[int, int]]) -> np.ndarray:
    """Piece ids [edge, word] for words of one length; no piece: V, an unknown single character: V + 1."""
    get, size = pieces.get, len(pieces)
    ids = np.array([get(word[i:j], size) for word in words for i, j in spans], dtype=np.int32).reshape(len(words), len(spans)).T
    single = np.array([j == i + 1 for i, j in spans])
    return np.where((ids == size) & single[:, None], size + 1, ids)


def by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of words of equal length, in groups of bounded lattice size."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        step = max(1, 100_000 // int(n))
        for i in range(0, len(at), step):
            yield at[i:i + step]


def with_edges(probability: np.ndarray) -> np.ndarray:
    """Two more rows: none (0) and the unknown character."""
    extra = np.zeros((2, probability.shape[1]))
    extra[1] = UNKNOWN
    return np.vstack([probability, extra])


def forward(words: list[str], pieces: dict[str, int], probability: np.ndarray) -> np.ndarray:
    """log P(word) in every language, summed over all segmentations: [word, language]."""
    out = np.zeros((len(words), probability.shape[1]))
    for at in by_length(words):
        n = len(words[at[0]])
        spans = edges(n)
        ids = lattice([words[i] for i in at], pieces, spans)
        into: list[list[int]] = [[] for _ in range(n + 1)]
        for e, (_, j) in enumerate(spans):
            into[j].append(e)
        alpha = np.zeros((n + 1, len(at), probability.shape[1]))
        alpha[0] = 1
        for j in range(1, n + 1):
            for e in into[j]:
                alpha[j] += alpha[spans[e][0]] * probability[ids[e]]
            if j % LONGEST == 0:
                top = alpha[j].max(axis=1, keepdims=True)
                alpha[max(0, j - LONGEST):j + 1] /= top
                out[at] += np.log(top)
        out[at] += np.log(alpha[n])
    return out


def expected(words: list[str], weights: np.ndarray, pieces: dict[str, int], probability: np.ndarray) -> np.ndarray:
    """Expected piece counts of weighted words (at most 32 characters and the mark) of one language."""
    counts = np.zeros(len(pieces) + 2)
    for at in by_length(words):
        n = len(words[at[0]])
        spans = edges(n)
        ids = lattice([words[i] for i in at], pieces, spans)
        p = probability[ids]
        alpha, beta = np.zeros((n + 1, len(at))), np.zeros((n + 1, len(at)))
        alpha[0] = beta[n] = 1
        for e, (i, j) in sorted(enumerate(spans), key=lambda x: x[1][1]):
            alpha[j] += alpha[i] * p[e]
        for e in range(len(spans) - 1, -1, -1):
            i, j = spans[e]
            beta[i] += beta[j] * p[e]
        starts, ends = np.array(spans).T
        share = alpha[starts] * p * beta[ends] * (weights[at] / alpha[n])
        counts += np.bincount(ids.ravel(), share.ravel(), len(counts))
    return counts[:-2]


def word_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, word, n), added up within tasks before the shuffle; a task holds a bounded number of words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        held: dict[str, Counter[bytes]] = {}

        def flush() -> Iterator[dict[str, object]]:
            for name, counts in held.items():
                words = [w.decode("utf-8", "replace") for w in counts]
                yield {"lang": [name] * len(words), "word": words, "n": list(counts.values())}
            held.clear()

        for batch in batches:
            for raw, name in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts = held.setdefault(name, Counter())
                for word in words_of(raw):
                    if len(word) <= 32:
                        counts[word] += 1
                    else:
                        whole = word.decode("utf-8", "replace")
                        counts.update(whole[i:i + 32].encode() for i in range(0, len(whole), 32))
            if sum(map(len, held.values())) > HELD_WORDS:
                yield from flush()
        yield from flush()

    arrow = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
    narrow = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    parts = map_arrow(narrow, "lang string, word string, n long", arrow, rows)
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang", rounds: int = 2, pseudo: float = 0.05,
        path: str | None = None) -> tuple[list[str], np.ndarray]:
    """Languages by name and piece probabilities [piece, language].

    The driver gets piece counts only: at most the vocabulary's size times the languages'.
    """
    words = materialize(word_counts(docs, text, lang), "words")
    langs = [r[0] for r in words.select("lang").distinct().orderBy("lang").collect()]
    pieces = vocabulary(path)
    probability = np.full((len(pieces), max(1, len(langs))), 1 / len(pieces))
    number = {name: i for i, name in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        shared = words.sparkSession.sparkContext.broadcast(with_edges(probability))

        def rows(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[dict[str, object]]:
            known, p = vocabulary(path), shared.value
            total = np.zeros((len(known), len(number)))
            held: dict[str, tuple[list[str], list[int]]] = {}

            def add(name: str) -> None:
                spelt, weights = held.pop(name)
                i = number[name]
                total[:, i] += expected(spelt, np.array(weights, dtype=float), known, np.ascontiguousarray(p[:, i]))

            for batch in batches:
                for name, word, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    words_, weights = held.setdefault(name, ([], []))
                    words_.append(MARK + word.lower())
                    weights.append(n)
                for name in [x for x, (w, _) in held.items() if len(w) >= 50_000]:
                    add(name)
            for name in list(held):
                add(name)
            piece, own = np.nonzero(total)
            yield {"lang": own, "piece": piece, "n": total[piece, own]}

        arrow = pa.schema([("lang", pa.int64()), ("piece", pa.int64()), ("n", pa.float64())])
        parts = map_arrow(words, "lang long, piece long, n double", arrow, rows).groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        counts = np.full((len(pieces), len(langs)), pseudo)
        got = parts.toArrow()
        counts[got["piece"].to_numpy(), got["lang"].to_numpy()] += got["n"].to_numpy()
        probability = counts / counts.sum(axis=0)
    return langs, probability


def identify(docs: DataFrame, langs: list[str], probability: np.ndarray, *, key: str = "doc_id", text: str = "text",
             extra: dict[str, Column] | None = None, path: str | None = None) -> DataFrame:
    """``key``, the columns of ``extra``, ``lang_pred`` and ``score`` (the posterior of the winner); no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(with_edges(probability))
    extra = extra or {}
    names = list(extra)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        pieces, p = vocabulary(path), shared.value
        number: dict[bytes, int] = {}
        logs = np.zeros((0, p.shape[1]))
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for first in range(0, len(texts), 500):
                if len(number) > HELD_WORDS:
                    number, logs = {}, logs[:0]
                split = [words_of(x) for x in texts[first:first + 500]]
                new = list({w for words in split for w in words} - number.keys())
                if new:
                    logs = np.vstack([logs, forward([spelled(w) for w in new], pieces, p)])
                    number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
                pred, score = [], []
                for raw, words in zip(texts[first:first + 500], split, strict=True):
                    letter = bool(words) and (any(w[0] < 128 for w in words) or any(map(str.isalpha, raw.decode("utf-8", "replace"))))
                    if not letter or not langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    total = logs[[number[w] for w in words]].sum(axis=0)
                    best = int(total.argmax())
                    pred.append(langs[best])
                    score.append(float(1 / np.exp(np.minimum(total - total[best], 0)).sum()))
                yield {"key": batch.column(0).slice(first, 500), "lang_pred": pred, "score": score} | {
                    name: batch.column(2 + i).slice(first, 500) for i, name in enumerate(names)}

    narrow = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"),
                         *[c.alias(n) for n, c in extra.items()])
    types = dict(narrow.dtypes)
    fields = [("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]
    arrow = pa.schema(fields + [(n, {"boolean": pa.bool_(), "string": pa.string(), "bigint": pa.int64()}[types[n]]) for n in extra])
    schema = "key long, lang_pred string, score double" + "".join(f", {n} {types[n]}" for n in extra)
    return map_arrow(narrow, schema, arrow, rows).withColumnRenamed("key", key)
