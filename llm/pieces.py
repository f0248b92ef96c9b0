"""SentencePiece encoding and decoding through a relational lattice.

White space is written as the mark ``▁`` and a mark is put first. Texts are cut into units that no piece of the
vocabulary crosses. Over the distinct units of all texts: substrings of bounded length are exploded and equi-joined
to the piece table, edges are grouped by unit, and a higher-order ``aggregate`` folds them left to right into the
segmentation of highest total piece score (Viterbi; ties to the longer last piece). Characters that are no piece fall back
to their UTF-8 bytes. The ids then go back to the blocks of texts that asked for them: a block asks each part of the
units (dealt by crc32) in one compressed frame and gets one back, so what moves are frames and each distinct unit once.

Edge cases: a null or empty text has no ids; text that holds the mark itself decodes to a space; repeated rows are encoded
alike; an empty table gives an empty result; the names of other columns do not matter. Units longer than ``LONG_UNIT``
characters (runs without blanks or of one sign) are not cut: the task that holds their text runs the same search over them,
in time and memory proportional to their length.

Texts travel to their blocks once, as compressed frames of many texts.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from llm import blocks
from llm.blocks import BLOCK, BODY
from llm.common import blocks_for, map_arrow

MARK = "▁"
#: Longer units are searched where their text is; no result depends on it.
LONG_UNIT = 64
#: Bytes of text of a block.
BLOCK_BYTES = 5_000_000
#: Score of a character that is no piece: below every piece but those of blanks.
UNKNOWN = -1e6
#: Marks and the letters, or the other characters, that follow: no piece crosses from one to the other. (The one piece
#: of the vocabulary that would, a raised two and a full stop, stays whole as neither is a letter here.)
_UNIT = re.compile(rf"{MARK}*(?:[^\W\d_²]+|(?:(?!{MARK})[\W\d_²])+)|{MARK}+")
#: Blanks after a mark, a blank or nothing: they open no new word.
_LOOSE = re.compile(rf"(?:\A|(?<=[ {MARK}])) ")
PART = "__part"


class Pieces:
    """The model file's pieces: names, scores, and the first of its 256 byte tokens."""

    def __init__(self, path: str | None) -> None:
        import sentencepiece

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.rows = [(name, i, float(model.get_score(i))) for i, name in enumerate(self.names)
                     if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.first_byte = model.piece_to_id("<0x00>")
        self.longest = max(len(name) for name, _, _ in self.rows)
        byte_tokens = range(self.first_byte, self.first_byte + 256)
        self.raw = [bytes([i - self.first_byte]) if i in byte_tokens else name.encode() for i, name in enumerate(self.names)]
        self.table = {name: (i, score) for name, i, score in self.rows}
        #: Ids travel as big-endian numbers of this many bytes.
        self.width = 2 if len(self.names) <= 1 << 16 else 4


@lru_cache(maxsize=2)
def pieces(path: str | None) -> Pieces:
    return Pieces(path)


def loosened(text: str) -> str:
    """The text with a blank only where a new word starts; blanks that open none are marks already."""
    return _LOOSE.sub(MARK, text) if "  " in text or text[:1] == " " or MARK in text else text


def words_of(text: str) -> list[str]:
    """Words of a text in order, whole units each; joined, a mark before each, they are the marked text."""
    return loosened(text).split(" ") if text else []


def units_of(text: str) -> list[str]:
    """Units of a text in order; joined they are the marked text."""
    return [u for word in words_of(text) for u in _UNIT.findall(MARK + word)]


def places(first: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the members of the runs ``at`` stand, end to end, of runs with these starts and sizes."""
    size = sizes[at]
    ends = np.cumsum(size)
    return np.repeat(first[at] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class Spelled:
    """Texts as numbers of their distinct words, and these as numbers of their distinct units."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        split = pc.split_pattern(pa.array([loosened(x.as_py()) or None for x in texts], pa.string()), " ")
        self.text_sizes = pc.list_value_length(split).fill_null(0).to_numpy().astype(np.int64)
        words = split.flatten().dictionary_encode()
        # Words without a mark are cut in one go: each starts at a unit with a mark.
        names = words.dictionary
        odd = pc.or_(pc.equal(pc.binary_length(names), 0), pc.match_substring(names, MARK)).to_numpy(zero_copy_only=False)
        plain = names.filter(pa.array(~odd))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(plain)], pa.int32()), plain), MARK)[0].as_py()
        flat = pa.array(_UNIT.findall(MARK + joined) if len(plain) else [], pa.string())
        starts = np.flatnonzero(pc.starts_with(flat, MARK).to_numpy(zero_copy_only=False))
        found = [_UNIT.findall(MARK + w) for w in names.filter(pa.array(odd)).to_pylist()]
        self.word_sizes = np.concatenate([np.diff(starts, append=len(flat)), np.array(list(map(len, found)), np.int64)])
        self.words = np.argsort(np.argsort(odd, kind="stable"))[words.indices.to_numpy()]
        units = pa.concat_arrays([flat, pa.array(list(chain.from_iterable(found)), pa.string())]).dictionary_encode()
        self.units, self.in_words = units.dictionary, units.indices.to_numpy()
        # What the lattice takes, by name.
        short = np.flatnonzero(pc.utf8_length(self.units).to_numpy() <= LONG_UNIT)
        units = self.units.take(pa.array(short))
        body, ends = bytes_of(units), np.cumsum(pc.binary_length(units).to_numpy()).tolist()
        crc = np.array([zlib.crc32(body[a:b]) for a, b in zip([0, *ends], ends, strict=False)], dtype=np.int64)
        order = pc.sort_indices(units).to_numpy()
        self.short, self.crc = short[order], crc[order]

    def by_part(self, n_parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the units the lattice takes, by part and then name, and their parts."""
        part = self.crc % n_parts
        order = np.argsort(part, kind="stable")
        return self.short[order], part[order]

    def ids(self, first: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the texts' ids and these, from where the units' ids stand in ``flat``."""
        last = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes[self.in_words], dtype=np.int64)])
        ends = np.cumsum(self.word_sizes)
        flat = flat[places(first, sizes, self.in_words)]
        first, sizes = last[ends - self.word_sizes], last[ends] - last[ends - self.word_sizes]
        split = np.split(self.words, np.cumsum(self.text_sizes)[:-1]) if len(self.text_sizes) else []
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum([sizes[at].sum() for at in split], dtype=np.int64)])
        out = np.empty(ends[-1], np.int32)
        for at, start, end in zip(split, ends[:-1], ends[1:], strict=True):
            out[start:end] = flat[places(first, sizes, at)]
        return ends, out


def bytes_of(strings: pa.Array) -> bytes:
    """The strings' bytes end to end."""
    if not len(strings):
        return b""
    offsets = np.frombuffer(strings.buffers()[1], np.int32)
    return strings.buffers()[2][offsets[strings.offset]:offsets[strings.offset + len(strings)]].to_pybytes()


def packed(strings: pa.Array) -> bytes:
    """A frame of byte strings: their number, sizes and bytes."""
    sizes = np.asarray(pc.binary_length(strings), dtype="<u2")
    return zstandard.compress(len(sizes).to_bytes(4, "little") + sizes.tobytes() + bytes_of(strings), 3)


def unpacked(frame: bytes) -> tuple[np.ndarray, bytes]:
    raw = zstandard.decompress(frame)
    end = 4 + 2 * int.from_bytes(raw[:4], "little")
    return np.frombuffer(raw[4:end], "<u2").astype(np.int64), raw[end:]


def units_in(frames: pa.ChunkedArray) -> list[pa.Array]:
    """The units of every frame."""
    parts = [unpacked(x.as_py()) for x in frames]
    return [pa.StringArray.from_buffers(len(sizes), pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.py_buffer(body))
            for sizes, body in parts]


def best_ids(unit: str, known: Pieces) -> list[int]:
    """The lattice's search over one unit of any length: highest total score, ties to the longer last piece."""
    scores, lengths = [0.0], [0]
    for end in range(1, len(unit) + 1):
        best, length = -math.inf, 1
        for n in range(1, min(known.longest, end) + 1):
            piece = known.table.get(unit[end - n:end])
            if piece is None and n > 1:
                continue
            score = scores[end - n] + (UNKNOWN if piece is None else piece[1])
            if score >= best:
                best, length = score, n
        scores.append(best)
        lengths.append(length)
    out: list[int] = []
    end = len(unit)
    while end:
        piece = unit[end - lengths[end]:end]
        out += [known.table[piece][0]] if piece in known.table else [known.first_byte + b for b in reversed(piece.encode())]
        end -= lengths[end]
    return out[::-1]


def lattice_ids(units: DataFrame, spark: SparkSession, path: str | None) -> DataFrame:
    """The columns of ``units``, of which ``unit`` comes first, and ``ids`` (big-endian, ``Pieces.width`` bytes each) of
    distinct units; partitioned by some of these columns before and after, so nothing moves. An edge is its end, length and id, negative for a character that is
    no piece."""
    known, own = pieces(path), units.columns
    table = F.broadcast(spark.createDataFrame(known.rows, "piece string, id int, score double"))  # fixed by the vocabulary
    n = F.length("unit")
    # In order of units, so that the grouping, which sorts by them, finds them sorted.
    spans = units.sortWithinPartitions(*own).select(*own, F.explode(F.sequence(F.lit(1), n)).alias("start")).select(
        *own, "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(known.longest), n - F.col("start") + 1))).alias("len"))
    edges = spans.select(*own, (F.col("start") + F.col("len") - 1).alias("end"), "len", F.substring(F.col("unit"), F.col("start"), F.col("len")).alias("piece")).join(
        table, "piece", "left").where("id IS NOT NULL OR len = 1")
    grouped = edges.groupBy(*own).agg(F.collect_list(F.struct(
        "end", "len", F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("score", F.lit(UNKNOWN)).alias("score"))).alias("edges"))
    digits = 2 * known.width

    def written(e: Column, end: Column) -> Column:
        """Hex digits of an edge's ids."""
        raw = F.hex(F.encode(F.substring(F.col("unit"), end, F.lit(1)), "UTF-8"))
        byte = lambda at: F.lpad(F.hex(F.conv(F.substring(raw, at, F.lit(2)), 16, 10).cast("int") + known.first_byte), digits, "0")
        return F.when(e["id"] >= 0, F.lpad(F.hex(e["id"]), digits, "0")).otherwise(
            F.array_join(F.transform(F.sequence(F.lit(1), F.length(raw), F.lit(2)), byte), ""))

    def step(best: Column, end: Column) -> Column:
        into = F.filter("edges", lambda e: e["end"] == end)
        reached = F.transform(into, lambda e: F.struct((F.get(best, end - e["len"])["score"] + e["score"]).alias("score"), e["len"].alias("len"), e["id"].alias("id")))
        return F.concat(best, F.transform(F.array(F.array_max(reached)), lambda top: F.struct(
            top["score"].alias("score"), F.concat(F.get(best, end - top["len"])["ids"], written(top, end)).alias("ids"))))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit("").alias("ids")))
    folded = F.aggregate(F.sequence(F.lit(1), F.length("unit")), start, step, lambda best: F.element_at(best, -1)["ids"])
    return grouped.select(*own, F.unhex(folded).alias("ids"))


def framed(dealt: DataFrame) -> DataFrame:
    """``__block, frame``: the rows of a batch that go to one block, as one compressed Arrow stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            block = batch.column(BLOCK).to_numpy()
            order = np.argsort(block, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(block[order])) + 1) if len(order) else []:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as writer:
                    writer.write_table(table.take(rows))
                frame = zstandard.compress(sink.getvalue(), 3)
                yield pa.RecordBatch.from_pydict({BLOCK: [block[rows[0]]], "frame": [frame]}, schema=pa.schema([(BLOCK, pa.int32()), ("frame", pa.binary())]))

    return dealt.mapInArrow(run, f"{BLOCK} int, frame binary")


def unframed(frames: pa.Table) -> pa.Table | None:
    """The rows of a block; none for no frames."""
    tables = [pa.ipc.open_stream(zstandard.decompress(x.as_py())).read_all() for x in frames["frame"]]
    return pa.concat_tables(tables) if tables else None


def encode(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None, path: str | None = None,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``carry`` (the key by default) and ``ids`` of every row."""
    carry = carry or {key: F.col(key)}
    carried = [f"__c{i}" for i in range(len(carry))]
    spark = docs.sparkSession
    whole = blocks.deal(docs, key=key, text=text, carry={f"__c{i}": c for i, c in enumerate(carry.values())}, block_bytes=block_bytes)
    dealt = framed(whole.drop(blocks.KEY))
    n_blocks = blocks_for(docs, text, block_bytes)
    width = pieces(path).width
    numbers = {2: ">u2", 4: ">u4"}[width]

    # Parts grow with the root of the blocks: so do the units of a part, and frames stay of some size.
    n_parts = 16 * math.ceil(math.sqrt(n_blocks))

    def asked(frames: pa.Table) -> pa.Table:
        table = unframed(frames)
        if table is None:
            return pa.table({BLOCK: pa.array([], pa.int32()), PART: pa.array([], pa.int32()), "frame": pa.array([], pa.binary())})
        spelled = Spelled(table[BODY])
        order, part = spelled.by_part(n_parts)
        units = spelled.units.take(pa.array(order))
        own, starts = np.unique(part, return_index=True)
        asks = [packed(units[a:b]) for a, b in zip(starts, [*starts[1:], len(units)], strict=True)]
        block = np.full(len(own), frames[BLOCK][0].as_py(), dtype=np.int32)
        del table, spelled, units
        pa.default_memory_pool().release_unused()  # idle workers would keep it
        return pa.table({BLOCK: block, PART: own.astype(np.int32), "frame": pa.array(asks, pa.binary())})

    def distinct(asks: pa.Table) -> pa.Table:
        units = pa.chunked_array(units_in(asks["frame"]), pa.string()).unique()
        part = np.full(len(units), asks[PART][0].as_py() if asks.num_rows else 0, dtype=np.int32)
        return pa.table({"unit": units, PART: part})

    def answered(asks: pa.Table, found: pa.Table) -> pa.Table:
        names, ids = found["unit"].combine_chunks(), found["ids"].combine_chunks()
        frames = [packed(ids.take(pc.index_in(units, value_set=names))) for units in units_in(asks["frame"])]
        return pa.table({BLOCK: asks[BLOCK], PART: asks[PART], "frame": pa.array(frames, pa.binary())})

    # One shuffle by part serves both sides.
    schema = f"{BLOCK} int, {PART} int, frame binary"
    questions = blocks.ask(dealt, asked, schema).repartition(n_parts, PART)
    units = questions.groupBy(PART).applyInArrow(distinct, f"unit string, {PART} int").repartition(n_parts, PART)
    answers = questions.groupBy(PART).cogroup(lattice_ids(units, spark, path).groupBy(PART)).applyInArrow(answered, schema)

    def applied(frames: pa.Table, answered: pa.Table) -> pa.Table:
        texts = unframed(frames)
        if texts is None:
            return schema_table.slice(0, 0)
        spelled = Spelled(texts[BODY])
        order, _ = spelled.by_part(n_parts)
        back = [unpacked(x.as_py()) for x in answered["frame"].take(pc.sort_indices(answered[PART]))]
        long = np.setdiff1d(np.arange(len(spelled.units)), order)
        searched = [np.array(best_ids(spelled.units[i].as_py(), pieces(path)), dtype=numbers).tobytes() for i in long.tolist()]
        sizes = np.concatenate([np.zeros(0, np.int64), *[sizes for sizes, _ in back], np.array(list(map(len, searched)), np.int64)]) // width
        flat = np.frombuffer(b"".join([*[body for _, body in back], *searched]), dtype=numbers).astype(np.int32)
        del back, searched
        # From the order of the parts, long units last, to the units' own.
        at = np.argsort(np.concatenate([order, long]))
        ends, ids = spelled.ids((np.cumsum(sizes) - sizes)[at], sizes[at], flat)
        del spelled, flat
        pa.default_memory_pool().release_unused()
        return pa.table({c: texts[c] for c in carried} | {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))})

    types = dict(whole.dtypes)
    returned = ", ".join([*[f"{c} {types[c]}" for c in carried], "ids array<int>"])
    schema_table = to_arrow_schema(whole.select(*carried, F.array().cast("array<int>").alias("ids")).schema).empty_table()
    return blocks.answer(dealt, answers, applied, returned).withColumnsRenamed(dict(zip(carried, carry, strict=True)))


def text_of(ids: pa.Scalar | list[int] | None, known: Pieces) -> str | None:
    """Pieces and byte tokens of a list of ids back to text: marks become spaces, the first one goes. Null for null."""
    if isinstance(ids, pa.Scalar):
        ids = ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else None
    if ids is None:
        return None
    raw = b"".join(map(known.raw.__getitem__, ids))
    return raw.decode("utf-8", "replace").replace(MARK, " ")[1:]


def decode(encoded: DataFrame, *, ids: str = "ids", path: str | None = None) -> DataFrame:
    """``encoded`` with the column ``decoded``; null ids give a null text."""
    place = encoded.columns.index(ids)
    schema = ", ".join([*[f"`{n}` {t}" for n, t in encoded.dtypes], "decoded string"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(path)
        for batch in batches:
            texts = pa.array([text_of(x, known) for x in batch.column(place)], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, schema)


def lossless(encoded: DataFrame, *, key: str = "doc_id", crc: str = "given_crc32", path: str | None = None) -> DataFrame:
    """``key``, number and crc32 of the ids (as little-endian 32-bit numbers), crc32 of the text they decode to, and whether
    ``crc`` is that. Texts are decoded one at a time where they are digested."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, object]]:
        known = pieces(path)
        for batch in batches:
            ids = [np.asarray(x.values.to_numpy(zero_copy_only=False) if x.is_valid else [], dtype="<u4") for x in batch.column(1)]
            back, given = [zlib.crc32((text_of(x, known) or "").encode()) for x in batch.column(1)], batch.column(2).to_pylist()
            yield {"key": batch.column(0), "n_tokens": [len(x) for x in ids], "ids_crc32": [zlib.crc32(x.tobytes()) for x in ids],
                   "text_crc32": back, "same_text": [a == b for a, b in zip(back, given, strict=True)]}

    arrow = pa.schema([*[(n, pa.int64()) for n in ("key", "n_tokens", "ids_crc32", "text_crc32")], ("same_text", pa.bool_())])
    narrow = encoded.select(F.col(key).cast("long").alias("key"), "ids", F.col(crc).cast("long").alias("crc"))
    return map_arrow(narrow, "key long, n_tokens long, ids_crc32 long, text_crc32 long, same_text boolean", arrow, rows).withColumnRenamed("key", key)
