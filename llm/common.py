"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.session import materialize, scratch_path

__all__ = ["as_bytes", "blocks_for", "crc_remainder", "free_name", "given", "map_arrow", "materialize", "scratch_path",
           "whole_text"]


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def whole_text(text: str = "text") -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def crc_remainder(key: str, divisor: int) -> Column:
    """crc32 of the key's text modulo ``divisor``; null keys count as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column, empty for null."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def map_arrow(df: DataFrame, schema: str, arrow: pa.Schema,
              rows: Callable[[Iterator[pa.RecordBatch]], Iterable[dict[str, object]]]) -> DataFrame:
    """``mapInArrow`` for functions that yield column dictionaries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(batches):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow)
    return df.mapInArrow(run, schema)


def blocks_for(docs: DataFrame, text: str, block_bytes: int) -> int:
    """How many blocks of about ``block_bytes`` of text the table makes; one narrow pass."""
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    return max(1, -(-int(total) // block_bytes))
