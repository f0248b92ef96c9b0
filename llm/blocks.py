"""Looking things up for whole texts without shuffling their words.

Documents are dealt to blocks of bounded size. A block *asks* only for the distinct things its documents hold; the
answers are made by ordinary grouping over all blocks' questions (so a very common word is one row per block), and
go back to the block, where they meet the texts.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import blocks_for, whole_text

#: Bytes of text of a block.
BLOCK_BYTES = 12_000_000

BLOCK, BODY, KEY = "__block", "__body", "__key"


def deal(docs: DataFrame, *, key: str = "doc_id", text: str = "text", carry: dict[str, Column] | None = None,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``__block, __key, __body`` and the columns of ``carry``.

    A row's block follows from its key and text, so a lost task deals alike when it runs again; rows equal in both
    share a block. Null keys are the smallest long, null texts are empty.
    """
    own = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    n = blocks_for(docs, text, block_bytes)
    body = whole_text(text)
    return docs.select(F.pmod(F.xxhash64(own, body), F.lit(n)).cast("int").alias(BLOCK), own.alias(KEY), body.alias(BODY),
                       *[c.alias(name) for name, c in (carry or {}).items()])


def ask(dealt: DataFrame, function: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    return dealt.groupBy(BLOCK).applyInArrow(function, schema)


def answer(dealt: DataFrame, answers: DataFrame, function: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``function(texts of a block, answers of that block)`` for every block; ``answers`` has the column ``__block``."""
    return dealt.groupBy(BLOCK).cogroup(answers.groupBy(BLOCK)).applyInArrow(function, schema)
