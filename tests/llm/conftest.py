import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside, with types they would not expect
    *[T.StructField(n, T.StringType()) for n in ("fp", "label", "row", "word", "rank", "__block", "__key", "n_words", "kept", "bucket", "ids")],
])


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    syllables = ["ta", "re", "mi", "lo", "ver", "sen", "qui", "ano", "del", "est"]
    return " ".join("".join(pick.choice(syllables) for _ in range(pick.randint(1, 4))) for _ in range(words))


def tricky_rows():
    passage = prose(99, 70)
    base = prose(1, 120)
    texts = [
        base, base, base.replace("ta", "ta", 1) + " extra", prose(2, 200) + "\n" + passage, passage + " " + prose(3, 150), None, "", "   \n\t ",
        "the the the the the the", prose(4, 30000), "x" * 30000, "no spaces" + "é" * 5000, "a,b;c\n\n a,b;c\n\na  b", "日本語のテキスト " * 30,
        "mail foo.bar@site.example.com or +1 (555) 123-4567, 4111 1111 1111 1111, 10.0.0.256 10.0.0.25 x@y @ @@ a@b.c", "ÀÉÎ straße <|endoftext|> ▁ mark",
        "Licensed under the MIT License.\nSPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only", "\u0000nul\u0000 and   wide   space",
    ]
    rows = [(i, t, ["en", "fr", None][i % 3], ["hot", "hot", None, "s1"][i % 4], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], rows[6], (None, base, "en", "hot", 5), (None, None, None, None, None), (-7, prose(5, 80), "fr", "", 1)]
    return [r + ("clash",) * 11 for r in rows]


@pytest.fixture(scope="session")
def tricky(spark):
    return spark.createDataFrame(tricky_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
