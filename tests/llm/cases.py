"""Small tables with the awkward rows that every operator has to take, and plain versions of the operators."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])
# Names that the operators use themselves.
CLASHING = ["score", "rank", "kept", "row", "hash", "shard", "d", "t", "n", "gone", "node", "start", "length", "y", "x",
            "has_text", "key", "none"]


def texts(seed: int = 3, many: int = 60) -> list[tuple[int | None, str | None]]:
    """Invented prose with copies, shared passages, repeated lines, empty, null, very long and odd texts."""
    r = random.Random(seed)
    syllables = "an the re ou ti on ver schön él ña qua lo mi 日本 x1 !".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n)) + "."
    passage, short = line(60), line(9)
    rows: list[tuple[int | None, str | None]] = []
    for i in range(many):
        parts = [line(r.randint(3, 40)) for _ in range(r.randint(1, 6))]
        if i % 4 == 0:
            parts.insert(r.randint(0, len(parts)), passage)
        if i % 3 == 0:
            parts.append(short)
        rows.append((i * 7 + 3, "\n".join(parts)))
    near = rows[5][1].split(" ")
    near[len(near) // 2] = "changed"
    rows += [(1000, rows[1][1]), (1001, rows[1][1]), (2, rows[9][1]), (1002, " ".join(near))]
    rows += [(1003, None), (1004, ""), (1005, " "), (1006, "a" * 200), (1007, "ab" * 30), (1008, "\n\n\n"), (1009, "x")]
    rows += [(1010, " ".join(line(50) for _ in range(200))), (1011, "  a \t b   c\r\n\n d<|endoftext|>e  ")]
    rows += [(1010, rows[-2][1]), (None, rows[2][1]), (None, None), (1012, passage), (1012, "an other text " * 9)]
    return rows


def documents(spark, rows=None, clash: bool = True):
    rows = texts() if rows is None else rows
    data = [(i, t, "en", None, None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clash else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
