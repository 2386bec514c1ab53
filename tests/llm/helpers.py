"""Small tables with the awkward cases, and random texts."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

#: Columns named like those that operators use inside.
CLASHING = (
    "unit bucket row line n key kind node fp class members digest content low high place line_id "
    "tokens budget score y words a b root least held_out best _stay _copy _mix0 _mix_row "
    "_mix_tokens _mix_order copy text_digest doc_ids position total level task rank"
).split()


def docs(spark, rows, clashing=True, parts=3):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "src1")[len(r) - 2 :]) if len(r) < 4 else r for r in rows]
    full = [(*r, None if r[1] is None else len(r[1])) for r in full]
    df = spark.createDataFrame(full, DOCS).repartition(parts)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' as `{name}`")
    return df


def words(rng: random.Random, n: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


AWKWARD = [
    (1, "a b c"),
    (1, "a b c"),
    (2, None),
    (3, ""),
    (4, "  \n\t "),
    (None, "a b c"),
    (None, None),
    (5, "é ü ß   x y"),
    (6, "long " * 30_000),
    (7, "x" * 200_000),
]
