"""Small tables and plain versions of shared steps for the corpus tests."""

from __future__ import annotations

import random
import re
import zlib

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
# names that operators use inside, as further columns of the input
CLASHES = ["id", "key", "bucket", "block", "digest", "hits", "found", "start", "score", "kept", "rep", "node", "label_"]


def documents(spark, rows, clash: bool = False):
    """Documents from (doc_id, text) or longer rows; ``clash`` adds columns with awkward names."""
    schema, full = DOCS, []
    if clash:
        schema = T.StructType(DOCS.fields + [T.StructField(n, T.StringType()) for n in CLASHES])
    for row in rows:
        doc_id, text = row[:2]
        rest = list(row[2:]) + [None] * (3 - len(row[2:]))
        full.append((doc_id, text, *rest[:2], None if text is None else len(text), *(["x"] * len(CLASHES) if clash else [])))
    return spark.createDataFrame(full, schema)


def ascii_lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))


def fold(doc_id, folds: int) -> int:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % folds


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def union_find(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def frame(df):
    return [r.asDict() for r in df.collect()]
