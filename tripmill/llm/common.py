"""What the corpus operators share: words, hashes, folds and saved intermediate tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# odd 64-bit multipliers with well spread bits (golden ratio and two finalizer constants)
MIX_A, MIX_B, MIX_C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The rows written once to the shared checkpoint folder; later reads start from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def fitted(df: DataFrame, rows: int, task_rows: int = 50_000) -> DataFrame:
    """``df`` in no more partitions than its ``rows`` need: a small table shuffled into
    very many partitions costs more files and tasks than work. Never more than it has."""
    return df.coalesce(max(1, -(-rows // task_rows)))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows written once, with consecutive numbers from 0 in the order they have now.

    The driver sees one count a partition; a partition's offset reaches its rows by a join
    with that small table.
    """
    spark = df.sparkSession
    # Spark's id is the partition in the upper 31 bits and the row within it in the lower 33
    marked = saved(df.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), 33)
    counts = sorted(tuple(r) for r in marked.groupBy(part.alias("part")).agg(F.count("*")).collect())
    offsets, total = [], 0
    for number, n in counts:
        offsets.append((number, total))
        total += n
    starts = spark.createDataFrame(offsets, "numbered_part long, numbered_from long")
    placed = marked.withColumn("numbered_own", part).join(starts, F.expr("numbered_own = numbered_part"))
    place = F.col("numbered_from") + F.col(name).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.select(*[place.alias(name) if c == name else F.col(c) for c in marked.columns])


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def words(text: bytes | None) -> list[bytes]:
    """Maximal runs without the bytes 0x20 and 0x09-0x0D, with A-Z in lower case.

    ``bytes.lower`` and ``bytes.split`` treat exactly these characters.
    """
    return text.lower().split() if text else []


def byte_texts(column: pa.Array) -> list[bytes | None]:
    """An Arrow text column as UTF-8 bytes."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word met, computed once; emptied when it holds ``most`` words."""

    def __init__(self, most: int = 300_000) -> None:
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit affects every output bit."""
    values = (values ^ (values >> np.uint64(30))) * MIX_B
    values = (values ^ (values >> np.uint64(27))) * MIX_C
    return values ^ (values >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words; all words as one run if there are fewer."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    total = hashes[: len(hashes) - size + 1].copy()
    for k in range(1, size):
        total = mix(total * MIX_A) + hashes[k : len(hashes) - size + 1 + k]
    return mix(total * MIX_A)
