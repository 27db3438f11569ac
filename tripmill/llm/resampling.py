"""Target-distribution importance resampling with bit-sliced aggregation.

Hashed runs of words are counted over the corpus and over a target set; the log ratio
of the two, scaled and rounded down, is a bucket's gain. A document's weight is the sum
of the gains of its features, and the documents drawn are those with the highest weight
plus Gumbel noise taken from their ids.

Weights are added up in bit slices. Bit k of all bucket counts of a document is one
plane of a bit per bucket; bit j of all gains, in two's complement, is another. The
buckets set in both contribute 2^(k+j) each, the sign plane with a minus, so a weight is
a sum of powers of two times population counts, without a rounding anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import LOWER, UPPER, byte_texts, numbered, saved


@dataclass(frozen=True)
class Resampling:
    """``longest`` is the longest run of words that is a feature; ``percent`` of the
    documents with ``least_words`` are drawn. ``block`` documents are sliced at a time:
    it bounds a task's memory, not its result.
    """

    buckets: int = 10_000
    longest: int = 1
    least_words: int = 20
    percent: int = 10
    scale: int = 1000
    seed: int = 2024
    block: int = 128


def _word_table() -> bytes:
    """Each byte as it counts: digits, a-z and all of 0x80 and above are letters, A-Z fold, the rest parts words."""
    table = bytearray(b" " * 256)
    for byte in range(256):
        if byte >= 0x80 or chr(byte) in "0123456789" + LOWER:
            table[byte] = byte
    for upper, lower in zip(UPPER, LOWER):
        table[ord(upper)] = ord(lower)
    return bytes(table)


class Buckets(dict):
    """The bucket of each feature met; emptied when it holds ``most``."""

    def __init__(self, buckets: int, most: int = 300_000) -> None:
        super().__init__()
        self.buckets, self.most, self.table = buckets, most, _word_table()

    def __missing__(self, feature: bytes) -> int:
        value = self[feature] = crc32(feature) % self.buckets
        return value

    def of(self, text: bytes | None, longest: int) -> tuple[int, np.ndarray]:
        """The number of words, and the bucket of every run of up to ``longest`` of them."""
        found = text.translate(self.table).split() if text else []
        if len(self) > self.most:
            self.clear()
        features = list(found)
        for size in range(2, longest + 1):
            features += [b" ".join(found[k : k + size]) for k in range(len(found) - size + 1)]
        return len(found), np.fromiter(map(self.__getitem__, features), np.int64, len(features))


def _counted(p: Resampling):
    """(bucket, n) of a task's texts: one array of counts a task, so at most ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, total = Buckets(p.buckets), np.zeros(p.buckets, np.int64)
        for batch in batches:
            for text in byte_texts(batch.column(0)):
                total += np.bincount(buckets.of(text, p.longest)[1], minlength=p.buckets)
        used = np.flatnonzero(total)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, p: Resampling) -> list[int]:
    """Features by bucket over all rows of ``texts`` (text); the driver gets one number a bucket."""
    rows = texts.select(F.col("text").cast("string")).mapInArrow(_counted(p), "bucket long, n long")
    counts = [0] * p.buckets
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(source: list[int], target: list[int], p: Resampling) -> list[int]:
    """floor(scale * ln of the smoothed ratio) for each bucket, in doubles."""
    s_all, t_all = float(sum(source) + p.buckets), float(sum(target) + p.buckets)
    return [
        math.floor(p.scale * math.log((float(t + 1) * s_all) / (float(s + 1) * t_all))) for s, t in zip(source, target)
    ]


def planes_of(gain: list[int]) -> tuple[np.ndarray, list[int]]:
    """Bit planes of the gains in two's complement, and what a bit of each plane is worth."""
    width = max(max(g.bit_length(), (~g).bit_length()) for g in gain) + 1
    values = np.array(gain, np.int64)
    bits = np.stack([(values >> j) & 1 for j in range(width)]).astype(np.uint8)
    return packed(bits), [1 << j for j in range(width - 1)] + [-(1 << (width - 1))]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    wide = np.zeros((len(bits), -(-bits.shape[1] // 64) * 64), np.uint8)
    wide[:, : bits.shape[1]] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


def sliced_weights(documents: list[np.ndarray], gain_planes: np.ndarray, worth: list[int], p: Resampling) -> list[int]:
    """The weight of each document, given as the buckets of its features."""
    n = len(documents)
    keys = np.concatenate([np.asarray(d, np.int64) + k * p.buckets for k, d in enumerate(documents)] or [np.zeros(0, np.int64)])
    cells, counts = np.unique(keys, return_counts=True)
    owner, bucket, totals = cells // p.buckets, cells % p.buckets, [0] * n
    for k in range(int(counts.max()).bit_length() if len(counts) else 0):
        there = (counts >> k) & 1 == 1
        rows, place = np.unique(owner[there], return_inverse=True)
        bits = np.zeros((len(rows), p.buckets), np.uint8)
        bits[place, bucket[there]] = 1
        plane = packed(bits)
        for gain_plane, value in zip(gain_planes, worth):
            both = np.bitwise_count(plane & gain_plane).sum(axis=1, dtype=np.int64)
            for row, found in zip(rows.tolist(), both.tolist()):
                totals[row] += (value << k) * found
    return totals


def _noise(doc_id: int | None, p: Resampling) -> int:
    h = int(sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-p.scale * math.log(-math.log((h + 0.5) / 4294967296)))


def _scored(p: Resampling, gain: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, (planes, worth) = Buckets(p.buckets), planes_of(gain)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            n_words, n_features, weights = [], [], []
            for start in range(0, len(texts), p.block):
                found = [buckets.of(text, p.longest) for text in texts[start : start + p.block]]
                n_words += [n for n, _ in found]
                n_features += [len(b) for _, b in found]
                weights += sliced_weights([b for _, b in found], planes, worth, p)
            scores = [w + _noise(i, p) for w, i in zip(weights, ids)]
            columns = [ids, n_features, weights, scores, n_words]
            names = ["doc_id", "n_features", "weight", "score", "n_words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return run


def resampled(docs: DataFrame, target: DataFrame, p: Resampling = Resampling()) -> DataFrame:
    """(doc_id, n_features, weight, score, rank, n_words) for each row of ``docs`` (doc_id, text).

    ``target`` (text) is what the drawn documents shall be like. Words are runs of ASCII
    letters and digits and of everything beyond ASCII, A-Z in lower case; a null or empty
    text has none, weighs 0 and, with fewer than ``least_words`` words, cannot be drawn.
    ``rank`` is null for documents that are not drawn. Rows that repeat an id share its
    noise, are scored on their own texts and may all be drawn; a null id counts as an
    empty text in the noise and comes before other ids in a tie. Of rows alike in all this
    any may come first. An empty target makes all gains depend on the corpus alone, and an
    empty ``docs`` gives no rows. Other columns are not read.

    The driver sees two counts a bucket and one a partition. The ranking sorts by ranges:
    no task holds more than its range, and equal keys spread over several.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(docs, p), bucket_counts(target, p), p)
    schema = "doc_id long, n_features long, weight long, score long, n_words long"
    scored = saved(docs.mapInArrow(_scored(p, gain), schema))
    able = F.col("n_words") >= p.least_words
    drawn = scored.filter(able).count() * p.percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features"), F.xxhash64(F.monotonically_increasing_id())]
    keyed = scored.filter(able).withColumn("spread", order[-1])
    ranked = numbered(keyed.repartitionByRange(*order[:-1], "spread").sortWithinPartitions(*order[:-1], "spread").drop("spread"), "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < drawn, F.col("rank") + 1))
    return ranked.unionByName(scored.filter(~able).withColumn("rank", F.lit(None).cast("long"))).select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words"
    )
