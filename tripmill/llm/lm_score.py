"""Language-model scores from a weighted backoff automaton.

The model is an n-gram model with Dirichlet smoothing: with c the training counts,

    p(w | h) = (c(h w) + K p(w | shorter h)) / (c(h) + K)

down to the word probabilities (c(w) + 1/2) / (N + (V + 1) / 2), the last unit being
any word outside the vocabulary. As an automaton, each history seen in training is a
state; a seen n-gram is an arc of its history's state that carries log10 p; every
state has a failure arc of weight log10(K / (c(h) + K)) to the state of the next
shorter history. A text is scored in one traversal from left to right.

The automaton of a whole corpus fits into no task, and it need not: documents are
dealt into blocks, and each block builds the part of the automaton that its texts can
reach. Blocks list their distinct n-grams, hashed, with their own counts; lists are
cut by hash range into buckets, each bucket sums its range over all blocks and sends
every block back the totals of its entries. A word that half
of all texts hold is one entry a block. Only N and V pass through the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import MIX_A, byte_texts, fold_of, mix

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
END = np.uint64(0x5851F42D4C957F2D)  # the hash of the end of a text
MESSAGE = "bucket long, block long, keys binary, counts binary"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


@dataclass(frozen=True)
class BackoffModel:
    """``order``: longest n-gram; ``strength``: K, the weight of the shorter history.

    ``block_bytes`` is how much text a block holds on average, which
    bounds a task's memory (a single longer text makes a larger block). N-grams travel as
    ``hash_bits`` bits of hash: among 10^13 of them one in 7,000 shares its own.
    """

    order: int = 2
    strength: float = 200.0
    folds: int = 5
    held_out: int = 1
    block_bytes: int = 4_000_000
    hash_bits: int = 56
    least_buckets: int = 64


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers, small: byte by byte of all values, then compressed."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def unpacked(data: bytes, kind: type) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def tokens(texts: list[bytes], batch: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, with one for the end after each text, and their number by text.

    Words are runs without the bytes 0x20 and 0x09-0x0D, with A-Z in lower case. A word's
    hash is a polynomial of its bytes, taken from sums over the whole batch and mixed.
    """
    hashes, lengths, begin = [], [], 0
    while begin < len(texts):
        stop, size = begin, 0
        while stop < len(texts) and (size < batch or stop == begin):
            size += len(texts[stop]) + 1
            stop += 1
        data = np.frombuffer((b"\n".join(texts[begin:stop]) + b"\n").lower(), np.uint8)
        starts_of = np.cumsum([0] + [len(t) + 1 for t in texts[begin : stop - 1]])
        blank = np.concatenate([[True], SPACE[data]])
        change = np.flatnonzero(blank[1:] != blank[:-1])
        starts, stops = change[0::2], change[1::2]
        power = np.cumprod(np.full(len(data), BASE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data + np.uint64(1)) * power, dtype=np.uint64)])
        shift = np.cumprod(np.full(len(data) + 1, BASE_INVERSE))[starts]
        found = mix((sums[stops] - sums[starts]) * shift + (stops - starts).astype(np.uint64) * MIX_A)
        counts = np.diff(np.append(np.searchsorted(starts, starts_of), len(starts)))
        out = np.full(len(found) + len(counts), END, np.uint64)
        out[np.arange(len(found)) + np.repeat(np.arange(len(counts)), counts)] = found
        hashes.append(out)
        lengths.append(counts + 1)
        begin = stop
    none = np.empty(0, np.int64)
    return np.concatenate([none.astype(np.uint64), *hashes]), np.concatenate([none, *lengths])


class Grams:
    """The distinct n-grams of a block's texts, numbered, and the places where they end.

    ``of[k]`` holds, for order k + 1: a 64-bit hash of each, its number ``at`` each
    position (-1 where the text is too short for one), and a position of each.
    """

    def __init__(self, texts: list[bytes], order: int) -> None:
        flat, self.lengths = tokens(texts)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        word, hashes = pd.factorize(flat)
        first = np.zeros(len(hashes), np.int64)
        first[word[::-1]] = np.arange(len(word))[::-1]
        self.of = [(hashes, word, first)]
        inner = np.ones(len(word), bool)  # whether the token before is of the same text
        inner[self.starts[:-1]] = False
        for k in range(1, order):
            above, before, _ = self.of[-1]
            ends = np.flatnonzero(inner[1:] & (before[:-1] >= 0)) + 1
            pairs, kinds = pd.factorize(before[ends - 1] * len(hashes) + word[ends])
            at = np.full(len(word), -1, np.int64)
            at[ends] = pairs
            place = np.zeros(len(kinds), np.int64)
            place[pairs[::-1]] = ends[::-1]
            self.of.append((mix(above[before[place - 1]] * MIX_A + hashes[word[place]] + np.uint64(k)), at, place))

    def counts(self, train: np.ndarray) -> list[np.ndarray]:
        """How often each n-gram occurs in training texts, by order."""
        inside = np.repeat(train, self.lengths)
        return [np.bincount(at[inside & (at >= 0)], minlength=len(keys)) for keys, at, _ in self.of]

    def sorted_keys(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``bits`` bits of all orders' hashes, ascending, and their order."""
        keys = np.concatenate([keys for keys, _, _ in self.of]) >> np.uint64(64 - bits)
        order = np.argsort(keys, kind="stable")
        return keys[order], order


class Automaton:
    """The states, weighted arcs and failure arcs along the texts of one block.

    Before a token, the state that history of d words names is known by its depth d.
    ``arcs[d]`` has, for each token, the weight of its arc from that state, or NaN where
    there is none, and ``fails[d]`` the weight of the state's failure arc to depth d - 1.
    A history that training lacks is no state: it fails at no cost.
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], total: int, kinds: int, strength: float) -> None:
        lower = np.log10((counts[0] + 0.5) / (total + 0.5 * (kinds + 1)))
        self.arcs, self.fails = [lower[grams.of[0][1]]], [np.zeros(len(grams.of[0][1]))]
        for k in range(1, len(counts)):
            (_, before, _), (_, at, place) = grams.of[k - 1 : k + 1]
            history, suffix = before[place - 1], before[place]
            seen = counts[k] > 0
            value = np.full(len(place), np.nan)
            below = 10.0 ** lower[suffix[seen]]
            value[seen] = np.log10((counts[k][seen] + strength * below) / (counts[k - 1][history[seen]] + strength))
            fail = np.log10(strength / (counts[k - 1] + strength))  # 0 for a history not seen
            inside = at >= 0
            arcs, fails = np.full(len(at), np.nan), np.zeros(len(at))
            arcs[inside] = value[at[inside]]
            fails[inside] = fail[history[at[inside]]]
            self.arcs.append(arcs)
            self.fails.append(fails)
            lower = value

    def score(self, first: int, last: int) -> float:
        """log10 probability of the tokens from first to last - 1, in one traversal."""
        arcs = [a[first:last].tolist() for a in self.arcs]
        fails = [f[first:last].tolist() for f in self.fails]
        depth, total, most = 0, 0.0, len(arcs) - 1
        for k in range(last - first):
            weight = arcs[depth][k]
            while weight != weight:  # no arc: fall back
                total += fails[depth][k]
                depth -= 1
                weight = arcs[depth][k]
            total += weight
            if depth < most:
                depth += 1
        return total


def _texts(docs: pd.DataFrame) -> list[bytes]:
    return [b"" if t is None else bytes(t) for t in docs["text"]]


def _cuts(keys: np.ndarray, buckets: int, bits: int) -> np.ndarray:
    """Where each bucket's hash range begins among sorted keys, and the end."""
    bounds = np.array([(k << bits) // buckets for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, bounds), [len(keys)]])


def _requests(model: BackoffModel, buckets: int):
    """A message to each bucket in whose hash range the block has n-grams."""

    def run(docs: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(_texts(docs), model.order)
        keys, order = grams.sorted_keys(model.hash_bits)
        counts = np.concatenate(grams.counts(~docs["held_out"].to_numpy(bool)))[order].astype(np.uint32)
        cuts, block, rows = _cuts(keys, buckets, model.hash_bits), docs["block"].iloc[0], []
        for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            part = slice(cuts[k], cuts[k + 1])
            rows.append((k, block, packed(np.diff(keys[part], prepend=np.uint64(0))), packed(counts[part])))
        return pd.DataFrame(rows, columns=["bucket", "block", "keys", "counts"])

    return run


def _totals(messages: pd.DataFrame) -> pd.DataFrame:
    """Sums one hash range over all blocks and answers each in the order of its keys."""
    asked = [np.cumsum(unpacked(bytes(d), np.uint64), dtype=np.uint64) for d in messages["keys"]]
    counts = np.concatenate([unpacked(bytes(d), np.uint32) for d in messages["counts"]])
    number, kinds = pd.factorize(np.concatenate(asked))
    total = np.bincount(number, counts, minlength=len(kinds)).astype(np.uint32)[number]
    ends = np.cumsum([len(a) for a in asked])
    parts = np.split(total, ends[:-1])
    return pd.DataFrame(
        {"bucket": messages["bucket"], "block": messages["block"], "keys": b"", "counts": [packed(p) for p in parts]}
    )


def _scores(model: BackoffModel, buckets: int, total: int, kinds: int):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        grams = Grams(_texts(docs), model.order)
        keys, order = grams.sorted_keys(model.hash_bits)
        cuts, flat = _cuts(keys, buckets, model.hash_bits), np.zeros(len(keys), np.int64)
        for k, data in zip(answers["bucket"], answers["counts"]):
            flat[order[cuts[k] : cuts[k + 1]]] = unpacked(bytes(data), np.uint32)
        by_order = np.split(flat, np.cumsum([len(keys) for keys, _, _ in grams.of])[:-1])
        automaton = Automaton(grams, by_order, total, kinds, model.strength)
        base = np.log10((by_order[0] + 0.5) / (total + 0.5 * (kinds + 1)))
        known = by_order[0] > 0
        rows = []
        for k in range(len(docs)):
            first, last = grams.starts[k : k + 2].tolist()
            text = grams.of[0][1][first:last]
            rows.append((len(text), known[text].sum(), total, base[text].sum(), automaton.score(first, last)))
        out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "train_tokens", "base_score", "score"])
        return pd.concat([docs[["doc_id", "held_out"]].reset_index(drop=True), out], axis=1)

    return run


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct training words of a task by hash, and how many tokens they are."""
    for batch in batches:
        found, _ = tokens(byte_texts(batch.column(0)))
        if len(found):
            kinds = pd.unique(found).view(np.int64)
            counts = np.zeros(len(kinds), np.int64)
            counts[0] = len(found)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(counts)], names=["word", "tokens"])


def lm_scores(docs: DataFrame, model: BackoffModel = BackoffModel()) -> DataFrame:
    """Scores each text of ``docs`` (doc_id, text) under a model learnt from ``docs``.

    Texts whose id's crc32 modulo ``folds`` is not ``held_out`` are learnt from. Words
    are runs without white space, A-Z in lower case, then one end of text. A null or
    empty text is its end alone; a null id counts as an empty one; repeated rows each
    count and each get a score. No rows give no rows. Without training texts N is 0 and
    every word has the same probability. Other columns are not read.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    size = docs.agg(F.sum(F.length("text") + 32)).first()[0] or 0
    held_out = fold_of(F.col("doc_id"), model.folds) == model.held_out
    met = docs.filter(~held_out).select("text").mapInArrow(_vocabulary, "word long, tokens long")
    kinds, total = met.groupBy("word").agg(F.sum("tokens").alias("n")).agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, math.ceil(size / model.block_bytes))
    buckets = max(model.least_buckets, blocks // 2)
    # by content as well, so that rows which share an id, or have none, still spread
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks))
    dealt = docs.select("doc_id", "text", held_out.alias("held_out"), block.alias("block"))
    asked = dealt.groupBy("block").applyInPandas(_requests(model, buckets), MESSAGE)
    answered = asked.groupBy("bucket").applyInPandas(_totals, MESSAGE)
    pairs = dealt.groupBy("block").cogroup(answered.groupBy("block"))
    return pairs.applyInPandas(_scores(model, buckets, total, kinds), SCORES)
