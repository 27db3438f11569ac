"""Best-fit packing of tokenized documents with swap-based local search.

Pieces of documents are dealt into groups. A group is packed by best fit, longest
first, and its underfull bins are then improved: documents are moved, exchanged one
for one, or two for one, whenever that raises the sum of squared fills, until bins
run empty. What is still badly filled goes on to a group of the next level, together
with the rest of its neighbours, up to a single last group. Every level's groups are
bounded: a group passes on no more than its share of the next group's size.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import saved

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED = PIECES + ", pack_row long, pack_group long, sequence_id long, offset long"


@dataclass(frozen=True)
class Packing:
    """``vocabulary`` and ``ranks``: the tokenizer's file for ``tokenizers`` and the same
    vocabulary as ranks; by default the public byte-level BPE installed on each executor.

    ``group``: pieces packed together; ``fan_in``: groups that meet in one of the next
    level; ``patience``: bins tried without success before a search ends; ``widest``: of
    the other bins, the roomiest that two-for-one exchanges look at. The last two bound the
    search and can cost sequences, never pieces.
    """

    capacity: int = 2048
    end_id: int = 0
    vocabulary: str | None = None
    ranks: str | None = None
    group: int = 20_000
    fan_in: int = 50
    patience: int = 60
    widest: int = 200


class Encoder:
    """Token ids of texts, as the tokenizer file has them.

    The ranks give the same ids several times faster; only a text that holds the
    tokenizer's special token goes to the tokenizer itself.
    """

    SPECIAL = "<|endoftext|>"
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, p: Packing) -> None:
        import base64

        import tiktoken

        if p.vocabulary is None or p.ranks is None:
            import public_tokenizers

        self.vocabulary = p.vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(p.ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.slow = None

    def ids(self, text: str) -> np.ndarray:
        if self.SPECIAL not in text:
            return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.vocabulary)
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: all full but the first."""
    first = length % capacity or min(length, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, length, capacity)]


def _pieces(p: Packing, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(p)
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text or ""), np.uint32(p.end_id)).astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), p.capacity)):
                    part = ids[start : start + length].tobytes()
                    for name, value in zip(rows, (doc_id, k, start, length, zlib.crc32(part), part)):
                        rows[name].append(value)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(rows[n], k) for n, k in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names=list(rows)[: 5 + with_ids])

    return run


def pieces(docs: DataFrame, p: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """The pieces of each document's token ids; ``with_ids`` adds them as little-endian bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_pieces(p, with_ids), PIECES + ", ids binary" * with_ids)


class Bins:
    """Bins of one group: their items (indexes into ``sizes``) and free space."""

    def __init__(self, sizes: list[int], capacity: int, widest: int = 200) -> None:
        self.sizes, self.capacity, self.widest = sizes, capacity, widest
        self.items: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that still has room."""
        by_free: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0  # bit r is set if some bin has r free
        for item in sorted(range(len(self.sizes)), key=self.sizes.__getitem__, reverse=True):
            size = self.sizes[item]
            room = mask >> size
            if room:
                left = size + (room & -room).bit_length() - 1
                k = by_free[left].pop()
                if not by_free[left]:
                    mask &= ~(1 << left)
                self.items[k].append(item)
            else:
                k, left = len(self.items), self.capacity
                self.items.append([item])
                self.free.append(left)
            left -= size
            self.free[k] = left
            if left:
                by_free[left].append(k)
                mask |= 1 << left

    def fill(self, k: int) -> int:
        return self.capacity - self.free[k]

    def shift(self, source: int, target: int, out: list[int], back: list[int]) -> None:
        """``out`` goes from source to target, ``back`` the other way."""
        for item in out:
            self.items[source].remove(item)
        for item in back:
            self.items[target].remove(item)
        self.items[source] += back
        self.items[target] += out
        change = sum(self.sizes[i] for i in out) - sum(self.sizes[i] for i in back)
        self.free[source] += change
        self.free[target] -= change

    def improve(self, patience: int) -> None:
        """Local search from the emptiest bins on.

        Any change takes load d > 0 from the bin at hand, a, to one that is at least as
        full, b, so that squared fill rises by 2 d (b - a + d). Integers below a bound
        rise only so often: the search ends.
        """
        tried = 0
        stuck: set[int] = set()
        while tried < patience:
            open_bins = [k for k in range(len(self.items)) if self.items[k] and self.free[k]]
            donors = [k for k in open_bins if k not in stuck]
            if len(open_bins) < 2 or not donors:
                return
            donor = min(donors, key=self.fill)
            others = sorted((k for k in open_bins if k != donor and self.fill(k) >= self.fill(donor)), key=self.free.__getitem__)
            moved = False
            while self.items[donor] and self._step(donor, others):
                moved = True
            if not self.items[donor]:
                tried = 0
            else:
                stuck.add(donor)
                tried += not moved

    def _step(self, donor: int, others: list[int]) -> bool:
        """One improving change: a move, else one for one, else two for one."""
        sizes, free = self.sizes, self.free
        own = sorted(self.items[donor], key=sizes.__getitem__, reverse=True)
        rooms = [k for k in others if free[k]]
        if not rooms:
            return False
        most = max(free[k] for k in rooms)
        for item in own:
            if sizes[item] <= most:
                target = min((k for k in rooms if free[k] >= sizes[item]), key=free.__getitem__)
                self.shift(donor, target, [item], [])
                return True
        flat = [(i, k) for k in rooms for i in self.items[k]]
        size = np.array([sizes[i] for i, _ in flat])
        room = np.array([free[k] for _, k in flat])
        for item in own:
            gain = sizes[item] - size
            gain[(gain <= 0) | (gain > room)] = 0
            best = int(gain.argmax())
            if gain[best] > 0:
                self.shift(donor, flat[best][1], [item], [flat[best][0]])
                return True
        for k in sorted(rooms, key=free.__getitem__, reverse=True)[:200]:
            if found := self._two_for_one(own, k):
                self.shift(donor, k, *found)
                return True
        return False

    def _two_for_one(self, own: list[int], k: int) -> tuple[list[int], list[int]] | None:
        """One item for two of bin k, or two items for one of it."""
        for one, pairs, forward in ((own, self.items[k], True), (self.items[k], own, False)):
            ordered = sorted(pairs, key=self.sizes.__getitem__)
            values = [self.sizes[i] for i in ordered]
            for item in one:
                size = self.sizes[item]
                for n, value in enumerate(values):
                    # forward: 0 < size - pair <= room; else 0 < pair - size <= room
                    low, high = (size - self.free[k], size - 1) if forward else (size + 1, size + self.free[k])
                    m = bisect.bisect_left(values, max(low - value, 0), n + 1)
                    if m < len(values) and value + values[m] <= high:
                        pair = [ordered[n], ordered[m]]
                        return ([item], pair) if forward else (pair, [item])
        return None


def _packed(p: Packing, level: int, last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "pack_row"], ascending=[False, True], kind="stable").reset_index(drop=True)
        bins = Bins(rows["length"].astype(int).tolist(), p.capacity, p.widest)
        bins.best_fit()
        bins.improve(p.patience)
        passed: set[int] = set()
        if not last:  # the emptiest bins go on, within this group's share of the next one
            share = p.group // p.fan_in
            for k in sorted((k for k in range(len(bins.items)) if bins.items[k]), key=bins.free.__getitem__, reverse=True):
                share -= len(bins.items[k])
                if share < 0 or bins.free[k] <= p.capacity // 100:
                    break
                passed.add(k)
        group = int(rows["pack_group"].iloc[0])
        sequence, offset = np.full(len(rows), -1, np.int64), np.zeros(len(rows), np.int64)
        for k, items in enumerate(bins.items):
            at = 0
            for item in items:
                sequence[item] = -1 if k in passed else (level << 57) | (group << 24) | k
                offset[item] = at
                at += bins.sizes[item]
        rows["sequence_id"], rows["offset"] = sequence, offset
        rows["pack_group"] = group // p.fan_in
        return rows[[c.split()[0] for c in PLACED.split(", ")]]

    return run


def packed(docs: DataFrame, p: Packing = Packing()) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row a piece.

    A null text is empty, and an empty text is one end id. Repeated rows are packed
    each for itself, a null id stays null, and no rows give no rows. Pieces longer than
    a sequence cannot occur. Other columns are not read.
    """
    made = saved(pieces(docs, p))
    groups = max(1, math.ceil(made.count() / p.group))
    row = F.monotonically_increasing_id()  # of the saved table: the same whenever it is read
    todo = made.withColumn("pack_row", row).withColumn("pack_group", F.pmod(F.xxhash64("pack_row"), F.lit(groups)))
    done, level = None, 0
    while True:
        last = groups == 1
        placed = saved(todo.groupBy("pack_group").applyInPandas(_packed(p, level, last), PLACED))
        kept = placed.filter("sequence_id >= 0").drop("pack_row", "pack_group")
        done = kept if done is None else done.union(kept)
        if last:
            return done
        todo = placed.filter("sequence_id < 0").drop("sequence_id", "offset")
        groups, level = math.ceil(groups / p.fan_in), level + 1


def sequences(docs: DataFrame, p: Packing = Packing()) -> DataFrame:
    """(sequence_id, ids, parts): the packed ids themselves and the pieces they hold."""
    places = packed(docs, p)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    texts = pieces(docs, p, with_ids=True).dropDuplicates(key)
    right = texts.select(*[F.col(c).alias(f"own_{c}") for c in key], "ids")
    whole = places.join(right, [F.col(c).eqNullSafe(F.col(f"own_{c}")) for c in key])
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))
    return whole.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.expr("aggregate(parts, cast('' as binary), (ids, part) -> concat(ids, part.ids))").alias("ids"),
        F.expr("transform(parts, part -> struct(part.offset, part.doc_id, part.piece, part.length))").alias("parts"),
    )
