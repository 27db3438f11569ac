"""Benchmark decontamination by q-gram filtering and banded alignment.

A text region that becomes a benchmark item of m characters by at most k edits shares
at least (m - q + 1) - k q of the item's q-grams with it, and the shared q-grams lie on
diagonals (place in the text less place in the item) that differ by no more than k. q is
8, or less for an item whose budget would leave no q-gram to share. So
shared q-grams are counted in diagonal bands of 2 (k + 1), which overlap by half: any
such region lies whole in one band. Bands that reach the bound are aligned with the
item inside the band, and kept if the edit distance is within the budget.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import saved

FOUND = "items array<long>, spans array<struct<item_id: long, start: long, end: long, edits: int>>"


@dataclass(frozen=True)
class Decontamination:
    """``edits``: share of an item's characters that may be edited.

    Characters are compared after A-Z went to lower case and each run of white space
    to one blank. An item of fewer than q characters is found where it stands between
    blanks or a text's ends, unedited. ``part_chars`` bounds how much of the benchmark
    the driver and a task hold: a larger benchmark takes more passes, and the documents
    with what was found so far are written between them.
    """

    q: int = 8
    edits: float = 0.1
    part_chars: int = 8_000_000
    batch_chars: int = 400_000


def characters(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Normalized code points, and the place of each in the text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    codes = np.where((codes >= 9) & (codes <= 13), 32, codes).astype(np.uint32)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    places = np.flatnonzero(keep)
    return codes[places], places


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each place on."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    wide = codes.astype(np.uint64) + np.uint64(1)
    total, have, power = np.zeros(n, np.uint64), 0, 1  # runs of 1, 2, 4, ... characters
    run, factor = wide, np.array([0x9E3779B97F4A7C15], np.uint64)
    while True:
        if q & power:
            total = total * factor + run[have : have + n]
            have += power
        if have == q:
            break
        run = run[:-power] * factor + run[power:]
        factor = factor * factor
        power *= 2
    total ^= total >> np.uint64(29)
    return total * np.uint64(0xBF58476D1CE4E5B9)


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the region nearest to the item, if within ``most`` edits.

    Only cells on diagonals low .. low + width - 1 count (text place less item place).
    Ends are free in the text. Among equals the first end is taken.
    """
    huge = 1 << 20
    span = np.arange(width)
    starts = low + span
    valid = (starts >= 0) & (starts <= len(text))
    row = np.where(valid, 0, huge)  # row 0: no item character used, any start
    begin = starts.copy()
    padded = np.concatenate([text, np.array([0xFFFFFFFF], np.uint32)])
    for i in range(len(item)):
        at = low + i + span  # text characters used before this row's step on the diagonal
        inside = (at >= 0) & (at < len(text))
        same = padded[np.where(inside, at, len(text))] == item[i]
        step = np.where(inside, row + ~same, huge)  # replace or keep, same diagonal
        drop = np.append(row[1:] + 1, huge)  # item character without partner
        origin = np.where(drop < step, np.append(begin[1:], 0), begin)
        new = np.minimum(step, drop)
        # text character without partner: from the left, cost 1 each
        reach = new - span
        best = np.minimum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == best, span, 0))
        row = np.minimum(best + span, huge)
        begin = origin[source]
        edge = low + i + 1 + span
        row = np.where((edge >= 0) & (edge <= len(text)), row, huge)
        if row.min() > most:
            return None
    k = int(row.argmin())
    if row[k] > most:
        return None
    return int(row[k]), int(begin[k]), int(low + len(item) + k)


def item_codes(text: str | None) -> np.ndarray:
    """An item's normalized code points, without blanks at its ends."""
    codes, _ = characters(text or "")
    codes = codes[1:] if len(codes) and codes[0] == 32 else codes
    return codes[:-1] if len(codes) and codes[-1] == 32 else codes


class Benchmark:
    """The indexes of some benchmark items: one for each q that their budgets ask for, and the short ones."""

    def __init__(self, items: list[tuple[int, str]], p: Decontamination) -> None:
        self.p, self.short = p, {}
        by_q: dict[int, list] = {}
        for item_id, text in items:
            codes = item_codes(text)
            if len(codes) >= p.q:
                by_q.setdefault(min(p.q, len(codes) // (int(p.edits * len(codes)) + 1)), []).append((item_id, codes))
            elif len(codes):
                self.short.setdefault(codes.tobytes(), []).append(item_id)
        self.indexes = [Index(found, q, p) for q, found in sorted(by_q.items())]

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, start, end, edits) for each text, in characters of the text."""
        out: list[list[tuple[int, int, int, int]]] = [self._whole(t) if self.short else [] for t in texts]
        for index in self.indexes:
            for rows, more in zip(out, index.find(texts)):
                rows += more
        return out

    def _whole(self, text: str) -> list[tuple[int, int, int, int]]:
        """Short items as runs of whole words."""
        codes, where = characters(text)
        blank = codes == 32
        starts = np.flatnonzero(~blank & np.append(True, blank[:-1])).tolist()
        ends = (np.flatnonzero(~blank & np.append(blank[1:], True)) + 1).tolist()
        found = []
        for k, start in enumerate(starts):
            for end in ends[k : k + self.p.q]:  # words are parted by a blank each
                if end - start >= self.p.q:
                    break
                for item_id in self.short.get(codes[start:end].tobytes(), ()):
                    found.append((item_id, int(where[start]), int(where[end - 1]) + 1, 0))
        return found


class Index:
    """The q-gram index of items that share their q."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int, p: Decontamination) -> None:
        self.p, self.q = p, q
        self.ids, self.codes, self.budget, self.bound = [], [], [], []
        grams, owner, place = [], [], []
        for item_id, codes in items:
            found = gram_hashes(codes, q)
            k = int(p.edits * len(codes))
            grams.append(found)
            owner.append(np.full(len(found), len(self.ids)))
            place.append(np.arange(len(found)))
            self.ids.append(item_id)
            self.codes.append(codes)
            self.budget.append(k)
            self.bound.append(len(found) - k * q)
        self.budget, self.bound = np.array(self.budget, np.int64), np.array(self.bound, np.int64)
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = np.concatenate(owner)[order], np.concatenate(place)[order]
        self.grams, self.first, self.many = np.unique(flat[order], return_index=True, return_counts=True)
        self.maybe = np.zeros(1 << 22, bool)  # small enough for a processor's cache
        self.maybe[self.grams >> np.uint64(42)] = True

    def find(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, start, end, edits) for each text, in characters of the text."""
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        batch, size = [], 0
        for n, text in enumerate(texts):
            batch.append(n)
            size += len(text)
            if size >= self.p.batch_chars or n == len(texts) - 1:
                self._find(batch, texts, out)
                batch, size = [], 0
        return out

    def _exact(self, m: int, codes: np.ndarray, low: int, width: int) -> tuple[int, int, int] | None:
        """The item itself on the first diagonal of the band that has it."""
        item = self.codes[m]
        first, last = max(low, 0), min(low + width, len(codes) - len(item) + 1)
        at = codes[first : max(first, last)] == item[0]
        for d in (first + np.flatnonzero(at)).tolist():
            if (codes[d : d + len(item)] == item).all():
                return 0, d, d + len(item)
        return None

    def _find(self, batch: list[int], texts: list[str], out: list) -> None:
        both = [characters(texts[n]) for n in batch]
        codes = [c for c, _ in both]
        lengths = np.array([len(c) for c in codes])
        starts = np.cumsum(lengths) - lengths
        flat = np.concatenate(codes)
        hashes = gram_hashes(flat, self.q)
        spot = np.flatnonzero(self.maybe[hashes >> np.uint64(42)])
        known = np.searchsorted(self.grams, hashes[spot])
        known = np.minimum(known, len(self.grams) - 1)
        spot, known = (x[self.grams[known] == hashes[spot]] for x in (spot, known))
        doc = np.searchsorted(starts, spot, side="right") - 1
        # empty texts share their start with the next one; the last of equals holds the place
        inside = spot - starts[doc] + self.q <= lengths[doc]
        spot, known, doc = spot[inside], known[inside], doc[inside]
        many = self.many[known]
        entry = np.repeat(self.first[known] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        item, place = self.owner[entry], self.place[entry]
        doc, local = np.repeat(doc, many), np.repeat(spot - starts[doc], many)
        # first without bands: most documents share too little with an item as a whole
        pair = doc * len(self.ids) + item
        found, back, total = np.unique(pair, return_inverse=True, return_counts=True)
        enough = (total >= self.bound[found % len(self.ids)])[back]
        pair, place, local = pair[enough], place[enough], local[enough]
        step = self.budget[pair % len(self.ids)] + 1
        band = (local - place) // step  # of two overlapping bands, the one that begins here
        keys = np.stack([np.tile(pair, 2), np.concatenate([band, band - 1]), np.tile(place, 2)])
        keys = keys[:, np.lexsort(keys[::-1])]
        # an item's q-gram counts once in a band, however often the text repeats it
        keys = keys[:2, np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])] if keys.shape[1] else keys[:2]
        new = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if keys.shape[1] else np.empty(0, int)
        count = np.diff(np.append(new, keys.shape[1]))
        for both_of, b in keys[:, new[count >= self.bound[keys[0, new] % len(self.ids)]]].T.tolist():
            n, m = divmod(both_of, len(self.ids))
            k = int(self.budget[m])
            hit = self._exact(m, codes[n], b * (k + 1), 2 * (k + 1))
            hit = hit or banded_distance(self.codes[m], codes[n], b * (k + 1), 2 * (k + 1), k)
            if hit:
                edits, start, end = hit
                where = both[n][1]
                span = (self.ids[m], int(where[start]), int(where[end - 1]) + 1, edits)
                rows = out[batch[n]]
                touching = [r for r in rows if r[0] == span[0] and r[1] < span[2] and span[1] < r[2]]
                if all(span[3] < r[3] for r in touching):  # of overlapping bands' finds, the nearest
                    out[batch[n]] = [r for r in rows if r not in touching] + [span]


def _finder(items: list[tuple[int, str]], p: Decontamination):
    @F.pandas_udf(FOUND)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        benchmark = Benchmark(items, p)
        for batch in texts:
            found = [sorted(rows) for rows in benchmark.find([t or "" for t in batch])]
            yield pd.DataFrame(
                {
                    "items": [sorted({r[0] for r in rows}) for rows in found],
                    "spans": [[dict(zip(("item_id", "start", "end", "edits"), r)) for r in rows] for rows in found],
                }
            )

    return run


def _parts(benchmark: DataFrame, p: Decontamination) -> Iterator[list[tuple[int, str]]]:
    """The benchmark in parts of a bounded size, collected one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id is not null and text is not null").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-chars // p.part_chars))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield sorted((r.item_id, r.text) for r in items.filter(number == k).collect())


def findings(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination(), name: str = "found") -> DataFrame:
    """``docs`` with a column ``name``: the benchmark items in each text and where they lie.

    Spans are code points of the text, end exclusive. A null or empty text holds
    nothing; a benchmark row without id or text is left out, and repeated ones count
    once; rows, nulls and further columns of ``docs`` stay as they are. A column of
    ``docs`` that is already called ``name`` raises an error.
    """
    if name in docs.columns:
        raise ValueError(f"docs has a column {name} already")
    parts = _parts(benchmark, p)
    items = next(parts)
    text = F.col("text").cast("string")
    while True:
        one = _finder(items, p)(text)
        if name in docs.columns:
            had = F.col(name)
            one = F.struct(F.concat(had["items"], one["items"]).alias("items"), F.concat(had["spans"], one["spans"]).alias("spans"))
        docs = docs.withColumn(name, one)
        items = next(parts, None)
        if items is None:
            return docs
        docs = saved(docs)  # neither the driver nor a task holds two parts


def clean(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination()) -> DataFrame:
    """The rows of ``docs`` whose texts hold no benchmark item."""
    name = "benchmark_items"
    while name in docs.columns:
        name += "_"
    return findings(docs, benchmark, p, name).filter(F.size(F.col(name)["items"]) == 0).drop(name)
