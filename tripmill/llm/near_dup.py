"""MinHash near-duplicates with odd sketches.

Each document gets MinHash samples of its word shingles. Bands of samples name
buckets; documents that share a bucket are candidates. The samples are also folded
into an odd sketch, a parity bitmap in which sample (i, value) flips one bit: the
number of bits in which two sketches differ estimates the similarity, and rejects
most false candidates before texts are compared. What remains is confirmed on the
full shingle sets.

Buckets may be very large, so pairs are never listed within one. First every member
is paired with the smallest one only; the confirmed links form components. Then just
the buckets that still hold several components are searched for links between them:
small ones by a join, large ones in blocks inside tasks, where the documents outside
the bucket's main component are compared with all others, first by their sketches. Of
the links found, a task sends on no more than join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import WordHashes, byte_texts, fitted, saved, shingle_hashes, words
from tripmill.llm.components import components

FEW = 16  # members up to which all pairs of a bucket are joined
SIGNATURE = "doc_id long, digest binary, n_shingles long, sketch array<long>, bands array<long>"


@dataclass(frozen=True)
class NearDuplicates:
    """``similarity`` in percent of the union.

    A pair at similarity s is missed with probability (1 - s^rows)^bands: at 0.8, with
    40 bands of 4 samples, 7e-10. ``slack`` is how far below the threshold a sketch
    estimate may lie: with 0.3 a pair at 0.8 is lost with probability 4e-8. ``block`` bounds how
    many documents a task compares with four times as many others at a time.
    """

    shingle: int = 5
    similarity: int = 80
    bands: int = 40
    rows: int = 4
    sketch_bits: int = 512
    slack: float = 0.3
    block: int = 512
    seed: int = 20240607

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """Differing sketch bits beyond which a pair is no candidate.

        Samples that differ flip two bits, so bits differ with probability
        (1 - exp(-4 k (1 - s) / n)) / 2 each.
        """
        s = max(0.0, self.similarity / 100 - self.slack)
        return int(np.ceil(self.sketch_bits * (1 - np.exp(-4 * self.samples * (1 - s) / self.sketch_bits)) / 2))


def minima(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest value of each of len(a) hash functions over the shingles."""
    low = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), 4096):
        np.minimum(low, (short[start : start + 4096][None, :] * a[:, None] + b[:, None]).min(axis=1), out=low)
    return low


def _signatures(p: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(p.seed)
        a = draw.integers(0, 2**32, p.samples, np.uint32) | np.uint32(1)
        b = draw.integers(0, 2**32, p.samples, np.uint32)
        salt = draw.integers(0, 2**64, (p.bands, (p.rows + 1) // 2), np.uint64) | np.uint64(1)
        place = draw.integers(0, 2**32, p.samples, np.uint64)
        hashes = WordHashes()
        long_lists = pa.list_(pa.int64())
        for batch in batches:
            ids = batch.column(0)
            out: dict[str, list] = {"digest": [], "n_shingles": [], "sketch": [], "bands": []}
            for text in byte_texts(batch.column(1)):
                found = words(text)
                shingles = np.unique(shingle_hashes(hashes.of(found), p.shingle))
                out["n_shingles"].append(len(shingles))
                if not len(shingles):
                    for name in ("digest", "sketch", "bands"):
                        out[name].append(None)
                    continue
                low = minima(shingles, a, b)
                # a sample's bit: any function of its number and value that spreads well
                spots = ((low.astype(np.uint64) + place) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
                flips = np.bincount((spots % np.uint64(p.sketch_bits)).astype(np.int64), minlength=p.sketch_bits) & 1
                wide = np.zeros((p.bands, salt.shape[1] * 2), np.uint32)
                wide[:, : p.rows] = low.reshape(p.bands, p.rows)
                band = (wide.view(np.uint64) * salt).sum(axis=1, dtype=np.uint64)
                band = (band ^ (band >> np.uint64(29))) * salt[:, 0]
                out["digest"].append(xxhash.xxh3_128_digest(b" ".join(found)))
                out["sketch"].append(np.packbits(flips.astype(np.uint8)).view(np.int64))
                out["bands"].append(band.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(out["digest"], pa.binary()),
                    pa.array(out["n_shingles"], pa.int64()),
                    pa.array(out["sketch"], long_lists),
                    pa.array(out["bands"], long_lists),
                ],
                names=["doc_id", "digest", "n_shingles", "sketch", "bands"],
            )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, digest, text) of the rows that have words, with the signatures' digest."""
    for batch in batches:
        found = [words(text) for text in byte_texts(batch.column(1))]
        digests = pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in found], pa.binary())
        columns = [batch.column(0), digests, batch.column(1)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "digest", "text"]).filter(digests.is_valid())


def _same_set(left: bytes, right: bytes, p: NearDuplicates) -> bool:
    a, b = (_sets(words(t), p.shingle) for t in (left, right))
    both = len(a & b)
    return 100 * both >= p.similarity * (len(a) + len(b) - both)


def _sets(found: list[bytes], size: int) -> set[bytes]:
    if len(found) < size:
        return {b" ".join(found)} if found else set()
    return {b" ".join(found[k : k + size]) for k in range(len(found) - size + 1)}


def _confirmed(p: NearDuplicates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = byte_texts(batch.column(2)), byte_texts(batch.column(3))
            keep = pa.array([_same_set(x, y, p) for x, y in zip(left, right)], pa.bool_())
            yield batch.select([0, 1]).filter(keep)

    return run


def _open_links(p: NearDuplicates):
    """Links between documents of the two sides that lie in different components.

    A pair that shares several buckets is looked at in its first one. Of the links of a
    document to one component a single one is sent on.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        side, ids, sizes, comp = (rows[c].to_numpy() for c in ("side", "id", "n", "comp"))
        bits, bands = (np.stack(rows[c].to_list()).astype(np.int64) for c in ("sketch", "bands"))
        bits, band, hashes, sets = bits.view(np.uint64), int(rows["band"].iloc[0]), WordHashes(), {}

        def shingles(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = np.unique(shingle_hashes(hashes.of(words(rows["text"].iloc[k].encode())), p.shingle))
            return sets[k]

        right, found = np.flatnonzero(side == 1), []
        for x in np.flatnonzero(side == 0).tolist():
            y = right[comp[right] != comp[x]]
            small, large = np.minimum(sizes[x], sizes[y]), np.maximum(sizes[x], sizes[y])
            y = y[100 * small >= p.similarity * large]
            y = y[np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1) <= p.most_bits]
            y = y[(bands[y] == bands[x]).argmax(axis=1) == band]
            if not len(y):
                continue
            own, others = shingles(x), [shingles(k) for k in y.tolist()]
            flat = np.concatenate(others)
            met = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            starts = np.cumsum([0] + [len(o) for o in others[:-1]])
            both = np.add.reduceat(met.astype(np.int64), starts)
            y = y[100 * both >= p.similarity * (sizes[x] + sizes[y] - both)]
            _, one = np.unique(comp[y], return_index=True)
            found += [(min(ids[x], ids[k]), max(ids[x], ids[k])) for k in y[one]]
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    return run


def near_duplicates(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text).

    Words are runs without white space, A-Z in lower case. A document with fewer words
    than a shingle has its whole sequence as its one shingle; an empty or null text has
    none, links with nothing and is kept. Rows that share an id are one node: they get
    the same component, and repeated rows are all marked alike. A row without an id
    links with nothing: its component is null and it is kept. Exact copies collapse
    to their smallest id before any search. Other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = saved(docs.mapInArrow(_signatures(p), SIGNATURE))
    usable = marked.filter("doc_id is not null and digest is not null")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = saved(usable.select("doc_id", "digest").join(classes, "digest").select("doc_id", "rep").distinct())

    heads = saved(
        usable.join(classes.select(F.col("digest").alias("head"), "rep"), F.expr("digest = head and doc_id = rep"))
        .select(F.col("doc_id").alias("id"), "digest", F.col("n_shingles").alias("n"), "sketch", "bands")
        .dropDuplicates(["id", "digest"])
    )
    entries = heads.select("id", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "band", "id"
    )
    buckets = entries.groupBy("bucket").agg(F.min("id").alias("least"), F.max("id").alias("most"))
    shared = saved(
        entries.join(buckets.filter("least <> most").select(F.col("bucket").alias("full"), "least"), F.expr("bucket = full"))
        .select("bucket", "band", "id", "least")
    )

    facts = heads.select("id", "n", "sketch")
    wanted = shared.select("id").distinct()
    texts = docs.join(wanted, F.col("doc_id") == F.col("id"), "left_semi")
    texts = saved(texts.mapInArrow(_digests, "doc_id long, digest binary, text string"))

    def near(pairs: DataFrame, rows: int) -> DataFrame:
        """Pairs (a, b), no more than ``rows``, whose sizes and sketches allow the similarity."""
        left = facts.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
        right = facts.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
        apart = F.expr("aggregate(zip_with(s_a, s_b, (x, y) -> bit_count(x ^ y)), 0, (t, x) -> t + x)")
        return (
            fitted(fitted(pairs, rows).join(left, "a"), rows)
            .join(right, "b")
            .filter(f"100 * least(n_a, n_b) >= {p.similarity} * greatest(n_a, n_b)")
            .filter(apart <= p.most_bits)
            .select("a", "b")
        )

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        return both.mapInArrow(_confirmed(p), "a long, b long")

    stars = shared.filter("id <> least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    # an id with several texts joins the classes of all of them
    several = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("last"))
    several = several.filter("a <> last").select(F.col("doc_id").alias("node"), "a")
    joined = member.join(several, F.expr("doc_id = node")).select("a", F.col("rep").alias("b"))
    links = saved(confirmed(near(stars, shared.count())).union(joined))
    label = components(links)

    # what the stars leave open: buckets that still hold several components
    placed = shared.join(label.withColumnRenamed("id", "node"), F.expr("id = node"), "left")
    placed = placed.select("bucket", "band", "id", F.coalesce("component_id", "id").alias("comp"))
    parties = placed.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    state = parties.groupBy(F.col("bucket").alias("open")).agg(
        F.sum("size").alias("members"), F.max(F.struct("size", "comp")).alias("major"), F.count("*").alias("parties")
    )
    state = state.filter("parties > 1").select(
        "open", "members", F.col("major.comp").alias("main"), F.expr("members - major.size").alias("others")
    )
    rest = saved(placed.join(state, F.expr("bucket = open")).drop("open"))
    # a pair of a small bucket needs one of its members, of which each has few others
    pairs = rest.count() * FEW
    small = rest.filter(f"members <= {FEW}")
    other = small.select(F.col("bucket").alias("bucket_b"), F.col("id").alias("b"), F.col("comp").alias("comp_b"))
    few = small.select("bucket", F.col("id").alias("a"), "comp").join(
        other, F.expr("bucket = bucket_b and a < b and comp <> comp_b")
    )
    # documents outside the bucket's main component, against all: rows grow with its members, not their pairs
    large = (
        rest.filter(f"members > {FEW}")
        .withColumn("i_parts", F.ceil(F.col("others") / p.block).cast("int"))
        .withColumn("j_parts", F.ceil(F.col("members") / (4 * p.block)).cast("int"))
    )
    left = (
        large.filter("comp <> main")
        .withColumns({"side": F.lit(0), "i": F.expr("cast(pmod(xxhash64(id), i_parts) as int)")})
        .withColumn("j", F.explode(F.expr("sequence(0, j_parts - 1)")))
    )
    right = large.withColumns({"side": F.lit(1), "j": F.expr("cast(pmod(xxhash64(id, 1), j_parts) as int)")}).withColumn(
        "i", F.explode(F.expr("sequence(0, i_parts - 1)"))
    )
    columns = ["bucket", "band", "i", "j", "side", "id", "comp"]
    # an id may have several texts, also ones without words
    contents = heads.select(F.col("id").alias("node"), "digest", "n", "sketch", "bands").join(
        texts.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_text"), "text"),
        F.expr("node = of and digest = of_text"),
    )
    sides = left.select(*columns).union(right.select(*columns)).join(contents, F.expr("id = node"))
    sides = sides.select(*columns, "n", "sketch", "bands", "text").groupBy("bucket", "i", "j")
    many = sides.applyInPandas(_open_links(p), "a long, b long")
    late = confirmed(near(few.select("a", "b").distinct(), pairs).union(many).distinct())
    label = components(links.union(late))

    found = member.join(label.withColumnRenamed("id", "node"), F.expr("rep = node"), "left")
    found = found.groupBy("doc_id").agg(F.min(F.coalesce("component_id", "rep")).alias("component_id"))
    found = found.withColumnRenamed("doc_id", "node")
    whole = marked.select("doc_id", "n_shingles").join(found, F.expr("doc_id = node"), "left")
    component = F.coalesce("component_id", "doc_id")
    return whole.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def distinct_documents(docs: DataFrame, p: NearDuplicates = NearDuplicates()) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates, all columns kept.

    Of each group the row with the least id stays; of several rows with that id, the one
    whose text hash is least, and one of rows that agree in that too. Rows without an id
    and rows with an empty or null text are no copies of anything and all stay.
    """
    marks = near_duplicates(docs, p).select(
        F.col("doc_id").alias("near_id"), "kept", (F.col("n_shingles") == 0).alias("empty")
    )
    kept = marks.filter("kept and near_id is not null and not empty").select("near_id").distinct()
    row = docs.select(
        F.struct(*docs.columns).alias("near_row"),
        F.col("doc_id").cast("long").alias("near_key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("near_text"),
    )
    free = F.col("near_key").isNull() | ~F.col("near_text").rlike(r"[^\x20\x09-\x0D]")
    singles = row.filter(free)
    grouped = row.filter(~free).join(kept, F.col("near_key") == F.col("near_id"), "left_semi")
    order = Window.partitionBy("near_key").orderBy(F.xxhash64("near_text"), F.hash("near_row"))
    heads = grouped.withColumn("near_rank", F.row_number().over(order)).filter("near_rank = 1")
    return singles.select("near_row.*").union(heads.select("near_row.*"))
