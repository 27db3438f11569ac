"""Near-duplicate vectors by a pivot-permutation index.

Reference points, the pivots, are drawn from the vectors of each length. Each vector is
described by its nearest pivots; inverted lists hold the vectors that have a pivot among
them. Two vectors of a label and length that share a pivot are compared exactly, and
every pair that passes is a link. A pair that meets in
several lists belongs to its smallest shared pivot, so that it counts once although
pairs are never listed: tasks send on numbers of links, and a spanning forest of them.
Long lists are cut into parts, and pairs of parts are compared. Equal vectors of a
label are one class, which is compared once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import saved
from tripmill.llm.components import components


@dataclass(frozen=True)
class PivotIndex:
    """``nearest``: pivots that describe a vector; ``shared``: how many of them a link's
    ends have in common at least, or all where there are fewer; more than one only loses
    links. ``pivots``: 0 for the square root of the number of vectors of a length, within
    16 and ``most_pivots``; that many vectors are drawn, by a hash of their ids.
    ``part``: vectors of a list that a task compares with as many others.
    """

    cosine: float = 0.98
    pivots: int = 0
    most_pivots: int = 2048
    nearest: int = 8
    shared: int = 1
    part: int = 256


def unit(vectors: list) -> np.ndarray:
    flat = np.array([np.asarray(v, np.float64) for v in vectors])
    scale = np.abs(flat).max(axis=1, keepdims=True)  # first, so that squares neither vanish nor overflow
    flat = flat / scale
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def _describe(pivots: dict[int, np.ndarray], p: PivotIndex):
    """The nearest pivots of each vector, nearest first; ties go to the lower number."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list = [None] * len(batch)
            sizes = np.array([len(v) for v in batch])
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                near = unit([batch.iloc[r] for r in rows]) @ pivots[int(size)].T
                order = np.argsort(-near, axis=1, kind="stable")[:, : p.nearest]
                for r, found in zip(rows, order):
                    out[r] = found.astype(np.int32)
            yield pd.Series(out)

    return F.pandas_udf(run, "array<int>")


def _find(parent: np.ndarray, k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def _compare(p: PivotIndex):
    """Links between two parts of a list: numbers by vector, and a forest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        i, j, pivot = (int(rows[c].iloc[0]) for c in ("i", "j", "pivot"))
        ids, part, copies = (rows[c].to_numpy() for c in ("head", "part", "copies"))
        sizes = np.array([len(v) for v in rows["embedding"]])
        counted, parent = np.zeros(len(rows), np.int64), np.arange(len(rows))
        edges = []
        for size in np.unique(sizes):
            own = sizes == size
            left, right = np.flatnonzero(own & (part == i)), np.flatnonzero(own & (part == j))
            if not len(left) or not len(right):
                continue
            a, b = unit(rows["embedding"].iloc[left].to_list()), unit(rows["embedding"].iloc[right].to_list())
            close = a @ b.T >= p.cosine
            x, y = np.nonzero(close)
            if i == j:
                x, y = x[x < y], y[x < y]
            if not len(x):
                continue
            near_x, near_y = (np.stack(rows["near"].iloc[k].to_list()) for k in (left, right))
            keep = np.empty(len(x), bool)
            for s in range(0, len(x), 8192):
                fx, fy = near_x[x[s : s + 8192]], near_y[y[s : s + 8192]]
                both = (fx[:, :, None] == fy[:, None, :]).any(axis=2)
                least = np.where(both, fx, np.iinfo(np.int32).max).min(axis=1)
                keep[s : s + 8192] = (both.sum(axis=1) >= min(p.shared, fx.shape[1])) & (least == pivot)
            x, y = left[x[keep]], right[y[keep]]
            np.add.at(counted, x, copies[y])
            np.add.at(counted, y, copies[x])
            for s, t in zip(x.tolist(), y.tolist()):
                s, t = _find(parent, s), _find(parent, t)
                if s != t:
                    parent[max(s, t)] = min(s, t)
                    edges.append((ids[s], ids[t]))
        n = np.flatnonzero(counted)
        links = pd.DataFrame({"a": ids[n], "b": pd.array([None] * len(n), "Int64"), "links": counted[n]})
        forest = pd.DataFrame(edges, columns=["a", "b"]).astype("int64").assign(links=0)
        return pd.concat([links, forest.astype({"b": "Int64"})], ignore_index=True)

    return run


def near_vectors(vectors: DataFrame, p: PivotIndex = PivotIndex()) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``vectors`` (vec_id, embedding, label).

    Linked are vectors of one label, of equal length and with a cosine of ``cosine`` or
    more in double precision, as far as the index finds them. Vectors that are null,
    empty, zero or hold a null or non-finite component, and rows with a null label or a
    null id, link with nothing: no links, themselves as component, kept. Each row of a
    repeated id counts as a vector for the others' links, and rows that share an id share
    a component. Other columns are not read.
    """
    value = F.col("embedding").cast("array<double>")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), value.alias("embedding")
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = finite & F.exists("embedding", lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = rows.filter(F.coalesce(usable, F.lit(False)))
    # minus zero equals zero
    same = F.sha2(F.to_json(F.struct("label", F.transform("embedding", lambda x: x + F.lit(0.0)).alias("e"))).cast("binary"), 256)
    keyed = good.withColumn("class", same)
    classes = keyed.groupBy(F.col("class").alias("group")).agg(F.min("vec_id").alias("head"), F.count("*").alias("copies"))
    heads = keyed.join(classes, F.expr("class = group and vec_id = head")).dropDuplicates(["class"])
    heads = saved(heads.select("class", "label", "head", "copies", "embedding"))

    sized = heads.select("head", "embedding", F.size("embedding").alias("size"))
    counts = {r[0]: r[1] for r in sized.groupBy("size").count().collect()}
    wanted = {size: p.pivots or min(p.most_pivots, max(16, math.isqrt(n))) for size, n in counts.items()}
    # at most most_pivots vectors of a length, whatever the table's size
    order = Window.partitionBy("size").orderBy(F.xxhash64(F.lit("pivot"), "head"), "head")
    places = sized.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max(wanted.values(), default=1))
    drawn: dict[int, list] = {size: [] for size in counts}
    for r in places.orderBy("size", "place").collect():
        if r.place <= wanted[r["size"]]:
            drawn[r["size"]].append(r.embedding)
    pivots = {size: unit(own) for size, own in drawn.items()}
    described = saved(heads.withColumn("near", _describe(pivots, p)("embedding")))

    lists = described.withColumn("pivot", F.explode("near")).withColumn("size", F.size("embedding"))
    length = lists.groupBy(F.col("label").alias("in_label"), F.col("size").alias("in_size"), F.col("pivot").alias("in_pivot")).agg(
        F.ceil(F.count("*") / p.part).cast("int").alias("parts")
    )
    placed = (
        lists.join(length, F.expr("label = in_label and size = in_size and pivot = in_pivot"))
        .withColumn("part", F.expr("cast(pmod(xxhash64(head, class), parts) as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select(
            "label", "size", "pivot", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            "part", "head", "copies", "embedding", "near",
        )
    )
    found = saved(placed.groupBy("label", "size", "pivot", "i", "j").applyInPandas(_compare(p), "a long, b long, links long"))
    links = found.filter("b is null").groupBy(F.col("a").alias("of")).agg(F.sum("links").alias("links"))
    # a repeated id ties the classes it stands in together
    ties = keyed.select("vec_id", "class").join(classes, F.expr("class = group")).select(
        F.col("vec_id").alias("a"), F.col("head").alias("b")
    )
    several = ties.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("x"), F.max("b").alias("y")).filter("x <> y")
    tied = ties.join(several, F.expr("a = id")).select(F.col("x").alias("a"), "b")
    label = components(found.filter("b is not null").select("a", "b").union(tied))

    member = keyed.select("vec_id", "class").join(classes, F.expr("class = group"))
    member = member.join(links, F.expr("head = of"), "left").join(label, F.expr("head = id"), "left")
    linked = member.select(
        F.col("vec_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "head").alias("component_id"),
    )
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return linked.union(alone).withColumn("kept", kept)
