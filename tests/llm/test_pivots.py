import itertools

import numpy as np
import pytest
from helpers import union_find

from tripmill.llm.pivots import PivotIndex, near_vectors

VECTORS = "vec_id long, embedding array<double>, label int, id string, head string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, "x", "y") for i, v, k in rows], VECTORS)


def brute(rows, cosine=0.98):
    good = [(n, i, np.array(v, float), k) for n, (i, v, k) in enumerate(rows) if usable(i, v, k)]
    links, pairs = {n: 0 for n in range(len(rows))}, []
    for (n, i, v, k), (m, j, w, l) in itertools.combinations(good, 2):
        if k == l and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine:
            links[n] += 1
            links[m] += 1
            pairs.append((i, j))
    label = union_find(pairs, {i for _, i, _, _ in good})
    return links, pairs, label


def usable(i, v, k):
    return i is not None and k is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def blobs(seed, size=32):
    draw = np.random.default_rng(seed)
    rows = [(k, draw.normal(size=size), k % 3) for k in range(150)]
    for k in range(120):
        base = rows[k % 20]
        rows.append((200 + k, base[1] + draw.normal(size=size) * draw.choice([0.05, 0.1, 0.2]), base[2]))
    center = draw.normal(size=size)
    rows += [(400 + k, center + draw.normal(size=size) * 0.1, 1) for k in range(90)]
    rows += [(600 + k, 2.0 * center, 1) for k in range(20)]
    return [(i, v.tolist(), k) for i, v, k in rows]


@pytest.mark.parametrize("part", [256, 16])
def test_links_and_components(spark, part):
    rows = blobs(1)
    links, pairs, label = brute(rows)
    got = {r.vec_id: r for r in near_vectors(frame(spark, rows), PivotIndex(part=part, pivots=24)).collect()}
    found, want = sum(r.n_links for r in got.values()), 2 * len(pairs)
    assert 0.97 * want <= found <= want
    assert all(got[i].n_links <= links[n] for n, (i, _, _) in enumerate(rows))
    right = sum(got[i].component_id == label[i] for i in label)
    assert right >= 0.97 * len(label)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_recall_on_the_given_vectors(spark, table):
    rows = [(r.vec_id, r.embedding, r.label) for r in table("embeddings").collect()]
    _, pairs, _ = brute(rows)
    found = sum(r.n_links for r in near_vectors(table("embeddings")).collect())
    assert 0.9 * 2 * len(pairs) <= found <= 2 * len(pairs)


def test_exact_with_all_pivots_shared(spark):
    """With one list that holds everything the index is exhaustive."""
    rows = blobs(2)
    links, _, label = brute(rows)
    got = {r.vec_id: r for r in near_vectors(frame(spark, rows), PivotIndex(pivots=4, nearest=4, shared=1, part=32)).collect()}
    assert {i: got[i].n_links for i, _, _ in rows} == {i: links[n] for n, (i, _, _) in enumerate(rows)}
    assert {i: got[i].component_id for i in label} == label


def test_edge_rows(spark):
    v, w = [1.0, 0.0, 0.1], [0.0, 1.0, 0.1]
    rows = [
        (1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, None, 0.0], 1),
        (9, [float("nan"), 1.0, 0.0], 1), (10, [float("inf"), 1.0, 0.0], 1), (None, v, 1), (11, [1.0, 0.0], 1), (12, [1e200, 0.0, 1e199], 1),
        (13, [1e-200, -0.0, 1e-201], 1), (14, w, 1), (14, w, 1), (15, v, 1), (15, w, 1), (16, [1.0, 0.0], 1),
    ]
    got = near_vectors(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.vec_id: r for r in got}
    group = {by_id[i].component_id for i in (1, 2, 12, 13, 14, 15)}
    assert group == {1}
    assert by_id[1].n_links == 4 and by_id[12].n_links == 4
    assert sorted(r.n_links for r in got if r.vec_id == 14) == [2, 2]
    assert by_id[11].component_id == by_id[16].component_id == 11
    for i in (3, 4, 5, 6, 7, 8, 9, 10):
        assert (by_id[i].n_links, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[None].n_links == 0 and by_id[None].kept and by_id[None].component_id is None
    assert near_vectors(frame(spark, [])).collect() == []


def test_rare_lengths_find_their_links(spark):
    draw = np.random.default_rng(5)
    rows = blobs(4)
    for size, pairs in ((5, 1), (7, 2), (8, 6)):
        for _ in range(pairs):
            v = draw.normal(size=size)
            rows += [(2000 + len(rows) + k, (v + draw.normal(size=size) * 0.001).tolist(), 1) for k in range(2)]
            rows.append((9000 + len(rows), draw.normal(size=size).tolist(), 1))
    links, _, label = brute(rows)
    got = {r.vec_id: r for r in near_vectors(frame(spark, rows)).collect()}
    rare = [n for n, (_, v, _) in enumerate(rows) if len(v) < 10]
    assert sum(links[n] for n in rare) >= 18
    assert {n: got[rows[n][0]].n_links for n in rare} == {n: links[n] for n in rare}
    assert {n: got[rows[n][0]].component_id for n in rare} == {n: label[rows[n][0]] for n in rare}


def test_a_confirmed_pair_with_one_pivot_in_common_is_a_link(spark):
    rows = blobs(3)
    _, pairs, _ = brute(rows)
    found = sum(r.n_links for r in near_vectors(frame(spark, rows), PivotIndex(pivots=8, nearest=1)).collect())
    assert 0.5 * 2 * len(pairs) <= found <= 2 * len(pairs)
