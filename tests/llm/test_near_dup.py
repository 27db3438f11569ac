import itertools
import random

import numpy as np
import pytest
from helpers import documents, prose, union_find, words

from tripmill.llm.components import components
from tripmill.llm.near_dup import NearDuplicates, distinct_documents, near_duplicates


def shingles(text, size):
    found = words(text)
    if not found:
        return set()
    return {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))}


def brute(rows, size, percent=80):
    sets = {}
    for doc_id, text in rows:
        sets.setdefault(doc_id, []).append(shingles(text, size))
    pairs = [
        (i, j)
        for i, j in itertools.combinations(sets, 2)
        if any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[i] for b in sets[j])
    ]
    return union_find(pairs, sets)


def edited(text, n, seed):
    draw, found = random.Random(seed), text.split(" ")
    for _ in range(n):
        found[draw.randrange(len(found))] = f"x{draw.randrange(10**6)}"
    return " ".join(found)


def corpus():
    rows = [(i, prose(i, 120)) for i in range(40)]
    for k in range(60):  # around the threshold from both sides
        rows.append((100 + k, edited(rows[k % 12][1], k % 9, k)))
    rows += [(200 + k, edited(prose(500, 200), 4, k)) for k in range(60)]  # a large group
    rows += [(300 + k, prose(600, 80)) for k in range(30)]  # exact copies
    rows += [(400 + k, t) for k, t in enumerate(["a", "A", "a b", "a b c", "a  b\tc", "a b c d", "", " \n"])]
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_groups_equal_brute_force(spark, block):
    rows = corpus()
    docs = documents(spark, [*rows, (500, None)], clash=True)
    want = brute(rows, 4)
    got = {r.doc_id: r for r in near_duplicates(docs, NearDuplicates(shingle=4, block=block)).collect()}
    assert len(got) == len(rows) + 1
    assert {i: got[i].component_id for i in want} == want
    texts = dict(rows)
    assert all(got[i].n_shingles == len(shingles(texts[i], 4)) for i in want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert got[500].n_shingles == 0 and got[500].kept


def test_two_families_that_never_link_stay_apart(spark):
    """Large buckets with several components: every cross pair is looked at, none links."""
    base = prose(1, 200)
    other = " ".join(w if k % 14 else f"y{k}" for k, w in enumerate(base.split(" ")))
    rows = [(k, edited(base, 1, k)) for k in range(40)] + [(100 + k, edited(other, 1, k)) for k in range(40)]
    got = {r.doc_id: r.component_id for r in near_duplicates(documents(spark, rows), NearDuplicates(block=8)).collect()}
    assert got == brute(rows, 5)


def test_null_ids_repeated_rows_and_ids_with_two_texts(spark):
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(None, a), (None, a), (1, a), (1, a), (2, b), (3, b), (3, c), (4, c)]
    got = [tuple(r) for r in near_duplicates(documents(spark, rows)).collect()]
    assert len(got) == len(rows)
    assert [r[2:] for r in got if r[0] is None] == [(None, True)] * 2
    assert {r[0]: r[2] for r in got if r[0]} == {1: 1, 2: 2, 3: 2, 4: 2}


def test_one_document_of_each_group_stays(spark):
    rows = [*corpus(), (None, "a b"), (None, None), (7, prose(7, 120)), (501, None), (501, None)]
    docs = documents(spark, rows, clash=True)
    left = distinct_documents(docs, NearDuplicates(shingle=4))
    assert left.columns == docs.columns
    ids = sorted(r.doc_id for r in left.collect() if r.doc_id is not None and words(r.text))
    want = brute([r for r in rows if r[0] is not None and words(r[1])], 4)
    assert ids == sorted(i for i, c in want.items() if i == c)
    free = [r for r in left.collect() if r.doc_id is None or not words(r.text)]
    assert len(free) == sum(i is None or not words(t) for i, t in rows)


def test_no_rows(spark):
    assert near_duplicates(documents(spark, [])).collect() == []
    assert distinct_documents(documents(spark, [])).collect() == []


def test_components_of_random_graphs(spark):
    for seed in range(3):
        draw = np.random.default_rng(seed)
        pairs = [tuple(map(int, p)) for p in draw.integers(0, 150, (110, 2))] + [(1000 + k, 1001 + k) for k in range(60)]
        got = dict(components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long")).collect())
        want = union_find(pairs, {x for p in pairs for x in p})
        touched = {x for a, b in pairs if a != b for x in (a, b)}
        assert got == {n: want[n] for n in touched}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_a_repeated_id_without_words_in_open_buckets(spark):
    """Families of more members than are joined pairwise, with rows of their ids that have no words."""
    base = prose(77, 60).split()
    rows = []
    for k in range(40):
        text = list(base)
        text[k] = f"own{k}"
        rows.append((k, " ".join(text)))
    for extra in (None, "", " \n "):
        got = {(r.doc_id, r.n_shingles): r for r in near_duplicates(documents(spark, rows + [(5, extra), (7, "other words here")])).collect()}
        assert got[5, 0].component_id == got[5, 56].component_id
        assert len(got) == 42
