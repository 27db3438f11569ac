import random

import numpy as np
import pytest
from helpers import documents

from tripmill.llm.decontaminate import Benchmark, Decontamination, characters, clean, findings, gram_hashes

ITEM = "Thntblere of then, edtioner in inea that esly ndstnd nter inor eringedwh hathre and onon thhahe thtionble"


def distance_within(item, text):
    """The least edit distance between the item and any region of the text."""
    row = [0] * (len(text) + 1)
    for c in item:
        last, row[0] = row[0], row[0] + 1
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(last + (c != d), row[j] + 1, row[j - 1] + 1)
    return min(row)


def plain(text):
    codes, _ = characters(text)
    return "".join(map(chr, codes)).strip(" ")


def edit(text, n, seed):
    draw, out = random.Random(seed), list(text)
    for _ in range(n):
        k = draw.randrange(len(out))
        kind = draw.randrange(3)
        out[k : k + (kind != 1)] = [] if kind == 0 else [draw.choice("abcxyz ")]
    return "".join(out)


def test_finds_are_those_of_full_alignment():
    """Whatever lies within the budget is found, and nothing else."""
    p = Decontamination()
    budget = int(p.edits * len(plain(ITEM)))
    texts = []
    for n in range(0, 26, 2):
        for seed in range(4):
            around = " ".join(random.Random(seed).choice(["of", "the", "Thntblere", "edtioner", "an", "it"]) for _ in range(40))
            texts.append(f"{around}\n{edit(ITEM, n, 31 * n + seed)} {around}")
    texts += ["", ITEM.upper(), ITEM.replace(" ", "\n  "), ITEM[:60], ITEM * 3]
    found = Benchmark([(7, ITEM)], p).find(texts)
    for text, rows in zip(texts, found):
        least = distance_within(plain(ITEM), plain(text))
        assert bool(rows) == (least <= budget)
        if rows:
            assert min(r[3] for r in rows) == least
            for _, start, end, edits in rows:
                assert distance_within(plain(ITEM), plain(text[start:end])) <= edits
    assert len(found[-1]) == 3


def test_batches_and_passes_do_not_change_the_result(spark):
    items = [(k, edit(ITEM, 60, k)) for k in range(6)] + [(None, "no id, no match"), (9, None), (10, "none of it"), (1, edit(ITEM, 60, 1))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, "start " + edit(items[k % 6][1], k % 7, k) + "\nend") for k in range(40)]
    rows += [(40, None), (41, ""), (None, ITEM), (42, items[0][1]), (42, items[0][1])]
    docs = documents(spark, rows)
    results = []
    for p in (Decontamination(), Decontamination(part_chars=250, batch_chars=1)):
        got = findings(docs, bench, p, "where").select("doc_id", "where").collect()
        results.append(sorted((str(r.doc_id), sorted(map(tuple, r["where"].spans))) for r in got))
    assert results[0] == results[1] and len(results[0]) == len(rows)
    assert sum(bool(s) for _, s in results[0]) == 42


def test_clean_keeps_rows_and_columns(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    docs = documents(spark, [(1, "x " + ITEM), (2, "clean"), (None, None), (3, "")], clash=True)
    left = clean(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "3", "None"]
    with pytest.raises(ValueError, match="found"):
        findings(docs, bench)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert clean(docs, empty).count() == 4
    assert clean(documents(spark, []), bench).collect() == []


def test_gram_hashes_depend_on_the_characters_alone():
    codes = np.array([1, 2, 3, 4, 1, 2, 3, 4, 5], np.uint32)
    for q in (1, 2, 3, 4, 7, 8):
        found = gram_hashes(codes, q)
        assert len(found) == len(codes) - q + 1
        for i in range(len(found)):
            for j in range(len(found)):
                assert (found[i] == found[j]) == (codes[i : i + q] == codes[j : j + q]).all()


def test_exact_items_in_the_given_documents_are_found(spark, table):
    items = [(r.item_id, r.text) for r in table("benchmark").collect()]
    got = {r.doc_id: r.found["items"] for r in findings(table("documents"), table("benchmark")).collect()}
    seen = 0
    for row in table("documents").collect():
        for item_id, text in items:
            if text in row.text:
                assert item_id in got[row.doc_id]
                seen += 1
    assert seen


@pytest.mark.parametrize("size", [8, 12, 19, 20, 29, 30, 31, 35, 39])
def test_items_of_few_characters_have_their_whole_budget(size):
    p, item = Decontamination(), ITEM[:size].strip()
    budget = int(p.edits * len(plain(item)))
    texts = [f"some words {edit(item, n, 7 * n + s)} and others" for n in range(4) for s in range(12)]
    for text, rows in zip(texts, Benchmark([(1, item)], p).find(texts)):
        least = distance_within(plain(item), plain(text))
        assert bool(rows) == (least <= budget)
        if rows:
            assert min(r[3] for r in rows) == least


def test_items_below_a_gram_are_found_as_whole_words(spark):
    items = [(1, "7 + 5?"), (2, "yes"), (3, "Yes "), (4, "?"), (5, " "), (6, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["what is 7  +\n5? he asked", "YES", "yesterday, eyes", "so ?", "27 + 5?", "", "a yes yes b"]
    docs = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r.found["spans"] for r in findings(docs, bench).collect()}
    spans = {k: sorted((s.item_id, s.start, s.end, s.edits) for s in v) for k, v in got.items()}
    assert spans[0] == [(1, 8, 15, 0)] and texts[0][8:15] == "7  +\n5?"
    assert spans[1] == [(2, 0, 3, 0), (3, 0, 3, 0)] and spans[3] == [(4, 3, 4, 0)]
    assert spans[2] == spans[4] == spans[5] == []
    assert spans[6] == [(2, 2, 5, 0), (2, 6, 9, 0), (3, 2, 5, 0), (3, 6, 9, 0)]


def test_very_long_texts():
    text = "word and other words " * 20_000 + ITEM + " more of them" * 10_000
    rows = Benchmark([(7, ITEM), (8, "7 + 5?")], Decontamination()).find([text, "", text.upper()])
    assert [[(r[0], r[3]) for r in x] for x in rows] == [[(7, 0)], [], [(7, 0)]]
