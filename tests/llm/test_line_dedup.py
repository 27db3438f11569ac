import random

import pytest
from helpers import documents, prose

from tripmill.llm.line_dedup import LineDedup, dedup_lines


def clean_lines(seed, n, words=12):
    return [prose(1000 * seed + k, words, 10**6) + f" {seed}-{k}" for k in range(n)]


def passage(seed, sizes):
    return [prose(77_000 + 100 * seed + k, n, 10**6) for k, n in enumerate(sizes)]


def result(spark, rows, p=LineDedup(), **more):
    return {r.doc_id: r for r in dedup_lines(documents(spark, rows, **more), p, count="gone").collect()}


@pytest.mark.parametrize("sizes", [[60], [25, 30], [9, 20, 9, 20], [6] * 10, [3, 55, 2], [20, 20, 20, 5, 4]])
def test_passages_of_over_fifty_words_stay_once(spark, sizes):
    shared = passage(len(sizes), sizes)
    rows = [(k, "\n".join(clean_lines(k, 3 + k % 4) + shared + clean_lines(50 + k, k % 3))) for k in range(1, 9)]
    got = result(spark, rows)
    assert got[1].text == rows[0][1] and got[1].gone == 0
    for k, text in rows[1:]:
        left = got[k].text.split("\n")
        own = [line for line in text.split("\n") if line not in shared]
        assert left == own
        assert got[k].n_chars == len(got[k].text)


def test_copies_become_empty_and_clean_text_stays(spark):
    text = "\n".join(clean_lines(1, 8))
    boiler = "Terms and conditions apply to this page."
    rows = [(1, text), (2, text), (3, "\n".join([boiler, *clean_lines(3, 5)])), (4, "\n".join([boiler, *clean_lines(4, 5)]))]
    got = result(spark, rows)
    assert got[2].text == "" and got[1].text == text
    assert got[3].text == rows[2][1] and got[4].text == rows[3][1]


def test_a_passage_within_one_document(spark):
    shared = passage(3, [30, 40])
    text = "\n".join([*shared, "between", *shared, "after"])
    assert result(spark, [(1, text)])[1].text == "\n".join([*shared, "between", "after"])
    line = "spam and more of it " * 6
    assert result(spark, [(1, "\n".join([line] * 100))])[1].text == line


def test_edge_rows(spark):
    text = "\n".join(clean_lines(9, 8))
    rows = [(None, text), (None, text), (5, text), (5, text), (6, None), (7, ""), (8, "\n\n\n"), (9, "one")]
    docs = documents(spark, rows, clash=True)
    done = dedup_lines(docs)
    assert done.columns == docs.columns and done.dtypes == docs.dtypes
    got = sorted((str(r.doc_id), str(r.text)) for r in done.collect())
    assert got == sorted([("None", text)] * 2 + [("5", "")] * 2 + [("6", "None"), ("7", ""), ("8", "\n\n\n"), ("9", "one")])
    assert dedup_lines(documents(spark, [])).collect() == []


def test_no_text_is_lost(spark, table):
    """Whatever goes stays elsewhere; what stays keeps its order; short repeats stay."""
    docs = {r.doc_id: r.text for r in table("documents").collect()}
    got = {r.doc_id: r for r in dedup_lines(table("documents"), count="gone").collect()}
    assert got.keys() == docs.keys()
    kept_lines = {line for r in got.values() for line in r.text.split("\n")}
    changed = 0
    for doc_id, text in docs.items():
        lines, left = text.split("\n"), iter(got[doc_id].text.split("\n") if got[doc_id].text else [])
        assert set(lines) <= kept_lines
        rest = iter(lines)
        assert all(any(line == x for x in rest) for line in left)
        changed += got[doc_id].gone > 0
        if not got[doc_id].gone:
            assert got[doc_id].text == text
    assert changed


def test_randomly_placed_passages(spark):
    draw = random.Random(4)
    pool = [passage(200 + k, [draw.randrange(4, 40) for _ in range(draw.randrange(2, 7))]) for k in range(6)]
    pool = [p for p in pool if sum(len(x.split()) for x in p) > 50]
    rows = []
    for k in range(40):
        lines = clean_lines(300 + k, 12)
        at = draw.randrange(12)
        rows.append((k, "\n".join(lines[:at] + pool[k % len(pool)] + lines[at:])))
    got = result(spark, rows)
    first = set()
    for k, text in rows:
        shared = pool[k % len(pool)]
        own = "\n".join(x for x in text.split("\n") if x not in shared)
        assert got[k].text == (own if k % len(pool) in first else text)
        first.add(k % len(pool))


@pytest.mark.parametrize("sizes", [[18] * 3, [14] * 4, [12] * 5, [10] * 6, [20, 1, 1, 1, 28], [52, 3, 4]])
def test_passages_of_a_few_short_lines_go_whole(spark, sizes):
    rows, shared = [], {}
    for n in range(12):
        shared[n] = [" ".join(f"{k}{n}{m}" for m in range(size)) for k, size in zip("abcdef", sizes)]
        for k in (2 * n, 2 * n + 1):
            rows.append((k, "\n".join(clean_lines(600 + k, 4, 10) + shared[n] + clean_lines(700 + k, k % 3, 10))))
    got = result(spark, rows)
    for k, text in rows:
        own = [line for line in text.split("\n") if line not in shared[k // 2]]
        assert got[k].text == (text if k % 2 == 0 else "\n".join(own))


def test_blank_lines_around_and_within_passages(spark):
    text = "\n\n" + "\n\n".join(clean_lines(31, 6)) + "\n \n"
    rows = [(1, text), (2, text), (3, "own\n" + text + "\nmore")]
    got = result(spark, rows)
    assert got[1].text == text and got[2].text == ""
    assert got[3].text.split() == ["own", "more"]


def test_touching_lines_of_unrelated_documents_are_no_passage(spark):
    common = [" ".join(f"{k}{m}" for m in range(30)) for k in "abcd"]
    short = [f"menu entry number {k} of this page" for k in range(12)]
    rows = [(k, "\n".join([*clean_lines(800 + k, 3), line, *clean_lines(820 + k, 2)])) for k, line in enumerate(common + short)]
    rows += [(100, "\n".join([*clean_lines(840, 2), *common, *clean_lines(841, 2)])), (101, "\n".join([*short, *clean_lines(842, 3)]))]
    got = result(spark, rows)
    assert all(got[k].text == text and got[k].gone == 0 for k, text in rows)


def removed_by_force(rows, least=50):
    """Lines of every run with enough words that stands at an earlier place, found by comparing all runs."""
    seen, gone = {}, {doc_id: set() for doc_id, _ in rows}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        sizes = [len(line.split()) for line in lines]
        for start in range(len(lines)):
            for end in range(start, len(lines)):
                if sizes[start] and sizes[end] and sum(sizes[start : end + 1]) >= least:
                    run = tuple(lines[start : end + 1])
                    if seen.setdefault(run, (doc_id, start)) != (doc_id, start):
                        gone[doc_id] |= set(range(start, end + 1))
    return gone


@pytest.mark.parametrize("p", [LineDedup(), LineDedup(divisor=1), LineDedup(rolling=3, divisor=3), LineDedup(rolling=1)])
def test_every_repeated_run_against_all_runs(spark, p):
    draw = random.Random(9)
    pool = [prose(5000 + k, n, 10**6) for k, n in enumerate((1, 4, 9, 15, 20, 30, 55))] + [""]
    rows = []
    for k in range(60):
        lines = [draw.choice(pool) if draw.random() < 0.9 else f"own line {k} {m}" for m in range(draw.randrange(1, 14))]
        rows.append((k, "\n".join(lines)))
    got, gone = result(spark, rows, p), removed_by_force(rows)
    assert sum(map(len, gone.values())) > 50
    for k, text in rows:
        left = [line for m, line in enumerate(text.split("\n")) if m not in gone[k]]
        if gone[k] and not any(line.split() for line in left):
            left = []
        assert got[k].text == (chr(10).join(left) if gone[k] else text)


def test_chunks_prune_and_a_hot_passage_is_not_dealt_by_hand(spark):
    shared = "\n".join(passage(9, [20, 20, 20]))
    rows = [(k, "\n".join([*clean_lines(900 + k, 6), shared])) for k in range(300)]
    docs = documents(spark, rows)
    got = result(spark, rows)
    assert [k for k, _ in rows if shared in got[k].text] == [0]
    assert "REPARTITION_BY_COL" not in dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()


def test_very_long_texts(spark):
    long = "\n".join(clean_lines(50_000, 20_000, 6))
    got = result(spark, [(1, long), (2, "own\n" + long), (3, " ".join(["word"] * 100_000))])
    assert got[1].text == long and got[2].text == "own" and got[3].gone == 0
