import collections
import math

import numpy as np
import pytest
from helpers import documents, fold, prose, words

from tripmill.llm.lm_score import BackoffModel, lm_scores, packed, unpacked


def brute(rows, order, strength):
    """Scores by the recursive definition, with plain dictionaries."""
    counts = collections.Counter()
    for doc_id, text in rows:
        if fold(doc_id, 5) != 1:
            tokens = [*words(text), "\n"]
            for k in range(1, order + 1):
                counts.update(tuple(tokens[i : i + k]) for i in range(len(tokens) - k + 1))
    total = sum(n for g, n in counts.items() if len(g) == 1)
    kinds = sum(len(g) == 1 for g in counts)

    def chance(word, history):
        if not history:
            return (counts[(word,)] + 0.5) / (total + 0.5 * (kinds + 1))
        below = chance(word, history[1:])
        seen = counts[history]
        return (counts[(*history, word)] + strength * below) / (seen + strength) if seen else below

    for doc_id, text in rows:
        tokens = [*words(text), "\n"]
        base = sum(math.log10(chance(t, ())) for t in tokens)
        score = sum(math.log10(chance(t, tuple(tokens[max(0, i - order + 1) : i]))) for i, t in enumerate(tokens))
        known = sum(counts[(t,)] > 0 for t in tokens)
        yield doc_id, fold(doc_id, 5) == 1, len(tokens), known, total, base, score


ROWS = [
    *[(i, prose(i % 9, 60 + i)) for i in range(30)],
    (30, None), (31, ""), (32, " \t\n"), (None, "W1 w2 W3"), (None, "w1 w2 w3"), (33, "É é A a"), (33, "É é A a"), (34, prose(3, 5000)),
]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("block", [10**9, 700])
def test_scores_equal_the_definition(spark, order, block):
    model = BackoffModel(order=order, strength=7.0, block_bytes=block, least_buckets=3)
    got = [tuple(r) for r in lm_scores(documents(spark, ROWS, clash=True), model).collect()]
    want = list(brute(ROWS, order, 7.0))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[6], 6))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=1e-8)


def test_no_rows_and_no_training_rows(spark):
    assert lm_scores(documents(spark, [])).collect() == []
    held = next(i for i in range(100) if fold(i, 5) == 1)
    row = lm_scores(documents(spark, [(held, "a b")])).first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.score == pytest.approx(0.0)


def test_the_model_beats_single_words_on_held_out_text(spark, table):
    rows = lm_scores(table("documents")).filter("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_packing_is_exact():
    draw = np.random.default_rng(3)
    for kind, n in ((np.uint64, 1000), (np.uint32, 7), (np.uint64, 1)):
        values = draw.integers(0, np.iinfo(kind).max, n, kind)
        assert (unpacked(packed(values), kind) == values).all()
