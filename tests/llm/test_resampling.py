import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import ascii_lower, documents, prose

from tripmill.llm.common import table
from tripmill.llm.resampling import Resampling, gains, planes_of, resampled, sliced_weights

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, target, p=Resampling()):
    """The same, word by word."""

    def features(text):
        words = WORD.findall(ascii_lower(text or ""))
        return len(words), [" ".join(words[k : k + n]) for n in range(1, p.longest + 1) for k in range(len(words) - n + 1)]

    def bucket(feature):
        return zlib.crc32(feature.encode()) % p.buckets

    def counts(texts):
        out = [0] * p.buckets
        for text in texts:
            for f in features(text)[1]:
                out[bucket(f)] += 1
        return out

    s, t = counts(text for _, text in docs), counts(target)
    total_s, total_t = sum(s) + p.buckets, sum(t) + p.buckets
    gain = [math.floor(p.scale * math.log((b + 1) * total_s / ((a + 1) * total_t))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{p.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-p.scale * math.log(-math.log((h + 0.5) / 2**32))), n])
    able = sorted((r for r in rows if r[4] >= p.least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = len(able) * p.percent // 100
    ranks = {id(r): k + 1 for k, r in enumerate(able[:drawn])}
    return sorted(((str(r[0]), r[1], r[2], r[3], ranks.get(id(r))) for r in rows), key=str)


def got(df):
    return sorted(((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=str)


def targets(spark, texts):
    return spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("p", [Resampling(), Resampling(longest=2, buckets=50, percent=30, block=3)])
def test_against_word_by_word(spark, p):
    rows = [(k, prose(k, random.Random(k).randrange(0, 60), 80) + " ÉCOLE École école a.b") for k in range(120)]
    target = [prose(900 + k, 20, 30) for k in range(8)]
    assert got(resampled(documents(spark, rows), targets(spark, target), p)) == plain(rows, target, p)


def test_the_whole_table(spark, sf_dir):
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(resampled(docs, target)) == plain(rows, [r.text for r in target.collect()])


def test_edge_rows(spark):
    long = prose(5, 100_000, 5000)
    rows = [(None, None), (None, long), (1, ""), (2, "one"), (3, prose(3, 30)), (3, prose(3, 30)), (4, prose(4, 30)), (5, long)]
    p = Resampling(percent=60)
    docs = documents(spark, rows, clash=True)
    found = resampled(docs, targets(spark, [prose(7, 20), None, ""]), p)
    assert got(found) == plain(rows, [prose(7, 20)], p)
    assert resampled(documents(spark, []), targets(spark, ["a b"])).collect() == []
    assert got(resampled(documents(spark, rows), targets(spark, []), p)) == plain(rows, [], p)


def test_ties_go_to_the_lower_id_and_repeats_all_count(spark):
    rows = [(9, prose(1, 25))] * 300 + [(k, prose(2, 25)) for k in range(100)]
    p = Resampling(percent=50)
    assert got(resampled(documents(spark, rows), targets(spark, [prose(1, 25)]), p)) == plain(rows, [prose(1, 25)], p)


def test_planes_hold_signed_gains():
    draw = random.Random(1)
    gain = [draw.randrange(-30_000, 30_000) for _ in range(1000)] + [0, -1, 1, -32_768, 32_767]
    p = Resampling(buckets=len(gain))
    planes, worth = planes_of(gain)
    docs = [np.array([draw.randrange(len(gain)) for _ in range(n)], np.int64) for n in (0, 1, 70, 5000)]
    assert sliced_weights(docs, planes, worth, p) == [sum(gain[b] for b in d.tolist()) for d in docs]
    assert gains([0, 5], [0, 0], Resampling(buckets=2))[0] > gains([0, 5], [0, 0], Resampling(buckets=2))[1]
