import numpy as np
from helpers import documents, fold, prose

from tripmill.llm.common import table
from tripmill.llm.toxicity import ToxicityModel, features, fit, toxicity, train, without_toxic

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark, larger):
    """About two fifths of the toxic labels there have no sign in the text; the rest must be found."""
    labels = {r.doc_id: r.toxic for r in table(spark, larger, "labels").collect()}
    docs = table(spark, larger, "documents")
    rows = toxicity(docs, table(spark, larger, "labels")).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    found = sum(r.predicted for r in held)
    right = sum(r.predicted * labels[r.doc_id] for r in held)
    assert right / found > 0.95 and right / sum(labels[r.doc_id] for r in held) > 0.55
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def corpus():
    letters = str.maketrans("0123456789", "abcdefghij")
    rows = [(k, prose(k, 40).translate(letters) + (" vile Scum" if k % 4 == 0 else "")) for k in range(400)]
    return rows, [(k, 1, int(k % 4 == 0)) for k in range(240)]


def test_edge_rows(spark):
    rows, labels = corpus()
    extra = [(1000, None), (1001, ""), (None, "scum"), (1002, "vile scum"), (1002, "vile scum"), (1003, "123 !!")]
    docs = documents(spark, rows + extra, clash=True)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (1, 1, None), (7777, 1, 1)], LABELS)
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1002].predicted == 1 and by_id[None].doc_id is None
    assert by_id[1000].score == by_id[1001].score == by_id[1003].score < 0.7
    assert all(by_id[k].held_out == (fold(k, 3) == 1) for k in range(400))
    wrong = sum(by_id[k].predicted != (k % 4 == 0) for k in range(400))
    assert wrong <= 4
    left = without_toxic(docs, marks)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in got if not r.predicted}


def test_labels_outside_the_training_folds_change_nothing(spark):
    rows, labels = corpus()
    docs = documents(spark, rows)
    flipped = [(i, q, 1 - t if fold(i, 3) == 1 else t) for i, q, t in labels]
    a, b = (
        sorted((r.doc_id, r.score) for r in toxicity(docs, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, flipped)
    )
    assert a == b


def test_without_examples_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert [r.score for r in toxicity(documents(spark, [(1, "a")]), none).collect()] == [0.0]
    assert toxicity(documents(spark, []), none).collect() == []
    assert toxicity(documents(spark, []), spark.createDataFrame([(2, 1, 1)], LABELS)).collect() == []


def test_the_risk_corrects_for_positives_among_the_unlabelled():
    """A third of the unlabelled are positives; their word still ends up as a sign of the positives."""
    m = ToxicityModel(bits=10, least=1)
    positive = [features(f"bad w{k % 50}", 10) for k in range(200)]
    unlabelled = [features(("bad " if k % 3 == 0 else "good ") + f"w{k % 50}", 10) for k in range(900)]
    weights = fit(positive, unlabelled, 1 / 3, m)
    chance = lambda text: 1 / (1 + np.exp(-(weights[features(text, 10)].sum() + weights[-1])))
    assert chance("bad") > 0.7 > 0.3 > chance("good")


def test_the_model_does_not_depend_on_task_order(spark, table):
    docs, labels = table("documents"), table("labels")
    few = ToxicityModel(positives=20, unlabelled=100)
    twice = docs.union(docs.limit(50))
    models = {train(df, labels, few) for df in (docs, docs.repartition(7), docs.orderBy("n_chars"), docs.coalesce(1))}
    assert len(models) == 1 and None not in models
    assert train(twice.repartition(5), labels, few) == train(twice.coalesce(1), labels, few)
