import numpy as np
import pytest

from tripmill.llm.common import table
from tripmill.llm.whitening import Whitening, whitened

FORM = "vec_id long, embedding array<float>, label int"


def vectors(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], 1) for k, v in rows], FORM)


def by_row(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.vec_id, {})[r.component] = r
    return out


def plain(data, p=Whitening()):
    """Exact integers, then one eigenvalue problem."""
    x = np.floor(np.asarray(data, np.float32).astype(np.float64) * p.scale).astype(np.int64) + p.shift
    n, total = len(x), x.sum(axis=0)
    apart = n * x - total
    centred = apart / n
    values, columns = np.linalg.eigh(centred.T @ centred / n)
    return apart, centred, values[::-1], columns[:, ::-1]


@pytest.mark.parametrize("p", [Whitening(block_rows=7, components=4), Whitening(components=3)])
def test_against_one_matrix(spark, p):
    data = np.random.default_rng(3).normal(size=(60, 5)) * [5, 3, 2, 1, 0.5]
    found = by_row(whitened(vectors(spark, enumerate(data)), p))
    apart, centred, values, columns = plain(data)
    k = min(p.components, 5)
    z = centred @ columns / np.sqrt(values)
    assert len(found) == 60
    for row in range(60):
        assert sorted(found[row]) == list(range(1, k + 1))
        assert {int(r.deviation) for r in found[row].values()} == {int((apart[row] ** 2).sum())}
        assert {r.n for r in found[row].values()} == {60}
    for c in range(k):
        mine = np.array([found[row][c + 1].whitened for row in range(60)])
        assert min(abs(mine - z[:, c]).max(), abs(mine + z[:, c]).max()) < 1e-9
        assert abs(found[0][c + 1].explained - values[c] / values.sum()) < 1e-12
    assert found[0][1].identity_error < 1e-9


def test_the_whole_table(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    data = {r.vec_id: r.embedding for r in df.collect()}
    found = by_row(whitened(df))
    assert found.keys() == data.keys()
    ids = sorted(found)
    z = np.array([[found[i][c].whitened for c in range(1, 33)] for i in ids])
    assert abs(z.T @ z / len(ids) - np.eye(32)).max() < 1e-8
    apart = plain([data[i] for i in ids])[0]
    assert [int(found[i][1].deviation) for i in ids] == (apart**2).sum(axis=1).tolist()


def test_edge_rows(spark):
    rows = [
        (1, None), (2, [1, None]), (3, [float("nan"), 1]), (4, [float("inf"), 1]), (5, [1e30, 0]),
        (6, [0, 1]), (6, [0, 1]), (None, [2, 5]), (8, [3]), (9, []), (10, [4, -2]),
    ]
    found = whitened(vectors(spark, rows).selectExpr("*", "1 as n", "2 as block", "3 as row", "4 as x")).collect()
    assert sorted({str(r.vec_id) for r in found}) == ["10", "6", "8", "9", "None"]
    assert len(found) == 6 * 2  # the shorter vectors have zeros; the repeated row counts twice
    apart = plain([[0, 1], [0, 1], [2, 5], [3, 0], [0, 0], [4, -2]])[0]
    assert sorted(int(r.deviation) for r in found if r.component == 1) == sorted((apart**2).sum(axis=1).tolist())


def test_components_without_variance_and_no_rows(spark):
    found = whitened(vectors(spark, [(1, [1, 2]), (2, [3, 2])])).collect()
    assert {(r.component, round(abs(r.whitened), 9)) for r in found} == {(1, 1.0), (2, 0.0)}
    assert {r.identity_error < 1e-9 for r in found} == {True}
    alone = whitened(vectors(spark, [(1, [1, 2])])).collect()
    assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in alone} == {(0.0, 0.0, 0.0, 0)}
    assert whitened(vectors(spark, [(1, None), (2, [])])).collect() == []
    assert whitened(vectors(spark, [])).collect() == []


def test_deviations_beyond_a_long_stay_exact(spark):
    data = [[2.0**43, -(2.0**43)], [0, 0], [-(2.0**42), 7]]
    found = by_row(whitened(vectors(spark, enumerate(data))))
    x = [[int(v * 64) + 1_000_000 for v in row] for row in data]
    total = [sum(c) for c in zip(*x)]
    for k, row in enumerate(x):
        assert int(found[k][1].deviation) == sum((3 * v - t) ** 2 for v, t in zip(row, total))
