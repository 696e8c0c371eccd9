import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import curves, hilbert, vafile

def asked():
    return F.col("vec_id") % 50 == 0

SHAPE = "vec_id long, embedding array<float>, rank string, score string"


def table(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).astype("f4").tolist(), "x", "y") for k in range(400)]
    same = rows[7][1]
    rows += [(k, same, None, None) for k in range(400, 520)]  # a common vector
    rows += [(600, None, "", ""), (601, [], "", ""), (602, [0.0] * 8, "", ""), (603, [float("nan")] * 8, "", "")]
    rows += [(604, [None] + same[1:], "", ""), (605, [float("inf")] + same[1:], "", ""), (606, same[:5], "", "")]
    rows += [(None, same, "", ""), rows[3], rows[0]]
    return spark.createDataFrame(rows, SHAPE), rows


def fits(v, zero):
    return v is not None and len(v) == 8 and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def by_force(rows, score, zero, k=5):
    known = {i: v for i, v, *_ in rows if i is not None and fits(v, zero)}
    out = {}
    for q in known:
        if q % 50 == 0:
            found = sorted((-score(known[q], v), i) for i, v in known.items() if i != q)[:k]
            out[q] = [(i, -s) for s, i in found]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_exact_top_k(spark):
    def score(a, b):
        a, b = (np.floor(256 * np.array(x, float)).astype(int) for x in (a, b))
        return int(a @ b)

    df, rows = table(spark)
    assert answers(vafile.top_k(df, asked())) == by_force(rows, score, True)


def test_few_exact_vectors_are_read():
    rng = np.random.default_rng(4)
    exact = rng.integers(-250, 250, (4000, 16))
    low, width = exact.min(0).astype(float), (exact.max(0) - exact.min(0) + 1) / vafile.CELLS
    cells = np.clip((exact - low) / width, 0, vafile.CELLS - 1).astype(np.uint8)
    ids = np.arange(4000)
    _, found, _, read = vafile.search_block(exact[:20], ids[:20], ids, cells, low, width, exact, 5)
    assert len(found) == 100 and read < 20 * 400


def test_neighbours_of_a_small_table_are_exact(spark):
    def score(a, b):
        a, b = np.array(a, float), np.array(b, float)
        return float(a @ b / np.sqrt((a @ a) * (b @ b)))

    df, rows = table(spark)
    got, want = answers(curves.neighbours(df, asked())), by_force(rows, score, False)
    assert got.keys() == want.keys()
    hits = 0
    for q, pairs in want.items():
        assert len(got[q]) == 5
        for (i, s), (j, t) in zip(got[q], pairs):
            hits += i == j
            assert s <= t + 1e-12
    assert hits >= 0.95 * 5 * len(want)


def test_recall_on_the_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in df.collect()]
    unit = np.array([v for _, v in rows])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    ids = np.array([i for i, _ in rows])
    got = answers(curves.neighbours(df, asked()))
    hits = total = 0
    for k in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[k]
        near[k] = -9
        true = set(ids[np.argsort(-near)[:5]].tolist())
        hits, total = hits + len(true & {i for i, _ in got[ids[k]]}), total + 5
    assert hits >= 0.9 * total


@pytest.mark.parametrize("search", [vafile.top_k, curves.neighbours])
def test_empty_tables(spark, search):
    none = spark.createDataFrame([], SHAPE)
    assert search(none, asked()).collect() == []
    alone = spark.createDataFrame([(50, [1.0, 2.0], "", "")], SHAPE)
    assert search(alone, asked()).collect() == []


@pytest.mark.parametrize("axes,bits", [(2, 4), (3, 3), (5, 2)])
def test_curve_visits_every_cell_by_single_steps(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), -1).reshape(-1, axes)
    keys = hilbert.keys((cells + 0.5) / (1 << bits), bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()
