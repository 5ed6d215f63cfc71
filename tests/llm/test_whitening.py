import math

import numpy as np
import pytest

from tidemark.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, n double, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.5, "x") for i, v in rows], SCHEMA).repartition(3)


def plain(rows, dim):
    """n, S, eigenvalues, directions and trace by numpy over the distinct rows, and the x of each usable row."""
    usable = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    distinct = np.array(sorted({tuple(x) for _, x in usable}), dtype=np.float64)
    centred = distinct - distinct.mean(axis=0)
    covariance = centred.T @ centred / len(distinct)
    values, vectors_ = np.linalg.eigh(covariance)
    return usable, len(distinct), [sum(int(v) for v in c) for c in distinct.T], values[::-1], vectors_[:, ::-1], np.trace(covariance), distinct


def check(spark, rows, dim):
    got = whitening.whiten(vectors(spark, rows)).collect()
    usable, n, sums, values, directions, trace, distinct = plain(rows, dim)
    k = min(4, dim)
    assert len(got) == k * len(usable)
    want = {}
    for i, x in usable:
        want.setdefault((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))), []).append((np.array(x) - np.array(sums) / n) @ directions)
    seen = {}
    for r in got:
        assert r["n"] == n
        seen.setdefault((r["vec_id"], r["deviation"], r["component"]), []).append(r)
    for c in range(k):
        share = values[c] / trace
        found = [r for r in got if r["component"] == c + 1]
        if values[c] < 1e-12 * values[0]:
            assert all(r["whitened"] is None and r["explained"] == 0 for r in found)
            continue
        assert all(abs(r["explained"] - share) <= 1e-9 * share and r["identity_error"] < 1e-9 for r in found)
        # Either sign, the same for all rows.
        pairs = [(r["whitened"], p[c] / np.sqrt(values[c])) for (i, d), ps in want.items() for r, p in zip(seen[i, d, c + 1], ps)]
        a, b = np.array(pairs).T
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
    return got


@pytest.mark.parametrize("dim", [1, 3, 17])
def test_against_numpy(spark, dim):
    rng = np.random.default_rng(dim)
    base = (rng.normal(size=(300, dim)) * np.linspace(3, 0.4, dim)).tolist()
    rows = list(enumerate(base)) + [(1000 + k, base[k % 5]) for k in range(200)] + [(None, base[7]), (5, base[9])]
    check(spark, rows, dim)


def test_ill_conditioned(spark):
    """Entries of very unequal scale, and one that is the sum of two others."""
    rng = np.random.default_rng(5)
    wide = rng.normal(size=(400, 8)) * 10.0 ** np.array([4, 3, 2, 1, 0, 4, 2, 0])
    wide = np.floor(wide * 256) / 256
    rows = np.column_stack([wide, wide[:, 0] + wide[:, 1]])
    found = whitening.fit(spark.createDataFrame([([int(c) for c in r * 256],) for r in rows], "x array<bigint>"), 9)
    covariance = np.cov((rows * 256).T, bias=True)
    assert np.allclose(found.values[:7], np.linalg.eigvalsh(covariance)[::-1][:7], rtol=1e-9)
    assert found.values[8] == 0 or found.values[8] < 1e-18 * found.values[0]
    assert found.identity_error < 1e-6


def test_hard_rows(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(40, 5)).tolist()
    odd = [None, [], [None] * 5, [float("nan")] * 5, [float("inf"), 1.0, 2.0, 3.0, 4.0], [-float("inf"), 1.0, 2.0, 3.0, 4.0], [1.0, 2.0], [0.0] * 5, [1.0, None, 2.0, 3.0, 4.0]]
    got = check(spark, list(enumerate(good)) + [(900 + k, v) for k, v in enumerate(odd)], 5)
    assert {r["vec_id"] for r in got if r["vec_id"] >= 900} == {907}


def test_no_rows_and_one(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    got = whitening.whiten(vectors(spark, [(1, [1.0, 2.0, 3.0, 4.0, 5.0])] * 3)).collect()
    assert len(got) == 12 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in got)


def test_huge_entries(spark):
    """A deviation that no long holds is null; nothing overflows."""
    got = whitening.whiten(vectors(spark, [(1, [1e30, 2.0]), (2, [-1e30, 5.0]), (3, [0.0, 1e-30])])).collect()
    assert len(got) == 6 and all(r["deviation"] is None for r in got if r["vec_id"] < 3) and all(r["whitened"] is None or math.isfinite(r["whitened"]) for r in got)


def test_given_vectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(spark, rows, 64)
