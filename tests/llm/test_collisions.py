import math
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collisions

SCHEMA = "vec_id bigint, embedding array<float>, label int, entry string, block double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, g, "x", 1.5) for i, v, g in rows], SCHEMA).repartition(3)


def plain(rows, cosine=0.98):
    """Expected rows by comparing all pairs."""
    fine = []
    for k, (_, v, g) in enumerate(rows):
        if g is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v):
            x = np.float32(v).astype(np.float64)
            fine.append((k, g, x / np.linalg.norm(x)))
    near, label = Counter(), list(range(len(rows)))
    groups = {}
    for k, g, x in fine:
        groups.setdefault((g, len(x)), []).append((k, x))
    for members in groups.values():
        at = np.array([k for k, _ in members])
        x = np.array([x for _, x in members])
        for i, row in enumerate(x @ x.T >= cosine - 1e-15):
            for j in np.flatnonzero(row):
                if i != j:
                    near[at[i]] += 1
                if i < j and label[at[i]] != label[at[j]]:
                    low, high = sorted((label[at[i]], label[at[j]]))
                    label = [low if y == high else y for y in label]
    ids = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            ids[label[k]] = min(i, ids.get(label[k], i))
    return Counter((i, near[k], ids.get(label[k]), i is not None and ids.get(label[k]) == i) for k, (i, _, _) in enumerate(rows))


def run(spark, rows, **more):
    got = collisions.near_duplicates(vectors(spark, rows), **more)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    return Counter(map(tuple, got.collect()))


def clusters(n, dim, seed, members=12, noise=0.9):
    """Groups of vectors whose cosines lie on both sides of 0.98, some of them repeated."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    rows = []
    for k in range(n * members):
        step = rng.normal(size=dim)
        v = centres[k % n] + step / np.linalg.norm(step) * 0.2 * noise * rng.random()
        rows.append((int(rng.integers(0, 10**12)), (v * rng.uniform(0.5, 3)).tolist(), int(k % n % 3)))
    return rows + [(i + 1, v, g) for i, v, g in rows[: n // 2]]


@pytest.mark.parametrize("dim", [2, 5, 8, 24, 64])
def test_against_all_pairs(spark, dim):
    rows = clusters(30, dim, dim)
    got = run(spark, rows)
    assert got == plain(rows) and sum(n for (_, n, _, _), c in got.items() for _ in range(c)) > 100


def test_dealt_into_blocks(spark):
    """Many small blocks in several tables: no pair counts twice and next to none is lost."""
    rows = clusters(60, 64, 3)
    got, want = run(spark, rows, block=64, whole=1), plain(rows)
    links = [sum(n * c for (_, n, _, _), c in x.items()) for x in (got, want)]
    assert 0.999 * links[1] <= links[0] <= links[1]
    assert sum((got & want).values()) >= 0.99 * len(rows)


def test_one_dense_block(spark):
    """A group that lines would tear apart is compared part by part, exactly."""
    rng = np.random.default_rng(8)
    centre = rng.normal(size=32)
    rows = [(k, (centre + rng.normal(size=32) * 0.14).tolist(), 1) for k in range(400)]
    rows += [(1000 + k, rows[0][1], 1) for k in range(300)]
    assert run(spark, rows, block=50, whole=1) == plain(rows)


def test_parts_and_blocks_agree():
    rng = np.random.default_rng(4)
    x = collisions.unit(np.repeat(rng.normal(size=(20, 16)), 6, axis=0) + rng.normal(size=(120, 16)) * 0.12)
    none = np.zeros((120, 0), np.int64)
    whole = {tuple(sorted(p)) for a, b in collisions.linked(x, None, none, none, step=7) for p in zip(a.tolist(), b.tolist())}
    half = [{tuple(sorted(p)) for a, b in collisions.linked(x[s], None, none[s], none[s]) for p in zip((a + s.start).tolist(), (b + s.start).tolist())} for s in (slice(0, 50), slice(50, 120))]
    cross = {(int(i), int(j) + 50) for a, b in collisions.linked(x[:50], x[50:], none[:50], none[50:]) for i, j in zip(a, b)}
    assert half[0] | half[1] | cross == whole == {(i, j) for i in range(120) for j in range(i + 1, 120) if x[i] @ x[j] >= 0.98}
    one = np.zeros((120, 1), np.int64)
    assert all(not len(a) for a, _ in collisions.linked(x, None, one, one))


def test_hard_rows(spark):
    v = [1.0, 2.0, -0.5, 4.0, 0.25]
    odd = [None, [], [0.0] * 5, [None] * 5, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [float("inf"), 1.0, 1.0, 1.0, 1.0], [-0.0] * 5]
    rows = [(k, x, 1) for k, x in enumerate(odd)] + [(k + 20, x, 1) for k, x in enumerate(odd)]
    rows += [(50, v, 1), (49, [2 * c for c in v], 1), (51, [-c for c in v], 1), (52, v, 2), (53, v, None), (54, v, None), (None, v, 1), (None, v, 3), (None, v, 3), (None, None, 1)]
    rows += [(55, [c * 1e-30 for c in v], 4), (56, [c * 1e30 for c in v], 4), (57, v[:4], 4), (58, v + [0.0], 4), (59, v, 4), (59, v, 4)]
    assert run(spark, rows) == plain(rows)


def test_no_rows(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, None, 1), (2, [0.0], 1)]) == Counter([(1, 0, 1, True), (2, 0, 2, True)])


def test_calibration():
    """Pairs at the threshold pass the count as often as promised."""
    half, need = collisions.calibrated(64)
    rng = np.random.default_rng(1)
    step = rng.normal(size=(200_000, 64))
    step *= math.sqrt(0.04) / np.linalg.norm(step, axis=1, keepdims=True)
    passed = (np.abs(step @ collisions.lines(64)) <= half).sum(axis=1) >= need
    assert passed.mean() > 1 - 1e-4
    apart = rng.normal(size=(20_000, 64))
    apart *= math.sqrt(2) / np.linalg.norm(apart, axis=1, keepdims=True)
    assert ((np.abs(apart @ collisions.lines(64)) <= half).sum(axis=1) >= need).mean() < 1e-3


def test_recall_on_given_vectors(spark):
    """Links found, of all that brute force finds on a tenth of a million pairs and more."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/check_s/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = 0
    for g in {r[2] for r in rows}:
        x = collisions.unit(np.array([r[1] for r in rows if r[2] == g], np.float32))
        want += int((x @ x.T >= 0.98).sum()) - len(x)
    for block, whole in ((collisions.BLOCK, collisions.WHOLE), (200, 1)):
        got = sum(r["n_links"] for r in collisions.near_duplicates(spark.read.parquet("/root/testdata/check_s/embeddings.parquet"), block=block, whole=whole).collect())
        assert 0.999 * want <= got <= want
