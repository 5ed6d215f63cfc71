import random
import time

import numpy as np
import pytest
from test_simhash import classes, plain_print

import corpus_pipeline
from tidemark.llm import copies, simhash


def plain_shingles(text):
    words = (text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def edited(words, n, draw):
    words = list(words)
    for k in draw.sample(range(len(words)), n):
        words[k] = f"new{draw.randrange(10**9)}"
    return words


def made_up():
    """Copies with 1 to 12 changed words of 200, and chains in which each text is a copy of the one before."""
    draw, rows = random.Random(5), []
    for g in range(12):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        rows += [" ".join(words)] + [" ".join(edited(words, n, draw)) for n in (1, 2, 3, 4, 6, 8, 12)]
        for _ in range(4 if g < 3 else 0):
            words = edited(words, 3, draw)
            rows.append(" ".join(words))
    draw.shuffle(rows)
    return [(i, t, "a") for i, t in enumerate(rows)]


def joint_kept(rows):
    """Ids that stay where three-bit fingerprints and five-word similarity connect: the smallest of each group, by comparing all pairs."""
    sets = {d: plain_shingles(t) for d, t, _ in rows}
    prints = {d: plain_print(t) for d, t, _ in rows}

    def near(a, b):
        both = len(sets[a] & sets[b])
        return (prints[a] ^ prints[b]).bit_count() <= 3 or both and 5 * both >= 4 * len(sets[a] | sets[b])

    ids = sorted(sets)
    return {d for d, g in zip(ids, classes(ids, near)) if ids.index(d) == g}


@pytest.mark.parametrize("part", [copies.PART, 3])
def test_all_near_copies_go(documents, part):
    """Also where a key's texts are compared part by part."""
    rows = made_up()
    docs = documents(rows)
    kept = copies.deduplicate(docs, part)
    assert kept.columns == docs.columns
    want = joint_kept(rows)
    assert {r["doc_id"] for r in kept.collect()} == want
    assert len(want) < simhash.deduplicate(docs).count()


def test_many_texts_to_pick(documents, monkeypatch):
    """The same where picked texts meet the documents in a shuffle."""
    monkeypatch.setattr(copies, "HELD", 0)
    rows = made_up()
    assert {r["doc_id"] for r in copies.deduplicate(documents(rows)).collect()} == joint_kept(rows)


def test_hard_rows(documents, hard_rows):
    rows = hard_rows + [(900 + i, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3 + "end" * (i > 0), "a") for i in range(2)]
    got = copies.deduplicate(documents(rows))
    assert sorted(r["doc_id"] for r in got.filter("doc_id >= 900").collect()) == [900]
    assert got.count() == simhash.deduplicate(documents(rows[:-1])).count()
    assert copies.deduplicate(documents([])).collect() == []


def test_stage_of_the_pipeline(documents):
    rows = made_up()
    docs = documents(rows)
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](docs.sparkSession, docs, "")
    assert {r["doc_id"] for r in kept.collect()} == joint_kept(rows)


@pytest.mark.parametrize("share, seed", [(0.0, 1), (0.25, 2), (0.6, 3)])
def test_classes_against_all_pairs(share, seed):
    """Dense groups that are alike but for the most part not near copies: similarities of 0.6 to 0.9."""
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 62, 100)
    sets = []
    for _ in range(120):
        own = base.copy()
        at = rng.choice(100, int(rng.integers(0, 25)), replace=False)
        own[at] = rng.integers(0, 1 << 62, len(at))
        sets.append(np.unique(own))
    ends, root = np.cumsum([len(s) for s in sets]), np.where(rng.random(120) < share, 0, np.arange(120))
    part = rng.integers(0, 2, 120)

    def near(i, j):
        both = len(np.intersect1d(sets[i], sets[j]))
        return root[i] == root[j] or 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both)

    for parts in (None, part):
        got = copies.connected(np.concatenate(sets), ends, root, parts)
        want = classes(range(120), lambda i, j: near(i, j) and (parts is None or parts[i] != parts[j] or root[i] == root[j]))
        assert len(set(zip(got.tolist(), want))) == len(set(got.tolist())) == len(set(want))
    assert len(set(want)) > 1


def test_a_large_dense_group_is_cheap():
    """4,000 near copies of one text: far fewer comparisons than pairs."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 62, 150)
    sets = [np.unique(np.append(np.delete(base, rng.integers(0, 150, 4)), rng.integers(0, 1 << 62, 4))) for _ in range(4000)]
    began = time.time()
    label = copies.connected(np.concatenate(sets), np.cumsum([len(s) for s in sets]), np.arange(4000))
    assert len(set(label.tolist())) == 1 and time.time() - began < 5
