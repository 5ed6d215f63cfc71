import hashlib
import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import quality, sketch

DOCS = "/root/testdata/sf0.001/documents.parquet"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def features(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [line for line in (text or "").split("\n") if words(line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    upper = sum(c.isupper() and c != c.lower() for c in text or "")
    chars = sum(map(len, w))
    base = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    dup = len(lines) - len(set(lines))
    bad = 5 * symbols > len(w) or 5 * dup > 2 * len(lines) or 5 * upper > 2 * chars or chars < 2 * len(w) or chars > 20 * len(w)
    return len(w), chars, symbols, dup, len(covered), base, not (base or bad)


FIELDS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_measures(documents, hard_rows):
    rng = random.Random(5)
    more = [(100 + i, "\n".join(" ".join(rng.choice(["a", "b", "Cé", "DD", "e|", "f"]) for _ in range(rng.randint(0, 30))) for _ in range(8)), "a") for i in range(60)]
    rows = hard_rows + more
    got = quality.measure(documents(rows)).select(*FIELDS).collect()
    assert Counter(map(tuple, got)) == Counter((d, *features(t)) for d, t, _ in rows)


def test_cascade_order_changes_nothing(spark):
    docs = spark.read.parquet(DOCS)
    names = list(quality.rules(quality.Features.of(F.lit(""))))
    kept = {tuple(sorted(r["doc_id"] for r in quality.clean(docs, order).select("doc_id").collect())) for order in (names, names[::-1], None)}
    assert kept == {tuple(sorted(r["doc_id"] for r in docs.collect() if features(r["text"])[-1]))}


def test_cascade_plan_prefers_cheap_and_selective_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    order = quality.plan_cascade(docs)
    assert sorted(order) == sorted(quality.rules(quality.Features.of(F.lit(""))))
    assert order.index("few_words") < order.index("word_length")


def test_rules_of_nothing(documents):
    assert quality.clean(documents([])).collect() == []
    assert quality.measure(documents([])).collect() == []


def unsigned(v):
    return v & (2**64 - 1)


def plain_sketch(text):
    fold = lambda hs, seed=42: seed if not hs else fold(hs[1:], xxhash.xxh64_intdigest(struct.pack("<Q", hs[0]), seed))
    h = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words(text)]
    grams = [h[i : i + 5] for i in range(len(h) - 4)] if len(h) >= 5 else [h] if h else []
    all_hashes = sorted({fold(g) >> 1 for g in grams})
    below = [v for v in all_hashes if v < sketch.THRESHOLD]
    return below if len(below) >= sketch.FLOOR else all_hashes[: sketch.FLOOR]


def likeness(a, b):
    reach = lambda s: sketch.TOP if len(s) < sketch.FLOOR else max(sketch.THRESHOLD - 1, s[-1])
    top = min(reach(a), reach(b))
    a, b = {v for v in a if v <= top}, {v for v in b if v <= top}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def check(got, rows):
    """Equal rows may follow one another in any order, so rows count as a multiset."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (xxhash.xxh64_intdigest((r[1] or "").encode(), 42) ^ 2**63)))
    want = Counter()
    for (d, t, _), (_, after, _) in zip(order, order[1:] + order[:1]):
        t, after = t or "", after or ""
        moved = len(t) // 4
        edited = t[: len(t) - moved] + after[:moved]
        own, other, following = plain_sketch(t), plain_sketch(edited), plain_sketch(after)
        text = lambda s: "-".join(f"{v:x}" for v in s)
        want[(d, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(own), text(other), round(likeness(own, other), 9), round(likeness(own, following), 9))] += 1
    assert Counter((*r[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == want


def test_fingerprints_of_hard_rows(documents, hard_rows):
    check(sketch.fingerprints(documents(hard_rows)).collect(), hard_rows)


@pytest.mark.parametrize("rows", [[], [(1, "a b c d e f g h", "a")], [(None, "a b", None)] * 3, [(7, f"text number {i} of one id", "a") for i in range(50)]])
def test_fingerprints_of_few_keys(documents, rows):
    check(sketch.fingerprints(documents(rows)).collect(), rows)


def test_fingerprints_of_given_documents(spark):
    docs = spark.read.parquet(DOCS)
    check(sketch.fingerprints(docs).collect(), [(r["doc_id"], r["text"], None) for r in docs.collect()])


def test_sketches_merge_and_contain(spark):
    text = [f"w{i}" for i in range(4000)]
    df = spark.createDataFrame([(" ".join(text), " ".join(text[:2004]), " ".join(text[2000:]), " ".join(text[100:300]))], "whole string, a string, b string, part string")
    s = {c: sketch.sketch(F.col(c)) for c in df.columns}
    row = df.select(
        (sketch.merged(s["a"], s["b"]) == s["whole"]).alias("merged"),
        sketch.containment(s["part"], s["whole"]).alias("inside"),
        sketch.containment(s["whole"], s["part"]).alias("around"),
        sketch.resemblance(s["a"], s["whole"]).alias("half"),
    ).first()
    assert row["merged"] and row["inside"] == 1.0 and row["around"] < 0.12 and 0.42 < row["half"] < 0.58


def test_containment_of_short_in_long_texts(spark):
    """Unrelated short texts are never inside a long one, those cut from it are wherever anything can be compared; no words are inside everything."""
    rng = np.random.default_rng(6)
    long = [f"w{x}" for x in rng.integers(0, 10**6, 5000)]
    short = [(" ".join(f"u{x}" for x in rng.integers(0, 10**6, 14)), " ".join(long[k * 20 : k * 20 + 14])) for k in range(60)]
    rows = spark.createDataFrame([(u, c, " ".join(long)) for u, c in short], "unrelated string, cut string, whole string")
    s = {c: sketch.sketch(F.col(c)) for c in rows.columns}
    got = rows.select(sketch.containment(s["unrelated"], s["whole"]).alias("u"), sketch.containment(s["cut"], s["whole"]).alias("c"), sketch.containment(sketch.sketch(F.lit("")), s["whole"]).alias("n")).collect()
    assert all(r["u"] in (None, 0.0) and r["c"] in (None, 1.0) and r["n"] == 1.0 for r in got)
    assert any(r["u"] == 0.0 for r in got) and any(r["c"] == 1.0 for r in got) and any(r["u"] is None for r in got)
