import hashlib
import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, proofs):
    """Root of ``nodes``; ``proofs`` (one list per first node) get (place in the run, run) for each level."""
    below = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[k : k + 16] for k in range(0, len(nodes), 16)]
        for k, members in enumerate(below):
            for m in members:
                proofs[m].append((k % 16, runs[k // 16]))
        below = [sum(below[k : k + 16], []) for k in range(0, len(below), 16)]
        nodes = [sha(*r) for r in runs]
    return nodes[0]


def plain(rows):
    """Expected rows by building the whole tree in memory."""
    groups = defaultdict(list)
    for r in rows:
        groups["" if r["source"] is None else "=" + r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"]), r))
    trees = {}
    for name in sorted(groups, key=str.encode):
        members = sorted(groups[name], key=lambda m: m[:3])
        proofs = [[] for _ in members]
        trees[name] = (climb([m[2] for m in members], proofs), members, proofs)
    over = [[] for _ in trees]
    root = climb([t[0] for t in trees.values()], over)
    out = Counter()
    for (subroot, members, proofs), upper in zip(trees.values(), over):
        for (_, _, leaf, row), proof in zip(members, proofs):
            proof = proof + upper
            text = row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            node = plain_leaf(row, text)
            for at, run in proof:
                node = sha(*run[:at], node, *run[at + 1 :])
            out[row["doc_id"], leaf, subroot, root, sha(*[h for at, run in proof for h in run[:at] + run[at + 1 :]]), node, node == root] += 1
    return out


def check(docs):
    got = merkle.audit(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain([r.asDict() for r in docs.select(*FIELDS).collect()])


def test_hard_rows(documents, hard_rows):
    check(documents(hard_rows))


def test_nulls_in_every_column(documents, hard_rows):
    docs = documents(hard_rows)
    check(docs.select(*[F.when(F.col("doc_id") % 3 != k, F.col(c)).alias(c) if c != "doc_id" else "doc_id" for k, c in enumerate(FIELDS)]))


def test_no_rows(documents):
    assert merkle.audit(documents([])).collect() == []


def test_one_row(documents):
    check(documents([(3, "Only One", None)]))


def test_runs_of_every_size(documents):
    """Sources of 1, 2, 15 to 18, 255 to 258 and 272 rows: last runs of one node on every level."""
    sizes = (1, 2, 15, 16, 17, 18, 255, 256, 257, 258, 272)
    check(documents([(s * 1000 + k, f"Text {k} of {s}", f"s{s}") for s in sizes for k in range(s)]))


def test_rounds_of_exchange(documents):
    """18 blocks meet in two rounds; the last group has two, so they serve the others by turns."""
    check(documents([(k * 7, f"T{k}", "big") for k in range(17 * 256 + 3)] + [(k, "x", "small") for k in range(5)]))


def test_many_sources(documents):
    """More sources than one run holds, with names that sort by bytes and not by letters."""
    names = [None, "", "é", "e", "Z", "😀", "￿", *[f"s{k}" for k in range(300)]]
    check(documents([(k, "Same", n) for k, n in enumerate(names)]))


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
