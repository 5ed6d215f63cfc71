"""Merkle manifest of a dataset by butterfly exchange (operator 13).

A tree is made per source and one more over the sources' roots; ``FANOUT``
consecutive nodes become one.  Leaves are ranked, and ``FANOUT ** 2``
consecutive ones are a block: a partition of its own that hashes its subtree
alone.  Blocks then meet in rounds.  In each round the aligned group of (at
most ``FANOUT``) subtrees that become one node swap their roots: every block
gets one message from each other subtree of its group, from the block at its
own place in there, and hashes the common ancestor itself.  So each block
gathers its upper siblings on the way up, and no pass leads down again.  A
round moves at most ``FANOUT - 1`` roots a block; texts are read once and
never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, prefix_sum

FANOUT = 16
_PROOF = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(*fields: Column) -> Column:
    """The leaf of a row: each field as ``-`` or as its UTF-8 byte count, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def joined(hashes: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(hashes, start, length), "")


def siblings(hashes: Column, place: Column) -> Column:
    """left and right: the other nodes of the run that holds ``place`` (from 0), as one text each."""
    begin = F.floor(place / FANOUT) * FANOUT
    left = joined(hashes, (begin + 1).cast("int"), (place - begin).cast("int"))
    right = joined(hashes, (place + 2).cast("int"), (begin + FANOUT - 1 - place).cast("int"))
    return F.struct(left.alias("left"), right.alias("right"))


def parents(hashes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(joined(hashes, i * FANOUT + 1, FANOUT), 256))


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` gives with the siblings of ``proof``, lowest level first."""
    return F.aggregate(proof, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _exchange(blocks: DataFrame) -> DataFrame:
    """tree, block, root, proof of ``blocks`` (tree, block, n_blocks, node): every block climbs to its tree's root."""
    state = cut(blocks.select("tree", "block", "n_blocks", F.col("node").alias("root"), F.array().cast(_PROOF).alias("proof")))
    most = state.agg(F.max("n_blocks").alias("n")).first()["n"] or 0
    span = 1
    while span < most:
        nodes, own = F.ceil(F.col("n_blocks") / span), F.floor(F.col("block") / span)
        first = F.floor(own / FANOUT) * FANOUT
        state = state.withColumn("__own", own).withColumn("__up", nodes > 1)
        # What a block asks for: the root of each other subtree, from the block at its own place there (a short last subtree serves by turns).
        asked = state.filter("__up").withColumn("__from", F.explode(F.sequence(first, F.least(first + FANOUT, nodes) - 1))).filter("__from != __own")
        held = F.least(F.lit(span), F.col("n_blocks") - F.col("__from") * span)
        sender = F.col("__from") * span + (F.col("block") % span) % held
        asked = asked.select("tree", "block", "__from", sender.cast("bigint").alias("__sender"))
        sent = state.select(F.col("tree").alias("__tree"), F.col("block").alias("__sender"), F.col("root").alias("__root"))
        got = cut(asked.join(sent, (asked["tree"] == sent["__tree"]) & (asked["__sender"] == sent["__sender"])).select("tree", "block", "__from", "__root"))
        # At most FANOUT - 1 messages a block.
        got = got.groupBy("tree", "block").agg(F.sort_array(F.collect_list(F.struct("__from", "__root"))).alias("__got"))
        state = state.join(got, ["tree", "block"], "left")

        def side(keep) -> Column:
            return F.array_join(F.transform(F.filter(F.coalesce("__got", F.array().cast("array<struct<__from:bigint,__root:string>>")), keep), lambda m: m["__root"]), "")

        left, right = side(lambda m: m["__from"] < F.col("__own")), side(lambda m: m["__from"] > F.col("__own"))
        state = state.withColumn("__left", left).withColumn("__right", right)
        climbed = F.array_append("proof", F.struct(F.col("__left").alias("left"), F.col("__right").alias("right")))
        state = state.withColumn("proof", F.when(F.col("__up"), climbed).otherwise(F.col("proof")))
        state = state.withColumn("root", F.when(F.col("__up"), digest(F.col("__left"), F.col("root"), F.col("__right"))).otherwise(F.col("root")))
        state = cut(state.select("tree", "block", "n_blocks", "root", "proof"))
        span *= FANOUT
    return state.select("tree", "block", "root", "proof")


def _blocks(items: DataFrame, order: list[str]) -> DataFrame:
    """tree, block, __n (leaves of the tree), __leaves (place, leaf, ...), __level0, __level1, node: one row for ``FANOUT ** 2`` leaves of ``items``."""
    rest = [c for c in items.columns if c not in ("tree", "leaf")]
    one = items.withColumn("__one", F.lit(1).cast("bigint"))
    numbered = prefix_sum(one, [(c, "asc") for c in order], {"__one": "__rank"}, by=("tree",), totals={"__one": "__n"})
    size = FANOUT * FANOUT
    place = F.col("__rank") - 1
    leaves = F.sort_array(F.collect_list(F.struct((place % size).alias("place"), "leaf", *rest)))
    rows = numbered.groupBy("tree", F.floor(place / size).alias("block"), "__n").agg(leaves.alias("__leaves"))
    rows = rows.withColumn("__level0", F.col("__leaves.leaf"))
    rows = rows.withColumn("__level1", F.when(F.col("__n") > 1, parents(F.col("__level0"))).otherwise(F.col("__level0")))
    node = F.when(F.col("__n") > FANOUT, F.sha2(F.array_join("__level1", ""), 256)).otherwise(F.col("__level1")[0])
    return cut(rows.withColumn("node", node))


def _roots(blocks: DataFrame) -> DataFrame:
    """tree, block, root, proof: what the rounds give every block."""
    return _exchange(blocks.select("tree", "block", F.ceil(F.col("__n") / (FANOUT * FANOUT)).alias("n_blocks"), "node"))


def _spread(blocks: DataFrame, upper: DataFrame) -> DataFrame:
    """The leaves of ``blocks`` with the columns of ``upper`` (tree, block, proof, ...), proofs begun inside the block."""
    more = [c for c in upper.columns if c not in ("tree", "block", "proof")]
    upper = upper.withColumnsRenamed({"tree": "__tree", "block": "__block", "proof": "__proof"})
    whole = blocks.join(upper, (blocks["tree"] == upper["__tree"]) & (blocks["block"] == upper["__block"]))

    def begun(place: Column) -> Column:
        low, high = siblings(F.col("__level0"), place), siblings(F.col("__level1"), F.floor(place / FANOUT))
        return F.when(F.col("__n") > FANOUT, F.array(low, high)).when(F.col("__n") > 1, F.array(low)).otherwise(F.array().cast(_PROOF))

    fields = [f.name for f in blocks.schema["__leaves"].dataType.elementType.fields if f.name != "place"]
    each = F.transform("__leaves", lambda e: F.struct(*[e[f].alias(f) for f in fields], F.concat(begun(e["place"]), "__proof").alias("proof")))
    return whole.select("tree", *more, F.inline(each))


def trees(items: DataFrame, order: list[str]) -> DataFrame:
    """``items`` (tree, leaf, ...) with root and proof (array of left and right) in the tree of each value of ``tree``.

    Leaves of a tree stand in the order of the columns ``order`` (nulls
    first); ``order`` should tell rows apart unless their leaves are equal.
    """
    blocks = _blocks(items, order)
    return _spread(blocks, _roots(blocks))


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof (array of left and right sibling texts, lowest level first) and altered_leaf of every row of ``docs``.

    Reads doc_id, source, lang, n_chars, text; other columns are ignored.  A
    null field is ``-``, an empty text ``0:``; rows of null source are a tree
    of their own, the first; null ids come first in their source.  Rows of
    equal id stand in the order of their leaves, so that equal rows are
    interchangeable.  No rows give no rows.  ``altered_leaf`` is the leaf of
    the row with its text's A-Z lower-cased; texts without A-Z keep theirs.
    """
    fields = [F.col(c) for c in FIELDS]
    altered = [*fields[:-1], F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")]
    # The empty name is the null source's; all others begin with "=", so plain order is the order of sources.
    tree = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), "doc_id", leaf_of(*fields).alias("leaf"), leaf_of(*altered).alias("altered_leaf"))
    rows = cut(rows.withColumn("__row", F.monotonically_increasing_id()))
    blocks = _blocks(rows, ["doc_id", "leaf", "__row"])
    upper = _roots(blocks)
    subroots = cut(upper.filter("block = 0").select(F.lit("").alias("tree"), F.col("root").alias("leaf"), F.col("tree").alias("name")))
    over = trees(subroots, ["name"]).select(F.col("name").alias("__name"), F.col("root").alias("__top"), F.col("proof").alias("__over"))
    over = cut(over)
    # Proofs of blocks, not yet of rows, are led on to the root of all sources.
    upper = upper.join(over, upper["tree"] == over["__name"])
    upper = cut(upper.select("tree", "block", F.col("root").alias("subroot"), F.col("__top").alias("root"), F.concat("proof", "__over").alias("proof")))
    source = F.when(F.col("tree") != "", F.substr("tree", F.lit(2)))
    return _spread(blocks, upper).select("doc_id", source.alias("source"), "leaf", "subroot", "root", "proof", "altered_leaf")


def verify(rows: DataFrame, leaf: Column) -> DataFrame:
    """``rows`` of a manifest with folded_root (from ``leaf`` and the row's siblings) and verified."""
    folded = rows.withColumn("folded_root", fold(leaf, F.col("proof")))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row in five is checked with its text lower-cased."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = verify(manifest(docs), F.when(tampered, F.col("altered_leaf")).otherwise(F.col("leaf")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def _levels(rows: str, depth: int) -> str:
    """SQL: common tables ``{rows}_0`` .. ``{rows}_depth`` of nodes (tree, i, n, h, l, r) above ``{rows}`` (tree, i, n, h)."""
    out, name = [], rows
    for k in range(depth + 1):
        run = "PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
        sides = f"string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING) AS l, string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r"
        out.append(f"{rows}_{k} AS (SELECT tree, i, n, h, coalesce(l, '') AS l, coalesce(r, '') AS r FROM (SELECT *, {sides} FROM ({name})))")
        name = (
            f"SELECT tree, i // 16 AS i, max((n + 15) // 16) AS n, CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h"
            f" FROM {rows}_{k} GROUP BY tree, i // 16"
        )
    return ",\n".join(out)


def _climb(rows: str, depth: int, start: str, keep: str) -> str:
    """SQL: ``start`` (tree, i, proof, folded, ``keep``) led up through the levels of ``rows``."""
    step = start
    for k in range(depth):
        step = (
            f"SELECT s.tree, s.i // 16 AS i, CASE WHEN v.n > 1 THEN s.proof || v.l || v.r ELSE s.proof END AS proof,"
            f" CASE WHEN v.n > 1 THEN sha256(v.l || s.folded || v.r) ELSE s.folded END AS folded, {keep}"
            f" FROM ({step}) s JOIN {rows}_{k} v ON s.tree = v.tree AND s.i = v.i"
        )
    return step


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}))::VARCHAR || ':' || {value}, '-')"


_TEXT = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_LEAF = "sha256(" + " || ".join(_field(f) for f in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", "{text}")) + ")"
_BIT = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),"
    f" lambda crc, b: list_reduce(list_prepend(xor(crc, b), list_transform(range(8), lambda z: 0::BIGINT)), lambda x, y: {_BIT})), 4294967295)"
)

#: Levels that the SQL unrolls: 16 ** 5 documents a source, 16 ** 3 sources.
_INNER, _OUTER = 5, 3
ORACLE_SQL = f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_LEAF.format(text='text')} AS leaf, {_LEAF.format(text=_TEXT)} AS altered,
         coalesce({_CRC} % 5 = 0, false) AS tampered FROM documents),
placed AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM leaves WINDOW w AS (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf)),
a AS (SELECT tree, i, n, leaf AS h FROM placed),
{_levels("a", _INNER)},
subs AS (SELECT tree AS name, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a_{_INNER}),
b AS (SELECT '' AS tree, i, n, subroot AS h FROM subs),
{_levels("b", _OUTER)},
lower_half AS ({_climb("a", _INNER, "SELECT tree, i, '' AS proof, CASE WHEN tampered THEN altered ELSE leaf END AS folded, doc_id, leaf FROM placed", "doc_id, leaf")}),
begun AS (SELECT '' AS tree, u.i, l.proof, l.folded, l.doc_id, l.leaf, u.subroot FROM lower_half l JOIN subs u ON l.tree = u.name),
whole AS ({_climb("b", _OUTER, "SELECT * FROM begun", "doc_id, leaf, subroot")})
SELECT w.doc_id, w.leaf, w.subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = t.h AS verified
FROM whole w CROSS JOIN b_{_OUTER} t
"""
