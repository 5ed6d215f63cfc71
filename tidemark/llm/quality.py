"""Quality rules as a short-circuit cascade (operator 7), in DataFrame expressions only.

Every rule is one boolean expression on the text.  ``plan_cascade`` measures
on a sample how long a rule takes and which share it rejects, and puts the
rules in order of rejections per second; ``rejected_by`` evaluates them in
that order and stops at the first that rejects.  The order changes the work,
never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, let, text_of, words_of

#: Characters that count as symbols.
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
SAMPLE_ROWS = 2_000


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    The windows' 64-bit hashes are sorted with the position in the low bits,
    so equal windows are neighbours; neighbours are compared in all bits.
    """
    n = F.size(words) - 2

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(F.get(h, i), F.get(h, i + 1), F.get(h, i + 2)))

    def covered(tri: Column, bits: Column) -> Column:
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1
        placed = F.sort_array(F.transform(tri, lambda h, i: h.bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("bigint"))))

        def same(a: Column, b: Column) -> Column:
            near = F.call_function("shiftrightunsigned", a.bitwiseXOR(b), bits) == 0
            return near & (F.get(tri, a.bitwiseAND(mask).cast("int")) == F.get(tri, b.bitwiseAND(mask).cast("int")))

        def count(s: Column) -> Column:
            twice = F.filter(s, lambda x, i: F.when(i > 0, same(x, F.get(s, i - 1))).otherwise(False) | F.when(i < F.size(s) - 1, same(x, F.get(s, i + 1))).otherwise(False))
            spots = F.flatten(F.transform(twice, lambda x: F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: x.bitwiseAND(mask) + k)))
            return F.size(F.array_distinct(spots))

        return let(placed, count)

    bits = F.ceil(F.log2(n + 1)).cast("int")
    whole = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(windows(h), lambda tri: covered(tri, bits)))
    return F.when(n < 2, 0).otherwise(whole).cast("bigint")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")


def dropped(text: Column, pattern: str) -> Column:
    """How many code points of ``text`` match ``pattern``, a class of single characters."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("bigint")


@dataclass(frozen=True)
class Features:
    """The numbers that rules read, as columns or as expressions on the text."""

    n_words: Column
    word_chars: Column
    n_symbols: Column
    n_lines: Column
    n_dup_lines: Column
    n_repeat_words: Column
    n_upper: Column

    @classmethod
    def of(cls, text: Column) -> "Features":
        words, lines = words_of(text), lines_with_words(text)
        return cls(
            n_words=F.size(words).cast("bigint"),
            word_chars=(F.char_length(text) - F.char_length(F.regexp_replace(text, "[^\\x20\\x09-\\x0D]+", ""))).cast("bigint"),
            n_symbols=dropped(text, SYMBOLS),
            n_lines=F.size(lines).cast("bigint"),
            n_dup_lines=let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint"),
            n_repeat_words=let(words, repeated_words).cast("bigint"),
            n_upper=dropped(text, r"\p{Lu}"),
        )


def rules(f: Features) -> dict[str, Column]:
    """Rejections: too short, repetitive, symbols, repeated lines, shouting, odd word lengths."""
    return {
        "few_words": f.n_words < MIN_WORDS,
        "repetitive": 100 * f.n_repeat_words > 50 * f.n_words,
        "symbols": 5 * f.n_symbols > f.n_words,
        "repeated_lines": 5 * f.n_dup_lines > 2 * f.n_lines,
        "shouting": 5 * f.n_upper > 2 * f.word_chars,
        "word_length": (f.word_chars < 2 * f.n_words) | (f.word_chars > 20 * f.n_words),
    }


def plan_cascade(docs: DataFrame, text: Column | None = None, sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules by rejections per second on a sample of at most about ``sample_rows`` rows, best first."""
    text = text_of() if text is None else text
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = cut(docs.select(text.alias("__text")).sample(share, seed=7).repartition(1))
    found = {}
    for name, rule in {"": F.lit(False), **rules(Features.of(F.col("__text")))}.items():
        begin = time.perf_counter()
        rejected = sample.agg(F.count_if(rule).alias("n")).first()["n"]
        found[name] = (rejected, time.perf_counter() - begin)
    idle = found.pop("")[1]
    return sorted(found, key=lambda name: -found[name][0] / max(found[name][1] - idle, 1e-3))


def rejected_by(found: dict[str, Column], order: list[str]) -> Column:
    """The first rule in ``order`` that rejects, null if none does; later rules are then not evaluated."""
    out = F.lit(None).cast("string")
    for name in reversed(order):
        out = F.when(found[name], F.lit(name)).otherwise(out)
    return out


def clean(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns.

    Null texts count as empty and are rejected as too short; equal rows share
    their verdict; no rows give no rows.  Only ``text`` is read.
    """
    order = order or plan_cascade(docs)
    return docs.filter(rejected_by(rules(Features.of(text_of())), order).isNull())


def measure(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """doc_id, the features, base_failed, rejected_by and kept of every row of ``docs`` (doc_id, text).

    Null texts are empty.  All features are returned, so all are computed here;
    the cascade runs on them.
    """
    order = order or plan_cascade(docs)
    text = F.col("__text")
    # Words and lines are arrays of their own columns, made once for what reads them.
    rows = docs.select("doc_id", text_of().alias("__text")).withColumns({"__words": words_of(text), "__lines": lines_with_words(text)})
    words, lines = F.col("__words"), F.col("__lines")
    rows = rows.select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
        dropped(text, SYMBOLS).alias("n_symbols"),
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        repeated_words(words).alias("n_repeat_words"),
        dropped(text, r"\p{Lu}").alias("n_upper"),
    )
    found = rules(Features(*[F.col(c) for c in Features.__dataclass_fields__]))
    base = found["few_words"] | found["repetitive"]
    return rows.withColumn("base_failed", base).withColumn("rejected_by", rejected_by(found, order)).withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri FROM d, unnest(range(1, len(w) - 1)) AS u(i)),
r AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, tri) > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
f AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper
  FROM d LEFT JOIN c USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 5 * n_symbols > n_words OR 5 * n_dup_lines > 2 * n_lines OR 5 * n_upper > 2 * word_chars
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""
