"""Document fingerprints as threshold-scaled sketches (operator 3), in DataFrame expressions only.

A sketch holds every hash of a five-word shingle below a fixed fraction of
the hash range, so it grows with its document, sketches of parts merge by
union, and containment can be estimated between documents of very unequal
length.  Where fewer than ``FLOOR`` hashes fall below the threshold, the
``FLOOR`` smallest are kept; such a sketch is complete up to its largest hash
and merges just as well.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import let, shuffle_width, text_of, words_of

WORDS = 5
FLOOR = 16
#: Hashes are 63-bit; this keeps one in eight.
THRESHOLD = 1 << 60
TOP = (1 << 63) - 1
#: Text that one bucket of the ordered layout holds, about.
BUCKET_BYTES = 32 << 20


def shingle_hashes(text: Column, n: int = WORDS) -> Column:
    """Hashes of all ``n``-word shingles; a shorter text is one shingle, no words give none."""

    def of(h: Column) -> Column:
        window = F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(h, i + k) for k in range(n)]), 1))
        short = F.array(F.shiftrightunsigned(F.xxhash64(h), 1))
        return F.when(F.size(h) >= n, window).when(F.size(h) > 0, short).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words_of(text), lambda w: F.xxhash64(w)), of)


def reduced(hashes: Column, threshold: int = THRESHOLD, floor: int = FLOOR) -> Column:
    """The sketch of a set of hashes: increasing, distinct."""

    def of(h: Column) -> Column:
        below = F.sort_array(F.array_distinct(F.filter(h, lambda v: v < F.lit(threshold))))
        return let(below, lambda b: F.when(F.size(b) >= floor, b).otherwise(F.slice(F.sort_array(F.array_distinct(h)), 1, floor)))

    return let(hashes, of)


def sketch(text: Column) -> Column:
    return reduced(shingle_hashes(text))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents together."""
    return reduced(F.concat(a, b))


def _reach(s: Column, threshold: int, floor: int) -> Column:
    """Up to which hash the sketch is complete."""
    return F.when(F.size(s) < floor, F.lit(TOP)).otherwise(F.greatest(F.lit(threshold - 1), F.get(s, F.size(s) - 1)))


def _shared(a: Column, b: Column, ratio, threshold: int, floor: int) -> Column:
    def cut_both(a: Column, b: Column) -> Column:
        top = F.least(_reach(a, threshold, floor), _reach(b, threshold, floor))
        return let(top, lambda t: F.struct(F.filter(a, lambda v: v <= t).alias("a"), F.filter(b, lambda v: v <= t).alias("b")))

    def of(p: Column) -> Column:
        return let(F.size(F.array_intersect(p["a"], p["b"])), lambda both: ratio(both, F.size(p["a"]), F.size(p["b"])))

    return let(F.struct(a.alias("a"), b.alias("b")), lambda p: let(cut_both(p["a"], p["b"]), of))


def resemblance(a: Column, b: Column, threshold: int = THRESHOLD, floor: int = FLOOR) -> Column:
    """Estimated share of common shingles, 0 to 1; two documents without words are alike."""
    return _shared(a, b, lambda both, x, y: F.when(x + y == 0, 1.0).otherwise(both / F.greatest(x + y - both, F.lit(1))), threshold, floor).cast("double")


def containment(a: Column, b: Column, threshold: int = THRESHOLD, floor: int = FLOOR) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has: 1 where ``a`` has no words, null where none of its hashes can be compared.

    Both sketches are cut to what both hold in full.  Of a short ``a`` against
    a long ``b`` nothing may be left below that: then nothing is known.
    """
    share = _shared(a, b, lambda both, x, y: F.when(x > 0, both / F.greatest(x, F.lit(1))), threshold, floor)
    return F.when(F.size(a) == 0, 1.0).otherwise(share).cast("double")


def as_text(s: Column) -> Column:
    return F.lower(F.array_join(F.transform(s, lambda v: F.hex(v)), "-"))


def rank_in(values: list[int], x: Column, strict: bool) -> Column:
    """How many of the increasing ``values`` are below ``x`` (or at most ``x``), by binary search."""
    steps = [1 << k for k in range(max(len(values), 1).bit_length() - 1, -1, -1)]
    held = F.lit(values).cast("array<bigint>") if values else F.array().cast("array<bigint>")

    def step(at: Column, more: Column) -> Column:
        v = F.get(held, at + more - 1)
        hit = (v < x) if strict else (v <= x)
        return F.when((at + more <= len(values)) & hit, at + more).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)


def with_next_text(docs: DataFrame, prepare, bucket_bytes: int = BUCKET_BYTES) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, prepared columns, ``__end``) in buckets that follow doc_id order, and the window inside a bucket.

    Buckets are bounded by quantiles of doc_id; an id that fills several is cut by the text's hash.
    The first row of each bucket is added to the bucket before it as its last row, marked ``__end``
    (the first of all to the last bucket), so ``lead`` finds every row's successor without a global window.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", text_of().alias("text")).withColumn("__key", key).withColumn("__hash", F.xxhash64("text"))
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_of())), F.lit(0)).alias("n")).first()["n"]
    n = max(2 * shuffle_width(docs.sparkSession), ceil(total / bucket_bytes))
    found = docs.agg(F.percentile_approx(key, [k / n for k in range(1, n)], 100 * n).alias("q")).first()["q"] or []
    low, high = rank_in(found, F.col("__key"), True), rank_in(found, F.col("__key"), False)
    # Where the id is itself a border, its rows are dealt over the buckets that it fills by hash.
    part = (F.shiftright("__hash", 33) + (1 << 30)) / float(1 << 31)
    rows = rows.withColumns({"__low": low, "__high": high}).withColumn("__bucket", (F.col("__low") + F.least(F.floor(part * (F.col("__high") - F.col("__low") + 1)), F.col("__high") - F.col("__low"))).cast("int"))
    rows = rows.drop("__low", "__high")
    # First keys of the buckets: at most n narrow rows; then the texts of just these rows.
    keys = rows.groupBy("__bucket").agg(F.min(F.struct("__key", "__hash")).alias("f")).select("__bucket", "f.__key", "f.__hash").collect()
    keys.sort(key=lambda r: r["__bucket"])
    before = {r["__bucket"]: keys[i - 1]["__bucket"] for i, r in enumerate(keys)}
    heads = docs.sparkSession.createDataFrame([(r["__key"], r["__hash"], before[r["__bucket"]]) for r in keys], "__key bigint, __hash bigint, __before int")
    ends = rows.join(F.broadcast(heads), ["__key", "__hash"]).dropDuplicates(["__key", "__hash"])
    ends = ends.select("doc_id", "text", F.lit(TOP).alias("__key"), F.lit(TOP).alias("__hash"), F.col("__before").alias("__bucket"), F.lit(True).alias("__end"))
    both = rows.withColumn("__end", F.lit(False)).unionByName(ends).repartition(shuffle_width(docs.sparkSession), "__bucket")
    return prepare(both), Window.partitionBy("__bucket").orderBy("__end", "__key", "__hash")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last quarter (rounded down, in code points)
    replaced by the beginning of the next document in ascending doc_id order;
    the last document is followed by the first, a single one by itself.  Null
    texts are empty; null ids come first; rows that share an id are ordered by
    their text's hash, equal rows follow one another.  Other columns are
    ignored.
    """
    rows, window = with_next_text(docs, lambda both: both.withColumn("__sketch", sketch(F.col("text"))))
    rows = rows.withColumns({"__next": F.lead("text").over(window), "__next_sketch": F.lead("__sketch").over(window)}).filter(~F.col("__end"))
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    moved = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - moved), F.substring(F.col("__next"), F.lit(1), moved))
    rows = rows.withColumn("__edited", edited).withColumn("__edited_sketch", sketch(F.col("__edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("__edited", 256).alias("edited_sha256"),
        as_text(F.col("__sketch")).alias("fingerprint"),
        as_text(F.col("__edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("__sketch"), F.col("__edited_sketch")).alias("near_edited"),
        resemblance(F.col("__sketch"), F.col("__next_sketch")).alias("near_next"),
    )
