"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A text is read as units: words of at most ``WORD`` characters, and single code points where a run is longer or its
script is written without spaces. Four units are a k-mer with three inner s-mers of two units. A k-mer is chosen if
the smallest of its s-mers, by hash, is its first or its last (a closed syncmer). Neither units nor choice depend on an
offset, so the same passage yields the same anchors wherever it stands, and an edit moves only the anchors it touches.
:func:`located_anchors` returns all anchors with their places.

The fingerprint holds the hashes below one in ``SCALE`` of their range, and at least the ``LEAST`` smallest, so it
grows with the text; the likeness of two texts is read from their fingerprints alone. Fifty words hold about 33 anchors;
that another passage of that length leaves a fingerprint as it was has a chance of 0.75^66.

Scale: a fingerprint is made where the text is read, once. Placing each document beside its successor deals texts and
fingerprints out once, by ranges of doc_id; the first document of a range is sent to the range before as well. Only
the anchors of edited texts are made after that.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.base import SPACE, plain

# Longest run that is one unit.
WORD = 16
# Thai and Lao, Myanmar, Khmer, CJK with kana and the forms of both: no spaces between words.
UNSPACED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\uFF00-\uFFEF\x{20000}-\x{3FFFF}"
SPACED = f"[^{SPACE}{UNSPACED}]"
UNIT = f"(?<!{SPACED}){SPACED}{{1,{WORD}}}(?!{SPACED})|[^{SPACE}]"
# A fingerprint keeps one hash in so many, and this many at least.
SCALE, LEAST = 4, 64
# Digits of one hash in a fingerprint, and the bits they hold.
DIGITS, BITS = 12, 48
BELOW = (1 << BITS) // SCALE
# Ranges of doc_id for each shuffle partition.
RANGES_PER_PARTITION = 4
FIRST = -(1 << 63)
ANCHORS = "array<struct<hash: bigint, unit: int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def places(text: Column) -> Column:
    """All closed syncmers of a text, in order: array of (hash, unit), the number of the k-mer's first unit from 0.

    With fewer than four units, the text is a single anchor; if no k-mer is chosen, all are anchors. A text
    without units has none.
    """
    hashes = F.transform(F.regexp_extract_all(text, F.lit(UNIT), F.lit(0)), lambda u: F.xxhash64(u))

    def chosen(h: Column) -> Column:
        n = F.size(h)
        pairs = F.zip_with(F.slice(h, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(h, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.xxhash64(a, b))
        return F.when(n == 0, F.array().cast(ANCHORS)).when(n < 4, F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("unit")))).otherwise(_syncmers(pairs))

    return let(hashes, chosen)


def sketch_of(located: Column) -> Column:
    """The ascending hashes of a fingerprint, see the module."""
    short = F.transform(located, lambda x: F.shiftrightunsigned(x["hash"], 64 - BITS))

    def kept(ascending: Column) -> Column:
        return F.slice(ascending, F.lit(1), F.greatest(F.lit(LEAST), F.size(F.filter(ascending, lambda x: x < BELOW))))

    return let(F.array_distinct(F.sort_array(short)), kept)


def anchors(text: Column) -> Column:
    """The sketch of a text: ascending hashes of its closed syncmers, see :func:`places`."""
    return sketch_of(places(text))


def _syncmers(pairs: Column) -> Column:
    """Hashes and places of the chosen k-mers from the hashes of all pairs of units."""

    def pick(m: Column) -> Column:
        n = F.size(m) - 2
        triples = F.arrays_zip(F.slice(m, F.lit(1), n).alias("a"), F.slice(m, F.lit(2), n).alias("b"), F.slice(m, F.lit(3), n).alias("c"), F.sequence(F.lit(0), n - 1).alias("unit"))
        # The smallest s-mer is at an edge unless the middle one is smaller than both.
        at_edge = F.filter(triples, lambda x: (x["a"] <= x["b"]) | (x["c"] <= x["b"]))
        used = F.when(F.size(at_edge) > 0, at_edge).otherwise(triples)
        return F.transform(used, lambda x: F.struct(F.xxhash64(x["a"], x["c"]).alias("hash"), x["unit"].alias("unit")))

    return let(pairs, pick)


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda x: F.lpad(F.lower(F.hex(x)), DIGITS, "0")), "")


def reach(sketch: Column) -> Column:
    """Up to where a sketch holds every hash of its text."""
    return F.when(F.size(sketch) < LEAST, F.lit(1 << BITS)).otherwise(F.greatest(F.element_at(sketch, -1), F.lit(BELOW)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sketches as far as both reach; 1 for two empty ones.

    It is that of all anchors where both texts have fewer than ``LEAST``, and an unbiased estimate of it otherwise. It is
    1 only if the sketches are equal.
    """
    def compared(x: Column) -> Column:
        both = F.size(F.array_union(x["a"], x["b"]))
        return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x["a"], x["b"])) / both)

    def within(x: Column, common: Column) -> Column:
        return F.struct(*[F.filter(x[side], lambda h: h <= common).alias(side) for side in "ab"])

    return let(F.struct(a.alias("a"), b.alias("b")), lambda x: let(
        F.least(reach(x["a"]), reach(x["b"])), lambda common: let(within(x, common), compared)))


def located_anchors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, anchors): every anchor of every document with its place, see :func:`places`."""
    return plain(docs, id_col, text_col).select("doc_id", places(F.col("text")).alias("anchors"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint): equal texts have equal fingerprints, a null text that of the empty one, ''."""
    return plain(docs, id_col, text_col).select("doc_id", as_text(anchors(F.col("text"))).alias("fingerprint"))


def beside_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (doc_id, ...) with ``next_*`` of the columns of the next row in ascending (doc_id, first of
    ``columns``), null doc_ids first; after the last row comes the first."""
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(FIRST))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [i / ranges for i in range(1, ranges)]
    cuts = docs.agg(F.percentile_approx(key, parts, 10_000)).first()[0] or []
    number = F.size(F.filter(F.array(*map(F.lit, sorted(set(cuts)))).cast("array<bigint>"), lambda c: c <= key))
    # At most ``ranges`` rows.
    firsts = sorted((r[0], r[1]) for r in docs.groupBy(number.alias("r")).agg(F.min(key).alias("k")).collect())
    if not firsts:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in columns])
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}
    earlier = F.element_at(F.map_from_arrays(
        F.array(*[F.lit(k).cast("bigint") for k in before]), F.array(*[F.lit(r) for r in before.values()])), key)
    copies = F.when(earlier.isNull(), F.array(F.struct(number.alias("r"), F.lit(False).alias("extra")))).otherwise(
        F.array(F.struct(number.alias("r"), F.lit(False).alias("extra")), F.struct(earlier.alias("r"), F.lit(True).alias("extra"))))
    dealt = docs.select("*", F.explode(copies).alias("_at"))
    order = Window.partitionBy("_at.r").orderBy("_at.extra", "doc_id", columns[0])
    ahead = [F.lead(c).over(order).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *ahead).filter("NOT _at.extra").drop("_at")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of documents and of their edited texts, whose last quarter is the start of the next document.

    One row per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (see
    :func:`likeness`). The next document is the next row by doc_id (rows that repeat a doc_id in the order of a
    text hash); a single document is its own next. Null and empty texts have no anchors, and edited they remain
    empty; a null doc_id comes first; an empty table gives no row; other columns are not read.
    """
    texts = plain(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("hash"), "text", anchors(F.col("text")).alias("own")
    )
    placed = beside_next(texts, ["hash", "text", "own"])
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    made = placed.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "own", "next_own")
    both = made.select("*", anchors(F.col("edited")).alias("changed"))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"), as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
