"""Semi and anti joins in which a digest of the smaller side's keys keeps the larger side out of the shuffle.

A digest is a bitmap: every key sets the bit that its hash names. It is made by an aggregation with map-side
combine, holds ``BITS_PER_KEY`` bits a key, and is broadcast only below ``DIGEST_BYTES``; with more keys the join is an
ordinary balanced one. A row whose bit is not set has no partner for certain. What is left, the partners and about one
row in eight of the others, is joined exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremor.operators.skew import BROADCAST_ROWS, balanced_join
from tremor.workspace import materialise

BITS_PER_KEY = 8
# With fewer bits a key than this a digest lets too many rows pass.
LEAST_BITS_PER_KEY = 2
DIGEST_BYTES = 64 << 20
# Bits of one array element, and of one row of the digest.
WORD_BITS, BLOCK_BITS = 64, 1 << 15
# Types whose equal values have equal hashes.
HASHED = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.StringType(), T.BinaryType(), T.BooleanType(), T.DateType(),
          T.TimestampType())


@dataclass(frozen=True)
class Digest:
    """``table`` (block, words) with the set bits of ``bits`` slots; ``lowest`` and ``highest`` of the first key."""

    table: DataFrame
    keys: list[str]
    bits: int
    lowest: object
    highest: object

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.bits))

    def marked(self, df: DataFrame, name: str = "_met") -> DataFrame:
        """``df`` with a flag that is false only for rows without a partner."""
        slot = self._slot()
        word = F.get("_words", F.pmod(F.floor(slot / WORD_BITS), F.lit(BLOCK_BITS // WORD_BITS)).cast("int"))
        bit = F.getbit(word, F.pmod(slot, F.lit(WORD_BITS)).cast("int")) == 1
        blocks = F.broadcast(self.table.withColumnsRenamed({"block": "_block", "words": "_words"}))
        joined = df.withColumn("_at", F.floor(slot / BLOCK_BITS)).join(blocks, F.col("_at") == F.col("_block"), "left")
        return joined.withColumn(name, F.coalesce(bit, F.lit(False))).drop("_at", "_block", "_words")

    def possible(self, df: DataFrame) -> DataFrame:
        """The rows that may have a partner. The range of the first key reaches the scan."""
        first = F.col(self.keys[0])
        in_range = df.filter((first >= F.lit(self.lowest)) & (first <= F.lit(self.highest)))
        return self.marked(in_range).filter("_met").drop("_met")


def slots_for(keys: int, most_bytes: int | None = None) -> int | None:
    """Bits of a digest of so many keys, a power of two; None if no digest within the bytes is worth its while."""
    most = 8 * (DIGEST_BYTES if most_bytes is None else most_bytes)
    wanted = max(BLOCK_BITS, 1 << (BITS_PER_KEY * keys - 1).bit_length() if keys else 0)
    while wanted > most:
        wanted //= 2
    return wanted if wanted >= max(BLOCK_BITS, LEAST_BITS_PER_KEY * keys) else None


def key_digest(df: DataFrame, keys: list[str], bits: int) -> Digest:
    """The digest of the keys of ``df``, written as a table. Rows with a NULL in a key match nothing and stay out."""
    known = df.select(*keys).dropna()
    slot = F.pmod(F.xxhash64(*keys), F.lit(bits))
    per_block = BLOCK_BITS // WORD_BITS
    words = (
        known.select(slot.alias("slot"))
        .select(F.floor(F.col("slot") / WORD_BITS).alias("at"), F.expr(f"shiftleft(1L, cast(pmod(slot, {WORD_BITS}) as int))").alias("bit"))
        .groupBy("at").agg(F.bit_or("bit").alias("word"))
    )
    held = F.map_from_entries(F.collect_list(F.struct(F.pmod("at", F.lit(per_block)).cast("int").alias("k"), "word")))
    blocks = words.groupBy(F.floor(F.col("at") / per_block).alias("block")).agg(held.alias("held")).select(
        "block", F.transform(F.sequence(F.lit(0), F.lit(per_block - 1)), lambda i: F.coalesce(F.element_at("held", i), F.lit(0).cast("bigint"))).alias("words")
    )
    ends = known.agg(F.min(keys[0]).alias("lowest"), F.max(keys[0]).alias("highest")).first()
    return Digest(materialise(blocks, "key-digest"), keys, bits, ends["lowest"], ends["highest"])


def _hashed_alike(left: DataFrame, right: DataFrame, keys: list[str]) -> bool:
    return all(left.schema[k].dataType == right.schema[k].dataType and left.schema[k].dataType in HASHED for k in keys)


def narrowed_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, spread: list[str] | None = None, limit: int | None = None,
    rows_per_split: int | None = None, most_bytes: int | None = None,
) -> DataFrame:
    """The left_semi or left_anti join on ``keys``; NULL keys match nothing.

    A ``right`` of at most ``limit`` rows is broadcast. Otherwise the side with fewer rows gets a digest. If that is the
    left, only the keys of the right that may occur there are written and joined. If it is the right, only the rows of
    the left that may have a partner are shuffled; the others are dropped (semi) or kept where they are (anti).

    Both sides are read several times: pass scans. Keys of two types, or of types that compare equal under several
    representations, are joined without a digest.
    """
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    right = right.select(*keys)
    many = right.count()
    small = many <= (BROADCAST_ROWS if limit is None else limit)
    few = None if small or not _hashed_alike(left, right, keys) else left.count()
    bits = None if few is None else slots_for(min(few, many), most_bytes)

    def joined(rows: DataFrame, partners: DataFrame, small: bool | None = None) -> DataFrame:
        return balanced_join(rows, partners, keys, how, spread, limit, rows_per_split, small=small)

    if bits is None:
        return joined(left, right, small)
    if few <= many:
        return joined(left, materialise(key_digest(left, keys, bits).possible(right).distinct(), "narrowed-keys"))
    digest = key_digest(right, keys, bits)
    if how == "left_semi":
        return joined(digest.possible(left), right, small=False)
    marked = digest.marked(left)
    return marked.filter("not _met").drop("_met").unionByName(joined(marked.filter("_met").drop("_met"), right, small=False))
