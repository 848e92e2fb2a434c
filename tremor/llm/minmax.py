"""Near-duplicate classes of texts by min-max hashing.

A text's shingles are 64-bit hashes of runs of words. Under each of 64 permutations both the smallest and the
largest shingle are kept, so 128 signature values cost 64 hash evaluations. Bands of values that come from different
permutations are the keys of a join; candidates are confirmed on the whole shingle sets, and confirmed links
joined to components.

Groups are never paired out. Texts with equal sets become one class first. In each band bucket the classes are
compared with one of them, the pivot, and linked ones joined to components; further rounds take a pivot from the
largest component of each bucket that still spans several, and compare it with the classes outside. What then is left
outside, classes linked with no pivot, is compared only where two classes of different components share one of their
rarest shingles, as sets this similar must, and where enough shingles follow it in both. That finds every link among
them, also those of pairs that share no band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, forget_held, in_chunks, rows_of, ship_by_value, small_batches
from tremor.operators.components import connected_components
from tremor.operators.skew import balanced_join, is_small
from tremor.workspace import materialise, settled

PERMUTATIONS = 64
# Rows of a pivot that share one copy of its set.
PAIRS_PER_SPLIT = 2_000
ITEMS = "doc_id long, hash long, part int, n_shingles int, set_a long, set_b long, bands array<long>"
MASK = (1 << 64) - 1
# Rounds of pivots before the classes left outside are compared with each other.
STAR_ROUNDS = 4


def _numbers(seed: int, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers from a fixed sequence."""
    return np.array([xxhash.xxh3_64_intdigest(b"permutation", seed * 1_000_003 + i) | 1 for i in range(n)], dtype=np.uint64)


FACTORS, SHIFTS = _numbers(1, PERMUTATIONS), _numbers(2, PERMUTATIONS)
MIX = _numbers(3, 16)


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words, A-Z in lower case; of all words if there are fewer.

    Words end at ASCII white space. A text without words has no shingles.
    """
    tokens = text.encode().lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    n = min(words, len(h))
    out = np.full(len(h) - n + 1, n, dtype=np.uint64)
    for i in range(n):
        out = scramble(out * MIX[i] + h[i:len(h) - n + 1 + i])
    return np.unique(out)


def signature(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of a set under all permutations."""
    low = np.full(PERMUTATIONS, MASK, dtype=np.uint64)
    high = np.zeros(PERMUTATIONS, dtype=np.uint64)
    for at in range(0, len(s), 2048):
        x = FACTORS[:, None] * s[None, at:at + 2048] + SHIFTS[:, None]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return low, high


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of many sets (permutations x sets); small sets are evaluated together."""
    low = np.empty((PERMUTATIONS, len(sets)), dtype=np.uint64)
    high = np.empty((PERMUTATIONS, len(sets)), dtype=np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 2048):
            size += len(sets[end])
            end += 1
        if end == at + 1:
            low[:, at], high[:, at] = signature(sets[at])
        else:
            x = FACTORS[:, None] * np.concatenate(sets[at:end])[None] + SHIFTS[:, None]
            starts = np.cumsum([0, *(len(s) for s in sets[at:end - 1])])
            np.minimum.reduceat(x, starts, axis=1, out=low[:, at:end])
            np.maximum.reduceat(x, starts, axis=1, out=high[:, at:end])
        at = end
    return low, high


def value_places(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Which end (0 minimum, 1 maximum) of which permutation each (band, row) uses.

    Values are numbered through all bands, so none is used twice; a band of up to 64 rows holds no permutation twice.
    """
    number = np.arange(bands * rows).reshape(bands, rows)
    end = number % 2
    return end, (number // 2 + end * (PERMUTATIONS // 2)) % PERMUTATIONS


def band_keys(s: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of ``bands`` bands of ``rows`` values, minima and maxima in turn; no value is used twice."""
    return keys_of(np.stack(signature(s))[:, :, None], bands, rows)[0]


def keys_of(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band keys (sets x bands) of the signatures ``values`` (ends x permutations x sets)."""
    if bands * rows > 2 * PERMUTATIONS:
        raise ValueError(f"{bands} bands of {rows} need more than the {2 * PERMUTATIONS} values of a signature")
    end, at = value_places(bands, rows)
    key = np.repeat(scramble(np.arange(bands).astype(np.uint64) + np.uint64(1))[:, None], values.shape[2], axis=1)
    for r in range(rows):
        key = scramble(key * MIX[r] + values[end[:, r], at[:, r]])
    return np.ascontiguousarray(key.T).view(np.int64)


def parts_of(text: str, lines: bool) -> list[str]:
    return text.split("\n") if lines else [text]


def _items(docs: DataFrame, words: int, bands: int, rows: int, lines: bool, least: int) -> DataFrame:
    """One row per text, or per line of a text: its number in the text, the size and a 128-bit hash of its set, its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_held()
        none = np.zeros(0, dtype=np.uint64)

        def made():
            for doc_id, named, text in rows_of(batches, "doc_id", "hash", "text"):
                for part, one in enumerate(parts_of(text, lines)):
                    s = shingles(one, words)
                    if least > 1 and len(s) and len(one.split()) < least:
                        s = none
                    if len(s) or not lines:
                        yield doc_id, named, part, s

        def batch(held: list) -> pa.RecordBatch:
            ids, named, parts, sets = zip(*held)
            filled = [s for s in sets if len(s)]
            keys = iter(keys_of(np.stack(signatures(filled)), bands, rows).tolist() if filled else ())
            whole = [xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0 for s in sets]
            columns = [
                pa.array(ids, pa.int64()), pa.array(named, pa.int64()), pa.array(parts, pa.int32()),
                pa.array([len(s) for s in sets], pa.int32()), pa.array([_signed(w >> 64) for w in whole], pa.int64()),
                pa.array([_signed(w & MASK) for w in whole], pa.int64()),
                pa.array([next(keys) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "part", "n_shingles", "set_a", "set_b", "bands"])

        yield from in_chunks(made(), batch, 500)

    return docs.mapInArrow(run, ITEMS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def named_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with ``hash``: a row is known by its id and its text, so rows that share an id stay apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("hash"), "text")


def same_row(left: DataFrame, right: DataFrame):
    """Rows with the same id, null or not, and the same text."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["hash"] == right["hash"])


def _sets(docs: DataFrame, wanted: DataFrame, words: int, lines: bool) -> DataFrame:
    """(node, shingles) of the wanted classes, from one text each; ``wanted`` has node, doc_id, hash, part, set_a, set_b."""
    listed = wanted.groupBy("doc_id", "hash").agg(F.collect_list(F.struct("node", "part", "set_a", "set_b")).alias("wanted"))
    listed = materialise(listed, "wanted-texts")
    right = F.broadcast(listed) if is_small(listed, SMALL_ROWS) else listed
    found = docs.join(right, same_row(docs, listed)).select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for text, asked in rows_of(batches, "text", "wanted"):
                parts = parts_of(text, lines)
                for one in asked:
                    if one["part"] < len(parts):
                        s = shingles(parts[one["part"]], words).tobytes()
                        whole = xxhash.xxh3_128_intdigest(s)
                        if (_signed(whole >> 64), _signed(whole & MASK)) == (one["set_a"], one["set_b"]):
                            yield one["node"], s

        yield from in_chunks(made(), lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64(), pa.binary()])], names=["node", "shingles"]), 500)

    # A row that repeats in the table gives its set again.
    return materialise(found.mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"]), "shingle-sets")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, place): the rarest shingles of every set, up to where a near set must have shared one.

    Shingles are ranked by how many of the ``sets`` have them. Sets whose intersection is ``percent`` of their union
    share one of the first n - ceil(n * percent) + 1 of each; shingles of one set alone take up places, but no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, s in zip(batch.column("node").to_pylist(), batch.column("shingles")):
                values = np.frombuffer(s.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node)), pa.array(values)], names=["node", "token"])

    each = materialise(sets.mapInArrow(run, "node long, token long"), "set-tokens")
    held = materialise(each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "shared-tokens")
    shared = balanced_join(each, held, ["token"], "inner", ["node"], limit=5 * SMALL_ROWS)
    listed = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    sizes = sets.select("node", (F.octet_length("shingles") / 8).cast("int").alias("n"))
    # A set is as long as its text, and so is its list of tokens. Those of no other set come first of all.
    own = F.col("n") - F.size("tokens")
    room = (F.col("n") * (100 - percent) / 100).cast("int") + 1 - own
    cut = listed.join(sizes, "node").filter(room > 0).select(
        "node", "n", own.alias("own"), F.posexplode(F.slice("tokens", F.lit(1), room)).alias("i", "t")
    )
    return materialise(cut.select("t.token", "node", "n", (F.col("own") + F.col("i")).alias("place")), "prefixes")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v, both, whole): the sizes of the intersection and the union of each pair's sets, written."""
    right = sets.select(F.col("node").alias("v"), F.col("shingles").alias("set_v"))
    left = sets.select(F.col("node").alias("u"), F.col("shingles").alias("set_u"))
    # A pivot can be in most pairs; its set is repeated for every few thousand of them.
    with_u = balanced_join(pairs, left, ["u"], "inner", ["v"], rows_per_split=PAIRS_PER_SPLIT, small=False)
    joined = with_u.join(right, "v").select("u", "v", "set_u", "set_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for x, y in zip(batch.column("set_u"), batch.column("set_v")):
                a = np.frombuffer(x.as_buffer(), dtype=np.uint64)
                b = np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                sizes.append((both, len(a) + len(b) - both))
            both, whole = zip(*sizes) if sizes else ((), ())
            columns = [batch.column("u"), batch.column("v"), pa.array(both, pa.int64()), pa.array(whole, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["u", "v", "both", "whole"])

    return materialise(joined.mapInArrow(run, "u long, v long, both long, whole long"), "measured")


def near_classes(
    docs: DataFrame, words: int, percent: int, bands: int, rows: int, lines: bool = False, least: int = 1
) -> tuple[DataFrame, DataFrame]:
    """(items, classes) of the near-duplicate graph over ``docs`` (doc_id, text).

    ``items`` has a row per text (per line with at least ``least`` words, if ``lines``). ``classes`` has a row per
    distinct set: set_a, set_b, first (the smallest doc_id, hash and part that has the set), origin (the smallest in
    the set's component), members (texts in the component). A row is known by its doc_id and the hash of its text.
    """
    spark = docs.sparkSession
    docs = named_texts(docs)
    with small_batches(spark):
        items = materialise(_items(docs, words, bands, rows, lines, least), "shingle-items")

    def joined() -> DataFrame:
        # The band keys are made from the set, so those of any of its texts will do.
        classes = materialise(
            items.filter("n_shingles > 0").groupBy("set_a", "set_b").agg(
                F.min(F.struct("doc_id", "hash", "part")).alias("first"), F.max("n_shingles").alias("n"),
                F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"),
            ).withColumn("node", F.monotonically_increasing_id()),
            "shingle-classes",
        )
        banded = classes.select("node", "n", F.explode("bands").alias("key"))
        # Most keys occur once. They are counted by themselves, and only rows of the others are dealt.
        shared = materialise(banded.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key"), "shared-keys")
        right = F.broadcast(shared) if is_small(shared) else shared
        members = materialise(banded.join(right, "key").withColumn("label", F.col("node")), "buckets")
        wanted = classes.select("node", "set_a", "set_b", "first.*").join(members.select("node").distinct(), "node", "left_semi")
        labels = _linked(members, _sets(docs, wanted, words, lines), percent)
        named = classes.drop("bands").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        named = materialise(named, "classes-named")
        whole = named.groupBy("label").agg(F.min("first").alias("origin"), F.sum("copies").alias("members"))
        return named.join(whole, "label").select("set_a", "set_b", "first", "origin", "members")

    with small_batches(spark):
        return items, settled(spark, joined, "classes-joined")


def _linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the components among the nodes that share buckets; ``members`` has key, node, n, label = node."""
    labels = members.select("node", "label").distinct()

    def fits(n: str, other: str):
        """Sets whose sizes differ too much cannot be similar enough."""
        return F.least(n, other) * 100 >= F.greatest(n, other) * percent

    def merged(links: DataFrame) -> None:
        """Join the components that ``links`` connect."""
        nonlocal members, labels
        ends = links
        for end in ("u", "v"):
            at = labels.select(F.col("node").alias(end), F.col("label").alias(f"_{end}"))
            ends = balanced_join(ends, at, [end], "inner", ["u", "v"], limit=SMALL_ROWS)
        moved = connected_components(ends.select(F.col("_u").alias("u"), F.col("_v").alias("v")).distinct(), limit=SMALL_ROWS)
        to = moved.select(F.col("node").alias("label"), F.col("label").alias("_to"))
        small = is_small(to, SMALL_ROWS)

        def follow(df: DataFrame) -> DataFrame:
            found = df.join(F.broadcast(to) if small else to, "label", "left")
            return found.withColumn("label", F.coalesce("_to", "label")).drop("_to").select(df.columns)

        labels = materialise(follow(labels), "labels")
        # Buckets that lie in one component are done with.
        renamed = materialise(follow(members), "buckets")
        spread = renamed.groupBy("key").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).filter("_low < _high")
        members = materialise(renamed.join(spread.select("key"), "key"), "open-buckets")

    def linked(measured: DataFrame) -> DataFrame:
        return measured.filter(F.col("both") * 100 >= F.col("whole") * percent).select("u", "v")

    labels = materialise(labels, "labels")
    # The first pivot of a bucket, the same one wherever its bucket-mates meet, is compared with all of them.
    first = members.groupBy("key").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("p")).select("key", F.col("p.node").alias("pivot"))
    starred = materialise(members.join(first, "key"), "starred-buckets")
    before = materialise(starred.filter("pivot <> node").select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct(), "star-pairs")
    measured = _measured(before, sets)
    distance = measured.select(F.col("u").alias("pivot"), F.col("v").alias("node"), (1 - F.col("both") / F.col("whole")).alias("_far"))
    members = materialise(
        starred.join(distance, ["pivot", "node"], "left").select("key", "node", "n", "label", F.coalesce("_far", F.lit(0.0)).alias("far")),
        "measured-buckets",
    )
    if not is_small(linked(measured), 0):
        merged(linked(measured))
    span = 1 - percent / 100 + 1e-9
    for turn in range(1, STAR_ROUNDS):
        parts = members.groupBy("key", "label").agg(
            F.count(F.lit(1)).alias("_size"), F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "n", "far")).alias("_at")
        )
        pivots = parts.groupBy("key").agg(F.max(F.struct("_size", "_at", "label")).alias("p"))
        pivots = pivots.select(
            "key", F.col("p._at.node").alias("pivot"), F.col("p._at.n").alias("_n"), F.col("p._at.far").alias("_far"), F.col("p.label").alias("_label")
        )
        pairs = members.join(pivots, "key").filter(
            (F.col("label") != F.col("_label")) & fits("n", "_n") & (F.abs(F.col("far") - F.col("_far")) <= span)
        ).select(F.col("pivot").alias("u"), F.col("node").alias("v")).distinct()
        pairs = materialise(pairs.join(before, ["u", "v"], "left_anti"), "star-pairs")
        tested = pairs.count()
        if not tested:
            break
        before = before.unionByName(pairs)
        links = linked(_measured(pairs, sets))
        found = links.count()
        if found:
            merged(links)
        if found * 20 < tested or is_small(members, 0):
            break
    if is_small(members, 0):
        return labels
    # Classes outside the largest components: whom can they still be linked with? Only with one that shares a rare shingle.
    rest = members.groupBy("node").agg(F.first("label").alias("label"))
    rest = materialise(rest, "rest")
    right = F.broadcast(rest) if is_small(rest, SMALL_ROWS) else rest
    prefixes = _prefixes(sets.join(F.broadcast(rest) if right is not rest else rest, "node", "left_semi"), percent)
    placed = materialise(prefixes.join(right, "node"), "placed-prefixes")
    a, b = placed.alias("a"), placed.alias("b")
    n = F.col("a.n") + F.col("b.n")
    # What can still be shared from the first common shingle on must reach the intersection that a link needs.
    reach = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    across = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.label") < F.col("b.label")) & fits("a.n", "b.n")
                    & (reach * (100 + percent) >= n * percent))
    pairs = across.select(F.col("a.node").alias("u"), F.col("b.node").alias("v")).distinct()
    for u, v in (("u", "v"), ("v", "u")):
        pairs = pairs.join(before.select(F.col("u").alias(u), F.col("v").alias(v)), ["u", "v"], "left_anti")
    links = linked(_measured(materialise(pairs, "cross-pairs"), sets))
    if not is_small(links, 0):
        merged(links)
    return labels


def with_class(items: DataFrame, classes: DataFrame) -> DataFrame:
    """``items`` beside their class; a set held by most items is spread."""
    return balanced_join(items, classes, ["set_a", "set_b"], "left", ["doc_id", "part"], limit=SMALL_ROWS)


ship_by_value(__name__)
