"""Ranked lexical search over hashed max-sketches.

The index keeps, per document, its terms with their counts and a sketch: an array of bytes in which every term's impact
raises two hashed coordinates to at least its own. The smaller of a term's two coordinates is never below the term's
impact in the document, so the weighted sum over a query's terms is an upper bound of the document's score. Impacts
grow with the count of a term alone while the length of the document is fixed, hence a coordinate holds a count, coded
in a byte and rounded up, and the index stays valid as the collection grows.

A search looks all queries of a batch up in the sketches of a block of documents at once. In each task and for each
query, documents are scored exactly from their terms, the highest bounds first, until the next bound is below the
lowest score of the best so far; thresholds are carried on from block to block. Each task sends its best documents of
each query, and the best of those are the result: no document is left out by anything but its bound.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.base import in_chunks, plain, rows_of, ship_by_value
from tremor.operators.ranking import batches as in_batches
from tremor.workspace import materialise, settled

# Coordinates of a sketch for each distinct term of its document.
WIDTH = 8
# Documents looked up together, and queries of one pass over the index.
BLOCK, QUERIES = 512, 256
# Query terms looked up together.
TERMS = 4096
TOP = 20
INDEX = "doc_id long, n long, terms binary, counts binary, sketch binary"

# Terms are runs of digits, letters and everything beyond ASCII; A-Z are lowered and all other bytes end a term.
FOLD = bytes(b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
# Counts a byte of a sketch stands for: exact up to 127, then by steps of a tenth; the last one stands for any count.
COUNTS = np.concatenate([np.arange(128), np.ceil(127 * 1.1 ** np.arange(1, 128))]).astype(np.int64)
# An impact is below this, whatever the count.
IMPACT = 1_000_000


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


def impact(count, length_part):
    """What ``count`` places of a term contribute, in millionths; ``length_part`` is the document's m."""
    return (1_000_000_000 * count) // (1000 * count + 12 * length_part)


def places(hashes: np.ndarray, width) -> tuple[np.ndarray, np.ndarray]:
    """The two coordinates of each hash in a sketch of ``width``, a power of two."""
    mixed = (hashes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mask = np.asarray(width, dtype=np.int64) - 1
    return (mixed >> np.uint64(33)).astype(np.int64) & mask, (mixed >> np.uint64(2)).astype(np.int64) & 0x7FFFFFFF & mask


def sketch_of(counts: Counter) -> np.ndarray:
    """The coordinatewise maxima of the byte codes of a document's term counts."""
    width = max(64, 1 << (WIDTH * len(counts) - 1).bit_length())
    hashes = np.fromiter(map(zlib.crc32, counts), dtype=np.uint32, count=len(counts))
    codes = np.searchsorted(COUNTS, np.fromiter(counts.values(), dtype=np.int64, count=len(counts))).astype(np.uint8)
    out = np.zeros(width, dtype=np.uint8)
    for at in places(hashes, width):
        np.maximum.at(out, at, codes)
    return out


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with a term: doc_id, n (terms with repeats), terms, counts, sketch.

    Terms are runs of ASCII digits, letters (A-Z lowered) and all characters beyond ASCII. Whole texts are read where
    they lie, and nothing is shuffled. Null, empty and blank texts have no row; repeated rows have one each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def indexed():
            for doc_id, text in rows_of(batches, "doc_id", "text"):
                counts = Counter(terms_of(text))
                if counts:
                    held = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
                    yield doc_id, int(held.sum()), b" ".join(counts), held.astype(np.uint32).tobytes(), sketch_of(counts).tobytes()

        def batch(rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts", "sketch"])

        yield from in_chunks(indexed(), batch, 500)

    return plain(docs, id_col, text_col).mapInArrow(run, INDEX)


def frequencies(index: DataFrame, wanted: list[bytes]) -> dict[bytes, int]:
    """How many documents hold each of the ``wanted`` terms; one row per wanted term and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(wanted)}
        held = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            for terms in batch.column("terms"):
                for term in number.keys() & terms.as_py().split(b" "):
                    held[number[term]] += 1
        at = np.nonzero(held)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "df"])

    counted = index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {wanted[r["term"]]: r["df"] for r in counted.collect()}


class Lookup:
    """A batch of queries, ready to be looked up in sketches. ``queries`` holds (item, terms with repeats)."""

    def __init__(self, queries: list[tuple[int, Counter]], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
        # A term that no document holds adds nothing.
        self.weighted = [{t: weight[t] * times for t, times in terms.items() if weight.get(t)} for _, terms in queries]
        vocabulary = sorted({t for terms in self.weighted for t in terms})
        at = {t: i for i, t in enumerate(vocabulary)}
        self.hashes = np.fromiter(map(zlib.crc32, vocabulary), dtype=np.uint32, count=len(vocabulary))
        self.matrix = np.zeros((len(vocabulary), len(queries)), dtype=np.float32)
        for q, terms in enumerate(self.weighted):
            for t, w in terms.items():
                self.matrix[at[t], q] = w

    def length_part(self, n):
        return 100 - 25 + (25 * n * self.n_docs) // self.n_terms

    def bounds(self, n: np.ndarray, sketches: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Upper bounds (documents x queries) of the scores of documents whose sketches lie one after another."""
        width = np.diff(offsets)[:, None]
        part = self.length_part(n)[:, None]
        out = np.zeros((len(n), self.matrix.shape[1]))
        for start in range(0, len(self.hashes), TERMS):
            one, two = places(self.hashes[None, start:start + TERMS], width)
            one += offsets[:-1, None]
            two += offsets[:-1, None]
            codes = np.minimum(sketches[one], sketches[two])
            doc, term = np.nonzero(codes)
            code = codes[doc, term]
            most = np.where(code < 255, impact(COUNTS[np.minimum(code, 254)], part[doc, 0]), IMPACT)
            impacts = np.zeros(codes.shape, dtype=np.float32)
            impacts[doc, term] = most
            out += impacts @ self.matrix[start:start + TERMS]
        # Sums of so many positive single-precision products are off by less than a thousandth.
        return out * 1.001

    def score(self, q: int, counts: dict[bytes, int], part: int) -> int:
        return sum(w * impact(counts[t], part) for t, w in self.weighted[q].items() if t in counts)


class Best:
    """The ``top`` best documents of each query so far: higher scores first, then smaller ids, null ids last."""

    def __init__(self, queries: int, top: int):
        self.top = top
        self.held: list[list[tuple]] = [[] for _ in range(queries)]
        self.least = np.zeros(queries)  # a document below this score cannot enter

    def add(self, q: int, score: int, doc_id: int | None) -> None:
        held = self.held[q]
        held.append((-score, doc_id is None, doc_id or 0))
        if len(held) >= 4 * self.top:
            self.trim(q)

    def trim(self, q: int) -> None:
        held = self.held[q]
        held.sort()
        del held[self.top:]
        if len(held) == self.top:
            self.least[q] = -held[-1][0]


def search_block(lookup: Lookup, best: Best, batch: pa.RecordBatch) -> None:
    """Score the documents of one block whose bounds reach what the queries' best documents have."""
    n = batch.column("n").to_numpy()
    sketch = batch.column("sketch").to_pylist()
    offsets = np.cumsum([0, *map(len, sketch)])
    bounds = lookup.bounds(n, np.frombuffer(b"".join(sketch), dtype=np.uint8), offsets)
    ids, part = batch.column("doc_id").to_pylist(), lookup.length_part(n).tolist()
    opened: dict[int, dict[bytes, int]] = {}
    for q in range(bounds.shape[1]):
        bound = bounds[:, q]
        reach = np.nonzero((bound > 0) & (bound >= best.least[q]))[0]
        for turn, d in enumerate(reach[np.argsort(-bound[reach], kind="stable")].tolist()):
            if turn % best.top == 0:
                best.trim(q)
            if bound[d] < best.least[q]:
                break
            if d not in opened:
                terms = batch.column("terms")[d].as_py().split(b" ")
                opened[d] = dict(zip(terms, np.frombuffer(batch.column("counts")[d].as_py(), dtype=np.uint32).tolist()))
            score = lookup.score(q, opened[d], part[d])
            if score > 0:
                best.add(q, score, ids[d])
        best.trim(q)


def search(index: DataFrame, queries: list[tuple[int, Counter]], n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """(item, doc_id, score) candidates of one batch of queries: the ``top`` best of every task."""
    lookup = Lookup(queries, frequencies(index, sorted({t for _, terms in queries for t in terms})), n_docs, n_terms)
    items = [item for item, _ in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items), top)
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                search_block(lookup, best, batch.slice(start, BLOCK))
        rows = [(item, None if null else doc_id, -low) for item, held in zip(items, best.held) for low, null, doc_id in held]
        if rows:
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def _items(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (item, item_id, text) in batches; ``item`` numbers the distinct ids, null among them."""
    texts = queries.select(F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    numbered = materialise(
        in_batches(materialise(texts.select("item_id").distinct(), "items"), ["item_id"], QUERIES, "batch")
        .withColumn("item", F.monotonically_increasing_id()).withColumnRenamed("item_id", "_id"),
        "items-numbered",
    )
    return materialise(texts.join(numbered, F.col("item_id").eqNullSafe(F.col("_id"))).drop("_id"), "item-texts")


def ranked_search(
    docs: DataFrame, queries: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", top: int = TOP,
) -> DataFrame:
    """The ``top`` documents of every item with a score above 0: item_id, rank (from 1), doc_id, score; written.

    A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))), a document's length part m = 75 + 25 n N div L, and its
    score sums weight * (10^9 tf div (1000 tf + 12 m)) over the item's terms, repeats included. N counts documents
    with a term, L all terms of all documents. Equal scores rank by ascending doc_id, a null id last. Rows that repeat
    a document are ranked one by one; rows that repeat an item and its text count once, and different texts of one item
    (null is an item too) are one query with all their terms. Items or documents without terms, and empty tables, give
    no row. Queries are taken in batches, each of which reads the index once; other columns are not read.
    """
    spark = docs.sparkSession

    def make() -> DataFrame:
        index = materialise(build_index(docs, id_col, text_col), "search-index")
        size = index.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        items = _items(queries, item_col, item_text_col)
        found = spark.createDataFrame([], "item long, doc_id long, score long")
        for (batch,) in items.select("batch").distinct().orderBy("batch").collect() if size["docs"] else []:
            asked: dict[int, Counter] = {}
            for row in items.filter(F.col("batch") == batch).select("item", "text").collect():
                asked.setdefault(row["item"], Counter()).update(terms_of(row["text"]))
            best = search(index, sorted(asked.items()), size["docs"], size["terms"], top)
            found = found.unionByName(materialise(best, "search-candidates"))
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        named = items.select("item", "item_id").distinct()
        return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")

    return settled(spark, make, "search-results")


ship_by_value(__name__)
