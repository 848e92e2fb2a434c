"""Vector code compression: product quantisation with integer codebooks and adaptive distance bounds.

Vectors are cut into parts, and every part gets the number of the nearest entry of its position's codebook. Codebooks
are refined by Lloyd rounds. After Drake and Hamerly, a row keeps, per part, its b closest entries in the order of
lower bounds on their distances, and one bound for all the others. When entries move, bounds move with them; a part
whose own entry stays below every bound needs one distance, one that does not compares only the entries whose bounds
it reaches, and only if the outer bound is reached too are all entries compared. Bounds are floating-point numbers
rounded down; what they cannot settle is decided by integer distances, so the codes are those of comparing everything.

A row's state travels with its vector in one written table per round; the table before it is deleted. Rows are never
shuffled: tasks send sums per entry, a table of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, ship_by_value
from tremor.operators.skew import balanced_join
from tremor.workspace import discard, materialise, new_path, settled

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Closest entries kept per part at first, and at least.
MOST_KEPT, LEAST_KEPT = 32, 2
# Fewer entries are kept once this share of all parts is settled by fewer.
SETTLED = 0.98
BLOCK = 4096
STATE = "vec_id long, label {label}, ints array<long>, near binary, low binary, outer binary, used binary, error long"
UP, DOWN = 1 + 1e-12, 1 - 3e-7


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, ints) of the vectors without null, NaN or infinite components, floor(1024 * x) each."""
    clean = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("_v")
    ).filter(F.col("_v").isNotNull() & ~F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return clean.select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * SCALE)).alias("ints"))


def cuts(length: int, parts: int) -> list[tuple[int, int]]:
    return [(p * length // parts, (p + 1) * length // parts) for p in range(parts)]


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` to all ``entries``; exact, as every term stays below 2**53."""
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def checked(ints: np.ndarray) -> np.ndarray:
    """The components as exact doubles; larger ones than doubles can square exactly are refused."""
    if ints.size and 8.0 * ints.shape[1] * float(np.abs(ints.astype(np.float64)).max()) ** 2 >= 2.0**53:
        raise ValueError("a vector component is too large for exact squared distances")
    return ints.astype(np.float64)


def first_state(x: np.ndarray, entries: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """(near, low, outer, error) of one part position from all distances; ties go to the lower index."""
    all_of = distances(x, entries)
    order = np.argsort(all_of, axis=1, kind="stable")[:, :keep + 1]
    sorted_of = np.take_along_axis(all_of, order, axis=1)
    low = np.sqrt(sorted_of) * DOWN
    outer = low[:, keep] if order.shape[1] > keep else np.full(len(x), np.inf)
    return order[:, :keep], low[:, :keep], outer, sorted_of[:, 0]


def next_state(
    x: np.ndarray, entries: np.ndarray, drift: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray, keep: int
) -> tuple[np.ndarray, ...]:
    """The state after the entries moved by at most ``drift``: (near, low, outer, error, used).

    ``used`` is how many kept entries were needed to settle the row, 255 if all entries were compared.
    """
    rows = np.arange(len(x))
    low = low - drift[near]
    outer = outer - drift.max()
    # Entries whose place in the order was lost are bounded by those that follow, so the bounds ascend again.
    ordered = np.minimum.accumulate(np.concatenate([low, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    own = ((x - entries[near[:, 0]]) ** 2).sum(axis=1)
    reach = np.sqrt(own) * UP
    doubt = ordered[:, :-1] <= reach[:, None]
    doubt[:, 0] = True
    used = doubt.sum(axis=1)
    full = ordered[:, -1] <= reach
    some = (used > 1) & ~full
    exact = np.full(near.shape, np.inf)
    exact[:, 0] = own
    at, place = np.nonzero(doubt & some[:, None])
    exact[at, place] = ((x[at] - entries[near[at, place]]) ** 2).sum(axis=1)
    # The nearest of the compared entries; of equal ones the lowest index.
    least = exact.min(axis=1)
    best = np.where(exact == least[:, None], near, len(entries)).argmin(axis=1)
    bound = np.where(np.isfinite(exact), np.sqrt(np.where(np.isfinite(exact), exact, 0)) * DOWN, ordered[:, :-1])
    rank = bound.copy()
    rank[rows, best] = -1
    order = np.argsort(rank, axis=1, kind="stable")
    near, low = np.take_along_axis(near, order, axis=1), np.take_along_axis(bound, order, axis=1)
    outer, error = ordered[:, -1].copy(), least
    if low.shape[1] > keep:
        outer = np.minimum(outer, low[:, keep:].min(axis=1))
        near, low = near[:, :keep], low[:, :keep]
    if full.any():
        near[full], low[full], outer[full], error[full] = first_state(x[full], entries, near.shape[1])
        used = np.where(full, 255, used)
    return near, low, outer, error, used


def _fixed(column, kind, shape) -> np.ndarray:
    """The rows of a binary column of equal lengths as one array."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=kind).reshape(shape)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.nbytes // len(rows)
    return pa.array([rows.data.cast("B")[i * width:(i + 1) * width].tobytes() for i in range(len(rows))], pa.binary())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            yield batch.slice(start, BLOCK)


def _ints(batch: pa.RecordBatch, length: int) -> np.ndarray:
    return batch.column("ints").flatten().to_numpy().reshape(batch.num_rows, length)


def _assign(table: DataFrame, books: list[np.ndarray], before: list[np.ndarray] | None, kept: int, keep: int) -> DataFrame:
    """One assignment: the state of every row under ``books``; from scratch, or from the state under the books ``before``."""
    length = sum(b.shape[1] for b in books)
    spans = cuts(length, len(books))
    drifts = before and [np.sqrt(((b - a) ** 2).sum(axis=1)) * UP for a, b in zip(before, books)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            n = batch.num_rows
            ints = checked(_ints(batch, length))
            if before is not None:
                held = (
                    _fixed(batch.column("near"), np.uint8, (n, len(books), kept)),
                    _fixed(batch.column("low"), np.float32, (n, len(books), kept)),
                    _fixed(batch.column("outer"), np.float32, (n, len(books))),
                )
            made = []
            for p, (start, end) in enumerate(spans):
                x = ints[:, start:end]
                if before is None:
                    near, low, outer, error = first_state(x, books[p], keep)
                    used = np.full(n, 255)
                else:
                    near, low, outer = (h[:, p].astype(kind) for h, kind in zip(held, (np.int64, np.float64, np.float64)))
                    near, low, outer, error, used = next_state(x, books[p], drifts[p], near, low, outer, keep)
                # Bounds are stored as the next smaller single-precision number.
                made.append((near.astype(np.uint8), _lower(low), _lower(outer), error, used.astype(np.uint8)))
            near, low, outer, error, used = (np.stack(c, axis=1) for c in zip(*made))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("vec_id", "label", "ints")]
                + [_binary(near), _binary(low), _binary(outer), _binary(used), pa.array(error.sum(axis=1).astype(np.int64))],
                names=["vec_id", "label", "ints", "near", "low", "outer", "used", "error"],
            )

    return table.mapInArrow(run, STATE.format(label=table.schema["label"].dataType.simpleString()))


def _lower(x: np.ndarray) -> np.ndarray:
    small = x.astype(np.float32)
    return np.where(small.astype(np.float64) > x, np.nextafter(small, np.float32(-np.inf)), small).astype(np.float32)


def _sums(state: DataFrame, parts: int, entries: int, length: int, kept: int) -> DataFrame:
    """(part, entry, place, total): sums of components by entry; at place -1 the rows; at part -1 how many parts used so many entries."""
    spans = cuts(length, parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((entries, end - start + 1), dtype=np.int64) for start, end in spans]
        needed = np.zeros(256, dtype=np.int64)
        for batch in _blocks(batches):
            n = batch.num_rows
            ints = _ints(batch, length)
            codes = _fixed(batch.column("near"), np.uint8, (n, parts, kept))[:, :, 0]
            needed += np.bincount(_fixed(batch.column("used"), np.uint8, (-1,)), minlength=256)
            for p, (start, end) in enumerate(spans):
                rows = np.concatenate([np.ones((n, 1), dtype=np.int64), ints[:, start:end]], axis=1)
                np.add.at(totals[p], codes[:, p], rows)
        for p, total in enumerate([*totals, needed[:, None]]):
            entry, place = np.nonzero(total)
            part = np.full(len(entry), p if p < parts else -1)
            columns = [part, entry, place - 1, total[entry, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "place", "total"])

    each = state.select("ints", "near", "used").mapInArrow(run, "part long, entry long, place long, total long")
    return each.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"))


def _refined(books: list[np.ndarray], totals) -> list[np.ndarray]:
    """Every used entry becomes the floor of the mean of its parts; unused ones stay."""
    sums = [np.zeros((len(b), b.shape[1] + 1), dtype=np.int64) for b in books]
    for part, entry, place, total in totals:
        if part >= 0:
            sums[part][entry, place + 1] = total
    out = []
    for book, total in zip(books, sums):
        n = total[:, :1]
        mean = np.floor_divide(total[:, 1:], np.maximum(n, 1)).astype(np.float64)
        out.append(np.where(n > 0, mean, book))
    return out


def _fewer(totals, kept: int) -> int:
    """How many entries to keep, from how many the parts needed: all, unless nearly all parts were settled by fewer."""
    needed = np.zeros(256, dtype=np.int64)
    for part, entry, _, total in totals:
        if part < 0:
            needed[entry] = total
    enough = int(np.searchsorted(np.cumsum(needed), SETTLED * needed.sum()))
    return kept if enough >= kept else max(min(kept, LEAST_KEPT), enough + 1)


def encode_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, keep: int = MOST_KEPT,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(codes, codebooks). ``codes`` has vec_id, label, code (two hex digits per part) and error (squared distance), written.

    Rows whose vector is null or holds null, NaN or infinite components are dropped, and so are empty vectors and
    those of another length than the first kept one. Codebooks start as the parts of the ``entries`` (at most 256)
    smallest ids, equal ids by their components, a null id last. Parts are as equal as the length allows, in order.
    Repeated rows count as often as they occur and get equal codes; null labels stay; an empty table gives no row and
    empty codebooks. Components beyond what doubles square exactly raise an error. Other columns are not read.
    """
    if not 1 <= entries <= 256 or keep < 1:
        raise ValueError("between 1 and 256 entries, and one kept entry at least")
    spark = vectors.sparkSession
    books: list[np.ndarray] = []

    def make() -> DataFrame:
        nonlocal books
        table = kept_vectors(vectors, id_col, vector_col, label_col).filter(F.size("ints") > 0)
        smallest = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
        head = table.orderBy(*smallest).first()
        if head is None:
            return table.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        length = len(head["ints"])
        table = table.filter(F.size("ints") == length)
        start = np.array([r["ints"] for r in table.orderBy(*smallest).limit(entries).select("ints").collect()])
        start = checked(start)
        books = [start[:, a:b] for a, b in cuts(length, parts)]
        kept = wanted = min(keep, len(start))
        state, before, last = table, None, None
        for turn in range(rounds + 1):
            path = new_path(spark, "vector-state")
            after = _assign(state, books, before, kept, wanted)
            after.write.parquet(path)
            if last:
                discard(spark, last)
            state, last, kept, before = spark.read.schema(after.schema).parquet(path), path, wanted, books
            if turn < rounds:
                totals = _sums(state, parts, len(start), length, kept).collect()
                books = _refined(books, totals)
                wanted = _fewer(totals, kept)
        hexes = [F.substring(F.hex("near"), 1 + 2 * p * kept, 2) for p in range(parts)]
        return state.select("vec_id", "label", F.lower(F.concat(*hexes)).alias("code"), "error")

    return settled(spark, make, "vector-codes"), books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all components of all entries by part, entry and place, as decimal integers joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for b in books for v in b.reshape(-1)).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the sum of errors over equal labels (null labels are equal); a frequent label is spread."""
    totals = materialise(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    return balanced_join(codes, totals, ["label"], "left", ["vec_id", "code"], limit=SMALL_ROWS, nulls_match=True)


ship_by_value(__name__)
