"""Toxicity scores by class-conditional Kneser-Ney models.

Two models of the bytes of words, one of toxic and one of ordinary documents, give every word two log-likelihoods:
each byte's probability after the four bytes before it in its word (A-Z in lower case). Both models discount their own
counts and back off to one set of shared lower-order continuation counts, so an expression that is rare in both
classes is judged by the part of it that is not. A document is described by length-normalised differences of
log-likelihoods: the mean over its bytes, and the mean per byte of its most toxic words. A logistic regression,
fitted on labelled documents that the counts have not seen, turns these into a score.

Training counts every labelled training document in Spark. The model is a written table of every gram and context by
its exact code, and grows with the corpus. A table that was counted and found below ``SMALL_GRAMS`` rows is sent to the
executors; a larger one is joined with the distinct words of the texts, by gram, and never goes through the driver.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, SPACE, in_chunks, per_process, plain, rows_of, ship_by_value, small_batches
from tremor.operators.digests import narrowed_join
from tremor.operators.skew import balanced_join, is_small
from tremor.workspace import materialise

ORDER = 5  # bytes of a gram; its context is all but the last
DISCOUNT = 0.75
# Rows of a model that is sent to the executors; a larger one is joined.
SMALL_GRAMS = 2_000_000
# Words of fewer bytes are their own names in joins.
NAME_BYTES = 32
GOLDEN = 0x9E3779B97F4A7C15
# The most toxic words that the second feature averages.
TOP_WORDS = 3
PIECE = 1 << 18  # bytes that are handled at a time


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def slot_of(codes: np.ndarray) -> np.ndarray:
    """The model's key of every gram: its code, so that no two grams share one."""
    return codes.astype(np.int64)


def pieces_of(text: str) -> Iterator[bytes]:
    """The text's words, each after and before a space, in pieces that end with a word."""
    held, size = [], 0
    for word in text.encode().lower().split():
        held.append(word)
        size += len(word) + 1
        if size > PIECE:
            yield b" " + b" ".join(held) + b" "
            held, size = [], 0
    if held:
        yield b" " + b" ".join(held) + b" "


def gram_codes(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(code, ends) of every byte but the first: the byte with up to four before it that belong to its word or the
    space before, packed into a number; and whether the byte is the space after a word."""
    a = np.frombuffer(piece, dtype=np.uint8).astype(np.int64)
    space = a == 32
    code, inside = a.copy(), np.ones(len(a), dtype=bool)
    for k in range(1, ORDER):
        # Byte i - k counts if no byte strictly between it and byte i is a space.
        if k > 1:
            inside[k - 1:] &= ~space[:len(a) - k + 1]
            inside[:k - 1] = False
        code[k:] += np.where(inside[k:], a[:-k] << (8 * k), 0)
    return code[1:], space[1:]


def count_grams(labelled: DataFrame) -> DataFrame:
    """(code, toxic_n, ordinary_n) of all grams of ``labelled`` (text, toxic)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {0: [], 1: []}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for label, parts in held.items():
                if parts:
                    codes, n = np.unique(np.concatenate(parts), return_counts=True)
                    zero = np.zeros(len(n), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(codes), pa.array(n if label else zero), pa.array(zero if label else n)],
                        names=["code", "toxic_n", "ordinary_n"],
                    )
                    held[label] = []

        for text, toxic in rows_of(batches, "text", "toxic"):
            for piece in pieces_of(text):
                codes = gram_codes(piece)[0]
                held[toxic].append(codes)
                size += len(codes)
                if size > 1_000_000:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = labelled.mapInArrow(run, "code long, toxic_n long, ordinary_n long")
    return counted.groupBy("code").agg(F.sum("toxic_n").alias("toxic_n"), F.sum("ordinary_n").alias("ordinary_n"))


def log_ratios(grams: DataFrame) -> DataFrame:
    """(slot, ratio, kind): log P(toxic) - log P(ordinary) of every gram (kind 0), and of the backoff weight of every
    context (kind 1); see :func:`slot_of`."""
    d = DISCOUNT
    low = grams.select("code", "toxic_n", "ordinary_n", F.shiftright("code", 8).alias("context"), F.col("code").bitwiseAND((1 << (8 * (ORDER - 1))) - 1).alias("lower"))
    # Shared lower order: in how many contexts a shorter gram was seen, interpolated with that of single bytes.
    shared = low.groupBy("lower").agg(F.count(F.lit(1)).alias("cont"))
    shared = shared.select("lower", "cont", F.shiftright("lower", 8).alias("lower_context"), F.col("lower").bitwiseAND(255).alias("byte"))
    by_context = shared.groupBy("lower_context").agg(F.sum("cont").alias("total"), F.count(F.lit(1)).alias("kinds"))
    bytes_ = shared.groupBy("byte").agg(F.sum("cont").alias("byte_n"))  # at most 256 rows
    bytes_ = bytes_.withColumn("byte_p", F.col("byte_n") / F.sum("byte_n").over(Window.partitionBy(F.lit(0))))
    lower_p = shared.join(by_context, "lower_context").join(F.broadcast(bytes_), "byte").select(
        "lower", ((F.col("cont") - d + d * F.col("kinds") * F.col("byte_p")) / F.col("total")).alias("shared_p")
    )
    contexts = low.groupBy("context").agg(
        F.sum("toxic_n").alias("toxic_all"), F.sum("ordinary_n").alias("ordinary_all"),
        F.count_if(F.col("toxic_n") > 0).alias("toxic_kinds"), F.count_if(F.col("ordinary_n") > 0).alias("ordinary_kinds"),
    )

    def weight(name: str) -> Column:
        return F.when(F.col(f"{name}_all") > 0, d * F.col(f"{name}_kinds") / F.col(f"{name}_all")).otherwise(1.0)

    def chance(name: str) -> Column:
        own = F.when(F.col(f"{name}_all") > 0, F.greatest(F.col(f"{name}_n") - d, F.lit(0.0)) / F.col(f"{name}_all")).otherwise(0.0)
        return own + weight(name) * F.col("shared_p")

    seen = low.join(lower_p, "lower").join(contexts, "context").select(
        F.col("code").alias("slot"), F.lit(0).alias("kind"), (F.log(chance("toxic")) - F.log(chance("ordinary"))).alias("ratio")
    )
    backoff = contexts.select(
        F.col("context").alias("slot"), F.lit(1).alias("kind"), (F.log(weight("toxic")) - F.log(weight("ordinary"))).alias("ratio")
    )
    return seen.unionByName(backoff)


class Lookup:
    """Values by exact key, in a table with linear probing; keys are distinct and not negative."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (2 * len(keys)).bit_length())
        home = self.home(keys)
        order = np.argsort(home, kind="stable")
        step = np.arange(len(keys))
        place = step + np.maximum.accumulate(home[order] - step)
        size = max(1 << self.bits, int(place[-1]) + 1 if len(keys) else 0) + 1  # the last place stays empty
        self.keys, self.values = np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.float32)
        self.keys[place], self.values[place] = keys[order], values[order]

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(GOLDEN)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value, known) of every key; 0 for unknown ones."""
        place = self.home(keys)
        found = self.keys[place]
        on = np.flatnonzero((found != keys) & (found >= 0))
        while len(on):
            place[on] += 1
            found[on] = self.keys[place[on]]
            on = on[(found[on] != keys[on]) & (found[on] >= 0)]
        known = found == keys
        return np.where(known, self.values[place].astype(np.float64), 0.0), known


def word_features(text: str, ratios: Lookup, weights: Lookup) -> tuple[float, float]:
    """(mean difference per byte, mean of the highest per-byte differences of a word) of a text; 0 without words."""
    total, size, best = 0.0, 0, []
    for piece in pieces_of(text):
        codes, ends = gram_codes(piece)
        value, known = ratios(slot_of(codes))
        unseen = np.flatnonzero(~known)
        if len(unseen):
            value[unseen] = weights(slot_of(codes[unseen] >> 8))[0]
        stops = np.flatnonzero(ends)
        sums = np.diff(np.concatenate([[0.0], np.cumsum(value)[stops]]))
        per_byte = sums / np.diff(np.concatenate([[-1], stops]))
        best.append(np.partition(per_byte, max(0, len(per_byte) - TOP_WORDS))[-TOP_WORDS:])
        total, size = total + float(sums.sum()), size + len(codes)
    if not size:
        return 0.0, 0.0
    return total / size, float(np.sort(np.concatenate(best))[-TOP_WORDS:].mean())


class Model:
    """Differences of the two Kneser-Ney models, a written table of (slot, kind, ratio), and the weights of the score."""

    def __init__(self, ratios: DataFrame, limit: int = SMALL_GRAMS):
        self.table = materialise(ratios.withColumn("ratio", F.col("ratio").cast("float")), "toxic-model")
        self.small = is_small(self.table, limit)
        self.logistic: np.ndarray | None = None  # for (mean, top, 1)
        if self.small:
            table = self.table.toArrow()  # at most ``limit`` rows
            slot, kind, ratio = (table.column(c).to_numpy() for c in ("slot", "kind", "ratio"))
            order = np.lexsort((slot, kind))
            slot, kind, ratio = slot[order], kind[order], ratio[order]
            self.grams, self.ratios = slot[kind == 0], ratio[kind == 0]
            self.contexts, self.weights = slot[kind == 1], ratio[kind == 1]

    def send(self, spark):
        """A small model on every executor."""
        return spark.sparkContext.broadcast((uuid.uuid4().hex, self.grams, self.ratios, self.contexts, self.weights, self.logistic))


def tables_of(sent: tuple) -> tuple[Lookup, Lookup]:
    """Ratios and backoff weights from what :meth:`Model.send` sends. A worker keeps those of one model."""
    held = per_process("toxicity tables", dict)
    if held.get("model") != sent[0]:
        held.clear()
        _, grams, ratios, contexts, weights, _ = sent
        held |= {"model": sent[0], "ratios": Lookup(grams, ratios), "weights": Lookup(contexts, weights)}
    return held["ratios"], held["weights"]


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def joined_features(texts: DataFrame, model: Model) -> DataFrame:
    """(key, mean, top) of every distinct text that has words, see :func:`word_features`; ``texts`` has text.

    Every distinct word is looked up once: its distinct grams are joined with the model, then the words with the texts.
    """

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for key, text in rows_of(batches, "key", "text"):
                for word, n in Counter(text.encode().lower().split()).items():
                    yield key, word, n

        yield from in_chunks(made(), lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), [pa.binary(), pa.binary(), pa.int64()])], names=["key", "word", "n"]), 10_000)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, word in rows_of(batches, "name", "word"):
            codes, n = np.unique(gram_codes(b" " + word + b" ")[0], return_counts=True)
            columns = [pa.array([name] * len(n), pa.binary()), pa.array(slot_of(codes)), pa.array(slot_of(codes >> 8)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, names=["name", "slot", "context", "n"])

    each = texts.select(text_key(F.col("text")).alias("key"), "text").mapInArrow(words, "key binary, word binary, n long")
    # A text that repeats gives its words again.
    each = each.groupBy("key", "word").agg(F.max("n").alias("n"))
    name = F.when(F.length("word") < NAME_BYTES, F.col("word")).otherwise(F.unhex(F.sha2("word", 256)))
    each = materialise(each.withColumn("name", name), "toxic-words")
    parts = each.select("name", "word").distinct().mapInArrow(grams, "name binary, slot long, context long, n long")
    parts = materialise(parts, "toxic-word-grams")
    known = model.table.filter("kind = 0").select("slot", "ratio")
    backoff = model.table.filter("kind = 1").select(F.col("slot").alias("context"), F.col("ratio").alias("weight"))
    valued = materialise(balanced_join(parts, known, ["slot"], "left", ["name"], limit=SMALL_ROWS), "toxic-known-grams")
    valued = balanced_join(valued, backoff, ["context"], "left", ["name", "slot"], limit=SMALL_ROWS)
    value = F.coalesce("ratio", "weight", F.lit(0.0)).cast("double")
    by_word = valued.groupBy("name").agg(F.sum(F.col("n") * value).alias("total"), F.sum("n").alias("size"))
    by_word = materialise(by_word, "toxic-word-values")
    placed = balanced_join(each.select("key", "name", "n"), by_word, ["name"], "inner", ["key"], limit=SMALL_ROWS)
    copies = F.array_repeat(F.col("total") / F.col("size"), F.least("n", F.lit(TOP_WORDS)).cast("int"))
    summed = placed.groupBy("key").agg(
        (F.sum(F.col("n") * F.col("total")) / F.sum(F.col("n") * F.col("size"))).alias("mean"),
        F.slice(F.sort_array(F.flatten(F.collect_list(copies)), asc=False), 1, TOP_WORDS).alias("best"),
    )
    top = F.aggregate("best", F.lit(0.0), lambda a, x: a + x) / F.size("best")
    return materialise(summed.select("key", "mean", top.alias("top")), "toxic-text-features")


def score_of(mean: float, top: float, logistic: np.ndarray | None) -> float:
    if logistic is None:
        return 0.5
    z = float(logistic @ np.array([mean, top, 1.0]))
    return float(1 / (1 + np.exp(-min(max(z, -35.0), 35.0))))


def score_column(mean: Column, top: Column, logistic: np.ndarray | None) -> Column:
    """:func:`score_of` as an expression."""
    if logistic is None:
        return F.lit(0.5)
    z = mean * F.lit(float(logistic[0])) + top * F.lit(float(logistic[1])) + F.lit(float(logistic[2]))
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))


def features(docs: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, mean, top, score, ...); a small model is sent to each executor once."""
    if not model.small:
        keyed = docs.select("doc_id", *extra, text_key(F.col("text")).alias("key"))
        found = balanced_join(keyed, joined_features(docs, model), ["key"], "left", ["doc_id"], limit=SMALL_ROWS)
        mean, top = (F.coalesce(c, F.lit(0.0)) for c in ("mean", "top"))
        return found.select("doc_id", mean.alias("mean"), top.alias("top"), score_column(mean, top, model.logistic).alias("score"), *extra)
    held = model.send(docs.sparkSession)
    names = ["doc_id", "mean", "top", "score", *extra]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, logistic = tables_of(held.value), held.value[-1]

        def made():
            for doc_id, text, *rest in rows_of(batches, "doc_id", "text", *extra):
                mean, top = word_features(text, *tables)
                yield doc_id, mean, top, score_of(mean, top, logistic), *rest

        kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64(), *[pa.int64()] * len(extra)]
        yield from in_chunks(made(), lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names))

    schema = "doc_id long, mean double, top double, score double" + "".join(f", {c} long" for c in extra)
    return docs.select("doc_id", "text", *extra).mapInArrow(run, schema)


def fit_logistic(table: DataFrame, steps: int = 25, ridge: float = 1e-2) -> np.ndarray:
    """Weights for (mean, top, 1) by Newton steps; every step is one sum over ``table`` (mean, top, toxic)."""
    spread = table.agg(*[f(c) for c in ("mean", "top") for f in (F.avg, F.stddev_pop)]).first()
    if spread[0] is None:
        return np.array([0.0, 0.0, 0.0])
    center, scale = np.array([spread[0], spread[2], 0.0]), np.array([spread[1] or 1.0, spread[3] or 1.0, 1.0])
    x = [(F.col(c) - F.lit(float(center[i]))) / F.lit(float(scale[i])) for i, c in enumerate(("mean", "top"))] + [F.lit(1.0)]
    w = np.zeros(3)
    for _ in range(steps):
        z = sum(xi * F.lit(float(wi)) for xi, wi in zip(x, w))
        p = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(35.0)), F.lit(-35.0))))
        pairs = [(i, j) for i in range(3) for j in range(i, 3)]
        row = table.agg(*[F.sum(x[i] * (p - F.col("toxic"))) for i in range(3)], *[F.sum(x[i] * x[j] * p * (1 - p)) for i, j in pairs]).first()
        gradient, hessian = np.array(row[:3]) + ridge * w, np.eye(3) * ridge
        for (i, j), v in zip(pairs, row[3:]):
            hessian[i, j] += v
            if i != j:
                hessian[j, i] += v
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    slope = w / scale
    return np.array([slope[0], slope[1], w[2] - slope[0] * center[0] - slope[1] * center[1]])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    limit: int = SMALL_GRAMS,
) -> Model:
    """Fit on all labelled documents of folds 1 to 4 (:func:`fold_of`): the counts on 1 to 3, the score on 4.

    Labels without a value are left out; a doc_id labelled toxic by any row is toxic. Without labelled documents
    every score is 0.5. A model of more than ``limit`` rows is joined instead of sent.
    """
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col)).cast("bigint").alias("toxic"))
    known = materialise(known.withColumn("fold", fold_of(F.col("_id"))).filter("fold <> 0"), "toxic-labels")
    texts = plain(docs, id_col, text_col)
    # Texts are not moved as long as the labels are few; beyond that both sides are dealt by id.
    right = F.broadcast(known) if is_small(known, SMALL_ROWS) else known
    labelled = texts.join(right, F.col("doc_id") == F.col("_id")).drop("_id")
    labelled = materialise(labelled, "toxic-training")
    with small_batches(docs.sparkSession):
        grams = materialise(count_grams(labelled.filter("fold < 4").select("text", "toxic")), "toxic-grams")
    model = Model(log_ratios(grams), limit)
    with small_batches(docs.sparkSession):
        checked = materialise(features(labelled.filter("fold = 4"), model, ("toxic",)), "toxic-features")
    model.logistic = fit_logistic(checked)
    return model


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher is more toxic), predicted (1 if score >= 0.5).

    Null and empty texts have no words and get the score of differences of 0. A null doc_id is in the fold of the
    empty string. Rows that repeat give equal rows; an empty table gives none; other columns are not read.
    """
    scored = features(plain(docs, id_col, text_col), model)
    return scored.select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, with all their columns.

    Only the keys of the other texts come back from Python, and are written.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    if not model.small:
        scored = joined_features(docs.select(text.alias("text")), model)
        none = score_column(F.lit(0.0), F.lit(0.0), model.logistic)
        toxic = scored.filter(score_column(F.col("mean"), F.col("top"), model.logistic) >= 0.5).select(F.col("key").alias("_key"))
        without = docs.sparkSession.range(1).filter(none >= 0.5).select(F.lit(None).cast("binary").alias("_key"))
        toxic = materialise(toxic.unionByName(without), "toxic-texts")
        # Texts without words have the key null.
        key = F.when(text.rlike(f"[^{SPACE}]"), text_key(text))
        marked = docs.select(F.struct(*docs.columns).alias("_doc"), key.alias("_key"), F.monotonically_increasing_id().alias("_row"))
        return balanced_join(marked, toxic, ["_key"], "left_anti", ["_row"], limit=SMALL_ROWS, nulls_match=True).select("_doc.*")
    held = model.send(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, logistic = tables_of(held.value), held.value[-1]
        toxic = ((key,) for text, key in rows_of(batches, "text", "_key") if not score_of(*word_features(text, *tables), logistic) < 0.5)
        yield from in_chunks(toxic, lambda rows: pa.RecordBatch.from_arrays([pa.array([k for k, in rows], pa.binary())], names=["_key"]))

    keyed = docs.select(text.alias("text"), text_key(text).alias("_key"))
    with small_batches(docs.sparkSession):
        toxic = materialise(keyed.mapInArrow(run, "_key binary").distinct(), "toxic-texts")
    marked = docs.select(F.struct(*docs.columns).alias("_doc"), text_key(text).alias("_key"), F.monotonically_increasing_id().alias("_row"))
    return narrowed_join(marked, toxic, ["_key"], "left_anti", ["_row"], limit=SMALL_ROWS).select("_doc.*")


ship_by_value(__name__)
