"""Mixing of sources to target weights by entropy balancing.

Targets: the sources, by code point with null last, take the weights in turn; each source's target is its share
of ``ratio`` times all words, at most ``cap`` times its own, the excess going to the others by weight.

Rates: every document gets a rate between 0 and ``cap`` = 2, as far as possible in entropy terms from choosing at all:
the base measure is two fair draws per document, and the solution under one token constraint per source is the
exponential tilt ``2 / (1 + exp(-t * size))``. The dual is convex and has one variable per source; Newton steps,
kept inside a bracket, find it. Each step is one distributed sum over (source, size) counts.

Copies: within a source, slabs of documents ordered by size are rounded by carrying the running sum of the rates,
so a slab misses its expected words by less than its largest document. Then a few single documents per
source, those that fit the rest best, are taken once more or once less.

Scale: a hot source is spread over slabs of a bounded number of documents, and the sums are pre-aggregated. The
driver sees single numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremor.llm.base import SMALL_ROWS, SPACE
from tremor.operators.ranking import row_numbers
from tremor.operators.skew import balanced_join, is_small
from tremor.workspace import materialise

WEIGHTS = (3.0, 1.0, 2.0)
RATIO = 1.5
CAP = 2
SLAB_DOCUMENTS = 10_000
STEPS = 40
# Rates are rounded to multiples of 1 / UNIT, so that running sums are exact.
UNIT = 1 << 30
# The words a source may miss by its rates, as a part of its target.
TOLERANCE = 1e-5
# Single documents moved per source after the rounding.
MOVES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights=WEIGHTS, ratio: float = RATIO, cap: float = CAP) -> DataFrame:
    """(source, source_size, n, target, ...) from (source, source_size, n): shares by weight, filled up to the caps."""
    ranked = row_numbers(sources.withColumn("_last", F.col("source").isNull()), [], ["_last", "source"], "_rank")
    turn = F.array(*[F.lit(float(w)) for w in weights])[((F.col("_rank") - 1) % len(weights)).cast("int")]
    weighed = materialise(
        ranked.select(*sources.columns, turn.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("_cap")),
        "mix-sources",
    )
    total = float(weighed.agg(F.sum("source_size")).first()[0] or 0) * ratio
    level, full = 0.0, -1
    while True:
        held = F.col("_cap") <= F.col("weight") * F.lit(level)
        row = weighed.agg(
            F.count_if(held), F.sum(F.when(held, F.col("_cap")).otherwise(0.0)), F.sum(F.when(held, 0.0).otherwise(F.col("weight")))
        ).first()
        if row[0] == full or not row[2]:
            break
        full, level = row[0], max(0.0, total - row[1]) / row[2]
    target = F.least("_cap", F.col("weight") * F.lit(level)) if row[2] else F.col("_cap")
    return weighed.withColumn("target", target).drop("_cap", "weight")


def _rate(tilt: Column, size: Column, mean: Column) -> Column:
    return F.lit(float(CAP)) / (F.exp(F.least(F.greatest(-tilt * size / mean, F.lit(-700.0)), F.lit(700.0))) + 1)


def _beside(left: DataFrame, right: DataFrame, small: bool) -> DataFrame:
    """``left`` with the row of its source from ``right``; every source has one."""
    named = right.withColumnRenamed("source", "_source")
    return left.join(F.broadcast(named) if small else named, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def tilts(cells: DataFrame, targets: DataFrame, small: bool, steps: int = STEPS) -> DataFrame:
    """``targets`` with the tilt of every source: (source, ..., mean, tilt), by Newton steps on the dual.

    ``cells`` counts documents: (source, size, n). A source whose target is all it can give, or nothing, needs no
    tilt; its rates are ``CAP``, or 0.
    """
    squares = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("size") * F.col("n")).alias("_sq"))
    size = F.col("source_size")
    open_ = (F.col("target") > 0) & (F.col("target") < size * CAP * (1 - 1e-12))
    mean = F.greatest(size / F.col("n"), F.lit(1e-9))
    state = materialise(
        _beside(targets, squares, False).select(
            *targets.columns, mean.alias("mean"), open_.alias("open"), F.lit(-1e4).alias("low"), F.lit(1e4).alias("high"),
            # The first step from a tilt of 0, where the rates are 1 and their slope is half the size.
            F.when(open_, F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col("target") - size) * 2 * mean / F.col("_sq")))).alias("tilt"),
            open_.alias("going"),
        ),
        "mix-tilts",
    )
    for _ in range(steps):
        if not state.agg(F.count_if("going")).first()[0]:
            break
        active = _beside(cells, state.select("source", "tilt", "mean", "open"), small).filter("open")
        rate = _rate(F.col("tilt"), F.col("size"), F.col("mean"))
        sums = active.groupBy("source").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("_got"),
            F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("mean") * rate * (CAP - rate) / CAP).alias("_slope"),
        )
        miss = F.col("_got") - F.col("target")
        done = F.abs(miss) <= F.greatest(F.col("target") * TOLERANCE, F.lit(0.01))
        low = F.when(miss < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - miss / F.greatest("_slope", F.lit(1e-300))
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        state = materialise(
            _beside(state, sums, False).select(
                *targets.columns, "mean", "open", low.alias("low"), high.alias("high"),
                F.when(F.col("open"), F.when(done, F.col("tilt")).otherwise(step)).alias("tilt"),
                (F.col("open") & ~done).alias("going"),
            ),
            "mix-tilts",
        )
    # Sums over differently ordered tasks differ in their last digits; reruns must not.
    return state.select(*targets.columns, "mean", F.round("tilt", 6).alias("tilt"))


def _moves(rounded: DataFrame, targets: DataFrame, small: bool, rounds: int) -> DataFrame:
    """Units to take once more or once less: (source, doc_id, size, hash, delta)."""
    cells = materialise(
        rounded.filter("size > 0").groupBy("source", "size", "copies", "m")
        .agg(F.min(F.struct("hash", "doc_id")).alias("first"), F.count(F.lit(1)).alias("units")),
        "mix-cells",
    )
    taken = cells.groupBy("source").agg(F.sum(F.col("copies") * F.col("size") * F.col("m") * F.col("units")).alias("_taken"))
    picked = "array<struct<size:bigint,copies:bigint,m:bigint,hash:bigint,doc_id:bigint,delta:int>>"
    state = materialise(
        _beside(targets, taken, False).select(
            "source", (F.col("target") - F.coalesce("_taken", F.lit(0))).alias("rest"), F.array().cast(picked).alias("picks")
        ),
        "mix-rest",
    )
    for _ in range(rounds):
        weight = F.col("size") * F.col("m")
        delta = F.when(F.col("rest") > 0, 1).otherwise(-1)
        fit = F.abs(F.col("rest") - delta * weight)
        used = F.exists("picks", lambda p: (p["size"] == F.col("size")) & (p["copies"] == F.col("copies")) & (p["m"] == F.col("m")))
        can = (F.col("copies") + delta).between(0, CAP) & (fit < F.abs("rest")) & ~used
        best = _beside(cells, state, small).filter(can).groupBy("source").agg(
            F.min(F.struct(fit.alias("fit"), "size", "copies", "m", "first", delta.alias("delta"))).alias("b")
        )
        b = F.col("b")
        pick = F.struct(b["size"].alias("size"), b["copies"].alias("copies"), b["m"].alias("m"), b["first"]["hash"].alias("hash"),
                        b["first"]["doc_id"].alias("doc_id"), b["delta"].alias("delta"))
        state = materialise(
            _beside(state, best, False).select(
                "source", F.when(b.isNull(), F.col("rest")).otherwise(F.col("rest") - b["delta"] * b["size"] * b["m"]).alias("rest"),
                F.when(b.isNull(), F.col("picks")).otherwise(F.concat("picks", F.array(pick))).cast(picked).alias("picks"),
            ),
            "mix-rest",
        )
    return state.select("source", F.explode("picks").alias("p")).select("source", "p.doc_id", "p.size", "p.hash", "p.delta")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    ratio: float = RATIO,
    slab_documents: int = SLAB_DOCUMENTS,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's), taken, copies, source, hash.

    A size is the number of words, 0 for a null text; no document is taken more than twice. Null sources are one
    source; null doc_ids are allowed. Rows that repeat doc_id, source and text get the same number of copies. A
    source without words has target 0. An empty table gives an empty result; other columns are not read. Reruns
    agree: ties are ordered by hash and doc_id.
    """
    keys = ["doc_id", "source", "size", "hash"]
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )
    units = materialise(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("m")), "mix-units")
    cells = materialise(units.groupBy("source", "size").agg(F.sum("m").alias("n")), "mix-counts")
    sources = materialise(
        cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n")), "mix-sums"
    )
    small = is_small(sources, SMALL_ROWS)
    targets = materialise(tilts(cells, source_targets(sources, weights, ratio), small), "mix-tilted")
    # Units of a hot source are many; beyond the size check they are spread over its slabs by the balanced join.
    with_source = balanced_join(units, targets, ["source"], "inner", ["doc_id", "hash"], small=small, nulls_match=True)

    slabs = F.ceil(F.col("n") / slab_documents)
    rate = (
        F.when(F.col("target") <= 0, F.lit(0.0)).when(F.col("tilt").isNull(), F.lit(float(CAP)))
        .otherwise(_rate(F.col("tilt"), F.col("size"), F.col("mean")))
    )
    placed = with_source.select(
        *keys, "m", "source_size", "target", F.pmod(F.xxhash64("hash", "doc_id"), slabs).alias("slab"),
        F.round(rate * UNIT).cast("bigint").alias("rate"),
    )
    order = Window.partitionBy("source", "slab").orderBy("size", "hash", "doc_id")
    upto = F.sum("rate").over(order.rowsBetween(Window.unboundedPreceding, 0))
    whole = lambda total: F.floor((total + UNIT // 2) / F.lit(UNIT))
    rounded = materialise(
        placed.withColumn("upto", upto).select(
            *keys, "m", "source_size", "target", (whole(F.col("upto")) - whole(F.col("upto") - F.col("rate"))).alias("copies")
        ),
        "mix-rounded",
    )
    moves = materialise(_moves(rounded, targets, small, MOVES), "mix-moves")
    final = balanced_join(rounded, moves, keys, "left", limit=SMALL_ROWS, nulls_match=True)
    copies = (F.col("copies") + F.coalesce("delta", F.lit(0))).cast("int")
    return final.select("*", F.explode(F.array_repeat(F.lit(0), F.col("m").cast("int")))).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source", "hash"
    )


def repeat_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    chosen = materialise(
        mixed.filter("copies > 0").select("doc_id", "source", "hash", "copies").distinct(), "mix-chosen"
    )
    keyed = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.xxhash64(F.col(text_col)).alias("hash"),
    )
    joined = balanced_join(keyed, chosen, ["doc_id", "source", "hash"], "inner", limit=SMALL_ROWS, nulls_match=True)
    return joined.select("_doc", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_doc.*")
