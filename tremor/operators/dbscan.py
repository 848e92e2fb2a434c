"""Exact density clustering by great-circle distance.

The work is organised around cubes small enough that all points of one cube are
neighbours of each other. A cube with at least ``min_samples`` points is *dense*:
all its points are core points of one cluster and need no pairwise work, however
many there are. Only points of sparse cubes (fewer than ``min_samples`` each) are
compared one by one. Two dense cubes are linked when some pair of their points is
near enough; that is decided from bounding boxes and sample points of ever finer
blocks, never from all pairs.

Beyond one aggregation over the events and one join to hand out labels, every
table here is bounded by the number of occupied cubes, which the globe's surface
bounds in turn.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.constants import DBSCAN_EPS, DBSCAN_MIN_SAMPLES
from tremor.operators.components import connected_components
from tremor.operators.ranking import row_numbers
from tremor.operators.skew import balanced_join
from tremor.operators.spherical import (
    AXES, SMALLEST_EPS, block_key, box_aggregates, box_gap_squared, box_reach_squared, cell_key, cell_side, chord,
    is_within, place_on_sphere, with_neighbour_cells,
)
from tremor.workspace import materialise

BOX = [f"{p}{d}" for d in "xyz" for p in ("lo_", "hi_")]
PAIR = ["a_cell", "b_cell"]
BLOCK_COLUMNS = ["block", "n", "sample", "single", *BOX]
# A cube is cut into this many parts per axis at each refinement.
CUTS = 4
# Block keys stay within 63 bits up to this level; blocks are then a millionth of a cube wide.
LAST_LEVEL = 10
# Two blocks are compared point by point only below this many pairs.
PAIR_BUDGET = 1024
# A block with at most so many points is compared with a loose point one by one.
CONTACT_POINTS = 64
# Slack on box bounds, so that rounding can never drop a true pair.
SLACK = 1e-9


@dataclass(frozen=True)
class Parameters:
    eps: float
    min_samples: int
    pair_budget: int = PAIR_BUDGET
    broadcast_rows: int | None = None
    rows_per_split: int | None = None

    @property
    def side(self) -> float:
        return cell_side(self.eps)

    @property
    def far(self) -> float:
        """Squared chord above which two points are certainly apart."""
        return chord(self.eps) ** 2 * (1 + SLACK) + 1e-18

    @property
    def near(self) -> float:
        """Squared chord below which two points are certainly within reach."""
        return chord(self.eps) ** 2 * (1 - SLACK) - 1e-18

    def block(self, level: int):
        return block_key(F.col("cell"), self.side, CUTS**level)

    def within(self, phi1: str, lam1: str, phi2: str, lam2: str):
        return is_within(self.eps, F.col(phi1), F.col(lam1), F.col(phi2), F.col(lam2))

    def join(self, left, right, keys, how="inner", spread=None):
        return balanced_join(left, right, keys, how, spread, self.broadcast_rows, self.rows_per_split)


def _marked(df: DataFrame, prefix: str, columns: list[str] | None = None) -> DataFrame:
    """Selected columns under a prefix."""
    return df.select(*[F.col(c).alias(prefix + c) for c in columns or df.columns])


def _sample() -> list:
    """Any one location of a group, and whether it is the only one.

    The choice does not matter for the result: a sample only ever confirms a link
    that exists. Plain numbers keep the aggregation hash-based.
    """
    only = (F.min("phi") == F.max("phi")) & (F.min("lam") == F.max("lam"))
    return [F.struct(F.first("phi").alias("phi"), F.first("lam").alias("lam")).alias("sample"), only.alias("single")]


def _scrambled(cell: str):
    """A one-to-one mix of a cube's key by xor and shift.

    Neighbouring cubes have keys in order, which would make long chains of
    pointers in the component search; mixed keys keep the chains short.
    """
    x = F.col(cell)
    for left, right, last in ((13, 7, 17), (21, 35, 4)):
        x = x.bitwiseXOR(F.shiftleft(x, left))
        x = x.bitwiseXOR(F.shiftrightunsigned(x, right))
        x = x.bitwiseXOR(F.shiftleft(x, last))
    return x


def _both_cells(pairs: DataFrame, *extra: str) -> DataFrame:
    """The distinct (cell, extra) of both sides of a table of pairs."""
    sides = [pairs.select(*[F.col(f"{s}_{c}").alias(c) for c in ("cell", *extra)]) for s in "ab"]
    return sides[0].unionByName(sides[1]).distinct()


def _meeting(pairs: DataFrame, left: DataFrame, right: DataFrame, p: Parameters) -> DataFrame:
    """Points of the cubes (a, b) that are within reach; columns get the prefixes a_ and b_.

    Used for points of sparse cubes only, so a pair of cubes yields few pairs of points.
    """
    return (
        pairs.join(_marked(left, "a_"), "a_cell").join(_marked(right, "b_"), "b_cell")
        .filter(p.within("a_phi", "a_lam", "b_phi", "b_lam"))
    )


def _dense_links(points: DataFrame, blocks: DataFrame, pairs: DataFrame, p: Parameters) -> DataFrame:
    """The pairs of dense cubes that have a pair of points within reach.

    Per round and block pair: a sample pair within reach settles the cube pair;
    boxes too far apart, or two single locations out of reach, settle the block
    pair; what is left is compared point by point if small, else cut finer.
    """
    block_pairs = (
        pairs.join(_marked(blocks, "a_", ["cell", *BLOCK_COLUMNS]), "a_cell")
        .join(_marked(blocks, "b_", ["cell", *BLOCK_COLUMNS]), "b_cell")
    )
    found, spots = None, None
    for level in range(1, LAST_LEVEL + 1):
        tested = materialise(
            block_pairs.filter(box_gap_squared("a_", "b_") <= p.far)
            .withColumn("hit", p.within("a_sample.phi", "a_sample.lam", "b_sample.phi", "b_sample.lam"))
            .filter("hit or not (a_single and b_single)")
            .select(*PAIR, "a_block", "b_block", "a_n", "b_n", "a_single", "b_single", "hit"),
            "block-pairs",
        )
        linked = tested.filter("hit").select(*PAIR).distinct()
        found = linked if found is None else found.unionByName(linked)
        points_a, points_b = F.expr("if(a_single, 1, a_n)"), F.expr("if(b_single, 1, b_n)")
        undecided = materialise(
            tested.filter("not hit").join(linked, PAIR, "left_anti")
            .withColumn("small", (points_a * points_b <= p.pair_budget) | F.lit(level == LAST_LEVEL))
            .select(*PAIR, "a_block", "b_block", "small"),
            "undecided",
        )
        if undecided.isEmpty():
            return found
        if spots is None:
            # Distinct locations of the cubes still in question.
            spots = materialise(
                p.join(points.select("cell", "phi", "lam", *AXES), _both_cells(undecided), ["cell"], "left_semi", ["phi", "lam"])
                .dropDuplicates(["cell", "phi", "lam"]),
                "spots",
            )
        placed = spots.withColumn("block", p.block(level)).select("cell", "block", "phi", "lam")
        small_pairs = undecided.filter("small").drop("small")
        exact = materialise(
            p.join(_marked(placed, "a_"), small_pairs, ["a_cell", "a_block"], "inner", ["a_phi", "a_lam"])
            .join(_marked(placed, "b_"), ["b_cell", "b_block"])
            .filter(p.within("a_phi", "a_lam", "b_phi", "b_lam"))
            .select(*PAIR).distinct(),
            "exact-links",
        )
        found = found.unionByName(exact)
        if undecided.filter("not small").isEmpty():
            return found
        large = materialise(undecided.filter("not small").drop("small").join(exact, PAIR, "left_anti"), "large-pairs")
        if large.isEmpty():
            return found
        block_pairs = _finer(spots, large, level, p)
    raise AssertionError("the last level decides every pair")


def _finer(spots: DataFrame, large: DataFrame, level: int, p: Parameters) -> DataFrame:
    """Cut the blocks of the remaining pairs and pair up the parts."""
    active = materialise(_both_cells(large, "block").withColumnRenamed("block", "parent"), "active-blocks")
    inside = p.join(spots.withColumn("parent", p.block(level)), active, ["cell", "parent"], "left_semi", ["phi", "lam"])
    parts = materialise(
        inside.groupBy("cell", "parent", p.block(level + 1).alias("block")).agg(
            F.count(F.lit(1)).alias("n"), *_sample(), *box_aggregates()
        ),
        "block-parts",
    )
    keyed = large.select(*PAIR, F.col("a_block").alias("a_parent"), F.col("b_block").alias("b_parent"))
    return keyed.join(_marked(parts, "a_"), ["a_cell", "a_parent"]).join(_marked(parts, "b_"), ["b_cell", "b_parent"])


def _as_box(located: DataFrame) -> DataFrame:
    """Points as boxes of no extent, with the prefix ``a_``."""
    return located.withColumns({f"a_{e}_{d}": F.col(f"u{d}") for d in "xyz" for e in ("lo", "hi")})


def _dense_contacts(
    points: DataFrame, loose: DataFrame, cubes: DataFrame, blocks: DataFrame, pairs: DataFrame, p: Parameters
) -> DataFrame:
    """(id, b_cell, near): how many points of a dense cube are within reach of a loose point, counted up to ``min_samples``.

    A dense cube wholly within reach settles its contact and makes the loose point a core point; then a sample within
    reach settles any other contact. Only the rest is looked at block by block.
    A block wholly within reach counts with its size, a single location counts if it is within reach. A block cut
    by the boundary is compared point by point if it holds few points, else cut finer; a pair that has its
    ``min_samples`` points, or a contact where the loose point has them elsewhere, is not looked into further.
    """
    place = ["id", "phi", "lam", *AXES]
    spot = loose.select(F.col("cell").alias("a_cell"), *place)
    cubed = materialise(
        _as_box(pairs.join(spot, "a_cell").join(_marked(cubes, "b_", ["cell", "n", "sample", *BOX]), "b_cell"))
        .filter(box_gap_squared("a_", "b_") <= p.far)
        .select(
            *place, "b_cell", "b_n", (box_reach_squared("a_", "b_") <= p.near).alias("whole"),
            p.within("phi", "lam", "b_sample.phi", "b_sample.lam").alias("hit"),
        ),
        "cube-contacts",
    )
    surely_core = cubed.filter("whole").select("id").distinct().withColumn("core", F.lit(True))
    open_pairs = materialise(
        cubed.filter("not whole").join(surely_core, "id", "left")
        .withColumn("settled", F.col("hit") & F.col("core").isNotNull()).drop("core"),
        "open-contacts",
    )
    near = (
        cubed.filter("whole").select("id", "b_cell", F.col("b_n").alias("near"))
        .unionByName(open_pairs.filter("settled").select("id", "b_cell", F.lit(1).cast("bigint").alias("near")))
    )
    reached = open_pairs.filter("not settled").select(*place, "b_cell").join(
        _marked(blocks, "b_", ["cell", *BLOCK_COLUMNS]), "b_cell"
    )
    for level in range(1, LAST_LEVEL + 1):
        met = (
            _as_box(reached).filter(box_gap_squared("a_", "b_") <= p.far)
            .withColumn("whole", (box_reach_squared("a_", "b_") <= p.near))
            .filter(F.col("whole") | ~F.col("b_single") | p.within("phi", "lam", "b_sample.phi", "b_sample.lam"))
        )
        met = materialise(met.select(*place, "b_cell", "b_block", "b_n", "b_single", "whole"), "contacts")
        sure = met.filter("whole or b_single").select("id", "b_cell", F.col("b_n").alias("near"))
        near = near.unionByName(sure)
        cut = met.filter("not whole and not b_single")
        if cut.isEmpty():
            break
        by_pair = near.groupBy("id", "b_cell").agg(F.sum("near").alias("_pair"))
        by_id = by_pair.groupBy("id").agg(F.sum("_pair").alias("_all"))
        enough = (F.col("_pair") >= p.min_samples) | ((F.col("_pair") > 0) & (F.col("_all") >= p.min_samples))
        settled = by_pair.join(by_id, "id").filter(enough).select("id", "b_cell")
        cut = materialise(cut.join(settled, ["id", "b_cell"], "left_anti"), "cut-contacts")
        few = (F.col("b_n") <= CONTACT_POINTS) | F.lit(level == LAST_LEVEL)
        placed = points.withColumn("block", p.block(level)).select(
            F.col("cell").alias("b_cell"), F.col("block").alias("b_block"), F.col("phi").alias("q_phi"), F.col("lam").alias("q_lam")
        )
        inside = (
            p.join(placed, cut.filter(few).select("id", "phi", "lam", "b_cell", "b_block"), ["b_cell", "b_block"], "inner", ["q_phi", "q_lam"])
            .filter(p.within("phi", "lam", "q_phi", "q_lam"))
            .groupBy("id", "b_cell").agg(F.count(F.lit(1)).alias("near"))
        )
        near = near.unionByName(inside)
        large = cut.filter(~few)
        if large.isEmpty():
            break
        active = materialise(large.select(F.col("b_cell").alias("cell"), F.col("b_block").alias("parent")).distinct(), "active-blocks")
        within = p.join(points.withColumn("parent", p.block(level)), active, ["cell", "parent"], "left_semi", ["phi", "lam"])
        parts = materialise(
            within.groupBy("cell", "parent", p.block(level + 1).alias("block")).agg(
                F.count(F.lit(1)).alias("n"), *_sample(), *box_aggregates()
            ),
            "block-parts",
        )
        keyed = large.select(*place, "b_cell", F.col("b_block").alias("b_parent"))
        reached = keyed.join(_marked(parts, "b_"), ["b_cell", "b_parent"])
    return materialise(near.groupBy("id", "b_cell").agg(F.sum("near").cast("bigint").alias("near")), "dense-contacts")


def _joined_cubes(links: DataFrame, unsure: DataFrame, points: DataFrame, blocks: DataFrame, p: Parameters) -> DataFrame:
    """(node, label): components of the cubes under ``links`` and those pairs of dense cubes in ``unsure`` that are within reach.

    Cubes that are in one component already are not compared: another link between them would change nothing. In a
    dense catalog hardly any pair is left, so block pairs do not grow with the density.
    """
    def edges(pairs: DataFrame) -> DataFrame:
        return pairs.select(_scrambled("a_cell").alias("u"), _scrambled("b_cell").alias("v"))

    first = connected_components(edges(links), p.broadcast_rows)
    placed = unsure
    for side, node in (("a", "u"), ("b", "v")):
        known = first.select(F.col("node").alias(node), F.col("label").alias(f"{side}_part"))
        placed = placed.withColumn(node, _scrambled(f"{side}_cell"))
        placed = p.join(placed, known, [node], "left", PAIR).withColumn(f"{side}_part", F.coalesce(f"{side}_part", node)).drop(node)
    apart = materialise(placed.filter("a_part <> b_part"), "apart")
    found = p.join(apart, materialise(_dense_links(points, blocks, apart.select(*PAIR), p).distinct(), "dense-links"), PAIR, "inner")
    second = connected_components(found.select(F.col("a_part").alias("u"), F.col("b_part").alias("v")), p.broadcast_rows)
    # Every cube of a found link, also one without a link before.
    ends = found.select(F.explode(F.array(*[
        F.struct(_scrambled(f"{s}_cell").alias("node"), F.col(f"{s}_part").alias("label")) for s in "ab"
    ])).alias("e")).select("e.*")
    parts = first.unionByName(ends).distinct()
    renamed = second.select(F.col("node").alias("label"), F.col("label").alias("_whole"))
    joined = p.join(parts, renamed, ["label"], "left", ["node"])
    return materialise(joined.select("node", F.coalesce("_whole", "label").alias("label")), "joined-cubes")


def density_labels(
    events: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES, id_col: str = "id", **options
) -> DataFrame:
    """(id, label, is_core) for events with coordinates.

    ``label`` is the smallest core id of the cluster, NULL for noise. A border
    point takes the smallest label among its core neighbours. A point counts as
    its own neighbour, as in the usual definition of ``min_samples``. ``events``
    is read several times: pass a scan, not an expensive plan.
    """
    if eps < SMALLEST_EPS or min_samples < 1:
        raise ValueError(f"eps must be at least {SMALLEST_EPS} radians and min_samples at least 1")
    p = Parameters(float(eps), int(min_samples), **options)
    located = events.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    points = place_on_sphere(
        located.select(F.col(id_col).alias("id"), "latitude", "longitude")
    ).withColumn("cell", cell_key(p.side)).drop("latitude", "longitude")

    blocks = materialise(
        points.groupBy("cell", p.block(1).alias("block")).agg(
            F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), *_sample(), *box_aggregates()
        ),
        "blocks",
    )
    merged_box = [f(f"{e}_{d}").alias(f"{e}_{d}") for d in "xyz" for e, f in (("lo", F.min), ("hi", F.max))]
    cells = materialise(
        blocks.groupBy("cell").agg(F.sum("n").alias("n"), F.min("first_id").alias("first_id"), F.first("sample").alias("sample"), *merged_box)
        .withColumn("dense", F.col("n") >= p.min_samples),
        "cells",
    )
    dense_cells, sparse_cells = cells.filter("dense"), cells.filter("not dense")

    # Occupied neighbouring cubes whose boxes are within reach, in both directions.
    # Two dense cubes whose samples are within reach are linked.
    boxed = ["cell", "dense", "sample", *BOX]
    adjacent = materialise(
        with_neighbour_cells(_marked(cells, "a_", boxed), p.side, "a_cell", "b_cell")
        .join(_marked(cells, "b_", boxed), "b_cell")
        .filter(box_gap_squared("a_", "b_") <= p.far)
        .select(*PAIR, "a_dense", "b_dense", p.within("a_sample.phi", "a_sample.lam", "b_sample.phi", "b_sample.lam").alias("hit")),
        "adjacent",
    )
    sparse_pairs = adjacent.filter("not a_dense and not b_dense").select(*PAIR)
    in_order = F.col("a_cell") < F.col("b_cell")

    # Points of sparse cubes. Cube mates are always neighbours, so only other cubes are searched.
    loose = materialise(
        p.join(points, sparse_cells.select("cell", "n"), ["cell"], "inner", ["id"]), "loose"
    )
    located_loose = loose.select("id", "phi", "lam", "cell")
    met = _meeting(sparse_pairs.filter(in_order), located_loose, located_loose, p)
    contacts = _dense_contacts(
        points, loose, dense_cells, blocks, adjacent.filter("not a_dense and b_dense").select(*PAIR), p
    )
    neighbours = (
        loose.select("id", F.col("n").alias("near"))
        .unionByName(met.select(F.explode(F.array("a_id", "b_id")).alias("id"), F.lit(1).cast("bigint").alias("near")))
        .unionByName(contacts.select("id", "near"))
        .groupBy("id").agg((F.sum("near") >= p.min_samples).alias("is_core"))
    )
    flagged = materialise(located_loose.join(neighbours, "id"), "flagged")
    cores, others = flagged.filter("is_core").drop("is_core"), flagged.filter("not is_core").drop("is_core")

    # Graph of the cubes that hold a core point, then the smallest core id of each component.
    spots = cores.select("cell", "phi", "lam")
    core_links = _meeting(sparse_pairs.filter(in_order), spots, spots, p).select(*PAIR)
    half = adjacent.filter("a_dense and b_dense").filter(in_order)
    core_touch = contacts.join(cores.select("id", F.col("cell").alias("a_cell")), "id").select(*PAIR)
    links = core_links.unionByName(core_touch).unionByName(half.filter("hit").select(*PAIR))
    components = _joined_cubes(links, half.filter("not hit").select(*PAIR), points, blocks, p)
    nodes = materialise(
        cores.groupBy("cell").agg(F.min("id").alias("first_id"))
        .unionByName(dense_cells.select("cell", "first_id"))
        .join(cells.select("cell", "dense"), "cell")
        .withColumn("node", _scrambled("cell")).join(components, "node", "left")
        .select("cell", "dense", "first_id", F.coalesce("label", "node").alias("component")),
        "nodes",
    )
    names = nodes.groupBy("component").agg(F.min("first_id").alias("label"))
    cell_labels = materialise(
        p.join(nodes.select("cell", "dense", "component"), names, ["component"], "inner", ["cell"])
        .select("cell", "dense", "label"),
        "cell-labels",
    )

    # Border points: the smallest label among core points in their own, an adjacent sparse or a dense cube.
    named = cell_labels.select("cell", "label")
    labelled_cores = cores.join(named, "cell")
    offers = (
        others.select("id", "cell").join(named, "cell").select("id", "label")
        .unionByName(
            _meeting(sparse_pairs, others, labelled_cores.drop("id"), p)
            .select(F.col("a_id").alias("id"), F.col("b_label").alias("label"))
        )
        .unionByName(
            contacts.join(others.select("id"), "id", "left_semi")
            .join(named.withColumnRenamed("cell", "b_cell"), "b_cell").select("id", "label")
        )
        .groupBy("id").agg(F.min("label").alias("label"))
    )
    in_cubes = p.join(
        points.select("id", "cell"), cell_labels.filter("dense").select("cell", "label"), ["cell"], "inner", ["id"]
    )
    return (
        in_cubes.select("id", "label", F.lit(True).alias("is_core"))
        .unionByName(labelled_cores.select("id", "label", F.lit(True).alias("is_core")))
        .unionByName(others.select("id").join(offers, "id", "left").select("id", "label", F.lit(False).alias("is_core")))
        .withColumnRenamed("id", id_col)
    )


def dbscan(
    events: DataFrame, eps: float = DBSCAN_EPS, min_samples: int = DBSCAN_MIN_SAMPLES, id_col: str = "id", **options
) -> DataFrame:
    """(id, cluster_id, is_core): clusters numbered from 0 by smallest core id, noise is -1."""
    labels = materialise(density_labels(events, eps, min_samples, id_col, **options), "density-labels")
    clusters = labels.filter(F.col("label").isNotNull()).select("label").distinct()
    numbers = row_numbers(clusters, [], ["label"], "_rn").select("label", (F.col("_rn") - 1).cast("int").alias("cluster_id"))
    return balanced_join(labels, numbers, ["label"], "left", [id_col], options.get("broadcast_rows")).select(
        id_col, F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), "is_core"
    )
