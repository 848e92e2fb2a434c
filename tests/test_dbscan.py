"""Density clustering against a brute-force version."""

import math
import random

import pytest

from tremor.operators import dbscan as module
from tremor.operators.dbscan import dbscan


def angle(a, b):
    (p1, l1), (p2, l2) = a, b
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(h)))


def brute(rows, eps, least):
    at = {i: (math.radians(y), math.radians(x)) for i, y, x in rows}
    near = {i: [j for j in at if angle(at[i], at[j]) <= eps] for i in at}
    core = {i for i in at if len(near[i]) >= least}
    label = {}
    for i in sorted(core):
        if i in label:
            continue
        todo, label[i] = [i], i
        while todo:
            for j in near[todo.pop()]:
                if j in core and j not in label:
                    label[j] = i
                    todo.append(j)
    number = {c: n for n, c in enumerate(sorted(set(label.values())))}
    full = {}
    for i in at:
        found = [label[j] for j in near[i] if j in core]
        full[i] = (number[label[i] if i in core else min(found)] if found else -1, i in core)
    return full


def run(spark, rows, eps, least, **options):
    df = spark.createDataFrame(rows, "id string, latitude double, longitude double")
    return {r["id"]: (r["cluster_id"], r["is_core"]) for r in dbscan(df, eps, least, **options).collect()}


def cloud(seed, n, spots, spread):
    rng = random.Random(seed)
    centres = [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(spots)]
    rows = []
    for i in range(n):
        y, x = centres[rng.randrange(spots)]
        x = (x + rng.gauss(0, spread) + 180) % 360 - 180
        rows.append((f"e{i:04d}", max(-90.0, min(90.0, y + rng.gauss(0, spread))), x))
    return rows


@pytest.mark.parametrize("seed, spread, eps, least", [(1, 0.3, 0.004, 5), (3, 3.0, 0.03, 4)])
def test_clouds(spark, seed, spread, eps, least):
    rows = cloud(seed, 400, 6, spread)
    assert run(spark, rows, eps, least) == brute(rows, eps, least)


def test_dense_cubes_are_refined(spark):
    """Two dense swarms with gaps near eps; a tiny pair budget forces cutting into finer blocks,
    and tiny broadcast and split limits force the salted joins."""
    rng = random.Random(9)
    eps = 0.01
    degrees = math.degrees(eps)
    rows = []
    for k, gap in enumerate((0.98, 1.0 - 1e-4, 1.0 + 1e-4, 1.03)):
        y0 = 10.0 * k
        for i in range(40):
            rows.append((f"a{k}{i:03d}", y0, 20.0 - rng.random() * 0.3 * degrees))
            rows.append((f"b{k}{i:03d}", y0, 20.0 + gap * degrees / math.cos(math.radians(y0)) + rng.random() * 0.3 * degrees))
        rows.append((f"a{k}x", y0, 20.0))
        rows.append((f"b{k}x", y0, 20.0 + gap * degrees / math.cos(math.radians(y0))))
    want = brute(rows, eps, 5)
    assert run(spark, rows, eps, 5) == want
    assert run(spark, rows, eps, 5, pair_budget=2, broadcast_rows=3, rows_per_split=7) == want


def test_one_location_holds_most_events(spark):
    rows = [(f"h{i:04d}", 1.0, 100.0) for i in range(600)] + cloud(6, 200, 3, 0.2)
    assert run(spark, rows, 0.004, 5, broadcast_rows=3, rows_per_split=50) == brute(rows, 0.004, 5)


def test_small_groups(spark):
    """Five points make a cluster and four do not; the 180th meridian and a pole split nothing;
    a border point between two clusters joins the one with the smaller id."""
    step = math.degrees(0.0039)
    rows = [(f"f{i}", 0.0, 10.0) for i in range(5)] + [(f"g{i}", 0.0, 50.0) for i in range(4)]
    rows += [(f"m{i}", 0.0, 179.95 if i % 2 else -179.95) for i in range(6)]
    rows += [(f"p{i}", 89.95, 60.0 * i) for i in range(6)]
    rows += [(f"s{i}", 0.0, 100 - step) for i in range(4)] + [(f"t{i}", 0.0, 100 + step) for i in range(4)]
    rows += [(f"s{i}", 0.0, 100 - 1.5 * step) for i in range(4, 6)] + [(f"t{i}", 0.0, 100 + 1.5 * step) for i in range(4, 6)]
    rows += [("u", 0.0, 100.0)]
    got = run(spark, rows, 0.004, 5)
    assert got == brute(rows, 0.004, 5)
    assert {got[f"f{i}"] for i in range(5)} == {(0, True)} and {got[f"g{i}"] for i in range(4)} == {(-1, False)}
    assert {got[f"m{i}"] for i in range(6)} == {(1, True)} and {got[f"p{i}"] for i in range(6)} == {(2, True)}


def test_border_between_two_clusters(spark):
    rows = [(f"a{i}", 0.0, -0.2) for i in range(6)] + [(f"b{i}", 0.0, 0.2) for i in range(6)] + [("x", 0.0, 0.0)]
    rows = [(i, y, x + (0.02 if i == "a5" else -0.02 if i == "b5" else 0)) for i, y, x in rows]
    got = run(spark, rows, math.radians(0.19), 6)
    assert got == brute(rows, math.radians(0.19), 6) and got["x"] == (0, False)


def test_bad_arguments(spark):
    with pytest.raises(ValueError):
        run(spark, [("a", 0.0, 0.0)], 0.0, 5)


def test_hot_cut_block_next_to_loose_points(spark):
    """A dense cube that the reach of loose points cuts is refined down to blocks of few points."""
    rng = random.Random(8)
    eps = 0.02
    rows = [(f"h{i:05d}", 10 + rng.random() * 0.3, 20 + rng.random() * 0.3) for i in range(700)]
    rows += [(f"l{i:05d}", 10 + math.degrees(eps) * (0.7 + 0.06 * i), 20.1) for i in range(12)]
    assert run(spark, rows, eps, 40) == brute(rows, eps, 40)


def test_linked_cubes_are_not_compared_again(spark, monkeypatch):
    """Dense cubes that samples have put into one cluster need no block pairs; two clouds apart stay two clusters."""
    rng = random.Random(5)
    rows = [(f"e{i:04d}", rng.uniform(0, 1) + i % 2 * 20, rng.uniform(0, 1)) for i in range(1200)]
    compared, plain = [], module._dense_links

    def counted(points, blocks, pairs, p):
        compared.append(pairs.count())
        return plain(points, blocks, pairs, p)

    monkeypatch.setattr(module, "_dense_links", counted)
    assert run(spark, rows, 0.004, 5) == brute(rows, 0.004, 5)
    assert compared == [0]
