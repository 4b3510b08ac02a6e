"""The box test of open cell pairs against all point pairs."""

import itertools
import math
import random

from orderlake.operators import density


def test_boxes_find_the_linked_cell_pairs(spark, monkeypatch):
    monkeypatch.setattr(density, "_PAIR_WORK", 4)
    rng, eps, d = random.Random(2), 0.9, 2
    side = eps / math.sqrt(d)
    pts, want, pairs = [], [], []
    for k in range(12):
        a, b = (10 * k, 0), (10 * k + 2, 0)  # cells with one cell between them
        gap = [0.1, -0.03, 0.001, -0.04][k % 4]
        # the left cell's points end at its middle, the right one's begin eps and a little beyond that
        left = {((10 * k + 0.7) * side - rng.random() * 0.4 * side, rng.random() * 0.1 * side) for _ in range(40)}
        right = {(max(x for x, _ in left) + eps + gap * rng.choice((1, 3)) + rng.random() * 0.01, rng.random() * 0.1 * side) for _ in range(40)}
        right = {(x, y) for x, y in right if (10 * k + 2) * side <= x < (10 * k + 3) * side}
        pts += [(*p, a) for p in left] + [(*p, b) for p in right]
        if right:
            pairs.append((a, b))
            if any((x - u) ** 2 + (y - v) ** 2 <= eps * eps for (x, y), (u, v) in itertools.product(left, right)):
                want.append((a, b))
    points = spark.createDataFrame(pts, "x double, y double, cell struct<c0:bigint,c1:bigint>")
    open_pairs = spark.createDataFrame(pairs, "v struct<c0:bigint,c1:bigint>, u struct<c0:bigint,c1:bigint>")
    got = density._linked_by_boxes(open_pairs, points, ["x", "y"], side, eps * eps, eps * eps * (1 - 1e-9), eps * eps * (1 + 1e-9))
    assert sorted((tuple(r.v), tuple(r.u)) for r in got.collect()) == sorted(want)
    assert 0 < len(want) < len(pairs)
