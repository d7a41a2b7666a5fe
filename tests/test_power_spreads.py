"""Variances under the powers of a grid."""

import numpy as np
import pytest

from keepwell.operators import segments


def test_spreads_are_the_variances_under_each_power(spark):
    x = [-3.0, -0.5, 0.0, 1.0, 2.5, 40.0]
    df = spark.createDataFrame([(v, abs(v)) for v in x] + [(None, 1.0)], "x double, y double")
    grids = {"x": [-1.5, 0.0, 0.7, 2.0], "y": [0.0, 1.0]}
    found = {(r.place, r.i): r["var"] for r in segments.spreads(df, grids).collect()}

    def moved(v, lam):
        def box(u, p):
            return np.log1p(u) if p == 0 else ((u + 1) ** p - 1) / p
        return box(v, lam) if v >= 0 else -box(-v, 2 - lam)
    for place, (values, grid) in enumerate(((x, grids["x"]), ([abs(v) for v in x] + [1.0], grids["y"]))):
        for i, lam in enumerate(grid):
            assert found.pop((place, i)) == pytest.approx(np.var([moved(v, lam) for v in values]))
    assert not found
