"""Radix selection of grouped quantiles against numpy: any doubles, hot groups, ties, nulls and empty input."""

from __future__ import annotations

import math
import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keepwell.functions import ordering

PROBS = [0.0, 0.25, 0.5, 0.9, 1.0]


def found(spark, rows, probs=PROBS, by=("k",)):
    df = spark.createDataFrame(rows, "k string, v double, n int, prob double, image long, prefix long")
    return {(r[0], r.prob): (r.n, r.value) for r in ordering.grouped_quantiles(df, list(by), "v", probs).collect()}


def wide(rows):
    return [(k, v, 1, 2.0, 3, 4) for k, v in rows]


def plainly(values, p):
    ordered = sorted(values)
    at = (len(ordered) - 1) * p
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


def test_many_groups_one_of_them_hot(spark):
    rng = np.random.default_rng(1)
    groups = {f"g{i}": rng.normal(size=rng.integers(1, 9)) * 10.0 ** rng.integers(-300, 300) for i in range(300)}
    groups["hot"] = np.round(rng.normal(size=4000), 2)
    groups[None] = np.array([2.0, 1.0])
    rows = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None), ("empty", None)]
    got = found(spark, wide(rows))
    assert set(got) == {(k, p) for k in groups for p in PROBS}
    for (k, p), (n, value) in got.items():
        assert n == len(groups[k])
        assert value == plainly(groups[k].tolist(), p), (k, p)


def test_signs_zeros_infinities_and_the_smallest_doubles(spark):
    odd = [-math.inf, -1e308, -5e-324, -0.0, 0.0, 5e-324, 2.2250738585072014e-308, 1.0, math.nextafter(1.0, 2.0), 1e308, math.inf]
    got = found(spark, wide([("k", v) for v in odd]), [i / 10 for i in range(11)])
    assert [got["k", i / 10][1] for i in range(11)] == odd
    assert found(spark, wide([("k", math.nan), ("k", 1.0), ("l", math.nan)]), [0.0, 1.0]) == {("k", 0.0): (1, 1.0), ("k", 1.0): (1, 1.0)}


def test_no_keys_no_rows_and_two_keys(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("a", None, 5.0), ("b", "x", 7.0)], "k string, l string, v double")
    assert [(r.n, r.prob, r.value) for r in ordering.grouped_quantiles(df, [], "v", [0.5]).collect()] == [(4, 0.5, 4.0)]
    two = {(r.k, r.l): r.value for r in ordering.grouped_quantiles(df, ["k", "l"], "v", [0.5]).collect()}
    assert two == {("a", "x"): 2.0, ("a", None): 5.0, ("b", "x"): 7.0}
    assert ordering.grouped_quantiles(df.where("false"), ["k"], "v", [0.5]).collect() == []
    assert ordering.grouped_quantiles(df.where("false"), [], "v", [0.5]).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False), min_size=2, max_size=2))
def test_images_order_like_their_doubles(pair):
    def image(x):
        bits = struct.unpack("<Q", struct.pack("<d", x + 0.0))[0]
        return ~bits & (2**64 - 1) if bits >> 63 else bits | 1 << 63
    import pandas as pd
    images = ordering._image.func(pd.Series(pair)).to_numpy().view(np.uint64).tolist()
    assert images == [image(x) for x in pair]
    assert (images[0] < images[1]) == (pair[0] < pair[1])
    assert ordering._value.func(pd.Series(np.array(images, np.uint64).view(np.int64))).tolist() == pair


@pytest.mark.parametrize("groups", [1, 50])
def test_four_rounds_whatever_the_number_of_groups(spark, monkeypatch, groups):
    written = []
    keep = ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda df, label: written.append(label) or keep(df, label))
    found(spark, wide([(f"g{i % groups}", float(i)) for i in range(200)]))
    assert written == ["images", *["ranks"] * 5]
