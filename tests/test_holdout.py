"""The exact hold-out against sorting, and what a run leaves beside its results."""
from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest

from pitf.operators import split as sp


@pytest.mark.parametrize("digits", [1, 3])
@pytest.mark.parametrize("share", [0.01, 0.2, 0.5])
def test_radix_selection_equals_sorting(spark, monkeypatch, digits, share):
    monkeypatch.setattr(sp, "DIGITS", digits)
    draw = random.Random(digits)
    rows = [(i, draw.choice([0, 0, 0, 1, None])) for i in range(3000)] + [(9000, 7), (None, 0)]
    df = spark.createDataFrame(rows, "customer_id INT, churn INT")
    by = defaultdict(list)
    for i, c in rows:
        text = "5" if i is None else f"{i}|5"
        by[c].append((hashlib.md5(text.encode()).hexdigest(), i))
    want = {i for own in by.values() for _, i in sorted(own, key=lambda x: x[0])[:int(len(own) * share + 0.5)]}
    got = sp.stratified_test_flags(df, share, 5)
    assert {r["customer_id"] for r in got.where("is_test").collect()} == want and got.count() == len(rows)


def test_hold_out_of_little(spark):
    empty = spark.createDataFrame([], "customer_id INT, churn INT")
    assert sp.stratified_bounds(empty) == {} and sp.stratified_test_flags(empty).collect() == []
    same = spark.createDataFrame([(4, 1)] * 10, "customer_id INT, churn INT")
    assert sp.stratified_test_flags(same).where("is_test").count() == 10, "rows of one customer stay together"
    with pytest.raises(ValueError):
        sp.stratified_bounds(empty, 1.0)
