import random

import pytest

from conftest import plan_of
from portolan.operators import joins, range_hashes
from portolan.operators.range_hashes import Layout

SCHEMA = "id bigint, part string, amount double, tags array<string>"


def _rows(df):
    return sorted(map(str, df.collect()))


def _both(spark, base, old, new, layout):
    for name, rows in (("old", old), ("new", new)):
        range_hashes.store(spark.createDataFrame(rows, SCHEMA), layout, f"{base}/{name}")
    return f"{base}/old", f"{base}/new"


@pytest.mark.parametrize("layout", [Layout(("id", "part"), width=10), Layout(("id", "part"), ranges=64)])
def test_equals_the_full_outer_join(spark, tmp_path, layout):
    draw = random.Random(5)

    def row(i):
        return (i if i % 17 else None, draw.choice("ab") + str(i), draw.choice([None, 0.5, 2.0]), draw.choice([None, [], [None], ["x"]]))

    old = [row(i) for i in range(-40, 160)]
    new = [r if draw.random() > 0.1 else (*r[:2], 9.0, r[3]) for r in old if draw.random() > 0.1] + [row(i) for i in range(500, 520)]
    paths = _both(spark, tmp_path, old, new, layout)
    expected = joins.snapshot_diff(spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA), ["id", "part"])
    assert _rows(range_hashes.stored_diff(spark, *paths, layout)) == _rows(expected)
    assert range_hashes.stored_diff(spark, paths[0], paths[0], layout).collect() == []


def test_one_changed_row_opens_one_range(spark, tmp_path):
    layout = Layout(("id",), width=100)
    old = [(i, "p", 1.0, []) for i in range(0, 60_000, 2)]
    new = [(*r[:2], 2.0, []) if r[0] == 30_002 else r for r in old]
    paths = _both(spark, tmp_path, old, new, layout)
    assert [tuple(r) for r in range_hashes.changed_pages(spark, *paths).collect()] == [(1,)]
    assert [r["__leaf"] for r in range_hashes.changed_ranges(spark, *paths).collect()] == [300]
    a, b = range_hashes.rows_of_changed_ranges(spark, *paths)
    assert (a.count(), b.count()) == (50, 50)
    assert "dynamicpruning" in plan_of(a).lower()
    diff = range_hashes.stored_diff(spark, *paths, layout).collect()
    assert [(r.id, r.op, r.amount, r.old_amount) for r in diff] == [(30_002, "UPDATE", 2.0, 1.0)]


@pytest.mark.parametrize("a, b", [((None, "x", None, None), (None, "x", None, [])), ((1, "x", None, []), (1, "x", None, [None])),
                                  ((1, "x", 0.0, None), (1, "x", None, None))])
def test_null_and_empty_values_differ(spark, tmp_path, a, b):
    layout = Layout(("id",), width=10)
    paths = _both(spark, tmp_path, [a], [b], layout)
    assert [r.op for r in range_hashes.stored_diff(spark, *paths, layout).collect()] == ["UPDATE"]


def test_empty_snapshots(spark, tmp_path):
    layout = Layout(("id",), width=10)
    paths = _both(spark, tmp_path, [], [(1, "x", 1.0, None)], layout)
    assert [r.op for r in range_hashes.stored_diff(spark, *paths, layout).collect()] == ["INSERT"]
    assert [r.op for r in range_hashes.stored_diff(spark, *paths[::-1], layout).collect()] == ["DELETE"]
    assert range_hashes.stored_diff(spark, paths[0], paths[0], layout).collect() == []


def test_pages_are_bounded(spark, tmp_path):
    layout = Layout(("id",), width=1)
    range_hashes.store(spark.range(-3, 3).selectExpr("id * 100000000 AS id"), layout, f"{tmp_path}/s")
    pages = spark.read.parquet(f"{tmp_path}/s/pages").selectExpr("min(__page)", "max(__page)").first()
    assert 0 <= pages[0] and pages[1] < range_hashes.PAGES
