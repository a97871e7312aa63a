import random
from datetime import datetime, timedelta

from conftest import plan_of
from portolan.operators import versions
from portolan.streaming.history import History

SCHEMA = "id string, at timestamp_ntz, seq bigint, op string, value int"
START = datetime(2024, 1, 1)


def _changes(draw, n, first):
    """Changes of random keys and times, ties in time and NULLs included."""
    return [
        (draw.choice("abcdefg") if draw.random() > 0.05 else None,
         START + timedelta(hours=draw.randrange(0, 240)) if draw.random() > 0.05 else None,
         first + i, draw.choice(["INSERT", "UPDATE", "UPDATE", "DELETE"]), draw.choice([None, 1, 2, 3]))
        for i in range(n)
    ]


def _history(spark, path):
    return History(spark, str(path), "id", "at", "seq", "op")


def _rows(df):
    return sorted(map(tuple, df.select("id", "at", "seq", "value").collect()), key=str)


def test_snapshots_and_late_batches_equal_the_whole_log(spark, tmp_path):
    draw = random.Random(11)
    held, whole = _history(spark, tmp_path), []
    for batch, at in enumerate([4, None, 7, 2]):
        rows = _changes(draw, 40, 100 * batch)
        whole += rows
        held.append(spark.createDataFrame(rows, SCHEMA), batch)
        if at is not None:
            held.snapshot(START + timedelta(days=at))
        log = spark.createDataFrame(whole, SCHEMA)
        for day in (0.5, 2, 3.3, 4, 7, 9.9):
            moment = START + timedelta(days=day)
            expected = versions.state_as_of(log, "id", "at", "seq", "op", str(moment))
            assert _rows(held.as_of(moment)) == _rows(expected), (batch, day)
    timed = versions.state_as_of(log.where("at IS NOT NULL"), "id", "at", "seq", "op")
    assert _rows(held.as_of()) == _rows(timed)


def test_replayed_batch_counts_once_and_an_unnamed_one_is_not_read(spark, tmp_path):
    held = _history(spark, tmp_path)
    rows = spark.createDataFrame([("a", START, 1, "INSERT", 1)], SCHEMA)
    held.append(rows, 0)
    held.append(rows, 0)
    assert [r.row_count for r in held.ledger().collect()] == [1]
    # files of a batch whose ledger row was never written
    rows.selectExpr("'b' AS id", "at", "seq", "op", "value", "DATE '2024-01-01' AS __day").write.partitionBy("__day").parquet(
        f"{tmp_path}/log/batch=1")
    assert [r.id for r in held.as_of().collect()] == ["a"]
    held.append(rows.limit(0), 2)
    assert [r.id for r in held.as_of().collect()] == ["a"]


def test_a_read_opens_the_snapshot_and_the_days_since(spark, tmp_path):
    held = _history(spark, tmp_path)
    rows = [(f"k{i % 5}", START + timedelta(days=i), i, "UPDATE", i) for i in range(50)]
    held.append(spark.createDataFrame(rows, SCHEMA), 0)
    held.snapshot(START + timedelta(days=40))
    state = held.as_of(START + timedelta(days=43))
    assert sorted(r.value for r in state.collect()) == [39, 40, 41, 42, 43]
    opened = [f for f in state.inputFiles()]
    assert any("/snapshots/" in f for f in opened)
    plan = plan_of(state)
    assert "PartitionFilters" in plan and "__day" in plan
    scanned = spark.read.parquet(f"{tmp_path}/log").where("__day >= '2024-02-10' and __day <= '2024-02-13'")
    assert scanned.count() == 4
