import os

from conftest import plan_of
from portolan.streaming import ingest, ledger

SCHEMA = "id bigint, amount decimal(10,2)"


def _load(spark, base, waves):
    """One file per wave, one batch per file."""
    landing = f"{base}/landing"
    os.makedirs(landing, exist_ok=True)
    for i, lines in waves:
        with open(f"{landing}/f{i:03}.csv", "w") as f:
            f.write("id,amount\n" + "".join(lines))
        ingest.ingest_csv(spark, landing, SCHEMA, f"{base}/target", f"{base}/checkpoint", max_files=1)
    return f"{base}/target"


def _told(df):
    return sorted(map(tuple, df.select("source_file", "rows_loaded", "rows_rejected", "misfit_rows", "first_error").collect()))


def _lines(i):
    return [f"{i},1.50\n"] * (i + 1) + (["x,2.00\n", "7,bad\n"] if i % 3 == 0 else [])


def test_ledger_equals_the_rows_and_reads_none_of_them(spark, tmp_path):
    target = _load(spark, tmp_path, [(i, _lines(i)) for i in range(10)])
    held = ledger.held(spark, target)
    assert _told(held) == _told(ledger.file_figures(spark.read.parquet(target)))
    by_file = {os.path.basename(r.source_file): r for r in held.collect()}
    assert (by_file["f003.csv"].rows_loaded, by_file["f003.csv"].rows_rejected) == (4, 2)
    assert by_file["f003.csv"].status == "PARTLY LOADED" and by_file["f004.csv"].status == "LOADED"
    assert by_file["f004.csv"].first_error is None and by_file["f003.csv"].first_error.startswith(("id: ", "amount: "))
    opened = held.inputFiles()
    assert all("/target.ledger/" in f for f in opened)
    assert {f.split("/target.ledger/")[1].rsplit("/", 1)[0] for f in opened} == {
        "level=1/first=0", "level=0/first=8", "level=0/first=9"}


def test_replayed_batch_counts_once(spark, tmp_path):
    target = _load(spark, tmp_path, [(i, _lines(i)) for i in range(8)])
    before = _told(ledger.held(spark, target))
    for batch in (7, 3):  # with and without a merge at its end
        path = f"{target}/batch_id={batch}"
        ledger.record(spark, target, batch, spark.read.parquet(path))
        assert _told(ledger.held(spark, target)) == before


def test_files_of_several_batches_and_levels(spark, tmp_path):
    """Figures of one file in many batches add up over two levels of merges, at every number of batches."""
    target = f"{tmp_path}/target"
    rows = spark.createDataFrame(
        [("a", "1", None, 0, False), ("a", None, ["id"], 1, True), ("b", "2", None, 0, False)],
        "source_file string, raw_row string, bad_columns array<string>, rejected int, misfit boolean",
    ).selectExpr("*", "timestamp '2024-01-01 00:00:00' AS loaded_at")
    for batch in range(9):
        ledger.record(spark, target, batch, rows, fanout=2)
        told = {r.source_file: (r.rows_loaded, r.rows_rejected, r.misfit_rows) for r in ledger.held(spark, target, 2).collect()}
        assert told == {"a": (batch + 1, batch + 1, batch + 1), "b": (batch + 1, 0, 0)}
    assert len(ledger.newest(ledger._segments(spark, f"{target}.ledger"), 2)) == 2


def test_a_missing_merge_is_read_from_its_parts():
    parts = {(0, i) for i in range(8)}
    assert ledger.newest(parts) == sorted(parts)
    assert ledger.newest(parts | {(1, 0)}) == [(1, 0)]
    assert ledger.newest(parts | {(1, 0), (0, 8)}) == [(1, 0), (0, 8)]


def test_nothing_loaded_has_an_empty_ledger(spark, tmp_path):
    assert ledger.held(spark, f"{tmp_path}/none").collect() == []


def test_errors_are_looked_for_among_rejects(spark, tmp_path):
    target = _load(spark, tmp_path, [(0, _lines(0))])
    plan = plan_of(ledger.file_figures(spark.read.parquet(target)))
    assert "PartitionFilters: [isnotnull(rejected" in plan
