import datetime
import os
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from portolan import bridge, schemas
from portolan.operators import joins, layers, messages, search
from conftest import DATA, plan_of
from portolan.plans.all import REGISTRY
from portolan.schemas import AMOUNTS, PAYLOAD
from portolan.sources import delimited, json_files, xml_files
from portolan.streaming import incremental, ingest
from portolan.streaming.declared import DeclaredSummary

HEADER = (
    "transaction_id,trade_date,settlement_date,customer_id,counterparty_country,transaction_type,"
    "currency_code,amount,booking_branch,instrument_type,free_text_notes\n"
)
GOOD = 'TX-1,2024-02-01,2024-02-05,7,FR,EXPORT,EUR,10.50,London,TT,"paid, in full"\n'


def _csv(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(lines), encoding="utf-8")
    return str(folder)


def test_csv_edges(spark, tmp_path):
    path = _csv(
        tmp_path / "csv", "a.csv", GOOD,
        "TX-2,2024-02-31,2024-02-05,7,FR,EXPORT,EUR,1,London,TT,bad date\n",
        "TX-3,2024-02-01,2024-02-05,7,FR,EXPORT,EUR,ten,London,TT,bad amount\n",
        "TX-4,2024-02-01,NULL,null,,EXPORT,EUR,1.005,London,TT,NULL tokens\n",
        "TX-5,2024-02-01,2024-02-05,1.7,FR,EXPORT,EUR,1,London,TT,surplus,column\n",
        "TX-6,2024-02-01,2024-02-05\n",
        'TX-7,2024-02-01,2024-02-05,7,FR,EXPORT,EUR,1,London,TT,"言った ""はい"""\n',
    )
    good, rejects = delimited.load_csv(spark, path, schemas.TRADES)
    rows = {r.transaction_id: r for r in good.collect()}
    assert set(rows) == {"TX-1", "TX-4", "TX-5", "TX-6", "TX-7"}
    assert rows["TX-1"].free_text_notes == "paid, in full" and rows["TX-1"].amount == Decimal("10.50")
    assert rows["TX-4"].settlement_date is None and rows["TX-4"].customer_id is None
    assert rows["TX-4"].counterparty_country is None and rows["TX-4"].amount == Decimal("1.01")
    assert rows["TX-5"].customer_id == 2  # whole numbers round, surplus columns are dropped
    assert rows["TX-6"].amount is None  # missing columns are NULL
    assert rows["TX-7"].free_text_notes == '言った "はい"'
    assert all(r.loaded_at is not None and r.source_file.endswith("a.csv") for r in rows.values())
    bad = {tuple(r.bad_columns): r.raw_row for r in rejects.collect()}
    assert set(bad) == {("trade_date",), ("amount",)} and "ten" in bad[("amount",)]
    assert good.count() + rejects.count() == 7


def test_csv_line_break_in_quotes(spark, tmp_path):
    path = _csv(tmp_path / "csv", "a.csv", GOOD.replace("paid, in full", "first\nsecond"))
    good, _ = delimited.load_csv(spark, path, schemas.TRADES, multiline=True)
    assert [r.free_text_notes for r in good.collect()] == ["first\nsecond"]


def test_json_arrays(spark, tmp_path):
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(
        '[{"customer_id": 1, "customer_name": "Aoi", "extra": [1, 2]},\n {"customer_id": "x"},\n {"customer_id": 3}]'
    )
    (folder / "b.json").write_text("[]")
    (folder / "c.json").write_text('{"customer_id": 9}')
    (folder / "broken.json").write_text('[{"customer_id": 1,')
    loaded = json_files.load_json_array(spark, str(folder))
    rows = json_files.variant_columns(loaded, {"customer_id": "bigint", "customer_name": "string"}).collect()
    got = sorted((r.source_file.split("/")[-1], r.element, r.customer_id, r.customer_name) for r in rows if r.customer_id)
    assert got == [("a.json", 0, 1, "Aoi"), ("a.json", 2, 3, None), ("c.json", 0, 9, None)]
    assert len(rows) == 4  # the wrong type is NULL in its row, the empty array gives no row
    text = spark.read.text(str(folder), wholetext=True)
    assert json_files.invalid_json(text, "value").count() == 1


def test_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a":\n\n{"a": null}\n')
    rows = json_files.variant_columns(json_files.load_json_lines(spark, str(tmp_path)), {"a": "int"}).collect()
    assert sorted(str(r.a) for r in rows) == ["1", "None"]
    assert [r.value for r in json_files.invalid_json(spark.read.text(str(tmp_path)), "value").collect()] == ['{"a":']


def _transfer(n, amount="5", more="", remit="<RmtInf><Ustrd>rent</Ustrd></RmtInf>"):
    tx = (
        f'<CdtTrfTxInf><PmtId><EndToEndId>E{n}</EndToEndId></PmtId><IntrBkSttlmAmt Ccy="USD">{amount}</IntrBkSttlmAmt>'
        f"<Dbtr><Nm>D{n}</Nm></Dbtr>{remit}</CdtTrfTxInf>"
    )
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n<Document xmlns="urn:x">\n<FIToFICstmrCdtTrf><GrpHdr>'
        f"<MsgId>M{n}</MsgId><CreDtTm>2026-05-03T00:00:00</CreDtTm><NbOfTxs>1</NbOfTxs></GrpHdr>{tx}{more}"
        "</FIToFICstmrCdtTrf>\n</Document>\n"
    )


def _statement(entries):
    body = "".join(
        f'<Ntry><Amt Ccy="{ccy}">{amount}</Amt><CdtDbtInd>{dc}</CdtDbtInd><BookgDt><Dt>2026-05-03</Dt></BookgDt></Ntry>'
        for ccy, amount, dc in entries
    )
    return (
        '<p:Document xmlns:p="urn:y"><p:BkToCstmrStmt><p:Stmt><p:Acct><p:Id><p:IBAN>JP9</p:IBAN></p:Id></p:Acct>'
        + body.replace("<", "<p:").replace("<p:/", "</p:")
        + "</p:Stmt></p:BkToCstmrStmt></p:Document>"
    )


def test_xml_messages(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    second = '<CdtTrfTxInf><PmtId><EndToEndId>E1b</EndToEndId></PmtId></CdtTrfTxInf>'
    (folder / "pacs_008_a.xml").write_text(_transfer(1, more=second) + _transfer(2, amount="n/a") + _transfer(3, remit=""))
    (folder / "PACS_008_b.xml").write_text(_transfer(4, amount="1000000000"))
    (folder / "other.xml").write_text("<Document><broken></Document>")
    loaded = xml_files.load_xml_messages(spark, str(folder))
    ids = {r.message_id: r.message_type for r in loaded.collect()}
    assert ids == {
        "pacs_008_a.xml-1": "pacs.008", "pacs_008_a.xml-2": "pacs.008", "pacs_008_a.xml-3": "pacs.008",
        "PACS_008_b.xml-1": "pacs.008", "other.xml-1": "unknown",
    }
    parsed = messages.parse(loaded)
    assert [r.message_id for r in messages.unreadable(parsed).collect()] == ["other.xml-1"]
    every = messages.transfers(parsed, "message_id").collect()
    assert sorted(r.end_to_end_id for r in every if r.msg_id == "M1") == ["E1", "E1b"]
    rows = {r.msg_id: r for r in messages.transfers(parsed, "message_id", nth=0).collect()}
    assert set(rows) == {"M1", "M2", "M3", "M4"}
    assert rows["M1"].end_to_end_id == "E1" and rows["M1"].settlement_amount == Decimal("5.00")
    assert rows["M2"].settlement_amount is None and rows["M2"].debtor_name == "D2"
    assert rows["M3"].remittance_info is None and rows["M1"].remittance_info == "rent"
    assert messages.transfers(parsed).count() == 5
    alerts = messages.large_value_alerts(messages.transfers(parsed)).collect()
    assert [(a.msg_id, a.flag) for a in alerts] == [("M4", "LARGE_VALUE_ALERT")]


def test_statement_with_one_none_and_many_entries(spark):
    docs = [
        _statement([("EUR", 1, "CRDT")]), _statement([]),
        _statement([("EUR", 2, "DBIT"), ("USD", 3, "DBIT"), ("EUR", 4, "CRDT")]),
    ]
    docs = [d.replace("</p:Document>", "</p:Document>") for d in docs]
    frame = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, payload string")
    parsed = messages.parse(frame)
    entries = messages.statement_entries(parsed, "id")
    assert sorted((r.id, r.entry_index, float(r.entry_amount)) for r in entries.collect()) == [
        (0, 0, 1.0), (2, 0, 2.0), (2, 1, 3.0), (2, 2, 4.0)
    ]
    totals = {(r.debit_credit, r.entry_count, float(r.total_amount)) for r in messages.account_totals(entries).collect()}
    assert totals == {("CRDT", 2, 5.0), ("DBIT", 2, 5.0)}
    assert messages.account_totals(entries, per_currency=True).count() == 3
    assert [r.entry_amount for r in messages.nth_entry(parsed, 1, "id").orderBy("id").collect()] == [
        None, None, Decimal("3.00")
    ]


def test_row_numbers_across_file_splits(spark, tmp_path):
    folder = tmp_path / "xml"
    folder.mkdir()
    (folder / "big.xml").write_text("".join(_transfer(n) for n in range(1, 301)))
    (folder / "small.xml").write_text(_transfer(1))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        docs = xml_files.read_documents(spark, str(folder))
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 3
        numbered = docs.where(F.col("source_file").endswith("big.xml")).select(
            "row_number", F.regexp_extract("payload", "<MsgId>M([0-9]+)", 1).cast("int").alias("n")
        ).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(r.n for r in numbered) == list(range(1, 301))
    assert all(r.row_number == r.n for r in numbered)


def test_ingest_reads_only_new_files(spark, tmp_path):
    landing, target, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    _csv(landing, "a.csv", GOOD, GOOD.replace("10.50", "ten"))
    args = (spark, str(landing), schemas.TRADES, target, checkpoint)
    assert ingest.ingest_csv(*args) == 1
    assert ingest.ingest_csv(*args) == 0
    _csv(landing, "b.csv", GOOD)
    assert ingest.ingest_csv(*args) == 1
    good, rejects = ingest.ingested(spark, target)
    assert good.count() == 2 and rejects.count() == 1


def test_drop_folder(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    names = [f.name for f in schemas.as_struct(schemas.CORPORATE_SALES)]
    row = dict(
        deal_id="D1", sales_rep="rep", customer_name="C, Ltd", industry="IT", company_size="big",
        opportunity_amount="12.5", stage="won", region="east", last_visit_date="2024-01-02",
        expected_close_date="2024-01-03",
    )

    def text(order, *rows, head=None):
        lines = [",".join(head or order)]
        lines += [",".join(f'"{r[c]}"' for c in order) for r in rows]
        return "\n".join(lines) + "\n"

    (drop / "one.csv").write_text(text(names, row, {**row, "deal_id": "D2", "opportunity_amount": "?"}))
    mixed = list(reversed(names))
    (drop / "TWO.CSV").write_text(text(mixed, {**row, "deal_id": "D3", "last_visit_date": "soon"},
                                       head=[f" {c.upper()} " for c in mixed]))
    (drop / "a +b.csv").write_text(text(names, {**row, "deal_id": "D4"}))
    (drop / "header.csv").write_text(text(names))
    (drop / "empty.csv").write_text("")
    (drop / "notes.txt").write_text("not a table")
    args = (spark, str(drop), str(tmp_path / "archive"), str(tmp_path / "out"), str(tmp_path / "cp"),
            schemas.CORPORATE_SALES, "deal_id")
    report = {r.source_file: (r.status, r.row_count) for r in ingest.load_drop_folder(*args).collect()}
    assert report == {
        "one.csv": ("LOADED", 2), "TWO.CSV": ("LOADED", 1), "a +b.csv": ("LOADED", 1), "header.csv": ("ERROR", 0), "empty.csv": ("ERROR", 0),
    }
    rows = {r.deal_id: r for r in spark.read.parquet(str(tmp_path / "out" / "rows")).collect()}
    assert set(rows) == {"D1", "D2", "D3", "D4"} and rows["D4"].source_file == "a +b.csv"
    assert rows["D2"].opportunity_amount is None and rows["D3"].last_visit_date is None
    assert rows["D1"].customer_name == "C, Ltd" and rows["D3"].source_file == "TWO.CSV"
    assert rows["D1"].loaded_at is not None
    assert sorted(p.name for p in drop.glob("[!.]*")) == ["empty.csv", "header.csv", "notes.txt"]
    assert sorted(p.name for p in (tmp_path / "archive").glob("[!.]*")) == ["TWO.CSV", "a +b.csv", "one.csv"]
    # The same name dropped again stays where it is and is reported; nothing is loaded twice.
    (drop / "one.csv").write_text(text(names, row))
    os.utime(drop / "one.csv", (2_000_000_000, 2_000_000_000))
    messages = {r.source_file: r.message for r in ingest.load_drop_folder(*args).where("status = 'ERROR'").collect()}
    assert messages["one.csv"] == "a file of this name was loaded before" and (drop / "one.csv").exists()
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == 4


def test_drop_folder_batch_replayed_before_files_moved(spark, tmp_path, monkeypatch):
    drop = tmp_path / "drop"
    drop.mkdir()
    names = [f.name for f in schemas.as_struct(schemas.CORPORATE_SALES)]
    (drop / "a.csv").write_text(",".join(names) + "\nD1" + "," * (len(names) - 1) + "\n")
    args = (spark, str(drop), str(tmp_path / "archive"), str(tmp_path / "out"), str(tmp_path / "cp"),
            schemas.CORPORATE_SALES, "deal_id")
    with monkeypatch.context() as patch:
        patch.setattr(ingest, "_move_files", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            ingest.load_drop_folder(*args)
    assert (drop / "a.csv").exists()
    ingest.load_drop_folder(*args)
    assert not (drop / "a.csv").exists() and (tmp_path / "archive" / "a.csv").exists()
    assert spark.read.parquet(str(tmp_path / "out" / "rows")).count() == 1


def test_prefixed_bare_and_commented_documents(spark, tmp_path):
    body = "<FIToFICstmrCdtTrf><GrpHdr><MsgId>{0}</MsgId></GrpHdr></FIToFICstmrCdtTrf>"
    prefixed = "<p:Document xmlns:p='urn:x'>" + body.replace("</", "</p:").replace("<F", "<p:F").replace(
        "<G", "<p:G").replace("<M", "<p:M") + "</p:Document>"
    (tmp_path / "a.xml").write_text(
        "<?xml version='1.0'?>\n" + prefixed.format("P1") + "\n" + prefixed.format("P2") + "\n<!-- the end -->\n")
    (tmp_path / "b.xml").write_text("<Document>" + body.format("B1") + "</Document>stray words")
    parsed = messages.parse(xml_files.load_xml_messages(spark, str(tmp_path)))
    rows = {r.message_id: r.msg_id for r in messages.transfer_headers(parsed, "message_id").collect()}
    assert rows == {"a.xml-1": "P1", "a.xml-2": "P2", "b.xml-1": "B1"}
    assert [r.text for r in xml_files.leftover_text(spark, str(tmp_path)).collect()] == ["stray words"]


def test_all_statements_transactions_and_texts(spark):
    entry = "<Ntry><Amt Ccy='EUR'>{0}</Amt><NtryDtls><TxDtls><RmtInf><Ustrd>x{0}</Ustrd><Ustrd>y</Ustrd></RmtInf></TxDtls>" \
            "<TxDtls/><TxDtls><RmtInf><Ustrd>z</Ustrd></RmtInf></TxDtls></NtryDtls></Ntry>"
    statement = "<Stmt><Acct><Id><IBAN>{0}</IBAN></Id></Acct>{1}</Stmt>"
    doc = "<Document><BkToCstmrStmt>" + statement.format("A", entry.format(1)) + statement.format(
        "B", entry.format(2) + entry.format(3)) + "</BkToCstmrStmt></Document>"
    rows = messages.statement_entries(messages.parse(spark.createDataFrame([(doc,)], "payload string"))).collect()
    assert [(r.account_iban, r.statement_index, r.entry_index, r.remittance_info) for r in rows] == [
        ("A", 0, 0, "x1 y z"), ("B", 1, 0, "x2 y z"), ("B", 1, 1, "x3 y z")]


def test_quoted_line_breaks_stay_in_their_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"first\nsecond"\n2,plain\n')
    good, rejects = delimited.load_csv(spark, str(tmp_path), "a int, b string")
    assert sorted((r.a, r.b) for r in good.collect()) == [(1, "first\nsecond"), (2, "plain")]
    assert rejects.count() == 0


def test_late_files_are_still_read(spark, tmp_path):
    import os
    import time

    source, args = str(tmp_path / "s"), (str(tmp_path / "t"), str(tmp_path / "c"))
    spark.range(3).coalesce(1).write.parquet(source)
    schema = spark.range(1).schema
    assert incremental.capture_appends(spark, source, schema, *args) == 1
    seen = set(os.listdir(source))
    spark.range(5).coalesce(1).write.mode("append").parquet(source)
    old = time.time() - 9 * 86400
    for name in set(os.listdir(source)) - seen:
        os.utime(f"{source}/{name}", (old, old))
    assert incremental.capture_appends(spark, source, schema, *args) == 1
    assert spark.read.parquet(args[0]).count() == 8


def test_wide_drop_folder_files_and_cells_that_name_the_key(spark, tmp_path):
    folder = tmp_path / "drop"
    folder.mkdir()
    names = [f"extra{i}" for i in range(38)] + ["deal_id", "customer_name"]
    lines = [",".join(names), ",".join(["x"] * 38 + ["D1", "deal_id"]), ",".join(["x"] * 38 + ["D2", '"two\nlines"'])]
    (folder / "wide.csv").write_text("\n".join(lines) + "\n")
    report = ingest.load_drop_folder(
        spark, str(folder), str(tmp_path / "archive"), str(tmp_path / "target"), str(tmp_path / "check"),
        "deal_id string, customer_name string", "deal_id").collect()
    assert [(r.status, r.row_count) for r in report] == [("LOADED", 2)]
    rows = spark.read.parquet(str(tmp_path / "target" / "rows")).collect()
    assert sorted((r.deal_id, r.customer_name) for r in rows) == [("D1", "deal_id"), ("D2", "two\nlines")]


def test_whole_array_files_are_parsed_by_element(spark, tmp_path):
    (tmp_path / "a.json").write_text("[" + ",\n".join('{"n": %d, "t": "%s"}' % (i, "x" * 1000) for i in range(20_000)) + "]")
    loaded = json_files.load_json_array(spark, str(tmp_path))
    assert json_files.variant_columns(loaded, {"n": "int"}).agg(F.sum("n")).first()[0] == 199_990_000


def test_state_refuses_another_checkpoint(spark, data, tmp_path):
    trades = bridge.trades(spark, data).select("transaction_id", *layers.DAILY_KEYS, "amount")
    source, state, check = (str(tmp_path / n) for n in ("source", "state", "check"))
    trades.limit(50).write.parquet(source)
    incremental.update_daily_totals(spark, source, trades.schema, state, check)
    total = incremental.read_daily_totals(spark, state).agg(F.sum("tx_count")).first()[0]
    assert total == 50
    with pytest.raises(ValueError):
        incremental.update_daily_totals(spark, source, trades.schema, state, str(tmp_path / "other"))
    compacted = str(tmp_path / "compacted")
    incremental.compact_daily_totals(spark, state, compacted)
    incremental.write_delta(trades.limit(50), 0, compacted, incremental._owner(spark, compacted)[1])  # replayed
    trades.limit(20).write.mode("append").parquet(source)
    assert incremental.update_daily_totals(spark, source, trades.schema, compacted, check) == 1
    assert incremental.read_daily_totals(spark, compacted).agg(F.sum("tx_count")).first()[0] == 70


def test_declared_summary_follows_its_sources(spark, data, tmp_path):
    trades, customers = bridge.trades(spark, data), bridge.customers(spark, data)
    path = str(tmp_path / "declared")
    part = trades.where("trade_date < DATE '1996-01-01'")
    incremental.refresh_daily_summary(part, customers, path)
    incremental.refresh_daily_summary(part, customers, path)
    assert DeclaredSummary(spark, path).ledger().count() == 1  # unchanged sources write nothing
    changed = customers.union(customers.limit(3))
    for now in (trades, part):
        for who in (customers, changed):
            got = incremental.refresh_daily_summary(now, who, path)
            full = layers.daily_summary(layers.harmonized_trades(now, who), extremes=True)
            assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
            assert sorted(map(str, layers.joined_daily_summary(now, who).collect())) == sorted(map(str, full.collect()))


def test_null_keys_and_zero_vectors(spark):
    rows = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int")
    assert joins.snapshot_diff(rows, rows, ["k"]).count() == 0
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])], "id int, v array<double>")
    got = [(r.id, r.similarity) for r in search.nearest(vectors, "id", "v", [1.0, 0.0], 3).collect()]
    assert got == [(1, 1.0), (3, 0.0), (2, None)]


def test_json_and_xml_files_are_loaded_once_with_a_ledger(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / x) for x in ("landing", "target", "checkpoint"))
    os.mkdir(landing)
    files = {"a.json": '[{"k": 1}, {"k": 2}]', "b.json": '[{"k": 3}, {"k"', "c.json": '{"k": 4}', "d.json": "[]",
             "e.json": '{"k": 5', "f.json": "  "}
    for name, text in files.items():
        (tmp_path / "landing" / name).write_text(text)
    assert ingest.ingest_json(spark, landing, target, checkpoint) == 1
    assert ingest.ingest_json(spark, landing, target, checkpoint) == 0
    (tmp_path / "landing" / "late.json").write_text('[{"k": 6}]')
    assert ingest.ingest_json(spark, landing, target, checkpoint) == 1
    good, rejects = ingest.ingested(spark, target)
    assert sorted(r.k for r in json_files.variant_columns(good, {"k": "int"}).collect()) == [1, 2, 3, 4, 6]
    assert {os.path.basename(r.source_file): (r.bad_columns, r.raw_row) for r in rejects.collect()} == {
        "b.json": (["payload"], '{"k"'), "e.json": (["payload"], files["e.json"])}
    ledger = {os.path.basename(r.source_file): (r.rows_loaded, r.rows_rejected, r.status)
              for r in ingest.load_ledger(spark, target).collect()}
    assert ledger["a.json"] == (2, 0, "LOADED") and ledger["b.json"] == (1, 1, "PARTLY LOADED")

    landing, target, checkpoint = (str(tmp_path / x) for x in ("pacs_008", "xml", "xml-checkpoint"))
    os.mkdir(landing)
    (tmp_path / "pacs_008" / "a.xml").write_text('<Document x="1"><A/></Document>\n<Document x="2"/>\n<Document x="3"></Document> stray')
    assert ingest.ingest_xml(spark, landing, target, checkpoint) == 1
    (tmp_path / "pacs_008" / "b.xml").write_text("<p:Document><B/></p:Document><!-- end -->")
    assert ingest.ingest_xml(spark, landing, target, checkpoint) == 1
    assert ingest.ingest_xml(spark, landing, target, checkpoint) == 0
    good, rejects = ingest.ingested(spark, target)
    batch = xml_files.load_xml_messages(spark, landing)
    key = lambda r: (r.message_id, r.message_type, r.payload)
    assert sorted(map(key, good.collect())) == sorted(map(key, batch.collect()))
    assert [(r.raw_row, os.path.basename(r.source_file)) for r in rejects.collect()] == [("stray", "a.xml")]


def test_rows_of_another_width_are_reported_and_refused_on_request(spark, tmp_path):
    short, surplus = "TX-6,2024-02-01,2024-02-05\n", GOOD.replace('"paid, in full"', "paid,twice")
    path = _csv(tmp_path / "csv", "a.csv", GOOD, short, surplus)
    _csv(tmp_path / "csv", "b.csv", GOOD)
    schema = schemas.as_struct(schemas.TRADES)
    rows = delimited.typed_rows(delimited.read_text_columns(spark, path, schema), schema)
    report = {os.path.basename(r.source_file): r for r in delimited.width_report(rows).collect()}
    assert (report["a.csv"].row_count, report["a.csv"].misfit_rows) == (3, 2)
    assert (report["b.csv"].misfit_rows, report["b.csv"].example) == (0, None)
    good, rejects = delimited.load_csv(spark, path, schemas.TRADES)
    assert good.count() == 4 and rejects.count() == 0
    good, rejects = delimited.load_csv(spark, path, schemas.TRADES, strict=True)
    assert good.count() == 2
    assert {(tuple(r.bad_columns), r.raw_row) for r in rejects.collect()} == {
        (("(width)",), short.strip()), (("(width)",), surplus.strip())}
    target = str(tmp_path / "target")
    ingest.ingest_csv(spark, path, schemas.TRADES, target, str(tmp_path / "checkpoint"))
    ledger = {os.path.basename(r.source_file): r.misfit_rows for r in ingest.load_ledger(spark, target).collect()}
    assert ledger == {"a.csv": 2, "b.csv": 0}
    good, _ = ingest.ingested(spark, target)
    assert "misfit" not in good.columns and good.count() == 4


def test_broken_elements_reject_themselves_and_not_their_file(spark, tmp_path):
    texts = {"comma.json": '[{"n": 1}, {"n": 2},]', "tru.json": '[{"n": 3}, {"n": tru}, [1, 2], {"n": 4}]',
             "cut.json": '[{"n": 5}, {"n": 6}', "brace.json": '[{"n": 7}, {"n": 8, {"n": 9}]', "two.json": '[{"n": 10}] x'}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    loaded = json_files.load_json_array(spark, str(tmp_path))
    found = json_files.variant_columns(loaded.where("source_file not like '%x%'"), {"n": "int"}).collect()
    assert sorted(r.n for r in found if r.n) == [1, 2, 3, 4, 5, 6, 7]
    bad = {(os.path.basename(r.source_file), r.element): r.raw_row
           for r in json_files.array_rejects(spark, str(tmp_path)).collect()}
    assert bad == {("comma.json", 2): "", ("tru.json", 1): '{"n": tru}',
                   ("brace.json", 1): '{"n": 8, {"n": 9}', ("two.json", 0): '{"n": 10}] x'}


def test_document_ends_inside_sections_are_text(spark, tmp_path):
    (tmp_path / "a.xml").write_text(
        "<Document x='1'><A><![CDATA[see </Document> tag]]></A></Document>\n<!-- </Document> --><Document><B/></Document>"
        "junk <Document x='3'/>\n<Document></Document>")
    rows = {r.row_number: r.payload for r in xml_files.read_documents(spark, str(tmp_path)).collect()}
    assert rows == {1: "<Document x='1'><A><![CDATA[see </Document> tag]]></A></Document>",
                    2: "<!-- </Document> --><Document><B/></Document>",
                    3: "<Document x='3'/>\n<Document></Document>"}
    assert xml_files.leftover_text(spark, str(tmp_path)).count() == 0


def test_begin_of_dropped_files_is_found_without_cells(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n1,\"x\ny\"\n2,z\n")
    (tmp_path / "b.csv").write_text("\nid,t\n")
    rows = spark.read.schema("_c0 string, _c1 string").option("multiLine", True).csv(str(tmp_path)).select(
        F.array("_c0", "_c1").alias("cells"), F.col("_metadata.file_path").alias("path"), F.lit(0).alias("modified"),
        F.monotonically_increasing_id().alias("position"))
    first = ingest._first_positions(rows)
    plan = plan_of(first)
    assert "ReadSchema: struct<>" in plan and "SortAggregate" not in plan
    at = {r.path: r.header_position for r in first.collect()}
    assert {(r.path, r.position) for r in rows.where("lower(cells[0]) = 'id'").collect()} == set(at.items())


def test_amounts_alone_are_those_of_the_whole_document(spark):
    """A query that totals amounts parses no other element; broken documents stay broken."""
    transfer = "<Document xmlns='urn:x'><FIToFICstmrCdtTrf><GrpHdr><MsgId>M</MsgId></GrpHdr>{}</FIToFICstmrCdtTrf></Document>"
    tx = "<CdtTrfTxInf><IntrBkSttlmAmt Ccy='EUR'>{}</IntrBkSttlmAmt><RmtInf><Ustrd>a</Ustrd><Ustrd/></RmtInf></CdtTrfTxInf>"
    entry = "<Ntry><Amt Ccy='EUR'>{}</Amt><NtryDtls><TxDtls/></NtryDtls></Ntry>"
    statement = "<Document><BkToCstmrStmt><Stmt>{}</Stmt><Stmt><Acct/></Stmt></BkToCstmrStmt></Document>"
    texts = [transfer.format(tx.format("1.50") + tx.format("x")), transfer.format(""), statement.format(entry.format(2) + entry.format(3)),
             transfer.format(tx.format("1"))[:-30], "no xml", "<Document/>", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, payload string")
    amounts = [F.col("doc.FIToFICstmrCdtTrf.CdtTrfTxInf.IntrBkSttlmAmt._VALUE"),
               F.transform("doc.BkToCstmrStmt.Stmt", lambda s: s["Ntry"]["Amt"]["_VALUE"])]
    whole, pruned = (messages.parse(frame, schema=s).orderBy("id").select(*amounts).collect() for s in (PAYLOAD, AMOUNTS))
    assert whole == pruned and whole[0][0] == ["1.50", "x"] and whole[2][1] == [["2", "3"], None]
    used = plan_of(REGISTRY["xml_files_loaded"].run(spark, DATA))
    assert "IntrBkSttlmAmt" in used and "CreDtTm" not in used


def test_messages_are_rendered_without_lambdas(spark, tmp_path):
    """Code is generated for all of a message; numbers of transactions and entries follow the keys, whatever their sign."""
    columns = ("transaction_id string, customer_id bigint, amount decimal(18,2), currency_code string, booking_branch string, "
               "counterparty_country string, instrument_type string, free_text_notes string, created_at timestamp_ntz")
    at = datetime.datetime(2026, 1, 2, 3, 4, 5)
    row = ("T", 0, Decimal("1.50"), "EUR", "tokyo", "JP", "SWAP", "a & b < c", at)
    rows = [(*row[:1], key, *row[2:]) for key in (0, 1, 2, -1, -2, None)]
    rows += [(*row[:7], None, at), (*row[:6], "LC", None, at), (*row[:6], None, "n", at), (*row[:2], None, *row[3:])]
    rendered = bridge.credit_transfer_xml(spark.createDataFrame(rows, columns).coalesce(1))
    assert "lambda" not in plan_of(rendered)
    texts = [r.payload for r in rendered.collect()]
    numbers = [t and re.findall(r"E2E--?\d+-(-?\d+)<.*?>([\d.-]+)</IntrBk", t) for t in texts]
    assert numbers[:6] == [[("0", "1.50")], [("0", "1.50"), ("1", "2.50")], [("0", "1.50"), ("1", "2.50"), ("2", "3.50")],
                           [("0", "1.50"), ("-1", "0.50")], [("0", "1.50"), ("-1", "0.50"), ("-2", "-0.50")], None]
    assert [len(n) for n in numbers[6:]] == [0, 1, 1, 0] and "RmtInf" not in texts[7] and "<Ustrd>n</Ustrd></RmtInf>" in texts[8]
    assert ('<Cdtr><Nm>Creditor JP</Nm></Cdtr><RmtInf><Ustrd>a &amp; b &lt; c</Ustrd><Ustrd>part 1</Ustrd></RmtInf>'
            '</CdtTrfTxInf></FIToFICstmrCdtTrf></Document>') in texts[1]

    orders = [(key, 7, 10.25, at) for key in (0, 1, 2, 3, 15, -3, None)] + [(2, 7, None, at), (3, 7, 1.0, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz").coalesce(
        1).write.parquet(f"{tmp_path}/orders.parquet")
    statements = bridge.statement_xml(spark, str(tmp_path))
    assert "lambda" not in plan_of(statements)
    texts = [r.payload for r in statements.collect()]
    entries = [t and re.findall(r'<Ntry><Amt Ccy="(\w+)">([\d.]+)<.*?Entry (\d)<', t) for t in texts]
    three = [("USD", "11.25", "1"), ("JPY", "12.25", "2"), ("EUR", "13.25", "3")]
    assert entries == [[], three[:1], three[:2], three, three * 2, [], None, [], []]


def test_documents_with_a_prolog_at_most_are_those_of_any_text(spark):
    """The short look at a document's first signs finds what the whole match of the text before it does."""
    texts = ["<Document>a</", "﻿\r\n<?xml version='1.0'?>\n<p:Document x='1'>b</p:", "<?a b?c?> <Document\n>d</", "no <Document>e</",
             "<!-- f --><Document>g</", "<Documents/><Document>h</", "<?xml?> <?i?> <Document>j</", "<?open <Document>k</", "l</"]
    records = spark.createDataFrame([(t, "f", i, True) for i, t in enumerate(texts)], "text string, source_file string, number bigint, closed boolean")
    assert [r.payload for r in xml_files.documents_of(records).orderBy("row_number").collect()] == [*(t + "Document>" for t in [
        "<Document>a</", "<?xml version='1.0'?>\n<p:Document x='1'>b</p:", "<?a b?c?> <Document\n>d</", "<Document>e</",
        "<!-- f --><Document>g</", "<Document>h</", "<?xml?> <?i?> <Document>j</", "<Document>k</"]), ""]
