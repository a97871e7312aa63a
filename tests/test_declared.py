"""Declared tables under signed deltas: they equal a full computation after any change."""

import os
import random
from datetime import date
from decimal import Decimal

import pytest

from conftest import plan_of
from portolan.operators import layers
from portolan.streaming.declared import DeclaredSummary, appended, difference, net, removed

TRADES = ("transaction_id string, trade_date date, customer_id bigint, currency_code string, amount decimal(18,2), "
          "booking_branch string, transaction_type string")
CUSTOMERS = ("customer_id bigint, customer_name string, contact_email string, contact_phone string, region string, "
             "customer_segment string, risk_rating string")


def trade(i, customer=1, amount="10.00", day=1, branch="London"):
    return (f"TX-{i}", date(2024, 1, day), customer, "EUR", None if amount is None else Decimal(amount), branch, "EXPORT")


def customer(i, segment="A", mail="x"):
    return (i, f"name {i}", mail, "0", "EU", segment, "LOW")


def frames(spark, trades, customers):
    return spark.createDataFrame(trades, TRADES), spark.createDataFrame(customers, CUSTOMERS)


def shown(df):
    return sorted(map(str, df.collect()))


def check(declared, trades, customers):
    joined = layers.harmonized_trades(trades, customers).drop("contact_email", "contact_phone")
    assert shown(declared.joined().select(*joined.columns)) == shown(joined)
    assert shown(declared.summary()) == shown(layers.daily_summary(joined, extremes=True))


@pytest.fixture
def declared(spark, tmp_path):
    return DeclaredSummary(spark, str(tmp_path), parts=2, full_beyond=100)


def test_one_row_writes_a_delta_and_not_the_tables(spark, declared):
    rows = [trade(i, i % 9, f"{i}.00", 1 + i % 5) for i in range(300)]
    trades, customers = frames(spark, rows, [customer(i) for i in range(8)])
    declared.refresh(appended(trades), appended(customers))
    one = frames(spark, [trade(999, 3, "5.00", 1)], [])[0]
    assert declared.refresh(appended(one)) == 2
    last = declared.ledger().where("version = 2").first()
    assert (last["mode"], last.trade_rows, last.joined_rows, last.summary_rows) == ("incremental", 1, 1, 1)
    check(declared, trades.union(one), customers)


def test_changed_customer_touches_its_trades_and_groups_only(spark, declared):
    rows = [trade(i, i % 9, f"{i}.00", 1 + i % 9) for i in range(90)]  # one day a customer
    trades, customers = frames(spark, rows, [customer(i) for i in range(8)])
    declared.refresh(appended(trades), appended(customers))
    old, new = frames(spark, [], [customer(4)])[1], frames(spark, [], [customer(4, "B")])[1]
    declared.refresh(customer_changes=removed(old).union(appended(new)))
    now = customers.where("customer_id <> 4").union(new)
    check(declared, trades, now)
    last = declared.ledger().where("version = 2").first()
    assert (last.joined_rows, last.summary_rows) == (20, 1)
    # what the joined table leaves out changes nothing below
    mailed = frames(spark, [], [customer(4, "B", "y")])[1]
    declared.refresh(customer_changes=removed(new).union(appended(mailed)))
    assert declared.ledger().where("version = 3").first().joined_rows == 0
    # a customer that trades waited for, and one that leaves
    declared.refresh(customer_changes=appended(frames(spark, [], [customer(8)])[1]).union(removed(mailed)))
    check(declared, trades, customers.where("customer_id <> 4").union(frames(spark, [], [customer(8)])[1]))


def test_extremes_move_inwards_when_their_rows_go(spark, declared):
    rows = [trade(1, 1, "1.00"), trade(2, 1, "5.00"), trade(3, 1, "5.00"), trade(4, 1, None), trade(5, 1, "9.00"),
            trade(6, 2, "7.00", 2), trade(7, 2, None, 3)]
    trades, customers = frames(spark, rows, [customer(1), customer(1, "twice")])
    declared.refresh(appended(trades), appended(customers))
    held = rows
    for gone, came in (([5], []), ([3], [trade(8, 1, "5.00")]), ([1], [trade(9, 1, "0.50")]), ([6, 7], []),
                       ([], [trade(6, 2, "7.00", 2)]), ([2, 4, 8], [])):
        out = [r for r in held if int(r[0][3:]) in gone]
        held = [r for r in held if r not in out] + came
        declared.refresh(removed(frames(spark, out, [])[0]).union(appended(frames(spark, came, [])[0])))
        check(declared, frames(spark, held, [])[0], customers)


def test_null_keys_and_repeated_rows(spark, declared):
    rows = [trade(1, None, "1.00"), trade(1, None, "1.00"), (None,) * 7, (None,) * 7]
    trades, customers = frames(spark, rows, [customer(None)])
    declared.refresh(appended(trades), appended(customers))
    check(declared, trades, customers)
    one = frames(spark, rows[1:3], [])[0]
    declared.refresh(removed(one))
    check(declared, frames(spark, [rows[0], rows[2]], [])[0], customers)


def test_random_changes_with_both_modes_and_compaction(spark, tmp_path):
    draw = random.Random(3)
    declared = DeclaredSummary(spark, str(tmp_path), parts=2, full_beyond=0.2)
    who = {i: customer(i) for i in range(6)}
    held = {i: trade(i, draw.randrange(8), f"{draw.randrange(40)}.00", 1 + draw.randrange(3)) for i in range(60)}
    trades, customers = frames(spark, list(held.values()), list(who.values()))
    declared.refresh(appended(trades), appended(customers))
    for step in range(3):
        for i in draw.sample(sorted(held), 30 if step == 1 else 4):
            del held[i]
        for i in range(100 * (step + 1), 100 * (step + 1) + 5):
            held[i] = trade(i, draw.randrange(8), f"{draw.randrange(40)}.00", 1 + draw.randrange(3))
        who[draw.randrange(7)] = customer(step, f"S{step}")
        trades, customers = frames(spark, list(held.values()), list(who.values()))
        declared.refresh(difference(declared.trades(), trades), difference(declared.customers(), customers))
        check(declared, trades, customers)
    modes = [r["mode"] for r in declared.ledger().orderBy("version").collect()]
    assert modes[0] == "full" and {"full", "incremental"} == set(modes[1:])
    declared.compact()
    check(declared, trades, customers)
    gone = frames(spark, [held.pop(max(held))], [])[0]
    declared.refresh(removed(gone))
    check(declared, frames(spark, list(held.values()), [])[0], customers)


def test_no_change_no_version_and_unnamed_versions_are_not_seen(spark, declared, monkeypatch):
    trades, customers = frames(spark, [trade(1)], [customer(1)])
    with pytest.raises(ValueError, match="both tables"):
        declared.refresh(appended(trades))
    declared.refresh(appended(trades), appended(customers))
    assert declared.refresh(appended(trades).union(removed(trades))) == 1
    more = frames(spark, [trade(2)], [])[0]
    with monkeypatch.context() as patch:
        patch.setattr(DeclaredSummary, "_name", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            declared.refresh(appended(more))
    assert "version=2" in os.listdir(f"{declared.path}/summary")
    check(declared, trades, customers)  # the dead refresh left files, but no version
    declared.refresh(appended(more))
    check(declared, trades.union(more), customers)


def test_tables_may_be_empty(spark, declared):
    trades, customers = frames(spark, [], [])
    declared.refresh(appended(trades), appended(customers))
    assert declared.summary().count() == 0
    declared.refresh(appended(frames(spark, [trade(1)], [])[0]))
    check(declared, frames(spark, [trade(1)], [])[0], customers)


def test_net_cancels(spark):
    one = frames(spark, [trade(1), trade(2)], [])[0]
    assert net(appended(one).union(removed(one))).count() == 0
    assert shown(difference(one, one.limit(0)).select("weight")) == ["Row(weight=-1)"] * 2


def test_net_rows_are_shuffled_once_and_read_as_written(spark, tmp_path):
    """Deltas are dealt as their folders want them; a single one needs no other shuffle to be read."""
    declared = DeclaredSummary(spark, str(tmp_path), parts=4)
    rows = [(1, "a", 1), (1, "a", 1), (1, "b", 1), (1, "b", -1), (2, None, 1), (None, "c", 1), (None, "c", 2)]
    signed = spark.createDataFrame(rows, "customer_id bigint, note string, weight bigint")
    dealt = declared._dealt_net(signed)
    assert plan_of(dealt, "simple").count("Exchange hashpartitioning") == 1 and "rebalance" not in plan_of(dealt)
    assert declared._write_net("trades", 1, signed) == 3
    assert sorted(map(str, dealt.select(*signed.columns).collect())) == sorted(map(str, net(signed).collect()))
    held = declared._held("trades", 1, 1)
    assert "Exchange" not in plan_of(held)
    assert sorted(map(str, held.collect())) == sorted(map(str, declared._rows(signed).collect()))
    assert len(held.collect()) == 6
