"""Properties and small brute-force checks."""

import math
import random
import re

import regex
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from portolan import bridge
from portolan.functions import phrases, rules, values as v
from portolan.functions.columns import money_text, percent, try_typed
from portolan.functions.text import TOKEN, token_list
from portolan.operators import governance as g
from portolan.operators import joins, layers, metrics, reports, search, triage, vectors, versions
from portolan.streaming import incremental
from conftest import plan_of

# --- text ---------------------------------------------------------------------------------

_STANDARD, _URGENT, _SUSPICIOUS, _DISPUTE, _VIP = (
    "Standard", "Urgent/Expedited", "Suspicious/Compliance", "Dispute", "VIP/Priority"
)
NOTE_LABELS = (
    [_STANDARD] * 3 + [_URGENT] * 3 + [_SUSPICIOUS] * 4 + [_DISPUTE] * 4 + [_VIP] * 3 + [_STANDARD] * 3
    + [_STANDARD] * 2 + [_URGENT] * 2 + [_SUSPICIOUS] * 2 + [_DISPUTE] * 2 + [_VIP, _STANDARD]
)


READ = [  # note, label, sentiment, risk
    ("The wire went to a sanctioned entity", _SUSPICIOUS, "negative", "HIGH"),
    ("Not suspicious at all, routine", _STANDARD, "neutral", "LOW"),
    ("Not suspicious, but disputed", _DISPUTE, "negative", "MEDIUM"),
    ("VIPER cables shipment", _STANDARD, "neutral", "LOW"),
    ("It isn't urgent. VIP!", _VIP, "positive", "LOW"),
    ("xAMLフラグ確認", _STANDARD, "neutral", "LOW"),
    ("AMLフラグあり", _SUSPICIOUS, "negative", "HIGH"),
    ("制裁リスト該当なし。通常", _STANDARD, "neutral", "LOW"),
    ("", _STANDARD, "neutral", "LOW"),
    (None, None, None, None),
]


def test_notes_are_read_by_whole_words_and_outside_denials(spark):
    notes = spark.createDataFrame([(i, *row) for i, row in enumerate(READ)], "i int, note string, l string, s string, k string")
    level, _ = triage.risk(F.col("note"))
    rows = triage.classify(notes, "note").select(
        "note", "classification", triage.sentiment(F.col("note")).alias("tone"), level.alias("level"), "i").orderBy("i").collect()
    assert [tuple(r)[:4] for r in rows] == READ


def test_thousands_of_phrases_against_single_patterns(spark):
    draw = random.Random(3)
    parts = ["ab", "abc", "b", "ca", "é1", "急", "未着", "a-b", " ", " "]
    word = lambda n: "".join(draw.choice(parts) for _ in range(draw.randint(1, n))).strip() or "b"
    many = list({word(5) for _ in range(3000)})
    texts = [word(30) for _ in range(60)]

    def single(p):
        before, after = phrases.bounds(p)
        inner = phrases.WORD
        return regex.compile((f"(?<!{inner})" if before else "") + regex.escape(p) + (f"(?!{inner})" if after else ""))

    single_patterns = {p: single(p) for p in many}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = df.select("text", phrases.phrases_in(F.col("text"), many).alias("found")).collect()
    assert sum(len(r.found) for r in got) > 300
    for row in got:
        assert len(row.found) == len(set(row.found))
        assert set(row.found) == {p for p, one in single_patterns.items() if one.search(row.text)}
    few = len(plan_of(df.select(phrases.phrases_in(F.col("text"), many[:20]))).splitlines())
    assert len(plan_of(df.select(phrases.phrases_in(F.col("text"), many))).splitlines()) == few


def test_note_labels_sentiment_and_risk(spark):
    notes = spark.createDataFrame(list(enumerate(v.NOTES)), "i int, note string")
    level, reason = triage.risk(F.col("note"))
    rows = triage.classify(notes, "note").select(
        "*", triage.sentiment(F.col("note")).alias("s"), level.alias("level"), reason.alias("reason")
    ).orderBy("i").collect()
    assert [r.classification for r in rows] == NOTE_LABELS
    sentiment = {r.note: r.s for r in rows}
    assert sentiment["Suspicious pattern detected. Manual review escalated to compliance."] == "negative"
    assert sentiment["Standard transaction. No issues reported."] == "neutral"
    assert sentiment["High-priority client. Premium handling."] == "positive"
    assert sentiment["Customer disputed amount; resolved after reconciliation."] == "negative"
    assert {r.level for r in rows if r.classification == _SUSPICIOUS} == {"HIGH"}
    assert rows[0].level == "LOW" and rows[0].reason == rules.NO_RISK_REASON
    mixed = spark.createDataFrame([("VIP client disputed the fee",), (None,)], "note string")
    assert [r[0] for r in mixed.select(triage.sentiment(F.col("note"))).collect()] == ["mixed", None]


def _bm25(docs, query):
    words = {k: token_list_with_repeats(t) for k, t in docs.items()}
    mean = sum(map(len, words.values())) / len(words)
    scores = Counter()
    for term in token_list(query):
        df = sum(term in w for w in words.values())
        for k, w in words.items():
            tf = w.count(term)
            if tf:
                idf = math.log(1 + (len(words) - df + 0.5) / (df + 0.5))
                scores[k] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
    return sorted(((-round(s, 6), k) for k, s in scores.items()))


def token_list_with_repeats(text):
    return regex.findall(TOKEN, text.lower())


def test_changed_documents_replace_their_old_text(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(list(rows), "id int, text string")
    path = str(tmp_path / "index")
    search.write_index(frame((1, "größe alt"), (2, "alt"), (3, "neu")), "id", "text", path, "a", version=1)
    search.write_index(frame((1, "größe neu")), "id", "text", path, "b", version=2)
    index = search.read_index(spark, path, "id")
    assert {r.id for r in search.search(index, "id", "alt", 9).collect()} == {2}
    assert {r.id for r in search.search(index, "id", "Größe", 9).collect()} == {1}
    assert index.where(F.col("term") == search.EVERY_DOCUMENT).count() == 3


def test_search_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    docs = {i: " ".join(rng.choices(["alpha", "beta", "Gamma", "delta", "x1", "決済"], k=rng.randint(0, 12))) for i in range(60)}
    frame = spark.createDataFrame(list(docs.items()), "id bigint, text string")
    expected = _bm25(docs, "alpha GAMMA 済 nothing")[:15]
    scanned = search.scan_search(frame, "id", "text", "alpha GAMMA 済 nothing", 15).collect()
    assert [(-r.score, r.id) for r in scanned] == expected
    path = str(tmp_path / "index")
    search.write_index(frame.where("id < 40"), "id", "text", path, "a")
    search.write_index(frame.where("id >= 40"), "id", "text", path, "b")
    search.write_index(frame.where("id >= 40"), "id", "text", path, "b")  # the same batch again
    found = search.search(search.read_index(spark, path), "id", "alpha GAMMA 済 nothing", 15).collect()
    assert [(-r.score, r.id) for r in found] == expected


def test_nearest_vectors_against_brute_force(spark, data):
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in vectors.collect()}
    target = rows[3]

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(y * y for y in b))

    expected = sorted(((-round(cosine(e, target), 6), k) for k, e in rows.items()))[:8]
    got = search.nearest(vectors, "vec_id", "embedding", target, 8).collect()
    assert [(-r.similarity, r.vec_id) for r in got] == expected


def test_vector_index_equals_the_scan(spark, tmp_path):
    draw = random.Random(5)
    middles = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(12)]
    rows = [(i, f"g{i % 3}", [m + draw.gauss(0, 0.2) for m in middles[i % 12]]) for i in range(600)]
    rows += [(700 + i, "tie", rows[0][2]) for i in range(15)]
    rows += [(800, "odd", None), (801, "odd", [0.0] * 8), (802, "odd", [float("nan")] * 8), (803, "odd", [1.0]),
             (804, "odd", [None] * 8), (805, "odd", [float("inf")] + [0.0] * 7), (806, "odd", [])]
    df = spark.createDataFrame(rows, "id int, kind string, v array<double>")
    index = vectors.build_index(df, "id", "v", str(tmp_path / "index"), "kind")
    assert index.rows().count() == 615
    sound = df.where("kind <> 'odd'")
    for target in (rows[0][2], rows[17][2], [1.0] * 8, [-5.0] + [0.1] * 7):
        exact = search.nearest(sound.select("id", "v"), "id", "v", target, 20).collect()
        assert [(r.id, r.similarity) for r in index.search(target, 20).collect()] == [tuple(r) for r in exact]
        some = search.nearest(sound.where("kind = 'g1'").select("id", "v"), "id", "v", target, 5).collect()
        got = index.search(target, 5, probes=1, where=F.col("kind") == "g1").collect()
        assert [r.id for r in got] == [r.id for r in some]
    assert "PartitionFilters: [list" in plan_of(index.search(rows[17][2], 3, exact=False)).replace("isnotnull(list#", "list#")
    assert index.search([1.0] * 8, 1000).count() == 615
    probes = index.probes_for(10, recall=0.95)
    assert 1 <= probes <= 12 and (index.needed_probes(10, seed=2) <= probes).mean() >= 0.9
    with pytest.raises(ValueError):
        index.search([0.0] * 8, 3)


def test_vector_index_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, [])], "id int, v array<float>")
    index = vectors.build_index(df, "id", "v", str(tmp_path / "index"))
    assert index.search([1.0], 3).collect() == [] and index.probes_for(3) == 1


def test_sample_is_repeatable_subset_of_exact_size(spark):
    ids = spark.range(5000)
    a = {r.id for r in reports.sample_rows(ids, "id", 300, 1).collect()}
    assert a == {r.id for r in reports.sample_rows(ids.repartition(7), "id", 300, 1).collect()}
    assert len(a) == 300 and a < set(range(5000))
    assert a != {r.id for r in reports.sample_rows(ids, "id", 300, 2).collect()}


# --- joins and versions -----------------------------------------------------------------------

@pytest.mark.parametrize("keys", [[1, 2], [1, None], [], [None]])
def test_not_in_follows_sql(spark, keys):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    right = spark.createDataFrame([(k,) for k in keys], "k int")
    left.createOrReplaceTempView("not_in_left")
    right.createOrReplaceTempView("not_in_right")
    expected = spark.sql("SELECT k FROM not_in_left WHERE k NOT IN (SELECT k FROM not_in_right)").collect()
    got = joins.not_in(left, "k", right).collect()
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_restore_undoes_delete(spark, data):
    trades = bridge.trades(spark, data)
    lost = F.expr("booking_branch = 'Tokyo' AND trade_date < DATE '1998-01-01'")
    current = versions.without(trades, lost)
    assert 0 < current.count() < trades.count()
    restored = versions.restore(current, trades, "transaction_id", lost)
    assert restored.exceptAll(trades).count() == 0 and trades.exceptAll(restored).count() == 0


def test_diff_applied_to_old_gives_new(spark):
    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, x string")
    new = spark.createDataFrame([(2, None), (3, "d"), (4, None)], "k int, x string")
    got = {(r.k, r.op, r.x, r.old_x) for r in joins.snapshot_diff(old, new, ["k"]).collect()}
    assert got == {(1, "DELETE", None, "a"), (3, "UPDATE", "d", "c"), (4, "INSERT", None, None)}


def test_merge_meets_null_keys_once(spark):
    schema = "a string, n bigint, s decimal(10,2)"
    one = spark.createDataFrame([("x", 1, Decimal(5)), (None, 2, Decimal(7))], schema)
    merged = joins.merge_additive(joins.merge_additive(one, one, ["a"], ["n", "s"]), one, ["a"], ["n", "s"])
    assert {(r.a, r.n, int(r.s)) for r in merged.collect()} == {("x", 3, 15), (None, 6, 21)}


def test_customers_without_trades_and_trades_without_customers(spark):
    customers = spark.createDataFrame(
        [(1, "A", "e", "p", "EU", "SME", "LOW"), (2, "B", "e", "p", "EU", "SME", "LOW")],
        "customer_id bigint, customer_name string, contact_email string, contact_phone string, region string, "
        "customer_segment string, risk_rating string",
    )
    trades = spark.createDataFrame(
        [("t1", 1, Decimal("2.50"), "2024-01-01"), ("t2", 9, Decimal(1), "2024-01-01"), ("t3", None, Decimal(1), "2024-01-01")],
        "transaction_id string, customer_id bigint, amount decimal(18,2), trade_date string",
    )
    summary = {r.customer_id: (r.tx_count, r.total_amount) for r in layers.customer_summary(customers, trades).collect()}
    assert summary == {1: (1, Decimal("2.50")), 2: (0, None)}
    joined = {r.transaction_id: r.customer_name for r in layers.harmonized_trades(trades, customers).collect()}
    assert joined == {"t1": "A", "t2": None, "t3": None}


def test_rep_without_closed_or_won_deals(spark):
    deals = spark.createDataFrame(
        [("r1", v.PROPOSAL, Decimal(5)), ("r2", v.LOST, Decimal(6)), ("r3", v.WON, Decimal(7))],
        "sales_rep string, stage string, opportunity_amount decimal(18,2)",
    )
    rows = {r.sales_rep: r for r in layers.rep_performance(layers.harmonized_sales(deals)).collect()}
    assert rows["r1"].win_rate is None and rows["r1"].won_amount is None
    assert rows["r2"].win_rate == 0 and rows["r3"].win_rate == 1
    report = {r.sales_rep: r.win_rate_pct for r in reports.rep_report(layers.harmonized_sales(deals)).collect()}
    assert report == {"r1": None, "r2": Decimal("0.0"), "r3": Decimal("100.0")}


def test_formatting(spark):
    row = spark.range(1).select(
        money_text(F.lit("1234567.5").cast("decimal(18,2)")).alias("a"),
        money_text(F.lit("1234567890123456").cast("decimal(18,0)")).alias("b"),
        percent(F.lit(1), F.lit(8)).alias("c"),
        percent(F.lit(1), F.lit(0)).alias("d"),
        try_typed(F.lit("x"), "date").alias("e"),
    ).first()
    assert row.a == "      1,234,568" and row.b == "1,234,567,890,123,456"
    assert row.c == Decimal("12.5") and row.d is None and row.e is None


# --- governance --------------------------------------------------------------------------------

def test_roles_see_what_they_may(spark, data):
    trades = g.tag_columns(bridge.trades(spark, data), g.COLUMN_TAGS["trades"])
    total = trades.count()

    def seen(role):
        return trades.where(g.branch_access(F.col("booking_branch"), role))

    assert all(seen(r).count() == total for r in ("admin", "DATA_ENGINEER", "developer", "ACCOUNT_ADMIN"))
    assert {r.booking_branch for r in seen("analyst").select("booking_branch").distinct().collect()} == {"Tokyo"}
    assert seen("VISITOR").count() == 0

    masked = g.mask_tagged(trades, "analyst", g.default_policies(400_000))
    hidden = masked.where(F.col("amount").isNull()).count()
    assert hidden == trades.where("amount > 400000").count() > 0
    assert masked.where("amount <= 400000").count() + hidden == total
    assert masked.where("amount > 400000").count() == 0
    clear = g.mask_tagged(trades, "Data_Engineer", g.default_policies(400_000))
    assert clear.where("amount > 400000").count() == hidden
    assert g.tags_of(masked) == [("amount", "financial_amount_tag", "TRADE_AMOUNT")]


def test_tags_survive_views_and_joins(spark, data):
    customers = g.tag_columns(bridge.customers(spark, data), g.COLUMN_TAGS["customers"])
    view = layers.harmonized_trades(bridge.trades(spark, data), customers)
    masked = g.mask_tagged(view, "ANALYST", g.default_policies())
    assert {r.customer_name for r in masked.select("customer_name").distinct().collect()} == {v.MASKED_TEXT}


def test_names_outside_any_list_are_found(spark):
    names = [("Siobhán O'Dálaigh", "North America", "Relationship Team"), ("大黒屋 蓮華", "Asia Pacific", "Other Desk"),
             ("Jean-Luc de Vries", "Latin America", "x"), ("Ximena Q. Ybarra", "EU", "y"), ("高円寺 ゆら", "EU", "z")]
    found = g.detect_pii(spark.createDataFrame(names, "who string, region string, desk string"), threshold=0.8).collect()
    assert [(r.column_name, r.semantic_category) for r in found] == [("who", "NAME")]


def test_dictionary_tells_places_from_names(spark):
    rows = [("Berlin East", "orla szabo", "Mara Quist", None), ("Paris West", "bram okafor", "Lio Venn", None),
            ("Oslo Harbour", None, "Paris Szabo", None), (None, "ines wren", "Paris Okafor", None)]
    df = spark.createDataFrame(rows, "place_of_work string, holder string, person string, bare string")
    df = df.withColumnRenamed("place_of_work", "site")
    words = [("berlin", "place"), ("Paris", "place"), ("oslo", "place"), ("Szabo", "name"), ("okafor", "name"), ("wren", "name")]
    dictionary = spark.createDataFrame(words + words, "word string, kind string")
    rates = {(r.column_name, r.kind): r.match_rate for r in g.dictionary_rates(df, dictionary).collect()}
    assert rates == {("site", "place"): 1.0, ("holder", "name"): 1.0, ("person", "place"): 0.5, ("person", "name"): 0.5}
    by_shape = {r.column_name for r in g.detect_pii(df).collect()}
    assert by_shape == {"site", "person"}
    assert {r.column_name for r in g.detect_pii_with_dictionary(df, dictionary).collect()} == {"holder", "person"}
    numbers = spark.createDataFrame([(1,)], "n int")
    assert g.detect_pii_with_dictionary(numbers, dictionary).collect() == []


def test_detected_categories_become_tags(spark):
    rates = [("a", "PHONE_NUMBER", 0.9), ("a", "NAME", 0.95), ("b", "EMAIL", 1.0), ("c", "POSTCODE", 1.0)]
    tags = g.detected_tags(spark.createDataFrame(rates, "column_name string, semantic_category string, match_rate double"))
    assert tags == {"a": (g.PII_TAG, "NAME"), "b": (g.PII_TAG, "EMAIL")}
    df = g.tag_columns(spark.createDataFrame([("x", "y", "z")], "a string, b string, c string"), tags)
    seen = g.mask_tagged(df, "analyst", g.default_policies()).first()
    assert seen.a == seen.b != "x" and seen.c == "z"


def test_pii_categories(spark):
    rows = [("Mary Smith", "m@x.org", "+81-3-1234-5678", "EU"), ("佐藤 太郎", "s@x.org", "03-1234-5678", "US"),
            (None, None, None, None)]
    found = g.detect_pii(spark.createDataFrame(rows, "who string, mail string, tel string, region string")).collect()
    assert {(r.column_name, r.semantic_category, r.match_rate) for r in found} == {
        ("who", "NAME", 1.0), ("mail", "EMAIL", 1.0), ("tel", "PHONE_NUMBER", 1.0)
    }


# --- incremental -------------------------------------------------------------------------------

def _state(spark, state):
    rows = incremental.read_daily_totals(spark, state).drop("last_updated_at").collect()
    return sorted(str(r) for r in rows)


def test_replay_late_batch_and_null_keys(spark, tmp_path):
    state = str(tmp_path / "state")
    schema = "trade_date string, booking_branch string, currency_code string, transaction_type string, amount decimal(18,2)"
    first = spark.createDataFrame(
        [("2024-01-01", "Tokyo", "USD", "EXPORT", Decimal(5)), ("2024-01-01", None, "USD", "EXPORT", Decimal(1))], schema
    )
    late = spark.createDataFrame(
        [("2024-01-01", "Tokyo", "USD", "EXPORT", Decimal(7)), ("2024-01-01", None, "USD", "EXPORT", Decimal(2))], schema
    )
    incremental.write_delta(first, 0, state)
    incremental.write_delta(late, 1, state)
    once = _state(spark, state)
    incremental.write_delta(late, 1, state)  # the batch is replayed after a failure
    assert _state(spark, state) == once
    full = incremental.daily_delta(first.unionByName(late)).select(*layers.DAILY_KEYS, *incremental.MEASURES)
    assert sorted(str(r) for r in full.collect()) == once
    compacted = str(tmp_path / "compacted")
    incremental.compact_daily_totals(spark, state, compacted)
    assert _state(spark, compacted) == once


# --- metric layer -------------------------------------------------------------------------------

def test_names_are_resolved_or_refused(spark):
    assert metrics.resolve("通貨") == ("trade_orders", "currency_code")
    assert metrics.resolve("Win Rate") == ("corporate_sales", "win_rate")
    for name in ("地域", "region"):
        with pytest.raises(metrics.AmbiguousName):
            metrics.resolve(name)
    assert metrics.resolve("region", "corporate_sales") == ("corporate_sales", "region")
    with pytest.raises(KeyError):
        metrics.resolve("weather")
    table = metrics.synonym_table(spark)
    ambiguous = table.groupBy("name").agg(F.count_distinct("entity", "canonical").alias("n")).where("n > 1")
    assert {r.name for r in ambiguous.collect()} == {"region", "地域"}


def test_amounts_bring_their_currency(spark, data):
    views = {"trade_orders": bridge.trades(spark, data)}
    assert "currency_code" in metrics.metric_query(views, ["total_trade_amount"], ["branch"]).columns
    assert "currency_code" not in metrics.metric_query(views, ["trade_count"], ["branch"]).columns
    with pytest.raises(ValueError):
        metrics.metric_query(views, ["trade_count"], ["industry"])
    with pytest.raises(ValueError):
        metrics.metric_query(views, ["branch"], [])


def test_queries_without_tokens_and_tables_without_text(spark):
    notes = spark.createDataFrame([(1, "some words")], "id int, note string")
    assert search.scan_search(notes, "id", "note", "???", 3).collect() == []
    assert g.detect_pii(spark.range(5)).collect() == []
    places = spark.createDataFrame([("Berlin East",), ("New York",)], "place string")
    assert g.detect_pii(places).collect() == []
