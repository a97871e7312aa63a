"""Queries that read, label and search text."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from portolan import bridge
from portolan.functions import rules as r
from portolan.functions import values as v
from portolan.functions.phrases import HEARD, bounds
from portolan.functions.text import SIGNS, TOKEN, token_list, tokens
from portolan.operators import reports, search, term_vectors, triage, vectors
from portolan.plans import sql as q
from portolan.plans.registry import query
from portolan.session import scratch_dir
from portolan.streaming.index import refresh_index
from portolan.streaming.segments import SegmentedIndex

# The oracle joins distinct notes to rule tables instead of scoring row by row.
def _notes(source: str = "trades") -> str:
    said = "lower(note)"
    for pattern, instead in HEARD:
        said = f"regexp_replace({said}, '{pattern.replace("'", "''")}', '{instead}', 'g')"
    return f"(SELECT note, {said} AS heard FROM (SELECT DISTINCT free_text_notes AS note FROM {source}))"


def _bounded(rules: list[tuple], at: int) -> list[tuple]:
    """The rules with a pattern of their phrase (in column ``at``) and its word bounds."""
    out = []
    for rule in rules:
        before, after = bounds(rule[at])
        left, right = rf"(?:^|[^\p{{L}}\p{{N}}\p{{M}}]|[{SIGNS}])", rf"(?:$|[^\p{{L}}\p{{N}}\p{{M}}]|[{SIGNS}])"
        out.append((*rule, (left if before else "") + re.escape(rule[at]) + (right if after else "")))
    return out


_NOTES = _notes()
_ORDER = "CASE label " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(r.LABELS)) + " END"
_LABEL_SQL = f"""SELECT note, coalesce(arg_min(label, -1000 * score + rank), '{r.LABELS[-1]}') AS classification
    FROM (SELECT note, label, sum(weight) AS score, min({_ORDER}) AS rank FROM {_NOTES}
          LEFT JOIN (VALUES {q.rows(_bounded(r.LABEL_RULES, 1))}) AS t(label, phrase, weight, seen) ON regexp_matches(heard, seen)
          GROUP BY note, label) GROUP BY note"""
_TERMS = [(label, t) for label, terms in triage.described_terms(v.LABEL_DESCRIPTIONS).items() for t in terms]
_DESCRIBED_SQL = f"""SELECT note, coalesce(arg_min(label, -1000 * score + rank), '{r.LABELS[-1]}') AS classification
    FROM (SELECT note, label, count(DISTINCT term) AS score, min({_ORDER}) AS rank
          FROM (SELECT note, unnest(regexp_extract_all(lower(note), '{TOKEN}')) AS word FROM {_NOTES})
          LEFT JOIN (VALUES {q.rows(_TERMS)}) AS t(label, term) ON word = term
          GROUP BY note, label) GROUP BY note"""
_SIGNED = [(p, 1, 0) for p in r.POSITIVE_PHRASES] + [(p, 0, 1) for p in r.NEGATIVE_PHRASES]
_SENTIMENT_SQL = f"""SELECT note, CASE WHEN good > 0 AND bad > 0 THEN 'mixed' WHEN good > 0 THEN 'positive'
    WHEN bad > 0 THEN 'negative' ELSE 'neutral' END AS sentiment
    FROM (SELECT note, sum(g) AS good, sum(b) AS bad FROM {_NOTES}
          LEFT JOIN (VALUES {q.rows(_bounded(_SIGNED, 0))}) AS t(phrase, g, b, seen) ON regexp_matches(heard, seen) GROUP BY note)"""
_RISKS = [(i, level, p, f"contains '{p}'") for i, (level, p) in enumerate(r.RISK_RULES)]
RISK_SQL = f"""SELECT note, coalesce(arg_min(level, ord), 'LOW') AS risk_level,
    coalesce(arg_min(why, ord), '{r.NO_RISK_REASON}') AS reason FROM {_NOTES}
    LEFT JOIN (VALUES {q.rows(_bounded(_RISKS, 2))}) AS t(ord, level, phrase, why, seen) ON regexp_matches(heard, seen) GROUP BY note"""
_PCT = "((2000 * sum(n) + sum(sum(n)) OVER ()) // (2 * sum(sum(n)) OVER ())) / 10.0::DOUBLE"


@query("M1 I9", q.query(
    f"""SELECT transaction_id, free_text_notes, classification FROM trades
        JOIN ({_LABEL_SQL}) ON note = free_text_notes""", "trades"))
def classified_notes(spark, sf_dir):
    df = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes")
    return triage.classify(df, "free_text_notes")


@query("M2", q.query(
    f"""SELECT transaction_id, free_text_notes, classification FROM trades
        JOIN ({_DESCRIBED_SQL}) ON note = free_text_notes""", "trades"))
def classified_notes_by_description(spark, sf_dir):
    df = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes")
    return triage.classify(df, "free_text_notes", triage.labels_by_description(F.col("free_text_notes")))


# A few words per language; most turns are told by other words, which come up beside these elsewhere.
_LANGUAGE_WORDS = {
    "English": ["with", "this", "from"], "French": ["avec", "dans", "pour"],
    "German": ["nicht", "und", "mit"], "Spanish": ["para", "los", "del"],
}
_SEEDS = [(label, w) for label, words in _LANGUAGE_WORDS.items() for w in words]
_LABEL_RANK = [(label, i) for i, label in enumerate(_LANGUAGE_WORDS)]


@query("M2", q.query(
    f"""SELECT conv_id, turn, CASE WHEN text IS NOT NULL THEN coalesce(label, 'Other') END AS classification,
        len(list_intersect(regexp_extract_all(lower(text), '{TOKEN}'), {q.text_list([w for _, w in _SEEDS])})) > 0 AS shares_a_word
        FROM conversations LEFT JOIN best ON text = note""",
    words=f"""SELECT note, unnest(list_distinct(regexp_extract_all(lower(note), '{TOKEN}'))) AS term
        FROM (SELECT DISTINCT text AS note FROM conversations WHERE text IS NOT NULL)""",
    notes="SELECT CAST(count(DISTINCT text) AS DOUBLE) AS n_all FROM conversations",
    seeds=q.rows_cte("label, seed", _SEEDS), ranks=q.rows_cte("label, rank", _LABEL_RANK),
    alone="SELECT term, count(*) AS n FROM words GROUP BY term",
    pairs="""SELECT a.term, b.term AS seed, CAST(count(*) AS DOUBLE) AS n_both
        FROM words a JOIN (SELECT * FROM words WHERE term IN (SELECT seed FROM seeds)) b USING (note) GROUP BY ALL HAVING count(*) >= 3""",
    weights="""SELECT p.term, label, sum(ln(n_both * n_all / (t.n * s.n)) / -ln(n_both / n_all)) / 3 AS weight
        FROM pairs p JOIN seeds USING (seed) JOIN alone t ON t.term = p.term JOIN alone s ON s.term = p.seed, notes
        WHERE n_both < n_all AND n_both * n_all > t.n * s.n GROUP BY p.term, label""",
    best="""SELECT note, arg_min(label, rank - 1000000000 * score) AS label FROM (
        SELECT note, label, round(sum(weight), 6) AS score FROM words JOIN weights USING (term) GROUP BY note, label)
        JOIN ranks USING (label) WHERE score > 0 GROUP BY note"""))
def turns_labelled_by_related_words(spark, sf_dir):
    turns = bridge.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    known = F.array(*[F.lit(w) for _, w in _SEEDS])
    return term_vectors.label_by_related_terms(turns, "text", _LANGUAGE_WORDS, "Other").select(
        "conv_id", "turn", "classification", F.arrays_overlap(tokens(F.col("text")), known).alias("shares_a_word"))


@query("M3 E1", q.query(
    f"""SELECT classification, CAST(sum(n) AS BIGINT) AS cnt, {_PCT} AS pct
        FROM (SELECT free_text_notes, count(*) AS n FROM
              (SELECT free_text_notes FROM trades ORDER BY md5(transaction_id || '|7'), transaction_id LIMIT 1000)
              GROUP BY free_text_notes)
        JOIN ({_LABEL_SQL}) ON note = free_text_notes GROUP BY classification""", "trades"))
def label_shares_of_sample(spark, sf_dir):
    df = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes")
    return triage.label_shares(reports.sample_rows(df, "transaction_id", 1000, 7), "free_text_notes").orderBy(
        F.desc("cnt")
    )


@query("D22", q.query(
    f"""SELECT classification, count(*) AS cnt FROM trades
        JOIN ({_LABEL_SQL}) ON note = free_text_notes GROUP BY classification""", "trades"))
def label_counts(spark, sf_dir):
    return triage.label_shares(bridge.trades(spark, sf_dir), "free_text_notes").select("classification", "cnt")


@query("D22", "SELECT quality, toxic, count(*) AS cnt FROM labels GROUP BY quality, toxic")
def document_label_counts(spark, sf_dir):
    return bridge.table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count("*").alias("cnt"))


@query("M4", q.query(
    f"""SELECT transaction_id, free_text_notes, sentiment FROM trades
        JOIN ({_SENTIMENT_SQL}) ON note = free_text_notes""", "trades"))
def note_sentiment(spark, sf_dir):
    return bridge.trades(spark, sf_dir).select(
        "transaction_id", "free_text_notes", triage.sentiment(F.col("free_text_notes")).alias("sentiment")
    )


@query("M5", q.query(
    f"""SELECT free_text_notes, count(*) AS cnt, sentiment FROM trades
        JOIN ({_SENTIMENT_SQL}) ON note = free_text_notes GROUP BY free_text_notes, sentiment""", "trades"))
def sentiment_per_note(spark, sf_dir):
    counted = bridge.trades(spark, sf_dir).groupBy("free_text_notes").agg(F.count("*").alias("cnt"))
    return counted.withColumn("sentiment", triage.sentiment(F.col("free_text_notes"))).orderBy(
        "sentiment", F.desc("cnt")
    )


@query("M6", q.query(
    f"""SELECT transaction_id, {q.day('trade_date')} AS trade_date, booking_branch, {q.dbl('amount')} AS amount,
        free_text_notes, sentiment FROM trades
        JOIN ({_SENTIMENT_SQL}) ON note = free_text_notes WHERE sentiment = 'negative'""", "trades"))
def negative_note_alerts(spark, sf_dir):
    return bridge.trades(spark, sf_dir).select(
        "transaction_id", "trade_date", "booking_branch", "amount", "free_text_notes",
        triage.sentiment(F.col("free_text_notes")).alias("sentiment"),
    ).where(F.col("sentiment") == "negative")


@query("M7", q.query(
    f"""SELECT transaction_id, free_text_notes, risk_level, reason FROM trades
        JOIN ({RISK_SQL}) ON note = free_text_notes""", "trades"))
def note_risk(spark, sf_dir):
    df = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes")
    return triage.remittance_risk(df, "free_text_notes")


_ALTERED = """CASE booking_branch WHEN 'Tokyo' THEN concat('Not ', free_text_notes)
    WHEN 'NewYork' THEN replace(replace(free_text_notes, 'VIP', 'VIPER'), 'AML', 'XAML')
    WHEN 'London' THEN concat('Never late but ', free_text_notes, ' Sanctioned entity?')
    ELSE concat(free_text_notes, ' 制裁リスト該当なし') END"""


@query("M1 M4 M7", q.query("", "trades").rstrip()
       + f", altered AS (SELECT transaction_id, {_ALTERED} AS free_text_notes FROM trades) "
       + f"""SELECT transaction_id, free_text_notes, classification, sentiment, risk_level, reason FROM altered
        JOIN ({_LABEL_SQL.replace(_NOTES, _notes('altered'))}) a ON a.note = free_text_notes
        JOIN ({_SENTIMENT_SQL.replace(_NOTES, _notes('altered'))}) b ON b.note = free_text_notes
        JOIN ({RISK_SQL.replace(_NOTES, _notes('altered'))}) c ON c.note = free_text_notes""")
def notes_with_denials(spark, sf_dir):
    """Notes that deny, contrast, or hold a phrase inside a longer word."""
    notes = bridge.trades(spark, sf_dir).select("transaction_id", F.expr(_ALTERED).alias("free_text_notes"))
    read = triage.classify(notes, "free_text_notes").withColumn("sentiment", triage.sentiment(F.col("free_text_notes")))
    return triage.remittance_risk(read, "free_text_notes")


def _bm25_sql(source: str, key: str, text: str, terms: list[str], k: int, keep: str = "") -> str:
    """BM25 over ``source`` by unnesting every token and joining the counts."""
    keep_sql = f", {keep}" if keep else ""
    wanted = ", ".join(f"'{t}'" for t in terms)
    return f"""tok AS (SELECT {key} AS k, unnest(regexp_extract_all(lower({text}), '{TOKEN}')) AS term FROM {source}),
        len AS (SELECT d.{key} AS k, count(t.term) AS dl FROM {source} d LEFT JOIN tok t ON t.k = d.{key} GROUP BY 1),
        corpus AS (SELECT count(*) AS n, avg(dl) AS mean_length FROM len),
        tf AS (SELECT k, term, count(*) AS tf FROM tok WHERE term IN ({wanted}) GROUP BY k, term),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        scored AS (SELECT tf.k, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * {search.K1 + 1}
                / (tf + {search.K1} * (1 - {search.B} + {search.B} * dl / mean_length))), 6) AS score
            FROM tf JOIN df USING (term) JOIN len ON len.k = tf.k, corpus GROUP BY tf.k)
        SELECT s.{key}, s.{text}{keep_sql}, score FROM scored JOIN {source} s ON s.{key} = scored.k
        ORDER BY score DESC, s.{key} LIMIT {k}"""


def _search_sql(*args, **kwargs) -> str:
    return q.query("", "trades").rstrip() + ", " + _bm25_sql(*args, **kwargs)


_FIRST, _SECOND = "suspicious compliance review", "urgent expedited settlement year-end"


@query("M9", _search_sql(
    "trades", "transaction_id", "free_text_notes", _FIRST.split(), 10,
    f"transaction_type, booking_branch, {q.dbl('amount')} AS amount"))
def note_search_suspicious(spark, sf_dir):
    return search.scan_search(
        bridge.trades(spark, sf_dir), "transaction_id", "free_text_notes", _FIRST, 10,
        "transaction_type", "booking_branch", "amount",
    )


@query("M9", _search_sql(
    "trades", "transaction_id", "free_text_notes", _SECOND.replace("-", " ").split(), 10,
    f"booking_branch, {q.dbl('amount')} AS amount"))
def note_search_urgent(spark, sf_dir):
    return search.scan_search(
        bridge.trades(spark, sf_dir), "transaction_id", "free_text_notes", _SECOND, 10,
        "booking_branch", "amount",
    )


@query("M11", q.query("", "trades").rstrip()
       + ", recent AS (SELECT * FROM trades WHERE trade_date >= DATE '2001-08-01' - INTERVAL 2 MONTH"
       + " AND transaction_type = 'EXPORT' AND booking_branch = 'Tokyo'), "
       + _bm25_sql("recent", "transaction_id", "free_text_notes", _SECOND.replace("-", " ").split(), 10,
                   "booking_branch"))
def note_search_recent_exports(spark, sf_dir):
    recent = bridge.trades(spark, sf_dir).where(
        (F.col("trade_date") >= F.add_months(F.lit("2001-08-01").cast("date"), -2))
        & (F.col("transaction_type") == "EXPORT")
        & (F.col("booking_branch") == "Tokyo")
    )
    return search.scan_search(recent, "transaction_id", "free_text_notes", _SECOND, 10, "booking_branch")


@query("M11 M12", q.query("", "trades").rstrip()
       + ", recent AS (SELECT * FROM trades WHERE transaction_type = 'EXPORT' AND booking_branch = 'Tokyo'), "
       + _bm25_sql("recent", "transaction_id", "free_text_notes", _SECOND.replace("-", " ").split(), 10)
       .replace("SELECT s.transaction_id, s.free_text_notes, score", "SELECT s.transaction_id, score"))
def indexed_search_of_exports(spark, sf_dir):
    """The index holds type and branch; notes written first under other words have a newer version."""
    path = scratch_dir(spark, "notes-index")
    trades = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes", "transaction_type", "booking_branch")
    old = trades.where("transaction_type = 'EXPORT'").withColumn("free_text_notes", F.lit("urgent expedited draft"))
    args = ("transaction_id", "free_text_notes", path)
    search.write_index(old, *args, "old", "transaction_type", "booking_branch", version=1, short=True)
    search.write_index(trades, *args, "new", "transaction_type", "booking_branch", version=2, short=True)
    index = search.read_index(spark, path, "transaction_id").where(
        (F.col("transaction_type") == "EXPORT") & (F.col("booking_branch") == "Tokyo"))
    return search.search(index, "transaction_id", _SECOND, 10)


@query("M9 M12 J1", _search_sql("trades", "transaction_id", "free_text_notes", _FIRST.split(), 25)
       .replace("SELECT s.transaction_id, s.free_text_notes, score", "SELECT s.transaction_id, score"))
def segmented_search_after_rewrites(spark, sf_dir):
    """Four batches, most notes first under other words, two merges of segments, then a search."""
    trades = bridge.trades(spark, sf_dir).select("transaction_id", "free_text_notes", "booking_branch")
    index = SegmentedIndex(
        spark, scratch_dir(spark, "segments"), "transaction_id", "free_text_notes", ("booking_branch",), fanout=2,
        short=True)
    draft = F.lit("suspicious draft under compliance review")
    index.add(trades.withColumn("free_text_notes", draft), 0)
    for batch, branches in enumerate([["Tokyo"], ["NewYork", "London"], ["Singapore"]], 1):
        index.add(trades.where(F.col("booking_branch").isin(branches)), batch)
    return index.search(_FIRST, 25)


_JAPANESE = "制裁リスト 緊急"


@query("M9", _search_sql("trades", "transaction_id", "free_text_notes", token_list(_JAPANESE), 10, "booking_branch"))
def note_search_japanese(spark, sf_dir):
    return search.scan_search(
        bridge.trades(spark, sf_dir), "transaction_id", "free_text_notes", _JAPANESE, 10, "booking_branch"
    )


_DOC_QUERY = "erthen thatou inerre the"


@query("M9 M12", "WITH " + _bm25_sql("documents", "doc_id", "text", _DOC_QUERY.split(), 20))
def document_search(spark, sf_dir):
    """Whole documents: build the index, query it, fetch the texts of the hits."""
    docs = bridge.table(spark, sf_dir, "documents").select("doc_id", "text")
    path = scratch_dir(spark, "index")
    search.write_index(docs, "doc_id", "text", path, batch="all")
    hits = search.search(search.read_index(spark, path), "doc_id", _DOC_QUERY, 20)
    # Twenty rows by construction.
    return docs.join(F.broadcast(hits), "doc_id").select("doc_id", "text", "score")


@query("M12 J1", q.query(
    f"""SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS occurrences, CAST(max(tf) AS BIGINT) AS max_tf
        FROM (SELECT conv_id, turn, term, count(*) AS tf FROM (SELECT conv_id, turn,
              unnest(regexp_extract_all(lower(text), '{TOKEN}')) AS term FROM conversations)
              GROUP BY ALL) GROUP BY term"""))
def index_terms_after_refresh(spark, sf_dir):
    """Documents arrive in two waves; a refresh after each indexes only the new ones."""
    base = scratch_dir(spark, "refresh")
    turns = bridge.table(spark, sf_dir, "conversations").select(
        F.concat_ws("/", "conv_id", "turn").alias("doc"), "role", "text"
    )
    for wave in (turns.where(F.col("role") == "user"), turns.where(~F.col("role").eqNullSafe("user"))):
        wave.write.mode("append").parquet(f"{base}/source")
        refresh_index(spark, f"{base}/source", turns.schema, "doc", "text", f"{base}/index", f"{base}/checkpoint")
    index = search.read_index(spark, f"{base}/index")
    return index.where(F.col("term") != search.EVERY_DOCUMENT).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("occurrences"), F.max("tf").alias("max_tf")
    )


@query("M10", """SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[],
    (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)), 6) AS similarity
    FROM embeddings WHERE vec_id <> 7 ORDER BY similarity DESC, vec_id LIMIT 10""")
def nearest_vectors(spark, sf_dir):
    vectors = bridge.table(spark, sf_dir, "embeddings")
    target = vectors.where(F.col("vec_id") == 7).select("embedding").scalar()
    return search.nearest(vectors.where(F.col("vec_id") != 7), "vec_id", "embedding", target, 10)


@query("M10", """SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[],
    (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)), 6) AS similarity
    FROM embeddings WHERE vec_id <> 7 ORDER BY similarity DESC, vec_id LIMIT 10""")
def nearest_vectors_by_index(spark, sf_dir):
    """The same rows from an index, which prunes lists by their radius."""
    rows = bridge.table(spark, sf_dir, "embeddings")
    index = vectors.build_index(rows, "vec_id", "embedding", scratch_dir(spark, "vectors"), "label")
    target = rows.where(F.col("vec_id") == 7).select("embedding").first().embedding
    return index.search(target, 10, where=F.col("vec_id") != 7)


@query("M10", "SELECT count(*) AS indexed, true AS recall_reached FROM embeddings")
def vector_index_recall(spark, sf_dir):
    """Probes chosen on one sample of targets find nine tenths of the neighbours of another."""
    rows = bridge.table(spark, sf_dir, "embeddings")
    index = vectors.build_index(rows, "vec_id", "embedding", scratch_dir(spark, "vectors"))
    probes = index.probes_for(10, seed=1)
    found = float((index.needed_probes(10, seed=2) <= probes).mean())
    return index.rows().agg(F.count("*").alias("indexed"), F.lit(found >= 0.9).alias("recall_reached"))
