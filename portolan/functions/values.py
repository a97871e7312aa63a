"""Lookup values of the trade-banking domain.

Everything in this file is a fixed value: the lists are data, in their natural order,
and results depend on them.  No logic lives here.
"""

# --- fixed values: reference data -------------------------------------------------
# (country_code, country_name, region)
COUNTRIES = [
    ("JP", "Japan", "Tokyo"),
    ("US", "United States", "US"),
    ("GB", "United Kingdom", "UK"),
    ("SG", "Singapore", "APAC"),
    ("HK", "Hong Kong", "APAC"),
    ("AU", "Australia", "APAC"),
    ("DE", "Germany", "EU"),
    ("FR", "France", "EU"),
    ("CN", "China", "APAC"),
    ("KR", "South Korea", "APAC"),
    ("TH", "Thailand", "APAC"),
    ("IN", "India", "APAC"),
]
# (currency_code, currency_name, decimal_places)
CURRENCIES = [
    ("JPY", "Japanese Yen", 0),
    ("USD", "US Dollar", 2),
    ("GBP", "Pound Sterling", 2),
    ("EUR", "Euro", 2),
    ("SGD", "Singapore Dollar", 2),
    ("HKD", "Hong Kong Dollar", 2),
    ("AUD", "Australian Dollar", 2),
    ("CNY", "Chinese Yuan", 2),
    ("KRW", "South Korean Won", 0),
    ("THB", "Thai Baht", 2),
    ("INR", "Indian Rupee", 2),
]

# --- fixed values: enumerations ----------------------------------------------------
TRADE_CURRENCIES = ["JPY", "USD", "EUR", "GBP", "SGD", "HKD", "AUD", "CNY"]
TRANSACTION_TYPES = ["IMPORT", "EXPORT", "REMITTANCE"]
BRANCHES = ["Tokyo", "NewYork", "London", "Singapore"]
INSTRUMENTS = ["LC", "TT", "DOC_COLL"]
CUSTOMER_REGIONS = ["Tokyo", "US", "UK", "APAC", "EU"]
SEGMENTS = ["CORPORATE", "SME", "RETAIL"]
RISK_RATINGS = ["LOW", "MEDIUM", "HIGH"]

# Deal stages: proposal, quote, won, lost; twenty slots hold them 6 / 6 / 5 / 3.
PROPOSAL, QUOTE, WON, LOST = "提案", "見積", "受注", "失注"
STAGE_SLOTS = [PROPOSAL] * 6 + [QUOTE] * 6 + [WON] * 5 + [LOST] * 3
INDUSTRIES = ["製造", "金融", "IT", "小売", "サービス", "公共"]
# Large, medium, small companies; ten slots hold them 2 / 3 / 5.
LARGE, MEDIUM, SMALL = "大手", "中堅", "中小"
SIZE_SLOTS = [LARGE] * 2 + [MEDIUM] * 3 + [SMALL] * 5
# Sales regions; ten slots hold them 5 / 2 / 1 / 1 / 1.
SALES_REGION_SLOTS = ["関東"] * 5 + ["関西"] * 2 + ["中部", "九州", "海外"]


# --- fixed values: trade notes, English then Japanese ------------------------------
NOTES = [
    "Standard transaction. No issues reported.",
    "Routine payment processed within normal parameters.",
    "Regular settlement. All documentation verified.",
    "Counterparty requested expedited settlement due to year-end closing.",
    "Urgent: client requires same-day value. Escalated to operations.",
    "Priority processing requested. Deadline T+0 settlement.",
    "Suspicious pattern detected. Manual review escalated to compliance.",
    "AML flag raised. Transaction amount exceeds threshold. Pending SAR filing.",
    "Unusual transaction pattern: multiple small transfers to same beneficiary.",
    "Potential sanctions match on counterparty name. Requires enhanced due diligence.",
    "Customer disputed amount; resolved after reconciliation.",
    "Beneficiary claims non-receipt. Investigation opened. Ref: INV-2026-0042.",
    "Partial payment received. Shortfall of 15%. Customer notified.",
    "Amendment request: incorrect beneficiary account. Awaiting corrected details.",
    "High-priority client. Premium handling.",
    "VIP client instruction. Relationship manager approval obtained.",
    "White-glove service. Board-level transaction requiring CEO sign-off.",
    "Cross-border regulatory requirement met. Documentation filed with central bank.",
    "Trade finance: Letter of Credit confirmed. Advising bank notified.",
    "Documentary collection: Documents released against payment.",
    "通常取引。問題なし。",
    "定例の仕入代金支払い。書類確認完了。",
    "年度末決算に伴い早期決済を依頼されました。営業部承認済み。",
    "緊急: 顧客より当日中の着金を要請。オペレーション部門へエスカレーション。",
    "AMLフラグ: 短期間に同一受取人への少額送金が複数回検出。コンプライアンス部門にて精査中。",
    "取引先名が制裁リストと部分一致。EDD(強化された顧客管理)を実施。",
    "顧客より金額相違の申告あり。調査の結果、為替レート差異と判明。解決済み。",
    "受取人より未着の連絡あり。中継銀行へトレーサー送信。回答待ち。",
    "重要顧客(プライベートバンキング)。担当マネージャー承認取得済み。",
    "信用状(L/C)開設完了。通知銀行への連絡済み。船積書類待ち。",
]

# --- names of made-up customers -----------------------------------------------------
FAMILY_NAMES_JA = ["桐谷", "水無月", "鷹取", "白川", "真壁", "織部", "佐々井", "久遠寺", "早瀬"]
GIVEN_NAMES_JA = ["りく", "こはる", "蒼", "ミナト", "灯", "千早", "ゆずき"]
GIVEN_NAMES_EN = ["Orla", "Bram", "Ines", "Zoltan", "Maeve", "Tariq", "Signe", "Anaïs", "Piotr", "Wren", "Kofi"]
FAMILY_NAMES_EN = ["Abernathy", "O'Rourke", "Lindqvist", "Okafor", "Vandermeer", "Szabo", "Castellano-Ruiz"]

# --- fixed values: note labels and their descriptions ------------------------------
LABEL_DESCRIPTIONS = {
    "Standard": "Routine transactions with no issues or special handling",
    "Urgent/Expedited": "Time-sensitive transactions requiring priority processing",
    "Suspicious/Compliance": "Transactions flagged for AML, sanctions, or compliance review",
    "Dispute": "Transactions with customer complaints or amount disagreements",
    "VIP/Priority": "High-value client transactions requiring premium service",
}

# --- fixed values: policies ---------------------------------------------------------
MASKED_TEXT = "***MASKED***"
MASK_AMOUNT_ABOVE = 100_000_000
LARGE_VALUE_AT_LEAST = 1_000_000_000
LARGE_VALUE_FLAG = "LARGE_VALUE_ALERT"
PII_TAG_VALUES = ["NAME", "EMAIL", "PHONE"]
AMOUNT_TAG_VALUES = ["TRADE_AMOUNT", "DEAL_AMOUNT"]

# --- fixed values: synonyms of dimensions and metrics --------------------------------
TRADE_SYNONYMS = {
    "customer_id": ("顧客ID", "customer"),
    "customer_region": ("顧客リージョン", "地域", "region"),
    "customer_segment": ("セグメント", "segment", "顧客種別"),
    "risk_rating": ("リスク格付", "risk", "リスク"),
    "counterparty_country": ("相手国", "取引先国", "counterparty"),
    "transaction_type": ("取引種別", "種別", "type"),
    "currency_code": ("通貨", "currency", "為替"),
    "booking_branch": ("拠点", "支店", "branch", "オフィス"),
    "instrument_type": ("取引手段", "instrument"),
    "trade_date": ("取引日", "日付", "date"),
    "trade_year": ("年", "year"),
    "trade_month": ("月", "month"),
    "total_trade_amount": ("取引総額", "総額", "total amount", "売上"),
    "trade_count": ("取引件数", "件数", "count", "取引数"),
    "avg_trade_amount": ("平均取引額", "平均額", "average"),
}
SALES_SYNONYMS = {
    "sales_rep": ("営業担当", "担当者", "rep"),
    "industry": ("業種", "industry", "業界"),
    "company_size": ("企業規模", "size", "規模"),
    "stage": ("ステージ", "stage", "案件状態", "フェーズ"),
    "region": ("営業地域", "地域", "area"),
    "expected_close_date": ("受注予定日", "close date"),
    "total_pipeline": ("パイプライン総額", "pipeline", "見込み総額"),
    "deal_count": ("案件数", "deals", "案件件数"),
    "win_rate": ("受注率", "win rate", "成約率"),
}
