"""Phrase rules for reading trade notes.  All phrases are lower case and matched as whole
words of what the note says and does not deny (``functions/phrases.py``), English and Japanese
alike.  They are parameters: every operator takes another list just as well.
"""

# Labels in order of precedence when two score the same; the last one is the default.
LABELS = ["Suspicious/Compliance", "Dispute", "Urgent/Expedited", "VIP/Priority", "Standard"]

# (label, phrase, weight)
LABEL_RULES = [
    ("Suspicious/Compliance", "suspicious", 3),
    ("Suspicious/Compliance", "unusual", 3),
    ("Suspicious/Compliance", "sanctions", 3),
    ("Suspicious/Compliance", "sanctioned", 3),
    ("Suspicious/Compliance", "aml flag", 3),
    ("Suspicious/Compliance", "sar filing", 2),
    ("Suspicious/Compliance", "due diligence", 2),
    ("Suspicious/Compliance", "to compliance", 2),
    ("Suspicious/Compliance", "amlフラグ", 3),
    ("Suspicious/Compliance", "制裁リスト", 3),
    ("Suspicious/Compliance", "コンプライアンス", 2),
    ("Dispute", "disputed", 3),
    ("Dispute", "non-receipt", 3),
    ("Dispute", "shortfall", 3),
    ("Dispute", "incorrect", 3),
    ("Dispute", "amendment request", 2),
    ("Dispute", "partial payment", 2),
    ("Dispute", "金額相違", 3),
    ("Dispute", "未着", 3),
    ("Urgent/Expedited", "urgent", 3),
    ("Urgent/Expedited", "expedited", 3),
    ("Urgent/Expedited", "priority processing", 3),
    ("Urgent/Expedited", "same-day", 2),
    ("Urgent/Expedited", "deadline", 2),
    ("Urgent/Expedited", "緊急", 3),
    ("Urgent/Expedited", "早期決済", 3),
    ("Urgent/Expedited", "当日中", 2),
    ("VIP/Priority", "vip", 3),
    ("VIP/Priority", "high-priority client", 3),
    ("VIP/Priority", "white-glove", 3),
    ("VIP/Priority", "premium", 2),
    ("VIP/Priority", "board-level", 2),
    ("VIP/Priority", "重要顧客", 3),
    ("Standard", "routine", 1),
    ("Standard", "standard", 1),
    ("Standard", "regular", 1),
    ("Standard", "通常", 1),
]

POSITIVE_PHRASES = [
    "premium", "vip", "white-glove", "approval obtained", "重要顧客", "承認取得",
]
NEGATIVE_PHRASES = [
    "suspicious", "aml flag", "unusual", "sanctions", "sanctioned", "disputed", "non-receipt", "shortfall",
    "incorrect", "amlフラグ", "制裁リスト", "金額相違", "未着",
]

# (level, phrase): the first phrase found decides; none found means LOW.
RISK_RULES = [
    ("HIGH", "suspicious"),
    ("HIGH", "sanctions"),
    ("HIGH", "sanctioned"),
    ("HIGH", "aml flag"),
    ("HIGH", "amlフラグ"),
    ("HIGH", "制裁リスト"),
    ("HIGH", "unusual transaction"),
    ("MEDIUM", "disputed"),
    ("MEDIUM", "non-receipt"),
    ("MEDIUM", "shortfall"),
    ("MEDIUM", "incorrect"),
    ("MEDIUM", "urgent"),
    ("MEDIUM", "expedited"),
    ("MEDIUM", "金額相違"),
    ("MEDIUM", "未着"),
    ("MEDIUM", "緊急"),
]
NO_RISK_REASON = "no risk phrase found"

# Words of a label description that say nothing about the label.
DESCRIPTION_STOP_WORDS = [
    "with", "for", "or", "and", "no", "transactions", "requiring", "client", "handling", "flagged",
]
