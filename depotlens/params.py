"""Parameters of the engine: vocabularies, thresholds and horizons.

Everything a rule, feature or label depends on is a field here, so a run is a
pure function of (tables, parameters). The defaults are the production values
of the depot book; the synthetic test tables use another vocabulary
(``FIXTURE_VOCAB``) because their security names are generic words.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as they are for results to match the
# existing depot book (names, words, patterns, codes, texts).
# ---------------------------------------------------------------------------

TECH_NAMES = (
    "APPLE", "MICROSOFT", "AMAZON", "ALPHABET", "GOOGLE", "META PLATFORMS", "FACEBOOK",
    "TESLA", "NETFLIX", "NVIDIA", "ADVANCED MICRO DEVICES", "AMD", "INTEL", "BROADCOM",
    "QUALCOMM", "ASML", "TSMC", "TAIWAN SEMICONDUCTOR", "MICRON", "MARVELL", "NXP",
    "STMICROELECTRONICS", "INFINEON", "TEXAS INSTRUMENTS", "ANALOG DEVICES",
    "ON SEMICONDUCTOR", "ONSEMI", "ADOBE", "SALESFORCE", "ORACLE", "SERVICENOW",
    "SNOWFLAKE", "DATADOG", "MONGODB", "ATLASSIAN", "ELASTIC", "INTUIT", "SHOPIFY",
    "PALANTIR", "CLOUDFLARE", "PALO ALTO NETWORKS", "CROWDSTRIKE", "ZSCALER",
    "FORTINET", "OKTA", "SAMSUNG ELECTRONICS", "TENCENT", "ALIBABA", "BAIDU", "SAP",
)
# A fund counts as tech when its name has the word "etf" and one sector word.
ETF_WORD = "etf"
ETF_SECTOR_WORDS = (
    "technology", "technologie", "software", "cloud", "semiconductor",
    "halbleiter", "robotics", "robotik", "cybersecurity",
)
# Booking remarks that mark internal transfers (excluded from money flows).
INTERNAL_REMARK_PATTERN = r"umbuchung|intern|depot[ -]?übertrag|uebertrag|transfer"

# Booking type -> flow class, first matching class wins (substring of the
# lower-cased type).
FLOW_CLASS_RULES = (
    ("in", ("einlage", "eingang", "überweisung", "ueberweisung")),
    ("out", ("entnahme", "ausgang", "auszahlung")),
    ("tax_in", ("steuer",)),
    ("fee_out", ("zins", "gebühr", "gebuehr", "entgelt", "spesen")),
    ("yield_in", ("ertrag", "div")),
)
# Second classifier of the reconciliation check: fees before taxes, and
# "div" only as a prefix.
FLOW_CLASS_RULES_ALT = (
    ("in", ("einlage", "eingang", "überweisung", "ueberweisung")),
    ("out", ("entnahme", "ausgang", "auszahlung")),
    ("fee_out", ("zins", "gebühr", "gebuehr", "entgelt", "spesen")),
    ("tax_in", ("steuer",)),
)
FLOW_CLASS_ALT_YIELD_CONTAINS = ("ertrag",)
FLOW_CLASS_ALT_YIELD_PREFIX = "div"

INFLOW_CLASSES = ("in",)
OUTFLOW_CLASSES = ("out", "fee_out")

# Segment names in decision order.
SEG_CLEANUP = "Bereinigen nötig"
SEG_INACTIVE = "Inaktiv"
SEG_REACTIVATED = "Reaktiviert"
SEG_WEALTHY = "Vermögend aktiv"
SEG_CASH_READY = "Cash-Ready"
SEG_TRADER = "Trader"
SEG_TECH = "Tech-Affin"
SEG_CAUTIOUS = "Vorsichtig"
SEG_DIY = "DIY-Sparer"
SEG_STANDARD = "Standard"

# Segments allowed to receive a call. The first entry is spelled without the
# umlaut, so depots of the segment "Vermögend aktiv" never match it; this is
# how the lead list has always behaved and is kept as the default.
ALLOWED_CALL_SEGMENTS = ("Vermoegend aktiv", "Cash-Ready", "Trader", "Reaktiviert", "Tech-Affin")

# Alert rules: code, text, severity.
ALERTS = (
    ("INAKTIV_90T", "Keine Trades seit > 90 Tagen bei relevantem Depotvolumen", "WARN"),
    ("CASH_40_NO_BUY_30D", "Hohe Cashquote (≥40%), aber keine Käufe in 30 Tagen", "INFO"),
    ("INFLOW_NO_BUY", "Hohe Einzahlung (≥5.000) ohne nachfolgenden Kauf", "WARN"),
    ("INFLOW_NO_BUY_REL", "Einzahlung ≥5% des Depotwerts ohne nachfolgenden Kauf", "WARN"),
    ("NETTO_ABFLUSS_30D", "Signifikanter Nettoabfluss in 30 Tagen", "WARN"),
    ("WERTLOS_BEREINIGEN", "Wertlose Position(en) vorhanden; Cash verfügbar – Depot bereinigen?", "INFO"),
    ("DEEPLOSS_ACTIVE", "Tiefe Verluste, aber zuletzt aktiv/Zufluss – gezielte Idee anbieten", "INFO"),
    ("REACTIVATED_CASHFLOW", "Nach Inaktivität wieder Cashflow in ≤7 Tagen", "INFO"),
    ("HOT_LEAD_SCORE", "Hohe Investitionsbereitschaft laut Score", "CRIT"),
)
ALERT_STATUS_OPEN = "offen"

# The rules as tables. A condition is a list of alternatives, an alternative a list of tests that must
# all hold, a test (measure, comparison, bound); a bound in words names another measure or a segment parameter.
# Measures are feature columns, with missing values as below, or the derived ones of ``operators.rules.measures``.
RULE_MISSING = {"Last_Buy_Days": 9999, "Last_Trade_Days": 9999, "Last_Cashflow_Days": 9999}  # 0 for all others

GENERAL_POINTS = (
    (8, (("Orderfrequenz_30d", ">=", 2),)),
    (6, (("Orderfrequenz_90d", ">=", 4),)),
    (2, (("ØOrdervolumen_90d", ">", 2000),)),
    (4, (("Cashquote_true", ">=", 0.25),)),
    (2, (("Cashquote_true", ">=", 0.50),)),
    (4, (("TechAffin", ">", 0),)),
    (-5, (("Wertlos_Flag", ">=", 1),)),
    (-4, (("Activity_Months_6m", "=", 0),)),
)
INVEST_POINTS = (
    (2, (("Cash_abs", ">=", 1000), ("Cashquote_true", ">=", 0.25))),
    (2, (("Cash_abs", ">=", 3000), ("Cashquote_true", ">=", 0.50))),
    (3, (("Einzahlung_30d_eff", ">", 0),)),
    (2, (("Inflow_Strength_30d", ">=", 0.02),)),
    (2, (("Last_Buy_Days", "<=", 30),)),
    (3, (("Last_Buy_Days", "<=", 14),)),
    (3, (("Orderfrequenz_30d", ">=", 2),)),
    (2, (("Orderfrequenz_90d", ">=", 4),)),
    (1, (("TechAffin", ">=", 1),)),
)
INVEST_MALUS = (
    (6, (("Activity_Months_6m", "=", 0), ("Last_Trade_Days", ">", 180), ("Einzahlung_90d", "=", 0), ("Cash_abs", "<", 100))),
    (5, (("Wertlos_Flag", ">=", 1),)),
    (3, (("DeepLossShare_50", ">=", 0.30),)),
    (2, (("WinLoss_Skew", "<=", -0.40),)),
    (4, (("Activity_Months_6m", "=", 0), ("Last_Cashflow_Days", ">", 60))),
    (2, (("Nettoflow_30d", "<", 0),)),
)
INVEST_RELIEF, INVEST_RELIEVED = 3, ((("Einzahlung_30d_eff", ">=", 500),), (("Last_Buy_Days", "<=", 14),))
WORTHLESS_IDLE, WORTHLESS_IDLE_CAP = (("Wertlos_Flag", ">=", 1), ("Activity_Months_6m", "=", 0)), 12
GENERAL_MAX, INVEST_MAX = 100, 20

# In the order of ALERTS.
ALERT_CONDITIONS = (
    ((("Last_Trade_Days", ">", 90), ("Depotwert", ">=", 1000)),),
    ((("Cashquote_true", ">=", 0.40), ("Last_Buy_Days", ">", 30), ("Cash_abs", ">=", 1000)),),
    ((("Einzahlung_30d_eff", ">=", 5000), ("Last_Buy_Days", ">", 20), ("Sparplan_Klein", "=", 0)),),
    ((("inflow_share", ">=", 0.05), ("Last_Buy_Days", ">", 20), ("Sparplan_Klein", "=", 0)),),
    ((("Nettoflow_30d", "<=", -2000),), (("netflow_share", "<=", -0.05),)),
    ((("Wertlos_Flag", "=", 1), ("Cash_abs", ">=", 500)),),
    ((("DeepLossShare_50", ">=", 0.30), ("Einzahlung_30d_eff", ">", 0)), (("DeepLossShare_50", ">=", 0.30), ("Last_Buy_Days", "<=", 14))),
    ((("Activity_Months_6m", "=", 0), ("Last_Cashflow_Days", "<=", 7)),),
    ((("InvestScore", ">=", 16), ("Cashquote_true", ">=", 0.25)),),
)

# The first segment whose condition holds; SEG_STANDARD if none does.
SEGMENT_CONDITIONS = (
    (SEG_CLEANUP, ((("Wertlos_Flag", "=", 1),), (("Depotwert", "<=", 1), ("Pos_Count", ">", 0)))),
    (SEG_INACTIVE, ((("Streak_Inactive_Months", ">=", "inactive_streak"),),
                    (("Orderfrequenz_90d", "=", 0), ("Orderfrequenz_30d", "=", 0), ("Last_Trade_Days", ">", "inactive_trade_days"), ("Einzahlung_90d", "=", 0)))),
    (SEG_REACTIVATED, ((("Activity_Months_6m", "<=", 1), ("Last_Cashflow_Days", "<=", 7)), (("Activity_Months_6m", "<=", 1), ("Einzahlung_30d_eff", ">", 0)))),
    (SEG_WEALTHY, ((("Depotwert", ">=", "wealth_cut"), ("ØOrdervolumen_90d", ">=", "vol_cut_90"), ("Last_Trade_Days", "<=", 60)),
                   (("Depotwert", ">=", "wealth_cut"), ("Orderfrequenz_90d", ">=", 4), ("Last_Trade_Days", "<=", 60)),
                   (("Depotwert", ">=", "wealth_cut"), ("Activity_Months_6m", ">=", 3)))),
    (SEG_CASH_READY, ((("cash_share", ">=", 0.40), ("Cash_abs", ">=", 1000), ("Last_Buy_Days", ">", 30)),
                      (("inflow_share", ">=", 0.05), ("Last_Buy_Days", ">", 20)))),
    (SEG_TRADER, ((("Orderfrequenz_90d", ">=", "trader_90d"), ("Last_Trade_Days", "<=", 60)),
                  (("Orderfrequenz_30d", ">=", "trader_30d"), ("Last_Trade_Days", "<=", 60)))),
    (SEG_TECH, ((("TechWeight", ">=", "tech_weight_min"), ("Activity_Months_6m", ">=", 2)),)),
    (SEG_CAUTIOUS, ((("DeepLossShare_50", ">=", "deeploss_high"),),
                    (("cash_share", ">", 0.70), ("Orderfrequenz_30d", "=", 0), ("Einzahlung_30d_eff", ">", 0)))),
    (SEG_DIY, ((("DIY_FrequentSmall", "=", 1),), (("Sparplan_Strength_6m", ">=", "saving_plan_min"),))),
)

# File catalog name prefixes (orders file "U", snapshot file "B").
FILE_PREFIX_ORDERS = "comdirect_U-"
FILE_PREFIX_SNAPSHOT = "comdirect_B-"

# Order types / statuses used by the label builders.
ORDER_TYPE_BUY = "Ankauf"
ORDER_EXEC_VALUES = ("EXECUTED", "FILLED", "AUSGEFÜHRT")
BOOKING_CREDIT_VALUES = ("Einzahlung", "Gutschrift")
TARGET_ISIN = "DE000A14UWW2"


# Feature columns that the schema audit does not expect in the stored table.
DERIVED_FEATURE_COLUMNS = ("Cash_over_bestand", "Cashquote_true", "Inflow_Strength_30d")


@dataclass(frozen=True)
class Vocabulary:
    """Words used to recognise tech securities and stock positions."""

    tech_names: tuple = TECH_NAMES
    etf_word: str = ETF_WORD
    etf_sector_words: tuple = ETF_SECTOR_WORDS
    stock_type: str = "AKTIE"
    internal_remark_pattern: str = INTERNAL_REMARK_PATTERN


# The synthetic part names are two generic words ("hot gear", "small ring").
FIXTURE_VOCAB = Vocabulary(tech_names=("GEAR", "GIZMO"), etf_word="small", etf_sector_words=("ring",))


@dataclass(frozen=True)
class FeatureParams:
    vocab: Vocabulary = field(default_factory=Vocabulary)
    small_saving_max: float = 1000.0      # a deposit below this is a savings-plan amount
    saving_plan_min_months: int = 3       # of the last 4 calendar months
    diy_min_orders_90d: int = 6
    diy_max_volume_90d: float = 2000.0
    streak_cap: int = 13                  # 12 months back + the current month
    never_days: int = 0                   # days-since value of "never bought/traded"
    no_cashflow_days: int = 9999


@dataclass(frozen=True)
class SegmentParams:
    inactive_trade_days: int = 180
    inactive_streak: int = 6
    trader_30d: int = 8
    trader_90d: int = 10
    tech_weight_min: float = 0.30
    deeploss_high: float = 0.30
    saving_plan_min: int = 3
    vol_quantile: float = 0.80
    vol_default: float = 5000.0
    wealth_quantile: float = 0.75
    wealth_min: float = 25000.0


@dataclass(frozen=True)
class LeadParams:
    call_quantile: float = 0.99
    min_calls: int = 60
    ready_cash_min: float = 1000.0
    ready_inflow_min: float = 300.0
    ready_last_buy_max: int = 21
    ready_recent_activity: int = 270
    enforce_segments: bool = True
    allowed_segments: tuple = ALLOWED_CALL_SEGMENTS


@dataclass(frozen=True)
class QcParams:
    rowcount_tol_pct: float = 2.0
    lead_min_rate: float = 5.0
    vol_q80_tol_pct: float = 30.0
    score_q80_tol_pct: float = 25.0
    cash_q80_tol_abs: float = 0.10


@dataclass(frozen=True)
class FirstBuyParams:
    isin: str = TARGET_ISIN
    min_ticket: float = 1000.0
    storno_margin_days: int = 60
    horizons: tuple = (7, 14, 30)
