"""Fixed schemas of every table the library reads or writes.

Operators declare their output types, so an empty day keeps the full schema.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, B, F, I, L = T.StringType(), T.DateType(), T.BooleanType(), T.DoubleType(), T.IntegerType(), T.LongType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# one row per open-market trade (purchase P / sale S)
TRADES = _struct(
    ("cik", S, False),
    ("accession_number", S, False),
    ("filing_date", D, False),
    ("ticker", S, False),
    ("company_name", S, False),
    ("owner_name", S, False),
    ("owner_title", S, True),
    ("is_director", B, False),
    ("is_officer", B, False),
    ("is_ten_percent_owner", B, False),
    ("transaction_date", D, False),
    ("transaction_code", S, False),
    ("shares", F, False),
    ("price_per_share", F, False),
    ("total_value", F, False),
    ("acquired_disposed_code", S, False),
)
TRADE_COLUMNS = TRADES.fieldNames()

SIGNAL_SCORE_COLUMNS = [
    "score_role",
    "score_value_mid",
    "score_value_high",
    "cluster_count",
    "score_cluster",
    "conviction_score",
]
SIGNALS = T.StructType(
    TRADES.fields
    + [
        T.StructField("score_role", I, False),
        T.StructField("score_value_mid", I, False),
        T.StructField("score_value_high", I, False),
        T.StructField("cluster_count", L, True),
        T.StructField("score_cluster", I, False),
        T.StructField("conviction_score", I, False),
    ]
)

# raw company fundamentals snapshot, one or more rows per ticker (optional as_of)
FUNDAMENTALS_RAW = _struct(
    ("ticker", S, True),
    ("current_price", F, True),
    ("high_52w", F, True),
    ("trailing_pe", F, True),
    ("price_to_book", F, True),
    ("debt_to_equity", F, True),
    ("profit_margins", F, True),
)

FUNDAMENTAL_COLUMNS = ["pe_ratio", "pb_ratio", "debt_to_equity", "profit_margins", "dip_from_52w_high"]
FUNDAMENTALS = _struct(("ticker", S, True), *[(c, F, True) for c in FUNDAMENTAL_COLUMNS])

ENRICH_SCORE_COLUMNS = [
    "score_val_elite",
    "score_cluster_elite",
    "f_score_pe",
    "f_score_debt",
    "f_score_dip",
    "f_score_profit",
    "ahab_score",
]
ENRICHED = T.StructType(
    SIGNALS.fields
    + [T.StructField(c, F, True) for c in FUNDAMENTAL_COLUMNS]
    + [T.StructField(c, I, False) for c in ENRICH_SCORE_COLUMNS]
)

INDEX_COLUMNS = ["cik", "company_name", "form_type", "date_filed", "filename"]
INDEX_TEXT_FIELDS = "cik STRING, company_name STRING, form_type STRING, date_filed STRING, filename STRING"
INDEX = _struct(
    ("cik", S, True),
    ("company_name", S, True),
    ("form_type", S, True),
    ("date_filed", D, True),
    ("filename", S, True),
)
FORM4_INDEX = T.StructType(INDEX.fields + [T.StructField("file_url", S, True)])

# kept beside the trades by the daily batch: rows per cluster, what could not be read, what has landed
CLUSTER_COUNTS = _struct(("filing_date", D, True), ("ticker", S, True), ("transaction_code", S, True), ("cluster_count", L, True))
ERRORS = _struct(("filing_date", D, True), ("step", S, True), ("source", S, True), ("detail", S, True))
LANDED = _struct(("filing_date", D, True), ("relative_path", S, True), ("folder_time", L, True))

PRICES = _struct(("ticker", S, True), ("date", D, True), ("close", F, True))
OVERLAY = _struct(("series", S, False), ("date", D, True), ("value", F, True), ("label", S, True))

FILINGS = _struct(("path", S, True), ("file_name", S, True), ("filing_date", D, True), ("content", S, True))

# the parts of an ownership document (public Form 4 layout) that trades are cut from
_VALUE = _struct(("value", S, True))
_OWNER = T.StructType(
    [
        T.StructField("reportingOwnerId", _struct(("rptOwnerCik", S, True), ("rptOwnerName", S, True))),
        T.StructField(
            "reportingOwnerRelationship",
            _struct(
                ("isDirector", S, True),
                ("isOfficer", S, True),
                ("isTenPercentOwner", S, True),
                ("officerTitle", S, True),
            ),
        ),
    ]
)
_TRANSACTION = T.StructType(
    [
        T.StructField("transactionDate", _VALUE),
        T.StructField("transactionCoding", _struct(("transactionCode", S, True))),
        T.StructField(
            "transactionAmounts",
            T.StructType(
                [
                    T.StructField("transactionShares", _VALUE),
                    T.StructField("transactionPricePerShare", _VALUE),
                    T.StructField("transactionAcquiredDisposedCode", _VALUE),
                ]
            ),
        ),
    ]
)
OWNERSHIP_DOCUMENT = T.StructType(
    [
        T.StructField("issuer", _struct(("issuerName", S, True), ("issuerTradingSymbol", S, True))),
        T.StructField("reportingOwner", T.ArrayType(_OWNER)),
        T.StructField("nonDerivativeTable", T.StructType([T.StructField("nonDerivativeTransaction", T.ArrayType(_TRANSACTION))])),
        T.StructField("_corrupt_record", S, True),
    ]
)
