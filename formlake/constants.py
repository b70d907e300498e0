"""Fixed values. These must equal the behaviour being matched, so they are kept
together, in plain text, in one place."""

# --- fixed values: scoring -------------------------------------------------------
C_SUITE_PATTERN = r"(?iU)\b(CEO|CFO|CHIEF EXECUTIVE|CHIEF FINANCIAL|PRESIDENT)\b"
ROLE_POINTS = 3
VALUE_MID_THRESHOLD = 100_000
VALUE_MID_POINTS = 2
BUY_HIGH_THRESHOLD = 500_000
SELL_HIGH_THRESHOLD = 1_000_000
VALUE_HIGH_POINTS = 3
CLUSTER_POINTS = 2
MIN_CONVICTION = 5

# enrichment: value bands (first match wins), cluster, fundamentals
ELITE_VALUE_BANDS = [(1_000_000, 5), (500_000, 3), (100_000, 1)]
ELITE_CLUSTER_POINTS = 3
PE_CHEAP_BELOW, PE_POINTS = 15, 2
DEBT_LOW_BELOW, DEBT_POINTS = 100, 1
DIP_DEEP_ABOVE, DIP_POINTS = 0.30, 2
MARGIN_POSITIVE_ABOVE, MARGIN_POINTS = 0, 1
DEFAULT_PE = 999.0
DEFAULT_PB = 999.0
DEFAULT_DEBT = 999.0
DEFAULT_DIP = 0.0
DEFAULT_MARGINS = -1.0
ELITE_MIN_SCORE = 10

# --- fixed values: serving ---------------------------------------------------------
ELITE_LIMIT = 50
SELL_ROLLUP_LIMIT = 100
EXPLORER_LIMIT = 500
EXPLORER_MIN_VALUE = 10_000
WHALE_DUMP_ABOVE = 1_000_000
REASON_C_SUITE = "👑 C-Suite"
REASON_WHALE = "📉 Whale Dump"
REASON_CLUSTER = "⚠️ Cluster (%d sellers)"
REASON_C_SUITE_SUBSTRINGS = ["CEO", "CFO"]
BUY_LABEL = "%s<br>Val: $%s"
SELL_LABEL = "%s ($%s)"

# --- fixed values: parsing ---------------------------------------------------------
UNKNOWN = "UNKNOWN"
DEFAULT_ACQUIRED_DISPOSED = "A"
TRADE_CODES = ["P", "S"]
TRUE_FLAGS = ["1", "true"]
# first <xml...> ... </xml> block; same match as the lazy form (?is)<xml.*?>(.*?)</xml>
XML_BLOCK_PATTERN = r"(?is)<xml[^>]*+>((?:[^<]+|<(?!/xml>))*+)</xml>"

# --- fixed values: index and download ----------------------------------------------
SEC_ARCHIVES = "https://www.sec.gov/Archives"
SEC_DATA_URL = "https://www.sec.gov/Archives/edgar/data"
DAILY_INDEX_URL = "%s/edgar/daily-index/%d/QTR%d/master.%s.idx"
INDEX_HEADER_MARKER = "CIK|Company Name"
FORM4_TYPES = ["4", "4/A"]
CALENDAR_START = "2026-01-01"

# --- fixed values: lake layout -----------------------------------------------------
TABLE_INDEX = "raw/form4_index"
TABLE_FILINGS = "raw/filings"
# a filing lands as a text or as a gzipped text; its name is that of the text
FILING_FILES, FILING_GZIP = "*.{txt,txt.gz}", ".gz"
TABLE_TRADES = "processed/trades"
TABLE_BUY_SIGNALS = "processed/gold_signals_buy"
TABLE_SELL_SIGNALS = "processed/gold_signals_sell"
TABLE_ENRICHED = "processed/enriched_signals"
TABLE_REJECTS = "processed/rejects"
TABLE_CLUSTERS = "processed/cluster_counts"
TABLE_ERRORS = "processed/errors"
TABLE_LANDED = "raw/landed_files"
PARTITION_COLUMN = "filing_date"
