"""ANSI SQL (DuckDB) for every named query, over the driver's pre-registered tables.

Written independently of the Spark code: window counts instead of the join-back,
``NOT EXISTS`` instead of the anti join, literal strings instead of rendered texts.
"""

from __future__ import annotations

from formlake.plans.queries import EXAMPLE_AS_OF, EXAMPLE_ROOT, EXAMPLE_TICKER

RAW_TRADES = """
fx_raw_trades AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cik,
    lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-26-' || lpad(substr(p_brand, 7), 6, '0') AS accession_number,
    CAST(o_orderdate AS DATE) AS filing_date,
    upper(replace(p_brand, '#', '')) AS ticker,
    p_brand || ' Inc' AS company_name,
    c_name AS owner_name,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Chief Executive Officer' WHEN 'BUILDING' THEN 'EVP & CFO'
      WHEN 'FURNITURE' THEN 'Vice President' WHEN 'HOUSEHOLD' THEN 'Head of Sales' END AS owner_title,
    (c_custkey % 3 = 0) AS is_director,
    (c_mktsegment <> 'MACHINERY') AS is_officer,
    (c_acctbal > 9000) AS is_ten_percent_owner,
    CAST(l_shipdate AS DATE) AS transaction_date,
    CASE l_returnflag WHEN 'A' THEN 'P' WHEN 'R' THEN 'S' ELSE 'G' END AS transaction_code,
    l_quantity * 10 AS shares,
    l_extendedprice / l_quantity AS price_per_share,
    (l_quantity * 10) * (l_extendedprice / l_quantity) AS total_value,
    CASE l_returnflag WHEN 'A' THEN 'A' ELSE 'D' END AS acquired_disposed_code
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    JOIN customer ON o_custkey = c_custkey
),
fx_trades AS (SELECT * FROM fx_raw_trades WHERE transaction_code IN ('P', 'S'))"""

TRADE_COLS = (
    "cik, accession_number, filing_date, ticker, company_name, owner_name, owner_title, is_director, is_officer, "
    "is_ten_percent_owner, transaction_date, transaction_code, shares, price_per_share, total_value, acquired_disposed_code"
)
ROLE = r"CASE WHEN regexp_matches(owner_title, '(?i)\b(CEO|CFO|CHIEF EXECUTIVE|CHIEF FINANCIAL|PRESIDENT)\b') THEN 3 ELSE 0 END"


def _scored(name: str, code: str, high: int) -> str:
    return f"""
{name}_pre AS (
  SELECT {TRADE_COLS}, {ROLE} AS score_role,
    CASE WHEN total_value > 100000 THEN 2 ELSE 0 END AS score_value_mid,
    CASE WHEN total_value > {high} THEN 3 ELSE 0 END AS score_value_high,
    count(*) OVER (PARTITION BY ticker, filing_date) AS cluster_count
  FROM fx_trades WHERE transaction_code = '{code}'
),
{name} AS (
  SELECT {TRADE_COLS}, score_role, score_value_mid, score_value_high, cluster_count,
    CASE WHEN cluster_count > 1 THEN 2 ELSE 0 END AS score_cluster,
    score_role + score_value_mid + score_value_high + CASE WHEN cluster_count > 1 THEN 2 ELSE 0 END AS conviction_score
  FROM {name}_pre
)"""


SCORED = RAW_TRADES + "," + _scored("fx_scored_buy", "P", 500000) + "," + _scored("fx_scored_sell", "S", 1000000) + """,
fx_scored AS (SELECT * FROM fx_scored_buy UNION ALL SELECT * FROM fx_scored_sell),
fx_buy AS (SELECT * FROM fx_scored_buy WHERE conviction_score >= 5),
fx_sell AS (SELECT * FROM fx_scored_sell WHERE conviction_score >= 5)"""

FUNDAMENTALS = """
fx_fund_raw AS (
  SELECT ticker,
    CASE WHEN n % 6 <> 0 THEN CAST(100 - (n % 9) * 6 AS DOUBLE) END AS current_price,
    CASE WHEN n % 6 <> 0 THEN CAST(100 AS DOUBLE) END AS high_52w,
    CASE WHEN n % 6 <> 0 AND n % 5 <> 0 THEN CAST(n + 3 AS DOUBLE) END AS trailing_pe,
    CASE WHEN n % 6 <> 0 AND n % 7 <> 0 THEN CAST(n AS DOUBLE) / 10 END AS price_to_book,
    CASE WHEN n % 6 <> 0 THEN CAST(n AS DOUBLE) * 7.5 END AS debt_to_equity,
    CASE WHEN n % 6 <> 0 THEN CAST((n % 4) - 1 AS DOUBLE) / 10 END AS profit_margins, n
  FROM (SELECT DISTINCT upper(replace(p_brand, '#', '')) AS ticker, CAST(substr(p_brand, 7) AS INTEGER) AS n FROM part) b
),
fx_fund AS (
  SELECT ticker,
    coalesce(trailing_pe, 999.0) AS pe_ratio,
    coalesce(price_to_book, 999.0) AS pb_ratio,
    coalesce(debt_to_equity, 999.0) AS debt_to_equity,
    coalesce(profit_margins, -1.0) AS profit_margins,
    CASE WHEN high_52w > 0 AND current_price > 0 THEN (high_52w - current_price) / high_52w ELSE 0.0 END AS dip_from_52w_high
  FROM fx_fund_raw
)"""

ENRICHED = SCORED + "," + FUNDAMENTALS + f""",
fx_enriched_pre AS (
  SELECT b.*, coalesce(f.pe_ratio, 999.0) AS pe_ratio, f.pb_ratio,
    coalesce(f.debt_to_equity, 999.0) AS debt_to_equity, coalesce(f.profit_margins, -1.0) AS profit_margins,
    coalesce(f.dip_from_52w_high, 0.0) AS dip_from_52w_high
  FROM fx_buy b LEFT JOIN fx_fund f ON b.ticker = f.ticker
),
fx_enriched_sc AS (
  SELECT *,
    CASE WHEN total_value > 1000000 THEN 5 WHEN total_value > 500000 THEN 3 WHEN total_value > 100000 THEN 1 ELSE 0 END
      AS score_val_elite,
    CASE WHEN score_cluster > 0 THEN 3 ELSE 0 END AS score_cluster_elite,
    CASE WHEN pe_ratio < 15 THEN 2 ELSE 0 END AS f_score_pe,
    CASE WHEN debt_to_equity < 100 THEN 1 ELSE 0 END AS f_score_debt,
    CASE WHEN dip_from_52w_high > 0.30 THEN 2 ELSE 0 END AS f_score_dip,
    CASE WHEN profit_margins > 0 THEN 1 ELSE 0 END AS f_score_profit
  FROM fx_enriched_pre
),
fx_enriched AS (
  SELECT *, score_role + score_val_elite + score_cluster_elite + f_score_pe + f_score_debt + f_score_dip + f_score_profit
    AS ahab_score
  FROM fx_enriched_sc
)"""

INDEX_ROWS = """
fx_index AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS cik, c_name AS company_name,
    CASE o_orderstatus WHEN 'F' THEN '4' WHEN 'O' THEN '4/A' ELSE '10-K' END AS form_type,
    CAST(o_orderdate AS DATE) AS date_filed,
    'edgar/data/' || CAST(o_custkey AS VARCHAR) || '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-26-000001.txt'
      AS filename
  FROM orders JOIN customer ON o_custkey = c_custkey
),
fx_form4 AS (
  SELECT *, 'https://www.sec.gov/Archives' || filename AS file_url FROM fx_index WHERE form_type IN ('4', '4/A')
)"""

EXPLORER = RAW_TRADES + """,
fx_explorer AS (
  SELECT filing_date, transaction_date, ticker, owner_name, owner_title, transaction_code, price_per_share, total_value
  FROM fx_trades WHERE total_value >= 10000 {ticker_filter}
),
fx_explorer_top AS (
  SELECT * FROM fx_explorer
  ORDER BY transaction_date DESC NULLS LAST, filing_date ASC NULLS FIRST, ticker ASC NULLS FIRST,
    owner_name ASC NULLS FIRST, owner_title ASC NULLS FIRST, transaction_code ASC NULLS FIRST,
    price_per_share ASC NULLS FIRST, total_value ASC NULLS FIRST
  LIMIT 500
)"""

PRICES = """,
fx_prices AS (SELECT ticker, filing_date AS date, max(price_per_share) AS close FROM fx_trades GROUP BY ticker, filing_date)"""

AS_OF_START = "2000-08-01"  # twelve months before EXAMPLE_AS_OF
assert EXAMPLE_AS_OF == "2001-08-01"


# the lake queries file rows on the first of their month
MONTH = "CAST(date_trunc('month', filing_date) AS DATE) AS filing_date"


def _with(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


ORACLE_SQL: dict[str, str] = {
    "index_calendar": """
SELECT CAST(d AS DATE) AS date,
  'https://www.sec.gov/Archives/edgar/daily-index/' || CAST(year(d) AS VARCHAR) || '/QTR' || CAST(quarter(d) AS VARCHAR)
    || '/master.' || strftime(d, '%Y%m%d') || '.idx' AS url
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d
      FROM orders) s
WHERE isodow(d) <= 5""",
    "master_index": _with(INDEX_ROWS, "SELECT cik, company_name, form_type, date_filed, filename FROM fx_index"),
    "form4_index": _with(INDEX_ROWS, "SELECT * FROM fx_form4"),
    "download_plan": _with(
        INDEX_ROWS
        + f""",
fx_plan AS (
  SELECT cik, regexp_extract(filename, '([^/]*)$', 1) AS accession_txt,
    replace(replace(regexp_extract(filename, '([^/]*)$', 1), '-', ''), '.txt', '') AS accession_no_dashes,
    date_filed
  FROM fx_form4
),
fx_targets AS (
  SELECT cik, accession_txt, accession_no_dashes,
    'https://www.sec.gov/Archives/edgar/data/' || cik || '/' || accession_no_dashes || '/' || accession_txt AS canonical_url,
    '{EXAMPLE_ROOT}/raw/filings/' || strftime(date_filed, '%Y-%m-%d') || '/' || cik || '_' || accession_txt AS output_path
  FROM fx_plan
),
fx_landed AS (
  SELECT '{EXAMPLE_ROOT}/raw/filings/' || strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') || '/' || CAST(o_custkey AS VARCHAR)
    || '_' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-26-000001.txt' AS output_path
  FROM orders WHERE o_orderpriority = '1-URGENT'
)""",
        "SELECT * FROM fx_targets t WHERE NOT EXISTS (SELECT 1 FROM fx_landed l WHERE l.output_path = t.output_path)",
    ),
    "form4_counts": _with(
        INDEX_ROWS, "SELECT date_filed AS filing_date, count(*) AS form4_filings FROM fx_form4 GROUP BY date_filed"
    ),
    "parse_filings": _with(RAW_TRADES, f"SELECT {TRADE_COLS} FROM fx_trades"),
    "fundamentals": _with(FUNDAMENTALS, "SELECT * FROM fx_fund"),
    "price_history": _with(
        RAW_TRADES + PRICES,
        f"SELECT ticker, date, close FROM fx_prices WHERE date > DATE '{AS_OF_START}' AND date <= DATE '{EXAMPLE_AS_OF}'",
    ),
    "score_role": _with(SCORED, "SELECT accession_number, ticker, owner_title, transaction_code, score_role FROM fx_scored"),
    "score_value": _with(
        SCORED,
        "SELECT accession_number, ticker, transaction_code, total_value, score_value_mid, score_value_high FROM fx_scored",
    ),
    "cluster_count": _with(SCORED, "SELECT ticker, filing_date, transaction_code, cluster_count FROM fx_scored"),
    "score_cluster": _with(SCORED, "SELECT ticker, filing_date, transaction_code, cluster_count, score_cluster FROM fx_scored"),
    "conviction_score": _with(
        SCORED,
        "SELECT accession_number, ticker, filing_date, transaction_code, total_value, conviction_score FROM fx_scored",
    ),
    "buy_signals": _with(SCORED, "SELECT * FROM fx_buy"),
    "sell_signals": _with(SCORED, "SELECT * FROM fx_sell"),
    "signal_counts": _with(
        SCORED,
        """
SELECT filing_date,
  count(*) FILTER (WHERE kind IN ('P', 'S')) AS trades,
  count(*) FILTER (WHERE kind = 'P') AS buys,
  count(*) FILTER (WHERE kind = 'buy_signal') AS buy_signals,
  count(*) FILTER (WHERE kind = 'S') AS sells,
  count(*) FILTER (WHERE kind = 'sell_signal') AS sell_signals
FROM (SELECT filing_date, transaction_code AS kind FROM fx_trades
      UNION ALL SELECT filing_date, 'buy_signal' FROM fx_buy
      UNION ALL SELECT filing_date, 'sell_signal' FROM fx_sell) u
GROUP BY filing_date""",
    ),
    "enriched_signals": _with(ENRICHED, "SELECT * FROM fx_enriched"),
    "elite_count": _with(
        ENRICHED,
        "SELECT filing_date, count(*) AS signals, count(*) FILTER (WHERE ahab_score >= 10) AS elite_signals "
        "FROM fx_enriched GROUP BY filing_date",
    ),
    "elite_buys": _with(
        ENRICHED,
        """
SELECT filing_date, ticker, owner_name, owner_title, total_value, ahab_score, pe_ratio,
  CAST(round_even(dip_from_52w_high * 100, 1) AS VARCHAR) || '%' AS dip_from_52w_high, cluster_count
FROM (
  SELECT filing_date, ticker, owner_name, owner_title, total_value, ahab_score, pe_ratio, dip_from_52w_high, cluster_count
  FROM fx_enriched WHERE ahab_score >= 10
  ORDER BY filing_date DESC NULLS LAST, ahab_score DESC NULLS LAST, ticker ASC NULLS FIRST, owner_name ASC NULLS FIRST,
    owner_title ASC NULLS FIRST, total_value ASC NULLS FIRST, pe_ratio ASC NULLS FIRST,
    dip_from_52w_high ASC NULLS FIRST, cluster_count ASC NULLS FIRST
  LIMIT 50
) t""",
    ),
    "sell_rollup": _with(
        SCORED
        + """,
fx_groups AS (
  SELECT filing_date, ticker, company_name, owner_name, owner_title,
    max(conviction_score) AS conviction_score, max(cluster_count) AS cluster_size,
    sum(total_value) AS raw_total, round(sum(total_value), 2) AS total_value_aggregated, sum(shares) AS total_shares,
    count(*) AS num_transactions
  FROM fx_sell GROUP BY filing_date, ticker, company_name, owner_name, owner_title
),
fx_shown AS (
  SELECT filing_date, ticker, company_name, owner_name, owner_title, conviction_score, cluster_size,
    total_value_aggregated, total_shares, num_transactions, total_value_aggregated / NULLIF(total_shares, 0) AS avg_price,
    concat_ws(', ',
      CASE WHEN upper(owner_title) LIKE '%CEO%' OR upper(owner_title) LIKE '%CFO%' THEN '👑 C-Suite' END,
      CASE WHEN raw_total > 1000000 THEN '📉 Whale Dump' END,
      CASE WHEN cluster_size > 1 THEN '⚠️ Cluster (' || CAST(cluster_size AS VARCHAR) || ' sellers)' END) AS signal_context
  FROM fx_groups WHERE raw_total > 0
)""",
        """
SELECT * FROM fx_shown
ORDER BY filing_date DESC NULLS LAST, conviction_score DESC NULLS LAST, ticker ASC NULLS FIRST,
  company_name ASC NULLS FIRST, owner_name ASC NULLS FIRST, owner_title ASC NULLS FIRST, cluster_size ASC NULLS FIRST,
  total_value_aggregated ASC NULLS FIRST, total_shares ASC NULLS FIRST, num_transactions ASC NULLS FIRST,
  avg_price ASC NULLS FIRST
LIMIT 100""",
    ),
    "trade_explorer": _with(EXPLORER.format(ticker_filter=""), "SELECT * FROM fx_explorer_top"),
    "explorer_metrics": _with(
        EXPLORER.format(ticker_filter=""),
        "SELECT count(*) AS visible_trades, round(sum(total_value), 2) / count(*) AS avg_trade_size FROM fx_explorer",
    ),
    "net_volume": _with(
        EXPLORER.format(ticker_filter=""),
        """
SELECT transaction_date, transaction_code,
  round(sum(CASE WHEN transaction_code = 'P' THEN total_value ELSE -total_value END), 2) AS plot_value
FROM fx_explorer GROUP BY transaction_date, transaction_code""",
    ),
    "price_overlay": _with(
        EXPLORER.format(ticker_filter=f"AND ticker = '{EXAMPLE_TICKER}'") + PRICES,
        f"""
SELECT 'price' AS series, date, close AS value, CAST(NULL AS VARCHAR) AS label
FROM fx_prices WHERE ticker = '{EXAMPLE_TICKER}' AND date > DATE '{AS_OF_START}' AND date <= DATE '{EXAMPLE_AS_OF}'
UNION ALL
SELECT 'buy', transaction_date, price_per_share, owner_name || '<br>Val: $' || format('{{:,.0f}}', total_value)
FROM fx_explorer WHERE transaction_code = 'P'
UNION ALL
SELECT 'sell', transaction_date, price_per_share, owner_name || ' ($' || format('{{:,.0f}}', total_value) || ')'
FROM fx_explorer WHERE transaction_code = 'S'""",
    ),
    "parse_rejects": _with(
        RAW_TRADES,
        """
SELECT CASE WHEN substr(md5(cik || '_' || accession_number || '.txt'), 1, 1) IN ('0', '3', '6', '9', 'c', 'f') THEN 'rejected' ELSE 'read' END AS state,
  accession_number, ticker, transaction_date, transaction_code, shares, price_per_share
FROM fx_trades""",
    ),
    "fundamentals_as_of": _with(
        RAW_TRADES + "," + FUNDAMENTALS + """,
fx_span AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
fx_history AS (
  SELECT f.* REPLACE (trailing_pe + 50 AS trailing_pe), lo AS as_of FROM fx_fund_raw f, fx_span WHERE n % 4 <> 3
  UNION ALL SELECT f.*, lo + CAST(floor((hi - lo) / 2) AS INTEGER) FROM fx_fund_raw f, fx_span
),
fx_met AS (
  SELECT d.filing_date, h.*, row_number() OVER (PARTITION BY d.ticker, d.filing_date ORDER BY h.as_of DESC) AS k
  FROM (SELECT DISTINCT ticker, filing_date FROM fx_trades) d JOIN fx_history h ON h.ticker = d.ticker AND h.as_of <= d.filing_date
)""",
        """
SELECT ticker, filing_date, coalesce(trailing_pe, 999.0) AS pe_ratio, coalesce(price_to_book, 999.0) AS pb_ratio,
  coalesce(debt_to_equity, 999.0) AS debt_to_equity, coalesce(profit_margins, -1.0) AS profit_margins,
  CASE WHEN high_52w > 0 AND current_price > 0 THEN (high_52w - current_price) / high_52w ELSE 0.0 END AS dip_from_52w_high
FROM fx_met WHERE k = 1""",
    ),
    "trade_display": _with(
        RAW_TRADES,
        """
SELECT accession_number, ticker, transaction_date, transaction_code,
  '$' || format('{:.2f}', floor(price_per_share * 8) / 8) AS price_per_share,
  '$' || format('{:,.0f}', total_value) AS total_value,
  format('{:.1f}', floor(total_value / 1000) / 4) AS ratio
FROM fx_trades""",
    ),
    "scan_filings": """
SELECT 'day_' || strftime(day, '%Y%m%d') || '_' || CAST(part AS VARCHAR) || '.txt' AS file_name, day AS filing_date,
  CAST(length(content) AS BIGINT) AS n_chars, md5(content) AS md5
FROM (SELECT day, o_orderkey % parts AS part,
        string_agg(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR), chr(10) ORDER BY o_orderkey) AS content
      FROM (SELECT *, CAST(ceil(count(*) OVER (PARTITION BY day) / 2000.0) AS BIGINT) AS parts
            FROM (SELECT *, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS day FROM orders) o) p
      GROUP BY 1, 2) d""",
    "scan_trades": _with(RAW_TRADES, f"SELECT {TRADE_COLS.replace('filing_date', MONTH)} FROM fx_trades"),
    "scan_signals": _with(SCORED, f"SELECT * REPLACE ({MONTH}) FROM fx_sell"),
    "write_partitioned": _with(
        RAW_TRADES,
        """
SELECT CAST(date_trunc('month', filing_date) AS DATE) AS filing_date, transaction_code, count(*) AS trades, sum(shares) AS shares
FROM fx_trades WHERE month(filing_date) % 2 = 0 OR transaction_code = 'S' GROUP BY 1, 2""",
    ),
    "run_dates": _with(
        RAW_TRADES + "," + INDEX_ROWS + """,
fx_month AS (SELECT * REPLACE (CAST(date_trunc('month', filing_date) AS DATE) AS filing_date) FROM fx_trades),
fx_day AS (
  SELECT filing_date, transaction_code AS code, total_value,
    CASE WHEN month(filing_date) % 2 = 0 THEN 3 ELSE 0 END + CASE WHEN total_value > 100000 THEN 2 ELSE 0 END
      + CASE WHEN total_value > CASE transaction_code WHEN 'P' THEN 500000 ELSE 1000000 END THEN 3 ELSE 0 END
      + CASE WHEN count(*) OVER (PARTITION BY filing_date, transaction_code) > 1 THEN 2 ELSE 0 END AS score
  FROM fx_month
)""",
        """
SELECT filing_date, stored, count(*) AS n FROM (
  SELECT filing_date, 'trades' AS stored FROM fx_day
  UNION ALL SELECT filing_date, CASE code WHEN 'P' THEN 'buy_signals' ELSE 'sell_signals' END FROM fx_day WHERE score >= 5
  UNION ALL SELECT CAST(date_trunc('month', date_filed) AS DATE), 'form4_filings' FROM fx_form4
) u GROUP BY filing_date, stored""",
    ),
    "table_preview": _with(
        RAW_TRADES,
        f"""
SELECT {TRADE_COLS.replace("filing_date", MONTH)}, (SELECT count(*) FROM fx_trades) AS row_count FROM fx_trades
ORDER BY cik, accession_number, date_trunc('month', filing_date), ticker, transaction_date, transaction_code, shares, price_per_share
LIMIT 10""",
    ),
    "projected_price": "SELECT upper(replace(p_brand, '#', '')) AS ticker, p_retailprice * 1.1 AS projected_price FROM part",
}
