"""Inputs derived from the driver's TPC-H-like tables (see FIXTURES.md).

Each derivation is a DataFrame plan over the given tables, so its size grows with them.
One filing = one (order, brand); the owner is the order's customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formlake.operators.joins import lookup_join
from formlake.schemas import TRADE_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_ticker(brand: Column) -> Column:
    return F.upper(F.replace(brand, F.lit("#"), F.lit("")))


def brand_number(brand: Column) -> Column:
    return F.substring(brand, 7, 1 << 20)


def raw_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a trade row, including codes the parser must drop ('G')."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    # the customers are joined to the orders: a line item is shuffled once less than order by order
    owned = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    joined = li.join(part, F.col("l_partkey") == F.col("p_partkey")).join(owned, F.col("l_orderkey") == F.col("o_orderkey"))
    shares = F.col("l_quantity") * 10
    price = F.col("l_extendedprice") / F.col("l_quantity")
    title = (
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", "Chief Executive Officer")
        .when(F.col("c_mktsegment") == "BUILDING", "EVP & CFO")
        .when(F.col("c_mktsegment") == "FURNITURE", "Vice President")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "Head of Sales")
    )
    flag = F.col("l_returnflag")
    return joined.select(
        F.col("c_custkey").cast("string").alias("cik"),
        F.concat(
            F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
            F.lit("-26-"),
            F.lpad(brand_number(F.col("p_brand")), 6, "0"),
        ).alias("accession_number"),
        F.col("o_orderdate").cast("date").alias("filing_date"),
        brand_ticker(F.col("p_brand")).alias("ticker"),
        F.concat(F.col("p_brand"), F.lit(" Inc")).alias("company_name"),
        F.col("c_name").alias("owner_name"),
        title.alias("owner_title"),
        (F.col("c_custkey") % 3 == 0).alias("is_director"),
        (F.col("c_mktsegment") != "MACHINERY").alias("is_officer"),
        (F.col("c_acctbal") > 9000).alias("is_ten_percent_owner"),
        F.col("l_shipdate").cast("date").alias("transaction_date"),
        F.when(flag == "A", "P").when(flag == "R", "S").otherwise("G").alias("transaction_code"),
        shares.alias("shares"),
        price.alias("price_per_share"),
        (shares * price).alias("total_value"),
        F.when(flag == "A", "A").otherwise("D").alias("acquired_disposed_code"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trades(spark, sf_dir).filter(F.col("transaction_code").isin("P", "S")).select(*TRADE_COLUMNS)


def fundamentals_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot row per brand ticker; tickers with ``n % 6 = 0`` have a row of nulls, others some."""
    part = table(spark, sf_dir, "part").select("p_brand")
    brands = part.select(
        brand_ticker(F.col("p_brand")).alias("ticker"),
        brand_number(F.col("p_brand")).cast("int").alias("n"),
    ).distinct()
    n = F.col("n")
    known = n % 6 != 0
    return brands.select(
        "ticker",
        F.when(known, (F.lit(100) - (n % 9) * 6).cast("double")).alias("current_price"),
        F.when(known, F.lit(100.0)).alias("high_52w"),
        F.when(known & (n % 5 != 0), (n + 3).cast("double")).alias("trailing_pe"),
        F.when(known & (n % 7 != 0), n.cast("double") / 10).alias("price_to_book"),
        F.when(known, n.cast("double") * 7.5).alias("debt_to_equity"),
        F.when(known, ((n % 4) - 1).cast("double") / 10).alias("profit_margins"),
    )


def fundamentals_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots per ticker: one from the start of the orders with a higher P/E, one from
    the middle; tickers with ``n % 4 = 3`` have the later one only."""
    lo, hi = table(spark, sf_dir, "orders").agg(F.min("o_orderdate").cast("date"), F.max("o_orderdate").cast("date")).first()
    now = fundamentals_raw(spark, sf_dir)
    late = now.withColumn("as_of", F.lit(lo + (hi - lo) // 2))
    early = now.withColumn("as_of", F.lit(lo)).withColumn("trailing_pe", F.col("trailing_pe") + 50)
    early = early.filter(F.regexp_extract("ticker", r"(\d+)$", 1).cast("int") % 4 != 3)
    return early.unionByName(late)


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily close per ticker: the highest trade price of the day."""
    return (
        trades(spark, sf_dir)
        .groupBy("ticker", F.col("filing_date").alias("date"))
        .agg(F.max("price_per_share").alias("close"))
    )


def index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-index rows: one per order; form type from the order status."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    status = F.col("o_orderstatus")
    return (
        orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").cast("string").alias("cik"),
            F.col("c_name").alias("company_name"),
            F.when(status == "F", "4").when(status == "O", "4/A").otherwise("10-K").alias("form_type"),
            F.col("o_orderdate").cast("date").alias("date_filed"),
            F.concat(
                F.lit("edgar/data/"),
                F.col("o_custkey").cast("string"),
                F.lit("/"),
                F.lpad(F.col("o_orderkey").cast("string"), 10, "0"),
                F.lit("-26-000001.txt"),
            ).alias("filename"),
        )
        .distinct()
    )


def landed_files(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """Target paths of filings already on disk: those of the urgent orders."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    accession = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-26-000001.txt"))
    return orders.select(
        F.concat(
            F.lit(root.rstrip("/") + "/raw/filings/"),
            F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd"),
            F.lit("/"),
            F.col("o_custkey").cast("string"),
            F.lit("_"),
            accession,
        ).alias("output_path")
    )


def parts_per_day(rows: DataFrame, day: str, rows_per_part: int) -> DataFrame:
    """``rows`` plus ``parts``: into how many parts of about ``rows_per_part`` rows their day is cut."""
    parts = F.ceil(F.count(F.lit(1)) / F.lit(rows_per_part)).cast("long").alias("parts")
    return lookup_join(rows, rows.groupBy(day).agg(parts), [day])


def day_filings(raw: DataFrame, rows_per_filing: int = 200) -> DataFrame:
    """The rows of ``raw`` as transactions of filings of about ``rows_per_filing`` rows each, whose
    header depends on the filing day: whole orders are dealt to a day's filings by a hash."""
    day, month = F.col("filing_date"), F.month("filing_date")
    part = F.pmod(F.xxhash64(F.substring_index("accession_number", "-", 1)), F.col("parts"))
    head = {
        "accession_number": F.concat(F.date_format(day, "yyyyMMdd"), F.lit("-26-"), F.lpad(part.cast("string"), 6, "0")),
        "cik": F.date_format(day, "yyyyMMdd"),
        "ticker": F.concat(F.lit("WD"), F.weekday(day).cast("string")),
        "company_name": F.lit("Day Inc"),
        "owner_name": F.concat(F.lit("Owner "), month.cast("string")),
        "owner_title": F.when(month % 2 == 0, F.lit("CFO")).otherwise(F.lit("Clerk")),
        "is_director": F.lit(False),
        "is_officer": F.lit(True),
        "is_ten_percent_owner": F.lit(False),
    }
    return parts_per_day(raw, "filing_date", rows_per_filing).withColumns(head).drop("parts")


def day_files(spark: SparkSession, sf_dir: str, rows_per_text: int = 2000) -> DataFrame:
    """Text files of about ``rows_per_text`` orders of one month, dated its first day: one line
    each, in order; an order's key chooses its file."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    orders = orders.withColumn("filing_date", F.trunc(F.col("o_orderdate").cast("date"), "MM"))
    dealt = parts_per_day(orders, "filing_date", rows_per_text)
    name = F.concat(F.lit("day_"), F.date_format("filing_date", "yyyyMMdd"), F.lit("_"), F.col("part").cast("string"), F.lit(".txt"))
    return (
        dealt.groupBy("filing_date", (F.col("o_orderkey") % F.col("parts")).alias("part"))
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("line")))), lambda x: x["line"]), "\n").alias("content"))
        .select("filing_date", name.alias("file_name"), "content")
    )


def smoke_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(ticker, price, is_tech) rows: each part's brand ticker and retail price."""
    part = table(spark, sf_dir, "part").select("p_brand", "p_retailprice", "p_type")
    return part.select(
        brand_ticker(F.col("p_brand")).alias("ticker"),
        F.col("p_retailprice").alias("price"),
        F.col("p_type").contains("BRASS").alias("is_tech"),
    )
