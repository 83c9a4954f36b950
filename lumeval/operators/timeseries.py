"""Price-history summaries and batch tool requests.

Every statistic is a partial aggregate per (symbol, period), so a symbol
holding a third of all points is pre-reduced in the map tasks.  The last-n
points use ``row_number() <= n``, which Catalyst turns into a partial
WindowGroupLimit before the shuffle.  Lookup tables (one row per symbol)
are broadcast only behind a size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maps import kv as _kv

from .joins import broadcast_if_small

# The accepted history periods, in order.
VALID_PERIODS = ["1d", "5d", "1mo", "3mo", "6mo", "1y", "2y", "5y", "max"]
_PERIOD_INTERVAL = {"1d": "1 day", "5d": "5 days", "1mo": "1 month", "3mo": "3 months",
                    "6mo": "6 months", "1y": "1 year", "2y": "2 years", "5y": "5 years"}

# Vendor keys -> output names of the quote and the financials.
QUOTE_KEYS = [("current_price", "regularMarketPrice"), ("previous_close", "previousClose"),
              ("day_change", "regularMarketChange"),
              ("day_change_percent", "regularMarketChangePercent"),
              ("volume", "volume"), ("market_cap", "marketCap"), ("exchange", "exchange")]
FINANCIAL_KEYS = [
    ("company_name", "longName"), ("sector", "sector"), ("industry", "industry"),
    ("pe_ratio", "trailingPE"), ("forward_pe", "forwardPE"), ("peg_ratio", "pegRatio"),
    ("price_to_book", "priceToBook"), ("profit_margin", "profitMargins"),
    ("operating_margin", "operatingMargins"), ("return_on_equity", "returnOnEquity"),
    ("revenue", "totalRevenue"), ("revenue_growth", "revenueGrowth"),
    ("earnings_growth", "earningsGrowth"), ("dividend_yield", "dividendYield"),
    ("payout_ratio", "payoutRatio"), ("target_mean_price", "targetMeanPrice"),
    ("recommendation", "recommendationKey"), ("number_of_analysts", "numberOfAnalystOpinions"),
]
_TEXT_FINANCIALS = {"company_name", "sector", "industry", "recommendation"}


def _cutoff(period: str, last_ts):
    if period == "max":
        return None
    return last_ts - F.expr(f"INTERVAL {_PERIOD_INTERVAL[period]}")


def price_stats(prices: DataFrame, periods: Sequence[str] = ("5d", "1mo", "max")) -> DataFrame:
    """G8 per (symbol, period): points, first/last date and close, high,
    low, mean, total return %, rounded to 2.  A period counts back from the
    symbol's last point."""
    last = prices.groupBy("symbol").agg(F.max("ts").alias("_last"))
    p = prices.join(broadcast_if_small(last), "symbol")
    p = p.withColumn("period", F.explode(F.array(*[F.lit(x) for x in periods])))
    conds = None
    for x in periods:
        cut = _cutoff(x, F.col("_last"))
        c = (F.col("period") == x) & (F.lit(True) if cut is None else (F.col("ts") >= cut))
        conds = c if conds is None else (conds | c)
    p = p.filter(conds)
    g = p.groupBy("symbol", "period").agg(
        F.count(F.lit(1)).alias("data_points"),
        F.min("ts").alias("_t0"), F.max("ts").alias("_t1"),
        F.min_by("close", "ts").alias("_p0"), F.max_by("close", "ts").alias("_p1"),
        F.max("close").alias("_hi"), F.min("close").alias("_lo"),
        F.sum(F.col("close").cast("decimal(18,8)")).alias("_sum"))
    # the unrounded prices are summed exactly and the mean is rounded once, half
    # up: the same in any engine and any summation order (a float mean often
    # sits on a tie such as 44.795)
    avg = F.round(F.col("_sum") / F.col("data_points"), 2).cast("double")
    return g.select(
        "symbol", "period", "data_points",
        F.date_format("_t0", "yyyy-MM-dd").alias("start_date"),
        F.date_format("_t1", "yyyy-MM-dd").alias("end_date"),
        F.round("_p0", 2).alias("start_price"), F.round("_p1", 2).alias("end_price"),
        F.round("_hi", 2).alias("high"), F.round("_lo", 2).alias("low"),
        avg.alias("average"),
        F.round(F.try_divide(F.col("_p1") - F.col("_p0"), F.col("_p0")) * 100, 2).alias("total_return_percent"))


def recent_prices(prices: DataFrame, n: int = 5) -> DataFrame:
    """The last min(n, points) (date, close) per symbol, ``ord`` 1 = oldest."""
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    r = prices.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    w2 = Window.partitionBy("symbol").orderBy("ts")
    return r.select("symbol", F.row_number().over(w2).alias("ord"),
                    F.date_format("ts", "yyyy-MM-dd").alias("date"), F.round("close", 2).alias("close"))


def quote_info(prices: DataFrame) -> DataFrame:
    """Vendor-style quote record per symbol (string map) from its last two points."""
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    r = prices.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
    g = r.groupBy("symbol").agg(F.max(F.when(F.col("_rn") == 1, F.col("close"))).alias("_c"),
                                F.max(F.when(F.col("_rn") == 2, F.col("close"))).alias("_p"))
    vol = prices.groupBy("symbol").agg(F.count(F.lit(1)).alias("_v"))
    g = g.join(vol, "symbol")
    chg = F.col("_c") - F.col("_p")
    entries = F.array(
        _kv("regularMarketPrice", F.col("_c").cast("string")),
        _kv("previousClose", F.col("_p").cast("string")),
        _kv("regularMarketChange", chg.cast("string")),
        _kv("regularMarketChangePercent", (F.try_divide(chg, F.col("_p")) * 100).cast("string")),
        _kv("volume", F.col("_v").cast("string")),
        _kv("exchange", F.lit("SIM")))
    return g.select(F.col("symbol").cast("string").alias("symbol"),
                    F.map_from_entries(F.filter(entries, lambda e: e.getField("v").isNotNull())).alias("info"))


def quote_projection(info: DataFrame) -> DataFrame:
    """Renamed quote fields, upper-case symbol, currency defaults to USD."""
    cols = [F.upper("symbol").alias("symbol")]
    for out, key in QUOTE_KEYS:
        v = F.col("info").getItem(key)
        cols.append((v if out == "exchange" else v.cast("double")).alias(out))
    cols.append(F.coalesce(F.col("info").getItem("currency"), F.lit("USD")).alias("currency"))
    return info.select(*cols)


def financials_projection(info: DataFrame) -> DataFrame:
    """18 vendor keys renamed; absent keys read as null."""
    cols = [F.upper("symbol").alias("symbol")]
    for out, key in FINANCIAL_KEYS:
        v = F.col("info").getItem(key)
        cols.append((v if out in _TEXT_FINANCIALS else v.cast("double")).alias(out))
    return info.select(*cols)


def resolve_requests(requests: DataFrame, quotes: DataFrame, financials: DataFrame,
                     history: DataFrame) -> DataFrame:
    """one result row per (tool, symbol, period) request; unknown tool,
    unknown symbol, bad period and empty history give an error row."""
    q = broadcast_if_small(quotes.select(F.col("symbol").alias("_qs"), F.col("current_price").alias("_qv")))
    f = broadcast_if_small(financials.select(F.col("symbol").alias("_fs"), F.col("company_name").alias("_fn"),
                                             F.col("revenue").alias("_fv")))
    h = broadcast_if_small(history.select(F.col("symbol").cast("string").alias("_hs"),
                                          F.col("period").alias("_hp"),
                                          F.col("total_return_percent").alias("_hv"),
                                          F.col("data_points").alias("_hn")))
    t = F.col("tool")
    sym_u = F.upper("symbol")
    r = requests.join(q, (t == "get_stock_price") & (sym_u == F.col("_qs")), "left") \
        .join(f, (t == "get_company_financials") & (sym_u == F.col("_fs")), "left") \
        .join(h, (t == "get_price_history") & (F.col("symbol") == F.col("_hs")) & (F.col("period") == F.col("_hp")),
              "left")
    valid = F.col("period").isin(VALID_PERIODS)
    err = (F.when(~t.isin("get_stock_price", "get_company_financials", "get_price_history"),
                  F.concat(F.lit("Unknown tool: "), t))
           .when((t == "get_stock_price") & F.col("_qs").isNull(),
                 F.concat(F.lit("Could not find stock with symbol '"), F.col("symbol"), F.lit("'")))
           .when((t == "get_company_financials") & F.col("_fs").isNull(),
                 F.concat(F.lit("Could not find financials for symbol '"), F.col("symbol"), F.lit("'")))
           .when((t == "get_price_history") & ~valid,
                 F.concat(F.lit("Invalid period '"), F.col("period"),
                          F.lit("'. Must be one of: " + str(VALID_PERIODS))))
           .when((t == "get_price_history") & F.col("_hs").isNull(),
                 F.concat(F.lit("No historical data found for symbol '"), F.col("symbol"), F.lit("'"))))
    value = (F.when(t == "get_stock_price", F.col("_qv")).when(t == "get_company_financials", F.col("_fv"))
             .when(t == "get_price_history", F.col("_hv")))
    label = (F.when(t == "get_stock_price", sym_u).when(t == "get_company_financials", F.col("_fn"))
             .when(t == "get_price_history", F.concat(F.col("period"), F.lit(":"), F.col("_hn").cast("string"))))
    return r.select("request_id", "tool", "symbol", err.isNull().alias("ok"), err.alias("error"),
                    F.when(err.isNull(), value).alias("value"), F.when(err.isNull(), label).alias("label"))
