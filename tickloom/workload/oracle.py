"""SQL for every registered query, over the same test tables.

Derived tables and intermediate results are named fragments; a query names
the ones it starts from and gets them, with what they need, as a WITH clause.
"""

from __future__ import annotations

from tickloom import constants as K

FRAGMENTS: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLE: dict[str, str] = {}

WINDOWS = K.MA_WINDOWS


def fragment(name: str, sql: str, *needs: str) -> None:
    FRAGMENTS[name] = (needs, sql)


def oracle(name: str, sql: str, *needs: str) -> None:
    ORACLE[name] = with_fragments(sql, needs)


def with_fragments(sql: str, needs: tuple[str, ...]) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in FRAGMENTS[name][0]:
            visit(other)
        ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return sql
    parts = [f"{name} AS ({FRAGMENTS[name][1]})" for name in ordered]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + sql


def r(expression: str, name: str | None = None, digits: int = 6) -> str:
    """A rounded number; HAIR keeps exact halves from being rounded either way."""
    return f"round({expression} + {K.HAIR}::DOUBLE, {digits}) + 0.0 AS {name or expression}"


def rs(*names: str, digits: int = 6) -> str:
    return ", ".join(r(n, digits=digits) for n in names)


def pick(key: str, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CAST(CASE {key} % {len(values)} {whens} END AS DOUBLE)"


def ticker(key: str) -> str:
    return f"'T' || lpad(CAST({key} AS VARCHAR), {K.TICKER_DIGITS}, '0')"


def category(cap: str) -> str:
    whens = " ".join(f"WHEN {cap} >= {bound} THEN '{name}'" for name, bound in K.CAP_CATEGORIES)
    return f"CASE {whens} ELSE '{K.SMALLEST_CAP_CATEGORY}' END"


def score(value: str) -> str:
    whens = " ".join(f"WHEN {value} >= {bound} THEN {points}" for points, bound in K.LIQUIDITY_SCORES)
    return f"CASE {whens} ELSE {K.LOWEST_LIQUIDITY_SCORE} END"


# ---------------------------------------------------------------- raw tables

fragment(
    "keyed_bars",
    f"""
    SELECT key, {ticker('key')} AS ticker, date, open, high, low, close, transactions,
           quantity * {pick('key', '100000', '10000', '1000', '100')} AS volume
    FROM (
        SELECT l_suppkey AS key, CAST(l_shipdate AS DATE) AS date,
               arg_min(l_extendedprice / l_quantity / 100, place) AS open,
               max(l_extendedprice / l_quantity / 100) AS high,
               min(l_extendedprice / l_quantity / 100) AS low,
               arg_max(l_extendedprice / l_quantity / 100, place) AS close,
               sum(l_quantity) AS quantity, count(*) AS transactions
        FROM (SELECT *, row(l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS place FROM lineitem)
        GROUP BY 1, 2)
    """,
)
BAR = "ticker, volume, open, close, high, low, date, transactions"
fragment("clean_bars", f"SELECT {BAR} FROM keyed_bars", "keyed_bars")
fragment(
    "raw_bars",
    """
    SELECT ticker, CASE WHEN (key + dayofyear(date)) % 29 = 0 THEN 0.0::DOUBLE ELSE volume END AS volume,
           open, close, high, low, date,
           CASE WHEN (key + dayofyear(date)) % 31 <> 0 THEN transactions END AS transactions
    FROM keyed_bars
    """,
    "keyed_bars",
)
fragment(
    "dirty_bars",
    """
    SELECT CASE WHEN mark % 101 <> 0 THEN ticker END AS ticker,
           CASE WHEN mark % 29 = 0 THEN 0.0::DOUBLE ELSE volume END AS volume,
           CASE WHEN mark % 37 = 0 THEN high + 1 WHEN mark % 43 = 0 THEN (-1.0)::DOUBLE ELSE open END AS open,
           CASE WHEN mark % 41 = 0 THEN low - 1 WHEN mark % 59 <> 0 THEN close END AS close,
           CASE WHEN mark % 47 = 0 THEN low - 2 ELSE high END AS high,
           low,
           CASE WHEN mark % 53 <> 0 THEN date END AS date,
           CASE WHEN mark % 61 = 0 THEN 0 ELSE transactions END AS transactions
    FROM (SELECT *, key * 3 + dayofyear(date) AS mark FROM keyed_bars)
    """,
    "keyed_bars",
)
fragment(
    "raw_tickers",
    f"""
    SELECT {ticker('s_suppkey')} AS ticker, s_name AS name, 'stocks' AS market, 'CS' AS type, true AS active
    FROM supplier
    UNION ALL SELECT {ticker('s_suppkey')}, s_name || ' again', 'stocks', 'CS', false FROM supplier WHERE s_suppkey % 10 = 0
    UNION ALL SELECT {ticker('s_suppkey')} || '.X', s_name, 'otc', 'CS', true FROM supplier WHERE s_suppkey % 7 = 0
    UNION ALL SELECT {ticker('s_suppkey')} || '.U', s_name, 'stocks', NULL, true FROM supplier WHERE s_suppkey % 11 = 0
    """,
)
fragment(
    "raw_details",
    f"""
    SELECT {ticker('s_suppkey')} AS ticker, 'CS' AS type,
           {pick('s_suppkey', '3e11', '5e10', '5e9', '1e9', '1e8', 'NULL')} + s_acctbal * 1e4::DOUBLE AS market_cap,
           CASE WHEN s_suppkey % 17 <> 16 THEN CAST(s_nationkey AS VARCHAR) END AS sic_code,
           n_name AS sic_description,
           'icon/' || s_suppkey AS branding_icon_url, 'logo/' || s_suppkey AS branding_logo_url,
           CAST(s_suppkey % 1000 * 10 AS INTEGER) AS total_employees, s_name AS name,
           s_suppkey * 1000 AS share_class_shares_outstanding, s_suppkey * 900 AS weighted_shares_outstanding,
           'X' || (s_suppkey % 3) AS primary_exchange
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
fragment(
    "sic_codes",
    "SELECT n_nationkey AS code, r_name AS office, n_name AS industry FROM nation JOIN region ON n_regionkey = r_regionkey",
)
fragment(
    "raw_splits",
    f"""
    SELECT {ticker('s_suppkey')} AS ticker, 1 AS split_from, 2 AS split_to, DATE '1998-01-02' AS date
    FROM supplier WHERE s_suppkey % 5 = 0
    UNION ALL SELECT {ticker('s_suppkey')}, 1, 3, DATE '2000-01-03' FROM supplier WHERE s_suppkey % 10 = 0
    UNION ALL SELECT {ticker('s_suppkey')}, NULL, 2, DATE '1999-01-04' FROM supplier WHERE s_suppkey % 20 = 0
    UNION ALL SELECT {ticker('s_suppkey')}, 1, 0, DATE '1999-06-01' FROM supplier WHERE s_suppkey % 15 = 0
    """,
)
fragment(
    "exchanges",
    """
    SELECT r_regionkey AS id, 'exchange' AS type,
           CASE WHEN r_regionkey % 2 = 0 THEN 'stocks' ELSE 'crypto' END AS asset_class, 'us' AS locale,
           r_name AS name, 'M' || r_regionkey AS operating_mic, CAST(r_regionkey AS VARCHAR) AS participant_id,
           'exchange/' || r_regionkey AS url
    FROM region
    """,
)
fragment(
    "news",
    f"""
    SELECT {ticker('doc_id % (SELECT count(*) FROM supplier)')} AS ticker,
           CASE doc_id % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' ELSE 'mixed' END AS sentiment,
           concat_ws(' ', lang, source) AS sentiment_reasoning,
           DATE '2001-01-01' + CAST(doc_id % 300 AS INTEGER) AS date,
           'doc/' || doc_id AS article_url
    FROM documents
    """,
)
fragment(
    "quarters",
    """
    SELECT key, ticker, CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
           max(date) AS date, arg_max(close, date) AS actual, arg_min(close, date) AS estimate,
           CAST(sum(volume) AS BIGINT) AS revenue
    FROM keyed_bars GROUP BY 1, 2, 3, 4
    """,
    "keyed_bars",
)
fragment(
    "raw_calendar",
    """
    SELECT ticker, year, date, 16 AS hour, quarter, actual AS "epsActual",
           CASE WHEN (key + year * 4 + quarter) % 23 = 0 THEN 0.0::DOUBLE ELSE estimate END AS "epsEstimate",
           revenue AS "revenueActual",
           lag(revenue) OVER (PARTITION BY ticker ORDER BY year, quarter) AS "revenueEstimate"
    FROM quarters
    """,
    "quarters",
)
fragment(
    "raw_surprises",
    """
    SELECT ticker, year, date, quarter, actual, estimate,
           CASE WHEN (key + quarter) % 19 <> 0 THEN actual - estimate END AS surprise,
           (actual - estimate) / abs(estimate) * 100 AS "surprisePercent"
    FROM quarters WHERE year < 1998
    """,
    "quarters",
)
_GRADES = ("Strong Buy", "Outperform", "Hold", "Underperform", "Strong Sell")


def _grade(shift: int) -> str:
    level = f"(CAST(o_orderpriority[1] AS INTEGER) - 1 + {shift}) % 5"
    return f"CASE {level} " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(_GRADES)) + " END"


fragment(
    "raw_grades",
    f"""
    SELECT {ticker('o_custkey % (SELECT count(*) FROM supplier)')} AS ticker, CAST(o_orderdate AS DATE) AS date,
           c_mktsegment AS "gradingCompany", {_grade(1)} AS "previousGrade", {_grade(0)} AS "newGrade",
           CASE o_orderstatus WHEN 'F' THEN 'upgrade' WHEN 'O' THEN 'maintain' ELSE 'downgrade' END AS action
    FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0)
    JOIN customer ON o_custkey = c_custkey
    """,
)
fragment(
    "arrivals",
    f"""
    SELECT {ticker('o_custkey % (SELECT count(*) FROM supplier)')} AS ticker,
           CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, o_orderkey AS arrival
    FROM orders
    """,
)
fragment(
    "ticks",
    """
    SELECT 'U' || user_id AS symbol, date_trunc('millisecond', ts) AS ts,
           value AS open, value * 1.01::DOUBLE AS high, value * 0.99::DOUBLE AS low,
           CASE WHEN copy = 2 THEN value * 1.001::DOUBLE ELSE value END AS close,
           CAST(props->>'$.k' AS DOUBLE) AS volume,
           CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL ELSE nullif(value, 0) END AS vwap,
           event_id * 2 + copy AS ingest_id, copy
    FROM (SELECT *, 1 AS copy FROM events UNION ALL SELECT *, 2 FROM events WHERE event_id % 11 = 0)
    WHERE event_type <> 'error'
    """,
)
fragment("watermark", "SELECT max(ts) - INTERVAL 1 HOUR AS w FROM ticks", "ticks")
fragment(
    "kept_ticks",
    "SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol, ts ORDER BY ingest_id DESC) = 1",
    "ticks",
)
fragment(
    "last_ticks",
    """
    SELECT symbol, ts, arg_max(close, ingest_id) AS close, max(ingest_id) AS ingest_id FROM ticks GROUP BY 1, 2
    """,
    "ticks",
)

# -------------------------------------------------------------- stored tables

fragment(
    "tickers",
    """
    SELECT ticker, name, market, type, active
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY name, market, type, active) AS n
          FROM raw_tickers WHERE market = 'stocks' AND type IS NOT NULL) WHERE n = 1
    """,
    "raw_tickers",
)
fragment("details", "SELECT * FROM raw_details WHERE sic_code IS NOT NULL AND type IS NOT NULL", "raw_details")
fragment(
    "bars",
    """
    SELECT b.* FROM raw_bars b JOIN tickers t ON b.ticker = t.ticker WHERE volume > 0 AND transactions > 0
    """,
    "raw_bars",
    "tickers",
)
fragment("splits", "SELECT * FROM raw_splits WHERE split_from IS NOT NULL AND split_to > 0", "raw_splits")
fragment(
    "daily",
    """
    SELECT ticker, volume * f AS volume, open / f AS open, close / f AS close, high / f AS high, low / f AS low,
           date, transactions
    FROM (SELECT b.*, coalesce((SELECT product(s.split_to / s.split_from) FROM splits s
                                WHERE s.ticker = b.ticker AND s.date > b.date), 1.0::DOUBLE) AS f FROM bars b)
    """,
    "bars",
    "splits",
)
fragment(
    "months",
    """
    SELECT ticker, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_num,
           count(*) AS record_count, min(date) AS first_date, max(date) AS last_date, sum(close) AS close_sum,
           string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS days,
           arg_max(close, date) AS close
    FROM daily GROUP BY 1, 2, 3
    """,
    "daily",
)
fragment(
    "changes",
    """
    SELECT m.ticker, m.year, m.month_num, m.last_date, m.close,
           coalesce(b.close, lag(m.close) OVER (PARTITION BY m.ticker ORDER BY m.year, m.month_num)) AS prev_close
    FROM months m
    LEFT JOIN (SELECT ticker, year(date) AS year, month(date) AS month_num, close
               FROM (SELECT *, row_number() OVER (PARTITION BY ticker, year(date), month(date) ORDER BY date DESC) AS nth
                     FROM daily) WHERE nth = 2) b
      ON b.ticker = m.ticker AND b.year = m.year AND b.month_num = m.month_num
    """,
    "months",
)
fragment(
    "flags",
    """
    SELECT *, year = (SELECT max(year) FROM months) AS is_current_year,
           year = (SELECT max(year) FROM months) AND month_num = (SELECT max(month_num) FROM months) AS is_current_month
    FROM months
    """,
    "months",
)
ENRICHED = (
    "ticker, name, active, sic_code, sic_description, office, industry, market_cap, branding_icon_url, "
    "branding_logo_url, share_class_shares_outstanding, weighted_shares_outstanding, primary_exchange, total_employees"
)
fragment(
    "enriched",
    """
    SELECT t.ticker, t.name, t.active, d.sic_code, d.sic_description, c.office, c.industry, d.market_cap,
           d.branding_icon_url, d.branding_logo_url, d.share_class_shares_outstanding,
           d.weighted_shares_outstanding, d.primary_exchange, d.total_employees
    FROM tickers t JOIN details d USING (ticker) JOIN sic_codes c ON c.code = CAST(d.sic_code AS INTEGER)
    """,
    "tickers",
    "details",
    "sic_codes",
)
fragment("horizon", "SELECT max(date) AS last_day FROM daily", "daily")
fragment(
    "liquidity",
    f"""
    SELECT ticker, avg(volume) AS avg_daily_volume, avg(volume * close) AS avg_daily_traded_value,
           min(volume * close) AS min_daily_traded_value, max(volume * close) AS max_daily_traded_value
    FROM daily, horizon WHERE date >= CAST(last_day - INTERVAL {K.LIQUIDITY_MONTHS} MONTH AS DATE) GROUP BY 1
    """,
    "daily",
    "horizon",
)
fragment(
    "scored",
    f"""
    SELECT l.*, market_cap, name, office, industry, branding_icon_url, branding_logo_url, primary_exchange,
           {category('market_cap')} AS market_cap_category,
           {score('avg_daily_traded_value')} AS liquidity_score
    FROM liquidity l LEFT JOIN enriched e ON e.ticker = l.ticker
    """,
    "liquidity",
    "enriched",
)
fragment(
    "ranked",
    f"""
    SELECT *, rank() OVER (PARTITION BY market_cap_category ORDER BY avg_daily_traded_value DESC NULLS FIRST)
                AS liquidity_rank_in_category,
           rank() OVER (ORDER BY market_cap * {K.RANK_WEIGHT_CAP}::DOUBLE
                                 + avg_daily_traded_value * {K.RANK_WEIGHT_LIQUIDITY}::DOUBLE DESC NULLS FIRST) AS overall_rank
    FROM scored
    """,
    "scored",
)
fragment(
    "reliable",
    f"""
    SELECT * FROM ranked WHERE liquidity_score >= {K.RELIABLE_MIN_SCORE} AND market_cap >= {K.RELIABLE_MIN_CAP}
                           AND avg_daily_volume > {K.RELIABLE_MIN_VOLUME}
    """,
    "ranked",
)
fragment(
    "leaders",
    f"SELECT ticker, market_cap_category FROM reliable ORDER BY overall_rank, ticker LIMIT {K.LEADING_TICKERS}",
    "reliable",
)
fragment(
    "ranked_news",
    "SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC NULLS FIRST, article_url) AS rn FROM news",
    "news",
)
fragment(
    "with_news",
    f"""
    SELECT {', '.join('e.' + c for c in ENRICHED.split(', '))}, a.sentiment AS current_sentiment,
           b.sentiment AS previous_sentiment, a.date, a.sentiment_reasoning AS current_reasoning
    FROM enriched e JOIN ranked_news a ON a.ticker = e.ticker AND a.rn = 1
    LEFT JOIN ranked_news b ON b.ticker = e.ticker AND b.rn = 2
    """,
    "enriched",
    "ranked_news",
)
fragment(
    "newest_changes",
    """
    SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100 AS pct_change
    FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY year DESC, month_num DESC) AS n FROM changes)
    WHERE n = 1
    """,
    "changes",
)
fragment(
    "leader_changes",
    """
    SELECT *, (close - prev_close) / nullif(prev_close, 0) * 100 AS pct_change
    FROM (SELECT c.*, row_number() OVER (PARTITION BY c.ticker ORDER BY year DESC, month_num DESC) AS n
          FROM changes c JOIN leaders USING (ticker), horizon
          WHERE year * 12 + month_num BETWEEN year(last_day) * 12 + month(last_day) - 1
                                          AND year(last_day) * 12 + month(last_day))
    WHERE n = 1
    """,
    "changes",
    "leaders",
    "horizon",
)
fragment(
    "calendar",
    """
    SELECT * FROM raw_calendar WHERE "epsActual" IS NOT NULL AND "epsEstimate" IS NOT NULL
       AND "revenueActual" IS NOT NULL AND "revenueEstimate" IS NOT NULL
    """,
    "raw_calendar",
)
fragment(
    "history",
    """
    SELECT * FROM raw_surprises WHERE actual IS NOT NULL AND estimate IS NOT NULL AND surprise IS NOT NULL
       AND "surprisePercent" IS NOT NULL
    """,
    "raw_surprises",
)
fragment(
    "earnings",
    """
    SELECT ticker, year, date, quarter, "epsActual", "epsEstimate", "epsActual" - "epsEstimate" AS "epsSurprise",
           ("epsActual" - "epsEstimate") / abs("epsEstimate") * 100 AS "epsSurprisePercent",
           "revenueActual" - "revenueEstimate" AS "revenueSurprise",
           ("revenueActual" - "revenueEstimate") / abs(CASE WHEN "revenueEstimate" = 0 THEN 1 ELSE "revenueEstimate" END)
             * 100 AS "revenueSurprisePercent",
           CAST(row_number() OVER (PARTITION BY ticker ORDER BY date NULLS LAST, quarter DESC) AS INTEGER) AS row_num
    FROM calendar WHERE "epsEstimate" <> 0
    """,
    "calendar",
)
fragment(
    "all_earnings",
    """
    SELECT * FROM earnings
    UNION
    SELECT ticker, year, date, quarter, actual, estimate, surprise, "surprisePercent", NULL, NULL,
           CAST(row_number() OVER (PARTITION BY ticker ORDER BY date DESC, quarter DESC) AS INTEGER)
    FROM history
    """,
    "earnings",
    "history",
)


# ----------------------------------------------------------------- indicators


def sma_sql(source: str, windows=WINDOWS, extra: str = "") -> str:
    averages = ", ".join(
        f"avg(close) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sma_{n}"
        for n in windows
    )
    return f"SELECT ticker, date, close{extra}, {averages} FROM {source}"


fragment("sma", sma_sql("clean_bars"), "clean_bars")
fragment("numbered", "SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM clean_bars", "clean_bars")


def wma_sql(source: str, windows=WINDOWS) -> str:
    """Weighted averages over named windows; every close of a window has to be known."""
    averages = ", ".join(
        f"""CASE WHEN rn >= {n} AND count(close) OVER w{n} = {n} THEN
              (({n} - rn) * sum(close) OVER w{n} + sum(close * rn) OVER w{n}) / {n * (n + 1) // 2} END AS wma_{n}"""
        for n in windows
    )
    named = ", ".join(
        f"w{n} AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in windows
    )
    return f"SELECT ticker, date, close, rn, {averages} FROM {source} WINDOW {named}"


fragment("wma_all", wma_sql("numbered"), "numbered")
fragment("wma", f"SELECT * FROM wma_all WHERE rn >= {max(WINDOWS)}", "wma_all")


def ema_fragments(name: str, source: str, windows, *needs: str) -> None:
    columns = ", ".join(f"close AS ema_{n}" for n in windows)
    steps = ", ".join(f"(b.close - e.ema_{n}) * (2.0::DOUBLE / {n + 1}) + e.ema_{n}" for n in windows)
    fragment(
        name,
        f"""
        SELECT ticker, date, close, rn, {columns} FROM {source} WHERE rn = 1
        UNION ALL
        SELECT b.ticker, b.date, b.close, b.rn, {steps} FROM {source} b JOIN {name} e ON b.ticker = e.ticker AND b.rn = e.rn + 1
        """,
        *needs,
    )


ema_fragments("ema", "numbered", WINDOWS, "numbered")
ema_fragments("ema_15", "numbered", (15,), "numbered")


def macd_fragments(prefix: str, source: str, *needs: str) -> None:
    fragment(
        f"{prefix}steps",
        f"""
        SELECT ticker, date, close, rn, close AS fast, NULL::DOUBLE AS slow, NULL::DOUBLE AS signal
        FROM {source} WHERE rn = {K.MACD_FAST}
        UNION ALL
        SELECT ticker, date, close, rn, f, s,
               CASE WHEN rn = {K.MACD_SIGNAL_SEED_ROW} THEN f - s
                    WHEN rn > {K.MACD_SIGNAL_SEED_ROW}
                    THEN (f - s - signal) * (2.0::DOUBLE / {K.MACD_SIGNAL + 1}) + signal END
        FROM (SELECT b.ticker, b.date, b.close, b.rn, e.signal,
                     (b.close - e.fast) * (2.0::DOUBLE / {K.MACD_FAST + 1}) + e.fast AS f,
                     CASE WHEN b.rn = {K.MACD_SLOW} THEN b.close
                          ELSE (b.close - e.slow) * (2.0::DOUBLE / {K.MACD_SLOW + 1}) + e.slow END AS s
              FROM {source} b JOIN {prefix}steps e ON b.ticker = e.ticker AND b.rn = e.rn + 1)
        """,
        *needs,
    )
    fragment(
        f"{prefix}macd",
        f"""
        SELECT ticker, date, close, fast - slow AS macd_line, signal AS signal_line, fast - slow - signal AS macd_histogram,
               lag(fast - slow) OVER (PARTITION BY ticker ORDER BY date) AS prev_macd_line,
               lag(signal) OVER (PARTITION BY ticker ORDER BY date) AS prev_signal_line
        FROM {prefix}steps WHERE rn >= {K.MACD_SIGNAL_SEED_ROW}
        """,
        f"{prefix}steps",
    )


macd_fragments("", "numbered", "numbered")
fragment(
    "gapped",
    """
    SELECT ticker, date, rn,
           CASE WHEN CAST(ticker[2:] AS BIGINT) % 3 = 0 AND rn % 41 = CAST(ticker[2:] AS BIGINT) % 41 THEN NULL ELSE close END AS close
    FROM numbered
    """,
    "numbered",
)
fragment("gapped_wma", wma_sql("gapped", (5, 20)), "gapped")
ema_fragments("gapped_ema", "gapped", WINDOWS, "gapped")
macd_fragments("gapped_", "gapped", "gapped")
fragment(
    "numbered_daily",
    "SELECT ticker, date, close, row_number() OVER (PARTITION BY ticker ORDER BY date) AS rn FROM daily",
    "daily",
)
macd_fragments("daily_", "numbered_daily", "numbered_daily")

FROM_TO = "BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"
BY_DATE = "PARTITION BY ticker ORDER BY date"


FACTOR = "(1.0::DOUBLE + ((key * 31 + rn * 17) % 21 - 10) / 1003.0::DOUBLE)"


def vendor(kind: str, source: str, source_has_rn: bool) -> None:
    """A vendor's values: ours, off by up to one percent, and none for some tickers."""
    columns = ", ".join(f"CASE WHEN key % 9 <> 0 THEN {kind}_{n} * {FACTOR} END AS {kind}_{n}" for n in WINDOWS)
    numbering = "" if source_has_rn else f", row_number() OVER ({BY_DATE}) AS rn"
    fragment(
        f"vendor_{kind}",
        f"""
        SELECT ticker, date AS timestamp, {columns}
        FROM (SELECT *, CAST(ticker[2:] AS BIGINT) AS key{numbering} FROM {source})
        """,
        source,
    )


vendor("sma", "sma", False)
vendor("ema", "ema", True)
vendor("wma", "wma_all", True)


def error_columns(kind: str, threshold: float, theirs_of: str, mine_of: str) -> str:
    columns = []
    for n in WINDOWS:
        theirs, mine = f"{theirs_of}{n}", f"{mine_of}{n}"
        error = f"abs(({theirs} - {mine}) / nullif({mine}, 0)) * 100"
        columns += [
            f"{theirs} AS {kind}_{n}_vendor",
            f"{mine} AS {kind}_{n}_calculated",
            f"{error} AS {kind}_{n}_error_percent",
            f"coalesce({error} > {threshold}, false) AS {kind}_{n}_is_critical",
        ]
    return ", ".join(columns)


def errors(kind: str, calculated: str, threshold: float) -> str:
    return f"""
        SELECT v.ticker, v.timestamp, {error_columns(kind, threshold, f"v.{kind}_", f"c.{kind}_")}
        FROM vendor_{kind} v LEFT JOIN {calculated} c ON c.ticker = v.ticker AND c.date = v.timestamp
        """


for _kind, _calculated, _threshold in (
    ("sma", "sma", K.DAILY_ERROR_THRESHOLD),
    ("ema", "ema", K.DAILY_ERROR_THRESHOLD),
    ("wma", "wma", K.STRICT_ERROR_THRESHOLD),
):
    if _kind == "wma":
        # The windows are heavy: both sides come from one pass over them, the vendor's on every row, ours from the longest window on.
        _pairs = ", ".join(f"CASE WHEN key % 9 <> 0 THEN wma_{n} * {FACTOR} END AS theirs_{n}, CASE WHEN rn >= {max(WINDOWS)} THEN wma_{n} END AS mine_{n}" for n in WINDOWS)
        fragment("wma_pairs", f"SELECT ticker, date AS timestamp, {_pairs} FROM (SELECT *, CAST(ticker[2:] AS BIGINT) AS key FROM wma_all)", "wma_all")
        fragment("wma_errors", f"SELECT ticker, timestamp, {error_columns('wma', _threshold, 'theirs_', 'mine_')} FROM wma_pairs", "wma_pairs")
    else:
        fragment(f"{_kind}_errors", errors(_kind, _calculated, _threshold), f"vendor_{_kind}", _calculated)
    _rounded = ", ".join(
        f"{rs(*[f'{_kind}_{n}_{c}' for c in ('vendor', 'calculated', 'error_percent')])}, {_kind}_{n}_is_critical"
        for n in WINDOWS
    )
    oracle(f"a19_{_kind}_errors", f"SELECT ticker, timestamp, {_rounded} FROM {_kind}_errors", f"{_kind}_errors")
fragment("sma_errors_strict", errors("sma", "sma", K.STRICT_ERROR_THRESHOLD), "vendor_sma", "sma")

# -------------------------------------------------------------------- queries

ROUNDED_BAR = f"ticker, date, {rs('volume', 'open', 'close', 'high', 'low')}, transactions"

oracle("s1_bars_csv", f"SELECT {ROUNDED_BAR.replace('transactions', 'CAST(transactions AS INTEGER) AS transactions')} FROM raw_bars", "raw_bars")
oracle("s2_daily_json", f"SELECT {ROUNDED_BAR.replace('transactions', 'CAST(transactions AS INTEGER) AS transactions')} FROM raw_bars", "raw_bars")
oracle("s3_ticker_details_json", "SELECT * FROM raw_details", "raw_details")
oracle(
    "s4_flatten_news",
    """
    SELECT CASE WHEN n % 7 <> 0 THEN ticker END AS ticker, CASE WHEN n % 7 <> 0 THEN sentiment END AS sentiment,
           CASE WHEN n % 7 <> 0 THEN sentiment_reasoning END AS sentiment_reasoning, date, article_url
    FROM (SELECT *, CAST(article_url[5:] AS BIGINT) AS n FROM news)
    """,
    "news",
)
CALENDAR = 'ticker, year, date, hour, quarter, ' + rs('"epsActual"', '"epsEstimate"') + ', "revenueActual", "revenueEstimate"'
SURPRISES = "ticker, year, date, quarter, " + rs("actual", "estimate", "surprise", '"surprisePercent"')
oracle("s5_map_earnings", f"SELECT {CALENDAR} FROM raw_calendar", "raw_calendar")
oracle("s5_map_surprises", f"SELECT {SURPRISES} FROM raw_surprises", "raw_surprises")
oracle("s5_map_grades", "SELECT * FROM raw_grades WHERE action <> 'maintain'", "raw_grades")
oracle("s5_map_splits", "SELECT * FROM raw_splits", "raw_splits")
oracle("s5_map_exchanges", "SELECT * FROM exchanges", "exchanges")
oracle("s5_map_tickers", "SELECT * FROM raw_tickers", "raw_tickers")
oracle(
    "s6_slice",
    f"SELECT {ROUNDED_BAR} FROM clean_bars WHERE date BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'",
    "clean_bars",
)
oracle("s7_write_clustered", f"SELECT {ROUNDED_BAR} FROM clean_bars", "clean_bars")
oracle(
    "s8_replace_partitions",
    f"""
    SELECT ticker, date, {r('close')},
           {r('CASE WHEN year(date) = 1997 THEN volume * 2 ELSE volume END', 'volume')}, CAST(year(date) AS INTEGER) AS year
    FROM clean_bars
    """,
    "clean_bars",
)
oracle("s9_replace_if_nonempty", "SELECT * FROM raw_grades", "raw_grades")
oracle(
    "s10_upsert",
    f"""
    SELECT ticker, date, {r('CASE WHEN year(date) >= 1999 THEN close + 1 ELSE close END', 'close')}, {r('volume')},
           CAST(year(date) AS INTEGER) AS year
    FROM clean_bars
    """,
    "clean_bars",
)
oracle("s11_incremental_append", f"SELECT ticker, date, {r('close')} FROM clean_bars", "clean_bars")
oracle("s12_seed", "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer")
oracle(
    "s13_json_records",
    """
    SELECT '{"ticker":"' || ticker || '","split_from":' || coalesce(CAST(split_from AS VARCHAR), 'null')
           || ',"split_to":' || split_to || '}' AS value
    FROM raw_splits
    """,
    "raw_splits",
)

oracle("f1_stage_bars", f"SELECT {ROUNDED_BAR} FROM bars", "bars")
oracle("f2_stage_tickers", "SELECT * FROM tickers", "tickers")
oracle("f3_stage_ticker_details", "SELECT * FROM details", "details")
oracle("f4_stage_splits", "SELECT * FROM splits", "splits")
oracle("f5_stage_earnings_calendar", f"SELECT {CALENDAR} FROM calendar", "calendar")
oracle("f6_stage_earnings_surprises", f"SELECT {SURPRISES} FROM history", "history")
oracle("f7_stage_grades", "SELECT DISTINCT * FROM raw_grades", "raw_grades")
oracle("f8_stage_exchanges", "SELECT * FROM exchanges WHERE asset_class = 'stocks'", "exchanges")
oracle("f9_stage_news", "SELECT * FROM news", "news")
oracle("f9_stage_sic_codes", "SELECT * FROM sic_codes", "sic_codes")
_BACK = {"last_3_months": "3 MONTH", "last_6_months": "6 MONTH", "last_1_year": "1 YEAR", "last_4_years": "4 YEAR"}
_PERIOD_SQL = {
    "last_5_days": "date >= m - 5",
    **{name: f"date >= CAST(m - INTERVAL {back} AS DATE)" for name, back in _BACK.items()},
    "mtd": "year(date) = year(m) AND month(date) = month(m)",
    "ytd": "year(date) = year(m)",
    "everything": "true",
}
oracle(
    "f10_time_periods",
    " UNION ALL ".join(
        f"SELECT ticker, date, {r('close')}, '{name}' AS period FROM clean_bars, (SELECT max(date) AS m FROM clean_bars) WHERE {condition}"
        for name, condition in _PERIOD_SQL.items()
    ),
    "clean_bars",
)
oracle("f11_date_range", f"SELECT ticker, date, {r('close')} FROM clean_bars WHERE date {FROM_TO}", "clean_bars")
oracle(
    "f12_category_filter",
    f"""
    SELECT d.ticker, d.date, {r('d.close', 'close')}, market_cap_category
    FROM daily d JOIN reliable USING (ticker) WHERE market_cap_category = 'Large Cap'
    """,
    "daily",
    "reliable",
)
oracle("f13_category_list", "SELECT DISTINCT market_cap_category FROM reliable", "reliable")
oracle(
    "f14_picker_category",
    "SELECT ticker || ' - ' || name AS text, ticker AS value FROM reliable WHERE market_cap_category = 'Mega Cap'",
    "reliable",
)
oracle("f14_picker_all", "SELECT ticker || ' - ' || name AS text, ticker AS value FROM reliable", "reliable")
oracle(
    "f15_earnings_mart",
    "SELECT ticker, CAST(year(date) AS INTEGER) AS year, date, quarter, "
    + rs('"epsActual"', '"epsEstimate"', '"epsSurprise"', '"epsSurprisePercent"')
    + ', "revenueSurprise", '
    + rs('"revenueSurprisePercent"')
    + " FROM earnings",
    "earnings",
)
oracle(
    "f16_stock_trend",
    f"SELECT ticker, date, {rs('open', 'high', 'low', 'close')} FROM daily, horizon WHERE date >= last_day - 30",
    "daily",
    "horizon",
)
_CLASSIFIED_NUMBERS = ", ".join(
    (
        r("round(market_cap / 1000000000, 2)", "market_cap_billions"),
        r("round(avg_daily_volume, 0)", "avg_daily_volume"),
        r("round(avg_daily_traded_value / 1000000, 2)", "avg_daily_traded_value_millions"),
    )
)
oracle(
    "f16_stock_info",
    f"""
    SELECT * EXCLUDE (market_cap_billions) FROM (
        SELECT ticker, name, industry, office, {_CLASSIFIED_NUMBERS}, liquidity_score, market_cap_category,
               branding_icon_url, branding_logo_url, primary_exchange FROM reliable)
    """,
    "reliable",
)

oracle("j1_ticker_enrichment", f"SELECT {ENRICHED} FROM enriched", "enriched")
oracle(
    "j2_liquidity_left_join",
    "SELECT ticker, "
    + rs(
        "avg_daily_volume", "avg_daily_traded_value", "min_daily_traded_value", "max_daily_traded_value", "market_cap",
        digits=2,
    )
    + ", name, office, industry, branding_icon_url, branding_logo_url, primary_exchange, market_cap_category, liquidity_score"
    " FROM scored",
    "scored",
)
oracle(
    "j3_later_splits",
    """
    SELECT b.ticker, b.date, CAST(count(s.date) AS INTEGER) AS later_splits
    FROM bars b LEFT JOIN splits s ON s.ticker = b.ticker AND s.date > b.date GROUP BY 1, 2
    """,
    "bars",
    "splits",
)
oracle("j6_leading_bars", f"SELECT ticker, date, {r('close')} FROM daily WHERE ticker IN (SELECT ticker FROM leaders)", "daily", "leaders")
oracle(
    "j7_vendor_join",
    f"SELECT ticker, timestamp, {rs('sma_20_vendor', 'sma_20_calculated')} FROM sma_errors",
    "sma_errors",
)
oracle(
    "j8_not_yet_graded",
    """
    SELECT ticker, overall_rank FROM reliable
    WHERE ticker NOT IN (SELECT ticker FROM raw_grades WHERE CAST(ticker[2:] AS BIGINT) % 13 <> 5)
    """,
    "reliable",
    "raw_grades",
)
oracle(
    "j10_latest_year_rows",
    "SELECT ticker, year, month_num, record_count, first_date, last_date FROM months WHERE year = (SELECT max(year) FROM months)",
    "months",
)

oracle("a1_split_adjust", f"SELECT {ROUNDED_BAR} FROM daily", "daily")
oracle(
    "a2_cumulated_months",
    f"SELECT ticker, year, month_num, days, {r('close_sum')}, record_count, first_date, last_date FROM months",
    "months",
)
oracle(
    "a3_liquidity",
    "SELECT ticker, "
    + rs("avg_daily_volume", "avg_daily_traded_value", "min_daily_traded_value", "max_daily_traded_value", digits=2)
    + " FROM liquidity",
    "liquidity",
)
oracle("a4_buckets", "SELECT market_cap_category, liquidity_score, count(*) AS tickers FROM scored GROUP BY 1, 2", "scored")
oracle(
    "a5_classifier",
    f"""
    SELECT ticker, name, overall_rank, market_cap_category, {_CLASSIFIED_NUMBERS}, liquidity_score,
           liquidity_rank_in_category, office, industry, branding_icon_url, branding_logo_url, primary_exchange
    FROM reliable
    """,
    "reliable",
)
oracle("a6_sentiment_pivot", f"SELECT {ENRICHED}, current_sentiment, previous_sentiment FROM with_news", "with_news")
oracle("a7_tickers_with_news", "SELECT * FROM with_news", "with_news")


def candles_sql(source: str, period: str) -> str:
    return f"""
        SELECT ticker, CAST(date_trunc('{period}', date) AS DATE) AS time, {r('arg_min(open, date)', 'open')},
               {r('max(high)', 'high')}, {r('min(low)', 'low')}, {r('arg_max(close, date)', 'close')},
               {r('sum(volume)', 'volume')}
        FROM {source} GROUP BY 1, 2
        """


oracle("a8_candles_weekly", candles_sql("clean_bars", "week"), "clean_bars")
oracle("a8_candles_monthly", candles_sql("clean_bars", "month"), "clean_bars")
oracle(
    "a9_candlestick_daily",
    f"""
    SELECT d.ticker, d.date AS time, {rs('open', 'high', 'low', 'close', 'volume')}, market_cap_category
    FROM daily d JOIN reliable USING (ticker), horizon WHERE d.date >= CAST(last_day - INTERVAL 3 MONTH AS DATE)
    """,
    "daily",
    "reliable",
    "horizon",
)
oracle(
    "a9_candlestick_weekly",
    f"""
    SELECT c.*, market_cap_category FROM ({candles_sql('(SELECT d.* FROM daily d, horizon WHERE year(d.date) = year(last_day))', 'week')}) c
    JOIN reliable USING (ticker) WHERE market_cap_category = 'Mega Cap'
    """,
    "daily",
    "reliable",
    "horizon",
)
oracle(
    "a10_market_sentiment",
    """
    SELECT score, CASE WHEN score > 0 THEN 'Bullish' ELSE 'Bearish' END AS market_sentiment
    FROM (SELECT CAST(coalesce(sum(CASE WHEN close > prev_close THEN 1 WHEN close < prev_close THEN -1 ELSE 0 END), 0) AS BIGINT) AS score
          FROM leader_changes)
    """,
    "leader_changes",
)
oracle(
    "a11_market_leader",
    f"""
    SELECT l.ticker, {r('l.close', 'close')}, {r('l.pct_change', 'pct_change')}, current_sentiment, branding_logo_url, branding_icon_url
    FROM (SELECT * FROM leader_changes WHERE pct_change IS NOT NULL ORDER BY pct_change DESC, ticker LIMIT 1) l
    LEFT JOIN with_news n ON n.ticker = l.ticker
    """,
    "leader_changes",
    "with_news",
)
fragment(
    "sectors",
    """
    SELECT industry AS sector, avg((close - prev_close) / prev_close * 100) AS avg_change_pct
    FROM changes JOIN enriched USING (ticker), horizon
    WHERE year = year(last_day) AND close IS NOT NULL AND prev_close <> 0 AND industry IS NOT NULL GROUP BY 1
    """,
    "changes",
    "enriched",
    "horizon",
)
oracle("a12_sector_performance", f"SELECT sector, {r('avg_change_pct')} FROM sectors", "sectors")
oracle(
    "a12_best_and_worst_sector",
    f"""
    SELECT (SELECT sector FROM sectors ORDER BY avg_change_pct DESC, sector LIMIT 1) AS hottest_sector,
           {r('max(avg_change_pct)', 'hottest_sector_change')},
           (SELECT sector FROM sectors ORDER BY avg_change_pct, sector LIMIT 1) AS worst_sector,
           {r('min(avg_change_pct)', 'worst_sector_change')}
    FROM sectors
    """,
    "sectors",
)
fragment(
    "movers",
    "SELECT * FROM newest_changes WHERE last_date = (SELECT max(last_date) FROM changes) AND pct_change IS NOT NULL",
    "newest_changes",
)
oracle(
    "a13_best_and_worst_stock",
    f"""
    SELECT t.ticker AS top_stock_ticker, {r('t.close', 'top_stock_price')}, {r('t.pct_change', 'top_stock_change')},
           w.ticker AS worst_stock_ticker, {r('w.close', 'worst_stock_price')}, {r('w.pct_change', 'worst_stock_change')}
    FROM (SELECT * FROM movers ORDER BY pct_change DESC, ticker LIMIT 1) t,
         (SELECT * FROM movers ORDER BY pct_change, ticker LIMIT 1) w
    """,
    "movers",
)
oracle(
    "a14_watchlist",
    f"""
    SELECT c.ticker, e.name, e.branding_icon_url, e.branding_logo_url, {r('close', 'price')}, {r('pct_change', 'change_pct')},
           CASE WHEN close > prev_close THEN 'up' WHEN close < prev_close THEN 'down' ELSE 'unchanged' END AS direction
    FROM newest_changes c LEFT JOIN enriched e ON e.ticker = c.ticker
    WHERE pct_change IS NOT NULL AND CAST(c.ticker[2:] AS BIGINT) <= 11
    """,
    "newest_changes",
    "enriched",
)
oracle("a15_latest_date", "SELECT max(date) AS max_date FROM clean_bars", "clean_bars")


def earnings_sql(source: str) -> str:
    return (
        "SELECT ticker, year, date, quarter, "
        + rs('"epsActual"', '"epsEstimate"', '"epsSurprise"', '"epsSurprisePercent"', digits=4)
        + ', "revenueSurprise", '
        + rs('"revenueSurprisePercent"', digits=4)
        + f", row_num FROM {source}"
    )


oracle("a16_earnings_surprises", earnings_sql("earnings"), "earnings")
oracle("u1_surprise_union", earnings_sql("all_earnings"), "all_earnings")
oracle(
    "a17_critical_counts",
    " UNION ALL ".join(
        f"SELECT ticker, {n} AS \"window\", count(*) AS critical FROM sma_errors_strict WHERE sma_{n}_is_critical GROUP BY 1"
        for n in WINDOWS
    ),
    "sma_errors_strict",
)
oracle(
    "a17_critical_counts_by_day",
    " UNION ALL ".join(
        f"SELECT ticker, timestamp, {n} AS \"window\", count(*) AS critical FROM sma_errors_strict WHERE sma_{n}_is_critical GROUP BY 1, 2"
        for n in WINDOWS
    ),
    "sma_errors_strict",
)
oracle(
    "a18_negative_totals",
    f"SELECT c_nationkey AS id, {r('sum(c_acctbal - 4500)', 'total', 2)} FROM customer GROUP BY 1 HAVING NOT (sum(c_acctbal - 4500) >= 0)",
)
oracle(
    "a20_vendor_consolidation",
    f"SELECT ticker, timestamp, {rs(*[f'sma_{n}' for n in WINDOWS])} FROM vendor_sma WHERE sma_10 IS NOT NULL",
    "vendor_sma",
)
fragment(
    "event_bars",
    """
    SELECT e.*, b.date AS price_date, b.close, b.rn - f.first_rn AS "offset"
    FROM earnings e
    JOIN (SELECT e.ticker, e.date, min(b.rn) AS first_rn FROM earnings e JOIN numbered_daily b
            ON b.ticker = e.ticker AND b.date >= e.date GROUP BY 1, 2) f ON f.ticker = e.ticker AND f.date = e.date
    JOIN numbered_daily b ON b.ticker = e.ticker AND b.rn BETWEEN f.first_rn AND f.first_rn + 10
    """,
    "earnings",
    "numbered_daily",
)
oracle(
    "a21_surprise_return_correlation",
    f"""
    SELECT CAST(year(a.date) AS INTEGER) AS year, a.quarter,
           {r('corr(a."epsSurprisePercent", (b.close / nullif(a.close, 0) - 1) * 100)', 'correlation')}, count(*) AS events
    FROM event_bars a JOIN event_bars b ON b.ticker = a.ticker AND b.date = a.date AND b.quarter = a.quarter AND b."offset" = 5
    WHERE a."offset" = 0 GROUP BY 1, 2
    """,
    "event_bars",
)
oracle(
    "a22_last_quarters",
    f"""
    SELECT ticker, date, quarter, {rs('"epsSurprisePercent"')}, quarters_back
    FROM (SELECT *, CAST(row_number() OVER (PARTITION BY ticker ORDER BY date DESC, quarter DESC) AS INTEGER) AS quarters_back FROM earnings)
    WHERE quarters_back <= 4
    """,
    "earnings",
)
oracle(
    "a23_normalised_performance",
    f"""
    SELECT b.ticker, b.date, CAST(b."offset" AS INTEGER) AS "offset", b.price_date, {r('b.close', 'close')},
           {r('b.close / nullif(a.close, 0) - 1', 'performance')}
    FROM event_bars b JOIN event_bars a ON a.ticker = b.ticker AND a.date = b.date AND a."offset" = 0
    """,
    "event_bars",
)
_FIELDS = BAR.split(", ")
oracle(
    "a24_missing_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) - count({c}) AS missing, {r(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 'percentage')} FROM dirty_bars"
        for c in _FIELDS
    ),
    "dirty_bars",
)

AVERAGES = rs(*[f"sma_{n}" for n in WINDOWS])
oracle("w1_sma", f"SELECT ticker, date, {r('close')}, {AVERAGES} FROM sma", "sma")
fragment("daily_sma", sma_sql("daily"), "daily")
oracle(
    "w1_sma_mart",
    f"""
    SELECT s.ticker, s.date, {r('s.close', 'close')}, {AVERAGES}, f.year, f.month_num, is_current_month, is_current_year
    FROM daily_sma s JOIN flags f ON f.ticker = s.ticker AND f.year = year(s.date) AND f.month_num = month(s.date)
    """,
    "daily_sma",
    "flags",
)
oracle("w2_wma", f"SELECT ticker, date, {r('close')}, {rs(*[f'wma_{n}' for n in WINDOWS])} FROM wma", "wma")
oracle("w3_ema", f"SELECT ticker, date, {r('close')}, {rs(*[f'ema_{n}' for n in WINDOWS])} FROM ema", "ema")
MACD = ("close", "macd_line", "signal_line", "macd_histogram", "prev_macd_line", "prev_signal_line")
oracle("w2_wma_missing_closes", f"SELECT ticker, date, {r('close')}, {rs('wma_5', 'wma_20')} FROM gapped_wma", "gapped_wma")
oracle("w3_ema_missing_closes", f"SELECT ticker, date, {r('close')}, {rs(*[f'ema_{n}' for n in WINDOWS])} FROM gapped_ema", "gapped_ema")
oracle("w4_macd_missing_closes", f"SELECT ticker, date, {rs(*MACD)} FROM gapped_macd", "gapped_macd")
oracle("w4_macd", f"SELECT ticker, date, {rs(*MACD)} FROM macd", "macd")
fragment(
    "bands",
    f"""
    SELECT ticker, date, close, sma_20 AS middle_band, sma_20 + spread AS upper_band, sma_20 - spread AS lower_band
    FROM (SELECT *, stddev_samp(close) OVER ({BY_DATE} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) * 2.0::DOUBLE AS spread
          FROM sma WHERE date {FROM_TO})
    """,
    "sma",
)
oracle("w5_bollinger", f"SELECT ticker, date, {rs('close', 'middle_band', 'upper_band', 'lower_band')} FROM bands", "bands")
oracle("w6_recurrence", f"SELECT ticker, date, {rs('close', 'ema_15')} FROM ema_15", "ema_15")


def crossing(source: str, fast: str, slow: str, order: str, price: str = "close") -> str:
    up = f"{fast} > {slow} AND lag({fast}) OVER w <= lag({slow}) OVER w"
    down = f"{fast} < {slow} AND lag({fast}) OVER w >= lag({slow}) OVER w"
    return f"""
        SELECT *, CASE WHEN {up} THEN 'BUY' WHEN {down} THEN 'SELL' END AS signal,
               CASE WHEN {up} THEN {price} END AS buy_signal, CASE WHEN {down} THEN {price} END AS sell_signal
        FROM {source} WINDOW w AS (PARTITION BY ticker ORDER BY {order})
        """


for _kind in ("ema", "sma", "wma"):
    fragment(
        f"{_kind}_range", f"SELECT ticker, date, close, {_kind}_20 AS {_kind} FROM {_kind} WHERE date {FROM_TO}", _kind
    )
    oracle(
        f"w7_{_kind}_signals",
        f"SELECT ticker, date, {rs('close', _kind)}, signal, {rs('buy_signal', 'sell_signal')} "
        f"FROM ({crossing(f'{_kind}_range', 'close', _kind, 'date')})",
        f"{_kind}_range",
    )
    for _period, _suffix in (("week", "weekly"), ("month", "monthly")):
        fragment(
            f"{_kind}_{_suffix}",
            f"""
            SELECT ticker, CAST(date_trunc('{_period}', date) AS DATE) AS date, CAST(year(date) AS INTEGER) AS year,
                   max(date) AS last_date, arg_max(close, date) AS close, arg_max({_kind}, date) AS {_kind},
                   {_period}(max(date)) AS number
            FROM {_kind}_range GROUP BY 1, 2, 3
            """,
            f"{_kind}_range",
        )
        oracle(
            f"w8_{_kind}_signals_{_suffix}",
            f"SELECT ticker, date, year, {rs('close', _kind)}, signal, {rs('buy_signal', 'sell_signal')} "
            f"FROM ({crossing(f'{_kind}_{_suffix}', 'close', _kind, 'year, last_date')})",
            f"{_kind}_{_suffix}",
        )
oracle(
    "w8_ema_signals_week_numbers",
    f"SELECT ticker, date, year, {rs('close', 'ema')}, signal, {rs('buy_signal', 'sell_signal')} "
    f"FROM ({crossing('ema_weekly', 'close', 'ema', 'year, number, last_date')})",
    "ema_weekly",
)
oracle(
    "w9_ranks",
    f"SELECT ticker, market_cap_category, {r('avg_daily_traded_value', digits=2)}, liquidity_rank_in_category, overall_rank FROM ranked",
    "ranked",
)


def money(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DECIMAL(20,2)) AS {name or column}"


MACD_RANGE = f"(SELECT * FROM macd WHERE date {FROM_TO})"
UP = "macd_line > signal_line AND prev_macd_line <= prev_signal_line"
DOWN = "macd_line < signal_line AND prev_macd_line >= prev_signal_line"
MACD_OUTPUT = f"""
    ticker, date, {money('close')}, {money('macd_line')}, {money('signal_line')},
    {r('CASE WHEN CAST(macd_histogram AS DECIMAL(20,2)) >= 0 THEN macd_histogram END', 'positive_histogram')},
    {r('CASE WHEN CAST(macd_histogram AS DECIMAL(20,2)) < 0 THEN macd_histogram END', 'negative_histogram')},
    CASE WHEN {UP} THEN 'BUY' WHEN {DOWN} THEN 'SELL' END AS signal,
    CAST(CASE WHEN {UP} THEN close END AS DECIMAL(20,2)) AS buy_signal,
    CAST(CASE WHEN {DOWN} THEN close END AS DECIMAL(20,2)) AS sell_signal
"""
BANDS = ("close", "middle_band", "upper_band", "lower_band")
OUT_LOW = "close < lower_band AND lag(close) OVER w >= lag(lower_band) OVER w"
OUT_HIGH = "close > upper_band AND lag(close) OVER w <= lag(upper_band) OVER w"
BAND_OUTPUT = f"""
    ticker, date, {', '.join(money(c) for c in BANDS)},
    CASE WHEN {OUT_LOW} THEN 'BUY' WHEN {OUT_HIGH} THEN 'SELL' END AS signal,
    CAST(CASE WHEN {OUT_LOW} THEN close END AS DECIMAL(20,2)) AS buy_signal,
    CAST(CASE WHEN {OUT_HIGH} THEN close END AS DECIMAL(20,2)) AS sell_signal
"""


def period_last(source: str, columns: tuple[str, ...], period: str) -> str:
    last = ", ".join(f"arg_max({c}, date) AS {c}" for c in columns)
    return f"SELECT ticker, CAST(date_trunc('{period}', date) AS DATE) AS date, {last} FROM {source} GROUP BY 1, 2"


for _period, _suffix in (("day", "daily"), ("week", "weekly"), ("month", "monthly")):
    if _period == "day":
        _bands, _macd = "bands", MACD_RANGE
    else:
        _bands = f"({period_last('(SELECT ticker, date, close, middle_band, upper_band, lower_band FROM bands)', BANDS, _period)})"
        _lines = period_last(MACD_RANGE, ("close", "macd_line", "signal_line", "macd_histogram"), _period)
        _macd = f"""(SELECT *, lag(macd_line) OVER ({BY_DATE}) AS prev_macd_line,
                            lag(signal_line) OVER ({BY_DATE}) AS prev_signal_line FROM ({_lines}))"""
    oracle(f"w10_bollinger_signals_{_suffix}", f"SELECT {BAND_OUTPUT} FROM {_bands} WINDOW w AS ({BY_DATE})", "bands")
    oracle(f"w12_macd_signals_{_suffix}", f"SELECT {MACD_OUTPUT} FROM {_macd}", "macd")
oracle(
    "w12_macd_mega_caps",
    f"""
    SELECT m.*, market_cap_category FROM (SELECT {MACD_OUTPUT} FROM daily_macd WHERE date {FROM_TO}) m
    JOIN reliable USING (ticker) WHERE market_cap_category = 'Mega Cap'
    """,
    "daily_macd",
    "reliable",
)
oracle("w11_month_end_changes", f"SELECT ticker, year, month_num, last_date, {rs('close', 'prev_close')} FROM changes", "changes")
oracle("w13_latest_news", "SELECT * REPLACE (CAST(rn AS INTEGER) AS rn) FROM ranked_news WHERE rn <= 3", "ranked_news")
oracle(
    "w14_first_bar_of_month",
    f"""
    SELECT ticker, date, {r('open')} FROM clean_bars
    QUALIFY row_number() OVER (PARTITION BY ticker, date_trunc('month', date) ORDER BY date) = 1
    """,
    "clean_bars",
)
oracle(
    "w15_first_and_last_value",
    f"""
    SELECT DISTINCT ticker, CAST(year(date) AS INTEGER) AS year,
           {r('first_value(open) OVER w', 'first_open')}, {r('last_value(close) OVER w', 'last_close')}
    FROM clean_bars
    WINDOW w AS (PARTITION BY ticker, year(date) ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
    "clean_bars",
)
oracle(
    "w16_best_and_worst_movers",
    f"""
    SELECT side, CAST(position AS INTEGER) AS position, ticker, {r('pct_change')} FROM (
        SELECT 'best' AS side, row_number() OVER (ORDER BY pct_change DESC, ticker) AS position, ticker, pct_change
        FROM newest_changes WHERE pct_change IS NOT NULL
        UNION ALL
        SELECT 'worst', row_number() OVER (ORDER BY pct_change, ticker), ticker, pct_change
        FROM newest_changes WHERE pct_change IS NOT NULL)
    WHERE position <= 10
    """,
    "newest_changes",
)
oracle(
    "w17_out_of_order",
    """
    SELECT * FROM (SELECT *, lag(date) OVER (PARTITION BY ticker ORDER BY arrival) AS prev_date FROM arrivals)
    WHERE date < prev_date
    """,
    "arrivals",
)
oracle(
    "w18_golden_cross",
    f"""
    SELECT ticker, date, {rs('close', 'sma_50', 'sma_200')}, signal, {rs('buy_signal', 'sell_signal')}
    FROM ({crossing('(SELECT ticker, date, close, sma_50, sma_200 FROM sma)', 'sma_50', 'sma_200', 'date')}) WHERE signal IS NOT NULL
    """,
    "sma",
)
fragment("ema_10_only", "SELECT ticker, date, close, ema_10 FROM ema", "ema")
oracle("k1_ordered_ema", f"SELECT ticker, date, {rs('close', 'ema_10')} FROM ema_10_only ORDER BY ticker, date", "ema_10_only")
oracle("k2_top_rows", f"SELECT ticker, date, {r('high')} FROM (SELECT * FROM clean_bars ORDER BY high DESC, ticker, date LIMIT 10)", "clean_bars")
oracle("k3_leading_tickers", "SELECT * FROM leaders", "leaders")


def mentions(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"lower({column}) LIKE '%{w}%'" for w in words) + ")"


oracle(
    "c1_grades_mart",
    f"""
    SELECT *, CASE WHEN {mentions('"newGrade"', K.BUY_GRADE_WORDS)} OR lower(action) LIKE '%{K.BUY_ACTION_WORD}%' THEN 'BUY'
                   WHEN {mentions('"newGrade"', K.HOLD_GRADE_WORDS)} THEN 'HOLD'
                   WHEN {mentions('"newGrade"', K.SELL_GRADE_WORDS)} OR lower(action) LIKE '%{K.SELL_ACTION_WORD}%' THEN 'SELL' END AS sentiment
    FROM (SELECT DISTINCT * FROM raw_grades)
    """,
    "raw_grades",
)
oracle(
    "c2_cents_to_dollars",
    "SELECT o_orderkey, CAST(CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS DECIMAL(16,2)) AS dollars FROM orders",
)
oracle("c3_unpack_bars", f"SELECT {ROUNDED_BAR} FROM daily", "daily")
oracle(
    "c4_period_flags",
    "SELECT ticker, year, month_num, CAST(record_count AS INTEGER) AS days, is_current_month, is_current_year FROM flags",
    "flags",
)

PRICES = rs("open", "high", "low", "close", "volume")
oracle("r1_parse_ticks", f"SELECT symbol, ts, {PRICES}, {r('vwap')}, ingest_id FROM ticks", "ticks")
oracle(
    "r2_series",
    " UNION ALL ".join(
        f"SELECT symbol, ts, '{m}' AS metric, {r(m, 'value')} FROM kept_ticks WHERE {m} IS NOT NULL AND ts <= (SELECT w FROM watermark)"
        for m in ("open", "high", "low", "close", "volume", "vwap")
    ),
    "kept_ticks",
    "watermark",
)
oracle(
    "r3_latest_values",
    f"SELECT symbol, {r('arg_max(close, row(ts, ingest_id))', 'price')}, max(ts) AS ts FROM ticks GROUP BY 1",
    "ticks",
)
oracle(
    "r3_compacted_values",
    f"SELECT symbol, {r('arg_max(close, row(ts, ingest_id))', 'price')}, max(ts) AS ts FROM ticks GROUP BY 1",
    "ticks",
)
oracle("r4_symbols", "SELECT DISTINCT symbol FROM ticks", "ticks")
oracle(
    "r4_symbol_sessions",
    """
    SELECT symbol, min(ts) AS first_seen, max(ts) AS last_seen, count(*) AS ticks
    FROM (SELECT symbol, ts, count(*) FILTER (WHERE fresh) OVER (PARTITION BY symbol ORDER BY ts) AS stretch
          FROM (SELECT symbol, ts, ts - coalesce(lag(ts) OVER (PARTITION BY symbol ORDER BY ts), TIMESTAMP '1900-01-01') > INTERVAL 1 DAY AS fresh FROM ticks))
    GROUP BY symbol, stretch
    HAVING max(ts) + INTERVAL 1 DAY <= (SELECT w FROM watermark)
    """,
    "ticks",
    "watermark",
)
oracle(
    "r5_update_messages",
    f"""
    SELECT 'updates:' || symbol AS channel, symbol, {r('close', 'price')}, epoch_ms(ts) AS timestamp, {r('volume')},
           {r('coalesce(vwap, 0)', 'vwap')}
    FROM ticks
    """,
    "ticks",
)


def tumbling(width_hours: int) -> str:
    return f"time_bucket(INTERVAL {width_hours} HOUR, ts, TIMESTAMP '1970-01-01')"


def sliding(width_hours: int, step_hours: int, source: str) -> str:
    """Every tick once per window it lies in."""
    return f"""
        (SELECT t.*, window_start, window_start + INTERVAL {width_hours} HOUR AS window_end
         FROM (SELECT *, unnest(list_transform(range(0, {width_hours // step_hours}),
                 lambda i: {tumbling(step_hours)} - to_hours(CAST(i AS INTEGER) * {step_hours}))) AS window_start FROM {source}) t)
        """


oracle(
    "r6_active_symbols",
    f"""
    SELECT * FROM (SELECT {tumbling(6)} AS window_start, {tumbling(6)} + INTERVAL 6 HOUR AS window_end,
                          count(DISTINCT symbol) AS active_symbols FROM ticks GROUP BY 1, 2)
    WHERE window_end <= (SELECT w FROM watermark)
    """,
    "ticks",
    "watermark",
)
oracle(
    "r6_active_symbols_approximate",
    f"""
    SELECT * FROM (SELECT DISTINCT {tumbling(6)} AS window_start, {tumbling(6)} + INTERVAL 6 HOUR AS window_end, true AS within_bound FROM ticks)
    WHERE window_end <= (SELECT w FROM watermark)
    """,
    "ticks",
    "watermark",
)
oracle(
    "r6_active_symbols_sketches",
    """
    SELECT hours, time_bucket(to_hours(hours), ts, TIMESTAMP '1970-01-01') AS window_start, count(DISTINCT symbol) AS exact, true AS within_bound
    FROM ticks, (SELECT unnest([6, 24, 168]::INTEGER[]) AS hours)
    WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT w FROM watermark) GROUP BY 1, 2
    """,
    "ticks",
    "watermark",
)
oracle(
    "r7_message_rate",
    f"""
    SELECT * FROM (SELECT window_start, window_end, symbol, count(*) AS messages FROM {sliding(6, 1, 'ticks')} GROUP BY 1, 2, 3)
    WHERE window_end <= (SELECT w FROM watermark)
    """,
    "ticks",
    "watermark",
)


def velocity_sql(source: str) -> str:
    return f"""
        SELECT symbol, ts, price, (price - p) / nullif(p, 0) * 100 / nullif((epoch_ms(ts) - epoch_ms(t)) / 1000.0::DOUBLE, 0) AS velocity
        FROM (SELECT symbol, ts, close AS price, lag(close) OVER w AS p, lag(ts) OVER w AS t
              FROM {source} WINDOW w AS (PARTITION BY symbol ORDER BY ts, ingest_id))
        WHERE ts - t <= INTERVAL {K.VELOCITY_RETENTION}
        """


fragment("velocity", velocity_sql("last_ticks"), "last_ticks")
oracle("r8_velocity", f"SELECT symbol, ts, {rs('price', 'velocity')} FROM velocity", "velocity")
oracle(
    "r8_velocity_stream",
    f"""
    SELECT symbol, ts, {rs('price', 'velocity')} FROM velocity
    WHERE {tumbling(1)} + INTERVAL 1 HOUR <= (SELECT w FROM watermark)
    """,
    "velocity",
    "watermark",
)
oracle(
    "r9_velocity_alerts_stream",
    f"""
    SELECT symbol, ts, {rs('price', 'velocity')} FROM velocity
    WHERE {tumbling(1)} + INTERVAL 1 HOUR <= (SELECT w FROM watermark) AND abs(velocity) > {K.VELOCITY_ALERT_PERCENT}
    """,
    "velocity",
    "watermark",
)
oracle(
    "r9_velocity_alerts",
    f"SELECT symbol, ts, {rs('price', 'velocity')} FROM velocity WHERE abs(velocity) > {K.VELOCITY_ALERT_PERCENT}",
    "velocity",
)
oracle(
    "r10_retention",
    f"SELECT symbol, ts, {r('close')}, ingest_id FROM ticks WHERE ts >= (SELECT max(ts) - INTERVAL 24 HOUR FROM ticks)",
    "ticks",
)
oracle(
    "r11_keep_last",
    f"SELECT symbol, ts, {r('close')}, ingest_id FROM last_ticks WHERE ts <= (SELECT w FROM watermark)",
    "last_ticks",
    "watermark",
)
oracle(
    "r12_tick_candles",
    f"""
    SELECT {tumbling(6)} AS window_start, symbol, {r('arg_min(open, row(ts, ingest_id))', 'open')}, {r('max(high)', 'high')},
           {r('min(low)', 'low')}, {r('arg_max(close, row(ts, ingest_id))', 'close')}, {r('sum(volume)', 'volume')}
    FROM kept_ticks WHERE {tumbling(6)} + INTERVAL 6 HOUR <= (SELECT w FROM watermark) GROUP BY 1, 2
    """,
    "kept_ticks",
    "watermark",
)
oracle(
    "r13_tick_moving_average",
    f"""
    SELECT window_end, symbol, {r('avg(close)', 'average')}, count(*) AS ticks FROM {sliding(6, 2, 'kept_ticks')}
    WHERE window_end <= (SELECT w FROM watermark) GROUP BY 1, 2
    """,
    "kept_ticks",
    "watermark",
)
fragment(
    "batched_ticks",
    """
    SELECT t.*, (SELECT max(ts) - INTERVAL 20 DAY FROM ticks e WHERE ((e.ingest_id - 1) // 2) % 5 < n) AS bound,
           (SELECT max(ts) - INTERVAL 25 DAY FROM ticks e WHERE ((e.ingest_id - 1) // 2) % 5 = n) AS oldest
    FROM (SELECT *, ((ingest_id - 1) // 2) % 5 AS n FROM ticks) t
    """,
    "ticks",
)
oracle(
    "r10_retention_stream",
    f"SELECT symbol, ts, {r('close')}, ingest_id FROM batched_ticks WHERE coalesce(ts >= bound, true) AND ts >= oldest",
    "batched_ticks",
)
oracle(
    "r10_retention_removed",
    f"""
    SELECT symbol, ts, {r('close')}, ingest_id FROM batched_ticks WHERE coalesce(ts >= bound, true) AND ts >= oldest
    AND ts >= (SELECT date_trunc('day', max(ts) - INTERVAL 25 DAY) FROM ticks)
    """,
    "batched_ticks",
)
oracle("r15_late_ticks_stream", "SELECT symbol, count(*) AS late FROM batched_ticks WHERE ts < bound GROUP BY 1", "batched_ticks")
oracle(
    "r15_late_ticks",
    "SELECT symbol, count(*) AS late FROM ticks WHERE ts < (SELECT max(ts) - INTERVAL 20 DAY FROM ticks) GROUP BY 1",
    "ticks",
)


def number_of(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


VOLUME_CHECKS = ", ".join(
    (
        "count(*) AS total_records",
        number_of("volume = 0", "invalid_volume"),
        number_of("transactions = 0", "invalid_transactions"),
        number_of("volume < transactions", "volume_less_than_transactions"),
    )
)
PRICE_CHECKS = ", ".join(
    (
        number_of("high < low", "high_less_than_low"),
        number_of("open > high", "open_above_high"),
        number_of("open < low", "open_below_low"),
        number_of("close > high", "close_above_high"),
        number_of("close < low", "close_below_low"),
        number_of("open <= 0 OR close <= 0 OR high <= 0 OR low <= 0", "negative_prices"),
    )
)


def null_percent(column: str) -> str:
    return r(f"(count(*) - count({column})) * 100.0::DOUBLE / count(*)", f"{column}_null_percentage")


oracle("q1_volume_checks", f"SELECT {VOLUME_CHECKS} FROM dirty_bars", "dirty_bars")
oracle("q2_price_checks", f"SELECT {PRICE_CHECKS} FROM dirty_bars", "dirty_bars")
oracle(
    "q3_timestamp_checks",
    """
    SELECT count(*) FILTER (WHERE date IS NULL) AS null_timestamps, count(*) FILTER (WHERE date < p) AS out_of_order_timestamps
    FROM (SELECT *, lag(date) OVER (PARTITION BY ticker ORDER BY arrival) AS p FROM arrivals)
    """,
    "arrivals",
)
fragment("per_ticker", "SELECT ticker, count(*) AS n FROM clean_bars GROUP BY 1", "clean_bars")
for _name, _measure in (("q4_completeness", "max(n)"), ("q4_completeness_of_all", "sum(n)")):
    oracle(
        _name,
        f"""
        SELECT count(*) AS unique_tickers,
               count(*) FILTER (WHERE n < {K.COMPLETENESS_SHARE}::DOUBLE * (SELECT {_measure} FROM per_ticker)) AS incomplete_tickers
        FROM per_ticker
        """,
        "per_ticker",
    )
_OUTLIER_COLUMNS = ("volume", "open", "close", "high", "low")
_OUTLIERS = (
    "SELECT "
    + ", ".join(
        number_of(f"{c} > {c}_m + 3 * {c}_s OR {c} < {c}_m - 3 * {c}_s", f"{c}_outliers") for c in _OUTLIER_COLUMNS
    )
    + " FROM clean_bars, (SELECT "
    + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in _OUTLIER_COLUMNS)
    + " FROM clean_bars)"
)
oracle("q5_outliers", _OUTLIERS, "clean_bars")
oracle("q5_outliers_of_loads", _OUTLIERS, "clean_bars")
oracle("q6_null_percentages", f"SELECT {', '.join(null_percent(c) for c in _FIELDS)} FROM dirty_bars", "dirty_bars")
_GATE = (
    ("Invalid transactions percentage", "count(*) FILTER (WHERE transactions = 0) * 100.0::DOUBLE / count(*) < 1"),
    ("Volume less than transactions", "count(*) FILTER (WHERE volume < transactions) = 0"),
    ("High less than low", "count(*) FILTER (WHERE high < low) = 0"),
    ("Open above high", "count(*) FILTER (WHERE open > high) = 0"),
    ("Open below low", "count(*) FILTER (WHERE open < low) = 0"),
    ("Close above high", "count(*) FILTER (WHERE close > high) = 0"),
    ("Close below low", "count(*) FILTER (WHERE close < low) = 0"),
    ("Negative prices", "count(*) FILTER (WHERE open <= 0 OR close <= 0 OR high <= 0 OR low <= 0) = 0"),
    *[(f"{c.capitalize()} null percentage", f"count(*) = count({c})") for c in ("ticker", "volume", "open", "high", "low", "close")],
)
oracle(
    "q7_load_gate",
    " UNION ALL ".join(f"SELECT '{name}' AS \"check\", {passed} AS passed FROM dirty_bars" for name, passed in _GATE),
    "dirty_bars",
)
oracle("q8_not_null", f"SELECT ticker, date, {r('open')} FROM dirty_bars WHERE close IS NULL", "dirty_bars")
oracle("q8_unique", "SELECT ticker, count(*) AS n FROM raw_tickers WHERE ticker IS NOT NULL GROUP BY 1 HAVING count(*) > 1", "raw_tickers")
oracle(
    "q8_accepted_values",
    "SELECT \"newGrade\", count(*) AS n FROM raw_grades WHERE \"newGrade\" NOT IN ('Hold', 'Strong Buy') GROUP BY 1",
    "raw_grades",
)
oracle(
    "q9_compound_unique",
    'SELECT ticker, date, "gradingCompany", count(*) AS n FROM raw_grades GROUP BY 1, 2, 3 HAVING count(*) > 1',
    "raw_grades",
)
oracle("q10_at_least", f"SELECT ticker, date, {rs('high', 'low')} FROM dirty_bars WHERE high < low", "dirty_bars")
oracle("q11_is_positive", f"SELECT ticker, date, {r('volume')}, 'warn' AS severity FROM dirty_bars WHERE volume <= 0", "dirty_bars")
oracle("q11_is_even", "SELECT ticker, date, transactions FROM clean_bars WHERE transactions % 2 = 1", "clean_bars")
oracle("q11_is_odd", "SELECT ticker, date, transactions FROM clean_bars WHERE transactions % 2 = 0", "clean_bars")
oracle(
    "q12_array_not_empty",
    """
    SELECT ticker, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month_num FROM daily
    GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE day(date) <= 10) = 0
    """,
    "daily",
)
oracle(
    "q13_value_length",
    "SELECT ticker, year, month_num, record_count FROM months WHERE length(CAST(record_count AS VARCHAR)) NOT BETWEEN 2 AND 31",
    "months",
)
oracle(
    "q14_critical_yesterday",
    f"""
    SELECT ticker, timestamp, {', '.join(f'sma_{n}_is_critical' for n in WINDOWS)} FROM sma_errors
    WHERE timestamp = (SELECT max(timestamp) - 1 FROM sma_errors) AND ({' OR '.join(f'sma_{n}_is_critical' for n in WINDOWS)})
    """,
    "sma_errors",
)
oracle(
    "q15_fill_calendar",
    f"""
    SELECT ticker, CAST(day AS DATE) AS date, {r('close')}, day <> date AS is_filled
    FROM (SELECT ticker, date, close, unnest(generate_series(date, CAST(coalesce(lead(date) OVER ({BY_DATE}) - 1, date) AS DATE), INTERVAL 1 DAY)) AS day
          FROM clean_bars)
    """,
    "clean_bars",
)
oracle(
    "q16_price_jumps",
    f"""
    SELECT ticker, date, {rs('close', 'prev_close', 'jump_percent')} FROM (
        SELECT *, (close / nullif(prev_close, 0) - 1) * 100 AS jump_percent
        FROM (SELECT ticker, date, close, lag(close) OVER ({BY_DATE}) AS prev_close FROM clean_bars))
    WHERE abs(jump_percent) > 50
    """,
    "clean_bars",
)

# Dashboard questions.

fragment("numbered_mart", "SELECT ticker, date, close, rn FROM numbered_daily", "numbered_daily")
ema_fragments("daily_ema", "numbered_mart", (50,), "numbered_mart")
fragment(
    "large_cap_weeks",
    f"""
    SELECT ticker, CAST(date_trunc('week', date) AS DATE) AS date, CAST(year(date) AS INTEGER) AS year,
           max(date) AS last_date, arg_max(close, date) AS close, arg_max(ema_50, date) AS ema
    FROM daily_ema WHERE date {FROM_TO} GROUP BY 1, 2, 3
    """,
    "daily_ema",
)
oracle(
    "d1_moving_average_weekly",
    f"""
    SELECT s.ticker, date, year, {rs('close', 'ema')}, signal, {rs('buy_signal', 'sell_signal')}, market_cap_category
    FROM ({crossing('large_cap_weeks', 'close', 'ema', 'year, last_date')}) s JOIN reliable r ON r.ticker = s.ticker
    WHERE market_cap_category = 'Large Cap'
    """,
    "large_cap_weeks",
    "reliable",
)
fragment(
    "daily_bands",
    f"""
    SELECT ticker, date, close, sma_20 AS middle_band, sma_20 + spread AS upper_band, sma_20 - spread AS lower_band
    FROM (SELECT *, stddev_samp(close) OVER ({BY_DATE} ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) * 2.0::DOUBLE AS spread
          FROM daily_sma WHERE date {FROM_TO})
    """,
    "daily_sma",
)
oracle(
    "d2_bollinger_daily",
    f"""
    SELECT b.*, market_cap_category FROM (SELECT {BAND_OUTPUT} FROM daily_bands WINDOW w AS ({BY_DATE})) b
    JOIN reliable USING (ticker)
    """,
    "daily_bands",
    "reliable",
)
_lines = period_last(
    f"(SELECT * FROM daily_macd WHERE date {FROM_TO})", ("close", "macd_line", "signal_line", "macd_histogram"), "month"
)
oracle(
    "d3_macd_monthly",
    f"""
    SELECT m.*, market_cap_category FROM (
        SELECT {MACD_OUTPUT} FROM (SELECT *, lag(macd_line) OVER ({BY_DATE}) AS prev_macd_line,
                                          lag(signal_line) OVER ({BY_DATE}) AS prev_signal_line FROM ({_lines}))) m
    JOIN reliable USING (ticker) WHERE market_cap_category = 'Mega Cap'
    """,
    "daily_macd",
    "reliable",
)
oracle(
    "d4_dashboard",
    f"""
    SELECT (SELECT CASE WHEN sum(sign(close - prev_close)) > 0 THEN 'Bullish' ELSE 'Bearish' END FROM leader_changes) AS market_sentiment,
           l.ticker AS leader_ticker, {r('l.pct_change', 'leader_change')},
           (SELECT sector FROM sectors ORDER BY avg_change_pct DESC, sector LIMIT 1) AS hottest_sector,
           (SELECT sector FROM sectors ORDER BY avg_change_pct, sector LIMIT 1) AS worst_sector,
           (SELECT ticker FROM movers ORDER BY pct_change DESC, ticker LIMIT 1) AS top_stock,
           (SELECT ticker FROM movers ORDER BY pct_change, ticker LIMIT 1) AS worst_stock,
           (SELECT CAST(count(*) AS INTEGER) FROM movers WHERE CAST(ticker[2:] AS BIGINT) <= 11) AS watched
    FROM (SELECT * FROM leader_changes WHERE pct_change IS NOT NULL ORDER BY pct_change DESC, ticker LIMIT 1) l
    """,
    "leader_changes",
    "sectors",
    "movers",
)
oracle(
    "d5_eps_surprises",
    f"""
    SELECT ticker, date, quarter, {rs('"epsSurprisePercent"')}, quarters_back
    FROM (SELECT e.*, CAST(row_number() OVER (PARTITION BY e.ticker ORDER BY date DESC, quarter DESC) AS INTEGER) AS quarters_back
          FROM earnings e JOIN reliable r ON r.ticker = e.ticker WHERE market_cap_category = 'Mega Cap')
    WHERE quarters_back <= 4
    """,
    "earnings",
    "reliable",
)
oracle(
    "d6_eps_performance",
    f"""
    SELECT b.ticker, b.date, CAST(b."offset" AS INTEGER) AS "offset", b.price_date, {r('b.close', 'close')},
           {r('b.close / nullif(a.close, 0) - 1', 'performance')}
    FROM event_bars b JOIN event_bars a ON a.ticker = b.ticker AND a.date = b.date AND a.quarter = b.quarter AND a."offset" = 0
    WHERE b.quarter = 2 AND year(b.date) = 1997 AND b.ticker IN (SELECT ticker FROM reliable)
    """,
    "event_bars",
    "reliable",
)
oracle(
    "d7_eps_correlation",
    f"""
    SELECT CAST(year(a.date) AS INTEGER) AS year, a.quarter,
           {r('corr(a."epsSurprisePercent", (b.close / nullif(a.close, 0) - 1) * 100)', 'correlation')}, count(*) AS events
    FROM event_bars a JOIN event_bars b ON b.ticker = a.ticker AND b.date = a.date AND b.quarter = a.quarter AND b."offset" = 3
    WHERE a."offset" = 0 AND a.ticker IN (SELECT ticker FROM reliable) GROUP BY 1, 2
    """,
    "event_bars",
    "reliable",
)
fragment(
    "last_year",
    "SELECT d.* FROM daily d, horizon WHERE d.date >= CAST(last_day - INTERVAL 12 MONTH AS DATE)",
    "daily",
    "horizon",
)
oracle(
    "d8_candlestick_weekly",
    f"SELECT c.*, market_cap_category FROM ({candles_sql('last_year', 'week')}) c JOIN reliable USING (ticker)",
    "last_year",
    "reliable",
)
oracle(
    "d9_sma_daily",
    f"""
    SELECT ticker, date, {rs('close', 'sma')}, signal, {rs('buy_signal', 'sell_signal')}, market_cap_category
    FROM ({crossing(f"(SELECT ticker, date, close, sma_20 AS sma FROM daily_sma WHERE date {FROM_TO})", 'close', 'sma', 'date')})
    JOIN reliable USING (ticker)
    """,
    "daily_sma",
    "reliable",
)

oracle(
    "r13_last_points",
    f"""
    SELECT symbol, ts, ingest_id, {r('avg(close) OVER w', 'average')}, count(*) OVER w AS ticks
    FROM last_ticks WINDOW w AS (PARTITION BY symbol ORDER BY ts, ingest_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
    """,
    "last_ticks",
)
oracle(
    "r13_last_points_stream",
    f"""
    SELECT symbol, ts, ingest_id, {r('avg(close) OVER w', 'average')}, count(*) OVER w AS ticks
    FROM last_ticks WHERE ts < (SELECT max(ts) - INTERVAL 20 DAY FROM ticks)
    WINDOW w AS (PARTITION BY symbol ORDER BY ts, ingest_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
    """,
    "ticks",
    "last_ticks",
)
oracle("r14_flush_groups", "SELECT symbol, count(*) AS events, true AS within FROM ticks GROUP BY symbol", "ticks")

# Kept up by loads, a table is what it is when built at once.
for _name, _whole in (
    ("w3_ema_by_loads", "w3_ema"),
    ("w3_ema_missing_closes_by_loads", "w3_ema_missing_closes"),
    ("w4_macd_by_loads", "w4_macd"),
    ("a2_months_by_loads", "a2_cumulated_months"),
    ("a1_splits_by_loads", "a1_split_adjust"),
):
    ORACLE[_name] = ORACLE[_whole]
