"""Explicit schemas, as DDL, of everything that is read from outside."""

# One bar per ticker and trading day.
BARS = (
    "ticker string, volume double, open double, close double, high double, low double, date date, transactions int"
)

# Bulk file of daily bars; window_start counts nanoseconds since the epoch.
BULK_BAR_FILE = (
    "ticker string, volume double, open double, close double, high double, low double, "
    "window_start bigint, transactions int"
)

# One page of a grouped daily response; t counts milliseconds since the epoch.
DAILY_RESPONSE = (
    "results array<struct<T string, v double, o double, c double, h double, l double, t bigint, n int>>"
)

TICKERS = ("ticker string, name string, market string, type string, active boolean")

TICKER_DETAIL_MAP = (
    "map<string, struct<request_id string, "
    "results struct<ticker string, name string, market string, locale string, primary_exchange string, "
    "type string, active boolean, currency_name string, cik string, composite_figi string, "
    "share_class_figi string, market_cap double, phone_number string, "
    "address struct<address1 string, address2 string, city string, state string, postal_code string>, "
    "description string, sic_code string, sic_description string, ticker_root string, homepage_url string, "
    "total_employees int, list_date string, branding struct<logo_url string, icon_url string>, "
    "share_class_shares_outstanding bigint, weighted_shares_outstanding bigint, round_lot int>, "
    "status string>>"
)

NEWS_ITEM = (
    "published_utc string, article_url string, "
    "insights array<struct<ticker string, sentiment string, sentiment_reasoning string>>"
)

EARNINGS_ITEM = (
    "symbol string, year int, date string, hour int, quarter int, epsActual double, epsEstimate double, "
    "revenueActual bigint, revenueEstimate bigint"
)

SURPRISE_ITEM = (
    "symbol string, year int, period string, quarter int, actual double, estimate double, "
    "surprise double, surprisePercent double"
)

GRADE_ITEM = (
    "symbol string, date string, gradingCompany string, previousGrade string, newGrade string, action string"
)

SPLIT_ITEM = ("execution_date string, id string, split_from string, split_to string, ticker string")

EXCHANGE_ITEM = (
    "id int, type string, asset_class string, locale string, name string, operating_mic string, "
    "participant_id string, url string"
)

SEED = ("code string, name string")

# One aggregate per symbol and second, as it comes off the wire.
TICK_EVENT = (
    "symbol string, event_type string, start_timestamp bigint, open double, high double, low double, "
    "close double, volume double, vwap double, ingest_id bigint"
)
