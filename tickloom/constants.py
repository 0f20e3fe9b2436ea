"""Fixed values the analytics depend on.

Everything in this module is a given of the domain (window lengths, category
thresholds, word lists): results are only right with exactly these values, so
they are kept together and in natural order.
"""

# Moving-average windows, in trading days.
MA_WINDOWS = (10, 20, 50, 100, 200)

# MACD: fast and slow spans, signal span, and the row on which each recursion
# is seeded.  The seeds are single observations, not averages.
MACD_FAST = 12
MACD_SLOW = 26
MACD_SIGNAL = 9
MACD_SIGNAL_SEED_ROW = 34

# Bollinger defaults.
BOLLINGER_WINDOW = 20
BOLLINGER_WIDTH = 2.0

# Market capitalisation categories: lower bound in dollars, largest first.
CAP_CATEGORIES = (
    ("Mega Cap", 200_000_000_000),
    ("Large Cap", 10_000_000_000),
    ("Mid Cap", 2_000_000_000),
    ("Small Cap", 300_000_000),
)
SMALLEST_CAP_CATEGORY = "Micro Cap"

# Liquidity scores: lower bound of the average daily traded value, best first.
LIQUIDITY_SCORES = (
    (5, 20_000_000),
    (4, 5_000_000),
    (3, 1_000_000),
    (2, 100_000),
)
LOWEST_LIQUIDITY_SCORE = 1

# A ticker is "reliable" with at least this score, cap and daily volume.
RELIABLE_MIN_SCORE = 3
RELIABLE_MIN_CAP = 300_000_000
RELIABLE_MIN_VOLUME = 100_000

# Weights of the overall rank.
RANK_WEIGHT_CAP = 0.6
RANK_WEIGHT_LIQUIDITY = 0.4

# Months of bars that count as recent for liquidity.
LIQUIDITY_MONTHS = 5

# Number of leading tickers the market mood is read from.
LEADING_TICKERS = 20

# Default watchlist.
WATCHLIST = (
    "AAPL", "AMZN", "MSFT", "GOOGL", "META", "TSLA",
    "AMD", "NVDA", "QQQ", "SPY", "IWM", "UBER",
)
DEFAULT_TICKER = "AAPL"
DEFAULT_TREND_DAYS = 30

# Grade words, looked for in this order; a first match wins.
BUY_GRADE_WORDS = (
    "buy", "strong", "outperform", "overweight", "positive",
    "long term buy", "accumulate", "top pick", "conviction buy",
)
BUY_ACTION_WORD = "upgrade"
HOLD_GRADE_WORDS = (
    "hold", "neutral", "equal weight", "market perform", "perform", "in line",
    "peer perform", "sector weight", "sector perform", "mixed", "average",
)
SELL_GRADE_WORDS = (
    "sell", "underperform", "underweight", "reduce",
    "sector underperform", "negative", "below average",
)
SELL_ACTION_WORD = "downgrade"

NEWS_SENTIMENTS = ("negative", "positive", "neutral", "mixed")

# Vendor comparison: an error above this many percent is critical.
DAILY_ERROR_THRESHOLD = 0.5
STRICT_ERROR_THRESHOLD = 0.1

# Real time: alert threshold in percent per second, flush interval,
# message-rate lookback and refresh.
VELOCITY_ALERT_PERCENT = 0.5
FLUSH_INTERVAL = "100 milliseconds"
FLUSH_EVENTS = 100
RATE_LOOKBACK = "60 seconds"
RATE_REFRESH = "10 seconds"
VELOCITY_RETENTION = "24 hours"

# Load gate: share of bars without transactions that is still accepted.
MAX_INVALID_TRANSACTIONS_PERCENT = 1.0
# Share of the fullest ticker's bars below which a ticker is incomplete.
COMPLETENESS_SHARE = 0.9
OUTLIER_SIGMAS = 3.0

# Incremental loads start here when the target is empty.
EPOCH_OF_HISTORY = "1900-01-01"

# Added before a result is rounded for comparison: far below the last digit
# kept, far above the noise of double arithmetic, and no multiple of it.
HAIR = 3.7137e-10

# Digits of the number in a derived ticker; enough for any key of the test tables.
TICKER_DIGITS = 12
