"""Domain tables derived from the generic test tables (rules in FIXTURES.md).

Only integer and IEEE double arithmetic is used, so the SQL side computes the
very same rows.  Nothing is rounded here.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom import constants as K
from tickloom.operators import indicators
from tickloom.plans.marts import Marts
from tickloom.session import use_utc
from tickloom.sources.writers import is_folder


def _ticker(key: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(key.cast("string"), K.TICKER_DIGITS, "0"))


def _pick(key: Column, *values: float | None) -> Column:
    """values[key % len(values)]."""
    return F.element_at(F.array(*[F.lit(v).cast("double") for v in values]), (key % len(values) + 1).cast("int"))


class Tables:
    """Raw sources over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = use_utc(spark)
        self.folder = folder.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def marts(self) -> Marts:
        return Marts(self, apply_split_adjustment=True)

    @cached_property
    def plain_marts(self) -> Marts:
        return Marts(self, apply_split_adjustment=False)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def _supplier_count(self) -> Column:
        return self.read("supplier").agg(F.count("*")).scalar()

    @cached_property
    def keyed_bars(self) -> DataFrame:
        """Bars with the number their ticker is made of."""
        # First and last trade are told by a number made of order key, line,
        # part and price; a number is aggregated by hashing, a struct by sorting.
        line = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("decimal(18,0)")
        cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(10,0)")
        part = F.col("l_partkey").cast("decimal(10,0)") * F.lit(Decimal(10**10)) + cents
        place = (line * F.lit(Decimal(10**20)) + part).cast("decimal(38,0)")
        trades = self.read("lineitem").select(
            F.col("l_suppkey").alias("key"),
            F.to_date("l_shipdate").alias("date"),
            (F.col("l_extendedprice") / F.col("l_quantity") / 100).alias("price"),
            F.col("l_quantity").alias("quantity"),
            place.alias("place"),
        )
        return (
            trades.groupBy("key", "date")
            .agg(
                F.min_by("price", "place").alias("open"),
                F.max("price").alias("high"),
                F.min("price").alias("low"),
                F.max_by("price", "place").alias("close"),
                F.sum("quantity").alias("quantity"),
                F.count("*").alias("transactions"),
            )
            .withColumn("volume", F.col("quantity") * _pick(F.col("key"), 100000, 10000, 1000, 100))
            .withColumn("ticker", _ticker(F.col("key")))
        )

    @cached_property
    def clean_bars(self) -> DataFrame:
        return self.keyed_bars.select(
            "ticker", "volume", "open", "close", "high", "low", "date", "transactions"
        )

    @cached_property
    def bars(self) -> DataFrame:
        """Bars with some untraded and some unreported days."""
        mark = F.col("key") + F.dayofyear("date")
        return self.keyed_bars.select(
            "ticker",
            F.when(mark % 29 == 0, F.lit(0.0)).otherwise(F.col("volume")).alias("volume"),
            "open", "close", "high", "low", "date",
            F.when(mark % 31 != 0, F.col("transactions")).alias("transactions"),
        )

    @cached_property
    def dirty_bars(self) -> DataFrame:
        """Bars with planted faults of every kind the checks look for."""
        mark = F.col("key") * 3 + F.dayofyear("date")
        return self.keyed_bars.select(
            F.when(mark % 101 != 0, F.col("ticker")).alias("ticker"),
            F.when(mark % 29 == 0, F.lit(0.0)).otherwise(F.col("volume")).alias("volume"),
            F.when(mark % 37 == 0, F.col("high") + 1).when(mark % 43 == 0, F.lit(-1.0)).otherwise(F.col("open")).alias("open"),
            F.when(mark % 41 == 0, F.col("low") - 1).when(mark % 59 != 0, F.col("close")).alias("close"),
            F.when(mark % 47 == 0, F.col("low") - 2).otherwise(F.col("high")).alias("high"),
            "low",
            F.when(mark % 53 != 0, F.col("date")).alias("date"),
            F.when(mark % 61 == 0, F.lit(0)).otherwise(F.col("transactions")).alias("transactions"),
        )

    @cached_property
    def tickers(self) -> DataFrame:
        key = F.col("s_suppkey")
        supplier = self.read("supplier")
        listed = supplier.select(
            _ticker(key).alias("ticker"), F.col("s_name").alias("name"), F.lit("stocks").alias("market"),
            F.lit("CS").alias("type"), F.lit(True).alias("active"),
        )
        again = supplier.where(key % 10 == 0).select(
            _ticker(key), F.concat("s_name", F.lit(" again")), F.lit("stocks"), F.lit("CS"), F.lit(False)
        )
        elsewhere = supplier.where(key % 7 == 0).select(
            F.concat(_ticker(key), F.lit(".X")), F.col("s_name"), F.lit("otc"), F.lit("CS"), F.lit(True)
        )
        untyped = supplier.where(key % 11 == 0).select(
            F.concat(_ticker(key), F.lit(".U")), F.col("s_name"), F.lit("stocks"),
            F.lit(None).cast("string"), F.lit(True),
        )
        return listed.union(again).union(elsewhere).union(untyped)

    @cached_property
    def ticker_details(self) -> DataFrame:
        key = F.col("s_suppkey")
        nation = self.read("nation").select("n_nationkey", "n_name")
        joined = self.read("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        return joined.select(
            _ticker(key).alias("ticker"),
            F.lit("CS").alias("type"),
            (_pick(key, 3e11, 5e10, 5e9, 1e9, 1e8, None) + F.col("s_acctbal") * 1e4).alias("market_cap"),
            F.when(key % 17 != 16, F.col("s_nationkey").cast("string")).alias("sic_code"),
            F.col("n_name").alias("sic_description"),
            F.concat(F.lit("icon/"), key.cast("string")).alias("branding_icon_url"),
            F.concat(F.lit("logo/"), key.cast("string")).alias("branding_logo_url"),
            (key % 1000 * 10).cast("int").alias("total_employees"),
            F.col("s_name").alias("name"),
            (key * 1000).alias("share_class_shares_outstanding"),
            (key * 900).alias("weighted_shares_outstanding"),
            F.concat(F.lit("X"), (key % 3).cast("string")).alias("primary_exchange"),
        )

    @cached_property
    def sic_codes(self) -> DataFrame:
        region = self.read("region")
        return self.read("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").alias("code"), F.col("r_name").alias("office"), F.col("n_name").alias("industry")
        )

    @cached_property
    def splits(self) -> DataFrame:
        key = F.col("s_suppkey")
        supplier = self.read("supplier")

        def rows(every: int, from_: int | None, to: int, day: str) -> DataFrame:
            return supplier.where(key % every == 0).select(
                _ticker(key).alias("ticker"), F.lit(from_).cast("int").alias("split_from"),
                F.lit(to).alias("split_to"), F.to_date(F.lit(day)).alias("date"),
            )

        return (
            rows(5, 1, 2, "1998-01-02")
            .union(rows(10, 1, 3, "2000-01-03"))
            .union(rows(20, None, 2, "1999-01-04"))
            .union(rows(15, 1, 0, "1999-06-01"))
        )

    @cached_property
    def exchanges(self) -> DataFrame:
        key = F.col("r_regionkey")
        return self.read("region").select(
            key.alias("id"), F.lit("exchange").alias("type"),
            F.when(key % 2 == 0, "stocks").otherwise("crypto").alias("asset_class"),
            F.lit("us").alias("locale"), F.col("r_name").alias("name"),
            F.concat(F.lit("M"), key.cast("string")).alias("operating_mic"),
            key.cast("string").alias("participant_id"),
            F.concat(F.lit("exchange/"), key.cast("string")).alias("url"),
        )

    @cached_property
    def news(self) -> DataFrame:
        key = F.col("doc_id")
        sentiment = F.when(key % 4 == 0, "positive").when(key % 4 == 1, "negative").when(key % 4 == 2, "neutral")
        return self.read("documents").select(
            _ticker(key % self._supplier_count).alias("ticker"),
            sentiment.otherwise("mixed").alias("sentiment"),
            F.concat_ws(" ", "lang", "source").alias("sentiment_reasoning"),
            F.date_add(F.lit("2001-01-01").cast("date"), (key % 300).cast("int")).alias("date"),
            F.concat(F.lit("doc/"), key.cast("string")).alias("article_url"),
        )

    @cached_property
    def _quarters(self) -> DataFrame:
        return self.keyed_bars.groupBy(
            "key", "ticker", F.year("date").alias("year"), F.quarter("date").alias("quarter")
        ).agg(
            F.max("date").alias("date"),
            F.max_by("close", "date").alias("actual"),
            F.min_by("close", "date").alias("estimate"),
            F.sum("volume").cast("bigint").alias("revenue"),
        )

    @cached_property
    def earnings_calendar(self) -> DataFrame:
        by_quarter = W.partitionBy("ticker").orderBy("year", "quarter")
        odd = (F.col("key") + F.col("year") * 4 + F.col("quarter")) % 23 == 0
        return self._quarters.select(
            "ticker", "year", "date", F.lit(16).alias("hour"), "quarter",
            F.col("actual").alias("epsActual"),
            F.when(odd, F.lit(0.0)).otherwise(F.col("estimate")).alias("epsEstimate"),
            F.col("revenue").alias("revenueActual"),
            F.lag("revenue").over(by_quarter).alias("revenueEstimate"),
        )

    @cached_property
    def earnings_surprises(self) -> DataFrame:
        surprise = F.col("actual") - F.col("estimate")
        missing = (F.col("key") + F.col("quarter")) % 19 == 0
        return self._quarters.where(F.col("year") < 1998).select(
            "ticker", "year", "date", "quarter", "actual", "estimate",
            F.when(~missing, surprise).alias("surprise"),
            (surprise / F.abs("estimate") * 100).alias("surprisePercent"),
        )

    @cached_property
    def grades(self) -> DataFrame:
        """Grades, every fiftieth one delivered twice."""
        names = {"1": "Strong Buy", "2": "Outperform", "3": "Hold", "4": "Underperform", "5": "Strong Sell"}

        def grade(shift: int) -> Column:
            level = F.substring("o_orderpriority", 1, 1).cast("int")
            listed = F.array(*[F.lit(name) for name in names.values()])
            return F.element_at(listed, (level - 1 + shift) % 5 + 1)

        customer = self.read("customer").select("c_custkey", "c_mktsegment")
        joined = self.read("orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
        status = F.col("o_orderstatus")
        rows = joined.select(
            _ticker(F.col("o_custkey") % self._supplier_count).alias("ticker"),
            F.to_date("o_orderdate").alias("date"),
            F.col("c_mktsegment").alias("gradingCompany"),
            grade(1).alias("previousGrade"),
            grade(0).alias("newGrade"),
            F.when(status == "F", "upgrade").when(status == "O", "maintain").otherwise("downgrade").alias("action"),
            F.col("o_orderkey").alias("arrival"),
        )
        copies = F.sequence(F.lit(1), F.when(F.col("arrival") % 50 == 0, 2).otherwise(1))
        return rows.withColumn("_copy", F.explode(copies)).drop("_copy", "arrival")

    @property
    def sparse_grades(self) -> DataFrame:
        """Grades in a world where every thirteenth ticker was never graded."""
        return self.grades.where(F.substring("ticker", 2, K.TICKER_DIGITS).cast("bigint") % 13 != 5)

    @cached_property
    def arrivals(self) -> DataFrame:
        """Dates by order of arrival, some missing."""
        key = F.col("o_orderkey")
        return self.read("orders").select(
            _ticker(F.col("o_custkey") % self._supplier_count).alias("ticker"),
            F.when(key % 97 != 0, F.to_date("o_orderdate")).alias("date"),
            key.alias("arrival"),
        )

    def vendor_values(self, kind: str, bars: DataFrame | None = None) -> DataFrame:
        """A vendor's values of an indicator: ours, off by up to one percent; ``bars`` are clean bars stored already."""
        calculated = {"sma": indicators.sma, "ema": indicators.ema}.get(kind)
        bars = (self.clean_bars if bars is None else bars).withColumn("row", F.row_number().over(W.partitionBy("ticker").orderBy("date")))
        if kind == "wma":
            values = indicators.wma(bars, carry=("row",), warm_only=False)
        else:
            values = calculated(bars, carry=("row",))
        key = F.substring("ticker", 2, K.TICKER_DIGITS).cast("bigint")
        factor = 1.0 + ((key * 31 + F.col("row") * 17) % 21 - 10) / 1003.0
        return values.select(
            "ticker",
            F.col("date").alias("timestamp"),
            *[
                F.when(key % 9 != 0, F.col(f"{kind}_{n}") * factor).alias(f"{kind}_{n}")
                for n in (10, 20, 50, 100, 200)
            ],
        )

    @cached_property
    def tick_events(self) -> DataFrame:
        """Wire events of a symbol per user; some of other types, some delivered twice."""
        return tick_events(self.read("events"))

    def tick_stream(self) -> DataFrame:
        """The same events as a stream over the stored file, or folder of files."""
        path = f"{self.folder}/events.parquet"
        reader = self.spark.readStream.schema(self.read("events").schema)
        if is_folder(self.spark, path):
            stream = reader.parquet(path)
        else:
            stream = reader.option("pathGlobFilter", "events.parquet").parquet(self.folder)
        return tick_events(stream)


def tick_events(events: DataFrame) -> DataFrame:
    number, value = F.col("event_id"), F.col("value")
    copies = F.when(number % 11 == 0, F.lit(2)).otherwise(F.lit(1))
    repeated = events.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    price = F.when(F.col("_copy") == 2, value * 1.001).otherwise(value)
    return repeated.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.when(F.col("event_type") == "error", "T").otherwise("A").alias("event_type"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("start_timestamp"),
        value.alias("open"),
        (value * 1.01).alias("high"),
        (value * 0.99).alias("low"),
        price.alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
        F.when(number % 7 == 0, F.lit(None).cast("double"))
        .when(number % 5 == 0, F.lit(0.0))
        .otherwise(value)
        .alias("vwap"),
        (number * 2 + F.col("_copy")).alias("ingest_id"),
    )
