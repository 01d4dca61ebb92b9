"""Table schemas and record contracts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

PRICE = DecimalType(38, 18)
_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
    "price": PRICE,
}


def table(columns: str) -> StructType:
    """A schema from ``name type, name type, ...``."""
    pairs = [part.split() for part in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


PARTITION_COLUMNS = ("year", "month", "day", "hour")
_PARTS = ", year int, month int, day int, hour int"

# --- wire messages -----------------------------------------------------------
# Prices travel as decimal strings, times as epoch milliseconds. The candle is read
# as a map, since it has keys that differ by case only.
KLINE_MESSAGE = StructType(
    [
        StructField("e", StringType()),
        StructField("s", StringType()),
        StructField("k", MapType(StringType(), StringType())),
    ]
)
CANDLE = table(
    "symbol string, name string, interval string, starttime long, endtime long, volume string,"
    " quotevolume string, open string, close string, highest string, lowest string, tag string"
)
SEARCH_RESPONSE = StructType(
    [
        StructField(
            "articles",
            ArrayType(
                StructType(
                    [
                        StructField("title", StringType()),
                        StructField("description", StringType()),
                        StructField("url", StringType()),
                        StructField("publishedAt", StringType()),
                        StructField("source", table("url string, name string")),
                    ]
                )
            ),
        )
    ]
)
FORUM_LISTING = StructType(
    [
        StructField(
            "data",
            StructType(
                [
                    StructField(
                        "children",
                        ArrayType(
                            StructType(
                                [
                                    StructField(
                                        "data",
                                        table(
                                            "title string, author string, score double,"
                                            " permalink string, created_utc double, id string,"
                                            " selftext string, num_comments int"
                                        ),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)

# --- raw records, as they lie in the landing zone ----------------------------
RAW = {
    "news": table(
        "domain string, title string, url string, text string, published string, author string,"
        " authors string, source string, tag string"
    ),
    "comments": table(
        "subreddit string, title string, author string, score double, url string,"
        " created_utc double, id string, selftext string, num_comments int, tag string"
    ),
    "realtimecoin": table(
        "event_id long, symbol string, name string, interval string, starttime string,"
        " endtime string, volume double, quotevolume double, open double, close double,"
        " highest double, lowest double, tag string"
    ),
    "statistic": table(
        "id long, event_id long, endtime string, symbol string, sma20 double, ema12 double,"
        " rsi10 double, macd double, bb double, atr double, va_high double, va_low double,"
        " poc double"
    ),
    "sentiment": table(
        "id long, event_id long, endtime string, rsi_sen string, macd_sen string,"
        " ema_sen string, bb_sen string, sma_sen string, atr_sen string"
    ),
}

# --- operational rows --------------------------------------------------------
EVENT = table(
    "event_id long, symbol string, name string, interval string, starttime timestamp,"
    " endtime timestamp, volume price, quotevolume price, open price, close price,"
    " highest price, lowest price, tag string"
)
EVENT_MAX_CACHE = table("symbol string, max_value double, max_timestamp timestamp")

# --- silver ------------------------------------------------------------------
SILVER = {
    "news": table(
        "domain string, title string, url string, text string, published timestamp,"
        " author string, source string, tag string" + _PARTS
    ),
    "comments": table(
        "subreddit string, title string, author string, score double, url string,"
        " created_utc timestamp, id string, selftext string, num_comments int, tag string" + _PARTS
    ),
    "realtime": table(
        "realtime_id long, symbol string, name string, interval string, starttime timestamp,"
        " endtime timestamp, volume double, quotevolume double, open double, close double,"
        " highest double, lowest double, tag string" + _PARTS
    ),
    "technical": table(
        "id long, realtime_id long, endtime timestamp, symbol string, sma20 double,"
        " ema12 double, rsi10 double, macd double, bb double, atr double, va_high double,"
        " va_low double, poc double" + _PARTS
    ),
    "sentiment": table(
        "id long, realtime_id long, endtime timestamp, rsi_sen string, macd_sen string,"
        " ema_sen string, bb_sen string, sma_sen string, atr_sen string" + _PARTS
    ),
}

# --- gold: one type per key, times stay timestamps ---------------------------
GOLD = {
    "coin_sentiment_statistic": table(
        "id long, coin_id long, realtime_id long, timestamp_id string, endtime timestamp,"
        " rsi10 double, rsi_sen string, macd double, macd_sen string, bolling_band double,"
        " bb_sen string, sma20 double, sma_sen string, ema12 double, ema_sen string,"
        " atr double, atr_sen string, va_high double, va_low double, poc double" + _PARTS
    ),
    "dim_time": table(
        "timestamp_id string, year int, month int, day int, week_of_year int, quarter int,"
        " day_of_week string, is_weekend boolean, datetime timestamp"
    ),
    "dim_news": table(
        "id long, id_topic long, domain string, title string, url string, text string,"
        " published timestamp, timestamp_id string, author string, source string" + _PARTS
    ),
    "dim_comments": table(
        "coin_id long, id_topic long, created_utc timestamp, timestamp_id string, title string,"
        " id_author long, score double, url string, id string, self_text string,"
        " num_comments int" + _PARTS
    ),
    "dim_realtime": table(
        "realtime_id long, coin_id long, interval string, starttime timestamp,"
        " starttime_id string, endtime timestamp, endtime_id string, volume double,"
        " quotevolume double, open double, close double, highest double, lowest double" + _PARTS
    ),
    "author_credit": table("id_author long, author string, credit_score double"),
    "dim_coin": table("coin_id long, symbol string, name string"),
    "dim_topic": table("id_topic long, topic string"),
}
# Author ids are too many for a partition column: comments are split by topic and time.
PARTITIONED_BY = {
    **{f"silver.{name}": PARTITION_COLUMNS for name in SILVER},
    "gold.coin_sentiment_statistic": ("coin_id",),
    "gold.dim_time": ("year", "month"),
    "gold.dim_news": ("id_topic", "year", "month"),
    "gold.dim_comments": ("id_topic", "year", "month"),
    "gold.dim_realtime": PARTITION_COLUMNS,
    "gold.author_credit": (),
    "gold.dim_coin": (),
    "gold.dim_topic": (),
}

# --- fixed values: coins, topics, tags ----------------------------------------
COINS = (
    ("bitcoin", "BTC"),
    ("ethereum", "ETH"),
    ("bnb", "BNB"),
    ("xrp", "XRP"),
    ("solana", "SOL"),
)
SYMBOL_NAMES = {
    "BTCUSDT": "Bitcoin",
    "ETHUSDT": "Ethereum",
    "BNBUSDT": "BNB",
    "SOLUSDT": "Solana",
    "XRPUSDT": "XRP",
}
TOPICS = ("economy", "coin", "politics", "comment")
SOURCE_TAGS = ("economy", "politics", "coin_news", "coins_news")
# Tags of the two coin sources, brought to the topic they belong to.
TOPIC_OF_TAG = {"coin_news": "coin", "coins_news": "coin"}
QUOTE_CURRENCY = "USDT"


# --- contracts -----------------------------------------------------------------
@dataclass(frozen=True)
class Contract:
    """Declared JSON type per property, and the properties that may be absent or NULL."""

    name: str
    properties: dict[str, str]
    optional: frozenset[str] = field(default_factory=frozenset)

    @property
    def required(self) -> list[str]:
        return [p for p in self.properties if p not in self.optional]


def _contract(name: str, columns: str, optional: tuple[str, ...] = ()) -> Contract:
    pairs = [part.split() for part in columns.split(",")]
    return Contract(name, {n: kind for n, kind in pairs}, frozenset(optional))


NEWS_CONTRACT = _contract(
    "news",
    "domain string, title string, url string, text string, published string, author string,"
    " source string, tag string",
    optional=("author",),
)
COMMENTS_CONTRACT = _contract(
    "comments",
    "subreddit string, title string, author string, score number, url string,"
    " created_utc number, id string, selftext string, num_comments integer, tag string",
)
REALTIME_CONTRACT = _contract(
    "realtime",
    "realtime_id number, symbol string, name string, interval string, starttime string,"
    " endtime string, volume number, quotevolume number, open number, close number,"
    " highest number, lowest number, tag string",
)
TECHNICAL_CONTRACT = _contract(
    "technical",
    "id integer, realtime_id integer, endtime string, symbol string, sma20 number,"
    " ema12 number, rsi10 number, macd number, bb number, atr number, va_high number,"
    " va_low number, poc number",
)
SENTIMENT_CONTRACT = _contract(
    "sentiment",
    "id integer, realtime_id integer, endtime string, rsi_sen string, macd_sen string,"
    " ema_sen string, bb_sen string, sma_sen string, atr_sen string",
)


def contract_is_backward(old: Contract, new: Contract) -> bool:
    """True if readers of ``new`` accept every record written under ``old``."""
    for name in new.required:
        if name not in old.properties or name in old.optional:
            return False
    return all(
        old.properties[name] == kind or (old.properties[name] == "integer" and kind == "number")
        for name, kind in new.properties.items()
        if name in old.properties
    )
