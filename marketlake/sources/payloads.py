"""Payloads of the exchange, the news search, the forum and the feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import page_title, url_domain, with_article_text
from ..functions.times import millis_to_second
from ..operators.topk import top_k
from ..schemas import FORUM_LISTING, KLINE_MESSAGE, PRICE, SEARCH_RESPONSE, SYMBOL_NAMES

# Fixed values of the producers.
CANDLE_TAG = "realtime"
COMMENT_TAG = "comment"
FORUM_HOST = "https://reddit.com"
EXTRACTED = "trafilatura"
FALLBACK = "gnews_fallback"
FEED_ITEMS = 10


def symbol_name_lookup(symbol: Column | str, names: dict[str, str] = SYMBOL_NAMES) -> Column:
    """Display name of a symbol; NULL for symbols that are not listed."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), s)


def kline_closed_parse(messages: DataFrame, value: str = "value", names=SYMBOL_NAMES) -> DataFrame:
    """Closed candles among exchange messages; acknowledgements and open candles are left out."""
    text = F.col(value).cast("string")

    def k(key: str) -> Column:
        return F.col("_m.k")[key]

    return (
        messages.withColumn("_m", F.from_json(text, KLINE_MESSAGE))
        .where((F.col("_m.e") == "kline") & (k("x") == "true"))
        .where(~F.coalesce(F.array_contains(F.json_object_keys(text), "result"), F.lit(False)))
        .select(
            F.col("_m.s").alias("symbol"),
            symbol_name_lookup("_m.s", names).alias("name"),
            k("i").alias("interval"),
            k("t").cast("long").alias("starttime"),
            k("T").cast("long").alias("endtime"),
            k("v").alias("volume"),
            k("q").alias("quotevolume"),
            k("o").alias("open"),
            k("c").alias("close"),
            k("h").alias("highest"),
            k("l").alias("lowest"),
            F.lit(CANDLE_TAG).alias("tag"),
        )
    )


def kline_decode(candles: DataFrame, names: dict[str, str] = SYMBOL_NAMES) -> DataFrame:
    """Wire candles to typed ones: names by symbol, whole seconds, decimal prices."""
    prices = ("volume", "quotevolume", "open", "close", "highest", "lowest")
    return candles.withColumns(
        {
            "name": symbol_name_lookup("symbol", names),
            "starttime": millis_to_second("starttime"),
            "endtime": millis_to_second("endtime"),
            **{p: F.col(p).try_cast(PRICE) for p in prices},
        }
    )


def json_articles_flatten(df: DataFrame, value: str = "value", tag: str = "coins_news") -> DataFrame:
    """One row per article of a search response; the text is still the description."""
    keep = [c for c in df.columns if c != value]
    return (
        df.withColumn("_articles", F.from_json(F.col(value), SEARCH_RESPONSE).articles)
        .select(*keep, F.inline("_articles"))
        .select(
            *keep,
            F.col("source.url").alias("domain"),
            "title",
            "url",
            "description",
            F.col("publishedAt").alias("published"),
            F.col("source.name").alias("authors"),
            F.lit(tag).alias("tag"),
        )
    )


def forum_listing_flatten(df: DataFrame, value: str = "value", topic: str = "topic") -> DataFrame:
    """One row per post of a listing; the subreddit is the topic that was asked for."""
    return (
        df.withColumn("_posts", F.from_json(F.col(value), FORUM_LISTING).data.children)
        .select(F.col(topic).alias("subreddit"), F.explode("_posts.data").alias("p"))
        .select(
            "subreddit",
            "p.title",
            "p.author",
            "p.score",
            F.concat(F.lit(FORUM_HOST), F.col("p.permalink")).alias("url"),
            "p.created_utc",
            "p.id",
            F.coalesce("p.selftext", F.lit("")).alias("selftext"),
            "p.num_comments",
            F.lit(COMMENT_TAG).alias("tag"),
        )
    )


def feed_item_topk(
    items: DataFrame, feed: str = "feed", position: str = "position", k: int = FEED_ITEMS
) -> DataFrame:
    """The first ``k`` entries of every feed, in feed order."""
    return top_k(items, [feed], [F.col(position).asc()], k)


def page_article_extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Adds domain, title and main text of every page; the text is NULL when none is found."""
    named = pages.withColumns({"domain": url_domain(url), "title": page_title(html)})
    return with_article_text(named, html, "text")


def text_fallback(df: DataFrame, text: str = "text", description: str = "description") -> DataFrame:
    """Where no text was extracted, take the description and say so in ``source``."""
    extracted = F.nullif(F.col(text), F.lit(""))
    return df.withColumns(
        {
            "source": F.when(extracted.isNotNull(), EXTRACTED).otherwise(FALLBACK),
            text: F.coalesce(extracted, F.col(description)),
        }
    )


def one_author(df: DataFrame) -> DataFrame:
    """``author`` from feeds and ``authors`` from searches brought into one column."""
    present = [c for c in ("author", "authors") if c in df.columns]
    if not present:
        return df.withColumn("author", F.lit(None).cast("string"))
    return df.withColumn("author", F.coalesce(*present)).drop("authors")


def source_union_tagged(sources: dict[str, DataFrame | list[DataFrame]]) -> DataFrame:
    """All sources in one frame, each row tagged with its source; columns go by name."""
    tagged = [
        one_author(df).withColumn("tag", F.lit(tag))
        for tag, dfs in sources.items()
        for df in (dfs if isinstance(dfs, list) else [dfs])
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
