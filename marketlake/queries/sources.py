"""Queries: payloads, pages, contracts and scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..functions import text as tx
from ..runtime import work_dir
from ..schemas import RAW, Contract, table
from ..sinks.files import raw_landing_write
from ..sources import contracts, payloads, raw, tables
from .base import (
    COMMENTS_SQL,
    NEWS_SQL,
    bars,
    bars_sql,
    candles_sql,
    comments,
    load,
    news,
    query,
)

HOUR = datetime(2024, 1, 31, 5)
RAW_COMMENTS = ", ".join(RAW["comments"].names)


@query("raw_json_read", f"SELECT {RAW_COMMENTS} FROM ({COMMENTS_SQL})")
def _(spark, sf):
    """Comments written to an hour folder and read back with their schema."""
    root = work_dir(spark, "raw")
    raw_landing_write(comments(spark, sf), root, "comments", HOUR)
    return raw.raw_json_read(spark, root, "comments", HOUR)


@query("raw_json_rejects", f"""
  SELECT '{{"id":"' || id || '","score":' AS line FROM ({COMMENTS_SQL}) WHERE id IS NOT NULL""")
def _(spark, sf):
    """Comments cut off in the middle, in a folder with whole ones."""
    root = work_dir(spark, "raw")
    raw_landing_write(comments(spark, sf), root, "comments", HOUR)
    cut = comments(spark, sf).where("id IS NOT NULL")
    cut = cut.select(F.concat(F.lit('{"id":"'), F.col("id"), F.lit('","score":')).alias("value"))
    cut.write.mode("append").text(raw.hour_folder(root, "comments", HOUR))
    return raw.raw_json_rejects(spark, root, "comments", HOUR).select("line")


@query("latest_path_partition", """
  SELECT max(CASE WHEN event_type = 'view' THEN date_trunc('second', ts)
                  ELSE date_trunc('hour', ts) END) AS latest FROM events""")
def _(spark, sf):
    """One object name per event: some name the second, some the hour only."""
    second = F.date_format("ts", "yyyy/MM/dd/HH/mm/ss")
    hour = F.concat(F.date_format("ts", "yyyy/MM/dd/HH"), F.lit("/part-0.json"))
    path = F.concat(F.lit("raw/news/"), F.when(F.col("event_type") == "view", second).otherwise(hour))
    return raw.latest_path_partition(load(spark, sf, "events").select(path.alias("path")))


# A message per minute bar, closed or still open, and an acknowledgement per hour bar.
NAMES = {"CLICKUSDT": "Click", "ERRORUSDT": "Error", "VIEWUSDT": "View", "PURCHASEUSDT": "Purchase"}


def messages(spark, sf):
    b = bars(spark, sf)
    millis = lambda ts: F.unix_millis(F.col(ts).cast("timestamp"))
    text = lambda name: F.col(name).cast("string")
    candles = F.format_string(
        '{"e":"kline","s":"%sUSDT","k":{"t":%d,"T":%d,"i":"1m","o":"%s","c":"%s","h":"%s",'
        '"l":"%s","v":"%s","q":"%s","x":%s}}',
        F.upper("symbol"),
        millis("starttime"),
        millis("endtime") - 1,
        *[text(p) for p in ("open", "close", "highest", "lowest", "volume", "quotevolume")],
        (F.col("close") >= F.col("open")).cast("string"),
    )
    acks = F.concat(F.lit('{"result":null,"id":'), F.col("event_id").cast("string"), F.lit("}"))
    return b.select(candles.alias("value")).unionAll(
        bars(spark, sf, "1h").select(acks.alias("value"))
    )


CANDLE_MESSAGES = f"""
  SELECT upper(symbol) || 'USDT' AS symbol,
         CASE symbol WHEN 'click' THEN 'Click' WHEN 'error' THEN 'Error' WHEN 'view' THEN 'View'
                     WHEN 'purchase' THEN 'Purchase' END AS name,
         '1m' AS "interval", epoch_ms(starttime) AS start_ms, epoch_ms(endtime) - 1 AS end_ms,
         volume, quotevolume, open, close, highest, lowest, 'realtime' AS tag
  FROM ({bars_sql()}) WHERE close >= open
"""
PRICES = ("volume", "quotevolume", "open", "close", "highest", "lowest")


@query("kline_closed_parse", f"""
  SELECT symbol, name, "interval", start_ms AS starttime, end_ms AS endtime,
         {", ".join(f"CAST({p} AS VARCHAR) AS {p}" for p in PRICES)}, tag
  FROM ({CANDLE_MESSAGES})""")
def _(spark, sf):
    return payloads.kline_closed_parse(messages(spark, sf), names=NAMES)


@query("kline_decode", f"""
  SELECT symbol, name, "interval", date_trunc('second', make_timestamp(start_ms * 1000)) AS starttime,
         date_trunc('second', make_timestamp(end_ms * 1000)) AS endtime,
         {", ".join(f"CAST({p} AS DOUBLE) AS {p}" for p in PRICES)}, tag
  FROM ({CANDLE_MESSAGES})""")
def _(spark, sf):
    return payloads.kline_decode(payloads.kline_closed_parse(messages(spark, sf), names=NAMES), NAMES)


# Each article answers a search of its own, with a second one that has no description.
def responses(spark, sf):
    source = F.struct(F.col("domain").alias("url"), F.col("source").alias("name"))
    article = lambda title, description: F.struct(
        title.alias("title"),
        description.alias("description"),
        "url",
        F.col("published").alias("publishedAt"),
        source.alias("source"),
    )
    first = article(F.col("title"), F.col("text"))
    second = article(F.concat("title", F.lit(" again")), F.lit(None).cast("string"))
    body = F.to_json(F.struct(F.array(first, second).alias("articles")))
    return news(spark, sf).select(body.alias("value"))


ARTICLES = f"""
  SELECT domain, title, url, text AS description, published, source AS authors FROM ({NEWS_SQL})
  UNION ALL
  SELECT domain, title || ' again', url, NULL, published, source FROM ({NEWS_SQL})
"""


@query("json_articles_flatten", f"SELECT *, 'coins_news' AS tag FROM ({ARTICLES})")
def _(spark, sf):
    return payloads.json_articles_flatten(responses(spark, sf))


@query("text_fallback", f"""
  SELECT a.* EXCLUDE (description), coalesce(nullif(d.text, ''), a.description) AS text,
         CASE WHEN nullif(d.text, '') IS NULL THEN 'gnews_fallback' ELSE 'trafilatura' END AS source
  FROM ({ARTICLES}) a
  LEFT JOIN (SELECT title || ' again' AS title, text FROM ({NEWS_SQL}) WHERE author IS NOT NULL) d
    USING (title)""")
def _(spark, sf):
    """Texts were extracted for the repeated articles of two languages only."""
    extracted = news(spark, sf).where(F.col("author").isNotNull()).select(
        F.concat("title", F.lit(" again")).alias("title"), "text"
    )
    found = payloads.json_articles_flatten(responses(spark, sf)).join(extracted, "title", "left")
    return payloads.text_fallback(found).drop("description", "tag")


def listings(spark, sf):
    c = comments(spark, sf)
    post = F.struct(
        "title",
        "author",
        "score",
        F.concat_ws("/", F.lit("/r"), "subreddit", "id", "num_comments").alias("permalink"),
        "created_utc",
        "id",
        F.when(F.col("subreddit") != "dogecoin", F.col("selftext")).alias("selftext"),
        "num_comments",
    )
    child = F.struct(post.alias("data"))
    listing = F.struct(F.struct(F.array(child).alias("children")).alias("data"))
    return c.select(F.col("subreddit").alias("topic"), F.to_json(listing).alias("value"))


@query("forum_listing_flatten", f"""
  SELECT subreddit, title, author, score,
         'https://reddit.com/r/' || subreddit || '/' || id || '/' || num_comments AS url,
         created_utc, id, CASE WHEN subreddit = 'dogecoin' THEN '' ELSE selftext END AS selftext,
         num_comments, tag FROM ({COMMENTS_SQL})""")
def _(spark, sf):
    return payloads.forum_listing_flatten(listings(spark, sf))


@query("feed_item_topk", """
  SELECT doc_id, source, lang, text FROM documents
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 10""")
def _(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    return payloads.feed_item_topk(docs, "source", "doc_id")


# --- pages -----------------------------------------------------------------------
# Written from what the given pages are: one article element, paragraphs, headings and breaks in it.
def _plain_sql(text: str) -> str:
    for mark in ("<p>", "</p>", "<br>", "<h1>", "</h1>"):
        text = f"replace({text}, '{mark}', chr(10))"
    text = f"replace({text}, '<b>', '')"
    for reference, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        text = f"replace({text}, '{reference}', '{character}')"
    text = f"regexp_replace({text}, '&amp;?', '&', 'g')"
    words = f"list_transform(string_split({text}, chr(10)), lambda l: trim(regexp_replace(l, ' +', ' ', 'g')))"
    return f"nullif(array_to_string(list_filter({words}, lambda l: l <> ''), chr(10)), '')"


PAGES_SQL = f"""
  SELECT page_id, url, split_part(split_part(split_part(split_part(url, '://', 2), '/', 1), '?', 1), '#', 1) AS domain,
         {_plain_sql("split_part(split_part(html, '<title>', 2), '</title>', 1)")} AS title,
         {_plain_sql("split_part(split_part(html, '<article>', 2), '</article>', 1)")} AS text
  FROM pages
"""


@query("page_article_extract", PAGES_SQL)
def _(spark, sf):
    return payloads.page_article_extract(load(spark, sf, "pages")).drop("html")


@query("url_domain", """
  SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain,
         'u:p@' || regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) || ':8080' AS full_domain
  FROM pages""")
def _(spark, sf):
    """The domain of every page, and of the same url with user-info and port put in."""
    pages = load(spark, sf, "pages")
    full = F.regexp_replace("url", r"^([a-z]+://)([^/?#]*)", "$1u:p@$2:8080")
    return pages.select(
        "page_id", tx.url_domain("url").alias("domain"), tx.url_domain(full).alias("full_domain")
    )


@query("source_union_tagged", f"""
  SELECT domain, title, url, text, published, coalesce(author, authors) AS author, source, tag
  FROM ({NEWS_SQL})""")
def _(spark, sf):
    """Four sources, two of them with ``author`` and two with ``authors``."""
    rows = news(spark, sf)

    def source(tag, name):
        other = "authors" if name == "author" else "author"
        return rows.where(F.col("tag") == tag).drop("tag", other)

    return payloads.source_union_tagged(
        {
            "economy": source("economy", "author"),
            "politics": source("politics", "author"),
            "coin_news": source("coin_news", "authors"),
            "coins_news": source("coins_news", "authors"),
        }
    )


PROPS = table("k int")


def event_messages(spark, sf):
    """The payload of every event; those of errors are cut in the middle."""
    cut = F.substring("props", 1, 4)
    value = F.when(F.col("event_type") == "error", cut).otherwise(F.col("props"))
    return load(spark, sf, "events").select("event_id", value.alias("value"))


@query("json_topic_decode", """
  SELECT event_id, CASE WHEN event_type <> 'error'
                        THEN CAST(json_extract_string(props, '$.k') AS INTEGER) ELSE -1 END AS k,
         CASE WHEN event_type = 'error' THEN left(props, 4) END AS broken FROM events""")
def _(spark, sf):
    good, broken = raw.json_topic_decode(event_messages(spark, sf), PROPS)
    return good.withColumn("broken", F.lit(None).cast("string")).unionByName(
        broken.select("event_id", F.lit(-1).alias("k"), F.col("value").alias("broken"))
    )


LINE_CONTRACT = Contract(
    "event",
    {"event_id": "integer", "event_type": "string", "value": "integer", "props": "number"},
    frozenset({"props"}),
)


@query("schema_contract_check", """
  SELECT event_id, CASE WHEN value = floor(value) AND event_type <> 'signup' THEN '' ELSE
           concat_ws(',', CASE WHEN value <> floor(value) THEN 'value:not integer' END,
                          CASE WHEN event_type = 'signup' THEN 'props:not number' END) END AS violations
  FROM events""")
def _(spark, sf):
    """Whole values keep the contract; the payload is a number, but for sign-ups one in quotes."""
    number = F.get_json_object("props", "$.k")
    quoted = F.concat(F.lit('"'), F.coalesce(number, F.lit("")), F.lit('"'))
    props = F.try_parse_json(F.when(F.col("event_type") == "signup", quoted).otherwise(number))
    rows = load(spark, sf, "events").withColumn("props", props)
    valid, rejected = contracts.schema_contract_check(rows, LINE_CONTRACT)
    return valid.select("event_id", F.lit("").alias("violations")).unionByName(
        rejected.select("event_id", F.concat_ws(",", "violations").alias("violations"))
    )


AS_OF = "2024-01-20 12:00:00"


@query("hourly_extract", f"""
  SELECT event_id, ts, event_type, value FROM events
  WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 1 HOUR AND ts < TIMESTAMP '{AS_OF}'""")
def _(spark, sf):
    events = load(spark, sf, "events").select("event_id", "ts", "event_type", "value")
    return tables.hourly_extract(events, AS_OF, "ts")


@query("table_scan", """
  SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'""")
def _(spark, sf):
    orders = tables.table_scan(spark, f"{sf}/orders.parquet", "o_orderstatus = 'F'")
    return orders.select("o_orderkey", "o_custkey", "o_orderdate")


@query("symbol_name_lookup", f"""
  SELECT event_id, upper(symbol) || 'USDT' AS symbol,
         CASE symbol WHEN 'click' THEN 'Click' WHEN 'error' THEN 'Error' WHEN 'view' THEN 'View'
                     WHEN 'purchase' THEN 'Purchase' END AS name FROM ({candles_sql()})""")
def _(spark, sf):
    b = bars(spark, sf).select("event_id", F.concat(F.upper("symbol"), F.lit("USDT")).alias("symbol"))
    return b.withColumn("name", payloads.symbol_name_lookup("symbol", NAMES))
