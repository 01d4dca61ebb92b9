"""Payloads, pages, paths and times on hand-made input."""

import json
import re
from datetime import datetime

from pyspark.sql import functions as F

from marketlake.functions import text, times
from marketlake.schemas import CANDLE, SYMBOL_NAMES, table
from marketlake.sources import payloads, raw


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("x")).first().x


def kline(symbol, closed, start):
    k = {"t": start, "T": start + 999, "i": "1s", "o": "1.10", "c": "1.20", "h": "1.30", "l": "1.00",
         "L": 5, "v": "7", "q": "8.4", "Q": "1", "V": "2", "x": closed}
    return json.dumps({"e": "kline", "E": 1, "s": symbol, "k": k})


def test_only_closed_candles_of_known_messages(spark):
    start = 1_700_000_000_000
    lines = [kline("BTCUSDT", True, start), kline("ETHUSDT", False, start), '{"result":null,"id":1}',
             kline("BTCUSDT", True, start)[:-1] + ', "result": 1}', '{"e":"trade","s":"BTCUSDT"}', '{"e":"kline","s":"X', kline("DOGEUSDT", True, start)[:-1] + ', "note": "\\"result\\""}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    wire = payloads.kline_closed_parse(df)
    assert wire.schema.names == CANDLE.names
    rows = {r.symbol: r for r in payloads.kline_decode(wire).collect()}
    assert set(rows) == {"BTCUSDT", "DOGEUSDT"}
    btc = rows["BTCUSDT"]
    assert btc.name == SYMBOL_NAMES["BTCUSDT"] and rows["DOGEUSDT"].name is None
    assert btc.starttime == btc.endtime == datetime(2023, 11, 14, 22, 13, 20)
    assert (float(btc.close), btc.tag) == (1.2, "realtime")


def test_arrays_and_lines_of_json(spark, tmp_path):
    hour = datetime(2024, 1, 31, 5)
    folder = tmp_path / "comments" / "2024/01/31/05"
    folder.mkdir(parents=True)
    (folder / "051000-a.json").write_text('[{"id":"1","score":2},{"id":"2","selftext":"t"}]')
    (folder / "051500-b.json").write_text('{"id":"3"}\n{"id":"4"}\n')
    rows = raw.raw_json_read(spark, str(tmp_path), "comments", hour)
    assert sorted(r.id for r in rows.collect()) == ["1", "2", "3", "4"]
    assert raw.raw_json_read(spark, str(tmp_path), "comments").count() == 4
    newest = raw.latest_path_partition(raw.object_paths(spark, str(tmp_path))).first().latest
    assert newest == hour


def test_broken_lines_are_rejected_not_read_as_nulls(spark, tmp_path):
    hour = datetime(2024, 1, 31, 5)
    folder = tmp_path / "comments" / "2024/01/31/05"
    folder.mkdir(parents=True)
    (folder / "a.json").write_text('{"id":"1"}\n{"id":"2","score":\n\ntext\n{"id":"3"}\n')
    assert sorted(r.id for r in raw.raw_json_read(spark, str(tmp_path), "comments", hour).collect()) == ["1", "3"]
    rejects = raw.raw_json_rejects(spark, str(tmp_path), "comments", hour).collect()
    assert sorted(r.line for r in rejects) == ["text", '{"id":"2","score":']
    assert all(r.path.endswith("a.json") for r in rejects)


def test_dates_in_all_notations(spark):
    day = datetime(2024, 1, 1)
    wanted = {
        "2024-01-01T05:06:07Z": (5, 6, 7, 0), "2024-01-01T05:06:07+00:00": (5, 6, 7, 0), "2024-01-01T05:06:07.123+00:00": (5, 6, 7, 123000),
        "2024-01-01T05:06:07.123456Z": (5, 6, 7, 123456), "2024-01-01T05:06:07.123456789Z": (5, 6, 7, 123456), "2024-01-01T05:06:07": (5, 6, 7, 0),
        "2024-01-01T05:06:07.123": (5, 6, 7, 123000), "2024-01-01T12:06:07+07:00": (5, 6, 7, 0), "2024-01-01T12:06:07+0700": (5, 6, 7, 0),
        "2024-01-01T12:06:07+07": (5, 6, 7, 0), "2024-01-01 05:06:07": (5, 6, 7, 0), "2024-01-01T05:06Z": (5, 6, 0, 0), "2024-01-01": (0, 0, 0, 0),
        "Mon, 01 Jan 2024 05:06 GMT": (5, 6, 0, 0), "Mon, 01 Jan 2024 05:06:07 GMT": (5, 6, 7, 0), "1 Jan 2024 12:06:07 +0700": (5, 6, 7, 0),
        "Mon, 1 Jan 2024 05:06:07": (5, 6, 7, 0), " 2024-01-01T05:06:07Z ": (5, 6, 7, 0),
    }
    garbage = ["", "soon", "2024", "05:06", "2024-13-01", "2024-01-01T25:00:00Z", "Mon, 99 Jan 2024 05:06 GMT", "2024-01-01Tx", None]
    df = spark.createDataFrame([(x,) for x in [*wanted, *garbage]], "v string")
    rows = {r.v: r for r in df.select("v", times.parse_timestamp("v").alias("t"), times.unreadable_date("v").alias("u")).collect()}
    for text_, (h, m, s, us) in wanted.items():
        assert rows[text_].t == day.replace(hour=h, minute=m, second=s, microsecond=us), text_
        assert not rows[text_].u
    for text_ in garbage:
        assert rows[text_].t is None and rows[text_].u == bool(text_)


def test_dates_keep_their_notations(spark):
    noon = datetime(2024, 1, 1, 12)
    same = ("2024-01-01T12:00 +00", "2024-01-01 19:00+0700", "2024-01-01T04:30-07:30", "2024-01-01 12:00 UTC", "2024-01-01T12:00:00 GMT",
            "1 Jan 2024 07:00 EST", "Monday, 01 jan 2024 19:00 +0700", "Mon 1 Jan 2024 12:00:00 Z")
    none = ("2024-01-01T12:00X", "2024-01-01+07:00", "2024-01-01 12:00:00:00", "-024-01-01T12:00Z", "1 Jan 2024 12:00 +07:00", "1 Jan 2024", "Mo, 1 Jan 2024 12:00",
            "31 Feb 2024 12:00 GMT", "1 Jan 2024 12:00 QQQ", "Mon, , 1 Jan 2024 12:00")
    df = spark.createDataFrame([(x,) for x in same + none], "v string")
    rows = {r.v: r.t for r in df.select("v", times.parse_timestamp("v").alias("t")).collect()}
    assert rows == dict.fromkeys(same, noon) | dict.fromkeys(none)


def test_dates_in_many_columns_are_compiled(spark, capsys):
    # Spark gives up on a method of 64 KB (-1), the machine's compiler on one of 8,000 bytes
    texts = spark.range(1).select(*[F.concat(F.lit(n), F.col("id").cast("string")).alias(n) for n in "abcdefghijklmn"])
    texts.select(*[times.parse_timestamp(n).cast("timestamp_ntz").alias(n) for n in texts.columns]).explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(-?\d+)", capsys.readouterr().out)]
    assert sizes and all(0 < n < 8000 for n in sizes)


def test_texts_are_no_numbers_in_a_contract(spark):
    from marketlake.schemas import Contract
    from marketlake.sources.contracts import schema_contract_check

    contract = Contract("x", {"a": "number", "b": "integer", "c": "string"})
    rows = [(1, '{"a":1.5,"b":2,"c":"x"}'), (2, '{"a":"1.5","b":2,"c":"x"}'), (3, '{"a":1,"b":2.5,"c":"x"}'), (4, '{"a":1,"b":2,"c":3}')]
    df = spark.createDataFrame(rows, "i int, v string").withColumn("v", F.parse_json("v"))
    cells = df.select("i", *[F.variant_get("v", f"$.{n}", "variant").alias(n) for n in "abc"])
    good, bad = schema_contract_check(cells, contract)
    assert [r.i for r in good.collect()] == [1]
    assert {r.i: r.violations for r in bad.collect()} == {2: ["a:not number"], 3: ["b:not integer"], 4: ["c:not string"]}
    typed = spark.createDataFrame([(float("nan"), 1, "x"), (1.0, 1, "x")], "a double, b long, c string")
    assert schema_contract_check(typed, contract)[0].count() == 1
    text_ = spark.createDataFrame([("1.5", 1, "x")], "a string, b long, c string")
    assert schema_contract_check(text_, contract)[0].count() == 0


def test_no_path_names_a_time(spark):
    paths = spark.createDataFrame([("raw/news/readme",), ("raw/9999/99/99/99/x",)], "path string")
    assert raw.latest_path_partition(paths).first().latest is None


def test_broken_messages_are_kept_apart(spark):
    lines = ['{"a":1,"b":"x"}', '{"a":1,', "text", '{"b":"y"}', None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string")
    good, broken = raw.json_topic_decode(df, table("a int, b string"))
    assert sorted((r.i, r.a, r.b) for r in good.collect()) == [(0, 1, "x"), (3, None, "y")]
    assert sorted(r.i for r in broken.collect()) == [1, 2, 4]


def test_articles_listings_and_fallback(spark):
    body = json.dumps({"articles": [
        {"title": "t", "description": "d", "url": "u", "publishedAt": "p", "source": {"url": "s", "name": "n"}},
        {"title": "t2", "url": "u2"}]})
    found = payloads.json_articles_flatten(spark.createDataFrame([(body,), ("{}",)], "value string"), tag="economy")
    rows = {r.title: r for r in found.collect()}
    assert (rows["t"].domain, rows["t"].authors, rows["t"].published, rows["t"].tag) == ("s", "n", "p", "economy")
    assert rows["t2"].domain is None
    texts = payloads.text_fallback(found.withColumn("text", F.when(F.col("title") == "t2", "").otherwise("full")))
    assert {r.title: (r.text, r.source) for r in texts.collect()} == {
        "t": ("full", payloads.EXTRACTED), "t2": (None, payloads.FALLBACK)}
    post = {"title": "q", "permalink": "/r/x/1", "id": "9", "created_utc": 1.7e9, "num_comments": 3}
    listing = json.dumps({"data": {"children": [{"data": post}, {"data": {**post, "selftext": "s"}}]}})
    posts = payloads.forum_listing_flatten(spark.createDataFrame([("bnb", listing)], "topic string, value string"))
    assert [(r.subreddit, r.selftext, r.tag) for r in posts.orderBy("selftext").collect()] == [
        ("bnb", "", "comment"), ("bnb", "s", "comment")]


def page_text(spark, html):
    pages = spark.createDataFrame([("https://a.example.com/x", html)], "url string, html string")
    return payloads.page_article_extract(pages).first().text


def test_page_text(spark):
    page = """<html><head><title>A &amp; B</title><style>p{}</style></head><body><nav><a>menu</a></nav>
    <div class="x ad"><p>buy</p></div><article><h1>Head</h1><p>One &lt;two&gt;<br>three</p><!-- no -->
    <script>var t="<p>no</p>";</script><div class="comments">first!</div></article><footer>end</footer></body></html>"""
    assert page_text(spark, page) == "Head\nOne <two>\nthree"
    assert one(spark, page, text.page_title) == "A & B"
    assert page_text(spark, "<p>bare</p>") == "bare"
    assert page_text(spark, "<html><body><nav>x</nav></body></html>") is None
    assert page_text(spark, None) is None
    assert page_text(spark, "a &amp;lt; b") == "a &lt; b"
    assert page_text(spark, "<body><form><p>all in a form</p></form></body>") == "all in a form"
    assert page_text(spark, "<p>it&#8217;s &mdash; &eacute;&#xe9; &hellip;&nbsp;x</p>") == "it’s — éé … x"


def test_nested_blocks_and_several_articles(spark):
    ad = '<div class="ad"><div><div>buy</div>now</div><p>cheap</p></div>'
    page = f"<body><p>before</p><article><p>One</p>{ad}<p>two</p></article><p>between</p><article>Three<article>four</article></article><p>after</p></body>"
    assert page_text(spark, page) == "One\ntwo\nThree\nfour"
    assert page_text(spark, "<nav><ul><nav>in</nav>still</ul></nav><p>text</p>") == "text"
    assert page_text(spark, "<script>if (a < b) '<script>'</script><p>text</p>") == "text"
    # blocks that never end are kept, and those of their name after them end where they can
    assert page_text(spark, '<p>a</p><div class="ad"><div>b</div><p>c</p>') == "a\nc"
    assert page_text(spark, "<p>a</p><aside>b<p>c</p>") == "a\nb\nc"
    assert page_text(spark, "<main>m<article></article></main>") == "m"
    assert page_text(spark, "<aside>" * 3000 + "x") == "x"


def test_domains(spark):
    assert one(spark, "https://u:p@host.example.com:8080/a?b#c", text.url_domain) == "u:p@host.example.com:8080"
    assert one(spark, "no url at all", text.url_domain) is None


def test_words_stand_alone(spark):
    found = lambda t: one(spark, t, text.search_or_query)
    assert found("The Economy grows") and found("inflation") and not found("economyx refinanced éfinance")


def test_times(spark):
    at = datetime(2024, 1, 5, 6, 7, 8)
    for written in ("2024-01-05T06:07:08Z", "2024-01-05T06:07:08.000Z", "2024-01-05T13:07:08+07",
                    "Fri, 05 Jan 2024 06:07:08 GMT", "Fri, 05 Jan 2024 06:07:08 +0000", "2024-01-05 06:07:08"):
        assert one(spark, written, times.parse_timestamp) == at, written
    for garbage in ("", "soon", None, "2024-13-45T00:00:00Z"):
        assert one(spark, garbage, times.parse_timestamp) is None
    assert one(spark, "1.7e9", times.epoch_to_timestamp) == one(spark, "1.7e12", times.epoch_to_timestamp)
    assert one(spark, "1e30", times.epoch_to_timestamp) is None
    local = spark.sql("SELECT TIMESTAMP'2024-01-05 20:00:00' AS t").select(times.display_timezone("t").alias("x"))
    assert local.first().x == datetime(2024, 1, 6, 3)


def test_sources_with_both_author_columns(spark):
    feeds = spark.createDataFrame([("a", "ann")], "title string, author string")
    search = spark.createDataFrame([("b", "bob", "d")], "title string, authors string, domain string")
    found = payloads.source_union_tagged({"economy": [feeds, search], "coin_news": feeds})
    assert sorted((r.title, r.author, r.tag) for r in found.collect()) == [
        ("a", "ann", "coin_news"), ("a", "ann", "economy"), ("b", "bob", "economy")]
