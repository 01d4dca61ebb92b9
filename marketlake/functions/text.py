"""Text columns: urls, pages, keyword searches and JSON."""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .times import column

# Page parts that never belong to the article.
SKIPPED_BLOCKS = frozenset((
    "script", "style", "noscript", "template", "svg", "iframe",
    "nav", "header", "footer", "aside", "figure",
))
RAW_BLOCKS = ("script", "style")  # whose text is no markup: they end at their first end tag
NOTICE = re.compile(r'class="[^"]*\b(?:ad|ads|advert|banner|comment|comments)\b', re.I)
REGIONS = ("article", "main", "body")  # where the article is looked for, in this order
# Tags that end a line of text.
LINE_TAGS = frozenset(
    "p br div section article main h1 h2 h3 h4 h5 h6 li ul ol tr table blockquote pre hr".split()
)
MARKUP = re.compile(r"<!--.*?-->|<(/?)([a-zA-Z][a-zA-Z0-9]*)\b([^>]*)>|<[^>]*>", re.S)
TAG_PATTERN = r"<[^>]*>"
TITLE_PATTERN = r"(?is)<title\b[^>]*>(.*?)</title>"

# Fixed value: the search expression of the economy feed.
ECONOMY_TERMS = ("economy", "inflation", "finance")


def url_domain(url: Column | str) -> Column:
    """Network location with user-info and port; NULL for text that is no url."""
    return F.try_parse_url(column(url), F.lit("AUTHORITY"))


def unescape_all(text: pd.Series) -> pd.Series:
    """All named and numeric character references undone, hard blanks as blanks."""
    return text.map(lambda t: html.unescape(t).replace("\xa0", " ") if t and "&" in t else t)


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    return unescape_all(text)


def _block_end(page: str, start: int, name: str, nested: bool) -> int:
    """Where the element ends whose start tag ends at ``start``, its inner elements of the same
    name counted; -1 if it never does."""
    depth = 1
    for m in re.compile(rf"<(/?){name}\b([^>]*)>", re.I).finditer(page, start):
        if m[1]:
            depth -= 1
        elif nested and not m[2].endswith("/"):
            depth += 1
        if not depth:
            return m.end()
    return -1


def article_lines(page: str | None) -> str | None:
    """The text of a page without markup and without the blocks that are no article, a line end
    at each tag that ends a line.

    A block ends at its own end tag, however many of its name it holds; one that never ends is kept, and after
    it blocks of that name end at the next end tag. Of several articles all are taken and nothing between them;
    without any, the main part, the body, or all there is.
    """
    if page is None:
        return None
    parts: dict[str, list[str]] = {name: [] for name in (*REGIONS, "")}
    inside, broken = dict.fromkeys(REGIONS, 0), set()

    def add(text: str) -> None:
        parts[""].append(text)
        for region in REGIONS:
            if inside[region]:
                parts[region].append(text)

    at = 0
    while m := MARKUP.search(page, at):
        add(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if not m[1] and (name in SKIPPED_BLOCKS or (name == "div" and NOTICE.search(m[3]))):
            end = _block_end(page, at, name, name not in RAW_BLOCKS and name not in broken)
            if end < 0 and name not in broken:
                broken.add(name)
                end = _block_end(page, at, name, False)
            at = max(at, end)
            continue
        if name in inside:
            inside[name] = max(0, inside[name] + (-1 if m[1] else 1))
        if name in LINE_TAGS:
            add("\n")
    add(page[at:])
    texts = ["".join(parts[name]) for name in parts]
    return next((t for t in texts if t.strip()), "")


@F.pandas_udf(StringType())
def article_text(page: pd.Series) -> pd.Series:
    """Main text of pages with all character references undone."""
    return unescape_all(page.map(article_lines))


def _tidy(text: Column) -> Column:
    """Single blanks, no blank lines, nothing around."""
    text = F.regexp_replace(text, r"[ \t\r\f]{2,}|[\t\r\f]", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.nullif(F.btrim(text, F.lit(" \n")), F.lit(""))


def with_article_text(df: DataFrame, page: str, name: str) -> DataFrame:
    """Adds the main text of a page, one line per block; NULL when nothing is left."""
    return df.withColumn(name, _tidy(article_text(page)))


def page_title(page: Column | str) -> Column:
    found = F.regexp_extract(column(page), TITLE_PATTERN, 1)
    return _tidy(unescape(F.regexp_replace(found, TAG_PATTERN, "")))


def word_pattern(terms) -> str:
    """Any of the terms between characters that are no letters or digits of any script."""
    words = "|".join(re.escape(t) for t in terms)
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{words})(?:$|[^\p{{L}}\p{{N}}_])"


def search_or_query(text: Column | str, terms=ECONOMY_TERMS) -> Column:
    """True where any of the words occurs on its own, in any case."""
    return column(text).rlike(word_pattern(terms))


def json_get(text: Column | str, schema) -> Column:
    return F.from_json(column(text), schema)


def json_set(*names: str) -> Column:
    return F.to_json(F.struct(*names))
