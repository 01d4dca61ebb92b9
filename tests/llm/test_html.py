"""Main text of pages."""

import math
import re
from html import unescape

from marketlake.llm.html import Node, _article, _count, _in_order, _weigh, extracted, main_text, parse
from marketlake.llm.registry import table

NAV = '<nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>'
P = "<p>A sentence of the article that is long enough, number {}.</p>"
BODY = "".join(P.format(k) for k in range(4))
TEXT = " ".join(f"A sentence of the article that is long enough, number {k}." for k in range(4))


def test_given_pages(llm):
    rows = extracted(table(llm, "/root/testdata/sf0.01", "pages")).collect()
    pages = {r["page_id"]: r["html"] for r in table(llm, "/root/testdata/sf0.01", "pages").collect()}
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", pages[r["page_id"]], re.S)[1]
        inner = re.sub(r"</?b>", "", inner)
        assert r["text"] == " ".join(unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert r["n_chars"] == len(r["text"])


def test_density_alone_finds_the_article(llm):
    """The given pages with every element that says what it is made a plain one, and no names."""
    pages = table(llm, "/root/testdata/sf0.01", "pages").collect()
    found = short = 0
    for r in pages:
        wanted = main_text(r["html"])
        plain = re.sub(r"<(/?)(nav|header|footer|aside|article|main|section|form)\b[^>]*>", r"<\1div>", r["html"])
        plain = re.sub(r"<(div|ul|ol|li|p|span|table|h\d)\s[^>]*>", r"<\1>", plain)
        got = main_text(plain)
        assert wanted in got  # never less than the article
        found += got == wanted
        short += got != wanted and len(wanted) < 1000
    assert found >= 0.95 * len(pages) and found + short == len(pages)


def densities(node, share):
    """(tag, chars, density) of ``node`` and all below it, straight from the definition."""
    below = [x for x in node.inside if isinstance(x, Node)]
    inside = [n for x in below for n in everything(x)]
    chars = sum(len(s.strip()) for n in [node, *inside] for s in n.inside if isinstance(s, str))
    links = [n for n in [node, *inside] if n.tag == "a"]
    link_chars = sum(len(s.strip()) for a in links for n in everything(a) for s in n.inside if isinstance(s, str))
    tags, link_tags = max(len(inside), 1), max(sum(n.tag == "a" for n in inside), 1)
    if node.tag == "a":
        link_tags = max(len(inside) + 1, 1)
    density = 0.0
    if chars:
        plain = max(chars - link_chars, 1)
        base = math.log(chars / plain * link_chars + share * chars + math.e)
        density = chars / tags * math.log(max(chars / max(link_chars, 1) * tags / link_tags, 1.0)) / math.log(base)
    return chars, link_chars, density


def everything(node):
    return [node, *(n for x in node.inside if isinstance(x, Node) for n in everything(x))]


def test_the_chosen_element_has_the_largest_sum_of_densities():
    """Densities, sums and the choice once more, element by element without running totals."""
    links = "<ul>" + "".join(f"<li><a href=/{k}>Another story {k}</a></li>" for k in range(9)) + "</ul>"
    page = f"<body><div>{links}</div><div><div>{BODY}<p>With <a href=x>one link</a> inside.</p></div></div><div><span>short</span></div></body>"
    body = parse(page).inside[0]
    body.parent = None
    nodes = _in_order(body)
    _count(nodes)
    _weigh(nodes, body)
    chars, link_chars, _ = densities(body, 0.0)
    share = link_chars / chars
    for n in nodes:
        assert (n.chars, n.link_chars) == densities(n, share)[:2]
        assert math.isclose(n.density, densities(n, share)[2])
        assert math.isclose(n.score, sum(densities(x, share)[2] for x in n.inside if isinstance(x, Node)))
    best = max(nodes, key=lambda n: sum(densities(x, share)[2] for x in n.inside if isinstance(x, Node)))
    assert _article(body, nodes) in (best, best.parent) and main_text(page) == f"{TEXT} With one link inside."


def test_without_article_element():
    page = f"""<html><head><title>t</title></head><body class="home has-sidebar"><div id="wrap"><div class="header">Site</div>{NAV}
      <div class="content">{BODY}</div><div class="sidebar"><p>Look here</p></div><div id="comments"><p>Nice, says a reader.</p></div>
      <div class="ad"><div>Buy</div> now</div><form><input name=q> Search</form><aside>Also</aside></div><footer>(c)</footer></body></html>"""
    assert main_text(page) == TEXT


def test_sections_are_joined_and_link_lists_left_out():
    links = "<ul>" + "".join(f'<li><a href="/{k}">Another story {k}</a></li>' for k in range(9)) + "</ul>"
    page = f"<body>{NAV}<div><section>{BODY}</section><section>{BODY}</section>{links}</div><footer>x</footer>"
    assert main_text(page) == f"{TEXT} {TEXT}"


def thread(tag, n=60):
    one = "<{0} class=comment-body><p>Reader {1} has a long opinion on this, and says so at length.</p></{0}>"
    return "".join(f"<li class=comment>{one.format(tag, k)}</li>" for k in range(n))


def test_long_comment_threads_are_left_out():
    for tag in ("div", "article"):
        for name in ("id=comments", "class='comments-area'", "class=commentList", "class=replies", "id=disqus_thread"):
            comments = f"<div {name}><ol class=comment-list>{thread(tag)}</ol></div>"
            assert main_text(f"<body>{NAV}<div class=content>{BODY}</div>{comments}") == TEXT
            assert main_text(f"<body>{NAV}<main><article>{BODY}</article>{comments}</main>") == TEXT
            assert main_text(f"<body>{NAV}<article class=post>{BODY}{comments}</article>") == TEXT


def test_cards_of_other_pages_are_left_out():
    cards = "".join(f"<article><h3>Story {k}</h3><p>What another story says in one line.</p></article>" for k in range(20))
    assert main_text(f"<body><article>{BODY}</article><div class=related-posts>{cards}</div>") == TEXT
    assert main_text(f"<body><main>{BODY * 20}</main><div class=sidebar>{cards}</div>") == " ".join([TEXT] * 20)


def test_wrappers_with_ambiguous_names_stay():
    for name in ("has-sidebar", "with-related", "comments-closed", "promo wrap"):
        assert main_text(f"<body>{NAV}<div class='{name}'><article class='{name}'>{BODY}</article></div>") == TEXT
        assert main_text(f"<body>{NAV}<div class='{name}'><div>{BODY}</div></div>") == TEXT
    assert main_text(f"<body>{NAV}<ol class=comments>{thread('div', 1)}</ol>").startswith("Reader 0 has")


def test_white_space_inline_elements_and_references():
    page = "<article><h1>T&eacute;st &#8217;</h1><p>a<b>b</b>c&nbsp; &amp;\n d<br>e</p><p>f&lt;g</p><td>h</td></article>"
    assert main_text(page) == "Tést ’ abc & d e f<g h"


def test_broken_pages():
    assert main_text(None) == main_text("") == main_text("<html><body></body></html>") == main_text("<!-- <p>x</p>") == ""
    assert main_text("just text & more &lt;") == "just text & more <"
    assert main_text("<p>one<p>two <a href='x") == "one two"
    assert main_text("<article><p>a < b and <3 and c") == "a < b and <3 and c"
    assert main_text('<article><p title="x>y">a</p><p title=\'">\'>b</p><p class="open>c</p></article>') .startswith("a b")
    assert main_text('<script>var t="</p>";</script><article><p>a</p></article><style>p{}') == "a"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert main_text("</div></p><article></b>x</i></article></article>") == "x"
    assert main_text("<article><p>İİİ<script>x</script>y</article>") == "İİİ y"
    long = "word " * 300_000
    assert main_text(f"<body><article><p>{long}</p></article>") == long.strip()


def test_odd_rows(llm):
    df = llm.createDataFrame(
        [(1, None, "u", "mine"), (1, "<p>x", "u", "mine"), (1, "<p>x", "u", "mine"), (None, "", None, None)],
        "page_id long, html string, url string, text string",
    )
    rows = extracted(df).collect()
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in rows) == [(0, "", 0), (1, "", 0), (1, "x", 1), (1, "x", 1)]
    assert extracted(df.where("false")).collect() == []
