"""Wrapper inference and the main text of pages."""

import re
from pathlib import Path

import pytest

from bazaarlake.llm import queries, wrappers
from bazaarlake.llm.wrappers import Wrapper, align, fold, main_text, shown, tidy

FOLDER = "/root/testdata/sf0.01"


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_repeats_fold():
    assert fold(list("abcbcbcd")) == ["a", ["+", ["b", "c"]], "d"]
    assert fold(list("aab") * 3) == [["+", [["+", ["a"]], "b"]]]
    assert fold(list("abc")) == list("abc") and fold([]) == []


def test_mismatches_become_groups():
    assert align(list("abc"), list("ac")) == ["a", ["?", ["b"]], "c"]
    assert align(list("ac"), list("axc")) == ["a", ["?", ["x"]], "c"]
    assert align(fold(list("abbbc")), list("abc")) == ["a", ["+", ["b"]], "c"]
    both = align(["a", "x", "c"], ["a", "y", "c"])
    assert both == ["a", ["?", ["x"]], ["?", ["y"]], "c"]
    assert align(both, ["a", "x", "c"]) == both


def matches(items, stream):
    """Whether the wrapper, as a regular expression, covers a token stream."""
    names = {}
    sign = lambda t: names.setdefault(t, chr(0x4E00 + len(names)))

    def pattern(parts):
        return "".join(f"(?:{pattern(x[1])}){x[0]}" if isinstance(x, list) else sign(x)
                       for x in parts)

    return re.fullmatch(pattern(items), "".join(map(sign, stream))) is not None


def test_wrappers_cover_their_pages():
    streams = [list("abcbcd"), list("abcd"), list("aed"), list("abxcd"), list("abcbcbcedd"),
               list("a"), list("fabcd")]
    items = tidy(fold(streams[0]))
    for stream in streams[1:]:
        items = align(items, tidy(fold(stream)))
    assert all(matches(items, s) for s in streams), shown(items)


def test_wrapper_stays_small():
    wrapper = Wrapper()
    for i in range(120):
        body = "".join(f"<p>{'<b>x</b>' * (i * k % 3)}t{'<br>' * (k % 2)}</p>" for k in range(i % 9))
        wrapper.add_page(page(f"<nav>m</nav><article>{body}</article>"))
    assert len(shown(wrapper.items)) < 400
    assert wrapper.roots() == ["article"] or wrapper.roots() == ["article", "html body"]


def roots(*pages):
    wrapper = Wrapper()
    for p in pages:
        wrapper.add_page(p)
    return wrapper.roots()


BOILERPLATE = [
    "<nav><a>menu</a></nav>", "<header>head</header>", "<footer>foot</footer>",
    "<aside>side</aside>", '<div class="sidebar">side</div>', '<div id="cookie-notice">c</div>',
    '<div class=ad>buy</div>', "<form><p>f</p><button>b</button></form>",
    "<script>var a='<p>s</p>';</script>", "<style>p{}</style>", "<!-- <p>c</p> -->",
    '<section class="comments"><article><p>first!</p></article></section>',
    '<div role="navigation">n</div>', "<noscript>n</noscript>", "<textarea>t</textarea>",
    '<div id="comments"><p>c</p></div>', "<select><option>o</select>"]


@pytest.mark.parametrize("extra", BOILERPLATE)
@pytest.mark.parametrize("root", ["article", "main", "div"])
def test_only_the_article(extra, root):
    body = f"{extra}<{root}><h1>Title</h1>{extra}<p>One &amp; two</p>{extra}</{root}>{extra}"
    html = page(body)
    assert main_text(html, roots(html)) == "Title\n\nOne & two"


def test_blocks_and_white_space():
    body = ("<article>a <b>b</b>\n\tc&nbsp;&#x41;<p>d<br>e<p>f<ul><li>g<li>h</ul>"
            "<div> </div>i</article>")
    assert main_text(page(body), roots(page(body))) == "a b c A\n\nd e\n\nf\n\ng\n\nh\n\ni"


def test_broken_pages():
    for html in ("<article><p>a", "<article><p>a</p", "<article><p>a<!-- b", "</div></b>"
                 "<article></i><p>a</article></article>", "<article><p>a<script>var x",
                 "<article><p title='>'>a</p>"):
        assert main_text(html, roots(html)) == "a", html
    assert main_text("a < b", roots("a < b")) == "a < b"
    assert main_text(None, None) == main_text("", []) == ""


def test_template_text_is_left_out():
    pages = [page(f"<div id=top>Our site</div><div id=body><p>Story {i}</p></div>")
             for i in range(4)]
    assert [main_text(p, roots(*pages)) for p in pages] == [f"Story {i}" for i in range(4)]


def test_pages_without_article_on_a_host_with_articles():
    pages = [page("<article>a</article>"), page("<div>plain</div>")]
    assert [main_text(p, roots(*pages)) for p in pages] == ["a", "plain"]


def extracted(spark, pages):
    """Main text of pages of one host, in their order."""
    rows = [(i, f"http://a.com/{i}", p) for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    out = wrappers.extract_main_text(df, "url", "html").collect()
    return [r.text for r in sorted(out, key=lambda r: r.page_id)]


def test_matcher_gives_places():
    items = ["a", ["+", [["?", ["b"]], ["?", ["c"]]]], ["?", ["b", "d"]], "e"]
    found = wrappers.Matcher(items)
    assert found.names == ["a", "b", "c", "b", "d", "e"]
    assert found.match(list("abcbde")) == [0, 1, 2, 3, 4, 5]
    assert found.match(list("ae")) == [0, 5] and found.match(list("abce")) == [0, 1, 2, 5]
    assert found.match(list("ade")) is None and found.match(list("ab")) is None
    assert wrappers.Matcher([]).match([]) == []


def test_template_inside_the_article(spark):
    """Template text that no class list names goes, at any length; what varies stays."""
    letter = "Get our letter every week. " * 40
    pages = [page(f"<article><h1>Title</h1><p>Story {i}</p><div class=newsletter><p>{letter}</p>"
                  f"</div><div class=more><p>More {i}</p></div></article>") for i in range(4)]
    assert extracted(spark, pages) == [f"Title\n\nStory {i}\n\nMore {i}" for i in range(4)]
    pages = [page(f"<div id=top><p>{letter}</p></div><div id=body><p>Story {i}</p></div>")
             for i in range(4)]
    assert extracted(spark, pages) == [f"Story {i}" for i in range(4)]


def test_copies_of_a_page_keep_their_text(spark):
    pages = [page(f"<nav>{i}</nav><div id=body><p>Story</p></div>") for i in range(5)]
    assert extracted(spark, pages) == ["Story"] * 5
    pages = [page("<div id=body><p>Story</p></div>")] * 5
    assert extracted(spark, pages) == ["Story"] * 5


def test_slots_tell_equal_paths_apart(spark):
    """The wrapper's place, not the path of tags alone, names a slot."""
    pages = [page(f"<div><p>Our site</p></div><hr><div><p>Story {i}</p></div>") for i in range(4)]
    assert extracted(spark, pages) == [f"Story {i}" for i in range(4)]


def test_frames(spark):
    rows = [(1, "http://a.com/1", page("<article><p>x</p></article>")), (2, None, None),
            (3, "http://a.com/2", ""), (4, None, page("<article>y</article>")),
            (5, "http://b.com/", page("<article>" + "<p>long</p>" * 20000 + "</article>")),
            (1, "http://a.com/1", page("<article><p>x</p></article>"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "1 AS text", "2 AS host", "3 AS roots", "4 AS `odd.name`")
    out = wrappers.extract_main_text(df, "url", "html")
    got = sorted((r.page_id, r.text, r.n_chars) for r in out.collect())
    long = "\n\n".join(["long"] * 20000)
    assert got == [(1, "x", 1), (1, "x", 1), (2, "", 0), (3, "", 0), (4, "y", 1),
                   (5, long, len(long))]
    assert wrappers.extract_main_text(df.limit(0), "url", "html").count() == 0
    merged = {r.host: r.pattern for r in wrappers.infer_wrappers(df, "url", "html").collect()}
    assert merged["a.com"] == "(<html> <head> </head> <body> <article> <p> # </p> </article> " \
        "</body> </html>)?" or "<article>" in merged["a.com"]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")
def test_whole_table(spark):
    """Every page's text equals that of a plain search of its article's tags."""
    import html

    pages = {r.page_id: r for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = queries.op5_html_extraction(spark, FOLDER).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search("<article>(.*)</article>", pages[row.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>|<br>", " ", x)).split())
                  for x in re.split("</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b) and row.n_chars == len(row.text)
