"""Main text by wrapper induction: parsing, tree matching, planted sites."""

import re

import pytest

from seqscore.llm import wrapper as W
from seqscore.llm.queries import op11_html_extraction

SF = "/root/testdata/sf0.001"


def extracted(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in W.main_text(df).collect()}


def brute_size(a, b):
    """Largest mapping by trying every pairing of the first children."""
    if a[0] != b[0]:
        return 0

    def forest(x, y):
        if not x or not y:
            return 0
        return max(forest(x[1:], y), forest(x, y[1:]), brute_size(x[0], y[0]) + forest(x[1:], y[1:]))
    return 1 + forest(a[1], b[1])


TREES = ["a;", "a(b;c;)", "a(c;b;)", "a(b(c;d;)b(c;)e;)", "a(b(d;)e;b(c;d;))", "a(e;b(c;d;d;)c;)", "x(b;)"]


def test_matching_is_the_largest_mapping():
    for s in TREES:
        for t in TREES:
            a, b = W.read_tree(s), W.read_tree(t)
            assert W.Matching().size(a, b) == brute_size(a, b), (s, t)
        assert W.write_tree(W.read_tree(s)) == s


def test_wrapper_holds_every_tree():
    merged = W.merge_all(TREES[:-1])
    for t in TREES[:-1]:
        place = W.align(t, merged)
        assert -1 not in place and len(set(place)) == len(place)


def test_parser_closes_what_pages_leave_open():
    root, texts, title = W.parse(
        "<title>A &amp; B</title><ul><li>one<li>two &lt;3</ul><p>x<b>y<p>z<br>w</b><table><tr><td>c<td>d</table>"
        "<script>var t='</p><p>no';</script><!-- <p>no --><p>a  &nbsp; b</i></div>tail")
    assert title == "A & B"
    assert [t[1] for t in texts] == ["one", "two <3", "xy", "z w", "c", "d", "a btail"]


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "&", "text only", "<p>" * 3000 + "deep",
                                  "<div>" * 5000 + "deep", "</div></p>", "<a href='x>y", "\x00<p>\x01"])
def test_odd_pages_do_not_crash(page):
    root, texts, _ = W.parse(page or "")
    W.roles(W.numbered(root))


def site(i, body, host="news.example"):
    links = "".join(f"<li><a href='/{j}'>Topic {j} {i}</a></li>" for j in range(4))
    return (i, f"https://{host}/{i}", f"""<html><head><title>Story {i}</title><style>p{{}}</style></head><body class="with-sidebar">
<div class="cookie-notice"><p>We use cookies.</p></div><header><h1>The Daily {i}</h1></header><nav><ul>{links}</ul></nav>
<div id="wrap" class="content-sidebar">{body}</div><div class="sidebar"><p>Most read {i}</p><article>teaser {i}</article></div>
<section id="comments"><article class="comment"><p>I disagree {i}</p></article></section>
<form><p>Sign up {i}</p><input></form><footer>&copy; {i}</footer></body></html>""")


def test_site_with_articles(spark):
    pages = [site(i, f"<article><header class='entry-header'><h1>Title {i}</h1></header><p>First of {i}.<p>Second&nbsp;of {i} "
                     f"<a href=x>link</a>.</p><p>Follow us on every channel.</p><aside>Box {i}</aside></article>")
             for i in range(8)]
    got = extracted(spark, pages)
    for i in range(8):
        assert got[i] == f"Title {i}\n\nFirst of {i}.\n\nSecond of {i} link.", got[i]


def test_site_without_article_elements(spark):
    pages = [(i, f"http://Blog.Example:80/{i}", f"<body><div>Home of blogs</div><div><a href=1>Next {i}</a> <a href=2>Previous "
              f"{i}</a></div><div><h2>On {i}</h2><div>Body of number {i}, long enough.</div></div><div>Legal line</div>")
             for i in range(6)]
    got = extracted(spark, pages)
    for i in range(6):
        assert got[i] == f"On {i}\n\nBody of number {i}, long enough."


def test_copies_make_no_template(spark):
    page = "<title>Same</title><body><div><p>A text that is copied.</p></div></body>"
    pages = [(i, "http://copy.example/x", page) for i in range(40)]
    pages.append((99, "http://copy.example/y", "<title>Other</title><body><div><p>Another text.</p></div></body>"))
    got = extracted(spark, pages)
    assert got.pop(99) == "Another text." and set(got.values()) == {"A text that is copied."}


def test_missing_values_repeats_and_empty_input(spark):
    pages = [(None, None, "<p>x</p>"), (1, None, None), (1, "no url", ""), (2, "http://a.example/", "<p>y</p>"),
             (2, "http://a.example/", "<p>y</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = sorted((str(r.page_id), str(r.url), r.text, r.n_chars) for r in W.main_text(df).collect())
    assert rows == [("1", "None", "", 0), ("1", "no url", "", 0), ("2", "http://a.example/", "y", 1),
                    ("2", "http://a.example/", "y", 1), ("None", "None", "x", 1)]
    assert W.main_text(df.limit(0)).count() == 0


def test_keys_of_any_name(spark):
    df = spark.createDataFrame([(1, "http://a.example/", "<p>y</p>", "t", 3)],
                               "page_id long, url string, html string, host string, tree int")
    out = W.main_text(df, keys=("page_id", "host", "tree"))
    assert out.columns == ["page_id", "host", "tree", "text", "n_chars"]
    assert tuple(out.collect()[0]) == (1, "t", 3, "y", 1)


def test_many_trees_of_one_host(spark):
    """More different trees than one group merges: rounds give one wrapper."""
    pages = [(i, "http://a.example/", f"<title>{i}</title>" + "".join(
        f"<div class='c{chr(97 + b)}'><p>{i} {b}</p></div>" for b in range(8) if i >> b & 1) + "<div class='z'>constant</div>")
        for i in range(1, 256)]
    got = extracted(spark, pages)
    for i in range(1, 256):
        assert got[i] == "\n\n".join(f"{i} {b}" for b in range(8) if i >> b & 1)


def test_query_on_given_pages(spark):
    """Every given page against a plain reading of its fixed layout."""
    import html
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: r for r in op11_html_extraction(spark, SF).collect()}
    assert set(got) == set(pages)
    for i, p in pages.items():
        inner = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<(?:b|br|/b)>", "", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", inner)]
        assert got[i].text == "\n\n".join(b for b in blocks if b)
        assert got[i].n_chars == len(got[i].text) and got[i].url == p.url
