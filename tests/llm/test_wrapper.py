import pytest
from pyspark.sql import functions as F

from quillgrid.llm import wrapper
from quillgrid.llm.wrapper import Page, extract, extract_chunk, match


def page(body, title="t"):
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style></head><body><nav><a href=/>Menu</a></nav>"
        f"<div class='ad top'>Buy</div>{body}<footer>&copy; x</footer><script>var t='<p>no</p>'</script></body></html>"
    )


def texts(spark, htmls, url="https://Host.example/{}"):
    df = spark.createDataFrame([(i, url.format(i), h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract(df).collect()}


def test_article_blocks_references_and_white_space(spark):
    html = page("<article><h1>A &amp; B</h1><p><b>one\n two<br>three<p>x&nbsp;&lt;y&gt;<ul><li>l1<li>l2</ul><form>f</form>"
                "<div id='comments'><p>c</p></div></article><aside>s</aside>")
    assert texts(spark, [html, None, ""]) == {0: "A & B\n\none two three\n\nx <y>\n\nl1\n\nl2", 1: "", 2: ""}


def test_constant_slots_go_and_varying_slots_stay(spark):
    body = "<div><p>Welcome to our site</p><div><h1>Title {0}</h1><p>Text {0} of some length, again and again.</p></div><p>Share this!</p></div>"
    htmls = [page(body.format(i)) for i in range(9)]
    found = texts(spark, htmls)
    assert found == {i: f"Title {i}\n\nText {i} of some length, again and again." for i in range(9)}


def test_copies_of_one_page_keep_their_text(spark):
    same = page("<article><p>All the same text</p></article>")
    assert set(texts(spark, [same] * 9).values()) == {"All the same text"}
    near = [page("<article><p>All the same text, over and over.</p></article>", title=str(i)) for i in range(9)]
    assert set(texts(spark, near).values()) == {"All the same text, over and over."}


def test_small_chunks_hot_hosts_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "CHUNK", 3)
    df = spark.createDataFrame(
        [(i, None if i % 7 == 0 else "http://h/", page(f"<main><p>n{i}</p></main>"), "mine", i) for i in range(60)],
        "page_id long, url string, html string, text string, _host int",
    )
    found = extract(df)
    assert sorted(found.columns) == ["_host", "page_id", "text", "url"]
    assert {r.page_id: (r.text, r["_host"]) for r in found.collect()} == {i: (f"n{i}", i) for i in range(60)}
    assert extract(df.where("false")).count() == 0


def test_very_long_and_broken_pages():
    many = "".join(f"<p>p{i}" for i in range(3000))
    deep = "<div>" * 300 + "deep" + "</div>" * 300
    broken = "<article><p>a<b>b</p>c<table><tr><td>d<td>e<!-- x --></table> <![CDATA[ <p"
    found = extract_chunk([page(f"<article>{many}</article>"), page(deep), broken, "plain &amp; simple"])
    assert found[0].split("\n\n") == [f"p{i}" for i in range(3000)] and found[1] == "deep"
    assert found[2].split("\n\n")[:2] == ["ab", "c"] and found[3] == "plain & simple"


@pytest.mark.parametrize("a, b, size", [
    ("<p>x<p>y", "<p>z", 2), ("<div><p>1</div><p>2", "<p>2", 2), ("<div><p><ul><li>", "<div><ul><li><li>", 4), ("<p>", "<div>", 1),
])
def test_simple_tree_matching(a, b, size):
    assert match(Page(a).root, Page(b).root)[0] == size
    assert len(match(Page(a).root, Page(b).root)[1]) == size


def test_many_copies_of_a_page_are_stripped_alike(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "CHUNK", 20)
    body = "<div><p>Welcome to our site</p><div><h1>Title {0}</h1><p>Text {0} of some length, again and again.</p></div><p>Share this!</p></div>"
    want = "Title {0}\n\nText {0} of some length, again and again."
    numbers = [*range(9), *[3] * 70, *[5] * 8]
    found = texts(spark, [page(body.format(i)) for i in numbers])
    assert found == {k: want.format(i) for k, i in enumerate(numbers)}


def test_the_last_pages_of_a_host_have_a_wrapper(spark, monkeypatch):
    monkeypatch.setattr(wrapper, "CHUNK", 20)
    body = "<div><p>Welcome to our site</p><div><h1>Title {0}</h1><p>Text {0} of some length, again and again.</p></div><p>Share this!</p></div>"
    for n in (21, 22, 43):
        found = texts(spark, [page(body.format(i)) for i in range(n)])
        assert found == {i: f"Title {i}\n\nText {i} of some length, again and again." for i in range(n)}


def test_template_longer_than_the_article_goes():
    body = "<div><p>" + "Welcome to our site. " * 20 + "</p><div><p>Short text {0}.</p><p><a href=/>A linked paragraph {0}</a></p></div><p>Share this!</p></div>"
    found = extract_chunk([page(body.format(i)) for i in range(9)])
    assert found == [f"Short text {i}.\n\nA linked paragraph {i}" for i in range(9)]
    near = [page(body.format(1), title=str(i)) for i in range(50)]
    assert extract_chunk([*near, *(page(body.format(i)) for i in range(2, 9))])[49] == "Short text 1.\n\nA linked paragraph 1"


def test_long_lists_of_children_are_aligned_exactly(monkeypatch):
    one = "<ul>" + "<li>" * 3 + "<p>" * 150 + "<li><p>" + "<h2>" * 120 + "<li>" * 9
    two = "<ul>" + "<h2>" + "<li>" * 5 + "<p>" * 170 + "<h3><li><p>" + "<h2>" * 100 + "<p>" * 7
    trees = Page(one.replace("<", "x<")).root, Page(two.replace("<", "x<")).root
    whole = match(*trees)
    monkeypatch.setattr(wrapper, "CELLS", 50)
    halved = match(*trees)
    assert halved[0] == whole[0] == len(halved[1]) == len(whole[1])
    body = "<div>{0}" + "<p>Same text</p>" * 40 + "{1}" + "<h2>Other text</h2>" * 40 + "<p>News {2}</p></div>"
    pages = [body.format("<h3>a</h3>" * (i % 2), "<h3>b</h3>" * (i % 3), i) for i in range(9)]
    assert not any("Same text" in t or "Other text" in t for t in extract_chunk(pages))


def test_pages_nested_very_deep():
    deep = "<div><p>Welcome to our site</p>" + "<div>" * 5000 + "<p>deep {0}" + "<blockquote>" * 5000 + "end {0}"
    assert extract_chunk([page(deep.format(i)) for i in range(5)])[3].split("\n\n")[:2] == ["deep 3", "end 3"]


def test_names_count_as_a_whole_inside_an_article(spark):
    prose = "".join(f'<p class="{c}">about {c}</p>' for c in ("social-history", "related-work", "alert-note"))
    gone = "".join(f'<div class="{c}">no {c}</div>' for c in ("ad", "share-buttons", "comment-list", "related posts", "Cookie-Notice"))
    found = texts(spark, [page(f"<article><p>first</p>{prose}{gone}</article><div class=related-links>x</div>")])
    assert found == {0: "first\n\nabout social-history\n\nabout related-work\n\nabout alert-note"}
