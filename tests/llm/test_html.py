from __future__ import annotations

from tickloom.llm import html as H
from tickloom.session import Scratch

WORDS = "Some words of a text, with commas and more of them. "


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style></head><body><nav><a href='/'>Home</a></nav>{body}<footer>&copy; us</footer></body></html>"


def test_extraction_drops_what_is_not_the_article():
    text = H.extract(
        page(
            '<div id="cookie-notice">We use cookies, lots of them, really.</div><div class="ad">Buy now, please, it is cheap.</div>'
            f"<article class='post-7'><header><h1>Title &amp; more</h1></header><p>First  para&nbsp;with &eacute;<br>break. {WORDS}<p>Second <b>bo</b>ld. {WORDS}<ul><li>one<li>two</ul>"
            "<form>Subscribe <input></form><script>var t='</p>';</script><!-- gone <p>x</p> --><aside>Side</aside></article>"
            f"<section class='comments'><p>{WORDS * 9}</p></section><div class='sidebar'><p>{WORDS * 9}</p></div>"
        ),
        None,
    )
    w = WORDS.strip()
    assert text == f"Title & more\nFirst para with é break. {w}\nSecond bold. {w}\none\ntwo"


def test_broken_markup():
    assert H.extract("", None) == "" and H.extract("<p", None) == "<p"
    assert H.extract("plain <b>text</b> &lt;b&gt;", None) == "plain text <b>"
    assert H.extract("<div><p>a<div>b</p>c", None) == "a\nb\nc"
    assert H.extract(page(f"<article><p>{WORDS}"), None) == WORDS.strip() + "\n© us" or H.extract(page(f"<article><p>{WORDS}"), None) == WORDS.strip()
    assert H.extract("</div></p><article>x</article>", None) == "x"
    deep = "<div>" * 5000 + WORDS + "</div>" * 5000
    assert H.extract(deep, None) == WORDS.strip()


def test_title_lead_and_sections_of_an_article_stay():
    w = WORDS.strip()
    long = (WORDS * 6).strip()
    sections = page(f"<article><h1>Title</h1><p>Lead. {WORDS}</p><section><p>{WORDS * 6}</p></section><section class='b'><p>{WORDS * 6}</p></section></article>")
    assert H.extract(sections, None) == f"Title\nLead. {w}\n{long}\n{long}"
    wrapped = page(f"<main><h1>Title</h1><article><h2><a href='/'>Linked</a></h2><div class='x'><div class='body'><p>{WORDS * 6}</p></div></div></article></main>")
    assert H.extract(wrapped, None) == f"Title\nLinked\n{long}"
    quoted = page(f"<div class='text'><p>Lead. {WORDS}</p><blockquote><p>{WORDS * 6}</p></blockquote><table><tr><td>{WORDS * 2}</td></tr></table><p>{WORDS}</p></div><div class='box'><p>{WORDS}</p></div>")
    assert H.extract(quoted, None) == f"Lead. {w}\n{long}\n{(WORDS * 2).strip()}\n{w}"
    # What stands beside in other containers is not drawn in for a few words.
    beside = page(f"Some line<div class='text'><p>{WORDS * 6}</p></div><div class='box'><p>{WORDS}</p></div>")
    assert H.extract(beside, None) == long


def test_host_path_that_covers_little_of_an_article():
    w, long = WORDS.strip(), (WORDS * 6).strip()
    short = page(f"<article><h1>Title</h1><p>{WORDS * 6}</p><section><p>{WORDS}</p></section></article>")
    assert H.extract(short, "/html/body/article/section") == f"Title\n{long}\n{w}"
    divs = page(f"<div class='post'><p>{WORDS * 6}</p><div class='body'><p>{WORDS}</p></div><div class='x'><p>{WORDS * 8}</p></div></div>")
    assert H.extract(divs, "/html/body/div.post/div.body").startswith(f"{long}\n{w}")


def test_host_consensus_overrides_a_page(spark):
    usual = [page(f"<div class='main-{i}'><p>{WORDS * 6}</p></div><div class='box'><p>{WORDS}</p></div>") for i in range(5)]
    odd = page(f"<div class='main-9'><p>Short text of this page.</p></div><div class='box'><p>{WORDS * 6}</p></div>")
    rows = [(i, f"https://A.example/{i}", x) for i, x in enumerate([*usual, odd])]
    rows += [(10, "http://b.example/1", odd), (11, None, usual[0]), (12, "http://a.example/x", None), (13, "http://a.example/y", ""), (None, "u", usual[0]), (0, "https://A.example/0", usual[0])]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, text string, path int")
    out = H.main_text(Scratch(spark), df)
    assert sorted(out.columns) == ["n_chars", "page_id", "path", "text", "url"]
    found = {r["page_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    assert found[5]["text"] == "Short text of this page." and found[10]["text"] == (WORDS * 6).strip()
    assert found[0]["text"] == found[11]["text"] == found[None]["text"] == (WORDS * 6).strip()
    assert found[12]["text"] == found[13]["text"] == "" and found[12]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert H.main_text(Scratch(spark), df.limit(0)).collect() == []


def test_names_are_judged_one_by_one():
    long = (WORDS * 6).strip()
    outside = (
        "class='share-container'", "class='menu-container'", "class='footer-wrapper'", "class='user-opinions'", "class='discussion'", "class='post-footer'", "class='main-nav'",
        "class='comment-body'", "class='sidebar-content'", "id='content-ads'", "class='post comment'", "class='sidebar container'", "role='complementary'", "class='alert content-box'",
    )
    for attributes in outside:
        for tag in ("div", "ul"):
            body = f"<{tag} {attributes}><p>{WORDS * 2}</p></{tag}>"
            assert H.extract(page(f"<article><h1>Title</h1><p>{WORDS * 6}</p>{body}</article>"), None) == f"Title\n{long}", attributes
            assert H.extract(page(f"<div class='text'><p>{WORDS * 6}</p></div>{body}"), None) == long, attributes
    inside = (
        "class='content with-sidebar'", "class='content-sidebar-wrap'", "class='container sidebar-left'", "class='layout-sidebar'", "class='post category-social tag-ads'", "class='has-menu page'",
        "class='post-12 hentry category-promotion'", "role='main' class='menu-open'", "class='wrapper no-sidebar'",
    )
    for attributes in inside:
        assert H.extract(page(f"<div {attributes}><h1>Title</h1><p>{WORDS * 6}</p></div>"), None) == f"Title\n{long}", attributes
    w = WORDS.strip()
    for section in ("class='related work'", "id='related-work'", "class='discussion'", "class='entry-header'"):
        assert H.extract(page(f"<article><p>{WORDS * 6}</p><section {section}><p>{WORDS}</p></section></article>"), None) == f"{long}\n{w}", section


def test_columns_of_any_name_pass_through(spark):
    names = ["last of all", "row", "c0", "c1", "host", "path", "a.b", "text", "html", "url"]
    df = spark.createDataFrame([("z", "r", "0", "1", "h", "p", "d", "t", page(f"<article>{WORDS}</article>"), "http://a/b")], ", ".join(f"`{n}` string" for n in names))
    found = H.main_text(Scratch(spark), df).first().asDict()
    assert found == {"last of all": "z", "row": "r", "c0": "0", "c1": "1", "host": "h", "path": "p", "a.b": "d", "url": "http://a/b", "text": WORDS.strip(), "n_chars": len(WORDS.strip())}
    bare = H.main_text(Scratch(spark), df.select("html", "url")).first().asDict()
    assert bare == {"url": "http://a/b", "text": WORDS.strip(), "n_chars": len(WORDS.strip())}
