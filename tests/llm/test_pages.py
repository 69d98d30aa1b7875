"""Page text by the site style tree; WARC derivatives."""

import json
import math
import time
from collections import Counter, defaultdict

import pytest

from indicator_lake.llm import style_tree, warc

SCHEMA = "page_id long, url string, html string, host string, node string"


def pages(llm, rows):
    return llm.createDataFrame([(*r, "h", "n") for r in rows], SCHEMA)


def article(body, extra=""):
    return (
        f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>';</script></head><body class='with-sidebar'><nav><a href=/x>Menu</a></nav>"
        f"<div class='ad'>Buy</div>{extra}<article>{body}</article><aside>side</aside><footer>&copy; foot</footer></body></html>"
    )


def texts(html):
    return [text for element, text in style_tree.blocks(html) if element.verdict == style_tree.KEPT]


def test_blocks_of_the_article_alone():
    html = article(
        "<h1>Ti&amp;tle</h1><p>One  <i>two</i>\n three&nbsp;four<!-- c --><p><b>Five<br><p>Six</b></p><form>f<input></form>"
        "<div class='cookie-notice'>n</div><section id='comments'><p>reader</p></section><ul><li>a<li>b</ul>"
    )
    kept = texts(html)
    assert kept == ["Ti&tle", "One two three four", "Five", "Six", "a", "b"]


def test_broken_and_cut_off_pages():
    for cut in range(0, 400, 7):
        list(style_tree.blocks(article("<p>some text &amp; more</p>" * 5)[:cut]))
    assert texts("plain < text <3 and</b> <p") == ["plain < text <3 and"]


def test_main_text_of_odd_rows(llm):
    long = "word " * 200_000
    rows = [
        (1, "http://a.example/1", article("<h1>H</h1><p>P</p>")),
        (1, "http://a.example/1", article("<h1>H</h1><p>P</p>")),
        (2, "http://a.example/2", None),
        (3, None, ""),
        (None, "http://b.example", article("<p>é 日</p>")),
        (4, "not a url", article(f"<p>{long}</p>")),
    ]
    found = sorted(style_tree.main_text(pages(llm, rows)).collect(), key=lambda r: (r.page_id or 0, r.url or ""))
    assert [(r.page_id, r.text if len(r.text) < 99 else len(r.text), r.n_chars) for r in found] == [
        (None, "é 日", 3), (1, "H\nP", 3), (1, "H\nP", 3), (2, "", 0), (3, "", 0), (4, len(long) - 1, len(long) - 1),
    ]
    assert style_tree.main_text(pages(llm, [])).count() == 0


def test_what_a_site_repeats_goes_and_what_varies_stays(llm):
    extra = "<div class='strap'><p>Same words on every page</p></div>"
    rows = [(i, f"http://one.example/{i}", f"<html><body>{extra}<div class='story'><p>Story {i}</p></div></body></html>") for i in range(20)]
    rows += [(100, "http://two.example/", f"<html><body>{extra}<div class='story'><p>Lone</p></div></body></html>")]
    rows += [(200 + i, "http://copies.example/", article("<p>Copied article</p>")) for i in range(30)]
    found = {r.page_id: r.text for r in style_tree.main_text(pages(llm, rows)).collect()}
    assert all(found[i] == f"Story {i}" for i in range(20))
    assert found[100] == "Same words on every page\nLone"  # one page tells nothing about its site
    assert all(found[200 + i] == "Copied article" for i in range(30))


def test_one_page_alone_is_no_site(llm):
    cells = "".join(f"<tr><td>{'yes' if i % 2 else 'no'}</td></tr>" for i in range(1000))
    items = "".join(f"<li>{'same' if 1 < i else f'own {i}'}</li>" for i in range(40))
    rows = [(1, "http://lone.example/", f"<html><body><table>{cells}</table><ul>{items}</ul></body></html>")]
    rows += [(2 + i, "http://few.example/", f"<html><body><div class='strap'><p>Twice</p><p>Twice</p></div><p>{i}</p></body></html>") for i in range(7)]
    found = {r.page_id: r.text.split("\n") for r in style_tree.main_text(pages(llm, rows)).collect()}
    assert found[1] == ["no", "yes"] * 500 + ["own 0", "own 1"] + ["same"] * 38
    assert all(found[2 + i] == ["Twice", "Twice", str(i)] for i in range(7))  # 14 blocks, but fewer pages than MIN_PAGES


def test_copied_pages_without_an_article_stay(llm):
    story = "<html><body><nav>{}</nav><div class='strap'><p>Site words</p></div><div class='story'><p>{}</p></div></body></html>"
    rows = [(i, f"http://copies.example/{i}", story.format(i, "Copied text")) for i in range(180)]
    rows += [(i, f"http://copies.example/{i}", story.format(0, f"Own {i}")) for i in range(180, 200)]
    found = {r.page_id: r.text for r in style_tree.main_text(pages(llm, rows)).collect()}
    assert all(found[i] == "Copied text" for i in range(180))
    assert all(found[i] == f"Own {i}" for i in range(180, 200))


def test_pages_without_a_host_are_no_site(llm):
    rows = [(i, [None, "", "not a url"][i % 3], f"<body><div class='strap'><p>Same words</p></div><p>Own {i}</p></body>") for i in range(30)]
    assert {r.text for r in style_tree.main_text(pages(llm, rows)).collect()} == {f"Same words\nOwn {i}" for i in range(30)}


def test_derivatives_link_back_and_round_trip(llm):
    html = "<html><head><title>A &amp; b</title></head><body><script>x</script><p>One<br>two</p><a href='/x?a=1&amp;b=2'>l</a></body></html>"
    rows = [(1, "http://a.example/1", html), (1, "http://a.example/1", html), (2, None, None), (None, "http://b.example", "")]
    table = pages(llm, rows)
    sources = {r.page_id: r.warc_headers["WARC-Record-ID"] for r in warc.responses(table).collect()}
    found = warc.derive(warc.responses(table)).collect()
    assert len(found) == 2 * len(rows) and len({r.record_id for r in found}) == 6
    for row in found:
        headers, content = warc.parse(bytes(row.record))
        assert headers == row.warc_headers and content == row.content
        assert headers["WARC-Refers-To"] == sources[row.page_id] == row.refers_to
        assert headers["WARC-Block-Digest"] == warc.digest(content.encode()) and int(headers["Content-Length"]) == len(content.encode())
        if row.page_id == 1:
            assert headers["WARC-Source-Payload-Digest"] == warc.digest(html.encode())
            if row.record_type == "conversion":
                assert content == "A & b\nOne\ntwo\nl"
            else:
                facts = json.loads(content)
                assert facts["html"] == {"title": "A & b", "links": ["/x?a=1&b=2"]} and facts["http-status"] == 200
                assert facts["warc-headers"]["WARC-Record-ID"] == sources[1]
    assert warc.derivative_digests(pages(llm, [])).count() == 0


def test_other_kinds_have_metadata_alone():
    headers = {"WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "u", "WARC-Date": "d", "WARC-Payload-Digest": "sha1:OTHER"}
    found = list(warc.derivatives(headers, {"content-type": "image/png"}, 200, "abc"))
    assert [r[0] for r in found] == ["metadata"]
    facts = json.loads(found[0][2])
    assert facts["payload-digest-matches"] is False and found[0][1]["WARC-Source-Payload-Digest"] == "sha1:OTHER"
    assert [r[0] for r in warc.derivatives(headers, {"content-type": "text/plain"}, 404, "abc")] == ["metadata", "conversion"]


def test_quotes_open_a_value_only_behind_an_equals_sign():
    html = "<article><p title=it's>First para</p><p>We don't know</p><p data-x='a>b' hidden-not \"x>Third</p><p a = \"1>2\">Fourth</p></article>"
    assert texts(html) == ["First para", "We don't know", "Third", "Fourth"]
    assert texts("<article><p>A</p><p title=\"never closed>B</p><p>C</p></article>") == ["A"]


def test_class_words_inside_an_article():
    names = "article-header form-factor legal-analysis search-results section-header post-related".split()
    kept = "".join(f"<div class='{n}'><p>{n}</p></div>" for n in names)
    gone = "".join(f"<div class='{n}'><p>x</p></div>" for n in "ad cookie-notice comments newsletter-signup share-widget".split())
    assert texts(f"<article><p>One</p>{kept}{gone}<div role=search>x</div><div hidden>x</div></article>") == ["One", *names]
    assert texts("<div class='layout-sidebar-left'><article><p>A</p></article><p>side</p></div>") == ["A"]
    assert texts("<div class='comments'><article><p>reply</p></article></div><article class=comment><p>r</p></article>") == []


@pytest.mark.parametrize("part", ["<a", '<a x="', "<div>x", "<title>", "<b>x", "</i>", "<!--", "<b><div></div>", "<li><p>", "<a =", "<p " + "a" * 50, "< ", "&amp"])
def test_broken_and_deep_pages_take_time_in_proportion(part):
    html = part * (1_000_000 // len(part))
    began = time.monotonic()
    list(style_tree.blocks(html))
    warc.html_parts(html)
    assert time.monotonic() - began < 20


def test_a_notice_repeated_inside_articles_goes_by_the_tree(llm, monkeypatch):
    body = "<h2>Introduction</h2><p>Own words {0}</p><div class='strap'><p>Same words in every article</p></div>"
    rows = [(i, f"http://one.example/{i}", article(body.format(i))) for i in range(20)]
    table = pages(llm, rows)
    assert {r.page_id: r.text for r in style_tree.main_text(table).collect()} == {i: f"Introduction\nOwn words {i}" for i in range(20)}
    monkeypatch.setattr(style_tree, "LOW_IMPORTANCE", -1.0)  # the tree switched off
    assert all("Same words in every article" in r.text for r in style_tree.main_text(table).collect())


def test_importance_equals_counting_by_hand(llm):
    strap = "<div class='{2}'><p>{0}</p></div>"
    rows = [(i, "http://x.example/", f"<body>{strap.format('Site' if i % 5 else f'T{i}', 0, 'a' if i % 3 else 'b')}<section><p>{i // 2}</p></section></body>") for i in range(24)]
    said, styles = defaultdict(Counter), defaultdict(Counter)
    for page in {html for _, _, html in rows}:
        on_page = defaultdict(list)
        for element, text in style_tree.blocks(page):
            on_page[element.parent, element.node, element.style].append(text)
        for (parent, node, style), texts_of in on_page.items():
            said[parent, node]["\n".join(texts_of)] += 1
            styles[parent][style] += 1

    def entropy(counts):
        n = sum(counts.values())
        return -sum(c / n * math.log2(c / n) for c in counts.values()) / math.log2(n) if n > 1 else 1.0

    expected = {
        node: 0.9 * entropy(counts) + 0.1 * entropy(styles[parent])
        for (parent, node), counts in said.items() if sum(counts.values()) >= style_tree.MIN_PAGES
    }
    table = pages(llm, rows).selectExpr("'x.example' AS host", "page_id AS row", "html")
    found = style_tree.style_tree(table.mapInArrow(style_tree._nodes, style_tree._NODES)).collect()
    assert len(found) == len(expected) >= 2
    assert all(abs(r.importance - expected[r.node]) < 1e-9 for r in found)
