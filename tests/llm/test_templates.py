"""Main text of generated hosts with different templates."""

import html as entities

from headway.llm import template_extraction as te
from tests.llm.conftest import prose

SCHEMA = "page_id long, url string, html string, text string, host string, slot string"


def article(seed):
    return [prose(seed, 6), *(prose(1000 * seed + k, 20 + k) for k in range(1 + seed % 4)), "tea & © <tags>"]


def semantic(i, parts):
    return (
        f"<!DOCTYPE html><html><head><title>{prose(i, 4)}</title><script>var x='</p><p>no</p>';</script><style>p{{}}</style></head><body>"
        f"<header><h2>{prose(5, 3)}</h2></header><nav><ul>{''.join(f'<li><a href=/{k}>{prose(i + k, 1)}</a></li>' for k in range(i % 5 + 1))}</ul></nav>"
        f"<!-- no --><div class='cookie-notice'>We use {prose(i, 2)}</div><article><h1>{entities.escape(parts[0])}</h1>"
        + "".join(f"<p><b>{entities.escape(p)}<br>" if k % 2 else f"<p>{entities.escape(p)}</p>\n" for k, p in enumerate(parts[1:]))
        + f"<div class=share>Share this</div></article><section id=comments><p>{prose(i + 77, 9)}</p></section><footer>&copy; {prose(i, 3)}</footer></body></html>"
    )


def anonymous(i, parts):
    """No element says what it is: only the template shows the article."""
    return (
        f"<html><body><div><div class=x1>{prose(8, 6)}</div><div class=x2><a href=/>{prose(8, 2)}</a> {prose(i, 2)}</div>"
        + "<div class=x3><h1>" + entities.escape(parts[0]) + "</h1>" + "".join(f"<p>{entities.escape(p)}" for p in parts[1:])
        + f"<div class=x5>{prose(44, 5)}</div></div><div class=x4>{prose(9, 8)}</div></div></body>"
    )


def test_hosts(spark):
    rows, want = [], {}
    for i in range(24):
        parts = article(i + 1)
        want[i] = "\n\n".join(parts)
        layout, host = (semantic, "Semantic.example:80") if i % 2 else (anonymous, "anon.example")
        rows.append((i, f"http://{host}/{i}?x", layout(i, parts), "t", "h", "s"))
    parts = article(50)
    want[50] = "\n\n".join(parts)
    rows.append((50, "https://lone.example/", semantic(50, parts), "t", "h", "s"))  # its host's only page
    got = {r.page_id: r for r in te.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got.keys() == want.keys()
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_marks_on_what_holds_the_article_do_not_empty_it(spark):
    """Whole pages in a form or a marked div, and headlines in a marked header; alone on a host and many."""
    opened = ["<form id=aspnetForm action='/'>", "<div class='has-sidebar'>", "<div id=page class='no-comments'>", "<div class=plain>"]
    rows, want = [], {}
    for i in range(48):
        parts = article(i + 1)
        tag = opened[i % 4]
        lone = i >= 40
        want[i] = "\n\n".join(parts)
        html = (
            f"<html><body>{tag}<nav><a href=/>{prose(3, 2)}</a></nav><article><header class='entry-header'><h1>{entities.escape(parts[0])}</h1></header>"
            + "".join(f"<p>{entities.escape(p)}</p>" for p in parts[1:])
            + f"</article><div class='sidebar'><p>{prose(i + 900, 3)}</p></div></{tag[1:].split()[0]}></body></html>"
        )
        rows.append((i, f"http://{f'lone{i}' if lone else f'wrapped{i % 4}'}.example/{i}", html, "t", "h", "s"))
    got = {r.page_id: r.text for r in te.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == want


def test_salted_join_gives_the_same(spark, monkeypatch):
    rows = [(i, "http://a.example/", anonymous(i, article(i + 1)), "t", "h", "s") for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    small = sorted(te.extract_main_text(df).collect())
    monkeypatch.setattr(te, "SMALL", 0)
    assert sorted(te.extract_main_text(df).collect()) == small


def test_odd_pages(spark):
    rows = [
        (1, None, None, "t", "h", "s"),
        (2, "not a url", "", "t", "h", "s"),
        (None, "http://u@b.example", "plain &amp; text \n here", "t", "h", "s"),
        (3, "http://b.example", "<p>cut <b>off <a href='x", "t", "h", "s"),
        (4, "http://c.example", "<!-- never ends", "t", "h", "s"),
        (5, "http://c.example", "<" * 2000 + ">" * 2000, "t", "h", "s"),
        (6, "http://d.example", "<div>" * 100_000 + "deep" + "</p>" * 100_000, "t", "h", "s"),
        (7, "http://e.example", "<script>x", "t", "h", "s"),
        (7, "http://e.example", "<script>x", "t", "h", "s"),
    ]
    got = te.extract_main_text(spark.createDataFrame(rows, SCHEMA)).collect()
    texts = {}
    for r in got:
        texts.setdefault(r.page_id, []).append(r.text)
    assert texts[1] == [""] and texts[2] == [""] and texts[4] == [""] and texts[7] == ["", ""]
    assert texts[None] == ["plain & text here"] and texts[3] == ["cut off"] and texts[6] == ["deep"]
    assert te.extract_main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_nesting_and_implied_ends():
    got = [(p, t) for p, t, _ in te.blocks("<ul><li>a<ul><li>b<li>c</ul>d<li>e</ul><p>f<p>g</p><table><tr><td>h<td>i<tr><td>j</table>") if t]
    assert [t for _, t in got] == list("abcdefghij")
    assert [p.count("/") for _, p in [(t, p) for p, t in got]] == [1, 3, 3, 1, 1, 0, 0, 2, 2, 2]
