"""Operators on pages: archives, main text, URL rules."""

import base64
import hashlib

import numpy as np
import pytest

from depotlens.llm import extract, url_rules, warc
from depotlens.llm.htmlblocks import leaf_blocks

from . import brute

ROWS = [
    (1, "http://a.com/x", None), (2, None, ""), (3, "a\r\nb", "x\r\n\r\ny"), (4, "é", "x\r\n\r\ny"), (5, "q", "é" * 70_000), (0, "q", "é" * 70_000),
    (None, "u", "x\r\n\r\ny"), (None, "u", "alone"), (3, "again", "x\r\n\r\ny"), (9, "r", "WARC/1.1\r\n\r\n"),
]


def test_warc_round_trip(spark):
    pages = brute.pages(spark, ROWS)
    small = warc.WarcParams(archive_bytes=300, gap_bytes=10, range_bytes=500)
    first = {}
    for i, _, h in ROWS:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = []
    for i, _, h in ROWS:
        payload, origin = (h or "").encode(), first.get(h or "")
        revisit = origin is not None and i != origin
        want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if revisit else "response", origin if revisit else None))
    for p in (warc.WarcParams(), small):
        assert sorted(map(tuple, warc.archived(pages, p).collect()), key=str) == sorted(want, key=str)
    index = warc.write_archives(pages, small)
    assert index.count() == len(ROWS)
    some = warc.read_records(index.where("page_id = 9"), small, with_payload=True).collect()
    assert [(r["url"], bytes(r["payload"])) for r in some] == [("r", b"WARC/1.1\r\n\r\n")]
    assert warc.archived(pages.limit(0)).count() == 0


def test_leaf_blocks():
    page = """<!DOCTYPE html><head><title>T &lt;</title><script>var t="</p><p>no";</script><style>p{}</style></head><body class="Home page">
    <!-- <p>hidden</p> --><p>one&nbsp;&amp; <b>two</b><br>three<p>four <a href="x>y">link</a><ul><li>five<li>six</ul>
    <div id=main><textarea>no</textarea>se<i>ve</i>n 1 < 2</div><table><tr><td>a<td>b</table><select><option>no</select>tail <!-- open"""
    blocks = leaf_blocks(page)
    assert [b.text for b in blocks] == ["one & two three", "four link", "five", "six", "seven 1 < 2", "a", "b", "tail"]
    assert blocks[0].path[-2:] == (("body", ".home", ".page"), ("p",)) and blocks[4].path[-1] == ("div", ".main")
    assert [e[0] for e in blocks[3].path].count("li") == 1 and 0.4 < blocks[1].link_share < 0.6
    assert leaf_blocks("") == [] and leaf_blocks("<script>x") == [] and [b.text for b in leaf_blocks("plain")] == ["plain"]
    assert len(leaf_blocks("<div>" * 3000 + "x" + "<a '" * 3000)) == 1


def test_a_block_is_left_out_and_never_the_rest_of_the_page():
    def texts(page):
        return [b.text for b in leaf_blocks(page)]

    head = "<html><head><meta charset=x><title>t</title><noscript><p>no</p></noscript>"
    for page in ("<article><p>one</p></article>", "<b>one</b>", "one", "<body>one", "</head>one"):
        assert texts(head + page + "<p>two") == ["one", "two"]
        assert not any(e[0] == "head" for b in leaf_blocks(head + page) for e in b.path)
    for tag in ("button", "object", "select", "svg", "math", "template", "noscript"):
        assert texts(f"<div><{tag} class=x></div><p>one</p><p>two</p>") == ["one", "two"]
        assert texts(f"<div><{tag}></div><p>one</p><div><{tag}>no</{tag}></div><p>two") == ["one", "two"]
        assert texts(f"<{tag}><p>one</p><{tag}>no</{tag}><p>two") == ["one", "two"]
        assert texts(f"<div><{tag}></div><p>one</p></{tag}><p>two") == ["one", "two"]
        assert texts(f"<p>one</p><{tag}><i>no<div>no</div><!-- </{tag}> --><script>'</{tag}>'</script></{tag}><p>two") == ["one", "two"]
    for tag in ("object", "svg", "template"):
        assert texts(f"one<{tag}>no<{tag}>no</{tag}>no</{tag}><p>two") == ["one", "two"]
    for tag in ("script", "style", "textarea", "iframe", "title"):
        assert texts(f"<p>one</p><{tag}><p>no") == ["one"]
    assert len(leaf_blocks("<svg><b>" * 20_000 + "x")) == 1


def test_gradient_of_the_labeller():
    """Backpropagation against finite differences."""
    rng = np.random.default_rng(0)
    p = extract.ExtractParams(hidden=3)
    width, h = 4, 3
    w = {"w": rng.standard_normal((2, width, 4 * h)), "u": rng.standard_normal((2, h, 4 * h)), "b": rng.standard_normal((2, 1, 4 * h))}
    x = rng.standard_normal((2, 2, 5, width))
    toward = rng.standard_normal((2, 2, 5, h))
    grads = {}
    _, past = extract._run(x, w, True)
    extract._back(x, w, past, toward, grads)
    for name in w:
        flat = w[name].reshape(-1)
        for k in rng.integers(len(flat), size=6):
            old = flat[k]
            flat[k] = old + 1e-3
            up = (extract._run(x, w, False)[0] * toward).sum()
            flat[k] = old - 1e-3
            down = (extract._run(x, w, False)[0] * toward).sum()
            flat[k] = old
            assert grads[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=0.02)
    assert p.width > 0


def test_main_text(spark):
    shell = '<html><head><title>t</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy this now.</div>{}<footer>&copy; 2020 some house</footer></body></html>'
    article = "<article><h1>Head {0}</h1><p>First   paragraph\n of page {0}, with &amp; sign.</p><p>Second one, a little longer than the first.</p></article>"
    rows = [(i, f"u{i}", shell.format(article.format(i))) for i in range(12)] + [(50, None, None), (51, "u", ""), (None, "n", shell.format(article.format(99))), (52, "v", "<nav><a href=/>Home</a></nav>")]
    rows.append((53, "w", shell.format('<div class="cookie-notice"><p>We use cookies on this site.</p></div>' + article.format(53) + '<section id="comments"><div class="comment"><p>Reader says this is a fine text.</p></div></section>')))
    got = {r["page_id"]: r for r in extract.main_texts(brute.pages(spark, rows)).collect()}
    for i in [*range(12), 53, None]:
        n = 99 if i is None else i
        assert got[i]["text"] == f"Head {n}\nFirst paragraph of page {n}, with & sign.\nSecond one, a little longer than the first."
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[50]["text"] == got[51]["text"] == got[52]["text"] == "" and got[50]["url"] is None
    assert extract.main_texts(brute.pages(spark, rows).limit(0)).count() == 0


def test_url_verdicts(spark):
    urls = {
        "http://Www.Example.COM/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "https://m.example.com/en/": ("m.example.com", "/en/", "example.com/en/", "block"),
        "https://m.example.com/EN/": ("m.example.com", "/EN/", "com/", "allow"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/es/a?b": ("x.net", "/es/a", "net/es/", "block"),
        "http://x.net/es": ("x.net", "/es", None, "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://example.com?x=/en/": ("example.com", "", None, "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "ftp://a.spam-farm.org/x#y": ("a.spam-farm.org", "/x", None, "block"),
        "http://www.casino.org": ("www.casino.org", "", None, "block"),
        "http://casinos.org/casino/": ("casinos.org", "/casino/", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, None) for i, u in enumerate(urls)] + [(0, "http://com/", None), (None, "http://com/", None)]
    got = url_rules.judged_pages(brute.pages(spark, rows)).collect()
    want = [(i, *urls[u]) for i, u, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert url_rules.judged_pages(brute.pages(spark, rows).limit(0)).count() == 0
    # a rule is filed under its rarest token
    assert url_rules.prefix_rule("block", "example.com", "/en/").tokens == ("example", "com", "en")
