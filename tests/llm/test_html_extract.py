import html as entities
import random
import re
import time
import tracemalloc

import numpy as np
import pytest

from stockroute.llm import html_extract as hx, queries


def plain(page):
    """The article's blocks by regular expression (the test pages' one layout)."""
    m = re.search(r"<article>(.*?)(</article>|$)", page, re.S)
    blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)[^>]*>", m[1] if m else "")]
    return "\n".join(b for b in blocks if b)


def test_held_out_pages():
    x, y = hx.made_pages(300, 501)
    said = [p > 0.5 for p in hx.probabilities(hx.network(), x)]
    assert np.mean(np.concatenate(said) == np.concatenate(y)) > 0.985
    assert np.mean([(a == b).all() for a, b in zip(said, y)]) > 0.9


def test_padding_does_not_change_labels():
    x, _ = hx.made_pages(40, 502)
    together = hx.probabilities(hx.network(), x)
    alone = [hx.probabilities(hx.network(), [p])[0] for p in x]
    assert all(np.allclose(a, b) for a, b in zip(together, alone))


@pytest.mark.parametrize("page, blocks", [
    ("", []), ("   ", []), ("just text", ["just text"]), ("<p>a<p>b<br>c", ["a", "b c"]), ("<p>x &amp; y&amp;&nbsp;&#233;&eacute</p>", ["x & y& éé"]),
    ("<script>var t='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> -->yes", ["yes"]), ("<a title='x>y'>l</a> t", ["l t"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("1 < 2 <b>and</b> 3", ["1 < 2 and 3"]), ("<script>never closed <p>x", []), ("</p></div>a", ["a"]),
    ("<p>a \n\t b</p>", ["a b"]), ("<![CDATA[x]]>y", ["xy"]), ("<p>cut <b", ["cut"]),
])
def test_blocks(page, blocks):
    assert [b.text for b in hx.blocks_of(page)] == blocks


def test_paths_and_links():
    b = hx.blocks_of('<body><div class="Ad box" id=x><p>one <a href="#">two</a></p></div><p>three</p></body>')
    assert b[0].node.path() == ("body", "div ad box x", "p") and b[0].linked == 3 and b[1].node.path() == ("body", "p")


def test_odd_and_long_pages():
    rng = random.Random(1)
    for _ in range(200):
        hx.blocks_of("".join(rng.choice(["<p>", "</", "<", ">", "&am", "&#x;", '"', "<a href='", "text ", "<!--", "-->", "<br/>", "</div>", "<div"]) for _ in range(40)))
    page = "<article>" + "".join(f"<p>Word number {i}, and so on.</p>" for i in range(20000)) + "</article>"
    assert len(hx.main_texts(hx.network(), [page])[0].split("\n")) > 19900
    assert hx.main_texts(hx.network(), ["<article><p>" + "word " * 400000 + "</p></article>"])[0].count("word") == 400000


MENU = '<a href="/">Home</a> | <a href="/n">News</a> | <a href="/c">Contact</a>'
LINES = ["Harvest began late this year", "Growers in the valley waited three weeks longer than usual for the first dry days.",
         "What it means for prices", "Wholesale prices rose by a tenth, and shops expect them to stay high until spring.",
         "Some farms, however, sold out early; their owners say the cold nights made better fruit."]


def layouts():
    """Articles by hand in layouts that the made-up pages do not copy: (page, main blocks)."""
    h, one, sub, two, three = LINES
    foot = '<footer><p>Imprint</p></footer>'
    yield (f'<body><div class="container-fluid"><div class="row">{MENU}</div><div class="row"><div class="col-lg-9"><h1>{h}</h1><p>{one}</p><h4>{sub}</h4>'
           f'<p>{two}</p><p>{three}</p></div><div class="col-lg-3"><div class="widget"><h4>Popular</h4><p>Ten photographs</p></div></div></div></div>{foot}', LINES)
    yield (f'<body><table width="100%"><tr><td>{MENU}</td></tr><tr><td><h2>{h}</h2><p>{one}</p><p>{two}</p><p>{three}</p></td></tr></table>{foot}', [h, one, two, three])
    yield f'<body><div>{MENU}</div><div><div>{one}</div><div>{two}</div><div>{three}</div></div>{foot}', [one, two, three]
    yield (f'<body><nav>{MENU}</nav><article><h1>{h}</h1><p>{one}</p><h5>{sub}</h5><table><tr><th>Month</th><th>Price</th></tr><tr><td>May</td><td>140</td></tr></table>'
           f'<dl><dt>Must</dt><dd>{two}</dd></dl><pre>tons = area * yield</pre><figure><figcaption>Pickers at work.</figcaption></figure><p>{three}</p></article>{foot}',
           [h, one, sub, "Month", "Price", "May", "140", "Must", two, "tons = area * yield", "Pickers at work.", three])
    rng = random.Random(17)
    for _ in range(20):
        a, b, c, d = ("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(4))
        yield (f'<body><div class="{a}"><div class="{b}">{MENU}</div><div class="{c}"><h1>{h}</h1><div class="{d}">{one}</div><h3>{sub}</h3><div class="{d}">{two}</div>'
               f'<div class="{d}">{three}</div></div></div><div class="footer">Imprint</div>', LINES)


def test_held_out_layouts():
    pages = list(layouts())
    kept = wanted = extra = 0
    for (_, blocks), text in zip(pages, hx.main_texts(hx.network(), ["<title>T</title>" + p for p, _ in pages])):
        got = text.split("\n")
        kept += sum(b in got for b in blocks)
        wanted += len(blocks)
        extra += sum(b not in blocks for b in got if b)
    assert kept >= 0.95 * wanted and extra <= 0.05 * wanted, (kept, wanted, extra)


def test_deep_nesting_takes_memory_by_length():
    tracemalloc.start()
    blocks = hx.blocks_of("<div>x" * 50000)
    assert len(blocks) == 50000 and blocks[-1].node.depth == 50000
    assert tracemalloc.get_traced_memory()[1] < 400 << 20
    tracemalloc.stop()
    start = time.time()
    assert hx.blocks_of("<div>" * 50000 + "</p>" * 50000 + "<b>" * 50000 + "<hr>" * 50000 + "</i>" * 50000) == []
    assert time.time() - start < 20


def test_query_on_the_pages(spark, saved):
    path = "/root/testdata/sf0.01"
    rows = {r.page_id: r for r in spark.read.parquet(path + "/pages.parquet").collect()}
    got = queries.op3_html_text(spark, path).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == plain(rows[r.page_id].html) and r.n_chars == len(r.text) and r.url == rows[r.page_id].url
    df = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", ""), (3, "u", "<p></p>")], "page_id long, url string, html string")
    assert sorted((r.text, r.n_chars) for r in queries.op3_html_text(spark, saved(pages=df)).collect()) == [("", 0)] * 4
    assert queries.op3_html_text(spark, saved(pages=df.limit(0))).count() == 0
