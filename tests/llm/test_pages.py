"""WARC archives and page extraction."""

import base64
import hashlib
import re

import pytest

from salesmart.llm import mainhtml, warc

SCHEMA = "page_id long, url string, html string"


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def rows():
    out = [(i, f"http://x.example/{i}?a=é b", f"<p>page {i % 7} " + "x" * (i * 300) * (i % 7 == 3)) for i in range(60)]
    return out + [(100, None, None), (101, "http://y.example/\r\nX: y", ""), (102, "u", "é\r\n\r\nWARC/1.1\r\n"),
                  (103, "u", "z" * 9_000_000), (None, "n", "<p>page 1 "), (104, "u", "only once"), (104, "u", "only once")]


def test_warc_round_trip(spark):
    data = rows()
    index = warc.write_archive(spark.createDataFrame(data, SCHEMA))
    got = warc.read_records(index).collect()
    first = {}
    for i, _, text in data:
        key = text or ""
        first[key] = min(x for x in (first.get(key), i) if x is not None) if (first.get(key), i) != (None, None) else None
    assert len(got) == len(data)
    want = sorted((str(i), len((t or "").encode()), digest(t), "response" if first[t or ""] == i else "revisit",
                   None if first[t or ""] == i else first[t or ""]) for i, _, t in data)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    texts = {i: t for i, _, t in data}
    assert all(bytes(r.payload).decode() == (texts[r.page_id] or "") for r in got if r.record_type == "response")


def test_warc_reads_only_what_is_selected(spark):
    index = warc.write_archive(spark.createDataFrame(rows(), SCHEMA), min_bytes=20)
    some = index.where("page_id IN (3, 10, 102)")
    got = warc.read_records(some).collect()
    assert sorted(r.page_id for r in got) == [3, 10, 102]
    assert {r.record_type for r in warc.read_records(index.where("payload_bytes < 20")).collect()} == {"response"}
    assert warc.read_records(index.where("false")).count() == 0


def test_warc_empty_table(spark):
    index = warc.write_archive(spark.createDataFrame([], SCHEMA))
    assert index.count() == 0 and warc.read_records(index).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now please.</div>
<article><h1>Title {i}</h1><p><b>First &amp; bold.<br><p>Second   line<br>goes on&nbsp;here, with <a href="#">a link</a>.</p>{more}</article>
<footer>&copy; someone, all rights.</footer></body></html>"""


@pytest.fixture(scope="module")
def model():
    return mainhtml.train([PAGE.format(i=i, more="<p>More words that make up a paragraph of text.</p>" * (i % 4)) for i in range(60)])


def text_of(spark, model, source):
    return mainhtml.extract(spark.createDataFrame([(1, "u", source)], SCHEMA), model).first().text


def test_html_main_text(spark, model):
    assert text_of(spark, model, PAGE.format(i=7, more="")) == (
        "Title 7\n\nFirst & bold.\n\nSecond line goes on here, with a link.")


def test_html_leaves_out_parts_inside_the_article(spark, model):
    more = ("<aside>Read also this other story.</aside><p>Real text stands here.</p><form><p>Your mail please.</p></form>"
            "<section class='comments'><p>A reader says something here.</p></section><div id=\"cookie-notice\"><p>We use cookies here.</p></div>")
    assert text_of(spark, model, PAGE.format(i=7, more=more)).split("\n\n")[3:] == ["Real text stands here."]


def test_html_odd_sources(spark, model):
    data = [(1, "u", None), (2, None, ""), (3, "u", "<<<>>> < p"), (4, "u", "<article><p>cut off in the mid"),
            (5, "u", "<!-- open"), (6, "u", "<script>open"), (7, "u", '<p class="open>x'), (None, None, None),
            (8, "u", "<article>" + "<p>word word word.</p>" * 20_000), (8, "u", "<article>" + "<div>" * 3000)]
    got = mainhtml.extract(spark.createDataFrame(data, SCHEMA), model).collect()
    assert len(got) == len(data) and all(r.n_chars == len(r.text) for r in got)
    assert [r.text for r in got if r.page_id in (1, 2, 5, 6)] == [""] * 4
    assert next(r.text for r in got if r.page_id == 4) == "cut off in the mid"
    assert max(r.n_chars for r in got) == 20_000 * 17 - 2
    assert mainhtml.extract(spark.createDataFrame([], SCHEMA), model).count() == 0


def test_html_marginals_are_exact(model):
    import itertools

    import numpy as np
    parent, depth = np.array([-1, 0, 0, 1, 1]), np.array([0, 1, 1, 2, 2])
    node = np.random.default_rng(3).normal(size=(5, 3))
    total, each = 0.0, np.zeros((5, 3))
    for s in itertools.product(range(3), repeat=5):
        p = np.exp(model.root[s[0]] + sum(node[i, s[i]] for i in range(5)) + sum(model.edge[s[parent[i]], s[i]] for i in range(1, 5)))
        total += p
        for i in range(5):
            each[i, s[i]] += p
    assert np.allclose(np.exp(mainhtml.marginals(parent, depth, node, model)), each / total)


def test_html_held_out_pages_of_the_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    m = mainhtml.learn(pages, bound=60)
    import html as h
    right = n = 0
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in mainhtml.extract(pages, m).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", sources[r.page_id], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)[^>]*>", inner)
        want = "\n\n".join(x for x in (" ".join(h.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split())
                                       for b in blocks) if x)
        right += r.text == want
        n += 1
    assert right == n


SECOND = "<article><p>First paragraph here.</p>%s<p>Second paragraph there.</p></article>"


@pytest.mark.parametrize("between,extra", [
    ('<svg width="1"/>', []), ("<math/>", []), ("<select><option>One", []), ("<button>Go", []), ("<svg>", []), ("<template>", []),
    ('<svg><path d="M1"/><text>no</text></svg>', []), ("<button><div>Go</div></button>", []), ("<svg><svg/></svg>", []),
    ("<template><p>x</p><template>y</template></template>", []), ("<select><option>1</select>", []),
    ("<button>A <button>B</button>", []), ("<button>A<p>mid</p><button>B</button>", ["mid"]),
    ("<object data=x>fallback</object>", ["fallback"]), ("<script>'<svg>'</script>", []), ("<!-- <select> -->", [])])
def test_nothing_after_a_muted_element_is_lost(between, extra):
    got = [x for x in mainhtml.parse(SECOND % between).text if x]
    assert got == ["First paragraph here.", *extra, "Second paragraph there."]


@pytest.mark.parametrize("page,blocks", [
    ("<p title=it's>Hello there, it's me.</p><p>Next block.</p>", ["Hello there, it's me.", "Next block."]),
    ("<p class=\"a>b\" id='c>d'>x</p><p class = \"q\">y</p><p class=>z</p><a href=a?b=c>k</a>", ["x", "y", "z", "k"]),
    ("<p data-x=\"1\"y=2>t</p>", ["t"]), ("<p title=a\"b>one</p><p title='it'>two</p>", ["one", "two"]),
    ("<p>a <math><mi>x</mi><mo>=</mo><mn>1</mn></math> b</p>", ["a x=1 b"]), ("<p>Say \"hi\"</p><p>It's</p>", ['Say "hi"', "It's"])])
def test_quotes_delimit_only_where_a_value_begins(page, blocks):
    assert [x for x in mainhtml.parse(page).text if x] == blocks


def test_many_unclosed_elements_are_parsed_in_linear_time():
    import time
    begin = time.process_time()
    page = mainhtml.parse("<p>x<svg><button>" * 20_000)
    assert len([x for x in page.text if x]) == 20_000 and time.process_time() - begin < 20
