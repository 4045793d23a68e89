import numpy as np
import pytest

from meeple.llm import html_dom, html_extract

KIND = "page_id bigint, url string, html string, text string, shard int"


@pytest.fixture(scope="module")
def trees():
    return html_extract.train()


def test_held_out_pages(trees):
    pages = html_extract.training_pages(200, seed=1234)
    p = 1 / (1 + np.exp(-html_extract.margins(html_dom.features(pages), trees)))
    at = right = whole = nodes = 0
    for page in pages:
        n = len(page.tags)
        kept = html_dom.decoded(page, p[at:at + n])
        at += n
        right += int((kept == np.array(page.marked)).sum())
        nodes += n
        whole += all(kept[i] == page.marked[i] for i in range(n))
        assert all(kept[page.parents[i]] or not kept[i] for i in range(1, n))  # no contradiction
    assert right / nodes > 0.985 and whole / len(pages) > 0.85


def test_texts(spark, trees):
    prose = "This is a fairly long paragraph, with commas, about nothing in particular. " * 3
    rows = [
        (1, f"<nav><ul><li><a href=x>Home</a></ul></nav><article><h1>A &amp; B</h1><p>{prose}<p>two\n  lines<br>here &lt;b&gt;"
            "</article><footer>&copy; me</footer>"),
        (2, f"<body><div class=cookie-notice>We use cookies.</div><div class=content><p>{prose}</p><div class=ad>Buy</div>"
            f"<p>{prose}</p></div><div id=comments><p>{prose}</p></div><form><p>Sign up now</p></form>"),
        (3, None), (4, ""), (5, "<html><head><title>t</title><script>var a='<p>x</p>'</script></head></html>"),
        (1, "<p>unclosed <b>markup &am")]
    df = spark.createDataFrame([(i, "u", h, "old", 1) for i, h in rows], KIND)
    out = html_extract.main_texts(df).collect()
    clean = " ".join(prose.split())
    by = {(r.page_id, r.text) for r in out}
    assert (1, f"A & B\n{clean}\ntwo lines here <b>") in by
    assert (2, f"{clean}\n{clean}") in by
    assert {(3, ""), (4, ""), (5, "")} <= by and len(out) == len(rows)
    assert all(r.n_chars == len(r.text) and r.url == "u" for r in out)
    assert html_extract.main_texts(df.limit(0)).collect() == []


def test_tree_building():
    page = html_dom.Page("<div><p>a<p>b<ul><li>c<li>d<ul><li>e</ul></ul><table><tr><td>f<td>g</table>h</div>i")
    got = [(page.tags[n], t) for n, t, _ in page.runs]
    assert got == [("p", "a"), ("p", "b"), ("li", "c"), ("li", "d"), ("li", "e"), ("td", "f"), ("td", "g"),
                   ("div", "h"), ("body", "i")]


def test_boosting_fits_an_interaction():
    rng = np.random.RandomState(0)
    x = rng.rand(3000, 5)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    trees = html_extract.fit(x[:2000], y[:2000], trees=30, depth=3)
    assert np.mean((html_extract.margins(x[2000:], trees) > 0) == y[2000:]) > 0.95


def test_decoding_prefers_the_likeliest_tree():
    page = html_dom.Page("<div><p>a</p><p>b</p></div><div><p>c</p></div>")
    assert page.tags == ["body", "div", "p", "p", "div", "p"]
    kept = html_dom.decoded(page, np.array([0.9, 0.4, 0.95, 0.95, 0.1, 0.6]))
    assert kept.tolist() == [True, True, True, True, False, False]


def test_left_out_end_tags():
    text = lambda h: [t for _, t, _ in html_dom.Page(h).runs]
    for head in ("<head>", "<head><title>t</title>", "<head><meta name=a><style>p {}</style>\n",
                 "<head><head><script>var a = '<p>x</p>'</script>", "<head><noscript><link rel=x></noscript>"):
        for body in ("<body><p>a</p>b", "<p>a</p>b", "</head><body><p>a</p>b", "</head><p>a</p>b"):
            assert text("<html>" + head + body) == ["a", "b"]
    assert text("<head><title>t</title>a<p>b") == ["a", "b"]
    assert text("<head><noscript><link rel=x><body><p>a") == ["a"]
    assert text("<head><template><body><p>x</template><p>a") == ["a"]
    # a button without an end tag is silent to the next block, one with it as a whole
    assert text("<div>a<button>x<p>b<p>c</div>") == ["a", "b", "c"]
    assert text("a<button>x<button><div>y</div></button>b") == ["a", "b"]
    assert text("a<button>x<svg><p>y</p></svg><p>b</p><div><button>z</button>c</div>") == ["a", "b", "c"]
    # formulas are text, their source is not
    assert text("<p>so <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding=tex>x = 2"
                "</annotation></semantics></math> holds") == ["so x=2 holds"]


def test_page_without_end_of_head(spark, trees):
    prose = "This is a fairly long paragraph, with commas, about nothing in particular. " * 3
    pages = [f"<html><head><title>t</title>{end}<body><article><p>{prose}</p></article></body></html>"
             for end in ("</head>", "")]
    out = html_extract.main_texts(spark.createDataFrame([(i, "u", h, "", 1) for i, h in enumerate(pages)], KIND))
    assert {(r.text, r.n_chars) for r in out.collect()} == {(prose.strip(), len(prose.strip()))}


def test_any_text_is_a_page():
    import random
    text = lambda h: [t for _, t, _ in html_dom.Page(h).runs]
    assert text("<![foo bar]>x<![CDATA[y]]>z<!-- q") == ["xz"]
    assert text("a<p>b</p><a href='x y") == ["a", "b"]
    r = random.Random(1)
    bits = ["<p>", "</p>", "<div class='", "'>", "<", "!", "[", "--", ">", "x y", "&", "<script>", "</script>", "<!",
            "]]>", "<li>", "<ul>", "</ul>", "\x00", "<a href=", "<?", "/", "<![", "<!DOCTYPE", "&#xD800;"]
    for _ in range(3000):
        page = html_dom.Page("".join(r.choice(bits) for _ in range(r.randint(1, 25))))
        assert len(html_dom.features([page])) == len(page.tags)
