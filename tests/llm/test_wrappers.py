from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from regspark.llm.wrappers import align, expression, frequent_names, infer, kept_paths, main_text, main_texts, op3_html_wrappers, shared_marks, spoken, tell, texts_of, wrapper_of

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p><article>no</article>";</script></head><body class="home">
<header><a href="/">Site</a></header><nav><ul><li><a href="/x">menu {0}</a></li></ul></nav><div class="cookie-notice">We use cookies</div>
<div class="content"><article><header><h1>Title {0} &amp; more</h1></header><p>First   <b>bold</b> text&nbsp;{0}.</p><p>Second<br>line {0}<ul><li>one<li>two</ul>
<div class="ad-box">Buy</div><form><input>Search</form><section class="comments"><p>Reader says {0}</p></section></article><aside>Related {0}</aside></div><footer>&copy; 2020</footer></body></html>"""


def test_inference_and_extraction():
    pages = [PAGE.format(k) for k in ("a", "b", "c")]
    w = wrapper_of(pages[0])
    for p in pages[1:]:
        w = align(w, wrapper_of(p))
    text = expression(w)
    assert "<h1>#</>" in text and "(<li>=</>)+" in text or "<li>" in text
    paths = {tuple(p) for p in kept_paths(w)}
    assert main_text(pages[1], paths) == "Title b & more\nFirst bold text b.\nSecond\nline b\none\ntwo"


def test_optional_nodes_and_pages_without_article():
    a, b = wrapper_of("<div><p>x y</p></div>"), wrapper_of("<div><p>z</p><span>q</span></div>")
    assert expression(align(a, b)) == "<div><p>#</>(<span>=</>)?</>"
    body = "<body><div id='nav'>Home</div><div class='post'><p>{} words of the text here</p><p>and more {}</p></div><div class='sidebar'>Links</div></body>"
    w = wrapper_of(body.format("Some", 1))
    for k in range(3):
        w = align(w, wrapper_of(body.format(f"Other{k}", k)))
    assert main_text(body.format("New", 9), {tuple(p) for p in kept_paths(w)}) == "New words of the text here\nand more 9"


def test_broken_and_empty_pages(spark):
    rows = [(1, "http://a/x", None, 1), (1, "http://a/x", "", 1), (2, None, "plain text", 1), (3, "http://a/y", "<p>a<p>b</div></p>", 1), (4, "http://b/", "<article><p>x &lt; y" + " z" * 50_000, 1), (4, "http://b/", "<article>same</article>", 1), (4, "http://b/", "<article>same</article>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted((r["page_id"], r["text"]) for r in main_texts(df).collect())
    assert got == [(1, ""), (1, ""), (2, "plain text"), (3, "a\nb"), (4, "same"), (4, "same"), (4, "x < y" + " z" * 50_000)]
    assert all(r["n_chars"] == len(r["text"]) for r in main_texts(df, most_broadcast=0).collect())
    assert main_texts(df.limit(0)).collect() == []


def test_given_pages_keep_the_article_alone(spark, sf_dir):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in pq.read_table(f"{sf_dir}/pages.parquet").to_pylist()}
    rows = op3_html_wrappers(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", re.sub(r"</?b>", "", inner))
        assert r["text"] == "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def paths_of(pages):
    w = wrapper_of(pages[0])
    for p in pages[1:]:
        w = align(w, wrapper_of(p))
    return {tuple(p) for p in kept_paths(w)}


def test_article_text_is_whole():
    body = "<body><div class=content><h1>Title {0}</h1><p>lead {0}</p><h2>Abstract</h2><div class=body><p>" + "word " * 40 + "{0}</p></div></div><div class=sidebar>Links</div></body>"
    pages = [body.format(k) for k in ("a", "b", "c", "d")]
    assert main_text(pages[1], paths_of(pages)) == "Title b\nlead b\nAbstract\n" + "word " * 40 + "b"
    body = "<body><div><p>Before {0}</p><pre>" + "code " * 40 + "{0}</pre><p>After {0}</p></div></body>"
    pages = [body.format(k) for k in ("a", "b", "c", "d")]
    assert main_text(pages[2], paths_of(pages)) == "Before c\n" + "code " * 40 + "c\nAfter c"
    # one page of many that alone has a text, three of many that share one
    pages = [f"<body><div><p>Text {k}</p>{'<div class=box>Some</div>' if k < 3 else ''}</div></body>" for k in range(9)]
    assert main_text(pages[1], paths_of(pages)) == "Text 1\nSome"


PLAIN = """<body><div><div><p>{promo}</p><p>Our site has news</p></div><div><div>{title}</div><div>{text}</div><div>Read on: our terms apply</div>
<ul><li><a href=1>{a}</a></li><li><a href=2>{b}</a></li><li><a href=3>{c}</a></li></ul></div><div><div>{ad}</div></div></div></body>"""


def plain_pages(n):
    promos, ads = ("Winter sale now", "New phones here", "Join our club"), ("Best shoes of all", "Cheap flights today")
    page = lambda k: PLAIN.format(promo=promos[k % 3], title=f"Story {k}", text=f"It was told on day {k} of that year", ad=ads[k % 2], a=f"more {k}", b=f"else {k}", c=f"other {k}")
    return [page(k) for k in range(n)]


def test_only_other_pages_reveal_the_borders(spark):
    """No telling tag or name: menus, rotating adverts, constants and link lists go by the host's wrapper alone."""
    pages = plain_pages(12)
    rows = [(k, "http://a/x", p) for k, p in enumerate(pages)] + [(50, "http://b/x", pages[3])] + [(60 + k, "http://c/x", pages[0]) for k in range(9)]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(12):
        assert got[k] == f"Story {k}\nIt was told on day {k} of that year"
    # the same page without its host's others, or with copies alone, keeps what nothing tells apart
    assert got[50].startswith("Winter sale now\nOur site has news\nStory 3") and "terms apply" in got[50]
    assert got[60].startswith("Winter sale now\nOur site has news\nStory 0") and len({got[60 + k] for k in range(9)}) == 1


def test_constants_inside_an_article(spark):
    body = "<body><article><h1>Title {0}</h1><h2>Abstract</h2><p>Text {0} here</p><p>Subscribe to our letter now</p><p>More {0}</p><section><h3>See too</h3><ul><li><a>one {0}</a><li><a>two {0}</a><li><a>three {0}</a></ul></section></article></body>"
    rows = [(k, "http://a/x", body.format(k)) for k in range(8)]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k}\nAbstract\nText {k} here\nMore {k}" for k in range(8)}


def test_articles_that_recur_stay(spark):
    """Most pages hold the same article under different menus."""
    page = "<body><nav><a>m{1}</a></nav><article><h1>Title {0}</h1><p>The long text of story {0}</p><p>And its end {0}</p></article></body>"
    rows = [(k, "http://a/x", page.format(k % 3, k)) for k in range(12)]
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k % 3}\nThe long text of story {k % 3}\nAnd its end {k % 3}" for k in range(12)}


def revisions(n):
    """Three revisions of one story, then other stories of the same host."""
    page = "<body><nav><a>m{0}</a></nav><article><h1>Title {0}</h1><p>own words of page {0} stand here alone</p>{1}</article></body>"
    both = "<p>The first paragraph that all revisions hold</p><p>And a second one, word by word</p>"
    return [page.format(k, both if k < 3 else f"<p>Other text {k}</p>") for k in range(n)]


def test_revisions_lose_nothing(spark):
    """Whatever the number of a host's other pages."""
    for n in (3, 4, 5, 8, 30):
        rows = [(k, "http://a/x", p) for k, p in enumerate(revisions(n))]
        got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        for k in range(3):
            assert got[k] == f"Title {k}\nown words of page {k} stand here alone\nThe first paragraph that all revisions hold\nAnd a second one, word by word"
    page = "<body><article><h1>Title {0}</h1><p>mine {0}</p><p>A paragraph that is the same in all revisions</p></article></body>"
    rows = [(k, "http://a/x", page.format(k)) for k in range(9)]  # nothing but revisions
    got = {r["page_id"]: r["text"] for r in main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"Title {k}\nmine {k}\nA paragraph that is the same in all revisions" for k in range(9)}


def brute_shared(pages, least_stories=4, recurs=3, nearly_all=90):
    """Template slots and constants of one host by plain sets."""
    own = {p: texts_of(spoken(p, None)) for p in pages}
    n = Counter(m for texts in own.values() for m in texts)
    constants = {m for m in n if len(own) >= least_stories and n[m] * 100 >= len(own) * nearly_all}
    about = {m: a for texts in own.values() for m, a in texts.items()}
    size = lambda some: sum(n[m] * about[m][0] for m in some if about[m][1])
    revised = 3 * size(constants) > size(n)
    longest = {p: max(((about[m][0], m[1]) for m in texts if m not in constants), default=(0, p))[1] for p, texts in own.items()}
    if len(set(longest.values())) < least_stories:
        return set()
    stories = Counter(m for m, _ in {(m, longest[p]) for p, texts in own.items() for m in texts})
    slots = {slot for slot, _ in stories}
    template = {s for s in slots if 2 * sum(c for m, c in stories.items() if m[0] == s and c >= recurs) > sum(c for m, c in stories.items() if m[0] == s)}
    return template | {m[1] for m in constants if stories[m] * 100 >= len(set(longest.values())) * nearly_all and not (revised and about[m][1])}


def test_slots_and_constants_against_plain_sets(spark):
    body = "<body><article><h1>Title {0}</h1><h2>Abstract</h2><p>Text {0} here</p><p>Subscribe to our letter now</p><p>More {0}</p></article></body>"
    hosts = {"plain": plain_pages(12), "few": plain_pages(3), "constants": [body.format(k) for k in range(8)], **{f"revisions{n}": revisions(n) for n in (3, 4, 9, 30)}}
    df = spark.createDataFrame([(h, p, None) for h, pages in hosts.items() for p in [*pages, pages[0]]], "host string, html string, frequent binary")
    got = {r["host"]: set(np.frombuffer(r["shared"], np.int64).tolist()) for r in shared_marks(tell(df), df).collect()}
    want = {h: brute_shared(pages) for h, pages in hosts.items()}
    assert got == {h: m for h, m in want.items() if m}
    assert want["plain"] and want["constants"] and not want["few"]


def test_names_inside_an_article():
    ids = ("related-work", "search-methods", "legal-framework", "share-prices", "discussion")
    own = "".join(f"<section id='{i}'><h2>{i}</h2><p>On {i} {{0}}</p></section>" for i in ids)
    body = "<article><div class='article-header'><h1>Title {0}</h1></div>" + own + "<div class='ad-box'>Buy {0}</div><div class='share-bar'>Tell <a>all your friends</a></div><div id='related'><a>Other {0}</a></div><div class='comments'>Yes {0}</div></article>"
    pages = [body.format(k) for k in ("a", "b", "c", "d")]
    for some in (pages, pages[:1]):
        assert main_text(pages[0], paths_of(some)) == "\n".join(["Title a", *(x for i in ids for x in (i, f"On {i} a"))])


def test_wrappers_do_not_grow_with_the_pages(spark):
    import hashlib
    import json

    name = lambda k: hashlib.md5(str(k).encode()).hexdigest()
    page = "<body><div class=menu>Home</div><article><h1>Title {0}</h1><h2 id='guide-{1}'>On {0}</h2><div class='c{1} x'><p>Text {0}</p></div><div class='ad-{1}'>Buy {0}</div></article></body>"
    n = 400
    rows = [(k, "http://a/x", page.format(k, name(k))) for k in range(n)] + [(n, "http://b/", "<div>" * 5000 + "deep" + "</div>" * 5000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in main_texts(df).collect()}
    assert got == {k: f"Title {k}\nOn {k}\nText {k}" for k in range(n)} | {n: "deep"}
    pages = df.filter(df["page_id"] < n).selectExpr("'a' as host", "html")
    pages = pages.join(frequent_names(pages), "host", "left")
    (w,) = infer(tell(pages)).collect()
    count = lambda node: 1 + sum(map(count, node["kids"].values()))
    assert count(json.loads(w["wrapper"])) < 20
