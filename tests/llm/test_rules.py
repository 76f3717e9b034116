"""Decontamination, page text, URL rules and host rules."""

import random

import pytest
from check import compare
from conftest_llm import ODD

from skyops.llm import decontaminate, host_rules, html_text, queries, url_filters


def test_retrieval_equals_scoring_every_item():
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(300)]
    word = lambda: vocabulary[min(int(rng.expovariate(0.02)), 299)]
    items = [(k, [word() for _ in range(rng.randrange(5, 30))], [word() for _ in range(rng.randrange(0, 6))]) for k in range(60)]
    index = decontaminate.Index(items)
    for _ in range(60):
        text = [word() for _ in range(rng.randrange(0, 400))]
        for k, q, a in rng.sample(items, 2):
            at = rng.randrange(len(text) + 1)
            text[at:at] = q + a
        want, step = set(), index.longest
        for p in range(max(1, -(-len(text) // step) - 1)):
            terms = set(text[p * step : (p + 2) * step])
            for k in range(len(items)):
                score = sum(v for t in terms if t in index.terms for i, v in index.postings[index.terms[t]] if i == k)
                if score >= 0.7 - 1e-9:
                    want.add((p, k))
        assert {(p, k) for p, k, _ in index.retrieve(text, 0.7)} == want


def test_planted_items_are_found_and_others_left(spark, docs_of):
    rng = random.Random(4)
    text = lambda n: " ".join(f"t{rng.randrange(5000)}" for _ in range(n))
    items = [(k, f"{text(20)}. {text(8)}.") for k in range(30)] + [(90, None), (91, ""), (92, "Two words"), (None, text(20))]
    table = decontaminate.with_answers(spark.createDataFrame(items, "item_id long, text string"))
    rows = [(k, text(rng.randrange(1, 300))) for k in range(200)]
    planted = {(k, k // 5) for k in range(0, 100, 5)}
    rows = [(k, f"{t} {items[k // 5][1].upper()}## {text(50)}" if (k, k // 5) in planted else t) for k, t in rows]
    half = items[29][1].split(". ")[0]
    rows += [(500, f"{text(100)} {half} {text(100)}"), (501, items[29][1])]  # a question without its answer is no leak
    got = decontaminate.find(docs_of(rows), table).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted | {(501, 29)}
    assert all(r.score >= 0.7 and r.question_overlap >= 0.8 and r.answer_overlap >= 0.8 for r in got)


def test_nearly_whole_items_with_short_answers_are_found():
    q = [f"q{k}" for k in range(26)]
    items = [(0, q, ["so", "it", "was"]), (1, [f"r{k}" for k in range(8)], ["yes", "indeed"]),
             (2, [f"s{k}" for k in range(26)], [f"a{k}" for k in range(6)]), (3, [f"t{k}" for k in range(10)], [f"b{k}" for k in range(10)])]
    index = decontaminate.Index(items)
    found = lambda words: [r[0] for r in index.verified(["x"] * 70 + words + ["y"] * 70, 0.7, 0.8)]
    assert found([*q, "so", "it", "is"]) == found([*q, "so", "is", "was"]) == [0]  # one word of the answer changed
    assert found(q) == [0] and found(q[:13] + ["z"] + q[13:18]) == []  # 22 of 25 windows of the whole, and too few
    assert found([*items[1][1], "said", "indeed", "yes"]) == [1]  # the answer's words beside the question
    assert found([*items[2][1], *items[2][2][:3], "z", *items[2][2][4:]]) == [2]
    assert found(items[2][2]) == found(items[3][1]) == []


def test_shards_find_the_same(spark, docs_of, monkeypatch):
    items = [(k, " ".join(f"q{k}x{j}" for j in range(20)) + ". " + f"end of {k} it is") for k in range(20)]
    table = decontaminate.with_answers(spark.createDataFrame(items, "item_id long, text string"))
    docs = docs_of([(k, f"before {t} after") for k, t in items])
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 100)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs, table).collect()} == {(k, k) for k in range(20)}


def test_decontamination_cases(spark, docs_of):
    items = decontaminate.with_answers(spark.createDataFrame([(1, "one two three"), (2, "one two three")], "item_id long, text string"))
    got = sorted((r.doc_id or 0, r.item_id) for r in decontaminate.find(docs_of(ODD), items).collect())
    assert got == sorted((i, k) for i in (5, 6, 0, 10, 10) for k in (1, 2))
    assert decontaminate.find(docs_of(ODD), items.where("item_id > 9")).collect() == []
    assert decontaminate.find(docs_of(ODD).where("doc_id > 99"), items).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header class="top"><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></nav>
<div id="cookieNotice">We use cookies here</div><main><article><h1>A &lt;title&gt; &amp; more</h1><p>Short.
<p>{long}<br>goes   on &#233;&nbsp;end</p><div class="ad-slot">Buy this now</div><ul><li>first</li><li>second</ul>
<blockquote><p>Quoted <b>bold</b>ly</p></blockquote><form>Your mail <input></form><p>End.</p></article>
<aside>Side</aside><section class="comments"><p>{reader}</p></section></main><footer>(c) all rights</footer></body>"""


def test_article_without_what_surrounds_it():
    long = "alpha beta " * 40
    got = html_text.main_text(PAGE.format(long=long, reader="I say " * 90))
    assert got.split("\n") == ["A <title> & more", "Short.", f"{long}goes on é end", "first", "second", "Quoted boldly", "End."]


def test_nested_articles_are_whole():
    a, b, c = "lead text " * 10, "body text " * 50, "more text " * 60
    body = f"<div><p>{b}</p><p>{c}</p></div>"
    want = ["T", a.strip(), b.strip(), c.strip()]
    menu = "<nav><a href=x>Home</a></nav>"
    lines = lambda page: html_text.main_text(page).split("\n")
    for page in (f"{menu}<article><h1>T</h1><p>{a}</p>{body}</article><footer>f</footer>", f"<main><h1>T</h1><p>{a}</p>{body}</main>",
                 f"<body>{menu}<h1>T</h1><div class=share>s</div><p>{a}</p>{body}<footer>f</footer></body>",
                 f"<body>{menu}<div><div><h1>T</h1></div><div><p>{a}</p></div>{body}</div><footer>f</footer></body>",
                 f"<main><h1>T</h1><article><p>{a}</p>{body}</article><aside>s</aside></main>",
                 f"<body><div><a href=x>Front page</a> | <a href=y>News</a></div><div><h1>T</h1><p>{a}</p>{body}</div></body>"):
        assert lines(page) == want
    sources = "<h2>Sources</h2><ul><li><a href=x>One</a><li><a href=y>Two</a></ul>"
    assert lines(f"{menu}<article><h1>T</h1><p>{a}</p>{body}{sources}</article>") == [*want, "Sources", "One", "Two"]
    lone = f"<div><h1>T</h1><p>{a}</p><p><a href=x>a whole paragraph</a></p>{body}</div>"
    assert lines(f"<body>{menu}{lone}</body>") == [*want[:2], "a whole paragraph", *want[2:]]


@pytest.mark.parametrize("open_", ["<a name=top>", "<a href=x>", "<a href=x>x <a href=y>y</a>", "<button>", "<select><option>", "<object data=x>",
                                  "<video src=x />", "<audio/>", "<canvas/>", "<video src=x>", "<textarea>", "<svg/>", "<template/>"])
def test_elements_left_open_hide_no_text(open_):
    a, b = "first words " * 20, "other words " * 30
    for page in (f"<article><p>Lead in {open_}</p><p>{a}</p><div><p>{b}</div></article>", f"<article><div>Lead in {open_}<p>{a}<p>{b}</div>"):
        got = html_text.main_text(page).split("\n")
        assert got[0].startswith("Lead in") and got[1:] == [a.strip(), b.strip()]
    assert html_text.main_text(f"<div><p>Lead in <video src=x /> and on</p><p>{a}</p></div>").startswith("Lead in and on\n")


def test_elements_with_their_ends_stay_silent():
    a = "first words " * 20
    for part in ("<button><div>Share</div></button>", "<select><option>x<option>y</select>", "<video src=x><p>No video</p></video>",
                 "<svg><title>t</title><path/><text>t</text></svg>", "<script>let a = '<p>'</script>", "<button>Share<p></p>",
                 "<noscript><p>n</p></noscript>", "<select><option>x<option>y<div></div>"):
        assert html_text.main_text(f"<div><p>{a}</p>{part}<p>End</p></div>") == f"{a.strip()}\nEnd"
    card = "<a href=x><h3>Title</h3><p>Teaser of a page</p></a>"  # a link around blocks, with its end
    assert html_text.main_text(f"<div>{card}{card}<p>{a}</p></div>") == a.strip()


@pytest.mark.parametrize("page", ["", None, "<p>", "<nav>menu</nav>", "<script>x()</script>", "<!-- c -->", "<", "<a href="])
def test_pages_without_text(page):
    assert html_text.main_text(page) in ("", "<", "<a href=")


def test_odd_pages():
    assert html_text.main_text("plain &lt;text") == "plain <text"
    assert html_text.main_text("<div>" * 3000 + "deep" + "</p></b>" * 10) == "deep"
    many = "".join(f"<p>paragraph number {k}</p>" for k in range(3000))
    assert len(html_text.main_text(f"<article>{many}</article>").split("\n")) == 3000


@pytest.mark.parametrize("name", ["has-sidebar", "content-with-sidebar", "post-header-fixed", "no-comments", "main-menu-page", "sidebar-layout"])
def test_wrappers_named_after_what_they_hold(name):
    """A class word on an element around the article does not make it aside; real sidebars and comments still go."""
    a, b = "first words " * 20, "other words " * 30
    article = f"<h1>T</h1><p>{a}</p><p>{b}</p>"
    rest = f'<div class="left-sidebar"><p>{"side " * 40}</p></div><div id="comments"><p>{"I say " * 60}</p></div>'
    for inner in (article, f"<article>{article}</article>", f"<div class=body>{article}</div>"):
        for after in ("", rest):
            got = html_text.main_text(f'<body><nav><a href=x>Home</a></nav><div class="{name}">{inner}{after}</div><footer>f</footer></body>')
            assert got.split("\n") == ["T", a.strip(), b.strip()]


def test_parts_of_an_article_named_like_asides():
    a, b = "first words " * 20, "other words " * 30
    page = f"""<body><div class="site-header"><h2>Site</h2></div><article><div class="entry-header"><h1>T</h1></div><p>{a}</p>
      <section id="market-share"><h2>Market share</h2><p>{b}</p></section><div class="social-share"><a href=x>Share</a> it</div>
      <div class="popular-posts-sidebar"><p>{a}</p></div></article><div class="cookie-notice"><p>{b}</p></div></body>"""
    assert html_text.main_text(page).split("\n") == ["T", a.strip(), "Market share", b.strip()]
    words = {"sidebar": 2, "site-footer": 1, "has-sidebar": 0, "market-share": 0, "entry-header": 0, "weatherWidget": 0, "relatedPosts": 1,
             "popular-posts-sidebar": 1, "nav-item-3": 1, "no-comments": 0, "": 0, "shareholder": 0}
    assert {w: html_text.hint(w, False) for w in words} == words


def made_page(rng):
    """A page of chance layout, and the blocks of its article."""
    text = lambda lo, hi: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(lo, hi)))
    blocks = [("h1", text(2, 8)), ("p", text(20, 60))]
    for _ in range(rng.randrange(2, 12)):
        blocks.append(rng.choice([("p", text(15, 120)), ("p", text(1, 6)), ("h2", text(1, 5)), ("li", text(2, 20)), ("blockquote", text(10, 40))]))
    blocks.append(("p", text(30, 90)))
    body = "".join(f"<ul><li>{t}</li></ul>" if k == "li" else f"<{k}>{t}</{k}>" for k, t in blocks)
    holder = rng.choice(["<article>{}</article>", "<main>{}</main>", "<main><article class=post>{}</article></main>", "<div class=content>{}</div>",
                         '<div class="row has-sidebar"><div class="entry-content">{}</div></div>'])
    links = "".join(f"<li><a href=/{k}>{text(1, 3)}</a></li>" for k in range(rng.randrange(3, 9)))
    before = rng.sample([f"<nav><ul>{links}</ul></nav>", f"<header><h2>{text(1, 3)}</h2></header>", f'<div class="ad">{text(3, 9)}</div>',
                         f'<div id="cookie-banner"><p>{text(10, 30)}</p></div>', f"<ul class=menu>{links}</ul>"], rng.randrange(1, 5))
    after = rng.sample([f'<div class="sidebar"><p>{text(10, 40)}</p></div>', f"<aside>{text(5, 20)}</aside>", f"<footer>{text(5, 20)}</footer>",
                        f'<section id="comments"><p>{text(30, 90)}</p><p>{text(30, 90)}</p></section>', f"<form>{text(2, 6)}<input></form>",
                        f'<div class="related-posts"><ul>{links}</ul></div>'], rng.randrange(1, 5))
    return f"<html><head><title>x</title></head><body>{''.join(before)}{holder.format(body)}{''.join(after)}</body></html>", [t for _, t in blocks]


WORDS = "river stone letter amber candle winter orchard signal harbor meadow copper lantern".split()


def test_made_pages_give_their_articles():
    rng = random.Random(77)
    for _ in range(400):
        page, blocks = made_page(rng)
        assert html_text.main_text(page).split("\n") == blocks, page


def test_smoothing_and_threshold():
    import numpy as np

    flat = html_text.smoothed(np.ones(9))
    assert flat[4] == pytest.approx(1) and flat[0] < 1
    assert html_text.content_lines(np.array([1, 1, 90, 80, 95, 1, 0.0])).tolist() == [False, True, True, True, True, True, False]


def test_page_query(spark, small):
    rows = queries.QUERIES["op7_html_text"](spark, small).collect()
    html = {r.page_id: r.html for r in queries.table(spark, small, "pages").collect()}
    assert len(rows) == len(html) and all(r.text == html_text.main_text(html[r.page_id]) and r.n_chars == len(r.text) for r in rows)
    assert sum(r.n_chars > 0 for r in rows) > 0.9 * len(rows)


URLS = [None, "", "no scheme", "http://", "http://COM", "http://a.com/", "http://Example.com/en/x?y", "http://www.example.com/en/",
        "http://x.www.example.com/en/a", "http://notexample.com/en/", "http://example.com/EN/", "x://net/es/1#f", "://a.net/fr/",
        "http://a.net/de/", "http://a.org/en/", "http://a.net?/es/", "http://é.com/x\ny", "a://b://c.com/"]


def test_url_rules_equal_trying_each_rule(spark):
    pages = spark.createDataFrame([(k, u, "r", "v") for k, u in enumerate(URLS)], "page_id long, url string, rule string, verdict string")
    rows = sorted(url_filters.judge(pages, queries.URL_RULES, shard=2).collect(), key=lambda r: r.page_id)
    assert len(rows) == len(URLS)
    for r in rows:
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in queries.URL_RULES
                if (r.host == h or r.host.endswith("." + h)) and r.path.startswith(p)]
        assert (r.rule, r.verdict) == (max(fits)[2:] if fits else (None, "allow"))
    assert [rows[6].host, rows[6].path, rows[3].host] == ["example.com", "/en/x", ""]
    assert {r.verdict for r in url_filters.judge(pages, []).collect()} == {"allow"}
    assert url_filters.judge(pages.where("page_id < 0"), queries.URL_RULES).collect() == []


def test_equal_digests_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(url_filters, "digests", lambda texts: np.array([len(t) % 2 for t in texts], np.uint64))
    index = url_filters.Index([("a.com", "/x", "block"), ("b.com", "/yy", "block"), ("c.org", "/zz", "allow"), ("a.com", "/x", "allow")])
    got = url_filters.best_rules(index, index.mapped(), ["a.com", "q.b.com", "d.com", "c.org"], ["/xx", "/yy", "/x", "/"])
    assert got == [("a.com", "/x", "block"), ("b.com", "/yy", "block"), None, None]


def test_host_rules(spark, docs_of):
    good = " ".join(f"w{k}" for k in range(40))
    rows = [(k, "bad text" if k % 3 == 0 or k % 30 == 1 else f"{good} d{k}") for k in range(120)]
    out = {r.doc_id: r for r in host_rules.judge(docs_of(rows)).collect()}
    assert all(out[k].base_failed and not out[k].kept for k in range(0, 120, 3))
    assert all(out[k].kept == (k % 30 != 1) for k in range(120) if k % 3)
    extra = [(k, f"{good} e{k}") for k in range(300, 303)]  # clean texts of the host whose texts nearly all fail
    out = {r.doc_id: r for r in host_rules.judge(docs_of(rows + extra)).collect()}
    assert not out[300].base_failed and not out[300].kept and out[301].kept


def test_measures():
    text = "a b c d e x a b c d e\n#$ é\n\n#$ é\n \n#$ é "
    assert host_rules.measure(text) == (17, 20, 6, 1, 10)
    assert host_rules.measure("a a a a a a a") == (7, 7, 0, 0, 7)
    assert host_rules.measure(None) == host_rules.measure("") == (0, 0, 0, 0, 0)


def test_host_rule_cases(spark, docs_of):
    rows = host_rules.judge(docs_of(ODD)).collect()
    assert len(rows) == len(ODD) and all(r.base_failed for r in rows if r.doc_id != 7)
    nohost = docs_of(ODD).selectExpr("doc_id", "text", "cast(null as string) as host", "1 as n_words")
    assert len(host_rules.judge(nohost, "host").collect()) == len(ODD)
    assert host_rules.judge(docs_of(ODD).where("doc_id > 99")).collect() == []


@pytest.mark.parametrize("name", ["op8_url_filters", "op9_jaccard_join", "op10_host_rules"])
def test_queries_equal_their_sql(spark, small, name):
    text, ok = compare(spark, small, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, text
