"""Wrapper text and URL models."""

import functools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightweir.llm import html_wrapper, url_filter
from brightweir.llm.html_wrapper import Node, Page, induced, main_text, matched, text_key

PAGE = "page_id long, url string, html string"


# --- Trees and wrappers -----------------------------------------------------

def random_tree(depth: int) -> Node:
    node = Node(random.choice("ab"))
    if depth:
        node.below = [random_tree(depth - 1) for _ in range(random.randint(0, 3))]
    return node


def most_matched(a: Node, b: Node) -> int:
    """Size of the largest matching, by trying to drop a child on either side."""
    if a.label != b.label:
        return 0

    @functools.cache
    def best(i: int, j: int) -> int:
        if i == len(a.below) or j == len(b.below):
            return 0
        return max(best(i + 1, j), best(i, j + 1), best(i + 1, j + 1) + most_matched(a.below[i], b.below[j]))

    return 1 + best(0, 0)


def test_matching_is_the_largest():
    random.seed(1)
    for _ in range(200):
        a, b = random_tree(3), random_tree(3)
        pairs = matched(a, b)
        assert len(pairs) == most_matched(a, b)
        assert all(x.label == y.label for x, y in pairs)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)


def test_matching_of_wide_and_deep_trees():
    wide = [Page("<div>" + f"<h2>a{i}</h2><p>b{i}</p>" * 4000 + "</div>").root for i in range(2)]
    start = time.monotonic()
    assert len(matched(*wide)) == 4
    assert time.monotonic() - start < 1
    chain = Node("a")
    for _ in range(5000):
        node = Node("a")
        node.below = [chain]
        chain = node
    assert len(matched(chain, chain)) == 5001


def page(i: int, body: str = "") -> str:
    return f"<body><div class=top><p>Our site</div><div class=box><p>Story {i}</p><p>Follow us</p>{body}</div></body>"


@pytest.mark.parametrize("n", [2, 7, 10])
def test_template_is_what_pages_share(n):
    pages = [page(i) for i in range(n)]
    wrapper = induced(pages)
    assert main_text(pages[1], wrapper) == "Story 1"
    assert main_text(pages[1]) == "Our site\nStory 1\nFollow us"
    # The same text at another place is content; a page may lack a part of the template.
    assert main_text("<body><div class=box><p>New</div>", wrapper) == "New"
    assert main_text("<body><div class=box><p>New</div><div class=box><section>Follow us</section>", wrapper) == "New\nFollow us"


def test_what_shows_nothing_is_no_template():
    # Copies, a single page, a text of half of the pages.
    assert induced([page(0)] * 16) is None and induced([page(0)]) is None
    half = [page(i, "<p>Half" if i % 2 else "") for i in range(10)]
    path = next(block.node.path for block in Page(half[1]).blocks if block.text == "Half")
    assert text_key(path, "Half") not in induced(half).template
    # Two articles with the same heading and a long line in common.
    pages = [f"<nav>n{i}</nav><article><h1>Title</h1><p>{'shared ' * 20}</p><p>{f'own{i} ' * 40}</p></article>" for i in range(2)]
    assert main_text(pages[1], induced(pages)).startswith("Title\nshared") and "own1" in main_text(pages[1], induced(pages))


def site(i: int) -> str:
    """A page without telling names whose menu, advert and footer vary."""
    words = " ".join(f"w{i}x{k}" for k in range(60))
    menu = "".join(f"<li><a href=/{k}>topic {(i * 7 + k) % 30}</a></li>" for k in range(6))
    return (
        f"<body><div class=a><ul>{menu}</ul></div><div class=b>Offer number {i % 4} of the week</div>"
        f"<div class=c><h1>Title {i}</h1><div class=d><p>{words}</p><h2>Part {i}</h2><p>{words} end</p></div></div>"
        f"<div class=e>All rights held since {1990 + i % 3}</div></body>"
    )


def test_varying_menus_and_adverts_go_by_structure():
    pages = [site(i) for i in range(24)]
    wrapper = induced(pages)
    for i in (0, 5, 23):
        text = main_text(pages[i], wrapper, prior=False).split("\n")
        assert [text[0], text[2]] == [f"Title {i}", f"Part {i}"] and len(text) == 4
    few = induced(pages[:2])
    assert len(main_text(pages[1], few, prior=False).split("\n")) == 4


def test_wrapper_of_deep_pages():
    deep = ["<div>" * 150 + "<p>Always here</p>" + f"<section>Text {i} of its own</section>" for i in range(9)]
    assert main_text(deep[4], induced(deep)) == "Text 4 of its own"


def test_spark_makes_the_wrappers_of_plain_code(spark, tables):
    pages = tables("pages", "0.01").where("url like '%example%'")
    rows = pages.select("page_id", "url", "html", url_filter.host_and_path(F.col("url"))[0].alias("host"))
    made = {r.host: r.wrapper for r in html_wrapper.wrappers(rows).collect()}
    chosen = {r.host: r.reference for r in html_wrapper.references(rows).collect()}
    by_host = {}
    for r in rows.collect():
        by_host.setdefault(r.host, []).append(r.html)
    wanted = {host: induced([chosen[host], *htmls]) for host, htmls in by_host.items() if host in chosen}
    wanted = {host: wrapper for host, wrapper in wanted.items() if wrapper}
    assert made.keys() == wanted.keys() and len(made) > 40
    for host, wrapper in wanted.items():
        assert all(frozenset(made[host][name]) == getattr(wrapper, name) for name in wrapper._fields)


def test_wrappers_alone_find_the_given_articles(tables):
    by_host = {}
    for r in tables("pages", "0.1").limit(600).collect():
        by_host.setdefault(r.url.split("/")[2].lower(), []).append(r.html)
    right = total = 0
    for htmls in by_host.values():
        wrapper = induced(htmls)
        if wrapper:
            total += len(htmls)
            right += sum(main_text(html, wrapper, prior=False) == by_pattern(html) for html in htmls)
    assert total > 500 and right >= 0.95 * total


@pytest.mark.parametrize(
    "html, text",
    [
        (None, ""),
        ("", ""),
        ("<p>a<p>b", "a\nb"),
        ("plain &lt;b&gt; &amp;\n\t x&nbsp;y", "plain <b> & x y"),
        ("<title>t</title><p>a</p>", "a"),
        ("<head><title>t</title><p>a</p>", "a"),
        ("<p>a<br>b<b>c</p>d</b>e", "a bc\nde"),
        ("<nav>n</nav><header>h</header><main><p>m</main><footer>f</footer><aside>s</aside>", "m"),
        ("<article>x<header><h1>T</h1></header><p>p</p><div class='comments'><article>no</article></div></article>z", "x\nT\np"),
        ("<article><p>a</p><form>f<input></form><div id=cookie-notice>c</div><p>b</p></article>", "a\nb"),
        ("<article><p>a <span class='ad'>buy</span> b</p></article>", "a\nb"),
        ("<div role=navigation>n</div><div hidden>h</div><div class='shadow adline'>s</div>", "s"),
        ("<script>var t='</p>';</script><style>p{}</style><noscript>x</noscript><p>y", "y"),
        ("<table><tr><td>a<td>b<tr><td>c</table><ul><li>d<li>e</ul><dl><dt>f<dd>g</dl>", "a\nb\nc\nd\ne\nf\ng"),
        ("<![CDATA[x]]><!-- c --><p>k</p>", "k"),
        ("</p></div>a</b>b", "ab"),
    ],
)
def test_main_text(html, text):
    assert main_text(html or "") == text


@pytest.mark.parametrize("html", ["<p>k<!", "b<p", "<![foo", "<!-- a", "<script>x", "<a href='", "&#x110000;&#0;&bogus", "<" * 99])
def test_broken_pages_do_not_fail(html):
    assert isinstance(main_text(html), str)


def test_long_and_deep_pages():
    assert main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert main_text("<article>" + "<p>word</p>" * 50_000) == "\n".join(["word"] * 50_000)
    assert induced(["<div>" * 2000 + str(i) for i in range(9)]).template == frozenset()


@pytest.mark.parametrize(
    "html, text",
    [
        ("<body class='right-sidebar'><p>a</p><div class='sidebar'>s</div>", "a"),
        ("<div class='content no-sidebar'><p>a</p></div>", "a"),
        ("<article class='post social-policy'><p>a</p><div class='post-comments'>c</div></article>", "a"),
        ("<main id='login-help'><p>a</p><div id='site_footer'>f</div></main>", "a"),
        ("<main class='comments'><article class='share'>a</article></main>", "a"),
        ("<div class='left-sidebar'>x<article>a<div class=ad>b</div></article></div>", "a"),
        ("<article>a</article><div class='related'><article>t</article></div>", "a"),
        ("<aside class='sidebar'><article>t</article></aside>", ""),
        ("<div class='social-policy'>a</div><div class='site-nav'>n</div><div id=share2>m</div>", "a"),
        ("<article>a<div class='ad-slot'>x</div><div class='cookie-bar'>x</div><div class='sidebar-left'>x</div>b</article>", "a\nb"),
        ("<article>a<div id='comments-area'>x</div><div class='newsletter-signup-box'>x</div></article>", "a"),
        ("<article>a<div class='share-buttons'>x</div><div class='how-to-share'>b</div></article>", "a\nb"),
    ],
)
def test_names_of_layout_are_not_noise(html, text):
    assert main_text(html) == text


def by_pattern(html: str) -> str:
    """The article of the generated pages, which hold paragraphs, breaks and bold type only."""
    import html as entities

    inside = re.search("<article>(.*?)</article>", html, re.S)[1]
    blocks = (" ".join(entities.unescape(b).split()) for b in re.split("</?p>|</?h1>|<br>", inside.replace("<b>", "")))
    return "\n".join(b for b in blocks if b)


def test_given_pages(tables):
    pages = tables("pages", "0.01")
    got = {r.page_id: r for r in html_wrapper.extracted(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert (got[r.page_id].url, got[r.page_id].text) == (r.url, by_pattern(r.html))
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


@pytest.mark.parametrize("most", [0, 16 << 20])
def test_pages_of_a_hot_host(spark, monkeypatch, most):
    monkeypatch.setattr(html_wrapper, "BROADCAST_BYTES", most)
    rows = [(i, f"https://hot.org/{i}", page(i)) for i in range(60)] + [(100 + i, f"https://h{i}.org/", page(i)) for i in range(3)]
    rows += [(None, None, None), (None, None, "<p>a"), (5, "https://hot.org/5", page(5)), (5, "https://hot.org/5", page(5))]
    more = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGE + ", host string, template string")
    got = sorted(((-1 if r.page_id is None else r.page_id, r.url or "", r.text, r.n_chars) for r in html_wrapper.extracted(more).collect()))
    wanted = [(i, u, f"Story {i}" if i < 100 else f"Our site\nStory {i - 100}\nFollow us") for i, u, _ in rows if u]
    wanted += [(-1, "", ""), (-1, "", "a")]
    assert got == sorted((*w, len(w[2])) for w in wanted)
    assert html_wrapper.extracted(spark.createDataFrame([], PAGE)).collect() == []


@pytest.mark.parametrize("most", [0, 16 << 20])
def test_template_of_all_pages(spark, monkeypatch, most):
    """Hosts of just enough pages, and of mostly copies, have their template; half of the pages are no proof."""
    monkeypatch.setattr(html_wrapper, "BROADCAST_BYTES", most)
    rows = [(100 * h + i, f"https://eight{h}.org/{i}", page(i)) for h in range(6) for i in range(8)]
    rows += [(1000 + i, "https://copies.org/", page(0)) for i in range(200)]
    rows += [(2000 + i, f"https://copies.org/{i}", page(i)) for i in range(1, 30)]
    rows += [(3000 + i, f"https://half.org/{i}", page(i, "<p>Half" if i % 2 else "")) for i in range(40)]
    got = {r.page_id: r.text for r in html_wrapper.extracted(spark.createDataFrame(rows, PAGE)).collect()}
    for i, _, html in rows:
        story = re.search("Story [0-9]+", html)[0]
        assert got[i] == (f"{story}\nHalf" if "Half" in html else story)


# --- URLs -------------------------------------------------------------------

def rule_by_hand(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url[url.index("://") + 3 :]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        rule
        for rule in url_filter.RULES
        for of_host, _, of_path in [rule.partition("/")]
        if (host == of_host or host.endswith("." + of_host)) and path.startswith("/" + of_path)
    ]
    return host, path, max(fits, key=len, default=None)


URLS = [
    None, "", "nothing", "http://", "http:///x", "https://A.Example.ORG/en/1x?q#f", "https://example.org/es/", "https://xexample.org/es/",
    "ftp://org/", "http://org", "http://b.com/fr/?a=://c", "http://com/de/1#x", "http://É.com/fr/É", "http://a.net/x?y=http://b.org/",
    "x://y://z.org/", "http://a.org?x/", "http://a\nb.org/c\nd",
]


def test_rules(spark):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in url_filter.ruled(df).collect()}
    assert got == {i: rule_by_hand(u) for i, u in enumerate(URLS)}


def test_models_learn_what_rules_decide(spark):
    random.seed(3)

    def some(host, folder, n):
        return [f"http://{''.join(random.choices('abc', k=5))}.{host}/{folder}/{random.randint(0, 999)}" for _ in range(n)]

    good, bad = some("x.com", "fr", 300), some("x.com", "de", 300)
    unknown_good, unknown_bad = some("y.net", "fr", 50), some("y.net", "de", 50)
    urls = good + bad + unknown_good + unknown_bad + unknown_bad[:1] * 2 + URLS
    df = spark.createDataFrame([(i, u, 0, "z") for i, u in enumerate(urls)], "page_id long, url string, score int, host string")
    got = {r.page_id: r for r in url_filter.filtered(df).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        rule = rule_by_hand(u)[2]
        assert got[i].rule == rule and got[i].verdict in ("allow", "block")
        assert rule is None or got[i].verdict == url_filter.RULES[rule]
    by_model = [got[i].verdict == ("allow" if "/fr/" in u else "block") for i, u in enumerate(urls) if u and ".y.net/" in u]
    assert np.mean(by_model) > 0.95


def test_nothing_to_learn_allows(spark):
    df = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None), (2, "http://a.org/")], "page_id long, url string")
    assert {r.verdict for r in url_filter.filtered(df).collect()} == {"allow"}
    assert url_filter.filtered(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_scores_are_the_smoothed_chances(monkeypatch):
    """Counts by hand: without clashing slots the tables are those of the texts."""
    texts = ["abcab", "abd", "xab"]
    at = url_filter.Contexts.of(texts)
    tables = np.zeros((2, 2, url_filter.ORDER + 1, url_filter.SLOTS), np.float32)
    for order in range(url_filter.ORDER + 1):
        for part, slots in enumerate((at.contexts[order], at.grams[order])):
            np.add.at(tables[1, part, order], slots, 1)
    model = url_filter.Model(tables[:, 0], tables[:, 1])

    def chance(text, i):
        p = 1 / 256
        padded = ["\x00" * url_filter.ORDER + t for t in texts]
        own = "\x00" * url_filter.ORDER + text
        for order in range(url_filter.ORDER + 1):
            context, char = own[i + url_filter.ORDER - order : i + url_filter.ORDER], text[i]
            places = [(t, k) for t in padded for k in range(url_filter.ORDER, len(t))]
            seen = [t[k] for t, k in places if t[k - order : k] == context]
            p = (seen.count(char) + url_filter.PRIOR * p) / (len(seen) + url_filter.PRIOR)
        return p

    tests = ["abc", "zz", "", "xabcab"]
    wanted = [sum(np.log(chance(t, i)) - np.log(1 / 256) for i in range(len(t))) / max(1, len(t)) for t in tests]
    assert np.allclose(model.scores(tests), wanted, atol=1e-5)
    monkeypatch.setattr(url_filter, "PIECE", 3)
    assert np.allclose(model.scores(tests[:3]), wanted[:3], atol=1e-5)


def test_url_scores_are_exact(spark):
    """More grams than any table of slots held, over whole URLs; the reference counts strings."""
    random.seed(9)
    letters = "abcdefghijklmnopqrstuvwxyzé"
    hosts = ["x.com/fr", "x.com/de", "y.net/a"]
    urls = [f"http://{random.choice(hosts)}/{''.join(random.choices(letters, k=20))}?q={i % 7}" for i in range(3000)]
    urls += ["http://y.net/same?l=fr", "http://y.net/same?l=de", None, "plain", "http://x.com/fr/\x00", urls[0], urls[0]]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.filtered(df).collect()}
    order, start = url_filter.ORDER, b"\xff" * url_filter.ORDER
    seen = {c: [{} for _ in range(order + 1)] for c in ("allow", "block")}
    for u in {u for u in urls if u}:
        rule = rule_by_hand(u)[2]
        if rule and zlib.crc32(u.encode()) % url_filter.KEPT_BACK:
            text = start + u.encode()
            for i in range(order, len(text)):
                for k in range(order + 1):
                    table = seen[url_filter.RULES[rule]][k]
                    for piece in (text[i - k : i], (text[i - k : i], text[i])):
                        table[piece] = table.get(piece, 0) + 1
    assert len(seen["allow"][order]) > url_filter.SLOTS // 2

    def likelihood(text, tables):
        total = 0.0
        for i in range(order, len(text)):
            p = 1 / 256
            for k in range(order + 1):
                context = text[i - k : i]
                p = (tables[k].get((context, text[i]), 0) + url_filter.PRIOR * p) / (tables[k].get(context, 0) + url_filter.PRIOR)
            total += np.log(p)
        return total

    for i, u in enumerate(urls):
        text = start + (u or "").encode()
        wanted = (likelihood(text, seen["allow"]) - likelihood(text, seen["block"])) / max(1, len(text) - order)
        assert abs(got[i].score - wanted) < 1e-9
    assert got[3000].score != got[3001].score
