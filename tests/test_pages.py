import random

from pyspark.sql import functions as F

from brightweir.functions import html
from brightweir.operators import chunking
from brightweir.operators.chunking import chunk_one

PAGE = """<html><head><title>T &amp; x</title><style>a{}</style><script>var t="</p>";</script></head><body><nav>menu</nav>
<div class="Cookie-Banner">cookie <b>inner</b></div><h1>Head</h1><p>One <b>two<br>three<p>four</p><!-- gone -->
<div class="ad">kept</div><div class="download-btn">load</div><ruby>k<rt>r</rt></ruby><template>tmpl</template>
<footer>foot</footer></body></html>"""


def test_clean_text_drops_noise(column_values):
    assert column_values(html.clean_html, [PAGE, "", None]) == ["T & x Head One two three four kept k", "", ""]


def test_clean_text_cuts_after_parsing(column_values):
    assert column_values(lambda c: html.clean_html(c, 5), ["<p>" + "<i></i>" * 50 + "abcdefgh</p>"]) == ["abcde"]


def test_stray_end_tags_are_ignored(column_values):
    pages = ["a</nav>b", "<nav>x<p>y</nav>z", "<nav>x</p>y", "<p>a</P>b", "x<br/>y</br>z", "<svg/>a", "<button>b<button>c</button>d</button>e"]
    assert column_values(html.clean_html, pages) == ["a b", "z", "", "a b", "x y z", "a", "e"]


def test_character_references(column_values):
    pages = ["&lt;b&gt; &eacute; &#233; &#xe9; &#150; &nosuch; &ampx", "a &middot b"]
    assert column_values(html.clean_html, pages) == ["<b> é é é – &nosuch &ampx", "a · b"]


def test_malformed_pages_never_fail(column_values):
    rng = random.Random(5)
    bits = ["<", ">", "</", "<p", "<div class='ad-x'>", "<!--", "-->", "&", "&#", "&#x110000;", "text", "<script>", "</script>", "<![", "<?", "\"", "='"]
    pages = ["".join(rng.choices(bits, k=30)) for _ in range(400)]
    assert all(isinstance(t, str) for t in column_values(html.clean_html, pages))


def test_metadata(spark):
    page = """<head><title>First</title><title>Second</title><meta NAME="Description" content=" d "><meta property="og:title" content="one">
    <meta name="og:title" content="two"><meta property="article:published_time" content="2026-09-12">
    <script type="application/ld+json">[{"datePublished": "no"}]</script><script type="application/ld+json">{broken</script>
    <script type="application/ld+json"> {"datePublished": "", "uploadDate": "2026-01-01"} </script></head>
    <time>2 <b>hours</b> ago</time><time datetime="x">y</time>"""
    df = spark.createDataFrame([(page,), ("<p>x",), (None,)], "h string")
    rows = df.select(html.page_parts(F.col("h")).alias("p")).select("p.*", html.json_ld_date(F.col("p.json_ld")).alias("d")).collect()
    first = rows[0]
    assert (first.title, first.description, first.og_title, first.og_published_time) == ("First", "d", "two", "2026-09-12")
    assert (first.time_tag, len(first.json_ld), first.d) == ("2hoursago", 2, "2026-01-01")
    assert rows[1].title is None and rows[1].text == "x" and rows[2].text == ""


def test_strip_tags(column_values):
    assert column_values(html.strip_tags, ["<p>a</p>\n<b>b", None]) == ["a b", ""]


def test_short_and_empty_texts():
    assert chunk_one("abc", 200) == ["abc"] and chunk_one("", 200) == [] and chunk_one(None, 200) == []


def test_sentences_are_packed():
    chunks = chunk_one("Rain fell on the quiet harbour all night! " * 31, 170)
    assert len(chunks) > 1 and all(len(c) <= 170 for c in chunks)


def test_joins_follow_the_flush():
    assert chunk_one("aaaa\n\nbbbb\n\ncccc", 12) == ["aaaa\n\nbbbb", "cccc"]
    # Sentences left over at the end are joined like paragraphs, which may exceed the limit.
    assert chunk_one("A b. C d. E f. G h.", 14) == ["A b. C d.", "E f.\n\nG h."]
    assert chunk_one("x" * 30, 10) == ["x" * 30]


def test_words_of_long_sentences_start_a_chunk():
    assert chunk_one("ab. " + " ".join(["cc"] * 5), 10) == ["ab.", "cc cc cc", "cc\n\ncc"]


def test_strict_chunks_keep_the_limit_and_every_letter(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(60):
        words = ["".join(rng.choices("ab.?", k=rng.choice([1, 3, 8, 40]))) for _ in range(rng.randint(1, 60))]
        texts.append("".join(w + rng.choice([" ", " ", ". ", "\n\n"]) for w in words))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(3)
    rows = chunking.chunk_table(df, "t", 25, strict=True).collect()
    assert rows and not any(r.over_limit for r in rows)
    for i, t in enumerate(texts):
        joined = "".join(r.chunk for r in sorted((r for r in rows if r.i == i), key=lambda r: r.chunk_no))
        assert "".join(joined.split()) == "".join(t.split())


def test_fitted(spark):
    df = spark.createDataFrame([("x" * 3000,), ("x" * 100000,), ("ok",), (None,)], "t string")
    rows = [r.f for r in df.select(chunking.fitted(F.col("t"), 1000).alias("f")).collect()]
    assert [(len(r.text), r.steps) for r in rows] == [(750, 2), (6250, 4), (2, 0), (0, 0)]
