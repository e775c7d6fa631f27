import json

import pytest
from pyspark.sql import functions as F

from brightweir import fixed_values as fixed
from brightweir.functions.dates import reference
from brightweir.operators import resolve
from brightweir.plans import catalog, job, verticals
from brightweir.sinks import export
from brightweir.sources import registry
from brightweir.sources.landing import read_landed
from brightweir.sources.registry import Source

REF = "2026-09-12 12:00:00"
COLLECTED = "2026-09-12T12:30:00Z"
SF = "/root/testdata/sf0.001"


def _landed(spark, payloads):
    return spark.createDataFrame(payloads, "source string, page long, payload string")


def _known(spark):
    return resolve.dictionary(spark)


def _reasons(ingested):
    return {r.reason: r.n_rows for r in ingested.rejections.collect()}


def test_startups(spark):
    pages = [
        (fixed.STARTUP_SOURCE, 1, json.dumps({"total": 9, "items": [
            {"login": " openai ", "html_url": "https://github.com/openai", "id": 1}, {"login": "", "html_url": "u"},
            {"login": "x"}, None, {"login": "OpenAI", "html_url": "https://github.com/openai"}]})),
        (fixed.STARTUP_SOURCE, 2, "{broken"),
        (fixed.STARTUP_SOURCE, 3, '{"items": []}'),
    ]
    done = verticals.ingest_startups(_landed(spark, pages), _known(spark), F.lit(COLLECTED))
    rows = done.rows.collect()
    assert [(r.entity_name, r.source_url, r.record_type) for r in rows] == [("OpenAI", "https://github.com/openai", "STARTUP")]
    assert _reasons(done) == {"MISSING_LOGIN": 2, "MISSING_URL": 1, "UNREADABLE_PAYLOAD": 1}
    metrics = done.metrics.first()
    assert (metrics.discovered, metrics.valid, metrics.duplicates, metrics.rejected) == (6, 1, 1, 4)
    assert [r.raw_name for r in done.mapping_log.orderBy("raw_name").collect()] == ["OpenAI", "openai"]


def test_products(spark):
    items = [{"id": "openai/gpt/2"}, {"id": "", "_id": "plain"}, {"_id": ""}, {"id": "Mistral AI SAS/m"}]
    done = verticals.ingest_products(_landed(spark, [(fixed.PRODUCT_SOURCE, 0, json.dumps(items))]), _known(spark), F.lit(COLLECTED))
    rows = {r.source_url: (r.startup_name, r.pricing_model) for r in done.rows.collect()}
    assert rows == {
        fixed.MODEL_SITE_PREFIX + "openai/gpt/2": ("OpenAI", "FREE"), fixed.MODEL_SITE_PREFIX + "plain": ("Independent", "FREE"),
        fixed.MODEL_SITE_PREFIX + "Mistral AI SAS/m": ("Mistral AI", "FREE")}
    assert _reasons(done) == {"MISSING_ID": 1}


def test_split_model_id(spark):
    df = spark.createDataFrame([("a/b/c",), ("/b",), ("b",)], "m string")
    owner, product = verticals.split_model_id(F.col("m"))
    assert [tuple(r) for r in df.select(owner, product).collect()] == [("a", "b/c"), ("", "b"), ("Independent", "b")]


def test_papers(spark):
    items = [
        {"paper": {"id": "1", "title": "T", "authors": [{"name": " A "}, {"name": ""}, {}], "publishedAt": "2026-09-12T10:00:00.000Z",
                   "githubRepo": "o/r", "githubStars": None}},
        {"paper": {"id": "2", "githubRepo": "https://github.com/O/R", "githubStars": 3}, "title": "Outer", "publishedAt": "in press"},
        {"paper": {}}, {"title": "no paper"}, {"paper": {"id": ""}},
    ]
    stars = spark.createDataFrame([("o/r", 12000)], "repo_key string, stars long")
    done = verticals.ingest_papers(_landed(spark, [("Papers With Code", 0, json.dumps(items))]), stars, F.lit(COLLECTED))
    rows = sorted((r.title, r.authors, r.paper_url, r.github_url, r.github_stars, r.published_date) for r in done.rows.collect())
    assert rows == [
        ("Outer", [], fixed.ABSTRACT_PREFIX + "2", "https://github.com/O/R", 3, "in press"),
        ("T", ["A"], fixed.ABSTRACT_PREFIX + "1", "https://github.com/o/r", 12000, "2026-09-12T10:00:00Z"),
        ("Untitled Paper", [], "", None, None, "")]
    assert _reasons(done) == {"EMPTY_RECORD": 2}
    assert done.mapping_log is None


RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>feed</title><link>x</link>
<item><title> A &amp; B </title><link>https://n.example/1</link><pubDate>Sat, 12 Sep 2026 08:00:00 GMT</pubDate>
<description><![CDATA[<p>Hello <script>x</script>world</p>]]></description></item>
<item><title>Old</title><link>https://n.example/2</link><pubDate>Sat, 05 Sep 2026 08:00:00 GMT</pubDate></item>
<item><title>Undated</title><link>https://n.example/3</link></item>
<item><title>Vague</title><link>https://n.example/4</link><pubDate>2 hours ago</pubDate></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>feed</title>
<entry><title type="html">C</title><link rel="alternate" href="https://n.example/5"/><link rel="x" href="https://n.example/no"/>
<published>2026-09-12T09:00:00Z</published><updated>2020-01-01T00:00:00Z</updated><summary type="html">&lt;b&gt;sum&lt;/b&gt;</summary><content>con</content></entry>
<entry><title>D</title><link href="https://n.example/6"/><updated>2026-09-12T11:00:00Z</updated><content type="html">con</content></entry>
<entry><title>Soon</title><link href="https://n.example/7"/><updated>2026-09-13T11:00:00Z</updated></entry></feed>"""


FEEDS = [Source("R", "rss"), Source("A", "atom")]


def test_news_reads_both_dialects(spark):
    landed = _landed(spark, [("R", 0, RSS), ("A", 0, ATOM)])
    done = verticals.ingest_news(landed, reference(REF), F.lit(COLLECTED), sources=FEEDS)
    rows = sorted((r.title, r.source_name, r.source_url, r.published_date, r.summary) for r in done.rows.collect())
    assert rows == [
        ("A & B", "R", "https://n.example/1", "2026-09-12T08:00:00Z", "Hello world"),
        ("C", "A", "https://n.example/5", "2026-09-12T09:00:00Z", "sum"),
        ("D", "A", "https://n.example/6", "2026-09-12T11:00:00Z", "con")]
    assert _reasons(done) == {"STALE_RECORD": 1, "MISSING_DATE": 1, "UNPARSEABLE_DATE": 1, "FUTURE_TIMESTAMP": 1}


JOBS = {
    "RemoteOK AI": json.dumps([{"legal": "x"}, {"id": 7, "date": "2026-09-12T08:00:00+00:00", "company": "OpenAI Inc", "url": ""},
                            {"id": 8, "date": "", "company": "B", "url": "u"}]),
    "Jobicy AI": json.dumps({"jobs": [{"pubDate": "2026-09-12 07:00:00", "companyName": "Scale AI", "url": "u2"},
                                   {"pubDate": "2026-09-12 07:00:00", "companyName": None, "url": "u3"}]}),
    "Remotive AI": json.dumps({"jobs": [{"publication_date": "2026-09-12T06:00:00", "company_name": "Acme", "url": "u4"}]}),
    "WeWorkRemotely": "<rss><channel><item><title>Cohere: Dev</title><link>u5</link><pubDate>Sat, 12 Sep 2026 05:00:00 +0000</pubDate></item>"
                      "<item><title>A very long company title without a colon</title><link>u6</link><pubDate>Sat, 12 Sep 2026 05:00:00 +0000</pubDate></item>"
                      "<item><title>: Dev</title><link>u9</link><pubDate>Sat, 12 Sep 2026 05:00:00 +0000</pubDate></item></channel></rss>",
    "Arbeitnow AI": json.dumps({"data": [
        {"created_at": 1789200000, "company_name": "Groq", "url": "u7", "tags": ["Data"], "title": "x", "remote": False},
        {"created_at": "3 hours ago", "company_name": "Harvey", "url": "u8", "tags": [], "title": "AI dev"},
        {"created_at": 1789200000, "company_name": "Off", "url": "u10", "tags": ["ops"], "title": "cook"}]}),
}


def _jobs(spark):
    landed = _landed(spark, [(name, 0, payload) for name, payload in JOBS.items()])
    return verticals.ingest_jobs(landed, _known(spark), reference(REF), F.lit(COLLECTED))


def test_jobs_harmonise_five_layouts(spark):
    done = _jobs(spark)
    rows = {(r.source_name, r.company, r.source_url, r.published_date[11:13], r.is_remote) for r in done.rows.collect()}
    assert rows == {
        ("RemoteOK", "OpenAI", fixed.BOARD_A_PREFIX + "7", "08", True), ("Jobicy", "Scale AI", "u2", "07", True), ("Remotive", "Acme", "u4", "06", True),
        ("WeWorkRemotely", "Cohere", "u5", "05", True), ("WeWorkRemotely", "A Very Long Title With", "u6", "05", True),
        ("WeWorkRemotely", "Unknown", "u9", "05", True), ("Arbeitnow", "Groq", "u7", "08", False), ("Arbeitnow", "Harvey", "u8", "09", True)}
    assert _reasons(done) == {"MISSING_DATE": 1, "MISSING_COMPANY": 1, "NOT_TOPICAL": 1}


def test_running_twice_inserts_nothing_new(spark, tmp_path):
    root = str(tmp_path / "tables")
    first = verticals.run_vertical(_jobs(spark), root)
    again = verticals.run_vertical(_jobs(spark), root)
    assert first == {"inserted": 8, "duplicates": 0, "rejected": 3} and again == {"inserted": 0, "duplicates": 8, "rejected": 3}
    assert export.read_output_table(spark, root, "jobs").count() == 8
    assert export.read_output_table(spark, root, "entity_mappings").count() == 16
    assert export.read_output_table(spark, root, "news") is None
    with pytest.raises(ValueError):
        export.read_output_table(spark, root, "processed_urls")


def test_limit_takes_the_first_accepted_rows(spark):
    items = [{"login": "" if i % 2 else f"org{i}", "html_url": "u"} for i in range(20)]
    pages = [(fixed.STARTUP_SOURCE, 1, json.dumps({"items": items[10:]})), (fixed.STARTUP_SOURCE, 0, json.dumps({"items": items[:10]}))]
    done = verticals.ingest_startups(_landed(spark, pages), _known(spark), F.lit(COLLECTED), limit=6)
    # The rows rejected before the sixth accepted one stay and count.
    assert {r.raw_name for r in done.judged.collect()} == {f"org{i}" for i in (0, 2, 4, 6, 8, 10)} | {None}
    assert _reasons(done) == {"MISSING_LOGIN": 5}
    more = verticals.ingest_startups(_landed(spark, pages), _known(spark), F.lit(COLLECTED), limit=11)
    metrics = more.metrics.first()
    assert (metrics.discovered, metrics.valid, metrics.duplicates, metrics.rejected) == (20, 10, 0, 10)


def test_no_page_vanishes(spark):
    pages = [("GitHub AI Organizations", 0, '{"items": [{"login": "a", "html_url": "u"}]}'), ("Elsewhere", 0, "{}"),
             ("Elsewhere", 1, None), (None, 0, "x"), ("Y Combinator", 0, '{"items": [{"login": "b", "html_url": "u"}, {"login": "c"}]}')]
    sources = [Source("GitHub AI Organizations", "organisations"), Source("Y Combinator", "organisations", enabled=False)]
    done = verticals.ingest_startups(_landed(spark, pages), _known(spark), F.lit(COLLECTED), sources=sources)
    assert _reasons(done) == {"UNKNOWN_SOURCE": 3, "DISABLED_SOURCE": 2}
    metrics = done.metrics.first()
    assert (metrics.discovered, metrics.valid, metrics.duplicates, metrics.rejected) == (6, 1, 0, 5)


def test_wrong_types_are_quarantined(spark):
    papers = [{"paper": {"id": "1", "githubStars": "many"}}, {"paper": {"id": "2", "authors": "z"}}, {"paper": {"id": "3", "other": 1}},
              {"paper": {"other": 1}}, {"paper": {"id": "4", "githubStars": "7", "authors": []}}, {"paper": {"id": "5", "authors": {"name": "n"}}}, {"paper": 5}]
    stars = spark.createDataFrame([], "repo_key string, stars long")
    done = verticals.ingest_papers(_landed(spark, [("Papers With Code", 0, json.dumps(papers))]), stars, F.lit(COLLECTED))
    assert _reasons(done) == {"BAD_TYPE_GITHUBSTARS": 1, "BAD_TYPE_AUTHORS": 2, "BAD_TYPE_PAPER": 1}
    assert {(r.paper_url, r.github_stars) for r in done.rows.collect()} >= {(fixed.ABSTRACT_PREFIX + "3", None), (fixed.ABSTRACT_PREFIX + "4", 7)}
    post = {"created_at": 1789200000, "company_name": "Groq", "url": "u", "title": "AI"}
    posts = [post | {"remote": "yes"}, post | {"remote": False, "tags": None}, post | {"tags": "ops"}, post | {"tags": [1, "x"], "remote": None}]
    landed = _landed(spark, [("Arbeitnow AI", 0, json.dumps({"data": posts}))])
    done = verticals.ingest_jobs(landed, _known(spark), reference(REF), F.lit(COLLECTED))
    assert _reasons(done) == {"BAD_TYPE_REMOTE": 1, "BAD_TYPE_TAGS": 1}
    assert done.judged.where("reason is null").count() == 2


def test_sources_arrive_in_the_order_of_the_registry(spark):
    # Of equal keys the one of the earlier source wins, then the lower page by number.
    item = '{"jobs": [{"%s": "2026-09-12T08:00:00", "%s": "Acme", "url": "u"}]}'
    boards = {"Remotive AI": item % ("publication_date", "company_name"), "Jobicy AI": item % ("pubDate", "companyName")}
    done = verticals.ingest_jobs(_landed(spark, [(n, 0, p) for n, p in boards.items()]), _known(spark), reference(REF), F.lit(COLLECTED))
    assert [r.source_name for r in done.rows.collect()] == ["Jobicy"]


def test_landed_files(spark, tmp_path):
    for page, payload in {2: '[{"id": "openai/a"}]', 10: '[{"id": "openai/b"}, {"id": ""}]'}.items():
        (tmp_path / f"v1_page_{page}.json").write_text(payload)
    landed = read_landed(spark, str(tmp_path), fixed.PRODUCT_SOURCE)
    assert {r.page for r in landed.collect()} == {2, 10}
    done = verticals.ingest_products(landed, _known(spark), F.lit(COLLECTED))
    assert {r.source_url for r in done.rows.collect()} == {fixed.MODEL_SITE_PREFIX + "openai/a", fixed.MODEL_SITE_PREFIX + "openai/b"}
    assert _reasons(done) == {"MISSING_ID": 1}


def test_whole_run(spark, tmp_path):
    landed = {
        "news": _landed(spark, [("TechCrunch AI", 0, RSS), ("The Verge AI", 0, ATOM)]),
        "jobs": _landed(spark, [(name, 0, payload) for name, payload in JOBS.items()]),
    }
    options = dict(export_dir=str(tmp_path / "csv"))

    def once():
        rows = job.run(spark, landed, str(tmp_path / "tables"), REF, COLLECTED, **options).collect()
        return {r.vertical: (r.discovered, r.valid, r.duplicates, r.rejected) for r in rows}

    assert once() == {"news": (7, 3, 0, 4), "jobs": (11, 8, 0, 3), "ALL": (18, 11, 0, 7)}
    assert once() == {"news": (7, 0, 3, 4), "jobs": (11, 0, 8, 3), "ALL": (18, 0, 11, 7)}
    assert sorted(p.name for p in (tmp_path / "csv").iterdir()) == ["entity_mapping_log.csv", "jobs.csv", "news.csv"]
    with pytest.raises(ValueError):
        job.run(spark, {"other": landed["news"]}, str(tmp_path), REF, COLLECTED)


@pytest.mark.parametrize("name", list(catalog.VERTICALS))
def test_every_row_is_accounted_for(spark, name):
    done = catalog.VERTICALS[name](spark, SF)
    metrics = done.metrics.first()
    assert metrics.discovered == metrics.valid + metrics.duplicates + metrics.rejected == done.judged.count()
    assert metrics.valid == done.rows.count() and metrics.rejected == done.quarantine.count()


def test_csv_mirror(spark, tmp_path):
    df = spark.createDataFrame(
        [("a\n\"b\", c ", True, ["x", "é"], None), (" lead", False, [], 3)], "t string, flag boolean, tags array<string>, n int")
    empty = df.where("n = 99")
    written = export.export_csv({"jobs": df, "news": empty, "entity_mappings": df}, str(tmp_path))
    assert list(written) == ["Jobs", "Entity Mapping Log"] and written["Entity Mapping Log"].endswith("entity_mapping_log.csv")
    back = export.read_csv_mirror(spark, written["Jobs"], df.columns)
    assert {tuple(r) for r in back.collect()} == {("a\n\"b\", c ", "1", '["x","é"]', None), (" lead", "0", "[]", "3")}
    assert {tuple(r) for r in export.text_matrix(df).collect()} == {("a\n\"b\", c ", "1", '["x","é"]', ""), (" lead", "0", "[]", "3")}
    with pytest.raises(ValueError):
        export.export_csv({"other": df}, str(tmp_path))


def test_registry(spark):
    listed = [("news", "a", "feed", "rss_xml", None, True), ("news", "b", "feed", "atom_xml", 2, False), ("news", "c", "html", "x", 2, True)]
    assert registry.sources_of("news", listed) == [Source("a", "rss"), Source("b", "atom", enabled=False)]
    sources = registry.registry(spark, listed)
    rows = spark.createDataFrame([("a", None), ("a", "UNREADABLE_PAYLOAD"), ("b", "DISABLED_SOURCE")], "source string, fault string")
    got = {(r.name, r.enabled, r.n_rows, r.n_disabled) for r in registry.coverage(rows, sources).collect()}
    assert got == {("a", True, 1, 0), ("b", False, 0, 1), ("c", True, 0, 0)}
    assert registry.registry(spark).count() == 16
