import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightweir.functions.names import sorted_tokens
from brightweir.operators import dedup, enrich, extraction, freshness, lookup, relations, report, resolve, validate
from brightweir.functions.dates import reference

REF = "2026-09-12 12:00:00"


def _hot_rows(n=3000, seed=1):
    """A third of the rows share one key; the order column is shuffled."""
    rng = random.Random(seed)
    order = list(range(n))
    rng.shuffle(order)
    return [(seq, "hot" if i % 3 == 0 else f"k{rng.randint(0, 400)}", f"v{seq}") for i, seq in enumerate(order)]


def _firsts(rows):
    firsts = {}
    for seq, key, value in sorted(rows):
        firsts.setdefault(key, (seq, key, value))
    return firsts


@pytest.mark.parametrize("partitions", [1, 7])
def test_first_wins_and_repeats(spark, partitions):
    rows = _hot_rows()
    df = spark.createDataFrame(rows, "seq long, key string, value string").repartition(partitions)
    firsts = _firsts(rows)
    assert {tuple(r) for r in dedup.first_wins(df, "key", ["seq"]).collect()} == set(firsts.values())
    marked = dedup.mark_repeats(df, "key", ["seq"]).collect()
    assert len(marked) == len(rows)
    assert {r.seq for r in marked if not r.is_repeat} == {f[0] for f in firsts.values()}


def test_first_wins_with_a_composite_order(spark):
    df = spark.createDataFrame([("a", 2, 0, "x"), ("a", 1, 9, "y"), ("a", 1, 3, "z")], "key string, page int, pos int, v string")
    assert dedup.first_wins(df, "key", ["page", "pos"]).first().v == "z"
    assert [r.v for r in dedup.mark_repeats(df, "key", ["page", "pos"]).where("not is_repeat").collect()] == ["z"]


def test_scoped_sequence(spark):
    from brightweir.functions.keys import entity_key

    df = spark.createDataFrame([(0, "OpenAI"), (1, "OpenAI"), (2, "Anthropic")], "seq int, name string")
    marked = dedup.mark_repeats(df.withColumn("k", entity_key("startup", F.col("name"))), "k", ["seq"])
    assert [r.is_repeat for r in marked.orderBy("seq").collect()] == [False, True, False]


def test_upsert_is_idempotent(spark, tmp_path):
    rows = _hot_rows(600)
    path = str(tmp_path / "table")
    df = spark.createDataFrame(rows, "seq long, key string, value string")
    firsts = _firsts(rows)
    assert dedup.upsert(df, path, "key", ["seq"]) == {"inserted": len(firsts), "duplicates": len(rows) - len(firsts)}
    assert dedup.upsert(df, path, "key", ["seq"]) == {"inserted": 0, "duplicates": len(rows)}
    more = spark.createDataFrame([(0, "hot", "late"), (1, "new", "n")], "seq long, key string, value string")
    assert dedup.upsert(more, path, "key", ["seq"]) == {"inserted": 1, "duplicates": 1}
    stored = {r.key: r.value for r in spark.read.parquet(path).collect()}
    assert stored == {k: v[2] for k, v in firsts.items()} | {"new": "n"}


def test_accounting_against_a_ledger(spark):
    df = spark.createDataFrame(
        [(0, "a", "s"), (1, "a", "t"), (2, "b", "t"), (3, "c", "t")], "seq int, key string, source string")
    ledger = spark.createDataFrame([("c",)], "key string")
    got = {r.source: (r.n_read, r.n_inserted, r.n_duplicates) for r in dedup.accounting(df, "key", ["seq"], "source", ledger).collect()}
    assert got == {"s": (1, 1, 0), "t": (3, 1, 2)}


def test_frontier_and_ledger(spark):
    seen = spark.createDataFrame([(0, "https://a.com/x?utm_source=q"), (1, "https://A.com/x/")], "seq int, url string")
    ledger = dedup.url_ledger(seen, "url", F.lit("s"), F.lit("t"), ["seq"])
    assert [r.url for r in ledger.collect()] == ["https://a.com/x?utm_source=q"]
    fresh = spark.createDataFrame([("https://a.com/x#top",), ("https://a.com/y",)], "url string")
    assert [r.url for r in dedup.unseen_urls(fresh, "url", ledger).collect()] == ["https://a.com/y"]


def test_spread_lookup_equals_a_plain_join(spark):
    rng = random.Random(2)
    rows = [(i, None if i % 5 == 0 else "hot" if i % 3 == 0 else f"k{rng.randint(0, 3000)}") for i in range(9000)]
    df = spark.createDataFrame(rows, "id int, key string")
    counts = lookup.key_counts(df, "key")
    dimension = counts.withColumn("label", F.concat(F.lit("L"), "key")).where("key <> 'k7'")
    joined = lookup.spread_lookup(df, dimension, "key", ["id"])
    assert joined.columns == ["key", "id", "label"]
    got = sorted((r.id, r.key, r.label) for r in joined.collect())
    assert got == [(i, k, f"L{k}" if k and k != "k7" else None) for i, k in rows]
    # The hot key is spread over many salts.
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "salt" in plan


def test_computed_once_keeps_the_filter_above(spark):
    df = lookup.computed_once(spark.range(10), twice=F.col("id") * 2, half=F.col("id") / 2)
    assert df.columns == ["id", "twice", "half"]
    assert [r.id for r in df.where("twice > 14").orderBy("id").collect()] == [8, 9]


@pytest.mark.parametrize(
    "offset, fresh, code",
    [
        ("-5 hours", True, None), ("-23 hours", True, None), ("-25 hours", False, "STALE_RECORD"), ("-3 days", False, "STALE_RECORD"),
        ("5 minutes", True, None), ("2 hours", False, "FUTURE_TIMESTAMP"), ("-24 hours", True, None), ("15 minutes", True, None),
        ("-86401 seconds", False, "STALE_RECORD"), ("901 seconds", False, "FUTURE_TIMESTAMP"),
    ],
)
def test_freshness(spark, offset, fresh, code):
    df = spark.range(1).select((reference(REF) + F.expr(f"interval {offset}")).alias("ts"))
    row = freshness.with_freshness(df, "ts", reference(REF)).first()
    assert (row.is_fresh, row.reason_code) == (fresh, code)
    assert row.reason is None if fresh else row.reason.startswith(code)
    assert freshness.fresh_only(df, "ts", reference(REF)).count() == int(fresh)


def test_freshness_texts(spark):
    df = spark.createDataFrame([("2026-09-12T08:00:00Z",), ("2026-09-01",), ("zzz",), (None,)], "d string")
    rows = freshness.with_freshness(df, "d", reference(REF)).collect()
    assert [r.reason_code for r in rows] == [None, "STALE_RECORD", "UNPARSEABLE_DATE", "INVALID_DATE_TYPE"]
    assert rows[1].reason == "STALE_RECORD (age: 276.0h > 24h)"


def test_freshness_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select timestamp_ntz'2026-09-12 11:00:00' as ts, 1 as x").write.parquet(path)
    plan = freshness.fresh_only(spark.read.parquet(path), "ts", reference(REF))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


ORGS = ["OpenAI", "Open AI", "OpenAI, Inc.", "OpenAI Inc.", "OpenAI LLC", "Anthropic PBC", "DeepMind Tech",
        "Cybernetics Robotics Dynamics", "", None, "databrickss", "Inc.", "  Hugging  Facee ", "Scale Labs"]


def _resolve(spark, values, **options):
    known = resolve.dictionary(spark, normalize_aliases=options.pop("normalize_aliases", False))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, name string")
    rows = resolve.resolve_entities(df, "name", ["id"], known, **options).orderBy("id").collect()
    return [(r.canonical_name, r.method, r.confidence) for r in rows]


def test_resolution(spark):
    got = _resolve(spark, ORGS)
    assert got[:5] == [("OpenAI", "EXACT_ALIAS", 100.0)] * 5
    assert got[5:8] == [("Anthropic", "EXACT_ALIAS", 100.0), ("Google DeepMind", "EXACT_ALIAS", 100.0),
                        ("Cybernetics Robotics Dynamics", "NORMALIZED_TITLECASE", 60.0)]
    assert got[8:10] == [("Unknown", "EMPTY_FALLBACK", 0.0)] * 2
    assert got[10:13] == [("Databricks", "FUZZY_RAPIDFUZZ", 95.2), ("", "NORMALIZED_TITLECASE", 60.0),
                          ("Hugging Face", "FUZZY_RAPIDFUZZ", 96.0)]
    # The alias "scale labs" can only be hit once it is normalised as well.
    assert got[13] == ("Scale", "NORMALIZED_TITLECASE", 60.0)


def test_resolution_modes(spark):
    assert _resolve(spark, ["databrickss"], mode="compat") == [("Databrickss", "NORMALIZED_TITLECASE", 60.0)]
    assert _resolve(spark, ["Scale Labs"], normalize_aliases=True) == [("Scale AI", "EXACT_ALIAS", 100.0)]
    with pytest.raises(ValueError):
        _resolve(spark, ["x"], mode="other")


def test_resolution_of_a_hot_name(spark):
    values = ["Acme" if i % 3 else f"OpenAI {i} Inc" for i in range(3000)]
    got = Counter(m for _, m, _ in _resolve(spark, values))
    assert sum(got.values()) == 3000 and got["NORMALIZED_TITLECASE"] >= 2000


def test_mapping_log_has_one_row_per_record(spark):
    known = resolve.dictionary(spark)
    df = spark.createDataFrame([(0, " OpenAI ", "u0"), (1, "OpenAI", "u1"), (2, "  ", "u2")], "id int, name string, url string")
    log = resolve.mapping_log(resolve.resolve_entities(df, "name", ["id"], known), "name", "url", F.lit("t"))
    assert sorted(tuple(r) for r in log.collect()) == [
        ("  ", "Unknown", "EMPTY_FALLBACK", 0.0, "u2", "t"), ("OpenAI", "OpenAI", "EXACT_ALIAS", 100.0, "u0", "t"),
        ("OpenAI", "OpenAI", "EXACT_ALIAS", 100.0, "u1", "t")]
    stats = resolve.method_stats(log).collect()
    assert {(r.method, r.n_mappings) for r in stats} == {("EMPTY_FALLBACK", 1), ("EXACT_ALIAS", 2)}


@pytest.mark.parametrize("floor", [75.0, 88.0])
def test_pieces_find_what_comparing_all_names_finds(spark, floor):
    rng = random.Random(int(floor))
    alphabet = "abcd e"
    word = lambda: "".join(rng.choices(alphabet, k=rng.randint(2, 12))).strip() or "a"
    table = {f"{word()}{i % 3}": [] for i in range(25)}
    names = set()
    for _ in range(150):
        base = list(rng.choice(list(table)))
        for _ in range(rng.randint(0, 3)):
            base.insert(rng.randint(0, len(base)), rng.choice(alphabet)) if rng.random() < 0.5 else base and base.pop(rng.randrange(len(base)))
        names.add("".join(base).strip() or "a")
    known = resolve.dictionary(spark, table)
    df = spark.createDataFrame([(n,) for n in names], "normal string").where("normal <> ''")
    literal = resolve._best_of_literal(df, known, "folded", floor)
    pieces = resolve._best_of_pieces(df, known, "folded", floor)
    key = lambda r: (r.normal, r.best_name, round(r.best_score, 9))
    want, got = {key(r) for r in literal.collect()}, {key(r) for r in pieces.collect()}
    assert want == got and want

    # And both agree with a plain scorer.
    from test_functions import _common

    shapes = {n: " ".join(sorted(n.lower().split())) for n in table}
    expected = set()
    for name in names:
        tokens = " ".join(sorted(name.split()))
        if not tokens:
            continue
        scored = [(200.0 * _common(tokens, s) / (len(tokens) + len(s)), -i, n) for i, (n, s) in enumerate(shapes.items())]
        score, _, best = max(scored)
        if score >= floor:
            expected.add((name, best, round(score, 9)))
    assert got == expected


def test_stars(spark):
    df = spark.createDataFrame(
        [(0, "https://github.com/A/B.git", None), (1, "https://github.com/a/b", 5), (2, "https://x.org", None), (3, "https://github.com/no/ne", None), (4, None, 7)],
        "id int, repo string, own int")
    stats = spark.createDataFrame([("a/b", 12000)], "repo_key string, stars int")
    rows = enrich.with_stars(df, "repo", "own", stats, ["id"]).orderBy("id").collect()
    assert [r.stars for r in rows] == [12000, 5, None, None, 7]


def test_required_and_topical(spark):
    df = spark.createDataFrame([("a", "b"), (" ", "b"), (None, None), ("a", "")], "x string, y string")
    assert [r[0] for r in df.select(validate.required(x=F.col("x"), y=F.col("y"))).collect()] == [None, "MISSING_X", "MISSING_X", "MISSING_Y"]
    jobs = spark.createDataFrame([(["Big DATA"], "x"), ([], "Maintenance"), (None, "ops"), (["Machine Learning"], None)], "t array<string>, n string")
    assert [r[0] for r in jobs.select(validate.topical(F.col("t"), F.col("n"))).collect()] == [True, True, False, True]


def test_responses(spark):
    bodies = [
        '{"source": {"name": "n", "url": "u", "x": 1}, "content": {"entityName": "A"}}',
        '{"recordType": "INVALID_TYPE", "source": {"name": "n", "url": "u"}, "content": {"entityName": "A"}}',
        '{"source": {"name": "n"}, "content": {"data": {"employeeCount": "many"}}}',
        '{"source": {"name": "n"',
        "[1]",
        None,
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    rows = extraction.parse_responses(df, "b", "STARTUP").collect()
    assert [r.failed for r in rows] == [
        [], ["recordType"], ["source.url", "content.entityName", "content.data.employeeCount"], ["unreadable"], ["unreadable"], ["unreadable"]]
    assert (rows[0].schemaVersion, rows[0].recordType) == ("1.0", "STARTUP")


@pytest.mark.parametrize(
    "kind, body, failed",
    [
        ("PRODUCT", '{"source":{"name":"n","url":"u"},"content":{"startupName":"A","pricingModel":"FREEMIUM"}}', []),
        ("PRODUCT", '{"source":{"name":"n","url":"u"},"content":{"startupName":"A"}}', []),
        ("PRODUCT", '{"source":{"name":"n","url":"u"},"content":{"startupName":"A","pricingModel":"CHEAP"}}', ["content.pricingModel"]),
        ("RESEARCH_PAPER", '{"content":{"title":"t","authors":["a"],"paper_url":"u","github_stars":12000,"published_date":"d"}}', []),
        ("RESEARCH_PAPER", '{"content":{"title":"t","paper_url":"u","github_stars":"x"}}', ["content.published_date", "content.github_stars"]),
        ("JOB", '{"source_url":"u","source_name":"s","content":{"company":"c","date":"d","is_remote":true}}', []),
        ("JOB", '{"source_url":"u","source_name":"s","content":{"company":"c","date":"d"}}', []),
        ("JOB", '{"source_url":"u","content":{"company":"c","date":"d","is_remote":"maybe"}}', ["source_name", "content.is_remote"]),
        ("NEWS", '{"source":{"name":"n","url":"u"},"content":{"title":"t","published_date":"d"}}', []),
    ],
)
def test_record_contracts(spark, kind, body, failed):
    df = spark.createDataFrame([(body,)], "b string")
    assert extraction.parse_responses(df, "b", kind).first().failed == failed


def test_validate_splits_rows(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "x int")
    valid, bad = validate.validate(df, {"positive": F.col("x") > 0})
    assert [r.x for r in valid.collect()] == [1] and [r.failed for r in bad.collect()] == [["positive"], ["positive"]]


def test_fallback(spark):
    rows = [(1, 0, 0, "rate_limited", "a"), (1, 1, 3, "ok", "b"), (1, 1, 2, "ok", "c"), (1, 2, 1, "ok", "d"), (2, 0, 0, "failed", "e"), (2, 2, 1, "too_large", "f")]
    df = spark.createDataFrame(rows, "call int, rank int, attempt int, status string, body string").repartition(3)
    resolution = extraction.fallback_resolution(df, "call", "rank", ["attempt"], "status", "body")
    assert {tuple(r) for r in resolution.collect()} == {(1, 4, 1, "c", False), (2, 2, None, None, True)}
    telemetry = extraction.fallback_telemetry(
        df, resolution.withColumnRenamed("rank", "provider_rank"), "status", 3).first().asDict()
    assert telemetry == {"total_calls": 2, "provider_0_wins": 0, "provider_1_wins": 1, "provider_2_wins": 0, "offline_fallbacks": 1,
                         "rate_limit_count": 1, "payload_too_large_count": 1}


def test_rule_extract(spark):
    df = spark.createDataFrame([(1, "Acme\nx"), (2, "")], "id int, t string")
    assert [r.entity_name for r in extraction.rule_extract(df, "t", "STARTUP").collect()] == ["Acme", "Unknown"]
    assert extraction.rule_extract(df, "t", "PRODUCT").first().pricing_model == "FREE"
    with pytest.raises(ValueError):
        extraction.rule_extract(df, "t", "NEWS")


def test_vendor_edges(spark):
    startups = spark.createDataFrame([("A",), ("A",), ("B",)], "entity_name string")
    products = spark.createDataFrame([("A", "p1"), ("A", "p2"), ("C", "p3")], "startup_name string, source_url string")
    jobs = spark.createDataFrame([("A", "Engineering")] * 50 + [("D", "Engineering")], "company string, role_family string")
    edges = relations.vendor_edges(startups, products, jobs)
    assert {tuple(r) for r in edges.collect()} == {("A", "PRODUCES", "p1", 1), ("A", "PRODUCES", "p2", 1), ("A", "HIRES", "Engineering", 50)}
    assert {tuple(r) for r in relations.vendor_summary(edges).collect()} == {("A", "PRODUCES", 2, 2), ("A", "HIRES", 1, 50)}


def test_totals(spark):
    judged = spark.createDataFrame(
        [("a", None, "h"), ("a", None, "h"), ("a", "STALE_RECORD", None), ("b", None, "g")], "vertical string, reason string, hash_key string")
    rows = {r.vertical: r for r in report.with_totals(report.ingest_metrics(judged), F.lit(0)).collect()}
    assert (rows["a"].discovered, rows["a"].valid, rows["a"].duplicates, rows["a"].rejected) == (3, 1, 1, 1)
    assert (rows["ALL"].discovered, rows["ALL"].valid) == (4, 2) and rows["ALL"].throughput == 20.0
    for r in rows.values():
        assert r.discovered == r.valid + r.duplicates + r.rejected


def test_sorted_tokens(column_values):
    assert column_values(sorted_tokens, [" b  a c", ""]) == ["a b c", ""]


def test_rows_without_an_order_value_are_no_repeats_by_themselves(spark):
    rows = [("a", None), ("b", None), (None, None), ("c", 2), ("c", 1), ("c", None)]
    marked = dedup.mark_repeats(spark.createDataFrame(rows, "k string, n int"), "k", ["n"])
    assert sorted(map(tuple, marked.collect()), key=str) == sorted(
        [("a", None, False), ("b", None, False), (None, None, False), ("c", 2, True), ("c", 1, False), ("c", None, True)], key=str
    )
