"""Inputs of the registered queries, derived from the given tables.

The given tables hold no web payloads, so each query derives the fields it
needs from whole tables: noisy organisation names, date texts, repository
addresses, and landed JSON, RSS and Atom pages.  The derivations are plain SQL
that Spark and a SQL oracle both run; the few spellings that differ are in
``Dialect``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightweir import fixed_values as fixed
from brightweir.operators.lookup import shuffle_partitions
from brightweir.sources.registry import sources_of

# Reference times of the queries.
NEWS_REF = "2024-01-15 12:00:00"
COLLECTED_AT = "2024-01-15 12:30:00"
REF_EPOCH = 1705320000

# What the extraction requests ask for.
TASK = "Extract the organisation."


@dataclass(frozen=True)
class Dialect:
    """Spellings that differ between Spark SQL and DuckDB."""

    spark: bool

    def pick(self, values: list[str], index: str) -> str:
        items = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
        if self.spark:
            return f"element_at(array({items}), cast(({index}) + 1 as int))"
        return f"list_extract([{items}], cast(({index}) + 1 as int))"

    def epoch(self, column: str) -> str:
        return f"unix_timestamp(cast({column} as timestamp))" if self.spark else f"cast(epoch({column}) as bigint)"

    def time_text(self, epoch: str, kind: str) -> str:
        spark, duck = {
            "iso": ("yyyy-MM-dd''T''HH:mm:ss''Z''", "%Y-%m-%dT%H:%M:%SZ"),
            "offset": ("yyyy-MM-dd''T''HH:mm:ss+02:00", "%Y-%m-%dT%H:%M:%S+02:00"),
            "naive": ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
            "mail": ("EEE, dd MMM yyyy HH:mm:ss ''GMT''", "%a, %d %b %Y %H:%M:%S GMT"),
            "long": ("MMMM d, yyyy", "%B %-d, %Y"),
            "weekday": ("EEEE, d MMMM yyyy h:mm a ''EST''", "%A, %-d %B %Y %-I:%M %p EST"),
            "noon": ("yyyy-MM-dd ha", "%Y-%m-%d %-I%p"),
            "dotted": ("MM.dd.yyyy", "%m.%d.%Y"),
            "month_first": ("MMM d yyyy HH:mm", "%b %-d %Y %H:%M"),
            "slashed": ("M/d/yyyy H:mm:ss", "%-m/%-d/%Y %-H:%M:%S"),
            "compact": ("yyyyMMdd''T''HHmmss''Z''", "%Y%m%dT%H%M%SZ"),
            "worded": ("''the'' d ''of'' MMMM yyyy", "the %-d of %B %Y"),
            "ordinal": ("d''th of'' MMMM, yyyy ''at'' HH:mm ''UTC+2''", "%-dth of %B, %Y at %H:%M UTC+2"),
        }[kind]
        if kind == "offset":
            epoch = f"({epoch}) + 7200"
        if self.spark:
            return f"date_format(timestamp_seconds({epoch}), '{spark}')"
        return f"strftime(make_timestamp(cast(({epoch}) as bigint) * 1000000), '{duck}')"

    def twice(self, items: str, share: int) -> str:
        """Every item, one of ``share`` twice, numbered by ``seq``.  Spark makes both rows in one pass over the items."""
        if self.spark:
            return f"select *, explode(if(k % {share} = 0, array(k * 2, k * 2 + 1), array(k * 2))) as seq from {items}"
        return f"select *, k * 2 as seq from {items} union all select *, k * 2 + 1 as seq from {items} where k % {share} = 0"


SPARK, DUCK = Dialect(True), Dialect(False)


def _all_aliases() -> list[str]:
    keys: dict[str, None] = {}
    for canonical, aliases in fixed.ALIASES.items():
        for alias in [canonical, *aliases]:
            keys.setdefault(alias.lower(), None)
    return list(keys)


def noisy_name(d: Dialect, key: str, other: str) -> str:
    """An organisation name as sources spell it: an alias with decorations, another name, or blank."""
    alias = d.pick(_all_aliases(), f"{key} % 131")
    return f"""case {key} % 7
        when 0 then {alias}
        when 1 then {alias} || ', Inc.'
        when 2 then {alias} || ' LLC'
        when 3 then upper({alias})
        when 4 then {alias} || right({alias}, 1)
        when 5 then {other}
        else case when {key} % 2 = 0 then '  ' else 'Café ' || {alias} end
    end"""


def _texts_by_kind(d: Dialect, kind: str, epoch: str, hours: str, junk: str) -> str:
    return f"""case {kind}
        when 0 then {d.time_text(epoch, "iso")}
        when 1 then {d.time_text(epoch, "offset")}
        when 2 then {d.time_text(epoch, "mail")}
        when 3 then {d.time_text(epoch, "long")}
        when 4 then ({hours}) || ' hours ago'
        else {junk}
    end"""


def organisations(d: Dialect) -> str:
    return f"""select c_custkey as id, {noisy_name(d, "c_custkey", "c_name")} as raw_name,
        'https://orgs.example.com/' || c_custkey as source_url from {{customer}}"""


def addresses(d: Dialect) -> str:
    return """select page_id, case page_id % 6
        when 0 then url
        when 1 then upper(substring(url, 1, 12)) || substring(url, 13)
        when 2 then replace(replace(replace(url, '.com/', '.com:443/'), '.org/', '.org:80/'), '.net/', '.net:8080/')
        when 3 then url || case when url like '%?%' then '&' else '?' end || 'b=2&a=x%20y&UTM_Medium=z&c=&a=%C3%A9'
        when 4 then '  ' || url || ' '
        else url || '/' end as url from {pages}"""


def date_texts(d: Dialect) -> str:
    text = _texts_by_kind(d, "k % 6", "e", "k % 72", "case when k % 12 = 5 then '' else 'soon' end")
    return f"""select k, e, {text} as date_text from (
        select o_orderkey as k, {d.epoch("o_orderdate")} + o_orderkey % 86400 as e from {{orders}}) t"""


# How the general date texts are written, and what they keep of the second they stand for.
GENERAL_KINDS = ["weekday", "noon", "dotted", "month_first", "slashed", "compact", "worded", "ordinal"]


def general_date_texts(d: Dialect) -> str:
    texts = " ".join(f"when {i} then {d.time_text('e', kind)}" for i, kind in enumerate(GENERAL_KINDS))
    return f"""select k, e, case k % 10 {texts} when 8 then 'Sep 2026' else '31.02.2026 10:00' end as date_text from (
        select o_orderkey as k, {d.epoch("o_orderdate")} + o_orderkey % 86400 as e from {{orders}}) t"""


def date_candidates(d: Dialect) -> str:
    return f"""select k, e,
        case k % 4 when 0 then {d.time_text("e", "iso")} when 1 then 'junk' end as feed,
        case k % 5 when 0 then {d.time_text("e + 60", "offset")} when 1 then '' end as json_ld,
        case k % 6 when 0 then {d.time_text("e + 120", "mail")} end as open_graph,
        case k % 7 when 0 then (k % 30) || ' mins ago' when 1 then {d.time_text("e + 180", "naive")} end as time_tag,
        case k % 3 when 0 then {d.time_text("e", "long")} when 1 then '3 days ago' end as raw,
        case k % 2 when 0 then 'yesterday' end as relative
        from (select o_orderkey as k, {d.epoch("o_orderdate")} + o_orderkey % 86400 as e from {{orders}}) t"""


def startup_items(d: Dialect) -> str:
    return f"""with base as (
        select s_suppkey as k, {noisy_name(d, "s_suppkey", "s_name")} as login,
            case when s_suppkey % 11 = 3 then '' else 'https://github.com/' || lower(replace(s_name, '#', '-')) end as url
        from {{supplier}})
        select k, login, url, k * 2 as seq from base
        union all select k, login, url, k * 2 + 1 as seq from base where k % 4 = 0"""


def product_items(d: Dialect) -> str:
    return f"""with base as (
        select p_partkey as k, case when p_partkey % 9 = 4 then p_name
            else {noisy_name(d, "p_partkey", "p_brand")} || '/' || p_name end as full_id from {{part}}),
        ids as (select k, case when k % 13 = 5 or k % 17 = 3 then '' else full_id end as id,
            case when k % 13 = 5 and k % 17 <> 3 then full_id end as alt_id from base)
        select k, id, alt_id, k * 2 as seq from ids
        union all select k, id, alt_id, k * 2 + 1 as seq from ids where k % 5 = 0"""


def paper_items(d: Dialect) -> str:
    epoch = "1704067200 + doc_id * 3600"
    return f"""select doc_id as k, doc_id % 19 = 7 as no_paper,
        case when doc_id % 10 = 9 then '' else '2401.' || doc_id end as id,
        case when doc_id % 8 = 1 then '' else 'Study ' || md5(text) end as title,
        case when doc_id % 16 = 1 then null else 'Daily ' || (doc_id % 40) end as outer_title,
        doc_id % 10 = 7 as no_authors, lang, source,
        case doc_id % 6 when 0 then {d.time_text(epoch, "iso")} when 1 then {d.time_text(epoch, "offset")}
            when 2 then '' when 3 then 'in press' when 4 then {d.time_text(epoch, "mail")} end as published,
        case when doc_id % 12 = 2 then {d.time_text(epoch + " + 60", "iso")} end as outer_published,
        case doc_id % 3 when 0 then lang || '/' || source
            when 1 then 'https://github.com/' || upper(lang) || '/' || source || '.git' end as repo,
        case when doc_id % 5 = 0 then cast(doc_id as int) end as own_stars
        from {{documents}}"""


def repo_stats(d: Dialect) -> str:
    return """select lang || '/' || source as repo_key, count(*) * 10 as stars
        from {documents} group by lang, source having count(*) % 4 <> 0"""


def repo_addresses(d: Dialect) -> str:
    return """select doc_id as k, case when doc_id % 7 = 6 then 'https://example.com/' || source
        when doc_id % 5 = 4 then lang || '/' || source
        else 'https://GitHub.com/' || upper(lang) || '/' || source
            || case doc_id % 3 when 0 then '.git' when 1 then '/tree/main#readme' else '?tab=x' end end as repo,
        case when doc_id % 5 = 0 then doc_id end as own_stars from {documents}"""


def news_items(d: Dialect) -> str:
    text = _texts_by_kind(d, "k % 6", "e", "k % 20", "case when k % 12 = 5 then '' else 'not a date' end")
    return f"""with base as (
        select page_id as k, {d.pick(fixed.NEWS_SOURCES, "floor(page_id / 20) % 5")} as source,
            cast(floor(page_id / 20) as bigint) as page, regexp_extract(html, '<title>([^<]*)</title>', 1) as title,
            url, html, {REF_EPOCH} - (page_id * 37 % 2400) * 60 + 600 as e from {{pages}}),
        dated as (select k, source, page, title, url, html, e, {text} as published from base)
        {d.twice("dated", 5)}"""


def job_items(d: Dialect) -> str:
    e = f"{REF_EPOCH} - (o_orderkey * 613) % 180000 + 1200"
    company = noisy_name(d, "o_custkey", "c_name")
    boards, recorded = [source.name for source in sources_of("jobs")], [source.recorded for source in sources_of("jobs")]
    return f"""with base as (
        select o_orderkey as k, o_orderkey % 5 as board, {d.pick(boards, "o_orderkey % 5")} as source,
            {d.pick(recorded, "o_orderkey % 5")} as recorded,
            cast(floor(o_orderkey / 250) as bigint) as page, {e} as e, {company} as company,
            case when o_orderkey % 15 = 0 then '' else 'https://jobs.example.com/' || o_orderkey end as url,
            o_orderpriority as priority, lower(c_mktsegment) as segment
        from {{orders}} join {{customer}} on o_custkey = c_custkey),
        items as (select *, case board
                when 0 then {d.time_text("e", "iso")}
                when 1 then {d.time_text("e", "naive")}
                when 2 then replace({d.time_text("e", "naive")}, ' ', 'T')
                when 3 then {d.time_text("e", "mail")}
                else case when k % 10 = 4 then cast(e as string) when k % 30 = 9 then '' else {d.time_text("e", "iso")} end
            end as published,
            case when k % 20 = 3 then company || ' hires ' || priority else company || ': ' || priority end as feed_title,
            case when k % 3 = 0 then 'Maintenance lead' else 'Clerk' end as title,
            case priority when '1-URGENT' then 'Machine Learning' when '2-HIGH' then 'Big Data' else 'ops' end as tag,
            case when k % 15 < 5 then null when k % 15 < 10 then true else false end as remote
            from base)
        {d.twice("items", 6)}"""


def attempts(d: Dialect) -> str:
    return """select user_id as call_id, cast(event_id % 3 as int) as provider_rank, event_id as attempt,
        case when event_type in ('purchase', 'signup') then 'ok' when event_type = 'error' then 'rate_limited'
            when event_type = 'view' then 'too_large' else 'failed' end as status, props as body from {events}"""


def marked_pages(d: Dialect) -> str:
    """Pages with metadata of four kinds wrapped into the head and the article."""
    e = f"{REF_EPOCH} - page_id * 600"
    return f"""select page_id, url, replace(html, '<head>', '<head><meta name="description" content=" About page '
            || page_id || ' ">' || case page_id % 4
        when 0 then '<meta property="og:title" content="Story ' || page_id || '"><meta property="og:published_time" content="'
            || {d.time_text(e, "iso")} || '">'
        when 1 then '<script type="application/ld+json">{{{{"@type": "Article", "datePublished": "'
            || {d.time_text(e, "offset")} || '"}}}}</script>'
        when 2 then '<meta name="ARTICLE:published_time" content="not a date"><time datetime="'
            || {d.time_text(e, "mail")} || '">then</time>'
        else '<script type="application/ld+json">broken</script><time> 3 hours ago </time>' end) as html,
        {e} as e from {{pages}}"""


# Tables each derivation reads.
_INPUTS = {
    organisations: ["customer"], addresses: ["pages"], date_texts: ["orders"], general_date_texts: ["orders"], date_candidates: ["orders"],
    startup_items: ["supplier"], product_items: ["part"], paper_items: ["documents"], repo_stats: ["documents"],
    repo_addresses: ["documents"], news_items: ["pages"], job_items: ["orders", "customer"], attempts: ["events"],
    marked_pages: ["pages"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, derivation) -> DataFrame:
    """A derivation as a DataFrame."""
    inputs = {name: table(spark, sf_dir, name) for name in _INPUTS[derivation]}
    return spark.sql(derivation(SPARK), **inputs)


def duck(derivation) -> str:
    """A derivation as SQL over views of the given tables."""
    sql = derivation(DUCK).replace("{{", "{").replace("}}", "}")
    for name in _INPUTS[derivation]:
        sql = sql.replace("{" + name + "}", name)
    return sql


def _listed(item: Column) -> Column:
    """The texts of a page in order.  A page holds a fixed range of keys, which bounds the group."""
    # sort_array compares natively; array_sort runs an expression per comparison.  No element is null.
    return F.sort_array(F.collect_list(F.struct("seq", item.alias("text"))))["text"]


def _pages(items: DataFrame, item: Column, before: str, after: str, gap: str = ",") -> DataFrame:
    texts = F.array_join(_listed(item), gap)
    return items.groupBy("source", "page").agg(F.concat(F.lit(before), texts, F.lit(after)).alias("payload"))


def _paged(df: DataFrame, source: str, per_page: int) -> DataFrame:
    return df.withColumns({"source": F.lit(source), "page": F.floor(F.col("seq") / per_page)})


def landed_startups(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _paged(derived(spark, sf_dir, startup_items), fixed.STARTUP_SOURCE, 100)
    return _pages(items, F.to_json(F.struct("login", F.col("url").alias("html_url"), "k")), '{"items":[', "]}")


def landed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _paged(derived(spark, sf_dir, product_items), fixed.PRODUCT_SOURCE, 100)
    return _pages(items, F.to_json(F.struct("id", F.col("alt_id").alias("_id"))), "[", "]")


def landed_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived(spark, sf_dir, paper_items).withColumn("seq", F.col("k"))
    authors = F.array(
        F.struct(F.col("lang").alias("name")),
        F.struct(F.lit("").alias("name")),
        F.struct(F.concat(F.lit("  "), F.col("source"), F.lit(" ")).alias("name")),
    )
    paper = F.when(F.col("no_paper"), F.lit(None)).otherwise(
        F.struct(
            "id", "title", F.when(~F.col("no_authors"), authors).alias("authors"),
            F.col("published").alias("publishedAt"), F.col("repo").alias("githubRepo"),
            F.col("own_stars").alias("githubStars"),
        )
    )
    item = F.to_json(
        F.struct(paper.alias("paper"), F.col("outer_title").alias("title"),
                 F.col("outer_published").alias("publishedAt"))
    )
    paged = _paged(items.withColumn("item", item).select("seq", "item"), sources_of("research_papers")[0].name, 100)
    return _pages(paged, F.col("item"), "[", "]")


def _xml(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _element(name: str, c: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), _xml(c), F.lit(f"</{name}>"))


ATOM_SOURCES = [source.name for source in sources_of("news") if source.layout == "atom"]
RSS_SOURCES = [source.name for source in sources_of("news") if source.layout == "rss"]


def landed_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived(spark, sf_dir, news_items)
    rss_item = F.concat(
        F.lit("<item>"), _element("title", F.col("title")), _element("link", F.col("url")),
        _element("pubDate", F.col("published")), _element("description", F.col("html")), F.lit("</item>"),
    )
    even = F.col("k") % 2 == 0
    atom_item = F.concat(
        F.lit("<entry>"), _element("title", F.col("title")),
        F.lit('<link rel="alternate" href="'), _xml(F.col("url")), F.lit('"/>'),
        F.when(even, _element("published", F.col("published"))).otherwise(_element("updated", F.col("published"))),
        F.lit('<content type="html">'), _xml(F.col("html")), F.lit("</content></entry>"),
    )
    rss = _pages(items.where(F.col("source").isin(RSS_SOURCES)), rss_item, "<rss><channel><title>feed</title>",
                 "</channel></rss>", "")
    atom = _pages(items.where(F.col("source").isin(ATOM_SOURCES)), atom_item,
                  '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>", "")
    return rss.unionByName(atom)


def landed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = derived(spark, sf_dir, job_items)

    def text(**fields: str) -> Column:
        return F.to_json(F.struct(*[F.col(c).alias(name) for name, c in fields.items()]))

    def number_plain(json: Column) -> Column:
        return F.regexp_replace(json, '"created_at":"([0-9]+)"', '"created_at":$1')

    tagged = items.withColumn("tags", F.array("segment", "tag"))
    item = (
        F.when(F.col("board") == 0, text(id="k", date="published", company="company", url="url"))
        .when(F.col("board") == 1, text(pubDate="published", companyName="company", url="url"))
        .when(F.col("board") == 2, text(publication_date="published", company_name="company", url="url"))
        .when(
            F.col("board") == 3,
            F.concat(F.lit("<item>"), _element("title", F.col("feed_title")), _element("link", F.col("url")),
                     _element("pubDate", F.col("published")), F.lit("</item>")),
        )
        .otherwise(number_plain(text(created_at="published", company_name="company", url="url", tags="tags",
                                     title="title", remote="remote")))
    )
    # One grouping for all boards; the envelope differs.  Few bytes but much work for whoever reads
    # the pages: dealt before the items are made, so that pages are not merged by size into few tasks.
    tagged = tagged.repartition(shuffle_partitions(tagged), "source", "page")
    pages = tagged.groupBy("source", "page").agg(_listed(item).alias("texts"))
    commas = F.array_join("texts", ",")
    names = {source.layout: source.name for source in sources_of("jobs")}
    source = F.col("source")
    payload = (
        F.when(source == names["board_a"], F.concat(F.lit('[{"legal":"terms apply"},'), commas, F.lit("]")))
        .when(source == names["board_d"], F.concat(F.lit("<rss><channel>"), F.array_join("texts", ""), F.lit("</channel></rss>")))
        .when(source == names["board_e"], F.concat(F.lit('{"data":['), commas, F.lit("]}")))
        .otherwise(F.concat(F.lit('{"jobs":['), commas, F.lit("]}")))
    )
    return pages.select("source", "page", payload.alias("payload"))
