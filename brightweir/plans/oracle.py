"""Reference SQL of the registered queries, for a DuckDB check on the same tables."""

from __future__ import annotations

from brightweir import fixed_values as fixed
from brightweir.operators.extraction import request_head
from brightweir.plans import workload as w

REF = f"timestamp '{w.NEWS_REF}'"
COLLECTED = "2024-01-15T12:30:00Z"


def _values(rows: list[tuple]) -> str:
    def literal(v) -> str:
        if v is None:
            return "null"
        if isinstance(v, bool):
            return str(v).lower()
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)


def iso(epoch: str) -> str:
    return f"strftime(make_timestamp(cast({epoch} as bigint) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


def sha(text: str) -> str:
    return f"sha256({text})"


def key(scope: str, name: str, url: str) -> str:
    return sha(f"'{scope}:' || lower(trim({name} || ':' || {url}))")


# --- URLs -------------------------------------------------------------------

def canonical_cte(source: str, url: str) -> str:
    """CTEs ending in ``canon(<source columns>, canonical)``."""
    tracking = ", ".join(f"'{t}'" for t in fixed.TRACKING_PARAMETERS)
    encode = "replace(url_encode({0}), '%20', '+')"
    decode = "url_decode(replace({0}, '+', ' '))"
    pair = (
        "{'k': " + decode.format("split_part(x, '=', 1)")
        + ", 'v': case when contains(x, '=') then " + decode.format("substr(x, instr(x, '=') + 1)") + " else '' end}"
    )
    return f"""src as (select * from {source}),
    cut as (select *, regexp_replace(trim({url}), '#.*$', '') as u from src),
    parts as (select *, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) as scheme,
        lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1)) as host,
        regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') as rest from cut),
    more as (select *, split_part(rest, '?', 1) as path,
        case when contains(rest, '?') then substr(rest, instr(rest, '?') + 1) else '' end as query from parts),
    params as (select *, list_sort(list_filter(list_transform(string_split(query, '&'), lambda x: {pair}),
        lambda p: p.v <> '' and lower(p.k) not in ({tracking}))) as ps from more),
    built as (select *, array_to_string(list_transform(ps, lambda p: {encode.format('p.k')} || '=' || {encode.format('p.v')}), '&') as q
        from params),
    canon as (select * exclude (u, scheme, host, rest, path, query, ps, q), scheme || '://'
        || case when scheme = 'http' and host like '%:80' then left(host, length(host) - 3)
            when scheme = 'https' and host like '%:443' then left(host, length(host) - 4) else host end
        || case when length(path) > 1 and right(path, 1) = '/' then left(path, length(path) - 1) else path end
        || case when coalesce(q, '') = '' then '' else '?' || q end as canonical from built)"""


def _addresses() -> str:
    return "with " + canonical_cte(f"({w.duck(w.addresses)})", "url")


# --- Names ------------------------------------------------------------------

def normal(name: str) -> str:
    words = "|".join(fixed.LEGAL_SUFFIXES)
    bare = f"regexp_replace(lower(strip_accents(trim({name}))), '\\b(?:{words})\\b', '', 'g')"
    return f"trim(regexp_replace(regexp_replace({bare}, '[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def title(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({text}, ' '), "
        "lambda x: upper(substr(x, 1, 1)) || lower(substr(x, 2))), ' ')"
    )


def tokens(text: str) -> str:
    return f"array_to_string(list_sort(string_split({text}, ' ')), ' ')"


def common(a: str, b: str) -> str:
    """Longest common subsequence by updating one row of the table per letter of ``a``."""
    return f"""list_reduce(string_split({a}, ''), lambda r, ch: list_prepend(0, list_transform(range(1, length({b}) + 1),
        lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(r[i + 1],
        case when substr({b}, i, 1) = ch then r[i] + 1 else 0 end))))),
        list_transform(range(0, length({b}) + 1), lambda z: 0::bigint))[length({b}) + 1]"""


def resolve_cte(source: str, name: str, folded: bool = True) -> str:
    """CTEs ending in ``resolved(raw, normal, canonical_name, method, confidence, best_name, best_score)``."""
    table = fixed.ALIASES
    keys = {}
    for canonical, aliases in table.items():
        for alias in [canonical, *aliases]:
            keys[alias.lower()] = canonical
    display = "lower(canonical_name)" if folded else "canonical_name"
    return f"""aliases(alias_key, alias_name) as (values {_values(list(keys.items()))}),
    canonicals(canonical_name, ord) as (values {_values([(n, i) for i, n in enumerate(table)])}),
    raws as (select distinct trim({name}) as raw from {source} where trim({name}) <> ''),
    norms as (select raw, {normal("raw")} as normal from raws),
    exact as (select raw, normal, alias_name from norms left join aliases on normal = alias_key),
    open_names as (select distinct normal, {tokens("normal")} as t from exact where alias_name is null and normal <> ''),
    shapes as (select canonical_name, ord, {tokens(display)} as c from canonicals),
    scores as (select normal, canonical_name, ord, 200.0::double * {common("t", "c")} / (length(t) + length(c)) as score
        from open_names cross join shapes),
    best as (select normal, canonical_name as best_name, score as best_score from (select *,
        row_number() over (partition by normal order by score desc, ord) as rn from scores) s
        where rn = 1 and score >= {fixed.FUZZY_REVIEW}),
    resolved as (select raw, exact.normal, case when alias_name is not null then alias_name
            when best_score >= {fixed.FUZZY_ACCEPT} then best_name else {title("exact.normal")} end as canonical_name,
        case when alias_name is not null then '{fixed.METHOD_EXACT}'
            when best_score >= {fixed.FUZZY_ACCEPT} then '{fixed.METHOD_FUZZY}'
            else '{fixed.METHOD_TITLECASE}' end as method,
        case when alias_name is not null then 100.0::double
            when best_score >= {fixed.FUZZY_ACCEPT} then round_even(best_score, 1)::double
            else 60.0::double end as confidence, best_name, best_score
        from exact left join best on alias_name is null and exact.normal = best.normal)"""


def record_cte(source: str, name: str) -> str:
    """CTEs ending in ``named``: the records with canonical name, method and confidence."""
    return f"""{resolve_cte(source, name)},
    named as (select s.*, coalesce(r.canonical_name, '{fixed.UNKNOWN_NAME}') as canonical_name,
        coalesce(r.method, '{fixed.METHOD_EMPTY}') as method, coalesce(r.confidence, 0.0) as confidence
        from {source} s left join resolved r on trim(s.{name}) = r.raw)"""


# --- Pages ------------------------------------------------------------------

def page_text(html: str, limit: int) -> str:
    text = html
    for element in ("script", "style", "nav", "footer"):
        text = f"regexp_replace({text}, '<{element}\\b[^>]*>.*?</{element}>', ' ', 'gs')"
    text = f"regexp_replace(regexp_replace({text}, '<!--.*?-->', ' ', 'gs'), '<[^>]*>', ' ', 'g')"
    for entity, char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        text = f"replace({text}, '&{entity};', '{char}')"
    text = f"regexp_replace({text}, '&amp\\b', '&', 'g')"
    return f"substr(trim(regexp_replace({text}, '\\s+', ' ', 'g')), 1, {limit})"


def chunks_cte(limit: int, strict: bool = False) -> str:
    """CTE ``chunks(doc_id, lang, source, chunk_no, chunk)``: a fold over the pieces of each document."""
    gap = "chr(10) || chr(10)"
    split = "string_split(s, ' ')"
    if strict:
        split = f"""flatten(list_transform({split}, lambda x: case when length(x) <= {limit} then [x]
            else list_transform(range(0, (length(x) + {limit} - 1) // {limit}), lambda n: substr(x, n * {limit} + 1, {limit})) end))"""
    words = f"list_transform({split}, lambda x, i: {{'s': x, 'g': 1, 'b': i = 1}})"
    close = "array_to_string(st.cur, ' ')"
    last = close if strict else "array_to_string(st.cur, '\n\n')"
    marked = "regexp_replace(p, '([.?!])\\s+', '\\1' || chr(1), 'g')"
    sentences = f"""flatten(list_transform(string_split({marked}, chr(1)), lambda s: case when length(s) <= {limit}
        then [{{'s': s, 'g': 1, 'b': false}}] else {words} end))"""
    pieces = f"""flatten(list_transform(list_filter(list_transform(string_split(t, {gap}), lambda x: trim(x, ' ' || chr(10))),
        lambda x: x <> ''), lambda p: case when length(p) <= {limit} then [{{'s': p, 'g': 2, 'b': false}}] else {sentences} end))"""
    return f"""docs as (select doc_id, lang, source, replace(text, chr(10), {gap}) as t from documents),
    cut as (select *, {pieces} as pieces from docs where length(t) > {limit}),
    folded as (select *, list_reduce(pieces, lambda st, x: case
        when len(st.cur) > 0 and (x.b or st.size + length(x.s) + x.g > {limit})
        then {{'done': list_append(st.done, case when x.g = 2 then {last} else {close} end), 'cur': [x.s],
            'size': (length(x.s) + x.g)::bigint}}
        else {{'done': st.done, 'cur': list_append(st.cur, x.s), 'size': (st.size + length(x.s) + x.g)::bigint}} end,
        {{'done': []::varchar[], 'cur': []::varchar[], 'size': 0::bigint}}) as st from cut),
    listed as (select doc_id, lang, source, list_append(st.done, {last}) as cs from folded
        union all select doc_id, lang, source, [t] as cs from docs where length(t) <= {limit} and t <> ''),
    chunks as (select doc_id, lang, source, unnest(range(0, len(cs)))::integer as chunk_no, unnest(cs) as chunk from listed)"""


# --- Vertical CTEs ------------------------------------------------------------

def startups_cte() -> str:
    """CTEs ending in ``startup_rows`` (accepted, keyed) over ``startup_items``."""
    return f"""startup_items as ({w.duck(w.startup_items)}),
    startup_ok as (select * from startup_items where trim(login) <> '' and trim(url) <> ''),
    {_prefixed(record_cte("startup_ok", "login"), "st")},
    startup_rows as (select *, {key("startup", "canonical_name", "url")} as hash_key from st_named)"""


def products_cte() -> str:
    return f"""product_items as ({w.duck(w.product_items)}),
    product_ok as (select *, case when contains(mid, '/') then substr(mid, 1, instr(mid, '/') - 1)
        else '{fixed.INDEPENDENT_OWNER}' end as owner, '{fixed.MODEL_SITE_PREFIX}' || mid as url
        from (select *, coalesce(nullif(id, ''), nullif(alt_id, '')) as mid from product_items) p where mid is not null),
    {_prefixed(record_cte("product_ok", "owner"), "pr")},
    product_rows as (select *, {key("product", "canonical_name", "url")} as hash_key from pr_named)"""


def papers_cte() -> str:
    epoch = "1704067200 + k * 3600"
    raw = "coalesce(nullif(published, ''), nullif(outer_published, ''), '')"
    return f"""paper_items as ({w.duck(w.paper_items)}),
    stars as ({w.duck(w.repo_stats)}),
    paper_ok as (select *, coalesce(nullif(title, ''), nullif(outer_title, ''), '{fixed.UNTITLED_PAPER}') as full_title,
        case when id = '' then '' else '{fixed.ABSTRACT_PREFIX}' || id end as paper_url,
        case when repo like 'http%' then repo when repo is not null then '{fixed.REPO_HOST_PREFIX}' || repo end as github_url,
        case when k % 6 in (0, 1, 4) then {iso(epoch)} when {raw} = outer_published then {iso(epoch + " + 60")}
            else {raw} end as published_date
        from paper_items where not no_paper),
    paper_rows as (select p.k, full_title as title, case when no_authors then '[]' else '["' || lang || '","' || source || '"]' end as authors,
        paper_url, github_url, coalesce(p.own_stars, case when github_url is not null then s.stars end)::bigint as github_stars, published_date,
        {key("paper", "full_title", "paper_url")} as hash_key
        from paper_ok p left join stars s on s.repo_key = lang || '/' || source)"""


def news_cte() -> str:
    """CTEs ending in ``news_judged``: every item with its reason and output columns."""
    return f"""news_items as ({w.duck(w.news_items)}),
    news_dated as (select *, case k % 6 when 3 then cast(floor(e / 86400.0) as bigint) * 86400
        when 4 then null when 5 then null else e end as t from news_items),
    news_judged as (select *, case when trim(title) = '' then 'MISSING_TITLE' when trim(published) = '' then 'MISSING_DATE'
        when t is null then '{fixed.REASON_UNPARSEABLE}' when t < {w.REF_EPOCH} - 86400 then '{fixed.REASON_STALE}'
        when t > {w.REF_EPOCH} + 900 then '{fixed.REASON_FUTURE}' end as reason,
        {key("news", "trim(title)", "url")} as hash_key from news_dated)"""


def jobs_cte() -> str:
    """CTEs ending in ``job_judged``."""
    return f"""job_items as ({w.duck(w.job_items).replace("cast(e as string)", "cast(e as varchar)")}),
    job_raw as (select *, case when board <> 3 then trim(company) when contains(feed_title, ':')
            then trim(split_part(feed_title, ':', 1)) else trim(substr(trim(feed_title), 1, 30)) end as name,
        case when board = 0 and url = '' then '{fixed.BOARD_A_PREFIX}' || k else url end as link,
        case when published = '' then null else e end as t,
        board = 4 and not (tag in ('Machine Learning', 'Big Data') or segment like '%ai%' or segment like '%data%'
            or lower(title) like '%ai%') as off_topic from job_items),
    job_judged0 as (select *, case when off_topic then 'NOT_TOPICAL' when name = '' and board <> 3 then 'MISSING_COMPANY'
        when published = '' then 'MISSING_DATE' when t < {w.REF_EPOCH} - 86400 then '{fixed.REASON_STALE}'
        when t > {w.REF_EPOCH} + 900 then '{fixed.REASON_FUTURE}' end as reason from job_raw),
    job_ok as (select * from job_judged0 where reason is null),
    {_prefixed(record_cte("job_ok", "name"), "jb")},
    job_rows as (select *, {key("job", "canonical_name", "link")} as hash_key from jb_named)"""


def _prefixed(ctes: str, prefix: str) -> str:
    # Gives the CTEs of a name resolution names of their own.
    import re

    names = ["aliases", "canonicals", "raws", "norms", "exact", "open_names", "shapes", "scores", "best", "resolved", "named"]
    for name in names:
        ctes = re.sub(rf"\b{name}\b(?!\s*(?:=|,\s*best_score))", f"{prefix}_{name}", ctes)
    return ctes


def first(rows: str, order: str, columns: str) -> str:
    return f"""select {columns} from (select *, row_number() over (partition by hash_key order by {order}) as rn
        from {rows}) x where rn = 1"""


STARTUP_COLUMNS = f"""hash_key, '1.0' as schema_version, 'STARTUP' as record_type, '{fixed.STARTUP_SOURCE}' as source_name,
    trim(url) as source_url, canonical_name as entity_name, null::integer as employee_count, '{COLLECTED}' as collected_at"""
PRODUCT_COLUMNS = f"""hash_key, '1.0' as schema_version, 'PRODUCT' as record_type, '{fixed.PRODUCT_SOURCE}' as source_name,
    url as source_url, canonical_name as startup_name, 'FREE' as pricing_model, '{COLLECTED}' as collected_at"""
PAPER_COLUMNS = f"""hash_key, '1.0' as schema_version, 'RESEARCH_PAPER' as record_type, title, authors, paper_url, github_url,
    github_stars, published_date, '{COLLECTED}' as collected_at"""
JOB_COLUMNS = f"""hash_key, '1.0' as schema_version, 'JOB' as record_type, recorded as source_name, link as source_url,
    canonical_name as company, {iso("t")} as published_date,
    case when board = 4 then coalesce(remote, true) else true end as is_remote, 'Engineering' as role_family,
    '{COLLECTED}' as collected_at"""


def news_columns() -> str:
    return f"""hash_key, '1.0' as schema_version, 'NEWS' as record_type, source as source_name, url as source_url,
    trim(title) as title, {iso("t")} as published_date, {page_text("html", 400)} as summary, '{COLLECTED}' as collected_at"""


def _judged(vertical: str) -> str:
    """CTE ``judged`` (vertical, reason, hash_key) of one vertical."""
    return {
        "startups": f"""{startups_cte()}, judged as (select 'startups' as vertical, null::varchar as reason, hash_key from startup_rows
            union all select 'startups', case when trim(login) = '' then 'MISSING_LOGIN' else 'MISSING_URL' end, null
            from startup_items where trim(login) = '' or trim(url) = '')""",
        "products": f"""{products_cte()}, judged as (select 'products' as vertical, null::varchar as reason, hash_key from product_rows
            union all select 'products', 'MISSING_ID', null from product_items
            where coalesce(nullif(id, ''), nullif(alt_id, '')) is null)""",
        "research_papers": f"""{papers_cte()}, judged as (select 'research_papers' as vertical, null::varchar as reason, hash_key
            from paper_rows union all select 'research_papers', 'EMPTY_RECORD', null from paper_items where no_paper)""",
        "news": f"""{news_cte()}, judged as (select 'news' as vertical, reason, hash_key from news_judged)""",
        "jobs": f"""{jobs_cte()}, judged as (select 'jobs' as vertical, null::varchar as reason, hash_key from job_rows
            union all select 'jobs', reason, null from job_judged0 where reason is not null)""",
    }[vertical]


VERTICALS = ["startups", "products", "research_papers", "news", "jobs"]


def _all_judged() -> str:
    # One subquery per vertical, so that their CTE names cannot meet.
    return " union all ".join(f"select * from (with {_judged(v)} select * from judged) {v}_j" for v in VERTICALS)


def _metrics() -> str:
    return f"""select vertical, count(*) as discovered, count(distinct case when reason is null then hash_key end) as valid,
        count(*) - count(distinct case when reason is null then hash_key end)
            - sum(case when reason is null then 0 else 1 end)::bigint as duplicates,
        sum(case when reason is null then 0 else 1 end)::bigint as rejected
        from ({_all_judged()}) j group by vertical"""


def statements() -> dict[str, str]:
    """SQL per query name."""
    sql: dict[str, str] = {}
    addresses, orgs = w.duck(w.addresses), w.duck(w.organisations)

    # URL jobs
    sql["url_canonicalize"] = f"{_addresses()} select page_id, url, canonical from canon"
    sql["url_hash"] = f"{_addresses()} select page_id, {sha('canonical')} as url_hash from canon"
    sql["url_dedup_first_seen"] = f"""{_addresses()} select page_id, url_hash, row_number() over
        (partition by url_hash order by page_id) > 1 as is_repeat
        from (select page_id, sha256(split_part(canonical, '?', 1)) as url_hash from canon) c"""
    sql["url_frontier_antijoin"] = f"""{_addresses()}, hashed as (select page_id, url, canonical, {sha('canonical')} as url_hash from canon),
        ledger as (select url_hash from hashed h join documents d on d.doc_id = h.page_id where d.lang <> 'en')
        select page_id, url, url_hash from hashed where url_hash not in (select url_hash from ledger)"""
    sql["processed_url_ledger"] = f"""{_addresses()} select url_hash, url, source_name, processed_at from (select {sha('canonical')} as url_hash, url,
        'crawl' as source_name, '{COLLECTED}' as processed_at, row_number() over (partition by canonical order by page_id) as rn
        from canon) c where rn = 1"""
    sql["composite_fingerprint"] = f"""{_addresses()} select page_id, sha256(canonical || {iso(f"{w.REF_EPOCH} - page_id * 600")}) as fingerprint from canon"""
    sql["repo_key_extract"] = f"""with r as ({w.duck(w.repo_addresses)}) select k, case when lower(repo) like '%github.com/%' then
        lower(regexp_replace(regexp_extract(repo, '(?i)github\\.com/([^/]+/[^/#?]+)', 1), '\\.git$', '')) end as repo_key from r"""

    # Keys and dedup
    doc_key = "sha256('document:' || lower(trim(text, ' ' || chr(9) || chr(10) || chr(13))))"
    sql["entity_hash_key"] = f"""with o as ({orgs}) select id, sha256('organisation:' || lower(trim(raw_name))) as hash_key from o"""
    sql["scoped_dedup"] = f"""select doc_id, hash_key, row_number() over (partition by hash_key order by doc_id) > 1 as is_repeat
        from (select doc_id, sha256(lang || ':' || lower(trim(text, ' ' || chr(9) || chr(10) || chr(13)))) as hash_key from documents) d"""
    first_docs = f"""select doc_id, source, {doc_key} as hash_key from documents"""
    sql["dedup_accounting"] = f"""with d as ({first_docs}), f as (select *, row_number() over (partition by hash_key order by doc_id) as rn from d)
        select source, count(*) as n_read, sum((rn = 1)::int)::bigint as n_inserted, sum((rn > 1)::int)::bigint as n_duplicates from f group by source"""
    sql["idempotent_upsert"] = f"""with d as ({first_docs}), f as (select *, row_number() over (partition by hash_key order by doc_id) as rn from d)
        select doc_id, source, hash_key from f where rn = 1"""

    # Dates
    texts = w.duck(w.date_texts)
    sql["date_parse_absolute"] = f"""with t as ({texts}) select k, date_text, case k % 6 when 3 then
        strftime(date_trunc('day', make_timestamp(e * 1000000)), '%Y-%m-%dT%H:%M:%SZ') when 4 then null when 5 then null
        else {iso("e")} end as parsed from t"""
    day, minute = "cast(floor(e / 86400.0) as bigint) * 86400", "cast(floor(e / 60.0) as bigint) * 60"
    general = w.duck(w.general_date_texts)
    kept = [f"{minute} + 18000", "cast(floor(e / 3600.0) as bigint) * 3600", day, minute, "e", "e", None, f"{minute} - 7200"]
    cases = " ".join(f"when {i} then {iso(of)}" for i, of in enumerate(kept) if of)
    sql["date_parse_general"] = f"""with t as ({general}) select k, date_text, case k % 10 {cases} end as parsed from t"""
    sql["date_parse_relative"] = f"""with t as ({texts}) select k, date_text, case when k % 6 = 4 then
        {iso(f"{w.REF_EPOCH} - (k % 72) * 3600")} end as parsed from t"""
    absolute = [("feed", "k % 4 = 0", "e"), ("json_ld", "k % 5 = 0", "e + 60"), ("open_graph", "k % 6 = 0", "e + 120"),
                ("time_tag", "k % 7 = 1", "e + 180"), ("raw", "k % 3 = 0", "cast(floor(e / 86400.0) as bigint) * 86400"),
                ("relative", "k % 2 = 0", f"{w.REF_EPOCH} - 86400"), ("relative_raw", "k % 3 = 1", f"{w.REF_EPOCH} - 259200"),
                ("relative_time_tag", "k % 7 = 0", f"{w.REF_EPOCH} - (k % 30) * 60")]
    when_ts = " ".join(f"when {cond} then {iso(ts)}" for _, cond, ts in absolute)
    when_name = " ".join(f"when {cond} then '{name}'" for name, cond, _ in absolute)
    sql["publication_date_priority"] = f"""with t as ({w.duck(w.date_candidates)}) select k, case {when_ts} end as published,
        case {when_name} end as date_source from t"""
    sql["date_format_iso"] = "select event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') as iso from events"
    sql["freshness_verdict"] = f"""select event_id, ts >= {REF} - interval 24 hour and ts <= {REF} + interval 15 minute as is_fresh,
        case when ts < {REF} - interval 24 hour then 'STALE_RECORD' when ts > {REF} + interval 15 minute then 'FUTURE_TIMESTAMP' end as reason_code,
        round((epoch_us({REF}) - epoch_us(ts)) / 1000000.0, 6)::double as age_seconds from events"""
    sql["freshness_filter"] = f"""select event_id, user_id, event_type from events
        where ts between {REF} - interval 24 hour and {REF} + interval 15 minute"""

    # Names
    o = f"orgs as ({orgs})"
    sql["entity_normalize"] = f"""with {o} select raw_name, n_rows, {normal("raw_name")} as normal from
        (select trim(raw_name) as raw_name, count(*) as n_rows from orgs where trim(raw_name) <> '' group by 1) n"""
    sql["entity_exact_alias"] = f"""with {o}, {resolve_cte("orgs", "raw_name")} select normal, n_rows, alias_name from (
        select trim(raw_name) as raw, count(*) as n_rows from orgs where trim(raw_name) <> '' group by 1) c join exact using (raw)"""
    for name, folded in (("entity_fuzzy_match", True), ("entity_fuzzy_match_compat", False)):
        sql[name] = f"""with {o}, {resolve_cte("orgs", "raw_name", folded)} select normal, best_name, round(best_score, 6) as best_score,
            best_score >= {fixed.FUZZY_ACCEPT} as accepted from best"""
    sql["entity_resolve"] = f"""with {o}, {record_cte("orgs", "raw_name")} select id, canonical_name, method, confidence from named"""
    log = f"""with {o}, {record_cte("orgs", "raw_name")}, log as (select case when trim(raw_name) = '' then raw_name else trim(raw_name) end as raw_name, canonical_name, method, confidence,
        source_url, '{COLLECTED}' as timestamp from named)"""
    sql["entity_mapping_log"] = f"{log} select * from log"
    sql["entity_method_stats"] = f"""{log} select method, count(*) as n_mappings, round(avg(confidence), 6) as avg_confidence from log group by method"""
    sql["entity_review_band"] = f"""with {o}, {resolve_cte("orgs", "raw_name")} select raw as raw_name, normal, best_name,
        round(best_score, 6) as best_score from resolved where best_score >= {fixed.FUZZY_REVIEW} and best_score < {fixed.FUZZY_ACCEPT}"""
    sql["token_sort_similarity"] = f"""with p as (select distinct lower(p_type || ' ' || p_name) as a, lower(p_name || ' ' || p_brand) as b from part),
        t as (select a, b, {tokens("a")} as ta, {tokens("b")} as tb from p)
        select a, b, round(200.0::double * {common("ta", "tb")} / (length(ta) + length(tb)), 6) as score from t"""

    # Pages and text
    sql["html_clean_text"] = f"""select page_id, {page_text("html", 12000)} as text from pages"""
    sql["html_strip_tags"] = """select page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 12000) as text from pages"""
    m = f"m as ({w.duck(w.marked_pages)})"
    title_text = "nullif(trim(replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp\\b;?', '&', 'g'), '&quot;', '\"')), '')"
    sql["html_metadata"] = f"""with {m} select page_id, {title_text} as title, 'About page ' || page_id as description,
        case when page_id % 4 = 0 then 'Story ' || page_id end as og_title,
        case page_id % 4 when 0 then {w.DUCK.time_text("e", "iso")} when 2 then 'not a date' end as og_published_time,
        case page_id % 4 when 2 then {w.DUCK.time_text("e", "mail")} when 3 then '3 hours ago' end as time_tag,
        case when page_id % 4 = 1 then 1 else 0 end as n_json_ld,
        case when page_id % 4 = 1 then {w.DUCK.time_text("e", "offset")} end as json_ld_date from m"""
    extracted = "case when page_id % 4 = 2 then replace(html, '\">then<', '\"> then <') else html end"
    sql["page_extract"] = f"""with {m} select page_id, case when page_id % 4 = 0 then 'Story ' || page_id else coalesce({title_text}, '') end as title,
        {page_text(extracted, 12000)} as text, case when page_id % 4 = 3 then {iso(f"{w.REF_EPOCH} - 10800")} else {iso("e")} end as published_date from m"""
    sql["evidence_snippet"] = """with s as (select doc_id, text, instr(lower(text), lower(term)) as spot, length(term) as n from
        (select doc_id, text, case doc_id % 3 when 0 then 'THE' when 1 then 'que' else 'zzzz' end as term from documents) d),
        b as (select *, greatest(0, spot - 1 - greatest(10, (500 - n) // 2)) as start from s),
        c as (select *, least(length(text), start + 500) as stop from b)
        select doc_id, case when spot = 0 then trim(substr(text, 1, 500), ' ' || chr(10)) else case when start > 0 then '...' else '' end
            || trim(substr(text, start + 1, stop - start), ' ' || chr(10))
            || case when stop < length(text) then '...' else '' end end as snippet from c"""
    est = "case when length({0}) = 0 then 0 else greatest(1, length({0}) // 4) end"
    sql["token_budget"] = f"""select lang, source, count(*) as n_docs, sum(length(text))::bigint as total_chars,
        sum({est.format("text")})::bigint as total_tokens from documents group by lang, source"""
    sql["payload_reduce"] = """select doc_id, trim(substr(text, 1, greatest(100, length(text) // 2)), ' ' || chr(10)) as reduced from documents"""
    sql["payload_fit_budget"] = """with recursive f(doc_id, t, steps) as (select doc_id, text, 0 from documents union all
        select doc_id, trim(substr(t, 1, greatest(100, length(t) // 2)), ' ' || chr(10)), steps + 1 from f where length(t) > 1000 and steps < 4)
        select doc_id, length(t) as final_chars, steps, length(t) <= 1000 as fits from (select *, row_number() over (partition by doc_id order by steps desc) as rn
        from f) x where rn = 1"""
    sql["rule_extract"] = f"""select doc_id, 'STARTUP' as record_type, '{fixed.RULE_SOURCE_NAME}' as source_name, '{fixed.RULE_SOURCE_URL}' as source_url,
        case when text = '' then 'Unknown' else trim(substr(string_split(text, chr(10))[1], 1, 50)) end as entity_name from documents"""

    chunks = chunks_cte(fixed.MAX_CHUNK_CHARS)
    limit = fixed.MAX_CHUNK_CHARS
    sql["chunk_corpus"] = f"""with {chunks} select doc_id, chunk_no, chunk, length(chunk)::integer as n_chars,
        length(chunk) > {limit} as over_limit from chunks"""
    for name, ctes in (("chunk_stats", chunks), ("chunk_stats_strict", chunks_cte(limit, strict=True))):
        sql[name] = f"""with {ctes} select lang, source, count(*) as n_chunks, sum(length(chunk))::bigint as total_chars,
            max(length(chunk))::integer as max_chars, sum((length(chunk) > {limit})::int)::bigint as n_over_limit from chunks group by lang, source"""
    head = request_head("STARTUP", w.TASK).replace("'", "''")
    sql["extraction_requests"] = f"""with {chunks}, r as (select doc_id, chunk_no, '{head}' || chunk as prompt from chunks)
        select doc_id, chunk_no, prompt, {est.format("prompt")}::bigint as est_tokens from r"""

    # Ingests
    sql["ingest_startups"] = f"with {startups_cte()} {first('startup_rows', 'seq', STARTUP_COLUMNS)}"
    sql["ingest_products"] = f"with {products_cte()} {first('product_rows', 'seq', PRODUCT_COLUMNS)}"
    sql["ingest_papers"] = f"with {papers_cte()} {first('paper_rows', 'k', PAPER_COLUMNS)}"
    sql["ingest_news"] = f"""with {news_cte()}, ok as (select * from news_judged where reason is null)
        {first('ok', f'list_position({fixed.NEWS_SOURCES}, source), page, seq', news_columns())}"""
    sql["ingest_jobs"] = f"with {jobs_cte()} {first('job_rows', 'board, page, seq', JOB_COLUMNS)}"
    sql["required_fields"] = " union all ".join(
        f"select * from (with {_judged(v)} select vertical, reason, count(*) as n_rows from judged where reason like 'MISSING%' "
        f"group by 1, 2) {v}_r" for v in VERTICALS)
    sql["relevance_filter"] = """with t as (select o_orderkey, lower(c_mktsegment) as segment, o_orderpriority as priority,
        case when o_orderkey % 2 = 0 then 'Maintenance lead' else 'Clerk' end as title from orders join customer on o_custkey = c_custkey)
        select o_orderkey, title from t where segment like '%ai%' or segment like '%machine learning%' or segment like '%data%'
        or lower(priority) like '%ai%' or lower(priority) like '%data%' or lower(priority) like '%machine learning%' or lower(title) like '%ai%'"""
    sql["limit_first_n"] = f"""with items as ({w.duck(w.startup_items)}),
        told as (select *, case when trim(login) = '' then 'MISSING_LOGIN' when trim(url) = '' then 'MISSING_URL' end as reason from items),
        kept as (select * from told where reason is null order by seq limit 50),
        cut as (select case when count(*) = 50 then max(seq) else 1e18 end as last from kept)
        select null as reason, login, url, 1 as n_rows from kept
        union all select reason, null, null, count(*) from told, cut where reason is not null and seq <= last group by reason"""
    sql["flatten_entities"] = """select 'job' || o_orderkey as source_url, 'orders' as source_name, c_name as company,
        strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as published_date, (o_orderkey % 2)::integer as is_remote, 'Engineering' as role_family
        from orders join customer on o_custkey = c_custkey"""
    sql["schema_validate"] = """with r as (select p_partkey, case when p_partkey % 11 = 0 then 'INVALID_TYPE' else 'PRODUCT' end as rt,
        case when p_partkey % 7 = 0 then null else p_name end as name, case p_partkey % 5 when 0 then 'FREE' when 1 then 'FREEMIUM' when 2 then 'PAID'
        when 3 then 'ENTERPRISE' else 'CHEAP' end as pricing, case when p_partkey % 13 = 0 then null else 'u' || p_partkey end as url from part)
        select p_partkey, array_to_string(list_filter([case when rt <> 'PRODUCT' then 'recordType' end, case when url is null then 'source.url' end,
        case when name is null then 'content.startupName' end, case when pricing = 'CHEAP' then 'content.pricingModel' end], lambda x: x is not null), ',') as failed from r"""
    parts = """p as (select p_partkey, p_partkey % 11 = 0 as bad_type, case when p_partkey % 17 <> 0 then 'list' end as source,
        case when p_partkey % 13 <> 0 then 'u' || p_partkey end as url, case when p_partkey % 7 <> 0 then p_name end as name,
        case when p_partkey % 5 <> 0 then '2024-01-02' end as day, p_partkey % 6 = 0 as bad_number,
        case when p_partkey % 6 = 0 then 'many' when p_partkey % 6 > 1 then p_partkey::varchar end as number,
        case when p_partkey % 5 = 0 then 'CHEAP' else 'FREE' end as pricing, p_brand, p_type,
        case when p_partkey % 4 = 0 then 'maybe' else 'true' end as remote from part)"""
    from_source = [("source is null", "source.name"), ("url is null", "source.url")]
    faults = {
        "STARTUP": [*from_source, ("name is null", "content.entityName"), ("bad_number", "content.data.employeeCount")],
        "PRODUCT": [*from_source, ("name is null", "content.startupName"), ("pricing = 'CHEAP'", "content.pricingModel")],
        "RESEARCH_PAPER": [("name is null", "content.title"), ("day is null", "content.published_date"), ("bad_number", "content.github_stars")],
        "JOB": [("url is null", "source_url"), ("source is null", "source_name"), ("name is null", "content.company"),
                ("day is null", "content.date"), ("remote = 'maybe'", "content.is_remote")],
        "NEWS": [*from_source, ("name is null", "content.title"), ("day is null", "content.published_date")],
    }
    told = {kind: ", ".join(f"case when {c} then '{rule}' end" for c, rule in [("bad_type", "recordType"), *rules]) for kind, rules in faults.items()}
    sql["schema_validate_kinds"] = f"with {parts} " + " union all ".join(
        f"select p_partkey, '{kind}' as kind, array_to_string(list_filter([{cases}], lambda x: x is not null), ',') as failed from p"
        for kind, cases in told.items())
    flat = {
        "STARTUP": ["source", "url", "name", "number"],
        "PRODUCT": ["source", "url", "name", "pricing"],
        "RESEARCH_PAPER": ["name", "p_brand || ',' || p_type", "'p' || p_partkey", "url", "number", "day"],
        "JOB": ["source", "url", "name", "day", "remote", f"'{fixed.ROLE_FAMILY}'"],
        "NEWS": ["source", "url", "name", "day", "p_type"],
    }
    sql["flatten_kinds"] = f"with {parts} " + " union all ".join(
        f"select p_partkey, '{kind}' as kind, " + " || '|' || ".join(f"coalesce({c}, '')" for c in columns) + " as flat from p"
        for kind, columns in flat.items())
    sql["star_enrichment"] = f"""with r as ({w.duck(w.repo_addresses)}), s as ({w.duck(w.repo_stats)}),
        kk as (select *, case when repo like 'http%' then repo else 'https://github.com/' || repo end as full_repo from r),
        x as (select *, case when lower(full_repo) like '%github.com/%' then
        lower(regexp_replace(regexp_extract(full_repo, '(?i)github\\.com/([^/]+/[^/#?]+)', 1), '\\.git$', '')) end as repo_key from kk)
        select k, coalesce(own_stars, case when own_stars is null then stars end)::bigint as stars from x left join s using (repo_key)"""

    # Reports
    sql["ingest_report"] = _metrics()
    sql["ingest_report_total"] = f"""with m as ({_metrics()}), t as (select * from m union all select 'ALL', sum(discovered), sum(valid), sum(duplicates), sum(rejected) from m)
        select vertical, discovered::bigint as discovered, valid::bigint as valid, duplicates::bigint as duplicates, rejected::bigint as rejected,
        round(valid / 60.0::double, 6) as throughput from t"""
    keys = [("startups", startups_cte(), "startup_rows"), ("products", products_cte(), "product_rows"),
            ("research_papers", papers_cte(), "paper_rows"), ("jobs", jobs_cte(), "job_rows")]
    counts = [f"select * from (with {ctes} select '{n}' as table_name, count(distinct hash_key) as n_rows from {rows}) {n}_t"
              for n, ctes, rows in keys]
    counts.append(f"""select * from (with {news_cte()} select 'news' as table_name, count(distinct hash_key) as n_rows
        from news_judged where reason is null) news_t""")
    counts.append("select 'entity_mappings' as table_name, sum(n) as n_rows from (" + " union all ".join(
        f"select * from (with {ctes} select count(*) as n from {rows}) {n}_l" for n, ctes, rows in keys if n != "research_papers") + ") l")
    sql["table_counts"] = "select table_name, n_rows::bigint as n_rows from (" + " union all ".join(counts) + ") c"
    sql["source_coverage"] = f"""with registry(vertical, name, enabled) as (values {_values([(v, n, e) for v, n, _, _, _, e in fixed.REGISTRY])}),
        counts as (select source, count(*) as n from ({w.duck(w.news_items)}) i group by source
            union all select source, count(*) from ({w.duck(w.job_items).replace("cast(e as string)", "cast(e as varchar)")}) i group by source
            union all select 'GitHub AI Organizations', count(*) from ({w.duck(w.startup_items)}) i
            union all select 'Hugging Face Models', count(*) from ({w.duck(w.product_items)}) i
            union all select 'Papers With Code', count(*) from ({w.duck(w.paper_items)}) i)
        select vertical, name, enabled and name <> 'Engadget AI' as enabled,
            case when name = 'Engadget AI' then 0 else coalesce(n, 0) end as n_rows,
            case when name = 'Engadget AI' then coalesce(n, 0) else 0 end as n_disabled
        from registry left join counts on name = source"""
    sql["export_matrix"] = f"""with {jobs_cte()}, j as ({first('job_rows', 'board, page, seq', JOB_COLUMNS)})
        select hash_key, schema_version, record_type, source_name, source_url, company, published_date,
        case when is_remote then '1' else '0' end as is_remote, role_family, collected_at from j"""
    sql["export_roundtrip"] = f"""with {papers_cte()}, p as ({first('paper_rows', 'k', PAPER_COLUMNS)})
        select hash_key, schema_version, record_type, title, authors, coalesce(paper_url, '') as paper_url, coalesce(github_url, '') as github_url,
        coalesce(cast(github_stars as varchar), '') as github_stars, published_date, collected_at from p"""
    sql["vendor_graph_edges"] = f"""select * from (with {startups_cte()} select distinct canonical_name as vendor from startup_rows) v
        join (select * from (with {products_cte()} select canonical_name as vendor, 'PRODUCES' as relation, url as target, 1::bigint as weight
            from ({first('product_rows', 'seq', '*')}) p) pp
        union all select * from (with {jobs_cte()} select canonical_name as vendor, 'HIRES' as relation, 'Engineering' as target, count(*) as weight
            from ({first('job_rows', 'source, page, seq', '*')}) q group by 1) jj) e using (vendor)"""
    # Multi-hop relations: ways of each length, then the least length per pair.
    def reach(steps: str, starts: str, hops: int) -> str:
        levels = "".join(f""", h{i} as (select h.start, s.dst as node, sum(h.n)::bigint as n from h{i - 1} h join steps s on s.src = h.node group by 1, 2)"""
                         for i in range(1, hops + 1))
        every = " union all ".join(f"select start, node, {i} as hops, n from h{i}" for i in range(hops + 1))
        return f"""with steps as (select distinct src, dst from ({steps}) s), h0 as (select distinct node as start, node, 1::bigint as n from ({starts}) t){levels}
            select start, node, min(hops)::int as hops, arg_min(n, hops) as n_paths from ({every}) e group by 1, 2 having min(hops) > 0"""

    edges = sql["vendor_graph_edges"]
    sql["vendor_reach"] = reach(
        f"""select 'vendor:' || vendor as src, lower(relation) || ':' || target as dst from ({edges}) e
            union all select lower(relation) || ':' || target, 'vendor:' || vendor from ({edges}) e where relation = 'HIRES'""",
        f"select 'vendor:' || vendor as node from ({edges}) e", 3)
    sql["region_reach"] = reach(
        """select 'region:' || n_regionkey as src, 'nation:' || n_nationkey as dst from nation
            union all select 'nation:' || s_nationkey, 'supplier:' || s_suppkey from supplier
            union all select 'supplier:' || l_suppkey, 'customer:' || o_custkey from lineitem join orders on l_orderkey = o_orderkey
            union all select 'customer:' || c_custkey, 'nation:' || c_nationkey from customer""",
        "select 'region:' || n_regionkey as node from nation", 4)

    # Vectors: all pairs, and what can be reached over them.
    def groups(cosine: float) -> str:
        return f"""with recursive v as materialized (select vec_id, embedding::double[] as e from embeddings where embedding is not null),
            l as materialized (select x.vec_id as a, y.vec_id as b from v x join v y on x.vec_id <> y.vec_id and list_cosine_similarity(x.e, y.e) >= {cosine}),
            reached(n, r) as (select vec_id, vec_id from v union select l.a, reached.r from reached join l on l.b = reached.n),
            g as (select n as vec_id, min(r) as group_id from reached group by n)
            select vec_id, group_id, count(*) over (partition by group_id) as group_size, vec_id = group_id as is_representative from g"""

    sql["semantic_dedup"] = groups(0.9)
    sql["semantic_topics"] = groups(0.42)

    # Extraction tables
    a = f"a as ({w.duck(w.attempts)})"
    sql["fallback_resolution"] = f"""with {a}, o as (select *, row_number() over (partition by call_id order by provider_rank, attempt) as rn from a where status = 'ok'),
        n as (select call_id, count(*) as n_attempts from a group by call_id)
        select call_id, n_attempts, provider_rank, body as result, o.call_id is null as offline from n left join (select * from o where rn = 1) o using (call_id)"""
    sql["fallback_telemetry"] = f"""with {a}, o as (select call_id, provider_rank, row_number() over (partition by call_id order by provider_rank, attempt) as rn from a where status = 'ok'),
        f as (select c.call_id, o.provider_rank from (select distinct call_id from a) c left join (select * from o where rn = 1) o using (call_id))
        select count(*) as total_calls, sum((coalesce(provider_rank, -1) = 0)::int)::bigint as provider_0_wins,
        sum((coalesce(provider_rank, -1) = 1)::int)::bigint as provider_1_wins, sum((coalesce(provider_rank, -1) = 2)::int)::bigint as provider_2_wins,
        sum((provider_rank is null)::int)::bigint as offline_fallbacks,
        (select count(*) from a where status = 'rate_limited') as rate_limit_count, (select count(*) from a where status = 'too_large') as payload_too_large_count from f"""
    sql["extraction_responses"] = """select event_id, case when event_id % 7 = 0 then 'unreadable' else array_to_string(list_filter([
        case when event_type = 'error' then 'recordType' end, case when event_id % 5 = 0 then 'source.url' end,
        case when event_type = 'view' then 'content.data.employeeCount' end], lambda x: x is not null), ',') end as failed,
        case when event_id % 7 <> 0 then 'Org ' || user_id end as entity_name from events"""

    # Streams
    sql["stream_news_ingest"] = sql["ingest_news"]
    sql["stream_news_quarantine"] = f"""with {news_cte()} select source, reason, count(*) as n_rows from news_judged
        where reason is not null group by source, reason"""
    sql["stream_fresh_ingest"] = f"""select event_id, sha256('event:' || lower(event_type || ':' || event_id)) as hash_key,
        strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as published_date from events
        where ts between {REF} - interval 24 hour and {REF} + interval 15 minute"""
    sql["stream_quarantine"] = f"""select event_id, case when ts < {REF} then 'STALE_RECORD' else 'FUTURE_TIMESTAMP' end as reason_code
        from events cross join (select 0 as copy union all select 1) c where not (ts between {REF} - interval 24 hour and {REF} + interval 15 minute)"""
    sql["stream_source_counts"] = """select strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') as window_start, event_type, count(*) as n_rows
        from events group by 1, 2"""
    return sql
