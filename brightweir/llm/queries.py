"""The numbered queries: each operator over its whole table, in the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brightweir.llm import (
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    html_wrapper,
    langid,
    packing,
    quality,
    secret_scan,
    sharding,
    simhash,
    token_alignment,
    url_filter,
    whitening,
)
from brightweir.llm.common import table
from brightweir.session import configure


def _over(name: str, operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(table(configure(spark), sf_dir, name))

    return query


def _quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(configure(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_ledger": _over("documents", secret_scan.secrets),
    "op2_hilbert_packing": _over("documents", packing.packed),
    "op3_cuckoo_dedup": _over("documents", exact_dedup.deduplicated),
    "op4_wrapper_text": _over("pages", html_wrapper.extracted),
    "op5_quality_rules": _quality,
    "op6_url_models": _over("pages", url_filter.filtered),
    "op7_gray_simhash": _over("documents", simhash.near_duplicates),
    "op8_kd_tree_shards": _over("documents", sharding.sharded),
    "op9_byte_bpe": _over("documents", byte_bpe.encoded_documents),
    "op10_cross_parsing_language": _over("documents", langid.identified),
    "op11_token_alignment": _over("documents", token_alignment.aligned_documents),
    "op12_cholesky_whitening": _over("embeddings", whitening.whitened),
    "op13_cross_polytope_dedup": _over("embeddings", embedding_dedup.near_duplicates),
}


def _secret_sql() -> str:
    """Each rule's matches by itself; DuckDB takes a pattern per statement only as a constant."""

    def matches(rank: int, rule: secret_scan.Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        return f"""select doc_id, '{rule.kind}' as kind, {rank} as rank, {str(rule.base).lower()} as base, {rule.least} as least,
            string_split_regex(t, {pattern}) as gaps, regexp_extract_all(t, {pattern}) as whole,
            regexp_extract_all(t, {pattern}, {rule.group}) as part from docs where regexp_matches(t, {pattern})"""

    every = " union all ".join(matches(rank, rule) for rank, rule in enumerate(secret_scan.RULES))
    return f"""
        with docs as (select doc_id, coalesce(text, '') as t from documents),
        hits as ({every}),
        each as (select *, unnest(range(1, len(whole) + 1)) as i from hits),
        placed as (
            select doc_id, kind, rank, base, least, length(part[i]) as part,
                list_sum(list_transform(gaps[1:i], lambda x: length(x)))
                    + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) as a,
                length(whole[i]) as size
            from each),
        spans as (select *, kind || ':' || cast(a as bigint) || ':' || cast(a + size as bigint) as span from placed where part >= least),
        found as (
            select doc_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
                count(*) filter (kind = 'hex') as n_hex, string_agg(span, ',' order by a, rank) filter (base) as base,
                string_agg(span, ',' order by a, rank) as spans
            from spans group by doc_id)
        select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
            sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
        from docs left join found using (doc_id)"""


ORACLE_SQL: dict[str, str] = {
    "op1_secret_ledger": _secret_sql(),
    "op3_cuckoo_dedup": r"""
        with digests as (
            select doc_id, length(coalesce(text, '')) as n_chars,
                sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
            from documents),
        ranked as (
            select *, first_value(doc_id) over w as keep_id, row_number() over w as place,
                count(*) over (partition by text_sha256) as group_size
            from digests window w as (partition by text_sha256 order by n_chars desc, doc_id nulls last))
        select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from ranked""",
}
