"""The numbered queries over documents, pages and benchmark, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm import alignment, decontaminate, language_model, line_dedup, packing, pii, prefix_trie, repetition, simhash, token_files, transducer, url_rules, warc
from gridloom.llm.common import table

#: The rules of the URL query: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judged(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(table(spark, sf_dir, "documents"))


def op6_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.scored_documents(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.shared_opening_trie(table(spark, sf_dir, "conversations"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_links(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_repetition": op2_repetition,
    "op3_token_files": op3_token_files,
    "op4_packing": op4_packing,
    "op5_token_counts": op5_token_counts,
    "op6_attention": op6_attention,
    "op7_personal_data": op7_personal_data,
    "op8_url_rules": op8_url_rules,
    "op9_decontaminate": op9_decontaminate,
    "op10_warc": op10_warc,
    "op11_line_dedup": op11_line_dedup,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES: dict[str, str] = {
    "op8_url_rules": """
        with rules(host, path, action) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        rest as (select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
        parts as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
        fits as (
            select p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) as rule, arg_max(r.action, length(r.host || r.path)) as action
            from parts p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path) group by p.page_id)
        select p.page_id, p.host, p.path, f.rule, coalesce(f.action, 'allow') as verdict from parts p left join fits f on p.page_id = f.page_id""",
    "op9_decontaminate": r"""
        with d as (select doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') as w from documents),
        i as (select item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda x: x <> '') as w from benchmark),
        si as (select distinct item_id, array_to_string(w[k:k + 4], ' ') as s from (select item_id, w, unnest(range(1, len(w) - 3)) as k from i)),
        sd as (select doc_id, array_to_string(w[k:k + 4], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 3)) as k from d)),
        n as (select item_id, count(*) as n_shingles from si group by item_id),
        m as (select doc_id, item_id, count(distinct s) as n_shared from sd join si using (s) group by doc_id, item_id)
        select doc_id, item_id, n_shingles, n_shared from m join n using (item_id) where 10 * n_shared >= 8 * n_shingles""",
    "op10_warc": """
        with p as (select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
        m as (select *, max(page_id) over (partition by payload_digest) as first from p)
        select page_id, payload_bytes, payload_digest, case when payload_bytes >= 1000 and page_id < first then 'revisit' else 'response' end as record_type,
            case when payload_bytes >= 1000 and page_id < first then first end as refers_to from m""",
    "op11_line_dedup": """
        with rows as (select doc_id, string_split(coalesce(text, ''), chr(10)) as own from documents),
        lines as (select doc_id, unnest(own) as line, unnest(range(1, len(own) + 1)) as place from rows),
        keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
        held as (select key, max(doc_id) as holder from keyed where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
        judged as (select k.*, h.holder is not null and h.holder <> k.doc_id as gone from keyed k left join held h on k.key = h.key)
        select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
            sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not gone), '')) as kept_sha256
        from judged group by doc_id""",
    "op12_prefix_trie": """
        with own as (select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first) as turns from conversations group by conv_id),
        steps as (select *, flatten(list_transform(string_split(conv_id::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])) as steps from own),
        cut as (select *, xor(list_reduce(list_prepend(4294967295, steps), lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, 3988292384 * (crc & 1)) end), 4294967295) % 6 as h from steps),
        rebuilt as (
            select c.conv_id, list_concat(coalesce(o.turns[1:c.h], []), c.turns[c.h + 1:]) as turns
            from cut c left join own o on o.conv_id = c.conv_id - c.conv_id % 100),
        members as (select conv_id, d, turns[1:d] as path, len(turns) = d as ends from (select *, unnest(range(0, len(turns) + 1)) as d from rebuilt)),
        nodes as (
            select d, path, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
            from members group by d, path),
        children as (select path[1:d - 1] as path, d - 1 as d, count(*) as n from nodes where d > 0 group by all),
        counted as (
            select n.*, coalesce(c.n, 0) as n_children, case when n.d = 0 then 0 else (n.n_convs - 1) * length(n.path[n.d].text) end as saved
            from nodes n left join children c on n.d = c.d and n.path = c.path),
        under as (
            select k as d, path[1:k] as path, count(*) filter (where n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
            from (select *, unnest(range(0, d + 1)) as k from counted) group by all)
        select c.conv_id, c.d as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, u.n_leaves, u.saved_tokens, c.ends_sha256
        from counted c join under u on c.d = u.d and c.path = u.path left join nodes p on p.d = c.d - 1 and p.path = c.path[1:c.d - 1]""",
}
