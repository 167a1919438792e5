"""The queries of problems 1 to 10 over the archive's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, table
from . import bpe, conversations, forms, mixing, names, neighbours, packing, pii, residue, tokens

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_entity_pairs(table(spark, d, "card"))


def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entity_classes(table(spark, d, "card"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.places(table(spark, d, "text_block"))


def p2_masked(spark: SparkSession, d: str) -> DataFrame:
    return pii.masked_blocks(table(spark, d, "text_block"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return tokens.unusable_estimates(table(spark, d, "doc"), table(spark, d, "text_block"))


def p3_document_totals(spark: SparkSession, d: str) -> DataFrame:
    return tokens.document_budget(table(spark, d, "documents"))


def p3_block_totals(spark: SparkSession, d: str) -> DataFrame:
    return tokens.block_budget(table(spark, d, "doc"), table(spark, d, "text_block"), table(spark, d, "card"))


def p4_batches(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_items(table(spark, d, "rec_row"), table(spark, d, "pack_capacity"))


def p4_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing.fill_report(p4_batches(spark, d), table(spark, d, "pack_capacity"))


def p4_totals(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity what is in its batches, and how many batches hold too much or a part of an item that needn't be cut."""
    b = p4_batches(spark, d)
    limits = table(spark, d, "pack_capacity").select("pass_name", "capacity_tokens").distinct()
    per = b.groupBy("pass_name", "batch").agg(F.sum("tokens").alias("t")).join(F.broadcast(limits), "pass_name")  # a fixed table of a few rows
    over = per.groupBy("pass_name").agg(F.count_if(F.col("t") > F.col("capacity_tokens")).alias("too_full"))
    whole = b.groupBy("pass_name").agg(F.count_if(F.col("piece") == 0).alias("items"), F.count(F.lit(1)).alias("pieces"), F.sum("tokens").alias("tokens"))
    return whole.join(over, "pass_name")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return neighbours.neighbour_pairs(table(spark, d, "vectors"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return forms.disguised_texts(table(spark, d, "text_block"), table(spark, d, "card"))


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    return forms.archive_forms(table(spark, d, "text_block"), table(spark, d, "card"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return conversations.broken_sessions(table(spark, d, "session_line"))


def p7_conversations(spark: SparkSession, d: str) -> DataFrame:
    return conversations.conversations(table(spark, d, "session_line"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode_corpus(table(spark, d, "documents"))


def _sized(spark: SparkSession, d: str) -> DataFrame:
    wanted = F.broadcast(table(spark, d, "mix_target").select("source").distinct())  # a fixed table of a few rows
    return cut(tokens.count_tokens(table(spark, d, "documents").join(wanted, "source", "left_semi"), keep=("doc_id", "source")))  # sizes are read twice, texts once


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(_sized(spark, d), table(spark, d, "mix_target"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    docs, targets = _sized(spark, d), table(spark, d, "mix_target")
    return mixing.mix_report(mixing.mix_sources(docs, targets), docs, targets)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "documents"))


def p10_kept(spark: SparkSession, d: str) -> DataFrame:
    return residue.without_residue(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found,
        "p1_entities": p1_entities,
        "p2_found": p2_found,
        "p2_masked": p2_masked,
        "p3_found": p3_found,
        "p3_document_totals": p3_document_totals,
        "p3_block_totals": p3_block_totals,
        "p4_batches": p4_batches,
        "p4_fill": p4_fill,
        "p4_totals": p4_totals,
        "p5_found": p5_found,
        "p6_found": p6_found,
        "p6_forms": p6_forms,
        "p7_found": p7_found,
        "p7_conversations": p7_conversations,
        "p8_ids": p8_ids,
        "p9_mix": p9_mix,
        "p9_shares": p9_shares,
        "p10_found": p10_found,
        "p10_kept": p10_kept,
    }


# Rows once, their words, depth in the chain, order and the sessions to drop.
_SESSIONS = """
    with recursive l as (select distinct session_id, line_no, msg_uuid as id, parent_uuid as parent, line_type, role, content, ts from session_line where session_id is not null),
     m as (select *, coalesce(regexp_matches(content, '(?s)^\\s*\\[\\s*(\\{\\s*("[A-Za-z_]*("\\s*(:.*)?)?)?)?$') and not json_valid(content), false) as is_cut,
               case when coalesce(trim(role), '') <> '' then lower(trim(role)) else lower(line_type) end as who from l),
     w as (select *, case who when 'human' then 'user' when 'ai' then 'assistant' when 'model' then 'assistant' else who end as speaker,
               case when is_cut then '' when regexp_matches(content, '^\\s*\\[\\s*(\\{|\\]|$)') and json_valid(content)
                    then array_to_string(list_transform(list_filter(from_json(content, '[{"type":"VARCHAR","text":"VARCHAR"}]'), lambda i: i.type = 'text' and i.text is not null), lambda i: i.text), chr(10)) else coalesce(content, '') end as words from m),
     r as (select *, speaker in ('user', 'assistant') and regexp_matches(words, '[^\\s\\p{Z}\\p{Cc}\\p{Cf}\\x{34F}\\x{115F}\\x{1160}\\x{2800}\\x{3164}\\x{FE00}-\\x{FE0F}\\x{FFA0}]') as is_message, max(parent is not null) over (partition by session_id) as chained from w),
     c as (select session_id, id, 1 as depth from r where chained and parent is null
           union all select r.session_id, r.id, c.depth + 1 from c join r on r.session_id = c.session_id and r.parent = c.id),
     o as (select r.session_id, r.speaker, r.words, row_number() over (partition by r.session_id order by c.depth, r.ts, r.line_no) as place from r left join c on c.session_id = r.session_id and c.id = r.id where is_message),
     n as (select *, lead(speaker) over (partition by session_id order by place) as after from o),
     b as (select session_id from r group by 1 having bool_or(is_cut) or not bool_or(is_message)
           union select a.session_id from r a where a.parent is not null and not exists (select 1 from r b where b.session_id = a.session_id and b.id = a.parent)
           union select session_id from n where place = 1 and speaker <> 'user' or speaker = 'user' and coalesce(after, 'user') = 'user')
"""
SQL = {
    "p3_found": """
        with d as (select * from doc qualify row_number() over (partition by doc_id order by taped_at desc) = 1),
             b as (select doc_id, seq, max(floor(len(regexp_extract_all(coalesce(text, ''), '[\\x{3000}-\\x{9FFF}\\x{F900}-\\x{FAFF}]')) + (length(coalesce(text, '')) - len(regexp_extract_all(coalesce(text, ''), '[\\x{3000}-\\x{9FFF}\\x{F900}-\\x{FAFF}]'))) / 4)) as n from text_block group by 1, 2),
             s as (select doc_id, sum(n) as n from b group by 1)
        select doc_id from d join s using (doc_id) where tokens_est is null or tokens_est * 2 < n or tokens_est > n * 2
    """,
    "p4_totals": """
        with i as (select doc_id, seq, max(tokens) as n from rec_row where tokens > 0 group by 1, 2), c as (select distinct pass_name, capacity_tokens as cap from pack_capacity)
        select pass_name, count(*) as items, sum(ceil(n / cap))::bigint as pieces, sum(n)::bigint as tokens, 0::bigint as too_full from i, c group by pass_name
    """,
    "p5_found": """
        with v as (select distinct vec_id, model, vec::double[] as x from vectors where vec_id is not null and len(vec) = 64 and len(list_filter(vec, lambda e: e is not null and isfinite(e))) = 64 and len(list_filter(vec, lambda e: e <> 0)) > 0),
             p as (select a.vec_id as a, b.vec_id as b, list_cosine_similarity(a.x, b.x) as s from v a join v b on a.model = b.model and a.vec_id <> b.vec_id),
             k as (select a, b from p qualify row_number() over (partition by a order by round(s, 12) desc, b) <= 10)
        select distinct least(a, b) as vec_id_a, greatest(a, b) as vec_id_b from k
    """,
    "p7_found": f"{_SESSIONS} select session_id from b",
    "p7_conversations": f"{_SESSIONS} select session_id, place - 1 as turn, speaker, words from o where session_id not in (select session_id from b)",
}


def oracle_sql() -> dict[str, str]:
    """SQL of the problems that SQL can express; the others are tested against brute force, round trips and public encoders."""
    return SQL
