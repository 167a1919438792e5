"""Queries: text functions, sessions, sampling, packing, spans, search and scoring."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import sampling, scoring, search, sessions, spans, tape
from ..session import shared_folder, table
from ..sources.jsonl import tolerant
from .catalogue import query
from .census import FIRST_BLOCK, FIRST_CARD, LAST_CARD, LATEST_DOC, TERMS, ESTIMATE, blocks, docs, first_cards, last_cards

SPACE = "[\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
SQUASH = f"lower(regexp_replace(regexp_replace({{0}}, '{SPACE.replace('{', '{{').replace('}', '}}')}+', ' ', 'g'), '^ | $', '', 'g'))"
STRIP = f"regexp_replace({{0}}, '^{SPACE.replace('{', '{{').replace('}', '}}')}+|{SPACE.replace('{', '{{').replace('}', '}}')}+$', '', 'g')"
ROWS = "(select doc_id, seq, max(tokens) as tokens, max(chars) as chars, max(year) as year, max(project) as project, max(modality) as modality from rec_row where tokens > 0 group by doc_id, seq)"


def scan(spark: SparkSession, d: str) -> DataFrame:
    """rec_row once per key, usable sizes only."""
    top = lambda c: F.max(c).alias(c)
    return table(spark, d, "rec_row").where("tokens > 0").groupBy("doc_id", "seq").agg(*map(top, ("tokens", "chars", "year", "project", "modality")))


@query("select doc_id, md5(nfc_normalize(regexp_replace(text, '\\r\\n?', chr(10), 'g'))) as digest from documents")
def canonical_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(tx.canonical_text(F.col("text"))).alias("digest"))


@query("""
    with recursive b as (
        select doc_id, text as rest, 0 as unit, cast(null as varchar) as block from documents where text is not null and text <> ''
        union all
        select doc_id, substr(rest, n + 1), unit + 1, substr(rest, 1, n) from (
            select *, case when length(rest) <= 2000 then length(rest) when strpos(substr(reverse(substr(rest, 1, 2000)), 1, 1999), chr(10)) > 0
                then 2001 - strpos(substr(reverse(substr(rest, 1, 2000)), 1, 1999), chr(10)) else 2000 end as n from b where length(rest) > 0))
    select doc_id, unit, length(block)::int as chars, md5(block) as digest from b where block is not null
""")
def text_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "documents").select("doc_id", F.posexplode(tx.text_blocks(F.col("text"), 2_000)).alias("unit", "block"))
    return b.select("doc_id", (F.col("unit") + 1).alias("unit"), F.char_length("block").alias("chars"), F.md5("block").alias("digest"))


@query("""
    select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '[\\t\\n\\r]', ' ', 'g'), '\\x{1b}\\[[0-9;?]*[ -/]*[@-~]', '', 'g'), '[\\x{00}-\\x{08}\\x{0b}-\\x{1f}\\x{7f}]', '', 'g')) as digest from documents
""")
def strip_control(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(tx.printable(F.col("text"))).alias("digest"))


# Capital I with a dot is lower i with a dot above it on the JVM; DuckDB drops the dot.
@query(f"select doc_id, md5({SQUASH.format('replace(text, chr(304), chr(105) || chr(775))')}) as digest from documents")
def squashed_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(tx.squash(F.col("text"))).alias("digest"))


@query("""
    with y as (select doc_id, text, regexp_extract(text, '(?:^|[^\\p{L}\\p{N}_])(?:19|20)[0-9]{2}(?:$|[^\\p{L}\\p{N}_])') as hit from documents),
         z as (select *, regexp_extract(hit, '((?:19|20)[0-9]{2})', 1) as year from y where hit <> '')
    select doc_id, md5(substr(text, 1, strpos(text, hit) - 1) || replace(hit, year, (year::int + 7)::varchar) || substr(text, strpos(text, hit) + length(hit))) as digest from z
""")
def mutate_year(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents").select("doc_id", F.md5(tx.shift_year(F.col("text"))).alias("digest"))
    return m.where("digest is not null")


@query("""
    with y as (select doc_id, text, list_filter(regexp_extract_all(regexp_replace(text, '([^\\p{L}\\p{N}_])', '\\1\\1', 'g'), '(?:^|[^\\p{L}\\p{N}_])[0-9]{2,6}(?:$|[^\\p{L}\\p{N}_])'), lambda n: not regexp_matches(n, '^[^0-9]?(?:19|20)[0-9]{2}[^0-9]?$')) as hits from documents),
         z as (select *, hits[1] as hit, regexp_extract(hits[1], '([0-9]+)', 1) as num from y where len(hits) > 0)
    select doc_id, md5(substr(text, 1, strpos(text, hit) - 1) || replace(hit, num, num || '0') || substr(text, strpos(text, hit) + length(hit))) as digest from z
""")
def mutate_number(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents").select("doc_id", F.md5(tx.scale_number(F.col("text"))).alias("digest"))
    return m.where("digest is not null")


@query("""
    select doc_id, md5(case when strpos(text, ' is not ') > 0 then substr(text, 1, strpos(text, ' is not ') - 1) || ' is ' || substr(text, strpos(text, ' is not ') + 8)
        else substr(text, 1, strpos(text, ' is ') - 1) || ' is not ' || substr(text, strpos(text, ' is ') + 4) end) as digest
    from documents where strpos(text, ' is not ') > 0 or strpos(text, ' is ') > 0
""")
def mutate_negation(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents").select("doc_id", F.md5(tx.flip_negation(F.col("text"))).alias("digest"))
    return m.where("digest is not null")


# The most frequent capitalised word of a text, the first of equals; neighbours must not share the sign between them.
_TOP_WORD = """
    t as (select doc_id, text, list_transform(regexp_extract_all(regexp_replace(text, '([^\\p{L}\\p{N}_])', '\\1\\1', 'g'), '(?:^|[^\\p{L}\\p{N}_])[A-Z][a-z]{3,}(?:$|[^\\p{L}\\p{N}_])'), lambda w: regexp_extract(w, '[A-Za-z]+')) as ws from documents),
    c as (select doc_id, ws[i] as w, count(*) as n, min(i) as i from t, unnest(range(1, len(ws) + 1)) as r(i) group by 1, 2),
    top as (select doc_id, w from c qualify row_number() over (partition by doc_id order by n desc, i) = 1 and n >= 3)
"""
_SWAPPED = "left(text, strpos(text, w) + length(w) - 1) || replace(substr(text, strpos(text, w) + length(w)), w, 'Zorbell')"


@query(f"with {_TOP_WORD} select doc_id, md5({_SWAPPED}) as digest from top join documents using (doc_id)")
def mutate_entity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(tx.swap_entity(F.col("text"))).alias("digest")).where("digest is not null")


@query(f"""
    with {_TOP_WORD},
    y as (select doc_id, regexp_extract(text, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:19|20)[0-9]{{2}}(?:$|[^\\p{{L}}\\p{{N}}_])') as hit, list_filter(regexp_extract_all(regexp_replace(text, '([^\\p{{L}}\\p{{N}}_])', '\\1\\1', 'g'), '(?:^|[^\\p{{L}}\\p{{N}}_])[0-9]{{2,6}}(?:$|[^\\p{{L}}\\p{{N}}_])'), lambda n: not regexp_matches(n, '^[^0-9]?(?:19|20)[0-9]{{2}}[^0-9]?$')) as hits from documents),
    can as (select d.doc_id, [w is not null, coalesce(strpos(text, ' is ') > 0 or strpos(text, ' is not ') > 0, false), coalesce(hit <> '', false), coalesce(len(hits) > 0, false)] as ok from documents d left join top using (doc_id) join y on y.doc_id = d.doc_id),
    k as (select doc_id, case when ok[doc_id % 4 + 1] then doc_id % 4 + 1 else list_position(ok, true) end as k from can)
    select doc_id, (['entity_swap', 'negation_flip', 'year_shift', 'number_scale'])[k] as kind from k where k is not null and k > 0
""")
def plant_defects(spark: SparkSession, d: str) -> DataFrame:
    made = table(spark, d, "documents").select("doc_id", tx.plant_defect(F.col("text"), F.col("doc_id")).alias("m"))
    return made.where("m is not null").select("doc_id", F.col("m.kind").alias("kind"))


@query(f"select doc_id, seq, '[doc ' || left(doc_id, 10) || ' | year ' || coalesce(year::varchar, '?') || ' | project ' || coalesce(project, '?') || ' | seq ' || seq || ']' as header from {ROWS}")
def record_headers(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d).select("doc_id", "seq", tx.record_header(F.col("doc_id"), F.col("year"), F.col("project"), F.col("seq")).alias("header"))


@query("""
    with l as (select distinct session_id, line_no, line_type, role, content, ts from session_line),
         w as (select *, case when regexp_matches(content, '^\\s*\\[') and json_valid(content) then
                    array_to_string(list_transform(list_filter(from_json(content, '[{"type":"VARCHAR","text":"VARCHAR"}]'), lambda i: i.type = 'text' and i.text is not null), lambda i: i.text), chr(10)) else coalesce(content, '') end as words from l),
         s as (select session_id, ts, line_no, content, case line_type when 'summary' then 'SUMMARY: ' || words when 'user' then 'USER: ' || trim(words, E' \\t\\n\\r') when 'assistant' then 'ASSISTANT: ' || trim(words, E' \\t\\n\\r') end as said, trim(words, E' \\t\\n\\r') as bare from w),
         r as (select *, row_number() over (partition by session_id order by ts, line_no, md5(coalesce(content, ''))) - 1 as place from s where said is not null and bare <> '')
    select session_id, (place // 500)::bigint as part, count(*) as lines, md5(string_agg(said, chr(10) || chr(10) order by place)) as digest from r group by 1, 2
""")
def session_transcripts(spark: SparkSession, d: str) -> DataFrame:
    t = sessions.transcripts(table(spark, d, "session_line"))
    return t.select("session_id", "part", "lines", F.md5("transcript").alias("digest"))


@query("select session_id, min(year(ts))::int as year from session_line where line_type in ('user', 'assistant') and year(ts) between 1990 and 2100 group by 1")
def session_years(spark: SparkSession, d: str) -> DataFrame:
    return sessions.years(table(spark, d, "session_line"))


@query(f"""
    with r as (select *, md5('7|' || doc_id || '|' || seq) as mix from {ROWS}), c as (select year, project, sum(tokens) as cell, sum(sum(tokens)) over () as total from r group by 1, 2),
         s as (select *, coalesce(sum(tokens) over (partition by year, project order by mix, doc_id, seq rows between unbounded preceding and 1 preceding), 0) as before from r)
    select s.doc_id, s.seq, s.year, s.project, s.tokens, s.before::bigint as before from s join c on s.year is not distinct from c.year and s.project is not distinct from c.project
    where s.before < greatest(200000 * c.cell / c.total, least(c.cell, 60))
""")
def stratified_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.stratified_sample(scan(spark, d), 200_000).select("doc_id", "seq", "year", "project", "tokens", "before")


@query(f"select doc_id, seq, project, tokens from (select *, sum(tokens) over (order by project nulls first, doc_id, seq rows unbounded preceding) as upto from {ROWS}) where upto <= 300000")
def select_rows_budget(spark: SparkSession, d: str) -> DataFrame:
    return sampling.within_budget(scan(spark, d), 300_000).select("doc_id", "seq", "project", "tokens")


@query(f"""
    with recursive o as materialized (select *, row_number() over (order by year nulls first, project nulls first, doc_id, seq) - 1 as place from {ROWS}),
    p as (
        select doc_id, seq, tokens, place, 0::bigint as batch, tokens as filled from o where place = 0
        union all
        select o.doc_id, o.seq, o.tokens, o.place, case when p.filled + o.tokens > 8192 then p.batch + 1 else p.batch end,
               case when p.filled + o.tokens > 8192 then o.tokens else p.filled + o.tokens end
        from p join o on o.place = p.place + 1)
    select doc_id, seq, tokens, batch from p
""")
def pack_batches(spark: SparkSession, d: str) -> DataFrame:
    return sampling.greedy_batches(scan(spark, d), ["year", "project", "doc_id", "seq"], 8_192).select("doc_id", "seq", "tokens", "batch")


@query(f"select doc_id, seq, ((row_number() over (order by project nulls first, doc_id, seq) - 1) // 48)::bigint as batch from {ROWS}")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    return sampling.fixed_batches(scan(spark, d), ["project", "doc_id", "seq"]).select("doc_id", "seq", "batch")


@query(f"select doc_id, seq, tokens from {ROWS} where tokens between 50 and 8500")
def token_range(spark: SparkSession, d: str) -> DataFrame:
    return scan(spark, d).where(F.col("tokens").between(50, 8_500)).select("doc_id", "seq", "tokens")


@query(f"""
    with s as (select model, row_number() over (order by model) - 1 as position, count(*) over () as n from (select distinct fp.model || ' ' || run_id as model from card where fp.model is not null))
    select model, position from s where ((position - 3 * 16) % n + n) % n < least(16, n)
""")
def calibration_rotation(spark: SparkSession, d: str) -> DataFrame:
    shards = table(spark, d, "card").where("fp.model is not null").select(F.concat_ws(" ", "fp.model", "run_id").alias("model")).distinct()
    return sampling.rotating_subset(shards, "model", 3)


@query(f"""
    with q as (select c.doc_id, c.seq, c.run_id, u.i - 1 as quote, {STRIP.format('c.quotes[u.i].text')} as wanted, b.text from {FIRST_CARD} c, unnest(range(1, len(c.quotes) + 1)) as u(i), {FIRST_BLOCK} b where b.doc_id = c.doc_id and b.seq = c.seq)
    select doc_id, seq, run_id, quote::int as quote, (strpos(text, wanted) - 1)::int as span_start, (strpos(text, wanted) - 1 + length(wanted))::int as span_end from q where wanted <> '' and strpos(text, wanted) > 0
""")
def locate_quotes(spark: SparkSession, d: str) -> DataFrame:
    return spans.found_spans(spans.quotes_with_text(first_cards(spark, d), blocks(spark, d)))


# Quotes with the block they are from, and where they stand in it, word for word or by their words.
_LOCATED = f"""
    q as (select c.doc_id, c.seq, c.run_id, (u.i - 1)::int as quote, {STRIP.format('c.quotes[u.i].text')} as wanted, b.text from {FIRST_CARD} c join unnest(range(1, len(c.quotes) + 1)) as u(i) on true left join {FIRST_BLOCK} b on b.doc_id = c.doc_id and b.seq = c.seq),
    e as (select *, case when wanted <> '' and strpos(text, wanted) > 0 then wanted when wanted <> '' then nullif(regexp_extract(text, array_to_string(list_transform(string_split_regex(wanted, '{SPACE}+'), lambda w: regexp_escape(w)), '{SPACE}+'), 0, 'i'), '') end as hit from q),
    l as (select doc_id, seq, run_id, quote, (strpos(text, hit) - 1)::int as span_start, (strpos(text, hit) - 1 + length(hit))::int as span_end, case when hit = wanted then 'find' else 'whitespace' end as method from e where hit is not null)
"""


@query(f"with {_LOCATED} select * from l")
def located_spans(spark: SparkSession, d: str) -> DataFrame:
    return spans.located_spans(spans.quotes_with_text(first_cards(spark, d), blocks(spark, d)))


@query(f"""
    with {_LOCATED}, n as (select count(*) filter (text is not null) as quotes, count(*) filter (text is null) as unfetchable from q),
    m as (select count(*) as located, count(*) filter (method = 'find') as by_find, count(*) filter (method = 'whitespace') as by_whitespace from l)
    select *, quotes - located as unlocated, round(located / nullif(quotes, 0), 4)::double as located_rate from n, m
""")
def derivation_stats(spark: SparkSession, d: str) -> DataFrame:
    quotes = spans.quotes_with_text(first_cards(spark, d), blocks(spark, d))
    return spans.derivation_stats(quotes, spans.located_spans(quotes))


_inside = f"({STRIP.format('q')} <> '' and strpos(text, {STRIP.format('q')}) > 0)"
_loosely = f"({SQUASH.format('q')} <> '' and strpos({SQUASH.format('text')}, {SQUASH.format('q')}) > 0)"


@query(f"""
    with f as (select c.*, b.text from card c left join {FIRST_BLOCK} b on b.doc_id = c.doc_id and b.seq = c.seq),
    q as (select text, coalesce(u.x.text, '') as q, coalesce(u.x.span_start, -1) as s, coalesce(u.x.span_end, -1) as e from f, unnest(f.quotes) as u(x) where text is not null),
    k as (select case when s < 0 or e <= s then case when {_inside} then 'no_offset_hit' when {_loosely} then 'no_offset_norm' else 'no_offset_miss' end
        when substr(text, s + 1, e - s) = q or ({STRIP.format('q')} <> '' and {STRIP.format('substr(text, s + 1, e - s)')} = {STRIP.format('q')}) then 'exact'
        when {_inside} then 'substring' when {_loosely} then 'normalized' else 'miss' end as c from q),
    a as (select count(*) as quotes, count(*) filter (c = 'exact') as exact, count(*) filter (c = 'substring') as substring, count(*) filter (c = 'normalized') as normalized, count(*) filter (c = 'miss') as miss,
        count(*) filter (c = 'no_offset_hit') as no_offset_hit, count(*) filter (c = 'no_offset_norm') as no_offset_norm, count(*) filter (c = 'no_offset_miss') as no_offset_miss from k),
    m as (select case when u.x.span is null or u.x.span.span_start is null or u.x.span.span_end is null then 'absent' when u.x.span.span_start >= 0 and u.x.span.span_start < u.x.span.span_end and u.x.span.span_end <= length(text) then 'valid' else 'invalid' end as c
        from f, unnest(f.claims) as u(x) where text is not null),
    b as (select count(*) filter (c = 'valid') as claims_valid, count(*) filter (c = 'invalid') as claims_invalid, count(*) filter (c = 'absent') as claims_absent from m)
    select (select count(*) from f) as cards, (select count(*) from f where text is null) as unfetchable, a.*, b.*,
        round((exact + substring + normalized + no_offset_hit + no_offset_norm) / quotes, 4)::double as verified_rate, round(exact / quotes, 4)::double as exact_rate, round((miss + no_offset_miss) / quotes, 4)::double as unlocated_rate from a, b
""")
def fence_report(spark: SparkSession, d: str) -> DataFrame:
    return spans.fence_report(table(spark, d, "card"), blocks(spark, d)).drop("misses")


@query(f"""
    with q as (select c.doc_id, c.seq, u.i - 1 as quote, coalesce(c.quotes[u.i].text, '') as q, coalesce(c.quotes[u.i].span_start, -1) as s, coalesce(c.quotes[u.i].span_end, -1) as e, b.text from card c, unnest(range(1, len(c.quotes) + 1)) as u(i), {FIRST_BLOCK} b where b.doc_id = c.doc_id and b.seq = c.seq)
    select doc_id, seq, quote::int as quote, q as text, case when s < 0 or e <= s then 'no_offset_miss' else 'miss' end as class from q
    where not {_inside} and not {_loosely} and not (s >= 0 and e > s and (substr(text, s + 1, e - s) = q or ({STRIP.format('q')} <> '' and {STRIP.format('substr(text, s + 1, e - s)')} = {STRIP.format('q')})))
    order by doc_id, seq, quote, text limit 10
""")
def fence_misses(spark: SparkSession, d: str) -> DataFrame:
    m = spans.fence_report(table(spark, d, "card"), blocks(spark, d)).select(F.explode("misses").alias("m"))
    return m.select("m.doc_id", "m.seq", "m.quote", "m.text", F.col("m.c").alias("class"))


_TERMS = TERMS
_BM25 = f"""
    with t as (select doc_id, seq, {_TERMS} as ws from {FIRST_BLOCK} where text is not null), g as (select count(*) as total, avg(coalesce(len(ws), 0)) as mean from (select b.doc_id, t.ws from {FIRST_BLOCK} b left join t using (doc_id, seq))),
    o as (select doc_id, seq, len(ws) as n, <tf> from t), i as (select <idf> from o),
    h as (select * from o where <where>)
    select doc_id, seq, round(-(<score>), 6)::double as rank from h, g, i
"""


def _bm25(tfs: dict[str, str], where: str) -> str:
    names = list(tfs)
    score = " + ".join(f"greatest(ln((total - df_{k} + 0.5) / (df_{k} + 0.5)), 1e-6) * {k} * 2.2 / ({k} + 1.2 * (0.25 + 0.75 * n / mean))" for k in names)
    parts = {"<tf>": ", ".join(f"{e} as {k}" for k, e in tfs.items()), "<idf>": ", ".join(f"count(*) filter ({k} > 0) as df_{k}" for k in names), "<where>": where, "<score>": score}
    sql = _BM25
    for name, part in parts.items():
        sql = sql.replace(name, part)
    return sql


def _tf(word: str) -> str:
    return f"len(list_filter(ws, lambda w: w = '{word}'))"


def _ranked(spark: SparkSession, d: str, q: str) -> DataFrame:
    return search.ranked(blocks(spark, d), q).select("doc_id", "seq", F.round("rank", 6).alias("rank"))


@query(_bm25({"a": _tf("lantern"), "b": _tf("resume")}, "a > 0 or b > 0"))
def fts_search(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, "lantern OR resume")


@query(_bm25({"a": _tf("lantern"), "b": _tf("ridge")}, "a > 0 and b > 0"))
def fts_search_and(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, "lantern ridge")


@query(_bm25({"a": _tf("lantern"), "b": _tf("ridge")}, "a > 0 and not b > 0"))
def fts_search_not(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, "lantern NOT ridge")


@query(_bm25({"a": "len(list_filter(range(1, len(ws)), lambda i: ws[i] = 'ridge' and ws[i + 1] = 'path'))"}, "a > 0"))
def fts_phrase(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, '"ridge path"')


@query(_bm25({"a": "len(list_filter(ws, lambda w: starts_with(w, 'catalo')))"}, "a > 0"))
def fts_prefix(spark: SparkSession, d: str) -> DataFrame:
    return _ranked(spark, d, "catalo*")


@query(f"""
    with hits as (select * from ({_bm25({"a": _tf("boathouse"), "b": "len(list_filter(range(1, len(ws)), lambda i: ws[i] = 'ridge' and ws[i + 1] = 'path'))"}, "a > 0 or b > 0")}) order by rank, doc_id, seq limit 20),
    {_LOCATED.replace(FIRST_CARD, LAST_CARD)}, f as (select doc_id, seq, count(*) as n from l group by 1, 2)
    select h.doc_id, h.seq, h.rank, 'query' as matched_as, coalesce(split_part(d.path, '/', 1), '?') as project, coalesce(d.path, '?') as path, coalesce(d.year, 0) as year,
        (case when c.doc_id is null then 0 else coalesce(f.n, 0) end)::int as located, (len(c.quotes) - coalesce(f.n, 0))::int as withheld
    from hits h left join {LATEST_DOC} d on d.doc_id = h.doc_id left join {LAST_CARD} c on c.doc_id = h.doc_id and c.seq = h.seq left join f on f.doc_id = h.doc_id and f.seq = h.seq
""")
def fts_report(spark: SparkSession, d: str) -> DataFrame:
    r = search.report(blocks(spark, d), docs(spark, d), table(spark, d, "card"), 'boathouse OR "ridge path"', 20)
    return r.select("doc_id", "seq", F.round("rank", 6).alias("rank"), "matched_as", "project", "path", "year", F.size("quotes").alias("located"), "withheld")


@query()
def fts_snippets(spark: SparkSession, d: str) -> DataFrame:
    r = search.report(blocks(spark, d), docs(spark, d), table(spark, d, "card"), "NEAR(lantern ridge, 8) OR boathouse", 20)
    return r.select("doc_id", "seq", "topics", "quotes", "snippet")


def _stored(spark: SparkSession, d: str) -> search.StoredIndex:
    """The blocks' index below the shared folder, built by the first query of an application that asks for it."""
    known = hashlib.sha256(f"{d}|{spark.sparkContext.applicationId}".encode()).hexdigest()[:16]
    if known not in _folders:
        folder = f"{shared_folder(spark)}/search-{known}"
        search.StoredIndex(spark, folder).add(blocks(spark, d))
        _folders[known] = folder
    return search.StoredIndex(spark, _folders[known])


_folders: dict[str, str] = {}


@query(f"select (select count(*) from {FIRST_BLOCK}) as chunks, (select count(*) from (select distinct doc_id, seq, unnest({_TERMS}) as term from {FIRST_BLOCK} where text is not null)) as postings")
def fts_index(spark: SparkSession, d: str) -> DataFrame:
    return _stored(spark, d).counts()


@query(_bm25({"a": _tf("lantern"), "b": _tf("ridge")}, "a > 0 and not b > 0"))
def fts_stored(spark: SparkSession, d: str) -> DataFrame:
    return search.ranked(None, "lantern NOT ridge", _stored(spark, d).index()).select("doc_id", "seq", F.round("rank", 6).alias("rank"))


_set = lambda s, f: f"list_distinct({f.replace('<side>', s)})"
_fields = {
    "entities": f"list_transform(list_filter(coalesce(<side>.entities, []), lambda e: e.name is not null), lambda e: {SQUASH.format('e.name')})",
    "topics": f"list_transform(coalesce(<side>.topics, []), lambda t: {SQUASH.format('t')})",
    "claims": f"list_transform(coalesce(<side>.claims, []), lambda c: concat_ws('|', {SQUASH.format('c.subject')}, {SQUASH.format('c.predicate')}, c.polarity))",
}
_f1 = lambda f: f"case when len({_set('a', f)}) = 0 and len({_set('b', f)}) = 0 then null when len({_set('a', f)}) = 0 or len({_set('b', f)}) = 0 then 0 else 2.0 * len(list_intersect({_set('a', f)}, {_set('b', f)})) / (len({_set('a', f)}) + len({_set('b', f)})) end"
F1_SQL = f"""
    select doc_id, seq, round(entities, 6)::double as entities, round(topics, 6)::double as topics, round(claims, 6)::double as claims, round(coalesce(list_avg(list_filter([entities, topics, claims], lambda v: v is not null)), 1), 6)::double as score
    from (select a.doc_id, a.seq, {', '.join(f'({_f1(v)})::double as {k}' for k, v in _fields.items())} from {FIRST_CARD} a join {LAST_CARD} b using (doc_id, seq))
"""


@query(F1_SQL)
def set_f1(spark: SparkSession, d: str) -> DataFrame:
    r = lambda c: F.round(c, 6).alias(c)
    return scoring.compare_readings(first_cards(spark, d), last_cards(spark, d)).select("doc_id", "seq", r("entities"), r("topics"), r("claims"), r("score"))


@query(f"""
    with x as (select doc_id || '/' || seq as id, coalesce(usage_tokens.hit / nullif(usage_tokens.hit + usage_tokens.miss, 0), 0) as score from {FIRST_CARD}),
         y as (select doc_id || '/' || seq as id, coalesce(usage_tokens.out / nullif(usage_tokens.out + usage_tokens.miss, 0), 0) as score from {LAST_CARD}),
         p as (select count(*) as n, coalesce(stddev_samp(x.score - y.score) / sqrt(count(*)), 0) as se from x join y using (id)),
         r as (select *, abs(mean1 - mean2) as gap, greatest(0.05, 2 * se) as tol from (select avg(score) as mean1 from x), (select avg(score) as mean2 from y), p)
    select n, round(mean1, 6)::double as mean1, round(mean2, 6)::double as mean2, round(gap, 6)::double as gap, round(se, 6)::double as se, round(tol, 6)::double as tol, gap <= tol as same, round(gap / nullif(se, 0), 4)::double as t from r
""")
def paired_stability(spark: SparkSession, d: str) -> DataFrame:
    share = lambda a: F.coalesce(F.col(f"usage_tokens.{a}") / F.nullif(F.col(f"usage_tokens.{a}") + F.col("usage_tokens.miss"), F.lit(0)), F.lit(0.0)).alias("score")
    key = F.concat_ws("/", "doc_id", F.col("seq").cast("string")).alias("id")
    return scoring.stability(first_cards(spark, d).select(key, share("hit")), last_cards(spark, d).select(key, share("out")))


@query("""
    with t as (select count(*) as calls, sum(greatest(coalesce(usage_tokens.hit, 0), 0))::bigint as hit, sum(greatest(coalesce(usage_tokens.miss, 0), 0))::bigint as miss, sum(greatest(coalesce(usage_tokens.out, 0), 0))::bigint as "out" from card)
    select *, round((miss * 0.14 + hit * 0.0028 + "out" * 0.28) / 1e6, 6)::double as usd, round(hit / (hit + miss), 4)::double as hit_rate, 0::bigint as reasoning from t
""")
def meter_usage(spark: SparkSession, d: str) -> DataFrame:
    return scoring.meter(table(spark, d, "card"))


@query(f"""
    with t as (select count(*) as rows, sum(tokens)::bigint as tokens from {ROWS}), u as (select *, floor(tokens * 0.46) as hit from t)
    select rows, tokens, round((tokens * 0.14 + rows * 2600 * 0.28) / 1e6, 6)::double as worst_usd, round(((tokens - hit) * 0.14 + hit * 0.0028 + rows * 2600 * 0.28) / 1e6, 6)::double as realistic_usd, (tokens * 0.14 + rows * 2600 * 0.28) / 1e6 > 1.0 as refused from u
""")
def cost_gate(spark: SparkSession, d: str) -> DataFrame:
    return scoring.gate(scan(spark, d), 1.0)


@query("""
    with b as (select distinct doc_id, seq from text_block), c as (select distinct doc_id, seq from card)
    select (select count(*) from b) as chunks, (select count(*) from b join c using (doc_id, seq)) as carded, round(100.0 * (select count(*) from b join c using (doc_id, seq)) / (select count(*) from b), 2)::double as coverage_pct,
        (select count(*) from card where usage_tokens.hit >= 0.75 * (usage_tokens.hit + usage_tokens.miss)) as prefix_hits,
        (select round(count(*) filter (usage_tokens.hit >= 0.75 * (usage_tokens.hit + usage_tokens.miss)) / count(*), 4)::double from card where usage_tokens.hit + usage_tokens.miss > 0) as prefix_efficiency,
        (select round(sum(usage_tokens.hit) / sum(usage_tokens.hit + usage_tokens.miss), 4)::double from card) as hit_share
""")
def read_report(spark: SparkSession, d: str) -> DataFrame:
    keys = table(spark, d, "text_block").select("doc_id", "seq").distinct().join(table(spark, d, "card").select("doc_id", "seq").distinct().withColumn("c", F.lit(True)), ["doc_id", "seq"], "left")
    n = keys.agg(F.count(F.lit(1)).alias("chunks"), F.count_if("c").alias("carded"))
    hit, whole = F.col("usage_tokens.hit"), F.col("usage_tokens.hit") + F.col("usage_tokens.miss")
    hits = table(spark, d, "card").agg(F.count_if(hit >= 0.75 * whole).alias("prefix_hits"), F.round(F.count_if((whole > 0) & (hit >= 0.75 * whole)) / F.count_if(whole > 0), 4).alias("prefix_efficiency"), F.round(F.sum(hit) / F.sum(whole), 4).alias("hit_share"))
    return n.join(hits).select("chunks", "carded", F.round(100.0 * F.col("carded") / F.col("chunks"), 2).alias("coverage_pct"), "prefix_hits", "prefix_efficiency", "hit_share")


@query(f"select doc_id, seq, batch * 48 as position from (select doc_id, seq, row_number() over (order by project nulls first, doc_id, seq) - 1 as place, (row_number() over (order by project nulls first, doc_id, seq) - 1) // 48 as batch from {ROWS}) where place % 48 = 0")
def every_nth(spark: SparkSession, d: str) -> DataFrame:
    return sampling.every_nth(scan(spark, d), ["project", "doc_id", "seq"], 48).select("doc_id", "seq", "position")


@query(f"select doc_id, seq, {ESTIMATE.format('text')} as tokens from {FIRST_BLOCK} where contains(lower(text), 'lantern') order by tokens desc, doc_id, seq limit 6")
def supporting(spark: SparkSession, d: str) -> DataFrame:
    rows = blocks(spark, d).select("doc_id", "seq", "text", tx.estimate_tokens(F.col("text")).alias("tokens"))
    return scoring.supporting(rows, "Lantern").select("doc_id", "seq", "tokens")


@query("select doc_id, seq, greatest(1, coalesce(length(text), 0) // 4)::bigint as usage from text_block")
def usage_estimates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "text_block").select("doc_id", "seq", scoring.usage_estimate(F.col("text")).alias("usage"))


@query("select event_id, user_id, (props::json->>'$.k')::bigint as k from events where props is not null and json_valid(props) and json_type(props) = 'OBJECT' and user_id is not null")
def json_tolerant_props(spark: SparkSession, d: str) -> DataFrame:
    rows = tolerant(table(spark, d, "events"), "props", "k bigint", keep=("event_id", "user_id"))
    return rows.where("user_id is not null")


@query("""
    with r as (select event_id as i, sha256(coalesce(props, '') || event_type) as h from (select row_number() over (order by event_id) - 1 as event_id, props, event_type from events))
    select i, sha256(coalesce(lag(h) over (order by i), '') || h) as link from r
""")
def chain_links(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("event_id", F.concat(F.coalesce("props", F.lit("")), "event_type").alias("body"))
    n = sampling.numbered(e, ["event_id"]).select(F.col("position").alias("i"), "body")
    return tape.broken_links(n)


@query("select event_id, year(ts)::int as year, strftime(ts, '%Y-%m-%dT%H:%M:%S') as iso, ((hour(ts) * 60 + minute(ts) + 480) % 1440) between 540 and 719 or ((hour(ts) * 60 + minute(ts) + 480) % 1440) between 840 and 1079 as peak from events")
def event_times(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, d, "events").select("event_id", F.year(ts).alias("year"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), scoring.in_windows(ts, [(540, 720), (840, 1080)]).alias("peak"))


@query(f"select event_type, window_start, count(*) as n, round(sum(value), 4)::double as total from (select event_type, value, date_trunc('hour', ts) as window_start from events) group by all")
def incremental_index(spark: SparkSession, d: str) -> DataFrame:
    from ..streaming.incremental import hourly_counts

    return hourly_counts(spark, f"{d}/events.parquet")
