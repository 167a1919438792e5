"""Queries: censuses, reconciliations, duplicates and keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import estimate_tokens
from ..operators import catalog, census, neardup, search
from ..operators.ranking import with_sorted_rank
from ..operators.sampling import path_matches, project_matches
from ..session import table
from .catalogue import query

# The latest row of each document, the first of each block, the first and last of each card, in SQL.
LATEST_DOC = "(select * from doc qualify row_number() over (partition by doc_id order by taped_at desc) = 1)"
FIRST_BLOCK = "(select * from text_block qualify row_number() over (partition by doc_id, seq order by tape_i) = 1)"
FIRST_CARD = "(select * from card qualify row_number() over (partition by doc_id, seq order by read_at) = 1)"
LAST_CARD = "(select * from card qualify row_number() over (partition by doc_id, seq order by read_at desc) = 1)"
ESTIMATE = "floor(len(regexp_extract_all({0}, '[\\x{{3000}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]')) + (length({0}) - len(regexp_extract_all({0}, '[\\x{{3000}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]'))) / 4)::bigint"


TERMS = f"list_filter(string_split_regex(translate(regexp_replace(lower(text), '\\p{{M}}', '', 'g'), '{search.MARKED}', '{search.UNMARKED}'), '[^\\p{{L}}\\p{{N}}\\p{{M}}]+'), lambda w: w <> '')"


def docs(spark: SparkSession, d: str) -> DataFrame:
    return catalog.latest_docs(table(spark, d, "doc"))


def blocks(spark: SparkSession, d: str) -> DataFrame:
    return catalog.distinct_blocks(table(spark, d, "text_block"))


def first_cards(spark: SparkSession, d: str) -> DataFrame:
    return catalog.first_per_key(table(spark, d, "card"), ["doc_id", "seq"], ["read_at"])


def last_cards(spark: SparkSession, d: str) -> DataFrame:
    return catalog.last_per_key(table(spark, d, "card"), ["doc_id", "seq"], ["read_at"])


@query(f"""
    select year, case when grouping(source) = 1 and grouping(year) = 1 then '*' else source end as source,
           case when grouping(modality) = 1 and grouping(year) = 1 then '*' else modality end as modality,
           count(*) as files, sum(chars)::bigint as chars, sum(tokens_est)::bigint as tokens_est
    from {LATEST_DOC} group by grouping sets ((year, source, modality), ())
""")
def contact_sheet(spark: SparkSession, d: str) -> DataFrame:
    return census.contact_sheet(docs(spark, d).select("year", "source", "modality", "chars", "tokens_est"))


@query("""
    select 'doc' as kind, modality as label, count(*) as n from doc group by modality
    union all select 'text', case when text is null or text = '' then 'empty' else 'full' end, count(*) from text_block group by 2
    union all select 'line', line_type, count(*) from session_line group by line_type
    union all select 'card', run_id, count(*) from card group by run_id
    union all select 'last', modality, count(*) from doc where taped_at = (select max(taped_at) from doc) group by modality
""")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    def n(t: str, kind: str, label) -> DataFrame:
        return table(spark, d, t).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "label", "n")

    newest = F.broadcast(table(spark, d, "doc").agg(F.max("taped_at").alias("newest")))  # one row
    last = table(spark, d, "doc").join(newest).where("taped_at = newest").groupBy(F.col("modality").alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("last").alias("kind"), "label", "n")
    empty = F.when(F.col("text").isNull() | (F.col("text") == ""), "empty").otherwise("full")
    return n("doc", "doc", F.col("modality")).unionByName(n("text_block", "text", empty)).unionByName(n("session_line", "line", F.col("line_type"))).unionByName(n("card", "card", F.col("run_id"))).unionByName(last)


@query(f"""
    select lower(regexp_extract(path, '[^/]\\.([^./]+)$', 1)) as ext, count(*) as files, round(sum(greatest(size, 0)) / 1e6, 6)::double as mb,
           floor(sum(case when lower(regexp_extract(path, '[^/]\\.([^./]+)$', 1)) in ({', '.join(repr(x) for x in [*census.EXTENSIONS['text'], 'jsonl'])}) then greatest(size, 0) else 0 end) / 4)::bigint as tokens
    from {LATEST_DOC} group by 1
""")
def plan_census(spark: SparkSession, d: str) -> DataFrame:
    return census.plan_census(docs(spark, d))


@query(f"select doc_id, {ESTIMATE.format('text')} as tokens from documents")
def token_estimate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", estimate_tokens(F.col("text")).alias("tokens"))


@query(f"""
    select doc_id, case when ref <> doc_id then ref end as ref, case when ref <> doc_id then 'dedup' else 'admitted' end as state
    from (select doc_id, first_value(doc_id) over (partition by content_b2 order by case modality when 'text' then 0 when 'pdf' then 1 when 'image' then 2 else 3 end, root, path, doc_id) as ref from {LATEST_DOC})
""")
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    lane = F.when(F.col("modality") == "text", 0).when(F.col("modality") == "pdf", 1).when(F.col("modality") == "image", 2).otherwise(3)
    return census.exact_duplicates(docs(spark, d).withColumn("lane", lane), "content_b2", ["lane", "root", "path"])


@query("""
    select doc_id, case when ref <> doc_id then ref end as ref, case when ref <> doc_id then 'dedup' else 'admitted' end as state
    from (select doc_id, case when text is null then doc_id else min(doc_id) over (partition by text) end as ref from documents)
""")
def exact_dedup_texts(spark: SparkSession, d: str) -> DataFrame:
    texts = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))
    return census.exact_duplicates(texts, "sha", ["doc_id"])


# Distinct texts by their smallest key, their word shingles, and all pairs that share one, in SQL.
_PAIRS = """
    w as (select min(doc_id) as rep, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') as ws from documents where text is not null group by text),
    s as (select distinct rep, array_to_string(ws[i:i+4], ' ') as s from w, unnest(range(1, len(ws) - 3)) as r(i) where len(ws) >= 5),
    n as (select rep, count(*) as n from s group by rep),
    j as (select x.rep as a, y.rep as b, count(*) as both_n from s x join s y on x.s = y.s and x.rep < y.rep group by 1, 2),
    p as (select a, b, both_n / (na.n + nb.n - both_n) as jaccard from j join n na on na.rep = a join n nb on nb.rep = b where both_n / (na.n + nb.n - both_n) >= 0.6)
"""


@query(f"with {_PAIRS} select a, b, round(jaccard, 6)::double as jaccard from p")
def near_dup_exact(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.similar_texts(neardup.text_classes(table(spark, d, "documents")), least=0.6)
    return pairs.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query(f"with {_PAIRS} select a, b, round(jaccard, 6)::double as jaccard from p where jaccard >= 0.8")
def near_dup_strict(spark: SparkSession, d: str) -> DataFrame:
    pairs = neardup.similar_texts(neardup.text_classes(table(spark, d, "documents")))
    return pairs.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


@query(f"""
    with recursive {_PAIRS}, e as (select a, b from p union select b, a from p),
    walk as (select a as u, a as v from e union select walk.u, e.b from walk join e on e.a = walk.v),
    roots as (select u, min(v) as root from walk group by u),
    links as (select a as u, count(*) as links from e group by a),
    r as (select doc_id, min(doc_id) over (partition by text) as rep from documents where text is not null)
    select doc_id, coalesce(root, rep) as class_id, coalesce(links, 0) as links from r left join roots on roots.u = rep left join links on links.u = rep
""")
def near_dup_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.duplicate_classes(table(spark, d, "documents"), least=0.6)


@query()
def near_dup_minhash(spark: SparkSession, d: str) -> DataFrame:
    return neardup.flagged(table(spark, d, "documents"), ["taped_at"])


@query(f"""
    select doc_id, case when lower(split_part(path, '/', 1)) in ('tape', 'runs', 'catalog', 'codex', 'certificate') then 'internal'
        when not regexp_matches(path, '(?i)^(?:.*/)?[^/]*\\.(?:md|txt|pdf|docx|jsonl)$') then 'not_included'
        when regexp_matches(path, '(?i)^(?:.*/)?[^/]*-scans/.*$') then 'excluded' else 'admitted' end as state
    from {LATEST_DOC}
""")
def glob_filter(spark: SparkSession, d: str) -> DataFrame:
    state = path_matches(F.col("path"), ["**/*.md", "**/*.txt", "**/*.PDF", "*.docx", "**/*.jsonl"], ["**/*-scans/**"])
    return docs(spark, d).select("doc_id", state.alias("state"))


@query(f"select doc_id, split_part(path, '/', 1) as project from {LATEST_DOC} where regexp_matches(lower(split_part(path, '/', 1)), '^(?:.*-notes|[a-m].*)$')")
def project_filter(spark: SparkSession, d: str) -> DataFrame:
    project = catalog.project_of(F.col("path"))
    return docs(spark, d).where(project_matches(project, ["*-NOTES", "[a-m]*"])).select("doc_id", project.alias("project"))


@query(f"""
    select doc_id, case ext when 'jsonl' then 'session' when 'pdf' then 'pdf' when 'docx' then 'docx' else
        case when ext in ({', '.join(map(repr, census.EXTENSIONS['text']))}) then 'text' when ext in ({', '.join(map(repr, census.EXTENSIONS['image']))}) then 'image'
             when ext in ({', '.join(map(repr, census.EXTENSIONS['av']))}) then 'av' else 'unsupported_modality' end end as modality
    from (select doc_id, lower(regexp_extract(path, '[^/]\\.([^./]+)$', 1)) as ext from {LATEST_DOC})
""")
def route_modality(spark: SparkSession, d: str) -> DataFrame:
    return docs(spark, d).select("doc_id", census.modality(F.col("path")).alias("modality"))


@query("""
    with s as (select case when a.doc_id is null then 'new_since' when b.doc_id is null then 'vanished' else 'both' end as state
               from (select distinct doc_id from doc) a full join (select distinct doc_id from text_block) b using (doc_id))
    select state, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 2)::double as pct from s group by state
""")
def reconcile_states(spark: SparkSession, d: str) -> DataFrame:
    return census.completeness(census.reconcile(table(spark, d, "doc"), table(spark, d, "text_block")))


@query("select doc_id, count(*) as blocks, max(seq) as last_seq, sum(c)::bigint as chars from (select doc_id, seq, max(coalesce(length(text), 0)) as c from text_block where doc_id not in (select doc_id from doc) group by 1, 2) group by 1")
def resume_partials(spark: SparkSession, d: str) -> DataFrame:
    return census.partial_docs(table(spark, d, "text_block"), table(spark, d, "doc"))


@query("select content_b2, doc_id from doc where content_b2 is not null qualify row_number() over (partition by content_b2 order by taped_at, doc_id) = 1")
def content_owners(spark: SparkSession, d: str) -> DataFrame:
    return census.content_owners(table(spark, d, "doc"))


@query("""
    with e as (select distinct root, path from doc where modality = 'audio' or path like '%.pdf'), l as (select distinct root, path from doc where not (path like '%.md'))
    select root, path, case when (root, path) in (select (root, path) from l) then 'doc' else 'seen' end as state from (select * from e union select * from l)
""")
def path_states(spark: SparkSession, d: str) -> DataFrame:
    all_docs = table(spark, d, "doc")
    events = all_docs.where("modality = 'audio' or path like '%.pdf'").select("root", "path", F.lit("seen").alias("event"), F.col("taped_at").alias("at"))
    return census.path_states(all_docs.where("path not like '%.md'"), events)


@query("""
    with b as (select distinct root, path from doc where year < 2022), a as (select distinct root, path from doc where year > 2012), e as (select distinct root, path from doc where modality <> 'text'),
         s as (select coalesce(b.root, a.root) as root, coalesce(b.path, a.path) as path, (coalesce(b.root, a.root), coalesce(b.path, a.path)) in (select (root, path) from e) as told, case when a.path is null then 'vanished' when b.path is null then 'new_since' when (b.root, b.path) not in (select (root, path) from e) then 'unaccounted' else 'both' end as state from b full join a on a.root = b.root and a.path = b.path)
    select count(*) filter (state <> 'new_since') as files, count(*) filter (told and state <> 'new_since') as classified, count(*) filter (state = 'new_since') as n_new_since, count(*) filter (state = 'vanished') as n_vanished, count(*) filter (state = 'unaccounted') as n_unaccounted,
        round(100.0 * count(*) filter (told and state <> 'new_since') / count(*) filter (state <> 'new_since'), 2)::double as completeness_pct from s
""")
def reconciliation(spark: SparkSession, d: str) -> DataFrame:
    all_docs = table(spark, d, "doc")
    # Two listings at different times, and the files of which something is known.
    r = census.reconciliation(all_docs.where("year < 2022"), all_docs.where("year > 2012"), all_docs.where("modality <> 'text'").withColumn("state", F.lit("doc")))
    return r.drop("new_since", "vanished", "unaccounted")


@query(f"""
    select t.doc_id, t.seq, {ESTIMATE.format('t.text')} as tokens, length(t.text)::bigint as chars, d.year, split_part(d.path, '/', 1) as project, d.modality
    from {FIRST_BLOCK} t join {LATEST_DOC} d using (doc_id)
""")
def scan_rows(spark: SparkSession, d: str) -> DataFrame:
    meta = docs(spark, d).select("doc_id", "year", catalog.project_of(F.col("path")).alias("project"), "modality")
    sized = blocks(spark, d).select("doc_id", "seq", estimate_tokens(F.col("text")).alias("tokens"), F.char_length("text").cast("bigint").alias("chars"))
    return sized.join(meta, "doc_id")


@query("select doc_id, seq from (select distinct doc_id, seq from text_block) where (doc_id, seq) not in (select (doc_id, seq) from card where doc_id is not null and seq is not null)")
def todo_antijoin(spark: SparkSession, d: str) -> DataFrame:
    return catalog.still_to_do(table(spark, d, "text_block").select("doc_id", "seq").distinct(), catalog.done_keys(table(spark, d, "card")))


@query("select doc_id, seq from card union select doc_id, seq from vectors where vec is not null")
def done_keys(spark: SparkSession, d: str) -> DataFrame:
    return catalog.done_keys(table(spark, d, "card"), table(spark, d, "vectors").where("vec is not null"))


@query("select distinct doc_id, seq from card c where not exists (select 1 from vectors v where v.doc_id = c.doc_id and v.seq = c.seq and v.vec is not null)")
def vector_backfill_todo(spark: SparkSession, d: str) -> DataFrame:
    have = table(spark, d, "vectors").where("vec is not null").select("doc_id", "seq")
    return catalog.still_to_do(table(spark, d, "card").select("doc_id", "seq").distinct(), have)


@query(f"""
    select (select count(distinct (doc_id, seq)) from text_block) as chunks, (select sum(len(list_distinct({TERMS}))) from {FIRST_BLOCK})::bigint as postings, (select count(*) from vectors) as vectors, (select count(*) from card) as cards,
           greatest(0, (select count(*) from card) - (select count(*) from vectors)) as vectors_missing
""")
def index_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.index_counts(table(spark, d, "text_block").select("doc_id", "seq").distinct(), search.postings(blocks(spark, d)), table(spark, d, "vectors"), table(spark, d, "card"))


@query(f"select doc_id, seq, run_id, len(quotes)::int as quotes from {FIRST_CARD}")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    return first_cards(spark, d).select("doc_id", "seq", "run_id", F.size("quotes").alias("quotes"))


@query(f"select doc_id, seq, run_id, len(quotes)::int as quotes from {LAST_CARD}")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    return last_cards(spark, d).select("doc_id", "seq", "run_id", F.size("quotes").alias("quotes"))


@query(f"""
    select *, greatest(models, charters) > 1 as mixed, round(quotes / cards, 2)::double as quotes_a_card, round(claims / cards, 2)::double as claims_a_card, round(entities / cards, 2)::double as entities_a_card,
        (select count(distinct year) from {LATEST_DOC} where doc_id in (select doc_id from {FIRST_CARD})) as years, (select count(distinct split_part(path, '/', 1)) from {LATEST_DOC} where doc_id in (select doc_id from {FIRST_CARD})) as projects
    from (select count(*) as cards, sum(len(coalesce(quotes, [])))::bigint as quotes, sum(len(coalesce(claims, [])))::bigint as claims, sum(len(coalesce(entities, [])))::bigint as entities,
                 count(distinct run_id) as runs, count(distinct fp.model) as models, count(distinct fp.charter_root) as charters from {FIRST_CARD})
""")
def catalog_summary(spark: SparkSession, d: str) -> DataFrame:
    s = catalog.card_summary(first_cards(spark, d), docs(spark, d).select("doc_id", "path", "year"))
    return s.withColumns({"models": F.size("models").cast("bigint"), "years": F.size("years").cast("bigint")})


@query(f"""
    select term, count(*) as n from (select t.topic as term, read_at, doc_id, seq from {FIRST_CARD} c, unnest(c.topics) as t(topic)) where term is not null
    group by term order by n desc, min((read_at, doc_id, seq)), term limit 10
""")
def catalog_top_topics(spark: SparkSession, d: str) -> DataFrame:
    items = first_cards(spark, d).select(F.struct("read_at", "doc_id", "seq").alias("place"), F.explode("topics").alias("term"))
    return catalog.top_terms(items, "term", "place", 10)


@query(f"""
    select term, count(*) as n from (select u.e.name as term, read_at, doc_id, seq from {FIRST_CARD} c, unnest(c.entities) as u(e)) where term is not null
    group by term order by n desc, min((read_at, doc_id, seq)), term limit 10
""")
def catalog_top_entities(spark: SparkSession, d: str) -> DataFrame:
    items = first_cards(spark, d).select(F.struct("read_at", "doc_id", "seq").alias("place"), F.explode("entities").alias("e")).select("place", F.col("e.name").alias("term"))
    return catalog.top_terms(items, "term", "place", 10)


@query(f"select u.e.kind as kind, count(*) as n from {FIRST_CARD} c, unnest(c.entities) as u(e) group by 1")
def entity_kinds(spark: SparkSession, d: str) -> DataFrame:
    return first_cards(spark, d).select(F.explode("entities").alias("e")).groupBy(F.col("e.kind").alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select lower(k.c.subject) as subject, k.c.predicate as predicate, k.c.polarity as polarity, count(*) as n, round(avg(k.c.confidence), 6)::double as confidence from {FIRST_CARD} d, unnest(d.claims) as k(c) group by all")
def claim_terms(spark: SparkSession, d: str) -> DataFrame:
    c = first_cards(spark, d).select(F.explode("claims").alias("c"))
    return c.groupBy(F.lower("c.subject").alias("subject"), F.col("c.predicate").alias("predicate"), F.col("c.polarity").alias("polarity")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("c.confidence"), 6).alias("confidence"))


@query("select left(split_part(notes, ':', 1), 60) as reason, count(*) as n from card where notes is not null group by 1")
def quarantine_histogram(spark: SparkSession, d: str) -> DataFrame:
    return catalog.reasons(table(spark, d, "card"), "notes")


@query("select count(distinct (year, project)) as cells, min(year) as first_year, max(year) as last_year from (select distinct year, project from rec_row where year is not null and project is not null)")
def distinct_cells(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "rec_row").where("year is not null and project is not null")
    return r.agg(F.count_distinct("year", "project").alias("cells"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query("select event_type, event_id, ts, value from events qualify row_number() over (partition by event_type order by ts desc, event_id desc) = 1")
def last_event(spark: SparkSession, d: str) -> DataFrame:
    return catalog.last_per_key(table(spark, d, "events").select("event_type", "event_id", "ts", "value"), ["event_type"], ["ts", "event_id"])


@query(f"""
    with a as (select doc_id, sum({ESTIMATE.format('text')}) as n from {FIRST_BLOCK} group by 1), b as (select doc_id, tokens_est as n from {LATEST_DOC})
    select round(avg(a / b), 4)::double as ratio, count(*) as docs from (select a.n as a, b.n as b from a join b using (doc_id) where a.n > 0 and b.n > 0 order by doc_id limit 10)
""")
def census_cross_check(spark: SparkSession, d: str) -> DataFrame:
    ours = blocks(spark, d).groupBy("doc_id").agg(F.sum(estimate_tokens(F.col("text"))).alias("n"))
    return census.census_ratio(ours, docs(spark, d).select("doc_id", F.col("tokens_est").alias("n")))


@query("select session_id, line_no, row_number() over (partition by session_id order by ts, line_no, ingested_at) - 1 as place from session_line")
def session_places(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "session_line").select("session_id", "line_no", "ts", "ingested_at")
    return with_sorted_rank(lines, ["session_id"], ["ts", "line_no", "ingested_at"], "place").select("session_id", "line_no", "place")
