"""Queries: the record log, keyed lookups and upserts, decoding, extraction and indexes that grow."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing
from ..functions import text as tx
from ..operators import catalog, extract, provider, sampling, tape
from ..session import shared_folder, table
from ..streaming.incremental import keep_index, read_index, stream_of
from .catalogue import query
from .census import FIRST_BLOCK, FIRST_CARD, LAST_CARD, blocks, first_cards, last_cards


@query("select kind, count(*) as records, 0::bigint as problems from (select 'doc' as kind from doc union all select 'journal' from card where notes is not null) group by kind")
def tape_verify(spark: SparkSession, d: str) -> DataFrame:
    """The rows of two tables written as a log, read back by kind, and verified; the log is written by the driver, as a chain is sequential."""
    folder = f"{shared_folder(spark).removeprefix('file://')}/tape-{uuid.uuid4().hex}"
    log = tape.Tape(folder, segment_bytes=64 * 1024)
    for kind, rows in (("doc", table(spark, d, "doc").select("doc_id", "path", "size")), ("journal", table(spark, d, "card").where("notes is not null").select("doc_id", "seq", "notes"))):
        part: list[tuple[str, dict]] = []
        for row in rows.toJSON().toLocalIterator():
            part.append((kind, json.loads(row)))
            if len(part) == 1_000:
                log.append(part)
                part = []
        log.append(part)
    read = tape.read_tape(spark, folder, ["doc", "journal"]).groupBy("kind").agg(F.count(F.lit(1)).alias("records"))
    bad = tape.verify_tape(spark, folder).agg(F.count(F.lit(1)).alias("problems"))
    return read.join(F.broadcast(bad))  # one row


@query("""
    select doc_id, md5('{"modality":' || coalesce(to_json(nfc_normalize(modality))::varchar, 'null') || ',"n_texts":' || coalesce(n_texts::varchar, 'null') || ',"path":' || coalesce(to_json(nfc_normalize(path))::varchar, 'null') || ',"year":' || coalesce(year::varchar, 'null') || '}') as digest from doc
""")
def canonical_json(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "doc").select("doc_id", F.md5(hashing.canonical(F.struct("year", "path", "n_texts", "modality"))).alias("digest"))


@query()
def chain_hash(spark: SparkSession, d: str) -> DataFrame:
    """Digests of documents' records behind the record before them, as a log would have them; blake2b has no SQL."""
    placed = sampling.numbered(table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"])
    body = placed.select("position", "doc_id", hashing.canonical(F.struct("doc_id", "n_chars")).alias("body"))
    before = body.select((F.col("position") + 1).alias("position"), hashing.blake2b(F.col("body")).alias("before"))
    linked = body.join(before, "position", "left")
    return linked.select("doc_id", hashing.chained(F.coalesce("before", F.lit(hashing.GENESIS)), F.col("body")).alias("h"))


@query(f"select t.doc_id, t.seq, length(t.text)::bigint as chars from {FIRST_BLOCK} t where (t.doc_id, t.seq) in (select (doc_id, seq) from card)")
def fetch_texts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.fetch(table(spark, d, "card").select("doc_id", "seq"), blocks(spark, d)).select("doc_id", "seq", F.char_length("text").cast("bigint").alias("chars"))


@query(f"select doc_id, seq, run_id from {LAST_CARD}")
def upsert_cards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "card").select("doc_id", "seq", "run_id", "read_at")
    return catalog.upsert(first_cards(spark, d).select("doc_id", "seq", "run_id", "read_at"), rows, ["read_at"]).select("doc_id", "seq", "run_id")


@query(f"select doc_id, seq, run_id from (select doc_id, seq, run_id from {LAST_CARD} where seq = 0 union all select doc_id, seq, run_id from {FIRST_CARD} where seq <> 0)")
def insert_cards(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "card").select("doc_id", "seq", "run_id", "read_at")
    return catalog.insert_new(last_cards(spark, d).select("doc_id", "seq", "run_id", "read_at").where("seq = 0"), rows, ["read_at"]).select("doc_id", "seq", "run_id")


@query("select doc_id, md5(text) as digest, case when text is not null then 'utf-8' end as encoding, case when text is not null then not contains(text, chr(0)) end as sniffed from documents")
def decode_ladder(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "documents").select("doc_id", F.encode("text", "utf-8").alias("raw"))
    return raw.select("doc_id", tx.decoded(F.col("raw")).alias("t"), tx.sniffed(F.col("raw")).alias("sniffed")).select("doc_id", F.md5("t.text").alias("digest"), "t.encoding", "sniffed")


@query("select doc_id, seq, tape_i from text_block qualify row_number() over (partition by doc_id, seq order by tape_i desc) = 1")
def keyed_stream(spark: SparkSession, d: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}"
    keep_index(stream_of(spark, f"{d}/text_block.parquet").select("doc_id", "seq", "tape_i"), f"{folder}/index", f"{folder}/stream", ["tape_i"])
    return read_index(spark, f"{folder}/index")


@query(f"select doc_id, seq, case when text is null then 'text_missing' end as reason from {FIRST_BLOCK}")
def read_cards(spark: SparkSession, d: str) -> DataFrame:
    chunks = blocks(spark, d).select("doc_id", "seq", F.lit("").alias("header"), "text")
    return extract.read_chunks(chunks, provider.make_provider("rules")).select("doc_id", "seq", "reason")


@query(f"select count(*) as rows, sum(tokens)::bigint as tokens from (select floor(len(regexp_extract_all(coalesce(text, ''), '[\\x{{3000}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]')) + (length(coalesce(text, '')) - len(regexp_extract_all(coalesce(text, ''), '[\\x{{3000}}-\\x{{9FFF}}\\x{{F900}}-\\x{{FAFF}}]'))) / 4) as tokens from {FIRST_BLOCK} where (doc_id, seq) not in (select (doc_id, seq) from card))")
def read_dry_run(spark: SparkSession, d: str) -> DataFrame:
    chunks = blocks(spark, d).select("doc_id", "seq", F.lit("").alias("header"), "text")
    return extract.dry_run(chunks, table(spark, d, "card")).select("rows", "tokens")
