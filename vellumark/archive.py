"""An archive as a folder: a manifest, Parquet tables, and the verbs that work on them."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import estimate_tokens, record_header
from .operators import catalog, census, charter, extract, neardup, sampling, search, spans, tape
from .session import cut
from .sources import files, manifest

TABLES = {
    "doc": "doc_id string, root string, path string, source string, content_b2 string, size bigint, mtime timestamp, year int, modality string, n_texts int, chars bigint, tokens_est bigint, taped_at timestamp",
    "text_block": "doc_id string, seq int, text string, chars int, tokens_est bigint, taped_at timestamp",
    "journal": "run_id string, event string, root string, path string, reason string, ref string, jaccard double, size bigint, mtime timestamp, at timestamp",
    "signature": "doc_id string, place struct<taped_at:timestamp,doc_id:string>, sig array<bigint>",
    "card": f"doc_id string, seq int, run_id string, {extract.CARD}, usage_tokens {extract.USAGE}, model string, read_at timestamp",
    "quarantine": "doc_id string, seq int, run_id string, reason string",
    "span": "doc_id string, seq int, run_id string, quote int, span_start int, span_end int, method string",
    "vectors": "doc_id string, seq int, dim int, vec array<float>, model string",
}


#: What makes two events of the journal one.
EVENT = ("event", "root", "path", "reason", "size", "mtime")


class Archive:
    """Every table is appended to in whole files; a verb that is run again skips what is done.

    The manifest and the charter are small files in `folder`; the tables may be in any folder that Spark reaches.
    """

    def __init__(self, spark: SparkSession, folder: str, tables: str | None = None):
        self.spark, self.folder, self.tables = spark, Path(folder), (tables or str(Path(folder) / "tables")).rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A table, empty before its first row."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.tables}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.tables}/{name}") if there else self.spark.createDataFrame([], TABLES[name])

    def _append(self, name: str, rows: DataFrame, mode: str = "append") -> None:
        columns = [c.strip().split(" ")[0] for c in _top_level(TABLES[name])]
        rows.select(*columns).write.mode(mode).parquet(f"{self.tables}/{name}")

    def _roots(self) -> tuple[manifest.Manifest, list[tuple[str, str]]]:
        m = manifest.load(self.folder)
        return m, [(str((self.folder / r["path"]).resolve()), r.get("label") or r["path"]) for r in m.roots]

    def plan(self) -> DataFrame:
        """What an intake would meet: files, size and rough tokens by extension."""
        m, roots = self._roots()
        listed = reduce(DataFrame.unionByName, [files.list_files(self.spark, path, label).drop("content") for path, label in roots])
        return census.plan_census(listed.where(sampling.path_matches(F.col("path"), list(m.include), list(m.exclude)) == "admitted"))

    def intake(self) -> DataFrame:
        """Read new and changed files into documents and blocks; returns the completeness by state.

        Files that were seen as they are, by size and time, aren't opened again. Documents whose text is like
        an earlier one's are flagged in the journal and kept.
        """
        run = uuid.uuid4().hex[:12]
        m, roots = self._roots()
        known, journal = self.table("doc"), self.table("journal")
        seen_before = known.select("root", "path", "size", "mtime").unionByName(journal.where("size is not null").select("root", "path", "size", "mtime")).distinct()
        fresh_files = reduce(DataFrame.unionByName, [files.changed_files(self.spark, path, label, seen_before) for path, label in roots])
        states, blocks = files.ingest(fresh_files, list(m.include), list(m.exclude), owners=census.content_owners(known))
        states = cut(states)
        fresh = catalog.still_to_do(states.where("state = 'doc'"), known, ["doc_id"])
        sized = blocks.withColumn("tokens_est", estimate_tokens(F.col("text")))
        sums = sized.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_texts"), F.sum("tokens_est").alias("tokens_est"))
        now = F.current_timestamp()
        docs = cut(
            fresh.join(sums, "doc_id", "left").select(
                "doc_id", "root", "path", F.col("root").alias("source"), "content_b2", "size", "mtime", "year", "modality", F.coalesce("n_texts", F.lit(0)).alias("n_texts"), "chars", F.coalesce("tokens_est", F.lit(0)).alias("tokens_est"), now.alias("taped_at")
            )
        )
        # Blocks first: a document counts as done once its row is there; blocks of a run that broke off aren't written twice.
        mine = sized.join(docs.select("doc_id"), "doc_id", "left_semi").withColumn("taped_at", now)
        self._append("text_block", catalog.still_to_do(mine, self.table("text_block")))
        whole = mine.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda b: b["text"]), "").alias("text"))  # a file's own blocks
        signed = cut(neardup.signed_texts(whole.join(docs.select("doc_id", "taped_at"), "doc_id"), ["taped_at"], whole=False))
        like = neardup.earlier_like(signed, self.table("signature").unionByName(signed))
        flags = like.join(docs.select("doc_id", "root", "path"), "doc_id").select(F.lit(run).alias("run_id"), F.lit("near_dup").alias("event"), "root", "path", F.lit(None).cast("string").alias("reason"), F.col("other").alias("ref"), "jaccard", F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("mtime"), now.alias("at"))
        self._append("journal", flags)
        self._append("signature", signed)
        self._append("doc", docs)
        facts = fresh_files.select("root", "path", "size", "mtime").distinct()
        events = states.drop("size", "mtime").where("state != 'doc'").join(facts, ["root", "path"]).select(F.lit(run).alias("run_id"), F.col("state").alias("event"), "root", "path", "reason", "ref", F.lit(None).cast("double").alias("jaccard"), "size", "mtime", now.alias("at"))
        old = journal.select(*[F.col(c).alias(f"o_{c}") for c in EVENT]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in EVENT])
        self._append("journal", events.join(old, same, "left_anti"))
        return census.completeness(census.path_states(self.table("doc"), self.table("journal").where("event != 'near_dup'")), "doc")

    def state(self) -> DataFrame:
        """(doc_id, blocks, last_seq, chars) of documents that a run which broke off left without a row."""
        return census.partial_docs(self.table("text_block"), self.table("doc"))

    def status(self) -> DataFrame:
        """(kind, label, n): documents by modality, journal by event, and how many blocks, cards and vectors there are."""
        def n(name: str, label) -> DataFrame:
            return self.table(name).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("kind"), "label", "n")

        every = F.lit("all")
        partial = self.state().groupBy(every.alias("label")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("partial").alias("kind"), "label", "n")
        return partial.unionByName(n("doc", F.col("modality"))).unionByName(n("journal", F.col("event"))).unionByName(n("text_block", every)).unionByName(n("card", every)).unionByName(n("quarantine", every)).unionByName(n("vectors", every))

    def contact_sheet(self) -> DataFrame:
        return census.contact_sheet(catalog.latest_docs(self.table("doc")))

    def rows(self) -> DataFrame:
        """Chunks with their size, year and project, for sampling and reading."""
        docs = catalog.latest_docs(self.table("doc")).select("doc_id", "year", catalog.project_of(F.col("path")).alias("project"), "modality")
        return self.table("text_block").select("doc_id", "seq", F.col("tokens_est").alias("tokens"), F.col("chars").cast("bigint").alias("chars")).join(docs, "doc_id")

    def discover(self, budget: int | None = None, seed: str = "7") -> DataFrame:
        """A stratified sample of chunks of usable size, within a budget that follows the archive's tokens."""
        rows = self.rows().where(F.col("tokens").between(50, 8_500))
        whole = budget or rows.agg(sampling.sample_budget(F.coalesce(F.sum("tokens"), F.lit(0)))).first()[0]
        return sampling.stratified_sample(rows, int(whole), seed)

    def propose(self, names: list[str]) -> dict[str, str]:
        return charter.propose(self.folder, names)

    def freeze(self, stable: bool, roster: str | None = None) -> dict[str, str]:
        return charter.freeze(self.folder, stable, roster)

    def _chosen(self, projects: list[str] | None, max_tokens: int) -> DataFrame:
        chosen = self.rows()
        if projects:
            chosen = chosen.where(sampling.project_matches(F.col("project"), projects))
        chosen = sampling.within_budget(chosen, max_tokens)
        return chosen.join(self.table("text_block").select("doc_id", "seq", "text"), ["doc_id", "seq"]).withColumn("header", record_header(F.col("doc_id"), F.col("year"), F.col("project"), F.col("seq"))).select("doc_id", "seq", "header", "text")

    def dry_run(self, projects: list[str] | None = None, max_tokens: int = 0, cap: float = 1.0) -> DataFrame:
        """What reading would do and cost; nothing is called."""
        return extract.dry_run(self._chosen(projects, max_tokens), catalog.done_keys(self.table("card"), self.table("quarantine")), cap=cap)

    def read(self, provider: extract.Provider, projects: list[str] | None = None, max_tokens: int = 0, retry_quarantined: bool = False, **rules) -> int:
        """Read chunks that have no card, into cards and quarantine; returns the number of batches."""
        run = uuid.uuid4().hex[:12]
        # Only cards count as done where what is in quarantine is to be tried again.
        done = catalog.done_keys(*([self.table("card")] if retry_quarantined else [self.table("card"), self.table("quarantine")]))

        def save(batch: DataFrame) -> None:
            stamped = batch.withColumn("run_id", F.lit(run)).withColumn("read_at", F.current_timestamp())
            self._append("quarantine", stamped.where("reason is not null"))
            self._append("card", stamped.where("reason is null"))

        return extract.reading_pass(self._chosen(projects, max_tokens), cut(done), provider, save, **rules)

    def fence(self, derive: bool = False, limit: int | None = None) -> DataFrame:
        """How well quotes and claims hold against their text; with `derive` the located spans are written too."""
        blocks = self.table("text_block")
        if derive:
            self._append("span", spans.located_spans(spans.quotes_with_text(self.table("card"), blocks)), "overwrite")
        return spans.fence_report(self.table("card"), blocks, limit)

    def query(self, terms: str | None = None, limit: int = 5) -> DataFrame:
        """The best blocks for a search, or without terms a summary of the cards."""
        if terms is None:
            return catalog.card_summary(catalog.first_per_key(self.table("card").withColumn("fp", F.struct("model", F.lit(None).cast("string").alias("charter_root"))), ["doc_id", "seq"], ["read_at"]))
        return search.report(self.table("text_block"), catalog.latest_docs(self.table("doc")), self.table("card"), terms, limit, self.index())

    def index(self) -> search.Index:
        """The stored index of carded blocks and all others, brought up to date."""
        store = search.StoredIndex(self.spark, f"{self.tables}/index")
        store.add(catalog.first_per_key(self.table("text_block"), ["doc_id", "seq"], ["taped_at"]))
        return store.index() or search.index_of(self.table("text_block"))

    def vectors(self, embed, model: str) -> DataFrame:
        """Embed carded chunks that have no vector yet; returns those that have none now, and why."""
        carded = catalog.fetch(self.table("card").select("doc_id", "seq"), self.table("text_block"))
        found = cut(extract.backfill_vectors(carded, self.table("vectors"), embed, model))
        self._append("vectors", found.where("vec is not null"))
        return found.where("vec is null").select("doc_id", "seq", "reason")

    def export_tape(self, folder: str, batch: int = 10_000) -> int:
        """Write documents and blocks as a hash-chained log, streamed through the driver since a chain is sequential."""
        log = tape.Tape(folder)
        part: list[tuple[str, dict]] = []
        for name, kind in (("text_block", "text"), ("doc", "doc")):
            for row in self.table(name).drop("taped_at").orderBy("doc_id").toJSON().toLocalIterator():
                part.append((kind, json.loads(row)))
                if len(part) >= batch:
                    log.append(part)
                    part = []
        return log.append(part)


def _top_level(schema: str) -> list[str]:
    """The columns of a schema, without those inside structs."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            out.append(schema[at:i])
            at = i + 1
    return [*out, schema[at:]]
