"""Censuses and reconciliations of an archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Extensions by modality.
EXTENSIONS = {
    "text": (
        "txt md markdown rst org tex log csv tsv json jsonl ndjson yaml yml toml ini cfg conf xml html htm css py js ts jsx tsx java c h cpp hpp cs go rs rb php sh bat cmd ps1 sql r lua pl swift kt srt vtt eml"
    ).split(),
    "pdf": ["pdf"],
    "docx": ["docx"],
    "image": "png jpg jpeg gif bmp tif tiff webp".split(),
    "av": "mp3 wav m4a flac ogg aac opus wma mp4 mov mkv avi webm m4v wmv".split(),
}


def contact_sheet(docs: DataFrame) -> DataFrame:
    """Files, characters and estimated tokens by (year, source, modality), and one row '*' for all; in order, that row last."""
    g = docs.groupingSets([("year", "source", "modality"), ()], "year", "source", "modality").agg(
        F.grouping_id().alias("__level"), F.count(F.lit(1)).alias("files"), F.sum("chars").alias("chars"), F.sum("tokens_est").alias("tokens_est")
    )
    star = lambda c: F.when(F.col("__level") > 0, "*").otherwise(F.col(c)).alias(c)
    return g.orderBy("__level", "year", "source", "modality").select("year", star("source"), star("modality"), "files", "chars", "tokens_est")


def extension(path):
    """The extension of a path in lower case, empty where there is none."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


def modality(path, sniffed=None):
    """Modality by extension; of unknown ones what `sniffed` (is it text?) says, else 'unsupported_modality'."""
    ext = extension(path)
    by = F.when(ext == "jsonl", "session")
    for name, known in EXTENSIONS.items():
        by = by.when(ext.isin(known), name)
    return by.when(sniffed, "text").otherwise("unsupported_modality") if sniffed is not None else by.otherwise("unsupported_modality")


def plan_census(files: DataFrame) -> DataFrame:
    """(ext, files, mb, tokens): what a pass over files would meet; sizes below 0 count as 0, tokens only for text."""
    size = F.greatest("size", F.lit(0))
    ext = extension(F.col("path"))
    tokens = F.sum(F.when(ext.isin([*EXTENSIONS["text"], "jsonl"]), size).otherwise(0))
    return files.groupBy(ext.alias("ext")).agg(F.count(F.lit(1)).alias("files"), F.round(F.sum(size) / 1e6, 6).alias("mb"), F.floor(tokens / 4).cast("bigint").alias("tokens"))


def reconcile(before: DataFrame, after: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys and state: 'both', 'vanished' (only before) or 'new_since' (only after)."""
    a = before.select(*keys).distinct().withColumn("__a", F.lit(True))
    b = after.select(*keys).distinct().withColumn("__b", F.lit(True))
    state = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "vanished").otherwise("new_since")
    return a.join(b, list(keys), "full").select(*keys, state.alias("state"))


def completeness(states: DataFrame, done: str = "both") -> DataFrame:
    """(state, n, pct): the histogram of states, with each one's share of all; 100 per cent of nothing has no row."""
    n = states.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    return n.join(F.broadcast(n.agg(F.sum("n").alias("__all")))).select("state", "n", F.round(100.0 * F.col("n") / F.col("__all"), 2).alias("pct"))


def reconciliation(before: DataFrame, after: DataFrame, events: DataFrame, most: int = 50) -> DataFrame:
    """One row on two listings (root, path) and what became of the files (root, path, state): completeness and what differs.

    Files that are in both listings but of which no event tells are unaccounted. completeness_pct is the
    share of the first listing's files that have a state, 100 where it is empty. Lists hold `most` paths, in order.
    """
    key = ["root", "path"]
    state = reconcile(before, after, tuple(key))
    told = events.select(*key).distinct().withColumn("__told", F.lit(True))
    named = state.join(told, key, "left").withColumn("state", F.when((F.col("state") == "both") & F.col("__told").isNull(), "unaccounted").otherwise(F.col("state")))
    # Each task keeps its first paths of each kind, so the lists stay short however many files differ.
    place = F.row_number().over(Window.partitionBy("state").orderBy(*key))
    lists = named.where("state != 'both'").withColumn("r", place).where(F.col("r") <= most)
    one = lambda s: F.coalesce(F.array_sort(F.collect_list(F.when(F.col("state") == s, F.col("path")))), F.expr("array()")).alias(s)
    n = named.agg(F.count_if(F.col("state") != "new_since").alias("files"), F.count_if(F.col("__told") & (F.col("state") != "new_since")).alias("classified"), *[F.count_if(F.col("state") == s).alias(f"n_{s}") for s in ("new_since", "vanished", "unaccounted")])
    pct = F.when(F.col("files") == 0, 100.0).otherwise(F.round(100.0 * F.col("classified") / F.col("files"), 2)).alias("completeness_pct")
    return n.select("*", pct).join(F.broadcast(lists.agg(*map(one, ("new_since", "vanished", "unaccounted")))))  # one row each


def partial_docs(text_block: DataFrame, doc: DataFrame) -> DataFrame:
    """(doc_id, blocks, last_seq, chars): documents of which blocks were written but no row, so that a rerun goes on behind the last block."""
    cuts = text_block.join(doc.select("doc_id").distinct(), "doc_id", "left_anti").groupBy("doc_id", "seq").agg(F.max(F.char_length("text")).alias("c"))
    return cuts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"), F.max("seq").alias("last_seq"), F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("chars"))


def content_owners(doc: DataFrame) -> DataFrame:
    """(content_b2, doc_id): the first document taped with each content, which later copies refer to."""
    return doc.where(F.col("content_b2").isNotNull()).groupBy("content_b2").agg(F.min_by("doc_id", F.struct("taped_at", "doc_id")).alias("doc_id"))


def path_states(doc: DataFrame, events: DataFrame) -> DataFrame:
    """(root, path, state) of every file ever seen: doc once there was a document of it, else the last event (root, path, event, at)."""
    last = events.groupBy("root", "path").agg(F.max_by("event", F.struct("at", "event")).alias("event"))
    known = doc.select("root", "path").distinct().withColumn("doc", F.lit(True))
    return last.join(known, ["root", "path"], "full").select("root", "path", F.when(F.col("doc"), "doc").otherwise(F.col("event")).alias("state"))


def exact_duplicates(docs: DataFrame, content: str, order: list[str], key: str = "doc_id") -> DataFrame:
    """(key, ref, state): 'admitted' for the first of equal contents in `order`, 'dedup' with its key as `ref` else.

    Null contents are never equal. The first is found by an aggregation that combines map-side and joined
    back by content, so a content that a third of all rows share is no window of its own.
    """
    first = docs.where(F.col(content).isNotNull()).groupBy(content).agg(F.min_by(key, F.struct(*order, key)).alias("__first"))
    joined = docs.join(first, content, "left")
    other = F.col("__first").isNotNull() & (F.col("__first") != F.col(key))
    return joined.select(key, F.when(other, F.col("__first")).alias("ref"), F.when(other, "dedup").otherwise("admitted").alias("state"))


def census_ratio(ours: DataFrame, theirs: DataFrame, first: int = 10) -> DataFrame:
    """Mean ratio of two counts (doc_id, n) over the first documents that have both, as a cross-check; null without any."""
    a, b = ours.select("doc_id", F.col("n").alias("a")), theirs.select("doc_id", F.col("n").alias("b"))
    head = a.join(b, "doc_id").where((F.col("a") > 0) & (F.col("b") > 0)).orderBy("doc_id").limit(first)
    return head.agg(F.round(F.avg(F.col("a") / F.col("b")), 4).alias("ratio"), F.count(F.lit(1)).alias("docs"))
