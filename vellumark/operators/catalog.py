"""Keyed tables of the archive: which row of a key counts, lookups, what is left to do, and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import reason_prefix


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in `order`; aggregated map-side, so a hot key costs no more than others."""
    return _one_per_key(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in `order`."""
    return _one_per_key(df, keys, order, F.max_by)


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    told = [F.col(f.name) for f in df.schema.fields if f.name in rest and "map<" not in f.dataType.simpleString()] or [F.lit(0)]
    # Rows equal in `order` are told apart by all they hold, so that the choice is the same every time.
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order, F.xxhash64(*told))).alias("__row"))
    return picked.select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def latest_docs(doc: DataFrame) -> DataFrame:
    """One row per document: what was emitted last."""
    return last_per_key(doc, ["doc_id"], ["taped_at"])


def distinct_blocks(text_block: DataFrame) -> DataFrame:
    """One row per (doc_id, seq): what was taped first."""
    return first_per_key(text_block, ["doc_id", "seq"], ["tape_i"])


def project_of(path: Column) -> Column:
    """The first segment of a path; of a file at the top its name."""
    return F.split_part(path, F.lit("/"), F.lit(1))


def done_keys(*tables: DataFrame, keys: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """Keys that occur in any of the tables."""
    whole = tables[0].select(*keys)
    for t in tables[1:]:
        whole = whole.unionByName(t.select(*keys))
    return whole.distinct()


def still_to_do(wanted: DataFrame, done: DataFrame, keys: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """Rows of `wanted` whose key isn't done; what makes a second run skip the first one's work."""
    return wanted.join(done.select(*keys), list(keys), "left_anti")


def fetch(keys: DataFrame, table: DataFrame, on: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """Rows of `table` for a set of keys; keys it doesn't know have no row."""
    return table.join(keys.select(*on).distinct(), list(on), "left_semi")


def insert_new(table: DataFrame, rows: DataFrame, order: Sequence[str], keys: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """Table and rows together, where a key that is there already keeps its row; of new rows of one key the first in `order` counts."""
    return table.unionByName(still_to_do(first_per_key(rows, keys, order), table, keys))


def upsert(table: DataFrame, rows: DataFrame, order: Sequence[str], keys: Sequence[str] = ("doc_id", "seq")) -> DataFrame:
    """Table and rows together, where a new row replaces the one of its key; of new rows of one key the last in `order` counts."""
    return still_to_do(table, rows, keys).unionByName(last_per_key(rows, keys, order))


def top_terms(items: DataFrame, term: str, first: str, k: int) -> DataFrame:
    """(term, n) of the k most frequent terms, of equals the one seen first, then the smaller."""
    counted = items.where(F.col(term).isNotNull()).groupBy(term).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("__first"))
    return counted.orderBy(F.desc("n"), "__first", term).limit(k).select(term, "n")


def card_summary(cards: DataFrame, docs: DataFrame | None = None) -> DataFrame:
    """One row: how many cards, quotes, claims and entities, how many on average, over how many runs, by which models and charters.

    The models are listed, and `mixed` says whether there are several readers. With `docs` (doc_id, path, year)
    also the years, in order, and how many projects. Lists are as long as there are models and years.
    """
    n = lambda c: F.sum(F.greatest(F.size(c), F.lit(0))).cast("bigint")
    whole = cards.agg(
        F.count(F.lit(1)).alias("cards"), n("quotes").alias("quotes"), n("claims").alias("claims"), n("entities").alias("entities"),
        F.count_distinct("run_id").alias("runs"), F.array_sort(F.collect_set("fp.model")).alias("models"), F.count_distinct("fp.charter_root").alias("charters"),
    )
    mean = lambda c: F.round(F.col(c) / F.when(F.col("cards") > 0, F.col("cards")), 2).alias(f"{c}_a_card")
    row = whole.select("*", (F.greatest(F.size("models"), "charters") > 1).alias("mixed"), mean("quotes"), mean("claims"), mean("entities"))
    if docs is None:
        return row
    known = cards.select("doc_id").distinct().join(docs, "doc_id").agg(F.array_sort(F.collect_set("year")).alias("years"), F.count_distinct(project_of(F.col("path"))).alias("projects"))
    return row.join(F.broadcast(known))  # one row each


def reasons(quarantine: DataFrame, reason: str = "reason") -> DataFrame:
    """(reason, n): rows by what their reason says before its colon."""
    return quarantine.where(F.col(reason).isNotNull()).groupBy(reason_prefix(F.col(reason)).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def index_counts(chunks: DataFrame | None, postings: DataFrame | None, vectors: DataFrame | None, cards: DataFrame) -> DataFrame:
    """One row of counts; a table that isn't there counts as null, not as 0."""
    rows = cards.agg(F.count(F.lit(1)).alias("cards"))
    for name, t in (("chunks", chunks), ("postings", postings), ("vectors", vectors)):
        rows = rows.withColumn(name, F.lit(None).cast("bigint")) if t is None else rows.join(F.broadcast(t.agg(F.count(F.lit(1)).alias(name))))
    return rows.select("chunks", "postings", "vectors", "cards", F.greatest(F.lit(0), F.col("cards") - F.col("vectors")).alias("vectors_missing") if vectors is not None else F.lit(None).cast("bigint").alias("vectors_missing"))
