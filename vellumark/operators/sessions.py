"""Transcripts of chat sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import with_sorted_rank

#: Lines of one part of a transcript; a session of any length is a number of parts.
PART_LINES = 500


def content_words(content):
    """The words of a message: plain text as it is, of a JSON list the texts of its items of type text, by line."""
    listed = content.rlike(r"^\s*\[") & F.try_parse_json(content).isNotNull()
    items = F.from_json(F.when(listed, content), "array<struct<type:string,text:string>>")
    texts = F.transform(F.filter(items, lambda i: (i["type"] == "text") & i["text"].isNotNull()), lambda i: i["text"])
    return F.when(listed, F.array_join(texts, "\n")).otherwise(F.coalesce(content, F.lit("")))


def transcripts(lines: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
    """(session_id, part, lines, transcript): what was said in a session, tagged by speaker, in parts of `part_lines`.

    Summaries, user and assistant lines speak; lines without words, other kinds and repeated rows don't.
    Order is by ts, then line_no; the place of a line in its session is found range by range, however many lines a moment has.
    """
    distinct = lines.select("session_id", "line_no", "line_type", "role", "content", "ts").distinct()
    words = content_words(F.col("content"))
    bare = F.regexp_replace(words, r"^[ \t\n\r]+|[ \t\n\r]+$", "")
    said = F.when(F.col("line_type") == "summary", F.concat(F.lit("SUMMARY: "), words)).when(F.col("line_type") == "user", F.concat(F.lit("USER: "), bare)).when(F.col("line_type") == "assistant", F.concat(F.lit("ASSISTANT: "), bare))
    spoken = distinct.select("session_id", "ts", "line_no", F.md5(F.coalesce("content", F.lit(""))).alias("m"), said.alias("said"), bare.alias("bare")).where("said is not null and bare <> ''").drop("bare")
    placed = with_sorted_rank(spoken, ["session_id"], ["ts", "line_no", "m"], "place")
    parts = placed.groupBy("session_id", F.floor(F.col("place") / part_lines).alias("part")).agg(F.count(F.lit(1)).alias("lines"), F.array_sort(F.collect_list(F.struct("place", "said"))).alias("s"))
    return parts.select("session_id", "part", "lines", F.array_join(F.col("s.said"), "\n\n").alias("transcript"))


def years(lines: DataFrame) -> DataFrame:
    """(session_id, year): the first year from 1990 to 2100 in which something was said."""
    said = lines.where(F.col("line_type").isin("user", "assistant") & F.year("ts").between(1990, 2100))
    return said.groupBy("session_id").agg(F.min(F.year("ts")).alias("year"))
