"""An append-only record log: hash-chained JSON lines in segments with a checkpoint."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.hashing import GENESIS, NotCanonical, chain_hash
from ..session import on_workers

# Fixed values of the log format: kinds of records, and below the names of files, fields and of the lock.
KINDS = ("doc", "text", "journal", "contact")
SEGMENT_BYTES = 64 * 1024 * 1024


class TapeError(Exception):
    """The log is damaged or was used against its rules."""


class Tape:
    """Writer and snapshot reader of one log folder; the control plane, whose appends are sequential by nature."""

    def __init__(self, folder: str | os.PathLike, readonly: bool = False, segment_bytes: int = SEGMENT_BYTES):
        self.folder, self.readonly, self.segment_bytes = Path(folder), readonly, segment_bytes
        self.head, self.count, self.segments = GENESIS, 0, []
        lock = self.folder / "tape.lock"
        if lock.exists():
            state = json.loads(lock.read_text("utf-8"))
            self.head, self.count, self.segments = state["head"], state["count"], state["segments"]
        if not readonly:
            self.folder.mkdir(parents=True, exist_ok=True)
            self._recover()

    def _path(self, name: str) -> Path:
        return self.folder / name

    def _recover(self) -> None:
        """Take over whole records behind the checkpoint and cut one torn last line; anything else is damage."""
        known = {s["name"] for s in self.segments}
        for path in sorted(self.folder.glob("seg-*.jsonl")):
            if path.name not in known:
                self.segments.append({"name": path.name, "first_i": self.count, "count": 0, "bytes": 0})
        if not self.segments:
            return
        last = self.segments[-1]
        path = self._path(last["name"])
        if path.stat().st_size < last["bytes"]:
            raise TapeError(f"{last['name']} is shorter than its checkpoint says")
        with path.open("rb") as f:
            f.seek(last["bytes"])
            rest = f.read()
        good = 0
        for line in rest.splitlines(keepends=True):
            if not line.endswith(b"\n"):
                break
            try:
                record = json.loads(line)
                if record["i"] != self.count or chain_hash(self.head, {k: v for k, v in record.items() if k != "h"}) != record["h"]:
                    raise TapeError(f"record {self.count} doesn't follow the one before")
            except (ValueError, KeyError, TypeError) as e:
                raise TapeError(f"record {self.count} behind the checkpoint is damaged") from e
            self.head, self.count, good = record["h"], self.count + 1, good + len(line)
            last["count"] += 1
        if good < len(rest):
            with path.open("r+b") as f:
                f.truncate(last["bytes"] + good)
        if good:
            last["bytes"] += good
            self._checkpoint()

    def _checkpoint(self) -> None:
        new = self.folder / "tape.lock.new"
        with new.open("w", encoding="utf-8") as f:
            json.dump({"head": self.head, "count": self.count, "segment_max_bytes": self.segment_bytes, "segments": self.segments}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(new, self.folder / "tape.lock")

    def append(self, records: Iterable[tuple[str, dict]]) -> int:
        """Append (kind, body) pairs as one batch, which is never split over segments; returns the count after it."""
        if self.readonly:
            raise TapeError("the log was opened for reading")
        lines, head, i = [], self.head, self.count
        for kind, body in records:
            if kind not in KINDS:
                raise TapeError(f"unknown kind {kind!r}")
            record = {"i": i, "kind": kind, "ts": datetime.now(UTC).isoformat(timespec="milliseconds"), "body": body}
            head = chain_hash(head, record)
            lines.append(json.dumps(record | {"h": head}, ensure_ascii=False).encode("utf-8") + b"\n")
            i += 1
        if not lines:
            return self.count
        if not self.segments or self.segments[-1]["bytes"] >= self.segment_bytes:
            self.segments.append({"name": f"seg-{len(self.segments):06d}.jsonl", "first_i": self.count, "count": 0, "bytes": 0})
        last = self.segments[-1]
        with self._path(last["name"]).open("ab") as f:
            f.write(b"".join(lines))
            f.flush()
            os.fsync(f.fileno())
        last["bytes"] += sum(map(len, lines))
        last["count"] += len(lines)
        last["tail_h"], self.head, self.count = head, head, i
        self._checkpoint()
        return self.count


def read_tape(spark: SparkSession, folder: str, kinds: Iterable[str] | None = None) -> DataFrame:
    """(segment, i, kind, ts, body, h, line): the acknowledged records, body as JSON; a log that isn't there is empty."""
    tape = Tape(folder, readonly=True)
    schema = "i bigint, kind string, ts string, h string"
    if not tape.segments:
        return spark.createDataFrame([], f"segment string, {schema}, body string, line string")
    lines = spark.read.text([str(Path(folder) / s["name"]) for s in tape.segments]).select(F.col("value").alias("line"), F.element_at(F.split(F.input_file_name(), "/"), -1).alias("segment"))
    fields = F.from_json("line", schema)
    rows = lines.select("segment", fields.alias("r"), F.get_json_object("line", "$.body").alias("body"), "line").select("segment", "r.*", "body", "line")
    rows = rows.where(F.col("i").isNull() | (F.col("i") < tape.count))
    return rows.where(F.col("kind").isin(*kinds)) if kinds else rows


def verify_tape(spark: SparkSession, folder: str) -> DataFrame:
    """(i, problem) of the first record in each segment that breaks the chain, in order; empty for a whole log.

    Each record is hashed against the digest stored with the one before it in the file, at a segment's start
    against the tail of the segment before from the checkpoint; so segments are checked side by side, each,
    bounded by its size, in one task. A record's place is its line's, whatever number it claims. Lines behind
    the acknowledged count are not looked at.
    """
    tape = Tape(folder, readonly=True)
    schema = "i bigint, problem string"
    if not tape.segments:
        return spark.createDataFrame([], schema)
    parts = [(s["name"], s["first_i"], s["count"], tape.segments[k - 1].get("tail_h") if k else GENESIS, tape.head if s is tape.segments[-1] else s.get("tail_h")) for k, s in enumerate(tape.segments)]
    known = spark.createDataFrame(parts, "segment string, first_i bigint, count bigint, before string, tail string")
    files = spark.read.format("binaryFile").load([str(Path(folder) / p[0]) for p in parts]).select(F.element_at(F.split("path", "/"), -1).alias("segment"), "content")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [first_break(bytes(c or b"").splitlines(), int(i), int(n), before, tail) for i, n, before, tail, c in zip(b["first_i"], b["count"], b["before"], b["tail"], b["content"], strict=True)]
            yield pd.DataFrame([f for f in found if f], columns=["i", "problem"])

    # The checkpoint's list is of one row for each segment file.
    return on_workers(F.broadcast(known).join(files, "segment", "left").drop("segment")).mapInPandas(check, schema).orderBy("i")


def first_break(lines: list[bytes], first_i: int, count: int, before: str | None, tail: str | None) -> tuple[int, str] | None:
    """(i, problem) of the first of a segment's `count` acknowledged lines that doesn't continue the chain from `before` to `tail`."""
    for i, line in enumerate(lines[:count], first_i):
        try:
            record = json.loads(line)
        except ValueError:
            return i, "unparseable"
        if not isinstance(record, dict) or "h" not in record:
            return i, "not a record"
        if record.get("i") != i:
            return i, "index mismatch"
        try:
            if chain_hash(before or "", {k: v for k, v in record.items() if k != "h"}) != record["h"]:
                return i, "hash mismatch"
        except NotCanonical:
            return i, "unhashable"
        before = record["h"]
    if len(lines) < count:
        return first_i + len(lines), "missing"
    return None if tail is None or before == tail else (first_i + count, "checkpoint mismatch")


def broken_links(rows: DataFrame, segment_rows: int = 1_000) -> DataFrame:
    """(i, link): sha256 of each row's body behind the digest of the row before it; rows are (i, body), i from 0 without gaps.

    Rows are cut into segments by i; the row before a segment's first is fetched by a join, so no window
    runs over the whole table.
    """
    r = rows.withColumn("d", F.sha2(F.coalesce("body", F.lit("")), 256)).withColumn("segment", F.floor(F.col("i") / segment_rows))
    tails = r.where((F.col("i") + 1) % segment_rows == 0).select((F.col("segment") + 1).alias("segment"), F.col("d").alias("tail"))
    inside = Window.partitionBy("segment").orderBy("i")
    joined = r.join(tails, "segment", "left").withColumn("before", F.coalesce(F.lag("d").over(inside), F.col("tail"), F.lit("")))
    return joined.select("i", F.sha2(F.concat("before", "d"), 256).alias("link"))
