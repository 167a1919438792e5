"""Canonical JSON, blake2b digests and hash chains."""

from __future__ import annotations

import hashlib
import json
import math
import unicodedata
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import worker_udf

GENESIS = "0" * 32


class NotCanonical(ValueError):
    """A value that has no canonical JSON."""


def _plain(value: Any) -> Any:
    if value is None or isinstance(value, bool | int):
        return value
    if isinstance(value, str):
        return unicodedata.normalize("NFC", value)
    if isinstance(value, float):
        if not math.isfinite(value):
            raise NotCanonical("a number that isn't finite")
        return value
    if isinstance(value, list | tuple):
        return [_plain(v) for v in value]
    if isinstance(value, dict):
        if not all(isinstance(k, str) for k in value):
            raise NotCanonical("a key that is no string")
        out = {unicodedata.normalize("NFC", k): _plain(v) for k, v in value.items()}
        if len(out) < len(value):
            raise NotCanonical("keys that differ in form alone")
        return out
    raise NotCanonical(f"a value of type {type(value).__name__}")


def canonical_json(value: Any) -> bytes:
    """JSON with composed strings, keys in order of code points, no spaces and nothing escaped that needn't be."""
    return json.dumps(_plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode("utf-8")


def canonical(row: Column) -> Column:
    """Canonical JSON of a struct column; null of null."""

    @worker_udf(T.StringType())
    def written(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([None if r is None else canonical_json(r).decode("utf-8") for r in rows["row"].map(json.loads, na_action="ignore")])

    return written(F.struct(F.to_json(row, {"ignoreNullFields": "false"}).alias("row")))


def chained(before: Column, record: Column) -> Column:
    """The chain's digest of a record (canonical JSON) behind the digest before it."""

    @worker_udf(T.StringType())
    def hashed(befores: pd.Series, records: pd.Series) -> pd.Series:
        return pd.Series([chain_hash(b, json.loads(r)) for b, r in zip(befores, records, strict=True)])

    return hashed(before, record)


def digest(data: bytes, size: int = 16) -> str:
    return hashlib.blake2b(data, digest_size=size).hexdigest()


def chain_hash(before: str, record: dict) -> str:
    """Digest of a record in its chain: of the digest before it and its canonical JSON."""
    if len(before) != 32 or set(before) - set("0123456789abcdef"):
        raise NotCanonical("the digest before is no 32 hexadecimal digits")
    return digest(before.encode("ascii") + canonical_json(record))


def document_id(root: str, path: str, content: str) -> str:
    return digest(canonical_json({"_": "doc-id-v1", "root": root, "path": path, "content": content}))


def blake2b(data: Column, size: int = 16) -> Column:
    """Hexadecimal blake2b digest of a binary or string column; null of null."""

    @worker_udf(T.StringType())
    def hashed(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else digest(v.encode("utf-8") if isinstance(v, str) else bytes(v), size))

    return hashed(data)
