"""Every core query that has SQL against that SQL, over the whole smallest tables."""

import datetime
import decimal
from pathlib import Path

import duckdb
import pytest

from vellumark import plans
from vellumark.functions import hashing
from vellumark.operators import neardup
from vellumark.plans.catalogue import QUERIES, SQL

plans.load()


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in Path(data).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_agrees_with_sql(spark, duck, data, name):
    df = QUERIES[name](spark, data)
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall()), key=repr)
    assert ours == theirs


def test_all_others_are_compared_below():
    assert set(QUERIES) - set(SQL) == {"chain_hash", "fts_snippets", "near_dup_minhash"}


def test_chain_of_digests(spark, data):
    got = {r["doc_id"]: r["h"] for r in QUERIES["chain_hash"](spark, data).collect()}
    records = [{"doc_id": r["doc_id"], "n_chars": r["n_chars"]} for r in spark.read.parquet(f"{data}/documents.parquet").orderBy("doc_id").collect()]
    before, want = hashing.GENESIS, {}
    for r in records:
        want[r["doc_id"]] = hashing.chain_hash(before, r)
        before = hashing.digest(hashing.canonical_json(r))
    assert got == want and len(want) > 50


def test_snippets(spark, data):
    rows = QUERIES["fts_snippets"](spark, data).collect()
    assert rows and all("[" in r["snippet"] and len(r["snippet"]) <= 240 for r in rows)
    texts = {(r["doc_id"], r["seq"]): r["text"] for r in spark.read.parquet(f"{data}/text_block.parquet").collect()}
    assert all(texts[r["doc_id"], r["seq"]][q["span_start"] : q["span_end"]] == q["text"] for r in rows for q in r["quotes"])


def test_flags_are_those_of_all_pairs(spark, data):
    """At 0.2, where there are some: each flag is a pair's estimate, and the best earlier text of high estimate is always among them."""
    docs = spark.read.parquet(f"{data}/documents.parquet")
    signed = [(tuple(r["place"]), r["doc_id"], r["sig"]) for r in neardup.signed_texts(docs, ["taped_at"]).collect()]
    alike = {(b, a): sum(x == y for x, y in zip(s, t, strict=True)) / 128 for p, a, s in signed for q, b, t in signed if p < q}
    got = {(r["doc_id"], r["other"]): r["jaccard"] for r in neardup.flagged(docs, ["taped_at"], least=0.2, most=50).collect()}
    assert all(abs(alike[k] - j) < 5e-4 for k, j in got.items()) and {k for k, j in alike.items() if j >= 0.7} <= set(got)
    assert {tuple(r)[:2] for r in QUERIES["near_dup_minhash"](spark, data).collect()} <= {k for k, j in alike.items() if j >= 0.6}


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
