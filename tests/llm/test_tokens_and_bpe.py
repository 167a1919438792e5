import base64
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vellumark.llm import bpe, mixing, packing, tokens

ODD = ["", "<|endoftext|> a", "a" * 3_000, "ab" * 2_000 + "é", "  \n\n\t x  ", "日本語のテキスト。", "I'm we'll DON'T", "👩‍💻 ﬁ ​", "힣́", "x" * 200_000]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_pattern_splits_as_the_published_one():
    import regex

    rng = random.Random(3)
    published = regex.compile(public_tokenizers.PATTERN)
    for _ in range(400):
        t = "".join(rng.choice("ab'sdlv  \n\t1.é日") for _ in range(30))
        assert regex.findall(bpe.PATTERN, t) == published.findall(t)


def test_ids_equal_the_public_encoder(reference, spark, data):
    texts = ODD + [r[0] or "" for r in spark.read.parquet(f"{data}/documents.parquet").select("text").collect()]
    codec = bpe.load_codec()
    want = [e.ids for e in reference.encode_batch(texts, add_special_tokens=False)]
    assert [codec.encode(t) for t in texts] == want
    assert all(codec.decode(i) == t for t, i in zip(texts, want, strict=True))


def test_bounded_memory_changes_nothing():
    codec = bpe.BytePairCodec(bpe.load_codec().ranks, remembered=3, longest=4)
    assert [codec.encode(t) for t in ODD] == [bpe.load_codec().encode(t) for t in ODD]


def test_encode_table(spark):
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "a b", "z"), (3, "a b", "z")], "doc_id bigint, text string, ids string")
    got = bpe.encode_corpus(df)
    assert got.columns == ["doc_id", "ids"] and sorted((r[0], tuple(r[1])) for r in got.collect()) == [(1, ()), (2, ()), (3, (64, 275)), (3, (64, 275))]
    back = bpe.decode_corpus(got)
    assert sorted((r[0], r[1]) for r in back.collect()) == [(1, ""), (2, ""), (3, "a b"), (3, "a b")]
    assert bpe.encode_corpus(df.limit(0)).count() == 0


def greedy(vocabulary, word):
    n = at = 0
    longest = max(map(len, vocabulary))
    while at < len(word):
        size = next(k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in vocabulary)
        n, at = n + 1, at + size
    return n


def test_longest_match_counts():
    rng = random.Random(4)
    vocabulary = {bytes([b]) for b in range(256)} | {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 7))) for _ in range(60)}
    trie = tokens.LongestMatchCounter(vocabulary)
    for _ in range(500):
        w = bytes(rng.choice(b"abcd") for _ in range(rng.randint(0, 40)))
        assert trie.count(w) == greedy(vocabulary, w)
    with pytest.raises(ValueError):
        tokens.LongestMatchCounter([b"a"])
    real = {base64.b64decode(x.split()[0]) for x in open(bpe.RANKS, "rb")}
    assert all(tokens.load_counter().count(w.encode()) == greedy(real, w.encode()) for w in ("unhappiness", "日本語", "x" * 99))


def test_document_budget_counts_each_text_once(spark):
    rows = [(1, "a b", "en", "S", "text", 2001), (2, "a b", "de", "T", "text", 2002), (3, None, "en", None, None, None), (4, "", "en", "S", "text", 2001), (5, "c", "Deutsch", " s ", "text", 2001), (6, "d", None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, modality string, year int")
    got = {(r["source"], r["language"]): (r["texts"], r["tokens"]) for r in tokens.document_budget(df, ("source", "language")).collect()}
    assert got == {("s", "en"): (1, 2), ("s", "de"): (1, 1), (None, None): (1, 1)}
    assert tokens.document_budget(df.limit(0)).count() == 0


def test_unusable_estimates(spark):
    doc = spark.createDataFrame([("a", "x", "t", 1, 10, 1), ("a", "x", "t", 1, 99, 2), ("b", "x", "t", 1, None, 1), ("c", "x", "t", 1, 10, 1), ("d", "x", "t", 1, 5, 1), ("e", "x", "t", 1, 4, 1), ("none", "x", "t", 1, None, 1)], "doc_id string, source string, modality string, year int, tokens_est bigint, at int").withColumn("taped_at", F.timestamp_seconds("at"))
    text = "x" * 40
    blocks = spark.createDataFrame([(k, 0, text) for k in "aabcde"] + [("orphan", 0, text), ("c", 1, None)], "doc_id string, seq int, text string")
    assert {r[0] for r in tokens.unusable_estimates(doc, blocks).collect()} == {"a", "b", "e"}


def test_language_labels(spark):
    df = spark.createDataFrame([(x,) for x in ("en-GB", "EN", "English", "Deutsch", "deu", " fra ", "xx", "", None, "ja_JP")], "l string").select(tokens.language_code(F.col("l")))
    assert [r[0] for r in df.collect()] == ["en", "en", "en", "de", "de", "fr", None, None, None, "ja"]


def test_packing_histogram_is_full_and_whole():
    rng = random.Random(9)
    for capacity in (1, 7, 100, 2_048):
        histogram = {n: rng.randint(1, 50) for n in rng.sample(range(1, capacity + 1), min(capacity, 40))}
        placed = packing.pack_histogram(histogram, capacity)
        load, seen = {}, {}
        for length, first, last, batch, each in placed:
            for r in range(first, last + 1):
                b = batch + (r - first) // each
                load[b] = load.get(b, 0) + length
                seen.setdefault(length, []).append(r)
        assert max(load.values()) <= capacity and sorted(load) == list(range(len(load)))
        assert all(sorted(seen[n]) == list(range(c)) for n, c in histogram.items())
        total = sum(n * c for n, c in histogram.items())
        assert len(load) <= -(-total // capacity) * 1.25 + 1
    with pytest.raises(ValueError):
        packing.pack_histogram({5: 1}, 4)


def test_packing_table(spark):
    rows = [("a", i, (i * 37) % 90 + 1, "p") for i in range(300)] + [("b", 0, 250, "p"), ("b", 1, None, "p"), ("b", 2, 0, "p"), ("b", 3, -1, "p"), ("a", 0, 1, "p")]
    items = spark.createDataFrame(rows, "doc_id string, seq int, tokens int, pass_name string").drop("pass_name").withColumn("batch", F.lit("x"))
    caps = spark.createDataFrame([("s", 100), ("l", 1_000), ("bad", 0), ("none", None)], "pass_name string, capacity_tokens int")
    got = packing.pack_items(items, caps)
    load = got.groupBy("pass_name", "batch").agg(F.sum("tokens").alias("t")).groupBy("pass_name").agg(F.max("t").alias("t")).collect()
    assert {r["pass_name"]: r["t"] <= {"s": 100, "l": 1_000}[r["pass_name"]] for r in load} == {"s": True, "l": True}
    assert sorted((r["piece"], r["tokens"]) for r in got.where("doc_id = 'b' and pass_name = 's'").collect()) == [(0, 100), (1, 100), (2, 50)]
    assert got.where("pass_name = 'l'").count() == 301 and got.where("doc_id = 'b' and seq > 0").count() == 0
    report = {r["pass_name"]: r["fill"] for r in packing.fill_report(got, caps).collect()}
    assert report["s"] > 0.97 and report["l"] > 0.9
    assert packing.pack_items(items.limit(0), caps).count() == 0 and packing.pack_items(items, caps.limit(0)).count() == 0


def test_mixing(spark):
    rng = random.Random(8)
    rows = [(i, s, rng.randint(1, 400)) for i, s in enumerate(["big"] * 900 + ["small"] * 60 + ["other"] * 50 + [None] * 5)] + [(5_000, "big", None), (5_001, "big", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint").withColumn("copy", F.lit("clash"))
    targets = spark.createDataFrame([("big", 0.7, 1), ("small", 0.3, 3), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    chosen = mixing.mix_sources(docs, targets)
    report = {r["source"]: r for r in mixing.mix_report(chosen, docs, targets).collect()}
    assert abs(report["big"]["share_reached"] - 0.7) < 0.02 and abs(report["small"]["share_reached"] - 0.3) < 0.02
    assert report["gone"]["uses"] == 0 and report["small"]["most_repeats"] <= 3 and report["big"]["most_repeats"] == 1
    assert chosen.where("source = 'other' or source is null").count() == 0
    again = lambda df: sorted(map(tuple, df.collect()))
    assert again(chosen) == again(mixing.mix_sources(docs.repartition(7), targets))
    assert mixing.mix_sources(docs.limit(0), targets).count() == 0 and mixing.mix_sources(docs, targets.limit(0)).count() == 0
