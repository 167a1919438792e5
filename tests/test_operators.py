import random
import re
import sqlite3
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumark.operators import catalog, census, extract, leases, neardup, provider, ranking, sampling, scoring, search, spans


def test_ranks_and_sums_of_a_hot_group(spark):
    rows = [("hot" if i % 3 else f"g{i % 7}", i, i % 5) for i in range(600)] + [(None, 1_000 + i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    ranks = ranking.with_group_rank(df, ["g"], ["k"]).collect()
    groups = {}
    for r in ranks:
        groups.setdefault(r["g"], []).append(r["rank"])
    assert len(ranks) == len(rows) and all(sorted(v) == list(range(len(v))) for v in groups.values())
    sums = {r["k"]: r["before"] for r in ranking.with_group_prefix_sum(df, [], F.floor(F.col("k") / 50), ["k"], "v").collect()}
    total = 0
    for _, k, v in sorted(rows, key=lambda r: r[1]):
        assert sums[k] == total
        total += v


def test_empty_tables(spark):
    rows = spark.createDataFrame([], "doc_id string, seq int, year int, project string, tokens bigint")
    assert sampling.stratified_sample(rows, 100).count() == 0 and sampling.within_budget(rows, 10).count() == 0
    assert sampling.greedy_batches(rows, ["doc_id", "seq"], 10).count() == 0
    docs = spark.createDataFrame([], "doc_id bigint, text string, taped_at timestamp")
    assert neardup.duplicate_classes(docs).count() == 0 and neardup.flagged(docs, ["taped_at"]).count() == 0
    blocks = spark.createDataFrame([], "doc_id string, seq int, text string")
    assert search.ranked(blocks, "a").count() == 0


def test_sample_has_every_cell(spark):
    rows = [(f"d{i}", 0, 2024 + i % 2, f"p{i % 3}", 500) for i in range(60)]
    got = sampling.stratified_sample(spark.createDataFrame(rows, "doc_id string, seq int, year int, project string, tokens bigint"), 6_000).collect()
    assert len({(r["year"], r["project"]) for r in got}) == 6 and 5_000 <= sum(r["tokens"] for r in got) <= 9_000


def test_greedy_batches(spark):
    rows = [("a", i, t) for i, t in enumerate([4, 5, 3, 9, 50, None, 1])]
    got = sampling.greedy_batches(spark.createDataFrame(rows, "doc_id string, seq int, tokens bigint"), ["doc_id", "seq"], 10)
    assert [r["batch"] for r in got.orderBy("seq").collect()] == [0, 0, 1, 2, 3, 4, 4]


def packed(tokens, most, filled=0):
    """One pass: where a batch that is filled so far ends up, how many were begun, and each row's batch."""
    n, out = 0, []
    for t in tokens:
        if filled + t > most:
            n, filled = n + 1, 0
        filled += t
        out.append(n)
    return filled, n, out


def test_passages_link_to_one_pass():
    rng = random.Random(1)
    for _ in range(400):
        most, n = rng.randint(1, 30), rng.randint(1, 15)
        t = np.array([rng.choice([0, 1, 2, 5, 9, 40, rng.randint(0, most)]) for _ in range(n)])
        k = rng.randint(1, n)
        whole, halves = sampling.passage(t, most), sampling.passage(t[:k], most)
        halves = halves.then(sampling.passage(t[k:], most)) if k < n else halves
        for f in range(most + 45):
            assert whole(f) == halves(f) == packed(t, most, f)[:2]


@pytest.mark.parametrize(("run", "runs"), [(7, 3), (1, 2), (1_000, 10)])
def test_batches_dont_depend_on_runs(spark, run, runs):
    rng = random.Random(4)
    tokens = [rng.choice([0, 3, 8, 20, 60, 130]) for _ in range(200)]
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate(tokens)], "doc_id string, seq int, tokens bigint").repartition(5)
    got = sampling.greedy_batches(df, ["doc_id", "seq"], 100, run, runs).orderBy("seq").collect()
    # Nothing is open before the first row, so an oversized one begins no second batch.
    want = packed(tokens, 100)[2]
    assert [r["batch"] for r in got] == [w - (tokens[0] > 100) for w in want]


def test_upserts(spark):
    old = spark.createDataFrame([("a", 0, 1), ("b", 0, 2)], "doc_id string, seq int, v int")
    new = spark.createDataFrame([("b", 0, 3), ("c", 0, 4)], "doc_id string, seq int, v int")
    values = lambda df: {r["doc_id"]: r["v"] for r in df.collect()}
    assert values(catalog.upsert(old, new, ["v"])) == {"a": 1, "b": 3, "c": 4} and values(catalog.insert_new(old, new, ["v"])) == {"a": 1, "b": 2, "c": 4}
    twice = new.unionByName(spark.createDataFrame([("c", 0, 9), ("c", 0, 7)], new.schema))
    assert values(catalog.upsert(old, twice, ["v"])) == {"a": 1, "b": 3, "c": 9} and values(catalog.insert_new(old, twice, ["v"])) == {"a": 1, "b": 2, "c": 4}
    assert values(catalog.fetch(new.select("doc_id", "seq"), old)) == {"b": 2}


def test_mersenne_products():
    rng = random.Random(1)
    a, x = [rng.randrange(neardup.PRIME) for _ in range(500)] + [neardup.PRIME - 1], [rng.randrange(neardup.PRIME) for _ in range(500)] + [neardup.PRIME - 1]
    got = neardup._times(np.array(a, np.uint64), np.array(x, np.uint64)).tolist()
    assert got == [i * j % neardup.PRIME for i, j in zip(a, x, strict=True)]


@pytest.fixture(scope="module")
def near_docs(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [[rng.choice(words) for _ in range(120)] for _ in range(40)]
    rows = []
    for i, b in enumerate(base):
        rows.append((i, " ".join(b)))
        other = list(b)
        for k in rng.sample(range(120), i % 4):
            other[k] = "changed"
        rows.append((100 + i, " ".join(other)))
    rows += [(200, " ".join(base[0])), (300, None), (301, ""), (302, "too short")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("taped_at", F.timestamp_seconds("doc_id"))


def jaccards(docs):
    sets = {}
    for r in docs.collect():
        w = re.findall(r"\w+", (r["text"] or "").lower())
        if len(w) >= 5 and r["text"] not in {t for t, _ in sets.values()}:
            sets[r["doc_id"]] = (r["text"], {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    return {(a, b): len(x & y) / len(x | y) for a, (_, x) in sets.items() for b, (_, y) in sets.items() if a < b}


def test_similar_texts_are_all_found(near_docs):
    want = {p: j for p, j in jaccards(near_docs).items() if j >= 0.8}
    got = {(r["a"], r["b"]): r["jaccard"] for r in neardup.similar_texts(neardup.text_classes(near_docs)).collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want) and want


def test_duplicate_classes(near_docs):
    got = {r["doc_id"]: r for r in neardup.duplicate_classes(near_docs).collect()}
    assert got[200]["class_id"] == got[0]["class_id"] == 0 and 300 not in got and got[302]["class_id"] == 302 and got[302]["links"] == 0
    assert all(got[b]["class_id"] == got[a]["class_id"] for (a, b), j in jaccards(near_docs).items() if j >= 0.8)


def broadcasts(monkeypatch, made):
    """Plans with a broadcast among those that `made` cuts and the one it returns."""
    plans, cut = [], neardup.cut
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df
    monkeypatch.setattr(neardup, "cut", lambda df: cut(plan(df)))
    plan(made())
    return [p for p in plans if "Broadcast" in p]


@pytest.fixture(scope="module")
def stored_docs(spark, near_docs, tmp_path_factory):
    """near_docs from files: only their size is known, not guessed as boundless."""
    path = str(tmp_path_factory.mktemp("near") / "docs.parquet")
    near_docs.write.parquet(path)
    return spark.read.parquet(path)


def test_duplicate_classes_are_not_broadcast(stored_docs, monkeypatch):
    """The size of a row with an array is estimated at a fraction, and the driver would hold all of them."""
    assert not broadcasts(monkeypatch, lambda: neardup.duplicate_classes(stored_docs, 0.6))


@pytest.fixture(scope="module")
def edited_docs(spark, tmp_path_factory):
    """Texts of few to many words with ever more edits and cuts, so that pairs lie on both sides of either threshold."""
    rng, rows = random.Random(11), []
    for i in range(60):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 6, 9, 15, 40, 120, 300]))]
        for k in range(5):
            other = base[: len(base) - rng.randrange(1 + len(base) // 3)]
            for at in rng.sample(range(len(other)), rng.randrange(1 + len(other) // 15)):
                other[at] = f"x{rng.randrange(50)}"
            rows.append((5 * i + k, " ".join(base[:4] + other)))
    path = str(tmp_path_factory.mktemp("edited") / "docs.parquet")
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(path)
    return spark.read.parquet(path)


def check_similar(docs, monkeypatch, least):
    made = []
    assert not broadcasts(monkeypatch, lambda: made.append(neardup.similar_texts(neardup.text_classes(docs), least)) or made[0])
    want, got = {p: j for p, j in jaccards(docs).items() if j >= least}, {(r["a"], r["b"]): r["jaccard"] for r in made[0].collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 1e-9 for p in want) and len(want) > 30


def test_similar_texts_at_the_threshold_of_flags(edited_docs, monkeypatch):
    check_similar(edited_docs, monkeypatch, 0.6)


def test_similar_texts_at_the_strict_threshold(spark, edited_docs, monkeypatch):
    check_similar(edited_docs, monkeypatch, 0.8)
    # A shingle that two texts share is never taken for one that is alone, nor a frequent one for a rare one.
    shingles = spark.createDataFrame([([5, 7, -3],), ([5, 9],)] + [([9],)] * 300, "s array<bigint>")
    found = neardup.weights(shingles)
    at = lambda h: int(found[h & (neardup.BUCKETS - 1)])
    assert at(7) == at(-3) == neardup.ALONE < at(5) < at(9) and at(6) == 0


def test_minhash_recall(near_docs):
    want = {(b, a) for (a, b), j in jaccards(near_docs).items() if j >= 0.8}
    got = {(r["doc_id"], r["other"]) for r in neardup.flagged(near_docs, ["taped_at"], least=0.6).collect()}
    assert len(want & got) >= 0.95 * len(want)


def test_texts_of_few_words_are_signed_by_characters(spark):
    rng = random.Random(8)
    letter = lambda: chr(rng.randrange(0x3042, 0x3090))
    base = ["".join(letter() for _ in range(400)) + "。" for _ in range(12)]
    near = [b[: 30 * i + 5] + letter() + b[30 * i + 6 :].replace("。", "\u3000\n。") for i, b in enumerate(base)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(near)]
    rows += [(200, base[0][:199]), (201, base[0][:198] + "x"), (202, "ab \n" * 100), (300, None)]  # too short, and few distinct runs
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("taped_at", F.timestamp_seconds("doc_id"))
    got = {r["doc_id"]: (r["other"], r["jaccard"]) for r in neardup.flagged(docs, ["taped_at"], least=0.8).collect()}
    assert {d: o for d, (o, _) in got.items()} == {100 + i: i for i in range(12)}
    # The shingles are those of the squashed, lower-case text.
    text = "Ab" * 20 + " \t\n" + base[1]
    squashed = "ab" * 20 + " " + base[1]
    want = neardup.signature([neardup.base_hash(s) for s in {squashed[i : i + 8] for i in range(len(squashed) - 7)}]).tolist()
    assert spark.createDataFrame([(text,)], "t string").select(neardup.minhash(F.col("t"))).first()[0] == want


FTS = ["alpha", "alpha beta", "alpha OR gamma", "alpha NOT beta", '"alpha beta"', "bet*", "cafe", "NEAR(alpha gamma, 2)", "NEAR(alpha gamma delta, 3)", 'NEAR("alpha beta" gamma)', "NEAR(alpha gamma) OR delta", "alpha OR alpha", "al* delta", "(alpha OR beta) AND gamma"]


@pytest.fixture(scope="module")
def blocks(spark):
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "Café", "delta", "bet_ter", "épsilon"]
    rows = [(f"d{i:02}", 0, " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))) for i in range(60)]
    return spark.createDataFrame(rows, "doc_id string, seq int, text string")


@pytest.mark.parametrize("query", FTS)
def test_search_ranks_as_the_embedded_engine(blocks, query):
    db = sqlite3.connect(":memory:")
    db.execute("create virtual table t using fts5(doc_id unindexed, text)")
    db.executemany("insert into t values (?, ?)", [(r["doc_id"], r["text"]) for r in blocks.collect()])
    want = {k: v for k, v in db.execute("select doc_id, bm25(t) from t where t match ?", (query,))}
    got = {r["doc_id"]: r["rank"] for r in search.ranked(blocks, query).collect()}
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want) and want


def test_stored_index_grows(spark, blocks, tmp_path):
    store = search.StoredIndex(spark, str(tmp_path))
    assert store.index() is None and store.counts().first()["chunks"] is None
    some = blocks.where("doc_id < 'd30'")
    assert store.add(some) == 30 and store.add(blocks) == 30 and store.add(blocks) == 0
    ranks = lambda **k: {(r["doc_id"], round(r["rank"], 9)) for r in search.ranked(query="alpha OR bet*", **k).collect()}
    assert ranks(blocks=None, index=store.index()) == ranks(blocks=blocks) and store.counts().first()["chunks"] == 60
    plan = search.ranked(None, "alpha", store.index())._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(term,alpha\)|PushedFilters: \[[^\]]*In\(term", plan)


def test_report_withholds_what_isnt_there(spark):
    blocks = spark.createDataFrame([("d1", 0, "The lantern stood\nby the ridge path."), ("d2", 0, "A lantern."), ("d3", 0, "lantern lantern")], "doc_id string, seq int, text string")
    docs = spark.createDataFrame([("d1", "p1/a.md", 2020)], "doc_id string, path string, year int")
    quote = "array<struct<text:string,span_start:int,span_end:int>>"
    cards = spark.createDataFrame([("d1", 0, 1, ["old"], [("never said", 0, 3)]), ("d1", 0, 2, ["t"], [("STOOD by", -1, -1), ("never said", 0, 3), (None, 0, 0), ("ridge", 5, 9)])], f"doc_id string, seq int, read_at int, topics array<string>, quotes {quote}")
    got = {r["doc_id"]: r for r in search.report(blocks, docs, cards, "lantern", 5).collect()}
    assert [(q["quote"], q["text"], q["method"]) for q in got["d1"]["quotes"]] == [(0, "stood\nby", "whitespace"), (3, "ridge", "find")] and got["d1"]["withheld"] == 2 and got["d1"]["topics"] == ["t"]
    assert (got["d2"]["project"], got["d2"]["path"], got["d2"]["year"], got["d2"]["quotes"], got["d2"]["withheld"]) == ("?", "?", 0, [], None) and got["d1"]["project"] == "p1"
    assert {r["matched_as"] for r in search.report(blocks, docs, cards, "ridge-path", 5).collect()} == {"phrase"}


def test_search_falls_back_to_a_phrase(blocks):
    for bad in ("a--b", 'AND OR "', "alpha (", "fence-check"):
        with pytest.raises(search.QueryError):
            search.parse(bad)
    hits, read_as = search.search(blocks, "alpha-beta", 3)
    assert read_as == "phrase" and hits.count() <= 3
    with pytest.raises(search.QueryError):
        search.search(blocks, "  ")


def test_quotes_are_located():
    t = "The quick\n brown fox. THE END"
    assert spans.locate(t, "quick") == (4, 9, "find") and spans.locate(t, " the QUICK brown ") == (0, 16, "whitespace")
    assert spans.locate(t, "slow") is None and spans.locate(t, " ") is None and spans.locate(None, "a") is None


def test_stability(spark):
    def run(a, b):
        f = lambda v: spark.createDataFrame(list(enumerate(v)), "id bigint, score double")
        return scoring.stability(f(a), f(b)).first()

    assert run([0.7] * 30, [0.7] * 30)["same"] and not run([0.7] * 30, [0.4] * 30)["same"]
    assert run([0.7], [0.6])["t"] is None
    a, b = [0.1, 0.5, 0.9, 0.3], [0.2, 0.4, 0.9, 0.6]
    d = [x - y for x, y in zip(a, b, strict=True)]
    assert abs(run(a, b)["se"] - statistics.stdev(d) / 2) < 1e-6


SMALL = provider.Ladder(sleep=lambda s: None)


def test_reading_pass(spark):
    chunks = spark.createDataFrame([("a", 0, "h", "Good text"), ("a", 1, "h", "bad"), ("b", 0, "h", None)], "doc_id string, seq int, header string, text string")

    def answers(header, text, most_out):
        if text == "bad":
            return provider.Answer("no object", 1, 1, 1, "m")
        return provider.Answer('```json\n{"entities": [{"name": "' + text.split()[0] + '"}], "claims": [{"subject": "s", "predicate": "p", "confidence": "0.9"}]}\n```', 1, 2, 3, "m")

    saved = []
    assert extract.reading_pass(chunks, None, answers, lambda df: saved.append(df), batch_rows=2) == 2
    got = {(r["doc_id"], r["seq"]): r for df in saved for r in df.collect()}
    assert len(got) == 3 and got["a", 0]["entities"][0]["name"] == "Good" and got["a", 0]["claims"][0]["confidence"] == 0.9
    assert got["a", 1]["reason"].startswith("invalid_output") and got["a", 1]["usage_tokens"]["out"] == 3 and got["b", 0]["reason"] == "text_missing"
    done = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "doc_id string, seq int")
    assert extract.reading_pass(chunks, done, answers, saved.append) == 0
    golden = chunks.where("seq = 0 and text is not null").join(saved[0].unionByName(saved[1]).drop("model", "reason", "usage_tokens"), ["doc_id", "seq"])
    with pytest.raises(extract.Halted, match="calibration"):
        extract.reading_pass(chunks, None, lambda h, t, n: provider.Answer("{}"), saved.append, golden=golden)
    with pytest.raises(extract.Halted, match="cost"):
        extract.reading_pass(chunks, None, answers, saved.append, most_usd=0.0)
    with pytest.raises(ZeroDivisionError):  # what can't work fails before the pass begins
        extract.reading_pass(chunks, None, lambda h, t, n: 1 / 0, saved.append)
    vectors = spark.createDataFrame([], "doc_id string, seq int")
    found = extract.backfill_vectors(chunks, vectors, lambda ts: [[float(len(t))] for t in ts], "m").collect()
    assert sorted((r["doc_id"], r["seq"], r["vec"], r["reason"]) for r in found) == [("a", 0, [9.0], None), ("a", 1, [3.0], None), ("b", 0, None, "text_missing")]

    def fails_later(ts):
        if "bad" in ts:
            raise RuntimeError("gone")
        return [[1.0]] * len(ts)

    found = extract.backfill_vectors(chunks.coalesce(1).sortWithinPartitions("seq"), vectors, fails_later, "m", group=1).collect()
    assert {(r["doc_id"], r["seq"]): r["reason"] for r in found} == {("a", 0): None, ("a", 1): "embedder: gone", ("b", 0): "text_missing"}


def test_golden_chunks_in_quarantine_count_nothing(spark):
    rows = [(f"d{i}", 0, "h", "Good") for i in range(10)]
    chunks = spark.createDataFrame(rows, "doc_id string, seq int, header string, text string")
    golden = chunks.join(extract.read_chunks(chunks, lambda h, t, n: provider.Answer('{"topics": ["x"]}')).drop("model", "reason", "usage_tokens"), ["doc_id", "seq"])
    again = extract.read_chunks(golden.withColumn("text", F.when(F.col("doc_id") == "d3", "Good").otherwise("bad")), lambda h, t, n: provider.Answer('{"topics": ["x"]}' if t == "Good" else "no"), SMALL)
    assert abs(extract.golden_mean(golden, again) - 0.1) < 1e-9 and extract.golden_mean(golden.limit(0), again) == 0.0


def test_a_second_model_halts(spark):
    chunks = spark.createDataFrame([(f"d{i}", 0, "h", f"t{i}") for i in range(9)], "doc_id string, seq int, header string, text string")
    saved = []
    with pytest.raises(extract.Halted, match="changed from a to b"):
        extract.reading_pass(chunks, None, lambda h, t, n: provider.Answer("{}", model="b" if t == "t4" else "a"), saved.append)
    assert saved[0].count() == 8


def test_ladder():
    gate, calls = provider.Gate(8), []

    def busy(h, t, n):
        calls.append(n)
        if len(calls) <= 3:
            raise provider.Unreached("429", 429)
        return provider.Answer('{"a": 1}' if len(calls) == 6 else "{", out=n, miss=1)

    slept = []
    got, reason, used = provider.climb(busy, "h", "t", extract.carve_object, provider.Ladder(sleep=slept.append), gate)
    assert got == {"a": 1} and reason is None and slept == [1, 2, 4] and gate.limit == 1
    assert calls == [6_000] * 4 + [18_000, 54_000] and used.out == 78_000 and used.miss == 3
    never = lambda h, t, n: (_ for _ in ()).throw(provider.Unreached("down"))
    slept.clear()
    assert provider.climb(never, "h", "t", extract.carve_object, provider.Ladder(sleep=slept.append), gate)[1] == "refused: transport: down" and slept == [1, 2, 4, 8, 16, 30]
    assert provider.climb(lambda h, t, n: provider.Answer("a: 1"), "h", "t", extract.carve_object, provider.Ladder(rescue=lambda t: '{"a": 1}'), gate)[0] == {"a": 1}
    assert provider.make_provider("rules")("h", "Tide at Quay. More", 10).model == "rules"
    with pytest.raises(ValueError, match="no provider"):
        provider.make_provider("none")


def test_gate_recovers():
    now = [0.0]
    gate = provider.Gate(1_000, clock=lambda: now[0])
    gate.ease(), gate.ease()
    assert gate.limit == 250
    now[0] = 130.0
    assert gate.limit == 378
    now[0] = 10_000.0
    assert gate.limit == 1_000


def test_leases(tmp_path):
    now = [0.0]
    a, b = (leases.Leases(tmp_path, o, 900, lambda: now[0]) for o in "ab")
    assert a.take("pass") and a.take("pass") and not b.take("pass") and not b.renew("pass")
    now[0] = 400.0
    assert a.renew("pass")
    now[0] = 1_000.0
    assert not b.take("pass")
    now[0] = 1_400.0
    assert b.take("pass") and not a.renew("pass")
    a.release("pass")
    assert not a.take("pass")
    b.release("pass")
    assert a.take("pass")
    assert leases.Leases(tmp_path / "pass.lease" / "x", "a").take("k")  # a folder that can't be used stops nothing


def test_reconciliation(spark):
    key = lambda *ps: spark.createDataFrame([("r", p) for p in ps], "root string, path string")
    r = census.reconciliation(key("a", "b", "c"), key("b", "c", "d", "e"), key("a", "b").withColumn("state", F.lit("doc")), most=1).first()
    assert (r["files"], r["classified"], r["completeness_pct"], r["new_since"], r["vanished"], r["unaccounted"], r["n_new_since"]) == (3, 2, 66.67, ["d"], ["a"], ["c"], 2)
    assert census.reconciliation(key("a").limit(0), key("a").limit(0), key("a").withColumn("state", F.lit("doc"))).first()["completeness_pct"] == 100.0


def test_long_texts_are_signed_by_a_sample(spark):
    t = "".join(chr(0x3042 + i * i % 70) for i in range(120_000))
    assert neardup.sampled(t) == "".join(t[i * 6_000 : i * 6_000 + 5_000] for i in range(20)) and neardup.sampled(t[:100_000]) == t[:100_000]
    whole, part = (spark.createDataFrame([(t,)], "t string").select(neardup.minhash(F.col("t"), w)).first()[0] for w in (True, False))
    assert len(whole) == len(part) == 128
    assert neardup.runs("a b " * 16 + "c") == set() and len(neardup.runs(" ".join(f"w{i}" for i in range(34)))) == 30


def test_sorted_ranks_of_a_hot_moment(spark):
    df = spark.createDataFrame([("hot" if i % 3 else f"g{i % 7}", 5 if i % 2 else None, i) for i in range(600)], "g string, ts int, k int").repartition(7)
    groups = {}
    for r in ranking.with_sorted_rank(df, ["g"], ["ts", "k"]).collect():
        groups.setdefault(r["g"], []).append((r["rank"], (r["ts"] or 0, r["k"])))
    assert sum(map(len, groups.values())) == 600
    for rows in groups.values():
        assert [x for _, x in sorted(rows)] == sorted(x for _, x in rows) and sorted(n for n, _ in rows) == list(range(len(rows)))
