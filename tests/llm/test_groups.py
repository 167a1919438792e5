import json
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellumark.llm import conversations, names, neighbours

LINE = "session_id string, line_no bigint, msg_uuid string, parent_uuid string, line_type string, role string, content string, at int"


def rows_of(sid, turns, chained=True, start=0):
    return [(sid, i, f"{sid}{i}" if chained else None, f"{sid}{i - 1}" if chained and i else None, t, r, c, start + i) for i, (t, r, c) in enumerate(turns)]


U, A = ("user", "user", "hello"), ("assistant", None, "hi")
TOOL = ("user", "user", json.dumps([{"type": "tool_result", "content": "x"}]))
CASES = {
    "good": ([U, A, U, A], False), "human": ([("user", "Human", "q"), ("assistant", "ai", "a")], False), "tools": ([U, TOOL, A, TOOL, A], False), "sic": ([("user", "user", "[sic] text"), A], False),
    "empty": ([("user", "user", " ​"), ("assistant", "ai", "[]")], True), "first": ([A, U, A], True), "last": ([U, A, U], True), "double": ([U, U, A], True), "system": ([("system", "system", "s"), U, A], False),
    "cut": ([U, ("assistant", "ai", '[{"type": "text", "te'), A], True), "null": ([("user", None, None), ("assistant", "", None)], True),
}


@pytest.fixture(scope="module")
def lines(spark):
    rows = []
    for chained in (True, False):
        for name, (turns, _) in CASES.items():
            rows += rows_of(f"{name}{'+' if chained else '-'}", turns, chained)
    rows += [("lost", 0, "l0", "gone", *U, 0), ("lost", 1, "l1", "l0", *A, 1), (None, 0, None, None, *U, 0)]
    rows += rows_of("long", [U, A] * 40) + rows_of("long-", [U, A] * 40, False) + rows_of("longbad", [U, A] * 20 + [U, U, A], True)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows + rows[:20], LINE).withColumn("ts", F.timestamp_seconds("at")).withColumn("ingested_at", F.current_timestamp())
    return df.withColumn("turn", F.lit("clash")).withColumn("words", F.lit(1))


WANT = {f"{n}{s}" for n, (_, bad) in CASES.items() for s in "+-" if bad} | {"lost", "longbad"}


@pytest.mark.parametrize("one_task", [20_000, 6])
def test_sessions_to_drop(lines, monkeypatch, one_task):
    monkeypatch.setattr(conversations, "ONE_TASK_ROWS", one_task)
    monkeypatch.setattr(conversations, "BLOCK_TURNS", 7)
    assert {r[0] for r in conversations.broken_sessions(lines).collect()} == WANT
    got = {}
    for r in conversations.conversations(lines).collect():
        got.setdefault(r["session_id"], {})[r["turn"]] = r["speaker"]
    assert set(got) & WANT == set() and [got["long"][i] for i in range(80)] == ["user", "assistant"] * 40 and [got["long-"][i] for i in range(80)] == ["user", "assistant"] * 40


def test_no_sessions(lines):
    assert conversations.broken_sessions(lines.limit(0)).count() == 0 and conversations.conversations(lines.limit(0)).count() == 0


def test_circles_end(spark):
    rows = [("c", 0, "a", "b", *U, 0), ("c", 1, "b", "a", *A, 1), ("s", 0, "x", "x", *U, 0), ("s", 1, "y", "x", *A, 1)]
    df = spark.createDataFrame(rows, LINE).withColumn("ts", F.timestamp_seconds("at"))
    got = [tuple(r) for r in conversations.conversations(df).orderBy("session_id", "turn").select("session_id", "turn", "speaker").collect()]
    assert conversations.broken_sessions(df).count() == 0 and got == [("c", 0, "user"), ("c", 1, "assistant"), ("s", 0, "user"), ("s", 1, "assistant")]


# (id, parent, turn) in order of time, the order wanted (level by level, each level by time, what has no root last), whether to drop.
TREES = {
    "edited": ([("r", None, U), ("a", "r", A), ("u1", "a", U), ("a1", "u1", A), ("u2", "a", U), ("a2", "u2", A)], ["r", "a", "u1", "u2", "a1", "a2"], True),
    "roots": ([("r1", None, U), ("b1", "r1", A), ("r2", None, U), ("b2", "r2", A)], ["r1", "r2", "b1", "b2"], True),
    "link": ([("r", None, U), ("a", "r", A), ("t", "a", TOOL), ("u1", "t", U), ("u2", "a", A)], ["r", "a", "u2", "u1"], True),
    "replies": ([("r", None, U), ("a1", "r", A), ("a2", "r", A), ("u", "a1", U), ("b", "u", A)], ["r", "a1", "a2", "u", "b"], False),
    "circle": ([("x", "x", U), ("y", "x", A), ("r", None, U), ("a", "r", A)], ["r", "a", "x", "y"], False),
}


def test_one_order_at_every_size(spark, monkeypatch):
    """Forks, circles, self-parents, lost parents and standing clocks: the same turns row by row whatever a task holds."""
    rng = random.Random(5)
    rows = []
    for s in range(24):
        for i in range(rng.randint(1, 30)):
            parent = rng.choice([None, f"m{i}", f"m{rng.randrange(40)}", f"m{max(0, i - 1)}", f"m{max(0, i - 1)}"]) if s % 4 else None
            rows.append((f"s{s}", i, f"m{i}" if rng.random() > 0.05 else None, parent, *rng.choice([U, A, A, TOOL]), rng.randrange(4)))
    df = spark.createDataFrame(rows, LINE).withColumn("ts", F.timestamp_seconds("at"))
    got = []
    for one_task in (1, 6, 20_000):
        monkeypatch.setattr(conversations, "ONE_TASK_ROWS", one_task)
        turns = conversations.ordered_messages(conversations.message_rows(df, with_words=False)).select("session_id", "turn", "line_no").collect()
        got.append((sorted(map(tuple, turns)), sorted(r[0] for r in conversations.broken_sessions(df).collect())))
    assert got[0] == got[1] == got[2] and len(got[0][0]) > 200 and got[0][1]


@pytest.mark.parametrize("one_task", [20_000, 2])
def test_forks_and_roots(spark, monkeypatch, one_task):
    monkeypatch.setattr(conversations, "ONE_TASK_ROWS", one_task)
    rows = [(sid, i, *r[:2], *r[2], i) for sid, (tree, _, _) in TREES.items() for i, r in enumerate(tree)]
    df = spark.createDataFrame(rows, LINE).withColumn("ts", F.timestamp_seconds("at"))
    got = {}
    for r in conversations.ordered_messages(conversations.message_rows(df, with_words=False)).collect():
        got.setdefault(r["session_id"], {})[r["turn"]] = r["id"]
    assert {sid: [t[i] for i in range(len(t))] for sid, t in got.items()} == {sid: order for sid, (_, order, _) in TREES.items()}
    assert {r[0] for r in conversations.broken_sessions(df).collect()} == {sid for sid, (_, _, bad) in TREES.items() if bad}


@pytest.mark.parametrize("one_task", [20_000, 2])
def test_repeated_ids_double_nothing(spark, monkeypatch, one_task):
    monkeypatch.setattr(conversations, "ONE_TASK_ROWS", one_task)
    rows = rows_of("r", [U, A] * 6)
    rows += [("r", i, *rows[i][2:6], "exported again", i) for i in (1, 3, 5)]  # rows of the assistant's
    # The last row of an id is the one meant: x stands a level lower the second time, and y below that.
    rows += [("m", 0, "a", None, *U, 0), ("m", 1, "b", "a", *A, 1), ("m", 2, "x", "a", *A, 2), ("m", 3, "x", "b", *A, 3), ("m", 4, "y", "x", *U, 4), ("m", 5, "z", "a", *A, 5), ("m", 6, "v", "y", *A, 6)]
    df = spark.createDataFrame(rows, LINE).withColumn("ts", F.timestamp_seconds("at"))
    got = {}
    for r in conversations.ordered_messages(conversations.message_rows(df, with_words=False)).collect():
        got.setdefault(r["session_id"], []).append((r["turn"], r["id"], r["line_no"]))
    assert [t for t, _, _ in sorted(got["r"])] == list(range(15)) and [i for _, i, _ in sorted(got["r"])] == sorted([r[2] for r in rows if r[0] == "r"], key=lambda i: int(i[1:]))
    assert [n for _, _, n in sorted(got["m"])] == [0, 1, 2, 5, 3, 4, 6]
    assert conversations.broken_sessions(df).count() == 0


ENTITIES = "array<struct<name:string,kind:string,aliases:array<string>>>"
PERSON = ["Prudence Diksifes", "Diksifes, Prue", "P. Diksifes", "Prudence Diksfes", "PRUDENCE DIKSIFES", "DIKSIFES Prudence", "Dr. Prudence Diksifes, PhD", "Prudence M. Diksifes", "Prudence  Diksifes", "Pruedence Diksifes", "Diksifes P."]
ORG = ["Seknojafil Print Trade Association", "The Seknojafil Print Trade Association", "Seknojafil PTA", "Seknojafil Print Trade Assn.", "Association of Print Trade, Seknojafil", "Print Trade Association Seknojafil", "SEKNOJAFIL PRINT TRADE ASSOCIATION", "Seknojafil Prnit Trade Association"]
OTHERS = ["Astrid Diksifal", "Robert Diksifes", "Vodelyt Print Trade Association", "Seknojafil Radio Company", "Bob", "the team", "HQ", ""]
UMLAUT = ["Jürgen Lavöros", "Juergen Lavoeros", "Jurgen Lavoros"]


@pytest.fixture(scope="module")
def cards(spark):
    rows = [([(n, "person", ["Bob", None])],) for n in PERSON for _ in range(2)] + [([(n, "org", None), (None, None, None)],) for n in ORG for _ in range(2)] + [([(n, None, [])],) for n in [*OTHERS, *UMLAUT]] + [(None,), ([None],)]
    rows += [([(f"{c.upper()}{c}{c}om{c} Print Trade Association", "org", [])],) for c in "abcdefghijklmnopqrstuvwxyz"]
    return spark.createDataFrame(rows, f"entities {ENTITIES}").withColumn("key", F.lit("clash")).withColumn("s", F.lit(1))


def test_spellings_of_one_entity(cards):
    got = {r["s"]: r["entity"] for r in names.entity_classes(cards).collect()}
    assert len({got[n] for n in PERSON}) == 1 and len({got[n] for n in ORG}) == 1 and len({got[n] for n in UMLAUT}) == 1
    assert len({got.get(n, n) for n in (PERSON[0], ORG[0], UMLAUT[0], *OTHERS[:4])}) == 7 and not {"Bob", "the team", "HQ", ""} & set(got)


def test_pairs_of_spellings(cards):
    got = {tuple(r) for r in names.same_entity_pairs(cards).collect()}
    want = {(a, b) for g in (PERSON, ORG, UMLAUT) for a in g for b in g if a < b}
    assert got == want and names.same_entity_pairs(cards.limit(0)).count() == 0


def test_what_may_be_two_is_none(spark):
    df = spark.createDataFrame([([(n, "person", [])],) for n in ("Edward Narvik", "Eleanor Narvik", "E. Narvik", "Edward Narvik")], f"entities {ENTITIES}")
    assert "E. Narvik" not in {r["s"] for r in names.entity_classes(df).collect()}


def test_slips_of_unlisted_given_names(spark):
    same = ["Thandiwe Mokoena", "Thandive Mokoena", "Thandwie Mokoena"]
    rows = [same[0]] * 3 + same[1:] + ["Nomvula Mokoena", "Thandive Brodersen", "Zuri Mokoena", "Zuli Mokoena"]
    df = spark.createDataFrame([([(n, "person", [])],) for n in rows], f"entities {ENTITIES}")
    assert {tuple(r) for r in names.same_entity_pairs(df).collect()} == {(a, b) for a in same for b in same if a < b}


def test_alike_tokens_lose_no_slip(spark):
    rng = random.Random(3)
    keys = {"".join(rng.choice("aeioukltnrs") for _ in range(rng.randint(2, 11))) for _ in range(250)} | {"ananas", "anananas", "bananana", "aaaa", "aaa"}
    for k in sorted(keys)[:150]:
        i, j = rng.randrange(len(k) - 1), rng.randrange(len(k) - 1)
        swap = lambda w, at: w[:at] + w[at + 1] + w[at] + w[at + 2 :]
        keys |= {k[:i] + k[i + 1 :], k[: i + 1] + k[i:], swap(k, i), swap(swap(k, i), j), k[:i] + "x" + k[i + 1 :]}
    keys.discard("")
    df = spark.createDataFrame([("person", k) for k in keys], "kind string, token string")
    got = {(r["token"], r["near"]): r["slips"] for r in names.alike_tokens(df).collect()}
    want = {(a, b): n for a in keys for b in keys if (n := names.slips(a, b)) is not None}
    unwritten = lambda w: re.sub("([aou])e", r"\1", w)
    want |= {(a, b): 0 for a in keys for b in keys if unwritten(a) == unwritten(b)}
    assert got == want


def test_orders_and_slips_of_names_on_no_list(spark):
    same = [["Thorvald Magnusson", "Thorvlad Magnusson"], ["Bayowale Adeyemi", "Bayowael Adeyemi", "Adeyemi Bayowale"], ["Robert Harrington", "Robert Harirngtno"], ["Kwabena Fisheries Institute", "Kwabena Fishereis Institute", "Institute of Fisheries, Kwabena"]]
    rows = [n for g in same for n in [g[0], *g]] + ["Thomas Martin", "Martin Thomas", "Robert Harringham", "Kwabena Forestry Institute"]
    df = spark.createDataFrame([([(n, "person", [])],) for n in rows], f"entities {ENTITIES}")
    assert {tuple(r) for r in names.same_entity_pairs(df).collect()} == {(a, b) for g in same for a in g for b in g if a < b}


def brute(x, ids, k):
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = n @ n.T
    np.fill_diagonal(s, -9)
    out = set()
    for i in range(len(ids)):
        for j in sorted(range(len(ids)), key=lambda j: (-round(s[i, j], 12), ids[j]))[:k]:
            if j != i:
                out.add((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return out


def test_neighbours(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "CELL", 40)
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((12, 64))
    x = (centres[rng.integers(0, 12, 900) ** 2 % 12] + 0.5 * rng.standard_normal((900, 64))).astype(np.float32)
    rows = [(int(i), v.tolist(), "a" if i < 800 else "b") for i, v in enumerate(x)]
    bad = [(5_000, None, "a"), (5_001, [0.0] * 64, "a"), (5_002, [1.0] * 63, "a"), (5_003, [float("nan")] * 64, "a"), (5_004, [float("inf")] * 64, "a"), (None, [1.0] * 64, "a")]
    df = spark.createDataFrame(rows + bad + rows[:30], "vec_id bigint, vec array<float>, model string").withColumn("id", F.lit("clash")).withColumn("found", F.lit(0))
    want = brute(x[:800].astype(float), range(800), 10) | brute(x[800:].astype(float), range(800, 900), 10)
    got = {tuple(r) for r in neighbours.neighbour_pairs(df).collect()}
    assert len(want & got) >= 0.98 * len(want) and len(got - want) <= 0.02 * len(want)
    assert neighbours.neighbour_pairs(df.limit(0)).count() == 0


@pytest.mark.parametrize("n", [300, 1_200])
def test_exact_setting_misses_nothing(spark, monkeypatch, n):
    """Without clusters, where cells prune worst; the usual setting stays above nine tenths at both sizes."""
    monkeypatch.setattr(neighbours, "CELL", 30)
    x = np.random.default_rng(n).standard_normal((n, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id bigint, vec array<float>, model string")
    want = brute(x.astype(float), range(n), 10)
    assert {tuple(r) for r in neighbours.neighbour_pairs(df, reach=1.0, deviations=float("inf")).collect()} == want
    got = {tuple(r) for r in neighbours.neighbour_pairs(df).collect()}
    assert len(want & got) >= 0.9 * len(want)


def test_centres_grow_with_the_vectors():
    sizes = [1, 10_000, 4_000_000, 40_000_000]
    assert [neighbours.centres_of(n) for n in sizes] == [1, 9, 3_906, 25_296]


def test_copies_and_few_vectors(spark):
    rng = np.random.default_rng(2)
    one, two = rng.standard_normal(64), rng.standard_normal(64)
    rows = [(i, one.tolist()) for i in range(30)] + [(100, two.tolist())]
    df = spark.createDataFrame(rows, "vec_id bigint, vec array<float>").withColumn("model", F.lit(None).cast("string"))
    got = {}
    for r in neighbours.nearest_neighbours(df).collect():
        got.setdefault(r["id"], []).append((r["place"], r["other"]))
    assert [o for _, o in sorted(got[29])] == list(range(10)) and [o for _, o in sorted(got[3])] == [0, 1, 2, *range(4, 11)] and [o for _, o in sorted(got[100])] == list(range(10))


def test_estimates_stay_within_their_bounds():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cell = neighbours.CodedCell(np.arange(400), x, x.mean(0))
    about, off = cell.estimate(x[:100])
    assert (np.abs(about - x[:100] @ x.T) <= off).mean() > 0.99


def test_cells_to_search_are_those_within_reach():
    """Against double precision, row by row, with more centres than are compared with one another at once."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((150, 64)) / 8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = (rng.standard_normal((700, 64)) / 12).astype(np.float32)
    centres[:150] = (0.9 * x).astype(np.float32)
    count, radius, limit = rng.integers(0, 3, 700), rng.uniform(0.2, 0.9, 700), rng.uniform(0.2, 1.2, 150)
    done = [rng.integers(0, 700, i % 4).tolist() for i in range(150)]
    c = centres.astype(float)
    d2 = ((x[:, None] - c[None]) ** 2).sum(2)
    own = d2.argmin(1)
    border = (d2 - d2.min(1)[:, None]) / (2 * np.maximum(np.linalg.norm(c[own][:, None] - c[None], axis=2), 1e-9))
    for reach in (0.4, 1.0):
        slack = lambda e: (border < reach * limit[:, None] + e) & (np.sqrt(d2) - radius < limit[:, None] + e) & (count > 0)  # noqa: B023, E731
        searched = lambda i: set(done[i])
        rows, cells = neighbours.border_cells(x, limit, done, centres, count, radius, reach)
        few = neighbours.border_cells(x, limit, done, centres, count, radius, reach, 2)
        for i in range(150):
            got = set(cells[rows == i].tolist())
            assert set(np.flatnonzero(slack(-1e-9)[i])) - searched(i) <= got <= set(np.flatnonzero(slack(1e-3)[i])) - searched(i)
            first = few[1][few[0] == i]
            assert len(first) == min(2, len(got)) and (not len(first) or border[i, first].max() <= sorted(border[i, list(got)])[len(first) - 1] + 1e-3)


def test_what_is_below_the_kth_of_other_cells_is_left_out():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cell = neighbours.CodedCell(np.arange(500), x, x.mean(0))
    floor = np.where(np.arange(100) % 3 == 0, -np.inf, np.sort(x[:100] @ x.T)[:, -4])
    rows, keys, sims = cell.search(x[:100], 11, floor)
    plain = cell.search(x[:100], 11)
    for i in range(100):
        whole = list(zip(plain[1][plain[0] == i], plain[2][plain[0] == i], strict=True))
        assert list(zip(keys[rows == i], sims[rows == i], strict=True)) == (whole if i % 3 == 0 else whole[:4])


def test_bins_hold_cells_near_one_another():
    rng = np.random.default_rng(6)
    count = np.append(rng.integers(0, 90, 200), 1_000)
    first, bins = neighbours.bins_of(rng.standard_normal((201, 64)), count, 256)
    assert bins[200] == 4 and (bins[:200] == 1).all() and first[200] not in first[:200]
    sizes = np.bincount(first[:200], count[:200])
    assert sizes.max() <= 256 and set(range(first.max() + 1)) >= set(first.tolist()) and sizes.sum() == count[:200].sum()
