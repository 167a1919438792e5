"""Rebuilding conversations from message rows (problem 7).

Rows are keyed by session and ordered by their depth in the chain of parents and then by time, or by time
alone where a session has no parents; a finite-state automaton then reads each session's roles. The automaton runs over blocks of
turns whose transition tables are composed afterwards, so a session of any length is split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from ..operators.ranking import with_sorted_rank

#: Sessions of up to so many rows are put in order in one task, longer ones by joins; both give the same order.
ONE_TASK_ROWS = 20_000
#: Order of the rows of a level, or of a session without parents; it tells all distinct rows apart.
IN_TIME = ["ts", "line_no", "what", "id", "parent"]
#: Turns that one run of the automaton reads.
BLOCK_TURNS = 4_096

# Names of the speakers' roles.
USER_ROLES = ("user", "human")
ASSISTANT_ROLES = ("assistant", "ai", "model", "bot", "gpt")
# Characters that show nothing, as a regular expression class.
INVISIBLE = r"\s\p{Z}\p{Cc}\p{Cf}\x{34F}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180E}\x{2800}\x{3164}\x{FE00}-\x{FE0F}\x{FFA0}"

# States: 0 nothing yet, 1 after the user, 2 after the assistant, 3 broken.
ON_USER, ON_ASSISTANT, ACCEPTING = (1, 3, 1, 3), (3, 2, 2, 3), 2


def speaker(role: Column, line_type: Column) -> Column:
    """user, assistant or other; a missing or blank role is taken from the line's type."""
    said = F.lower(F.trim(role))
    name = F.when(F.coalesce(said, F.lit("")) != "", said).otherwise(F.lower(F.trim(line_type)))
    return F.when(name.isin(*USER_ROLES), "user").when(name.isin(*ASSISTANT_ROLES), "assistant").otherwise("other")


def read_content(df: DataFrame) -> DataFrame:
    """Adds `words` (string) and `is_cut` (boolean) for `content`: plain text or a JSON list of typed items.

    The words of a list are those of its items of type text, joined by line ends. A list is cut off when it
    begins like one of typed items and isn't JSON. Text that merely starts with a bracket is plain text.
    """
    listed = F.col("content").rlike(r"^\s*\[\s*(\{|\]|$)")
    begun = F.col("content").rlike(r'(?s)^\s*\[\s*(\{\s*("[A-Za-z_]*("\s*(:.*)?)?)?)?$')
    parsed = F.try_parse_json(F.when(listed, F.col("content")))
    items = F.from_json(F.when(F.col("__json").isNotNull(), F.col("content")), "array<struct<type:string,text:string>>")
    said = F.array_join(F.transform(F.filter(items, lambda i: (i["type"] == "text") & i["text"].isNotNull()), lambda i: i["text"]), "\n")
    return (
        df.withColumn("__json", parsed)
        .withColumn("is_cut", F.coalesce(begun & F.col("__json").isNull(), F.lit(False)))
        .withColumn("words", F.when(F.col("__json").isNotNull(), said).when(F.col("is_cut"), F.lit("")).otherwise(F.coalesce("content", F.lit(""))))
        .drop("__json")
    )


def message_rows(lines: DataFrame, with_words: bool) -> DataFrame:
    """One row per distinct line: session_id, line_no, id, parent, ts, speaker, is_message, is_cut[, words].

    Repeated rows, which differ in ingested_at alone, become one. Rows without session are left out.
    """
    read = read_content(lines.select("session_id", "line_no", "msg_uuid", "parent_uuid", "line_type", "role", "content", "ts").where(F.col("session_id").isNotNull()))
    who = speaker(F.col("role"), F.col("line_type"))
    fields = [
        "session_id", "line_no", F.col("msg_uuid").alias("id"), F.col("parent_uuid").alias("parent"), "ts", who.alias("speaker"),
        ((who != "other") & F.col("words").rlike(f"[^{INVISIBLE}]")).alias("is_message"), "is_cut", F.xxhash64("content", "line_type", "role").alias("what"),
    ]
    distinct = ["session_id", "line_no", "id", "parent", "ts", "speaker", "is_message", "is_cut", "what"]
    return read.select(*fields, *(["words"] if with_words else [])).dropDuplicates(distinct)


def _chain_places(ids: list, parents: list) -> list[int]:
    """Positions of the rows of one session, which come in order of time, by depth below a row without parent.

    Forks and several roots come level by level, each level in order of time. Rows without a root above them
    (on or below a circle, or below a parent that isn't there) come after the rest, in order of time.
    """
    at = {v: i for i, v in enumerate(ids) if v is not None}
    below: dict[int, list[int]] = {}
    level = []
    for i, p in enumerate(parents):
        if p is None:
            level.append(i)
        elif (to := at.get(p, i)) != i:
            below.setdefault(to, []).append(i)
    place: dict[int, int] = {}
    while level:
        for i in level:
            place[i] = len(place)
        level = sorted(j for i in level for j in below.get(i, ()))
    for i in range(len(ids)):
        place.setdefault(i, len(place))
    return [place[i] for i in range(len(ids))]


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds `at` to rows that come by session and in order of time; a session may run over batches."""
    rest: pd.DataFrame | None = None

    def placed(rows: pd.DataFrame) -> pd.DataFrame:
        sessions, ids, parents = (rows[c].tolist() for c in ("session_id", "id", "parent"))
        at: list[int] = []
        begin = 0
        for end in range(1, len(sessions) + 1):
            if end == len(sessions) or sessions[end] != sessions[begin]:
                at.extend(_chain_places(ids[begin:end], parents[begin:end]))
                begin = end
        out = rows.drop(columns=["parent"])
        out["at"] = at
        return out

    for batch in batches:
        if not len(batch):
            continue
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = rows["session_id"].iloc[-1]
        first_of_last = int((rows["session_id"] == last).to_numpy().argmax())
        rest = rows.iloc[first_of_last:]
        if first_of_last:
            yield placed(rows.iloc[:first_of_last])
    if rest is not None:
        yield placed(rest)


def ordered_messages(rows: DataFrame) -> DataFrame:
    """Messages with `turn`, 0-based and dense inside each session; the columns of message_rows else.

    Short sessions are put in order in one task each. In long ones the depth in the chain is found by
    doubling pointers, which takes as many joins as the logarithm of the chain's length; long sessions
    without parents are ranked by time, range by range.
    """
    has_words = ["words"] if "words" in rows.columns else []
    columns = ["session_id", "turn", "speaker", "line_no", "id", "ts", *has_words]
    shape = rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("__rows"), F.max(F.col("parent").isNotNull()).alias("__chained"))
    rows = rows.join(shape, "session_id")
    small = F.col("__rows") <= ONE_TASK_ROWS

    timed = rows.where(small & ~F.col("__chained") & F.col("is_message"))
    by_time = Window.partitionBy("session_id").orderBy(*IN_TIME)
    short_timed = timed.withColumn("turn", (F.row_number().over(by_time) - 1).cast("bigint")).select(*columns)

    chained = rows.where(small & F.col("__chained"))
    kept = [c for c in rows.columns if not c.startswith("__")]
    fields = [f for f in rows.schema.fields if f.name in kept and f.name != "parent"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", at bigint"
    sorted_rows = chained.select(*kept).repartition("session_id").sortWithinPartitions("session_id", *IN_TIME)
    walked = sorted_rows.mapInPandas(_walk, schema).where("is_message")
    by_chain = Window.partitionBy("session_id").orderBy("at")
    short_chained = walked.withColumn("turn", (F.row_number().over(by_chain) - 1).cast("bigint")).select(*columns)

    result = short_timed.unionByName(short_chained)
    long = rows.where(~small)
    kinds = {r[0] for r in shape.where(F.col("__rows") > ONE_TASK_ROWS).select("__chained").distinct().collect()}  # at most two rows
    if False in kinds:
        messages = long.where(~F.col("__chained") & F.col("is_message"))
        result = result.unionByName(with_sorted_rank(messages, ["session_id"], IN_TIME, "turn").select(*columns))
    if True in kinds:
        result = result.unionByName(_long_chains(long.where("__chained")).select(*columns))
    return result


def _long_chains(rows: DataFrame) -> DataFrame:
    """Turns of the messages of long sessions, in the order of _chain_places, by doubling pointers up the chain of parents."""
    rows = cut(rows.withColumn("__n", F.monotonically_increasing_id()))
    # An id that several rows carry names the last of them, as in _chain_places; every row has one row above it at most.
    named = rows.where(F.col("id").isNotNull()).groupBy("session_id", F.col("id").alias("parent")).agg(F.max_by("__n", F.struct(*IN_TIME)).alias("up"))
    # Rows whose parent is missing or themselves, and in the end those on circles, have no root above them and get no depth.
    rooted = F.col("parent").isNull() | (F.col("up") != F.col("__n"))
    state = cut(rows.select("session_id", "__n", "parent").join(named, ["session_id", "parent"], "left").where(rooted).select("__n", "up", F.lit(1).cast("bigint").alias("depth")))
    longest = rows.groupBy("session_id").count().agg(F.max("count")).first()[0] or 0
    # No chain is longer than its session, so what hasn't ended after these rounds is on a circle or below one.
    for _ in range(int(longest).bit_length()):
        if state.where(F.col("up").isNotNull()).limit(1).count() == 0:
            break
        hop = state.select(F.col("__n").alias("up"), F.col("up").alias("__up"), F.col("depth").alias("__depth"))
        ended = state.where(F.col("up").isNull())
        moved = state.where(F.col("up").isNotNull()).join(hop, "up").select("__n", F.col("__up").alias("up"), (F.col("depth") + F.col("__depth")).alias("depth"))
        state = cut(ended.unionByName(moved))
    depths = state.where(F.col("up").isNull()).select("__n", "depth")
    placed = rows.join(depths, "__n", "left").where("is_message").withColumn("depth", F.coalesce("depth", F.lit(2**62)))
    return with_sorted_rank(placed, ["session_id"], ["depth", *IN_TIME], "turn")


def run_automaton(messages: DataFrame) -> DataFrame:
    """(session_id, turns, end_state): the automaton's state after all turns of each session."""
    # One transition table per block of turns, as the state reached from each of the four.
    step = lambda state, who: F.when(who == "user", F.element_at(F.array(*map(F.lit, ON_USER)), state + 1)).otherwise(F.element_at(F.array(*map(F.lit, ON_ASSISTANT)), state + 1))
    blocks = messages.groupBy("session_id", F.floor(F.col("turn") / BLOCK_TURNS).alias("block")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "speaker"))), lambda x: x["speaker"]).alias("who"), F.count(F.lit(1)).alias("n"))
    tables = blocks.select("session_id", "block", "n", F.array(*[F.aggregate("who", F.lit(s), step) for s in range(4)]).alias("to"))
    # A session of a billion turns has 250,000 blocks of four numbers each.
    whole = tables.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("block", "to"))).alias("blocks"), F.sum("n").alias("turns"))
    return whole.select("session_id", "turns", F.aggregate("blocks", F.lit(0), lambda s, b: F.element_at(b["to"], s + 1)).alias("end_state"))


def judged_sessions(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """(session_id, turns, is_cut, is_dangling, is_broken) for every session; drop it if any of the three holds."""
    whole = rows.groupBy("session_id").agg(F.max("is_cut").alias("is_cut"))
    known = rows.where(F.col("id").isNotNull()).select("session_id", F.col("id").alias("parent")).distinct()
    dangling = rows.where(F.col("parent").isNotNull()).select("session_id", "parent").distinct().join(known, ["session_id", "parent"], "left_anti").select("session_id").distinct().withColumn("is_dangling", F.lit(True))
    read = run_automaton(messages)
    return (
        whole.join(dangling, "session_id", "left")
        .join(read, "session_id", "left")
        .select("session_id", F.coalesce("turns", F.lit(0)).alias("turns"), "is_cut", F.coalesce("is_dangling", F.lit(False)).alias("is_dangling"), (F.coalesce("end_state", F.lit(0)) != ACCEPTING).alias("is_broken"))
    )


def broken_sessions(lines: DataFrame) -> DataFrame:
    """session_id of sessions to drop: without message, not begun by the user, with a user message left
    without reply, with a parent that names no row, or with a content list that is cut off.

    Sessions that are null are no sessions; null contents have no words; empty input gives an empty table.
    """
    rows = cut(message_rows(lines, with_words=False))
    judged = judged_sessions(rows, ordered_messages(rows))
    return judged.where(F.col("is_cut") | F.col("is_dangling") | F.col("is_broken")).select("session_id")


def conversations(lines: DataFrame) -> DataFrame:
    """(session_id, turn, speaker, words) of the sessions that are whole, one row per message in order."""
    rows = cut(message_rows(lines, with_words=True))
    messages = cut(ordered_messages(rows))  # put in order once, read by the automaton and by the join
    judged = judged_sessions(rows.drop("words"), messages)
    whole = judged.where(~(F.col("is_cut") | F.col("is_dangling") | F.col("is_broken"))).select("session_id")
    return messages.join(whole, "session_id", "left_semi").select("session_id", "turn", "speaker", "words")
