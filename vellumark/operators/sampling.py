"""Stratified samples, budgets and batches."""

from __future__ import annotations

import re
from fnmatch import translate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, on_workers
from .ranking import with_group_prefix_sum, with_sorted_rank

#: Rows in order that one task packs, and such runs that one task links; the batches don't depend on either.
PACK_ROWS, PACK_RUNS = 10_000, 1_000


def glob_regex(pattern: str) -> str:
    """A regular expression for a path glob: ** spans segments, * and ? stay in one, a bare name matches at any depth."""
    out, i = "", 0
    if "/" not in pattern:
        out = "(?:.*/)?"
    while i < len(pattern):
        if pattern.startswith("**/", i):
            out, i = out + "(?:.*/)?", i + 3
        elif pattern.startswith("**", i):
            out, i = out + ".*", i + 2
        elif pattern[i] in "*?":
            out, i = out + ("[^/]*" if pattern[i] == "*" else "[^/]"), i + 1
        else:
            out, i = out + re.escape(pattern[i]), i + 1
    return f"(?i)^{out}$"


def path_matches(path: Column, include: list[str], exclude: list[str] = ()) -> Column:
    """'internal', 'not_included', 'excluded' or 'admitted' of a path, in that order."""
    any_of = lambda globs: F.lit(False) if not globs else F.greatest(*[path.rlike(glob_regex(g)) for g in globs], F.lit(False))
    # An archive's own folders.
    internal = F.lower(F.split_part(path, F.lit("/"), F.lit(1))).isin("tape", "runs", "catalog", "codex", "certificate")
    return F.when(internal, "internal").when(~any_of(include), "not_included").when(any_of(list(exclude)), "excluded").otherwise("admitted")


def project_matches(project: Column, globs: list[str]) -> Column:
    """Whether a project, in lower case, matches any of some shell patterns, in which * crosses slashes."""
    patterns = [f"^{translate(g.lower()).removeprefix('(?s:').removesuffix(')\\Z').removesuffix(')\\z')}$" for g in globs]
    return F.lower(project).rlike("|".join(patterns)) if patterns else F.lit(True)


def sample_budget(corpus_tokens: Column) -> Column:
    return F.least(F.greatest(F.floor(corpus_tokens * 0.02), F.lit(200_000)), F.lit(6_000_000))


def stratified_sample(rows: DataFrame, budget: int, seed: str = "7", least: int = 60) -> DataFrame:
    """Rows of every (year, project), in an order shuffled by `seed`, until each has its share of the budget.

    A cell's share follows its tokens but is never below the smaller of its tokens and `least`. A row is
    taken if what was taken of its cell before it is below the share, so every cell has a row. The shuffle
    is by hash and the sums are made bucket by bucket: a project with a third of all rows is no single task.
    """
    cells = rows.groupBy("year", "project").agg(F.sum("tokens").alias("__cell"))
    total = cells.agg(F.sum("__cell").alias("__total"))
    share = F.greatest(budget * F.col("__cell") / F.col("__total"), F.least("__cell", F.lit(least)))
    shares = cells.join(F.broadcast(total)).select(F.col("year").alias("__y"), F.col("project").alias("__p"), share.alias("__share"))
    mixed = rows.withColumn("mix", F.md5(F.concat_ws("|", F.lit(seed), "doc_id", F.col("seq").cast("string"))))
    summed = with_group_prefix_sum(mixed, ["year", "project"], F.substring("mix", 1, 2), ["mix", "doc_id", "seq"], "tokens")
    on = F.col("year").eqNullSafe(F.col("__y")) & F.col("project").eqNullSafe(F.col("__p"))
    return summed.join(shares, on).where(F.col("before") < F.col("__share")).drop("__y", "__p", "__share", "mix")


def within_budget(rows: DataFrame, most: int) -> DataFrame:
    """Rows in order of (project, doc_id, seq) as long as their tokens together stay within `most`; 0 is no limit."""
    if not most:
        return rows
    summed = with_group_prefix_sum(rows, [], F.struct("project", F.substring("doc_id", 1, 2).alias("d")), ["project", "doc_id", "seq"], "tokens")
    return summed.where(F.col("before") + F.coalesce("tokens", F.lit(0)) <= most).drop("before")


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with `position`, from 0, in the whole table's order."""
    return with_sorted_rank(rows, [], order, "position")


def fixed_batches(rows: DataFrame, order: list[str], size: int = 48) -> DataFrame:
    return numbered(rows, order).withColumn("batch", F.floor(F.col("position") / size).cast("bigint")).drop("position")


def every_nth(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The rows at positions 0, n, 2n ... of the whole table's order, with `position`."""
    return numbered(rows, order).where(F.col("position") % n == 0)


class Passage:
    """What a run of rows does to an open batch: filled at its start -> (filled at its end, batches begun).

    For `filled` up to `most_kept` no row overflows and the run adds `total`; above that the steps apply,
    each from its least `filled` on: the run's first break is then at one row, and what follows is the same.
    """

    def __init__(self, least: list[int], filled: list[int], begun: list[int], most_kept: int, total: int):
        self.least, self.filled, self.begun, self.most_kept, self.total = least, filled, begun, most_kept, total

    def __call__(self, filled: int) -> tuple[int, int]:
        if filled <= self.most_kept:
            return filled + self.total, 0
        k = int(np.searchsorted(self.least, filled, "right")) - 1
        return int(self.filled[k]), int(self.begun[k])

    def then(self, after: Passage) -> Passage:
        """Both passages as one."""
        least, filled, begun = [], [], []
        kept = min(self.most_kept, after.most_kept - self.total)
        # Below most_kept the first run only adds, so the second's steps count, moved down by what was added.
        starts = sorted({x - self.total for x in after.least if kept < x - self.total <= self.most_kept} | ({kept + 1} if kept < self.most_kept else set()) | {x for x in self.least})
        for x in starts:
            one, n = self(x)
            two, m = after(one)
            least.append(x), filled.append(two), begun.append(n + m)
        return Passage(least, filled, begun, kept, self.total + after.total)


def passage(tokens: np.ndarray, most: int) -> Passage:
    """The passage of rows of these sizes."""
    upto = np.concatenate([[0], np.cumsum(tokens)])
    n = len(tokens)
    # after[k]: the first row that no longer fits a batch begun at row k, which holds its first row in any case.
    after = np.maximum(np.searchsorted(upto, upto[:-1] + most, "right") - 1, np.arange(n) + 1)
    breaks = [k for k in range(n) if upto[k] <= most and (k == 0 or tokens[k] > 0)]  # rows that may be the first to overflow
    out: dict[int, tuple[int, int]] = {}
    for k in breaks[::-1]:
        chain, at = [], k
        while at < n and at not in out:
            chain.append(at)
            at = int(after[at])
        for c in reversed(chain):
            to = int(after[c])
            out[c] = (int(upto[n] - upto[c]), 1) if to >= n else (out[to][0], out[to][1] + 1)
    # Row k overflows first for filled above most - upto[k + 1] that row k - 1 still fitted.
    steps = sorted((max(0, int(most - upto[k + 1] + 1)), k) for k in breaks)
    merged: dict[int, int] = {}
    for x, k in steps:
        merged[x] = min(k, merged.get(x, k))
    least = sorted(merged)
    return Passage(least, [out[merged[x]][0] for x in least], [out[merged[x]][1] for x in least], int(most - upto[n]), int(upto[n]))


_PASSAGE = "least array<bigint>, filled array<bigint>, begun array<bigint>, most_kept bigint, total bigint"


def _read_passage(row) -> Passage:
    return Passage(list(row.least), list(row.filled), list(row.begun), int(row.most_kept), int(row.total))


def greedy_batches(rows: DataFrame, order: list[str], most: int, run: int = PACK_ROWS, runs: int = PACK_RUNS) -> DataFrame:
    """rows with `batch`: in order, a new batch where the next row would exceed `most`, as in one pass over all rows.

    A row above `most` is a batch of its own; null and negative sizes count as 0. What a run of rows does to
    the batch that is open at its start is a small step function; these are linked in groups, then the groups,
    and each run is packed from the state it is reached in. So no task holds more than a run of rows, or
    the functions of `runs` runs.
    """
    size = F.greatest(F.coalesce("tokens", F.lit(0)), F.lit(0)).cast("bigint")
    placed = cut(numbered(rows, order).withColumn("__run", F.floor(F.col("position") / run).cast("bigint")).withColumn("__size", size))

    def passages(g: pd.DataFrame) -> pd.DataFrame:
        p = passage(g.sort_values("position")["__size"].to_numpy(), most)
        return pd.DataFrame([(g["__run"].iloc[0], p.least, p.filled, p.begun, p.most_kept, p.total)], columns=["run", "least", "filled", "begun", "most_kept", "total"])

    each = cut(on_workers(placed.select("__run", "position", "__size")).groupBy("__run").applyInPandas(passages, f"run bigint, {_PASSAGE}").withColumn("group", F.floor(F.col("run") / runs)))

    def linked(g: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for row in g.sort_values("run").itertuples():
            p = _read_passage(row)
            whole = p if whole is None else whole.then(p)
        return pd.DataFrame([(g["group"].iloc[0], whole.least, whole.filled, whole.begun, whole.most_kept, whole.total)], columns=["run", "least", "filled", "begun", "most_kept", "total"])

    def entered(g: pd.DataFrame) -> pd.DataFrame:
        """The state in which each of some runs in order is reached."""
        filled, batch, out = (0, 0, []) if "filled_at" not in g else (int(g["filled_at"].iloc[0]), int(g["batch_at"].iloc[0]), [])
        for row in g.sort_values("run").itertuples():
            out.append((row.run, filled, batch))
            filled, begun = _read_passage(row)(filled)
            batch += begun
        return pd.DataFrame(out, columns=["run", "filled_at", "batch_at"])

    state = "run bigint, filled_at bigint, batch_at bigint"
    groups = each.groupBy("group").applyInPandas(linked, f"run bigint, {_PASSAGE}")
    # One row for each run x runs rows of the table, ten million.
    at_groups = groups.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(entered, state)
    at_runs = each.join(at_groups.withColumnRenamed("run", "group"), "group").groupBy("group").applyInPandas(entered, state)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    kept = rows.columns

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("position")
        filled, batch, out = int(g["filled_at"].iloc[0]), int(g["batch_at"].iloc[0]), []
        begun = g["position"].iloc[0] > 0
        for tokens in g["__size"].tolist():
            if begun and filled + tokens > most:
                batch, filled = batch + 1, 0
            filled, begun = filled + tokens, True
            out.append(batch)
        return g.assign(batch=out)[[*kept, "batch"]]

    return placed.join(at_runs.withColumnRenamed("run", "__run"), "__run").groupBy("__run").applyInPandas(pack, f"{fields}, batch bigint")


def rotating_subset(shards: DataFrame, key: str, turn: int, size: int = 16) -> DataFrame:
    """The `size` shards of a turn: positions turn*size, turn*size + 1, ... in order of `key`, counted round in a circle."""
    w = Window.orderBy(key)  # shards are a hand-made set of some dozens
    n = shards.withColumn("position", F.row_number().over(w) - 1).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    return n.where(F.pmod(F.col("position") - F.lit(turn * size), F.col("__n")) < F.least(F.lit(size), F.col("__n"))).drop("__n")
