"""Typed extraction per chunk: a provider is called, what it answers is checked, and every chunk ends as a card or in quarantine."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import estimate_tokens
from ..session import cut, on_workers
from .catalog import done_keys, still_to_do
from .leases import Leases
from .provider import Gate, Ladder, Provider, climb
from .scoring import compare_readings, gate, meter

ENTITY = "struct<name:string,kind:string,aliases:array<string>>"
CLAIM = "struct<subject:string,predicate:string,object_text:string,polarity:int,confidence:double,claim_time:string,span:struct<span_start:int,span_end:int>>"
QUOTE = "struct<text:string,span_start:int,span_end:int>"
CARD = f"entities array<{ENTITY}>, claims array<{CLAIM}>, quotes array<{QUOTE}>, topics array<string>, style struct<voice:string,language:string>, notes string"
USAGE = "struct<hit:bigint,miss:bigint,out:bigint,reasoning:bigint>"


def carve_object(text: str) -> dict:
    """The JSON object in an answer, whatever stands around it."""
    start, end = text.find("{"), text.rfind("}")
    if start < 0 or end <= start:
        raise ValueError("no object")
    found = json.loads(text[start : end + 1])
    if not isinstance(found, dict):
        raise ValueError("no object")
    return found


def checked_card(raw: dict) -> dict:
    """A card with defaults for what is missing; numbers written as text are numbers, nested parts must be whole."""

    def part(x: dict, needed: tuple[str, ...], fields: dict[str, type | None]) -> dict:
        if not isinstance(x, dict) or any(x.get(k) is None for k in needed):
            raise ValueError(f"a part without {' and '.join(needed)}")
        return {k: (None if x.get(k) is None else t(x[k]) if t else x[k]) for k, t in fields.items()}

    def span(x: dict | None) -> dict | None:
        return None if x is None else part(x, ("span_start", "span_end"), {"span_start": int, "span_end": int})

    listed = lambda k: raw.get(k) if isinstance(raw.get(k), list) else []
    claims = [part(c, ("subject", "predicate"), {"subject": str, "predicate": str, "object_text": str, "polarity": int, "confidence": float, "claim_time": str}) | {"span": span(c.get("span"))} for c in listed("claims")]
    style = raw.get("style") if isinstance(raw.get("style"), dict) else {}
    return {
        "entities": [part(e, ("name",), {"name": str, "kind": str, "aliases": list}) for e in listed("entities")],
        "claims": claims,
        "quotes": [part(q, ("text",), {"text": str, "span_start": int, "span_end": int}) for q in listed("quotes")],
        "topics": [str(t) for t in listed("topics")],
        "style": {"voice": style.get("voice"), "language": style.get("language")},
        "notes": raw.get("notes"),
    }


def read_chunks(chunks: DataFrame, provider: Provider, ladder: Ladder = Ladder()) -> DataFrame:
    """(doc_id, seq, card fields, usage_tokens, model, reason): one row per chunk, `reason` null where it has a card.

    Calls of a batch run side by side, as many as the process's gate lets through. A null text is missing.
    """
    schema = f"doc_id string, seq int, {CARD}, usage_tokens {USAGE}, model string, reason string"
    names = ["entities", "claims", "quotes", "topics", "style", "notes"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_gate = Gate()

        def one(row) -> tuple:
            card, reason, used = (None, "text_missing", None) if row.text is None else climb(provider, row.header, row.text, lambda t: checked_card(carve_object(t)), ladder, open_gate)
            usage = {k: getattr(used, k, 0) for k in ("hit", "miss", "out", "reasoning")}
            return row.doc_id, row.seq, *[(card or {}).get(n) for n in names], usage, getattr(used, "model", ""), reason

        with ThreadPoolExecutor(ladder.threads) as pool:
            for b in batches:
                yield pd.DataFrame(list(pool.map(one, b.itertuples(index=False))), columns=["doc_id", "seq", *names, "usage_tokens", "model", "reason"])

    return on_workers(chunks.select("doc_id", "seq", "header", "text")).mapInPandas(read, schema)


class Halted(Exception):
    """A reading pass that stopped between batches, with all that was read kept."""


def golden_mean(golden: DataFrame, again: DataFrame) -> float:
    """Mean score of golden chunks read again; what is in quarantine or missing counts 0, and no golden chunks are 0."""
    scored = compare_readings(golden, again.where("reason is null")).agg(F.sum("score")).first()[0] or 0.0
    n = golden.count()
    return scored / n if n else 0.0


def dry_run(chunks: DataFrame, cards: DataFrame | None, batch_rows: int = 10_000, cap: float = 1.0, sample: int = 200) -> DataFrame:
    """One row: what a reading pass would do and cost at worst and realistically, whether it would be refused, and how many of a sample can be read."""
    todo = chunks if cards is None else still_to_do(chunks, done_keys(cards))
    seen = todo.orderBy(F.xxhash64("doc_id", "seq")).limit(sample).agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("text").isNotNull()).alias("readable"))
    cost = gate(todo.select(estimate_tokens(F.coalesce("text", F.lit(""))).alias("tokens")), cap).withColumn("batches", F.ceil(F.col("rows") / batch_rows).cast("bigint"))
    return cost.join(F.broadcast(seen))  # one row each


def reading_pass(
    chunks: DataFrame, cards: DataFrame | None, provider: Provider, save: Callable[[DataFrame], None], batch_rows: int = 10_000, bar: float = 0.55, golden: DataFrame | None = None,
    most_usd: float | None = None, calibrate_every: int = 50, ladder: Ladder = Ladder(), leases: Leases | None = None,
) -> int:
    """Read what has no card yet, batch by batch, and hand each batch to `save`; returns the number of batches.

    A pass whose worst cost is above `most_usd` doesn't begin. One call is made alone first, so that a provider
    that can't work fails before many are made. Before every `calibrate_every`-th batch the golden chunks
    (doc_id, seq, header, text and a reference card) are read again and scored; below `bar`, above `most_usd`
    or when a second model answers, whose rows aren't saved, the pass halts. A rerun goes on where the last one
    stopped; where `leases` says that another pass is running, this one doesn't begin.
    """
    if leases is not None and not leases.take("pass"):
        raise Halted("another pass is reading")
    try:
        todo = chunks if cards is None else still_to_do(chunks, done_keys(cards))
        todo = cut(todo.withColumn("__n", F.pmod(F.xxhash64("doc_id", "seq"), F.lit(1 << 20))))
        total = todo.count()
        if most_usd is not None and total and (cost := gate(todo.select(estimate_tokens(F.coalesce("text", F.lit(""))).alias("tokens")), most_usd).first())["refused"]:
            raise Halted(f"it would cost up to {cost['worst_usd']:.4f} of {most_usd}")
        if (first := todo.where("text is not null").select("header", "text").first()) is not None:
            provider(first["header"], first["text"], ladder.most_out)
        batches = -(-total // batch_rows)
        spent, pinned = 0.0, None
        for k in range(batches):
            if leases is not None and not leases.renew("pass"):
                raise Halted("another pass has taken over")
            if golden is not None and k % calibrate_every == 0 and (mean := golden_mean(golden, read_chunks(golden, provider, ladder))) < bar:
                raise Halted(f"calibration {mean:.3f} is below {bar}")
            width = (1 << 20) / batches
            part = cut(read_chunks(todo.where((F.col("__n") >= int(k * width)) & (F.col("__n") < (int((k + 1) * width) if k + 1 < batches else 1 << 20))), provider, ladder))
            models = [r[0] for r in part.where("model != ''").groupBy("model").count().orderBy(F.desc("count"), "model").limit(3).collect()]
            pinned = pinned or next(iter(models), None)
            save(part.where(F.col("model").isin("", pinned or "")))
            spent += meter(part).first()["usd"]
            if others := [m for m in models if m != pinned]:
                raise Halted(f"the model changed from {pinned} to {', '.join(others)}")
            if most_usd is not None and spent > most_usd:
                raise Halted(f"{spent:.4f} spent of {most_usd}")
        return batches
    finally:
        if leases is not None:
            leases.release("pass")


def backfill_vectors(chunks: DataFrame, vectors: DataFrame, embed: Callable[[list[str]], list[list[float]]], model: str, group: int = 16, most_chars: int = 8_000) -> DataFrame:
    """(doc_id, seq, dim, vec, model, reason) for chunks that have no vector, embedded some at a time.

    The embedder sees the first `most_chars` characters of a text, a fixed limit, and nothing after them. After
    an error of the embedder a task goes no further: groups before it have their vectors, the rest have a
    null vector and `reason`, as have chunks whose text is missing.
    """
    todo = still_to_do(chunks, vectors).select("doc_id", "seq", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failed = None
        for b in batches:
            vec: list[list[float] | None] = [None] * len(b)
            reason: list[str | None] = ["text_missing" if t is None else None for t in b["text"]]
            there = [i for i, t in enumerate(b["text"]) if t is not None]
            for start in range(0, len(there), group):
                part = there[start : start + group]
                try:
                    found = None if failed else embed([b["text"].iloc[i][:most_chars] for i in part])
                except Exception as e:  # noqa: BLE001  whatever an embedder raises
                    failed, found = f"embedder: {e}", None
                for j, i in enumerate(part):
                    vec[i], reason[i] = (found[j], None) if found is not None else (None, failed)
            yield pd.DataFrame({"doc_id": b["doc_id"], "seq": b["seq"], "dim": pd.array([None if v is None else len(v) for v in vec], "Int32"), "vec": vec, "model": model, "reason": reason})

    return on_workers(todo).mapInPandas(run, "doc_id string, seq int, dim int, vec array<float>, model string, reason string")
