"""Calls to a provider of cards: what an answer is, how a call is retried, and how many run at once."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class Answer:
    """What a provider says about one chunk: its raw text, and what that took."""

    text: str
    hit: int = 0
    miss: int = 0
    out: int = 0
    model: str = ""
    reasoning: int = 0


#: Called with a chunk's header, its text and the most tokens the answer may have; must be picklable, runs on the executors.
Provider = Callable[[str, str, int], Answer]


class Refused(Exception):
    """A provider's typed refusal; the chunk ends in quarantine."""


class Unreached(Exception):
    """The provider couldn't be reached or was too busy; the call may be made again."""

    def __init__(self, detail: str = "", status: int | None = None):
        super().__init__(detail)
        self.status = status


class Gate:
    """How many calls of a process run at once: halved when the provider is too busy, some more again with each quiet minute."""

    def __init__(self, most: int = 1_024, step: int = 64, clock: Callable[[], float] = time.monotonic):
        self.most, self.step, self.clock = most, step, clock
        self._limit, self._since, self._running = most, clock(), 0
        self._free = threading.Condition()

    @property
    def limit(self) -> int:
        minutes = int((self.clock() - self._since) // 60)
        if minutes:
            self._limit, self._since = min(self.most, self._limit + minutes * self.step), self._since + 60 * minutes
        return self._limit

    def ease(self) -> None:
        with self._free:
            self._limit, self._since = max(1, self.limit // 2), self.clock()

    def __enter__(self) -> Gate:
        with self._free:
            while self._running >= self.limit:
                self._free.wait(0.05)
            self._running += 1
        return self

    def __exit__(self, *_: Any) -> None:
        with self._free:
            self._running -= 1
            self._free.notify()


@dataclass(frozen=True)
class Ladder:
    """How far a chunk is tried: some same calls, each with more room if the last ran out of it, then a rescue, then quarantine."""

    tries: int = 3
    most_out: int = 6_000
    # An answer that used such a share of its room gets that many times as much, up to a ceiling.
    used_up: float = 0.85
    growth: int = 3
    ceiling: int = 131_072
    #: Turns an answer that can't be read into one that can, without the provider.
    rescue: Callable[[str], str] | None = None
    # Calls until a provider counts as out of reach, and the wait between them, doubled each time.
    reaches: int = 7
    wait: float = 1.0
    longest_wait: float = 30.0
    threads: int = 8
    sleep: Callable[[float], None] = field(default=time.sleep)


def reach(provider: Provider, header: str, text: str, most_out: int, ladder: Ladder, gate: Gate) -> Answer:
    """One answer; a provider that is busy or out of reach is called again, waiting outside the gate."""
    wait = ladder.wait
    for k in range(ladder.reaches):
        try:
            with gate:
                return provider(header, text, most_out)
        except Unreached as e:
            gate.ease()
            if k + 1 == ladder.reaches:
                raise Refused(f"transport: {e}") from e
        ladder.sleep(wait)
        wait = min(2 * wait, ladder.longest_wait)
    raise AssertionError("a ladder reaches once at least")


def climb(provider: Provider, header: str, text: str, read: Callable[[str], Any], ladder: Ladder, gate: Gate) -> tuple[Any, str | None, Answer]:
    """(what was read, None, usage) or (None, typed reason, usage) of a chunk; the usage is that of all its calls together."""
    used, room, reason, last = Answer(""), ladder.most_out, "no_answer", ""
    for _ in range(ladder.tries):
        try:
            answer = reach(provider, header, text, room, ladder, gate)
        except Refused as e:
            return None, f"refused: {e}", used
        used = replace(used, hit=used.hit + answer.hit, miss=used.miss + answer.miss, out=used.out + answer.out, reasoning=used.reasoning + answer.reasoning, model=answer.model or used.model)
        last = answer.text
        try:
            return read(answer.text), None, used
        except (ValueError, TypeError) as e:
            reason = f"invalid_output: {e}"
        if answer.out >= ladder.used_up * room:
            room = min(room * ladder.growth, ladder.ceiling)
    if ladder.rescue is not None:
        try:
            return read(ladder.rescue(last)), None, used
        except (ValueError, TypeError) as e:
            reason = f"invalid_output: {e}"
    return None, reason, used


_makers: dict[str, Callable[..., Provider]] = {}


def register(name: str, maker: Callable[..., Provider]) -> None:
    """Make a kind of provider known under a name."""
    _makers[name] = maker


def make_provider(name: str, **options: Any) -> Provider:
    """A provider of a kind that is known; ValueError for others."""
    if name not in _makers:
        raise ValueError(f"no provider {name!r}; known are {', '.join(sorted(_makers)) or 'none'}")
    return _makers[name](**options)


def _by_rules(words: int = 3) -> Provider:
    """Reads a chunk by rules alone: its capitalised words are entities, its first sentence a quote; for tests and dry runs."""
    import re

    def read(header: str, text: str, most_out: int) -> Answer:
        names = list(dict.fromkeys(re.findall(r"\b[A-Z][a-z]{3,}\b", text)))[:words]
        quote = re.split(r"(?<=[.!?])\s", text.strip(), maxsplit=1)[0]
        card = {"entities": [{"name": n} for n in names], "quotes": [{"text": quote, "span_start": -1, "span_end": -1}] if quote else [], "topics": []}
        said = json.dumps(card, ensure_ascii=False)
        return Answer(said, 0, max(1, len(text) // 4), max(1, len(said) // 4), "rules")

    return read


register("rules", _by_rules)
