"""Leases on a shared folder: who works on what, until when."""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable
from pathlib import Path

# Seconds that a lease on a pass and on a chunk lasts.
PASS_SECONDS, CHUNK_SECONDS = 900, 3_600


class Leases:
    """Each lease is a file that only one worker can create; one that has run out is taken over by whoever moves it away first.

    A lease is advisory: where the folder can't be used the work goes on without it, as a lease that is lost
    costs double work, not wrong results.
    """

    def __init__(self, folder: str | Path, owner: str, seconds: int = PASS_SECONDS, clock: Callable[[], float] = time.time):
        self.folder, self.owner, self.seconds, self.clock = Path(folder), owner, seconds, clock

    def _file(self, key: str) -> Path:
        return self.folder / f"{key}.lease"

    def _holder(self, key: str) -> tuple[str, float] | None:
        try:
            held = json.loads(self._file(key).read_text("utf-8"))
            return held["owner"], float(held["until"])
        except FileNotFoundError:
            return None
        except (ValueError, KeyError, TypeError):
            return "", 0.0  # half written by someone who is gone

    def _written(self) -> str:
        return json.dumps({"owner": self.owner, "until": self.clock() + self.seconds})

    def take(self, key: str) -> bool:
        """Whether the work is ours: False only while somebody else holds it."""
        try:
            self.folder.mkdir(parents=True, exist_ok=True)
            if (held := self._holder(key)) is not None:
                if held[0] == self.owner:
                    return self.renew(key)
                if held[1] > self.clock():
                    return False
                os.rename(self._file(key), self.folder / f"{key}.{uuid.uuid4().hex}.gone")
            with self._file(key).open("x", encoding="utf-8") as f:
                f.write(self._written())
            return True
        except (FileExistsError, FileNotFoundError):
            return False  # somebody was quicker
        except OSError:
            return True

    def renew(self, key: str) -> bool:
        """Go on holding a lease; written anew once a third of its time is over. False if somebody else has it."""
        try:
            held = self._holder(key)
            if held is None or held[0] != self.owner:
                return False
            if held[1] - self.clock() < self.seconds * 2 / 3:
                new = self.folder / f"{key}.{uuid.uuid4().hex}.new"
                new.write_text(self._written(), "utf-8")
                os.replace(new, self._file(key))
            return True
        except OSError:
            return True

    def release(self, key: str) -> None:
        try:
            if (held := self._holder(key)) is not None and held[0] == self.owner:
                self._file(key).unlink()
        except OSError:
            pass
