"""Freezing the artifacts a reading pass rests on, and the roster of archives."""

from __future__ import annotations

import json
from pathlib import Path

from ..functions.hashing import digest

LOCK, PROPOSED = "charter.lock", "charter.proposed"


class CharterError(Exception):
    """Why a charter can't be frozen or doesn't hold."""


def fingerprints(folder: str | Path, names: list[str]) -> dict[str, str]:
    """Digest of each named file and, under 'root', of all of them together."""
    found = {}
    for name in sorted(names):
        path = Path(folder) / name
        if not path.is_file():
            raise CharterError(f"{name} is missing")
        found[name] = digest(path.read_bytes())
    return found | {"root": digest(json.dumps(found, sort_keys=True).encode())}


def propose(folder: str | Path, names: list[str]) -> dict[str, str]:
    """Write down which artifacts a charter is to rest on, as they are now; may be done again until it is frozen."""
    if (Path(folder) / LOCK).exists():
        raise CharterError("the charter is frozen already")
    prints = fingerprints(folder, names)
    (Path(folder) / PROPOSED).write_text(json.dumps(prints, sort_keys=True, indent=1))
    return prints


def freeze(folder: str | Path, stable: bool, roster: str | Path | None = None) -> dict[str, str]:
    """Fix the proposed charter: once only, only as it was proposed, and only where two runs of scoring agreed.

    With a `roster`, a file of all archives, the archive gets its row there under its key.
    """
    lock, proposed = Path(folder) / LOCK, Path(folder) / PROPOSED
    if lock.exists():
        raise CharterError("the charter is frozen already")
    if not proposed.exists():
        raise CharterError("no charter is proposed")
    if not stable:
        raise CharterError("the scores of two runs don't agree")
    prints = json.loads(proposed.read_text())
    if fingerprints(folder, [n for n in prints if n != "root"]) != prints:
        raise CharterError("the artifacts changed after they were proposed")
    lock.write_text(json.dumps(prints, sort_keys=True, indent=1))
    if roster is not None:
        rows = json.loads(Path(roster).read_text()) if Path(roster).exists() else {}
        rows[roster_key(Path(folder).resolve().name, prints["root"], rows)] = prints["root"]
        Path(roster).write_text(json.dumps(rows, sort_keys=True, indent=1))
    return prints


def verify(folder: str | Path) -> str:
    """The frozen root fingerprint, if every artifact is still what it was."""
    lock = Path(folder) / LOCK
    if not lock.exists():
        raise CharterError("the charter isn't frozen")
    frozen = json.loads(lock.read_text())
    now = fingerprints(folder, [n for n in frozen if n != "root"])
    if changed := sorted(n for n in frozen if frozen[n] != now[n]):
        raise CharterError(f"changed since: {', '.join(changed)}")
    return frozen["root"]


def roster_key(name: str, root: str, roster: dict[str, str]) -> str:
    """An archive's key in a roster {key: root}: its name, or name@ and eight digits where another archive has that."""
    return name if roster.get(name, root) == root else f"{name}@{root[:8]}"
