import json

import pytest

from vellumark.operators.tape import Tape, TapeError, read_tape, verify_tape


def fill(folder, n=9, size=400):
    t = Tape(folder, segment_bytes=size)
    for k in range(0, n, 3):
        t.append([("text", {"doc_id": "d", "seq": k + i, "text": "é" * 5}) for i in range(2)] + [("journal", {"event": "x", "k": k})])
    return t


def test_append_read_verify(spark, tmp_path):
    t = fill(tmp_path)
    assert t.count == 9 and len(t.segments) > 1
    assert read_tape(spark, str(tmp_path)).count() == 9
    assert read_tape(spark, str(tmp_path), ["journal"]).count() == 3
    assert verify_tape(spark, str(tmp_path)).count() == 0
    assert Tape(tmp_path).head == t.head


def test_damage_is_found(spark, tmp_path):
    t = fill(tmp_path)
    path = tmp_path / t.segments[0]["name"]
    lines = path.read_text().splitlines()
    row = json.loads(lines[1])
    row["body"]["text"] = "other"
    lines[1] = json.dumps(row)
    path.write_text("\n".join(lines) + "\n")
    assert [(r["i"], r["problem"]) for r in verify_tape(spark, str(tmp_path)).collect()] == [(1, "hash mismatch")]


@pytest.mark.parametrize("where", ["first", "middle", "last"])
@pytest.mark.parametrize("segment", [0, -1])
@pytest.mark.parametrize(("spoil", "problem"), [(lambda x: "{torn", "unparseable"), (lambda x: "[1]", "not a record"), (lambda x: x.replace('"i": ', '"i": 7'), "index mismatch"), (lambda x: x.replace('"body": {', '"body": {"more": 1, '), "hash mismatch")])
def test_first_damage_is_named(spark, tmp_path, where, segment, spoil, problem):
    t = fill(tmp_path, 36, 1_500)
    s = t.segments[segment]
    at = {"first": 0, "middle": s["count"] // 2, "last": s["count"] - 1}[where]
    path = tmp_path / s["name"]
    lines = path.read_text().splitlines()
    lines[at] = spoil(lines[at])
    path.write_text("\n".join(lines) + "\n")
    assert len(t.segments) > 2 and [tuple(r) for r in verify_tape(spark, str(tmp_path)).collect()] == [(s["first_i"] + at, problem)]


def test_missing_lines_and_foreign_heads(spark, tmp_path):
    t = fill(tmp_path)
    lock = json.loads((tmp_path / "tape.lock").read_text())
    (tmp_path / "tape.lock").write_text(json.dumps(lock | {"head": "f" * 32}))
    assert [tuple(r) for r in verify_tape(spark, str(tmp_path)).collect()] == [(9, "checkpoint mismatch")]
    (tmp_path / "tape.lock").write_text(json.dumps(lock))
    path = tmp_path / t.segments[0]["name"]
    path.write_text(path.read_text().splitlines(keepends=True)[0])
    assert [tuple(r) for r in verify_tape(spark, str(tmp_path)).collect()] == [(1, "missing")]


def test_recovery(tmp_path):
    t = fill(tmp_path)
    last = tmp_path / t.segments[-1]["name"]
    with last.open("ab") as f:
        f.write(b'{"torn')
    assert Tape(tmp_path).count == 9 and not last.read_bytes().endswith(b"torn")
    lock = json.loads((tmp_path / "tape.lock").read_text())
    Tape(tmp_path).append([("doc", {"doc_id": "d"})])
    (tmp_path / "tape.lock").write_text(json.dumps(lock))  # written, but not acknowledged
    again = Tape(tmp_path)
    assert again.count == 10 and Tape(tmp_path).head == again.head


def test_rules(spark, tmp_path):
    with pytest.raises(TapeError):
        Tape(tmp_path).append([("other", {})])
    with pytest.raises(TapeError):
        Tape(tmp_path, readonly=True).append([("doc", {})])
    assert read_tape(spark, str(tmp_path / "none")).count() == 0 and verify_tape(spark, str(tmp_path / "none")).count() == 0
