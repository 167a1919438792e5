import json

import pytest
from pyspark.sql import functions as F

from vellumark.__main__ import main
from vellumark.archive import Archive
from vellumark.operators import charter
from vellumark.operators.provider import Answer
from vellumark.operators.tape import verify_tape


@pytest.fixture()
def archive(spark, tmp_path):
    src = tmp_path / "src"
    for name, text in {"p1/a.md": "The lantern stood by the ridge path. " * 12, "p1/copy.md": "The lantern stood by the ridge path. " * 12, "p2/b.txt": "Another text about a boathouse. " * 12, "p2/c.tmp": "x", "p2/d.pdf": "%PDF"}.items():
        (src / name).parent.mkdir(parents=True, exist_ok=True)
        (src / name).write_text(text)
    (tmp_path / "manifest.yaml").write_text("roots:\n  - path: src\n    label: notes\nexclude: ['*.tmp']\n")
    return Archive(spark, str(tmp_path))


def test_from_files_to_answers(spark, archive, tmp_path):
    assert {r["ext"]: r["files"] for r in archive.plan().collect()} == {"md": 2, "txt": 1, "pdf": 1}
    assert {r["state"]: r["n"] for r in archive.intake().collect()} == {"doc": 2, "dedup": 1, "excluded": 1, "quarantined": 1}
    assert {r["state"]: r["n"] for r in archive.intake().collect()} == {"doc": 2, "dedup": 1, "excluded": 1, "quarantined": 1}
    assert archive.table("doc").count() == 2 and archive.table("text_block").count() == 2 and archive.table("journal").count() == 3
    total = archive.contact_sheet().where("source = '*'").first()
    assert total["files"] == 2 and total["chars"] == 12 * (37 + 32)

    def provider(header, text, most_out):
        return Answer(json.dumps({"entities": [{"name": "lantern"}], "quotes": [{"text": text[:20], "span_start": 0, "span_end": 20}, {"text": "never said"}]}), 5, 5, 5, "m")

    plan = archive.dry_run(cap=0.0).first()
    assert (plan["rows"], plan["batches"], plan["sampled"], plan["readable"], plan["refused"]) == (2, 1, 2, 2, True)
    assert archive.read(provider) == 1 and archive.read(provider) == 0
    report = archive.fence(derive=True).first()
    assert (report["quotes"], report["exact"], report["no_offset_miss"], report["verified_rate"]) == (4, 2, 2, 0.5) and archive.table("span").count() == 2
    hit = archive.query("lantern ridge").first()
    assert hit["path"] == "p1/a.md" and "[lantern]" in hit["snippet"] and archive.query().first()["cards"] == 2
    archive.vectors(lambda ts: [[1.0, 2.0]] * len(ts), "e")
    archive.vectors(lambda ts: [[1.0, 2.0]] * len(ts), "e")
    assert archive.table("vectors").count() == 2
    assert archive.discover().count() == 2
    assert {(r["kind"], r["label"]): r["n"] for r in archive.status().collect()}["doc", "text"] == 2
    assert archive.export_tape(str(tmp_path / "log")) == 4 and verify_tape(spark, str(tmp_path / "log")).count() == 0


def test_later_files(spark, archive, tmp_path):
    """A second run opens what is new only: a copy refers to the first, a near copy is flagged, a broken run's blocks aren't doubled."""
    archive.intake()
    words = [f"word{i * 7 % 101}" for i in range(120)]
    (tmp_path / "src/p3").mkdir()
    (tmp_path / "src/p3/one.md").write_text(" ".join(words))
    (tmp_path / "src/p3/copy.txt").write_text("Another text about a boathouse. " * 12)
    archive.intake()
    (tmp_path / "src/p3/two.md").write_text(" ".join([*words[:-1], "else"]))
    assert {r["state"]: r["n"] for r in archive.intake().collect()} == {"doc": 4, "dedup": 2, "excluded": 1, "quarantined": 1}
    (flag,) = archive.table("journal").where("event = 'near_dup'").collect()
    one = archive.table("doc").where("path = 'p3/one.md'").first()["doc_id"]
    assert (flag["path"], flag["ref"]) == ("p3/two.md", one) and flag["jaccard"] > 0.8
    assert archive.state().count() == 0
    archive._append("text_block", archive.table("text_block").limit(1).withColumn("doc_id", F.lit("broken")))
    assert [tuple(r)[:3] for r in archive.state().collect()] == [("broken", 1, 0)]


def test_command_line(spark, archive, tmp_path, capsys):
    run = lambda *a: main([a[0], str(tmp_path), *a[1:]])
    assert run("plan") == 0 and run("intake") == 1 and run("census", "--json") == 0
    assert run("read", "--dry-run", "--json") == 0 and '"batches":1' in capsys.readouterr().out
    assert run("read", "--cap", "0") == 2 and run("read") == 0 and run("fence", "--derive") == 0 and run("query", "lantern", "--json") == 0
    assert "[lantern]" in capsys.readouterr().out and run("query", "lantern") == 0
    said = capsys.readouterr().out
    assert said.startswith("1. p1/a.md #0  [p1, ") and "read as one phrase" not in said and "The [lantern] stood" in said and "0-36: The lantern stood by the ridge path." in said
    assert run("query", "ridge-path") == 0 and "read as one phrase" in capsys.readouterr().out and run("query", "zeppelin") == 0 and capsys.readouterr().out == "no hits\n"
    assert run("query", "") == 2 and run("vectors") == 2 and run("freeze", "--stable") == 2
    (tmp_path / "rubric.txt").write_text("one")
    assert run("propose", "--artifact", "rubric.txt") == 0 and run("freeze") == 2 and run("freeze", "--stable", "--roster", str(tmp_path / "roster.json")) == 0


def test_charter(tmp_path):
    (tmp_path / "rubric.txt").write_text("one")
    roster = tmp_path / "roster.json"
    roster.write_text(json.dumps({tmp_path.name: "another root"}))
    with pytest.raises(charter.CharterError, match="proposed"):
        charter.freeze(tmp_path, stable=True)
    charter.propose(tmp_path, ["rubric.txt"])
    with pytest.raises(charter.CharterError, match="agree"):
        charter.freeze(tmp_path, stable=False)
    (tmp_path / "rubric.txt").write_text("between")
    with pytest.raises(charter.CharterError, match="changed"):
        charter.freeze(tmp_path, stable=True)
    (tmp_path / "rubric.txt").write_text("one")
    root = charter.freeze(tmp_path, stable=True, roster=roster)["root"]
    assert json.loads(roster.read_text()) == {tmp_path.name: "another root", f"{tmp_path.name}@{root[:8]}": root}
    assert charter.verify(tmp_path) == root
    with pytest.raises(charter.CharterError):
        charter.freeze(tmp_path, stable=True)
    (tmp_path / "rubric.txt").write_text("two")
    with pytest.raises(charter.CharterError):
        charter.verify(tmp_path)
    assert charter.roster_key("a", root, {}) == "a" and charter.roster_key("a", root, {"a": "x"}) == f"a@{root[:8]}"
