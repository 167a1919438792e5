import io
import json
import random
import zipfile
from xml.etree import ElementTree

import pytest

from vellumark.operators.sampling import glob_regex
from vellumark.sources import files, jsonl, manifest


WORDS = "kelp tide brine quay buoy mast oar reef".split()


def poem(seed, lines=24):
    rng = random.Random(seed)
    return "\n".join(" ".join(rng.choices(WORDS, k=7)) for _ in range(lines))


def letter(*paragraphs):
    """A word-processor file of paragraphs, each a list of runs; None is a tab."""
    space = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
    root = ElementTree.Element(f"{{{space}}}document")
    for runs in paragraphs:
        p = ElementTree.SubElement(root, f"{{{space}}}p")
        for r in runs:
            e = ElementTree.SubElement(p, f"{{{space}}}{'tab' if r is None else 't'}")
            e.text = r
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", ElementTree.tostring(root))
    return out.getvalue()


TALK = [
    {"type": "summary", "summary": "On tides"},
    {"type": "assistant", "timestamp": "2019-08-01T10:00", "message": {"content": [{"type": "text", "text": "low at six"}, {"type": "tool_use", "text": "x"}]}},
    {"type": "user", "timestamp": "2018-07-31T09:00", "message": {"content": " when is the tide low? "}},
]
# path: (bytes, state, reason)
PLANTED = {
    "log/first.md": (poem(1).encode(), "doc", None),
    "log/zz-again.rst": (poem(1).encode(), "dedup", None),
    "log/latin.txt": ("Tidehafen f\xfcr \xd6l".encode("latin-1"), "doc", None),
    "mail/note.eml": (b"Subject: buoys", "doc", None),
    "mail/letter.docx": (letter(["brine", None, "quay"], ["mast"]), "doc", None),
    "mail/torn.docx": (b"PK but no archive", "quarantined", "parse_error"),
    "pictures/reef.webp": (b"RIFF\0\0", "quarantined", "ocr_unavailable"),
    "sound/gulls.opus": (b"OggS\0", "quarantined", "asr_unavailable"),
    "talk/tides.jsonl": ("\n".join(map(json.dumps, TALK)).encode() + b"\n[1]\nno json", "doc", None),
    "odd/README": (b"kelp only", "doc", None),
    "odd/dump.dat": (b"\x00\xff" * 900, "quarantined", "unsupported_modality"),
    "odd/cache.bak": (b"left out", "excluded", "excluded"),
    "runs/0.md": (b"the archive's own", "excluded", "internal"),
}


@pytest.fixture()
def tree(tmp_path):
    for name, (raw, _, _) in PLANTED.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(raw)
    return tmp_path


def test_every_file_ends_in_a_state(spark, tree):
    listed = files.list_files(spark, str(tree))
    states, blocks = files.ingest(listed.unionByName(listed), ["**"], ["*.bak"])
    by = {r["path"]: r for r in states.collect()}
    assert {p: (r["state"], r["reason"] and r["reason"].partition(":")[0]) for p, r in by.items()} == {p: (s, why) for p, (_, s, why) in PLANTED.items()}
    assert by["log/zz-again.rst"]["ref"] == by["log/first.md"]["doc_id"]
    texts = {r["doc_id"]: r["text"] for r in blocks.collect()}
    said = lambda p: texts[by[p]["doc_id"]]
    assert said("mail/letter.docx") == "brine\tquay\nmast" and said("log/latin.txt") == "Tidehafen für Öl"
    assert said("talk/tides.jsonl") == "SUMMARY: On tides\n\nASSISTANT: low at six\n\nUSER: when is the tide low?" and by["talk/tides.jsonl"]["year"] == 2018


def test_only_changed_files_are_opened(spark, tree):
    known = files.list_files(spark, str(tree)).drop("content").where("path not like 'mail/%'").cache()
    assert {r["path"] for r in files.changed_files(spark, str(tree), "root", known).collect()} == {p for p in PLANTED if p.startswith("mail/")}
    assert files.changed_files(spark, str(tree), "root", files.list_files(spark, str(tree)).drop("content")).count() == 0
    with pytest.raises(FileNotFoundError):
        files.list_files(spark, str(tree / "nowhere"))
    (tree / "names.txt").write_text("a/b.md\n\na/b.md\n c.md \n")
    assert sorted(r["path"] for r in files.listed_elsewhere(spark, str(tree / "names.txt")).collect()) == ["a/b.md", "c.md"]


def test_pages_and_recordings():
    pages = {b"text": [("x" * 30, True, None), ("", False, None)], b"scan": [("x" * 30, True, None), (" no ", True, b"img")]}
    assert files.pdf_reader(pages.get)(b"text") == [(1, "x" * 30, {"source": "pdf", "page": "1"})]
    with pytest.raises(files.Unreadable, match="ocr_unavailable: page 2"):
        files.pdf_reader(pages.get)(b"scan")
    assert files.pdf_reader(pages.get, lambda image: "seen")(b"scan")[1] == (2, "seen", {"source": "ocr", "page": "2"})
    with pytest.raises(files.Unreadable, match="parse_error"):
        files.pdf_reader(pages.__getitem__)(b"torn")
    run = lambda code: files.speech_reader(["sh", "-c", f"cat; exit {code}"])(b"gulls")
    assert run(0) == [(0, "gulls", {"source": "asr"})] and run(4) == []
    for code, kind in ((2, "asr_unavailable"), (3, "asr_timeout"), (9, "asr_failed")):
        with pytest.raises(files.Unreadable, match=kind):
            run(code)
    with pytest.raises(files.Unreadable, match="asr_unavailable"):
        files.speech_reader(["no-such-program"])(b"")


def test_globs():
    import re

    yes = [("**/*.md", "a/b/C.MD"), ("*.md", "x/y.md"), ("a/*.txt", "a/b.txt"), ("a/**", "a/b/c"), ("?.c", "d/e.c")]
    no = [("a/*.txt", "a/b/c.txt"), ("*.md", "x.mdx"), ("a?c", "a/c")]
    assert all(re.search(glob_regex(g), p) for g, p in yes) and not any(re.search(glob_regex(g), p) for g, p in no)


def test_keyed_lines(spark, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"doc_id":"a","seq":0,"x":1}\n[1]\n{"seq":1}\nnot json\n{"doc_id":"b","seq":2}\n{"doc_id":"torn')
    got = jsonl.read_keyed(spark, str(tmp_path / "c.jsonl"), "doc_id string, seq int, x int").collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == [("a", 0, 1), ("b", 2, None)]
    assert jsonl.read_keyed(spark, str(tmp_path / "none.jsonl"), "doc_id string, seq int").count() == 0


def test_manifest(tmp_path):
    text = "# archive\nroots:\n  - path: /a  # first\n    label: \"A: b\"\n  - /b\ninclude: [\"**/*.md\", '*.txt']\noptions:\n  depth: 3\n  ratio: 0.5\n  on: true\n"
    m = manifest.check(manifest.parse_yaml(text))
    assert m.roots == ({"path": "/a", "label": "A: b"}, {"path": "/b"}) and m.include == ("**/*.md", "*.txt") and m.options == {"depth": 3, "ratio": 0.5, "on": True}
    raw = manifest.parse_yaml(text)
    assert manifest.parse_yaml(manifest.dump_yaml(raw)) == raw
    for bad in ("a: &x 1", "a: |\n  b", "a: {b: 1}", "\ta: 1", "a: 1\na: 2", "a:\n  -\n", "roots: []", "roots: [a]\nother: 1", "roots: [a]\nsovereignty: true"):
        with pytest.raises(manifest.ManifestError):
            manifest.check(manifest.parse_yaml(bad))
    (tmp_path / "manifest.json").write_text('{"roots": ["/x"]}')
    assert manifest.load(tmp_path).roots == ({"path": "/x"},)
