import unicodedata

import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from vellumark.llm import forms, pii, residue

FOLDS = [
    ("Gr​and­father", "Grandfather", True), ("a b c", "a b c", True), ("пoлуслове", "полуслове", True), ("сrауon", "crayon", True), ("résumé", "résumé", True), ("Ｈｅｌｌｏ２", "Hello2", True), ("ﬁnal", "final", True),
    ("ｶﾀﾛｸﾞ", "カタログ", True), ("２００３年", "2003年", True), ("Keller", "Keller", True), ("There is а map", "There is a map", True), ("한", "한", True), ("ậ", "ậ", True),
    ("Привет из порта", "Привет из порта", False), ("stencilled ΑΡΧΕΙΟ here", "stencilled ΑΡΧΕΙΟ here", False), ("Plot Δt against β, μ-law", "Plot Δt against β, μ-law", False), ("👩‍💻 ❤️ 1️⃣", "👩‍💻 ❤️ 1️⃣", False),
    ("“Never” — that’s…", "“Never” — that’s…", False), ("½ a cup, 21 °C, ±3 µm, 24º", "½ a cup, 21 °C, ±3 µm, 24º", False), ("なぜ（16冊）！", "なぜ（16冊）！", False), ("напишу о Verick", "напишу о Verick", False), ("می‌خواهم", "می‌خواهم", False), ("", "", False), ("tab\tline\n", "tab\tline\n", False),
    ("the соорег house", "the cooper house", True), ("оссоре near the gate", "occope near the gate", True), ("Ꮪchool bell", "School bell", True), ("հouse օwl", "house owl", True), ("pαlm tree", "palm tree", True), ("SALE АВС NOW", "SALE ABC NOW", True), ("to wynard＠corvid.invalid now", "to wynard@corvid.invalid now", True),
    ("СССР in old maps", "СССР in old maps", False), ("сахар Verick вода", "сахар Verick вода", False), ("αmax of βs", "αmax of βs", False), ("Հայաստան, բարև", "Հայաստան, բարև", False), ("гора у Verick, вода", "гора у Verick, вода", False),
]


@pytest.mark.parametrize(("text", "form", "told"), FOLDS)
def test_forms(text, form, told):
    f = forms.fold(pa.array([text]))
    assert (f.strings().to_pylist(), f.disguised.tolist()) == ([form], [told])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=12), st.text(alphabet="aẹ́́​о о１ﬁ한\n", max_size=12)), max_size=6))
def test_texts_of_a_batch_dont_touch(texts):
    together = forms.fold(pa.array(texts, pa.string()))
    alone = [forms.fold(pa.array([t], pa.string())) for t in texts]
    assert together.strings().to_pylist() == [a.strings().to_pylist()[0] for a in alone]
    assert together.disguised.tolist() == [bool(a.disguised[0]) for a in alone]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aeoḉ̣̈͂가ᅡᆫ", max_size=14))
def test_composition_is_the_standard_one(t):
    assert forms.fold(pa.array([t])).strings().to_pylist() == [unicodedata.normalize("NFC", t)]


def test_form_tables(spark):
    blocks = spark.createDataFrame([("a", 0, "x​y", "t"), ("a", 0, "x​y", "t"), ("a", 1, None, "t"), ("a", 2, "", "t")], "doc_id string, seq int, text string, form string")
    quote = "array<struct<text:string,span_start:int,span_end:int>>"
    cards = spark.createDataFrame([("a", 0, [("xy", 0, 2), ("ｘ", 0, 1), (None, 0, 0)]), ("a", 1, None)], f"doc_id string, seq int, quotes {quote}")
    assert sorted(map(tuple, forms.disguised_texts(blocks, cards).collect())) == [("a", 0, -1), ("a", 0, 1)]
    got = {(r["seq"], r["quote_no"]): r["form"] for r in forms.archive_forms(blocks, cards).collect()}
    assert got[0, -1] == got[0, 0] == "xy" and got[1, -1] is None and got[2, -1] == ""
    assert forms.disguised_texts(blocks.limit(0), cards.limit(0)).count() == 0


def test_slices_bound_the_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 10, None, "y" * 50, "z"])], names=["t"])
    assert [b.num_rows for b in forms.slices(iter([batch]), 0, 20)] == [2, 1, 1]


FOUND = [
    ("Write to Torden.Ganesk@uni.example.net before", ["Torden.Ganesk@uni.example.net"]), ("a b.c [at] mail.example now", ["b.c [at] mail.example"]), ("x(at)office(dot)example(dot)com", ["x(at)office(dot)example(dot)com"]), ("<tormo at uni dot example dot net>", ["tormo at uni dot example dot net"]),
    ("q​u_1＠uni.example.net", ["q​u_1＠uni.example.net"]), ("Pinned lumen@2.4.571 and see @param", []), ("Call +1 (646) 555-0149 ext. 41 now", ["+1 (646) 555-0149 ext. 41"]), ("Tel: 030/23125-989.", ["030/23125-989"]), ("01.99.00.08.82 after", ["01.99.00.08.82"]), ("Call 555.0121 later", ["555.0121"]),
    ("ISBN 978-0-00-71438-4 and 2021-03-04 at 09:15, 4471-757-9", []), ("call five five five, zero one two one", ["five five five, zero one two one"]), ("SSN 965-19-9877.", ["965-19-9877"]), ("QQ 70 66 64 C here", ["QQ 70 66 64 C"]), ("passport C08X05T08", ["C08X05T08"]), ("National ID: 1 99 34 99 224 772 08", ["1 99 34 99 224 772 08"]),
    ("to Flat 19, 180 Vasden Avenue in", ["Flat 19, 180 Vasden Avenue"]), ("to 205a Eldtha Rd. in", ["205a Eldtha Rd."]), ("Habite 80 bis, avenue Wyneth", ["80 bis, avenue Wyneth"]), ("Vive en Calle Rasden 113, 13º B", ["Calle Rasden 113, 13º B"]), ("ging an Selesker Straße 117.", ["Selesker Straße 117"]), ("Walked along Tallow Lane without", []),
    ("Dr. Marguerite Tesjahofot signed", ["Marguerite Tesjahofot"]), ("Frau Raméöfil, Sam bringt", ["Raméöfil, Sam"]), ("It was Wilhelmína Wutnokufon who", ["Wilhelmína Wutnokufon"]), ("Present: ZOË FISESIT", ["ZOË FISESIT"]), ("Project Vereth moved to Renell", []), ("", []),
    ("anna dot smith at mail dot example dot org", ["anna dot smith at mail dot example dot org"]), ("x at mail[dot]example[dot]org now", ["x at mail[dot]example[dot]org"]), ("a_1@uni dot example dot net", ["a_1@uni dot example dot net"]), ("I stayed at home dot anna, meet me at example.org", []),
    ("I met Kwame Mensah at the dock", ["Kwame Mensah"]), ("Oluwaseun Adeyemi called", ["Oluwaseun Adeyemi"]), ("We saw Zoltan Kovacs today", ["Zoltan Kovacs"]), ("then Bexley Tarnovic said so", ["Bexley Tarnovic"]), ("I asked Bexley Tarnovic twice", ["Bexley Tarnovic"]), ("The Bexley Tarnovic said so; I saw Bexley Bridge", []),
    ("The serial is 555-0121 there", []),
]


@pytest.mark.parametrize(("text", "want"), FOUND)
def test_places(text, want):
    (spans,) = pii.found_in(forms.fold(pa.array([text])))
    assert [text[a:b] for _, a, b in spans] == want


def test_masking(spark):
    text = "Write to a.b@uni.example.net or call 555.0121 twice."
    df = spark.createDataFrame([("a", 0, text, "z"), ("a", 0, text, "z"), ("a", 1, None, "z"), ("a", 2, "", "z")], "doc_id string, seq int, text string, spans string")
    assert {(r["seq"], r["masked"]) for r in pii.masked_blocks(df).collect()} == {(0, "Write to [EMAIL] or call [PHONE] twice."), (1, None), (2, "")}
    assert sorted((r["pii_type"], text[r["start_at"] : r["end_at"]]) for r in pii.places(df).collect()) == [("email", "a.b@uni.example.net"), ("phone", "555.0121")]
    assert pii.places(df.limit(0)).count() == 0


def test_masking_keeps_the_rest(spark, data):
    df = spark.read.parquet(f"{data}/text_block.parquet")
    for r in pii.with_spans(df.select("doc_id", "seq", "text"), keep=("doc_id", "seq")).join(df.select("doc_id", "seq", "text"), ["doc_id", "seq"]).collect():
        at = 0
        for s in r["spans"]:
            assert at <= s["start_at"] < s["end_at"] <= len(r["text"])
            at = s["end_at"]


RESIDUE = [
    ("Subject: {{prenom}}\nCity: [INSERT DATE]", True), ("We met [hier Datum eintragen] at the pier.", True), ("Then the @@company@@ boathouse stopped.", True), ("Lorem ipsum dolor sit amet consectetur adipiscing elit sed.", True), ("Please enable JavaScript to continue.", True), ("Menu\nSearch\n404 Not Found\n\nThe page you requested could not be found on this server.", True),
    ("Fehler 404 – Seite nicht gefunden", True), ("asdf asdf qwer asdf", True), ("<noscript>We're sorry but X doesn't work properly without JavaScript.</noscript>", True), ('{"error": {"code": 503, "message": "upstream unavailable"}}', True),
    ("The engine replaces `{{ title }}` by the value from the row, so a missing key must fail loudly.", False), ("Typesetters have used lorem ipsum for ages; for Renolm I drew boxes instead and nobody minded.", False), ("We decided that it should work without JavaScript; the reader page renders on the server now.", False), ("Notes on arrays: a[[104]] picks one item, [104] picks a list; a lookup table is __dict__ in disguise.", False),
    ("Postmortem: it answered 502 Bad Gateway for 293 minutes because the pool was exhausted; we raised the limit and added an alert. We walked to the reading room, burned nothing, and came home missing.", False), ("def f(rows):\n    out = []\n    for r in rows:\n        out.append(f'{r}')\n    return out", False), ("", False), ("Plain words.", False), (None, False),
]


def test_residue(spark):
    df = spark.createDataFrame([(i, t, None if i % 2 else "s", "k") for i, (t, _) in enumerate(RESIDUE)], "doc_id bigint, text string, source string, line string")
    want = {i for i, (_, bad) in enumerate(RESIDUE) if bad}
    assert {r[0] for r in residue.residue(df).collect()} == want
    assert residue.without_residue(df).count() == len(RESIDUE) - len(want) and residue.residue(df.limit(0)).count() == 0


def test_boilerplate_of_a_host_is_nothing(spark):
    nav = "The gallery of maritime maps and postcards\nOpening hours of the harbour museum, all year round\n"
    rows = [(i, "h", nav + f"Content number {i} " * 12) for i in range(9)] + [(100, "h", nav + "Access denied."), (101, "other", nav + "Access denied.")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert {r[0] for r in residue.residue(df).collect()} == {100}


def test_recurrent_placeholders_are_subtracted(spark):
    rows = [(i, "h", f"A note on the harbour, number {i}: the tide was {'low' if i % 2 else 'high'} and {i} boats came in.\nGenerated by {{{{site_name}}}}") for i in range(40)]
    rows += [(100, "h", "Dear {{name}},\nthe harbour is closed.\nGenerated by {{site_name}}"), (101, "other", "The tide was low.\nGenerated by {{site_name}}")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert {r[0] for r in residue.residue(df).collect()} == {100, 101}


def test_error_pages_a_host_repeats_are_error_pages(spark):
    rows = [(i, "h", f"404 Not Found\nThe requested URL /{chr(97 + i)} was not found on this server.\nnginx/1.2") for i in range(20)] + [(50, "h", "The mill was closed when we came. " * 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert {r[0] for r in residue.residue(df).collect()} == set(range(20))


def test_what_isnt_searched_has_no_message(data):
    import pyarrow.parquet as pq

    for text in forms.fold(pq.read_table(f"{data}/documents.parquet", columns=["text"]).column(0).combine_chunks()).strings().to_pylist():
        lines = [x.casefold() for x in residue.shown_lines(text)]
        said = "\n".join(x for x in lines if len(x) <= 3 * residue.MESSAGE_CHARS)
        if any(residue.is_message(x) for x in lines):
            assert residue.STATUS.search(said) and any(w in said for w in residue.STATUS_NEEDS) or any(w in said for w in (*residue.SCRIPT_NEEDS, *residue.ERROR_NEEDS))
        if short := [x for x in lines if len(x) <= residue.FILLER_CHARS and residue.FILLER.search(x)]:
            assert any(w in x for x in short for w in residue.FILLER_NEEDS)


def test_detectors_are_skipped_where_they_find_nothing(data):
    """What a text must hold for a detector to run never costs a find."""
    import pyarrow.parquet as pq

    for text in pq.read_table(f"{data}/text_block.parquet", columns=["text"]).column(0).to_pylist():
        low = (text or "").lower()
        for pattern, needs in zip(pii.ADDRESS, pii.ADDRESS_NEEDS, strict=True):
            assert any(w in low for w in needs) or not pattern.search(text or "")
        for m in regex.finditer(r"\p{Lu}", text or ""):
            for cue in (pii.NAME_CUE, pii.TITLE_BEFORE, pii.PERSON_BEFORE):
                assert pii.cued_by(cue, text, m.start()) == pii.before(cue, text, m.start())


def test_copies_make_no_boilerplate(spark):
    chat = "Did the ferry leave on time this morning\nYes and the harbour was full of grey geese\nAccess denied.\nBring the green lantern tonight"
    df = spark.createDataFrame([(i, "h", chat) for i in range(12)] + [(100, "other", chat)], "doc_id bigint, source string, text string")
    assert residue.residue(df).count() == 0


@pytest.mark.parametrize(("hosts_texts", "share", "found"), [(30, 0.1, {100}), (90, 0.1, set())])
def test_boilerplate_is_a_share_of_the_host(spark, monkeypatch, hosts_texts, share, found):
    monkeypatch.setattr(residue, "RECURRENT_SHARE", share)
    nav = "The gallery of maritime maps and postcards\nOpening hours of the harbour museum, all year round\n"
    rows = [(i, "h", (nav if i < 6 else "") + f"Content number {i} " * 12) for i in range(hosts_texts)] + [(100, "h", nav + "Access denied.")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert {r[0] for r in residue.residue(df).collect()} == found


@pytest.mark.parametrize("unit", ["Abc ", "a@", "a at b dot ", "[{", "a.b-c+", "<p>", " ", "1", "+1", "12 Main ", "Robert ", "Tel: 555.0121 ", "Calle de ", "\n", "é"])
def test_very_long_texts(unit):
    text = (unit * 60_000)[:60_000]
    list(pii.found_in(forms.fold(pa.array([text]))))
    residue.examine(text)
