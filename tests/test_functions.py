import math
import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vellumark.functions import hashing, text


def test_decoding_takes_the_strictest():
    assert text.decode_bytes("é".encode()) == ("é", "utf-8")
    assert text.decode_bytes(b"\xef\xbb\xbfa") == ("a", "utf-8")
    assert text.decode_bytes("é".encode("cp1252")) == ("é", "cp1252")
    assert text.decode_bytes(b"\x81") == ("\x81", "latin-1")


def test_sniffing():
    assert text.looks_like_text(b"plain") and text.looks_like_text("é".encode()[:1] + b"")
    assert not text.looks_like_text(b"a\0b") and not text.looks_like_text(b"\xff" + b"a" * 10)


@given(st.text(alphabet="ab\n", max_size=60), st.integers(1, 9))
def test_blocks_add_up(t, most):
    blocks = text.split_blocks(t, most)
    assert "".join(blocks) == t and all(0 < len(b) <= most for b in blocks)


def test_block_cuts_after_a_line_end():
    assert text.split_blocks("aaa\nbbb", 5) == ["aaa\n", "bbb"]
    assert text.split_blocks("\naaaaaa", 4) == ["\naaa", "aaa"]
    assert [len(b) for b in text.split_blocks("x" * 75_000)] == [32_000, 32_000, 11_000]


def test_columns_on_odd_rows(spark):
    rows = [(None,), ("",), ("   ",), ("A 日本 text",), ("x" * 50_000,), ("e\u0301\r\nb\rc",)]
    df = spark.createDataFrame(rows, "t string").select(
        text.estimate_tokens(F.col("t")).alias("n"), text.canonical_text(F.col("t")).alias("c"), text.squash(F.col("t")).alias("s"), text.shingle_hashes(F.col("t")).alias("h"), text.text_blocks(F.col("t"), 10).alias("b")
    )
    got = df.collect()
    assert [r["n"] for r in got] == [None, 0, 0, 3, 12_500, 1]
    assert got[5]["c"] == "é\nb\nc" and got[0]["c"] is None and got[2]["s"] == ""
    assert all(r["h"] is None for r in got) and got[0]["b"] == [] and len(got[4]["b"]) == 5_000


def test_planted_defects(spark):
    t = "The Cortex saw it. Cortex is here in 2024 with 1500 and 12. Cortex, Cortex."
    df = spark.createDataFrame([(t,), (None,), ("none here",)], "t string")
    got = df.select(text.shift_year(F.col("t")).alias("y"), text.scale_number(F.col("t")).alias("n"), text.flip_negation(F.col("t")).alias("g"), text.swap_entity(F.col("t")).alias("e")).collect()
    assert got[0]["y"] == t.replace("2024", "2031") and got[0]["n"] == t.replace("1500", "15000") and got[0]["g"] == t.replace(" is ", " is not ")
    assert got[0]["e"].count("Zorbell") == 3 and got[0]["e"].startswith("The Cortex")
    assert got[1] == got[2] == (None, None, None, None)


def test_display_is_one_line(spark):
    t = "a\tb\r\nc \x1b[31mred\x1b[0m \x07end"
    assert text.shown(t) == "a b  c red end" == spark.createDataFrame([(t,)], "t string").select(text.printable(F.col("t"))).first()[0]


def test_canonical_json():
    assert hashing.canonical_json({"b": [0.1, 1e300, -0.0, 2.5], "a": "e\u0301"}) == '{"a":"é","b":[0.1,1e+300,-0.0,2.5]}'.encode()
    for bad in ({"é": 1, unicodedata.normalize("NFD", "é"): 2}, math.nan, {1: 2}, object()):
        with pytest.raises(hashing.NotCanonical):
            hashing.canonical_json(bad)
    with pytest.raises(hashing.NotCanonical):
        hashing.chain_hash("0", {})


def test_blake2b_column(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string").select(hashing.blake2b(F.col("t")).alias("h"))
    assert [r[0] for r in df.collect()] == [hashing.digest(b"a"), None]
