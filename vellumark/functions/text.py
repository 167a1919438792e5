"""Scalar functions over text: canonical form, blocks, estimates, squashing, quoting and planted defects."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import worker_udf

# The white space that splits words, as a regular expression class for JVM and RE2 alike.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WIDE = r"[\x{3000}-\x{9FFF}\x{F900}-\x{FAFF}]"
WORD = r"[\p{L}\p{N}_]+"
BLOCK_CHARS = 32_000

DECODERS = (("utf-8-sig", "utf-8"), ("cp1252", "cp1252"), ("latin-1", "latin-1"))


def decode_bytes(raw: bytes) -> tuple[str, str]:
    """Text of a file's bytes and the encoding that read it: the strictest of UTF-8, cp1252 and Latin-1 that can."""
    for codec, name in DECODERS:
        try:
            return raw.decode(codec), name
        except UnicodeDecodeError:
            continue
    raise AssertionError("Latin-1 reads any bytes")


def looks_like_text(head: bytes) -> bool:
    """No NUL byte and valid UTF-8, but for a sequence that is cut or broken in the last four bytes."""
    if b"\0" in head:
        return False
    try:
        head.decode("utf-8")
    except UnicodeDecodeError as e:
        return e.start >= len(head) - 4
    return True


def decoded(raw: Column) -> Column:
    """struct(text, encoding) of a binary column by the same ladder; null of null."""

    @worker_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("encoding", T.StringType())]))
    def read(rows: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(None, None) if r is None else decode_bytes(bytes(r)) for r in rows], columns=["text", "encoding"])

    return read(raw)


def sniffed(head: Column) -> Column:
    """Whether a file's first bytes look like text; null of null."""

    @worker_udf(T.BooleanType())
    def look(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: None if r is None else looks_like_text(bytes(r)))

    return look(head)


def canonical(text: str) -> str:
    """Line ends as line feeds, characters composed."""
    return unicodedata.normalize("NFC", text.replace("\r\n", "\n").replace("\r", "\n"))


@worker_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))


def canonical_text(text: Column) -> Column:
    """Canonical form of a text column; the line ends are mended on the JVM, only NFC runs in Python."""
    return nfc(F.regexp_replace(text, "\r\n?", "\n"))


def split_blocks(text: str, most: int = BLOCK_CHARS) -> list[str]:
    """Blocks of at most `most` characters that add up to the text, cut after the last line end that leaves one."""
    blocks, at = [], 0
    while len(text) - at > most:
        cut = text.rfind("\n", at, at + most)
        end = cut + 1 if cut > at else at + most
        blocks.append(text[at:end])
        at = end
    return [*blocks, text[at:]] if at < len(text) else blocks


def text_blocks(text: Column, most: int = BLOCK_CHARS) -> Column:
    """Array of a text's blocks; null and empty texts have none."""

    @worker_udf(T.ArrayType(T.StringType()))
    def blocks(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: split_blocks(t, most) if t else [])

    return blocks(text)


def estimate_tokens(text: Column) -> Column:
    """One token for each wide character and for each four of the others, rounded down."""
    wide = F.regexp_count(text, F.lit(WIDE))
    return F.floor(wide + (F.char_length(text) - wide) / F.lit(4)).cast("bigint")


def squash(text: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, SPACE + "+", " "), "^ | $", ""))


def strip_space(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def printable(text: Column) -> Column:
    """One line for display: tabs and line ends as spaces, colour codes and control characters gone."""
    one_line = F.regexp_replace(text, r"[\t\n\r]", " ")
    return F.regexp_replace(F.regexp_replace(one_line, r"\x{1b}\[[0-9;?]*[ -/]*[@-~]", ""), r"[\x{00}-\x{08}\x{0b}-\x{1f}\x{7f}]", "")


def shown(text: object) -> str:
    """A value on one line for display, by the same rules as `printable`."""
    one_line = re.sub(r"[\t\n\r]", " ", str(text))
    return re.sub(r"[\x00-\x08\x0b-\x1f\x7f]", "", re.sub(r"\x1b\[[0-9;?]*[ -/]*[@-~]", "", one_line))


def words(text: Column) -> Column:
    """Lower-case words of a text, in order."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), 1)


def shingle_hashes(text: Column, n: int = 5) -> Column:
    """Distinct 64-bit hashes of the runs of n words; null where there are fewer. Words are hashed once, runs from their words' hashes."""
    runs = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(n)]))
    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    # The hashes are bound to a name by a list of one, or they would be found anew for every run.
    return F.get(F.transform(F.array(hashed), lambda h: F.when(F.size(h) >= n, F.array_distinct(runs(h)))), F.lit(0))


def record_header(doc_id: Column, year: Column, project: Column, seq: Column) -> Column:
    """The line that introduces a chunk: document, year, project and number."""
    return F.format_string("[doc %s | year %s | project %s | seq %s]", F.substring(doc_id, 1, 10), F.coalesce(year.cast("string"), F.lit("?")), F.coalesce(project, F.lit("?")), seq.cast("string"))


def reason_prefix(reason: Column) -> Column:
    """A reason up to its colon, 60 characters at most."""
    return F.left(F.split_part(reason, F.lit(":"), F.lit(1)), F.lit(60))


def splice(text: Column, found: Column, other: Column) -> Column:
    """text with the first occurrence of `found` replaced; as it is where there is none."""
    at = F.instr(text, found) if isinstance(found, str) else F.position(found, text)
    return F.when((at > 0) & (F.char_length(found) > 0), F.concat(F.substring(text, F.lit(1), at - 1), other, F.substring(text, at + F.char_length(found), F.char_length(text))))


# Word borders as spaces, so that neighbours don't share the character between them.
_bordered = r"([^\p{L}\p{N}_])"


def shift_year(text: Column, years: int = 7) -> Column:
    """The first year of a text moved on by some years; null where there is none."""
    with_border = F.regexp_extract(text, r"(?:^|[^\p{L}\p{N}_])(?:19|20)[0-9]{2}(?:$|[^\p{L}\p{N}_])", 0)
    year = F.regexp_extract(with_border, "((?:19|20)[0-9]{2})", 1)
    moved = F.replace(with_border, year, (year.cast("int") + years).cast("string"))
    return F.when(year != "", splice(text, with_border, moved))


def scale_number(text: Column, zeros: str = "0") -> Column:
    """The first whole number of two to six digits that is no year, ten times as large; null where there is none."""
    doubled = F.regexp_replace(text, _bordered, "$1$1")
    all_numbers = F.regexp_extract_all(doubled, F.lit(r"((?:^|[^\p{L}\p{N}_])[0-9]{2,6}(?:$|[^\p{L}\p{N}_]))"), 1)
    plain = F.filter(all_numbers, lambda n: ~n.rlike(r"^[^0-9]?(?:19|20)[0-9]{2}[^0-9]?$"))
    with_border = F.get(plain, F.lit(0))
    number = F.regexp_extract(with_border, "([0-9]+)", 1)
    return F.when(with_border.isNotNull(), splice(text, with_border, F.replace(with_border, number, F.concat(number, F.lit(zeros)))))


def flip_negation(text: Column) -> Column:
    """The first " is not " made " is ", else the first " is " made " is not "; null where neither is found."""
    return F.coalesce(splice(text, F.lit(" is not "), F.lit(" is ")), splice(text, F.lit(" is "), F.lit(" is not ")))


def swap_entity(text: Column, other: str = "Zorbell", least: int = 3) -> Column:
    """The most frequent capitalised word, if it occurs `least` times, replaced after its first occurrence.

    Of equally frequent words the one that comes first counts; null where none is frequent enough. The word
    put in its place is a fixed value.
    """
    names = F.regexp_extract_all(text, F.lit(r"(?<![\p{L}\p{N}_])([A-Z][a-z]{3,})(?![\p{L}\p{N}_])"), 1)
    counted = lambda ws: F.transform(F.array_distinct(ws), lambda w, i: F.struct(F.size(F.filter(ws, lambda x: x == w)).alias("n"), (-i).alias("place"), w.alias("w")))
    # Bound to a name by a list of one, so that words are found once.
    top = F.get(F.transform(F.array(names), lambda ws: F.array_max(counted(ws))), F.lit(0))
    at = F.position(top["w"], text) + F.char_length(top["w"])
    return F.when(top["n"] >= least, F.concat(F.substring(text, F.lit(1), at - 1), F.replace(F.substring(text, at, F.char_length(text)), top["w"], F.lit(other))))


# Kinds of planted defects, in the order in which they are tried.
DEFECTS = ("entity_swap", "negation_flip", "year_shift", "number_scale")


def plant_defect(text: Column, place: Column) -> Column:
    """struct(kind, text): the defect whose turn it is at a place, or the first of the others that can be planted; null if none can."""
    made = F.array(*[F.struct(F.lit(k).alias("kind"), t.alias("text")) for k, t in zip(DEFECTS, (swap_entity(text), flip_negation(text), shift_year(text), scale_number(text)), strict=True)])
    turn = F.get(made, F.pmod(place, F.lit(len(DEFECTS))).cast("int"))
    return F.get(F.filter(F.concat(F.array(turn), made), lambda d: d["text"].isNotNull()), F.lit(0))
