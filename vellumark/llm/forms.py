"""One consistent form for text whose characters look alike (problem 6).

Texts are copied from Arrow into arrays of code points, a whole batch at a time. Lookup tables say what to
drop and what to expand, offsets place the expansions, combining marks are composed by rank over all texts
at once, and letters standing in for those of another script are resolved word by word with segment sums.
Every code point of the result keeps the place it came from.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread

# Letters of other scripts that look like a Latin letter, script by script.
CYRILLIC = "аАВсСеЕԍНіІјЈКМоОрРѕЅТԛԝхХуУԁһгүҮѵӏӀ"
CYRILLIC_AS = "aABcCeEGHiIjJKMoOpPsSTqwxXyYdhryYvlI"
GREEK = "ΑΒΕΖΗΙΚΜΝΟοΡΤΥΧνϲϳ"
GREEK_AS = "ABEZHIKMNOoPTYXvcj"
#: Greek letters that also stand for quantities beside Latin ones: look-alikes inside longer words only.
GREEK_SMALL, GREEK_SMALL_AS = "αικρυχγω", "aikpuxyw"
ARMENIAN, ARMENIAN_AS = "աօոհսզցյՕՍՏՀԼ", "wonhuqgjOUSZL"
CHEROKEE, CHEROKEE_AS = "ᎪᏴᏟᎠᎬᏀᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃᎩ", "ABCDEGHJKLMPRSTVWZY"
COPTIC, COPTIC_AS = "ⲞⲟⲢⲣⲤⲥⲘⲚⲦⲬⲎⲒⲔ", "OoPpCcMNTXHIK"
LISU, LISU_AS = "ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ"
# Marks that change nothing in sight besides the format characters (Cf).
UNSEEN = "͏ᅟᅠ឴឵᠋᠌᠍᠏ㅤﾠ"

# OTHER are scripts whose words may stand beside Latin ones without a space; the rest are told apart word by word.
LATIN, CYR, GRK, OTHER, ARM, CHR, COP, LIS = range(1, 9)
SCRIPTS = {"LATIN": LATIN, "CYRILLIC": CYR, "GREEK": GRK, "ARMENIAN": ARM, "CHEROKEE": CHR, "COPTIC": COP, "LISU": LIS}
DROP, SPACE, EXPAND = 1, 2, 3
#: Words of one or two look-alikes are settled by the words beside them; longer ones also by the other words of their line.
PARTICLE = 2


@dataclass(frozen=True)
class Tables:
    """Lookup tables by code point."""

    kind: np.ndarray  # DROP, SPACE, EXPAND or 0
    start: np.ndarray  # where the expansion begins in flat
    size: np.ndarray
    flat: np.ndarray
    told: np.ndarray  # the expansion counts as a disguise
    script: np.ndarray  # LATIN and so on, OTHER, 0 for what is no letter
    capital: np.ndarray
    quantity: np.ndarray  # Greek letters that also stand for quantities
    mark: np.ndarray  # combining class
    symbol: np.ndarray  # emoji and other symbols
    joins: np.ndarray  # letters of scripts that use joiners and direction marks
    pairs: np.ndarray  # base << 21 | mark, sorted
    composed: np.ndarray
    latin: np.ndarray  # look-alike in Latin, 0 for none
    cyrillic: np.ndarray
    greek: np.ndarray
    wide: np.ndarray  # full-width punctuation, as its plain form


@lru_cache(maxsize=1)
def tables() -> Tables:
    n = sys.maxunicode + 1
    zero = lambda t: np.zeros(n, t)
    kind, start, size, told = zero(np.uint8), zero(np.uint32), np.ones(n, np.uint8), zero(bool)
    script, mark, symbol, joins, capital, quantity = zero(np.uint8), zero(np.uint8), zero(bool), zero(bool), zero(bool), zero(bool)
    latin, cyrillic, greek, wide = zero(np.uint32), zero(np.uint32), zero(np.uint32), zero(np.uint32)
    flat: list[int] = []
    pairs: list[tuple[int, int]] = []
    for o in [*range(0x80, 0x323B0), *range(0xE0000, 0xE0200)]:
        c = chr(o)
        category = unicodedata.category(c)
        if category == "Cn":
            continue
        mark[o] = unicodedata.combining(c)
        symbol[o] = category in ("So", "Sk", "Sm") or 0x1F000 <= o < 0x20000
        if category == "Cf" or c in UNSEEN or 0xFE00 <= o <= 0xFE0F or 0xE0100 <= o <= 0xE01EF or category == "Cc" and o != 0x85:
            kind[o] = DROP
            continue
        if category in ("Zs", "Zl", "Zp") or o == 0x85:
            kind[o] = SPACE
            continue
        decomposed = unicodedata.decomposition(c).split()
        if decomposed and decomposed[0][0] != "<" and len(decomposed) == 2 and unicodedata.normalize("NFC", c) == c:
            pairs.append(((int(decomposed[0], 16) << 21) | int(decomposed[1], 16), o))
        plain = unicodedata.normalize("NFC", c)
        if decomposed and decomposed[0] in ("<wide>", "<narrow>", "<font>", "<compat>", "<initial>", "<medial>", "<final>", "<isolated>"):
            letter = category[0] == "L" or category == "Nd"
            kept = o in (0xB5, 0x587, 0x2113, 0xE33, 0xEB3) or 0x3130 <= o <= 0x318F or decomposed[0] == "<compat>" and 0x3200 <= o <= 0x33FF
            if letter and not kept:
                plain = unicodedata.normalize("NFKC", c)
            elif decomposed[0] == "<wide>" and 0xFF00 < o < 0xFF5F:
                wide[o] = o - 0xFEE0
        if plain != c:
            kind[o], told[o], start[o], size[o] = EXPAND, True, len(flat), len(plain)
            flat.extend(map(ord, plain))
        if category[0] == "L":
            name = unicodedata.name(c, "")
            script[o] = SCRIPTS.get(name.partition(" ")[0], OTHER)
            capital[o] = category == "Lu"
            joins[o] = 0x590 <= o <= 0xDFF or 0x1000 <= o <= 0x109F or 0x1780 <= o <= 0x18AF
        elif category[0] == "M":
            joins[o] = 0x590 <= o <= 0xDFF or 0x1000 <= o <= 0x109F or 0x1780 <= o <= 0x18AF
    for o in [*range(0x41, 0x5B), *range(0x61, 0x7B)]:
        script[o] = LATIN
        capital[o] = o < 0x61
    for o in range(0x20):
        if chr(o) not in "\t\n\r\f\v":
            kind[o] = DROP
    kind[0x7F] = DROP
    for c in GREEK_SMALL:
        quantity[ord(c)] = True
    for alike, as_latin in ((CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS), (GREEK_SMALL, GREEK_SMALL_AS), (ARMENIAN, ARMENIAN_AS), (CHEROKEE, CHEROKEE_AS), (COPTIC, COPTIC_AS), (LISU, LISU_AS)):
        for c, l in zip(alike, as_latin, strict=True):
            latin[ord(c)] = ord(l)
    for other, back in ((CYRILLIC, CYRILLIC_AS), (GREEK, GREEK_AS)):
        for c, as_latin in zip(other, back, strict=True):
            (cyrillic if other is CYRILLIC else greek)[ord(as_latin)] = ord(c)
    pairs.sort()
    keys, results = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
    return Tables(kind, start, size, np.array(flat or [0], np.uint32), told, script, capital, quantity, mark, symbol, joins, keys, results.astype(np.uint32), latin, cyrillic, greek, wide)


@dataclass
class Folded:
    """Texts of a batch in their consistent form, end to end, each closed by a line end."""

    points: np.ndarray  # uint32
    source: np.ndarray  # index into `before` of the first code point it came from
    ends: np.ndarray  # of each text, its line end included
    before: np.ndarray  # the texts as they were
    starts_before: np.ndarray
    disguised: np.ndarray  # bool for each text

    def strings(self) -> pa.Array:
        """The folded texts; what was null is empty."""
        keep = np.ones(len(self.points), bool)
        keep[self.ends - 1] = False
        whole = self.points[keep].astype("<u4").tobytes().decode("utf-32-le", "replace").encode("utf-8")
        p = self.points
        width = 1 + (p >= 0x80).astype(np.int64) + (p >= 0x800) + (p >= 0x10000)
        width[self.ends - 1] = 0
        offsets = np.concatenate([[0], np.cumsum(width)[self.ends - 1]])
        return pa.LargeStringArray.from_buffers(len(self.ends), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(whole))


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each closed by a line end, and where each text ends."""
    closed = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), ""), pa.scalar("\n", pa.large_string()), pa.scalar("", pa.large_string()))
    if isinstance(closed, pa.ChunkedArray):
        closed = closed.combine_chunks()
    # join(text, "\n", sep "") keeps the line end last; offsets of a sliced array begin past zero.
    offsets = np.frombuffer(closed.buffers()[1], np.int64)[closed.offset : closed.offset + len(closed) + 1]
    data = closed.buffers()[2]
    raw = b"" if data is None else data.to_pybytes()[offsets[0] : offsets[-1]]
    points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    return points, np.cumsum(pc.utf8_length(closed).to_numpy(zero_copy_only=False)).astype(np.int64)


def _neighbour(values: np.ndarray, step: int) -> np.ndarray:
    out = np.zeros_like(values)
    if step > 0:
        out[step:] = values[:-step]
    else:
        out[:step] = values[-step:]
    return out


def _dropped(p: np.ndarray, t: Tables) -> np.ndarray:
    """Which code points show nothing, without those that belong to emoji or to scripts that need them."""
    drop = t.kind[p] == DROP
    at = np.flatnonzero(drop)
    if not len(at):
        return drop
    c, before, after = p[at], np.where(at > 0, p[at - 1], 0), np.where(at + 1 < len(p), p[np.minimum(at + 1, len(p) - 1)], 0)
    symbol_before = t.symbol[before] | (before == 0xFE0F) | (before == 0x20E3)
    selector = (c >= 0xFE00) & (c <= 0xFE0F)
    keycap = (c == 0xFE0F) & (after == 0x20E3)
    ideographic = (selector | (c >= 0xE0100) & (c <= 0xE01EF)) & (t.script[before] == OTHER)
    joined = (c == 0x200D) & symbol_before & t.symbol[after]
    tagged = (c >= 0xE0020) & (c <= 0xE007F) & (t.symbol[before] | (before >= 0xE0020) & (before <= 0xE007F))
    needed = ((c == 0x200C) | (c == 0x200D)) & t.joins[before] | ((c == 0x200E) | (c == 0x200F) | (c == 0x61C)) & (t.joins[before] | t.joins[after])
    drop[at[(selector & (symbol_before | (before == 0x203C) | (before == 0x2049))) | keycap | ideographic | joined | tagged | needed]] = False
    return drop


def _composed(p: np.ndarray, src: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical order and composition; also the places (in src) where marks were composed."""
    cls = t.mark[p]
    marks = np.flatnonzero((cls > 0) | (p >= 0x1161) & (p <= 0x11C2) | (p == 0x9BE) | (p == 0x9D7))
    if not len(marks):
        return p, src, marks
    p = p.copy()
    above = marks[(marks > 0) & (cls[marks] > 0)]
    if (cls[above - 1] > cls[above]).any():
        group = np.cumsum(cls == 0)  # a starter and the marks after it
        order = np.lexsort((np.arange(len(p)), cls, group))
        p, src, cls = p[order], src[order], cls[order]
    starter = marks.copy()  # the letter that its marks follow; a text that begins with marks has the first of them
    while (back := (cls[starter] > 0) & (starter > 0)).any():
        starter[back] -= 1
    gone = np.zeros(len(p), bool)
    done: list[np.ndarray] = []
    blocked = np.zeros(len(p), np.int64)  # by starter: class of the last mark left standing
    rank = marks - starter
    lowest = np.where(cls[marks] == 0, 0, rank)
    for r in np.unique(lowest):
        now = marks[lowest == r]
        if r == 0:  # vowels and finals of syllable blocks, which are no marks: the letter before is their base
            continue
        base = starter[lowest == r]
        free = blocked[base] < cls[now]
        key = (p[base].astype(np.int64) << 21) | p[now].astype(np.int64)
        at = np.minimum(np.searchsorted(t.pairs, key), len(t.pairs) - 1)
        hit = free & (t.pairs[at] == key)
        p[base[hit]] = t.composed[at[hit]]
        gone[now[hit]] = True
        done.append(now[hit])
        blocked[base[~hit]] = cls[now[~hit]]
    # Syllable blocks: a leading consonant and a vowel, then a final consonant.
    for _ in range(2 if ((p >= 0x1161) & (p <= 0x11C2)).any() else 0):
        live = np.flatnonzero(~gone)
        a, b = p[live[:-1]].astype(np.int64), p[live[1:]].astype(np.int64)
        lv = (a >= 0x1100) & (a <= 0x1112) & (b >= 0x1161) & (b <= 0x1175)
        lvt = (a >= 0xAC00) & (a <= 0xD7A3) & ((a - 0xAC00) % 28 == 0) & (b >= 0x11A8) & (b <= 0x11C2)
        at = np.flatnonzero(lv | lvt)
        if not len(at):
            break
        p[live[at]] = np.where(lv[at], 0xAC00 + ((a[at] - 0x1100) * 21 + (b[at] - 0x1161)) * 28, a[at] + (b[at] - 0x11A7)).astype(np.uint32)
        gone[live[at + 1]] = True
        done.append(live[at + 1])
    places = src[np.concatenate(done)] if done else np.empty(0, np.int64)
    return p[~gone], src[~gone], places


def _resolved(p: np.ndarray, src: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Look-alikes of another script put right, word by word; also the places where. Lines of one script aren't looked at."""
    script = t.script[p]
    foreign = np.flatnonzero((script > LATIN) & (script != OTHER))
    if not len(foreign):
        return p, np.empty(0, np.int64)
    line = np.cumsum(p == 0x0A, dtype=np.int32)
    mixed = np.zeros(int(line[-1]) + 1, bool)
    mixed[line[foreign]] = True
    at = np.flatnonzero(mixed[line])
    p = p.copy()
    p[at], places = _resolved_lines(p[at], src[at], t)
    return p, places


def _resolved_lines(p: np.ndarray, src: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    script = t.script[p]
    word = (script > 0) & (script != OTHER)
    foreign = word & (script != LATIN)
    edge = np.flatnonzero(word & ~_neighbour(word, 1))
    stop = np.flatnonzero(word & ~_neighbour(word, -1)) + 1
    add = lambda x: np.add.reduceat(np.append(x, 0).astype(np.int64), np.stack([edge, stop], 1).ravel())[::2]
    n, is_latin, is_cyr, is_grk, is_foreign = stop - edge, add(script == LATIN), add(script == CYR), add(script == GRK), add(foreign)
    like_latin = add(foreign & (t.latin[p] > 0))
    to_cyr, to_grk = add((script == LATIN) & (t.cyrillic[p] > 0)), add((script == LATIN) & (t.greek[p] > 0))
    mixed = (is_latin > 0) & (is_foreign > 0)
    # A small Greek letter beside few Latin ones, or before them, is a quantity.
    small = add(t.quantity[p])
    quantity = (small > 0) & ((is_latin < 3) | t.quantity[p[edge]] & (n < 5))
    can_latin = mixed & (like_latin == is_foreign) & ~quantity
    can_cyr, can_grk = mixed & (is_foreign == is_cyr) & (to_cyr == is_latin), mixed & (is_foreign == is_grk) & (to_grk == is_latin)
    # Where both ways are open the script with more letters of its own decides, Latin in a tie.
    as_cyr = can_cyr & (~can_latin | (is_cyr > is_latin))
    as_grk = can_grk & (~can_latin | (is_grk > is_latin)) & ~as_cyr
    as_latin = can_latin & ~as_cyr & ~as_grk
    # Whole words of look-alikes go by the words beside them, on the same line.
    alike = (is_latin == 0) & (like_latin == n) & (small == 0)
    own = np.maximum.reduceat(np.append(script, 0), np.stack([edge, stop], 1).ravel())[::2].astype(np.int64)
    solid = np.where(add(script == np.repeat(own, n)[np.cumsum(word) - 1]) == n, own, 0) if len(edge) else own
    solid[alike] = 0
    solid[as_latin] = LATIN
    solid[as_cyr] = CYR
    line = np.cumsum(p == 0x0A)[edge]

    def beside() -> tuple[np.ndarray, np.ndarray]:
        near = _neighbour(solid, 1), _neighbour(solid, -1)
        for side, step in zip(near, (1, -1), strict=True):
            side[_neighbour(line, step) != line] = 0
        return near

    # A longer word stays what it is on a line with surer words of its script, or as an inscription: in capitals among words that aren't.
    held = np.zeros(len(edge), bool)
    if (longer := alike & (n > PARTICLE)).any():
        sure = np.unique(line[(solid > 0)] * 16 + solid[solid > 0])
        shouted = add(t.capital[p]) == n
        around = _neighbour(shouted, 1) & (_neighbour(line, 1) == line) | _neighbour(shouted, -1) & (_neighbour(line, -1) == line)
        held = longer & (np.isin(line * 16 + own, sure) | shouted & ~around)
        solid[held] = own[held]
    while True:  # a word that was settled may settle the one beside it
        left, right = beside()
        more = alike & ~held & ~as_latin & ((left == LATIN) | (right == LATIN)) & (left != own) & (right != own)
        if not more.any():
            break
        as_latin |= more
        solid[more] = LATIN
    lone = (n == 1) & (is_latin == 1) & (to_cyr == 1) & (p[edge] >= 0x61)
    as_cyr |= lone & (left == CYR) & (edge > 0) & (_neighbour(p, 1)[edge] == 0x20)
    p, places = p.copy(), []
    for chosen, table, own_script in ((as_latin, t.latin, None), (as_cyr, t.cyrillic, LATIN), (as_grk, t.greek, LATIN)):
        if chosen.any():
            inside = np.zeros(len(p) + 1, np.int64)
            inside[edge[chosen]] += 1
            inside[stop[chosen]] -= 1
            at = np.flatnonzero((np.cumsum(inside)[:-1] > 0) & (foreign if own_script is None else script == own_script))
            p[at] = table[p[at]]
            places.append(src[at])
    return p, np.concatenate(places) if places else np.empty(0, np.int64)


def fold(texts: pa.Array) -> Folded:
    """The consistent form of a batch of texts."""
    t = tables()
    before, ends_before = code_points(texts)
    starts_before = np.concatenate([[0], ends_before[:-1]]).astype(np.int64)
    disguise: list[np.ndarray] = []
    drop = _dropped(before, t)
    src = np.flatnonzero(~drop)
    disguise.append(np.flatnonzero(drop))
    p = before[src].astype(np.uint32)
    kind = t.kind[p]
    disguise.append(src[(kind == SPACE) | t.told[p]])
    # Full-width punctuation is plain punctuation unless something East Asian stands beside it.
    punctuation = t.wide[p]
    if punctuation.any():
        asian = (t.script[p] == OTHER) & (t.kind[p] != EXPAND) | (p >= 0x3000) & (p <= 0x303F) | (p >= 0xFF61) & (p <= 0xFF9F)
        # A run of such punctuation is judged by what stands at its two ends.
        inside = punctuation > 0
        first, last = np.flatnonzero(inside & ~_neighbour(inside, 1)), np.flatnonzero(inside & ~_neighbour(inside, -1))
        beside = _neighbour(asian, 1)[first] | _neighbour(asian, -1)[last]
        p = p.copy()
        at = np.flatnonzero(inside)
        at = at[~np.repeat(beside, last - first + 1)]
        p[at] = punctuation[at]
        disguise.append(src[at])
        kind = t.kind[p]
    p = np.where(kind == SPACE, 0x20, p).astype(np.uint32)
    if (kind == EXPAND).any():
        size = np.where(kind == EXPAND, t.size[p], 1).astype(np.int64)
        first = np.cumsum(size) - size
        inner = np.arange(size.sum()) - np.repeat(first, size)
        p, src, kind = np.repeat(p, size), np.repeat(src, size), np.repeat(kind, size)
        p = np.where(kind == EXPAND, t.flat[np.minimum(t.start[p] + inner, len(t.flat) - 1)], p).astype(np.uint32)
    p, src, places = _composed(p, src, t)
    disguise.append(places)
    p, places = _resolved(p, src, t)
    disguise.append(places)
    ends = np.searchsorted(src, ends_before - 1, "right")
    disguised = np.zeros(len(ends_before), bool)
    disguised[np.searchsorted(ends_before, np.concatenate(disguise), "right")] = True
    return Folded(p, src, ends, before, starts_before, disguised)


#: Bytes of text that are folded at once; one longer text is folded by itself.
FOLD_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = FOLD_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices of bounded text, so that arrays of code points stay small."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _with_forms(df: DataFrame, text: str, keep: tuple[str, ...], with_form: bool) -> DataFrame:
    narrow = df.select(*keep, F.col(text).alias("__text"))
    extra = [T.StructField("form", T.StringType())] * with_form
    schema = T.StructType([*(narrow.schema[k] for k in keep), *extra, T.StructField("disguised", T.BooleanType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep)):
            texts = batch.column(len(keep))
            folded = fold(texts)
            columns = [*batch.columns[: len(keep)]]
            if with_form:
                columns.append(pc.if_else(texts.is_valid(), folded.strings().cast(pa.string()), pa.scalar(None, pa.string())))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(folded.disguised)], names=schema.names)

    return spread(narrow).mapInArrow(run, schema)


def consistent_forms(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "seq")) -> DataFrame:
    """`keep`, `form` (the text in its consistent form) and `disguised` (whether it wasn't in it) of each row.

    One narrow pass. Disguised are invisible characters, spaces other than the plain one, letters standing
    in for a look-alike of another script, accents split from their letter, and compatibility forms of
    letters and digits. Left alone are words truly in another script, emoji sequences, typographic quotes
    and dashes, fractions, units and full-width punctuation beside East Asian text; elsewhere such punctuation
    is a compatibility form like that of letters. A null text has a null form, an empty one an empty form;
    neither is disguised. Repeated rows stay repeated. Other columns are dropped.
    """
    return _with_forms(df, text, keep, True)


def archive_texts(text_block: DataFrame, card: DataFrame) -> DataFrame:
    """(doc_id, seq, quote_no, text): blocks with quote_no -1 and the quotes of their cards from 0, copies once."""
    blocks = text_block.select("doc_id", "seq", F.lit(-1).alias("quote_no"), "text")
    quotes = card.select("doc_id", "seq", F.posexplode("quotes").alias("quote_no", "q")).select("doc_id", "seq", "quote_no", F.col("q.text").alias("text"))
    return blocks.unionByName(quotes)


def disguised_texts(text_block: DataFrame, card: DataFrame) -> DataFrame:
    """(doc_id, seq, quote_no) of texts holding a disguised character, once per key.

    Texts are judged where they are read; only the keys of the disguised ones are shuffled.
    """
    judged = _with_forms(archive_texts(text_block, card), "text", ("doc_id", "seq", "quote_no"), False)
    return judged.where("disguised").select("doc_id", "seq", "quote_no").distinct()


def archive_forms(text_block: DataFrame, card: DataFrame) -> DataFrame:
    """(doc_id, seq, quote_no, form): the consistent form of each block and quote, once per key and form."""
    return consistent_forms(archive_texts(text_block, card), keep=("doc_id", "seq", "quote_no")).select("doc_id", "seq", "quote_no", "form").distinct()
