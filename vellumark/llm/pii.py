"""Personal information inside free text (problem 2).

Each batch of texts is brought into the consistent form of `forms`, which undoes look-alikes and invisible
characters and remembers where each code point came from. Two more transducers keep that memory: one turns
runs of spelled digits into digits, one the at and dot of disguised addresses into their signs. Detectors of
plain identifiers run on the result, and the spans they find are mapped back to the stored text.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import spread
from .forms import Folded, fold, slices, tables
from .given_names import SHORT_FORMS, full_names, near_given, plain, short_names

KINDS = ("email", "phone", "id_number", "address", "name")
SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("pii_type", T.StringType(), False), T.StructField("start_at", T.IntegerType(), False), T.StructField("end_at", T.IntegerType(), False)]), False)

# Digits as words.
DIGIT_WORDS = {
    w: str(d)
    for d, words in enumerate(
        ("zero oh null zéro cero ноль", "one eins un uno один", "two zwei deux dos два", "three drei trois tres три", "four vier quatre cuatro четыре", "five fünf cinq cinco пять", "six sechs seis шесть", "seven sieben sept siete семь", "eight acht huit ocho восемь", "nine neun neuf nueve девять")
    )
    for w in words.split()
}
_word = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
SPELLED = regex.compile(rf"(?i)(?<!\w)(?:(?:{_word}|\d)[\s,.\-]{{1,2}}){{5,}}(?:{_word}|\d)(?!\w)")
SPELLED_WORD, SPELLED_DIGIT = regex.compile(rf"(?i){_word}"), regex.compile(rf"(?i){_word}|\d")
DIGIT_TOKENS = frozenset(DIGIT_WORDS) | frozenset("0123456789")

# Words for the signs of an address, as they are used to disguise it.
_at = r"at|arroba|arobase|ät|собака|アットマーク"
_dot = r"dot|punto|punkt|point|точка|ドット"
AT_WORDS, DOT_WORDS = _at.split("|"), _dot.split("|")
#: What may not stand beside a value: letters of scripts written with spaces, digits, underscores.
_L = r"\p{Latin}\p{Cyrillic}\p{Greek}\p{Nd}_"
_tld = r"(?-i:[a-z]{2,24}(?![a-z0-9])|[A-Z]{2,24}(?![A-Z0-9]))"
_label = r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?"
_boxed = lambda words: rf"(?:\[\s?(?:{words})\s?\]|\(\s?(?:{words})\s?\)|\{{\s?(?:{words})\s?\}}|<\s?(?:{words})\s?>)"
_boxed_at, _boxed_dot, _bare_dot = rf"\s?{_boxed(_at + '|@')}\s?", rf"\s?{_boxed(_dot + r'|[.]')}\s?", rf"\s(?:{_dot})\s"
_part, _any_dot = r"[A-Za-z0-9](?:[A-Za-z0-9_%+\-]*[A-Za-z0-9])?", rf"(?:\.|{_bare_dot}|{_boxed_dot})"
#: Parts chained to an address by signs, some of them disguised; a bare "at" needs a disguised dot and an ending in use.
_ending = r"(?:com|org|net|edu|gov|mil|int|info|biz|name|example|invalid|test|[a-z]{2})(?-i:(?![a-z0-9]))"
CHAINED = regex.compile(rf"(?i)(?<![A-Za-z0-9._%+\-@])(?:{_part}{_any_dot})*+{_part}(?:(?:@|{_boxed_at})(?:{_part}{_any_dot})+{_tld}|\s(?:{_at})\s(?:{_part}\.)*{_part}(?:{_bare_dot}|{_boxed_dot})(?:{_part}{_any_dot})*{_ending})")
SIGN = regex.compile(rf"(?i)(?P<at>\s(?:{_at})\s|{_boxed_at})|{_bare_dot}|{_boxed_dot}")
IN_BRACKETS = re.compile(rf"[\[({{<]\s?(?:{_at}|{_dot}|@|\.)\s?[\])}}>]")
EMAIL = regex.compile(rf"(?i)(?<![A-Za-z0-9._%+\-@])[A-Za-z0-9](?:[A-Za-z0-9._%+\-']*[A-Za-z0-9_+\-])?\s?@\s?(?:{_label}\.)+{_tld}(?![A-Za-z0-9\-]*@)")

_ext = r"(?:,?\s?(?:ext|extn|extension|x|Durchwahl|Dw|App|poste|int|доб)\.?\s?\d{1,6})?"
_before = rf"(?<![{_L}+@.,/\-:])(?<!\d[ \-])"
_after = r"(?![\p{Nd}\p{Ll}_@]|\p{Lu}[\p{Lu}\p{Nd}])(?![.\-/,:]\d)"
PHONE = regex.compile(
    rf"{_before}(?:"
    rf"(?:\+|00)[1-9]\d{{0,2}}(?:[ .\-/]?\(\d{{1,5}}\))?(?:[ .\-/]?\d{{1,6}}){{2,6}}"  # with country code
    rf"|\(0?\d{{2,5}}\)[ \-/]?\d{{2,4}}(?:[ .\-]?\d{{2,5}}){{1,3}}"  # area in brackets
    rf"|(?:1[ .\-])?[2-9]\d{{2}}([ .\-])\d{{3}}\1\d{{4}}"  # 3-3-4
    rf"|0\d{{1,4}}[ /\-]\d{{3,8}}(?:[ \-]\d{{2,6}}){{0,3}}"  # national, trunk prefix
    rf"|0\d(?:[ .]\d\d){{4}}"
    rf"|0\d{{9,10}}"
    rf"|[2-9]\d{{2}}[.\-]?\d{{4}}"  # subscriber number
    rf"|(?:\d-){{6,10}}\d"
    rf"){_ext}{_after}",
    regex.IGNORECASE,
)
#: Enough digits close by for an identifier, for a telephone number.
FIVE_DIGITS, SEVEN_DIGITS = re.compile(r"\d(?:\D{0,3}\d){4}"), re.compile(r"\d(?:\D{0,3}\d){6}")
_cue = regex.compile(r"(?i)(?:tel|call|phone|fon|tél|mobile|handy|fax|message on|number|joindre|llamar|erreichbar|anruf|numéro|móvil|cell|ring|звон|тел|電話)[^\d]{0,24}$")

ID_NUMBER = regex.compile(
    rf"(?<![{_L}@.\-/+])(?:"
    rf"\d{{3}}([ \-])\d{{2}}\1\d{{4}}"  # 3-2-4
    rf"|[A-CEGHJ-PR-TW-Z][A-NP-Z] ?\d{{2}} ?\d{{2}} ?\d{{2}} ?[A-D]|QQ ?\d{{2}} ?\d{{2}} ?\d{{2}} ?[A-D]"
    rf"|[12] ?\d{{2}} ?\d{{2}} ?\d[\dAB] ?\d{{3}} ?\d{{3}}(?: ?\d{{2}})?"  # 13 or 15 digits
    rf"|\d\d \d{{3}} \d{{3}} \d{{3}}"
    rf"|[XYZ]-?\d{{7}}-?[A-Z]|\d{{8}}-?[A-HJ-NP-TV-Z]"
    rf"|[CFGHJKLMNPRTVWXYZ](?:\d\d[CFGHJKLMNPRTVWXYZ]){{2}}\d\d"
    rf"){_after}"
)
CUED_ID = regex.compile(
    rf"(?i)(?:\bSSN|\bNINO?\b|national id|passport|pasaporte|passeport|reisepass|steuer-?id|ausweis|\bDNI\b|\bNIE\b|sécurité sociale|social security|identity (?:card|number)|id number|паспорт|マイナンバー)"
    rf"(?:(?!ISBN)[\p{{L}} .:#/\-]){{0,22}}?(?-i:(?<![{_L}\-])((?:[A-Z]{{1,3}} ?)?\d[A-Z0-9]*(?:[ \-][A-Z]{{0,2}}\d[A-Z0-9]*){{0,6}}))(?![{_L}@])"
)

ID_CUES = ("ssn", "nin", "national id", "passport", "pasaporte", "passeport", "reisepass", "steuer", "ausweis", "dni", "nie", "sécurité sociale", "social security", "identity", "id number", "паспорт", "マイナンバー")

# Words for streets in several languages.
_road = r"Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Boulevard|Blvd|Court|Ct|Drive|Place|Square|Sq|Terrace|Way|Close|Crescent|Row|Gardens|Hill|Mews|Alley|Parade|Highway"
_flat = r"(?:Flat|Apt\.?|Apartment|Unit|Suite) \d+(?:[A-Za-z](?![\p{Latin}\d]))?"
_cap = r"[\p{Lu}][\p{L}'’\-]*"
_rue = r"rue|avenue|boulevard|place|impasse|allée|chemin|quai|cours|route|passage|square"
_calle = r"Calle|C/|Avenida|Avda\.?|Av\.|Plaza|Pza\.?|Paseo|Camino|Carrera|Ronda|Travesía|Via|Viale|Piazza|Corso|Rua"
_strasse = r"(?:straße|strasse|str\.|gasse|weg|platz|allee|ring|damm|ufer|steig|chaussee)"
_große = r"(?:(?:Alte|Neue|Große|Kleine|Obere|Untere|Lange|Hohe) )?"
_no, _end = rf"(?<![{_L}])", rf"(?![{_L}])"
# A short abbreviation keeps its full stop; after Blvd it may be the sentence's.
_stop = r"(?:(?<=(?:Rd|St|Ave|Ln|Ct|Sq))\.|(?<=Blvd)\.(?=[.,]| \p{Ll}))?"
ADDRESS = [
    regex.compile(rf"{_no}(?:{_flat},? )?\d{{1,5}} ?[a-z]?(?:-\d+)?,? (?:(?:[NSEW]|North|South|East|West)\.? )?(?:{_cap} ){{1,3}}?(?:{_road})(?![\p{{Ll}}_]){_stop}(?:,? {_flat})?"),
    regex.compile(rf"(?i){_no}\d{{1,4}}(?: ?(?:bis|ter|quater|[a-d]))?,? (?:{_rue}) (?:(?:du |des |de la |de l['’]|de |d['’]|la |le |les |l['’])){{0,3}}(?-i:{_cap}(?: {_cap}(?=\n|$))?)"),
    regex.compile(rf"{_no}(?:{_calle}) ?(?:(?:de la|de los|de las|del|de|la|el) ){{0,3}}{_cap}(?: (?:de |del |y )?{_cap}){{0,4}},? (?:n\.?º ?)?\d{{1,4}}(?: ?(?:bis|[a-d]){_end})?(?:, \d{{1,2}}\.?[ºª°o]?(?: ?[A-Z]{_end}| (?:izda|dcha)\.?)?)?{_end}"),
    regex.compile(rf"{_no}(?:(?:Am|An der|An den|Im|In der|Auf dem|Auf der|Zum|Zur|Unter den|Hinter der) (?:{_cap} ){{0,2}}{_cap}|{_große}{_cap}{_strasse}|{_große}{_cap}[ \-](?:Straße|Strasse|Str\.|Gasse|Weg|Platz|Allee|Ring|Damm|Ufer|Hof|Steig)) \d{{1,4}}(?: ?[a-h]{_end})?(?:[/\-]\d+)?{_end}"),
    regex.compile(rf"(?i){_no}(?:ул\.?|улица|пр-?т\.?|проспект|пер\.|переулок|наб\.) (?-i:{_cap}(?: {_cap})?),? (?:д\.? ?|дом )?\d{{1,4}}(?:,? ?(?:кв\.?|квартира) ?\d+)?"),
]
# Each notation has one of these words, in lower case.
ADDRESS_NEEDS = [
    _road.lower().split("|"), _rue.split("|"), ["calle", "c/", "avenida", "avda", "av.", "plaza", "pza", "paseo", "camino", "carrera", "ronda", "travesía", "via", "piazza", "corso", "rua"],
    ["straße", "strasse", "str.", "gasse", "weg", "platz", "allee", "ring", "damm", "ufer", "hof", "steig", "chaussee", "am ", "an de", "im ", "in der", "auf de", "zum ", "zur ", "unter den", "hinter der"], ["ул", "пр", "пер", "наб"],
]
_dates = regex.compile(r"^(?:Am|Im|Zum) (?:\d|(?:Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahr|Jahre|Sommer|Winter|Herbst|Frühling)\b)")

TITLES = r"Dr|Prof|Professor|Mr|Mrs|Ms|Miss|Mx|Herr|Frau|Hr|Fr|Mme|Mlle|Madame|Monsieur|M|Sr|Sra|Srta|Señor|Señora|Don|Doña|Sir|Lady|Dame|Rev|Ing|Dipl\.-Ing"
_letter = r"\p{Latin}\p{Cyrillic}\p{Greek}"
_name = rf"\p{{Lu}}[{_letter}\p{{M}}'’\-]*[{_letter}]"
_particle = r"(?:(?:de la|de los|del|de|di|da|van der|van den|van|von der|von|zu|af|la|le|al|bin|ibn) )?"
PAIR = regex.compile(rf"(?<![{_L}@/])({_name})((?: (?:\p{{Lu}}\.?|{_name}(?= {_name})))??)( | ?-)({_particle}{_name})(?![{_L}@_])", regex.V1)
TURNED = regex.compile(rf"(?<![{_L}@/])({_particle}{_name}), ({_name})((?: \p{{Lu}}\.)?)(?![{_L}@_])")
INITIALS = regex.compile(rf"(?<![{_L}@/])(?:((?:\p{{Lu}}\.? ){{1,3}}){_particle}{_name}|(?!(?:{TITLES})\b)({_name}),? (?:\p{{Lu}}\.){{1,2}})(?![{_L}@_])")
LOWER = regex.compile(rf"(?<![{_L}@./\-])(\p{{Ll}}{{4,}}) (\p{{Ll}}{{4,}})(?![{_L}@])")
HYPHENED = regex.compile(rf"(?<![{_L}@./\-])(\p{{Lu}}[{_letter}]+)-(\p{{Lu}}[{_letter}]{{3,}})(?![{_L}@\-])")
PLACE_WORD = regex.compile(rf"(?i)\b(?:{_road}|park|bridge|house|station|island|river|lake|mount|north|south|east|west|new|old|saint|san|santa|project|projekt|proyecto|projet|team|group|club|band|radio|times|post|day|night|january|february|march|april|may|june|july|august|september|october|november|december|monday|tuesday|wednesday|thursday|friday|saturday|sunday|english|french|german|spanish|russian|japanese)\b")
NEXT_NAME = regex.compile(rf"\s({_name})")
TITLE_BEFORE = regex.compile(rf"(?<![\p{{L}}])(?:{TITLES})\.?\s$")
# What people do to people, and what only people do, in several languages.
_done_to = "met|saw|asked|told|thanked|phoned|called|promised|married|hired|knew|knows|know|introduced|interviewed|emailed|texted|paid|helped|believed|trusted|gave|showed|lent|sent|owed|invited|rencontré|rencontrai|appelé|vu|remercié|demandé à|traf|getroffen|fragte|gefragt|sah|kannte|dankte|conocí|vi a|llamé a|conoció a|encontré a"
_done_by = (
    "who|whose|said|says|told|asked|asks|called|calls|wrote|writes|signed|signs|promised|replied|answered|insisted|agreed|admitted|explained|thinks|thought|knew|knows|phoned|emailed|smiled|laughed|nodded|apologised|apologized|resigned|married|died|remembers|remembered|suggested|mentioned|wondered|complained"
    "|qui a|a dit|a appelé|a écrit|a signé|a promis|a répondu|dit que|écrit que|pense que|sagte|sagt|schrieb|schreibt|rief|ruft|fragte|meinte|meint|unterschrieb|versprach|dijo|dice|llamó|escribió|escribe|firmó|prometió|respondió|preguntó|piensa|сказал|сказала|написал|написала|позвонил|позвонила|обещал|обещала|подписал|подписала"
)
NAME_CUE = regex.compile(rf"(?:(?<![\p{{L}}])(?:{TITLES})\.?\s|(?i:\b(?:present|signed(?: by)?|signature|unterschrift|gezeichnet|firmado(?: por)?|firmó|signé(?: par)?|attendees?|from|author|contact|anwesend|presentes?|présents?|name|nombre|nom)\b):?\s|\b(?:{_done_to})\s)$")
# The last words of these cues, without full stop or colon: only behind one of them is a cue looked for.
LAST_WORDS = frozenset(w.rsplit(" ", 1)[-1].lower() for w in f"{_done_to}|{TITLES.replace(chr(92), '')}|present|signed|by|signature|unterschrift|gezeichnet|firmado|por|firmó|signé|par|attendee|attendees|from|author|contact|anwesend|presente|presentes|présent|présents|name|nombre|nom".split("|"))
PERSON_BEFORE = regex.compile(rf"\b(?:{_done_to})\s$")
ARTICLE = regex.compile(r"(?i)(?<![\p{L}])(?:the|a|an|this|that|our|der|die|das|den|dem|des|ein|eine|einen|el|la|los|las|un|una|le|les|une|il|lo)\s$")
PERSON_AFTER = regex.compile(rf"\s(?:{_done_by})(?![\p{{L}}])")
# Words that begin with a capital where they begin a sentence or name no person.
NO_SURNAME = frozenset(
    "the a an in on at by to of for from and or but if it its he she we they you i my your his her our their this that these those there then than when where why who what which how no not nobody somebody everybody after before between during since until while two three four five each every some any all both out up down off over under again once tomorrow yesterday today slowly version project room score commit ratio part address email tel isbn national passport version page pages "
    "der die das ein eine auf aus bei für im mit nach seit und von vor warum wie wir zum zur zwei niemand morgen gestern später meine mein gegen wer und ich es sie er "
    "le la les un une des il elle on nous vous je tu mon mes ma sur sous dans pour par pourquoi demain hier plus personne sans enfin comme tél "
    "el los las una unos hay por para sobre sin con mañana ayer nadie todavía leí mis mi al del desde correo "
    "street avenue road lane court company institute university department society association foundation corporation laboratory limited office archive press museum library school college bank".split()
)


# What a turned name, one with an initial and one in lower case hold at least; no small letter of ASCII is a capital.
COMMA_NAME, ONE_LETTER = re.compile(r", [^\W\d_a-z]"), re.compile(r"\b[^\W\d_a-z][. ]")
LAST_WORD = re.compile(r"([^\W\d_]+)[.:]{0,2}$")
LONG_WORD = re.compile(r"[^\W\d_]{4,}")


@lru_cache(maxsize=1)
def small_names() -> frozenset[str]:
    """Given names of the list in lower case, with and without marks."""
    return full_names() | frozenset(n.lower() for n in SHORT_FORMS)


def _surname(word: str) -> bool:
    last = plain(word.split()[-1].split("-")[-1])
    return len(last) >= 3 and last not in NO_SURNAME and word.split()[0].lower().split("'")[0] not in NO_SURNAME


def _given(word: str) -> bool:
    return bool(near_given(plain(word)))


def _known(word: str) -> bool:
    p = plain(word)
    return p in full_names() or p in short_names()


#: How far before a find its cue may begin; no cue is longer.
CUE_CHARS = 64


def before(cue: regex.Pattern, text: str, at: int) -> bool:
    """Whether a cue stands right before a place; only the characters next to it are read."""
    return bool(cue.search(text, max(0, at - CUE_CHARS), at))


def cued_by(cue: regex.Pattern, text: str, at: int) -> bool:
    """`before` for the cues of names, which end in one of LAST_WORDS and a space."""
    if not text[at - 1 : at].isspace() or not (words := text[max(0, at - 32) : at].split()):
        return False
    last = LAST_WORD.search(words[-1])
    return last is not None and last[1].lower() in LAST_WORDS and before(cue, text, at)


def _sentence_start(text: str, at: int) -> bool:
    near = text[max(0, at - CUE_CHARS) : at]
    head = near.rstrip()
    return not head or head[-1] in ".!?。！？…»”\"" or "\n" in near[len(head) :]


def names(text: str) -> Iterator[tuple[int, int]]:
    """Spans of people's names of two or more parts, without title."""
    for m in TURNED.finditer(text) if COMMA_NAME.search(text) else ():
        last, first = m[1], m[2]
        cued = cued_by(NAME_CUE, text, m.start())
        if not (_known(first) or _given(first) and (cued or len(first) > 4)) or not _surname(last) or _known(last):
            continue
        if _sentence_start(text, m.start()) and not cued and (follow := NEXT_NAME.match(text, m.end())) and _surname(follow[1]):
            continue  # "However, Robert Miller said"
        yield m.start(), m.end()
    at = 0
    while m := PAIR.search(text, at):
        first, second = m[1], m[4]
        at = m.start() + len(first)
        title = cued_by(TITLE_BEFORE, text, m.start())
        done = bool(PERSON_AFTER.match(text, m.end()))
        cued = title or done or cued_by(NAME_CUE, text, m.start())
        if m[3].endswith("-") and not (_known(first) and _surname(second)):
            continue
        if first.isupper() and not second.isupper() and len(first) > 2:  # SURNAME Given
            good = _given(second) and _surname(first)
        elif _given(first):
            begins = _sentence_start(text, m.start()) and regex.match(r" \p{Ll}", text[m.end() : m.end() + 2])
            good = _surname(second) and (_known(first) or cued or len(first) >= 5 or begins)
        else:
            # A name of no list: a person does it, or it is done to one, and both words are shaped like names.
            shaped = not first.isupper() and not second.isupper() and not before(ARTICLE, text, m.start()) and not PLACE_WORD.search(m[0]) and (cued_by(PERSON_BEFORE, text, m.start()) or done)
            good = (title or cued and _given(second) or shaped) and _surname(first) and _surname(second) and first.lower() not in NO_SURNAME
        if good:
            yield m.start(), m.end()
            at = m.end()
    for m in INITIALS.finditer(text) if ONE_LETTER.search(text) else ():
        surname = regex.sub(r"(?:^| |,)\p{Lu}\.?(?= |\.|$)", " ", m[0]).strip(" .,")
        if not surname or not _surname(surname):
            continue
        lone = m[1] and (m[1][1] == "." or m[1][0] not in "AEIOUY") and _sentence_start(text, m.start()) and regex.match(r" \p{Ll}", text[m.end() : m.end() + 2])
        if lone or cued_by(NAME_CUE, text, m.start()) or PERSON_AFTER.match(text, m.end()):
            yield m.start(), m.end()
    for m in LOWER.finditer(text, overlapped=True) if not small_names().isdisjoint(LONG_WORD.findall(text)) else ():
        if plain(m[1]) in full_names() and plain(m[2]) not in NO_SURNAME and (_sentence_start(text, m.start()) or cued_by(NAME_CUE, text, m.start())):
            yield m.start(), m.end()
    for m in HYPHENED.finditer(text):
        if plain(m[1]) in full_names() and not _known(m[2]):
            yield m.start(), m.end()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        digits = sum(c.isdigit() for c in regex.split(r"(?i)ext|x|Durchwahl|App|poste", m[0])[0])
        if digits < 7 or digits > 15:
            continue
        if digits == 7 and not before(_cue, text, m.start()):
            continue  # so short a number may be anything else
        yield m.start(), m.end()


def ids(text: str) -> Iterator[tuple[int, int, bool]]:
    for m in ID_NUMBER.finditer(text):
        yield m.start(), m.end(), False
    low = text.lower()
    for m in CUED_ID.finditer(text) if any(w in low for w in ID_CUES) else ():
        if sum(c.isdigit() for c in m[1]) >= 6:
            yield m.start(1), m.end(1), True


def addresses(text: str) -> Iterator[tuple[int, int]]:
    low = text.lower()
    for pattern, needs in zip(ADDRESS, ADDRESS_NEEDS, strict=True):
        if any(w in low for w in needs):
            for m in pattern.finditer(text):
                if not _dates.match(m[0]):
                    yield m.start(), m.end()


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in order of place; of spans that overlap the one of the surer kind, then the longer, stays."""
    found: list[tuple[int, int, str, int]] = []
    # Each detector runs where what it needs is in the text at all.
    if "@" in text:
        found += [(m.start(), m.end(), "email", 0) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        if FIVE_DIGITS.search(text):
            found += [(a, b, "id_number", 1 + cued) for a, b, cued in ids(text)]
            if SEVEN_DIGITS.search(text):
                found += [(a, b, "phone", 1) for a, b in phones(text)]
        found += [(a, b, "address", 3) for a, b in addresses(text)]
    found += [(a, b, "name", 4) for a, b in names(text)]
    taken: list[tuple[int, int, str]] = []  # in order of place, none overlapping another
    for a, b, kind, _ in sorted(found, key=lambda f: (f[3], f[0] - f[1], f[0])):
        at = bisect(taken, (a, b, kind))
        if (at == 0 or taken[at - 1][1] <= a) and (at == len(taken) or b <= taken[at][0]):
            taken.insert(at, (a, b, kind))
    return [(kind, a, b) for a, b, kind in taken]


DIGIT = re.compile(r"\d")


class Traced:
    """A text with the first and last place of each of its characters in the text it was made from."""

    def __init__(self, text: str):
        self.text, self.first, self.last = text, None, None

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Put other characters, or none, for the spans of `edits`, which come in order; they keep the span's place."""
        if not edits:
            return
        first, last = self.first or list(range(len(self.text))), self.last or list(range(len(self.text)))
        out, firsts, lasts, at = [], [], [], 0
        for start, end, new in [*edits, (len(self.text), len(self.text), "")]:
            out += [self.text[at:start], new]
            firsts += [*first[at:start], *[first[start]] * len(new)] if new else first[at:start]
            lasts += [*last[at:start], *[last[end - 1]] * len(new)] if new else last[at:start]
            at = end
        self.text, self.first, self.last = "".join(out), firsts, lasts

    def place(self, start: int, end: int) -> tuple[int, int]:
        return (start, end) if self.first is None else (self.first[start], self.last[end - 1] + 1)


def undigit(t: Traced) -> None:
    """Runs of spelled digits as digits."""
    words = t.text.lower().replace(",", " ").replace(".", " ").replace("-", " ").split()
    if sum(map(DIGIT_TOKENS.__contains__, words)) < 6:
        return
    edits = []
    for hit in SPELLED.finditer(t.text):
        if SPELLED_WORD.search(hit[0]):
            at = hit.start()
            for m in SPELLED_DIGIT.finditer(t.text, hit.start(), hit.end()):
                edits += [(at, m.start(), ""), (m.start(), m.end(), DIGIT_WORDS.get(m[0].lower(), m[0]))]
                at = m.end()
    t.rewrite(edits)


def unsign(t: Traced) -> None:
    """The disguised signs between the parts of an address, as [at] or as bare words, as what they stand for."""
    low = t.text.lower()
    boxed = IN_BRACKETS.search(low)
    if not (boxed or any(w in low for w in DOT_WORDS)) or not (boxed or "@" in low or any(f" {w} " in low for w in AT_WORDS)):
        return
    edits = []
    for chain in CHAINED.finditer(t.text):
        edits += [(m.start(), m.end(), "@" if m["at"] else ".") for m in SIGN.finditer(t.text, chain.start(), chain.end())]
    t.rewrite(edits)


def found_in(folded: Folded) -> Iterable[list[tuple[str, int, int]]]:
    """Spans of each text of a batch, in code points of the text as it was."""
    t = tables()
    begin = 0
    for k, end in enumerate(folded.ends.tolist()):
        text = folded.points[begin : end - 1].tobytes().decode("utf-32-le", "replace")
        source, origin = folded.source, int(folded.starts_before[k])
        traced = Traced(text)
        undigit(traced)
        unsign(traced)
        spans = []
        for kind, a, b in find(traced.text):
            a, b = traced.place(a, b)
            start, stop = int(source[begin + a]) - origin, int(source[begin + b - 1]) + 1 - origin
            while t.mark[folded.before[origin + stop]]:  # marks composed into the last letter
                stop += 1
            spans.append((kind, start, stop))
        begin = end
        yield spans


def with_spans(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "seq"), masked: str | None = None) -> DataFrame:
    """`keep` and `spans`, an array of (pii_type, start_at, end_at) in code points; with `masked` also the text
    with each span replaced by its typed placeholder, as in [EMAIL], and all else unchanged.

    One narrow pass. Null and empty texts have no spans, and a null text stays null when masked.
    """
    narrow = df.select(*keep, F.col(text).alias("__text"))
    schema = T.StructType([*(narrow.schema[k] for k in keep), T.StructField("spans", SPAN_TYPE, False), *([T.StructField(masked, T.StringType())] if masked else [])])
    kind = pa.list_(pa.struct([("pii_type", pa.string()), ("start_at", pa.int32()), ("end_at", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, len(keep)):
            texts = batch.column(len(keep))
            spans = list(found_in(fold(texts)))
            columns = [*batch.columns[: len(keep)], pa.array([[{"pii_type": s[0], "start_at": s[1], "end_at": s[2]} for s in x] for x in spans], kind)]
            if masked:
                columns.append(pa.array([None if v is None else mask(v, s) for v, s in zip(texts.to_pylist(), spans, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return spread(narrow).mapInArrow(run, schema)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, start, end in spans:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def places(text_block: DataFrame) -> DataFrame:
    """(doc_id, seq, pii_type, start_at, end_at): each place once per block, however often the block is stored."""
    spans = with_spans(text_block).where(F.size("spans") > 0)
    return spans.select("doc_id", "seq", F.inline("spans")).distinct()


def masked_blocks(text_block: DataFrame) -> DataFrame:
    """(doc_id, seq, masked): each block's text with typed placeholders, once per block and text."""
    return with_spans(text_block, masked="masked").select("doc_id", "seq", "masked").distinct()
