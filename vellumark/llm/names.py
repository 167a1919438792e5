"""Variant spellings of the names of people and organisations (problem 1).

Every distinct spelling is parsed into its tokens: a key (surname, or an organisation's own name) and the
rest. All tokens are joined with one another by a prefix-filtered set-similarity join on their q-grams. Spellings
whose tokens are alike one by one, in either order, are then verified by soft weighted token similarity: tokens
match as they are, as short forms, initials, abbreviations or slips of the pen, and rare tokens count more.
Spellings that fit several entities stand for none of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut
from .given_names import full_names, full_of, near_given, one_edit_apart, plain

#: Length of the grams, and how many of the rarest of a token are joined: one slip, a swap of neighbours at
#: most, changes Q + 1 grams, so two tokens one slip apart share one of their first Q + 2.
Q, PREFIX = 3, 5
#: Soft weighted similarity from which two spellings are one entity.
SAME = 0.8
#: Least length of a given name that may have a slip: shorter ones are too often two names.
SLIP_CHARS = 5
#: Least length of a token that may have two slips, both of them swaps of neighbours.
SWAPS_CHARS = 8
#: A word of an organisation is mended to one that so many spellings hold, and so many times as many as hold the word itself.
MEND_LEAST, MEND_TIMES = 10, 10

# What stands before or after a name without being part of it.
TITLES = frozenset("dr prof professor mr mrs ms miss mx herr frau hr mme mlle madame monsieur sr sra srta señor señora don doña sir lady dame rev ing".split())
SUFFIXES = frozenset("phd md jr sr junior senior esq msc ma ba mba dds ii iii iv".split())
# Words that say what kind of organisation it is, with their abbreviations.
ORG_TYPES = {
    "association": "assn assoc", "society": "soc", "institute": "inst", "institution": "instn", "university": "univ uni", "college": "coll", "laboratory": "lab labs", "laboratories": "", "department": "dept dep", "company": "co", "corporation": "corp",
    "foundation": "fdn found fnd", "limited": "ltd", "brothers": "bros", "incorporated": "inc", "group": "grp", "agency": "agcy", "bureau": "bur", "office": "off", "ministry": "min", "committee": "comm cttee", "council": "cncl", "centre": "ctr", "center": "", "academy": "acad", "trust": "tr", "museum": "mus", "library": "libr",
    "press": "", "archive": "", "bank": "bk", "union": "", "club": "", "school": "sch", "federation": "fed", "partners": "", "sons": "", "works": "wks", "gmbh": "", "ag": "", "verein": "ev", "gesellschaft": "ges",
}
_short_types = {a: t for t, v in ORG_TYPES.items() for a in v.split()}
SMALL_WORDS = frozenset("the of for and de la du des der die das und et y el los las a an".split())

PARSED = T.StructType(
    [
        T.StructField("s", T.StringType(), False),
        T.StructField("n", T.LongType(), False),
        T.StructField("kind", T.StringType(), False),  # person or org
        T.StructField("key", T.StringType(), False),  # surname, or an organisation's own name
        T.StructField("form", T.StringType(), False),  # full, variant, initial
        T.StructField("given", T.ArrayType(T.StringType()), False),  # full given names it may be, or the initial
        T.StructField("rest", T.ArrayType(T.StringType()), False),  # an organisation's other words
    ]
)


def words_of(s: str) -> list[str]:
    return regex.findall(r"[\p{L}\p{M}][\p{L}\p{M}'’\-]*\.?|&", s)


def is_org_word(w: str) -> bool:
    p = plain(w.rstrip("."))
    return p in ORG_TYPES or p in _short_types and (w.endswith(".") or p in ("ltd", "inc", "corp", "bros", "dept", "univ", "assn", "assoc", "co", "inst", "lab", "labs", "fdn", "coll", "acad"))


def parse_org(s: str, rarity: Mapping[str, int], mend: Callable[[str], str] = str) -> tuple[str, str, list[str]] | None:
    """(key, form, rest) of an organisation's name; `rarity` counts words over all spellings, `mend` corrects one."""
    words = words_of(s)
    if len(words) < 2:
        return None
    turned = regex.match(r"^(.+?) of (.+), (\S+)$", s.strip())
    if turned:  # "Institute of Weather, Name"
        words = [*words_of(turned[3]), *words_of(turned[2]), *words_of(turned[1])]
    words = [w for w in words if plain(w) not in SMALL_WORDS]
    typed = [i for i, w in enumerate(words) if is_org_word(w)]
    acronym = regex.fullmatch(r"\p{Lu}{2,5}", words[-1]) if words else None
    shouted = s.isupper()
    if len(words) == 2 and acronym and not shouted and not words[0].isupper() and not typed:
        return plain(words[0]), "variant", ["*" + plain(words[1])]
    if not typed or len(words) < 2:
        return None
    plains = [plain(w.rstrip(".")) if w.endswith(".") else mend(plain(w)) for w in words]
    # Its own name is the rarest word that says nothing about its kind.
    own = min((i for i in range(len(words)) if i not in typed and not words[i].endswith(".")), key=lambda i: (rarity.get(plains[i], 0), i), default=None)
    if own is None:
        return None
    rest = [p + "." if w.endswith(".") and p not in ORG_TYPES else p for i, (w, p) in enumerate(zip(words, plains, strict=True)) if i != own]
    rest = [r if r.rstrip(".") not in _short_types else r.rstrip(".") + "." for r in rest]
    return plains[own], "variant" if any(r.endswith(".") for r in rest) else "full", rest


def parse_person(s: str) -> tuple[str, str, list[str]] | None:
    """(key, form, given) of a person's name of two parts or more."""
    text = regex.sub(r"\s+", " ", s).strip()
    parts = [p.strip() for p in text.split(",")]
    while len(parts) > 1 and plain(parts[-1]).replace(".", "") in SUFFIXES:
        parts.pop()
    turned = len(parts) == 2
    if len(parts) > 2:
        return None
    if turned:
        parts = parts[::-1]  # given, surname
    words = [w for p in parts for w in p.split()]
    words = [w for w in words if plain(w).rstrip(".") not in TITLES or len(plain(w).rstrip(".")) == 1]
    while len(words) > 1 and plain(words[-1]).replace(".", "") in SUFFIXES:
        words.pop()
    if len(words) == 1 and "-" in words[0]:
        first, _, last = words[0].partition("-")
        words = [first, last] if near_given(plain(first)) else words
    if len(words) < 2 or any(regex.search(r"[\d@/&]", w) for w in words):
        return None
    clean = [regex.sub(r"[^\p{L}\p{M}\-'’]", "", w) for w in words]
    if not all(clean):
        return None
    single = [len(c) == 1 for c in clean]
    if not turned and not text.isupper() and clean[0].isupper() and len(clean[0]) > 1 and not clean[-1].isupper() and not single[-1]:
        clean, single = [*clean[1:], clean[0]], [*single[1:], single[0]]  # SURNAME Given
    elif not turned and single[-1] and not single[0]:
        clean, single = [*clean[1:], clean[0]], [*single[1:], single[0]]  # Surname G.
    if single[-1]:
        return None
    surname, first = plain(clean[-1]), plain(clean[0])
    if single[0]:
        others = [plain(c) for c, one in zip(clean[1:-1], single[1:-1], strict=True) if not one]
        if not others:
            return surname, "initial", [first]
        first = others[0]
    if text.islower() and not near_given(first):
        return None  # no name but words
    if first in full_names():
        return surname, "full", sorted(full_of()[first])[:1]
    # What it is short for comes before what it may be a slip of.
    may_be = [*sorted(full_of().get(first, ())), *sorted(n for n in full_names() if len(first) >= 2 and n not in full_of().get(first, ()) and one_edit_apart(first, n))]
    if may_be:
        return surname, "variant", may_be
    return surname, "full", [first]


def fits_abbreviation(short: list[str], full: list[str]) -> bool:
    """Whether words, some of them abbreviated, stand for the full ones: in order, first for first and last for last."""
    if len(short) == 1 and short[0].startswith("*"):
        return short[0][1:] == "".join(w[0] for w in full)
    if not short or not full or len(short) > len(full):
        return False

    def fits(a: str, b: str) -> bool:
        if not a.endswith("."):
            return a == b or one_edit_apart(a, b)
        a = a[:-1]
        if _short_types.get(a) == b:
            return True
        letters = iter(b)
        return a[:1] == b[:1] and all(c in letters for c in a)

    if not fits(short[0], full[0]) or not fits(short[-1], full[-1]):
        return False
    at = 1
    for a in short[1:-1]:
        while at < len(full) - 1 and not fits(a, full[at]):
            at += 1
        if at >= len(full) - 1:
            return False
        at += 1
    return True


def slips(a: str, b: str) -> int | None:
    """How many slips of the pen two tokens are apart: 0, 1, or 2 where both are swaps of neighbours; None if more."""
    if a == b:
        return 0
    if max(len(a), len(b)) > 1 and one_edit_apart(a, b):
        return 1
    if len(a) != len(b) or len(a) < SWAPS_CHARS:
        return None
    swaps, i = 0, 0
    while i < len(a):
        if a[i] == b[i]:
            i += 1
        elif a[i : i + 2] == b[i : i + 2][::-1]:
            swaps, i = swaps + 1, i + 2
        else:
            return None
    return 2 if swaps == 2 else None


def _word_slip(a: list[str], b: list[str]) -> bool:
    """Whether two sequences of words differ in one slip of one longer word."""
    differing = [(x, y) for x, y in zip(a, b) if x != y]  # noqa: B905
    return len(a) == len(b) and len(differing) == 1 and min(map(len, differing[0])) >= SLIP_CHARS and one_edit_apart(*differing[0])


def spellings(card: DataFrame) -> DataFrame:
    """(s, n, as_name, other): distinct spellings, how often they are written, and how often as a name of no person or organisation."""
    e = card.select(F.explode("entities").alias("e")).where(F.col("e").isNotNull()).select("e.name", F.lower("e.kind").alias("kind"), "e.aliases")
    foreign = F.coalesce(F.col("kind").isin("concept", "tool", "place", "work", "event", "thing", "topic"), F.lit(False))
    named = e.select(F.col("name").alias("s"), F.lit(1).alias("as_name"), foreign.cast("int").alias("other"))
    alias = e.select(F.explode("aliases").alias("s"), F.lit(0).alias("as_name"), F.lit(0).alias("other"))
    seen = named.unionByName(alias).where(F.col("s").isNotNull() & (F.trim("s") != ""))
    return seen.groupBy("s").agg(F.count(F.lit(1)).alias("n"), F.sum("as_name").alias("as_name"), F.sum("other").alias("other"))


def alike_tokens(tokens: DataFrame) -> DataFrame:
    """(kind, token, near, slips): tokens of a kind that are equal, or some slips apart, by a prefix-filtered q-gram join.

    The grams of a token are ordered by how rare they are; two tokens one slip apart have one of their PREFIX
    rarest grams in common, but for swaps of two letters; those, and tokens two swaps apart, have the same
    letters. Umlauts written out are no slips.
    """
    padded = F.concat(F.lit("^" * (Q - 1)), F.col("token"), F.lit("$" * (Q - 1)))
    grams = tokens.select("kind", "token", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - Q + 1), lambda i: F.substring(padded, i, F.lit(Q))))).alias("gram"))
    rarity = grams.groupBy("kind", "gram").agg(F.count(F.lit(1)).alias("df"))
    # A token has as many grams as letters, so the window's groups are short.
    order = Window.partitionBy("kind", "token").orderBy("df", "gram")
    prefix = cut(grams.join(rarity, ["kind", "gram"]).withColumn("r", F.row_number().over(order)).where(F.col("r") <= PREFIX).select("kind", "token", "gram"))
    other = prefix.select("kind", "gram", F.col("token").alias("near"))
    close = (F.col("token") < F.col("near")) & (F.abs(F.length("token") - F.length("near")) <= 1)
    # Cheap bound first: a swap of neighbours is two edits.
    few = prefix.join(other, ["kind", "gram"]).where(close & (F.levenshtein("token", "near", 2) >= 0)).select("kind", "token", "near")
    lettered = tokens.where((F.length("token") >= SWAPS_CHARS) | (F.length("token") == 2)).select("kind", "token", F.array_join(F.array_sort(F.split("token", "")), "").alias("letters"))
    swapped = lettered.join(lettered.withColumnRenamed("token", "near"), ["kind", "letters"]).where("token < near").select("kind", "token", "near")
    pairs = few.unionByName(swapped).distinct()

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["slips"] = [slips(x, y) for x, y in zip(b["token"], b["near"], strict=True)]
            b = b[b["slips"].notna()]
            yield b.assign(slips=b["slips"].astype("int32"))

    slipped = pairs.mapInPandas(verified, "kind string, token string, near string, slips int")
    both = slipped.unionByName(slipped.select("kind", F.col("near").alias("token"), F.col("token").alias("near"), "slips"))
    folded = tokens.select("kind", "token", F.regexp_replace("token", "([aou])e", "$1").alias("folded"))
    written_out = folded.join(folded.withColumnRenamed("token", "near"), ["kind", "folded"]).select("kind", "token", "near", F.lit(0).alias("slips"))
    return written_out.unionByName(both).groupBy("kind", "token", "near").agg(F.min("slips").alias("slips"))


def _word_info(seen: DataFrame) -> DataFrame:
    """(s, info): of each word of a spelling how many names of organisations hold it, and the far more frequent word it may be a slip of."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words = [[(w, plain(w.rstrip("."))) for w in words_of(s)] for s in b["s"]]
            typed = [any(p in ORG_TYPES or p in _short_types for _, p in ws) for ws in words]
            yield pd.DataFrame({"s": b["s"], "typed": typed, "w": [sorted({p for _, p in ws}) if len(ws) > 1 else [] for ws in words]})

    words = cut(seen.select("s").mapInPandas(split, "s string, typed boolean, w array<string>").where(F.size("w") > 0).select("s", "typed", F.explode("w").alias("w")))
    counts = words.where("typed").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # A word that is no organisation's may still be the slip of one that is.
    near = alike_tokens(words.select(F.lit("word").alias("kind"), F.col("w").alias("token")).distinct()).where("slips = 1 and length(token) >= 3")
    known = counts.withColumnRenamed("n", "known_n")
    target = near.join(known.where(F.col("known_n") >= MEND_LEAST).withColumnRenamed("w", "near"), "near").join(counts.withColumnRenamed("w", "token"), "token", "left")
    better = target.where(F.col("known_n") >= MEND_TIMES * F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))).groupBy(F.col("token").alias("w")).agg(F.max(F.struct(F.col("known_n").alias("n"), F.col("near").alias("w"))).alias("better"))
    each = words.join(counts, "w", "left").join(better, "w", "left").select("s", F.struct("w", F.coalesce("n", F.lit(0)).alias("n"), "better").alias("i"))
    return each.groupBy("s").agg(F.collect_list("i").alias("info"))  # as many as a name has words


def _roots(links: DataFrame) -> DataFrame:
    """(node, root) of (node, up) where every node has one `up`, itself at the top: pointers are doubled until they rest."""
    state = cut(links)
    for _ in range(30):
        hop = state.select(F.col("node").alias("up"), F.col("up").alias("top"))
        after = cut(state.join(hop, "up").select("node", F.col("top").alias("up")))
        moved = after.join(state.withColumnRenamed("up", "was"), "node").where(F.col("up") != F.col("was")).limit(1).count()
        state = after
        if not moved:
            return state.withColumnRenamed("up", "root")
    raise RuntimeError("a chain of more than 2**30 links, or a circle")


def entity_classes(card: DataFrame) -> DataFrame:
    """(s, entity): the entity of every spelling that stands for exactly one person or organisation.

    Spellings are compared exactly as written; their count follows the number of distinct names, not of
    cards. Null, blank and one-word spellings, roles, and spellings that fit several entities have no row,
    nor do names that are mostly labelled as places, tools and the like. Null aliases, kinds and structs are
    ignored; repeated cards change nothing but counts. An empty table gives an empty one.
    """
    spark = card.sparkSession
    all_seen = cut(spellings(card))
    seen = all_seen.where((F.col("other") * 2 <= F.col("as_name")) | (F.col("as_name") == 0)).select("s", "n")
    informed = seen.join(_word_info(seen), "s", "left")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for s, n, info in zip(b["s"], b["n"], b["info"], strict=True):
                known = [] if info is None else list(info)
                better = {i["w"]: i["better"]["w"] for i in known if i["better"] is not None}
                rarity = {i["w"]: i["n"] for i in known} | {i["better"]["w"]: i["better"]["n"] for i in known if i["better"] is not None}

                def mend(w: str, better=better) -> str:
                    return better.get(w, w)

                if org := parse_org(s, rarity, mend) or _mistyped_org(s, rarity, mend):
                    key, form, rest = org
                    out.append((s, n, "org", key, form, [], rest))
                elif person := parse_person(s):
                    key, form, given = person
                    out.append((s, n, "person", key, form, given, []))
            yield pd.DataFrame(out, columns=PARSED.names)

    def _mistyped_org(s: str, rarity: Mapping[str, int], mend: Callable[[str], str]) -> tuple[str, str, list[str]] | None:
        """An organisation whose word for its kind is mistyped."""
        words = words_of(s)
        if len(words) < 3 or "," in s or any(plain(w) in full_names() for w in words):
            return None
        better = [mend(plain(w)) for w in words]
        return parse_org(" ".join(v.capitalize() if plain(w) != v else w for w, v in zip(words, better, strict=True)), rarity, mend) if any(v in ORG_TYPES for v in better) else None

    parsed = cut(informed.mapInPandas(parse, PARSED))
    given_tokens = parsed.where("kind = 'person' and form = 'full'").select("kind", F.get("given", F.lit(0)).alias("token"))
    alike = cut(alike_tokens(parsed.select("kind", F.col("key").alias("token")).unionByName(given_tokens).distinct())).withColumnRenamed("token", "key")
    weight = parsed.groupBy("kind", "key").agg(F.sum("n").alias("key_n"))

    # People. Nodes are (full given name, surname); variants take the given name an attested node offers.
    people = parsed.where("kind = 'person'")
    near_keys = alike.where("kind = 'person'").select("key", "near", "slips")
    attested = people.where("form = 'full'").select(F.get("given", F.lit(0)).alias("full"), "key").distinct()
    variants = people.where("form = 'variant'").select("s", "n", "key", F.explode("given").alias("full"))
    offers = variants.join(near_keys, "key").join(attested.withColumnRenamed("key", "near"), ["full", "near"]).groupBy("s").agg(
        F.collect_set(F.when(F.col("key") == F.col("near"), F.col("full"))).alias("exact"), F.collect_set("full").alias("any")
    )
    choice = F.when(F.size("exact") == 1, F.get("exact", F.lit(0))).when((F.size("exact") == 0) & (F.size("any") == 1), F.get("any", F.lit(0)))
    chosen = people.where("form = 'variant'").join(offers, "s", "left").select("s", "n", "key", F.when(F.col("any").isNull(), F.get("given", F.lit(0))).otherwise(choice).alias("full"))
    placed = people.where("form = 'full'").select("s", "n", "key", F.get("given", F.lit(0)).alias("full")).unionByName(chosen).where(F.col("full").isNotNull())
    placed = cut(placed.withColumn("node", F.concat_ws("|", F.lit("p"), "full", "key")))
    nodes = placed.groupBy("node", "full", "key").agg(F.sum("n").alias("n"))
    given_n = nodes.groupBy("full").agg(F.sum("n").alias("given_n"))

    # Organisations. Nodes are (own name, other words); abbreviated ones are placed afterwards.
    orgs = parsed.where("kind = 'org'")
    org_keys = alike.where("kind = 'org'").select("key", "near", "slips")
    full_orgs = orgs.where("form = 'full'").withColumn("full", F.array_join("rest", " ")).withColumn("node", F.concat_ws("|", F.lit("o"), "full", "key"))
    org_nodes = full_orgs.groupBy("node", "full", "key").agg(F.sum("n").alias("n"))

    listed = lambda c: F.col(c).isin(*full_names())
    left_out = lambda c: F.array_distinct(F.concat(F.array(c), F.transform(F.sequence(F.lit(1), F.greatest(F.length(c), F.lit(1))), lambda i: F.concat(F.substring(c, F.lit(1), i - 1), F.substring(c, i + 1, F.length(c))))))

    def people_pairs() -> DataFrame:
        """(node, up, key, full, near, up_full, slips, rest_slips): nodes whose tokens are alike one by one, in either order.

        Each side brings what one of its tokens is like, so the join is on both tokens and no pair of nodes
        that share a surname alone is ever made. Two given names of the list are two.
        """
        likes = near_keys.select(F.col("key").alias("full"), F.col("near").alias("up_full"), F.col("slips").alias("rest_slips"))
        apart = (F.col("full") != F.col("up_full")) & (F.least(F.length("full"), F.length("up_full")) < SLIP_CHARS) | (F.col("rest_slips") > 0) & listed("full") & listed("up_full")
        asks = nodes.join(likes, "full").where(~apart)
        straight = nodes.select(F.col("node").alias("up"), F.col("n").alias("up_n"), F.col("full").alias("up_full"), F.col("key").alias("near"))
        turned = nodes.where(~(listed("full") & listed("key"))).select(F.col("node").alias("up"), F.col("n").alias("up_n"), F.col("key").alias("up_full"), F.col("full").alias("near"))
        offers = straight.unionByName(turned).join(near_keys, "near")
        return asks.join(offers, ["key", "up_full"])

    def org_pairs() -> DataFrame:
        """The same for organisations: own names alike, and the other words equal or one slip apart.

        Word sequences one slip apart are equal once a letter, or none, is left out of each: few rows each,
        however many organisations share a name.
        """
        other = org_nodes.select(F.col("node").alias("up"), F.col("full").alias("up_full"), F.col("key").alias("near"), F.col("n").alias("up_n"))
        beside = org_nodes.join(org_keys, "key")
        equal = beside.join(other.withColumn("full", F.col("up_full")), ["full", "near"]).withColumn("rest_slips", F.lit(0))
        maybe = beside.withColumn("part", F.explode(left_out("full"))).join(other.withColumn("part", F.explode(left_out("up_full"))), ["near", "part"]).where("full != up_full").drop("part").distinct()

        def slipped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield b[[_word_slip(x.split(" "), y.split(" ")) for x, y in zip(b["full"], b["up_full"], strict=True)]]

        return equal.unionByName(maybe.mapInPandas(slipped, maybe.schema).withColumn("rest_slips", F.lit(1)))

    def linked(pairs: DataFrame, kind: str, rest_n: DataFrame) -> DataFrame:
        """(node, up): each node to its most frequent like node if that is more frequent, verified by weighted similarity."""
        upward = pairs.where((F.col("up_n") > F.col("n")) | (F.col("up_n") == F.col("n")) & (F.col("up") > F.col("node")) | (F.col("up") == F.col("node")))
        total = weight.where(F.col("kind") == kind).agg(F.sum("key_n").alias("total"))
        scored = upward.join(weight.where(F.col("kind") == kind).select("key", "key_n"), "key").join(rest_n, "full").join(F.broadcast(total))
        # Weights are inverse frequencies: a rare surname tells more than a common given name.
        rare = lambda c: F.log(1 + F.col("total") / F.col(c))
        like = lambda n, a, b: 1 - F.col(n) / F.greatest(F.length(a), F.length(b), F.lit(1))
        score = (rare("key_n") * like("slips", "key", "near") + rare("rest_n") * like("rest_slips", "full", "up_full")) / (rare("key_n") + rare("rest_n"))
        best = scored.where(score >= SAME).groupBy("node").agg(F.max(F.struct("up_n", "up")).alias("b"))
        return best.select("node", F.col("b.up").alias("up"))

    up = linked(people_pairs(), "person", given_n.select("full", F.col("given_n").alias("rest_n"))).unionByName(
        linked(org_pairs(), "org", org_nodes.groupBy("full").agg(F.sum("n").alias("rest_n")))
    )
    roots = cut(_roots(up))
    whole = placed.select("s", "node").unionByName(full_orgs.select("s", "node")).join(roots, "node").select("s", F.col("root").alias("entity"))

    # Initials go to the one entity with that surname and letter, an exact surname before a mistyped one.
    initials = people.where("form = 'initial'").select("s", "key", F.get("given", F.lit(0)).alias("letter"))
    entities = nodes.join(roots, "node").select(F.col("key").alias("near"), F.substring("full", 1, 1).alias("letter"), F.col("root").alias("entity"))
    fit = initials.join(near_keys, "key").join(entities, ["near", "letter"]).select("s", "entity", (F.col("key") == F.col("near")).alias("exact"))
    # Abbreviated organisations go to the one entity whose words they stand for.
    shortened = orgs.where("form = 'variant'").select("s", "key", "rest")
    offered = org_nodes.join(roots, "node").select(F.col("key").alias("near"), "full", F.col("root").alias("entity"))
    tried = shortened.join(org_keys, "key").join(offered, "near").select("s", "rest", "full", "entity", (F.col("key") == F.col("near")).alias("exact"))

    def stands_for(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[[fits_abbreviation(list(r), f.split(" ")) for r, f in zip(b["rest"], b["full"], strict=True)]][["s", "entity", "exact"]]

    fit = fit.unionByName(tried.mapInPandas(stands_for, "s string, entity string, exact boolean"))
    sure = fit.groupBy("s").agg(F.collect_set(F.when(F.col("exact"), F.col("entity"))).alias("exact"), F.collect_set("entity").alias("any"))
    one = F.when(F.size("exact") == 1, F.get("exact", F.lit(0))).when((F.size("exact") == 0) & (F.size("any") == 1), F.get("any", F.lit(0)))
    decided = sure.select("s", one.alias("entity"), F.lit(True).alias("tried"))
    # With no entity to go to, equal initials of equal surnames, and equal abbreviations, are entities of their own.
    lonely = initials.select("s", F.concat_ws("|", F.lit("i"), "letter", "key").alias("own")).unionByName(shortened.select("s", F.concat_ws("|", F.lit("a"), F.array_join("rest", " "), "key").alias("own")))
    rest = lonely.join(decided, "s", "left").select("s", F.when(F.col("tried"), F.col("entity")).otherwise(F.col("own")).alias("entity")).where(F.col("entity").isNotNull())
    return whole.unionByName(rest)


def same_entity_pairs(card: DataFrame) -> DataFrame:
    """(name_a, name_b): every pair of different spellings of one person or organisation, name_a < name_b by code point."""
    classes = cut(entity_classes(card))
    a, b = classes.withColumnRenamed("s", "name_a"), classes.withColumnRenamed("s", "name_b")
    return a.join(b, "entity").where(F.col("name_a") < F.col("name_b")).select("name_a", "name_b").distinct()
