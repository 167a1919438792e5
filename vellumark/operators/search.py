"""Full-text search: postings, boolean queries, BM25 rank and snippets."""

from __future__ import annotations

import re
import unicodedata
import uuid
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut, worker_udf
from .spans import located_quotes

# Fixed values of the rank function.
K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
# Latin letters with marks, and the letters they are found by.
MARKED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďēėęěğīįłńňōőřśşšťūůűųźżž"
UNMARKED = "".join(unicodedata.normalize("NFD", c)[0] if c != "ł" else "ł" for c in MARKED)
SPLIT = r"[^\p{L}\p{N}\p{M}]+"


class QueryError(ValueError):
    """A search that can't be read."""


def terms(text: Column) -> Column:
    """Search terms of a text in order: runs of letters and digits, lower case, without marks."""
    plain = F.translate(F.regexp_replace(F.lower(text), r"\p{M}", ""), MARKED, UNMARKED)
    return F.filter(F.split(plain, SPLIT), lambda w: w != "")


def plain_term(word: str) -> str:
    return "".join(c for c in word.lower().translate(str.maketrans(MARKED, UNMARKED)) if not unicodedata.combining(c))


def postings(blocks: DataFrame) -> DataFrame:
    """(term, doc_id, seq, n, positions): an inverted index of blocks, each key once; n is the block's number of words."""
    words = blocks.select("doc_id", "seq", terms(F.coalesce("text", F.lit(""))).alias("w"))
    t = words.select("doc_id", "seq", F.size("w").alias("n"), F.posexplode("w").alias("position", "term"))
    return t.groupBy("term", "doc_id", "seq", "n").agg(F.array_sort(F.collect_list("position")).alias("positions"))


def sizes(blocks: DataFrame) -> DataFrame:
    """One row (total, words): how many blocks there are, and their words."""
    return blocks.agg(F.count(F.lit(1)).alias("total"), F.coalesce(F.sum(F.size(terms(F.coalesce("text", F.lit(""))))), F.lit(0)).cast("bigint").alias("words"))


@dataclass(frozen=True)
class Index:
    """What a search reads: postings, and the sizes of all that is indexed (rows that are to be added up)."""

    postings: DataFrame
    sizes: DataFrame


def index_of(blocks: DataFrame) -> Index:
    return Index(postings(blocks), sizes(blocks))


class StoredIndex:
    """An index kept in a folder: postings sorted by term, so that a search reads the row groups of its words alone.

    Each addition is written beside what is there: `keys` last, so that a block counts as indexed once all of
    it is. A key that is indexed already keeps its text.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _part(self, name: str) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}") if path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path) else None

    def add(self, blocks: DataFrame) -> int:
        """Index the blocks whose key isn't indexed yet; returns how many there were."""
        known = self._part("keys")
        fresh = blocks.select("doc_id", "seq", "text")
        fresh = cut(fresh if known is None else fresh.join(known, ["doc_id", "seq"], "left_anti"))
        if not (n := fresh.count()):
            return 0
        ranges = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        batch = F.lit(uuid.uuid4().hex)
        postings(fresh).repartitionByRange(ranges, "term", "doc_id").sortWithinPartitions("term", "doc_id", "seq").withColumn("batch", batch).write.mode("append").parquet(f"{self.folder}/postings")
        sizes(fresh).withColumn("batch", batch).write.mode("append").parquet(f"{self.folder}/sizes")
        fresh.select("doc_id", "seq").withColumn("batch", batch).write.mode("append").parquet(f"{self.folder}/keys")
        return n

    def index(self) -> Index | None:
        """The index of additions that were finished; None before the first."""
        if (keys := self._part("keys")) is None:
            return None
        done = F.broadcast(keys.select("batch").distinct())  # one row for each addition
        return Index(self._part("postings").join(done, "batch", "left_semi"), self._part("sizes").join(done, "batch", "left_semi"))

    def counts(self) -> DataFrame:
        """One row (chunks, postings): how many keys and postings there are, null where nothing was ever indexed."""
        if (index := self.index()) is None:
            return self.spark.createDataFrame([(None, None)], "chunks bigint, postings bigint")
        return index.sizes.agg(F.sum("total").alias("chunks")).join(index.postings.agg(F.count(F.lit(1)).alias("postings")))


@dataclass(frozen=True)
class Phrase:
    """Words in a row, the last of which may be the beginning of one."""

    words: tuple[str, ...]
    prefix: bool = False


@dataclass(frozen=True)
class Near:
    """Phrases that have at most `reach` words between the first and the last of them."""

    phrases: tuple[Phrase, ...]
    reach: int


@dataclass(frozen=True)
class Both:
    left: object
    right: object


@dataclass(frozen=True)
class Either:
    left: object
    right: object


@dataclass(frozen=True)
class Without:
    left: object
    right: object


TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|(NEAR)\s*\(|([()])|(,)|(AND|OR|NOT)(?![^\s()])|([^\s()",*]+))(\*)?')


def parse(query: str):
    """The tree of a query: words and "phrases" side by side mean AND, then NOT, AND and OR, each less binding; word*, NEAR(a b, n)."""
    tokens, at = [], 0
    query = query.strip()
    if not query:
        raise QueryError("an empty query")
    while at < len(query):
        m = TOKEN.match(query, at)
        if not m or m.end() == at:
            raise QueryError(f"can't read {query[at:]!r}")
        if m[6] and not re.fullmatch(r"[\w\u0080-\U0010ffff]+", m[6]):
            raise QueryError(f"{m[6]!r} is no word")
        tokens.append(m)
        at = m.end()
    place = 0

    def peek():
        return tokens[place] if place < len(tokens) else None

    def take():
        nonlocal place
        place += 1
        return tokens[place - 1]

    def word(m) -> Phrase:
        found = tuple(plain_term(w) for w in re.findall(r"[^\W_]+", m[1].replace('""', '"') if m[1] is not None else m[6]))
        if not found:
            raise QueryError("a phrase without words")
        return Phrase(found, bool(m[7]))

    def primary():
        m = peek()
        if m is None:
            raise QueryError("a query that breaks off")
        if m[3] == "(":
            take()
            inner = either()
            if not peek() or peek()[3] != ")":
                raise QueryError("a bracket that isn't closed")
            take()
            return inner
        if m[2]:
            take()
            phrases, n = [], 10
            while peek() and peek()[3] != ")":
                t = take()
                if t[4]:
                    n = int(take()[6])
                else:
                    phrases.append(word(t))
            if not peek():
                raise QueryError("NEAR that isn't closed")
            take()
            if not phrases:
                raise QueryError("NEAR of nothing")
            return Near(tuple(phrases), n) if len(phrases) > 1 else phrases[0]
        if m[1] is not None or m[6]:
            return word(take())
        raise QueryError(f"{m[0].strip()!r} where a word was expected")

    def adjacent():
        node = primary()
        while (m := peek()) and (m[1] is not None or m[6] or m[2] or m[3] == "("):
            node = Both(node, primary())
        return node

    def without():
        node = adjacent()
        while (m := peek()) and m[5] == "NOT":
            take()
            node = Without(node, adjacent())
        return node

    def both():
        node = without()
        while (m := peek()) and m[5] == "AND":
            take()
            node = Both(node, without())
        return node

    def either():
        node = both()
        while (m := peek()) and m[5] == "OR":
            take()
            node = Either(node, both())
        return node

    tree = either()
    if peek():
        raise QueryError(f"{peek()[0].strip()!r} where the query should end")
    return tree


def leaves(tree) -> list[Phrase | Near]:
    return [tree] if isinstance(tree, Phrase | Near) else leaves(tree.left) + leaves(tree.right)


def phrases_of(tree) -> list[Phrase]:
    """The phrases of a query in order, those inside a Near too; each counts for the rank as often as it stands there."""
    return [p for leaf in leaves(tree) for p in (leaf.phrases if isinstance(leaf, Near) else (leaf,))]


def near_hits(places: list[list[int]], lengths: list[int], reach: int) -> list[list[int]]:
    """Of the sorted places of some phrases those that take part in a passage of all of them.

    A passage has each phrase begin at most `reach` words and its own length before the last. Passages are
    found by moving on the phrase that begins first, so only those reached that way count.
    """
    at, kept = [0] * len(places), [[] for _ in places]
    if not all(places):
        return kept
    while True:
        last = max(p[i] for p, i in zip(places, at, strict=True))
        moved = True
        while moved:
            moved = False
            for k, p in enumerate(places):
                while at[k] < len(p) and p[at[k]] < last - lengths[k] - reach:
                    at[k] += 1
                if at[k] == len(p):
                    return kept
                if p[at[k]] > last:
                    last, moved = p[at[k]], True
        for k, p in enumerate(places):
            if not kept[k] or kept[k][-1] != p[at[k]]:
                kept[k].append(p[at[k]])
        first = min(range(len(places)), key=lambda k: places[k][at[k]])
        at[first] += 1
        if at[first] == len(places[first]):
            return kept


def _near_counts(near: Near, columns: list[Column]) -> Column:
    """How often each phrase takes part; zeros where the phrases don't come together."""
    lengths, reach = [len(p.words) for p in near.phrases], near.reach

    @worker_udf(T.ArrayType(T.IntegerType()))
    def count(rows: pd.Series) -> pd.Series:
        return rows.map(lambda places: [len(k) for k in near_hits([list(p) for p in places], lengths, reach)])

    return count(F.array(*columns))


def ranked(blocks: DataFrame | None, query: str, index: Index | None = None) -> DataFrame:
    """(doc_id, seq, rank) of all blocks that match, rank by BM25: the more negative, the better.

    Only postings of the query's words are read, and only they are shuffled, once: whether a block matches,
    how often each phrase stands in it and how many blocks have it all follow from a block's postings
    together. A query that can't be read raises QueryError.
    """
    tree = parse(query)
    index = index or index_of(blocks)
    wanted = list(dict.fromkeys((w, p.prefix and i == len(p.words) - 1) for p in phrases_of(tree) for i, w in enumerate(p.words)))
    fits = lambda w, prefix: F.col("term").startswith(w) if prefix else F.col("term") == w
    # Spelled out for the scan: equal words as a list, prefixes one by one.
    equal = [w for w, prefix in wanted if not prefix]
    some = reduce(lambda a, b: a | b, [*([F.col("term").isin(equal)] if equal else []), *[fits(w, True) for w, prefix in wanted if prefix]])
    at = {x: f"__p{i}" for i, x in enumerate(wanted)}
    rows = index.postings.where(some).groupBy("doc_id", "seq", "n").agg(*[F.array_sort(F.flatten(F.collect_list(F.when(fits(*x), F.col("positions"))))).alias(c) for x, c in at.items()])

    def starts(p: Phrase) -> Column:
        places = [F.col(at[w, p.prefix and i == len(p.words) - 1]) for i, w in enumerate(p.words)]
        return places[0] if len(places) == 1 else F.filter(places[0], lambda x: reduce(lambda a, b: a & b, [F.array_contains(c, (x + i).cast("int")) for i, c in enumerate(places[1:], 1)]))

    phrases = list(dict.fromkeys(phrases_of(tree)))
    named = {p: f"__s{i}" for i, p in enumerate(phrases)}
    rows = rows.select("doc_id", "seq", "n", *[starts(p).alias(c) for p, c in named.items()])
    nears = {leaf: f"__n{i}" for i, leaf in enumerate(dict.fromkeys(leaf for leaf in leaves(tree) if isinstance(leaf, Near)))}
    rows = rows.withColumns({c: _near_counts(leaf, [F.col(named[p]) for p in leaf.phrases]) for leaf, c in nears.items()})

    def matches(t) -> Column:
        if isinstance(t, Phrase):
            return F.size(named[t]) > 0
        if isinstance(t, Near):
            return F.col(nears[t])[0] > 0
        left, right = matches(t.left), matches(t.right)
        return left & right if isinstance(t, Both) else left | right if isinstance(t, Either) else left & ~right

    # Every phrase that stands in the query counts, inside a Near by its part in passages, with its own number of blocks.
    counts = [c for leaf in leaves(tree) for c in ([(p, F.col(nears[leaf])[k]) for k, p in enumerate(leaf.phrases)] if isinstance(leaf, Near) else [(leaf, F.size(named[leaf]))])]
    blocks_with = rows.agg(*[F.count_if(F.size(c) > 0).alias(f"{c}_df") for c in named.values()])
    stats = index.sizes.agg(F.sum("total").alias("total"), (F.sum("words") / F.sum("total")).alias("mean"))
    hits = rows.where(matches(tree)).join(F.broadcast(stats)).join(F.broadcast(blocks_with))  # one row each

    def part(p: Phrase, tf: Column) -> Column:
        df = F.col(f"{named[p]}_df")
        idf = F.greatest(F.log((F.col("total") - df + 0.5) / (df + 0.5)), F.lit(LEAST_IDF))
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("n") / F.col("mean")))

    return hits.select("doc_id", "seq", (-reduce(lambda a, b: a + b, [part(p, tf) for p, tf in counts])).alias("rank"))


def search(blocks: DataFrame | None, query: str, limit: int = 5, index: Index | None = None) -> tuple[DataFrame, str]:
    """The best blocks (doc_id, seq, rank) and how the query was read: 'query', or as one 'phrase' if it can't be read."""
    if not query.strip():
        raise QueryError("an empty query")
    query, read_as = read_query(query)
    return ranked(blocks, query, index).orderBy("rank", "doc_id", "seq").limit(limit), read_as


def read_query(query: str) -> tuple[str, str]:
    """A query that can be read: itself, or as one phrase."""
    try:
        parse(query)
        return query, "query"
    except QueryError:
        phrase = '"' + query.replace('"', '""') + '"'
        parse(phrase)
        return phrase, "phrase"


def snippet(text: Column, words: list[str], size: int = 12, most: int = 240) -> Column:
    """A passage of some words around the first hit, hits in brackets, on one line and cut to `most` characters."""
    wanted = frozenset(plain_term(w) for w in words)

    @worker_udf(T.StringType())
    def cut_out(texts: pd.Series) -> pd.Series:
        def one(t: str | None) -> str | None:
            if t is None:
                return None
            tokens = list(re.finditer(r"[^\W_]+", t))
            hits = [i for i, m in enumerate(tokens) if plain_term(m[0]) in wanted]
            if not tokens:
                return ""
            first = max(0, min((hits[0] if hits else 0) - size // 3, len(tokens) - size))
            last = min(len(tokens), first + size) - 1
            out, at = "" if first == 0 else " ... ", tokens[first].start()
            for i in range(first, last + 1):
                m = tokens[i]
                out += t[at : m.start()] + (f"[{m[0]}]" if i in hits else m[0])
                at = m.end()
            out += "" if last == len(tokens) - 1 else " ... "
            return re.sub(r"[\x00-\x08\x0b-\x1f\x7f]", "", re.sub(r"[\t\r\n]", " ", out))[:most]

        return texts.map(one)

    return cut_out(text)


def report(blocks: DataFrame, docs: DataFrame, cards: DataFrame, query: str, limit: int = 5, index: Index | None = None) -> DataFrame:
    """The best blocks, each with its document, the card last read and a snippet.

    Quotes of the card come with the place where they were found in the block's text; those that stand nowhere
    in it are withheld and only counted. A block without document has path and project '?' and year 0, one
    without card null topics, no quotes and null withheld; without text nothing can be located.
    """
    from .catalog import last_per_key, project_of

    hits, read_as = search(blocks, query, limit, index)
    words = [w for p in phrases_of(parse(read_query(query)[0])) for w in p.words]
    keys = F.broadcast(hits)  # `limit` rows
    latest = last_per_key(keys.select("doc_id", "seq").join(cards.select("doc_id", "seq", "read_at", "topics", "quotes"), ["doc_id", "seq"]), ["doc_id", "seq"], ["read_at"]).drop("read_at")
    known = keys.select("doc_id").distinct().join(docs.select("doc_id", "path", "year"), "doc_id")
    texts = keys.select("doc_id", "seq").join(blocks.select("doc_id", "seq", "text"), ["doc_id", "seq"])
    joined = hits.join(known, "doc_id", "left").join(latest, ["doc_id", "seq"], "left").join(texts, ["doc_id", "seq"], "left")
    said = F.transform(F.coalesce("quotes", F.expr("array()")), lambda q: q["text"])
    found = joined.withColumn("__found", located_quotes(F.col("text"), said))
    return found.select(
        "doc_id", "seq", "rank", F.lit(read_as).alias("matched_as"), F.coalesce(project_of(F.col("path")), F.lit("?")).alias("project"), F.coalesce("path", F.lit("?")).alias("path"), F.coalesce("year", F.lit(0)).alias("year"),
        "topics", F.col("__found").alias("quotes"), F.when(F.col("quotes").isNotNull(), F.size("quotes") - F.size("__found")).alias("withheld"), snippet(F.col("text"), words).alias("snippet"),
    ).orderBy("rank", "doc_id", "seq")
