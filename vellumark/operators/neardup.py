"""Near duplicates among documents by shingles: of words, and in the estimate of characters where words are few."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import shingle_hashes
from ..session import cut, on_workers, spread, worker_udf

#: Least similarity of near duplicates where a caller asks for none.
LEAST = 0.8
# Shingle length in words, and the least number of words of a text that has them; length of
# character shingles, and the least length of a text that has those; the least number of shingles that are signed.
SHINGLE, LEAST_WORDS = 5, 34
CHARS, LEAST_CHARS = 8, 200
LEAST_SHINGLES = 30
# The sample of a very long text: so many slices of so many characters where it has more than so many.
SLICES, SLICE_CHARS, SLICED_CHARS = 20, 5_000, 100_000
# The prime and the seed of the hash family, slots of a signature, least estimate and most earlier texts of a flag.
PRIME, SEED, SLOTS = (1 << 61) - 1, 20_260_731, 128
FLAG_LEAST, FLAG_MOST = 0.6, 5
BANDS = 32
# Buckets in which hashes are counted, a byte each in every process, and how many of them travel together.
BUCKETS, SLICE = 1 << 22, 1 << 16
ALONE = 8  # the weight of a bucket that counts one


def sorted_side(df: DataFrame) -> DataFrame:
    """df as a side of a join by sorting. Catalyst takes an array for one element and exploded rows for one a row, so it would broadcast what is many times its estimate."""
    return df.hint("merge")


def text_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(rep, sha, shingles): one row per distinct text that has shingles, named by the smallest of its keys."""
    d = spread(docs.where(F.col(text).isNotNull()).select(key, text)).select(F.col(key).alias("k"), F.sha2(text, 256).alias("sha"), F.col(text).alias("t"))
    one = d.groupBy("sha").agg(F.min("k").alias("rep"), F.min("t").alias("t"))
    return one.select("rep", "sha", shingle_hashes(F.col("t"), SHINGLE).alias("shingles")).where(F.col("shingles").isNotNull())


def weights(hashes: DataFrame) -> np.ndarray:
    """How frequent the hashes of each of BUCKETS buckets are, as one byte on a scale of logarithms, over a column of arrays of 64-bit hashes."""
    slices = BUCKETS // SLICE

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            total += np.bincount(b.column(0).flatten().to_numpy(zero_copy_only=False) & (BUCKETS - 1), minlength=BUCKETS)
        if total.any():
            rows = np.minimum(total, 65_535).astype(np.uint16).reshape(slices, SLICE)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(slices, dtype=np.int32)), pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary())], names=["slice", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE, np.int64)
        for r in rows["counts"]:
            total += np.frombuffer(zlib.decompress(r), np.uint16)
        return pd.DataFrame({"slice": rows["slice"][:1], "weight": [np.minimum(8 * np.log2(total + 1), 255).astype(np.uint8).tobytes()]})

    found = on_workers(hashes).mapInArrow(count, "slice int, counts binary").groupBy("slice").applyInPandas(add, "slice int, weight binary").collect()  # BUCKETS bytes
    made = np.zeros((slices, SLICE), np.uint8)
    for r in found:
        made[r["slice"]] = np.frombuffer(r["weight"], np.uint8)
    return made.reshape(-1)


def prefixes(classes: DataFrame, least: float) -> DataFrame:
    """(rep, n, s): of each text's n shingles the rarest, as many as it may lack and still be similar enough, and one more.

    Those that are alone in their bucket take up places, but no other text has them.
    """
    shared = classes.sparkSession.sparkContext.broadcast(weights(classes.select("shingles")))
    schema = T.StructType([T.StructField("rep", classes.schema["rep"].dataType), T.StructField("n", T.IntegerType()), T.StructField("s", T.LongType())])

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat, text = b.column(1).flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n)
            weight = shared.value[flat & (BUCKETS - 1)]
            order = np.lexsort((flat, weight, text))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(n) - n, n)
            first = order[(place < np.repeat(prefix_size(n, least), n)) & (weight[order] > ALONE)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text[first])), pa.array(n[text[first]].astype(np.int32)), pa.array(flat[first])], names=["rep", "n", "s"])

    return on_workers(classes.select("rep", "shingles")).mapInArrow(rarest, schema)


def prefix_size(n: Column | np.ndarray, least: float) -> Column | np.ndarray:
    """Of n shingles, as many as may be lacking and one more."""
    needed = n * least - 1e-9
    return n - (F.ceil(needed) if isinstance(n, Column) else np.ceil(needed).astype(np.int64)) + 1


def among(rep: Column, kept: np.ndarray) -> Column:
    """Whether the bucket of a key's hash is among those kept; true of every key kept and of few others."""
    shared = SparkSession.getActiveSession().sparkContext.broadcast(kept)

    @worker_udf(T.BooleanType())
    def there(hashes: pd.Series) -> pd.Series:
        return pd.Series(shared.value[hashes.to_numpy(np.int64) & (BUCKETS - 1)] > 0)

    return there(F.xxhash64(rep))


def similar_texts(classes: DataFrame, least: float = LEAST) -> DataFrame:
    """(a, b, jaccard): every pair of distinct texts whose shingles are at least that similar, a < b.

    Exact, by prefix filter: of each text only its rarest shingles are joined, as many as a text may lack
    and still be similar enough, and one more. How rare they are is estimated, by buckets of their hashes; any
    order that is one for all texts loses none. A pair is compared in full where what its prefixes share and
    all that is left of either text could be enough.
    """
    classes = cut(classes.select("rep", "shingles"))
    prefix = prefixes(classes, least).repartition("s")
    other = prefix.select(F.col("rep").alias("b"), F.col("n").alias("m"), "s")
    n, m = F.col("n"), F.col("m")
    sized = (F.col("rep") < F.col("b")) & (F.least(n, m) >= F.lit(least) * F.greatest(n, m) - 1e-9)
    met = prefix.join(sorted_side(other), "s").where(sized).groupBy(F.col("rep").alias("a"), "b", "n", "m").agg(F.count(F.lit(1)).alias("met"))
    # What two texts share comes after the prefix that ends first or is in both prefixes.
    most = F.col("met") + F.greatest(n - prefix_size(n, least), m - prefix_size(m, least))
    pairs = cut(met.where(most >= F.lit(least / (1 + least)) * (n + m) - 1e-6).select("a", "b"))
    kept = weights(pairs.select(F.array(F.xxhash64("a"), F.xxhash64("b"))))
    compared = classes.where(among(F.col("rep"), kept))
    left, right = compared.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), compared.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    scored = pairs.join(sorted_side(left), "a").join(sorted_side(right), "b").select("a", "b", (both / (F.size("sa") + F.size("sb") - both)).alias("jaccard"))
    return scored.where(F.col("jaccard") >= least)


def hash_family(slots: int = SLOTS, seed: int = SEED) -> list[tuple[int, int]]:
    """(a, b) of each slot's hash (a*x + b) mod PRIME, drawn in turn from a seeded generator."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(slots)]


def _times(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """a*x mod 2**61-1 of numbers below it, in 64-bit words: the upper factor is cut into pieces of 30 bits."""
    mask, p = np.uint64((1 << 61) - 1), np.uint64(PRIME)

    def reduce(v: np.ndarray) -> np.ndarray:
        v = (v & mask) + (v >> np.uint64(61))
        return np.where(v >= p, v - p, v)

    def shifted(v: np.ndarray, bits: int) -> np.ndarray:
        """v * 2**bits mod p: a rotation of 61 bits."""
        return reduce(((v << np.uint64(bits)) & mask) + (v >> np.uint64(61 - bits)))

    low, high = x & np.uint64((1 << 31) - 1), x >> np.uint64(31)
    a_low, a_high = a & np.uint64((1 << 31) - 1), a >> np.uint64(31)
    middle = reduce(reduce(a_low * high) + reduce(a_high * low))
    top = reduce(a_high * high)  # times 2**62, which is 2 mod p
    return reduce(reduce(reduce(a_low * low) + shifted(middle, 31)) + reduce(top * np.uint64(2)))


def signature(values: list[int] | np.ndarray, family: list[tuple[int, int]] | None = None) -> np.ndarray:
    """The least hash of each slot over a set of 64-bit values."""
    a, b = (np.array(c, np.uint64)[:, None] for c in zip(*(family or hash_family()), strict=True))
    x = np.asarray(values, np.uint64)[None, :] % np.uint64(PRIME)
    s = _times(a, x) + b
    return np.where(s >= np.uint64(PRIME), s - np.uint64(PRIME), s).min(axis=1)


WORDS = regex.compile(r"[\p{L}\p{N}_]+")


def base_hash(shingle: str) -> int:
    return int.from_bytes(hashlib.blake2b(shingle.encode("utf-8"), digest_size=8).digest(), "big")


def sampled(text: str) -> str:
    """A text, or of one above SLICED_CHARS characters SLICES slices at even distances."""
    n = len(text)
    return text if n <= SLICED_CHARS else "".join(text[i * n // SLICES : i * n // SLICES + SLICE_CHARS] for i in range(SLICES))


def runs(text: str) -> set[str]:
    """A text's shingles: runs of five words; with fewer than 34 words runs of eight characters if it has 200 or more, else none."""
    low = text.lower()
    w = WORDS.findall(low)
    if len(w) >= LEAST_WORDS:
        return {" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)}
    c = re.sub(r"\s+", " ", low)
    return {c[i : i + CHARS] for i in range(len(c) - CHARS + 1)} if len(c) >= LEAST_CHARS else set()


def minhash(text: Column, whole: bool = True) -> Column:
    """128 slots of a text's distinct shingles; null where there are fewer than 30. `whole` off signs a sample of very long texts."""

    @worker_udf(T.ArrayType(T.LongType()))
    def signed(texts: pd.Series) -> pd.Series:
        family = hash_family()

        def one(t: str | None) -> np.ndarray | None:
            found = runs((t if whole else sampled(t)) if t else "")
            return signature([base_hash(x) for x in found], family).astype(np.int64) if len(found) >= LEAST_SHINGLES else None

        return texts.map(one)

    return signed(text)


def estimate(a: Column, b: Column) -> Column:
    """Share of equal slots."""
    return F.size(F.filter(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z: z["x"] == z["y"])) / F.lit(float(SLOTS))


def signed_texts(docs: DataFrame, order: list[str], whole: bool = True) -> DataFrame:
    """(doc_id, place, sig): each distinct text that can be signed, under its earliest document in `order`."""
    texts = spread(docs.where(F.col("text").isNotNull()).select("doc_id", "text", *[o for o in order if o != "doc_id"]))
    keyed = texts.select(F.sha2("text", 256).alias("sha"), F.struct(*order, "doc_id").alias("place"), minhash(F.col("text"), whole).alias("sig"))
    reps = keyed.groupBy("sha").agg(F.min("place").alias("place"), F.first("sig").alias("sig"))
    return reps.where(F.col("sig").isNotNull()).select(F.col("place.doc_id").alias("doc_id"), "place", "sig")


def flagged(docs: DataFrame, order: list[str], least: float = FLAG_LEAST, most: int = FLAG_MOST, whole: bool = True) -> DataFrame:
    """(doc_id, other, jaccard): for each distinct text the most similar earlier ones by estimate, five at most.

    Texts stand under their earliest document in `order`; copies are in exact_duplicates, not here.
    """
    signed = cut(signed_texts(docs, order, whole))
    return earlier_like(signed, signed, least, most)


def earlier_like(asking: DataFrame, signed: DataFrame, least: float = FLAG_LEAST, most: int = FLAG_MOST) -> DataFrame:
    """(doc_id, other, jaccard) of each text that asks: the most similar earlier ones among those signed, of equals the larger key.

    Candidates share one of 32 bands of four slots: of pairs at 0.6 one in a hundred is missed, at 0.8 one in
    ten million. Only keys travel with the bands; signatures meet once for each pair.
    """
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.slice("sig", i * (SLOTS // BANDS) + 1, SLOTS // BANDS)))
    banded = asking.select("doc_id", "place", F.explode(bands).alias("h"))
    earlier = signed.select(F.explode(bands).alias("h"), F.col("doc_id").alias("other"), F.col("place").alias("other_place"))
    pairs = banded.join(earlier, "h").where(F.col("other_place") < F.col("place")).select("doc_id", "other").distinct()
    sides = pairs.join(asking.select("doc_id", F.col("sig").alias("x")), "doc_id").join(signed.select(F.col("doc_id").alias("other"), F.col("sig").alias("y")), "other")
    scored = sides.select("doc_id", "other", estimate(F.col("x"), F.col("y")).alias("j")).where(F.col("j") >= least)
    # The limit is applied before the exchange, so a text that is like a million others brings `most` of each task.
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("j"), F.desc("other")))
    return scored.withColumn("r", place).where(F.col("r") <= most).select("doc_id", "other", F.round("j", 3).alias("jaccard"))


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node that each node of some pair is connected with, by min-label rounds with shortcuts."""
    edges = cut(pairs.select(F.col(a).alias("u"), F.col(b).alias("v")).unionByName(pairs.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct())
    labels = cut(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "node"))
    for _ in range(60):
        around = edges.join(sorted_side(labels.withColumnRenamed("node", "v")), "v").groupBy("u").agg(F.min("root").alias("seen"))
        lower = labels.join(sorted_side(around.withColumnRenamed("u", "node")), "node").select("node", F.least("root", "seen").alias("root"))
        shortcut = lower.select(F.col("node").alias("root"), F.col("root").alias("top"))
        after = cut(lower.join(sorted_side(shortcut), "root", "left").select("node", F.least("root", F.coalesce("top", "root")).alias("root")))
        changed = after.join(sorted_side(labels.withColumnRenamed("root", "was")), "node").where(F.col("root") != F.col("was")).limit(1).count()
        labels = after
        if not changed:
            return labels
    raise RuntimeError("components didn't settle in 60 rounds")


def duplicate_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, class_id, links): for every document with a text the class of near duplicates it is in.

    class_id is the smallest doc_id of the class, the document's own if it is alone; links counts the other
    distinct texts that are at least so similar to its own. Null texts have no row.
    """
    keyed = cut(docs.where(F.col("text").isNotNull()).select("doc_id", F.sha2("text", 256).alias("sha")))
    reps = keyed.groupBy("sha").agg(F.min("doc_id").alias("rep"))
    pairs = cut(similar_texts(text_classes(docs), least))
    roots = components(pairs)
    ends = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep")))
    links = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    named = reps.join(sorted_side(roots.withColumnRenamed("node", "rep")), "rep", "left").join(sorted_side(links), "rep", "left")
    return keyed.join(sorted_side(named), "sha").select("doc_id", F.coalesce("root", "rep").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"))
