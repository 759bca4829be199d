"""MinHash near-duplicates: universal hash minima, banding, verification, large-star and small-star.

Texts of equal shingle sets form one class, whose least document stands for it. Bands of minima put
class representatives into buckets. In each bucket every member is first compared with the least
one alone, which joins a group of any size by as many comparisons as members. Where members of a
bucket are then still in different components, those outside its main component are looked at with
all the others, so no link between components is lost. Signatures and upper bounds of the intersection
sort out hopeless pairs within the join; what is left are members that are all but surely alike, and
yet in different components after every bucket's star, so no group of copies is expanded into pairs.
Full shingle sets decide. Hot bands, centres and classes are dealt out in parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import body, dealt, done, numbered, written
from plumbline.llm.grams import mixed, shingle_prints, words_of
from plumbline.llm.repeats import slices

#: Bands, and minima in each. A pair of similarity 0.85 shares no band once in 10^7 times, one of 0.8 once in 6*10^4.
BANDS, ROWS = 28, 5
#: Rows of links for which a written table of the components has a part of its own.
PART_ROWS = 10_000
#: Bits of the sketch, and how many may differ in a pair that is looked at. At similarity 0.8 a bit differs with
#: probability 0.1: over 32 of 128 do so 3 times in 10^9, far less often than a pair shares no band.
BITS, DIFFER = 128, 32
SEED = 7


def hashes() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)


def minima(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minima of the set under multiply-add hashes modulo 2^32."""
    x = (prints >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(out, (x[k : k + 1024, None] * a + b).min(axis=0), out=out)
    return out


def signatures(words: int):
    """Rows k, n, c1, c2, bands, s1, s2 of texts."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = hashes()
        turn = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407], dtype=np.uint64)
        band_no = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)
        for own, data, starts, ends in slices(batches):
            prints, of = shingle_prints(words_of(data, starts, ends), len(own), words)
            cut = np.searchsorted(of, np.arange(len(own) + 1))
            n, least = np.zeros(len(own), dtype=np.int64), np.zeros((len(own), BANDS * ROWS), dtype=np.uint32)
            c1, c2 = np.zeros(len(own), dtype=np.uint64), np.zeros(len(own), dtype=np.uint64)
            for t in range(len(own)):
                one = np.unique(prints[cut[t] : cut[t + 1]])
                n[t] = len(one)
                if len(one):
                    least[t] = minima(one, a, b)
                    c1[t], c2[t] = one.sum(dtype=np.uint64), mixed(one * turn[1]).sum(dtype=np.uint64)
            bands = mixed((least.reshape(len(own), BANDS, ROWS).astype(np.uint64) * turn).sum(axis=2, dtype=np.uint64) + band_no)
            bits = np.packbits((least[:, :BITS] >> np.uint32(9)) & np.uint32(1), axis=1).view("<i8")
            yield pd.DataFrame({"k": own["k"], "n": n, "c1": c1.view(np.int64), "c2": c2.view(np.int64), "bands": [*bands.view(np.int64)], "s1": bits[:, 0], "s2": bits[:, 1]})

    return rows


def bitmap(prints: np.ndarray) -> list[int]:
    """The set's elements in 256 bits, as four numbers."""
    out = np.zeros(256, dtype=np.uint8)
    out[(prints >> np.uint64(20)).astype(np.int64) & 255] = 1
    return np.packbits(out).view("<i8").tolist()


#: What a member has against its centre: sizes, intersection, and bitmaps of what it adds and lacks.
AGAINST = ["nu", "nv", "both", *[f"{x}{k}" for x in "ar" for k in range(4)]]


def overlaps(words: int, share: int):
    """Of rows u, v, tu, tv: whether 100 * intersection >= share * union of their shingle sets, and AGAINST."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = {}
            for side in "uv":
                texts |= dict(zip(batch[side], batch["t" + side], strict=True))
            own = pd.DataFrame({"k": list(texts), "t": list(texts.values())})
            sets: dict[int, np.ndarray] = {}
            for part, data, starts, ends in slices([own]):
                prints, of = shingle_prints(words_of(data, starts, ends), len(part), words)
                cut = np.searchsorted(of, np.arange(len(part) + 1))
                sets |= {k: np.unique(prints[cut[t] : cut[t + 1]]) for t, k in enumerate(part["k"])}
            out = []
            for u, v in zip(batch["u"], batch["v"], strict=True):
                x, y = sets[u], sets[v]
                both = np.intersect1d(x, y, assume_unique=True)
                ok = len(both) > 0 and 100 * len(both) >= share * (len(x) + len(y) - len(both))
                adds, lacks = np.setdiff1d(x, both, assume_unique=True), np.setdiff1d(y, both, assume_unique=True)
                out.append((u, v, ok, len(x), len(y), len(both), *bitmap(adds), *bitmap(lacks)))
            yield pd.DataFrame(out, columns=["u", "v", "ok", *AGAINST])

    return rows


def compared(pairs: DataFrame, texts: DataFrame, words: int, share: int) -> DataFrame:
    """Pairs (u, v) with their verdict (ok) on full shingle sets, and AGAINST."""
    pairs = written(pairs.select("u", "v"), "pairs")
    centres = written(pairs.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "pair-centres")
    tu, tv = (texts.select(F.col("k").alias(x), F.col("t").alias("t" + x)) for x in "uv")
    # The same way at every size: texts are shuffled to the pairs, however few these are.
    rows = dealt(pairs.hint("merge").join(tu, "u"), tv.join(centres.hint("merge"), "v"), ["v"], sizes=centres).select("u", "v", "tu", "tv")
    out = written(rows.mapInPandas(overlaps(words, share), "u long, v long, ok boolean, " + ", ".join(f"{c} long" for c in AGAINST)), "compared")
    done(pairs, centres)
    return out


def at_most(x: str, y: str) -> Column:
    """Upper bound of the intersection of two members of one bucket, from what each has against its centre.

    What of the centre both have is its size less what either lacks; what neither has from the
    centre must be in both of what they add. An element whose bit the other's bitmap lacks is in
    one of them only.
    """

    def common(kind: str) -> Column:
        def own(p: str, q: str) -> Column:
            bits = [F.bit_count(F.col(f"{p}_{kind}{k}").bitwiseAND(F.bitwise_not(F.col(f"{q}_{kind}{k}")))) for k in range(4)]
            size = F.col(f"{p}_nu") - F.col(f"{p}_both") if kind == "a" else F.col(f"{p}_nv") - F.col(f"{p}_both")
            return size - (bits[0] + bits[1] + bits[2] + bits[3])

        return F.least(own(x, y), own(y, x))

    lacks = F.col(f"{x}_nv") - F.col(f"{x}_both") + F.col(f"{y}_nv") - F.col(f"{y}_both") - common("r")
    return F.col(f"{x}_nv") - lacks + common("a")


def components(links: DataFrame) -> DataFrame:
    """(k, comp) for each node of the links (u, v): the least node it is connected with.

    Large-star and small-star by turns until nothing changes; each is a least neighbour by node and
    a join with it, in which nodes of many neighbours are dealt out in parts. Tables are written in as
    many parts as their links ask for, as few links in many files cost more than they are worth.
    """
    edges = written(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state, count = None, F.count(F.lit(1)).alias("n")
    parts = 1 + edges.count() // PART_ROWS
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), count).select("u", F.least("u", "m").alias("m"), "n").coalesce(parts), "least")
        large = dealt(both, least, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large.coalesce(parts), "large-star")
        done(edges, least)
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), count).coalesce(parts), "least")
        small = dealt(large, least, ["u"]).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u <> v")
        own = least.select("u", F.col("m").alias("v"))
        edges = written(small.unionByName(own).distinct().coalesce(parts), "small-star")
        done(large, least)
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")).first()
        if (now["n"], now["x"]) == state:
            return edges.select(F.col("u").alias("k"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("k"), F.col("v").alias("comp")).distinct())
        state = (now["n"], now["x"])


def near_duplicates(docs: DataFrame, words: int = 5, share: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with k (a unique key), n_shingles and first (k of the least row linked with it).

    Links: 100 * intersection >= share * union of the sets of `words`-word shingles; words are runs of
    bytes other than ASCII white space, A-Z lower-cased. Texts with fewer words are one shingle; null,
    empty and blank texts are linked with nothing. Rows of one id are documents of their own, in the
    order of their texts. An empty table gives an empty result.
    """
    base = numbered(docs.select(F.col(id_col).alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), body(text_col).cast("binary").alias("t")), "id", "t")
    texts = base.select("k", "t")
    signed = written(texts.mapInPandas(signatures(words), "k long, n long, c1 long, c2 long, bands array<long>, s1 long, s2 long"), "signatures")
    some = signed.where("n > 0")
    classes = written(some.groupBy("c1", "c2", "n").agg(F.min("k").alias("class"), F.count(F.lit(1)).alias("members")), "classes")
    stand = some.join(classes.select(F.col("class").alias("k")), "k", "left_semi")

    buckets = written(stand.select(F.explode("bands").alias("band"), "k", "s1", "s2"), "buckets")
    centres = written(buckets.groupBy("band").agg(F.min("k").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1"), "centres")
    met = written(dealt(buckets, centres, ["band"]), "met")
    done(buckets)
    stars = met.where("k <> centre").select(F.col("k").alias("u"), F.col("centre").alias("v")).distinct()
    against = compared(stars, texts, words, share)
    comps = written(components(against.where("ok").select("u", "v")), "components")

    # Buckets whose members are still apart: those outside the main component against all others.
    placed = written(met.join(comps, "k", "left").withColumn("comp", F.coalesce("comp", "k")), "placed")
    sizes = placed.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"))
    mains = sizes.groupBy("band").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count(F.lit(1)).alias("comps"), F.sum("n").alias("n")).where("comps > 1").select("band", "main", "n")
    mains = written(mains, "mains")
    apart = dealt(placed.where("k <> centre"), mains, ["band"]).join(against.select(F.col("u").alias("k"), F.col("v").alias("centre"), *AGAINST), ["k", "centre"])
    apart = written(apart, "apart")
    side = lambda x: apart.select("band", F.col("k").alias(x), F.col("comp").alias(f"{x}_comp"), F.col("main").alias(f"{x}_main"), F.col("s1").alias(f"{x}_s1"), F.col("s2").alias(f"{x}_s2"), *[F.col(c).alias(f"{x}_{c}") for c in AGAINST])
    differ = F.bit_count(F.col("u_s1").bitwiseXOR(F.col("v_s1"))) + F.bit_count(F.col("u_s2").bitwiseXOR(F.col("v_s2")))
    bound = at_most("u", "v")
    may = (differ <= DIFFER) & (100 * bound >= share * (F.col("u_nu") + F.col("v_nu") - bound))
    other = (F.col("u_comp") != F.col("v_comp")) & ((F.col("v_comp") == F.col("v_main")) | (F.col("u") > F.col("v")))
    # A hot bucket's members go to one of its parts each, and meet there all that are outside its main component.
    outside = side("u").where("u_comp <> u_main")
    rest = dealt(side("v"), outside.join(mains.select("band", "n"), "band"), ["band"], sizes=mains).where(other & may)
    rest = rest.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    more = compared(rest, texts, words, share).where("ok").select("u", "v")
    if more.take(1):
        # Components of components: what was found already comes in as its stars.
        comps = written(components(more.unionByName(comps.where("k <> comp").select(F.col("k").alias("u"), F.col("comp").alias("v")))), "components")

    placed = classes.join(comps.select(F.col("k").alias("class"), "comp"), "class", "left").select("c1", "c2", F.col("n").alias("n_shingles"), F.coalesce("comp", "class").alias("first"), F.col("members").alias("n"))
    placed = written(placed, "placed-classes")
    member = dealt(some.select("k", "c1", "c2", F.col("n").alias("n_shingles")), placed, ["c1", "c2", "n_shingles"]).select("k", "n_shingles", "first")
    member = member.unionByName(signed.where("n = 0").select("k", F.col("n").alias("n_shingles"), F.col("k").alias("first")))
    return base.select("k", "id", "row").join(member, "k")


def op6_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    from plumbline.llm.common import table

    out = near_duplicates(table(spark, sf_dir, "documents"), words=3, share=85)
    return component_ids(out)


def component_ids(found: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of what near_duplicates returns."""
    rows = found.select("k", F.col("id").alias("doc_id"), "n_shingles", "first")
    names = rows.where("k = first").select(F.col("k").alias("first"), F.col("doc_id").alias("component_id"))
    return rows.join(names, "first").select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))
