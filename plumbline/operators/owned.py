"""Matching a reader's own list of names with the catalog: chains of shorter names, first hits, outcomes, collisions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.sources.records import written

#: Words that name a style, words of degree before one, tokens of patched builds and of variable builds.
STYLES = ("regular", "italic", "oblique", "bold", "light", "medium", "thin", "black", "heavy", "book", "roman")
DEGREES = ("semi", "extra", "ultra", "demi")
PATCHED, VARIABLE = ("nf", "nfm", "nfp", "cn", "nl", "pl"), ("variable", "var", "vf")
#: Letters of codes that make a hit owned, and why others make it near; both in order of preference.
HOW = {"f": "family", "r": "rename", "p": "postscript", "b": "build", "n": "patched"}
WHY = {"ambiguous": "ambiguous", "s": "sibling", "l": "related", "u": "bundle", "patched": "patched"}
#: Codes that a patched build shares with its font.
SAME_FONT = ("f", "r", "p", "b")
#: Parts into which each key of the catalog is dealt, as one name may be a third of all.
PARTS = 16


def chain(name: Column, fold: Callable[[Column], Column]) -> Column:
    """A name and what is left of it as its last unit goes, one at a time: array of (key, patched), the longest first.

    A unit is a word of style with its words of degree, or a token of a patched or a variable build; "Nerd
    Font" with its variants is one token. At least one word stays, and names without a key have no chain.
    """
    text = F.regexp_replace(F.trim(F.regexp_replace(name, r"\s+", " ")), "(?i) nerd font( mono| propo)?$", " NF")
    words = F.split(text, " ")
    backward = F.when(F.size(words) > 1, F.sequence(F.size(words) - 1, F.lit(1))).otherwise(F.array().cast("array<int>"))
    start = F.struct(F.array(F.struct(F.size(words).alias("n"), F.lit(False).alias("patched"))).alias("cuts"), F.lit(False).alias("styled"), F.lit(True).alias("open"))

    def step(a: Column, i: Column) -> Column:
        w = F.lower(F.get(words, i))
        patched = F.element_at(a["cuts"], -1)["patched"]
        more = lambda p: F.concat(a["cuts"], F.array(F.struct(i.alias("n"), p.alias("patched"))))
        # Words of degree join the unit behind them.
        wider = F.concat(F.slice(a["cuts"], 1, F.size(a["cuts"]) - 1), F.array(F.struct(i.alias("n"), patched.alias("patched"))))
        state = lambda cuts, styled, open_: F.struct(cuts.alias("cuts"), F.lit(styled).alias("styled"), F.lit(open_).alias("open"))
        return (
            F.when(~a["open"], F.struct(a["cuts"].alias("cuts"), F.lit(False).alias("styled"), F.lit(False).alias("open")))
            .when(w.isin(*STYLES), state(more(patched), True, True))
            .when(a["styled"] & w.isin(*DEGREES), state(wider, True, True))
            .when(w.isin(*PATCHED), state(more(F.lit(True)), False, True))
            .when(w.isin(*VARIABLE), state(more(patched), False, True))
            .otherwise(state(a["cuts"], False, False))
        )

    cuts = F.aggregate(backward, start, step, lambda a: a["cuts"])
    named = F.transform(cuts, lambda c: F.struct(fold(F.array_join(F.slice(words, 1, c["n"]), " ")).alias("key"), c["patched"].alias("patched")))
    return F.filter(named, lambda c: c["key"] != "")


def _dealt(rows: DataFrame, table: DataFrame, by: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """rows joined with a table of the catalog's size, whose keys are dealt out in PARTS parts."""
    parts = table.withColumn("_part", F.explode(F.array(*[F.lit(k) for k in range(PARTS)])))
    return rows.withColumn("_part", F.pmod(F.hash(spread), F.lit(PARTS))).join(parts, [*by, "_part"], how).drop("_part")


def _entries(tries: DataFrame, codes: DataFrame, entry: str, chains: DataFrame | None) -> DataFrame:
    """(entry, h) of every entry, h being its first hit or null; see first_hits().

    What a name comes to is found once for each distinct name and written, so that only the small table
    of names meets the catalog, and Spark knows its size when the tries meet it.
    """
    on = ["name"] if chains is not None else ["name", "chain"]
    names = chains if chains is not None else tries.select(*on).distinct()
    # The outer form, as the other one's filter on chains would be moved to all tries.
    forms = names.select(*on, F.posexplode_outer("chain").alias("turn", "c")).select(*on, "turn", "c.key", "c.patched")
    known = _dealt(forms, codes.select("key").distinct(), ["key"], F.col("name"))
    firsts = written(known.groupBy(*on).agg(F.min(F.struct("turn", "key", "patched")).alias("f")), "hits")
    met = _dealt(tries.select(entry, "place", "trusted", *on), firsts, on, F.col(entry), "left")
    hit = F.struct("place", "f.turn", "f.key", "f.patched", "trusted", F.col("name").alias("shown"))
    return met.groupBy(entry).agg(F.min(F.when(F.col("f").isNotNull(), hit)).alias("h"))


def first_hits(tries: DataFrame, codes: DataFrame, entry: str = "entry", chains: DataFrame | None = None) -> DataFrame:
    """(entry, key, patched, trusted, shown): the first known key of each entry, by the order of its names, then of a name's chain (of equal places the least key).

    tries: entry, place, name, trusted and chain, or, where `chains` (name, chain) of all distinct names
    are given, without chain; codes: key and more.
    """
    return _entries(tries, codes, entry, chains).where("h is not null").select(entry, "h.key", "h.patched", "h.trusted", "h.shown")


#: What decides, beside an entry's first known key, what the entry means.
STATE = ["key", "patched", "trusted"]


def _meanings(codes: DataFrame, doubts: DataFrame, patched: bool) -> DataFrame:
    """(key, patched, trusted, means): outcome, family and why of every family that a key names, by the state of its hit; written.

    A table of the catalog's size: codes of a key that say the same are one, however many parts have them.
    """
    flags = lambda name: F.explode(F.array(F.lit(False), F.lit(True))).alias(name)
    amb = doubts.groupBy("key").agg(F.collect_set("family").alias("maybe"))  # a name's few weights
    rows = codes.groupBy("key").agg(F.collect_set(F.struct("family", "letter", "known", "reason")).alias("codes")).join(amb, "key", "left")
    rows = rows.select("*", flags("patched")).select("*", flags("trusted"))
    rows = rows.withColumn("maybe", F.coalesce("maybe", F.array().cast(rows.schema["maybe"].dataType))).withColumn("doubt", (F.size("maybe") > 0) & ~F.col("trusted"))
    letter = F.when(F.col("patched") & F.col("c.letter").isin(*SAME_FONT), "n").otherwise(F.col("c.letter"))
    each = rows.select("*", F.explode("codes").alias("c")).withColumn("letter", letter)
    names = F.create_map(*[F.lit(x) for kv in (HOW | WHY).items() for x in kv])
    near_patched = (F.col("letter") == "n") & F.lit(not patched)
    owns = F.col("letter").isin(*HOW)
    is_ = lambda outcome, why: F.struct(F.lit(outcome).alias("o"), why.alias("w"))
    own_name = names[F.col("letter")]
    what = F.when(near_patched, is_("near", F.lit("patched"))).when(owns & F.col("doubt"), is_("near", F.lit("ambiguous"))).when(owns, is_("owned", own_name)).otherwise(is_("near", own_name))
    of_family = each.where("c.family is not null").select(*STATE, F.col("c.family").alias("family"), what.alias("x")).select(*STATE, "x.o", "family", "x.w")
    listed = F.exists("codes", lambda c: c["family"].isNotNull())
    some_known = F.exists("codes", lambda c: c["family"].isNull() & F.coalesce(c["known"], F.lit(False)))
    maybe = rows.where(F.col("doubt") | (some_known & ~listed)).select(*STATE, F.lit("near").alias("o"), F.explode("maybe").alias("family"), F.lit("ambiguous").alias("w"))
    both = of_family.unionByName(maybe)
    order = F.array_position(F.array(*[F.lit(x) for x in [*HOW.values(), *WHY.values()]]), F.col("w")) + F.when(F.col("o") == "owned", 0).otherwise(100)
    best = both.groupBy(*STATE, "family").agg(F.min_by(F.struct("o", "w"), order).alias("b")).select(*STATE, F.col("b.o").alias("outcome"), "family", F.col("b.w").alias("why"))
    why = F.array_join(F.array_sort(F.array_distinct(F.transform(F.filter("codes", lambda c: c["family"].isNull() & c["reason"].isNotNull()), lambda c: c["reason"]))), "+")
    rest = rows.select(*STATE, F.when(some_known, "known").when(why != "", "ineligible").otherwise("unknown").alias("outcome"), F.lit(None).cast(codes.schema["family"].dataType).alias("family"), F.when(~some_known & (why != ""), why).alias("why"))
    rest = rest.join(best.select(*STATE), STATE, "left_anti")
    return written(best.unionByName(rest).groupBy(*STATE).agg(F.collect_list(F.struct("outcome", "family", "why")).alias("means")), "meanings")


def _meant(hits: DataFrame, means: DataFrame, spread: Column, how: str = "inner") -> DataFrame:
    """hits with what they mean; a hit without a word on its trust is trusted."""
    state = [F.coalesce("patched", F.lit(False)).alias("patched"), F.coalesce("trusted", F.lit(True)).alias("trusted")]
    return _dealt(hits.select(*[c for c in hits.columns if c not in STATE[1:]], *state), means, STATE, spread, how)


def outcomes(tries: DataFrame, codes: DataFrame, doubts: DataFrame, patched: bool = True, entry: str = "entry", chains: DataFrame | None = None) -> DataFrame:
    """(entry, outcome, family, why, shown): what each entry means to each family that its first known key names.

    codes: key, family (null: none), letter, known (a family that isn't listed), reason (why a name is
    ineligible). doubts: key and the families that its name may be a weight of. A trusted name owns what
    its key's codes say; where there is a doubt, an untrusted one is near, and so are the doubted families.
    Without `patched`, patched builds are near. Entries without family rows are 'known', 'ineligible' or 'unknown'.
    tries and chains: see first_hits().
    """
    means = _meanings(codes, doubts, patched)
    hits = _entries(tries, codes, entry, chains).select(entry, "h.key", "h.patched", "h.trusted", "h.shown")
    none = F.array(F.struct(F.lit("unknown").alias("outcome"), F.lit(None).cast(codes.schema["family"].dataType).alias("family"), F.lit(None).cast("string").alias("why")))
    found = _meant(hits, means, F.col(entry), "left")
    return found.select(entry, "shown", F.explode(F.coalesce("means", none)).alias("m")).select(entry, "m.outcome", "m.family", "m.why", "shown")


def families(tries: DataFrame, codes: DataFrame, doubts: DataFrame, patched: bool = True, entry: str = "entry", chains: DataFrame | None = None) -> DataFrame:
    """by_family() of outcomes(), without a row for each entry and family: of the hits in one state the first entry speaks for all."""
    means = _meanings(codes, doubts, patched)
    hits = first_hits(tries, codes, entry, chains).groupBy(*STATE).agg(F.min(F.struct(entry, "shown")).alias("e")).select(*STATE, f"e.{entry}", "e.shown")
    found = _meant(hits, means, F.col(entry)).select(entry, "shown", F.explode("means").alias("m"))
    return by_family(found.select(entry, "m.outcome", "m.family", "m.why", "shown"), entry)


def by_family(found: DataFrame, entry: str = "entry") -> DataFrame:
    """(family, outcome, why, shown): each family's best outcome over all entries; owned beats near, then the kind, then the first entry."""
    order = F.array_position(F.array(*[F.lit(x) for x in [*HOW.values(), *WHY.values()]]), F.col("why")) + F.when(F.col("outcome") == "owned", 0).otherwise(100)
    some = found.where("family is not null")
    return some.groupBy("family").agg(F.min_by(F.struct("outcome", "why", "shown"), F.struct(order, entry)).alias("b")).select("family", "b.*")


def collisions(names: DataFrame, catalog: DataFrame) -> DataFrame:
    """(name, key, reached, family, listed): names whose first shorter form that is known belongs to families which their own key lacks.

    names: family, name, chain. A name's forms meet all names' keys by equality, so families are never
    compared with each other; keys that many forms reach are dealt out.
    """
    own = names.select("name", F.get("chain", F.lit(0))["key"].alias("key"), "family").where("key is not null")
    holders = own.select("key", "family").distinct()
    per_key = holders.groupBy("key").agg(F.collect_set("family").alias("families"))  # families that share one name
    forms = names.select("name", "chain").distinct().select("name", F.get("chain", F.lit(0))["key"].alias("key"), F.posexplode("chain").alias("turn", "c")).where("turn > 0").select("name", "key", "turn", F.col("c.key").alias("reached"))
    met = _dealt(forms, per_key.select(F.col("key").alias("reached"), F.col("families").alias("new")), ["reached"], F.col("name"))
    first = met.groupBy("name", "key").agg(F.min_by(F.struct("reached", "new"), "turn").alias("f")).select("name", "key", "f.*")
    out = first.join(per_key, "key").select("name", "key", "reached", F.explode(F.array_except("new", "families")).alias("family"))
    return out.join(catalog.select("family", F.lit(True).alias("listed")).distinct(), "family", "left").select("name", "key", "reached", "family", F.coalesce("listed", F.lit(False)).alias("listed"))


def meetings(names: DataFrame, pairs: DataFrame, owned: DataFrame) -> DataFrame:
    """(family, other, name, key): names of a family that reach a key which counts as owned for another one that it is distinct from, from either side of a pair."""
    both = pairs.select("family", "other").unionByName(pairs.select(F.col("other").alias("family"), F.col("family").alias("other"))).distinct()
    forms = names.join(both.select("family").distinct(), "family", "left_semi").select("family", "name", F.explode("chain").alias("c")).select("family", "name", F.col("c.key").alias("key"))
    return forms.join(both, "family").join(owned.select("key", F.col("family").alias("other")).distinct(), ["key", "other"], "left_semi").select("family", "other", "name", "key").distinct()
