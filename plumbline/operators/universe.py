"""Placing records in families: verdicts of an alias table, groups of names, rounds of links, and a registry of ids that only grows.

Records have rid (unique), ns and km (folded key), name and mk (folded name), asserted (folded names that
the record gives its family as well) and rank (which of a family's records names it, the least first).
The alias table has ns, mk, family (an id), relation ('fold' or 'package': the key or name is the
family's; 'ineligible' and 'bundle': it is kept out; 'distinct': it must never be the family's), detail,
needle (a distinct row that holds for every name with mk in it) and named (ns is a space of names).
The registry has id, name and minted_from (both folded), and first_seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.operators.entities import connected, ids_minted
from plumbline.sources.records import written

#: How strongly a name points to an id: a reviewed row, the current name, an older or lent one.
ROW, CURRENT, OLDER = 0, 1, 2
#: Placements against the registry that each one proposes, before what still moves is held back.
SETTLE = 8
REGISTRY = "id string, name string, minted_from string, first_seen date"


@dataclass
class Rules:
    """The alias table in the forms that placing reads."""

    rows: DataFrame

    def _by(self, rows: DataFrame, keys: list[str]) -> DataFrame:
        fold = F.col("relation").isin("fold", "package")
        return rows.where(F.col("relation") != "distinct").groupBy(*keys).agg(
            F.count_distinct(F.when(fold, F.col("family"))).alias("folds"),
            F.min(F.when(fold, F.col("family"))).alias("fold"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("relation") == "ineligible", F.coalesce("detail", F.lit(""))))), "+").alias("why"),
            F.max(F.col("relation") == "ineligible").alias("out"),
            F.max(F.col("relation") == "bundle").alias("bundle"),
            F.coalesce(F.min(F.when(fold, F.col("relation") == "package")), F.lit(False)).alias("package_only"),
        )

    def verdicts(self, records: DataFrame) -> DataFrame:
        """records with verdict ('alias', 'exclude', 'unmapped', 'name'), value (the family, or why) and lends (whether a keyed record's own name points to it).

        The key's rows decide; where they say nothing, those of the name in any space of names do. Rows that
        contradict each other leave a record unmapped.
        """
        by_key = self._by(self.rows, ["ns", "mk"]).withColumnRenamed("mk", "km")
        by_name = self._by(self.rows.where("named"), ["mk"])
        # A record's own columns may be called like those of the rules.
        slim = records.select("rid", "ns", "km", "mk")
        key = slim.join(by_key, ["ns", "km"], "left")

        def verdict(alias: bool) -> Column:
            barred = F.col("out") | F.col("bundle")
            clash = barred | (F.col("folds") > 1) if alias else barred
            return F.when(F.col("folds") > 0, F.when(clash, "unmapped").otherwise("alias" if alias else "name")).when(barred, "exclude").otherwise("name")

        value = F.when(F.col("out"), F.concat(F.lit("ineligible:"), F.col("why"))).when(F.col("bundle"), "bundle")
        keyed = key.select("rid", "mk", verdict(True).alias("v"), F.when((F.col("folds") == 1) & ~F.col("out") & ~F.col("bundle"), F.col("fold")).otherwise(value).alias("x"), (~F.coalesce("package_only", F.lit(False))).alias("lends"))
        named = keyed.join(by_name, "mk", "left").select("rid", "lends", F.when(F.col("v") == "name", verdict(False)).otherwise(F.col("v")).alias("v"), F.when(F.col("v") == "name", value).otherwise(F.col("x")).alias("x"))
        named = named.withColumn("x", F.when(F.col("v").isin("alias", "exclude"), F.col("x")))
        return records.join(named.select("rid", F.col("v").alias("verdict"), F.col("x").alias("value"), "lends"), "rid")

    def free(self, pairs: DataFrame) -> DataFrame:
        """pairs (ns and km, or none; mk; id) that no distinct row forbids, by key or by name."""
        d = self.rows.where((F.col("relation") == "distinct") & F.col("family").isNotNull())
        space = F.when(F.col("named"), F.lit("name")).otherwise(F.col("ns"))
        exact = d.where(~F.coalesce("needle", F.lit(False))).select(space.alias("_ns"), F.col("mk").alias("_mk"), F.col("family").alias("_id")).distinct()
        out = pairs.join(exact.where("_ns = 'name'"), (F.col("mk") == F.col("_mk")) & (F.col("id") == F.col("_id")), "left_anti")
        needles = d.where(F.coalesce("needle", F.lit(False)) & (F.col("mk") != "")).select(F.col("family").alias("_id"), F.col("mk").alias("_needle")).distinct()
        inside = F.col("mk").contains(F.col("_needle"))
        if "km" in pairs.columns:
            own_space = F.when(F.col("key_named"), F.lit("name")).otherwise(F.col("ns"))
            out = out.join(exact, (own_space == F.col("_ns")) & (F.col("km") == F.col("_mk")) & (F.col("id") == F.col("_id")), "left_anti")
            inside = inside | F.col("km").contains(F.col("_needle"))
        return out.join(needles, (F.col("id") == F.col("_id")) & inside, "left_anti")

    def split(self) -> DataFrame:
        return self.rows.where("relation = 'distinct' and family is not null").select(F.col("family").alias("id")).distinct()


def picked(pairs: DataFrame, by: list[str], rules: Rules, registry: DataFrame) -> DataFrame:
    """By keys the one id that their pairs (id, rank) point to (pick), or null for a tie.

    The best rank wins. Of several ids with one current name those that a distinct row split something off
    keep it, of these the one first seen.
    """
    split = rules.split().join(registry.select("id", "first_seen"), "id", "left").select("id", F.coalesce("first_seen", F.lit("9999-12-31").cast("date")).alias("_seen"), F.lit(True).alias("_split"))
    best = pairs.groupBy(*by, "id").agg(F.min("rank").alias("rank")).withColumn("_best", F.min("rank").over(Window.partitionBy(*by))).where("rank = _best")
    best = best.join(split, "id", "left")
    seen = best.groupBy(*by).agg(F.min("rank").alias("_rank"), F.count(F.lit(1)).alias("_n"), F.min("id").alias("_id"), F.min(F.when(F.col("_split"), F.struct("_seen", "id"))).alias("_first"), F.collect_list(F.when(F.col("_split"), F.col("_seen"))).alias("_days"))
    alone = F.size(F.filter("_days", lambda x: x == F.col("_first._seen"))) == 1
    return seen.select(*by, F.when(F.col("_n") == 1, F.col("_id")).when((F.col("_rank") == CURRENT) & alone, F.col("_first.id")).alias("pick"))


def placed(records: DataFrame, rules: Rules, registry: DataFrame) -> DataFrame:
    """(rid, state, value): 'id' and a family, 'new' and a group of names, 'excluded' and why, or 'unmapped'.

    A key's row places its record at once. Other records of connected names go together: to the one id that any of
    their names points to, or to a new group. Where that is several ids, or one that is forbidden, each
    record is placed by its own name, else by the one id that all names asserted for its name give; what
    was placed so lends its names to the rest, round by round, until nothing moves.
    """
    spaces = rules.rows.where("named").select("ns").distinct().withColumn("key_named", F.lit(True))
    judged = rules.verdicts(records.join(spaces, "ns", "left").withColumn("key_named", F.coalesce("key_named", F.lit(False))))
    pair = ["rid", "ns", "km", "mk", "key_named"]
    alias = judged.where("verdict = 'alias'").withColumn("id", F.col("value"))
    kept = rules.free(alias.select(*pair, "id")).select("rid").withColumn("_free", F.lit(True))
    judged = judged.join(kept, "rid", "left")
    state = F.when(F.col("verdict") == "alias", F.when(F.col("_free"), "id").otherwise("unmapped")).when(F.col("verdict") == "exclude", "excluded").when((F.col("verdict") == "unmapped") | (F.col("mk") == ""), "unmapped")
    judged = written(judged.withColumn("state", state).select(*pair, "asserted", "lends", "state", F.when(state.isin("id", "excluded"), F.col("value")).alias("value")), "judged")
    settled = judged.where("state is not null").select("rid", "state", "value")
    named = judged.where("state is null")

    own = named.select(F.col("mk").alias("a"), F.explode(F.array_union(F.array("mk"), "asserted")).alias("b")).where("b <> ''").distinct()
    roots = written(connected(own, "a", "b").select(F.col("node").alias("name"), F.col("label").alias("root")), "roots")
    lent = judged.where("state = 'id'").select(F.explode(F.array_union(F.when(F.col("lends"), F.array("mk")).otherwise(F.array().cast("array<string>")), "asserted")).alias("mk"), F.col("value").alias("id"), F.lit(OLDER).alias("rank"))
    links = rules.rows.where("named and relation in ('fold', 'package')").select("mk", F.col("family").alias("id"), F.lit(ROW).alias("rank"))
    links = links.unionByName(registry.select(F.col("name").alias("mk"), "id", F.lit(CURRENT).alias("rank"))).unionByName(registry.select(F.col("minted_from").alias("mk"), "id", F.lit(OLDER).alias("rank"))).unionByName(lent)
    links = rules.free(links.where("mk <> ''"))
    links = written(links.groupBy("mk", "id").agg(F.min("rank").alias("rank")), "links")

    ids = roots.join(links.select(F.col("mk").alias("name"), "id"), "name").groupBy("root").agg(F.count_distinct("id").alias("n"), F.min("id").alias("only"))
    grouped = named.join(roots.withColumnRenamed("name", "mk"), "mk").join(ids, "root", "left").select(*pair, "asserted", "root", F.coalesce("n", F.lit(0)).alias("n"), "only")
    grouped = written(grouped, "grouped")
    single = rules.free(grouped.where("n = 1").withColumn("id", F.col("only"))).select("rid", F.lit("id").alias("state"), F.col("id").alias("value"))
    new = grouped.where("n = 0").select("rid", F.lit("new").alias("state"), F.col("root").alias("value"))
    settled = written(settled.unionByName(single).unionByName(new), "settled")
    said = written(named.select("mk", F.explode("asserted").alias("other")).where("other <> ''").distinct(), "asserted")

    pending = grouped.where("n > 0").join(settled.select("rid"), "rid", "left_anti")
    found = [settled]
    while True:
        pending = written(pending, "pending")
        open_ = written(rules.free(pending.select(*pair).join(links, "mk")).select("rid", "id", "rank"), "open")
        by_own = picked(open_, ["rid"], rules, registry)
        rest = pending.select(*pair).join(open_.select("rid").distinct(), "rid", "left_anti")
        other = rules.free(rest.join(said, "mk").join(links.withColumnRenamed("mk", "other"), "other"))
        # Each name that is asserted gives one id or a tie, which is a vote of its own.
        votes = picked(other.select("rid", "other", "id", "rank"), ["rid", "other"], rules, registry)
        by_other = votes.groupBy("rid").agg(F.count_distinct("pick").alias("_n"), F.max(F.col("pick").isNull()).alias("_tie"), F.min("pick").alias("pick")).where("_n = 1 and not _tie").select("rid", "pick")
        done = by_own.where("pick is not null").select("rid", "pick").unionByName(by_other)
        done = written(done.select("rid", F.lit("id").alias("state"), F.col("pick").alias("value")), "done")
        if not done.take(1):
            break
        found.append(done)
        names = pending.join(done, "rid").select(F.explode(F.array_union(F.array("mk"), "asserted")).alias("mk"), F.col("value").alias("id"), F.lit(OLDER).alias("rank"))
        links = written(links.unionByName(rules.free(names.where("mk <> ''").distinct())).groupBy("mk", "id").agg(F.min("rank").alias("rank")), "links")
        pending = pending.join(done.select("rid"), "rid", "left_anti")
    left = pending.join(open_.select("rid", F.lit(True).alias("_open")).distinct(), "rid", "left")
    apart = (F.col("n") == 1) & F.col("_open").isNull()
    found.append(left.select("rid", F.when(apart, "new").otherwise("unmapped").alias("state"), F.when(apart, F.concat("mk", F.lit("\u0000apart"))).alias("value")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return written(out, "placed")


def minted(records: DataFrame, where: DataFrame, rules: Rules, registry: DataFrame) -> tuple[DataFrame, DataFrame]:
    """where with an id for every new group (rid, state, value), and the names of the new ids (id, name folded).

    A group's best record names it; ids are its slug, numbered where that is taken. A record that may not have the
    id its group got is minted again, with the others of its name.
    """
    out = where.where("state <> 'new'")
    new = where.where("state = 'new'").select("rid", F.col("value").alias("grp"))
    names = None
    while new.take(1):
        best = new.join(records, "rid").groupBy("grp").agg(F.min_by(F.struct("name", "mk"), F.struct("rank", "ns", "km", "name")).alias("b")).select("grp", F.concat_ws("\u0000", "b.mk", "b.name", "grp").alias("order"), "b.name", "b.mk")
        slug = F.regexp_replace(F.regexp_replace(F.lower("name"), "[^a-z0-9]+", "-"), "^-|-$", "")
        ids = written(ids_minted(best, "order", slug, taken=registry.select("id")), "minted")
        mine = new.join(ids.select("grp", "id"), "grp").join(records.select("rid", "ns", "km", "mk"), "rid")
        spaces = rules.rows.where("named").select("ns").distinct().withColumn("key_named", F.lit(True))
        mine = mine.join(spaces, "ns", "left").withColumn("key_named", F.coalesce("key_named", F.lit(False)))
        kept = written(rules.free(mine).select("rid", "id"), "kept")
        out = out.unionByName(kept.select("rid", F.lit("id").alias("state"), F.col("id").alias("value")))
        used = ids.join(kept.select("id").distinct(), "id", "left_semi").select("id", F.col("mk").alias("name"))
        names = used if names is None else names.unionByName(used)
        # A name whose records all refuse its id has spent it.
        registry = registry.unionByName(ids.select("id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("minted_from"), F.lit(None).cast("date").alias("first_seen")))
        new = written(mine.join(kept.select("rid"), "rid", "left_anti").select("rid", F.col("mk").alias("grp")), "again")
    if names is None:
        names = registry.select("id", "name").limit(0)
    return written(out, "placements"), written(names, "new-ids")


def next_registry(registry: DataFrame, records: DataFrame, where: DataFrame, names: DataFrame, day: Column) -> DataFrame:
    """The registry with new ids and current names; no id is ever lost, and what an id was minted from stays."""
    best = where.where("state = 'id'").join(records, "rid").groupBy(F.col("value").alias("id")).agg(F.min_by("mk", F.struct("rank", "ns", "km", "name")).alias("_now"))
    out = registry.join(names.withColumnRenamed("name", "_from"), "id", "full_outer").join(best, "id", "full_outer")
    return out.select("id", F.coalesce("_now", "name").alias("name"), F.coalesce("minted_from", "_from", "_now").alias("minted_from"), F.coalesce("first_seen", F.when(F.col("_now").isNotNull(), day)).alias("first_seen"))


def _same(a: DataFrame, b: DataFrame) -> bool:
    return not a.exceptAll(b).take(1) and not b.exceptAll(a).take(1)


def settled_universe(records: DataFrame, rows: DataFrame, registry: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """Placements (rid, state, value) and the registry after them, at rest: placing again against the new registry changes nothing.

    Records are placed against the registry that the last placement proposes, SETTLE times at most; the keys
    of what still moves then are held back as unmapped, and all starts again. A null or empty folded name is
    unmapped unless its key has a row; an empty table places nothing and keeps the registry.
    """
    rules, today = Rules(rows), F.lit(day).cast("date")
    records = written(records.select("rid", "ns", "km", "name", F.coalesce("mk", F.lit("")).alias("mk"), F.coalesce("asserted", F.array().cast("array<string>")).alias("asserted"), "rank"), "records")
    held = written(records.select("ns", "km").limit(0), "held")

    def build(known: DataFrame) -> tuple[DataFrame, DataFrame]:
        moving = records.join(held, ["ns", "km"], "left_anti")
        where, names = minted(moving, placed(moving, rules, known), rules, known)
        stay = records.join(held, ["ns", "km"], "left_semi").select("rid", F.lit("unmapped").alias("state"), F.lit(None).cast("string").alias("value"))
        return written(where.unionByName(stay), "where"), written(next_registry(known, records, where, names, today), "registry")

    while True:
        where, known = build(registry)
        moved = None
        for _ in range(SETTLE):
            again, after = build(known)
            if _same(where, again) and _same(known, after):
                return where, known
            moved = where.exceptAll(again).select("rid").unionByName(again.exceptAll(where).select("rid")).distinct()
            where, known = again, after
        keys = records.join(moved, "rid", "left_semi").select("ns", "km").distinct()
        if not keys.take(1):
            return where, known  # only names move: records rest
        held = written(held.unionByName(keys).distinct(), "held")
