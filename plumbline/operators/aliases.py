"""Names to families: resolving by levels, competing proposals, forbidden pairs, relations, a check's scope."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolved_names(names: DataFrame, families: DataFrame) -> DataFrame:
    """names (ns, name, match_key) with the family they name, else null.

    families has a row per key: family, ns, key, key_match, named_match (the match key of its display
    name). The first level that knows a name decides: its exact key (unique there), its match key in the
    namespace, its match key among display names. A level that knows several families gives null.
    """
    exact = families.groupBy("ns", F.col("key").alias("name")).agg(F.max("family").alias("_exact"))
    only = lambda name: F.when(F.count_distinct("family") == 1, F.max("family")).alias(name)
    known = F.lit(True)
    inside = families.groupBy("ns", F.col("key_match").alias("match_key")).agg(only("_in"), F.max(known).alias("_known"))
    shown = families.groupBy(F.col("named_match").alias("match_key")).agg(only("_shown"))
    out = names.join(exact, ["ns", "name"], "left").join(inside, ["ns", "match_key"], "left").join(shown, "match_key", "left")
    family = F.when(F.col("_exact").isNotNull(), F.col("_exact")).when(F.col("_known"), F.col("_in")).otherwise(F.col("_shown"))
    return out.select(*names.columns, family.alias("family"))


def settled(proposals: DataFrame, keys: list[str], order: str) -> DataFrame:
    """proposals (keys, family, status 'accepted' or 'queued', order) with the status that one family per key leaves.

    Proposals of different families for a key all wait ('queued', reason 'competing'). Of those that agree, the
    first accepted one stays and all others are 'known'; without an accepted one they stay as they are.
    """
    by = proposals.groupBy(*keys).agg(F.count_distinct("family").alias("_n"), F.min(F.when(F.col("status") == "accepted", F.col(order))).alias("_first"))
    compete = F.col("_n") > 1
    status = F.when(compete, "queued").when(F.col("_first").isNull() | (F.col("_first") == F.col(order)), F.col("status")).otherwise("known")
    return proposals.join(by, keys).select(*[c for c in proposals.columns if c != "status"], status.alias("status"), F.when(compete, "competing").otherwise("").alias("reason"))


def unblocked(proposals: DataFrame, blocks: DataFrame, keys: list[str]) -> DataFrame:
    """proposals whose (keys, family) no block forbids; a block has keys, family, needle.

    A block without a needle forbids its key alone; one with a needle forbids its family to all keys whose
    match key holds the needle, which are met by family and never by all keys.
    """
    left = proposals.join(blocks.where("needle is null").select(*keys, "family"), [*keys, "family"], "left_anti")
    near = blocks.where("needle is not null").select(F.col("family").alias("_family"), "needle").distinct()
    return left.join(near, (F.col("family") == F.col("_family")) & F.col("match_key").contains(F.col("needle")), "left_anti")


def both_ways(edges: DataFrame, a: str, b: str) -> DataFrame:
    """By family every other one it is related with, from either end of an edge; ends that are one or unknown are left out."""
    some = edges.where(F.col(a) != F.col(b))
    pairs = some.select(F.col(a).alias("family"), F.col(b).alias("other")).unionByName(some.select(F.col(b).alias("family"), F.col(a).alias("other")))
    return pairs.groupBy("family").agg(F.sort_array(F.collect_set("other")).alias("others"))


def check_scope(ranks: DataFrame, members: DataFrame, overall: str, overall_max: int, extra: list[str], extra_top: int) -> DataFrame:
    """Families to be checked: overall order up to overall_max, the top of each extra rank, and all members."""
    inside = ((F.col("key") == overall) & (F.col("order") <= overall_max)) | (F.col("key").isin(extra) & (F.col("order") <= extra_top))
    return ranks.where(inside).select("family").unionByName(members.select("family")).distinct()


#: Relations that map a key to a family, in the order in which one key's entries are taken; the last one maps to none.
RELATIONS = ["direct", "fold", "rename", "build", "package", "ineligible"]
MAPPING = RELATIONS[1:]


def barred(pairs: DataFrame, distinct: DataFrame, spaces: list[str]) -> DataFrame:
    """pairs (ns, mk, family) that a distinct row (ns, mk, family, needle) forbids.

    All spaces of names are one to such a row; one with a needle holds for every key with its mk inside.
    Needles are met by family alone.
    """
    one = lambda c: F.when(c.isin(spaces), F.lit("name")).otherwise(c)
    exact = distinct.where("not needle").select(one(F.col("ns")).alias("_ns"), "mk", "family").distinct()
    near = distinct.where("needle and mk <> ''").select(F.col("mk").alias("_needle"), F.col("family").alias("_family")).distinct()
    some = pairs.select("ns", "mk", "family").distinct().withColumn("_ns", one(F.col("ns")))
    a = some.join(exact, ["_ns", "mk", "family"], "left_semi")
    b = some.join(near, (F.col("family") == F.col("_family")) & F.col("mk").contains(F.col("_needle")), "left_semi")
    return a.unionByName(b).select("ns", "mk", "family").distinct()


def alias_index(rows: DataFrame, keys: DataFrame, names: DataFrame, spaces: list[str], packages: list[tuple[str, str, str]] = (), package_ns: str = "npm") -> DataFrame:
    """What every key means: ns, mk, level, family (empty: ineligible), relation, detail, state.

    rows (ns, mk, family, relation, detail, needle) is the alias table; keys (family, ns, mk) and names (family, mk) are
    the families'. For each key the first level that names anything decides: 0 a mapping row there, 1 a
    family's key (or its package: prefix, ns and detail in `packages`), 2 a mapping row in another space of
    names, 3 a family's name. state: 'hit'; 'ambiguous' where that level names several families; 'violation'
    or 'left out' where a distinct row forbids the family, by a row or key, or else. Rows of families that
    are not there, and bundles, are left out.
    """
    known = keys.select("family").unionByName(names.select("family")).distinct()
    table = rows.where(F.col("relation").isin(MAPPING)).withColumn("family", F.when(F.col("relation") == "ineligible", "").otherwise(F.col("family")))
    table = table.join(known.unionByName(known.sparkSession.createDataFrame([("",)], "family string")), "family", "left_semi")
    entry = ["ns", "mk", "level", "family", "relation", "detail", "own"]
    every = F.explode(F.array(*[F.lit(s) for s in spaces])).alias("ns")
    levels = table.select("ns", "mk", F.lit(0).alias("level"), "family", "relation", F.coalesce("detail", F.lit("")).alias("detail"), F.lit(True).alias("own"))
    direct = keys.select("ns", "mk", F.lit(1).alias("level"), "family", F.lit("direct").alias("relation"), F.lit("").alias("detail"), F.lit(True).alias("own"))
    parts = [levels, direct]
    for prefix, ns, detail in packages:
        parts.append(keys.where(F.col("ns") == ns).select(F.lit(package_ns).alias("ns"), F.concat(F.lit(prefix), "mk").alias("mk"), F.lit(1).alias("level"), "family", F.lit("package").alias("relation"), F.lit(detail).alias("detail"), F.lit(False).alias("own")))
    parts.append(levels.where(F.col("ns").isin(spaces)).drop("ns", "level").select("*", every).select("ns", "mk", F.lit(2).alias("level"), "family", "relation", "detail", F.lit(False).alias("own")))
    named = names.select("family", "mk").unionByName(keys.where(F.col("ns").isin(spaces)).select("family", "mk")).distinct()
    parts.append(named.select("*", every).select("ns", "mk", F.lit(3).alias("level"), "family", F.lit("direct").alias("relation"), F.lit("").alias("detail"), F.lit(False).alias("own")))
    all_ = parts[0].select(*entry)
    for p in parts[1:]:
        all_ = all_.unionByName(p.select(*entry))
    order = F.array_position(F.array(*[F.lit(r) for r in RELATIONS]), F.col("relation"))
    by = all_.groupBy("ns", "mk", "level").agg(F.count_distinct("family").alias("n"), F.min_by(F.struct("family", "relation", "detail"), F.struct(order, "detail", "family")).alias("x"), F.max("own").alias("own"))
    first = by.groupBy("ns", "mk").agg(F.min_by(F.struct("level", "n", "x", "own"), "level").alias("f")).select("ns", "mk", "f.level", "f.n", "f.x.*", "f.own")
    no = barred(first, rows.where("relation = 'distinct' and family is not null").select("ns", "mk", "family", F.coalesce("needle", F.lit(False)).alias("needle")), spaces)
    out = first.join(no.withColumn("_no", F.lit(True)), ["ns", "mk", "family"], "left")
    hard = (F.col("level") == 0) | ((F.col("level") == 1) & F.col("own"))
    state = F.when(F.col("n") > 1, "ambiguous").when(F.col("_no"), F.when(hard, "violation").otherwise("left out")).otherwise("hit")
    seen = lambda c: F.when(state != "ambiguous", F.col(c)).alias(c)
    return out.select("ns", "mk", "level", seen("family"), seen("relation"), seen("detail"), state.alias("state"))


def merged(candidates: DataFrame, rows: DataFrame, index: DataFrame, spaces: list[str]) -> DataFrame:
    """Outcome of every proposed row: candidates (id, ns, mk, family, relation, detail, rule, current) with status and reason.

    family is null where the target is unknown; rule the automatic rule that may accept the proposal, null
    if none; current the new name (folded) that a rename gives its family, null for others. What the table
    has is 'known', what a bundle or a distinct row excludes 'blocked'; what contradicts a row or another
    family's name, or no rule accepts, is 'queued'. Proposals of several families for one key all wait; of those
    that agree, the first accepted one stays. Renames to one new name that keep different families wait as well.
    """
    hits = index.where("state = 'hit'").select("ns", "mk", F.col("family").alias("_hit"), F.col("level").alias("_level"))
    unclear = index.where("state = 'ambiguous'").select("ns", "mk", F.lit(True).alias("_unclear"))
    bundles = rows.where("relation = 'bundle'")
    own = bundles.select("ns", "mk").unionByName(bundles.where(F.col("ns").isin(spaces)).select(F.explode(F.array(*[F.lit(s) for s in spaces])).alias("ns"), "mk")).distinct().withColumn("_bundle", F.lit(True))
    distinct = rows.where("relation = 'distinct' and family is not null").select("ns", "mk", "family", F.coalesce("needle", F.lit(False)).alias("needle"))
    no = barred(candidates.where("family is not null"), distinct, spaces).withColumn("_no", F.lit(True))
    table = rows.withColumn("family", F.when(F.col("relation") == "ineligible", "").otherwise(F.col("family")))
    same = table.select("ns", "mk", "relation", "family", F.lit(True).alias("_same")).distinct()
    held = table.where(F.col("relation").isin(MAPPING)).groupBy("ns", "mk").agg(F.min("family").alias("_least"), F.max("family").alias("_most"))
    c = candidates.join(hits, ["ns", "mk"], "left").join(unclear, ["ns", "mk"], "left").join(own, ["ns", "mk"], "left").join(no, ["ns", "mk", "family"], "left").join(same, ["ns", "mk", "relation", "family"], "left").join(held, ["ns", "mk"], "left")
    maps = F.col("relation").isin(MAPPING)
    is_ = lambda status, reason="": F.struct(F.lit(status).alias("s"), (F.lit(reason) if isinstance(reason, str) else reason).alias("r"))
    judged = (
        F.when(maps & F.col("_bundle"), is_("blocked", "bundle"))
        .when(F.col("family").isNull(), is_("queued", "no-family"))
        .when((maps | (F.col("relation") == "bundle")) & F.col("_no"), is_("blocked", "distinct"))
        .when(~maps, F.when(F.col("_same"), is_("known")).otherwise(is_("queued", "review")))
        .when(F.col("_hit") == F.col("family"), is_("known"))
        .when(F.col("_hit").isNull() & F.col("_unclear"), is_("queued", "other-family"))
        .when(F.col("_hit").isNotNull(), is_("queued", F.when(F.col("_level").isin(0, 2), "conflict").otherwise("other-family")))
        .when((F.col("_least") != F.col("family")) | (F.col("_most") != F.col("family")), is_("queued", "conflict"))
        .when(F.col("rule").isNull(), is_("queued", "review"))
        .otherwise(is_("accepted"))
    )
    c = c.withColumn("_j", judged).select(*candidates.columns, F.col("_j.s").alias("status"), F.col("_j.r").alias("reason"))
    counted = F.col("relation").isin(MAPPING) & F.col("status").isin("accepted", "queued") & F.col("family").isNotNull()
    sides = c.where(counted).groupBy("ns", "mk").agg(F.count_distinct("family").alias("_n"), F.min(F.when(F.col("status") == "accepted", F.col("id"))).alias("_first"))
    c = c.join(sides, ["ns", "mk"], "left").withColumn("_in", counted)
    compete = F.col("_in") & (F.col("_n") > 1)
    follow = F.col("_in") & F.col("_first").isNotNull() & (F.col("_first") != F.col("id"))
    c = c.select(*candidates.columns, F.when(compete, "queued").when(follow, "known").otherwise(F.col("status")).alias("status"), F.when(compete, "competing").when(follow, "").otherwise(F.col("reason")).alias("reason"))
    named = c.where("status = 'accepted' and current is not null").groupBy("current").agg(F.count_distinct("family").alias("_n"))
    c = c.join(named, "current", "left")
    clash = (F.col("status") == "accepted") & (F.coalesce("_n", F.lit(0)) > 1)
    return c.select(*candidates.columns, F.when(clash, "queued").otherwise(F.col("status")).alias("status"), F.when(clash, "competing").otherwise(F.col("reason")).alias("reason"))


def queue(outcomes: DataFrame) -> DataFrame:
    """The owner's questions: a row for each key, target and relation of queued proposals, with how many make it, and its sources if there are any."""
    q = outcomes.where("status = 'queued'")
    more = [F.array_sort(F.collect_set("source")).alias("sources")] if "source" in outcomes.columns else []  # as many as there are miners
    return q.groupBy("ns", "mk", "family", "relation", "detail", "reason").agg(F.count(F.lit(1)).alias("n"), *more)
