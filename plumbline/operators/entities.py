"""Entity resolution: alias joins, bundles, chains of renames, connected names, dependency shares, abstentions."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from plumbline.sources.records import shared_dir


#: Relations of an alias that keep a key from being credited.
BLOCKING = ["sibling", "distinct"]


def resolved(records: DataFrame, aliases: DataFrame, keys: list[str], eligible: DataFrame, family: str = "family", relation: str | None = None) -> DataFrame:
    """Every record with its family: 'matched', 'ineligible' (known, but not to be ranked) or 'unmatched'.

    Exact lookup by keys. An alias of a blocking relation leaves its key unmatched; one of the relation
    'ineligible' resolves without a family, and so does a family that is not in `eligible`.
    """
    named = aliases.where(~F.col(relation).isin(BLOCKING)) if relation else aliases
    barred = F.coalesce(F.col(relation) == "ineligible", F.lit(False)) if relation else F.lit(False)
    found = records.join(named.withColumn("_hit", F.lit(True)), keys, "left").join(eligible.select(family, F.lit(True).alias("_ok")).distinct(), family, "left")
    state = F.when(F.col("_hit").isNull(), "unmatched").when(barred | F.col("_ok").isNull(), "ineligible").otherwise("matched")
    return found.withColumn("resolution", state).withColumn(family, F.when(F.col("resolution") == "matched", F.col(family))).drop("_ok", "_hit")


def unmatched(records: DataFrame, aliases: DataFrame, keys: list[str], value: str, floor: float, top: int) -> DataFrame:
    """Keys without an alias above the floor, the largest first (`top` is the report's length)."""
    left = records.join(aliases.select(*keys), keys, "left_anti").where(F.col(value) > floor)
    return left.orderBy(F.desc(value), *keys).limit(top)


def bundles(values: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """One row per member family of each key, with how many share it."""
    size = members.groupBy(key).agg(F.count(F.lit(1)).alias("n_members"))
    return values.join(members, key).join(size, key)


def dependency_shares(edges: DataFrame, installs: DataFrame, packages: DataFrame, dependents: DataFrame | None = None) -> DataFrame:
    """Which share of a family's installs another package explains: edges (dependent, package), installs (package, n), packages (package, family).

    share = min(1, min(dependent's, package's installs) / the larger of the family's and the package's);
    by family and dependent the largest counts; a family's own packages explain nothing. dependents
    (package, n): installs of dependents, where they are counted apart (else installs has them).
    """
    n = installs.select("package", "n")
    family_n = packages.join(n, "package").groupBy("family").agg(F.max("n").alias("family_n"))
    out = edges.join(n, "package").join((n if dependents is None else dependents).select(F.col("package").alias("dependent"), F.col("n").alias("dependent_n")), "dependent")
    out = out.join(packages, "package").join(family_n, "family")
    share = F.least(F.lit(1.0), F.least("dependent_n", "n") / F.greatest("family_n", "n"))
    out = out.groupBy("family", "dependent").agg(F.max(share).alias("share")).where("share > 0")
    own = packages.select("family", F.col("package").alias("dependent"))
    return out.join(own, ["family", "dependent"], "left_anti")


def abstentions(found: DataFrame, keys: list[str], reason: str, order: list[str]) -> DataFrame:
    """One reason by key: the first of the order."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(reason))
    return found.groupBy(*keys).agg(F.min_by(reason, rank).alias(reason))


def chains(renames: DataFrame, old: str, new: str) -> DataFrame:
    """Where each old name ends, however many renames away; names on a cycle, or leading to one, have no end.

    Each round doubles how far every name has been followed, and is written by checkpoint(). A chain of
    n renames holds one of each length below n, so that a round after which no further name is at its
    end leaves none but those of cycles.
    """
    _checkpoints(renames.sparkSession)
    out = renames.groupBy(old).agg(F.min(new).alias("end")).select(old, "end", F.lit(1).alias("steps")).checkpoint()
    before = None
    while True:
        step = out.select(F.col(old).alias("_from"), F.col("end").alias("_to"), F.col("steps").alias("_steps"))
        moves = F.col("_from").isNotNull()
        out = out.join(step, out["end"] == step["_from"], "left").select(old, F.when(moves, F.col("_to")).otherwise(F.col("end")).alias("end"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), moves.alias("_moved")).checkpoint()
        moved = out.where("_moved").count()
        if moved in (0, before):
            return out.where("not _moved").select(old, "end", "steps")
        before = moved


def _checkpoints(spark) -> None:
    """Sets the folder of checkpoint() where none is set: spark.checkpoint.dir, or a local one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/plumbline-{uuid.uuid4().hex}")


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Least label of each node's component, by labels that spread, hook and jump until nothing changes.

    A node's find goes to the node it is labelled with as well (FastSV), so that a small label need not
    walk a long path node by node. Each round is written to the folder in spark.checkpoint.dir by
    checkpoint(), so a lost executor costs a read of it.
    """
    _checkpoints(edges.sparkSession)
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    pairs = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x is not null").distinct().checkpoint()
    labels = pairs.groupBy("x").agg(F.least(F.min("x"), F.min("y")).alias("label")).checkpoint()
    while True:
        up = labels.select(F.col("x").alias("label"), F.col("label").alias("_up"))
        at = labels.join(up, "label")
        near = pairs.join(at.select(F.col("x").alias("y"), "_up"), "y").groupBy("x").agg(F.min("_up").alias("_near"))
        found = at.join(near, "x", "left").select("x", "label", F.least("_up", "_near").alias("_least"))
        new = found.select("x", F.col("_least").alias("label")).unionByName(found.select(F.col("label").alias("x"), F.col("_least").alias("label")))
        new = new.groupBy("x").agg(F.min("label").alias("label")).checkpoint()
        changed = new.join(labels.withColumnRenamed("label", "_old"), "x").where("label <> _old").take(1)
        labels = new
        if not changed:
            return labels.select(F.col("x").alias("node"), "label")


def drop_code(df: DataFrame, family: str, code: str, order: list[str], unanimous: str) -> DataFrame:
    """A family's drop code: the first of the order that any record has; `unanimous` counts only if all have it."""
    rank = F.array_position(F.array(*[F.lit(x) for x in order]), F.col(code))
    out = df.groupBy(family).agg(F.min_by(code, F.when((rank > 0) & (F.col(code) != unanimous), rank)).alias("_any"), F.every(F.col(code).eqNullSafe(F.lit(unanimous))).alias("_all"))
    return out.select(family, F.when(F.col("_any").isNotNull(), F.col("_any")).when(F.col("_all"), F.lit(unanimous)).alias("drop_code"))


def ids_minted(names: DataFrame, name: str, slug: Column, taken: DataFrame | None = None) -> DataFrame:
    """An id for each name, in name order: its slug ('family' if that is empty), or slug-2, slug-3, ... the first not taken.

    taken: ids (id) that are in use already. A name's number is its place among equal slugs, counted over
    tasks. Only where one slug is another one with a number behind it (or an id taken is) does the order
    of minting decide beyond that; names of such slugs go through one group by root.
    """
    base = F.when(slug == "", "family").otherwise(slug)
    cut = names.withColumn("_slug", base)
    slugs = cut.select("_slug").distinct()
    used = taken.select("id") if taken is not None else slugs.select(F.col("_slug").alias("id")).limit(0)
    every = slugs.select(F.col("_slug").alias("id")).unionByName(used)
    parent = F.regexp_extract("id", r"^(.+)-([2-9]|[1-9][0-9]+)$", 1)
    pairs = every.select("id", parent.alias("_slug")).join(slugs, "_slug")
    clashing = pairs.select("_slug").unionByName(pairs.select(F.col("id").alias("_slug"))).unionByName(used.select(F.col("id").alias("_slug"))).distinct()
    root = lambda c: F.regexp_replace(c, r"(-[0-9]+)+$", "")
    held = used.groupBy(root(F.col("id")).alias("_root")).agg(F.collect_set("id").alias("_held"))
    plain = _numbered(cut.join(clashing, "_slug", "left_anti"), name)
    plain = plain.select(*names.columns, F.when(F.col("_n") == 1, F.col("_slug")).otherwise(F.concat_ws("-", "_slug", F.col("_n").cast("string"))).alias("id"))
    rest = cut.join(clashing, "_slug", "left_semi").withColumn("_root", root(F.col("_slug"))).join(held, "_root", "left")

    columns = [*names.columns, "id"]

    def mint(group: pd.DataFrame) -> pd.DataFrame:
        first = group["_held"].iloc[0]
        used, out = set() if first is None else set(first), []
        group = group.sort_values(name)
        for own in group["_slug"]:
            n = 1
            while (own if n == 1 else f"{own}-{n}") in used:
                n += 1
            out.append(own if n == 1 else f"{own}-{n}")
            used.add(out[-1])
        return group.assign(id=out)[columns]

    schema = StructType([*names.schema.fields, StructField("id", StringType())])
    return plain.unionByName(rest.groupBy("_root").applyInPandas(mint, schema))


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """df with _n, each name's place among those of its _slug, counted in ranges of the names' first characters."""
    range_ = F.substring(F.col(name), 1, 8)
    inside = F.row_number().over(Window.partitionBy("_slug", "_range").orderBy(name))
    cut = df.withColumn("_range", range_)
    upto = Window.partitionBy("_slug").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy("_slug", "_range").agg(F.count(F.lit(1)).alias("_size"))
    bases = sizes.select("_slug", "_range", F.coalesce(F.sum("_size").over(upto), F.lit(0)).alias("_base"))
    return cut.withColumn("_in", inside).join(bases, ["_slug", "_range"]).withColumn("_n", F.col("_base") + F.col("_in"))
