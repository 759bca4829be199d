"""Sources and sinks: strict line JSON, snapshots by source and day, and the formats that collectors bring.

Everything reads through Spark's own readers with a given schema; text formats are taken apart by
column expressions, so a file of any size is dealt out by lines or records.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.kernel import once

OBSERVATION = "source string, series string, ns string, key string, value double, unit string, start date, end date, attrs map<string,string>"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a local one of this process where it is unset."""
    return (spark.conf.get("spark.checkpoint.dir", None) or local_dir()).rstrip("/")


@lru_cache(maxsize=1)
def local_dir() -> str:
    """Stands in for the shared folder on a single machine, where the session names none (tests)."""
    return "file://" + tempfile.mkdtemp(prefix="plumbline-")


def fresh(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing is written to yet."""
    return f"{shared_dir(spark)}/plumbline/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df written once to the shared folder and read from there, so what is made of it twice is computed once."""
    path = fresh(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- line JSON, tables, snapshots --------------------------------------------------------------------


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Objects of a line JSON file (also compressed); blank lines are skipped, anything malformed is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """Rows as line JSON in a total order, keys of each object sorted; an existing path is an error."""
    df.select(*sorted(df.columns)).orderBy(*order).write.mode("errorifexists").json(path)


def check_schema(df: DataFrame, expected: str) -> DataFrame:
    """df if its columns have the expected names and types, else an error that names the first difference."""
    want = StructType.fromDDL(expected)
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    for f in want:
        if have.get(f.name) != f.dataType.simpleString():
            raise ValueError(f"column {f.name}: {have.get(f.name, 'missing')}, not {f.dataType.simpleString()}")
    if extra := set(have) - {f.name for f in want}:
        raise ValueError(f"unknown columns {sorted(extra)}")
    return df.select(*[f.name for f in want])


def write_snapshots(df: DataFrame, path: str, source: str = "source", day: str = "day") -> None:
    """One immutable part by source and day; rewriting a table is an error."""
    df.write.partitionBy(source, day).mode("errorifexists").parquet(path)


def latest_snapshots(table: DataFrame, on_or_before: str, max_age: int, source: str = "source", day: str = "day") -> DataFrame:
    """Rows of each source's newest snapshot that is not after a day and not older than max_age days.

    The days of a partitioned table come from its folders, so only the chosen parts are read: the
    second read is pruned by the first one's result.
    """
    limit = F.to_date(F.lit(on_or_before))
    usable = table.where((F.col(day) <= limit) & (F.datediff(limit, day) <= max_age))
    newest = usable.groupBy(source).agg(F.max(day).alias(day))
    return table.join(F.broadcast(newest), [source, day], "left_semi")  # a row by source


def baselines(table: DataFrame, on: str, least: int, most: int, source: str = "source", day: str = "day") -> DataFrame:
    """Each source's oldest snapshot day between `most` and `least` days before a day."""
    age = F.datediff(F.to_date(F.lit(on)), F.col(day))
    return table.where(age.between(least, most)).groupBy(source).agg(F.min(day).alias(day))


def shrunken(now: DataFrame, before: DataFrame, source: str, share: float) -> DataFrame:
    """Sources whose rows are fewer than a share of those before: such a fetch is refused."""
    count = lambda df, name: df.groupBy(source).agg(F.count(F.lit(1)).alias(name))
    both = count(before, "rows_before").join(count(now, "rows_now"), source, "left").withColumn("rows_now", F.coalesce("rows_now", F.lit(0)))
    return both.where(F.col("rows_now") < share * F.col("rows_before"))


# --- formats ---------------------------------------------------------------------------------------------


def stanzas(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """Paragraphs of 'Field: value' lines: keys, stanza (its number), fields (a map); lines that start blank go on.

    A line that is neither a field, nor goes on from one, nor is blank is an error. One row is to hold
    one paragraph, or a few: large files are read with read_stanzas.
    """
    joined = F.regexp_replace(F.regexp_replace(F.col(text), "\r", ""), r"\n[ \t]+(?=\S)", "\n ")
    parts = df.select(*keys, F.posexplode(F.split(joined, r"\n[ \t]*\n\s*")).alias("stanza", "_part")).where(F.regexp_replace("_part", r"\s+", "") != "")
    return parts.select(*keys, "stanza", fields_of(F.col("_part")).alias("fields"))


def fields_of(paragraph: Column) -> Column:
    """Fields of one paragraph as a map, names in lower case; anything malformed is an error."""
    whole = F.regexp_replace(F.regexp_replace(paragraph, r"^\n+|\n+$", ""), r"\n ", "\u0001")
    lines = F.split(whole, "\n")
    name = lambda x: F.trim(F.substring_index(x, ":", 1))
    ok = F.forall(lines, lambda x: x.contains(":") & (F.length(name(x)) > 0) & ~x.rlike("^[ \\t]"))
    value = lambda x: F.translate(F.trim(F.substr(x, F.instr(x, ":") + 1)), "\u0001", "\n")
    pairs = F.transform(lines, lambda x: F.struct(F.lower(name(x)).alias("key"), value(x).alias("value")))
    return F.map_from_entries(F.when(ok, pairs).otherwise(F.raise_error(F.concat(F.lit("not a field: "), F.substring(paragraph, 1, 80)))))


def read_stanzas(spark: SparkSession, path: str) -> DataFrame:
    """Paragraphs of text files of any size, one a row (fields): the reader splits at blank lines, so a file is dealt out."""
    rows = spark.read.option("lineSep", "\n\n").text(path)
    rows = rows.select(F.regexp_replace(F.regexp_replace("value", "\r", ""), r"\n[ \t]+(?=\S)", "\n ").alias("v")).where(F.regexp_replace("v", r"\s+", "") != "")
    return rows.select(fields_of(F.col("v")).alias("fields"))


def relation_groups(df: DataFrame, relations: str, keys: list[str]) -> DataFrame:
    """'a (>= 1) | b, c' as edges: keys, grp (place of the group), alt (place in it), object (name alone).

    A name repeated in its group is there once; what is no package name is skipped, and a group without
    names does not count.
    """
    groups = F.split(F.translate(F.col(relations), "\n", " "), ",")
    name = lambda a: F.regexp_extract(a, r"^\s*([a-z0-9][a-z0-9+.-]*)", 1)
    named = F.filter(F.transform(groups, lambda g: F.array_distinct(F.filter(F.transform(F.split(g, r"\|"), name), lambda n: n != ""))), lambda g: F.size(g) > 0)
    rows = df.select(*keys, F.posexplode(named).alias("grp", "_names"))
    return rows.select(*keys, "grp", F.posexplode("_names").alias("alt", "object"))


def unpivoted(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row by key and measure: series, value; measures without a value are left out."""
    return df.unpivot(keys, measures, "series", "value").where("value is not null")


def number_of(text: Column) -> Column:
    """A count written with thousands separators; null for anything else."""
    plain = F.regexp_replace(F.trim(text), ",", "")
    return F.when(plain.rlike(r"^\d+$"), plain.cast("long"))


def daily_summary(days: DataFrame, key: str, day: str, value: str, end: str, window: int = 365) -> DataFrame:
    """Daily counts by key: last_year (the window's total), first_day (first one not zero), whole_months (calendar months within)."""
    last = F.to_date(F.lit(end))
    first = F.date_sub(last, window - 1)
    inside = F.col(day).between(first, last)
    month = F.trunc(day, "month")
    whole = inside & (month >= first) & (F.last_day(day) <= last)
    return days.groupBy(key).agg(
        F.sum(F.when(inside, F.col(value)).otherwise(0)).alias("last_year"),
        F.min(F.when(F.col(value) > 0, F.col(day))).alias("first_day"),
        F.count_distinct(F.when(whole, month)).alias("whole_months"),
    )


def weekly_sites(rows: DataFrame, week: str, site: str, name: str, fold: Column) -> DataFrame:
    """By week and folded name: sites (each counts once) and the commonest spelling (the smallest of equals)."""
    named = rows.select(week, site, name, fold.alias("fold"))
    sites = named.groupBy(week, "fold").agg(F.count_distinct(site).alias("sites"))
    spelled = named.groupBy("fold", name).agg(F.count(F.lit(1)).alias("_n"))
    spelled = spelled.groupBy("fold").agg(F.min_by(name, F.struct(-F.col("_n"), F.col(name))).alias("spelling"))
    return sites.join(spelled, "fold").select(week, "fold", "spelling", "sites")


#: Endings of archives and font files that stay with an asset's name.
ENDINGS = (".tar.xz", ".tar.gz", ".tar.bz2", ".tar.zst", ".tgz", ".txz", ".zip", ".7z", ".ttf", ".otf", ".ttc", ".woff", ".woff2", ".dmg", ".pkg")


#: Fixed value: a version of two parts or more between separators.
VERSION = r"(?:^|[-_. ])[vV]?\d+(?:[._]\d+)+(?=$|[-_. ])"


def asset_base(name: Column) -> Column:
    """A release file's name without its folder and a final .zip or .tar.xz."""
    bare = F.substring_index(name, "/", -1)
    return F.when(bare.endswith(".tar.xz"), F.left(bare, F.length(bare) - 7)).when(bare.endswith(".zip"), F.left(bare, F.length(bare) - 4)).otherwise(bare)


def tag_version(tag: Column) -> Column:
    """The version a tag names: its longest run of digits with dots or underscores between them, the first of equals; null without digits."""
    runs = F.regexp_extract_all(tag, F.lit("[0-9]+(?:[._][0-9]+)*"), F.lit(0))
    longest = F.array_max(F.transform(runs, F.length))
    return F.get(F.filter(runs, lambda r: F.length(r) == longest), F.lit(0))


def asset_key(name: Column, tag: Column) -> Column:
    """A release file's name without versions, so that all releases of an asset share it; its ending stays.

    The tag's version, any other one of several parts (both between separators, with or without a v before
    them) and a commit's hash at the end go, in this order. A name of which nothing would be left stays as
    it is.
    """
    ending = F.coalesce(*[F.when(F.lower(name).endswith(e) & (F.length(name) > len(e)), F.right(name, F.lit(len(e)))) for e in ENDINGS], F.lit(""))
    stem = F.left(name, F.length(name) - F.length(ending))
    version = tag_version(tag)
    own = F.concat(F.lit(r"(?:^|[-_. ])[vV]?\Q"), version, F.lit(r"\E(?=$|[-_. ])"))
    stem = F.when(version.isNotNull(), F.regexp_replace(stem, own, F.lit(""))).otherwise(stem)
    stem = F.regexp_replace(stem, VERSION, "")
    commit = F.regexp_extract(stem, "[-_]([0-9a-f]{7,12})$", 1)
    stem = F.when(commit.rlike("[0-9]") & commit.rlike("[a-f]"), F.left(stem, F.length(stem) - F.length(commit) - 1)).otherwise(stem)
    stem = F.regexp_replace(stem, "^[-_. ]+|[-_. ]+$", "")
    return F.when(stem == "", name).otherwise(F.concat(stem, ending))


def repository(repo: Column, key: Column) -> Column:
    """A release's repository in lower case: the one it names, else the first two parts of a key of three or more."""
    parts = F.split(key, "/")
    return F.lower(F.when(F.length(repo) > 0, repo).when(F.size(parts) >= 3, F.concat_ws("/", F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))).otherwise(""))


# --- package versions --------------------------------------------------------------------------------------


def _version_part(part: Column) -> Column:
    """A version or revision as text that sorts as it does: runs of other characters and of digits by turns.

    Of other characters a tilde comes before the end of a run, letters after it, and the rest after them;
    digits come with their number of digits, without leading zeros. An empty part is a zero.
    """
    part = F.when(part == "", "0").otherwise(part)
    def run(t: Column, d: Column) -> Column:
        marked = F.when(t == "", "").otherwise(F.regexp_replace(F.regexp_replace(t, "([^A-Za-z~])", "3$1"), "([A-Za-z])", "2$1"))
        return F.concat(F.translate(marked, "~", "0"), F.lit("1"), once(F.ltrim(d, F.lit("0")), lambda n: F.concat(F.lpad(F.length(n).cast("string"), 4, "0"), n)))

    def runs(p: Column) -> Column:
        of = lambda k: F.regexp_extract_all(p, F.lit("([^0-9]*)([0-9]*)"), F.lit(k))
        return F.array_join(F.zip_with(of(1), of(2), run), "")

    return once(part, runs)


def version_key(version: Column) -> Column:
    """A package version (epoch:upstream-revision) as text whose order is the package manager's; null stays null.

    Epoch first, then upstream up to the last dash, then the revision, one that is missing being empty.
    """
    epoch = once(F.regexp_replace(F.regexp_extract(version, "^([0-9]*):", 1), "^0+", ""), lambda e: F.concat(F.lpad(F.length(e).cast("string"), 4, "0"), e))

    def parts(rest: Column) -> Column:
        dash = F.length(rest) - F.instr(F.reverse(rest), "-")  # characters before the last dash
        has = F.instr(rest, "-") > 0
        return F.concat(_version_part(F.when(has, F.left(rest, dash)).otherwise(rest)), _version_part(F.when(has, F.substr(rest, dash + 2)).otherwise("")))

    return F.concat(epoch, once(F.when(version.contains(":"), F.substr(version, F.instr(version, ":") + 1)).otherwise(version), parts))


def latest_versions(stanzas: DataFrame, package: str, version: str) -> DataFrame:
    """Of each package the row of its highest version, of equal ones the last by content; rows without a package are left out. Keys are made of the distinct versions, and written."""
    columns = [c for c in stanzas.columns if c not in (package, version)]
    keys = written(stanzas.select(version).distinct().select(F.col(version).alias("_version"), version_key(F.coalesce(version, F.lit(""))).alias("k")), "versions")
    order = F.struct("k", version, *columns)
    best = stanzas.join(keys, F.col(version).eqNullSafe(F.col("_version"))).where(F.trim(package) != "").groupBy(F.trim(package).alias(package)).agg(F.max(order).alias("_b"))
    return best.select(package, F.col(f"_b.{version}").alias(version), *[F.col(f"_b.{c}").alias(c) for c in columns])
