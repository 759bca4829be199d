"""Audit of how filters interact: what each takes at each place of each order, over long-form cells.

A document is a mask of the filters that it fails. Documents are counted into cells (part, mask), at
most 32 a part; each cell is unpivoted against the steps of all orders, a running bit-or over a cell's
steps tells what an earlier filter took, conditional sums over a part's cells give a step's metrics,
and a window over a filter's steps in all orders gives its total. Nothing after the cells grows with
the documents.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import body, table

#: The filters' letters, in the order of their bits.
LETTERS = "ABCDE"
#: What stands between words, and the marks of filter D.
BLANKS, MARKS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def failures(text: Column) -> list[Column]:
    """Whether a text fails A (under 100 words), B (few distinct words), C (many capitals), D (marks)."""
    words = F.filter(F.split(text, BLANKS), lambda w: w != "")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]", ""))
    return [
        F.size(words) < 100,
        100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike(MARKS),
    ]


def bits(flags: list[Column]) -> Column:
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(flags)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and filters failed, and how many of them are labelled so.

    Texts travel as digests. Copies within one part with equal labels are counted before they meet the
    rest of their text's copies, so a text that a third of all documents share is a few rows by then.
    """
    text = body(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("t"))
    rows = rows.select("id", "part", bits(failures(F.col("t"))).alias("mask"), F.unhex(F.sha2("t", 256)).alias("digest"))
    # Rows without an id have no label: they spread over salts that no label has.
    rows = rows.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    rows = rows.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(1 << 20)) + 1).otherwise(0))
    good, toxic = (F.max(F.coalesce(F.col(c) == 1, F.lit(False))) for c in ("quality", "toxic"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(good.alias("good"), toxic.alias("toxic"))
    rows = rows.join(marks.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left").drop("salt")
    rows = rows.fillna(False, ["good", "toxic"])
    # Of copies, those of the smallest id are the first; a row without an id is neither first nor a copy.
    same = [F.col("id").isNull().alias("lost"), "digest", "part", "mask", "good", "toxic"]
    copies = rows.groupBy(*same, "id").agg(F.sum("n").alias("n")).groupBy("lost", *same[1:]).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("least"))
    first = F.min("least.id").over(Window.partitionBy("digest", "lost"))  # a digest has four rows a part at most
    alone = F.when(F.col("lost"), F.col("n")).when(F.col("least.id") == F.col("first"), F.col("least.n")).otherwise(0)
    counted = copies.withColumn("first", first).withColumn("alone", alone)
    kinds = F.array(F.struct("mask", F.col("alone").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("alone")).alias("n")))
    counted = counted.select("part", "good", "toxic", F.inline(kinds)).where("n > 0")
    those = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return counted.groupBy("part", "mask").agg(F.sum("n").alias("n"), those("good").alias("good"), those("toxic").alias("toxic"))


def audit(cells: DataFrame) -> DataFrame:
    """Metrics of every step of every order, by part: see op13's columns."""
    steps = [(order, k + 1, 1 << LETTERS.index(f)) for order in map("".join, permutations(LETTERS)) for k, f in enumerate(order)]
    step = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(b).alias("bit")) for o, k, b in steps])
    long = cells.select("*", F.inline(step)).withColumn("own", F.col("mask").bitwiseAND(F.col("bit")))
    before = Window.partitionBy("part", "mask", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    long = long.withColumn("earlier", F.coalesce(F.bit_or("own").over(before), F.lit(0)))
    fails, free = F.col("own") != 0, F.col("earlier") == 0
    total = lambda cond, x: F.sum(F.when(cond, F.col(x)).otherwise(0)).cast("long")
    out = long.groupBy("part", "filter_order", "step", "bit").agg(
        total(~fails & free, "n").alias("kept"),
        total(fails & free, "n").alias("removed"),
        total(fails & ~free, "n").alias("redundant"),
        total(F.col("mask") == F.col("bit"), "n").alias("unique_fails"),
        total(fails & free, "good").alias("good_lost"),
        total(fails & free, "toxic").alias("toxic_lost"),
    )
    return out.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, filter_order and step.

    A null text is empty (it fails A only, if it is no copy); a null part is the empty one. Repeated rows
    count each; rows of one id and text are copies of other ids' rows only. A row without an id is never
    a copy and has no label; of several labels of an id any 1 counts. An empty table gives no row; extra
    columns are not read.
    """
    return audit(cells(docs, labels))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = """
with orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order
    from (values ('A'), ('B'), ('C'), ('D'), ('E')) a(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) b(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) c(f),
        (values ('A'), ('B'), ('C'), ('D'), ('E')) d(f), (values ('A'), ('B'), ('C'), ('D'), ('E')) e(f)
    where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), texts as (
    select doc_id, coalesce(lang, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') w from documents
), docs as (
    select part, len(w) < 100 a, 100 * len(list_distinct(w)) < 80 * len(w) b,
        100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) c, regexp_matches(t, '[#$%&*|]') d,
        coalesce(doc_id > min(doc_id) over (partition by t), false) e,
        exists (from labels l where l.doc_id = texts.doc_id and quality = 1) good,
        exists (from labels l where l.doc_id = texts.doc_id and toxic = 1) toxic
    from texts
), failed as (
    select part, good, toxic, [x.f for x in [{'f': 'A', 'y': a}, {'f': 'B', 'y': b}, {'f': 'C', 'y': c}, {'f': 'D', 'y': d}, {'f': 'E', 'y': e}] if x.y] fs, count(*) n
    from docs group by all
), steps as (
    select filter_order, s.step, substr(filter_order, s.step, 1) f, string_split(substr(filter_order, 1, s.step - 1), '') earlier
    from orders, (select unnest([1, 2, 3, 4, 5]) step) s
), metrics as (
    select part, filter_order, step, f,
        coalesce(sum(n) filter (not list_contains(fs, f) and not list_has_any(fs, earlier)), 0)::bigint kept,
        coalesce(sum(n) filter (list_contains(fs, f) and not list_has_any(fs, earlier)), 0)::bigint removed,
        coalesce(sum(n) filter (list_contains(fs, f) and list_has_any(fs, earlier)), 0)::bigint redundant,
        coalesce(sum(n) filter (fs = [f]), 0)::bigint unique_fails,
        coalesce(sum(n) filter (good and list_contains(fs, f) and not list_has_any(fs, earlier)), 0)::bigint good_lost,
        coalesce(sum(n) filter (toxic and list_contains(fs, f) and not list_has_any(fs, earlier)), 0)::bigint toxic_lost
    from failed, steps group by all
)
select part, filter_order, step::int step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, f))::bigint shapley
from metrics
"""
