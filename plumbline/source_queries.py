"""Queries of the sources, the measurement model, the gates and the streaming jobs, and their DuckDB SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from plumbline.operators import gates, licences, model
from plumbline.plans.views import monthly, observations, sql
from plumbline.queries import query
from plumbline.session import table
from plumbline.sources import records
from plumbline.streaming import jobs

# --- sources ---------------------------------------------------------------------------------------------


@query("select event_id, (props->>'k')::bigint k from events")
def jsonl_props(spark, d):
    """Line JSON with a strict schema: written by Spark, read back FAILFAST."""
    path = records.fresh(spark, "props")
    table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k")).write.json(path)
    return records.read_jsonl(spark, path, "event_id long, k long")


@query("""with s as (select event_type as source, ts::date as day, count(*) n from events group by all), m as (select source, max(day) as day from s where day <= date '2024-01-20' and day >= date '2023-12-21' group by 1)
 select source, day, n from s join m using (source, day)""")
def snapshot_latest(spark, d):
    """Snapshots by source and day, of which each source's newest usable one is read."""
    path = records.fresh(spark, "snapshots")
    days = observations(spark, d).groupBy("source", "day").agg(F.count(F.lit(1)).alias("n"))
    records.write_snapshots(days.repartition("source"), path)
    stored = spark.read.schema("n long, source string, day date").parquet(path)
    return records.latest_snapshots(stored, "2024-01-20", 30).select("source", "day", "n")


@query("select event_type as source, min(ts::date) as day from events where date_diff('day', ts::date, date '2024-02-01') between 7 and 28 group by 1")
def snapshot_baseline(spark, d):
    return records.baselines(observations(spark, d), "2024-02-01", 7, 28)


@query("""with b as (select o_orderpriority as source, count(*) rows_before from orders where year(o_orderdate) = 1996 group by 1), n as (select o_orderpriority as source, count(*) rows_now from orders where year(o_orderdate) = 1998 group by 1)
 select source, rows_before, coalesce(rows_now, 0) rows_now from b left join n using (source) where coalesce(rows_now, 0) < 0.95 * rows_before""")
def shrink_guard(spark, d):
    o = table(spark, d, "orders").withColumnRenamed("o_orderpriority", "source")
    return records.shrunken(o.where(F.year("o_orderdate") == 1998), o.where(F.year("o_orderdate") == 1996), "source", 0.95)


def _packages(spark, d):
    """A package list as text files of stanzas, one for each supplier, read back by stanza."""
    s, k = table(spark, d, "supplier"), F.col("s_suppkey").cast("string")
    m = lambda n: (F.col("s_suppkey") % n).cast("string")
    text = F.concat(F.lit("Package: pkg-"), k, F.lit("\nVersion: 1."), m(9), F.lit("\nDepends: lib"), m(7), F.lit(" (>= 1.2) | lib"), m(5), F.lit(":any,\n core"), m(3), F.lit(", |\nNote: a: b"))
    path = records.fresh(spark, "packages")
    s.select(text.alias("value")).write.option("lineSep", "\n\n").text(path)
    return records.read_stanzas(spark, path)


@query("select 'pkg-' || s_suppkey as package, '1.' || s_suppkey % 9 as version, 'a: b' as note from supplier")
def stanza_fields(spark, d):
    return _packages(spark, d).select(*[F.col("fields")[c].alias(c) for c in ("package", "version", "note")])


@query("""select 'pkg-' || s_suppkey as package, 0 grp, 0 alt, 'lib' || s_suppkey % 7 as object from supplier union all select 'pkg-' || s_suppkey, 0, 1, 'lib' || s_suppkey % 5 from supplier where s_suppkey % 7 <> s_suppkey % 5 union all select 'pkg-' || s_suppkey, 1, 0, 'core' || s_suppkey % 3 from supplier""")
def relation_groups(spark, d):
    f = _packages(spark, d).select(F.col("fields")["package"].alias("package"), F.col("fields")["depends"].alias("depends"))
    return records.relation_groups(f, "depends", ["package"])


@query("""with t as (select l_returnflag flag, round(sum(l_quantity), 2) quantity, round(sum(l_tax), 4) tax, max(l_linenumber)::double most from lineitem group by 1)
 select flag, 'quantity' as series, quantity as value from t union all select flag, 'tax', tax from t union all select flag, 'most', most from t""")
def unpivot_measures(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("flag"))
    t = li.agg(F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum("l_tax"), 4).alias("tax"), F.max("l_linenumber").cast("double").alias("most"))
    return records.unpivoted(t, ["flag"], ["quantity", "tax", "most"])


@query("select p_partkey, p_size * 1234567 as n from part")
def thousands_numbers(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.format_number(F.col("p_size") * 1234567, 0).alias("text"))
    return p.select("p_partkey", records.number_of(F.col("text")).cast("int").alias("n"))


@query("""with x as (select o_custkey package, o_orderdate::date as day, count(*) n from orders group by all)
 select package, sum(case when day between date '1997-07-02' and date '1998-07-01' then n else 0 end)::bigint last_year, min(day) first_day,
 count(distinct case when day between date '1997-07-02' and date '1998-07-01' and date_trunc('month', day) >= date '1997-07-02' and last_day(day) <= date '1998-07-01' then date_trunc('month', day) end) whole_months from x group by 1""")
def daily_summary(spark, d):
    days = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("package"), F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return records.daily_summary(days, "package", "day", "n", "1998-07-01")


@query("""with r as (select date_trunc('week', ts)::date as week, user_id site, case when event_id % 3 = 0 then upper(event_type) else event_type end as name from events),
 s as (select week, lower(name) as fold, count(distinct site) sites from r group by all), n as (select lower(name) as fold, name, count(*) n from r group by all), p as (select fold, name as spelling from n qualify row_number() over (partition by fold order by n desc, name) = 1)
 select week, fold, spelling, sites from s join p using (fold)""")
def weekly_sites(spark, d):
    e = table(spark, d, "events")
    day = F.to_date("ts")
    name = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    rows = e.select(F.date_sub(day, F.weekday(day)).alias("week"), F.col("user_id").alias("site"), name.alias("name"))
    return records.weekly_sites(rows, "week", "site", "name", F.lower("name"))


@query("""with p as (select p_partkey, regexp_replace(p_name, '[^A-Za-z]', '', 'g') n, (p_size % 9) || '.' || (p_partkey % 12) v, p_size from part)
 select p_partkey, n || case p_partkey % 5 when 1 then '-ttf' else '' end || case when p_partkey % 3 = 0 then '.tar.gz' when p_partkey % 3 = 1 then '.tar.xz' else '.zip' end as base, case when p_partkey % 2 = 0 then 'own/repo' || p_size else 'named/repo' end repo from p""")
def asset_names(spark, d):
    """Files of a release that carry its version in several ways, another version, or a commit; all releases of one come to one key."""
    k = F.col("p_partkey")
    n, v = F.regexp_replace("p_name", "[^A-Za-z]", ""), F.concat((F.col("p_size") % 9).cast("string"), F.lit("."), (k % 12).cast("string"))
    stem = F.when(k % 5 == 0, F.concat(n, F.lit("-v"), v)).when(k % 5 == 1, F.concat(n, F.lit("_"), v, F.lit("-ttf"))).when(k % 5 == 2, F.concat(n, F.lit("-3f174fcef6"))).when(k % 5 == 3, F.concat(n, F.lit("_v77.1_2"))).otherwise(n)
    name = F.concat(stem, F.when(k % 3 == 0, ".tar.gz").when(k % 3 == 1, ".tar.xz").otherwise(".zip"))
    key = F.concat(F.lit("Own/Repo"), F.col("p_size").cast("string"), F.lit("/x"))
    tag = F.concat(F.lit("release-"), F.when(k % 5 < 2, v).otherwise(""))
    return table(spark, d, "part").select("p_partkey", records.asset_key(name, tag).alias("base"), records.repository(F.when(k % 2 == 1, "Named/Repo"), key).alias("repo"))


# --- gates -----------------------------------------------------------------------------------------------


@query("""select p_partkey, case when s and l then 'pass' when c then 'cjk' when not l then 'no_latin_subset' else 'dual_script' end verdict from (select p_partkey, p_size % 4 in (0, 1) s, p_size % 3 <> 0 l, p_size % 4 = 2 c from part)""")
def script_gate(spark, d):
    k = F.col("p_size")
    p = table(spark, d, "part").select("p_partkey", F.when(k % 4 == 0, "").when(k % 4 == 1, "Latn").when(k % 4 == 2, "Jpan").otherwise("Grek").alias("script"), F.when(k % 3 != 0, F.array(F.lit("latin"), F.lit("x"))).otherwise(F.array(F.lit("x"))).alias("subsets"))
    return p.select("p_partkey", gates.script_verdict(F.col("script"), F.col("subsets")).alias("verdict"))


@query("""with f as (select c_nationkey family, c_mktsegment category, case c_custkey % 3 when 0 then 'a' when 1 then 'b' else 'c' end as source, c_custkey k from customer where c_custkey % 5 <> 0)
 select family, category, source from f qualify row_number() over (partition by family order by source, k) = 1""")
def first_source_facts(spark, d):
    k = F.col("c_custkey")
    source = F.when(k % 3 == 0, "a").when(k % 3 == 1, "b").otherwise("c")
    facts = table(spark, d, "customer").select(F.col("c_nationkey").alias("family"), F.when(k % 5 != 0, F.col("c_mktsegment")).alias("category"), source.alias("source"), k.alias("k"))
    return gates.first_of(facts, ["family"], "category", "source", ["a", "b", "c"], ["k"])


@query("""select p_partkey, greatest(0, 6 - p_size % 8)::int missing, round(least(p_size % 8, 6) / 6.0, 4) share,
 case when p_size % 8 >= 6 then 'pass' when p_size % 8 >= 3 then 'partial' else 'fail' end verdict from part""")
def glyph_gate(spark, d):
    kernel = [65, 66, 67, 97, 98, 99]
    have = F.slice(F.array(*[F.lit(x) for x in [*kernel, 1000, 1001]]), 1, F.col("p_size") % 8)
    return gates.glyph_coverage(table(spark, d, "part").select("p_partkey", have.alias("points")), "points", kernel, 0.5).drop("points")


@query("""select s_suppkey, sha256('permission is hereby granted to use this ' || s_suppkey % 3) print from supplier""")
def license_print(spark, d):
    k = F.col("s_suppkey")
    text = F.concat(F.lit("The Title\r\nCopyright (c) 20"), (k % 90 + 10).cast("string"), F.lit(" Someone\n(c) 2019 Another\nwith Reserved Font Name X.\n\n1. Permission is HEREBY granted,\n to use https://x.org/a  this: "), (k % 3).cast("string"), F.lit(".\n"))
    # A small file is one task, but the work on its rows is not small.
    rows = table(spark, d, "supplier").repartition(3 * spark.sparkContext.defaultParallelism, "s_suppkey")
    return rows.select("s_suppkey", licences.text_print(text).alias("print"))


# --- the measurement model ---------------------------------------------------------------------------------

#: Parameters of the example's terms: alpha, lam, bulk, k.
MODEL = {"click": (1.0, 0.8, 0.2, 3.0), "view": (1.2, 0.6, 0.1, 4.0), "purchase": (0.5, 0.9, 0.1, 2.0)}


def _model_terms(spark, d):
    names = observations(spark, d).where(F.col("source").isin(list(MODEL))).groupBy("family", F.col("source").alias("term")).agg(F.count(F.lit(1)).cast("double").alias("y"))
    out = names.withColumn("n", F.lit(1.0)).withColumn("e", F.lit(1.0))
    for i, c in enumerate(("alpha", "lam", "bulk", "k")):
        value = F
        for term, given in MODEL.items():
            value = value.when(F.col("term") == term, given[i])
        out = out.withColumn(c, value)
    return out


_GRID = f"""select i, {model.LOW} + {model.STEP} * i x, ln({model.STEP} * case when i in (0, 260) then 0.5 else 1.0 end) - ({model.LOW} + {model.STEP} * i) ** 2 / 2 - 0.5 * ln(2 * pi()) w from range(261) t(i)"""
_CASES = {c: "case source " + " ".join(f"when '{t}' then {g[i]}" for t, g in MODEL.items()) + " end" for i, c in enumerate(("alpha", "lam", "bulk", "k"))}
_MODEL = f""", t as (select family, source, count(*)::double y, {_CASES["alpha"]}::double alpha, {_CASES["lam"]}::double lam, {_CASES["bulk"]}::double bulk, {_CASES["k"]}::double k from obs where source in ('click', 'view', 'purchase') group by all), g as ({_GRID}),
 c as (select t.*, i, x, w, bulk + exp(alpha + lam * x) m from t, g), e as (select family, source, i, x, w, lgamma(y + k) - lgamma(k) - lgamma(y + 1) + k * ln(k / (k + m)) + y * ln(m / (k + m)) l from c),
 f as (select family, i, x, any_value(w) + sum(l) l from e group by all), b as (select *, exp(l - max(l) over (partition by family)) p, max(l) over (partition by family) top from f)"""


@query(sql(_MODEL + """, s as (select family, sum(p * x) / sum(p) m, sum(p * x * x) / sum(p) m2, any_value(top) + ln(sum(p)) ev from b group by 1) select family, round(m, 5) mean, round(sqrt(m2 - m * m), 5) sd, round(ev, 5) evidence from s""", "obs"))
def model_posterior(spark, d):
    out = model.posterior(_model_terms(spark, d), ["family"])
    return out.select("family", *[(F.round(c, 5) + F.lit(0.0)).alias(c) for c in ("mean", "sd", "evidence")])


@query(sql(_MODEL + f""", q as (select family, x, p / sum(p) over (partition by family) s, sum(p) over (partition by family order by i) / sum(p) over (partition by family) cum from b)
 select family, round(min_by(x - {model.STEP / 2} + {model.STEP} * (0.05 - (cum - s)) / s, x) filter (where cum >= 0.05), 4) low, round(min_by(x - {model.STEP / 2} + {model.STEP} * (0.95 - (cum - s)) / s, x) filter (where cum >= 0.95), 4) high from q group by 1""", "obs"))
def model_quantiles(spark, d):
    out = model.posterior(_model_terms(spark, d), ["family"], (0.05, 0.95))
    return out.select("family", F.round("q0", 4).alias("low"), F.round("q1", 4).alias("high"))


@query(sql(_MODEL + f""", z as (select family, source, i, lead(l) over w2 + lag(l) over w2 - 2 * l bend from e window w2 as (partition by family, source order by i)), n as (select family, sum(p) whole from b group by 1),
 o as (select z.family, source, greatest(sum(-bend * p) / any_value(whole) / {model.STEP * model.STEP}, 0) info from z join b on b.family = z.family and b.i = z.i join n on n.family = z.family where bend is not null group by all)
 select family, source as term, round(info / sum(info) over (partition by family), 4) share from o""", "obs"))
def model_information(spark, d):
    return model.information_shares(_model_terms(spark, d), ["family"]).select("family", "term", F.round("share", 4).alias("share"))


@query("select c_custkey, round(case when c_custkey % 7 = 0 then 1.0 else least(greatest(c_custkey % 500 / 365.0, 0), 1) end, 6) share from customer")
def age_share(spark, d):
    k = F.col("c_custkey")
    first = F.when(k % 7 != 0, F.date_sub(F.to_date(F.lit("2024-01-01")), (k % 500).cast("int")))
    return table(spark, d, "customer").select("c_custkey", F.round(gates.age_share(first, F.to_date(F.lit("2024-01-01")), 365), 6).alias("share"))


@query()
def lgamma_table(spark, d):
    """The log-gamma expression against the closed form of factorials: largest error."""
    n = spark.range(1, 21).select("id", F.abs(model.lgamma(F.col("id").cast("double")) - F.log(F.factorial((F.col("id") - 1).cast("int")).cast("double"))).alias("error"))
    return n.agg(F.max("error").alias("largest")).select((F.col("largest") < 1e-9).alias("exact"), F.lit(math.pi).alias("pi"))


# --- streams -----------------------------------------------------------------------------------------------


@query("""select time_bucket(interval 7 days, ts, timestamp '1970-01-01') as start, event_type as source, count(*) n, round(sum(value), 2) total from events group by all""")
def stream_weekly_counts(spark, d):
    """Counts by week as a stream of updates, of which the last one counts."""
    events = jobs.stream(spark, f"{d}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("source"), "value")
    updates = jobs.drained(jobs.windowed_counts(events, "ts", ["source"], "value"), "update", "weekly")
    return jobs.latest_of(updates, ["start", "source"], "n").select(F.col("start").cast("timestamp_ntz").alias("start"), "source", "n", F.round("total", 2).alias("total"))


@query(sql(""", m as (select source, month, round(x, 2) x, row_number() over (partition by source order by month) k from monthly), r as (
 select a.source, a.month, sum(case when b.k = 1 then b.x * 0.7 ** (a.k - 1) else 0.3 * b.x * 0.7 ** (a.k - b.k) end) s from m a join m b on a.source = b.source and b.k <= a.k group by all) select source, month, round(s, 2) smooth from r""", "monthly"))
def stream_ewma(spark, d):
    """Smoothing with kept state, on monthly totals that come as files."""
    path = records.fresh(spark, "months")
    monthly(spark, d).select("source", F.col("month").cast("long").alias("month"), F.round("x", 2).alias("x")).write.parquet(path)
    out = jobs.drained(jobs.smoothed_stream(jobs.stream(spark, path), "source", "month", "x", 0.3), "append", "ewma")
    return out.select("source", F.col("month").cast("int").alias("month"), F.round("smooth", 2).alias("smooth"))
