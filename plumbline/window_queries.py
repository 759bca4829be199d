"""Queries of the backtest, of ranges by quantiles, of package versions and of placements, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import backtest, lists, universe
from plumbline.plans.views import observations, sql, terms
from plumbline.queries import query
from plumbline.session import table
from plumbline.sources import records

# --- backtest ----------------------------------------------------------------------------------------------

_ROWS = """r as (select o_orderstatus as source, o_custkey item, o_totalprice x, o_orderdate::date - 3 as s, o_orderdate::date + 2 as e from orders), m as (select *, year(s) * 12 + month(s) - 1 as mo from r),
 wh as (select source, mo from m group by all having min(s) <= make_date((mo // 12)::int, (mo % 12 + 1)::int, 1) and max(e) >= last_day(make_date((mo // 12)::int, (mo % 12 + 1)::int, 1)) and last_day(make_date((mo // 12)::int, (mo % 12 + 1)::int, 1)) < date '1998-06-15'),
 v as (select source, mo, item, sum(x) x from m join wh using (source, mo) group by all), isl as (select source, mo, mo - row_number() over (partition by source order by mo) g from (select distinct source, mo from v)),
 ru as (select source, arg_max(struct_pack(a := a, b := b, n := n), b) z from (select source, g, min(mo) a, max(mo) b, count(*) n from isl group by all) group by 1), le as (select source, z.a a, z.b b, least(6, z.n - 1) l from ru where z.n > 1),
 st as (select source, l, unnest(range(a, b - l + 2)) as first from le), wi as (select st.source, st.first, st.first + l - 1 as last, item, sum(x) x from st join v on v.source = st.source and v.mo between st.first and st.first + l - 1 group by all)"""
_PAIRS = f"""with {_ROWS}, rk as (select *, row_number() over (partition by source, first order by x desc, item) k, x / sum(x) over (partition by source, first) sh from wi where x > 0), pr as (select source, first from wi group by 1, 2),
 p as (select source, first as step0, row_number() over (partition by source order by first) step from pr), j as (select p.source, p.step, coalesce(a.item, b.item) item, a.x a, b.x b, a.sh sa, b.sh sb, a.k ra, b.k rb from p join p q on q.source = p.source and q.step = p.step + 1 join (select distinct source, item from rk) i on i.source = p.source
  left join rk a on a.source = p.source and a.first = p.step0 and a.item = i.item left join rk b on b.source = p.source and b.first = q.step0 and b.item = i.item where a.item is not null or b.item is not null),
 t as (select source, step, coalesce(a, 0) a, coalesce(b, 0) b from j where ra <= 50 or rb <= 50), y as (select *, rank() over (partition by source, step order by a) + (count(*) over (partition by source, step, a) - 1) / 2.0 pa, rank() over (partition by source, step order by b) + (count(*) over (partition by source, step, b) - 1) / 2.0 pb from t),
 rho as (select source, step, case when count(*) >= 3 then corr(pa, pb) end rho from y group by all), ju as (select source, step, max(greatest(sb / sa, sa / sb)) jump from j where greatest(sa, sb) >= 0.002 and sa is not null and sb is not null group by all),
 co as (select source, step, abs(count(b) - count(a))::double / nullif(count(a), 0) coverage from j group by all), z as (select source, step, rho, jump, coverage from co left join rho using (source, step) left join ju using (source, step))"""


def _rows(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select(F.col("o_orderstatus").alias("source"), F.col("o_custkey").alias("item"), F.col("o_totalprice").alias("x"), F.date_sub(day, 3).alias("s"), F.date_add(day, 2).alias("e"))


def _pairs(spark, d):
    return backtest.backtest(_rows(spark, d), "source", "item", "x", "s", "e", 6, 50, 0.002, F.to_date(F.lit("1998-06-15")))


@query(f"with {_ROWS} select source, first, last, count(*) items, round(sum(x), 2) total from wi group by all")
def backtest_windows(spark, d):
    """Rolling windows of half a year over the whole months of each status."""
    rows = _rows(spark, d).withColumn("mo", backtest.month_number(F.col("s")))
    whole = backtest.whole_months(rows, "source", "s", "e", "mo", F.to_date(F.lit("1998-06-15")))
    w = backtest.monthly_windows(rows.join(F.broadcast(whole), ["source", "mo"]), "source", "item", "mo", "x", 6)  # a row by source and month
    return w.groupBy("source", "first", "last").agg(F.count(F.lit(1)).alias("items"), F.round(F.sum("x"), 2).alias("total"))


@query(_PAIRS + " select source, step, round(rho, 6) rho, round(jump, 6) jump, round(coverage, 6) coverage from z")
def backtest_pairs(spark, d):
    return _pairs(spark, d).select("source", "step", *[F.round(c, 6).alias(c) for c in ("rho", "jump", "coverage")])


@query(_PAIRS + """ select * from (select unnest(['spearman_min', 'share_jump_max', 'coverage_change_max']) threshold, unnest([floor(round((min(rho) - 0.02) * 100, 6)) / 100, ceil(round((max(jump) + 0.02) * 100, 6)) / 100, ceil(round((max(coverage) + 0.02) * 100, 6)) / 100]) as value from z) where value is not null""")
def backtest_thresholds(spark, d):
    """Thresholds beyond the worst change that the backtest saw."""
    return backtest.suggested(_pairs(spark, d))


@query(sql(""", l as (select source, family item, sum(value) x from obs group by all), s as (select source, family item, sum(value) x from obs where day >= date '2024-01-20' group by all), a as (select source, sum(x) lx, 90 ld from l group by 1), b as (select source, sum(x) sx from s group by 1),
 k as (select source, 1 - 30.0 / ld kept, lx * 30 / ld / sx sc from a join b using (source)), j as (select coalesce(l.source, s.source) source, coalesce(l.item, s.item) item, l.x la, s.x sb from l full join s on l.source = s.source and l.item = s.item)
 select source, item, 0 step, round(la, 4) x from j where la is not null union all select source, item, 1, round(coalesce(la, 0) * kept + coalesce(sb, 0) * sc, 4) from j join k using (source)""", "obs"))
def backtest_slid(spark, d):
    """A window that stands for 90 days, moved on by the last weeks, which stand for 31."""
    o = observations(spark, d)
    of = lambda df, n: df.select("source", F.col("family").alias("item"), F.col("value").alias("x"), F.lit(n).alias("days"))
    return backtest.slid_windows(of(o, 90), of(o.where("day >= date'2024-01-20'"), 31), "source", "item", "x", "days").select("source", "item", "step", F.round("x", 4).alias("x"))


# --- ranges, versions --------------------------------------------------------------------------------------


@query(sql(""", q as (select source, family, x, x - family % 40 low, x + family % 25 high from terms), r as (select source, family, 1 + (select count(*) from terms t where t.source = q.source and t.family <> q.family and t.x > q.high) best, 1 + (select count(*) from terms t where t.source = q.source and t.family <> q.family and t.x > q.low) worst from q)
 select * from r""", "terms"))
def quantile_rank_ranges(spark, d):
    """Ranks at both ends of an interval around each score."""
    t = terms(spark, d).withColumn("score", F.col("x"))
    q = t.select("source", "family", (F.col("x") - F.col("family") % 40).alias("low"), (F.col("x") + F.col("family") % 25).alias("high"))
    return lists.quantile_ranges(t, q, ["source"], "family")


#: Versions made of a line's numbers: with epochs, tildes, letters, leading zeros and revisions.
_VERSION = "case when l_orderkey % 6 = 0 then '1:' else '' end || l_linenumber || '.' || lpad((l_suppkey % 12)::varchar, 2, '0') || case l_orderkey % 4 when 0 then '~rc' || l_partkey % 3 when 1 then '+git' when 2 then 'b' else '' end || case when l_orderkey % 5 = 0 then '' else '-' || l_orderkey % 30 end"


@query(f"""with v as (select l_partkey package, {_VERSION} as version, l_orderkey % 6 = 0 as ep, l_linenumber a, l_suppkey % 12 b, case l_orderkey % 4 when 0 then -1 when 1 then 2 when 2 then 1 else 0 end k, case when l_orderkey % 4 = 0 then l_partkey % 3 else 0 end rc, case when l_orderkey % 5 = 0 then 0 else l_orderkey % 30 end rev, l_orderkey % 5 > 0 as has from lineitem)
 select package, arg_max(version, (ep, a, b, k, rc, rev, version)) as version from v group by 1""")
def package_latest(spark, d):
    """The highest version of each part, in the package manager's order."""
    o, k = F.col("l_orderkey"), lambda c: F.col(c).cast("string")
    tail = F.when(o % 4 == 0, F.concat(F.lit("~rc"), (F.col("l_partkey") % 3).cast("string"))).when(o % 4 == 1, "+git").when(o % 4 == 2, "b").otherwise("")
    v = F.concat(F.when(o % 6 == 0, "1:").otherwise(""), k("l_linenumber"), F.lit("."), F.lpad((F.col("l_suppkey") % 12).cast("string"), 2, "0"), tail, F.when(o % 5 == 0, "").otherwise(F.concat(F.lit("-"), (o % 30).cast("string"))))
    return records.latest_versions(table(spark, d, "lineitem").select(k("l_partkey").alias("p"), v.alias("version")), "p", "version").select(F.col("p").cast("long").alias("package"), "version")


# --- placements --------------------------------------------------------------------------------------------


@query()
def universe_placements(spark, d):
    """Suppliers and parts as records of brands, placed until nothing moves; a twentieth of the brands has an id already."""
    p = table(spark, d, "part").withColumn("b", F.lower("p_brand"))
    k = F.col("p_partkey")
    other = F.when(k % 17 == 0, F.array(F.lower("p_type"))).otherwise(F.array().cast("array<string>"))
    recs = p.select(k.alias("rid"), F.when(k % 3 == 0, "npm").when(k % 3 == 1, "gf").otherwise("deb").alias("ns"), F.lower("p_name").alias("km"), F.concat("p_brand", F.lit(" "), (F.col("p_size") % 7).cast("string")).alias("name"), F.concat("b", F.lit(" "), (F.col("p_size") % 7).cast("string")).alias("mk"), other.alias("asserted"), (k % 4).cast("int").alias("rank"))
    registry = recs.where("rid % 20 = 0").groupBy("mk").agg(F.min("name").alias("n")).select(F.regexp_replace(F.lower("n"), "[^a-z0-9]+", "-").alias("id"), F.col("mk").alias("name"), F.col("mk").alias("minted_from"), F.lit("2025-01-01").cast("date").alias("first_seen"))
    relation = F.when(k % 41 == 0, "ineligible").when(k % 43 == 0, "bundle").when(k % 37 == 0, "fold").when(k % 31 == 0, "distinct")
    rows = p.where(relation.isNotNull()).select(F.when(k % 2 == 0, "gf").otherwise("npm").alias("ns"), F.when(k % 37 == 0, F.lower("p_name")).otherwise(F.concat("b", F.lit(" "), (F.col("p_size") % 7).cast("string"))).alias("mk"), F.regexp_replace(F.concat("b", F.lit("-"), ((F.col("p_size") + 1) % 7).cast("string")), "[^a-z0-9]+", "-").alias("family"), relation.alias("relation"), F.lit("why").alias("detail"), F.lit(False).alias("needle"), (k % 2 == 0).alias("named"))
    where, _ = universe.settled_universe(recs, rows, registry, "2026-01-01")
    return where
