"""Queries of survey scoring, corrections, checks, flags and links, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions.kernel import row_numbers, six
from plumbline.operators import checks, corrections, licences, links, scoring, surveys
from plumbline.plans.views import SQL, counts, observations, sql, terms
from plumbline.queries import _EQUATE, W_SQL, WEIGHTS, query
from plumbline.session import table

#: The example's independence groups of sources, their fixed shares, and the source that counts for the gate alone.
GROUPS = {"click": "web", "view": "web", "purchase": "shop", "signup": "shop", "error": "ops"}
SHARES = {"web": 0.5, "shop": 0.3, "ops": 0.2}
GATE_ONLY = "error"
G_SQL = "case source " + " ".join(f"when '{k}' then '{v}'" for k, v in GROUPS.items()) + " end"
S_SQL = "case grp " + " ".join(f"when '{k}' then {v}" for k, v in SHARES.items()) + " end"
_WEIGHTS = f""", o as (select source, count(*) n from terms join counts using (family) group by 1), e as (select source, {G_SQL} grp, {W_SQL} * case when n < 15 then 0.0 else least(1.0, n / 60.0) end w from o),
 ew as (select source, case when sum(w) over (partition by grp) > 0 then {S_SQL} * w / sum(w) over (partition by grp) else 0.0 end w from e)"""


def states(spark, d):
    """Terms with their state: values under 100 are censored."""
    return terms(spark, d).withColumn("state", F.when(F.col("x") < 100, "censored").otherwise("observed"))


def grouped(df):
    group = F
    for k, v in GROUPS.items():
        group = group.when(F.col("source") == k, v)
    return df.withColumn("group", group)


def effective(spark, d):
    nominal = grouped(spark.createDataFrame(list(WEIGHTS.items()), "source string, w double"))
    n = terms(spark, d).join(counts(spark, d).select("family"), "family", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return surveys.effective_weights(nominal, n, 60, 15, spark.createDataFrame(list(SHARES.items()), "group string, share double"))


@query(sql(_WEIGHTS + " select source, round(w, 9) w from ew", "terms", "counts"))
def effective_weights(spark, d):
    return effective(spark, d).select("source", F.round("w", 9).alias("w"))


@query(sql(_WEIGHTS + f""", k as (select source, case when {G_SQL} = 'web' then 'desktop' else 'project' end as key, w from ew) select source, round(case when sum(w) over (partition by key) > 0 then case key when 'desktop' then 0.6 else 0.4 end * w / sum(w) over (partition by key) else 0.0 end, 9) w from k""", "terms", "counts"))
def mix_weights(spark, d):
    """Two keys of a mix: the web sources, and all others."""
    keyed = grouped(effective(spark, d)).withColumn("key", F.when(F.col("group") == "web", "desktop").otherwise("project"))
    mix = spark.createDataFrame([("desktop", 0.6), ("project", 0.4)], "key string, share double")
    return surveys.mix_weights(keyed.select("key", "source", "w"), mix).select("source", F.round("w", 9).alias("w"))


def gates(spark, d):
    return surveys.groups_of(grouped(states(spark, d)), "family", "group", "state", F.col("source") == GATE_ONLY)


_GATES = f""", gt as (select family, count(*) filter (where source <> '{GATE_ONLY}') n_observed, coalesce(list_sort(list(distinct {G_SQL}) filter (where source <> '{GATE_ONLY}')), []) groups,
 coalesce(list_sort(list(distinct {G_SQL}) filter (where source = '{GATE_ONLY}')), []) gate_groups from terms where x >= 100 group by 1)"""


@query(sql(_GATES + " select f.family, coalesce(n_observed, 0) n_observed, coalesce(groups, []) groups, coalesce(gate_groups, []) gate_groups from (select distinct family from terms) f left join gt using (family)", "terms"))
def gate_groups(spark, d):
    return gates(spark, d)


#: The same SQL on terms of which the censored ones are below all others.
_STATED = "with terms as (select source, family, case when x < 100 then '-infinity'::double else x end x from (" + SQL["terms"] + ") where source <> 'error'), counts as (" + SQL["counts"] + ")" + _EQUATE + f""", w as (select eq.*, {W_SQL} w, case when count(*) over (partition by family) >= 3 and abs(z - median(z) over (partition by family)) > 1.5 then 0.5 else 1.0 end guard from eq)"""
_WHOLE = sum(v for k, v in WEIGHTS.items() if k != GATE_ONLY)
_SURVEY = _STATED + f""", su as (select family, sum(w * guard * z) wz, sum(w * guard) weight, min(z) lo, max(z) hi from w group by 1),
 fu as (select family, round(weight, 6) weight, round(least(greatest(wz / (0.2 * {_WHOLE} + weight), least(lo, 0)), greatest(hi, 0)), 6) + 0.0 score from su),
 a as (select event_type source, user_id family, round(sum(value), 2) x from events group by all), gt as (select family, count(*) filter (where source <> 'error') n_observed, count(distinct {G_SQL}) n_groups from a where x >= 100 group by 1),
 r as (select fu.*, n_groups >= 2 ok, row_number() over (order by score desc, weight desc, family) rn from fu join gt using (family) where n_observed >= 1), r2 as (select *, sum(ok::int) over (order by rn) np from r),
 l as (select max(rn) filter (where ok and np <= 20) last, max(np) mx from r2), k as (select r2.*, case when ok and np <= 20 then 0 when mx < 20 or rn <= last then 1 else 2 end kind from r2, l),
 pl as (select family, score, row_number() over (order by kind, rn) place, case when kind = 0 then row_number() over (order by kind, rn) end as rank, not ok and rn <= 20 gate_held from k)"""


def scored(spark, d):
    """Equated and guarded terms of a survey whose gate-only source has no weight."""
    weights = spark.createDataFrame([(k, v if k != GATE_ONLY else 0.0) for k, v in WEIGHTS.items()], "source string, w double")
    return surveys.score(states(spark, d), scoring.ruler(counts(spark, d), "family", "n"), weights, "family", {"gap": 1.5}, _WHOLE)


def survey(spark, d):
    fused = scoring.fused(scored(spark, d), ["family"], "w", _WHOLE)
    fused = fused.withColumn("score", six(F.col("score"))).withColumn("weight", F.round("weight", 6))
    return surveys.placed(fused, gates(spark, d), "family", 20)


@query(_SURVEY + " select family, score, place, rank, gate_held from pl")
def survey_scores(spark, d):
    """One survey from terms to places: equating with censored terms, guard, fusion, evidence gate."""
    return survey(spark, d).select("family", "score", "place", "rank", "gate_held")


@query(_STATED + f""", v as (select family, source, z, guard, case when source in ('click', 'view') then 0.6 * {W_SQL} / {WEIGHTS["click"] + WEIGHTS["view"]} else 0.4 * {W_SQL} / {WEIGHTS["purchase"] + WEIGHTS["signup"]} end v from w),
 su as (select family, sum(v * guard * z) wz, sum(v * guard) weight, min(z) lo, max(z) hi from v group by 1) select family, round(least(greatest(wz / (0.2 * 1.0 + weight), least(lo, 0)), greatest(hi, 0)), 6) + 0.0 score from su""")
def overall_fusion(spark, d):
    """Two surveys' terms fused at once, each keeping its guard."""
    keyed = spark.createDataFrame([("desktop" if GROUPS[k] == "web" else "project", k, v) for k, v in WEIGHTS.items() if k != GATE_ONLY], "key string, source string, w double")
    mix = surveys.mix_weights(keyed, spark.createDataFrame([("desktop", 0.6), ("project", 0.4)], "key string, share double"))
    return surveys.overall(scored(spark, d), mix, "family").select("family", six(F.col("score")).alias("score"))


@query(_SURVEY + """, h as (select family, place, rank, case when rank <= 5 and family % 2 = 0 then true else false end held from pl), m as (select greatest(21 - min(place) filter (where rank is null), 0) shift from h)
 select family, case when rank is null then place + coalesce(shift, 0) else place - (select count(*) from h g where g.held and g.rank is not null and g.place < h.place) end published from h, m where not held""")
def published_orders(spark, d):
    """Some of the first five ranks are held back; the ranks behind them close up."""
    p = survey(spark, d).withColumn("list", F.lit("all"))
    held = p.where("rank <= 5 and family % 2 = 0").select("family")
    return surveys.published(p, ["list"], "family", 20, held).select("family", "published")


@query(sql(""", v as (select family, source, case when source in ('click', 'purchase') then case family % 5 when 0 then 'too_new' when 1 then 'censored' else 'observed' end when family % 3 = 0 then 'observed' else 'censored' end st from terms), view as (select * from v where source in ('click', 'purchase')), placed as (select distinct family from view where st = 'observed'),
 lost as (select distinct a.family from v a where source in ('view', 'signup') and st = 'observed')
 select f.family, case when lost.family is not null then 'no_deliberate_evidence' when f.family in (select family from view where st = 'too_new') then 'too_new' else 'no_evidence' end reason from (select distinct family from terms) f left join lost using (family) where f.family not in (select family from placed)""", "terms"))
def unranked_reasons(spark, d):
    """A view of two sources against one of four, with families that are too new, censored or seen elsewhere alone."""
    part = F.col("family") % 5
    inside = F.when(part == 0, "too_new").when(part == 1, "censored").otherwise("observed")
    v = terms(spark, d).withColumn("state", F.when(F.col("source").isin("click", "purchase"), inside).when(F.col("family") % 3 == 0, "observed").otherwise("censored"))
    view = v.where(F.col("source").isin("click", "purchase"))
    return surveys.unranked_reasons(v, view.where("state = 'observed'").select("family").distinct(), view, v, ["view", "signup"], "family")


# --- corrections -------------------------------------------------------------------------------------------


@query("select event_id, event_type from events where event_type = 'view' and ts < timestamp '2024-01-20' and event_id % 5 <> 0 and (event_id % 3 <> 0 or user_id < 20)")
def selected_observations(spark, d):
    """Views as observations of monthly series; some are prereleases (early for a few repositories), some unpackaged."""
    e = table(spark, d, "events")
    obs = e.select(F.col("event_type").alias("source"), F.when(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"), "2024-01").otherwise("2024-W04").alias("series"), F.concat(F.lit("pkg:npm/%40fonts/f"), F.col("user_id").cast("string")).alias("key"), (F.col("event_id") % 3 == 0).alias("prerelease"), F.col("user_id").alias("repo"), F.lit(None).cast("string").alias("base"), (F.col("event_id") % 5 != 0).alias("packaged"), F.lit(None).cast("string").alias("method"), "event_id", "event_type")
    return corrections.selected(obs, "view", "YYYY-MM", ["@fonts"], list(range(20))).select("event_id", "event_type")


@query("""with o as (select o_custkey, o_orderkey, coalesce(case when o_orderkey % 5 > 0 then o_orderdate::date end, o_orderdate::date - 400) s from orders), r as (select *, row_number() over (partition by o_custkey order by s desc, o_orderkey desc) n from o),
 m as (select max(o_orderdate::date) - 730 c from orders) select o_custkey as repo, o_orderkey as release, 'latest24' as mode from r where n <= 24 union all select o_custkey, o_orderkey, '24months' from o, m where s >= c""")
def release_history(spark, d):
    """Orders as releases, of which one in five has no day of publication, only a start."""
    day, k = F.to_date("o_orderdate"), F.col("o_orderkey")
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("repo"), k.alias("release"), F.when(k % 5 > 0, day).alias("published"), F.date_sub(day, 400).alias("start"), day.alias("end"))
    modes = [corrections.release_history(o, m).select("repo", "release", F.lit(m).alias("mode")) for m in ("latest24", "24months")]
    return modes[0].unionByName(modes[1])


@query("""with v as (select c_custkey k, c_nationkey g, c_acctbal x, min(o_orderdate::date) s, date '1998-07-01' e from customer left join orders on o_custkey = c_custkey group by all), t as (select *, g < 10 and (s is null or (year(e) - year(s)) * 12 + month(e) - month(s) + 1 >= 60) long from v), f as (select coalesce(quantile_cont(x, 0.1), 0) fl from t where long and x > 0)
 select k, round(case when long and x > 0 then greatest(x - fl, 0) else x end, 6) above from t, f""")
def tenured_floor(spark, d):
    """Customers of ten nations as a group; those with five years since their first order, or without one, lose the floor."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("g"), F.col("c_acctbal").alias("x"))
    first = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.min(F.to_date("o_orderdate")).alias("s"))
    v = c.join(first, "k", "left").withColumn("e", F.to_date(F.lit("1998-07-01")))
    members = v.where("g < 10").select(F.col("k").alias("member"), F.lit(None).cast("date").alias("joined"))
    return corrections.tenured_floor(v, members, "k", "x", "s", "e", 60, 0.1).select("k", F.round("above", 6).alias("above"))


@query(sql(""", f as (select s.source, u.family from (select distinct source from obs) s, (select distinct family from obs where day >= date '2024-01-28') u)
 select source, family, case when t.x is null then 'censored:no_value' else 'observed' end state from f full join (select * from terms where x > 60) t using (source, family)""", "obs", "terms"))
def frame_completion(spark, d):
    obs = observations(spark, d)
    recent = obs.where("day >= date'2024-01-28'").select("family").distinct()
    frame = recent.join(F.broadcast(obs.select("source").distinct()))  # sources are few
    return corrections.framed(terms(spark, d).where("x > 60").withColumn("state", F.lit("observed")), frame, ["source", "family"]).select("source", "family", "state")


@query(sql(""", a as (select source, family from terms where source = 'click' and x < 100), v as (select unnest(['chosen', 'installed']) as view) select view, source, t.family from terms t, v where not (view = 'chosen' and exists (select 1 from a where a.source = t.source and a.family = t.family))""", "terms"))
def view_assembly(spark, d):
    t = terms(spark, d)
    views = spark.createDataFrame([("chosen",), ("installed",)], "view string")
    every = t.join(F.broadcast(views))  # two views
    return corrections.without_abstaining(every, t.where("source = 'click' and x < 100"), ["chosen"], "family").select("view", "source", "family")


@query(sql(""", a as (select source, family, case when family % 2 = 0 then 'preinstalled' else 'dependency' end why, 0.9 share from terms where source = 'click' and x < 120), s as (select source, family, round(x / 1000, 6) share from terms where source in ('click', 'view')),
 f as (select a.*, case why when 'preinstalled' then 'pre-' else 'dep-' end || source || '-' || family as c from a), g as (select f.*, case when family % 3 = 0 then 'overruled' when family % 3 = 1 then 'accepted' else 'new' end st from f),
 r as (select source, family, share, case when share >= 0.2 then 'dependency' when share >= 0.1 then 'review' end kind from s where share >= 0.1 and not exists (select 1 from g where g.source = s.source and g.family = s.family and not (why = 'preinstalled' and st = 'overruled')))
 select c as "case", why kind, source, family, share, st status from g union all
 select case kind when 'dependency' then 'dep-' else 'rev-' end || source || '-' || family, kind, source, family, share, case when family % 3 = 0 then 'overruled' when family % 3 = 1 then 'accepted' else 'new' end from r""", "terms"))
def case_build(spark, d):
    """Abstentions of both kinds and shares on both sides of both thresholds, with rulings that accept and overrule."""
    t = terms(spark, d)
    a = t.where("source = 'click' and x < 120").select("source", "family", F.when(F.col("family") % 2 == 0, "preinstalled").otherwise("dependency").alias("why"), F.lit(0.9).alias("share"))
    shares = t.where("source in ('click', 'view')").withColumn("share", F.col("x") / 1000)
    case = F.explode(F.array(*[F.concat(F.lit(p), "source", F.lit("-"), F.col("family").cast("string")) for p in ("pre-", "dep-", "rev-")]))
    rulings = t.where("family % 3 < 2").select(case.alias("case"), F.when(F.col("family") % 3 == 0, "b").otherwise("a").alias("answer")).distinct()
    return corrections.cases(a, shares, t, rulings, 0.2, 0.1, "family")


@query("""with n as (select distinct p_name || case p_size % 8 when 0 then ' Condensed' when 1 then ' Extra Narrow' when 2 then ' semi-compressed' when 3 then ' black' when 4 then 'black' when 5 then ' UltraCondensed' else '' end k from part),
 p as (select k, lower(regexp_replace(k, '\\s+((semi|extra|ultra)[\\s-]?)?(condensed|narrow|compressed)$|\\s+black$', '', 'i')) f from n) select p.k, n.k parent from p join n on p.f = lower(n.k) where p.f <> lower(p.k) and p.f <> ''""")
def width_parents(spark, d):
    """Part names with widths behind them, in all ways of writing; 'xblack' is no width."""
    ends = F.array(*[F.lit(x) for x in (" Condensed", " Extra Narrow", " semi-compressed", " black", "black", " UltraCondensed", "", "")])
    k = F.concat("p_name", F.get(ends, F.col("p_size") % 8))
    return corrections.width_parents(table(spark, d, "part").select(k.alias("k")).distinct(), "k", F.lower)


@query("""with a as (select l_partkey f, list(distinct l_suppkey) r from lineitem where l_returnflag = 'A' group by 1), b as (select l_partkey f, list(distinct l_suppkey) r from lineitem where l_returnflag = 'R' group by 1) select a.f, list_has_any(a.r, b.r) same from a join b using (f)""")
def repository_match(spark, d):
    li = table(spark, d, "lineitem")
    side = lambda v: li.where(F.col("l_returnflag") == v).groupBy(F.col("l_partkey").alias("f")).agg(F.collect_set("l_suppkey").alias("r"))
    return corrections.shares_repository(side("A"), side("R"), "f", "r")


@query("select c_custkey family, coalesce(round(sum(o_totalprice), 2), 0) as count from customer left join orders on o_custkey = c_custkey and o_orderstatus = 'O' group by 1")
def ruler_sums(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_custkey").alias("family"), F.col("o_totalprice").alias("x"))
    return corrections.ruler_counts(o, "family", "x", table(spark, d, "customer").select(F.col("c_custkey").alias("family"))).withColumn("count", F.round("count", 2))


@query(sql("select case when family < 75 then 'one' else 'two' end as view, source, case when x < 100 then 'censored' else 'observed' end state, count(*) n from terms group by all", "terms"))
def state_counts(spark, d):
    return corrections.state_counts(states(spark, d).withColumn("view", F.when(F.col("family") < 75, "one").otherwise("two")), "view")


@query("select o_orderkey, (1998 - year(o_orderdate)) * 12 + 7 - month(o_orderdate) + 1 as months, round(o_totalprice, 2) as value from orders")
def months_inclusive(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", corrections.months_between(F.to_date("o_orderdate"), F.to_date(F.lit("1998-07-15"))).cast("long").alias("months"), F.round("o_totalprice", 2).alias("value"))


@query("select o_custkey k, round(sum(case when o_orderstatus <> 'P' then o_totalprice end), 2) as value, min(o_orderdate::date) as start, max(o_orderdate::date) as \"end\" from orders group by 1")
def plain_counts(spark, d):
    """Orders in process have no value; a customer with such orders alone has none."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("x"), F.to_date("o_orderdate").alias("day"))
    return corrections.plain_counts(o, ["k"], "x", "day", "day").withColumn("value", F.round("value", 2))


@query("with e as (select o_orderpriority s, o_custkey o, o_orderdate::date d from orders) select o as member, min(d) as joined from e where s = '1-URGENT' group by 1")
def group_membership(spark, d):
    o = table(spark, d, "orders")
    edges = o.select(F.lit("group").alias("kind"), F.col("o_orderpriority").alias("subject"), F.col("o_custkey").cast("string").alias("object"), F.to_date("o_orderdate").alias("first_seen"))
    return corrections.group_members(edges, "1-URGENT").select(F.col("member").cast("long").alias("member"), "joined")


# --- licences ----------------------------------------------------------------------------------------------

#: Spellings of the example's sources, and what they come to by hand.
SPELLINGS = {"mit license": "MIT", "ofl": "OFL-1.1", "apache 2": "Apache-2.0", "deb::expat": "MIT", "custom": "NOASSERTION"}
RAW = [("deb", "Expat", "MIT"), ("arch", "Expat", None), ("deb", "OFL or (MIT License and ofl)", "(MIT AND OFL-1.1) OR OFL-1.1"), ("arch", "custom and ofl", "NOASSERTION"), ("arch", " Apache  2 ", "Apache-2.0"), ("deb", "Font exception", None)]
_RAW = "(values " + ", ".join(f"({i}, '{s}', '{r}', {'null' if e is None else repr(e)})" for i, (s, r, e) in enumerate(RAW)) + ") t(i, source, raw, expression)"


@query(f"select p_partkey, source, raw, expression from part join {_RAW} on p_partkey % {len(RAW)} = i")
def license_normalize(spark, d):
    pick = (F.col("p_partkey") % len(RAW)).cast("int")
    p = table(spark, d, "part").select("p_partkey", *[F.get(F.array(*[F.lit(r[k]) for r in RAW]), pick).alias(n) for k, n in enumerate(("source", "raw"))])
    return licences.with_normalized(p, "raw", "source", SPELLINGS).select("p_partkey", "source", "raw", "expression")


@query("""with f as (select l_partkey fam, case l_returnflag when 'A' then 'deb' when 'N' then 'arch' else 'gr' end s, case when l_linestatus = 'F' and l_returnflag = 'A' then 'MIT' when l_returnflag = 'N' then 'OFL-1.1' when l_linestatus = 'O' then 'MIT' end e from lineitem),
 s as (select fam, s, case when count(distinct e) = 2 then 'MIT AND OFL-1.1' else any_value(e) end x from f where e is not null group by all), a as (select fam, count(*) filter (where e is null) unreadable from f group by 1),
 b as (select fam, arg_min(x, case s when 'gr' then 1 when 'arch' then 2 else 3 end) e, count(distinct x) > 1 dis from s group by 1)
 select fam, e as expression, case when e is null then 'ruling' else 'allowed' end status, case when e is null then '' when e like '%OFL%' then 'open-font' else 'permissive' end grp, coalesce(dis, false) disagreement, unreadable from a left join b using (fam)""")
def license_crosscheck(spark, d):
    li = table(spark, d, "lineitem")
    flag, line = F.col("l_returnflag"), F.col("l_linestatus")
    facts = li.select(F.col("l_partkey").alias("fam"), F.when(flag == "A", "deb").when(flag == "N", "arch").otherwise("gr").alias("s"), F.when((line == "F") & (flag == "A"), "MIT").when(flag == "N", "OFL-1.1").when(line == "O", "MIT").alias("e"))
    known = {"MIT": licences.Entry("allowed", "permissive"), "OFL-1.1": licences.Entry("allowed", "open-font")}
    return licences.cross_checked(facts, "fam", "s", "e", ["gr", "arch", "deb"], known)


@query("""select doc_id, list_filter(['apache', 'gpl', 'lgpl', 'mit'], lambda x: case x when 'mit' then contains(t, ' mit license ') when 'apache' then contains(t, ' apache license ') when 'lgpl' then contains(t, ' lesser general public license ') else contains(replace(t, ' lesser general public license ', ' # '), ' general public license ') end) as found from (select doc_id, ' ' || trim(regexp_replace(lower(text || case doc_id % 3 when 0 then ' GNU Lesser General Public License' when 1 then ' the general public license' else '' end), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' as t from documents)""")
def license_mentions(spark, d):
    """Texts that end in a longer licence name, in a shorter one that stands inside it, or in neither."""
    more = F.when(F.col("doc_id") % 3 == 0, " GNU Lesser General Public License").when(F.col("doc_id") % 3 == 1, " the general public license").otherwise("")
    return table(spark, d, "documents").select("doc_id", licences.mentions(F.concat("text", more), {"mit": "mit license", "gpl": "general public license", "apache": "apache license", "lgpl": "lesser general public license"}).alias("found"))


# --- links -------------------------------------------------------------------------------------------------


@query("""with u as (select page_id, url, lower(split_part(url, '://', 1)) as s, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') as h, split_part(split_part(regexp_extract(url, '://[^/?#]*(.*)', 1), '#', 1), '?', 1) as p, split_part(split_part(url, '#', 1), '?', 2) as q from pages)
 select page_id, list_filter([case when s <> 'https' then 'not https' end, case when h like 'm.%' then 'an aggregator' end], lambda x: x is not null) as problems, h || regexp_replace(p, '/+$', '') || case when q <> '' then '?' || q else '' end as target,
 case when q <> '' then split_part(split_part(url, '#', 1), '?', 1) || '?' || array_to_string(list_sort(string_split(q, '&')), '&') else split_part(split_part(url, '#', 1), '?', 1) end as ordered from u""")
def link_targets(spark, d):
    """Pages' addresses under a policy by which mobile hosts are aggregators."""
    pages = table(spark, d, "pages").select("page_id", "url")
    host = links.bare_host(F.col("url"))
    plain = links.problems(F.col("url"), [])
    every = F.when(host.startswith("m."), F.array_append(plain, F.lit("an aggregator"))).otherwise(plain)
    return pages.select("page_id", every.alias("problems"), links.target(F.col("url"), ["github.com"]).alias("target"), links.sorted_query(F.col("url")).alias("ordered"))


@query("""with l as (select l_partkey f, l_suppkey k, case when l_linestatus = 'F' then 'homepage' else 'repository' end kind, l_returnflag s from lineitem), b as (select f, k, count(distinct s) n, bool_or(s = 'R') t, min(kind) kind from l group by all),
 r as (select *, row_number() over (partition by f order by n desc, kind <> 'homepage', k) i from b) select f, k as link, n, kind, t or n >= 2 as accepted from r where i = 1""")
def link_choice(spark, d):
    li = table(spark, d, "lineitem").select(F.col("l_partkey").alias("f"), F.col("l_suppkey").alias("k"), F.when(F.col("l_linestatus") == "F", "homepage").otherwise("repository").alias("kind"), F.col("l_returnflag").alias("s"))
    return links.choice(li, "f", "s", "k", "kind", ["R"])


# --- checks and flags --------------------------------------------------------------------------------------


@query(sql(""", bad as (select distinct family from obs where source = 'error' and value > 150),
 ps as (select source, family, case when source = 'view' and family % 7 > 0 or source = 'click' and family % 5 = 0 then null else x / sum(x) filter (where source <> 'view' and not (source = 'click' and family % 5 = 0)) over (partition by family) * (case when family % 11 = 0 then 1.1 else 1 end) end s from terms)
 select 'ineligible_ranked' as "check", family::varchar family, 'terms' as what from terms join bad using (family) group by family union all
 select 'ineligible_ranked', family::varchar, 'ruler' from counts join bad using (family) union all
 select 'alias_target', k::varchar, b from (select p_partkey k, p_brand b from part) where b not in (select p_brand from part where p_size > 49) union all
 select 'private_share', family::varchar, 'view' from ps where source = 'view' and s is not null union all
 select 'private_share', family::varchar, round(sum(s), 6)::varchar from ps where source <> 'view' group by family having count(s) > 0 and abs(sum(s) - 1) > count(s) * 0.01 union all
 select 'fot_only_ranked', family::varchar, 'view' from (select family from terms where x >= 200 group by 1 having count(*) = 1 and max(source) = 'view') union all
 select 'raw_value_published', r, count(distinct v) || ' values' from (select distinct 'r' || o.family % 5 r, h.v from (select family, floor(x) v from terms where source = 'error' and x > 100 union select family, ceil(x) from terms where source = 'error' and x > 100) h
  join (select family, floor(x + family % 3) v from terms where source = 'error' union select family, ceil(x + family % 3) from terms where source = 'error') o on o.v = h.v and contains('font' || o.family || ';', 'font' || h.family || ';')) group by r union all
 select 'rerun_differs', family::varchar, case when family % 2 = 0 then 'changed' else 'gone' end from terms where source = 'click' and x > 250""", "obs", "terms", "counts"))
def hard_checks(spark, d):
    """Several checks over tables with planted faults, as one table of failures."""
    t, c = terms(spark, d), counts(spark, d)
    bad = observations(spark, d).where("source = 'error' and value > 150").select("family").distinct()
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("b"))
    known = table(spark, d, "part").where("p_size > 49").select(F.col("p_brand").alias("b"))
    stated = t.where("x >= 200").withColumn("state", F.lit("observed"))
    clicks = t.where("source = 'click'")
    again = clicks.where("not (x > 250 and family % 2 = 1)").withColumn("x", F.when(F.col("x") > 250, F.col("x") + 1).otherwise(F.col("x")))
    # Shares of which some are null, some carry a private source, and some don't sum to 1.
    unknown = ((F.col("source") == "view") & (F.col("family") % 7 > 0)) | ((F.col("source") == "click") & (F.col("family") % 5 == 0))
    open_ = t.where((F.col("source") != "view") & ~unknown).groupBy("family").agg(F.sum("x").alias("_sum"))
    shares = t.join(open_, "family", "left").withColumn("s", F.when(~unknown, F.col("x") / F.col("_sum") * F.when(F.col("family") % 11 == 0, 1.1).otherwise(1.0)))
    # Five reports, a line by font; values that were moved are not the hidden ones.
    errors, label = t.where("source = 'error'"), F.concat(F.lit("font"), F.col("family").cast("string"), F.lit(";"))
    line = F.concat(F.lit("| Font"), F.col("family").cast("string"), F.lit("; | "), F.format_number(F.col("x") + F.col("family") % 3, 2), F.lit(" |"))
    reports = errors.groupBy(F.concat(F.lit("r"), (F.col("family") % 5).cast("string")).alias("report")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("text"))
    return checks.run({
        "ineligible_ranked": lambda: checks.ineligible_ranked(bad, {"terms": t, "ruler": c}, "family"),
        "alias_target": lambda: checks.subset(part, known, ["b"], "alias_target", "k"),
        "private_share": lambda: checks.share_sums(shares, "family", "source", "s", ["view"], 2),
        "fot_only_ranked": lambda: checks.single_source_ranked(stated, stated.select("family").distinct(), "view", "family"),
        "raw_value_published": lambda: checks.raw_published(reports, errors.where("x > 100").select(F.col("x").alias("value"), label.alias("label"))),
        "rerun_differs": lambda: checks.rerun_differs(clicks, again, ["source", "family"], "family"),
    })


@query(sql(""", a as (select source, family, x from terms where source in ('click', 'view')), c as (select source, family, case when source = 'view' and x > 250 then x + 1 else x end x from a where not (source = 'click' and x < 100) and not (source = 'view' and x < 50))
 select 'desktop_views_differ' as "check", a.family::varchar family, a.source || ':' || case when c.family is null then 'missing' else 'other evidence' end as what from a left join c on a.source = c.source and a.family = c.family where (c.family is null and a.source <> 'click') or c.x <> a.x""", "terms"))
def desktop_views_differ(spark, d):
    a = terms(spark, d).where("source in ('click', 'view')").withColumn("state", F.lit("observed"))
    c = a.where("not (source = 'click' and x < 100) and not (source = 'view' and x < 50)").withColumn("x", F.when((F.col("source") == "view") & (F.col("x") > 250), F.col("x") + 1).otherwise(F.col("x")))
    return checks.views_differ(c, a, ["click"], "family")


@query(sql(""", p as (select source, family, x score, case when family < 20 then x + 1 when family % 3 = 0 and family % 2 = 0 then null else x end previous from terms), l as (select source, family, x score from terms where family % 3 <> 0)
 select 'previous_score' as "check", p.family::varchar family, coalesce(previous::varchar, 'null') what from p left join l using (source, family) where previous is distinct from (case when source = 'error' then p.score else l.score end)""", "terms"))
def previous_scores(spark, d):
    """Last scores of two thirds of the families; one rank's method has changed."""
    t = terms(spark, d).withColumnRenamed("x", "score")
    kept = F.when(F.col("family") < 20, F.col("score") + 1).when(F.col("family") % 6 == 0, None).otherwise(F.col("score"))
    return checks.previous_differs(t.withColumn("previous", kept), t.where("family % 3 <> 0"), spark.createDataFrame([("error",)], "source string"), ["source", "family"], "family")


@query(sql(""", w as (select family, source, row_number() over (partition by source order by x desc, family) p from terms where source in ('click', 'view')), b as (select family from w where source = 'click' and p <= 40), n as (select family from w where source = 'view' and p <= 40)
 select coalesce(b.family, n.family) family, case when b.family is null then 'entry' else 'exit' end flag, w.p as place from b full join n on b.family = n.family left join w on w.source = 'view' and w.family = coalesce(b.family, n.family) where b.family is null or n.family is null""", "terms"))
def member_flags(spark, d):
    o = row_numbers(terms(spark, d).where("source in ('click', 'view')"), ["source"], "x", [F.desc("x"), "family"], falling=True)
    side = lambda s: o.where(F.col("source") == s).select("family", "place")
    state = lambda s: side(s).select("family", (F.col("place") <= 40).alias("member"))
    return checks.member_flags(state("click"), state("view"), side("view"), "family")


@query("""with o as (select o_custkey k, arg_max(o_orderstatus, o_orderkey) st, arg_max(o_orderpriority, o_orderkey) pr from orders where o_orderdate < timestamp '1997-01-01' group by 1), n as (select o_custkey k, arg_max(o_orderstatus, o_orderkey) st, arg_max(o_orderpriority, o_orderkey) pr from orders where o_orderdate >= timestamp '1997-01-01' group by 1)
 select k, list_filter([case when o.st <> n.st then 'st' end, case when o.pr <> n.pr then 'pr' end], lambda x: x is not null) changed from o join n using (k) where o.st <> n.st or o.pr <> n.pr""")
def changed_flags(spark, d):
    o = table(spark, d, "orders")
    early = F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz")
    last = lambda df: df.groupBy(F.col("o_custkey").alias("k")).agg(F.max_by("o_orderstatus", "o_orderkey").alias("st"), F.max_by("o_orderpriority", "o_orderkey").alias("pr"))
    return checks.changed_flags(last(o.where(early)), last(o.where(~early)), "k", ["st", "pr"])


@query(sql(", l as (select source, max(day) as day from obs where value > 200 group by 1) select source, date_diff('day', day, date '2024-02-20') age, case when date_diff('day', day, date '2024-02-20') > 22 then 'dropped' else 'stale' end flag from l where day < date '2024-02-20'", "obs"))
def stale_flags(spark, d):
    last = observations(spark, d).where("value > 200").groupBy("source").agg(F.max("day").alias("day"))
    return checks.stale_flags(last, F.to_date(F.lit("2024-02-20")), 22).withColumn("age", F.col("age").cast("long"))


@query(sql(", o as (select source, count(*) n from terms join counts using (family) group by 1) select source, n, greatest(500 - n, 0) short from o where n < 500", "terms", "counts"))
def overlap_flags(spark, d):
    n = terms(spark, d).join(counts(spark, d).select("family"), "family", "left_semi").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return checks.overlap_flags(n, 500)


@query("""with n as (select o_orderpriority || o_orderstatus p, sum(o_totalprice) x from orders where year(o_orderdate) = 1996 group by 1), b as (select o_orderpriority || o_orderstatus p, sum(o_totalprice) x from orders where year(o_orderdate) = 1998 group by 1) select p, round(n.x / b.x - 1, 6) growth from n join b using (p) where n.x > 1.2 * b.x""")
def growth_flags(spark, d):
    o = table(spark, d, "orders").withColumn("p", F.concat("o_orderpriority", "o_orderstatus"))
    year = lambda y: o.where(F.year("o_orderdate") == y).groupBy("p").agg(F.sum("o_totalprice").alias("x"))
    return checks.growth_flags(year(1996), year(1998), "p", "x")


@query(sql(", r as (select source, family, row_number() over (partition by source order by x desc, family) n, count(*) over (partition by source) c from terms where x > 100) select source, family, n, greatest(c - 7, 0) n_more from r where n <= 7", "terms"))
def flag_report(spark, d):
    """The report's length (7) is the operator's."""
    return checks.report(terms(spark, d).where("x > 100"), "source", [F.desc("x"), "family"], 7).select("source", "family", F.col("n").cast("long").alias("n"), F.col("n_more").cast("long").alias("n_more"))


@query(sql(", n as (select count(*) filter (where source = 'click' and x > 100) a, count(*) filter (where source = 'view' and x > 100) b from terms) select a n_before, b n_now, abs(b - a)::double / a as change from n", "terms"))
def coverage_change(spark, d):
    t = terms(spark, d).where("x > 100")
    return checks.coverage_change(t.where("source = 'click'"), t.where("source = 'view'"), "x")
