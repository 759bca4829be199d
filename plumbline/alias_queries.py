"""Queries of names and their families, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import aliases
from plumbline.plans.views import sql, terms
from plumbline.queries import query
from plumbline.session import table


@query("""with f as (select p_partkey family, p_brand ns, p_name as key, lower(p_name) km, lower(p_type) nm from part), n as (select p_partkey id, p_brand ns, case when p_size % 3 = 0 then p_name when p_size % 3 = 1 then upper(p_name) else p_type end as name from part),
 e as (select ns, key, max(family) x from f group by all), i as (select ns, km, case when count(distinct family) = 1 then max(family) end x from f group by all), s as (select nm, case when count(distinct family) = 1 then max(family) end x from f group by all)
 select id, case when e.x is not null then e.x when i.km is not null then i.x else s.x end family from n left join e on n.ns = e.ns and n.name = e.key left join i on n.ns = i.ns and lower(n.name) = i.km left join s on lower(n.name) = s.nm""")
def resolved_names(spark, d):
    """Parts as families with a brand as namespace; names are exact, in capitals, or the display name."""
    p = table(spark, d, "part")
    families = p.select(F.col("p_partkey").alias("family"), F.col("p_brand").alias("ns"), F.col("p_name").alias("key"), F.lower("p_name").alias("key_match"), F.lower("p_type").alias("named_match"))
    name = F.when(F.col("p_size") % 3 == 0, F.col("p_name")).when(F.col("p_size") % 3 == 1, F.upper("p_name")).otherwise(F.col("p_type"))
    names = p.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("ns"), name.alias("name")).withColumn("match_key", F.lower("name"))
    return aliases.resolved_names(names, families).select("id", "family")


@query("""with p as (select o_orderkey id, o_custkey k, o_orderpriority family, case when o_orderstatus = 'F' then 'accepted' else 'queued' end status from orders where o_orderdate::date >= date '1998-01-01'),
 g as (select k, count(distinct family) n, min(id) filter (where status = 'accepted') f from p group by 1)
 select id, case when n > 1 then 'queued' when f is null or f = id then status else 'known' end status, case when n > 1 then 'competing' else '' end reason from p join g using (k)""")
def settled_proposals(spark, d):
    o = table(spark, d, "orders").where(F.to_date("o_orderdate") >= "1998-01-01")
    status = F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("queued")
    p = o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("k"), F.col("o_orderpriority").alias("family"), status.alias("status"))
    return aliases.settled(p, ["k"], "id").select("id", "status", "reason")


@query("""with p as (select p_partkey k, lower(p_name) m, p_brand family from part), b as (select l_partkey k, p_brand family from lineitem join part on l_partkey = p_partkey where l_quantity >= 50),
 n as (select distinct p_brand family, lower(split_part(p_name, ' ', 1)) needle from part where p_size = 1)
 select k, family from p where not exists (select 1 from b where b.k = p.k and b.family = p.family) and not exists (select 1 from n where n.family = p.family and contains(p.m, n.needle))""")
def unblocked_proposals(spark, d):
    p = table(spark, d, "part")
    proposals = p.select(F.col("p_partkey").alias("k"), F.lower("p_name").alias("match_key"), F.col("p_brand").alias("family"))
    large = table(spark, d, "lineitem").where("l_quantity >= 50").select(F.col("l_partkey").alias("p_partkey")).distinct()
    exact = p.join(large, "p_partkey").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("family"), F.lit(None).cast("string").alias("needle"))
    needles = p.where("p_size = 1").select(F.lit(None).cast("long").alias("k"), F.col("p_brand").alias("family"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("needle"))
    return aliases.unblocked(proposals, exact.unionByName(needles), ["k"]).select("k", "family")


@query("""with e as (select c_nationkey a, s_nationkey b from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join supplier on l_suppkey = s_suppkey where l_quantity >= 50 and a <> b)
 select family, list_sort(list(distinct other)) others from (select a family, b other from e union all select b, a from e) group by 1""")
def related_both_ways(spark, d):
    items = table(spark, d, "lineitem").where("l_quantity >= 50").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    edges = items.join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return aliases.both_ways(edges.select("c_nationkey", "s_nationkey").distinct(), "c_nationkey", "s_nationkey")


@query(sql(", r as (select source, family, row_number() over (partition by source order by x desc, family) n from terms) select family from r where source = 'click' and n <= 70 union select family from r where source in ('view', 'purchase') and n <= 15 union select family from terms where source = 'signup' and x > 1100", "terms"))
def check_scope(spark, d):
    """Members are the families with a large value of one source."""
    from pyspark.sql import Window

    t = terms(spark, d)
    ranks = t.select(F.col("source").alias("key"), "family", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("x"), "family")).alias("order"))
    return aliases.check_scope(ranks, t.where("source = 'signup' and x > 1100"), "click", 70, ["view", "purchase"], 15)

#: An alias table of orders, families of brands: keys in one plain space and in two spaces of names.
_SPACES = ["gf", "foundry"]
_ROWS = """rows as (select case o_orderkey % 4 when 0 then 'npm' when 1 then 'gf' when 2 then 'foundry' else 'deb' end ns, lower(p_name) mk, case when o_orderkey % 11 = 0 then 'gone' else lower(p_brand) end family,
 case o_orderkey % 7 when 0 then 'bundle' when 1 then 'distinct' when 2 then 'ineligible' when 3 then 'package' when 4 then 'rename' else 'fold' end relation, (o_orderkey % 3)::varchar detail, o_orderkey % 7 = 1 and o_orderkey % 2 = 0 needle from orders join part on p_partkey = o_orderkey),
 r as (select ns, mk, case when relation = 'ineligible' then '' else family end family, relation, detail, needle from rows)"""
_KEYS = "keys as (select distinct lower(p_brand) family, case p_size % 3 when 0 then 'npm' when 1 then 'gf' else 'deb' end ns, lower(p_name) mk from part where p_size <= 20), names as (select distinct lower(p_brand) family, lower(p_type) mk from part where p_size > 40)"
_INDEX = f"""with {_ROWS}, {_KEYS}, fams as (select family from keys union select family from names), mp as (select * from r where relation in ('fold', 'rename', 'build', 'package', 'ineligible') and (family = '' or family in (select family from fams))),
 sp as (select unnest(['gf', 'foundry']) s), nm as (select family, mk from names union select family, mk from keys where ns in ('gf', 'foundry')),
 e as (select ns, mk, 0 lv, family, relation, detail, true own from mp union all select ns, mk, 1, family, 'direct', '', true from keys union all select 'npm', '@fontsource/' || mk, 1, family, 'package', 'fontsource', false from keys where ns = 'gf'
  union all select s, mk, 2, family, relation, detail, false from mp, sp where ns in ('gf', 'foundry') union all select s, mk, 3, family, 'direct', '', false from nm, sp),
 l as (select *, min(lv) over (partition by ns, mk) best from e), f as (select ns, mk, lv, count(distinct family) n, bool_or(own) own, min(struct_pack(o := list_position(['direct', 'fold', 'rename', 'build', 'package', 'ineligible'], relation), d := detail, f := family)) x from l where lv = best group by all),
 di as (select case when ns in ('gf', 'foundry') then 'name' else ns end ns, mk, family, needle from rows where relation = 'distinct'),
 idx as (select ns, mk, lv, n, x.f family, ['direct', 'fold', 'rename', 'build', 'package', 'ineligible'][x.o] relation, x.d detail, own, exists (select 1 from di where di.family = x.f and case when needle then contains(f.mk, di.mk) else di.mk = f.mk and di.ns = (case when f.ns in ('gf', 'foundry') then 'name' else f.ns end) end) no from f),
 ix as (select *, case when n > 1 then 'ambiguous' when no then case when lv = 0 or lv = 1 and own then 'violation' else 'left out' end else 'hit' end state from idx)"""


def _alias_rows(spark, d):
    k = F.col("o_orderkey")
    ns = F.when(k % 4 == 0, "npm").when(k % 4 == 1, "gf").when(k % 4 == 2, "foundry").otherwise("deb")
    relation = F.when(k % 7 == 0, "bundle").when(k % 7 == 1, "distinct").when(k % 7 == 2, "ineligible").when(k % 7 == 3, "package").when(k % 7 == 4, "rename").otherwise("fold")
    o = table(spark, d, "orders").join(table(spark, d, "part"), k == F.col("p_partkey"))
    return o.select(ns.alias("ns"), F.lower("p_name").alias("mk"), F.when(k % 11 == 0, "gone").otherwise(F.lower("p_brand")).alias("family"), relation.alias("relation"), (k % 3).cast("string").alias("detail"), ((k % 7 == 1) & (k % 2 == 0)).alias("needle"))


def _index(spark, d):
    p = table(spark, d, "part")
    ns = F.when(F.col("p_size") % 3 == 0, "npm").when(F.col("p_size") % 3 == 1, "gf").otherwise("deb")
    keys = p.where("p_size <= 20").select(F.lower("p_brand").alias("family"), ns.alias("ns"), F.lower("p_name").alias("mk")).distinct()
    names = p.where("p_size > 40").select(F.lower("p_brand").alias("family"), F.lower("p_type").alias("mk")).distinct()
    return aliases.alias_index(_alias_rows(spark, d), keys, names, _SPACES, [("@fontsource/", "gf", "fontsource")])


@query(_INDEX + " select ns, mk, lv as level, case when state <> 'ambiguous' then family end family, case when state <> 'ambiguous' then relation end relation, case when state <> 'ambiguous' then detail end detail, state from ix")
def alias_levels(spark, d):
    """Every key and name with the level that decides it."""
    return _index(spark, d)


_MERGED = _INDEX + """, c as (select l_orderkey * 8 + l_linenumber id, case l_suppkey % 3 when 0 then 'npm' when 1 then 'gf' else 'deb' end ns, lower(p_name) || case when l_linenumber % 2 = 0 then '' else ' ' || l_suppkey % 9 end mk, case when l_partkey % 13 > 0 then lower(p_brand) end family,
  case l_orderkey % 5 when 0 then 'distinct' when 1 then 'rename' else 'fold' end relation, 'mined' detail, case when l_orderkey % 3 > 0 then 'same-name' end as rule, case when l_orderkey % 5 = 1 then lower(p_type) end as current from lineitem join part on p_partkey = l_partkey),
 h as (select ns, mk, min(family) lo, max(family) hi from r where relation in ('fold', 'rename', 'build', 'package', 'ineligible') group by 1, 2), bu as (select ns, mk from r where relation = 'bundle' union select s, mk from r, sp where relation = 'bundle' and ns in ('gf', 'foundry')),
 a as (select c.*, ix.family hit, ix.lv, u.mk is not null unclear, bu.mk is not null bundled, h.lo, h.hi, c.relation in ('fold', 'rename') maps, exists (select 1 from di where di.family = c.family and case when needle then contains(c.mk, di.mk) else di.mk = c.mk and di.ns = (case when c.ns in ('gf', 'foundry') then 'name' else c.ns end) end) no,
  exists (select 1 from r where r.ns = c.ns and r.mk = c.mk and r.relation = c.relation and r.family = c.family) same from c left join ix on ix.ns = c.ns and ix.mk = c.mk and ix.state = 'hit' left join ix u on u.ns = c.ns and u.mk = c.mk and u.state = 'ambiguous' left join bu on bu.ns = c.ns and bu.mk = c.mk left join h on h.ns = c.ns and h.mk = c.mk),
 j as (select *, case when maps and bundled then 'blocked:bundle' when family is null then 'queued:no-family' when maps and no then 'blocked:distinct' when not maps then case when same then 'known:' else 'queued:review' end when hit = family then 'known:' when hit is null and unclear then 'queued:other-family'
  when hit is not null then case when lv in (0, 2) then 'queued:conflict' else 'queued:other-family' end when lo <> family or hi <> family then 'queued:conflict' when rule is null then 'queued:review' else 'accepted:' end st from a),
 g as (select ns, mk, count(distinct family) n, min(id) filter (where st = 'accepted:') f from j where maps and family is not null and st[1] in ('a', 'q') group by all),
 k as (select j.*, case when maps and family is not null and st[1] in ('a', 'q') and n > 1 then 'queued:competing' when maps and family is not null and st[1] in ('a', 'q') and f is not null and f <> id then 'known:' else st end s2 from j left join g on g.ns = j.ns and g.mk = j.mk),
 w as (select current, count(distinct family) n from k where s2 = 'accepted:' and current is not null group by 1), o as (select k.*, case when s2 = 'accepted:' and w.n > 1 then 'queued:competing' else s2 end s3 from k left join w on w.current = k.current)"""


def _merged(spark, d):
    li = table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    s, o = F.col("l_suppkey"), F.col("l_orderkey")
    c = li.select(
        (o * 8 + F.col("l_linenumber")).alias("id"), F.when(s % 3 == 0, "npm").when(s % 3 == 1, "gf").otherwise("deb").alias("ns"),
        F.concat(F.lower("p_name"), F.when(F.col("l_linenumber") % 2 == 0, "").otherwise(F.concat(F.lit(" "), (s % 9).cast("string")))).alias("mk"),
        F.when(F.col("l_partkey") % 13 > 0, F.lower("p_brand")).alias("family"), F.when(o % 5 == 0, "distinct").when(o % 5 == 1, "rename").otherwise("fold").alias("relation"),
        F.lit("mined").alias("detail"), F.when(o % 3 > 0, "same-name").alias("rule"), F.when(o % 5 == 1, F.lower("p_type")).alias("current"),
    )
    return aliases.merged(c, _alias_rows(spark, d), _index(spark, d), _SPACES)


@query(_MERGED + " select id, split_part(s3, ':', 1) status, split_part(s3, ':', 2) reason from o")
def alias_merge(spark, d):
    """Lines as mined proposals for the alias table of orders."""
    return _merged(spark, d).select("id", "status", "reason")


@query(_MERGED + " select ns, mk, family, relation, detail, split_part(s3, ':', 2) reason, count(*) n from o where s3[1] = 'q' group by all")
def alias_queue(spark, d):
    return aliases.queue(_merged(spark, d))
