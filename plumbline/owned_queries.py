"""Queries of matching lists of names with a catalog, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.operators import owned
from plumbline.queries import query
from plumbline.session import table

#: Ends of names in the example, by the row's number: styles with and without words of degree, patched and variable builds.
ENDS = ("", " Bold", " Extra Light", " Bold Italic", " NF", " Nerd Font Mono", " Semi", " Variable", " Bold NF", " Black")
_ENDS = "[" + ", ".join(f"'{e}'" for e in ENDS) + "]"
#: What is left of each end as units go, with whether a build of it is patched (the whole name comes first).
_CUTS = "[[], ['0'], ['0'], [' Bold', '0'], ['0p'], ['0p'], [], ['0'], [' Boldp', '0p'], ['0']]"
_CHAINS = f"""nm as (select *, {_ENDS}[(n % 10 + 1)::int] tail, {_CUTS}[(n % 10 + 1)::int] cuts from src), ch as (select *, replace(lower(base || case when tail = ' Nerd Font Mono' then ' NF' else tail end), ' ', '') k0,
  list_prepend(struct_pack(key := replace(lower(base || case when tail = ' Nerd Font Mono' then ' NF' else tail end), ' ', ''), patched := false), list_transform(cuts, lambda c: struct_pack(key := replace(lower(base || replace(replace(c, '0', ''), 'p', '')), ' ', ''), patched := contains(c, 'p')))) as chain from nm)"""


def _named(df, number: str, base: str):
    tail = F.get(F.array(*[F.lit(e) for e in ENDS]), (F.col(number) % 10).cast("int"))
    return F.concat(F.col(base), tail)


def _fold(c):
    return F.regexp_replace(F.lower(c), " ", "")


@query(f"with src as (select p_partkey n, p_name base from part), {_CHAINS} select n as p_partkey, list_transform(chain, lambda c: c.key || case when c.patched then '*' else '' end) keys from ch")
def owned_chains(spark, d):
    """Part names with style words behind them, and all that is left of them unit by unit."""
    p = table(spark, d, "part")
    c = owned.chain(_named(p, "p_partkey", "p_name"), _fold)
    return p.select("p_partkey", F.transform(c, lambda x: F.concat(x["key"], F.when(x["patched"], "*").otherwise(""))).alias("keys"))


_CODES = """codes as (select replace(lower(p_name), ' ', '') as key, case when p_partkey % 7 < 5 then p_brand end family, case p_partkey % 5 when 0 then 'f' when 1 then 'r' when 2 then 'b' when 3 then 's' else 'l' end letter, p_partkey % 7 = 5 known, case when p_partkey % 7 = 6 then 'icons' end reason from part where p_size <= 12),
 amb as (select distinct replace(lower(p_name), ' ', '') as key, p_brand family from part where p_size = 50)"""
_FOUND = f"""with src as (select l_orderkey * 10 + l_linenumber n, p_name base, l_orderkey, l_linenumber from lineitem join part on p_partkey = l_partkey), {_CHAINS}, {_CODES},
 t as (select l_orderkey entry, l_linenumber place, base || tail shown, l_linenumber = 1 and l_orderkey % 2 = 0 trusted, unnest(chain) c, unnest(range(len(chain))) turn from ch),
 h as (select entry, min(struct_pack(place := place, turn := turn, key := c.key, patched := c.patched, trusted := trusted, shown := shown)) z from t where c.key in (select key from codes) group by 1),
 r as (select entry, z.key as key, z.patched patched, z.trusted trusted, z.shown shown, exists (select 1 from amb where amb.key = z.key) and not z.trusted doubt from h),
 f as (select entry, shown, family, case when patched and letter in ('f', 'r', 'p', 'b') then 'n' else letter end l, doubt from r join codes using (key) where family is not null),
 o as (select entry, shown, family, case when l in ('s', 'l', 'u') then 'near' when doubt then 'near' else 'owned' end o, case l when 's' then 'sibling' when 'l' then 'related' when 'u' then 'bundle' else case when doubt then 'ambiguous' else case l when 'f' then 'family' when 'r' then 'rename' when 'b' then 'build' else 'patched' end end end w from f
  union all select entry, shown, amb.family, 'near', 'ambiguous' from r join amb using (key) where doubt or (exists (select 1 from codes c where c.key = r.key and c.family is null and c.known) and not exists (select 1 from codes c where c.key = r.key and c.family is not null))),
 rk as (select *, list_position(['family', 'rename', 'postscript', 'build', 'patched', 'ambiguous', 'sibling', 'related', 'bundle'], w) + case when o = 'owned' then 0 else 100 end k from o), b as (select entry, family, min(struct_pack(k := k, o := o, w := w, shown := shown)) z from rk group by all),
 al as (select entry, z.o outcome, family, z.w why from b union all select entry, case when kn then 'known' when re <> '' then 'ineligible' else 'unknown' end, null, case when not kn and re <> '' then re end from (select entry, bool_or(coalesce(c.known, false)) kn, coalesce(string_agg(distinct c.reason, '+'), '') re from r join codes c on c.key = r.key where entry not in (select entry from b) group by 1)
  union all select distinct l_orderkey, 'unknown', null, null from ch where l_orderkey not in (select entry from r))"""


def _matched(spark, d, how):
    """how (outcomes or families) on the orders; chains are made of the distinct names alone."""
    p = table(spark, d, "part")
    li = table(spark, d, "lineitem").join(p.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("base")), "l_partkey").withColumn("n", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    name = _named(li, "n", "base")
    tries = li.select(F.col("l_orderkey").alias("entry"), F.col("l_linenumber").alias("place"), name.alias("name"), ((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 2 == 0)).alias("trusted"))
    chains = tries.select("name").distinct().select("name", owned.chain(F.col("name"), _fold).alias("chain"))
    k = F.col("p_partkey")
    letter = F.when(k % 5 == 0, "f").when(k % 5 == 1, "r").when(k % 5 == 2, "b").when(k % 5 == 3, "s").otherwise("l")
    codes = p.where("p_size <= 12").select(_fold(F.col("p_name")).alias("key"), F.when(k % 7 < 5, F.col("p_brand")).alias("family"), letter.alias("letter"), (k % 7 == 5).alias("known"), F.when(k % 7 == 6, "icons").alias("reason"))
    doubts = p.where("p_size = 50").select(_fold(F.col("p_name")).alias("key"), F.col("p_brand").alias("family")).distinct()
    return how(tries, codes, doubts, chains=chains)


@query(_FOUND + " select entry, outcome, family, why from al")
def owned_outcomes(spark, d):
    """Orders as entries of a list, their lines as names in order, matched with some of the parts."""
    return _matched(spark, d, owned.outcomes).select("entry", "outcome", "family", "why")


@query(_FOUND + " select family, min(struct_pack(k := list_position(['family', 'rename', 'postscript', 'build', 'patched', 'ambiguous', 'sibling', 'related', 'bundle'], why) + case when outcome = 'owned' then 0 else 100 end, o := outcome, w := why)).o outcome, min(struct_pack(k := list_position(['family', 'rename', 'postscript', 'build', 'patched', 'ambiguous', 'sibling', 'related', 'bundle'], why) + case when outcome = 'owned' then 0 else 100 end, o := outcome, w := why)).w why from al where family is not null group by 1")
def owned_families(spark, d):
    return _matched(spark, d, owned.families).select("family", "outcome", "why")


_NAMES = f"""with src as (select p_partkey n, case when p_partkey % 3 = 0 then split_part(p_name, ' ', 1) else p_name end base, p_brand from part), {_CHAINS}, ho as (select distinct k0 as key, p_brand family from ch)"""


def _names(spark, d):
    p = table(spark, d, "part").withColumn("base", F.when(F.col("p_partkey") % 3 == 0, F.split("p_name", " ")[0]).otherwise(F.col("p_name")))
    name = _named(p, "p_partkey", "base")
    return p.select(F.col("p_brand").alias("family"), name.alias("name"), owned.chain(name, _fold).alias("chain"))


@query(_NAMES + """, fo as (select distinct base || tail as name, k0, unnest(chain[2:]) c, unnest(range(len(chain) - 1)) turn from ch), me as (select name, k0, min(struct_pack(t := turn, r := c.key)) z from fo where c.key in (select key from ho) group by all)
 select name, k0 as key, z.r reached, ho.family, ho.family in (select p_brand from part where p_size < 3) listed from me join ho on ho.key = z.r where not exists (select 1 from ho o where o.key = me.k0 and o.family = ho.family)""")
def name_collisions(spark, d):
    """Names whose shorter forms are other brands' names."""
    return owned.collisions(_names(spark, d), table(spark, d, "part").where("p_size < 3").select(F.col("p_brand").alias("family")))


@query(_NAMES + """, pa as (select distinct a.p_brand family, b.p_brand other from part a join part b on a.p_partkey + 1 = b.p_partkey where a.p_brand <> b.p_brand), bo as (select family, other from pa union select other, family from pa), al as (select distinct p_brand family, base || tail as name, unnest(chain).key as key from ch)
 select al.family, other, name, key from al join bo using (family) where exists (select 1 from ho where ho.key = al.key and ho.family = bo.other)""")
def name_meetings(spark, d):
    """Brands of neighbouring parts as pairs that must never meet, and the names by which they do."""
    n, p = _names(spark, d), table(spark, d, "part").select("p_partkey", "p_brand")
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_brand").alias("other"))
    pairs = p.join(nxt, "p_partkey").where("p_brand <> other").select(F.col("p_brand").alias("family"), "other").distinct()
    own = n.select(F.get("chain", F.lit(0))["key"].alias("key"), "family").distinct()
    return owned.meetings(n, pairs, own)
