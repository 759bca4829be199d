"""Operators and queries on the whole job, against brute force."""

import re

import pandas as pd
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import entities
from plumbline.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def components(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {(x, top(x)) for x in up}


def test_connected_on_a_path_of_more_than_40_rounds(spark):
    # 0 is next to the largest number, so that it used to walk the path one node a round.
    path = [0, *range(90, 0, -1)]
    edges = [*zip(path, path[1:]), (100, 101), (101, 102), (200, 200)]
    found = entities.connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert len(found) == 95 and {tuple(r) for r in found} == components(edges)


def test_connected_names_has_every_order(spark):
    orders = pd.read_parquet(f"{DATA}/orders.parquet")
    edges = list(zip(orders.o_custkey.tolist(), (-1 - orders.o_orderkey).tolist()))
    found = QUERIES["connected_names"](spark, DATA).collect()
    assert len(found) == orders.o_orderkey.nunique() + orders.o_custkey.nunique()
    assert {tuple(r) for r in found} == components(edges)


def ends(hop):
    out = set()
    for old in hop:
        at, steps, seen = old, 0, set()
        while at in hop and at not in seen:
            seen.add(at)
            at, steps = hop[at], steps + 1
        if at not in hop:
            out.add((old, at, steps))
    return out


def test_chains_of_any_length(spark):
    # 100 renames in a row, a branch into them, a name without an end that leads to a cycle, and the cycle.
    hop = {**{k: k + 1 for k in range(100)}, 200: 50, 300: 301, 301: 302, 302: 303, 303: 301, 400: 400}
    found = entities.chains(spark.createDataFrame(list(hop.items()), "old long, new long"), "old", "new").collect()
    assert len(found) == 101 and {tuple(r) for r in found} == ends(hop)


def test_rename_chains_has_every_name(spark):
    p = pd.read_parquet(f"{DATA}/part.parquet")
    found = QUERIES["rename_chains"](spark, DATA).select("old", "end", "steps").collect()
    assert {tuple(r) for r in found} == ends(dict(zip(p.p_partkey.tolist(), (p.p_partkey + p.p_size).tolist())))
    assert len(found) == p.p_partkey.nunique()


def test_ids_minted_with_whole_names(spark):
    suppliers = pd.read_parquet(f"{DATA}/supplier.parquet").s_name.unique().tolist()
    found = {tuple(r) for r in QUERIES["ids_minted"](spark, DATA).select("s_name", "id").collect()}
    assert found == {(s, re.sub("[^a-z0-9]+", "-", s.lower()).strip("-")) for s in suppliers}
    assert len(found) == len(suppliers)


def test_ids_minted_numbers_one_slug_over_tasks(spark):
    names = [f"Same{'_' * k}name" for k in range(1, 301)] + ["Other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    out = entities.ids_minted(df, "name", text.slug(F.col("name")))
    same = sorted(n for n in names if n != "Other")
    assert {tuple(r) for r in out.collect()} == {("Other", "other")} | {(n, "same-name" if k == 1 else f"same-name-{k}") for k, n in enumerate(same, 1)}


def test_match_keys_of_whole_texts(spark):
    docs = pd.read_parquet(f"{DATA}/documents.parquet").text
    found = QUERIES["match_keys"](spark, DATA).collect()
    assert sorted(r["name"] for r in found if r["name"] is not None) == sorted(docs.dropna().unique())
    assert all((r["match_key"], r["search_key"]) == (text.match_key_of(r["name"]), text.search_key_of(r["name"])) for r in found if r["name"] is not None)


def test_keyed_keeps_null(spark):
    found = {tuple(r) for r in text.keyed(spark.createDataFrame([("A b",), (None,)], "name string"), "name").collect()}
    assert found == {("A b", text.match_key_of("A b"), text.search_key_of("A b")), (None, None, None)}
