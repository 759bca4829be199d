"""Names and families: values worked out by hand."""

from plumbline.operators import aliases


def test_a_level_that_knows_a_name_decides(spark):
    families = spark.createDataFrame([("a", "x", "Foo", "foo", "foo"), ("b", "x", "FOO", "foo", "bar"), ("c", "y", "Baz", "baz", "bar"), ("d", "y", "Qux", "qux", "solo")], "family string, ns string, key string, key_match string, named_match string")
    names = spark.createDataFrame([("x", "Foo", "foo"), ("x", "fOO", "foo"), ("y", "BAZ", "baz"), ("z", "Bar", "bar"), ("z", "Solo", "solo"), ("z", "none", "none")], "ns string, name string, match_key string")
    got = {(r["ns"], r["name"]): r["family"] for r in aliases.resolved_names(names, families).collect()}
    assert got == {("x", "Foo"): "a", ("x", "fOO"): None, ("y", "BAZ"): "c", ("z", "Bar"): None, ("z", "Solo"): "d", ("z", "none"): None}


def test_competing_proposals_wait_and_agreeing_ones_follow(spark):
    rows = [(1, "k", "a", "accepted"), (2, "k", "b", "queued"), (3, "m", "a", "queued"), (4, "m", "a", "accepted"), (5, "m", "a", "accepted"), (6, "n", "a", "queued")]
    got = aliases.settled(spark.createDataFrame(rows, "id long, k string, family string, status string"), ["k"], "id")
    assert {r["id"]: (r["status"], r["reason"]) for r in got.collect()} == {1: ("queued", "competing"), 2: ("queued", "competing"), 3: ("known", ""), 4: ("accepted", ""), 5: ("known", ""), 6: ("queued", "")}


def test_blocks_forbid_a_key_or_all_that_hold_a_needle(spark):
    proposals = spark.createDataFrame([("k1", "foosans", "a"), ("k1", "foosans", "b"), ("k2", "foomono", "a"), ("k3", None, "a")], "k string, match_key string, family string")
    blocks = spark.createDataFrame([("k1", "b", None), (None, "a", "mono")], "k string, family string, needle string")
    assert {(r["k"], r["family"]) for r in aliases.unblocked(proposals, blocks, ["k"]).collect()} == {("k1", "a"), ("k3", "a")}


def test_relations_count_from_both_ends(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "a"), ("c", "a"), (None, "a"), ("a", None)], "a string, b string")
    assert {r["family"]: r["others"] for r in aliases.both_ways(edges, "a", "b").collect()} == {"a": ["b", "c"], "b": ["a"], "c": ["a"]}
