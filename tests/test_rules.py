"""Rules of the ranking operators on small inputs whose results are worked out by hand."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from plumbline.functions import text
from plumbline.operators import counting, entities, licences, lists, scoring, timeseries
from plumbline.sources import records

DAY = datetime.date(2026, 10, 1)
OLD = datetime.date(2026, 9, 1)


def places(spark, verdicts, top):
    df = spark.createDataFrame([(i, float(-i), v) for i, v in enumerate(verdicts)], "f int, s double, ok boolean")
    return [(r["f"], r["rank"], r["gate_held"]) for r in scoring.placed(df, "s", [F.desc("s"), "f"], "ok", top).orderBy("place").collect()]


def test_failures_move_just_behind_the_top(spark):
    assert places(spark, [True, False, True, False, True, False], 3) == [(0, 1, False), (2, 2, False), (4, 3, False), (1, None, True), (3, None, False), (5, None, False)]


def test_held_are_the_failing_ones_within_the_first_places_only(spark):
    assert places(spark, [False, False, False, True, True], 2) == [(3, 1, False), (4, 2, False), (0, None, True), (1, None, True), (2, None, False)]


def test_a_top_that_is_never_full(spark):
    assert places(spark, [False, True, False, None], 3) == [(1, 1, False), (0, None, True), (2, None, True), (3, None, False)]
    assert places(spark, [False, False], 5) == [(0, None, True), (1, None, True)]


def test_capped_share_keeps_the_whole(spark):
    rows = [("w1", "startups", 5231.0), ("w1", "other", 5234.0), ("w2", "startups", 7.0), ("w3", "other", 7.0), ("w4", "startups", 1.0), ("w4", "other", 9.0)]
    got = {(r["w"], r["c"]): r["factor"] for r in counting.capped_share(spark.createDataFrame(rows, "w string, c string, x double"), "w", "c", "startups", "x", 0.25).collect()}
    assert got["w1", "startups"] == pytest.approx(0.25 * 10465 / 5231) and got["w1", "other"] == pytest.approx(0.75 * 10465 / 5234)
    assert {v for (w, _), v in got.items() if w != "w1"} == {1.0}


def test_history_starts_at_one_month_and_rests_without_data(spark):
    prev = spark.createDataFrame([("a", "x", [0.1, 0.2]), ("a", "gone", [0.5, 0.0]), ("b", "y", [0.3])], "s string, k string, history array<double>")
    now = spark.createDataFrame([("a", "x", 0.4), ("a", "new", 0.6)], "s string, k string, share double")
    got = {(r["s"], r["k"]): r["history"] for r in timeseries.history(prev, now, "s", "k", "share", 2).collect()}
    assert got == {("a", "x"): [0.2, 0.4], ("a", "new"): [0.6], ("b", "y"): [0.3]}


def test_rising_counts_missing_months_as_nothing(spark):
    shares = spark.createDataFrame([("s", "x", 1, 0.1), ("s", "x", 4, 0.4), ("s", "y", 4, 0.6), ("s", "z", 1, 0.9)], "s string, k string, m int, share double")
    own = timeseries.histories(shares, "s", "k", "m", "share", 12)
    assert {r["k"]: r["history"] for r in own.collect()} == {"x": [0.1, 0.0, 0.0, 0.4], "y": [0.6], "z": [0.9, 0.0, 0.0, 0.0]}
    got = {r["k"]: r["ratio"] for r in timeseries.rising(own, ["s", "k"]).collect()}
    assert got == {"x": pytest.approx(math.log((0.4 / 3) / (0.5 / 4)))}


def states(spark, rows):
    return spark.createDataFrame(rows, "id string, member boolean, entered date, runs_outside int")


def turn(spark, orders, state, first=500, kept=None):
    o = spark.createDataFrame(orders, "id string, place int")
    k = spark.createDataFrame([(x,) for x in kept], "id string") if kept else None
    out = timeseries.hysteresis(o, states(spark, state), [], "id", 450, 550, 2, first, F.lit(DAY), k)
    return {r["id"]: (r["member"], r["entered"], r["runs_outside"]) for r in out.collect()}


def test_hysteresis(spark):
    got = turn(spark, [("stays", 550), ("out", 551), ("again", 600), ("in", 450), ("not", 451), ("back", 500)], [("stays", True, OLD, 1), ("out", True, OLD, 0), ("again", True, OLD, 1), ("unranked", True, OLD, 0), ("back", False, OLD, 2)])
    assert got == {"stays": (True, OLD, 0), "out": (True, OLD, 1), "again": (False, OLD, 2), "unranked": (True, OLD, 1), "in": (True, DAY, 0)}


def test_hysteresis_first_run_and_kept(spark):
    assert turn(spark, [("a", 500), ("b", 501)], []) == {"a": (True, DAY, 0)}
    assert turn(spark, [("m", 900), ("k", 900)], [("m", True, OLD, 1)], kept=["m", "k", "new"]) == {"m": (True, OLD, 0), "k": (True, DAY, 0), "new": (True, DAY, 0)}


def test_excluded_leave_at_once(spark):
    state = states(spark, [("a", True, OLD, 0), ("b", True, OLD, 1), ("c", False, OLD, 2), ("d", False, OLD, 2)])
    got = {tuple(r) for r in timeseries.excluded(state, spark.createDataFrame([("a",), ("c",)], "id string"), "id").collect()}
    assert got == {("a", False, OLD, 0), ("b", True, OLD, 1), ("d", False, OLD, 2)}


def test_tier(spark):
    rows = [(10, 20, 2, "A"), (11, 20, 2, "B"), (30, 100, 2, "A"), (31, 100, 2, "B"), (10, 20, 1, "B"), (21, 20, 3, "C")]
    df = spark.createDataFrame(rows, "w int, r int, g int, want string").select(lists.tier(F.col("w"), F.col("r"), F.col("g")).alias("got"), "want")
    assert all(r["got"] == r["want"] for r in df.collect())


def mint(names, taken):
    used, out = set(taken), {}
    for n in sorted(names):
        base = text.ascii_of(n)
        base = "-".join(w for w in "".join(c if c.isascii() and c.isalnum() else " " for c in base).split()) or "family"
        k = 1
        while (base if k == 1 else f"{base}-{k}") in used:
            k += 1
        out[n] = base if k == 1 else f"{base}-{k}"
        used.add(out[n])
    return out


@pytest.mark.parametrize("taken", [[], ["a", "b-2", "family", "z-7"]])
def test_ids_are_minted_in_order(spark, taken):
    names = ["a", "A", "A 2", "A-2-2", "Łódź Sans 3", "lodz sans 3", "漢字", "かな", "b", "B", "b!", "C 02", "c", "Z", "z 7"]
    used = spark.createDataFrame([(t,) for t in taken], "id string") if taken else None
    got = entities.ids_minted(spark.createDataFrame([(n,) for n in names], "name string"), "name", text.slug(F.col("name")), used).collect()
    assert {r["name"]: r["id"] for r in got} == mint(names, taken)


def test_keys_drop_all_dashes_and_joiners():
    for dash in "-­‐‑‒–—−﹣－_​‍⁠﻿  　":
        assert text.match_key_of(f"Source{dash}Sans") == "sourcesans"
    assert text.match_key_of("ΣΑΣ") == "σασ" and text.search_key_of("Éclair") == "eclair"


def test_rbo_of_empty_lists(spark):
    some, none = spark.createDataFrame([(1, 1), (2, 2)], "id int, r int"), spark.createDataFrame([], "id int, r int")
    assert lists.rank_biased_overlap(none, none, "id", "r").first()["rbo"] == 1.0
    assert lists.rank_biased_overlap(some, none, "id", "r").first()["rbo"] == 0.0


def test_asset_base_and_repository(spark):
    df = spark.createDataFrame([("dir/FiraCode-v3.1.zip", None, "O/R/x"), ("Hack.tar.xz", "Own/Repo", "x"), ("a.tar.gz", "", "x/y")], "n string, r string, k string")
    got = [tuple(r) for r in df.select(records.asset_base(F.col("n")), records.repository(F.col("r"), F.col("k"))).collect()]
    assert got == [("FiraCode-v3.1", "o/r"), ("Hack", "own/repo"), ("a.tar.gz", "")]


def test_relation_groups(spark):
    df = spark.createDataFrame([("p", "a (>= 1) | b:any | a, (x), c [amd64]\n, ")], "p string, v string")
    assert {tuple(r) for r in records.relation_groups(df, "v", ["p"]).collect()} == {("p", 0, 0, "a"), ("p", 0, 1, "b"), ("p", 1, 0, "c")}


def test_malformed_stanza_is_an_error(spark):
    ok = spark.createDataFrame([("A: 1\nB: x\n y\n\nA: 2\n",)], "t string")
    assert [r["fields"] for r in records.stanzas(ok, "t", []).collect()] == [{"a": "1", "b": "x\ny"}, {"a": "2"}]
    with pytest.raises(Exception, match="not a field"):
        records.stanzas(spark.createDataFrame([("A: 1\nno field",)], "t string"), "t", []).collect()


def test_blocking_aliases_leave_a_key_unmatched(spark):
    al = spark.createDataFrame([("k1", "f", "direct"), ("k2", "f", "sibling"), ("k3", None, "ineligible"), ("k4", "other", "direct")], "k string, family string, rel string")
    rec = spark.createDataFrame([(f"k{i}",) for i in range(1, 6)], "k string")
    got = {r["k"]: (r["family"], r["resolution"]) for r in entities.resolved(rec, al, ["k"], spark.createDataFrame([("f",)], "family string"), relation="rel").collect()}
    assert got == {"k1": ("f", "matched"), "k2": (None, "unmatched"), "k3": (None, "ineligible"), "k4": (None, "ineligible"), "k5": (None, "unmatched")}


def test_dominance_against_brute_force(spark):
    import random

    r = random.Random(4)
    for width in (2, 3):
        rows = [(k, "st"[k % 2], *[float(r.randint(0, 9)) for _ in range(width)], float(r.randint(0, 30))) for k in range(150)]
        names = ["x", "y", "z"][:width]
        df = spark.createDataFrame(rows, "k int, g string, " + ", ".join(f"{n} double" for n in names) + ", s double")
        want = {}
        for a in rows:
            over = [(b[-1], b[0]) for b in rows if b[1] == a[1] and b[-1] < a[-1] and all(p >= q for p, q in zip(b[2:-1], a[2:-1])) and b[2:-1] != a[2:-1]]
            if over:
                want[a[0]] = min(over)[1]
        assert {x["low"]: x["high"] for x in lists.dominance_violations(df, "k", "g", names, "s").collect()} == want


def test_licences():
    table = {"ofl": "OFL-1.1", "mit": "MIT", "x::mit": "Apache-2.0", "gpl + exception": "GPL-3.0-only WITH Font-exception-2.0"}
    assert licences.normalized_of("  OFL ", "s", table) == "OFL-1.1"
    assert licences.normalized_of("mit OR (ofl and MIT)", "s", table) == "(MIT AND OFL-1.1) OR MIT"
    assert licences.normalized_of("MIT", "x", table) == "Apache-2.0" and licences.normalized_of("unheard of", "s", table) is None
    assert licences.normalized_of("gpl + exception", "s", table) == "GPL-3.0-only WITH Font-exception-2.0"
    for text_, shown in (("B AND (A AND B)", "A AND B"), ("NOASSERTION AND A", "NOASSERTION"), ("NOASSERTION OR A", "A"), ("A OR (B OR A)", "A OR B")):
        assert licences.shown(licences.simplified(licences.parsed(text_))) == shown
    for bad in ("", "(A", "A)", "A B", "A WITH", "(A OR B) WITH C", "AND A", "A WITH B WITH C"):
        with pytest.raises(ValueError):
            licences.parsed(bad)


def test_licence_sources_are_compared(spark):
    table = {"MIT": licences.Entry("allowed", "permissive"), "OFL-1.1": licences.Entry("allowed", "open-font")}
    rows = [("a", "s1", "MIT"), ("a", "s2", "OFL-1.1"), ("b", "s2", "MIT"), ("b", "s2", "NOASSERTION"), ("b", "s1", "OFL-1.1"), ("c", "s1", None), ("d", "s1", "Foo"), ("d", "s2", "Bar"), ("e", "s2", "MIT"), ("e", "s2", "OFL-1.1")]
    got = {r["f"]: (r["expression"], r["status"], r["disagreement"], r["unreadable"]) for r in licences.cross_checked(spark.createDataFrame(rows, "f string, s string, e string"), "f", "s", "e", ["s2", "s1"], table).collect()}
    assert got == {"a": ("OFL-1.1", "allowed", True, 0), "b": ("OFL-1.1", "allowed", False, 0), "c": (None, "ruling", False, 1), "d": ("Bar", "excluded", False, 0), "e": ("MIT AND OFL-1.1", "allowed", False, 0)}


def test_licence_texts_without_notices_are_equal(spark):
    a = "SIL OPEN FONT LICENSE\nCopyright 2019 The X Authors\nwith Reserved Font Name Y.\n\nPREAMBLE\nThe goals of the Open Font License are.\n2) To be free."
    b = "﻿copyright (c) 2020 others\r\nPreamble -- the goals of the open  font license are\r\n(a) to be FREE"
    df = spark.createDataFrame([(a,), (b,), (b + " not",)], "t string").select(licences.text_print(F.col("t")).alias("p"))
    one, two, three = (r["p"] for r in df.collect())
    assert one == two != three


def test_licence_texts_by_their_words(spark):
    body = "permission is hereby granted to organize & license this on non-commercial terms; the copyright holder keeps it."
    same = [
        body, "Title\n" + body.replace("organize", "ORGANISE").replace("license", "licence"), body.replace("&", "and"), body.replace("non-commercial", "noncommercial"), body.replace("holder", "owner"),
        body.replace("terms", "terms (https://a.b/c) example.org/x"), "© 2001 Foo\nCopyright by Foo\nCopyright: [years]\nportions copyright 1999 Bar\nDigitized data copyright (c) 2012-2018 Z\n" + body, body.replace("; the", ";\n iv. the"), body.replace("; the", ";\n* (b) the"), body + "\nReserved Font Name Foo.",
    ]
    other = [body + " Copyright notices stay.", body.replace("; the", ";\ncopyright law applies; the"), body.replace("; the", ";\nabc. the"), body + "\nReserved Font Name refers to it", body + " a.organ"]
    prints = [r["p"] for r in spark.createDataFrame([(t,) for t in same + other], "t string").select(licences.text_print(F.col("t")).alias("p")).collect()]
    assert len(set(prints[: len(same)])) == 1 and len(set(prints)) == 1 + len(other)


def test_longest_licence_name_wins(spark):
    phrases = {"gpl": "general public license", "lgpl": "lesser general public license", "mit": "mit license"}
    rows = ["GNU Lesser General Public License", "the General Public License", "lesser general public license or general public license", "MIT-license", None, ""]
    got = [r["f"] for r in spark.createDataFrame([(t,) for t in rows], "t string").select(licences.mentions(F.col("t"), phrases).alias("f")).collect()]
    assert got[:4] == [["lgpl"], ["gpl"], ["gpl", "lgpl"], ["mit"]] and got[5] == []
    assert spark.createDataFrame([("may not be sold by itself. No resale",)], "t string").select(licences.restrictions(F.col("t"), ["no resale", "not be sold", "old by"])).first()[0] == ["no resale", "not be sold"]


def test_asset_keys_have_no_versions(spark):
    rows = [("JetBrainsMono-2.304.zip", "v2.304", "JetBrainsMono.zip"), ("Fira_Code_v6.2.zip", "6.2", "Fira_Code.zip"), ("Hack-v3.003-ttf.zip", "v3.003", "Hack-ttf.zip"), ("MapleMono-TTF.zip", "latest", "MapleMono-TTF.zip"), ("Inter-3f174fcef6.zip", "nightly", "Inter.zip"), ("Inter-abcdefab.zip", "x", "Inter-abcdefab.zip"), ("1.1.0.zip", "@a/b@1.1.0", "1.1.0.zip"), ("Font2-7.zip", "r7", "Font2.zip"), ("a_1_2_3.tar.gz", "9", "a.tar.gz"), ("Plain", None, "Plain")]
    got = [r["k"] for r in spark.createDataFrame([x[:2] for x in rows], "n string, t string").select(records.asset_key(F.col("n"), F.col("t")).alias("k")).collect()]
    assert got == [x[2] for x in rows]


def test_names_of_series_and_releases_without_a_day(spark):
    from plumbline.operators import corrections

    rows = [("YYYY-MM", "2024-01", True), ("YYYY-MM", "2024-1", False), ("YYYY-MM", "2024-011", False), ("YYYY-MM", "2024-W1", False), ("x-YYYY-Www.y", "x-2024-W09.y", True), ("x-YYYY-Www.y", "x-2024-W09zy", False), ("30day", "30day", True), ("30day", "30days", False)]
    for series, name, want in rows:
        assert spark.createDataFrame([(name,)], "s string").select(corrections.of_series(F.col("s"), series)).first()[0] is want
    obs = spark.createDataFrame([("r", "a", "2024-05-01", "2024-01-01", "2024-06-01"), ("r", "b", None, "2024-01-01", "2024-06-01"), ("r", "c", None, "2021-01-01", "2021-06-01")], "repo string, release string, published string, start string, end string").selectExpr("repo", "release", "date(published) published", "date(start) start", "date(end) end")
    assert {r["release"] for r in corrections.release_history(obs, "24months").collect()} == {"a", "b"}
    assert corrections.release_history(obs, "latest24").count() == 3


def test_shares_and_previous_scores(spark):
    from plumbline.operators import checks

    shares = spark.createDataFrame([("a", "x", None), ("a", "y", 0.6), ("a", "z", 0.4), ("b", "x", 0.5), ("b", "y", 0.4), ("c", "p", 0.1), ("c", "y", 1.0), ("d", "x", None)], "f string, s string, v double")
    assert {(r["family"], r["what"]) for r in checks.share_sums(shares, "f", "s", "v", ["p"]).collect()} == {("b", "0.9"), ("c", "p")}
    now = spark.createDataFrame([("k", "a", 1.0, 2.0), ("k", "b", 1.0, None), ("k", "c", 1.0, 1.0), ("m", "a", 3.0, 3.0)], "k string, f string, score double, previous double")
    last = spark.createDataFrame([("k", "a", 2.0), ("m", "a", 9.0)], "k string, f string, score double")
    new = spark.createDataFrame([("m",)], "k string")
    assert [r["family"] for r in checks.previous_differs(now, last, new, ["k", "f"], "f").collect()] == ["c"]
    assert {r["family"] for r in checks.previous_differs(now, last.limit(0), new.limit(0), ["k", "f"], "f").collect()} == {"a", "b"}
    reports = spark.createDataFrame([("one", "| Foo Sans | 1,234.5 |\nBar 99"), ("two", "Foo Sans: 12345\nFoo Sans v1.1234"), ("three", None)], "report string, text string")
    hidden = spark.createDataFrame([(1234.0, "foo sans"), (99.0, "foo sans")], "value double, label string")
    assert [(r["family"], r["what"]) for r in checks.raw_published(reports, hidden).collect()] == [("one", "1 values")]


def test_prefix_sums_over_signs_and_sizes(spark):
    import random

    from plumbline.functions.kernel import running

    r = random.Random(1)
    xs = [r.choice([0.0, -1.5, 1e-9, -1e12, float("-inf"), float("inf"), r.uniform(-5, 5), 3.25]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(xs)), "k int, x double")
    up = {x["k"]: x["n"] for x in running(df, [], "x", ["x", "k"], {"n": F.lit(1)}).collect()}
    down = {x["k"]: x["n"] for x in running(df, [], "x", [F.desc("x"), "k"], {"n": F.lit(1)}, falling=True).collect()}
    assert [k for k, _ in sorted(up.items(), key=lambda t: t[1])] == sorted(range(400), key=lambda k: (xs[k], k))
    assert [k for k, _ in sorted(down.items(), key=lambda t: t[1])] == sorted(range(400), key=lambda k: (-xs[k], k))
