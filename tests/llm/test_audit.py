"""The filter audit against a plain walk through every order, document by document."""

import random
from itertools import permutations

from plumbline.llm.filter_audit import filter_audit

SPACE = " \t\n\x0b\x0c\r"


def words(t):
    out = [""]
    for c in t:
        if c in SPACE:
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def walked(docs, labels):
    rows = []
    for i, t, lang in docs:
        t = t or ""
        w = words(t)
        earlier = [j for j, u, _ in docs if j is not None and (u or "") == t]
        fails = {f for f, x in zip("ABCDE", [len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), any(c in "#$%&*|" for c in t), i is not None and min(earlier) < i], strict=True) if x}
        good, toxic = (any(x[0] == i and x[k] == 1 for x in labels) and i is not None for k in (1, 2))
        rows.append((lang or "", fails, good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                red = sum(f in r[1] for r in own) - len(gone)
                out[part, "".join(order), k + 1] = [len(left), len(gone), red, sum(r[1] == {f} for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                total[f] += len(gone)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                out[part, "".join(order), k + 1].append(total[f])
    return out


def test_metrics_match_a_walk_through_all_orders(spark):
    r = random.Random(3)
    texts = [None, "", " \n ", "a b c", "A" * 20, "word # word"] + [" ".join(r.choice(["x", "Y", "ü", f"w{r.randrange(400)}", "a|b", "\t\r"]) for _ in range(r.choice([5, 120, 200]))) for _ in range(10)]
    texts += [" ".join(f"w{k}" for k in range(150)), " ".join("αβ{}".format(k) for k in range(20000))]
    docs = [(r.choice([None, *range(30)]), r.choice(texts), r.choice([None, "", "en", "de"])) for _ in range(70)]
    labels = [(r.choice([None, *range(30)]), r.choice([0, 1, None]), r.choice([0, 1, None])) for _ in range(25)]
    df = spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, lang string, part string, mask int")
    got = filter_audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(x.part, x.filter_order, x.step): [x[n] for n in names] for x in got} == walked(docs, labels)
    assert len(got) == 600 * len({x.part for x in got})


def test_empty_table_gives_no_row(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
