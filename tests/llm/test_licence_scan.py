"""The licence scan against brute force, with every template in one text, nulls, ties and repeated rows."""

import random
import re

import pytest

from plumbline.llm import licenses as L

SCHEMA = "doc_id long, text string"


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(rows):
    texts = [words_of(t) for _, t in rows]
    df = {}
    for ws in texts:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = []
    for (k, _), ws in zip(rows, texts, strict=True):
        starts, labels, share = [], set(), None
        for phrase, label in L.BASE.items():
            p = phrase.split()
            own = [i for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
            starts += own
            labels |= {label} if own else set()
        base = set(labels)
        for label, template, phrase in L.TEMPLATES:
            t, p = template.split(), phrase.split()
            index = sorted(dict.fromkeys(t), key=lambda w: (df.get(w, 0), w))
            index = set(index[: max(L.RARE_LEAST, len(index) // L.RARE_SHARE)])
            votes = {}
            for i, w in enumerate(ws):
                for at, x in enumerate(t):
                    if x == w and w in index:
                        votes.setdefault(i - at, set()).add(w)
            agree = max(map(len, votes.values()), default=0)
            if agree >= L.AGREE * len(index) and any(ws[i : i + len(p)] == p for i in range(len(ws) - len(p) + 1)):
                labels.add(label)
                share = max(share or 0, agree / len(index))
        score = share if share is not None else (1.0 if starts else 0.0)
        out.append((k, len(ws), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 9)))
    return sorted(out, key=repr)


def found(spark, rows):
    got = L.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9)) for r in got), key=repr)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    common = "the of and to in a is that for it as was license software permission public version free use copy general mit gnu apache cc by".split()
    rows = []
    for k in range(120):
        words = [r.choice(common) for _ in range(r.randint(0, 80))]
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            t = r.choice(L.TEMPLATES)[1].split()
            if r.random() < 0.4:
                t[r.randrange(len(t))] = "other"
            at = r.randint(0, len(words))
            words[at:at] = t
        rows.append((k, r.choice([" ", ", ", "-"]).join(w.upper() if r.random() < 0.2 else w for w in words)))
    rows += [(1, rows[1][1]), (None, "MIT License mit license"), (500, None), (501, ""), (502, " -- "), (503, "Größe Σ license é")]
    assert found(spark, rows) == expected(rows)


def test_all_templates_in_one_text(spark):
    rows = [(0, " xx ".join(t for _, t, _ in L.TEMPLATES)), *((k + 1, f"xx {t} yy") for k, (_, t, _) in enumerate(L.TEMPLATES))]
    got = {r[0]: r[6] for r in found(spark, rows)}
    assert got[0] == ",".join(sorted({label for label, _, _ in L.TEMPLATES}))
    assert all(label in got[k + 1].split(",") for k, (label, _, _) in enumerate(L.TEMPLATES))


def test_identifiers(spark):
    rows = [(1, "// SPDX-License-Identifier: GPL-2.0-only"), (2, "CC BY-SA 3.0"), (3, "SPDX-License-Identifier: LGPL-2.1"), (4, "the license of the software")]
    assert {r[0]: r[6] for r in found(spark, rows)} == {1: "gpl", 2: "cc-by-sa", 3: "lgpl", 4: ""}


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    df = spark.createDataFrame([(1, "mit license")], SCHEMA).selectExpr("*", "'x' as words", "'y' as row", "1 as template", "'z' as hits")
    assert [(r["doc_id"], r["base_labels"]) for r in L.scan(df).collect()] == [(1, "mit")]
