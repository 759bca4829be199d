"""The trie of conversations against one that is built turn by turn."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from plumbline.llm import prefix_trie
from plumbline.llm.prefix_trie import conversation_trie, least_of, nearest


def built(rows):
    """Nodes by walking every prefix of every conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    convs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    nodes = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    kids = {}
    for p in nodes:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    out = set()
    for p, members in nodes.items():
        todo, leaves, saved = [p], 0, 0
        while todo:
            x = todo.pop()
            leaves += x not in kids
            saved += (len(nodes[x]) - 1) * len(x[-1][1].encode()) if x else 0
            todo += kids.get(x, [])
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(p))))
        out.add((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    assert len(out) == len({(x[0], x[1]) for x in out})
    return out


@pytest.mark.parametrize("seed,classes,blocks", [(1, 256, 4096), (2, 1, 4096), (3, 2, 4096), (4, 1, 7)])
def test_random_conversations(spark, monkeypatch, seed, classes, blocks):
    monkeypatch.setattr(prefix_trie, "CLASSES", classes)
    monkeypatch.setattr(prefix_trie, "BLOCKS", blocks)
    monkeypatch.setattr(prefix_trie, "PIECE", 2)
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(400), 120):
        n = r.choice([1, 2, 3, 5, 9, 12, 40])
        rows += [(c, t if t or r.random() < 0.5 else None, r.choice(["user", "user", "assistant", None]), r.choice(["", None, "a", "é" * 3, "b"])) for t in range(n)]
    # Copies of one conversation, an extension of it, an empty role beside a null one, rows without an id.
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1060) for t in range(12)] + [(1061, t, "user", f"same {t}") for t in range(14)]
    rows += [(None, 0, "user", "x"), (None, 1, None, None)]
    r.shuffle(rows)
    df = spark.createDataFrame([(*x, 7, "clash") for x in rows], "conv_id long, turn long, role string, text string, n long, j string")
    got = [tuple(x) for x in conversation_trie(df).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()]
    assert len(got) == len(set(got)) and set(got) == built(rows)


def test_one_conversation_turnless_ones_and_none(spark):
    schema = "conv_id long, turn long, role string, text string"
    for rows in ([(10, 0, "user", "x")], [(c, 0, None, None) for c in range(1, 30) if c % 5], [(5, k, "user", "y" * 70_000) for k in range(300)]):
        got = {tuple(x) for x in conversation_trie(spark.createDataFrame(rows, schema)).collect()}
        assert got == built(rows)
    assert conversation_trie(spark.createDataFrame([(None, 1, "a", "b")], schema)).count() == 0


def test_nearest_smaller_and_least_values():
    r = random.Random(9)
    for _ in range(200):
        v = np.array([r.randrange(6) for _ in range(r.randrange(1, 30))])
        left, right = nearest(v)
        for k, x in enumerate(v):
            assert left[k] == max([i for i in range(k) if v[i] < x], default=-1)
            assert right[k] == min([i for i in range(k + 1, len(v)) if v[i] < x], default=len(v))
        spans = np.array([(a, b) for a in range(len(v)) for b in range(a + 1, len(v) + 1)])
        assert least_of(v, spans[:, 0], spans[:, 1]).tolist() == [min(v[a:b]) for a, b in spans]
