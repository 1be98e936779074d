"""Components against all-pairs brute force, over both the short-list and the cluster path."""

import random
import re

import numpy as np
import pytest

from heliopanel.llm import near_dedup as N
from heliopanel.llm.common import table
from tests.conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = {i: plain_set(t) for i, t in rows}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    holders = {}
    for i in ids:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for n, i in enumerate(ids):
        seen = {}
        for s in sets[i]:
            for j in holders[s]:
                if j < i:
                    seen[j] = seen.get(j, 0) + 1
        for j, c in seen.items():
            if N.linked(c, len(sets[i]), len(sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def result(docs):
    return sorted(map(tuple, N.near_duplicates(docs).collect()))


def test_given_documents(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert result(docs) == brute(rows)


@pytest.mark.parametrize("short", [True, False])
def test_groups_of_near_copies(spark, monkeypatch, short):
    monkeypatch.setattr(N, "LIST", 10_000 if short else 6)
    monkeypatch.setattr(N, "BLOCK", 16)
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(4))
    rows, at = [], 0
    for size, length, edits in ((60, 120, 5), (25, 40, 2), (40, 400, 30), (3, 7, 1)):
        base = [word() for _ in range(length)]
        for _ in range(size):
            w = list(base)
            for _ in range(r.randint(0, edits)):
                kind, i = r.random(), r.randrange(len(w))
                if kind < 0.5:
                    w[i] = word()
                elif kind < 0.75:
                    del w[i]
                else:
                    w.insert(i, word())
            if r.random() < 0.2:
                w = w[:len(w) * 3 // 4]
            rows.append((at, " ".join(w) if r.random() < 0.8 else "\n".join(w).upper()))
            at += 1
    shared = " ".join(word() for _ in range(60))
    for _ in range(40):
        rows.append((at, " ".join(word() for _ in range(30)) + " " + shared))
        at += 1
    r.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs) == brute(rows)


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(104)]       # 100 shingles
    near = words[:-8] + [f"x{i}" for i in range(8)]      # 92 of 108 shared: 0.8518
    far = words[:-9] + [f"y{i}" for i in range(9)]       # 91 of 109: 0.8348
    docs = spark.createDataFrame([(5, " ".join(words)), (3, " ".join(near)), (1, " ".join(far))], "doc_id long, text string")
    assert [(x[0], x[2]) for x in result(docs)] == [(1, 1), (3, 3), (5, 3)]


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "A b"), (5, "a  B"), (6, "a b c"), (6, "a b c"), (None, "a b"),
            (7, "v " * 300_000), (8, "V " * 200_000)]
    docs = spark.createDataFrame([(*x, "z") for x in rows], "doc_id long, text string, n_shingles string")
    got = sorted(map(tuple, N.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False),
                          (6, 1, 6, True), (6, 1, 6, True), (None, 1, None, True), (7, 1, 7, True), (8, 1, 7, False)], key=str)
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == 8
    assert N.near_duplicates(docs.limit(0)).count() == 0


def test_estimate_is_exact_for_small_sets():
    pad = np.uint64(2**64 - 1)
    a, b = np.full((1, N.K), pad), np.full((1, N.K), pad)
    a[0, :4], b[0, :3] = [1, 2, 3, 4], [2, 3, 9]
    assert N.estimate(a, b)[0] == 2 / 5


def test_ids_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i // 3) * 40 + k + (i % 3 == 2) * (k == 0)}" for k in range(60))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = result(docs)
    assert want == brute(rows)
    monkeypatch.setattr(N, "BROADCAST_IDS", 0)
    assert result(docs) == want and N.drop_near_duplicates(docs).count() == sum(x[3] for x in want)


def test_repeated_ids_with_different_texts(spark):
    words = [" ".join(f"w{n}x{i}" for i in range(40)) for n in range(6)]
    near = [w + " tail" for w in words]
    # id 10 has four texts: near id 20, near id 30, one of its own, and none; 5 follows by 30
    rows = [(10, words[0]), (10, words[1]), (10, words[2]), (10, None), (20, near[0]), (30, near[1]), (30, words[3]),
            (5, near[3]), (40, words[4]), (40, words[4]), (50, near[4]), (60, words[5]), (None, words[5]), (None, near[0]), (70, "")]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
        assert len(got) == len(rows)
        assert {(g["doc_id"], g["component_id"], g["kept"]) for g in got} == {
            (5, 5, True), (10, 5, False), (20, 5, False), (30, 5, False), (40, 40, True), (50, 40, False),
            (60, 60, True), (70, 70, True), (None, None, True)}
