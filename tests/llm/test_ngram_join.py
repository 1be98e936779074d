"""The join against all pairs in plain Python, over short columns, hubs and blocks."""

import random
import re

import numpy as np
import pytest

from heliopanel.llm import ngram_join as J
from heliopanel.llm.common import table
from tests.conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_set(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def components(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain(rows):
    """rows: (doc_id, text); rows of one id are one document's texts."""
    sets = [plain_set(t) for _, t in rows]
    edges = []
    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            c = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (sets[i] and 100 * c >= 90 * (len(sets[i]) + len(sets[j]) - c)):
                edges.append((j, i))
    root = components(len(rows), edges)
    least = {}
    for (d, _), r in zip(rows, root):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), None if d is None else least[r]) for (d, _), s, r in zip(rows, sets, root)), key=repr)


def of(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as value", "'x' as cluster")
    return sorted((tuple(r) for r in J.components(df.repartition(parts), **kw).collect()), key=repr)


def near_copies(seed, groups, words=120):
    """Groups of copies with a few words changed, some of them beyond the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    rows = []
    for g, size in enumerate(groups):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 4, 6])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append(" ".join(text))
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


EDGES = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (905, "one two"), (906, "one two three"),
         (907, "one two three"), (None, "one two three"), (None, None), (908, "a b c d e f g h i j k l"), (909, "a b c d e f g h i j k l m")]


@pytest.mark.parametrize("sizes", [{}, {"list_size": 3, "block": 5}, {"list_size": 2, "block": 256}])
def test_against_all_pairs(spark, sizes):
    rows = near_copies(5, [40, 25, 3, 2, 1, 1, 1]) + EDGES
    want = plain(rows)
    assert of(spark, rows, **sizes) == want
    assert len({r[2] for r in want}) > 12


def test_template_rows_with_own_words(spark):
    rng = random.Random(2)
    base = [f"t{i}" for i in range(90)]
    rows = [(i, " ".join(base[:60] + [f"own{i}x{j}" for j in range(rng.choice([0, 3, 12]))] + base[60:])) for i in range(80)]
    assert of(spark, rows, list_size=4, block=16) == plain(rows)


def test_repeated_ids(spark):
    rows = near_copies(9, [6, 5, 1, 1])
    rows += [(rows[0][0], "quite another text of its own words"), (999, "quite another text of its own words"),
             (rows[0][0], rows[0][1]), (None, rows[0][1])]
    assert of(spark, rows) == plain(rows)


def test_one_long_text_and_an_empty_table(spark):
    rng = random.Random(3)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(200_000))
    assert of(spark, [(1, long), (2, long + " tail"), (3, "short")]) == [(1, 199_998, 1), (2, 199_999, 1), (3, 1, 3)]
    assert of(spark, []) == []


def test_forest_against_all_pairs():
    rng = np.random.default_rng(4)
    base = np.arange(1, 9001, dtype=np.uint64)
    sets = [np.sort(rng.choice(base, 9000 - int(rng.integers(0, 800)), replace=False)) for _ in range(30)]
    label = rng.integers(0, 4, 30)
    u, v = J._forest(np.arange(30), sets, label)
    edges = [(j, i) for i in range(30) for j in range(i) if label[i] != label[j]
             and J.linked(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]))]
    assert components(30, zip(u.tolist(), v.tolist())) == components(30, edges)
    assert len(u) < 30 and edges


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = plain(rows)
    assert sorted((tuple(r) for r in J.components(docs).collect()), key=repr) == want
    assert len({r[2] for r in want}) < len(rows)
