"""The manifest against plain recursion over whole lists, over one, two and three tiers of blocks."""

import zlib
from hashlib import sha256

import numpy as np
import pytest

from heliopanel.llm import merkle as M
from heliopanel.llm.common import table
from tests.conftest import SF_SMALL


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def plain(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    groups = {}
    for d, text, lang, source, n in rows:
        leaf = h(*map(field, (d, source, lang, n, text)))
        other = None
        if d is not None and zlib.crc32(str(d).encode()) % 7 == 0 and n is not None:
            other = h(*map(field, (d, source, lang, n + 1, text)))
        groups.setdefault(lang, []).append(((d is not None, d or 0, leaf), leaf, other, d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[1] for x in sorted(groups[g], key=lambda x: x[0])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, leaf, other, d) in enumerate(sorted(groups[g], key=lambda x: x[0])):
            at, now, path = i, other or leaf, []
            for level in [*trees[g][:-1], None, *top[:-1]]:
                if level is None:
                    at = k
                    continue
                s = at ^ 1
                if s < len(level):
                    path.append(level[s])
                    now = h(level[s], now) if at & 1 else h(now, level[s])
                else:
                    now = h(now)
                at >>= 1
            out.append((d, leaf, trees[g][-1][0], top[-1][0], h(*path), now, now == top[-1][0]))
    return out


def of(spark, rows, extra="", bits=M.HEIGHT):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return [tuple(r) for r in M.tampering(df.selectExpr("*", *([extra] if extra else [])), bits).collect()]


def key(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("levels_", [1, 2, 3, 4, 7, 11])
def test_addresses_are_a_permutation_with_subtrees_together(levels_):
    all_ = np.concatenate([np.atleast_1d(M.address(levels_, d, np.arange(1 << d))) for d in range(levels_)])
    assert sorted(all_.tolist()) == list(range((1 << levels_) - 1))
    if levels_ > 1:
        top = levels_ // 2
        assert max(int(np.max(M.address(levels_, d, np.arange(1 << d)))) for d in range(top)) == (1 << top) - 2
        under = [M.address(levels_, top + d, np.arange(1 << d)) for d in range(levels_ - top)]
        ends = np.concatenate([np.atleast_1d(x) for x in under])
        assert ends.min() == (1 << top) - 1 and ends.max() - ends.min() == len(ends) - 1


@pytest.mark.parametrize("height", [1, 2, 10])
def test_against_plain_trees(spark, height):
    rows = [(i * 3, f"text {i} é", "en" if i % 5 else None, "s%d" % (i % 3), i if i % 4 else None) for i in range(37)]
    rows += [(5, None, "de", None, 7), (None, "no id", "de", "x", 1), (None, "no id", "de", "x", 1), (9, "", "fr", "y", 0),
             (5, "again", "de", None, 7), (5, "again", "de", None, 7), (14, "\U0001F600" * 50, "ünï", "a", 2**40)]
    assert key(of(spark, rows, bits=height)) == key(plain(rows))


def test_many_groups_of_one(spark):
    rows = [(i, "t", f"l{i % 23}", "s", 1) for i in range(24)]
    assert key(of(spark, rows, bits=2)) == key(plain(rows))


def test_one_row_empty_table_and_other_columns(spark):
    rows = [(1, "only", "en", "s", 4)]
    assert of(spark, rows, "1 as grp") == plain(rows)
    assert of(spark, []) == []
    assert of(spark, rows, "'x' as digest") == plain(rows)


def test_given_documents(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    assert key(tuple(r) for r in M.tampering(docs).collect()) == key(plain([tuple(r) for r in docs.collect()]))
