"""Counts against a plain re-statement, sketches against exact quantiles, edges."""

import random
import re
from collections import Counter

import numpy as np

from heliopanel.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    inside = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)]


def texts():
    r = random.Random(1)
    alphabet = ["a", "b", "the", "é", "日", " ", " ", "\n", "\t", "\x0b", " ", " ", "#", "|", "\x1f", "<p>", "A"]
    return [None, "", " \n ", "x"] + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 300))) for _ in range(300)]


def test_counts_equal_plain():
    for t in texts():
        assert list(Q.measure((t or "").encode()))[:5] == plain(t or ""), t


def test_long_text_is_cut_at_white_space():
    text = ("word" * 700_000 + " ") + "a b c a b c " * 200_000
    assert list(Q.measure(text.encode()))[:5] == [1 + 1_200_000, 2_800_000 + 1_200_000, 0, 0, 1_200_000]


def test_verdicts_and_filter(spark):
    r = random.Random(2)
    rows = []
    for i in range(900):
        words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 9))) for _ in range(80)]
        if i % 30 == 0:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), "en" if i % 3 else None, "hot" if i % 4 else f"s{i % 40}", i))
    rows += [(900, None, "en", "hot", 0), (901, "", None, None, 0), (902, "short text", "xx", "new", 0),
             (3, rows[3][1], rows[3][2], rows[3][3], 3), (None, rows[4][1], "en", "hot", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words int")
    got = Q.verdicts(docs).collect()
    assert len(got) == len(rows)
    for g in got:
        text = next(t for i, t, *_ in rows if i == g["doc_id"]) or ""
        want = plain(text)
        assert [g[c] for c in Q.COUNTS[:5]] == want
        assert g["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert g["kept"] == (not g["base_failed"] and "%" not in text)
    kept = Q.quality_filter(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(g["kept"] for g in got)
    assert Q.verdicts(docs.limit(0)).count() == 0 and Q.quality_filter(docs.limit(0)).count() == 0


def test_salted_join_gives_the_same(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 97}" for k in range(60)) + " %" * (i % 50 == 0) * 60, "en", f"s{i % 3}")
            for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = sorted(map(tuple, Q.verdicts(docs).collect()))
    monkeypatch.setattr(Q, "BROADCAST_GROUPS", 0)
    assert sorted(map(tuple, Q.verdicts(docs).collect())) == want


def test_sketch_quantiles_are_close_and_mergeable(spark):
    values = np.random.default_rng(1).lognormal(1, 1, 4000)
    rows = [("en", f"s{i % 5}", 100, int(v * 100), 0, 0, 0, 1, 0) for i, v in enumerate(values)]
    counts = spark.createDataFrame(rows, "lang string, source string, n_words long, word_chars long, n_symbols long,"
                                         "n_dup_lines long, n_repeat_words long, n_lines long, n_upper long")
    merged = Q.merge(Q.sketches(counts), ["lang"])
    q = Q.quantiles(merged, ["lang"], {"q1": 0.25, "q3": 0.75}).where("signal = 'word_length'").first()
    exact = np.quantile([int(v * 100) / 100 for v in values], [0.25, 0.75])
    assert abs(q["q1"] / exact[0] - 1) < 0.03 and abs(q["q3"] / exact[1] - 1) < 0.03 and q["n_docs"] == 4000
