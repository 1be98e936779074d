"""The automaton against Python's ``re`` rule by rule, and the operator's edge cases."""

import hashlib
import random
import re

import pytest

from heliopanel.llm import secret_scan
from heliopanel.llm.automaton import Anchored, Combined, Rule, parse

ASSIGN = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def brute(text):
    out = []
    for kind, pattern, ok in (("assign", ASSIGN, lambda m: len(m[2]) >= 12),
                              ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
                              ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if ok(m)]
    order = ["assign", "access", "hex"]
    return sorted(out, key=lambda x: (x[0], order.index(x[1])))


def scanned(text, rules=secret_scan.BASE):
    machine = secret_scan.compiled(rules)
    data = text.encode()
    return [(s, rules[i].kind, e) for s, i, e in secret_scan._code_points(data, machine.spans(data))]


PIECES = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "=", ":", " ", "  ", '"', "'", "AKIA", "AKIA0",
          "0123456789abcdef", "deadbeef", "abc", "Z9", "==", "é", "日本", "\n", "pass", "tok", "key", "/+", ".", "x" * 12,
          "-", "ABCDEFGHIJKLMNOP", "eyJ", "A", "f"]


@pytest.mark.parametrize("seed", range(6))
def test_base_spans_equal_re(seed):
    r = random.Random(seed)
    for _ in range(1500):
        text = "".join(r.choice(PIECES) for _ in range(r.randint(0, 25)))
        assert scanned(text) == brute(text), text
        base = [x for x in scanned(text, secret_scan.RULES) if x[1] in ("assign", "access", "hex")]
        assert base == brute(text), text


def test_consumed_short_match_hides_a_later_one():
    text = "secret=token:abcdefghijklmnop"
    assert brute(text) == [] and scanned(text) == []


def test_more_rules():
    text = "a ghp_" + "a1B2" * 9 + " b -----BEGIN RSA PRIVATE KEY----- c eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM9 d"
    assert [k for _, k, _ in scanned(text, secret_scan.RULES)] == ["github", "pem", "jwt"]


def test_parser_against_re():
    r = random.Random(5)
    for pattern in ("(ab|a)c{2,3}d?", "[a-c]+x?(yz)*", "a{2}(b|cd){1,2}"):
        machine, ref = Anchored(parse(Rule("x", pattern))), re.compile(pattern)
        for _ in range(800):
            text = "".join(r.choice("abcdxyz") for _ in range(r.randint(0, 9)))
            want = max([n for n in range(len(text) + 1) if ref.fullmatch(text, 0, n)], default=-1)
            assert machine.longest(text.encode()) == want, (pattern, text)


def test_unsafe_rules_are_refused():
    with pytest.raises(ValueError):
        Combined([Rule("gap", "a(bc)*b")])
    with pytest.raises(ValueError):
        Combined([Rule("one", "a")])


def test_operator_edges(spark):
    key = "AKIA" + "Q" * 16
    rows = [(1, None, "x"), (2, "", "x"), (3, "é " + key, None), (3, "é " + key, None), (4, "z" * 300_000 + key, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(map(tuple, secret_scan.digest(secret_scan.find_secrets(docs)).collect()))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[0] == (1, 0, 0, 0, empty, "") and got[1] == (2, 0, 0, 0, empty, "")
    want = "access:2:22"
    assert got[2] == got[3] == (3, 0, 1, 0, hashlib.sha256(want.encode()).hexdigest(), want)
    assert got[4][5] == "access:300000:300020"
    clean = {r["doc_id"]: r for r in secret_scan.redact_secrets(docs).collect()}
    assert clean[1]["text"] is None and clean[3]["text"] == "é [access]" and clean[4]["text"].endswith("z[access]")
    assert clean[4]["spans"] == "y"
    assert secret_scan.find_secrets(docs.limit(0)).count() == 0
