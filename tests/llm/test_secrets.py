import hashlib
import re

import pytest
from pyspark.sql import functions as F

from bizops.llm.queries import QUERIES
from bizops.llm.secretscan import RULES, Rule, scan, trigram_query, vocabulary

KINDS = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def plain(text):
    spans = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(KINDS) for m in re.finditer(p, text or "", re.A) if ok(m)]
    return ",".join(f"{KINDS[k][0]}:{a}:{b}" for a, k, b in sorted(spans))


def listed(df):
    joined = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return [(r["doc_id"], r["s"]) for r in df.select("doc_id", joined.alias("s")).collect()]


def test_trigram_queries():
    assert trigram_query("AKIA[A-Z]+") == [{"aki", "kia"}]
    assert trigram_query("[0-9a-f]{24,}") is None and trigram_query("a*b?") is None
    assert {frozenset(x) for x in trigram_query("(?i:token|secret)=")} == {frozenset(x) for x in (
        {"tok", "oke", "ken", "en="}, {"sec", "ecr", "cre", "ret", "et="})}
    assert trigram_query("abc|x.z") is None  # one branch has no trigram
    assert trigram_query("abc.*wxyz") == [{"wxy", "xyz"}]
    assert sorted(map(sorted, trigram_query("ab?cde"))) == [["abc", "bcd", "cde"], ["acd", "cde"]]
    assert set(vocabulary(RULES)) >= {"pas", "aki", "tok", "pik", "pi_"}


@pytest.mark.parametrize("text", [
    "token=token : abcdefgh é password='x1234567' \U0001f600 TOKEN:abcdef1",
    "AKIAAKIA" + "A" * 20 + " AKIAABC " + "a1" * 12 + "g" + "f" * 23,
    "token==a password = = abcdefg api_key\"='aaaaaa apikey:zzzzzzz passwd:12345 PassWord : 123456",
    "token=abcdef" * 20, "a" * 24, "f" * 23, "tokem=abcdefg", "ſecret=abcdefg Kapi_Key=abcdefg",
])
def test_spans_against_plain_regex(make_docs, scratch, text):
    assert listed(scan(make_docs([(1, text)]), scratch)) == [(1, plain(text))]


def test_many_matches_in_one_text(make_docs, scratch):
    text = " ".join(f"Secret = {i:06d}x é" for i in range(3000))
    assert listed(scan(make_docs([(1, text)]), scratch)) == [(1, plain(text))]


def test_edge_cases(make_docs, edge_rows, scratch):
    rows = [*edge_rows, (20, "password=abcdef1"), (20, "nothing"), (None, "token=1234567")]
    got = sorted(listed(scan(make_docs(rows), scratch)), key=str)
    assert got == sorted(((i, plain(t)) for i, t in rows), key=str)
    assert scan(make_docs([]), scratch).count() == 0


def test_own_rules_and_full_scan(make_docs, scratch):
    rules = [Rule("digits", r"[0-9]{3,}"), Rule("card", r"card-([0-9]+)", 1, 4)]
    got = listed(scan(make_docs([(1, "card-12 card-1234 999")]), scratch, rules))
    assert got == [(1, "card:8:17,digits:13:17,digits:18:21")]


def vendor_rules(n):
    return [Rule(f"k{i}", f"vendor{chr(97 + i // 26)}{chr(97 + i % 26)}{'xyz'[i % 3] * 3}q{i:02d}[-_]key[-_]([0-9]{{4,}})", 1, 5) for i in range(n)]


def test_a_hundred_rules_are_asked_at_once(spark, scratch):
    """Far more rules and trigrams than a word has bits: every text asks for its own rule alone."""
    from bizops.llm.secretscan import build_index, candidates

    rules = vendor_rules(100)
    assert len(vocabulary(rules)) > 300
    docs = spark.createDataFrame([(i, r.pattern.split("[")[0].upper() + "_key-") for i, r in enumerate(rules)] + [(200, "vendor _key-"), (201, "")], "doc_id bigint, text string")
    got = candidates(build_index(docs, vocabulary(rules), scratch), rules).collect()
    assert sorted((r["doc"], list(r["rules"])) for r in got) == [(i, [i]) for i in range(100)]


def test_spans_of_many_trigrams(make_docs, scratch):
    rules = vendor_rules(12)
    assert len(vocabulary(rules)) > 63
    names = [r.pattern.split("[")[0] for r in rules]
    text = " ".join(f"{n}_key-{10_000 + i}" for i, n in enumerate(names)) + f" {names[3]}-key-1234"
    got = dict(listed(scan(make_docs([(1, text), (2, f"x {names[9]}-key_123456 {names[2]}"), (3, "vendor key"), (4, None)]), scratch, rules)))
    found = [(m.start(), i, m.end()) for i, r in enumerate(rules) for m in re.finditer(r.pattern, text) if len(m[1]) >= 5]
    assert len(found) == 12 and got[1] == ",".join(f"k{i}:{a}:{b}" for a, i, b in sorted(found))
    assert got[2].startswith("k9:2:") and "," not in got[2] and got[3] == got[4] == ""


def test_only_rules_without_trigrams(make_docs, scratch):
    assert listed(scan(make_docs([(1, "ab 123 45")]), scratch, [Rule("digits", r"[0-9]+", 0, 3)])) == [(1, "digits:3:6")]


def test_query_is_native_and_right(spark, small):
    got = QUERIES["op2_secret_scan"](spark, small).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert len(got) == len(text)
    for r in got:
        want = plain(text[r["doc_id"]])
        kinds = [x.split(":")[0] for x in want.split(",")] if want else []
        assert r["spans"] == want and r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [kinds.count(k) for k in ("assign", "access", "hex")]
