"""The trigram query of an expression, and spans of texts with many matches."""

import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import secrets


def meets(query, text):
    low = text.lower()
    return any(all(t in low for t in part) for part in query)


FORMS = [r.pattern for r in (*secrets.BASE_RULES, *secrets.MORE_RULES)] + [
    r"a(bc|de)?fgh", r"(?i:key|Kennwort)[0-9]{2,3}x", r"ab{2,4}c[xy]+z", r"(one|two|.*three)four", r"[^a]bcd\b", r"(abc)+d(e|)f", r"x[a-z]yzw|long_word", r"\d+abc$", r"\bqueen\b", r"(ab|cd){3}",
]


@pytest.mark.parametrize("pattern", FORMS)
def test_no_match_is_missed(pattern):
    query = secrets.trigram_query(pattern)

    @settings(max_examples=60, deadline=None)
    @given(st.from_regex(re.compile(pattern, re.ASCII)))
    def run(text):
        assert meets(query, text)

    run()


@settings(max_examples=300, deadline=None)
@given(st.recursive(
    st.sampled_from(["a", "bc", "def", "[xy]", "[0-9]", ".", "g?", "h*", "(?:ij)+", "K"]),
    lambda inner: st.one_of(
        st.lists(inner, min_size=1, max_size=4).map("".join), st.lists(inner, min_size=1, max_size=3).map(lambda p: "(" + "|".join(p) + ")"),
        st.tuples(inner, st.sampled_from(["?", "+", "{2}", "{0,3}"])).map(lambda x: f"(?:{x[0]}){x[1]}"),
    ), max_leaves=12,
), st.data())
def test_no_match_of_a_made_up_expression_is_missed(pattern, data):
    text = data.draw(st.from_regex(re.compile(pattern, re.ASCII)))
    assert re.search(pattern, text) and meets(secrets.trigram_query(pattern), text)


def test_queries_say_something():
    by_kind = {r.kind: secrets.trigram_query(r.pattern) for r in (*secrets.BASE_RULES, *secrets.MORE_RULES)}
    assert [k for k, q in by_kind.items() if q == secrets.TRUE] == ["hex"]
    assert not meets(by_kind["assign"], "pass the word to a key holder") and meets(by_kind["assign"], "x API_Key = 1")
    assert not meets(by_kind["access"], "the akin") and meets(by_kind["private_key"], "-----BEGIN RSA PRIVATE KEY-----")


def test_many_matches_take_linear_time(spark):
    n = 100_000
    text = ("deadbeef" * 4 + "é ") * n
    docs = spark.createDataFrame([(1, text), (2, "token=abcdefgh1")], "doc_id long, text string")
    began = time.perf_counter()
    rows = {r["doc_id"]: r for r in secrets.scan_secrets(docs).collect()}
    assert time.perf_counter() - began < 60
    assert rows[1]["spans"] == ",".join(f"hex:{34 * i}:{34 * i + 32}" for i in range(n)) and rows[2]["spans"] == "assign:0:15"


def test_many_candidates_go_by_shuffle(spark):
    rng = random.Random(9)
    parts = ["password=", "abcdefgh12", " ", "AKIA", "ABCDEFGHIJKLMNOP", "İ", "SECRET: "]
    rows = [(None if i % 5 == 0 else i % 50, "".join(rng.choice(parts) for _ in range(rng.randint(0, 8)))) for i in range(400)] + [(None, None), (7, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    few, many = (sorted(map(str, secrets.scan_secrets(docs, broadcast_rows=n).collect())) for n in (10**6, 0))
    assert few == many and len(few) == len(rows)


def test_rules_without_trigrams_scan_all(spark):
    docs = spark.createDataFrame([(1, "0123456789abcdef" * 2), (2, "x")], "doc_id long, text string")
    rows = sorted(tuple(r) for r in secrets.scan_secrets(docs, base=secrets.BASE_RULES[2:], more=()).select("doc_id", "n_hex", "spans").collect())
    assert rows == [(1, 1, "hex:0:32"), (2, 0, "")]
