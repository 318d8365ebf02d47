import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pii
from millrace.llm.queries import QUERIES


def _brute(text):
    out = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, m.start(), m.end()) for m in re.finditer(pii.IP, text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(pii.CARD, text):
        digits = re.sub("[ -]", "", m[0])
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(digits[::-1]))
        if 13 <= len(digits) <= 19 and total % 10 == 0:
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in re.finditer(pii.PHONE, text) if 9 <= len(re.findall("[0-9]", m[0])) <= 15]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["4", "11", "1.2.3.4", "256", ".", "@", "a.b", "-", " ", "+1", "(555)", "555-0100", "4111 1111 1111 1111", "é", "x@y.z"]), max_size=14).map("".join))
def test_base_spans_against_brute_force(text):
    assert pii.base_spans(text) == _brute(text)


def test_long_runs_take_linear_time():
    for unit in ("1", "a", "1.", "a@", "+1", "1 ", "+(", "@a.", "1-"):
        assert isinstance(pii.base_spans(unit * 60_000 + "@"), list)


def test_field_adds_mentions_like_known_ones(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    weights = pii.learn(docs)
    text = (
        "Call +1 (743) 555-3824 now or (743) 555-3824 later; card 4041894974608795, 4041.8949.7460.8795. "
        "Order 4041894974608796 and 4041894974608796 again."
    )
    base, spans = pii.all_spans(text, weights)
    assert set(base) <= set(spans)
    added = {(pii.KINDS[k], text[a:b]) for k, a, b in set(spans) - set(base)}
    assert added == {("phone", "(743) 555-3824"), ("card", "4041.8949.7460.8795")}


def test_messages_agree_with_enumeration():
    """On a tree, message passing is exact."""
    rng = np.random.default_rng(0)
    weights = rng.normal(0, 0.5, (5, 1 + pii.N_MARKS + 12))
    found = pii.Mentions("", [])
    found.places, found.marks, found.given = [(0, 1)] * 3, [1, 6, 512], np.array([2, 0, 0])
    found.chain, found.skip = [(1, 2)], [(0, 1)]
    got = pii.marginals(found, weights)
    c = 1 + pii.N_MARKS
    none = pii._row(np.array(found.marks), np.full(3, 5), np.full(3, 5))
    none[:, c:] = 0
    unary = none @ weights.T
    chain, skip = weights[:, c : c + 5].T - weights[:, c + 5], weights[:, c + 6 : c + 11].T - weights[:, c + 11]
    skip = (skip + skip.T) / 2
    joint = np.exp(unary[1][:, None] + unary[2][None, :] + chain + skip[2][:, None])
    joint /= joint.sum()
    assert np.allclose(got[1], joint.sum(1), atol=1e-3)
    assert np.allclose(got[2], joint.sum(0), atol=1e-3)


def test_registered_query_and_odd_rows(spark):
    raw = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    found = QUERIES["op5_pii"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(raw)
    for row in found:
        want = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in _brute(raw[row["doc_id"]] or "")]
        assert set(want) <= set(filter(None, row["spans"].split(",")))
        assert row["n_email"] + row["n_ip"] + row["n_card"] + row["n_phone"] == len(want)
    rows = [(1, None, "b"), (2, "", "b"), (3, "a@b.co", "b"), (3, "a@b.co", "b"), (None, "x", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = sorted((len(r["base"]), len(r["spans"])) for r in pii.find(df, pii.learn(df)).collect())
    assert got == [(0, 0)] * 3 + [(1, 1)] * 2
    assert pii.find(df.limit(0), pii.learn(df.limit(0))).collect() == []


def test_field_adds_mentions_without_known_ones(spark):
    """Loose mentions alone, and those beside other kinds, become spans; numbers that fail a check don't."""
    weights = pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))

    def added(text):
        base, spans = pii.all_spans(text, weights)
        return {(pii.KINDS[k], text[a:b]) for k, a, b in set(spans) - set(base)}

    phones = {("phone", "(743) 555-3824"), ("phone", "743.555.3824")}
    assert added("call (743) 555-3824 today, or by phone 743.555.3824") == phones
    assert added("call (743) 555-3824 or write to x@y.org, or phone 743.555.3824") == phones
    mail = "jane [at] example [dot] com"
    assert added(f"mail {mail} now, again: {mail}") == {("email", mail)}
    assert pii.all_spans(f"{mail} and {mail}", weights)[1] == [(0, 0, 27), (0, 32, 59)]
    assert added("from 4041.8949.7460.8795 to 4041.8949.7460.8795") == {("card", "4041.8949.7460.8795")}
    assert added("it is 8[.]8[.]4[.]4 here") == {("ip", "8[.]8[.]4[.]4")}
    plain = "Order 4041.8949.7460.8796 of 2021-03-04 12:30:11, 1,234,567,890 pieces, ids 5551234567 and 5551234567, 1,2,3,4."
    assert added(plain) == set()
    assert pii.all_spans("no digits here", weights) == ([], [])
