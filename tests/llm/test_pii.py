"""Pseudonyms: one to one, valid, format-preserving, reversible."""

import re
from datetime import date

from hypothesis import given, settings
from hypothesis import strategies as st

from thicket.llm import pii

THERE, BACK = pii.Pseudonyms("k"), pii.Pseudonyms("k", reverse=True)


def shape(s):
    return re.sub(r"\d", "0", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", s)))


def luhn_card(n):
    body = f"4{n:014d}"
    return body + str((10 - pii._luhn(body + "0")) % 10)


VALUES = st.one_of(
    st.tuples(st.just("card"), st.integers(0, 10**14 - 1).map(luhn_card)),
    st.tuples(st.just("phone"), st.tuples(st.integers(200, 999), st.integers(200, 999), st.integers(0, 9999)).map(lambda t: "+1 (%d) %d-%04d" % t)),
    st.tuples(st.just("email"), st.from_regex(r"\A[a-z]{3,9}\.[0-9]{2}@mail[0-9]\.example\.com\Z")),
    st.tuples(st.just("ssn"), st.tuples(st.integers(1, 665), st.integers(1, 99), st.integers(1, 9999)).map(lambda t: "%03d-%02d-%04d" % t)),
    st.tuples(st.just("ip"), st.tuples(st.integers(1, 126), *[st.integers(0, 255)] * 3).map(lambda t: "%d.%d.%d.%d" % t)),
    st.tuples(st.just("date"), st.dates(date(1900, 1, 1), date(2099, 12, 31)).map(lambda d: d.isoformat())),
    st.tuples(st.just("date"), st.dates(date(1900, 1, 1), date(2099, 12, 31)).map(lambda d: d.strftime("%d.%m.%Y"))),
)


@settings(max_examples=400, deadline=None)
@given(VALUES)
def test_valid_reversible_and_of_the_same_shape(value):
    kind, text = value
    new, spans = pii.replace_all(f"See {text}, or not.", THERE)
    assert [s[0] for s in spans] == [kind]
    start, n = spans[0][1:]
    got = new[start : start + n]
    assert kind == "ip" or shape(got) == shape(text)
    assert new == f"See {got}, or not."
    assert pii.replace_all(new, BACK)[0] == f"See {text}, or not."


def test_one_to_one():
    assert len({THERE.change("card", luhn_card(i)) for i in range(3000)}) == 3000
    days = {THERE.change("date", date.fromordinal(date(1900, 1, 1).toordinal() + i).isoformat()) for i in range(20000)}
    assert len(days) == 20000


def test_equal_values_stay_linked_across_formats():
    digits = lambda s: re.sub(r"\D", "", s)
    assert digits(THERE.change("card", "4111 1111 1111 1111")) == THERE.change("card", "4111111111111111")
    assert digits(THERE.change("phone", "+1 (988) 555-2485"))[1:] == digits(THERE.change("phone", "988-555-2485"))
    a, b = THERE.change("date", "2020-03-09"), THERE.change("date", "09.03.2020")
    assert a == "-".join(reversed(b.split(".")))


def test_neighbours_and_iban():
    text = "a.b9@mail1.example.com +1 (846) 555-5432 83.188.222.77 4111111111111111 10.1.2.3 4111111111111111 DE89 3704 0044 0532 0130 00 end"
    new, spans = pii.replace_all(text, THERE)
    assert [s[0] for s in spans] == ["email", "phone", "ip", "card", "ip", "card", "iban"]
    assert pii.replace_all(new, BACK)[0] == text
    assert not set(text.split()) & {w for w in new.split() if re.search(r"\d\d\d", w)}


def test_what_is_not_valid_stays():
    for text in ("4111111111111112", "999.1.1.1", "127.0.0.1", "2021-02-30", "000-12-3456", "version 2.0, 1999", "31.12.1899", "DE00 3704 0044 0532 0130 00", "", "no numbers @ all"):
        assert pii.replace_all(text, THERE) == (text, [])


def test_operator(spark):
    long = "word " * 200_000 + "a.b9@mail1.example.com"
    rows = [(1, "x 4111111111111111", "p"), (2, None, None), (3, "", "q"), (4, long, "r"), (1, "x 4111111111111111", "p")]
    got = pii.pseudonymise(spark.createDataFrame(rows, "doc_id long, text string, kind string"), "k").collect()
    assert [r["text"] for r in got][:3] == [pii.replace_all(rows[0][1], THERE)[0], None, ""]
    assert got[0] == got[4] and [len(r["pii"]) for r in got] == [1, 0, 0, 1, 1] and len(got[3]["text"]) == len(long)
    assert pii.pseudonymise(spark.createDataFrame([], "text string"), "k").collect() == []
