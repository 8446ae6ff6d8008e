import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ebbwatch.llm.pseudonyms import found_values, luhn_digit, permuted, pseudonymised, replaced
from tests.llm.texts import documents, mixed_texts

KEY = b"test"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation(size):
    assert sorted(permuted(i, size, KEY, "t") for i in range(size)) == list(range(size))


VALID = {
    "DE89 3704 0044 0532 0130 00": "iban", "GB82WEST12345698765432": "iban", "4111 1111 1111 1111": "card", "4111111111111111": "card",
    "123-45-6789": "ssn", "2000-02-29": "date", "12/31/1999": "date", "31.12.1999": "date", "a.b+c@mail.example.com": "email",
    "10.20.30.40": "ip", "(212) 555-1234": "phone", "+44 20 7946 0958": "phone", "+1 (017) 555-7713": "phone",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"': "secret",
}


@pytest.mark.parametrize("text", VALID)
def test_format_stays_and_value_goes(text):
    values = found_values(f"before {text} after", KEY)
    assert [v[2] for v in values] == [VALID[text]]
    out = replaced(f"before {text} after", values)
    assert text not in out and [v[2] for v in found_values(out, KEY)] == [VALID[text]]  # as valid as before
    assert out == replaced(f"before {text} after", found_values(f"before {text} after", KEY))
    assert out != replaced(f"before {text} after", found_values(f"before {text} after", b"other"))


@pytest.mark.parametrize("text", [
    "4111 1111 1111 1112", "7536784127813051", "2001-02-29", "999-45-6789", "000-12-3456", "256.1.1.1", "1.2.3", "01.2.3.4", "no @ here",
    "DE88 3704 0044 0532 0130 00", "32/13/1999", "0000000000000000", "chapter 12, page 345", "v1.2.3.4.5",
])
def test_invalid_values_stay(text):
    assert found_values(text, KEY) == []


@settings(max_examples=200, deadline=None)
@given(st.integers(10**14, 10**15 - 1), st.integers(10**14, 10**15 - 1))
def test_cards_map_one_to_one(x, y):
    cards = [f"{n}{luhn_digit(str(n))}" for n in (x, y)]
    names = [replaced(c, found_values(c, KEY)) for c in cards]
    assert (names[0] == names[1]) == (x == y)
    assert all(luhn_digit(n[:-1]) == n[-1] for n in names)


def test_table(spark):
    texts = mixed_texts() + ["mail a1@b2.com, again a1@b2.com", "a1@b2.com"]
    got = pseudonymised(documents(spark, texts)).toPandas().set_index("doc_id")
    for i, t in enumerate(texts[:-2]):
        assert got.text[i] == t and len(got["values"][i]) == 0
    name = got.text[len(texts) - 1]
    assert got.text[len(texts) - 2] == f"mail {name}, again {name}" and name != "a1@b2.com"
    spans = [(v["first"], v["last"], v["kind"]) for v in got["values"][len(texts) - 2]]
    assert spans == [(5, 14, "email"), (22, 31, "email")]
    assert pseudonymised(documents(spark, [])).count() == 0


BETWEEN = {
    "ES9121000418450200051332": "iban", "ES91 2100 0418 4502 0005 1332": "iban", "DE89 3704 0044 0532 0130 00": "iban",
    "+33 1 23 45 67 89": "phone", "+43 1 5123456": "phone", "+49 30 12345678": "phone", "+49 (0) 30 123456": "phone",
    "+1 415 555 2671": "phone", "+44 20 7946 0958": "phone", "1/2/1999": "date", "2000-1-25": "date", "3/25/1999": "date", "5.12.1999": "date",
    "4111 1111 1111 1111": "card", "123-45-6789": "ssn",
}


@pytest.mark.parametrize("text", BETWEEN)
@pytest.mark.parametrize("around", ["{}", "AT {} AND", "NO {} BIC", "IBAN {} A BC", "AB12 {} DATE", "x {}, 17", "TO {} 20261234", "{} 10.20.30.40"])
def test_values_between_words_and_numbers(text, around):
    whole = around.format(text)
    values = found_values(whole, KEY)
    at = whole.index(text)
    assert (at, at + len(text), BETWEEN[text]) in [v[:3] for v in values]
    out = replaced(whole, values)
    assert text not in out and len(out) - len(whole) == sum(len(v[3]) - (v[1] - v[0]) for v in values)
    assert ("10.20.30.40" in whole) == any(v[2] == "ip" for v in values)


def test_dates_keep_their_digits():
    days = [f"{d}/{m}/{y}" for y in (1999, 2000) for m in range(1, 10) for d in range(1, 10)]
    names = [found_values(x, KEY)[0][3] for x in days]
    assert len(set(names)) == len(days) and all(len(n) == 8 for n in names)


def test_a_following_value_is_not_taken_for_a_group():
    values = found_values("call +44 20 7946 0958 2000-01-02 or +1 415 555 2671 20261", KEY)
    assert [v[2] for v in values] == ["phone", "date", "phone"] and values[2][:2] == (36, 51)


def test_many_values_in_one_text():
    """The time to find values grows with their number, not with its square."""
    text = " ".join(f"user{i}@example.org 10.0.{i % 256}.{i // 256 % 256}" for i in range(50_000))
    began = time.perf_counter()
    values = found_values(text, KEY)
    assert time.perf_counter() - began < 40
    assert len(values) == 100_000 and all(a[1] <= b[0] for a, b in zip(values, values[1:]))
