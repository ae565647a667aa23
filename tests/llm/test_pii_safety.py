"""Pseudonyms of texts that are long, hostile or beyond ASCII."""

from __future__ import annotations

import time

import pytest
from tests.llm.docs import odd_docs

from spanweave.llm import pii

KEY = b"test"


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 128, 500, 3_060, 100_000])
def test_addresses_of_any_length_are_replaced_whole(n):
    letters = "abcdefghijklmnopqrstuvwxyz"
    local = (letters * (n // 26 + 1))[:n]
    new, found = pii.pseudonymise(f"write to {local}@example.com now", KEY)
    assert found == [("email", 9, 9 + n + 12)] and new.startswith("write to ") and new.endswith(".com now")
    made = new[9 : 9 + n]
    assert made.isalpha() and made.islower()
    # no stretch stays as it was: chance alone keeps one letter in 26
    assert sum(a == b for a, b in zip(made, local, strict=True)) <= max(1, n // 10)
    # every character depends on all others
    other = pii.pseudonymise(f"write to {local[:-1]}{'z' if local[-1] != 'z' else 'y'}@example.com now", KEY)[0]
    assert other[9 : 9 + n] != made
    if n > 60:
        assert sum(a == b for a, b in zip(made, other[9 : 9 + n], strict=True)) <= n // 5


def test_long_permutation_is_one_to_one():
    base = "abcde" * 30
    texts = [base[:i] + "z" + base[i + 1 :] for i in range(len(base))] + [base]
    assert len({pii.permute_text(t, KEY, "t") for t in texts}) == len(texts)


@pytest.mark.parametrize("unit", ["a%", "a@", "1.", "4 ", "1 ", "a.", "@", "a@a.", "a@b.c", "+1 ", "12-", "AB12 ", "de89", "0 0", "'", "%a@"])
def test_a_megabyte_takes_seconds(unit):
    text = unit * (1_000_000 // len(unit)) + "1"
    pii.pseudonymise(text[:1000], KEY)
    began = time.process_time()
    pii.pseudonymise(text, KEY)
    assert time.process_time() - began < 15


@pytest.mark.parametrize(
    "text",
    [
        "josé@example.com", "müller@straße.de", "o'neil@example.com", "日本語@example.jp", "iban de89370400440532013000 end", "card 4111.1111.1111.1111 end",
        "call 0044 20 7946 0958 now", "100%jane.doe@example.com", "a_b@c.org",
    ],
)
def test_values_of_other_forms_are_found(text):
    new, found = pii.pseudonymise(text, KEY)
    assert len(found) == 1 and len(new) == len(text) and new != text
    _, s, e = found[0]
    assert new[:s] == text[:s] and new[e:] == text[e:]
    if "@" in text:
        local = lambda t: t[s:e].partition("@")[0]
        assert all(not a.isalpha() or a.isalpha() for a in local(new)) and local(new) != local(text)


def test_quotes_and_signs_around_addresses_stay():
    new, found = pii.pseudonymise("'bob@y.org', <amy@x.com>; %x@z.com", KEY)
    assert [k for k, _, _ in found] == ["email"] * 3
    assert new[0] == "'" and new.count("<") == new.count(">") == 1 and ", <" in new and "; %" in new


def test_long_words_in_a_job(spark):
    docs = odd_docs(spark, [(1, "a" * 3060 + "@ex.com"), (2, "a%" * 100_000 + "1"), (3, "x" * 70_000 + "@" + "y" * 70_000 + ".com")])
    assert [r[0] for r in docs.select(pii.pseudonyms(KEY)("text")["n_found"]).collect()] == [1, 0, 1]
