"""Account boundaries: printed and compact international numbers, check digits, long separators."""

import pytest

from riskframe.llm.pii import find, mod97


@pytest.mark.parametrize("text, want", [
    ("IBAN DE89 3704 0044 0532 0130 00 BIC X", ["DE89 3704 0044 0532 0130 00"]),
    ("iban: GB82WEST12345698765432.", ["GB82WEST12345698765432"]),
    ("IBAN" + " " * 40 + "NO93 8601 1117 947", ["NO93 8601 1117 947"]),
    ("IBAN DE88 3704 0044 0532 0130 00", []),
    ("IBAN ABC-0000-X9", []),
    ("Account GB82 WEST 1234 5698 7654 32, account no 12345678", ["GB82 WEST 1234 5698 7654 32", "12345678"]),
    ("account GB83WEST12345698765432", []),
    ("myaccount 12345678 account", []),
    ("IBAN", []),
])
def test_accounts(text, want):
    assert [text[a:b] for a, b in find(text)["account"]] == want


def test_check_digits():
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765423")


def test_long_separators_take_linear_time():
    assert find(("account" + " -" * 50_000) * 4)["account"] == []
