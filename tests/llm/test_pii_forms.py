"""Cues and schemes in any case, and IBANs as they are printed."""

import pytest

from ledgerloom.llm import pii


@pytest.mark.parametrize("cue", ["User ID: ", "Customer ID ", "Member Id ", "uSeR iD=", "Iban: ", "iBAN "])
def test_cues_in_any_case(cue):
    text = f"é {cue}48213377."
    assert [(text[a:b], k) for a, b, k in pii.find_pii(text)] == [("48213377", "account")]
    assert pii.redacted(text) == f"é {cue}[ACCOUNT]."


@pytest.mark.parametrize("scheme", ["hTTps://", "HTTP://", "Ftp://"])
def test_schemes_in_any_case(scheme):
    text = f"see {scheme}a.b/c"
    assert (4, len(text), "url") in pii.find_pii(text)


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "de89 3704 0044 0532 0130 00"])
@pytest.mark.parametrize("after", ["", ".", " OK then", " THE 12 END"])
def test_ibans_in_groups(iban, after):
    text = f"IBAN {iban}{after}"
    assert (5, 5 + len(iban), "account") in pii.find_pii(text)
    assert pii.redacted(text) == f"IBAN [ACCOUNT]{after}"


def test_false_ibans_and_other_letters():
    assert not [s for s in pii.find_pii("IBAN DE88 3704 0044 0532 0130 00") if s[2] == "account"]
    text = "\u0130 \u212a User ID: 48213377"  # letters whose small form is longer or ASCII
    assert [text[a:b] for a, b, _ in pii.find_pii(text)] == ["48213377"]


@pytest.mark.parametrize("text, account", [
    ("SSN: 123-45-6789.", "123-45-6789"), ("ssn 123 45 6789", "123 45 6789"), ("ssn no. 123456789", "123456789"), ("SSN 000-45-6789", ""), ("SSN 666-45-6789", ""),
    ("SSN 912-45-6789", ""), ("SSN 123-00-6789", ""), ("SSN 123-45-0000", ""), ("SSN 123-45 6789", ""), ("ssn 123-45-67890", ""), ("ssn AB-123456", ""),
    ("Routing number: 021000021", "021000021"), ("routing 021000022", ""), ("routing 02100002", ""), ("routing 011401533x", ""),
    ("IBAN DE88370400440532013000", ""), ("IBAN DE89370400440532013000", "DE89370400440532013000"), ("account GB82WEST12345698765431", ""), ("account 1234-5678-AB", "1234-5678-AB"),
])
def test_numbers_are_validated(text, account):
    assert "".join(text[a:b] for a, b, k in pii.find_pii(text) if k == "account") == account


def test_urls_by_brute_force():
    import random
    import re

    rng = random.Random(3)
    parts = ["http://", "HTTPS://", "ftp://", "mailto:", "a.b/c", "x", " ", ".", ")", "?q=1", "\n", "é", "<", "https:/", "//"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        want, done = [], 0
        for m in re.finditer(r"(?i)(?=(http://|https://|ftp://|mailto:))", text):
            start = m.start() + len(m[1])
            rest = re.match(r"[^\x00-\x20\x7f<>\"'`{}|\\^]*", text[start:])[0].rstrip(".,;:!?)]")
            if m.start() >= done and rest:
                done = start + len(rest)
                want.append((m.start(), done, "url"))
        assert [s for s in pii.find_pii(text) if s[2] == "url"] == want, text
