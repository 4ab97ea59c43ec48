import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from sparkrank.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 14 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m.group())) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.BASE.index(s[0])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab0149.@-+ ()_%\né\U0001f600", max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert [s[:3] for s in pii.find(text) if s[0] in pii.BASE] == base(text)


CASES = [
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, mail me at a.b@c.example.com.",
    "10.0.0.1 10.0.0.256 1.2.3.4.5.6.7.8 010.1.1.1 call +1 (017) 555-7713!",
    "a@b.c@d.e x@y.co_z@q.org @n.one é@x.yz \U0001f600q@w.er",
    "IBAN DE89 3704 0044 0532 0130 00 and DE89370400440532013001; SSN 123-45-6789, id 123-45-6789",
]


def test_added_spans_need_confirmation():
    kinds = [[s[0] for s in pii.find(t)] for t in CASES]
    assert kinds[0] == ["card", "email"]
    assert kinds[3].count("iban") == 1
    assert [s[0] for s in pii.find("social security 123-45-6789")] == ["ssn"]
    assert pii.find("order 123-45-6789") == [] and pii.find("fax (212) 555-0100")[0][0] == "local_phone"
    assert pii.find("just (212) 555-0100") == []


def test_checksums():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")


def test_long_runs_are_linear():
    for text in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" * 200_000, "@" * 200_000, "a@" * 200_000, "A1" * 200_000):
        pii.find(text)


def test_query_and_masking(spark, docs_of):
    rows = [(1, None), (2, ""), (None, CASES[0]), (4, CASES[1]), (4, CASES[1]), (6, CASES[2] * 300), (7, CASES[3])]
    docs = docs_of(rows)
    found = pii.find_pii(docs, out="own").select("doc_id", "text", "own").collect()
    assert len(found) == len(rows)
    for r in found:
        want = base(r.text or "")
        assert [(s.kind, s.start, s.stop) for s in r.own if s.kind in pii.BASE] == want
    masked = {r.doc_id: r.text for r in pii.redact_pii(docs).collect()}
    assert masked[1] is None and masked[2] == "" and masked[None].startswith("card <CARD> and 4111-1111-1111-1112, mail me at <EMAIL>.")
    assert pii.redact_pii(docs).columns == docs.columns
    assert pii.find_pii(docs_of([])).count() == 0


def test_registered_query(spark, sf):
    got = pii.q_op1_pii(spark, sf).collect()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(texts)
    for r in got:
        want = base(texts[r.doc_id])
        assert [r[f"n_{k}"] for k in pii.BASE] == [sum(s[0] == k for s in want) for k in pii.BASE]
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE] == [f"{k}:{a}:{b}" for k, a, b in want]


def test_ibans_before_other_words():
    code, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    for text, iban in [
        (f"IBAN: {spaced} BIC: COBADEFF", spaced),
        (f"{code} BIC COBADEFFXXX", code),
        (f"IBAN {spaced} 2024 EUR", spaced),
        (f"XX12 ABCD EFGH {spaced}", spaced),
        ("NO93 8601 1117 947 OSLO", "NO93 8601 1117 947"),
    ]:
        at = text.index(iban)
        assert ("iban", at, at + len(iban)) in [s[:3] for s in pii.find(text)], text
        assert iban not in pii.mask(text, pii.find(text))
    assert not [s for s in pii.find(f"{code}0 and {code[:-1]} and DE89 3704 0044 0532 0130 01 BIC") if s[0] == "iban"]


def test_iban_beside_a_card():
    digits = next(d for d in (f"{n:018d}" for n in range(370400440532013000, 370400440532023000)) if pii.luhn(f"{98 - int(d + '131400') % 97:02d}{d}"[2:]) and d[0] != "0")
    code = f"DE{98 - int(digits + '131400') % 97:02d} {digits}"
    assert pii.mod97(code.replace(" ", ""))
    assert ("iban", 0, len(code)) in [s[:3] for s in pii.find(code)]
