import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecshoal.llm import pii

from .conftest import EDGE

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, sign in enumerate(reversed(digits)):
        x = int(sign) * (1 + place % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def holds(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def brute(text):
    return [(k, m.start(), m.end(), m.group()) for k, p in BASE.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def found(frame):
    return {r.doc_id: [(s["kind"], s["start"], s["end"], s["value"]) for s in r.spans] for r in frame.collect()}


TEXTS = [
    "mail a.b@c.de, or x@y and p@q@r.st or a@b.c%d@e.f.",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 and 0001.02.3.255 999.1.2.3.4",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1111 or 4111111111111112 1 2",
    "call +1 (578) 555-6437, +12 34, +49 30 1234567890123456 and +4930123456 78",
    "😀 é +1 (578) 555-6437 ü a@b.co",
    "5" * 30 + " " + "4111111111111111",
    "a" * 60_000 + " " + "1" * 60_000 + " +" + "1 " * 30_000,
    "x@" * 2_000 + "a@b." + "c." * 2_000,
]


def test_base_spans_match_plain_regular_expressions(documents):
    texts = [*TEXTS, *EDGE, "write to a@b.co or 10.0.0.1 " * 20_000]
    got = found(pii.find_pii(documents(texts)))
    for number, text in enumerate(texts):
        assert [s for s in got[number] if s[0] in BASE] == brute(text), number


def test_random_texts(spark, documents):
    texts = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet="a1.@+-( )9%_x😀", max_size=40))
    def gather(text):
        texts.append(text)

    gather()
    got = found(pii.find_pii(documents(texts)))
    for number, text in enumerate(texts):
        assert [s for s in got[number] if s[0] in BASE] == brute(text), text


def test_checksums_and_context_of_further_kinds(documents):
    texts = [
        "account DE89 3704 0044 0532 0130 00 please",
        "DE89370400440532013001",
        "ssn: 123-45-6789",
        "part 123-45-6789 in stock",
        "tel (578) 555-6437",
        "(578) 555-6437 apples",
        "GB82WEST12345698765432",
        "DE89 3704 0044 0532 0130 00 BIC COBADEFF",
        "DE89370400440532013000 2024-05-01",
        "XX89370400440532013000 DE8937040044053201300",
    ]
    got = found(pii.find_pii(documents(texts)))
    kinds = {n: [(s[0], s[3]) for s in spans if s[0] not in BASE] for n, spans in got.items()}
    assert kinds == {
        0: [("iban", "DE89 3704 0044 0532 0130 00")], 1: [], 2: [("ssn", "123-45-6789")], 3: [],
        4: [("local_phone", "(578) 555-6437")], 5: [], 6: [("iban", "GB82WEST12345698765432")],
        7: [("iban", "DE89 3704 0044 0532 0130 00")], 8: [("iban", "DE89370400440532013000")], 9: [],
    }
    raised = pii.find_pii(documents(["my card 4111111111111111", "4111111111111111"])).select("doc_id", F.col("spans")[0]["score"]).collect()
    assert {r[0]: round(r[1], 6) for r in raised} == {0: 1.0, 1: 0.9}


def test_edges(documents):
    assert pii.find_pii(documents([])).count() == 0
    odd = documents([(1, "a@b.co"), (1, "a@b.co"), (None, None)]).selectExpr("*", "1 as spans", "2 as _text", "3 as value")
    rows = pii.find_pii(odd).collect()
    assert sorted((r.doc_id is None, len(r.spans)) for r in rows) == [(False, 1), (False, 1), (True, 0)]
