"""Personal data: base spans against the plain patterns, added ones by examples."""

from __future__ import annotations

import hashlib
import random
import re
import time

import pytest

from sedimenta.llm.personal_data import BASE, find_personal, luhn, mask_personal, mod97, personal_report, spans_of

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plainly_confirmed(kind, text):
    digits = [int(c) for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        total = 0
        for i, d in enumerate(reversed(digits)):
            total += d if i % 2 == 0 else sum(map(int, str(2 * d)))
        return 14 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        found += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text or "") if plainly_confirmed(kind, m[0])]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def texts(count=400):
    rng = random.Random(12)
    pieces = [
        "é", " ", " ", "@", "@", ".", "-", "+", "(", ")", "a", "b.c", "x@y.zz", "me@a-b.co.uk.", "1.2.3.4", "300.1.1.1",
        "01.002.3.4.5.6.7.8", "4111 1111 1111 1111", "4736962573099581", "5500-0000-0000-0004", "+1 (017) 555-7713",
        "+49 30 1234567", "7", "0", "12", "\n", "phone", "%", "_",
    ]
    out = [None, "", "a" * 30, "@@a.b@c.d", "x@a.b@c.d", "+1", "+1 2", "1.2.3", "9 9"]
    return out + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(count)]


def test_base_spans_are_those_of_the_plain_patterns(spark):
    rows = [(None if i == 5 else i, t, 7) for i, t in enumerate(texts())]
    docs = spark.createDataFrame([*rows, rows[20], rows[20]], "doc_id long, text string, found int").repartition(3)
    got = sorted(map(tuple, personal_report(find_personal(docs)).collect()), key=repr)
    want = []
    for doc, text, _ in [*rows, rows[20], rows[20]]:
        base = brute(text)
        counts = [sum(x.startswith(k + ":") for x in base) for k in BASE]
        want.append((doc, *counts, hashlib.sha256(",".join(base).encode()).hexdigest()))
    assert [g[:-1] for g in got] == [w for w in sorted(want, key=repr)]
    for (_, *_, spans), base in zip(
        sorted(got, key=repr), (brute(dict((r[0], r[1]) for r in rows)[g[0]]) for g in sorted(got, key=repr)), strict=True
    ):
        assert [s for s in spans.split(",") if s.split(":")[0] in BASE] == base
    assert personal_report(find_personal(docs.limit(0))).collect() == []


def kinds(text):
    return [(k, text[s:e]) for s, e, k, _ in spans_of(text)]


@pytest.mark.parametrize(
    "text, want",
    [
        ("IBAN DE89 3704 0044 0532 0130 00, bitte", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("GB82WEST12345698765432", [("iban", "GB82WEST12345698765432")]),
        ("DE88 3704 0044 0532 0130 00", []),
        ("DE89 3704 0044 0532 0130 00 UND", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("his social security number 123-45-6789.", [("ssn", "123-45-6789")]),
        ("123-45-6789", []),
        ("social security 000-45-6789", []),
        ("routing 021000021", [("routing", "021000021")]),
        ("routing 021000022", []),
        ("call (555) 123-4567 now", [("local", "(555) 123-4567")]),
        ("(555) 123-4567", []),
        ("call about order (555) 123-4567", []),
        ("recall (555) 123-4567", []),
        ("call +1 (555) 123-4567", [("phone", "+1 (555) 123-4567")]),
    ],
)
def test_added_spans(text, want):
    assert kinds(text) == want


def test_context_moves_the_score():
    score = lambda text: spans_of(text)[0][3]
    assert score("card 4736962573099581") > score("4736962573099581") > score("order 4736962573099581")


def test_checksums():
    assert luhn("4736962573099581") and not luhn("4736962573099582")
    assert mod97("GB82 WEST 1234 5698 7654 32") and not mod97("GB83 WEST 1234 5698 7654 32")


def test_very_long_runs_take_time_in_proportion():
    start = time.perf_counter()
    for text in ("a" * 3_000_000 + "1", "1" * 3_000_000, "1." * 1_500_000, "+1" + " " * 3_000_000, "a@" * 1_500_000, "1 " * 1_500_000):
        spans_of(text)
    spans = spans_of("x" * 2_000_000 + "@a.b")
    assert spans[0][:3] == (0, 2_000_004, "email")
    assert time.perf_counter() - start < 60


def test_masked(spark):
    rows = [(1, "write to a@b.cc or 1.2.3.4!", "k"), (2, None, "k"), (3, "nothing", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    got = mask_personal(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == [(1, "write to <email> or <ip>!", "k"), rows[1], rows[2]]
