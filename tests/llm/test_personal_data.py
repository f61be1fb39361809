"""Personal data: base matches against plain patterns in Python, runs of 100,000 characters, spans that the method adds."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from podium.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _base(text):
    out = [[(m.start(), m.end()) for m in EMAIL.finditer(text)],
           [(m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]]
    cards, phones = [], []
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and _luhn(d):
            cards.append((m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            phones.append((m.start(), m.end()))
    return [*out, cards, phones]


def _want(text):
    found = _base(text)
    joined = ",".join(f"{k}:{s}:{e}" for k, spans in zip(pii.KINDS, found) for s, e in spans)
    return tuple(map(len, found)), hashlib.sha256(joined.encode()).hexdigest()


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(7)
    alphabet = "0123456789" * 3 + "..--  ++()@@ab%_é\n\t"
    parts = ["4111 1111 1111 1111", "4111-1111-1111-1112", "a.b+c@d-e.f.g", "10.0.0.255", "256.1.1.1", "1.2.3.4.5", "+1 (583) 555-1341",
             "+12", "x@y", "@a.b", "a@b@c.d", "00000000000000000", "+49.30/901820"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 8))) for _ in range(300)]
    texts += [rng.choice(["", " ", ".", "é"]).join(rng.choice(parts) for _ in range(3)) for _ in range(200)] + [""]
    rows = list(enumerate(texts)) + [(9000, None), (None, parts[0])]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, kind int, spans string").repartition(4)
    got = pii.report(df).collect()
    assert len(got) == len(rows)
    by_id = dict(rows)
    for r in got:
        n, digest = _want(by_id[r.doc_id] or "")
        assert ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) == (n, digest), by_id[r.doc_id]
        base = set(filter(None, _spans(by_id[r.doc_id] or "").split(",")))
        assert base <= set(filter(None, r.spans.split(",")))


def _spans(text):
    return ",".join(f"{k}:{s}:{e}" for k, spans in zip(pii.KINDS, _base(text)) for s, e in spans)


def test_runs_of_any_length(spark):
    """Runs of 100,000 characters of every kind neither overflow a stack nor take a square of their length."""
    # as long as the plain patterns can bear, and 100,000
    short, long = _long(8_000), _long(100_000)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*short, *long])], "doc_id long, text string").repartition(8)
    got = {r.doc_id: r for r in pii.report(df).collect()}
    for i, t in enumerate(short):
        assert ((got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone), got[i].base_sha256) == _want(t), i
    assert len(got) == 2 * len(short)
    masked = {r.doc_id: r.text for r in pii.mask(df, chars_col=None).collect()}
    assert masked[3] == "[EMAIL]" and masked[len(short) + 3] == "[EMAIL]"


def _long(n):
    return ["1" * n, "1 " * (n // 2), "1-" * (n // 2) + "1", "a@b" + ".c" * (n // 2), "a" * n + "@b.c", "@" * n, "." * n, "-" * n,
             " " * n, "+" * n, "+1" + "(" * n, "+1" + " 2" * (n // 2), "1." * (n // 2), "!" * n + "a", "!" * n, "x" + "!" * n + "x1",
             "é" * n + " 1", "a.1@ " * (n // 5), "word " * (n // 5) + "7"]


def test_patterns_discover_what_the_fixed_ones_miss(spark):
    """Words that stand before seeds only mark runs of the right shape; words that stand before anything do not."""
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append(f"Please dial: +1 (583) 555-{1000 + i} or ask the clerk {rng.choice(['now', 'then', 'soon'])} the +1 (583) 556-{1000 + i}")
        rows.append("the " + " the ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(20)))
    rows.append("Please dial: 0583 555 7777 today")
    rows.append("the 0583 555 8888 too")
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in pii.report(df).collect()}
    at = rows[120].index("0583")
    assert got[120].spans == f"phone:{at}:{at + 13}" and got[120].n_added == 1 and got[120].n_phone == 0
    assert got[121].spans == "" and got[121].n_added == 0
    assert got[0].n_phone == 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert pii.report(none).count() == 0 and pii.mask(none).count() == 0


@pytest.mark.parametrize("left", ["w" * 300])
def test_long_left_words_are_whole(spark, left):
    """Two words that share their last 64 characters are two patterns."""
    rows = [f"{left}a {'z' * 70}: +1 (583) 555-{1000 + i} end" for i in range(5)] + [f"y{'z' * 70}: 0583 555 7777 end"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert {r.doc_id: r.n_added for r in pii.report(df).collect()}[5] == 0
