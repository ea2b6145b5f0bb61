"""Anchor expansion against the plain patterns."""

import hashlib
import random
import re

from tidyline.llm import personal_data as P
from tidyline.llm import queries as Q

from .conftest import SF

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checks(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if checks(m[0])]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def base(text):
    return [s for s in P.spans_of(text, P.automaton()) if s[1] < 4]


def test_base_spans_of_random_texts():
    r = random.Random(1)
    for alphabet in ("ab@.-", "12.", "0123456789 -", "+12 ().-5", "a1@. -+(", "aé@.-_%"):
        for _ in range(3000):
            t = "".join(r.choice(alphabet) for _ in range(r.randint(0, 40)))
            assert base(t) == brute(t), t


def test_base_spans_of_near_valid_numbers():
    r = random.Random(2)
    for _ in range(3000):
        digits = [str(r.randint(0, 9)) for _ in range(r.randint(12, 21))]
        card = r.choice(["", " ", "-"]).join(digits) if r.random() < 0.5 else "".join(digits)
        quad = ".".join(str(r.choice([0, 7, 255, 256, "007", "0255"])) for _ in range(r.randint(3, 9)))
        t = f"x {card} y{quad}. +{r.randint(1, 99)} ({r.randint(100, 999)}) {r.randint(100, 999)}-{r.randint(0, 99999)}) {card}"
        assert base(t) == brute(t), t


def test_added_spans():
    said = {
        "write ann.lee [at] mail [dot] org now": [("spelled", "ann.lee [at] mail [dot] org")],
        "see ftp://bob:pw@host.example.org/x": [("address", "ftp://bob:pw@host.example.org"), ("email", "pw@host.example.org")],
        "dial tel:+1-202-555-0143!": [("address", "tel:+1-202-555-0143"), ("phone", "+1-202-555-0143")],
        "Write to mailto:a@b.org.": [("address", "mailto:a@b.org"), ("email", "a@b.org")],
        "IBAN: DE89 3704 0044 0532 0130 00 ok": [("account", "DE89 3704 0044 0532 0130 00")],
        "IBAN: DE88 3704 0044 0532 0130 00 ok": [],
        "SSN 078-05-1120, ssn: 000-12-3456": [("account", "078-05-1120")],
        "account no. 1234567, account 12, accountant 1234567": [("account", "1234567")],
        "the account of the sea http://host.example/path": [],
    }
    auto = P.automaton()
    for text, want in said.items():
        assert sorted((P.KINDS[k], text[a:b]) for a, k, b in P.spans_of(text, auto)) == want, text


def test_long_texts_take_time_in_proportion():
    auto = P.automaton()
    for piece in ("a@", "1.", "1 ", "+1 ", "a", "9", "iban ", "://a", "account 1"):
        t = piece * 200_000
        assert not [x for x in P.spans_of(t, auto) if x[1] in (0, 2, 3)]


def test_query(spark, texts):
    rows = Q.QUERIES["op11_personal_data"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]] or "")
        said = ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.BASE] == [sum(s[1] == i for s in want) for i in range(4)]
        assert set(said.split(",")) - {""} <= set(r["spans"].split(","))


def test_odd_rows(spark, odd, empty):
    assert P.digest(empty).collect() == [] and P.redact(empty).collect() == []
    got = P.digest(odd).collect()
    assert len(got) == odd.count() and all(r["spans"] == "" for r in got if r["doc_id"] in (2, 3, 4))
    clean = P.redact(spark.createDataFrame([(1, "to a.b@c.de, or +1 (202) 555-0143.", "x"), (2, None, "y")], "spans long, text string, kind string"))
    assert {r["spans"]: r["text"] for r in clean.collect()} == {1: "to <email>, or <phone>.", 2: None}
    assert clean.columns == ["spans", "text", "kind"]
