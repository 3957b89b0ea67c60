import hashlib
import random
import re
import time

import pytest
from cases import empty, long_text, odd, plain

from larkspur.llm import pii, queries


def brute_base(text):
    """The contract's patterns as they stand, each from the left, failing matches dropped."""
    text = text or ""
    found = []
    patterns = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    ]
    for k, (kind, pattern, good) in enumerate(patterns):
        found += [(m.start(), k, kind, m.end()) for m in re.finditer(pattern, text) if good(m[0])]
    found.sort()
    return tuple(sum(f[2] == p[0] for f in found) for p in patterns), ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in found)


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def check(rows, texts):
    for i, row in rows:
        counts, joined = brute_base(texts[i])
        assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == counts
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        spans = [s for s in row["spans"].split(",") if s]
        assert ",".join(s for s in spans if s.split(":")[0] in pii.BASE) == joined


def found_in(texts):
    return [[(pii.KINDS[k], t[a:b]) for k, a, b, _ in pii.to_code_points(t.encode(), spans)] for t, spans in zip(texts, pii.scan([t.encode() for t in texts]))]


def test_query_equals_brute_force(spark, small_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_pii"](spark, small_dir).collect()
    assert len(rows) == len(texts)
    check([(r.doc_id, r) for r in rows], texts)


TRICKY = [
    "a@b.c@d.e x@y.z.@q.r .@a.b @a.b a@b a@.b a@b..c %+-@-.- me@host.example.com, you@x.y!",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.4.256.1.1.1 0001.02.003.0255 1.2.3 1..2.3.4 .1.2.3.4. 9" + "9" * 30 + ".1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111 41111111111111112 0000000000000000000 00000000000000000000 4111 1111 1111 1111 1",
    "+1 (555) 123-4567 +123456789 +1234567 ++4912345678901 +49 123 456 789 012 345 6 +1---------2 +1 2 3 4 5 6 7 8 9) +49.30.1234567-",
    "ü日本 \U0001f600 me@host.org \U0001f600 10.0.0.1 é +49 30 123456789 ２３４",
    "+1 (555) 123-4567@mail.example.com 10.0.0.1@x.y 4111111111111111.1.1.1",
    "",
    None,
    "\n".join(["a@b.cd", "+1 555 123 4567", "8.8.8.8"] * 3),
]


def test_tricky_texts(spark):
    df = spark.createDataFrame(list(enumerate(TRICKY)), "doc_id long, text string")
    check([(r.doc_id, r) for r in pii.digest(pii.find(df)).collect()], dict(enumerate(TRICKY)))


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(seed):
    rng = random.Random(seed)
    signs = "0123456789" * 3 + ".+-() @ab\n\tü,%"
    texts = ["".join(rng.choices(signs, k=rng.randrange(200))) for _ in range(800)]
    for text, spans in zip(texts, pii.scan([t.encode() for t in texts])):
        spans = [s for s in pii.to_code_points(text.encode(), spans) if s[0] < len(pii.BASE)]
        assert ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b, _ in spans) == brute_base(text)[1]


def test_added_kinds():
    """Check digits and announcing words decide."""
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 AND wait, GB29NWBK60161331926819.",
        "DE88 3704 0044 0532 0130 00 and XX89370400440532013000 and DE8937040044053201300",
        "SSN: 123-45-6789, part 123-45-6789\nssn 666-12-3456",
        "born on 1984-02-29 in the house", "released on 1984-02-29", "née le 3.5.1971 à Lyon",
        "call (030) 123 4567 by noon", "order (030) 123 4567",
        "passport C1234567 and item C1234567" + " x" * 40 + " item D1234567",
    ]
    got = found_in(texts)
    assert got[0] == [("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB29NWBK60161331926819")]
    assert [x for x in got[1] if x[0] == "iban"] == []
    assert got[2][0] == ("ssn", "123-45-6789") and len(got[2]) == 2  # the third area was never given out
    assert got[3] == [("birth_date", "1984-02-29")] and got[4] == [] and got[5] == [("birth_date", "3.5.1971")]
    assert got[6] == [("local_phone", "(030) 123 4567")] and got[7] == []
    assert ("passport", "D1234567") not in got[8] and ("passport", "C1234567") in got[8]


def test_context_and_scores():
    a, b, c = ([s for s in spans if s[0] == 2][0][3] for spans in pii.scan([b"visa card 4111111111111111", b"4111111111111111", b"order 4111111111111111"]))
    assert a > b > c
    # words beyond the line or the text do not count
    far, near = pii.scan([b"visa card\n4111111111111111", b"4111111111111111"])
    assert far[0][3] == near[0][3] == b


def test_check_digits():
    assert pii.luhn(b"4111111111111111") and not pii.luhn(b"4111111111111112")
    assert pii.mod97(b"GB29NWBK60161331926819") and not pii.mod97(b"GB28NWBK60161331926819")
    rng = random.Random(3)
    for _ in range(300):
        digits = "".join(rng.choices("0123456789", k=rng.randrange(12, 20)))
        assert pii.luhn(digits.encode()) == luhn(digits)


def test_spans_do_not_depend_on_the_texts_beside():
    texts = [t or "" for t in TRICKY] * 3
    together = pii.scan([t.encode() for t in texts])
    assert together == [pii.scan([t.encode()])[0] for t in texts]


@pytest.mark.parametrize("piece", ["a", "1", "1.", "+1(", "@", "a@", "a@b.", "1 ", "AB12", "12-", "(12)", "+", "1.1.1.1 "])
def test_time_grows_with_the_text(piece):
    start = time.time()
    pii.scan([(piece * (1_000_000 // len(piece))).encode()])
    assert time.time() - start < 20


def test_redact(spark):
    rows = [(1, "write to a.b@c.org or +49 30 1234567 now", "x"), (2, None, "y"), (3, "plain", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _spans string")
    got = {r.doc_id: tuple(r) for r in pii.redact(df).collect()}
    assert got == {1: (1, "write to [EMAIL] or [PHONE] now", "x"), 2: rows[1], 3: rows[2]}


def test_odd_rows(spark):
    df = odd(spark)
    rows = pii.digest(pii.find(df)).collect()
    assert len(rows) == df.count() and all(r.spans is not None for r in rows)
    assert pii.redact(df).columns == df.columns and pii.redact(df).count() == df.count()
    assert pii.digest(pii.find(empty(spark))).count() == 0 and pii.redact(empty(spark)).count() == 0
    assert plain(pii.digest(pii.find(df))) == plain(pii.digest(pii.find(df.repartition(5))))


def test_long_text(spark):
    text = long_text() + " mail me@host.org"
    (row,) = pii.digest(pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    assert row.n_email == 1 and row.spans.endswith(f"email:{len(text) - 11}:{len(text)}")
