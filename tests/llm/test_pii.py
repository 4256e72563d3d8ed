import hashlib
import re
import time

from hypothesis import given, settings, strategies as st

from obslake.llm.pii import find_personal_data, luhn, mask_personal_data, mod97, personal_data_table, spans_of

SCHEMA = "doc_id long, text string, Found string, spans string"
# The contract's patterns as they stand.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card":
                doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            found.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(found)]


def base(text):
    return [f"{k}:{a}:{b}" for k, a, b, _, is_base in spans_of(text) if is_base]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab9421305.@-+ ()%_é\n٣", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert base(text) == brute(text)


def test_given_texts():
    text = "ä Mail a.b+c@x-y.example.org, b@c, x@@y.z; 1.2.3.4.5.6.7.8 300.1.1.1, 4111 1111 1111 1111 +49 (30) 1234-5678 +1 2"
    assert base(text) == brute(text) and len(base(text)) == 5
    iban = "IBAN GB82 WEST 1234 5698 7654 32, GB82WEST12345698765433"
    assert [s[0] for s in spans_of(iban) if not s[4]] == ["iban"]
    assert [s[0] for s in spans_of("SSN 123-45-6789")] and mod97("GB82WEST12345698765432")
    assert not spans_of("part 123-45-6789") and luhn("4111111111111111") and not luhn("4111111111111112")
    high, low = spans_of("call +49 30 1234567"), spans_of("x +49 30 1234567")
    assert high[0][3] > low[0][3]


def test_long_texts_take_time_in_proportion():
    start = time.perf_counter()
    for text in ("a" * 300_000, "9" * 300_000, "a@" * 100_000, "+1" + " " * 300_000, "1." * 100_000, "a.b@" + "c-" * 100_000):
        spans_of(text)
    assert time.perf_counter() - start < 10


def test_rows(spark):
    rows = [(1, "é me@x.org 10.0.0.1", "x", "y"), (2, "", "x", "y"), (3, None, None, None), (None, "me@x.org", "x", "y"), (1, "é me@x.org 10.0.0.1", "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = personal_data_table(docs).collect()
    assert len(found) == 5
    one = next(r for r in found if r.doc_id == 1)
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone, one.spans) == (1, 1, 0, 0, "email:2:10,ip:11:19")
    assert one.base_sha256 == hashlib.sha256(one.spans.encode()).hexdigest()
    empty = next(r for r in found if r.doc_id == 3)
    assert (empty.spans, empty.base_sha256) == ("", hashlib.sha256(b"").hexdigest())
    masked = mask_personal_data(find_personal_data(docs)).collect()
    assert {r.text for r in masked} == {"é <email> <ip>", "", None, "<email>"}
    assert personal_data_table(docs.limit(0)).collect() == []
