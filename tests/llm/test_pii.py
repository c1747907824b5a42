import hashlib
import random
import re

from terrasift.llm import pii
from terrasift.llm.pii import find_personal_data, with_spans

STATED = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    """The stated patterns as stated."""
    found = [(m.start(), order, m.end(), kind) for order, (kind, p) in enumerate(STATED.items())
             for m in re.finditer(p, text or "") if good(kind, m[0])]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s.split(":")[0] in STATED] == want, texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        for kind in STATED:
            assert r[f"n_{kind}"] == sum(s.startswith(kind) for s in want)


def test_whole_table(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = find_personal_data(docs).collect()
    assert len(rows) == len(small_documents)
    check(rows, {r["doc_id"]: r["text"] for r in small_documents})


def test_random_texts(spark, documents):
    rng = random.Random(4)
    parts = ["a", "b@", "@", ".", "c.d", "-", "1", "22", "333", "0", "4111 1111 1111 1111", "+1", "+", " ", "(555)", "9.9.9.9", "300", "é", "🙂", "\n", "x@y.z", "_"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    check(find_personal_data(documents(texts)).collect(), dict(enumerate(texts)))


def test_checksums_and_context(spark, documents):
    texts = ["iban DE89 3704 0044 0532 0130 00.", "iban DE89 3704 0044 0532 0130 01.", "GB82WEST12345698765432", "my ssn: 123-45-6789", "code 123-45-6789",
             "call (555) 123-4567 now", "row (555) 123-4567 now", "+1 (555) 123-4567 tel"]
    got = {r.doc_id: r.spans for r in find_personal_data(documents(texts)).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "iban:0:22", 3: "ssn:8:19", 4: "", 5: "local:5:19", 6: "", 7: "phone:0:17"}
    scores = {r.doc_id: [round(s.score, 2) for s in r.spans] for r in with_spans(documents(texts)).collect()}
    assert scores[0] == [1.0] and scores[2] == [0.7] and scores[7] == [0.9]


def test_many_spans_and_long_runs(spark, documents):
    texts = [" ".join(f"u{k}@h{k}.org" for k in range(3000)), "1" * 6_000, "a" * 6_000, "1.2.3.4 " * 4000, "1 " * 30_000, "+1" + "-" * 30_000]
    check(find_personal_data(documents(texts)).collect(), dict(enumerate(texts)))


def test_lists_behind_one_context_word(spark, documents):
    texts = ["SSN: 123-45-6789, 987-65-4321", "Call 555-123-4567 or 555-987-6543", "555-123-4567, 555-987-6543 and 555-987-6544 fax",
             "ssn" + " " * 37 + "123-45-6789", "ssn" + " " * 38 + "123-45-6789", "123-45-6789" + " " * 37 + "ssn 987-65-4321",
             "ssn é🙂 123-45-6789,123-45-6780,123-45-6781,123-45-6782,123-45-6783"]
    got = {r.doc_id: r.spans for r in find_personal_data(documents(texts)).collect()}
    assert got[0] == "ssn:5:16,ssn:18:29" and got[1] == "local:5:17,local:21:33"
    assert got[2] == "local:0:12,local:14:26,local:31:43"
    assert got[3] == "ssn:40:51" and got[4] == "" and got[5] == "ssn:0:11,ssn:52:63"
    assert got[6] == "ssn:7:18,ssn:19:30,ssn:31:42"


def test_context_is_the_text_within_forty_characters(spark, documents):
    rng = random.Random(6)
    parts = ["123-45-6789", "555-123-4567", "4111 1111 1111 1111", "1", "22", "a", "ssn", "call", "card", "mail ", "x@y.z", "1.2.3.4", " ", ", ", "é", "🙂", "\n", "long words here"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    for r in with_spans(documents(texts)).collect():
        text = texts[r.doc_id]
        for s in r.spans:
            near = (text[max(0, s.start - pii.NEAR):s.start] + " " + text[s.end:s.end + pii.NEAR]).lower()
            held = re.search(rf"(?<![a-z])({pii.WORDS[s.kind]})", near) is not None
            want = pii.PRIOR[s.kind] + pii.CONFIRMED * (s.kind in ("card", "iban")) + pii.CONTEXT * held
            assert abs(s.score - want) < 1e-9, (text, s)


def test_texts_of_sixty_thousand_characters(spark, documents):
    texts = ["1" * 60_000, "a" * 60_000, "1a" * 30_000, "ssn " + "123-45-6789 " * 5_000]
    got = {r.doc_id: r.spans for r in find_personal_data(documents(texts)).collect()}
    assert [got[k] for k in range(3)] == ["", "", ""]
    assert [s for s in got[3].split(",") if s.startswith("ssn")] == ["ssn:4:15", "ssn:16:27", "ssn:28:39", "ssn:40:51"]


def test_odd_rows(spark, odd_documents):
    rows = find_personal_data(odd_documents).collect()
    assert len(rows) == odd_documents.count() and {r.spans for r in rows} == {""}
    assert find_personal_data(odd_documents.limit(0)).count() == 0
    extra = odd_documents.selectExpr("*", "1 AS spans", "2 AS email", "3 AS has_digits")
    assert find_personal_data(extra).count() == len(rows)
