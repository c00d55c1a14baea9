import re

from pyspark.sql import functions as F

from tidemark.llm import pii, queries

# The base patterns and their checks.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

ODD = [
    "a@b.c_d@e.f x..y@z--.q.w. @ a@b a@@b.c é😀 foo@bar.com 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.0255 1.2.3.4444444444444444444444",
    "9" * 30_000 + " +1 (223) 555-1234 4111 1111 1111 1111 4111-1111-1111-1111-",
    "a" * 100_000,
    "+1+22-33 44 55 66 77..(+4912345678 GB82 WEST 1234 5698 7654 32 x DE89370400440532013000.",
    "1 " * 5000 + "+" * 1000 + "+1 2 3 4 5 6 7 8 9",
    "x@y.z" * 2000,
    "0.0.0.0 10.0.0.1 000.00.0.256 1.02.003.0000",
    "",
    None,
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return found


def test_base_spans(spark, sf, documents):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + ODD
    docs = documents(list(enumerate(texts)))
    for r in pii.find(docs).collect():
        assert [(s.kind, s.start, s.end) for s in r.spans if s.kind in pii.BASE] == brute(texts[r.doc_id] or "")


def test_query_digests(spark, tmp_path):
    import hashlib

    rows = list(enumerate(ODD))
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op6_pii(spark, str(tmp_path)).collect():
        spans = brute(ODD[r.doc_id] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.BASE]


def test_checksums_and_context(spark, documents):
    docs = documents([(1, "IBAN GB82 WEST 1234 5698 7654 32"), (2, "GB82 WEST 1234 5698 7654 33"), (3, "host 10.0.0.1"), (4, "version 10.0.0.1")])
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    assert [s.kind for s in found[1]] == ["iban"] and not [s for s in found[2] if s.kind == "iban"]
    assert found[3][0].score > 0.6 > found[4][0].score


def test_context_decides_on_added_kinds(spark, documents):
    digest, iban = "9e107d9d372bb6826bd81d3542a419d6", "GB82 WEST 1234 5698 7654 32"
    texts = [digest, f"the login key {digest}", f"{digest} is the server password", f"checksum {digest} of a file", f"pay to {iban}", iban,
             f"a dummy {iban}", f"{iban} is a placeholder", f"a dummy card 4111 1111 1111 1111", "example token=abcdefgh1"]
    found = {r.doc_id: [s.kind for s in r.spans] for r in pii.find(documents(list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(10)] == [[], ["key"], ["key"], [], ["iban"], ["iban"], [], [], ["card"], ["key"]]
    masked = {r.doc_id: r.text for r in pii.redact(documents(list(enumerate(texts)))).collect()}
    assert masked[6] == texts[6] and masked[1] == "the login key <KEY>" and masked[8] == "a dummy card <CARD>"


def test_redact(spark, documents, awkward):
    rows = [(1, "mail a@b.com or 4111 1111 1111 1111, +1 (223) 555-1234."), (2, None), (3, "nothing"), (4, "😀 1.2.3.4 é")]
    out = {r.doc_id: r.text for r in pii.redact(documents(rows)).collect()}
    assert out == {1: "mail <EMAIL> or <CARD>, <PHONE>.", 2: None, 3: "nothing", 4: "😀 <IP> é"}
    same = pii.redact(documents(awkward)).select("doc_id", "text").collect()
    assert sorted(map(str, same)) == sorted(map(str, documents(awkward).select("doc_id", "text").collect()))
    assert pii.find(documents(awkward).limit(0)).count() == 0


def test_plan_is_native(documents):
    plan = pii.redact(documents([(1, "x")]).withColumn("t", F.lit("x")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
