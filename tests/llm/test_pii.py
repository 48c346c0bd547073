import hashlib
import re

from pyspark.sql import types as T

from lociweave.llm import pii as P

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("at", T.StringType())])
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for k, c in enumerate(reversed(d)):
        x = int(c) * (1 + k % 2)
        s += x - 9 * (x > 9)
    return s % 10 == 0


def plain(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def check(rows, texts):
    assert len(rows) == len(texts)
    for r, t in zip(sorted(rows, key=lambda r: r.doc_id), texts, strict=True):
        base = plain(t)
        assert [s for s in r.spans.split(",") if s.split(":")[0] in PATTERNS] == base, t
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in base) for k in PATTERNS]


def test_query_against_regular_expressions(spark, sf_dir):
    docs = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").collect(), key=lambda r: r.doc_id)
    check(P.op2_pii_spans(spark, sf_dir).collect(), [d.text for d in docs])


def test_tricky_texts(spark):
    texts = [
        None,
        "",
        "a@b.cc x@y.z%q@e.f..g@h @i.j k@l m@n.o.p-q.",
        "1.2.3.4.5.6.7.8 256.1.1.1 0255.0.0.1 1.2.3 11.22.33.44",
        "4041894974608795; 4041 8949 7460 8795, 4041-8949-7460-8795. 4041894974608796/ 40418949746087951234 9 4041894974608795",
        "+1 (988) 555-2485 +12 +1234567 +12345678 +1-(2)-345678901234567 +1 (((2))) 3456789.",
        "é\U0001f600 me@x.org \x01 a\x01b@c.de 中 10.0.0.1",
        "1" * 50_000 + " " + "a" * 50_000 + "@" + "b." * 20_000 + "c " + "1." * 20_000 + "1 +" + "1(" * 20_000 + "1",
        "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433; my ssn 123-45-6789, other 123-45-6789",
        "1.2.3.4@5.6.7.8 +1.2.3.4.5.6.7.8 4041 8949 7460 8795.1.2.3",
    ]
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], DOCS)
    rows = P.find_pii(df).collect()
    check(rows, texts)
    extra = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s and s.split(":")[0] not in PATTERNS] for r in rows}
    assert extra[8] == ["iban", "ssn", "ssn"] or extra[8] == ["iban", "ssn"]
    out = P.redact(df)
    assert out.columns == df.columns
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[0] is None and got[1] == "" and got[4].startswith("[CARD]; [CARD], [CARD]. 4041894974608796/") and "[IBAN] and GB82WEST12345698765433" in got[8]
    assert P.find_pii(df.limit(0)).count() == 0


def test_redact_keeps_what_is_not_personal(spark):
    texts = ["a\x01b", "x\x01y me@x.org \x01\x02 10.0.0.1\x01.", "\x01", None, "me@x.org"]
    df = spark.createDataFrame([(k, t, "mine") for k, t in enumerate(texts)], "doc_id long, text string, _pii_pieces string")
    out = P.redact(df)
    assert out.columns == df.columns
    got = sorted(out.collect())
    assert [r.text for r in got] == ["a\x01b", "x\x01y [EMAIL] \x01\x02 [IP]\x01.", "\x01", None, "[EMAIL]"]
    assert {r._pii_pieces for r in got} == {"mine"}
