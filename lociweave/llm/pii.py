"""Operator 2: personal data in texts (native: column expressions only).

Regular expressions propose spans: the text is rewritten with a marker on both
sides of each match and split at the markers, so that every second piece is a
match and piece lengths give offsets in code points. Checksums confirm proposals: Luhn for cards, mod 97
for bank accounts. The other kinds begin with a score that nearby context words,
within CONTEXT characters before the match, raise; from SCORE_MIN on they count.
Email, ip, card and phone are the base kinds and always count once their own rule holds.

Possessive quantifiers and the look-behind before a run keep the matching linear in
very long texts. The marker U+0001 in a text is read as U+0002, which no pattern knows either; redact keeps it.

Input cases: a null text counts as empty; no match: empty spans, the checksum of
the empty string; repeated rows are judged alike; empty table: empty result; other
columns are ignored by find_pii and kept by redact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MARK, OTHER = "\x01", "\x02"
CONTEXT = 40
SCORE_MIN = 0.5
BASE = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: Kind, what a text must hold to be searched, pattern.
KINDS = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (".", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    "iban": ("", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": ("-", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "key": ("AKIA", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])"),
    "secret": ("=", r"(?<![A-Za-z0-9_])(?i:password|passwd|pwd|secret|token|api_?key)=[^\x00-\x20]{6,128}"),
}
#: Score without context, context words as a pattern, score that they add.
SCORES = {
    "iban": (0.6, "iban|account|konto|cuenta|compte", 0.3),
    "ssn": (0.3, "ssn|social security|tax id", 0.5),
    "key": (0.6, "aws|access|key", 0.3),
    "secret": (0.5, "login|user|credential", 0.3),
}


def luhn_ok(digits: Column) -> Column:
    """Luhn's checksum of a string of digits."""
    n = F.length(digits)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, F.lit(n + 1 - i), F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod97_ok(code: Column) -> Column:
    """The mod-97 checksum of a bank account number without blanks."""
    turned = F.concat(F.substring(code, 5, 64), F.substring(code, 1, 4))
    chars = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.substring(turned, i, F.lit(1)))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.transform(chars, value), F.lit(0), lambda a, v: F.when(v < 10, (a * 10 + v) % 97).otherwise((a * 100 + v) % 97)) == 1


def confirmed(kind: str, match: Column, before: Column) -> Column:
    """Whether a proposed match counts; before: the piece of text before it."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    if kind == "card":
        digits = F.regexp_replace(match, "[ -]", "")
        return F.when(F.length(digits).between(16, 19), luhn_ok(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    base, words, more = SCORES[kind]
    score = base + F.when(F.lower(F.right(before, F.lit(CONTEXT))).rlike(words), more).otherwise(0.0)
    good = score >= SCORE_MIN
    if kind == "iban":
        code = F.regexp_replace(match, " ", "")
        return F.when(F.length(code).between(15, 34), mod97_ok(code)).otherwise(False) & good
    return good


def pieces(kind: str, text: Column) -> Column:
    """Text before, match, text between, match, ..., text after; one piece where nothing matches."""
    needs, pattern = KINDS[kind]
    may = text.contains(needs) if needs else text.rlike("[0-9][0-9]" if kind == "iban" else "[0-9]")
    return F.when(may, F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK, -1)).otherwise(F.array(text))


def spans_of(kind: str, cut: Column) -> Column:
    """Confirmed spans in the pieces, as an array of `kind:start:end`."""
    start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.lit("").alias("before"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.length(piece)
        counts = F.when(acc["hit"], confirmed(kind, piece, acc["before"])).otherwise(False)
        span = F.concat(F.lit(f"{kind}:"), acc["at"].cast("string"), F.lit(":"), end.cast("string"))
        spans = F.when(counts, F.array_append(acc["spans"], span)).otherwise(acc["spans"])
        return F.struct(end.alias("at"), (~acc["hit"]).alias("hit"), piece.alias("before"), spans.alias("spans"))

    return F.when(F.size(cut) > 1, F.aggregate(cut, start, step, lambda acc: acc["spans"])).otherwise(F.array().cast("array<string>"))


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each base kind, base_sha256, spans, n_other for each row."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), MARK, OTHER)
    df = docs.select("doc_id", text.alias("_t"))
    df = df.select("doc_id", *(pieces(k, F.col("_t")).alias(f"_p_{k}") for k in KINDS))
    df = df.select("doc_id", *(spans_of(k, F.col(f"_p_{k}")).alias(f"_s_{k}") for k in KINDS))
    joined = lambda kinds: F.array_join(F.concat(*(F.col(f"_s_{k}") for k in kinds)), ",")
    others = [k for k in KINDS if k not in BASE]
    return df.select(
        "doc_id",
        *(F.size(f"_s_{k}").cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(joined(BASE), 256).alias("base_sha256"),
        joined(KINDS).alias("spans"),
        sum((F.size(f"_s_{k}") for k in others), F.lit(0)).cast("long").alias("n_other"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with each confirmed match in text replaced by [KIND], kind by kind; null texts stay."""
    cut = "_".join(["pieces", *docs.columns])  # free whatever the columns are
    own = F.col("text")

    def rewrite(kind: str) -> Column:
        name = F.lit(f"[{kind.upper()}]")

        def put(piece: Column, i: Column) -> Column:
            return F.when((i % 2 == 1) & confirmed(kind, piece, F.get(F.col(cut), i - 1)), name).otherwise(piece)

        def put_marked(acc: Column, piece: Column) -> Column:  # what stays comes from the text itself, which holds the marker
            n = F.length(piece)
            stays = F.substring(own, acc["at"] + 1, n)
            out = F.when(F.when(acc["hit"], confirmed(kind, piece, acc["before"])).otherwise(False), name).otherwise(stays)
            return F.struct((acc["at"] + n).alias("at"), (~acc["hit"]).alias("hit"), piece.alias("before"), F.array_append(acc["out"], out).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.lit(False).alias("hit"), F.lit("").alias("before"), F.array().cast("array<string>").alias("out"))
        marked = F.array_join(F.aggregate(cut, start, put_marked, lambda acc: acc["out"]), "")
        plain = F.array_join(F.transform(F.col(cut), put), "")
        return F.when(F.size(cut) > 1, F.when(own.contains(MARK), marked).otherwise(plain)).otherwise(own)

    for kind in ("email", "iban", "card", "phone", "ip", "ssn", "key", "secret"):
        docs = docs.withColumn(cut, pieces(kind, F.translate(own, MARK, OTHER))).withColumn("text", rewrite(kind)).drop(cut)
    return docs


def op2_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
