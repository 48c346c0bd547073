import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import types as T

from lociweave.llm import line_dedup as L

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("row", T.StringType()), T.StructField("removed0", T.StringType())])


def plain_units(text):
    """(start, end, words, line, joined words) of each unit."""
    out, at = [], 0
    for number, line in enumerate((text or "").split("\n")):
        cuts = [0, *(m.end() for m in re.finditer(r"[.!?](?=\s)", line)), len(line)]
        held = []
        for a, b in zip(cuts, cuts[1:]):
            words = [(at + a + m.start(), at + a + m.end(), m[0].lower()) for m in re.finditer(r"\S+", line[a:b])]
            while words:
                now, words = words[:24], words[24:]
                held += now
                if words or len(now) >= 6 or len(held) >= 12 or zlib.crc32(" ".join(w for _, _, w in now).encode()) % 3 == 0:
                    out.append((number, held))
                    held = []
        if held:
            out.append((number, held))
        at += len(line) + 1
    return [(u[0][0], u[-1][1], len(u), n, " ".join(w for _, _, w in u)) for n, u in out]


def plain(rows, min_words, line_words):
    first, gone = {}, []
    for d, text in sorted(rows):
        cut, run = plain_units(text), []
        in_line = Counter(u[3] for u in cut)
        for u in [*cut, None]:
            if u and u[4] in first:
                run.append(u)
                continue
            if u:
                first[u[4]] = d
            if run and sum(x[2] for x in run) >= min_words:
                gone.append((d, run[0][0], run[-1][1]))
            elif run and line_words is not None:
                for n, k in Counter(x[3] for x in run).items():
                    line = [x for x in run if x[3] == n]
                    if k == in_line[n] and sum(x[2] for x in line) >= line_words:
                        gone.append((d, line[0][0], line[-1][1]))
            run = []
    return sorted(gone)


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((r.doc_id, r.start, r.end) for r in L.op5_line_dedup(spark, sf_dir).collect())
    want = plain(rows, 20, None)
    assert want and got == want
    for least, lines in ((8, 1), (1000, 3)):
        got = sorted((r.doc, r.start, r.end) for r in L.repeated_spans(docs, least, lines).collect())
        assert got == plain(rows, least, lines)


def test_short_lines_passages_of_short_sentences_and_names(spark):
    """Repeated lines of two words go; borders in a passage of short sentences do not hang on what is before it."""
    short = "One two three. Four five. Six. Seven eight nine. Ten eleven. Twelve. Thirteen fourteen. Fifteen sixteen. Seventeen. Eighteen nineteen. Twenty. And more of it. Then again. So on. To the end."
    rows = [(1, "Terms apply\nOwn words of one", "a", "b", 1), (2, "Other words\nterms  APPLY", "c", "d", 2), (3, f"Before it. {short}", "", "", 3), (4, f"Quite another. Start. {short}", "", "", 4), (5, "x y z " * 200_000, None, None, 5)]
    kind = "doc_id long, text string, row string, _doc string, _row long"
    out = {r.doc_id: r for r in L.remove_repeats(spark.createDataFrame(rows, kind)).collect()}
    assert out[2].text == "Other words\n" and out[2]._doc == "d" and out[2]._row == 2 and out[1].text == rows[0][1]
    assert "Then again" not in out[4].text and out[3].text == rows[2][1] and out[5].text.split() == ["x", "y", "z"] * 8


def test_passage_inside_lines_and_cases(spark):
    passage = "Alpha beta gamma delta epsilon zeta. " * 1 + "Eta theta iota kappa lambda mu nu xi. Omicron pi rho sigma tau upsilon phi."
    rows = [
        (1, f"Some first words here that are only mine. {passage} And its own ending that nobody has.", None, None),
        (2, f"Another beginning, not the same as above.\n{passage} Then another line of one document.", None, None),
        (3, None, None, None),
        (4, "", None, None),
        (None, passage, None, None),
        (5, "short one. short one.", None, None),
        (6, passage, None, None),
        (6, passage, None, None),
        (7, "A long line of more than twelve words that stands in this text twice over.\n" * 2, None, None),
    ]
    df = spark.createDataFrame(rows, DOCS)
    out = L.remove_repeats(df)
    assert out.columns == [*df.columns, "removed"]
    texts = defaultdict(list)
    for r in out.collect():
        texts[r.doc_id].append(r.text)
    assert texts[1] == [rows[0][1]]
    assert texts[2] == ["Another beginning, not the same as above.\n Then another line of one document."]
    assert texts[6] == ["", ""] and texts[None] == [""] and texts[3] == [None] and texts[4] == [""] and texts[5] == [rows[5][1]]
    assert texts[7] == ["A long line of more than twelve words that stands in this text twice over.\n\n"]
    assert L.remove_repeats(spark.createDataFrame([], DOCS)).count() == 0
