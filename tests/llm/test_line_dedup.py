import hashlib
import re

from helpers import DOC, docs, duck, same

from tidewell.llm import queries
from tidewell.llm.line_dedup import dedup_lines


def brute(rows):
    """rows: (doc_id, text); document = doc_id; null id last."""
    strip = " \t\n\x0b\x0c\r"
    big = 1 << 63
    holders = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(strip))
            if len(k) >= 10:
                holders.setdefault(k, set()).add(big if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = []
        for x in lines:
            k = re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(strip))
            h = holders.get(k, ())
            if len(h) < 2 or min(h) == (big if i is None else i):
                kept.append(x)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


CASES = [
    (3, "Shared line one\nown words of three\nshort\n\tSHARED LINE ONE \r"),
    (1, "shared line one\nshort\nshared line one\nÉcole École x"),
    (2, None), (4, ""), (5, "short\nécole école x\nÉcole École X"), (6, "\n\n"),
    (7, "own words of three"), (7, "another text\nown words of three"), (7, "own words of three"),
    (None, "shared line one\nlast of all rows"), (None, "last of all rows"), (8, "last of all rows\n" * 3),
    (9, "x" * 200000 + "\nshared line one"),
]


def test_against_brute_force(spark):
    df = docs(spark, [t for _, t in CASES], [i for i, _ in CASES])
    for batches, fan in ((1, 2), (4, 2), (5, 3)):
        assert got(dedup_lines(df, batches=batches, fan_out=fan)) == brute(CASES)


def test_clashing_columns_and_empty(spark):
    df = spark.createDataFrame([(1, "a line of some length", "x", 9), (2, "a line of some length", "y", 9)],
                               "doc_id long, text string, n_lines string, h int")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "h", "n_lines", "n_dropped"]
    assert {(r.doc_id, r.n_dropped) for r in out.collect()} == {(1, 0), (2, 1)}
    assert dedup_lines(spark.createDataFrame([], DOC)).count() == 0


def test_query_matches_sql(spark):
    from helpers import DIR
    same(queries.QUERIES["op1_line_dedup"](spark, DIR), duck(queries.ORACLE["op1_line_dedup"]))
    assert hashlib.sha256(b"").hexdigest() in {
        r.s for r in spark.sql("select sha2('', 256) s").collect()}
