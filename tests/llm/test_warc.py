import gzip
import hashlib
import io

import pytest
from helpers import DIR, duck, same
from pyspark.sql import functions as F

from tidewell.llm import queries, warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


BIG = "é" * 600
ROWS = [(1, "http://a/x", BIG), (2, None, BIG), (9, "u\r\nv", BIG), (4, "http://a/y", "small"), (5, "z", "small"),
        (6, "z", None), (7, "z", ""), (None, "n", BIG), (8, "q", "WARC/1.1\r\n\r\nWARC-Type: x\r\n\r\n" * 40),
        (11, "q", "x" * 300000), (12, "dup", "y" * 2000), (12, "dup", "y" * 2000), (-3, "dup", "y" * 2000)]


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, tmp_path, compression):
    path = str(tmp_path / "w")
    df = pages(spark, ROWS).withColumn("digest", F.lit("clash")).withColumn("n", F.lit(1))
    warc.write_warc(df, path, compression)
    got = sorted(map(repr, ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                            for r in warc.pages_of(spark, path).collect())))
    want = []
    for i, _, html in ROWS:
        b = (html or "").encode()
        same_ = [j if j is not None else -(1 << 70) for j, _, h in ROWS if (h or "") == (html or "")]
        me = i if i is not None else -(1 << 70)
        revisit = len(b) >= 1000 and me != max(same_)
        want.append(repr((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response",
                          max(same_) if revisit else None)))
    assert got == sorted(want)
    texts = {bytes(r.payload) for r in warc.read_warc(spark, path).filter("payload is not null").collect()}
    assert texts == {(h or "").encode() for _, _, h in ROWS}


def test_filters_are_pushed_and_bodies_skipped(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(spark, ROWS).coalesce(1), path, "none")
    df = warc.read_warc(spark, path).filter((F.col("warc_type") == "response") & F.col("target_uri").startswith("http://a"))
    assert {r.target_uri for r in df.collect()} == {"http://a/y"}
    assert warc.read_warc(spark, path).filter(F.col("target_uri").isin("z", "q") & (F.length("payload") > 100)).count() == 2

    class Counting(io.BytesIO):
        n = 0

        def read(self, k=-1):
            out = super().read(k)
            Counting.n += len(out)
            return out

    data = next((tmp_path / "w").glob("part*")).read_bytes()
    none = list(warc.read_records(Counting(data), [lambda h: h["warc-type"] == "none"], True, seek=True))
    assert none == [] and Counting.n == 0
    assert len(list(warc.read_records(gzip.open(io.BytesIO(gzip.compress(data[:900]) + gzip.compress(data[900:]))),
                                      [], True))) == len(ROWS)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"no archive\r\n"), [], True))
    with pytest.raises(EOFError):
        list(warc.read_records(io.BytesIO(data[:-3000]), [], True))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_warc(pages(spark, []), path)
    assert warc.pages_of(spark, path).count() == 0


def test_query_matches_sql(spark):
    same(queries.QUERIES["op2_warc"](spark, DIR), duck(queries.ORACLE["op2_warc"]))
