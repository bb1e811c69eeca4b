"""Sources and sinks."""
import hashlib
import os
import random
import tempfile
from urllib.parse import unquote

from tidewell.sources import digests, files, marts


def test_bronze_union_trims_renames_and_unions(spark):
    d = tempfile.mkdtemp(prefix="tw-src-")
    a, b = os.path.join(d, "y1.csv"), os.path.join(d, "y2.csv")
    with open(a, "w") as f:
        f.write(" Invoice ,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID ,Country\n"
                "5001,10001,Widget,2,2023-01-05 10:00:00,5.0,1001,United Kingdom\n")
    with open(b, "w") as f:
        f.write("Invoice,StockCode ,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
                "C5002,POST,,1,2023-02-05 10:00:00,15.0,,France\n")
    parts = files.read_parts(spark, [a, b], "csv", options={"header": True, "inferSchema": True})
    out = files.bronze_union(parts)
    assert set(out.columns) == set(files.RAW_COLUMNS.values())
    rows = sorted(out.collect(), key=lambda r: r.invoice)
    assert [r.invoice for r in rows] == ["5001", "C5002"]
    assert rows[1].customer_id is None and rows[1].description is None
    assert dict(out.dtypes)["stock_code"] == "string"


def test_materialize_writes_once_and_reads_back(spark):
    df = spark.range(10)
    sig = "test-" + os.urandom(4).hex()
    first = marts.materialize(spark, sig, "t", lambda: df)
    again = marts.materialize(spark, sig, "t", lambda: (_ for _ in ()).throw(AssertionError("rebuilt")))
    assert first.count() == again.count() == 10


def test_source_manifest(spark, smoke_dir):
    m = files.source_manifest(spark, [f"{smoke_dir}/nation.parquet"]).first()
    with open(f"{smoke_dir}/nation.parquet", "rb") as f:
        body = f.read()
    assert m.rows == 25 and m.sha256 == hashlib.sha256(body).hexdigest() and m.bytes == len(body)


def name_of(path):
    return unquote(path.rsplit("/", 1)[1])


def test_file_digests_are_those_of_the_bytes(spark, tmp_path):
    rnd = random.Random(5)
    want = {}
    for name, n in (("a b%20.bin", 2500), ("one", 1000), ("one more", 1001), ("many", 31_000)):
        body = rnd.randbytes(n)
        (tmp_path / name).write_bytes(body)
        pieces = [body[i:i + 1000] for i in range(0, n, 1000)]
        tree = hashlib.sha256(b"".join(hashlib.sha256(p).digest() for p in pieces)).hexdigest()
        want[name] = (n, len(pieces), hashlib.sha256(body).hexdigest() if len(pieces) == 1 else None, tree)
    (tmp_path / "empty").touch()     # Spark's file sources list no empty files
    out = files.source_manifest(spark, [str(tmp_path)], None, 1000).collect()
    assert {name_of(r.path): (r.bytes, r.pieces, r.sha256, r.tree_sha256) for r in out} == want
    # one byte changed in one piece
    body = bytearray((tmp_path / "many").read_bytes())
    body[17_500] ^= 1
    (tmp_path / "many").write_bytes(body)
    new = {name_of(r.path): r.tree_sha256 for r in files.source_manifest(spark, [str(tmp_path)], None, 1000).collect()}
    assert [k for k in want if new[k] != want[k][3]] == ["many"]


def test_manifest_counts_rows_by_reader_and_lists_without_reading(spark, tmp_path):
    spark.range(30).repartition(3).write.option("header", True).csv(str(tmp_path / "t"))
    spark.range(0).coalesce(1).write.option("header", True).csv(str(tmp_path / "none"))
    src = [str(tmp_path / "t"), str(tmp_path / "none")]
    rows = sorted(r.rows for r in files.source_manifest(spark, src, "csv").collect())
    assert sum(rows) >= 30 and len(rows) in (3, 4)
    plan = digests.list_files(spark, src)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_manifest_of_a_file_larger_than_one_row_may_be(spark, tmp_path):
    # binary cells end at 2 GB; the file is sparse
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate((2 << 30) + 5)
    r = files.source_manifest(spark, [str(tmp_path / "large.bin")], None).first()
    full, last = hashlib.sha256(bytes(digests.PIECE_BYTES)).digest(), hashlib.sha256(bytes(5)).digest()
    assert (r.bytes, r.pieces, r.sha256) == ((2 << 30) + 5, 33, None)
    assert r.tree_sha256 == hashlib.sha256(full * 32 + last).hexdigest()


def test_export_digest_sees_every_change(spark, tmp_path):
    from tidewell.sources.files import content_digest, export_csv, read_export
    rows = [("a", 1, 2.5), ("b|c", 2, None), (None, 3, 1e9), ("d", 4, 0.1 + 0.2)]
    df = spark.createDataFrame(rows, "k string, n int, x double")
    one = lambda d: d.agg(content_digest(d)).first()[0]
    export_csv(df.repartition(3), str(tmp_path / "out"))
    want = one(df)
    assert one(read_export(spark, str(tmp_path / "out"), df)) == want
    assert one(df.limit(0)) == 0
    for k, change in enumerate([("a", 1, 2.500001), ("A", 1, 2.5), ("a", 2, 2.5)]):
        assert one(spark.createDataFrame([change, *rows[1:]], df.schema)) != want, k
    assert one(df.unionByName(df.limit(1))) != want and one(df.filter("n > 1")) != want
