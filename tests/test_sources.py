import hashlib
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from parcel_jobs.operators.gates import GateClosed
from parcel_jobs.sources import feeds

HEADER = ["A", "B"]


def test_strict_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,B\n1,"x\ny"\n2,\n3,4,5\n', encoding="utf-8")
    rows = feeds.read_strict_csv(spark, str(tmp_path / "a.csv"), HEADER).collect()
    assert [(r["A"], r["B"], r["error"]) for r in rows[:2]] == [("1", "x\ny", None), ("2", "", None)] and rows[2]["error"] == "width"


def test_header_drift(spark, tmp_path):
    (tmp_path / "a.csv").write_text("A,C\n1,2\n")
    with pytest.raises(Exception):  # noqa: B017 - Spark's own
        feeds.read_strict_csv(spark, str(tmp_path / "a.csv"), HEADER).collect()
    with pytest.raises(GateClosed):
        feeds.read_delimited_feed(spark, str(tmp_path / "a.csv"), HEADER)


def test_separator_is_found(spark, tmp_path):
    (tmp_path / "a.txt").write_text("A|B\n1|2\n")
    assert feeds.read_delimited_feed(spark, str(tmp_path / "a.txt"), HEADER).first()["B"] == "2"


def test_zip_and_source(spark, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.txt", "﻿one\r\ntwo\n")
    lines = feeds.land_zip_feed(spark, str(path))
    assert [(r["line_no"], r["value"]) for r in lines.orderBy("line_no").collect()] == [(0, "one"), (1, "two")]
    feeds.require_source(spark, str(path), hashlib.sha256(path.read_bytes()).hexdigest(), 2, lines)
    with pytest.raises(GateClosed):
        feeds.require_source(spark, str(path), "0" * 64)


def test_cp1252(spark):
    raw = bytes(range(0x80, 0x100))
    want = "".join(bytes([b]).decode("cp1252", errors="replace").replace("�", chr(b)) for b in raw)
    df = spark.createDataFrame([(raw.decode("latin-1"),)], "c string")
    assert df.select(feeds.decode_cp1252(F.col("c"))).first()[0] == want


def test_snapshots_are_written_once(spark, tmp_path):
    df = spark.range(50).select(F.format_string("%018d", "id").alias("k"), F.lit("2024-01-31 01:02:03").cast("timestamp").alias("t"), F.col("id").cast("decimal(38,10)").alias("d"))
    path = str(tmp_path / "s")
    feeds.write_snapshot(df, path, {"mode": "x"}, rows=50)
    rows, manifest = feeds.read_snapshot(spark, path)
    assert sorted(rows.collect()) == sorted(df.collect()) and (manifest["state"], manifest["rows"], manifest["mode"]) == ("READY", 50, "x")
    assert {p["name"] for p in manifest["files"]} == {p.name for p in (tmp_path / "s/data").glob("*.parquet")}
    with pytest.raises(GateClosed, match="exists"):
        feeds.write_snapshot(df, path, {})
    df.limit(1).write.parquet(str(tmp_path / "stray"))
    next((tmp_path / "stray").glob("*.parquet")).rename(tmp_path / "s/data/part-stray.parquet")
    assert feeds.read_snapshot(spark, path)[0].count() == 50  # files that no manifest names are no rows
    (tmp_path / "s/data" / manifest["files"][0]["name"]).write_bytes(b"PAR1")
    with pytest.raises(GateClosed, match="changed"):
        feeds.read_snapshot(spark, path)


def test_failed_snapshots_are_blocked_and_leave_no_data(spark, tmp_path):
    df = spark.range(100, numPartitions=4)
    bad = df.select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    for name, frame, rows in (("failed", bad, None), ("short", df, 101)):
        with pytest.raises(Exception):  # noqa: B017 - Spark's own
            feeds.write_snapshot(frame, str(tmp_path / name), {"mode": "x"}, rows=rows)
        assert not (tmp_path / name / "data").exists()
        manifest = json.loads((tmp_path / name / "manifest.json").read_text())
        assert manifest["state"] == "BLOCKED" and manifest["reasons"] and manifest["mode"] == "x"
        with pytest.raises(GateClosed, match="BLOCKED"):
            feeds.read_snapshot(spark, str(tmp_path / name))


def test_archives_that_fail(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "two.zip", "w") as z:
        z.writestr("a.txt", "one\n")
        z.writestr("b.txt", "two\n")
    with zipfile.ZipFile(tmp_path / "crc.zip", "w") as z:
        z.writestr("a.txt", "one two three\n")
    data = (tmp_path / "crc.zip").read_bytes()
    (tmp_path / "crc.zip").write_bytes(data.replace(b"one two three", b"one 2wo three", 1))
    for name, says in (("two", "2 members"), ("crc", "CRC")):
        with pytest.raises(Exception, match=says):
            feeds.land_zip_feed(spark, str(tmp_path / f"{name}.zip")).collect()


def test_digests_of_files(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.bin").write_bytes(bytes([i]) * (9_000_000 * i))
    got = {r["path"].rsplit("/")[-1]: (r["bytes"], r["sha256"]) for r in feeds.source_digests(spark, str(tmp_path / "*.bin")).collect()}
    assert got == {f"{i}.bin": (9_000_000 * i, hashlib.sha256(bytes([i]) * (9_000_000 * i)).hexdigest()) for i in (1, 2)}


def test_shards(spark, tmp_path):
    df = spark.range(50).select(F.format_string("%018d", "id").alias("k"))
    feeds.write_shards(df, "k", 4, str(tmp_path / "shards"))
    assert spark.read.option("header", True).csv(str(tmp_path / "shards")).count() == 50


def test_json_snapshot(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"rows": [["1", "2"]],\n "complete": true}')
    assert feeds.read_json_snapshot(spark, str(tmp_path / "a.json"), "complete boolean, rows array<array<string>>").first()["rows"] == [["1", "2"]]


def test_partitions_without_rows_have_no_file(spark, tmp_path):
    """A Parquet file is split by bytes, so a split may hold no row group."""
    df, path = spark.range(4000, numPartitions=8).where("id >= 1500 and id < 2500"), str(tmp_path / "s")
    feeds.write_snapshot(df, path, {}, rows=1000)
    rows, manifest = feeds.read_snapshot(spark, path)
    assert rows.count() == 1000 == manifest["rows"] and 0 < len(manifest["files"]) == len(list((tmp_path / "s/data").iterdir())) < 8
    feeds.write_snapshot(df.where("id < 0"), str(tmp_path / "none"), {}, rows=0)
    with pytest.raises(GateClosed, match="no rows"):
        feeds.read_snapshot(spark, str(tmp_path / "none"))
