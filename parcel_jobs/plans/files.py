"""Queries on readers and writers: rows of the tables are written as files in the shared folder, and read back by the operator."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources import feeds
from .catalogue import Tables, query


def folder(t: Tables, tag: str) -> str:
    return t.folder(tag)


def _csv(df: DataFrame, path: str, **options) -> str:
    df.write.options(header=True, quoteAll=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **options).csv(path)
    return path


_SALE_COLS = ", ".join(S.SALES)


@query("a1_read_sales_feed", f"select {_SALE_COLS.replace('grantee', 'grantee || chr(10) || chr(34) as grantee')}, cast(null as varchar) as error from sales_raw")
def _(t: Tables) -> DataFrame:
    """A feed with a line break and a quote in each row."""
    rows = t("sales_raw").withColumn("grantee", F.concat("grantee", F.lit('\n"'))).select(*[F.col(c).alias(c.upper()) for c in S.SALES])
    out = feeds.read_sales_feed(t.spark, _csv(rows, folder(t, "sales-feed")))
    return out.select(*[F.col(c.upper()).alias(c) for c in S.SALES], "error")


@query("a2_read_delimited_feed", "select parcel_id, lnnum, taxdist, taxesdue, cast(null as varchar) as error from tax_raw")
def _(t: Tables) -> DataFrame:
    names = ["parcel_id", "lnnum", "taxdist", "taxesdue"]
    path = _csv(t("tax_raw").select(*[F.col(c).alias(c.upper()) for c in names]), folder(t, "tax-feed"), sep="|")
    out = feeds.read_delimited_feed(t.spark, path, [c.upper() for c in names])
    return out.select(*[F.col(c.upper()).alias(c) for c in names], "error")


@query("a3_read_property_feed", "select parcel_id, dorus_code, dordesc1, case when cast(parcel_id as bigint) % 7 = 0 then 'nul' end as error from parcel_raw")
def _(t: Tables) -> DataFrame:
    """Some rows hold a NUL."""
    nul = F.when(F.col("parcel_id").cast("bigint") % 7 == 0, F.lit("\0")).otherwise("")
    rows = t("parcel_raw").select(F.col("parcel_id").alias("PARCEL_ID"), F.col("dorus_code").alias("DORUS_CODE"), F.col("dordesc1").alias("DORDESC1"), F.concat("amtdue", nul).alias("AMTDUE"))
    out = feeds.read_property_feed(t.spark, "parcel", _csv(rows, folder(t, "parcel-feed")), {"parcel": rows.columns})
    return out.select(*[F.col(c).alias(c.lower()) for c in ("PARCEL_ID", "DORUS_CODE", "DORDESC1")], "error")


def _archived(df: DataFrame, path: str) -> DataFrame:
    """Names of ZIP archives, one for each value of archive, that executors write under path; each holds one member of the rows' values in order of line_no."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        name, held = group["archive"].iloc[0], io.BytesIO()
        with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("feed.csv", "\n".join(group.sort_values("line_no")["value"]) + "\n")
        store, where = fs.FileSystem.from_uri(path)
        store.create_dir(where, recursive=True)
        with store.open_output_stream(f"{where}/{name}.zip") as out:  # a task that runs twice writes the same file
            out.write(held.getvalue())
        return pd.DataFrame({"archive": [name]})

    return df.groupBy("archive").applyInPandas(pack, "archive string")


@query("a8_land_zip_feed", ", l as (select 'z' || cast(line_no // 500 as string) as archive, line_no % 500 as n, value from legal_lines) select archive, row_number() over (partition by archive order by n) - 1 as line_no, value from l")
def _(t: Tables) -> DataFrame:
    """An archive for every 500 lines, landed again."""
    path = folder(t, "archives")
    _archived(t("legal_lines").withColumn("archive", F.concat(F.lit("z"), F.floor(F.col("line_no") / 500).cast("string"))), path).write.format("noop").mode("overwrite").save()
    landed = feeds.land_zip_feed(t.spark, path)
    return landed.select(F.regexp_extract("file", r"(z[0-9]+)\.zip$", 1).alias("archive"), "line_no", "value")


@query("a9_read_json_snapshot", "select event_id as id, event_type as kind, props as body from events")
def _(t: Tables) -> DataFrame:
    """A document for every two hundred events, over several lines."""
    path = folder(t, "snapshots")
    reply = F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("kind"), F.col("props").alias("body")).alias("reply"))
    block = F.floor(F.col("event_id") / 200).cast("string").alias("block")
    rows = t("events").groupBy(block).agg(F.to_json(F.collect_list(reply)).alias("x"))
    rows.select("block", F.replace("x", F.lit('},{"id"'), F.lit('},\n{"id"')).alias("value")).write.partitionBy("block").text(path)
    return feeds.read_json_snapshot(t.spark, f"{path}/*/*.txt", "id long, reply struct<kind:string, body:string>").select("id", "reply.kind", "reply.body")


@query("a10_write_snapshot", "select parcel_id, amtdue, 'READY' as state, (select count(*) from parcel_raw) as n, 'screen' as mode from parcel_raw")
def _(t: Tables) -> DataFrame:
    """A snapshot that must have as many rows as the table, read back by what its manifest names."""
    path, rows = folder(t, "published"), t("parcel_raw").select("parcel_id", "amtdue")
    feeds.write_snapshot(rows, path, {"mode": "screen"}, rows=rows.count())
    back, manifest = feeds.read_snapshot(t.spark, path)
    return back.select("*", *[F.lit(manifest[c]).alias(n) for c, n in (("state", "state"), ("rows", "n"), ("mode", "mode"))]).withColumn("n", F.col("n").cast("long"))


@query("a11_write_shards", "select parcel_id, cast(cast('0x' || substr(sha256(parcel_id), 1, 16) as ubigint) % 16 as int) as shard from parcel_raw")
def _(t: Tables) -> DataFrame:
    path = folder(t, "shards")
    feeds.write_shards(t("parcel_raw").select("parcel_id"), "parcel_id", 16, path)
    return t.spark.read.schema("parcel_id string, shard int").option("header", True).csv(path)


@query("a12_decode_cp1252", "select c_custkey as id, substr('€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ', cast(c_custkey % 32 + 1 as int), 1) || c_name || 'é' as text from customer")
def _(t: Tables) -> DataFrame:
    """Files of single bytes, read as ISO-8859-1."""
    path = folder(t, "legacy")
    codes = F.element_at(F.array(*[F.lit(chr(c)) for c in range(0x80, 0xA0)]), (F.col("c_custkey") % 32 + 1).cast("int"))
    t("customer").select("c_custkey", F.concat(codes, "c_name", F.lit("é")).alias("text")).write.options(header=True, encoding="ISO-8859-1").csv(path)
    rows = t.spark.read.schema("id long, text string").options(header=True, encoding="ISO-8859-1").csv(path)
    return rows.select("id", feeds.decode_cp1252(F.col("text")).alias("text"))


@query("g3_require_source", ", f as (select 'b' || cast(c_custkey // 100 as string) as bucket, string_agg(c_name, ',' order by c_custkey) || chr(10) as content from customer group by 1) select bucket, sha256(content) as sha256, strlen(content) as bytes from f")
def _(t: Tables) -> DataFrame:
    """A text file for every hundred customers: all of them pass the gate on their own digests, and a changed one closes it."""
    path = folder(t, "accepted")
    names = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name")))
    rows = t("customer").groupBy(F.concat(F.lit("b"), F.floor(F.col("c_custkey") / 100).cast("string")).alias("bucket")).agg(F.array_join(F.transform(names, lambda r: r["c_name"]), ",").alias("value"))
    rows.write.partitionBy("bucket").text(path)
    accepted = rows.select("bucket", F.sha2(F.concat("value", F.lit("\n")), 256).alias("sha256"))
    found = feeds.source_digests(t.spark, f"{path}/*/*.txt").withColumn("bucket", F.regexp_extract("path", "bucket=([^/]+)/", 1))
    return feeds.require_digests(found, accepted, "bucket").select("bucket", "sha256", "bytes")
