import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcel_jobs.functions import scalars as S

KEY = "0" * 17 + "1"
ROW = dict(zip(S.SALES, [KEY, "7", "01", "02/28/2023", "100.00", "5", "6", "I", "WD", "Warranty Deed", "01", "Q-Per examination of deed", "A", "B", "N"], strict=True))


@pytest.mark.parametrize(
    ("change", "error"),
    [
        ({}, None), ({"parcel_id": KEY[1:]}, "parcel_id"), ({"parcel_id": KEY + "\n"}, None), ({"parcel_id": "١" * 18}, "parcel_id"), ({"ln_num": "-1"}, "ln_num"), ({"ln_num": "2147483647"}, None), ({"ln_num": "2147483648"}, "ln_num"),
        ({"ln_num": "9" * 60}, "ln_num"), ({"saledt": "02/29/2023"}, "saledt"), ({"saledt": "2/8/2023"}, "saledt"), ({"saledt": " "}, None), ({"price": "1e6"}, "price"), ({"price": "-5"}, "negative_price"), ({"price": ".5"}, None), ({"price": "+5."}, None), ({"grantor": "a\0b"}, "nul_byte"), ({"grantor": None}, None),
    ],
)
def test_sales_contract(spark, change, error):
    schema = ", ".join(f"{c} string" for c in S.SALES)
    row = S.normalize_sales(spark.createDataFrame([tuple((ROW | change).values())], schema)).first()
    assert row["error"] == error
    if "ln_num" not in change:
        assert row["ln_num"] == "1"


def test_shards_are_those_of_the_whole_digest(spark):
    keys = [f"{i:018d}" for i in range(40)]
    rows = spark.createDataFrame([(k,) for k in keys], "k string").select("k", S.sha_shard(F.col("k"), 97).alias("a"), S.md5_shard(F.col("k"), 97).alias("b")).collect()
    assert all(r["a"] == int(hashlib.sha256(r["k"].encode()).hexdigest()[:16], 16) % 97 and r["b"] == int(hashlib.md5(r["k"].encode()).hexdigest(), 16) % 97 for r in rows)


def test_amounts(spark):
    df = spark.createDataFrame([("",), ("0",), ("$1,200.50",), ("x",), (None,)], "c string")
    got = df.select(S.amount(F.col("c")), S.money(F.col("c")), S.to_num(F.col("c"))).collect()
    assert [r[0] for r in got] == [None, 0, None, None, None]
    assert [r[1] for r in got] == [None, 0, Decimal("1200.5"), None, None]
    assert [r[2] for r in got] == [0.0, 0.0, 1200.5, 0.0, 0.0]


def test_window_has_both_ends(spark):
    df = spark.sql("select * from values (date '2000-01-01'), (date '2000-12-31'), (date '1999-12-31'), (date '2001-01-01'), (cast(null as date)) as t(d)")
    assert [r[0] for r in df.select(S.window_class(F.col("d"), "2000-01-01", "2000-12-31")).collect()] == ["in_window", "in_window", "before_window", "after_as_of", "undated"]


def test_flags(spark):
    df = spark.createDataFrame([("9910", "INACCESSIBLE TRACTS"), ("9910", "Other"), ("1", "Mineral Rights (Not Phos.)"), ("1", "x"), (None, None)], "a string, b string")
    got = [r[0] for r in df.select(S.source_review_flags(F.col("a"), F.col("b"))).collect()]
    assert got == [["county_inaccessible_tract"], ["county_inaccessible_tract", "county_classification_mismatch"], ["county_mineral_rights", "county_classification_mismatch"], [], []]


def test_parse_year_tries_formats_only_where_their_separators_stand(spark):
    """The same years as from all formats in turn, and fewer dates that are parsed in vain."""
    texts = ["02/29/2024", "02/29/2023", "2024-02-29", "2023-02-30", "02-29-2024", "13-01-2020", "2024/12/31", "2024/13/31", "sold/1999/x", "x-2100", "2101/1899", "19991", "1/2/1998", " 01/02/1998", "01/02/1998 ",
             "01/02/1998\n", "1999\n", "0000-01-01", "01/01/0000", "+12345-01-01", "01/02/+12345", "-0001-01-01", "12345/01/01", "99/1998/2003", "", "/", "-", "ab", "١٢/٠١/٢٠٢٠", "2020", "2020-", None]
    c = F.col("t")
    dates = [F.year(F.try_to_date(c, f)) for f in ("MM/dd/yyyy", "yyyy-MM-dd", "MM-dd-yyyy", "yyyy/MM/dd")]
    tokens = F.filter(F.split(F.translate(c, "-", "/"), "/"), lambda x: x.rlike(r"^(19[0-9]{2}|20[0-9]{2}|2100)\z"))
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.parse_year(c).alias("got"), F.coalesce(*dates, F.get(tokens, F.lit(0)).try_cast("int")).alias("want"))
    assert [r for r in df.collect() if r["got"] != r["want"]] == []
    assert "filter" not in str(S.parse_year(c)).lower()
