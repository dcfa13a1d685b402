import struct
from datetime import date
from decimal import Decimal

import pytest
import xxhash
from pyspark.sql import functions as F

from starloom.functions import columns as c


def one(spark, value, **cells):
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in cells.items()), F.lit(0).alias("z"))
    return df.select(value.alias("v")).first().v


def test_business_id_pads_and_rejects_overflow(spark):
    assert one(spark, c.business_id("CUS", "n", 5), n=42) == "CUS00042"
    assert one(spark, c.business_id("CUS", "n", 5), n=99999) == "CUS99999"
    with pytest.raises(Exception, match="wider than 5"):
        one(spark, c.business_id("CUS", "n", 5), n=100000)


def test_code_lookup_unknown_code_is_null(spark):
    labels = ("a", "b")
    assert one(spark, c.code_lookup("n", labels), n=1) == "b"
    assert one(spark, c.code_lookup("n", labels), n=2) is None
    assert one(spark, c.code_lookup("n", labels), n=-1) is None


def test_hash_bucket_is_stable_and_in_range(spark):
    df = spark.range(1000).select(
        c.hash_bucket("id", 7, salt=1).alias("a"),
        c.hash_bucket("id", 7, salt=1).alias("b"),
        c.hash_bucket("id", 7, salt=2).alias("other"),
    )
    rows = df.collect()
    assert {r.a for r in rows} == set(range(7))
    assert all(r.a == r.b for r in rows)
    assert any(r.a != r.other for r in rows)


def test_hash_bucket_against_another_implementation(spark):
    """Chained 64-bit xxHash of the key and the salt, each in little-endian bytes."""
    mask = 2**64

    def expected(key, salt, buckets):
        first = xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)
        mixed = xxhash.xxh64_intdigest(struct.pack("<i", salt), seed=first)
        signed = mixed - mask if mixed >= mask // 2 else mixed
        return signed % buckets

    found = spark.range(500).select("id", c.hash_bucket("id", 20, salt=7).alias("bucket")).collect()
    assert [r.bucket for r in found] == [expected(r.id, 7, 20) for r in found]


def test_dates(spark):
    leap = date(2024, 2, 29)
    assert one(spark, c.date_key("d"), d=leap) == 20240229
    assert one(spark, c.warranty_expiry("d"), d=leap) == date(2027, 2, 28)
    assert one(spark, c.offset_date("d", 1), d=leap) == date(2024, 3, 1)


def test_banding_takes_the_first_bound(spark):
    bands = ((2000, "High"), (5000, "Medium"))
    found = [one(spark, c.banding("n", bands, "Low"), n=v) for v in (1999, 2000, 4999, 5000)]
    assert found == ["High", "Medium", "Medium", "Low"]


def test_status_rules(spark):
    as_of = F.lit(date(2001, 8, 1))
    ordered = [date(2001, 7, 2), date(2001, 7, 3)]
    assert [one(spark, c.order_status("d", F.lit(True), as_of), d=d) for d in ordered] == [
        "Cancelled", "Open",
    ]
    late, early = date(2001, 8, 2), date(2001, 8, 1)
    assert one(spark, c.purchase_status("d", "r", "o", as_of), d=late, r=1, o=2) == "Open"
    assert one(spark, c.purchase_status("d", "r", "o", as_of), d=early, r=1, o=2) == "Partially Received"
    assert one(spark, c.purchase_status("d", "r", "o", as_of), d=early, r=2, o=2) == "Received"
    assert one(spark, c.shipment_status("h", "d", as_of), h=True, d=late) == "Quality Hold"
    assert one(spark, c.shipment_status("h", "d", as_of), h=False, d=late) == "In Transit"
    assert one(spark, c.shipment_status("h", "d", as_of), h=False, d=early) == "Delivered"
    assert one(spark, c.work_order_status("d", F.lit(True), as_of), d=early) == "Waiting for Parts"


def test_money_is_rounded_on_each_line(spark):
    amount = c.line_revenue("q", c.money("p"), c.fraction("d"))
    assert one(spark, amount, q=3, p=0.55, d=0.05) == Decimal("1.57")
    factor = F.lit("0.85").cast("decimal(5,4)")
    assert one(spark, c.unit_cost(c.money("p"), factor), p=10.1) == Decimal("8.59")
    assert one(spark, c.received_quantity("o", F.lit(9)), o=4) == 0


def test_durations(spark):
    assert one(spark, c.repair_hours("q", "p"), q=5, p="Critical") == Decimal("30.00")
    assert one(spark, c.resolve_days("h"), h=24) == 1
    assert one(spark, c.resolve_days("h"), h=25) == 2
    assert one(spark, c.downtime_hours("h"), h=7) == Decimal("17.0")


def test_positions(spark):
    found = spark.range(7).select(c.batch_id("id", 3).alias("b"), c.spread_id("id", 2, 7).alias("s")).collect()
    assert [r.b for r in found] == [1, 1, 1, 2, 2, 2, 3]
    assert [r.s for r in found] == [1, 1, 1, 1, 2, 2, 2]


def test_pair_keys_never_collide(spark):
    rows = spark.createDataFrame([(1, 12), (2, 2), (11, 2), (1, 2), (10**18, 7), (-1, 3)], "a long, b int")
    keys = [r.k for r in rows.select(c.pair_key("a", "b").alias("k")).collect()]
    assert keys == ["1:12", "2:2", "11:2", "1:2", "1000000000000000000:7", "-1:3"]
    made = rows.where("a = 11").select(c.pair_id("SOL", c.pair_key("a", "b"), 6).alias("i")).first().i
    assert made == "SOL000011:2"


def test_leading_number(spark):
    rows = spark.createDataFrame([("1-URGENT",), ("10-SPARE",), ("none",), (None,), ("-5",)], "t string")
    found = [r.n for r in rows.select(c.leading_number("t").alias("n")).collect()]
    assert found == [1, 10, None, None, None]
