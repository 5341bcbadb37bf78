"""Amounts and masks against plain Python."""

from __future__ import annotations

import base64
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline.functions import (
    counter_sign,
    customer_key,
    decode_amount,
    encode_amount,
    mask_email,
    per_second,
    percent,
    status_key,
)

EDGES = ["0", "0.01", "-0.01", "1.27", "1.28", "-1.28", "-1.29", "655.35", "-655.36", "1250000.00",
         "9999999999.99", "-9999999999.99", "2.55", "2.56", "-327.68", "-327.69"]


def shortest(cents: int) -> bytes:
    n = 1
    while not -(1 << (8 * n - 1)) <= cents < (1 << (8 * n - 1)):
        n += 1
    return cents.to_bytes(n, "big", signed=True)


def decoded(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = rows.select("i", decode_amount(F.col("t")).alias("a")).orderBy("i").collect()
    return [r.a for r in out]


def test_edge_amounts_both_ways(spark):
    rows = spark.createDataFrame([(e,) for e in EDGES], "t string").withColumn("a", F.col("t").cast("decimal(12,2)"))
    out = rows.select("a", encode_amount(F.col("a")).alias("b")).withColumn("back", decode_amount(F.col("b"))).collect()
    for row in out:
        assert base64.b64decode(row.b) == shortest(int(row.a * 100))
        assert row.back == row.a


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-999_999_999_999, 999_999_999_999), min_size=20, max_size=60))
def test_any_amount_decodes(spark, cents):
    texts = [base64.b64encode(shortest(c)).decode() for c in cents]
    assert decoded(spark, texts) == [Decimal(c) / 100 for c in cents]


def test_padded_and_too_large(spark):
    padded = [base64.b64encode(c.to_bytes(n, "big", signed=True)).decode() for c in (5, -5) for n in (8, 9, 16, 20)]
    assert decoded(spark, padded) == [Decimal("0.05")] * 4 + [Decimal("-0.05")] * 4
    large = [base64.b64encode(shortest(c)).decode() for c in (10**12, -(10**12), 2**63, 2**70, -(2**90))]
    assert decoded(spark, large) == [None] * 5


def test_text_that_is_no_base64(spark):
    assert decoded(spark, [None, "!!!", "abc", "not base64", "ab=c", "AA==\n", "12.5"]) == [None] * 7
    assert decoded(spark, [""]) == [Decimal("0.00")]


def python_mask(email):
    if email is None or email.count("@") != 1:
        return email
    local, domain = email.split("@")
    if len(local) <= 2:
        return email
    return f"{local[0]}{'*' * (len(local) - 2)}{local[-1]}@{domain}"


EMAILS = ["a@x", "ab@x", "abc@x", "abc@", "@x", "@", "", "no at sign", "two@at@signs", "abc@@", "😀b😀c@x.org",
          "Nguyễn.Văn@công.ty", "line\nbreak@x", "a.very.long.local.part@example.com", "***@x", None]


def masks(spark, emails, **options):
    rows = spark.createDataFrame([(i, e) for i, e in enumerate(emails)], "i int, e string")
    out = rows.select("i", mask_email(F.col("e"), **options).alias("m")).orderBy("i").collect()
    return [r.m for r in out]


def test_masks(spark):
    assert masks(spark, EMAILS) == [python_mask(e) for e in EMAILS]


def test_address_without_a_domain(spark):
    assert masks(spark, ["abc@", "abc@x"], drop_trailing_empty_part=True) == ["abc@", "a*c@x"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab@.é😀 ", max_size=9), min_size=30, max_size=60))
def test_any_text_masks(spark, emails):
    assert masks(spark, emails) == [python_mask(e) for e in emails]


def test_keys_and_defaults(spark):
    rows = spark.createDataFrame([(None, None, None), (7, "SHIPPED", "d")], "c bigint, s string, op string")
    out = rows.select(
        customer_key(F.col("c")).alias("m"),
        status_key(F.col("s")).alias("s"),
        status_key(F.col("s"), None).alias("skipped"),
        counter_sign(F.col("op")).alias("n"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("customer:UNKNOWN", "orders:status:UNKNOWN", None, 1),
        ("customer:7", "orders:status:SHIPPED", "orders:status:SHIPPED", -1),
    ]


@pytest.mark.parametrize("n, s, rate", [(10, 4.0, 2.5), (10, 0.0, 0.0), (0, 3.0, 0.0)])
def test_rate(spark, n, s, rate):
    assert spark.range(1).select(per_second(F.lit(n), F.lit(s)).alias("r")).first().r == rate


def test_percent_of_nothing(spark):
    row = spark.range(1).select(percent(F.lit(3), F.lit(4)).alias("a"), percent(F.lit(3), F.lit(0)).alias("b")).first()
    assert (row.a, row.b) == (75.0, None)
