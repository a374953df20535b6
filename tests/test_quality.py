"""Record rules: every trap with its expected rows."""

import itertools
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestead.fixed_values import CUSTOMER_PENALTIES, ORDER_STATUSES
from lakestead.operators.quality import quality_summary
from lakestead.plans import curated, processed

GOOD = {
    "customer_id": "a",
    "customer_unique_id": "u",
    "customer_zip_code_prefix": "01037",
    "customer_city": "sao paulo",
    "customer_state": "sp",
}


def raw(spark, documents):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    return spark.createDataFrame(list(enumerate(texts)), "raw_id long, data string")


def test_clean_customer_scores_one_and_is_normalised(spark):
    doc = {**GOOD, "customer_city": "\t sao paulo ", "customer_state": " sp\n"}
    row = processed.customers(raw(spark, [doc])).first()
    assert (row.customer_city, row.customer_state) == ("sao paulo", "SP")
    assert (row.data_quality_score, row.is_valid, row.validation_notes) == (Decimal("1.00"), True, None)


def test_null_absent_and_blank_city(spark, rows):
    absent = {k: v for k, v in GOOD.items() if k != "customer_city"}
    documents = raw(spark, [absent, {**GOOD, "customer_city": None}, {**GOOD, "customer_city": " "}])
    missing = processed.customers(documents)
    assert rows(missing, "customer_city", "data_quality_score") == [("", Decimal("0.80"))] * 3
    compat = processed.customers(documents, null_mode="compat")
    assert rows(compat, "source_raw_id", "customer_city", "data_quality_score") == [
        (0, "", Decimal("0.80")),
        (1, "None", Decimal("1.00")),
        (2, "", Decimal("0.80")),
    ]


def test_null_state_reads_none_and_is_kept_out_of_the_curated_zone(spark, rows):
    documents = raw(spark, [{**GOOD, "customer_state": None}, {**GOOD, "customer_id": "b"}])
    scored = processed.accepted(processed.customers(documents, null_mode="compat"))
    first = scored.orderBy("source_raw_id").first()
    assert (first.customer_state, first.is_valid) == ("NONE", True)
    assert rows(curated.oversized(scored)) == [(0, "too long: customer_state")]
    assert rows(curated.customers_refined(scored), "customer_id") == [("b",)]


def test_every_combination_of_customer_penalties(spark):
    bad = {
        "customer_id": {"customer_id": ""},
        "customer_unique_id": {"customer_unique_id": " "},
        "zip": {"customer_zip_code_prefix": "123"},
        "city": {"customer_city": ""},
        "state": {"customer_state": "XYZ"},
    }
    cases, expected = [], []
    for n in range(len(bad) + 1):
        for names in itertools.combinations(bad, n):
            doc = dict(GOOD)
            as_float = 1.0
            for name in names:
                doc.update(bad[name])
                as_float -= float(CUSTOMER_PENALTIES[name][0])
            exact = max(Decimal(0), 1 - sum(Decimal(CUSTOMER_PENALTIES[x][0]) for x in names))
            notes = "; ".join(CUSTOMER_PENALTIES[x][1] for x in names) or None
            cases.append(doc)
            expected.append((exact, as_float > 0.5, notes))
    got = processed.customers(raw(spark, cases)).orderBy("source_raw_id").collect()
    assert [(r.data_quality_score, r.is_valid, r.validation_notes) for r in got] == expected


def test_order_status_domain_and_note(spark):
    base = {"order_id": "o", "customer_id": "c", "order_purchase_timestamp": "2017-10-02T10:56:33"}
    documents = [{**base, "order_status": s.upper()} for s in ORDER_STATUSES]
    documents += [{**base, "order_status": " Invoiced "}, {**base, "order_purchase_timestamp": ""}]
    got = processed.orders(raw(spark, documents)).orderBy("source_raw_id").collect()
    assert all(r.data_quality_score == 1 for r in got[:5])
    assert got[5].validation_notes == "Invalid order_status: invoiced"
    assert got[6].validation_notes == "Invalid order_status: ; Missing purchase timestamp"
    assert got[6].data_quality_score == Decimal("0.60") and got[6].reject_reason is None


@pytest.mark.parametrize(("mode", "expected"), [("value", (40, None)), ("compat", (2, 0))])
def test_product_lengths(spark, mode, expected):
    documents = raw(spark, [{"product_id": "p", "product_category_name": "x", "product_name_length": 40}])
    row = processed.products(documents, length_mode=mode).first()
    assert (row.product_name_length, row.product_description_length) == expected


def test_product_length_of_a_null_value_in_compat_mode(spark):
    documents = raw(spark, [{"product_id": "p", "product_name_length": None}])
    row = processed.products(documents, null_mode="compat", length_mode="compat").first()
    assert row.product_name_length == 4


def test_geolocation(spark, rows):
    good = {"geolocation_zip_code_prefix": "01037", "geolocation_lat": -23.5, "geolocation_lng": -46.6}
    documents = [good, {**good, "geolocation_zip_code_prefix": 1037}, {**good, "geolocation_lat": None}]
    documents.append({"geolocation_zip_code_prefix": "1"})
    got = processed.geolocations(raw(spark, documents))
    assert rows(got, "source_raw_id", "data_quality_score", "is_valid") == [
        (0, Decimal("1.00"), True),
        (1, Decimal("0.70"), True),
        (2, Decimal("0.70"), True),
        (3, Decimal("0.40"), False),
    ]


def test_item_zero_is_unknown_but_text_zero_is_not(spark, rows):
    documents = [
        {"order_id": "o", "price": 10.5, "freight_value": 0},
        {"order_id": "o", "price": "0", "freight_value": "0.00"},
        {"order_id": " ", "price": 0.0},
    ]
    got = processed.order_items(raw(spark, documents))
    assert rows(got, "source_raw_id", "price", "freight_value", "data_quality_score", "is_valid") == [
        (0, Decimal("10.50"), None, Decimal("1.00"), True),
        (1, Decimal("0.00"), Decimal("0.00"), Decimal("1.00"), True),
        (2, None, None, Decimal("0.00"), False),
    ]


def test_quarantine_takes_unreadable_rows_only(spark, rows):
    documents = [
        {"order_id": "o", "price": "abc"},
        {"order_id": "o", "shipping_limit_date": "x"},
        '{"order_id":',
        "[1, 2]",
        {"order_id": "o", "price": " 7.25 ", "shipping_limit_date": " 2017-01-01 "},
    ]
    got = processed.order_items(raw(spark, documents))
    assert rows(processed.rejected(got), "source_raw_id", "reject_reason") == [
        (0, "unreadable: price"),
        (1, "unreadable: shipping_limit_date"),
        (2, "malformed document"),
        (3, "malformed document"),
    ]
    assert rows(processed.accepted(got), "source_raw_id", "price") == [(4, Decimal("7.25"))]


def test_repeated_key_keeps_the_last_value(spark):
    row = processed.sellers(raw(spark, ['{"seller_id":"a","seller_id":"b"}'])).first()
    assert row.seller_id == "b" and row.reject_reason is None


def test_summary(spark, rows):
    scored = processed.customers(raw(spark, [GOOD, {**GOOD, "customer_city": ""}, {}]))
    assert rows(quality_summary({"customers": scored})) == [
        ("customers", 3, 2, Decimal("0.600"), Decimal("0.00"))
    ]
    assert scored.filter(F.col("processed_at").isNotNull()).count() == 0
