"""Processed zone: documents become typed, cleaned and scored records.

Every entity takes raw documents and gives the declared columns plus ``reject_reason``, which is
set where a record cannot be stored: one pass yields the good and the bad rows.

``null_mode="missing"`` treats a null value like an absent key. ``"compat"`` turns a null value
into the text ``None`` first, so that it passes the blank checks. ``zip_as_int`` reads zip codes as
numbers, whose lost zeros cost the score of a short code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lakestead.fixed_values import (
    CUSTOMER_PENALTIES,
    GEOLOCATION_PENALTIES,
    MIN_ZIP_CHARS,
    NULL_AS_TEXT,
    ORDER_PENALTIES,
    ORDER_STATUSES,
    PRODUCT_PENALTIES,
    SELLER_PENALTIES,
    STATE_CHARS,
)
from lakestead.functions import documents as docs
from lakestead.functions.scalars import is_blank, strip, to_timestamp_or_null
from lakestead.operators.quality import SCORE, Rule, assess
from lakestead.schemas import conform, schema, too_long

MALFORMED = "malformed document"
UNREADABLE = "unreadable: "


# ---- entities -------------------------------------------------------------------------------
def customers(
    raw: DataFrame, null_mode: str = "missing", zip_as_int: bool = False
) -> DataFrame:
    names = schema("source.customers").names
    cleaned = _zip(_with_text(_opened(raw, names), names, null_mode), zip_as_int, "customer").withColumn(
        "customer_state", F.upper("customer_state")
    )
    p = CUSTOMER_PENALTIES
    rules = [
        Rule(F.col("customer_id") == "", *p["customer_id"]),
        Rule(F.col("customer_unique_id") == "", *p["customer_unique_id"]),
        Rule(F.length("customer_zip_code_prefix") < MIN_ZIP_CHARS, *p["zip"]),
        Rule(F.col("customer_city") == "", *p["city"]),
        Rule(F.length("customer_state") != STATE_CHARS, *p["state"]),
    ]
    return _stored(assess(cleaned, rules), "processed.customers")


def sellers(
    raw: DataFrame, null_mode: str = "missing", zip_as_int: bool = False
) -> DataFrame:
    names = schema("source.sellers").names
    cleaned = _zip(_with_text(_opened(raw, names), names, null_mode), zip_as_int, "seller").withColumn(
        "seller_state", F.upper("seller_state")
    )
    p = SELLER_PENALTIES
    rules = [
        Rule(F.col("seller_id") == "", *p["seller_id"]),
        Rule(F.length("seller_zip_code_prefix") < MIN_ZIP_CHARS, *p["zip"]),
        Rule(F.col("seller_city") == "", *p["city"]),
        Rule(F.length("seller_state") != STATE_CHARS, *p["state"]),
    ]
    return _stored(assess(cleaned, rules), "processed.sellers")


def orders(raw: DataFrame, null_mode: str = "missing") -> DataFrame:
    texts = ["order_id", "customer_id", "order_status"]
    names = schema("source.orders").names
    times = [n for n in names if n not in texts]
    cleaned = _with_text(_opened(raw, names), texts, null_mode).withColumn(
        "order_status", F.lower("order_status")
    )
    p = ORDER_PENALTIES
    status = F.col("order_status")
    penalty, note = p["status"]
    rules = [
        Rule(F.col("order_id") == "", *p["order_id"]),
        Rule(F.col("customer_id") == "", *p["customer_id"]),
        Rule(~status.isin(*ORDER_STATUSES), penalty, F.concat(F.lit(note), status)),
        Rule(F.coalesce(F.col("order_purchase_timestamp"), F.lit("")) == "", *p["purchase"]),
    ]
    return _stored(
        assess(cleaned, rules),
        "processed.orders",
        {n: to_timestamp_or_null(F.col(n)) for n in times},
    )


def products(raw: DataFrame, null_mode: str = "missing", length_mode: str = "value") -> DataFrame:
    """``length_mode="value"`` keeps the given lengths; ``"compat"`` stores how many characters the
    text of the given length has."""
    texts = ["product_id", "product_category_name"]
    lengths = ["product_name_length", "product_description_length"]
    opened = _opened(raw, schema("source.products").names)
    cleaned = _with_text(opened, texts, null_mode)
    if length_mode == "compat":
        cleaned = cleaned.withColumns(
            {n: F.length(_null_as_text(n)).cast("string") for n in lengths}
        )
    elif length_mode != "value":
        raise ValueError(f"unknown length_mode: {length_mode}")
    p = PRODUCT_PENALTIES
    rules = [
        Rule(F.col("product_id") == "", *p["product_id"]),
        Rule(F.col("product_category_name") == "", *p["category"]),
    ]
    # Counts may be written as 40 or 40.0.
    numbers = [*lengths, "product_photos_qty"]
    return _stored(
        assess(cleaned, rules),
        "processed.products",
        {n: F.col(n).try_cast("double").try_cast("int") for n in numbers},
    )


def geolocations(
    raw: DataFrame, null_mode: str = "missing", zip_as_int: bool = False
) -> DataFrame:
    texts = ["geolocation_zip_code_prefix", "geolocation_city", "geolocation_state"]
    opened = _opened(raw, schema("source.geolocation").names)
    cleaned = (
        _zip(_with_text(opened, texts, null_mode), zip_as_int, "geolocation")
        .withColumn("geolocation_state", F.upper("geolocation_state"))
        .withColumnRenamed("geolocation_lat", "geolocation_latitude")
        .withColumnRenamed("geolocation_lng", "geolocation_longitude")
    )
    position = ["geolocation_latitude", "geolocation_longitude"]
    p = GEOLOCATION_PENALTIES
    rules = [
        Rule(F.length("geolocation_zip_code_prefix") < MIN_ZIP_CHARS, *p["zip"]),
        Rule(F.col(position[0]).isNull() | F.col(position[1]).isNull(), *p["position"]),
    ]
    return _stored(
        assess(cleaned, rules),
        "processed.geolocations",
        {n: F.col(n).try_cast("decimal(10,6)") for n in position},
    )


def order_items(raw: DataFrame, null_mode: str = "missing") -> DataFrame:
    """An item is valid when it names its order. A price or freight of the number 0 counts as
    unknown, the text "0" does not."""
    texts = ["order_id", "product_id", "seller_id"]
    amounts = ["price", "freight_value"]
    cleaned = _with_text(_opened(raw, schema("source.order_items").names), texts, null_mode)
    valid = F.col("order_id") != ""
    scored = cleaned.select(
        "*",
        F.when(valid, F.lit("1.00")).otherwise(F.lit("0.00")).cast(SCORE).alias("data_quality_score"),
        valid.alias("is_valid"),
        F.lit(None).cast("string").alias("validation_notes"),
    )

    def unknown_zero(name: str, number: Column) -> Column:
        kind = F.schema_of_variant(F.variant_get(F.try_parse_json("data"), f"$.{name}", "variant"))
        # The document is looked at for zeros only.
        return F.when(number == 0, F.when(kind == "STRING", number)).otherwise(number)

    return _stored(
        scored,
        "processed.order_items",
        {
            **{n: F.col(n).try_cast("decimal(10,2)") for n in amounts},
            "shipping_limit_date": to_timestamp_or_null(F.col("shipping_limit_date")),
        },
        adjust={n: unknown_zero for n in amounts},
    )


PROCESS = {
    "customers": customers,
    "sellers": sellers,
    "orders": orders,
    "products": products,
    "geolocations": geolocations,
    "order_items": order_items,
}


# ---- good and bad rows ----------------------------------------------------------------------
def accepted(processed: DataFrame) -> DataFrame:
    return processed.filter("reject_reason is null").drop("reject_reason", "document")


def rejected(processed: DataFrame) -> DataFrame:
    return processed.filter("reject_reason is not null").select(
        "source_raw_id", "reject_reason", "document"
    )


# ---- shared steps ---------------------------------------------------------------------------
def _opened(raw: DataFrame, names: list[str]) -> DataFrame:
    """Every wanted field as text, and the document where it did not parse; one parse per row."""
    fields = ", ".join(f"{n} string" for n in names)
    parsed = F.from_json(
        F.col("data"), f"{fields}, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}
    )
    return raw.select(F.col("raw_id").alias("source_raw_id"), "data", parsed.alias("doc")).select(
        "source_raw_id",
        "data",
        *[F.col(f"doc.{n}") for n in names],
        (F.col("doc").isNull() | F.col("doc._corrupt").isNotNull()).alias("_malformed"),
    )


def _null_as_text(name: str) -> Column:
    """The value as text, where an absent key is empty and a null value reads ``None``."""
    value = F.col(name)
    there = docs.has_key(F.col("data"), name)
    return F.when(value.isNull(), F.when(there, NULL_AS_TEXT).otherwise("")).otherwise(value)


def _with_text(df: DataFrame, names: list[str], null_mode: str) -> DataFrame:
    if null_mode not in ("missing", "compat"):
        raise ValueError(f"unknown null_mode: {null_mode}")
    value = _null_as_text if null_mode == "compat" else F.col
    return df.withColumns({n: F.coalesce(strip(value(n)), F.lit("")) for n in names})


def _zip(df: DataFrame, as_int: bool, who: str) -> DataFrame:
    """With ``as_int`` the zip code as a reader without a schema takes it: a number, without leading zeros."""
    name = f"{who}_zip_code_prefix"
    number = F.col(name).try_cast("int").cast("string")
    return df.withColumn(name, F.coalesce(number, F.col(name))) if as_int else df


def _stored(
    df: DataFrame,
    table: str,
    typed: dict[str, Column] | None = None,
    adjust: dict[str, Callable[[str, Column], Column]] | None = None,
) -> DataFrame:
    """Declared columns, those in ``typed`` converted from text and then adjusted. A text that is
    there but cannot be converted rejects the row."""
    typed, adjust = typed or {}, adjust or {}
    converted = df.withColumns({f"_{n}": value for n, value in typed.items()})
    reason = F.coalesce(
        F.when(F.col("_malformed"), F.lit(MALFORMED)),
        *[
            F.when(F.col(f"_{n}").isNull() & ~is_blank(F.col(n)), F.lit(f"{UNREADABLE}{n}"))
            for n in typed
        ],
        F.lit(None).cast("string"),
    )

    def value(name: str) -> Column:
        if name not in typed:
            return F.col(name)
        return adjust.get(name, lambda _, c: c)(name, F.col(f"_{name}"))

    names = [c for c in df.columns if c not in ("data", "_malformed")]
    # The document stays with rows that this zone or, for their width, the next one turns away.
    turned_away = reason.isNotNull() | too_long(df.select(*names)).isNotNull()
    out = converted.select(
        *[value(n).alias(n) for n in names],
        reason.alias("reject_reason"),
        F.when(turned_away, F.col("data")).alias("document"),
    )
    record = conform(out, table, keep=["reject_reason", "document"])
    # Filters on score or reason stay above a generator. Without it they would be pushed down to
    # the documents, and every document would be parsed and judged twice.
    once = F.explode(F.array(F.struct(*record.columns))).alias("record")
    return record.select(once).select("record.*")
