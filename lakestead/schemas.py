"""Declared columns of every zone and the step that makes a frame conform to them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from lakestead.fixed_values import TEXT_WIDTHS

_QUALITY = (
    "data_quality_score decimal(3,2), is_valid boolean, validation_notes string,"
    " processed_at timestamp_ntz, source_raw_id bigint"
)
_CUSTOMER = (
    "customer_id string, customer_unique_id string, customer_zip_code_prefix string,"
    " customer_city string, customer_state string"
)
_SELLER = "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"

_DDL = {
    # Source entities: zip codes are text, so a leading zero stays.
    "source.customers": _CUSTOMER,
    "source.sellers": _SELLER,
    "source.orders": (
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp string, order_approved_at string,"
        " order_delivered_carrier_date string, order_delivered_customer_date string,"
        " order_estimated_delivery_date string"
    ),
    "source.order_items": (
        "order_id string, product_id string, seller_id string, shipping_limit_date string,"
        " price double, freight_value double"
    ),
    "source.products": (
        "product_id string, product_category_name string, product_name_length int,"
        " product_description_length int, product_photos_qty int"
    ),
    "source.geolocation": (
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double,"
        " geolocation_city string, geolocation_state string"
    ),
    "source.category_translation": (
        "product_category_name string, product_category_name_english string"
    ),
    "raw.documents": (
        "raw_id bigint, data string, source_table string, loaded_at timestamp_ntz,"
        " file_hash string, created_by string"
    ),
    "raw.data_metadata": (
        "table_name string, total_records bigint, loaded_at timestamp_ntz, source_file string,"
        " record_count bigint, status string"
    ),
    "processed.customers": f"{_CUSTOMER}, {_QUALITY}",
    "processed.sellers": f"{_SELLER}, {_QUALITY}",
    "processed.orders": (
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
        f" order_estimated_delivery_date timestamp_ntz, {_QUALITY}"
    ),
    "processed.order_items": (
        "order_id string, product_id string, seller_id string, shipping_limit_date timestamp_ntz,"
        f" price decimal(10,2), freight_value decimal(10,2), {_QUALITY}"
    ),
    "processed.products": (
        "product_id string, product_category_name string, product_name_length int,"
        f" product_description_length int, product_photos_qty int, {_QUALITY}"
    ),
    "processed.geolocations": (
        "geolocation_zip_code_prefix string, geolocation_latitude decimal(10,6),"
        " geolocation_longitude decimal(10,6), geolocation_city string,"
        f" geolocation_state string, {_QUALITY}"
    ),
    "curated.orders_refined": (
        "order_id string, customer_id string, order_status string,"
        " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
        " order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz,"
        " days_to_delivery int, is_on_time boolean, purchase_month date,"
        " data_quality_score decimal(3,2), is_valid boolean"
    ),
    "curated.order_items_refined": (
        "order_item_id bigint, order_id string, product_id string, seller_id string,"
        " price decimal(10,2), freight_value decimal(10,2), total_item_value decimal(12,2),"
        " shipping_limit_date timestamp_ntz, data_quality_score decimal(3,2)"
    ),
    "curated.customers_refined": f"{_CUSTOMER}, data_quality_score decimal(3,2), is_valid boolean",
    "curated.sellers_refined": f"{_SELLER}, data_quality_score decimal(3,2), is_valid boolean",
    "warehouse.dim_date": (
        "date_id int, date_value date, year int, month int, day int, quarter int, week int,"
        " day_of_week string, is_weekend boolean, is_holiday boolean"
    ),
    "warehouse.dim_customer": (
        "dim_customer_id bigint, customer_id string, customer_unique_id string,"
        " customer_state string, customer_city string, customer_zip_code_prefix string,"
        " data_quality_score decimal(3,2), is_active boolean, created_at timestamp_ntz,"
        " updated_at timestamp_ntz"
    ),
    "warehouse.dim_product": (
        "dim_product_id bigint, product_id string, avg_price decimal(12,2), is_active boolean"
    ),
    "warehouse.dim_seller_scd": (
        "scd_id bigint, seller_id string, seller_state string, seller_city string,"
        " seller_zip_code_prefix string, is_active boolean, is_current boolean, valid_from date,"
        " valid_to date, change_reason string, created_by string"
    ),
    "warehouse.dim_location": (
        "dim_location_id bigint, location_key string, state_code string, city_name string,"
        " is_active boolean"
    ),
    "warehouse.fct_orders": (
        "order_id string, dim_customer_id bigint, dim_product_id bigint, dim_date_id int,"
        " dim_location_id bigint, quantity int, price_amount decimal(18,2),"
        " freight_value decimal(18,2), total_order_value decimal(18,2), order_status string,"
        " days_to_delivery int, is_on_time boolean, order_date date, delivery_date date,"
        " estimated_delivery_date date, data_quality_score decimal(3,2), order_month date"
    ),
}

TABLES = tuple(_DDL)

#: Columns that hold no NULL, and defaults, as the catalog shows them.
NOT_NULL = {
    "warehouse.dim_date": ("date_value",),
    "warehouse.dim_customer": ("customer_id",),
    "warehouse.dim_product": ("product_id",),
    "warehouse.dim_seller_scd": ("seller_id", "valid_from"),
    "warehouse.dim_location": ("location_key",),
    "warehouse.fct_orders": ("order_id",),
}
DEFAULTS = {
    "warehouse.dim_customer": {"is_active": "true"},
    "warehouse.dim_product": {"is_active": "true"},
    "warehouse.dim_seller_scd": {"is_active": "true", "is_current": "true", "created_by": "'ETL'"},
    "warehouse.dim_location": {"is_active": "true"},
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(_DDL[table])


def conform(df: DataFrame, table: str, keep: list[str] | None = None) -> DataFrame:
    """The declared columns in order and with their types; absent ones are NULL.

    ``keep`` names further columns that pass unchanged.
    """
    wanted = schema(table)
    if keep:
        given = df.schema
        wanted = StructType([*wanted, *[given[c] for c in keep]])
    return df.to(wanted)


def too_long(df: DataFrame) -> Column:
    """Name of the first text column over its declared width, NULL when all fit."""
    checks = [
        F.when(F.length(c) > TEXT_WIDTHS[c], F.lit(f"too long: {c}"))
        for c in df.columns
        if c in TEXT_WIDTHS
    ]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def fits(df: DataFrame) -> DataFrame:
    """Rows whose text fits the declared widths; the others belong in quarantine."""
    checks = [
        F.coalesce(F.length(c) <= TEXT_WIDTHS[c], F.lit(True))
        for c in df.columns
        if c in TEXT_WIDTHS
    ]
    return df.filter(reduce(Column.__and__, checks)) if checks else df
