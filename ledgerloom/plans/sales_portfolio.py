"""Subscription sales portfolio of one gateway and country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import safe_bigint
from ..functions.dates import parse_timestamp, same_day_flag
from ..functions.labels import connection_type, free_sale_flag, pixel_flags
from ..functions.texts import ip_prefix
from ..operators.projection import apply_mapping, with_constants, with_load_stamp

# Mapping lists (source, source type, target, target type).
OFFERS = [
    ("offer_id", "bigint", "offerid", "bigint"),
    ("name", "string", "offer_name", "string"),
]
AFFILIATES = [
    ("aff_id", "bigint", "affiliate_id", "bigint"),
    ("name", "string", "affiliate_name", "string"),
]
FLOWS = [
    ("flow_id", "bigint", "flow_type", "bigint"),
    ("flow_name", "string", "flow_name", "string"),
]
CUSTOMERS = [
    ("rid", "bigint", "ref_cust_table_rid", "bigint"),
    ("subscribe_time", "string", "subscribetime", "string"),
    ("offer_id", "bigint", "offer_id", "bigint"),
    ("offer_price", "double", "offer_price", "double"),
    ("affiliate_id", "bigint", "affiliate_id", "bigint"),
    ("publisher_id", "string", "publisher_id", "string"),
    ("total_billed", "double", "total_billed", "double"),
    ("last_billed", "string", "last_billed", "string"),
    ("investor_campaign", "bigint", "investor_campaign", "bigint"),
    ("sync", "string", "sync", "string"),
    ("resub", "bigint", "resub", "bigint"),
    ("status", "bigint", "status", "bigint"),
    ("unsubscribe_time", "string", "unsubscribetime", "string"),
    ("shortcode", "bigint", "shortcode", "bigint"),
    ("keyword", "string", "keyword", "string"),
    ("operator", "string", "operator", "string"),
    ("msisdn", "bigint", "msisdn", "bigint"),
    ("mo_id", "string", "mo_id", "string"),
]
CUSTOMER_DATA = [
    ("rid", "bigint", "ref_cust_data_table_rid", "bigint"),
    ("click_time", "string", "click_time", "string"),
    ("view_time", "string", "view_time", "string"),
    ("lead_time", "string", "lead_time", "string"),
    ("conversion_time", "string", "conversion_time", "string"),
    ("click_cost", "double", "click_cost", "double"),
    ("view_cost", "double", "view_cost", "double"),
    ("lead_cost", "double", "lead_cost", "double"),
    ("conversion_cost", "double", "conversion_cost", "double"),
    ("flow_type", "string", "flow_type", "string"),
    ("remote_ip", "string", "remoteip", "string"),
    ("carrier", "string", "carrier", "string"),
    ("client_type", "string", "client_type", "string"),
    ("device_name", "string", "device_name", "string"),
    ("offer_url", "string", "offer_url", "string"),
    ("webview_app", "string", "webview_app", "string"),
    ("total_click", "bigint", "total_click", "bigint"),
    ("total_view", "bigint", "total_view", "bigint"),
    ("total_lead", "bigint", "total_lead", "bigint"),
    ("ref_table_id", "bigint", "ref_cust_table_rid", "bigint"),
]
BILLING_INFO = [
    ("charge_price", "double", "charge_price", "double"),
    ("info_category", "string", "info_category", "string"),
    ("dn_status", "bigint", "dn_status", "bigint"),
]
PORTFOLIO = [
    ("ref_cust_data_table_rid", "bigint", "ref_cust_data_table_rid", "bigint"),
    ("click_time", "string", "click_time", "string"),
    ("view_time", "string", "view_time", "string"),
    ("lead_time", "string", "lead_time", "string"),
    ("conversion_time", "string", "conversion_time", "string"),
    ("click_cost", "double", "click_cost", "double"),
    ("view_cost", "double", "view_cost", "double"),
    ("lead_cost", "double", "lead_cost", "double"),
    ("conversion_cost", "double", "conversion_cost", "double"),
    ("flow_type", "string", "flow_type", "string"),
    ("flow_name", "string", "flow_name", "string"),
    ("remoteip", "string", "remote_ip", "string"),
    ("carrier", "string", "carrier", "string"),
    ("client_type", "string", "client_type", "string"),
    ("device_name", "string", "device_name", "string"),
    ("offer_url", "string", "offer_url", "string"),
    ("webview_app", "string", "webview_app", "string"),
    ("total_click", "bigint", "click_count", "bigint"),
    ("total_view", "bigint", "view_count", "bigint"),
    ("total_lead", "bigint", "lead_count", "bigint"),
    ("ref_cust_table_rid", "bigint", "ref_cust_table_rid", "bigint"),
    ("offer_name", "string", "offer_name", "string"),
    ("mo_id", "string", "mo_id", "string"),
    ("total_billed", "double", "total_billed", "double"),
    ("last_billed", "string", "last_billed", "string"),
    ("publisher_id", "string", "publisher_id", "string"),
    ("offer_price", "double", "offer_price", "double"),
    ("unsubscribetime", "string", "unsubscribe_time", "string"),
    ("status", "bigint", "status", "bigint"),
    ("investor_campaign", "bigint", "investor_campaign", "bigint"),
    ("connection_type", "string", "connection_type", "string"),
    ("sales_count", "bigint", "sales_count", "bigint"),
    ("free_sales_count", "bigint", "free_sales_count", "bigint"),
    ("update_year", "string", "update_year", "string"),
    ("update_month", "string", "update_month", "string"),
    ("resub", "bigint", "resub", "bigint"),
    ("optout24", "bigint", "optout24", "bigint"),
    ("offerid", "bigint", "offer_id", "bigint"),
    ("affiliate_id", "bigint", "affiliate_id", "bigint"),
    ("affiliate_name", "string", "affiliate_name", "string"),
    ("subscribetime", "string", "subscribe_time", "string"),
    ("country", "string", "country", "string"),
    ("gateway", "string", "gateway", "string"),
    ("free_pixels_count", "bigint", "free_pixels_count", "bigint"),
    ("pixels_count", "bigint", "pixels_count", "bigint"),
    ("first_billing_count", "bigint", "first_billing_count", "bigint"),
    ("ip2", "string", "ip2", "string"),
    ("ip3", "string", "ip3", "string"),
    ("shortcode", "bigint", "shortcode", "bigint"),
    ("keyword", "string", "keyword", "string"),
    ("operator", "string", "operator", "string"),
    ("msisdn", "bigint", "msisdn", "bigint"),
]
SUBSCRIBED_AFTER = "2018-01-01 00:00:00"


def enabled_settings(settings: DataFrame, gateway: str, country: str) -> DataFrame:
    return (
        settings.where("enabled = 'yes'")
        .where(F.col("country") == country)
        .where(F.col("gateway") == gateway)
    )


def _with_times(df: DataFrame, names: list[str]) -> DataFrame:
    """Time texts parsed; a mapping skips the columns that a source lacks."""
    return df.withColumns({n: parse_timestamp(n) for n in names if n in df.columns})


def recent_customers(customers: DataFrame) -> DataFrame:
    """Mapped subscriptions after the start date."""
    return _with_times(
        apply_mapping(customers, CUSTOMERS), ["subscribetime", "unsubscribetime"]
    ).where(F.col("subscribetime") > F.lit(SUBSCRIBED_AFTER).cast("timestamp_ntz"))


def customer_activity(data: DataFrame) -> DataFrame:
    times = ["click_time", "view_time", "lead_time", "conversion_time"]
    return _with_times(apply_mapping(data, CUSTOMER_DATA), times)


def first_billings(info: DataFrame) -> DataFrame:
    return (
        apply_mapping(info, BILLING_INFO)
        .where(F.col("charge_price") > 0)
        .where("info_category = 'first'")
        .where(F.col("dn_status") == 1)
    )


def sales_portfolio(
    customers: DataFrame, data: DataFrame, info: DataFrame, offers: DataFrame, affiliates: DataFrame,
    flows: DataFrame, gateway: str, country: str, run_date: str,
) -> DataFrame:
    """The portfolio's 52 columns, ready for the warehouse.

    Whether any first billing exists is a scalar subquery, not a job of its own.
    Timestamps leave as text.
    """
    sold = (
        recent_customers(customers).join(apply_mapping(offers, OFFERS), F.col("offer_id") == F.col("offerid"))
        .drop("offer_id").join(apply_mapping(affiliates, AFFILIATES), "affiliate_id")
    )
    flow = apply_mapping(flows, FLOWS).withColumnRenamed("flow_type", "_flow")
    activity = customer_activity(data).join(flow, safe_bigint("flow_type") == F.col("_flow")).drop("_flow")
    any_billing = first_billings(info).limit(1).agg((F.count("*") > 0).cast("int").alias("n")).scalar()
    free, paid = pixel_flags("offerid", "offer_price")
    joined = sold.join(activity, "ref_cust_table_rid").withColumns(
        {
            "ip2": ip_prefix("remoteip", 2),
            "ip3": ip_prefix("remoteip", 3),
            "connection_type": connection_type("carrier"),
            "free_sales_count": free_sale_flag("offerid"),
            "optout24": same_day_flag("subscribetime", "unsubscribetime"),
            "first_billing_count": any_billing,
            "free_pixels_count": free,
            "pixels_count": paid,
        }
    )
    stamped = with_load_stamp(
        with_constants(joined, {"sales_count": 1, "resub": 0, "country": country, "gateway": gateway}),
        run_date,
    )
    return apply_mapping(stamped, PORTFOLIO)
