"""Report of refunds whose mail is pending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_stamp


def pending_refunds(refunds: DataFrame, now: str) -> DataFrame:
    stamp = iso_stamp(F.lit(now).cast("timestamp_ntz"))
    return refunds.where(~F.col("emailRefundStatus")).select(
        F.col("orderNumber").alias("Order Number"),
        stamp.alias("Date Created"),
        F.col("refundAmount").alias("Amount"),
        F.col("refundTransactionId").alias("TXN ID"),
        F.col("paymentMethod").alias("Payment Method"),
        F.col("refundReason").alias("Reason"),
    )
