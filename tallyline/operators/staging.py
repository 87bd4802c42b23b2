"""Raw tables to staged tables: same columns, cleaned and typed, one output row per input row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.cleaning import (
    blank_to_null,
    clean_status,
    clean_text,
    safe_amount,
    safe_rate,
    safe_timestamp,
)
from tallyline.schemas import Inputs


def _moment(raw: DataFrame, name: str) -> Column:
    """A column that already is a timestamp, with or without zone, keeps its type."""
    if isinstance(raw.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return safe_timestamp(F.col(name)).alias(name)


def _text(name: str) -> Column:
    return clean_text(F.col(name)).alias(name)


def _amount(raw: DataFrame, name: str) -> Column:
    return safe_amount(F.col(name), raw.schema[name].dataType).alias(name)


def _status(name: str) -> Column:
    return clean_status(F.col(name)).alias(name)


def stage_merchants(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("merchant_id"),
        _text("merchant_name"),
        safe_rate(F.col("fee_rate")).alias("fee_rate"),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("order_id"),
        _text("merchant_id"),
        _amount(raw, "order_amount"),
        _moment(raw, "ordered_at"),
    )


def stage_payments(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("payment_id"),
        _text("order_id"),
        _amount(raw, "payment_amount"),
        _status("payment_status"),
        blank_to_null(F.col("settlement_batch_id")).alias("settlement_batch_id"),
        _moment(raw, "paid_at"),
    )


def stage_settlements(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("settlement_id"),
        _text("settlement_batch_id"),
        _text("merchant_id"),
        _amount(raw, "gross_amount"),
        _amount(raw, "fee_amount"),
        _amount(raw, "net_amount"),
        _status("settlement_status"),
        _moment(raw, "settled_at"),
    )


STAGES = {
    "merchants": stage_merchants,
    "orders": stage_orders,
    "payments": stage_payments,
    "settlements": stage_settlements,
}


def stage(raw: Inputs) -> Inputs:
    return Inputs(**{name: STAGES[name](table) for name, table in raw.items()})
