"""Column layout of every layer, and the containers that carry a layer's tables together."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The input columns, in file order.
RAW_COLUMNS = {
    "merchants": ["merchant_id", "merchant_name", "fee_rate"],
    "orders": ["order_id", "merchant_id", "order_amount", "ordered_at"],
    "payments": [
        "payment_id",
        "order_id",
        "payment_amount",
        "payment_status",
        "settlement_batch_id",
        "paid_at",
    ],
    "settlements": [
        "settlement_id",
        "settlement_batch_id",
        "merchant_id",
        "gross_amount",
        "fee_amount",
        "net_amount",
        "settlement_status",
        "settled_at",
    ],
}

# The order mart up to its twelve flags, in output order.
ORDER_COLUMNS = [
    "order_id",
    "merchant_id",
    "merchant_name",
    "order_amount",
    "ordered_at",
    "payment_id",
    "payment_amount",
    "settlement_batch_id",
    "paid_at",
    "settlement_id",
    "settlement_merchant_id",
    "gross_amount",
    "actual_fee_amount",
    "actual_net_amount",
    "settlement_status",
    "settled_at",
    "fee_rate",
    "expected_fee_amount",
    "expected_net_amount",
]

# The error mart, in output order.
ERROR_COLUMNS = [
    "order_id",
    "merchant_id",
    "merchant_name",
    "payment_id",
    "settlement_id",
    "error_code",
    "error_reason",
    "order_amount",
    "payment_amount",
    "gross_amount",
    "actual_fee_amount",
    "expected_fee_amount",
    "actual_net_amount",
    "expected_net_amount",
    "ordered_at",
    "paid_at",
    "settled_at",
]

RATE = T.DecimalType(38, 9)


def raw_schema(table: str) -> T.StructType:
    """All columns as text: typing happens in staging, where a bad value becomes null."""
    return T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS[table]])


@dataclass(frozen=True)
class Inputs:
    """The four input tables, raw or staged."""

    merchants: DataFrame
    orders: DataFrame
    payments: DataFrame
    settlements: DataFrame

    def items(self):
        return [(name, getattr(self, name)) for name in RAW_COLUMNS]

    def tables(self) -> dict[str, DataFrame]:
        """Under the names that staged tables are stored by."""
        return {f"stg_{name}": table for name, table in self.items()}
