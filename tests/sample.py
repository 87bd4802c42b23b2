"""A small shop's month: 200 orders with every anomaly, as untyped input rows.

Orders O001 to O030 are fixed values with known results. O031 to O200 are clean orders by rule.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import SparkSession

from tallyline.schemas import Inputs, raw_schema

# Id, name, rate.
MERCHANTS = """
M001,青葉ストア,0.03
M002,みどり商店,0.035
M003,さくら電器,0.04
M004,つばき書店,
M005,ひかり雑貨,0.025
M006,あさひ食品,0.045
"""

# Id, merchant, amount, time.
ORDERS = """
O001,M001,10000,2026-07-01 10:00:00
O002,M001,5000,2026-07-01 11:00:00
O003,M999,8000,2026-07-02 09:30:00
O004,M004,12000,2026-07-02 14:00:00
O005,M003,20000,2026-07-03 10:15:00
O006,M003,15000,2026-07-03 16:20:00
O007,M001,3000,2026-07-04 12:00:00
O008,M002,10000,2026-07-04 15:30:00
O009,M005,14633,2026-08-15 13:55:00
O010,M001,16223,2026-08-26 08:27:00
O011,M005,17813,2026-07-10 13:40:00
O012,M001,19403,2026-07-21 08:53:00
O013,M003,20993,2026-08-01 13:25:00
O014,M006,21106,2026-08-12 08:38:00
O015,M002,22696,2026-08-23 13:51:00
O016,M005,24286,2026-07-07 08:23:00
O017,M001,25876,2026-07-18 13:36:00
O018,M003,27466,2026-07-29 08:49:00
O019,M006,29056,2026-08-09 13:21:00
O020,M002,30646,2026-08-20 08:34:00
O021,M005,30759,2026-08-31 13:47:00
O022,M002,32349,2026-07-15 09:00:00
O023,M005,33939,2026-07-26 13:32:00
O024,M001,35529,2026-08-06 08:45:00
O025,M999,37119,2026-08-17 13:58:00
O026,M004,38709,2026-08-28 08:30:00
O027,M002,40299,2026-07-12 13:43:00
O028,M005,40412,2026-07-23 08:56:00
O029,M001,42002,2026-08-03 13:28:00
O030,M003,43592,2026-08-14 08:41:00
"""

# Id, order, amount, status, batch, time.
PAYMENTS = """
P001,O001,10000,SUCCESS,B001,2026-07-01 10:01:00
P002,O002,4500,SUCCESS,B002,2026-07-01 11:01:00
P003,O003,8000,FAILED,,2026-07-02 09:31:00
P005,O005,20000,SUCCESS,B005,2026-07-03 10:16:00
P006,O006,15000,SUCCESS,B006,2026-07-03 16:21:00
P007,O007,3000,SUCCESS,B007,2026-07-04 12:01:00
P008,O008,10000,SUCCESS,B008,2026-07-04 15:31:00
P010,O010,16223,FAILED,,2026-08-26 08:29:00
P012,O012,19403,FAILED,,2026-07-21 08:55:00
P013,O013,20993,SUCCESS,B013,2026-08-01 13:30:00
P014,O014,21106,SUCCESS,B014,2026-08-12 08:44:00
P015,O015,22696,SUCCESS,B015,2026-08-23 13:58:00
P016,O016,24286,SUCCESS,B016,2026-07-07 08:31:00
P017,O017,25705,SUCCESS,B017,2026-07-18 13:45:00
P018,O018,27292,SUCCESS,B018,2026-07-29 08:48:00
P019,O019,28879,SUCCESS,B019,2026-08-09 13:23:00
P020,O020,30646,SUCCESS,B020,2026-08-20 08:37:00
P021,O021,30759,SUCCESS,B021,2026-08-31 13:51:00
P022,O022,32349,SUCCESS,B022,2026-07-15 09:05:00
P023,O023,33939,SUCCESS,B023,2026-07-26 13:38:00
P024,O024,35529,SUCCESS,B024,2026-08-06 08:52:00
P025,O025,37119,SUCCESS,B025,2026-08-17 14:06:00
P026,O026,38709,SUCCESS,B026,2026-08-28 08:39:00
P027,O027,40299,SUCCESS,B027,2026-07-12 13:44:00
P028,O028,40412,SUCCESS,B028,2026-07-23 08:58:00
P029,O029,42002,SUCCESS,B029,2026-08-03 13:21:00
P030,O030,43592,SUCCESS,B030,2026-08-14 08:45:00
"""

# Id, batch, merchant, gross, fee, net, status, time.
SETTLEMENTS = """
S001,B001,M001,10000,300,9700,COMPLETED,2026-07-05 09:00:00
S002,B002,M001,4500,135,4365,COMPLETED,2026-07-05 09:05:00
S006,B006,M003,15000,600,14300,COMPLETED,2026-07-06 09:00:00
S007,B007,M001,3000,90,2910,COMPLETED,2026-07-06 09:05:00
S008,B008,M002,10000,350,9650,COMPLETED,2026-07-06 09:10:00
S017,B017,M002,25705,771,24934,COMPLETED,2026-07-21 16:45:00
S018,B018,M003,27292,1092,26200,COMPLETED,2026-08-02 12:50:00
S019,B019,M006,28879,1300,27579,COMPLETED,2026-08-14 18:23:00
S020,B020,M002,30647,1073,29573,PENDING,2026-08-22 09:37:00
S021,B021,M005,30759,769,29990,PENDING,2026-08-31 13:50:00
S022,B022,M002,32349,1132,31217,PENDING,2026-07-19 12:05:00
S023,B023,M005,33939,882,33090,COMPLETED,2026-07-31 17:38:00
S024,B024,M001,35529,1101,34463,COMPLETED,2026-08-08 13:52:00
S025,B025,M999,37119,0,37119,COMPLETED,2026-08-20 15:06:00
S026,B026,M004,38709,0,38709,COMPLETED,2026-09-01 10:39:00
S027,B027,M001,40299,1410,38889,COMPLETED,2026-07-17 16:44:00
S028,B028,M005,40662,1010,39402,COMPLETED,2026-07-25 12:58:00
S029,B029,M001,42002,1260,40742,COMPLETED,2026-08-06 18:21:00
S030,B030,M003,43592,1744,41848,COMPLETED,2026-08-14 08:33:00
"""

# The flags that each order in error must raise. All other orders match.
EXPECTED_ERRORS = {
    "O002": {"is_order_payment_amount_mismatch"},
    "O003": {"is_payment_missing", "is_merchant_missing"},
    "O004": {"is_payment_missing", "is_fee_rate_missing"},
    "O005": {"is_settlement_missing"},
    "O006": {"is_net_amount_mismatch"},
    "O009": {"is_payment_missing"},
    "O010": {"is_payment_missing"},
    "O011": {"is_payment_missing"},
    "O012": {"is_payment_missing"},
    "O013": {"is_settlement_missing"},
    "O014": {"is_settlement_missing"},
    "O015": {"is_settlement_missing"},
    "O016": {"is_settlement_missing"},
    "O017": {"is_order_payment_amount_mismatch", "is_merchant_mismatch"},
    "O018": {"is_order_payment_amount_mismatch", "is_payment_datetime_invalid"},
    "O019": {"is_order_payment_amount_mismatch"},
    "O020": {"is_settlement_not_completed", "is_gross_amount_mismatch"},
    "O021": {"is_settlement_not_completed", "is_settlement_datetime_invalid"},
    "O022": {"is_settlement_not_completed"},
    "O023": {"is_fee_amount_mismatch", "is_net_amount_mismatch"},
    "O024": {"is_fee_amount_mismatch"},
    "O025": {"is_merchant_missing"},
    "O026": {"is_fee_rate_missing"},
    "O027": {"is_merchant_mismatch"},
    "O028": {"is_gross_amount_mismatch"},
    "O029": {"is_payment_datetime_invalid"},
    "O030": {"is_settlement_datetime_invalid"},
}

# The distribution over all 200 orders.
EXPECTED_METRICS = {
    "total_orders": 200,
    "matched_orders": 173,
    "error_orders": 27,
    "is_payment_missing": 6,
    "is_merchant_missing": 2,
    "is_fee_rate_missing": 2,
    "is_order_payment_amount_mismatch": 4,
    "is_settlement_missing": 5,
    "is_settlement_not_completed": 3,
    "is_merchant_mismatch": 2,
    "is_gross_amount_mismatch": 2,
    "is_fee_amount_mismatch": 2,
    "is_net_amount_mismatch": 2,
    "is_payment_datetime_invalid": 2,
    "is_settlement_datetime_invalid": 2,
    "error_detail_rows": 34,
}


def _rows(text: str) -> list[tuple]:
    return [tuple(v or None for v in line.split(",")) for line in text.strip().splitlines()]


def sample_rows() -> dict[str, list[tuple]]:
    tables = {
        "merchants": _rows(MERCHANTS),
        "orders": _rows(ORDERS),
        "payments": _rows(PAYMENTS),
        "settlements": _rows(SETTLEMENTS),
    }
    rates = {key: Decimal(rate) for key, _, rate in tables["merchants"] if rate}
    for n in range(31, 201):
        merchant = sorted(rates)[n % len(rates)]
        amount = 1000 + 137 * n
        fee = int((amount * rates[merchant]).quantize(Decimal(1), ROUND_HALF_UP))
        ordered = datetime(2026, 7, 1, 8) + timedelta(hours=7 * n)
        paid, settled = ordered + timedelta(minutes=n % 9), ordered + timedelta(days=2 + n % 3)
        tables["orders"].append((f"O{n:03}", merchant, str(amount), str(ordered)))
        tables["payments"].append(
            (f"P{n:03}", f"O{n:03}", str(amount), "SUCCESS", f"B{n:03}", str(paid))
        )
        tables["settlements"].append(
            (f"S{n:03}", f"B{n:03}", merchant, str(amount), str(fee), str(amount - fee),
             "COMPLETED", str(settled))
        )
    return tables


def make_inputs(spark: SparkSession, tables: dict[str, list[tuple]]) -> Inputs:
    """Raw tables from literal rows; a table that is not given is empty."""
    return Inputs(
        **{
            name: spark.createDataFrame(tables.get(name, []), raw_schema(name))
            for name in ("merchants", "orders", "payments", "settlements")
        }
    )
