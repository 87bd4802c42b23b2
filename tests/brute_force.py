"""The order mart by nested loops over plain rows, written apart from the Spark code."""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal


def _text(value):
    return None if value is None else value.strip()


def _number(value):
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def _time(value):
    try:
        return datetime.strptime(value, "%Y-%m-%d %H:%M:%S")
    except (TypeError, ValueError):
        return None


def _matches(rows, position, key):
    found = [row for row in rows if key is not None and row[position] == key]
    return found or [None]


def order_rows(tables: dict[str, list[tuple]]) -> list[tuple]:
    """(order, payment, settlement, master name, expected fee, raised flags) per mart row."""
    merchants = [(_text(m), _text(n), Decimal(r) if r else None) for m, n, r in tables["merchants"]]
    paid = [
        (_text(p), _text(o), _number(a), _text(b) or None, _time(t))
        for p, o, a, status, b, t in tables["payments"]
        if status and _text(status).upper() == "SUCCESS"
    ]
    settled = [
        (_text(s), _text(b), _text(m), _number(g), _number(f), _number(n),
         _text(status).upper() if status else None, _time(t))
        for s, b, m, g, f, n, status, t in tables["settlements"]
    ]
    result = []
    for raw_id, raw_merchant, raw_amount, raw_time in tables["orders"]:
        order, merchant = _text(raw_id), _text(raw_merchant)
        for payment in _matches(paid, 1, order):
            for settlement in _matches(settled, 1, payment[3] if payment else None):
                for master in _matches(merchants, 0, merchant):
                    result.append(
                        _judged(order, merchant, _number(raw_amount), _time(raw_time), payment,
                                settlement, master)
                    )
    return result


def _judged(order, merchant, amount, ordered, payment, settlement, master):
    rate = master[2] if master else None
    paid_amount, paid_time = (payment[2], payment[4]) if payment else (None, None)
    fee = None
    if paid_amount is not None and rate is not None:
        fee = int((paid_amount * rate).quantize(Decimal(1), ROUND_HALF_UP))
    raised = set()
    if master is None:
        raised.add("is_merchant_missing")
    elif rate is None:
        raised.add("is_fee_rate_missing")
    if payment is None:
        raised.add("is_payment_missing")
    else:
        if amount != paid_amount:
            raised.add("is_order_payment_amount_mismatch")
        if settlement is None:
            raised.add("is_settlement_missing")
        if ordered is None or paid_time is None or paid_time < ordered:
            raised.add("is_payment_datetime_invalid")
    if settlement is not None:
        _, _, settled_merchant, gross, actual_fee, net, status, settled_time = settlement
        checks = {
            "is_settlement_not_completed": status != "COMPLETED",
            "is_merchant_mismatch": merchant != settled_merchant,
            "is_gross_amount_mismatch": gross != paid_amount,
            "is_fee_amount_mismatch": fee is not None and actual_fee != fee,
            "is_net_amount_mismatch": fee is not None and net != paid_amount - fee,
            "is_settlement_datetime_invalid":
                paid_time is None or settled_time is None or settled_time < paid_time,
        }
        raised |= {code for code, failed in checks.items() if failed}
    return (
        order,
        payment[0] if payment else None,
        settlement[0] if settlement else None,
        master[1] if master else None,
        fee,
        frozenset(raised),
    )
