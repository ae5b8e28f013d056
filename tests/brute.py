"""Gold tables worked out row by row in plain Python, straight from their definition.

Inputs are lists of dicts; results are dicts keyed by the grain of the table.
"""

from __future__ import annotations

from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

CENT = Decimal("0.01")


def cents(x) -> Decimal:
    return Decimal(str(x)).quantize(CENT, ROUND_HALF_UP)


def ratio(n, d) -> float:
    return float(cents(Decimal(repr(float(n) / float(d))))) if d and d > 0 else 0.0


def products_of_ads(spend):
    found = {}
    for r in spend:
        key, old = (r["product_id"], r["product_name"]), found.get(r["ad_id"])
        better = old is None or (key[0] is not None and (old[0] is None or key < old))
        if better:
            found[r["ad_id"]] = key
    return found


def reach_deltas(snapshots):
    totals = defaultdict(int)
    for r in snapshots:
        totals[(r["ad_id"], r["fecha"])] += r["reach"]
    deltas, previous = {}, {}
    for ad, day in sorted(totals, key=lambda k: (str(k[0]), k[1] is not None, str(k[1]))):
        total = totals[(ad, day)]
        deltas[(ad, day)] = max(total - previous[ad], 0) if ad in previous else total
        previous[ad] = total
    return deltas


def active_grid(snapshots):
    days = {r["fecha"] for r in snapshots if r["fecha"] is not None}
    starts = {}
    for r in snapshots:
        start = r["ad_delivery_start_time"]
        known = starts.setdefault(r["ad_id"], start)
        if start is not None and (known is None or start < known):
            starts[r["ad_id"]] = start
    return {
        (ad, day): start
        for ad, start in starts.items() if start is not None
        for day in days if day >= start
    }


def ad_daily(sales, spend, snapshots):
    product = products_of_ads(spend)
    deltas = reach_deltas(snapshots)
    spent, sold = defaultdict(Decimal), defaultdict(lambda: [0, Decimal(0)])
    for r in spend:
        spent[(r["ad_id"], r["fecha"])] += r["daily_spend"]
    for r in sales:
        entry = sold[(r["fecha"], r["product_id"], r["product_name"])]
        entry[0] += r["ventas_unidades"]
        entry[1] += r["ventas_importe"]
    table = {}
    for (ad, day), start in active_grid(snapshots).items():
        pid, name = product.get(ad, (None, None)) if ad is not None else (None, None)
        units, amount = (0, Decimal(0))
        if pid is not None and name is not None:
            units, amount = sold.get((day, pid, name), (0, Decimal(0)))
        cost = spent.get((ad, day), Decimal(0)) if ad is not None else Decimal(0)
        new = deltas.get((ad, day), 0) if ad is not None else 0
        table[(ad, day)] = (
            pid, name, cents(cost), new, units, cents(amount),
            ratio(amount, cost), (day - start).days,
        )
    return table


def ad_totals(daily):
    sums = defaultdict(lambda: [Decimal(0), 0, 0, Decimal(0)])
    for (ad, _), (pid, name, cost, new, units, amount, _, _) in daily.items():
        entry = sums[(ad, pid, name)]
        for i, x in enumerate((cost, new, units, amount)):
            entry[i] += x
    return {k: (*v, ratio(v[3], v[0])) for k, v in sums.items()}


def saturation(sales, spend):
    spent, sold = defaultdict(Decimal), defaultdict(lambda: [0, Decimal(0)])
    for r in spend:
        spent[r["fecha"]] += r["daily_spend"]
    for r in sales:
        sold[r["fecha"]][0] += r["ventas_unidades"]
        sold[r["fecha"]][1] += r["ventas_importe"]
    table = {}
    for day, cost in spent.items():
        units, amount = sold.get(day, (0, Decimal(0))) if day is not None else (0, Decimal(0))
        table[day] = (cents(cost), units, cents(amount), ratio(amount, cost))
    return table


def demographic_reach(spend, snapshots):
    product = products_of_ads(spend)
    return sorted(
        (
            (r["fecha"], r["ad_id"], *product.get(r["ad_id"], (None, None)),
             r["country"], r["age_range"], gender, r[gender])
            for r in snapshots for gender in ("female", "male")
            if r[gender] > 0 and r["fecha"] is not None and r["ad_id"] is not None
        ),
        key=str,
    )
