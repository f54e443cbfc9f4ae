"""Column functions: lead times, discounts, prices, dates, labels, messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: (largest quantity, days); beyond the last step 7 days
LEAD_STEPS = ((10, 0), (100, 1), (1000, 4))
LEAD_BEYOND = 7
# fixed values: (quantity below, rate); beyond the last step 0.15
DISCOUNT_STEPS = ((100, "0.00"), (500, "0.05"), (1000, "0.10"))
DISCOUNT_BEYOND = "0.15"
MAX_DISCOUNT = "0.30"


def lead_days(quantity: Column) -> Column:
    out = F.when(quantity <= LEAD_STEPS[0][0], LEAD_STEPS[0][1])
    for limit, days in LEAD_STEPS[1:]:
        out = out.when(quantity <= limit, days)
    return out.otherwise(LEAD_BEYOND)


def delivery_date(day: Column, quantity: Column) -> Column:
    return F.date_add(day, lead_days(quantity))


def _rate(text: str) -> Column:
    return F.lit(text).cast("decimal(4,2)")


def clamp_rate(rate: Column) -> Column:
    return F.greatest(_rate("0.00"), F.least(rate.cast("decimal(4,2)"), _rate(MAX_DISCOUNT)))


def discount_rate(quantity: Column) -> Column:
    out = F.when(quantity < DISCOUNT_STEPS[0][0], _rate(DISCOUNT_STEPS[0][1]))
    for limit, rate in DISCOUNT_STEPS[1:]:
        out = out.when(quantity < limit, _rate(rate))
    return clamp_rate(out.otherwise(_rate(DISCOUNT_BEYOND)))


def price_parts(unit_price: Column, quantity: Column, rate: Column) -> dict[str, Column]:
    """``subtotal``, ``discount``, ``total``: half-even rounding to cents at each step, on decimals."""
    subtotal = F.bround(unit_price * quantity, 2).cast("decimal(18,2)")
    discount = F.bround(subtotal * rate, 2).cast("decimal(18,2)")
    return {"subtotal": subtotal, "discount": discount, "total": F.bround(subtotal - discount, 2).cast("decimal(18,2)")}


def shortage(requested: Column, available: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), requested - available)


def reorder_quantity(stock: Column, minimum: Column, line_quantity: Column) -> Column:
    """Quantity to reorder when the stock is under the minimum; null otherwise."""
    return F.when(stock < minimum, F.greatest(minimum * 2 - stock, line_quantity))


def queue_days(volume: Column) -> Column:
    return F.greatest(F.lit(1.0), volume / 10)


# fixed values: queue priorities
NORMAL, RUSH, EMERGENCY = 1, 2, 3


def eta_days(volume: Column, priority: Column) -> Column:
    """Days until an order added to a queue of this volume is ready."""
    days = queue_days(volume)
    days = F.when(priority == EMERGENCY, F.lit(1.0)).when(priority == RUSH, F.greatest(F.lit(1.0), days / 2)).otherwise(days)
    return F.greatest(F.lit(1).cast("long"), F.floor(days) + 1)


def complexity_days(is_complex: Column, quantity: Column) -> Column:
    """Base of 3 (complex) or 1 days times half the quantity, at least once."""
    return F.when(is_complex, 3).otherwise(1) * F.greatest(F.lit(1).cast("long"), F.floor(quantity / 2))


def fulfilment_status(delivery: Column, requested_by: Column) -> Column:
    return F.when(requested_by.isNotNull() & (delivery > requested_by), "NOT_FULFILLED").otherwise("FULFILLED")


# fixed values: reasons given with a line
LATE = "Requested delivery date cannot be met. Earliest possible: "
SHORT = "Supplier lead time required due to shortage."
BAD_LINE = "Invalid quantity or missing item name."
UNKNOWN_ITEM = "Unknown item (not in catalog)."


def fulfilment_reason(delivery: Column, requested_by: Column, short: Column) -> Column:
    late = F.concat(F.lit(LATE), delivery.cast("string"), F.lit("."))
    return (
        F.when(requested_by.isNotNull() & (delivery > requested_by), late)
        .when(short > 0, SHORT)
        .otherwise("")
    )


# fixed values: customer texts
MESSAGES = {
    "invalid": "Your request could not be processed due to invalid item information.",
    "quote": "Here is your quote with pricing and estimated delivery dates.",
    "placed": "Your order has been successfully placed.",
    "counter_offer": "We cannot meet your requested delivery date. Here is a counter-offer.",
    "other": "Request processed.",
}


def customer_message(status: Column, intent: Column) -> Column:
    """Text for the customer: invalid requests first, then quotes, then the outcome of an order; else it is just processed."""
    kind = F.when(status == "INVALID", "invalid").when(intent == "QUOTE", "quote")
    ordered = intent == "ORDER"
    kind = kind.when(ordered & (status == "FULFILLED"), "placed").when(ordered & (status == "NOT_FULFILLED"), "counter_offer")
    return value_of(MESSAGES, kind, MESSAGES["other"])


# fixed values: statuses from best to worst
STATUS_ORDER = ("FULFILLED", "NOT_FULFILLED", "INVALID")


def worst_status(status: Column) -> Column:
    """Aggregate: the worst status of a group; INVALID for a group without lines."""
    place = F.array_position(F.array(*[F.lit(s) for s in STATUS_ORDER]), status)
    worst = F.max(F.when(place > 0, place))
    return F.coalesce(F.element_at(F.array(*[F.lit(s) for s in STATUS_ORDER]), worst.cast("int")), F.lit("INVALID"))


def booking_confirmation(customer: Column, service: Column, urgent: Column, special: Column, kind: Column) -> Column:
    """Confirmation text; the urgent tag and the priority-service part only where they apply."""
    tag = F.when(urgent, " URGENTLY").otherwise("")
    extra = F.when(special, F.concat(F.lit(" with "), kind, F.lit(" priority service"))).otherwise("")
    return F.concat(customer, F.lit("'s "), service, F.lit(" service booking is confirmed"), tag, extra, F.lit("."))


# fixed values: severity weights and risk limits
SEVERITY_WEIGHTS = {"low": 0.3, "medium": 0.6, "high": 0.8, "critical": 1.0}
SEVERITY_DEFAULT = 0.5
RISK_LIMITS = ((0.3, "low"), (0.7, "medium"), (1.2, "high"))
RECOMMENDATIONS = {
    "low": "Proceed with normal processing",
    "medium": "Flag for manual review before approving",
    "high": "Requires investigator review before processing",
    "critical": "Suspend claim and initiate fraud investigation",
}
RECOMMENDATION_DEFAULT = "Requires further assessment"


def value_of(mapping: dict, key: Column, default) -> Column:
    """Constant lookup as a CASE chain, so no join is needed."""
    out = None
    for k, v in mapping.items():
        out = F.when(key == k, F.lit(v)) if out is None else out.when(key == k, F.lit(v))
    return out.otherwise(F.lit(default))


def severity_weight(severity: Column) -> Column:
    return value_of(SEVERITY_WEIGHTS, severity, SEVERITY_DEFAULT)


def risk_class(score: Column) -> Column:
    out = F.when(score < RISK_LIMITS[0][0], RISK_LIMITS[0][1])
    for limit, name in RISK_LIMITS[1:]:
        out = out.when(score < limit, name)
    return out.otherwise("critical")


def recommendation(risk: Column) -> Column:
    return value_of(RECOMMENDATIONS, risk, RECOMMENDATION_DEFAULT)


# fixed value: USD per token
COST_PER_TOKEN = 0.375 / 1_000_000


def token_cost(tokens: Column) -> Column:
    return tokens * F.lit(COST_PER_TOKEN)
