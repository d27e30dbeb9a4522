"""Business measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakemart.functions import casts

# Stock labels, and the bands as (exclusive upper limit, label).
STOCK_NONE = "Out of Stock"
STOCK_BANDS = [(20, "Low Stock")]
STOCK_ABOVE = "In Stock"

# Customer segments in order of precedence, with the least and greatest
# recency, frequency and monetary score of each.
SEGMENT_RULES = [
    ("Champions", (4, None), (4, None), (4, None)),
    ("Loyal Customers", (3, None), (3, None), (None, None)),
    ("New Customers", (4, None), (None, 2), (None, None)),
    ("Potential Loyalists", (3, None), (None, 2), (3, None)),
    ("At Risk", (None, 2), (3, None), (3, None)),
    ("Cant Lose Them", (None, 2), (4, None), (4, None)),
    ("Lost", (None, 2), (None, 2), (None, None)),
]
SEGMENT_ELSE = "Needs Attention"


def safe_ratio(num: Column, den: Column, scale: int = 2) -> Column:
    """``num / den`` rounded half up; NULL where ``den`` is 0.

    The operands keep six digits, and the quotient ten before it is rounded.
    """
    quotient = num.cast("decimal(24,6)") / F.nullif(den.cast("decimal(22,6)"), F.lit(0).cast("decimal(22,6)"))
    return F.round(quotient, scale).cast("decimal(18,2)")


def safe_pct(num: Column, den: Column) -> Column:
    """Share in percent with two digits."""
    return safe_ratio(num.cast("decimal(20,6)") * 100, den)


def mean_amount(amount: Column) -> Column:
    """Rounded mean of the non-NULL amounts."""
    return safe_ratio(F.sum(amount), F.count(amount))


def line_revenue(quantity: Column, unit_price: Column, discount_pct: Column) -> Column:
    """B1: NULL if quantity or price is; no discount counts as 0."""
    paid = F.lit(1) - F.coalesce(discount_pct, F.lit(0).cast("decimal(5,2)")) / 100
    return F.round(quantity * unit_price * paid, 2).cast("decimal(18,2)")


def is_discounted(discount_pct: Column) -> Column:
    """B2"""
    return F.coalesce(discount_pct > 0, F.lit(False))


def gross_margin(unit_price: Column, unit_cost: Column) -> Column:
    """B3"""
    return F.round(unit_price - unit_cost, 2).cast("decimal(12,2)")


def gross_margin_pct(unit_price: Column, unit_cost: Column) -> Column:
    """B3"""
    return safe_pct(unit_price - unit_cost, unit_price)


def band(value: Column, limits: list[tuple[int, str]], above: str) -> Column:
    """Label of the first limit that ``value`` stays below; ``above`` otherwise and for NULL."""
    label = F.lit(above)
    for limit, name in reversed(limits):
        label = F.when(value < limit, name).otherwise(label)
    return label


def stock_status(stock_qty: Column) -> Column:
    """An unknown stock counts as in stock."""
    return F.when(stock_qty == 0, STOCK_NONE).otherwise(band(stock_qty, STOCK_BANDS, STOCK_ABOVE))


def is_incomplete(email: Column) -> Column:
    """On the e-mail as received, so one of blanks only counts as given."""
    return email.isNull() | (email == "")


def rfm_average(*scores: Column) -> Column:
    """B13"""
    total = sum(scores[1:], scores[0])
    return F.round(total.cast("decimal(10,0)") / len(scores), 2).cast("decimal(5,2)")


def rfm_cell(*scores: Column) -> Column:
    """The scores as one string."""
    return F.concat(*[casts.as_text(s) for s in scores])


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """The first rule that holds names the segment.  'At Risk' hides 'Cant Lose Them'."""
    label = F.lit(SEGMENT_ELSE)
    for name, *ranges in reversed(SEGMENT_RULES):
        holds = F.lit(True)
        for score, (low, high) in zip((recency, frequency, monetary), ranges):
            if low is not None:
                holds = holds & (score >= low)
            if high is not None:
                holds = holds & (score <= high)
        label = F.when(holds, name).otherwise(label)
    return label
