"""Refresh of the marts from what changed in staging (C11).

Orders are kept as a log (``LatestTable``), so the rows that changed since the last refresh are known, with their old and
their new version.  Old versions are subtracted from stored totals and new ones are added:

* sales per (group, customer), a counted multiset from which distinct customers follow, stored by month; only months
  with a change are read and written,
* totals per customer and per product.  First and last order dates can't be subtracted: customers whose first or last
  order goes away are added up anew from their orders.

Scores, ranks and anomaly flags compare all customers, products and days, so those marts are made anew from the totals;
orders are not read for them.  A refresh whose starting point is not there any more starts from all orders, by the same way.
Where much has changed, the log is resolved once, with a mark on the changed orders, for all that looks at orders.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.functions import dates, measures
from lakemart.plans import marts
from lakemart.plans.marts import COMPLETED, RETURNED, SALES_KEYS
from lakemart.sources.lake import Lake
from lakemart.sources.latest import LatestTable, Snapshot, new_version
from lakemart.workspace import Stored, complete_folders, delete, file_names, read_text, scratch, write_counted, write_text

MONTH, SIGN, CHANGED = "order_month", "_sign", "_changed"
PRODUCT_KEYS = ["product_id", "category", "sub_category", "unit_cost"]
#: Additive measures of the multiset, with their types.
SALES_SUMS = {
    "lines": "bigint", "revenue": "decimal(38,2)", "priced": "bigint", "units": "decimal(38,0)", "counted": "bigint", "discounted": "bigint",
    "profit": "decimal(38,2)", "profited": "bigint",
}
CUSTOMER_SUMS = {"lines": "bigint", "revenue": "decimal(38,2)", "priced": "bigint"}
PRODUCT_SUMS = {"lines": "bigint", "units": "decimal(38,0)", "counted": "bigint", "revenue": "decimal(38,2)", "priced": "bigint", "returned": "bigint"}
#: Versions that the months of the sales may be spread over before they are written together.
MOST_VERSIONS = 16


@dataclass
class State:
    """What the stored totals were made from and where they are; ``sales`` has the months of each version."""

    orders: dict | None = None
    products: str | None = None
    customer_totals: str | None = None
    product_totals: str | None = None
    sales: dict[str, list[str]] = field(default_factory=dict)


def refresh_marts_from(lake: Lake, orders: LatestTable, as_of: dt.date | None = None, keep: int = 2) -> dict[str, int | None]:
    """All marts after the changes of ``orders`` since the last call; staged products and customers are read as they are.

    Returns the rows written of each mart.  A call that is repeated after a failure starts from the last state that was
    written as a whole.
    """
    work = _Refresh(lake, orders)
    with scratch(lake.spark):
        return work.run(as_of, keep)


class _Refresh:
    def __init__(self, lake: Lake, orders: LatestTable):
        self.lake, self.spark, self.orders = lake, lake.spark, orders
        self.folder = lake.log_folder(lake.marts, "totals")
        self.version = new_version()
        self.whole: DataFrame | None = None  # all lines as of now, if they were stored

    def run(self, as_of: dt.date | None, keep: int) -> dict[str, int | None]:
        states = file_names(self.spark, f"{self.folder}/states")
        before = State(**json.loads(read_text(self.spark, f"{self.folder}/states/{states[-1]}"))) if states else State()
        now = self.orders.snapshot()
        new_products = f"{self.folder}/products/{self.version}"
        write_counted(self.lake.table(self.lake.stg, "stg_products").select(*PRODUCT_KEYS), new_products)
        found = self._changes(before, now, new_products)
        if found is None:  # nothing to start from
            whole = _signed(self.orders.read(now), 1)
            resolved = len(now.deltas) + (now.base is not None) < 2
            before, found = State(), (whole if resolved else Stored(whole, "all-lines").df, None)
        lines, moved = found
        after = State({"base": now.base, "deltas": now.deltas, "folded": now.folded}, new_products)
        after.sales, rows = self._sales(before, self._priced(lines if moved is None else lines.unionByName(moved), before.products, new_products))
        after.customer_totals = self._customers(before, lines, now)
        after.product_totals = self._products(before, lines)
        write_text(self.spark, f"{self.folder}/states/{self.version}.json", json.dumps(asdict(after)))
        written = {"mart_sales": rows, **self._publish(after, as_of)}
        self._forget(keep)
        return written

    # What changed

    def _changes(self, before: State, now: Snapshot, new_products: str) -> tuple[DataFrame, DataFrame | None] | None:
        """Old versions of changed orders with sign -1 and new ones with +1; beside them the orders that stay, but leave their
        groups and enter others because their product has changed.  None if the old versions can't be read."""
        if before.orders is None:
            return None
        old = Snapshot(before.orders["base"], tuple(before.orders["deltas"]), tuple(before.orders["folded"]))
        keys = self.orders.changed_keys(old, now)
        if keys is None:
            return None
        keys = Stored(keys, "changed-keys").df
        if self.orders.many_changed(old, now):
            marked = Stored(_signed(self.orders.marked(now, keys, CHANGED), 1, CHANGED), "all-lines").df
            self.whole = marked.drop(CHANGED)
            lines, stay = (marked.where(which).drop(CHANGED) for which in (F.col(CHANGED), ~F.col(CHANGED)))
            if not old.empty:
                lines = lines.unionByName(Stored(_signed(self._replaced(old, keys), -1), "replaced-lines").df)
        else:
            lines = _signed(self.orders.read(now, keys), 1)
            if not old.empty:
                lines = lines.unionByName(_signed(self.orders.read(old, keys), -1))
            lines = Stored(lines, "changed-lines").df
            stay = _signed(self.orders.read(now).join(keys, self.orders.key, "left_anti"), 1)
        was, is_now = (self.spark.read.parquet(path) for path in (before.products, new_products))
        products = Stored(was.exceptAll(is_now).unionByName(is_now.exceptAll(was)).select("product_id").distinct(), "changed-products")
        if not products.rows or old.empty:
            return lines, None
        same = Stored(marts.completed(stay).join(products.df, "product_id", "left_semi"), "moved-lines").df
        return lines, same.unionByName(same.withColumn(SIGN, -F.col(SIGN)))

    def _replaced(self, old: Snapshot, keys: DataFrame) -> DataFrame:
        """The orders as of ``old`` whose key is among many ``keys``."""
        if len(old.deltas) + (old.base is not None) == 1:  # nothing to resolve
            return self.orders.read(old, keys)
        return self.orders.marked(old, keys, CHANGED).where(CHANGED)

    def _priced(self, lines: DataFrame, old_products: str | None, new_products: str) -> DataFrame:
        """Completed lines with the product attributes of their time."""
        done = marts.completed(lines)
        found = done.where(F.col(SIGN) > 0).join(self.spark.read.parquet(new_products), "product_id", "left")
        if old_products:
            found = found.unionByName(done.where(F.col(SIGN) < 0).join(self.spark.read.parquet(old_products), "product_id", "left"))
        return found

    # Stored totals

    def _sales(self, before: State, lines: DataFrame) -> tuple[dict[str, list[str]], int]:
        """The multiset and the mart of the months with a change, in a version of their own; versions with their months."""
        c, sign = F.col, F.col(SIGN)
        margin = c("line_revenue") - c("unit_cost") * c("quantity")
        keys = [*SALES_KEYS, "customer_id"]
        change = Stored(_typed(lines.groupBy(*keys).agg(
            F.sum(sign).alias("lines"), _total(c("line_revenue")).alias("revenue"), _present(c("line_revenue")).alias("priced"),
            _total(c("quantity")).alias("units"), _present(c("quantity")).alias("counted"),
            F.sum(sign * c("is_discounted").cast("int")).alias("discounted"), _total(margin).alias("profit"), _present(margin).alias("profited"),
        ).withColumn(MONTH, dates.month_start(c("order_date"))), [MONTH, *keys], SALES_SUMS), "sales-change").df
        months = sorted(str(r[0]) for r in change.select(MONTH).distinct().collect())  # calendar months
        if len(before.sales) >= MOST_VERSIONS:
            months = sorted({*months, *(m for live in before.sales.values() for m in live)})
        if not months:
            return before.sales, 0
        parts = [change]
        for version, live in before.sales.items():
            if touched := [m for m in live if m in months]:
                stored = self.spark.read.schema(change.schema).parquet(f"{self.folder}/sales/{version}")
                parts.append(stored.where(F.col(MONTH).isin([dt.date.fromisoformat(m) for m in touched])))
        summed = _added(parts, [MONTH, *keys], SALES_SUMS)
        write_counted(summed.hint("rebalance", MONTH), f"{self.folder}/sales/{self.version}", partition_by=[MONTH])
        stored = self.spark.read.schema(change.schema).parquet(f"{self.folder}/sales/{self.version}")
        rows = write_counted(_sales_mart(stored).hint("rebalance", MONTH), f"{self.folder}/mart_sales/{self.version}", partition_by=[MONTH])
        live = {v: [m for m in known if m not in months] for v, known in before.sales.items()}
        return {**{v: m for v, m in live.items() if m}, self.version: months}, rows

    def _customers(self, before: State, lines: DataFrame, now: Snapshot) -> str:
        c, sign = F.col, F.col(SIGN)
        done = marts.completed(lines).where(c("customer_id").isNotNull())
        day = lambda when: F.when(when, c("order_date"))
        change = Stored(_typed(done.groupBy("customer_id").agg(
            F.max(day(sign > 0)).alias("last_date"), F.min(day(sign > 0)).alias("first_date"),
            F.max(day(sign < 0)).alias("last_gone"), F.min(day(sign < 0)).alias("first_gone"),
            F.sum(sign).alias("lines"), _total(c("line_revenue")).alias("revenue"), _present(c("line_revenue")).alias("priced"),
        ), ["customer_id", "last_date", "first_date", "last_gone", "first_gone"], CUSTOMER_SUMS), "customer-change")
        path = f"{self.folder}/customer_totals/{self.version}"
        extremes = {"last_date": F.max("last_date"), "first_date": F.min("first_date")}
        if not before.customer_totals:
            write_counted(_added([change.df.drop("last_gone", "first_gone")], ["customer_id"], CUSTOMER_SUMS, extremes), path)
            return path
        known = self.spark.read.parquet(before.customer_totals)
        gone = change.df.where(c("last_gone").isNotNull()).withColumnsRenamed({"last_date": "last_new", "first_date": "first_new"})
        lost_last = (c("last_gone") >= c("last_date")) & ~F.coalesce(c("last_new") >= c("last_date"), F.lit(False))
        lost_first = (c("first_gone") <= c("first_date")) & ~F.coalesce(c("first_new") <= c("first_date"), F.lit(False))
        gone = gone.select("customer_id", "last_gone", "first_gone", "last_new", "first_new")
        anew = known.join(gone, "customer_id").where(lost_last | lost_first).select("customer_id")
        anew = Stored(anew, "customers-anew")
        parts = [known, change.df.drop("last_gone", "first_gone")]
        if anew.rows:
            own = self.whole if self.whole is not None else _signed(self.orders.read(now), 1)
            own = marts.completed(own).join(anew.df, "customer_id", "left_semi")
            again = _typed(own.groupBy("customer_id").agg(
                F.max("order_date").alias("last_date"), F.min("order_date").alias("first_date"),
                F.sum(sign).alias("lines"), _total(c("line_revenue")).alias("revenue"), _present(c("line_revenue")).alias("priced"),
            ), ["customer_id", "last_date", "first_date"], CUSTOMER_SUMS)
            parts = [p.join(anew.df, "customer_id", "left_anti") for p in parts] + [again]
        write_counted(_added(parts, ["customer_id"], CUSTOMER_SUMS, extremes), path)
        return path

    def _products(self, before: State, lines: DataFrame) -> str:
        c, sign = F.col, F.col(SIGN)
        change = _typed(lines.where(c("product_id").isNotNull()).groupBy("product_id").agg(
            F.sum(sign).alias("lines"), _total(c("quantity")).alias("units"), _present(c("quantity")).alias("counted"),
            _total(c("line_revenue")).alias("revenue"), _present(c("line_revenue")).alias("priced"),
            F.sum(sign * (F.coalesce(c("order_status") == RETURNED, F.lit(False))).cast("int")).alias("returned"),
        ), ["product_id"], PRODUCT_SUMS)
        parts = [change] + ([self.spark.read.parquet(before.product_totals)] if before.product_totals else [])
        path = f"{self.folder}/product_totals/{self.version}"
        write_counted(_added(parts, ["product_id"], PRODUCT_SUMS), path)
        return path

    # Marts

    def _publish(self, state: State, as_of: dt.date | None) -> dict[str, int]:
        lake, c = self.lake, F.col
        lake.switch(lake.marts, "mart_sales", self._sales_sql(state))
        customers = self.spark.read.parquet(state.customer_totals).select(
            "customer_id", c("last_date").alias("last_order_date"), c("first_date").alias("first_order_date"), c("lines").alias("order_count"),
            _sum_of("revenue", "priced", "decimal(28,2)").alias("total_spent"), measures.safe_ratio(c("revenue"), c("priced")).alias("avg_order_value"),
        )
        products = self.spark.read.parquet(state.product_totals).select(
            "product_id", c("lines").alias("total_orders"), _sum_of("units", "counted", "decimal(28,0)").alias("total_units_sold"),
            _sum_of("revenue", "priced", "decimal(28,2)").alias("total_revenue"), measures.safe_ratio(c("revenue"), c("priced")).alias("avg_order_value"),
            c("returned").alias("returned_orders"),
        )
        staged = {name: lake.table(lake.stg, name) for name in ("stg_customers", "stg_products")}
        return {
            "mart_customer_rfm": lake.publish(lake.marts, "mart_customer_rfm", marts.rfm_of_totals(customers, staged["stg_customers"], as_of)),
            "mart_product": lake.publish(lake.marts, "mart_product", marts.product_of_totals(staged["stg_products"], products)),
            "mart_anomalies": lake.publish(lake.marts, "mart_anomalies", marts.anomalies_of_sales(lake.table(lake.marts, "mart_sales"))),
        }

    def _sales_sql(self, state: State) -> str:
        """The mart over its versions, each with the months that it still holds."""
        columns = ", ".join(f"`{x}`" for x in SALES_COLUMNS)
        parts = []
        for version, months in state.sales.items():
            listed = ", ".join(f"DATE '{m}'" for m in months)
            parts.append(f"SELECT {columns} FROM parquet.`{self.folder}/mart_sales/{version}` WHERE {MONTH} IN ({listed})")
        if not parts:
            types = {**SALES_TYPES, **{k: "string" for k in SALES_KEYS[1:]}}
            return "SELECT " + ", ".join(f"CAST(NULL AS {types[x]}) AS `{x}`" for x in SALES_COLUMNS) + " WHERE false"
        return " UNION ALL ".join(parts)

    def _forget(self, keep: int) -> None:
        """Delete what only states before the last ``keep`` ones need."""
        states = file_names(self.spark, f"{self.folder}/states")
        kept = [State(**json.loads(read_text(self.spark, f"{self.folder}/states/{s}"))) for s in states[-keep:]]
        for name in states[:-keep]:
            delete(self.spark, f"{self.folder}/states/{name}")
        used = {v for k in kept for v in k.sales} | {p.rpartition("/")[2] for k in kept for p in (k.products, k.customer_totals, k.product_totals)}
        for table in ("sales", "mart_sales", "products", "customer_totals", "product_totals"):
            for version in complete_folders(self.spark, f"{self.folder}/{table}"):
                if version not in used and version < self.version:
                    delete(self.spark, f"{self.folder}/{table}/{version}")


#: Columns of the sales mart in their order, and types of those that are made here.
SALES_TYPES = {
    "order_date": "date", MONTH: "date", "order_day_of_week": "int", "order_status": "string", "total_orders": "bigint", "unique_customers": "bigint",
    "total_revenue": "decimal(28,2)", "avg_order_value": "decimal(18,2)", "total_units_sold": "decimal(28,0)", "discounted_orders": "bigint",
    "discount_rate_pct": "decimal(18,2)", "total_gross_profit": "decimal(38,2)", "gross_profit_margin_pct": "decimal(18,2)",
}
SALES_COLUMNS = [
    "order_date", MONTH, "order_day_of_week", *SALES_KEYS[1:], "order_status", "total_orders", "unique_customers", "total_revenue", "avg_order_value",
    "total_units_sold", "discounted_orders", "discount_rate_pct", "total_gross_profit", "gross_profit_margin_pct",
]


def _signed(orders: DataFrame, sign: int, *more: str) -> DataFrame:
    """The columns that marts look at and ``more`` ones, with a sign."""
    names = ("order_id", "customer_id", "product_id", "order_date", "order_status", "shipping_country", "quantity", "line_revenue", "is_discounted")
    return orders.select(*names, *more, F.lit(sign).alias(SIGN))


def _total(value: Column) -> Column:
    """Signed sum of the values that are there."""
    return F.sum(F.when(F.col(SIGN) > 0, value).otherwise(-value))


def _present(value: Column) -> Column:
    """Signed number of the values that are there."""
    return F.sum(F.when(value.isNotNull(), F.col(SIGN)))


def _typed(sums: DataFrame, keys: list[str], types: dict[str, str]) -> DataFrame:
    return sums.select(*keys, *[F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind)).alias(name) for name, kind in types.items()])


def _added(parts: list[DataFrame], keys: list[str], types: dict[str, str], others: dict[str, Column] | None = None) -> DataFrame:
    """Signed totals added up per key; keys that have no line left drop out.

    Each part has a row a key, so one part alone is added up already and is not shuffled.
    """
    others = others or {}
    if len(parts) == 1:
        return _typed(parts[0], [*keys, *others], types).where(F.col("lines") != 0)
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    sums = rows.groupBy(*keys).agg(*[e.alias(name) for name, e in others.items()], *[F.sum(name).alias(name) for name in types])
    return _typed(sums, [*keys, *others], types).where(F.col("lines") != 0)


def _sum_of(value: str, count: str, kind: str) -> Column:
    """A sum as SQL has it: NULL if there was no value."""
    return F.when(F.col(count) > 0, F.col(value)).cast(kind)


def _sales_mart(multiset: DataFrame) -> DataFrame:
    """C5 from the lines per group and customer."""
    c = F.col
    sums = multiset.groupBy(MONTH, *SALES_KEYS).agg(
        F.count("customer_id").alias("unique_customers"), *[F.sum(name).alias(name) for name in SALES_SUMS]
    )
    profit, revenue = _sum_of("profit", "profited", "decimal(38,2)"), _sum_of("revenue", "priced", "decimal(38,2)")
    made = {
        "order_day_of_week": dates.day_of_week(c("order_date")), "order_status": F.lit(COMPLETED), "total_orders": c("lines"), "total_revenue": revenue,
        "avg_order_value": measures.safe_ratio(c("revenue"), c("priced")), "total_units_sold": _sum_of("units", "counted", "decimal(28,0)"),
        "discounted_orders": c("discounted"), "discount_rate_pct": measures.safe_pct(c("discounted"), c("lines")), "total_gross_profit": profit,
        "gross_profit_margin_pct": measures.safe_pct(profit, revenue),
    }
    return sums.select(*[(made.get(x, c(x)).cast(SALES_TYPES[x]) if x in SALES_TYPES else c(x)).alias(x) for x in SALES_COLUMNS])
