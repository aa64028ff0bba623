"""Layers on disk, each table built once per run from the tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.context import RunContext
from tallyhouse.plans.customers import dim_customers
from tallyhouse.plans.dates import dim_dates
from tallyhouse.plans.fact import fact_transactions
from tallyhouse.plans.monthly import monthly_customer_summary
from tallyhouse.plans.performance import product_performance
from tallyhouse.plans.products import dim_products
from tallyhouse.plans.staging import stg_transactions
from tallyhouse.sources.raw import load_raw
from tallyhouse.sources.versions import read_table, replace_table

LAYERS = {
    "customer_transactions": "raw",
    "stg_transactions": "staging",
    "dim_customers": "mart",
    "dim_products": "mart",
    "dim_dates": "mart",
    "fact_transactions": "mart",
    "monthly_customer_summary": "mart",
    "product_performance": "mart",
}
# the marts that read other marts
LATE_MARTS = ["monthly_customer_summary", "product_performance"]


class Warehouse:
    """Tables under ``root``, each built once per run from the tables it reads.

    Marts are written without a final sort, and read back from their files: a
    small dimension then has a known size, which is what lets Spark decide by
    itself whether to broadcast it.

    Staging has some seven readers, from the marts to the tests, so it is written
    once instead of parsing the text for each. ``staging_view`` leaves it a view,
    which saves its storage and costs that parsing. ``padded_names`` fills the day and
    month names of the calendar with blanks to nine characters.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        source: Callable[[], DataFrame],
        ctx: RunContext,
        staging_view: bool = False,
        padded_names: bool = False,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.source = source
        self.ctx = ctx
        self.staging_view = staging_view
        self.padded_names = padded_names
        self._built: set[str] = set()

    def path(self, name: str) -> str:
        return f"{self.root}/{LAYERS[name]}/{name}"

    def table(self, name: str) -> DataFrame:
        """A table of any layer, built first when this run has not built it yet."""
        if LAYERS[name] == "staging" and self.staging_view:
            return self.model(name)
        if name not in self._built:
            if name == "customer_transactions":
                load_raw(self.spark, self.source(), self.path(name), self.ctx)
            else:
                replace_table(self.model(name), self.path(name))
            self._built.add(name)
        return read_table(self.spark, self.path(name))

    def model(self, name: str) -> DataFrame:
        """The query of a table over the tables it reads, not yet written."""
        if name == "stg_transactions":
            return stg_transactions(self.table("customer_transactions"))
        if name in LATE_MARTS:
            fact, dates = self.table("fact_transactions"), self.table("dim_dates")
            if name == "product_performance":
                return product_performance(fact, dates, self.table("dim_products"), self.ctx)
            return monthly_customer_summary(fact, dates, self.table("dim_customers"), self.ctx)
        stg = self.table("stg_transactions")
        build = {
            "dim_customers": dim_customers,
            "dim_products": dim_products,
            "dim_dates": partial(dim_dates, padded_names=self.padded_names),
            "fact_transactions": fact_transactions,
        }[name]
        return build(stg, self.ctx)

    def rebuild(self, name: str, ctx: RunContext) -> DataFrame:
        """Overwrite one mart as a new run; a type 1 dimension keeps no history."""
        self.table(name)
        self.ctx = ctx
        self._built.discard(name)
        return self.table(name)

    def start(self) -> None:
        """Begin a new run: every table is built again when it is next asked for."""
        self._built.clear()

    def build_layer(self, layer: str) -> dict[str, DataFrame]:
        """The tables of one layer, over the tables below it that are already there.

        Tables that do not read each other are written at the same time, so that the
        last tasks of one do not leave the cluster idle.
        """
        names = [name for name, of in LAYERS.items() if of == layer]
        with ThreadPoolExecutor(max_workers=4) as pool:
            for together in ([n for n in names if n not in LATE_MARTS], [n for n in names if n in LATE_MARTS]):
                list(pool.map(self.table, together))
        return {name: self.table(name) for name in names}

    def build(self) -> dict[str, DataFrame]:
        """Every layer; running it again replaces every table with the same rows."""
        self.start()
        return {name: df for layer in dict.fromkeys(LAYERS.values()) for name, df in self.build_layer(layer).items()}
