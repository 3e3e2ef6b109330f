"""All models over one source, each stored once and read by the ones after it."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import DataFrame

from omnimart.plans import core, marts, staging
from omnimart.session import pin

MODELS = (
    "stg_orders",
    "stg_payments",
    "stg_retail_events",
    "stg_customer_identities",
    "stg_customers",
    "stg_products",
    "stg_inventory",
    "stg_price_history",
    "identity_bridge",
    "dim_customer",
    "dim_product",
    "dim_product_price",
    "fct_sales",
    "fct_retail_event",
    "fct_payments",
    "available_to_promise",
    "payment_reconciliation",
    "customer_rfm",
    "repricing",
)

# Plain projections of a source or of another model: nothing to gain by storing them.
VIEWS = frozenset(
    {
        "stg_customers",
        "stg_products",
        "stg_inventory",
        "stg_price_history",
        "dim_product",
        "dim_product_price",
        "fct_payments",
    }
)


# Staged models that can be cut to some columns before their rows are ranked.
STAGED_PARTS = frozenset({"stg_orders", "stg_payments", "stg_retail_events"})


class Warehouse(Mapping[str, DataFrame]):
    """Models by name, built on first use; later models read the stored earlier ones.

    ``columns`` names, for some models, the only columns that readers and later models use; the others are
    neither shuffled nor stored. The rows and the values of the columns that stay are the same.
    """

    def __init__(self, source: staging.Source, columns: Mapping[str, Collection[str]] | None = None):
        self.source = source
        self.columns = columns or {}
        self._built: dict[str, DataFrame] = {}

    def __iter__(self) -> Iterator[str]:
        return iter(MODELS)

    def __len__(self) -> int:
        return len(MODELS)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._build(name)
            if name in self.columns:
                df = df.select(*self.columns[name])
            self._built[name] = df if name in VIEWS else pin(df, name)
        return self._built[name]

    def register_views(self, prefix: str = "") -> list[str]:
        """One temporary view per model, for SQL users."""
        for name in MODELS:
            self[name].createOrReplaceTempView(prefix + name)
        return [prefix + name for name in MODELS]

    def _build(self, name: str) -> DataFrame:
        if name in STAGED_PARTS:
            return getattr(staging, name)(self.source, wanted=self.columns.get(name))
        if name.startswith("stg_"):
            return getattr(staging, name)(self.source)
        if name == "identity_bridge":
            return core.identity_bridge(self["stg_customer_identities"], self["stg_customers"])
        if name == "dim_customer":
            return core.dim_customer(self["stg_customers"], self["identity_bridge"])
        if name == "dim_product":
            return core.dim_product(self["stg_products"])
        if name == "dim_product_price":
            return core.dim_product_price(self["stg_price_history"])
        if name == "fct_sales":
            return core.fct_sales(self["stg_orders"], self["identity_bridge"])
        if name == "fct_retail_event":
            return core.fct_retail_event(self["stg_retail_events"], self["identity_bridge"])
        if name == "fct_payments":
            return core.fct_payments(self["stg_payments"])
        if name == "available_to_promise":
            return marts.available_to_promise(self["stg_inventory"], self["fct_sales"])
        if name == "payment_reconciliation":
            return marts.payment_reconciliation(self["fct_sales"], self["fct_payments"])
        if name == "customer_rfm":
            return marts.customer_rfm(self["fct_sales"], self["dim_customer"])
        if name == "repricing":
            return marts.repricing(self["dim_product"], self["stg_inventory"], self["fct_sales"])
        raise KeyError(name)
