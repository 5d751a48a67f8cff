"""Staged, bronze, silver and gold frames over the derived feeds."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from shelfline.catalog.feeds import Feeds
from shelfline.plans import bronze, features, gold, silver, staging
from shelfline.sources.tables import stored

# Stands for "now" wherever a job looks at the clock, so that results can be compared.
AS_OF = "2001-08-01"
AUDIT_AT = "2001-08-01 00:30:00"
RUN_TIME = "2001-08-02 06:00:00"
# Loads up to this moment make the first increment, later ones the second.
FIRST_LOAD_END = "2000-12-31 00:00:00"


class Tables(Feeds):
    @cached_property
    def orders_staged(self) -> DataFrame:
        return bronze.stage_orders(self.raw_orders, RUN_TIME)

    @cached_property
    def stg_pos(self) -> DataFrame:
        return staging.stage_pos(self.raw_pos)

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stage_inventory(self.raw_inventory)

    @cached_property
    def stg_promo(self) -> DataFrame:
        return staging.stage_promo(self.raw_promo)

    @cached_property
    def pos_cleansed(self) -> DataFrame:
        return bronze.cleanse_pos(self.raw_pos, self.dim_store, self.dim_fx)

    @cached_property
    def inventory_cleansed(self) -> DataFrame:
        return bronze.cleanse_inventory(self.raw_inventory, self.dim_store)

    @cached_property
    def readable_pos(self) -> DataFrame:
        """What the strict job takes; the rows it can't are in ``bronze.unreadable_pos``."""
        return stored(bronze.readable_pos(self.raw_pos), "readable_pos")

    @cached_property
    def pos_enriched(self) -> DataFrame:
        return bronze.enrich_pos(self.readable_pos, self.dim_product)

    @cached_property
    def fct_pos_sales(self) -> DataFrame:
        return silver.fct_pos_sales(self.stg_pos, self.dim_store, self.dim_product, self.dim_fx)

    @cached_property
    def fct_inventory(self) -> DataFrame:
        return silver.fct_inventory(self.stg_inventory, self.dim_store)

    @cached_property
    def fct_promotions(self) -> DataFrame:
        return silver.fct_promotions(self.stg_promo, self.dim_product)

    @cached_property
    def demand_features(self) -> DataFrame:
        return features.demand_features(self.pos_cleansed)

    @cached_property
    def conformed_sales(self) -> DataFrame:
        return gold.conformed_sales(self.orders_staged, self.dim_product, self.dim_fx)

    @cached_property
    def weekly_store_demand(self) -> DataFrame:
        return gold.weekly_store_demand(self.fct_pos_sales, self.dim_store, self.dim_product)
