"""The lineage from landing tables to facts, as lazily connected DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, cached_property

from pyspark.sql import DataFrame

from harborline.operators import (
    advertising, attribution, cleaning, history, reconciliation, sales,
)


class Warehouse:
    """Every table of the platform, derived on demand from its landing tables.

    ``landing`` returns the untyped table of a given name.  Only the
    tables an output needs are part of its plan.
    A ``cached_property`` keeps the DataFrame object, not its rows; only the
    reconciliation writes intermediate rows to the shared folder.
    """

    def __init__(
        self,
        landing: Callable[[str], DataFrame],
        utm_sources: DataFrame,
        campaigns: DataFrame,
    ):
        self.landing = cache(landing)
        self.utm_source_seed = utm_sources
        self.campaign_seed = campaigns

    # orders
    @cached_property
    def order_base(self) -> DataFrame:
        return cleaning.order_base(self.landing("orders"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return cleaning.clean_orders(self.order_base)

    @cached_property
    def dated_orders(self) -> DataFrame:
        return cleaning.with_business_date(self.stg_orders)

    @cached_property
    def rejected_orders(self) -> DataFrame:
        return cleaning.rejected_orders(self.order_base)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return cleaning.clean_items(self.landing("order_items"))

    @cached_property
    def stg_customers(self) -> DataFrame:
        return cleaning.clean_customers(self.landing("customers"))

    @cached_property
    def stg_products(self) -> DataFrame:
        return cleaning.clean_products(self.landing("products"))

    @cached_property
    def order_status_history(self) -> DataFrame:
        return history.status_history(self.landing("orders"))

    @cached_property
    def orders_enriched(self) -> DataFrame:
        return sales.enriched_orders(self.stg_orders, self.stg_customers, self.stg_order_items)

    @cached_property
    def located_orders(self) -> DataFrame:
        """Orders with customer and region only, for questions that need no lines."""
        return sales.with_customer(self.dated_orders, self.stg_customers)

    @cached_property
    def order_lines(self) -> DataFrame:
        return sales.order_lines(self.dated_orders, self.landing("order_items"), self.stg_products)

    @cached_property
    def daily_orders(self) -> DataFrame:
        return sales.daily_orders(self.dated_orders)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return sales.daily_sales(self.order_lines)

    @cached_property
    def refund_analysis(self) -> DataFrame:
        return sales.refund_analysis(self.order_lines)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return sales.customer_dimension(self.stg_customers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return sales.product_dimension(self.stg_products)

    # reconciliation
    @cached_property
    def norm_gateway(self) -> DataFrame:
        return reconciliation.normalize_gateway(self.landing("gateway_txns"))

    @cached_property
    def norm_ledger(self) -> DataFrame:
        return reconciliation.normalize_ledger(self.landing("ledger_entries"))

    @cached_property
    def recon_sides(self) -> DataFrame:
        return reconciliation.stored_sides(self.landing("gateway_txns"), self.landing("ledger_entries"))

    @cached_property
    def recon_results(self) -> DataFrame:
        return reconciliation.reconcile_sides(self.recon_sides)

    @cached_property
    def recon_summary(self) -> DataFrame:
        # the stored sides hold what the daily totals need
        gateway = self.recon_sides.where("side = 'G'").selectExpr("day AS txn_date", "amount")
        ledger = self.recon_sides.where("side = 'L'").selectExpr("day AS entry_date", "amount")
        return reconciliation.daily_summary(gateway, ledger, self.recon_results)

    @cached_property
    def recon_alerts(self) -> DataFrame:
        return reconciliation.alerts(self.recon_summary)

    # advertising
    @cached_property
    def stg_fx_rates(self) -> DataFrame:
        return cleaning.clean_fx_rates(self.landing("fx_rates"))

    @cached_property
    def stg_ad_performance(self) -> DataFrame:
        return advertising.clean_ads(self.landing("ad_performance"), self.stg_fx_rates)

    @cached_property
    def stg_utm_touches(self) -> DataFrame:
        return advertising.clean_touches(self.landing("utm_touches"), self.utm_source_seed)

    @cached_property
    def campaign_mapping(self) -> DataFrame:
        return advertising.campaign_mapping(self.stg_ad_performance, self.stg_utm_touches, self.campaign_seed)

    @cached_property
    def attributed_revenue(self) -> DataFrame:
        return attribution.attributed_revenue(
            self.stg_utm_touches, self.dated_orders, self.campaign_seed, self.landing("utm_touches")
        )

    @cached_property
    def channel_performance(self) -> DataFrame:
        return attribution.channel_performance(self.stg_ad_performance, self.attributed_revenue)

    @cached_property
    def campaign_performance(self) -> DataFrame:
        return attribution.campaign_performance(
            self.stg_ad_performance, self.attributed_revenue, self.campaign_seed
        )
