"""The portfolio build as a chain of DataFrames with two materialised layers.

Layer 1, ingest: customers, monthly statements and outcomes derived from the
raw tables.  Layer 2: the feature table.  Both are what the SQL line persists
as tables and what every analysis reads many times, so each is written ONCE
per (application, data folder) as a Parquet table bucketed by customer_id in
the shared checkpoint folder and re-read from there; tiers, views and scores
stay lazy projections/joins over them.  Bucketing keeps the customer_id
partitioning across the write: transitions, features and the account view
do not shuffle the statements or the features again, and a recomputation
after a lost executor starts at the stored table, not at the raw scan.

``materialize=False`` keeps everything lazy (plan inspection, tests).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cardpanel.functions.columns import heuristic_probability
from cardpanel.operators import features as feat
from cardpanel.operators import tiers as tr
from cardpanel.operators.panel import split_accounts
from cardpanel.session import drop_table, partitions_for, store_table
from cardpanel.sources.files import load_accounts, load_once, read_accounts, reasons_of, split_records
from cardpanel.sources.starschema import (Portfolio, customers_from_star, outcomes_from_panel, panel_from_star,
                                          read_tables, star_portfolio)
from cardpanel.sources.upsert import check_unique_source

_INGEST: dict[tuple[str, str], Portfolio] = {}
#: Rejected records and counts of card files.
_LOADED: dict[tuple[str, str], tuple[DataFrame, dict[str, int]]] = {}
_FEATURES: dict[tuple[str, str, str], DataFrame] = {}
#: Forgets what else was derived from a data folder (models); ``refresh`` calls each with its key.
_ON_REFRESH: list[Callable[[tuple[str, str]], None]] = []


def _app_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return spark.sparkContext.applicationId, sf_dir.rstrip("/")


def _stored(customers: DataFrame, panel_of: Callable[[DataFrame], DataFrame], paths: list[str],
            outcomes_of: Callable[[DataFrame], DataFrame], hashed: bool) -> Portfolio:
    """Customers and panel in tables bucketed by customer_id, as many buckets as
    the input's size asks for; rows are dealt to the buckets first, so each bucket
    is one file (``hashed``: the panel leaves its aggregation dealt by customer)."""
    spark = customers.sparkSession
    buckets = partitions_for(spark, paths)
    customers = store_table(customers.repartition(buckets, "customer_id"), "customers", ["customer_id"], ["customer_id"], buckets)
    panel = panel_of(customers)
    if not hashed:
        panel = panel.repartition(buckets, "customer_id")
    # planned with as many shuffle partitions as buckets, the aggregation's own shuffle deals the rows to them
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(buckets))
    try:
        panel = store_table(panel, "monthly_payments", ["customer_id"], ["customer_id", "month_number"], buckets)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return Portfolio(customers, panel, outcomes_of(panel))


def ingest(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Portfolio:
    """customers / panel / outcomes.  Customers and the panel (the expensive
    derivation from orders and line items) are stored once per application,
    both bucketed by customer_id, so every later join on the account key is
    co-partitioned; outcomes are a projection of the stored panel."""
    if not materialize:
        return star_portfolio(spark, sf_dir)
    key = _app_key(spark, sf_dir)
    if key not in _INGEST:
        t = read_tables(spark, sf_dir)
        paths = [f"{sf_dir}/{name}.parquet" for name in t]
        _INGEST[key] = _stored(customers_from_star(t["customer"]), lambda c: panel_from_star(c, t["orders"], t["lineitem"]),
                               paths, outcomes_from_panel, hashed=True)
    return _INGEST[key]


def ingest_accounts(spark: SparkSession, path: str) -> tuple[Portfolio, DataFrame, dict[str, int]]:
    """(portfolio, rejected records, counts) of a card file (CSV, bound by position).
    Records that break a type or a rule are rejected as a whole, and a file with
    two good records of one account is refused.  The file is parsed once: typed
    records with their reasons are stored, counted on the way, and all else reads
    them."""
    key = _app_key(spark, path)
    if key not in _INGEST:
        loaded, counts = load_once(load_accounts(read_accounts(spark, path)), reasons_of())
        good, rejected = split_records(loaded)
        check_unique_source(good, ["id"])
        customers, outcomes, panel = split_accounts(good)
        outcomes = store_table(outcomes, "outcomes")
        _INGEST[key] = _stored(customers, lambda _: panel, [path], lambda _: outcomes, hashed=False)
        _LOADED[key] = rejected, counts
    return _INGEST[key], *_LOADED[key]


class PortfolioPlan:
    def __init__(self, spark: SparkSession, sf_dir: str, semantics: str = "panel", materialize: bool = True,
                 portfolio: Portfolio | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.semantics = semantics
        self.materialize = materialize
        p = portfolio or ingest(spark, sf_dir, materialize)
        self.customers, self.panel, self.outcomes = p.customers, p.panel, p.outcomes
        self.rejected: DataFrame | None = None
        self.load_counts: dict[str, int] = {}

    @classmethod
    def from_accounts(cls, spark: SparkSession, path: str, semantics: str = "panel") -> PortfolioPlan:
        """The plan over a card file; ``rejected`` has the records left out,
        ``load_counts`` the accepted and rejected ones and those of each reason."""
        portfolio, rejected, counts = ingest_accounts(spark, path)
        plan = cls(spark, path, semantics, portfolio=portfolio)
        plan.rejected, plan.load_counts = rejected, counts
        return plan

    def with_semantics(self, semantics: str) -> PortfolioPlan:
        """The same tables under the other line's rounding rules."""
        return PortfolioPlan(self.spark, self.sf_dir, semantics, self.materialize, Portfolio(self.customers, self.panel, self.outcomes))

    @cached_property
    def features(self) -> DataFrame:
        f = feat.credit_features(self.panel, self.customers, self.semantics)
        if not self.materialize:
            return f
        key = (*_app_key(self.spark, self.sf_dir), self.semantics)
        if key not in _FEATURES:
            _FEATURES[key] = store_table(f, f"credit_features_{self.semantics}", ["customer_id"], ["customer_id"])
        return _FEATURES[key]

    @cached_property
    def tiers(self) -> DataFrame:
        return tr.assign_tiers(self.features)

    @cached_property
    def view(self) -> DataFrame:
        return tr.account_view(self.features, None, self.customers, self.outcomes)

    @cached_property
    def scored_view(self) -> DataFrame:
        """The account view with the heuristic score as a column (no re-join)."""
        return self.view.withColumn("risk_score", heuristic_probability())

    @cached_property
    def test_scores(self) -> DataFrame:
        """The scores of the test split: what model figures are taken from."""
        from cardpanel.operators.modeling import stratified_split
        return stratified_split(self.scores).filter("split = 'test'").drop("split")

    @cached_property
    def scores(self) -> DataFrame:
        """Deterministic heuristic probability per account with its label."""
        return self.features.join(self.outcomes, "customer_id").select(
            "customer_id", "default_next_month", heuristic_probability().alias("risk_score"))


def flagship(spark: SparkSession, sf_dir: str, materialize: bool = False) -> DataFrame:
    """Sources -> features -> tiers -> dashboard tier overview (USD, rounded)."""
    plan = PortfolioPlan(spark, sf_dir, materialize=materialize)
    return tr.portfolio_overview(plan.view, currency="USD", digits=True)


def refresh(spark: SparkSession, sf_dir: str) -> None:
    """Forget and drop the stored tables of ``sf_dir`` for this application (after
    the source tables changed), and the models trained on them; the next plan
    re-derives and stores them."""
    key = _app_key(spark, sf_dir)
    old = _INGEST.pop(key, None)
    _LOADED.pop(key, None)
    frames = [old.customers, old.panel, old.outcomes] if old else []
    frames += [_FEATURES.pop(k) for k in [k for k in _FEATURES if k[:2] == key]]
    for df in frames:
        drop_table(df)
    for forget in _ON_REFRESH:
        forget(key)
