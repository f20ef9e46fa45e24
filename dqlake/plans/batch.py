"""Validation of a batch of three datasets as lazy plans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from dqlake.operators import rules, splits
from dqlake.operators.rules import CHECKS, flag_rows
from dqlake.sources.staging import stage

DATASETS = ("customers", "products", "orders")
PARENT_KEYS = {"customers": "customer_id", "products": "product_id"}


@dataclass
class Flagged:
    """Flagged rows per dataset. Parents are flagged first: only their valid keys count for orders."""

    customers: DataFrame
    products: DataFrame
    orders: DataFrame

    def __getitem__(self, dataset: str) -> DataFrame:
        return getattr(self, dataset)

    def valid(self, dataset: str) -> DataFrame:
        return splits.valid_rows(self[dataset])

    def totals(self, dataset: str) -> DataFrame:
        return splits.totals(self[dataset], dataset, CHECKS[dataset])

    def metrics(self) -> DataFrame:
        parts = [
            splits.metrics(self.totals(d), CHECKS[d], self[d].columns).withColumn("seq", F.col("seq") + 10 * n)
            for n, d in enumerate(DATASETS)
        ]
        return reduce(DataFrame.unionByName, parts)

    def all_totals(self) -> DataFrame:
        return reduce(
            DataFrame.unionByName, [self.totals(d).select("dataset", "ingested", "valid") for d in DATASETS]
        )


def valid_keys(flagged: DataFrame, key: str) -> DataFrame:
    """Keys of the valid rows; distinct, because rows that share a key fail the uniqueness check."""
    return splits.valid_rows(flagged).select(key)


def flag_batch(raw: dict[str, DataFrame]) -> Flagged:
    """The flagged rows as lazy plans. For one use; several uses should start from ``stage_batch``."""
    customers, products = (flag_rows(raw[d], CHECKS[d]) for d in ("customers", "products"))
    parents = {d: rules.valid_keys(raw[d], CHECKS[d], key) for d, key in PARENT_KEYS.items()}
    return Flagged(customers, products, flag_rows(raw["orders"], CHECKS["orders"], parents))


def stage_batch(raw: dict[str, DataFrame], folder: str) -> Flagged:
    """Flag the batch and write each dataset once; whatever follows reads the written tables."""
    done = {}
    for d in ("customers", "products"):
        done[d] = stage(flag_rows(raw[d], CHECKS[d], store=True), d, f"{folder}/{d}")
    parents = {d: valid_keys(done[d], key) for d, key in PARENT_KEYS.items()}
    done["orders"] = stage(flag_rows(raw["orders"], CHECKS["orders"], parents, store=True), "orders", f"{folder}/orders")
    return Flagged(**done)
