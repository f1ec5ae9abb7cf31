"""Row expectations: warn, drop or fail, with counters per rule."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A named SQL condition. A row for which it is not true, NULL included, violates it."""

    name: str
    condition: str
    action: str = WARN

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


class ExpectationError(Exception):
    """A rule with action ``fail`` was violated; nothing has been written."""


def rules(conditions: Mapping[str, str], action: str = WARN) -> list[Rule]:
    """Bulk form: every condition of the mapping with the same action."""
    return [Rule(name, condition, action) for name, condition in conditions.items()]


def counters(checks: list[Rule]) -> list[Column]:
    """Aggregates: all rows, and the rows that violate each rule."""
    failed = [F.count_if(~r.holds()).alias(f"failed_{r.name}") for r in checks]
    return [F.count(F.lit(1)).alias("rows"), *failed]


def expect(df: DataFrame, checks: list[Rule]) -> tuple[DataFrame, Observation]:
    """Rows that pass all ``drop`` rules, and counters filled while the rows are processed.

    A row that violates a ``fail`` rule ends the job that processes the rows, so a write of them
    publishes nothing; the error names the rule. No second pass is needed.
    """
    seen = Observation()
    observed = df.observe(seen, *counters(checks))
    return enforce(observed, checks), seen


def expect_stream(stream: DataFrame, checks: list[Rule], name: str) -> DataFrame:
    """The same for a stream: the counters are reported with every batch under ``name``, and a
    violated ``fail`` rule ends the batch before it is committed."""
    return enforce(stream.observe(name, *counters(checks)), checks)


def drop_rules_hold(checks: list[Rule]) -> Column:
    kept = F.lit(True)
    for rule in checks:
        if rule.action == DROP:
            kept = kept & rule.holds()
    return kept


def enforce(df: DataFrame, checks: list[Rule]) -> DataFrame:
    """Rows that pass all ``drop`` rules; a row that violates a ``fail`` rule raises an error, also
    when a ``drop`` rule would take it out. The rules are one condition, tried in this order."""
    kept = drop_rules_hold(checks)
    for rule in reversed(checks):
        if rule.action == FAIL:
            error = F.raise_error(f"violated expectation: {rule.name}").cast("boolean")
            kept = F.when(rule.holds(), kept).otherwise(error)
    return df.filter(kept)


def apply_drops(df: DataFrame, checks: list[Rule]) -> DataFrame:
    for rule in checks:
        if rule.action == DROP:
            df = df.filter(rule.holds())
    return df


def expectation_report(df: DataFrame, checks: list[Rule], dataset: str) -> DataFrame:
    """Passed and failed rows per rule, from one pass over the data."""
    items = F.array(*[
        F.struct(F.lit(r.name).alias("name"), F.lit(dataset).alias("dataset"),
                 F.lit(r.action).alias("action"),
                 (F.col("rows") - F.col(f"failed_{r.name}")).alias("passed_records"),
                 F.col(f"failed_{r.name}").alias("failed_records")) for r in checks])
    return df.agg(*counters(checks)).select(F.inline(items))


def require(df: DataFrame, checks: list[Rule]) -> DataFrame:
    """``df`` unchanged, or an error when a ``fail`` rule is violated. Call it before a write."""
    strict = [r for r in checks if r.action == FAIL]
    if strict:
        counts = df.agg(*counters(strict)).first()
        broken = {r.name: counts[f"failed_{r.name}"] for r in strict if counts[f"failed_{r.name}"]}
        if broken:
            raise ExpectationError(f"violated expectations: {broken}")
    return df


# Rules of the order quality flow per layer.
BRONZE_RULES = rules({"valid_json": "_rescued_data IS NULL"})
SILVER_RULES = rules({
    "valid_customer": "customer_id IS NOT NULL",
    "valid_product": "product_id IS NOT NULL",
    "positive_quantity": "quantity > 0",
    "positive_price": "unit_price > 0",
}, DROP)
GOLD_RULES = rules({"has_orders": "order_count > 0"}, FAIL)


def reasonable_date(as_of: str) -> Rule:
    return Rule("reasonable_date", f"order_date <= DATE '{as_of}'", WARN)


@dataclass
class Layers:
    bronze: DataFrame
    silver: DataFrame
    gold: DataFrame
    drops: list[Rule]

    def counts(self) -> DataFrame:
        """Rows per layer and rows dropped on the way to silver. Bronze is read once for three."""
        kept = F.lit(True)
        for rule in self.drops:
            kept = kept & rule.holds()
        rows = F.count(F.lit(1))
        passed = F.count_if(kept)
        items = {"bronze": rows, "silver": passed, "dropped": rows - passed}
        seen = self.bronze.agg(*[c.alias(name) for name, c in items.items()])
        gold = self.gold.agg(rows.alias("row_count")).select(F.lit("gold").alias("layer"),
                                                             "row_count")
        return seen.unpivot([], list(items), "layer", "row_count").unionByName(gold)


def dq_layers(orders: DataFrame, as_of: str, check: bool = True) -> Layers:
    """Bronze keeps all rows, silver drops invalid ones, gold fails on an empty day."""
    checks = [*SILVER_RULES, reasonable_date(as_of)]
    silver = apply_drops(orders, checks)
    gold = silver.groupBy("order_date", "channel").agg(
        F.count("*").alias("order_count"),
        F.sum(F.col("quantity") * F.col("unit_price")).alias("revenue"))
    return Layers(orders, silver, enforce(gold, GOLD_RULES) if check else gold,
                  [r for r in checks if r.action == DROP])
