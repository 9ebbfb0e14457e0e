"""Conflict-resolution policy: small control tables that are joined to the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from quadweld.model import (
    DEFAULT_AGG_ERROR,
    DEFAULT_CARDINALITY,
    DEFAULT_FUNCTION,
)
from quadweld.operators.stage import attach

# Fixed patterns for a usable prefix name and for an absolute IRI.
PREFIX_PATTERN = r"^[A-Za-z_][A-Za-z0-9_.-]*$"
IRI_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|^`\\]*$"

# The documented default of each field that has one.
DEFAULTS = {
    "function": DEFAULT_FUNCTION,
    "cardinality": DEFAULT_CARDINALITY,
    "agg_error": DEFAULT_AGG_ERROR,
}

STRATEGY_FIELDS = ["function", "cardinality", "agg_error", "depends_on", "params"]


def last_prefixes(prefixes: DataFrame) -> DataFrame:
    """One namespace per prefix; with a column ``position`` the last definition wins."""
    if "position" not in prefixes.columns:
        return prefixes.groupBy("prefix").agg(F.max("namespace").alias("namespace"))
    return prefixes.groupBy("prefix").agg(F.max_by("namespace", "position").alias("namespace"))


def expand_prefix(df: DataFrame, column: str, prefixes: DataFrame) -> DataFrame:
    """Replace a declared prefix by its namespace; anything else stays as it is.

    The column is looked up by its distinct heads, so a predicate column of any
    size is joined with a table no larger than the prefix list.
    """
    head = F.split_part(F.col(column), F.lit(":"), F.lit(1))
    declared = last_prefixes(prefixes).withColumnRenamed("prefix", "_head")
    rest = F.expr(f"substring(`{column}`, length(_head) + 2)")
    expanded = attach(
        df.withColumn("_head", F.when(F.col(column).contains(":"), head)),
        declared,
        ["_head"],
    )
    full = F.when(F.col("namespace").isNotNull(), F.concat("namespace", rest)).otherwise(
        F.col(column)
    )
    return expanded.withColumn(column, full).select(*df.columns)


def property_policy(strategies: DataFrame) -> DataFrame:
    """One row per property from strategy rows that list many.

    Input: ``position, properties ARRAY<STRING>`` and the strategy fields. A property
    named by several strategies takes the last one.
    """
    rows = strategies.select(F.explode("properties").alias("property"), "position", *STRATEGY_FIELDS)
    # A struct cannot be compared through its map, so max_by picks by position alone.
    last = rows.groupBy("property").agg(
        F.max_by(F.struct(*STRATEGY_FIELDS), "position").alias("strategy")
    )
    return last.select("property", "strategy.*")


def invalid_prefixes(prefixes: DataFrame) -> DataFrame:
    """Rows whose non-empty prefix or namespace is not well formed."""
    bad_name = (F.col("prefix") != "") & ~F.col("prefix").rlike(PREFIX_PATTERN)
    bad_iri = (F.col("namespace") != "") & ~F.col("namespace").rlike(IRI_PATTERN)
    return prefixes.where(bad_name | bad_iri)


@dataclass(frozen=True)
class Rules:
    """The policy on the driver: one row per configured property, and the default.

    It turns a strategy field into a condition on ``p``, which reaches the scan as
    an IN filter; a condition on a joined policy column would not.
    """

    table: DataFrame
    named: dict[str, Row]
    default: Row | None

    @classmethod
    def read(cls, policy: DataFrame) -> Rules:
        rows = policy.collect()
        table = policy.sparkSession.createDataFrame(rows, policy.schema)
        default = next((r for r in rows if r["property"] is None), Row(**dict.fromkeys(STRATEGY_FIELDS)))
        return cls(table, {r["property"]: r for r in rows if r["property"] is not None}, default)

    def _value(self, row: Row, field: str) -> str | None:
        return row[field] or DEFAULTS.get(field)

    def used(self, field: str) -> set[str]:
        rows = [*self.named.values(), *([self.default] if self.default else [])]
        return {v for v in (self._value(r, field) for r in rows) if v is not None}

    def having(self, field: str, value: str) -> Column:
        """Condition on ``p``: its strategy has this value."""
        hits = [p for p, r in self.named.items() if self._value(r, field) == value]
        misses = [p for p in self.named if p not in hits]
        if self.default is not None and self._value(self.default, field) == value:
            return ~F.col("p").isin(misses) if misses else F.lit(True)
        return F.col("p").isin(hits) if hits else F.lit(False)

    def only(self, field: str, value: str) -> Rules:
        """The strategies with this value, for rows that are already filtered by it."""
        named = {p: r for p, r in self.named.items() if self._value(r, field) == value}
        default = self.default
        if default is not None and self._value(default, field) != value:
            default = None
        return Rules(self.table, named, default)

    def params(self, name: str, default: str) -> list[str]:
        """Values of a strategy parameter over all strategies."""
        rows = [*self.named.values(), *([self.default] if self.default else [])]
        return sorted({(r["params"] or {}).get(name, default) for r in rows})

    def having_param(self, name: str, value: str, default: str) -> Column:
        """Condition on ``p``: its strategy has this parameter value."""

        def has(row: Row) -> bool:
            return (row["params"] or {}).get(name, default) == value

        hits = [p for p, r in self.named.items() if has(r)]
        misses = [p for p, r in self.named.items() if not has(r)]
        if self.default is not None and has(self.default):
            return ~F.col("p").isin(misses) if misses else F.lit(True)
        return F.col("p").isin(hits) if hits else F.lit(False)

    def properties(self, field: str, value: str) -> list[str]:
        return sorted(p for p, r in self.named.items() if self._value(r, field) == value)


def effective(field: str, default: str) -> Column:
    """A strategy's own field, else the documented default.

    ``_default`` holds the default strategy and only stands in for properties that
    have no strategy of their own.
    """
    own = F.when(F.col("_named"), F.col(field)).otherwise(F.col(f"_default.{field}"))
    return F.coalesce(own, F.lit(default))


def policy_by_property(properties: DataFrame, policy: DataFrame) -> DataFrame:
    """Effective strategy of every row of ``properties`` (column ``p``)."""
    default_row = policy.where("property IS NULL").select(*STRATEGY_FIELDS).first()
    named = policy.where("property IS NOT NULL").select(
        F.col("property").alias("p"), *STRATEGY_FIELDS, F.lit(True).alias("_named")
    )
    given = default_row.asDict() if default_row else {}
    default = F.struct(
        *[
            F.lit(given.get(f)).cast("string").alias(f)
            for f in ("function", "cardinality", "agg_error", "depends_on")
        ]
    )
    default_params = F.create_map(
        *[F.lit(x) for kv in (given.get("params") or {}).items() for x in kv]
    ).cast("map<string,string>")
    joined = (
        attach(properties, named, ["p"])
        .withColumn("_default", default)
        .withColumn("_named", F.coalesce("_named", F.lit(False)))
    )
    return joined.select(
        *properties.columns,
        effective("function", DEFAULT_FUNCTION).alias("function"),
        effective("cardinality", DEFAULT_CARDINALITY).alias("cardinality"),
        effective("agg_error", DEFAULT_AGG_ERROR).alias("agg_error"),
        F.when(F.col("_named"), F.col("depends_on"))
        .otherwise(F.col("_default.depends_on"))
        .alias("depends_on"),
        F.when(F.col("_named"), F.coalesce("params", F.create_map().cast("map<string,string>")))
        .otherwise(default_params)
        .alias("params"),
    )


def assign_policy(quads: DataFrame, policy: DataFrame) -> DataFrame:
    """Give every quad the strategy of its property (map the properties first)."""
    return policy_by_property(quads, policy)
