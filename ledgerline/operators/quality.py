"""Validation rules, valid/quarantine split, constraint audits, defaults and the DQ gate
(V1-V11) plus stage row metrics (M1).

Every rule is a total (never NULL) boolean, so a row lands in exactly one of the two outputs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import nan_to_null

HASH_LENGTH = 66
MONEY_LIMIT = 1e10

# Rule names used in the quarantine's failed_rules list.
RULES = ("amount_positive", "sender_not_receiver", "hash_length", "timestamp_present", "money_fits")


def rule_columns() -> dict[str, Column]:
    amount, fee = nan_to_null("amount"), nan_to_null("fee")
    return {
        "amount_positive": F.coalesce(amount > 0, F.lit(False)),                                   # V1
        "sender_not_receiver": F.coalesce(F.col("sender") != F.col("receiver"), F.lit(True)),     # V2
        "hash_length": F.coalesce(F.length("tx_hash") == HASH_LENGTH, F.lit(False)),              # V3
        "timestamp_present": F.col("timestamp").isNotNull(),                                      # V4
        # the warehouse's DECIMAL(18,8) and its DECIMAL(18,2) in USD hold amounts below 10^10
        "money_fits": F.coalesce(F.abs(amount) < MONEY_LIMIT, F.lit(True)) & F.coalesce(F.abs(fee) < MONEY_LIMIT, F.lit(True)),
    }


def with_rules(df: DataFrame) -> DataFrame:
    rules = rule_columns()
    is_valid = reduce(lambda a, b: a & b, rules.values())
    failed = F.concat_ws(",", *[F.when(~cond, F.lit(name)) for name, cond in rules.items()])
    return df.withColumns({"_is_valid": is_valid, "failed_rules": failed})


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V5: (valid, invalid). Invalid rows keep a comma list of the rules they failed."""
    tagged = with_rules(df)
    valid = tagged.where(F.col("_is_valid")).drop("_is_valid", "failed_rules")
    invalid = tagged.where(~F.col("_is_valid")).drop("_is_valid")
    return valid, invalid


# ---- constraint audits over built tables (V6-V9) -------------------------------------------

@dataclass(frozen=True)
class Constraint:
    """``kind`` is NOT NULL, PRIMARY KEY, UNIQUE, FOREIGN KEY or CHECK. A foreign key names its ``parent`` (table, column),
    whose own key must be among the constraints; a check has its ``rule``, a SQL condition that NULL passes."""

    table: str
    kind: str
    column: str
    parent: tuple[str, str] | None = None
    rule: str | None = None

    @property
    def label(self) -> str:
        return {"FOREIGN KEY": f"FOREIGN KEY -> {self.parent and self.parent[1]}", "CHECK": f"CHECK ({self.rule})"}.get(self.kind, self.kind)


def audit(tables: dict[str, DataFrame], constraints: list[Constraint]) -> DataFrame:
    """V6-V9: table_name, constraint_type, column_name and violations for every constraint, from one scan of each table.

    Each row of a table gives one (key, value, place) for each of its keys: place 0 for a unique key's own column, 1 and up
    for the foreign keys that point at it. They are counted by (key, value) in the map tasks, so that of a hot foreign key
    one row a task is shuffled and of a table never a whole row; the one shuffle brings a parent's value and its
    children together. A value with several rows at place 0 breaks UNIQUE, one with rows at another place and none at place 0
    breaks that foreign key. NULLs and broken checks are counted under a key of their own. As in SQL, NULL breaks no
    key and no check.
    """
    spark = next(iter(tables.values())).sparkSession
    own = {(c.table, c.column): i for i, c in enumerate(constraints) if c.kind in ("PRIMARY KEY", "UNIQUE")}
    children: dict[int, int] = {}
    slots: list[tuple[int, int, str]] = []                      # of each constraint: key, place, how it is judged
    for i, c in enumerate(constraints):
        if c.kind == "FOREIGN KEY":
            key = own[c.parent]
            children[key] = children.get(key, 0) + 1
            slots.append((key, children[key], "orphan"))
        else:
            slots.append((i, 0, "repeat" if (c.table, c.column) in own and own[c.table, c.column] == i else "count"))

    def entry(i: int) -> Column:
        c, (key, place, judged) = constraints[i], slots[i]
        col = F.col(c.column)
        broken = col.isNull() if c.kind == "NOT NULL" else F.coalesce(~F.expr(c.rule), F.lit(False)) if c.kind == "CHECK" else None
        value = F.lit("") if judged == "count" else col.cast("string")
        made = F.struct(F.lit(key).alias("key"), value.alias("value"), F.lit(place).alias("place"))
        return F.when(broken if judged == "count" else col.isNotNull(), made)

    parts = []
    for name, table in tables.items():
        mine = [i for i, c in enumerate(constraints) if c.table == name]
        if mine:
            parts.append(table.select(F.explode(F.array_compact(F.array(*[entry(i) for i in mine]))).alias("e")).select("e.*"))
    places = max(children.values(), default=0) + 1
    at = lambda p: F.count_if(F.col("place") == p)
    values = reduce(DataFrame.unionByName, parts).groupBy("key", "value").agg(*[at(p).alias(f"n{p}") for p in range(places)])
    totals = values.groupBy("key").agg(F.sum("n0").alias("count"), F.sum(F.when(F.col("n0") > 1, F.col("n0"))).alias("repeat"),
                                       *[F.sum(F.when(F.col("n0") == 0, F.col(f"n{p}"))).alias(f"orphan{p}") for p in range(1, places)])
    long = totals.select("key", F.explode(F.create_map(*[x for c in totals.columns[1:] for x in (F.lit(c), F.col(c))])).alias("judged", "n"))
    names = spark.createDataFrame([(c.table, c.label, c.column, i, key, f"orphan{place}" if judged == "orphan" else judged)
                                   for i, (c, (key, place, judged)) in enumerate(zip(constraints, slots, strict=True))],
                                  "table_name string, constraint_type string, column_name string, number int, key int, judged string")
    return (names.join(long, ["key", "judged"], "left")
            .select("table_name", "constraint_type", "column_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("violations")))


def apply_defaults(df: DataFrame, defaults: dict[str, Column | object]) -> DataFrame:
    """Column defaults, filled where the value is NULL."""
    return df.withColumns({c: F.coalesce(F.col(c), v if isinstance(v, Column) else F.lit(v))
                           for c, v in defaults.items()})


# ---- post-load gate (V11) -------------------------------------------------------------------

def quality_counts(df: DataFrame) -> DataFrame:
    """One row: total, rows with amount <= 0, rows with NULL tx_hash (0, not NULL, when clean)."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col("amount") <= 0).cast("bigint").alias("bad_amount"),
                  F.count_if(F.col("tx_hash").isNull()).cast("bigint").alias("null_hash"))


class QualityGateError(AssertionError):
    pass


def assert_quality(df: DataFrame) -> dict:
    """Run the gate; raise if any bad row exists. Returns the counts."""
    row = quality_counts(df).first().asDict()
    if row["bad_amount"] != 0:
        raise QualityGateError(f"quality gate: amounts that are not positive: {row['bad_amount']}")
    if row["null_hash"] != 0:
        raise QualityGateError(f"quality gate: rows without a transaction hash: {row['null_hash']}")
    return row


# ---- stage metrics (M1) ---------------------------------------------------------------------

def observed_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next (a stage write), with no
    extra job: ``obs.get["rows"]`` after the action."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def stage_metrics(stages: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """(stage, rows_in, rows_out) from count aggregates of each stage's input and output."""
    rows = []
    for name, before, after in stages:
        rows_out = after.agg(F.count(F.lit(1))).scalar()
        rows.append(before.agg(F.count(F.lit(1)).alias("rows_in"))
                    .select(F.lit(name).alias("stage"), "rows_in", rows_out.alias("rows_out")))
    return reduce(DataFrame.unionByName, rows)
