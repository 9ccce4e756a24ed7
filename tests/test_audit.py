"""All declared constraints in one scan a table."""

from conftest import SF_SMALL

from ledgerline.operators.quality import Constraint, audit
from ledgerline.plans import catalog
from ledgerline.plans.stages import Ledger

CONSTRAINTS = [
    Constraint("parent", "PRIMARY KEY", "k"), Constraint("parent", "NOT NULL", "k"), Constraint("parent", "UNIQUE", "name"),
    Constraint("child", "FOREIGN KEY", "a", parent=("parent", "k")), Constraint("child", "FOREIGN KEY", "b", parent=("parent", "k")),
    Constraint("child", "FOREIGN KEY", "n", parent=("parent", "name")), Constraint("child", "CHECK", "v", rule="v > 0"),
    Constraint("child", "NOT NULL", "v"), Constraint("child", "UNIQUE", "v")]


def violations(spark, parent, child):
    tables = {"parent": spark.createDataFrame(parent, "k long, name string"), "child": spark.createDataFrame(child, "a long, b int, n string, v double")}
    return {(r.table_name, r.constraint_type, r.column_name): r.violations for r in audit(tables, CONSTRAINTS).collect()}


def test_every_kind_of_violation(spark):
    parent = [(1, "x"), (2, "x"), (2, "y"), (2, None), (None, None), (None, "z")]
    child = [(1, 2, "x", 1.0), (9, 1, "y", -1.0), (9, None, None, 0.0), (8, 7, "q", None), (None, 1, "q", 1.0)]
    assert violations(spark, parent, child) == {
        ("parent", "PRIMARY KEY", "k"): 3, ("parent", "NOT NULL", "k"): 2, ("parent", "UNIQUE", "name"): 2,
        ("child", "FOREIGN KEY -> k", "a"): 3, ("child", "FOREIGN KEY -> k", "b"): 1, ("child", "FOREIGN KEY -> name", "n"): 2,
        ("child", "CHECK (v > 0)", "v"): 2, ("child", "NOT NULL", "v"): 1, ("child", "UNIQUE", "v"): 2}
    assert set(violations(spark, [], []).values()) == {0}
    assert violations(spark, [], [(1, 1, None, 1.0)])["child", "FOREIGN KEY -> k", "a"] == 1


def test_each_table_is_scanned_once_and_keys_are_counted_before_the_shuffle(spark):
    tables = catalog._star_tables(Ledger(spark, SF_SMALL))
    result = audit(tables, catalog.star_constraints())
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # the persisted fact is the only table with all five foreign keys
    assert sum("sender_key" in line and "receiver_key" in line for line in plan.splitlines() if "FileScan" in line) == 1
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning(key" in line]
    assert len(shuffles) == 2 and "SortMergeJoin" not in plan.split("Exchange hashpartitioning(key")[-1]
    assert result.count() == len(catalog.star_constraints())
