"""Masking policies and metric scans for use from SQL.

A policy is an SQL function of one value that looks at the session variable ``reader_role``. Which column of which table has
which policy is a table of its own; the views made from it name the policy, so changing a policy in one place changes
what every view shows. Like all masking here it shapes results and is no access control.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

from ledgermill.functions import fixed

ROLE = "reader_role"

_STEWARD = f"coalesce(upper({ROLE}) = '{fixed.STEWARD_ROLE}', false)"
#: name, and what a value becomes for everybody but the steward (names and hidden forms are fixed values)
POLICIES = {
    "mask_last_name": f"'{fixed.HIDDEN_NAME}'",
    "mask_phone_partial": f"concat('{fixed.HIDDEN_PHONE_PREFIX}', right(value, 4))",
}

#: table, column and policy
ATTACHED = [
    ("customer_table", "last_name", "mask_last_name"),
    ("customer_table", "phone_number", "mask_phone_partial"),
]

#: condition of the rows that a metric counts; %s is the column
METRICS = {"blank_count": "trim(%s) = ''", "null_count": "%s IS NULL"}


def create_role_variable(spark: SparkSession) -> None:
    """``SET VAR reader_role = ...`` decides what later queries show; nobody has a role at first."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE} STRING DEFAULT ''")


def create_policy(spark: SparkSession, name: str, hidden: str) -> None:
    """A policy, new or in place of the one of that name. hidden: SQL of what others see; it may use ``value``."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING "
        f"RETURN CASE WHEN {_STEWARD} THEN value ELSE {hidden} END"
    )


def create_policies(spark: SparkSession, policies: dict[str, str] | None = None) -> None:
    for name, hidden in (policies or POLICIES).items():
        create_policy(spark, name, hidden)


def masked_views(spark: SparkSession, tables: dict[str, str], attached: Iterable[tuple[str, str, str]] = ATTACHED) -> None:
    """For each table (name to the relation behind it) a view that shows its columns through their policies.

    A column that a policy names and the relation lacks is an error, as is a table that none is made of.
    """
    wanted: dict[str, dict[str, str]] = {}
    for table, column, policy in attached:
        wanted.setdefault(table, {})[column] = policy
    if missing := set(wanted) - set(tables):
        raise ValueError(f"no relation for {sorted(missing)}")
    for name, relation in tables.items():
        policies = wanted.get(name, {})
        columns = spark.table(relation).columns
        if missing := set(policies) - set(columns):
            raise ValueError(f"{name} has no {sorted(missing)}")
        shown = ", ".join(f"{policies[c]}(`{c}`) AS `{c}`" if c in policies else f"`{c}`" for c in columns)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {shown} FROM {relation}")


def metric_scan_function(spark: SparkSession, relation: str, name: str | None = None) -> str:
    """An SQL table function of a metric's name and a column's name that gives the rows which the metric counts.

    ``SELECT * FROM scan_of_transactions_table('core.blank_count', 'transaction_type')``; letter case and anything before the
    last dot of a metric do not matter. An unknown metric or column is an error of the query. Both arguments are constants, so
    the query's plan is a scan with a single condition.
    """
    name = name or f"scan_of_{relation.rsplit('.', 1)[-1]}"
    fields = spark.table(relation).schema.fields
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    texts = {f.name for f in fields if f.dataType.simpleString() == "string"}
    cases = [
        f"WHEN '{metric}/{f.name.lower()}' THEN {test % f'`{f.name}`'}"
        for metric, test in METRICS.items()
        for f in fields
        if f.name in texts or "trim" not in test
    ]
    asked = "concat(lower(element_at(split(metric, '[.]'), -1)), '/', lower(argument))"
    unknown = f"raise_error(concat('no such metric of {name}: ', metric, ' of ', argument))"
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(metric STRING, argument STRING) RETURNS TABLE ({shape}) "
        f"RETURN SELECT * FROM {relation} WHERE CASE {asked} {' '.join(cases)} ELSE CAST({unknown} AS BOOLEAN) END"
    )
    return name
