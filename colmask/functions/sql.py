"""The masks as SQL functions, for readers who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from colmask.functions.names import quote_ident, quote_table, quote_text
from colmask.functions.redact import MASK_FUNCTIONS, redact_sql, text_sql

# Fixed value: the group whose members see the stored values.
ACCESS_GROUP = "pii_access"


def granted_sql(grants_table: str, group: str = ACCESS_GROUP, closure_table: str | None = None) -> str:
    """Condition that the reader is in ``group``, looked up when the query runs.

    With a ``closure_table`` (member, grp), as ``group_closure`` makes it, members of groups inside the group
    are in it as well; it has to be made again when groups are put into other groups.
    """
    if closure_table is not None:
        return (
            f"EXISTS (SELECT 1 FROM {quote_table(grants_table)} g JOIN {quote_table(closure_table)} c ON c.member = g.grp "
            f"WHERE g.principal = current_user() AND c.grp = {quote_text(group)})"
        )
    return (
        f"EXISTS (SELECT 1 FROM {quote_table(grants_table)} g "
        f"WHERE g.principal = current_user() AND g.grp = {quote_text(group)})"
    )


def register_mask_functions(
    spark: SparkSession,
    grants_table: str,
    group: str = ACCESS_GROUP,
    schema: str | None = None,
    decimal_type: str = "DECIMAL(10,2)",
    closure_table: str | None = None,
) -> list[str]:
    """Create the nine mask functions; safe to repeat.

    They look up the reader in ``grants_table`` (principal, grp) when a query
    runs (and ``closure_table``, see ``granted_sql``), and Spark inlines them, so a query over them stays native. Without
    ``schema`` they live as long as the session. SQL functions have one
    decimal type, so a value of another scale is cast to ``decimal_type``
    first; :func:`colmask.functions.redact.mask_expr` takes any precision.
    """
    authorized = granted_sql(grants_table, group, closure_table)
    scope = "FUNCTION" if schema else "TEMPORARY FUNCTION"
    prefix = f"{quote_table(schema)}." if schema else ""
    names = []
    for dtype, function in MASK_FUNCTIONS.items():
        name = prefix + quote_ident(function)
        spark.sql(
            f"CREATE OR REPLACE {scope} {name}(v {decimal_type if dtype == 'decimal' else dtype}) "
            f"RETURNS STRING RETURN CASE WHEN {authorized} THEN {text_sql('v')} "
            f"ELSE {redact_sql('v', dtype)} END"
        )
        names.append(name)
    return names
