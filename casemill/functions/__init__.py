"""Column expressions (pure `pyspark.sql.functions` compositions, no UDFs)."""

from casemill.functions.columns import (
    as_of_date,
    first_value_for_key,
    join_or_default,
    message_class,
)

__all__ = [
    "as_of_date",
    "first_value_for_key",
    "join_or_default",
    "message_class",
]
