"""Read-only ad hoc SQL entry (S5) and its result contract.

``run_sql`` returns ``(DataFrame, None)`` or ``(None, message)``, the same
contract as the course's runner.  The statement is wrapped as a derived
table, ``SELECT * FROM (<q>) q``, so only a single query parses: DDL, DML,
``EXPLAIN`` and two statements fail at parse time, ``SHOW TABLES`` fails at
analysis.  Errors in the data (ANSI overflow, bad casts) surface only at the
action that runs the plan.
"""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession


_PIECE = re.compile(r"'(?:[^'\\\\]|\\\\.|'')*'|\"(?:[^\"\\\\]|\\\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;|\s+|.", re.S)


def _strip(sql: str) -> str:
    """The statement without a final ``;`` and the comments behind it."""
    end, closed = 0, False
    for m in _PIECE.finditer(sql):
        piece = m[0]
        if piece == ";":
            closed = True
        elif not (piece.isspace() or piece.startswith(("--", "/*"))):
            if closed:
                return sql.strip()  # a second statement: left for the parser to refuse
            end = m.end()
    return sql[:end].strip()


def run_sql(spark: SparkSession, sql: str) -> tuple[DataFrame | None, str | None]:
    """Plan one read-only query over the registered views."""
    text = _strip(sql)
    if not text:
        return None, "empty statement"
    try:
        df = spark.sql("SELECT * FROM (\n" + text + "\n) q")
        df.schema  # force analysis so unknown tables/columns are reported here
        return df, None
    except PySparkException as exc:
        return None, str(exc)


def row_count(df: DataFrame) -> int:
    """Number of result rows (one distributed count; only when asked for)."""
    return df.count()
