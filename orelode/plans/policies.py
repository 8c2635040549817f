"""Column policies that are decided when a view is read, by the role that the reading session has then."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from orelode.specs import MASKED_TEXT, PII_COLUMNS, UNMASKED_ROLES

#: The session variable that holds the role; NULL, as in a new session, is a role without rights.
ROLE = "orelode_role"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def declare_role(spark: SparkSession) -> None:
    """The session's role variable, which stays as it is where there is one."""
    try:
        spark.sql(f"SELECT session.{ROLE}")
    except AnalysisException:
        spark.sql(f"DECLARE VARIABLE {ROLE} STRING DEFAULT NULL")


def set_role(spark: SparkSession, role: str | None) -> None:
    """What the session reads from now on it reads in this role."""
    declare_role(spark)
    spark.sql(f"SET VAR {ROLE} = {'NULL' if role is None else _quoted(role)}")


def policy_view(
    df: DataFrame,
    name: str,
    columns: Iterable[str] = PII_COLUMNS,
    allowed: Iterable[str] = UNMASKED_ROLES,
) -> str:
    """Publish ``df`` as the session's view ``name``, of which ``columns`` show to the allowed roles only.

    Others, and sessions without a role, see a fixed text, for NULLs too. The view is kept as SQL, so that each
    reading of it looks at the role anew; a DataFrame taken from it keeps the role it was made under.
    Masked columns are texts. Spark lets session variables into a session's own views only.
    """
    spark = df.sparkSession
    declare_role(spark)
    rows = f"{name}_rows"
    df.createOrReplaceTempView(_name(rows))
    masked, roles = set(columns), ", ".join(_quoted(r) for r in allowed)
    # No role at all is allowed where the list is empty.
    may = f"session.{ROLE} IN ({roles})" if roles else "false"
    shown = [
        f"CASE WHEN {may} THEN CAST({_name(c)} AS STRING) ELSE {_quoted(MASKED_TEXT)} END AS {_name(c)}" if c in masked else _name(c)
        for c in df.columns
    ]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {_name(name)} AS SELECT {', '.join(shown)} FROM {_name(rows)}")
    return name
