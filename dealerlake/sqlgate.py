"""Read-only gate for ad-hoc SQL text."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Statement words the gate refuses anywhere in the text.
WRITE_WORDS = ("insert", "update", "delete", "merge", "drop", "alter", "truncate", "create", "grant", "revoke")
# Ways a Spark SELECT could run code: functions, and the clause that pipes rows through a program.
CODE_FUNCTIONS = ("reflect", "try_reflect", "java_method")
SCRIPT = "ScriptTransformation"


def cleaned(sql: str | None) -> str:
    """The statement without a surrounding code fence and trailing semicolons."""
    text = (sql or "").strip()
    fenced = re.fullmatch(r"```[\w-]*\n?(.*?)(?:\n?```)?", text, flags=re.DOTALL)
    return (fenced.group(1) if fenced else text).strip().rstrip(";").rstrip()


def is_read_only(sql: str) -> bool:
    """True for a text that begins with SELECT and names none of the refused words."""
    text = sql.strip().lower()
    return text.startswith("select") and not set(re.findall(r"\w+", text)).intersection(WRITE_WORDS)


def parsed(spark: SparkSession, sql: str) -> list[dict]:
    """The nodes of the statement's plan as Spark parses it, outermost first; subqueries lie within their expressions."""
    return json.loads(spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toJSON())


def _within(part: Any) -> Iterator[dict]:
    """All nodes of a plan, those inside expressions included."""
    if isinstance(part, dict):
        if "class" in part:
            yield part
        part = list(part.values())
    if isinstance(part, list):
        for inner in part:
            yield from _within(inner)


def _kind(node: dict) -> str:
    return node["class"].rpartition(".")[2]


def runs_code(plan: list[dict]) -> bool:
    """Whether any node, at whatever depth, calls a function that runs code or pipes rows through a program."""
    for node in _within(plan):
        name = node.get("nameParts")
        # The names of a call; its last part is the function's own.
        called = re.split(r"[\s,.\[\]]+", name.strip("[] ")) if isinstance(name, str) else name or [""]
        if _kind(node) == SCRIPT or (_kind(node).endswith("Function") and str(called[-1]).lower() in CODE_FUNCTIONS):
            return True
    return False


def has_own_limit(plan: list[dict]) -> bool:
    """Whether the statement itself, not a subquery, a comment or a text in it, limits its rows."""
    return _kind(plan[0]) == "GlobalLimit"


def safe_sql(spark: SparkSession, sql: str, limit: int = 200, args: dict[str, Any] | None = None) -> DataFrame:
    """A read-only query, cut to ``limit`` rows unless it sets a limit of its own; anything else raises ValueError.

    Named binds go in ``args`` (``:name`` in the text). The words of the text are looked at first, then the plan Spark makes of it. Direct file paths
    in FROM are refused too.
    """
    text = cleaned(sql)
    if not is_read_only(text):
        raise ValueError("only SELECT statements are allowed")
    plan = parsed(spark, text)
    if runs_code(plan):
        raise ValueError("statements that run code are not allowed")
    name = "spark.sql.runSQLOnFiles"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        found = spark.sql(text, args=args)
        return found if has_own_limit(plan) else found.limit(limit)
    finally:
        spark.conf.set(name, before)
