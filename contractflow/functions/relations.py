"""What a query or predicate is made of, from Spark's own parse of it: the nodes of the plan, never their printed text."""

from __future__ import annotations

from collections.abc import Collection, Iterator

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from ..errors import ContractError, require

# Parsed nodes that bypass declared inputs or are not offered in queries.
REFUSED = {
    "Pivot": "PIVOT",
    "UnresolvedPivot": "PIVOT",
    "Unpivot": "PIVOT",
    "RelationTimeTravel": "time travel",
    "UnresolvedTableValuedFunction": "table functions",
    "UnresolvedTVFAliases": "table functions",
    "PlanWithUnresolvedIdentifier": "dynamic identifiers",
    "ExpressionWithUnresolvedIdentifier": "dynamic identifiers",
    "ScriptTransformation": "script transforms",
}
#: What Spark calls the plans of statements that do more than read.
COMMANDS = "org.apache.spark.sql.catalyst.plans.logical.Command", "org.apache.spark.sql.catalyst.plans.logical.ParsedStatement"
PLAN = "org.apache.spark.sql.catalyst.plans.logical.LogicalPlan"
SUBQUERY = "org.apache.spark.sql.catalyst.expressions.PlanExpression"


def _each(sequence) -> Iterator:
    return (sequence.apply(i) for i in range(sequence.size()))


def nodes(spark: SparkSession, plan) -> Iterator:
    """All nodes of a parsed plan or expression: its CTEs, and the plans inside its expressions, included."""
    kind = spark._jvm.java.lang.Class.forName
    is_plan, is_subquery = kind(PLAN), kind(SUBQUERY)
    waiting = [plan]
    while waiting:
        node = waiting.pop()
        yield node
        waiting.extend(_each(node.children()))
        if is_plan.isInstance(node):
            # CTE definitions are inner children of their node; expressions are kept apart from plans.
            inner = node.innerChildren()
            waiting.extend(n for n in _each(inner) if is_plan.isInstance(n))
            waiting.extend(_each(node.expressions()))
        elif is_subquery.isInstance(node):
            waiting.append(node.plan())


def _parsed(spark: SparkSession, text: str, message: str, expression: bool = False):
    parser = spark._jsparkSession.sessionState().sqlParser()
    try:
        return parser.parseExpression(text) if expression else parser.parsePlan(text)
    except (PySparkException, Py4JJavaError):
        raise ContractError(message) from None


def require_one_statement(spark: SparkSession, text: str, rule: str) -> list[str]:
    """The words of a text as Spark's lexer cuts it, refused where it has comments or semicolons outside of quotes."""
    parser = spark._jvm.org.apache.spark.sql.catalyst.parser
    lexer = parser.SqlBaseLexer(spark._jvm.org.antlr.v4.runtime.CharStreams.fromString(text))
    lexer.removeErrorListeners()
    comments = {parser.SqlBaseLexer.SIMPLE_COMMENT, parser.SqlBaseLexer.BRACKETED_COMMENT}
    found = list(lexer.getAllTokens())
    fine = not any(t.getType() in comments or t.getText() == ";" for t in found)
    require(fine, f"{rule}: one statement is expected, without comments and semicolons")
    return [t.getText() for t in found if t.getText().strip()]


def require_query(spark: SparkSession, text: str, rule: str) -> None:
    """Refuse what is not one query that reads only: a SELECT, or a WITH before one, without any command in it."""
    words = require_one_statement(spark, text, rule)
    kind = spark._jvm.java.lang.Class.forName
    commands = [kind(c) for c in COMMANDS]
    plan = _parsed(spark, text, f"{rule}: Spark cannot read this as a query")
    reads = words[0].upper() in ("SELECT", "WITH") and not any(c.isInstance(n) for n in nodes(spark, plan) for c in commands)
    require(reads, f"{rule}: only a query is accepted, beginning with SELECT or WITH")


def require_predicate(spark: SparkSession, text: str, rule: str) -> None:
    """Refuse what is not one expression over the columns of a row, without a query in it."""
    require_one_statement(spark, text, rule)
    kind = spark._jvm.java.lang.Class.forName(SUBQUERY)
    found = _parsed(spark, text, f"{rule}: Spark cannot read this as a predicate", expression=True)
    require(not any(kind.isInstance(n) for n in nodes(spark, found)), f"{rule}: a predicate judges one row, without subqueries")


def require_declared(spark: SparkSession, query: str, inputs: Collection[str]) -> None:
    """Refuse a query that reads anything but the inputs and its own CTEs.

    A CTE may be named neither like an input nor like a table that the session knows, so a reference
    to it can mean nothing else, wherever it stands.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    declared, ctes, read = {name.lower() for name in inputs}, set(), set()
    for node in nodes(spark, plan):
        kind = node.getClass().getSimpleName()
        require(kind not in REFUSED, f"Queries do not support {REFUSED.get(kind)}")
        if kind == "UnresolvedWith":
            ctes.update(pair._1().lower() for pair in _each(node.cteRelations()))
        elif kind == "UnresolvedRelation":
            read.add(".".join(_each(node.multipartIdentifier())).lower())
    require(not ctes & declared, "A CTE may not be named like an input")
    for name in sorted(read - declared):
        own = name in ctes and not spark.catalog.tableExists(f"`{name}`")
        require(own, f"{name} is not a declared input")
