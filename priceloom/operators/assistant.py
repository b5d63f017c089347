"""Questions to intents, and the guard that lets only reading SQL through."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.views import rounded

#: Keywords of each intent, in order of precedence.
KEYWORDS = {
    "price_analytics": ["price", "pricing", "cost", "cheapest", "expensive", "price change", "price increase", "price decrease", "price mover", "price trend", "average price", "price statistics", "price comparison"],
    "pipeline_status": ["pipeline", "pipeline status", "pipeline health", "consumer lag", "processing rate", "throughput", "last successful", "pipeline run", "job status", "etl status"],
    "data_quality": ["quality", "data quality", "validation", "check failed", "quality check", "quality result", "failed records", "invalid records", "duplicate rate", "null rate"],
    "source_health": ["source", "sources", "source health", "source status", "ingestion", "adapter", "source failed", "source degradation", "source freshness", "freshness", "observations drop", "stopped producing"],
    "product_history": ["history", "product history", "observations", "observation count", "product look", "past observations", "historical", "time series", "trend"],
}


def classify(question: Column) -> Column:
    """struct(intent, confidence): the intent with most keywords at word boundaries, the first of equals; general without any."""
    q = F.lower(question)
    scored = []
    for i, (intent, words) in enumerate(KEYWORDS.items()):
        n = reduce(lambda a, b: a + b, [F.when(q.rlike(rf"\b{w}\b"), 1).otherwise(0) for w in words])
        scored.append(F.struct(n.alias("n"), F.lit(-i).alias("rank"), F.lit(intent).alias("intent"), F.lit(max(len(words) * 0.3, 1.0)).alias("most")))
    best = F.array_max(F.array(*scored))
    hit = best["n"] > 0
    return F.struct(F.when(hit, best["intent"]).otherwise("general").alias("intent"), F.when(hit, rounded(F.least(best["n"] / best["most"], F.lit(1.0)))).otherwise(1.0).alias("confidence"))


def why_not_readonly(spark: SparkSession, sql: str) -> str | None:
    """None for a single query that only reads; else why it is refused.  Decided on Spark's own parse tree, so words inside literals or names do not matter
    and a write inside WITH is seen."""
    if not sql.strip().rstrip(";").strip():
        return "empty query"
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as e:  # noqa: BLE001  the JVM's parse error, or a second statement
        if isinstance(e, ParseException) or "Parse" in type(e).__name__ or "PARSE" in str(e):
            return "does not parse as one query"
        raise
    todo = [plan]
    while todo:
        node = todo.pop()
        for kind in ("Command", "ParsedStatement", "InsertIntoStatement"):
            if kind in [c.getSimpleName() for c in _kinds(node)]:
                return f"not a query: {node.nodeName()}"
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        inner = node.innerChildren()
        todo += [x for i in range(inner.size()) if hasattr(x := inner.apply(i), "nodeName")]
    return None


def _kinds(node) -> list:
    """Classes and interfaces of a JVM object."""
    out, todo = [], [node.getClass()]
    while todo:
        c = todo.pop()
        if c is None:
            continue
        out.append(c)
        todo += [c.getSuperclass(), *c.getInterfaces()]
    return out


def ask(spark: SparkSession, sql: str, limit: int = 100) -> DataFrame:
    why = why_not_readonly(spark, sql)
    if why:
        raise PermissionError(why)
    return spark.sql(sql).limit(limit)
