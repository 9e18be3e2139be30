"""SQL guardrails as a Spark job over a table of SQL texts.

Input: a DataFrame with an id and a SQL text column (a query log). Every
rule is a column expression (regex functions, higher-order array
functions), so the audit is narrow: no UDF, no shuffle, any number of
statements. Each pass over the text is a named column that later steps use,
and a cheap test of the raw text decides whether a costly one is needed.

Rules run in order and the first failure is reported (fail closed):

1. ``keyword``    -- a blocked keyword appears anywhere as a whole word
                     (upper-cased text); the first one in list order is named.
2. ``not_select`` -- the text, leading whitespace removed, does not start
                     with SELECT or WITH (a prefix test).
3. ``no_table``   -- no table name follows FROM / JOIN.
   ``table``      -- a name after FROM / JOIN (last dotted part) is not in
                     the allowed list (case-sensitive); the first is named.

A passing statement gets ``LIMIT 100`` appended unless some ``LIMIT n``
is already present (trailing whitespace and ';' removed first), and its
allowed table names are then qualified with the project and dataset.
"""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelake.functions.columns import WHITESPACE
from carelake.schemas import ALLOWED_TABLES
from carelake.session import apply_conf

# Blocked statement keywords, checked in this order.
BLOCKED_KEYWORDS = ["DROP", "DELETE", "UPDATE", "INSERT", "ALTER",
                    "TRUNCATE", "MERGE", "CREATE", "GRANT", "REVOKE"]
DEFAULT_ROW_LIMIT = 100

# The patterns that define the rules. White space and digits are
# Unicode's: Spark's parser takes a no-break space for a blank, too.
WS = WHITESPACE
TABLE_REF = rf"(?i)(?:FROM|JOIN){WS}+`?([a-zA-Z0-9_.]+)`?"
HAS_LIMIT = rf"(?i)\bLIMIT{WS}+\p{{Nd}}+"
QUALIFY_HEAD = rf"((?i:FROM|JOIN)){WS}+`?("


def strip_text(c: Column) -> Column:
    """Without Unicode white space at both ends; most texts have none there."""
    return F.when(c.rlike(rf"\A{WS}|{WS}\z"), F.regexp_replace(c, rf"\A{WS}+|{WS}+\z", "")).otherwise(c)


def clean_fences(sql: Column) -> Column:
    """Drop a Markdown code fence around generated SQL: strip the text;
    if it starts with ```, strip backticks at both ends and a leading
    'sql' line, then strip again."""
    return unfenced(strip_text(sql))


def unfenced(t: Column) -> Column:
    """The second half of :func:`clean_fences`, on a stripped text."""
    unticked = F.regexp_replace(t, r"^`+|`+\z", "")
    untagged = F.when(unticked.startswith("sql\n"), F.substr(unticked, F.lit(5))).otherwise(unticked)
    return F.when(t.startswith("```"), strip_text(untagged)).otherwise(t)


def blocked_keyword(sql: Column) -> Column:
    """G1: the blocked keyword that comes first in the list among those
    present as whole words (upper-cased text), else NULL. One regex scan
    finds them all; the list position then picks the one to report."""
    keywords = F.array(*[F.lit(k) for k in BLOCKED_KEYWORDS])
    any_of = r"\b(" + "|".join(BLOCKED_KEYWORDS) + r")\b"
    found = F.regexp_extract_all(F.upper(sql), F.lit(any_of), 1)
    first = F.array_min(F.transform(found, lambda k: F.array_position(keywords, k)))
    return F.when(F.upper(sql).rlike(any_of), F.try_element_at(keywords, first.cast("int")))


def starts_with_select(sql: Column) -> Column:
    """Prefix test after removing leading whitespace."""
    return F.upper(sql).rlike(rf"\A{WS}*(?:SELECT|WITH)")


def referenced_tables(sql: Column) -> Column:
    """Names after FROM / JOIN, each cut to its last dotted part."""
    refs = F.regexp_extract_all(sql, F.lit(TABLE_REF), 1)
    return F.transform(refs, lambda r: F.try_element_at(F.split(r, r"\.", -1), F.lit(-1)))


def first_disallowed(tables: Column, allowed=ALLOWED_TABLES) -> Column:
    allowed_arr = F.array(*[F.lit(t) for t in allowed])
    return F.try_element_at(F.filter(tables, lambda t: ~F.array_contains(allowed_arr, t)), F.lit(1))


def enforce_row_limit(sql: Column, limit: int = DEFAULT_ROW_LIMIT) -> Column:
    """Append a LIMIT when none is present anywhere in the text."""
    trimmed = F.when(sql.rlike(rf"(?:{WS}|;)\z"), F.regexp_replace(F.regexp_replace(sql, rf"{WS}+\z", ""), r";+\z", "")).otherwise(sql)
    return F.when(sql.rlike(HAS_LIMIT), sql).otherwise(F.concat(trimmed, F.lit(f"\nLIMIT {limit}")))


def qualify_tables(sql: Column, project: str, dataset: str, allowed=ALLOWED_TABLES) -> Column:
    """Rewrite ``FROM t`` / ``JOIN t`` for allowed t to
    ``FROM `project.dataset.t```; anything else is left untouched."""
    for part in (project, dataset):
        if not re.fullmatch(r"[A-Za-z0-9_-]+", part):
            raise ValueError(f"bad project/dataset name: {part!r}")
    names = "|".join(re.escape(t) for t in allowed)
    pattern = rf"{QUALIFY_HEAD}{names})`?([^a-zA-Z0-9_]|\z)"
    return F.regexp_replace(sql, pattern, f"$1 `{project}.{dataset}.$2`$3")


def audit_sql(log: DataFrame, id_col: str = "query_id", sql_col: str = "sql_text",
              project: str = "analytics", dataset: str = "marts",
              limit: int = DEFAULT_ROW_LIMIT) -> DataFrame:
    """G1-G7 over a query log. Output: id, cleaned sql, verdict
    ('pass' / 'blocked'), rule, detail, safe_sql, qualified_sql."""
    keep = [F.col(id_col), "sql"]
    df = log.select(F.col(id_col), strip_text(F.col(sql_col)).alias("stripped")).select(F.col(id_col), unfenced(F.col("stripped")).alias("sql"))
    sql = F.col("sql")
    df = df.select(*keep, blocked_keyword(sql).alias("kw"), starts_with_select(sql).alias("selects"), referenced_tables(sql).alias("tables"))
    df = df.select(*keep, "kw", "selects", F.size("tables").alias("n_tables"), first_disallowed(F.col("tables")).alias("bad_table"))
    df = df.select(*keep, "kw", "bad_table", F.when(F.col("kw").isNotNull(), F.lit("keyword"))
                   .when(~F.col("selects"), F.lit("not_select"))
                   .when(F.col("n_tables") == 0, F.lit("no_table"))
                   .when(F.col("bad_table").isNotNull(), F.lit("table")).alias("rule"))
    passes = F.col("rule").isNull()
    df = df.select(*keep, "rule", F.when(F.col("rule") == "keyword", F.col("kw")).when(F.col("rule") == "table", F.col("bad_table")).alias("detail"),
                   F.when(passes, enforce_row_limit(sql, limit)).alias("safe_sql"))
    return df.select(*keep, F.when(passes, F.lit("pass")).otherwise(F.lit("blocked")).alias("verdict"), "rule", "detail", "safe_sql",
                     F.when(passes, qualify_tables(F.col("safe_sql"), project, dataset)).alias("qualified_sql"))


class GuardrailViolation(ValueError):
    """A statement failed the guardrails; it must not run (fail closed)."""


class QueryExecutionError(RuntimeError):
    """An accepted statement failed to run."""


# Expressions that run code of the JVM.
CODE_EXPRESSIONS = {"CallMethodViaReflection", "TryReflect"}


def _children(node) -> list:
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def plan_violation(plan, database: str | None = None, allowed=ALLOWED_TABLES) -> str | None:
    """What an analysed plan reads or runs besides the allowed names, or None: every
    leaf must be a table of ``database`` (without one: lie under a view) of an allowed
    name, subqueries included, and no expression may call code by reflection."""
    todo = [plan]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "View" and database is None and node.desc().identifier().table() in allowed:
            continue
        if kind == "LogicalRelation" and database is not None and node.catalogTable().isDefined():
            name = node.catalogTable().get().identifier()
            if name.table() in allowed and name.database().isDefined() and name.database().get() == database:
                continue
        expressions = [node.expressions().apply(i) for i in range(node.expressions().size())]
        while expressions:
            e = expressions.pop()
            if e.getClass().getSimpleName() in CODE_EXPRESSIONS:
                return f"expression {e.prettyName()}"
            expressions += _children(e)
        todo += [node.subqueries().apply(i) for i in range(node.subqueries().size())]
        below = _children(node)
        if not below and kind not in ("CTERelationRef", "OneRowRelation"):
            return f"{kind} {node.simpleString(5)[:80]}"
        todo += below
    return None


def run_query(spark, sql_text: str, limit: int = DEFAULT_ROW_LIMIT, database: str | None = None) -> DataFrame:
    """Check one statement with the same rules as the log audit (a
    one-row DataFrame), prepare it, and accept its analysed plan only if all it
    reads are the marts: the text rules alone let a comma join or a file
    path through.

    With ``database`` (a run's schema, or the published one) the names mean its
    tables: the statement is resolved in a session of its own whose current database it
    is, so views of the caller's session and other runs do not matter. Without
    one they are views of the session. Returns the lazy result; an accepted
    statement that Spark refuses raises QueryExecutionError."""
    log = spark.createDataFrame([(0, sql_text)], "query_id long, sql_text string")
    verdict = audit_sql(log, limit=limit).first()
    if verdict["verdict"] != "pass":
        raise GuardrailViolation(f"blocked ({verdict['rule']}: {verdict['detail']}): {sql_text[:80]}")
    session = spark
    if database is not None:
        session = apply_conf(spark.newSession())
        session.catalog.setCurrentDatabase(database)
    try:
        result = session.sql(verdict["safe_sql"])
    except PySparkException as exc:
        raise QueryExecutionError(f"statement failed: {exc}") from exc
    bad = plan_violation(result._jdf.queryExecution().analyzed(), database)
    if bad:
        raise GuardrailViolation(f"blocked (plan: {bad}): {sql_text[:80]}")
    return result
