"""Read-only SQL over registered views, and a safe builder of filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPS = ("contains", "=", ">", "<", ">=", "<=", "is empty")


def register(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


#: Functions that run code or look at the session; a query that calls one is refused.
REFUSED = frozenset("reflect java_method try_reflect call_function input_file_name input_file_block_start input_file_block_length current_user user session_user version".split())
_CHANGES = ("Insert", "Create", "Drop", "Delete", "Update", "Merge", "Replace", "Alter", "Set", "Truncate", "Refresh", "Cache", "Uncache", "Script", "Load", "Add", "Clear", "Describe", "Show")


def _parts(spark: SparkSession, plan) -> tuple[list[str], list[list[str]], list[str]]:
    """Kinds of all nodes of a parsed query, parts of its relations' names, and names of its functions; subqueries included."""
    of = lambda name: spark._jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.{name}")
    is_plan, is_subquery = of("plans.QueryPlan"), of("expressions.PlanExpression")
    listed = lambda seq: [seq.apply(i) for i in range(seq.size())]
    kinds, names, calls, todo = [], [], [], [plan]
    while todo:
        x = todo.pop()
        kind = x.getClass().getName().rpartition(".")[2]
        kinds.append(kind if ".command." not in x.getClass().getName() else f"{kind}Command")
        if kind == "UnresolvedRelation":
            names.append(listed(x.multipartIdentifier()))
        elif kind == "UnresolvedFunction":
            calls.append(listed(x.nameParts())[-1].lower())
        elif kind == "UnresolvedTableValuedFunction":
            calls.append(listed(x.name())[-1].lower())
        todo += listed(x.children()) + listed(x.innerChildren())
        if is_plan.isInstance(x):
            todo += listed(x.expressions())
        if is_subquery.isInstance(x):
            todo.append(x.plan())
    return kinds, names, calls


def read_only(spark: SparkSession, text: str, **args) -> DataFrame:
    """Run a query over registered tables; it is parsed, and refused before it runs if it changes anything, calls a function that runs code, or names files instead of tables."""
    kinds, names, calls = _parts(spark, spark._jsparkSession.sessionState().sqlParser().parsePlan(text))
    if any(k.endswith("Command") or k.startswith(_CHANGES) for k in kinds):
        raise PermissionError("only queries are allowed")
    if bad := sorted(REFUSED.intersection(calls)):
        raise PermissionError(f"not allowed in a query: {', '.join(bad)}")
    if files := [".".join(n) for n in names if "/" in n[-1] or len(n) > 1 and n[0].lower() in FORMATS]:
        raise PermissionError(f"only registered tables are read, not {', '.join(files)}")
    return spark.sql(text, args=args or None)


FORMATS = frozenset("parquet csv json orc text avro binaryfile delta xml paged_json".split())


def condition(column: str, op: str, value=None) -> Column:
    if op not in OPS:
        raise ValueError(f"no such operation: {op}")
    c = F.col(f"`{column}`")
    if op == "contains":
        return F.contains(F.lower(c.cast("string")), F.lit(str(value).lower()))
    if op == "is empty":
        return c.isNull() | (c.cast("string") == "")
    return {"=": c == value, ">": c > value, "<": c < value, ">=": c >= value, "<=": c <= value}[op]


def filtered(df: DataFrame, conditions: list[tuple], limit: int = 200) -> DataFrame:
    for column, op, *value in conditions:
        df = df.where(condition(column, op, *value))
    return df.limit(limit)
