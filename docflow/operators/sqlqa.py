"""Questions to SQL to answers, as a job over a table of questions."""

from __future__ import annotations

import json
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words of statements that change something.
FORBIDDEN = ("alter", "create", "delete", "drop", "insert", "merge", "truncate", "update")

STEPS = "array<struct<action:string,observation:string>>"

_READ_ONLY = r"(?is)^\s*(select|with)\b[^;]*;?\s*$"
_CHANGES = rf"(?is)\b({'|'.join(FORBIDDEN)})\b"
# Functions that run code by name, and formats whose files can be named as tables.
_RUNS_CODE = r"(?is)\b(java_method|reflect|try_reflect)\s*\("
_READS_FILES = r"(?is)\b(avro|binaryfile|csv|delta|json|orc|parquet|text|xml)\s*\.\s*x\s"
#: What is no code: quoted text and names, and comments. The first to begin counts, as a reader of SQL would see it.
_NO_CODE = r"(?s)'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/"


def guard(sql: Column) -> Column:
    """Null for what looks like one statement that only reads, else why it is refused.

    A sieve for columns of statements: quoted text, quoted names and comments are not looked at, and one that does
    not end refuses the statement. What is run is decided by :func:`refusal`, on the parsed plan.
    """
    bare = F.regexp_replace(sql, _NO_CODE, " x ")
    open_end = bare.rlike("['\"`]|/[*]")
    return F.when(~F.coalesce(F.trim(F.regexp_replace(bare, r"(?s)^(\s*x\s)+", "")).rlike(_READ_ONLY) & ~open_end, F.lit(False)), "not one read-only statement").when(
        bare.rlike(_CHANGES), "changes data"
    ).when(bare.rlike(_RUNS_CODE), "runs code").when(bare.rlike(_READS_FILES), "reads files")


#: Nodes that a read of tables is made of; a statement with any other is refused.
NODES = frozenset(
    "Project Filter Aggregate Join LateralJoin Generate Sort GlobalLimit LocalLimit Offset Distinct Union Intersect Except SubqueryAlias "
    "UnresolvedRelation UnresolvedWith UnresolvedHaving UnresolvedInlineTable UnresolvedSubqueryColumnAliases UnresolvedTableValuedFunction "
    "UnresolvedTVFAliases WithWindowDefinition LocalRelation OneRowRelation Pivot Unpivot Sample".split()
)
#: Kinds of built-in functions that work on values alone. Others run code by name, read files or tell about the session.
GROUPS = frozenset(
    "agg_funcs array_funcs bitwise_funcs collection_funcs conditional_funcs conversion_funcs csv_funcs date_funcs generator_funcs hash_funcs "
    "json_funcs lambda_funcs map_funcs math_funcs predicate_funcs string_funcs struct_funcs url_funcs window_funcs".split()
)
#: Functions that make rows of their arguments.
TABLE_FUNCTIONS = frozenset("explode explode_outer posexplode posexplode_outer inline inline_outer stack json_tuple range".split())


def _each(seq):
    return (seq.apply(i) for i in range(seq.size()))


def _name(node) -> str:
    return node.getClass().getName().rpartition(".")[2]


class _Walk:
    """What a parsed statement touches: its relations and functions, in its plan, its expressions and the plans within those."""

    def __init__(self, spark: SparkSession, tables: frozenset[str] | None, functions: frozenset[str]):
        self.spark, self.functions = spark, functions
        self.tables = None if tables is None else {t.lower() for t in tables}
        self.registry = spark._jsparkSession.sessionState().functionRegistry()
        self.expression = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.Expression")
        logical = "org.apache.spark.sql.catalyst.plans.logical."
        self.plan, *self.writes = [spark._jvm.java.lang.Class.forName(logical + c) for c in ("LogicalPlan", "Command", "ParsedStatement")]

    def refusal(self, plan) -> str | None:
        plans, expressions, named = [(plan, frozenset())], [], frozenset()
        while plans or expressions:
            if plans:
                node, named = plans.pop()
                why, inside = self._node(node, named)
                if why:
                    return why
                for nodes in (node.children(), node.innerChildren()):
                    plans += [(x, inside) for x in _each(nodes) if self.plan.isInstance(x)]
                expressions += [(x, inside) for x in _each(node.expressions())]
                if _name(node) == "UnresolvedWith":
                    plans += [(pair._2(), inside) for pair in _each(node.cteRelations())]
                continue
            node, named = expressions.pop()
            kind = _name(node)
            if kind in ("UnresolvedFunction", "UnresolvedGenerator"):
                parts = list(_each(node.nameParts())) if kind == "UnresolvedFunction" else [node.name().funcName()]
                if why := self._function(parts):
                    return why
            if kind == "UnresolvedTableValuedFunction" or "CallFunction" in kind:
                return f"calls {kind}"
            expressions += [(x, named) for x in _each(node.children()) if self.expression.isInstance(x)]
            if hasattr(node, "plan") and kind in ("ScalarSubquery", "Exists", "ListQuery", "LateralSubquery", "ArraySubquery"):
                plans.append((node.plan(), named))
            expressions += [(x, named) for x in _each(node.innerChildren()) if self.expression.isInstance(x)]
        return None

    def _node(self, node, named: frozenset[str]) -> tuple[str | None, frozenset[str]]:
        kind = _name(node)
        if kind not in NODES:
            return "changes data" if any(c.isInstance(node) for c in self.writes) else f"is no plain read: {kind}", named
        if kind == "UnresolvedWith":
            return None, named | {pair._1().lower() for pair in _each(node.cteRelations())}
        if kind == "UnresolvedTableValuedFunction":
            parts = list(_each(node.name()))
            return (None if len(parts) == 1 and parts[0].lower() in TABLE_FUNCTIONS else f"reads {'.'.join(parts)}"), named
        if kind == "UnresolvedRelation":
            parts = list(_each(node.multipartIdentifier()))
            if len(parts) == 1 and (parts[0].lower() in named or self._known(parts[0])):
                return None, named
            return f"reads {'.'.join(parts)}", named
        return None, named

    def _known(self, table: str) -> bool:
        if self.tables is not None:
            return table.lower() in self.tables
        return self.spark._jsparkSession.sessionState().catalog().getTempView(table).isDefined()

    def _function(self, parts: list[str]) -> str | None:
        name = parts[-1].lower()
        if len(parts) == 1 and name in self.functions:
            return None
        if len(parts) == 1:
            found = self.registry.lookupFunction(self.spark._jvm.org.apache.spark.sql.catalyst.FunctionIdentifier(name))
            if found.isDefined() and found.get().getGroup() in GROUPS and found.get().getSource() == "built-in":
                return None
        return f"calls {'.'.join(parts)}"


def refusal(spark: SparkSession, sql: str, tables: frozenset[str] | None = None, functions: frozenset[str] = frozenset()) -> str | None:
    """Why a statement may not run, or null.

    It must parse as one query, made of the nodes of a plain read (``NODES``) all through, over ``tables`` (by default the session's
    temporary views) and its own common tables, and call only built-in functions of the ``GROUPS`` that work on values, or those in ``functions``.
    So files read as tables, functions that run code by name, scripts and writes are refused wherever they stand.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as error:
        return f"does not parse: {(str(error).splitlines() or [''])[0]}"
    return _Walk(spark, tables, functions).refusal(plan)


def table_context(df: DataFrame, name: str, distinct: bool = True) -> DataFrame:
    """One row per column of a table: type, rows, nulls, least and greatest value, and about how many values.

    One pass and one aggregate for the whole table.
    """
    simple = ("string", "int", "bigint")
    aggs, parts = [F.count("*").alias("_n")], []
    for i, (column, kind) in enumerate(df.dtypes):
        c = F.col(f"`{column}`")
        aggs.append(F.count_if(c.isNull()).alias(f"_z{i}"))
        if distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"_d{i}"))
        if kind in simple:
            aggs += [F.min(c).cast("string").alias(f"_a{i}"), F.max(c).cast("string").alias(f"_b{i}")]
        none = F.lit(None).cast("string")
        parts.append(
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(kind).alias("column_type"),
                F.col("_n").alias("n_rows"),
                F.col(f"_z{i}").alias("n_nulls"),
                (F.col(f"_a{i}") if kind in simple else none).alias("least"),
                (F.col(f"_b{i}") if kind in simple else none).alias("greatest"),
                *([F.col(f"_d{i}").alias("n_distinct")] if distinct else []),
            )
        )
    return df.agg(*aggs).select(F.explode(F.array(*parts)).alias("_c")).select("_c.*")


def answer_questions(
    spark: SparkSession, questions: DataFrame, to_sql: Callable[[str, str], str], output: str, context: str = "", concurrency: int = 4
) -> tuple[DataFrame, DataFrame]:
    """Answer the rows of ``questions`` (``question``) by guarded SQL over the session's tables.

    Returns what was done for each question (``question, sql, n_rows, steps, error``) and the answers (``question, position,
    row_json``). Statements of the same meaning run once, by the canonical form of their analysed plans. Questions come to the driver one after the other, as their statements must be planned there; each
    answer is written below ``output`` by a Spark job of its own, all its rows, in its order. Whatever
    fails is kept in ``error`` beside the question.
    """
    lock, known, run = Lock(), {}, []

    def answer(numbered: tuple[int, str]) -> tuple:
        number, question = numbered
        steps: list[tuple[str, str]] = []
        sql = None
        try:
            sql = to_sql(question, context)
            steps.append(("write_sql", sql))
            refused = refusal(spark, sql)
            steps.append(("check", refused or "read-only"))
            if refused:
                return question, sql, None, steps, refused
            result = spark.sql(sql.rstrip().rstrip(";"))
            with lock:
                alike = known.setdefault(result.semanticHash(), [])
                first = next((x for x in alike if x[0].sameSemantics(result) and x[0].columns == result.columns), None)
                if first is None:
                    first = (result, number, Future())
                    alike.append(first)
            path = f"{output}/statement={first[1]}"
            if first[1] == number:
                try:
                    rows = result.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row_json"))
                    rows.select(F.monotonically_increasing_id().alias("position"), "row_json").write.mode("overwrite").parquet(path)
                    first[2].set_result(spark.read.parquet(path).count())
                except Exception as error:
                    first[2].set_exception(error)
            n = first[2].result()
            steps.append(("run", f"{n} rows"))
            run.append((question, first[1]))
            return question, sql, n, steps, None
        except Exception as error:
            text = (str(error).splitlines() or [type(error).__name__])[0]
            steps.append(("error", text))
            return question, sql, None, steps, f"{type(error).__name__}: {text}"

    asked = ((i, r["question"]) for i, r in enumerate(questions.select("question").toLocalIterator()))
    with ThreadPoolExecutor(concurrency) as pool:
        done = spark.createDataFrame(list(pool.map(answer, asked)), f"question string, sql string, n_rows bigint, steps {STEPS}, error string")
    asked_of = spark.createDataFrame(run, "question string, statement int")  # a row a question, as in ``done``
    shape = "position bigint, row_json string, statement int"
    paths = [f"{output}/statement={n}" for n in sorted({n for _, n in run})]
    stored = spark.read.schema(shape).option("basePath", output).parquet(*paths) if paths else spark.createDataFrame([], shape)
    return done, stored.join(asked_of, "statement").select("question", "position", "row_json")


def samples(df: DataFrame, name: str, n: int = 3) -> DataFrame:
    """A few rows of a table as JSON text, for a prompt."""
    return df.limit(n).select(F.lit(name).alias("table_name"), F.to_json(F.struct("*")).alias("row_json"))


def context_text(context: DataFrame, *rows: DataFrame) -> str:
    """Schema context, and sample rows if given, as text for a prompt; one line per column or row."""
    return "\n".join(json.dumps(r.asDict()) for part in (context, *rows) for r in part.collect())
