"""Citation audit (Q19): every number in an output is a copy of a cited one, recomputes from cited ones, or is told."""

from __future__ import annotations

import ast
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weavegraph.functions.text import numbers_equal
from weavegraph.operators.walk import leaves
from weavegraph.sources.shared import stored

#: A cited number in a formula: {source#path}.
CITED = re.compile(r"\{([^{}#]*)#([^{}]*)\}")
OPERATORS = {ast.Add: "+", ast.Sub: "-", ast.Mult: "*", ast.Div: "/"}
EXPRESSION = "artifact string, path string, node int, parent int, side int, level int, op string, number double, source string, source_path string"


#: Shapes of formulas whose trees a worker keeps.
SHAPES = 4096


@functools.lru_cache(maxsize=SHAPES)
def _shape(text: str, n_cited: int) -> list[tuple] | None:
    """A formula with cited__0, cited__1, .. for its n_cited citations as rows: node, parent, side, level, op, number, and
    which citation. None for what isn't arithmetic. Formulas of one shape are parsed once."""
    try:
        tree, out = ast.parse(text, mode="eval").body, []
        waiting = [(tree, None, 0, 0)]
        while waiting:
            at, parent, side, level = waiting.pop()
            me = len(out)
            if isinstance(at, ast.BinOp) and type(at.op) in OPERATORS:
                out.append((me, parent, side, level, OPERATORS[type(at.op)], None, None))
                waiting += [(at.left, me, 0, level + 1), (at.right, me, 1, level + 1)]
            elif isinstance(at, ast.UnaryOp) and isinstance(at.op, ast.USub):
                out.append((me, parent, side, level, "neg", None, None))
                waiting.append((at.operand, me, 0, level + 1))
            elif isinstance(at, ast.Constant) and type(at.value) in (int, float):
                out.append((me, parent, side, level, "number", float(at.value), None))
            elif isinstance(at, ast.Name) and re.fullmatch(r"cited__\d+", at.id) and int(at.id[7:]) < n_cited:
                out.append((me, parent, side, level, "cited", None, int(at.id[7:])))
            else:
                return None
    except (SyntaxError, ValueError, RecursionError, MemoryError, OverflowError):
        return None
    return out


def _nodes(formula: str) -> list[tuple]:
    """A formula as rows: node, parent, side, level, op, number, source, source_path. ValueError for what isn't arithmetic."""
    cited: list[tuple[str, str]] = []

    def named(m: re.Match) -> str:
        cited.append((m.group(1), m.group(2)))
        return f"cited__{len(cited) - 1}"

    shape = _shape(CITED.sub(named, formula).strip(), len(cited))
    if shape is None:
        raise ValueError(formula)
    return [(*row, *(cited[i] if i is not None else (None, None))) for *row, i in shape]


def expressions(formulas: DataFrame) -> DataFrame:
    """Formulas (artifact, path, formula) as an expression table, a row per operator, number and citation. One that isn't
    arithmetic over +, -, *, / and cited numbers is the one row of op bad."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for artifact, path, formula in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                try:
                    made = _nodes(formula or "")
                except ValueError:
                    made = [(0, None, 0, 0, "bad", None, None, None)]
                rows += [(artifact, path, *r) for r in made]
            names = [c.split()[0] for c in EXPRESSION.split(", ")]
            kinds = [{"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[c.split()[1]] for c in EXPRESSION.split(", ")]
            values = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    return formulas.select("artifact", "path", "formula").mapInArrow(run, EXPRESSION)


def evaluate(nodes: DataFrame, values: DataFrame) -> DataFrame:
    """artifact, path and result of every formula. values: source, path, value (double). Nodes are settled level by level,
    the deepest first; a node takes its operands by one grouping. A missing number, a division by zero or a bad formula
    has a null result."""
    # Nodes that cite nothing, most of them, would all be one task's by their null key.
    uncited = lambda otherwise: F.when(F.col("source").isNull(), otherwise).otherwise(F.lit(0).cast("bigint")).alias("dealt__")
    known = values.select("source", F.col("path").alias("source_path"), "value", uncited(F.lit(-1).cast("bigint")))
    dealt = nodes.select("*", uncited(F.pmod(F.xxhash64("artifact", "path", "node"), F.lit(1 << 20))))
    n = stored(dealt.join(known, ["source", "source_path", "dealt__"], "left").drop("dealt__").withColumn("value", F.coalesce("number", "value")), "expressions")
    deepest = n.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]
    here = ["artifact", "path"]
    settled = n.filter(F.col("level") == deepest).select(*here, "node", "parent", "side", "value")
    for level in range(deepest - 1, -1, -1):
        side = lambda i: F.max(F.when(F.col("side") == i, F.col("value")))
        operands = settled.groupBy(*here, F.col("parent").alias("node")).agg(side(0).alias("a"), side(1).alias("b"))
        a, b, op = F.col("a"), F.col("b"), F.col("op")
        value = F.when(op == "+", a + b).when(op == "-", a - b).when(op == "*", a * b).when(op == "/", F.try_divide(a, b)).when(op == "neg", -a).otherwise(F.col("value"))
        settled = n.filter(F.col("level") == level).join(operands, [*here, "node"], "left").select(*here, "node", "parent", "side", value.alias("value"))
        if level % 8 == 0 and level:
            settled = stored(settled, "settled")
    return settled.select(*here, F.col("value").alias("result"))


def numbers(documents: DataFrame, name: str, payload: str, nulls: bool = False) -> DataFrame:
    """The numeric leaves of JSON documents: name, path, value; with nulls, also null leaves, of null value."""
    kinds = ["BIGINT", "DOUBLE", *(["VOID"] if nulls else [])]
    return leaves(documents, payload, [name]).filter(F.col("kind").isin(*kinds)).select(name, "path", F.col("text").cast("double").alias("value"))


def audit(outputs: DataFrame, sources: DataFrame, copies: DataFrame, formulas: DataFrame, labelled: DataFrame) -> DataFrame:
    """Q19: artifact, path, value, expected and verdict of every number in the outputs (artifact, payload).

    Numbers are what a walk finds in the payloads, so none goes unseen. formulas (artifact, path, formula) come first: the
    verdict is recomputed, differs, or unreadable where the cited numbers don't give one; then copies (artifact, path,
    source, source_path) of numbers in the sources (source, payload): ok, differs or unreadable; then labelled blocks
    (artifact, prefix of the path): code; a null is null; what is left is uncited.
    """
    given = numbers(outputs, "artifact", "payload", nulls=True).dropDuplicates(["artifact", "path"])
    there = stored(numbers(sources, "source", "payload").dropDuplicates(["source", "path"]), "numbers")
    made = evaluate(expressions(formulas), there).withColumn("derived__", F.lit(True))
    cited = copies.join(there.select("source", F.col("path").alias("source_path"), F.col("value").alias("copied__")), ["source", "source_path"], "left")
    cited = cited.groupBy("artifact", "path").agg(F.min("copied__").alias("copied__")).withColumn("cited__", F.lit(True))
    prefixes = labelled.groupBy("artifact").agg(F.collect_set("prefix").alias("prefixes__"))  # an artifact's few blocks
    j = given.join(made, ["artifact", "path"], "left").join(cited, ["artifact", "path"], "left").join(prefixes, "artifact", "left")
    held = lambda expected, fine: F.when(F.col(expected).isNull(), "unreadable").when(numbers_equal("value", expected), fine).otherwise("differs")
    code = F.coalesce(F.exists("prefixes__", lambda p: F.startswith(F.col("path"), p)), F.lit(False))
    verdict: Column = F.when(F.col("value").isNull(), "null").when(F.col("derived__"), held("result", "recomputed")).when(F.col("cited__"), held("copied__", "ok")).when(code, "code").otherwise("uncited")
    return j.select("artifact", "path", "value", F.when(F.col("derived__"), F.col("result")).otherwise(F.col("copied__")).alias("expected"), verdict.alias("verdict"))
