"""Compiler dumps in HLO text: ops with payload and topology, loop multipliers and the census of what a step runs.

Every job works on the lines of all dumps at once; a dump or a computation of any
length is spread over tasks. Comments (from ``//`` on) count for nothing but the metadata of an op.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stepfold.operators.common import global_last, written

# Layouts of the text, and ops that launch nothing.
HEADER = r"^\s*(ENTRY\s+)?%([^\s(]+)\s*\(.*?\)\s*->.*\{"
WHILE = r"while\([^)]*\).*condition=%([^\s,}]+),\s*body=%([^\s,}]+)"
TRUE_FALSE = r"true_computation=%([^\s,}]+),\s*false_computation=%([^\s,}]+)"
BRANCHES = r"branch_computations=\{([^}]+)\}"
TRIPS = r'"known_trip_count":\{"n":"(-?\d+)"'
CONSTANT = r"(%[^\s=]+)\s*=\s*.*constant.*literal=(-?\d+)"
COMPARE = r"compare\((%[^\s,]+),\s*(%[^\s)]+)\).*direction=[A-Z]+"
TENSOR = r"([A-Za-z0-9_]+\[[^\]]*\](?:\{[^}]*\})?)"
FREE_OPS = ("bitcast", "get-tuple-element", "tuple", "parameter", "constant", "partition-id")
PREFERRED_ENTRY = "main"


def _found(text: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, null if there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def own_lines(lines: DataFrame) -> DataFrame:
    """SRC11: (dump, comp, line_no, line, entry) of the lines (dump, line_no, line) inside a computation.

    A line belongs to the last computation header above it; where a name is defined
    again, the later lines hold. ``entry`` is the dump's first ENTRY computation
    whose name contains "main", else its first. A dump without one raises an error.
    """
    header = F.when(F.col("line").rlike(HEADER), F.struct(
        F.regexp_extract("line", HEADER, 2).alias("comp"), F.col("line_no").alias("at"),
        F.col("line").rlike(r"^\s*ENTRY\s").alias("is_entry")))
    headers = written(lines.select("dump", header.alias("h")).where("h is not null").select("dump", "h.*"))
    place = F.struct((~F.contains("comp", F.lit(PREFERRED_ENTRY))).alias("other"), F.col("at"))
    entries = headers.where("is_entry").groupBy("dump").agg(F.min_by("comp", place).alias("entry"))
    current = headers.groupBy("dump", "comp").agg(F.max("at").alias("at"))
    dumps = lines.select("dump").distinct().join(entries, "dump", "left")
    entry = F.coalesce("entry", F.raise_error(F.concat(F.lit("no ENTRY computation in "), F.col("dump"))).cast("string"))
    owned = global_last(lines, ["line_no"], ["dump"], header, "_owner").where(~F.col("line").rlike(HEADER))
    owned = owned.select("dump", F.col("_owner.comp").alias("comp"), F.col("_owner.at").alias("at"), "line_no", "line")
    # the join with the dumps comes first and keeps them all, so that a missing entry is seen
    owned = dumps.select("dump", entry.alias("entry")).join(owned, "dump", "left")
    return owned.join(current, ["dump", "comp", "at"]).where("entry is not null").select("dump", "comp", "line_no", "line", "entry")


# ------------------------------------------------------------------ fields of a line

def _code() -> Column:
    return F.substring_index("line", "//", 1)


def _right(code: Column) -> Column:
    """What follows the first ``=``."""
    return F.when(F.contains(code, F.lit("=")), F.trim(F.expr("substring(_code, instr(_code, '=') + 1)")))


def _op(right: Column) -> Column:
    """The op's name: behind a tuple type, else the word before the first parenthesis."""
    return F.coalesce(_found(right, r"\)\s*([A-Za-z0-9_.-]+)\s*\("), _found(right, r"^[^(]*?([^\s(]+)\s*\("))


def _call_target(line: Column) -> Column:
    """Library and routine of a custom call: ``__cublas$gemm.1`` is cublas:gemm, ``rocblas_gemm_ex`` is rocblas:gemm_ex."""
    named = F.regexp_replace(_found(line, r'call_target_name="([^"]+)"'), r"\.\d+$", "")
    library = (F.when(named.startswith("__"), F.replace(F.regexp_replace(named, "^_+", ""), F.lit("$"), F.lit(":")))
               .when(F.contains(F.lower(named), F.lit("rocblas")), F.regexp_replace(named, "^([^_]*)_", "$1:")).otherwise(named))
    plain = F.regexp_replace(_found(line, r'custom-call[^(]*\([^)]*\),\s*custom_call_target="([^"]+)"'), r"\.\d+$", "")
    return F.coalesce(library, plain)


def _fusion_kind(line: Column) -> Column:
    scheduled = F.regexp_replace(_found(line, r'scheduling_name="([^"]+)"'), r"\.\d+$", "")
    kind = _found(line, r'"kind":"([^"]+)"')
    kind = F.when(kind.startswith("k"), F.lower(F.regexp_replace(kind, "^k", ""))).otherwise(kind)
    return F.coalesce(scheduled, kind, F.lower(_found(line, "kind=k([A-Za-z]+)")))


def _subtype(op: Column, detail: Column) -> Column:
    return F.when(detail.isNotNull(), F.concat(op, F.lit(":"), detail)).otherwise(op)


def payload(right: Column, op: Column) -> Column:
    """PRJ18: the tensors of an op's result in order of first appearance, ``2xbf16[8], f32[4]``; null without any."""
    specs = F.regexp_extract_all(F.substring(right, F.lit(1), F.instr(right, op) - 1), F.lit(TENSOR), F.lit(1))
    counted = F.transform(F.array_distinct(specs), lambda s: F.struct(s.alias("s"), F.size(F.filter(specs, lambda x: x == s)).alias("n")))
    shown = F.transform(counted, lambda c: F.when(c["n"] > 1, F.concat(c["n"].cast("string"), F.lit("x"), c["s"])).otherwise(c["s"]))
    return F.when(F.size(specs) > 0, F.array_join(shown, ", "))


def topology(code: Column) -> Column:
    """PRJ19: source-target pairs as they are; replica groups written out as ``[groups,size]<=[replicas]``; their compressed form as it is.

    A list ends at its first ``}}``, so braces of later fields are no part of it."""
    pairs = _found(code, r"source_target_pairs=(\{\{.*?\}\})")
    inner = _found(code, r"replica_groups=\{\{(.*?)\}\}")
    groups = F.filter(F.split(inner, r"\},\{"), lambda g: F.trim(g) != "")
    size = F.size(F.filter(F.split(F.try_element_at(groups, F.lit(1)), ","), lambda x: F.trim(x) != ""))
    n = F.size(groups)
    listed = F.when((n > 0) & (size > 0), F.concat(F.lit("["), n.cast("string"), F.lit(","), size.cast("string"), F.lit("]<=["), (n * size).cast("string"), F.lit("]")))
    token = F.trim(_found(code, r"replica_groups=(.*?)(?:,\s*\w+=|$)"))
    packed = F.when(token.startswith("[") & ~F.contains(token, F.lit("{")), token)
    return F.coalesce(pairs, F.when(inner.isNotNull(), listed).otherwise(packed))


# ------------------------------------------------------------------ jobs

def parse(owned: DataFrame) -> DataFrame:
    """PRJ17-19: the lines of ``own_lines`` with ``op``, ``kind`` (communication, computation or
    null), ``result``, ``op_path``, ``source``, ``payload`` and ``topology``, and what control flow names:
    ``cond``, ``callees``, ``trips``, ``calls``, ``constant``, ``value`` and ``limit``. The text itself
    is searched once; the fields are written, as several jobs read them.

    Communication is what its result calls ``<op>-start``; completions are neither kind. Computation is
    any other op that isn't control flow, the root or free of cost.
    """
    line, code = F.col("line"), F.col("_code")
    df = owned.withColumn("_code", F.trim(_code()))
    df = df.withColumn("_right", _right(code)).withColumn("_op", _op(F.col("_right")))
    df = df.withColumn("result", _found(code, r"(%[^\s=]+)\s*="))
    loop, choice, call = (F.contains(code, F.lit(f" {w}(")) for w in ("while", "conditional", "call"))
    branches = F.transform(F.filter(F.split(_found(code, BRANCHES), ","), lambda b: F.trim(b) != ""), lambda b: F.regexp_replace(F.trim(b), "^%+", ""))
    callees = (F.when(loop & code.rlike(WHILE), F.array(F.regexp_extract(code, WHILE, 2)))
               .when(choice & code.rlike(TRUE_FALSE), F.array(F.regexp_extract(code, TRUE_FALSE, 1), F.regexp_extract(code, TRUE_FALSE, 2)))
               .when(choice & branches.isNotNull(), branches)
               .when(call & code.rlike(r"to_apply=%[^\s,}]+"), F.array(F.regexp_extract(code, r"to_apply=%+([^\s,}]+)", 1)))
               .when(call & code.rlike(r"calls=%[^\s,}]+"), F.array(F.regexp_extract(code, r"calls=%+([^\s,}]+)", 1))))
    df = df.withColumns({
        "callees": callees, "calls": _found(code, r"calls=%+([^\s,}]+)"),
        "cond": F.when(loop & code.rlike(WHILE), F.regexp_extract(code, WHILE, 1)),
        "trips": F.when(loop, _found(code, TRIPS)).cast("long")})
    done = F.col("_op").endswith("done")
    base = F.substring_index(F.regexp_replace("result", "^%+", ""), ".", 1)
    started = F.when(~F.coalesce(done, F.lit(False)) & base.endswith("-start"), base)
    counts = (F.col("_op").isNotNull() & ~loop & ~choice & ~done & ~code.startswith("ROOT") & ~F.col("_op").isin(*FREE_OPS))
    kind = F.when(F.col("callees").isNull(), F.when(started.isNotNull(), "communication").when(counts, "computation"))
    name, number = _found(line, r'source_file="([^"]+)"'), _found(line, r"source_line=(\d+)")
    source = F.when(name.isNotNull() | number.isNotNull(), F.concat(F.coalesce(name, F.lit("?")), F.lit(":"), F.coalesce(number, F.lit("?"))))
    detailed = (F.when(started.isNotNull(), started).when(F.col("_op") == "custom-call", _subtype(F.col("_op"), _call_target(line)))
                .when(F.col("_op") == "fusion", _subtype(F.col("_op"), _fusion_kind(line))).otherwise(F.col("_op")))
    df = df.withColumns({"kind": kind, "op": detailed, "op_path": _found(line, r'op_name="([^"]+)"'), "source": source,
                         "payload": payload(F.col("_right"), F.col("_op")), "topology": topology(code),
                         "constant": _found(code, CONSTANT), "value": _found(code, CONSTANT, 2).cast("long"), "limit": _found(code, COMPARE, 2)})
    return written(df.drop("line", "_code", "_right", "_op"))


def ops(parsed: DataFrame) -> DataFrame:
    """One row for each communication or computation op: (dump, comp, line_no, kind, op, result, payload, op_path, source)."""
    return parsed.where("kind is not null").select("dump", "comp", "line_no", "kind", "op", "result", "payload", "op_path", "source")


def communication_topology(parsed: DataFrame) -> DataFrame:
    """JN8: (dump, comp, line_no, op, result, topology) of communication; an op that has
    none of its own takes the first one in the computation that it calls."""
    first = (parsed.where("topology is not null").groupBy("dump", F.col("comp").alias("calls"))
             .agg(F.min_by("topology", "line_no").alias("_called")))
    started = parsed.where("kind = 'communication'").select("dump", "comp", "line_no", "op", "result", "topology", "calls")
    return (started.join(first, ["dump", "calls"], "left")
            .select("dump", "comp", "line_no", "op", "result", F.coalesce("topology", "_called").alias("topology")))


def loop_limits(parsed: DataFrame) -> DataFrame:
    """(dump, cond, limit): the constant that the first comparison of a condition has on its right, not below 0."""
    constants = (parsed.where("constant is not null").groupBy("dump", "comp", F.col("constant").alias("limit"))
                 .agg(F.max_by("value", "line_no").alias("value")))
    compares = parsed.where("limit is not null").groupBy("dump", "comp").agg(F.min_by("limit", "line_no").alias("limit"))
    return (compares.join(constants, ["dump", "comp", "limit"])
            .select("dump", F.col("comp").alias("cond"), F.greatest("value", F.lit(0)).alias("limit")))


def call_edges(parsed: DataFrame) -> DataFrame:
    """(dump, caller, callee, times): loops count as often as they turn (metadata, else the limit in
    their condition, else once), branches and calls once. Equal edges of a caller are added up."""
    calls = parsed.where("callees is not null").select("dump", F.col("comp").alias("caller"), "cond", "trips", F.explode("callees").alias("callee"))
    turns = F.when(F.col("cond").isNotNull(), F.coalesce("trips", "limit")).otherwise(1)
    return (calls.join(loop_limits(parsed), ["dump", "cond"], "left").groupBy("dump", "caller", "callee")
            .agg(F.sum(F.coalesce(turns, F.lit(1)).cast("long")).alias("times")))


def multipliers(parsed: DataFrame) -> DataFrame:
    """REC1: (dump, comp, times): how often a step runs each computation that its entry reaches.

    The call graphs of all dumps are walked together, a level a round. Paths that end in the same computation over
    the same others are one row, so their number stays small; a call back into the path is skipped.
    """
    edges = written(call_edges(parsed))
    level = parsed.groupBy("dump").agg(F.first("entry").alias("comp"))
    level = level.select("dump", "comp", F.array("comp").alias("above"), F.lit(1).cast("long").alias("times"))
    level, found = written(level), None
    while not level.isEmpty():
        found = level if found is None else found.unionAll(level)
        onward = level.withColumnRenamed("times", "_above").join(edges, (level["dump"] == edges["dump"]) & (F.col("comp") == F.col("caller")))
        onward = onward.where(~F.array_contains("above", F.col("callee"))).select(
            level["dump"], F.col("callee").alias("comp"), F.array_sort(F.array_append("above", F.col("callee"))).alias("above"),
            (F.col("_above") * F.col("times")).alias("times"))
        level = written(onward.groupBy("dump", "comp", "above").agg(F.sum("times").alias("times")))
    defined = parsed.select("dump", "comp").distinct()
    empty = parsed.select("dump", "comp", F.lit(0).cast("long").alias("times")).limit(0)
    reached = empty if found is None else found.select("dump", "comp", "times")
    return reached.join(defined, ["dump", "comp"], "left_semi").groupBy("dump", "comp").agg(F.sum("times").alias("times"))


def census(parsed: DataFrame, fusion_kinds: bool = False) -> DataFrame:
    """AGG25: (dump, kind, op, n, total, categories): how often a step runs each op, with the total and the number of
    ops of its kind. Fusions are one op unless ``fusion_kinds``."""
    op = F.col("op") if fusion_kinds else F.when(F.col("op").startswith("fusion:"), "fusion").otherwise(F.col("op"))
    counts = (ops(parsed).select("dump", "comp", "kind", op.alias("op")).groupBy("dump", "comp", "kind", "op").agg(F.count("*").alias("k"))
              .join(multipliers(parsed), ["dump", "comp"]).groupBy("dump", "kind", "op").agg(F.sum(F.col("k") * F.col("times")).alias("n")))
    totals = counts.groupBy("dump", "kind").agg(F.sum("n").alias("total"), F.count("*").alias("categories"))
    return counts.join(totals, ["dump", "kind"]).select("dump", "kind", "op", "n", "total", "categories")
