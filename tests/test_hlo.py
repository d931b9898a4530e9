"""HLO dumps: the documented counts of a two-loop dump, control flow against a plain walk, odd lines, files in blocks."""

import collections
import random

import pytest

from stepfold.operators import hlo
from stepfold.sources.files import read_hlo_dumps

# Two nested loops of 10 and 5 turns: 10 all-gathers, 50 reduce-scatters, 10 + 50 all-reduces and 10 adds.
TWO_LOOPS = """HloModule module

ENTRY %main.1 (x: f32[1024]) -> f32[1024] {
  %x = f32[1024] parameter(0)

  %while.1 = while(%x), condition=%outer.condition, body=%outer.body
  ROOT %y = f32[1024] get-tuple-element(%while.1), index=0
}

%outer.condition (s: (s32[], f32[1024])) -> pred[] {
  %s = (s32[], f32[1024]) parameter(0)
  %i = s32[] get-tuple-element(%s), index=0
  %limit = s32[] constant(), literal=10
  ROOT %lt = pred[] compare(%i, %limit), direction=LT
}

%outer.body (s: (s32[], f32[1024])) -> (s32[], f32[1024]) {
  %all-gather-start.1 = (f32[1024], f32[8192]) all-gather-start(f32[1024] %d), replica_groups={{0,1,2,3,4,5,6,7}}, metadata={op_name="gather" source_file="/m.py" source_line=42}
  %all-gather-done.1 = f32[8192] all-gather-done(%all-gather-start.1)
  %while.2 = while(%all-gather-done.1), condition=%inner.condition, body=%inner.body
  %all-reduce-start.1 = f32[8192] all-reduce-start(%while.2), replica_groups={{0,1,2,3},{4,5,6,7}}, to_apply=add
  %i_new = s32[] add(%i, s32[] constant(1))
  ROOT %tuple = (s32[], f32[1024]) tuple(%i_new, %d)
}

%inner.condition (p: f32[8192]) -> pred[] {
  %counter = s32[] constant(), literal=0
  %limit = s32[] constant(), literal=5
  ROOT %lt = pred[] compare(%counter, %limit), direction=LT
}

%inner.body (p: f32[8192]) -> f32[8192] {
  %reduce-scatter-start.1 = (f32[8192], f32[1024]) reduce-scatter-start(f32[8192] %d), replica_groups={{0,1,2,3,4,5,6,7}}
  %all-reduce-start.2 = f32[1024] all-reduce-start(%d), replica_groups={{0,1,2,3,4,5,6,7}}
  ROOT %r = f32[8192] broadcast(%all-reduce-start.2), dimensions={0}
}
"""


def parsed(spark, **dumps):
    rows = [(d, i, line) for d, text in dumps.items() for i, line in enumerate(text.splitlines())]
    return hlo.parse(hlo.own_lines(spark.createDataFrame(rows, "dump string, line_no long, line string")))


def times(df):
    return {(r["dump"], r["comp"]): r["times"] for r in hlo.multipliers(df).collect()}


def test_census_of_two_loops(spark):
    found = {(r["kind"], r["op"]): (r["n"], r["total"], r["categories"]) for r in hlo.census(parsed(spark, a=TWO_LOOPS)).collect()}
    assert found == {("communication", "all-gather-start"): (10, 120, 3), ("communication", "all-reduce-start"): (60, 120, 3),
                     ("communication", "reduce-scatter-start"): (50, 120, 3), ("computation", "add"): (10, 10, 1)}


def test_fields_of_two_loops(spark):
    df = parsed(spark, a=TWO_LOOPS)
    first = hlo.ops(df).orderBy("line_no").first()
    assert (first["op"], first["result"], first["payload"], first["op_path"], first["source"]) == (
        "all-gather-start", "%all-gather-start.1", "f32[1024], f32[8192]", "gather", "/m.py:42")
    assert {r["result"]: r["topology"] for r in hlo.communication_topology(df).collect()} == {
        "%all-gather-start.1": "[1,8]<=[8]", "%all-reduce-start.1": "[2,4]<=[8]", "%reduce-scatter-start.1": "[1,8]<=[8]", "%all-reduce-start.2": "[1,8]<=[8]"}


def random_dump(rng):
    """Computations that loop over, branch to and call each other at random, cycles, unknown names and unknown trips included;
    returns text and how often each runs by a plain walk."""
    names = [f"c{i}" for i in range(rng.randint(2, 9))]
    edges, lines = collections.defaultdict(list), []
    for n in ["main.0", *names]:
        lines.append(f"{'ENTRY ' if n == 'main.0' else ''}%{n} (a: f32[]) -> f32[] {{")
        for j in range(rng.randint(0, 3)):
            a, b = rng.choice([*names, "gone"]), rng.choice([*names, "gone"])
            how = rng.randrange(7)
            if how == 0:
                t = rng.randint(0, 4)
                lines.append(f'  %w.{j} = f32[] while(%a), condition=%none, body=%{a}, backend_config={{"known_trip_count":{{"n":"{t}"}}}}')
                edges[n].append((a, t))
            elif how == 1:
                lines.append(f"  %w.{j} = f32[] while(%a), condition=%limit3, body=%{a}")
                edges[n].append((a, 3))
            elif how == 2:
                lines.append(f"  %w.{j} = f32[] while(%a), condition=%odd, body=%{a}")
                edges[n].append((a, 1))
            elif how == 3:
                lines.append(f"  %w.{j} = f32[] conditional(%a), true_computation=%{a}, false_computation=%{b}")
                edges[n] += [(a, 1), (b, 1)]
            elif how == 4:
                lines.append(f"  %w.{j} = f32[] conditional(%a), branch_computations={{%{a}, %{b}}}")
                edges[n] += [(a, 1), (b, 1)]
            else:
                lines.append(f"  %w.{j} = f32[] call(%a), {'to_apply' if how == 5 else 'calls'}=%{a}")
                edges[n].append((a, 1))
        lines += ["  %x = f32[] exp(%a)", "}"]
    lines += ["%limit3 (a: f32[]) -> pred[] {", "  %k = s32[] constant(), literal=7", "  %k = s32[] constant(), literal=3",
              "  ROOT %c = pred[] compare(%i, %k), direction=LT", "}",
              "%odd (a: f32[]) -> pred[] {", "  %k = s32[] constant(), literal=9", "  %c = pred[] compare(%k, %i), direction=GT",
              "  ROOT %d = pred[] compare(%i, %k), direction=LT", "}"]
    runs = collections.Counter()

    def walk(n, mult, stack):
        if n in stack or n == "gone":
            return
        runs[n] += mult
        for callee, t in edges[n]:
            walk(callee, mult * t, stack | {n})

    walk("main.0", 1, frozenset())
    return "\n".join(lines), runs


def test_multipliers_against_a_plain_walk(spark):
    rng = random.Random(5)
    dumps = {f"d{i}": random_dump(rng) for i in range(40)}
    want = {(d, n): t for d, (_, runs) in dumps.items() for n, t in runs.items()}
    assert times(parsed(spark, **{d: text for d, (text, _) in dumps.items()})) == want


def test_entry(spark):
    comp = "%{0} (a: f32[]) -> f32[] {{\n  %x = f32[] exp(%a)\n}}\n"
    text = {"first": "ENTRY " + comp.format("one") + "ENTRY " + comp.format("two"),
            "preferred": "ENTRY " + comp.format("one") + comp.format("main.0") + "ENTRY " + comp.format("the_main") + "ENTRY " + comp.format("main.1")}
    assert times(parsed(spark, **text)) == {("first", "one"): 1, ("preferred", "the_main"): 1}


def test_a_dump_without_entry_raises(spark):
    for bad in ("%a (a: f32[]) -> f32[] {\n  %x = f32[] exp(%a)\n}", "HloModule m", ""):
        rows = [("good", i, line) for i, line in enumerate(TWO_LOOPS.splitlines())] + [("bad", i, line) for i, line in enumerate(bad.split("\n"))]
        lines = spark.createDataFrame(rows, "dump string, line_no long, line string")
        with pytest.raises(Exception, match="no ENTRY computation in bad"):
            hlo.ops(hlo.parse(hlo.own_lines(lines))).count()


def test_a_name_defined_again_holds_its_later_lines(spark):
    text = ("ENTRY %main (a: f32[]) -> f32[] {\n  %x = f32[] call(%a), to_apply=%f\n}\n%f (a: f32[]) -> f32[] {\n  %old = f32[] exp(%a)\n}\n"
            "%f (a: f32[]) -> f32[] {\n  %new = f32[] log(%a)\n}\n")
    assert [(r["op"], r["n"]) for r in hlo.census(parsed(spark, a=text)).collect()] == [("log", 1)]


LINES = [  # line, kind, op, payload, topology
    ("%a.1 = f32[2] custom-call(%x), backend_config={call_target_name=\"__cudnn$convForward\"}", "computation", "custom-call:cudnn:convForward", "f32[2]", None),
    ("%a.1 = f32[2] custom-call(%x), call_target_name=\"rocblas_gemm_ex.3\"", "computation", "custom-call:rocblas:gemm_ex", "f32[2]", None),
    ("%a.1 = f32[2] custom-call(%x), custom_call_target=\"topk\"", "computation", "custom-call:topk", "f32[2]", None),
    ("%a.1 = f32[2] custom-call(%x)", "computation", "custom-call", "f32[2]", None),
    ("%f = f32[2] fusion(%x), backend_config={\"kind\":\"kInput\"}", "computation", "fusion:input", "f32[2]", None),
    ("%f = f32[2] fusion(%x), backend_config={\"kind\":\"Triton\"}, kind=kLoop", "computation", "fusion:Triton", "f32[2]", None),
    ("%f = f32[2] fusion(%x), kind=kLoop", "computation", "fusion:loop", "f32[2]", None),
    ("%f = f32[2] fusion(%x)", "computation", "fusion", "f32[2]", None),
    ("%b = f32[2] bitcast(%x)", None, "bitcast", "f32[2]", None),
    ("ROOT %b = f32[2] exp(%x)", None, "exp", "f32[2]", None),
    ("%w = f32[2] while(%x)", None, "while", "f32[2]", None),
    ("%c = f32[2] call(%x)", "computation", "call", "f32[2]", None),
    ("%send-start.1 = ((f32[1], f32[1]), u32[]) send-start(%x), source_target_pairs={{0,1},{1,2}}, backend_config={\"a\":{\"b\":1}}",
     "communication", "send-start", "2xf32[1], u32[]", "{{0,1},{1,2}}"),
    ("%all-reduce-start = f32[4]{0} all-reduce-start(%x), replica_groups={{0,1,2,3}}, backend_config={\"a\":{\"b\":1},{\"c\":2}}",
     "communication", "all-reduce-start", "f32[4]{0}", "[1,4]<=[4]"),
    ("%all-reduce-start.2 = f32[4] all-reduce-start(%x), replica_groups=[8,2]<=[2,8]T(1,0), use_global_ids=true", "communication", "all-reduce-start", "f32[4]",
     "[8,2]<=[2,8]T(1,0)"),
    ("%all-reduce-start.2 = f32[4] all-reduce-start(%x), replica_groups={}", "communication", "all-reduce-start", "f32[4]", None),
    ("%all-reduce-start.2 = f32[4] all-reduce-start(%x), replica_groups={{}}", "communication", "all-reduce-start", "f32[4]", None),
    ("%x-start.9 = f32[4] copy-done(%x)", None, "copy-done", "f32[4]", None),
    ("%e = token[] after-all()", "computation", "after-all", "token[]", None),
    ("%n = after-all()", "computation", "after-all", None, None),
    ("no assignment (here)", None, None, None, None),
    ("// %q = f32[2] exp(%x)", None, None, None, None),
    ("", None, None, None, None),
]


def test_lines(spark):
    dumps = {f"d{i}": f"ENTRY %main (a: f32[]) -> f32[] {{\n  {case[0]}\n}}" for i, case in enumerate(LINES)}
    found = {r["dump"]: r for r in parsed(spark, **dumps).where("line_no = 1").collect()}
    for i, (line, kind, op, payload, topology) in enumerate(LINES):
        row = found[f"d{i}"]
        assert (row["kind"], row["payload"], row["topology"]) == (kind, payload, topology), line
        assert row["op"] == op or not kind, line


def test_topology_of_the_callee(spark):
    text = ("ENTRY %main (a: f32[]) -> f32[] {\n  %all-gather-start.1 = f32[8] async-start(%a), calls=%comp.1\n  %all-gather-start.2 = f32[8] async-start(%a), calls=%gone\n"
            "  %all-gather-start.3 = f32[8] async-start(%a), replica_groups=[1,8]<=[8], calls=%comp.1\n}\n"
            "%comp.1 (a: f32[]) -> f32[] {\n  %p = f32[] parameter(0)\n  %g = f32[8] all-gather(%p), replica_groups={{0,1},{2,3}}\n  ROOT %h = f32[8] all-gather(%g), replica_groups=[4,2]<=[8]\n}\n")
    found = {r["result"]: r["topology"] for r in hlo.communication_topology(parsed(spark, a=text)).collect()}
    assert found == {"%all-gather-start.1": "[2,2]<=[4]", "%all-gather-start.2": None, "%all-gather-start.3": "[1,8]<=[8]"}


def test_files_in_blocks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_text(TWO_LOOPS)
    (tmp_path / "sub" / "b.txt").write_text(TWO_LOOPS.replace("literal=5", "literal=2"))
    (tmp_path / "notes.md").write_text("not a dump")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    try:
        counts = hlo.census(hlo.parse(read_hlo_dumps(spark, str(tmp_path)))).where("op = 'all-reduce-start'").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r["dump"].rsplit("/", 1)[1]: r["n"] for r in counts} == {"a.txt": 60, "b.txt": 30}
