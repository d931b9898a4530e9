"""Test view: a compiler dump in HLO text for each supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepfold.plans.tables import table

# (condition or None, format, its arguments). k is s_suppkey, t1 and t2 the trips of the outer and inner loop.
# How the outer loop tells its trips goes by k % 4: 0 metadata (its condition says 999), 1 a constant, 2 not at all, 3 a negative constant.
TEMPLATE = [
    (None, "HloModule jit_step_%d, is_scheduled=true", ["k"]),
    (None, "", []),
    ("k % 5 = 0", "ENTRY %%aux.%d (q: f32[]) -> f32[] {", ["k"]),
    ("k % 5 = 0", "  %%copy.9 = f32[] copy(%%q)", []),
    ("k % 5 = 0", "}", []),
    (None, "ENTRY %%main.%d (p: f32[1024]) -> f32[1024] {", ["k"]),
    (None, "  %%p = f32[1024] parameter(0)", []),
    (None, "  %%while.1 = f32[1024] while(%%p), condition=%%outer.cond, body=%%outer.body%s",
     ["if(k % 4 = 0, concat(', backend_config={\"known_trip_count\":{\"n\":\"', t1, '\"}}'), '')"]),
    (None, '  %%fusion.3 = bf16[256,512]{1,0} fusion(%%p, %%p), kind=kLoop, calls=%%fused, metadata={op_name="jit(step)/mul" source_file="/w/mlp.py" source_line=%d}',
     ["k % 90 + 10"]),
    (None, "  %%gemm.5 = (bf16[256,256]{1,0}, s8[4096]{0}) custom-call(%%p), %s",
     ["element_at(array('call_target_name=\"__cublas$gemm.2\"', 'call_target_name=\"rocblas_gemm_ex\"', 'custom_call_target=\"topk.11\"'), cast(k % 3 + 1 as int))"]),
    (None, "  %%conditional.2 = f32[8] conditional(%%p), %s",
     ["if(k % 2 = 0, 'true_computation=%then, false_computation=%else', 'branch_computations={%then, %else, %third}')"]),
    (None, "  %%call.4 = f32[4] call(%%p), to_apply=%%helper", []),
    (None, '  %%all-gather-start.7 = ((bf16[8]{0}, bf16[8]{0}), bf16[64]{0}) async-start(%%p), calls=%%async.7, metadata={op_name="jit(step)/gather"}', []),
    (None, "  %%all-gather-done.7 = bf16[64]{0} async-done(%%all-gather-start.7)", []),
    (None, "  %%sort.6 = s32[64] sort(%%p), dimensions={0} // %%all-reduce-start.9 = f32[1] all-reduce-start(%%p), replica_groups={{0,1}}", []),
    (None, "  ROOT %%out = f32[1024] get-tuple-element(%%while.1), index=0", []),
    (None, "}", []),
    (None, "%%outer.cond (s: (s32[], f32[1024])) -> pred[] {", []),
    (None, "  %%i = s32[] get-tuple-element(%%s), index=0", []),
    (None, "  %%limit = s32[] %s", ["element_at(array('constant(), literal=999', concat('constant(), literal=', t1), "
                                     "'get-tuple-element(%s), index=2', 'constant(), literal=-3'), cast(k % 4 + 1 as int))"]),
    (None, "  ROOT %%lt = pred[] compare(%%i, %%limit), direction=LT", []),
    (None, "}", []),
    (None, "%%outer.body (x: (s32[], f32[1024])) -> (s32[], f32[1024]) {", []),
    (None, '  %%all-reduce-start.1 = f32[8192]{0} all-reduce-start(%%x), channel_id=%d, replica_groups={{0,1,2,3},{4,5,6,7}}, to_apply=%%sum, '
           'metadata={op_name="jit(step)/grad" source_file="/w/opt.py"}, backend_config={"collective":{"is_sync":false}}', ["k"]),
    (None, "  %%all-reduce-done.1 = f32[8192]{0} all-reduce-done(%%all-reduce-start.1)", []),
    (None, "  %%while.2 = f32[64] while(%%x), condition=%%inner.cond, body=%%inner.body", []),
    (None, "  %%next = s32[] add(%%i, %%one)", []),
    (None, "  ROOT %%t = (s32[], f32[1024]) tuple(%%next, %%x)", []),
    (None, "}", []),
    (None, "%%inner.cond (y: f32[64]) -> pred[] {", []),
    (None, "  %%c = s32[] constant(), literal=0", []),
    (None, "  %%n = s32[] constant(), literal=%d", ["t2"]),
    (None, "  ROOT %%lt.2 = pred[] compare(%%c, %%n), direction=LT", []),
    (None, "}", []),
    (None, "%%inner.body (y: f32[64]) -> f32[64] {", []),
    (None, "  %%collective-permute-start.3 = (f32[64]{0}, f32[64]{0}) collective-permute-start(%%y), source_target_pairs={{0,1},{1,0}}, metadata={source_line=%d}",
     ["k % 50"]),
    (None, "  %%collective-permute-done.3 = f32[64]{0} collective-permute-done(%%collective-permute-start.3)", []),
    (None, '  %%fusion.8 = f32[64]{0} fusion(%%y), kind=kInput, metadata={op_name="jit(step)/inner" scheduling_name="wrapped_reduce.5"}', []),
    (None, "  ROOT %%r = f32[64] bitcast(%%fusion.8)", []),
    (None, "}", []),
    (None, "%%then (z: f32[8]) -> f32[8] {", []),
    (None, "  %%call.8 = f32[8] call(%%z), to_apply=%%helper", []),
    (None, "  ROOT %%r = f32[8] copy(%%z)", []),
    (None, "}", []),
    (None, "%%else (z: f32[8]) -> f32[8] {", []),
    (None, "  %%reduce-scatter-start.4 = (f32[8]{0}, f32[1]{0}) reduce-scatter-start(%%z), replica_groups=[2,4]<=[4,2]T(1,0), dimensions={0}", []),
    (None, "}", []),
    (None, "%%third (z: f32[8]) -> f32[8] {", []),
    (None, "  %%exp.1 = f32[8] exponential(%%z)", []),
    (None, "}", []),
    (None, "%%helper (h: f32[4]) -> f32[4] {", []),
    (None, "  %%call.9 = f32[4] call(%%h), calls=%%again", []),
    (None, "  %%mul.2 = f32[4] multiply(%%h, %%h)", []),
    (None, "}", []),
    (None, "%%again (h: f32[4]) -> f32[4] {", []),
    (None, "  %%call.10 = f32[4] call(%%h), to_apply=%%helper", []),
    (None, "  %%neg.1 = f32[4] negate(%%h)", []),
    (None, "}", []),
    (None, "%%async.7 (a: bf16[8]) -> bf16[64] {", []),
    (None, "  %%a = bf16[8] parameter(0)", []),
    (None, "  ROOT %%ag = bf16[64] all-gather(%%a), replica_groups=[4,2]<=[8], dimensions={0}", []),
    (None, "}", []),
    (None, "%%unused (a: f32[2,2]) -> f32[2,2] {", []),
    (None, "  %%dot.1 = f32[2,2] dot(%%a, %%b)", []),
    (None, "}", []),
]


def v_hlo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dump, line_no, line): the template's lines, a missing one leaves a gap in the numbers."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as k", "s_suppkey % 7 + 1 as t1", "s_nationkey % 5 + 1 as t2")
    lines = [F.struct(F.lit(i).cast("long").alias("line_no"),
                      F.when(F.expr(when or "true"), F.format_string(text, *[F.expr(a) for a in arguments]) if arguments else F.lit(text.replace("%%", "%"))).alias("line"))
             for i, (when, text, arguments) in enumerate(TEMPLATE)]
    dump = F.format_string("dumps/module_%d.txt", "k").alias("dump")
    return s.select(dump, F.inline(F.array(*lines))).where("line is not null")
