"""Registered queries and oracles: HLO dumps, one for each supplier."""

from __future__ import annotations

from stepfold.operators import hlo as H
from stepfold.plans.finalize import rounded
from stepfold.plans.views_hlo import v_hlo

QUERIES = {}
ORACLE = {}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# The ops of a dump and how often its computations run, from the numbers behind the text.
OPS = """d AS (SELECT s_suppkey AS k, s_suppkey % 7 + 1 AS t1, s_nationkey % 5 + 1 AS t2, concat('dumps/module_', s_suppkey, '.txt') AS dump FROM supplier),
runs AS (SELECT *, CASE k % 4 WHEN 2 THEN 1 WHEN 3 THEN 0 ELSE t1 END AS outer_times FROM d),
o AS (
  SELECT dump, k, unnest([
    {'line_no': 3, 'comp': concat('aux.', k), 'kind': 'computation', 'op': 'copy', 'result': '%copy.9', 'payload': 'f32[]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 8, 'comp': concat('main.', k), 'kind': 'computation', 'op': 'fusion:loop', 'result': '%fusion.3', 'payload': 'bf16[256,512]{1,0}',
     'op_path': 'jit(step)/mul', 'source': concat('/w/mlp.py:', k % 90 + 10), 'topology': NULL},
    {'line_no': 9, 'comp': concat('main.', k), 'kind': 'computation', 'op': ['custom-call:cublas:gemm', 'custom-call:rocblas:gemm_ex', 'custom-call:topk'][k % 3 + 1],
     'result': '%gemm.5', 'payload': 'bf16[256,256]{1,0}, s8[4096]{0}', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 12, 'comp': concat('main.', k), 'kind': 'communication', 'op': 'all-gather-start', 'result': '%all-gather-start.7',
     'payload': '2xbf16[8]{0}, bf16[64]{0}', 'op_path': 'jit(step)/gather', 'source': NULL, 'topology': '[4,2]<=[8]'},
    {'line_no': 14, 'comp': concat('main.', k), 'kind': 'computation', 'op': 'sort', 'result': '%sort.6', 'payload': 's32[64]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 23, 'comp': 'outer.body', 'kind': 'communication', 'op': 'all-reduce-start', 'result': '%all-reduce-start.1', 'payload': 'f32[8192]{0}',
     'op_path': 'jit(step)/grad', 'source': '/w/opt.py:?', 'topology': '[2,4]<=[8]'},
    {'line_no': 26, 'comp': 'outer.body', 'kind': 'computation', 'op': 'add', 'result': '%next', 'payload': 's32[]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 35, 'comp': 'inner.body', 'kind': 'communication', 'op': 'collective-permute-start', 'result': '%collective-permute-start.3',
     'payload': '2xf32[64]{0}', 'op_path': NULL, 'source': concat('?:', k % 50), 'topology': '{{0,1},{1,0}}'},
    {'line_no': 37, 'comp': 'inner.body', 'kind': 'computation', 'op': 'fusion:wrapped_reduce', 'result': '%fusion.8', 'payload': 'f32[64]{0}',
     'op_path': 'jit(step)/inner', 'source': NULL, 'topology': NULL},
    {'line_no': 45, 'comp': 'else', 'kind': 'communication', 'op': 'reduce-scatter-start', 'result': '%reduce-scatter-start.4',
     'payload': 'f32[8]{0}, f32[1]{0}', 'op_path': NULL, 'source': NULL, 'topology': '[2,4]<=[4,2]T(1,0)'},
    {'line_no': 48, 'comp': 'third', 'kind': 'computation', 'op': 'exponential', 'result': '%exp.1', 'payload': 'f32[8]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 52, 'comp': 'helper', 'kind': 'computation', 'op': 'multiply', 'result': '%mul.2', 'payload': 'f32[4]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 56, 'comp': 'again', 'kind': 'computation', 'op': 'negate', 'result': '%neg.1', 'payload': 'f32[4]', 'op_path': NULL, 'source': NULL, 'topology': NULL},
    {'line_no': 63, 'comp': 'unused', 'kind': 'computation', 'op': 'dot', 'result': '%dot.1', 'payload': 'f32[2,2]', 'op_path': NULL, 'source': NULL, 'topology': NULL}
  ], recursive := true) FROM d),
ops AS (SELECT dump, comp, line_no::BIGINT AS line_no, kind, op, result, payload, op_path, source, topology FROM o WHERE line_no <> 3 OR k % 5 = 0),
m AS (SELECT dump, unnest([
    {'comp': concat('main.', k), 'times': 1}, {'comp': 'outer.body', 'times': outer_times}, {'comp': 'inner.body', 'times': outer_times * t2},
    {'comp': 'then', 'times': 1}, {'comp': 'else', 'times': 1}, {'comp': 'third', 'times': k % 2}, {'comp': 'helper', 'times': 2}, {'comp': 'again', 'times': 2}
  ], recursive := true), k FROM runs),
multipliers AS (SELECT dump, comp, times::BIGINT AS times FROM m WHERE comp <> 'third' OR k % 2 = 1)"""


def _parsed(spark, sf_dir):
    return H.parse(H.own_lines(v_hlo(spark, sf_dir)))


@register("hlo_ops", f"WITH {OPS} SELECT dump, comp, line_no, kind, op, result, op_path, source FROM ops")
def q_hlo_ops(spark, sf_dir):
    return H.ops(_parsed(spark, sf_dir)).drop("payload")


@register("hlo_payload", f"WITH {OPS} SELECT dump, line_no, op, payload FROM ops")
def q_hlo_payload(spark, sf_dir):
    return H.ops(_parsed(spark, sf_dir)).select("dump", "line_no", "op", "payload")


@register("hlo_topology", f"WITH {OPS} SELECT dump, comp, line_no, op, result, topology FROM ops WHERE kind = 'communication'")
def q_hlo_topology(spark, sf_dir):
    return H.communication_topology(_parsed(spark, sf_dir))


@register("hlo_multipliers", f"WITH {OPS} SELECT dump, comp, times FROM multipliers")
def q_hlo_multipliers(spark, sf_dir):
    return H.multipliers(_parsed(spark, sf_dir))


CENSUS = """, c AS (SELECT dump, kind, {op} AS op, sum(times)::BIGINT AS n FROM ops JOIN multipliers USING (dump, comp) GROUP BY ALL)
SELECT dump, kind, op, n, (sum(n) OVER w)::BIGINT AS total, count(*) OVER w AS categories FROM c WINDOW w AS (PARTITION BY dump, kind)"""


@register("hlo_census", f"WITH {OPS}" + CENSUS.format(op="CASE WHEN op LIKE 'fusion:%' THEN 'fusion' ELSE op END"))
def q_hlo_census(spark, sf_dir):
    return H.census(_parsed(spark, sf_dir))


@register("hlo_census_by_fusion", f"WITH {OPS}" + CENSUS.format(op="op"))
def q_hlo_census_by_fusion(spark, sf_dir):
    return H.census(_parsed(spark, sf_dir), fusion_kinds=True)
