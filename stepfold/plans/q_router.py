"""Registered queries and oracles of the expert-routing jobs (from ``embeddings``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from stepfold.operators import router as R
from stepfold.plans.finalize import rounded
from stepfold.plans.tables import table

QUERIES = {}
ORACLE = {}

E, GROUPS, GROUP_TOPK, TOPK, CAP_FACTOR, AUX_COEFF, Z_COEFF = 64, 8, 4, 8, 1.0, 1e-2, 1e-3
BIAS = {e: (e % 5) * 0.02 for e in range(E)}


def register(name, sql=None):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def v_router(spark, sf_dir):
    """(token_id, seq_id, expert_id, score): one expert for each of the 64 values of an embedding."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(F.col("vec_id").alias("token_id"), F.col("label").alias("seq_id"),
                      F.posexplode("embedding").alias("expert_id", "score")) \
        .withColumn("score", F.col("score").cast("double")) \
        .withColumn("expert_id", F.col("expert_id").cast("int"))


def _selected(spark, sf_dir):
    routes = v_router(spark, sf_dir)
    return routes, R.group_limited_topk(routes, TOPK, E, GROUPS, GROUP_TOPK)


ROUTER = f"""vr AS (
  SELECT vec_id AS token_id, label AS seq_id, CAST(i - 1 AS INTEGER) AS expert_id, CAST(embedding[i] AS DOUBLE) AS score
  FROM embeddings CROSS JOIN range(1, {E + 1}) t(i)),
g1 AS (SELECT token_id, expert_id // {E // GROUPS} AS g, score,
              row_number() OVER (PARTITION BY token_id, expert_id // {E // GROUPS} ORDER BY score DESC) AS r FROM vr),
gsc AS (SELECT token_id, g, sum(score) AS gscore FROM g1 WHERE r <= 2 GROUP BY ALL),
gsel AS (SELECT token_id, g FROM (
  SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY gscore DESC, g) AS rg FROM gsc) WHERE rg <= {GROUP_TOPK}),
cand AS (SELECT vr.* FROM vr JOIN gsel ON vr.token_id = gsel.token_id AND vr.expert_id // {E // GROUPS} = gsel.g),
top AS (SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY token_id ORDER BY score DESC, expert_id) - 1 AS INTEGER) AS slot
  FROM cand) WHERE slot < {TOPK}),
mx AS (SELECT *, max(score) OVER (PARTITION BY token_id) AS m FROM top),
sel AS (SELECT token_id, seq_id, expert_id, slot,
               exp(score - m) / sum(exp(score - m)) OVER (PARTITION BY token_id) AS prob FROM mx),
ntok AS (SELECT count(DISTINCT token_id) AS n FROM vr),
probs AS (SELECT token_id, seq_id, expert_id, exp(score - m) / sum(exp(score - m)) OVER (PARTITION BY token_id) AS p
          FROM (SELECT *, max(score) OVER (PARTITION BY token_id) AS m FROM vr))"""


@register("group_limited_topk", f"""WITH {ROUTER}
SELECT token_id, seq_id, expert_id, round(prob, 8) AS prob, slot FROM sel""")
def q_group_limited_topk(spark, sf_dir):
    return _selected(spark, sf_dir)[1]


@register("capacity_drop", f"""WITH {ROUTER}
SELECT token_id, expert_id, round(prob, 8) AS prob, true AS routed, pos_in_expert FROM (
  SELECT *, row_number() OVER (PARTITION BY expert_id ORDER BY -prob, token_id) - 1 AS pos_in_expert FROM sel)
WHERE pos_in_expert < (SELECT CAST(ceil(n * {TOPK} / {E} * {CAP_FACTOR}) AS BIGINT) FROM ntok)""")
def q_capacity_drop(spark, sf_dir):
    routes, sel = _selected(spark, sf_dir)
    return R.capacity_drop(routes, sel, TOPK, E, CAP_FACTOR, policy="probs")


@register("capacity_pad", f"""WITH {ROUTER}, c AS (
  SELECT vr.token_id, vr.expert_id, sel.prob IS NOT NULL AS routed, coalesce(sel.prob, 0.0) AS prob
  FROM vr LEFT JOIN sel ON vr.token_id = sel.token_id AND vr.expert_id = sel.expert_id)
SELECT token_id, expert_id, round(prob, 8) AS prob, routed, pos_in_expert FROM (
  SELECT *, row_number() OVER (PARTITION BY expert_id ORDER BY CASE WHEN routed THEN 0 ELSE 1 END, token_id) - 1 AS pos_in_expert FROM c)
WHERE pos_in_expert < (SELECT CAST(ceil(n * {TOPK} / {E} * {CAP_FACTOR}) AS BIGINT) FROM ntok)""")

def q_capacity_pad(spark, sf_dir):
    routes, sel = _selected(spark, sf_dir)
    return R.capacity_drop(routes, sel, TOPK, E, CAP_FACTOR, policy="position", pad_to_capacity=True)


@register("expert_permute", f"""WITH {ROUTER}
SELECT token_id, seq_id, expert_id, round(prob, 8) AS prob, slot,
       row_number() OVER (ORDER BY expert_id, token_id) - 1 AS perm_pos
FROM sel""")
def q_expert_permute(spark, sf_dir):
    return R.expert_permute(_selected(spark, sf_dir)[1])


@register("expert_unpermute", f"""WITH {ROUTER}
SELECT token_id, round(sum(prob * (token_id % 97 + 1)), 8) AS value FROM sel GROUP BY token_id""")
def q_expert_unpermute(spark, sf_dir):
    """Round trip: tokens permuted to their experts, which pass them on, come back as the weighted sum of what they were."""
    permuted = R.expert_permute(_selected(spark, sf_dir)[1])
    return R.expert_unpermute(permuted.withColumn("value", (F.col("token_id") % 97 + 1).cast("double")))


@register("sigmoid_topk", f"""WITH {ROUTER.split(',\ng1 AS')[0]}, s AS (
  SELECT *, 1.0 / (1.0 + exp(-score)) AS w, 1.0 / (1.0 + exp(-score)) + (expert_id % 5) * 0.02 AS r FROM vr),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY token_id ORDER BY r DESC, expert_id) - 1 AS INTEGER) AS slot FROM s)
SELECT token_id, seq_id, expert_id, slot, round(2.5 * w / (sum(w) OVER (PARTITION BY token_id) + 1e-20), 8) AS prob
FROM t WHERE slot < {TOPK}""")
def q_sigmoid_topk(spark, sf_dir):
    return R.group_limited_topk(v_router(spark, sf_dir), TOPK, E, score_function="sigmoid", expert_bias=BIAS, scaling_factor=2.5)


@register("pre_softmax_topk", f"""WITH {ROUTER}, t AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY token_id ORDER BY p DESC, expert_id) - 1 AS INTEGER) AS slot FROM probs)
SELECT token_id, seq_id, expert_id, slot, round(p, 8) AS prob FROM t WHERE slot < {TOPK}""")
def q_pre_softmax_topk(spark, sf_dir):
    return R.group_limited_topk(v_router(spark, sf_dir), TOPK, E, use_pre_softmax=True)


@register("tokens_per_expert", f"""WITH {ROUTER}, l AS (
  SELECT e.expert_id, coalesce(c.load, 0) AS load
  FROM (SELECT DISTINCT expert_id FROM vr) e LEFT JOIN (SELECT expert_id, count(*) AS load FROM sel GROUP BY ALL) c USING (expert_id))
SELECT expert_id, load, CAST(sign((SELECT avg(load) FROM l) - load) AS DOUBLE) * 0.001 AS bias_update FROM l""")
def q_tokens_per_expert(spark, sf_dir):
    routes, sel = _selected(spark, sf_dir)
    return R.tokens_per_expert(routes, sel)


@register("load_balance_loss", f"""WITH {ROUTER},
ps AS (SELECT expert_id, sum(p) AS p_sum FROM probs GROUP BY ALL),
ld AS (SELECT expert_id, count(*) AS load FROM sel GROUP BY ALL)
SELECT round(sum(p_sum * coalesce(load, 0)) * {E} * {AUX_COEFF} / ((SELECT n FROM ntok) * (SELECT n FROM ntok) * {TOPK}), 8) AS aux_loss
FROM ps LEFT JOIN ld USING (expert_id)""")
def q_load_balance_loss(spark, sf_dir):
    routes, sel = _selected(spark, sf_dir)
    return R.load_balance_loss(routes, sel, TOPK, AUX_COEFF)


@register("sequence_balance_loss", f"""WITH {ROUTER},
per AS (SELECT seq_id, expert_id, avg(p) AS p_mean FROM probs GROUP BY ALL),
cnt AS (SELECT seq_id, expert_id, count(*) AS c FROM sel GROUP BY ALL),
L AS (SELECT seq_id, count(DISTINCT token_id) AS L FROM vr GROUP BY ALL),
s AS (SELECT seq_id, sum(coalesce(c, 0) / (L * {TOPK} / {E}) * p_mean) AS seq_loss
      FROM per LEFT JOIN cnt USING (seq_id, expert_id) JOIN L USING (seq_id) GROUP BY seq_id)
SELECT round(avg(seq_loss) * {AUX_COEFF}, 8) AS seq_aux_loss FROM s""")
def q_sequence_balance_loss(spark, sf_dir):
    routes, sel = _selected(spark, sf_dir)
    return R.sequence_balance_loss(routes, sel, TOPK, AUX_COEFF)


@register("z_loss", f"""WITH {ROUTER}, t AS (
  SELECT token_id, ln(sum(exp(score - m))) + m AS lse FROM (
    SELECT *, max(score) OVER (PARTITION BY token_id) AS m FROM vr) GROUP BY token_id, m)
SELECT round(avg(lse * lse) * {Z_COEFF}, 8) AS z_loss FROM t""")
def q_z_loss(spark, sf_dir):
    return R.z_loss(v_router(spark, sf_dir), Z_COEFF)


@register("layer_loss_summary", """WITH ll AS (
  SELECT CASE l_returnflag WHEN 'A' THEN 'load_balancing_loss' WHEN 'N' THEN 'z_loss' ELSE 'seq_load_balancing_loss' END AS name,
         l_linenumber AS layer, l_discount AS value FROM lineitem)
SELECT name, round(sum(value) / 7, 8) AS mean_loss, count(DISTINCT layer) AS n_layers FROM ll GROUP BY name""")
def q_layer_loss_summary(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    losses = li.select(
        F.when(F.col("l_returnflag") == "A", "load_balancing_loss").when(F.col("l_returnflag") == "N", "z_loss")
        .otherwise("seq_load_balancing_loss").alias("name"),
        F.col("l_linenumber").alias("layer"), (F.col("l_suppkey") % 8).alias("rank"),
        F.col("l_discount").alias("value"))
    return R.layer_loss_summary(losses, num_layers=7, moe_layer_freq=1)
