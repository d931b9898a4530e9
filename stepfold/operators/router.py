"""Expert-routing analytics (WIN4-6, RTR1-5).

A routing table is long: (token_id, seq_id, expert_id, score) with one row
per token and expert (the dense [tokens, experts] logits). Per-token work
(group-limited top-k, softmax) runs as windows over the rows of a token, all
on one exchange by token; per-expert work (capacity, permutation) ranks rows
with the range-bucketed ``global_index``, so a hot expert never sits in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stepfold.operators.common import global_index


def _softmax(value: str, over) -> Column:
    """Softmax of a column over a window, shifted by the maximum."""
    e = F.exp(F.col(value) - F.max(value).over(over))
    return e / F.sum(e).over(over)


def group_limited_topk(routes: DataFrame, topk: int, num_experts: int, num_groups: int | None = None,
                       group_topk: int | None = None, score_function: str = "softmax",
                       use_pre_softmax: bool = False, expert_bias: dict | None = None,
                       scaling_factor: float | None = None) -> DataFrame:
    """WIN4: per token the selected experts and their weights.

    * group score = sum of the two best routing scores of the group; the best
      ``group_topk`` groups are kept, then ``topk`` experts inside them;
    * softmax: softmax over the selected logits, or (``use_pre_softmax``)
      softmax over all experts first and no renormalising;
    * sigmoid: sigmoid scores, ``expert_bias`` added for selection only,
      weights divided by their sum + 1e-20 when topk > 1;
    * optional scaling factor. Ties go to the lower group / expert id.

    Output: (token_id, seq_id, expert_id, prob, slot).
    """
    token = Window.partitionBy("token_id")
    t = routes.select("token_id", "seq_id", "expert_id", F.col("score").cast("double").alias("w")).repartition("token_id")
    if score_function == "softmax":
        if use_pre_softmax:
            t = t.withColumn("w", _softmax("w", token))
        t = t.withColumn("r", F.col("w"))
    elif score_function == "sigmoid":
        bias = F.lit(0.0)
        for e, b in sorted((expert_bias or {}).items()):
            bias = F.when(F.col("expert_id") == e, float(b)).otherwise(bias)
        t = t.withColumn("w", 1.0 / (1.0 + F.exp(-F.col("w")))).withColumn("r", F.col("w") + bias)
    else:
        raise ValueError(f"Invalid score_function: {score_function}")
    if group_topk:
        t = t.withColumn("g", F.floor(F.col("expert_id") / (num_experts // num_groups)).cast("int"))
        group = Window.partitionBy("token_id", "g")
        t = t.withColumn("_in", F.row_number().over(group.orderBy(F.col("r").desc(), "expert_id")))
        t = t.withColumn("_gs", F.sum(F.when(F.col("_in") <= 2, F.col("r"))).over(group))
        t = t.withColumn("_gr", F.dense_rank().over(token.orderBy(F.col("_gs").desc(), "g"))) \
            .filter(F.col("_gr") <= group_topk)
    t = t.withColumn("slot", F.row_number().over(token.orderBy(F.col("r").desc(), "expert_id")) - 1) \
        .filter(F.col("slot") < topk)
    if score_function == "softmax" and not use_pre_softmax:
        t = t.withColumn("prob", _softmax("w", token))
    elif score_function == "sigmoid" and topk > 1:
        t = t.withColumn("prob", F.col("w") / (F.sum("w").over(token) + 1e-20))
    else:
        t = t.withColumn("prob", F.col("w"))
    if scaling_factor:
        t = t.withColumn("prob", F.col("prob") * scaling_factor)
    return t.select("token_id", "seq_id", "expert_id", "prob", F.col("slot").cast("int").alias("slot"))


def capacity(num_tokens: Column, topk: int, num_experts: int, capacity_factor: float) -> Column:
    """Rows each expert keeps: ceil(n * k / E * factor)."""
    return F.ceil(num_tokens * topk / num_experts * capacity_factor).cast("long")


def capacity_drop(routes: DataFrame, selected: DataFrame, topk: int, num_experts: int,
                  capacity_factor: float, policy: str = "probs", pad_to_capacity: bool = False) -> DataFrame:
    """WIN5: each expert keeps its first ``capacity`` rows — highest
    probability (``probs``) or earliest token (``position``); ties by token.

    With ``pad_to_capacity`` every expert gets exactly ``capacity`` rows:
    tokens not routed to it follow with weight 0 in token order (they are
    the other rows of the dense routing table, so no cross product is built).
    Ranks per expert come from ``global_index`` (range-bucketed).
    """
    n_tokens = routes.select(F.countDistinct("token_id").alias("n"))
    cand = routes.select("token_id", "expert_id").join(
        selected.select("token_id", "expert_id", "prob"), ["token_id", "expert_id"], "left")
    cand = cand.withColumn("routed", F.col("prob").isNotNull()) \
        .withColumn("prob", F.coalesce(F.col("prob"), F.lit(0.0)))
    if not pad_to_capacity:
        cand = cand.filter("routed")
    if policy == "probs":
        cand = cand.withColumn("_k", -F.col("prob"))
    elif policy == "position":
        cand = cand.withColumn("_k", (~F.col("routed")).cast("int"))
    else:
        raise ValueError(f"Invalid drop_policy: {policy}")
    ranked = global_index(cand, order=["_k", "token_id"], group=["expert_id"], out="pos_in_expert")
    cap = capacity(F.col("n"), topk, num_experts, capacity_factor)
    return (ranked.crossJoin(F.broadcast(n_tokens))  # one-row table
            .filter(F.col("pos_in_expert") < cap)
            .select("token_id", "expert_id", F.when(F.col("routed"), F.col("prob")).otherwise(0.0).alias("prob"),
                    "routed", "pos_in_expert"))


def expert_permute(selected: DataFrame) -> DataFrame:
    """WIN6: rows regrouped by expert in token order; ``perm_pos`` is the
    position in the permuted buffer, (token_id, slot) the inverse index."""
    return global_index(selected, order=["expert_id", "token_id"], out="perm_pos")


def expert_unpermute(permuted: DataFrame, value: str = "value") -> DataFrame:
    """Inverse of WIN6: weighted sum of the expert outputs back to tokens."""
    return permuted.groupBy("token_id").agg(F.sum(F.col("prob") * F.col(value)).alias(value))


def tokens_per_expert(routes: DataFrame, selected: DataFrame, rate: float = 1e-3) -> DataFrame:
    """RTR1: load per expert including zero-load experts, and the expert-bias
    step ``bias + sign(avg - load) * rate`` (bias starting at 0)."""
    experts = routes.select("expert_id").distinct()
    load = selected.groupBy("expert_id").agg(F.count(F.lit(1)).alias("load"))
    out = experts.join(load, "expert_id", "left").withColumn("load", F.coalesce(F.col("load"), F.lit(0)))
    avg = out.agg(F.avg("load").alias("avg_load"))
    return out.crossJoin(F.broadcast(avg)).select(  # one-row table
        "expert_id", "load", (F.signum(F.col("avg_load") - F.col("load")) * rate).alias("bias_update"))


def routing_probs(routes: DataFrame) -> DataFrame:
    """Softmax over all experts per token, long form (token_id, seq_id, expert_id, p)."""
    t = routes.select("token_id", "seq_id", "expert_id", F.col("score").cast("double").alias("score"))
    return t.select("token_id", "seq_id", "expert_id", _softmax("score", Window.partitionBy("token_id")).alias("p"))


def load_balance_loss(routes: DataFrame, selected: DataFrame, topk: int, coeff: float) -> DataFrame:
    """RTR2: sum_e(sum_t p[t,e] * load_e) * E * coeff / (n^2 * k)."""
    p = routing_probs(routes).groupBy("expert_id").agg(F.sum("p").alias("p_sum"))
    load = selected.groupBy("expert_id").agg(F.count(F.lit(1)).alias("load"))
    dims = routes.agg(F.countDistinct("token_id").alias("n"), F.countDistinct("expert_id").alias("E"))
    s = p.join(load, "expert_id", "left").agg(F.sum(F.col("p_sum") * F.coalesce(F.col("load"), F.lit(0))).alias("s"))
    return s.crossJoin(F.broadcast(dims)).select(  # one-row table
       
        (F.col("s") * F.col("E") * coeff / (F.col("n") * F.col("n") * topk)).alias("aux_loss"))


def sequence_balance_loss(routes: DataFrame, selected: DataFrame, topk: int, coeff: float) -> DataFrame:
    """RTR3: per sequence sum_e(count_e / (L * k / E) * mean_t p[t,e]), mean over
    sequences, times coeff (L = tokens of the sequence)."""
    p = routing_probs(routes)
    E = routes.agg(F.countDistinct("expert_id").alias("E"))
    per = p.groupBy("seq_id", "expert_id").agg(F.avg("p").alias("p_mean"))
    cnt = selected.groupBy("seq_id", "expert_id").agg(F.count(F.lit(1)).alias("c"))
    L = routes.groupBy("seq_id").agg(F.countDistinct("token_id").alias("L"))
    s = (per.join(cnt, ["seq_id", "expert_id"], "left").join(L, "seq_id").crossJoin(F.broadcast(E))  # one-row table
        
         .groupBy("seq_id")
         .agg(F.sum(F.coalesce(F.col("c"), F.lit(0)) / (F.col("L") * topk / F.col("E")) * F.col("p_mean"))
              .alias("seq_loss")))
    return s.agg((F.avg("seq_loss") * coeff).alias("seq_aux_loss"))


def z_loss(routes: DataFrame, coeff: float) -> DataFrame:
    """RTR4: mean over tokens of logsumexp(logits)^2, times coeff (max-shifted)."""
    t = routes.groupBy("token_id").agg(F.max("score").alias("m"),
                                       F.collect_list(F.col("score").cast("double")).alias("v"))
    lse = F.log(F.aggregate("v", F.lit(0.0), lambda acc, s: acc + F.exp(s - F.col("m")))) + F.col("m")
    return t.select(lse.alias("lse")).agg((F.avg(F.col("lse") * F.col("lse")) * coeff).alias("z_loss"))


def layer_loss_summary(losses: DataFrame, num_layers: int, moe_layer_freq: int | list = 1) -> DataFrame:
    """RTR5: per (name, layer) values summed over ranks; per name the mean over
    the MoE layers (count from an int frequency or a 0/1 list)."""
    if isinstance(moe_layer_freq, int):
        n_moe = len([i for i in range(num_layers) if i % moe_layer_freq == 0])
    else:
        n_moe = sum(1 for v in moe_layer_freq if v)
    per_layer = losses.groupBy("name", "layer").agg(F.sum("value").alias("layer_value"))
    return per_layer.groupBy("name").agg(
        (F.sum("layer_value") / F.lit(n_moe)).alias("mean_loss"), F.count(F.lit(1)).alias("n_layers"))
