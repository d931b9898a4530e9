"""Test views for checkpoint, loss, memory, fleet and pipeline jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepfold.plans.tables import table
from stepfold.plans.views_bench import LINEITEM_ORDER
from stepfold.plans.views_logs import v_steps

ESC = "\u001b"


# ------------------------------------------------------------------ checkpoints

def v_ckpt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed checkpoint messages (run, line_no, ts, msg). Runs 7 and 13 save
    asynchronously, run 13 logs the overlap warning, run 19 misses some ends."""
    o = table(spark, sf_dir, "orders")
    run = (F.col("o_custkey") % 20).cast("int")
    k = F.col("o_orderkey")
    start = F.col("o_orderdate")
    ev = [
        F.struct(F.lit(0).alias("kind"), start.alias("ts"),
                 F.format_string("saving checkpoint at iteration %d to /ckpt", k).alias("msg")),
        F.struct(F.lit(1).alias("kind"), (start + F.make_dt_interval(secs=(k % 30).cast("int"))).alias("ts"),
                 F.format_string("scheduled an async checkpoint save at iteration %d", k).alias("msg")),
        F.struct(F.lit(2).alias("kind"), (start + F.make_dt_interval(secs=(k % 600 + 1).cast("int"))).alias("ts"),
                 F.format_string("successfully saved checkpoint from iteration %d to /ckpt", k).alias("msg")),
        F.struct(F.lit(3).alias("kind"), (start + F.make_dt_interval(secs=F.lit(2))).alias("ts"),
                 F.lit("Starting a checkpoint save before previous has finished").alias("msg")),
    ]
    rows = o.select(run.alias("run"), k.alias("o_orderkey"), F.inline(F.array(*ev)))
    keep = ((F.col("kind") == 0) |
            ((F.col("kind") == 1) & F.col("run").isin(7, 13)) |
            ((F.col("kind") == 2) & ~((F.col("run") == 19) & (F.col("o_orderkey") % 7 == 0))) |
            ((F.col("kind") == 3) & (F.col("run") == 13) & (F.col("o_orderkey") % 50 == 0)))
    saves = rows.filter(keep).select("run", (F.col("o_orderkey") * 4 + F.col("kind")).alias("line_no"),
                                     "ts", "msg")
    runs = saves.select("run").distinct()
    t0 = F.to_timestamp_ntz(F.lit("1990-01-01 00:00:00"))
    load = runs.select("run", F.lit(-2).cast("long").alias("line_no"), t0.alias("ts"),
                       F.lit("loading checkpoint from /ckpt at iteration 0").alias("msg")) \
        .unionByName(runs.select("run", F.lit(-1).cast("long").alias("line_no"),
                                 (t0 + F.make_dt_interval(secs=(F.col("run") * 3 + 5))).alias("ts"),
                                 F.lit("successfully loaded checkpoint from /ckpt at iteration 0").alias("msg")))
    args = runs.select("run", F.lit(-10).cast("long").alias("line_no"), t0.alias("ts"),
                       F.format_string("async_save ...................... %s",
                                       F.when(F.col("run").isin(7, 13), "True").otherwise("False")).alias("msg"))
    return saves.unionByName(load).unionByName(args)


def v_ckpt_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered rank logs: (path, line_no, line) in the logger's header layout,
    first and last rank (0 and 7) and one middle rank (3); ranks write the same messages."""
    e = v_ckpt_events(spark, sf_dir)
    ranks = spark.createDataFrame([(0,), (3,), (7,)], "rank int")
    hdr = F.format_string("[%s][user/team][checkpointing.py:%d]: ", F.date_format("ts", "yyyyMMdd HH:mm:ss"),
                          F.pmod(F.col("line_no"), F.lit(900)).cast("int"))
    line = F.concat(F.lit(ESC + "[32m"), hdr, F.lit(ESC + "[0m"), F.col("msg"))
    return e.crossJoin(F.broadcast(ranks)).select(
        F.format_string("ckpt/run_%d/rank-%d/info.log", "run", "rank").alias("path"),
        "line_no", line.alias("line"))


def v_ckpt_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder for each save: a common file (orders) and shards (lineitem).
    Run 11 has lost some of its folders."""
    o = table(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 20).cast("int").alias("run"), F.col("o_orderkey").alias("k"), "o_totalprice")
    o = o.filter(~((F.col("run") == 11) & (F.col("k") % 5 == 0)))
    folder = F.format_string("ckpt/run_%d/iter_%07d/", "run", "k")
    shards = o.join(table(spark, sf_dir, "lineitem"), F.col("l_orderkey") == F.col("k")).select(
        F.concat(folder, F.format_string("shard_%d.distcp", "l_linenumber")).alias("path"),
        (F.col("l_extendedprice") * 100).cast("long").alias("length"))
    return o.select(F.concat(folder, F.lit("common.pt")).alias("path"),
                    (F.col("o_totalprice") * 100).cast("long").alias("length")).unionAll(shards)


# ------------------------------------------------------------------ losses

def v_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run, pos, loss, loss_ref) strings; runs 3 and 5 differ on purpose."""
    s = v_steps(spark, sf_dir)
    txt = F.format_string("%.6E", F.col("value") / 10 + 1)
    ref = F.when((F.col("run") == 3) & (F.col("iter") == 5), F.format_string("%.6E", F.col("value") / 10 + 2)) \
        .otherwise(txt)
    mx = Window.partitionBy("run")
    s = s.withColumn("_n", F.max("iter").over(mx))
    run = s.select("run", F.col("iter").alias("pos"), txt.alias("loss"))
    reference = s.filter(~((F.col("run") == 5) & (F.col("iter") > F.col("_n") - 3))) \
        .select("run", F.col("iter").alias("pos"), ref.alias("loss"))
    return run, reference


def v_loss_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    skipped = F.col("l_returnflag") == "R"
    num = F.when(skipped & (F.col("l_suppkey") % 97 == 0), F.lit(float("nan"))) \
        .otherwise(F.col("l_extendedprice") / 1000)
    return li.select(
        (F.col("l_suppkey") % 10).cast("int").alias("run"),
        (F.col("l_orderkey") % 300 + 1).cast("int").alias("iter"),
        F.when(F.col("l_linenumber") % 2 == 1, "lm loss").otherwise("mtp loss").alias("key"),
        num.alias("num"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_quantity")).alias("den"),
        skipped.alias("skipped"))


# ------------------------------------------------------------------ memory

def v_rank_memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy((F.col("l_suppkey") % 5).cast("int").alias("run"),
                       (F.col("l_orderkey") % 50).cast("int").alias("iter"),
                       (F.col("l_linenumber") - 1).cast("int").alias("rank"))
            .agg(F.max((F.col("l_extendedprice") * 1e6).cast("long")).alias("used"))
            .withColumn("total", F.lit(192 * (1 << 30)).cast("long"))
            .withColumn("sampled", F.col("iter") % 5 == 0))


# ------------------------------------------------------------------ fleet

def v_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    level = (F.when(F.col("event_type") == "error", "fail").when(F.col("event_type") == "signup", "warn")
             .otherwise("info"))
    w = Window.partitionBy(F.col("user_id") % 128).orderBy("ts", "event_id")
    return ev.select(
        F.concat(F.lit("node"), (F.col("user_id") % 16).cast("string")).alias("host"),
        (F.col("user_id") % 128).cast("int").alias("rank"),
        (F.row_number().over(w) - 1).cast("int").alias("pos"),
        level.alias("level"), F.col("event_type").alias("message"), F.col("props").alias("details"))


def v_network_env(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    nic_sets = F.array(F.array(F.lit("lo"), F.lit("eth0"), F.lit("ib0")),
                       F.array(F.lit("lo"), F.lit("docker0"), F.lit("eth0")),
                       F.array(F.lit("lo"), F.lit("veth12ab")),
                       F.array(F.lit("lo"), F.lit("eth0"), F.lit("eth1"), F.lit("ib0")))
    ifn = F.array(F.lit("eth0"), F.lit("docker0"), F.lit(""), F.lit("ib0"), F.lit("veth12ab"))
    return c.select(
        F.concat(F.lit("node"), (k % 64).cast("string")).alias("host"),
        (k % 8).cast("int").alias("rank"),
        F.element_at(nic_sets, (k % 4 + 1).cast("int")).alias("nics"),
        F.element_at(ifn, (k % 5 + 1).cast("int")).alias("ifname"),
        F.element_at(ifn, ((k / 3).cast("long") % 5 + 1).cast("int")).alias("gloo_ifname"),
        F.when(k % 6 == 0, F.lit("eth1")).otherwise(F.lit("eth0")).alias("route_dev"),
        F.when(k % 7 == 0, F.lit("")).otherwise(F.lit("mlx5_0")).alias("hca"),
        F.when(k % 11 == 0, F.lit("2")).when(k % 2 == 0, F.lit("0")).otherwise(F.lit("1")).alias("ib_disable"),
        F.when(k % 5 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.lit("mlx5_0"), F.lit("mlx5_1"))).alias("ib_devices"),
        F.format_string("10.0.%d.%d", (k % 64).cast("int"), (k % 8).cast("int")).alias("route_src_ip"),
        F.when(k % 3 == 0, F.lit("PHB")).alias("gdr_level"), F.when(k % 4 == 1, F.lit("INFO")).alias("debug"))


def v_gpu_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(host, rank, pos, level, message, details) of GPU checks, one record (host, rank) for each
    customer; some records lack details, repeat a message or hold values that don't read as numbers."""
    c = table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "abs(c_acctbal) as a")
    device = "'name', if(k % 10 = 0, '', 'MI300X'), 'arch', if(k % 4 = 0, '', 'gfx942')"
    found = [  # condition, level, message, details
        ("true", "info", "GPU enumeration",
         "if(k % 5 = 0, '{}', to_json(named_struct('device_count', if(k % 7 = 0, 0, 8), 'amdgpu_version', if(k % 3 = 0, '', concat('6.', k % 4)), 'rocm_version', concat('7.0.', k % 2))))"),
        ("k % 11 = 0", "info", "GPU enumeration", "'{\"device_count\":99,\"amdgpu_version\":\"later\",\"rocm_version\":\"later\"}'"),
        ("true", "info", "GPU identity",
         f"if(k % 9 = 0, '{{\"devices\":[]}}', concat('{{\"devices\":[\"odd\",', to_json(named_struct({device}, 'total_memory_gb', 190.5D + k % 3, 'free_memory_gb', a / 64)), "
         "',{\"name\":\"MI325X\",\"total_memory_gb\":\"256\",\"free_memory_gb\":\"n/a\"}]}'))"),
        ("k % 90 = 0", "warn", "GPU occupied by other processes (amd-smi)", "'{\"processes\":[{\"pid\":1}]}'"),
        ("true", "info", "GPU occupancy (amd-smi)", "'{\"processes\":[]}'"),
        ("true", "info", "GPU↔NUMA mapping", "if(k % 4 = 0, '{\"imbalance\":null}', to_json(named_struct('imbalance', k % 6 = 1)))"),
        ("k % 32 = 1", "warn", "Topology indicates PCIe paths; XGMI may be absent", "'[]'"),
        ("k % 16 < 4", "warn", "NCCL_IB_HCA not set (may fall back to socket)", "if(k % 48 = 2, '{\"NCCL_IB_HCA\":\"mlx5_0\"}', '{\"NCCL_IB_HCA\":\"\"}')"),
        ("k % 13 <> 0", "info", "Single-GPU GEMM sanity", "to_json(named_struct('m', if(k % 2 = 0, 0, 4096), 'n', 4096, 'k', 8192, 'tflops', a / 8, 'ms', a / 1024))"),
        ("true", "info", "Memory alloc/free sanity", "to_json(named_struct('bytes_approx', k * 1024))"),
        ("k % 160 = 5", "fail", "GPU missing", "null"),
    ]
    rows = [F.when(F.expr(when), F.struct(F.lit(i).alias("pos"), F.lit(level).alias("level"), F.lit(message).alias("message"), F.expr(details).cast("string").alias("details")))
            for i, (when, level, message, details) in enumerate(found)]
    return c.select(F.concat(F.lit("node"), F.col("k") % 16).alias("host"), F.expr("cast(k div 16 as int)").alias("rank"),
                    F.explode(F.filter(F.array(*rows), lambda r: r.isNotNull())).alias("f")).select("host", "rank", "f.*")


# ------------------------------------------------------------------ pipeline

SERIES = ["fwd", "bwd", "wgrad"]


def v_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    series = F.element_at(F.array(*[F.lit(s) for s in SERIES]), (F.col("l_partkey") % 3 + 1).cast("int"))
    base = li.select(*LINEITEM_ORDER,
                     F.col("l_returnflag").alias("task"), (F.col("l_suppkey") % 5).cast("int").alias("iter"),
                     (F.col("l_linenumber") - 1).cast("int").alias("pp_rank"), series.alias("series"),
                     (F.col("l_orderkey") % 1000).cast("double").alias("start_ms"),
                     F.col("l_quantity").alias("dur"))
    w = Window.partitionBy("task", "iter", "pp_rank", "series").orderBy(*LINEITEM_ORDER)
    ev = base.select("task", "iter", "pp_rank", "series", (F.row_number().over(w) - 1).cast("int").alias("ord"),
                     "start_ms", (F.col("start_ms") + F.col("dur")).alias("end_ms"),
                     (F.col("l_partkey") % 4).cast("int").alias("minibatch"), F.lit(0).alias("chunk"))
    tot = Window.partitionBy("task", "iter", "pp_rank")
    return ev.withColumn("total", F.max("end_ms").over(tot)) \
        .withColumn("memory", (F.col("pp_rank") * 1.5 + F.col("iter")).cast("double"))
