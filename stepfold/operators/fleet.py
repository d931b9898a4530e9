"""Fleet health: per-rank findings -> rank, host and fleet status (AGG14-18, SET1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _status(n_fail: Column, n_warn: Column) -> Column:
    return F.when(n_fail > 0, "FAIL").when(n_warn > 0, "WARN").otherwise("OK")


def fleet_status(findings: DataFrame) -> DataFrame:
    """AGG14: counts per level and status FAIL > WARN > OK for every rank, every
    host and the fleet in one plan (ROLLUP(host, rank)); exit code 2 on fail."""
    lv = F.col("level")
    agg = findings.rollup("host", "rank").agg(
        F.count_if(lv == "info").alias("n_info"), F.count_if(lv == "warn").alias("n_warn"),
        F.count_if(lv == "fail").alias("n_fail"), F.grouping_id().alias("_g"))
    return agg.select(
        F.when(F.col("_g") == 3, "fleet").when(F.col("_g") == 1, "host").otherwise("rank").alias("scope"),
        "host", "rank", "n_info", "n_warn", "n_fail",
        _status(F.col("n_fail"), F.col("n_warn")).alias("status"),
        F.when(F.col("n_fail") > 0, 2).otherwise(0).alias("exit_code"))


def host_summary(findings: DataFrame, messages: Sequence[str]) -> DataFrame:
    """AGG15: per host the sorted distinct ranks, for each known message the
    first non-empty details in record order (rank, pos), and the status."""
    d = F.col("details")
    nonempty = d.isNotNull() & (d != "") & (d != "{}")
    firsts = [F.min_by(d, F.when((F.col("message") == m) & nonempty, F.struct("rank", "pos"))).alias(
        "details_" + m) for m in messages]
    return findings.groupBy("host").agg(
        F.array_join(F.sort_array(F.collect_set("rank")), ",").alias("ranks"),
        *firsts,
        _status(F.count_if(F.col("level") == "fail"), F.count_if(F.col("level") == "warn")).alias("status"))


def gpu_host_summary(findings: DataFrame, metric_path: str = "$.k") -> DataFrame:
    """AGG16: numeric details read from the VARIANT column: min/max/avg, an
    'occupied' flag, distinct warning messages sorted and joined, status."""
    v = F.try_variant_get(F.try_parse_json("details"), metric_path, "double")
    warn = F.when(F.col("level") == "warn", F.col("message"))
    return findings.select("host", "level", "message", v.alias("metric")).groupBy("host").agg(
        F.min("metric").alias("metric_min"), F.max("metric").alias("metric_max"),
        F.avg("metric").alias("metric_avg"), F.bool_or(F.col("metric") > 90).alias("occupied"),
        F.array_join(F.sort_array(F.collect_set(warn)), "; ").alias("warnings"),
        _status(F.count_if(F.col("level") == "fail"), F.count_if(F.col("level") == "warn")).alias("status"))


# The messages whose details a GPU report reads.
GPU_COUNT, GPU_DEVICES, GPU_NUMA = "GPU enumeration", "GPU identity", "GPU↔NUMA mapping"
GPU_GEMM, GPU_ALLOC, GPU_PCIE = "Single-GPU GEMM sanity", "Memory alloc/free sanity", "Topology indicates PCIe paths; XGMI may be absent"
GPU_BUSY = ("GPU occupied by other processes (amd-smi)", "GPU occupancy (amd-smi)")
HCA = "NCCL_IB_HCA"


def _is_object(v: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))


def gpu_host_report(findings: DataFrame) -> DataFrame:
    """AGG16: what the GPUs of each host are and do, read from the details (JSON) of known messages.

    A rank's record speaks by its first finding of a message, details that are no
    object say nothing, and ranks speak in order: the first version, name, count and shape that isn't
    empty holds, memory and GEMM figures are taken over all devices and ranks. A value that doesn't read as its type counts as absent.
    """
    read = [GPU_COUNT, GPU_DEVICES, GPU_NUMA, GPU_GEMM, GPU_ALLOC, *GPU_BUSY]
    # first finding of a message in a rank's record; records are dealt out first, as the texts of a whole input split would be sorted in one task
    firsts = (findings.where(F.col("message").isin(*read)).repartition("host", "rank").groupBy("host", "rank", "message")
              .agg(F.min_by("details", "pos").alias("details")).withColumn("d", F.try_parse_json("details")))
    firsts = firsts.withColumn("d", F.when(_is_object(F.col("d")), F.col("d")))

    def said(message: str, path: str, kind: str) -> Column:
        return F.when(F.col("message") == message, F.try_variant_get("d", f"$.{path}", kind))

    def text(message: str, path: str) -> Column:
        value = said(message, path, "string")
        return F.when(value != "", value)

    def first(value: Column, by: Column | None = None) -> Column:
        return F.min_by(value, F.when(value.isNotNull(), F.col("rank") if by is None else by))

    devices = F.filter(said(GPU_DEVICES, "devices", "array<variant>"), _is_object)

    def of_devices(path: str) -> Column:
        return F.filter(F.transform(devices, lambda x: F.try_variant_get(x, f"$.{path}", "double")), lambda x: x.isNotNull())

    one = F.try_element_at(devices, F.lit(1))
    name = F.coalesce(F.try_variant_get(one, "$.name", "string"), F.lit(""))
    arch = F.try_variant_get(one, "$.arch", "string")
    kind = F.when(F.coalesce(arch, F.lit("")) != "", F.concat(name, F.lit("/"), arch)).otherwise(name)
    count = F.coalesce(said(GPU_COUNT, "device_count", "int"), F.size(devices))
    shape = F.struct(*[said(GPU_GEMM, x, "int").alias(x) for x in "mnk"])
    whole = F.when((shape["m"] != 0) & (shape["n"] != 0) & (shape["k"] != 0), shape)
    busy = F.col("message").isin(*GPU_BUSY) & (F.size(F.try_variant_get("d", "$.processes", "array<variant>")) > 0)
    tflops, ms = said(GPU_GEMM, "tflops", "double"), said(GPU_GEMM, "ms", "double")
    alloc = said(GPU_ALLOC, "bytes_approx", "long")
    facts = firsts.groupBy("host").agg(
        first(F.when((kind != "") & (F.size(devices) > 0), kind)).alias("gpu_type_arch"),
        F.coalesce(first(F.when(count > 0, count), F.struct("rank", F.col("message") != GPU_COUNT)), F.lit(0)).alias("gpu_count"),
        F.min(F.array_min(of_devices("total_memory_gb"))).alias("total_memory_gb_min"), F.max(F.array_max(of_devices("total_memory_gb"))).alias("total_memory_gb_max"),
        F.min(F.array_min(of_devices("free_memory_gb"))).alias("min_free_gb"),
        F.coalesce(F.bool_or(busy), F.lit(False)).alias("occupied"),
        first(text(GPU_COUNT, "amdgpu_version")).alias("amdgpu_version"), first(text(GPU_COUNT, "rocm_version")).alias("rocm_version"),
        first(said(GPU_NUMA, "imbalance", "boolean")).alias("numa_imbalance"), first(whole).alias("shape"),
        F.min(tflops).alias("tflops_min"), F.max(tflops).alias("tflops_max"), F.avg(tflops).alias("tflops_avg"),
        F.min(ms).alias("ms_min"), F.max(ms).alias("ms_max"), F.avg(ms).alias("ms_avg"),
        F.max_by(alloc, F.when(alloc.isNotNull(), F.col("rank"))).alias("alloc_bytes"))
    warning = F.when((F.col("level") == "warn") & (F.col("message") != ""), F.col("message"))
    hca = F.try_parse_json(F.when(F.contains("message", F.lit(HCA)), F.col("details")))
    hca_set = F.when(_is_object(hca), F.coalesce(F.try_variant_get(hca, f"$.{HCA}", "string"), F.lit("")) != "")
    hosts = findings.groupBy("host").agg(
        F.array_join(F.sort_array(F.collect_set("rank")), ",").alias("ranks"),
        F.max(F.when((F.col("level") == "warn") & (F.col("message") == GPU_PCIE), True)).alias("topo_pcie_hint"),
        F.max_by(hca_set, F.when(hca_set.isNotNull(), F.struct("rank", "pos"))).alias("nccl_ib_hca_set"),
        F.array_join(F.sort_array(F.collect_set(warning)), "; ").alias("warnings"),
        _status(F.count_if(F.col("level") == "fail"), F.count(warning)).alias("status"))
    out = hosts.join(facts, "host", "left")
    return out.select("host", "ranks", "status", "gpu_type_arch", F.coalesce("gpu_count", F.lit(0)).alias("gpu_count"),
                      "total_memory_gb_min", "total_memory_gb_max", "min_free_gb", F.coalesce("occupied", F.lit(False)).alias("occupied"),
                      "amdgpu_version", "rocm_version", "numa_imbalance", "topo_pcie_hint", "nccl_ib_hca_set", "warnings",
                      "shape.m", "shape.n", "shape.k", "tflops_min", "tflops_max", "tflops_avg", "ms_min", "ms_max", "ms_avg", "alloc_bytes")


def consistency_check(records: DataFrame, group: Sequence[str], attribute: str) -> DataFrame:
    """AGG17: groups whose attribute takes more than one value -> warn rows
    listing the distinct values."""
    return (records.groupBy(*group)
            .agg(F.count_distinct(attribute).alias("n_values"),
                 F.array_join(F.sort_array(F.collect_set(F.col(attribute).cast("string"))), ",").alias("values"))
            .filter(F.col("n_values") > 1)
            .withColumn("level", F.lit("warn"))
            .withColumn("message", F.lit(f"{attribute} differs"))
            .select(*group, "level", "message", "n_values", "values"))


def below_threshold(records: DataFrame, value: str, minimum: float, key: Sequence[str]) -> DataFrame:
    """AGG17 threshold rule: rows whose value is below a minimum."""
    return records.filter(F.col(value) < minimum).select(*key, value, F.lit("warn").alias("level"))


# Interface names the network check treats as suspect.
SUSPECT_IFNAMES = ("lo", "docker0")
SUSPECT_PREFIX = "veth"


def _suspect(c: Column) -> Column:
    return c.isin(*SUSPECT_IFNAMES) | c.startswith(SUSPECT_PREFIX)


def network_findings(env: DataFrame) -> DataFrame:
    """AGG18: rules over collected environment rows -> long findings (host, rank,
    level, message, details VARIANT). One row of env yields its findings via a
    filtered array of candidate findings (no per-rule pass over the data).

    An interface or adapter that is null or empty is unset. Columns that may be absent: route_ok (else: there is a
    route_dev), route_src_ip, gdr_level, debug."""
    def optional(name: str, kind: str) -> Column:
        return F.col(name) if name in env.columns else F.lit(None).cast(kind)

    nics, ifn, gloo, hca = F.col("nics"), F.col("ifname"), F.col("gloo_ifname"), F.col("hca")
    route = F.coalesce("route_dev", F.lit(""))
    route_ok = F.coalesce(optional("route_ok", "boolean"), route != "")
    unset = lambda c: F.coalesce(c, F.lit(""))
    has_ib = F.coalesce(F.size(F.col("ib_devices")) > 0, F.lit(False))
    expected_ib = (unset(hca) != "") | unset(ifn).startswith("ib") | F.coalesce(F.exists(nics, lambda x: x.startswith("ib")), F.lit(False))
    ib_disable = F.when(unset(F.col("ib_disable")) == "", "0").otherwise(F.col("ib_disable"))
    ib_status = F.when(ib_disable == "1", "disabled").when(~has_ib, "absent").otherwise("enabled")
    seen = lambda c: F.coalesce(F.array_contains(nics, c), F.lit(False))
    nccl_bad, gloo_bad = (unset(ifn) != "") & ~seen(ifn), (unset(gloo) != "") & ~seen(gloo)
    suspect = _suspect(unset(ifn)) | _suspect(unset(gloo))
    mismatch = route_ok & (route != "") & (((unset(ifn) != "") & (ifn != route)) | ((unset(gloo) != "") & (gloo != route)))
    names = [ifn.alias("NCCL_SOCKET_IFNAME"), gloo.alias("GLOO_SOCKET_IFNAME")]
    path = F.struct(F.struct(
        nics.alias("available_nics"), *names, (~nccl_bad & ~gloo_bad).alias("ifname_valid"), suspect.alias("ifname_suspect"),
        route_ok.alias("route_to_master_ok"), F.col("route_dev").alias("route_to_master_dev"),
        optional("route_src_ip", "string").alias("route_to_master_src_ip")).alias("nics"))
    fabric = F.struct(F.struct(
        expected_ib.alias("expected_ib"), has_ib.alias("has_ib"), F.col("ib_devices").alias("ib_devices"),
        ib_disable.alias("NCCL_IB_DISABLE"), ib_status.alias("ib_status")).alias("ib"))
    snapshot = F.struct(F.struct(
        ifn.alias("NCCL_SOCKET_IFNAME"), hca.alias(HCA), optional("gdr_level", "string").alias("NCCL_NET_GDR_LEVEL"),
        optional("debug", "string").alias("NCCL_DEBUG")).alias("rccl"))

    def f(cond: Column, level: str, msg: str, details: Column) -> Column:
        return F.when(cond, F.struct(F.lit(level).alias("level"), F.lit(msg).alias("message"),
                                     F.to_json(details, {"ignoreNullFields": "false"}).alias("details")))

    # Finding texts are looked up by their wording.
    always = F.lit(True)
    cands = F.array(
        f(nccl_bad, "warn", "NCCL_SOCKET_IFNAME does not match any visible NIC", F.struct(ifn.alias("ifname"), nics.alias("available_nics"))),
        f(gloo_bad, "warn", "GLOO_SOCKET_IFNAME does not match any visible NIC", F.struct(gloo.alias("ifname"), nics.alias("available_nics"))),
        f(suspect, "warn", "IFNAME looks suspect (lo/docker0/veth)", F.struct(*names)),
        f(always, "info", "NIC and network path", path),
        f(mismatch, "warn", "Socket IFNAME does not match route-to-master interface (may hang init_process_group)",
          F.struct(F.col("route_dev").alias("suggested_dev"), *names)),
        f(~ib_disable.isin("0", "1"), "warn", "NCCL_IB_DISABLE has an unexpected value", F.struct(ib_disable.alias("NCCL_IB_DISABLE"))),
        f(always, "info", "InfiniBand / RDMA", fabric),
        f(expected_ib & (ib_status != "enabled"), "warn", "IB expected but not enabled/available", fabric),
        f(always, "info", "RCCL/NCCL snapshot", snapshot),
        f(expected_ib & (unset(hca) == ""), "warn", "NCCL_IB_HCA not set (may fall back to socket)", F.struct(unset(hca).alias(HCA))))
    return env.select("host", "rank", F.explode(F.filter(cands, lambda x: x.isNotNull())).alias("f")) \
        .select("host", "rank", "f.level", "f.message", F.parse_json("f.details").alias("details"))


def network_checks(env: DataFrame) -> DataFrame:
    """AGG18 without the details: (host, rank, level, message)."""
    return network_findings(env).drop("details")


def gather_records(frames: Sequence[DataFrame], world: int) -> DataFrame:
    """SET1: per-rank record frames concatenated with the union of their
    columns (missing -> NULL), empty records dropped, world size injected."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    payload = [c for c in out.columns if c not in ("host", "rank")]
    return out.filter(F.greatest(*[F.col(c).isNotNull() for c in payload]) if len(payload) > 1
                      else F.col(payload[0]).isNotNull()).withColumn("world", F.lit(world))
