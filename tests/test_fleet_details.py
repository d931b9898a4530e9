"""Findings with VARIANT details, and GPU reports from odd ones."""

from pyspark.sql import functions as F

from stepfold.operators import fleet


def test_details_of_findings_are_variants(spark):
    env = spark.createDataFrame(
        [("a", 0, ["lo", "eth0"], "eth9", "", "eth0", None, "3", ["m0"]), ("b", 1, None, None, None, None, "m1", None, None)],
        "host string, rank int, nics array<string>, ifname string, gloo_ifname string, route_dev string, hca string, ib_disable string, ib_devices array<string>")
    found = fleet.network_findings(env)
    assert dict(found.dtypes)["details"] == "variant"
    get = lambda path, kind: F.try_variant_get("details", path, kind)
    rows = {(r["host"], r["message"]): r for r in found.select(
        "host", "message", "level", get("$.ifname", "string").alias("ifname"), get("$.available_nics", "array<string>").alias("nics"), get("$.nics.ifname_valid", "boolean").alias("valid"),
        get("$.nics.route_to_master_ok", "boolean").alias("ok"), get("$.suggested_dev", "string").alias("dev"), get("$.NCCL_IB_DISABLE", "string").alias("disable"),
        get("$.ib.ib_status", "string").alias("status"), get("$.ib.ib_devices", "array<string>").alias("devices"), get("$.rccl.NCCL_IB_HCA", "string").alias("hca")).collect()}
    bad = rows["a", "NCCL_SOCKET_IFNAME does not match any visible NIC"]
    assert (bad["level"], bad["ifname"], bad["nics"]) == ("warn", "eth9", ["lo", "eth0"])
    assert (rows["a", "NIC and network path"]["valid"], rows["a", "NIC and network path"]["ok"]) == (False, True)
    assert rows["a", "Socket IFNAME does not match route-to-master interface (may hang init_process_group)"]["dev"] == "eth0"
    assert rows["a", "NCCL_IB_DISABLE has an unexpected value"]["disable"] == "3"
    assert (rows["a", "InfiniBand / RDMA"]["status"], rows["a", "InfiniBand / RDMA"]["devices"]) == ("enabled", ["m0"])
    assert sorted(m for h, m in rows if h == "b") == ["IB expected but not enabled/available", "InfiniBand / RDMA", "NIC and network path", "RCCL/NCCL snapshot"]
    assert (rows["b", "NIC and network path"]["valid"], rows["b", "InfiniBand / RDMA"]["status"], rows["b", "RCCL/NCCL snapshot"]["hca"]) == (True, "absent", "m1")


def report(spark, rows):
    df = spark.createDataFrame(rows, "host string, rank int, pos int, level string, message string, details string")
    return {r["host"]: r.asDict() for r in fleet.gpu_host_report(df).collect()}


def test_gpu_report_of_odd_details(spark):
    gemm = '{"m": 8, "n": 8, "k": 8, "tflops": %s, "ms": "%s"}'
    got = report(spark, [
        ("a", 1, 0, "info", fleet.GPU_COUNT, '{"device_count": 4, "amdgpu_version": "late"}'), ("a", 0, 0, "info", fleet.GPU_COUNT, '{"device_count": 0, "amdgpu_version": ""}'),
        ("a", 0, 1, "info", fleet.GPU_COUNT, '{"device_count": 7, "amdgpu_version": "second of its rank"}'),
        ("a", 0, 2, "info", fleet.GPU_DEVICES, '{"devices": [{"name": "X", "total_memory_gb": "12.5"}, {"total_memory_gb": 20, "free_memory_gb": 1}, 3, {"total_memory_gb": "?"}]}'),
        ("a", 0, 3, "info", fleet.GPU_GEMM, gemm % (10, 2)), ("a", 1, 3, "info", fleet.GPU_GEMM, gemm % ("null", "x")), ("a", 2, 3, "info", fleet.GPU_GEMM, gemm % (20.5, 3)),
        ("a", 1, 4, "info", fleet.GPU_BUSY[1], '{"processes": [1]}'), ("a", 1, 5, "warn", "b", None), ("a", 0, 5, "warn", "a", "not json"), ("a", 2, 5, "warn", "a", "{}"),
        ("b", 0, 0, "fail", "gone", None), ("b", 0, 1, "info", fleet.GPU_DEVICES, "[1]"), ("b", 0, 2, "info", fleet.GPU_COUNT, "{"),
        ("b", 3, 0, "info", "NCCL_IB_HCA seen", '{"NCCL_IB_HCA": "m"}'), ("b", 3, 1, "info", "NCCL_IB_HCA seen", '["m"]')])
    a, b = got["a"], got["b"]
    assert (a["ranks"], a["status"], a["gpu_type_arch"], a["gpu_count"], a["amdgpu_version"], a["warnings"], a["occupied"]) == ("0,1,2", "WARN", "X", 3, "late", "a; b", True)
    assert (a["total_memory_gb_min"], a["total_memory_gb_max"], a["min_free_gb"]) == (12.5, 20.0, 1.0)
    assert (a["tflops_min"], a["tflops_max"], a["tflops_avg"], a["ms_min"], a["ms_max"], a["m"]) == (10.0, 20.5, 15.25, 2.0, 3.0, 8)
    assert (b["ranks"], b["status"], b["gpu_count"], b["occupied"], b["nccl_ib_hca_set"], b["tflops_avg"]) == ("0,3", "FAIL", 0, False, True, None)
    assert report(spark, []) == {}
