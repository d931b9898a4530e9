"""Listings and dumps read from files, and the small forms of reports."""

import os

from stepfold.operators import catalog as K
from stepfold.operators import checkpoint as CK
from stepfold.operators import collectives as CO
from stepfold.operators import trainlog as T
from stepfold.sinks import reports as R
from stepfold.sources import files as S


def test_checkpoint_folders_by_size(spark, tmp_path):
    for run, it, name, size in [(1, 10, "common.pt", 5), (1, 10, "a/shard_0.distcp", 7), (1, 20, "common.pt", 0), (2, 10, "common.pt", 9), (2, 0, "note", 1)]:
        f = tmp_path / f"run_{run}" / (f"iter_{it:07d}" if it else "other") / name
        os.makedirs(f.parent, exist_ok=True)
        f.write_bytes(b"x" * size)
    sizes = S.read_file_sizes(spark, str(tmp_path))
    assert sizes.columns == ["path", "length"] and sizes.count() == 4  # without the empty one
    assert sorted(map(tuple, CK.checkpoint_sizes(sizes).collect())) == [(1, 10, 12), (2, 10, 9)]


def test_gemm_dump_tree(spark, tmp_path):
    line = "hipblaslt-bench --api_method c -m 64 -n 32 -k 16 --lda 64 --ldb 16 --ldc 64 --ldd 64 --transA N --transB T --batch_count 2 --a_type f16_r --b_type f16_r"
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text(f"  {line}\n{line}\n")
    (tmp_path / "y.log").write_text(f"{line}\n{line.replace('-m 64', '-m 65')}\n")
    lines = S.read_gemm_dump_files(spark, str(tmp_path))
    assert lines.count() == 4
    found = sorted(tuple(r) for r in K.gemm_shape_census(lines).select("m", "n", "k", "batch_count", "n_lines").collect())
    assert found == [(64, 32, 16, 2, 3), (65, 32, 16, 2, 1)]


def test_display_rounding(spark):
    df = spark.createDataFrame([("p", 1.2349, 0.00049, 10.25, None)], "path string, tflops_gpu double, step_time_s double, tokens_gpu double, mem_usage double")
    assert tuple(R.present_daily_metrics(df).first()) == ("p", 1.23, 0.0, 10.3, None)


def test_arguments_as_map(spark):
    df = spark.createDataFrame([("a", "x", "1"), ("a", "y", None), ("b", "x", "2")], "path string, key string, value string")
    assert {r["path"]: r["arguments"] for r in T.arguments_map(df).collect()} == {"a": {"x": "1", "y": None}, "b": {"x": "2"}}


def test_trace_counts(spark):
    df = spark.createDataFrame([("AllReduce", 7, 10), ("AllReduce", 7, 5), ("AllReduce", 9, 1), ("Send", 7, None)], "op string, datatype int, count long")
    assert sorted(map(tuple, CO.collective_trace_counts(df).collect()), key=str) == [("AllReduce", 7, 2, 15), ("AllReduce", 9, 1, 1), ("Send", 7, 1, None)]
