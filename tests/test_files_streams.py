"""Round trips of file sources, sinks and streams in fresh temporary folders."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from stepfold.operators import trainlog as T
from stepfold.sinks import reports as R
from stepfold.sources import files as S
from stepfold.streaming import logs as ST

LINE = ("[20240101 00:00:01][rank-7/8][INFO] iteration        3/      50 | consumed samples: 384 | "
        "elapsed time per iteration (ms): 6046.6 | throughput per GPU (TFLOP/s/GPU): 1255.4 | "
        "tokens per GPU (tokens/s/GPU): 1,234.5 | global batch size:   128 |")


def _write_logs(folder, n_files=2, n_iters=14):
    os.makedirs(folder, exist_ok=True)
    for f in range(n_files):
        with open(os.path.join(folder, f"run{f}.log"), "w") as fh:
            for i in range(1, n_iters + 1):
                fh.write(LINE.replace("        3/", f"{i:9d}/") + "\n")
                fh.write("noise line\n")


def test_golden_line_parse(spark):
    df = spark.createDataFrame([("a.log", 0, LINE)], "path string, line_no long, line string")
    r = T.parse_train_log(df).collect()[0]
    assert (r.iteration, r.train_iters, r.elapsed_ms, r.global_batch_size, r.throughput_tflops) == \
        (3, 50, 6046.6, 128, 1255.4)
    m = T.parse_megatron_steps(df).collect()[0]
    assert m.tokens_gpu == 1234.5


def test_read_log_lines_and_averages(spark):
    d = tempfile.mkdtemp(prefix="stepfold-logs-")
    _write_logs(d)
    lines = S.read_log_lines(spark, d)
    assert lines.count() == 2 * 28
    assert lines.filter(F.col("line_no") == 0).count() == 2
    avg = T.megatron_averages(T.parse_megatron_steps(lines)).collect()
    assert len(avg) == 2 and all(r.n_steps == 12 for r in avg)


def test_log_split_in_blocks_keeps_line_numbers(spark):
    d = tempfile.mkdtemp(prefix="stepfold-blocks-")
    with open(os.path.join(d, "big.log"), "w") as fh:
        fh.writelines(f"line {i} {'x' * (i % 37)}\n" for i in range(5000))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        lines = S.read_log_lines(spark, d)
        assert lines.select("line").rdd.getNumPartitions() >= 1
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.line_no, int(r.line.split()[1])) for r in rows) == [(i, i) for i in range(5000)]


def test_corpus_text_that_begins_with_a_bracket(spark):
    d = tempfile.mkdtemp(prefix="stepfold-jsonl-")
    with open(os.path.join(d, "c.jsonl"), "w") as fh:
        fh.write('{"text": "[Note] a document", "id": 1}\n{"text": ["One.", "Two."], "id": 2}\n{"id": 3}\n{"text": "[1, 2]", "id": 4}\n')
    rows = {r.doc_id: (r.text, r.sentences) for r in S.read_corpus_jsonl(spark, d, id_col="id").collect()}
    assert rows[1] == ("[Note] a document", ["[Note] a document"])
    assert rows[2] == ("One. Two.", ["One.", "Two."])
    assert rows[3][0] is None
    assert rows[4][0] == "[1, 2]"


def test_markdown_is_refused_not_cut(spark):
    with pytest.raises(ValueError):
        R.to_markdown(spark.range(1001).toDF("id"))
    assert len(R.to_markdown(spark.range(1000).toDF("id")).splitlines()) == 1002


def test_report_sinks_round_trip(spark):
    d = tempfile.mkdtemp(prefix="stepfold-sink-")
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, 2.5)], "id int, name string, v double")
    R.write_report(df, os.path.join(d, "r.csv"), "csv")
    back = spark.read.option("header", "true").csv(os.path.join(d, "r.csv"))
    assert back.count() == 2
    R.write_report(df, os.path.join(d, "r.jsonl"), "jsonl", compression="gzip")
    assert spark.read.json(os.path.join(d, "r.jsonl")).count() == 2
    md = R.to_markdown(df)
    assert md.splitlines()[0] == "| id | name | v |"
    rep = R.daily_report_frame([df.withColumnRenamed("name", "Model"), df.select("id")])
    assert rep.columns[0] == "Model" and rep.filter(F.col("Model") == "").count() == 3


def test_checkpoint_golden(spark):
    from stepfold.operators import checkpoint as CK
    rows = [(0, 0, "20240101 00:00:00", "saving checkpoint at iteration 20"),
            (0, 1, "20240101 00:12:38", "successfully saved checkpoint from iteration 20"),
            (0, 2, "20240101 01:00:00", "loading checkpoint from /x"),
            (0, 3, "20240101 01:02:54", "successfully loaded checkpoint from /x"),
            (0, 4, "20240101 00:00:00", "async_save ..... False")]
    ev = spark.createDataFrame(rows, "run int, line_no long, time string, msg string") \
        .withColumn("ts", F.to_timestamp_ntz("time", F.lit("yyyyMMdd HH:mm:ss")))
    sizes = spark.createDataFrame([(0, 20, 94338155448)], "run int, iteration long, folder_bytes long")
    r = CK.checkpoint_report(ev, sizes).collect()[0]
    assert r.save_total_s == 758 and r.load_s == 174
    assert abs(r.save_mbps - 118.69112916609228) < 1e-9
    assert abs(r.load_mbps - 517.0567580913676) < 1e-9


def test_stream_running_averages(spark):
    d = tempfile.mkdtemp(prefix="stepfold-stream-")
    src = os.path.join(d, "logs")
    _write_logs(src, n_files=1, n_iters=14)
    steps = ST.stream_train_log(spark, src)
    out = ST.stream_running_averages(steps)
    q = (out.writeStream.format("memory").queryName("run_avg").outputMode("append")
         .option("checkpointLocation", os.path.join(d, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    rows = spark.sql("select * from run_avg order by line_no").collect()
    assert len(rows) == 14
    assert rows[0].elapsed_ms_avg is None and rows[2].elapsed_ms_avg == 6046.6
    assert [r.line_no for r in rows] == list(range(0, 28, 2))


def test_pipeline_dump_with_old_and_new_names(spark):
    from stepfold.operators import timeline as TL
    d = tempfile.mkdtemp(prefix="stepfold-dump-")
    configs = {"new": {"pp_size": 2, "vp_size": 1, "num_mbs": 2}, "old": {"pp_size": 2, "vpp_size": 1, "micro_batches": 2}}
    for name, config in configs.items():
        os.makedirs(os.path.join(d, name))
        with open(os.path.join(d, name, "config.json"), "w") as fh:
            json.dump(config, fh, indent=1)
        for r in range(2):
            it = {"total": 20.0 + r, "memory": 3.5, "fwd_start": [0, 5], "fwd_end": [4, 9], "bwd_start": [10, 13], "bwd_end": [12.5, 15]}
            if name == "new":
                it |= {"wgrad_start": [16], "wgrad_end": [17], "fwd_minibatch": [0, 1], "fwd_chunk": [0, 0]}
            with open(os.path.join(d, name, f"pp_rank_{r}.json"), "w") as fh:
                json.dump({"1": it, "2": it}, fh)
    config, events = S.read_pipeline_dump(spark, d)
    assert sorted(map(tuple, config.collect())) == [("new", 2, 1, 2), ("old", 2, 1, 2)]
    assert events.count() == 2 * 2 * (4 + 5)
    one = events.filter("task = 'new' AND iter = 2 AND pp_rank = 1 AND series = 'fwd'").orderBy("ord").collect()
    assert [(r.start_ms, r.end_ms, r.minibatch, r.total) for r in one] == [(0.0, 4.0, 0, 21.0), (5.0, 9.0, 1, 21.0)]
    bubble = {(r.task, r.iter, r.pp_rank): r for r in TL.pipeline_bubble(events, 1, 2).collect()}
    assert len(bubble) == 8
    r = bubble["old", 1, 0]
    assert (r.iter_ms, r.f_ms, r.b_ms, r.w_ms) == (21.0, 8.0, 4.5, 0.0)


def test_shape_catalog(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="stepfold-shapes-"), "shapes.json")
    with open(path, "w") as fh:
        json.dump([{"model": m, "seqlen_q": q, "seqlen_kv": 64, "num_head_q": 8} for m, q in (("a", 64), ("b", 64), ("c", 32), ("d", 64))], fh)
    names = lambda **kw: sorted(r.model for r in S.read_shape_catalog(spark, path, **kw).collect())
    assert names() == ["a", "b", "d"]
    assert names(models=["a", "c", "d"], skip_models=["d"]) == ["a"]


def test_traces_read_merged_and_written(spark):
    d = tempfile.mkdtemp(prefix="stepfold-trace-")
    for i in range(2):
        with open(os.path.join(d, f"t{i}.json"), "w") as fh:
            json.dump({"traceEvents": [{"name": f"k{i}", "ts": j, "ph": "X"} for j in range(3)]}, fh, indent=1)
    events = S.read_profiler_traces(spark, d)
    assert sorted((r.file, r.event["name"], r.event["ts"]) for r in events.collect()) == [(f"t{i}.json", f"k{i}", j) for i in range(2) for j in range(3)]
    R.write_merged_trace(events.select("event.*"), os.path.join(d, "merged"))
    assert spark.read.json(os.path.join(d, "merged")).count() == 6


def test_token_corpus_and_sorted_report(spark):
    d = tempfile.mkdtemp(prefix="stepfold-corpus-")
    df = spark.createDataFrame([("text", s, i, [i, i + 1]) for i in range(6) for s in [i % 2]], "key string, shard int, doc_id long, tokens array<int>")
    R.write_token_corpus(df, os.path.join(d, "c"))
    back = spark.read.parquet(os.path.join(d, "c"))
    assert back.filter("level = 'document' AND shard = 1").count() == 3
    R.write_report(df.select("doc_id").repartition(4), os.path.join(d, "r"), "csv", order=["doc_id"])
    files = sorted(f for f in os.listdir(os.path.join(d, "r")) if f.startswith("part-"))
    got = [int(x) for f in files for x in open(os.path.join(d, "r", f)).read().split()[1:]]
    assert got == list(range(6))
    assert R.to_markdown(df.select("doc_id"), order=["doc_id"]).splitlines()[2:] == [f"| {i} |" for i in range(6)]
