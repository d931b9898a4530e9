"""File sources (SRC1, SRC5-SRC9, SRC11, SRC12): everything lands as a
DataFrame planned by Spark; nothing is read on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stepfold.operators.hlo import own_lines


def read_log_lines(spark: SparkSession, path: str, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """SRC1: log files as ordered lines (path, line_no, line), line_no from 0.

    Files are read in blocks, so a log of any size is split over tasks. A line
    is numbered inside its block, and blocks are shifted by the line counts of
    the blocks before them in the file.
    """
    r = spark.read.option("recursiveFileLookup", str(recursive).lower()).option("lineSep", "\n")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return number_lines(block_lines(r.text(path)))


def block_lines(text: DataFrame) -> DataFrame:
    """Lines of text files, each with its file and the first byte of the block that it was read in."""
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.col("value").alias("line"))


def number_lines(lines: DataFrame) -> DataFrame:
    """(path, line_no, line) of lines (path, _block, line) that were just read, whole files at a time."""
    lines = lines.withColumn("_at", F.monotonically_increasing_id())
    counts = lines.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("path", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy("path", "_block").orderBy("_at")) - 1
    return (lines.withColumn("_within", within).join(base, ["path", "_block"])
            .select("path", (F.col("_base") + F.col("_within")).cast("long").alias("line_no"), "line"))


def read_corpus_jsonl(spark: SparkSession, paths: str | Sequence[str], keys: Sequence[str] = ("text",),
                      id_col: str | None = None) -> DataFrame:
    """SRC5: JSONL (plain or gzip) with an explicit schema of the chosen keys
    (column pruning); a value may be a string or a list of sentences.
    Output (path, doc_id, key, text, sentences)."""
    fields = [f"`{k}` variant" for k in keys] + ([f"`{id_col}` string"] if id_col else [])
    df = spark.read.schema(", ".join(fields)).json(paths)
    df = df.withColumn("path", F.col("_metadata.file_path"))
    doc = F.col(id_col).cast("long") if id_col else F.xxhash64("path", F.monotonically_increasing_id())
    values = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys])
    long = df.select("path", doc.alias("doc_id"), F.explode(values).alias("z")).select("path", "doc_id", "z.*")
    # the JSON type of the value decides, never its first character
    is_list = F.coalesce(F.schema_of_variant("value").startswith("ARRAY"), F.lit(False))
    sents = F.try_variant_get("value", "$", "array<string>")
    raw = F.try_variant_get("value", "$", "string")
    return long.select("path", "doc_id", "key",
                       F.when(is_list, F.array_join(sents, " ")).otherwise(raw).alias("text"),
                       F.when(is_list, sents).otherwise(F.array(raw)).alias("sentences"))


def read_profiler_traces(spark: SparkSession, folder: str) -> DataFrame:
    """SRC7: every ``*.json`` trace of a folder; ``traceEvents`` defaults to []."""
    df = spark.read.option("multiLine", "true").option("pathGlobFilter", "*.json").json(folder)
    if "traceEvents" not in df.columns:
        df = df.withColumn("traceEvents", F.array())
    return df.select(F.col("_metadata.file_name").alias("file"),
                     F.explode_outer("traceEvents").alias("event"))


def read_trace_events(spark: SparkSession, folder: str) -> DataFrame:
    """SRC7 with events as they are: (file, event VARIANT), one row for each event of every ``*.json`` trace, so
    fields that have different types in different traces stay apart. A trace without events has one row with none."""
    df = spark.read.schema("traceEvents array<variant>").option("multiLine", "true").option("pathGlobFilter", "*.json").json(folder)
    return df.select(F.col("_metadata.file_name").alias("file"), F.explode_outer("traceEvents").alias("event"))


def read_file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """SRC9 listing: (path, length) of every file below root; the binaryFile
    source with only metadata columns selected never reads file contents. Spark lists no empty files."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
            .select("path", "length"))


def read_gemm_dump_files(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: a file or a whole tree of dumped command lines."""
    return spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("value").alias("line"))


def read_hlo_dumps(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """SRC11: dumps in HLO text, the lines of their computations as ``hlo.own_lines`` gives them; the dump is the file.
    Files are read in blocks, so a dump of any size is split over tasks."""
    return own_lines(read_log_lines(spark, path, glob=glob).withColumnRenamed("path", "dump"))


# The series of a pipeline dump.
SERIES = ("fwd", "bwd", "wgrad")


def read_pipeline_dump(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """SRC6: every dump folder below ``root``, which holds ``config.json`` and
    ``pp_rank_<r>.json`` (an object of iterations), as (config, events).

    Config: (task, pp_size, vp_size, num_mbs); older names ``vpp_size`` and
    ``micro_batches`` stand in where the newer ones are absent. Events: the table
    of ``operators.timeline``, one row for each start and end of a series;
    ``minibatch`` and ``chunk`` are null where a dump has none. The task is the folder.
    """
    task = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("task")
    def whole(names: str) -> DataFrame:
        return spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=names)

    config = whole("config.json").select(
        task, F.from_json("value", "pp_size int, vp_size int, vpp_size int, num_mbs int, micro_batches int").alias("c"))
    config = config.select("task", "c.pp_size", F.coalesce("c.vp_size", "c.vpp_size").alias("vp_size"),
                           F.coalesce("c.num_mbs", "c.micro_batches").alias("num_mbs"))
    parts = ", ".join(f"{s}_start array<double>, {s}_end array<double>, {s}_minibatch array<int>, {s}_chunk array<int>" for s in SERIES)
    dumps = whole("pp_rank_*.json").select(
        task, F.regexp_extract(F.col("_metadata.file_name"), r"pp_rank_(\d+)", 1).cast("int").alias("pp_rank"),
        F.explode(F.from_json("value", f"map<string, struct<total double, memory double, {parts}>>")).alias("iter", "d"))

    def rows(name: str):
        lists = [F.coalesce(f"d.{name}_{c}", F.array().cast(f"array<{t}>")) for c, t in
                 (("start", "double"), ("end", "double"), ("minibatch", "int"), ("chunk", "int"))]
        return F.transform(F.arrays_zip(*lists), lambda z, i: F.struct(
            F.lit(name).alias("series"), i.alias("ord"), z["0"].alias("start_ms"), z["1"].alias("end_ms"),
            z["2"].alias("minibatch"), z["3"].alias("chunk")))

    events = dumps.select("task", F.col("iter").cast("int").alias("iter"), "pp_rank", "d.total", "d.memory",
                          F.inline(F.flatten(F.array(*[rows(s) for s in SERIES]))))
    return config, events.filter("start_ms IS NOT NULL")


def read_shape_catalog(spark: SparkSession, path: str, models: Sequence[str] = (), skip_models: Sequence[str] = ()) -> DataFrame:
    """SRC12: attention shapes from a JSON list. ``models`` keeps those only
    (empty: all), ``skip_models`` drops some; shapes whose query and key lengths differ go."""
    shapes = spark.read.option("multiLine", "true").schema(
        "model string, seqlen_q long, seqlen_kv long, num_head_q int, num_head_kv int, "
        "head_dim_qk int, head_dim_v int, causal boolean").json(path)
    shapes = shapes.withColumn("model", F.coalesce("model", F.lit(""))).filter("seqlen_q = seqlen_kv")
    if models:
        shapes = shapes.filter(F.col("model").isin(*models))
    return shapes.filter(~F.col("model").isin(*skip_models)) if skip_models else shapes
