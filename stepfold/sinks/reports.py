"""Report sinks (SNK1-SNK4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stepfold.operators.corpus import document_sizes, merge_shards


def _by_extension(path: str) -> tuple[str, str | None]:
    """Format and compression that a path's extension names; Markdown if it names none."""
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    packed = name.endswith(".gz")
    end = name.removesuffix(".gz").rsplit(".", 1)[-1]
    return (end if end in ("csv", "tsv", "jsonl", "json") else "md"), "gzip" if packed else None


def write_report(df: DataFrame, path: str, fmt: str | None = None, append: bool = False, compression: str | None = None,
                 order: Sequence[str] = (), preamble: str | None = None):
    """SNK1: table to csv / tsv / jsonl, with ``.gz`` compressed, by the path's extension unless ``fmt``
    names the format; any other extension is Markdown, with a preamble if given. Header once for each file.
    Distributed write (one file per partition), but Markdown, which is ``to_markdown``'s bounded text.
    SRT1: with ``order`` the rows are sorted over all files, in file order."""
    found, packed = _by_extension(path)
    fmt, compression = fmt or found, compression or packed
    mode = "append" if append else "overwrite"
    if fmt == "md":
        text = to_markdown(df, preamble=preamble, order=order).removesuffix("\n")
        df = df.sparkSession.createDataFrame([(text,)], "value string").coalesce(1)
    elif order:
        df = df.orderBy(*order)
    w = df.write.mode(mode)
    if compression:
        w = w.option("compression", compression)
    if fmt in ("csv", "tsv"):
        w.option("header", "true").option("sep", "," if fmt == "csv" else "\t").csv(path)
    elif fmt in ("jsonl", "json"):
        w.json(path)
    elif fmt == "md":
        w.text(path)
    else:
        raise ValueError(f"unsupported format {fmt}")


def to_markdown(df: DataFrame, max_rows: int = 1000, preamble: str | None = None, order: Sequence[str] = ()) -> str:
    """SNK1 Markdown: rendering of an already aggregated frame on the driver, sorted
    by ``order`` (SRT1). A frame over ``max_rows`` is refused, never cut; ``write_report`` writes those."""
    df = df.orderBy(*order) if order else df
    cols = df.columns
    lines = [preamble, ""] if preamble else []
    lines.append("| " + " | ".join(cols) + " |")
    lines.append("|" + "|".join("---" for _ in cols) + "|")
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"report has more than {max_rows} rows; use write_report")
    for r in rows:
        lines.append("| " + " | ".join("" if v is None else str(v) for v in r) + " |")
    return "\n".join(lines) + "\n"


# Preferred leading columns of the daily report.
DAILY_FIRST = ["date", "GPU", "Framework", "Model", "TFLOP/s/GPU", "Step Time (s)", "Tokens/s/GPU", "Mem Usage"]


def daily_report_frame(frames: Sequence[DataFrame]) -> DataFrame:
    """SNK2: union of columns, the eight preferred columns first, the rest
    alphabetical, missing values as empty strings (only here)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    rest = sorted(c for c in out.columns if c not in DAILY_FIRST)
    cols = [c for c in DAILY_FIRST if c in out.columns] + rest
    return out.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in cols])


def present_daily_metrics(df: DataFrame) -> DataFrame:
    """Display rounding of the daily report: TFLOP/s 2, step time 3, tokens 1, memory 2."""
    r = {"tflops_gpu": 2, "step_time_s": 3, "tokens_gpu": 1, "mem_usage": 2}
    return df.select(*[F.round(c, r[c]).alias(c) if c in r else F.col(c) for c in df.columns])


def write_token_corpus(encoded: DataFrame, path: str, level: str = "document"):
    """SNK3: encoded documents as Parquet partitioned by key, level and shard."""
    write_token_corpora({level: encoded}, path)


def write_token_corpora(levels: dict[str, DataFrame], path: str):
    """SNK3: the encoded documents of all levels (document, sentence) in one write,
    as Parquet partitioned by key, level and shard. The levels have the same columns."""
    frames = [df.withColumn("level", F.lit(level)) for level, df in levels.items()]
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    out.write.mode("overwrite").partitionBy("key", "level", "shard").parquet(path)


def read_token_corpus(spark: SparkSession, path: str, key: str, level: str, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The corpus of a key and level with its shards merged in order: every document with its
    place in the corpus (doc_index) and its first sentence and token there. Only that partition is read."""
    docs = spark.read.parquet(path).where((F.col("key") == key) & (F.col("level") == level)).drop("key", "level")
    places = merge_shards(document_sizes(docs, ("shard", *order)), "shard", order).drop("n_sentences", "n_tokens")
    return docs.join(places, ["shard", *order])


def write_merged_trace(events: DataFrame, path: str):
    """SNK4: one merged trace as a JSON-lines event table (scales with the events). Events may be
    typed columns or, in a column ``event``, VARIANT objects, which are written as they were read."""
    if dict(events.dtypes).get("event") == "variant":
        events.where("event is not null").select(F.to_json("event")).write.mode("overwrite").text(path)
    else:
        events.write.mode("overwrite").json(path)
