"""Reports take their format from the path's extension."""

import gzip
import os

import pytest

from stepfold.sinks import reports as R


def parts(path):
    return [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part-")]


def test_formats_by_extension(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a,\tx")], "n int, s string").coalesce(1)
    at = lambda name: str(tmp_path / name)
    for name, want in (("r.csv", 'n,s\n1,"a,\tx"\n2,b\n'), ("r.tsv", 'n\ts\n1\t"a,\tx"\n2\tb\n'), ("r.jsonl", '{"n":1,"s":"a,\\tx"}\n{"n":2,"s":"b"}\n')):
        R.write_report(df, at(name), order=["n"])
        assert "".join(open(f).read() for f in parts(at(name))) == want
        R.write_report(df, at(name + ".gz"), order=["n"])
        assert "".join(gzip.open(f, "rt").read() for f in parts(at(name + ".gz"))) == want
    for name in ("r.md", "r.out", "report"):
        R.write_report(df, at(name), order=["n"], preamble="# Title")
        assert open(parts(at(name))[0]).read() == "# Title\n\n| n | s |\n|---|---|\n| 1 | a,\tx |\n| 2 | b |\n"
    R.write_report(df, at("r.md"), append=True)
    assert len(parts(at("r.md"))) == 2
    with pytest.raises(ValueError, match="unsupported"):
        R.write_report(df, at("x"), "xlsx")
