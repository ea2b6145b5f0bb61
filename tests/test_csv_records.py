"""CSV by byte ranges against Python's csv module and a one-task read; committed files."""

import csv
import io
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidyline.sources import csv_records as R
from tidyline.sources import io as IO
from tidyline.sources.sink import write_committed

BITS = ["a", "b", "é", '"', "\n", ",", '""', " ", "\r\n", "x y", "\n\n"]


def random_rows(seed):
    r = random.Random(seed)
    return [["".join(r.choice(BITS) for _ in range(r.randint(0, 12))) for _ in range(3)] for _ in range(r.randint(1, 60))]


def write_csv(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL, encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as f:
        w = csv.writer(f, lineterminator=end, quoting=quoting)
        w.writerow(["x", "y", "z"])
        w.writerows(rows)


@pytest.mark.parametrize("seed, ranges", [(1, None), (2, 3), (3, 20), (4, 60)])
def test_records_do_not_depend_on_ranges(spark, tmp_path, seed, ranges):
    rows, p = random_rows(seed), str(tmp_path / "a.csv")
    write_csv(p, rows, "\r\n" if seed % 2 else "\n", csv.QUOTE_ALL if seed > 2 else csv.QUOTE_MINIMAL, "utf-8-sig" if seed == 3 else "utf-8")
    got = R.read_records(spark, p, ranges).collect()
    assert sorted(next(csv.reader(io.StringIO(r["record"], newline=""))) for r in got) == sorted([["x", "y", "z"], *rows])
    assert [r["record"].replace('"', "") for r in got if r["first"]] == ["x,y,z"]


def test_one_file_in_ranges_equals_one_task(spark, tmp_path):
    """A record longer than many ranges, several files, and Spark's own multiLine read."""
    long = "\n".join(f'line "{k}", more' for k in range(300))
    for k in range(3):
        write_csv(tmp_path / f"{k}.csv", [*random_rows(10 + k), ["q", long, "r"], *random_rows(20 + k)])
    schema = "x string, y string, z string"
    want = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path)).collect()
    got = IO.read_table(spark, str(tmp_path), schema, fmt="csv", ranges=100).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and any(r["y"] == long for r in got)


def test_quotes_in_unquoted_fields(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text('x,y,z\n5" pipe,b,"c\nd"\n"a"b,"e ""f""\n\ng",h"\n,,\n')
    got = {r["record"] for r in R.read_records(spark, str(p), 9).collect()}
    assert got == {"x,y,z", '5" pipe,b,"c\nd"', '"a"b,"e ""f""\n\ng",h"', ",,"}


def test_maps_of_lines_compose():
    """The states of a run of lines are those of a walk, from both states."""
    r = np.random.default_rng(1)
    for _ in range(200):
        effects = r.integers(0, 4, r.integers(1, 12)).astype(np.int8)
        for before in (0, 1):
            state, want = before, []
            for e in effects:
                state = {R.KEEP: state, R.CLOSE: 0, R.OPEN: 1, R.SWAP: 1 - state}[int(e)]
                want.append(state)
            assert R._after(effects, before).tolist() == want


def test_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    (tmp_path / "h.csv").write_text("x,y,z\n")
    assert IO.read_table(spark, str(tmp_path), "x string, y string, z string", fmt="csv").collect() == []


def files_of(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs)


def test_committed_files(spark, tmp_path):
    p = str(tmp_path / "out")
    rows = [(k, 'say "hi",\nthen go' if k % 3 else None, k % 2 if k != 5 else None) for k in range(40)] + [(99, "", 1)]
    df = spark.createDataFrame(rows, "id long, text string, is_noise int").repartition(4)
    write_committed(df, p, by="is_noise", bom=True)
    assert sorted(os.listdir(p)) == ["is_noise=0", "is_noise=1", "is_noise=__HIVE_DEFAULT_PARTITION__"]
    assert all(open(f, "rb").read(3) == b"\xef\xbb\xbf" for f in files_of(p))
    got = {(r["id"], r["text"], r["is_noise"]) for v in (0, 1) for r in
           IO.read_table(spark, f"{p}/is_noise={v}", "id long, text string", fmt="csv").withColumn("is_noise", F.lit(v)).collect()}
    assert got == {(a, b or None, c) for a, b, c in rows if c is not None}  # blanks are read as NULL
    # a failed write leaves the files as they were, and nothing beside them
    before = files_of(tmp_path)
    broken = df.withColumn("text", F.when(F.col("id") == 17, F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    with pytest.raises(Exception):
        write_committed(broken, p, by="is_noise")
    assert files_of(tmp_path) == before and os.listdir(tmp_path) == ["out"]
    # the folder may only be replaced when that is asked for
    with pytest.raises(Exception):
        write_committed(df, p, overwrite=False)
    assert files_of(tmp_path) == before and os.listdir(tmp_path) == ["out"]
    write_committed(df.filter("id < 3").drop("is_noise"), p)
    assert {r["id"] for r in IO.read_table(spark, p, "id long, text string", fmt="csv").collect()} == {0, 1, 2}
    write_committed(df.filter("id < 0").drop("is_noise"), p)
    assert [open(f).read() for f in files_of(p)] == ['"id","text"\n'] and os.listdir(tmp_path) == ["out"]
