"""Manifests with line breaks inside fields, read by several tasks."""

import csv
import os
import random

import pytest
from pyspark.sql import functions as F

from ratelens.sources.manifest import read_manifest, read_manifest_raw
from test_rateshop import HEADER, manifest_row

FIELDS = ["", "plain", "two\nlines", 'say ""hi""', 'quoted "word"', "a,b", "\n\nblank lines\n", " x ", "é\n日本"]


def rows_of(rng, n):
    out = []
    for i in range(1, n + 1):
        row = manifest_row(i, rng.choice(FIELDS) + f" {i}", city=rng.choice(FIELDS))
        out.append(row[:3] if rng.random() < 0.05 else row)
    return out


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b",
            "spark.sql.files.minPartitionNum": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_same_rows_and_ids_as_one_task(spark, tmp_dir, small_splits, end):
    rng = random.Random(len(end))
    folder = f"{tmp_dir}/m{len(end)}"
    os.makedirs(folder + "/b")
    files = {"hotels.csv": rows_of(rng, 150), "b/more.csv": rows_of(rng, 20), "none.csv": []}
    for name, rows in files.items():
        with open(f"{folder}/{name}", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator=end)
            w.writerow(HEADER)
            for i, r in enumerate(rows):
                w.writerow(r)
                if i % 9 == 0:
                    f.write(end)
    path = folder + "/hotels.csv"
    raw = read_manifest_raw(spark, path)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 5  # several tasks share the file
    one = read_manifest_raw(spark, path, multi_line="whole")
    assert set(raw.columns) == set(one.columns)
    one = one.select(raw.columns)

    def told(df):
        return sorted(map(repr, df.drop("source_file").collect()))
    assert told(raw) == told(one)
    got = {r.request_id: r for r in read_manifest(spark, path).collect()}
    assert set(got) == {f"hotels.csv:{i}" for i in range(1, 151)}
    for i, row in enumerate(files["hotels.csv"], 1):
        r = got[f"hotels.csv:{i}"]
        assert r.malformed == (len(row) < 19)
        if not r.malformed:
            assert (r.hotel, r.city or "") == (row[1], row[4])
    nested = read_manifest(spark, folder + "/*").select("request_id").collect()
    assert {r.request_id for r in nested} >= {"hotels.csv:1", "hotels.csv:150"}
    assert read_manifest(spark, folder + "/none.csv").count() == 0
    assert read_manifest(spark, path).filter("malformed").count() == sum(len(r) < 19 for r in files["hotels.csv"])


def test_no_task_holds_a_file(spark, tmp_dir, small_splits):
    from test_rateshop import write_manifest
    path = write_manifest(tmp_dir + "/big", [manifest_row(i, "H\n" + "x" * 30) for i in range(300)])
    parts = read_manifest_raw(spark, path).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 300 and max(r["count"] for r in parts) < 300
