import datetime as dt

from ratelens.sources.manifest import read_manifest
from ratelens.streaming import latest_outcomes, stream_rate_shop

from golden import LAYOUTS, PAGES
from test_rateshop import manifest_row, write_manifest


def test_stream_over_capture_files(spark, tmp_dir):
    path = write_manifest(tmp_dir + "/m", [manifest_row(i, f"H{i}") for i in range(1, 4)])
    requests = read_manifest(spark, path)
    t0 = dt.datetime(2024, 1, 1)
    schema = ("request_id string, page_id bigint, url string, html string, "
              "captured_at timestamp_ntz")
    first = [("hotels.csv:1", 1, "u", PAGES["neither"], t0),
             ("hotels.csv:2", 2, "u", PAGES["offers"], t0)]
    second = [("hotels.csv:1", 3, "u", PAGES["blanks"], t0 + dt.timedelta(hours=1))]
    cap_dir = tmp_dir + "/captures"
    spark.createDataFrame(first, schema).write.parquet(cap_dir + "/a")
    spark.createDataFrame(second, schema).write.parquet(cap_dir + "/b")
    q = stream_rate_shop(spark, requests, cap_dir + "/*", LAYOUTS, tmp_dir + "/out",
                         "2024-05-01", checkpoint_location=tmp_dir + "/ckpt",
                         max_files_per_trigger=1)
    q.awaitTermination(180)
    assert q.exception() is None
    latest = {r.request_id: r.status for r in
              latest_outcomes(spark, tmp_dir + "/out", "2024-05-01").collect()}
    # request 1 was broken, then captured again with offers; request 3 never captured
    assert latest == {"hotels.csv:1": "offers", "hotels.csv:2": "offers"}
    offers = spark.read.parquet(tmp_dir + "/out/offers/run_date=2024-05-01")
    assert offers.filter("request_id = 'hotels.csv:2'").count() == 3


def test_replayed_epochs_overwrite_not_duplicate(spark, tmp_dir):
    path = write_manifest(tmp_dir + "/m", [manifest_row(1, "H1")])
    requests = read_manifest(spark, path)
    schema = ("request_id string, page_id bigint, url string, html string, "
              "captured_at timestamp_ntz")
    spark.createDataFrame([("hotels.csv:1", 1, "u", PAGES["offers"], dt.datetime(2024, 1, 1))],
                          schema).write.parquet(tmp_dir + "/captures/a")
    for attempt in ("first", "replay"):  # a lost checkpoint replays epoch 0
        q = stream_rate_shop(spark, requests, tmp_dir + "/captures/*", LAYOUTS,
                             tmp_dir + "/out", "2024-05-01",
                             checkpoint_location=f"{tmp_dir}/ckpt-{attempt}")
        q.awaitTermination(180)
        assert q.exception() is None
    offers = spark.read.parquet(tmp_dir + "/out/offers/run_date=2024-05-01")
    assert offers.count() == 3
