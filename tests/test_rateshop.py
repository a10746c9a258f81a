import csv
import datetime as dt
import os

from pyspark.sql import functions as F

from ratelens.plans.rateshop import run_rate_shop
from ratelens.sources.manifest import read_manifest, sample_manifest
from ratelens.sources.sinks import read_csv, write_outputs

from golden import LAYOUTS, PAGES

HEADER = ["id", "name", "c2", "c3", "city", "c5", "c6", "c7", "c8", "c9", "checkin", "c11",
          "checkout", "c13", "nights", "base", "fees", "avg", "total"]


def manifest_row(i, name, city="Paris", ci="May 1, 2024", co="May 3, 2024", base="$1,234"):
    r = [str(i), name, "", "", city, "", "", "", "", "", ci, "", co, "", "2", base, "", "", ""]
    return r


def write_manifest(folder, rows, blank_after=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, "hotels.csv")
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f)
        w.writerow(HEADER)
        for n, r in enumerate(rows):
            w.writerow(r)
            if blank_after == n:
                f.write("\n")
    return path


def test_manifest_cases(spark, tmp_dir):
    rows = [manifest_row(1, 'Hotel, "Quoted"'), manifest_row(2, "Multi\nLine"),
            ["3", "Short", "x"], manifest_row(4, "Hôtel Größe") + ["extra"],
            manifest_row(1, 'Hotel, "Quoted"')]
    path = write_manifest(tmp_dir, rows, blank_after=1)
    df = read_manifest(spark, path).orderBy("row_in_file").collect()
    assert [r.request_id for r in df] == [f"hotels.csv:{i}" for i in range(1, 6)]
    assert df[0].hotel == 'Hotel, "Quoted"' and df[1].hotel == "Multi\nLine"
    # fields beyond the header are ignored: fields are read by position
    assert [r.malformed for r in df] == [False, False, True, False, False]
    assert str(df[0].listed_base_price_num) == "1234.00"
    assert sample_manifest(read_manifest(spark, path), 2).count() == 2


def test_header_only_manifest(spark, tmp_dir):
    path = write_manifest(tmp_dir, [])
    assert read_manifest(spark, path).count() == 0


def _captures(spark, ids_pages):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rid, i, f"https://x/{i}", PAGES[name], t0 + dt.timedelta(minutes=i))
            for i, (rid, name) in enumerate(ids_pages)]
    return spark.createDataFrame(
        rows, "request_id string, page_id bigint, url string, html string, "
              "captured_at timestamp_ntz")


def test_run_end_to_end(spark, tmp_dir):
    names = ["offers", "too_few_prices", "na_rule1", "contact_rule1", "listing", "neither",
             "no_agents", "blanks"]
    rows = [manifest_row(i + 1, f"Hôtel {n}") for i, n in enumerate(names)]
    rows.append(manifest_row(99, "No capture"))
    rows.append(["100", "Short"])
    path = write_manifest(tmp_dir + "/m", rows)
    requests = read_manifest(spark, path)
    ids = [f"hotels.csv:{i + 1}" for i in range(len(names))]
    # an older, broken capture of the first request is superseded by the later one
    caps = _captures(spark, [(ids[0], "neither")] + list(zip(ids, names)))
    out = run_rate_shop(requests, caps, LAYOUTS, "2024-05-01")

    outcomes = {r.request_id: r for r in out.outcomes.collect()}
    assert len(outcomes) == len(rows)  # every request exactly once
    assert outcomes[ids[0]].status == "offers"
    assert outcomes[ids[1]].status == "broken" and outcomes[ids[1]].reason == "too_few_prices"
    assert outcomes[ids[2]].status == "not_available"
    assert outcomes[ids[3]].status == "contact"
    assert outcomes[ids[4]].status == "offers"
    assert outcomes[ids[5]].reason == "no_layout"
    assert outcomes["hotels.csv:9"].reason == "no_capture"
    assert outcomes["hotels.csv:10"].reason == "malformed_row"

    offers = out.offers.collect()
    broken = {r.request_id for r in out.reattempt.collect()}
    assert not broken & {r.request_id for r in offers}  # a broken request emits no offers
    first = sorted((r for r in offers if r.request_id == ids[0]), key=lambda r: r.scrape_position)
    assert [(r.agent, r.scrape_position, r.scrape_base_price, str(r.scrape_base_price_num))
            for r in first] == [("Booking.com", 1, "120", "120.00"),
                                ("Expedia", 2, "1234", "1234.00"),
                                ("Hotels.com", 3, "99", "99.00")]
    assert first[0].hotel == "Hotel offers" and str(first[0].scrape_date) == "2024-05-01"
    na = [r for r in offers if r.request_id == ids[2]]
    assert len(na) == 1 and na[0].agent is None and na[0].status == "not_available"
    summary = {r.status: (r.requests, r.offers) for r in out.summary.collect()}
    assert sum(v[0] for v in summary.values()) == len(rows)
    assert summary["offers"][1] == 3 + 1 + 0 + 2

    paths = write_outputs(out, tmp_dir + "/out", "2024-05-01")
    audit = spark.read.parquet(paths["outcomes"])
    assert audit.count() == len(rows) and audit.filter("status = 'broken'").count() == len(broken)
    back = read_csv(spark, paths["final_data"], "hotel_id string, hotel string, agents string, "
                    "scrape_position string, scrape_date string, check_in string, "
                    "check_out string, check_in_search string, check_out_search string, "
                    "hoken_base_price string, scrape_base_price string, nights string")
    assert back.count() == out.offers.count()
    assert back.filter(F.col("agents") == "Not Available").count() == 1
    re = read_csv(spark, paths["reattempt"], ",".join(
        f"{c} string" for c in ["request_id", "hotel_id", "hotel", "check_in", "check_out",
                                "city", "listed_base_price", "nights", "reason"]))
    assert re.count() == len(broken)


def test_reattempt_written_when_empty(spark, tmp_dir):
    path = write_manifest(tmp_dir + "/m", [manifest_row(1, "A")])
    caps = _captures(spark, [("hotels.csv:1", "offers")])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01")
    paths = write_outputs(out, tmp_dir + "/out", "2024-05-01")
    files = os.listdir(paths["reattempt"])
    assert any(f.endswith(".csv") for f in files)
    assert out.reattempt.count() == 0


def test_extra_prices_keep_pairing(spark, tmp_dir):
    row = manifest_row(1, "A")
    row[16], row[17], row[18] = "$10", "$115", "$230"
    path = write_manifest(tmp_dir + "/m", [row])
    caps = _captures(spark, [("hotels.csv:1", "fees")])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01",
                        extra_prices=True)
    got = sorted(out.offers.collect(), key=lambda r: r.scrape_position)
    assert [(r.agent, r.scrape_base_price, r.scrape_average_price_fees, r.scrape_total_price)
            for r in got] == [("A", "100", "110", "220"), ("B", "50", None, None)]
    assert got[0].listed_average_price_fees == "$115" and got[0].fees == "$10"
    assert str(got[0].scrape_total_price_num) == "220.00"


def test_ordered_legacy_export(spark, tmp_dir):
    names = ["offers", "na_rule1", "blanks"]
    path = write_manifest(tmp_dir + "/m", [manifest_row(i + 1, f"H{i}") for i in range(3)])
    caps = _captures(spark, [(f"hotels.csv:{i + 1}", n) for i, n in enumerate(names)])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01")
    paths = write_outputs(out, tmp_dir + "/out", "2024-05-01", ordered=True)
    import glob
    lines = []
    for f in sorted(glob.glob(paths["final_data"] + "/part-*.csv")):
        with open(f, newline="", encoding="utf-8") as fh:
            lines += list(csv.reader(fh))[1:]
    assert [(r[0], r[3]) for r in lines] == [("1", "1"), ("1", "2"), ("1", "3"),
                                             ("2", "Not Available"), ("3", "1"), ("3", "2")]


def test_read_captures(spark, tmp_dir):
    import json
    from ratelens.sources.captures import read_captures
    os.makedirs(tmp_dir + "/j")
    with open(tmp_dir + "/j/c.json", "w") as f:
        f.write(json.dumps({"request_id": "r1", "html": PAGES["offers"],
                            "captured_at": "2024-01-01 10:00:00"}) + "\n")
        f.write(json.dumps({"request_id": "r2", "html": None}) + "\n")
    df = read_captures(spark, tmp_dir + "/j", fmt="json")
    assert df.columns == ["request_id", "page_id", "url", "html", "captured_at"]
    rows = {r.request_id: r for r in df.collect()}
    assert rows["r1"].captured_at == dt.datetime(2024, 1, 1, 10) and rows["r2"].html is None
    df.write.parquet(tmp_dir + "/p")
    assert read_captures(spark, tmp_dir + "/p").count() == 2


def test_split_manifest_keeps_row_numbers(spark, tmp_dir):
    rows = [manifest_row(i, f"Hotel {i:05d} " + "x" * 40) for i in range(1, 3001)]
    path = write_manifest(tmp_dir + "/big", rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = read_manifest(spark, path, multi_line=False)
        assert df.rdd.getNumPartitions() > 1
        got = {r.row_in_file: r.hotel_id for r in df.select("row_in_file", "hotel_id").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i: str(i) for i in range(1, 3001)}


def test_reattempt_manifest_feeds_back(spark, tmp_dir):
    from ratelens.sources.manifest import reattempt_manifest
    from ratelens.sources.sinks import write_csv
    names = ["offers", "too_few_prices", "neither"]
    path = write_manifest(tmp_dir + "/m", [manifest_row(i + 1, f"H{i}") for i in range(3)])
    caps = _captures(spark, [(f"hotels.csv:{i + 1}", n) for i, n in enumerate(names)])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01")
    again = reattempt_manifest(spark, path, out.reattempt)
    assert again.columns == HEADER
    write_csv(again, tmp_dir + "/again")
    second = read_manifest(spark, tmp_dir + "/again")
    assert sorted(r.hotel_id for r in second.collect()) == ["2", "3"]
    assert second.filter("malformed").count() == 0


def test_legacy_csv_round_trip_exact(spark, tmp_dir):
    import glob
    from ratelens.operators.offers import legacy_projection
    names = ["offers", "na_rule1", "contact_rule1"]
    hotels = ['Hôtel "Le, Grand"', "Two\nLines", "Plain"]
    path = write_manifest(tmp_dir + "/m", [manifest_row(i + 1, h) for i, h in enumerate(hotels)])
    caps = _captures(spark, [(f"hotels.csv:{i + 1}", n) for i, n in enumerate(names)])
    out = run_rate_shop(read_manifest(spark, path), caps, LAYOUTS, "2024-05-01")
    paths = write_outputs(out, tmp_dir + "/out", "2024-05-01")
    want = sorted(tuple(None if v in (None, "") else v for v in r)
                  for r in legacy_projection(out.offers).collect())
    got = []
    for f in glob.glob(paths["final_data"] + "/part-*.csv"):
        with open(f, newline="", encoding="utf-8") as fh:
            rows = list(csv.reader(fh))
        got += [tuple(None if v == "" else v for v in r) for r in rows[1:]]
    assert sorted(got) == want
    assert any(r[1] == 'Hotel "Le, Grand"' for r in got)
    assert any(r[1] == "Two\nLines" for r in got)


def test_command_line_run(spark, tmp_dir, capsys):
    from ratelens.__main__ import main
    names = ["offers", "too_few_prices"]
    path = write_manifest(tmp_dir + "/m", [manifest_row(i + 1, f"H{i}") for i in range(2)])
    _captures(spark, [(f"hotels.csv:{i + 1}", n) for i, n in enumerate(names)]).write.parquet(
        tmp_dir + "/caps")
    assert main(["--manifest", path, "--captures", tmp_dir + "/caps", "--out",
                 tmp_dir + "/out", "--run-date", "2024-05-01"]) == 0
    printed = capsys.readouterr().out
    assert "offers" in printed and "reattempt_manifest" in printed
    retry = read_manifest(spark, tmp_dir + "/out/reattempt_manifest_2024-05-01")
    assert [r.hotel_id for r in retry.collect()] == ["2"]


def test_request_ids_unique_across_folders(spark, tmp_dir):
    write_manifest(tmp_dir + "/m/a", [manifest_row(1, "A")])
    write_manifest(tmp_dir + "/m/b", [manifest_row(2, "B")])
    ids = [r.request_id for r in read_manifest(spark, tmp_dir + "/m/*/hotels.csv").collect()]
    assert len(set(ids)) == 2 and all(i.endswith("hotels.csv:1") for i in ids)


def test_require_dates(spark, tmp_dir):
    names = ["dates", "offers"]
    rows = [manifest_row(1, "A", ci="May 1, 2024", co="May 1, 2024"), manifest_row(2, "B", ci="May 1, 2024")]
    path = write_manifest(tmp_dir + "/m", rows)
    caps = _captures(spark, [(f"hotels.csv:{i + 1}", n) for i, n in enumerate(names)])
    req = read_manifest(spark, path)
    loose = {r.request_id: r.status for r in
             run_rate_shop(req, caps, LAYOUTS, "2024-05-01").outcomes.collect()}
    strict = {r.request_id: (r.status, r.reason) for r in
              run_rate_shop(req, caps, LAYOUTS, "2024-05-01", require_dates=True)
              .outcomes.collect()}
    assert loose == {"hotels.csv:1": "offers", "hotels.csv:2": "offers"}
    assert strict == {"hotels.csv:1": ("offers", None),
                      "hotels.csv:2": ("broken", "dates_not_found")}
