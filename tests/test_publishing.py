"""Outputs are published together or not at all, with counts of one job."""

import os

import pytest
from pyspark.sql import functions as F

from golden import PAGES
from ratelens.operators.extract import NativeLayout, Test
from ratelens.plans.rateshop import RunOutputs, run_rate_shop
from ratelens.sources.sinks import published, read_output, write_outputs
from test_defaults import captures, requests

RULES = [NativeLayout(layout=1, names='<div class="NiGhzc">([^<]*)</div>', prices='<span class="pNExyb">([^<]*)</span>',
                      not_available=(Test("na-one"),), contact=(Test("MEVoGd"),))]


def run(spark, names):
    pages = {n: PAGES[n] for n in names}
    return run_rate_shop(requests(spark, [*names, "nothing"]), captures(spark, pages), RULES, "2024-05-01")


def test_summary_equals_the_written_rows_after_one_job(spark, tmp_dir):
    out = run(spark, ["offers", "na_rule1", "contact_rule1", "too_few_prices", "no_agents"])
    want = sorted(map(tuple, out.summary.select("status", "requests", "offers", "no_sellers").collect()))
    # the counts come from the writing job: the summary itself is never computed
    broken = F.raise_error(F.lit("computed")).cast("string")
    out = RunOutputs(out.offers, out.reattempt, out.summary.withColumn("status", broken), out.outcomes)
    paths = write_outputs(out, tmp_dir, "2024-05-01", legacy_csv=False)
    assert published(spark, tmp_dir, "2024-05-01") and not os.listdir(tmp_dir + "/_staging")
    summary = read_output(spark, tmp_dir, "2024-05-01", "summary")
    assert sorted(map(tuple, summary.select("status", "requests", "offers", "no_sellers").collect())) == want
    outcomes = read_output(spark, tmp_dir, "2024-05-01", "outcomes")
    assert sum(w[1] for w in want) == outcomes.count() == 6
    assert read_output(spark, tmp_dir, "2024-05-01").count() == sum(w[2] for w in want) + 2
    assert set(paths) == {"offers", "reattempt", "summary", "outcomes"}


def test_a_failed_run_leaves_the_earlier_outputs(spark, tmp_dir):
    good = run(spark, ["offers"])
    write_outputs(good, tmp_dir, "2024-05-01")
    before = read_output(spark, tmp_dir, "2024-05-01").count()
    bad = RunOutputs(good.offers.withColumn("agent", F.raise_error(F.lit("lost")).cast("string")), good.reattempt,
                     good.summary, run(spark, ["offers", "na_rule1"]).outcomes)
    with pytest.raises(Exception, match="lost"):
        write_outputs(bad, tmp_dir, "2024-05-01")
    assert published(spark, tmp_dir, "2024-05-01") and not os.listdir(tmp_dir + "/_staging")
    assert read_output(spark, tmp_dir, "2024-05-01").count() == before
    assert read_output(spark, tmp_dir, "2024-05-01", "outcomes").count() == 2
    with pytest.raises(FileNotFoundError):
        read_output(spark, tmp_dir, "2024-05-02")
    # a rerun without offers takes the old ones away
    paths = write_outputs(run(spark, ["too_few_prices"]), tmp_dir, "2024-05-01")
    assert "offers" not in paths and not os.path.exists(f"{tmp_dir}/offers/run_date=2024-05-01")
    assert not os.path.exists(f"{tmp_dir}/final_data_2024-05-01") and published(spark, tmp_dir, "2024-05-01")
