"""Properties that hold for any input, and independence from the physical layout."""

import pytest
from pyspark.sql import functions as F

from sunfleet.operators import daily as d
from sunfleet.operators import quantiles, ranking, sampling, series, special
from sunfleet.plans import daily as plan
from sunfleet.plans import training as train_plan
from sunfleet.plans.cleaning import clean_telemetry
from sunfleet import functions as fn
from validation import inputs

TIES = ("etotal",)
KINDS = ["vac1", "eday"]


def values(df, digits=9):
    def cell(v):
        return round(v, digits) if isinstance(v, float) else v

    order = sorted(df.columns)
    return sorted((tuple(cell(v) for v in r) for r in df.select(*order).collect()), key=str)


@pytest.fixture(scope="module")
def telemetry(spark, sf_dir):
    return inputs.telemetry(spark, sf_dir).cache()


@pytest.fixture(scope="module")
def clean(telemetry):
    return clean_telemetry(telemetry)[0].cache()


@pytest.mark.parametrize("t", [2, 7, 30])
def test_matrix_width(t):
    expected = 2 * 6 * (t - 1) + 2 * 3 * (t - 1) + 6 * t + 3 * t + 6 * 7 * t + 3 * 6 * t + 4 * t + 2 * (t - 1)
    names = plan.feature_names(t)
    assert len(names) == len(set(names)) == expected
    if t == 7:
        assert expected == 631
        assert "vpv1_0.8_spikes_day_3" in names and "vpv1_mean_day_0" not in names


def test_one_row_per_kept_device_and_full_spine(telemetry, clean):
    days = plan.daily_feature_days(telemetry, spec=d.DailySpec(("switch",)))
    devices = clean.select("sn").distinct().count()
    per_device = days.groupBy("sn").count()
    assert per_device.count() == devices
    assert per_device.filter("count <> 7").count() == 0


def test_spike_counts_fall_as_the_amplitude_rises(telemetry):
    days = plan.daily_feature_days(telemetry, spec=d.DailySpec(("vpv_spikes", "vac_sags")))
    wrong = days.filter(
        "vpv1_0_8_spikes < vpv1_0_9_spikes or vpv1_1_1_spikes < vpv1_1_2_spikes or vac1_0_8_sags > vac1_1_0_sags"
    )
    assert wrong.count() == 0


def test_splits_are_disjoint_and_complete(spark, sf_dir):
    labels = inputs.all_labels(spark, sf_dir)
    split = sampling.stratified_split(labels, "label", ["sn"], 0.3, 7)
    assert split.count() == labels.count() == split.select("sn").distinct().count()
    folds = sampling.stratified_kfold(labels, "label", ["sn"], 5, 7)
    sizes = folds.groupBy("label", "fold").count().groupBy("label").agg(
        (F.max("count") - F.min("count")).alias("spread")
    )
    assert sizes.filter("spread > 1").count() == 0


def test_quotas_add_up(spark, sf_dir):
    devices = inputs.users(spark, sf_dir)
    total = devices.count() - 2
    assert sampling.model_quotas(devices, total).agg(F.sum("required_count")).first()[0] == total
    assert sampling.proportional_sample(devices, total, 1).distinct().count() == total


@pytest.mark.parametrize("digits", [1, 2, 3])
def test_rank_equals_a_plain_window(spark, sf_dir, digits):
    rows = inputs.all_labels(spark, sf_dir)
    key = fn.seeded_key(["sn"], 5)
    ours = ranking.ranked(rows, key, ["label"], "r", "n", digits)
    rows.createOrReplaceTempView("rank_rows")
    plain = spark.sql(
        "select sn, label, row_number() over (partition by label order by md5(concat_ws(':', sn, '5'))) r, "
        "count(*) over (partition by label) n from rank_rows"
    )
    assert values(ours) == values(plain)


@pytest.mark.parametrize("chunk", [5, 17])
def test_chunks_do_not_change_neighbour_features(clean, chunk):
    whole = series.neighbour_features(clean, KINDS, tie_breakers=TIES)
    cut = series.neighbour_features(clean, KINDS, tie_breakers=TIES, chunk=chunk)
    assert values(whole, 4) == values(cut, 4)


def test_chunks_do_not_change_wavelet_peaks(clean):
    whole = special.number_cwt_peaks(clean, KINDS, tie_breakers=TIES)
    cut = special.number_cwt_peaks(clean, KINDS, tie_breakers=TIES, chunk=11)
    assert values(whole) == values(cut)


@pytest.mark.parametrize("bins", [1, 3, 1000])
def test_bins_do_not_change_quantiles(clean, bins):
    long = series.long_form(clean, KINDS)
    ours = quantiles.group_quantiles(long, ["sn", "kind"], {"a": 0.3, "b": 0.5}, bins=bins, small=0)
    plain = long.groupBy("sn", "kind").agg(
        F.percentile("value", 0.3).alias("a"), F.percentile("value", 0.5).alias("b")
    )
    assert values(ours) == values(plain)


def test_quantiles_with_far_outliers(spark):
    """Crowded values beside an outlier still spread over bins, and the result is exact."""
    rows = spark.range(2000).selectExpr(
        "'a' as k", "if(id = 0, 1e9, id / 7.0D) as value"
    ).unionByName(spark.range(2000).selectExpr("'b' as k", "if(id = 0, -1e9, id / 7.0D) as value"))
    ours = quantiles.group_quantiles(rows, ["k"], {"a": 0.1, "b": 0.75}, small=0)
    plain = rows.groupBy("k").agg(F.percentile("value", 0.1).alias("a"), F.percentile("value", 0.75).alias("b"))
    assert values(ours) == values(plain)
    ends = rows.groupBy("k").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    bins = rows.withColumnRenamed("value", "_v").join(ends, "k").selectExpr(
        "k", f"{quantiles._bin_number(1024)} as bin"
    )
    assert bins.groupBy("k", "bin").count().agg(F.max("count")).first()[0] < 100


def test_layout_independence(spark, telemetry):
    spec = d.DailySpec(("error", "vac", "energy"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for partitions, source in (("1", telemetry), ("8", telemetry.repartition(13, "etotal"))):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            results.append(values(plan.daily_feature_days(source, spec=spec)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_offsets_in_one_pass_equal_single_windows(telemetry):
    spec = d.DailySpec(("error", "vac"))
    together = train_plan.offset_days(telemetry, range(4), spec=spec)
    for offset in (0, 3):
        alone = plan.daily_feature_days(telemetry, out_days=offset, spec=spec)
        part = together.filter(F.col("out_days") == offset).drop("out_days")
        assert values(part) == values(alone)


def test_offsets_respect_the_strict_midnight(core_frame):
    df = core_frame(
        {"createtime": "2024-01-02 00:00:00", "vac1": 100.0},
        {"createtime": "2024-01-08 09:00:00", "vac1": 220.0},
    )
    spec = d.DailySpec(("vac",))
    for offset in (0, 1):
        part = train_plan.offset_days(df, (0, 1), spec=spec).filter(F.col("out_days") == offset).drop("out_days")
        assert values(part) == values(plan.daily_feature_days(df, out_days=offset, spec=spec))


def test_one_hot_device_gives_the_same_values(spark, telemetry):
    """A device with a third of all rows: the chunked path equals a plain window."""
    hot = telemetry.withColumn("sn", F.when(F.col("etotal") % 3 == 0, "TP10KBT000B999999999").otherwise(F.col("sn")))
    ours = series.neighbour_features(hot, ["vac1"], ["changes"], TIES, chunk=16)
    hot.createOrReplaceTempView("hot_rows")
    plain = spark.sql(
        "select sn, 'vac1' kind, sum(abs(a - vac1)) absolute_sum_of_changes from (select sn, vac1, "
        "lead(vac1) over (partition by sn order by createtime, etotal) a from hot_rows) group by sn"
    )
    assert values(ours) == values(plain)
