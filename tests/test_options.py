import pytest

from rangeload import LoadOptions


def test_defaults(spark):
    options = LoadOptions.from_conf(spark, offsetColumn="ts")
    assert (options.num_ranges, options.include_deleted, options.max_records) == (1, True, 10_000)
    assert (options.max_batches, options.poll_interval_ms, options.load_available) == (1_000, 60_000, False)


def test_call_beats_conf_and_prefix_is_last(spark):
    try:
        spark.conf.set("spark.rangeload.loadNumPartitions", "4")
        assert LoadOptions.from_conf(spark, offset_column="ts").num_ranges == 4
        spark.conf.set("loadNumPartitions", "5")
        assert LoadOptions.from_conf(spark, offset_column="ts").num_ranges == 5
        assert LoadOptions.from_conf(spark, offset_column="ts", LOADNUMPARTITIONS="6").num_ranges == 6
        spark.conf.unset("loadNumPartitions")
        spark.conf.set("LOADNUMPARTITIONS", "9")
        assert LoadOptions.from_conf(spark, offset_column="ts").num_ranges == 9
    finally:
        spark.conf.unset("LOADNUMPARTITIONS")
        spark.conf.unset("loadNumPartitions")
        spark.conf.unset("spark.rangeload.loadNumPartitions")


def test_offset_column_is_required(spark):
    with pytest.raises(ValueError, match="needs offsetColumn"):
        LoadOptions.from_conf(spark)


@pytest.mark.parametrize(
    ("given", "message"),
    [
        ({"loadNumPartitions": "abc"}, "loadNumPartitions=abc: no whole number"),
        ({"isQueryAll": "maybe"}, "isQueryAll=maybe: neither"),
        ({"loadNumPartitions": 0}, "less than 1"),
        ({"poll_interval_ms": -1}, "less than 0"),
        ({"colour": "red"}, "Unknown option"),
    ],
)
def test_bad_options(spark, given, message):
    with pytest.raises(ValueError, match=message):
        LoadOptions.from_conf(spark, offset_column="ts", **given)


def test_text_values(spark):
    options = LoadOptions.from_conf(spark, offset_column="ts", isQueryAll="FALSE", streamingMaxRecordsInPartition="7")
    assert options.include_deleted is False and options.max_records == 7
