"""Scans, schemas, filters and casts on a small table."""


from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import plans
from rangeload import (
    apply_filters,
    apply_schema,
    conform,
    describe,
    drop_compound,
    load,
    order_output,
    scan,
    top_k,
    typed_load,
)
from rangeload.functions.casts import format_iso_timestamp, parse_iso_timestamp, utc_clock
from rangeload.functions.durations import format_duration
from rangeload.sources.tables import declared_schema


@pytest.fixture(scope="module")
def users(spark):
    rows = [
        ("a", "2020-10-23T13:39:45.000Z", "10:00:00", "alex"),
        ("b", "2020-10-24T13:39:45.000Z", None, "o'brien"),
        ("c", None, "12:00:00", "50%"),
        ("d", "2020-10-26T13:39:45.000Z", "13:00:00", None),
        ("e", "2020-10-27T13:39:45.123Z", "14:00:00", "alex"),
    ]
    schema = declared_schema([("Id", "string"), ("SystemTime", "string"), ("TimeField", "time"), ("Name", "string")])
    table = spark.createDataFrame(rows, schema)
    return table.withColumn("SystemTime", F.col("SystemTime").cast("timestamp"))


@pytest.fixture(scope="module")
def stored(spark, users, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("scan") / "users")
    users.write.parquet(path)
    return spark.read.parquet(path)


def ids(df):
    return sorted(r[0] for r in df.select("Id").collect())


def test_order_and_spelling_of_the_select_list(users):
    assert scan(users, ["NAME", "id"]).columns == ["NAME", "id"]
    assert scan(users, ["*"]).columns == users.columns


def test_unknown_column_lists_the_known_ones(users):
    with pytest.raises(ValueError, match="Available columns: Id, SystemTime"):
        scan(users, ["Age"])


def test_only_plain_columns_in_the_select_list(users):
    with pytest.raises(ValueError, match="No column"):
        scan(users, ["upper(Name)"])
    with pytest.raises(ValueError, match="Only column names"):
        scan(users, [F.upper("Name")])


def test_selecting_beyond_the_list_fails(users):
    with pytest.raises(AnalysisException):
        scan(users, ["Id"]).select("Name").collect()


def test_filter_on_a_hidden_column(stored):
    rows = scan(stored, ["Id"], "SystemTime > '2020-10-25'")
    assert rows.columns == ["Id"] and ids(rows) == ["d", "e"]
    assert "Name" not in plans.read_schema(rows)


def test_deleted_rows(users):
    gone = F.coalesce(F.col("Name") == "alex", F.lit(False))
    assert ids(scan(users, deleted=gone)) == list("abcde")
    assert ids(scan(users, include_deleted=False, deleted=gone)) == ["b", "c", "d"]
    with pytest.raises(ValueError, match="marks deleted"):
        scan(users, include_deleted=False)


def test_values_need_no_escaping(users):
    assert ids(apply_filters(users, F.col("Name") == "o'brien")) == ["b"]
    assert ids(apply_filters(users, F.col("Name").contains("%"))) == ["c"]
    assert ids(apply_filters(users, F.col("Name").startswith("o'"))) == ["b"]


def test_three_valued_logic(users):
    assert ids(apply_filters(users, ~(F.col("Name") == "alex"))) == ["b", "c"]
    assert ids(apply_filters(users, ~F.col("Name").eqNullSafe("alex"))) == ["b", "c", "d"]
    assert ids(apply_filters(users, F.col("TimeField").isNull())) == ["b"]
    assert ids(apply_filters(users, F.col("Name").isin([]))) == []
    assert ids(apply_filters(users)) == list("abcde")


def test_pushdown_and_pruning(stored):
    rows = apply_filters(stored, "Id >= 'b'", F.col("Name").startswith("al"), "TimeField IS NOT NULL").select("Id")
    filters = plans.pushed(rows)
    for part in ("GreaterThanOrEqual(Id,b)", "StringStartsWith(Name,al)", "IsNotNull(TimeField)"):
        assert part in filters
    assert plans.read_schema(rows) == "Id:string,TimeField:string,Name:string"


def test_what_cannot_be_pushed_stays_in_the_plan(stored):
    rows = apply_filters(stored, "length(Name) > 4", "Id >= 'b'").select("Id")
    assert "length" not in plans.pushed(rows) and "length(Name" in plans.explained(rows)
    assert "Id#" in plans.explained(rows).split("Condition")[1]
    assert ids(rows) == ["b"]


def test_count_reads_no_columns(stored):
    assert plans.read_schema(stored.agg(F.count(F.lit(1)))) == ""


def test_empty_result_keeps_its_schema(users):
    rows = scan(users, ["Id", "SystemTime"], "Id = 'zzz'")
    assert rows.collect() == [] and [f.dataType for f in rows.schema] == [T.StringType(), T.TimestampType()]


def test_load_by_query_or_name(spark, users):
    users.createOrReplaceTempView("users_view")
    assert ids(load(spark, "users_view")) == list("abcde")
    assert ids(load(spark, "SELECT Id FROM users_view WHERE Name = 'alex'")) == ["a", "e"]
    assert ids(load(spark, "SELECT Id\nFROM users_view WHERE Name <> 'a;b' AND Name IS NOT NULL;")) == ["a", "b", "c", "e"]
    for bad in (None, " "):
        with pytest.raises(ValueError, match="query"):
            load(spark, bad)
    with pytest.raises(ParseException):
        load(spark, "SELECT 1; SELECT 2")


def test_describe_and_declared_types(users):
    assert describe(users)[:2] == [("Id", "string"), ("SystemTime", "timestamp")]
    names = [("a", "datetime"), ("b", "int"), ("c", "double"), ("d", "boolean"), ("e", "currency"), ("f", "date")]
    schema = declared_schema(names, key="a")
    assert [f.dataType.simpleString() for f in schema] == ["timestamp", "int", "double", "boolean", "string", "string"]
    assert [f.nullable for f in schema] == [False] + [True] * 5


def test_predefined_schema_fills_absent_columns(users):
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("Age", T.IntegerType())])
    rows = apply_schema(users, schema)
    assert rows.columns == ["name", "Age"]
    assert {r.Age for r in rows.collect()} == {None}
    assert rows.select("Age").columns == ["Age"]


def test_predefined_schema_must_agree_on_types(users):
    with pytest.raises(ValueError, match="Id.*declared int"):
        apply_schema(users, T.StructType([T.StructField("Id", T.IntegerType())]))


def test_records_need_every_field(users):
    record = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Id", T.StringType())])
    assert conform(users, record).columns == ["Name", "Id"]
    with pytest.raises(ValueError, match="Missing columns"):
        conform(users, T.StructType([T.StructField("Age", T.IntegerType())]))


def test_records_only_widen(spark):
    table = spark.sql("SELECT 1.7D AS a, 5 AS b, CAST(NULL AS INT) AS c, 1.25BD AS d")
    kinds = {"b": T.LongType(), "a": T.StringType(), "d": T.DecimalType(10, 4), "c": T.DoubleType()}
    row = conform(table, T.StructType([T.StructField(n, k) for n, k in kinds.items()])).first()
    assert tuple(row) == (5, "1.7", Decimal("1.2500"), None)
    for name, kind in (("a", T.IntegerType()), ("b", T.ShortType()), ("d", T.DecimalType(10, 1)), ("b", T.BooleanType())):
        with pytest.raises(ValueError, match="does not fit"):
            conform(table, T.StructType([T.StructField(name, kind)]))
    assert conform(table, T.StructType([T.StructField("b", T.IntegerType(), False)])).first()[0] == 5
    with pytest.raises(Exception, match="Null in column 'c'"):
        conform(table, T.StructType([T.StructField("c", T.IntegerType(), False)])).collect()


def test_compound_columns_go(spark):
    table = spark.sql("SELECT 1 AS a, array(1) AS b, map('x', 1) AS c, named_struct('y', 1) AS d, 'z' AS e")
    assert drop_compound(table).columns == ["a", "e"]


def text_table(spark, **columns):
    return spark.createDataFrame([tuple(columns.values())], ", ".join(f"{name} string" for name in columns))


def test_typed_load(spark):
    table = text_table(
        spark, b="1", s="2", i="3", l="4", f="1.5", d="1e3", t="True", m="1,234,567.89",
        at="2020-10-23T13:39:45.123Z", day="2020-10-23", text="x", none=None,
    )
    types = {
        "b": T.ByteType(), "s": T.ShortType(), "i": T.IntegerType(), "l": T.LongType(), "f": T.FloatType(),
        "d": T.DoubleType(), "t": T.BooleanType(), "m": T.DecimalType(12, 2), "at": T.TimestampType(),
        "day": T.DateType(), "text": T.StringType(), "none": T.IntegerType(), "absent": T.LongType(),
    }
    schema = T.StructType([T.StructField(name, kind) for name, kind in types.items()])
    row = typed_load(table, schema).withColumn("at", F.unix_micros("at")).first()
    assert tuple(row) == (
        1, 2, 3, 4, 1.5, 1000.0, True, Decimal("1234567.89"), 1603460385123000, date(2020, 10, 23), "x", None, None,
    )


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize(
    ("kind", "text"),
    [
        (T.IntegerType(), "1.5"),
        (T.DoubleType(), "abc"),
        (T.BooleanType(), "yes"),
        (T.TimestampType(), "soon"),
        (T.DateType(), "2020-13-01"),
        (T.ByteType(), "300"),
        (T.DecimalType(5, 2), "1,234,567"),
        (T.DecimalType(18, 2), "1.239"),
        (T.DateType(), "2020"),
        (T.TimestampType(), "2020-10"),
        (T.IntegerType(), " 7 "),
        (T.DoubleType(), " 7"),
    ],
)
def test_bad_text_is_an_error(spark, kind, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match=f"Cannot parse '{text}' as .* in column 'c'"):
            typed_load(text_table(spark, c=text), T.StructType([T.StructField("c", kind)])).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_types_that_text_cannot_hold(spark):
    with pytest.raises(ValueError, match="cannot parse text"):
        typed_load(text_table(spark, c="1"), T.StructType([T.StructField("c", T.ArrayType(T.LongType()))]))


def test_iso_timestamps(spark):
    table = text_table(spark, c="2020-10-23T16:39:45.123456+03:00")
    row = table.select(
        F.unix_micros(parse_iso_timestamp(F.col("c"))),
        F.unix_micros(parse_iso_timestamp(F.col("c"), truncate_seconds=True)),
        format_iso_timestamp(parse_iso_timestamp(F.col("c"))),
    ).first()
    assert tuple(row) == (1603460385123456, 1603460385000000, "2020-10-23T13:39:45.123Z")


def test_iso_text_of_local_clocks_in_a_zone_that_changes(spark):
    clocks = {
        "2024-03-10 02:30:00": "2024-03-10T02:30:00.000Z",
        "1969-12-31 23:59:59.999999": "1969-12-31T23:59:59.999Z",
        "2024-11-03 01:30:00.5": "2024-11-03T01:30:00.500Z",
    }
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for clock, text in clocks.items():
            found = spark.sql(f"SELECT TIMESTAMP_NTZ '{clock}' AS t").select(format_iso_timestamp(F.col("t"))).first()[0]
            assert found == text
        assert spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS t").select(format_iso_timestamp(F.col("t"))).first()[0] is None
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_clock_in_any_session_zone(spark, zone):
    """Also through the hour that New York has twice, and before 1970."""
    starts = [1604206800000000 + 1800_000_000 * i for i in range(8)] + [-1, -86_400_000_001, 0]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        instants = spark.createDataFrame([(s,) for s in starts], "s bigint").select("s", F.timestamp_micros("s").alias("t"))
        rows = instants.select("s", utc_clock(F.col("t")).alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert all(r.t == datetime(1970, 1, 1) + timedelta(microseconds=r.s) for r in rows)


@pytest.mark.parametrize(
    ("millis", "units", "text"),
    [
        (2_000_031_007, ("d", "h", "min", "sec", "millis"), "23d 3h 33min 51sec 7millis"),
        (5_000, ("h", "min", "sec"), "5sec"),
        (2_000_031_007, ("d", "h"), "23d 3h"),
        (0, ("h", "min", "sec", "millis"), "0millis"),
        (90_000_000, ("h", "min"), "25h 0min"),
        (60_000, ("h", "min", "sec", "millis"), "1min 0sec 0millis"),
    ],
)
def test_durations(spark, millis, units, text):
    assert spark.range(1).select(format_duration(F.lit(millis), units)).first()[0] == text


def test_duration_units_are_neighbours():
    for units in (("h", "sec"), ("min", "h"), (), ("week",)):
        with pytest.raises(ValueError, match="neighbours"):
            format_duration(F.lit(1), units)


def test_user_order_comes_first(users):
    rows = order_output(users.where("SystemTime IS NOT NULL"), ["Name"], "SystemTime").collect()
    assert [r.Id for r in rows] == ["d", "a", "e", "b"]
    rows = order_output(users, [F.col("SystemTime").desc_nulls_last()], "SystemTime").collect()
    assert [r.Id for r in rows] == ["e", "d", "b", "a", "c"]


def test_order_reads_only_what_it_uses(stored):
    rows = order_output(stored, ["Name"], "SystemTime").select("Id")
    assert "TimeField" not in plans.read_schema(rows) and len(rows.collect()) == 5


def test_top_k_is_global_and_keeps_k_rows_per_task(stored):
    rows = top_k(stored, 2, F.col("SystemTime").desc())
    assert [r.Id for r in rows.collect()] == ["e", "d"]
    assert "TakeOrderedAndProject" in plans.explained(rows)


