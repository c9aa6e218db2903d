import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridcast import spec
from gridcast.operators import calendar, events
from gridcast.sources import describe, jdbc, listing, seeds

INDEX = """1:0:d=2026032600:PRMSL:mean sea level:240 hour fcst:
2:900:d=2026032600:APCP:surface:0-10 day acc fcst:
3:1500:d=2026032600:TMP:850 mb:234 hour fcst:
4:2000:d=2026032600:TMP:850 mb:240 hour fcst:
5:2600:d=2026032600:TMP:850 mb:240 hour fcst:
6:3000:d=2026032600:HGT:500 mb:240 hour fcst:
"""
KEYS = [":TMP:850 mb:", ":HGT:500 mb:", ":APCP:surface:", ":UGRD:250 mb:"]


def test_index_ranges(spark, fresh):
    path = fresh()
    spark.createDataFrame([(INDEX,)], "value string").coalesce(1).write.text(path)
    files = listing.read_texts(spark, path).withColumn("step", F.lit(240))
    got = {r.key: (r.range_start, r.range_end) for r in listing.index_ranges(files, KEYS).collect()}
    assert got == {":TMP:850 mb:": (2000, 2599), ":HGT:500 mb:": (3000, None), ":APCP:surface:": (900, 1499)}


def test_index_of_the_analysis_step_and_crlf(spark):
    text = "1:0:d=x:HGT:500 mb:anl:\r\n2:70:d=x:TMP:850 mb:6 hour fcst:\r\n"
    df = spark.createDataFrame([("f", 0, text), ("empty", 0, "")], "file string, step int, text string")
    assert [tuple(r) for r in listing.index_ranges(df, KEYS).collect()] == [("f", 0, ":HGT:500 mb:", 0, 69)]


def test_index_lines_that_follow_each_other_and_lines_cut_short(spark):
    text = "1:0:d=x:HGT:500 mb:24 hour fcst:\n2:70:d=x:HGT:500 mb:240 hour fcst:\n3:90:d=x:TMP:850 mb:240 hour fcst:\nx\n4:99\n5:120:d=x:APCP:surface:1-2 day acc fcst:\n"
    df = spark.createDataFrame([("f", 240, text), ("none", 240, None)], "file string, step int, text string")
    got = {r.key: (r.range_start, r.range_end) for r in listing.index_ranges(df, KEYS).collect()}
    assert got == {":HGT:500 mb:": (70, 89), ":TMP:850 mb:": (90, None), ":APCP:surface:": (120, None)}


def test_index_keys_are_checked(spark):
    df = spark.createDataFrame([("f", 0, "")], "file string, step int, text string")
    with pytest.raises(ValueError):
        listing.index_ranges(df, ["TMP"])


def test_listing_ready(spark):
    pages = [
        ("a", '<a href="x"> 20260326-360h-oper-fc.grib2 </a>'),
        ("b", '<A HREF="20260326-360h-oper-fc.grib2"><b>x</b></A><a></a>'),
        ("c", "gfs.t00z.pgrb2.0p25.f360"),
        ("d", "<a>\n<i>20260326-360h-oper</i>-fc.grib2\n</a>"),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    got = {r.url: (r.links, r.ready) for r in listing.listing_ready(df, listing.target_file(360, False), listing.sentinel_file(0, 360)).collect()}
    assert got == {"a": (1, True), "b": (1, False), "c": (0, True), "d": (1, True)}
    assert listing.target_file(360, True) == "-360h-enfo-ep.grib2"


def test_seed_with_quoted_list(spark, fresh):
    path = fresh()
    with open(path, "w") as f:
        f.write('variable_id,level_mb,grib_params,pack_type,physical_significance\nx,500,"x,z,1",P,Some text\n')
    row = seeds.load_seed(spark, path, "weather_model_variables").first()
    assert (row.level_mb, row.grib_params) == ("500", "x,z,1")


def test_seed_with_a_wrong_header_fails(spark, fresh):
    path = fresh()
    with open(path, "w") as f:
        f.write("anchor,latitude,longitude,teleconnection,description\na,1,2,b,c\n")
    with pytest.raises(Exception):
        seeds.load_seed(spark, path, "meteorological_anchors").collect()


@pytest.mark.parametrize(
    "data_type,expected",
    [
        (T.ArrayType(T.ArrayType(T.IntegerType())), "int4[][]"),
        (T.DecimalType(38, 0), "numeric(38,0)"),
        (T.MapType(T.StringType(), T.StringType()), "text"),
        (T.BinaryType(), "bytea"),
        (T.TimestampType(), "timestamptz"),
        (T.TimestampNTZType(), "timestamp"),
    ],
)
def test_relational_types(data_type, expected):
    assert describe.relational_type(data_type) == expected


def test_raw_schema_in_relational_types(spark):
    df = spark.createDataFrame([], spec.raw_schema(spec.UPPER))
    assert describe.relational_columns(df)["isobaricinhpa"] == "int4"


class Recorder:
    """Stands in for Spark's JDBC reader and writer; no database is started."""

    def __init__(self):
        self.seen = {}
        self.write = self.read = self

    def jdbc(self, url, table, mode, properties):
        self.seen = {"url": url, "dbtable": table, "mode": mode, **properties}

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen |= options
        return self

    def load(self):
        return self.seen


def test_jdbc_options():
    sink = Recorder()
    jdbc.write_table(sink, "jdbc:x", "t", "append", {"user": "u"}, connections=3)
    assert sink.seen == {"url": "jdbc:x", "dbtable": "t", "mode": "append", "batchsize": "10000", "user": "u", "numPartitions": "3"}
    seen = jdbc.read_table(Recorder(), "jdbc:x", "t", split_on="cycle_hour", bounds=("0", "24"), splits=4)
    assert (seen["partitionColumn"], seen["numPartitions"]) == ("cycle_hour", "4")
    assert "partitionColumn" not in jdbc.read_table(Recorder(), "jdbc:x", "t")


def found(spark, skip=()):
    rows = [
        (f"b/{p.source}/{p.table}/forecast_date=2026-03-25/forecast_cycle={c}/x.parquet",)
        for p in spec.PRODUCTS
        if p.published
        for c in p.cycles
        if (p.table, c) not in skip
    ]
    return calendar.parse_listing(spark.createDataFrame(rows + [("b/readme",)], "path string"))


def test_readiness_by_the_new_york_day(spark):
    products = calendar.product_table(spark)
    for instant, missing in (("2026-03-26 12:00:00", 0), ("2026-03-27 03:59:00", 0), ("2026-03-27 04:00:00", 22)):
        got = calendar.missing_partitions(found(spark), F.lit(instant).cast("timestamp"), products)
        assert got.count() == missing
    lost = calendar.missing_partitions(found(spark, {("ifs_spread", 12)}), F.lit("2026-03-26 12:00:00").cast("timestamp"), products)
    assert [tuple(r) for r in lost.collect()] == [("ifs_spread", "2026-03-25", 12)]


def test_calendar_size_and_names(spark):
    df = calendar.partition_calendar(calendar.product_table(spark), F.lit("2026-03-26").cast("date"), 0, 2)
    assert df.count() == 3 * (4 * 4 + 4 * 2)
    assert df.where("partition_name = 'fct_aifs_spread_c12_p2026_03_28'").count() == 1
    assert calendar.partitions_to_create(df, df).count() == 0


def test_expired_names(spark):
    names = ["f_c00_p2026_03_23", "f_c00_p2026_03_24", "f_c00_p2026_02_30", "f_c00", "p2026_01_01_x"]
    df = spark.createDataFrame([(n,) for n in names], "partition_name string")
    got = calendar.expired_partitions(df, "2026-05-08", 45)
    assert [r.partition_name for r in got.collect()] == ["f_c00_p2026_03_23"]


def ev(spark, rows):
    return spark.createDataFrame(rows, "t string, uri string").select(F.col("t").cast("timestamp_ntz").alias("ts"), "uri")


def run_log(spark, rows):
    return spark.createDataFrame(rows, "t string, state string").select(F.col("t").cast("timestamp_ntz").alias("start_date"), "state")


def test_routing_since_last_success_or_fallback(spark):
    e = ev(
        spark,
        [
            ("2026-03-26 10:00:00", "s3://x/gfs_raw/gfs_upper/"),
            ("2026-03-26 11:50:00", "s3://x/ecmwf_raw/at_ifs_upper/"),
            ("2026-03-26 11:55:00", "s3://x/other/"),
            ("2026-03-26 11:56:00", "s3://x/ecmwf_raw/aifs_spread/?also=ecmwf_raw/ifs_spread"),
        ],
    )
    start = "2026-03-26 12:00:00"

    def models(log, **kw):
        return sorted(r.model for r in events.models_to_refresh(e, run_log(spark, log), start, **kw).collect())

    late = ["aifs_spread", "ifs_spread", "ifs_upper"]
    assert models([("2026-03-26 09:00:00", "success")]) == sorted([*late, "gfs_upper"])
    assert models([("2026-03-26 09:00:00", "failed")]) == late
    assert models([("2026-03-26 11:56:00", "success")]) == []
    assert len(models([], manual=True)) == 8


def test_coalescing(spark):
    uri = "s3://x/gfs_raw/gfs_upper/"
    e = ev(spark, [("2026-03-26 10:00:00", uri), ("2026-03-26 10:04:59", uri), ("2026-03-26 10:05:00", "s3://x/gfs_raw/gfs_surface/")])
    got = [(str(r.window_start), r.models, r.events) for r in events.coalesce_events(e).orderBy("window_start").collect()]
    assert got == [("2026-03-26 10:00:00", "gfs_upper", 2), ("2026-03-26 10:05:00", "gfs_surface", 1)]
