import pytest
from pyspark.sql import functions as F

from clickweave.session import build_session, cut_lineage, shared_dir
from clickweave.sinks import streams, tables
from clickweave.sinks.files import write_files
from clickweave.sources import kafka
from clickweave.sources.files import read_files

SERVERS = {"bootstrap_servers": "host:1"}


def test_kafka_stream_options():
    options = kafka.stream_options(
        {
            **SERVERS,
            "topics": ["a", "b"],
            "group_id": "g",
            "maxOffsetsPerTrigger": 1000,
            "kafka.security.protocol": "SSL",
        }
    )
    assert options == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "a,b",
        "kafka.group.id": "g",
        "kafka.security.protocol": "SSL",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
    }


def test_kafka_batch_reads_everything_by_default():
    options = kafka.batch_options({"kafka.bootstrap.servers": "h", "subscribePattern": "t.*"})
    assert (options["startingOffsets"], options["endingOffsets"]) == ("earliest", "latest")
    chosen = kafka.batch_options({**SERVERS, "assign": {"t": [0, 1]}, "startingOffsets": {"t": {"0": 5, "1": -2}}})
    assert chosen["assign"] == '{"t": [0, 1]}'
    assert chosen["startingOffsets"] == '{"t": {"0": 5, "1": -2}}'


@pytest.mark.parametrize(
    "settings",
    [
        {"subscribe": "t"},
        SERVERS,
        {**SERVERS, "subscribe": "t", "subscribePattern": "t.*"},
        {**SERVERS, "subscribe": "t", "topics": ["t"]},
    ],
)
def test_kafka_settings_that_do_not_work(settings):
    with pytest.raises(ValueError):
        kafka.stream_options(settings)


def test_kafka_sink_options(spark):
    options = streams.kafka_options({**SERVERS, "topic": "out", "kafka.acks": "all"})
    assert options == {"kafka.bootstrap.servers": "host:1", "topic": "out", "kafka.acks": "all"}
    with pytest.raises(ValueError):
        streams.kafka_options(SERVERS)
    frame = spark.sql("SELECT 1 AS a, 'x' AS b")
    assert streams.kafka_payload(frame).first().value == '{"a":1,"b":"x"}'


@pytest.mark.parametrize(
    "trigger, stateful, expected",
    [
        (None, True, {"processingTime": "10 seconds"}),
        ({"once": True}, True, {"availableNow": True}),
        ({"availableNow": True}, False, {"availableNow": True}),
        ({"continuous": "1 second"}, False, {"continuous": "1 second"}),
        ({"processingTime": "30 seconds"}, True, {"processingTime": "30 seconds"}),
    ],
)
def test_triggers(trigger, stateful, expected):
    assert streams.trigger_arguments(trigger, stateful) == expected


@pytest.mark.parametrize(
    "trigger", [{"continuous": "1 second"}, {"sometimes": True}, {"once": True, "processingTime": "1 s"}]
)
def test_bad_triggers(trigger):
    with pytest.raises(ValueError):
        streams.trigger_arguments(trigger, stateful=True)


def test_table_stream_options():
    settings = {"fanout_enabled": True, "iceberg.x": 1, "other": 2}
    assert streams.table_stream_options(settings) == {
        "mergeSchema": "true",
        "fanout-enabled": "true",
        "iceberg.x": "1",
    }


def test_catalog_conf():
    hadoop = tables.catalog_conf("local", warehouse="/w")
    assert hadoop["spark.sql.catalog.local.type"] == "hadoop"
    assert hadoop["spark.sql.catalog.local.warehouse"] == "/w"
    rest = tables.catalog_conf("c", "rest", uri="http://x")
    assert rest["spark.sql.catalog.c.catalog-impl"].endswith("RESTCatalog")
    hive = tables.catalog_conf("c", "hive", uri="thrift://x")
    assert hive["spark.sql.catalog.c.uri"] == "thrift://x"
    glue = tables.catalog_conf("c", "glue", warehouse="s3://b")
    assert glue["spark.sql.catalog.c.catalog-impl"].endswith("GlueCatalog")
    for bad in ({"kind": "other"}, {"kind": "hadoop"}, {"kind": "rest"}):
        with pytest.raises(ValueError):
            tables.catalog_conf("c", **bad)


@pytest.mark.parametrize("format", ["parquet", "json", "orc", "csv"])
def test_file_round_trip(spark, tmp_path, format):
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    options = {"header": "true"} if format == "csv" else {}
    write_files(frame, str(tmp_path / "t"), format, partition_by=["s"], options=options)
    back = read_files(spark, str(tmp_path / "t"), format, schema=frame.schema, options=options)
    assert sorted(tuple(r) for r in back.select("n", "s").collect()) == [(1, "a"), (2, "b")]


def test_unknown_formats_and_modes(spark, tmp_path):
    frame = spark.range(1)
    for arguments in ({"format": "xml"}, {"mode": "merge"}):
        with pytest.raises(ValueError):
            write_files(frame, str(tmp_path), **arguments)
    with pytest.raises(ValueError):
        read_files(spark, str(tmp_path), "xml")
    with pytest.raises(ValueError):
        tables.write_table(frame, "t", "merge")


def test_table_modes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    assert tables.ensure_table(spark, "modes", rows.schema, partition_by=["s"]) is True
    assert tables.ensure_table(spark, "modes", rows.schema) is False
    tables.write_table(rows, "modes", "append", ["s"])
    tables.write_table(spark.createDataFrame([("b", 9)], "s string, n int"), "modes", "overwrite", ["s"])
    assert sorted(map(tuple, spark.table("modes").collect())) == [(1, "a"), (9, "b")]
    with pytest.raises(Exception, match="already exists"):
        tables.write_table(rows, "modes", "create")
    tables.write_table(rows.limit(1), "modes", "replace")
    assert spark.table("modes").count() == 1
    assert tables.table_columns(spark, "modes").count() == 2


def test_ddl_follows_the_schema(spark):
    schema = spark.sql("SELECT 1 AS n, map('a', 'b') AS m, 'd' AS day").schema
    text = tables.table_ddl("t", schema, ["day"], {"k": "v"}, "iceberg")
    assert text == (
        "CREATE TABLE IF NOT EXISTS t (`n` int, `m` map<string,string>, `day` string) USING iceberg"
        " PARTITIONED BY (day) TBLPROPERTIES ('k' = 'v')"
    )
    spark.sql(tables.table_ddl("ddl_check", schema, ["day"], tables.SESSION_TABLE_PROPERTIES))
    assert tables.table_partitions(spark, "ddl_check").count() == 0
    assert tables.table_properties(spark, "ddl_check").filter("key = 'format-version'").count() == 1


def test_partition_pruning_by_date_and_bucket(spark, tmp_path):
    rows = spark.range(100).select(
        F.col("id"), (F.col("id") % 5).cast("string").alias("session_date"), (F.col("id") % 10).cast("int").alias("user_hash_bucket")
    )
    tables.write_table(rows, "pruning", "create", ["session_date", "user_hash_bucket"], location=str(tmp_path / "t"))
    from clickweave.operators.analytics import pruned_count

    frame = pruned_count(spark.table("pruning"), "3", [3, 8])
    plan = frame._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "session_date" in filters and "user_hash_bucket" in filters
    assert frame.first().event_count == 20


def test_lineage_is_cut_in_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert "ExistingRDD" in cut_lineage(spark.range(3))._jdf.queryExecution().toString()


def test_session_builder_reuses_the_session(spark):
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_memory_and_console_sinks(spark, tmp_path):
    rows = spark.range(20).withColumn("s", F.lit("x"))
    rows.write.parquet(str(tmp_path / "in"))
    from clickweave.sources.files import stream_files

    stream = stream_files(spark, str(tmp_path / "in"), rows.schema, max_files_per_trigger=2)
    drain = {"availableNow": True}
    counted = stream.groupBy("s").count()
    streams.write_stream(
        counted, str(tmp_path / "c1"), "memory", output_mode="complete", trigger=drain, name="kept", stateful=True
    ).awaitTermination()
    assert spark.table("kept").first()["count"] == 20
    streams.write_stream(stream.limit(1), str(tmp_path / "c2"), "console", trigger=drain).awaitTermination()
    with pytest.raises(ValueError):
        streams.write_stream(stream, str(tmp_path / "c3"), output_mode="replace")


def test_spread(spark):
    from clickweave.functions.layout import spread

    frame = spark.range(10)
    assert spread(frame) is frame
    assert spread(frame, partitions=3).rdd.getNumPartitions() == 3
    assert "hashpartitioning(id" in spread(frame, ["id"], 4)._jdf.queryExecution().toString()


def test_differing_columns_are_an_error(spark, tmp_path):
    rows = spark.range(4).select("id", (F.col("id") % 2).alias("part"))
    tables.write_table(rows, "narrow", "create", ["part"], location=str(tmp_path / "narrow"))
    wider = rows.withColumn("extra", F.lit("x")).select("id", "extra", "part")
    for mode in ("append", "overwrite"):
        with pytest.raises(ValueError, match="extra"):
            tables.write_table(wider, "narrow", mode)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    tables.write_table(wider.filter("part = 1"), "narrow", "overwrite", merge_schema=True)
    assert sorted((r.id, r.extra) for r in spark.table("narrow").collect()) == [(0, None), (1, "x"), (2, None), (3, "x")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_filters_on_a_rolled_up_table_prune_its_partitions(spark, tmp_path):
    from clickweave.operators.analytics import daily_sessions, rollup_stored, session_lookup

    rows = spark.range(60).select(
        F.col("id").cast("string").alias("uuid"),
        F.concat("id", F.lit("_session_1")).alias("session_id"),
        F.col("id").alias("session_start_time_ms"),
        (F.col("id") + 5).alias("session_end_time_ms"),
        (F.col("id") % 3).cast("string").alias("session_date"),
        (F.col("id") % 4).cast("int").alias("user_hash_bucket"),
    )
    tables.write_table(rows, "rolled", "create", ["session_date", "user_hash_bucket"], location=str(tmp_path / "t"))
    rolled = rollup_stored(spark.table("rolled"))
    for frame, columns in (
        (session_lookup(rolled, "1", 2), ("session_date", "user_hash_bucket")),
        (daily_sessions(rolled, "0", "1"), ("session_date",)),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
        assert all(c in filters for c in columns)
    assert session_lookup(rolled, "1", 2).count() == 5
