"""Registered queries: scans, writes, JSON and time columns, row steps, quality checks, jobs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from clickweave.functions.event_time import normalise_event_time, parse_timestamp
from clickweave.functions.json_columns import (
    extract_fields,
    found_schema,
    parse_json,
    parse_variant,
    variant_fields,
    with_processing_time,
)
from clickweave.functions.layout import add_layout_columns, spread, with_date_column
from clickweave.functions.schema import to_schema
from clickweave.operators import analytics, quality
from clickweave.operators.row_ops import apply_steps
from clickweave.operators.sessions import count_unusable, detect_sessions, rollup_sessions
from clickweave.plans import jobs
from clickweave.plans.inputs import click_messages, clicks, scratch, table
from clickweave.plans.registry import query
from clickweave.plans.session_queries import LIMITS, page_activity
from clickweave.plans.sql_parts import BIN_SESSIONS, ROLLUP_COLUMNS
from clickweave.sinks.files import write_files
from clickweave.sinks.streams import kafka_payload
from clickweave.sinks.tables import (
    SESSION_TABLE_PROPERTIES,
    ensure_table,
    table_columns,
    table_partitions,
    table_properties,
    write_table,
)
from clickweave.sources.files import read_files, read_table

# Sources and sinks -------------------------------------------------------------------------


@query("scan_files", "SELECT event_id, (epoch_us(ts) // 1000) AS ms, user_id, event_type, value, props FROM events")
def scan_files(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.withColumn("ms", F.unix_millis(F.col("ts").cast("timestamp"))).drop("ts")


def _saved(spark, df, label, **layout):
    """Save a table under the shared folder and return its catalog name."""
    path = scratch(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    write_table(df, name, "create", location=path, **layout)
    return name


@query("table_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def table_scan(spark, sf_dir):
    name = _saved(spark, table(spark, sf_dir, "orders"), "orders_table")
    return read_table(spark, name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


CLICK_FIELDS = """
    CAST(event_id AS VARCHAR) AS event_id, event_type AS page_name,
    CAST((epoch_us(ts) // 1000) AS VARCHAR) AS event_timestamp,
    json_extract_string(props, '$.k') AS booking_k, CAST(user_id AS VARCHAR) AS uuid,
    'user-' || event_type AS event_name"""


def _click_columns(events):
    return events.select(
        "event_id",
        "page_name",
        "event_timestamp",
        F.col("booking_details")["k"].alias("booking_k"),
        "uuid",
        F.col("event_details.event_name").alias("event_name"),
    )


@query("envelope_roundtrip", f"SELECT {CLICK_FIELDS} FROM events")
def envelope_roundtrip(spark, sf_dir):
    messages = click_messages(table(spark, sf_dir, "events"))
    return _click_columns(parse_json(messages, jobs.CLICKSTREAM_SCHEMA, keep_value=False))


@query("write_read_files", "SELECT event_id, user_id, event_type, value, props FROM events")
def write_read_files(spark, sf_dir):
    """Round trip through JSON files partitioned by event type."""
    path = scratch(spark, "files")
    events = table(spark, sf_dir, "events").drop("ts")
    write_files(events, path, "json", partition_by=["event_type"])
    return read_files(spark, path, "json", schema=events.schema).select(
        "event_id", "user_id", "event_type", "value", "props"
    )


@query(
    "write_read_csv",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def write_read_csv(spark, sf_dir):
    path = scratch(spark, "csv")
    customer = table(spark, sf_dir, "customer")
    write_files(customer, path, "csv", options={"header": "true"})
    return read_files(spark, path, "csv", schema=customer.schema, options={"header": "true"})


@query("write_read_orc", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def write_read_orc(spark, sf_dir):
    path = scratch(spark, "orc")
    write_files(table(spark, sf_dir, "part"), path, "orc")
    return read_files(spark, path, "orc")


@query("write_read_text", "SELECT props AS value FROM events")
def write_read_text(spark, sf_dir):
    path = scratch(spark, "text")
    write_files(table(spark, sf_dir, "events").select(F.col("props").alias("value")), path, "text")
    return read_files(spark, path, "text")


@query("table_append", "SELECT event_id, user_id, event_type FROM events")
def table_append(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    name = _saved(spark, events.filter("event_type = 'click'"), "append")
    write_table(events.filter("event_type <> 'click'"), name, "append")
    return spark.table(name)


@query(
    "table_overwrite_partitions",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN value + 1 ELSE value END AS value,
        event_type FROM events""",
)
def table_overwrite_partitions(spark, sf_dir):
    """Only the partitions present in the new rows are replaced."""
    events = table(spark, sf_dir, "events").select("event_id", "value", "event_type")
    name = _saved(spark, events, "overwrite", partition_by=["event_type"])
    changed = events.filter("event_type IN ('click', 'view')").withColumn("value", F.col("value") + 1)
    write_table(changed, name, "overwrite")
    return spark.table(name)


@query(
    "table_merge_schema",
    """SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value FROM events""",
)
def table_merge_schema(spark, sf_dir):
    """Later rows bring a column that the table lacks."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    name = _saved(spark, events.filter("event_type = 'click'").drop("value"), "merge")
    write_table(events.filter("event_type <> 'click'"), name, "append", merge_schema=True)
    return spark.table(name)


@query(
    "table_metadata",
    "SELECT * FROM (VALUES ('event_id', 'bigint'), ('event_type', 'string'), ('kept', 'yes')) AS t(name, value)",
)
def table_metadata(spark, sf_dir):
    """Columns and an own property, as the catalog has them."""
    name = _saved(spark, table(spark, sf_dir, "events").select("event_id", "event_type"), "meta")
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('kept' = 'yes')")
    columns = table_columns(spark, name).select(F.col("col_name").alias("name"), F.col("data_type").alias("value"))
    return columns.union(table_properties(spark, name).filter("key = 'kept'").select("key", "value"))


@query(
    "job_rejects",
    """SELECT CAST(event_id AS VARCHAR) AS event_id,
        CASE WHEN event_id % 7 = 0 THEN 'no user' ELSE 'no readable time' END AS reason
    FROM events WHERE event_id % 7 = 0 OR event_id % 5 = 0""",
)
def job_rejects(spark, sf_dir):
    """Every seventh event loses its user, every fifth gets a time beyond the year 9999."""
    events = table(spark, sf_dir, "events")
    messages = click_messages(events)
    fields = F.from_json("value", "event_id STRING, page_name STRING, event_timestamp STRING, uuid STRING")
    number = F.col("f.event_id").cast("bigint")
    broken = F.struct(
        "f.event_id",
        "f.page_name",
        F.when(number % 5 == 0, F.lit("300000000000000")).otherwise(F.col("f.event_timestamp")).alias("event_timestamp"),
        F.when(number % 7 != 0, F.col("f.uuid")).alias("uuid"),
    )
    messages = messages.withColumn("f", fields).withColumn("value", F.to_json(broken)).drop("f")
    path = scratch(spark, "rejects")
    jobs.sessions_batch(
        messages,
        lambda df: df.write.format("noop").mode("overwrite").save(),
        rejects=lambda df: df.write.parquet(path),
        **LIMITS,
    )
    found = read_files(spark, path)
    return found.select(F.get_json_object("value", "$.event_id").alias("event_id"), "reason")


@query("table_replace", "SELECT event_type, count(*) AS event_count FROM events GROUP BY event_type")
def table_replace(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    name = _saved(spark, events.select("event_id", "event_type"), "replace")
    counts = analytics.counts_by(events, "event_type")
    write_table(counts, name, "replace", location=scratch(spark, "replaced"))
    return spark.table(name)


def _by_day(spark, sf_dir):
    sessions = add_layout_columns(detect_sessions(clicks(spark, sf_dir), **LIMITS))
    return sessions.select("uuid", "event_id", "session_id", "user_hash_bucket", "session_date")


@query(
    "table_partitions",
    f"""{BIN_SESSIONS} SELECT DISTINCT 'session_date=' || strftime(epoch_ms(s), '%Y-%m-%d') AS partition
    FROM sess""",
)
def partitions(spark, sf_dir):
    name = _saved(spark, _by_day(spark, sf_dir), "by_day", partition_by=["session_date"])
    return table_partitions(spark, name)


@query(
    "date_partition_column",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders""",
)
def date_partition_column(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    dated = with_date_column(orders, F.col("o_orderdate"), "order_day").drop("o_orderdate")
    return dated.withColumn("order_day", F.col("order_day").cast("string"))


@query(
    "kafka_payload",
    """SELECT CAST(user_id AS VARCHAR) AS key,
        '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value
    FROM events""",
)
def payload(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return kafka_payload(events, key="user_id")


# JSON and time -----------------------------------------------------------------------------


@query("json_parse", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_parse(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return parse_json(events, {"k": "bigint"}, "props", keep_value=False)


SCHEMA_FORMS = {
    "names": {"k": "bigint"},
    "fields": [{"name": "k", "type": "bigint", "nullable": True}],
    "ddl": "k BIGINT",
    "json": '{"type": "struct", "fields": [{"name": "k", "type": "long", "nullable": true, "metadata": {}}]}',
}


@query(
    "json_schema_forms",
    "SELECT event_id, form, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k"
    " FROM events, (VALUES ('names'), ('fields'), ('ddl'), ('json')) AS f(form)",
)
def json_schema_forms(spark, sf_dir):
    """The same messages parsed by every way to write their schema."""
    events = table(spark, sf_dir, "events").select("event_id", "props")
    parsed = [parse_json(events.withColumn("form", F.lit(form)), spec, "props", keep_value=False) for form, spec in SCHEMA_FORMS.items()]
    return reduce(lambda a, b: a.unionByName(b), parsed)


@query(
    "json_variant",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,"
    " CAST(NULL AS VARCHAR) AS missing FROM events",
)
def json_variant(spark, sf_dir):
    """Fields nobody declared, read from one parse of the text."""
    events = parse_variant(table(spark, sf_dir, "events").select("event_id", "props"), "props")
    fields = {"k": ("$.k", "bigint"), "k_text": ("$.k", "string"), "missing": ("$.a.b[0]", "string")}
    return variant_fields(events, fields).select("event_id", *fields)


@query(
    "json_schema_found",
    """SELECT 'OBJECT<' || array_to_string(list_sort(list(DISTINCT key || ': ' || kind)), ', ') || '>' AS schema,
        (SELECT count(props) FROM events) AS parsed, 0::BIGINT AS malformed
    FROM (SELECT unnest(json_keys(props)) AS key,
                 CASE json_type(props, '$.' || unnest(json_keys(props)))
                   WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' ELSE json_type(props, '$.' || unnest(json_keys(props))) END AS kind
          FROM events)""",
)
def json_schema_found(spark, sf_dir):
    return found_schema(table(spark, sf_dir, "events"), "props")


@query("json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return extract_fields(events, ["k"], "props").select("event_id", "k")


@query(
    "json_parse_meta",
    f"SELECT {CLICK_FIELDS}, (epoch_us(ts) // 1000) AS kafka_ms, true AS stamped FROM events",
)
def json_parse_meta(spark, sf_dir):
    messages = click_messages(table(spark, sf_dir, "events"))
    parsed = with_processing_time(parse_json(messages, jobs.CLICKSTREAM_SCHEMA))
    return parsed.select(
        *_click_columns(parsed).columns[:3],
        F.col("booking_details")["k"].alias("booking_k"),
        "uuid",
        F.col("event_details.event_name").alias("event_name"),
        F.unix_millis("kafka_timestamp").alias("kafka_ms"),
        F.col("processing_time").isNotNull().alias("stamped"),
    )


@query(
    "json_malformed",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
            ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
        CASE WHEN event_type = 'error' THEN 'broken ' || props END AS bad_text
    FROM events""",
)
def json_malformed(spark, sf_dir):
    """Error events carry text that is no JSON: fields turn null and the text is kept apart."""
    events = table(spark, sf_dir, "events")
    broken = F.when(F.col("event_type") == "error", F.concat(F.lit("broken "), "props")).otherwise(
        F.col("props")
    )
    messages = events.select("event_id", broken.alias("value"))
    return parse_json(messages, {"k": "bigint"}, keep_value=False, corrupt_column="bad_text")


@query(
    "parse_timestamp",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
        ELSE epoch_ms(date_trunc('second', ts)) END AS ms FROM events""",
)
def parse_timestamp_query(spark, sf_dir):
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy/MM/dd HH:mm:ss")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", "no time").otherwise(text).alias("t")
    )
    parsed = parse_timestamp(events, "t", "yyyy/MM/dd HH:mm:ss")
    return parsed.select("event_id", F.unix_millis("t").alias("ms"))


MIXED_TIMES = """
    CASE event_type WHEN 'click' THEN (epoch_us(ts) // 1000)
        WHEN 'view' THEN epoch_ms(date_trunc('second', ts)) WHEN 'error' THEN NULL
        ELSE (epoch_us(ts) // 1000) END"""


def _mixed_times(spark, sf_dir):
    """Events whose time is epoch text, ISO text or unreadable, depending on their type."""
    time = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("uuid"),
        F.when(F.col("event_type") == "view", F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("event_type") == "error", F.lit("soon"))
        .otherwise(F.unix_millis(time).cast("string"))
        .alias("event_timestamp"),
    )


@query("event_time_normalise", f"SELECT event_id, {MIXED_TIMES} AS event_time_ms FROM events")
def event_time_normalise(spark, sf_dir):
    return normalise_event_time(_mixed_times(spark, sf_dir)).select("event_id", "event_time_ms")


@query(
    "event_time_seconds",
    f"SELECT event_id, ({MIXED_TIMES}) // 1000 * 1000 AS event_time_ms FROM events",
)
def event_time_seconds(spark, sf_dir):
    whole = normalise_event_time(_mixed_times(spark, sf_dir), truncate_to_seconds=True)
    return whole.select("event_id", "event_time_ms")


@query(
    "unusable_events",
    "SELECT count(*) FILTER (WHERE user_id IS NULL) AS null_user,"
    " count(*) FILTER (WHERE event_type = 'error') AS null_time, count(*) AS total FROM events",
)
def unusable(spark, sf_dir):
    return count_unusable(normalise_event_time(_mixed_times(spark, sf_dir)))


# Row steps ---------------------------------------------------------------------------------


@query("row_filter", "SELECT event_id, event_type, value FROM events WHERE value > 20 AND event_type <> 'view'")
def row_filter(spark, sf_dir):
    steps = [{"filter": "value > 20 AND event_type <> 'view'"}, "select: event_id, event_type, value"]
    return apply_steps(table(spark, sf_dir, "events"), steps)


@query("row_select", "SELECT event_id, upper(event_type) AS kind FROM events")
def row_select(spark, sf_dir):
    return apply_steps(table(spark, sf_dir, "events"), [{"select": ["event_id", "upper(event_type) AS kind"]}])


@query(
    "row_select_text",
    """SELECT event_id, concat(event_type, ', ', upper(trim(event_type))) AS label,
        CASE WHEN user_id IN (1, 2, 3) THEN 'few' ELSE 'rest' END AS kind FROM events""",
)
def row_select_text(spark, sf_dir):
    text = (
        "select: event_id, concat(event_type, ', ', upper(trim(event_type))) AS label,"
        " CASE WHEN array_contains(array(1, 2, 3), user_id) THEN 'few' ELSE 'rest' END AS kind"
    )
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id").cast("int"))
    return apply_steps(events, [text])


@query("row_drop", "SELECT event_id, user_id, event_type FROM events")
def row_drop(spark, sf_dir):
    return apply_steps(table(spark, sf_dir, "events"), [{"drop": ["ts", "value", "props", "absent"]}])


@query("row_rename", "SELECT n_nationkey AS id, n_name AS country FROM nation")
def row_rename(spark, sf_dir):
    steps = [{"select": ["n_nationkey", "n_name"]}, {"rename": {"n_nationkey": "id", "n_name": "country"}}]
    return apply_steps(table(spark, sf_dir, "nation"), steps)


@query("row_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def row_distinct(spark, sf_dir):
    return apply_steps(table(spark, sf_dir, "events"), [{"select": ["user_id", "event_type"]}, "distinct"])


@query("row_top_n", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 10")
def row_top_n(spark, sf_dir):
    steps = [
        {"select": ["event_id", "user_id", "value"]},
        {"limit": 10, "order_by": ["value DESC NULLS LAST", "event_id"]},
    ]
    return apply_steps(table(spark, sf_dir, "events"), steps)


@query(
    "row_group_agg",
    """SELECT l_returnflag, count(l_linenumber) AS l_linenumber_count,
        CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber_sum, max(l_linenumber) AS l_linenumber_max,
        min(l_linenumber) AS l_linenumber_min, round(avg(l_linenumber), 6) AS l_linenumber_avg
    FROM lineitem GROUP BY l_returnflag""",
)
def row_group_agg(spark, sf_dir):
    functions = ["count", "sum", "max", "min", "avg"]
    steps = [{"groupBy": ["l_returnflag"], "agg": {"l_linenumber": functions}}]
    result = apply_steps(table(spark, sf_dir, "lineitem"), steps)
    return result.withColumn("l_linenumber_avg", F.round("l_linenumber_avg", 6))


@query(
    "row_group_window",
    """SELECT (epoch_us(ts) // 1000) // 3600000 * 3600000 AS window_start_ms, count(event_id) AS event_id_count
    FROM events GROUP BY 1""",
)
def row_group_window(spark, sf_dir):
    steps = [
        {"select": ["event_id", "CAST(ts AS TIMESTAMP) AS at"]},
        {"watermark": "at, 10 minutes"},
        {"groupBy": ["window(at, '1 hour')"], "agg": {"event_id": "count"}},
        {"select": ["unix_millis(window.start) AS window_start_ms", "event_id_count"]},
    ]
    return apply_steps(table(spark, sf_dir, "events"), steps)


@query("row_sql", "SELECT event_type, min(value) AS low FROM events WHERE user_id IS NOT NULL GROUP BY event_type")
def row_sql(spark, sf_dir):
    steps = [
        {"type": "create_view", "name": "input_data"},
        {"type": "sql_query", "query": "SELECT * FROM input_data WHERE user_id IS NOT NULL"},
        {"sql_query": "SELECT event_type, min(value) AS low FROM {df} GROUP BY event_type"},
    ]
    return apply_steps(table(spark, sf_dir, "events"), steps)


@query(
    "row_chain",
    "SELECT c_custkey AS id, c_acctbal * 2 AS doubled FROM customer WHERE c_acctbal > 0",
)
def row_chain(spark, sf_dir):
    """Steps and a plain function in one chain."""
    steps = [
        "filter: c_acctbal > 0",
        lambda df: df.withColumn("doubled", F.col("c_acctbal") * 2),
        {"rename": {"c_custkey": "id"}},
        {"select": ["id", "doubled"]},
    ]
    return apply_steps(table(spark, sf_dir, "customer"), steps)


# Quality -----------------------------------------------------------------------------------

PEOPLE = """
people AS (
    SELECT CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS id, c_name AS name,
        CAST(floor(c_acctbal / 50) AS INTEGER) AS age,
        CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name
             ELSE lower(c_mktsegment) || '@example.com' END AS email
    FROM customer
)"""


def _people(spark, sf_dir):
    return as_people(table(spark, sf_dir, "customer"))


def as_people(customers):
    """Customers as people, some with no id, an impossible age or a malformed address."""
    return customers.selectExpr(
        "CASE WHEN c_nationkey = 0 THEN NULL ELSE c_custkey END AS id",
        "c_name AS name",
        "CAST(floor(c_acctbal / 50) AS INT) AS age",
        "CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name"
        " ELSE concat(lower(c_mktsegment), '@example.com') END AS email",
    )


EXPECTED = {
    "not_null": ["id"],
    "ranges": {"age": {"min": 0, "max": 150}},
    "allowed": {"email": ["building@example.com", "household@example.com"]},
}
REPORT_SQL = f"""WITH {PEOPLE}, n AS (SELECT count(*) AS row_count,
        count(*) FILTER (WHERE id IS NULL) AS no_id,
        count(*) FILTER (WHERE age < 0 OR age > 150) AS bad_age,
        count(*) FILTER (WHERE email NOT IN ('building@example.com', 'household@example.com')) AS bad_email
        FROM people)
    SELECT 'min_rows' AS check_name, '*' AS column_name, greatest(1000000 - row_count, 0) AS violations,
        row_count FROM n
    UNION ALL SELECT 'not_null', 'id', no_id, row_count FROM n
    UNION ALL SELECT 'range', 'age', bad_age, row_count FROM n
    UNION ALL SELECT 'allowed', 'email', bad_email, row_count FROM n"""


@query("dq_report", REPORT_SQL)
def dq_report(spark, sf_dir):
    return quality.quality_report(_people(spark, sf_dir), min_rows=1_000_000, **EXPECTED)


@query(
    "dq_unique",
    """SELECT 'event_id' AS column_name, count(*) AS row_count, count(DISTINCT event_id) AS distinct_count,
        count(*) - count(DISTINCT event_id) AS duplicates FROM events
    UNION ALL SELECT 'user_id', count(*), count(DISTINCT user_id), count(*) - count(DISTINCT user_id) FROM events""",
)
def dq_unique(spark, sf_dir):
    return quality.uniqueness_report(table(spark, sf_dir, "events"), ["event_id", "user_id"])


@query(
    "dq_duplicates",
    "SELECT user_id, count(*) AS occurrences FROM events GROUP BY user_id HAVING count(*) > 1",
)
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_values(table(spark, sf_dir, "events"), "user_id")


@query(
    "dq_allowed",
    "SELECT event_type, count(*) AS occurrences FROM events"
    " WHERE event_type NOT IN ('click', 'view') GROUP BY event_type",
)
def dq_allowed(spark, sf_dir):
    return quality.disallowed_values(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


PERSON_TEST = "id IS NOT NULL AND age BETWEEN 0 AND 150 AND regexp_matches(email, '^[^@]+@[^@]+\\.[^@]+$')"


@query("dq_clean", f"WITH {PEOPLE} SELECT id, name, age, email FROM people WHERE {PERSON_TEST}")
def dq_clean(spark, sf_dir):
    return quality.clean_rows(_people(spark, sf_dir))


@query(
    "dq_rejects",
    f"""WITH {PEOPLE} SELECT id, name, age, email,
        CASE WHEN id IS NULL THEN 'missing id'
             WHEN age IS NULL OR age NOT BETWEEN 0 AND 150 THEN 'age out of range' ELSE 'bad email' END AS reject_reason
    FROM people WHERE NOT coalesce({PERSON_TEST}, false)""",
)
def dq_rejects(spark, sf_dir):
    return quality.rejected_rows(_people(spark, sf_dir))


@query(
    "cleanse",
    """SELECT DISTINCT c_nationkey AS nation, trim(' ' || c_mktsegment || ' ') AS segment,
        strftime(TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * c_nationkey, '%Y-%m-%d %H:%M:%S') AS at_formatted,
        true AS stamped
    FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def cleanse(spark, sf_dir):
    """Customers reduced to nation and segment, with duplicates, nulls and padded text."""
    dirty = table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey AS nation",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN concat(' ', c_mktsegment, ' ') END AS segment",
        "CAST(date_add(DATE'2024-01-01', c_nationkey) AS TIMESTAMP) AS at",
    )
    cleaned = quality.cleanse(dirty, timestamp_column="at")
    return cleaned.select(
        "nation", "segment", "at_formatted", F.col("processing_timestamp").isNotNull().alias("stamped")
    )


@query("dq_required", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def dq_required(spark, sf_dir):
    """A table that meets every declared expectation passes unchanged; one that does not would raise."""
    suppliers = table(spark, sf_dir, "supplier")
    types = {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"}
    checked = quality.require_types(quality.require_columns(suppliers, list(types)), types)
    checked = quality.require_schema(checked, to_schema(types))
    return quality.enforce(checked, min_rows=1, not_null=list(types), ranges={"s_nationkey": {"min": 0, "max": 24}})


@query(
    "spread_by_user",
    "SELECT user_id, 1::BIGINT AS partitions, count(*) AS event_count FROM events GROUP BY user_id",
)
def spread_by_user(spark, sf_dir):
    """After a repartition by user each user's events are in one partition, all of them."""
    placed = spread(table(spark, sf_dir, "events"), ["user_id"], 7).select("user_id", F.spark_partition_id().alias("place"))
    return placed.groupBy("user_id").agg(F.count_distinct("place").alias("partitions"), F.count(F.lit(1)).alias("event_count"))


@query("table_created_once", "SELECT event_id, user_id, event_type, 'zstd' AS codec FROM events")
def table_created_once(spark, sf_dir):
    """A table created with its properties if it is absent; the second time changes nothing."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path = scratch(spark, "created_once")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    layout = {"partition_by": ["event_type"], "properties": SESSION_TABLE_PROPERTIES, "location": path}
    made = [ensure_table(spark, name, events.schema, **layout) for _ in range(2)]
    if made != [True, False]:
        raise ValueError(f"the table should be made once: {made}")
    write_table(events, name, "append", ["event_type"])
    key = "write.parquet.compression-codec"
    codec = table_properties(spark, name).filter(F.col("key") == key).select(F.col("value").alias("codec"))
    return spark.table(name).join(F.broadcast(codec)).select("event_id", "user_id", "event_type", "codec")


@query(
    "dataset_info",
    "SELECT count(*) AS row_count, 4::BIGINT AS partition_count, CAST(5 AS INTEGER) AS column_count, 'struct<c_custkey:bigint,c_name:string,"
    "c_nationkey:int,c_acctbal:double,c_mktsegment:string>' AS schema_text FROM customer",
)
def dataset_info(spark, sf_dir):
    """Dealt to four partitions first, as the number of a scan's partitions depends on the cluster."""
    return quality.dataset_info(table(spark, sf_dir, "customer").repartition(4, "c_custkey"))


# Jobs --------------------------------------------------------------------------------------


@query("job_sessions_batch", f"{BIN_SESSIONS} SELECT {ROLLUP_COLUMNS} FROM sess GROUP BY uuid, session_id")
def job_sessions_batch(spark, sf_dir):
    """Messages to sessionised rows in a table partitioned by date, then rolled up."""
    path = scratch(spark, "job_sessions")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    jobs.sessions_batch(
        click_messages(table(spark, sf_dir, "events")),
        lambda df: write_table(df, name, "create", ["session_date"], location=path),
        **LIMITS,
    )
    return rollup_sessions(read_table(spark, name))


@query(
    "job_filter_files",
    "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 25",
)
def job_filter_files(spark, sf_dir):
    path = scratch(spark, "job_filter")
    jobs.filter_files(
        spark,
        f"{sf_dir}/customer.parquet",
        path,
        predicate="c_acctbal > 25",
        columns=["c_custkey", "c_name", "c_acctbal"],
    )
    return read_files(spark, path)


@query("job_quality_files", f"WITH {PEOPLE} SELECT id, name, age, email FROM people WHERE {PERSON_TEST}")
def job_quality_files(spark, sf_dir):
    source, target = scratch(spark, "people"), scratch(spark, "job_quality")
    write_files(_people(spark, sf_dir), source)
    jobs.quality_files(spark, source, target)
    return read_files(spark, target)


@query(
    "job_windowed_activity",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS session_id,
        (epoch_us(ts) // 1000) // 1800000 * 1800000 AS window_start_ms,
        strftime(epoch_ms((epoch_us(ts) // 1000) // 1800000 * 1800000), '%Y-%m-%d') AS window_day,
        CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS duration_seconds_sum,
        count(*) AS page_count
    FROM events GROUP BY 1, 2, 3, 4""",
)
def job_windowed_activity(spark, sf_dir):
    pages = page_activity(table(spark, sf_dir, "events")).withColumn("session_id", F.col("page"))
    messages = pages.select(F.to_json(F.struct(*pages.columns)).alias("value"))
    report = jobs.activity_windows(messages)
    return report.select(
        "user_id",
        "session_id",
        F.unix_millis("window.start").alias("window_start_ms"),
        F.col("window_date").cast("string").alias("window_day"),
        "duration_seconds_sum",
        "page_count",
    )


@query(
    "job_typed_events",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
        (epoch_us(ts) // 1000) AS ms, CAST(json_extract_string(props, '$.k') AS INTEGER) AS duration_ms,
        strftime(ts, '%Y-%m-%d') AS event_day
    FROM events""",
)
def job_typed_events(spark, sf_dir):
    events = jobs.typed_events(user_event_messages(table(spark, sf_dir, "events")), by_date=True)
    return events.select(
        "event_id",
        "event_type",
        "user_id",
        F.unix_millis("timestamp").alias("ms"),
        "duration_ms",
        F.col("event_date").cast("string").alias("event_day"),
    )


def user_event_messages(events):
    """Events as messages of the user-event job."""
    rows = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.col("user_id").cast("string").alias("user_id"),
        F.date_format(F.col("ts").cast("timestamp"), jobs.USER_EVENT_TIME).alias("timestamp"),
        F.get_json_object("props", "$.k").cast("int").alias("duration_ms"),
    )
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
