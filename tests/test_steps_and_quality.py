import pytest
from pyspark.sql import functions as F

from clickweave.operators import quality
from clickweave.operators.row_ops import apply_steps
from clickweave.plans import jobs
from clickweave.sinks.files import write_files

PEOPLE = [
    (1, "Ann", 22, "ann@example.com", "A"),
    (2, "Bob", 35, "bob@example.com", "B"),
    (3, "Cy", 41, "bad", "A"),
    (None, "Di", 30, "di@example.com", "B"),
    (5, "Ed", 200, "ed@example.com", "A"),
]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "id int, name string, age int, email string, department string")


def test_text_and_dict_steps_agree(people):
    text = apply_steps(people, ["filter: age > 25", "select: id, concat(name, '!') AS n", "distinct"])
    dicts = apply_steps(
        people,
        [{"filter": "age > 25"}, {"select": ["id", "concat(name, '!') AS n"]}, {"distinct": True}],
    )
    assert sorted(map(str, text.collect())) == sorted(map(str, dicts.collect()))
    assert text.count() == 4


def test_group_step(people):
    steps = [{"groupBy": ["department"], "agg": {"age": ["max", "min"], "id": "count"}}]
    rows = {r.department: (r.age_max, r.age_min, r.id_count) for r in apply_steps(people, steps).collect()}
    assert rows == {"A": (200, 22, 3), "B": (35, 30, 1)}


def test_limit_with_order(people):
    steps = [{"limit": 2, "order_by": ["age desc", "id"]}, {"select": ["age"]}]
    assert [r.age for r in apply_steps(people, steps).collect()] == [200, 41]


def test_no_steps_and_chained_functions(people):
    assert apply_steps(people, []) is people
    doubled = apply_steps(people, [lambda d: d.withColumn("x", F.col("age") * 2), {"filter": "x > 70"}])
    assert {r.x for r in doubled.collect()} == {82, 400}


@pytest.mark.parametrize(
    "step", ["explode: a", {"pivot": "a"}, "filter", {"groupBy": ["id"], "agg": {"age": "median"}}]
)
def test_unknown_steps_raise(people, step):
    with pytest.raises(ValueError):
        apply_steps(people, [step])


def test_report_counts_all_checks_in_one_job(people):
    report = quality.quality_report(
        people,
        min_rows=6,
        not_null=["id", "name"],
        ranges={"age": {"min": 25, "max": 150}, "id": {"max": 4}},
        allowed={"department": ["A"]},
    )
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1
    found = {(r.check_name, r.column_name): r.violations for r in report.collect()}
    assert found == {
        ("min_rows", "*"): 1,
        ("not_null", "id"): 1,
        ("not_null", "name"): 0,
        ("range", "age"): 2,
        ("range", "id"): 1,
        ("allowed", "department"): 2,
    }


def test_enforce(people):
    assert quality.enforce(people, not_null=["name"], min_rows=5) is people
    with pytest.raises(quality.QualityError, match=r"not_null\(id\): 1"):
        quality.enforce(people, not_null=["id"])


def test_schema_checks(people):
    quality.require_columns(people, ["id"])
    quality.require_types(people, {"id": "int", "name": "string"})
    quality.require_schema(people, people.schema)
    with pytest.raises(quality.QualityError):
        quality.require_columns(people, ["phone"])
    with pytest.raises(quality.QualityError):
        quality.require_types(people, {"id": "bigint"})
    with pytest.raises(quality.QualityError):
        quality.require_schema(people, people.select("id").schema)


def test_uniqueness(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id int, value string")
    report = {r.column_name: r.duplicates for r in quality.uniqueness_report(frame, ["id", "value"]).collect()}
    assert report == {"id": 0, "value": 1}
    assert quality.duplicate_values(frame, "value").collect() == [("a", 2)]
    assert quality.disallowed_values(frame, "value", ["b"]).collect() == [("a", 2)]


def test_uniqueness_of_times_within_a_millisecond(spark):
    texts = ["2024-01-01 00:00:00.123456", "2024-01-01 00:00:00.123457", "2024-01-01 00:00:00.123457", "-0001-01-01 00:00:00", "0002-01-01 00:00:00", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(
        "cast(t AS timestamp) AS z", "cast(t AS timestamp_ntz) AS n", "cast(t AS date) AS d", "array(cast(t AS timestamp)) AS a"
    )
    report = {r.column_name: (r.row_count, r.distinct_count) for r in quality.uniqueness_report(frame, frame.columns).collect()}
    counted = {c: (6, frame.select(c).distinct().count()) for c in frame.columns}
    assert report == counted == {"z": (6, 5), "n": (6, 5), "d": (6, 4), "a": (6, 5)}


def test_clean_and_rejected_rows_partition_the_table(people):
    clean, rejected = quality.clean_rows(people), quality.rejected_rows(people)
    assert {r.id for r in clean.collect()} == {1, 2}
    assert {(r.name, r.reject_reason) for r in rejected.collect()} == {
        ("Cy", "bad email"),
        ("Di", "missing id"),
        ("Ed", "age out of range"),
    }


def test_cleanse(spark):
    rows = [
        (1, " Ann ", 22, "2024-01-01 10:00:00"),
        (2, "Bob", None, "2024-01-01 11:00:00"),
        (3, "Cy", 41, "2024-01-01 12:00:00"),
        (3, "Cy", 41, "2024-01-01 12:00:00"),
        (4, "Di", 33, "2024-01-01 13:00:00"),
    ]
    frame = spark.createDataFrame(rows, "id int, name string, age int, t string")
    cleaned = quality.cleanse(frame.withColumn("t", F.to_timestamp("t")), timestamp_column="t")
    found = {(r.id, r.name, r.t_formatted) for r in cleaned.collect()}
    assert found == {
        (1, "Ann", "2024-01-01 10:00:00"),
        (3, "Cy", "2024-01-01 12:00:00"),
        (4, "Di", "2024-01-01 13:00:00"),
    }


def test_dataset_info(people):
    info = quality.dataset_info(people.repartition(2)).first()
    assert (info.row_count, info.column_count) == (5, 5)
    assert 1 <= info.partition_count <= 2


def test_file_jobs(spark, people, tmp_path):
    source, target, checked = (str(tmp_path / n) for n in ("in", "out", "checked"))
    write_files(people, source, "csv", options={"header": "true"})
    options = {"header": "true", "inferSchema": "true"}
    jobs.filter_files(spark, source, target, "csv", "parquet", predicate="age > 25", source_options=options)
    assert spark.read.parquet(target).count() == 4
    jobs.filter_files(spark, source, target, "csv", source_options=options)
    assert spark.read.parquet(target).count() == 5
    jobs.quality_files(spark, source, checked, "csv", source_options=options)
    assert spark.read.parquet(checked).count() == 2
