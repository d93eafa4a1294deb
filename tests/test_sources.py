"""CSV logs: types, missing cells, time, machine, row order; versioned artifacts."""

import csv
import io

import pytest
from gearwatch.options import LogOptions
from gearwatch.plans.data_job import ingest_pipeline
from gearwatch.session import fresh_path, run_folder, written
from gearwatch.sources import artifacts, csv_records
from gearwatch.sources.files import exists
from gearwatch.sources.sensor_log import read_csv_log, sort_by_time
from pyspark.sql import functions as F

O = LogOptions()


def write(path, text):
    path.write_text(text)
    return str(path)


def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_csv_log(spark, str(tmp_path / "none.csv"), O)


def test_types_and_missing_cells(spark, tmp_path):
    path = write(
        tmp_path / "log.csv",
        "timestamp,machine_id,a,b,ok,name\n"
        "2024-01-01 00:00:00,M1,1,NA,True,x\n"
        "not a time,M1,2,2.5,False,null\n"
        "2024-01-01T01:00:00.123456,M2,,nan,,y\n",
    )
    df = read_csv_log(spark, path, O)
    assert dict(df.dtypes) == {
        "seq": "bigint", "timestamp": "timestamp", "machine_id": "string", "a": "bigint", "b": "double",
        "ok": "boolean", "name": "string",
    }
    rows = df.orderBy("seq").collect()
    assert [r["seq"] for r in rows] == [0, 1, 2]
    assert rows[1]["timestamp"] is None and rows[2]["timestamp"].microsecond == 123456
    assert [r["a"] for r in rows] == [1, 2, None]
    assert [r["b"] for r in rows] == [None, 2.5, None]
    assert [r["name"] for r in rows] == ["x", None, "y"]


def test_given_schema(spark, tmp_path):
    path = write(tmp_path / "log.csv", "timestamp,machine_id,a\n2024-01-01,M1,7\n2024-01-02,M1,bad\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("timestamp", T.StringType())])
    rows = read_csv_log(spark, path, O, schema).orderBy("seq").collect()
    assert [r["a"] for r in rows] == [7.0, None]


@pytest.mark.parametrize(
    "header,expected", [("Product ID", "7"), ("id", "7"), ("unknown", "machine_1")]
)
def test_machine_and_clock(spark, tmp_path, header, expected):
    path = write(tmp_path / "log.csv", f"{header},a\n7,1.5\n7,2.5\n")
    rows = read_csv_log(spark, path, O).withColumn("us", F.unix_micros("timestamp")).orderBy("seq").collect()
    assert [r["machine_id"] for r in rows] == [expected] * 2
    assert [str(r["timestamp"]) for r in rows] == ["2024-01-01 00:00:00", "2024-01-01 01:00:00"]


def test_row_order_over_many_files(spark, tmp_path):
    for part in range(4):
        write(tmp_path / f"part-{part}.csv", "a\n" + "".join(f"{part * 10 + i}\n" for i in range(10)))
    rows = read_csv_log(spark, str(tmp_path), O).orderBy("seq").collect()
    assert [r["a"] for r in rows] == list(range(40))
    assert [r["seq"] for r in rows] == list(range(40))


def test_untimed_rows_are_rejected(spark, tmp_path):
    path = write(tmp_path / "log.csv", "timestamp,machine_id,a\n2024-01-01,M1,1\nx,M1,2\n,M1,3\n")
    good, bad = ingest_pipeline(spark, path, O)
    assert good.count() == 1
    assert {r["a"] for r in bad.collect()} == {2, 3}


def test_sort(spark):
    df = spark.createDataFrame(
        [("b", None, 0), ("b", "2024-01-02", 1), ("a", "2024-01-03", 2), ("b", "2024-01-01", 3)],
        "machine_id string, timestamp string, seq long",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert [r["seq"] for r in sort_by_time(df, O).collect()] == [2, 3, 1, 0]
    with pytest.raises(ValueError):
        sort_by_time(df.drop("timestamp"), O)


def test_versions(spark, tmp_path):
    base = str(tmp_path / "sets")
    a, b = spark.range(3), spark.range(5)
    with pytest.raises(FileNotFoundError):
        artifacts.load_dataset(spark, base)
    assert artifacts.save_datasets(a, b, base, "20240101_000000", "csv")[0].endswith("split=train")
    artifacts.save_datasets(a, b, base, "20240101_000000")
    artifacts.save_datasets(b, a, base, "20240301_000000", "both")
    assert artifacts.load_dataset(spark, base, "test").count() == 3
    old = f"{base}/parquet/version=20240101_000000/split=test"
    assert artifacts.load_dataset(spark, base, path=old).count() == 5
    with pytest.raises(ValueError):
        artifacts.save_datasets(a, b, base, format="avro")


def test_a_stop_on_the_way_leaves_the_committed_version(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "sets")
    a, b = spark.range(3), spark.range(5)
    artifacts.save_datasets(a, b, base, "20240101_000000")
    broken = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("id")).alias("id"))
    for version in ("20240101_000000", "20240301_000000"):
        with pytest.raises(Exception, match="stop"):
            artifacts.save_datasets(a, broken, base, version)  # train is written, test is not
        assert artifacts.latest_version(spark, base) == "20240101_000000"
        assert artifacts.load_dataset(spark, base, "test").count() == 5
    # A stop after the files are in place but before the manifest.
    with monkeypatch.context() as m:
        m.setattr(artifacts, "write_text", lambda *_: (_ for _ in ()).throw(OSError("stop")))
        with pytest.raises(OSError):
            artifacts.save_datasets(b, a, base, "20240401_000000")
    assert artifacts.latest_version(spark, base) == "20240101_000000"
    artifacts.save_datasets(b, a, base, "20240401_000000")
    assert artifacts.load_dataset(spark, base, "test").count() == 3


def test_versions_in_csv_only(spark, tmp_path):
    base = str(tmp_path / "sets")
    df = spark.sql("SELECT 1L AS id, TIMESTAMP '2024-01-01 00:00:00.123456' AS t, 0.5D AS x UNION ALL SELECT 2L, NULL, NULL")
    artifacts.save_datasets(df, df.limit(0), base, "20240101_000000", "csv")
    again = artifacts.load_dataset(spark, base, "train")
    assert again.dtypes == df.dtypes and sorted(again.collect(), key=str) == sorted(df.collect(), key=str)
    assert artifacts.load_dataset(spark, base, "test").count() == 0
    with pytest.raises(FileNotFoundError):
        artifacts.load_dataset(spark, base, "other")
    with pytest.raises(FileNotFoundError):
        artifacts.load_dataset(spark, base, "train", version="20990101_000000")


def test_tables_of_a_run_go_with_it(spark):
    with run_folder(spark) as folder:
        assert written(spark.range(5), "five").count() == 5
        assert spark.read.parquet(f"{folder}/five-*").count() == 5
    assert not exists(spark, folder)
    assert not fresh_path(spark, "x").startswith(folder)


LINES = [
    'a,note,b', '1,plain,2', '2,"one', 'two",3', '3,"say ""hi""', '', 'then, so"', '"4","",5', '5,5" pipe,6', '', '6,"x","y"',
    '7,"ends with ""', '""",8', '8,"a\r', 'b",9\r', '9,"""",10',
]
CELLS = [
    ("1", "plain", "2"), ("2", "one\ntwo", "3"), ("3", 'say "hi"\n\nthen, so', None), ("4", None, "5"), ("5", '5" pipe', "6"),
    ("6", "x", "y"), ("7", 'ends with "\n"', "8"), ("8", "a\r\nb", "9"), ("9", '"', "10"),
]


@pytest.mark.parametrize("bytes_per_split", [7, 64, 1 << 20])
def test_cells_over_several_lines(spark, tmp_path, bytes_per_split):
    text = "\n".join(LINES) + "\n"
    assert list(csv.reader(io.StringIO(text, newline="")))[1][1] == "plain"
    (tmp_path / "logs").mkdir()
    for i in range(2):
        (tmp_path / f"logs/part-{i}.csv").write_bytes(text.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(bytes_per_split))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert csv_records.spans_lines(spark, str(tmp_path / "logs"))
        found = csv_records.csv_records(spark, str(tmp_path / "logs"), ["a", "note", "b"]).orderBy("_record").collect()
        log = read_csv_log(spark, str(tmp_path / "logs"), O).orderBy("seq").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [(r["a"], r["note"], r["b"]) for r in found] == CELLS * 2
    assert [r["seq"] for r in log] == list(range(18)) and [r["a"] for r in log] == [*range(1, 10)] * 2
    # What a reader of whole files makes of it.
    plain = [r for r in csv.reader(io.StringIO("\n".join(x for x in LINES[:9]) + "\n", newline="")) if r][1:]
    assert [tuple(c or None for c in (*r, "")[:3]) for r in plain] == CELLS[: len(plain)]


def test_a_file_that_ends_inside_a_cell_is_refused(spark, tmp_path):
    path = write(tmp_path / "log.csv", 'a,b\n1,"open\n2,3\n')
    with pytest.raises(ValueError, match="inside a quoted cell"):
        read_csv_log(spark, path, O)
    assert not csv_records.spans_lines(spark, write(tmp_path / "plain.csv", 'a,b\n1,"x"\n2,5" pipe\n'))


def test_cache_is_per_version(spark, tmp_path):
    base = str(tmp_path / "cache")
    first = artifacts.cached(spark, base, "v1", "k", lambda: spark.range(2))
    again = artifacts.cached(spark, base, "v1", "k", lambda: spark.range(9))
    other = artifacts.cached(spark, base, "v2", "k", lambda: spark.range(9))
    assert (first.count(), again.count(), other.count()) == (2, 2, 9)
