import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from store_rows import rows
from mercato.lakehouse import Lakehouse, Table, TableChanged, TableMissing, TableNotEmpty
from mercato.operators.ingest import append_bronze, csv_to_bronze
from mercato.plans.gold import materialize
from mercato.schemas import ENTITIES
from mercato.sources import csv_files, jdbc


def make(spark, path, partition=True):
    schema = spark.createDataFrame([], "k int, at timestamp").schema
    return Table(spark, str(path), schema, "day" if partition else None, "at", ("k",))


def data(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, at string").withColumn("at", F.col("at").cast("timestamp"))


def test_writers_never_create(spark, tmp_path):
    with pytest.raises(TableMissing):
        make(spark, tmp_path / "t").append(data(spark, (1, "2026-01-01 00:00:00")))


def test_dispositions_and_ranges(spark, tmp_path):
    t = make(spark, tmp_path / "t").create()
    assert t.read().count() == 0
    t.write(data(spark, (1, "2026-01-01 00:00:00"), (2, "2026-01-02 00:00:00"), (3, None)), "empty")
    with pytest.raises(TableNotEmpty):
        t.write(data(spark, (9, None)), "empty")
    t.write(data(spark, (4, "2026-01-02 23:59:59")))
    assert rows(t.read(), "k") == [(1,), (2,), (3,), (4,)]
    assert rows(t.read("2026-01-02", "2026-01-02"), "k") == [(2,), (4,)]
    assert rows(t.read(only=["__HIVE_DEFAULT_PARTITION__"]), "k") == [(3,)]
    t.write(data(spark, (7, "2026-01-05 00:00:00")), "truncate")
    assert rows(t.read(), "k") == [(7,)] and t.days() == ["2026-01-05"]
    with pytest.raises(ValueError):
        t.write(data(spark), "other")


def test_repeated_batch_is_written_once(spark, tmp_path):
    t = make(spark, tmp_path / "t", partition=False).create()
    df = data(spark, (1, None))
    assert t.append(df, ("job", 0)) and t.append(df, ("job", 0)) is None and t.append(df, ("job", 1))
    assert t.read().count() == 2


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_path):
    t = make(spark, tmp_path / "t").create()
    for i in range(4):
        t.append(data(spark, (i, "2026-01-01 00:00:00"), (10 + i, "2026-01-02 00:00:00")))
    assert t.compact("2026-01-01") == ["2026-01-01"]
    assert len(t.read("2026-01-01", "2026-01-01").inputFiles()) == 1
    assert len(t.read("2026-01-02", "2026-01-02").inputFiles()) == 4
    assert rows(t.read(), "k") == [(k,) for k in (0, 1, 10, 11, 12, 13, 2, 3)]
    assert t.compact("2026-01-01") == []


def test_a_load_of_one_day_is_written_by_the_tasks_that_made_it(spark, lake):
    t = lake.bronze("orders_raw")
    made = spark.range(0, 400, 1, 4).select(
        F.col("id").cast("string").alias("record_id"), F.spark_partition_id().cast("string").alias("raw_data"),
        F.lit("s").alias("source"), F.lit("2026-01-01 05:00:00").cast("timestamp").alias("ingested_at"))
    t.append(made, one_day=True)
    files = t.read().groupBy(F.input_file_name()).agg(F.count_distinct("raw_data").alias("tasks"), F.count("*").alias("n"))
    assert rows(files.select("tasks", "n"), "tasks", "n") == [(1, 100)] * 4
    t.append(made.withColumn("ingested_at", F.expr("ingested_at + make_interval(0, 0, 0, int(record_id) % 2)")), one_day=True)
    assert t.days() == ["2026-01-01", "2026-01-02"]
    assert t.read("2026-01-02", "2026-01-02").count() == 200 and t.read().count() == 800


def test_a_merge_into_a_new_table_plans_no_join(spark, lake, capsys):
    arriving = spark.range(3).select(F.col("id").cast("string").alias("product_id"))
    for table in (lake.silver("products").read(), lake.bronze("products_raw").read_write()):
        key = table.columns[0]
        left = arriving.join(table.select(F.col(key).alias("product_id")), "product_id", "left_anti")
        capsys.readouterr()
        left.explain()
        assert "Join" not in capsys.readouterr().out
        assert rows(left, "product_id") == [("0",), ("1",), ("2",)]


def test_latest_commit_is_found_past_a_stale_hint(spark, tmp_path):
    t = make(spark, tmp_path / "t", partition=False).create()
    t.append(data(spark, (1, None)))
    (tmp_path / "t" / "_CURRENT").write_text("0")
    (tmp_path / "t" / "._CURRENT.crc").unlink(missing_ok=True)
    assert t.state()["version"] == 1


def test_lost_write_is_not_seen_and_racing_rewrite_fails(spark, tmp_path):
    t = make(spark, tmp_path / "t").create()
    t._write(data(spark, (1, "2026-01-01 00:00:00")))  # files without a commit
    assert t.read().count() == 0
    t.append(data(spark, (2, "2026-01-01 00:00:00")))
    seen = t.state()["parts"]
    t.append(data(spark, (3, "2026-01-02 00:00:00")))
    t.replace(data(spark, (4, "2026-01-01 00:00:00")), ["2026-01-01"], seen)
    assert rows(t.read(), "k") == [(3,), (4,)]
    with pytest.raises(TableChanged):
        t.replace(data(spark, (5, "2026-01-01 00:00:00")), ["2026-01-01"], seen)
    assert rows(t.read(), "k") == [(3,), (4,)]


def test_appends_of_several_writers_all_get_in(spark, tmp_path):
    t = make(spark, tmp_path / "t", partition=False).create()
    other, state = make(spark, tmp_path / "t", partition=False), t.state
    stale = [t.state()]

    def late_look():  # the first look at the state misses the other writer's commit
        return stale.pop() if stale else state()

    write_id, held = t._write(data(spark, (1, None)))
    other.append(data(spark, (2, None)))
    t.state = late_look
    assert t._commit_change(lambda parts: parts.setdefault("", []).append(write_id))
    t.state = state
    assert rows(t.read(), "k") == [(1,), (2,)]


def test_hot_day_is_split_over_files(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, at timestamp, pad string").schema
    t = Table(spark, str(tmp_path / "t"), schema, "day", "at", ("k",)).create()
    df = spark.range(400_000).select(
        F.col("id").alias("k"), F.when(F.col("id") % 20 == 0, "2026-01-02").otherwise("2026-01-01").cast(
            "timestamp").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        t.append(df)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = list((tmp_path / "t").glob("w=*/day=2026-01-01/*.parquet"))
    assert len(files) > 3 and t.read().count() == 400_000


# ---- CSV

HEADER = ",".join(csv_files.csv_columns(ENTITIES["reviews"]))


def landing(tmp_path, files):
    for name, text in files.items():
        path = tmp_path / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    return str(tmp_path / "landing")


def test_csv_details(spark, tmp_path):
    body = HEADER + '\nr1,p1,c1,5,"Great, really","two\nlines ""quoted"" é",2026-01-01T00:00:00Z\n\nr2,,c2,,,,\nr3,"p,3",,\n'
    root = landing(tmp_path, {"reviews/a b+c.csv": body, "reviews/.keep": "", "reviews/x.txt": "no", "other/y.csv": "a\n1\n"})
    got = csv_files.bronze_from_folder(spark, root, "reviews", "2026-02-01 00:00:00")
    docs = {r.record_id: r for r in got.select("*", F.from_json("raw_data", "title string, comment string, rating string").alias("d")).collect()}
    assert set(docs) == {"r1", "r2", "r3"}
    assert docs["r1"].d.title == "Great, really" and docs["r1"].d.comment == 'two\nlines "quoted" é'
    assert docs["r2"].d.rating == "" and docs["r3"].d.title is None
    assert '"product_id":"p,3","customer_id":"","rating":"","title":null' in docs["r3"].raw_data
    assert docs["r1"].source == "gcs/reviews/a b+c.csv"


def test_csv_against_the_csv_module(spark, tmp_path):
    rng, columns, want = random.Random(5), csv_files.csv_columns(ENTITIES["reviews"]), {}
    cells = ["", "a", " b ", "x,y", 'q"q', "two\nlines", '""', "é", "\\", '\\"', "null", "#c", "\t", "'s'"]
    for f in range(12):
        out = io.StringIO()
        writer = csv.writer(out, quoting=rng.choice([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]),
                            lineterminator=rng.choice(["\n", "\r\n"]))
        writer.writerow(columns)
        for i in range(rng.randint(0, 12)):
            width = len(columns) if rng.random() < 0.8 else rng.randint(1, len(columns))
            writer.writerow([f"k{f}-{i}"] + [rng.choice(cells) for _ in range(width - 1)])
            out.write(rng.choice(["", "", "\n"]))
        path = tmp_path / "landing" / "reviews" / f"f{f}.csv"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(out.getvalue().encode())
        want |= {r["review_id"]: dict(r) for r in csv.DictReader(io.StringIO(out.getvalue()))}
    got = csv_files.bronze_from_folder(spark, str(tmp_path / "landing"), "reviews").collect()
    assert {r.record_id: json.loads(r.raw_data) for r in got} == want


def test_wrong_header_is_an_error(spark, tmp_path):
    root = landing(tmp_path, {"reviews/a.csv": "x,y\n1,2\n"})
    with pytest.raises(Exception):
        csv_files.bronze_from_folder(spark, root, "reviews").collect()
    free = csv_files.read_entity_csv(spark, f"{root}/reviews")
    assert rows(free, "x", "y") == [("1", "2")]


def test_event_defaults_only_for_absent_columns(spark):
    with_columns = spark.createDataFrame([("", "", "f")], f"event_id string, event_type string, {csv_files.PATH} string")
    r = csv_files.to_bronze(with_columns, "events", F.lit("s")).first()
    assert (r.event_id, r.event_type) == ("", "")


def test_lines_are_numbered_per_file_across_blocks(spark, tmp_path):
    root = landing(tmp_path, {f"events/{n}.csv": "device,timestamp\n" + "".join(f"{n}{i},t\n" for i in range(500))
                              for n in "ab"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = csv_files.bronze_from_folder(spark, root, "events", columns=["device", "timestamp"], multiline=False)
        found = {(r.raw_payload, r.event_id, r.event_type) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {(f'{{"device":"{n}{i}","timestamp":"t"}}', f"ev-auto-{i + 1}", "unknown")
                     for n in "ab" for i in range(500)}


def test_routing(spark):
    names = ["customers/a.csv", "customers/sub/a.csv", "customers/a.CSV", "customers/.keep", "misc/a.csv", "a.csv"]
    df = csv_files.route_by_folder(spark.createDataFrame([(n,) for n in names], "name string"), "name")
    assert {r.name: r.table_name for r in df.collect()} == {
        names[0]: "customers_raw", names[1]: "customers_raw", names[2]: None, names[3]: None, names[4]: None,
        names[5]: None}


def test_append_is_blind_but_ledger_skips(spark, tmp_path, lake):
    line = "r1,p1,c1,5,t,c,2026-01-01T00:00:00Z\n"
    root = landing(tmp_path, {"reviews/a.csv": HEADER + "\n" + line})
    csv_to_bronze(lake, root, "reviews")
    csv_to_bronze(lake, root, "reviews")
    assert lake.table("bronze", "reviews_raw").count() == 2
    other = Lakehouse(spark, str(tmp_path / "other")).create()
    csv_to_bronze(other, root, "reviews", ledger=True)
    landing(tmp_path, {"reviews/b.csv": HEADER + "\n" + line + line.replace("r1", "r2")})
    csv_to_bronze(other, root, "reviews", ledger=True)
    csv_to_bronze(other, root, "reviews", ledger=True)
    assert other.bronze("reviews_raw").read().count() == 3
    assert rows(other.bronze("_ingestion_log").read(), "source", "rows") == [
        ("gcs/reviews/a.csv", 1), ("gcs/reviews/b.csv", 2)]
    assert other.table("bronze", "reviews_raw", limit=1).count() == 1


def test_rejected_rows_are_reported(spark, lake):
    df = spark.createDataFrame([("a", "{}", "s"), (None, "{}", "s")], "record_id string, raw_data string, source string"
                               ).withColumn("ingested_at", F.lit("2026-01-01").cast("timestamp"))
    version, rejects = append_bronze(lake.bronze("orders_raw"), df)
    assert version and rejects.count() == 1 and lake.bronze("orders_raw").read().count() == 1


def test_database_reader_options(spark):
    assert jdbc.jdbc_options("jdbc:x", query="select 1")["query"] == "select 1"
    split = jdbc.jdbc_options("jdbc:x", query="select 1", split_on=("id", 0, 100, 4), user="u")
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "4" and split["user"] == "u"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x")
    made = jdbc.rows_to_bronze(spark.createDataFrame([(7, None)], "id int, name string"), "customers", "jdbc/customers")
    assert made.select("record_id", "raw_data").first() == ("7", '{"id":"7","name":null}')


def test_materialize_again_replaces(spark, tmp_path):
    df = spark.createDataFrame([("2026-01-01", 1), ("2026-01-02", 2)], "date string, n int")
    for _ in range(2):
        materialize(df, str(tmp_path / "g"), "date")
    materialize(df.where("n = 2").withColumn("n", F.lit(5)), str(tmp_path / "g"), "date")
    assert rows(spark.read.parquet(str(tmp_path / "g")), "n") == [(1,), (5,)]
