import os
import struct

import pytest
from pyspark.sql import functions as F

from tallyworks import schemas, session, sinks
from tallyworks.operators import aggregates
from tallyworks.plans import rental, retail
from tallyworks.sources import exif, files, jdbc, literals
from tallyworks.stand_ins import jpeg_header


# --- CSV and JSON -------------------------------------------------------------------


def test_csv_is_read_by_name_and_never_raises(spark, rows, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("z,Units Sold,Store ID,Date\nq,3,s1,2022-05-01\nq,three,s2,2022-13-01\nq,,s3,\n")
    types = {"Store ID": "string", "Units Sold": "int", "Date": "date"}
    df = files.csv_typed(spark, str(path), types)
    assert df.dtypes == [("z", "string"), ("Units Sold", "int"), ("Store ID", "string"), ("Date", "date")]
    assert [r[1] for r in df.orderBy("`Store ID`").collect()] == [3, None, None]
    with pytest.raises(ValueError, match="Colour"):
        files.csv_typed(spark, str(path), {"Colour": "string"})
    assert dict(files.csv_text(spark, str(path)).dtypes)["Units Sold"] == "string"


def test_csv_folder_with_two_headers_fails(spark, rows, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,x\n")
    (tmp_path / "2.csv").write_text("a,b\n2,y\n")
    assert rows(files.csv_typed(spark, str(tmp_path), {"a": "int"})) == [(1, "x"), (2, "y")]
    (tmp_path / "3.csv").write_text("b,a\ny,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.csv_typed(spark, str(tmp_path), {"a": "int"}).collect()


def test_decimal_discount_is_kept(spark, rows, tmp_path):
    path = tmp_path / "s.csv"
    names = list(schemas.RETAIL_SALES)
    line = ["s", "p", "2022-01-01", "2.5", "9.99", "Oslo", "12.5", "toys", "Monday"]
    path.write_text(",".join([*names, "Note"]) + "\n" + ",".join([*line, "hi"]) + "\n")
    sales = retail.load_sales(spark, str(path))
    assert rows(retail.discounted_sales(sales)) == [(1,)]
    assert sales.first()["Note"] == "hi"


def test_csv_separator_and_inference(spark, rows, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("a;b\n1;x\n2;y\n")
    assert rows(files.csv_typed(spark, str(path), {"a": "int"}, sep=";")) == [(1, "x"), (2, "y")]
    assert files.csv_inferred(spark, str(path), sep=";").dtypes == [("a", "int"), ("b", "string")]


def test_json_lines_with_and_without_schema(spark, rows, tmp_path):
    path = tmp_path / "a.json"
    path.write_text('{"a": {"b": 1}, "c": "x"}\n{"a": null}\n')
    assert rows(files.json_lines(spark, str(path), "a STRUCT<b: INT>").select("a.b")) == [(1,), (None,)]
    assert rows(files.json_lines(spark, str(path)), "c") == [("x",), (None,)]


def test_retail_file(spark, rows, tmp_path):
    path = tmp_path / "sales.csv"
    path.write_text(
        "Store ID,Product ID,Date,Units Sold,Sales Revenue (USD),Discount Percentage,Marketing Spend (USD),"
        "Store Location,Product Category,Day of the Week,Holiday Effect\n"
        "S1,P1,2022-01-01,9,2741.69,20,81,Tanzania,Furniture,Saturday,FALSE\n"
    )
    sales = retail.load_sales(spark, str(path))
    assert "Store ID" not in sales.columns
    assert rows(retail.monthly_category_summary(sales)) == [("Furniture", 2022, 1, 9, 2741.7)]


def test_literals(spark, rows):
    df = literals.named_rows(spark, [("a", 1), ("b", 2)], ["k", "n"], slices=2)
    assert rows(df) == [("a", 1), ("b", 2)] and df.rdd.getNumPartitions() == 2
    assert literals.typed_rows(spark, [], "k STRING, n INT").count() == 0


# --- JDBC: no database is started here, the options are what is checked ----------------


class Recorder:
    """Stands in for the session's reader and remembers its options."""

    def __init__(self):
        self.seen, self.read = {}, self

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **many):
        self.seen.update(many)
        return self

    def load(self):
        return self

    def first(self):
        return (3, 90)


def test_jdbc_options():
    plain = jdbc.read_query(Recorder(), {"url": "jdbc:x", "driver": "d"}, "SELECT 1").seen
    assert plain["format"] == "jdbc" and plain["query"] == "SELECT 1" and plain["url"] == "jdbc:x"
    assert "partitionColumn" not in plain
    cut = jdbc.read_table(Recorder(), {"url": "jdbc:x"}, "film", jdbc.Split("film_id", 1, 1000, 8)).seen
    assert cut["dbtable"] == "(SELECT * FROM film) q" and "query" not in cut
    assert (cut["partitionColumn"], cut["lowerBound"], cut["upperBound"], cut["numPartitions"]) == (
        "film_id", 1, 1000, 8,
    )
    found = jdbc.find_split(Recorder(), {"url": "jdbc:x"}, "SELECT * FROM film", "film_id", 4)
    assert found == jdbc.Split("film_id", 3, 90, 4)
    keyed = rental.load_table(Recorder(), {"url": "jdbc:x"}, "film", key="film_id").seen
    assert keyed["partitionColumn"] == "film_id" and keyed["upperBound"] == 90


# --- EXIF ---------------------------------------------------------------------------


def jpeg(order="<", make=b"ACME", taken=b"2020:01:02 03:04:05"):
    """A JPEG start with an APP0 segment before the EXIF block."""
    make, taken = make + b"\0", taken + b"\0"
    mark = b"II*\0" if order == "<" else b"MM\0*"
    main_at, exif_at, texts_at = 8, 8 + 2 + 24 + 4, 8 + 2 + 24 + 4 + 2 + 12 + 4
    value = make.ljust(4, b"\0") if len(make) <= 4 else struct.pack(order + "I", texts_at)
    tiff = mark + struct.pack(order + "I", main_at)
    tiff += struct.pack(order + "HHHI", 2, 271, 2, len(make)) + value
    tiff += struct.pack(order + "HHII", 34665, 4, 1, exif_at) + struct.pack(order + "I", 0)
    tiff += struct.pack(order + "HHHII", 1, 36867, 2, len(taken), texts_at + len(make))
    tiff += struct.pack(order + "I", 0) + make + taken
    block = b"Exif\0\0" + tiff
    app0 = b"\xff\xe0" + struct.pack(">H", 4) + b"JF"
    return b"\xff\xd8" + app0 + b"\xff\xe1" + struct.pack(">H", len(block) + 2) + block + b"\xff\xda\0\2"


@pytest.mark.parametrize("order", ["<", ">"])
def test_exif_header(order):
    assert exif.parse_header(jpeg(order)) == ("ACME", "2020:01:02 03:04:05")
    assert exif.parse_header(jpeg(order, make=b"ab")) == ("ab", "2020:01:02 03:04:05")


def test_exif_behind_long_segments_fill_bytes_and_lone_markers():
    plain = jpeg()
    profile = b"\xff\xe2" + struct.pack(">H", 0xFFFF) + b"i" * 65533
    for front in (profile * 5, b"\xff\xff\xff", b"\xff\x01", b"\xff\xd3"):
        if front == b"\xff\xff\xff":
            data = plain[:2] + front + plain[3:]
        else:
            data = plain[:2] + front + plain[2:]
        assert exif.parse_header(data) == ("ACME", "2020:01:02 03:04:05"), front[:4]


def test_exif_absent_or_broken():
    assert exif.parse_header(b"") == (None, None)
    assert exif.parse_header(b"\xff\xd8\xff\xda\0\2") == (None, None)
    assert exif.parse_header(b"not an image at all") == (None, None)
    whole = jpeg()
    for cut in range(0, len(whole), 7):
        make, taken = exif.parse_header(whole[:cut])
        assert make in (None, "", "A", "AC", "ACM", "ACME")


def test_exif_source_and_scan(spark, rows, plan, tmp_path):
    for i in range(7):
        (tmp_path / f"p{i}.jpg").write_bytes(jpeg(make=f"CAM{i}".encode()))
    (tmp_path / "plain.jpg").write_bytes(b"\xff\xd8\xff\xda\0\2")
    exif.register(spark)
    df = spark.read.format("exif").option("tasks", 3).load(str(tmp_path))
    assert df.columns == ["image_path", "camera_make", "date_time_original"]
    assert df.rdd.getNumPartitions() == 3
    found = rows(df, "camera_make", "date_time_original")
    assert found == [*((f"CAM{i}", "2020:01:02 03:04:05") for i in range(7)), (None, None)]
    assert rows(exif.exif_scan(spark, str(tmp_path)), "camera_make", "date_time_original") == found
    assert "content" not in plan(exif.exif_scan(spark, str(tmp_path))).split("FileScan")[1].split("Batched")[0]


def test_exif_recursive_and_unreadable(spark, rows, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.jpg").write_bytes(jpeg())
    exif.register(spark)
    load = spark.read.format("exif")
    assert load.load(str(tmp_path)).count() == 0
    assert rows(load.option("recursive", "true").load(str(tmp_path)), "camera_make") == [("ACME",)]
    paths = spark.createDataFrame([(str(tmp_path / "gone.jpg"),)], "path STRING")
    with pytest.raises(Exception, match="gone"):
        paths.mapInPandas(exif._read_batches, schemas.EXIF).collect()


def test_images_are_written_by_tasks(spark, rows, tmp_path):
    images = spark.createDataFrame([(f"x/{k}.jpg", jpeg(make=b"M%d" % k)) for k in range(5)], "path STRING, content BINARY")
    for _ in range(2):
        exif.write_images(images, f"file:{tmp_path}")
    found = exif.exif_scan(spark, str(tmp_path), recursive=True)
    assert rows(found, "camera_make") == [(f"M{k}",) for k in range(5)]


def test_exif_bytes_from_columns(spark, rows):
    df = spark.createDataFrame([("a", "MAKER", "2020:01:02 03:04:05"), ("b", None, "x")], "path STRING, m STRING, t STRING")
    images = df.select("path", jpeg_header(F.col("m"), F.col("t")).alias("content"))
    assert rows(exif.exif_from_content(images)) == [("a", "MAKER", "2020:01:02 03:04:05"), ("b", None, None)]


# --- sinks and catalog ------------------------------------------------------------------


def test_bucketed_table_is_overwritten_and_groups_without_shuffle(spark, rows, plan, tmp_path):
    session.use_database(spark, "stores_db", str(tmp_path / "db"))
    try:
        counted = spark.range(100).select((F.col("id") % 10).cast("string").alias("store_location"), "id")
        for _ in range(2):
            table = retail.publish_locations(counted)
        assert table.count() == 100
        grouped = aggregates.count_by(table, "store_location")
        assert "Exchange" not in plan(grouped)
        assert rows(grouped)[0] == ("0", 10)
        kept = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED sales_per_location").collect()}
        assert kept["Num Buckets"] == "3" and "store_location" in kept["Sort Columns"]
        sinks.write_bucketed(counted, "sales_as_json", "store_location", fmt="json")
        assert spark.table("sales_as_json").count() == 100
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_partitioned_write_prunes(spark, plan, tmp_path):
    sales = spark.range(50).select(
        (F.col("id") % 2).alias("store_id"), (F.col("id") % 5).alias("store_location"), "id"
    )
    path = str(tmp_path / "out")
    for _ in range(2):
        retail.write_by_store(sales, path)
    back = spark.read.parquet(path)
    assert back.count() == 50
    one = back.where("store_id = 1 AND store_location = 3")
    assert one.count() == 5
    assert "PartitionFilters: [isnotnull(store_id" in plan(one)


def test_shared_view(spark, rows):
    books = spark.createDataFrame([("a", "20853"), ("b", "1")], "t STRING, zip STRING")
    assert rows(session.query_shared_view(books, "books_view", "zip = '20853'")) == [("a", "20853")]


def test_shared_root_comes_from_the_session(spark):
    before = spark.sparkContext.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    root = session.shared_root(spark)
    assert root == (named or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared")
    assert spark.sparkContext.getCheckpointDir() == before
    assert session.new_shared_folder(spark, "x") != session.new_shared_folder(spark, "x")


def test_sized_conf():
    small = session.sized_conf(10**6, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert session.sized_conf(10**12, 1000)["spark.sql.shuffle.partitions"] == "5000"
    assert session.sized_conf(10**14, 4000)["spark.sql.shuffle.partitions"] == "500000"


class Settings(dict):
    """Stands in for a session's settings."""

    @property
    def conf(self):
        return self


def test_shared_root_of_a_cluster_is_named():
    unset = f"file:{os.getcwd()}/spark-warehouse"
    cluster = Settings({"spark.master": "spark://host:7077", "spark.sql.warehouse.dir": unset})
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(cluster)
    assert session.shared_root(Settings({**cluster, "spark.checkpoint.dir": "hdfs:///c/"})) == "hdfs:///c"
    named = Settings({**cluster, "spark.sql.warehouse.dir": "file:/shared/warehouse"})
    assert session.shared_root(named) == "file:/shared/warehouse/_shared"
    local = Settings({**cluster, "spark.master": "local[8]"})
    assert session.shared_root(local) == f"{unset}/_shared"


def files_of(df):
    return [name for name in df.inputFiles() if os.path.exists(name.removeprefix("file://"))]


def test_passing_pins_go_with_their_block(spark):
    stays = session.pin(spark.range(10))
    with session.passing_pins(spark):
        outer = session.pin(spark.range(10))
        with session.passing_pins(spark):
            inner = session.pin(outer)
            inner_files = inner.inputFiles()
            assert files_of(inner) == inner_files
        assert not any(os.path.exists(f.removeprefix("file://")) for f in inner_files)
        assert outer.count() == 10
        outer_files = outer.inputFiles()
    assert not any(os.path.exists(f.removeprefix("file://")) for f in outer_files)
    assert stays.count() == 10


def test_passing_pins_go_after_a_failure(spark):
    with pytest.raises(ValueError), session.passing_pins(spark):
        files = session.pin(spark.range(3)).inputFiles()
        raise ValueError
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert files_of(session.pin(spark.range(3)))
