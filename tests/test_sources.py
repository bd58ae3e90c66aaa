import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from squadweave import schemas, session
from squadweave.sources import seeds, tables, versions


def test_csv_with_mark_quotes_and_missing_values(spark, tmp_path):
    path = tmp_path / "teams.csv"
    text = 'name,season,note\n"a, ""b""",2025,N/A\nc,2024.0,\nd,x,""\n'
    path.write_bytes(b"\xef\xbb\xbf" + text.encode())
    schema = schemas.strings("name").add("season", T.IntegerType()).add("note", T.StringType())
    for multi_line in (False, True):
        df = tables.read_table(spark, str(path), schema, order="seq", multi_line=multi_line)
        assert df.columns == ["name", "season", "note", "seq"]
        assert [tuple(r)[:3] for r in df.orderBy("seq").collect()] == [('a, "b"', 2025, None), ("c", 2024, None), ("d", None, None)]
        raw = tables.load_rows(spark, str(path), schema, multi_line=multi_line)
        assert [tuple(r) for r in raw.collect()] == [('a, "b"', "2025", "N/A"), ("c", "2024.0", None), ("d", "x", None)]


def test_row_order_over_many_blocks(spark, tmp_path):
    path = tmp_path / "long.csv"
    path.write_text("name\n" + "".join(f"n{at:06d}\n" for at in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = tables.read_table(spark, str(path), schemas.NAMES, order="seq")
        assert df.rdd.getNumPartitions() > 4
        got = [r.name for r in df.repartition(5).orderBy("seq").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == sorted(got) and len(got) == 20000


def test_written_tables_replace_what_was_there(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"', "x")], "id int, High School string, c string".replace("High School", "`High School`"))
    for form in ("parquet", "csv"):
        out = str(tmp_path / form)
        tables.write_table(df, out, form=form)
        tables.write_table(df, out, ["High School", "id"], form)
        back = spark.read.csv(out, header=True, escape='"') if form == "csv" else spark.read.parquet(out)
        assert back.columns == ["High School", "id"]
        assert {(r[0], int(r[1])) for r in back.collect()} == {("a,b", 1), ('q"', 2)}


def test_dimension_and_batches(spark):
    a = spark.createDataFrame([("x/ ",), ("N/A",), ("b",), (None,)], "hs string")
    b = spark.createDataFrame([(" x",), ("B",)], "hs string")
    both = tables.union_batches([a, b])
    assert [r.name for r in tables.derive_dimension(both, "hs").collect()] == ["B", "b", "x"]
    assert sorted(r.batch_no for r in both.collect()) == [0, 0, 0, 0, 1, 1]
    assert tables.distinct_union([a, a, b], "hs").count() == 6
    assert {r.hs for r in tables.distinct_values(a.union(a), "hs").collect()} == {"x/ ", "N/A", "b"}
    assert [r.hs for r in tables.sort_values(a, "hs").collect()] == ["N/A", "b", "x/ ", None]
    assert [r.hs for r in tables.top_k(a, [F.asc_nulls_last("hs")], 2).collect()] == ["N/A", "b"]
    assert tables.preview(a, 2).count() == 2 and tables.row_count(a) == 4


def test_pages_meet_the_page_list(spark, tmp_path):
    listed = seeds.page_list(spark)
    url = listed.filter("college = 'Rice University' and season = 2024").first().url
    raw = spark.createDataFrame([(url, "<p>"), ("https://elsewhere", "<p>")], "url string, html string")
    for form in ("parquet", "json"):
        raw.write.format(form).save(str(tmp_path / form))
        page = tables.read_pages(spark, str(tmp_path / form), listed, form).first()
        assert (page.college, page.season, page.batch_no, page.page_no) == ("Rice University", 2024, 1, 12)
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "one.html").write_text("<h1>\n</h1>")
    file = tables.read_page_files(spark, str(tmp_path / "html")).first()
    assert file.html == "<h1>\n</h1>" and file.url.endswith("one.html")


def test_lineage_is_cut_in_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    cut = session.cut_lineage(spark.range(5).withColumn("x", F.rand()))
    assert cut.collect() == cut.collect() and cut.columns == ["id", "x"]
    written = [os.path.realpath(path.removeprefix("file://")) for path in cut.inputFiles()]
    assert written and all(path.startswith(os.path.realpath(folder)) for path in written)
    session.release(spark)
    assert not any(os.path.exists(path) for path in written)


def test_literal_tables_are_local(spark):
    plan = seeds.teams(spark)._jdf.queryExecution().executedPlan().toString()
    assert "LocalTableScan" in plan


def test_broken_lines_are_counted_and_left_out(spark, tmp_path):
    """Too many fields, too few, and a good line with an empty last field; a byte order mark and a quoted comma."""
    path = tmp_path / "players.csv"
    lines = ["name,season,note", '"a, b",2025,x', "c,2024,y,too,many", "d,2023", "e,2022,", "f,x,z"]
    path.write_bytes(b"\xef\xbb\xbf" + "\n".join(lines).encode())
    schema = schemas.strings("name").add("season", T.IntegerType()).add("note", T.StringType())
    for multi_line in (False, True):
        df = tables.read_table(spark, str(path), schema, order="seq", multi_line=multi_line, well_formed=True)
        good = [tuple(r)[:3] for r in df.orderBy("seq").collect()]
        assert good == [("a, b", 2025, "x"), ("e", 2022, None), ("f", None, "z")]
        assert df.select("name").count() == 3 and df.count() == 3
        bad = tables.malformed_rows(spark, str(path), schema, order="seq", multi_line=multi_line)
        assert [r.line.strip() for r in bad.orderBy("seq").collect()] == ["c,2024,y,too,many", "d,2023"]
        assert bad.count() == 2
        raw = tables.load_rows(spark, str(path), schema, multi_line=multi_line, well_formed=True)
        assert [r.season for r in raw.collect()] == ["2025", "2022", "x"]
        assert tables.read_table(spark, str(path), schema, multi_line=multi_line).count() == 5


def test_loads_at_once_get_versions_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "graph")
    with ThreadPoolExecutor(8) as pool:
        begun = list(pool.map(lambda _: versions.begin(spark, root), range(16)))
    assert sorted(begun) == [f"{root}/versions/{number:08d}" for number in range(1, 17)]


def test_old_versions_go(spark, tmp_path):
    root = str(tmp_path / "graph")
    begun = []
    for number in range(5):
        begun.append(versions.begin(spark, root))
        tables.write_table(spark.range(number), f"{begun[-1]}/rows")
        if number != 1:
            versions.complete(spark, begun[-1])
    assert versions.retain(spark, root, 9) == []
    assert versions.retain(spark, root, 2) == begun[:3]
    assert versions.latest(spark, root) == begun[4]
    assert [os.path.exists(path) for path in begun] == [False] * 3 + [True] * 2
    assert versions.begin(spark, root).endswith("00000006")
