import gzip
import os

import pytest
from flowloom.operators import filters as fl
from flowloom.operators import privacy as pv
from flowloom.operators import projections as pj
from flowloom.session import work_path
from flowloom.sources import readers as rd
from flowloom.sources import sinks as sn
from pyspark.sql import functions as F

CUBE = "SiteCode_Source string, SiteCode_Destination string, con_protocol string, dest_port int, source_aip_app_name string, source_app_exec string"


@pytest.fixture
def cube(spark):
    return spark.createDataFrame([("A", "B", "tcp", 80, "App1", "x"), ("A", "A", "udp", 53, "App2", "y"), ("B", "C", "tcp", 100, None, "x"),
                                  ("nf", None, "udp", 54, "App1", None)], CUBE)


def test_port_spec():
    assert fl.parse_port_spec("tcp/80|udp/100-1|icmp/1|tcp/x|tcp/5-") == [("tcp", 80, 80), ("udp", 1, 100)]


def test_ports_include_and_exclude_split_the_rows(cube):
    kept = cube.filter(fl.port_filter("tcp/1-100|udp/53")).count()
    assert kept == 3 and cube.filter(fl.port_filter("tcp/1-100|udp/53", "exclude")).count() == 1


def test_filters_commute(cube, rows):
    tests = [fl.include_ends("SiteCode_Source", "SiteCode_Destination", ["A"], ["C"], "OR"), fl.inter_intra(True, False),
             fl.port_filter("tcp/1-90"), fl.exclude_ends("SiteCode_Source", "SiteCode_Destination", [], ["C"])]
    one, other = cube, cube
    for test in tests:
        one = one.filter(test)
    for test in reversed(tests):
        other = other.filter(test)
    assert rows(one) == rows(other) == [("A", "B", "tcp", 80, "App1", "x")]


def test_exclusion_keeps_unknown_sites(cube):
    assert cube.filter(fl.exclude_ends("SiteCode_Source", "SiteCode_Destination", ["A"], ["C"])).count() == 1


def test_application_lists(cube):
    both = {"AIPAppName": ["App1"], "NX_bin_exec_name": ["x"]}
    count = lambda **k: cube.filter(fl.application_list_filter(cube.columns, **k)).count()
    assert count(source=both) == 3 and count(source=both, source_operand="AND") == 1
    assert count(source=both, source_mode="exclude") == 3 and count(source={}) == 4


def test_bad_arguments(cube):
    for call in (lambda: fl.inter_intra(False, False), lambda: fl.include_ends("a", "b", ["x"], ["y"], "XOR"), lambda: fl.port_filter("tcp/1", "maybe"),
                 lambda: pj.repository_of("noname.csv"), lambda: pj.repository_of("Unknown_20160501.csv"), lambda: pj.raw_execution_names(9)):
        with pytest.raises(ValueError):
            call()
    assert pj.repository_of("/in/CartoServer_20160501.csv.gz") == ("AIP-Server", "2016-05-01")


def test_export_single_or_many(spark, rows):
    root, df = work_path(spark, "export"), spark.range(100).toDF("n")
    one = sn.export_csv(df, root, "one.csv.gz", single=True)
    many = sn.export_csv(df, root, "many.csv.gz", file_rows=30)
    assert os.path.isfile(one) and os.path.isdir(many) and gzip.open(one, "rt").readline() == "n\n"
    assert rd.read_extract(spark, one).count() == rd.read_extract(spark, many).count() == 100
    sn.export_csv(spark.range(3).toDF("n"), root, "one.csv.gz", single=True)
    assert rd.read_extract(spark, one).count() == 3
    for folder, name in ((root, ""), ("/elsewhere", "x"), (root + "/../up", "x")):
        with pytest.raises(ValueError):
            sn.export_csv(df, folder, name, allowed_root=root)


def test_compaction_leaves_corrupt_files_out(spark):
    small, large = work_path(spark, "small"), work_path(spark, "large")
    os.makedirs(small)
    for i in range(4):
        data = gzip.compress(f"a;b\n{i};x\n{i};y\n".encode())
        with open(f"{small}/f{i}.csv.gz", "wb") as out:
            out.write(data if i else data[:-9])
    bad = sn.compact_csv(spark, small, large, rows_per_file=4)
    assert [b.rsplit("/", 1)[-1] for b in bad] == ["f0.csv.gz"]
    assert sorted(r["a"] for r in rd.read_extract(spark, large).collect()) == ["1", "1", "2", "2", "3", "3"]


def test_missing_table_is_empty_but_other_errors_surface(spark):
    assert rd.read_or_empty(spark, work_path(spark, "none"), "a int").count() == 0
    path = work_path(spark, "text")
    os.makedirs(path)
    with open(f"{path}/x.parquet", "w") as out:
        out.write("no parquet")
    with pytest.raises(Exception):
        rd.read_or_empty(spark, path, "a int").collect()


def test_as_of_before_the_first_snapshot(spark):
    df = spark.createDataFrame([("2016-05-01", 1), ("2016-06-01", 2)], "filedate string, n int")
    assert rd.as_of(df, "2016-04-01").count() == 0
    assert [r["n"] for r in rd.as_of(df, "2016-05-31").collect()] == [1]
    assert [r["n"] for r in rd.as_of(df).collect()] == [2]


def test_filter_list(spark):
    path = work_path(spark, "list")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as out:
        out.write("AIPAppName;NX_bin_exec_name\nApp1;x\nApp2;\n")
    assert rd.read_filter_list(spark, f"{path}/a.csv") == {"AIPAppName": ["App1", "App2"], "NX_bin_exec_name": ["x"]}


def test_file_name_metadata(spark):
    path = work_path(spark, "names")
    os.makedirs(path)
    with open(f"{path}/connection_eng7_20160501.csv", "w") as out:
        out.write("a;b\n1;2\n")
    row = rd.with_file_metadata(rd.read_extract(spark, path)).first()
    assert (row["filetype"], row["engine"], row["filedt"], row["filedate"]) == ("connection", "eng7", "20160501", "2016-05-01")


def test_pseudonyms_are_stable_and_hide_names(spark, rows):
    feed = spark.createDataFrame([("Ann",), ("ann",), ("Bob",), (None,)], "u string")
    dictionary = spark.createDataFrame([("ANN", "id1")], pv.DICTIONARY_SCHEMA)
    out = pv.pseudonymize(feed, {"u": "id"}, dictionary, "k")
    assert out.columns == ["id"]
    ids = [r["id"] for r in out.collect()]
    assert ids.count("id1") == 2 and ids.count(None) == 1 and len(set(ids)) == 3
    entries = pv.new_dictionary_entries(feed.toDF("name"), dictionary, "k")
    assert [r["name"] for r in entries.collect()] == ["bob"]
    label = pv.pseudonymize_inventory(feed, "u", dictionary, "k").filter(F.col("I_ID_D").startswith("unknown")).first()["I_ID_D"]
    assert "bob" not in label.lower().replace("unknown", "")


def test_widths_of_executions(spark):
    one = spark.createDataFrame([["v"] * 14], ["I_ID_D", "I_ID_U", *list(pj.EXECUTION)[2:14]]).selectExpr("*", "'e' engine", "'f' filedt")
    row = pj.project_execution(one, []).first()
    assert row["source_ip"] == "" and row["app_bin_hash"] is None and row["collecttype"] == "device"


def test_raw_feed_to_pseudonyms(spark):
    from flowloom.plans import jobs

    folder = work_path(spark, "feed")
    os.makedirs(folder)
    with open(f"{folder}/connection_eng7_20160501.tgz.csv", "w") as out:
        out.write("\t".join(f"v{i}" for i in range(16)) + "\tPC1\t10.0.0.1\tlast\tAnn.CORP.example\t1\tdep\tsid\tfull\tdn\n")
    feed = jobs.read_feed(spark, folder, "connection")
    ctx = jobs.scratch(spark, "feed", key="k")
    dictionary = spark.createDataFrame([("ann", "id1")], pv.DICTIONARY_SCHEMA)
    clean, entries = jobs.pseudonymize_feed(feed, "connection", dictionary, ctx)
    row = clean.first()
    assert (row["I_ID_U"], row["engine"], row["filedt"], row["NX_con_start_time"]) == ("id1", "eng7", "20160501", "v0")
    assert not {"NX_user_name", "NX_device_name", "NX_user_full_name"} & set(clean.columns)
    assert [r["name"] for r in entries.collect()] == ["pc1"]
    with pytest.raises(ValueError):
        jobs.pseudonymize_feed(feed, "other", dictionary, ctx)
