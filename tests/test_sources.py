from __future__ import annotations

import pytest
from conftest import rows

from tidemark import schemas
from tidemark.sources import existing_snapshots, header_of, read_jdbc, read_runs, scan_csv

ABC = schemas.table(a=schemas.INT, b=schemas.INT, c=schemas.INT)


def test_declared_columns_are_found_by_name(spark, landing):
    path = landing("x.csv", "b,a,c", "1,9.7, 5", "2,NULL,6 ", "x,3,", "4,5", "5,6,7,8")
    frame = scan_csv(spark, path, ABC)
    assert frame.columns == ["b", "a", "c"]
    assert [tuple(r) for r in frame.collect()] == [
        (1, None, 5), (2, None, 6), (None, 3, None), (4, 5, None), (5, 6, 7),
    ]


def test_scan_does_not_trim_text(spark, landing):
    path = landing("x.csv", "name,a", " x ,1")
    frame = scan_csv(spark, path, schemas.table(a=schemas.INT))
    assert rows(frame) == [(" x ", 1)]


def test_repeated_and_empty_headers_are_renamed_by_position(spark, landing):
    path = landing("x.csv", "a,b,a,", "1,2,3,4")
    assert header_of(spark, path) == (["a0", "b", "a2", "_c3"], False)
    assert scan_csv(spark, path).columns == ["a0", "b", "a2", "_c3"]
    assert rows(scan_csv(spark, path)) == [("1", "2", "3", "4")]


def test_files_with_repeated_headers_must_agree(spark, landing, tmp_path):
    landing("a.csv", "k,a,v,a", "1,2,3,4")
    landing("b.csv", "", "k,a,v,a", "5,6,7,8")
    folder = str(tmp_path / "files")
    assert rows(scan_csv(spark, folder)) == [("1", "2", "3", "4"), ("5", "6", "7", "8")]
    landing("c.csv", "v,a,k,a", "9,9,9,9")
    for infer in (False, True):
        with pytest.raises(ValueError, match="header"):
            scan_csv(spark, folder, infer=infer)


def test_names_that_only_look_renamed_stay_checked(spark, landing):
    path = landing("x.csv", "q0,q1", "1,2")
    assert header_of(spark, path) == (["q0", "q1"], True)


def test_another_header_order_fails_instead_of_swapping(spark, landing, tmp_path):
    landing("a.csv", "a,b", "1,2")
    landing("b.csv", "b,a", "2,1")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path / "files")).collect()
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path / "files")).select("a").collect()


def test_missing_declared_column_is_an_error(spark, landing):
    with pytest.raises(ValueError, match="c"):
        scan_csv(spark, landing("x.csv", "a,b", "1,2"), ABC)


def test_quotes_and_separator(spark, landing):
    path = landing("x.csv", "a;b", '"x;y";2')
    assert rows(scan_csv(spark, path, sep=";")) == [("x;y", "2")]


def test_inferred_types_depend_on_the_data(spark, landing):
    clean = scan_csv(spark, landing("a.csv", "m,n", "9.7,1", "3.2,2"), infer=True)
    mixed = scan_csv(spark, landing("b.csv", "m,n", "9.7,1", "NA,2"), infer=True)
    assert [t for _, t in clean.dtypes] == ["double", "int"]
    assert [t for _, t in mixed.dtypes] == ["string", "int"]


def test_scan_reads_only_the_columns_asked_for(spark, landing):
    frame = scan_csv(spark, landing("x.csv", "a,b,c", "1,2,3"), ABC).select("b")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<b:string>" in plan
    assert rows(frame) == [(2,)]
    assert frame.count() == 1


def test_absent_registry_is_empty(spark, tmp_path):
    assert read_runs(spark, str(tmp_path / "none")).columns == schemas.RUNS.names
    assert read_runs(spark, str(tmp_path / "none")).count() == 0


def test_relational_scan_takes_everything_as_options():
    """No database is started here; only what is handed to Spark's reader is checked."""
    calls = {}

    class Reader:
        def format(self, name):
            calls["format"] = name
            return self

        def options(self, **options):
            calls.update(options)
            return self

        def load(self):
            return "rows"

    class Session:
        read = Reader()

    options = {"user": "u", "numPartitions": "8", "partitionColumn": "match_id"}
    assert read_jdbc(Session, "jdbc:x:y", "deliveries", options) == "rows"
    assert calls == {"format": "jdbc", "url": "jdbc:x:y", "dbtable": "deliveries", **options}


def test_snapshot_listing(spark, tmp_path):
    (tmp_path / "p" / "x_1").mkdir(parents=True)
    (tmp_path / "p" / "file").write_text("")
    assert rows(existing_snapshots(spark, str(tmp_path / "p"))) == [("x_1",)]
    with pytest.raises(Exception, match="FileNotFound"):
        existing_snapshots(spark, str(tmp_path / "none"))


def test_guessed_files_with_another_header_order_fail(spark, landing):
    landing("a.csv", "k,v,w", "1,2,3")
    path = landing("b.csv", "v,k,w", "99,5,6")
    with pytest.raises(Exception, match="header"):
        scan_csv(spark, path.rpartition("/")[0], infer=True).collect()
