"""Row numbers over several files and splits, and CSV from a store."""

from __future__ import annotations

import random
from datetime import datetime

import pytest

from silverlane.operators.cleaning import clean
from silverlane.plans import pipeline
from silverlane.sources import readers
from silverlane.sources.ingest import Source, add_ingest_metadata, ingest_sources

AT = datetime(2024, 2, 1, 6)


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def write_files(folder, sizes):
    """Files with rows (name, place); returns all rows in order."""
    folder.mkdir()
    out = []
    for name, n in sizes.items():
        (folder / f"{name}.csv").write_text("name,place\n" + "".join(f"{name},{i}\n" for i in range(n)))
        out += [(name, i) for i in range(n)]
    return sorted(out)


@pytest.mark.parametrize("sizes", [{"a": 2, "b": 197}, {"b": 1, "a": 3000, "c": 40, "d": 900}, {"only": 1500}, {"a": 0, "b": 5, "c": 0}])
def test_rows_are_numbered_by_file_and_place(spark, tmp_path, small_splits, sizes):
    want = write_files(tmp_path / "in", sizes)
    landed = add_ingest_metadata(readers.scan_csv(spark, str(tmp_path / "in"), "name string, place bigint"), AT)
    rows = landed.collect()
    assert [(r["name"], r["place"]) for r in sorted(rows, key=lambda r: r["_row_seq"])] == want
    if len(sizes) > 1:
        assert sorted(r["_row_seq"] for r in rows) == list(range(len(want)))


def test_lines_that_do_not_fit_do_not_shift_the_order(spark, tmp_path, small_splits):
    rng = random.Random(4)
    (tmp_path / "in").mkdir()
    want = []
    for name in ("x", "a"):
        lines = []
        for i in range(700):
            bad = rng.random() < 0.2
            lines.append(f"{name},oops" if bad else f"{name},{i}")
            want += [] if bad else [(name, i)]
        (tmp_path / "in" / f"{name}.csv").write_text("name,place\n" + "\n".join(lines) + "\n")
    source = Source("s", "csv", str(tmp_path / "in"), "name string, place bigint")
    out = ingest_sources(spark, [source], str(tmp_path / "bronze"), AT, "r").first()
    assert (out["rows_ingested"], out["rows_rejected"]) == (len(want), 1400 - len(want))
    rows = readers.scan_layer(spark, out["output_path"], "r").orderBy("_row_seq").collect()
    assert [(r["name"], r["place"]) for r in rows] == sorted(want) and [r["_row_seq"] for r in rows] == list(range(len(want)))


def test_forward_fill_and_first_copy_follow_the_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,start_date,note\n1,2020-01-01,x\n")
    (tmp_path / "in" / "b.csv").write_text("id,start_date,note\n" + "".join(f"{i},,y\n" for i in range(2, 300)) + "1,2020-01-01,x\n")
    landed = add_ingest_metadata(readers.scan_csv(spark, str(tmp_path / "in"), "id string, start_date string, note string"), AT)
    rows = clean(landed, AT).orderBy("_row_seq").collect()
    assert len(rows) == 299 and {str(r["start_date"])[:10] for r in rows} == {"2020-01-01"}
    assert rows[0]["_source_file"].endswith("a.csv")


def test_store_csv_keeps_quotes_and_reports_bad_lines(spark, tmp_path):
    (tmp_path / "in" / "day").mkdir(parents=True)
    (tmp_path / "in" / "day" / "f.csv").write_text('id,text,n\n1,"say ""hi"", ok",5\n2,"two\nlines",6\n3,c,7,EXTRA\nbad\n')
    (tmp_path / "in" / "day" / "f.txt").write_text("not this one\n")
    source = Source("s", "s3", str(tmp_path / "in"), "id int, text string, n int", file_format="csv", glob="*.csv", multi_line=True)
    out = ingest_sources(spark, [source], str(tmp_path / "bronze"), AT, "r", rejects=str(tmp_path / "rejects")).first()
    assert (out["rows_ingested"], out["rows_rejected"], out["status"]) == (2, 2, "success")
    rows = readers.scan_layer(spark, out["output_path"], "r").orderBy("id").collect()
    assert [(r["id"], r["text"], r["n"]) for r in rows] == [(1, 'say "hi", ok', 5), (2, "two\nlines", 6)]
    reasons = {r["record"]: r["reason"] for r in spark.read.parquet(f"{tmp_path}/rejects/s").collect()}
    assert reasons == {"3,c,7,EXTRA": "too_many_fields", "bad": "missing_or_unreadable_field"}


def test_store_json_documents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('[{"x": 1},\n {"x": 2}]')
    assert readers.scan_object_store(spark, str(tmp_path / "in"), "json", "x int", lines=False).count() == 2


def test_stage_status_is_that_of_the_source(spark, tmp_path):
    (tmp_path / "good.csv").write_text("account_id,amount\nA1,5\nA2,6\n")
    (tmp_path / "other.csv").write_text("account_id,amount\nA1,5\n")
    sources = [Source(n, "csv", str(tmp_path / f"{n}.csv")) for n in ("good", "other", "absent")]
    plans = {"other": pipeline.QualityPlan(fail_on_error=True, threshold=2.0)}
    layout = pipeline.Layout(str(tmp_path / "out"))
    pipeline.run_full_pipeline(spark, layout, sources, "r", AT, plans)
    got = {(r["stage"], r["source_name"]): r["status"] for r in spark.read.parquet(layout.metadata).collect()}
    assert got["ingestion", "good"] == "completed" and got["ingestion", "absent"] == "failed"
    assert got["transformation", "good"] == "completed" and got["transformation", "other"] == "failed"


def test_business_rules_quarantine_without_declared_fields(spark, tmp_path):
    from silverlane.functions.rules import Rule

    (tmp_path / "t.csv").write_text("account_id,amount\n" + "".join(f"A{i},{i - 3}\n" for i in range(8)))
    plans = {"t": pipeline.QualityPlan(rules=[Rule("positive", "amount", "greater_than", {"value": 0})])}
    out = pipeline.run_full_pipeline(
        spark, pipeline.Layout(str(tmp_path / "out")), [Source("t", "csv", str(tmp_path / "t.csv"))], "r", AT, plans)
    row = out["transformation"].first()
    assert (row["status"], row["quarantined_rows"]) == ("success", 4)
