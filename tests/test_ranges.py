"""Ranged readers against Spark's own, and against a byte-by-byte scan."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest

from silverlane.sources import ranges, readers
from silverlane.sources.ingest import Source, ingest_sources

AT = datetime(2024, 2, 1, 6)


def step_by_step(data: bytes, state: int) -> tuple[int, int]:
    """State after ``data`` and place of the first record start, one byte at a time."""
    first = 0 if state == ranges.RECORD else None
    for i, c in enumerate(data):
        if state == ranges.QUOTED:
            state = ranges.QUOTE if c == 34 else ranges.QUOTED
        elif state != ranges.PLAIN and c == 34:
            state = ranges.QUOTED
        else:
            state = {10: ranges.RECORD, 44: ranges.FIELD}.get(c, ranges.PLAIN)
            if state == ranges.RECORD and first is None:
                first = i + 1
    return state, len(data) if first is None else first


def test_csv_states_against_a_byte_by_byte_scan():
    rng = random.Random(1)
    for _ in range(30_000):
        data = bytes(rng.choices(b'",\nx', k=rng.randrange(14)))
        for state in range(5):
            end, first = step_by_step(data, state)
            assert (ranges.csv_end_state(data, state), ranges.csv_first_record(data, state)) == (end, first), (data, state)


def csv_text(rng, rows):
    pieces = ["plain", 'say "hi"', "two\nlines", "a,b", '"', '""', "\n\n", "", "ünï", " ", "end\r\nof"]
    lines = ["id,text,n"]
    for i in range(rows):
        text = "".join(rng.choices(pieces, k=rng.randrange(4)))
        quoted = '"' + text.replace('"', '""') + '"'
        lines.append(rng.choice([f"{i},{quoted},{i}", f"{i},{quoted},{i}", f"{i},mid\"quote,{i}", f"{i},,", f"{i}", f"{i},x,y,z", ""]))
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.mark.parametrize("range_bytes", [5, 64, 1 << 20])
def test_csv_equals_the_one_task_reader(spark, tmp_path, range_bytes):
    rng = random.Random(range_bytes)
    (tmp_path / "in").mkdir()
    for i, rows in enumerate((0, 1, 12 if range_bytes < 10 else 150)):
        (tmp_path / "in" / f"f{i}.csv").write_bytes(csv_text(rng, rows).encode())
    schema = "id int, text string, n int"
    want = readers.scan_csv(spark, str(tmp_path / "in"), schema, multi_line=True, keep_rejected=True)
    got = ranges.scan_csv_ranges(spark, str(tmp_path / "in"), schema, keep_rejected=True, range_bytes=range_bytes)
    assert got.schema == want.schema

    def plain(df):
        return sorted((repr((r["id"], r["text"], r["n"], (r[readers.CORRUPT] or "").rstrip("\n"))) for r in df.collect()
                       if r["id"] is not None or r[readers.CORRUPT]))

    assert plain(got) == plain(want)


def test_csv_marks_and_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbf"id",text\r\n1,"x\r\ny"\r\n\r\n2,z\r\n')
    for size in (5, 1000):
        got = ranges.scan_csv_ranges(spark, str(tmp_path), "id int, text string", range_bytes=size, places=True)
        assert [(r["id"], r["text"]) for r in got.orderBy("_row_seq").collect()] == [(1, "x\r\ny"), (2, "z")]


def test_csv_without_schema_header_or_rows(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "a.csv").write_text('id,text\n1,"x\ny"\n2,z\n')
    got = ranges.scan_csv_ranges(spark, str(tmp_path / "a"), range_bytes=6)
    assert got.dtypes == [("id", "int"), ("text", "string")] and got.count() == 2
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "a.csv").write_text('1,"x\ny"\n2,z\n')
    assert ranges.scan_csv_ranges(spark, str(tmp_path / "b"), "id int, text string", header=False, range_bytes=6).count() == 2
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "a.csv").write_text("id,text\n")
    assert ranges.scan_csv_ranges(spark, str(tmp_path / "c"), "id int, text string").count() == 0
    with pytest.raises(Exception, match="header"):
        ranges.scan_csv_ranges(spark, str(tmp_path / "a"), "id int, other string").count()


def test_one_record_longer_than_many_ranges(spark, tmp_path):
    long = "line\n" * 600
    (tmp_path / "a.csv").write_text(f'id,text\n1,a\n2,"{long}"\n3,b\n')
    got = ranges.scan_csv_ranges(spark, str(tmp_path), "id int, text string", range_bytes=100, places=True).orderBy("_row_seq")
    assert [(r["id"], r["text"]) for r in got.collect()] == [(1, "a"), (2, long), (3, "b")]


@pytest.mark.parametrize("range_bytes", [5, 64, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_equals_the_one_task_reader(spark, tmp_path, range_bytes, indent):
    rng = random.Random(range_bytes)
    pieces = ['"', "\\", "{", "}", "[", "]", ",", "x", "\n", "é", "\\\\"]
    rows = [{"id": i, "text": "".join(rng.choices(pieces, k=rng.randrange(8))), "deep": [{"k": i}, {"k": None}]}
            for i in range(4 if range_bytes < 10 else 60)]
    (tmp_path / "list.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "one.json").write_text(json.dumps(rows[0], indent=indent))
    (tmp_path / "none.json").write_text(" [ ]\n")
    schema = "id int, text string, deep array<struct<k: int>>"
    want = readers.scan_json(spark, str(tmp_path), schema).collect()
    got = ranges.scan_json_ranges(spark, str(tmp_path), schema, range_bytes=range_bytes)
    assert sorted(got.collect(), key=repr) == sorted(want, key=repr) and len(want) == len(rows) + 1
    if range_bytes > 5:
        free = ranges.scan_json_ranges(spark, str(tmp_path), range_bytes=range_bytes, places=True)
        in_list = free.filter(free["_source_file"].endswith("list.json")).orderBy("_row_seq").collect()
        assert [(r["id"], r["text"]) for r in in_list] == [(r["id"], r["text"]) for r in rows]


@pytest.mark.parametrize("text", ['[{"a": 1}, 5]', '[{"a": 1}', '[{"a": 1} {"a": 2}]', '[[{"a": 1}]]', "5", '[{"a": "x]', '{"a": 1} 5'])
def test_json_that_is_no_list_of_objects_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    for size in (4, 1000):
        with pytest.raises(Exception, match="not a JSON object"):
            ranges.scan_json_ranges(spark, str(tmp_path), "a int", range_bytes=size).collect()


def test_many_tasks_read_one_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"a\nb"\n' for i in range(3000)))
    got = ranges.scan_csv_ranges(spark, str(tmp_path), "id int, text string", range_bytes=1000)
    per_task = [len(rows) for rows in got.select("id").rdd.glom().collect()]
    assert sum(per_task) == 3000 and max(per_task) < 1000


def test_ingest_reads_by_ranges_and_keeps_the_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('id,text\n1,"x\ny"\nbad\n2,z\n')
    (tmp_path / "in" / "b.csv").write_text('id,text\n3,"x,y"\n')
    (tmp_path / "doc.json").write_text('[{"id": 1}, {"id": 2}]')
    sources = [Source("s", "csv", str(tmp_path / "in"), "id int, text string", multi_line=True),
               Source("j", "json", str(tmp_path / "doc.json"), "id int")]
    out = ingest_sources(spark, sources, str(tmp_path / "bronze"), AT, "r", rejects=str(tmp_path / "rejects")).collect()
    assert [(r["rows_ingested"], r["rows_rejected"], r["status"]) for r in out] == [(3, 1, "success"), (2, 0, "success")]
    rows = readers.scan_layer(spark, out[0]["output_path"], "r").orderBy("_row_seq").collect()
    assert [(r["id"], r["text"], r["_source_file"][-5:]) for r in rows] == [(1, "x\ny", "a.csv"), (2, "z", "a.csv"), (3, "x,y", "b.csv")]
    assert spark.read.parquet(f"{tmp_path}/rejects/s").count() == 1
