import gzip
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from claimlake.sources import excel, landing


@pytest.fixture()
def landing_root(tmp_path, fixtures_dir):
    root = tmp_path / "landing"
    shutil.copytree(os.path.join(fixtures_dir, "landing"), root)
    # gzip file, latin-1 file and an empty file are produced here (binary content)
    with gzip.open(root / "provider_b" / "medical-claims-20240201.CSV.gz", "wb") as fh:
        fh.write(b"CLAIM_ID,CHARGE_AMOUNT\nMB-9,10.00\n")
    (root / "provider_c").mkdir()
    (root / "provider_c" / "claims-latin1.csv").write_bytes("CLAIM_ID,PROVIDER\nC-1,Clínica Sol\n".encode("latin-1"))
    (root / "provider_c" / "empty.csv").write_bytes(b"")
    return str(root)


def test_read_landing_csv_keeps_each_header_and_text(spark, landing_root):
    rows = landing.read_landing_csv(spark, landing_root).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file_name, []).append(r)
    dental = sorted(by_file["provider_a/dental-claims-20240301.csv"], key=lambda r: r.file_row_number)
    assert [r.file_row_number for r in dental] == [1, 2, 3]
    first = json.loads(dental[0].raw_data)
    assert first["NPI"] == "0123456789" and first["BILLED_AMOUNT"] == "150.00"
    assert first["PROVIDER_NAME"] == "Smile, Dental"
    assert json.loads(dental[1].raw_data)["PROVIDER_NAME"] == "Two\nLines Dental"
    assert json.loads(dental[2].raw_data)["DOB"] is None  # an empty cell is a null under its key
    assert dental[0].tpa == "provider_a" and dental[0].file_type == "CSV"
    medical = by_file["provider_b/medical-claims-20240115.csv"]
    assert set(json.loads(medical[0].raw_data)) >= {"CHARGE_AMOUNT", "PAYMENT_AMOUNT"}
    gz = by_file["provider_b/medical-claims-20240201.CSV.gz"]
    assert json.loads(gz[0].raw_data) == {"CLAIM_ID": "MB-9", "CHARGE_AMOUNT": "10.00"}
    assert gz[0].file_type == "CSV"
    lat = by_file["provider_c/claims-latin1.csv"]
    assert json.loads(lat[0].raw_data)["PROVIDER"] == "Clínica Sol"
    loose = by_file["loose-pharmacy.csv"]
    assert loose[0].tpa is None and json.loads(loose[0].raw_data)["NDC"] == "00093-0058-01"
    assert "provider_b/header-only.csv" not in by_file
    assert not any(f.endswith(".txt") for f in by_file)


def test_list_landing_prunes_content(spark, landing_root):
    df = landing.list_landing(spark, landing_root)
    names = {r.file_name for r in df.collect()}
    assert "provider_a/readme.txt" in names and "loose-pharmacy.csv" in names
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_load_csv_as_modes(spark, tmp_path):
    p = tmp_path / "rows.csv"
    p.write_text("ID,AMOUNT,ACTIVE,DAY\n1, 10.50 ,Y,2024-02-29\n2,abc,N,2024-01-01\n3,,Y,\n")
    schema = "ID int, AMOUNT decimal(5,2), ACTIVE boolean, DAY date"
    cont = landing.load_csv_as(spark, str(p), schema, mode="CONTINUE").orderBy("ID").collect()
    assert [r.ID for r in cont] == [1, 3]
    assert str(cont[0].AMOUNT) == "10.50" and cont[0].ACTIVE is True and cont[1].AMOUNT is None
    perm = landing.load_csv_as(spark, str(p), schema, mode="PERMISSIVE").orderBy("ID").collect()
    assert len(perm) == 3 and perm[1].AMOUNT is None and perm[1].ACTIVE is False
    with pytest.raises(Exception):
        landing.load_csv_as(spark, str(p), schema, mode="ABORT").collect()


def test_to_raw_numbers_rows(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    rows = landing.to_raw(df, ["k"]).orderBy("row_number").collect()
    assert [r.row_number for r in rows] == [1, 2, 3]
    assert json.loads(rows[0].raw_data) == {"K": "1", "V": "a"}


def test_excel_workbook_all_sheets(spark, tmp_path):
    root = tmp_path / "x"
    (root / "provider_d").mkdir(parents=True)
    excel.write_test_workbook(str(root / "provider_d" / "book.xlsx"), {
        "Claims": [["CLAIM_ID", "AMOUNT"], ["X-1", 12.5], ["X-2", None]],
        "More": [["CLAIM_ID", "NOTE"], ["X-3", "hello"]],
    })
    rows = sorted(excel.read_landing_excel(spark, str(root)).collect(),
                  key=lambda r: (r.sheet_name, r.file_row_number))
    assert [(r.sheet_name, r.file_row_number) for r in rows] == [("Claims", 1), ("Claims", 2), ("More", 1)]
    assert json.loads(rows[0].raw_data) == {"CLAIM_ID": "X-1", "AMOUNT": "12.5"}
    assert json.loads(rows[1].raw_data)["AMOUNT"] is None
    assert rows[0].tpa == "provider_d" and rows[0].file_type == "EXCEL"


def test_landing_names_wide_header_and_split_files(spark, tmp_path):
    root = tmp_path / "land ing"
    (root / "tenant x").mkdir(parents=True)
    names = [f"COLUMN_NUMBER_{i}" for i in range(6000)]
    (root / "tenant x" / "my+file 1.csv").write_text(",".join(names) + "\n" + ",".join("v" for _ in names) + "\n")
    (root / "tenant x" / "long.csv").write_text("A,B\n" + "".join(f"{i},x\n" for i in range(1, 30001)))
    for r in (str(root), "file://" + str(root)):
        got = landing.read_landing_csv(spark, r).collect()
        assert {x.tpa for x in got} == {"tenant x"} and {x.file_name for x in got} == {"tenant x/my+file 1.csv", "tenant x/long.csv"}
        wide = json.loads(next(x.raw_data for x in got if "my+" in x.file_name))
        assert list(wide) == names
        assert {x.file_name for x in landing.list_landing(spark, r).collect()} == {x.file_name for x in got}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        rows = [x for x in landing.read_landing_csv(spark, str(root)).collect() if "long" in x.file_name]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(x.file_row_number for x in rows) == list(range(1, 30001))
    assert all(json.loads(x.raw_data)["A"] == str(x.file_row_number) for x in rows)


def test_excel_keeps_every_cell(spark, tmp_path):
    from claimlake.sources import excel
    (tmp_path / "t 1").mkdir()
    excel.write_test_workbook(str(tmp_path / "t 1" / "b.xlsx"), {"S": [["A", "A", ""], [1, 2, 3, 4], ["", "x"]]})
    rows = sorted(excel.read_landing_excel(spark, str(tmp_path)).collect(), key=lambda r: r.file_row_number)
    assert [json.loads(r.raw_data) for r in rows] == [{"A": "1", "A_1": "2", "_c2": "3", "_c3": "4"}, {"A": None, "A_1": "x", "_c2": None, "_c3": None}]
    assert rows[0].tpa == "t 1" and rows[0].file_name == "t 1/b.xlsx"


def _as_landed(root, files):
    for name, data in files.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        if name.endswith(".gz"):
            with gzip.open(p, "wb") as fh:
                fh.write(data)
        else:
            p.write_bytes(data)


def test_landing_records_across_lines_and_splits(spark, tmp_path):
    """Cells over many lines and splits, against Python's reader of whole files."""
    import csv
    import io
    import random
    rng = random.Random(5)
    bits = ["a", "", "x,y", 'say "hi"', "two\nlines", "\n\n", '"', ",", "é", " lead", "long " * 40 + "\n" + "tail" * 30]
    rows = [[str(i), *(rng.choice(bits) for _ in range(3))] for i in range(3000)]
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["ID", "A", "A", ""], *rows])
    _as_landed(tmp_path, {"t/multi.csv": out.getvalue().encode(), "t/gz.csv.gz": out.getvalue().encode(),
                          "t/plain.csv": b"ID,A\n" + b"".join(b"%d,v\n" % i for i in range(20000))})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        got = landing.read_landing_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name in ("t/multi.csv", "t/gz.csv.gz"):
        mine = sorted((r for r in got if r.file_name == name), key=lambda r: r.file_row_number)
        assert [r.file_row_number for r in mine] == list(range(1, 3001))
        assert [list(json.loads(r.raw_data).items()) for r in mine] == [list(zip(["ID", "A", "A_1", "_c3"], [c or None for c in row])) for row in rows]
    assert sorted(r.file_row_number for r in got if r.file_name == "t/plain.csv") == list(range(1, 20001))


def test_landing_odd_rows_and_outcomes(spark, tmp_path):
    _as_landed(tmp_path, {"t/odd.csv": b'A,B\n1,2,3\n4\n5" pipe,"x"y\n', "t/blank.csv": b"\n\nA,B\n\n1,2\n  \n3,4\n\n", "t/open.csv": b'A,B\n1,"never\n2,x\n\n3,y\n',
                          "t/crlf.csv": b'\xef\xbb\xbfA,B\r\n1,"two\r\nlines"\r\n2,""\r\n', "t/head.csv": b"A,B\n", "t/empty.csv": b"",
                          "t/wide head.csv": b'"A\nlong",B\n1,2\n', "t/latin.csv": "A\nmañana\n".encode("latin-1")})
    got = {}
    for r in landing.read_landing_csv(spark, str(tmp_path)).collect():
        got.setdefault(r.file_name, {})[r.file_row_number] = json.loads(r.raw_data)
    assert got == {
        "t/odd.csv": {1: {"A": "1", "B": "2"}, 2: {"A": "4", "B": None}, 3: {"A": '5" pipe', "B": '"x"y'}},
        "t/blank.csv": {1: {"A": "1", "B": "2"}, 2: {"A": "3", "B": "4"}},
        "t/open.csv": {1: {"A": "1", "B": "never"}, 2: {"A": "2", "B": "x"}, 4: {"A": "3", "B": "y"}},
        "t/crlf.csv": {1: {"A": "1", "B": "two\nlines"}, 2: {"A": "2", "B": None}},
        "t/wide head.csv": {1: {"A\nlong": "1", "B": "2"}}, "t/latin.csv": {1: {"A": "mañana"}}}
    kept = landing.read_landing_csv(spark, str(tmp_path), mode="DROPMALFORMED").filter("file_name = 't/odd.csv'").collect()
    assert [r.file_row_number for r in kept] == [3]
    with pytest.raises(Exception, match="uneven row"):
        landing.read_landing_csv(spark, str(tmp_path), mode="FAILFAST").collect()
    res = {r.file_name: (r.rows_read, r.short_rows, r.long_rows, r.result.split(":")[0]) for r in landing.landing_outcomes(spark, str(tmp_path)).collect()}
    assert res["t/odd.csv"] == (3, 1, 1, "SUCCESS") and "t/empty.csv" not in res and res["t/head.csv"] == (0, 0, 0, "SUCCESS")
    assert len(res) == 7
