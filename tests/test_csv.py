"""CSV as people write it."""

import os

import pytest

from lendwise.sources import files

COLUMNS = "loan_id long, description string, loan_amount double"
ROWS = [(1, "x\ny", 1.0), (2, 'q"u,o"te', 2.0), (3, "", 3.0), (4, None, None), (5, " pad ", 5.5), (6, 'end"', 6.0), (7, "back\\slash\\", 7.0), (8, '"', 8.0), (9, "a\r\nb", 9.0), (10, "\\\"", 0.0)]


def collected(df):
    return sorted((r.loan_id, r.description, r.loan_amount) for r in df.collect())


def put(folder, **texts):
    os.makedirs(folder, exist_ok=True)
    for name, text in texts.items():
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(text)
    return str(folder)


def test_written_rows_come_back(spark, tmp_path):
    path = str(tmp_path / "out dir")
    files.write_csv(spark.createDataFrame(ROWS, COLUMNS).repartition(3), path)
    assert collected(files.read_csv(spark, path)) == ROWS
    plain = [r for r in ROWS if r[0] not in (1, 9)]
    files.write_csv(spark.createDataFrame(plain, COLUMNS), path)
    assert collected(files.read_csv(spark, path)) == collected(files.read_csv(spark, path, checked=False)) == plain


def test_a_file_in_the_pandas_style(spark, tmp_path):
    path = put(tmp_path / "p", a='Loan Id,Description,Loan Amount\n1,"a ""quoted"" word, and\na break",10.5\n2,,\n3,"",7\n')
    assert collected(files.read_csv(spark, path)) == [(1, 'a "quoted" word, and\na break', 10.5), (2, None, None), (3, "", 7.0)]


def test_headers_in_another_order_and_with_other_columns(spark, tmp_path):
    path = put(tmp_path / "h", a="Loan Id,Description,Loan Amount\n1,one,10\n", b='Loan Amount,Loan Id,"Extra, name"\n20,2,more\n', c="Description,Loan Amount,Loan Id\n\"th\nree\",30,3\n", d="")
    df = files.read_csv(spark, path)
    assert collected(df) == [(1, "one", 10.0), (2, None, 20.0), (3, "th\nree", 30.0)]
    assert [g["broken"] for g in files.csv_layout(spark, path)] == [True, False, False]


def test_a_broken_record_is_an_error_not_a_row(spark, tmp_path):
    path = put(tmp_path / "b", a='Loan Id,Description,Loan Amount\n1,"x\ny",1\n')
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path, checked=False).collect()
    path = put(tmp_path / "s", a="Loan Id,Description,Loan Amount\n1,x\n")
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path).collect()


def test_nothing_to_read(spark, tmp_path):
    assert files.read_csv(spark, put(tmp_path / "e", a="")).count() == 0
    assert files.read_csv(spark, put(tmp_path / "f", a="Loan Id,Description,Loan Amount\n")).count() == 0


def test_only_files_with_breaks_are_read_whole(spark, tmp_path):
    path = put(tmp_path / "m", a="Loan Id,Description,Loan Amount\n1,one,10\n", b='Loan Id,Description,Loan Amount\n2,"t\nwo",20\n')
    layout = files.csv_layout(spark, path)
    assert [(g["broken"], len(g["files"])) for g in layout] == [(False, 1), (True, 1)]
