"""Released tables as CSV: columns by name, lines set aside."""

import pytest

from termfold.sources.released import FIELDS, HEADER, QUOTES, read_released

SCHEMA = "LOINC_NUM string, RANK int, COMPONENT string"


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode())
    return str(folder)


def test_good_rows_and_one_row_for_each_bad_line(spark, tmp_path):
    path = put(tmp_path / "t", "a.csv", '\ufeff"COMPONENT","EXTRA",LOINC_NUM,RANK\r\n"Glucose, ""fasting""",x,1-1,5\r\n\r\nshort,1-2\r\nA,"broken,1-3,7\r\n'
               'B,x,1-4,seven\r\nC,x,,8\r\n"",,1-5,\r\nD,x,1-6,9,more\r\nlast,x,1-7,"3')
    got = read_released(spark, path, SCHEMA, required=["LOINC_NUM"])
    assert sorted(map(tuple, got.rows.collect()), key=repr) == sorted([("1-1", 5, 'Glucose, "fasting"'), ("1-5", None, None)], key=repr)
    assert got.rows.columns == ["LOINC_NUM", "RANK", "COMPONENT"]
    bad = {r.record: r.problem for r in got.quarantine.collect()}
    assert bad == {"short,1-2": FIELDS, 'A,"broken,1-3,7': QUOTES, "B,x,1-4,seven": FIELDS, "C,x,,8": "no LOINC_NUM",
                   "D,x,1-6,9,more": FIELDS, 'last,x,1-7,"3': QUOTES}
    assert (got.n_rows, got.n_bad) == (2, 6)
    assert all(r.file.endswith("a.csv") for r in got.quarantine.collect())
    with pytest.raises(ValueError, match="6 of 8 lines.*2 with quotes do not close"):
        got.require(0.5)
    assert got.require(0.75).count() == 2


def test_several_files_and_another_header(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        path = put(tmp_path / "t", name, f"LOINC_NUM,RANK,COMPONENT\n{name},1,x\n{name},1,x\n")
    got = read_released(spark, path, SCHEMA)
    assert (got.n_rows, got.n_bad) == (4, 0) and got.require().count() == 4
    put(tmp_path / "t", "c.csv", "LOINC_NUM,COMPONENT,RANK\nc,2,y\n")
    got = read_released(spark, path, "LOINC_NUM string, COMPONENT string")
    assert [r.problem for r in got.quarantine.collect()] == [HEADER]


def test_names_given_clashing_and_lacking(spark, tmp_path):
    path = put(tmp_path / "t", "a.csv", "1,_line,file\n2,_bad,problem\n")
    got = read_released(spark, path, "file string, _bad string, _line int", header=["_line", "_bad", "file"])
    assert sorted(map(tuple, got.require().collect())) == [("file", "_line", 1), ("problem", "_bad", 2)]
    with pytest.raises(ValueError, match="exactly one column b"):
        read_released(spark, path, "a string, b string", header=["a", "b", "b"])
    with pytest.raises(ValueError, match="exactly one column z"):
        read_released(spark, path, "z string", header=["a", "b", "c"])


def test_empty_files_and_long_fields(spark, tmp_path):
    path = put(tmp_path / "t", "a.csv", "\n")
    got = read_released(spark, path, SCHEMA, header=["LOINC_NUM", "RANK", "COMPONENT"])
    assert got.require().collect() == [] and got.quarantine.collect() == []
    with pytest.raises(ValueError, match="no header"):
        read_released(spark, path, SCHEMA)
    path = put(tmp_path / "u", "a.csv", f"LOINC_NUM,RANK,COMPONENT\n1-1,1,{'x' * 2_000_000}\n")
    assert len(read_released(spark, path, SCHEMA).require().first().COMPONENT) == 2_000_000
