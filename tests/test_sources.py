"""Readers and writers: tab-delimited spend files and the reject-list XML."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendstar.constants import SPEND_COLUMNS
from spendstar.sources.delimited import read_spend, write_spend
from spendstar.sources.reject_list import RejectListError, read_reject_list, write_reject_list

HEADER = "\t".join(SPEND_COLUMNS)


def _line(*fields):
    vals = list(fields) + [""] * (len(SPEND_COLUMNS) - len(fields))
    return "\t".join(vals)


def test_multi_file_header_skip_and_lineage(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"f{i}.txt").write_text(
            HEADER + "\n" + _line("D", f"E{i}", "01/02/2013") + "\n")
    df = read_spend(spark, str(tmp_path / "*.txt"))
    rows = df.collect()
    assert len(rows) == 3  # one header skipped per file
    assert sorted(r.Entity for r in rows) == ["E0", "E1", "E2"]
    assert all(r.source_file.endswith(".txt") for r in rows)
    assert all(r._corrupt_record is None for r in rows)


def test_quotes_are_data_and_empty_is_null(spark, tmp_path):
    p = tmp_path / "q.txt"
    p.write_text(HEADER + "\n" + _line("D", "  ", "01/02/2013", "T", "A", '"ACME, LTD"', "X",
                                       '"1,234.56"', "", "", "", "C:\\x\\y") + "\n")
    r = read_spend(spark, str(p)).first()
    assert r.ContractNumber == "C:\\x\\y"  # backslashes are data too
    assert r.Supplier == '"ACME, LTD"'
    assert r.Amount == '"1,234.56"'
    assert r.Entity == "  "          # whitespace is kept
    assert r.Description is None     # empty field loads as NULL


def test_crlf_line_endings(spark, tmp_path):
    p = tmp_path / "crlf.txt"
    p.write_bytes((HEADER + "\r\n" + _line("D", "E", "01/02/2013") + "\r\n").encode())
    r = read_spend(spark, str(p)).first()
    assert r.DateOfPayment == "01/02/2013"
    assert r.ExpenditureType is None  # no stray carriage return in the last field


def test_short_and_long_rows_are_kept_and_flagged(spark, tmp_path):
    p = tmp_path / "bad.txt"
    good = _line("D", "E", "01/02/2013")
    short = "D\tE\t01/02/2013"
    long = good + "\textra"
    p.write_text("\n".join([HEADER, good, short, long]) + "\n")
    rows = read_spend(spark, str(p)).collect()
    assert len(rows) == 3
    flagged = [r for r in rows if r._corrupt_record is not None]
    assert len(flagged) == 2
    assert all(r.Department == "D" for r in rows)


def test_write_then_read_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [tuple(["  padded ", None, ""] + ["x"] * (len(SPEND_COLUMNS) - 3))],
        ", ".join(f"{c} string" for c in SPEND_COLUMNS))
    write_spend(df, str(tmp_path / "out"))
    r = read_spend(spark, str(tmp_path / "out"), lineage=False).first()
    assert r.Department == "  padded "   # no trimming on write
    assert r.Entity is None and r.DateOfPayment is None


def _xml(tmp_path, body, name="s.xml"):
    p = tmp_path / name
    p.write_text('<?xml version="1.0" encoding="UTF-8"?>\n' + body)
    return str(p)


def test_reject_list_sample_shape(spark, tmp_path):
    path = _xml(tmp_path, "<Suppliers>\n"
                          '    <Supplier SupplierName="EXAMPLE SUPPLIER LTD" />\n'
                          '    <Supplier SupplierName="ANOTHER INVALID SUPPLIER" />\n'
                          "</Suppliers>\n")
    names = sorted(r.SupplierName for r in read_reject_list(spark, path).collect())
    assert names == ["ANOTHER INVALID SUPPLIER", "EXAMPLE SUPPLIER LTD"]


def test_reject_list_escaped_ampersand(spark, tmp_path):
    path = _xml(tmp_path, '<Suppliers><Supplier SupplierName="A &amp; B" /></Suppliers>\n')
    assert [r.SupplierName for r in read_reject_list(spark, path).collect()] == ["A & B"]


def test_reject_list_bare_ampersand_raises(spark, tmp_path):
    path = _xml(tmp_path, "<Suppliers>\n"
                          '  <Supplier SupplierName="A & B" />\n'
                          '  <Supplier SupplierName="C" />\n'
                          "</Suppliers>\n")
    with pytest.raises(RejectListError, match="XML parsing failed"):
        read_reject_list(spark, path)


def test_reject_list_repair_escapes_bare_ampersand(spark, tmp_path):
    path = _xml(tmp_path, "<Suppliers>\n"
                          '  <Supplier SupplierName="A & B" />\n'
                          '  <Supplier SupplierName="C &amp; D" />\n'
                          '  <Supplier SupplierName="E" />\n'
                          "</Suppliers>\n")
    names = sorted(r.SupplierName for r in read_reject_list(spark, path, repair=True).collect())
    assert names == ["A & B", "C & D", "E"]


def test_reject_list_unclosed_root_raises(spark, tmp_path):
    path = _xml(tmp_path, '<Suppliers>\n  <Supplier SupplierName="A" />\n')
    with pytest.raises(RejectListError):
        read_reject_list(spark, path)


def test_reject_list_two_roots_on_one_line_raise(spark, tmp_path):
    path = _xml(tmp_path, '<Suppliers><Supplier SupplierName="A"/></Suppliers>'
                          '<Suppliers><Supplier SupplierName="B"/></Suppliers>\n')
    with pytest.raises(RejectListError):
        read_reject_list(spark, path)


def test_reject_list_write_read_round_trip(spark, tmp_path):
    names = spark.createDataFrame([("X & Y",), ("<Z>",), ("plain",)], "SupplierName string")
    write_reject_list(names.repartition(2), str(tmp_path / "xml"))
    back = sorted(r.SupplierName for r in read_reject_list(spark, str(tmp_path / "xml")).collect())
    assert back == ["<Z>", "X & Y", "plain"]


def test_reject_list_refuses_elements_without_the_attribute(spark, tmp_path):
    path = _xml(tmp_path, '<Suppliers><Supplier SupplierName="A" /><Supplier /></Suppliers>\n')
    with pytest.raises(RejectListError):
        read_reject_list(spark, path)


# --- encodings and line endings ------------------------------------------------

HEADER = "\t".join(SPEND_COLUMNS)


def _line(*first):
    return "\t".join([*first] + [""] * (len(SPEND_COLUMNS) - len(first)))


MARKS = {"UTF-8": b"\xef\xbb\xbf", "UTF-16LE": b"\xff\xfe", "UTF-16BE": b"\xfe\xff"}


@pytest.mark.parametrize("ending", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("encoding", sorted(MARKS))
def test_encoding_and_line_ending_are_told_from_the_file(spark, tmp_path, encoding, ending):
    lines = [HEADER, _line("Dé", '"E', "01/02/2013"), _line("D2", "l'été", "02/02/2013")]
    text = ending.join(lines) + ending
    (tmp_path / "f.txt").write_bytes(MARKS[encoding] + text.encode(encoding))
    for header in (True, False):
        rows = read_spend(spark, str(tmp_path / "f.txt"), header=header).collect()
        got = [(r.Department, r.Entity, r.DateOfPayment) for r in rows]
        want = [("Dé", '"E', "01/02/2013"), ("D2", "l'été", "02/02/2013")]
        assert got == want if header else got == [tuple(SPEND_COLUMNS[:3]), *want]
        assert all(r._corrupt_record is None for r in rows)


def test_files_of_several_kinds_are_one_staging_table(spark, tmp_path):
    for i, (encoding, ending) in enumerate([("UTF-8", "\n"), ("UTF-16LE", "\r\n"), ("UTF-16BE", "\n")]):
        body = ending.join([HEADER, _line(f"D{i}", "x"), _line(f"E{i}", "y")]) + ending
        (tmp_path / f"{i}.txt").write_bytes((MARKS[encoding] if i else b"") + body.encode(encoding))
    rows = read_spend(spark, str(tmp_path)).collect()
    assert sorted(r.Department for r in rows) == ["D0", "D1", "D2", "E0", "E1", "E2"]
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"0.txt", "1.txt", "2.txt"}


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_a_lone_carriage_return_is_data(spark, tmp_path, ending):
    body = ending.join([HEADER, _line("D", "one\rtwo"), _line("E", "z")]) + ending
    (tmp_path / "f.txt").write_bytes(body.encode())
    rows = read_spend(spark, str(tmp_path / "f.txt")).collect()
    assert [(r.Department, r.Entity) for r in rows] == [("D", "one\rtwo"), ("E", "z")]
    assert rows[0].ExpenditureType is None  # no carriage return left over in the last field


def test_utf16_files_split_between_tasks(spark, tmp_path):
    """Many splits of one UTF-16 file: records are cut at the encoded line ending."""
    lines = [HEADER] + [_line(f"Dé{i}", "ऊ਀") for i in range(4000)]
    (tmp_path / "f.txt").write_bytes(b"\xff\xfe" + "".join(x + "\r\n" for x in lines).encode("UTF-16LE"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10007")
    try:
        df = read_spend(spark, str(tmp_path / "f.txt"))
        assert df.select(F.spark_partition_id()).distinct().count() > 5
        rows = df.collect()
        assert sorted(r.Department for r in rows) == sorted(f"Dé{i}" for i in range(4000))
        assert all(r._corrupt_record is None and r.Entity == "ऊ਀" for r in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_missing_and_empty_inputs(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_spend(spark, str(tmp_path / "nothing")).count()
    (tmp_path / "empty.txt").write_bytes(b"")
    assert read_spend(spark, str(tmp_path / "empty.txt")).count() == 0
    (tmp_path / "folder").mkdir()
    empty = read_spend(spark, str(tmp_path / "folder"))
    assert empty.count() == 0 and empty.columns[-2:] == ["_corrupt_record", "source_file"]


def test_writing_a_separator_inside_a_value_is_an_error(spark, tmp_path):
    schema = ", ".join(f"{c} string" for c in SPEND_COLUMNS)
    for i, bad in enumerate(["a\tb", "a\nb", "a\rb"]):
        df = spark.createDataFrame([tuple([bad] + ["x"] * (len(SPEND_COLUMNS) - 1))], schema)
        with pytest.raises(Exception, match="Department holds a field or line separator"):
            write_spend(df, str(tmp_path / f"out{i}"))


# --- one parse of the reject-list document --------------------------------------

def _names_of(spark, path, **options):
    return sorted(r.SupplierName for r in read_reject_list(spark, path, **options).collect())


@pytest.mark.parametrize("repair", [False, True])
def test_only_the_roots_own_suppliers_are_listed(spark, tmp_path, repair):
    path = _xml(tmp_path, '<Suppliers><Old><Supplier SupplierName="NESTED"/></Old>'
                          '<Supplier SupplierName="A"/></Suppliers>')
    assert _names_of(spark, path, repair=repair) == ["A"]


def test_root_tag_over_two_lines_comments_and_doctype(spark, tmp_path):
    path = _xml(tmp_path, '<!DOCTYPE Suppliers>\n<!-- <Suppliers> of old -->\n<Suppliers\n  kind="x">\n'
                          '<Supplier\n SupplierName="A"\n/><!-- <Supplier SupplierName="no"/> -->'
                          '<![CDATA[<Supplier SupplierName="no"/>]]></Suppliers>\n')
    assert _names_of(spark, path) == ["A"]


def test_documents_in_other_encodings(spark, tmp_path):
    body = '<Suppliers><Supplier SupplierName="Café &amp; Ünlü"/></Suppliers>'
    (tmp_path / "a.xml").write_bytes(b"\xff\xfe" + ('<?xml version="1.0" encoding="UTF-16"?>' + body).encode("UTF-16LE"))
    (tmp_path / "b.xml").write_bytes(('<?xml version="1.0" encoding="iso-8859-1"?>' + body).encode("latin-1"))
    (tmp_path / "c.xml").write_bytes(b"\xef\xbb\xbf" + body.encode())
    for name in "abc":
        assert _names_of(spark, str(tmp_path / f"{name}.xml")) == ["Café & Ünlü"]


def test_the_error_says_where_and_why(spark, tmp_path):
    path = _xml(tmp_path, '<Suppliers>\n  <Supplier SupplierName="A & B" />\n</Suppliers>\n')
    with pytest.raises(RejectListError, match="line 3, column 30: The entity name must immediately follow"):
        read_reject_list(spark, path)
    other = _xml(tmp_path, '<Names><Supplier SupplierName="A"/></Names>', "other.xml")
    with pytest.raises(RejectListError, match="root is not <Suppliers> in .*other.xml"):
        read_reject_list(spark, other)
    nameless = _xml(tmp_path, '<Suppliers><Supplier SupplierName="A"/><Supplier/></Suppliers>', "less.xml")
    with pytest.raises(RejectListError, match="1 <Supplier> without SupplierName in .*less.xml"):
        read_reject_list(spark, nameless)
    # an empty file is an empty document, as the server's cast to XML has it
    (tmp_path / "empty.xml").write_bytes(b"")
    assert read_reject_list(spark, str(tmp_path / "empty.xml")).count() == 0
