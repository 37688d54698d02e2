from __future__ import annotations

import json
import subprocess
import sys
import zipfile
from io import BytesIO

import pytest
from pyspark import cloudpickle

from ledgerloom import CUSTOMERS, ORDERS, PRODUCTS, empty_table, read_csv, read_json, read_workbooks
from ledgerloom.sources.workbook import table_batches
from tests.conftest import bag, rows
from trial.files import RELATIONS, pack

HEADER = "Product ID,Category,Sub-Category,Product Name,State,Price Per Product\n"


def save(path, text):
    path.write_text(text)
    return str(path)


def test_csv_quotes_commas_and_line_breaks(spark, tmp_path):
    path = save(
        tmp_path / "p.csv",
        HEADER + 'P1,Tech,Disks,"3.5"" ""Big"" disk, black",NY,12.50\nP2,Tech,Disks,"two\nlines",,7\n',
    )
    assert rows(read_csv(spark, path, PRODUCTS)) == [
        ("P1", "Tech", "Disks", '3.5" "Big" disk, black', "NY", "12.50"),
        ("P2", "Tech", "Disks", "two\nlines", None, "7"),
    ]


def test_csv_short_row_is_padded_with_nulls(spark, tmp_path):
    path = save(tmp_path / "p.csv", HEADER + "P1,Tech\n")
    assert rows(read_csv(spark, path, PRODUCTS)) == [("P1", "Tech", None, None, None, None)]


def test_csv_with_swapped_header_fails_when_checked(spark, tmp_path):
    swapped = HEADER.replace("Category,Sub-Category", "Sub-Category,Category", 1)
    path = save(tmp_path / "p.csv", swapped + "P1,Disks,Tech,Disk,NY,1\n")
    with pytest.raises(Exception, match="CSV header|header"):
        read_csv(spark, path, PRODUCTS).collect()
    by_position = read_csv(spark, path, PRODUCTS, check_header=False)
    assert rows(by_position)[0][:3] == ("P1", "Disks", "Tech")


def test_csv_folder_of_files_without_line_breaks(spark, tmp_path):
    folder = tmp_path / "products"
    folder.mkdir()
    save(folder / "a.csv", HEADER + "P1,A,B,C,D,1\n")
    save(folder / "b.csv", HEADER + "P2,A,B,C,D,2\n")
    df = read_csv(spark, str(folder), PRODUCTS, multi_line=False)
    assert [r[0] for r in bag(df)] == ["P1", "P2"]


def order(**changes):
    record = {
        "Row ID": 1, "Order ID": "O1", "Order Date": "21/8/2016", "Ship Date": "25/8/2016",
        "Ship Mode": "Standard", "Customer ID": "C1", "Product ID": "P1", "Quantity": 2,
        "Price": 10.5, "Discount": 0.1, "Profit": 1.25,
    }
    record.update(changes)
    return record


def test_json_array_of_objects(spark, tmp_path):
    records = [order(), order(**{"Row ID": 2, "Price": 1, "Extra": "dropped"})]
    path = save(tmp_path / "o.json", json.dumps(records, indent=2))
    expected = ("O1", "21/8/2016", "25/8/2016", "Standard", "C1", "P1", 2)
    assert rows(read_json(spark, path, ORDERS)) == [
        (1, *expected, 10.5, 0.1, 1.25),
        (2, *expected, 1.0, 0.1, 1.25),
    ]


@pytest.mark.parametrize("value", ["2", 2.0, 2.7])
def test_json_value_of_wrong_type_is_null_and_the_rest_is_kept(spark, tmp_path, value):
    path = save(tmp_path / "o.json", json.dumps([order(Quantity=value)]))
    row = read_json(spark, path, ORDERS).first()
    assert (row["Quantity"], row["Order ID"], row["Profit"]) == (None, "O1", 1.25)


def test_json_missing_keys_are_null(spark, tmp_path):
    path = save(tmp_path / "o.json", '[{"Order ID": "O1", "Profit": "1.5"}]')
    row = read_json(spark, path, ORDERS).first()
    assert (row["Order ID"], row["Profit"], row["Row ID"]) == ("O1", None, None)


def test_json_cut_document_is_one_empty_row(spark, tmp_path):
    path = save(tmp_path / "o.json", json.dumps([order(), order()])[:-40])
    assert rows(read_json(spark, path, ORDERS)) == [(None,) * 11]


def test_json_one_object_per_line(spark, tmp_path):
    path = save(tmp_path / "o.json", "\n".join(json.dumps(order(**{"Row ID": i})) for i in (1, 2)))
    df = read_json(spark, path, ORDERS, multi_line=False)
    assert [r[0] for r in bag(df)] == [1, 2]


@pytest.mark.parametrize(
    ("read", "table"), [(read_csv, PRODUCTS), (read_json, ORDERS), (read_workbooks, CUSTOMERS)]
)
def test_missing_source(spark, tmp_path, read, table):
    path = str(tmp_path / "absent")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read(spark, path, table)
    empty = read(spark, path, table, on_missing="empty")
    assert empty.schema == table.source_schema
    assert rows(empty) == []


def test_empty_table_has_the_declared_schema(spark):
    empty = empty_table(spark, ORDERS.schema)
    assert (empty.schema, empty.count()) == (ORDERS.schema, 0)


# workbooks

NAMES = CUSTOMERS.source_schema.names
SHARED = "".join(f"<si><t>{name}</t></si>" for name in NAMES)
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"


def sheet_xml(*lines):
    return f'<worksheet xmlns="{MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def book(*lines, shared="", names=range(11), **options):
    header = "".join(f'<c t="s"><v>{i}</v></c>' for i in names)
    sheet = sheet_xml(f'<row r="1">{header}</row>', *lines)
    return pack(sheet, f'<sst xmlns="{MAIN}">{SHARED}{shared}</sst>', **options)


def read_book(spark, tmp_path, content):
    path = tmp_path / "Customer.xlsx"
    path.write_bytes(content)
    return rows(read_workbooks(spark, str(path), CUSTOMERS))


def text(reference, value):
    return f'<c r="{reference}" t="inlineStr"><is><t>{value}</t></is></c>'


def test_workbook_kinds_of_cells(spark, tmp_path):
    line = (
        '<row r="2"><c r="A2" t="s"><v>11</v></c>'
        + text("B2", "NA")
        + '<c r="D2"><v>5550001</v></c>'
        + '<c r="E2" t="str"><f>A1</f><v>1 Main St</v></c>'
        + '<c r="F2" t="b"><v>1</v></c><c r="G2" t="e"><v>#DIV/0!</v></c>'
        + '<c r="H2"><v>1.5</v></c><c r="I2"/><c r="J2"><v>10001.0</v></c>'
        + '<c r="K2" t="inlineStr"><is><r><t>Ea</t></r><r><t>st</t></r><rPh><t>x</t></rPh></is></c></row>'
    )
    shared = "<si><r><t>CUST</t></r><r><t>-001</t></r></si>"
    assert read_book(spark, tmp_path, book(line, shared=shared)) == [
        ("CUST-001", None, None, "5550001", "1 Main St", "True", None, "1.5", None, "10001", "East")
    ]


@pytest.mark.parametrize("word", ["", "#N/A", "NULL", "NaN", "None", "n/a", "nan", "null", "-1.#IND"])
def test_workbook_words_for_no_value(spark, tmp_path, word):
    line = f'<row r="2">{text("A2", "C1")}{text("B2", word)}</row>'
    assert read_book(spark, tmp_path, book(line))[0][:2] == ("C1", None)


def test_workbook_rows_left_out_are_empty_and_trailing_ones_dropped(spark, tmp_path):
    lines = (
        f'<row r="2">{text("A2", "C1")}</row>',
        f'<row r="4">{text("A4", "C2")}</row>',
        '<row r="5"><c r="A5"/></row>',
    )
    result = read_book(spark, tmp_path, book(*lines))
    assert [r[0] for r in result] == ["C1", None, "C2"]


def test_workbook_without_cell_and_row_references(spark, tmp_path):
    cells = "".join(f"<c><v>{i}</v></c>" for i in range(11))
    assert read_book(spark, tmp_path, book(f"<row>{cells}</row>")) == [
        tuple(str(i) for i in range(11))
    ]


def test_workbook_columns_are_found_by_name(spark, tmp_path):
    line = f'<row r="2">{text("A2", "East")}{text("K2", "C1")}</row>'
    result = read_book(spark, tmp_path, book(line, names=reversed(range(11))))
    assert (result[0][0], result[0][10]) == ("C1", "East")


def test_workbook_without_a_declared_column_fails(spark, tmp_path):
    with pytest.raises(Exception, match="workbook has no column"):
        read_book(spark, tmp_path, book(names=range(10)))


def test_workbook_sheet_with_absolute_target(spark, tmp_path):
    content = book(f'<row r="2">{text("A2", "C1")}</row>', target="/xl/worksheets/sheet7.xml")
    assert read_book(spark, tmp_path, content)[0][0] == "C1"


def with_chart_sheet_first(content):
    """The workbook with a chart sheet listed before its sheet."""
    out = BytesIO()
    with zipfile.ZipFile(BytesIO(content)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            part = old.read(name).decode()
            if name == "xl/workbook.xml":
                part = part.replace("<sheets>", '<sheets><sheet name="Chart" sheetId="9" r:id="rId9"/>')
            if name.endswith(".rels"):
                kind = f"{RELATIONS}/chartsheet"
                chart = f'<Relationship Id="rId9" Type="{kind}" Target="chartsheets/sheet1.xml"/>'
                part = part.replace("</Relationships>", f"{chart}</Relationships>")
            new.writestr(name, part)
    return out.getvalue()


def test_workbook_whose_first_sheet_is_a_chart(spark, tmp_path):
    content = book(f'<row r="2">{text("A2", "K1")}</row>')
    assert read_book(spark, tmp_path, with_chart_sheet_first(content)) == [("K1", *[None] * 10)]


def test_file_that_is_not_a_workbook_fails(spark, tmp_path):
    with pytest.raises(Exception, match="BadZipFile"):
        read_book(spark, tmp_path, b"notes")


def test_workbook_tasks_need_no_copy_of_the_package(tmp_path):
    task = tmp_path / "task.pickle"
    task.write_bytes(cloudpickle.dumps(table_batches))
    content = tmp_path / "Customer.xlsx"
    content.write_bytes(book(f'<row r="2">{text("A2", "C1")}</row>'))
    script = (
        "import pickle, zipfile\n"
        "read = pickle.load(open('task.pickle', 'rb'))\n"
        f"print([b.num_rows for b in read(zipfile.ZipFile('Customer.xlsx'), {NAMES})])\n"
    )
    ran = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert ran.stdout.strip() == "[1]"


def test_many_workbooks_with_many_rows(spark, tmp_path):
    folder = tmp_path / "customers"
    folder.mkdir()
    for number in range(3):
        lines = [f'<row r="{i}">{text(f"A{i}", f"C{number}-{i}")}</row>' for i in range(2, 6003)]
        (folder / f"{number}.xlsx").write_bytes(book(*lines))
    df = read_workbooks(spark, str(folder), CUSTOMERS)
    assert df.count() == 3 * 6001
    assert df.select("Customer ID").distinct().count() == 3 * 6001


FORMATS = {
    "0": "General", "14": None, "22": None, "46": None, "164": "dd/mm/yyyy", "165": "yyyy\\-mm\\-dd;@",
    "166": "[h]:mm", "167": '#,##0.00" days"', "168": "[Red]0.0;[Blue]\\d0", "169": "[$-409]d\\-mmm\\-yy", "170": "h:mm AM/PM",
    "171": "0.00E+00", "172": "_($* #,##0_)",
}


def styled_book(*cells, since_1904=False):
    """A workbook with one row of (format number, value) cells, and its styles."""
    line = "".join(f'<c s="{list(FORMATS).index(f)}"><v>{value}</v></c>' for f, value in cells)
    content = BytesIO(book(f'<row r="2">{line}</row>'))
    codes = "".join(f"<numFmt numFmtId='{n}' formatCode='{c}'/>" for n, c in FORMATS.items() if c)
    styles = "".join(f'<xf numFmtId="{n}"/>' for n in FORMATS)
    out = BytesIO()
    with zipfile.ZipFile(content) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            part = old.read(name).decode()
            if name == "xl/workbook.xml" and since_1904:
                part = part.replace("<sheets>", '<workbookPr date1904="1"/><sheets>')
            new.writestr(name, part)
        new.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{MAIN}"><numFmts>{codes}</numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>'
            f"<cellXfs>{styles}</cellXfs></styleSheet>",
        )
    return out.getvalue()


def test_workbook_dates_are_text_and_numbers_stay_numbers(spark, tmp_path):
    cells = [
        ("14", 42618), ("22", 42618.5), ("164", "42618.0"), ("165", 42618.604166666664), ("169", 1), ("170", 0.604166666),
        ("46", 1.0833333333333333), ("0", 42618), ("167", 42618.25), ("168", 7), ("171", 3.5),
    ]
    assert read_book(spark, tmp_path, styled_book(*cells)) == [
        (
            "2016-09-05 00:00:00", "2016-09-05 12:00:00", "2016-09-05 00:00:00", "2016-09-05 14:30:00",
            "1900-01-01 00:00:00", "14:30:00", "1 day, 2:00:00", "42618", "42618.25", "7", "3.5",
        )
    ]


def test_workbook_dates_since_1904_and_at_the_ends_of_the_calendar(spark, tmp_path):
    cells = [("14", 41156), ("14", 0), ("14", 1), ("14", 1e9), ("166", 0.5), ("172", 2)]
    assert read_book(spark, tmp_path, styled_book(*cells, since_1904=True))[0][:6] == (
        "2016-09-05 00:00:00", "00:00:00", "1904-01-02 00:00:00", None, "12:00:00", "2",
    )
    cells = [("14", 59), ("14", 60), ("14", 61), ("14", 0.25), ("14", 2958465)]
    assert read_book(spark, tmp_path, styled_book(*cells))[0][:5] == (
        "1900-02-28 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00", "06:00:00", "9999-12-31 00:00:00",
    )


def test_workbook_dates_that_are_texts(spark, tmp_path):
    values = ["2016-09-05T00:00:00", "2016-09-05T14:30:00Z", "2016-09-05", "14:30:00", "soon"]
    line = "".join(f'<c t="d"><v>{value}</v></c>' for value in values)
    assert read_book(spark, tmp_path, book(f'<row r="2">{line}</row>'))[0][:5] == (
        "2016-09-05 00:00:00", "2016-09-05 14:30:00", "2016-09-05", "14:30:00", None,
    )
