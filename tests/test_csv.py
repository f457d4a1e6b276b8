"""CSV scans: fixed schemas, FAILFAST at the action, corrupt-record capture."""

import os
import tempfile

import pytest

from cardflow.sources import csv

# A raw customer file with one malformed income.
CUSTOMER_FILE = """CUSTOMER_ID,FIRST_NAME,MIDDLE_NAME,LAST_NAME,DOB,ADDRESS1,ADDRESS2,STATE,CITY,COUNTRY,PIN_CODE,CUST_PEP_EXPOSED,ANNUAL_INCOME
1,Ann,,Lee,01-02-1990,,STREET,TEXAS,AUSTIN,india,111111,true,1000.5
2,Bob,,Ray,03-04-1985,,STREET,OHIO,DAYTON,india,111112,true,not-a-number
"""


def _file(text: str) -> str:
    d = tempfile.mkdtemp(prefix="cardflow-csv-")
    p = os.path.join(d, "customers.csv")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_permissive_keeps_rows_with_null_field(spark):
    rows = {r["CUSTOMER_ID"]: r for r in csv.read_customers(spark, _file(CUSTOMER_FILE)).collect()}
    assert rows["1"]["ANNUAL_INCOME"] == 1000.5 and rows["1"]["MIDDLE_NAME"] is None
    assert rows["2"]["ANNUAL_INCOME"] is None


def test_failfast_raises_at_the_action_not_the_load(spark):
    df = csv.read_customers(spark, _file(CUSTOMER_FILE), mode="FAILFAST")   # no error yet
    with pytest.raises(Exception):
        df.collect()


MALFORMED = CUSTOMER_FILE + """3,Eve,,Poe,05-06-1970,,STREET,UTAH,PROVO,india,111113,true
4,Sam,,Fox,07-08-1960,,STREET,IOWA,AMES,india,111114,true,10,one-too-many
5,"Kim, Jr",,Roe,09-10-1950,,STREET,MAINE,BATH,india,111115,true,20
"""


def test_corrupt_records_whatever_columns_are_read(spark):
    bad = csv.corrupt_records(spark, _file(MALFORMED), csv.CUSTOMER_DDL)
    rows = {r["CUSTOMER_ID"]: r for r in bad.collect()}
    assert sorted(rows) == ["2", "3", "4"]                  # no number, a field short, a field long
    assert rows["2"][csv.CORRUPT].endswith("not-a-number")
    assert rows["4"][csv.CORRUPT].endswith("10,one-too-many")
    assert bad.count() == 3
    assert sorted(r[0] for r in bad.select("CUSTOMER_ID").collect()) == ["2", "3", "4"]
    assert bad.groupBy("COUNTRY").count().collect()[0]["count"] == 3
    assert bad.filter("ANNUAL_INCOME IS NULL").count() == 2
    assert bad.select(csv.CORRUPT).count() == 3


def _folder(**texts) -> str:
    d = tempfile.mkdtemp(prefix="cardflow-csv-")
    for name, text in texts.items():
        with open(os.path.join(d, f"{name}.csv"), "w", newline="") as f:
            f.write(text)
    return d


def _row(i, income="10", last="Poe", extra=""):
    return f'{i},Eve,,{last},05-06-1970,,STREET,UTAH,PROVO,india,111113,true,{income}{extra}\n'


def test_records_over_lines_and_any_character(spark):
    """A line end in quotes belongs to its record, and no character separates what it should not."""
    head = CUSTOMER_FILE.split("\n")[0] + "\n"
    path = _folder(a=head + _row(1, last='"Poe\nof Provo"') + _row(2, "ten", last='"Poe\n\n,of"') + _row(3, extra=",y\u0001z,more"),
                   b=head + "\n" + _row(4, "\u0001") + _row(5, last='"a ""quoted"" name"') + _row(6, "n/a"))
    bad = {r["CUSTOMER_ID"]: r for r in csv.corrupt_records(spark, path, csv.CUSTOMER_DDL, with_place=True).collect()}
    assert sorted(bad) == ["2", "3", "4", "6"]
    assert bad["2"][csv.CORRUPT] == _row(2, "ten", last='"Poe\n\n,of"').rstrip("\n") and bad["2"]["LAST_NAME"] == "Poe\n\n,of"
    assert bad["3"][csv.CORRUPT].endswith("10,y\u0001z,more") and bad["4"][csv.CORRUPT].endswith("\u0001")
    assert {i: (r["_file"].rsplit("/", 1)[1], r["_record"]) for i, r in bad.items()} == {
        "2": ("a.csv", 2), "3": ("a.csv", 3), "4": ("b.csv", 1), "6": ("b.csv", 3)}


def test_records_of_a_file_that_is_read_in_parts(spark):
    """Quotes that are open where one part of a file ends are known to the next."""
    rows = [_row(i, "x" if i % 7 == 0 else "1", last='"' + "very long\n" * (i % 5 * 40) + 'name"') for i in range(300)]
    path = _folder(a=CUSTOMER_FILE.split("\n")[0] + "\n" + "".join(rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        bad = csv.corrupt_records(spark, path, csv.CUSTOMER_DDL, with_place=True).collect()
        whole = {r["at"]: r["record"] for r in csv.records(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [whole[i + 1] + "\n" for i in range(300)] == rows and len(whole) == 301
    assert sorted((r["_record"], r[csv.CORRUPT] + "\n") for r in bad) == [(i + 1, rows[i]) for i in range(0, 300, 7)]
