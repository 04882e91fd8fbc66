import datetime

import pytest
from pyspark.sql import functions as F

from starfold.fixed import ID_URL_PREFIX as URL
from starfold.functions import text as X
from starfold.sinks.delimited import double_text

D = datetime.date

CASES = {
    "short_id": (X.short_id, [
        (None, None), ("", None), ("  ", None), (f"{URL}W12", "W12"), (" W12\n", "W12"),
        (f"{URL}domains/1", "domains/1"), (URL, None), ("http://other/W1", "http://other/W1")]),
    "id_number": (X.id_number, [
        (f"{URL}W12", 12), ("W12", 12), (f"{URL}domains/1", 1), ("none", None), ("W12x", None), ("W", None),
        ("", None), ("7", 7), ("W99999999999999999999999", None)]),
    "iso_date_text": (X.iso_date_text, [
        ("2024-01-05", "2024-01-05"), ("2024-01-05T10:11:12", "2024-01-05"), ("2024-01-05T10:11:12.123", "2024-01-05"),
        ("2024-01-05T10:11:12.123456", "2024-01-05"), ("2024-1-5", "2024-01-05"),
        ("2024-01-05T10:11:12Z", "2024-01-05T10:11:12Z"), ("soon", "soon"), ("2024-13-05", "2024-13-05"), ("", None)]),
    "iso_day_text": (X.iso_day_text, [("2024-01-05T10:11:12Z", "2024-01-05"), ("soon", "soon"), (None, None)]),
    "day": (X.day, [
        ("2024-01-05T10:11:12Z", D(2024, 1, 5)), ("2024-1-5", D(2024, 1, 5)), ("2024-01-05T1:2:3.5", D(2024, 1, 5)),
        ("2024", None), ("soon", None), ("2024-02-30", None), ("", None)]),
    "whole_number": (X.whole_number, [(" 12 ", 12), ("12.7", None), ("-3", -3), ("", None), ("x", None)]),
    "decimal_number": (X.decimal_number, [("1.5", 1.5), (" 2 ", 2.0), ("x", None), ("1e2", 100.0), ("1d", None), ("-.5", -0.5), ("3.", 3.0)]),
    "flag": (X.flag, [
        ("TRUE", True), (" t ", True), ("1", True), ("Yes", True), ("y", True), ("false", False), ("F", False),
        ("0", False), ("no", False), ("N", False), ("maybe", None), ("", None), (None, None)]),
    "longest_number": (X.longest_number, [
        ("a 3456 x 7890", 7890), ("PMC123", 123), (" 42 ", 42), ("1 and 22", 22), ("7 or 8", 8), ("12 345 6789 1", 6789),
        ("none", None), ("", None), ("-5", -5)]),
    "language_code": (X.language_code, [("EN-us", "en"), ("f", "f"), ("", None), (None, None)]),
    "last_segment": (X.last_segment, [
        ("https://x/wiki/Q1/", "Q1"), ("Q1", "Q1"), (" https://x/Q2 ", "Q2"), ("", None), ("///", None)]),
    "segment_number": (X.segment_number, [("https://x/sdg/3/", 3), ("https://x/none", None), ("", None)]),
    "orcid": (X.orcid, [
        ("https://orcid.org/0000-0002-1825-009x", "0000-0002-1825-009X"), ("0000000218250097", "0000-0002-1825-0097"),
        ("id 000000021825009x.", "0000-0002-1825-009X"), ("0000 0002 1825 0097", "0000-0002-1825-0097"),
        ("000000021825009", None), ("", None), ("00000002182500971", None)]),
    "scopus_author": (X.scopus_author, [
        ("http://x?authorID=7004185&x", 7004185), (" 55 ", 55), ("a55", None), ("", None)]),
    "doi": (X.doi, [
        ("HTTPS://DOI.ORG/10.1/A", "10.1/A"), ("http://dx.doi.org/10.1/A", "http://dx.doi.org/10.1/A"),
        (" 10.1/b ", "10.1/b"), ("", None)]),
    "issn": (X.issn, [
        ("urn:issn:1234-567x", "1234-567X"), ("1234567X", None), (" 1234-5678 ", "1234-5678"), ("a:b:1234-5679", "1234-5679"),
        ("", None)]),
    "collapse_spaces": (X.collapse_spaces, [
        (" a\t\r\n b  c\x1cd ", "a b c d"), ("　", None), ("", None), ("a​b", "a​b")]),
    "publisher": (lambda c: X.id_with_letter(c, "P"), [(f"{URL}P5", 5), ("I5", None), ("", None)]),
    "element_id": (X.element_id, [('{"id":"C1"}', "C1"), ("C2", "C2"), ('{"name":"5"}', None), (None, None)]),
    "canonical": (X.canonical_object, [
        ('{"b":1,"a":{"d":2,"c":null}}', '{"a":{"c":null,"d":2},"b":1}'), ("{}", "{}"), ("no json", None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_scalar(spark, name):
    function, cases = CASES[name]
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, text string")
    found = rows.select("i", function(F.col("text")).alias("out")).orderBy("i").collect()
    assert [(cases[r["i"]][0], r["out"]) for r in found] == cases


def test_number_forms(spark):
    row = spark.range(1).select(
        X.whole_of_number(F.lit(12.7)).alias("a"), X.flag_of_number(F.lit(2)).alias("b"),
        X.flag_of_number(F.lit(0.0)).alias("c"), X.map_text(F.create_map(F.lit("k"), F.lit(" v ")), "k").alias("d"),
        X.map_text(F.create_map(F.lit("k"), F.lit(" v ")), "z").alias("e"),
    ).first()
    assert tuple(row) == (12, True, False, "v", None)


def test_page_range(spark):
    rows = spark.createDataFrame([("1", "9"), ("1", None), ("1", ""), (None, "9"), ("", "")], "a string, b string")
    assert [r[0] for r in rows.select(X.page_range(F.col("a"), F.col("b"))).collect()] == ["1-9", "1", "1", None, None]


def test_affiliation_texts(spark):
    rows = spark.createDataFrame(
        [(["a  b", " ", None, "c"], "x"), ([], " d ; ;e\nf"), (None, None), ([""], "g")], "many array<string>, one string"
    )
    found = [r[0] for r in rows.select(X.affiliation_texts(F.col("many"), F.col("one"))).collect()]
    assert found == [["a b", "c"], ["d", "e f"], [], ["g"]]


def test_double_text_is_pythons(spark):
    values = [0.0, 1.0, -1.5, 0.1, 0.001, 0.0001, 0.00015, 1e-5, 1.25e-7, 1e6, 1e7, 12345678.0, 1.5e7, 123456789.125,
              1e15, 1.5e15, 1e16, -2.5e20, 1e100, 1e-300, 0.3333333333333333]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in rows.select(double_text(F.col("v"))).collect()] == [repr(v) for v in values]
