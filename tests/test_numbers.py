"""Numbers stay numbers: JSON 2020.0 is a year, the text "2020.0" is not."""

from pyspark.sql import functions as F

from starfold.functions import text as X


def test_work(table_of):
    columns = ["work_id", "pub_year", "n_refs", "n_cits", "mag_id", "is_retracted", "is_paratext", "is_oa", "apc_list_price", "apc_list_price_usd"]
    rows = table_of(
        "work",
        {"id": "W1", "publication_year": 2020.0, "referenced_works_count": 3, "cited_by_count": "4", "ids": {"mag": "5"}, "is_retracted": 2,
         "is_paratext": 0.0, "open_access": {"is_oa": 1.0}, "apc_list": {"value": 1850.0, "value_usd": 12.7}},
        {"id": "W2", "publication_year": "2020.0", "referenced_works_count": "x", "cited_by_count": None, "ids": {"mag": 7.0}, "is_retracted": "2",
         "is_paratext": "No", "open_access": {"is_oa": " TRUE "}, "apc_list": {"value": " 9 ", "value_usd": {"a": 1}}},
        columns=columns,
    )
    assert rows == [
        (1, 2020, 3, 4, 5, True, False, True, 1850, 12),
        (2, None, None, None, 7, None, False, True, 9, None),
    ]


def test_city_prices_years_and_levels(table_of):
    geo = {"city": "Here", "geonames_city_id": 5.0}
    assert table_of("city", {"id": "I1", "geo": geo}) == [(5, "Here")]
    prices = [{"price": 1200.0, "currency": "EUR"}, {"price": "12.7", "currency": "USD"}, {"price": None, "currency": "GBP"}, {"price": "30", "currency": "CHF"}]
    assert table_of("source_apc_price", {"id": "S1", "apc_prices": prices}) == [(1, 1, 1200, "EUR"), (1, 2, None, "USD"), (1, 3, 30, "CHF")]
    years = [{"institution": {"id": "I9"}, "years": [2020.0, "2019", "x", 2018]}]
    assert table_of("author_institution_year", {"id": "A1", "affiliations": years}) == [(1, 1, 1, 2020), (1, 1, 2, 2019), (1, 1, 3, 2018)]
    assert table_of("concept", {"id": "C1", "level": 2.0}, columns=["concept_id", "level"]) == [(1, 2)]
    assert table_of("publisher", {"id": "P1", "hierarchy_level": 1.0}, columns=["publisher_id", "hierarchy_level"]) == [(1, 1)]


def test_citation(table_of):
    rows = table_of(
        "citation",
        {"id": "W1", "publication_year": 2020.0, "referenced_works": ["W2"]}, {"id": "W2", "publication_year": "2015"},
    )
    assert rows == [(1, 1, 2, 2020, 5, None)] or rows == [(1, 1, 2, 2020, 5, False)]


def test_equal_locations_whatever_their_spelling(table_of):
    one, same, other = {"is_oa": True, "rank": 1}, {"rank": 1.0, "is_oa": True}, {"rank": 2, "is_oa": True}
    rows = table_of(
        "work_location", {"id": "W1", "primary_location": one, "locations": [same, other]},
        columns=["location_seq", "is_primary_location", "is_oa"],
    )
    assert rows == [(1, True, True), (2, False, True)]


def test_a_long_doi_is_kept_whole(spark):
    tail = "10.1/" + "x" * 1_100_000
    row = spark.createDataFrame([("https://doi.org/" + tail,)], "d string").select(F.length(X.doi(F.col("d"))).alias("n")).first()
    assert row.n == len(tail)
