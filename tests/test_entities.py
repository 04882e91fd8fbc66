from starfold.fixed import ID_URL_PREFIX as URL


def test_author_alternatives_keep_places(table_of):
    rows = table_of("author_alternative_name", {"id": "A1", "display_name_alternatives": ["a", "", "a", "b"]})
    assert rows == [(1, 1, "a"), (1, 4, "b")]


def test_institution_acronyms_are_dense(table_of):
    rows = table_of("institution_acronym", {"id": "I1", "display_name_acronyms": ["a", "", "a", "b"]})
    assert rows == [(1, 1, "a"), (1, 2, "b")]


def test_ancestors_mix_objects_and_ids(table_of):
    rows = table_of("concept_ancestor", {"id": "C1", "ancestors": [{"id": "C1"}, "C2", None, {"name": "7"}, {"id": "C4"}]})
    assert rows == [(1, 1, 1), (1, 2, 2), (1, 3, 4)]


def test_roles_skip_what_is_no_object(table_of):
    record = {"id": "I1", "roles": ["x", {"role": "funder", "id": "F1"}, {"role": "publisher", "id": "P2"},
                                    {"role": "funder"}, {"role": "funder", "id": "F3"}]}
    assert table_of("institution_funder", record) == [(1, 1, 1), (1, 2, 3)]
    assert table_of("institution_publisher", record) == [(1, 1, 2)]


def test_country_first_row_wins_even_without_name(table_of):
    rows = table_of(
        "country", {"id": "I1", "country_code": "NL", "geo": {}}, {"id": "I2", "country_code": "NL", "geo": {"country": "Netherlands"}},
        {"id": "I3", "country_code": "", "geo": {"country": "Nowhere"}})
    assert rows == [("NL", None)]


def test_city_zero_is_not_set(table_of):
    geo = [{"geonames_city_id": "0", "city": "A"}, {"geonames_city_id": 5, "city": "B"}, {"geonames_city_id": "5", "city": "C"},
           {"geonames_city_id": "6", "city": ""}]
    assert table_of("city", *[{"id": f"I{i}", "geo": g} for i, g in enumerate(geo)]) == [(5, "B")]


def test_author_years_are_dense_on_both_levels(table_of):
    affiliations = [{"institution": {"id": "none"}, "years": [1]}, {"institution": {"id": "I5"}, "years": [2020, "x", 2019]},
                    "odd", {"institution": None}, {"institution": {"id": "I6"}}]
    record = {"id": "A1", "affiliations": affiliations}
    assert table_of("author_institution", record) == [(1, 1, 5), (1, 2, 6)]
    assert table_of("author_institution_year", record) == [(1, 1, 1, 2020), (1, 1, 2, 2019)]


def test_last_known_institutions(table_of):
    rows = table_of(
        "author_last_known_institution",
        {"id": "A1", "last_known_institution": {"id": "I2"}, "last_known_institutions": [{"id": "I1"}, {"id": "I2"}, "I9", {"id": None}]},
        {"id": "A2", "last_known_institution": "I2", "last_known_institutions": {"id": "I1"}})
    assert rows == [(1, 1, 2), (1, 2, 1)]


def test_international_names(table_of):
    rows = table_of("institution_international_name", {"id": "I1", "international": {"display_name": {"b": "x", "a": "", "c": None}}},
                    '{"id":"I2","international":{"display_name":{"a":"old","a":"new"}}}', {"id": "I3"})
    assert rows == [(1, "b", "x"), (2, "a", "new")]


def test_source_details(table_of):
    rows = table_of(
        "source", {"id": "S1", "host_organization": f"{URL}I3", "publisher_id": "P4", "issn_l": "urn:issn:1234-567x"},
        columns=["host_organization_publisher_id", "host_organization_institution_id", "issn_l"])
    assert rows == [(4, 3, "1234-567X")]
    assert table_of("source_issn", {"id": "S1", "issn": [], "ids": {"issn": ["1234-5678", "x", "ISSN:1234-5678"]}}) == [(1, 1, "1234-5678")]
    assert table_of("source_society", {"id": "S1", "societies": [{"organization": "", "name": "n"}, {}, {"url": "u"}, 3]}) == [
        (1, 1, "n", None), (1, 2, None, "u")]
    assert table_of("source_apc_price", {"id": "S1", "apc_prices": [{"price": 0, "currency": "USD"}, {"price": 5}, {"price": 7, "currency": "EUR"}]}) == [
        (1, 1, 0, "USD"), (1, 2, 7, "EUR")]


def test_publisher_parent_only_from_an_object(table_of):
    rows = table_of("publisher", {"id": "P1", "parent_publisher": {"id": "P9"}}, {"id": "P2", "parent_publisher": "P9"},
                    columns=["publisher_id", "parent_publisher_id"])
    assert rows == [(1, 9), (2, None)]


def test_taxonomy_uses_numbers_as_ids(table_of):
    record = {"id": f"{URL}fields/17", "domain": {"id": f"{URL}domains/3"}, "siblings": [{"id": f"{URL}fields/18"}, "x", f"{URL}fields/19"]}
    assert [r[:1] + r[3:4] + r[6:7] for r in table_of("field", record)] == [(17, 17, 3)]
    assert table_of("field_sibling", record) == [(17, 1, 18), (17, 2, 19)]


def test_type_trouble_in_one_field_spares_the_document(table_of):
    rows = table_of("concept", {"id": "C1", "level": "2", "display_name": 5}, columns=["concept_id", "concept", "level"])
    assert rows == [(1, "5", 2)]


def test_all_tables_are_declared():
    from starfold.fixed import ENTITIES
    from starfold.plans.registry import TABLES

    assert len(TABLES) == 88
    assert {t.entity for t in TABLES.values()} == set(ENTITIES)
    for t in TABLES.values():
        assert set(t.key) <= {c.name for c in t.columns}
