import json
import random
import re

import pytest

from starfold.fixed import ID_URL_PREFIX as URL


def work(**fields):
    return {"id": f"{URL}W1", **fields}


def test_records_without_number_vanish(table_of):
    assert table_of("work_title", {"id": None, "title": "a"}, {"id": "none", "title": "b"}, {"title": "c"}) == []


def test_title_falls_back_and_is_cleaned(table_of):
    assert table_of("work_title", work(title="", display_name=" a\n b "), {"id": "W2", "title": "  "}) == [(1, "a b")]


def test_positions_keep_gaps(table_of):
    rows = table_of("work_concept", work(concepts=[{"id": "C5", "score": 0.5}, {"score": 1}, {"id": "C7"}]))
    assert rows == [(1, 1, 5, 0.5), (1, 3, 7, None)]


def test_references_keep_nulls(table_of):
    assert table_of("work_reference", work(referenced_works=["W1", "x"])) == [(1, 1, 1), (1, 2, None)]


def test_work_types(table_of):
    rows = table_of(
        "work", {"id": "W1", "type": "a_b"}, {"id": "W2", "type_crossref": "c_d"}, {"id": "W3", "type": ""},
        columns=["work_id", "work_type_id", "crossref_work_type_id"],
    )
    # a-b = 1, c_d = 2, other = 3
    assert rows == [(1, 1, 1), (2, 3, 2), (3, 3, 3)]


def test_goals_first_wins(table_of):
    goal = {"id": "https://x/sdg/3", "display_name": "one"}
    other = {"id": "https://x/sdg/3/", "display_name": "two"}
    assert table_of("sustainable_development_goal", work(sustainable_development_goals=[other, goal]),
                    {"id": "W2", "sustainable_development_goals": [goal]}) == [(3, "two", "https://x/sdg/3/")]


def test_location_equality(table_of):
    primary = {"source": {"id": "S1", "x": 1.5}, "version": "publishedVersion", "n": None}
    reordered = {"version": "publishedVersion", "n": None, "source": {"x": 1.5, "id": "S1"}}
    without_null = {"version": "publishedVersion", "source": {"x": 1.5, "id": "S1"}}
    rows = table_of(
        "work_location", work(primary_location=primary, locations=[reordered, without_null]),
        {"id": "W2", "locations": [{}]},
        columns=["work_id", "location_seq", "is_primary_location", "is_best_oa_location", "is_published"],
    )
    # An empty location equals a missing one.
    assert rows == [(1, 1, True, False, True), (1, 2, False, False, True), (2, 1, True, True, False)]


def test_data_sources_in_order(table_of):
    rows = table_of("work_data_source", work(
        ids={"arxiv": "a", "pmcid": "1"}, doi_registration_agency="DataCite",
        primary_location={"source": {"is_in_doaj": True}}))
    # ids: arxiv 1, datacite 2, doaj 3, pubmed 4
    assert rows == [(1, 1, 1), (1, 2, 4), (1, 3, 2), (1, 4, 3)]


def test_repeated_affiliation_text(table_of):
    record = work(authorships=[{"raw_affiliation_strings": ["X", " X "]}])
    assert table_of("work_affiliation", record) == [(1, 1, 1)]
    assert table_of("work_author_affiliation", record) == [(1, 1, 1), (1, 1, 1)]


def test_author_countries_keep_gaps(table_of):
    rows = table_of("work_author_country", work(authorships=[{}, {"countries": ["US", "", None, "DE"]}]))
    assert rows == [(1, 2, 1, "US"), (1, 2, 4, "DE")]


def test_work_detail_names(table_of):
    people = [{"raw_author_name": n} for n in "abcdef"]
    rows = table_of(
        "work_detail", work(authorships=people, biblio={"first_page": "1", "last_page": "2"}), {"id": "W2"},
        columns=["work_id", "author_first", "author_et_al", "institution_et_al", "pages", "n_self_cits"],
    )
    assert rows == [(1, "a", "b; c; d; ...; f", "", "1-2", 0), (2, None, "", "", None, 0)]


def test_citation_measures(table_of):
    rows = table_of(
        "citation",
        {"id": "W1", "publication_year": 2020, "authorships": [{"author": {"id": "A1"}}, {"author": {"id": "A2"}}],
         "referenced_works": ["W2", "W3", "W9", None]},
        {"id": "W2", "publication_year": 2015, "authorships": [{"author": {"id": "A2"}}]},
        {"id": "W3", "publication_year": None, "authorships": []},
    )
    assert rows == [(1, 1, 2, 2020, 5, True), (1, 2, 3, 2020, None, False), (1, 3, 9, 2020, None, None),
                    (1, 4, None, 2020, None, None)]


# --- institution links against a model ---------------------------------------


def clean(text):
    return " ".join((text or "").split()) or None


def number(text):
    found = re.search(r"^[^0-9]*([0-9]+)$", text or "")
    return int(found.group(1)) if found else None


def texts_of(a):
    listed = [t for t in map(clean, a.get("raw_affiliation_strings") or []) if t]
    return listed or [t for t in map(clean, (a.get("raw_affiliation_string") or "").split(";")) if t]


def model_links(authorships):
    """Every link by brute force: a list per affiliation, looked through in full."""
    known = []
    for t in (t for a in authorships for t in texts_of(a)):
        if t not in known:
            known.append(t)
    found = {}

    def add(label, ref):
        if label not in known or number(ref) is None:
            return False
        seen = found.setdefault(known.index(label) + 1, [])
        if number(ref) in seen:
            return False
        seen.append(number(ref))
        return True

    for a in authorships:
        pairs = [(clean(f.get("raw_affiliation_string")), i)
                 for f in a.get("affiliations") or [] for i in f.get("institution_ids") or []]
        if any([add(label, i) for label, i in pairs]):
            continue
        texts, institutions = texts_of(a), a.get("institutions") or []
        for n, inst in enumerate(institutions):
            add(texts[min(n, len(texts) - 1)] if texts else inst.get("display_name"), inst.get("id"))
    return [(aff, n, inst) for aff, seen in found.items() for n, inst in enumerate(seen, 1)]


def random_authorship(rng):
    texts = ["Univ A", " Univ  B", "Lab C", "", None]
    refs = ["I1", "I2", f"{URL}I3", "I4", "none", None]
    a = {}
    if rng.random() < 0.7:
        a["raw_affiliation_strings"] = [rng.choice(texts) for _ in range(rng.randrange(4))]
    if rng.random() < 0.4:
        a["raw_affiliation_string"] = "; ".join(rng.choice(texts) or " " for _ in range(rng.randrange(1, 4)))
    if rng.random() < 0.6:
        a["affiliations"] = [
            {"raw_affiliation_string": rng.choice(texts + ["Nowhere"]),
             "institution_ids": [rng.choice(refs) for _ in range(rng.randrange(4))] if rng.random() < 0.9 else None}
            for _ in range(rng.randrange(3))
        ]
    if rng.random() < 0.8:
        a["institutions"] = [
            {"id": rng.choice(refs), "display_name": rng.choice(["Univ A", "Univ B", "Other", "", None])}
            for _ in range(rng.randrange(4))
        ]
    return a


def test_institution_links_against_a_model(table_of):
    rng = random.Random(11)
    records = [[random_authorship(rng) for _ in range(rng.randrange(6))] for _ in range(800)]
    wanted = sorted((k, *link) for k, a in enumerate(records) for link in model_links(a))
    found = table_of(
        "work_affiliation_institution", *[{"id": f"W{k}", "authorships": a} for k, a in enumerate(records)])
    assert len(wanted) > 1000
    assert found == wanted


def test_institution_links_when_all_were_seen(table_of):
    # The second author's explicit link is known already, so the institutions count.
    explicit = [{"raw_affiliation_string": "U", "institution_ids": ["I1"]}]
    record = work(authorships=[
        {"raw_affiliation_strings": ["U"], "affiliations": explicit, "institutions": [{"id": "I9"}]},
        {"raw_affiliation_strings": ["U"], "affiliations": explicit, "institutions": [{"id": "I1"}, {"id": "I2"}]},
    ])
    assert table_of("work_affiliation_institution", record) == [(1, 1, 1, 1), (1, 1, 2, 2)]


@pytest.mark.parametrize("authors", [3000])
def test_institution_links_of_a_long_author_list(table_of, authors):
    people = [
        {"raw_affiliation_strings": [f"Univ {i % 150}", "Shared"],
         "affiliations": [{"raw_affiliation_string": f"Univ {i % 150}", "institution_ids": [f"I{i % 97}"]}],
         "institutions": [{"id": f"I{i}"}]}
        for i in range(authors)
    ]
    assert table_of("work_affiliation_institution", json.dumps({"id": "W0", "authorships": people})) == sorted(
        (0, *link) for link in model_links(people))
