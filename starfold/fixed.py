"""Values that results must agree on.  They are facts of the data, not choices."""

# Address prefixes and the column that keeps a record's short id.
ID_URL_PREFIX = "https://openalex.org/"
DOI_URL_PREFIX = "https://doi.org/"
SHORT_ID = "openalex_id"

# The characters that count as white space, in code-point order.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Entities, in the order "all" stands for.
ENTITIES = (
    "works", "authors", "institutions", "concepts", "domains", "fields",
    "subfields", "topics", "funders", "publishers", "sources",
)

# Names a work's data sources can have, in the order tested.
ARXIV, PUBMED, DATACITE, CROSSREF, DOAJ = "arxiv", "pubmed", "datacite", "crossref", "doaj"
