"""Delimited files (K1, K3) and the saved catalogue (K4)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.catalogue import CATALOGUES, Catalogue, CatalogueConfig
from ..session import at_once


def double_text(c: Column) -> Column:
    """A double in its usual decimal form: exponents only below 1e-4 and from 1e16."""
    s = c.cast("string")
    pattern = r"^(-?)([0-9])\.([0-9]+)E(-?[0-9]+)$"
    sign, lead, frac = (F.regexp_extract(s, pattern, g) for g in (1, 2, 3))
    exponent = F.regexp_extract(s, pattern, 4).try_cast("int")
    frac = F.when(frac == "0", F.lit("")).otherwise(frac)
    digits = F.concat(lead, frac)
    whole = exponent + 1
    positional = F.concat(
        sign,
        F.rpad(F.substring(digits, F.lit(1), whole), whole, F.lit("0")),
        F.lit("."),
        F.coalesce(X.filled(F.substring(digits, whole + 1, F.length(digits))), F.lit("0")),
    )
    small = F.concat(sign, F.lit("0.000"), digits)
    scientific = F.concat(
        sign, lead, F.when(frac != "", F.concat(F.lit("."), frac)).otherwise(F.lit("")),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.length(F.abs(exponent).cast("string")), F.lit(2)), F.lit("0")),
    )
    return (
        F.when(exponent.isNull(), s)
        .when(exponent.between(7, 15), positional)
        .when(exponent == -4, small)
        .otherwise(scientific)
    )


def cell(c: Column, kind: str) -> Column:
    """K3: a value as text; null is empty, texts have their white space collapsed."""
    if kind == "string":
        shown = X.collapse_spaces(c)
    elif kind == "boolean":
        shown = F.when(c, F.lit("1")).otherwise(F.when(~c, F.lit("0")))
    elif kind in ("double", "float"):
        shown = double_text(c)
    elif kind == "date":
        shown = F.date_format(c, "yyyy-MM-dd")
    elif kind.startswith("timestamp"):
        shown = F.regexp_replace(c.cast("string"), " ", "T")
    else:
        shown = c.cast("string")
    return F.coalesce(shown, F.lit(""))


def formatted(df: DataFrame) -> DataFrame:
    return df.select(*[cell(F.col(n), kind).alias(n) for n, kind in df.dtypes])


def write_delimited(df: DataFrame, path: str, delimiter: str = "\t", encoding: str = "UTF-8") -> None:
    """K1: a folder of files, each with a header; one file per task, so any size."""
    if len(delimiter) != 1:
        raise ValueError("the delimiter is a single character")
    writer = formatted(df).write.mode("overwrite").option("header", True).option("sep", delimiter)
    for name, value in (("quote", '"'), ("escape", '"'), ("emptyValue", ""), ("nullValue", ""), ("lineSep", "\n")):
        writer = writer.option(name, value)
    writer.option("encoding", encoding).csv(path)


#: Beside the exported files: the catalogue itself.  Rows of the catalogue without a name
#: are the entities it was collected from, so that both are replaced by one write.
VALUES, ENTITIES_FED = "_values", ""


def save_catalogue(catalogue: Catalogue, folder: str, entities: Iterable[str] = ()) -> None:
    """K4: the assignments as Parquet, which keeps every value as it is and is what a
    later run reads; and one tab-separated table per catalogue, in id order, also when
    empty.  ``entities`` are those whose documents were all looked at."""
    root, spark = folder.rstrip("/"), catalogue.assigned.sparkSession

    def save(config: CatalogueConfig) -> None:
        # Each task writes a range of ids, so the files are in order one after another.
        rows = catalogue.table(config.name).orderBy(config.id_column)
        writer = rows.write.mode("overwrite").option("header", True).option("sep", "\t").option("escape", '"')
        for end in ("Leading", "Trailing"):
            writer = writer.option(f"ignore{end}WhiteSpace", False)
        writer.csv(f"{root}/{config.file_name}")

    at_once(save, CATALOGUES.values())
    fed = spark.createDataFrame([(ENTITIES_FED, e, None) for e in entities], "catalogue string, value string, id bigint")
    # Last, as its completion says that the catalogue is complete.
    catalogue.assigned.select("catalogue", "value", "id").unionByName(fed).write.mode("overwrite").parquet(f"{root}/{VALUES}")
