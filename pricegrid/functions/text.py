"""Text clean-up expressions."""

from pyspark.sql import functions as F


def title_case(col):
    """Upper-case the first letter of every run of letters, lower-case the rest.

    initcap alone only starts a word after white space, so the text is cut
    into runs of letters and runs of other characters first.
    """
    runs = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def strip(col):
    """Trim white space of any kind, not only blanks."""
    return F.regexp_replace(col, r"^\s+|\s+$", "")


def collapse_spaces(col):
    return F.regexp_replace(col, r"\s+", " ")


def clean_title(col):
    return title_case(strip(col))


def clean_name(col):
    return collapse_spaces(title_case(strip(col)))


def clean_code(col):
    return F.upper(strip(col))
