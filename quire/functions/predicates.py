"""What a heading is, told by its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
END_MATTER = (
    r"\btool\s+kit\b", r"^annex\b", r"^appendix\b", r"^references?\b", r"^bibliography\b",
    r"^glossary\b", r"^index\b", r"^acknowledgements?\b", r"\babout\s+the\s+author\b",
)
FRONT_MATTER = ("table of contents", "contents", "foreword", "preface", "acknowledgement", "acronym", "abbreviation", "executive summary")
SUBSECTION = (r"step\s+\d+[:.]", r"[a-z]\)", r"[ivx]+\)", r"\([a-z]\)", r"[a-z]\.([^0-9]|$)")


def is_end_matter(heading: Column) -> Column:
    return F.lower(heading).rlike("|".join(END_MATTER))


def is_front_matter(heading: Column) -> Column:
    return F.lower(heading).rlike("|".join(FRONT_MATTER))


def is_subsection(heading: Column) -> Column:
    """Steps, letters and small Roman numerals that stand under the heading before."""
    return F.lower(heading).rlike(f"^(?:{'|'.join(SUBSECTION)})")


def numbering_level(heading: Column) -> Column:
    """1 for end matter, else the depth of a leading number, 5 at most; null without a number."""
    number = F.regexp_extract(heading, r"^(\d+(?:\.\d+)*)", 1)
    return F.when(is_end_matter(heading), 1).when(number != "", F.least(F.size(F.split(number, r"\.")), F.lit(5)))
