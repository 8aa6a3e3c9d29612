"""Document ids and text terms of the vessel index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline.schema import DOC_PREFIX


def doc_id(mmsi: Column) -> Column:
    return F.concat(F.lit(DOC_PREFIX), mmsi.cast("string"))


def strip_doc_prefix(doc: Column) -> Column:
    return F.substr(doc, F.lit(len(DOC_PREFIX) + 1))


def has_term(text: Column, term: Column | str) -> Column:
    """Whole-word, case-insensitive match."""
    wanted = F.lit(term) if isinstance(term, str) else term
    return F.array_contains(F.split(F.lower(text), r"\W+"), F.lower(wanted))


def missing_number_to_null(value: Column) -> Column:
    """NaN and NULL both mean missing."""
    return F.nanvl(value, F.lit(None).cast("double"))
