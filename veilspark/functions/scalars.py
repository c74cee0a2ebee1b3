"""Scalar functions as column expressions: ids, keys, buckets, guards, identity values, status rules."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Statuses and patterns whose results must not differ.
STATUSES = ["found", "not_found", "uncertain", "model_failed", "not_applicable"]
HONORIFICS = r"(?iU)\b(?:dr|prof|professor|mr|mrs|ms|ph\.?d)\.?(?=\s|$)"
YEAR = r"\b(?:19|20)\d{2}\b"
CV_NAME = r"(?i)(?:^|[^a-z])(?:cv|curriculum[ _-]?vitae)(?:[^a-z]|$)"
CV_NAME_LOOSE = r"(?i)cv|curriculum[ _-]?vitae"
CONTROLLED = {
    "degree_type": "associate bachelor bachelors ba b_a bs b_s master masters ma m_a ms m_s mba mph jd md phd ph_d doctorate postdoctoral other",
    "job_category": "academic_faculty academic_staff research teaching administration industry government nonprofit student postdoctoral other",
    "position_type": "faculty staff research teaching administrative postdoctoral student industry government nonprofit other",
    "publication_type": "journal_article conference_paper book book_chapter working_paper preprint report thesis dissertation review editorial other",
}


def stable_id(prefix: str | Column, value: Column, digits: int = 20) -> Column:
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(prefix, F.lit("_"), F.substring(F.sha2(value.cast("string"), 256), 1, digits))


@F.pandas_udf(T.StringType())
def compatible(values: pd.Series) -> pd.Series:
    """NFKC: Spark has no built-in for it. Only texts beyond ASCII need it."""
    return values.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def casefold(values: pd.Series) -> pd.Series:
    return values.map(lambda x: x if x is None else x.casefold())


def single_spaced(value: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(value, r"(?U)\s+", " "), "^ | $", "")


def normalize(value: Column) -> Column:
    return single_spaced(compatible(value))


def word_key(value: Column, folded: Column | None = None) -> Column:
    """Lower case, runs of other than word characters as one space. For texts that NFKC and case folding
    don't change beyond lower case, all of it runs in the JVM."""
    base = F.lower(value) if folded is None else folded
    return F.trim(F.regexp_replace(base, r"(?U)[^\w]+", " "))


def normalized_key(value: Column) -> Column:
    return word_key(value, casefold(normalize(value)))


def canonical_fingerprint(*columns: str) -> Column:
    """Digest of the named columns as JSON with sorted keys and nulls kept."""
    ordered = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.sha2(ordered, 256)


def five_year_bucket(value: Column) -> Column:
    text = F.trim(value.cast("string"))
    year = F.regexp_extract(text, YEAR, 0)
    start = (year.cast("int") - year.cast("int") % 5).cast("string")
    end = (year.cast("int") - year.cast("int") % 5 + 4).cast("string")
    return (
        F.when(value.isNull() | (value.cast("string") == ""), F.lit(None))
        .when(F.lower(text).isin("present", "current", "ongoing"), F.lit("present"))
        .when(year != "", F.concat(start, F.lit("-"), end))
    )


def csv_safe(value: Column) -> Column:
    return F.when(value.rlike("^[=+@-]"), F.concat(F.lit("'"), value)).otherwise(value)


def confidence(value: Column) -> Column:
    """A number from 0 to 1, else null."""
    number = value.try_cast("double")
    return F.when(number.between(0.0, 1.0), number)


def rounded_confidence(value: Column) -> Column:
    return F.round(confidence(value), 3)


def text_status(value: Column, may_not_apply: bool = False) -> Column:
    allowed = STATUSES if may_not_apply else STATUSES[:-1]
    return F.when(value.isin(allowed), value).otherwise("model_failed")


def compact_text(value: Column) -> Column:
    return F.regexp_replace(F.lower(value), "[^a-z0-9]", "")


def identity_value(kind: Column, value: Column) -> Column:
    """The form in which identifiers are compared, by type."""
    flat = single_spaced(value)
    lower = F.lower(flat)
    site = F.regexp_replace(F.regexp_replace(F.regexp_replace(lower, "^https?://", ""), r"[/.,;:]+$", ""), r"^www\.", "")
    name = F.regexp_replace(F.regexp_replace(flat, HONORIFICS, " "), r"(?U)[^\w\s'-]", " ")
    return (
        F.when(kind == "email", F.regexp_replace(lower, r"[.,;:]+$", ""))
        .when(kind == "phone_number", F.regexp_replace(flat, r"(?U)\D", ""))
        .when(kind == "website", site)
        .when(kind == "unique_identifier", F.upper(F.regexp_replace(flat, r"(?i)^https?://orcid\.org/", "")))
        .when(kind == "person_name", F.lower(single_spaced(name)))
        .otherwise(lower)
    )


def name_parts(name: Column) -> Column:
    """struct(surname, initial) of a name in comparable form."""
    tokens = F.filter(F.split(F.regexp_replace(name, ",", " "), " "), lambda t: t != "")
    some = F.size(tokens) > 0
    return F.struct(
        F.when(some, F.element_at(tokens, -1)).otherwise("").alias("surname"),
        F.when(some, F.substring(F.element_at(tokens, 1), 1, 1)).otherwise("").alias("initial"),
    )


def is_full_name(name: Column) -> Column:
    return F.size(F.filter(F.split(name, " "), lambda t: F.length(t) >= 2)) >= 2


def is_personal_url(site: Column) -> Column:
    return F.contains(site, F.lit("/")) & (F.length(F.regexp_replace(F.regexp_replace(site, "^[^/]*/", ""), "^/+|/+$", "")) >= 2)


def failure_code(value: Column) -> Column:
    return F.when(value.rlike("^[A-Za-z0-9_-]+$"), value).otherwise("unclassified_failure")


def is_safe_path(value: Column) -> Column:
    return (value != "") & ~value.rlike(r"^/|(^|/)\.\.(/|$)")


def is_cv_name(stem: Column, loose: bool = False) -> Column:
    return stem.rlike(CV_NAME_LOOSE if loose else CV_NAME)


def is_pdf(path: Column) -> Column:
    return path.rlike(r"(?i)\.pdf$")


def native_text_reliable(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", "")) >= 40


# What a page's own text needs to be used as it is.
LEAST_ALNUM, LEAST_PRINTABLE, MOST_REPLACED, MOST_IMAGE = 40, 0.85, 0.05, 0.65


def alphanumeric(text: Column) -> Column:
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def native_quality(text: Column, rotation: Column, image_share: Column) -> Column:
    """Names of what speaks against a page's own text, in order."""
    n, letters = F.length(text), alphanumeric(text)
    printable = n - F.length(F.regexp_replace(text, r"[^\p{C}\p{Z}]|[ \n\t]", ""))
    replaced = n - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))
    flags = {
        "encoding_replacement_characters": replaced > MOST_REPLACED * n,
        "image_dominant_page": (image_share > MOST_IMAGE) & (letters < 4 * LEAST_ALNUM),
        "insufficient_native_text": letters < LEAST_ALNUM,
        "low_printable_ratio": printable < LEAST_PRINTABLE * n,
        "rotated_page": F.abs(rotation) % 180 != 0,
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))


def visually_blank(text: Column, images: Column, drawings: Column) -> Column:
    return ~text.rlike(r"\S") & (images == 0) & (drawings == 0)


def model_json(response: Column, schema: str) -> Column:
    """The object in a model's answer: fences are dropped, and what precedes its first brace."""
    bare = F.regexp_replace(response, r"(?s)^\s*```(?:json)?\s*|\s*```\s*$", "")
    return F.from_json(F.regexp_extract(bare, r"(?s)\{.*\}", 0), schema)


def controlled(value: Column, kind: str) -> Column:
    """struct(value, valid): null where a value is outside the vocabulary."""
    key = F.replace(word_key(value), F.lit(" "), F.lit("_"))
    valid = value.isNull() | key.isin(CONTROLLED[kind].split())
    return F.struct(F.when(valid, value).alias("value"), valid.alias("valid"))


def public_field(value: Column, status: Column, number: Column, flags: Column, kind: str | None = None) -> Column:
    """The published form of a field; a value outside its vocabulary is suppressed and flagged."""
    if kind is None:
        shown, valid = value, F.lit(True)
    else:
        shown, valid = controlled(value, kind)["value"], controlled(value, kind)["valid"]
    flagged = F.array_sort(F.array_union(flags, F.array(F.lit("invalid_controlled_value_suppressed"))))
    return F.struct(
        shown.alias("value"), F.when(valid, status).otherwise("uncertain").alias("status"),
        number.alias("model_confidence"), F.when(valid, flags).otherwise(flagged).alias("validation_flags"),
    )


def percentile_linear(column: str, p: float) -> Column:
    """Interpolated between the two nearest ranks."""
    return F.percentile(F.col(column), F.lit(p))


def percentile_rank_index(sorted_values: Column, p: float) -> Column:
    """The value at 0-based rank int((n - 1) p + 0.999) of an ascending array."""
    place = F.floor((F.size(sorted_values) - 1) * F.lit(p) + F.lit(0.999)).cast("int") + 1
    return F.when(F.size(sorted_values) > 0, F.element_at(sorted_values, F.least(place, F.size(sorted_values))))


PLACEHOLDER_OF = {
    "postal_address": "[[ADDRESS]]", "website": "[[URL]]", "signature": "[[SIGNATURE]]",
    "unique_identifier": "[[IDENTIFIER]]", "date": "[[DATE]]",
}


def placeholder(kind: Column, role: Column, entity: Column, local: Column) -> Column:
    """What replaces a mention in released text."""

    def tagged(label: str | Column, id_: Column) -> Column:
        label = F.lit(label) if isinstance(label, str) else label
        return F.concat(F.lit("[["), label, F.lit(":"), id_, F.lit("]]"))

    id_ = F.coalesce(entity, local, F.lit("None"))
    person = F.when(role.isin("applicant", "recommender"), F.upper(role)).otherwise("PERSON")
    known = F.coalesce(entity.startswith("person_"), F.lit(False))
    out = (
        F.when(kind == "person_name", tagged(person, id_))
        .when(kind == "organization", tagged("ORG", id_))
        .when(kind == "work_title", tagged("WORK", id_))
        .when(kind == "email", F.when(known, tagged("EMAIL", entity)).otherwise("[[EMAIL]]"))
        .when(kind == "phone_number", F.when(known, tagged("PHONE", entity)).otherwise("[[PHONE]]"))
    )
    for name, text in PLACEHOLDER_OF.items():
        out = out.when(kind == name, text)
    return out.otherwise("[[REDACTED]]")
