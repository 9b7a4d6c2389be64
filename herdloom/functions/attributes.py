"""JSON attribute bags and location forms."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.functions.text import lenient_num

# Attribute ids in the JSON bag of an event (or a farm), and of the location key in forms.
MILK_MORNING = "59"
MILK_MIDDAY = "68"
MILK_EVENING = "61"
MILK_FAT = "63"
MILK_PROTEIN = "64"
MILK_CELL_COUNT = "66"
BODY_WEIGHT = "136"
HEART_GIRTH = "137"
BODY_LENGTH = "138"
BODY_SCORE = "139"
ESTIMATED_WEIGHT = "529"
CATTLE_OWNED = "49"
FORM_SECTION = "farmer_general"
FORM_GPS_SUFFIX = "farmer_gpslocation"


def attributes(c: Column) -> Column:
    """Attribute bag as a map; NULL when the text is not a JSON object."""
    return F.from_json(c, "map<string,string>")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    As a plain column the optimizer would copy its expression into every filter and aggregate made from
    it. The output of ``explode`` over one element is never copied.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def with_attributes(df: DataFrame, name: str = "attrs", bag: str = "additional_attributes") -> DataFrame:
    """Add the parsed attribute bag, parsed once per row however many lookups and filters follow."""
    return _once(df, name, attributes(F.col(bag)))


def with_attr_texts(df: DataFrame, attrs: str, texts: Mapping[str, str], **computed: Column) -> DataFrame:
    """Add texts of attributes (column -> attribute id) and computed columns, each made once per row."""
    columns = {name: attr_text(F.col(attrs), attr_id) for name, attr_id in texts.items()} | computed
    made = _once(df, "_made", F.struct(*[c.alias(name) for name, c in columns.items()]))
    return made.withColumns({name: F.col("_made")[name] for name in columns}).drop("_made")


def attr_text(attrs: Column, attr_id: str) -> Column:
    """Text of one attribute: a JSON null reads as the text ``null``, a missing key as NULL."""
    return F.when(F.map_contains_key(attrs, attr_id), F.coalesce(attrs[attr_id], F.lit("null")))


def _cleaned_number(attrs: Column, attr_id: str) -> Column:
    return lenient_num(F.replace(attr_text(attrs, attr_id), F.lit("null"), F.lit("")))


def milk_total_strict(attrs: Column, digits: int | None = 2) -> Column:
    """Evening + midday + morning milk; NULL as soon as one of the three keys is missing."""
    parts = [_cleaned_number(attrs, a) for a in (MILK_EVENING, MILK_MIDDAY, MILK_MORNING)]
    if digits is not None:
        parts = [F.round(p, digits) for p in parts]
    return parts[0] + parts[1] + parts[2]


def milk_total_lenient(attrs: Column) -> Column:
    """Morning + midday + evening milk; a missing key counts as 0."""
    texts = [attr_text(attrs, a) for a in (MILK_MORNING, MILK_MIDDAY, MILK_EVENING)]
    parts = [F.coalesce(lenient_num(t), F.lit(0.0)) for t in texts]
    return parts[0] + parts[1] + parts[2]


def first_gps(form: Column) -> Column:
    """First location in a form document as struct(latitude, longitude) of texts, NULL without one.

    Sections and keys are searched in document order; a value counts when it has two blank-separated
    parts or more. Documents of another shape, or broken ones, give NULL.
    """
    sections = F.from_json(form, f"struct<{FORM_SECTION}:array<map<string,string>>>")[FORM_SECTION]
    entries = F.flatten(F.transform(F.array_compact(sections), F.map_entries))
    spots = F.filter(
        entries,
        lambda e: F.lower(e["key"]).endswith(FORM_GPS_SUFFIX) & F.contains(e["value"], F.lit(" ")),
    )
    parts = F.split(F.get(spots, F.lit(0))["value"], " ")
    return F.when(
        F.size(spots) > 0,
        F.struct(F.get(parts, F.lit(0)).alias("latitude"), F.get(parts, F.lit(1)).alias("longitude")),
    )
