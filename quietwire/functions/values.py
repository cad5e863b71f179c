"""Cleaning of single values from landed records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quietwire.functions.text import strip

_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\z"


def filled(value: Column) -> Column:
    """The value, or null when it is empty."""
    return F.nullif(value, F.lit(""))


def normalise_symbol(raw: Column) -> Column:
    """BBCA, bbca and BBCA.JK are one symbol: BBCA."""
    return F.regexp_replace(F.upper(strip(filled(raw))), r"\.JK\z", "")


def number(raw: Column) -> Column:
    """A double, or null for anything that is not a finite decimal number."""
    return stripped_number(strip(raw))


def stripped_number(text: Column) -> Column:
    """The same of a text without white space at its ends."""
    return F.when(F.rlike(text, F.lit(_NUMBER)), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def _own_id(record: Column, raw: Column, key: str) -> Column:
    """An id the record brings along. Zero, false and empty values count as none."""
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(raw), f"$.{key}", "variant"))
    text = filled(record[key])
    zero = (kind != "STRING") & (text.try_cast("double") == 0)
    return (
        F.when((kind == "BOOLEAN") & (text == "true"), F.lit("True"))
        .when((kind == "BOOLEAN") | F.coalesce(zero, F.lit(False)), F.lit(None).cast("string"))
        .otherwise(text)
    )


def stable_id(record: Column, raw: Column) -> Column:
    """The record's own id, else a hash of title, source and url. ``record`` maps key to text, ``raw`` is its JSON."""

    def part(key: str) -> Column:
        # A key that is there without a value hashes as the word None, a missing key as nothing.
        return F.when(F.map_contains_key(record, key), F.coalesce(record[key], F.lit("None"))).otherwise("")

    own = [_own_id(record, raw, key) for key in ("id", "article_id", "uuid")]
    return F.coalesce(*own, F.sha1(F.concat_ws("|", part("title"), part("source"), part("url"))))


def signed(value: Column) -> Column:
    return F.format_string("%+.1f", value)


def counted(value: Column) -> Column:
    """Integer with thousands separators."""
    return F.format_number(value, 0)


def percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)
