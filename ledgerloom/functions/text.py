"""Text cleaning and label canonicalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import specs

# Every character a Unicode-aware strip removes.
WHITE_SPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(
    chr(code) for code in range(0x2000, 0x200B)
)
WORD_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def text_clean(c: Column) -> Column:
    """Trim spaces (and only spaces); an empty result becomes NULL."""
    return F.nullif(F.trim(c.cast("string")), F.lit(""))


def strip_all(c: Column) -> Column:
    """Trim every kind of white space, as batch validation does; NULL becomes empty."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit(WHITE_SPACE))


def normalise_operation(c: Column) -> Column:
    return F.upper(strip_all(c))


def normalize_token(c: Column) -> Column:
    """Lower-case, and fold each run of other characters to one underscore."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_")


def canonical(token: Column, labels: dict[str, str], default: str = specs.UNKNOWN) -> Column:
    """Look a token up in a label map; unknown or NULL tokens take the default."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[token], F.lit(default))


def canonical_text(c: Column, labels: dict[str, str], default: str = specs.UNKNOWN) -> Column:
    return canonical(normalize_token(c), labels, default)


def age_band(c: Column) -> Column:
    return canonical(F.regexp_replace(F.lower(c), "[^a-z0-9+]+", ""), specs.AGE_MAP)


def order_status(c: Column) -> Column:
    return canonical_text(c, specs.STATUS_MAP, specs.UNKNOWN_STATUS)


def name_case(c: Column) -> Column:
    """Capitalise every run of letters and digits, not only those after a space."""
    runs = F.regexp_extract_all(F.lower(c), F.lit(WORD_RUNS), F.lit(1))
    return F.array_join(
        F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), ""
    )


def invalid_phone(c: Column) -> Column:
    """Present, and either negative or without any digit."""
    no_digit = F.regexp_replace(c, "[^0-9]", "") == ""
    return c.isNotNull() & (c.startswith("-") | no_digit)


def row_signature(*texts: Column) -> Column:
    return F.md5(F.concat_ws("|", *texts))
