"""String expressions, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.constants import (
    CONTENT_TYPES,
    DEFAULT_CONTENT_TYPE,
    NAME_AFTER_BRACKET,
    NAME_AT_START,
    SPACE_CLASS,
    TITLE_LENGTH,
    WHITE_SPACE,
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim Unicode white space on both ends, as Python's strip() does."""
    return F.btrim(col(c), F.lit(WHITE_SPACE))


def blank_to_null(c: Column | str) -> Column:
    """Empty and all-space strings count as missing."""
    c = col(c)
    return F.when(strip(c) != "", c)


def name_from_title(title: Column | str) -> Column:
    """Creator name guessed from a title, in three tiers; null when none applies.

    After a closing bracket up to a dash or a Latin letter; else the leading run up to a dash or
    an alphanumeric; else the first word. Names have at least two characters.
    """
    t = strip(title)
    after_bracket = strip(F.regexp_extract(t, NAME_AFTER_BRACKET, 1))
    leading = strip(F.regexp_extract(t, NAME_AT_START, 1))
    first_word = F.regexp_extract(t, f"^[^{SPACE_CLASS}]+", 0)
    return F.coalesce(
        F.when(F.length(after_bracket) > 1, after_bracket),
        F.when(F.length(leading) > 1, leading),
        F.when(F.length(first_word) >= 2, first_word),
    )


def clean_url(url: Column | str) -> Column:
    return F.substring_index(col(url), "?", 1)


def url_extension(url: Column | str) -> Column:
    u = F.lower(col(url))
    return (
        F.when(F.contains(u, F.lit(".png")), ".png").when(F.contains(u, F.lit(".webp")), ".webp").otherwise(".jpg")
    )


def item_file_name(position: Column | str, extension: Column | str) -> Column:
    """Three-digit zero padding that grows past 999."""
    return F.format_string("%03d%s", col(position), col(extension))


def folder_name(collection_id: Column | str, title: Column | str) -> Column:
    short = F.replace(F.substring(col(title), 1, TITLE_LENGTH), F.lit("/"), F.lit("_"))
    return F.concat_ws("_", col(collection_id).cast("string"), short)


def id_from_folder(name: Column | str) -> Column:
    return F.substring_index(col(name), "_", 1).try_cast("bigint")


def extension_of(path: Column | str) -> Column:
    """Lower-case extension with its dot, empty when there is none; a leading dot is no extension."""
    return F.lower(F.regexp_extract(col(path), r"[^/.][^/]*?(\.[^./]+)$", 1))


def stem_of(file_name: Column | str) -> Column:
    return F.regexp_replace(col(file_name), r"(?<=[^/])\.[^./]+$", "")


def content_type(path: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, extension_of(path)), F.lit(DEFAULT_CONTENT_TYPE))


def relative_path(path: Column | str, root: str) -> Column:
    prefix = root.rstrip("/") + "/"
    c = col(path)
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, F.lit(len(prefix) + 1), F.length(c))).otherwise(c)


def percent_decode(c: Column | str) -> Column:
    """Percent decoding that leaves a plus sign alone; null when malformed."""
    return F.try_url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B")))


def numeric_stem(stem: Column | str) -> Column:
    """Stem as an integer when it is written as one, else null."""
    s = strip(stem)
    return F.when(s.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(s, F.lit("_"), F.lit("")).try_cast("decimal(38,0)"))


def natural_order(stem: Column | str) -> list[Column]:
    """Sort keys: numeric stems first by value, then the others by text."""
    n = numeric_stem(stem)
    return [n.isNull(), n, col(stem)]
