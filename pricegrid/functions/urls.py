"""File names and URL decoding as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Extensions kept on a stored file name.
KNOWN_EXTENSIONS = (
    ".bmp", ".csv", ".css", ".doc", ".docx", ".gif", ".gz", ".htm", ".html",
    ".jpeg", ".jpg", ".js", ".json", ".pdf", ".png", ".ppt", ".pptx", ".svg",
    ".tar", ".txt", ".xls", ".xlsx", ".xml", ".zip",
)


# Extension given back by a MIME type that several share.
PREFERRED_EXTENSIONS = {".htm": ".html", ".jpeg": ".jpg"}


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


# Leading dots belong to the stem.
_STEM_AND_EXT = r"(?s)^(\.*[^.].*?)(\.[^.]*)\z"


def _ext(name: Column) -> Column:
    return F.regexp_extract(name, _STEM_AND_EXT, 2)


def file_stem(path: Column) -> Column:
    """Base name without its extension; also used as the id of a report."""
    return F.regexp_replace(base_name(path), _STEM_AND_EXT, "$1")


def stored_file_name(url: Column) -> Column:
    """Name a downloaded file is stored under.

    The last path segment, kept percent-encoded. An extension that is not known
    as it stands is replaced by the one the URL's path has, looked up in lower
    case; if that fails too the file is stored without one.
    """
    ext = _ext(base_name(url))
    path = F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#;]*)", 1)
    guess = F.lower(_ext(base_name(path)))
    for shared, preferred in PREFERRED_EXTENSIONS.items():
        guess = F.regexp_replace(guess, rf"^\{shared}$", preferred)
    return F.concat(
        file_stem(url),
        F.when(ext.isin(*KNOWN_EXTENSIONS), ext)
        .when(guess.isin(*KNOWN_EXTENSIONS), guess)
        .otherwise(F.lit("")),
    )


def output_name(path: Column, variant: Column | None = None) -> Column:
    """CSV name of a converted report; ``single`` carries no suffix."""
    folder = F.regexp_extract(path, "(?s)^(.*/)", 1)
    stem = F.concat(folder, file_stem(path))
    if variant is None:
        return F.concat(stem, F.lit(".csv"))
    suffix = F.when(variant == "single", F.lit("")).otherwise(F.concat(F.lit("-"), variant))
    return F.concat(stem, suffix, F.lit(".csv"))


def percent_decode(text: Column) -> Column:
    """Decode %XX and nothing else: "+" stays, a bad escape stays."""
    safe = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(text, F.lit("%")), decoded).otherwise(text)


def report_name(url: Column) -> Column:
    """Base name of a URL that may have been encoded twice."""
    return base_name(percent_decode(percent_decode(url)))
