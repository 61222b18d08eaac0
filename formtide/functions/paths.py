"""Functions on object keys, paths, URLs and file listings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formtide.functions.columns import as_column
from formtide.functions.fixed_values import FOLDER_MIME, ROUTE_ORDER
from formtide.functions.text import strip_blanks



def text_after_prefix(value: Column | str, prefix: str) -> Column:
    """Text between the first and second occurrence of a prefix, null when absent."""
    text = as_column(value)
    return F.when(F.contains(text, F.lit(prefix)), F.split_part(text, F.lit(prefix), F.lit(2)))


def base_name(path: Column | str) -> Column:
    """Last path segment (C14)."""
    return F.substring_index(as_column(path), "/", -1)


def strip_extension(path: Column | str, suffix: str | None = None) -> Column:
    """Path without its extension, or without a known suffix (C14).

    A name that starts with its only dot has no extension.
    """
    text = as_column(path)
    if suffix is not None:
        head = F.left(text, F.length(text) - F.lit(len(suffix)))
        return F.when(F.endswith(text, F.lit(suffix)), head).otherwise(text)
    return F.regexp_replace(text, r"([^/.][^/]*)\.[^./]*$", "$1")


def path_segment(path: Column | str, position: int) -> Column:
    """Path segment counted from the end with -1, -2, …; null when there is none."""
    text = as_column(path)
    if position == -1:
        return base_name(text)
    return F.try_element_at(F.split(text, "/"), F.lit(position))


def file_id_of_reference(reference: Column | str) -> Column:
    """File id in a photo reference: last segment without backslashes."""
    return F.replace(base_name(reference), F.lit("\\"), F.lit(""))


def public_url(bucket: str, key: Column | str) -> Column:
    """Public address of an object."""
    return F.concat(F.lit(f"https://{bucket}.s3.amazonaws.com/"), as_column(key))


def entry_kind(mime_type: Column | str) -> Column:
    """``folder`` for the folder mime type, else ``file`` (C20)."""
    return F.when(as_column(mime_type) == FOLDER_MIME, "folder").otherwise("file")


def layer_path(prefix: str, name: str, extension: str) -> str:
    """Location of one form's table in a layer: ``prefix/name/name.extension``."""
    return f"{prefix.rstrip('/')}/{name}/{name}.{extension}"


def route_name(name: str) -> str | None:
    """Form a file name belongs to; None when no form matches."""
    plain = name.lower().strip()
    return next((form for form in ROUTE_ORDER if form in plain), None)


def route_column(name: Column | str) -> Column:
    """:func:`route_name` for a column of names."""
    plain = strip_blanks(F.lower(as_column(name)))
    hits = [F.when(F.contains(plain, F.lit(form)), form) for form in ROUTE_ORDER]
    return F.coalesce(*hits)
