"""Rewriting the catalog qualifier in view texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablemove.functions.literals import is_opaque, sql_pieces
from tablemove.functions.names import FOLD_SEPARATOR


def _qualifier(catalog: str, folded: bool) -> str:
    """Pattern of ``catalog.`` (or ``catalog__``) at the start of a name.

    The prefix that separates it from longer identifiers and from struct fields
    is looked at, not consumed.
    """
    name = re.escape(catalog)
    if folded:
        return rf"(?<![\w]){name}{FOLD_SEPARATOR}(?=\w)"
    return rf"(?<![\w`.])(`?){name}\1\s*\.(?!\d)"


def rewrite(text: Column, source: str, target: str, folded: bool = False) -> Column:
    """Replace ``source`` by ``target`` where it qualifies a name.

    String literals, comments, longer identifiers and struct fields of the same
    name stay as they are. ``folded`` rewrites names of the form
    ``<catalog>__<schema>`` (catalogs that live inside the session catalog).
    """
    replacement = target + FOLD_SEPARATOR if folded else f"{target}."
    pattern = _qualifier(source, folded)
    pieces = F.transform(
        sql_pieces(text),
        lambda piece: F.when(is_opaque(piece), piece).otherwise(
            F.regexp_replace(piece, pattern, replacement.replace("$", r"\$"))
        ),
    )
    # Most texts never name the catalog; they skip the piecewise work.
    return F.when(F.contains(text, F.lit(source)), F.array_join(pieces, "")).otherwise(text)


def mentions(text: Column, catalog: str, folded: bool = False) -> Column:
    """True when ``catalog`` still qualifies a name in the text."""
    pattern = _qualifier(catalog, folded)
    return F.exists(sql_pieces(text), lambda piece: ~is_opaque(piece) & piece.rlike(pattern))
