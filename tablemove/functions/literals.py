"""Looking at SQL text without its quoted parts.

A text is cut into quoted pieces (string literals, back-quoted identifiers,
comments) and the pieces between them, so that a pattern can be applied to SQL
only, or to a masked text in which every quoted piece is ``'<index>'``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_STRING = r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_DOUBLE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_BACKQUOTED = r"`[^`]*+`"
_LINE_COMMENT = r"--[^\n]*+"
_BLOCK_COMMENT = r"/\*.*?\*/"


def _pieces(text: Column, quoted: list[str], plain: str) -> Column:
    """Split so that concatenating the pieces gives the text back."""
    pattern = f"(?s)({'|'.join(quoted)}|{plain}|.)"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def sql_pieces(text: Column) -> Column:
    """Pieces of a query text; literals and comments are whole pieces."""
    plain = rf"(?:[^'\"/`-]++|{_BACKQUOTED})++"
    return _pieces(text, [_STRING, _DOUBLE, _LINE_COMMENT, _BLOCK_COMMENT], plain)


def is_opaque(piece: Column) -> Column:
    """True for a literal or comment piece."""
    return (
        F.startswith(piece, F.lit("'"))
        | F.startswith(piece, F.lit('"'))
        | F.startswith(piece, F.lit("--"))
        | F.startswith(piece, F.lit("/*"))
    )


def ddl_pieces(text: Column) -> Column:
    """Pieces of a DDL text; literals and back-quoted names are whole pieces."""
    return _pieces(text, [_STRING, _BACKQUOTED], "[^'`]++")


def mask(pieces: Column) -> Column:
    """Join pieces, each quoted one replaced by ``'<index>'``."""
    return F.array_join(
        F.transform(
            pieces,
            lambda piece, index: F.when(
                piece.rlike("^['`]"), F.concat(F.lit("'"), index.cast("string"), F.lit("'"))
            ).otherwise(piece),
        ),
        "",
    )


def unmask(masked: Column, pieces: Column) -> Column:
    """Put the quoted pieces back into any part of a masked text."""
    tokens = F.regexp_extract_all(masked, F.lit(r"(?s)('\d+'|[^']++|')"), F.lit(1))
    return F.array_join(
        F.transform(
            tokens,
            lambda token: F.when(
                token.rlike(r"^'\d+'$"),
                F.get(pieces, F.regexp_extract(token, r"\d+", 0).try_cast("int")),
            ).otherwise(token),
        ),
        "",
    )


def unquote(quoted: Column) -> Column:
    """Value of a quoted string literal."""
    body = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
    return F.regexp_replace(body, r"\\(.)", "$1")
