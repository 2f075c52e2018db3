"""E2 for nested markup: elements cut by the depth of their tag.

The text is split before each opening and closing token of one tag, so every
piece after the first starts with a token. The depth (+1 for an opening, -1 for
a closing token) follows from the numbers of both, and an element reaches to
the first later piece at which the depth is back below its own. Elements of
the same name inside an element are part of it; those of the wanted class are
elements of their own as well. Built-in functions only: a page is one row.

Tags are matched in any case, attributes with double quotes; a self-closing
token opens nothing. An element that is never closed reaches to the end of the
page. Comments and scripts are not told apart from markup.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nested import bound


def pieces(html: Column, tag: str) -> Column:
    """The text before each opening and closing token of a tag; null for null.
    Elements are cut from it, several times if need be."""
    # a blank in front: the first piece then never starts with a token
    return F.split(F.concat(F.lit(" "), html), rf"(?is)(?=<(?:/{tag}\s*>|{tag}(?=[\s>])(?![^>]*/>)))")


def _places(pieces: Column, tag: str, cls: str | None = None) -> Column:
    """At which pieces an element of the tag (and class) opens."""
    wanted = rf'(?is)^<{tag}(\s[^>]*)?>'
    if cls is not None:
        wanted = rf'(?is)^<{tag}\s([^>]*\s)?class="([^"]*\s)?{cls}(\s[^"]*)?"'

    def is_wanted(piece: Column) -> Column:
        test = piece.rlike(wanted)
        plain = cls is not None and re.fullmatch(r"[\w-]+", cls, re.A)
        return F.lower(piece).contains(cls.lower()) & test if plain else test

    return F.filter(F.sequence(F.lit(1), F.size(pieces)), lambda i: is_wanted(F.element_at(pieces, i)))


def _cut(pieces: Column, tag: str, places: Column) -> Column:
    """The markup of the elements that open at ``places``.

    The depth after the j-th closing token, piece c, is c - 1 - 2j, and after a
    token that opens at piece a, with k closing ones before it, a - 1 - 2k; the
    element ends where the former is first one below the latter. So only the
    closing tokens are numbered, and no depth is kept for each piece."""
    closing = F.filter(F.sequence(F.lit(1), F.size(pieces)), lambda i: F.element_at(pieces, i).startswith("</"))

    def cut(c: Column, level: Column, at: Column) -> Column:
        def end(k: Column) -> Column:
            later = F.array_position(F.slice(level, k + 1, F.size(level) - k), at - 1 - 2 * k).cast("int")
            return F.get(c, k - 1 + F.nullif(later, F.lit(0)))

        def text(to: Column) -> Column:
            body = F.array_join(F.slice(pieces, at, F.coalesce(to, F.size(pieces) + 1) - at), "")
            return F.concat(body, F.coalesce(F.regexp_extract(F.get(pieces, to - 1), rf"(?i)^</{tag}\s*>", 0), F.lit("")))

        return bound(bound(F.size(F.filter(c, lambda x: x < at)), end), text)

    def all_of(c: Column) -> Column:
        return bound(F.transform(c, lambda x, j: x - 2 * (j + 1)), lambda level: F.transform(places, lambda at: cut(c, level, at)))

    return bound(closing, all_of)


def elements(html: Column, tag: str, cls: str | None = None) -> Column:
    """The elements of a tag (and class) with their markup, in page order, as
    array<string>. Null for a null text, empty where there is none."""
    return F.when(html.isNotNull(), bound(pieces(html, tag), lambda p: _cut(p, tag, _places(p, tag, cls))))


def count_elements(pieces: Column, tag: str, cls: str | None = None) -> Column:
    """How many ``elements`` a text in ``pieces`` has: none is cut out for it."""
    return F.size(_places(pieces, tag, cls))


def first_element(pieces: Column, tag: str, cls: str | None = None) -> Column:
    """The first of the ``elements`` of a text in ``pieces``; null if there is
    none."""
    return bound(pieces, lambda p: F.get(_cut(p, tag, F.slice(_places(p, tag, cls), 1, 1)), 0))


def text_of(element: Column) -> Column:
    """The text of an element, without the tokens inside it, trimmed."""
    return F.trim(F.regexp_replace(element, r"(?s)<[^>]*>", ""))


def first_text(html: Column, tag: str, cls: str) -> Column:
    """The text of the first element of a class; null if there is none."""
    return text_of(first_element(pieces(html, tag), tag, cls))
