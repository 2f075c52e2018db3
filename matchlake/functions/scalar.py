"""Scalar Column helpers. Everything is a built-in expression, so it stays
inside whole-stage codegen; no Python runs per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# English month names in calendar order.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- labels and casts (X1-X7) ---------------------------------------------
def best_of_label(best_of_type: ColumnOrName) -> Column:
    """X1: 'Best of 3' -> MD3, 'Best of 5' -> MD5, anything else (Bo1, Bo2,
    NULL) -> MD1. Only spaces are trimmed (X5)."""
    bo = F.trim(_c(best_of_type))
    return F.when(bo == "Best of 3", "MD3").when(bo == "Best of 5", "MD5").otherwise("MD1")


def strict_int(s: ColumnOrName) -> Column:
    """Text to integer; bad text fails the query, whether or not the
    session casts by ANSI rules. Blanks around digits are accepted."""
    got = _c(s).try_cast("int")
    bad = F.raise_error(F.concat(F.lit("not an integer: "), _c(s))).cast("int")
    return F.when(got.isNotNull() | _c(s).isNull(), got).otherwise(bad)


def lenient_int(s: ColumnOrName) -> Column:
    """X4, quality-check variant: bad text gives NULL instead of an error."""
    return _c(s).try_cast("int")


def series_score(
    best_of_type: ColumnOrName, own: ColumnOrName, other: ColumnOrName, strict: bool = True
) -> Column:
    """A Bo1 score is a round score, turned into win 1 / 0 (equal or NULL
    scores give 0); other formats keep the number of maps won."""
    bo = F.trim(_c(best_of_type))
    to_int = strict_int if strict else lenient_int
    mine, theirs = to_int(own), to_int(other)
    return F.when(bo == "Best of 1", F.when(mine > theirs, 1).otherwise(0)).otherwise(mine)


# Position of a played map in its series, by format (None: any
# other) and choice number.
MAP_CHOICES = {
    "Best of 1": {"3": "Map 1", "4": "Map 2", "5": "Map 1", "6": "Map 2", "7": "Map 1"},
    "Best of 3": {"3": "Map 1", "4": "Map 2", "7": "Map 3"},
    "Best of 5": {"3": "Map 1", "4": "Map 2", "5": "Map 3", "6": "Map 4", "7": "Map 5"},
    None: {"3": "Map 1", "4": "Map 2"},
}


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def map_choice(best_of_type: ColumnOrName, choice_number: ColumnOrName) -> Column:
    """Position of a played map in the series, from the table above;
    NULL outside it. choice_number compares as text."""
    bo = F.coalesce(F.trim(_c(best_of_type)), F.lit(""))
    known = {k: v for k, v in MAP_CHOICES.items() if k is not None}
    table = F.when(~bo.isin(*known), _literal_map(MAP_CHOICES[None]))
    for label, choices in known.items():
        table = table.when(bo == label, _literal_map(choices))
    return F.try_element_at(table, _c(choice_number))


def or_left(team_id: ColumnOrName) -> Column:
    """A veto without a team is the left-over map."""
    return F.coalesce(_c(team_id), F.lit("Left"))


# ---- dates (X8, X10, X11, X16) ---------------------------------------------
def day_before(iso_day: ColumnOrName) -> Column:
    """ISO date text (or date) minus one day, as yyyy-MM-dd text."""
    return F.date_format(F.date_sub(F.to_date(_c(iso_day)), 1), "yyyy-MM-dd")


def month_number(month_name: ColumnOrName) -> Column:
    """X11: English month name to two-digit text; unknown names give NULL."""
    numbers = {name: f"{i:02d}" for i, name in enumerate(MONTHS, start=1)}
    return F.try_element_at(_literal_map(numbers), _c(month_name))


def ordinal_suffix(day: ColumnOrName) -> Column:
    """English ordinal suffix of a day number (1st, 2nd, 3rd, 4th, 11th ...)."""
    d = _c(day)
    teen = (d % 100 >= 11) & (d % 100 <= 13)
    return (
        F.when(teen, "th")
        .when(d % 10 == 1, "st")
        .when(d % 10 == 2, "nd")
        .when(d % 10 == 3, "rd")
        .otherwise("th")
    )


def headline_of(day: ColumnOrName) -> Column:
    """Render a date as a results headline: 'Results for February 25th 2022'."""
    d = F.to_date(_c(day))
    dom = F.dayofmonth(d)
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month(d))
    return F.concat(
        F.lit("Results for "), month, F.lit(" "), dom.cast("string"), ordinal_suffix(dom),
        F.lit(" "), F.year(d).cast("string"),
    )


def headline_date(headline: ColumnOrName) -> Column:
    """X10: '... <Month> <day><st|nd|rd|th> <year>' to a date. Tokens are
    taken from the end, the month goes through X11 (unknown month -> NULL)."""
    tok = F.split(_c(headline), " ")
    # try_element_at: a short or malformed headline gives NULL, not an error
    day = F.regexp_replace(F.try_element_at(tok, F.lit(-2)), "(st|nd|rd|th)$", "")
    month = month_number(F.try_element_at(tok, F.lit(-3)))
    year = F.try_element_at(tok, F.lit(-1))
    return F.try_to_date(F.concat_ws("-", year, month, F.lpad(day, 2, "0")), "yyyy-MM-dd")


# ---- text (X9, X12-X15, X18) -------------------------------------------------
def path_part(s: ColumnOrName, index: int, sep: str = "/") -> Column:
    """0-based (negative: from the end) token of a split, '' when out of
    range."""
    part = index + 1 if index >= 0 else index
    return F.split_part(_c(s), F.lit(sep), F.lit(part))


def strip_chars(s: ColumnOrName, *subs: str) -> Column:
    """Remove every occurrence of each substring."""
    c = _c(s)
    for x in subs:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def token_count(s: ColumnOrName, sep: str = " ") -> Column:
    """Number of tokens of a literal split (empty tokens count)."""
    return F.size(F.split(_c(s), _regex_literal(sep)))


def _regex_literal(sep: str) -> str:
    import re

    return re.escape(sep)


def format_parts(format_line: ColumnOrName) -> tuple[Column, Column]:
    """X15: 'Best of 3 (LAN)' -> ('Best of 3 ', 'LAN'); text from '*' on is
    dropped first, then newlines."""
    head = strip_chars(F.split_part(_c(format_line), F.lit("*"), F.lit(1)), "\n")
    best_of = F.split_part(head, F.lit("("), F.lit(1))
    kind = strip_chars(F.split_part(head, F.lit("("), F.lit(2)), ")")
    return best_of, kind


def lines_of(text: ColumnOrName) -> Column:
    """Text to an array of lines."""
    return F.split(_c(text), "\n")
