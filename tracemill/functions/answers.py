"""Finding, normalizing and comparing boxed answers.

Every function maps columns to a column of built-in expressions, so a plan that
uses them stays inside whole-stage code generation.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracemill.functions.text import collapse, strip, strip_end, strip_long

# The answer marker, a closed box without inner braces, a closed
# box at the end of the text, and the LaTeX escape for a blank.
BOX_OPEN = r"\boxed{"
BOX_PATTERN = r"\\boxed\{([^{}]+)\}"
BOX_AT_END_PATTERN = r"(?U)\\boxed\{[^{}]+\}[\s\x1C-\x1F]*\z"
LATEX_BLANK = "\\ "

# Characters dropped in front of a box that is cut off.
CUT_TRAILERS = " .。．"

PROFILES = ("collapse", "latex_space", "latex_strict")

# The relative part of the closeness test that applies at any tolerance.
RELATIVE_TOLERANCE = 1e-9

_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
NUMBER_PATTERN = (
    rf"\A[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    r"|(?i:inf|infinity))\z"
)

# Decimal digits of other scripts, by rule, each paired with its ASCII digit.
_OTHER_DIGITS = [
    (chr(code), str(unicodedata.decimal(chr(code))))
    for code in range(128, sys.maxunicode + 1)
    if unicodedata.category(chr(code)) == "Nd"
]
_OTHER = "".join(char for char, _ in _OTHER_DIGITS)
_ASCII = "".join(digit for _, digit in _OTHER_DIGITS)


def has_box(text: Column) -> Column:
    """Whether the marker occurs, closed or not."""
    return text.contains(F.lit(BOX_OPEN))


def ends_in_box(text: Column) -> Column:
    """Whether the text ends in a closed box (whitespace may follow)."""
    # The cheap test spares the regex on texts without any marker.
    return has_box(text) & text.rlike(BOX_AT_END_PATTERN)


def has_latex_blank(text: Column) -> Column:
    return text.contains(F.lit(LATEX_BLANK))


def _last_box_content(text: Column) -> Column:
    boxes = F.regexp_extract_all(text, F.lit(BOX_PATTERN), F.lit(1))
    return F.try_element_at(boxes, F.lit(-1))


def last_boxed(text: Column, profile: str | None = None) -> Column:
    """Content of the last closed box, stripped, or null if there is none.

    With ``profile`` the content is normalized instead of only stripped.
    """
    content = _last_box_content(text)
    return strip(content) if profile is None else normalize(content, profile)


def normalize(text: Column, profile: str = "collapse") -> Column:
    """Bring an answer to comparable form.

    ``collapse`` only unifies whitespace, ``latex_space`` also reads ``\\ `` as a
    blank, ``latex_strict`` then drops every other backslash. Whitespace goes
    first: a trailing ``\\ `` has lost its blank when the escape is looked for.
    """
    if profile == "collapse":
        return collapse(text)
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}, expected one of {PROFILES}")
    unescaped = F.replace(strip(text), F.lit(LATEX_BLANK), F.lit(" "))
    if profile == "latex_strict":
        unescaped = F.replace(unescaped, F.lit("\\"), F.lit(""))
    return collapse(unescaped)


def to_number(text: Column) -> Column:
    """Read a number the way Python's ``float`` does after dropping commas.

    Null where the text is no number. ``nan`` also gives null: it is close to
    nothing, not even to itself.
    """
    bare = strip(F.replace(text, F.lit(","), F.lit("")))
    ascii_digits = F.translate(F.replace(bare, F.lit("_"), F.lit("")), _OTHER, _ASCII)
    return F.when(bare.rlike(NUMBER_PATTERN), ascii_digits.try_cast("double"))


def check_tolerance(tolerance: float | None) -> None:
    if tolerance is not None and not tolerance >= 0:
        raise ValueError(f"tolerance must not be negative: {tolerance}")


def is_close(left: Column, right: Column, tolerance: float) -> Column:
    """Numbers within ``tolerance``, or within 1e-9 relative; false on null."""
    check_tolerance(tolerance)
    infinite = F.lit(float("inf"))
    finite = (F.abs(left) < infinite) & (F.abs(right) < infinite)
    relative = F.lit(RELATIVE_TOLERANCE) * F.greatest(F.abs(left), F.abs(right))
    near = F.abs(left - right) <= F.greatest(relative, F.lit(float(tolerance)))
    return F.coalesce((left == right) | (finite & near), F.lit(False))


def same_answer(expected: Column, predicted: Column, profile: str = "latex_strict") -> Column:
    """Equal after normalizing; a missing answer equals nothing."""
    return F.coalesce(
        normalize(expected, profile) == normalize(predicted, profile), F.lit(False)
    )


def answers_match(expected: Column, predicted: Column, tolerance: float | None = None) -> Column:
    """Equal up to whitespace or, given a tolerance, numerically close."""
    check_tolerance(tolerance)
    exact = same_answer(expected, predicted, "collapse")
    if tolerance is None:
        return exact
    left, right = to_number(collapse(expected)), to_number(collapse(predicted))
    return exact | is_close(left, right, tolerance)


def predicted_answer(prediction: Column) -> Column:
    """The last boxed answer if there is one, else the stripped text."""
    return F.coalesce(last_boxed(prediction), strip_long(prediction))


def cut_last_box(reasoning: Column) -> Column:
    """Drop everything from the last marker on, closed or not, and tidy the end.

    Earlier boxes stay. The cut position comes from the length of what follows the
    last marker, in bytes: no regex runs, and no character is counted. The two
    cases are concatenated, one of them empty, because what stands in a branch is
    computed again for every use.
    """
    text = F.replace(strip_long(reasoning), F.lit(LATEX_BLANK), F.lit(" "))
    behind = F.substring_index(text, BOX_OPEN, -1)
    size, rest = F.octet_length(text), F.octet_length(behind)
    before = F.left(text.cast("binary"), size - rest - F.lit(len(BOX_OPEN))).cast("string")
    unmarked = F.when(rest == size, text).otherwise(F.lit(""))
    return strip_long(F.concat(strip_end(before, CUT_TRAILERS), unmarked))
