"""Verbatim slices of page text between two anchors, as Column builders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from entrygraph.functions.text import FOOTER_LINE, HYPHEN_BREAK, squeezed


def reflow(text: Column) -> Column:
    """Without footer numbers, with broken words joined, on one line."""
    return squeezed(F.regexp_replace(F.regexp_replace(text, FOOTER_LINE, ""), HYPHEN_BREAK, ""))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Each run of white space of a page becomes one character, so that places in it are places in the text with blanks for
# runs. Six characters, which no text holds, tell runs with line breaks apart by what reflowing looks at: whether a break
# comes at once, whether only blanks and tabs come before the first, and whether only these come after the last.
MARKS = {
    "\ufdd0": (r"(?U)(?<!\s)\n(?:\s*\n)?[ \t]*(?!\s)", "\n"),
    "\ufdd1": (r"(?U)(?<!\s)\n\s*(?!\s)", "\n\r"),
    "\ufdd2": (r"(?U)(?<!\s)[ \t]+\n(?:\s*\n)?[ \t]*(?!\s)", " \n"),
    "\ufdd3": (r"(?U)(?<!\s)[ \t]+\n\s*(?!\s)", " \n\r"),
    "\ufdd4": (r"(?U)(?<!\s)\s*\n[ \t]*(?!\s)", "\r\n"),
    "\ufdd5": (r"(?U)(?<!\s)\s*\n\s*(?!\s)", "\r\n\r"),
}
_ALL = "".join(MARKS)


def marked(page: Column) -> Column:
    """The page with one character for each run of white space."""
    (simple, (pattern, _)), *others = MARKS.items()

    def rest(text: Column) -> Column:
        for mark, (p, _) in others:
            text = F.regexp_replace(text, p, mark)
        return text

    # most breaks are of the first kind; the other patterns are for pages that have breaks left
    broken = _with(F.regexp_replace(page, pattern, simple), lambda t: F.when(F.contains(t, F.lit("\n")), rest(t)).otherwise(t))
    return F.regexp_replace(broken, r"(?U) \s+|[\s&&[^ ]]\s*", " ")


def flat(marked_page: Column) -> Column:
    """Blanks for the marks: the text in which anchors are looked up; places stay as they are."""
    return F.translate(marked_page, _ALL, " " * len(_ALL))


def unmarked(cut: Column) -> Column:
    """Runs of white space again, such that reflowing does with them what it would do with the page's own."""
    for mark, (_, run) in MARKS.items():
        cut = F.replace(cut, F.lit(mark), F.lit(run))
    return cut


def _blank(quote: Column) -> Column:
    return F.coalesce(squeezed(quote), F.lit("")) == ""


def _times(page: Column, quote: Column) -> Column:
    """How often the quote occurs, apart from overlaps."""
    n = F.length(quote)
    return F.when(n > 0, F.floor((F.length(page) - F.length(F.replace(page, quote, F.lit("")))) / n))


def _cut(page: Column, after: Column, start: Column, end: Column) -> Column:
    """The slice in one page (marked), or over the break into the next; null unless the start (squeezed) occurs just once."""
    over = lambda at: _with(F.position(end, flat(after)), lambda to: F.when(to > 0, F.concat(F.substring(page, at, F.length(page)), F.lit("\n"), F.substring(after, F.lit(1), to + F.length(end) - 1))))
    inside = lambda at, last: F.when(last > 0, F.substring(page, at, last + F.length(end) - at)).when(after != "", over(at))
    found = lambda here, at: F.when(at > 0, _with(F.position(end, here, at + F.length(start)), lambda last: inside(at, last)))
    return _with(flat(page), lambda here: F.when(_times(here, start) == 1, reflow(unmarked(_with(F.position(start, here), lambda at: found(here, at))))))


def slice_description(page: Column, after: Column, start: Column, end: Column, flow: Column | None = None, after_flow: Column | None = None, mark: bool = True) -> Column:
    """The text between the anchors, tried on the page as it is, then reflowed (``flow``, if known already).

    Anchors are looked up as plain text; ``mark`` says that the pages are not marked yet.
    """
    first, last = squeezed(start), squeezed(end)
    raw = _cut(*(marked(p) if mark else p for p in (page, after)), first, last)
    flowed = _cut(reflow(page) if flow is None else flow, reflow(after) if after_flow is None else after_flow, first, last)
    return F.when(~_blank(start) & ~_blank(end), F.coalesce(raw, flowed))


def unsliced_reason(page: Column, start: Column, end: Column, flow: Column | None = None, mark: bool = True) -> Column:
    """Why there is no slice: the first text in which the start occurs decides."""
    quote = squeezed(start)
    raw, flowed = _times(flat(marked(page) if mark else page), quote), _times(reflow(page) if flow is None else flow, quote)
    hits = _with(raw, lambda n: F.when(n > 0, n).otherwise(flowed))
    counted = _with(hits, lambda n: F.when(n == 0, "start_not_found").when(n > 1, "start_ambiguous").otherwise("end_mismatch"))
    return F.when(_blank(start) | _blank(end), "empty_anchor").when(quote == squeezed(end), "stub").otherwise(counted)


def description(page: Column, after: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """(description, its source, the reason there is none)."""
    cut = slice_description(page, after, start, end)
    return described(cut, F.when(cut.isNull(), unsliced_reason(page, start, end)), start)


def described(cut: Column, reason: Column, start: Column) -> tuple[Column, Column, Column]:
    """The same from a slice and a reason that are columns already."""
    text = F.coalesce(cut, F.when(reason == "stub", start))
    source = F.when(cut.isNotNull(), "sliced").when(reason == "stub", "stub").otherwise("none")
    return text, source, reason
