"""Text cleaning as Column expressions.

Everything here stays inside whole-stage code generation. Plain ``replace`` and
``btrim`` are used wherever the rule is a fixed string; the few regular
expressions run only on the rows that hold a character they look for.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as white space. Vertical tab is not one.
WHITESPACE = " \t\n\r\f"
# What line breaks inside a cell turn into.
PARAGRAPH_TOKEN = "#PARA_START#"
RETURN_TOKEN = "#RETURN#"
# The strings that count as "no value".
FALSY = ("", "0")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _swap(c: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def trim_ws(c: Column | str) -> Column:
    """Remove white space at both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def strip_eol(c: Column | str) -> Column:
    """Remove the end-of-line characters."""
    return F.rtrim(_col(c), F.lit("\r\n"))


def escape_xml(c: Column | str) -> Column:
    """Escape ``& < >`` for text sinks. The XML sink escapes by itself."""
    return _swap(_col(c), ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))


def unescape_xml(c: Column | str) -> Column:
    """Undo ``&lt; &gt; &amp;``, so that the XML sink does not escape twice."""
    return _swap(_col(c), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def _has_entity(c: Column) -> Column:
    return c.contains("&") | c.contains("#")


def _entities(c: Column) -> Column:
    out = F.regexp_replace(c, "&(?!(?:gt|lt|apos|quot);)", "&amp;")
    out = _swap(out, ("#gt;", "&gt;"), ("#lt;", "&lt;"))
    return _swap(out, ("#apos;", "'"), ("#quot;", '"'), ("&apos;", "'"), ("&quot;", '"'))


def _breaks(c: Column) -> Column:
    out = _swap(F.regexp_replace(c, "(\r\n){2,}", PARAGRAPH_TOKEN), ("\r\n", RETURN_TOKEN))
    return _swap(F.regexp_replace(out, "\r{2,}", PARAGRAPH_TOKEN), ("\r", RETURN_TOKEN))


def normalise_entities(c: Column | str) -> Column:
    """Keep ``&gt; &lt;``, decode ``&apos; &quot;``, escape any other ``&``.

    The rule lets ``#`` stand for ``&``, so a literal ``#gt;``, ``#lt;``,
    ``#apos;`` or ``#quot;`` is changed as well.
    """
    c = _col(c)
    return F.when(_has_entity(c), _entities(c)).otherwise(c)


def tokenise_breaks(c: Column | str) -> Column:
    """Line breaks to tokens: a run of breaks opens a paragraph, a single one is
    a return. ``\\r\\n`` goes first, then bare ``\\r``; bare ``\\n`` stays."""
    c = _col(c)
    return F.when(c.contains("\r"), _breaks(c)).otherwise(c)


def clean_cell(c: Column | str) -> Column:
    """Trim, normalise entities, tokenise line breaks: the cleaning of a cell.

    Both conditions look at the untrimmed text, which decides the same. A
    condition on the result of the step before would double that step's code.
    """
    c = _col(c)
    out = trim_ws(c)
    out = F.when(_has_entity(c), _entities(out)).otherwise(out)
    return F.when(c.contains("\r"), _breaks(out)).otherwise(out)


def strip_control(c: Column | str) -> Column:
    """Remove the characters XML 1.0 forbids; the XML sink fails on them."""
    return F.regexp_replace(_col(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F\uFFFE\uFFFF]", "")


def replace_first(c: Column | str, pattern: str, text: str) -> Column:
    """Replace only the first match of ``pattern``, which must hold no groups."""
    return F.regexp_replace(_col(c), f"(?s)\\A(.*?)(?:{pattern})", "$1" + text)


def repair_quote(c: Column | str, correct: bool = False) -> Column:
    """Turn the first U+0092 + ``s`` of a line into an apostrophe.

    The rule loses the ``s``. ``correct=True`` keeps it and repairs every U+0092.
    """
    c = _col(c)
    if correct:
        return F.translate(c, "\u0092", "'")
    return F.when(c.contains("\u0092s"), replace_first(c, "\u0092s", "'")).otherwise(c)


def drop_falsy(c: Column | str, keep_zero: bool = False) -> Column:
    """NULL for values that count as missing: ``''`` and, unless kept, ``'0'``."""
    c = _col(c)
    for missing in FALSY[:1] if keep_zero else FALSY:
        c = F.nullif(c, F.lit(missing))
    return c


def drop_empty_value(c: Column | str) -> Column:
    """NULL for ``''`` only."""
    return F.nullif(_col(c), F.lit(""))


def fit_fields(line: Column | str, n: int, sep: str = "\t") -> Column:
    """Exactly ``n`` fields: the last keeps the unsplit rest, short rows get NULL."""
    parts = F.split(_col(line), sep, n)
    return F.array(*(F.get(parts, F.lit(i)) for i in range(n)))


def normalise_header(c: Column | str) -> Column:
    """Make a header cell usable as a name.

    The semicolon goes before entities are looked for, so ``&apos`` is the only
    one left to find; ``&quot;`` keeps its name without the semicolon.
    """
    c = _col(c)
    out = F.when(c.startswith("f"), F.regexp_replace(c, "\\Af([0-9]) ", "f0$1_")).otherwise(c)
    # Blanks become underscores and the other marks go, in one pass.
    out = _swap(F.translate(out, " '\";()/\\", "_"), ("#", "_No_"), ("&apos", ""))
    # Only runs are left to a regular expression; where there were none of what makes them, there is none.
    runs = c.contains("__") | c.contains(" ") | c.contains("#") | c.contains("_")
    return F.when(runs, F.regexp_replace(out, "__+", "_")).otherwise(out)


def element_name(header: Column | str, col_no: Column | str) -> Column:
    """A valid XML element name: the normalised header, with ``_c<i>`` for a
    blank one and ``_`` for characters a name may not hold."""
    name = F.regexp_replace(normalise_header(header), "[^\\p{L}\\p{N}_.-]", "_")
    name = F.regexp_replace(name, "\\A(?![\\p{L}_])", "_")
    blank = F.coalesce(trim_ws(header), F.lit("")) == ""
    return F.when(blank, F.concat(F.lit("_c"), _col(col_no).cast("string"))).otherwise(name)
