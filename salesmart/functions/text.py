"""Text Column helpers for report cells and file names.

All are built-in Spark expressions (JVM side, codegen'd) — no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart.functions.numeric import col_

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results
# ---------------------------------------------------------------------------
# Cell texts that mean "no value"
NULL_TOKENS = ["", "-", "N/A", "#N/A", "#VALUE!"]
# Unicode hyphens mapped to ASCII "-": U+2010, U+2011, U+2012, U+2013, U+2014, U+2212, U+FF0D
UNICODE_HYPHENS = "‐‑‒–—−－"
# Store label aliases
NAME_ALIASES = {"ALL 19 STORES": "ALL 18 STORES", "ALL 17 STORES": "ALL 18 STORES",
                "BD": "Business Development"}
# Date in a file name: yyyy.m.d (the last valid one wins)
FILE_DATE_PATTERN = r"(\d{4})\.(\d{1,2})\.(\d{1,2})"
# Strict number syntax accepted after cleaning (Python float() minus nan/inf/underscores)
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def date_from_filename(name) -> Column:
    """H1: last *valid* yyyy.m.d in the string; invalid dates are skipped."""
    found = F.regexp_extract_all(col_(name), F.lit(FILE_DATE_PATTERN), 0)
    # fast path (codegen'd): the last match is usually a valid date
    last = F.try_to_date(F.try_element_at(found, F.lit(-1)), "yyyy.M.d")
    parsed = F.filter(F.transform(found, lambda s: F.try_to_date(s, "yyyy.M.d")),
                      lambda d: d.isNotNull())
    return F.coalesce(last, F.when(F.size(parsed) > 0, F.element_at(parsed, -1)))


def parse_amount(cell) -> Column:
    """H2: accounting number -> double.  Commas stripped, NULL tokens -> NULL,
    ``(n)`` -> -n, anything that is not a plain number -> NULL."""
    text = col_(cell).cast("string")
    s = F.trim(F.replace(text, F.lit(","), F.lit("")))   # literal, not regex
    minus = F.concat(F.lit("-"), F.trim(F.substr(s, F.lit(2), F.length(s) - 2)))
    # no NULL token ('', '-', 'N/A', ...) is a number: most cells hold one and are
    # known before any regular expression; a plain number never begins with '('
    number = F.when(s.startswith("("), F.when(s.endswith(")") & minus.rlike(NUMBER_PATTERN), minus.try_cast("double"))) \
        .when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))
    return F.when(~text.isin(NULL_TOKENS), number)


def parse_int(cell) -> Column:
    """H3: truncating int of H2."""
    return parse_amount(cell).cast("bigint")


def normalise_name(label) -> Column:
    """H4: trim, first non-empty line, Unicode hyphens -> '-', alias table."""
    def named(value, use):   # ``value`` is computed once, however often ``use`` names it
        return F.get(F.transform(F.array(value), use), 0)

    def first_line(s):
        lines = F.filter(F.transform(F.split(s, "\n"), lambda x: F.trim(x)), lambda x: x != "")
        return F.when(s.contains("\n"), F.coalesce(F.try_element_at(lines, F.lit(1)), s)).otherwise(s)

    def alias(n):
        out = n
        for k, v in NAME_ALIASES.items():
            out = F.when(n == k, F.lit(v)).otherwise(out)
        return out
    raw = col_(label).cast("string")
    s = F.replace(F.replace(F.trim(raw), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # a line of ASCII text, as most labels are, has nothing to split or translate
    plain = (F.length(raw) == F.octet_length(raw)) & ~raw.contains("\n") & ~raw.contains("\r")
    return F.when(plain, alias(F.trim(raw))).otherwise(
        named(F.translate(named(s, first_line), UNICODE_HYPHENS, "-" * len(UNICODE_HYPHENS)), alias))


def payload_int(payload, tag: str) -> Column:
    """H5: ``TAG:(\\d+)`` -> int (regexp_extract no-match is '', hence nullif)."""
    return F.nullif(F.regexp_extract(col_(payload), tag + r":(\d+)", 1), F.lit("")).try_cast("int")


def join_or_null(arr, sep: str = "; ") -> Column:
    """Join a list, NULL when empty."""
    a = col_(arr)
    return F.when(F.size(a) > 0, F.array_join(a, sep))


def basename(path) -> Column:
    """Last path element, separators normalised."""
    return F.element_at(F.split(F.replace(col_(path), F.lit("\\"), F.lit("/")), "/"), -1)


def format_amount(x, decimals: int = 0) -> Column:
    """Inverse of H2 for building report cells: thousands separators, negatives
    in parentheses."""
    x = col_(x)
    body = F.format_number(F.abs(x), decimals)
    mark = lambda m: F.when(x < 0, m).otherwise("")   # noqa: E731 - the body stands once in the plan
    return F.coalesce(F.concat(mark("("), body, mark(")")), F.lit("-"))
