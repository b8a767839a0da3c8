"""Field splitting for the three CSV dialects of the dumps (PRJ-1..3).

Each dialect is a left-to-right state machine in the original loaders.  Here it
is written as Java regular expressions evaluated by ``regexp_extract_all`` and
``transform``: no Python runs per row.  Possessive quantifiers keep the regex
engine from backtracking (and from overflowing its stack on megabyte fields).

L (lenient):  ``\\"`` is a literal quote anywhere; inside quotes ``""`` is a
              quote; a quote closes only before a comma or the end, otherwise it
              is literal; a quote outside quotes opens, even mid-field.
T (toggle):   as L, but every non-doubled quote toggles the quote state.
E (escape):   a backslash escapes any next character (a trailing one is
              dropped); otherwise as T without the ``\\"`` rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import once

# Private-use characters stand in for escaped ones (``MARK`` for a backslash) while T and E split.  Input that
# holds them is escaped first (``KEEP`` and a digit) and restored in every field, so
# no text is out of bounds.
KEEP, SENT_QUOTE, SENT_COMMA, MARK = "\ue000", "\ue001", "\ue002", "\ue003"
RESERVED = KEEP + SENT_QUOTE + SENT_COMMA + MARK

# L: one field after a leading comma: unquoted prefix, then an optional quoted part.
_L_FIELD = r'(?s),((?:\\"|[^",])*+(?:"(?:\\"|""|"(?!,|\z)|[^"])*+(?:"|\z))?)'
_L_PREFIX = r'(?s)^((?:\\"|[^"])*+)'
_L_BODY = r'(?s)^(?:\\"|[^"])*+"((?:\\"|""|"(?!\z)|[^"])*+)"?\z'

# T core: a field is a sequence of unquoted characters and quoted runs.
_T_FIELD = r'(?s),((?:[^",]|"(?:""|[^"])*+(?:"|\z))*+)'
_T_RUN = r'(?s)[^"]+|"(?:""|[^"])*+(?:"|\z)'
_T_RUN_BODY = r'(?s)^"((?:""|[^"])*+)"?\z'


def _lead_comma(line: Column) -> Column:
    return F.concat(F.lit(","), F.coalesce(line, F.lit("")))


def split_lenient(line: Column) -> Column:
    """PRJ-1: ARRAY<STRING> of the fields of ``line`` in dialect L."""
    fields = F.regexp_extract_all(_lead_comma(line), F.lit(_L_FIELD), 1)

    def decode(f: Column) -> Column:
        prefix = F.regexp_replace(F.regexp_extract(f, _L_PREFIX, 1), r'\\"', '"')
        body = F.regexp_replace(F.regexp_extract(f, _L_BODY, 1), r'\\"|""', '"')
        return F.concat(prefix, body)

    return F.transform(fields, decode)


def _toggle_core(line: Column) -> Column:
    """Split on commas outside quoted runs; strip run quotes and undouble ``""``."""
    fields = F.regexp_extract_all(_lead_comma(line), F.lit(_T_FIELD), 1)

    def run_value(r: Column) -> Column:
        quoted = F.replace(F.regexp_extract(r, _T_RUN_BODY, 1), F.lit('""'), F.lit('"'))
        return F.when(F.startswith(r, F.lit('"')), quoted).otherwise(r)

    def decode(f: Column) -> Column:
        runs = F.regexp_extract_all(f, F.lit(_T_RUN), 0)
        return F.when(F.contains(f, F.lit('"')), F.array_join(F.transform(runs, run_value), "")).otherwise(f)

    return F.transform(fields, decode)


def _split_protected(line: Column) -> Column:
    """Fields of a line whose escapes are sentinels; without a quote every comma separates."""
    return once(line, lambda s: F.when(F.contains(s, F.lit('"')), _toggle_core(s)).otherwise(F.split(s, ",")))


def _reserve(line: Column) -> Column:
    kept = line
    for digit, c in enumerate(RESERVED):  # KEEP first: later replacements bring new ones
        kept = F.replace(kept, F.lit(c), F.lit(f"{KEEP}{digit}"))
    holds = reduce(Column.__or__, [F.contains(line, F.lit(c)) for c in RESERVED])
    return F.when(holds, kept).otherwise(line)


def _restore(field: Column) -> Column:
    plain = field
    for sent, c in ((SENT_QUOTE, '"'), (SENT_COMMA, ","), (MARK, "\\")):
        plain = F.replace(plain, F.lit(sent), F.lit(c))
    kept = plain
    for digit in reversed(range(len(RESERVED))):  # KEEP last
        kept = F.replace(kept, F.lit(f"{KEEP}{digit}"), F.lit(RESERVED[digit]))
    return F.when(F.contains(field, F.lit(KEEP)), kept).otherwise(plain)


def split_toggle(line: Column) -> Column:
    """PRJ-2: ARRAY<STRING> of the fields of ``line`` in dialect T."""
    protected = F.regexp_replace(_reserve(F.coalesce(line, F.lit(""))), r'\\"', SENT_QUOTE)
    return F.transform(_split_protected(protected), _restore)


def split_escape_all(line: Column) -> Column:
    """PRJ-3: ARRAY<STRING> of the fields of ``line`` in dialect E."""
    s = _reserve(F.coalesce(line, F.lit("")))
    # a run of backslashes pairs up from its left; an odd last one escapes what follows, or is dropped at the end
    for escaped, sent in (("\\\\", MARK), ('\\"', SENT_QUOTE), ("\\,", SENT_COMMA), ("\\", "")):
        s = F.replace(s, F.lit(escaped), F.lit(sent))
    return F.transform(_split_protected(s), _restore)


SPLITTERS = {"L": split_lenient, "T": split_toggle, "E": split_escape_all}


def split_fields(line: Column, dialect: str) -> Column:
    """Dispatch on the dialect letter (L, T or E)."""
    return SPLITTERS[dialect](line)

