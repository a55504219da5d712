"""Column helpers for the text rules every operator shares.

One notion of "empty" holds everywhere: null, the empty string and white
space only are the same thing.  All helpers are built-in Spark expressions,
so they stay inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space at the ends of a cell.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE_RUN = r"(?U)[\s\x1c-\x1f]+"
SENTENCE_ENDERS = "。！？；"

# Column names that can be written in an expression as they are.
_PLAIN_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")
_NUMBER = r"\A[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\z"
_HOST = r"(?i)\A(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#]*@)?([^/?#:@\[\]]+)"
_NETLOC = r"(?i)\A(?:[a-z][a-z0-9+.\-]*:)?//([^/?#]*)"
_PATH = r"(?i)\A(?:[a-z][a-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _raw_sql(name: str) -> str:
    quoted = ".".join(f"`{part}`" for part in name.split("."))
    return f"coalesce(cast({quoted} as string), '')"


def raw(c: ColumnLike) -> Column:
    """The cell as stored, null read as the empty string."""
    if isinstance(c, str) and _PLAIN_NAME.fullmatch(c):
        return F.expr(_raw_sql(c))
    return F.coalesce(col(c).cast("string"), F.lit(""))


def strip(c: ColumnLike) -> Column:
    if isinstance(c, str) and _PLAIN_NAME.fullmatch(c):
        return F.expr(f"btrim({_raw_sql(c)}, '{SPACE_CHARS}')")
    return F.btrim(raw(c), F.lit(SPACE_CHARS))


def has_text(c: ColumnLike) -> Column:
    return strip(c) != F.lit("")


def is_blank(c: ColumnLike) -> Column:
    return strip(c) == F.lit("")


def first_text(*cs: ColumnLike) -> Column:
    """The first stripped cell that is not blank, else the empty string."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cs[:-1]], strip(cs[-1]))


def collapse(c: ColumnLike) -> Column:
    return F.regexp_replace(raw(c), SPACE_RUN, " ")


def to_int(c: ColumnLike) -> Column:
    """Whole number in the text, or null.  ``'2023.0'`` is not one."""
    return F.when(strip(c).rlike(r"\A[-+]?\d+\z"), strip(c).try_cast("int"))


def to_number(c: ColumnLike) -> Column:
    """Number in the text, or null.  Leaves out the suffixes a JVM parse lets pass."""
    return F.when(strip(c).rlike(_NUMBER), strip(c).try_cast("double"))


def year_key(c: ColumnLike) -> Column:
    """All-digit text without leading zeros; other text stripped."""
    text = strip(c)
    return F.when(text.rlike(r"\A[0-9]+\z"), F.regexp_replace(text, r"\A0+(?=.)", "")).otherwise(text)


def any_of(tests: Iterable[Column], empty: bool = False) -> Column:
    tests = list(tests)
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(empty)


def all_of(tests: Iterable[Column], empty: bool = True) -> Column:
    tests = list(tests)
    return reduce(lambda a, b: a & b, tests) if tests else F.lit(empty)


def has_value(cols: Sequence[str]) -> Column:
    """True when any listed column holds text; true for an empty list."""
    return any_of([has_text(c) for c in cols], empty=True)


def contains_any(c: ColumnLike, words: Iterable[str]) -> Column:
    return any_of([col(c).contains(F.lit(w)) for w in words])


def total(terms: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, list(terms), F.lit(0))


def weight_when(test: Column, weight: int) -> Column:
    return F.when(test, F.lit(int(weight))).otherwise(F.lit(0))


def split_sentences(c: ColumnLike, enders: str = SENTENCE_ENDERS) -> Column:
    """Sentences of a text, each ending with its own ender; blanks dropped."""
    parts = F.split(collapse(c), f"(?<=[{enders}])")
    return F.filter(F.transform(parts, strip), lambda s: s != F.lit(""))


def extract_domain(url: ColumnLike) -> Column:
    """Lower-case host without user or port; blank when there is none."""
    return F.lower(F.regexp_extract(strip(url), _HOST, 1))


def net_location(url: ColumnLike) -> Column:
    """Host part as written, with port and letter case kept."""
    return F.regexp_extract(raw(url), _NETLOC, 1)


def url_path(url: ColumnLike) -> Column:
    return F.regexp_extract(raw(url), _PATH, 1)


def is_http(url: ColumnLike) -> Column:
    return strip(url).startswith("http://") | strip(url).startswith("https://")


def domain_filter(url: ColumnLike, wanted: Sequence[str] = ()) -> Column:
    """Keep http(s) addresses that hold any of the wanted texts (all, if none)."""
    words = [w.strip().lower() for w in wanted if w.strip()]
    keep = is_http(url)
    return keep & contains_any(F.lower(strip(url)), words) if words else keep


def clean_snippet(c: ColumnLike, n: int = 96) -> Column:
    """One line, without private-use characters, cut to ``n`` with dots."""
    line = F.btrim(F.regexp_replace(raw(c), "\n", " "), F.lit(SPACE_CHARS))
    line = F.regexp_replace(line, r"[\ue000-\uf8ff]", "")
    return F.when(F.length(line) > n, F.concat(F.substring(line, 1, n), F.lit("..."))).otherwise(line)


def plain_decimal(c: ColumnLike, places: int = 6) -> Column:
    """Fixed-point text without trailing zeros."""
    text = F.format_string(f"%.{places}f", col(c).cast("double"))
    return F.regexp_replace(F.regexp_replace(text, r"0+\z", ""), r"\.\z", "")
