"""Text column functions: trim, drop last character, safe numeric parse,
case-insensitive comparison, object paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading/trailing white space of any kind (incl. newlines and
    Unicode spaces), like Python's ``str.strip()``."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def drop_last_char(c) -> Column:
    """``s[:-1]``: the text without its last character; '' stays ''."""
    s = _col(c)
    return F.when(F.length(s) > 0, s.substr(F.lit(1), F.length(s) - 1)).otherwise(s)


def safe_long(c) -> Column:
    """Number parse, bad -> null (``to_numeric(errors='coerce')`` to Int64).
    Spark's string-to-number cast already ignores surrounding white space
    and control characters, so no extra trim (and no regex) is needed."""
    return _col(c).try_cast("bigint")


def safe_double(c) -> Column:
    """Number parse, bad -> null, as double (surrounding white space ignored)."""
    return _col(c).try_cast("double")


# The collation that text is compared under: case and trailing blanks do not count.
COLLATION = "UTF8_LCASE_RTRIM"


def collated(c) -> Column:
    """Text whose comparisons, groups and joins ignore case and trailing blanks; the text itself
    stays as it is."""
    return F.collate(_col(c), COLLATION)


def ci_equals(c, literal: str) -> Column:
    """Equality with a literal under the collation, null -> false."""
    return F.coalesce(collated(c) == F.lit(literal), F.lit(False))


def object_path(prefix: str, company, stamp) -> Column:
    """``{prefix}/{company}/{company}_{stamp}.parquet``."""
    c = _col(company)
    return F.concat(F.lit(prefix + "/"), c, F.lit("/"), c, F.lit("_"), _col(stamp),
                    F.lit(".parquet"))
