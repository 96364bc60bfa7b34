"""String and regular-expression helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entity patterns used on call notes.
PHONE = r"\d{3}[-.]?\d{3}[-.]?\d{4}"
AMOUNT = r"\$[\d,]+\.\d{2}"
EMAIL = r"[\w.]+@[\w]+\.[a-z]+"
ACCOUNT = r"AC\d+"
VALID_EMAIL = r"^[\w.]+@[\w]+\.[a-z]+$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_name(x) -> Column:
    return F.initcap(F.trim(_c(x)))


def mask_keep_last(x, keep: int = 4, char: str = "*") -> Column:
    """Replace all but the last characters."""
    col = _c(x)
    hidden = F.greatest(F.length(col) - keep, F.lit(0))
    return F.concat(F.repeat(F.lit(char), hidden), F.right(col, F.lit(keep)))


def characters(x) -> Column:
    return F.filter(F.split(_c(x), ""), lambda c: c != "")


def every_nth_char(x, step: int = 2) -> Column:
    return F.array_join(F.filter(characters(x), lambda c, i: i % step == 0), "")


def index_of(x, needle: str) -> Column:
    """0-based position of the first occurrence, -1 when absent."""
    return F.instr(_c(x), needle) - 1


def count_of(x, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    col = _c(x)
    gone = F.length(F.replace(col, F.lit(needle), F.lit("")))
    return ((F.length(col) - gone) / len(needle)).cast("int")


def is_digits(x) -> Column:
    return _c(x).rlike("^[0-9]+$")


def is_alnum(x) -> Column:
    return _c(x).rlike("^[A-Za-z0-9]+$")


def split_nonempty(x, pattern: str) -> Column:
    return F.filter(F.split(_c(x), pattern), lambda p: F.trim(p) != "")


def literal(separator: str) -> str:
    """A regular expression for exactly this text."""
    return r"\Q" + separator.replace(r"\E", r"\E\\E\Q") + r"\E"


def key_values(x, pair_sep: str = "|", kv_sep: str = ":") -> Column:
    """``"k: v | k: v"`` as a trimmed string map; a repeated key keeps its last value."""
    entries = F.transform(
        F.split(_c(x), literal(pair_sep)),
        lambda p: F.struct(
            F.trim(F.get(F.split(p, literal(kv_sep), 2), F.lit(0))).alias("key"),
            F.trim(F.get(F.split(p, literal(kv_sep), 2), F.lit(1))).alias("value"),
        ),
    )
    keys = lambda es: F.transform(es, lambda e: e["key"])
    last = F.filter(entries, lambda e, i: ~F.array_contains(keys(F.slice(entries, i + 2, F.size(entries))), e["key"]))
    return F.map_from_entries(last)


def int_values(m) -> Column:
    """Parse map values to integers; unparsable ones become null."""
    return F.transform_values(m, lambda k, v: v.try_cast("int"))


def pairs_to_map(x, pattern: str) -> Column:
    """Map of group 1 to group 2 over all matches; a repeated key keeps its last value."""
    keys = F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(1))
    values = F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(2))
    last = F.transform(
        F.array_distinct(keys),
        lambda k: F.struct(
            k.alias("key"),
            F.element_at(F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda p: p["k"] == k), -1)["v"].alias("value"),
        ),
    )
    return F.map_from_entries(last)


def search(x, pattern: str) -> Column:
    """First match or null."""
    return F.regexp_substr(_c(x), F.lit(pattern))


def search_with(x, needle: str, pattern: str) -> Column:
    """First match of a pattern that always contains ``needle``; texts without it are skipped cheaply."""
    col = _c(x)
    return F.when(col.contains(needle), search(col, pattern))


def find_all(x, pattern: str) -> Column:
    return F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(0))


def starts_with_pattern(x, pattern: str) -> Column:
    return _c(x).rlike(f"^(?:{pattern})")


def squeeze_spaces(x) -> Column:
    return F.regexp_replace(_c(x), r"\s+", " ")


def entities(x) -> dict[str, Column]:
    """Phone, amount, e-mail and account number of a note (null where absent)."""
    return {
        "phone": search(x, PHONE),
        "amount": search_with(x, "$", AMOUNT),
        "email": search_with(x, "@", EMAIL),
        "account": search_with(x, "AC", ACCOUNT),
    }


def odd_letter_count(x) -> Column:
    """How many distinct characters occur an odd number of times.

    Works on the sorted characters, so one pass per text and no explode: a character closes an
    odd run when its run length is odd.
    """
    chars = F.array_sort(characters(x))
    start = F.struct(
        F.lit("").alias("prev"), F.lit(0).alias("run"), F.lit(0).alias("odd")
    )

    def step(acc, c):
        same = acc["prev"] == c
        return F.struct(
            c.alias("prev"),
            F.when(same, acc["run"] + 1).otherwise(1).alias("run"),
            F.when(same, acc["odd"]).otherwise(acc["odd"] + acc["run"] % 2).alias("odd"),
        )

    return F.aggregate(chars, start, step, lambda acc: acc["odd"] + acc["run"] % 2)


def can_be_palindrome(x) -> Column:
    return odd_letter_count(x) <= 1


def money(x) -> Column:
    return F.concat(F.lit("$"), F.format_number(_c(x), 2))


def percent(x, digits: int = 2) -> Column:
    return F.format_string(f"%.{digits}f%%", _c(x))


def thousands(x) -> Column:
    return F.format_number(_c(x), 0)
