"""Column-level helpers: channel classification, path (de)serialisation,
path transforms and attribution weights. All return JVM-side expressions
(no Python UDFs), so they stay inside whole-stage codegen."""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NO_CAMPAIGN, PATH_SEPARATOR, ChannelRule


def ts_lit(t) -> Column:
    """A TIMESTAMP_NTZ literal built from its wall-clock text, so it means the
    same under every session time zone (``F.lit(datetime)`` does not)."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour without a time-zone round trip."""
    return F.date_format(ts, "yyyy-MM-dd HH:00:00").cast("timestamp_ntz")


def day_number(ts: Column) -> Column:
    """Calendar day of a timestamp as days since 1970-01-01 (an int key)."""
    return F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))


def classify_channel(rules: Sequence[ChannelRule], default: str) -> Column:
    """Ordered (predicate, label) rules as one CASE chain. Predicates are
    SQL over the touchpoint's columns (``medium``, ``source``, ...)."""
    expr: Column | None = None
    for r in rules:
        cond = F.expr(f"({r.condition})")
        expr = F.when(cond, F.lit(r.label)) if expr is None else expr.when(cond, F.lit(r.label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def campaign_label(mkt_campaign: Column) -> Column:
    """Null or empty campaign -> 'No campaign'."""
    return F.when(mkt_campaign.isNull() | (mkt_campaign == ""), F.lit(NO_CAMPAIGN)).otherwise(mkt_campaign)


#: A separator's sign that stands alone in a label, with the escape signs before it.
_ALONE = r"(?<=^| )(\\*)>(?=$| )"
_ESCAPED = r"(?<=^| )\\(\\*)>(?=$| )"


def path_to_string(arr: Column) -> Column:
    """Array path -> ``' > '``-joined string (nulls skipped).

    The text can be read back whatever the labels hold: where the separator's sign stands alone in a label
    (between spaces or at its ends) an escape sign is put before it, and before the ones already there.
    Labels without such a sign, all ordinary ones, are written as they are."""
    plain = F.array_join(arr, PATH_SEPARATOR)
    escaped = F.array_join(F.transform(arr, lambda x: F.regexp_replace(x, _ALONE, r"\\$1>")), PATH_SEPARATOR)
    return F.when(F.exists(arr, lambda x: F.contains(x, F.lit(">"))), escaped).otherwise(plain)


def string_to_path(s: Column) -> Column:
    """The labels of a path's text, as they were before ``path_to_string`` (an empty string is one empty
    element, a null string a null array)."""
    labels = F.split(s, re.escape(PATH_SEPARATOR))
    return F.when(F.contains(s, F.lit("\\")), F.transform(labels, lambda x: F.regexp_replace(x, _ESCAPED, "$1>"))).otherwise(labels)


# --- path transforms (O18) ----------------------------------------------------
# The reference delegates the transform body to a package; these two are our
# examples. Each maps an array<string> Column to an array<string> Column.

def unique_path(arr: Column) -> Column:
    """Keep the first occurrence of each touch point."""
    return F.array_distinct(arr)


def collapse_repeats(arr: Column) -> Column:
    """Collapse runs of the same touch point into one element."""
    return F.filter(arr, lambda x, i: (i == 0) | (x != F.get(arr, i - 1)))


# --- attribution weights (O24) ------------------------------------------------

def weights(index: Column, length: Column) -> dict[str, Column]:
    """Credit of the touch point at 0-based ``index`` in a path of ``length``
    under the four models (weights, not money; each sums to 1 per path).
    Position-based: 1 for one touch, 1/2 each for two, otherwise 0.4 to the
    first and last and 0.2 shared by the middle ones."""
    n = length.cast("double")
    is_first = index == 0
    is_last = index == length - 1
    return {
        "first_touch": F.when(is_first, 1.0).otherwise(0.0),
        "last_touch": F.when(is_last, 1.0).otherwise(0.0),
        "linear": F.lit(1.0) / F.nullif(n, F.lit(0.0)),
        "position_based": (
            F.when(length == 1, 1.0)
            .when(length == 2, 0.5)
            .when(is_first, 0.4)
            .when(is_last, 0.4)
            .otherwise(F.lit(0.2) / (n - 2.0))
        ),
    }
