"""Column expressions on RDF terms: gates, parsing, distance, rounding.

All of them are built-in Spark expressions; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadweld.model import LITERAL, MAX_DATE_DIFFERENCE

# Fixed patterns: a plain decimal number, an ISO date or date-time.
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
DATE_PATTERN = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})?)?$"
)

# Fixed pattern: a number that decimal(28,10) holds without rounding.
EXACT_PATTERN = r"^[+-]?([0-9]{1,18}([.][0-9]{0,10})?|[.][0-9]{1,10})$"


def as_number(kind: Column, text: Column) -> Column:
    """Double value of a numeric literal, else null."""
    value = F.when((kind == LITERAL) & text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    # A text that no double holds is no number.
    return F.when(F.abs(value) < F.lit(float("inf")), value)


def as_decimal(text: Column) -> Column:
    """The number itself as a decimal, else null."""
    return F.when(text.rlike(EXACT_PATTERN), text.try_cast("decimal(28,10)"))


def as_seconds(kind: Column, text: Column) -> Column:
    """Epoch seconds of a date or date-time literal (UTC unless it says otherwise)."""
    zoned = (
        F.when(F.length(text) == 10, F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike("(Z|[+-][0-9]{2}:[0-9]{2})$"), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    stamp = F.when((kind == LITERAL) & text.rlike(DATE_PATTERN), zoned.try_cast("timestamp"))
    return F.unix_micros(stamp) / F.lit(1e6)


def is_finite_number(kind: Column, text: Column) -> Column:
    return as_number(kind, text).isNotNull()


def text_distance(a: Column, b: Column) -> Column:
    """One minus the cosine of the counts of character pairs, ends included.

    This is for single pairs. Sums over a cluster need no pairs: vectors of one length add up, see
    ``operators.quality``.
    """

    def tagged(text: Column, side: int) -> Column:
        return F.transform(character_pairs(text), lambda pair: F.struct(pair.alias("pair"), F.lit(side).alias("side")))

    def told(now: Column) -> dict[str, Column]:
        """The three products, with those of the pair that was counted last."""
        return {
            "aa": now["aa"] + now["a"] * now["a"],
            "bb": now["bb"] + now["b"] * now["b"],
            "ab": now["ab"] + now["a"] * now["b"],
        }

    def step(now: Column, pair: Column) -> Column:
        same = now["pair"] == pair["pair"]
        in_a, in_b = (F.when(pair["side"] == side, 1.0).otherwise(0.0) for side in (0, 1))
        counts = {"a": F.when(same, now["a"]).otherwise(0.0) + in_a, "b": F.when(same, now["b"]).otherwise(0.0) + in_b}
        sums = {name: F.when(same, now[name]).otherwise(total) for name, total in told(now).items()}
        fields = {"pair": pair["pair"], **counts, **sums}
        return F.struct(*[c.alias(name) for name, c in fields.items()])

    def cosine(now: Column) -> Column:
        sums = told(now)
        return sums["ab"] / F.sqrt(sums["aa"] * sums["bb"])

    # Equal pairs of both texts come together once all are sorted.
    start = F.struct(F.lit("").alias("pair"), *[F.lit(0.0).alias(c) for c in ("a", "b", "aa", "bb", "ab")])
    cosine_of_both = F.aggregate(F.array_sort(F.concat(tagged(a, 0), tagged(b, 1))), start, step, cosine)
    return F.when(a == b, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - cosine_of_both))


def character_pairs(text: Column) -> Column:
    """All neighbouring characters of a text between two marks, repeats included."""
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    before, after = F.concat(F.array(F.lit("^")), characters), F.concat(characters, F.array(F.lit("$")))
    return F.zip_with(before, after, lambda x, y: F.concat(x, y))


def number_distance(a: Column, b: Column) -> Column:
    longest = F.greatest(F.abs(a), F.abs(b))
    return F.when(longest == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.abs(a - b) / longest)
    )


def time_distance(a: Column, b: Column, span: float = MAX_DATE_DIFFERENCE) -> Column:
    return F.least(F.lit(1.0), F.abs(a - b) / F.lit(float(span)))


def distance(
    a_kind: Column, a: Column, b_kind: Column, b: Column, span: float = MAX_DATE_DIFFERENCE
) -> Column:
    """Distance of two terms in [0, 1].

    Same kind and text 0; numbers, dates and other literals by their own measure;
    different IRIs or literals of different classes 1.
    """
    a_num, b_num = as_number(a_kind, a), as_number(b_kind, b)
    a_sec, b_sec = as_seconds(a_kind, a), as_seconds(b_kind, b)
    plain = (
        (a_kind == LITERAL)
        & (b_kind == LITERAL)
        & a_num.isNull()
        & b_num.isNull()
        & a_sec.isNull()
        & b_sec.isNull()
    )
    return (
        F.when((a_kind == b_kind) & (a == b), F.lit(0.0))
        .when(a_num.isNotNull() & b_num.isNotNull(), number_distance(a_num, b_num))
        .when(a_sec.isNotNull() & b_sec.isNotNull(), time_distance(a_sec, b_sec, span))
        .when(plain, text_distance(a, b))
        .otherwise(F.lit(1.0))
    )


def quantise(value: Column) -> Column:
    """Round to steps of 1e-9 so that the order of summation cannot show.

    The offset keeps short decimals, which are common among scores, away from the
    rounding edge.
    """
    return F.floor(value * F.lit(1e9) + F.lit(0.533713)) / F.lit(1e9)


def short_decimal(value: Column) -> Column:
    """Text of a decimal without closing zeros."""
    return F.regexp_replace(F.regexp_replace(value.cast("string"), "([.][0-9]*?)0+$", "$1"), "[.]$", "")
