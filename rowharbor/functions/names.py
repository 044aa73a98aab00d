"""How far a file header is from a dataset column's name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITE = float("inf")
MOST_BITS = 62  # letters of a field name that one number holds, with room to add


def _word(c: Column) -> Column:
    return c.rlike(r"^[\p{L}\p{Nd}]$")


def header_letters(header: Column) -> Column:
    """What the distances need of each character of a header; worked out once for all its pairs."""
    return F.transform(F.split(header, ""), lambda c: F.struct(
        c.alias("c"), _word(c).alias("word"), c.rlike(r"^\p{IsUppercase}$").alias("high")))


def field_letters(field_name: Column) -> Column:
    """What the distances need of a field name: its letters, and the places of each as bits."""
    letters = F.transform(F.split(field_name, ""), lambda c, i: F.struct(
        c.alias("c"), i.alias("i"), c.rlike(r"^\p{IsLowercase}$").alias("low")))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def places(c: Column) -> Column:
        return F.aggregate(F.filter(letters, lambda p: (p["c"] == c) & (p["i"] < MOST_BITS)), zero,
                           lambda bits, p: bits.bitwiseOR(F.call_function("shiftleft", one, p["i"])))

    known = F.array_distinct(F.split(field_name, ""))
    masks = F.map_from_arrays(known, F.transform(known, places))
    return F.struct(letters.alias("letters"), masks.alias("masks"),
                    F.coalesce(F.try_element_at(masks, F.lit("_")), zero).alias("under"))


def _lost(header: Column, field: Column, n: Column) -> Column:
    """Letters of the field name that the header doesn't have in this order; ``_`` is had by any
    character that is neither letter nor digit.

    A longest common subsequence with one bit for each letter of the field name: a step for each letter
    of the header adds the bits that it has to the row of bits not reached yet.
    """
    zero, all_bits = F.lit(0).cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), n) - 1

    def step(row: Column, b: Column) -> Column:
        has = F.coalesce(F.try_element_at(field["masks"], b["c"]), zero)
        hit = row.bitwiseAND(F.when(b["word"], has).otherwise(has.bitwiseOR(field["under"])))
        return (row + hit).bitwiseOR(row - hit).bitwiseAND(all_bits)

    return F.bit_count(F.aggregate(header, all_bits, step))


def _lost_of_long(header: Column, field: Column, n: Column) -> Column:
    """The same for names of any length, over a row of counts."""
    start = F.sequence(F.lit(0), n).cast("array<int>")

    def row(above: Column, b: Column) -> Column:
        return F.aggregate(field["letters"], F.array(F.lit(0)), lambda out, p: F.array_append(out, F.least(
            F.element_at(out, -1) + 1, F.get(above, p["i"] + 1),
            F.get(above, p["i"]) + F.when((p["c"] == b["c"]) | ((p["c"] == "_") & ~b["word"]), 0).otherwise(1))))

    return F.element_at(F.aggregate(header, start, row), -1)


def _cost(header: Column, field: Column, n: Column) -> Column:
    """Weighted edit distance, over two rows of the table at a time.

    Fixed values: 0.1 for a character that is no letter or digit where the field name has ``_`` or nothing,
    and for a capital where it has a small letter; 1 for all other changes.
    """
    first = F.transform(F.sequence(F.lit(0), n), lambda j: j.cast("double"))

    def row(above: Column, a: Column) -> Column:
        drop = F.when(a["word"] | (a["c"] == "_"), 1.0).otherwise(0.1)
        return F.aggregate(field["letters"], F.array(F.get(above, F.lit(0)) + drop), lambda out, p: F.array_append(out, F.least(
            F.element_at(out, -1) + 1.0, F.get(above, p["i"] + 1) + drop,
            F.get(above, p["i"]) + F.when(p["c"] == a["c"], 0.0)
            .when(((p["c"] == "_") & ~a["word"]) | (a["high"] & p["low"]), 0.1).otherwise(1.0))))

    return F.element_at(F.aggregate(header, first, row), -1)


def field_name_distance(
    header: Column, field_name: Column, letters: Column | None = None, field: Column | None = None
) -> Column:
    """Cost of reading ``header`` as ``field_name``; infinite where a quarter of the field name or
    more would be lost or changed. Where many pairs are compared, hand over ``header_letters`` and
    ``field_letters``, worked out before."""
    letters = header_letters(header) if letters is None else letters
    field = field_letters(field_name) if field is None else field
    n = F.length(field_name)
    lost = F.when(n <= MOST_BITS, _lost(letters, field, n)).otherwise(_lost_of_long(letters, field, n))
    never = (header == "") | (field_name == "") | ~may_be_field(header, field_name)
    return (
        F.when(never, INFINITE).when(header == field_name, 0.0)
        .when(lost >= n * 0.25, INFINITE).otherwise(_cost(letters, field, n))
    )


def may_be_field(header: Column, field_name: Column) -> Column:
    """False where the weighted distance is infinite for sure: letters of the field name that the
    header does not have at all must be lost or changed. Spares the slow comparison."""
    absent = F.call_function("translate", field_name, F.concat(header, F.lit("_")), F.lit(""))
    return F.length(absent) < F.length(field_name) * 0.25


def display_name_distance(header: Column, display_name: Column) -> Column:
    """Plain edit distance; infinite from a quarter of the longer text on."""
    longer = F.greatest(F.length(header), F.length(display_name))
    allowed = (F.ceil(longer * 0.25) - 1).cast("int")
    distance = F.call_function("levenshtein", header, display_name, allowed)
    return F.when((allowed >= 0) & (distance >= 0), distance.cast("double")).otherwise(
        F.lit(INFINITE)
    )
