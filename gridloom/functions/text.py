"""Text of recognised lines, names of artifacts, and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined_lines(order: str, text: str) -> Column:
    """Aggregate: the lines that have text, in order, one to a line; empty if none has."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    some = F.filter(rows, lambda r: r.t.isNotNull() & (r.t != ""))
    return F.array_join(F.transform(some, lambda r: r.t), "\n")


def line_records(order: str, *columns: str) -> Column:
    """Aggregate: structs of the columns in order; lines without text stay."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), *columns)))
    return F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in columns]))


def result_json(page, lines) -> Column:
    """A result as JSON; a page that isn't named is the first."""
    return F.to_json(F.struct(F.coalesce(page, F.lit(1)).cast("int").alias("page"), lines.alias("text_lines")))


def stem(path: Column) -> Column:
    """Name of a file without its last suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def voter_file(number: Column) -> Column:
    """At least three digits; more widen the name."""
    return F.format_string("voter_%03d.jpg", number)


def two_digits(seconds: Column) -> Column:
    return F.format_string("%.2f", seconds)


def elapsed(seconds: Column) -> Column:
    """Hours, minutes and seconds, without leading units that are zero."""
    hours = F.floor(seconds / 3600).cast("long")
    minutes = F.floor(F.pmod(seconds, F.lit(3600.0)) / 60).cast("long")
    rest = two_digits(F.pmod(seconds, F.lit(60.0)))
    short = F.when(minutes > 0, F.concat(minutes.cast("string"), F.lit("m "), rest, F.lit("s"))).otherwise(F.concat(rest, F.lit("s")))
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m "), rest, F.lit("s"))).otherwise(short)


def elapsed_long(seconds: Column) -> Column:
    """Minutes, if any, and seconds in words, with all seconds behind."""
    minutes = F.floor(seconds / 60).cast("long")
    rest = two_digits(F.pmod(seconds, F.lit(60.0)))
    many = F.concat(minutes.cast("string"), F.lit(" minute(s) "), rest, F.lit(" seconds ("), two_digits(seconds), F.lit(" seconds)"))
    return F.when(minutes > 0, many).otherwise(F.concat(rest, F.lit(" seconds")))


def gibibytes(n: Column) -> Column:
    return n / F.lit(1024.0**3)
