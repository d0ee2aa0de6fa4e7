"""Lines of source code that are not comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions.text import STRIP

# How a comment line begins in each language, and in any.
PREFIXES = {
    "python": "#", "ruby": "#", "shell": "#", "javascript": "//", "typescript": "//", "java": "//", "c": "//", "c++": "//", "c-sharp": "//",
    "go": "//", "rust": "//", "php": "//", "sql": "--", "html": "<!--", "css": "/*",
}
GENERIC = ("#", "//", "--", "/*", "*", "<!--")
# What ends a line of code; a carriage return and a line feed end one together.
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
#: Least lines of code of a file worth keeping.
LEAST_LINES = 3


def lines(c: Column) -> Column:
    """The lines of a text; an end of line at the very end starts no further one, an empty text has none."""
    parts = F.split(F.regexp_replace(c, f"(?:{BREAK})$", ""), BREAK, -1)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(parts)


def markers(language: Column) -> Column:
    """What a comment line may begin with in that language."""
    own = F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair])
    return F.array_compact(F.array(F.element_at(own, language), *[F.lit(g) for g in GENERIC]))


def line_counts(c: Column, language: Column) -> Column:
    """struct(code_lines, total_lines): lines that are not blank and begin with no comment marker, and all lines. A null text has
    none of either; a null or unknown language has the generic markers."""
    found = lines(F.coalesce(c, F.lit("")))
    is_code = lambda x: (x != "") & ~F.exists(markers(F.coalesce(language, F.lit(""))), lambda m: F.startswith(x, m))
    code = F.size(F.filter(F.transform(found, lambda x: F.regexp_replace(x, STRIP, "")), is_code))
    return F.struct(code.cast("long").alias("code_lines"), F.size(found).cast("long").alias("total_lines"))
