"""Ordered redaction rules as Column builders: each works on what the one before left."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import EMAIL, URL

_EDGE, _END = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
# The patterns of the ordered rules.
OCTET = r"(?:25[0-5]|2[0-4]\p{Nd}|1?\p{Nd}?\p{Nd})"
IPV4 = rf"{_EDGE}(?:{OCTET}\.){{3}}{OCTET}{_END}"
PAN = rf"{_EDGE}[A-Za-z]{{5}}[0-9]{{4}}[A-Za-z]{_END}"
PHONE = r"(?<!\p{Nd})(?:\+?91[-\s]?)?[6-9]\p{Nd}{9}(?!\p{Nd})"
RUN = r"(?<!\p{Nd})\p{Nd}[\p{Nd} \-]{9,24}\p{Nd}(?!\p{Nd})"
RULES = (("URL", URL), ("EMAIL", EMAIL), ("IP", IPV4), ("PAN", PAN), ("PHONE", PHONE))
LABELS = (*(label for label, _ in RULES), "AADHAAR", "CREDIT_CARD")
_NATIVE = [chr(i) for i in range(0x80, 0x20000) if unicodedata.decimal(chr(i), None) is not None]


def verhoeff_ok(digits: Column) -> Column:
    """Whether a string of digits passes the Verhoeff check, by the rule of the dihedral group."""
    d = [[(a + b) % 5 if a < 5 and b < 5 else 5 + (a + b) % 5 if a < 5 else 5 + (a - b) % 5 if b < 5 else (a - b) % 5 for b in range(10)] for a in range(10)]
    first = [1, 5, 7, 6, 2, 8, 3, 0, 9, 4]
    perms = [list(range(10))]
    for _ in range(7):
        perms.append([perms[-1][first[i]] for i in range(10)])
    dt = F.array(*[F.lit(x) for row in d for x in row])
    pt = F.array(*[F.lit(x) for row in perms for x in row])
    signs = F.split(F.reverse(digits), "")
    numbered = F.transform(F.filter(signs, lambda x: x != ""), lambda x, i: F.element_at(pt, (i % 8) * 10 + x.cast("int") + 1))
    return F.aggregate(numbered, F.lit(0), lambda c, p: F.element_at(dt, c * 10 + p + 1)) == 0


def run_label(run: Column) -> Column:
    """AADHAAR or CREDIT_CARD for a run of digits, blanks and dashes with the right length and check digit, else null."""
    plain = F.regexp_replace(F.translate(run, "".join(_NATIVE), "".join(str(unicodedata.decimal(c)) for c in _NATIVE)), "[^0-9]", "")
    return F.when((F.length(plain) == 12) & verhoeff_ok(plain), "AADHAAR").when(F.length(plain).between(13, 19) & F.call_function("luhn_check", plain), "CREDIT_CARD")


def _is(label: str):
    return lambda x: x == F.lit(label)


def _between(c: Column, found: Column) -> Column:
    """``c`` with its digit runs replaced in place: what stands between them and their labels, joined again."""
    parts = F.split(c, RUN, -1)
    return F.array_join(F.zip_with(parts, F.array_append(found, F.lit("")), lambda p, r: F.concat(p, r)), "")


def redact(c: Column) -> Column:
    """Text with URL, EMAIL, IP, PAN, PHONE placeholders, then checked digit runs (AADHAAR, CREDIT_CARD), each run judged and
    replaced where it stands; null stays null."""
    for label, pattern in RULES:
        c = F.regexp_replace(c, pattern, f"[{label}]")
    named = F.transform(F.regexp_extract_all(c, F.lit(RUN), F.lit(0)), lambda r: F.coalesce(F.concat(F.lit("["), run_label(r), F.lit("]")), r))
    return _between(c, named)


def redact_counted(df: DataFrame, text: str) -> DataFrame:
    """``df`` plus ``redacted`` and ``counts``, a map of each label to its replacements in the row (0 where none; placeholders
    that stood in the text already do not count). A null text has a null result and zero counts."""
    df = df.withColumn("redacted", F.col(text))
    for label, pattern in RULES:
        df = df.withColumn(f"_n_{label}", F.coalesce(F.regexp_count("redacted", F.lit(pattern)), F.lit(0))).withColumn("redacted", F.regexp_replace("redacted", pattern, f"[{label}]"))
    df = df.withColumn("_runs", F.regexp_extract_all("redacted", F.lit(RUN), F.lit(0))).withColumn("_named", F.transform("_runs", run_label))
    for label in ("AADHAAR", "CREDIT_CARD"):
        df = df.withColumn(f"_n_{label}", F.coalesce(F.size(F.filter("_named", _is(label))), F.lit(0)))
    kept = F.zip_with("_named", "_runs", lambda n, r: F.coalesce(F.concat(F.lit("["), n, F.lit("]")), r))
    df = df.withColumn("redacted", _between(F.col("redacted"), kept)).withColumn("counts", F.create_map(*[x for label in LABELS for x in (F.lit(label), F.greatest(F.lit(0), F.col(f"_n_{label}")))]))
    return df.drop("_runs", "_named", *[f"_n_{label}" for label in LABELS])
