import unicodedata

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.functions import code, pii, quality, tokens
from textloom.functions import text as tx


def one(spark, build, value):
    return spark.createDataFrame([(value,)], "t string").select(build(F.col("t")).alias("r")).first().r


def test_cleaning(spark):
    assert one(spark, tx.collapse_stops, "Hi!!! ok?!?!") == "Hi! ok?!?!"
    assert one(spark, tx.collapse_elongation, "sooo 1111") == "soo 1111"
    assert one(spark, tx.strip_html, "<b>a</b>&amp;b &frac12; &#X41; &#x41;&#65;") == " a  b &frac12; &#X41;   "
    assert one(spark, tx.clean_text, "  see www.x.org/a \n\n\n\n me@x.org. sooo") == "see \n\n soo"
    for build in (tx.clean_text, tx.normalize_text, tx.preprocess, tx.brahmic_script):
        assert one(spark, build, None) is None
    assert one(spark, tx.preprocess, "") == ""


def test_normalisation(spark):
    for whole, parts in (("क़", "क़"), ("का़", "क़ा"), ("क़्", "क़्"), ("ऩ", "ऩ")):
        assert one(spark, tx.normalize_text, whole) == one(spark, tx.normalize_text, parts) == parts if "़" in parts else True
    assert one(spark, tx.normalize_nuktas, " ा़") == " ा़"  # no letter before the marks
    mixed = "क‍ख ‌ á ड़"
    again = one(spark, tx.normalize_text, mixed)
    assert one(spark, tx.normalize_text, again) == again
    assert one(spark, tx.strip_joiners, "क्‍ष a‍b") == "क्‍ष ab"
    assert one(spark, tx.fold_digits, "१२ ௩") == "12 3"
    assert one(spark, lambda c: tx.normalize_text(c, joiner_policy="keep", nukta_policy="nfc", fold=True), "a‍b १ ऩ") == "a‍b 1 ऩ"
    assert one(spark, lambda c: tx.normalize_text(c, joiner_policy="strip"), "क्‍ष") == "क्ष"
    with pytest.raises(ValueError, match="policy"):
        tx.normalize_text(F.lit("a"), joiner_policy="no")


@settings(max_examples=200, deadline=None)
@given(st.text("कखग़ा्क़ऩ a", max_size=12))
def test_nuktas_stand_first(text):
    got = tx._MARKS.sub(tx._nuktas_first, unicodedata.normalize("NFC", text).translate(tx._APART))
    assert sorted(got) == sorted(unicodedata.normalize("NFC", text).translate(tx._APART)) and tx._MARKS.sub(tx._nuktas_first, got) == got


def _diversity(words, limit=0.72):
    def run(ws):
        factors, seen, n = 0.0, [], 0
        for w in ws:
            n += 1
            if w not in seen:
                seen.append(w)
            if len(seen) / n <= limit:
                factors, seen, n = factors + 1, [], 0
        factors += (1 - len(seen) / n) / (1 - limit) if n else 0
        return len(ws) / factors if factors else float(len(ws))

    return (run(words) + run(words[::-1])) / 2 if len(words) > 1 else 0.0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefghij"), max_size=250))
def test_repetition_equals_plain_counting(words):
    codes = quality._codes(words)
    assert quality._diversity(codes) == pytest.approx(_diversity(words))
    for n in (1, 2, 3):
        runs = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        assert quality._top_share(codes, n) == pytest.approx(max(map(runs.count, runs)) * n / len(words) if runs else 0)


def test_quality(spark):
    assert one(spark, quality.sentences, "") == 1
    assert one(spark, quality.reading_ease, "") == 0
    assert one(spark, quality.lexical_diversity, "a") == 0
    assert one(spark, quality.syllables, "banana") == 3
    assert one(spark, quality.syllables, "कॢख") == 2 and "ৢ" in quality.VOWEL_SIGNS and "ৗ" not in quality.VOWEL_SIGNS
    assert one(spark, lambda c: quality.repeated_share(c, "\n"), "x\n x\ny") == 2 / 3
    assert one(spark, lambda c: quality.top_gram_share(c, 2), "a a a") == 4 / 3
    for build in (lambda c: quality.repeated_share(c, "\n"), lambda c: quality.top_gram_share(c, 2), quality.lexical_diversity):
        assert one(spark, build, None) == 0
    assert tuple(one(spark, quality.repetition, None)) == (0, 0, 0, 0, 0)


def test_code_lines(spark):
    df = spark.createDataFrame([("a = 1\n# b\n\n  -- c\r\nd e\n", "python"), ("% x\n// y", "odd"), ("", None), (None, "c"), ("\n", "c")], "t string, l string")
    got = [tuple(r.n) for r in df.select(code.line_counts(F.col("t"), F.col("l")).alias("n")).collect()]
    assert got == [(3, 6), (1, 2), (0, 0), (0, 0), (0, 1)]
    for text in ("a\nb", "a\r\nb\r", "\x0ba\x85b\x1c", "a "):
        assert one(spark, code.lines, text) == text.splitlines()


def test_token_counts(spark):
    path = "/opt/tokenizers/byte_bpe_50k.tiktoken"
    assert one(spark, tokens.count_tokens, "é") == 2
    for text in ("Don't stop  now", "", "पंचायत"):
        assert one(spark, lambda c: tokens.count_tokens(c, path), text) == len(tokens.encoding(path).encode_ordinary(text))
    assert one(spark, lambda c: tokens.count_tokens(c, path), None) is None and isinstance(tokens.encoding(path), tiktoken.Encoding)


def test_redaction(spark):
    assert one(spark, pii.redact, "card 4111111111111111 end") == "card [CREDIT_CARD] end"
    assert one(spark, pii.redact, "4111111111111111 and 94111111111111111") == "[CREDIT_CARD] and 94111111111111111"
    assert one(spark, pii.redact, "2024 4111 1111 1111 1111") == "2024 4111 1111 1111 1111"
    assert one(spark, pii.redact, "+91-9876543210, 12345678901") == "[PHONE], 12345678901"
    assert one(spark, pii.redact, "at 10.0.0.1 ABCDE1234F me@x.org") == "at [IP] [PAN] [EMAIL]"
    assert one(spark, pii.redact, "४१११ ११११ ११११ ११११") == "[CREDIT_CARD]"
    assert one(spark, pii.redact, None) is None and one(spark, pii.redact, "") == ""
    df = spark.createDataFrame([("[EMAIL] me@x.org 4111111111111111", "x"), (None, "y"), ("", "z")], "t string, counts0 string")
    got = {r.counts0: (r.redacted, {k: n for k, n in r.counts.items() if n}) for r in pii.redact_counted(df, "t").collect()}
    assert got == {"x": ("[EMAIL] [EMAIL] [CREDIT_CARD]", {"EMAIL": 1, "CREDIT_CARD": 1}), "y": (None, {}), "z": ("", {})}
