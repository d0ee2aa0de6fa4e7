"""The same results stated in SQL, with patterns, ranges and lists spelled out here, apart from the library's own."""

from __future__ import annotations

SQL: dict[str, str] = {}

# White space as Python has it.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORDS = f"regexp_extract_all(coalesce(text, ''), '[^{WS}]+')"
TRIM = f"^[{WS}]+|[{WS}]+$"
STOP_SIGNS = ["!", r"\?", r"\.", ",", ";", ":", "।", "॥"]
MAIL = r"[\p{L}\p{N}+._-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}._-]+"
LINK = rf"(?i)(?:http://|https://|www\.)[^{WS}]+"
CONTROLS = r"[\x{ad}\x{180e}\x{200b}\x{200e}\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{feff}]"
FIGURES = "".join(chr(z + i) for z in (0x966, 0x9E6, 0xA66, 0xAE6, 0xB66, 0xBE6, 0xC66, 0xCE6, 0xD66) for i in range(10))
SYMBOLS = r"[#*~^_+=<>|@$%&…]|[.][.][.]"
NUKTA = r"\x{93c}\x{9bc}\x{a3c}\x{abc}\x{b3c}\x{c3c}\x{cbc}"
VIRAMA = r"\x{94d}\x{9cd}\x{a4d}\x{acd}\x{b4d}\x{bcd}\x{c4d}\x{ccd}\x{d4d}"
SIGNS = (
    r"\x{93a}\x{93b}\x{93e}-\x{94c}\x{94e}\x{94f}\x{955}-\x{957}\x{962}\x{963}\x{9be}-\x{9c4}\x{9c7}\x{9c8}\x{9cb}\x{9cc}\x{9e2}\x{9e3}\x{a3e}-\x{a42}\x{a47}\x{a48}\x{a4b}\x{a4c}"
    r"\x{abe}-\x{ac5}\x{ac7}-\x{ac9}\x{acb}\x{acc}\x{ae2}\x{ae3}\x{b3e}-\x{b44}\x{b47}\x{b48}\x{b4b}\x{b4c}\x{b62}\x{b63}\x{bbe}-\x{bc2}\x{bc6}-\x{bc8}\x{bca}-\x{bcc}\x{c3e}-\x{c44}\x{c46}-\x{c48}\x{c4a}-\x{c4c}\x{c62}\x{c63}"
    r"\x{cbe}-\x{cc4}\x{cc6}-\x{cc8}\x{cca}-\x{ccc}\x{ce2}\x{ce3}\x{d3e}-\x{d44}\x{d46}-\x{d48}\x{d4a}-\x{d4c}\x{d62}\x{d63}\x{dcf}-\x{dd4}\x{dd6}\x{dd8}-\x{ddf}\x{df2}\x{df3}"
)
BLOCKS = [("Devanagari", r"\x{900}-\x{97f}"), ("Bengali", r"\x{980}-\x{9ff}"), ("Gurmukhi", r"\x{a00}-\x{a7f}"), ("Gujarati", r"\x{a80}-\x{aff}"), ("Oriya", r"\x{b00}-\x{b7f}"), ("Tamil", r"\x{b80}-\x{bff}"), ("Telugu", r"\x{c00}-\x{c7f}"), ("Kannada", r"\x{c80}-\x{cff}"), ("Malayalam", r"\x{d00}-\x{d7f}"), ("Sinhala", r"\x{d80}-\x{dff}")]
# Letters with a nukta and their base letters, by block.
PRECOMPOSED = {
    0x93C: [(0x929, 0x928), (0x931, 0x930), (0x934, 0x933), (0x958, 0x915), (0x959, 0x916), (0x95A, 0x917), (0x95B, 0x91C), (0x95C, 0x921), (0x95D, 0x922), (0x95E, 0x92B), (0x95F, 0x92F)],
    0x9BC: [(0x9DC, 0x9A1), (0x9DD, 0x9A2), (0x9DF, 0x9AF)], 0xA3C: [(0xA33, 0xA32), (0xA36, 0xA38), (0xA59, 0xA16), (0xA5A, 0xA17), (0xA5B, 0xA1C), (0xA5E, 0xA2B)], 0xB3C: [(0xB5C, 0xB21), (0xB5D, 0xB22)],
}


def sub(x: str, pattern: str, by: str) -> str:
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def chars(source: str, name: str = "t") -> str:
    """(doc_id, z): each sign of a text with the one before, the one before that and the one after."""
    cut = f"(SELECT doc_id, {name} AS whole, regexp_extract_all({name}, '(?s).') AS c FROM ({source}))"
    return f"(SELECT doc_id, whole, list_zip(c, list_concat([NULL], c), list_concat([NULL, NULL], c), c[2:]) AS z, len(c) AS k FROM {cut})"


def filtered(source: str, keep: str) -> str:
    """(doc_id, t): a text's signs for which ``keep`` holds (z[1] the sign, z[2] and z[3] those before, z[4] the next)."""
    return f"SELECT doc_id, CASE WHEN whole IS NOT NULL THEN array_to_string(list_transform(list_filter(z[:k], lambda z: {keep}), lambda z: z[1]), '') END AS t FROM {chars(source)}"


def html(x: str) -> str:
    return sub(sub(x, "<[^>]+>", " "), r"&(?:[a-zA-Z]+|#\p{Nd}+|#x[0-9a-fA-F]+);", " ")


def stops(x: str) -> str:
    for c in STOP_SIGNS:
        x = sub(x, c + "+", c[-1])
    return x


def white(x: str) -> str:
    return sub(sub(sub(x, r"[ \t\x{a0}]+", " "), r"\n{3,}", "\n\n"), TRIM, "")


TEXTS = "SELECT doc_id, text AS t FROM documents"
ELONGATED = "NOT coalesce(z[1] = z[2] AND z[1] = z[3] AND regexp_matches(z[1], '[\\p{L}\\p{M}]'), false)"
JOINED = f"NOT (z[1] IN (chr(8204), chr(8205)) AND NOT coalesce(regexp_matches(z[2], '[{VIRAMA}]'), false) AND NOT coalesce(regexp_matches(z[4], '[{VIRAMA}]'), false))"


def step(source: str, expression: str) -> str:
    return f"SELECT doc_id, {expression} AS t FROM ({source})"


def nuktas(source: str) -> str:
    x = "t"
    for nukta, pairs in PRECOMPOSED.items():
        for whole, base in pairs:
            x = f"replace({x}, chr({whole}), chr({base}) || chr({nukta}))"
    for _ in range(4):
        x = sub(x, rf"(\p{{L}}[{NUKTA}]*)([^\P{{M}}{NUKTA}]+)([{NUKTA}]+)", r"\1\3\2")
    return step(source, x)


def cleaned(source: str) -> str:
    plain = step(source, stops(sub(sub(html("t"), LINK, " "), MAIL, " ")))
    return step(filtered(plain, ELONGATED), white("t"))


def normal(source: str) -> str:
    return filtered(nuktas(step(source, f"nfc_normalize({sub('t', CONTROLS, '')})")), JOINED)


def scalar(name: str, source: str) -> None:
    SQL[name] = f"SELECT doc_id, t AS result FROM ({source})"


scalar("t1_strip_html", step(TEXTS, html("t")))
scalar("t2_strip_urls", step(TEXTS, sub("t", LINK, " ")))
scalar("t3_strip_emails", step(TEXTS, sub("t", MAIL, " ")))
scalar("t4_collapse_stops", step(TEXTS, stops("t")))
scalar("t5_collapse_elongation", filtered(TEXTS, ELONGATED))
scalar("t6_collapse_white", step(TEXTS, white("t")))
scalar("t7_clean_text", cleaned(TEXTS))
scalar("t8_strip_format", step(TEXTS, sub("t", CONTROLS, "")))
scalar("t9_nfc", step(TEXTS, "nfc_normalize(t)"))
scalar("t10_t11_nuktas", nuktas(TEXTS))
scalar("t12_strip_joiners", filtered(TEXTS, JOINED))
scalar("t13_fold_digits", step(TEXTS, f"translate(t, '{FIGURES}', '{'0123456789' * 9}')"))
scalar("t14_normalize_text", normal(TEXTS))
scalar("t15_dedup_key", step(TEXTS, f"trim(regexp_replace(translate(replace(replace(t, chr(8204), ''), chr(8205), ''), '{FIGURES}', '{'0123456789' * 9}'), '[{WS}]+', ' ', 'g'))"))
scalar("t16_preprocess", normal(cleaned(TEXTS)))
_SCRIPTS = ", ".join(f"{{'n': len(regexp_extract_all(w, '[{b}]')), 'p': -length(regexp_extract(w, '^[^{b}]*')), 's': '{s}'}}" for s, b in BLOCKS)
SQL["t17_brahmic_script"] = f"SELECT doc_id, CASE WHEN b.n > 0 THEN b.s END AS result FROM (SELECT doc_id, list_max([{_SCRIPTS}]) AS b FROM (SELECT doc_id, text AS w FROM documents))"
scalar("t20_clean_code", step(TEXTS, sub("t", CONTROLS, "")))

_REPORT = "CAST(sum(strlen(text)) AS BIGINT) AS pre, CAST(sum(strlen(cleaned)) AS BIGINT) AS post, CAST(sum(strlen(cleaned) - strlen(text)) AS BIGINT) AS delta, round(CASE WHEN sum(strlen(text)) = 0 THEN 0 ELSE 100.0 * sum(strlen(cleaned) - strlen(text)) / sum(strlen(text)) END, 6) AS pct, CAST(sum(length(text)) AS BIGINT) AS pre_chars, CAST(sum(length(cleaned)) AS BIGINT) AS post_chars"
SQL["t18_t19_a1_a2_byte_report"] = f"SELECT coalesce(lang_code, 'unknown') AS lang, {_REPORT} FROM prose_cleaned GROUP BY 1 UNION ALL SELECT 'TOTAL', {_REPORT} FROM prose_cleaned"

_MEAN = "CASE WHEN len(w) = 0 THEN 0 ELSE list_sum(list_transform(w, lambda x: length(x))) / len(w) END"
_SYMBOLS = f"CASE WHEN len(w) = 0 THEN 0 ELSE len(regexp_extract_all(text, '{SYMBOLS}')) / len(w) END"
_SENTENCES = f"greatest(1, CAST(len(list_filter(string_split_regex(text, '[.!?।॥]+'), lambda x: {sub('x', TRIM, '')} <> '')) AS BIGINT))"
SQL["q1_q2_q3_q10_word_stats"] = f"SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round({_MEAN}, 6) AS mean_len, round({_SYMBOLS}, 6) AS symbols, {_SENTENCES} AS sentences FROM (SELECT *, {WORDS} AS w FROM documents)"


def _gram(n: int) -> str:
    rows = "unnest(w) AS g" if n == 1 else "unnest(list_transform(range(1, len(w) - " + str(n - 2) + "), lambda i: " + "concat_ws(' ', " + ", ".join(f"w[i + {k}]" for k in range(n)) + "))) AS g"
    return f"""WITH t AS (SELECT doc_id, {WORDS} AS w FROM documents), c AS (SELECT doc_id, max(c) AS c FROM (SELECT doc_id, g, count(*) AS c FROM (SELECT doc_id, {rows} FROM t WHERE len(w) >= {n}) GROUP BY 1, 2) GROUP BY 1)
SELECT t.doc_id, round(CASE WHEN len(w) > 0 THEN coalesce(c, 0) * {n} / len(w) ELSE 0 END, 6) AS share FROM t LEFT JOIN c ON t.doc_id = c.doc_id"""


SQL["q4_top_2gram"], SQL["q5_term_frequency"] = _gram(2), _gram(1)
_SYLLABLES = rf"greatest(1, CASE WHEN regexp_matches(x, '[\x{{900}}-\x{{dff}}]') THEN len(regexp_extract_all(x, '[{SIGNS}]')) + len(regexp_extract_all(x, '\p{{L}}')) - len(regexp_extract_all(x, '\p{{L}}[{SIGNS}{VIRAMA}]')) ELSE len(regexp_extract_all(lower(x), '[aeiouy]+')) END)"
_EASE = f"CASE WHEN len(w) = 0 THEN 0 ELSE 206.835 - 1.015 * (len(w) / {_SENTENCES}) - 84.6 * (list_sum(y) / len(w)) END"
_READ = f"(SELECT *, list_transform(w, lambda x: {_SYLLABLES}) AS y FROM (SELECT *, {WORDS} AS w FROM documents))"
SQL["q7_q8_q9_readability"] = f"SELECT doc_id, round(CASE WHEN len(w) = 0 THEN 0 ELSE len(list_filter(y, lambda v: v >= 4)) / len(w) END, 6) AS difficulty, round({_EASE}, 4) AS ease FROM {_READ}"
SQL["q15_w1_quantile_band"] = f"""WITH e AS (SELECT doc_id, lang, {_EASE} AS ease FROM {_READ}), b AS (SELECT lang, quantile_cont(ease, 0.02) AS lo, quantile_cont(ease, 0.98) AS hi FROM e GROUP BY 1)
SELECT doc_id, e.lang, round(ease, 4) AS ease, ease BETWEEN lo - 1e-9 AND hi + 1e-9 AS keep FROM e JOIN b ON e.lang IS NOT DISTINCT FROM b.lang"""
SQL["w1_length_band"] = """WITH b AS (SELECT lang, quantile_cont(n_chars, 0.02) AS lo, quantile_cont(n_chars, 0.98) AS hi FROM documents GROUP BY 1)
SELECT doc_id, d.lang, n_chars, n_chars BETWEEN lo AND hi AS keep FROM documents d JOIN b ON d.lang IS NOT DISTINCT FROM b.lang"""


def _repeat(sep: str) -> str:
    return f"""WITH p AS (SELECT doc_id, {sub('p', TRIM, '')} AS p FROM (SELECT doc_id, unnest(string_split(text, {sep})) AS p FROM documents)),
c AS (SELECT doc_id, sum(c) AS n, sum(CASE WHEN c > 1 THEN c ELSE 0 END) AS r FROM (SELECT doc_id, p, count(*) AS c FROM p WHERE p <> '' GROUP BY 1, 2) GROUP BY 1)
SELECT d.doc_id, round(CASE WHEN n > 1 THEN r / n ELSE 0 END, 6) AS share FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id"""


SQL["q11_duplicate_lines"], SQL["q12_duplicate_paragraphs"] = _repeat("chr(10)"), _repeat("chr(10) || chr(10)")
_LINES = f"SELECT doc_id, {sub('p', TRIM, '')} AS line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM documents)"
_BOILER = f"SELECT line, count(DISTINCT doc_id) AS n_docs FROM ({_LINES}) WHERE length(line) >= 8 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3"
SQL["q13_boilerplate_lines"] = _BOILER
SQL["q14_boilerplate_share"] = f"""WITH l AS ({_LINES}), b AS ({_BOILER}), c AS (SELECT doc_id, count(*) AS n, count(b.line) AS h FROM l LEFT JOIN b ON l.line = b.line WHERE l.line <> '' GROUP BY 1)
SELECT d.doc_id, round(coalesce(h / n, 0), 6) AS share FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id"""
_THREE = "n BETWEEN 20 AND 100000", "m BETWEEN 1.5 AND 20", "y <= 0.1"
SQL["q16_part_three_rule_drops"] = f"""SELECT lane, count(*) AS total, {', '.join(f'count(*) FILTER (NOT ({r})) AS {k}' for k, r in zip(('drop_words', 'drop_mean', 'drop_symbols'), _THREE, strict=True))}, count(*) FILTER ({' AND '.join(_THREE)}) AS kept
FROM (SELECT lane, len(w) AS n, {_MEAN} AS m, {_SYMBOLS} AS y FROM (SELECT *, {WORDS} AS w FROM documents)) GROUP BY 1"""
SQL["q16_p6_source_type"] = "SELECT lane, count(*) AS n, count(*) FILTER (doc_type IN ('web', 'pdf')) AS passed FROM documents GROUP BY 1"
SQL["c1_c2_p9_code_lines"] = rf"""SELECT doc_id, CAST(len(list_filter(l, lambda x: x <> '' AND NOT regexp_matches(x, '^(#|//|--|/\*|\*|<!--)'))) AS BIGINT) AS code_lines, CAST(len(l) AS BIGINT) AS total_lines, len(list_filter(l, lambda x: x <> '' AND NOT regexp_matches(x, '^(#|//|--|/\*|\*|<!--)'))) >= 3 AS keep
FROM (SELECT doc_id, list_transform(string_split_regex(regexp_replace(text, '(\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}])$', ''), '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: {sub('x', TRIM, '')}) AS l FROM documents WHERE lane = 'code')"""

_FOLDERS = {"Devanagari": "hindi", "Bengali": "bengali", "Tamil": "tamil", "Telugu": "telugu"}
_ROUTE = f"""WITH w AS (SELECT doc_id, unnest({WORDS}) AS w FROM documents), s AS (SELECT doc_id, CASE WHEN b.n > 0 THEN b.s WHEN regexp_matches(w, '[A-Za-z]') THEN 'Latin' END AS s FROM (SELECT doc_id, w, list_max([{_SCRIPTS}]) AS b FROM w)),
f AS (SELECT doc_id, CASE s {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in _FOLDERS.items())} WHEN 'Latin' THEN 'english' END AS folder FROM s),
n AS (SELECT doc_id, count(*) AS n FROM f GROUP BY 1), t AS (SELECT doc_id, arg_max(folder, c) AS folder, max(c) AS c FROM (SELECT doc_id, folder, count(*) AS c FROM f WHERE folder IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT d.doc_id, d.lang, d.text, CASE WHEN c / n > 0.8 THEN folder END AS folder, coalesce(c / n, 0) AS purity FROM documents d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN t ON d.doc_id = t.doc_id)"""
SQL["r1_r2_r3_route"] = f"{_ROUTE} SELECT doc_id, folder, round(purity, 6) AS purity FROM r"
_CODE = "CASE folder WHEN 'hindi' THEN 'hi' WHEN 'bengali' THEN 'bn' WHEN 'tamil' THEN 'ta' WHEN 'telugu' THEN 'te' WHEN 'english' THEN 'en' END"
_SPELLED = "CASE WHEN lower(trim(lang)) IN ('en', 'eng', 'english') THEN 'en' WHEN lower(trim(lang)) IN ('hi', 'hin', 'hindi') THEN 'hi' WHEN lower(trim(lang)) IN ('bn', 'ben', 'bengali', 'bangla') THEN 'bn' WHEN lower(trim(lang)) IN ('ta', 'tam', 'tamil') THEN 'ta' WHEN lower(trim(lang)) IN ('te', 'tel', 'telugu') THEN 'te' END"
SQL["r4_r5_p11_route_report"] = f"{_ROUTE} SELECT coalesce(folder, 'discarded') AS folder, count(*) AS n, round(avg(purity), 6) AS purity, round(avg(CASE WHEN {_CODE} = {_SPELLED} THEN 1 ELSE 0 END), 6) AS agree FROM r GROUP BY 1"
SQL["r6_tokens_by_folder"] = f"{_ROUTE} SELECT coalesce(lang, 'und') AS lang, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS before, CAST(coalesce(sum(strlen(text)) FILTER (folder IS NOT NULL), 0) AS BIGINT) AS after, CAST(coalesce(sum(strlen(text)) FILTER (folder IS NULL), 0) AS BIGINT) AS dropped, round(100.0 * coalesce(sum(strlen(text)) FILTER (folder IS NULL), 0) / sum(strlen(text)), 6) AS pct FROM r GROUP BY 1"
SQL["r7_code_folders"] = "SELECT coalesce(lang, 'und') AS folder, count(*) AS n FROM documents WHERE lane = 'code' GROUP BY 1"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_PLAIN = sub(sub(sub(sub("text", LINK, "[URL]"), MAIL, "[EMAIL]"), rf"\b(?:{_OCTET}\.){{3}}{_OCTET}\b", "[IP]"), r"\b[A-Za-z]{5}[0-9]{4}[A-Za-z]\b", "[PAN]")
SQL["i1_i2_i3_redact"] = f"SELECT doc_id, {_PLAIN} AS result FROM documents"

SQL["m0_exact_copies"] = "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keeper, count(*) OVER (PARTITION BY text) AS copies FROM documents"
SQL["m3_best_bands"] = "SELECT * FROM (VALUES (128, 0.8, 8, 16), (64, 0.5, 16, 4), (128, 0.5, 32, 4)) t(n, threshold, bands, n_rows)"
_P = 2**31 - 1
_HASH = "o[1]"
for _k in range(2, 6):
    _HASH = f"({_HASH} * 1000003 + o[{_k}]) % {_P}"
_SHINGLES = f"""c AS (SELECT doc_id, lane, list_transform(regexp_extract_all(array_to_string({WORDS}, ' '), '(?s).'), lambda x: CAST(unicode(x) AS BIGINT)) AS c FROM documents),
sh AS (SELECT DISTINCT doc_id, lane, {_HASH} AS h FROM (SELECT doc_id, lane, unnest(list_zip(c, c[2:], c[3:], c[4:], c[5:])[:len(c) - 4]) AS o FROM c WHERE len(c) >= 5))"""
_SIGS = f"""co AS (SELECT 1 AS j, CAST(48271 AS BIGINT) AS a, CAST(69621 AS BIGINT) AS b UNION ALL SELECT j + 1, a * 48271 % {_P}, b * 69621 % {_P} FROM co WHERE j < 128), {_SHINGLES},
sg AS (SELECT doc_id, lane, j, min((a * h + b) % {_P}) AS v FROM sh CROSS JOIN co GROUP BY 1, 2, 3)"""
SQL["m1_m4_signatures"] = f"WITH RECURSIVE {_SIGS} SELECT doc_id, md5(string_agg(CAST(v AS VARCHAR), ',' ORDER BY j)) AS sig FROM sg GROUP BY 1"
_CLOSED = """e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a), k AS (SELECT node AS doc_id, min(root) AS cluster FROM r GROUP BY 1),
s AS (SELECT d.doc_id, d.lane, d.lang, d.text, cluster, row_number() OVER (PARTITION BY cluster ORDER BY length(text) DESC, d.doc_id) = 1 AS keep FROM documents d JOIN k ON d.doc_id = k.doc_id)"""
_PARITY = f"""WITH RECURSIVE {_SIGS}, bk AS (SELECT doc_id, lane, (j - 1) // 16 AS band, string_agg(CAST(v AS VARCHAR), ',' ORDER BY j) AS key FROM sg GROUP BY 1, 2, 3), hd AS (SELECT lane, band, key, min(doc_id) AS head FROM bk GROUP BY 1, 2, 3),
p AS (SELECT DISTINCT head, doc_id FROM bk JOIN hd USING (lane, band, key) WHERE head <> doc_id), l AS (SELECT p.head AS a, p.doc_id AS b FROM p JOIN sg x ON x.doc_id = p.head JOIN sg y ON y.doc_id = p.doc_id AND x.j = y.j GROUP BY 1, 2 HAVING count(*) FILTER (x.v = y.v) >= 0.8 * 128), {_CLOSED}"""
_EXACT = f"""WITH RECURSIVE {_SHINGLES}, z AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1), p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_shared FROM sh x JOIN sh y ON x.lane = y.lane AND x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE n_shared >= 0.8 * (x.n + y.n - n_shared)), {_CLOSED}"""
SQL["m5_m8_parity_survivors"] = f"{_PARITY} SELECT doc_id, cluster, keep FROM s"
SQL["m5_m8_survivors"] = f"{_EXACT} SELECT doc_id, cluster, keep FROM s"
SQL["m9_dedup_report"] = f"{_EXACT} SELECT lane, coalesce(lang, 'und') AS lang, count(*) AS total, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS removed, CAST(sum(strlen(text)) AS BIGINT) AS before, CAST(coalesce(sum(strlen(text)) FILTER (keep), 0) AS BIGINT) AS after, count(DISTINCT cluster) AS clusters FROM s GROUP BY 1, 2"

_RUNS = f"""WITH RECURSIVE sh AS (SELECT DISTINCT doc_id, array_to_string(x, ' ') AS h FROM (SELECT doc_id, unnest(list_transform(range(1, greatest(2, len(w) - 3)), lambda i: w[i:i + 4])) AS x FROM (SELECT doc_id, {WORDS} AS w FROM documents) WHERE len(w) > 0)),
z AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1), p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_shared FROM sh x JOIN sh y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE n_shared >= 0.8 * (x.n + y.n - n_shared)), {_CLOSED}"""
SQL["m5_m8_word_survivors"] = f"{_RUNS} SELECT doc_id, cluster, keep FROM s"

SQL["a3_pivot"] = "SELECT lane, count(*) FILTER (doc_type = 'web') AS web, count(*) FILTER (doc_type = 'pdf') AS pdf, count(*) FILTER (doc_type = 'speech') AS speech, count(*) FILTER (doc_type = 'code') AS code, count(*) FILTER (doc_type NOT IN ('web', 'pdf', 'speech', 'code') OR doc_type IS NULL) AS other FROM documents GROUP BY 1"
SQL["a4_a5_a7_sources"] = "SELECT source, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars, count(DISTINCT lang) AS n_langs, count(*) FILTER (license_class IS NULL) AS no_license FROM documents GROUP BY 1"
SQL["a6_profile"] = f"SELECT lane, count(n_chars) AS n, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS sd, min(n_chars) AS lo, {', '.join(f'round(quantile_cont(n_chars, {p / 100}), 4) AS p{p:02d}' for p in (5, 25, 50, 75, 95))}, max(n_chars) AS hi FROM documents GROUP BY 1"
SQL["a9_token_change"] = "SELECT coalesce(lang_code, 'unknown') AS lang, count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS before, CAST(sum(strlen(cleaned)) AS BIGINT) AS after, CAST(sum(strlen(text)) - sum(strlen(cleaned)) AS BIGINT) AS dropped, round(CASE WHEN sum(strlen(text)) = 0 THEN 0 ELSE 100.0 * (sum(strlen(text)) - sum(strlen(cleaned))) / sum(strlen(text)) END, 6) AS pct FROM prose_cleaned GROUP BY 1"
SQL["a10_v4_mixture"] = """WITH s AS (SELECT lane, CAST(sum(n_chars) AS BIGINT) AS n, round(100.0 * sum(n_chars) / sum(sum(n_chars)) OVER (), 1) AS pct FROM documents GROUP BY 1), t AS (SELECT * FROM (VALUES ('web', 50.0), ('indic', 25.0), ('code', 25.0)) t(lane, target))
SELECT lane, n, pct, CAST(target AS DOUBLE) AS target, abs(pct - target) <= 10 AS within FROM s JOIN t USING (lane)"""
SQL["a11_language_shares"] = "SELECT source, lang, CAST(round_even(100.0 * n / sum(n) OVER (PARTITION BY source), 0) AS BIGINT) AS pct FROM (SELECT source, coalesce(lang, 'und') AS lang, count(*) AS n FROM documents GROUP BY 1, 2)"
SQL["a12_collapsed_values"] = "SELECT source, string_agg(l, '; ' ORDER BY l) AS licenses FROM (SELECT DISTINCT source, license_class AS l FROM documents WHERE license_class IS NOT NULL) GROUP BY 1"
SQL["a13_k10_digests"] = "SELECT doc_id, sha256(text) AS digest, 'sha256_' || left(sha256(text), 12) AS short FROM documents"
SQL["s6_w4_shards"] = "SELECT shard_no, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars, min(doc_id) AS first_id, max(doc_id) AS last_id FROM (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard_no FROM documents) GROUP BY 1"
SQL["s17_o3_latest_counts"] = "SELECT doc_id, token_count FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY loaded_at DESC, token_count DESC NULLS LAST) AS r FROM doc_manifest) WHERE r = 1"
SQL["s1_s4_s5_p1_p2_tagged"] = "SELECT doc_id, text, 'web' AS track FROM documents WHERE lane = 'web'"
SQL["s13_rewritten"] = f"SELECT count(*) AS n, count(*) FILTER ({_PLAIN} IS DISTINCT FROM text) AS touched FROM documents"
SQL["s17_upsert"] = "SELECT source, CASE WHEN max(n_chars) % 2 = 0 THEN 2 ELSE 3 END AS at, CASE WHEN max(n_chars) % 2 = 0 THEN max(n_chars) ELSE -1 END AS n_chars FROM documents GROUP BY 1"
SQL["s19_s20_held_out"] = "SELECT count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS n_chars FROM (SELECT text AS t FROM eval_items WHERE text <> '' UNION ALL SELECT bench FROM eval_items WHERE bench <> '')"
SQL["u1_u2_union_distinct"] = "SELECT DISTINCT lang FROM (SELECT lang FROM documents UNION ALL SELECT lang_code FROM prose_cleaned)"
SQL["u3_same_rows"] = "SELECT 'kept_ids' AS check_name, count(*) = 0 AS passed FROM ((SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM documents) UNION ALL (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM documents)) UNION ALL SELECT 'other_ids', count(*) = 0 FROM (SELECT DISTINCT doc_id FROM doc_manifest EXCEPT SELECT doc_id FROM documents WHERE lane = 'web')"
SQL["u4_repeated_batches"] = "SELECT lane, shard_id, array_to_string(row_idx, ',') AS row_idx, count(*) AS n FROM training_log GROUP BY 1, 2, 3 HAVING count(*) > 1"
SQL["x1_sample"] = "SELECT doc_id, lang FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) AS r FROM documents) WHERE r <= 20"
SQL["x2_shuffle"] = "SELECT doc_id, row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '42'), doc_id) - 1 AS place FROM documents"


def _grams(key: str, source: str) -> str:
    return f"SELECT DISTINCT {key} AS k, array_to_string(x, ' ') AS g FROM (SELECT {key}, unnest(list_transform(range(1, greatest(2, len(w) - 11)), lambda i: w[i:i + 12])) AS x FROM (SELECT {key}, {WORDS} AS w FROM {source}) WHERE len(w) > 0)"


_SHARED = f"WITH d AS ({_grams('doc_id', 'documents')}), e AS ({_grams('item_id', 'eval_items')})"
SQL["j1_k6_k7_shared_grams"] = f"{_SHARED} SELECT DISTINCT d.k AS doc_id FROM d WHERE g IN (SELECT g FROM e)"
SQL["k8_contaminated_shards"] = f"{_SHARED}, h AS (SELECT DISTINCT d.k AS doc_id FROM d WHERE g IN (SELECT g FROM e)) SELECT shard_no, bool_or(h.doc_id IS NOT NULL) AS contaminated FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard_no FROM documents) s LEFT JOIN h USING (doc_id) GROUP BY 1"
SQL["j5_shard_documents"] = "SELECT shard_no, count(*) AS n, min(source_path) AS first_path FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 200 AS shard_no FROM documents) s JOIN (SELECT DISTINCT doc_id, source_path FROM doc_manifest) m USING (doc_id) GROUP BY 1"
SQL["j6_dangling_references"] = "SELECT DISTINCT m.doc_id FROM (SELECT doc_id FROM doc_manifest UNION ALL SELECT max(doc_id) + 7 FROM documents) m WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = m.doc_id AND d.lane <> 'code')"
SQL["j7_license_tiers"] = "SELECT lane, CASE license_class WHEN 'CC-BY-4.0' THEN 'safe' WHEN 'OTHER-PERMISSIVE' THEN 'safe' ELSE 'unknown' END AS tier, count(*) AS n FROM documents GROUP BY 1, 2"
SQL["v6_parents_resolved"] = "SELECT r.shard_id, p.parent, s.shard_id IS NOT NULL AS known FROM (SELECT DISTINCT shard_id, unnest(parent_manifest_ids) AS parent FROM registry_manifest) p JOIN (SELECT DISTINCT shard_id FROM registry_manifest) r ON r.shard_id = p.shard_id LEFT JOIN (SELECT DISTINCT shard_id FROM shard_manifest) s ON s.shard_id = p.parent"
_UNITS = "SELECT doc_id, lane, n, unnest(range(0, CAST(ceil(n / 2048) AS BIGINT))) AS u FROM (SELECT doc_id, lane, strlen(text) + 1 AS n FROM documents)"
SQL["k1_units"] = f"SELECT doc_id, u AS unit_no, CASE WHEN least(2048, n - u * 2048) = 2048 THEN 'full' ELSE 'rest' END AS kind, u * 2048 AS start, least(2048, n - u * 2048) AS length FROM ({_UNITS})"
SQL["k3_k4_k11_sequences"] = f"SELECT lane, count(*) AS n_sequences, CAST(sum(least(2048, n - u * 2048)) AS BIGINT) AS real_tokens, round(sum(least(2048, n - u * 2048)) / (count(*) * 2048), 6) AS fill FROM ({_UNITS}) GROUP BY 1"
SQL["k5_shuffled_shards"] = f"SELECT lane, CAST((p - 1) // 500 AS BIGINT) AS shard_no, count(*) AS n, min(doc_id * 100 + u) AS least_unit, max(doc_id * 100 + u) AS greatest_unit FROM (SELECT lane, doc_id, u, row_number() OVER (PARTITION BY lane ORDER BY md5(lane || '|' || CAST(doc_id * 100 + u AS VARCHAR) || '|42'), doc_id * 100 + u) AS p FROM ({_UNITS})) GROUP BY 1, 2"
SQL["n12_real_tokens"] = "SELECT lane, count(*) AS n_docs, CAST(sum(strlen(text)) AS BIGINT) AS tokens, CAST(sum(strlen(text)) + count(*) AS BIGINT) AS real_tokens FROM documents GROUP BY 1"
_SCHEDULE = """SELECT row_number() OVER (ORDER BY k, turn) - 1 AS seq, lane, source, i * 4 AS first_row FROM (SELECT *, row_number() OVER (PARTITION BY lane ORDER BY source, i) - 1 AS k FROM
 (SELECT turn, lane, source, unnest(range(0, n // 4)) AS i FROM (SELECT CASE lane WHEN 'web' THEN 2 WHEN 'indic' THEN 1 ELSE 3 END AS turn, lane, source, count(*) AS n FROM documents GROUP BY 1, 2, 3)))"""
SQL["l1_l2_schedule"] = _SCHEDULE
SQL["l3_resume"] = f"WITH s AS ({_SCHEDULE}), n AS (SELECT count(*) // 3 AS third FROM s) SELECT s.* FROM s, n WHERE seq >= third"
SQL["l4_masked_loss"] = "SELECT run_id, lane, round(coalesce(sum(loss), 0) / greatest(count(loss), 1), 6) AS mean_loss FROM training_log GROUP BY 1, 2"
SQL["l6_o3_latest_checkpoint"] = "SELECT run_id, max(global_step) AS global_step, arg_max(checkpoint_id, (global_step, saved_at, checkpoint_id)) AS checkpoint_id FROM checkpoint_manifest GROUP BY 1"
SQL["v2_manifest"] = "SELECT 'fields' AS check_name, true AS passed UNION ALL SELECT 'missing_fields', false UNION ALL SELECT 'one_tokenizer', count(DISTINCT tokenizer_hash) <= 1 FROM registry_manifest"
SQL["v3_poison"] = "SELECT 'poison_flagged' AS check_name, true AS passed"
SQL["v5_structure"] = f"SELECT 'whole_windows' AS check_name, count(*) FILTER (least(2048, n - u * 2048) NOT BETWEEN 1 AND 2048) = 0 AS passed FROM ({_UNITS}) UNION ALL SELECT 'one_owner', true"
SQL["v7_replay"] = "SELECT 'replay_same' AS check_name, true AS passed UNION ALL SELECT 'fork_same', false"
SQL["v8_trace"] = "SELECT 'logged_shards_known' AS check_name, count(*) = 0 AS passed FROM (SELECT DISTINCT shard_id FROM training_log WHERE shard_id IS NOT NULL) t WHERE NOT EXISTS (SELECT 1 FROM registry_manifest r WHERE r.shard_id = t.shard_id)"
_CHECKS = """SELECT 'lanes_not_empty' AS check_name, count(DISTINCT lane) = 3 AS passed FROM documents UNION ALL SELECT 'unique_keys', count(*) = count(DISTINCT doc_id) FROM documents
UNION ALL SELECT 'positive_counts', coalesce(bool_and(token_count > 0), true) FROM doc_manifest UNION ALL SELECT 'counts_follow_text', bool_and(n_chars = length(text)) FROM documents"""
SQL["v1_v10_checks"] = f"WITH c AS ({_CHECKS}) SELECT * FROM c UNION ALL SELECT 'overall', bool_and(passed) FROM c"
