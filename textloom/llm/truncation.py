"""Texts that stop before their end: word trigrams inside texts against the same trigrams at ends, in SQL.

Words are set apart by white space, digits become ``#``, and omission marks that excerpts carry at the end are
taken off. The final trigram x y z of each text is looked up among all trigrams of all texts: it *goes on* where
its third word is followed by another one in the same line or is the beginning of a longer word (so words that
were cut are met too), and it *ends* where a line, a cell or a text stops. A text is cut if its final trigram
goes on often and almost never ends. Where x y z is too rare for a verdict, x, then y, then both give way to
their kind (sentence end S, clause end C, number #, capital W, other w); the last word always stays, at the
very last as its kind or, in code, as its shape. Lines of code, items, cells and labelled lines are each counted
apart from prose. Code whose last line is finished is judged by blocks instead of lines: it goes on where
another line follows.

"Often" and "almost never" are one test, an interval on the share of ends, so a verdict depends on how sure the
counts make it and on no count of its own; the more rows, the more specific the trigrams that decide.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from textloom.storage import materialize, scratch

#: A form decides "cut" if the share of ends is surely under SHARE, "complete" if it is surely above it; otherwise the
#: next form is asked. Sure are Z_CUT and Z_WHOLE standard deviations. Undecided texts count as complete.
SHARE, Z_CUT, Z_WHOLE = 0.04, 0.7, 1.65
#: Keys of final trigrams are broadcast to the scan up to this number (8 bytes each), joined by shuffle beyond it.
BROADCAST_KEYS = 1_000_000

# The marks that excerpts end with, as one pattern.
OMISSION = r"(\s*(\[\s*(\.\.\.|…)\s*\]|…|\.\.\.+|\(more\)?|\(contd\.?\)?|\x{fffd}))+\s*$"
# Runs of ASCII digits and of the Indic scripts' digits.
DIGITS = "[0-9०-९০-৯੦-੯૦-૯୦-୯௦-௯౦-౯೦-೯൦-൯]+"
# The same, asked only of signs between the first and the last of them.
DIGITS_FIRST = f"[0-9०-൯&&{DIGITS[:-1]}]+"
# Signs that may follow a stop, and signs that numbers are written with.
CLOSERS, FIGURES = "\")”'", "#.,%()-:/+"
# Words that part the items or cells of a line.
PARTERS = "'/', '|', ';', '•', '$'"
# Lines of other kinds than prose: an item's mark, cells or items set apart by signs, a label within the first words.
ITEM = r"^\s*([-*•▪–·>]|[(]?(#|[a-zA-Z]{1,4})[.)])\s"
CELLS, COMMAS = r"((\s[/|•:]\s|;|\||\S=\S).*){2}", r",\S.*,\S"
CELL_SIGNS = (";", "|", " / ", "=", " : ", "•")
# All signs that cleaning and kinds of lines but for commas look for: most texts hold none and are searched once.
SIGNS = r"[<&\r\t\x{a0};|/=:•]"
LABEL = r"^(\S+\s+){0,4}\S*:(\s|$)"


# The kind of a word by its last sign; a capital at the beginning (W) or nothing of note (w) otherwise.
LAST_SIGNS = {**dict.fromkeys(".।॥?!…", "S"), **dict.fromkeys(",;:", "C"), **dict.fromkeys("#%", "#"), **dict.fromkeys("\")”'", "Q"), "^": "^", "⏎": "^"}


def _quoted(sign: str) -> str:
    return "'" + sign.replace("'", "\\'") + "'"


def _kind(word: str, last: str) -> str:
    """The kind of a word that ends in the sign ``last``; most words end in none of the signs, which is asked first."""
    signs, kinds = _quoted("".join(LAST_SIGNS)), _quoted("".join(LAST_SIGNS.values()))
    return f"if({last} IN ({', '.join(map(_quoted, LAST_SIGNS))}), substring({kinds}, instr({signs}, {last}), 1), if({word} >= 'A' AND {word} < '[', 'W', 'w'))"


_STOPPED = f"right(rtrim({_quoted(CLOSERS)}, z), 1) IN ('.', '।', '॥', '?', '!', '…')"


# Letters, which are one ``a`` in the shape of a line of code.
LETTERS = r"[\p{L}\p{M}_]+"
# What the last word of an excerpt with omission marks ends in, looked for before the whole pattern is.
MARKED = r"(\]|…|\.\.\.|more\)?|contd\.?\)?|\x{fffd})$"


def _structs(keys: list[tuple[str, str]]) -> str:
    return "array(" + ", ".join(f"named_struct('p', {p}, 'w', {w})" for p, w in keys) + ")"


def _hashes(keys: list[tuple[str, str]]) -> str:
    return "array(" + ", ".join(p for p, _ in keys) + ")"


def _with_kinds(rows: str) -> str:
    """Trigrams x y z (``shape``: the shape of z in code) with the kinds kx, ky and s, the shape of z in code, else its kind.

    Kinds are compiled expressions of a word each: a function over a line's array of words would be interpreted.
    """
    tails = f"SELECT *, right(x, 1) AS lx, right(y, 1) AS ly, right(z, 1) AS lz FROM ({rows})"
    return f"SELECT *, {_kind('x', 'lx')} AS kx, {_kind('y', 'ly')} AS ky, if(reg = 'k', shape, {_kind('z', 'lz')}) AS s, xxhash64(y, reg) AS hy FROM ({tails})"


#: Hashes of the places a third word may stand in: under the first word or its kind, at the second word or its kind; for
#: code also at places for shapes. With the third word's first sign (c) or its shape or kind (s) they make the keys.
_PLACES = "xxhash64(1, x, hy) AS h1, xxhash64(2, kx, hy) AS h2, xxhash64(3, kx, hy, if(reg = 'k', left(s, 1), s)) AS h3, xxhash64(4, kx, ky, reg) AS h4, if(reg = 'k', xxhash64(5, kx, ky, left(s, 1)), 0) AS h5, shiftleft(cast(ascii(z) AS bigint), 40) AS c"
_PROSE = [("h1 ^ c", "z"), ("h2 ^ c", "z"), ("h3", "''"), ("h4 ^ c", "z")]
_CODE = [("h1 ^ c", "z"), ("h2 ^ c", "z"), ("h3", "s"), ("h4 ^ c", "z"), ("h5", "s")]
#: Keys of a trigram x y z (kinds kx, ky; s: the shape of z in code, else its kind) in the order they are asked.
_KEYS = f"if(reg = 'k', {_structs(_CODE)}, {_structs(_PROSE)})"
#: The same in two parts for the scan of all trigrams: hashes, and the word that goes with the hash at ``at``.
_KEY_HASHES = f"if(reg = 'k', {_hashes(_CODE)}, {_hashes(_PROSE)})"
_KEY_WORD = "CASE WHEN at = 2 THEN if(reg = 'k', s, '') WHEN at = 4 THEN s ELSE z END"
#: Keys of the end of a finished line of code, asked in this order.
_LINE = [("xxhash64(6, x, y, z)", "''"), ("xxhash64(7, kx, y, z)", "''"), ("xxhash64(8, kx, ky, z)", "''"), ("xxhash64(9, right(s, 1))", "''")]
_LINE_KEYS = _structs(_LINE)
#: The last trigram of a line.
_LAST = "element_at(w, -3) AS x, element_at(w, -2) AS y, element_at(w, -1) AS z"


def _bound(side: str, z: float) -> str:
    """Wilson's bound on the share of ends of a form f: the lower one (``-``) or the upper one (``+``)."""
    n, p = "(f.goes + f.ends)", "(f.ends / (f.goes + f.ends))"
    return f"(({p} + {z * z / 2} / {n} {side} {z} * sqrt({p} * (1 - {p}) / {n} + {z * z / 4} / ({n} * {n}))) / (1 + {z * z} / {n}))"


def last_trigrams(df: DataFrame, id_col: str, text_col: str, lane_col: str | None = None) -> DataFrame:
    """(id, content, stopped, forms): of every text, whether it ends with a sentence end, and for each form of its
    final trigram, in order, ``goes`` (places where it goes on, all rows) and ``ends`` (lines, cells and other
    texts that end so).

    Ends of texts are counted over distinct contents, so copies of one cut text do not vouch for each other. Null and
    blank texts have no row; texts under three words are padded.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:12]
    views: list[str] = []

    def view(name: str, rows: DataFrame) -> None:
        rows.createOrReplaceTempView(f"{name}_{tag}")
        views.append(f"{name}_{tag}")

    try:
        view("src", df.selectExpr(f"cast({id_col} AS bigint) AS id", f"{text_col} AS txt", (f"coalesce({lane_col} = 'code', false)" if lane_col else "false") + " AS code"))
        held = " OR ".join(f"contains(l, '{c}')" for c in CELL_SIGNS)
        # a tag or reference left open at the end is taken off: what stands before it is judged. Few texts hold any of the signs
        lines = spark.sql(
            rf"""
            WITH open AS (SELECT id, code, code AND endswith(rtrim(' \r\t', txt), '\n') AS lined, signs, txt, if(endswith(txt, ' ') OR endswith(txt, '\n') OR endswith(txt, '\r') OR endswith(txt, '\t'), rtrim(' \n\r\t', txt), txt) AS trimmed,
                         if(signs AND contains(txt, '<'), substring_index(txt, '<', -1), null) AS tag, if(signs AND contains(txt, '&'), substring_index(txt, '&', -1), null) AS reference
                     FROM (SELECT *, txt RLIKE r'{SIGNS}' AS signs FROM src_{tag} WHERE txt IS NOT NULL)),
            shut AS (SELECT id, code, lined, signs, CASE WHEN code THEN trimmed
                         WHEN instr(tag, '>') = 0 AND tag RLIKE '^[a-zA-Z/]' THEN rtrim(' \n\r\t', left(txt, length(txt) - length(tag) - 1))
                         WHEN reference RLIKE '^#?[a-zA-Z0-9]*$' THEN rtrim(' \n\r\t', left(txt, length(txt) - length(reference) - 1))
                         WHEN substring_index(trimmed, ' ', -1) RLIKE r'{MARKED}' THEN rtrim(' \n\r\t', regexp_replace(trimmed, r'{OMISSION}', '')) ELSE trimmed END AS txt FROM open),
            plain AS (SELECT id, code, lined, signs, xxhash64(txt) AS content, regexp_replace(if(signs AND (contains(txt, '\r') OR contains(txt, chr(160))), replace(replace(txt, '\r', ''), chr(160), ' '), txt), '{DIGITS_FIRST}', '#') AS txt FROM shut WHERE txt <> ''),
            parts AS (SELECT id, code, lined, signs, content, split(if(signs AND contains(txt, '\t'), replace(txt, '\t', ' | '), txt), '\n') AS ls FROM plain),
            lines AS (SELECT id, code, lined, signs, content, t.l, t.before, trim(t.after) = '' AS block, t.after IS NULL AS last
                      FROM parts LATERAL VIEW inline(arrays_zip(ls, concat(array('^'), slice(ls, 1, size(ls) - 1)), concat(slice(ls, 2, size(ls) - 1), array(cast(null AS string))))) t AS l, before, after)
            SELECT id, content, lined, last, coalesce(block, true) AS block, l, if(code, coalesce(element_at(split(trim(before), ' '), -1), '^'), '^') AS before,
                   CASE WHEN code THEN 'k' WHEN l RLIKE r'{ITEM}' THEN 'i' WHEN signs AND ({held}) AND l RLIKE r'{CELLS}' OR contains(l, ',') AND l RLIKE r'{COMMAS}' THEN 'c' WHEN signs AND contains(l, ':') AND l RLIKE r'{LABEL}' THEN 'h' ELSE 'p' END AS reg
            FROM lines WHERE trim(l) <> ''"""
        )
        view("lines", materialize(lines, "p8-lines"))  # cleaned lines: smaller than their words, which are cheap to part
        # words with two before a line's first, and in code their shapes
        words = spark.sql(f"SELECT *, concat(array(before, if(reg = 'k', '⏎', '^')), array_remove(split(l, ' '), '')) AS w FROM lines_{tag}")
        view("words", words)
        view("shaped", words.selectExpr("*", f"if(reg = 'k', concat(array('', ''), array_remove(split(regexp_replace(l, r'{LETTERS}', 'a'), ' '), '')), null) AS shapes"))
        ends = f"SELECT *, if(reg = 'k', regexp_replace(z, r'{LETTERS}', 'a'), null) AS shape FROM (SELECT id, content, lined, last, block, reg, {_LAST} FROM words_{tag})"
        last = spark.sql(
            f"""
            SELECT id, content, {_STOPPED} AND reg <> 'k' AS stopped, lined, reg = 'k' AS code, if(lined, {_LINE_KEYS}, {_KEYS}) AS forms
            FROM (SELECT *, {_PLACES} FROM ({_with_kinds(f"{ends} WHERE last")}))"""
        )
        view("last", materialize(last, "p8-last"))
        # the forms to be looked up, with the number of different contents that end so; words of prose may carry marks, code is met letter by letter
        wanted = spark.sql(
            f"SELECT f.p, f.w AS z, count(DISTINCT content) AS texts, max(lined) AS lined, max(code) AS code FROM (SELECT content, lined, code, explode(forms) AS f FROM last_{tag} WHERE NOT stopped) GROUP BY f.p, f.w"
        )
        view("wanted", materialize(wanted, "p8-wanted"))
        keys = materialize(spark.sql(f"SELECT DISTINCT p FROM wanted_{tag}"), "p8-keys")
        view("keys", keys)
        hint = "/*+ BROADCAST(k) */" if keys.count() <= BROADCAST_KEYS else ""
        trigrams = f"""SELECT reg, last, block, get(w, i) AS x, get(w, i + 1) AS y, get(w, i + 2) AS z, coalesce(get(w, i + 3), '$') AS n, get(shapes, i + 2) AS shape
                       FROM shaped_{tag} LATERAL VIEW explode(sequence(0, size(w) - 3)) t AS i"""
        whole = f"SELECT * FROM ({trigrams}) WHERE z NOT IN ({PARTERS}) AND NOT (last AND n = '$')"
        counted = spark.sql(
            f"""
            WITH places AS (SELECT reg, z, s, n IN ({PARTERS}) AS stop, n = '$' AS over, block, {_PLACES} FROM ({_with_kinds(whole)})),
            grams AS (SELECT t.p, {_KEY_WORD} AS w, stop, over, block FROM places LATERAL VIEW posexplode({_KEY_HASHES}) t AS at, p),
            line_ends AS (SELECT block, explode({_hashes(_LINE)}) AS p FROM ({_with_kinds(f"{ends} WHERE reg = 'k' AND NOT last")}))
            SELECT p, w, count_if(NOT stop) AS on, count_if(over AND NOT block) AS line, count_if(stop AND (block OR NOT over)) AS block
            FROM (SELECT {hint} g.* FROM grams g LEFT SEMI JOIN keys_{tag} k ON g.p = k.p) GROUP BY p, w
            UNION ALL
            SELECT {hint} e.p, '' AS w, 0 AS on, count_if(NOT block) AS line, count_if(block) AS block FROM line_ends e LEFT SEMI JOIN keys_{tag} k ON e.p = k.p GROUP BY e.p"""
        )
        view("counts", materialize(counted, "p8-counts"))
        # of a finished line, a further line goes on and a block ends. Otherwise a longer word goes on wherever it stands, the same word where another one follows
        longer = "if(k.code, c.w, rtrim(',;:.।॥?!…)”\"\\'', c.w)) <> k.z"
        found = spark.sql(
            f"""
            SELECT k.p, k.z, max(k.texts) AS texts,
                   coalesce(sum(CASE WHEN k.lined THEN c.line WHEN c.w = k.z THEN c.on WHEN {longer} THEN c.on + c.line + c.block ELSE 0 END), 0) AS goes,
                   coalesce(sum(CASE WHEN k.lined THEN c.block WHEN c.w = k.z THEN c.line + c.block ELSE 0 END), 0) AS ends
            FROM wanted_{tag} k LEFT JOIN counts_{tag} c ON k.p = c.p AND startswith(c.w, k.z) GROUP BY k.p, k.z"""
        )
        view("found", materialize(found, "p8-found"))
        return materialize(
            spark.sql(
                f"""
                SELECT l.id, l.content, l.stopped, array_sort(filter(collect_list(struct(l.form, c.goes, c.ends + c.texts - 1 AS ends)), f -> f.goes IS NOT NULL)) AS forms
                FROM (SELECT id, content, stopped, posexplode_outer(if(stopped, null, forms)) AS (form, f) FROM last_{tag}) l
                LEFT JOIN found_{tag} c ON l.f.p = c.p AND l.f.w = c.z GROUP BY l.id, l.content, l.stopped"""
            ),
            "p8-forms",
        )
    finally:
        for name in views:
            spark.catalog.dropTempView(name)


def cut_texts(df: DataFrame, id_col: str, text_col: str, lane_col: str | None = None) -> DataFrame:
    """(id, cut, forms): whether each text that is not null or blank stops before its end.

    A text that ends with a sentence end is complete. Otherwise the first form decides whose share of ends is surely
    under or surely above SHARE; a text no form decides on is complete. Ids of repeated rows with equal texts give
    one row.
    """
    with scratch() as tables:
        looked = tables.keep(last_trigrams(df, id_col, text_col, lane_col))
    judged = f"CASE WHEN {_bound('+', Z_CUT)} < {SHARE} THEN true WHEN {_bound('-', Z_WHOLE)} > {SHARE} THEN false END"
    sure = f"filter(transform(filter(forms, f -> f.goes + f.ends > 0), f -> {judged}), c -> c IS NOT NULL)"
    return looked.selectExpr("id", f"NOT stopped AND coalesce(get({sure}, 0), false) AS cut", "forms")
