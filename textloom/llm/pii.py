"""Personal data in free text: offset-preserving deobfuscation, detection, typed placeholders.

Transducers rewrite a batch of texts one code point at a time or by contractions that keep an index
back to the source: compatibility forms, look-alike letters and native digits become plain ones,
invisible characters go, character references become their characters, and disguised ``at`` and ``dot``
and spelled digits become signs and figures. Identifiers are detected in the rewritten string and their
spans are mapped back to source characters, so the rest of the text stays as it was.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.kernels import codes_of, join_texts

LABELS = ("EMAIL", "PHONE", "ID_NUMBER", "ADDRESS", "NAME")
CHUNK_CHARS = 1_000_000
DROP = np.uint32(0xFFFFFFFF)

# Cyrillic and Greek letters that look like Latin ones, small and capital.
LOOKALIKES = dict(zip("аеорсухіјѕԁһАВЕКМНОРСТУХІЈЅοαρνΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhABEKMHOPCTYXIJSoapvABEZHIKMNOPTYX", strict=True))
# Character references met in markup.
REFERENCES = {"&nbsp;": " ", "&#160;": " ", "&#64;": "@", "&commat;": "@", "&#46;": ".", "&period;": ".", "&amp;": "&", "&lt;": "<", "&gt;": ">", "&#43;": "+", "&plus;": "+", "&quot;": '"'}
# Digits in words.
SPELLED = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
# Endings that name files, not mail domains.
FILES = {"png", "jpg", "jpeg", "gif", "svg", "webp", "pdf", "css", "js", "ico", "bmp", "txt", "html", "json", "zip"}
# Words that end the name of a street, in the corpus languages.
STREETS = (
    "road rd street st lane ln gali marg cross main avenue ave path chowk colony nagar layout "
    "सड़क सड़क गली मार्ग रोड रास्ता मोहल्ला कॉलोनी নগর রোড লেন রাস্তা সড়ক সড়ক গলি সরণি தெரு சாலை வீதி సందు వీధి రోడ్డు రోడ్ మార్గం"
).split()
# Titles before a person's name.
TITLES = "mr mrs ms dr prof shri smt sri श्री श्रीमती डॉ डॉ. श्रीमान কুমারী শ্রী শ্রীমতী ডাঃ ড திரு திருமதி டாக்டர் శ్రీ శ్రీమతి డాక్టర్".split()

_LUT: np.ndarray | None = None


def _lut() -> np.ndarray:
    global _LUT
    if _LUT is None:
        lut = np.arange(0x110000, dtype=np.uint32)
        for i in range(0x80, 0x20000):
            c = chr(i)
            cat = unicodedata.category(c)
            digit = unicodedata.decimal(c, None)
            if digit is not None:
                lut[i] = 48 + digit
            elif cat == "Zs":
                lut[i] = 32
            elif cat == "Pd":
                lut[i] = 45
            elif cat == "Cf" or 0xFE00 <= i <= 0xFE0F:
                lut[i] = DROP
            elif 0xFF01 <= i <= 0xFF5E:
                lut[i] = i - 0xFEE0
            elif i >= 0x1D400 and len(unicodedata.normalize("NFKC", c)) == 1:
                lut[i] = ord(unicodedata.normalize("NFKC", c))
        for a, b in LOOKALIKES.items():
            lut[ord(a)] = ord(b)
        _LUT = lut
    return _LUT


_REFERENCE = re.compile("|".join(map(re.escape, REFERENCES)))
_AT = re.compile(r"[ ]?[(\[{<][ ]?at[ ]?[)\]}>][ ]?|(?<=[A-Za-z0-9]) @ (?=[A-Za-z0-9])| at (?=[a-z0-9-]+(?: dot [a-z]+)+\b)", re.I)
_DOT = re.compile(r"[ ]?[(\[{<][ ]?dot[ ]?[)\]}>][ ]?|(?<=[A-Za-z0-9]) dot (?=[A-Za-z])", re.I)
_DIGIT_WORDS = re.compile(r"\b(?:(?:" + "|".join(SPELLED) + r")[ ,-]{1,2}){6,}(?:" + "|".join(SPELLED) + r")\b", re.I)
_WORD = re.compile(r"[a-z]+", re.I)

DOMAIN = re.compile(r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+([A-Za-z]{2,24})(?![A-Za-z0-9])")
PHONE = re.compile(
    r"(?<![\w.,/+-])(?:"
    r"(?:\+|00)\d{1,3}[ .-]?\(?\d{2,5}\)?(?:[ .-]?\d{3,6}){1,3}"
    r"|\(\d{3,5}\)[ .-]?\d{3}[ .-]\d{3,4}"
    r"|\d{3}([.-])\d{3}\1\d{4}"
    r"|0\d{2,4}-\d{6,8}"
    r"|0?[6-9]\d{4}[ -]?\d{5}"
    r")(?![\w/]|[.,-]\d)(?! \d{3,})"
)
NUMBER = re.compile(r"(?<![\w.,/+-])\d{4}([ -]?)\d{4}\1\d{4}(?:\1\d{3,4}|\1\d{4}\1\d{1,3})?(?![\w/]|[.,-]\d)(?! \d)|(?<![\w.,/+-])\d{4}([ -])\d{6}\2\d{5}(?![\w-])")
TAX = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{5}[ -]?\d{4}[ -]?[A-Za-z](?![A-Za-z0-9])")
_STREET = "|".join(sorted(map(re.escape, STREETS), key=len, reverse=True))
_END = r"(?![A-Za-zऀ-෿])"
ADDRESS = re.compile(
    r"(?:\d{1,4}[A-Za-z]?(?:[/-]\d{1,4}[A-Za-z]?)?,?[ \n]{1,3}(?:(?:\d{1,4}|[^\W\d_][^\s.।,;|:=]{0,24}),?[ \n]{1,3}){0,4}?(?:" + _STREET + r")" + _END
    + r"|\d{1,4}[A-Za-z]?,?[ \n]{1,3}(?:sector|block|phase|ward) {1,3}\d{1,3})"
    + r"(?:[ ]?,[ \n]{0,3}|[ ]?\n[ ]?)[^\W\d_][^\s.।,;|:=\d]{2,30}(?:[ ]{0,3}[-,]?[ ]{0,3}\d{3}[ ]?\d{3}(?!\d))?",
    re.I,
)
_BEFORE = re.compile(r"(?:(?:flat|plot|house|door|apt|no|h)\b\.?[ ]?(?:no\.?[ ]?)?|मकान नं\.?[ ]?|फ़?्?लैट[ ]?|प्लॉट[ ]?|বাড়ি নং[ ]?|বাড়ি নং[ ]?|ফ্ল্যাট[ ]?|எண்[ ]?|ఇంటి నం\.?[ ]?)$", re.I)

# The published Verhoeff tables, by their rule (the dihedral group of order ten).
_D5 = [[(a + b) % 5 if a < 5 and b < 5 else 5 + (a + b) % 5 if a < 5 else 5 + (a - b) % 5 if b < 5 else (a - b) % 5 for b in range(10)] for a in range(10)]
_P1 = [1, 5, 7, 6, 2, 8, 3, 0, 9, 4]
_PERM = [list(range(10))]
for _ in range(7):
    _PERM.append([_PERM[-1][_P1[i]] for i in range(10)])


def verhoeff(digits: str) -> bool:
    check = 0
    for i, c in enumerate(reversed(digits)):
        check = _D5[check][_PERM[i % 8][int(c)]]
    return check == 0


def luhn(digits: str) -> bool:
    odd, even = [int(c) for c in digits[-1::-2]], [int(c) * 2 for c in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 if x > 9 else x for x in even)) % 10 == 0


_SYLLABLE = re.compile(r"[^\W\d_][\u0900-\u0903\u093c\u093e-\u094d\u0981-\u0983\u09bc\u09be-\u09cd\u0b82\u0bbe-\u0bcd\u0c00-\u0c03\u0c3e-\u0c4d]*")
#: A syllable counts as one that names are built of if the lexicon has it so often.
SEEN = 3
#: A stem or an ending taken from the lexicon must occur with so many different partners.
PARTNERS = 2


class Names:
    """A lexicon of given and family names, closed under its own stems and endings.

    The lexicon is known to be incomplete. Every form is cut in two at each place; stems with PARTNERS
    endings and endings with PARTNERS stems, of one language and kind, may combine to further forms.
    """

    def __init__(self, rows: list[tuple[str, str, str]]):
        self.kinds: dict[str, set[str]] = {}
        groups: dict[tuple, set[str]] = {}
        for form, lang, kind in rows:
            if form:
                self.kinds.setdefault(_plain(form), set()).add(kind or "given")
                groups.setdefault((lang, kind or "given"), set()).add(_plain(form))
        self.likely: dict[str, set[str]] = {w: set(k) for w, k in self.kinds.items()}
        for (_, kind), forms in groups.items():
            stems: dict[str, set[str]] = {}
            ends: dict[str, set[str]] = {}
            for w in forms:
                for i in range(3, len(w) - 1):
                    stems.setdefault(w[:i], set()).add(w[i:])
                    ends.setdefault(w[i:], set()).add(w[:i])
            good = [e for e, ss in ends.items() if len(ss) >= PARTNERS]
            for stem, es in stems.items():
                if len(es) >= PARTNERS:
                    for e in good:
                        self.likely.setdefault(stem + e, set()).add(kind)
        self.heads = {w[:3] for w in self.kinds}
        self.tails = {w[-2:] for w in self.kinds}
        self.lengths = {}
        for w in self.kinds:
            s = _script(w)
            lo, hi = self.lengths.get(s, (99, 0))
            self.lengths[s] = (min(lo, len(w)), max(hi, len(w)))
        self.forms = frozenset(self.likely)
        self.shapes = self._shapes(groups)
        self.titles = {_plain(t) for t in TITLES}

    @staticmethod
    def _shapes(groups: dict[tuple, set[str]]) -> list[re.Pattern]:
        """For each Indic script: a given and a family name, built of the syllables that the lexicon's
        names of that kind are built of, with as many syllables as they have."""
        parts: dict[tuple[int, str], str] = {}
        for (_, kind), forms in groups.items():
            for script in {_script(w) for w in forms if ord(w[0]) >= 0x900}:
                own = [w for w in forms if _script(w) == script]
                beats = [_SYLLABLE.findall(w) for w in own]
                seen = Counter(x for w in beats for x in w)
                if len(own) < 20:
                    continue
                marks = f"[{chr(script << 7)}-{chr((script << 7) + 4)}{chr((script << 7) + 0x3C)}-{chr((script << 7) + 0x57)}]"
                common = sorted((x for x, n in seen.items() if n >= SEEN), key=len, reverse=True)
                counts = [len(w) for w in beats]
                parts[script, kind] = f"(?:(?:{'|'.join(common)})(?!{marks})){{{max(2, min(counts))},{max(counts)}}}"
        out = []
        for script in {k[0] for k in parts}:
            if (script, "given") in parts and (script, "family") in parts:
                edge = f"[\\u{script << 7:04x}-\\u{(script << 7) + 0x63:04x}]"
                out.append(re.compile(f"(?<!{edge}){parts[script, 'given']} {parts[script, 'family']}(?!{edge})"))
        return out

    def looks(self, word: str) -> bool:
        if word in self.likely:
            return True
        lo, hi = self.lengths.get(_script(word), (99, 0))
        return lo <= len(word) <= hi and word[:3] in self.heads and word[-2:] in self.tails


def _script(word: str) -> int:
    return max(ord(c) >> 7 for c in word)


def _plain(text: str) -> str:
    codes = _lut()[codes_of(text)]
    return codes[codes != DROP].tobytes().decode("utf-32-le").lower()


class Rewritten:
    """The rewritten batch: ``text`` and, for each of its characters, where the source characters that it stands
    for begin (``index``) and end (``stop``)."""

    def __init__(self, texts: list[str | None]):
        big = join_texts(texts)
        codes = codes_of(big)
        ends = np.flatnonzero(codes == 0)
        self.starts = np.concatenate((np.zeros(1, np.int64), ends + 1))
        codes = _lut()[codes].copy()
        stop = np.arange(1, len(codes) + 1)
        if "&" in big:
            for m in _REFERENCE.finditer(big):
                codes[m.start()] = ord(REFERENCES[m[0]])
                codes[m.start() + 1 : m.end()] = DROP
                stop[m.start()] = m.end()
        keep = codes != DROP
        self.index, self.stop = np.flatnonzero(keep), stop[keep]
        self.text = codes[keep].tobytes().decode("utf-32-le", "replace")
        for pattern, sign in ((_AT, "@"), (_DOT, "."), (_DIGIT_WORDS, None)):
            self._contract(pattern, sign)

    def _contract(self, pattern: re.Pattern, sign: str | None) -> None:
        """Each match becomes one sign that stands for all of it, or a figure for each of its words."""
        hits = list(pattern.finditer(self.text))
        if not hits:
            return
        codes = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        keep = np.ones(len(codes), bool)
        for m in hits:
            parts = [(sign, m.start(), m.end())] if sign else [(SPELLED[w[0].lower()], w.start(), w.end()) for w in _WORD.finditer(self.text, m.start(), m.end())]
            keep[m.start() : m.end()] = False
            for new, a, b in parts:
                codes[a], keep[a] = ord(new), True
                self.stop[a] = self.stop[b - 1]
        self.index, self.stop = self.index[keep], self.stop[keep]
        self.text = codes[keep].tobytes().decode("utf-32-le", "replace")

    def source(self, start: int, end: int) -> tuple[int, int, int]:
        """(text number, start, end) in the source of a span of the rewritten string."""
        a, b = int(self.index[start]), int(self.stop[end - 1])
        doc = int(np.searchsorted(self.starts, a, "right")) - 1
        return doc, a - int(self.starts[doc]), b - int(self.starts[doc])


def _runs(codes: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place the beginning and the end of the run of allowed signs before it and from it on."""
    bad = ~allowed[np.minimum(codes, 127)] | (codes > 126)
    place = np.arange(len(codes))
    before = np.maximum.accumulate(np.where(bad, place, -1)) + 1
    after = np.minimum.accumulate(np.where(bad, place, len(codes))[::-1])[::-1]
    return before, after


_LOCAL, _DOMAIN = np.zeros(128, bool), np.zeros(128, bool)
for _c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
    _LOCAL[ord(_c)] = _DOMAIN[ord(_c)] = True
for _c in "._%+-":
    _LOCAL[ord(_c)] = True
for _c in ".-":
    _DOMAIN[ord(_c)] = True


def _addresses(text: str, codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Spans of mail addresses of any length: the signs around each ``@`` that addresses are written with."""
    at = np.flatnonzero(codes == 64)
    if not len(at):
        return
    before, after = _runs(codes, _LOCAL)[0], _runs(codes, _DOMAIN)[1]
    for i in at.tolist():
        if i == 0 or i + 1 >= len(codes):
            continue
        lo, hi = int(before[i - 1]), int(after[i + 1])
        while lo < i and not text[lo].isalnum():
            lo += 1
        if lo == i or not text[i - 1].isalnum():
            continue
        m = DOMAIN.match(text, i + 1, hi)
        if m and m[1].lower() not in FILES:
            yield lo, m.end()


def _segments(codes: np.ndarray, least: int, gap: int, margin: int) -> list[tuple[int, int]]:
    """Stretches around figures: at least ``least`` of them with at most ``gap`` other characters between."""
    at = np.flatnonzero((codes >= 48) & (codes <= 57))
    if not len(at):
        return []
    new = np.flatnonzero(np.diff(at) > gap + 1) + 1
    first, last = np.concatenate(([0], new)), np.concatenate((new, [len(at)])) - 1
    many = last - first + 1 >= least
    return [(max(0, a - margin), b + 1 + margin) for a, b in zip(at[first[many]].tolist(), at[last[many]].tolist(), strict=True)]


def detect(texts: list[str | None], names: Names) -> list[tuple[int, int, int, str]]:
    """(text number, start, end, label) in source characters; spans of different labels may not overlap,
    the label listed first wins, so figures inside a mail address are no phone number."""
    r = Rewritten(texts)
    text = r.text
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    spans: list[tuple[int, int, str]] = [(a, b, "EMAIL") for a, b in _addresses(text, codes)]
    taken = np.zeros(len(codes) + 1, bool)
    for a, b, _ in spans:
        taken[a:b] = True

    def add(a: int, b: int, label: str) -> None:
        if not taken[a:b].any():
            taken[a:b] = True
            spans.append((a, b, label))

    for a, b in _segments(codes, 4, 3, 14):
        for m in TAX.finditer(text, a, b):
            s = "".join(c for c in m[0] if c.isalnum())
            if s.isupper() or m[0].isalnum() and s.islower():
                add(m.start(), m.end(), "ID_NUMBER")
        for m in NUMBER.finditer(text, a, b):
            s = "".join(c for c in m[0] if c.isdigit())
            if len(s) == 12 and verhoeff(s) or 13 <= len(s) <= 19 and luhn(s):
                add(m.start(), m.end(), "ID_NUMBER")
            else:  # of the form of such a number, but with a wrong check digit: no telephone number either
                taken[m.start() : m.end()] = True
        for m in PHONE.finditer(text, a, b):
            n = sum(c.isdigit() for c in m[0])
            if 10 <= n <= 14:
                add(m.start(), m.end(), "PHONE")
    for a, b in _segments(codes, 1, 0, 0):
        if a and text[a - 1] in "0123456789/+":
            continue
        m = ADDRESS.match(text, a)
        if m:
            before = _BEFORE.search(text, max(0, a - 16), a)  # no match of that pattern is longer
            add(before.start() if before else a, m.end(), "ADDRESS")
    spans.extend(_names(text, codes, names, taken))
    return [(*r.source(a, b), label) for a, b, label in spans]


_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0900-\u0963\u0970-\u0dff\u0300-\u036f'’])*")
_LETTERS: np.ndarray | None = None


def _letters() -> np.ndarray:
    """1 for letters and marks, 0 for anything that parts words."""
    global _LETTERS
    if _LETTERS is None:
        flags = np.zeros(0x110000, bool)
        for i in range(0x3001):
            c = chr(i)
            flags[i] = c.isalpha() or (unicodedata.category(c)[0] == "M")
        _LETTERS = flags
    return _LETTERS


def _names(text: str, codes: np.ndarray, names: Names, taken: np.ndarray) -> list[tuple[int, int, str]]:
    """Name parts side by side: a given and a family name, real or likely, in this order or turned with a
    comma; a lexicon form beside a word that looks like a name; an initial or title and a family name."""
    words = np.where(_letters()[codes] | (codes == 0), codes, np.uint32(32)).tobytes().decode("utf-32-le", "replace").lower()
    out: list[tuple[int, int, str]] = []
    base = 0
    for doc in words.split("\0"):
        if not names.forms.isdisjoint(doc.split()):
            out.extend(_names_in(text, base, base + len(doc), names, taken))
        base += len(doc) + 1
    if (codes >= 0x900).any():
        for shape in names.shapes:
            for m in shape.finditer(text):
                if not taken[m.start() : m.end()].any():
                    taken[m.start() : m.end()] = True
                    out.append((m.start(), m.end(), "NAME"))
    return out


def _names_in(text: str, lo: int, hi: int, names: Names, taken: np.ndarray) -> Iterator[tuple[int, int, str]]:
    toks = [(m[0], m.start(), m.end()) for m in _TOKEN.finditer(text, lo, hi)]
    low = [t[0].lower() for t in toks]
    i = 0
    while i < len(toks):
        if low[i] not in names.likely:
            i += 1
            continue
        best = None
        for j in (i - 1, i - 2, i + 1, i + 2):
            if not 0 <= j < len(toks):
                continue
            a, b = (j, i) if j < i else (i, j)
            if b - a == 2 and not (len(low[a + 1]) == 1 and text[toks[a + 1][2] : toks[b][1]] == ". " and text[toks[a][2] : toks[a + 1][1]] == " "):
                continue
            gap = text[toks[a][2] : toks[b][1]] if b - a == 1 else " "
            other = toks[j][0]
            title = a > 0 and low[a - 1] in names.titles
            if b - a == 1 and j < i and len(other) == 1 and other.isupper() and gap == ". " and "family" in names.likely[low[i]]:
                best = (a, b)
                break
            if gap not in (" ", "  ", ", "):
                continue
            upper = toks[a][0][0].isupper() and toks[b][0][0].isupper() or ord(other[0]) > 0x900
            if not upper or len(other) < 3:
                continue
            first, second = names.likely.get(low[a], set()), names.likely.get(low[b], set())
            if gap == ", ":  # places and cells are listed with commas too: the order must be family, given
                if "family" in first and "given" in second:
                    best = (a, b)
                    break
                continue
            real = low[i] in names.kinds
            fits = "given" in first and "family" in second
            if fits or title or real and not (first and second) and names.looks(low[j]):
                best = (a, b)
                break
        if best:
            a, b = best
            if not taken[toks[a][1] : toks[b][2]].any():
                taken[toks[a][1] : toks[b][2]] = True
                yield toks[a][1], toks[b][2], "NAME"
            i = b + 1
        else:
            i += 1


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` with each span replaced by its label in brackets."""
    out, at = [], 0
    for a, b, label in sorted(spans):
        out += [text[at:a], f"[{label}]"]
        at = b
    return "".join([*out, text[at:]])


def _scanner(lexicon, rewrite: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names(lexicon.value)
        for batch in batches:
            ids, texts = batch.column("id").to_pylist(), batch.column("txt").to_pylist()
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and (to == at or size < CHUNK_CHARS):
                    size += len(texts[to] or "")
                    to += 1
                hits = detect(texts[at:to], names)
                if rewrite:
                    by: dict[int, list] = {}
                    for d, a, b, label in hits:
                        by.setdefault(d, []).append((a, b, label))
                    found = [sorted({s[2] for s in by.get(d, [])}) for d in range(to - at)]
                    new = [t if t is None or d not in by else redact(t.replace("\0", " "), by[d]) for d, t in enumerate(texts[at:to])]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at:to], pa.int64()), pa.array(new, pa.string()), pa.array(found, pa.list_(pa.string())), pa.array([len(by.get(d, [])) for d in range(to - at)], pa.int32())], names=["id", "txt", "labels", "spans"])
                else:
                    rows = sorted({(d, label) for d, _, _, label in hits})
                    yield pa.RecordBatch.from_arrays([pa.array([ids[at + d] for d, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.string())], names=["id", "label"])
                at = to

    return run


#: The lexicon is broadcast; one of more entries than this (some 30 MB) is refused rather than cut.
LEXICON_ROWS = 500_000


def _lexicon(lexicon: DataFrame):
    rows = lexicon.select("form", "lang", "name_kind").where("form is not null").limit(LEXICON_ROWS + 1).collect()
    if len(rows) > LEXICON_ROWS:
        raise ValueError(f"the name lexicon has more than {LEXICON_ROWS} entries")
    return lexicon.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])


def find_personal_data(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """(id, label): the types of personal data in each text; null and empty texts have none."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    return src.mapInArrow(_scanner(_lexicon(lexicon), False), "id long, label string")


def redact_personal_data(df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame) -> DataFrame:
    """(id, txt, labels, spans): every text with placeholders, null staying null, one row per input row."""
    src = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("txt"))
    return src.mapInArrow(_scanner(_lexicon(lexicon), True), "id long, txt string, labels array<string>, spans int")
