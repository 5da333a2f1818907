"""Personal data in plain and in disguised spelling, with the places it has in the source text.

Plain identifiers are found by pattern. A text that shows signs of disguise also goes through transducers: characters that
look like ASCII ones, invisible characters, digits spelled as words, and at and dot in brackets or words, each by itself, are
rewritten, and every character of the result remembers the source range it came from. The same patterns then run on the rewritten text and their
spans are mapped back. Spans found plainly always stay; one found in disguise is added where it overlaps none of its kind.

Each text is handled by itself in one task, whole; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdcspark.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")

#: What gives the contract's leftmost matches in time linear in the text: digits are entered once per run, and addresses are
#: looked for from their sign (see ``_emails``).
_PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": re.compile(r"[0-9](?:[\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")

#: Letters of other scripts and the ASCII letters they look like.
LOOKALIKES = {
    "а": "a", "е": "e", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "ԛ": "q", "ԝ": "w", "А": "A", "В": "B", "Е": "E", "І": "I", "Ј": "J", "К": "K", "М": "M",
    "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "α": "a", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ɑ": "a", "ɡ": "g", "ı": "i", "․": ".", "。": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-",
    "−": "-",
}

#: Characters without width.
INVISIBLE = "­​‌‍⁠﻿"

#: Digits as words.
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}

_DIGIT = "(?:" + "|".join(sorted(DIGIT_WORDS, key=len, reverse=True)) + ")"
_BRACKETED_DOT = r"\s*[\[({<]\s*(?:dot|\.|punkt|point|punto)\s*[\])}>]\s*"
#: What stands between digits in words: gaps, and dots as words or in brackets.
_BETWEEN = rf"(?:{_BRACKETED_DOT}|[ ,.-]+(?:(?:dot|point)[ ,.-]+)?)"
#: At least four digits in words, with plus, dots and other digits between them.
_DIGIT_RUN = re.compile(rf"(?<!\w)(?:plus[ ,]+)?{_DIGIT}(?:{_BETWEEN}(?:{_DIGIT}|[0-9]+)){{3,}}(?!\w)", re.I)
_DIGIT_TOKEN = re.compile(
    rf"(?P<plus>plus[ ,]+)|(?P<dot>{_BRACKETED_DOT}|[ ,.-]+(?:dot|point)[ ,.-]+)|(?P<digit>{_DIGIT})|(?P<gap>[ ,.-]+)|(?P<rest>.)", re.I
)
#: Cheap signs of such a run: the start of a word of each language's digits that long numbers rarely lack.
_DIGIT_SIGNS = re.compile(rf"(?<!\w){_DIGIT}{_BETWEEN}(?:{_DIGIT}|[0-9]+)(?:[ ,.-]|{_BRACKETED_DOT})", re.I)
#: Without the white space before them, which is added by hand: long runs of it would be searched from each place.
_AT = re.compile(r"[\[({<]\s*(?:at|@)\s*[\])}>]\s*|(?<=\s)@\s+(?=[A-Za-z0-9-]+\s*(?:\.|[\[({<]|dot\b))", re.I)
_DOT = re.compile(_BRACKETED_DOT.removeprefix(r"\s*"), re.I)
_BARE_DOT = re.compile(r"(?<=\s)dot\s+", re.I)
#: A bare "at" before what may be a domain, however its dots are written.
_BARE_AT = re.compile(r"(?<=\s)at\s+(?=[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]|\s+dot\s|\s*[\[({<]))", re.I)
#: Numbers with dots of any spelling between them; the ip pattern judges them when they are rewritten.
_NUMBERS = re.compile(rf"(?<![0-9])[0-9]+(?:(?:{_BRACKETED_DOT}|\s+(?:dot|point)\s+|\.)[0-9]+){{3,}}", re.I)
_NUMBERS_DOT = re.compile(r"\s+(?:dot|point)\s+", re.I)
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: What an address with a dot or an at in bare words ends in, besides two letters; other words beside "dot" are left alone.
_ENDING = re.compile(
    "[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|online|site|shop|app|dev|cloud|mail|aero|asia|blog|cat|club|company|coop|"
    "digital|email|global|group|jobs|live|ltd|media|mobi|museum|network|news|pro|services|solutions|space|store|systems|tech|tel|"
    "travel|website|work|world|xyz|zone"
)
#: Words before "at" and a site's name in running text; so are those in -ing and -ed.
_BEFORE_AT = frozenset(
    "a about account again also am and anything are article articles as available back be been blog book books bought buy call check "
    "click code content copy data date day details directly document documents download else everything file files find first for "
    "free from full get go got had has have he held her here him his home house i image images in info information is issue it item "
    "items job join just kept laugh link list live lives located look looks made mail me meet meets met more myself news not now of on "
    "one online only or order orders out over page pages paper people photo photos play point post posts price prices project read "
    "register report reports run runs sale sat saw see seen sell sells service services shop shops she shown sign site sites smile "
    "sold someone something source spoke stand start stay stop store stories story study submit summary support team text that the "
    "them there they this tickets time today together up us version video videos visit was watch we website went were what when "
    "where which who will with work works yes you yourself".split()
)


def _folded() -> dict[str, str]:
    """Every character that stands for an ASCII one, and those to leave out."""
    table = {c: "" for c in INVISIBLE} | LOOKALIKES
    for code in range(0x80, 0x20000):
        c = chr(code)
        if c in table:
            continue
        plain = unicodedata.normalize("NFKC", c)
        if len(plain) == 1 and "\x20" <= plain < "\x7f":
            table[c] = plain
        elif unicodedata.decimal(c, None) is not None:
            table[c] = str(unicodedata.decimal(c))
    return table


FOLDED = _folded()


def _class(characters: list[str]) -> str:
    """A character class as ranges of neighbours."""
    codes, ranges = sorted(map(ord, characters)), []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b))}" for a, b in ranges) + "]"


_FOLDABLE = re.compile(_class(list(FOLDED)))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        parts = [x.lstrip("0") for x in found.split(".")]
        return all(len(x) <= 3 and int(x or "0") <= 255 for x in parts)
    digits = re.sub("[^0-9]", "", found)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start: each kind's leftmost matches that do not overlap, less those not valid."""
    spans = []
    for kind in KINDS:
        sign = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
        if sign and sign not in text:
            continue
        if kind == "email":
            spans += _emails(text)
        else:
            spans += [(kind, m.start(), m.end()) for m in _PATTERNS[kind].finditer(text) if _valid(kind, m[0])]
    return spans


def _emails(text: str) -> list[tuple[str, int, int]]:
    """Leftmost addresses: from each sign back over what may stand before it, to the end of the address before at most."""
    spans, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            end = m.end()
            spans.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    return spans


Edit = tuple[int, int, str]


def _edits(text: str) -> list[Edit]:
    """Ranges of ``text`` that words and brackets disguise, and what they stand for; they do not overlap."""
    low = text.lower()
    edits: list[Edit] = []
    has_at, has_dot = "@" in text or "at" in low, "dot" in low
    if has_at:
        edits += [(s, e, "@") for s, e in _ats(text)]
    # Dots are rewritten wherever they stand; the patterns judge what comes of it.
    dots = [(_left(text, m.start()), m.end()) for m in _DOT.finditer(text)] if any(c in text for c in "[({<") else []
    bare = [(_left(text, m.start()), m.end()) for m in _BARE_DOT.finditer(text)] if has_dot else []
    if has_at:
        edits += _address_edits(text, [e[:2] for e in edits], dots, bare)
    edits += [(s, e, ".") for s, e in dots]
    if has_dot or "point" in low:
        for m in _NUMBERS.finditer(text):
            edits += [(m.start() + x.start(), m.start() + x.end(), ".") for x in _NUMBERS_DOT.finditer(m[0])]
    if _DIGIT_SIGNS.search(text):
        for m in _DIGIT_RUN.finditer(text):
            for x in _DIGIT_TOKEN.finditer(m[0]):
                new = {"plus": "+", "dot": ".", "gap": ""}.get(x.lastgroup or "", "")
                if x.lastgroup == "digit":
                    new = DIGIT_WORDS[x[0].lower()]
                elif x.lastgroup == "rest":
                    new = x[0]
                edits.append((m.start() + x.start(), m.start() + x.end(), new))
    edits.sort()
    apart: list[Edit] = []
    for e in edits:
        if not apart or e[0] >= apart[-1][1]:
            apart.append(e)
    return apart


def _ats(text: str) -> list[tuple[int, int]]:
    """Signs in brackets or between blanks, with the white space around them that no other one has."""
    found, end = [], 0
    for m in _AT.finditer(text):
        start = max(_left(text, m.start()), end)
        # A bare sign needs white space of its own before it.
        if text[m.start()] != "@" or start < m.start():
            end = m.end()
            found.append((start, end))
    return found


def _left(text: str, at: int) -> int:
    """Where the white space before ``at`` starts."""
    while at and text[at - 1].isspace():
        at -= 1
    return at


def _address_edits(text: str, ats: list[tuple[int, int]], dots: list[tuple[int, int]], bare: list[tuple[int, int]]) -> list[Edit]:
    """Edits of the bare words "at" and "dot" inside addresses, whose other signs may be plain, in brackets or bare too."""
    places: list[tuple[int, int, bool]] = []  # start, end, and if it is a bare word
    if bare:
        places += [(s, e, False) for s, e in ats] + [(m.start(), m.end(), False) for m in re.finditer("@", text)]
    for m in _BARE_AT.finditer(text):
        places.append((_left(text, m.start()), m.end(), True))
    if not places:
        return []
    starts = {s: (e, False) for s, e in dots} | {s: (e, True) for s, e in bare}
    ends = {e: (s, False) for s, e in dots} | {e: (s, True) for s, e in bare}
    edits: list[Edit] = []
    for start, end, word in places:
        # The local part, backwards.
        local, at, split = [], start, False
        while True:
            left = at
            while left and text[left - 1] in _LOCAL:
                left -= 1
            if left == at:
                break
            first, at = left, left
            if left not in ends:
                break
            at, is_bare = ends[left]
            split = True
            if is_bare:
                local.append((at, left, "."))
        if start == 0 or text[start - 1] not in _LOCAL:
            continue
        if local and at != first:  # nothing stands before the last dot
            local = [x for x in local if x[0] != at]
        # The domain: after each label its end, the kind of dot before it, and where a bare one stands.
        m = _LABEL.match(text, end)
        labels: list[tuple[str, str, tuple[int, int]]] = []
        last = m
        while last is not None:
            at = last.end()
            if at in starts:
                to, is_bare = starts[at]
                kind, place = "bare" if is_bare else "bracketed", (at, to)
            elif text.startswith(".", at):
                kind, place = "plain", (at, at + 1)
            else:
                break
            last = _LABEL.match(text, place[1])
            if last is not None:
                labels.append((kind, last[0] if not text[last.end() : last.end() + 1].isalnum() else "", place))
        spaced = text[start:end].strip() == "@" and end - start > 1
        while labels and not _ends(labels, word, spaced):
            labels.pop()
        if not labels:
            continue
        if word and any(kind != "bare" for kind, _, _ in labels) and not split:
            name = text[first:start]
            if name.isalpha() and (name.lower() in _BEFORE_AT or name.lower().endswith(("ing", "ed"))):
                continue
        if word:
            edits.append((start, end, "@"))
        edits += local + [(*place, ".") for kind, _, place in labels if kind == "bare"]
    return edits


def _ends(labels: list[tuple[str, str, tuple[int, int]]], word: bool, spaced: bool) -> bool:
    """Whether an address may end with the last of ``labels``."""
    kind, label, _ = labels[-1]
    if kind == "plain":
        # A sentence that begins without a space has a capital.
        return not word or _ENDING.fullmatch(label) is not None or label.isupper() and _ENDING.fullmatch(label.lower()) is not None
    if _ENDING.fullmatch(label.lower()):
        return True
    named = len(label) > 1 and label.isalpha() and label.lower() not in ("at", "dot")
    # One dot beside a sign that is no bare word: any name will do.
    return named and (kind == "bracketed" or not word and not spaced and len(labels) == 1)


def rewritten(text: str) -> tuple[str, list[int], list[int]] | None:
    """The text without disguise, and for each character of it where its source starts and ends; None if nothing is disguised."""
    folds = not text.isascii() and _FOLDABLE.search(text)
    # Characters first, so that words and brackets written with lookalikes are seen too.
    out, starts, ends = text, None, None
    if folds:
        chars, starts = [], []
        for i, c in enumerate(text):
            new = FOLDED.get(c, c)
            if new:
                chars.append(new)
                starts.append(i)
        out = "".join(chars)
        ends = [i + 1 for i in starts]
    edits = _edits(out)
    if not folds and not edits:
        return None
    if starts is None:
        starts = list(range(len(text)))
        ends = list(range(1, len(text) + 1))
    parts, new_starts, new_ends, at = [], [], [], 0
    for a, b, new in [*edits, (len(out), len(out), "")]:
        parts += [out[at:a], new]
        new_starts += starts[at:a] + [starts[a]] * len(new) if new else starts[at:a]
        new_ends += ends[at:a] + [ends[b - 1]] * len(new) if new else ends[at:a]
        at = b
    return "".join(parts), new_starts, new_ends


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Plain spans, and all spans: those and the disguised ones, by kind, then start."""
    base = plain_spans(text)
    other = rewritten(text)
    if other is None:
        return base, base
    plain, starts, ends = other
    added = list(base)
    for kind in KINDS:
        own = [(s, e) for k, s, e in base if k == kind]
        lefts = [s for s, _ in own]
        for k, s, e in plain_spans(plain):
            if k != kind:
                continue
            start, end = starts[s], ends[e - 1]
            at = bisect_left(lefts, end)  # spans of a kind do not overlap: only the one before can reach in
            if not (at and own[at - 1][1] > start):
                added.append((kind, start, end))
    added.sort(key=lambda x: (KINDS.index(x[0]), x[1], x[2]))
    return base, added


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


SPANS = ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def find(documents: DataFrame) -> DataFrame:
    """Per row doc_id, the numbers of plain spans by kind, base_sha256 (of the plain spans' list) and spans (all spans).

    Spans are ``kind:start:end`` in code points, end exclusive, by kind as in ``KINDS``, then start, comma-joined. Null and
    empty text have none; other columns are ignored; repeated rows give repeated results.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in KINDS]
            hashes, shown = [], []
            for text in batch.column(1):
                base, spans = all_spans(text.as_py() or "")
                for column, kind in zip(counts, KINDS, strict=True):
                    column.append(sum(k == kind for k, _, _ in base))
                hashes.append(hashlib.sha256(joined(base).encode()).hexdigest())
                shown.append(joined(spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(shown, pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    bounded_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, f"doc_id long, {SPANS}")


def masked_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the kind of its first one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda x: (x[1], -x[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(documents: DataFrame) -> DataFrame:
    """All rows and columns, personal data in ``text`` replaced by its kind in angle brackets; null stays null."""
    at = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x if x is None else masked_text(x, all_spans(x)[1]) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, "text", pa.array(texts, batch.schema.field(at).type))

    bounded_batches(documents.sparkSession)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(work, fields)
