"""Personal data: e-mail addresses, IP addresses, card and phone numbers, also behind disguises.

A text passes through transducers that undo disguises. Each carries for every character the place in the source from
which it came, so what is found in the normalised text is reported as a span of the source.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from plenaria.llm.common import kept, slices, texts_of

#: Kinds in the order in which spans of one start are listed.
KINDS = ["email", "ip", "card", "phone"]
#: Characters that may stand in the name of an address.
NAME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A match can only begin where a run of digits begins, since every match takes whole runs.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
#: Code points of texts that are put into one Arrow batch.
POINTS = 2_000_000
SPANS = "array<struct<start:long,kind:int,end:long>>"
SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a name, @ and a domain of two labels or more; each @ is looked at once."""
    at, free = text.find("@"), 0
    while at >= 0:
        name = text[free:at]
        start = free + len(name.rstrip(NAME))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all identifiers that are written plainly, in order."""
    found = [(a, 0, b) for a, b in emails(text)]
    if DIGITS.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() and 12 <= len(digits := "".join(DIGITS.findall(m[0]))) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGITS.findall(m[0])) <= 15]
    return sorted(found)


@dataclass
class Normalised:
    """A text and, for each of its characters, where in the source the characters begin and end that it stands for."""

    text: str
    begin: np.ndarray
    end: np.ndarray

    @classmethod
    def of(cls, text: str) -> Normalised:
        places = np.arange(len(text) + 1)
        return cls(text, places[:-1], places[1:])

    def rewritten(self, edits: Iterable[tuple[int, int, str]]) -> Normalised:
        """With each (start, end, new text) applied; edits are in order and do not overlap."""
        texts, begins, ends, at = [], [], [], 0
        for start, stop, new in edits:
            texts += [self.text[at:start], new]
            begins += [self.begin[at:start], np.full(len(new), self.begin[start])]
            ends += [self.end[at:start], np.full(len(new), self.end[stop - 1])]
            at = stop
        if not at:
            return self
        return Normalised("".join([*texts, self.text[at:]]), np.concatenate([*begins, self.begin[at:]]), np.concatenate([*ends, self.end[at:]]))


# Letters that look like Latin ones, in pairs of look-alike and Latin letter.
CYRILLIC = "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw АA ВB ЕE КK МM НH ОO РP СC ТT ХX ІI ЈJ ЅS"
GREEK = "οo νv αa ιi κk ρp υu ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
PUNCTUATION = "․. 。. ‐- ‑- ‒- –- −- ∙. "
#: Characters without width, which are left out.
UNSEEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Blocks whose characters stand for ASCII by compatibility: superscripts and subscripts, enclosed, fullwidth and small
#: forms, mathematical letters and digits.
COMPATIBLE = [(0x2070, 0x20A0), (0x2460, 0x24FF), (0xFE50, 0xFE70), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)]
#: Single characters that may stand between the parts of identifiers.
SEPARATORS = "@._%+-() "


def look_alikes() -> dict[int, str | None]:
    """The table of the first transducer: look-alikes, compatible forms and the digits of all scripts; None: left out."""
    table: dict[int, str | None] = {ord(pair[0]): pair[1] for pair in f"{CYRILLIC} {GREEK} {PUNCTUATION}".split()}
    for first, last in COMPATIBLE:
        for code in range(first, last):
            plain = unicodedata.normalize("NFKC", chr(code))
            if len(plain) == 1 and plain.isascii() and (plain.isalnum() or plain in SEPARATORS):
                table[code] = plain
    for code in range(0x80, 0x20000):
        if unicodedata.category(chr(code)) == "Nd":
            table[code] = str(unicodedata.digit(chr(code)))
    return table | {ord(c): None for c in UNSEEN} | {0xA0: " ", 0x2007: " ", 0x202F: " "}


#: Where characters of the first transducer can stand; texts in ASCII and the common letters of Latin-1 have none of these.
UNCOMMON = re.compile("[\u00a0\u00ad\u0100-\U0010ffff]")


def seen(source: Normalised) -> Normalised:
    """First transducer: look-alike letters and digits of other scripts become ASCII, characters without width go."""
    if source.text.isascii() or not UNCOMMON.search(source.text):
        return source
    table = kept("look-alikes", look_alikes)
    text = source.text.translate(table)
    if text == source.text:
        return source
    if len(text) == len(source.text):
        return Normalised(text, source.begin, source.end)
    seen = np.array([table.get(ord(c), c) is not None for c in source.text])
    return Normalised(text, source.begin[seen], source.end[seen])


# The digits from 0 to 9 in English, German, French and Spanish, and words for signs.
SPELLED = [
    "zero one two three four five six seven eight nine", "null eins zwei drei vier fünf sechs sieben acht neun",
    "zéro un deux trois quatre cinq six sept huit neuf", "cero uno dos tres cuatro cinco seis siete ocho nueve",
]
OTHER_SPELLED = {"oh": "0", "zwo": "2", "fuenf": "5", "ein": "1", "une": "1", "una": "1"}
#: Last labels after which an address that is said with plain words counts as one.
LAST_LABELS = frozenset(("com org net edu gov mil int info biz io co ai app dev me tv example test de at ch li fr be lu es mx ar cl pe it pt br nl uk ie eu "
                         "pl cz se no dk fi ru ua us ca au nz in jp cn kr za").split())
AT_WORDS, DOT_WORDS, PLUS_WORDS = "at arroba arobase ät", "dot punkt point punto", "plus más mas"
VALUES = {word: str(n) for line in SPELLED for n, word in enumerate(line.split())} | OTHER_SPELLED

_words = lambda found: "|".join(sorted(found, key=lambda w: (-len(w), w)))
_digit, _dot, _at, _plus = _words(VALUES), _words(DOT_WORDS.split()), _words(AT_WORDS.split()), _words(PLUS_WORDS.split())
_gap, _edge_left, _edge_right = r"[ ,\-]{1,3}", r"(?<![^\W_])", r"(?![^\W_])"
#: Spelled and written digits in a row, which may be parted by a word for a dot, and a word for plus before them.
SEQUENCE = re.compile(rf"{_edge_left}(?:(?:{_plus}){_gap}|\+ ?)?(?:{_digit}|[0-9]+)(?:{_gap}(?:(?:{_dot}){_gap})?(?:{_digit}|[0-9]+)){{2,}}{_edge_right}", re.I)
TOKEN = re.compile(rf"{_edge_left}(?:({_digit})|({_dot})|({_plus})|([0-9]+)){_edge_right}|(\+)", re.I)
#: So many digits of a sequence are spelled at least.
LEAST_SPELLED = 3
#: Letters in place of digits, between digits.
LETTER_DIGITS = re.compile(r"[0-9][OoIl]{1,3}(?=[0-9])")
LETTERS = str.maketrans("OoIl", "0011")

_open, _close = r"[ ]{0,2}[\[({<][ ]{0,2}", r"[ ]{0,2}[\])}>][ ]{0,2}"
_at_code, _dot_code = "&#0*64;|&#x0*40;|&commat;|%40", "&#0*46;|&#x0*2e;|&period;|%2e"
HIDDEN_AT, HIDDEN_DOT = rf"{_open}(?:@|{_at}){_close}|{_at_code}", rf"{_open}(?:\.|{_dot}){_close}|{_dot_code}"


def _in_words(words: str, sign: str) -> str:
    """A sign between blanks, or its word between blanks or dashes, or in capitals between small letters."""
    capitals = "|".join(w.upper() for w in words.split("|"))
    return rf"[ ]{{1,2}}(?:{sign}|{words})[ ]{{1,2}}|[_\-](?:{words})[_\-]|(?-i:(?<=[a-z0-9])(?:{capitals})(?=[a-z0-9]))"


SAID_DOT = rf"(?:{HIDDEN_DOT}|{_in_words(_dot, chr(92) + '.')})"
_label, _part = "[A-Za-z0-9-]+", "[A-Za-z0-9_%+-]+"
#: What follows an @ that is hidden in brackets, and one that is plain, spaced or said as a word: only the first needs no
#: further disguise, so that "look at example.com" stays as it is.
AFTER_HIDDEN = re.compile(rf"({_label})((?:(?:{SAID_DOT}|\.){_label})+)", re.I)
AFTER_SAID = re.compile(rf"({_label})((?:\.{_label})*{SAID_DOT}{_label}(?:(?:{SAID_DOT}|\.){_label})*)", re.I)
AT = re.compile(rf"(?P<hidden>{HIDDEN_AT})|(?P<said>{_in_words(_at, '@')}|@)", re.I)
ANY_DOT = re.compile(SAID_DOT, re.I)
#: What a text with a hidden or said sign holds: a cheap first look.
HINT = re.compile(rf"[\[({{<][ ]{{0,2}}(?:[.@]|{_at}|{_dot})[ ]{{0,2}}[\])}}>]|&#|&commat|&period|%40|%2e|[ _\-](?:\.|{_dot})[ _\-]", re.I)
CAPITALS = re.compile(rf"[a-z0-9](?:{_dot.upper()})[a-z0-9]")
#: The name before an @, whose dots may be said too.
BEFORE = re.compile(rf"{_part}(?:(?:{SAID_DOT}|\.){_part})*\Z", re.I)
LAST_LABEL = re.compile(r"[A-Za-z]{2,}")
DOT_OF_NUMBERS = re.compile(rf"(?<=[0-9]){SAID_DOT}(?=[0-9])", re.I)
#: Code points before an @ among which its name is looked for, as long as the longest name that mail allows, and dots.
LONGEST_NAME = 96
_ascii_word = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 else 32 for b in range(256))
_kind_of_word = {w.encode(): 1 for w in VALUES} | {w.encode(): 2 for w in DOT_WORDS.split()}


def spelled(source: Normalised) -> Normalised:
    """Second transducer: digits in a row of which three or more are spelled are written, and letters between digits too."""
    text = source.text
    edits = [(m.start() + 1, m.end(), m[0][1:].translate(LETTERS)) for m in LETTER_DIGITS.finditer(text)]
    kinds = bytes(map(_kind_of_word.get, text.encode().translate(_ascii_word).split(), repeat(0)))
    if b"\1\1\1" in kinds.replace(b"\2", b""):
        for run in SEQUENCE.finditer(text):
            tokens = list(TOKEN.finditer(text, run.start(), run.end()))
            if sum(t[1] is not None for t in tokens) < LEAST_SPELLED:
                continue
            at = run.start()
            for token in tokens:
                new = VALUES.get(token[1].casefold(), token[1]) if token[1] else "." if token[2] else token[4] or "+"
                edits.append((at, token.end(), new))  # the gap before a token goes with it
                at = token.end()
    return source.rewritten(sorted(edits))


def said(source: Normalised) -> Normalised:
    """Third transducer: @ and dots that are hidden in brackets or said as words become signs, inside addresses only."""
    text = source.text
    if not HINT.search(text) and not CAPITALS.search(text):
        return source
    edits = [(m.start(), m.end(), ".") for m in DOT_OF_NUMBERS.finditer(text)]
    free = 0
    for m in AT.finditer(text):
        after = (AFTER_HIDDEN if m["hidden"] else AFTER_SAID).match(text, m.end())
        before = BEFORE.search(text, max(free, m.start() - LONGEST_NAME), m.start()) if after else None
        if not before:
            continue
        last = ANY_DOT.sub(".", after[0]).rsplit(".", 1)[-1]
        if not LAST_LABEL.fullmatch(last) or m["said"] not in (None, "@") and last.lower() not in LAST_LABELS:
            continue
        edits += [(d.start(), d.end(), ".") for d in ANY_DOT.finditer(text, before.start(), m.start())]
        edits.append((m.start(), m.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in ANY_DOT.finditer(text, m.end(), after.end())]
        free = after.end()
    ordered, at = [], 0
    for edit in sorted(set(edits)):
        if edit[0] >= at:
            ordered.append(edit)
            at = edit[1]
    return source.rewritten(ordered)


TRANSDUCERS: list[Callable[[Normalised], Normalised]] = [seen, spelled, said]


def normalised(text: str) -> Normalised:
    """The text after all transducers, with the way back to the source."""
    out = Normalised.of(text)
    for step in TRANSDUCERS:
        out = step(out)
    return out


def scanned(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain identifiers, and all identifiers: those and the disguised ones, as (start, kind number, end) in the source.

    A disguised one holds at least one character that a transducer changed and lies in no plain one of its kind.
    """
    base = identifiers(text)
    plain = normalised(text)
    if plain.text == text:
        return base, base
    more, own = set(), [[s for s in base if s[1] == k] for k in range(len(KINDS))]
    for start, kind, end in identifiers(plain.text):
        a, b = int(plain.begin[start]), int(plain.end[end - 1])
        before = bisect_right(own[kind], (a, kind, len(text)))
        inside = before and b <= own[kind][before - 1][2]  # spans of one kind do not overlap
        if text[a:b] != plain.text[start:end] and not inside:
            more.add((a, kind, b))
    return base, sorted({*base, *more})


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base (plain identifiers) and spans (those and the disguised ones) of every row.

    A span is (start, number of its kind, end) in code points of the source, end exclusive; spans are in that order and
    may overlap across kinds, and a disguised one may hold a plain one of its kind. Null text is empty and has no spans;
    repeated rows and null ids come back as often as they occur; an empty table gives an empty result; other columns are
    left out and may have any name. The work grows with the length of a text, also for one without spaces.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for run in slices(rows, POINTS, lambda r: len(r[1])):
                base, spans = zip(*(scanned(t) for _, t in run), strict=True)
                named = [[[dict(zip(("start", "kind", "end"), s, strict=True)) for s in row] for row in side] for side in (base, spans)]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in run], pa.int64()), *(pa.array(side, SPAN_TYPE) for side in named)], ["doc_id", "base", "spans"])
    return texts_of(docs, doc_id, text).mapInArrow(task, f"doc_id long, base {SPANS}, spans {SPANS}")


def count(found: Column, kind: str) -> Column:
    """How many spans of a kind an array holds."""
    return F.size(F.filter(found, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def written(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
