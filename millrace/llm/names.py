"""Organisation names as people type them: cleaning and parsing into core words, sector and initials.

``Grammar.parse`` undoes what typing does without changing the words: look-alike letters, full-width forms, accents, letter case,
digits for letters, doubled spaces, legal forms, hiring notes, places, an acronym beside the name, joined or split words.
What is left is a tuple of core words, a sector if one is said, and the words given by their initial only. Sectors are the
last words that names of the reference list share, and their shortenings follow by rule.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable
from typing import NamedTuple

from millrace.llm.distance import weighted_distance

RECURS = 3  # names of the reference list whose last word makes it a sector
VOWELS = set("aeiou")

# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans({
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "к": "k", "м": "m", "т": "t", "в": "b", "н": "h", "ӏ": "l", "ѵ": "v", "ո": "n",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S", "Ζ": "Z", "Α": "A", "Β": "B", "Ε": "E", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "ı": "i", "ø": "o", "ł": "l", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
})
# Digits typed for letters inside a word.
DIGITS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s"})
# Legal forms, and words that say nothing about which organisation is meant.
LEGAL = "inc incorporated llc ltd limited corp corporation co company plc gmbh ag sas sarl srl spa sa bv nv ab oy as pbc pty kk lp llp ev intl international group holding holdings labs technologies technology hq worldwide global".split()
LONG_LEGAL = [x for x in LEGAL if len(x) >= 7]
# What people type in place of a name.
NO_NAMES = set(
    "unknown none null confidential vertraulich recruiter company stealth stealthstartup privatecompany ourclient selfemployed na nn tbd anonymous undisclosed client employer startup various freelance notdisclosed test notavailable hidden seedescription seebelow".split()
)


class Name(NamedTuple):
    core: tuple[str, ...]  # the words but for sector, initials last known place
    sector: str
    initials: str  # of words given only by a letter
    acronym: str

    @property
    def joined(self) -> str:
        return "".join(self.core) + self.sector


def letters(text: str) -> str:
    """Latin letters for look-alikes, full-width and accented ones; lower case."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKC", text).translate(LOOKALIKES)
    text = "".join(c for c in unicodedata.normalize("NFD", text) if not unicodedata.combining(c) and unicodedata.category(c) not in ("Cf", "Cc") or c in "\t\n\r")
    return text


def near(a: str, b: str) -> bool:
    """Within one edit or swap of neighbours."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > 1:
        return False
    i = 0
    while i < min(la, lb) and a[i] == b[i]:
        i += 1
    if la == lb:
        return a[i + 1 :] == b[i + 1 :] or (a[i + 2 :] == b[i + 2 :] and a[i : i + 2] == b[i : i + 2][::-1])
    return a[i + 1 :] == b[i:] if la > lb else a[i:] == b[i + 1 :]


def letter_mask(word: str) -> int:
    out = 0
    for c in word:
        out |= 1 << (ord(c) % 32)
    return out


def subsequence(a: str, b: str) -> bool:
    it = iter(b)
    return all(c in it for c in a)


@functools.lru_cache(100_000)
def legal(word: str) -> bool:
    return word in LEGAL or (len(word) >= 6 and any(near(word, x) for x in LONG_LEGAL))


LEGAL_RUN = re.compile("^(?:" + "|".join(sorted(LEGAL, key=len, reverse=True)) + "){2,}$")


HEAD = re.compile(r"^\s*(?:careers?\s*(?:@|at)|jobs?\s+(?:at|with)|join|via|the\s+(?=.*\speople\s*$)|team|work at|hiring(?: at|:)|about)\s+(?=\S)", re.I)
TAIL = re.compile(r"\s*(?:\|\s*(?:careers?|jobs?|home|hiring).*|/\s*[\w &]*team.*|:\s*people (?:&|and) culture.*|\(\s*(?:we.re )?(?:hiring|remote|hybrid)[^)]*\)|,\s*[^,]*\boffice\b\s*|\s[–—-]\s*(?:emea|apac|amer|americas|europe|na|us|uk|dach|latam|global|remote)\s*|\s+people\s*|\bis hiring\b.*)$", re.I)
MARKED = re.compile(r"[|/:(,–—-]|people|hiring", re.I)
DASHES = re.compile(r"[–—−-]")
PLACE_PAREN = re.compile(r"\(\s*([^()]*)\s*\)")
DASH = re.compile(r"\s+[–—−-]+\s*|\s*-*[–—]\s+")
DOTTED = re.compile(r"\b((?:[A-Za-z]\.\s?){2,}[A-Za-z]?)(?=\W|$)")
WORD = re.compile(r"[^\W_]+\.?")
CAMEL = re.compile(r"(?<=[a-z]{2})(?=[A-Z][a-z])")


def fits_acronym(short: str, full: str, least: int = 0) -> bool:
    """``short`` is made of the initials of ``full``. With ``least``, only so many must agree: a sector may be left out."""
    heads = [w[0].lower() for w in re.findall(r"[^\W_]+", full)]
    if least and len(heads) >= least and list(short.lower()[:least]) == heads[:least]:
        return True
    return len(heads) >= 2 and len(short) >= 2 and subsequence(short.lower()[: len(heads)], "".join(heads)) and short.lower()[0] in heads


def says_nothing(raw: str) -> bool:
    flat = re.sub(r"[^a-z]", "", letters(raw).lower())
    return not flat or flat in NO_NAMES


def sectors_of(names: Iterable[str]) -> list[str]:
    """The sector words of a reference list: last words that ``RECURS`` of its names of several words share."""
    heads: dict[str, set[str]] = defaultdict(set)
    for name in names:
        words = letters(name).lower().split()
        if len(words) > 1 and words[-1].isalpha() and words[-1] not in LEGAL:
            heads[words[-1]].add(" ".join(words[:-1]))
    return sorted((w for w, h in heads.items() if len(h) >= RECURS), key=lambda w: (-len(heads[w]), w))


class Grammar:
    """Parses names, given the sector words of a reference list."""

    def __init__(self, sectors: Iterable[str] = ()):
        self.sectors = list(sectors)
        self.known = set(self.sectors)
        self.masks = [(s, letter_mask(s)) for s in self.sectors]
        self.sector_of = functools.lru_cache(100_000)(self._sector_of)
        self.short_legal = functools.lru_cache(100_000)(self._short_legal)
        self.shortened = functools.lru_cache(100_000)(self._shortened)
        self.kept = functools.lru_cache(100_000)(self._parse)
        self.tiny = [s for s in self.sectors if len(s) == 2]

    def __reduce__(self):
        return Grammar, (self.sectors,)

    def _sector_of(self, word: str) -> str:
        """The sector a word stands for: itself, a typo, or a shortening of no other: a prefix, its consonants, or both."""
        if word in self.known:
            return word
        if len(word) >= 4:
            mask = letter_mask(word)
            # two edits bring in or take out at most two letters
            close = [s for s, m in self.masks if abs(len(s) - len(word)) <= 2 and (mask & ~m).bit_count() <= 2 and (m & ~mask).bit_count() <= 2]
            for s in close:
                if len(s) > 4 and near(word, s):
                    return s
            if len(word) >= 6:
                for s in close:
                    if len(s) >= 7 and weighted_distance(word, s, 2.0) <= 2.0:
                        return s
        return self.shortened(word)

    def parse(self, raw: str) -> Name:
        return self.kept(raw) if len(raw) <= 200 else self._parse(raw)

    def begun(self, word: str) -> list[str]:
        """The sectors that a word is the beginning of."""
        return [s for s in self.sectors if len(s) > len(word) and s.startswith(word)] if len(word) > 1 and word not in LEGAL else []

    def _shortened(self, word: str) -> str:
        if len(word) < 2 or word in LEGAL:
            return ""
        starts = self.begun(word)
        if len(starts) == 1:
            return starts[0]
        if len(word) == 2:
            bones = [s for s in self.sectors if s[0] == word[0] != word[1] and word[1] in s[1:]]
            return bones[0] if not starts and len(bones) == 1 and word[1] not in VOWELS else ""
        if not set(word[1:-1]) & VOWELS:
            for s in self.sectors:
                if s[0] == word[0] and (word[-1] == s[-1] or word[-1] not in VOWELS) and len(s) > len(word) and subsequence(word, s) and len(word) * 2 >= len([c for c in s if c not in VOWELS]):
                    return s
        ends = [s for s in self.sectors if len(word) >= 4 and len(s) > len(word) and s.startswith(word[:3]) and word[-1] == s[-1] and subsequence(word, s)]
        return ends[0] if len(ends) == 1 else ""

    def _short_legal(self, word: str) -> bool:
        """At most five letters and one edit from a short legal form; sectors and words of a name's length are not."""
        if word in self.known or len(word) > 5 or len(word) < 2 or len(self.begun(word)) == 1:
            return False
        return any(near(word, x) for x in LEGAL if (len(x) >= 3 and len(x) <= 5) or len(x) == 2 and len(word) == 3) and (len(word) < 4 or not self.sector_of(word))

    def without_legal_tail(self, words: list[tuple[str, bool]]) -> list[tuple[str, bool]]:
        """Without the legal forms, some with a typo or in pieces, that end a name. What is left has a word of three letters."""
        while len(words) > 1:
            w = words[-1][0]
            said = w in self.known or len(self.begun(w)) == 1 or len(w) == 2 and bool(self.shortened(w))
            if len(w) in (2, 3) and not said and w not in LEGAL and not any(self.sector_of(x) for x, _ in words[:-1]):
                if meant := next((s for s in self.tiny if near(w, s)), ""):
                    return [*words[:-1], (meant, False)]
            small = len(w) <= 2 and not said and any(len(x) > 2 for x, _ in words[:-1])
            if len(w) == 1 and (len(words) == 2 or words[-2][0] not in self.known and len(words[-2][0]) > 2):
                small = False  # one letter after a word may be an initial
            if not (small or self.short_legal(w) or LEGAL_RUN.match(w)):
                break
            words = words[:-1]
            if small and len(w) == 2 and words and len(words[-1][0]) == 1:
                words = words[:-1]
        return words

    def _parse(self, raw: str) -> Name:
        text = " ".join(letters(raw).split())
        was = None
        while was != text:
            was = text
            if MARKED.search(text):
                text = TAIL.sub("", text).strip()
            if m := HEAD.match(text):
                text = text[m.end() :].rstrip("! ")
        acronym = ""
        # an acronym beside the name: "PVA - Punise Veruse", "Dolagu Getandre Mobility (DGM)"
        if "(" in text:
            for m in PLACE_PAREN.finditer(text):
                if 2 <= len(m[1]) <= 5 and fits_acronym(m[1], text[: m.start()]):
                    acronym = m[1].lower()
            text = PLACE_PAREN.sub(" ", text).strip()
        parts = [p for p in DASH.split(text) if p.strip()] if DASHES.search(text) else [text]
        if len(parts) == 2:
            a, b = parts[0].strip(), parts[1].strip()
            if 2 <= len(a) <= 5 and " " not in a and fits_acronym(a, b, 2):
                acronym, text = a.lower(), b
            elif not self.words_of(b)[1] or len(b.split()) <= 2 and not any(self.sector_of(w.lower()) for w in re.findall(r"\w+", b)):
                text = a  # "Kapumo Zeka - Gapuville": a place
            else:
                text = f"{a} {b}"
        core, sector, initials = self.words_of(text)
        return Name(core, sector, initials, acronym)

    def words_of(self, text: str) -> tuple[tuple[str, ...], str, str]:
        if "." in text:
            text = DOTTED.sub(lambda m: re.sub(r"[.\s]", "", m[1]) + " ", text)
        if "'" in text or "’" in text:
            text = re.sub(r"(?<=\w)['’](?=\w)", "", text)
        found: list[tuple[str, bool]] = []
        for m in WORD.finditer(text):
            dotted = m[0].endswith(".")
            w = m[0].rstrip(".")
            if not w.isalpha() and any(c.isalpha() for c in w):
                w = w.lower().translate(DIGITS)
            if w.islower() or w.isupper() or w.istitle():
                found.append((w.lower(), dotted))
            else:
                found += [(p.lower(), dotted) for p in CAMEL.split(w)]
        words = [(w, d) for w, d in found if w not in ("and", "und", "et", "y", "the")]
        if len(words) > 1:
            kept = [x for i, x in enumerate(words) if not (legal(x[0]) and i > 0)]
            words = kept or words
        words = self.without_legal_tail(words)
        core: list[str] = []
        sector, initials = "", ""
        for i, (w, d) in enumerate(words):
            if len(w) == 1 and len(words) > 1:
                if not d and not sector and core and i == len(words) - 1 and (meant := next((s for s in self.tiny if w in s), "")):
                    sector = meant  # half of a short sector
                elif not (i == len(words) - 1 and (sector or d and len(words) == 2)):
                    initials += w
            elif not sector and len(words) > 1 and (s := self.sector_of(w)) and (len(s) > 2 or w == s):
                sector = s
            else:
                core.append(w)
        if not core and sector:
            core, sector = [sector], ""
        return tuple(core), sector, initials
