"""Text decoded with the wrong code page: found and restored as a substitution cipher, learned per source.

Which pages were swapped is unknown, so what a wrongly shown character stands for is learned, for every source, by
expectation-maximization against the letter bigrams of all clean texts:

* A character that was several bytes of UTF-8 shows as a sequence, the same for every occurrence. Which characters begin
  such sequences, and how long those are, follows from where they stand. A table gives how each of the 128 upper bytes is
  shown; a sequence reads as the letter whose bytes its characters show.
* A character that was one byte shows as one character (or as a mark that belongs to the letter before it). A table
  gives how each letter of the corpus, and each combining mark, is shown.
* A sequence or character may stand for itself: the more so the less it is over-represented in the odd texts of its
  source, against the others; that reading is weighed by the same bigrams.

Tables start from flat ones, with votes of the code pages that Python knows where those know the character; the votes
weigh as much as a few occurrences, so pages that no list holds are learned from the text alone. Wrong characters are
replaced by way of a private character each and translate().
"""

from __future__ import annotations

import codecs
import encodings
import functools
import pkgutil
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebind.storage import cut

#: Rounds of replacement: a text may have been read wrongly several times over.
ROUNDS = 3
#: Characters of the bigrams, the most frequent ones; all others count as one. It bounds what is sent to every task.
ALPHABET = 1000
#: Weight of a character's own frequency in its bigrams, and steps of expectation-maximization.
SMOOTH, STEPS = 5.0, 12
#: Weight of a table's start, in occurrences; share of the votes of code pages in it. The votes also stay as a factor, so
#: that bigrams must speak clearly against what a page says; where no page knows a character all is left to them.
START, VOTES = 4.0, 0.7
#: How many times rarer a symbol is in clean than in odd texts when both readings are as likely; characters of the whole
#: corpus that are added to a source's clean ones.
RARER, BORROWED = 0.05, 2000.0
#: Log odds that the occurrences of a character must reach together before it is read as another; a few good contexts do.
EVIDENCE = 25.0
#: Rows of ciphers up to which they are sent to every task; beyond, records are joined with them.
SENT = 400_000
LOST, OTHER, MARK = "�", "\x00", "﻿"
#: Share of its table that a sequence's letter must reach, and the fit of any letter between two sequences.
LEAST, BETWEEN = 2e-3, 1e-3
#: Factor of the letters that no page votes for where some page knows the whole sequence, and what a vote adds to a letter.
UNVOTED, VOTED = 0.005, 0.05
TONES = "̣̀́̃̉"
_CONTROL = regex.compile("[\x80-\x84\x86-\x9f�]")
_RUN = regex.compile("[^\x00-\x7f]+")
_WORDY, _LETTER, _SMALL, _CAPITAL, _BEYOND, _SIGN, _SYMBOL, _BLANK, _LATIN, _FOREIGN, _LOST, _QUOTE = (1 << k for k in range(12))
#: Beside symbols, what a wrong reading leaves next to letters (ordinals, stops, daggers), and quotes within words.
_MARKS, _QUOTES = set("ªº­¡§¶¿†‡•‰¹²³¼½¾"), set("‚„‘“‹›«")
_OTHER_SCRIPTS = ("CYRILLIC", "GREEK", "CJK", "HANGUL", "HIRAGANA", "KATAKANA", "HALFWIDTH", "ARABIC", "HEBREW", "THAI", "ARMENIAN", "GEORGIAN", "BOX", "BLOCK", "LIGHT SHADE", "MEDIUM SHADE", "DARK SHADE")


@functools.cache
def _classes() -> np.ndarray:
    """What each character of the basic plane is, as bits; the last entry is for all others."""
    out = np.zeros(0x10001, dtype=np.uint16)
    for code in range(0x10000):
        c, kind = chr(code), unicodedata.category(chr(code))
        bits = _BEYOND if code > 127 else 0
        bits |= (_LETTER if kind[0] == "L" else 0) | (_WORDY if kind[0] in "LM" else 0) | (_SMALL if kind == "Ll" else 0) | (_CAPITAL if kind == "Lu" else 0)
        bits |= (_SYMBOL if kind[0] == "S" else 0) | (_BLANK if kind[0] == "Z" or code < 33 else 0)
        bits |= _SIGN if code > 127 and (kind[0] == "S" or kind == "Lm" or c in _MARKS) else 0
        bits |= _QUOTE if c in _QUOTES else 0
        bits |= _LOST if 0x80 <= code < 0xA0 and code != 0x85 or c == LOST else 0
        name = unicodedata.name(c, "") if code > 127 or kind[0] == "L" else ""
        bits |= (_LATIN if kind[0] == "L" and name.startswith("LATIN") else 0) | (_FOREIGN if name.startswith(_OTHER_SCRIPTS) else 0)
        out[code] = bits
    out[-1] = _BEYOND | _SYMBOL | _SIGN
    return out


def odd_texts(texts: list[str]) -> np.ndarray:
    """Which texts hold neighbours that ordinary text hardly has; such texts teach no bigrams.

    Signs within words or after letters beyond ASCII, capitals after small letters where one is beyond ASCII, two scripts
    in one word, symbols before other characters beyond ASCII, and control characters.
    """
    found = np.zeros(len(texts), dtype=bool)
    which = [k for k, text in enumerate(texts) if not text.isascii()]
    if not which:
        return found
    raw = [(" " + texts[k] + " ").encode("utf-32-le", "replace") for k in which]
    bits = _classes()[np.minimum(np.frombuffer(b"".join(raw), dtype=np.uint32), 0x10000)]
    before, here, after = bits[:-2], bits[1:-1], bits[2:]
    has = lambda of, *wanted: of & sum(wanted) == sum(wanted)
    odd_ = has(here, _LOST) | (has(before, _WORDY) & (here & (_SIGN | _QUOTE) != 0) & has(after, _LETTER))
    odd_ |= has(before, _SMALL) & has(here, _CAPITAL) & ((before | here) & _BEYOND != 0)
    odd_ |= has(before, _LETTER, _BEYOND) & has(here, _SIGN) | has(before, _SIGN, _BEYOND) & has(here, _SMALL)
    odd_ |= has(before, _LATIN) & has(here, _FOREIGN) | has(before, _FOREIGN) & has(here, _LATIN)
    odd_ |= has(before, _SYMBOL, _BEYOND) & has(here, _BEYOND) & (here & (_SYMBOL | _BLANK) == 0)
    ends = np.cumsum([len(r) // 4 for r in raw])
    found[np.array(which)[np.unique(np.searchsorted(ends, np.flatnonzero(odd_) + 1, side="right"))]] = True
    return found


def odd(text: str) -> bool:
    return bool(odd_texts([text])[0])


@functools.cache
def _pages() -> tuple[tuple[str, ...], ...]:
    """The upper halves of the pages of single bytes that Python knows."""
    pages: list[tuple[str, ...]] = []
    for name in sorted(m.name for m in pkgutil.iter_modules(encodings.__path__)):
        try:
            if codecs.lookup(name)._is_text_encoding and b"az09 ,".decode(name) == "az09 ,":
                page = tuple(bytes([b]).decode(name, "replace") for b in range(128, 256))
                if sum(c != LOST and len(c) == 1 for c in page) > 60 and page not in pages:
                    pages.append(page)
        except (LookupError, UnicodeError, ValueError, TypeError):
            continue
    return tuple(pages)


@functools.cache
def _places() -> tuple[dict[str, int], ...]:
    return tuple({c: 128 + b for b, c in enumerate(page) if c != LOST} for page in _pages())


@functools.lru_cache(maxsize=1 << 16)
def page_width(run: str) -> int:
    """How many characters at the start of a run are one character of UTF-8 in some page; 1 if none is."""
    for places in _places():
        raw = bytes(places.get(c, ord(c) if 128 <= ord(c) < 160 else 0) for c in run)
        for k in (2, 3, 4):
            if len(raw) >= k and min(raw[:k]) > 0:
                try:
                    if len(raw[:k].decode()) == 1:
                        return k
                except UnicodeDecodeError:
                    continue
    return 1


@functools.cache
def _votes() -> tuple[dict[str, Counter], dict[str, Counter]]:
    """For a shown character, the upper bytes it is in Python's pages of single bytes, and the characters those bytes are in others."""
    pages = _pages()
    to_byte: dict[str, Counter] = {}
    for page in pages:
        for b, c in enumerate(page):
            to_byte.setdefault(chr(128 + b) if c == LOST else c, Counter())[b] += 1
    other: dict[str, Counter] = {c: Counter(p[b] for b, n in bytes_.items() for p in pages if p[b] not in (c, LOST)) for c, bytes_ in to_byte.items()}
    return to_byte, other


class Bigrams:
    """Probabilities of one character after another, over the most frequent characters; the rest are one."""

    def __init__(self, counts: dict[tuple[str, str], int]):
        totals: Counter = Counter()
        for (_, b), n in counts.items():
            totals[b] += n
        self.chars = [OTHER, " ", *sorted((c for c in totals if c not in (OTHER, " ")), key=lambda c: (-totals[c], c))[: ALPHABET - 2]]
        self.place = {c: k for k, c in enumerate(self.chars)}
        table = np.zeros((len(self.chars),) * 2)
        for (a, b), n in counts.items():
            table[self.place.get(a, 0), self.place.get(b, 0)] += n
        upper = np.array([ord(c) > 127 for c in self.chars])
        #: counts of characters and pairs beyond ASCII, as shares of such characters
        self.rate = np.where(upper[:, None] & upper, table, 0.0) / max(1.0, table[:, upper].sum())
        self.single_rate = np.where(upper, table.sum(axis=0), 0.0) / max(1.0, table[:, upper].sum())
        alone = table.sum(axis=0) + 0.02
        alone[0] = 0.02
        alone /= alone.sum()
        kinds = SMOOTH + (table > 0).sum(axis=1, keepdims=True)
        self.after = (table + kinds * alone) / (table.sum(axis=1, keepdims=True) + kinds)
        self.after[0] = alone
        self.after[:, 0] = np.minimum(self.after[:, 0], 1e-6)
        #: what wrongly shown characters may stand for: letters and signs beyond ASCII that clean texts hold, and marks
        self.letters = [c for c in self.chars if ord(c) > 127 and not unicodedata.combining(c) and c != MARK]
        self.letters.append(MARK)
        self.letter_places = np.array([self.of(c) for c in self.letters], dtype=np.int64)
        self.by_size = {k: np.array([n for n, c in enumerate(self.letters) if len(c.encode()) == k], dtype=np.int64) for k in (2, 3, 4)}
        self.bytes_of = {k: np.array([[b - 128 for b in self.letters[n].encode()] for n in own], dtype=np.int64).reshape(-1, k) for k, own in self.by_size.items()}

    def of(self, char: str) -> int:
        return self.place.get(" " if char in "\n\t\r" else char, 0)

    def chain(self, text: str) -> float:
        places = [self.of(c) for c in text]
        return float(np.prod([self.after[a, b] for a, b in zip(places, places[1:])]))


class Cipher:
    """What the characters of one source stand for: lengths of sequences by first character, tables over bytes and letters."""

    def __init__(self, lm: Bigrams, widths: dict[str, int] | None = None, to_byte: dict[str, np.ndarray] | None = None, to_letter: dict[str, np.ndarray] | None = None, itself: dict[str, float] | None = None, sequences: dict[str, str] | None = None):
        self.lm, self.widths, self.to_byte, self.to_letter, self.itself, self.sequences = lm, widths or {}, to_byte or {}, to_letter or {}, itself or {}, sequences or {}
        self.known: dict[tuple, str] = {}

    def parse(self, before: str, run: str, after: str) -> list[tuple[int, int, str, str, str, str]]:
        """(start, end, left of the left neighbour, left neighbour, symbol, two right neighbours) of the symbols of a run.

        A sequence that lacks its last character takes the blank that follows it: a hard blank may have become a plain one.
        """
        spans, at = [], 0
        while at < len(run):
            width, by_page = self.widths.get(run[at]), page_width(run[at : at + 4])
            if width is None or by_page > 1 and width > 1 and not voted_letters(run[at : at + width]):
                width = by_page
            end = min(at + width, len(run))
            symbol = run[at:end]
            if len(symbol) == width - 1 and LOST not in symbol and end == len(run) and after[:1] == " ":
                symbol += " "
            elif len(symbol) != width or LOST in symbol or any(self.widths.get(c, 1) > 1 for c in symbol[1:]) and page_width(symbol) != width:
                symbol = run[at]
                end = at + 1
            spans.append((at, at + len(symbol), symbol))
            at = max(end, at + len(symbol))
        out, whole = [], before + run + after
        for k, (a, b, symbol) in enumerate(spans):
            x, y = len(before) + a, len(before) + b
            left = whole[max(0, x - 2) : x].rjust(2)
            if k and len(spans[k - 1][2]) > 1:
                left = OTHER + OTHER
            right = whole[y : y + 1] or " "
            if k + 1 < len(spans) and len(spans[k + 1][2]) > 1:
                right = OTHER
            out.append((a, b, left[0], left[1], symbol, right))
        return out

    def readings(self, symbol: str, contexts: list[tuple[str, str, str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(readings, their weights by the tables, fit of each to each context); the first reading is the symbol itself."""
        lm = self.lm
        l2, l1, right = (np.array([lm.of(c[k]) for c in contexts]) for k in range(3))
        fit = lm.after
        own = [lm.of(c) for c in symbol]
        itself = fit[l2, l1] * fit[l1, own[0]] * np.where(right == 0, 1.0, fit[own[-1], right])
        for a, b in zip(own, own[1:]):
            itself = itself * fit[a, b]
        sure = self.itself.get(symbol, 0.02)
        names, weights, fits = [symbol], [np.array([sure])], [itself[:, None]]
        size = len(symbol)
        if size == 1:
            table = self.to_letter.get(symbol, np.zeros(len(lm.letters) + len(TONES)))
            where = lm.letter_places
            names += lm.letters
            weights.append((1 - sure) * table[: len(where)])
            fits.append((fit[l2, l1])[:, None] * fit[l1[:, None], where] * fit[where, right[:, None]])
            names += TONES
            weights.append((1 - sure) * table[len(where) :])
            fits.append(self._marked([(a, b) for a, b, _ in contexts], right))
        elif size in lm.by_size:
            tables = [self.to_byte.get(c, _NONE) for c in symbol]
            where, wanted = lm.letter_places[lm.by_size[size]], lm.bytes_of[size]
            names += [lm.letters[n] for n in lm.by_size[size]]
            voted = voted_letters(symbol)
            votes = np.array([voted.get(n, UNVOTED) for n in names[1:]]) if voted else 1.0
            first = VOTED * np.array([voted.get(n, 0.0) for n in names[1:]])
            weights.append((1 - sure) * (first + votes * np.prod([t[wanted[:, k]] for k, t in enumerate(tables)], axis=0)))
            # between two sequences the bigrams say nothing: what is read may be part of an inner wrong reading
            lone = np.array([OTHER in c[1:] for c in contexts])[:, None]
            around = fit[l1[:, None], where] * fit[where, right[:, None]]
            if size == 3:
                around[:, lm.by_size[3] == len(lm.letters) - 1] = fit[l1, right][:, None]  # the mark at the start of a file is nothing
            fits.append(fit[l2, l1][:, None] * np.where(lone, BETWEEN, around))
            most = bytes(128 + int(t.argmax()) for t in tables)
            try:
                letter = most.decode()
            except UnicodeDecodeError:
                letter = ""
            if len(letter) == 1 and letter not in names and (letter in self.to_byte or ord(letter) > 0x2BFF) and unicodedata.category(letter) not in ("Cn", "Co", "Mn"):
                at = lm.of(letter)
                names.append(letter)
                weights.append(np.array([(1 - sure) * np.prod([t.max() for t in tables])]))
                fits.append((fit[l2, l1] * np.where(lone[:, 0], BETWEEN, fit[l1, at] * fit[at, right]))[:, None])
        return names, np.concatenate(weights), np.concatenate(fits, axis=1)

    def _marked(self, lefts: list[tuple[str, str]], right: np.ndarray) -> np.ndarray:
        """Fits of the marks: each belongs to the left neighbour and makes another letter of it."""
        lm, out = self.lm, np.zeros((len(lefts), len(TONES)))
        for k, (l2, l1) in enumerate(lefts):
            for j, mark in enumerate(TONES):
                letter = unicodedata.normalize("NFC", l1 + mark)
                if len(letter) == 1 and letter in lm.place:
                    out[k, j] = lm.after[lm.of(l2), lm.of(letter)] * lm.after[lm.of(letter), right[k]]
        return out

    def agreed(self, symbol: str, contexts: list[tuple[str, str, str]], counts: np.ndarray) -> tuple[str, float]:
        """The one letter a sequence stands for, and its weight: by the tables, and by all contexts together, repeated ones counting little."""
        names, weights, fits = self.readings(symbol, contexts)
        shares = fits[:, 1:] / fits[:, 1:].sum(axis=1, keepdims=True)
        score = np.log(weights[1:] + 1e-30) + 0.15 * (np.log1p(counts) / np.log(2)) @ np.log(shares + 1e-9) / max(1.0, len(counts) ** 0.5)
        best = 1 + int(score.argmax())
        return names[best], float(weights[best])

    def read(self, symbol: str, l2: str, l1: str, right: str, trusting: bool) -> str:
        """The reading of a symbol between its neighbours: what it stands for in its source, or itself where that fits better."""
        key = (symbol, l2 if len(symbol) == 1 else "", l1, right, trusting)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            if len(symbol) == 1 and symbol not in self.to_letter or not trusting and symbol not in self.sequences:
                self.known[key] = symbol
            else:
                names, weights, fits = self.readings(symbol, [(l2, l1, right)])
                joint = weights * fits[0]
                best = names.index(self.sequences[symbol]) if self.sequences.get(symbol) in names else int((joint if len(symbol) == 1 else weights)[1:].argmax()) + 1 if len(names) > 1 else 0
                sure = " " not in symbol or weights[best] > LEAST / 10
                self.known[key] = names[best] if sure and joint[best] > 2 * joint[0] else symbol
        return self.known[key]


_NONE = np.full(128, 1e-6)


def start_bytes(char: str) -> np.ndarray:
    flat = np.full(128, (1 - VOTES) / 128)
    votes = _votes()[0].get(char)
    if not votes:
        return np.full(128, 1 / 128)
    for b, n in votes.items():
        flat[b] += VOTES * n / sum(votes.values())
    return flat


@functools.lru_cache(maxsize=1 << 16)
def voted_letters(symbol: str) -> dict[str, float]:
    """The letters that a sequence is by the pages that know all its characters, weighed against the first of them."""
    out: Counter = Counter()
    for places in _places():
        raw = [places.get(c, ord(c) if 128 <= ord(c) < 160 else 0) for c in symbol.replace(" ", "\xa0")]
        try:
            out[bytes(raw).decode()] += 1
        except UnicodeDecodeError:
            continue
    return {letter: n / max(out.values()) for letter, n in out.items() if len(letter) == 1 and ord(letter) > 127}


def start_letters(lm: Bigrams, char: str) -> np.ndarray:
    size = len(lm.letters) + len(TONES)
    flat = np.full(size, 1 / size)
    votes = _votes()[1].get(char, Counter())
    own = np.array([votes[c] for c in [*lm.letters, *TONES]], dtype=float)
    own[: len(lm.letters)][[k for k, c in enumerate(lm.letters) if c == char]] = 0
    return flat if own.sum() == 0 else (1 - VOTES) * flat + VOTES * own / own.sum()


def sequence_widths(runs: Counter) -> dict[str, int]:
    """The length of the sequences that a character begins, from (run, whether a letter stands before) with counts.

    A character begins sequences if it stands first in runs more often than elsewhere; the length is the most frequent
    distance to the next such character or to the end of the run.
    """
    out: dict[str, int] = {}
    for _ in range(3):  # known lengths tell where a sequence begins right after another
        first, inner = Counter(), Counter()
        starts_of = {}
        for (run, wordy), n in runs.items():
            starts, following = set(), 0
            for k, c in enumerate(run):
                if k == following:
                    starts.add(k)
                    following = k + out[c] if c in out else k + 1 if out else len(run)
            starts_of[run] = starts
            for k, c in enumerate(run):
                if k in starts:
                    first[c] += n if len(run) > 1 or wordy else 0
                else:
                    inner[c] += n
        begins = {c for c, n in first.items() if n > 0.8 * inner[c]}
        lengths: dict[str, Counter] = {}
        for (run, _), n in runs.items():
            edges = sorted({0, len(run), *(k for k in range(1, len(run)) if run[k] in begins)})
            for a, b in zip(edges, edges[1:]):
                lengths.setdefault(run[a], Counter())[b - a] += n
        before, out = out, {}
        for c in begins:
            longer = {k: n for k, n in lengths.get(c, Counter()).items() if 2 <= k <= 4}
            if longer and sum(longer.values()) > 0.2 * sum(lengths[c].values()):
                out[c] = max(longer, key=lambda k: (longer[k], -k))
        if out == before:
            break
    return out


def _shown(tables: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """How what a table is over (bytes or letters) is shown: counts by character as shares of all characters'.

    A page shows each as one character and each character stands for one, so the shares within a character count too.
    """
    total = np.sum(list(tables.values()), axis=0) if tables else 1.0
    return {c: t / np.maximum(total, 1e-9) * t / max(t.sum(), 1e-9) for c, t in tables.items()}


def learn(contexts: list[tuple[str, str, str, int]], clean: dict[tuple[str, str], int], lm: Bigrams) -> Cipher:
    """The cipher of a source from (two characters before, run, two characters after, count) of its odd texts.

    ``clean`` counts the characters beyond ASCII of its other texts, as ("", character), and their pairs.
    """
    runs: Counter = Counter()
    for before, run, _, n in contexts:
        runs[run, before[-1:].isalpha()] += n
    cipher = Cipher(lm, sequence_widths(runs))
    alone, begun = Counter(), Counter()
    for before, run, after, n in contexts:
        if len(run) > 1:
            begun[run[0]] += n
        else:
            alone[run] += n
    # what mostly stands alone begins nothing: in a wrongly read text every such character would go on
    cipher.widths |= {c: 1 for c, n in alone.items() if n > 3 * begun[c]}
    found: dict[str, Counter] = {}
    for before, run, after, n in contexts:
        for _, _, l2, l1, symbol, right in cipher.parse(before, run, after):
            found.setdefault(symbol, Counter())[l2, l1, right] += n
    singles = [s for s in found if len(s) == 1 and s != LOST]
    sequences = [s for s in found if len(s) in (2, 3, 4)]
    odd_total, clean_total = sum(len(run) * n for (run, _), n in runs.items()), sum(n for (a, _), n in clean.items() if not a)

    def clean_rate(a: str, b: str) -> float:
        everywhere = lm.rate[lm.of(a), lm.of(b)] if a else lm.single_rate[lm.of(b)]
        return (clean.get((a, b), 0) + BORROWED * everywhere) / (clean_total + BORROWED)

    for s, own in found.items():
        pairs = [(a, b) for a, b in zip(s, s[1:]) if b != " "] or [("", s[0])]
        n = sum(own.values())
        rarer = (min(clean_rate(a, b) for a, b in pairs) * odd_total + 0.3) / (n + 0.3)
        cipher.itself[s] = float(np.clip(rarer / (rarer + RARER), 1e-4, 0.999))
    counts_of = {s: np.array(list(own.values()), dtype=float) for s, own in found.items()}
    contexts_of = {s: list(own) for s, own in found.items()}
    evidence: dict[str, float] = {}

    def expected(symbol: str) -> tuple[list[str], np.ndarray]:
        names, weights, fit = cipher.readings(symbol, contexts_of[symbol])
        joint, n = fit * weights + 1e-300, counts_of[symbol]
        evidence[symbol] = float(n @ (np.log(joint[:, 1:].sum(axis=1)) - np.log(joint[:, 0]))) if joint.shape[1] > 1 else 0.0
        return names, n @ (joint / joint.sum(axis=1, keepdims=True))

    chars = {c for s in sequences for c in s}
    start = {c: START * (np.eye(128)[0x20] if c == " " else start_bytes(c)) for c in chars}
    cipher.to_byte = _shown(start)
    for _ in range(STEPS if sequences else 0):
        sums = {c: start[c].copy() for c in chars}
        for s in sequences:
            names, counts = expected(s)
            size = len(s)
            if size in lm.by_size and len(names) > 1:
                wanted, own = lm.bytes_of[size], counts[1 : 1 + len(lm.by_size[size])]
                for k, c in enumerate(s):
                    np.add.at(sums[c], wanted[:, k], own)
                    for name, n in zip(names[1 + len(own) :], counts[1 + len(own) :]):
                        sums[c][name.encode()[k] - 128] += n
        if " " in sums:
            sums[" "] = start[" "]
        new = _shown(sums)
        moved = max(np.abs(new[c] - cipher.to_byte[c]).max() for c in chars)
        cipher.to_byte = new
        if moved < 1e-3:
            break
    stand_for = {s: cipher.agreed(s, contexts_of[s], counts_of[s]) for s in sequences if evidence.get(s, 0) > 3.0}
    cipher.sequences = {s: letter for s, (letter, weight) in stand_for.items() if weight > LEAST}
    start_of = {s: START * start_letters(lm, s) for s in singles}
    itself = {c: k for k, c in enumerate(lm.letters)}
    cipher.to_letter = _shown(start_of)
    agreed: dict[str, float] = {}
    for _ in range(STEPS):
        following = {}
        for s in singles:
            _, counts = expected(s)
            following[s] = start_of[s] + counts[1:]
            agreed[s] = float(counts[1:].max() / max(1e-9, counts[1:].sum()))
            if s in itself:
                following[s][itself[s]] += counts[0]
        cipher.to_letter = {}
        for s, t in _shown(following).items():
            if s in itself:
                t[itself[s]] = 0.0
            cipher.to_letter[s] = t
    # another reading needs evidence from all occurrences together, and one letter that most of them agree on
    within = {c for s in cipher.sequences for c in s}
    cipher.to_letter = {s: t for s, t in cipher.to_letter.items() if s not in within and evidence.get(s, 0) > EVIDENCE and agreed[s] > 0.5}
    return cipher


def to_rows(cipher: Cipher) -> list[tuple[str, str, str, float]]:
    """(what, character, value, weight): the tables of a cipher, without their near-zero entries."""
    rows = [("width", c, str(w), 1.0) for c, w in cipher.widths.items()] + [("sequence", s, r, 1.0) for s, r in cipher.sequences.items()] + [("itself", s, "", w) for s, w in cipher.itself.items()]
    rows += [("byte", c, str(b), float(t[b])) for c, t in cipher.to_byte.items() for b in np.flatnonzero(t > 0.003)]
    names = [*cipher.lm.letters, *TONES]
    return rows + [("letter", c, names[k], float(t[k])) for c, t in cipher.to_letter.items() for k in np.flatnonzero(t > 0.003)]


def from_rows(rows: list[tuple[str, str, str, float]], lm: Bigrams) -> Cipher:
    cipher = Cipher(lm)
    places = {c: k for k, c in enumerate([*lm.letters, *TONES])}
    for what, char, value, weight in rows:
        if what == "width":
            cipher.widths[char] = int(value)
        elif what == "sequence":
            cipher.sequences[char] = value
        elif what == "itself":
            cipher.itself[char] = weight
        elif what == "byte":
            cipher.to_byte.setdefault(char, np.full(128, 1e-6))[int(value)] = weight
        elif value in places:
            cipher.to_letter.setdefault(char, np.full(len(places), 1e-6))[places[value]] = weight
    return cipher


def restore(text: str, cipher: Cipher) -> tuple[str, bool]:
    """(restored text, whether it held wrongly decoded characters)."""
    wrong = bool(_CONTROL.search(text))
    for _ in range(ROUNDS):
        trusting = odd(text)
        if text.isascii() or not trusting and not cipher.sequences:
            break
        pieces, table, end = [], {}, 0
        for match in _RUN.finditer(text):
            a, b = match.span()
            for x, y, l2, l1, symbol, right in cipher.parse(text[max(0, a - 2) : a], match.group(), text[b : b + 2]):
                best = cipher.read(symbol, l2, l1, right, trusting)
                if best != symbol:
                    mark = chr(0xF0000 + len(table))
                    table[ord(mark)] = best
                    pieces += [text[end : a + x], mark]
                    end = a + y
        if not table:
            break
        wrong = True
        changed = ("".join(pieces) + text[end:]).translate(table)
        text = unicodedata.normalize("NFC", changed) if any(v in TONES for v in table.values()) else changed.replace("﻿", "")
    return text, wrong


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is learned from, counted by task, as (source, a, b, c, n).

    Pairs of characters of the texts without odd neighbours (no source), the characters and pairs beyond ASCII of those
    texts by source (no c), and the runs beyond ASCII of the other texts with two characters on both sides.
    """
    pairs: Counter = Counter()
    uppers: Counter = Counter()
    contexts: Counter = Counter()
    for batch in batches:
        clean: dict[str, list[str]] = {}
        whole = batch.column(1).to_pylist()
        for source, text, is_odd in zip(batch.column(0).to_pylist(), whole, odd_texts(whole)):
            if is_odd:
                for match in _RUN.finditer(text):
                    a, b = match.span()
                    run = match.group()
                    for k in range(0, len(run), 24):
                        contexts[source, text[max(0, a + k - 2) : a + k], run[k : k + 24], text[a + k + 24 : a + k + 26] if k + 24 < len(run) else text[b : b + 2]] += 1
            else:
                clean.setdefault(source, []).append(text)
        for source, texts in clean.items():
            codes = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)
            codes = np.where((codes == 10) | (codes == 9) | (codes == 13), 32, codes)
            both, counts = np.unique((codes[:-1] << np.uint64(21)) | codes[1:], return_counts=True)
            for pair, n in zip(both.tolist(), counts.tolist()):
                pairs[pair] += n
                if pair & 0x1FFFFF > 127:
                    uppers[source, pair & 0x1FFFFF] += n
                    if pair >> 21 > 127:
                        uppers[source, pair] += n
        if len(contexts) > 500_000:
            yield _counted(Counter(), Counter(), contexts)
            contexts.clear()
    yield _counted(pairs, uppers, contexts)


def _counted(pairs: Counter, uppers: Counter, contexts: Counter) -> pa.RecordBatch:
    one = lambda p: chr(p >> 21) if p >> 21 else ""
    rows = [(None, chr(p >> 21), chr(p & 0x1FFFFF), None, n) for p, n in pairs.items()]
    rows += [(source, one(p), chr(p & 0x1FFFFF), None, n) for (source, p), n in uppers.items()]
    rows += [(source, a, run, b, n) for (source, a, run, b), n in contexts.items()]
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(),) * 4 + (pa.int64(),))], names=["source", "a", "b", "c", "n"])


def bigrams_of(counts: DataFrame) -> Bigrams:
    """The bigrams of (a, b, n), over the most frequent characters: at most ``ALPHABET`` squared of them come to the driver."""
    common = counts.groupBy("b").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "b").limit(ALPHABET).select("b")
    for side in ("a", "b"):
        counts = counts.join(F.broadcast(common.select(F.col("b").alias(side), F.lit(True).alias(f"known_{side}"))), side, "left")
        counts = counts.withColumn(side, F.when(F.col(f"known_{side}"), F.col(side)).otherwise(OTHER))
    return Bigrams({(r["a"], r["b"]): r["n"] for r in counts.groupBy("a", "b").agg(F.sum("n").alias("n")).toLocalIterator()})


def repair_encoding(df: DataFrame, kind: str, key: str, source: str, text: str, sent: int = SENT) -> DataFrame:
    """Columns (kind, key, wrong, original, restored) of the records that may be wrongly decoded.

    ``wrong`` tells whether characters from a wrong decoding were found, restorable or not: a character or sequence that
    is better read as a letter by its source's cipher, the replacement character, or a control character of the upper
    range. ``restored`` has them replaced; replacement characters stay, as what they stood for is lost. Null and empty
    texts, null keys and texts without any sign are not returned; a null source is a source of its own; repeated rows
    count once in the result; other columns are ignored. Texts are read twice and never shuffled: only counts are, of
    bigrams and of runs with their surroundings, combined within tasks first. A source's distinct ones are bounded by
    what its languages write, whatever the number of its records. Ciphers are sent to all tasks up to ``sent`` rows of
    tables, else joined to the records by source, where AQE splits a source that very many records share.
    """
    spark = df.sparkSession
    rows = df.select(F.col(kind).cast("string").alias("kind"), F.col(key).cast("string").alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).alias("text"))
    rows = rows.where(F.col("kind").isNotNull() & F.col("id").isNotNull() & (F.col("text") != ""))
    counted = cut(rows.select("source", "text").mapInArrow(_count, "source string, a string, b string, c string, n bigint").groupBy("source", "a", "b", "c").agg(F.sum("n").alias("n")))
    lm = spark.sparkContext.broadcast(bigrams_of(counted.where("source IS NULL").select("a", "b", "n")))

    def em(table: pd.DataFrame) -> pd.DataFrame:
        rows_ = list(zip(*(table[c] for c in ("a", "b", "c", "n"))))
        cipher = learn([r for r in rows_ if r[2] is not None], {(a, b): n for a, b, c, n in rows_ if c is None}, lm.value)
        return pd.DataFrame([(table["source"].iloc[0], *row) for row in to_rows(cipher)], columns=["source", "what", "char", "value", "weight"])

    ciphers = cut(counted.where("source IS NOT NULL").groupBy("source").applyInPandas(em, "source string, what string, char string, value string, weight double"))
    return _restored(spark, rows, ciphers, lm, sent).withColumnsRenamed({"kind": kind, "id": key})


def _restored(spark: SparkSession, rows: DataFrame, ciphers: DataFrame, lm, sent: int) -> DataFrame:
    shape = "kind string, id string, wrong boolean, original string, restored string"
    tables: dict[str, list] | None = None
    if ciphers.count() <= sent:
        tables = {}
        for r in ciphers.collect():
            tables.setdefault(r["source"], []).append((r["what"], r["char"], r["value"], r["weight"]))
    else:
        listed = ciphers.groupBy("source").agg(F.collect_list(F.struct("what", "char", "value", "weight")).alias("cipher"))
        rows = rows.where(~F.col("text").rlike(r"^[\x00-\x7f]*$")).join(listed, "source", "left").select("kind", "id", "source", "text", "cipher")
    shared = spark.sparkContext.broadcast(tables)

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: dict[str, tuple[Cipher, regex.Pattern | None]] = {}
        for batch in batches:
            out = []
            given = batch.column("cipher").to_pylist() if shared.value is None else [None] * batch.num_rows
            whole = batch.column("text").to_pylist()
            for k, i, source, text, own, is_odd in zip(*(batch.column(c).to_pylist() for c in ("kind", "id", "source")), whole, given, odd_texts(whole)):
                if text.isascii():
                    continue
                if source not in ready:
                    if len(ready) > 1000:
                        ready.clear()
                    table = shared.value.get(source, []) if shared.value is not None else [(r["what"], r["char"], r["value"], r["weight"]) for r in own or ()]
                    cipher = from_rows(table, lm.value)
                    longest = sorted(cipher.sequences, key=lambda s: (-len(s), s))
                    ready[source] = cipher, regex.compile("|".join(map(regex.escape, longest))) if longest else None
                cipher, sequences = ready[source]
                if is_odd or sequences is not None and sequences.search(text):
                    restored, wrong = restore(text, cipher)
                    out.append((k, i, wrong, text, restored))
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string()))], names=["kind", "id", "wrong", "original", "restored"])

    return rows.mapInArrow(repair, shape)
