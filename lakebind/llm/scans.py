"""Text from scanned pages: words broken over lines, misread characters, running headers and page numbers.

Words are looked up in the corpus itself: a rare word is set against the common words that share character trigrams
with it, found by an inverted join, and a gradient-boosted ranking says whether it is a misreading of one of them.
Line pairs and lines are judged by two more boosted classifiers: whether a line ends in a broken word, and whether a
line is furniture (header or page number). All three learn from pages made from clean sentences of the corpus, with
breaks, misreadings and furniture put in, so that their labels are known, and from lists and data made of its words. As
lines that are no furniture they also see records of the corpus in which nothing repeats and no numbers rise.
"""

from __future__ import annotations

import functools
import random
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebind.llm.boosting import Boosted
from lakebind.storage import cut, written

#: Misread characters and what they stand for (fixed values, in either letter case).
MISREAD = (
    ("1", "l"), ("1", "i"), ("l", "i"), ("i", "l"), ("0", "o"), ("5", "s"), ("8", "b"), ("6", "b"), ("9", "g"), ("2", "z"),
    ("rn", "m"), ("m", "rn"), ("cl", "d"), ("d", "cl"), ("ii", "u"), ("u", "ii"), ("vv", "w"), ("li", "h"),
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("o", "a"), ("a", "o"), ("b", "h"), ("h", "b"), ("n", "u"), ("u", "n"), ("y", "v"), ("j", "i"),
)
#: Records and common words from which the classifiers learn, at most.
SAMPLE_RECORDS, SAMPLE_WORDS = 3000, 6000
#: How many times as frequent as a word its correction is at least; the letters of the shortest word that is corrected.
RATIO, SHORTEST = 8, 4
#: How many times as frequent as its misreading a word is at most in training, and as a real word that resembles it;
#: such real pairs are drawn so often. Shares of the corpus, so that its size changes nothing.
RAREST, RESEMBLING, DRAWS = 5000, 60, 8
#: Trigrams of a word that its misreadings change at most, and letters that they add or take away.
CHANGED, LONGER = 5, 2
#: Trigrams below this share of all are taken as unseen, which bounds their table; corrections sent to all tasks, at most.
UNSEEN, SENT = 1e-6, 200_000
#: A text has furniture if one of its lines is so with this probability at least; then its likely ones are taken too.
SURE = 0.9
#: Marks at the end of a broken line.
MARKS = "-¬‐‑­"

_BREAK = regex.compile(rf"([\p{{L}}\p{{M}}\d’']+)([{MARKS}])[^\S\n]*$")
_START = regex.compile(r"^\s*([\p{L}\p{M}\d’']+)")
_BROKEN_END = regex.compile(rf"[^\s{MARKS}]+[{MARKS}][^\S\n]*(?=\n|$)")
_TOKEN = regex.compile(r"(?<![^\s\"“”'’‘(\[,;:¿¡«/–—-])[\p{L}\p{M}\p{N}]+(?=[\s\"“”'’‘)\],;:.!?…»/–—-]|$)")
_COMPOUND = regex.compile(r"(?<![\w-])\p{L}{2,}-\p{L}{2,}(?![\w-])")
_CODE = regex.compile(r"^(?:\p{Lu}\d[\dOIlSB]*|[\dOIlSB]+|\d+\p{L}{1,2}|[0-9a-f]{8}|[a-z]\d\p{L}?\d*\p{L}?)$")
_NUMBER = r"(?:[\dlOoISBi]{1,4}|[ivxlcdm1]{1,7})"
_LABEL = r"(?:p\.|pp\.|pg\.|page|seite|s\.|trang|pág\.|página)"
_PAGE = regex.compile(rf"^[\s\-–—|\[(~•*=_]*(?:{_LABEL}\s*)?({_NUMBER})(?:\s*(?:/|of|de|von|sur)\s*{_NUMBER})?[\s\-–—|\])~•*=_]*$", regex.I)
_TAIL = regex.compile(rf"^(.*\S)\s{{3,}}([\-–—|\[( ]*(?:{_LABEL}\s*)?{_NUMBER}(?:\s*(?:/|of|de|von|sur)\s*{_NUMBER})?[\s\-–—|\])]*)$", regex.I)
_ITEM, _HEADED, _FIGURES = regex.compile(r"\d+[.)]\s"), regex.compile(r"\p{L}+ \d+:"), regex.compile(r"[\dlOoISBivxcdm]+")
_MARK_SET = frozenset(MARKS)
_ENDS = frozenset(".!?…:;\"”’»)")
_DIGITS = frozenset("0123456789lOoISBivxcdmIVXLCDM")
_APART = str.maketrans(dict.fromkeys("\"“”'’‘([,;:¿¡«/–—-)]»", " "))


# -- words ------------------------------------------------------------------------------------------------------------

@functools.lru_cache(maxsize=1 << 18)
def _word(token: str) -> str | None:
    """A token in lower case, if it is a word: three letters or digits at least, more letters than not, no code."""
    token = token.rstrip(".!?…")
    if len(token) < 3 or not token.isalnum() and not regex.fullmatch(r"[\p{L}\p{M}\p{N}]+", token):
        return None
    if not token.isalpha() and (_CODE.match(token) or sum(map(str.isalpha, token)) * 2 <= len(token)) or token.isascii() and _CODE.match(token):
        return None
    return unicodedata.normalize("NFKC", token).lower()


def words_of(text: str) -> set[str]:
    """Words of a text in lower case, without parts of file names and codes and without the halves of broken words."""
    if text[-1:] in MARKS or any(m + after in text for m in MARKS for after in ("\n", " \n", "\r\n", "\t\n")):
        text = _BROKEN_END.sub(" ", text)
    return {w for w in map(_word, set(text.translate(_APART).split())) if w}


def grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return sorted({padded[k : k + 3] for k in range(len(padded) - 2)})


_BY_MISREAD: dict[str, list[str]] = {}
for _a, _b in MISREAD:
    _BY_MISREAD.setdefault(_a, []).append(_b)


def explained(word: str, other: str) -> tuple[int, int]:
    """(misreadings, other edits) of the cheapest way from ``other`` to ``word``; an edit counts as six misreadings."""
    edit, rows, columns = 6, len(word), len(other)
    if abs(rows - columns) > 3:
        return 9, 9
    best = [[10**6] * (columns + 1) for _ in range(rows + 1)]
    best[0][0] = 0
    for i in range(rows + 1):
        for j in range(columns + 1):
            now = best[i][j]
            if now >= 10**6:
                continue
            if i < rows and j < columns:
                step = now + (0 if word[i] == other[j] else edit)
                best[i + 1][j + 1] = min(best[i + 1][j + 1], step)
            if i < rows:
                best[i + 1][j] = min(best[i + 1][j], now + edit)
            if j < columns:
                best[i][j + 1] = min(best[i][j + 1], now + edit)
            for size in (1, 2):
                for true in _BY_MISREAD.get(word[i : i + size], ()) if i + size <= rows else ():
                    if other.startswith(true, j):
                        best[i + size][j + len(true)] = min(best[i + size][j + len(true)], now + 1)
    total = best[rows][columns]
    return total % edit, total // edit


class Grams:
    """How many records hold the words of each trigram, as shares of all: how odd a spelling is in this corpus."""

    def __init__(self, counts: dict[str, int], total: int):
        self.counts, self.total = counts, max(1, total)

    def oddness(self, word: str, df: int, other: str) -> float:
        """Log ratio of the rarest trigram that ``word`` has instead of ``other``'s, its own records apart, to the rarest of those."""
        mine, others = set(grams(word)), set(grams(other))

        def rarest(of: set[str], own: int) -> float:
            return min((max(0, self.counts.get(g, 0) - own) for g in of), default=0) / self.total + 1e-6

        return float(np.log(rarest(mine - others, df) / rarest(others - mine, 0)))


def pair_features(word: str, df: int, other: str, ratio: float, known: Grams) -> list[float]:
    """Features of a word in ``df`` records and one ``ratio`` times as frequent; none depends on the size of the corpus."""
    misread, edits = explained(word, other)
    shared = len(set(grams(word)) & set(grams(other)))
    digit = any(c.isdigit() for c in word)
    return [misread, edits, float(digit), np.log(ratio), known.oddness(word, df, other), len(word), shared / len(grams(word)), float(word[0] == other[0])]


def misread_word(word: str, dice: random.Random) -> str:
    """A word with one or two misreadings put in."""
    for _ in range(1 + (dice.random() < 0.15)):
        places = [(k, a, b) for a, b in MISREAD for k in range(len(word)) if word.startswith(b, k)]
        if not places:
            return word
        k, a, b = dice.choice(places)
        word = word[:k] + a + word[k + len(b) :]
    return word


def learn_words(vocabulary: dict[str, int], known: Grams) -> Boosted:
    """The ranking model, from misread common words and, as words that need no correction, real words beside rarer ones.

    Common words that may themselves be misreadings, being far rarer than a word that explains them, teach nothing.
    """
    dice = random.Random(7)

    def draw(most: float) -> float:
        return float(np.exp(dice.uniform(np.log(RATIO), np.log(most))))

    def indexed(words: dict[str, int]) -> dict[str, list[str]]:
        index: dict[str, list[str]] = {}
        for word in words:
            for g in grams(word):
                index.setdefault(g, []).append(word)
        return index

    def candidates(word: str) -> list[str]:
        counts = Counter(c for g in grams(word) for c in index.get(g, ()))
        least = max(1, len(word) - 5)
        return [c for c, n in counts.most_common(12) if n >= least and c != word]

    index = indexed(vocabulary)
    doubtful = {w for w, n in vocabulary.items() if len(w) >= SHORTEST and any(vocabulary[c] >= RATIO * n and explained(w, c)[1] == 0 for c in candidates(w))}
    vocabulary = {w: n for w, n in vocabulary.items() if w not in doubtful}
    index = indexed(vocabulary)
    x, y = [], []
    for word in sorted(vocabulary):
        if len(word) < SHORTEST:
            continue
        df, wrong = vocabulary[word], misread_word(word, dice)
        if wrong != word and wrong not in vocabulary:
            ratio = draw(RAREST)
            for c in sorted({*candidates(wrong), word}):
                x.append(pair_features(wrong, 0, c, ratio * vocabulary[c] / df, known))
                y.append(c == word)
            for _ in range(DRAWS):
                x.append(pair_features(word, df, wrong, draw(RESEMBLING), known))
                y.append(False)
        for c in candidates(word)[:6]:
            if df < RATIO * vocabulary[c] and vocabulary[c] < RATIO * df:
                x.append(pair_features(word, df, c, draw(RESEMBLING), known))
                y.append(False)
    return Boosted(depth=4, rounds=60).fit(np.array(x), np.array(y, dtype=float)) if x else Boosted().fit(np.zeros((2, 8)), np.array([0.0, 0.0]))


# -- lines ------------------------------------------------------------------------------------------------------------

class _Folding(dict):
    """Characters that all forms of one running header share: no figures, blanks, punctuation and easily confused letters."""

    def __missing__(self, code: int) -> int | None:
        c = chr(code)
        gone = c.isspace() or c.isdigit() or unicodedata.category(c)[0] in "PSN" or c in "ilojczse"
        self[code] = None if gone else code
        return self[code]


_FOLDING = _Folding()


def page_value(text: str) -> int | None:
    """The number on a page-number line, read with the usual confusions undone."""
    match = _PAGE.match(text)
    if not match:
        return None
    raw = match.group(1)
    if regex.fullmatch(r"[ivxlcdm]+", raw):
        values = [{"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}[c] for c in raw]
        return sum(-a if a < b else a for a, b in zip(values, [*values[1:], 0]))
    plain = raw.translate(str.maketrans("lIioOSB", "1110058"))
    return int(plain) if plain.isdigit() else None


def _page_like(line: str) -> tuple[str, int, str] | None:
    """(kind of page number, value, the line without it) of a line that is or ends in one."""
    last = line.rstrip(" -–—|])~•*=_")[-1:]
    if last not in _DIGITS or not _DIGITS.issuperset(line.rsplit(None, 1)[-1].strip("-–—|[]()/.~•*=_")) and "/" not in line[-12:]:
        return None
    match = _TAIL.match(line)
    part = match.group(2) if match else line
    value = page_value(part) if match or len(line) < 40 else None
    if value is None:
        return None
    return ("tail:" if match else "own:") + _FIGURES.sub("9", part.strip().lower()), value, match.group(1) if match else ""


#: Features of a line.
N_LINE = 32


def _numbered(keys: list) -> np.ndarray:
    """Small numbers in place of keys."""
    seen: dict = {}
    return np.array([seen.setdefault(k, len(seen)) for k in keys], dtype=np.int64)


def _grouped_median(values: np.ndarray, groups: np.ndarray, n: int, default: float) -> np.ndarray:
    out = np.full(n, default)
    if len(values):
        order = np.lexsort((values, groups))
        values, groups = values[order], groups[order]
        starts = np.searchsorted(groups, np.arange(n))
        counts = np.bincount(groups, minlength=n)
        some = np.flatnonzero(counts)
        out[some] = (values[starts[some] + (counts[some] - 1) // 2] + values[starts[some] + counts[some] // 2]) / 2
    return out


def line_features(pages: list[list[str]]) -> np.ndarray:
    """Features of every line of several texts for the furniture classifier, one pass over all lines."""
    sizes = np.array([len(p) for p in pages], dtype=np.int64)
    texts = [line.strip() for page in pages for line in page]
    total, n = len(texts), len(pages)
    if not total:
        return np.empty((0, N_LINE))
    of = np.repeat(np.arange(n), sizes)
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    end = start + np.repeat(sizes, sizes)
    at = np.arange(total)
    length = np.array([len(t) for t in texts], dtype=float)
    shown = length > 0
    width = _grouped_median(length[length > 25], of[length > 25], n, 40.0)[of]
    found = [_page_like(t) if t else None for t in texts]
    paged = np.array([f is not None for f in found])
    own = np.array([f is not None and f[0][0] == "o" for f in found])
    folded = [(f[2] if f else t).lower().translate(_FOLDING) for f, t in zip(found, texts)]
    some = np.array([len(f) >= 2 for f in folded])
    group = _numbered(list(zip(of.tolist(), folded)))
    repeats = np.where(some, np.bincount(group, weights=some & (length < 200))[group], 0.0)
    same = _numbered([(k, f[2] if f else t) for k, f, t in zip(of.tolist(), found, texts)])
    whole = np.where(length > 3, np.bincount(same)[same], 0.0)
    first_word = _numbered([(k, t.split(" ", 1)[0]) for k, t in zip(of.tolist(), texts)])
    starts = np.where(shown, np.bincount(first_word)[first_word], 0.0)

    rising, of_kind, apart = np.zeros(total), np.zeros(total), np.zeros(total)
    places = np.flatnonzero(paged)
    if len(places):
        kind = _numbered([(of[k], found[k][0]) for k in places])
        value = np.array([found[k][1] for k in places], dtype=float)
        order = np.argsort(kind, kind="stable")
        follows = kind[order][1:] == kind[order][:-1]
        step = np.diff(value[order])
        rises = np.bincount(kind[order][1:], weights=follows & (step > 0) & (step <= 2), minlength=kind.max() + 1)
        count = np.bincount(kind)
        gaps = np.bincount(kind[order][1:], weights=np.where(follows, np.diff(places[order]), 0), minlength=kind.max() + 1)
        rising[places] = (rises / np.maximum(1, count - 1))[kind]
        of_kind[places] = count[kind]
        apart[places] = (gaps / np.maximum(1, count - 1))[kind]
    pages_in = np.bincount(of, weights=paged, minlength=n)[of]
    repeated_in = np.bincount(of, weights=(repeats >= 2) & shown, minlength=n)[of]
    exact_in, rising_in = np.zeros(n), np.zeros(n)
    np.maximum.at(exact_in, of, np.where(own, 0.0, whole))
    np.maximum.at(rising_in, of, np.where(of_kind > 1, rising, 0.0))

    # the nearest lines before and after that are neither page numbers nor repeated
    plain = shown & ~paged & (repeats < 2)
    before = np.maximum.accumulate(np.where(plain, at, -1))
    before = np.concatenate(([-1], before[:-1]))
    after = np.minimum.accumulate(np.where(plain, at, total)[::-1])[::-1]
    after = np.concatenate((after[1:], [total]))
    has_before, has_after = before >= start, after < end
    ends = np.array([t[-1:] in _ENDS for t in texts])
    small = np.array([t[:1].islower() for t in texts])
    b, a = np.where(has_before, before, 0), np.where(has_after, after, 0)
    stops = has_before & ends[b]
    small_after = has_after & small[a]
    long_before = np.where(has_before, length[b], 0) / width
    cutting = has_before & ~ends[b] & (small_after | (long_before > 0.7))

    near_page, near_repeats = np.zeros(total, dtype=bool), np.zeros(total)
    for step in (-2, -1, 1, 2):
        other = np.clip(at + step, 0, total - 1)
        inside = (at + step >= start) & (at + step < end)
        near_page |= inside & paged[other]
        near_repeats = np.maximum(near_repeats, np.where(inside, repeats[other], 0))
    blank_before, blank_after = (at > start) & ~shown[np.maximum(at - 1, 0)], (at + 1 < end) & ~shown[np.minimum(at + 1, total - 1)]
    bullet = np.array([t[:1] in ("#", "├", "│", "└", "•", "*", "-") or t[:1].isdigit() and bool(_ITEM.match(t)) for t in texts])
    mark = np.array([t.endswith(":") or ":" in t and bool(_HEADED.match(t)) for t in texts])
    upper = np.array([t.isupper() for t in texts])
    # of all forms of one line together: how many cut a sentence, and how far they are apart
    forms = _numbered([(k, "", f[0]) if f and not f[2] else (k, g) for k, g, f in zip(of.tolist(), folded, found)])
    size = np.bincount(forms)
    cuts_all = (np.bincount(forms, weights=cutting) / size)[forms]
    order = np.argsort(forms, kind="stable")
    gap = np.where(forms[order][1:] == forms[order][:-1], np.diff(order), 0)
    gap_all = (np.bincount(forms[order][1:], weights=gap, minlength=len(size)) / np.maximum(1, size - 1))[forms]
    dash = np.array([t[-1:] in MARKS and bool(t) for t in texts])
    digits = np.array([sum(map(str.isdigit, t)) for t in texts]) / np.maximum(1, length)
    n_shown = np.maximum(1, np.bincount(of, weights=shown, minlength=n))
    long_in = (np.bincount(of, weights=length > 0.6 * width, minlength=n) / n_shown)[of]
    return np.stack([
        own, paged & ~own, rising, of_kind, repeats, whole, cutting, small_after, stops, length / width, long_before, near_page, near_repeats, blank_before, blank_after, bullet,
        mark, ends, (end - start), starts, upper, (at - start) / (end - start), pages_in, repeated_in, apart, exact_in[of], rising_in[of],
        cuts_all, gap_all, dash, digits, long_in,
    ], axis=1).astype(float)


def break_candidates(lines: list[str], skipped: np.ndarray) -> list[tuple[int, int, str, str, str]]:
    """(line, following line, first half, mark, second half) where a line may end in a broken word; furniture is passed over."""
    out = []
    for k, line in enumerate(lines):
        if line.rstrip()[-1:] not in _MARK_SET or skipped[k]:
            continue
        match = _BREAK.search(line)
        if not match:
            continue
        j = k + 1
        while j < len(lines) and (skipped[j] or not lines[j].strip()):
            j += 1
        if j < len(lines) and (start := _START.match(lines[j])):
            out.append((k, j, match.group(1), match.group(2), start.group(1)))
    return out


def break_features(first: str, mark: str, second: str, length: float, joined: float, compound: float, left: float, right: float) -> list[float]:
    """Features of a possible break; the frequencies of the words are shares of the records."""
    return [float(mark == "-"), float(second[:1].islower()), len(first), len(second), length, *(np.log(share + 1e-6) for share in (joined, compound, left, right))]


def _wrap(words: list[str], width: int, broken: float, mark: str, dice: random.Random) -> tuple[list[str], list[int]]:
    """Lines of at most ``width`` characters, and which of them end in a broken word."""
    lines, breaks, now = [], [], ""
    for word in words:
        if len(now) + 1 + len(word) > width and now:
            room = width - len(now) - 2
            if len(word) >= 6 and word.isalpha() and room >= 3 and dice.random() < broken:
                at = dice.randint(2, min(room, len(word) - 2))
                lines.append(f"{now} {word[:at]}{mark}")
                breaks.append(len(lines) - 1)
                now = word[at:]
                continue
            lines.append(now)
            now = word
        else:
            now = f"{now} {word}".strip()
    return [*lines, now], breaks


def made_lists(sentences: list[str], compounds: list[str], dice: random.Random) -> list[str]:
    """Lines of a list, table, log, tree or record made of the corpus's words, none of them furniture."""
    words = [w for w in (x.strip(".,;:()").lower() for s in dice.sample(sentences, min(len(sentences), 10)) for x in s.split()) if w.isalpha()] or ["item"]
    if dice.random() < 0.6:  # rows of one form: the same words with other values
        words, compounds = dice.sample(words, min(len(words), dice.randint(2, 6))), dice.sample(compounds, min(len(compounds), 2))
    shapes = dice.sample(["A999", "A99-9", "aa99", "A9999A", "99a9a9a9", "9999-99-99", "a9a9", "A9.99"], 2)
    code = lambda: "".join(dice.choice({"A": "ABCDEFGHKMNPRSTX", "a": "abcdefghkmnpqrtxyz", "9": "0123456789"}.get(c, c)) for c in dice.choice(shapes))
    name = lambda: f"{dice.choice(words)}{dice.choice('_-')}{dice.choice(words)}.{dice.choice(['txt', 'pdf', 'dat', 'xml', 'log'])}"
    number = lambda: str(dice.randint(1, 10 ** dice.randint(1, 4)))
    kinds = {
        "sentence": lambda: [dice.choice(sentences)], "numbered": lambda: [f"{k}. {s}" for k, s in enumerate(dice.sample(sentences, min(len(sentences), dice.randint(2, 6))), 1)],
        "bullets": lambda: [f"{dice.choice('-*•')} {dice.choice(words)} {name()}" for _ in range(dice.randint(2, 5))], "pair": lambda: [f"{dice.choice(words).capitalize()}: {dice.choice([number(), code(), dice.choice(words)])}"],
        "cells": lambda: [dice.choice(["\t", " | ", ", "]).join(dice.choice([number(), code(), dice.choice(words)]) for _ in range(dice.randint(2, 5)))], "column": lambda: [dice.choice(words), *(number() for _ in range(dice.randint(1, 3)))],
        "codes": lambda: [f"{dice.choice(words)} {code()}, {dice.choice(words)} {code()}"], "file": lambda: [f"{dice.choice(words).capitalize()} {code()} {dice.choice(words)} {name()}"],
        "log": lambda: [f"{dice.randint(10, 23)}:{dice.randint(10, 59)} {dice.choice(words)} {number()}"], "tree": lambda: [dice.choice(["├── ", "│   ├── ", "└── "]) + name() for _ in range(dice.randint(2, 5))],
        "paired": lambda: [f"{dice.choice(dice.choice([compounds or words, words])).split('-')[0]}-", f"{dice.choice(['and', 'or', 'und', 'oder', 'et', 'ou', 'y', 'o', 'và'])} {dice.choice(compounds or words)} {dice.choice(words)}"],
        "mark": lambda: ["", f"{dice.choice(['Page', 'Slide', '## ' + dice.choice(words).capitalize()])} {dice.randint(1, 9)}:", ""],
    }
    mix = dice.sample(sorted(kinds), dice.randint(1, 5)) + (["paired"] if dice.random() < 0.3 else [])
    lines = [f"{dice.choice(words).capitalize()} {dice.choice(words)} {dice.randint(1950, 2030)}"] if dice.random() < 0.7 else []
    for _ in range(dice.randint(3, 20)):
        lines += kinds[dice.choice(mix)]()
    return lines


def made_page(sentences: list[str], compounds: list[str], dice: random.Random) -> tuple[list[str], list[bool], set[int]]:
    """(lines, which are furniture, which end in a broken word) of a made page."""
    if dice.random() < 0.45:
        data = made_lists(sentences, compounds, dice)
        return data, [False] * len(data), set()
    words = " ".join(dice.choices(sentences, k=dice.randint(3, dice.choice([8, 12, 30]))) if sentences else []).split()
    if not words:
        return [""], [False], set()
    names = [w.strip(".,") for w in words if w[:1].isupper()] or ["Report"]
    scanned = dice.random() < 0.6
    mark = dice.choice(["-", "-", "-", "¬", "‐", "­"])
    lines, breaks = _wrap(words, dice.randint(42, 95), 0.5 if scanned and dice.random() < 0.75 else 0.0, mark, dice)
    pick = lambda: dice.choice(words).strip(".,")
    first = dice.randrange(len(words))
    title = dice.choice([
        f"{pick().capitalize()} {dice.choice(names)} {dice.randint(1900, 2030)}", f"{pick()} {pick()} {pick()}".upper(), f"{dice.choice(names)} {pick()} | {pick()}", f"{pick().capitalize()} - {dice.choice(names)}",
        " ".join(w.strip(".,;:!?") for w in words[first : first + dice.randint(3, 6)]).capitalize(), " ".join(dice.choice(names).upper()), f"{dice.choice(names)}, {pick()} {pick()} {pick()}", f"{dice.choice(names)} {pick()} • {dice.choice('ABCDEF')}{dice.randint(10, 999)}"])
    form = dice.choice(["{}", "— {} —", "- {} -", "[{}]", "({})", "p. {}", "pp. {}", "S. {}", "Page {} of 173", "Seite {}", "Trang {}", "Página {}", "{} / 99", "{} |", "| {}", "Page {}"])
    number, roman, stride = dice.randint(1, 400), dice.random() < 0.12, dice.choice([1, 1, 1, 2])
    numerals = ["i", "ii", "iii", "iv", "v", "vi", "vii", "viii", "ix", "x", "xi", "xii", "xiii", "xiv", "xv", "xvi", "xvii"]

    def misread(text: str) -> str:
        return "".join(dice.choice([c, c, c, {"1": "l", "0": "O", "5": "S"}.get(c, c)]) for c in text)

    out: list[tuple[str, bool, int | None]] = []
    with_header, with_number, same_line = dice.random() < 0.75, dice.random() < 0.75, dice.random() < 0.5
    every = dice.randint(3, 9)
    if dice.random() < 0.35 and not scanned:
        out.append((title, False, None))
        if dice.random() < 0.5:
            out.append(("", False, None))
    for k, line in enumerate(lines):
        if scanned and (with_header or with_number) and k % every == 0 and (k or dice.random() < 0.5):
            page = form.format(numerals[(number + k) % 17] if roman else number)
            page = misread(page) if dice.random() < 0.3 else page
            number += stride
            blank = [("", False, None)] if dice.random() < 0.3 else []
            head = misread(title) if dice.random() < 0.15 else title
            if with_header and with_number and same_line:
                out += [(f"{head}    {page}", True, None)]
            else:
                out += ([(page, True, None)] if with_number and k else []) + blank + ([(head, True, None)] if with_header else [])
        out.append((line, False, k))
        if not scanned and dice.random() < 0.05:
            out += [("", False, None)]
    if dice.random() < 0.5:
        at = dice.choice([0, len(out)])
        if not scanned or at:
            out[at:at] = [(e, False, None) for e in made_lists(sentences, compounds, dice)]
    if dice.random() < 0.35 and not scanned:
        label = dice.choice([f"## {pick().capitalize()}", "Page", "Slide"])
        step, n = max(2, len(out) // 4), 1
        for at in reversed(range(0, len(out), step)):
            out[at:at] = [("", False, None), (f"{label} {len(range(0, len(out), step)) - n}" + (":" if label in ("Page", "Slide") else ""), False, None)] + ([("", False, None)] if label[0] == "#" else [])
            n += 1
    marked = [k for k, x in enumerate(out) if x[1]]
    if len(marked) == 1 and _page_like(out[marked[0]][0]) is None:
        out[marked[0]] = (out[marked[0]][0], False, None)  # a single title is no running header
    done = set(breaks)
    return [x[0] for x in out], [x[1] for x in out], {k for k, x in enumerate(out) if x[2] in done and x[2] is not None}


def learn_lines(sentences: list[str], vocabulary: dict[str, int], records: int, real: list[list[str]], pages: int = 3000) -> tuple[Boosted, Boosted]:
    """The classifiers for furniture and for broken words, from made pages and from real texts (as lines).

    The lines of real texts in which no line repeats and no page numbers rise are no furniture. ``vocabulary`` counts
    the records that hold a word, of ``records``.
    """
    dice = random.Random(11)
    compounds = sorted(w for w in vocabulary if "-" in w)
    made = [made_page(sentences, compounds, dice) for _ in range(pages if sentences else 0)]
    features = line_features([m[0] for m in made])
    labels = np.array([f for m in made for f in m[1]], dtype=float)
    # of each page all furniture and some other lines, so that long pages do not outweigh many short ones
    shown = np.array([bool(line.strip()) and (marked or dice.random() < 18 / len(m[0])) for m in made for line, marked in zip(m[0], m[1])], dtype=bool)
    x, y = [features[shown]] if len(shown) else [], [labels[shown]] if len(shown) else []
    f, at = line_features(real), 0
    for lines in real:
        own = f[at : at + len(lines)]
        at += len(lines)
        if len(lines) > 1 and not ((own[:, 5] >= 2) & (own[:, 0] == 0)).any() and not ((own[:, 2] > 0) & (own[:, 3] > 1)).any():
            kept = own[[bool(line.strip()) and dice.random() < 18 / len(lines) for line in lines]]
            x.append(kept)
            y.append(np.zeros(len(kept)))
    furniture = Boosted(depth=5, rounds=80).fit(np.concatenate(x), np.concatenate(y)) if made else Boosted().fit(np.zeros((2, N_LINE)), np.zeros(2))
    bx, by = [], []
    rate = lambda w: vocabulary.get(w, 0) / max(1, records)
    for lines, marked, broken in made:
        width = _median_width(lines)
        for k, _, first, mark, second in break_candidates(lines, np.array(marked)):
            shares = [rate(w) for w in ((first + second).lower(), f"{first}-{second}".lower(), first.lower(), second.lower())]
            if k in broken and dice.random() < 0.25:
                shares[0] = 0.0
            bx.append(break_features(first, mark, second, len(lines[k]) / width, *shares))
            by.append(k in broken)
    for word in compounds:
        first, second = word.rsplit("-", 1)
        for _ in range(3):
            bx.append(break_features(first, "-", second, 0.9 + 0.1 * dice.random(), rate(first + second), rate(word), rate(first), rate(second)))
            by.append(False)
    breaks = Boosted(depth=4, rounds=50).fit(np.array(bx), np.array(by, dtype=float)) if bx else Boosted().fit(np.zeros((2, 9)), np.zeros(2))
    return furniture, breaks


def _median_width(lines: list[str]) -> float:
    return float(np.median([len(t) for t in lines if len(t) > 25] or [40]))


# -- the operator -----------------------------------------------------------------------------------------------------

def repaired(text: str, furniture: set[int], joins: dict[int, int], fixes: dict[str, str]) -> str:
    """Continuous paragraphs: furniture dropped, broken words joined, misread words replaced, lines of a paragraph run together."""
    lines = text.split("\n")
    out, k = [], 0
    while k < len(lines):
        line = lines[k]
        if k in furniture:
            k += 1
            continue
        while k in joins:
            line = _BREAK.sub(lambda m: m.group(1), line) + lines[joins[k]].lstrip()
            k = joins[k]
        out.append(line)
        k += 1

    def fix(match: regex.Match) -> str:
        token = match.group()
        right = fixes.get(unicodedata.normalize("NFKC", token).lower())
        if not right:
            return token
        return right.upper() if token.isupper() and len(token) > 1 else right.capitalize() if token[:1].isupper() else right

    joined: list[str] = []
    width = float(np.median([len(t) for t in out if len(t) > 25] or [1e9]))
    for line in out:
        if joined and joined[-1] and line.strip() and len(joined[-1].rsplit("\n", 1)[-1]) > 0.6 * width and joined[-1][-1] not in ":" and (furniture or joins):
            joined[-1] = joined[-1].rstrip() + " " + line.lstrip()
        else:
            joined.append(line)
    return _TOKEN.sub(fix, "\n".join(joined))


def misread_words(words: DataFrame, sampled: dict[str, int]) -> DataFrame:
    """(word, fix) of the misread words of a table (word, df); ``sampled`` are frequent ones to learn from.

    Rare words meet frequent ones through an inverted join on character trigrams. A word and its misreading share all
    but ``CHANGED`` of the word's trigrams, so they share one of the rarest of each: only those are joined, by length.
    Every pair that misreadings alone explain is ranked.
    """
    spelled = words.where(~F.col("word").contains("-") & (F.char_length("word") >= 3)).withColumn("len", F.char_length("word"))
    padded = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    spelled = spelled.withColumn("grams", F.array_distinct(F.transform(F.sequence(F.lit(1), F.col("len")), lambda k: F.substring(padded, k, F.lit(3)))))
    spelled = written(spelled, "spelled")
    frequency = cut(spelled.select(F.explode("grams").alias("gram"), "df").groupBy("gram").agg(F.sum("df").alias("n"), F.count(F.lit(1)).alias("words")))
    total = frequency.agg(F.coalesce(F.sum("n"), F.lit(1))).first()[0]
    seen = frequency.where(F.col("n") >= UNSEEN * total)  # at most one over UNSEEN of them
    counts = Grams({r["gram"]: r["n"] for r in seen.select("gram", "n").toLocalIterator()}, total)
    ranking = words.sparkSession.sparkContext.broadcast((learn_words({w: n for w, n in sampled.items() if "-" not in w}, counts), counts))
    limit = spelled.agg(F.max("df")).first()[0] or 0

    def rarest(of: DataFrame, prefix: str, most: Column) -> DataFrame:
        """The rarest trigrams of each word, as many as a pair that shares enough must have one of in common."""
        exploded = of.select("word", "df", "len", F.explode("grams").alias("gram")).join(frequency.select("gram", "words"), "gram")
        ordered = exploded.groupBy("word", "df", "len").agg(F.array_sort(F.collect_list(F.struct("words", "gram"))).alias("l"))
        return ordered.select(F.explode(F.slice("l", F.lit(1), most)).alias("x"), *[F.col(c).alias(f"{prefix}_{c}") for c in ("word", "df", "len")]).withColumn("gram", F.col("x.gram")).drop("x")

    rare = rarest(spelled.where((F.col("df") * RATIO <= limit) & (F.col("len") >= SHORTEST)), "r", F.least(F.col("len"), F.lit(CHANGED + 1)))
    known = rarest(spelled.where(F.col("df") >= RATIO), "c", F.least(F.col("len"), F.lit(CHANGED + 1 + LONGER)))
    rare = rare.withColumn("c_len", F.explode(F.sequence(F.greatest(F.col("r_len") - LONGER, F.lit(1)), F.col("r_len") + LONGER)))
    pairs = rare.join(known, ["gram", "c_len"]).where(F.col("r_df") * RATIO <= F.col("c_df")).select("r_word", "r_df", "c_word", "c_df").distinct()
    pairs = pairs.where(F.levenshtein("r_word", "c_word", 4) > 0)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, grams_ = ranking.value
        for batch in batches:
            pairs_ = [p for p in zip(*(batch.column(c).to_pylist() for c in ("r_word", "r_df", "c_word", "c_df"))) if explained(p[0], p[2])[1] == 0]
            scores = model.probability(np.array([pair_features(*p[:3], p[3] / p[1], grams_) for p in pairs_], dtype=float)) if pairs_ else np.empty(0)
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs_], pa.string()), pa.array([p[2] for p in pairs_], pa.string()), pa.array(scores, pa.float64())], names=["word", "fix", "score"])

    ranked = pairs.mapInArrow(rank, "word string, fix string, score double").where("score > 0.5")
    best = ranked.groupBy("word").agg(F.max_by("fix", F.struct("score", "fix")).alias("fix"))
    return cut(best)


_BREAKS = "array<struct<line:int,next:int,first:string,mark:string,second:string,length:double>>"
_FIXES = "array<struct<word:string,fix:string>>"


def repair_scans(df: DataFrame, kind: str, key: str, text: str, sent: int = SENT) -> DataFrame:
    """Columns (kind, key, n_furniture, n_joins, n_misread, original, repaired) of the records that bear traces of a scan.

    Null, empty and blank texts and null keys are left out; repeated rows come out once; records without traces are not
    returned; texts are read whole; other columns are ignored. The vocabulary and the frequencies come from all
    records; only the classifiers learn from a sample, of at most ``SAMPLE_RECORDS`` records (those with the smallest
    hash) and ``SAMPLE_WORDS`` words. A corpus too small to have frequent words yields joins and furniture only. Texts
    are read three times and not shuffled; only records with a possible trace are written and joined. The corrections
    are sent to all tasks up to ``sent`` of them, else joined with the words of the records.
    """
    spark = df.sparkSession
    rows = df.select(F.col(kind).cast("string").alias("kind"), F.col(key).cast("string").alias("id"), F.col(text).alias("text"))
    rows = rows.where(F.col("kind").isNotNull() & F.col("id").isNotNull() & F.col("text").rlike(r"\S"))

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                counts.update(words_of(t))
                if "-" in t:
                    counts.update({w.lower() for w in _COMPOUND.findall(t)})
                counts[""] += 1
            if len(counts) > 200_000:
                yield _counts(counts)
                counts.clear()
        yield _counts(counts)

    words = written(rows.select("text").mapInArrow(count_words, "word string, df bigint").groupBy("word").agg(F.sum("df").alias("df")), "words")
    n_records = (words.where("word = ''").first() or {"df": 0})["df"]
    words = words.where("word <> ''")
    sampled = {r["word"]: r["df"] for r in words.where(F.col("df") >= RATIO).orderBy(F.xxhash64("word"), "word").limit(SAMPLE_WORDS).collect()}
    sample = rows.where(F.length("text") < 20000).select("text", F.xxhash64("id", "text").alias("h")).orderBy("h", "text").limit(SAMPLE_RECORDS).select("text").distinct().collect()
    texts = sorted(r["text"] for r in sample)
    sentences = sorted({s.strip() for t in texts if not regex.search(r"[\n\r]\S+[\n\r]", t) for s in regex.split(r"(?<=[.!?])\s+", t) if 30 < len(s) < 200 and "\n" not in s and s[:1].isupper()})
    line_models = spark.sparkContext.broadcast(learn_lines(sentences, sampled, n_records, [t.split("\n") for t in texts if "\n" in t]))
    fixes = misread_words(words, sampled)
    few = fixes.count() <= sent
    fix_of = spark.sparkContext.broadcast({r["word"]: r["fix"] for r in fixes.collect()} if few else None)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records with furniture, with lines that may end in a broken word, or with misread words (or any, if those are joined)."""
        model, known = line_models.value[0], fix_of.value
        for batch in batches:
            texts_ = batch.column("text").to_pylist()
            split = [t.split("\n") for t in texts_]
            many = [k for k, lines in enumerate(split) if len(lines) > 1]
            scores = model.probability(line_features([split[k] for k in many]))
            marks: list[np.ndarray] = [np.zeros(len(lines), dtype=bool) for lines in split]
            at = 0
            for k in many:
                own_ = scores[at : at + len(split[k])] * np.array([bool(line.strip()) for line in split[k]])
                marks[k] = (own_ > 0.5) & (own_.max() > SURE)
                at += len(split[k])
            out = []
            for k, lines in enumerate(split):
                width = _median_width(lines) if len(lines) > 1 else 1.0
                breaks = [{"line": i, "next": j, "first": a, "mark": m, "second": b, "length": len(lines[i]) / width} for i, j, a, m, b in break_candidates(lines, marks[k])] if len(lines) > 1 else []
                if known is None:
                    own = [{"word": w, "fix": None} for w in sorted(words_of(texts_[k]))]
                else:
                    own = [{"word": w, "fix": known[w]} for w in sorted(words_of(texts_[k])) if w in known]
                if own or breaks or marks[k].any():
                    out.append((k, np.flatnonzero(marks[k]).tolist(), breaks, own))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            taken = pa.array(columns[0], pa.int64())
            kinds = (
                pa.list_(pa.int32()), pa.list_(pa.struct([("line", pa.int32()), ("next", pa.int32()), ("first", pa.string()), ("mark", pa.string()), ("second", pa.string()), ("length", pa.float64())])),
                pa.list_(pa.struct([("word", pa.string()), ("fix", pa.string())])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(taken) for c in ("kind", "id", "text")), *(pa.array(c, t) for c, t in zip(columns[1:], kinds))], names=["kind", "id", "text", "furniture", "breaks", "fixes"])

    judged = rows.mapInArrow(judge, f"kind string, id string, text string, furniture array<int>, breaks {_BREAKS}, fixes {_FIXES}")
    name = ["kind", "id", "h"]
    judged = written(judged.withColumn("h", F.xxhash64("text")), "judged")
    breaks = judged.where(F.size("breaks") > 0).select(*name, F.explode("breaks").alias("b")).distinct()
    roles = F.array(*[F.struct(F.lit(r).alias("role"), F.lower(w).alias("word")) for r, w in (
        ("joined", F.concat("b.first", "b.second")), ("compound", F.concat("b.first", F.lit("-"), "b.second")), ("left", F.col("b.first")), ("right", F.col("b.second")))])
    looked = breaks.select(*name, "b", F.explode(roles).alias("r")).select(*name, "b", "r.role", "r.word").join(words, "word", "left")
    looked = looked.groupBy(*name, "b").agg(*[(F.coalesce(F.max(F.when(F.col("role") == r, F.col("df"))), F.lit(0)) / F.lit(max(1, n_records))).alias(r) for r in ("joined", "compound", "left", "right")])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = line_models.value[1]
        for batch in batches:
            rows_ = batch.to_pylist()
            x = [break_features(r["b"]["first"], r["b"]["mark"], r["b"]["second"], r["b"]["length"], r["joined"], r["compound"], r["left"], r["right"]) for r in rows_]
            kept = [r for r, p in zip(rows_, model.probability(np.array(x, dtype=float).reshape(len(x), 9))) if p > 0.5]
            columns = ([r["kind"] for r in kept], [r["id"] for r in kept], [r["h"] for r in kept], [r["b"]["line"] for r in kept], [r["b"]["next"] for r in kept])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.int32()))], names=["kind", "id", "h", "line", "next"])

    joins = looked.mapInArrow(decide, "kind string, id string, h bigint, line int, next int").groupBy(*name).agg(F.collect_list(F.struct("line", "next")).alias("joins"))
    traces = judged.drop("breaks").join(joins, name, "left")
    if not few:
        own = judged.select(*name, F.explode("fixes.word").alias("word")).join(fixes, "word").groupBy(*name).agg(F.collect_set(F.struct("word", "fix")).alias("fixes"))
        traces = traces.drop("fixes").join(own, name, "left")
    traces = traces.where((F.size("furniture") > 0) | F.col("joins").isNotNull() | (F.coalesce(F.size("fixes"), F.lit(0)) > 0))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                joined = {j["line"]: j["next"] for j in r["joins"] or ()}
                changes = {f["word"]: f["fix"] for f in r["fixes"] or ()}
                out.append((r["kind"], r["id"], len(r["furniture"]), len(joined), len(changes), r["text"], repaired(r["text"], set(r["furniture"]), joined, changes)))
            columns = list(zip(*out)) if out else [()] * 7
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "id", "n_furniture", "n_joins", "n_misread", "original", "repaired"])

    done = traces.select("kind", "id", "text", "furniture", "joins", "fixes").mapInArrow(apply, "kind string, id string, n_furniture int, n_joins int, n_misread int, original string, repaired string")
    return done.dropDuplicates(["kind", "id", "original"]).withColumnsRenamed({"kind": kind, "id": key})


def _counts(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "df"])
