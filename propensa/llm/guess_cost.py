"""What a string costs to guess: least bits over all ways to cut it up.

A dynamic program over the places of the string.  A segment is a word of a
ranked list (with capitals and substituted letters), a date or year, a repeat
of a shorter string, a walk over neighbouring keys or along the alphabet, or
one character by brute force.  The cost of a way is the sum of its segments'.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping

LONGEST_WORD, LONGEST_UNIT = 24, 8
#: Letters that are often written as other characters.
LEET = str.maketrans("430157@$!|+", "aeoistasilt")
#: Key rows of a US keyboard, and the alphabet as a row of its own.
KEY_ROWS = ("`1234567890-=", "\tqwertyuiop[]\\", "\tasdfghjkl;'", "\tzxcvbnm,./")
SHIFTED = str.maketrans("~!@#$%^&*()_+{}|:\"<>?", "`1234567890-=[]\\;',./")
ALPHABET = "abcdefghijklmnopqrstuvwxyz"
#: Bits of a character tried by brute force, by its kind; a letter has one more
#: where a string has both cases.
DIGIT_BITS, LETTER_BITS, MARK_BITS, OTHER_BITS = math.log2(10), math.log2(26), math.log2(33), math.log2(1 << 12)
YEAR = re.compile(r"19\d\d|20\d\d")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:(?:19|20)\d\d|\d\d)"
                  r"|(?:0[1-9]|1[0-2])([-/._]?)(?:0[1-9]|[12]\d|3[01])\3(?:(?:19|20)\d\d|\d\d)", re.ASCII)
#: Words that stand in for a secret or are tried first; they rank
#: before all others.
FIRST_TRIED = ("password passwd passphrase secret token key admin root user login guest test testing example sample "
               "default changeme change welcome letmein master none null nil true false undefined empty unknown your "
               "my here insert enter replace placeholder redacted hidden masked value string optional required "
               "localhost private public api access auth bearer basic dummy fake demo temp todo").split()


def _neighbours() -> dict[tuple[str, str], int]:
    """Direction between neighbouring keys: each row is half a key further
    right than the one above."""
    place = {c: (2 * x + y, y) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row) if c != "\t"}
    steps = {(2, 0): 0, (-2, 0): 1, (1, 1): 2, (-1, 1): 3, (1, -1): 4, (-1, -1): 5}
    at = {v: k for k, v in place.items()}
    found = {(c, at[x + dx, y + dy]): d for c, (x, y) in place.items() for (dx, dy), d in steps.items()
             if (x + dx, y + dy) in at}
    along = {(a, b): 6 for a, b in zip(ALPHABET, ALPHABET[1:])} | {(b, a): 7 for a, b in zip(ALPHABET, ALPHABET[1:])}
    return along | found


NEXT_KEY = _neighbours()
START_BITS, TURN_BITS = math.log2(len({a for a, _ in NEXT_KEY})), math.log2(8)


def brute_bits(c: str, letter: float = LETTER_BITS) -> float:
    if "0" <= c <= "9":
        return DIGIT_BITS
    if "a" <= c <= "z" or "A" <= c <= "Z":
        return letter
    return MARK_BITS if " " <= c <= "~" else OTHER_BITS


def case_bits(word: str) -> float:
    upper = sum("A" <= c <= "Z" for c in word)
    if not upper:
        return 0.0
    letters = sum(c.isalpha() for c in word)
    if upper >= letters or upper == 1 and "A" <= word[0] <= "Z":
        return 1.0
    return 1.0 + math.log2(math.comb(letters, upper))


def runs_of(value: str, period: int) -> list[int]:
    """For each place, how many characters from there on equal those one
    period later."""
    found = [0] * (len(value) + 1)
    for i in range(len(value) - period - 1, -1, -1):
        if value[i] == value[i + period]:
            found[i] = found[i + 1] + 1
    return found


def guess_bits(value: str, words: Mapping[str, float], repeats: bool = True) -> float:
    """Least bits of any segmentation.  ``words``: bits of each lower-case
    word.  A repeat starts where its run starts, or ends where it ends."""
    n = len(value)
    best = [0.0] + [math.inf] * n
    # case changes that alter the length would shift places
    folded = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    plain = folded.translate(LEET)
    mixed = LETTER_BITS + (any("a" <= c <= "z" for c in value) and any("A" <= c <= "Z" for c in value))
    keys = folded.translate(SHIFTED)
    periods = [(p, runs_of(value, p)) for p in range(1, min(LONGEST_UNIT, n // 2) + 1)] if repeats else []
    units: dict[str, float] = {}
    for i in range(n):
        here = best[i]
        best[i + 1] = min(best[i + 1], here + brute_bits(value[i], mixed))
        if plain[i].isalpha():
            for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
                if not plain[j - 1].isalpha():
                    break
                bits = words.get(folded[i:j])
                if bits is None and (bits := words.get(plain[i:j])) is not None:
                    bits += sum(a != b for a, b in zip(folded[i:j], plain[i:j]))
                if bits is not None:
                    best[j] = min(best[j], here + bits + case_bits(value[i:j]))
        if value[i].isdigit():
            if YEAR.match(value, i):
                best[i + 4] = min(best[i + 4], here + math.log2(200))
            if m := DATE.match(value, i):
                marks = 2.0 if any(m.groups()) else 0.0
                best[m.end()] = min(best[m.end()], here + math.log2(200 * 366) + marks)
        turns, before = 0, None
        for j in range(i + 1, n):          # a walk that ends with character j
            way = NEXT_KEY.get((keys[j - 1], keys[j]))
            if way is None:
                break
            turns, before = turns + (way != before), way
            if j - i >= 2:
                best[j + 1] = min(best[j + 1], here + START_BITS + turns * TURN_BITS + math.log2(j - i + 1))
            if turns > 8:                  # no cheaper than single characters
                break
        for period, run in periods:
            most = run[i] // period + 1
            if most < 2:
                continue
            unit = value[i:i + period]
            if unit not in units:
                units[unit] = guess_bits(unit, words, False)
            starts = i == 0 or value[i - 1] != value[i - 1 + period]
            for times in range(2, most + 1) if starts else (most,):
                j = i + times * period
                best[j] = min(best[j], here + units[unit] + math.log2(times))
    return best[n]


def word_bits(ranked: list[str]) -> dict[str, float]:
    """Bits of the words of a list by rank, after those tried first."""
    bits = {w: math.log2(k + 2) for k, w in enumerate(FIRST_TRIED)}
    for k, word in enumerate(ranked):
        bits.setdefault(word, math.log2(k + 2 + len(FIRST_TRIED)))
    return bits
