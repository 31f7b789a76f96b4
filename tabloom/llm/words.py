"""The word patterns of BPE tokenizers as finite-state transducers, run over many texts at once.

A pattern is compiled to a deterministic transducer over character classes, whose transitions
tell where words begin. A batch of text is dealt into equal chunks; every chunk gives the map
from each state it may begin in to the state it ends in, and a parallel prefix scan composes
the maps, which tells each chunk's true first state. All chunks then run side by side and emit
their word starts. A chunk's last characters alone give its map where they lead from every state
to the same one; they do once a word ends or begins there.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LANES = 4_096       # chunks that run side by side
LAST = 32           # characters of a chunk from which its map is sought first
KEPT = 300_000      # words that a task remembers
LONGEST = 64        # characters of a word that is remembered

# Character classes: letters that matter after an apostrophe apart from the rest.
LETTER, STMD, RV, E, EL, NUMBER, SPACE, WHITE, APOSTROPHE, OTHER, END = range(11)
CLASSES = 11
LETTERS = (LETTER, STMD, RV, E, EL)

# States, by the word that is open: none, letters, numbers, other marks; one space, several
# white characters with a space last, one white character, several with no space last;
# an apostrophe; an apostrophe and r or v, or l.
(NONE, LETS, NUMS, MARKS, SPACE1, SPACES, WHITE1, WHITES, QUOTE, QUOTE_RV, QUOTE_L) = range(11)
STATES = 11
HERE, BEFORE = 1, 2     # what a transition emits: a word begins here, one character before


def _opened(kind: int) -> int:
    if kind in LETTERS:
        return LETS
    return {NUMBER: NUMS, SPACE: SPACE1, WHITE: WHITE1, APOSTROPHE: QUOTE, OTHER: MARKS,
            END: NONE}[kind]


def _lower_words(state: int, kind: int) -> tuple[int, int]:
    """The pattern of lower-casing BPE: white space and digits are words of one character."""
    if kind in (NUMBER, SPACE, WHITE):
        pending = BEFORE if state in (QUOTE_RV, QUOTE_L) else 0
        return NONE, HERE | pending
    return _byte_level(state, kind)


def _byte_level(state: int, kind: int) -> tuple[int, int]:
    """The usual pattern of byte-level BPE: the next state, and what is emitted."""
    fresh = _opened(kind), HERE
    joined = {NUMBER: NUMS, OTHER: MARKS, APOSTROPHE: MARKS}.get(kind, LETS)
    blank = kind in (SPACE, WHITE)
    if kind == END:     # nothing may reach across; a pending 'r, 'v or 'l was no contraction
        return NONE, HERE | (BEFORE if state in (QUOTE_RV, QUOTE_L) else 0)
    if state == LETS:
        return (LETS, 0) if kind in LETTERS else fresh
    if state == NUMS:
        return (NUMS, 0) if kind == NUMBER else fresh
    if state == MARKS:
        return (MARKS, 0) if kind in (OTHER, APOSTROPHE) else fresh
    if state in (SPACE1, SPACES, WHITE1, WHITES):
        if blank:
            return (SPACES if kind == SPACE else WHITES), 0
        if state == SPACE1:     # the space belongs to the word
            return joined, 0
        if state == SPACES:     # only the last of the spaces does
            return joined, BEFORE
        return fresh[0], HERE | (BEFORE if state == WHITES else 0)
    if state == QUOTE:
        if kind == STMD:
            return NONE, 0
        if kind in (RV, EL):
            return (QUOTE_RV if kind == RV else QUOTE_L), 0
        return (MARKS, 0) if kind in (OTHER, APOSTROPHE) else fresh
    if state in (QUOTE_RV, QUOTE_L):
        if kind == (E if state == QUOTE_RV else EL):
            return NONE, 0
        return (LETS, BEFORE) if kind in LETTERS else (fresh[0], HERE | BEFORE)
    return fresh


STEPS = {"byte_level": _byte_level, "lower_words": _lower_words}


@lru_cache(maxsize=4)
def transducer(pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Next state and output by ``state * CLASSES + class``."""
    step = STEPS[pattern]
    table = np.array([step(s, c) for s in range(STATES) for c in range(CLASSES)], np.uint8)
    return table[:, 0].copy(), table[:, 1].copy()


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    # Unicode's white space, and the letters of the contractions.
    white = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
             0x205F, 0x3000]
    out[white] = WHITE
    for chars, kind in ((" ", SPACE), ("stmd", STMD), ("rv", RV), ("e", E), ("l", EL),
                        ("'", APOSTROPHE)):
        out[[ord(c) for c in chars]] = kind
    return out


def composed(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps: row k is the maps 0 to k one after the other."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return maps


def _maps(grid: np.ndarray, go: np.ndarray, last: int) -> np.ndarray:
    """The state each chunk (a column) ends in, by the state it begins in (a row)."""
    while True:
        state = np.repeat(np.arange(STATES, dtype=np.intp)[:, None], grid.shape[1], axis=1)
        for row in grid[-last:]:
            state = go[state * CLASSES + row].astype(np.intp)
        if last >= len(grid) or (state == state[0]).all():
            return state
        last *= 4


def word_starts(kinds: np.ndarray, pattern: str = "byte_level",
                lanes: int = LANES) -> np.ndarray:
    """Where words begin in a text given as classes, ends included as words of their own."""
    go, emit = transducer(pattern)
    n = len(kinds)
    steps = max(1, -(-n // lanes))
    lanes = max(1, -(-n // steps))
    grid = np.full(lanes * steps, END, np.uint8)
    grid[:n] = kinds
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    state = _maps(grid, go, LAST)
    after = composed(np.ascontiguousarray(state.T).astype(np.uint8))[:, NONE]
    now = np.concatenate([[NONE], after[:-1]]).astype(np.intp)
    out = np.empty((steps, lanes), np.uint8)
    for t, row in enumerate(grid):
        at = now * CLASSES + row
        out[t] = emit[at]
        now = go[at].astype(np.intp)
    marks = out.T.reshape(-1)[:n]
    begins = marks & HERE
    begins[:-1] |= (marks[1:] & BEFORE) >> 1
    return np.nonzero(begins)[0]


class Words(NamedTuple):
    """The words of several texts, each distinct one once."""

    distinct: list[str]
    place: np.ndarray       # of each word among the distinct ones, in the order of the texts
    owner: np.ndarray       # the text it is from


ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers below n of an odd number and of its inverse, modulo 2**64."""
    base, out = 0xD1342543DE82EF95, []
    for b in (base, pow(base, -1, 2**64)):
        steps = np.full(n, b, np.uint64)
        steps[0] = 1
        with np.errstate(over="ignore"):
            out.append(np.multiply.accumulate(steps))
    return tuple(out)


def _keys(chars: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word: differences of prefix sums, so nothing is done per word."""
    up, down = _powers(max(3, 1 + (len(chars) >> 20)) << 20)
    with np.errstate(over="ignore"):
        value = (chars.astype(np.uint64) + np.uint64(1)) * ODD
        value ^= value >> np.uint64(29)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value * up[:len(chars)], dtype=np.uint64)])
        key = (sums[stops] - sums[starts]) * down[starts]
        return (key ^ (key >> np.uint64(32))) * ODD + (stops - starts).astype(np.uint64)


def words_of(texts: list[str], pattern: str) -> Words:
    """The words that the pattern finds; with ``lower_words``, white space is left out."""
    whole = "\0".join([*texts, ""])
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    chars = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = classes()[chars]
    kinds[ends] = END
    starts = word_starts(kinds, pattern)
    stops = np.append(starts[1:], len(whole))
    first = kinds[starts]
    real = first != END
    if pattern == "lower_words":
        real &= (first != SPACE) & (first != WHITE)
    starts, stops = starts[real], stops[real]
    place = pa.array(_keys(chars, starts, stops)).dictionary_encode().indices.to_numpy()
    index = np.empty(place.max(initial=-1) + 1, np.int64)
    index[place] = np.arange(len(place))
    distinct = [whole[a:b] for a, b in zip(starts[index].tolist(), stops[index].tolist(),
                                           strict=True)]
    return Words(distinct, place, np.searchsorted(ends, starts))


def forget(known: dict, new: list[str], distinct: int) -> None:
    """Drop new words that are too long to keep, and all of them once the memory is full: the
    words that come often are among the first. Where most words are new, start again."""
    full = len(known) > KEPT
    if full and 2 * len(new) > distinct:
        known.clear()
        return
    for word in new:
        if full or len(word) > LONGEST:
            del known[word]


def remember(known: dict, new: list[str], values: list, distinct: int) -> None:
    """Keep what ``forget`` would leave of the new words, without taking the others in first."""
    if len(known) + len(new) <= KEPT:
        known.update((w, v) for w, v in zip(new, values, strict=True) if len(w) <= LONGEST)
    elif 2 * len(new) > distinct:
        known.clear()
