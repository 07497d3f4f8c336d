"""Where the pieces of a text begin, found without a regular expression.

The piece pattern of the public byte-level vocabularies is read as a small
automaton over classes of code points. Each class is a function from state to
state; such functions compose associatively, so the state before every character
of a batch comes from one scan: blocks are composed side by side, the block
functions by a parallel prefix, and the prefix is applied to every place.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np

# The characters that Unicode gives the property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and numbers of Unicode 16 that Python's own table does not have yet.
NEW_LETTERS = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
               (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
               (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
               (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
               (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
               (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
# The endings the pattern splits off after an apostrophe.
SHORT_ENDINGS = "stmd"
LONG_ENDINGS = ("re", "ve", "ll")

# Classes. The last four differ by what follows: a character that is no white space, or not.
LETTER, NUMBER, OTHER, APOSTROPHE2, APOSTROPHE3, BLANK, BLANK_LAST, WHITE, WHITE_LAST, GAP = range(10)
# States: what the open piece may still take.
FREE, LETTERS, NUMBERS, OTHERS, LED, WHITES, ONE_MORE, TWO_MORE = range(8)
BLOCK = 256


@cache
def class_table() -> np.ndarray:
    """LETTER, NUMBER, OTHER, BLANK or WHITE for every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    for kind, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
        for a, b in ranges:
            table[a:b + 1] = kind
    table[WHITE_SPACE] = WHITE
    table[0x20] = BLANK
    return table


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this character."""
    if kind == GAP:
        return FREE, True
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return FREE, False
    if kind in (LETTER, NUMBER):
        own = LETTERS if kind == LETTER else NUMBERS
        return own, state not in (own, LED)
    if kind in (OTHER, APOSTROPHE2, APOSTROPHE3):
        if state in (OTHERS, LED) or kind == OTHER:
            return OTHERS, state not in (OTHERS, LED)
        return (ONE_MORE if kind == APOSTROPHE2 else TWO_MORE), True
    if kind == BLANK_LAST:  # leads the next piece
        return LED, True
    if kind == WHITE_LAST:  # a piece of its own
        return FREE, True
    return WHITES, state != WHITES


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Function number per class; their products; what each does to a state; where pieces begin."""
    steps = [[_step(s, k) for s in range(8)] for k in range(10)]
    known = {tuple(range(8)): 0}
    functions = [tuple(range(8))]
    classes = []
    for k in range(10):
        f = tuple(s for s, _ in steps[k])
        if f not in known:
            known[f] = len(functions)
            functions.append(f)
        classes.append(known[f])
    i = 0
    while i < len(functions):  # close under composition
        for j in classes:
            f = tuple(functions[j][s] for s in functions[i])
            if f not in known:
                known[f] = len(functions)
                functions.append(f)
        i += 1
    table = np.array(functions, np.uint8)
    product = np.empty((len(functions), len(functions)), np.uint8 if len(functions) < 256 else np.uint16)
    for a, f in enumerate(functions):
        for b, g in enumerate(functions):
            product[a, b] = known[tuple(g[s] for s in f)]
    begins = np.array([[steps[k][s][1] for k in range(10)] for s in range(8)])
    return np.array(classes, product.dtype), product, table, begins


def classes_of(points: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """The class of each character; ``gaps`` are the places between texts."""
    kind = np.take(class_table(), points, mode="clip")
    space = kind >= BLANK
    space[gaps] = True  # the end of a text ends white space as more of it would
    solid_next = np.empty(len(kind), bool)
    solid_next[:-1] = ~space[1:]
    solid_next[-1:] = False
    blank = kind == BLANK
    white = kind == WHITE
    kind[blank & solid_next] = BLANK_LAST
    kind[white] = np.where(solid_next[white], WHITE_LAST, WHITE)
    marks = np.flatnonzero(points == 39)
    if len(marks):
        after = np.concatenate((points, [0, 0]))
        one, two = after[marks + 1], after[marks + 2]
        inside = np.isin(marks + 1, gaps, invert=True)
        kind[marks[np.isin(one, [ord(c) for c in SHORT_ENDINGS]) & inside]] = APOSTROPHE2
        inside &= np.isin(marks + 2, gaps, invert=True)
        for pair in LONG_ENDINGS:
            kind[marks[(one == ord(pair[0])) & (two == ord(pair[1])) & inside]] = APOSTROPHE3
    kind[gaps] = GAP
    return kind


def states_before(kinds: np.ndarray) -> np.ndarray:
    """The automaton's state before every character, starting FREE."""
    classes, product, table, _ = automaton()
    n = len(kinds)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, product.dtype)
    padded[:n] = classes[kinds]
    lanes = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T)
    before = np.empty((BLOCK, blocks), product.dtype)
    flat, width = product.ravel(), len(product)
    place = np.empty(blocks, np.int64)
    run = np.zeros(blocks, product.dtype)
    for j in range(BLOCK):  # all blocks advance side by side
        before[j] = run
        np.multiply(run, width, out=place, casting="unsafe", dtype=np.int64)
        place += lanes[j]
        np.take(flat, place, out=run, mode="clip")
    run = run.astype(np.int64)
    span = 1
    while span < blocks:  # parallel prefix over the block functions
        moved = run.copy()
        moved[span:] = flat[run[:-span] * width + run[span:]]
        run, span = moved, span * 2
    entry = np.zeros(blocks, np.uint8)
    entry[1:] = table[run[:-1], FREE]
    after = np.empty((BLOCK, blocks), np.uint8)
    flat = table.ravel()
    for j in range(BLOCK):
        np.multiply(before[j], 8, out=place, casting="unsafe", dtype=np.int64)
        place += entry
        np.take(flat, place, out=after[j], mode="clip")
    return after.T.reshape(-1)[:n]


def piece_starts(points: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Places where a piece begins, the gaps among them."""
    kinds = classes_of(points, gaps)
    return np.flatnonzero(np.take(automaton()[3].ravel(), states_before(kinds) * np.uint8(10) + kinds, mode="clip"))
