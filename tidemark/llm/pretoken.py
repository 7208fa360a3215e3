"""Where a byte-level BPE tokenizer cuts a text before it merges: a transducer over characters.

The cuts are those of the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
compiled by hand into a deterministic machine over twelve character classes. A transition tells
whether a piece starts at the character just read, or at the one before it (white space and
contractions are settled one character late). All rows of a slice are one tape, with an end mark
after each row.

The tape is cut into chunks of equal length. Every chunk's map from each possible state to the
state after it is worked out for all chunks at once, the maps are composed by a parallel prefix
scan, and a second sweep, again over all chunks at once, writes the cuts.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np

# Character classes.
LETTER, NUMBER, SPACE, BLANK, OTHER, QUOTE, SUFFIX, R, V, L, E, END = range(12)
# States. W*: white space; its last character is a space (S) or another one (B); 1 or more of them.
START, WORD, DIGITS, SIGNS, Q, QR, QV, QL, W1S, W1B, WNS, WNB = range(12)
HERE, BEFORE = 1, 2
CHUNK, TAIL = 128, 8
_N = 12


def _machine() -> tuple[np.ndarray, np.ndarray]:
    letters = (LETTER, SUFFIX, R, V, L, E)
    goes = np.zeros((_N, _N), np.uint8)  # class, state -> state
    cuts = np.zeros((_N, _N), np.uint8)

    def enter(c: int) -> int:
        if c in letters:
            return WORD
        return {NUMBER: DIGITS, SPACE: W1S, BLANK: W1B, OTHER: SIGNS, QUOTE: Q, END: START}[c]

    def joined(c: int) -> int:
        return SIGNS if c == QUOTE else enter(c)

    for c in range(_N):
        for s in range(_N):
            to, cut = enter(c), HERE
            white = c in (SPACE, BLANK)
            if c == END:
                to, cut = START, HERE | (BEFORE if s in (QR, QV, QL) else 0)
            elif s == WORD and c in letters or s == DIGITS and c == NUMBER:
                cut = 0
            elif s == SIGNS and c in (OTHER, QUOTE):
                to, cut = SIGNS, 0
            elif s == Q and c in (SUFFIX, R, V, L):
                to, cut = {SUFFIX: START, R: QR, V: QV, L: QL}[c], 0
            elif s == Q and c in (OTHER, QUOTE):
                to, cut = SIGNS, 0
            elif (s, c) in ((QR, E), (QV, E), (QL, L)):
                to, cut = START, 0
            elif s in (QR, QV, QL):
                to, cut = enter(c), BEFORE | (0 if c in letters else HERE)
            elif s in (W1S, W1B, WNS, WNB) and white:
                to, cut = (WNS if c == SPACE else WNB), 0
            elif s == W1S:
                to, cut = joined(c), 0
            elif s == WNS:
                to, cut = joined(c), BEFORE
            elif s == WNB:
                cut = BEFORE | HERE
            goes[c, s], cuts[c, s] = to, cut
    return goes.reshape(-1), cuts.reshape(-1)


_GOES, _CUTS = _machine()
_CLASSES: list[np.ndarray] = []


def character_classes() -> np.ndarray:
    """The class of every code point (worked out once per process)."""
    if not _CLASSES:
        table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
        for i in range(sys.maxunicode + 1):
            kind = unicodedata.category(chr(i))[0]
            if kind == "L":
                table[i] = LETTER
            elif kind == "N":
                table[i] = NUMBER
        # White_Space of Unicode.
        for i in (*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
            table[i] = BLANK
        for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SUFFIX), ("r", R), ("v", V), ("l", L), ("e", E)):
            for c in chars:
                table[ord(c)] = kind
        _CLASSES.append(table)
    return _CLASSES[0]


def byte_letters() -> dict[str, int]:
    """How byte-level vocabularies write bytes: printable ones as themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def _maps(steps: np.ndarray, lanes: np.ndarray) -> np.ndarray:
    """Per start state and lane, the state after the steps."""
    maps = np.tile(np.arange(_N, dtype=np.uint8)[:, None], (1, len(lanes)))
    for step in steps:
        maps = _GOES[maps + step[lanes]]
    return maps


def _run(tape: np.ndarray) -> np.ndarray:
    """The cuts at every character of the tape, from state START."""
    n = len(tape)
    count = -(-n // CHUNK)
    padded = np.full(count * CHUNK, END, np.uint8)
    padded[:n] = tape
    steps = np.ascontiguousarray((padded * _N).reshape(count, CHUNK).T)
    # The map of each chunk. Where the last characters alone lead all states to one, the whole
    # chunk does; only the other chunks are read from their start.
    lanes = np.arange(count)
    maps = _maps(steps[CHUNK - TAIL :], lanes)
    loose = np.flatnonzero((maps != maps[0]).any(axis=0))
    if len(loose):
        maps[:, loose] = _maps(steps, loose)
    # Composition of all maps before each chunk.
    reach = 1
    while reach < count and len(loose):
        later = maps[:, reach:]
        maps[:, reach:] = later[maps[:, :-reach], lanes[None, : count - reach]]
        reach *= 2
    state = np.full(count, START, np.uint8)
    state[1:] = maps[START, :-1]
    cuts = np.empty((CHUNK, count), np.uint8)
    for i, step in enumerate(steps):
        at = state + step
        np.take(_CUTS, at, out=cuts[i], mode="clip")
        state = _GOES[at]
    return cuts.T.reshape(-1)[:n]


def pieces(data: np.ndarray, offsets: np.ndarray, special: bytes | None = None):
    """(start, end, row, is_special) of all pieces of whole rows, in order, as byte positions.

    `special` is cut out of the text wherever it stands, as a piece of its own.
    """
    edges, owner, marked = offsets, np.arange(len(offsets) - 1), np.zeros(len(offsets) - 1, bool)
    if special:
        raw, at, found = data.tobytes(), 0, []
        while (at := raw.find(special, at)) >= 0:
            row = int(np.searchsorted(offsets, at, side="right")) - 1
            if at + len(special) <= offsets[row + 1]:
                found.append((row, at))
                at += len(special)
            else:
                at += 1
        if found:
            # Rows of the tape: what stands between the special strings, and these themselves.
            inner = np.array([x for _, p in found for x in (p, p + len(special))])
            rows = np.array([r for r, _ in found for _ in range(2)])
            starts = np.concatenate([offsets[:-1], inner])
            owner = np.concatenate([owner, rows])
            marked = np.zeros(len(starts), bool)
            marked[len(offsets) - 1 :: 2] = True
            order = np.lexsort((starts, owner))
            starts, owner, marked = starts[order], owner[order], marked[order]
            edges = np.append(starts, offsets[-1])
    lead = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(lead)])
    ends = before[edges[1:]]
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    tape = np.insert(character_classes()[points], ends, END)
    cut = _run(tape)
    starts = (cut & HERE).astype(bool)
    starts[:-1] |= (cut[1:] & BEFORE).astype(bool)
    marks = ends + np.arange(len(ends))
    starts[marks] = False
    spot = np.flatnonzero(starts)
    row = np.searchsorted(marks, spot)
    position = np.flatnonzero(lead)[spot - row] if len(spot) else np.zeros(0, np.int64)
    if marked.any():
        # A special string is one piece, whatever its characters are.
        keep = ~marked[row] | (position == edges[:-1][row])
        row, position = row[keep], position[keep]
    end = np.append(position[1:], 0)
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    end[last] = edges[1:][row[last]]
    return position, end, owner[row], marked[row]
