"""Exact BPE token counts by finite-state transducers.

Two machines work in line. The first (`pretoken`) cuts the text into pieces, the second counts
the tokens of a piece: it reads bytes and every transition carries how many tokens the piece
gains by this byte (which can be negative).

The second machine is compiled from the merges, as far as the texts need it. BPE has this
property: the tokens of a string are those of a shorter prefix plus one last token, and a token
can be last exactly if it and the last token before it would not have merged otherwise. So all
that matters after a prefix are its last token and, for every start from which a token may still
be unfinished: the place in the tree of tokens, the last token before that start, and the count
there, relative to the count here. That is a state; there are finitely many.

Pieces start in the same state and do not see each other, so the counts of chunks of any length
add up; equal pieces of a slice are run once.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.pretoken import byte_letters, pieces
from tidemark.llm.text import byte_values, held, map_arrow, slices, span_hashes

_TABLE = byte_values("token-piece", lower=False)
# Compiled states and counted pieces kept per process; beyond that, both start afresh.
MOST_STATES, MOST_PIECES = 150_000, 1_000_000


class CountMachine:
    """The lazily compiled transducer of one byte-level BPE vocabulary."""

    def __init__(self, vocabulary: bytes) -> None:
        spec = json.loads(vocabulary)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("unk_token"):
            raise ValueError("a byte-level BPE vocabulary is needed")
        self.specials = [t["content"].encode() for t in spec.get("added_tokens", [])]
        letters = byte_letters()

        def raw(word: str) -> bytes:
            return bytes(letters[c] for c in word)

        # Tokens are numbered as they can be made: bytes first, then one per merge.
        number = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.merged: dict[tuple[int, int], int] = {}
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right = number[raw(a)], number[raw(b)]
            new = number.setdefault(raw(a) + raw(b), len(self.parts))
            if new == len(self.parts):
                self.parts.append((left, right))
            self.merged[(left, right)] = new
        self.next: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.open: list[bool] = [False]
        for word, token in number.items():
            node = 0
            for byte in word:
                child = self.next.get(node << 8 | byte)
                if child is None:
                    child = len(self.token)
                    self.next[node << 8 | byte] = child
                    self.token.append(-1)
                    self.open.append(False)
                    self.open[node] = True
                node = child
            self.token[node] = token
        self.fits: dict[tuple[int, int], bool] = {}
        self._restart()

    def _restart(self) -> None:
        self.states: list[tuple] = [(-1, ())]
        self.names: dict[tuple, int] = {(-1, ()): 0}
        self.moves: list[dict[int, tuple[int, int]]] = [{}]

    def stands(self, left: int, right: int) -> bool:
        """Whether BPE leaves these two tokens next to each other.

        Undo the later one's last merge, again and again: no pair that meets at the border may
        have a merge that comes before those already undone.
        """
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        bound = len(self.parts)
        answer = None
        while answer is None:
            new = self.merged.get((left, right))
            if new is not None and new < bound:
                answer = False
            elif left > right and left >= 256:
                bound, left = left, self.parts[left][1]
            elif right >= 256:
                bound, right = right + 1, self.parts[right][0]
            elif left >= 256:
                bound, left = left, self.parts[left][1]
            else:
                answer = True
        if len(self.fits) < 4 * MOST_STATES:
            self.fits[key] = answer
        return answer

    def _compile(self, state: int, byte: int) -> tuple[int, int]:
        last, running = self.states[state]
        gain, token, alive = None, -1, []
        for node, before, count in (*running, (0, last, 0)):
            child = self.next.get(node << 8 | byte)
            if child is None:
                continue
            here = self.token[child]
            if gain is None and here >= 0 and (before < 0 or self.stands(before, here)):
                gain, token = count + 1, here
            if self.open[child]:
                alive.append((child, before, count))
        key = (token, tuple((node, before, count - gain) for node, before, count in alive))
        to = self.names.get(key)
        if to is None:
            to = self.names[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
        self.moves[state][byte] = (to, gain)
        return to, gain

    def count(self, piece: bytes) -> int:
        if len(self.states) > MOST_STATES:
            self._restart()
        state, total, moves = 0, 0, self.moves
        for byte in piece:
            move = moves[state].get(byte)
            if move is None:
                move = self._compile(state, byte)
            state = move[0]
            total += move[1]
        return total


class PieceTable:
    """What is known of pieces by their hash: sorted arrays that grow by merging."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.values = np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] == hashes, self.values[at]

    def add(self, hashes: np.ndarray, values: np.ndarray) -> None:
        if len(self.hashes) + len(hashes) > MOST_PIECES:
            self.hashes, self.values = self.hashes[:0], self.values[:0]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.values = np.insert(self.values, at, values)


def _machine(key: str, vocabulary) -> tuple[CountMachine, PieceTable]:
    return held(__name__, (key,), lambda: (CountMachine(vocabulary.value), PieceTable()))


def slice_counts(machine: CountMachine, known: PieceTable, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of whole rows."""
    special = machine.specials[0] if machine.specials else None
    start, end, row, marked = pieces(data, offsets, special)
    hashes = span_hashes(data, start, end, _TABLE)
    names, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    seen, values = known.look_up(names)
    new = np.flatnonzero(~seen)
    if len(new):
        raw = data.tobytes()
        values[new] = [machine.count(raw[start[i] : end[i]]) for i in first[new]]
        known.add(names[new], values[new])
    counts = values[which.reshape(-1)]
    counts[marked] = 1
    total = np.concatenate([[0], np.cumsum(counts)])
    edge = np.searchsorted(row, np.arange(len(offsets)))
    return total[edge[1:]] - total[edge[:-1]]


def _count(key: str, vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, known = _machine(key, vocabulary)
        for batch in batches:
            sizes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for _, _, data, offsets in slices(batch.column(1)):
                sizes.append(np.diff(offsets))
                counts.append(slice_counts(machine, known, data, offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(sizes)), pa.array(np.concatenate(counts))],
                names=["id", "n_bytes", "n_tokens"],
            )

    return run


def token_counts(
    docs: DataFrame, vocabulary_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row.

    `vocabulary_path` is a byte-level BPE file (.json) that the driver can open; its content is
    sent to the tasks. Counts are those of encoding the whole text without tokens added at its
    ends; the vocabulary's special string counts as one token where it stands in a text (one
    such string is supported). A null or empty text has 0 bytes and 0 tokens. Rows are counted
    one by one, so repeated rows and ids make no difference; other columns are not read.
    """
    with open(vocabulary_path, "rb") as file:
        raw = file.read()
    if len(json.loads(raw).get("added_tokens", [])) > 1:
        raise ValueError("more than one special string")
    vocabulary = docs.sparkSession.sparkContext.broadcast(raw)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    counted = map_arrow(narrow, _count(hashlib.sha256(raw).hexdigest(), vocabulary), f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
