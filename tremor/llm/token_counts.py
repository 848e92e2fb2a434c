"""Word-piece counts by a longest-match automaton in linear time.

Greedy longest-match-first word pieces, counted without building them. The vocabulary is a trie over bytes, with
one root for the start of a word and one for its continuation. Every state has a failure link: the state reached
after the longest pieces of its string have been taken off, and the number of those pieces. A word is read once;
where the trie has no edge, the popped count is added and the failure link followed. Each link shortens what is
held, so the work is linear in the word whatever its length. A word that cannot be cut into pieces counts as one
unknown piece.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tremor.llm.base import in_chunks, per_process, plain, rows_of, ship_by_value

# Words whose counts a worker remembers.
HELD_WORDS = 500_000
# Longer words (bytes) are counted each time, so that what is remembered is bounded in bytes too.
HELD_LENGTH = 64
# Marks the start of a word in the vocabulary file (U+2581).
WORD_START = "▁"
COUNTS = "doc_id long, n_words long, n_pieces long, n_unknown long, n_bytes long"


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol buffer message's fields; bytes for nested ones."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at:at + size]
            at += size
        else:
            size = 4 if kind == 5 else 8
            yield key >> 3, struct.unpack_from("<f" if kind == 5 else "<d", data, at)[0]
            at += size


def read_vocabulary(path: str) -> tuple[set[bytes], set[bytes]]:
    """(pieces that start a word, pieces that continue one) of a sentencepiece model's ordinary pieces."""
    with open(path, "rb") as file:
        data = file.read()
    first, later = set(), set()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            text = piece[1].decode()
            if piece.get(3, 1) == 1 and text.strip(WORD_START) == text.removeprefix(WORD_START) and text != WORD_START:
                (first if text.startswith(WORD_START) else later).add(text.removeprefix(WORD_START).encode())
    return first, later


class Automaton:
    """Trie, failure links and popped counts of a word-piece vocabulary.

    State 0 is the start of a word, state 1 the start of a continuation. ``edges[state]`` maps a byte to the next
    state. ``link[state]`` is -1 where the state's string has no piece as a prefix.
    """

    def __init__(self, first: set[bytes], later: set[bytes]):
        self.edges: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        order = [(0, -1, 0), (1, -1, 0)]  # (state, parent, byte), parents first after the sort below
        depth = [0, 0]
        for root, words in ((0, first), (1, later)):
            for word in sorted(words):
                state = root
                for byte in word:
                    step = self.edges[state].get(byte)
                    if step is None:
                        step = len(self.edges)
                        self.edges[state][byte] = step
                        self.edges.append({})
                        piece.append(False)
                        depth.append(depth[state] + 1)
                        order.append((step, state, byte))
                    state = step
                if word:
                    piece[state] = True
        self.link, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        for state, parent, byte in sorted(order[2:], key=lambda x: depth[x[0]]):
            if piece[state]:  # the whole string is one piece
                self.link[state], self.popped[state] = 1, 1
                continue
            at, count = self.link[parent], self.popped[parent]
            while at >= 0 and byte not in self.edges[at]:
                count += self.popped[at]
                at = self.link[at]
            if at >= 0:
                self.link[state], self.popped[state] = self.edges[at][byte], count

    def pieces(self, word: bytes) -> int:
        """The number of greedy pieces, -1 for an unknown word."""
        edges, link, popped = self.edges, self.link, self.popped
        state = count = 0
        for byte in word:
            while (step := edges[state].get(byte)) is None:
                count += popped[state]
                state = link[state]
                if state < 0:
                    return -1
            state = step
        while state != 1:  # the end of the word: take off what is held
            if state <= 0:
                return -1
            count += popped[state]
            state = link[state]
        return count


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_words, n_pieces (an unknown word is one), n_unknown and n_bytes.

    Words are split at ASCII white space and taken as their UTF-8 bytes. Null and empty texts have no words; a
    null doc_id stays null; repeated rows give repeated rows; an empty table gives none. ``vocabulary`` is a
    sentencepiece model file that every executor can open. A worker remembers the counts of the words it has met,
    a bounded number; nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = per_process(("automaton", vocabulary), lambda: Automaton(*read_vocabulary(vocabulary)))
        held = per_process(("piece counts", vocabulary), dict)

        def counted(rows):
            for doc_id, text in rows:
                data = text.encode()
                words = Counter(data.split())
                if len(held) + len(words) > HELD_WORDS:
                    held.clear()
                pieces = unknown = total = 0
                for word, times in words.items():
                    n = held.get(word)
                    if n is None:
                        n = automaton.pieces(word)
                        if len(word) <= HELD_LENGTH:
                            held[word] = n
                    total += times
                    if n < 0:
                        unknown += times
                    else:
                        pieces += n * times
                yield doc_id, total, pieces + unknown, unknown, len(data)

        def batch(rows: list) -> pa.RecordBatch:
            names = ["doc_id", "n_words", "n_pieces", "n_unknown", "n_bytes"]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        yield from in_chunks(counted(rows_of(batches, "doc_id", "text")), batch)

    return plain(docs, id_col, text_col).mapInArrow(run, COUNTS)


ship_by_value(__name__)
