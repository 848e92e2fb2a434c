"""Packing of tokenised documents into training sequences, balanced by attention cost.

Each task tokenises its documents and packs them block by block, so nothing is shuffled and a task holds one
block at most. A piece of n tokens costs ``linear * n + quadratic * n * n``. Within a block the pieces go, longest
first, to the sequence of the lowest cost that still has room; pieces that fit nowhere are cut to fill the gaps.
All sequences of a block are therefore full. What is left over is carried to the next block; the last rest of a
task becomes sequences whose lengths are powers of two, so there is no padding at all.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tremor.llm.base import per_process, plain, rows_of, ship_by_value, small_batches
from tremor.workspace import materialise

CAPACITY = 4096
END_ID = 2
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
# Sequences of one block; bounds the memory of a task.
BLOCK_SEQUENCES = 256
# Words whose ids a worker remembers.
HELD_WORDS = 150_000
# Characters of the words it remembers: runs of encoded data can be as long as their texts.
HELD_CHARACTERS = 32_000_000
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
# Words of these letters, and single marks, have one way through the tokenizer's normaliser and splitter.
SIMPLE = "[a-zß-öø-ÿ]+|[.,]"
# A full stop or comma beside another mark: the splitter keeps such runs together.
RUN_OF_MARKS = r"[^\sa-z0-9ß-öø-ÿ][.,]|[.,][^\sa-z0-9ß-öø-ÿ]"
# White space to Python, but marks to the tokenizer.
SEPARATORS = "[\x1c-\x1f]"


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []
        self.characters = 0

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.characters += len(word)
        self.new.append(word)
        return number


class WordIds:
    """Token ids of texts by the tokenizer file, word by word and each word once.

    The tokenizer drops white space and never joins across it, so a text's ids are those of its words. Texts of
    Latin-1 characters are put in lower case, and full stops and commas cut off, before the words are looked up.
    New words of plain letters go through a merge table made from the same file (end of word as a zero byte),
    which is faster than the tokenizer and gives the same ids; all others go through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        # Tasks run side by side already; each thread of the tokenizer would keep memory of its own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown}
        byte_of |= {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(shown)))}
        ranks = {}
        for token, number in vocabulary.items():
            body = token.removesuffix("</w>")
            if all(c in byte_of for c in body) and not token.startswith("<|"):
                ranks[bytes(byte_of[c] for c in body) + b"\0" * (body != token)] = number
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.merges = tiktoken.Encoding("words", pat_str="[^\\x00]*\\x00", mergeable_ranks=ranks, special_tokens={})
        self.simple, self.run, self.odd = re.compile(SIMPLE), re.compile(RUN_OF_MARKS), re.compile(SEPARATORS)
        self.forget()

    def forget(self) -> None:
        self.number = _Numbers()
        self.pool = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(0, dtype=np.int64)
        self.length = np.zeros(0, dtype=np.int64)

    def _learn(self) -> None:
        """Ids of the words that have a number but no ids yet."""
        new, self.number.new = self.number.new, []
        simple = np.fromiter((self.simple.fullmatch(w) is not None for w in new), dtype=bool, count=len(new))
        length, ids = np.zeros(len(new), dtype=np.int64), []
        if simple.any():
            one = self.merges.encode_to_numpy("\0".join([w for w, s in zip(new, simple) if s]) + "\0").astype(np.int32)
            length[simple] = np.diff(np.flatnonzero(self.ends[one]), prepend=-1)
            ids.append(one)
        if not simple.all():
            found = self.tokenizer.encode_batch([w for w, s in zip(new, simple) if not s], add_special_tokens=False)
            length[~simple] = [len(e.ids) for e in found]
            ids.append(np.array([i for e in found for i in e.ids], dtype=np.int32))
        start = np.zeros(len(new), dtype=np.int64)
        order = np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])
        start[order] = np.cumsum(length[order]) - length[order] + len(self.pool)
        self.pool = np.concatenate([self.pool, *ids])
        self.start, self.length = np.concatenate([self.start, start]), np.concatenate([self.length, length])

    def _words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split()
        lower = text.lower()
        if not self.run.search(lower):
            lower = lower.replace(".", " .").replace(",", " ,")
        return lower.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > HELD_WORDS or self.number.characters > HELD_CHARACTERS:
            self.forget()
        look = self.number.__getitem__
        numbers: list[np.ndarray | None] = []
        for text in texts:
            if self.odd.search(text):
                numbers.append(None)
                continue
            words = self._words(text)
            numbers.append(np.fromiter(map(look, words), dtype=np.int64, count=len(words)))
        if self.number.new:
            self._learn()
        out = []
        for text, at in zip(texts, numbers):
            if at is None:
                out.append(np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.int32))
                continue
            n = self.length[at]
            first = np.cumsum(n) - n
            out.append(self.pool[np.arange(n.sum()) + np.repeat(self.start[at] - first, n)])
        return out


def powers(n: int) -> list[int]:
    """The powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pack(pieces: list[tuple[int, int, int]], capacity: int, last: bool, linear: float, quadratic: float):
    """Place (document, start, length) pieces of one block.

    Returns [(document, start, length, sequence, offset)], the number of sequences, and the pieces left over,
    fewer than ``capacity`` tokens, which with ``last`` are placed as well.
    """
    placed, sequences, rest = [], 0, []
    for document, start, length in pieces:
        while length > capacity:
            placed.append((document, start, capacity, sequences, 0))
            sequences, start, length = sequences + 1, start + capacity, length - capacity
        rest.append((document, start, length))
    rest.sort(key=lambda p: (-p[2], p[0], p[1]))
    total = sum(p[2] for p in rest)
    count = total // capacity
    cost, room = np.zeros(count), np.full(count, capacity)
    over = []
    for document, start, length in rest:
        fits = np.where(room >= length, cost, np.inf)
        best = int(fits.argmin()) if count else 0
        if not count or fits[best] == np.inf:
            over.append((document, start, length))
            continue
        placed.append((document, start, length, sequences + best, capacity - int(room[best])))
        room[best] -= length
        cost[best] += linear * length + quadratic * length * length
    gaps = [(sequences + int(s), capacity - int(room[s]), int(room[s])) for s in np.argsort(cost, kind="stable") if room[s]]
    sequences += count
    left = total - count * capacity
    if last:
        gaps += [(sequences + i, 0, n) for i, n in enumerate(powers(left))]
        sequences += len(powers(left))
    gaps, remain = gaps[::-1], []
    for document, start, length in over:
        while length and gaps:
            sequence, offset, free = gaps.pop()
            take = min(free, length)
            placed.append((document, start, take, sequence, offset))
            start, length = start + take, length - take
            if take < free:
                gaps.append((sequence, offset + take, free - take))
        if length:
            remain.append((document, start, length))
    return placed, sequences, remain


def _pack_rows(rows: Iterator[tuple], encode, partition: int, capacity: int, end_id: int, linear: float, quadratic: float):
    """Lists of output rows, block by block."""
    held: dict[int, tuple] = {}  # document number in this task -> (doc_id, ids)
    pieces: list[tuple[int, int, int]] = []
    made, waiting, number, texts, size = 0, 0, 0, [], 0

    def block(last: bool) -> list[tuple]:
        nonlocal made, waiting, pieces
        placed, count, pieces = pack(pieces, capacity, last, linear, quadratic)
        out = []
        for document, start, length, sequence, offset in placed:
            doc_id, ids = held[document]
            crc = zlib.crc32(ids[start:start + length].astype("<u4").tobytes())
            out.append((doc_id, start, length, crc, len(ids), (partition << 32) + made + sequence, offset))
        made += count
        waiting = sum(p[2] for p in pieces)
        for document in held.keys() - {p[0] for p in pieces}:
            del held[document]
        return out

    def read() -> None:
        nonlocal number, waiting, texts, size
        for doc_id, ids in zip([d for d, _ in texts], encode([t for _, t in texts])):
            ids = np.append(ids, np.int32(end_id))
            held[number] = (doc_id, ids)
            pieces.append((number, 0, len(ids)))
            number, waiting = number + 1, waiting + len(ids)
        texts, size = [], 0

    for doc_id, text in rows:
        texts.append((doc_id, text))
        size += len(text)
        if size > 500_000:
            read()
            if waiting >= capacity * BLOCK_SEQUENCES:
                yield block(False)
    read()
    if pieces:
        yield block(True)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    linear: float = LINEAR,
    quadratic: float = QUADRATIC,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` (a power of two) tokens; see the module.

    One row per piece: doc_id; start, the ids of its document before it; length; ids_crc32 over its ids as
    little-endian 32-bit numbers; doc_tokens, all ids of the document with the closing ``end_id``; sequence_id;
    offset in the sequence. A null or empty text is its end id alone; a null doc_id stays null; repeated rows are
    documents of their own; an empty table gives no row. Each id lies in one piece, each sequence is gapless and
    either full or as long as a power of two. ``tokenizer`` names a file every executor can open. The pieces are
    written: the texts, which are long, go to Python in small batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = per_process(("word ids", tokenizer), lambda: WordIds(tokenizer))
        rows = rows_of(batches, "doc_id", "text")
        kinds = [pa.int64()] * 7
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for out in _pack_rows(rows, words.encode, TaskContext.get().partitionId(), capacity, end_id, linear, quadratic):
            columns = zip(*out) if out else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    with small_batches(docs.sparkSession):
        return materialise(plain(docs, id_col, text_col).mapInArrow(run, PIECES), "packed-pieces")


ship_by_value(__name__)
