"""Packing documents into training sequences of balanced attention cost.

Tokens never travel: the task that reads documents also cuts them into tokens and deals them into sequences, a group of some
millions of tokens at a time, so a task holds one group and nothing is shuffled, however large or uneven the table is.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from meterline.llm.common import pieces

#: Tokens of a full sequence.
CAPACITY = 4096

#: Tokens that are dealt out at a time.
GROUP = 1 << 22

#: Cost of a piece of n tokens: LINEAR * n for projections, n * n for attention, which stays inside a piece.
LINEAR = 6 * 1024

#: Sequence ids are those of the task times this, counted on from there.
TASK = 1 << 40

#: Words that a worker remembers.
REMEMBERED = 1_000_000

#: What is one token to the splitter and unchanged by its normaliser once in lower case, and what may follow it.
_PLAIN = re.compile(r"([a-zß-öø-ÿ]+)([.,;:!?]*)")

_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: The character that stands for each byte: its own if it prints, else the next one from 256.
_BYTES = dict(zip([*_PRINTED, *sorted(set(range(256)) - set(_PRINTED))], [*_PRINTED, *range(256, 324)], strict=True))


class Encoder:
    """Ids of whole texts by a tokenizer that never joins what a space or line end parts.

    Words between spaces are looked up in a bounded table; new ones go to the tokenizer, words of plain letters straight
    to its model.
    """

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def _ids(self, word: str) -> list[int]:
        plain = _PLAIN.fullmatch(word.lower())
        if not plain:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        coded = plain[1].encode().decode("latin-1").translate(_BYTES)
        out = [token.id for token in self.tokenizer.model.tokenize(coded)]
        return out + list(self.ids[slice(*self._span(plain[2]))]) if plain[2] else out

    def _span(self, word: str) -> tuple[int, int]:
        at = self.known.get(word)
        if at is None:
            self.ids.extend(self.tokenizer.encode(word, add_special_tokens=False).ids)
            self.ends.append(len(self.ids))
            at = self.known[word] = len(self.ends) - 2
        return self.ends[at], self.ends[at + 1]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and how many each has."""
        if len(self.known) > REMEMBERED or len(self.ids) > 8 * REMEMBERED:
            self.forget()
        words = [t.replace("\n", " ").split(" ") for t in texts]
        every = list(chain.from_iterable(words))
        for word in set(every).difference(self.known):
            if word not in self.known:
                ids = self._ids(word)
                self.ids.extend(ids)
                self.ends.append(len(self.ids))
                self.known[word] = len(self.ends) - 2
        at = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        ends, ids = np.array(self.ends), np.array(self.ids, np.uint32)
        size = ends[at + 1] - ends[at]
        last = np.cumsum(size)
        total = int(last[-1]) if len(last) else 0
        out = ids[np.repeat(ends[at] - (last - size), size) + np.arange(total)]
        first = np.cumsum([0, *map(len, words)])
        counts = np.diff(np.concatenate(([0], last))[first])
        return out, counts


@lru_cache(maxsize=2)
def _encoder(definition: str) -> Encoder:
    return Encoder(definition)


def lay_out(lengths: np.ndarray, capacity: int = CAPACITY, linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that fill sequences to the last token.

    Each run of `capacity` tokens from a document's beginning is a sequence of its own. What is left of the documents goes,
    the longest first, to the sequence of lowest cost for its size that has room; ties go to the first. One that fits
    nowhere is cut at the largest room, and its rest waits for its turn. Sequences hold `capacity` tokens, and what does not
    fill one is parted into powers of two, so none needs padding.
    """
    out, sequences = [], 0
    rest = []
    for doc, n in enumerate(lengths.tolist()):
        for start in range(0, n - capacity + 1, capacity):
            out.append((doc, start, capacity, sequences, 0))
            sequences += 1
        if n % capacity:
            rest.append((-(n % capacity), doc, n - n % capacity))
    total = -sum(n for n, _, _ in rest)
    sizes = [capacity] * (total // capacity)
    sizes += [1 << b for b in reversed(range(capacity.bit_length())) if total % capacity >> b & 1]
    room = sizes.copy()
    open_ = [(0.0, k) for k in range(len(sizes))]  # by cost
    full: list[tuple[int, float, int]] = []  # without room for the present piece, the roomiest first
    heapq.heapify(rest)
    while rest:
        n, doc, start = heapq.heappop(rest)
        n = -n
        while full and -full[0][0] >= n:
            _, cost, k = heapq.heappop(full)
            heapq.heappush(open_, (cost, k))
        while open_ and room[open_[0][1]] < n:
            cost, k = heapq.heappop(open_)
            heapq.heappush(full, (-room[k], cost, k))
        if open_:
            cost, k = heapq.heappop(open_)
        else:
            left, cost, k = heapq.heappop(full)
            heapq.heappush(rest, (-(n + left), doc, start - left))
            n = -left
        out.append((doc, start, n, sequences + k, sizes[k] - room[k]))
        room[k] -= n
        if room[k]:
            heapq.heappush(open_, (cost + (linear * n + n * n) / sizes[k], k))
    return out


def pack(
    documents: DataFrame, definition: str, end_id: int, capacity: int = CAPACITY, group: int = GROUP, linear: int = LINEAR
) -> DataFrame:
    """Rows (doc_id, start, length, doc_tokens, sequence_id, offset, cost, ids), one for each piece of a document.

    `definition` is the text of a tokenizer file. A document is its text's ids, without special ones, and `end_id`; each of
    them is in exactly one piece. `ids` holds a piece's ids as little-endian unsigned 32-bit numbers. A sequence's pieces
    follow each other without a gap from offset 0; it holds `capacity` tokens, a power of two, or a smaller power of two.
    `cost` is the piece's estimated linear plus quadratic cost.

    A null text is an empty one, which still has its `end_id`. Repeated rows, and rows that share an id or have none, are
    documents of their own. A very long text is one document of many sequences. An empty table gives no rows. Columns but
    doc_id and text are not read. Which documents share a sequence depends on how the table's files are split; a task that
    runs again deals its rows the same way.
    """
    if capacity & (capacity - 1) or capacity < 1:
        raise ValueError("the capacity has to be a power of two")
    sent = documents.sparkSession.sparkContext.broadcast(definition)
    kind = documents.schema["doc_id"].dataType

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, base, used = _encoder(sent.value), TaskContext.get().partitionId() * TASK, 0
        keys, ids, counts, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal used
            lengths, tokens = np.concatenate(counts), np.concatenate(ids).astype("<u4", copy=False)
            first = np.cumsum(lengths) - lengths
            laid = np.array(lay_out(lengths, capacity, linear), np.int64).reshape(-1, 5)
            names = pa.concat_arrays(keys)
            for a in range(0, len(laid), 4096):
                doc, start, length, sequence, offset = laid[a : a + 4096].T
                begin = first[doc] + start
                chunks = [tokens[b : b + n].tobytes() for b, n in zip(begin.tolist(), length.tolist(), strict=True)]
                columns = [names.take(pa.array(doc)), start, length, lengths[doc], base + used + sequence, offset]
                columns += [(linear * length + length * length).astype(float), pa.array(chunks, pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=FIELDS)
            used += int(laid[:, 3].max()) + 1
            keys.clear(), ids.clear(), counts.clear()

        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            for a, b in pieces(texts, 1 << 22):
                found, size = encode(texts[a:b])
                ids.append(np.insert(found, np.cumsum(size), end_id))
                counts.append(size + 1)
                keys.append(batch.column("doc_id").slice(a, b - a))
                held += len(ids[-1])
                if held >= group:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()

    return documents.select("doc_id", "text").mapInArrow(
        deal,
        f"doc_id {kind.simpleString()}, start long, length long, doc_tokens long, sequence_id long, offset long, cost double, ids binary",
    )


FIELDS = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "cost", "ids"]
