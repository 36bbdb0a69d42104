"""SentencePiece encoding and decoding with a public vocabulary: a relational lattice over the corpus's words.

Spaces become the mark U+2581, one more goes in front, and a text is cut in words where a run of marks or of line ends begins: no
piece reaches over such a cut. Each different word is solved once: its bounded-length substrings are exploded and
equi-joined to the piece table, the edges are grouped by word, and a fold over them (Viterbi) keeps for each place the best
path that ends there. Characters that are no piece fall back to pieces of their bytes. Words of more than 256 characters (unspaced
text, urls) are solved whole by the same fold where they are read, as their edges would be too many for one row.

Documents travel as numbers of words in a chunk's own dictionary. Only dictionaries are joined with the solved words;
chunks are stored in buckets, so that they stay where they are when their dictionary comes back.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterline.llm.common import pieces as runs
from meterline.session import scratch_database

MARK = "▁"
#: A longer word isn't exploded to edges, of which there are some twenty a character, but solved where it is read.
LONGEST_WORD = 256
#: Characters of the texts in one chunk, about.
CHUNK = 32 << 20
#: What a character that is no piece costs, below the lowest score, as the format has it. Fixed value.
UNKNOWN_COST = 10.0


class Vocabulary(NamedTuple):
    pieces: list[tuple[str, int, float]]  # text, id, score
    bytes: list[int]  # id of each byte's piece

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @property
    def unknown_score(self) -> float:
        return min(s for _, _, s in self.pieces) - UNKNOWN_COST


def load(path: str) -> Vocabulary:
    """Pieces of a model file whose texts are left as they are but for spaces, and that falls back to bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = range(model.get_piece_size())
    plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    of_byte = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
    return Vocabulary([(model.id_to_piece(i), i, model.get_score(i)) for i in plain], [of_byte[b] for b in range(256)])


_WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(MARK + text.replace(" ", MARK)) if text else []


def best_path(word: str, vocabulary: Vocabulary, table: dict[str, tuple[int, float]]) -> list[int]:
    """Ids along the best path, equal to that of `solve` also among equal sums. table: id and score of each piece.

    Only the sums of as many places as the longest piece has characters are looked back at; each place keeps where the last
    piece of its path begins.
    """
    longest, unknown = vocabulary.longest, vocabulary.unknown_score
    sums, begins = [0.0], [0]
    for stop in range(1, len(word) + 1):
        best, begin = None, 0
        for start in range(max(0, stop - longest), stop):
            known = table.get(word[start:stop])
            if known is None and stop - start > 1:
                continue
            here = sums[start] + (unknown if known is None else known[1])
            if best is None or here > best:
                best, begin = here, start
        sums.append(best)
        begins.append(begin)
    parts, stop = [], len(word)
    while stop:
        known = table.get(word[begins[stop] : stop])
        parts.append([vocabulary.bytes[c] for c in word[begins[stop] : stop].encode()] if known is None else [known[0]])
        stop = begins[stop]
    return [i for ids in reversed(parts) for i in ids]


def _best_path(edges: Column) -> Column:
    """Ids along the best path. edges: structs (stop, start, score, ids), ordered, every place being the stop of some.

    Of equal paths the one whose last piece is longest is kept.
    """
    begin = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def extend(paths: Column, e: Column) -> Column:
        before = F.element_at(paths, e["start"] + 1)
        here = F.struct((before["score"] + e["score"]).alias("score"), F.concat(before["ids"], e["ids"]).alias("ids"))
        return (
            F.when(F.size(paths) == e["stop"], F.concat(paths, F.array(here)))
            .when(here["score"] > F.element_at(paths, -1)["score"], F.concat(F.slice(paths, F.lit(1), e["stop"]), F.array(here)))
            .otherwise(paths)
        )

    return F.element_at(F.aggregate(edges, begin, extend), -1)["ids"]


def solve(distinct: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (word, ids) for rows (word); words are different and not empty.

    The piece table has as many rows as the vocabulary and is broadcast; all else stays partitioned by word.
    """
    spark = distinct.sparkSession
    table = spark.createDataFrame([(p, i, float(s)) for p, i, s in vocabulary.pieces], "piece string, id int, score double")
    n, longest = F.char_length("word"), F.lit(vocabulary.longest)
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda a: F.transform(
                F.sequence(F.lit(1), F.least(longest, n - a)),
                lambda k: F.struct((a + k).alias("stop"), a.alias("start"), F.substring(F.col("word"), a + 1, k).alias("piece")),
            ),
        )
    )
    edges = distinct.select("word", F.explode(spans).alias("e")).select("word", "e.*").join(F.broadcast(table), "piece", "left")
    edges = edges.where((F.col("stop") - F.col("start") == 1) | F.col("id").isNotNull())
    known = F.array(*(F.lit(i) for i in vocabulary.bytes))
    by_bytes = F.transform(
        F.filter(F.split(F.hex(F.encode("piece", "UTF-8")), "(?<=\\G..)"), lambda h: h != ""),
        lambda h: F.element_at(known, F.conv(h, 16, 10).cast("int") + 1),
    )
    edge = F.struct(
        "stop",
        "start",
        F.coalesce("score", F.lit(vocabulary.unknown_score)).alias("score"),
        F.when(F.col("id").isNotNull(), F.array("id")).otherwise(by_bytes).alias("ids"),
    )
    return edges.groupBy("word").agg(_best_path(F.sort_array(F.collect_list(edge))).alias("ids"))


def _chunk(batches: Iterator[pd.DataFrame], vocabulary: Vocabulary) -> Iterator[pd.DataFrame]:
    made = 0
    table = {p: (i, float(s)) for p, i, s in vocabulary.pieces}
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in runs(texts, CHUNK):
            number: dict[str, int] = {}
            parts = [np.array([number.setdefault(w, len(number)) for w in words(t)], np.uint32) for t in texts[a:b]]
            stream = np.concatenate(parts)
            known = list(number)
            # frequent words get small numbers, long ones the last; low and high halves apart compress better
            long = np.array([len(w) > LONGEST_WORD for w in known], bool)
            order = np.lexsort((-np.bincount(stream, minlength=len(number)), long))
            rank = np.empty(len(order), np.uint32)
            rank[order] = np.arange(len(order), dtype=np.uint32)
            halves = rank[stream].view(np.uint16).reshape(-1, 2).T
            short = len(known) - int(long.sum())
            solved = (best_path(known[i], vocabulary, table) for i in order[short:])
            yield pd.DataFrame(
                {
                    "chunk": [f"{TaskContext.get().partitionId()}-{made}"],
                    "ids": [batch["doc_id"].iloc[a:b].tolist()],
                    "sizes": [np.array([len(p) for p in parts], np.int32)],
                    "stream": [zlib.compress(halves.tobytes(), 1)],
                    "words": [[known[i] for i in order[:short]]],
                    "long": [",".join(" ".join(map(str, ids)) for ids in solved)],
                }
            )
            made += 1


#: Words whose pieces are put together at once.
SLICE = 1 << 18


def _numbers(reply: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a reply, and how many each word has. Words are apart by commas, ids by spaces."""
    if not reply:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    signs = np.frombuffer(reply.encode(), np.uint8)
    ends = np.append(np.flatnonzero(signs == 44), len(signs))
    count = np.diff(np.concatenate(([0], np.cumsum(signs == 32, dtype=np.int32)))[ends], prepend=0) + 1
    return np.fromstring(reply.replace(",", " "), np.int32, sep=" "), count


def _assemble(batches: Iterator[pa.RecordBatch], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Documents of each chunk, some at a time, so that what is held beside the chunk itself stays small."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids, sizes, stream, reply, long = (batch.column(c)[row] for c in ("ids", "sizes", "stream", "reply", "long"))
            flat, count = _numbers(",".join(r for r in (reply.as_py(), long.as_py()) if r))
            first, names, sizes = np.cumsum(count) - count, ids.values.cast(kind), sizes.values.to_numpy()
            halves = np.frombuffer(zlib.decompress(stream.as_py()), np.uint16).reshape(2, -1)
            until, doc = np.cumsum(sizes), 0
            while doc < len(sizes):
                begin = until[doc] - sizes[doc]
                stop = max(doc + 1, int(np.searchsorted(until, begin + SLICE, "right")))
                word = np.ascontiguousarray(halves[:, begin : until[stop - 1]].T).view(np.uint32).ravel()
                each = count[word] if len(word) else np.zeros(0, np.int64)
                ends = np.cumsum(each)
                at = np.repeat(first[word] - (ends - each), each) + np.arange(ends[-1]) if len(word) else np.zeros(0, np.int64)
                stops = np.concatenate(([0], ends))[np.concatenate(([0], until[doc:stop] - begin))]
                lists = pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(flat[at]))
                parts = [names.slice(doc, stop - doc), lists, pa.array(np.diff(stops), pa.int32())]
                yield pa.RecordBatch.from_arrays(parts, ["doc_id", "ids", "n_pieces"])
                doc = stop


def encode(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (doc_id, ids, n_pieces), one for each row of (doc_id, text).

    Null and empty texts have no pieces. Whole texts are encoded: decoding gives the text again, but for the mark U+2581
    itself, which comes back as a space.
    """
    spark = documents.sparkSession
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = rows.schema["doc_id"].dataType
    kind, arrow = named.simpleString(), to_arrow_type(named)
    shape = f"chunk string, ids array<{kind}>, sizes array<int>, stream binary, words array<string>, long string"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{scratch_database(spark, 'pieces')}.chunks"
    chunked = rows.mapInPandas(lambda b: _chunk(b, vocabulary), shape)
    chunked.write.option("compression", "zstd").bucketBy(parts, "chunk").saveAsTable(name)
    chunks = spark.table(name)

    # lattices have some twenty edges a word, so words are dealt finer than other shuffles
    entry = chunks.select("chunk", F.posexplode("words").alias("at", "word")).repartition(8 * parts, "word")
    solved = solve(entry.select("word").distinct(), vocabulary)
    told = entry.join(solved.select("word", F.array_join("ids", " ").alias("ids")), "word")
    replies = told.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "ids"))).alias("told"))
    reply = replies.select("chunk", F.array_join(F.col("told.ids"), ",").alias("reply"))
    whole = chunks.drop("words").join(reply.hint("merge"), "chunk", "left").select("ids", "sizes", "stream", "reply", "long")
    return whole.mapInArrow(lambda b: _assemble(b, arrow), f"doc_id {kind}, ids array<int>, n_pieces int")


def with_text(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The same rows with `text`, decoded from `ids`. Ids that are no piece's are skipped; no ids give an empty text."""
    mark = MARK.encode()
    spelled = {i: p.encode().replace(mark, b" ") for p, i, _ in vocabulary.pieces}
    spelled |= {i: bytes([b]) for b, i in enumerate(vocabulary.bytes)}

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (b"".join([spelled.get(i, b"") for i in ids.as_py() or ()])[1:] for ids in batch.column("ids"))
            decoded = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(spell, f"{fields}, text string")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Rows (doc_id, text) for rows (doc_id, ids). Ids that are no piece's are skipped; no ids give an empty text."""
    return with_text(encoded.select("doc_id", "ids"), vocabulary).select("doc_id", "text")
