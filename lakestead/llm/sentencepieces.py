"""SentencePiece encoding over a table of distinct marked words, and decoding.

A merge never makes a symbol that is not a piece. So where two neighbouring bytes stand side by side in no piece of the
model, as a character and a white-space marker behind it do, no merge crosses, and the ids of a text are those of its
chunks one after another: marked words, and what else such places cut off, as punctuation. Each
distinct chunk is segmented once, by the library, with a line feed in front that keeps its marker from being
doubled; the ids come back to their texts by position.

1. Batches count their chunks and name those that make up a millionth of them; of these the most frequent, at most
   ``hot_rows`` of ``hot_bytes`` bytes each, are segmented and go to all tasks. In a corpus they make up most of the text.
2. A text becomes the numbers of its chunks, one to four bytes each, and 0 where a chunk is not among the hot ones.
3. Those chunks are listed with the hash of their text and their position. The distinct ones are segmented and joined
   back to all their places, and the ids go to their text. A chunk that is not
   hot makes up less than about a millionth of the corpus, so no key of the join is hot but a very long one, which
   adaptive planning splits.

A text is known by 128 bits of its hash, so no row number has to hold over two readings, and copies of a text
share their rare chunks. Chunks are compared as bytes.

Models that normalise texts, are not BPE or have pieces with a line feed take each text as one chunk.

Defined cases: a null or empty text has no ids. A literal marker character counts as white space, as in the library,
and decodes to a blank. Repeated rows and null ids are rows like any other. Very long texts are held a few times over in
one task, as any cell; decoding works in blocks. No rows give no rows. Columns besides the text come back unchanged; one
named as a result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestead.llm.arrays import pieces, text_buffer
from lakestead.llm.common import written

MARK = "▁"
ANCHOR = "\n"


@dataclass(frozen=True)
class Hot:
    """Bound of the chunks that go to all tasks."""

    rows: int = 1 << 20
    bytes: int = 32


class Model:
    """A model file and what its pieces allow."""

    def __init__(self, proto: bytes):
        self.proto = proto

    def __reduce__(self):
        return Model, (self.proto,)

    @cached_property
    def library(self) -> sentencepiece.SentencePieceProcessor:
        return sentencepiece.SentencePieceProcessor(model_proto=self.proto)

    @cached_property
    def pieces(self) -> list[str]:
        return [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]

    @cached_property
    def cuts(self) -> np.ndarray | None:
        """Per pair of bytes whether no piece has them side by side; None where texts may not be cut."""
        probe = f" A  {ANCHOR} ÅÅﬁ　x\t "
        plain = self.library.normalize(probe) == MARK + probe.replace(" ", MARK)
        if not plain or not self._is_bpe():
            return None
        apart = np.ones((256, 256), bool)
        for i, piece in enumerate(self.pieces):
            if not self._special(i):
                data = np.frombuffer(piece.replace(MARK, " ").encode(), np.uint8)
                apart[data[:-1], data[1:]] = False
        feed = ord(ANCHOR)
        return apart.ravel() if apart[feed].all() and apart[:, feed].all() else None

    def _special(self, i: int) -> bool:
        lib = self.library
        return lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i) or lib.is_byte(i)

    def _is_bpe(self) -> bool:
        """The scores of BPE pieces are negative ranks; those of unigram pieces are logarithms."""
        return all(self.library.get_score(i).is_integer() for i in range(len(self.pieces)))

    def segment(self, chunks: list[str]) -> list[list[int]]:
        if self.cuts is None:
            return self.library.encode(chunks, num_threads=1)
        lead = len(self.library.encode(ANCHOR))
        return [ids[lead:] for ids in self.library.encode([ANCHOR + c for c in chunks], num_threads=1)]

    def decode(self, ids: np.ndarray, block: int = 1 << 16) -> str:
        """The library's text of ids. Long lists are cut before marked pieces; the text
        in front of a block keeps its blank from being taken for the one at the start of a text."""
        if len(ids) <= block or self.cuts is None:
            return self.library.decode(ids.tolist())
        marked = np.flatnonzero(self._marked[ids])
        out, start = [], 0
        lead = self.library.encode("a")
        while start < len(ids):
            stop = len(ids)
            if stop - start > block:
                k = np.searchsorted(marked, start + block)
                stop = int(marked[k]) if k < len(marked) else stop
            text = self.library.decode((lead if start else []) + ids[start:stop].tolist())
            out.append(text[1:] if start else text)
            start = stop
        return "".join(out)

    @cached_property
    def _marked(self) -> np.ndarray:
        return np.array([p.startswith(MARK) for p in self.pieces])


@lru_cache(2)
def loaded(proto: bytes) -> Model:
    return Model(proto)


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The model file, whose size does not depend on the data."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def chunked(texts: pa.Array, cuts: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    """All chunks of a batch, and where those of each row begin."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    given = pc.not_equal(texts, "")
    if cuts is None:
        first = np.concatenate([[0], np.cumsum(given.to_numpy(zero_copy_only=False))])
        return texts.filter(given).cast(pa.large_binary()), first
    blank, nothing = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
    texts = pc.if_else(given, pc.binary_join_element_wise(blank, texts, nothing), nothing)
    data, offsets = text_buffer(pc.replace_substring(texts, MARK, " "))
    begins = np.ones(len(data), bool)
    pairs = data[:-1].astype(np.uint16)
    pairs <<= 8
    pairs |= data[1:]
    begins[1:] = cuts[pairs]
    begins &= (data & 0xC0) != 0x80  # only before a character
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts, len(data)).astype(np.int64)
    buffers = [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers), np.searchsorted(starts, offsets)


def as_text(chunks: list[bytes]) -> list[str]:
    return [c.decode() for c in chunks]


def to_bytes(ids: list[list[int]], kind: str) -> list[bytes]:
    return [np.array(x, kind).tobytes() for x in ids]


def varints(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Little-endian groups of seven bits, and the length of each number."""
    sizes = 1 + sum((numbers >= 1 << s).astype(np.int64) for s in (7, 14, 21))
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    for j in range(4):
        has = sizes > j
        more = np.where(sizes[has] > j + 1, 128, 0)
        out[(ends - sizes)[has] + j] = (numbers[has] >> 7 * j & 127) | more
    return out, sizes


def from_varints(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers, and the byte that each one begins at."""
    last = data < 128
    starts = np.flatnonzero(np.concatenate([[True], last[:-1]])) if len(data) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(data)))
    out = np.zeros(len(starts), np.int64)
    for j in range(4):
        has = sizes > j
        out[has] |= (data[starts[has] + j] & 127).astype(np.int64) << 7 * j
    return out, starts


def segmented(chunks: DataFrame, model: Broadcast) -> DataFrame:
    """(chunk, ids as bytes) of distinct chunks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(model.value)
        kind = id_type(m)
        for batch in pieces(batches, "chunk", 1 << 20):
            ids = to_bytes(m.segment(as_text(batch.column("chunk").to_pylist())), kind)
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(ids, pa.binary())], ["chunk", "ids"])

    return chunks.select("chunk").mapInArrow(work, "chunk binary, ids binary")


def named_chunks(texts: DataFrame, text: str, model: Broadcast) -> DataFrame:
    """(chunk, n): chunks that are frequent in a batch, and how often they stand in such batches."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = loaded(model.value).cuts
        for batch in pieces(batches, text, 16 << 20):
            found = pc.value_counts(chunked(batch.column(text), cuts)[0])
            counts = found.field("counts").to_numpy(zero_copy_only=False)
            named = pa.array(np.flatnonzero(counts >= max(2, counts.sum() >> 20)))
            yield pa.RecordBatch.from_arrays(
                [found.field("values").take(named).cast(pa.binary()), found.field("counts").take(named)], ["chunk", "n"]
            )

    named = texts.select(text).mapInArrow(count, "chunk binary, n long")
    return named.groupBy("chunk").agg(F.sum("n").alias("n"))


def id_type(model: Model) -> str:
    return "<u2" if len(model.pieces) <= 1 << 16 else "<u4"


def least_hot(short: DataFrame, most: int) -> int | None:
    """The least count of a hot chunk, so that at most that many chunks have it; by eighths of octaves."""
    octave = F.floor(F.log2("n") * 8).cast("int")
    sizes = short.groupBy(octave.alias("o")).agg(F.count("*").alias("c"), F.min("n").alias("least")).collect()
    total, least = 0, None
    for o in sorted(sizes, key=lambda r: -r.o):  # at most 8 * 63 rows
        total += o.c
        if total > most:
            break
        least = o.least
    return least


def hot_chunks(named: DataFrame, model: Broadcast, hot: Hot) -> tuple[pa.Array, pa.Array]:
    """The hot chunks by falling count, with their ids; at most hot.rows rows of hot.bytes bytes."""
    short = written(named.filter(F.octet_length("chunk") <= hot.bytes), "named_chunks")
    least = least_hot(short, hot.rows)
    if least is None:
        return pa.array([], pa.large_binary()), pa.array([], pa.binary())
    frequent = short.filter(F.col("n") >= least)
    counts = frequent.toArrow().combine_chunks()
    ids = segmented(frequent, model).toArrow().combine_chunks()
    rows = counts.join(ids, "chunk").sort_by([("n", "descending"), ("chunk", "ascending")])
    return rows["chunk"].combine_chunks().cast(pa.large_binary()), rows["ids"].combine_chunks()


def looked_up(model: Broadcast, hot: Broadcast, text: str, rest: list[str], rare: bool) -> Callable:
    """Rows of texts to rows with their codes, or to one row per rare chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, known = loaded(model.value).cuts, hot.value[0]
        for batch in pieces(batches, text, 16 << 20):
            chunks, first = chunked(batch.column(text), cuts)
            at = pc.fill_null(pc.index_in(chunks, value_set=known), -1).to_numpy(zero_copy_only=False)
            if rare:
                missing = np.flatnonzero(at < 0)
                row = np.searchsorted(first, missing, side="right") - 1
                out = [batch.column(c).take(pa.array(row)) for c in rest]
                out += [pa.array((missing - first[row]).astype(np.int32)), chunks.take(pa.array(missing)).cast(pa.binary())]
                yield pa.RecordBatch.from_arrays(out, [*rest, "k", "chunk"])
                continue
            data, sizes = varints(at.astype(np.int64) + 1)
            ends = np.concatenate([[0], np.cumsum(sizes)])[first].astype(np.int32)
            codes = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data)]
            )
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], codes], [*rest, "codes"])

    return work


def filled(model: Broadcast, hot: Broadcast, rest: list[str], decoded: bool) -> Callable:
    """Rows with codes and the ids of their rare chunks to rows with ids, and with their text if asked for."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(model.value)
        kind = id_type(m)
        width = np.dtype(kind).itemsize
        known, known_at = values_of(hot.value[1])
        known, known_at = known.view(kind), known_at // width
        for batch in pieces(batches, "codes", 1 << 20):
            data, starts = values_of(batch.column("codes"))
            numbers, begins = from_varints(data)
            first = np.searchsorted(begins, starts)
            found = batch.column("found")
            inner = found.flatten()
            extra, extra_at = values_of(inner.field("ids"))
            extra, extra_at = extra.view(kind), extra_at // width
            per_row = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False)
            place = np.repeat(first[:-1], per_row) + inner.field("k").to_numpy(zero_copy_only=False)
            code = numbers - 1
            if not np.array_equal(place, np.flatnonzero(code < 0)):
                raise RuntimeError("a chunk found no ids")
            hot_at = np.maximum(code, 0) if len(known_at) > 1 else np.zeros(0, np.int64)
            source_at, source_len = np.zeros((2, len(code)), np.int64)
            source_at[: len(hot_at)] = known_at[:-1][hot_at]
            source_len[: len(hot_at)] = np.diff(known_at)[hot_at]
            source_at[place] = extra_at[:-1] + len(known)
            source_len[place] = np.diff(extra_at)
            ids = np.concatenate([known, extra])
            ends = np.concatenate([[0], np.cumsum(source_len)])
            take = np.arange(ends[-1]) + np.repeat(source_at - ends[:-1], source_len)
            flat, rows = ids[take].astype(np.int32), ends[first].astype(np.int32)
            out = [*[batch.column(c) for c in rest], pa.ListArray.from_arrays(pa.array(rows), pa.array(flat))]
            if decoded:
                out.append(pa.array([m.decode(flat[i:j]) for i, j in zip(rows, rows[1:], strict=False)], pa.string()))
            yield pa.RecordBatch.from_arrays(out, [*rest, "ids", "decoded"][: len(out)])

    return work


def values_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary array, and where each value begins and the last one ends."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    values = pc.fill_null(values.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _with_schema(rows: DataFrame, work: Callable, *added: str) -> DataFrame:
    """work over the batches of rows; its result has the column carried and the added ones."""
    carried = f"carried {rows.schema['carried'].dataType.simpleString()}"
    return rows.mapInArrow(work, ", ".join([carried, *added]))


def _carried(rows: DataFrame, without: str) -> DataFrame:
    inner = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rows.columns) if c != without]
    return rows.select(F.struct(F.lit(0).alias("none"), *inner).alias("carried"), F.col(f"`{without}`"))


def _unpacked(rows: DataFrame, names: list[str], without: str, *new: str) -> DataFrame:
    back = [F.col(f"carried.c{i}").alias(c) for i, c in enumerate(names) if c not in (without, *new)]
    return rows.select(*back, *new)


def encode(
    docs: DataFrame, model_path: str, text: str = "text", hot: Hot = Hot(), decoded: bool = False
) -> DataFrame:
    """docs without the text, with ids: array<int>. ``decoded`` adds what decode gives for them, in the same pass."""
    model = shared(docs.sparkSession, model_path)
    body = F.coalesce(F.col("text"), F.lit(""))
    texts = _carried(docs, text).withColumnRenamed(text, "text").select(
        "carried",
        F.xxhash64(body).alias("h1"),
        F.xxhash64(F.lit(1), body).alias("h2"),
        body.alias("text"),
    )
    frequent = docs.sparkSession.sparkContext.broadcast(hot_chunks(named_chunks(texts, "text", model), model, hot))
    coded = _with_schema(
        texts, looked_up(model, frequent, "text", ["carried", "h1", "h2"], False), "h1 long, h2 long, codes binary"
    )
    rare = texts.select("h1", "h2", "text").mapInArrow(
        looked_up(model, frequent, "text", ["h1", "h2"], True), "h1 long, h2 long, k int, chunk binary"
    )
    table = segmented(rare.select("chunk").distinct(), model)
    met = rare.join(table, "chunk").select("h1", "h2", "k", "ids")
    # Dealt as they are; sets begun before the exchange would be larger.
    met = met.repartition("h1", "h2")
    found = met.groupBy("h1", "h2").agg(F.array_sort(F.collect_set(F.struct("k", "ids"))).alias("found"))
    joined = coded.join(found, ["h1", "h2"], "left").select("carried", "codes", "found")
    new = ["ids array<int>", "decoded string"] if decoded else ["ids array<int>"]
    done = _with_schema(joined, filled(model, frequent, ["carried"], decoded), *new)
    return _unpacked(done, docs.columns, text, *[c.split()[0] for c in new])


def decode(rows: DataFrame, model_path: str, ids: str = "ids") -> DataFrame:
    """rows without the ids, with their text."""
    model = shared(rows.sparkSession, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = loaded(model.value)
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            texts = [m.decode(x) for x in np.split(flat, ends[:-1])] if len(ends) else []
            yield pa.RecordBatch.from_arrays([batch.column("carried"), pa.array(texts, pa.string())], ["carried", "text"])

    packed = _carried(rows, ids).withColumnRenamed(ids, "ids")
    return _unpacked(_with_schema(packed, work, "text string"), rows.columns, ids, "text")
