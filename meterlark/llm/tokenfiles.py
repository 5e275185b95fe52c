"""Token-id files: every document compressed by itself with one shared zstandard dictionary.

A file holds, in this order: MAGIC; the length of a JSON header (8 bytes) and the header, with the
SHA-256 of the dictionary, the width of an id in bytes and the number of documents; one zstandard
frame per document; the index, three arrays of little-endian 64-bit integers (id of the document,
place of its frame, tokens before it in the file, each with one more entry for the end, of the ids
a bit map of nulls after them); the place of the index (8 bytes); MAGIC. One document is read by
its index entry and its frame alone. The dictionary is a file of its own in the same folder.

Documents are ordered by id (nulls first, then by a hash of the text where ids repeat) over all files. A task
writes each file under a name of its own; the list of files is written by Spark's commit protocol
and only listed files are read, so a lost attempt leaves nothing behind that is seen.

Texts are encoded by the public tokenizers library, each distinct word of a batch once: no
token of this kind of vocabulary crosses ASCII white space. Null texts count as empty; an empty
text has only the end id. A text of any length is encoded whole. No documents give no files.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlark.llm.common import small_batches, store, texts_of
from meterlark.session import fresh_path, materialize

MAGIC = b"TOKIDS01"
#: Documents on which the dictionary is trained (on average at most), the longest of them in ids, and its size.
SAMPLE, SAMPLE_IDS, DICTIONARY_BYTES = 3000, 16_384, 64 * 1024
#: A file is closed when it has more compressed bytes than this.
FILE_BYTES = 512 << 20
#: Words whose ids a worker remembers.
REMEMBERED = 1_000_000
LEVEL = 3


class LibraryEncoder:
    """The tokenizers library, asked once for each distinct word, and for simple words once for each part."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"
        self.known: dict[bytes, bytes] = {b"": b""}
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        #: Of each id whether it ends a piece, if the vocabulary tells.
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool) if suffix else None
        for token, k in vocabulary.items() if suffix else ():
            self.ends[k] = token.endswith(suffix)

    def packed(self, texts: list[str], end: int) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned integers of this width."""
        split = pc.ascii_split_whitespace(pa.array([_lowered(t) for t in texts], pa.binary()).cast(pa.string()))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_pylist()
        if len(self.known) > REMEMBERED:
            self.known = {b"": b""}
        self.learn(set(words).difference(self.known))
        found = [self.known[w] for w in words]
        ids, ends = np.frombuffer(b"".join(found), self.kind), np.cumsum([0, *map(len, found)]) // np.dtype(self.kind).itemsize
        word = coded.indices.to_numpy(zero_copy_only=False)
        stops = np.cumsum(ends[word + 1] - ends[word])
        starts = np.concatenate([[0], stops])
        every = ids[np.arange(starts[-1]) + np.repeat(ends[word] - starts[:-1], np.diff(starts))]
        edges = starts[split.offsets.to_numpy()].tolist()
        last = np.array([end], self.kind).tobytes()
        return [every[x:y].tobytes() + last for x, y in zip(edges[:-1], edges[1:], strict=True)]

    def learn(self, fresh: set[bytes]) -> None:
        """Find the ids of words that are not remembered."""
        # Letters and the marks behind them are two pieces for the vocabulary, whatever stands around them.
        cut = {w: m.groups() for w in fresh if (m := _LETTERS_MARKS(w))} if self.ends is not None else {}
        self.ask(fresh.difference(cut))
        self.ask_pieces({piece for pieces in cut.values() for piece in pieces if piece})
        known = self.known
        known.update((w, known[a] + known[b]) for w, (a, b) in cut.items() if b)

    def ask_pieces(self, pieces: set[bytes]) -> None:
        """The same as `ask` for words of one piece each, many in one text: where a piece ends is seen in its ids."""
        fresh = list(pieces.difference(self.known))
        for k in range(0, len(fresh), 4096):
            part = fresh[k : k + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(part).decode("utf-8")], add_special_tokens=False)[0].ids, self.kind)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                self.ask(set(part))
                continue
            packed, places = ids.tobytes(), (stops * ids.itemsize).tolist()
            self.known.update((w, packed[a:b]) for w, a, b in zip(part, [0, *places[:-1]], places, strict=True))

    def ask(self, words: set[bytes]) -> None:
        """Have the library encode those of the words that are not remembered."""
        fresh = list(words.difference(self.known))
        for k in range(0, len(fresh), 4096):
            part = fresh[k : k + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode("utf-8") for w in part], add_special_tokens=False)
            self.known.update((w, np.array(e.ids, self.kind).tobytes()) for w, e in zip(part, found, strict=True))


# Letters of U+00C0 to U+024F but U+0130, whose lower case is a letter and a combining mark, and ASCII marks behind them, in UTF-8.
_LETTERS_MARKS = re.compile(
    rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]|\xc4[\x80-\xaf\xb1-\xbf]|[\xc5-\xc8][\x80-\xbf]|\xc9[\x80-\x8f])+)([!-/:-@\[-`{-~]*)"
).fullmatch


def _lowered(text: str) -> bytes:
    """The text in UTF-8; its words are what stands between ASCII white space.

    A-Z are lowered first, as the vocabulary does later, unless special tokens can be there or
    marks of U+0300 to U+037F, with which a small letter may have a composed form that its capital lacks.
    """
    raw = text.encode("utf-8")
    return raw if b"<|" in raw or b"\xcc" in raw or b"\xcd" in raw else raw.lower()


_ENCODERS: dict[str, LibraryEncoder] = {}


def library_encoder(path: str) -> LibraryEncoder:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = LibraryEncoder(path)
    return _ENCODERS[path]


def train_dictionary(docs: DataFrame, vocabulary: str, end: int, key: str = "doc_id", text: str = "text") -> bytes:
    """A dictionary for the serialized ids of these documents, from a bounded sample; runs a job."""
    share = int(min(1.0, SAMPLE / max(1, docs.count())) * (1 << 30))

    def run(batches):
        encoder = library_encoder(vocabulary)
        width = np.dtype(encoder.kind).itemsize
        for batch in small_batches(batches, 256, 0):
            found = [p for p in encoder.packed(texts_of(batch.column(0)), end) if len(p) <= SAMPLE_IDS * width]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["ids"])

    picked = docs.where(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 30)) <= share).select(text)
    samples = sorted(bytes(r.ids) for r in picked.mapInArrow(run, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]  # too few documents to train on


class FileWriter:
    """Writes one file in a folder."""

    def __init__(self, name: str, dictionary: bytes, kind: str, end: int) -> None:
        fs, path = store(name)
        self.name, self.out, self.kind = name, fs.open_output_stream(path, compression=None), kind
        self.compressor = zstandard.ZstdCompressor(LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        head = json.dumps({"dictionary": hashlib.sha256(dictionary).hexdigest(), "width": np.dtype(kind).itemsize, "end": end}).encode()
        self.out.write(MAGIC + len(head).to_bytes(8, "little") + head)
        self.place, self.tokens = 16 + len(head), 0
        self.ids: list[int | None] = []
        self.places, self.starts = [], []

    def add(self, key: int | None, packed: bytes) -> None:
        frame = self.compressor.compress(packed)
        self.ids.append(key)
        self.places.append(self.place)
        self.starts.append(self.tokens)
        self.out.write(frame)
        self.place += len(frame)
        self.tokens += len(packed) // np.dtype(self.kind).itemsize

    def close(self) -> None:
        known = np.array([k is not None for k in self.ids])
        parts = [np.array([k or 0 for k in self.ids], "<i8"), np.array([*self.places, self.place], "<i8"), np.array([*self.starts, self.tokens], "<i8"), np.packbits(known)]
        for part in (np.array([len(self.ids)], "<i8"), *parts):
            self.out.write(part.tobytes())
        self.out.write(self.place.to_bytes(8, "little") + MAGIC)
        self.out.close()


class FileReader:
    """One file: its index, and documents by their number in the file."""

    def __init__(self, name: str) -> None:
        fs, path = store(name)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        self.file.seek(size - 16)
        tail = self.file.read(16)
        self.file.seek(0)
        head = self.file.read(16)
        if head[:8] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{name} is not a whole file of token ids")
        spec = json.loads(self.file.read(int.from_bytes(head[8:], "little")))
        place = int.from_bytes(tail[:8], "little")
        self.file.seek(place)
        raw = self.file.read(size - 16 - place)
        n = int(np.frombuffer(raw, "<i8", 1)[0])
        numbers = np.frombuffer(raw, "<i8", 3 * n + 2, 8)
        known = np.unpackbits(np.frombuffer(raw, "u1", -1, 8 * (3 * n + 3)), count=n).astype(bool)
        self.ids = [int(k) if ok else None for k, ok in zip(numbers[:n], known, strict=True)]
        self.places, self.starts = numbers[n : 2 * n + 1], numbers[2 * n + 1 :]
        self.kind = f"<u{spec['width']}"
        with fs.open_input_file(os.path.join(os.path.dirname(path), DICTIONARY)) as f:
            dictionary = f.read()
        if hashlib.sha256(dictionary).hexdigest() != spec["dictionary"]:
            raise ValueError(f"{name} was written with another dictionary")
        self.decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def tokens(self, number: int) -> np.ndarray:
        """Ids of one document; only its frame is read."""
        start = int(self.places[number])
        self.file.seek(start)
        return np.frombuffer(self.decompressor.decompress(self.file.read(int(self.places[number + 1]) - start)), self.kind)

    def find(self, key: int) -> list[int]:
        """Numbers of the documents with this id."""
        first = self.ids.count(None)
        known = np.array(self.ids[first:], np.int64)
        return list(range(first + int(np.searchsorted(known, key, "left")), first + int(np.searchsorted(known, key, "right"))))


DICTIONARY = "dictionary.zstd"


def write(docs: DataFrame, vocabulary: str, end: int, folder: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and write all documents; returns the files in order (file, part, number, docs, tokens, bytes). Runs jobs."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-ids")
    fs, path = store(folder)
    fs.create_dir(path, recursive=True)
    dictionary = train_dictionary(docs, vocabulary, end, key, text)
    with fs.open_output_stream(f"{path}/{DICTIONARY}", compression=None) as out:
        out.write(dictionary)

    def run(batches):
        encoder = library_encoder(vocabulary)
        part, number, writer = TaskContext.get().partitionId(), 0, None
        for batch in small_batches(batches, 4096, 1, 8_000_000):
            for k, packed in zip(batch.column(0).to_pylist(), encoder.packed(texts_of(batch.column(1)), end), strict=True):
                writer = writer or FileWriter(f"{folder}/{uuid.uuid4().hex}.tokens", dictionary, encoder.kind, end)
                writer.add(k, packed)
                if writer.place > FILE_BYTES:
                    writer.close()
                    yield listed(writer, part, number)
                    writer, number = None, number + 1
        if writer:
            writer.close()
            yield listed(writer, part, number)

    def listed(writer, part, number):
        row = {"file": writer.name, "part": part, "number": number, "docs": len(writer.ids), "tokens": writer.tokens, "bytes": writer.place}
        return pa.RecordBatch.from_pylist([row], pa.schema([("file", pa.string()), ("part", pa.int32()), ("number", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64())]))

    # The hash splits an id that very many rows share. It stands for the text, since Spark samples what it ranges by.
    order = [F.col(key).asc_nulls_first(), F.xxhash64(text).asc()]
    ordered = docs.select(F.col(key), F.col(text)).repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.mapInArrow(run, "file string, part int, number int, docs long, tokens long, bytes long"), "token-files")


def read(spark: SparkSession, files: DataFrame, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; `start` counts the ids of all documents before it.

    With `digests`, `ids_crc32` (of the ids as little-endian unsigned 32-bit integers) takes the
    place of the ids. The list of files passes the driver, as with any file source.
    """
    first, parts = 0, []
    for r in files.orderBy("part", "number").toLocalIterator():
        parts.append((r.file, first))
        first += r.tokens

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                reader = FileReader(name)
                for a in range(0, len(reader.ids), 64):
                    b = min(a + 64, len(reader.ids))
                    found = [reader.tokens(k) for k in range(a, b)]
                    if digests:
                        out = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in found], pa.int64())
                    else:
                        out = pa.array([x.astype(np.int32) for x in found], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.ids[a:b], pa.int64()), pa.array(reader.starts[a:b] + before), pa.array([len(x) for x in found], pa.int64()), out],
                        ["doc_id", "start", "n_tokens", "ids_crc32" if digests else "ids"],
                    )

    schema = "doc_id long, start long, n_tokens long, " + ("ids_crc32 long" if digests else "ids array<int>")
    listed = spark.createDataFrame(parts, "file string, first long")
    return listed.repartition(max(1, len(parts))).mapInArrow(run, schema)
