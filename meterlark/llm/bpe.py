"""Byte-pair encoding with a memory-mapped lexicon of frequent words, and its inverse.

Words (pieces between ASCII white space, after normalisation) that are frequent in the corpus
are compiled into a minimal acyclic automaton: common prefixes and common suffixes are stored
once. Each transition carries how many words come before it, so the automaton numbers its words
without gaps, and the number leads to the word's ids. All other words are merged exactly, pair
by pair, so results never depend on which words are in the lexicon.

Nulls count as empty texts; an empty text has no ids and decodes to an empty text. A text of any
length is encoded whole. Rows that repeat are encoded each. An empty table gives an empty result.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import ship_bytes, small_batches, texts_of
from meterlark.session import materialize

#: Words in the lexicon. Its size is bounded by this number, whatever the corpus.
LEXICON_WORDS = 200_000
#: Longer words are merged when met; they would make the walk through the automaton long.
LEXICON_BYTES = 48
#: Longer pieces are merged one by one, with a heap.
LONG_PIECE = 40
#: Words of which one task counts at once, before it hands the counts on.
COUNTED_AT_ONCE = 500_000
#: Words outside the lexicon whose ids a Python worker remembers.
REMEMBERED = 900_000
MAGIC = b"LEXICON1"


# ---------------------------------------------------------------- vocabulary and exact merges


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 256
    for b in range(256):
        if b in shown:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class Vocabulary:
    """A word-level BPE vocabulary file: normalisation, splitting, exact merging, decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        letters = byte_letters()
        self.inner = np.array([self.vocab[x] for x in letters], np.int64)
        self.last = np.array([self.vocab[x + self.suffix] for x in letters], np.int64)
        pairs = np.array([(a << 32) + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.pair_keys, self.pair_ranks = pairs[order], np.array([x[0] for x in self.merges.values()], np.int64)[order]
        self.made = np.array([x[1] for x in self.merges.values()], np.int64)  # by rank
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._library = None

    def library(self):
        """The public library's tokenizer, for characters that this Python's Unicode data lacks."""
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def normal(self, text: str) -> str:
        """NFC and lower case, each character by itself (so no special final sigma)."""
        if text.isascii():
            return text.lower()
        if unassigned(text):
            return self.library().normalizer.normalize_str(text)
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()

    def segments(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, text) of each part; special tokens are found before normalisation."""
        if self.specials is None or "<" not in text:
            yield False, text
            return
        for k, part in enumerate(self.specials.split(text)):
            if part:
                yield k % 2 == 1, part

    def split(self, word: bytes) -> list[bytes]:
        """The pieces of a normalised word; merges never cross their borders."""
        text = word.decode("utf-8")
        if not text.isascii() and unassigned(text):
            back = {c: b for b, c in enumerate(byte_letters())}
            return [bytes(back[c] for c in p) for p, _ in self.library().pre_tokenizer.pre_tokenize_str(text)]
        if text.isalpha():
            return [word]
        if text[-1] in ",.;:!?" and text[:-1].isalpha():
            return [word[:-1], word[-1:]]
        return [p.encode("utf-8") for p in self.pieces.findall(text)]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or the number of merges where there is none."""
        want = (a << 32) + b
        at = np.minimum(np.searchsorted(self.pair_keys, want), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == want, self.pair_ranks[at], len(self.made))

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, as little-endian unsigned 32-bit integers.

        Pieces of one length are merged together, each step merging the best pair of every
        piece, the leftmost first. Long pieces are merged one by one.
        """
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            by_length.setdefault(len(piece), []).append(k)
        for length, where in by_length.items():
            if length > LONG_PIECE:
                for k in where:
                    raw = np.frombuffer(pieces[k], np.uint8)
                    ids = [*self.inner[raw[:-1]].tolist(), int(self.last[raw[-1]])]
                    out[k] = np.asarray(_merge_long(ids, self.merges), "<u4").tobytes()
                continue
            raw = np.frombuffer(b"".join(pieces[k] for k in where), np.uint8).reshape(-1, length)
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            ranks, rows = self.ranks(ids[:, :-1], ids[:, 1:]), np.array(where)
            while len(rows):
                width = ids.shape[1]
                best = ranks.argmin(1) if width > 1 else np.zeros(len(rows), np.int64)
                rank = ranks[np.arange(len(rows)), best] if width > 1 else np.full(len(rows), len(self.made))
                done = rank == len(self.made)
                blob = ids[done].astype("<u4").tobytes()
                for n, k in enumerate(rows[done].tolist()):
                    out[k] = blob[4 * width * n : 4 * width * (n + 1)]
                go = ~done
                rows, best, rank = rows[go], best[go, None], rank[go]
                if not len(rows):
                    break
                cols = np.arange(width - 1)
                ids = np.take_along_axis(ids[go], cols + (cols > best), 1)
                np.put_along_axis(ids, best, self.made[rank][:, None], 1)
                cols = np.arange(width - 2)
                ranks = np.take_along_axis(ranks[go], cols + (cols >= best), 1)
                line, best = np.arange(len(rows)), best[:, 0]
                some = best > 0
                r, c = line[some], best[some]
                ranks[r, c - 1] = self.ranks(ids[r, c - 1], ids[r, c])
                some = best < width - 2
                r, c = line[some], best[some]
                ranks[r, c] = self.ranks(ids[r, c], ids[r, c + 1])
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Ids of normalised words without ASCII white space, as little-endian unsigned 32-bit integers."""
        split = [self.split(w) for w in words]
        pieces = list({p for s in split for p in s})
        known = dict(zip(pieces, self.merged(pieces), strict=True))
        return [b"".join([known[p] for p in s]) for s in split]


def _merge_long(ids: list[int], merges: dict) -> list[int]:
    """The same with a heap and linked positions, for words of any length."""
    n = len(ids)
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(found[0], k, ids[k], ids[k + 1], found[1]) for k in range(n - 1) if (found := merges.get((ids[k], ids[k + 1])))]
    heapq.heapify(heap)
    while heap:
        _, k, a, b, new = heapq.heappop(heap)
        r = right[k]
        if ids[k] != a or r < 0 or ids[r] != b:
            continue
        ids[k], ids[r] = new, -1
        right[k] = right[r]
        if right[r] >= 0:
            left[right[r]] = k
        for i, j in ((left[k], k), (k, right[k])):
            if i >= 0 and j >= 0 and (found := merges.get((ids[i], ids[j]))):
                heapq.heappush(heap, (found[0], i, ids[i], ids[j], found[1]))
    return [i for i in ids if i >= 0]


_ASSIGNED: set[str] = set()


def unassigned(text: str) -> bool:
    """Whether a character has no category in this Python's Unicode data."""
    fresh = set(text) - _ASSIGNED
    if not fresh:
        return False
    free = {c for c in fresh if unicodedata.category(c) == "Cn"}
    _ASSIGNED.update(fresh - free)
    return bool(free)


# ---------------------------------------------------------------- the automaton


def build_lexicon(words: dict[bytes, bytes]) -> bytes:
    """The file of a minimal acyclic automaton over `words`, with the ids of each.

    Words are added in sorted order; whenever a branch is complete, each of its states is
    replaced by an equal one if there is one already, so equal suffixes share their states.
    """
    ordered = sorted(words)
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    path: list[list] = [[False, []]]  # open states: final, transitions (label, state or None while open)

    def close(down_to: int) -> None:
        while len(path) > down_to:
            final, moves = path.pop()
            key = (final, tuple(moves))
            at = register.get(key)
            if at is None:
                at = register[key] = len(states)
                states.append(key)
            if path:
                path[-1][1][-1] = (path[-1][1][-1][0], at)

    before = b""
    for word in ordered:
        same = 0
        while same < min(len(word), len(before)) and word[same] == before[same]:
            same += 1
        close(same + 1)
        for b in word[same:]:
            path[-1][1].append((b, -1))
            path.append([False, []])
        path[-1][0] = True
        before = word
    close(1)
    final, moves = path.pop()
    states.append((final, tuple(moves)))  # the root is the last state

    size = np.zeros(len(states), np.int64)  # words from a state on; targets come before their sources
    keys, targets, skips = [], [], []
    for s, (final, moves) in enumerate(states):
        n = int(final)
        for label, target in moves:
            keys.append(s * 256 + label)
            targets.append(target)
            skips.append(n)
            n += int(size[target])
        size[s] = n
    ids = [words[w] for w in ordered]
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
    parts = [
        np.asarray(keys, "<i8"),
        np.asarray(targets, "<i4"),
        np.asarray(skips, "<i4"),
        np.asarray([s[0] for s in states], "u1"),
        np.asarray(ends, "<i8"),
        np.frombuffer(b"".join(ids), "<u4"),
    ]
    head = json.dumps([[str(p.dtype), len(p)] for p in parts]).encode()
    out = bytearray(MAGIC + len(head).to_bytes(8, "little") + head)
    for p in parts:
        out += b"\0" * (-len(out) % 8) + p.tobytes()
    return bytes(out)


class Lexicon:
    """A lexicon file, memory-mapped: tasks of one machine share its pages."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            if f.read(8) != MAGIC:
                raise ValueError(f"{path} is not a lexicon")
            head = int.from_bytes(f.read(8), "little")
            parts = json.loads(f.read(head))
            at, arrays = 16 + head, []
            for kind, n in parts:
                at += -at % 8
                arrays.append(np.asarray(np.memmap(path, kind, "r", at, (n,))) if n else np.zeros(0, kind))
                at += n * np.dtype(kind).itemsize
        self.keys, self.targets, self.skips, self.final, self.ends, self.ids = arrays

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Ids as little-endian unsigned 32-bit integers of each word, None where it is not in the lexicon.

        All words walk through the automaton together, one letter a step.
        """
        out: list[bytes | None] = [None] * len(words)
        if not len(self.keys):
            return out
        some = np.array([k for k, w in enumerate(words) if 0 < len(w) <= LEXICON_BYTES], np.int64)
        if not len(some):
            return out
        joined = np.frombuffer(b"".join(words[k] for k in some), np.uint8)
        lengths = np.array([len(words[k]) for k in some], np.int64)
        starts = np.cumsum(lengths) - lengths
        state = np.full(len(some), len(self.final) - 1, np.int64)
        number = np.zeros(len(some), np.int64)
        live = np.arange(len(some))
        for step in range(int(lengths.max())):
            live = live[lengths[live] > step]
            want = state[live] * 256 + joined[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, want), len(self.keys) - 1)
            hit = self.keys[at] == want
            state[live[~hit]] = -1
            live, at = live[hit], at[hit]
            number[live] += self.skips[at]
            state[live] = self.targets[at]
        good = (state >= 0) & self.final[np.maximum(state, 0)].astype(bool)
        for k in np.flatnonzero(good):
            n = number[k]
            out[some[k]] = self.ids[self.ends[n] : self.ends[n + 1]].tobytes()
        return out


# ---------------------------------------------------------------- encoding and decoding in a task


class Encoder:
    """Encodes texts with a lexicon and exact merges; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        """Find the ids of words that are not remembered."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh = list(words.difference(self.known))
        found = self.lexicon.find(fresh) if self.lexicon else [None] * len(fresh)
        unseen = [w for w, ids in zip(fresh, found, strict=True) if ids is None]
        self.known.update((w, ids) for w, ids in zip(fresh, found, strict=True) if ids is not None)
        self.known.update(zip(unseen, self.vocabulary.words(unseen), strict=True))

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        v = self.vocabulary
        split: list[list] = []
        need: set[bytes] = set()
        for text in texts:
            parts = []
            for special, part in v.segments(text):
                if special:
                    parts.append(v.special[part].to_bytes(4, "little"))
                else:
                    words = v.normal(part).encode("utf-8", "surrogatepass").split()
                    need.update(words)
                    parts.append(words)
            split.append(parts)
        self.learn(need)
        get = self.known.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(get, p)) for p in parts) for parts in split]


class Decoder:
    """Ids back to text: this vocabulary has no decoder, so its tokens are joined by one space."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        top = max(vocabulary.tokens, default=-1) + 1
        self.tokens = [vocabulary.tokens.get(i, "").encode("utf-8") for i in range(top)]

    def texts(self, packed: list[bytes]) -> list[bytes]:
        get = self.tokens.__getitem__
        return [b" ".join(map(get, np.frombuffer(p, "<u4").tolist())) for p in packed]


_VOCABULARIES: dict[str, Vocabulary] = {}
_ENCODERS: dict[tuple, Encoder] = {}
_DECODERS: dict[str, Decoder] = {}


def vocabulary_of(path: str) -> Vocabulary:
    """The worker's vocabulary; one at a time."""
    if path not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encoder(path: str, lexicon: str | None) -> Encoder:
    """The worker's encoder; tasks that follow each other in one worker share what it remembers."""
    if (path, lexicon) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, lexicon] = Encoder(vocabulary_of(path), Lexicon(SparkFiles.get(lexicon)) if lexicon else None)
    return _ENCODERS[path, lexicon]


def decoder(path: str) -> Decoder:
    if path not in _DECODERS:
        _DECODERS[path] = Decoder(vocabulary_of(path))
    return _DECODERS[path]


# ---------------------------------------------------------------- DataFrame operators


def word_counts(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """How often each normalised word occurs in all texts: (word binary, n long).

    Each task adds up its own words first, a bounded number at a time.
    """

    def count(batches):
        v, seen = vocabulary_of(vocabulary), Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if value:
                    seen.update(v.normal(value).encode("utf-8", "surrogatepass").split())
                    if len(seen) > COUNTED_AT_ONCE:
                        yield counted(seen)
                        seen = Counter()
        if seen:
            yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    return docs.select(text).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_lexicon(docs: DataFrame, vocabulary: str, text: str = "text", words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent words of all texts and ship the file; runs jobs.

    Counts are put into classes of nearly equal frequency, and as many of the highest classes are
    compiled as have at most `words` words together, so that no more than these reach the driver.
    Words that occur once are left to the merges.
    """
    level = F.floor(F.log2("n") * 16).cast("int")
    repeated = word_counts(docs, vocabulary, text).where((F.col("n") > 1) & (F.length("word") <= LEXICON_BYTES))
    counts = materialize(repeated.select("word", level.alias("level")), "words")
    room, least = words, None
    for r in counts.groupBy("level").count().orderBy(F.desc("level")).collect():
        room -= r["count"]
        if room < 0:
            break
        least = r["level"]
    top = counts.where(F.col("level") >= least).collect() if least is not None else []
    frequent = [bytes(r.word) for r in top]
    ids = vocabulary_of(vocabulary).words(frequent)
    return ship_bytes(docs.sparkSession, build_lexicon(dict(zip(frequent, ids, strict=True))), "lexicon")


def encode(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", lexicon: str | None = None) -> DataFrame:
    """(key, n_tokens int, ids array<int>) of every row; `lexicon` as from `fit_lexicon`."""

    def run(batches):
        enc = encoder(vocabulary, lexicon)
        for batch in small_batches(batches, 256, 1):
            packed = enc.packed(texts_of(batch.column(1)))
            flat = np.frombuffer(b"".join(packed), "<i4")
            n = np.array([len(p) // 4 for p in packed], np.int32)
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), ids], [key, "n_tokens", "ids"])

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens int, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, decoded string) of every row of ids; null ids count as none."""

    def run(batches):
        dec = decoder(vocabulary)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                packed = [np.asarray(x or [], "<u4").tobytes() for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(x.decode("utf-8") for x in dec.texts(packed))], [key, "decoded"])

    kind = encoded.select(key).schema[0].dataType.simpleString()
    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, decoded string")


def round_trip(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", lexicon: str | None = None) -> DataFrame:
    """Encode and decode in one pass: (key, n_tokens, ids_sha256, decoded_sha256) of every row.

    The ids are hashed as little-endian unsigned 32-bit integers, the decoded text as UTF-8.
    """

    def run(batches):
        enc, dec = encoder(vocabulary, lexicon), decoder(vocabulary)
        for batch in small_batches(batches, 256, 1):
            packed = enc.packed(texts_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(t).hexdigest() for t in dec.texts(packed)]),
                ],
                [key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
