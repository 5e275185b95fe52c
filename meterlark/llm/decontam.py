"""Benchmark decontamination by templates: copies are found even with other numbers and names.

Texts are cut into lower-case words without punctuation. Numbers, units after a number, and
names (words with one capital that do not begin a sentence) become typed placeholders. Line breaks
do not end a sentence, and dashes between words are no words. The first word of an item counts both
as it stands and as a name, since what comes before it in a document is not known. What is a name
depends on capitals and on the word before, so every window is also compared with its names as plain
words: copies in lower case, in capitals or with other sentence ends are found by these. A document
holds an item if it has at least SHARE of the item's distinct windows of WORDS template words in one
of the readings, and if the values behind the placeholders agree: a value that comes several times in
the item, as a name anywhere or at the start of a sentence, must, in SHARE of its places at least,
stand for one value of the document: the same one in exact copies, another one in questions with new
parameters.

The benchmark is the query set. It is compared with all documents in blocks of at most
BLOCK_WINDOWS windows, whose hashes are joined in the tasks that read the documents; documents are
never shuffled. Window hashes have 64 bits.

Null texts count as empty. Empty texts hold nothing. Items of fewer than WORDS words have no window:
they are held by the texts that consist of the same words, and by no others. A text of any length is searched whole. Rows and
items that repeat are judged each; an empty benchmark leaves every document clean. All columns of
the documents are passed through by `mark`.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlark.llm.common import small_batches, texts_of
from meterlark.llm.minhash import _BYTE, _RANDOM, mix, powers

#: Words of a window, and the share of an item's windows and of its values that must agree.
WORDS, SHARE = 5, 0.8
#: Windows of a block of the benchmark; a block is broadcast.
BLOCK_WINDOWS = 1_000_000
#: Units that count as such directly after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months year years "
    "percent degree degrees celsius fahrenheit dollar dollars cent cents euro euros usd eur gbp mph kmh hz khz mhz ghz v volt volts w watt watts kw j joule joules n pa kb mb gb tb"
).split()
#: Number words.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty "
    "thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
NUMBER, UNIT, NAME = 1, 2, 3

_GAP = np.zeros(256, bool)
_GAP[list(b" \t\n\r\x0b\x0c.,;:!?\"()[]{}<>|*_#`'")] = True
_END = np.zeros(256, bool)
_END[list(b".!?:")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[list(b"0123456789")] = True
_POINT = np.zeros(256, bool)
_POINT[list(b".,:")] = True
_DASH = ord("-")
_NUMERIC = _DIGIT | _POINT
_NUMERIC[list(b"+-$%/")] = True


@dataclass
class Words:
    """Words of a text: where each begins and ends, its hash and kind, and its template hash."""

    data: bytes
    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    kinds: np.ndarray
    template: np.ndarray

    def windows(self, template: np.ndarray | None = None) -> np.ndarray:
        """Hash of each window of WORDS template words, by position; of other templates if given."""
        t = self.template if template is None else template
        n = len(t) - WORDS + 1
        if n < 1:
            return np.zeros(0, np.uint64)
        out = t[:n].copy()
        for k in range(1, WORDS):
            out = mix(out * _RANDOM[510]) + t[k : n + k]
        return mix(out)

    def value(self, at: int) -> bytes:
        return self.data[self.starts[at] : self.ends[at]]

    def unnamed(self) -> np.ndarray:
        """Hash of each window with its names as plain words, by position."""
        return self.windows(np.where(self.kinds == NAME, self.hashes, self.template))

    def whole(self) -> tuple[int, ...]:
        """The plain words of a short text."""
        return tuple(self.hashes.tolist())

    def slots(self) -> np.ndarray:
        """Whether each word has a value: placeholders, and words that are names elsewhere in the text."""
        return (self.kinds > 0) | np.isin(self.hashes, self.hashes[self.kinds == NAME])

    def others(self) -> list[tuple[int, int]]:
        """(hash, position) of windows that may read otherwise in a document."""
        out = []
        if len(self.template) >= WORDS and self.kinds[0] == 0:
            word = self.raw[self.starts[0] : self.ends[0]].decode("utf-8", "replace")
            if word[0].isupper() and word[1:] == word[1:].lower() and len(word) > 1:
                begun = self.template[:WORDS].copy()
                begun[0] = _RANDOM[520 + NAME]
                out.append((int(self.windows(begun)[0]), 0))
        if (self.kinds == NAME).any():
            plain = self.unnamed()
            out += [(int(plain[k]), int(k)) for k in np.flatnonzero(plain != self.windows())]
        return out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[: len(data)])])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words_of(text: str) -> Words:
    """Cut a text into words and classify them."""
    raw, low = text.encode("utf-8", "surrogatepass"), text.lower().encode("utf-8", "surrogatepass")
    if len(raw) != len(low):
        low = raw.lower()
    data = np.frombuffer(low, np.uint8)
    gap = _GAP[data]
    if len(data) > 2:
        inside = np.zeros(len(data), bool)
        inside[1:-1] = _POINT[data[1:-1]] & _DIGIT[data[:-2]] & _DIGIT[data[2:]]
        gap &= ~inside
    wall = np.concatenate([[True], gap, [True]])
    edge = np.flatnonzero(wall[1:] != wall[:-1])
    starts, ends = edge[::2], edge[1::2]
    worded = np.concatenate([[0], np.cumsum(data != _DASH)])
    apart = worded[ends] > worded[starts]
    starts, ends = starts[apart], ends[apart]
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return Words(low, raw, starts, ends, none, np.zeros(0, np.uint8), none)
    hashes = _hashes(data, starts, ends)
    kinds = np.zeros(len(starts), np.uint8)
    changed = np.concatenate([[0], np.cumsum(data != np.frombuffer(raw, np.uint8))])
    capitals = changed[ends] - changed[starts]
    first = changed[np.minimum(starts + 2, ends)] - changed[starts]
    closed = np.concatenate([[0], np.cumsum(gap & _END[data])])
    before = closed[starts] - closed[np.concatenate([[0], ends[:-1]])]
    before[0] = 1
    kinds[(capitals == 1) & (first == 1) & (before == 0) & (ends - starts > 1)] = NAME
    odd = np.concatenate([[0], np.cumsum(~_NUMERIC[data])])
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    has_digit = digits[ends] > digits[starts]
    kinds[(has_digit & (odd[ends] == odd[starts])) | np.isin(hashes, _NUMBER_HASHES)] = NUMBER
    follows = np.concatenate([[False], kinds[:-1] == NUMBER])
    kinds[follows & (kinds != NUMBER) & np.isin(hashes, _UNIT_HASHES)] = UNIT
    return Words(low, raw, starts, ends, hashes, kinds, np.where(kinds == 0, hashes, _RANDOM[520 + kinds.astype(np.int64)]))


def _listed(words: list[str]) -> np.ndarray:
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(_hashes(data, np.zeros(1, np.int64), np.array([len(data)]))[0])
    return np.sort(np.array(out, np.uint64))


_NUMBER_HASHES, _UNIT_HASHES = _listed(NUMBERS), _listed(UNITS)


class Block:
    """Some benchmark items, and an index from window hashes to the places that have them."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        self.ids = [k for k, _ in items]
        self.words = [words_of(t) for _, t in items]
        windows = [w.windows() for w in self.words]
        self.sizes = [len(set(w.tolist())) for w in windows]
        flat = np.concatenate([np.zeros(0, np.uint64), *windows])
        item = np.repeat(np.arange(len(windows)), [len(w) for w in windows])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(w)) for w in windows)])
        order = np.argsort(flat, kind="stable")
        self.keys, self.item, self.place = flat[order], item[order], place[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        # Other readings: (index of the window's first key, item, place) by hash.
        self.others: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        self.short: dict[tuple[int, ...], list[int]] = defaultdict(list)
        for i, w in enumerate(self.words):
            for key, at in w.others():
                self.others[key].append((int(np.searchsorted(self.keys, windows[i][at])), i, at))
            if 0 < len(w.hashes) < WORDS:
                self.short[w.whole()].append(i)
        self.other_keys = np.sort(np.fromiter(self.others, np.uint64, len(self.others)))
        self.maybe[self.other_keys >> np.uint64(44)] = True

    def held(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item id, windows of the item that the text has, all its windows, values, agreeing values) of each item held."""
        words = words_of(text)
        if len(words.hashes) < WORDS:
            return [(self.ids[i], 1, 1, 0, 0) for i in self.short.get(words.whole(), ())]
        if not len(self.keys):
            return []
        windows, places = words.windows(), np.arange(len(words.hashes) - WORDS + 1)
        if (words.kinds == NAME).any():
            plain = words.unnamed()
            other = np.flatnonzero(plain != windows)
            windows, places = np.concatenate([windows, plain[other]]), np.concatenate([places, other])
        some = np.flatnonzero(self.maybe[windows >> np.uint64(44)])
        windows, some = windows[some], places[some]
        low = np.searchsorted(self.keys, windows, "left")
        high = np.searchsorted(self.keys, windows, "right")
        again = []
        if len(self.other_keys):
            place = np.minimum(np.searchsorted(self.other_keys, windows), len(self.other_keys) - 1)
            for k in np.flatnonzero(self.other_keys[place] == windows).tolist():
                again += [(int(some[k]), *o) for o in self.others[int(windows[k])]]
        hit = high > low
        some, low, high = some[hit], low[hit], high[hit]
        if not len(some) and not again:
            return []
        # Windows of the text that are equal meet the same places; the first few hits decide nothing alone.
        distinct: dict[int, set[int]] = defaultdict(set)
        for a, b in {(int(a), int(b)) for a, b in zip(low, high, strict=True)}:
            for item in set(self.item[a:b].tolist()):
                distinct[item].add(a)
        for _, a, item, _ in again:
            distinct[item].add(a)
        full = {i for i, found in distinct.items() if len(found) >= SHARE * self.sizes[i]}
        if not full:
            return []
        pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, a, b in zip(some.tolist(), low.tolist(), high.tolist(), strict=True):
            for k in range(a, b):
                if int(self.item[k]) in full:
                    pairs[int(self.item[k])].append((at, int(self.place[k])))
        for at, _, item, place in again:
            if item in full:
                pairs[item].append((at, place))
        out = []
        for i in sorted(full):
            values, agreeing = self.agreement(words, self.words[i], pairs[i])
            if agreeing >= SHARE * values:
                out.append((self.ids[i], len(distinct[i]), self.sizes[i], values, agreeing))
        return out

    def agreement(self, text: Words, item: Words, hits: list[tuple[int, int]]) -> tuple[int, int]:
        """Places whose value comes again in the item, and those whose value in the text is the usual one for it.

        Only the run of hits that covers most of the item counts, one copy of it in the text.
        """
        slots = item.slots()
        if not slots.any():
            return 0, 0
        runs = Counter((at - place) // max(1, 2 * len(item.hashes)) for at, place in hits)
        run = max(runs, key=lambda r: (runs[r] + runs.get(r + 1, 0), -r))
        seen: dict[int, Counter] = defaultdict(Counter)
        for at, place in hits:
            if (at - place) // max(1, 2 * len(item.hashes)) in (run, run + 1):
                for k in range(WORDS):
                    if slots[place + k]:
                        seen[place + k][text.value(at + k)] += 1
        usual: dict[bytes, Counter] = defaultdict(Counter)
        for place, found in seen.items():
            usual[item.value(place)][found.most_common(1)[0][0]] += 1
        again = [c for c in usual.values() if c.total() > 1]
        return sum(c.total() for c in again), sum(c.most_common(1)[0][1] for c in again)


def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[Block]:
    """The benchmark in blocks of bounded size; items stream to the driver and stay there one block long."""
    held, windows = [], 0
    for row in benchmark.select(key, text).where(F.col(key).isNotNull() & F.col(text).isNotNull()).orderBy(key, text).toLocalIterator():
        held.append((row[0], row[1]))
        windows += len(row[1]) // 2 + 1
        if windows >= BLOCK_WINDOWS:
            yield Block(held)
            held, windows = [], 0
    yield Block(held)


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", to: str = "held_items") -> DataFrame:
    """All rows and columns of `docs`, with what each holds of the benchmark in column `to`.

    `to` must not be among them; it is an array of structs: item_id (bigint), shared and windows (of the item), values and agreeing.
    """
    if to in docs.columns:
        raise ValueError(f"the column {to} is in the way")
    kind = "array<struct<item_id: bigint, shared: int, windows: int, values: int, agreeing: int>>"
    out = docs.withColumn(to, F.expr(f"cast(array() as {kind})"))
    at, last = docs.columns.index(text), len(docs.columns)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{to}` {kind}"
    arrow = pa.list_(pa.struct([("item_id", pa.int64()), ("shared", pa.int32()), ("windows", pa.int32()), ("values", pa.int32()), ("agreeing", pa.int32())]))
    names = ("item_id", "shared", "windows", "values", "agreeing")
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            for batch in small_batches(batches, 1024, at):
                found = [
                    [*(before or []), *(dict(zip(names, h, strict=True)) for h in shared.value.held(t))]
                    for before, t in zip(batch.column(last).to_pylist(), texts_of(batch.column(at)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, arrow)], batch.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def report(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, contaminated, n_items, item_ids, largest_share) of every row."""
    held = F.col("held_items")
    return mark(docs.select(key, text), benchmark, text).select(
        key,
        (F.size(held) > 0).alias("contaminated"),
        F.size(held).alias("n_items"),
        F.array_sort(F.transform(held, lambda h: h["item_id"])).alias("item_ids"),
        F.coalesce(F.array_max(F.transform(held, lambda h: h["shared"] / h["windows"])), F.lit(0.0)).alias("largest_share"),
    )
