"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

The automaton accepts every substring, in words, of every item. Document words are streamed through
it while the length of the longest match that ends at each word is tracked. A match of at least
``window`` words covers its words; an item shorter than a window counts only as a whole. Words that
no item holds reset the automaton, so it walks only the runs of known words that are long enough.

Items are dealt to blocks of bounded size (items longer than a piece are cut into pieces that overlap
by a window less one word, which keeps every window). One automaton is broadcast at a time; more
blocks mean more passes, and the spans of the passes are merged for each row.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import saved, small_batches

BLOCK_WORDS = 300_000
PIECE_WORDS = 50_000
ROWS_AT_ONCE = 512

#: ASCII letters become small, other ASCII than letters and digits becomes a blank, the rest stays.
WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()


def words_of(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return raw.translate(WORD_BYTES).split() if raw else []


class Automaton:
    """Generalised suffix automaton over word numbers; knows which items hold which windows."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = []
        for name, words in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if numbers:
                texts.append((name, numbers))
                self._add(numbers)
        self.shortest = min([window, *(len(t) for _, t in texts)])
        self.holders: dict[int, list[int | None]] = {}  # state of a window: the items that hold it
        self.whole: dict[int, list[tuple[int, int | None]]] = {}  # state: short items (length, name) that end there
        seen: dict[int, int] = {}
        for at, (name, numbers) in enumerate(texts):
            state = 0
            for number in numbers:
                state = self.next[state][number]
                above = state
                while self.length[above] >= window and seen.get(above) != at:
                    seen[above] = at
                    self.holders.setdefault(above, []).append(name)
                    above = self.link[above]
            if len(numbers) < window:
                self.whole.setdefault(state, []).append((len(numbers), name))

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, state: int, number: int, target: int) -> int:
        """A copy of ``target`` for the shorter of its strings, those that end like ``state`` + number."""
        copy = self._state(self.length[state] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while state >= 0 and self.next[state].get(number) == target:
            self.next[state][number] = copy
            state = self.link[state]
        return copy

    def _add(self, numbers: list[int]) -> None:
        last = 0
        for number in numbers:
            target = self.next[last].get(number)
            if target is not None:
                last = target if self.length[target] == self.length[last] + 1 else self._split(last, number, target)
                continue
            new, state = self._state(self.length[last] + 1), last
            while state >= 0 and number not in self.next[state]:
                self.next[state][number] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][number]
                self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, number, target)
            last = new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int | None]]:
        """Disjoint, sorted spans [start, end) of covered words, and the items found."""
        if not self.vocabulary or len(words) < self.shortest:
            return [], set()
        numbers = np.fromiter(map(self.vocabulary.get, words, itertools.repeat(-1)), np.int64, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([False], numbers >= 0, [False]))))
        starts, ends = known[::2], known[1::2]
        long = ends - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        found: set[int | None] = set()
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            self._walk(numbers[start:end].tolist(), start, spans, found)
        return spans, found

    def _walk(self, numbers: list[int], offset: int, spans: list, found: set) -> None:
        window, following, link, length = self.window, self.next, self.link, self.length
        state, matched = 0, 0
        for at, number in enumerate(numbers, offset + 1):
            while state and number not in following[state]:
                state = link[state]
                matched = length[state]
            if number not in following[state]:
                continue
            state = following[state][number]
            matched += 1
            reach = matched if matched >= window else 0
            if reach:
                holder = state
                while length[link[holder]] >= window:
                    holder = link[holder]
                found.update(self.holders[holder])
            if self.whole:
                above = state
                while above > 0:
                    for n, name in self.whole.get(above, ()):
                        if n <= matched:
                            reach = max(reach, n)
                            found.add(name)
                    above = link[above]
            if reach:
                start = at - reach
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, at))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _pieces(window: int):
    schema = pa.schema([("item_id", pa.int64()), ("piece", pa.int32()), ("n", pa.int64()), ("words", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(raw)
                for i, at in enumerate(range(0, max(1, len(words) - window + 1) if words else 0, PIECE_WORDS)):
                    piece = words[at : at + PIECE_WORDS + window - 1]
                    rows.append((name, i, len(piece), b" ".join(piece)))
            yield pa.record_batch(list(zip(*rows, strict=True)) if rows else [[]] * 4, schema=schema)

    return cut


_BUILT: dict[tuple, Automaton] = {}


def _scanner(block, key: tuple, window: int, fields: T.StructType, text: str):
    """Adds what one block of items finds to the spans and items of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _BUILT:
            _BUILT.clear()
            _BUILT[key] = Automaton([(name, raw.split()) for name, raw in block.value], window)
        automaton = _BUILT[key]
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, len(b), ROWS_AT_ONCE)):
            texts = pa.compute.struct_field(batch.column("doc"), text).cast(pa.binary()).to_pylist()
            cover, names, longest, hit, total = [], [], [], [], []
            for raw, old, had in zip(texts, batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True):
                words = words_of(raw)
                spans, found = automaton.scan(words)
                if old:
                    spans = merge([*spans, *zip(old[::2], old[1::2], strict=True)])
                cover.append([x for span in spans for x in span])
                names.append(sorted(found | set(had), key=str))
                longest.append(max((e - s for s, e in spans), default=0))
                hit.append(sum(e - s for s, e in spans))
                total.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(total, pa.int64()), pa.array(hit, pa.int64()), pa.array(longest, pa.int64()), pa.array(cover, pa.list_(pa.int64())), pa.array(names, pa.list_(pa.int64()))],
                ["doc", "n_words", "n_hit", "longest", "spans", "items"],
            )

    return scan


def scan(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document: ``doc`` (its columns as a struct), ``n_words``, ``n_hit``, ``longest``, ``spans``, ``items``.

    ``spans`` is flat: start, end, start, end, ... in words, ends exclusive, sorted and disjoint.
    ``items`` are the ids of the items of which a window occurs, sorted as strings. Null texts have
    no words, items without words have no window, an empty table of items hits nothing. Rows that
    repeat are scanned each; equal items are all reported. Other columns are carried as they are.
    """
    spark = docs.sparkSession
    pieces = saved(items.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).mapInArrow(_pieces(window), "item_id long, piece int, n long, words binary"), "items")
    total = pieces.agg(F.sum("n")).first()[0] or 0
    blocks = math.ceil(2 * total / block_words) if total > block_words else 1
    rows = docs.select(F.struct("*").alias("doc"), F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<bigint>").alias("items"))
    schema = T.StructType([rows.schema["doc"], *T._parse_datatype_string("n_words long, n_hit long, longest long, spans array<long>, items array<long>").fields])
    block_of = F.pmod(F.xxhash64("item_id", "piece"), F.lit(blocks))
    for i in range(blocks):
        some = [(r.item_id, bytes(r.words)) for r in pieces.where(block_of == i).select("item_id", "words").collect()]  # bounded by block_words
        sent = spark.sparkContext.broadcast(some)
        key = (pieces.inputFiles()[0] if some else "", i, window)
        rows = rows.mapInArrow(_scanner(sent, key, window, docs.schema, text), schema)
        if i + 1 < blocks:
            with small_batches(spark):
                rows = saved(rows, "scanned")
    return rows


def _cutter(fields: list[str], text: str, limit: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(fields, batch.column("doc").flatten(), strict=True))
            texts = columns[text].to_pylist()
            for i, flat in enumerate(batch.column("spans").to_pylist()):
                spans = [(s, e) for s, e in zip(flat[::2], flat[1::2], strict=True) if e - s >= limit]
                if spans:
                    texts[i] = without(texts[i], spans)
            columns[text] = pa.array(texts, columns[text].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), fields)

    return cut


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and what stands between these; one blank in place of each."""
    raw = text.encode()
    kept = raw.translate(WORD_BYTES)
    is_word = np.frombuffer(kept, np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([False], is_word, [False]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at : starts[s]])
        at = int(ends[e - 1])
    out.append(raw[at:])
    return b" ".join(out).decode()


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", most_coverage: float = 0.0, cut_from: int | None = None, n_chars: str | None = None
) -> DataFrame:
    """The columns of ``docs``, without what the items leak into them.

    Documents of which more than the share ``most_coverage`` of the words is covered go (0: any hit).
    With ``cut_from``, covered spans of that many words and more are cut out of the texts that stay,
    and ``n_chars``, if named, is counted anew. A document without words stays as it is.
    What stays is written here, as whole rows pass through Python and only a job run here has small batches.
    """
    found = scan(docs, items, window, text)
    stays = found.where(F.col("n_hit") <= F.lit(most_coverage) * F.col("n_words"))
    with small_batches(docs.sparkSession):
        if cut_from is None:
            return saved(stays.select("doc.*"), "clean", keep=True)
        out = saved(stays.select("doc", "spans").mapInArrow(_cutter(docs.columns, text, cut_from), docs.schema), "clean", keep=True)
    return out.withColumn(n_chars, F.length(text).cast(docs.schema[n_chars].dataType)) if n_chars else out
