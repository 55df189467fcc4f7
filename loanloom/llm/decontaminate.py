"""Benchmark decontamination by template windows.

Windows of ``width`` folded words of the benchmark are the build side of a hash join, windows
of the whole documents probe it; an item of fewer words is one window. In scripts without
spaces every character is a word, and windows of items mostly written so are twice as wide.

Beside them texts become templates: numbers, units after a number and names (capitalised
inside a sentence) turn into typed placeholders. Windows of template words that hold
placeholders, but not too many, are joined likewise. Matches on one diagonal (document position minus item position)
must fill the slots consistently: one value for one value, in both directions. So an item
with other numbers and names is still found, while a chance mix of values is not. Where values
conflict, the best supported ones stay and only windows with others are dropped; windows that
hold the item's own values always count. A document is contaminated by an item when the
windows kept cover ``cover`` of the item's words.

The build side goes to every task in blocks of at most BLOCK_BYTES of benchmark text, so its
size is bounded whatever the benchmark's; each further block is one more scan.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loanloom.llm.common import cut
from loanloom.llm.shingles import U64, Chunk, alphabet, chunks, unspaced, windows, word_hashes

WIDTH = 6
COVER = 0.5
#: A window with more placeholders than this share says too little with other values.
PLACEHOLDERS = 0.5
#: Items of fewer words than this are searched for with their own values only.
SHORTEST = 4
BLOCK_BYTES = 16 << 20

WORDS = alphabet(bytes(b for b in range(128) if not chr(b).isalnum()), characters=True)
UNITS = (
    "kg g mg lb lbs oz km m cm mm mi mile miles meter meters metre metres foot feet inch inches "
    "l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years percent dollar dollars euro euros cent cents usd eur gbp "
    "mph kmh hz khz mhz ghz w kw kwh v kb mb gb tb degrees celsius fahrenheit"
).split()
NUMBER, UNIT, NAME = (U64(x) for x in (0x11, 0x22, 0x33))
_STOP = np.zeros(256, dtype=bool)
_STOP[list(b".!?:;\n\r\"")] = True


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    separator = WORDS.separator[data]
    start = np.flatnonzero(~separator & np.append(True, separator[:-1]))
    return word_hashes(data, start, separator)


UNIT_HASHES = np.sort(_hashes(UNITS))


def template(chunk: Chunk, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The template word and whether it is a placeholder, for every word of the chunk."""
    start, end, made = chunk.start, chunk.end, chunk.word.copy()
    if not len(start):
        return made, np.zeros(0, bool)
    digits = np.append(0, np.cumsum((raw >= 48) & (raw <= 57)))
    number = digits[end] - digits[start] == end - start
    unit = np.isin(chunk.word, UNIT_HASHES)
    unit[0] = False
    unit[1:] &= number[:-1]
    stops = np.append(0, np.cumsum(_STOP[raw]))
    after = np.append(0, end[:-1])
    inner = stops[start] == stops[after]
    inner[chunk.first[:-1][chunk.first[:-1] < len(start)]] = False
    unit[chunk.first[:-1][chunk.first[:-1] < len(start)]] = False
    head, second = raw[start], raw[np.minimum(start + 1, len(raw) - 1)]
    upper = (head >= 65) & (head <= 90) | (head == 0xC3) & (second >= 0x80) & (second <= 0x9E)
    name = upper & inner
    made[number], made[unit], made[name] = NUMBER, UNIT, NAME
    return made, number | unit | name


def _usable(slot: np.ndarray, width: int) -> np.ndarray:
    """Windows with placeholders and enough literal words; those without are exact ones."""
    total = np.append(0, np.cumsum(slot))
    held = total[width:] - total[:-width]
    return (held > 0) & (held <= PLACEHOLDERS * width)


@dataclass
class Items:
    """Benchmark windows in hash order, by window width and whether they are exact."""

    ids: list[int]
    words: list[np.ndarray]
    made: list[np.ndarray]
    slots: list[np.ndarray]
    by_width: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray, np.ndarray]]


def items(rows: list[tuple[int, str]], width: int = WIDTH) -> Items:
    """Windows of (item_id, text) rows; items without words have none."""
    column = pa.array([t for _, t in rows], pa.string())
    out = Items([], [], [], [], {})
    found: dict[tuple[int, bool], list] = defaultdict(list)
    for chunk in chunks(column, WORDS):
        made, slot = template(chunk, chunk.raw)
        characters = np.isin(chunk.start, unspaced(chunk.raw)[0])
        for i in range(len(chunk.first) - 1):
            a, b = int(chunk.first[i]), int(chunk.first[i + 1])
            if a == b:
                continue
            w = min(2 * width if 2 * characters[a:b].sum() > b - a else width, b - a)
            at = np.arange(b - a - w + 1)
            found[w, True].append((windows(chunk.word[a:b], w), np.full(len(at), len(out.ids)), at))
            if b - a >= SHORTEST:
                at = np.flatnonzero(_usable(slot[a:b], w))
                found[w, False].append((windows(made[a:b], w)[at], np.full(len(at), len(out.ids)), at))
            out.ids.append(int(rows[chunk.row + i][0]))
            out.words.append(chunk.word[a:b])
            out.made.append(made[a:b])
            out.slots.append(slot[a:b])
    for kind, parts in found.items():
        key, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((at, item, key))
        if len(key):
            out.by_width[kind] = key[order], item[order], at[order]
    return out


def _accepted(mine: np.ndarray, theirs: np.ndarray) -> set[tuple[int, int]]:
    """Pairs that give one value for one value in both directions.

    The most frequent pair first, then the item's own value, then the first in the text.
    """
    count = Counter(zip(mine.tolist(), theirs.tolist(), strict=True))
    left, right, out = set(), set(), set()
    for pair in sorted(count, key=lambda x: (-count[x], x[0] != x[1])):
        if pair[0] not in left and pair[1] not in right:
            left.add(pair[0])
            right.add(pair[1])
            out.add(pair)
    return out


def _kept(matched: list[tuple[int, int]], shift: int, words: np.ndarray, slots: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The item's words in windows of one diagonal that hold its own or consistent values."""
    mine = np.zeros(len(words), bool)
    for a, w in matched:
        mine[a : a + w] = True
    filled = np.flatnonzero(mine & slots)
    good = np.ones(len(words), bool)
    accepted = _accepted(words[filled], text[filled + shift])
    own = np.ones(len(words), bool)
    own[filled] = words[filled] == text[filled + shift]
    good[filled] = [x in accepted for x in zip(words[filled].tolist(), text[filled + shift].tolist(), strict=True)]
    mine[:] = False
    for a, w in matched:
        if good[a : a + w].all() or own[a : a + w].all():
            mine[a : a + w] = True
    return mine


def _found(chunk: Chunk, bench: Items, cover: float) -> Iterator[tuple[int, int, int, float, int, bool]]:
    """(row, item, words covered, share, slots, other values) of contaminated texts."""
    made, _ = template(chunk, chunk.raw)
    hits: dict[tuple[int, int], dict[int, list]] = defaultdict(lambda: defaultdict(list))
    for (w, exact), (key, item, at) in bench.by_width.items():
        run = windows(chunk.word if exact else made, w)
        if not len(run):
            continue
        low = np.searchsorted(key, run, "left")
        places = np.flatnonzero(key[np.minimum(low, len(key) - 1)] == run)
        text = np.searchsorted(chunk.first, places, "right") - 1
        fits = places + w <= chunk.first[text + 1]
        for p, t in zip(places[fits].tolist(), text[fits].tolist(), strict=True):
            k = int(low[p])
            while k < len(key) and key[k] == run[p]:
                hits[t, int(item[k])][p - int(at[k])].append((int(at[k]), w))
                k += 1
    for (t, item), diagonals in sorted(hits.items()):
        words, slots = bench.words[item], bench.slots[item]
        covered, n_slots, other = np.zeros(len(words), bool), 0, False
        for shift, matched in diagonals.items():
            mine = _kept(matched, shift, words, slots, chunk.word)
            filled = np.flatnonzero(mine & slots)
            theirs = chunk.word[filled + shift]
            covered |= mine
            n_slots = max(n_slots, len(filled))
            other |= bool((words[filled] != theirs).any())
        share = float(covered.mean())
        if share >= cover:
            yield chunk.row + t, bench.ids[item], int(covered.sum()), share, n_slots, other


SCHEMA = "doc_id long, item_id long, n_words long, coverage double, n_slots long, other_values boolean"


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, cover: float = COVER) -> DataFrame:
    """(doc_id, item_id, n_words, coverage, n_slots, other_values) of contaminated documents.

    One row per document row and benchmark item; coverage is the share of the item's words
    found, other_values tells that slots were filled differently. An item of one word is found
    wherever that word stands. Null and empty texts are
    clean, rows without an id on either side take no part, repeated items count once, a
    repeated document row repeats its result. Other columns are not read.
    """
    spark = documents.sparkSession
    texts = documents.where("doc_id IS NOT NULL").selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    questions = cut(
        benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
        .selectExpr("CAST(item_id AS BIGINT) AS item_id", "text")
        .distinct()
    )
    size = questions.selectExpr("coalesce(sum(octet_length(text)), 0)").first()[0]
    blocks = -(-size // BLOCK_BYTES) or 1
    out = None
    for block in range(blocks):
        part = questions.where(f"pmod(xxhash64(item_id), {blocks}) = {block}").orderBy("item_id", "text")
        built = items([(r.item_id, r.text) for r in part.collect()], width)
        sent = spark.sparkContext.broadcast(vars(built))

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            bench = Items(**sent.value)
            for batch in batches:
                ids, found = batch.column(0).to_numpy(zero_copy_only=False), []
                for chunk in chunks(batch.column(1), WORDS) if bench.by_width else ():
                    found += [(int(ids[row]), *rest) for row, *rest in _found(chunk, bench, cover)]
                columns = list(zip(*found, strict=True)) or [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "n_words", "coverage", "n_slots", "other_values"],
                )

        rows = texts.mapInArrow(work, SCHEMA)
        out = rows if out is None else out.union(rows)
    return out


def without_benchmark(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item; columns as given."""
    found = cut(contamination(documents, benchmark, **options).selectExpr("doc_id AS _gone").distinct())
    return documents.join(found, documents["doc_id"] == found["_gone"], "left_anti")
