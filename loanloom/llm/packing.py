"""Packing: documents as token sequences of one size, with no padding and few cuts.

Documents are dealt into random groups of bounded size, which are packed independently. A document
that is longer than a sequence gives full sequences and a rest. The rests are packed by first fit
decreasing: the longest first, each into the first sequence with room for it, found in a tournament
tree over the free room of all sequences (every node holds the most room below it, so the first
one with enough is found by going down once). Sequences that stay open are closed by cutting: the
emptiest are taken apart to fill the others, and what is left at the very end is cut into
sequences whose sizes are powers of two, which need no padding either.

A group's size is bounded by the number of groups, which follows from the bytes of all texts; a
byte-level vocabulary never makes more tokens than bytes.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loanloom.llm.common import BATCH_BYTES, worker_memory

SEQUENCE = 2048
#: Bytes of text in a group, on average.
GROUP_BYTES = 4_000_000
#: Sequences of a group are numbered within 2^32.
GROUP_SHIFT = 32

#: Letters of one word beyond which the tokenizers library takes over: it needs less stack.
LONG_RUN = 100_000


def byte_alphabet() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for U+0100 and on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteTokens:
    """Token numbers of texts as the tokenizers library gives them for a byte-level BPE file.

    Where the file is a plain byte-level BPE, whose numbers are also its merge order, tiktoken
    computes the same numbers in a quarter of the time; special tokens are split off first.
    """

    def __init__(self, path: str, pattern: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_padding()
        self.whole.no_truncation()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.fast = tiktoken.Encoding("byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = self.whole.get_vocab_size()

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special) or _long_run(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def _long_run(text: str) -> bool:
    """Whether more than LONG_RUN characters follow without a blank, or are all white space."""
    if len(text) <= LONG_RUN:
        return False
    return any(
        not (part := text[at : at + LONG_RUN // 2]).strip() or " " not in part and "\n" not in part
        for at in range(0, len(text), LONG_RUN // 2)
    )


class Room:
    """Tournament tree over the free room of sequences that are all empty at first."""

    def __init__(self, bins: int, room: int):
        self.width = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.width)

    def first_with(self, need: int) -> int:
        """The first sequence with at least ``need`` room, which is taken."""
        best, at = self.best, 1
        while at < self.width:
            at *= 2
            if best[at] < need:
                at += 1
        found = at - self.width
        best[at] -= need
        while at > 1:
            at //= 2
            larger = max(best[2 * at], best[2 * at + 1])
            if best[at] == larger:
                break
            best[at] = larger
        return found


Piece = tuple[int, int, int]


def plan(lengths: list[int], size: int = SEQUENCE) -> list[list[Piece]]:
    """Sequences as lists of pieces (document, start, length) that cover all lengths once.

    Every sequence is full, or its tokens are a power of two.
    """
    full, rests = [], []
    for doc, n in enumerate(lengths):
        for start in range(0, n - size + 1, size):
            full.append([(doc, start, size)])
        if n % size:
            rests.append((n % size, doc, n - n % size))
    rests.sort(key=lambda r: (-r[0], r[1]))
    room = Room(len(rests), size)
    bins: list[list[Piece]] = []
    for need, doc, start in rests:
        at = room.first_with(need)
        if at == len(bins):
            bins.append([])
        bins[at].append((doc, start, need))
    return full + _closed(bins, size)


def _closed(bins: list[list[Piece]], size: int) -> list[list[Piece]]:
    """The same pieces in full sequences; the emptiest are cut to fill the others."""
    done, open_ = [], []
    for pieces in bins:
        total = sum(p[2] for p in pieces)
        (done if total == size else open_).append((total, pieces))
    done = [pieces for _, pieces in done]
    open_.sort(key=lambda b: -b[0])
    left = sum(total for total, _ in open_)
    filled, spare = open_[: left // size], open_[left // size :]
    loose = [p for _, pieces in reversed(spare) for p in pieces]
    holes = [(size - total, pieces) for total, pieces in filled]
    rest = left % size
    # The last tokens: one sequence per power of two in their number.
    holes += [(1 << bit, []) for bit in reversed(range(rest.bit_length())) if rest >> bit & 1]
    for hole, pieces in holes:
        while hole:
            doc, start, length = loose.pop()
            taken = min(hole, length)
            pieces.append((doc, start, taken))
            hole -= taken
            if taken < length:
                loose.append((doc, start + taken, length - taken))
        done.append(pieces)
    return done


def packed(
    documents: DataFrame,
    tokenizer: str,
    pattern: str,
    end: int = 1,
    size: int = SEQUENCE,
    group_bytes: int = GROUP_BYTES,
    seed: int = 42,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, start, length, doc_tokens, sequence_id, offset, ids) per piece, ids as 32-bit numbers.

    ``tokenizer`` is a byte-level BPE file whose words ``pattern`` parts. Each text, null as an
    empty one, is its tokens and the number ``end``; its pieces hold every token once. A row is a
    document of its own, also where others have its key and text, or none has a key. Texts are
    tokenised once, where they lie; their numbers are shuffled once, by group. The group is a hash of key,
    text and how many equal rows the task saw before, so no value gathers the rows of a table in one group.
    An empty table gives no rows; other columns are left out.
    """
    sizes = documents.selectExpr(f"sum(coalesce(octet_length(`{text}`), 0L) + 1L) AS bytes").first()
    groups = max(1, -(-(sizes["bytes"] or 0) // group_bytes))
    kind = documents.schema[key].dataType.simpleString()

    def tokens() -> ByteTokens:
        kept = worker_memory()
        if (tokenizer, pattern) not in kept:
            kept[tokenizer, pattern] = ByteTokens(tokenizer, pattern)
        return kept[tokenizer, pattern]

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = tokens()
        # Half the bytes where they suffice.
        width = np.uint16 if max(known.size, end + 1) <= 2**16 else np.uint32
        seen: Counter[int] = Counter()
        for batch in batches:
            first, ids, group, held = 0, [], [], 0
            for i, (whole, mark) in enumerate(zip(batch.column(1), batch.column(2))):
                h = mark.as_py()
                group.append((h + seen[h]) % groups)
                seen[h] += 1
                numbers = np.append(known.ids(whole.as_py()), np.uint32(end)).astype(width)
                ids.append(numbers.tobytes())
                held += len(ids[-1])
                if held >= BATCH_BYTES or i + 1 == batch.num_rows:
                    arrays = [batch.column(0).slice(first, len(ids)), pa.array(group, pa.int64()), pa.array(ids, pa.binary())]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array([np.dtype(width).itemsize] * len(ids), pa.int32())], [key, "_group", "_ids", "_width"])
                    first, ids, group, held = i + 1, [], [], 0

    def pack(group: pa.Table) -> pa.Table:
        rows = group.sort_by([(key, "ascending"), ("_ids", "ascending")]).combine_chunks()
        width = rows["_width"][0].as_py()
        number = rows["_group"][0].as_py()
        bodies = rows["_ids"].to_pylist()
        lengths = [len(b) // width for b in bodies]
        out: dict[str, list] = {c: [] for c in ("doc", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
        for i, pieces in enumerate(plan(lengths, size)):
            offset = 0
            for doc, start, length in pieces:
                part = np.frombuffer(bodies[doc], dtype=f"<u{width}", count=length, offset=start * width)
                values = (doc, start, length, lengths[doc], (number << GROUP_SHIFT) + i, offset, part.astype("<u4").tobytes())
                for held, value in zip(out.values(), values):
                    held.append(value)
                offset += length
        keys = rows[key].take(pa.array(out.pop("doc"), pa.int64()))
        ids = pa.array(out.pop("ids"), pa.binary())
        return pa.table([keys, *(pa.array(v, pa.int64()) for v in out.values()), ids], [key, *out, "ids"])

    rows = documents.selectExpr(f"`{key}`", f"coalesce(`{text}`, '') AS _text", f"xxhash64(`{key}`, `{text}`, {int(seed)}) AS _hash")
    dealt = rows.mapInArrow(tokenise, f"`{key}` {kind}, _group long, _ids binary, _width int")
    out = f"`{key}` {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return dealt.groupBy("_group").applyInArrow(pack, out)


def sequences(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """(sequence_id, n_tokens, ids, documents) per sequence, its pieces joined in order.

    A sequence has at most as many pieces as tokens.
    """
    joined = pieces.groupBy("sequence_id").agg(
        F.expr(f"array_sort(collect_list(struct(offset, `{key}` AS key, start, length, ids))) AS p")
    )
    return joined.selectExpr(
        "sequence_id",
        "aggregate(p, 0L, (n, x) -> n + x.length) AS n_tokens",
        "array_join(transform(p, x -> hex(x.ids)), '') AS ids",
        "transform(p, x -> struct(x.key, x.start, x.length)) AS documents",
    ).withColumn("ids", F.unhex("ids"))
