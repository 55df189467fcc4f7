"""BPE encoding and decoding as a bounded-lookahead streaming transducer.

Text goes through in pieces cut before white space, where neither normalisation nor word
splitting looks across. A word is encoded by merging its symbols in rank order. A long word
is not held whole: how far a merge can be influenced from its right is bounded by the merge
list alone (``lookahead``), so every token that ends that far before the end of the buffer
is final, is emitted, and leaves the buffer. What stays is the buffer and the lookahead,
whatever the text's length.

The same merges apply to what is left after final tokens are taken off: no merge crossed
their border, so the rest is merged as if it stood alone.

Decoding is a state machine over ids. With the byte decoder it holds the bytes of one
unfinished UTF-8 sequence; without a decoder, as in a file that names none, it joins the
token strings by a space, as the tokenizers library does.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from loanloom.llm.common import worker_memory

#: White space as Unicode names it.
SPACE = r"\t-\r \x85\xa0  -     　"
#: Characters of text that go through at a time, if white space allows a cut there.
PIECE = 1 << 16
#: Runs of words whose ids a task remembers; when so many are new, the ones not met since go.
REMEMBERED = 250_000
#: A word of more symbols than this is streamed.
WHOLE = 512
#: Rank of a pair that does not merge.
NEVER = 1 << 62
#: What Python's split() takes for white space though Unicode does not.
UNSPACED = re.compile("[\x1c-\x1f]")


def byte_alphabet() -> list[str]:
    """The printable character of each byte: itself where it has one, else from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    table = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


@dataclass
class Bpe:
    """A vocabulary with ranked merges, word pattern and normalisation, read from JSON."""

    vocab: dict[str, int]
    ranks: dict[tuple[str, str], int]
    suffix: str
    pattern: str
    added: dict[str, int]
    _memory: dict[str, tuple[int, ...]] = field(default_factory=dict)
    _older: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.words = regex.compile(self.pattern.replace(r"\s", SPACE))
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.bytes = byte_alphabet()
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.numerals = {i: b"%d" % i for i in self.tokens}
        self.ids = {i: i for i in self.tokens}
        self.start = [self.vocab[c] for c in self.bytes]
        self.ending = {self.vocab[c]: self.vocab[c + self.suffix] for c in self.bytes}
        self.width = {i: self._symbols(t) for i, t in self.tokens.items()}
        # A pair of ids to its rank and the id it becomes, each packed into one number.
        self.merges = {
            self.vocab[a] << 32 | self.vocab[b]: rank << 32 | self.vocab[a + b]
            for (a, b), rank in self.ranks.items()
        }
        self.lookahead = sufficient_lookahead(self.ranks)

    @classmethod
    def read(cls, path: str) -> Bpe:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        split = next(s for s in steps if s["type"] == "Split")
        rules = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if split["behavior"] != "Removed" or not split["invert"] or rules != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"{path}: only files that keep pattern matches and fold case are read")
        return cls(
            vocab=model["vocab"],
            ranks={tuple(m): r for r, m in enumerate(model["merges"])},
            suffix=model.get("end_of_word_suffix") or "",
            pattern=split["pattern"]["Regex"],
            added={t["content"]: t["id"] for t in spec["added_tokens"]},
        )

    # --- encoding ---------------------------------------------------------------

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of the text, some at a time."""
        for part in self.specials.split(text) if self.specials else [text]:
            if part in self.added:
                yield [self.added[part]]
                continue
            for piece in self._pieces(part):
                ids: list[int] = []
                known = self._memory.get
                for run in self._runs(self.normalised(piece)):
                    ids += known(run) or self._run(run)
                yield ids

    def _pieces(self, text: str) -> Iterator[str]:
        """Cuts before white space, about PIECE characters apart."""
        at = 0
        while at < len(text):
            cut = self.spaces.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def normalised(self, text: str) -> str:
        """NFC, then lower case letter by letter: a final sigma stays a plain one."""
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def _runs(self, text: str) -> list[str]:
        """What stands between white space; no word of the pattern crosses it."""
        if UNSPACED.search(text):
            return [run for run in self.spaces.split(text) if run]
        return text.split()

    def _run(self, run: str) -> tuple[int, ...]:
        """Ids of a run of words; short runs are remembered."""
        if found := self._known(run):
            return found
        ids: list[int] = []
        words = self.words.findall(run)
        for word in words:
            if word != run and (found := self._known(word)):
                ids += found
                continue
            symbols = [self.start[b] for b in word.encode("utf-8", "surrogatepass")]
            symbols[-1] = self.ending[symbols[-1]]
            merged = self.merged(symbols) if len(symbols) <= WHOLE else self.stream(iter(symbols))
            ids += self._remember(word, merged)
        return tuple(ids) if words == [run] else self._remember(run, ids)

    def _known(self, run: str) -> tuple[int, ...] | None:
        """What is remembered of a run; an older one counts as new again."""
        found = self._memory.get(run)
        if found is None and (found := self._older.get(run)) is not None:
            self._keep(run, found)
        return found

    def _keep(self, run: str, made: tuple[int, ...]) -> None:
        if len(self._memory) >= REMEMBERED:
            self._older, self._memory = self._memory, {}
        self._memory[run] = made

    def _remember(self, run: str, ids: Iterable[int]) -> tuple[int, ...]:
        made = tuple(map(self.ids.__getitem__, ids))
        if len(run) <= 64:
            self._keep(run, made)
        return made

    def stream(self, symbols: Iterator[int], room: int = 2048) -> Iterator[int]:
        """Ids of one word of any length, from a buffer of ``room`` plus the lookahead."""
        buffer: list[int] = []
        more = True
        while more:
            while len(buffer) < room + self.lookahead:
                symbol = next(symbols, None)
                if symbol is None:
                    more = False
                    break
                buffer.append(symbol)
            done, last = 0, len(buffer) - (self.lookahead if more else 0)
            for token in self.merged(list(buffer)):
                end = done + self.width[token]
                if end > last:
                    break
                yield token
                done = end
            buffer = buffer[done:]

    def merged(self, parts: list[int]) -> list[int]:
        """The word's tokens: always the pair of lowest rank, the leftmost of equal ones."""
        if len(parts) > 64:
            return self._merged_long(parts)
        get = self.merges.get
        found = [get(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
        while found and (least := min(found)) < NEVER:
            i = found.index(least)
            parts[i] = made = least & 0xFFFFFFFF
            del parts[i + 1], found[i]
            if i < len(found):
                found[i] = get(made << 32 | parts[i + 1], NEVER)
            if i:
                found[i - 1] = get(parts[i - 1] << 32 | made, NEVER)
        return parts

    def _merged_long(self, parts: list[int]) -> list[int]:
        """The same with a queue of pairs and a list of neighbours."""
        n, get = len(parts), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(m, i) for i in range(n - 1) if (m := get(parts[i] << 32 | parts[i + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            least, i = heapq.heappop(queue)
            j = after[i]
            if parts[i] < 0 or j >= n or get(parts[i] << 32 | parts[j]) != least:
                continue
            parts[i], parts[j] = least & 0xFFFFFFFF, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := get(parts[i] << 32 | parts[k])) is not None:
                    heapq.heappush(queue, (m, i))
            if (h := before[i]) >= 0 and (m := get(parts[h] << 32 | parts[i])) is not None:
                heapq.heappush(queue, (m, h))
        return [p for p in parts if p >= 0]

    # --- decoding ---------------------------------------------------------------

    def _symbols(self, token: str) -> int:
        """Bytes a token stands for."""
        ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
        return len(token) - len(self.suffix) * ends

    def decode(self, ids: Iterable[Iterable[int]]) -> Iterator[str]:
        """Token strings joined by one space, part by part."""
        name, first = self.tokens.__getitem__, True
        for part in ids:
            text = " ".join(map(name, part))
            if text:
                yield text if first else f" {text}"
                first = False

    def decode_text(self, ids: Iterable[Iterable[int]]) -> Iterator[str]:
        """Bytes back to text: word ends become spaces, broken sequences U+FFFD.

        The state between parts is at most the first bytes of one character.
        """
        value = {c: b for b, c in enumerate(self.bytes)}
        state = codecs.getincrementaldecoder("utf-8")("replace")
        for part in ids:
            for i in part:
                token = self.tokens[i]
                if token in self.added:
                    yield state.decode(b"", final=True) + token
                    state.reset()
                    continue
                own = token[: self._symbols(token)]
                yield state.decode(bytes(value[c] for c in own) + b" " * (len(own) < len(token)))
        yield state.decode(b"", final=True)


def sufficient_lookahead(ranks: dict[tuple[str, str], int]) -> int:
    """Symbols to the right of a token that can decide about it, at most.

    A merge of (left, right) is only upset from the right if an earlier merge takes a
    piece that ends where it ends: one whose left side is on the right edge of ``right``
    (the piece itself, its right part, the right part of that, ...). That merge reaches
    over its own right side, and can be upset in turn by a still earlier one. In rank
    order the longest such chain needs one pass. The longest token is added, as the
    buffer may end inside it.
    """
    right_part: dict[str, str] = {}
    reach: dict[str, int] = {}
    most, longest = 0, 1
    for left, right in ranks:
        far, piece = 0, right
        while piece is not None:
            far = max(far, reach.get(piece, 0))
            piece = right_part.get(piece)
        right_part.setdefault(left + right, right)
        reach[left] = max(reach.get(left, 0), len(right) + far)
        most = max(most, len(right) + far)
        longest = max(longest, len(left) + len(right))
    return most + longest



def tokenizer(path: str) -> Bpe:
    """The tokenizer of this worker for that file; it stays from task to task."""
    kept = worker_memory()
    if ("bpe", path) not in kept:
        kept["bpe", path] = Bpe.read(path)
    return kept["bpe", path]


def digests(bpe: Bpe, text: str) -> tuple[int, str, str]:
    """Number of ids, and digests of the ids and of the text they decode to."""
    ids, decoded, count, state = hashlib.sha256(), hashlib.sha256(), 0, b""

    def seen() -> Iterator[list[int]]:
        nonlocal count, state
        for part in bpe.encode(text):
            if part:
                ids.update(state + b" ".join(map(bpe.numerals.__getitem__, part)))
                state = b" "
                count += len(part)
                yield part

    for piece in bpe.decode(seen()):
        decoded.update(piece.encode())
    return count, ids.hexdigest(), decoded.hexdigest()


def encode_ids(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids): the ids of every whole text. Null and empty texts have none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                ids = [[i for p in bpe.encode(t.as_py() or "") for i in p] for t in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    return documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(
        work, "doc_id long, ids array<int>"
    )


def decode_ids(ids: DataFrame, path: str, plain: bool = False) -> DataFrame:
    """(doc_id, text) from (doc_id, ids): the library's decoding, or plain text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            texts = [
                "".join((bpe.decode_text if plain else bpe.decode)([row.as_py() or []])) for row in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "ids").mapInArrow(work, "doc_id long, text string")


DIGESTS = T.StructType(
    [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
     T.StructField("decoded_sha256", T.StringType())]
)


def _digested(rows: DataFrame, path: str, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of every row and the digests of its text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = part.column(part.schema.names.index("text"))
                made = zip(*(digests(bpe, t.as_py() or "") for t in texts), strict=True)
                new = [pa.array(m, k) for m, k in zip(made, (pa.int64(), pa.string(), pa.string()), strict=True)]
                old = [part.column(part.schema.names.index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*old, *new], [*kept, *DIGESTS.names])

    fields = [f for f in rows.schema.fields if f.name in kept]
    return rows.mapInArrow(work, T.StructType([*fields, *DIGESTS.fields]))


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    Whole texts, row by row: repeated rows give repeated results, a null text counts as
    empty (no ids, digests of the empty string), other columns are not read.
    """
    return _digested(documents.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text"), path, ["doc_id"])


def with_digests(documents: DataFrame, path: str) -> DataFrame:
    """All columns and the digests of each row's text; clashing columns are replaced."""
    plain = documents.drop(*DIGESTS.names)
    return _digested(plain, path, plain.columns)
