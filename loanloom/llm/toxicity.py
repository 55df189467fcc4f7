"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text.

Folding maps look-alike letters of other scripts, digits and signs that stand for letters,
accents and case to plain letters (``i``, ``l``, ``1`` and ``!`` become one letter), so a
disguised word meets the same lexicon entry. Entries are word beginnings; each has the log
odds of toxic against other documents as its weight. Exceptions are whole words and phrases
in which a match does not count. The sum of weights is divided by a power of the length and
mapped to 0 to 1, the threshold of the fit at one half.

The lexicon is fitted on at most about ``sample`` labelled rows (a documented bound, picked
by a hash of the id). Of those with one label whose ALIKE smallest word hashes agree, mostly
copies, one is read; each text keeps its own label. Counting runs in Spark, and only
entries that pass leave it; how many there are is bounded by the sample's words.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.llm.common import cut

#: Labelled rows the fit reads, at most about so many.
SAMPLE = 12_000
#: Texts of one label with so many smallest word hashes in common are read once.
ALIKE = 3
#: An entry's least share of toxic documents; other documents count OTHERS times.
PURITY, OTHERS = 0.9, 3
#: A longer beginning is as good as a shorter one if it keeps this share of toxic documents.
KEPT = 0.95
SHORTEST, LONGEST = 3, 9
#: The sum of weights is divided by (words) ** LENGTH_POWER.
LENGTH_POWER = 0.1

#: Letters that look like Latin ones, and what is written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "ё": "e", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ӏ": "l", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ɑ": "a", "ɡ": "g",
}
WRITTEN_FOR = {
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i", "l": "i"
}
#: Signs that end a sentence as well: they stand for a letter only inside a word.
AMBIGUOUS = "!|"


class Fold(dict):
    """Translation table for str.translate, filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        made = []
        for c in unicodedata.normalize("NFKD", chr(code).lower()):
            if unicodedata.combining(c) or unicodedata.category(c) in ("Cf", "Mn"):
                continue
            c = LOOKALIKES.get(c, c)
            c = " " if c in AMBIGUOUS else WRITTEN_FOR.get(c, c)
            made.append(c if c.isalpha() else " ")
        self[code] = text = "".join(made)
        return text


def folded(text: str, table: Fold) -> str:
    """Folded words, one space around each."""
    for sign in AMBIGUOUS:
        if sign in text:
            text = _inside(text, sign)
    return f" {' '.join(text.translate(table).split())} "


def _inside(text: str, sign: str) -> str:
    """The sign as a letter where letters follow it directly."""
    parts = text.split(sign)
    made = [parts[0]]
    for before, after in zip(parts, parts[1:], strict=False):
        made.append("i" if before[-1:].isalpha() and after[:1].isalpha() else sign)
        made.append(after)
    return "".join(made)


@dataclass
class Lexicon:
    """Word beginnings with weights, exception phrases, and the score of one half."""

    weights: dict[str, float]
    exceptions: list[str]
    half: float

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(f" {entry}", (weight, len(entry) + 1))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (None, len(phrase) + 2))
        found.make_automaton()
        return found

    def raw(self, text: str, automaton: ahocorasick.Automaton, table: Fold) -> float:
        """Sum of the weights that count, divided by the power of the length."""
        words = folded(text, table)
        hits, spared = [], []
        if len(automaton):
            for end, (weight, size) in automaton.iter(words):
                (spared if weight is None else hits).append((end - size + 1, end, weight))
        if spared:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in spared)]
        # One weight per word: of the entries that begin it, the heaviest.
        best: dict[int, float] = {}
        for start, _, weight in hits:
            best[start] = max(weight, best.get(start, 0.0))
        return sum(best.values()) / max(words.count(" ") - 1, 1) ** LENGTH_POWER

    def score(self, raw: float) -> float:
        return raw * raw / (raw * raw + self.half * self.half) if raw > 0 else 0.0


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, toxic) of labelled documents that are not held out, at most about ``sample``.

    A document labelled both ways counts as toxic. The picked ids are at most about
    ``sample``, so they are sent to every task.
    """
    usable = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    usable = cut(usable)
    share = min(1.0, sample / max(1, usable.count()))
    picked = usable.where(f"pmod(xxhash64(doc_id), 1000000) < {int(share * 1_000_000)}")
    texts = documents.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    # Copies tell nothing new. A text with the other label does, however alike it is.
    sketch = f"slice(array_sort(transform(array_distinct(split(coalesce(text, ''), ' ')), w -> xxhash64(w))), 1, {ALIKE})"
    return texts.groupBy(F.expr(sketch).alias("s"), "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, toxic, others): documents of the task that hold a word beginning or word."""
    counts, table = (Counter(), Counter()), Fold()
    docs = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            found = set()
            for word in set(folded(text.as_py() or "", table).split()):
                found.add(f"{word} ")
                for n in range(SHORTEST, min(len(word), LONGEST) + 1):
                    found.add(word[:n])
            side = int(toxic.as_py() > 0)
            docs[side] += 1
            counts[side].update(found)
    counts[1][""], counts[0][""] = docs[1], docs[0]
    entries = list(counts[1].keys() | counts[0].keys())
    for low in range(0, len(entries), 20_000):
        part = entries[low : low + 20_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(part, pa.string()),
                pa.array([counts[1][e] for e in part], pa.int64()),
                pa.array([counts[0][e] for e in part], pa.int64()),
            ],
            ["entry", "toxic", "others"],
        )


def least_support(n_toxic: int, n_others: int, entries: int) -> int:
    """Toxic documents after which purity is no chance finding among so many entries."""
    rate = min(max(n_toxic / max(1, n_toxic + n_others), 0.01), 0.5)
    return max(2, ceil((log(max(1, entries)) + 1) / -log(rate)))


def chosen(toxic: dict[str, int]) -> set[str]:
    """One of each chain of beginnings: the longest that keeps the shortest one's documents."""
    after: dict[str, list[str]] = {}
    for entry in toxic:
        after.setdefault(entry[:-1], []).append(entry)
    out = set()
    for entry in toxic:
        if any(entry[:n] in toxic for n in range(SHORTEST, len(entry))):
            continue
        least = KEPT * toxic[entry]
        while longer := [e for e in after.get(entry, ()) if toxic[e] >= least]:
            entry = longer[0]
        out.add(entry)
    return out


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """Fit a lexicon; without labelled toxic rows it is empty and scores are 0.

    ``exceptions`` are phrases in which a match never counts, beside those found.
    """
    rows = cut(training_rows(documents, labels, sample))
    counts = cut(
        rows.mapInArrow(_features, "entry string, toxic long, others long")
        .groupBy("entry")
        .agg(F.sum("toxic").alias("toxic"), F.sum("others").alias("others"))
        .where("toxic >= 2 OR entry = ''")
    )
    total = counts.where("entry = ''").first()
    n_toxic, n_others = (total.toxic, total.others) if total else (0, 0)
    support = least_support(n_toxic, n_others, counts.count())
    pure = counts.where(
        f"entry <> '' AND entry NOT LIKE '% ' AND toxic >= {support}"
        f" AND toxic >= {PURITY} * (toxic + {OTHERS} * others + 0.3)"
    )
    passing = {r.entry: (r.toxic, r.others) for r in pure.collect()}
    kept = {e: passing[e] for e in chosen({e: v[0] for e, v in passing.items()})}
    weights = {
        e: log((a + 0.5) / (n_toxic + 1)) - log((b + 0.5) / (n_others + 1)) for e, (a, b) in sorted(kept.items())
    }
    spared = counts.where("entry LIKE '% ' AND others > toxic").selectExpr("rtrim(entry) AS w")
    beginnings = cut(spared.where("length(w) >= 3")) if weights else None
    found = []
    if beginnings is not None:
        heads = sorted(weights)
        starts = F.broadcast(counts.sparkSession.createDataFrame([(h,) for h in heads], "head string"))
        lengths = F.explode(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)))
        found = [
            r.w
            for r in beginnings.withColumn("n", lengths).withColumn("head", F.expr("substring(w, 1, n)"))
            .join(starts, "head").select("w").distinct().collect()
        ]
    fold = Fold()
    phrases = sorted({*found, *(folded(p, fold).strip() for p in exceptions)} - {""})
    return _halved(rows, Lexicon(weights, phrases, 1.0))


def _halved(rows: DataFrame, lexicon: Lexicon) -> Lexicon:
    """The same lexicon with the score of one half where the sample is told apart best."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, table = lexicon.automaton(), Fold()
        for batch in batches:
            raw = [lexicon.raw(t.as_py() or "", automaton, table) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column(1).cast(pa.int64())], ["raw", "toxic"])

    seen = rows.mapInArrow(work, "raw double, toxic long").toArrow()
    raw, toxic = seen.column("raw").to_numpy(), seen.column("toxic").to_numpy() > 0
    order = np.argsort(raw)
    raw, toxic = raw[order], toxic[order]
    # Right if everything from position i on is called toxic.
    right = np.append(0, np.cumsum(~toxic)) + np.append(np.cumsum(toxic[::-1])[::-1], 0)
    edges = np.flatnonzero(np.append(True, np.diff(raw) > 0)) if len(raw) else np.zeros(0, int)
    edges = edges[raw[edges] > 0] if len(raw) else edges
    if not len(edges):
        return Lexicon(lexicon.weights, lexicon.exceptions, 1.0)
    at = edges[np.argmax(right[edges])]
    below = raw[at - 1] if at else 0.0
    return Lexicon(lexicon.weights, lexicon.exceptions, float((raw[at] + max(below, 0.0)) / 2))


def scored(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """All columns and ``score`` (0 to 1), over whole texts; null and empty texts score 0."""
    schema = T.StructType([*documents.schema.fields, T.StructField("_score", T.DoubleType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, table = lexicon.automaton(), Fold()
        for batch in batches:
            texts = batch.column(batch.schema.names.index("text"))
            made = [lexicon.score(lexicon.raw(t.as_py() or "", automaton, table)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, pa.float64())], [*batch.schema.names, "_score"]
            )

    return documents.mapInArrow(work, schema)


def toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, repeated rows included.

    A row without doc_id is never held out. Other columns are not read.
    """
    lexicon = fit(documents, labels, sample)
    return scored(documents.select("doc_id", "text"), lexicon).selectExpr(
        "doc_id",
        "coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false) AS held_out",
        "_score AS score",
        "CAST(_score >= 0.5 AS INT) AS predicted",
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that score below one half; columns as given."""
    lexicon = fit(documents, labels, sample)
    return scored(documents, lexicon).where("_score < 0.5").drop("_score")
