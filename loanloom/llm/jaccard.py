"""N-gram Jaccard join: a blocked sparse product of documents and n-grams.

The incidence of documents and n-grams is cut into column blocks by n-gram hash. Map tasks
hash whole texts (array arithmetic, see ``shingles``) and send each block one packed piece.
A block counts in how many documents each of its n-grams occurs and hands back only the
shared ones, to row blocks by document. There the size bound discards every document that
cannot reach the threshold with anybody: an n-gram found in one document overlaps with
nothing. What is left are the rows of the product that can hold a link.

Overlap of two rows is then accumulated only for pairs that share one of their rarest
shared n-grams (at Jaccard t, two sets of size n agree on one of the rarest
n - ceil(t n) + 1) and whose sizes allow it. Equal sets are one row. For each n-gram one
document, the one with the largest shared part, is compared with the others first; linked
rows become one component, and that is repeated for what is left. At last all pairs that
still lie in different components are compared. So a group of near copies costs its size,
not its square, and no link between components is lost.

Hot n-grams: a pass before the first counts inside each map task and sums over tasks; an
n-gram with more than ``hot_rows`` entries skips its block, its count goes along from the
map side. The table of hot n-grams has at most ``HOT_LIMIT`` rows by construction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import cut, partitions
from loanloom.llm.components import smallest_reachable
from loanloom.llm.shingles import U64, chunks, mix, shingle_sets

WIDTH = 5
PERCENT = 80
#: Entries of one n-gram that a column block may hold; beyond it the n-gram is hot.
HOT_ROWS = 20_000
HOT_LIMIT = 1_000_000
#: Entries a map task packs before it sends them on.
PACK = 300_000
#: Blocks for each shuffle partition, so that uneven blocks even out.
SPREAD = 2
#: Rounds that compare one document of each n-gram with the rest, after the first.
ROUNDS = 2
#: A task reports n-grams that so many of its documents hold to the hot count.
LOCAL = 8
#: Parts a class of equal sets is dealt to when its documents look up their first one.
PARTS = 16
#: Bits of an n-gram's hash that go along; its block adds the rest.
MASK40 = U64((1 << 40) - 1)

PACKED = "block int, low binary, high binary, rank binary, doc binary"
TICKETS = "block int, gram binary, rank binary, doc binary"
SETS = "doc_id long, n long, shared long, s1 long, s2 long, grams array<bigint>, prefix array<bigint>"
SETS_TYPE = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("s1", pa.int64()),
     ("s2", pa.int64()), ("grams", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))]
)
Batches = Iterator[pa.RecordBatch]


def least_overlap(n: int, percent: int) -> int:
    """A set of n shares at least so many n-grams with any partner."""
    return -(-n * percent // 100)


def rank_of(count: np.ndarray) -> np.ndarray:
    """Rarity class of a document count, 1 to 255; 0 is kept for set sizes."""
    return np.minimum(1 + 6 * np.log2(count), 255).astype(np.uint8)


def _grams(batches: Batches, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, sizes, n-grams, their ids) of about PACK n-grams of whole documents."""
    ids, sizes, grams, held = [], [], [], 0
    for batch in batches:
        doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for chunk in chunks(batch.column(1)):
            for row, found in shingle_sets(chunk, width):
                ids.append(doc[row])
                sizes.append(len(found))
                grams.append(found)
                held += len(found)
            if held >= PACK:
                yield _packed(ids, sizes, grams)
                ids, sizes, grams, held = [], [], [], 0
    if ids:
        yield _packed(ids, sizes, grams)


def _packed(ids, sizes, grams):
    ids, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
    return ids, sizes, np.concatenate(grams), np.repeat(ids, sizes)


def _hot_counts(width: int) -> Callable[[Batches], Batches]:
    def counted(batches: Batches) -> Batches:
        for _, _, grams, _ in _grams(batches, width):
            found, count = np.unique(grams, return_counts=True)
            many = count >= LOCAL
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[many].view(np.int64)), pa.array(count[many])], ["gram", "count"]
            )

    return counted


def hot_grams(texts: DataFrame, width: int, hot_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams above ``hot_rows`` entries and their counts; at most HOT_LIMIT of them.

    The threshold rises where more would pass, so what is sent to every task is bounded.
    """
    counts = cut(
        texts.mapInArrow(_hot_counts(width), "gram long, count long")
        .groupBy("gram")
        .agg(F.sum("count").alias("count"))
        .where(F.col("count") > hot_rows)
    )
    while True:
        least = max(hot_rows, counts.selectExpr(f"coalesce(sum(count), 0) div {HOT_LIMIT}").first()[0])
        rows = counts.where(F.col("count") > least).toArrow()
        order = np.argsort(gram := rows.column("gram").to_numpy().view(U64))
        return gram[order], rows.column("count").to_numpy()[order]


def _send(blocks: int, width: int, hot) -> Callable[[Batches], Batches]:
    """Map side: n-grams to column blocks; sizes and hot n-grams past them (block < 0)."""

    def sent(batches: Batches) -> Batches:
        known, count = hot.value
        for turn, (ids, sizes, grams, doc) in enumerate(_grams(batches, width)):
            block = (((grams >> U64(32)) * U64(blocks)) >> U64(32)).astype(np.int32)
            grams, rank = (block.astype(U64) % U64(32768) << U64(48)) | grams & MASK40, grams
            if len(known):
                at = np.minimum(np.searchsorted(known, rank), len(known) - 1)
                is_hot = known[at] == rank
            else:
                at, is_hot = np.zeros(len(grams), np.int64), np.zeros(len(grams), bool)
            past = -1 - int(ids[0] % blocks) if len(ids) else -1
            classes = np.zeros(len(ids) + int(is_hot.sum()), np.uint8)
            classes[len(ids) :] = rank_of(count[at[is_hot]]) if is_hot.any() else 0
            rows = [_piece(past, np.append(sizes.astype(U64), grams[is_hot]), np.append(ids, doc[is_hot]), classes)]
            keep = ~is_hot
            block, grams, doc = block[keep], grams[keep], doc[keep]
            order = np.argsort(block, kind="stable")
            block, grams, doc = block[order], grams[order], doc[order]
            edges = np.flatnonzero(np.diff(block)) + 1
            for low, high in zip(np.append(0, edges), np.append(edges, len(block)), strict=True):
                if high > low:
                    rows.append(_piece(int(block[low]), grams[low:high], doc[low:high], None))
            for i in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[i : i + 256], _schema(PACKED))

    return sent


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _piece(block: int, grams: np.ndarray, doc: np.ndarray, rank: np.ndarray | None) -> dict:
    """Five bytes an n-gram: the block gives the rest. Past the blocks all eight are kept."""
    low = (grams & U64(0xFFFFFFFF)).astype(np.uint32)
    high = (grams >> U64(32)).astype(np.uint8 if block >= 0 else np.uint32)
    return {
        "block": block, "low": low.tobytes(), "high": high.tobytes(),
        "rank": b"" if rank is None else rank.tobytes(), "doc": doc.astype(np.int64).tobytes(),
    }


def _joined(pieces: list[bytes], kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(pieces), dtype=kind)


def _count(buckets: int) -> Callable[[Batches], Batches]:
    """Column side: keep n-grams of two or more documents, deal them to row blocks."""

    def counted(batches: Batches) -> Batches:
        blocks: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blocks.setdefault(row["block"], []).append(row)
        kept = [(np.zeros(0, U64), np.zeros(0, np.uint8), np.zeros(0, np.int64))]
        for block in list(blocks):
            rows = blocks.pop(block)
            low = _joined([r["low"] for r in rows], np.uint32).astype(U64)
            doc = _joined([r["doc"] for r in rows], np.int64)
            if block < 0:
                high = _joined([r["high"] for r in rows], np.uint32).astype(U64)
                kept.append((high << U64(32) | low, _joined([r["rank"] for r in rows], np.uint8), doc))
                continue
            high = _joined([r["high"] for r in rows], np.uint8).astype(U64)
            grams = U64(block % 32768) << U64(48) | high << U64(32) | low
            order = np.argsort(grams)
            grams, doc = grams[order], doc[order]
            edges = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
            times = np.diff(np.append(edges, len(grams)))
            times = np.repeat(times, times)
            many = times > 1
            kept.append((grams[many], rank_of(times[many]), doc[many]))
        grams, rank, doc = (np.concatenate(x) for x in zip(*kept, strict=True))
        bucket = (mix(doc.view(U64)) % U64(buckets)).astype(np.int32)
        order = np.lexsort((doc, bucket))
        grams, rank, doc, bucket = grams[order], rank[order], doc[order], bucket[order]
        edges = np.flatnonzero(np.diff(bucket)) + 1
        rows = [
            {"block": int(bucket[a]), "gram": grams[a:b].tobytes(), "rank": rank[a:b].tobytes(), "doc": doc[a:b].tobytes()}
            for a, b in zip(np.append(0, edges), np.append(edges, len(doc)), strict=True)
            if b > a
        ]
        for i in range(0, len(rows), 256):
            yield pa.RecordBatch.from_pylist(rows[i : i + 256], _schema(TICKETS))

    return counted


def _bound(percent: int) -> Callable[[Batches], Batches]:
    """Row side: a document's size and, if it can hold a link, its shared n-grams."""

    def bounded(batches: Batches) -> Batches:
        blocks: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                blocks.setdefault(row["block"], []).append(row)
        for block in list(blocks):
            rows = blocks.pop(block)
            doc = _joined([r["doc"] for r in rows], np.int64)
            grams = _joined([r["gram"] for r in rows], U64)
            rank = _joined([r["rank"] for r in rows], np.uint8)
            order = np.argsort(doc, kind="stable")
            doc, grams, rank = doc[order], grams[order], rank[order]
            edges = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else []
            out = []
            for a, b in zip(edges, np.append(edges[1:], len(doc)), strict=True):
                out.append(_row(int(doc[a]), grams[a:b], rank[a:b], percent))
                if len(out) == 512:
                    yield pa.RecordBatch.from_pylist(out, SETS_TYPE)
                    out = []
            yield pa.RecordBatch.from_pylist(out, SETS_TYPE)

    return bounded


def _row(doc: int, grams: np.ndarray, rank: np.ndarray, percent: int) -> dict:
    size = rank == 0
    n = int(grams[size].max()) if size.any() else 0
    grams, at = np.unique(grams[~size], return_index=True)
    rank = rank[~size][at]
    row = {"doc_id": doc, "n": n, "shared": len(grams), "s1": None, "s2": None, "grams": None, "prefix": None}
    least = least_overlap(n, percent)
    if n == 0 or len(grams) < least:
        return row
    alone = max(0, n - len(grams))
    # The n-grams of no other document come first in the order and use up places.
    places = n - least + 1 - alone
    rarest = np.lexsort((grams, rank))[:places]
    # Sets that are shared throughout can be equal; any other is a class of its own.
    one, two = (doc, -1 - doc) if alone else (mix(grams).sum(), mix(grams ^ U64(0x5BD1E995)).sum())
    if not alone:
        one, two = (int(np.array([x], U64).view(np.int64)[0]) for x in (one, two))
    return row | {"s1": one, "s2": two, "grams": grams.view(np.int64), "prefix": grams[rarest].view(np.int64)}


def document_sets(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per doc_id its set size n and, for those that may have a link, the shared n-grams."""
    spark = documents.sparkSession
    texts = documents.where("doc_id IS NOT NULL").selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    hot = spark.sparkContext.broadcast(hot_grams(texts, width, hot_rows))
    blocks = buckets = SPREAD * partitions(spark)
    sent = texts.mapInArrow(_send(blocks, width, hot), PACKED).repartition(partitions(spark), "block")
    tickets = sent.mapInArrow(_count(buckets), TICKETS).repartition(partitions(spark), "block")
    return tickets.mapInArrow(_bound(percent), SETS)


def _candidates(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow a link: they share at most what each shares at all."""
    allowed = f"{100 + percent} * least(sa, sb) >= {percent} * (na + nb)"
    return pairs.where(allowed).selectExpr("a", "b").distinct()


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose accumulated overlap reaches the threshold.

    ``a`` is the side that few documents are on, so only their sets travel a second time.
    """
    few = pairs.select("a").distinct()
    left = rows.join(few, F.expr("doc_id = a"), "left_semi").selectExpr("doc_id AS a", "n AS na", "grams AS ga")
    right = rows.selectExpr("doc_id AS b", "n AS nb", "grams AS gb")
    return (
        pairs.join(right, "b")
        .join(left, "a")
        .selectExpr("a", "b", "na + nb AS total", "size(array_intersect(gb, ga)) AS overlap")
        .where(f"100 * overlap >= {percent} * (total - overlap)")
        .select("a", "b")
    )


def jaccard_components(
    documents: DataFrame, width: int = WIDTH, percent: int = PERCENT, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document that has an id.

    Documents link when the Jaccard similarity of their sets of word n-grams is at least
    ``percent`` / 100; component_id is the smallest doc_id reachable by links. Null and
    empty texts have an empty set and link with nothing. Rows that repeat a doc_id are one
    document: it has the largest of their sizes, and equal rows change nothing. Rows
    without doc_id are left out, other columns are not read.
    """
    sets = cut(document_sets(documents, width, percent, hot_rows))
    may = sets.where("s1 IS NOT NULL")
    # A set of its own needs no look-up; a large class of equal ones looks up in PARTS tasks.
    classes = may.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep"), F.count("doc_id").alias("_many")).where("_many > 1")
    classes = classes.selectExpr("s1", "s2", "n", "rep", f"explode(sequence(0, {PARTS - 1})) AS _part")
    member = cut(
        may.selectExpr("doc_id", "s1", "s2", "n", f"CAST(pmod(xxhash64(doc_id), {PARTS}) AS INT) AS _part")
        .join(classes, ["s1", "s2", "n", "_part"], "left")
        .selectExpr("doc_id", "coalesce(rep, doc_id) AS rep")
    )
    rows = cut(
        may.join(member.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi").select(
            "doc_id", "n", "shared", "grams", "prefix"
        )
    )
    postings = cut(rows.selectExpr("posexplode(prefix) AS (at, gram)", "doc_id AS b", "n AS nb", "shared AS sb"))

    def stars(entries: DataFrame, among: DataFrame) -> DataFrame:
        """Of every n-gram, one document of ``among`` against the others.

        The one that shares the largest part of its set: in a group of copies, the original.
        """
        hub = among.groupBy("gram").agg(F.min(F.expr("struct(nb - sb AS alone, b, nb, sb, part)")).alias("hub"))
        hub = hub.selectExpr("gram", "hub.b AS a", "hub.nb AS na", "hub.sb AS sa", "hub.part AS own")
        return cut(_candidates(entries.join(hub, "gram").where("own <> part"), percent))

    def open_postings(links: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Postings of n-grams that still join different components; of these, all that
        are not in the component of the n-gram's first document."""
        labels = smallest_reachable(links).withColumnRenamed("node", "b")
        placed = postings.join(labels, "b", "left").selectExpr(
            "gram", "at", "b", "nb", "sb", "coalesce(component, b) AS part"
        )
        grams = placed.groupBy("gram").agg(
            F.min("part").alias("low"), F.max("part").alias("high"), F.min(F.struct("b", "part")).alias("first"),
            F.min("nb").alias("least_n"),
        )
        grams = grams.where("low < high").selectExpr("gram", "first.part AS main", "least_n")
        left = cut(placed.join(grams, "gram"))
        return left, left.where("part <> main")

    placed = postings.withColumn("part", F.col("b"))
    links = cut(_verified(stars(placed, placed), rows, percent))
    left, minor = open_postings(links)
    for _ in range(ROUNDS):
        more = cut(_verified(stars(left, minor), rows, percent))
        if more.isEmpty():
            break
        links = links.union(more)
        left, minor = open_postings(links)
    # What is left: every document outside the first one's component against all others.
    # All documents order n-grams alike, so a pair's first common n-gram has all of its overlap
    # at or behind its place in either; a pair that is short of n-grams there is no link.
    behind = f"{100 + percent} * (sb - at) >= {percent} * (nb + least_n)"
    pairs = minor.where(behind).selectExpr("gram", "b AS a", "nb AS na", "sb - at AS sa", "part AS own").join(
        left.where(behind).selectExpr("gram", "b", "nb", "sb - at AS sb", "part", "main"), "gram"
    )
    pairs = cut(_candidates(pairs.where("own <> part AND (part = main OR a < b)"), percent))
    labels = smallest_reachable(links.union(_verified(pairs, rows, percent)))
    labels = member.join(labels.withColumnRenamed("node", "rep"), "rep", "left").selectExpr(
        "doc_id", "coalesce(component, rep) AS component"
    )
    return sets.select("doc_id", "n").join(labels, "doc_id", "left").selectExpr(
        "doc_id", "n AS n_shingles", "coalesce(component, doc_id) AS component_id"
    )


def one_of_each(documents: DataFrame, **options) -> DataFrame:
    """The documents that stay when each component keeps its smallest doc_id.

    Rows without doc_id stay, of rows that repeat a doc_id one stays. Columns as given.
    """
    found = jaccard_components(documents, **options)
    gone = found.where("component_id <> doc_id").selectExpr("doc_id AS _gone")
    named = documents.where("doc_id IS NOT NULL")
    stay = named.join(gone, F.expr("doc_id = _gone"), "left_anti").dropDuplicates(["doc_id"])
    return stay.union(documents.where("doc_id IS NULL"))


__all__ = ["document_sets", "hot_grams", "jaccard_components", "one_of_each"]
