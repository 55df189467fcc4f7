"""One query per operator over its whole table, and checking SQL where SQL can state it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import bpe, chat, decontaminate, fim, jaccard, license, packing, periodic, rollup, search, toxicity, urls, warc
from loanloom.llm.common import cut, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The vocabulary file; LOANLOOM_TOKENIZER names another one."""
    given = os.environ.get("LOANLOOM_TOKENIZER")
    if given:
        return given
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def byte_tokenizer() -> tuple[str, str]:
    """The byte-level vocabulary file and the pattern of its words; LOANLOOM_BYTE_TOKENIZER names another file."""
    import public_tokenizers

    given = os.environ.get("LOANLOOM_BYTE_TOKENIZER")
    return given or str(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN


@query
def op1_ngram_jaccard(spark, sf_dir):
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark, sf_dir):
    return license.license_scan(table(spark, sf_dir, "documents"))


@query
def op3_bpe_digests(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op4_exact_top_k(spark, sf_dir):
    return search.top_k(table(spark, sf_dir, "embeddings"))


@query
def op5_chat_windows(spark, sf_dir):
    own = "<|im_end|><|im_start|>assistant ok"
    added = spark.createDataFrame(
        [(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, sf_dir, "conversations").selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn", "role", "text")
    read = chat.read_windows(chat.format_windows(rows.union(added)))
    told = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    return read.selectExpr(
        "conv_id", "CAST(size(turns) AS BIGINT) AS n_turns", f"sha2({told}, 256) AS turns_sha256",
        "CAST(length(loss_text) AS BIGINT) AS loss_chars", "sha2(loss_text, 256) AS loss_sha256",
        "CAST(formatted_chars AS BIGINT) AS formatted_chars",
    )


@query
def op6_warc_index(spark, sf_dir):
    found = warc.archived(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_url_verdicts(spark, sf_dir):
    """The table labels speaks of documents, so the rules' verdicts label the URLs they fit."""
    pages = table(spark, sf_dir, "pages")
    return urls.url_verdicts(pages, urls.rule_labels(pages))


@query
def op8_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_token_rollup(spark, sf_dir):
    """Insert all documents, delete the toxic ones, recount junk without its repeated lines.

    Texts are counted where they lie; what meets the labels is a few numbers per document.
    """
    once = "array_join(array_distinct(split(text, '\\n')), '\\n')"
    counted = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "source", "lang", f"{rollup.numbers()} AS numbers", f"{rollup.numbers(once)} AS again"
    )
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.expr("coalesce(max(toxic), 0) = 1 AS toxic"), F.expr("min(quality) = 0 AS junk")
    )
    told = cut(counted.join(labels.where("toxic OR junk"), "doc_id"))
    gone, junk = told.where("toxic"), told.where("NOT toxic")
    base = scratch_dir(spark, "rollup")
    deleted = rollup.signed(rollup.by_version(gone), -1)
    rollup.commit(rollup.signed(rollup.by_version(counted), 1), base, "insert-1")
    rollup.commit(deleted, base, "delete-1")
    rollup.commit(rollup.revised(rollup.by_version(junk), rollup.by_version(junk, "again")), base, "revise-1")
    # Sent again: changes nothing.
    rollup.commit(deleted, base, "delete-1")
    return rollup.totals(spark, base)


@query
def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_period(text: str, h: int | None) -> list[str]:
    """Words of a text; where h divides by ten they repeat with one period from a place on."""
    words = periodic.split_words(text)
    if h is None or h % 10 or not words:
        return words
    start = h // 10 % len(words)
    period = 1 + (len(words) - start) // (3 + h // 10 % 8)
    return [*words[:start], *(words[start + i % period] for i in range(len(words) - start))]


def period_digests(documents: DataFrame) -> DataFrame:
    """Digests of the runs of documents, every tenth of which, by checksum, is made periodic first."""
    found = periodic.periodic_runs(documents, split=with_period, more=["crc32(CAST(doc_id AS STRING))"])
    return periodic.run_digests(found)


@query
def op11_periodic_runs(spark, sf_dir):
    return period_digests(table(spark, sf_dir, "documents"))


@query
def op12_fill_in_middle(spark, sf_dir):
    cut_up = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    return cut_up.selectExpr(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "sha2(output, 256) AS output_sha256",
        f"sha2({fim.restored()}, 256) AS restored_sha256",
    )


@query
def op13_packing(spark, sf_dir):
    pieces = packing.packed(table(spark, sf_dir, "documents"), *byte_tokenizer())
    return pieces.selectExpr(
        "doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline

ORACLES["op9_token_rollup"] = r"""
WITH told AS (
    SELECT doc_id, max(toxic) AS toxic, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), rows AS (
    SELECT source, lang, coalesce(CASE WHEN told.quality = 0 THEN
        (SELECT string_agg(line, chr(10) ORDER BY pos) FROM
            (SELECT line, min(pos) AS pos FROM (SELECT unnest(string_split(d.text, chr(10))) AS line,
                generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) GROUP BY line))
        ELSE d.text END, '') AS text
    FROM documents d LEFT JOIN told USING (doc_id)
    WHERE coalesce(told.toxic, 0) <> 1
), counted AS (
    SELECT source, lang, 'words-1' AS version, len(regexp_extract_all(text, '[^ \t\n\r]+')) AS tokens FROM rows
    UNION ALL
    SELECT source, lang, 'quarters-1' AS version, CAST(ceil(length(text) / 4) AS BIGINT) AS tokens FROM rows
)
SELECT source, lang, version, count(*) AS docs, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counted GROUP BY ALL
"""

_UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
ORACLES["op12_fill_in_middle"] = rf"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
        sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), k AS (
    SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1,
        CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
            OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
            WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM t
), s AS (
    SELECT doc_id, t, n, form, array_to_string(u[1:least(c1, c2)], '') AS p,
        array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s
    FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM s
"""

ORACLES["op1_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents WHERE doc_id IS NOT NULL
), starts AS (
    SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words
), grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM starts
), sizes AS (
    SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
    HAVING 100 * count(*) >= 80 * ((SELECT n FROM sizes s WHERE s.doc_id = a.doc_id)
        + (SELECT n FROM sizes s WHERE s.doc_id = b.doc_id) - count(*))
), near AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
    SELECT DISTINCT doc_id, doc_id AS to_id FROM words
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN near l ON l.a = r.to_id
)
SELECT r.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.to_id) AS component_id
FROM reach r LEFT JOIN sizes s USING (doc_id) GROUP BY r.doc_id
"""

ORACLES["op4_exact_top_k"] = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
    WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_GROUPS = " || ".join(
    "".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((CAST('0x' || substr(h, {1 + 5 * i}, 5) AS INTEGER)) >> {shift}) & 31), 1) || "
            for shift in (15, 10, 5, 0))[:-4]
    for i in range(8)
)
ORACLES["op6_warc_index"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
     k AS (SELECT html, max(page_id) AS kept FROM p GROUP BY html),
     d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS h, kept FROM p JOIN k USING (html))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_GROUPS} AS payload_digest,
    CASE WHEN page_id < kept THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < kept THEN kept END AS refers_to
FROM d
"""
