"""URL filters: host and path rules, and a path-template tree judged by labelled purity.

Rules come first: a rule fits its host and every subdomain when the path starts with the
rule's path; the longest rule wins. Other URLs go to the template tree. Level by level, until
no segment is left, a segment under one host and template becomes a wildcard if it looks like
an id, or if it is one of many words and holds a small share of the distinct URLs there. How
often a URL was captured does not count. Sibling templates whose share of bad labels does not differ from their common share
beyond chance are merged into one branch. A branch is rejected when its smoothed share of
good labels falls below ``least_purity``. It is smoothed towards the share its template has over all
hosts, and that towards the overall share: so hosts without labels are judged by how their
templates fare elsewhere, and a host's own labels weigh more the more there are.

All counts are combined before they are shuffled; joins of URLs with what was found about a
host are salted, so a host with a third of all URLs is spread over SALTS keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import cut

#: (verdict, host, path); fixed by the contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Values that are ids by their shape: numbers, dates, long hexadecimal, words with three digits.
ID = r"^([0-9]+([-_.:][0-9]+)*([.][a-zA-Z]+)?|[0-9a-fA-F-]*[0-9][0-9a-fA-F-]{7,}|[^0-9]*([0-9][^0-9]*){3,})$"
#: Of so many words or more, those with less than this part of the distinct URLs are variable.
MANY = 50
#: Standard deviations beyond which a branch differs from its siblings.
DIFFERENT = 2.0
#: Labels that the overall share of good ones counts for in every branch.
PRIOR = 8.0
LEAST_PURITY = 0.5
SALTS = 64

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path; both empty for null URLs and those without ``://``."""
    rest = "CASE WHEN instr(url, '://') > 0 THEN substring(url, instr(url, '://') + 3) ELSE '' END"
    return (
        pages.selectExpr("CAST(page_id AS BIGINT) AS page_id", f"coalesce({rest}, '') AS _rest")
        .selectExpr("page_id", "_rest", "regexp_extract(_rest, '^[^/?#]*', 0) AS _host")
        .selectExpr(
            "page_id",
            f"translate(_host, '{UPPER}', '{LOWER}') AS host",
            "regexp_extract(substring(_rest, length(_host) + 1), '^[^?#]*', 0) AS path",
        )
    )


def rule_expression(rules: Sequence[tuple[str, str, str]], what: int | None = None) -> str:
    """The longest fitting rule as text, or its field ``what``; null where none fits."""
    cases = []
    for rule in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        _, host, path = rule
        value = host + path if what is None else rule[what]
        cases.append(
            f"WHEN (host = '{host}' OR endswith(host, '.{host}')) AND startswith(path, '{path}') THEN '{value}'"
        )
    return f"CASE {' '.join(cases)} END" if cases else "CAST(NULL AS STRING)"


def rule_labels(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(doc_id, quality) of the pages a rule fits: 1 where it allows them, 0 where it blocks them."""
    told = split_urls(pages).selectExpr("page_id AS doc_id", f"{rule_expression(rules, 0)} AS told")
    return told.where("doc_id IS NOT NULL AND told IS NOT NULL").selectExpr("doc_id", "CAST(told = 'allow' AS INT) AS quality")


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(path, page_id), {SALTS}) AS INT)"))


def _spread(found: DataFrame) -> DataFrame:
    return found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def templates(urls: DataFrame) -> DataFrame:
    """The rows of ``split_urls`` with ``parent`` and ``template`` of their path."""
    active = urls.select("host", "path").distinct().selectExpr(
        "host", "path", f"CAST(pmod(xxhash64(path), {SALTS}) AS INT) AS salt",
        "split(ltrim('/', path), '/') AS segments", "'' AS parent", "'' AS template",
    )
    active = cut(active)
    done, level = active.limit(0).select("host", "path", "parent", "template"), 0
    while not active.isEmpty():
        # Among fewer URLs no word is one of MANY, here or further down: what is left of them is plain.
        large = active.groupBy("host", "template").agg(F.count("*").alias("urls")).where(f"urls >= {MANY}")
        here = active.join(_spread(large), ["host", "template", "salt"], "left")
        here = cut(here.withColumn("segment", F.expr(f"segments[{level}]")).withColumn("id", F.expr(f"segment RLIKE r'{ID}'")))
        rest = f"transform(slice(segments, {level + 1}, size(segments)), s -> IF(s RLIKE r'{ID}', '*', s))"
        plain = here.where("urls IS NULL").selectExpr("host", "path", "template", f"{rest} AS names")
        done = done.union(
            plain.selectExpr(
                "host", "path", "array_join(concat(array(template), slice(names, 1, size(names) - 1)), '/') AS parent",
                "array_join(concat(array(template), names), '/') AS template",
            )
        )
        here = here.where("urls IS NOT NULL")
        values = here.where("NOT id").groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        many = values.groupBy("host", "template").agg(F.count("*").alias("k"), F.sum("n").alias("all")).where(f"k >= {MANY}")
        # At most MANY values hold such a share.
        own = values.join(many, ["host", "template"]).groupBy("host", "template").agg(
            F.expr(f"collect_set(CASE WHEN n * {MANY} >= all THEN segment END)").alias("own")
        )
        joined = here.join(_spread(own), ["host", "template", "salt"], "left")
        active = cut(
            joined.selectExpr(
                "host", "path", "salt", "segments", "template AS parent",
                "concat(template, '/', CASE WHEN id OR NOT array_contains(own, segment) THEN '*' ELSE segment END) AS template",
            )
        )
        level += 1
        done = done.union(active.where(f"size(segments) = {level}").select("host", "path", "parent", "template"))
        active = active.where(f"size(segments) > {level}")
    found = _salted(urls).join(done, ["host", "path"])
    return found.select("page_id", "host", "path", "salt", "parent", "template")


def branches(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, template, branch, labelled, bad, elsewhere, purity) of every template.

    ``elsewhere`` is how many labels the template has on any host.
    ``labels`` says of a page, its doc_id is a page_id, whether it is good (1) or bad (0);
    pages labelled both ways are bad.
    """
    told = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
        .agg(F.min("quality").alias("good")).selectExpr("doc_id AS page_id", "CAST(good <= 0 AS INT) AS bad")
    )
    leaves = rows.join(told, "page_id", "left").groupBy("host", "parent", "template").agg(
        F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    leaves = cut(leaves)
    total = leaves.selectExpr("coalesce(sum(labelled), 0) AS labelled", "coalesce(sum(bad), 0) AS bad").first()
    good = 1.0 - (total.bad / total.labelled if total.labelled else 0.0)
    spread = f"CAST(pmod(xxhash64(host), {SALTS}) AS INT) AS salt"
    alike = leaves.groupBy("template").agg(F.sum("labelled").alias("tl"), F.sum("bad").alias("tb")).where("tl > 0")
    leaves = leaves.selectExpr("*", spread).join(_spread(alike), ["template", "salt"], "left").selectExpr(
        "host", "parent", "template", "labelled", "bad", "coalesce(tl, 0) AS elsewhere",
        f"(coalesce(tl - tb, 0) + {PRIOR} * {good!r}D) / (coalesce(tl, 0) + {PRIOR}) AS prior",
    )
    pools = leaves.groupBy("host", "parent").agg(F.sum("labelled").alias("pl"), F.sum("bad").alias("pb"))
    compared = leaves.join(pools, ["host", "parent"]).withColumn("share", F.expr("coalesce(pb / nullif(pl, 0), 0)"))
    compared = compared.withColumn(
        "differs",
        F.expr(f"abs(bad - labelled * share) > {DIFFERENT} * sqrt(labelled * share * (1 - share) + 0.25)"),
    ).withColumn("branch", F.expr("CASE WHEN differs THEN template ELSE concat(parent, '/~') END"))
    merged = compared.groupBy("host", "parent", "branch").agg(F.sum("labelled").alias("bl"), F.sum("bad").alias("bb"))
    return compared.join(merged, ["host", "parent", "branch"]).selectExpr(
        "host", "template", "branch", "bl AS labelled", "bb AS bad", "elsewhere",
        f"(bl - bb + {PRIOR} * prior) / (bl + {PRIOR}) AS purity",
    )


def url_verdicts(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_purity: float = LEAST_PURITY,
) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every row.

    Null URLs and URLs without ``://`` have empty host and path, no rule, and the verdict
    of the empty template. Repeated rows repeat their result, rows without page_id have no
    label. Labels must be about pages, as those of ``rule_labels`` are: their doc_id is a
    page_id. What neither a rule nor a label speaks against is allowed, a template without
    labels on any host too. Other columns of either table are not read.
    """
    rows = cut(templates(split_urls(pages)))
    rejected = branches(rows, labels.select("doc_id", "quality")).where(f"labelled + elsewhere > 0 AND purity < {least_purity}")
    rejected = rejected.select("host", "template", F.lit("block").alias("judged")).distinct()
    joined = rows.join(_spread(rejected), ["host", "template", "salt"], "left")
    return joined.selectExpr(
        "page_id", "host", "path", f"{rule_expression(rules)} AS rule",
        f"coalesce({rule_expression(rules, 0)}, judged, 'allow') AS verdict", "template",
    )
