"""The training-data operators against brute force, round trips and held-out labels."""

import base64
import gzip
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest

from loanloom.llm import bpe, chat, decontaminate, jaccard, license, rollup, search, toxicity, urls, warc
from loanloom.llm.components import smallest_reachable
from loanloom.llm.queries import QUERIES, tokenizer_path
from conftest import TESTDATA

SF = str(TESTDATA / "sf0.001")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
needs_data = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC)


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (5, "One TWO"), (None, "one two"), (6, "x" * 300_000)]


def shingle_set(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall("[^ \t-\r]+", low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("hot_rows", [5, 20_000])
def test_jaccard_equals_brute_force(spark, hot_rows):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 30, 80]))] for _ in range(12)]
    shared = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(1000)}"
        rows.append((i, " ".join(words + shared * (i % 3 == 0))))
    df = documents(spark, rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df, hot_rows=hot_rows).collect()}
    assert got == brute_components(rows)


def test_jaccard_edges(spark):
    df = documents(spark, EDGES)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect()}
    assert got == {1: (0, 1), 2: (0, 2), 3: (0, 3), 4: (1, 4), 5: (1, 4), 6: (1, 6)}
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    kept = sorted((r.doc_id or 0) for r in jaccard.one_of_each(df).collect())
    assert kept == [0, 1, 2, 3, 4, 6]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 30)] + [(50, 60), (60, 50), (70, 70), (None, 3)]
    got = {r.node: r.component for r in smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 50: 50, 60: 50}


def test_license_scan(spark):
    texts = {
        1: "x MIT License y\nGNU General Public License",
        2: "permission is hereby granted FREE of charge to any person obtaining a copy of this software",
        3: "mit\nlicense cc-by",
        4: "permission is granted to any person",
        5: None,
    }
    got = {r.doc_id: r for r in license.license_scan(documents(spark, [*texts.items(), (None, "cc by")])).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (2, 1, 4, "gpl,mit")
    assert (got[2].n_base, got[2].base_labels, got[2].labels, got[2].first_word) == (0, "", "mit", None)
    assert (got[3].n_base, got[3].base_labels) == (2, "cc-by,mit")
    assert (got[4].labels, got[4].score) == ("", 0.0) and (got[5].n_words, got[5].score) == (0, 0.0)
    assert got[None].base_labels == "cc-by"


def brute_license(text, percent=license.PERCENT):
    """Labels and best containment by looking at every run of words a template may span."""
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    base = {
        label for phrase, label in license.PHRASES.items() for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    }
    labels, best = set(base), 1.0 if base else 0.0
    for template, label in license.TEMPLATES.items():
        held = set(template.split())
        least, span = -(-len(held) * percent // 100), -(-len(template.split()) * 100 // percent)
        common = max((len(held & set(w[i : i + span])) for i in range(len(w))), default=0)
        if common >= least:
            labels.add(label)
            best = max(best, common / len(held))
    return len(w), ",".join(sorted(base)), ",".join(sorted(labels)), best


def test_license_labels_and_scores_equal_brute_force(spark):
    rng = random.Random(3)
    templates = list(license.TEMPLATES)
    texts = {0: None, 1: "", 2: "LICENSE\U0001F600 K İ café\x85 mit\tlicense", 3: "All humans have equal rights under the law, and some seats are reserved."}
    for i in range(4, 160):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            words = rng.choice(templates).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = rng.choice([[], ["other"], ["other", "words"]])
            parts += ["filler"] * rng.randrange(0, 70) + words[rng.choice([0, 0, 0, 2]) :]
        texts[i] = "".join(w.upper() + rng.choice([" ", ", ", "\n", "\n# "]) if rng.random() < 0.3 else w + " " for w in parts)
    rows = [*texts.items(), (5, texts[5]), (None, texts[6])]
    found = license.license_scan(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    got = {r.doc_id: (r.n_words, r.base_labels, r.labels, pytest.approx(r.score)) for r in found if r.doc_id is not None}
    assert got == {i: brute_license(t) for i, t in texts.items()}
    assert sum(bool(v[2]) for v in got.values()) > 80 and got[3][2] == ""
    assert license.license_scan(documents(spark, rows).limit(0)).count() == 0


def test_license_notices_span_lines(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and more"
    bsd = "// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided"
    texts = {
        1: "Some words\n" + mit,
        2: "word " * 30 + "\n" + bsd,
        3: "All rights reserved.",
        4: "prose " * 25 + "\r\n * licensed under\r\n *\r\n * the Apache License,\r\n * Version 2.0",
        5: "all of us " + "x " * 10 + "\nhad rights " + "y " * 10 + "\nreserved for others",
        6: "licensed " + "x " * 50 + "under the mit license " + "released",
        **{100 + n: "w " * n + mit for n in range(0, 45, 3)},
    }
    got = {r.doc_id: r for r in license.license_scan(documents(spark, texts.items())).collect()}
    want = {1: "mit", 2: "bsd", 3: "all-rights-reserved", 4: "apache", 5: "", 6: "mit"} | {i: "mit" for i in texts if i >= 100}
    assert {i: r.labels for i, r in got.items()} == want
    assert got[1].base_labels == "" and got[1].score == 1.0 and got[5].score == 0.0


@needs_data
def test_license_base_equals_brute_force(spark):
    rows = read(spark, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in license.license_scan(read(spark, "documents")).collect()}
    table = str.maketrans(license.UPPER, license.LOWER)
    for row in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (row.text or "").translate(table))
        places = [(i, v) for p, v in license.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        r = got[row.doc_id]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert r.base_labels == ",".join(sorted({v for _, v in places}))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def test_bpe_equals_the_library(library):
    own, rng = bpe.Bpe.read(tokenizer_path()), random.Random(2)
    texts = ["", " ", "Σας ΟΔΟΣ", "a<|endoftext|>b", "it's we'll 123 ½", "x\x1cy\x85z", "é é", "日本語 😀"]
    texts += ["".join(rng.choice(a) for _ in range(n)) for n in (600, 9000) for a in ("abcdefgh", "ab", "eta", "éü日")]
    texts.append(" ".join("".join(rng.choice("etaoin") for _ in range(rng.randrange(1, 12))) for _ in range(30_000)))
    for text in texts:
        ids = [i for part in own.encode(text) for i in part]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert "".join(own.decode([ids])) == library.decode(ids, skip_special_tokens=False)


def test_bpe_forgets_without_a_trace(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own, rng = bpe.Bpe.read(tokenizer_path()), random.Random(7)
    words = ["one,", "two", "three.", "it's", "four", "five-six", "…", "seven", "一二"]
    for _ in range(20):
        text = " ".join(rng.choice(words) for _ in range(40))
        assert [i for part in own.encode(text) for i in part] == library.encode(text, add_special_tokens=False).ids
        assert len(own._memory) <= 3 and len(own._older) <= 3


def test_bpe_streams_long_words_the_same():
    own, rng = bpe.Bpe.read(tokenizer_path()), random.Random(3)
    for letters in ("abcdefghijklmnop", "ab", "thein"):
        word = [own.start[ord(rng.choice(letters))] for _ in range(20_000)]
        word[-1] = own.ending[word[-1]]
        assert list(own.stream(iter(word), room=64)) == own.merged(list(word))


def test_bpe_plain_text_state(spark):
    own = bpe.Bpe.read(tokenizer_path())
    ids = [i for part in own.encode("héllo wörld 日本") for i in part]
    assert "".join(own.decode_text([[i] for i in ids])) == "héllo wörld 日本 "
    df = documents(spark, EDGES).selectExpr("*", "n_chars AS n_tokens")
    with_digests = bpe.with_digests(df, tokenizer_path())
    assert with_digests.count() == len(EDGES) and with_digests.columns.count("n_tokens") == 1
    rows = bpe.token_digests(df, tokenizer_path()).where("doc_id = 1").collect()
    assert (rows[0].n_tokens, rows[0].ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    round_trip = bpe.decode_ids(bpe.encode_ids(documents(spark, [(1, "a b")]), tokenizer_path()), tokenizer_path(), True)
    assert round_trip.first().text == "a b "


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_ROWS", 150)
    rng = np.random.default_rng(4)
    v = rng.normal(size=(500, 8)).round(1)
    v[100:300] = v[100]
    rows = [(i, [float(x) for x in v[i]]) for i in range(500)]
    odd = [(1000, None), (1050, [1.0, None]), (1100, [float("nan")] * 8), (1150, [1.0, 2.0]), (None, [1.0] * 8), (0, rows[0][1])]
    got = search.top_k(spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>"))
    q = np.floor(256 * v.astype(np.float32).astype(float))
    want = set()
    for i in range(0, 500, 50):
        s = q @ q[i]
        best = [j for j in np.lexsort((np.arange(500), -s)) if j != i][:5]
        want |= {(i, n + 1, int(j), int(s[j])) for n, j in enumerate(best)}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()} == want


@pytest.mark.parametrize("budget", [1, 60, 2048])
def test_chat_round_trip(spark, budget):
    rng = random.Random(5)
    rows = [
        (c, t, "system" if t == 0 and (c or 0) % 2 else ("user", "assistant", "a\\b\nc", None)[rng.randrange(4)],
         rng.choice([None, "", "<|im_end|>\n", "\\<|x|>\\\\", "<|im_start|>assistant", "y" * 90, "😀<", "\n\n"]))
        for c in [*range(12), None] for t in range(1 + (c or 0))
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_windows(chat.format_windows(df, budget, budget // 4)).collect()}
    for conv in {r[0] for r in rows}:
        turns = [(r or "", t or "") for c, _, r, t in sorted((x for x in rows if x[0] == conv), key=lambda x: x[1])]
        assert [(t.role, t.text) for t in got[conv].turns] == turns
        assert got[conv].loss_text == "".join(t for r, t in turns if r == "assistant")
    assert chat.read_windows(chat.format_windows(df.limit(0))).count() == 0


def test_warc_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RUN_ROWS", 7)
    html = [None, "", "\r\n", "a\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\n\r\n", "é" * 50]
    rows = [(i, f"http://h{i % 3}.org/p?{i}", html[i % 5]) for i in range(40)] + [(None, None, "n")]
    got = warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    last = {}
    for i, _, h in rows[:-1]:
        last[h or ""] = i
    for r in got:
        text = dict((i, h or "") for i, _, h in rows)[r.page_id]
        assert r.payload_bytes == len(text.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
        kept = last.get(text, r.page_id)
        assert (r.record_type, r.refers_to) == (("response", None) if kept == r.page_id else ("revisit", kept))
    keys = [(r.urlkey, r.captured, r.page_id is not None, r.page_id) for r in got]
    assert len(got) == 41 and keys == sorted(keys)


def test_warc_reads_back_what_it_reports(spark, tmp_path):
    """A payload that was cut or changed, a missing response, repeated and empty pages."""
    rows = [(i, f"http://h.org/{i}", html) for i, html in enumerate(["<p>one</p>", "<p>two</p>", "<p>one</p>", "", None])]
    rows += [(7, "http://h.org/7", "seven"), (7, "http://h.org/7", "other"), (3, "u", "seven"), (None, "u", "seven")]
    # Other columns may have any name.
    pages = spark.createDataFrame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, payload string, kept int")
    path = str(tmp_path / "good")
    got = warc.archived(pages, path=path).select("page_id", "record_type", "payload_bytes", "refers_to").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([
        (0, "revisit", 10, 2), (1, "response", 10, None), (2, "response", 10, None), (3, "revisit", 0, 4), (4, "response", 0, None),
        (7, "response", 5, None), (7, "response", 5, None), (3, "revisit", 5, 7), (None, "response", 5, None),
    ], key=repr)
    assert warc.archived(pages.limit(0), path=str(tmp_path / "none")).count() == 0

    def changed(name, edit):
        target = tmp_path / name
        target.mkdir()
        whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "good").glob("*.gz")))
        assert edit(whole) != whole
        (target / "part-0.txt.gz").write_bytes(gzip.compress(edit(whole)))
        return warc.capture_index(warc.read_archive(spark, str(target), "good"))

    with pytest.raises(Exception, match="damaged"):
        changed("cut", lambda b: b.replace(b"<p>two</p>", b"<p>two<")).collect()
    with pytest.raises(Exception, match="damaged"):
        changed("other", lambda b: b.replace(b"<p>two</p>", b"<p>TWO</p>")).collect()
    with pytest.raises(Exception, match="missing or another"):
        changed("lost", lambda b: b.replace(b"Refers-To: <urn:page:2>", b"Refers-To: <urn:page:1>")).collect()
    assert changed("same", lambda b: b.replace(b"Content-Type", b"content-type")).count() == len(rows)


def test_loser_tree():
    rng = random.Random(6)
    for n in (0, 1, 2, 3, 7, 8):
        runs = [sorted((rng.randrange(50),) for _ in range(rng.randrange(30))) for _ in range(n)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_url_rules_and_templates(spark):
    plain = {
        "https://a.example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://A.Example.ORG/en/12?x": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "http://x.com/fr/1#y": ("x.com", "/fr/1", "com/fr/", "allow"),
        "http://org": ("org", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u) for i, u in enumerate(plain)] + [(100 + i, f"http://bad.net/x/{i}") for i in range(40)]
    rows += [(200 + i, f"http://bad.net/fine/{i}") for i in range(40)]
    labels = [(100 + i, 0) for i in range(30)] + [(200 + i, 1) for i in range(40)]
    got = {
        r.page_id: r
        for r in urls.url_verdicts(
            spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int")
        ).collect()
    }
    for i, want in enumerate(plain.values()):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == want
    assert got[139].template == "/x/*" and {got[100 + i].verdict for i in range(40)} == {"block"}
    assert {got[200 + i].verdict for i in range(40)} == {"allow"}


def test_url_labels_are_about_urls(spark, tmp_path):
    rows = [(i, f"http://clean.net/a/{i}") for i in range(40)] + [(100 + i, f"http://x.com/de/{i}") for i in range(40)]
    rows += [(200 + i, f"http://x.com/fr/{i}") for i in range(60)] + [(300, "http://x.com//de/7"), (301, "http://x.com//fr/7")]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, int(i >= 100), 0) for i in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.page_id: (r.rule, r.verdict) for r in QUERIES["op7_url_verdicts"](spark, str(tmp_path)).collect()}
    assert {got[i] for i in range(40)} == {(None, "allow")}
    assert got[300] == (None, "block") and got[301] == (None, "allow")


def test_url_templates_are_judged_by_other_hosts_too(spark):
    rows = [(i, f"http://h{i % 4}.com/promo/{i}") for i in range(40)] + [(100 + i, f"http://h{i % 4}.com/news/{i}") for i in range(40)]
    rows += [(200, "http://new.net/promo/7"), (201, "http://new.net/news/7"), (202, "http://new.net/promo/x"), (203, None)]
    # On this host the template is good, by labels of its own.
    rows += [(300 + i, f"http://fine.net/promo/{i}") for i in range(40)]
    told = [(i, int(i >= 100)) for i in (*range(40), *range(100, 140), *range(300, 336))] + [(None, 0)]
    pages = spark.createDataFrame([(*r, "h", "t", 1) for r in rows], "page_id long, url string, host string, template string, salt int")
    labels = spark.createDataFrame(told, "doc_id long, quality int")
    got = {r.page_id: r for r in urls.url_verdicts(pages, labels).collect()}
    assert len(got) == len(rows)
    assert got[200].verdict == "block" and got[200].template == "/promo/*"
    assert {got[i].verdict for i in (201, 202, 203)} == {"allow"}
    assert {got[300 + i].verdict for i in range(40)} == {"allow"} and {got[i].verdict for i in range(40)} == {"block"}
    # By the definition: the template's share over all hosts, then the host's own.
    bad, n = 40, 116
    good = 1 - bad / n
    over_all = (36 + urls.PRIOR * good) / (76 + urls.PRIOR)
    found = {(r.host, r.template): r for r in urls.branches(urls.templates(urls.split_urls(pages)), labels).collect()}
    assert found["new.net", "/promo/*"].purity == pytest.approx(over_all)
    assert found["fine.net", "/promo/*"].purity == pytest.approx((36 + urls.PRIOR * over_all) / (36 + urls.PRIOR))
    assert found["h1.com", "/promo/*"].purity == pytest.approx(urls.PRIOR * over_all / (10 + urls.PRIOR))
    assert urls.url_verdicts(pages.limit(0), labels).count() == 0 and urls.url_verdicts(pages, labels.limit(0)).where("verdict = 'block'").count() == 0


def test_a_deep_path_costs_no_level(spark):
    deep = "/".join(f"s{i % 90}" if i % 3 else str(i) for i in range(5000))
    rows = [(1, f"http://h.net/{deep}")] + [(10 + i, f"http://h.net/u/{a}{i}x/p") for i, a in enumerate("abcdefghij" * 8)]
    began = time.time()
    got = {r.page_id: r for r in urls.templates(urls.split_urls(spark.createDataFrame(rows, "page_id long, url string"))).collect()}
    assert time.time() - began < 60
    assert got[1].template == "/" + "/".join(f"s{i % 90}" if i % 3 else "*" for i in range(5000))
    assert got[1].parent == got[1].template[: got[1].template.rindex("/")]
    assert {got[10 + i].template for i in range(80)} == {"/u/*/p"}


def test_url_templates_do_not_depend_on_captures_or_depth(spark):
    paths = [f"/item/{1000 + i}" for i in range(9)] + ["/about", "/jobs", "/faq", "/shop", "/one/two", "", "/"]
    paths += [f"/u/{a}{b}/posts" for a in "abcdefghij" for b in "klmnopq"] + [f"/a/b/c/spam/{i}" for i in range(30)]
    paths += [f"/a/b/c/docs/{i}/x/y" for i in range(30)]

    def found(times):
        rows = [(i, f"http://h.net{p}") for i, p in enumerate(paths)] * times
        df = spark.createDataFrame(rows, "page_id long, url string")
        return urls.templates(urls.split_urls(df)).select("path", "template", "page_id").collect()

    once, often = found(1), found(5)
    assert len(once) == len(paths) and len(often) == 5 * len(paths) and set(once) == set(often)
    got = {r.path: r.template for r in often}
    assert got["/item/1003"] == "/item/*" and got["/about"] == "/about" and got["/u/ak/posts"] == "/u/*/posts"
    assert got["/a/b/c/spam/7"] == "/a/b/c/spam/*" and got["/a/b/c/docs/7/x/y"] == "/a/b/c/docs/*/x/y"
    assert got[""] == "/" and got["/one/two"] == "/one/two"


BENCH = (
    "Yesterday Tom walked 12 km with Anna to the market and paid 7 dollars for bread while Tom carried it home in 12 minutes"
)


def test_decontamination(spark):
    other = BENCH.replace("Tom", "Jean").replace("12", "31").replace("Anna", "Rita")
    mixed = BENCH.replace("12", "31", 1).replace("Tom", "Jean", 1)
    rows = [
        (1, "intro words here. " + BENCH.lower().upper().lower()), (2, f"Some text. {other} and more"), (3, "clean words only " * 20),
        (4, None), (5, ""), (6, f"Some text. {BENCH}"), (None, BENCH), (7, f"Some text. {mixed} and more"),
    ]
    bench = spark.createDataFrame([(9, BENCH), (9, BENCH), (10, None), (11, "a b")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(documents(spark, rows), bench).collect()}
    assert {2, 6, 7} <= set(got) and not {3, 4, 5, None} & set(got)
    assert got[2].other_values and not got[6].other_values and got[6].item_id == 9
    # One of two equal numbers and names was edited: the windows beside them are the item's own.
    assert not got[7].other_values and got[7].item_id == 9
    kept = decontaminate.without_benchmark(documents(spark, rows), bench).collect()
    assert {r.doc_id for r in kept} == {r[0] for r in rows} - set(got)


def test_decontamination_drops_only_windows_that_conflict(spark):
    decimal = "The pump in the cellar moves 3.5 litres of water through the old copper pipe every 5 seconds of the day"
    short = "Anna had 12 red apples and gave 7 to Tom in the garden"
    rows = [
        (1, "Some text. " + BENCH.replace("12", "31", 1).replace("Tom", "Jean", 1) + " and more"),
        (2, "Some text. " + BENCH.replace("7 dollars", "12 dollars")),
        (3, "Some text. " + decimal.replace("3.5", "3.7")),
        (4, "Some text. " + BENCH.replace("Tom", "Jean").replace("12", "31").replace("while Jean", "while Tom")),
        (5, "Some text. Rita had 31 red apples and gave 31 to Rita in the garden"),
    ]
    bench = spark.createDataFrame([(1, BENCH), (2, decimal), (3, short)], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.contamination(documents(spark, rows), bench).collect()}
    assert {i: r.item_id for i, r in got.items()} == {1: 1, 2: 1, 3: 2, 4: 1}
    assert not got[1].other_values and got[1].n_words == 20 and got[4].other_values


def test_decontamination_finds_items_of_any_kind_word_for_word(spark):
    rows = [
        (1, "Task: convert 3 km 500 m to cm."), (2, "1) What is the capital of France"), (3, "Name a prime"),
        (4, "地理。法国的首都是什么城市？请回答"), (5, "地理。德国的首都是什么城市？请回答"), (6, "他有3个苹果，又买了12个苹果，一共有几个苹果呢"),
        (7, "Convert 3 km 700 m to cm"), (8, "name that prime"), (9, "x日本語y"), (10, "Tom Smith met Ann Lee, Bob Ray, Joe Fox"),
    ]
    told = [
        (1, "Convert 3 km 500 m to cm"), (2, "What is the capital of France"), (3, "name a prime"), (4, "法国的首都是什么城市？"),
        (6, "他有3个苹果,又买了12个苹果,一共有几个苹果呢"), (9, "日本語"), (10, "TOM SMITH met ANN LEE, BOB RAY, JOE FOX"), (11, "!?"),
    ]
    bench = spark.createDataFrame(told, "item_id long, text string")
    got = decontaminate.contamination(documents(spark, rows), bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, i) for i in (1, 2, 3, 4, 6, 9, 10)]


def test_rollup_is_idempotent(spark, tmp_path):
    df = documents(spark, [(1, "a b"), (2, "c"), (3, None)])
    base, counts = str(tmp_path), rollup.counts(df)
    assert rollup.totals(spark, base).count() == 0
    assert rollup.commit(rollup.signed(counts, 1), base, "1") and not rollup.commit(rollup.signed(counts, 1), base, "1")
    assert rollup.commit(rollup.revised(rollup.counts(df.where("doc_id = 1")), rollup.counts(documents(spark, [(1, "a b c")]))), base, "2")
    got = {r.version: (r.docs, r.tokens) for r in rollup.totals(spark, base).collect()}
    assert got == {"words-1": (3, 4), "quarters-1": (3, 3)}


def test_rollup_keeps_batch_names_and_odd_rows(spark, tmp_path):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "s", "en"), (3, "a " * 200_000, "s", "en"), (None, "b", "s", None)]
    # Columns that clash with those of the rollup.
    df = spark.createDataFrame([(*r, 9, "v", 7) for r in rows], "doc_id long, text string, source string, lang string, tokens int, version string, numbers int")
    base = str(tmp_path)
    for batch in ("007", "2024-01-01", "1e3"):
        assert rollup.commit(rollup.signed(rollup.counts(df), 1), base, batch)
        assert not rollup.commit(rollup.signed(rollup.counts(df), 1), base, batch)
    rollup.commit(rollup.signed(rollup.counts(df.limit(0)), 1), base, "empty")
    got = {(r.source, r.lang): (r.docs, r.tokens) for r in rollup.totals(spark, base).where("version = 'words-1'").collect()}
    assert got == {(None, None): (6, 0), ("s", "en"): (6, 600_000), ("s", None): (3, 3)}


def test_rollup_query_with_null_labels(spark, tmp_path):
    docs = [(1, "a b", "en", "s"), (2, "x\nx\ny", "en", "s"), (3, "bad words", "en", "s"), (4, "q\nq", "en", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(1, None, None), (2, 0, None), (3, 0, 1), (3, 1, 0), (4, 1, 0), (None, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.version: (r.docs, r.tokens) for r in QUERIES["op9_token_rollup"](spark, str(tmp_path)).collect()}
    # 3 is gone; 2 is counted as "x, y".
    assert got == {"words-1": (3, 6), "quarters-1": (3, 3)}


def test_toxicity_folds_and_excepts():
    table = toxicity.Fold()
    assert toxicity.folded("1D10T, lоser!", table) == toxicity.folded("idiot loser", table)
    lexicon = toxicity.Lexicon({"idiot": 4.0}, ["idiotic savant"], 1.0)
    automaton = lexicon.automaton()
    assert lexicon.score(lexicon.raw("an IDI0TS text", automaton, table)) > 0.5
    assert lexicon.raw("the idiotic savant", automaton, table) == 0 and lexicon.score(lexicon.raw("", automaton, table)) == 0


def test_toxicity_fit_keeps_every_label(spark):
    """A toxic text beside a clean one with the same smallest word hashes; copies count once."""
    words = spark.range(60).selectExpr("concat('w', id) AS w").selectExpr("w", "xxhash64(w) AS h").orderBy("h").collect()
    shared, others = [r.w for r in words[:3]], [r.w for r in words[3:]]
    texts = [" ".join(shared + others[:20]), " ".join(shared + others[20:40] + others[:1]), " ".join(others)]
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, texts[k % 3]) for k, i in enumerate(ids[:12])] + [(900, None), (None, "lost")]
    told = spark.createDataFrame([(i, 1, int(t == texts[1])) for i, t in rows[:12]] + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    got = {(r.text, r.toxic) for r in toxicity.training_rows(documents(spark, rows), told).collect()}
    assert got == {(texts[0], 0), (texts[1], 1), (texts[2], 0)}
    empty = toxicity.toxicity(documents(spark, rows), told.limit(0))
    assert {r.score for r in empty.collect()} == {0.0} and empty.count() == len(rows)
    assert toxicity.toxicity(documents(spark, rows).limit(0), told).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(40)}w" for _ in range(30)]
        if i % 6 == 0:
            words[rng.randrange(30)] = rng.choice(["vermin", "vermins", "wretched"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 6 == 0)))
    docs = documents(spark, [*rows, (None, None)])
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, told).join(told, "doc_id").where("held_out").collect()
    assert len(got) > 100 and sum(r.predicted == r.toxic for r in got) / len(got) > 0.98
    empty = toxicity.toxicity(docs, told.limit(0)).collect()
    assert len(empty) == 901 and {r.score for r in empty} == {0.0}


@needs_data
def test_pipeline_keeps_what_stages_keep(spark):
    import corpus_pipeline

    docs = read(spark, "documents")
    toxic = {r.doc_id for r in toxicity.toxicity(docs, read(spark, "labels")).where("predicted = 1").collect()}
    stage = [r for r in docs.collect() if r.doc_id not in toxic]
    parts = brute_components([(r.doc_id, r.text) for r in stage])
    stage = [r for r in stage if parts[r.doc_id][1] == r.doc_id]
    dirty = {
        r.doc_id
        for r in decontaminate.contamination(spark.createDataFrame(stage, docs.schema), read(spark, "benchmark")).collect()
    }
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.collect()} == {r.doc_id for r in stage} - dirty
    assert got.columns == [*docs.columns, *bpe.DIGESTS.names]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_copies", "decontamination", "tokens"]


@needs_data
def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES if q != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
