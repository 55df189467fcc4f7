"""Periodic runs, fill-in-middle and packing against brute force and exact round trips."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from tokenizers import Tokenizer

from loanloom.llm import fim, packing, periodic
from loanloom.llm.queries import QUERIES, byte_tokenizer, period_digests
from conftest import TESTDATA

SF = str(TESTDATA / "sf0.001")
needs_data = pytest.mark.skipif(not TESTDATA.exists(), reason="test tables not present")
WORD = re.compile("[^ \t-\r]+")
# Extra columns carry names the operators use themselves.
DOC = "doc_id long, text string, runs string, ids int, offset int, output string, n long, form string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "r", 1, 2, "o", 3, "f") for i, t in rows], DOC)


EDGES = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (4, "three"), (None, "one two"), (None, None), (6, "x" * 300_000), (7, "ab " * 60_000)]


def naive_runs(words, min_length=24, exponent=3):
    """Every stretch of every period, by definition."""
    out = []
    for q in range(1, len(words) // exponent + 1):
        equal = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            if not same and start is not None:
                length = i - start + q
                own = words[start : start + length]
                smaller = any(own[r:] == own[:-r] for r in range(1, q))
                if length >= max(min_length, exponent * q) and not smaller:
                    out.append((start, length, q))
                start = None
    return sorted(out)


def periodic_words(rng):
    words = []
    for _ in range(rng.randrange(1, 5)):
        q = rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31])
        block = [f"w{rng.randrange(rng.choice([1, 2, 40]))}" for _ in range(q)]
        words += (block * 40)[: rng.randrange(1, 7 * q + 30)]
    return words * rng.choice([1, 1, 1, 3])


@pytest.mark.parametrize("min_length, exponent", [(24, 3), (1, 3), (9, 4), (70, 5)])
def test_runs_equal_the_definition(min_length, exponent):
    rng = random.Random(min_length)
    found = 0
    for _ in range(60):
        words = periodic_words(rng)
        numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
        got = periodic.runs_of(np.array([numbers[w] for w in words]), min_length, exponent)
        assert got == naive_runs(words, min_length, exponent)
        found += len(got)
    assert found > 30


def test_transform_convolves_and_inverts():
    rng = np.random.default_rng(3)
    for size in (1, 2, 16, 128):
        rows = rng.integers(0, periodic.PRIME, (3, size)).astype(np.uint64)
        assert (periodic.inverse_ntt(periodic.ntt(rows)) == rows).all()
    blocks = rng.integers(0, 2**30, (4, 8)).astype(np.uint64)
    windows = rng.integers(0, 2**30, (4, 15)).astype(np.uint64)
    windows[1, 3:11] = blocks[1]
    got = periodic.mismatches(blocks, windows)
    want = [[sum((int(a) - int(c)) ** 2 for a, c in zip(b, w[k : k + 8])) % periodic.PRIME for k in range(8)] for b, w in zip(blocks, windows)]
    assert got.tolist() == want and got[1, 3] == 0


def test_long_period_and_long_text():
    rng = random.Random(2)
    block = [rng.randrange(10**6) for _ in range(5000)]
    codes = np.array([7] * 100 + block * 3 + [8, 9])
    assert periodic.runs_of(codes) == [(0, 100, 1), (100, 15000, 5000)]
    assert periodic.runs_of(np.arange(50_000) % 3) == [(0, 50_000, 3)]


def test_run_rows(spark):
    rows = [*EDGES, (8, "intro " + "a b c " * 20 + "end"), (9, "x " * 23), (10, "x " * 24), (11, "p q " * 12 + "p r " * 12)]
    got = periodic.periodic_runs(documents(spark, rows))
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"] and got.count() == len(rows)
    one = {r.doc_id: r for r in got.where("doc_id > 5 OR doc_id < 4").collect()}
    assert [tuple(r) for r in one[8].runs] == [(1, 60, 3)] and one[8].collapsed == "intro a b c end"
    assert one[9].runs == [] and [tuple(r) for r in one[10].runs] == [(0, 24, 1)] and one[10].collapsed == "x"
    assert [tuple(r) for r in one[11].runs] == [(0, 25, 2), (24, 24, 2)]
    assert one[11].collapsed == "p q r"
    assert all((one[i].n_words, one[i].runs, one[i].collapsed) == (0, [], "") for i in (1, 2, 3))
    assert one[6].n_words == 1 and [tuple(r) for r in one[7].runs] == [(0, 60_000, 1)]
    assert periodic.periodic_runs(documents(spark, rows).limit(0)).count() == 0


def naive_digest(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    runs = naive_runs(words)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in drop)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    told = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (told, kept)]
    return (doc_id, len(runs), *(top or (None,) * 3), top and 1000 * top[1] // top[2], *sha)


def test_run_digests(spark):
    rng = random.Random(8)
    rows = [(i, " \t".join(periodic_words(rng)[:500])) for i in range(80)] + [(80, None), (81, ""), (None, "a " * 50)]
    found = period_digests(documents(spark, rows))
    got = {tuple(r) for r in found.where("doc_id IS NOT NULL").collect()}
    assert got == {naive_digest(i, t) for i, t in rows if i is not None}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i in range(80)) > 3


@needs_data
def test_run_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert set(got) == set(docs)
    short = [i for i, t in docs.items() if len(WORD.findall(t or "")) < 700]
    assert len(short) > 50 and all(got[i] == naive_digest(i, docs[i]) for i in short)


UNIT = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")


def test_boundaries_equal_the_pattern():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab é\n\t中😀 ​") for _ in range(rng.randrange(0, 150))) for _ in range(300)]
    for text in [*texts, "", " ", "a", "ab" * 100, " " * 70, "x\x0b\x0cy\x85z "]:
        units = UNIT.findall(text)
        marks = fim.Boundaries(text)
        assert marks.units == len(units)
        assert [marks.after(k) for k in range(len(units) + 1)] == [len("".join(units[:k])) for k in range(len(units) + 1)]
        assert fim.Boundaries(text, "char").after(len(text) // 2) == len(text) // 2


def test_classes_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = "ab  c\n" * 50 + " "
    whole = fim.classes(text)
    monkeypatch.setattr(fim, "CHUNK", 7)
    assert (fim.classes(text) == whole).all() and whole[-1] == fim.TEXT_END


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 8, size).astype(np.uint8)
        matrix = fim.WaveletMatrix(symbols, 3)
        for upto in {0, size // 3, size}:
            assert [matrix.rank(c, upto) for c in range(8)] == [int((symbols[:upto] == c).sum()) for c in range(8)]


def test_fill_in_middle(spark):
    rows = [*EDGES, *[(100 + i, f"some words {i} < P>\n with 中文 and tails " * 3) for i in range(200)], (8, "a <P> b"), (9, "x<M>"), (10, "<S>")]
    got = fim.fill_in_middle(documents(spark, rows))
    back = got.selectExpr("*", f"{fim.restored()} AS back").collect()
    assert len(back) == len(rows)
    texts = {i: t or "" for i, t in rows if i is not None and i != 4}
    for r in back:
        if r.doc_id in texts:
            assert r.back == texts[r.doc_id] and r.n == len(UNIT.findall(r.back))
        assert (r.form == "plain") == (r.prefix_chars is None) == (r.middle_chars is None)
        if r.form != "plain":
            first, second, third = re.split("<P>|<S>|<M>", r.output)[1:]
            prefix, middle = (first, third) if r.form == "psm" else (second, third)
            assert (len(prefix), len(middle)) == (r.prefix_chars, r.middle_chars)
    forms = [r.form for r in back]
    assert {r.form for r in back if r.doc_id in (1, 2, 8, 9, 10)} == {"plain"}
    assert forms.count("spm") > 50 and forms.count("psm") > 5 and forms.count("plain") > 60
    assert fim.fill_in_middle(documents(spark, rows).limit(0)).count() == 0
    assert {r.form for r in fim.fill_in_middle(documents(spark, rows), percent=0).collect()} == {"plain"}


def test_plans_cover_every_token_once():
    rng = random.Random(6)
    for size in (2048, 64, 1):
        for _ in range(150):
            lengths = [rng.choice([1, size, 2 * size, rng.randrange(1, size + 1), rng.randrange(1, 5 * size + 1)]) for _ in range(rng.randrange(0, 40))]
            parts = {}
            for pieces in packing.plan(lengths, size):
                total = sum(p[2] for p in pieces)
                assert total == size or total < size and total & (total - 1) == 0
                for doc, start, length in pieces:
                    parts.setdefault(doc, []).append((start, length))
            for doc, n in enumerate(lengths):
                at = 0
                for start, length in sorted(parts[doc]):
                    assert start == at and length > 0
                    at += length
                assert at == n


def test_rests_that_fit_are_not_cut():
    """First fit decreasing, by the definition, where nothing has to be closed."""
    lengths = [60, 50, 40, 30, 10, 10, 100, 200]
    got = sorted(sorted(doc for doc, _, _ in pieces) for pieces in packing.plan(lengths, 100))
    assert got == [[0, 2], [1, 3, 4, 5], [6], [7], [7]]
    room = packing.Room(5, 10)
    free, firsts = [10] * 5, []
    for need in (7, 7, 3, 4, 2, 3, 6, 1):
        want = next(i for i, f in enumerate(free) if f >= need)
        free[want] -= need
        firsts.append(room.first_with(need) == want)
    assert all(firsts)


TRICKY = [
    "<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "it's we'll I'M don't", "  two  blanks \n\n\t x", "é中文😀 ½ ①٣", "a b c\x85d",
    "0123456789 " * 50, "!?" * 3000, " " * 5000 + "x", "\x00\x01\x7f",
]


def test_byte_tokens_equal_the_library():
    path, pattern = byte_tokenizer()
    known, whole = packing.ByteTokens(path, pattern), Tokenizer.from_file(path)
    rng = random.Random(5)
    letters = [chr(c) for c in (*range(32, 127), 9, 10, 13, 0xA0, 0xE9, 0x300, 0x661, 0x2028, 0x3000, 0x4E2D, 0x1F600, 0x1D7D8, 0x378)]
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randrange(80))) for _ in range(500)]
    for text in [*TRICKY, *mixed, "", "x" * 250_000, " " * 250_000]:
        assert list(known.ids(text)) == whole.encode(text, add_special_tokens=False).ids


def test_packed_rows(spark):
    path, pattern = byte_tokenizer()
    whole = Tokenizer.from_file(path)
    rows = [*EDGES, *[(20 + i, t) for i, t in enumerate(TRICKY)], *[(100 + i, "some words and more " * (i % 90)) for i in range(300)]]
    rows += [(5, "same row")] * 40
    for group_bytes in (packing.GROUP_BYTES, 20_000):
        pieces = packing.packed(documents(spark, rows), path, pattern, group_bytes=group_bytes).collect()
        sequences, docs = {}, {}
        for p in pieces:
            assert len(p.ids) == 4 * p.length
            sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
            docs.setdefault(p.doc_id, []).append(p)
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at == 2048 or at < 2048 and at & (at - 1) == 0
        texts = {}
        for i, t in rows:
            texts.setdefault(i, []).append([*whole.encode(t or "", add_special_tokens=False).ids, 1])
        assert sum(p.length for p in pieces) == sum(len(ids) for all_ids in texts.values() for ids in all_ids)
        for i, all_ids in texts.items():
            assert sorted({p.doc_tokens for p in docs[i]}) == sorted({len(ids) for ids in all_ids})
            if len(all_ids) == 1:
                told = sorted((p.start, list(np.frombuffer(p.ids, "<u4"))) for p in docs[i])
                assert [x for _, ids in told for x in ids] == all_ids[0]
                assert [s for s, _ in told] == list(np.cumsum([0] + [len(ids) for _, ids in told])[:-1])
        # Copies of one row are dealt over the groups too.
        if group_bytes == 20_000:
            assert len({p.sequence_id >> packing.GROUP_SHIFT for p in docs[5]}) > 5
    assert packing.packed(documents(spark, rows).limit(0), path, pattern).count() == 0


def test_sequences_join_their_pieces(spark):
    path, pattern = byte_tokenizer()
    pieces = packing.packed(documents(spark, [(i, "some words " * i) for i in range(60)]), path, pattern, size=64)
    got = packing.sequences(pieces).collect()
    assert sum(r.n_tokens for r in got) == pieces.selectExpr("sum(length)").first()[0]
    assert all(len(r.ids) == 4 * r.n_tokens == 4 * sum(d.length for d in r.documents) for r in got)


@needs_data
def test_packing_query(spark):
    path, _ = byte_tokenizer()
    whole = Tokenizer.from_file(path)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_packing"](spark, SF).collect()
    held = {}
    for r in got:
        held.setdefault(r.doc_id, []).append(r)
    assert set(held) == set(docs)
    for i, parts in held.items():
        ids = np.array([*whole.encode(docs[i] or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 and p.doc_tokens == len(ids) for p in parts)
        assert sum(p.length for p in parts) == len(ids)
