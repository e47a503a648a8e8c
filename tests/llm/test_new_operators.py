"""Operators 11 to 13: brute force, the tokenizers library, and round trips."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import filter_audit, sql, token_files
from footfall.llm.filter_audit import audit, failures, measures
from footfall.llm.registry import queries
from footfall.llm.runs import SquareCatcher, collapsed, periodic_runs, recycled, word_runs
from footfall.llm.token_files import fetch, read_dictionary, read_tokens, train, with_starts, write_tokens
from tests.conftest import SF_SMALL

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()


# --- filter audit ------------------------------------------------------------------------

def _plain_counts(t: bytes):
    w = t.split()
    return [len(w), len(set(w)), sum(65 <= c <= 90 for c in t), len(t.decode()), sum(c in b"#$%&*|" for c in t)]


def test_transducer_counts_as_plain_python(monkeypatch):
    random.seed(1)
    signs = ["a", "A", "é", "中", "🎉", " ", "\n", "\t", "\x1c", "\x85", "#", "b" * 70, "b" * 71, "cc", "ccc ", " "]
    for size in (1, 40, 1 << 20):
        monkeypatch.setattr(filter_audit, "SLICE", size)
        for _ in range(150):
            texts = ["".join(random.choices(signs, k=random.randrange(60))).encode() for _ in range(random.randrange(6))]
            assert filter_audit.counts(texts).tolist() == [_plain_counts(t) for t in texts]


def test_words_that_collide_in_the_table_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit.WordTable, "_hash", lambda self, texts, starts, lengths: np.zeros(len(starts), np.uint64))
    text = b" ".join(b"%d" % (i % 37) for i in range(300))
    assert filter_audit.counts([text, b"", text + b" x"]).tolist() == [_plain_counts(t) for t in (text, b"", text + b" x")]


def _plain_audit(docs, labels):
    """Rows of the audit by applying every order of the filters one after the other."""
    good, toxic = ({r[0] for r in labels if r[k] == 1 and r[0] is not None} for k in (1, 2))
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    parts = collections.defaultdict(list)
    for i, t, lang in docs:
        t = t or ""
        w = _WORD.findall(t)
        fails = "".join(c for c, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search(r"[#$%&*|]", t) is not None, i is not None and first[t] < i)) if bad)
        parts[lang or ""].append((i, fails))
    out = set()
    for part, rows in parts.items():
        shapley, found = collections.Counter(), []
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, c in enumerate(order, 1):
                gone = [r for r in left if c in r[1]]
                n_fail = sum(c in f for _, f in rows)
                left = [r for r in left if c not in r[1]]
                shapley[c] += len(gone)
                found.append((part, order, step, len(left), len(gone), n_fail - len(gone), sum(f == c for _, f in rows),
                              sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), c))
        out |= {(*r[:-1], shapley[r[-1]]) for r in found}
    return out


def test_audit_of_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(220))
    docs = [(1, None, None), (2, "", "en"), (3, "", None), (None, "", "en"), (None, long, "en"), (4, long, "en"), (4, long, "en"),
            (5, long, "de"), (5, long + " #", "de"), (6, "AA " * 300, "de"), (7, long, None), (8, "x", ""), (8, "x", ""), (9, "é" * 3, "fr")]
    labels = [(4, 1, 0), (5, 0, 1), (5, None, None), (6, 1, 1), (None, 1, 1), (7, 1, 0), (7, 0, 0), (99, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns(
        {c: F.lit(1) for c in ("part", "n_words", "digest", "good", "n", "copied")})
    marks = spark.createDataFrame(labels, "doc_id long, quality long, toxic long").withColumn("text", F.lit("?"))
    got = audit(failures(df, marks))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) == 4 * 600 and set(rows) == _plain_audit(docs, labels)
    assert audit(failures(df.limit(0), marks)).count() == 0
    assert audit(failures(df, marks.limit(0))).where("good_lost + toxic_lost > 0").count() == 0


def test_audit_over_whole_tables_and_its_sql(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in _documents(spark)]
    labels = [(r.doc_id, r.quality, r.toxic) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()]
    got = queries()["op11_filter_audit"](spark, SF_SMALL)
    rows = {tuple(r) for r in got.collect()}
    assert rows == _plain_audit(docs, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    res = con.execute(sql.OP11)
    assert [d[0] for d in res.description] == got.columns and set(res.fetchall()) == rows


def test_measures_pass_columns_through(spark):
    df = spark.createDataFrame([(1, "a a B#", "x"), (None, None, None)], "doc_id long, text string, lang string")
    got = {r.doc_id: tuple(r)[2:7] for r in measures(df).collect()}
    assert got == {1: (3, 2, 1, 6, 1), None: (0, 0, 0, 0, 0)}


# --- token files -------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    return t


def _ids(library, text, end=2):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_query_equals_the_library(spark, library):
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries()["op12_token_files"](spark, SF_SMALL).collect()}
    start, want = 0, {}
    for r in sorted(_documents(spark), key=lambda r: r.doc_id):
        ids = _ids(library, r.text)
        want[r.doc_id] = start, len(ids), zlib.crc32(ids)
        start += len(ids)
    assert got == want


def test_token_files_of_odd_rows(spark, library, tmp_root):
    rows = [(5, "five"), (None, "none"), (3, None), (3, ""), (5, "five again"), (-7, "<|endoftext|> \n"), (4, "é🎉 中" * 2000), (5, "five")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("id", "ids", "salt", "row")})
    write_tokens(df, f"{tmp_root}/files", TOKENIZER, file_bytes=4000)
    found = with_starts(read_tokens(spark, f"{tmp_root}/files")).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, -7, 3, 3, 4, 5, 5, 5] and len({r.file for r in found}) > 1
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
    assert sorted((str(r.doc_id), tuple(r.ids)) for r in found) == sorted((str(i), tuple(_ids(library, t).tolist())) for i, t in rows)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4")) for r in found)
    some = fetch(spark, f"{tmp_root}/files", [4, 3, 11])
    assert set(some) == {3, 4} and len(some[3]) == 2 and some[4][0].tolist() == _ids(library, rows[6][1]).tolist()
    write_tokens(df.limit(0), f"{tmp_root}/none", TOKENIZER)
    assert with_starts(read_tokens(spark, f"{tmp_root}/none")).count() == 0 and fetch(spark, f"{tmp_root}/none", [1]) == {}


def test_dictionary_is_shared_and_checked(spark, tmp_root):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    write_tokens(docs, f"{tmp_root}/a", TOKENIZER)
    write_tokens(docs.limit(3), f"{tmp_root}/b", TOKENIZER)
    one, other = read_dictionary(spark, f"{tmp_root}/a"), read_dictionary(spark, f"{tmp_root}/b")
    assert one != other and train([]) == b"" and len(train([b"ab" * 400])) == 800
    with pytest.raises(Exception, match="another dictionary"):
        from footfall.llm import token_files
        token_files._width_of(token_files.struct.pack(token_files._HEADER, token_files.MAGIC, 2, hashlib.sha256(one).digest()), other)


def test_texts_do_not_move_between_tasks(spark, library, tmp_root, monkeypatch):
    taken, held = [], token_files.map_batches
    monkeypatch.setattr(token_files, "map_batches", lambda df, run, schema: taken.append(df) or held(df, run, schema))
    rows = [(i, f"{i % 7} text " * (i % 50)) for i in range(3000)]
    write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), f"{tmp_root}/moved", TOKENIZER, file_bytes=100_000)
    dealt = [df.columns for df in taken if "RepartitionByExpression" in df._jdf.queryExecution().analyzed().toString() and "frame" in df.columns]
    assert dealt == [["id", "n", "frame"]]
    found = with_starts(read_tokens(spark, f"{tmp_root}/moved")).orderBy("doc_id").collect()
    assert len({r.file for r in found}) > 3 and [(r.doc_id, list(r.ids)) for r in found] == [(i, _ids(library, t).tolist()) for i, t in rows]
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()


def test_rows_left_for_the_dictionary_do_not_grow_with_the_table(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SAMPLE_ROWS", 200)
    for n in (0, 1, 399, 4000, 40000):
        d = spark.range(n).select("id", F.concat(F.lit("text "), "id").alias("text"))
        left = token_files.candidates(d, n)
        assert min(n, 200) <= left.count() < 600
        least = [r.id for r in d.orderBy(F.xxhash64(F.lit(7), "id", "text"), "id").limit(200).collect()]
        assert [r.id for r in left.orderBy("chance", "id").limit(200).collect()] == least


# --- periodic runs -----------------------------------------------------------------------

def _plain_runs(w, least=12):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        same, i = [w[i] == w[i + q] for i in range(n - q)] + [False], 0
        while i < len(same):
            j = i
            while same[j]:
                j += 1
            s = w[i:j + q]
            if len(s) >= max(least, 2 * q) and j > i and not any(s[p:] == s[:-p] for p in range(1, q)):
                out.append((i, len(s), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force_however_appended():
    random.seed(3)
    for _ in range(600):
        w = [b"%d" % random.randrange(random.choice([1, 2, 2, 3, 5])) for _ in range(random.randrange(90))]
        w = recycled(random.randrange(1000), w) if random.random() < 0.5 else w
        least = random.choice([2, 12])
        want = _plain_runs(w, least)
        assert all([tuple(r) for r in word_runs(w, least, step).tolist()] == want for step in (1, 7, 1000))


def test_runs_are_reported_while_the_text_grows():
    text = [1, 2, 3] * 5 + [9] + [4, 5] * 8
    catcher, seen = SquareCatcher(), []
    for x in text:
        catcher.append(np.array([x]))
        seen.append(len(catcher.runs()))
    assert seen.index(1) == 11 and seen.index(2) == 15 + 12 and catcher.runs().tolist() == [[0, 15, 3], [16, 16, 2]]


def test_collapsed_words_keep_the_first_period():
    w = b"a b c a b c a b c a b c d e".split()
    assert collapsed(w, np.array([[0, 12, 3]])) == b"a b c d e".split()
    nested = b"x".split() * 20 + [b"y"] + b"x".split() * 20 + [b"y"]
    runs = word_runs(nested)
    assert [tuple(r) for r in runs.tolist()] == _plain_runs(nested) == [(0, 20, 1), (0, 42, 21), (21, 20, 1)]
    assert collapsed(nested, runs) == [b"x", b"y"]


def _plain_row(doc_id, text):
    w = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = _plain_runs(w)
    gone = {k for s, l, q in runs for k in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
            sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_equals_brute_force(spark):
    docs = [r for r in _documents(spark) if len((r.text or "").split()) < 700]
    got = {r.doc_id: tuple(r)[1:] for r in queries()["op13_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert any(r[0] for r in got.values())
    for r in docs:
        assert got[r.doc_id] == _plain_row(r.doc_id, r.text), r.doc_id


def test_runs_of_odd_rows(spark, monkeypatch):
    rows = [(1, None), (None, "x " * 30), (2, ""), (2, " \n"), (3, "é 中 " * 10), (3, "é 中 " * 10), (4, "z" * 10**6 + " a" * 70_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("_content", "runs", "collapsed")})
    got = sorted(periodic_runs(df).collect(), key=str)
    assert [(r.doc_id, r.n_words, [tuple(x) for x in r.runs]) for r in got] == [
        (1, 0, []), (2, 0, []), (2, 0, []), (3, 20, [(0, 20, 2)]), (3, 20, [(0, 20, 2)]), (4, 70_001, [(1, 70_000, 1)]), (None, 30, [(0, 30, 1)])]
    assert [r.collapsed for r in got if r.doc_id == 3] == ["é 中"] * 2
    assert periodic_runs(df.limit(0)).count() == 0 and recycled(None, [b"x"]) == [b"x"]
    assert periodic_runs(df.select("doc_id", "text", F.lit("k").alias("tag")), keep=("tag",)).where("tag = 'k'").count() == len(rows)
