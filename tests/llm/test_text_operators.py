"""Operators 4, 6, 8 and 10: round trips and the libraries' own results."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from footfall.llm import html_text
from footfall.llm.bpe import Codec, decode, digests, encode, merge, read_ranks
from footfall.llm.html_text import extract, main_text
from footfall.llm.packing import CAPACITY, FirstFit, pack, pack_documents, pieces
from footfall.llm.registry import queries
from footfall.llm.warc import Archive, assemble, read_archive, write_archive
from tests.conftest import SF_SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def own():
    with open(RANKS, "rb") as f:
        return Codec(read_ranks(f.read()))


def _ids(library, text):
    return np.array(library.encode_ordinary(text), "<u4").tobytes()


# --- byte-level BPE ----------------------------------------------------------------------

def test_random_texts_encode_as_the_library_does(library, own):
    random.seed(5)
    signs = list(" \n\t'  'strevmlldSTRE12ab,.!  éß中文١٢'̀\x00\x1c\x85🎉 ")
    texts = ["".join(random.choices(signs, k=random.randrange(40))) for _ in range(5000)] + ["", "\0", "<|endoftext|>"]
    got = own.encode(texts)
    assert got == [_ids(library, t) for t in texts]
    assert [own.decode(i).decode() for i in got] == texts


def test_every_code_point_is_classified_as_the_pattern_does(library, own):
    texts = [f"a{c}1{c}.{c} {c}" for c in (chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000)]
    assert own.encode(texts) == [_ids(library, t) for t in texts]


def test_long_pieces_and_offsets(library, own):
    long = "x" * 3000 + "!?" * 3000 + " " * 2000 + "é" * 2000
    ids = own.encode([long])[0]
    assert ids == _ids(library, long)
    at = own.offsets(ids)
    tokens = [own.tokens[i] for i in np.frombuffer(ids, "<u4")]
    assert all(long.encode()[a:a + len(t)] == t for a, t in zip(at, tokens))
    assert merge(b"abc", {b"a": 0, b"b": 1, b"c": 2, b"bc": 3}) == [0, 3]


def test_cache_generations_do_not_change_results(library, monkeypatch):
    monkeypatch.setattr("footfall.llm.bpe.CACHE_PIECES", 7)
    with open(RANKS, "rb") as f:
        small = Codec(read_ranks(f.read()))
    texts = [" ".join(f"w{random.randrange(30)}" for _ in range(50)) for _ in range(20)]
    assert small.encode(texts) == [_ids(library, t) for t in texts]


def test_encode_decode_frames(spark):
    df = spark.createDataFrame([(1, "Hello there", 5), (2, None, 6), (2, "", 6), (None, "é", 7)], "doc_id long, text string, ids int")
    enc = encode(df, RANKS, with_offsets=True)
    out = decode(enc, RANKS).collect()
    assert sorted(r.decoded.decode() for r in out) == ["", "", "Hello there", "é"]
    assert digests(df.limit(0), RANKS).count() == 0
    d = {r.n_tokens for r in digests(df, RANKS).collect()}
    assert 0 in d


def test_op10_equals_the_library(spark, library):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries()["op10_byte_bpe"](spark, SF_SMALL).collect():
        ids = _ids(library, rows[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].encode()).hexdigest()


# --- packing -----------------------------------------------------------------------------

def test_first_fit_equals_the_plain_search():
    random.seed(2)
    lengths = sorted((random.randrange(1, 101) for _ in range(300)), reverse=True)
    tree, bins = FirstFit(len(lengths), 100), []
    for n in lengths:
        k = next((i for i, room in enumerate(bins) if room >= n), len(bins))
        if k == len(bins):
            bins.append(100)
        assert tree.place(n) == (k, bins[k])
        bins[k] -= n


def _check_packed(rows, want):
    """Each id in exactly one piece; pieces fill their sequences without gaps."""
    docs, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(docs) == set(want)
    for k, parts in docs.items():
        ids = want[k]
        at = 0
        for start, length, crc, total in sorted(parts):
            assert start == at and total == len(ids) and crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return sum(1 - sum(n for _, n in p) / CAPACITY for p in seqs.values()) / len(seqs)


def test_op6_packs_the_tokenizers_ids(spark):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    want = {k: t.encode(x, add_special_tokens=False).ids + [1] for k, x in rows.items()}
    assert _check_packed(queries()["op6_packing"](spark, SF_SMALL).collect(), want) < 0.03


def test_packing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "word " * 5000, 3)], "doc_id long, text string, offset long")
    _check_packed(pack_documents(df, RANKS).collect(), {1: [1], 2: [1], 3: _word_ids()})
    same = pack_documents(df.limit(1).unionByName(df.limit(1)), RANKS).collect()
    assert len(same) == 2 and len({(r.sequence_id, r.offset) for r in same}) == 2
    assert pack_documents(df.limit(0), RANKS).count() == 0
    assert pieces(df, RANKS, with_ids=True).where("size(ids) != length").count() == 0
    many = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit(0).alias("start"), F.lit(1024).alias("length"))
    assert pack(many).groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0


def _word_ids():
    with open(RANKS, "rb") as f:
        return [*np.frombuffer(Codec(read_ranks(f.read())).encode(["word " * 5000])[0], "<u4").tolist(), 1]


# --- main text ---------------------------------------------------------------------------

PARAGRAPH = "This is a sentence of the article, with commas, and enough words to count as prose."


def test_article_without_the_page_around_it():
    page = f"""<html><head><title>No</title><style>p{{x}}</style></head><body><header>Top</header><nav><a href=/>Menu</a></nav>
    <div class="cookie-notice">We use cookies, really.</div><div id=sidebar><p>{PARAGRAPH} side</p></div>
    <div><h1>Head &amp; line</h1><p>{PARAGRAPH}</p><p>Short.<p>{PARAGRAPH}<br>next <a href=x>a link</a> &#233;&nbsp;x</div>
    <section id="comments"><p>{PARAGRAPH} comment</p></section><form><p>{PARAGRAPH} form</p></form>
    <script>var a = "<p>{PARAGRAPH}</p>";</script><footer>&copy; x</footer></body></html>"""
    assert main_text(page) == f"Head & line\n{PARAGRAPH}\nShort.\n{PARAGRAPH} next a link é x"


def test_article_element_is_kept_whole():
    page = f"<body><div><p>{PARAGRAPH}</p></div><article><h2>T</h2><section><p>{PARAGRAPH}</p></section><ul><li>One<li>Two</ul><p>x</p></article></body>"
    assert main_text(page) == f"T\n{PARAGRAPH}\nOne\nTwo\nx"


def test_points_choose_before_article_elements():
    story = "".join(f"<p>{PARAGRAPH} part {k}</p>" for k in range(7))
    teaser = "".join(f"<p>{PARAGRAPH} teaser {k}</p>" for k in range(3))
    whole = "\n".join(f"{PARAGRAPH} part {k}" for k in range(7))
    assert main_text(f"<body><div><div id=a>{story}</div></div><div><article>{teaser}</article></div></body>") == whole
    parts = "".join(f"<article><p>{PARAGRAPH} part {k}</p></article>" for k in range(7))
    assert main_text(f"<body><div>{parts}</div></body>") == whole  # a story in several articles
    two = f"<article><p>{PARAGRAPH} one</p><p>{PARAGRAPH}</p></article><article><p>{PARAGRAPH} two</p></article>"
    assert main_text(f"<body><section>{two}</section></body>") == f"{PARAGRAPH} one\n{PARAGRAPH}\n{PARAGRAPH} two"
    assert main_text(f"<body><main><div>{story}</div><p>x</p></main><div><p>{PARAGRAPH}</p></div></body>") == f"{whole}\nx"
    assert main_text(f"<body><main><div>{story}</div><article><a href=x>{PARAGRAPH}</a></article></main></body>") == whole


def test_broken_and_empty_pages():
    assert main_text(None) == main_text("") == main_text("<p>") == main_text("<!-- x") == ""
    assert main_text("a < b and c") == "a < b and c"
    assert main_text("<nav>menu</nav>") == "" and main_text("<div>one</p>two<b>three") == "one two three".replace(" ", "")
    assert main_text("<p title='a > b'>x</p><p title='open>y") == "x\ny"
    deep = "<div>" * 5000 + PARAGRAPH + "</div>" * 5000
    assert main_text(deep) == PARAGRAPH
    assert main_text("<svg><p>x</svg><p>y") == "y"


def test_op8_takes_the_article_of_every_page(spark):
    import html
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries()["op8_html_text"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", " " if "br" in x else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_class_words_are_evidence_only():
    other = PARAGRAPH.replace(",", ";")
    page = (f'<body><div class="story"><p class="notice-of-death">{PARAGRAPH}</p><p id="share-of-market-2020">{other}</p>'
            '<div class="ad">Buy, buy, buy this now, it is cheap</div><div class="ad-box-2"><p>Buy more, and more</p></div>'
            '<div class="comments-by-readers"><a href="/1">first</a> <a href="/2">second</a></div></div>'
            f'<div class="related-to-this"><p>{PARAGRAPH} elsewhere</p></div><ul class="adList"><li>buy</li></ul></body>')
    assert main_text(page) == f"{PARAGRAPH}\n{other}"
    for around in ("main", "article", "section"):
        assert main_text(f'<body><nav>x</nav><{around}><p class="menu-of-the-day">{PARAGRAPH}</p><p>{other}</p></{around}></body>') == f"{PARAGRAPH}\n{other}"
    assert main_text(f'<main><p class=ads/>{other}</p><div data-x=/a/><p>{PARAGRAPH}</p></div><p>{other}</p></main>') == f"{PARAGRAPH}\n{other}"


def test_extract_frame(spark):
    df = spark.createDataFrame([(1, f"<p>{PARAGRAPH}</p>", "old"), (None, None, None)], "page_id long, html string, text string")
    out = {r.page_id: (r.text, r.n_chars) for r in extract(df).collect()}
    assert out == {1: (PARAGRAPH, len(PARAGRAPH)), None: ("", 0)} and extract(df.limit(0)).count() == 0
    assert html_text._blocks([html_text.parse("<p>a<p>b")]) == ["a", "b"]


# --- WARC --------------------------------------------------------------------------------

ODD = ["x" * 200, "x" * 200, "a\r\n\r\nb" * 40, "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 5, "ends\r\n", "\r\n", "", None, "small", "small",
       "é" * 60, "é" * 60 + "\r\n"]


def test_archive_round_trip(spark, tmp_root):
    rows = [(i, f"http://h/{i}" if i % 5 else None, t) for i, t in enumerate(ODD)] + [(100, "http://h/\r\nX: y", "x" * 200)]
    path = f"{tmp_root}/warc"
    write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    rec = read_archive(spark, path)
    assert rec.where("malformed").count() == 0 and rec.count() == 3 * len(rows)
    got = {}
    for r in assemble(rec).collect():
        page = int(bytes(r.metadata.payload).decode().split(":")[1])
        got[page] = r
        assert r.request.concurrent_to == [r.capture_id] and r.request.type == "request"
    assert len(got) == len(rows)
    for i, url, t in rows:
        raw, r = (t or "").encode(), got[i].response
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert r.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
        assert r.type == ("revisit" if i in (1, 100) else "response")
        if r.type == "response":
            assert bytes(r.payload) == raw
        else:
            assert r.refers_to == got[0].capture_id
    assert read_archive(spark, path, with_payload=False).where("type = 'response' and payload is not null").count() == 0


def test_links_in_other_directions_and_broken_records(spark):
    rec = lambda i, t, to: (i, t, "u", "d", to, None, {}, {}, None, 0, "x", False)
    from footfall.llm.warc import RECORD
    rows = [rec("r1", "response", ["q1"]), rec("q1", "request", []), rec("m1", "metadata", ["q1"]), rec("r2", "response", []),
            rec("q2", "request", ["r2"]), rec("m2", "metadata", ["q2"]), rec("m9", "metadata", ["nowhere"]),
            (None, None, None, None, [], None, {}, {}, None, 0, None, True)]
    out = {r.capture_id: r for r in assemble(spark.createDataFrame(rows, RECORD)).collect()}
    assert {k: (r.response and r.response.record_id, r.request and r.request.record_id, r.metadata and r.metadata.record_id)
            for k, r in out.items()} == {"r1": ("r1", "q1", "m1"), "r2": ("r2", "q2", "m2"), "m9": (None, None, "m9")}
    a = Archive()
    found = [*a.feed(b"junk\r\n\r\nWARC/1.0\r\nContent-Length: 2\r\n\r\nab\r\n\r\nWARC/1.0\r\nContent-"), *a.rest()]
    assert [(b, bad) for _, b, bad in found] == [(b"junk", True), (b"ab", False), (b"WARC/1.0\r\nContent-", True)]


def test_all_records_of_a_capture_are_kept(spark):
    rec = lambda i, t, to: (i, t, "u", "d", to, None, {}, {}, None, 0, "x", False)
    from footfall.llm.warc import RECORD
    rows = [rec("r1", "response", []), rec("m2", "metadata", ["r1"]), rec("m1", "metadata", ["r1"]), rec("q1", "request", ["r1"]),
            rec("q2", "request", ["r1"]), rec("c1", "conversion", ["r1"])]
    r, = assemble(spark.createDataFrame(rows, RECORD)).collect()
    assert (r.metadata.record_id, r.request.record_id) == ("m1", "q1")
    assert [(x.record_id, x.type) for x in r.records] == [("c1", "conversion"), ("m1", "metadata"), ("m2", "metadata"), ("q1", "request"), ("q2", "request")]


def test_plain_files_are_read_whole(spark, tmp_root):
    import gzip
    import os
    write_archive(spark.createDataFrame([(i, None, ODD[3] * 3000) for i in range(4)], "page_id long, url string, html string").coalesce(1), f"{tmp_root}/a")
    os.makedirs(f"{tmp_root}/b")
    for name in os.listdir(f"{tmp_root}/a"):
        if name.startswith("part") and name.endswith(".gz"):
            with gzip.open(f"{tmp_root}/a/{name}") as f, open(f"{tmp_root}/b/{name[:-3]}", "wb") as g:
                g.write(f.read())
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        key = lambda p: sorted((r.record_id, r.payload_digest, r.malformed) for r in read_archive(spark, p).collect())
        assert key(f"{tmp_root}/a") == key(f"{tmp_root}/b") and len(key(f"{tmp_root}/b")) == 12
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_op4_pages(spark):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    first = {}
    for k in sorted(pages):
        first.setdefault(pages[k], k)
    got = {r.page_id: r for r in queries()["op4_warc"](spark, SF_SMALL).collect()}
    assert set(got) == set(pages)
    for k, raw in pages.items():
        again = len(raw) >= 100 and first[raw] != k
        assert (got[k].payload_bytes, got[k].payload_digest) == (len(raw), hashlib.sha256(raw).hexdigest())
        assert (got[k].record_type, got[k].refers_to) == (("revisit", first[raw]) if again else ("response", None))


def test_empty_archive(spark, tmp_root):
    write_archive(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_root}/none")
    assert read_archive(spark, f"{tmp_root}/none").count() == 0
