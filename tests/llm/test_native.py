"""Operators 1, 3 and 9: column expressions against plain Python."""

import collections
import hashlib
import re
import struct

import duckdb
import xxhash
from pyspark.sql import functions as F

from footfall.llm import sql
from footfall.llm.fingerprints import add, as_string, fingerprinted, likeness, subtract, with_next
from footfall.llm.line_dedup import remove_boilerplate
from footfall.llm.quality import RULES, compile_rules, good, quality
from footfall.llm.registry import queries
from tests.conftest import SF_SMALL

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _docs(spark, rows, schema="doc_id long, text string, source string"):
    return spark.createDataFrame(rows, schema)


# --- quality rules -----------------------------------------------------------------------

def _repeat_words(words):
    at = collections.defaultdict(list)
    for i in range(len(words) - 7):
        at[tuple(words[i:i + 8])].append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)})


TEXTS = [None, "", "  \n\t ", "one", "a b c d e f g h", "x " * 40, "a b c d e f g h " * 3 + "z", "é #*$ %&|<>\na\na\n \n \nb",
         "the cat sat on the mat and ran off to the hills with a friend in the rain for one more day of fun and joy",
         " ".join(f"w{i % 11}" for i in range(500)), "u\x85v\xa0w", "long" * 50_000]


def test_measures_equal_plain_python(spark):
    got = {r.doc_id: r for r in quality(_docs(spark, [(i, t, "s") for i, t in enumerate(TEXTS)])).collect()}
    for i, t in enumerate(TEXTS):
        t = t or ""
        w, lines = _WORD.findall(t), [x for x in t.split("\n") if _WORD.search(x)]
        r = got[i]
        assert (r.n_words, r.word_chars) == (len(w), sum(map(len, w)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", t))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == _repeat_words(w), t[:40]
    assert got[8].kept and got[8].failed == [] and not got[0].kept


def test_good_rows_keep_their_columns_whatever_their_names(spark):
    df = _docs(spark, [(1, TEXTS[8], "a"), (1, TEXTS[8], "a"), (2, None, None), (None, TEXTS[8], "b")]).withColumns(
        {"n_words": F.lit("x"), "kept": F.lit(7), "_text": F.lit(0)})
    out = good(df)
    assert out.columns == df.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "1", "None"]
    assert good(df.limit(0)).count() == 0 and len(compile_rules()) == len(RULES)


def _oracle(name, spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    rel = con.sql(sql.oracle()[name])
    got = queries()[name](spark, SF_SMALL)
    cols = sorted(got.columns)
    assert sorted(rel.columns) == cols
    want = [tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r[c] for c in cols)) for r in got.collect())


def test_quality_equals_sql(spark):
    _oracle("op3_quality_rules", spark)


# --- line dedup --------------------------------------------------------------------------

def test_line_dedup_equals_sql(spark):
    _oracle("op9_line_dedup", spark)


def test_line_dedup_keeps_the_first_copy_and_other_columns(spark):
    rows = [(i, f"own {i}\nshared line\n\n  \ntwice\ntwice", f"s{i % 12}") for i in range(1, 25)]
    rows += [(30, None, "s1"), (31, "", None), (32, "shared line", None), (32, "shared line", None), (None, "shared line\nx", "z")]
    df = _docs(spark, rows).withColumns({"line": F.lit(1), "row": F.lit(2), "n_removed": F.lit("old")})
    out = remove_boilerplate(df, min_sites=10).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and by[1].line == 1 and by[1].row == 2
    assert by[None].text == "x" and by[None].n_removed == 1  # a null key sorts after all others
    assert by[1].text == rows[0][1] and by[1].n_removed == 0 and by[1].n_lines == 4
    assert by[2].text == "own 2\n\n  " and by[2].n_removed == 3
    assert by[30].text is None and by[31].text == "" and by[32].text == ""
    none = remove_boilerplate(df, min_sites=15)
    assert {r.doc_id: r.text for r in none.collect() if r.doc_id} == {i: t for i, t, _ in rows if i}
    assert remove_boilerplate(df.limit(0)).count() == 0


def test_near_threshold_lines_are_counted_exactly(spark):
    rows = [(i, f"line {k}", f"site {j}") for i, (k, j) in enumerate((k, j) for k in range(30, 70) for j in range(k))]
    out = remove_boilerplate(_docs(spark, rows), min_sites=50, lg_k=4).where("n_removed > 0")
    gone = collections.Counter(rows[r.doc_id][1] for r in out.collect())
    assert gone == {f"line {k}": k - 1 for k in range(50, 70)}


# --- fingerprints ------------------------------------------------------------------------

def test_fingerprint_sums_do_not_depend_on_order_and_can_be_undone(spark):
    rows = [(1, "A a.\nB b.\nC c."), (2, "C c.\nA a.\nB b."), (3, "A a.\nB b."), (4, "C c."), (5, None), (6, ""), (7, "A a.\nA a.\nB b.")]
    fp = fingerprinted(_docs(spark, rows, "id long, text string"), "text")
    s = {r.id: r.s for r in fp.select("id", as_string(F.col("fp")).alias("s")).collect()}
    assert s[1] == s[2] and s[5] == s[6] and len({s[1], s[3], s[4], s[5], s[7]}) == 5
    both = fp.where("id = 3").select(F.col("fp").alias("x")).crossJoin(fp.where("id = 4").select(F.col("fp").alias("y")))
    r = both.select(as_string(add(F.col("x"), F.col("y"))).alias("s"),
                    as_string(subtract(add(F.col("x"), F.col("y")), F.col("y"))).alias("t")).first()
    assert r.s == s[1] and r.t == s[3]


def _plain_fingerprint(text):
    """The sums over the units in plain Python; a unit's hashes chain xxHash64 over a number and the unit."""
    found = [u for u in re.split(r"\n+|(?<=[.!?])[\x20\t]+", text) if u]
    out = [0] * 47
    for u in found:
        p, q, r, s = (xxhash.xxh64_intdigest(u.encode(), xxhash.xxh64_intdigest(struct.pack("<i", k), 42)) for k in range(4))
        for part, h in enumerate((p, q)):
            for i in range(21):
                for at in (0, 21, 42):
                    old = out[part * 21 + i] >> at & (2**20 - 1)
                    new = (old + (h >> i + at & 1)) % 2**20
                    out[part * 21 + i] += (new - old) << at
        for k, h in enumerate((r, r >> 32, s, s >> 32)):
            out[42 + k] = (out[42 + k] + h) % 2**32
    return "".join(f"{x:016x}" for x in [*out[:46], len(found) % 2**32])


def test_fingerprints_equal_plain_sums(spark):
    texts = ["", "One unit", "A a. B b! C c?\nD d.\n\nA a.", "é 中. 🎉 x\ty.  z", " ".join(f"Sentence {i % 7} of many." for i in range(60))]
    got = fingerprinted(_docs(spark, list(enumerate(texts)), "id long, text string"), "text").select("id", as_string(F.col("fp")).alias("s"))
    assert {r.id: r.s for r in got.collect()} == {i: _plain_fingerprint(t) for i, t in enumerate(texts)}


def test_likeness_leaves_other_columns(spark):
    df = fingerprinted(_docs(spark, [(1, "A.", "B.")], "id long, a string, _d string"), "a", "x").withColumn("near", F.lit(7))
    out = likeness(df, {"near": ("x", "x")})
    assert sorted(out.columns) == sorted(df.columns) and out.first()._d == "B." and out.first().near == 1.0


def test_ranges_are_planned_alike_at_any_number_of_partitions(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(3000)], "k long, v string")
    before, sizes = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (8, 2000):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            plan = with_next(df, "k", ["v"])._jdf.queryExecution().analyzed()
            sizes.append(plan.toString().count("("))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sizes[1] <= sizes[0]


def test_likeness_estimates_shared_units(spark):
    part = lambda a, b: " ".join(f"Unit {i} of the text." for i in range(a, b))
    rows = [(0, part(0, 300), part(0, 300)), (1, part(0, 300), part(150, 450)), (2, part(0, 300), part(1000, 1300)), (3, "", ""), (4, "", "x")]
    df = fingerprinted(fingerprinted(_docs(spark, rows, "id long, a string, b string"), "a", "x"), "b", "y")
    got = {r.id: r.near for r in likeness(df, {"near": ("x", "y")}).collect()}
    assert got[0] == 1 and got[3] == 1 and got[4] == 0
    assert abs(got[1] - 0.5) < 0.25 and got[2] < 0.3


def test_next_row_across_ranges(spark):
    ids = [*range(0, 500, 3), -5, 10**12]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "k long, v string").repartition(7)
    down = sorted(ids, reverse=True)
    want = {a: f"t{b}" for a, b in zip(down, down[1:] + down[:1])}
    assert {r.k: r.next.v for r in with_next(df, "k", ["v"]).collect()} == want
    odd = spark.createDataFrame([(None, "n"), (3, "c"), (3, "c"), (1, "a"), (None, "m")], "k long, v string")
    got = sorted((str(r.k), r.v, r.next.v) for r in with_next(odd, "k", ["v"]).collect())
    assert got == [("1", "a", "m"), ("3", "c", "a"), ("3", "c", "c"), ("None", "m", "n"), ("None", "n", "c")]
    assert [r.next.v for r in with_next(odd.where("k = 1"), "k", ["v"]).collect()] == ["a"]
    assert with_next(odd.where("k is null"), "k", ["v"]).count() == 2 and with_next(odd.limit(0), "k", ["v"]).count() == 0


def test_op1_texts(spark):
    rows = {r[0]: r[1] or "" for r in duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()}
    down = sorted(rows, reverse=True)
    after = dict(zip(down, down[1:] + down[:1]))
    got = queries()["op1_fingerprints"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        t, n = rows[r.doc_id], len(rows[r.doc_id])
        edited = t[:n - n // 2] + rows[after[r.doc_id]][:n // 2]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len({r.fingerprint for r in got}) == len(set(rows.values()))


def test_filters_on_the_quality_result_do_not_copy_the_measures(spark):
    """A filter on the verdict or a measure is planned at once and gives the rows of the plain result."""
    q = queries()["op3_quality_rules"](spark, SF_SMALL)
    rows = q.collect()
    for wanted, keep in (("kept", lambda r: r.kept), ("n_repeat_words > 8", lambda r: r.n_repeat_words > 8)):
        some = q.where(wanted)
        assert len(some._jdf.queryExecution().optimizedPlan().toString()) < 60_000
        assert sorted(some.collect()) == sorted(r for r in rows if keep(r))
