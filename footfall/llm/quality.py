"""Quality rules: a threshold table compiled into one projection (operator 3, native).

Every measure is a column expression over the text; ``RULES`` names a measure and the range
it must lie in, and ``quality`` compiles the table into one boolean per rule and a verdict.
Nothing is shuffled, so a hot source or a group of copies has no effect.

Defined cases: a null or empty text has no words and fails; repeated rows are judged one by
one; other columns of the input (``keep``) are passed through, and an input column whose
name clashes with a result column must be left out of ``keep`` by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import SPACE_CLASS, SPACES, ascii_lower, words

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: Frequent function words of the four languages of the corpus.
STOP_WORDS = [
    "the", "be", "to", "of", "and", "that", "with", "in", "is", "for",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ein", "auf",
    "de", "la", "le", "et", "les", "des", "en", "un", "une", "que",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "para",
]
WINDOW = 8

#: (rule, measure, smallest allowed, largest allowed); None: no bound on that side.
RULES = [
    ("word_count", "n_words", 20, None),
    ("repeated_words_pct", "repeat_pct", None, 30),
    ("mean_word_length", "mean_word_chars", 2, 14),
    ("symbols_per_100_words", "symbol_pct", None, 20),
    ("duplicate_lines_pct", "dup_line_pct", None, 50),
    ("distinct_stop_words", "n_stop_words", 1, None),
    ("upper_case_pct", "upper_pct", None, 60),
]


def _covered(positions: Column, width: int) -> Column:
    """Number of positions covered by windows of ``width`` that start at the sorted ``positions``."""
    step = lambda acc, p: F.struct(
        p.alias("last"), (acc["n"] + F.least(F.lit(width), p - acc["last"])).alias("n"))
    zero = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(positions, zero, step)["n"].cast("long")


def measures(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the measures of ``text``.

    Repeated windows: the hash of every ``WINDOW`` words; only texts whose hashes are not
    all distinct sort them with their positions, so most rows cost one pass.
    """
    keep = ["doc_id"] if keep is None else keep
    held = [F.col(c) for c in keep]
    a = df.select(*held, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    a = a.select(*held, "_text", words(F.col("_text")).alias("_words"),
                 F.filter(F.split("_text", "\n"),
                          lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0).alias("_lines"))
    n_words = F.when(F.get("_words", F.lit(0)) == "", 0).otherwise(F.size("_words"))
    bare = F.regexp_replace("_text", SPACE_CLASS + "+", "")
    a = a.select(
        *held, n_words.cast("long").alias("n_words"),
        F.length(bare).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_intersect(F.split(ascii_lower(F.array_join("_words", " ")), " "),
                                 F.array(*map(F.lit, STOP_WORDS)))).cast("long").alias("n_stop_words"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[A-ZÀ-ÖØ-Þ]", ""))).alias("_upper"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[a-zß-öø-ÿ]", ""))).alias("_lower"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"))
    last = F.size("_hashes") - WINDOW
    window = lambda i: F.xxhash64(*[F.get("_hashes", i + k) for k in range(WINDOW)])
    a = a.withColumn("_windows", F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), window)))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    a = a.withColumn("_sorted", F.when(repeats, F.sort_array(
        F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    same = lambda x, i: ((F.get("_sorted", i - 1)["x"] == x["x"])
                         | F.coalesce(F.get("_sorted", i + 1)["x"] == x["x"], F.lit(False)))
    a = a.withColumn("_at", F.sort_array(F.transform(F.filter("_sorted", same), lambda x: x["i"])))
    # a filter on the measures is not moved below a row number, where it would repeat all of the above
    here = F.monotonically_increasing_id() >= 0
    return a.select(
        *held, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words",
        "_upper", "_lower",
        F.coalesce(F.when(here, _covered(F.col("_at"), WINDOW)), F.lit(0)).cast("long").alias("n_repeat_words"))


def _ratios() -> dict[str, Column]:
    per = lambda a, b: F.coalesce(100.0 * F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    return {
        "n_words": F.col("n_words"),
        "repeat_pct": per("n_repeat_words", "n_words"),
        "mean_word_chars": per("word_chars", "n_words") / 100,
        "symbol_pct": per("n_symbols", "n_words"),
        "dup_line_pct": per("n_dup_lines", "n_lines"),
        "n_stop_words": F.col("n_stop_words"),
        "upper_pct": F.coalesce(100.0 * F.col("_upper") / F.nullif(F.col("_upper") + F.col("_lower"), F.lit(0)),
                                F.lit(0.0)),
    }


def compile_rules(rules=RULES) -> dict[str, Column]:
    """One boolean expression per row of the threshold table."""
    known = _ratios()
    out = {}
    for name, measure, low, high in rules:
        bounds = ([known[measure] >= low] if low is not None else []) + (
            [known[measure] <= high] if high is not None else [])
        out[name] = reduce(lambda a, b: a & b, bounds, F.lit(True))
    return out


def quality(df: DataFrame, text: str = "text", keep: list[str] | None = None, rules=RULES) -> DataFrame:
    """``keep`` columns, the measures, ``failed`` (names of broken rules) and ``kept``."""
    checks = compile_rules(rules)
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(name)) for name, ok in checks.items()]))
    m = measures(df, text, keep).withColumn("failed", failed)
    return m.withColumn("kept", F.size("failed") == 0).drop("_upper", "_lower")


def good(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns.

    The row number that the filter also names keeps the optimiser from copying every measure
    into the filter, level by level.
    """
    held = df.select(F.struct("*").alias("_row"), F.col(text).alias("_content"))
    m = measures(held, "_content", ["_row"]).withColumn("_number", F.monotonically_increasing_id())
    passed = reduce(lambda a, b: a & b, compile_rules(rules).values())
    return m.where(passed & (F.col("_number") >= 0)).select("_row.*")


def op3_quality_rules(spark, sf_dir):
    from footfall.llm.common import table

    q = quality(table(spark, sf_dir, "documents"))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))
