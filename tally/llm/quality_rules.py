"""Line-first cleaning: rules per line, failing lines go, documents that lose too much text go.

Every expression is a built-in DataFrame function (no Python on the executors).  Each
document is handled inside its own row: no shuffle, no join.

Cases: null text counts as an empty text (no words, so it fails the base rules).  Empty
and blank lines are never judged and stay.  Repeated rows are judged one by one, alike.
Extra columns pass through; result columns that clash with an input column replace it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.llm.common import SPACE_CHARS, set_aside, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Phrases that mark a short line as boilerplate (matched without regard to case).
BOILERPLATE = (
    "all rights reserved", "copyright (c)", "copyright ©", "cookie policy", "accept cookies", "we use cookies",
    "privacy policy", "terms of use", "terms of service", "terms and conditions", "subscribe to our", "sign up for",
    "log in to", "enable javascript", "click here", "read more", "share on", "follow us",
)
# A word made of separators only, as between the entries of a menu.
SEPARATORS = "|»›•·>/\\-"
SEPARATOR_WORD = "(?<![^\\x20\\x09-\\x0D])[|»›•·>/\\\\-]+(?![^\\x20\\x09-\\x0D])"


@dataclass(frozen=True)
class Rules:
    min_words: int = 10
    max_repeat_percent: int = 20
    punctuation_min_words: int = 8      # a line this long must have a sentence mark somewhere
    navigation_min_separators: int = 2
    navigation_words_per_separator: int = 4
    symbol_percent: int = 50            # symbols per 100 words that a line may have
    shout_min_words: int = 3
    boilerplate_max_words: int = 30
    max_loss_percent: int = 50          # words a document may lose


def removed(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def line_facts(line: Column, rules: Rules) -> Column:
    """What the rules need to know of a line, computed once for each line."""
    n = F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.struct(
        line.alias("line"), n.alias("n"),
        (F.length(line) - F.length(removed(line, SYMBOLS))).alias("symbols"),
        (F.length(line) - F.length(removed(line, SEPARATORS))).alias("separators"),
        F.lower(line).alias("lower"))


def line_fails(x: Column, rules: Rules) -> Column:
    """The first rule that a line (as `line_facts`) breaks, or null.  Plain tests come before the regular expressions."""
    line, n = x["line"], x["n"]
    separator_words = F.regexp_count(line, F.lit(SEPARATOR_WORD))
    boilerplate = reduce(lambda a, b: a | b, [x["lower"].contains(p) for p in BOILERPLATE])
    has_stop = line.endswith(".") | line.contains(". ")
    return (
        F.when(n == 0, F.lit(None).cast("string"))
        .when((x["separators"] >= rules.navigation_min_separators)
              & (x["separators"] * rules.navigation_words_per_separator >= n)
              & (separator_words >= rules.navigation_min_separators)
              & (separator_words * rules.navigation_words_per_separator >= n), "navigation")
        .when(x["symbols"] * 100 > n * rules.symbol_percent, "symbols")
        .when((n >= rules.shout_min_words) & line.contains("!!") & (F.upper(line) == line) & (x["lower"] != line),
              "shouting")
        .when((n >= rules.punctuation_min_words) & ~has_stop
              & ~line.rlike("[.!?…。！？](?=[\\x20\\x09-\\x0D\"'”’»)\\]]|$)"), "punctuation")
        .when((n <= rules.boilerplate_max_words) & boilerplate, "boilerplate")
    )


# Columns that are added on the way and dropped; given columns of these names come back as they were.
WORKING = ["_words", "_lines", "_windows", "_sorted", "_with_word", "_judged"]


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumns({"_words": words(F.col(text)), "_lines": F.split(t, "\n", -1)})
    # a window of five words as one 64-bit hash: windows of one text are compared with each other only
    window = F.transform(
        F.sequence(F.lit(0), F.size("_words") - WINDOW),
        lambda i: F.xxhash64(*[F.col("_words")[i + k] for k in range(WINDOW)]))
    df = df.withColumn("_windows", F.when(F.size("_words") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    numbered = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) == F.size("_windows"), none).otherwise(numbered))
    s = F.col("_sorted")
    twice = F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["h"] == x["h"]))
                     | ((i + 1 < F.size(s)) & (F.get(s, i + 1)["h"] == x["h"])))
    places = F.array_sort(F.transform(twice, lambda x: x["i"]))
    # words covered by repeated windows: each start adds what the one before it has not covered
    covered = F.aggregate(
        places, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
        lambda a: a["n"])
    with_word = F.filter("_lines", lambda x: F.length(removed(x, SPACE_CHARS)) > 0)
    df = df.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(removed(t, SPACE_CHARS)).cast("long"),
        "n_symbols": (F.length(t) - F.length(removed(t, SYMBOLS))).cast("long"),
        "_with_word": with_word,
        "n_repeat_words": covered,
    })
    df = df.withColumn("n_dup_lines", (F.size("_with_word") - F.size(F.array_distinct("_with_word"))).cast("long"))
    return df.drop("_words", "_windows", "_sorted", "_with_word")


def clean(df: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """Judge every line and document; adds the base counts, ``cleaned``, ``n_removed_words``, ``base_failed``, ``kept``.

    ``cleaned`` is the text without its failing lines.  A document is kept if it passes the
    base rules and loses at most ``max_loss_percent`` of its words to the line rules.
    """
    df, back = set_aside(df, WORKING)
    text = next((n for n, c in back.items() if c == text), text)
    df = base_counts(df, text)
    facts = F.transform("_lines", lambda x: line_facts(x, rules))
    judged = F.transform(facts, lambda x: F.struct(x["line"].alias("line"), x["n"].alias("n"),
                                                   line_fails(x, rules).isNull().alias("ok")))
    df = df.withColumn("_judged", judged)
    good = F.transform(F.filter("_judged", lambda x: x["ok"]), lambda x: x["line"])
    lost = F.aggregate("_judged", F.lit(0).cast("long"), lambda n, x: n + F.when(x["ok"], 0).otherwise(x["n"]))
    base_failed = (F.col("n_words") < rules.min_words) \
        | (F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent)
    df = df.withColumns({"cleaned": F.array_join(good, "\n"), "base_failed": base_failed, "n_removed_words": lost})
    df = df.drop("_lines", "_judged")
    verdict = ~F.col("base_failed") & (F.col("n_removed_words") * 100 <= F.col("n_words") * rules.max_loss_percent)
    # The random term (always 0) keeps a filter on ``kept`` above this projection: pushed below
    # it, the filter would spell out the word and line expressions inside their own lambdas.
    return df.withColumn("kept", verdict.cast("int") + F.floor(F.rand(0)).cast("int") == 1).withColumnsRenamed(back)


def query(spark, sf_dir: str) -> DataFrame:
    """op10: counts and verdict for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return clean(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept", "n_removed_words")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: rejected documents go, the others carry on with their cleaned text."""
    kept = clean(docs).filter("kept")
    return kept.select("doc_id", F.col("cleaned").alias("text"), "lang", "source",
                       F.length("cleaned").cast("long").alias("n_chars"))


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT doc_id, rid, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         string_split(t, chr(10)) AS ls FROM d
), p AS (
  SELECT rid, unnest(range(1, len(ws) - 3)) AS i, ws FROM w WHERE len(ws) >= 5
), g AS (
  SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] || ' ' || ws[i+3] || ' ' || ws[i+4] AS win FROM p
), r AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS c FROM g
), v AS (
  SELECT rid, least(5, i - coalesce(lag(i) OVER (PARTITION BY rid ORDER BY i), -5)) AS adds FROM r WHERE c >= 2
), rep AS (
  SELECT rid, sum(adds)::BIGINT AS n_repeat_words FROM v GROUP BY rid
), l AS (
  SELECT rid, unnest(ls) AS line FROM w
), f AS (
  SELECT rid, line,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
    len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'),
                    lambda x: regexp_full_match(x, '[|»›•·>/\\-]+'))) AS sep,
    length(line) - length(translate(line, '#*$%&|<>', '')) AS sym
  FROM l
), j AS (
  SELECT rid, sum(n)::BIGINT AS lost FROM f
  WHERE n > 0 AND ((sep >= 2 AND sep * 4 >= n) OR sym * 100 > n * 50
    OR (n >= 3 AND contains(line, '!!') AND upper(line) = line AND lower(line) <> line)
    OR (n >= 8 AND NOT regexp_matches(line, '[.!?…。！？]([\x20\x09-\x0D"''”’»)\]]|$)'))
    OR (n <= 30 AND regexp_matches(lower(line), 'all rights reserved|copyright \(c\)|copyright ©|cookie policy|accept cookies|we use cookies|privacy policy|terms of use|terms of service|terms and conditions|subscribe to our|sign up for|log in to|enable javascript|click here|read more|share on|follow us')))
  GROUP BY rid
), k AS (
  SELECT w.rid, w.doc_id, len(ws)::BIGINT AS n_words,
    length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
     - len(list_distinct(list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(lost, 0) AS n_removed_words
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN j USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_removed_words * 100 <= n_words * 50 AS kept,
  n_removed_words
FROM k
"""
