"""Line-first quality rules, in DataFrame functions only.

Every line is judged by three rules:

* punctuation: clutter marks are over a tenth of the line, it has no letter or digit, or it is a fragment of one or two
  words without an end mark;
* navigation: three or more entries set apart by ``|``, ``>``, ``»``, ``·`` or ``•``, or the line is a menu entry;
* boilerplate: a line of up to 200 characters with a site phrase (cookies, privacy policy, all rights reserved ...).

Lines that fail go. A document that loses over half of its words that way is rejected, as is one that fails the base
rules (too few words, or too many words in repeated windows of eight).

Cases: a null text has no words and is rejected; blank lines neither fail nor count; other columns pass through. The
names of the added columns come before those of the input: an input column of such a name is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# The rules' patterns. They are written for both Java's and RE2's syntax.
SYMBOLS = "[#*$%&|<>]"
CLUTTER = "[^#*$%&|<>~^_={}!?]+"
ALNUM = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"
WORD = "[^ \\t-\\r]"
FRAGMENT = "^[ \\t-\\r]*[^ \\t-\\r]+([ \\t-\\r]+[^ \\t-\\r]+)?[ \\t-\\r]*$"
END_MARK = "[.!?:;\"')…。！？”’»\\]][ \\t-\\r]*$"
NAVIGATION = "([^ \\t-\\r]+ [|>»·•] ){2,}"
MENU = (
    "^[^0-9a-z]*(home|menu|search|log ?in|sign (in|up|out)|register|next( page)?|previous( page)?|back to top|skip to (main )?content|"
    "read more|share( this)?|print|contact( us)?|about( us)?|site ?map|archives?|faq|help)[^0-9a-z]*$"
)
BOILERPLATE = (
    "all rights reserved|(we|site) uses? cookies|accept (all )?cookies|cookie (policy|settings)|privacy policy|terms (of (use|service)|and conditions)|"
    "enable javascript|lorem ipsum|click here|subscribe to our|sign up for our|powered by|follow us on|share this (article|page|post)"
)
MENU_CHARS = 200
MIN_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
CLUTTER_PERCENT = 10


def line_fails(line: Column) -> Column:
    """Whether a line (never null) breaks a rule."""
    short = F.lower(line)
    clutter = F.length(F.regexp_replace(line, CLUTTER, ""))
    punctuation = (
        (clutter * 100 > F.length(line) * CLUTTER_PERCENT) | ~line.rlike(ALNUM) | (line.rlike(FRAGMENT) & ~line.rlike(END_MARK))
    )
    phrases = (F.length(line) <= MENU_CHARS) & (short.rlike(MENU) | short.rlike(BOILERPLATE))
    return punctuation | line.rlike(NAVIGATION) | phrases


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that a text has twice or more.

    Hashed windows tell that nothing repeats, which is the common case. Otherwise the windows themselves are sorted with
    their places, and the words that repeated places cover are counted.
    """

    def places(ws):
        return F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1))

    def exact(ws):
        pairs = F.array_sort(F.transform(places(ws), lambda i: F.struct(F.array_join(F.slice(ws, i, WINDOW), " ").alias("w"), i.alias("i"))))
        twice = _let(
            pairs,
            lambda p: F.filter(
                p, lambda x, k: F.coalesce(x["w"] == F.get(p, k - 1)["w"], F.lit(False)) | F.coalesce(x["w"] == F.get(p, k + 1)["w"], F.lit(False))
            ),
        )
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        steps = _let(starts, lambda s: F.transform(s, lambda x, k: F.least(F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def hashed(ws):
        marks = _let(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(places(h), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))
        return _let(marks, lambda m: F.size(F.array_distinct(m)) < F.size(m))

    return F.when((F.size(words) > WINDOW) & hashed(words), exact(words)).otherwise(F.lit(0).cast("long"))


#: Columns that ``judge`` adds, in place of any of the same name; names that begin with ``_judge_`` are its own, too.
MADE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_lost", "words_lost", "base_failed", "kept", "clean_text"]


def judge(docs: DataFrame, max_lost: float = 0.5, text: str = "text") -> DataFrame:
    """Add the base figures, ``clean_text``, ``words_lost``, ``base_failed`` and ``kept`` to each document."""
    whole = F.col(text)
    docs = docs.drop(*MADE)
    lines = F.split(whole, "\n", -1)
    with_word = F.filter(lines, lambda x: x.rlike(WORD))
    step = docs.withColumns(
        {
            "_judge_words": common.word_array(whole),
            "word_chars": F.coalesce(F.length(F.regexp_replace(whole, common.SPACE_RUN, "")), F.lit(0)).cast("long"),
            "n_symbols": F.coalesce(F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, "")), F.lit(0)).cast("long"),
            "n_dup_lines": F.coalesce(_let(with_word, lambda w: F.size(w) - F.size(F.array_distinct(w))), F.lit(0)).cast("long"),
            "_judge_lines": F.coalesce(F.size(lines), F.lit(0)),
            "_judge_good": F.filter(lines, lambda x: ~(x.rlike(WORD) & line_fails(x))),
        }
    )
    step = step.withColumns({"n_words": F.size("_judge_words").cast("long"), "n_repeat_words": repeat_words(F.col("_judge_words"))})
    step = step.withColumns(
        {
            "n_lines_lost": F.when(whole.isNull(), 0).otherwise(F.col("_judge_lines") - F.size("_judge_good")).cast("long"),
            "clean_text": F.when(F.size("_judge_good") == F.col("_judge_lines"), whole).otherwise(F.array_join("_judge_good", "\n")),
        }
    )
    step = step.withColumn("words_lost", F.when(F.col("n_lines_lost") == 0, F.lit(0).cast("long")).otherwise(F.col("n_words") - common.word_count(F.col("clean_text"))))
    step = step.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT))
    step = step.withColumn("kept", ~F.col("base_failed") & (F.col("words_lost") <= F.col("n_words") * F.lit(max_lost)))
    return step.drop("_judge_words", "_judge_lines", "_judge_good")


def query(spark, sf_dir):
    out = judge(common.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_lost", "words_lost", "base_failed", "kept")


def stage(spark, docs, sf_dir):
    """Rejected documents go; those that stay lose the failed lines.

    The verdict passes through a generator of one row: a filter directly on ``kept`` would be moved below the steps of
    ``judge``, where its copy of all their expressions splits the text anew for each window.
    """
    docs, columns = common.set_apart(docs, [*MADE, "_judged"])
    good = judge(docs).withColumn("_judged", F.explode_outer(F.array(F.struct("kept", "clean_text")))).where("_judged.kept")
    return good.withColumns({"text": F.col("_judged.clean_text"), "n_chars": F.length("_judged.clean_text").cast("long")}).select(*columns)


def _sql_text(pattern: str) -> str:
    return pattern.replace("'", "''")


def _words_sql(text: str) -> str:
    return f"coalesce(len(regexp_extract_all({text}, '[^ \\t-\\r]+')), 0)"


SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, text, regexp_extract_all(text, '[^ \\t-\\r]+') AS words, string_split(text, chr(10)) AS lines FROM documents
),
windows AS (
  SELECT row_id, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i, words FROM d WHERE len(words) >= {WINDOW}
),
keyed AS (SELECT row_id, i, array_to_string(words[i : i + {WINDOW - 1}], ' ') AS w FROM windows),
twice AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM keyed) WHERE n > 1),
cover AS (
  SELECT row_id, sum(least({WINDOW}, coalesce(following - i, {WINDOW}))) AS n_repeat_words
  FROM (SELECT row_id, i, lead(i) OVER (PARTITION BY row_id ORDER BY i) AS following FROM twice) GROUP BY row_id
),
line AS (SELECT row_id, unnest(lines) AS l FROM d WHERE text IS NOT NULL),
judged AS (
  SELECT row_id, l, regexp_matches(l, '{WORD}') AS has_word,
    regexp_matches(l, '{WORD}') AND (
      length(regexp_replace(l, '{CLUTTER}', '', 'g')) * 100 > length(l) * {CLUTTER_PERCENT} OR NOT regexp_matches(l, '{ALNUM}')
      OR (regexp_matches(l, '{FRAGMENT}') AND NOT regexp_matches(l, '{_sql_text(END_MARK)}')) OR regexp_matches(l, '{NAVIGATION}')
      OR (length(l) <= {MENU_CHARS} AND (regexp_matches(lower(l), '{MENU}') OR regexp_matches(lower(l), '{BOILERPLATE}')))
    ) AS fails FROM line
),
per AS (
  SELECT row_id, count(*) FILTER (has_word) - count(DISTINCT l) FILTER (has_word) AS n_dup_lines, count(*) FILTER (fails) AS n_lines_lost,
    coalesce(sum({_words_sql('l')}) FILTER (fails), 0) AS words_lost FROM judged GROUP BY row_id
),
base AS (
  SELECT doc_id, coalesce(len(words), 0)::BIGINT AS n_words, coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
    coalesce(length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')), 0)::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_lines_lost, 0)::BIGINT AS n_lines_lost, coalesce(words_lost, 0)::BIGINT AS words_lost
  FROM d LEFT JOIN per USING (row_id) LEFT JOIN cover USING (row_id)
)
SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT} AS base_failed,
  NOT (n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {REPEAT_PERCENT}) AND words_lost <= n_words * 0.5 AS kept FROM base
"""
