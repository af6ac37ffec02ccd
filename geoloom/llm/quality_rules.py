"""Quality rules as a ledger of failure bits (DataFrame functions only; no shuffle, no Python).

``measured`` derives the base measurements of a text, ``ledger`` evaluates every rule of ``RULES`` once
and stores its failure as a bit of ``failed``, ``apply_policy`` keeps what fails none of a versioned
policy's bits, and ``ablations`` counts, by bitwise aggregation over the distinct bit sets, what each
rule rejects, rejects alone, and what the policy would keep without it.

Words are runs of characters other than blank, tab, newline, vertical tab, form feed and return.

Cases: a null text has no words (all counts 0); an empty text likewise; a null doc_id and repeated
rows are kept as they are, a row each; an empty table gives no rows; columns of the input with the
names of measurements are replaced.  A text of any length is measured whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SPACES = "[\\x20\\x09-\\x0D]+"
#: Runs of characters that no rule counts.
UNCOUNTED = "[^#*$%&|<>!\\p{Lu}]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_chars_all", "n_lines", "n_bars", "n_bangs")
#: Rules by the number of their bit: name and the condition under which a document fails.
RULES: dict[int, tuple[str, Callable[[], Column]]] = {
    0: ("few_words", lambda: F.col("n_words") < 50),
    1: ("repeated_words", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    2: ("many_symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    3: ("upper_case", lambda: 100 * F.col("n_upper") > 30 * F.col("word_chars")),
    4: ("bar_list", lambda: 10 * F.col("n_bars") > F.col("n_words")),
    5: ("many_bangs", lambda: 10 * F.col("n_bangs") > F.col("n_words")),
    6: ("repeated_lines", lambda: 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
    7: ("long_words", lambda: F.col("word_chars") > 40 * F.col("n_words")),
    8: ("no_words", lambda: F.col("n_words") == 0),
}
#: Policies by version: the bits that reject a document.  Rules 6 and 7 are recorded but stand in no policy: on sf0.1
#: rule 6 rejects 25 documents that pass the base and are otherwise clean, rule 7 none.
POLICIES = {1: (0, 1), 2: (0, 1, 2, 3, 4, 5, 8), 3: (2, 3, 4, 5, 8)}
BASE_POLICY, POLICY = 1, 2


def mask(policy: int) -> int:
    return sum(1 << bit for bit in POLICIES[policy])


def _count(text: Column, pattern: str) -> Column:
    """Characters of text that a class matches."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _window_keys(words: str) -> Column:
    """A long for each 3-word window of an array, in order: 33 bits of a hash, then the window's place."""
    place = F.lit((1 << 31) - 1).cast("long")
    key = lambda x, i: F.xxhash64(x, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.bitwise_not(place)).bitwiseOR(i.cast("long"))
    return F.sort_array(F.transform(F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))), key))


def measured(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with the columns of MEASURES in place of text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.array_remove(F.split(text, SPACES), "")
    # only windows whose hash another one has can stand twice.  Neighbours of a hash are compared word by word; where two
    # differ (a hash of two windows), the text's windows of repeated hashes are sorted and those equal to a neighbour count
    after = lambda a: F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))
    place = lambda x: x.bitwiseAND(F.lit((1 << 31) - 1).cast("long")).cast("int")
    pair = lambda a, b: F.when(F.shiftright(a.bitwiseXOR(b), 31) == 0, F.struct(place(a).alias("a"), place(b).alias("b")))
    met = F.filter(F.zip_with("_k", after("_k"), pair), lambda x: x.isNotNull())
    word = lambda i, n: F.get("_w", i + n)
    mixed = F.exists("_c", lambda x: (word(x.a, 0) != word(x.b, 0)) | (word(x.a, 1) != word(x.b, 1)) | (word(x.a, 2) != word(x.b, 2)))
    places = F.array_distinct(F.concat(F.transform("_c", lambda x: x.a), F.transform("_c", lambda x: x.b)))
    windows = F.sort_array(F.transform(places, lambda i: F.struct(F.concat_ws(" ", word(i, 0), word(i, 1), word(i, 2)).alias("t"), i.alias("i"))))
    same = lambda a, b: F.get("_s", a).t == F.get("_s", b).t
    repeated = F.transform(F.filter(F.transform("_s", lambda x, j: F.struct(x.i.alias("i"), j.alias("j"))), lambda y: same(y.j, y.j - 1) | same(y.j, y.j + 1)), lambda y: y.i)
    gaps = F.zip_with(after("_p"), F.slice("_p", 1, F.greatest(F.size("_p") - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(3)))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    keep = [c for c in docs.columns if c not in (*MEASURES, "text", "_t", "_w", "_l", "_k", "_c", "_z", "_s", "_p", "_r", "_q")]
    one = docs.select(*[F.col(f"`{c}`") for c in keep], text.alias("_t"), words.alias("_w"), lines.alias("_l"))
    two = one.select(
        *[F.col(f"`{c}`") for c in keep], "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.monotonically_increasing_id().alias("_r"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.length("_t").cast("long").alias("n_chars_all"),
        F.regexp_replace("_t", UNCOUNTED, "").alias("_z"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("_w") >= 4, _window_keys("_w")).otherwise(F.array().cast("array<bigint>")).alias("_k"),
    )
    found = two.withColumn("_c", met).drop("_k").withColumn("_s", F.when(mixed, windows))
    three = found.withColumn("_p", F.sort_array(F.when(F.col("_s").isNotNull(), repeated).otherwise(places))).withColumn("_q", F.monotonically_increasing_id())
    # row numbers that the result refers to keep later filters above the measurements: moved below, they would
    # evaluate whole texts again inside the lambdas
    return three.select(
        *[F.col(f"`{c}`") for c in keep], F.when((F.col("_r") >= 0) & (F.col("_q") >= 0), F.col("n_words")).alias("n_words"), "word_chars",
        _count(F.col("_z"), "[#*$%&|<>]").alias("n_symbols"),
        "n_dup_lines",
        F.when(F.size("_p") > 0, F.aggregate(gaps, F.lit(3), lambda a, x: a + x)).otherwise(0).cast("long").alias("n_repeat_words"),
        _count(F.col("_z"), "\\p{Lu}").alias("n_upper"),
        "n_chars_all",
        "n_lines",
        _count(F.col("_z"), "[|]").alias("n_bars"),
        _count(F.col("_z"), "!").alias("n_bangs"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """measured(docs) with ``failed``, one bit for each rule that the document fails."""
    bits = [F.when(rule(), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long") for bit, (_, rule) in RULES.items()]
    return measured(docs).withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits))


def apply_policy(rows: DataFrame, policy: int, column: str = "kept") -> DataFrame:
    """A ledger with whether a policy keeps each row."""
    return rows.withColumn(column, F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0)


def ablations(rows: DataFrame, policy: int) -> DataFrame:
    """For each rule of a policy: rule, n_failed, n_only (rejected by it alone), n_kept_without."""
    sets = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("bits")).count()
    rules = F.array(*[F.struct(F.lit(RULES[b][0]).alias("rule"), F.lit(1 << b).cast("long").alias("bit")) for b in POLICIES[policy]])
    each = sets.select("bits", "count", F.explode(rules).alias("r")).select("bits", "count", "r.rule", "r.bit")
    n = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).alias
    has, rest = F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit")))
    return each.groupBy("rule").agg(n(has)("n_failed"), n(has & (rest == 0))("n_only"), n(rest == 0)("n_kept_without"))


def judged(docs: DataFrame, policy: int = POLICY) -> DataFrame:
    """The ledger of docs with base_failed (the base policy) and kept (base and policy)."""
    base = apply_policy(ledger(docs), BASE_POLICY, "_base")
    return apply_policy(base, policy, "_own").select("*", (~F.col("_base")).alias("base_failed"), (F.col("_base") & F.col("_own")).alias("kept")).drop("_base", "_own")


def passing(docs: DataFrame, policy: int = POLICY) -> DataFrame:
    """The rows of docs that base and policy keep, with the columns of docs but those of measurements."""
    names = [c for c in docs.columns if c not in MEASURES]
    rows = judged(docs.select(*[F.col(f"`{c}`") for c in names], F.col("text").alias("_whole")), policy)
    return rows.where("kept").select(*[F.col("_whole").alias("text") if c == "text" else F.col(f"`{c}`") for c in names])


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy rejects, rejects alone, and would leave if it were dropped."""
    return ablations(ledger(table(spark, sf_dir, "documents").select("doc_id", "text")), POLICY)


_LEDGER_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), p AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri FROM (
    SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
), c AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS n FROM p
), r AS (
  SELECT rid, count(DISTINCT pos) AS n_repeat_words FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS pos FROM c WHERE n > 1) GROUP BY rid
), m AS (
  SELECT doc_id, l, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_upper,
         length(t) - length(replace(t, '|', '')) AS n_bars,
         length(t) - length(replace(t, '!', '')) AS n_bangs
  FROM d LEFT JOIN r USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         10 * n_symbols > n_words OR 100 * n_upper > 30 * word_chars OR 10 * n_bars > n_words
           OR 10 * n_bangs > n_words OR n_words = 0 AS own_failed,
         CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_upper > 30 * word_chars THEN 8 ELSE 0 END
           + CASE WHEN 10 * n_bars > n_words THEN 16 ELSE 0 END + CASE WHEN 10 * n_bangs > n_words THEN 32 ELSE 0 END
           + CASE WHEN 100 * n_dup_lines > 30 * len(l) THEN 64 ELSE 0 END + CASE WHEN word_chars > 40 * n_words THEN 128 ELSE 0 END
           + CASE WHEN n_words = 0 THEN 256 ELSE 0 END AS bits
  FROM m
)
"""
OP2_SQL = (
    _LEDGER_SQL
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT own_failed AS kept, CAST(bits AS BIGINT) AS failed
FROM b
"""
)
ABLATIONS_SQL = (
    _LEDGER_SQL
    + """, rules(rule, bit) AS (VALUES ('few_words', 1), ('repeated_words', 2), ('many_symbols', 4), ('upper_case', 8), ('bar_list', 16), ('many_bangs', 32), ('no_words', 256))
SELECT rule, count(*) FILTER (bits & bit <> 0) AS n_failed, count(*) FILTER (bits & 319 = bit) AS n_only,
       count(*) FILTER (bits & (319 - bit) = 0) AS n_kept_without
FROM b, rules GROUP BY rule
"""
)
