"""Quality rules: repetition within a text, and its distance from how its language is written.

Every text is described by two histograms, of the classes of its characters and of the most
common words of its language, and both are compared with the same histograms over all texts
of that language by their Jensen-Shannon distance. A short text differs from any reference by
chance, so texts under a minimum length are not judged by a histogram, and the divergence
that chance alone explains is allowed on top of the limit.

Everything is built from Spark's own functions; a text is handled within its row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.session import settle
from .common import WORD

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS, REPEATED_PERCENT = 20, 30
CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "letter": r"\p{Lt}\p{Lm}\p{Lo}", "number": r"\p{N}", "space": r"\x20\x09-\x0D", "mark": r"\p{P}"}
"""Classes of characters; what is in none of them is one more."""
COMMON = 24
"""Common words of a reference."""
COMMON_SHARE = 4096
"""Only words with 1/4096 of a language's words can be common ones, at most 4096 a language."""
LANGUAGE_SHARE = 1024
"""A language with less than 1/1024 of all words has no reference of its own, so there are at most 1024."""
MIN_CHARS, MIN_TOKENS, MIN_REFERENCE = 200, 50, 1000
"""Characters and words from which a text is judged by a histogram, and words a reference needs."""
CHAR_LIMIT, WORD_LIMIT = 0.25, 0.3
"""Largest Jensen-Shannon distances of a text that is kept."""


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda refers to it."""
    return F.get(F.transform(F.array(value), body), 0)


def split_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def with_class_counts(rows: DataFrame, text: str, counts: str, symbols: str) -> DataFrame:
    """Adds the characters of each class and of none, as an array, and how many of them are SYMBOLS.

    Each class is taken out of what the classes before it left, so that only the first
    one, the most frequent, is searched for in the whole text.
    """
    left, names = F.col(text), []
    for name, characters in CLASSES.items():
        rows = rows.withColumn(f"_less_{name}", F.regexp_replace(left, f"[{characters}]+", ""))
        names.append(F.length(left) - F.length(f"_less_{name}"))
        left = F.col(f"_less_{name}")
    signs = F.col("_less_space")
    return rows.withColumns(
        {counts: F.array(*[n.cast("long") for n in [*names, F.length(left)]]), symbols: (F.length(signs) - F.length(F.translate(signs, SYMBOLS, ""))).cast("long")}
    ).drop(*[f"_less_{name}" for name in CLASSES])


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words in windows of ``window`` words that a text has twice or more, the first ones included.

    Windows are sorted by a hash; neighbours with equal hashes are compared word by word.
    """

    def covered(w: Column, hashes: Column) -> Column:
        def among(s: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                return F.coalesce((x["h"] == y["h"]) & (F.slice(w, x["i"] + 1, window) == F.slice(w, y["i"] + 1, window)), F.lit(False))

            repeated = F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)))
            return F.array_sort(F.transform(repeated, lambda x: x["i"]))

        ordered = let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), among)
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(ordered, start, lambda a, i: F.struct((i + window).alias("end"), (a["n"] + i + window - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), F.size(w) - window + 1), lambda i: F.xxhash64(F.slice(w, i, window)))
        return F.when(F.size(w) <= window, 0).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(w, h))))

    return let(words, counted)


def repeated_lines(text: Column) -> Column:
    """Lines with a word that are equal to an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon divergence of two histograms of shares, in bits: 0 if they are equal, 1 at most."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, 0.5 * a * F.log2(2 * a / (a + b))).otherwise(0.0)

    return F.greatest(F.lit(0.0), F.aggregate(F.zip_with(p, q, lambda a, b: half(a, b) + half(b, a)), F.lit(0.0), lambda s, x: s + x))


def shares(counts: Column) -> Column:
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return let(total, lambda n: F.transform(counts, lambda c: c / n))


def word_counts(found: Column, common: Column) -> Column:
    """How often each common word stands in ``found``, then how many other words do."""

    def counted(hits: Column) -> Column:
        return F.transform(common, lambda c: F.size(F.filter(hits, lambda w: w == c)).cast("long"))

    return let(found, lambda w: let(F.filter(w, lambda x: F.array_contains(common, x)), lambda hits: F.concat(counted(hits), F.array((F.size(w) - F.size(hits)).cast("long")))))


def fit_references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The histograms of each language (common words are of letters only) and, with a null ``lang``, of all texts together.

    Columns lang, chars (shares of the classes of characters), words (the common words),
    common (their shares, and that of the others). At most LANGUAGE_SHARE + 1 rows of
    COMMON words each. Texts without a language count for the whole alone.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = with_class_counts(docs.select(F.col(lang).cast("string").alias("lang"), body.alias("body")), "body", "chars", "symbols")
    # a word is a row, and each class of a text's characters, without a word
    words = F.transform(split_words(F.col("body")), lambda w: F.struct(w.alias("word"), F.lit(-1).alias("class"), F.lit(1).cast("long").alias("n")))
    chars = F.transform("chars", lambda n, i: F.struct(F.lit(None).cast("string").alias("word"), i.alias("class"), n.alias("n")))
    listed = rows.select("lang", F.inline(F.concat(words, chars)))
    counted = settle(listed.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")))
    both = counted.filter("lang is not null").unionAll(counted.groupBy("word", "class").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "word", "class", "n"))
    totals = both.groupBy("lang").agg(F.sum(F.when(F.col("class") < 0, F.col("n"))).alias("tokens"), *[F.sum(F.when(F.col("class") == i, F.col("n"))).alias(f"class_{i}") for i in range(len(CLASSES) + 1)])
    totals = settle(totals.filter(F.col("tokens") >= MIN_REFERENCE))
    whole = totals.filter("lang is null").select("tokens").first()
    totals = totals.filter(F.col("lang").isNull() | (F.col("tokens") * LANGUAGE_SHARE >= (whole.tokens if whole else 0)))

    same = both.filter("class < 0").join(F.broadcast(totals), both.lang.eqNullSafe(totals.lang)).select(totals.lang, "word", "n", "tokens")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = same.filter(F.col("word").rlike(r"^\p{L}+$")).filter(F.col("n") * COMMON_SHARE >= F.col("tokens")).withColumn("place", place).filter(F.col("place") <= COMMON)
    listed = common.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "word", "n"))).alias("found")).withColumnRenamed("lang", "of")
    counts = F.array(*[f"class_{i}" for i in range(len(CLASSES) + 1)])
    hits = F.transform("found", lambda x: x["n"])
    others = F.col("tokens") - F.aggregate(hits, F.lit(0).cast("long"), lambda a, b: a + b)
    return totals.join(F.broadcast(listed), F.col("lang").eqNullSafe(F.col("of"))).select(
        "lang", shares(counts).alias("chars"), F.transform("found", lambda x: x["word"]).alias("words"), shares(F.concat(hits, F.array(others))).alias("common")
    )


def judge(
    docs: DataFrame,
    references: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    char_limit: float = CHAR_LIMIT,
    word_limit: float = WORD_LIMIT,
) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, char_distance, word_distance, kept.

    A null text has no words and fails by their number. A text is compared with the
    reference of its language, and with that of all texts if it has none. A distance is
    null, and not judged, if the text is too short for it or there is no reference.
    Repeated rows are judged alike; an empty table gives an empty result.
    """
    own = references.filter("lang is not null").select(F.col("lang").alias("_of"), F.struct("chars", "words", "common").alias("_own"))
    row = references.filter("lang is null").select("chars", "words", "common").first()
    schema = "struct<chars: array<double>, words: array<string>, common: array<double>>"
    pooled = F.struct(*[F.array(*map(F.lit, row[n])).alias(n) for n in ("chars", "words", "common")]) if row else F.lit(None)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("_lang"), body.alias("_text"))
    matched = rows.join(F.broadcast(own), F.col("_lang") == F.col("_of"), "left").select("doc_id", "_text", split_words(F.col("_text")).alias("_words"), F.coalesce("_own", pooled.cast(schema)).alias("_ref"))
    described = with_class_counts(matched, "_text", "_chars", "n_symbols").select(
        "doc_id",
        F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - F.get("_chars", list(CLASSES).index("space"))).cast("long").alias("word_chars"),
        "n_symbols",
        repeated_lines(F.col("_text")).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.length("_text").alias("_size"),
        "_ref",
        "_chars",
        F.when(F.col("_ref").isNotNull(), word_counts(F.col("_words"), F.col("_ref")["words"])).alias("_common"),
    )
    seen = F.aggregate("_common", F.lit(0).cast("long"), lambda a, b: a + b)
    measured = described.withColumn("_seen", seen).withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")),
            "_char": F.when((F.col("_size") >= MIN_CHARS) & F.col("_ref").isNotNull(), divergence(shares(F.col("_chars")), F.col("_ref")["chars"])),
            "_word": F.when(F.col("_seen") >= MIN_TOKENS, divergence(shares(F.col("_common")), F.col("_ref")["common"])),
        }
    )
    by_chance = lambda cells, n: (cells - 1) / (8 * math.log(2) * n)
    fits = [
        F.col("_char") <= char_limit**2 + by_chance(len(CLASSES) + 1, F.col("_size")),
        F.col("_word") <= word_limit**2 + by_chance(F.size("_common"), F.col("_seen")),
    ]
    passes = F.coalesce(fits[0], F.lit(True)) & F.coalesce(fits[1], F.lit(True))
    return measured.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.round(F.sqrt("_char"), 6).alias("char_distance"), F.round(F.sqrt("_word"), 6).alias("word_distance"), (~F.col("base_failed") & passes).alias("kept"),
    )


def apply_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **limits: float) -> DataFrame:
    """:func:`judge` by references from the same documents."""
    return judge(docs, fit_references(docs, text, lang), doc_id, text, lang, **limits)


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id::BIGINT AS doc_id, coalesce(text, '') AS t, lang FROM documents),
described AS MATERIALIZED (
  SELECT rid, doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    [length(t) - length(regexp_replace(t, '\p{Ll}+', '', 'g')), length(t) - length(regexp_replace(t, '\p{Lu}+', '', 'g')),
     length(t) - length(regexp_replace(t, '[\p{Lt}\p{Lm}\p{Lo}]+', '', 'g')), length(t) - length(regexp_replace(t, '\p{N}+', '', 'g')),
     length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')), length(t) - length(regexp_replace(t, '\p{P}+', '', 'g'))] AS six
  FROM docs),
counted AS MATERIALIZED (SELECT *, list_append(six, length(t) - list_sum(six)::BIGINT) AS chars FROM described),
windows AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM described WHERE len(ws) >= 8)),
twice AS (SELECT rid, i FROM windows QUALIFY count(*) OVER (PARTITION BY rid, g) > 1),
covered AS (SELECT rid, count(DISTINCT i + d)::BIGINT AS n FROM twice, unnest(range(0, 8)) AS u(d) GROUP BY rid),
words AS (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(ws) AS word FROM described) GROUP BY ALL),
pools AS MATERIALIZED (SELECT * FROM words WHERE lang IS NOT NULL UNION ALL SELECT NULL, word, sum(n) FROM words GROUP BY word),
sums AS (SELECT lang, i, sum(chars[i]) AS n FROM counted, unnest(range(1, 8)) AS u(i) GROUP BY ALL),
classes AS (SELECT lang, list(n ORDER BY i) AS counts FROM (SELECT * FROM sums WHERE lang IS NOT NULL UNION ALL SELECT NULL, i, sum(n) FROM sums GROUP BY i) GROUP BY lang),
totals AS (SELECT lang, sum(n) AS tokens FROM pools GROUP BY lang),
large AS (SELECT * FROM totals WHERE tokens >= 1000 AND (lang IS NULL OR tokens * 1024 >= (SELECT tokens FROM totals WHERE lang IS NULL))),
common AS (
  SELECT b.lang, b.word, b.n, g.tokens, row_number() OVER (PARTITION BY b.lang ORDER BY b.n DESC, encode(b.word)) AS place
  FROM pools b JOIN large g ON b.lang IS NOT DISTINCT FROM g.lang WHERE regexp_full_match(b.word, '\p{L}+') AND b.n * 4096 >= g.tokens QUALIFY place <= 24),
listed AS (SELECT lang, list(word ORDER BY place) AS words, list_append(list(n ORDER BY place), any_value(tokens) - sum(n)) AS hits FROM common GROUP BY lang),
refs AS MATERIALIZED (
  SELECT l.lang, l.words, list_transform(l.hits, lambda x: x / list_sum(l.hits)) AS common, list_transform(c.counts, lambda x: x / list_sum(c.counts)) AS chars
  FROM listed l JOIN classes c ON l.lang IS NOT DISTINCT FROM c.lang),
matched AS (
  SELECT d.*, r.words, r.common AS rc, r.chars AS rs FROM counted d
  JOIN refs r ON r.lang IS NOT DISTINCT FROM CASE WHEN d.lang IN (SELECT lang FROM refs WHERE lang IS NOT NULL) THEN d.lang END),
hist AS (SELECT *, list_transform(words, lambda c: len(list_filter(ws, lambda w: w = c))) AS few FROM matched),
shared AS (
  SELECT *, len(ws) AS seen, len(few) + 1 AS cells, list_transform(list_append(few, len(ws) - list_sum(few)::BIGINT), lambda x: x / len(ws)) AS wc,
    list_transform(chars, lambda x: x / length(t)) AS cc FROM hist),
apart AS (
  SELECT rid, seen, cells,
    CASE WHEN length(t) >= 200 THEN greatest(0.0, list_sum(list_transform(range(1, 8), lambda i: CASE WHEN cc[i] > 0 THEN 0.5 * cc[i] * log2(2 * cc[i] / (cc[i] + rs[i])) ELSE 0.0 END + CASE WHEN rs[i] > 0 THEN 0.5 * rs[i] * log2(2 * rs[i] / (cc[i] + rs[i])) ELSE 0.0 END))) END AS cd,
    CASE WHEN seen >= 50 THEN greatest(0.0, list_sum(list_transform(range(1, cells + 1), lambda i: CASE WHEN wc[i] > 0 THEN 0.5 * wc[i] * log2(2 * wc[i] / (wc[i] + rc[i])) ELSE 0.0 END + CASE WHEN rc[i] > 0 THEN 0.5 * rc[i] * log2(2 * rc[i] / (wc[i] + rc[i])) ELSE 0.0 END))) END AS wd
  FROM shared),
base AS (
  SELECT rid, doc_id, t, len(ws)::BIGINT AS n_words, (length(t) - six[5])::BIGINT AS word_chars, (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM described LEFT JOIN covered c USING (rid)),
failed AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(sqrt(cd), 6) AS char_distance, round(sqrt(wd), 6) AS word_distance,
  NOT base_failed AND coalesce(cd <= 0.0625 + 6 / (8 * ln(2) * length(t)), true) AND coalesce(wd <= 0.09 + (cells - 1) / (8 * ln(2) * seen), true) AS kept
FROM failed LEFT JOIN apart USING (rid)
"""
