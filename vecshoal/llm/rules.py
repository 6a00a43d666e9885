"""Quality rules whose thresholds come from the data: fences around the quartiles of each language and source.

Everything is DataFrame functions, and texts never move: counts are taken where a text is read, stored, and
summed into mergeable quantile sketches (``percentile_approx``) by language and source, by language, and over all rows. Symbols and word lengths are
sketched over all documents; repeated lines and words, which most documents have none of, over the documents that have any. For each measure a
group takes its own sketch if it holds ``least_rows`` values, else that of its language, else that of all. A fence lies ``reach`` quartile
distances outside the quartiles. No cutoff is fixed: where the documents of a group hold no symbols its fence is 0.

A document goes if a measure lies beyond its fence by more than chance would have it: of ``n`` symbols, repeated lines or repeated words,
``noise`` times the root of ``n`` are not counted.

Cases: a NULL or empty text has no words and fails the base rule; NULL languages and sources are groups of their own; repeated
rows are judged alike; an empty table gives an empty result. Input columns other than id, text,
language and source are not read, so they never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecshoal.llm.common import stored, text_key, whole
from vecshoal.operators.joins import attach

BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
#: Measure: the documents that are sketched, the sides that are fenced, and the count that it is a share of words or lines by.
FENCED = {
    "symbol_share": ("all", "upper", ("n_symbols", "n_words")),
    "dup_line_share": ("positive", "upper", ("n_dup_lines", "n_lines")),
    "repeat_share": ("positive", "upper", ("n_repeat_words", "n_words")),
    "mean_word": ("all", "both", None),
}


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, BLANKS[:-1], " " * (len(BLANKS) - 1)), " "), "")


def repeated_words(docs: DataFrame, words: str, name: str) -> DataFrame:
    """Adds the number of words in three-word windows that occur twice or more in the row's text.

    Windows are compared by 64-bit hashes. Only rows that hold a window twice sort theirs: equal hashes then
    lie side by side, and their places, in order, tell how many words they cover together.
    """
    w = F.col(words)
    window = F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )
    rows = docs.withColumn("_windows", F.when(F.size(w) >= 3, window))
    hashes = F.col("_windows")
    twice = F.size(F.array_distinct(hashes)) < F.size(hashes)
    placed = F.array_sort(F.transform(hashes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(twice, placed))
    s = F.col("_sorted")
    nothing = F.array(F.lit(None).cast("bigint"))
    near = F.arrays_zip(
        s.alias("own"),
        F.concat(nothing, s["x"]).alias("before"),
        F.concat(F.slice(s["x"], 2, F.size(s)), nothing).alias("after"),
    )
    repeated = F.filter(
        near,
        lambda z: z["own"].isNotNull()
        & (z["own"]["x"].eqNullSafe(z["before"]) | z["own"]["x"].eqNullSafe(z["after"])),
    )
    places = F.array_sort(F.transform(repeated, lambda z: z["own"]["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("total")),
        lambda a, i: F.struct((i + 3).alias("end"), (a["total"] + i + 3 - F.greatest(i, a["end"])).alias("total")),
        lambda a: a["total"],
    )
    return rows.withColumn(name, F.when(s.isNotNull(), covered).otherwise(F.lit(0).cast("bigint"))).drop("_windows", "_sorted")


def measures(docs: DataFrame, doc_id: str, text: str, lang: str, source: str) -> DataFrame:
    body = F.col("_text")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), whole(text).alias("_text")
    ).withColumn("_words", words_of(body))
    rows = rows.withColumn(
        "_lines", F.filter(F.split(body, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    )
    rows = repeated_words(rows, "_words", "n_repeat_words")
    per = lambda part, of: F.when(of > 0, part / of).otherwise(0.0)
    n_words, n_lines = F.size("_words").cast("bigint"), F.size("_lines")
    word_chars = F.length(F.translate(body, BLANKS, "")).cast("bigint")
    n_symbols = (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint")
    n_dup_lines = (n_lines - F.size(F.array_distinct("_lines"))).cast("bigint")
    counted = rows.select(
        "doc_id", "lang", "source", text_key(body).alias("_spread"),
        n_words.alias("n_words"), word_chars.alias("word_chars"), n_symbols.alias("n_symbols"),
        n_dup_lines.alias("n_dup_lines"), "n_repeat_words", n_lines.cast("bigint").alias("n_lines"),
    )
    return counted.withColumns(
        {
            "symbol_share": per(F.col("n_symbols"), F.col("n_words")),
            "dup_line_share": per(F.col("n_dup_lines"), F.col("n_lines")),
            "repeat_share": per(F.col("n_repeat_words"), F.col("n_words")),
            "mean_word": per(F.col("word_chars"), F.col("n_words")),
        }
    )


def thresholds(measured: DataFrame, least_rows: int, reach: float, accuracy: int) -> DataFrame:
    """Fences by language and source: ``lang, source, <measure>_low, <measure>_high``."""
    sketched = []
    for m, (whose, _, _) in FENCED.items():
        value = F.col(m) if whose == "all" else F.when(F.col(m) > 0, F.col(m))
        sketched += [F.percentile_approx(value, [0.25, 0.75], accuracy).alias(m), F.count(value).alias(m + "_n")]
    levels = measured.groupingSets([["lang", "source"], ["lang"], []], "lang", "source").agg(F.grouping_id("lang", "source").alias("level"), *sketched)

    def level(number: int, suffix: str, *keys: str) -> DataFrame:
        renamed = [F.col(name).alias(name + suffix) for m in FENCED for name in (m, m + "_n")]
        return levels.where(F.col("level") == number).select(*keys, *renamed)

    own, by_lang, overall = level(0, "", "lang", "source"), level(1, "_lang", F.col("lang").alias("of")), level(3, "_all")
    by_lang, one = by_lang.withColumn("one", F.lit(1)), overall.withColumn("one", F.lit(1))
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("of"))).join(F.broadcast(one), "one")
    fences = []
    for m, (_, sides, _) in FENCED.items():
        own_enough, lang_enough = F.col(f"{m}_n") >= least_rows, F.col(f"{m}_n_lang") >= least_rows
        q = F.when(own_enough, F.col(m)).when(lang_enough, F.col(f"{m}_lang")).otherwise(F.col(f"{m}_all"))
        beyond = F.lit(reach) * (q[1] - q[0])
        fences.append((q[1] + beyond).alias(m + "_high"))
        if sides == "both":
            fences.append((q[0] - beyond).alias(m + "_low"))
    return joined.select("lang", "source", *fences)


def apply_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    least_rows: int = 100,
    reach: float = 6.0,
    noise: float = 3.0,
    accuracy: int = 10_000,
) -> DataFrame:
    """Counts, measures and verdict of each document.

    ``base_failed``: under 50 words, or over half of the words in repeated windows. ``kept``: neither that nor beyond a fence.
    """
    measured = stored(measures(docs, doc_id, text, lang, source), "measures")
    key = F.concat(*[F.concat(F.coalesce(F.hex(c), F.lit("-")), F.lit(":")) for c in ("lang", "source")])
    fences = thresholds(measured, least_rows, reach, accuracy).withColumn("_key", key).drop("lang", "source")
    judged = attach(measured.withColumn("_key", key), fences, "_key", "_spread")
    beyond = F.lit(False)
    for m, (_, sides, share) in FENCED.items():
        if share:
            n, of = F.col(share[0]), F.col(share[1])
            above = n - noise * F.sqrt(n) > F.col(m + "_high") * of
        else:
            above = F.col(m) > F.col(m + "_high")
        # No fence without any value of the measure.
        beyond |= F.coalesce(above, F.lit(False))
        if sides == "both":
            beyond |= F.coalesce(F.col(m) < F.col(m + "_low"), F.lit(False))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~beyond).alias("kept"), *FENCED,
    )
