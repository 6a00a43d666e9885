"""The queries that apply each operator to whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecshoal.llm import (
    classifier, fingerprints, html_text, jaccard, lines, mixing, packing, pii, ranked, residual_packing, rules, spelling, substrings,
)
from vecshoal.llm.common import whole


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_pack_best_fit(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    pieces = packing.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def held_out() -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))


def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = classifier.train(docs, labels.where(~held_out())).score(docs)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op3_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf, "documents"), count="n_removed")
    return cut.select("doc_id", "text", "n_removed")


#: Sources numbered under ten are the web, the others curated; targets by level.
WEIGHTS = (
    {"web": 0.6, "curated": 0.4},
    {"en": 0.4, "de": 0.25, "fr": 0.2, "es": 0.15},
    {"src0": 2.0},
)


def mix_levels() -> tuple[Column, Column, Column]:
    web = F.regexp_like("source", F.lit("^src[0-9]$"))
    return F.when(web, "web").otherwise("curated"), F.col("lang"), F.col("source")


def op4_mix_hierarchy(spark: SparkSession, sf: str) -> DataFrame:
    chosen = mixing.choose(table(spark, sf, "documents"), mix_levels(), WEIGHTS, budget_share=0.5, max_epochs=2, seed=17)
    return chosen.select("doc_id", F.col("l1").alias("domain"), F.col("l2").alias("lang"), F.col("l3").alias("source"), "tokens", "epochs")


def op5_weighted_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edited(table(spark, sf, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents")).select("doc_id", "class_id", "n_links")


def op7_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf, "documents"))
    spans = F.col("spans")

    def listed(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE]
    base = listed(of(*pii.BASE))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), listed(spans).alias("spans"))


def op8_adaptive_rules(spark: SparkSession, sf: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op9_html_main_text(spark: SparkSession, sf: str) -> DataFrame:
    found = html_text.extract(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op10_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    cut = substrings.remove_repeats(table(spark, sf, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    lowered = F.translate(whole("text"), CAPITALS, SMALL)
    runs = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all(lowered, F.lit("([a-z\u00C0-\u00FF]+)"))).alias("run"))
    drawn = runs.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("run"))))
    run, at = F.col("run"), (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return spelling.group_variants(drawn.select(F.when(F.col("h") % 199 == 0, cut).otherwise(run).alias("word")))


def op12_residual_packing(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    pieces = residual_packing.pack_whole(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


def op13_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pack_best_fit,
        op2_quality_classifier,
        op3_line_dedup,
        op4_mix_hierarchy,
        op5_weighted_fingerprints,
        op6_ngram_jaccard_join,
        op7_personal_data,
        op8_adaptive_rules,
        op9_html_main_text,
        op10_repeated_passages,
        op11_spelling_variants,
        op12_residual_packing,
        op13_ranked_search,
    )
}

BLANKS = r"'[\t\n\x0b\x0c\r ]+'"


def words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, {BLANKS}), lambda w: w <> '')"


LINE_SQL = f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM d),
w AS (SELECT doc_id, no, line, {words_sql('line')} AS words FROM l),
f AS (SELECT words, min({{'d': doc_id, 'n': no}}) AS spot FROM w WHERE len(words) > 0 GROUP BY words),
t AS (SELECT words, spot, array_to_string(words, ' ') AS tidy, len(words) < 8 AS chars FROM f),
u AS (SELECT words, spot, chars, CASE WHEN chars THEN list_transform(range(1, length(tidy) + 1), lambda i: substring(tidy, i, 1)) ELSE words END AS units
      FROM t WHERE NOT chars OR length(tidy) BETWEEN 20 AND 255),
v AS (SELECT words, spot, chars, i, list_concat(units[:i - 1], units[i + 1:]) AS rest
      FROM (SELECT words, spot, chars, units, unnest(range(1, len(units) + 1)) AS i FROM u)
      UNION ALL SELECT words, spot, chars, 0, units FROM u),
e AS (SELECT chars, rest, i, min(spot) AS spot FROM v GROUP BY chars, rest, i),
gone AS (SELECT DISTINCT v.words FROM v JOIN e ON v.rest = e.rest AND v.chars = e.chars AND (v.i = e.i OR (v.i = 0) <> (e.i = 0)) WHERE e.spot < v.spot),
k AS (SELECT w.*, len(words) = 0 AS blank,
        len(words) = 0 OR (f.spot = {{'d': doc_id, 'n': no}} AND words NOT IN (SELECT words FROM gone)) AS stays
      FROM w LEFT JOIN f USING (words))
SELECT doc_id, CASE WHEN bool_or(stays AND NOT blank) THEN string_agg(line, chr(10) ORDER BY no) FILTER (WHERE stays) ELSE '' END AS text,
  count(*) FILTER (WHERE NOT stays) AS n_removed FROM k GROUP BY doc_id"""


def poured_sql(name: str, nodes: str, parent: str, key: str, weight: str) -> str:
    """Steps ``<name>`` that share the ``budget`` of the rows of ``nodes`` among siblings."""
    over = f"PARTITION BY {parent}" if parent else ""
    return f"""{name}_w AS (SELECT *, room / weight AS ratio, least(budget, sum(room) OVER ({over})) AS b
        FROM (SELECT *, {weight} AS weight FROM {nodes})),
      {name}_f AS (SELECT *, ratio * sum(weight) OVER ({over} ORDER BY ratio, {key} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
          <= b - coalesce(sum(room) OVER ({over} ORDER BY ratio, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled FROM {name}_w),
      {name} AS (SELECT * EXCLUDE (budget), CASE WHEN filled THEN room ELSE
          (b - coalesce(sum(room) FILTER (WHERE filled) OVER ({over}), 0)) / sum(weight) FILTER (WHERE NOT filled) OVER ({over}) * weight END AS budget
        FROM {name}_f)"""


def weights_sql(column: str, weights: dict[str, float]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1.0 END::DOUBLE"


MIX_SQL = f"""WITH t AS (SELECT doc_id, CASE WHEN regexp_matches(source, '^src[0-9]$') THEN 'web' ELSE 'curated' END AS l1,
    coalesce(lang, '') AS l2, coalesce(source, '') AS l3, len({words_sql("coalesce(text, '')")}) AS tokens FROM documents),
  leaf AS (SELECT l1, l2, l3, sum(tokens)::BIGINT AS tokens FROM t GROUP BY ALL),
  total AS (SELECT least(sum(tokens) * 0.5, sum(tokens) * 2)::DOUBLE AS budget FROM leaf),
  n1 AS (SELECT l1, (sum(tokens) * 2)::DOUBLE AS room, any_value(budget) AS budget FROM leaf, total GROUP BY l1),
  {poured_sql('p1', 'n1', '', 'l1', weights_sql('l1', WEIGHTS[0]))},
  n2 AS (SELECT l1, l2, (sum(tokens) * 2)::DOUBLE AS room, any_value(p1.budget) AS budget FROM leaf JOIN p1 USING (l1) GROUP BY l1, l2),
  {poured_sql('p2', 'n2', 'l1', 'l2', weights_sql('l2', WEIGHTS[1]))},
  n3 AS (SELECT l1, l2, l3, (sum(tokens) * 2)::DOUBLE AS room, any_value(p2.budget) AS budget FROM leaf JOIN p2 USING (l1, l2) GROUP BY l1, l2, l3),
  {poured_sql('p3', 'n3', 'l1, l2', 'l3', weights_sql('l3', WEIGHTS[2]))},
  plan AS (SELECT l1, l2, l3, CASE WHEN tokens > 0 THEN floor(budget + 1e-6)::BIGINT // tokens ELSE 0 END AS passes,
      floor(budget + 1e-6)::BIGINT AS words, tokens AS has FROM p3 JOIN leaf USING (l1, l2, l3)),
  r AS (SELECT t.*, passes, words - passes * has AS rest, sum(tokens) OVER (PARTITION BY l1, l2, l3
      ORDER BY md5('17:' || passes::VARCHAR || ':' || doc_id::VARCHAR) ROWS UNBOUNDED PRECEDING) AS upto FROM t JOIN plan USING (l1, l2, l3))
  SELECT doc_id, l1 AS domain, l2 AS lang, l3 AS source, tokens::BIGINT AS tokens, (passes + (upto <= rest)::INT)::BIGINT AS epochs
  FROM r WHERE passes + (upto <= rest)::INT > 0"""

#: All pairs of n-gram sets that share a gram, and classes by following links.
JACCARD_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') AS words FROM documents),
g AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END)) AS grams FROM w),
s AS (SELECT grams, min(doc_id) AS sid, len(grams) AS n FROM g GROUP BY grams),
t AS (SELECT sid, n, unnest(grams) AS gram FROM s),
p AS (SELECT a.sid AS a, b.sid AS b FROM t a JOIN t b USING (gram) WHERE a.sid <> b.sid GROUP BY a.sid, b.sid
    HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
r AS (SELECT sid AS a, sid AS b FROM s UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
c AS (SELECT a AS sid, min(b) AS class_id FROM r GROUP BY a),
l AS (SELECT a AS sid, count(*) AS n_links FROM p GROUP BY a)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM g JOIN s USING (grams) JOIN c USING (sid) LEFT JOIN l USING (sid)"""

#: 100 values for fences of a group's own, 6 quartile distances, 3 roots of a count; see ``rules.apply_rules``.
RULES_SQL = f"""WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, {words_sql("coalesce(text, '')")} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
v AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
x AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n FROM v),
y AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM x WHERE n > 1) GROUP BY doc_id),
m AS (SELECT doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines FROM w LEFT JOIN y USING (doc_id)),
q AS (SELECT *, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS m1, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS m2,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS m3, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS m4 FROM m),
o AS (SELECT lang, source, grouping(lang, source) AS level, count(*) AS n1, quantile_disc(m1, [0.25, 0.75]) AS q1,
    count(*) FILTER (WHERE m2 > 0) AS n2, quantile_disc(m2, [0.25, 0.75]) FILTER (WHERE m2 > 0) AS q2,
    count(*) FILTER (WHERE m3 > 0) AS n3, quantile_disc(m3, [0.25, 0.75]) FILTER (WHERE m3 > 0) AS q3,
    count(*) AS n4, quantile_disc(m4, [0.25, 0.75]) AS q4 FROM q GROUP BY GROUPING SETS ((lang, source), (lang), ())),
f AS (SELECT a.lang, a.source, {", ".join(f"CASE WHEN a.n{i} >= 100 THEN a.q{i} WHEN b.n{i} >= 100 THEN b.q{i} ELSE c.q{i} END AS q{i}" for i in (1, 2, 3, 4))}
    FROM (SELECT * FROM o WHERE level = 0) a JOIN (SELECT * FROM o WHERE level = 1) b ON a.lang IS NOT DISTINCT FROM b.lang, (SELECT * FROM o WHERE level = 3) c),
h AS (SELECT lang, source, {", ".join(f"q{i}[2] + 6.0::DOUBLE * (q{i}[2] - q{i}[1]) AS h{i}" for i in (1, 2, 3, 4))}, q4[1] - 6.0::DOUBLE * (q4[2] - q4[1]) AS l4 FROM f),
j AS (SELECT q.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    coalesce(n_symbols - 3.0::DOUBLE * sqrt(n_symbols) > h1 * n_words, false) OR coalesce(n_dup_lines - 3.0::DOUBLE * sqrt(n_dup_lines) > h2 * n_lines, false)
    OR coalesce(n_repeat_words - 3.0::DOUBLE * sqrt(n_repeat_words) > h3 * n_words, false) OR m4 > h4 OR m4 < l4 AS beyond
    FROM q JOIN h ON q.lang IS NOT DISTINCT FROM h.lang AND q.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT beyond AS kept FROM j"""

#: Every 50-byte string of every document, as hexadecimal digits.
PASSAGES_SQL = """WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
s AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS string FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM h WHERE len(x) >= 100)),
e AS (SELECT string, min(doc_id) AS first FROM s GROUP BY string HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT doc_id, i FROM s JOIN e USING (string) WHERE first < doc_id),
o AS (SELECT doc_id, i, i - lag(i, 1, -1000) OVER (PARTITION BY doc_id ORDER BY i) AS gap FROM r),
n AS (SELECT doc_id, i, sum((gap > 50)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM o),
z AS (SELECT doc_id, run, min(i) AS start, max(i) + 50 AS stop FROM n GROUP BY doc_id, run),
k AS (SELECT doc_id, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS start, start AS stop FROM z
    UNION ALL SELECT doc_id, max(stop), NULL FROM z GROUP BY doc_id),
b AS (SELECT doc_id, string_agg(CASE WHEN k.stop IS NULL THEN substr(x, 2 * k.start + 1) ELSE substr(x, 2 * k.start + 1, 2 * (k.stop - k.start)) END, '' ORDER BY k.start) AS kept
    FROM k JOIN h USING (doc_id) GROUP BY doc_id),
c AS (SELECT doc_id, count(*) AS n_spans, sum(stop - start) AS n_removed FROM z GROUP BY doc_id)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, x))) AS kept_sha256 FROM h LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)"""

#: CRC-32 by its table, which eight steps make of each byte; near words share what is left when one character is dropped from them.
SPELLING_SQL = f"""WITH RECURSIVE crc AS (SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
    FROM (SELECT unnest(range(256)) AS b)),
r AS (SELECT doc_id, run, count(*) AS times FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents) GROUP BY ALL),
x AS (SELECT *, hex(encode(doc_id::VARCHAR || ':' || run)) AS code FROM r),
y AS (SELECT run, times, list_prepend(4294967295, list_transform(range(1, len(code), 2),
    lambda i: ((strpos('0123456789ABCDEF', code[i]) - 1) * 16 + strpos('0123456789ABCDEF', code[i + 1]) - 1)::BIGINT)) AS bytes FROM x),
h AS (SELECT run, times, xor(list_reduce(bytes, lambda c, b: xor(t[1 + xor(c & 255, b)], c >> 8)), 4294967295) AS h FROM y, crc),
e AS (SELECT times, CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM h),
w AS (SELECT word, sum(times)::BIGINT AS n FROM e WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
d AS (SELECT word, n, i, CASE WHEN i = 0 THEN word ELSE word[:i - 1] || word[i + 1:] END AS rest FROM (SELECT *, unnest(range(0, length(word) + 1)) AS i FROM w)),
p AS (SELECT DISTINCT a.word, a.n, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.rest = b.rest AND a.word <> b.word AND (a.i = b.i OR (a.i = 0) <> (b.i = 0))),
q AS (SELECT word, count(*) AS n_near, max(near_n) AS most FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN most END AS form_n,
    (SELECT min(near) FROM p WHERE p.word = w.word AND p.near_n = most AND most >= 5 * w.n) AS form FROM w LEFT JOIN q USING (word)),
o AS (SELECT word, form AS root, 1 AS steps FROM f WHERE form IS NOT NULL UNION ALL SELECT o.word, f.form, steps + 1 FROM o JOIN f ON f.word = o.root WHERE f.form IS NOT NULL)
SELECT word, form, coalesce(z.root, word) AS root, n, n_near, form_n FROM f LEFT JOIN (SELECT word, arg_max(root, steps) AS root FROM o GROUP BY word) z USING (word)"""

RANKED_SQL = f"""WITH t AS (SELECT *, unnest(terms) AS term FROM (SELECT doc_id, len(terms) AS n, terms FROM (SELECT doc_id,
    regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents) WHERE len(terms) > 0)),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM (SELECT doc_id, any_value(n) AS n FROM t GROUP BY doc_id)),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{CAPITALS}', '{SMALL}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
c AS (SELECT doc_id, any_value(n)::BIGINT AS n, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM i) GROUP BY doc_id, term),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM c, s GROUP BY term, docs),
v AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
    FROM i JOIN c USING (term) JOIN w USING (term), s GROUP BY item_id, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM v WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""

SQL: dict[str, str] = {
    "op3_line_dedup": LINE_SQL,
    "op4_mix_hierarchy": MIX_SQL,
    "op6_ngram_jaccard_join": JACCARD_SQL,
    "op8_adaptive_rules": RULES_SQL,
    "op10_repeated_passages": PASSAGES_SQL,
    "op11_spelling_variants": SPELLING_SQL,
    "op13_ranked_search": RANKED_SQL,
}
