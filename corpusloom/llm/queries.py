"""One query for each operator of this subpackage, over its whole table with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, exact, idfiles, lines, packing, quality, simhash, substrings, tokencount, toxicity
from .common import load


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality_filter(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(load(spark, sf_dir, "documents"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bytebpe.round_trips(load(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1, capacity=4096)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_common_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_cut", F.sha2("text", 256).alias("text_sha256"))


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.id_files(load(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(load(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, load(spark, sf_dir, "labels")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(load(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.drop_repeats(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_simhash_neardup, op3_byte_bpe, op4_best_fit_packing, op5_line_dedup, op6_token_ids, op7_exact_dedup, op8_toxicity, op9_token_counts, op10_substring_dedup)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _bucket(v: str) -> str:
    return f"CASE WHEN {v} < 64 THEN {v} ELSE 64 + (length(bin({v})) - 7) * 32 + ({v} >> (length(bin({v})) - 6)) - 32 END"


_FLOOR = "CASE WHEN bucket < 64 THEN bucket ELSE (32 + (bucket - 64) % 32) << ((bucket - 64) // 32 + 1) END"


#: The rules of operator 1 as SQL has them: ratio, thousandths of the tail quantile, multiple, lower fence too.
_RULES = {
    "symbols": ("n_symbols * 10000 // greatest(n_words, 1)", 850, 2, False),
    "dup_lines": ("n_dup_lines * 10000 // greatest(n_lines, 1)", 980, 1, False),
    "repeats": ("n_repeat_words * 10000 // greatest(n_words, 1)", 950, 3, False),
    "word_len": ("word_chars * 1000 // greatest(n_words, 1)", 850, 3, True),
}


def _quality_sql(prior: int = 50) -> str:
    ratios = {m: r[0] for m, r in _RULES.items()}
    tail = "CASE metric " + " ".join(f"WHEN '{m}' THEN {r[1]}" for m, r in _RULES.items()) + " END"
    levels = {"o": "lang, source", "l": "lang", "a": "1"}
    ctes = []
    for tag, by in levels.items():
        part = by if tag != "a" else "NULL::INT"
        ctes.append(f"""q_{tag} AS (SELECT {by if tag != 'a' else '1 AS one'}, metric, max(n) AS n, min(f) FILTER (upto * 1000 >= n * (1000 - {tail})) AS lo, min(f) FILTER (upto * 1000 >= n * 500) AS mid, min(f) FILTER (upto * 1000 >= n * {tail}) AS hi
            FROM (SELECT *, {_FLOOR} AS f, sum(cnt) OVER (PARTITION BY {part}, metric ORDER BY bucket) AS upto, sum(cnt) OVER (PARTITION BY {part}, metric) AS n
                  FROM (SELECT {by if tag != 'a' else '1'}, metric, bucket, sum(cnt) AS cnt FROM sk GROUP BY ALL)) GROUP BY ALL)""")
    draw = lambda c: f"(coalesce(o.n, 0) * coalesce(o.{c}, 0) + {prior} * ((coalesce(l.n, 0) * coalesce(l.{c}, 0) + {prior} * a.{c}) // (coalesce(l.n, 0) + {prior}))) // (coalesce(o.n, 0) + {prior})"
    ctes.append(f"""drawn AS (SELECT g.lang, g.source, a.metric, {', '.join(f'{draw(c)} AS {c}' for c in ('lo', 'mid', 'hi'))}
        FROM (SELECT DISTINCT lang, source FROM s) g, q_a a LEFT JOIN q_o o ON o.metric = a.metric AND o.lang IS NOT DISTINCT FROM g.lang AND o.source IS NOT DISTINCT FROM g.source
        LEFT JOIN q_l l ON l.metric = a.metric AND l.lang IS NOT DISTINCT FROM g.lang)""")
    beyond = []
    for m, (ratio, _, times, two_sided) in _RULES.items():
        beyond.append(f"d.metric = '{m}' AND ({ratio} > hi + {times} * (hi - mid)" + (f" OR {ratio} < lo - {times} * (mid - lo))" if two_sided else ")"))
    checks = [f"NOT EXISTS (SELECT 1 FROM drawn d WHERE d.lang IS NOT DISTINCT FROM s.lang AND d.source IS NOT DISTINCT FROM s.source AND ({' OR '.join(f'({b})' for b in beyond)}))"]
    stack = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS metric, CAST({e} AS BIGINT) AS v FROM s WHERE NOT base_failed" for m, e in ratios.items())
    return f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
    g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS tri FROM d, unnest(range(1, len(w) - 1)) AS t(i)),
    r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, tri) AS c FROM g) WHERE c > 1) GROUP BY rid),
    li AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
    ln AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM li WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
    s0 AS (SELECT d.doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
           (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols, coalesce(n_lines, 0) AS n_lines, coalesce(n_dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
           FROM d LEFT JOIN r USING (rid) LEFT JOIN ln USING (rid)),
    s AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM s0),
    v AS ({stack}),
    sk AS (SELECT lang, source, metric, {_bucket('v')} AS bucket, count(*) AS cnt FROM v GROUP BY ALL),
    {', '.join(ctes)}
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({' AND '.join(checks)}, true) AS kept FROM s"""


_EXACT_SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)"""

_SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS k FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM g) WHERE first < doc_id),
c AS (SELECT DISTINCT doc_id, p FROM r, unnest(range(i, i + 50)) AS t(p)),
x AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda p: gone IS NULL OR NOT list_contains(gone, p)), lambda p: w[p]), ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _quality_sql(), "op7_exact_dedup": _EXACT_SQL, "op10_substring_dedup": _SUBSTRING_SQL}
