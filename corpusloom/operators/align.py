"""From documents to sentence pairs: marker search with graded fallbacks, slicing and coverage (ALN-01 to ALN-08, ALN-15)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import jsons as J
from ..functions import text as X
from .relational import first_by, keep_columns, union_all

SLICES = "array<struct<raw: int, start: int, end: int, method: string>>"


def canonical_pairs(train: DataFrame, ratio: float = 0.1, salt: str = "deep_past_split_v1", id_col: str = "oare_id") -> DataFrame:
    """ALN-01: both texts cleaned, a hash split by document, provenance and weight."""
    out = train.withColumn("transliteration_clean", X.normalize_transliteration("transliteration")).withColumn("translation_clean", X.normalize_translation("translation"))
    out = out.withColumn("split", X.split_name(id_col, ratio, salt))
    out = keep_columns(out, [id_col, "transliteration", "transliteration_clean", "translation", "translation_clean", "split"])
    return out.withColumn("provenance", F.lit("gold_train_doc")).withColumn("trust_weight", F.lit(1.0))


def _fits(token: str, marker: str) -> bool:
    return token.startswith(marker) or marker.startswith(token)


def resolve_starts(tokens: list[str], markers: list[str], places: list[int | None], strict_empty: bool = False) -> list[tuple[int, str]]:
    """ALN-02, ALN-03: where each marker's sentence starts, and how that was found.

    A marker is searched from the furthest start so far: a token that equals it, or of which one is a prefix of the other,
    with or without hyphens. Then its given place counts, then its share of the document. A token without any letters
    left is a prefix of every marker; ``strict_empty`` passes over such tokens.
    """
    n, cursor, out = len(tokens), 0, []
    compact = [t.replace("-", "") for t in tokens]
    for k, (marker, place) in enumerate(zip(markers, places)):
        short = marker.replace("-", "")
        at = None
        if marker:
            at = next((j for j in range(cursor, n) if (tokens[j] or not strict_empty) and (_fits(tokens[j], marker) or (short and _fits(compact[j], short)))), None)
        if at is not None:
            method = "marker_search"
        elif place is not None and not pd.isna(place):
            at, method = int(place), "first_word_obj_fallback"
        else:
            at, method = (round(k / (len(markers) - 1) * (n - 1)) if n > 1 and len(markers) > 1 else 0), "proportional_fallback"
        out.append((at, method))
        cursor = max(cursor, at)
    return out


def slices(starts: list[int], n: int) -> list[tuple[int, int]]:
    """WIN-02, WIN-03: starts within the document and never falling, each with the next one as its end, one token at least."""
    fixed = list(accumulate((min(max(s, 0), n - 1) for s in starts), max))
    return [(a, b if b > a else min(n, a + 1)) for a, b in zip(fixed, [*fixed[1:], n])]


def _resolve(strict_empty: bool):
    @F.pandas_udf(SLICES)
    def resolve(tokens: pd.Series, markers: pd.Series, places: pd.Series) -> pd.Series:
        out = []
        for t, m, p in zip(tokens, markers, places):
            found = resolve_starts(list(t), list(m), list(p), strict_empty)
            out.append([{"raw": s, "start": a, "end": b, "method": how} for (s, how), (a, b) in zip(found, slices([s for s, _ in found], len(t)))])
        return pd.Series(out)

    return resolve


def marker_rows(markers: DataFrame, docs: DataFrame) -> DataFrame:
    """JOIN-01, WIN-01, PRJ-04: markers with a row id in input order, restricted to documents that exist.

    ``row_id`` comes from the caller's own order if the column is there; else rows are numbered by document, place and
    ordinal, which is a total order only if those are unique.
    """
    if "sentence_row_id" not in markers.columns:
        order = [F.asc_nulls_last("first_word_obj_in_text"), F.asc_nulls_last("sentence_obj_in_text"), F.asc_nulls_last("sentence_uuid")]
        markers = markers.withColumn("sentence_row_id", F.xxhash64("text_uuid", F.row_number().over(Window.partitionBy("text_uuid").orderBy(*order))))
    return markers.join(docs.select("text_uuid").distinct(), "text_uuid", "left_semi")


def _documents(canonical: DataFrame, id_col: str = "oare_id") -> DataFrame:
    """One row for each document, the first by text where an id repeats; names do not meet those of markers."""
    docs = canonical.withColumnsRenamed({id_col: "text_uuid", "split": "doc_split"})
    return first_by(docs, ["text_uuid"], F.asc_nulls_last("transliteration"), F.asc_nulls_last("translation"))


def sentence_pairs(canonical: DataFrame, markers: DataFrame, strict_empty: bool = False, id_col: str = "oare_id") -> DataFrame:
    """ALN-03, ALN-04: a row for each marker whose slice of its document is not blank after cleaning.

    A document's tokens and ordered markers meet in one row (both are as long as the document) and the search runs on
    Arrow batches of such rows. Slices are taken there too, before markers become rows again, so no row carries a
    document that it does not need, and nothing is shuffled after the one join.
    """
    docs = _documents(canonical, id_col).withColumn("tokens", X.words("transliteration")).filter(F.size("tokens") > 0)
    docs = docs.select("text_uuid", "doc_split", "tokens", F.transform("tokens", lambda t: X.token_for_match(t)).alias("token_keys"))
    rows = marker_rows(markers, docs).withColumn("first_word_transcription_clean", X.normalize_transliteration("first_word_transcription"))
    rows = rows.withColumn("marker", X.token_for_match("first_word_transcription_clean")).withColumn("target_sentence_clean", X.normalize_translation("translation"))
    payload = F.struct("first_word_obj_in_text", "sentence_obj_in_text", "sentence_row_id", "sentence_uuid", "line_number", "translation", "target_sentence_clean", "first_word_transcription", "first_word_transcription_clean", "marker")
    order = F.struct(F.col("first_word_obj_in_text").isNull(), "first_word_obj_in_text", F.col("sentence_obj_in_text").isNull(), "sentence_obj_in_text", "sentence_row_id")
    grouped = rows.groupBy("text_uuid").agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), payload.alias("p")))).alias("m"))
    joined = docs.join(grouped, "text_uuid")
    places = F.transform("m", lambda m: X.word_index(m["p"]["first_word_obj_in_text"], F.size("tokens")))
    found = joined.withColumn("found", _resolve(strict_empty)("token_keys", F.transform("m", lambda m: m["p"]["marker"]), places))

    def sentence(x: Column) -> Column:
        f = x["found"]
        return F.struct(x["m"]["p"].alias("p"), f.alias("f"), X.join_slice("tokens", f["start"], f["end"]).alias("source"), F.get("token_keys", f["start"]).alias("first"))

    flat = found.select("text_uuid", "doc_split", F.explode(F.transform(F.arrays_zip("m", "found"), sentence)).alias("x"))
    flat = flat.select("text_uuid", "doc_split", "x.p.*", "x.f.*", "x.first", F.col("x.source").alias("source_sentence_raw"), X.normalize_transliteration("x.source").alias("source_sentence_clean"))
    match = (F.col("marker") != "") & (F.startswith("first", "marker") | F.startswith("marker", "first"))
    return flat.filter("source_sentence_clean <> ''").select(
        "sentence_row_id", "text_uuid", "sentence_uuid", "sentence_obj_in_text", "line_number", "source_sentence_raw", "source_sentence_clean",
        F.col("translation").alias("target_sentence"), "target_sentence_clean", (F.col("start") + 1).alias("source_start_word_idx"), F.col("end").alias("source_end_word_idx_exclusive"),
        F.col("method").alias("boundary_method"), (F.col("raw") + 1).alias("source_start_word_idx_raw"), (F.col("start") != F.col("raw")).cast("int").alias("source_start_idx_repaired"),
        "first_word_transcription", "first_word_transcription_clean", match.cast("int").alias("first_word_match"), F.col("doc_split").alias("split"),
        F.lit("gold_sentence_pair_from_markers").alias("provenance"), F.lit(1.0).alias("trust_weight"),
    )


def coverage(canonical: DataFrame, markers: DataFrame, pairs: DataFrame, id_col: str = "oare_id") -> DataFrame:
    """AGG-01, AGG-02, JOIN-02: expected, produced and missing sentences of every document."""
    docs = _documents(canonical, id_col)
    expected = markers.groupBy("text_uuid").agg(F.count("*").cast("int").alias("expected_sentence_rows"))
    produced = pairs.groupBy("text_uuid").agg(F.count("*").cast("int").alias("produced_sentence_rows"))
    out = docs.join(expected, "text_uuid", "left").join(produced, "text_uuid", "left").fillna(0, ["expected_sentence_rows", "produced_sentence_rows"])
    e, p = F.col("expected_sentence_rows"), F.col("produced_sentence_rows")
    out = out.withColumn("unmatched_sentence_rows", e - p).withColumn("has_sentence_markers", (e > 0).cast("int")).withColumn("coverage_percent", F.when(e > 0, F.bround(p / F.greatest(e, F.lit(1)) * 100, 2)).otherwise(0.0))
    return keep_columns(out, ["text_uuid", "doc_split", "transliteration", "transliteration_clean", "translation", "translation_clean", "expected_sentence_rows", "produced_sentence_rows", "unmatched_sentence_rows", "has_sentence_markers", "coverage_percent"])


def unmatched(canonical: DataFrame, markers: DataFrame, pairs: DataFrame, id_col: str = "oare_id") -> DataFrame:
    """ALN-05, JOIN-08, JOIN-09: markers that gave no pair, and documents that have no marker."""
    docs = _documents(canonical, id_col)
    rows = marker_rows(markers, docs)
    missing = rows.join(pairs.select("sentence_row_id"), "sentence_row_id", "left_anti").withColumn("unmatched_reason", F.lit("alignment_not_generated"))
    bare = docs.join(markers.select("text_uuid").distinct(), "text_uuid", "left_anti").select("text_uuid", F.lit("no_sentence_markers").alias("unmatched_reason"))
    return union_all(missing, bare)


def training_ready(pairs: DataFrame) -> DataFrame:
    """ALN-07, FLT-03: pairs with words on both sides after cleaning."""
    out = pairs.withColumn("source_sentence_clean", X.normalize_transliteration("source_sentence_raw")).withColumn("target_sentence_clean", X.normalize_translation("target_sentence"))
    out = out.withColumn("source_token_count", X.word_count("source_sentence_clean")).withColumn("target_token_count", X.word_count("target_sentence_clean"))
    return out.filter("source_token_count > 0 AND target_token_count > 0").withColumn("is_training_ready", F.lit(1))


def high_confidence(pairs: DataFrame) -> DataFrame:
    """FLT-11: pairs whose boundary was searched for and whose first word is the marker."""
    return pairs.filter("first_word_match = 1 AND boundary_method = 'marker_search'")


def clues(markers: DataFrame, order: list[str], columns: list[str], key: str = "text_uuid") -> DataFrame:
    """SRT-03: key, clues: a document's markers as an array, by the first of the order columns that exists, then all others."""
    by = [c for c in order if c in markers.columns][:1] + columns
    sort = F.struct(*[F.struct(F.col(c).isNull().alias("n"), F.col(c).alias("v")).alias(f"o{k}") for k, c in enumerate(by)])
    grouped = markers.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(sort.alias("o"), F.struct(*columns).alias("c")))).alias("m"))
    return grouped.select(key, F.transform("m", lambda m: m["c"]).alias("clues"))


# ---- replies of an aligning model -------------------------------------------------------------------------------

VERDICTS = "array<struct<pair_index: int, reason: string, source: string, target: string, source_pos: int, target_pos: int>>"
# The reasons in the order of the tests.
REASONS = ("empty_source_or_target", "not_exact_substring", "duplicate_pair", "order_position_not_found", "near_duplicate_overlap")


def judge_pairs(pairs: list[tuple[str, str]], source: str, target: str, known: set[tuple[str, str]], overlap: float = 0.95) -> Iterator[tuple[int, str, str, str, int, int]]:
    """ALN-06: for each pair in turn ``accepted`` or the first test that it fails. Order and overlap are held against the
    last *accepted* pair, so the tests are a fold."""
    seen, src_at, tgt_at, last = set(known), -1, -1, frozenset()
    for k, (a, b) in enumerate(pairs, 1):
        src, tgt, reason = -1, -1, "accepted"
        if not a or not b:
            reason = REASONS[0]
        elif a not in source or b not in target:
            reason = REASONS[1]
        elif (a, b) in seen:
            reason = REASONS[2]
        else:
            src, tgt = source.find(a, src_at + 1), target.find(b, tgt_at + 1)
            tokens = frozenset(a.lower().split())
            if src < 0 or tgt < 0:
                reason = REASONS[3]
            elif last and tokens and len(tokens & last) / len(tokens | last) >= overlap:
                reason = REASONS[4]
            else:
                seen.add((a, b))
                src_at, tgt_at, last = src, tgt, tokens
        yield k, reason, a, b, src if reason == "accepted" else -1, tgt if reason == "accepted" else -1


def _judge(overlap: float):
    @F.pandas_udf(VERDICTS)
    def judge(sources: pd.Series, targets: pd.Series, doc_sources: pd.Series, doc_targets: pd.Series, known_sources: pd.Series, known_targets: pd.Series) -> pd.Series:
        out = []
        for a, b, s, t, ks, kt in zip(sources, targets, doc_sources, doc_targets, known_sources, known_targets):
            got = judge_pairs(list(zip(a, b)), s, t, set(zip(ks, kt)), overlap)
            out.append([dict(zip(("pair_index", "reason", "source", "target", "source_pos", "target_pos"), v)) for v in got])
        return pd.Series(out)

    return judge


def validated_pairs(replies: DataFrame, overlap: float = 0.95, pass_name: str = "first") -> DataFrame:
    """ALN-06: a row for each proposed pair with its verdict.

    ``replies``: oare_id, transliteration, translation, pairs (array of structs as in ALIGNMENT_REPLY), and optionally
    known (array of struct<source, target>: pairs that an earlier pass accepted).
    """
    known = F.col("known") if "known" in replies.columns else F.array().cast("array<struct<source: string, target: string>>")
    pairs = F.coalesce("pairs", F.array().cast("array<struct<source_sentence: string, target_sentence: string, source_method: string, target_method: string, confidence: string, note: string>>"))
    rows = replies.withColumn("pairs", pairs).withColumn("__known", known)
    side = lambda f: F.transform("pairs", lambda p: X.collapse_space(p[f]))
    verdicts = _judge(overlap)(side("source_sentence"), side("target_sentence"), X._text("transliteration"), X._text("translation"), F.transform("__known", lambda p: p["source"]), F.transform("__known", lambda p: p["target"]))
    flat = rows.withColumn("v", verdicts).select("oare_id", "transliteration", "translation", F.explode(F.arrays_zip("v", "pairs")).alias("x"))
    v, p = F.col("x.v"), F.col("x.pairs")
    return flat.select(
        "oare_id", v["pair_index"].alias("pair_index"), F.lit(pass_name).alias("alignment_pass"), v["reason"].alias("reason"), v["source"].alias("source_sentence_raw"), v["target"].alias("target_sentence_raw"),
        F.coalesce(F.nullif(X.collapse_space(p["source_method"]), F.lit("")), F.lit("inferred")).alias("source_method"), F.coalesce(F.nullif(X.collapse_space(p["target_method"]), F.lit("")), F.lit("inferred")).alias("target_method"),
        p["confidence"].try_cast("double").alias("alignment_confidence"), X.collapse_space(p["note"]).alias("alignment_note"), v["source_pos"].alias("source_pos"), v["target_pos"].alias("target_pos"), "transliteration", "translation",
    )


def aligned_pairs(verdicts: DataFrame) -> DataFrame:
    """FLT-08: accepted pairs, cleaned (tags lose their brackets), with words on both sides."""
    out = verdicts.filter("reason = 'accepted'").withColumn("source_sentence_clean", X.normalize_transliteration("source_sentence_raw", keep_gap_tags=False)).withColumn("target_sentence_clean", X.normalize_translation("target_sentence_raw"))
    return out.filter("source_sentence_clean <> '' AND target_sentence_clean <> ''").withColumnsRenamed({"transliteration": "doc_transliteration", "translation": "doc_translation"}).drop("reason")


def two_passes(docs: DataFrame, first: DataFrame, second: DataFrame, overlap: float = 0.95) -> DataFrame:
    """ALN-08: verdicts of both passes; the second may not repeat what the first accepted, and is held against the whole
    document. ``docs``: oare_id, transliteration, translation; ``first`` and ``second``: oare_id, reply (text)."""
    parsed = lambda r: docs.join(r, "oare_id").withColumn("pairs", J.parse_reply("reply", J.ALIGNMENT_REPLY)["pairs"])
    one = validated_pairs(parsed(first), overlap, "first")
    known = one.filter("reason = 'accepted'").groupBy("oare_id").agg(F.collect_list(F.struct(F.col("source_sentence_raw").alias("source"), F.col("target_sentence_raw").alias("target"))).alias("known"))
    again = parsed(second).join(known, "oare_id", "left").withColumn("known", F.coalesce("known", F.array().cast("array<struct<source: string, target: string>>")))
    return one.unionByName(validated_pairs(again, overlap, "second"))


def alignment_status(docs: DataFrame, replies: DataFrame, verdicts: DataFrame, markers: DataFrame | None = None) -> DataFrame:
    """ALN-15, AGG-08, AGG-09: the counts and leftovers of every document that was sent."""
    parsed = replies.withColumn("r", J.parse_reply("reply", J.ALIGNMENT_REPLY))
    per = verdicts.groupBy("oare_id").agg(
        F.count_if(F.expr("reason = 'accepted' AND alignment_pass = 'first'")).alias("accepted_first_pass_pairs"),
        F.count_if(F.expr("reason = 'accepted' AND alignment_pass = 'second'")).alias("second_pass_added_pairs"),
        *[F.count_if((F.col("reason") == r) & (F.col("alignment_pass") == "first")).alias(n) for r, n in zip(REASONS, ("rejected_empty", "rejected_not_substring", "rejected_duplicate", "rejected_order", "rejected_overlap"))],
    )
    out = docs.select("oare_id").join(parsed, "oare_id").join(per, "oare_id", "left")
    counts = [c for c in per.columns if c != "oare_id"]
    out = out.select("oare_id", F.when(F.col("r").isNull(), "llm_error").otherwise("completed").alias("status"), X._text("r.leftover_source_text").alias("leftover_source_text"), X._text("r.leftover_target_text").alias("leftover_target_text"), *[F.coalesce(c, F.lit(0)).cast("int").alias(c) for c in counts])
    out = out.withColumn("produced_pairs", F.col("accepted_first_pass_pairs") + F.col("second_pass_added_pairs"))
    if markers is not None:
        clues = markers.groupBy(F.col("text_uuid").alias("oare_id")).agg(F.count("*").cast("int").alias("expected_clue_rows"))
        out = out.join(clues, "oare_id", "left").fillna(0, ["expected_clue_rows"])
    return out


def validation_issues(verdicts: DataFrame) -> DataFrame:
    return verdicts.filter("reason <> 'accepted'").select("oare_id", F.col("alignment_pass").alias("pass"), "pair_index", "reason", F.col("source_sentence_raw").alias("source"), F.col("target_sentence_raw").alias("target"))


def leftovers(status: DataFrame) -> DataFrame:
    return status.filter("leftover_source_text <> '' OR leftover_target_text <> ''").select("oare_id", "leftover_source_text", "leftover_target_text", F.length("leftover_source_text").alias("leftover_source_chars"), F.length("leftover_target_text").alias("leftover_target_chars"), F.col("accepted_first_pass_pairs").alias("first_pass_accepted_pairs"), "second_pass_added_pairs")
