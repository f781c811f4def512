"""Model replies: tolerant JSON parsing, prompts and payloads as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, _text, collapse_space_ends, let, strip_fences

# The fields of the two kinds of reply. Scalars are read as text and cast later, so that one field of
# another type does not lose the rest.
REPLY = (
    "found string, oare_id string, source_pdf string, source_page string, language_detected string, confidence string, translation_extracted string, "
    "translation_english string, llm_opinion string, akkadian_from_page_text array<string>, pairs array<struct<source_sentence: string, target_sentence_english: string>>, evidence string, notes string"
)
ALIGNMENT_REPLY = (
    "oare_id string, pairs array<struct<source_sentence: string, target_sentence: string, source_method: string, target_method: string, confidence: string, note: string>>, "
    "leftover_source_text string, leftover_target_text string"
)


def _object(text: Column) -> Column:
    """The text if it is one JSON object, else null."""
    return F.when(text.startswith("{") & F.try_parse_json(text).isNotNull(), text)


def json_object(c: Column | str, fenced: bool = True) -> Column:
    """JSN-01 (``fenced``) and JSN-02: the JSON object in a reply as text: all of it, or what the first and the last
    brace enclose; null if neither is one. Lists and scalars are no objects."""
    whole = strip_fences(c) if fenced else collapse_space_ends(_text(c))
    return let(whole, lambda w: F.coalesce(_object(w), let(F.regexp_extract(w, r"(?s)\{.*\}", 0), _object)))


def parse_reply(c: Column | str, schema: str = REPLY, fenced: bool = True) -> Column:
    """A struct of ``schema``, null if the reply holds no object. Unknown fields are left out."""
    return let(json_object(c, fenced), lambda found: F.when(found.isNotNull(), F.from_json(found, schema)))


def number_or_zero(c: Column | str) -> Column:
    """JSN-05."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def true_flag(c: Column | str) -> Column:
    """A reply's boolean: ``true`` in any case, as a word or a JSON value; all else is false."""
    return F.coalesce(F.lower(collapse_space_ends(_text(c))) == "true", F.lit(False))


def alignment_payload(oare_id: Column | str, source: Column | str, target: Column | str, clues: Column | str, task: str, rules: list[str]) -> Column:
    """JSN-03: a document with its clues (an array of structs) and the instructions as JSON; other scripts stay readable."""
    instructions = F.struct(F.lit(task).alias("task"), F.array(*map(F.lit, rules)).alias("hard_rules"), F.lit(ALIGNMENT_REPLY).alias("output_json_schema"))
    document = F.struct(_col(oare_id).alias("oare_id"), _text(source).alias("full_transliteration"), _text(target).alias("full_translation"), _col(clues).alias("sentence_clues"))
    return F.to_json(F.struct(instructions.alias("instructions"), document.alias("document")))


def page_prompt(template: str, **columns: Column | str) -> Column:
    """JSN-04: a prompt from a template whose ``{name}`` marks are replaced by columns, each as text."""
    out: list[Column] = []
    rest = template
    while rest:
        at = min((i for i in (rest.find("{" + n + "}") for n in columns) if i >= 0), default=-1)
        if at < 0:
            out.append(F.lit(rest))
            break
        name = rest[at + 1 : rest.index("}", at)]
        out += [F.lit(rest[:at]), _text(columns[name])]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*out)


#: The page's facts in the order that a reader of the prompt needs them; the wording is this package's own.
PAGE_TEMPLATE = """Tablet {oare_id}, page {page} of {pdf_name} (matched by {match_source}, confidence {match_confidence}).
Transliteration:
{transliteration}
Page text:
{page_text}
Reply with one JSON object and nothing else. Fields: found, oare_id, source_pdf, source_page, language_detected, confidence, translation_extracted, translation_english, llm_opinion, akkadian_from_page_text, pairs [source_sentence, target_sentence_english], evidence, notes.
If the page holds no reliable translation of this tablet, set found to false."""
