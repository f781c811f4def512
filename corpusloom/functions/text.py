"""Text cleaning as column expressions: nothing here leaves the JVM.

White space is Unicode white space and U+001C to U+001F throughout. A null input gives the empty string unless a
function says otherwise; a caller that must tell the two apart tests for null first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]"


#: Word characters are letters, numbers of any kind (fractions and subscripts too) and the underscore; ``\\w`` and ``\\b`` of the
#: regular expressions here would leave those numbers out. What a match begins with comes before what may not stand before it.
WORD = r"[a-zA-Z0-9_\p{L}\p{N}]"
START, END = f"(?<!{WORD})", f"(?!{WORD})"

# Characters and marks of the transliteration scheme.
SUBSCRIPTS = ("₀₁₂₃₄₅₆₇₈₉ₓ", "0123456789x")
GAP, BIG_GAP = "<gap>", "<big_gap>"
COMMODITIES = {
    "KÙ.BABBAR": "silver", "KU.BABBAR": "silver", "AN.NA": "tin", "MA.NA": "mina", "GÍN": "shekel", "GIN": "shekel",
    "TÚG": "textile", "TUG": "textile", "GADA": "linen", "ŠE": "barley", "SE": "barley", "URUDU": "copper",
    "ANŠE": "donkey", "É": "house", "DUMU": "son", "DUMU.MUNUS": "daughter",
}
FRACTION_GLYPHS = {"0.8333": "⅚", "0.6666": "⅔", "0.3333": "⅓", "0.1666": "⅙", "0.625": "⅝", "0.75": "¾", "0.25": "¼", "0.5": "½"}
SNAPPED_DECIMALS = ((1 / 6, "16666"), (1 / 4, "25"), (1 / 3, "33333"), (1 / 2, "5"), (2 / 3, "66666"), (3 / 4, "75"), (5 / 6, "83333"))
GAP_FORMS = rf"(?iU)(?=[<.…\[x])(?:<\s*gap\s*>|\.{{3,}}|…+|\[\.+\]|{START}x{END})"
GAP_FORMS_WIDE = rf"(?iU)(?=[<.…\[(xb])(?:<\s*big[\s_\-]*gap\s*>|<\s*gap\s*>|{START}big[\s_\-]*gap{END}|{START}x(?:\s+x)+{END}|\.{{3,}}|…+|\[\.+\]|\[\s*x\s*\]|\(\s*x\s*\)|{START}x{{2,}}{END}|{START}x{END}|\(\s*large\s+break\s*\)|\(\s*break\s*\)|\(\s*\d+\s+broken\s+lines?\s*\))"
CDLI_ID = rf"(?iU)(?=P){START}P\d{{5,7}}{END}"
PUBLICATION_REF = rf"(?iU)(?=[A-Z]){START}(?:BM\s*\d{{3,8}}|[A-Z]{{2,8}}\s*[IVXLC0-9]{{0,4}}\s*\d{{1,6}}[A-Z]{{0,2}}){END}"
#: The same two as SQL engines with RE2 read them: word characters, digits and white space are ASCII, so a letter with an accent ends
#: a word; of other letters only the two that fold to S and K count as letters.
_ASCII = "[a-zA-Z0-9_]"
_EDGE = f"(?:(?<={_ASCII})(?!{_ASCII})|(?<!{_ASCII})(?={_ASCII}))"
CDLI_ID_ASCII = rf"(?=[Pp]){_EDGE}[Pp][0-9]{{5,7}}{_EDGE}"
PUBLICATION_REF_ASCII = rf"(?=[A-Za-z\u017f\u212a]){_EDGE}(?:[Bb][Mm][\t\n\f\r ]*[0-9]{{3,8}}|[A-Za-z\u017f\u212a]{{2,8}}[\t\n\f\r ]*[IVXLCivxlc0-9]{{0,4}}[\t\n\f\r ]*[0-9]{{1,6}}[A-Za-z\u017f\u212a]{{0,2}}){_EDGE}"
PERSON = rf"PN(?<!{WORD}PN){END}"
REPEATED_WORDS = rf"(?U){START}({WORD}++)(?:\s+\1{END})+"
LONG_DECIMAL = rf"(?U)(?=\d)(?<!{WORD}|/)\d++\.\d{{4,}}+(?!{WORD}|/)"
PROMPT_PREFIX = "translate Akkadian to English: "
FORBIDDEN = "()——<>⌈⌋⌊[]+ʾ;"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _text(c: Column | str) -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def _sub(c: Column, pattern: str, by: str) -> Column:
    return F.regexp_replace(c, pattern, by)


def collapse_space(c: Column | str) -> Column:
    """STR-06: one blank for each run of white space, none at the ends."""
    return F.trim(_sub(_text(c), f"{SPACE}+", " "))


def words(c: Column | str) -> Column:
    """STR-21: the runs of non-space characters, an empty array for none."""
    return F.filter(F.split(collapse_space(c), " "), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    """AGG-17."""
    return F.size(words(c))


def normalize_transliteration(c: Column | str, keep_gap_tags: bool = True) -> Column:
    """STR-01; STR-02 with ``keep_gap_tags=False``, where the tags lose their brackets."""
    v = F.translate(_text(c), "Ḫḫ", "Hh")
    # private-use characters stand for the tags while brackets are taken out
    gap, big = ("\ue000", "\ue001") if keep_gap_tags else ("gap", "big_gap")
    v = _sub(v, r"\[x\]", f" {gap} ")
    v = _sub(v, rf"\[{SPACE[4:]}*\.\.\.{SPACE[4:]}*\]|\.\.\.", f" {big} ")
    v = F.translate(v, SUBSCRIPTS[0] + "!?/:.[]<>", SUBSCRIPTS[1] + "     ")
    if keep_gap_tags:
        v = F.replace(F.replace(v, F.lit(gap), F.lit(GAP)), F.lit(big), F.lit(BIG_GAP))
    return collapse_space(v)


def normalize_translation(c: Column | str) -> Column:
    """STR-03."""
    return collapse_space(F.translate(_text(c), "<>", ""))


def token_for_match(c: Column | str, normalized: bool = False) -> Column:
    """STR-04; ``normalized``: the input has been through normalize_transliteration."""
    v = _col(c) if normalized else normalize_transliteration(c)
    return _sub(F.lower(v), r"[^a-z0-9šṣṭh\-]", "")


def compact_token(c: Column | str) -> Column:
    """STR-05: a token_for_match without hyphens."""
    return F.replace(token_for_match(c), F.lit("-"), F.lit(""))


def normalize_ref(c: Column | str) -> Column:
    """STR-07: upper-case letters and digits only."""
    return _sub(F.upper(collapse_space(c)), r"[^A-Z0-9]+", "")


def split_multi_value(c: Column | str) -> Column:
    """STR-08: the non-blank parts between bars."""
    return F.filter(F.transform(F.split(_text(c), r"\|"), collapse_space_ends), lambda x: x != "")


def collapse_space_ends(c: Column) -> Column:
    return _sub(c, f"^{SPACE}+|{SPACE}+$", "")


def cdli_ids(c: Column | str, ascii_words: bool = False) -> Column:
    """STR-09: sorted, distinct, upper case; ``ascii_words``: words as RE2 has them."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(_text(c), F.lit(CDLI_ID_ASCII if ascii_words else CDLI_ID), F.lit(0)), F.upper)))


def publication_refs(c: Column | str, ascii_words: bool = False) -> Column:
    """STR-10: sorted, distinct, in the form of normalize_ref; ``ascii_words``: words as RE2 has them."""
    found = F.transform(F.regexp_extract_all(_text(c), F.lit(PUBLICATION_REF_ASCII if ascii_words else PUBLICATION_REF), F.lit(0)), normalize_ref)
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x != "")))


def snippet(c: Column | str, needle: Column | str, radius: int = 240) -> Column:
    """STR-11: what surrounds the first match whatever the case; without one, the first ``2 * radius`` characters."""
    size = F.length(_col(needle))

    def cut(v: Column) -> Column:
        left = F.greatest(v["at"] - 1 - radius, F.lit(0))
        right = F.least(F.length(v["text"]), v["at"] - 1 + size + radius)
        return F.when(v["at"] > 0, F.substring(v["text"], left + 1, right - left)).otherwise(F.substring(v["text"], F.lit(1), F.lit(2 * radius)))

    return let(collapse_space(c), lambda t: let(F.struct(t.alias("text"), F.instr(F.upper(t), F.upper(_col(needle))).alias("at")), cut))


def first_sentence(c: Column | str) -> Column:
    """STR-12."""
    first = F.get(F.split(normalize_translation(c), r"(?<=[.!?])\s+"), F.lit(0))
    return let(first, lambda v: F.when(v == "", "unknown").when(F.substring(v, -1, 1).isin(".", "!", "?"), v).otherwise(F.concat(v, F.lit("."))))


def ascii_to_diacritics(c: Column | str) -> Column:
    """STR-13: sz, s-comma and t-comma to their letters, vowels before 2 and 3 to acute and grave."""
    v = _text(c)
    for plain, letter in (("sz", "š"), ("SZ", "Š"), ("s,", "ṣ"), ("S,", "Ṣ"), ("t,", "ṭ"), ("T,", "Ṭ")):
        v = F.replace(v, F.lit(plain), F.lit(letter))
    for digits, accented in (("[2₂]", "áéíúÁÉÍÚ"), ("[3₃]", "àèìùÀÈÌÙ")):
        for vowel, letter in zip("aeiuAEIU", accented):
            v = _sub(v, vowel + digits, letter)
    return v


def unify_gaps(c: Column | str, wide: bool = False) -> Column:
    """STR-14; STR-15 with ``wide``."""
    return _sub(_text(c), GAP_FORMS_WIDE if wide else GAP_FORMS, GAP)


def plain_characters(c: Column | str) -> Column:
    """STR-16."""
    return F.translate(_text(c), "ḫḪ₀₁₂₃₄₅₆₇₈₉—–ʾₓ", "hH0123456789--")


def _five_places(x: Column) -> Column:
    """A number with five decimals, rounded as the double that it is.

    ``format_string`` rounds the shortest decimal that stands for the double, half up, which is the same but where that
    decimal ends with a 5 in the sixth place. There the double itself is held against the decimal: its product with a million
    is taken in two exact parts, and of a true tie the even neighbour is the result. Numbers from 9e9 on have no such digits.
    """
    millionths = (x.cast("decimal(30,12)") * F.lit(1_000_000)).cast("decimal(38,6)")
    n = millionths.cast("long")
    tie = (x < 9e9) & (millionths == n) & (n % 10 == 5)
    big = x * 134217729.0  # 2^27 + 1: the upper half of the double's digits, and the rest
    high = big - (big - x)
    over = (high * 1e6 - n.cast("double")) + (x - high) * 1e6
    down = ((n - n % 10) / 10).cast("long")
    rounded = down + F.when(over > 0, 1).when(over < 0, 0).otherwise(down % 2)
    whole = ((rounded - rounded % 100_000) / 100_000).cast("long")
    return F.when(tie, F.concat(whole.cast("string"), F.lit("."), F.lpad((rounded % 100_000).cast("string"), 5, "0"))).otherwise(F.format_string("%.5f", x))


def _snapped(number: Column) -> Column:
    """The decimal text of a number: a near fraction as it is always written, else five places without final zeros."""
    x = number
    whole = F.floor(x + 1e-12)
    near = F.array(*[F.struct(F.abs(x - whole - F.lit(v)).alias("d"), F.lit(k).alias("k"), F.lit(t).alias("s")) for k, (v, t) in enumerate(SNAPPED_DECIMALS)])
    plain = _sub(let(x, _five_places), r"\.?0+$", "")
    return let(F.array_min(near), lambda best: F.when(best["d"] <= 2e-3, F.concat(whole.cast("string"), F.lit("."), best["s"])).otherwise(plain))


def snap_decimals(c: Column | str) -> Column:
    """STR-17: numbers of four or more decimals, each rewritten; the text between them stays.

    The text is cut at the numbers, so any number of matches is handled in one pass of array functions.
    """

    def rewrite(text: Column) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(LONG_DECIMAL), F.lit(0)), lambda x: let(x.cast("double"), _snapped))
        parts = F.zip_with(F.split(text, LONG_DECIMAL), found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        return F.when(text.rlike(LONG_DECIMAL), F.array_join(parts, "")).otherwise(text)

    return let(_text(c), rewrite)


def commodity_hints(c: Column | str) -> Column:
    """STR-18 and AGG-14: the text with the first four different commodities named in it."""

    def hinted(text: Column) -> Column:
        named = let(F.upper(text), lambda u: F.array(*[F.when(F.contains(u, F.lit(k.upper())), F.lit(v)) for k, v in COMMODITIES.items()]))
        first = F.slice(F.array_distinct(F.filter(named, lambda x: x.isNotNull())), 1, 4)
        return let(first, lambda f: F.when(F.size(f) > 0, F.concat(text, F.lit(" [Commodities: "), F.array_join(f, ", "), F.lit("]"))).otherwise(text))

    return let(_text(c), hinted)


def fraction_glyphs(c: Column | str) -> Column:
    """STR-20: written decimals to fraction characters, the longer ones first and wherever they stand."""
    return reduce(lambda v, kv: F.replace(v, F.lit(kv[0]), F.lit(kv[1])), FRACTION_GLYPHS.items(), _text(c))


def preprocess(c: Column | str, prefix: str = PROMPT_PREFIX) -> Column:
    """STR-13 to STR-18 and PRJ-07 in their order."""
    v = collapse_space(snap_decimals(plain_characters(unify_gaps(ascii_to_diacritics(c), wide=True))))
    return F.concat(F.lit(prefix), commodity_hints(v))


def _where(c: Column, mark: str, body: Callable[[Column], Column]) -> Column:
    """``body`` of texts that hold a mark, without which it changes nothing."""
    return let(c, lambda t: F.when(F.contains(t, F.lit(mark)), body(t)).otherwise(t))


def postprocess(c: Column | str) -> Column:
    """STR-19."""
    v = _where(_text(c), "[", lambda t: _sub(t, r"(?iU)\s*\[Commodities:[^\]]*\]", ""))
    v = _where(unify_gaps(v, wide=True), "PN", lambda t: _sub(t, PERSON, GAP))
    v = _where(_where(v, "0.", fraction_glyphs), GAP, lambda t: _sub(t, r"(?U)(?:<gap>\s*){2,}", GAP))
    v = F.replace(F.translate(F.replace(v, F.lit(GAP), F.lit("\ue000")), FORBIDDEN, ""), F.lit("\ue000"), F.lit(f" {GAP} "))
    v = _sub(v, REPEATED_WORDS, "$1")
    v = _sub(_sub(v, r"(?U)\s+([.,:])", "$1"), r"([.,])\1+", "$1")
    return collapse_space(v)


def strip_fences(c: Column | str) -> Column:
    """STR-22: without a code fence around the text."""
    v = collapse_space_ends(_text(c))
    return collapse_space_ends(_sub(collapse_space_ends(_sub(v, r"^(?i)```(?:json)?", "")), r"```\z", ""))


def position(container: Column | str, part: Column | str, after: Column | int = -1) -> Column:
    """STR-23: the first 0-based place of a non-empty part beyond ``after``, -1 if there is none."""
    part = _col(part)
    start = F.greatest((F.lit(after) if isinstance(after, int) else after) + 1, F.lit(0))
    return F.when(F.length(part) > 0, F.position(part, _col(container), start + 1) - 1).otherwise(-1)


def truncate(c: Column | str, most: int) -> Column:
    """PRJ-08: the first ``most`` characters; 0 keeps all."""
    return F.substring(_text(c), 1, most) if most > 0 else _text(c)


def or_default(c: Column | str, default: str) -> Column:
    """PRJ-09: a text for blank results."""
    return let(_col(c), lambda v: F.when(collapse_space(v) == "", default).otherwise(v))


def estimated_tokens(c: Column | str) -> Column:
    """MTH-04: a quarter of the characters, at least 1 unless there are none."""
    n = F.length(_text(c))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 4))).cast("int")


def geometric_mean(a: Column | str, b: Column | str) -> Column:
    """MTH-03."""
    return F.sqrt(F.greatest(_col(a), F.lit(0.0)) * F.greatest(_col(b), F.lit(0.0)))


def word_index(c: Column | str, n: Column | str) -> Column:
    """MTH-01: a 1-based place of any type as a 0-based one within n words; null if it is no number, below 1 or n is 0."""
    i = F.floor(_col(c).try_cast("double")).cast("int") - 1
    return F.when((i >= 0) & (_col(n) > 0), F.least(i, _col(n) - 1))


def split_bucket(c: Column | str, salt: str) -> Column:
    """HSH-01: the MD5 of ``salt:id`` as a 128-bit number, modulo 10,000, a 32-bit word at a time."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), _col(c).cast("string")).cast("binary"))
    word = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
    return reduce(lambda acc, k: (acc * (2**32 % 10_000) + word(k)) % 10_000, range(1, 4), word(0) % 10_000).cast("int")


def split_name(c: Column | str, ratio: float, salt: str) -> Column:
    return F.when(split_bucket(c, salt) < int(ratio * 10_000), "valid").otherwise("train")


def join_slice(tokens: Column | str, start: Column, end: Column) -> Column:
    """ARR-01: the words from start (0-based) up to end, not included."""
    return F.array_join(F.slice(_col(tokens), start + 1, end - start), " ")


def char_ngrams(c: Column | str, n: int) -> Column:
    """ARR-02: all n-grams; a shorter text is its only one."""
    windows = lambda cs: F.transform(F.sequence(F.lit(1), F.greatest(F.size(cs) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(cs, i, n), ""))
    return let(_text(c), lambda v: F.when(F.length(v) < n, F.array(v)).otherwise(let(F.split(v, ""), windows)))


def padded_ngrams(c: Column | str, low: int = 3, high: int = 5) -> Column:
    """ARR-03: n-grams within each blank-padded word; a word with one window at some n gives it once and no longer ones."""

    def windows(padded: Column, n: int) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(padded) - n + 1, F.lit(1)))
        grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(n)))
        return grams if n == low else F.when(F.length(padded) >= n, grams).otherwise(F.array().cast("array<string>"))

    def grams(padded: Column) -> Column:
        return F.concat(*[windows(padded, n) for n in range(low, high + 1)])

    return F.flatten(F.transform(F.transform(words(c), lambda w: F.concat(F.lit(" "), w, F.lit(" "))), lambda p: grams(p)))


def token_set(c: Column | str) -> Column:
    """SET-07."""
    return F.array_distinct(words(F.lower(_text(c))))


def jaccard(a: Column, b: Column) -> Column:
    """SIM-01: of two arrays of distinct items; 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1)))


def run_id(at: Column | None = None) -> Column:
    """DAT-01: a run's id from its time in UTC, by default the query's own, which is one value for all rows."""
    utc = F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone())
    return F.date_format(utc, "yyyyMMdd'T'HHmmss'Z'")
