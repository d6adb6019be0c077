"""Column functions over text; all are built-in expressions, so whole stages stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() has it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: Thresholds of the flags of a whole filing and of its sections.
LOW_WORDS, HIGH_WORDS, LOW_ALPHA, DENSE_NON_ASCII, PARSED_WORDS = 5_000, 250_000, 0.5, 0.05, 1_000
REFERENCE_WORDS, OVER_WORDS, OVER_RATIO, MDNA_FLOOR, EXCERPT = 500, 50_000, 0.95, 100, 300
#: Fixed value: wording that points to another document instead of giving the section.
BY_REFERENCE = r"\bincorporated\b(?:\s+\w+){0,3}\s+by\b(?:\s+\w+){0,1}\s+reference\b|\bsee\s+our\s+proxy\b|\bannual\s+proxy\s+statement\b"
#: Typographic characters and their plain forms.
FOLDED = {"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "–": "-", "—": "-", "−": "-", " ": " "}


def tokens(text: Column) -> Column:
    """ASCII letter runs, lower-cased after matching; null text has none."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("[A-Za-z]+"), 0), F.lower)


def word_count(text: Column) -> Column:
    """Words between white space of any kind. No lambda: Spark counts anew for each use of an expression that has one."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("bigint")


def char_count(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit(""))).cast("bigint")


def share(text: Column, but: str, empty: float) -> Column:
    """Of the characters, the share that the pattern doesn't match."""
    return F.when(char_count(text) == 0, F.lit(empty)).otherwise(F.length(F.regexp_replace(text, but, "")) / F.length(text))


def non_letter_ratio(text: Column) -> Column:
    return 1 - share(text, r"[^\p{L}]+", 0.0)


def non_ascii_ratio(text: Column) -> Column:
    return share(text, r"[\x00-\x7f]+", 0.0)


def flags(*named: tuple[Column, str]) -> Column:
    """The names whose condition holds."""
    return F.array_compact(F.array(*(F.when(condition, F.lit(name)) for condition, name in named)))


def full_text_flags(text: Column) -> Column:
    m = full_measures(text)
    return measured_flags(m["words"], m["non_letter"], m["non_ascii"])


def measured_flags(words: Column, non_letter: Column, non_ascii: Column) -> Column:
    return flags((words < LOW_WORDS, "word_count_low"), (words > HIGH_WORDS, "word_count_high"), (non_letter > LOW_ALPHA, "low_alpha_ratio"), (non_ascii > DENSE_NON_ASCII, "non_ascii_dense"))


def fold_punctuation(text: Column) -> Column:
    plain = F.translate(text, "".join(FOLDED), "".join(FOLDED.values()))
    return F.regexp_replace(plain, "…", "...")


def strip(text: Column) -> Column:
    """As Python's str.strip()."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def collapse_space(text: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(text, r"[ \t]+", " "), r"\n{2,}", "\n\n"))


def parse_status(words: Column) -> Column:
    return F.when(words >= PARSED_WORDS, "ok").otherwise("parse_fail")


def full_measures(text: Column) -> dict[str, Column]:
    """What a whole filing's record takes from its text. As columns of their own they are taken once, where the text is read."""
    return {"words": word_count(text), "chars": char_count(text), "non_letter": non_letter_ratio(text), "non_ascii": non_ascii_ratio(text)}


#: The measures of a text that isn't there.
NO_FULL = {"words": 0, "chars": 0, "non_letter": 1.0, "non_ascii": 0.0}


def full_record(words: Column, chars: Column, non_letter: Column, non_ascii: Column) -> Column:
    """What is kept about a whole filing's text, of its measures."""
    return F.struct(parse_status(words).alias("status"), words.alias("word_count"), chars.alias("char_count"), F.round(non_letter, 4).alias("non_letter_ratio"), F.round(non_ascii, 4).alias("non_ascii_ratio"), measured_flags(words, non_letter, non_ascii).alias("suspicious_flags"))


def by_reference(text: Column) -> Column:
    return F.coalesce(text.rlike("(?iU)" + BY_REFERENCE), F.lit(False))


def section_measures(text: Column) -> dict[str, Column]:
    """What a section's record takes from its text, as full_measures()."""
    n = word_count(text)
    return {"words": n, "chars": char_count(text), "refers": (n < REFERENCE_WORDS) & by_reference(text), "excerpt": F.substring(F.coalesce(text, F.lit("")), 1, EXCERPT)}


#: The measures of a section that isn't there.
NO_SECTION = {"words": 0, "chars": 0, "refers": False, "excerpt": ""}


def section_record(text: Column, full_words: Column, floor: Column | int = 0, least: Column | int = PARSED_WORDS) -> Column:
    """Status and flags of one section."""
    return measured_section(**section_measures(text), full_words=full_words, floor=floor, least=least)


def measured_section(words: Column, chars: Column, refers: Column, excerpt: Column, full_words: Column, floor: Column | int = 0, least: Column | int = PARSED_WORDS) -> Column:
    """section_record() of the text's measures; the first rule that holds decides."""
    floor, least = (F.lit(x) if isinstance(x, int) else x for x in (floor, least))
    n = words
    whole = (full_words > 0) & (n > full_words * OVER_RATIO)
    status = F.when(chars == 0, "missing").when(refers, "incorp_ref").when(n < floor, "missing").when((n > OVER_WORDS) | F.coalesce(whole, F.lit(False)), "over_extracted").otherwise("ok")
    flag = F.when(chars == 0, F.lit(None)).when(refers, "incorp_ref_phrase").when(n < floor, "below_hard_floor").when(n > OVER_WORDS, "length_high").when(whole, "equal_to_full").when(n < least, "length_low")
    return F.struct(status.alias("status"), n.alias("word_count"), chars.alias("char_count"), F.array_compact(F.array(flag)).alias("suspicious_flags"), excerpt.alias("head_excerpt"))


def missing_record(flag: str) -> Column:
    """The record of a section that there is no text of."""
    return F.struct(F.lit("missing").alias("status"), F.lit(0).cast("bigint").alias("word_count"), F.lit(0).cast("bigint").alias("char_count"), F.array(F.lit(flag)).alias("suspicious_flags"), F.lit("").alias("head_excerpt"))


def risk_least(form: Column) -> Column:
    """Quarterly risk factors may be a sentence."""
    return F.when(form == "10-Q", 0).otherwise(PARSED_WORDS)


def filing_status(full: Column, risk: Column, mdna: Column) -> Column:
    good = (risk == "ok").cast("int") + (mdna == "ok").cast("int")
    return F.when(full != "ok", full).when((risk == "over_extracted") | (mdna == "over_extracted"), "section_fail").when(good == 2, "ok").when(good == 1, "partial").otherwise("section_fail")


def jump_ratio(now: Column, before: Column) -> Column:
    """Larger by smaller length, null if either is 0 or null."""
    return F.when((now > 0) & (before > 0), F.greatest(now, before) / F.least(now, before))
