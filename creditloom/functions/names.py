"""Column expressions that clean raw counterparty names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the cleaning rules, in the order in which they fire -------------------
PROCESSORS = (
    "SQ", "PAYPAL", "STRIPE", "SUMUP", "ZETTLE", "GOCARDLESS",
    "ADYEN", "AMZN", "GOOGLE", "MICROSOFT", "UBER", "MSFT",
)
LOCATION_CODES = (r"\s*#\d+\s*", r"\s*STORE\s*\d+\s*", r"\s*STATION\s*\d+\s*")
URL_FRAGMENTS = (r"HELP\.\w+\.COM", r"\*\w+\.COM")
DESCRIPTORS = (
    r"\bRETAIL\b", r"\bSUPERMARKET\b", r"\bEXPRESS\b", r"\bMETRO\b", r"\bLOCAL\b",
    r"\bONLINE\b", r"\bSUBSCRIPTION\b", r"\bMONTHLY\b", r"\bSTORE\s*\d+\b",
    r"\bSTATION\s*\d+\b", r"#\d+", r"\bSERVICES\b", r"\bTECHNOLOGIES\b", r"\bPAYMENTS\b",
    r"\bPAYMENT\b", r"\bBUSINESS\b", r"\bCENTRE\b", r"\bMANAGEMENT\b", r"\bMGMT\b",
    r"\bOFFICES\b",
)
LEGAL_FORMS = (
    "LTD", "LIMITED", "PLC", "LLP", "INC", "CORP", "CO", "UK", "BV", "SARL", "GMBH",
)
# -----------------------------------------------------------------------------------------

PROCESSOR_RULES = [(rf"^{name}\s*\*+\s*", "") for name in PROCESSORS]
CODE_RULES = [(pattern, " ") for pattern in LOCATION_CODES]
URL_RULES = [(pattern, "") for pattern in URL_FRAGMENTS]
DESCRIPTOR_RULES = [(pattern, "") for pattern in DESCRIPTORS]
LEGAL_RULES = [(rf"\b{form}\.?\s*$", "") for form in LEGAL_FORMS]
EDGE_SPACE_RULES = [(r"^\s+|\s+$", "")]
PUNCTUATION_RULES = [(r"[^A-Z0-9\s]", ""), (r"\s+", " "), (r"^\s+|\s+$", "")]


def apply_rules(text: Column, rules, ignore_case: bool = True) -> Column:
    """Fold an ordered list of (pattern, replacement) rules over one column.

    Character classes are Unicode-aware, so a no-break space counts as white space.
    """
    flags = "(?iU)" if ignore_case else "(?U)"
    return reduce(lambda c, r: F.regexp_replace(c, flags + r[0], r[1]), rules, text)


def upper_stripped(raw: Column) -> Column:
    return apply_rules(F.upper(F.coalesce(raw, F.lit(""))), EDGE_SPACE_RULES)


def strip_processor(name: Column) -> Column:
    return apply_rules(name, PROCESSOR_RULES)


def strip_codes(name: Column) -> Column:
    return apply_rules(name, CODE_RULES)


def strip_urls(name: Column) -> Column:
    return apply_rules(name, URL_RULES)


def strip_descriptors(name: Column) -> Column:
    return apply_rules(name, DESCRIPTOR_RULES)


def strip_legal(name: Column) -> Column:
    return apply_rules(name, LEGAL_RULES)


def clean_punctuation(name: Column) -> Column:
    return apply_rules(name, PUNCTUATION_RULES, ignore_case=False)


def normalise_name(raw: Column) -> Column:
    """Whole cascade; null and empty names give the empty string."""
    steps = (strip_processor, strip_codes, strip_urls, strip_descriptors, strip_legal, clean_punctuation)
    return reduce(lambda c, step: step(c), steps, upper_stripped(raw))
