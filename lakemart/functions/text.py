"""Notice text: boilerplate removal, tokens, shingles and set similarity, all as built-in expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- boilerplate ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class CleanRule:
    """A case-insensitive removal; ``title`` rules see the title only, the others title and body together.

    In a lower-case ASCII text whatever matches has a match of ``needs``, a plainer pattern, if one is given.
    """

    name: str
    pattern: str
    replacement: str = ""
    title: bool = False
    needs: str = ""


# The patterns of the notice portals' boilerplate.
TITLE_PREFIX = r"^(e-tender|nit for|tender notice|corrigendum)\s*[-:]*"
NPAS_PREAMBLE = r"GOVERNMENT OF INDIA -- NATIONAL PROCUREMENT AGGREGATION SERVICE[\s\S]*?(?=(Name of work:|$))"
SPC_PREAMBLE = r"STATE PROCUREMENT CELL -- CONSOLIDATED TENDER BULLETIN[\s\S]*?(?=(Name of work:|$))"
TERMS_BLOCK = r"STANDARD TERMS AND CONDITIONS APPLICABLE TO ALL NOTICES[\s\S]*?(?=(Name of work:|$))"
INSTRUCTIONS_BLOCK = (
    r"GENERAL INSTRUCTIONS TO BIDDERS \(REPRODUCED IN FULL IN EVERY BULLETIN ENTRY\)[\s\S]*?(?=(Name of work:|$))"
)
DISCLAIMER = r"Disclaimer:[\s\S]*$"
REFERENCE_LINE = r"(tender reference number|ref no|tender ref)[\s:]*([^\n\r]+)"
REFERENCE_NUMBER_LINE = r"tender reference number:\s*[^\n]+"
PORTAL_REFERENCE = r"\b(NPAS|SPC|PWD|TN|MC|ref|DEPA|MUNI)[-\d/A-Za-z]+"
PORTAL_REFERENCE_SHORT = r"\b(NPAS|SPC|PWD|TN|MC|ref)[-\d/A-Za-z]+"
PORTAL_REFERENCE_WITH_DIGIT = r"\b(NPAS|SPC|PWD|TN|MC|ref|DEPA|MUNI)[-/A-Za-z]*\d[-\d/A-Za-z]*"
INSTRUCTIONS_TO_RULE = r"GENERAL INSTRUCTIONS TO BIDDERS[\s\S]*?==================+"
TERMS_TO_RULE = r"STANDARD TERMS AND CONDITIONS[\s\S]*?------------------+"
PREFIX_NEEDS = "e-tender|nit for|tender notice|corrigendum"
REFERENCE_NEEDS = "tender ref|ref no"
PORTAL_NEEDS = r"\b(?:npas|spc|pwd|tn|mc|ref|depa|muni)[-0-9/a-z]"

_BODY = (
    CleanRule("national preamble", NPAS_PREAMBLE, needs="government of india"),
    CleanRule("state preamble", SPC_PREAMBLE, needs="state procurement cell"),
    CleanRule("disclaimer", DISCLAIMER, needs="disclaimer:"),
    CleanRule("reference line", REFERENCE_LINE, needs=REFERENCE_NEEDS),
)
_TAIL = (
    CleanRule("general instructions", INSTRUCTIONS_TO_RULE, needs="general instructions to bidders"),
    CleanRule("standard terms", TERMS_TO_RULE, needs="standard terms and conditions"),
)

RAW_RULES: tuple[CleanRule, ...] = ()
STANDARD_RULES = (
    CleanRule("title prefix", TITLE_PREFIX, title=True, needs=PREFIX_NEEDS), *_BODY,
    CleanRule("portal reference", PORTAL_REFERENCE, needs=PORTAL_NEEDS), *_TAIL,
)
# Without the title and portal reference rules.
BODY_RULES = (*_BODY, *_TAIL)
# Whole blocks up to the work name; references leave a blank behind.
BLOCK_RULES = (
    CleanRule("national preamble", NPAS_PREAMBLE, needs="government of india"),
    CleanRule("state preamble", SPC_PREAMBLE, needs="state procurement cell"),
    CleanRule("standard terms", TERMS_BLOCK, needs="standard terms and conditions"),
    CleanRule("general instructions", INSTRUCTIONS_BLOCK, needs="general instructions to bidders"),
    CleanRule("disclaimer", DISCLAIMER, needs="disclaimer:"),
    CleanRule("portal reference", PORTAL_REFERENCE_SHORT, " ", needs=PORTAL_NEEDS),
    CleanRule("reference number", REFERENCE_NUMBER_LINE, " ", needs="tender reference number:"),
    CleanRule("prefix", TITLE_PREFIX, " ", needs=PREFIX_NEEDS),
)
# Like the standard rules, but a portal reference has to contain a digit: ordinary words survive.
STRICT_RULES = tuple(
    CleanRule(r.name, PORTAL_REFERENCE_WITH_DIGIT, needs=r.needs) if r.name == "portal reference" else r for r in STANDARD_RULES
)


def cleaned(title: Column | None, body: Column, rules: Sequence[CleanRule], joiner: str = " ") -> Column:
    """Title and body as one text with the rules applied in order; a missing body is empty."""
    def apply(text: Column, rule: CleanRule) -> Column:
        return F.regexp_replace(text, F.lit("(?iU)" + rule.pattern), F.lit(rule.replacement))

    text = F.coalesce(body, F.lit(""))
    if title is not None:
        head = F.coalesce(title, F.lit(""))
        for rule in rules:
            if rule.title:
                head = apply(head, rule)
        text = F.concat(head, F.lit(joiner), text)
    whole, inside = text, [rule for rule in rules if not rule.title]
    for rule in inside:
        text = apply(text, rule)
    if not inside or not all(rule.needs for rule in inside):
        return text
    # Where no rule matches the whole text, none changes it for the next. Beyond ASCII, letters have case forms that lower() does not give.
    may = (F.octet_length(whole) != F.char_length(whole)) | F.rlike(F.lower(whole), F.lit("|".join(rule.needs for rule in inside)))
    return F.when(may, text).otherwise(whole)


# --- tokens and shingles -------------------------------------------------------------------------------
# No lambda below refers to a column outside its own arguments. The optimiser may copy an expression
# into a filter, and a lambda holding the whole token list would then rebuild it for every element.

TOKEN = "[a-z0-9]+"
UNICODE_WORD = r"[\p{L}\p{N}_]+"


def tokens(text: Column, pattern: str = TOKEN) -> Column:
    """Lower-case words; NULL has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def _windows(items: Column, k: int, join) -> Column:
    n = F.greatest(F.size(items) - F.lit(k - 1), F.lit(0))
    windows = F.slice(items, F.lit(1), n)
    for offset in range(1, k):
        windows = F.zip_with(windows, F.slice(items, F.lit(offset + 1), n), join)
    return windows


def word_shingles(words: Column, k: int) -> Column:
    """The set of k-word shingles; a text of fewer words is the set of its words."""
    runs = _windows(words, k, lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.when(F.size(words) >= k, runs).otherwise(words))


def hashed_shingles(shingles: Column) -> Column:
    """Shingles as sorted 64-bit values, for set operations."""
    return F.sort_array(F.transform(shingles, lambda s: F.xxhash64(s)))


def folded(text: Column) -> Column:
    """Lower-case text with runs of white space as one blank; NULL is empty."""
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+", " ")


def char_shingles(text: Column, k: int = 9) -> Column:
    """The set of k-character shingles after folding white space; a shorter text is its own shingle."""
    chars = F.split(folded(text), "")
    runs = _windows(chars, k, lambda a, b: F.concat(a, b))
    return F.array_distinct(F.when(F.char_length(folded(text)) >= k, runs).otherwise(F.array(folded(text))))


# --- similarity ----------------------------------------------------------------------------------------


def shared_count(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def jaccard_of_counts(shared: Column, size_a: Column, size_b: Column, empty_pair: float = 0.0) -> Column:
    """Jaccard from set sizes; ``empty_pair`` is the similarity of two empty sets."""
    union = size_a + size_b - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(float(empty_pair)))


def jaccard(a: Column, b: Column, empty_pair: float = 0.0) -> Column:
    return jaccard_of_counts(shared_count(a, b), F.size(a), F.size(b), empty_pair)


def containment(a: Column, b: Column) -> Column:
    """Shared part of the smaller set; 0 when it is empty."""
    smaller = F.least(F.size(a), F.size(b))
    return F.when(smaller > 0, shared_count(a, b) / smaller).otherwise(F.lit(0.0))
