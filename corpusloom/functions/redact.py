"""Redaction of identifying spans as a chain of JVM-side replacements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .charclasses import DECIMAL, NOT_AFTER_WORD, NOT_BEFORE_WORD, SPACE, WORD
from .text import as_text

# Capitalised words that are not personal names.
COMMON_WORDS = """
I I'm I'll I've A An The This That These Those There Here It Its
You Your Yours We Our Us They Their He She Him Her His Hers My Mine Me
And But Or So If Then Than When While Because As At By For From In Into
Of On To With Without Up Down Out Off Over Under Again Just Now Not No
Yes Ok Okay Hi Hey Hello Bye Thanks Thank Please Sorry Call Text Send
Free Win Won Winner Urgent Claim Prize Cash Offer Reply Stop Mobile
Phone Msg Message Txt Sms Congratulations Congrats Guaranteed Award
Customer Service Network Contact Ltd Box Po Pobox Valid Only New Latest
Do Don't Can Can't Will Won't Would Should Could Have Has Had Am Are Is
Was Were Be Been Being Get Got Go Going Come Coming See Know Let Make
Good Great Nice Love Like Want Need Time Day Today Tomorrow Tonight
Monday Tuesday Wednesday Thursday Friday Saturday Sunday
""".split()

_D = f"[{DECIMAL}]"
# Fixed values, in order: an address before the URL rule, a phone number before money and
# plain numbers. The e-mail run may only start where a run starts (or where the
# last match ended), so a long unbroken token is scanned once.
SPANS = (
    (
        rf"(?:(?<![.+{WORD}-])|\G)[.+{WORD}-]++@[{WORD}-]++\.[.{WORD}]++",
        "<EMAIL>",
    ),
    (rf"(?:(?iu:https?)://|(?iu:www)\.)[^{SPACE}]+", "<URL>"),
    (rf"\+?{_D}[{SPACE}{DECIMAL}-]{{4,}}{_D}", "<PHONE>"),
    (rf"[£$€¥₹][{SPACE}]?{_D}+(?:[.,]{_D}+)?", "<MONEY>"),
    (rf"(?={_D}){NOT_AFTER_WORD}{_D}+(?:[.,]{_D}+)?{NOT_BEFORE_WORD}", "<NUM>"),
)


# Runs of white space other than one plain space.
_LOOSE_SPACE = f"[{SPACE}&&[^ ]][{SPACE}]*+| [{SPACE}]++"


def mask_names(col: Column, allowed: list[str] | tuple[str, ...] = tuple(COMMON_WORDS)) -> Column:
    """Capitalised words of three letters or more become <NAME> unless allowed.

    An entry with an apostrophe never equals a whole word run, so `Don't` reads
    as `<NAME>'t`; pass the stem (`Don`) in `allowed` to keep it.
    """
    keep = "|".join(sorted(w for w in set(allowed) if w.isalpha() and len(w) > 2))
    guard = f"(?!(?:{keep}){NOT_BEFORE_WORD})" if keep else ""
    return F.regexp_replace(
        col, rf"(?=[A-Z]){NOT_AFTER_WORD}{guard}[A-Z][a-z]{{2,}}+{NOT_BEFORE_WORD}", "<NAME>"
    )


def redact(
    col: Column,
    *,
    max_chars: int = 70,
    names: bool = True,
    allowed: list[str] | tuple[str, ...] = tuple(COMMON_WORDS),
) -> Column:
    (email, email_mark), *others = SPANS
    text = as_text(col)
    # Most texts hold no address at all, and looking for the sign is cheap.
    text = F.when(text.contains("@"), F.regexp_replace(text, email, email_mark)).otherwise(text)
    for pattern, placeholder in others:
        text = F.regexp_replace(text, pattern, placeholder)
    if names:
        text = mask_names(text, allowed)
    text = F.trim(F.regexp_replace(text, _LOOSE_SPACE, " "))
    cut = F.rtrim(F.substring(text, 1, max_chars - 1))
    return F.when(F.length(text) > max_chars, F.concat(cut, F.lit("…"))).otherwise(text)


def keeps_digit_run(col: Column) -> Column:
    """True where three or more digits in a row are still readable."""
    return as_text(col).rlike(r"\p{Nd}{3,}")
