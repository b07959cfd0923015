"""Column expressions over free text. Everything stays inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from citeloom.functions.fixed import (
    EMAIL_PATTERN,
    INSTITUTION_KEYWORDS,
    ZIPCODE_PATTERN,
)

# A leftmost match can only start where a run of local-part characters starts,
# so each run is tried once. Keeps long junk runs without an "@" linear.
_EMAIL_SCAN = r"(?<![a-zA-Z0-9._%+-])" + EMAIL_PATTERN

# Letters, digits, underscore and hyphen belong to a word; a country name must
# not start or end inside one.
_WORD = r"[\p{L}\p{N}_-]"


# Each sign that would break a line, and the backslash, as a backslash and a letter.
_BREAKS = (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"))


def escape_breaks(text: Column) -> Column:
    """The text on one line; ``restore_breaks`` gives it back."""
    for raw, code in _BREAKS:
        text = F.replace(text, F.lit(raw), F.lit(code))
    return text


def restore_breaks(text: Column) -> Column:
    """What ``escape_breaks`` was given. The backslash comes last, so that it starts no new code."""
    for raw, code in reversed(_BREAKS):
        text = F.replace(text, F.lit(code), F.lit(raw))
    return text


def email(text: Column) -> Column:
    """First e-mail address in the text, null when there is none."""
    return F.regexp_substr(text, F.lit(_EMAIL_SCAN))


def zipcode(text: Column, postal_pattern: str = ZIPCODE_PATTERN) -> Column:
    """First postal code in the text, ignoring case, null when there is none.

    ``(?U)`` makes word boundaries and digits follow Unicode on every JDK.
    """
    return F.regexp_substr(text, F.lit("(?iU)" + postal_pattern))


def title_case(text: Column) -> Column:
    """Upper-case each letter that follows a non-letter, lower-case the rest.

    Unlike ``initcap`` this also restarts after hyphens and other punctuation.
    """
    pieces = F.split(F.lower(text), r"(?<![\p{L}])(?=\p{L})")
    raised = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))
    )
    return F.array_join(raised, "")


def matchable_names(names: Iterable[str], include_unmatchable: bool = False) -> list[str]:
    """Names that a title-cased mention can equal.

    A name such as ``UK`` is not its own title case, so the membership rule
    never finds it; ``include_unmatchable`` keeps it anyway. A mention has no
    space around it, so neither has a name that can match.
    """
    kept = dict.fromkeys(n for n in names if n and n == n.strip())
    return [n for n in kept if include_unmatchable or n == n.title()]


def _is_word(char: str) -> bool:
    return re.match(r"[\w-]", char) is not None


def _backwards(names: Sequence[str]) -> str:
    """Reversed names as one regex branch per last character, longest name first inside it.

    A name must not begin or end inside a word; at an edge that is no word
    character there is nothing to check. Branches that check both edges, nearly
    all, share the checks.
    """
    turned = sorted({n[::-1] for n in names}, key=lambda n: (n[0].lower(), -len(n), n))
    shared, single = [], []
    for last, group in groupby(turned, key=lambda n: n[0].lower()):
        tails = [(re.escape(n[1:]), _is_word(n[-1])) for n in group]
        if _is_word(last[0]) and all(word for _, word in tails):
            shared.append(f"{re.escape(last)}(?:{'|'.join(t for t, _ in tails)})")
            continue
        rest = "|".join(t + (rf"(?!{_WORD})" if word else "") for t, word in tails)
        before = rf"(?<!{_WORD})" if _is_word(last[0]) else ""
        single.append(f"{before}{re.escape(last)}(?:{rest})")
    if shared:
        single.insert(0, rf"(?<!{_WORD})(?:{'|'.join(shared)})(?!{_WORD})")
    return "|".join(single)


def last_mention(text: Column, names: Iterable[str], include_unmatchable: bool = False) -> Column:
    """Raw text of the mention that ends last (the longest one on a tie), in any case.

    The text and the names are reversed, so the first match of the scan is the
    last mention and the scan stops there: no explode, no shuffle.
    """
    kept = matchable_names(names, include_unmatchable)
    if not kept:
        return F.lit(None).cast("string")
    return F.reverse(F.regexp_substr(F.reverse(text), F.lit(f"(?iu)(?:{_backwards(kept)})")))


def _segment_pattern(keywords: Sequence[str]) -> str:
    """A comma or semicolon separated segment that contains a keyword.

    Only a segment's first position can start a match, so each is read once.
    """
    words = "|".join(re.escape(k) for k in keywords)
    return rf"(?i)(?<![^,;])[^,;]*?(?:{words})[^,;]*"


def _trimmed(segment: Column) -> Column:
    return F.regexp_replace(segment, r"^\s+|\s+$", "")


def institution_mentions(
    text: Column, keywords: Sequence[str] = INSTITUTION_KEYWORDS
) -> Column:
    """Segments that contain a keyword, in order; null when there is none."""
    found = F.regexp_extract_all(text, F.lit(_segment_pattern(keywords)), F.lit(0))
    return F.nullif(F.transform(found, _trimmed), F.array().cast("array<string>"))


def first_institution(text: Column, keywords: Sequence[str] = INSTITUTION_KEYWORDS) -> Column:
    """First segment that contains a keyword, null when there is none."""
    return _trimmed(F.regexp_substr(text, F.lit(_segment_pattern(keywords))))
