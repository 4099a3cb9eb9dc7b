"""Text functions as native column expressions.

Patterns spell out Unicode classes, as Java's defaults cover ASCII alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

_SP = C.SPACE
_WRAP = rf"[{_SP}\\\\\"'“”«»]+"
_LETTER = r"A-Za-zÀ-ÖØ-öø-ÿ"
_FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_FOLD_TO = "aaaaaaceeeeiiiinooooouuuuyy"


def once(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a column whose value is computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def strip(x: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(x, rf"^[{_SP}]+|[{_SP}]+$", "")


def squeeze(x: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(x, rf"[{_SP}]+", " "))


def clean_text(x: Column) -> Column:
    """No-break spaces and C1 controls as spaces, then squeezed."""
    return F.trim(F.regexp_replace(x, rf"[\x{{80}}-\x{{9f}}{_SP}]+", " "))


def non_empty(x: Column) -> Column:
    return x.isNotNull() & (strip(x) != "")


def blank_to_null(x: Column) -> Column:
    return F.nullif(strip(x), F.lit(""))


def strip_wrappers(x: Column) -> Column:
    """Without quotes, backslashes and white space around, squeezed; null becomes empty."""
    return squeeze(F.coalesce(F.regexp_replace(x, f"^{_WRAP}|{_WRAP}$", ""), F.lit("")))


def fold(x: Column) -> Column:
    """Lower case without Latin-1 accents; native stand-in for decomposition."""
    return F.translate(F.replace(F.replace(F.lower(x), F.lit("’"), F.lit("'")), F.lit("ß"), F.lit("ss")), _FOLD_FROM, _FOLD_TO)


def simple_key(x: Column, oe: bool = False) -> Column:
    """Folded, each run of other than a-z and 0-9 as one space; ``oe`` spells œ out."""
    folded = F.replace(fold(x), F.lit("œ"), F.lit("oe")) if oe else fold(x)
    return F.coalesce(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")), F.lit(""))


def label_key(x: Column) -> Column:
    """Key of a club's label: folded, œ spelled out, parentheses and the chair's title dropped."""
    folded = F.replace(fold(x), F.lit("œ"), F.lit("oe"))
    bare = F.regexp_replace(F.regexp_replace(folded, r"\([^)]*\)", " "), r"president du groupe", " ")
    return F.coalesce(squeeze(bare), F.lit(""))


def name_key(x: Column) -> Column:
    """Key of a person's name: a label key up to a birth name, without punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(label_key(x), r"\bnee?\b.*$", ""), "[^a-z0-9]+", " "))


def person_key(key: Column, honorifics: Sequence[str] = C.HONORIFICS) -> Column:
    """A key without the honorifics that it opens with; one of nothing else stays."""
    bare = F.regexp_replace(key, rf"^(?:(?:{'|'.join(honorifics)}) )+", "")
    return F.when(bare == "", key).otherwise(bare)


def last_token(x: Column) -> Column:
    return F.element_at(F.split(x, " "), -1)


def split_name(x: Column) -> Column:
    """Struct (first_name, last_name); a birth name after ``Né(e)`` is dropped."""
    words = F.split(squeeze(F.regexp_replace(x, r"(?iu)\s+née?\s.*$", "")), " ")
    return F.struct(F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ").alias("first_name"), F.element_at(words, -1).alias("last_name"))


def capital(x: Column) -> Column:
    """A character's capital; itself if that is not one character, as with ß and ligatures."""
    upper = F.upper(x)
    return F.when(F.length(upper) == F.length(x), upper).otherwise(x)


def has_speaker_marker(x: Column, space: str = _SP) -> Column:
    """Whether a text opens with an honorific, a capitalised name and a comma or full stop; ``space`` is a class body."""
    marks = "|".join(m.replace(".", r"\.") for m in C.SPEAKER_MARKS)
    return F.coalesce(x.rlike(rf"^[{space}]*(?:{marks})[{space}]+[A-ZÀ-ÖØ-Þ][^.!?\n]{{2,90}}[,.]"), F.lit(False))


def is_reaction(x: Column, words: Iterable[str] = C.REACTION_WORDS) -> Column:
    """Whether a text has a reaction's word; phrases of business alone have none."""
    pattern = rf"(?iuU)(?<!\w)(?:{'|'.join(words)})(?!\w)"
    return F.coalesce(strip_wrappers(x).rlike(pattern), F.lit(False))


def upper_ratio(x: Column) -> Column:
    """Share of capitals among the letters; 0 without letters."""
    letters, upper = F.length(F.regexp_replace(x, r"[^\p{L}]", "")), F.length(F.regexp_replace(x, r"[^\p{Lu}]", ""))
    return F.coalesce(F.try_divide(upper.cast("double"), letters.cast("double")), F.lit(0.0))


def is_parenthetical(x: Column) -> Column:
    return strip(x).startswith("(") & strip(x).endswith(")")


def is_title_like(x: Column, least: float = 0.70, most_chars: int = 180) -> Column:
    bracketed = lambda t: t.startswith("(") & t.endswith(")")
    return once(strip_wrappers(x), lambda t: (t != "") & (F.length(t) <= most_chars) & ~t.rlike(r"[.!?;:]$") & ~bracketed(t) & (upper_ratio(t) >= least))


#: Split contractions and what each becomes.
_CONTRACTIONS = ((r"[àÀ]", "les", "aux"), (r"[àÀ]", "le", "au"), ("[dD][eE]", "les", "des"), ("[dD][eE]", "le", "du"))


def clean_title(x: Column) -> Column:
    """Rejoin split contractions, capitals among capitals, and close gaps after apostrophes."""
    def joined(x: Column) -> Column:
        bare = F.regexp_replace(x, r"(?iuU)\b(?:à\s+les|à\s+le|de\s+les|de\s+le)\b", " ")
        upper = (upper_ratio(x) >= 0.8) | (upper_ratio(bare) >= 0.8)
        capitals = others = x
        for head, tail, joint in _CONTRACTIONS:
            capital = head.replace("[àÀ]", "À").replace("[dD][eE]", "DE") + rf"\s+{tail.upper()}"
            anyhow = rf"(?iuU)\b{head}\s+{tail}\b"
            capitals, others = (F.regexp_replace(out, rf"(?U)\b{capital}\b", joint.upper()) for out in (capitals, others))
            capitals, others = F.regexp_replace(capitals, anyhow, joint.upper()), F.regexp_replace(others, anyhow, joint)
        return F.when(upper, capitals).otherwise(others)

    split = r"(?iuU)\b(?:[àÀ]|de)\s+les?\b"
    return once(x, lambda t: F.regexp_replace(F.when(t.rlike(split), joined(t)).otherwise(t), rf"([{_LETTER}])'\s+(?=[{_LETTER}])", "$1'"))


def phrases(words: Iterable[str]) -> str:
    """A pattern of any of the phrases, with any white space inside and accents of capitals or none."""
    loose = str.maketrans({"É": "[ÉE]", "È": "[ÈE]", "Ô": "[ÔO]", "À": "[ÀA]", ".": r"\.", "'": "['’ ]", " ": r"\s+"})
    return "(?:" + "|".join(w.translate(loose) for w in sorted(words, key=len, reverse=True)) + ")"


def _undetailed(x: Column) -> Column:
    """A title without the detail of its debate, glued words parted."""
    t = strip(F.regexp_replace(x, rf"\s+{phrases(C.DEBATE_DETAILS)}.*$", ""))
    for glued, right in C.GLUED_WORDS.items():
        t = F.regexp_replace(t, rf"(?U)\b{glued}\b", right)
    return squeeze(t)


def normalize_major_title(x: Column) -> Column:
    """A title without the detail of its debate, glued words parted, cleaned."""
    return clean_title(_undetailed(x))


#: A text that ends in punctuation, wrappers aside: no title ends so.
_ENDS = rf"[.!?;:](?:{_WRAP})?$"
#: Cleaning leaves more than a quarter of a squeezed text: of what it rejoins at least two fifths, of gaps closed two thirds.
_CLEANED_SHARE = 4


def match_major_topic(x: Column, most_chars: int = 180) -> Column:
    """Struct (number, title) of a numbered title that opens a text or its last sentence; else null."""
    inner = r"(?:^|[.!?]\s+)(\d{1,2})\s+(.+?)$"
    made = lambda number, title: F.when(is_title_like(title, 0.55, most_chars), F.struct(number.try_cast("int").alias("number"), title.alias("title")))
    # of a longer one no title can be left
    fits = lambda raw: F.length(F.regexp_replace(raw, f"^{_WRAP}|{_WRAP}$", "")) <= _CLEANED_SHARE * most_chars
    titled = lambda number, raw: once(_undetailed(raw), lambda r: F.when(fits(r), once(clean_title(r), lambda title: made(number, title))))
    found = lambda t, pattern: F.when(t.rlike(pattern), titled(F.regexp_extract(t, pattern, 1), F.regexp_extract(t, pattern, 2)))
    whole = once(strip_wrappers(x), lambda t: F.when(t.rlike(r"^\d{1,2}\s+\S"), found(t, r"^(\d{1,2})\s+(.+?)$")).otherwise(found(t, inner)))
    # only the detail of a debate can hide that a title ends in punctuation
    details = phrases(C.DEBATE_DETAILS).replace("['’ ]", r"(?:['’]|\s+)").replace(r"\s+", f"[{_SP}]+")
    return F.when(~F.coalesce(x.rlike(_ENDS) & ~x.rlike(details), F.lit(False)), whole)


def _subtopic_candidate(t: Column) -> Column:
    words = F.size(F.regexp_extract_all(t, F.lit(rf"[{_LETTER}0-9']+"), F.lit(0)))
    return ~t.rlike(r"^\s*\d{1,2}\s+\S") & is_title_like(t, 0.75, 120) & words.between(2, 14)


def match_subtopic(x: Column) -> Column:
    """An unnumbered title, alone or after the last sentence; else null."""
    capital = r"[A-ZÀ-ÖØ-Þ]"
    announced = lambda t: strip(F.regexp_extract(t, rf"(?U)\b{phrases(C.ANNOUNCEMENTS)}\b.+?\s+({capital}(?:{capital}|[' -])+{capital})\s*$", 1))
    spoken = r"(?iuU)\bla parole est\b"
    trailing = lambda parts: F.when(F.size(parts) > 1, once(strip(F.element_at(parts, -1)), lambda tail: F.when(~tail.rlike(spoken) & _subtopic_candidate(tail), tail)))
    named = lambda t: once(announced(t), lambda a: F.when((a != "") & _subtopic_candidate(a), a))
    found = once(strip_wrappers(x), lambda t: F.when(_subtopic_candidate(t), t).otherwise(F.coalesce(named(t), once(F.split(t, r"[.!?;:]\s+"), trailing))))
    # each of the three ends where the text does
    return F.when(~F.coalesce(x.rlike(_ENDS), F.lit(False)), clean_title(found))


def is_continuation(x: Column) -> Column:
    t = strip_wrappers(x)
    return is_title_like(t, 0.70, 80) & t.rlike("^(?:" + "|".join(C.CONTINUATIONS) + ")")


def is_chair(x: Column) -> Column:
    """Whether a label names whoever chairs a sitting, not a committee or group."""
    key = simple_key(x)
    starts = key.rlike("^(?:" + "|".join(C.CHAIR_PREFIXES) + ")(?: |$)")
    excepted = key.rlike("|".join(C.CHAIR_EXCEPTIONS))
    return (key == C.CHAIR_LABEL) | (starts & ~excepted)


def join_values(xs: Column, sep: str = ";") -> Column:
    """Cleaned, non-empty items of an array as one string."""
    return F.array_join(F.filter(F.transform(xs, squeeze), lambda v: v.isNotNull() & (v != "")), sep)


def parse_list(x: Column) -> Column:
    """Items of a list literal in quotes of either kind; any other text is its own one item."""
    parsed = F.from_json(x, "array<string>", {"allowSingleQuotes": "true"})
    looks = F.trim(x).startswith("[") & F.trim(x).endswith("]")
    return F.when(looks & parsed.isNotNull(), parsed).when(non_empty(x), F.array(F.trim(x))).otherwise(F.array().cast("array<string>"))


def drop_weak(xs: Column, weak: str = C.WEAK_PARTY) -> Column:
    """Without the weak member, unless it is the only one."""
    return F.when(F.size(xs) > 1, F.array_remove(xs, weak)).otherwise(xs)


def inline_value(x: Column, label: str) -> Column:
    found = F.regexp_extract(x, rf"(?iu)^\s*{label}\s*:\s*(.+?)\s*$", 1)
    return F.nullif(found, F.lit(""))


def preview(x: Column, chars: int = 240) -> Column:
    return F.substring(x, 1, chars)
