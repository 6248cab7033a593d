"""Text expressions: scripts, accents, base normalisation, handles, skeletons. All are columns that Spark compiles."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from recordloom.functions import rules

NUMBER = r"\d+(?:st|nd|rd|th)\b|\d+-[a-z]\b|\d[\d/\-a-z]*\d|\d+"
JUNK = r"^[\-<>\"'`~!@#$%^*+={}\[\]|\\:;,.?/]+\s*"
PUNCTUATION = r"[^\p{L}\p{N}_]"
HANDLE, DOMAIN, CAMEL = r"^\s*[@#]+", r"(?i)\.(?:com|in|net|org|co)\s*$", r"([a-z])([A-Z])"


def script(text: Column) -> Column:
    """The commonest non-Latin script among the letters of text, "Other" for unknown ones; "Latin" if there is none.

    Of equally common scripts the first in the table wins.
    """
    text = F.coalesce(text, F.lit(""))
    counts = [(name, F.regexp_count(text, F.lit(f"[{span}&&\\p{{L}}]"))) for name, span in rules.SCRIPTS]
    known = "".join(span for _, span in rules.SCRIPTS)
    counts.append(("Other", F.regexp_count(text, F.lit(f"[\\p{{L}}&&[^{rules.LATIN}{known}]]"))))
    most = F.greatest(*(n for _, n in counts))
    out = F.lit("Latin")
    for name, n in reversed(counts):
        out = F.when((n == most) & (most > 0), F.lit(name)).otherwise(out)
    return out


@functools.cache
def _accents() -> tuple[str, str]:
    """Every Latin letter that is another with marks, and that other letter."""
    pairs = []
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = [x for x in unicodedata.normalize("NFD", chr(c)) if not unicodedata.combining(x)]
        if len(parts) == 1 and parts[0] != chr(c):
            pairs.append((chr(c), parts[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def fold_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, *_accents()), r"\p{Mn}", "")


def base(text: Column) -> Column:
    """Lower case without accents, junk in front, or punctuation but inside numbers ("12/3", "45-a"); "&" is "and"; one blank between tokens."""
    x = F.regexp_replace(F.btrim(F.coalesce(text, F.lit(""))), JUNK, "")
    x = F.lower(fold_accents(F.replace(x, F.lit("&"), F.lit(" and "))))
    x = F.regexp_replace(x, f"({NUMBER})", " $1 ")
    tokens = F.transform(F.split(x, r"\s+"), lambda t: F.when(t.rlike(f"^(?:{NUMBER})$"), t).otherwise(F.regexp_replace(t, PUNCTUATION, " ")))
    return F.btrim(F.regexp_replace(F.array_join(tokens, " "), r"\s+", " "))


def strip_handle(name: Column) -> Column:
    """A handle or domain as plain words: no leading @ or #, no trailing .com and the like, camelCase split."""
    x = F.regexp_replace(F.regexp_replace(name, HANDLE, ""), DOMAIN, "")
    return F.btrim(F.regexp_replace(x, CAMEL, "$1 $2"))


def is_handle(name: Column) -> Column:
    x = F.btrim(name)
    return x.rlike(HANDLE) | x.rlike(DOMAIN) | (~x.rlike(r"\s") & x.rlike(CAMEL))


def handle_words(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(strip_handle(name)), r"[^\p{L}\p{N}]+", " "))


def words(text: Column) -> Column:
    """The blank-separated tokens of normalised text; none for an empty one."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def skeleton(name: Column) -> Column:
    """Per token: phonetic letters, no vowels after the first letter, no repeated letters."""

    def one(t: Column) -> Column:
        for a, b in rules.PHONETIC:
            t = F.replace(t, F.lit(a), F.lit(b))
        t = F.concat(F.substring(t, 1, 1), F.regexp_replace(F.substr(t, F.lit(2)), "[aeiou]", ""))
        return F.regexp_replace(t, r"(.)\1+", "$1")

    return F.array_join(F.transform(words(name), one), " ")


@functools.cache
def _syllable(c: str) -> str:
    """A letter's sound by its Unicode name: "DEVANAGARI LETTER KA" is "ka", a vowel sign its vowel, a virama removes the last a."""
    name = unicodedata.name(c, "")
    kind, _, sound = name.rpartition(" ")
    if "VIRAMA" in name or "NUKTA" in name:
        return "\b" if "VIRAMA" in name else ""
    if "VOWEL SIGN" in name:
        return "\b" + sound.lower()
    if "LETTER" in kind or "DIGIT" in kind:
        return str(unicodedata.digit(c)) if "DIGIT" in kind else sound.lower()
    return {"ANUSVARA": "n", "VISARGA": "h", "CANDRABINDU": "n"}.get(sound, "")


def latin(text: str) -> str:
    out = []
    for c in text:
        if c < "ɐ" or not unicodedata.name(c, "").strip():
            out.append(c)
            continue
        s = _syllable(c)
        if s.startswith("\b"):
            if out and out[-1].endswith("a"):
                out[-1] = out[-1][:-1]
            s = s[1:]
        out.append(s)
    return "".join(out)


def _to_latin(texts: pd.Series) -> pd.Series:
    fold = lambda t: unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))
    return texts.map(lambda t: None if t is None else fold(latin(t)))


def transliterate(column: str) -> Column:
    """Any script in Latin letters, without accents. Only rows of other scripts should get here."""
    return F.pandas_udf(_to_latin, "string")(column)
