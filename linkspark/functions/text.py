"""Text normalisation as column expressions; Python only where Unicode tables are needed."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Separators of words; / - # . ' are none. \x1c-\x1f are white space too.
SEPARATORS = "(?U)[\\s\\x1c-\\x1f,;:()\\[\\]{}<>*|\"`~!?@$%^+=_\\\\​‌‍﻿]+"
#: A web domain and its label. The endings that count as domains.
DOMAIN = "(?U)\\b(?:www\\.)?([a-z0-9][a-z0-9\\-]*)\\.(?:co\\.in|com|net|org|in|co|io|biz|info|us|fr)\\b"
LATIN = "\\u00c0-\\u024f\\u1e00-\\u1eff"
#: Stands for a comma between components while the text is folded.
COMMA = "\x1f"


@F.pandas_udf(StringType())
def nfkc_casefold(text: pd.Series) -> pd.Series:
    """NFKC and case folding; Spark has neither."""
    return text.map(lambda x: x.lower() if x.isascii() else unicodedata.normalize("NFKC", x).casefold(), na_action="ignore")


@F.pandas_udf(StringType())
def nfkc_casefold_twice(text: pd.Series) -> pd.Series:
    """nfkc_casefold() of its own result, as names are folded: the second pass settles what folding composed anew."""
    fold = lambda x: unicodedata.normalize("NFKC", x).casefold()
    return text.map(lambda x: x.lower() if x.isascii() else fold(fold(x)), na_action="ignore")


@F.pandas_udf(StringType())
def bare(text: pd.Series) -> pd.Series:
    """Lower case without combining marks, after NFKD."""
    return text.map(lambda x: x.lower() if x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).lower(), na_action="ignore")


def norm(text: Column) -> Column:
    """Words of letters, digits and _ without marks, lower case, one blank between them."""
    return F.trim(F.regexp_replace(bare(text), "(?U)[^\\w]+", " "))


#: Latin letters without a decomposition, and what they become.
LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ł": "l", "ð": "d", "þ": "th", "ı": "i", "ħ": "h", "ŋ": "ng", "ŧ": "t", "ĸ": "k", "ƒ": "f"}


def latin_table() -> tuple[str, str]:
    """Accented Latin letters and the ASCII letters left when their marks go, for translate()."""
    plain = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)).lower()
        if len(bare) == 1 and bare.isascii() and bare.isalpha():
            plain[c] = bare
    plain |= {k: v for k, v in LETTERS.items() if len(v) == 1}
    return "".join(plain), "".join(plain.values())


LATIN_FROM, LATIN_TO = latin_table()


def fold_latin(token: Column) -> Column:
    """Accents off a token that has only Latin letters."""
    out = token
    for k, v in LETTERS.items():
        if len(v) > 1:
            out = F.replace(out, F.lit(k), F.lit(v))
    out = F.translate(out, LATIN_FROM, LATIN_TO)
    return F.when(token.rlike(f"[{LATIN}]") & token.rlike("^[\\x00-\\u024f\\u1e00-\\u1eff]*$"), out).otherwise(token)


def prepared(folded: Column) -> Column:
    """Punctuation rules on folded text, in this order: & is a word, apostrophes go, # before a digit and dots between letters go, other dots part words."""
    t = F.replace(folded, F.lit("&"), F.lit(" and "))
    t = F.translate(t, "’'", "")
    t = F.regexp_replace(t, "(?U)#(?=\\d)", "")
    t = F.regexp_replace(t, "(?<=[a-z])\\.(?=[a-z])", "")
    return F.replace(t, F.lit("."), F.lit(" "))


def edge_trim(token: Column) -> Column:
    return F.regexp_replace(token, "^[-/#.']+|[-/.']+$", "")


def base_tokens(folded: Column) -> Column:
    """Words of folded text: a lone # stays, edges are trimmed, words of - / # alone go, Latin accents go."""
    words = F.transform(F.split(prepared(folded), SEPARATORS), lambda x: F.when(x == "#", x).otherwise(edge_trim(x)))
    words = F.filter(words, lambda x: (x == "#") | x.rlike("[^-/#]"))
    return F.transform(words, fold_latin)


def has_domain(folded: Column) -> Column:
    return folded.rlike(DOMAIN)


def name_text(folded: Column) -> Column:
    """A name with web domains reduced to their label and hyphens as blanks."""
    return F.replace(F.regexp_replace(folded, DOMAIN, "$1"), F.lit("-"), F.lit(" "))


def name_tokens(folded: Column) -> Column:
    return base_tokens(name_text(folded))


def components(folded: Column) -> Column:
    """Words of each component of folded text, whose commas were COMMA; empty ones go."""
    return F.filter(F.transform(F.split(folded, COMMA), base_tokens), lambda x: F.size(x) > 0)


def component_count(address: Column) -> Column:
    return F.size(F.split(address, ","))


def last_component(address: Column) -> Column:
    return F.trim(F.element_at(F.split(address, ","), -1))


def house_number(address: Column) -> Column:
    return F.regexp_extract(address, "[0-9]+", 0)


def last_word(text: Column) -> Column:
    return F.lower(F.element_at(F.split(text, " +"), -1))


#: Vowels, consonants and signs by their place in the block of a Brahmic script; the blocks lie in parallel from U+0900 to U+0D7F.
VOWELS = {5: "a", 6: "a", 7: "i", 8: "i", 9: "u", 10: "u", 11: "r", 14: "e", 15: "e", 16: "ai", 18: "o", 19: "o", 20: "au"}
CONSONANTS = dict(zip(range(0x15, 0x3A), "k kh g gh n c ch j jh n t th d dh n t th d dh n n p ph b bh m y r r l l l v sh sh s h".split(), strict=True))
SIGNS = {0x3E: "a", 0x3F: "i", 0x40: "i", 0x41: "u", 0x42: "u", 0x43: "r", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au"}
VIRAMA, NASAL = 0x4D, {1: "n", 2: "n", 3: "h"}
#: Spellings of the letters of other alphabets, by runs of code points.
ALPHABETS = {
    0x03B1: "a b g d e z e th i k l m n x o p r s s t y f ch ps o",
    0x0430: "a b v g d e zh z i y k l m n o p r s t u f kh ts ch sh shch - y - e yu ya",
    0x05D0: "a b g d h v z h t y k k l m m n n s a p p ts ts q r sh t",
    0x0627: "a b h t th j h kh d th r z s sh s d t z a gh",
    0x0641: "f q k l m n h w a y",
}
SPELLINGS = {chr(start + i): x.replace("-", "") for start, run in ALPHABETS.items() for i, x in enumerate(run.split())}
#: Their letters that stand apart.
SPELLINGS |= {"\u0621": "", "\u0622": "a", "\u0623": "a", "\u0624": "w", "\u0625": "i", "\u0626": "y", "\u067e": "p", "\u0686": "ch", "\u0698": "zh", "\u06a9": "k", "\u06af": "g", "\u06cc": "y", "\u0451": "e", "\u0454": "ye", "\u0456": "i", "\u0457": "yi", "\u0491": "g"}


def romanised(token: str) -> str:
    """An ASCII spelling, lower case, of letters, digits, / and -; scripts without a rule, as Han and Hangul, go."""
    out: list[str] = []
    inherent = False
    for c in token.lower():
        code = ord(c)
        place = code % 0x80
        if 0x900 <= code < 0xD80:
            if inherent and place not in SIGNS and place != VIRAMA:
                out.append("a")
            inherent = False
            if place in CONSONANTS:
                out.append(CONSONANTS[place])
                inherent = True
            elif place in VOWELS or place in SIGNS or place in NASAL:
                out.append((VOWELS | SIGNS | NASAL)[place])
            elif 0x66 <= place <= 0x6F:
                out.append(str(place - 0x66))
            continue
        if inherent:
            out.append("a")
            inherent = False
        if c in SPELLINGS:
            out.append(SPELLINGS[c])
            continue
        bare = LETTERS.get(c) or "".join(SPELLINGS.get(x, x) for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        digit = unicodedata.decimal(c, None)
        out.append(str(digit) if digit is not None else bare.lower())
    # a final inherent vowel is silent
    return "".join(x for x in "".join(out) if x.isascii() and (x.isalnum() or x in "/-"))


@F.pandas_udf(ArrayType(StringType()))
def romanise(tokens: pd.Series) -> pd.Series:
    """Romanises the words that aren't ASCII; what is left empty stays as ''."""
    return tokens.map(lambda x: [t if t.isascii() else romanised(t) for t in x], na_action="ignore")


def is_native(text: Column) -> Column:
    """Whether a character lies outside Latin and general punctuation."""
    return text.rlike("[^\\x00-\\u024f\\u1e00-\\u1eff\\u2000-\\u206f]")


def is_caps(text: Column) -> Column:
    return text.rlike("\\p{Lu}") & ~text.rlike("[\\p{Ll}\\p{Lt}]")


def is_junk(text: Column) -> Column:
    return text.rlike("(?U)^\\s*[^\\w\\s(\\[]{2,}")


def affixes(values: Column, n: int, least: int, tag: str) -> Column:
    """The first and last ``n`` characters of values of at least ``least``, tagged < and >."""
    long = F.filter(values, lambda v: F.length(v) >= least)
    head = F.transform(long, lambda v: F.concat(F.lit(f"{tag}<"), F.substring(v, 1, n)))
    tail = F.transform(long, lambda v: F.concat(F.lit(f"{tag}>"), F.substring(v, -n, n)))
    return F.concat(head, tail)


def compound_parts(tokens: Column) -> Column:
    """Parts of words that hold / or - or begin with 0, cut there, without leading zeros; empty ones go."""
    parts = F.transform(F.filter(tokens, lambda t: t.rlike("[/\\-]|^0")), lambda t: F.split(t, "[/\\-]"))
    return F.filter(F.transform(F.flatten(parts), lambda p: F.ltrim(p, F.lit("0"))), lambda p: p != "")


def ngrams(text: Column, n: int = 3) -> Column:
    """Distinct character n-grams; a text shorter than n has itself."""
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(grams)


SCRIPTS = ["Latin", "Devanagari", "Bengali", "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada", "Malayalam", "Arabic", "Cyrillic", "Greek", "Han"]


def scripts(text: Column) -> Column:
    """Scripts of the characters outside ASCII."""
    found = [F.when(text.rlike(f"[\\p{{Is{s}}}&&[^\\x00-\\x7f]]"), F.lit(s)) for s in SCRIPTS]
    return F.array_compact(F.array(*found))
