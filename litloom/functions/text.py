"""Text cleaning as column expressions.

Null texts stay null unless a function says otherwise. Accents are folded before patterns are applied, since
word classes of both engines are ASCII.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql import functions as F

from litloom.functions.lexicon import DROPPED, FOLD_FROM, FOLD_TO, is_dropped, lemma, lemma_of

MARKS = ",.;?!"
# Entities that stand for a sign, in the order in which they are read.
ENTITIES = {"amp": "&", "gt": ">", "lt": "<", "quot": '"', "nbsp": " "}


def squeeze(text: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def fold_accents(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, FOLD_FROM, FOLD_TO), r"[^\x00-\x7F]", "")


def _capital(word: Column) -> Column:
    return (F.upper(word) == word) & (F.lower(word) != word)


def is_abbreviation(word: Column) -> Column:
    """Upper-case words, also with a plural s."""
    return _capital(word) | (F.endswith(word, F.lit("s")) & _capital(normalize_abbreviation(word)))


def normalize_abbreviation(word: Column) -> Column:
    return F.when(F.endswith(word, F.lit("s")), F.substr(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def separate_words(text: Column) -> Column:
    """Accents folded; other than word characters, underscores and words that start with a digit become spaces."""
    return squeeze(F.regexp_replace(fold_accents(text), r"[^A-Za-z0-9_]|\b[0-9]\w*\b|_", " "))


def normalize_text(text: Column, lower: bool = True) -> Column:
    """Words of a text; lower-cased, but for abbreviations, which lose a plural s."""
    words = separate_words(text)
    if not lower:
        return words
    parts = F.filter(F.split(words, " "), lambda w: w != "")
    return F.array_join(F.transform(parts, lambda w: F.when(is_abbreviation(w), normalize_abbreviation(w)).otherwise(F.lower(w))), " ")


def tokens(text: Column) -> Column:
    """Index terms of a normalised text: no dropped words, nouns in the singular, abbreviations in upper case.

    Each step binds what the next one uses, so nothing is computed twice for a word.
    """
    words = F.filter(F.split(F.regexp_replace(text, r"[^A-Za-z0-9_]+", " "), " "), lambda w: (w != "") & ((w < "0") | (w >= ":")) & ~is_dropped(w))
    seen = F.transform(words, lambda w: F.struct(w.alias("w"), is_abbreviation(w).alias("short")))
    seen = F.filter(seen, lambda s: s["short"] | ((F.length(s["w"]) > 1) & ~is_dropped(F.lower(s["w"]))))

    def term(s: Column) -> Column:
        return F.when(s["short"], normalize_abbreviation(s["w"])).otherwise(F.lower(lemma(s["w"])))

    found = F.transform(seen, lambda s: F.struct(s["w"].alias("w"), s["short"].alias("short"), term(s).alias("term")))
    found = F.transform(found, lambda s: F.when(~s["short"] & (F.length(s["term"]) <= 1), s["w"]).otherwise(s["term"]))
    return F.filter(found, lambda t: ~is_dropped(t))


FOLDED = str.maketrans(FOLD_FROM, FOLD_TO)
OTHER = re.compile(r"[^\x00-\x7F]+")
NO_WORD = bytes(c if chr(c).isalnum() and c < 128 else 32 for c in range(256))
NUMBERED = re.compile(rb"[^A-Za-z0-9_]|\b[0-9]\w*\b|_")
_DROPPED = frozenset(DROPPED)


def _short(word: str) -> bool:
    capital = lambda w: w.upper() == w and w.lower() != w
    return capital(word) or (word.endswith("s") and capital(word[:-1]))


def term_of(word: str) -> str | None:
    """The index term of one word of a cleaned text, as `tokens(normalize_text(...))` gives it; None where it gives none."""
    if _short(word):
        word = word.removesuffix("s")
    else:
        word = word.lower()
    if "0" <= word[:1] < ":" or word in _DROPPED:
        return None
    if _short(word):
        term = word.removesuffix("s")
    elif len(word) > 1 and word.lower() not in _DROPPED:
        term = lemma_of(word).lower()
        term = word if len(term) <= 1 else term
    else:
        return None
    return None if term in _DROPPED else term


class Terms(dict):
    """Numbers of words' terms, each word judged once; -1 for none."""

    def __init__(self) -> None:
        super().__init__()
        self.names: list[str] = []
        self.numbers: dict[str, int] = {}

    def __missing__(self, word: bytes) -> int:
        term = term_of(word.decode())
        if term is None:
            at = -1
        else:
            at = self.numbers.setdefault(term, len(self.names))
            if at == len(self.names):
                self.names.append(term)
        self[word] = at
        return at


def term_numbers(text: str, known: Terms) -> np.ndarray:
    # Folding a whole text letter by letter takes longer than all that follows.
    data = (text if text.isascii() else OTHER.sub(lambda m: m[0].translate(FOLDED), text)).encode("ascii", "ignore")
    # An underscore can stand within a number, which goes as a whole.
    words = (NUMBERED.sub(b" ", data) if b"_" in data else data.translate(NO_WORD)).split()
    found = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    return found[found >= 0]


def term_lists(texts: pa.Array, known: Terms, pairs: bool = False) -> pa.Array:
    """The terms of each text, null of null; with `pairs` its distinct terms and distinct pairs of neighbours instead."""
    none = np.zeros(0, np.int64)
    lists = [none if t is None else term_numbers(t, known) for t in texts.to_pylist()]
    names = pa.array(known.names, pa.string())

    def listed(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([none, *parts]), np.cumsum([0, *map(len, parts)])

    if pairs:
        both = [np.unique((x[:-1] << 32) | x[1:]) if len(x) else none for x in lists]
        lists = [np.unique(x) for x in lists]
        # One flat list: the terms of a text, then its pairs.
        flat, ends = listed([np.concatenate((x << 32 | 0xFFFFFFFF, y)) for x, y in zip(lists, both, strict=True)])
        first, second = names.take(pa.array(flat >> 32)), flat & 0xFFFFFFFF
        single = pa.array(second == 0xFFFFFFFF)
        second = names.take(pa.array(second, mask=np.asarray(single)))
        values = pa.compute.if_else(single, first, pa.compute.binary_join_element_wise(first, second, " "))
    else:
        flat, ends = listed(lists)
        values = names.take(pa.array(flat))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=pa.array(np.asarray(texts.is_null())))


def remove_unicode_symbols(text: Column) -> Column:
    """Codes such as <U+00E9> separate what stands around them: by a semicolon, or by the mark that is there already."""
    code = r"<\s*U\s*\+[A-Za-z0-9_]{4}\s*>"
    parted = F.regexp_replace(F.regexp_replace(text, code, " ; "), r"(?<=[.:;!?])\s*;", "")
    return F.when(text.rlike(code), F.regexp_replace(F.regexp_replace(parted, r"\s*;\s*", " ; "), "^ ; ", "")).otherwise(text)


def remove_html_tags(text: Column) -> Column:
    """No tags, no brackets with nothing in them, no entities; white space squeezed, not trimmed."""
    for nothing in (r"<.+?>", r"\(\s*\)", r"\[\s*\]"):
        text = F.regexp_replace(text, nothing, "")
    for name, sign in ENTITIES.items():
        text = F.replace(text, F.lit(f"&{name};"), F.lit(sign))
    return F.regexp_replace(text, r"(?:&\w+;|\s)+", " ")


def remove_copyright(text: Column) -> Column:
    """The text before a copyright sign, without that word; what stands for a missing abstract is emptied."""
    missing = F.lower(F.translate(text, "[]", "")) == "no abstract available"
    before = F.element_at(F.split(text, r"©|\([cC]\)"), 1)
    return F.when(missing, F.lit("")).otherwise(squeeze(F.regexp_replace(before, r"[Cc]opyright ?\.?", "")))


def trim_marks(text: Column, marks: str = MARKS) -> Column:
    """No marks or white space at the ends, but a sentence keeps its first closing mark."""
    core = F.regexp_replace(F.regexp_replace(text, f"^[{marks}\\s]+", ""), f"[{marks}\\s]+$", "")
    tail = F.regexp_extract(text, f"[^{marks}\\s]([{marks}\\s]+)$", 1)
    return F.concat(core, F.substr(F.regexp_replace(tail, "[^.?!]", ""), F.lit(1), F.lit(1)))


def keyword_list(text: Column) -> Column:
    """Keywords between commas and semicolons; blanks and mentions of full text go."""
    parts = F.transform(F.split(F.replace(text, F.lit(","), F.lit(";")), ";"), lambda p: F.trim(p))
    return F.filter(parts, lambda w: (w != "") & ~F.contains(F.lower(w), F.lit("full text")))


def normalize_keywords(text: Column, lower: bool = False) -> Column:
    parts = F.filter(F.transform(keyword_list(text), lambda w: normalize_text(w, lower)), lambda w: w != "")
    return F.array_join(parts, " ; ")


def calm_keywords(text: Column) -> Column:
    """If there are over five keywords and half of them shout, those are lower-cased; then all are normalised."""
    words = keyword_list(text)
    loud = lambda w: (F.upper(w) == w) & w.rlike("[A-Z]")
    calm = F.when((F.size(words) > 5) & (2 * F.size(F.filter(words, loud)) >= F.size(words)), F.transform(words, lambda w: F.when(loud(w), F.lower(w)).otherwise(w))).otherwise(words)
    return F.array_join(F.transform(calm, lambda w: normalize_text(w, False)), ";")


def index_keywords(text: Column) -> Column:
    """Keywords as index terms; those about full text or articles go."""
    kept = F.filter(keyword_list(text), lambda w: ~F.contains(F.lower(w), F.lit("article")))
    terms = F.transform(kept, lambda w: F.lower(F.array_join(tokens(normalize_text(w)), " ")))
    return F.filter(terms, lambda w: w != "")


def split_parts(text: Column, conjunctions: bool = True) -> Column:
    """Parts of a sentence between commas, brackets, colons, short bracketed codes and conjunctions."""
    out = F.regexp_replace(text, r"\b(and|or)\b", ",") if conjunctions else text
    out = F.regexp_replace(F.regexp_replace(out, r"\(\s*\w{1,4}\s*\)", ","), r"\[\s*\w{1,4}\s*\]", ",")
    parts = F.split(F.regexp_replace(out, r"[()\[\];:]", ","), ",")
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def split_phrases(text: Column) -> Column:
    return F.filter(F.split(text, r"[,;.!?:()]+|\band\b|\bor\b"), lambda p: p != "")


def camel_case(text: Column) -> Column:
    """Words capitalised, function words lower-cased, single letters upper-cased."""
    words = F.filter(F.split(squeeze(text), " "), lambda w: w != "")

    def cased(w: Column) -> Column:
        big = F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))
        return F.when(F.length(w) == 1, F.upper(w)).when(is_dropped(F.lower(w)), F.lower(w)).otherwise(big)

    return F.array_join(F.transform(words, cased), " ")


def country_name(text: Column) -> Column:
    return fold_accents(squeeze(F.regexp_replace(F.trim(F.split(text, ",")[0]), r"\(.*?\)|\[.*?\]", " ")))


def journal_name(text: Column) -> Column:
    """Before the first semicolon if a part names a volume; else the last part, up to its comma."""
    plain = replace_braces(remove_html_tags(text))
    parts = F.split(plain, ";")
    volume = F.exists(parts, lambda p: F.startswith(F.lower(F.trim(p)), F.lit("vol.")))
    last = F.element_at(parts, -1)
    return F.trim(F.when(~F.contains(plain, F.lit(";")), plain).when(volume, parts[0]).otherwise(F.split(last, ",")[0]))


def replace_braces(text: Column) -> Column:
    """{x} with a single sign in it becomes the sign, other braces go with what they hold."""
    one = F.regexp_replace(text, r"\{[^A-Za-z0-9_%&#}]*([A-Za-z0-9%&#])(?:[^A-Za-z0-9_}][^}]*)?\}", "$1")
    return F.regexp_replace(one, r"\{[^}]*\}", "")


def subexpressions(text: Column) -> Column:
    """All runs of consecutive words of a phrase, in order of start, then length."""
    words = F.filter(F.split(squeeze(text), " "), lambda w: w != "")
    n = F.size(words)
    runs = F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(F.lit(1), n - i + 1), lambda k: F.array_join(F.slice(words, i, k), " ")))
    return F.when(n > 0, F.flatten(runs)).otherwise(F.array().cast("array<string>"))


def clean_ocr(text: Column) -> Column:
    """No runs of letters that stand for rulers, no form codes; lines joined."""
    out = F.regexp_replace(text, r"[sencmaruotv]{15,}", "")
    return squeeze(F.regexp_replace(F.regexp_replace(out, r"-\n", ""), r"\(cid:\d+\)|\n", " "))


def similarity(a: Column, b: Column) -> Column:
    """One minus the edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def swaps(word: Column, old: str, new: str) -> Column:
    """A long word with one of its letters swapped, at places that spelling variants differ in."""
    at = F.filter(F.sequence(F.lit(3), F.greatest(F.length(word) - 1, F.lit(3))), lambda i: F.substr(word, i, F.lit(1)) == old)
    made = F.transform(at, lambda i: F.concat(F.substr(word, F.lit(1), i - 1), F.lit(new), F.substr(word, i + 1)))
    return F.when((F.length(word) > 5) & ~F.contains(word, F.lit(" ")), made).otherwise(F.array().cast("array<string>"))


def spelling_swaps(word: Column) -> Column:
    return F.array_distinct(F.concat(swaps(word, "s", "z"), swaps(word, "z", "s")))


def words_similar(a: Column, b: Column, threshold: float) -> Column:
    return (similarity(a, b) >= threshold) | F.array_contains(spelling_swaps(a), b)


def mentions_any(text: Column, words: list[str]) -> Column:
    """Any of the words, whole, also with one or two s added."""
    return text.rlike("\\b(" + "|".join(words) + ")s?s?\\b")


def has_lone_symbol(text: Column) -> Column:
    """A word with a digit and at most one other character."""
    return F.exists(F.split(squeeze(text), " "), lambda w: w.rlike("[0-9]") & (F.length(F.regexp_replace(w, "[0-9]", "")) < 2))


def drop_stopwords(text: Column) -> Column:
    words = F.filter(F.split(squeeze(text), " "), lambda w: (w != "") & ~is_dropped(F.lower(w)) & ~is_dropped(lemma(F.lower(w))))
    return F.array_join(words, " ")


def sentences(text: Column) -> Column:
    """Sentences: up to a closing mark that white space follows."""
    marked = F.regexp_replace(text, r"([.!?])[\x20\x09-\x0D]+", "$1\u0001")
    return F.filter(F.transform(F.split(marked, "\u0001"), lambda s: F.trim(s)), lambda s: s != "")


def find_year(value: Column, default: int = 2018) -> Column:
    """A year from ="2015", dates, and numbers with trailing digits; blank and 0 give the default."""
    plain = F.trim(F.regexp_replace(value, '[="]', ""))
    digits = F.regexp_extract(plain, r"([0-9]{4})", 1)
    return F.when(plain.isNull() | (plain == "") | (plain == "0") | (digits == ""), F.lit(default)).otherwise(digits.cast("int"))


def years_in(text: Column, latest: int, earliest: int = 1800) -> Column:
    """The least plausible four-digit year, null without one."""
    found = F.transform(F.regexp_extract_all(text, F.lit(r"\b([0-9]{4})\b"), F.lit(1)), lambda y: y.cast("int"))
    return F.array_min(F.filter(found, lambda y: (y > earliest) & (y <= latest)))


def article_link(url: Column, doi: Column) -> Column:
    return F.when(url.rlike("^https?://"), url).when(doi.isNotNull() & (doi != ""), F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.lit(""))
