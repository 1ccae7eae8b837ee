"""Affiliation strings: repairs, forms to compare, and when two of them mean the same place."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litloom.functions.lexicon import DROPPED, lemma
from litloom.functions.repair import join_initials
from litloom.functions.text import camel_case, fold_accents, is_abbreviation, similarity, squeeze

# Generic words of institutions, for both ways to compare them.
INSTITUTIONS = ["university", "institute", "research", "center", "centre", "department", "college"]
COMPANIES = ["state", "limited", "incorporation", "corporation", "company", "LLC"]
COMPASS = ["north", "south", "east", "west"]
CLIPPED = {"univ": "University", "inst": "Institute", "dept": "Department", "natl": "National", "intl": "International"}

SIGNS = r"""[-.!"#$%'()*+,/:;<>=?@\[\]\\^_`{}|~®]+"""


def spell_out(text: Column, clipped: dict[str, str] = CLIPPED) -> Column:
    """Clipped words in full, spaces around & and after an "of" that is glued to a name."""
    for short, word in clipped.items():
        text = F.regexp_replace(text, rf"(?i)\b{short}(?:\.|\b)", word)
    text = F.regexp_replace(text, r"\s*&\s*", " & ")
    return F.regexp_replace(text, r"\s*of([A-Z]\w)", " of $1")


def without_articles(text: Column) -> Column:
    """No articles, but where an & or a full stop follows; other signs become spaces."""
    plain = F.regexp_replace(text, r"(?i)\b(?:a|the)\b(?!\s*&|\.)", " ")
    return squeeze(F.regexp_replace(plain, SIGNS, " "))


def without_numbers(text: Column) -> Column:
    """No digits; nothing at all where less than two letters are left."""
    letters = F.trim(F.regexp_replace(text, r"[-.!\"#$%'()*+,/:;<>=?@\[\]\\^_`{}|~0-9]+", ""))
    return F.when(F.length(letters) < 2, F.lit("")).otherwise(F.trim(F.regexp_replace(text, "[0-9]+", "")))


def comparing_form(text: Column) -> Column:
    """Lower case, accents folded, without link words."""
    return F.lower(fold_accents(squeeze(F.regexp_replace(text, r"(?i)\b(?:and|of|&|de|for|do)\b", ""))))


def without_generic(text: Column, words: list[str]) -> Column:
    return squeeze(F.regexp_replace(text, r"(?i)\b(?:" + "|".join(words) + r")\w*\b", " "))


def sorted_words(text: Column) -> Column:
    return F.array_join(F.array_sort(F.filter(F.split(squeeze(text), " "), lambda w: w != "")), " ")


def answer_form(text: Column) -> Column:
    """Words in the singular, without dropped words, single letters and "part"."""
    plain = squeeze(F.regexp_replace(F.lower(F.replace(text, F.lit("."), F.lit(""))), r"[^\w\s']", " "))
    words = F.filter(F.split(plain, " "), lambda w: (F.length(w) > 1) & ~w.isin([*DROPPED, "part"]))
    return F.array_join(F.filter(F.transform(words, lemma), lambda w: F.length(w) > 1), " ")


def corporate_authors(text: Column, countries: list[str]) -> Column:
    """The authors between semicolons, each with the country that stands at either end put last. countries: in comparing form."""
    clean = lambda p: comparing_form(without_articles(without_numbers(p)))
    shown = lambda p: without_articles(without_numbers(camel_case(p)))

    def one(author: Column) -> Column:
        parts = F.filter(F.transform(F.split(author, ","), lambda p: F.trim(p)), lambda p: p != "")
        bound = F.transform(F.array(parts), lambda p: F.struct(p.alias("p"), F.coalesce(clean(F.get(p, F.lit(0))).isin(countries), F.lit(False)).alias("first")))
        rest = F.transform(bound, lambda b: F.struct(F.when(b["first"], shown(F.get(b["p"], F.lit(0)))).alias("country"), F.when(b["first"], F.slice(b["p"], 2, F.greatest(F.size(b["p"]), F.lit(1)))).otherwise(b["p"]).alias("p")))
        ends = F.transform(rest, lambda b: F.struct(b["country"].alias("country"), b["p"].alias("p"), F.coalesce(clean(F.get(b["p"], F.size(b["p"]) - 1)).isin(countries), F.lit(False)).alias("last")))
        named = F.transform(ends, lambda b: F.struct(F.when(b["last"], shown(F.get(b["p"], F.size(b["p"]) - 1))).otherwise(b["country"]).alias("country"), F.when(b["last"], F.slice(b["p"], 1, F.size(b["p"]) - 1)).otherwise(b["p"]).alias("p")))
        return F.get(F.transform(named, lambda b: F.concat_ws(", ", F.array_join(b["p"], ","), b["country"])), F.lit(0))

    return F.filter(F.transform(F.split(text, ";"), one), lambda a: a != "")


def compass_agrees(a: Column, b: Column) -> Column:
    """Not: both name a direction that the other does not."""
    only = lambda x, y: sum(((F.contains(x, F.lit(w)) & ~F.contains(y, F.lit(w))).cast("int") for w in COMPASS), F.lit(0)) > 0
    return ~(only(a, b) & only(b, a))


def other_words_agree(a: Column, b: Column, generic: list[str]) -> Column:
    """What only one of them has is alike, or one has nothing of its own."""
    x, y = (F.split(without_generic(t, generic), " ") for t in (a, b))
    own = lambda p, q: F.array_join(F.array_sort(F.filter(F.array_except(p, q), lambda w: w != "")), " ")
    return (own(x, y) == "") | (own(y, x) == "") | (similarity(own(x, y), own(y, x)) > 0.4)


def same_institution(a: Column, b: Column, generic: list[str] = [*INSTITUTIONS, *COMPANIES]) -> Column:  # noqa: B006
    """Names in comparing form that mean one institution: alike as they are or with words sorted, and alike without generic words."""
    near = (similarity(a, b) >= 0.92) | (similarity(sorted_words(a), sorted_words(b)) >= 0.92)
    return compass_agrees(a, b) & other_words_agree(a, b, generic) & near & (similarity(without_generic(a, generic), without_generic(b, generic)) >= 0.85)


def same_place(a: Column, b: Column, threshold: float = 0.88) -> Column:
    """The looser comparison within a city or country: names, names without generic words, and both with words sorted."""
    generic = lambda t: squeeze(F.regexp_replace(t, "|".join(INSTITUTIONS), " "))
    forms = [(generic(a), generic(b)), (a, b), (sorted_words(generic(a)), sorted_words(generic(b))), (sorted_words(a), sorted_words(b))]
    return F.greatest(*[similarity(x, y) for x, y in forms]) >= threshold


def processed(text: Column) -> Column:
    """An affiliation cleaned for counting: clipped words, case, signs, numbers and initials put right."""
    plain = without_articles(without_numbers(camel_case(spell_out(text))))
    plain = F.regexp_replace(F.regexp_replace(plain, r"\b (?:in|at) \w+\b", ""), r"^(?:and\b|&)", "")
    return join_initials(F.trim(plain))


def is_acronym(text: Column) -> Column:
    return is_abbreviation(text) & ~F.contains(text, F.lit(" "))
