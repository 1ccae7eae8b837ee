"""Word lists and the rule lemmatizer."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# English function words that the index leaves out.
STOPWORDS = (
    "a about above after again against all am an and any are as at be because been before being below between both but by can did do does doing "
    "down during each few for from further had has have having he her here hers him his how i if in into is it its just me more most my no nor not "
    "now of off on once only or other our out over own same she should so some such than that the their them then there these they this those "
    "through to too under until up very was we were what when where which while who whom why will with you your"
).split()
# Units and foreign articles left out as well.
UNIT_WORDS = "kg g mg ml l s ms km mm la en le de et los une un del i ii iii iv A per also ha cm non ton etc el among along".split()
DROPPED = sorted({*STOPWORDS, *UNIT_WORDS})


def _folding() -> tuple[str, str]:
    """Letters whose compatibility decomposition starts with one ASCII letter and goes on with marks only."""
    plain, folded = [], []
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii():
            plain.append(chr(code))
            folded.append(parts[0])
    return "".join(plain), "".join(folded)


FOLD_FROM, FOLD_TO = _folding()


def is_dropped(word: Column) -> Column:
    return word.isin(DROPPED)


def _cut(word: Column, n: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - n)


def _ends(word: Column, *tails: str) -> Column:
    out = F.endswith(word, F.lit(tails[0]))
    for tail in tails[1:]:
        out = out | F.endswith(word, F.lit(tail))
    return out


def lemma(word: Column) -> Column:
    """Singular of a noun by rule; other words stay. No patterns, since it runs once for every word of a text."""
    return (
        F.when(~_ends(word, "s", "men"), word)
        .when(word.isin("assess", "assesses"), F.lit("assess"))
        .when(_ends(word, "ies") & (F.length(word) >= 5), F.concat(_cut(word, 3), F.lit("y")))
        .when(_ends(word, "ches", "shes", "xes", "zes", "sses"), _cut(word, 2))
        .when(_ends(word, "men"), F.concat(_cut(word, 3), F.lit("man")))
        .when(~_ends(word, "ss", "us", "is") & (F.length(word) > 1), _cut(word, 1))
        .otherwise(word)
    )


def lemma_of(word: str) -> str:
    """The same for one word in Python."""
    if not word.endswith(("s", "men")):
        return word
    if word in ("assess", "assesses"):
        return "assess"
    if word.endswith("ies") and len(word) >= 5:
        return word[:-3] + "y"
    if word.endswith(("ches", "shes", "xes", "zes", "sses")):
        return word[:-2]
    if word.endswith("men"):
        return word[:-3] + "man"
    return word[:-1] if not word.endswith(("ss", "us", "is")) and len(word) > 1 else word


def lemma_sql(w: str) -> str:
    return (
        f"(CASE WHEN {w} IN ('assess', 'assesses') THEN 'assess' "
        f"WHEN regexp_matches({w}, '^.{{2,}}ies$') THEN regexp_replace({w}, 'ies$', 'y') "
        f"WHEN regexp_matches({w}, '(ch|sh|x|z|ss)es$') THEN regexp_replace({w}, 'es$', '') "
        f"WHEN regexp_matches({w}, 'men$') THEN regexp_replace({w}, 'men$', 'man') "
        f"WHEN regexp_matches({w}, '[^sui]s$') THEN regexp_replace({w}, 's$', '') ELSE {w} END)"
    )


DROPPED_SQL = ", ".join(f"'{w}'" for w in DROPPED)
