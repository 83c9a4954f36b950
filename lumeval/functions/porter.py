"""Porter's stemmer (Porter 1980, with the usual later refinements) as a plan of JVM expressions.

``stem_words`` adds the stem of a column of lower-case words.  Each step is the lambda of a ``transform`` over
the step before, so the expression grows with the number of steps and is never copied into itself.  A word is rewritten in a marked form first: ``Y`` is a ``y`` that counts
as a consonant (at the start or after a vowel), so the paper's conditions become regular expressions over
``[aeiouy]`` (vowels) and its complement.  The marks of a prefix do not depend on what follows, so they
hold through all steps.  ``stem_sql`` gives the same steps as SQL common table expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The paper's suffixes and replacements of steps 2 to 4, and the irregular forms.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble",
         "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate",
         "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive",
         "biliti": "ble", "fulli": "ful", "logi": "log"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism",
         "ate", "iti", "ous", "ive", "ize"]
IRREGULAR = {"skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
             "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
             "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
             "exceed": "exceed", "succeed": "succeed"}

VOWEL = "[aeiouy]"
VC = "[aeiouy][^aeiouy]"            # m > 0: a vowel before a consonant
VC2 = f"{VC}.*{VC}"                 # m > 1
SHORT = "[^aeiouy][aeiouy][^aeiouywxY]$|^[aeiouy][^aeiouy]$"   # *o


def _ends(suffixes) -> str:
    """The longest of the suffixes that ends the word (the leftmost match)."""
    return "(" + "|".join(sorted(suffixes, key=len, reverse=True)) + ")$"


def _steps():
    """The steps as SQL expressions over ``w``, in a dialect that Spark and DuckDB share.

    Each is a list of (name, expression) whose names later expressions of the list may use; the last is
    the new ``w``.  ``{has(x, pattern)}`` and ``{end(pattern)}`` stand for the two functions whose names differ.
    """
    def has(x, pattern):
        return f"regexp_like({x}, '{pattern}')"

    def cut(n, x="w"):
        return f"substring({x}, 1, length({x}) - {n})"

    def replaced(table, cond):
        cases = " ".join(f"WHEN '{s}' THEN '{r}'" for s, r in table.items())
        return f"CASE WHEN s <> '' AND {cond} THEN concat(p, CASE s {cases} ELSE '' END) ELSE w END"

    def suffix(suffixes):
        return ("s", f"regexp_extract(w, '{_ends(suffixes)}', 1)"), ("p", "substring(w, 1, length(w) - length(s))")

    m1 = f"({has('{x}', VC)} AND NOT {has('{x}', VC2)})"
    yield [("w", r"replace(regexp_replace(w, '(^|[aeiou])y', '{1}Y'{g}), 'yy', 'yY')")]
    yield [("w", f"CASE WHEN w LIKE '%sses' THEN {cut(2)} WHEN w LIKE '%ies' THEN CASE WHEN length(w) = 4 THEN {cut(1)} "
                 f"ELSE {cut(2)} END WHEN w LIKE '%ss' THEN w WHEN w LIKE '%s' THEN {cut(1)} ELSE w END")]
    # 1b: what is left of -ed and -ing after a vowel is mended in the next step
    yield [("i", f"CASE WHEN w LIKE '%ied' OR w LIKE '%eed' THEN NULL WHEN w LIKE '%ed' AND {has(cut(2), VOWEL)} THEN {cut(2)} "
                 f"WHEN w LIKE '%ing' AND {has(cut(3), VOWEL)} THEN {cut(3)} END"),
           ("w", f"CASE WHEN i IS NOT NULL THEN CASE WHEN {has('i', '(at|bl|iz)$')} THEN concat(i, 'e') "
                 f"WHEN length(i) >= 2 AND lower(right(i, 1)) = lower(substring(i, length(i) - 1, 1)) "
                 f"AND {has('i', '[^aeiouy]$')} THEN CASE WHEN {has('i', '[lsz]$')} THEN i ELSE {cut(1, 'i')} END "
                 f"WHEN {m1.replace('{x}', 'i')} AND {has('i', SHORT)} THEN concat(i, 'e') ELSE i END "
                 f"WHEN w LIKE '%ied' THEN CASE WHEN length(w) = 4 THEN {cut(1)} ELSE {cut(2)} END "
                 f"WHEN w LIKE '%eed' AND {has(cut(3), VC)} THEN {cut(1)} ELSE w END")]
    yield [("w", f"CASE WHEN {has('w', '^.+[^aeiouy]y$')} THEN concat({cut(1)}, 'i') ELSE w END")]
    # 2: -alli is taken off first, what it leaves may end in -ational or -tional
    yield [("w", f"CASE WHEN w LIKE '%alli' AND {has(cut(4), VC)} THEN {cut(2)} ELSE w END")]
    yield [*suffix(STEP2), ("w", replaced(STEP2, f"({has('p', VC)} OR s = 'logi' AND {has(cut(3), VC)})"))]
    yield [*suffix(STEP3), ("w", replaced(STEP3, has("p", VC)))]
    yield [*suffix(STEP4), ("w", f"CASE WHEN s <> '' AND {has('p', VC2)} AND (s <> 'ion' OR {has('p', '[st]$')}) THEN p ELSE w END")]
    yield [("p", cut(1)),
           ("w", f"CASE WHEN w LIKE '%e' AND ({has('p', VC2)} OR {m1.replace('{x}', 'p')} AND NOT {has('p', SHORT)}) THEN p ELSE w END")]
    yield [("w", f"CASE WHEN w LIKE '%ll' AND {has(cut(1), VC2)} THEN {cut(1)} ELSE w END")]


def _irregular(word: str, otherwise: str) -> str:
    return f"CASE {word} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items()) + f" ELSE {otherwise} END"


def stem_words(words: DataFrame, word: str, stem: str = "stem") -> DataFrame:
    """``words`` with the stem of each word; words of up to two letters stay, null stays null."""
    name = "`" + word + "`"
    state = f"array(named_struct('w', {name}))"
    for parts in _steps():
        known = ["w"]
        for out, sql in parts:
            sql = _fields(sql.replace("{1}", "$1").replace("{g}", ""))
            kept = [] if out == "w" else [k for k in known if k != out]
            known = [*kept, out]
            state = f"transform({state}, x -> named_struct({''.join(f"'{k}', x.{k}, " for k in kept)}'{out}', {sql}))"
    done = _irregular(name, f"lower({state}[0].w)")
    return words.withColumn(stem, F.expr(f"CASE WHEN length({name}) <= 2 THEN {name} ELSE {done} END"))


def _fields(sql: str) -> str:
    """The step's names as fields of the lambda's variable."""
    quoted = re.split(r"('[^']*')", sql)
    return "".join(x if x.startswith("'") else re.sub(r"\b([wspi])\b", r"x.\1", x) for x in quoted)


def stem_sql(source: str, word: str) -> str:
    """Common table expressions ending in ``stems(word, stem)`` over the distinct words of ``source``."""
    ctes = [f"porter_0 AS (SELECT DISTINCT {word} AS word, {word} AS w FROM {source})"]
    for parts in _steps():
        inner = f"SELECT word, w FROM porter_{len(ctes) - 1}"
        for name, sql in parts:
            sql = sql.replace("{1}", r"\1").replace("{g}", ", 'g'").replace("regexp_like", "regexp_matches")
            kept = "word" if name == "w" else "* EXCLUDE (w), w"
            inner = f"SELECT {kept}, {sql} AS {name} FROM ({inner})"
        ctes.append(f"porter_{len(ctes)} AS MATERIALIZED ({inner})")
    ctes.append(f"stems AS (SELECT word, CASE WHEN length(word) <= 2 THEN word ELSE {_irregular('word', 'lower(w)')} END "
                f"AS stem FROM porter_{len(ctes) - 1})")
    return ",\n".join(ctes)
