"""Dictionary phrase tagging inside a row, with the longest-match rule.

A text becomes an array of tokens. For each phrase length, longest first, the n-grams at
words that open a phrase are looked up in a hash set, so the time does not depend on the
size of the dictionary. What is found is noted in a string of marks, one per token, and a
left-to-right pass of a short regular expression over the marks picks the earliest
non-overlapping spans; their tokens are marked as taken for the shorter phrases. That is
the rule "longest first, ties to the earliest start, no overlaps", in time linear in
the text, and without a shuffle: the text never leaves its row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_WORD = r"[\p{L}\p{M}\p{N}_]"
_TOKEN = rf"c\+\+|{_WORD}+(?:\.{_WORD}+)*|[\s\x0B\p{{Z}}]{{2,}}|[^ \p{{L}}\p{{M}}\p{{N}}_]"
# Marks: a token is free, opens a found phrase, opens a picked one, or is taken.
_FREE, _FOUND, _PICKED, _TAKEN = "0", "1", "2", "3"


def tokens(text: Column) -> Column:
    """Lower-case tokens: words (dots inside a word stay), ``c++``, and single punctuation marks.

    White space other than one plain space is a token too: words on two sides
    of a line break or of a wide gap are not neighbours.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def read_dictionary(spark: SparkSession, path: str, label: str = "SKILL") -> list[str]:
    """Phrases of one label from a two-column CSV (phrase, label).

    They ride along in the plan of :func:`tag_phrases`, so the driver holds them all.
    """
    rows = (
        spark.read.schema("phrase string, label string").csv(path, header=True)
        .filter((F.col("label") == label) & (F.trim("phrase") != ""))
        .select("phrase").distinct().orderBy("phrase").collect()
    )
    return [r.phrase for r in rows]


def _spellings(spark: SparkSession, phrases: list[str], tokenize: bool) -> dict[str, list[str]]:
    """Token form of each phrase -> its lower-case spellings."""
    plain = sorted({" ".join(p.lower().split()) for p in phrases if p.strip()})
    if not tokenize:
        return {p: [p] for p in plain}
    # The dictionary goes through the same expression as the texts.
    rows = (
        spark.createDataFrame([(p,) for p in plain], "phrase string")
        .select("phrase", F.array_join(tokens(F.col("phrase")), " ").alias("form"))
        .orderBy("phrase").collect()
    )
    spelling: dict[str, list[str]] = {}
    for r in rows:
        if r.form:
            spelling.setdefault(r.form, []).append(r.phrase)
    return spelling


def _by_length(forms) -> dict[int, list[str]]:
    lengths: dict[int, list[str]] = {}
    for form in sorted(forms):
        lengths.setdefault(form.count(" ") + 1, []).append(form)
    return dict(sorted(lengths.items(), reverse=True))


def _quoted(text: str) -> str:
    return "'" + re.sub(r"([\\'])", r"\\\1", text) + "'"


def _among(item: str, forms) -> str:
    """SQL text of a lookup in a constant set, which Spark evaluates with a hash set."""
    return f"{item} IN ({', '.join(map(_quoted, sorted(forms)))})"


def _ngram(words: str, start: str, length: int) -> str:
    """SQL text of the words from ``start`` on; fewer at the end of the text, where no phrase of this length fits."""
    return f"concat_ws(' ', {', '.join(f'get({words}, {start} + {k})' for k in range(length))})"


def _respelt(found: str, spelling: dict[str, list[str]]) -> str:
    """SQL text that replaces token forms by the phrases they stand for.

    The constant maps are cut into buckets by hash, because a map is searched from end to end.
    """
    respelt = {form: names for form, names in spelling.items() if names != [form]}
    if not respelt:
        return found
    buckets = max(1, len(respelt) // 4)
    # Sorted by the first four characters' code, which Python and SQL compute alike.
    code = lambda form: sum(ord(c) * 31 ** k for k, c in enumerate(form[:4])) % buckets
    maps: list[list[str]] = [[] for _ in range(buckets)]
    for form, names in respelt.items():
        maps[code(form)].append(f"{_quoted(form)}, array({', '.join(map(_quoted, names))})")
    table = ", ".join(f"map({', '.join(entries)})" if entries else "map('', array(''))" for entries in maps)
    spot = " + ".join(f"coalesce(ascii(nullif(substr(p, {k + 1}, 1), '')), 0) * {31 ** k}" for k in range(4))
    return f"flatten(transform({found}, p -> coalesce(try_element_at(array({table})[({spot}) % {buckets}], p), array(p))))"


def tag_phrases(
    df: DataFrame,
    text: str,
    phrases: list[str],
    output: str = "skills",
    tokenize_dictionary: bool = False,
) -> DataFrame:
    """Add an array column with the distinct dictionary phrases found in ``text``.

    With ``tokenize_dictionary=False`` entries are split at spaces only, so an
    entry such as ``ci/cd`` cannot be found, because texts are split at ``/``.
    ``True`` makes these entries reachable; entries of one token form are all reported.
    """
    spelling = _spellings(df.sparkSession, phrases, tokenize_dictionary)
    if not spelling:
        return df.withColumn(output, F.array().cast("array<string>"))
    words, marks, opens = "_tagging_words", "_tagging_marks", "_tagging_opens"
    found = [f"_tagging_found{length}" for length in _by_length(spelling)]
    free = F.expr(f"repeat('{_FREE}', size({words}))")
    tagged = df.withColumn(words, F.coalesce(tokens(F.col(text)), F.array().cast("array<string>"))).withColumn(marks, free)
    for name, (length, forms) in zip(found, _by_length(spelling).items()):
        if length == 1:
            hit = f"m = '{_FREE}' AND {_among('w', forms)}"
            pairs = f"zip_with({words}, split({marks}, ''), (w, m) -> if({hit}, w, NULL))"
            picked = f"array_compact({pairs})"
            tagged = tagged.withColumn(name, F.expr(picked))
            continue
        openers = {form.split(" ")[0] for form in forms}
        gram = _among(_ngram(words, "i", length), forms)
        tagged = tagged.withColumn(opens, F.expr(f"transform({words}, (w, i) -> {_among('w', openers)} AND {gram})"))
        marked = f"array_join(zip_with(split({marks}, ''), {opens}, (m, o) -> if(o AND m = '{_FREE}', '{_FOUND}', m)), '')"
        pattern, picked_as = f"{_FOUND}[{_FREE}{_FOUND}]{{{length - 1}}}", _PICKED + _TAKEN * (length - 1)
        noted = f"if(array_contains({opens}, true), regexp_replace({marked}, '{pattern}', '{picked_as}'), {marks})"
        tagged = tagged.withColumn(marks, F.expr(noted))
        starts = f"filter(transform(split({marks}, ''), (m, i) -> if(m = '{_PICKED}', i, -1)), i -> i >= 0)"
        tagged = tagged.withColumn(name, F.expr(f"transform({starts}, i -> {_ngram(words, 'i', length)})"))
        tagged = tagged.withColumn(marks, F.translate(marks, _FOUND + _PICKED, _FREE + _TAKEN))
    every = f"concat({', '.join(found)})"
    return tagged.withColumn(output, F.expr(f"array_distinct({_respelt(every, spelling)})")).drop(words, marks, opens, *found)


def phrase_hits(
    df: DataFrame, key: str, text: str, phrases: list[str], tokenize_dictionary: bool = False
) -> DataFrame:
    """Every dictionary hit before the overlap rule: (key, start, n_words, phrase).

    Word n-grams are compared with the dictionary inside the row, so only hits
    are turned into rows.
    """
    spelling = _spellings(df.sparkSession, phrases, tokenize_dictionary)
    openers = sorted({form.split(" ")[0] for form in spelling})
    words = df.select(key, tokens(F.col(text)).alias("_words"))
    # Only positions whose word opens some phrase are looked at further.
    placed = F.transform("_words", lambda w, i: F.struct(w.alias("word"), i.alias("start")))
    starts = F.filter(placed, lambda s: s["word"].isin(openers))
    words = words.withColumn("_starts", F.transform(starts, lambda s: s["start"]))
    parts = []
    for length, forms in _by_length(spelling).items():
        grams = F.transform("_starts", _gram(F.col("_words"), length))
        parts.append(F.filter(grams, lambda g: g["phrase"].isin(forms)))
    return words.select(key, F.inline(F.concat(*parts)))


def _gram(words: Column, length: int):
    def gram(start: Column) -> Column:
        if length == 1:
            phrase = F.get(words, start)
        else:
            phrase = F.array_join(F.slice(words, start + 1, F.lit(length)), " ")
        return F.struct(
            start.alias("start"), F.lit(length).alias("n_words"), phrase.alias("phrase")
        )

    return gram
