import random

import pytest
from pyspark.sql import functions as F

from hirelake import session
from hirelake.functions import tagging, text
from hirelake.operators import dictionary
from hirelake.plans.skills import skill_rows


def apply(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in df.select("i", expression(F.col("t"))).orderBy("i").collect()]


def test_clean_text(spark):
    values = ["  C++ & Café!\tin Zürich_1  ", None, "", "--"]
    assert apply(spark, text.clean_text, values) == ["c café in zürich_1", "", "", ""]


def test_normalize_company(spark):
    names = {
        "System One Holdings LLC": "system one", "Acme, Inc.": "acme", "Acme Inc": "acme",
        "Google (Alphabet)": "google", "Open (paren": "open paren", "The Group Partners Ltd.": "the",
        "Nestlé S.A.": "nestlé sa", "Services LLC": "", "under_score Co": "under_score",
        "Incline Corporation": "incline", "  spaced \t out  ": "spaced out", "Cocoa Co.": "cocoa",
        None: "", "": "",
    }
    assert apply(spark, text.normalize_company, list(names)) == list(names.values())
    again = apply(spark, text.normalize_company, list(names.values()))
    assert again == list(names.values())


@pytest.mark.parametrize("value, expected", [
    ("5 years", "5"), ("5+ yrs", "5+"), ("min 5-7 Years", "5-7"), ("3 - 5 years", "5"),
    ("5years", None), ("10 years", "10"), ("none", None), ("2 yr or 9 years", "2"),
    ("5-year", None), ("", None),
])
def test_experience(spark, value, expected):
    assert apply(spark, text.experience, [value]) == [expected]


def test_prompt_and_cluster_text(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("T!", "d")], "t string, d string")
    got = df.select(text.prompt_text(F.col("t"), F.col("d")),
                    text.title_and_description(F.col("t"), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [
        ("Title: a\nDescription: None", ""), ("Title: None\nDescription: b", ""),
        ("Title: T!\nDescription: d", "t d")]


def test_tokens(spark):
    got = apply(spark, tagging.tokens, ["C++, node.js (v3.5) a/b  c\nd c++x."])[0]
    assert got == ["c++", ",", "node.js", "(", "v3.5", ")", "a", "/", "b", "  ", "c", "\n", "d",
                   "c++", "x", "."]


def tag(spark, values, phrases, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    tagged = tagging.tag_phrases(df, "t", phrases, **options).orderBy("i").collect()
    return [sorted(r.skills) for r in tagged]


def test_longest_match_hides_shorter(spark):
    phrases = ["Spark", "Apache Spark", "SQL", "Microsoft SQL Server", "R", "C++", "Machine Learning"]
    texts = [
        "Apache Spark and spark.", "APACHE SPARK", "Microsoft SQL Server / SQL", "R, c++; C+",
        "machine  learning, machine\nlearning", "machine learning", "", None, "sparkR",
    ]
    assert tag(spark, texts, phrases) == [
        ["apache spark", "spark"], ["apache spark"], ["microsoft sql server", "sql"], ["c++", "r"],
        [], ["machine learning"], [], [], []]


def test_equal_length_goes_to_the_earlier(spark):
    assert tag(spark, ["a b c d", "x a b c"], ["a b", "b c", "c d"]) == [["a b", "c d"], ["a b"]]


def test_longer_later_phrase_beats_shorter_earlier(spark):
    assert tag(spark, ["a b c d"], ["a b", "b c d"]) == [["b c d"]]


def test_dictionary_entries_with_punctuation(spark):
    phrases = ["CI/CD", "Scikit-learn", "SQL", "T-SQL", "C#"]
    texts = ["ci/cd with scikit-learn", "T-SQL", "C# only"]
    assert tag(spark, texts, phrases) == [[], ["sql"], []]
    assert tag(spark, texts, phrases, tokenize_dictionary=True) == [
        ["ci/cd", "scikit-learn"], ["t-sql"], ["c#"]]


def test_empty_dictionary(spark):
    assert tag(spark, ["a b"], []) == [[]]


def brute_force(words, phrases):
    spans = [
        (n, s) for n in (1, 2, 3) for s in range(len(words) - n + 1)
        if " ".join(words[s:s + n]) in phrases
    ]
    taken, found = set(), set()
    for n, s in sorted(spans, key=lambda x: (-x[0], x[1])):
        if not taken & set(range(s, s + n)):
            taken |= set(range(s, s + n))
            found.add(" ".join(words[s:s + n]))
    return sorted(found), len(spans)


def test_tagger_equals_brute_force(spark):
    draw = random.Random(7)
    letters = "abcd"
    phrases = sorted({" ".join(draw.choices(letters, k=draw.choice([1, 2, 2, 3, 3]))) for _ in range(25)})
    texts = [" ".join(draw.choices(letters + "xy", k=draw.randrange(0, 40))) for _ in range(200)]
    expected = [brute_force(t.split(), phrases) for t in texts]
    assert tag(spark, texts, phrases) == [found for found, _ in expected]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    hits = tagging.phrase_hits(df, "i", "t", phrases).groupBy("i").count().collect()
    counts = {r.i: r["count"] for r in hits}
    assert [counts.get(i, 0) for i in range(len(texts))] == [n for _, n in expected]


def test_dictionary_file(spark, tmp_path):
    (tmp_path / "d.csv").write_text("phrase,label\nSQL,SKILL\nSQL,SKILL\nBoston,PLACE\n,SKILL\nC++,SKILL\n")
    assert tagging.read_dictionary(spark, str(tmp_path / "d.csv")) == ["C++", "SQL"]


def test_large_dictionary_costs_no_more(spark):
    """20,000 phrases; at most one and a half times the time of 200 on the same texts."""
    import time

    draw = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    many = sorted({" ".join(draw.choices(words, k=2)) for _ in range(20500)})[:20000]
    texts = [" ".join(draw.choices(words, k=1000)) for _ in range(800)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(4).cache()
    df.count()

    def seconds(phrases):
        tagged = tagging.tag_phrases(df, "t", phrases)
        took = []
        for _ in range(3):
            start = time.perf_counter()
            tagged.write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    small, large = seconds(many[::100]), seconds(many)
    assert large < 1.5 * small + 1.0  # a second for the larger plan itself
    found = {r.i: sorted(r.skills) for r in tagging.tag_phrases(df.where("i < 20"), "t", many).collect()}
    known = set(many)
    assert all(found[k] == brute_force(texts[k].split(), known)[0] for k in range(20))


def test_equal_token_forms_are_all_reported(spark):
    phrases = ["CI/CD", "ci / cd", "C#", "T-SQL", "t - sql"]
    assert tag(spark, ["ci/cd, c# and t-sql"], phrases, tokenize_dictionary=True) == [["c#", "ci / cd", "ci/cd", "t - sql", "t-sql"]]


def test_callers_columns_stay(spark):
    df = spark.createDataFrame([("sql", 1)], "t string, _hits2 int")
    assert tagging.tag_phrases(df, "t", ["sql", "a b"]).columns == ["t", "_hits2", "skills"]


def test_skill_rows(spark, rows):
    jobs = spark.createDataFrame(
        [("1", "SQL and sql, 5+ years of SQL"), ("2", "nothing"), ("3", None)],
        "job_id string, description string")
    got = skill_rows(jobs, ["SQL"], F.lit("2025-01-01"), "v1")
    assert rows(got) == [("1", "5+ years experience", "2025-01-01", "v1"), ("1", "sql", "2025-01-01", "v1")]


@pytest.mark.parametrize("tokenize", [False, True])
def test_dictionary_table_tags_as_the_list_does(spark, tokenize):
    """Random texts of few words, chains of overlaps, phrases of one to five words, and a very long text."""
    draw = random.Random(9)
    words = ["a", "b", "c++", "d/e", "f", "g.h"]
    phrases = sorted({" ".join(draw.choices(words, k=draw.randint(1, 5))) for _ in range(40)}) + [" ", "A  B", "d/e", "d/ e"]
    texts = [" ".join(draw.choices([*words, "x", "x,", "\n"], k=draw.randint(0, 60))) for _ in range(50)]
    texts += [None, "", "a " * 20000, " ".join(draw.choices(words, k=5000))]
    df = spark.createDataFrame([*enumerate(texts), (None, "a b")], "k long, text string").repartition(3)
    listed = tagging.tag_phrases(df, "text", phrases, "found", tokenize).where("k IS NOT NULL").collect()
    expected = {(r.k, p) for r in listed for p in r.found}
    table = spark.createDataFrame([(p,) for p in phrases], "phrase string")
    got = [tuple(r) for r in dictionary.tag_with(df, "k", "text", table, tokenize).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_plan_does_not_grow_with_the_dictionary(spark):
    df = spark.createDataFrame([(1, "phrase 7 and phrase 199999 of a b c")], "k long, text string")
    size = {}
    for n in (10, 200_000):
        table = spark.range(n).selectExpr("concat('phrase ', id) AS phrase")
        found = dictionary.tag_with(df, "k", "text", table)
        assert {r.phrase for r in found.collect()} == {f"phrase {k}" for k in (7, 199_999) if k < n}
        size[n] = len(found._jdf.queryExecution().analyzed().toString())
    assert size[200_000] < size[10] + 200


def test_only_passing_ngrams_become_rows(spark):
    """Of 60,000 n-grams without a hit next to none is written, and no hit is exchanged by its form."""
    texts = [(k, " ".join(f"w{k}x{i}" for i in range(200)) + " a b c") for k in range(100)]
    table = spark.createDataFrame([(p,) for p in ("a b c", "b", "z")], "phrase string")
    before = set(session.files(spark, session.scratch_folder(spark)))
    found = dictionary.tag_with(spark.createDataFrame([*texts, (None, "b"), (200, None)], "k long, text string"), "k", "text", table)
    assert sorted(found.collect()) == [(k, "a b c") for k in range(100)]
    new = set(session.files(spark, session.scratch_folder(spark))) - before
    passed, = [f for f in new if f.startswith("passed-")]
    assert 200 <= spark.read.parquet(f"{session.scratch_folder(spark)}/{passed}").count() < 500


def test_no_phrases(spark):
    df = spark.createDataFrame([(1, "a b")], "k long, text string")
    assert dictionary.tag_with(df, "k", "text", spark.createDataFrame([], "phrase string")).count() == 0
