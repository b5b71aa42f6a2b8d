"""Phrases, spelling variants and the tokenization automaton against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelake.llm import automaton, phrases, variants
from hirelake.llm.arrow import importable
from tests.llm.test_operators import same

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def _paths(spark):
    importable(spark)


@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_file(WORD)


# --- automaton ---------------------------------------------------------------

def test_automaton(run, read, coder, folder):
    expected = []
    for doc, text in read(folder, "documents", "doc_id", "text"):
        ids = coder.encode(text or "", add_special_tokens=False).ids
        decoded = coder.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    same(run("op13_automaton", folder, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), expected)


def test_automaton_of_few_merges_is_plain_merging():
    """Random merges over two letters: the sequence that all merges give is accepted, and it is the only one."""
    pick = random.Random(3)
    for _ in range(30):
        known, merges = ["a", "b"], []
        while len(known) < 9:
            made = pick.choice(known) + pick.choice(known)
            parts = [(u, made[len(u):]) for u in known if made.startswith(u) and made[len(u):] in known]
            if made in known or not parts or len(made) > 6:
                continue
            merges.append((*pick.choice(parts), made))
            known.append(made)
        number = {x: k for k, x in enumerate(known)}
        tokens = automaton.TokenAutomaton([0, 1], [tuple(number[x] for x in merge) for merge in merges])

        def accepted(word, last=-1):
            if not word:
                return [[]]
            return [[x, *rest] for x in known if word.startswith(x) and tokens.live[number[x]] and tokens.has_arc(tokens.state(last), number[x])
                    for rest in accepted(word[len(x):], number[x])]

        for size in range(1, 9):
            for code in range(1 << size):
                word = "".join("ab"[code >> k & 1] for k in range(size))
                parts = [*word]
                for u, v, made in merges:
                    k = 0
                    while k < len(parts) - 1:
                        if parts[k] == u and parts[k + 1] == v:
                            parts[k:k + 2] = [made]
                        k += 1
                assert accepted(word) == [parts], (merges, word)


def test_automaton_words(coder):
    pick = random.Random(1)
    words = ["".join(pick.choice("abehinorst") for _ in range(pick.randint(1, 30))) for _ in range(2000)]
    words += ["".join(pick.choice("!#$%&*+-=<>?@") for _ in range(pick.randint(1, 30))) for _ in range(500)]
    words += ["".join(pick.choice("日本語é한국ñç") for _ in range(pick.randint(1, 9))) for _ in range(500)]
    words += ["a" * 400, "ab" * 3000, "".join(pick.choice("etaoin") for _ in range(20000))]
    found = automaton.load(WORD)
    expected = [x.ids for x in coder.encode_batch(words, add_special_tokens=False)]
    assert [found.encode_word(word.encode()) for word in words] == expected
    small = automaton.WordAutomaton(WORD)
    small.limit = 50  # the table starts anew many times, within words too
    small._restart()
    assert [small.encode_word(word.encode()) for word in words] == expected


def test_automaton_texts(spark, coder):
    pick = random.Random(5)
    parts = [" ", "\n", "'re", "'", "the", "ing", "É", "é", "e\u0301", "日本", "12", "!?", "İ", "Σ", "<|endoftext|>", "<|", "\u3000", "\x1c"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 15))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = automaton.encode_texts(docs, WORD).cache()
    ids = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in coded.collect()}
    decoded = {r.doc_id: r.decoded for r in automaton.decode_ids(coded, WORD).collect()}
    for k, text in enumerate(texts):
        expected = coder.encode(text, add_special_tokens=False).ids
        assert ids[k] == expected and decoded[k] == coder.decode(expected, skip_special_tokens=False)


# --- variants ----------------------------------------------------------------

def variant_rows(docs):
    n = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {word: count for word, count in n.items() if len(word) >= 7 and count >= 2}
    near = collections.defaultdict(set)
    holes = collections.defaultdict(list)
    for word in n:
        for k in range(len(word)):
            holes[word[:k], word[k + 1:]].append(word)
            short = word[:k] + word[k + 1:]
            if short in n:
                near[word].add(short)
                near[short].add(word)
    for words in holes.values():
        for word in words:
            near[word].update(x for x in words if x != word)
    form = {word: min(found, key=lambda x: (-n[x], x)) for word, found in near.items() if found}
    form = {word: x for word, x in form.items() if n[x] >= 10 * n[word]}

    def root(word):
        return root(form[word]) if word in form else word

    return [(word, form.get(word), root(word), n[word], len(near[word]), n.get(form.get(word))) for word in n]


VARIANTS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_variants(run, read, folder):
    same(run("op12_variants", folder, *VARIANTS), variant_rows(read(folder, "documents", "doc_id", "text")))


@pytest.mark.parametrize("cell", [7, 20000])
def test_variants_of_made_words(spark, monkeypatch, cell):
    """Words of few letters, anagrams, capitals, accents and long ones; chains of forms; many cells and one."""
    monkeypatch.setattr(variants, "CELL_WORDS", cell)
    pick = random.Random(6)
    stems = ["".join(pick.choice("abcé×") for _ in range(pick.randint(7, 10))) for _ in range(30)] + ["z" * 150, "anagrams", "managras", "SIRENAS"]
    words = []
    for k, stem in enumerate(stems):
        words += [stem] * (3 * 10 ** (k % 4))
        for _ in range(6):
            at = pick.randrange(len(stem))
            words += [stem[:at] + pick.choice(["", "x", stem[at] + "ÿ"]) + stem[at + 1:]] * pick.choice([1, 2, 25])
    pick.shuffle(words)
    docs = [(k if k % 7 else None, ", ".join(words[at:at + 50])) for k, at in enumerate(range(0, len(words), 50))]
    found = variants.variant_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(5))
    rows = [tuple(row) for row in found.select(*VARIANTS).collect()]
    same(rows, variant_rows(docs))
    assert any(row[1] and row[1] != row[2] for row in rows) or cell


# --- phrases -----------------------------------------------------------------

def phrase_rows(docs, plan):
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in range(1, plan.longest + 1):
                counts[lang].update(tuple(words[k:k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if a >= plan.least}
        covered = {p[i:j] for p, a in frequent.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                   if j - i < len(p) and a >= frequent[p[i:j]]}
        rows = []
        for p, a in frequent.items():
            if len(p) > 1 and p not in covered:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:plan.wanted], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return out


PHRASES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases(run, read, folder):
    same(run("op11_phrases", folder, *PHRASES), phrase_rows(read(folder, "documents", "lang", "text"), phrases.Plan()))


@pytest.mark.parametrize("plan", [phrases.Plan(least=3, wanted=40, batches=(0.05, 0.2)), phrases.Plan(least=2, wanted=5, batches=(0.01,))])
def test_phrases_of_made_texts(spark, plan):
    """Ties, a long text in parts, phrases that always go together, runs of one word, and a language that settles early."""
    pick = random.Random(2)
    rare = [f"r{k}" for k in range(60)]
    docs = []
    for k in range(200):
        words = pick.choices(["the", "of", "a", "Red", "red fox", "new york city", "x x x", *rare], k=pick.randint(0, 30))
        docs.append((pick.choice([None, "und", "en", "de"]), "".join(word + pick.choice([" ", " ", " ", "\t", ", ", ".\n"]) for word in words)))
    docs += [("en", None), ("en", " ".join(f"w{k % 50} red fox" for k in range(150_000)))]
    assert len(docs[-1][1].encode()) > 1 << 20
    found = phrases.phrase_report(spark.createDataFrame(docs, "lang string, text string").repartition(4), plan)
    same([tuple(row) for row in found.select(*PHRASES).collect()], phrase_rows(docs, plan))


def test_best_first_leaves_frequent_words_unexpanded(spark):
    """Rare pairs settle the language before the words of later batches are looked at."""
    docs = [("en", f"p{k} q{k}. the of the of the of") for k in range(40) for _ in range(3)]
    plan = phrases.Plan(least=3, wanted=10, batches=(0.3, 0.5))
    frame = spark.createDataFrame(docs, "lang string, text string")
    mined = phrases.mine(frame, plan)
    assert mined.rounds < 1 + len(plan.batches)
    same([tuple(row) for row in phrases.phrase_report(frame, plan).select(*PHRASES).collect()], phrase_rows(docs, plan))


def test_words_of_one_number_are_told_apart(spark):
    """What shows that another hash is needed, and that a count is the same with another hash."""
    part = np.frombuffer(b"foxes boxes fox a very long word of one number and more", np.uint8)
    starts, ends = np.array([0, 6, 0, 12]), np.array([5, 11, 5, 15])
    assert phrases._unlike(part, starts, ends, np.zeros(4, np.int64), starts[:1], ends[:1]).tolist() == [1, 3]
    docs = spark.createDataFrame([("en", "Red fox. red cat"), (None, "red")], "lang string, text string")
    counts = [sorted(tuple(row)[:1] + tuple(row)[2:] for row in phrases.word_counts(docs, seed, "lang", "text").collect()) for seed in (0, 3)]
    assert counts[0] == counts[1] == [("en", "cat", 1), ("en", "fox", 1), ("en", "red", 2), ("und", "red", 1)]


def test_filter_has_all_keys(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    found = phrases.Filter.of(keys)
    every = np.array([r.key for r in keys.collect()], np.int64).astype(np.uint64)
    assert found.has(every).all()
    others = np.array([r.key for r in spark.range(9000, 19000).selectExpr("xxhash64(id) AS key").collect()], np.int64).astype(np.uint64)
    assert found.has(others).mean() < 0.05


