"""Operator 4: exact token counts at every prefix of a text, by dynamic programming.

For a BPE vocabulary, the tokens of a prefix are the tokens of a shorter prefix plus
one last token, and exactly one last token is possible: it must encode to itself, and
together with the token before it, it must encode to just those two. So one pass over
a word finds, from the stored last token and count of each shorter prefix, those of the
next. This holds the counts of all prefixes; how many tokens a text has, how many its
first characters have, or how far a token budget reaches is then read off.

The counts are kept as one signed byte per character: how many tokens more (or fewer:
a longer prefix can have fewer tokens) the prefix has with this character. No token has
over 127 characters, so a byte suffices; that is checked.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import map_texts, text_of
from hirelake.llm.scan import KeyTable, UnitTable, fingerprints, mix, text_bytes, tool


#: Longer words are counted one by one instead of as rows of a matrix.
ROW_BYTES = 64


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100 on."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte if byte in printing else next(spare)) for byte in range(256)]


class PrefixCounter:
    """Prefix counts for a ``tokenizers`` file: BPE with word ends over lower-cased words, white space dropped.

    Prefixes are those of the text in normal form NFC, which is the text itself unless
    it holds characters in parts. A prefix counts as a text of its own: its last word ends
    where it ends. The strings of special tokens count as one token, as the library's default has it.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        model = file["model"]
        self.end = model["end_of_word_suffix"]
        self.vocabulary = set(model["vocab"])
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.longest = max(len(token.removesuffix(self.end)) for token in self.vocabulary)
        if self.longest > 127:
            raise ValueError("a token has over 127 characters")
        splits = [x["pattern"]["Regex"] for x in file["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        pattern = splits[0].replace(r"\s", r"\p{White_Space}")
        self.words = regex.compile(pattern)
        self.pieces = regex.compile(pattern + r"|\p{White_Space}+")
        self.special = [x["content"] for x in file["added_tokens"]]
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.letters = _byte_letters()
        self.whole = functools.lru_cache(1 << 17)(self._encodes_to_itself)
        self.fits = functools.lru_cache(1 << 16)(self._stays_apart)
        self.tokens = sorted(self.vocabulary)
        byte = {letter: k for k, letter in enumerate(self.letters)}
        ended = np.array([token.endswith(self.end) and token != self.end for token in self.tokens])
        spelled = [bytes(byte[x] for x in token.removesuffix(self.end)) if end else bytes(byte[x] for x in token if x in byte)
                   for token, end in zip(self.tokens, ended)]
        ends = np.cumsum([len(x) for x in spelled])
        prints = fingerprints(np.frombuffer(b"".join(spelled), np.uint8), ends - [len(x) for x in spelled], ends)
        self.inner, self.outer = KeyTable(), KeyTable()
        for table, those in ((self.inner, np.flatnonzero(~ended)), (self.outer, np.flatnonzero(ended))):
            table.add(prints[those], those)
        self.checked = np.full(len(self.tokens), -1, np.int8)
        self.apart = KeyTable()
        self.table = UnitTable(self.encode_units, np.int8)

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: the leftmost pair of least rank is merged until none is left."""
        symbols = list(symbols)
        while len(symbols) > 1:
            rank, at = min((self.ranks.get(pair, len(self.ranks)), k) for k, pair in enumerate(zip(symbols, symbols[1:])))
            if rank == len(self.ranks):
                break
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _symbols(self, token: str) -> list[str]:
        if not token.endswith(self.end) or token == self.end:
            return list(token)
        head = token.removesuffix(self.end)
        return [*head[:-1], head[-1] + self.end]

    def _encodes_to_itself(self, token: str) -> bool:
        return token in self.vocabulary and len(self.merge(self._symbols(token))) == 1

    def _stays_apart(self, left: str, right: str) -> bool:
        return self.merge([*left, *self._symbols(right)]) == [left, right]

    def word_counts(self, word: str, known: tuple[list, list, list]) -> None:
        """Fill ``known`` with the last token and the count without word end, and the count as a whole word, of every prefix."""
        last, inner, outer = known
        for at in range(1, len(word) + 1):
            found = closed = None
            for start in range(max(0, at - self.longest), at):
                if last[start] is None:
                    continue
                token = word[start:at]
                if found is None and self.whole(token) and (not start or self.fits(last[start], token)):
                    found = (token, inner[start] + 1)
                if closed is None and self.whole(token + self.end) and (not start or self.fits(last[start], token + self.end)):
                    closed = inner[start] + 1
            last.append(found[0])
            inner.append(found[1])
            outer.append(closed)

    def _known_tokens(self, table: KeyTable, prints: np.ndarray) -> np.ndarray:
        """Numbers of the tokens with these fingerprints that encode to themselves, else -1."""
        found = table.find(prints)
        there = np.unique(found[found >= 0])
        for k in there[self.checked[there] < 0].tolist():
            self.checked[k] = self.whole(self.tokens[k])
        found[(found >= 0) & (self.checked[found] == 0)] = -1
        return found

    def _all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the tokens of each pair of numbers stay apart; -2 on the left is the start of a word."""
        answer = left == -2
        live = np.flatnonzero(left >= 0)
        keys = mix((left[live].astype(np.uint64) << np.uint64(32)) | right[live].astype(np.uint64))
        known = self.apart.find(keys)
        new, first = np.unique(keys[known < 0], return_index=True)
        if len(new):
            if self.apart.used + len(new) > 2_000_000:
                self.apart = KeyTable()
                return self._all_fit(left, right)
            at = live[known < 0][first]
            fit = [self._stays_apart(self.tokens[a], self.tokens[b]) for a, b in zip(left[at].tolist(), right[at].tolist())]
            self.apart.add(new, np.array(fit, np.int32))
            known = self.apart.find(keys)
        answer[live] = known > 0
        return answer

    def rows_counts(self, raw: np.ndarray, starts: np.ndarray, widths: np.ndarray) -> np.ndarray:
        """Counts as whole words of all prefixes of words, a row per word; the widths (in bytes) must not rise."""
        shape = (len(starts), int(widths[0]) + 1)
        last = np.full(shape, -1, np.int32)
        last[:, 0] = -2
        inner = np.zeros(shape, np.int32)
        outer = np.zeros(shape, np.int32)
        for at in range(1, shape[1]):
            many = int(np.searchsorted(-widths, -at, "right"))  # so many words have this byte
            for start in range(at - 1, max(0, at - self.longest) - 1, -1):
                for table, open_rows in ((self.inner, last[:many, at] == -1), (self.outer, outer[:many, at] == 0)):
                    rows = np.flatnonzero(open_rows & (last[:many, start] != -1))
                    if not len(rows):
                        continue
                    token = self._known_tokens(table, fingerprints(raw, starts[rows] + start, starts[rows] + at))
                    rows, token = rows[token >= 0], token[token >= 0]
                    fit = self._all_fit(last[rows, start], token)
                    rows, token = rows[fit], token[fit]
                    if table is self.inner:
                        last[rows, at], inner[rows, at] = token, inner[rows, start] + 1
                    else:
                        outer[rows, at] = inner[rows, start] + 1
        return outer[:, 1:]

    def words_steps(self, words: list[str]) -> dict[str, bytes]:
        """The change of the count at every character of distinct words."""
        out: dict[str, bytes] = {}
        rows = []
        for word in words:
            spelled = word.encode()
            if len(spelled) > ROW_BYTES:
                known: tuple[list, list, list] = ([""], [0], [0])
                self.word_counts("".join(map(self.letters.__getitem__, spelled)), known)
                ends = np.cumsum([len(letter.encode()) for letter in word])
                out[word] = self._differences(np.array(known[2])[ends])
            else:
                rows.append((-len(spelled), spelled, word))
        rows.sort()
        for at in range(0, len(rows), 1 << 15):
            part = rows[at:at + (1 << 15)]
            widths = -np.fromiter((row[0] for row in part), np.int64, len(part))
            raw = np.frombuffer(b"".join(row[1] for row in part), np.uint8)
            starts = np.cumsum(widths) - widths
            counts = self.rows_counts(raw, starts, widths)
            inside = np.arange(counts.shape[1]) < widths[:, None]
            ends = np.append((raw[1:] & 0xC0) != 0x80, True)  # the last byte of each character
            inside[inside] = ends
            flat, characters = counts[inside], inside.sum(axis=1)
            first = np.cumsum(characters) - characters
            changes = np.diff(flat, prepend=0)
            changes[first] = flat[first]
            steps, first = changes.astype(np.int8).tobytes(), first.tolist()
            for row, a, b in zip(part, first, [*first[1:], len(flat)]):
                out[row[2]] = steps[a:b]
        return out

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The changes of the count at every character of the units, end to end, and how many characters each has."""
        lowered: list[str] = []
        odd: dict[int, bytes] = {}
        for k, unit in enumerate(units):
            text = unit.decode()
            lower = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
            if len(lower) != len(text) or not unicodedata.is_normalized("NFC", text) or "<|" in text and self.special_split.search(text):
                odd[k], lower = self.odd_steps(text), ""
            lowered.append(lower)
        steps = self.lowered_steps(lowered)
        out = [odd[k] if k in odd else plain for k, plain in enumerate(steps)]
        return np.frombuffer(b"".join(out), np.int8), np.fromiter(map(len, out), np.int64, len(out))

    def lowered_steps(self, texts: list[str]) -> list[bytes]:
        """The changes at every character of lower-cased texts without special tokens."""
        split = list(map(self.pieces.findall, texts))
        steps: dict[str, bytes] = {}
        words = []
        for piece in set().union(*split):
            if self.words.match(piece) is None:  # white space
                steps[piece] = bytes(len(piece))
            elif piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # cut short, it is a quote and a word
                steps[piece] = self._differences([*(self.count(piece[:k]) for k in range(1, len(piece))), self._alone(piece)])
            else:
                words.append(piece)
        steps |= self.words_steps(words)
        return [b"".join(map(steps.__getitem__, pieces)) for pieces in split]

    @staticmethod
    def _differences(counts) -> bytes:
        return np.diff(np.asarray(counts, np.int64), prepend=0).astype(np.int8).tobytes()

    def odd_steps(self, unit: str) -> bytes:
        """The changes for a unit with special tokens, characters in parts, or letters that are two in lower case."""
        out = []
        parts = self.special_split.split(unit)
        tail = ""  # what stands right before, up to white space or a special token
        for k, part in enumerate(parts):
            if k % 2:
                base = self.count(tail)
                out.append(self._differences([*(self.count(tail + part[:n]) - base for n in range(1, len(part))), 1]))
                tail = ""
                continue
            part = unicodedata.normalize("NFC", part)
            lowered = "".join(map(str.lower, part))
            counts = np.cumsum(np.frombuffer(self.lowered_steps([lowered])[0], np.int8), dtype=np.int64)
            ends = np.cumsum([len(letter.lower()) for letter in part], dtype=np.int64)  # a few letters are two in lower case
            out.append(self._differences(counts[ends - 1]))
            tail = regex.split(r"\p{White_Space}", lowered)[-1]
        return b"".join(out)

    def _alone(self, word: str) -> int:
        """Count of one word: by plain merging, or from its prefixes if it is long."""
        spelled = [self.letters[byte] for byte in word.encode()]
        if len(spelled) > ROW_BYTES:
            known: tuple[list, list, list] = ([""], [0], [0])
            self.word_counts("".join(spelled), known)
            return known[2][-1]
        spelled[-1] += self.end
        return len(self.merge(spelled))

    def count(self, lowered: str) -> int:
        """Count of a lower-cased text without special tokens."""
        return sum(map(self._alone, self.words.findall(lowered)))


def load(path: str) -> PrefixCounter:
    """The counter of a file, built once per Python worker."""
    return tool(("counts", path), lambda: PrefixCounter(path))


def prefix_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``steps`` for every whole text.

    ``steps`` is a binary with a signed byte per character: the change of the token count. Ask it
    with :func:`tokens_of_prefix` and :func:`longest_prefix`. One row per input row, repeated
    rows and null ids included; a null text counts as empty (no bytes, no tokens). Other
    columns, whatever their names, are not read. No shuffle; ``path`` must exist on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path).table
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            tokens = np.zeros(batch.num_rows, np.int64)
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for k, steps in table.each(batch.column(1)):
                tokens[k] += steps.sum(dtype=np.int64)
                parts[k].append(steps.tobytes())
            yield pa.record_batch(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(map(b"".join, parts), pa.binary())],
                ["doc_id", "n_bytes", "n_tokens", "steps"],
            )

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)},
                     "doc_id long, n_bytes long, n_tokens long, steps binary", run)


def _over_steps(counted: DataFrame, asked: str, answer: str, function) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                None if steps is None or wanted is None else function(np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64), wanted)
                for steps, wanted in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.int64())], ["doc_id", answer])

    return map_texts(counted, {"doc_id": counted["doc_id"], "steps": counted["steps"], "asked": F.expr(asked).cast("long")},
                     f"doc_id long, {answer} long", run)


def tokens_of_prefix(counted: DataFrame, characters: str) -> DataFrame:
    """``doc_id`` and ``prefix_tokens``: tokens of the first ``characters`` (an SQL expression) characters.

    ``counted`` comes from :func:`prefix_counts`. No text is encoded again. More characters
    than the text has mean the whole text, fewer than one none; null gives null.
    """
    return _over_steps(counted, characters, "prefix_tokens",
                       lambda counts, k: int(counts[min(k, len(counts)) - 1]) if min(k, len(counts)) > 0 else 0)


def longest_prefix(counted: DataFrame, budget: str) -> DataFrame:
    """``doc_id`` and ``prefix_characters``: the longest prefix with at most ``budget`` (an SQL expression) tokens.

    ``counted`` comes from :func:`prefix_counts`. No text is encoded again. A negative budget gives 0; null gives null.
    """

    def reach(counts: np.ndarray, most: int) -> int:
        fitting = np.flatnonzero(counts <= most)
        return int(fitting[-1]) + 1 if len(fitting) else 0

    return _over_steps(counted, budget, "prefix_characters", reach)
