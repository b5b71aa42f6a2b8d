"""Operator 13: BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens: a word's sequence of tokens is accepted if and only if it is
the one that the merges give. It is built merge by merge. At first one state has an arc for every
symbol back to itself. The gadget of a merge (u, v) takes every path over a u-arc and a v-arc, gives
it a direct arc labelled uv, and sends u-arcs to a copy of the state behind them that lacks the v-arc. All
u-arcs lead to one state at any time, so a merge makes one state, which is kept as what it lacks
against the state it was copied from; arcs are added to all states with a u-arc, which is
a step in the tree of labels by their left parts.

A word is encoded by a deterministic automaton over its bytes: the subset construction of the above, whose states are
made when they are first entered and then found in a table. Exactly one token can end at each byte of a
word, so its tokens are read off backwards. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from hirelake.llm.arrow import map_texts, text_of
from hirelake.llm.scan import UnitTable, spread_ranges, tool

#: So many transitions are kept (about 300 bytes each with their states); the table then starts anew.
TRANSITIONS = 200_000


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it prints, else the next from U+0100 on."""
    printing = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte if byte in printing else next(spare)) for byte in range(256)]


class TokenAutomaton:
    """States and arcs over tokens, from the merges in their order.

    ``follows(token, label)`` tells whether the state behind ``token`` has an arc of that label; -1 is the start of a word.
    """

    def __init__(self, symbols: list[int], merges: list[tuple[int, int, int]]):
        size = max([*symbols, *(made for _, _, made in merges)]) + 1
        self.left, self.right = [-1] * size, [-1] * size
        self.made_at = [-1] * size  # the merge that made an arc of this label, -1 for symbols
        self.live = [False] * size  # whether any arc has this label
        self.lacks: list[dict[int, int]] = [{} for _ in range(size)]  # by token: the arcs its state lost, and at which merge
        self.longer: list[list[int]] = [[] for _ in range(size)]  # by label: the labels that begin with it, in the order of their merges
        for symbol in symbols:
            self.live[symbol] = True
        for turn, (u, v, made) in enumerate(merges):
            if self.made_at[made] >= 0 or made in (u, v):
                raise ValueError("a token is made by two merges")
            if self.live[u] and self._has_arc(u, v):
                self.left[made], self.right[made], self.made_at[made], self.live[made] = u, v, turn, True
                self.longer[u].append(made)
                self.lacks[u][v] = turn
        self._tables(symbols)

    def _has_arc(self, token: int, label: int) -> bool:
        """Whether the state behind ``token`` has an arc of this label now.

        The state behind uv is what the state behind v was when uv was made; an arc uv was added where the
        arc u was then. So the losses of each right part count up to the merge it went into, and
        those of each left part of the label likewise.
        """
        if not self.live[label]:
            return False
        before = len(self.made_at) * 2
        while token >= 0:
            lost = self.lacks[token]
            if lost:
                part, until = label, before
                while part >= 0:
                    # A loss at the very merge that made the longer label: its two parts are the same token.
                    if lost.get(part, before) < min(until, before):
                        return False
                    part, until = self.left[part], self.made_at[part] + 1
            before = self.made_at[token] if self.made_at[token] >= 0 else 0
            token = self.right[token]
        return True

    def _tables(self, symbols: list[int]) -> None:
        """Labels numbered so that what a state lacks is a few ranges: each label before those made from it, the last made first."""
        number, end = [-1] * len(self.live), [-1] * len(self.live)
        counter = 0
        for symbol in symbols:
            stack = [(symbol, False)]
            while stack:
                label, closed = stack.pop()
                if closed:
                    end[label] = counter
                    continue
                number[label] = counter
                counter += 1
                stack.append((label, True))
                stack.extend((child, False) for child in self.longer[label])  # the last made is taken first
        self.number, self.end = number, end
        self.ranges: list[tuple[array, array]] = [(array("i"), array("i"))]
        self.known: dict[bytes, int] = {b"": 0}
        self.state_of: dict[int, int] = {-1: 0}

    def state(self, token: int) -> int:
        """The state behind a token (-1: at the start of a word), its ranges laid out when first asked for."""
        if token in self.state_of:
            return self.state_of[token]
        lost: list[tuple[int, int]] = []
        part, before = token, len(self.live) * 2
        while part >= 0:
            for label, turn in self.lacks[part].items():
                if turn < before:
                    # The label itself and those made from it at that merge or later; these follow it in the numbers.
                    stop = self.number[label] + 1
                    for child in self.longer[label]:
                        if self.made_at[child] >= turn:
                            stop = self.end[child]
                            break
                    lost.append((self.number[label], stop))
            before = self.made_at[part] if self.made_at[part] >= 0 else 0
            part = self.right[part]
        lost.sort()
        merged: list[tuple[int, int]] = []
        for low, high in lost:
            if merged and low <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(high, merged[-1][1]))
            else:
                merged.append((low, high))
        lows, highs = array("i", (low for low, _ in merged)), array("i", (high for _, high in merged))
        found = self.known.setdefault(lows.tobytes() + highs.tobytes(), len(self.ranges))
        if found == len(self.ranges):
            self.ranges.append((lows, highs))
        self.state_of[token] = found
        return found

    def has_arc(self, state: int, label: int) -> bool:
        """Whether a state has an arc of this label (as :meth:`state` numbers them)."""
        low, high = self.ranges[state]
        at = bisect_right(low, self.number[label]) - 1
        return at < 0 or self.number[label] >= high[at]


class WordAutomaton:
    """A ``tokenizers`` file: BPE with word ends over lower-cased words, white space dropped, no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as lines:
            file = json.load(lines)
        model = file["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        byte = {letter: k for k, letter in enumerate(letters)}
        symbols = [vocabulary[letter + end] for end in ("", suffix) for letter in letters]
        merges = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in model["merges"]]
        self.tokens = TokenAutomaton(symbols, merges)
        self.special = {x["content"]: x["id"] for x in file["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        splits = [x["pattern"]["Regex"] for x in file["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split"]
        # Python's \s also has the separators 1C to 1F, which are no white space to Unicode.
        self.words = regex.compile(splits[0].replace(r"\s", r"\p{White_Space}"))

        # The labels as a tree over bytes; a label ends inside a word or closes it.
        self.step: list[dict[int, int]] = [{}]
        self.inside, self.closing = [-1], [-1]
        self.size = [0] * len(self.tokens.live)
        for label, number in vocabulary.items():
            if number >= len(self.tokens.live) or not self.tokens.live[number]:
                continue
            closes = label.endswith(suffix) and label != suffix
            spelled = [byte[letter] for letter in (label.removesuffix(suffix) if closes else label)]
            node = 0
            for x in spelled:
                if x not in self.step[node]:
                    self.step[node][x] = len(self.step)
                    self.step.append({})
                    self.inside.append(-1)
                    self.closing.append(-1)
                node = self.step[node][x]
            (self.closing if closes else self.inside)[node] = number
            self.size[number] = len(spelled)
        self.limit = TRANSITIONS
        self._restart()

        texts = {number: label for label, number in vocabulary.items()} | {number: label for label, number in self.special.items()}
        spelled = [texts.get(number, "").encode() for number in range(max(texts) + 1)]
        self.label_length = np.fromiter(map(len, spelled), np.int64, len(spelled)) + 1
        self.label_start = np.cumsum(self.label_length) - self.label_length
        self.label_bytes = np.frombuffer(b"".join(x + b" " for x in spelled), np.uint8)
        self.table = UnitTable(self.encode_units, np.uint32)

    def _restart(self) -> None:
        self.entered = 0
        start = ((0, 0),)
        self.numbers: dict[tuple, int] = {start: 0}
        self.members = [start]
        self.moves: list[dict[int, tuple[int, int]]] = [{}]
        self.ends: list[dict[int, int]] = [{}]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """The state after one more byte, and the token that ends there; both kept in the table."""
        tokens, on, ended = self.tokens, [], -1
        for behind, node in self.members[state]:
            node = self.step[node].get(byte)
            if node is None:
                continue
            if self.inside[node] >= 0 and tokens.has_arc(behind, self.inside[node]):
                ended = self.inside[node]
            if self.step[node] or self.closing[node] >= 0:
                on.append((behind, node))
        on.append((tokens.state(ended), 0))
        key = tuple(on)
        after = self.numbers.get(key)
        if after is None:
            after = self.numbers[key] = len(self.members)
            self.members.append(key)
            self.moves.append({})
            self.ends.append({})
        self.moves[state][byte] = after, ended
        self.entered += 1
        return after, ended

    def _end(self, state: int, byte: int) -> int:
        """The token that closes a word with this byte, kept in the table."""
        closed = -1
        for behind, node in self.members[state]:
            node = self.step[node].get(byte)
            if node is not None and self.closing[node] >= 0 and self.tokens.has_arc(behind, self.closing[node]):
                closed = self.closing[node]
        self.ends[state][byte] = closed
        self.entered += 1
        return closed

    def encode_word(self, word: bytes) -> list[int]:
        """The tokens of one word (one match of the pattern, not empty)."""
        if self.entered > self.limit:
            self._restart()
        moves, state, ended = self.moves, 0, []
        for byte in word[:-1]:
            found = moves[state].get(byte)
            if found is None:
                found = self._move(state, byte)
                if self.entered > self.limit:  # within a very long word: go on in a new table from the same members
                    key = self.members[found[0]]
                    self._restart()
                    moves = self.moves
                    state = self.numbers.setdefault(key, 1)
                    if state:
                        self.members.append(key)
                        moves.append({})
                        self.ends.append({})
                    ended.append(found[1])
                    continue
            state = found[0]
            ended.append(found[1])
        last = word[-1]
        token = self.ends[state].get(last)
        if token is None:
            token = self._end(state, last)
        out, at = [token], len(word) - self.size[token]
        while at:
            token = ended[at - 1]
            out.append(token)
            at -= self.size[token]
        out.reverse()
        return out

    def split(self, unit: str) -> list[str | int]:
        """The words of a unit of text in normal form, lower-cased letter by letter, and special tokens as numbers."""
        out: list[str | int] = []
        for k, part in enumerate(self.special_split.split(unit)):
            if k % 2:
                out.append(self.special[part])
            else:
                part = unicodedata.normalize("NFC", part)
                out += self.words.findall("".join(map(str.lower, part)) if "Σ" in part else part.lower())
        return out

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units end to end, and how many each has."""
        known: dict[str | int, list[int]] = {}
        flat: list[int] = []
        lengths = np.zeros(len(units), np.int64)
        for k, unit in enumerate(units):
            before = len(flat)
            for word in self.split(unit.decode()):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = [word] if isinstance(word, int) else self.encode_word(word.encode())
                flat += ids
            lengths[k] = len(flat) - before
        return np.array(flat, np.uint32), lengths

    def decode(self, ids: np.ndarray) -> bytes:
        """The labels of the tokens, a space between each two."""
        return self.label_bytes[spread_ranges(self.label_start[ids], self.label_length[ids])].tobytes()[:-1]


def load(path: str) -> WordAutomaton:
    """The automaton of a file, built once per Python worker."""
    return tool(("automaton", path), lambda: WordAutomaton(path))


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text: ``doc_id``, ``ids`` (little-endian unsigned 32-bit integers in a binary).

    ``path`` is read on the executors and must exist there. One row per input row, repeated rows and null
    ids included; a null text counts as empty and has no ids. Other columns, whatever their
    names, are not read. There is no shuffle; a row depends on its text alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = load(path).table
        for batch in batches:
            parts: list[list[bytes]] = [[] for _ in range(batch.num_rows)]
            for k, ids in table.each(batch.column(1)):
                parts[k].append(ids.astype("<u4").tobytes())
            yield pa.record_batch([batch.column(0), pa.array(map(b"".join, parts), pa.binary())], ["doc_id", "ids"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)}, "doc_id long, ids binary", run)


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id`` and ``decoded`` (text) of ids as :func:`encode_texts` gives them; null ids give null, an unknown id is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = load(path)
        for batch in batches:
            out = [None if ids is None else automaton.decode(np.frombuffer(ids, "<u4")).decode() for ids in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.string())], ["doc_id", "decoded"])

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "ids": df[ids_col]}, "doc_id long, decoded string", run)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text, decode its ids, and return digests of both.

    ``doc_id``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers), ``decoded_sha256``
    (of the decoded text in UTF-8). A long text is digested part by part, so neither
    its ids nor its decoded text are held as a whole. Rows as in :func:`encode_texts`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = load(path)
        for batch in batches:
            count = np.zeros(batch.num_rows, np.int64)
            coded = [hashlib.sha256() for _ in range(batch.num_rows)]
            decoded = [hashlib.sha256() for _ in range(batch.num_rows)]
            for k, ids in automaton.table.each(batch.column(1)):
                if len(ids):
                    if count[k]:
                        decoded[k].update(b" ")
                    count[k] += len(ids)
                    coded[k].update(ids.astype("<u4").tobytes())
                    decoded[k].update(automaton.decode(ids))
            yield pa.record_batch(
                [batch.column(0), pa.array(count), pa.array(x.hexdigest() for x in coded), pa.array(x.hexdigest() for x in decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return map_texts(df, {"doc_id": df[id_col].cast("long"), "text": text_of(df, text_col)},
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", run)
