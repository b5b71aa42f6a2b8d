"""Token ids by the ``tokenizers`` library, each distinct unit of text encoded once per Python worker."""

from __future__ import annotations

import itertools
import os

import numpy as np

from hirelake.llm.scan import UnitTable, tool


class LibraryEncoder:
    """Encodes as ``Tokenizer.encode(text, add_special_tokens=False)`` does, unit by unit.

    Right for tokenizers that split at white space runs or before the last white space
    character of a run, as byte-level BPE and BPE over words do: no token then holds
    characters of two units, and special tokens hold no white space.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.table = UnitTable(self.encode_units, np.uint32)

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units end to end, and how many each has."""
        ids = [x.ids for x in self.tokenizer.encode_batch_fast([unit.decode() for unit in units], add_special_tokens=False)]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(lengths.sum())), lengths


def load(path: str) -> LibraryEncoder:
    """The encoder of a file, built once per Python worker."""
    return tool(("library", path), lambda: LibraryEncoder(path))
