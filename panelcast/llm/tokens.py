"""Token ids and token counts that equal those of the ``tokenizers`` library.

Both vocabularies encode a text in parts that do not depend on each other, so a text is cut
into parts and a worker encodes each different part once. Texts of plain letters, figures and
signs are cut as the vocabulary itself cuts them; other texts are cut at white space, and what
is not plain goes through the library. Texts that hold one of the vocabulary's special strings
are encoded whole by the library, because such a string also cuts the white space around it.
"""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# The characters that the tokenizers' patterns count as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Pieces of the byte-level vocabulary: a word with one space before it, or white space.
BYTE_PIECES = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Pieces of the word vocabulary, which drops white space.
WORD_PIECES = re.compile(f"[^{SPACE}]+")

# Pieces longer than this are encoded when met and not remembered.
LONGEST_CACHED = 64
# Runs a worker remembers before it starts afresh: some 100 MB.
CACHE_SIZE = 500_000

# Texts of plain letters, figures, signs and white space fall into runs that a vocabulary
# encodes one by one, so the ids of a run come from the vocabulary's merges without the way
# through the whole library. Pieces of other texts (apostrophes, other scripts) that are not
# plain themselves take that way.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
SIGNS = "!-&(-/:-@\\[-`{-~"
PLAIN = re.compile(f"[{LETTERS}0-9{SIGNS}\t-\r ]*")
BYTE_RUNS = re.compile(f" ?[{LETTERS}]+| ?[0-9]+| ?[{SIGNS}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
WORD_RUNS = re.compile(f"[{LETTERS}]+|[0-9]|[{SIGNS}]+")
# Byte-level vocabularies write a byte as a printable character: its own if it has one, else
# the next free one from 256 on.
PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in set(PRINTED))}


def process_state() -> dict:
    """What a worker process keeps from task to task."""
    name = "panelcast_process_state"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def vocabulary(path: str):
    """The tokenizer of a file, loaded once per process."""
    state = process_state()
    if path not in state:
        from tokenizers import Tokenizer

        state[path] = Tokenizer.from_file(path)
    return state[path]


def special_strings(tokenizer) -> list[str]:
    return [t.content for t in tokenizer.get_added_tokens_decoder().values()]


class Known(dict):
    """Key -> ``make(key)``, remembered for short keys, started afresh when full."""

    def __init__(self, make: Callable, size: int = CACHE_SIZE):
        super().__init__()
        self.make, self.size, self.frequent = make, size, {}

    def __missing__(self, key: str):
        found = self.make(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) > self.size + len(self.frequent):
                self.clear()
                self.update(self.frequent)
            self[key] = found
        return found

    def keep(self, frequent: dict) -> None:
        """Entries that a fresh start does not lose."""
        self.frequent = frequent
        self.update(frequent)


class Encoder:
    """What ``value`` makes of the ids of whole texts; ``join`` adds up the values of their parts.

    ``pieces`` and ``runs`` are the vocabulary's patterns above; ``lower`` says that it folds case.
    """

    def __init__(self, tokenizer, pieces: re.Pattern, runs: re.Pattern, value: Callable, join: Callable,
                 lower: bool = False, size: int = CACHE_SIZE):
        self.tokenizer, self.merges, self.special = tokenizer, tokenizer.model, special_strings(tokenizer)
        self.pieces, self.run_pattern, self.value, self.join, self.lower = pieces, runs, value, join, lower
        self.runs, self.others = Known(self.of_run, size), Known(self.of_other, size)

    def __call__(self, text: str):
        if PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            return self.of_plain(text)
        if any(s in text for s in self.special):
            return self.of_other(text)
        return self.join([self.of_plain(p) if PLAIN.fullmatch(p) else self.others[p] for p in self.pieces.findall(text)])

    def of_plain(self, text: str):
        return self.join(map(self.runs.__getitem__, self.run_pattern.findall(text.lower() if self.lower else text)))

    def of_run(self, run: str):
        letters = run.encode().decode("latin-1").translate(BYTE_LETTERS)
        return self.value([t.id for t in self.merges.tokenize(letters)])

    def of_other(self, text: str):
        return self.value(self.tokenizer.encode(text, add_special_tokens=False).ids)


def worker_encoder(use: str, path: str, **how) -> Encoder:
    """The worker's encoder for one use of a vocabulary; later tasks find its caches filled."""
    state, key = process_state(), f"{use} {path}"
    if key not in state:
        state[key] = Encoder(vocabulary(path), **how)
    return state[key]
