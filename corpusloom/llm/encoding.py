"""Token ids of whole texts by a public tokenizer, one dictionary look-up per word.

A text is cut into units at places where the tokenizer itself always cuts (before
a blank or a line end that follows a visible character), so the ids of a text are
those of its units in turn. Each worker process keeps the ids of the units it has
met, up to a bound; the library encodes every other unit.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache

import numpy as np

#: A worker keeps up to twice as many units: those met lately, and those met before them.
CACHED_UNITS = 400_000
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Byte-level vocabularies keep white space: it opens the unit that follows it. A word of plain letters
#: and the stop or comma behind it are units of their own.
WITH_SPACE = re.compile(rf" ?[{_LETTER}]+(?=[.,\n ]|$)|[.,](?:\n(?=[{_LETTER}])|(?= )|$)|\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
#: Vocabularies that drop white space need the words alone.
WITHOUT_SPACE = re.compile(rf"[{_LETTER}]+(?=[.,\n ]|$)|[^ \n]+")


_PLAIN = re.compile(rf" ?[{_LETTER}]+")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write a byte: visible Latin-1 characters as they are, others as the next free ones from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return {b: chr(b if b in visible else next(free)) for b in range(256)}


class Encoder:
    """`keeps_space`: the vocabulary is case-sensitive and keeps white space; else it lowers case and drops it.

    `plain_specials`: the strings of special tokens in a text are ordinary text; else, as the library has it, those tokens.
    """

    def __init__(self, path: str, keeps_space: bool, plain_specials: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.keeps_space = keeps_space
        self.units = WITH_SPACE if keeps_space else WITHOUT_SPACE
        letters = _byte_letters()
        self.written = {c: "".join(letters[b] for b in chr(c).encode()) for c in [32, *range(256)] if chr(c) == " " or chr(c).isalpha()}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """Per text its ids with `end_id` behind them, as 16-bit unsigned integers."""
        cut = [self.units.findall(t) for t in texts]
        new = {u for units in cut for u in units if u not in self.known}
        if len(self.known) + len(new) > CACHED_UNITS:
            self.before, self.known = self.known, {}
            new = {u for units in cut for u in units}
        known, before = self.known, self.before
        known.update((u, before[u]) for u in new if u in before)
        plain = _PLAIN.fullmatch
        unmet = []
        tokenize, written = self.tokenizer.model.tokenize, self.written
        for unit in new:
            if unit in before:
                continue
            if plain(unit):  # one word of plain letters goes straight to the library's model
                word = unit if self.keeps_space else unit.lower()
                known[unit] = array("H", [t.id for t in tokenize(word.translate(written))]).tobytes()
            else:
                unmet.append(unit)
        for at in range(0, len(unmet), 20_000):
            part = unmet[at : at + 20_000]
            for unit, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                known[unit] = np.array(got.ids, "<u2").tobytes()
        end = np.array([end_id], "<u2").tobytes()
        look = known.__getitem__
        return [np.frombuffer(b"".join([*map(look, units), end]), "<u2") for units in cut]


@lru_cache(maxsize=4)
def encoder(path: str, keeps_space: bool, plain_specials: bool = True) -> Encoder:
    """One encoder for each vocabulary and worker process."""
    return Encoder(path, keeps_space, plain_specials)
