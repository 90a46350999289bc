"""Ids of a public byte-level vocabulary, by the tokenizers library with a cache of words."""

from __future__ import annotations

import gc
from array import array
from collections.abc import Iterable
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from scanyard.llm.common import remembered, slices

VOCABULARY = "byte_bpe_50k.json"
END = 0
# Words whose ids a worker remembers, so its memory has a bound. Forgetting costs time only.
MOST_WORDS = 800_000


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: the byte itself where it prints,
    the next letter from 256 on for the others."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + n) for n, b in enumerate(others)}


# How the vocabulary writes a space.
_GAP = _byte_letters()[32]
_id = attrgetter("id")


class _Parts(dict):
    """Place in the tables of each known part, a text between two single spaces."""

    def __init__(self, learn):
        self.learn = learn

    def __missing__(self, part: str) -> int:
        # With a space before white space or the end, a cut here may part what belongs together.
        if not part or part[0].isspace():
            return ODD
        self[part] = place = self.learn(" " + part)
        return place


NONE, ODD = 0, -1
# Characters of a piece whose ids are remembered by themselves.
SHORT = 2


class Encoder:
    """Ids of texts, equal to those the library gives for each text as a whole.

    The vocabulary's pattern never matches across a space that a non-space follows, so texts are
    cut there and the parts looked up. A part not yet known is cut by the pattern, and the
    library's model encodes its pieces. A text that holds the string of an added token, such as a
    special one, goes to the library as it is.
    """

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = _byte_letters()
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.most_words = most_words
        self._forget()

    def _forget(self) -> None:
        self.parts = _Parts(self._learn)
        self.short: dict[str, array] = {}
        self.ids = array("I")
        # The first place has no ids: what a text begins with when that is a space.
        self.starts, self.sizes = array("q", [0]), array("q", [0])

    def _learn(self, part: str) -> int:
        """Add a part's ids to the tables."""
        body = part[1:]
        if part[0] == " " and body.isalpha():
            pieces = (part,)
        elif part[0] == " " and part[-1] in ",." and body[:-1].isalpha():
            pieces = part[:-1], part[-1]
        else:
            pieces = self.pattern.findall(part)
        start, ids = len(self.ids), self.ids
        for piece in pieces:
            if len(pieces) > 1:
                known = self._known(piece)
                if known is not None:
                    ids.extend(known)
                    continue
            if piece[0] == " " and piece[1:2] != " " and piece.isascii() and piece.isprintable():
                spelt = _GAP + piece[1:]
            else:
                spelt = piece.encode().decode("latin-1").translate(self.letters)
            ids.extend([*map(_id, self.tokenize(spelt))])
        self.starts.append(start)
        self.sizes.append(len(ids) - start)
        return len(self.starts) - 1

    def _known(self, piece: str) -> array | None:
        """Ids of a piece that is short, or stands by itself elsewhere."""
        if len(piece) <= SHORT:
            if piece not in self.short:
                self.short[piece] = array("I", map(_id, self.tokenize(
                    piece.encode().decode("latin-1").translate(self.letters))))
            return self.short[piece]
        place = self.parts.get(piece[1:], ODD) if piece[0] == " " else ODD
        if place == ODD:
            return None
        start = self.starts[place]
        return self.ids[start:start + self.sizes[place]]

    def _odd(self, text: str) -> list[int]:
        """Places of a text whose spaces don't all stand before a part."""
        first, *rest = (p for p in _AT_SPACE.split(text) if p)
        return [self._learn(first), *map(self._learn, rest)]

    def _parted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the parts of all texts, one text after another, and where each text begins.

        Texts are parted and equal parts found in Arrow, so a part is looked up once a block.
        """
        lists = pc.split_pattern(pa.array(texts, pa.string()), " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        leads = np.zeros(len(codes), bool)
        leads[bounds[:-1]] = True
        asked = np.zeros(len(coded.dictionary), bool)
        asked[codes[~leads]] = True
        asked = np.flatnonzero(asked)
        table = np.full(len(coded.dictionary), ODD, np.int64)
        table[asked] = [*map(self.parts.__getitem__, coded.dictionary.take(asked).to_pylist())]
        places = table[codes]
        # What a text begins with has no space before it.
        first = coded.dictionary.take(codes[leads]).to_pylist()
        places[leads] = [self._learn(p) if p else NONE for p in first]
        odd = np.unique(np.searchsorted(bounds, np.flatnonzero(places == ODD), "right") - 1)
        if not len(odd):
            return places, bounds
        each = np.split(places, bounds[1:-1])
        for n in odd.tolist():
            each[n] = np.array(self._odd(texts[n]), np.int64)
        return np.concatenate(each), np.cumsum([0, *map(len, each)])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """One uint32 array per text."""
        if not texts:
            return []
        if len(self.starts) > self.most_words:
            self._forget()
        whole = {n: np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                 for n, text in enumerate(texts) if self.added and self.added.search(text)}
        collecting = gc.isenabled()
        gc.disable()  # nothing here is cyclic, and each pass would walk the whole cache
        places, bounds = self._parted(["" if n in whole else t for n, t in enumerate(texts)])
        if collecting:
            gc.enable()
        ids = np.frombuffer(self.ids, np.uint32) if self.ids else np.zeros(0, np.uint32)
        starts, sizes = np.array(self.starts, np.int64), np.array(self.sizes, np.int64)
        n = sizes[places]
        ends = np.cumsum(n)
        every = ids[np.arange(int(ends[-1])) + np.repeat(starts[places] - ends + n, n)]
        out = np.split(every, ends[bounds[1:-1] - 1])
        return [whole.get(n, own) for n, own in enumerate(out)]


# Where a space stands before a non-space; the space stays with what follows.
_AT_SPACE = regex.compile(r"(?V1)(?= \S)")


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    return remembered(("encoder", path), lambda: Encoder(path))


def small(batches):
    """Batches of so little text that lists of its words take little memory."""
    for batch in batches:
        yield from slices(batch, most=4 << 20)
