"""Token ids of whole texts by a public tokenizer, with the library called once per distinct piece of text.

A text is split at single spaces. Splits between two characters that are not white space never cut a token of the
supported tokenizers, so the ids of a text are the ids of its pieces one after the other. A text with other runs of white
space is cut by a pattern instead, and one that holds a special token goes to the library whole. Values are kept per
worker process up to a limit of entries: memory stays bounded, results do not depend on it.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable
from itertools import islice

from tallyhouse.llm.base import hold


if sys.byteorder != "little":
    raise ImportError("token ids are kept as little-endian arrays of the machine")
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Characters that the tokenizers take as white space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: Cuts that never fall inside a token: around white space, and between Latin letters and punctuation at a word's end.
_CHUNK = re.compile(f" ?[{_LATIN}]+(?=[{SPACE}.,:;!?]|$)| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_EDGE = re.compile(f"^[{SPACE}]|[{SPACE}]$")
SPECIAL = "<|"


#: A word of Latin letters, which every supported tokenizer takes as one pre-token.
is_word = re.compile(f" ?[{_LATIN}]+").fullmatch


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte: printable Latin-1 bytes stand for themselves, others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_LETTERS = byte_letters()


def as_letters(raw: bytes) -> str:
    return raw.decode("latin-1").translate(_LETTERS)


def has_edge(piece: str) -> bool:
    """Whether a piece begins or ends with white space."""
    return piece.strip() != piece and _EDGE.search(piece) is not None


def trim(kept: dict, limit: int) -> None:
    """Drop the youngest third once there are more than ``limit`` entries: frequent pieces came early."""
    if len(kept) > limit:
        for key in list(islice(reversed(kept), len(kept) // 3)):
            del kept[key]


class Pieces:
    """Values of texts that add up over their pieces.

    ``fill`` gives the values of a list of short texts, ``join`` puts values in sequence together, ``whole`` gives the value
    of one text that must not be cut. ``spaced`` says whether a piece keeps the space before it.
    """

    def __init__(self, fill: Callable, join: Callable[[Iterable], object], whole: Callable, spaced: bool, limit: int = 1_200_000):
        self.fill, self.join, self.whole, self.limit = fill, join, whole, limit
        self.space = " " if spaced else ""
        self.rest: dict[str, object] = {}
        self.chunks: dict[str, object] = {}

    def __call__(self, texts: list[str]) -> list:
        trim(self.rest, self.limit)
        trim(self.chunks, self.limit // 3)
        get, out, open_, odd, missing = self.rest.get, [None] * len(texts), [], {}, set()
        for i, text in enumerate(texts):
            if SPECIAL in text:
                out[i] = self.whole(text)
                continue
            pieces = text.split(" ")
            if "" in pieces or has_edge(pieces[0]):
                odd[i] = _CHUNK.findall(text)
                continue
            values = list(map(get, pieces))
            if None in values:
                missing.update([p for p, v in zip(pieces, values) if v is None])
                open_.append((i, pieces))
            elif self.space:
                odd[i] = _CHUNK.findall(pieces[0])
                out[i] = values[1:]
            else:
                out[i] = self.join(values)
        space, cut, edges = self.space, {}, set()
        for p in missing:
            if is_word(p):
                cut[p] = (space + p,)
            elif has_edge(p):
                edges.add(p)
            else:
                cut[p] = _CHUNK.findall(space + p)
        waiting = []
        for i, pieces in open_:
            if edges and not edges.isdisjoint(pieces[1:]):
                odd[i] = _CHUNK.findall(texts[i])
                continue
            waiting.append((i, pieces))
            if space:
                odd[i] = _CHUNK.findall(pieces[0])
        known, join = self.chunks, self.join
        new = list({c for some in (cut.values(), odd.values()) for chunks in some for c in chunks if c not in known})
        known.update(zip(new, self.fill(new)))
        for p, chunks in cut.items():
            self.rest[p] = known[chunks[0]] if len(chunks) == 1 else join([known[c] for c in chunks])
        value = self.rest.__getitem__
        for i, pieces in waiting:
            out[i] = list(map(value, pieces[1:])) if space else join(map(value, pieces))
        for i, chunks in odd.items():
            first = [known[c] for c in chunks]
            out[i] = join(first + out[i]) if out[i] is not None else join(first)
        return out


def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


_ENCODERS: dict[str, Pieces] = {}


def encoder(path: str) -> Pieces:
    """Little-endian unsigned 16-bit ids (as bytes) of texts, by the tokenizers library without added special tokens.

    Serves files whose ids are below 65,536. One encoder per worker process and file.
    """
    hold("encoder", _ENCODERS.clear)
    if path not in _ENCODERS:
        tool = _library(path)
        if tool.get_vocab_size() > 65_536:
            raise ValueError("ids do not fit 16 bits")

        spaced, merge = tool.normalizer is None, tool.model.tokenize

        def fill(chunks: list[str]) -> list[bytes]:
            out = []
            for at in range(0, len(chunks), 2000):
                some = chunks[at : at + 2000]
                plain = [is_word(c) is not None for c in some]
                found = iter(tool.encode_batch_fast([c for c, w in zip(some, plain) if not w], add_special_tokens=False))
                for c, word in zip(some, plain):
                    if word:  # one pre-token: straight to the library's merges
                        ids = [x.id for x in merge(as_letters(c.encode() if spaced else c.strip(" ").lower().encode()))]
                    else:
                        ids = next(found).ids
                    out.append(array("H", ids).tobytes())
            return out

        _ENCODERS[path] = Pieces(fill, b"".join, lambda text: fill([text])[0], spaced)
    return _ENCODERS[path]


def vocabulary_file(name: str) -> str:
    """Where this process finds a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)
