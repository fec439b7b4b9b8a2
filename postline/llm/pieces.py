"""SentencePiece encoding and decoding as a shortest path through a weighted transducer.

Three transducers are compiled from a model file: the normaliser (a space in
front, spaces become the mark), the pieces (a trie of arcs over characters, one
path per piece), and the byte fallback (an arc per character that no piece
has, to the pieces of its bytes). An input is composed with them from left to
right; the encoding is the path of least total weight in the tropical semiring.

For a unigram model, an arc weighs the negative score of its piece. A model of
merges has no additive scores: there, two arcs may follow each other if merging
their joined text gives back just the two, and exactly one path is left for an
input. That path is what merging gives, which weights alone do not.

Characters that stand next to each other in no piece are never in one arc. The
input is cut there, which is exact, and each distinct cut is composed once.
"""

from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from postline.llm.batches import map_text

# Fixed values of the model format: piece kinds, model kinds, the mark for a space.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, MERGES = 1, 2
MARK = "▁"
# Distinct cuts, and pairs of pieces, that a worker remembers: some 100 MB each at most.
REMEMBERED_CUTS = 400_000
REMEMBERED_PAIRS = 1_000_000
# What an unknown character adds in a unigram model, beyond the least score.
UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of one message of the model file."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        kind, name = key & 7, key >> 3
        if kind == 0:
            yield name, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield name, raw[at : at + size]
            at += size


@dataclass
class Model:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    merges: bool
    prefix: bool
    squeeze: bool
    ids: dict[str, int] = field(default_factory=dict)

    @classmethod
    def parse(cls, raw: bytes) -> "Model":
        pieces, scores, kinds, trainer, normaliser = [], [], [], {}, {}
        for name, value in _fields(raw):
            if name == 1:
                piece = dict(_fields(value))
                pieces.append(piece.get(1, b"").decode("utf-8"))
                scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                kinds.append(piece.get(3, NORMAL))
            elif name == 2:
                trainer = dict(_fields(value))
            elif name == 3:
                normaliser = dict(_fields(value))
        if normaliser.get(2):
            raise ValueError("only models whose normaliser changes no characters but spaces are supported")
        model = cls(
            pieces, scores, kinds, trainer.get(3, UNIGRAM) == MERGES, bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1))
        )
        model.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k in (NORMAL, USER)}
        return model


class Transducer:
    """A compiled model. `encode` composes it with a text, `decode` turns ids back into text."""

    def __init__(self, model: Model):
        self.model = model
        self.trie: dict = {}
        for piece, i in model.ids.items():
            node = self.trie
            for char in piece:
                node = node.setdefault(char, {})
            node[""] = i
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        self.spelling = [
            b"" if kind == CONTROL else piece.replace(MARK, " ").encode() for piece, kind in zip(model.pieces, model.kinds, strict=True)
        ]
        for byte, i in self.bytes.items():
            self.spelling[i] = bytes([byte])
        self.unknown = model.kinds.index(UNKNOWN) if UNKNOWN in model.kinds else 0
        known = sorted({char for piece in model.ids for char in piece})
        self.classes = np.zeros(0x110000, np.uint16)
        self.classes[[ord(char) for char in known]] = np.arange(1, len(known) + 1)
        number = {char: i + 1 for i, char in enumerate(known)}
        self.inside = np.zeros((len(known) + 1, len(known) + 1), bool)
        for piece in model.ids:
            for a, b in zip(piece, piece[1:]):
                self.inside[number[a], number[b]] = True
        self.worst = min((s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL), default=0.0)
        self.paths: dict[str, tuple[int, ...]] = {}
        self.joins: dict[int, bool] = {}

    def plain(self, text: str) -> str:
        """The text as decoding can give it back."""
        text = text.replace(MARK, " ")
        return " ".join(part for part in text.split(" ") if part) if self.model.squeeze else text

    def normalise(self, text: str) -> str:
        text = self.plain(text)
        return ((" " if text and self.model.prefix else "") + text).replace(" ", MARK)

    def _merge(self, text: str) -> list[int]:
        """Join the neighbours whose piece has the best score, the first of equals, until none is a piece."""
        ids, scores = self.model.ids, self.model.scores
        parts = list(text)
        while len(parts) > 1:
            best = max(
                ((scores[ids[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ids), default=None
            )
            if best is None:
                break
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ids.get(part, -1) for part in parts]

    def _may_follow(self, a: int, b: int) -> bool:
        if not self.model.merges:
            return True
        pair = a << 32 | b
        found = self.joins.get(pair)
        if found is None:
            if len(self.joins) >= REMEMBERED_PAIRS:
                self.joins.clear()
            pieces = self.model.pieces
            found = self.joins[pair] = self._merge(pieces[a] + pieces[b]) == [a, b]
        return found

    def _spelled(self, char: str) -> tuple[int, ...]:
        if self.bytes:
            return tuple(self.bytes[b] for b in char.encode("utf-8", "replace"))
        return (self.unknown,)

    def _shortest(self, text: str) -> tuple[int, ...]:
        """The path of least weight through one cut of the input.

        A state is a place in the text and, for merges, the last piece; of the
        states of one place only one can be reached there.
        """
        merges, scores = self.model.merges, self.model.scores
        cost: list[float | None] = [0.0] + [None] * len(text)
        last: list[tuple[int, ...]] = [()] * (len(text) + 1)
        source = [0] * (len(text) + 1)
        for at in range(len(text)):
            if cost[at] is None:
                continue
            before, node, end = last[at], self.trie, at
            while end < len(text) and (node := node.get(text[end])) is not None:
                end += 1
                piece = node.get("")
                if piece is None:
                    continue
                total = cost[at] - (0.0 if merges else scores[piece])
                if (cost[end] is None or total < cost[end]) and (
                    not merges or not before or self._may_follow(before[-1], piece)
                ):
                    cost[end], last[end], source[end] = total, (piece,), at
            if text[at] not in self.model.ids:
                total = cost[at] + (0.0 if merges else UNKNOWN_PENALTY - self.worst)
                if cost[at + 1] is None or total < cost[at + 1]:
                    cost[at + 1], last[at + 1], source[at + 1] = total, self._spelled(text[at]), at
        path, at = [], len(text)
        while at:
            path.append(last[at])
            at = source[at]
        return tuple(i for arc in reversed(path) for i in arc)

    def _cuts(self, line: str) -> list[str]:
        points = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes[points]
        edges = np.flatnonzero(~self.inside[classes[:-1], classes[1:]]) + 1
        ends = [*edges.tolist(), len(line)]
        return [line[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode(self, text: str | None) -> array:
        """The ids of the text; none for NULL or an empty text."""
        out = array("i")
        line = self.normalise(text or "")
        if not line:
            return out
        paths = self.paths
        for cut in self._cuts(line):
            path = paths.get(cut)
            if path is None:
                if len(paths) >= REMEMBERED_CUTS:
                    paths.clear()
                path = paths[cut] = self._shortest(cut)
            out.extend(path)
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids: marks become spaces, byte pieces are read as UTF-8, the first space goes."""
        text = b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.model.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def compiled(raw: bytes) -> Transducer:
    """One transducer per worker process; what it has composed serves later tasks."""
    return Transducer(Model.parse(raw))


def encode_documents(docs: DataFrame, model_file: str, keep: list[str]) -> DataFrame:
    """The kept columns, `ids`, `n_tokens`, and `round_trip`: whether decoding the ids gives the text back.

    Every whole text is encoded. NULL and empty texts have no ids and make the
    round trip. A mark in the text itself is read as a space, which counts as a
    round trip, as it is part of the format; so do spaces that the model's
    normaliser squeezes. Repeated rows are all returned; an empty table gives
    no rows. `model_file` is read on the driver and sent with the tasks.
    """
    with open(model_file, "rb") as file:
        raw = file.read()

    def start():
        transducer = compiled(raw)

        def apply(texts: list[str | None]) -> list:
            ids = [transducer.encode(text) for text in texts]
            back = [transducer.decode(found) for found in ids]
            whole = [transducer.plain(text or "") == again for text, again in zip(texts, back, strict=True)]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *(np.frombuffer(i, np.int32) for i in ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
            return [lists, [len(i) for i in ids], whole]

        return apply

    return map_text(docs, "text", keep, "ids array<int>, n_tokens bigint, round_trip boolean", start)


def decode_documents(encoded: DataFrame, model_file: str, keep: list[str]) -> DataFrame:
    """The kept columns and `text`, decoded from `ids`; NULL ids give a NULL text."""
    with open(model_file, "rb") as file:
        raw = file.read()

    def start():
        transducer = compiled(raw)
        return lambda lists: [[None if ids is None else transducer.decode(ids) for ids in lists]]

    return map_text(encoded, "ids", keep, "text string", start)
