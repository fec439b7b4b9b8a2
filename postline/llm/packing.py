"""Packing of token sequences: Martello-Toth dominance reduction, then best fit.

Documents become pieces of 1 to `capacity` tokens. How pieces are packed
depends on their lengths alone, and there are at most `capacity` lengths: the
instance is a count per length, however many documents there are. The
reduction and best fit work on these counts, many equal pieces at a time, and
give a plan of runs: so many sequences alike, with which lengths in them. The
driver sees the counts and makes the plan; pieces are numbered in the order of
length by Spark, and a piece finds its run in the plan by its number.

Reduction, from the longest piece down: where one set of two or three pieces
holds as much as any other set with the longest piece could, put in no better
way, that set is a sequence of an optimal packing and is fixed.
"""

import re
import string
import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline.llm.batches import chunks
from postline.operators.layout import surrogate_id
from postline.session import stage

CAPACITY = 2048
END = 0
ID_BYTES = 4
# Encoded parts of texts that a Python worker remembers over its tasks, none longer than so many bytes, and those
# that are encoded at once.
REMEMBERED = 8 << 16
LONGEST = 64
TOGETHER = 20_000
# A place in a text before ASCII white space and behind what is surely none. The tokenizer's pattern never
# reaches over such a place, so stretches between them are encoded one by one.
CUT = re.compile(r"(?<=[!-~\w])(?=[ \t\n\r])")
# Pairs of which the second sign may belong to the white space before it, and signs that may be white space.
RUNS = ("  ", "\n ", "\t ", "\r ", " \n")
ODD = r"\x0b\x0c\x1c-\x1f\x85\xa0\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
ODD_SPACE = re.compile(f"[{re.sub(r'x{(....)}', r'u\1', ODD)}]")
# Nor does it reach from a letter or digit to a sign behind it; from what is neither of them to the end there are signs.
WORD = r"^[ \t\n\r]*[0-9A-Za-zÀ-ÖØ-öø-ÿ]+$"
WORD_SIGNS = " \t\n\r" + "".join(c for c in map(chr, range(256)) if re.match("[0-9A-Za-zÀ-ÖØ-öø-ÿ]", c))
# What may go to the tokenizer in one text with others: it ends with what is surely no white space, and begins with
# such, or with white space of ASCII.
TOGETHER_WITH = rf"^[^{ODD}](?s:.*)[^ \t\n\r{ODD}]$|^[^ \t\n\r{ODD}]$"
SPACED = r"^[ \t\n\r]"
# Characters that are encoded at once.
CHARS = 8_000_000
# Numbers of a row: the task above this bit, the row in it below.
TASK_BITS = 40

# Literals of Arrow's wide types.
NOTHING, SPACE, BREAK = (pa.scalar(sign, pa.large_string()) for sign in ("", " ", "\n"))
NO_IDS = pa.scalar(b"", pa.large_binary())

Run = tuple[int, tuple[int, ...]]


def _is_plain(text: str) -> bool:
    """Whether every space of the text surely stands behind a sign or letter, and before no line break."""
    return not (text.startswith((" ", "\n")) or any(run in text for run in RUNS) or ODD_SPACE.search(text))


def _with_spaces(text: str) -> str:
    """A plain text with a space put before each run of line breaks, unless other white space may belong to one."""
    if "\n" not in text or "\r\n" in text or "\t\n" in text:
        return text
    # The first time leaves runs of two at most apart, the second none.
    return text.replace("\n", " \n").replace("\n \n", "\n\n").replace("\n \n", "\n\n")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, by a tokenizer of bytes; remembers parts of texts."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        # What was met last comes last.
        self.known = pa.array([], pa.large_string())
        self.known_ids = pa.array([], pa.large_binary())
        # A token is written with a sign per byte.
        self.bytes_of = np.zeros(tokenizer.get_vocab_size(), np.int64)
        for token, number in tokenizer.get_vocab().items():
            self.bytes_of[number] = len(token)

    def _together(self, parts: pa.Array) -> pa.Array:
        """The ids of parts that may go to the tokenizer as one text.

        White space cuts off what it stands before. A line break is put before parts without, and its id taken out.
        """
        spaced = pc.match_substring_regex(parts, SPACED)
        text = pc.binary_join_element_wise(pc.if_else(spaced, NOTHING, BREAK), parts, NOTHING)
        ends = np.cumsum(pc.binary_length(text).to_numpy())
        whole = pc.binary_join(pa.LargeListArray.from_arrays([0, len(text)], text), NOTHING)[0].as_py()
        ids = np.array(self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids, "<u4")
        places = np.r_[0, np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1]
        added = ~spaced.to_numpy(zero_copy_only=False)
        ids = np.delete(ids, places[:-1][added])
        return _binary(ids, places - np.r_[0, np.cumsum(added)])

    def _encode(self, parts: pa.Array) -> pa.Array:
        found = [pa.array([], pa.large_binary())]
        together = pc.match_substring_regex(parts, TOGETHER_WITH)
        many, others = parts.filter(together), parts.filter(pc.invert(together)).to_pylist()
        for start in range(0, len(many), TOGETHER):
            found.append(self._together(many.slice(start, TOGETHER)))
        for start in range(0, len(others), TOGETHER):
            alone = self.tokenizer.encode_batch_fast(others[start : start + TOGETHER], add_special_tokens=False)
            found.append(pa.array([np.array(each.ids, "<u4").tobytes() for each in alone], pa.large_binary()))
        is_many = together.to_numpy(zero_copy_only=False)
        order = np.where(is_many, np.cumsum(is_many) - 1, len(many) + np.cumsum(~is_many) - 1)
        return pa.concat_arrays(found).take(pa.array(order))

    def _remembered(self, parts: pa.Array) -> pa.Array:
        """The ids of parts, all different."""
        at = pc.index_in(parts, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        new = at < 0
        ids = pa.concat_arrays([self.known_ids, self._encode(parts.filter(pa.array(new)))])
        at[new] = np.arange(len(self.known), len(ids))
        found = ids.take(pa.array(at))
        # What is met again comes last, too; what has not been met for the longest time is forgotten.
        idle = np.ones(len(self.known), bool)
        idle[at[~new]] = False
        idle, short = pa.array(idle), pc.less_equal(pc.binary_length(parts), LONGEST)
        self.known, self.known_ids = (
            pa.concat_arrays([old.filter(idle), met.filter(short)])[-REMEMBERED:]
            for old, met in ((self.known, parts), (self.known_ids, found))
        )
        return found

    def _ids(self, stretches: pa.Array) -> pa.Array:
        """The ids of each stretch. Words and the signs behind them are remembered, not what they are put together to."""
        words = pc.utf8_rtrim(stretches, string.punctuation)
        cut = pc.match_substring_regex(words, WORD)
        signs = pc.utf8_ltrim(pc.if_else(cut, stretches, NOTHING), WORD_SIGNS)
        parts = pa.concat_arrays([pc.if_else(cut, words, stretches), signs]).dictionary_encode()
        ids = self._remembered(parts.dictionary).take(parts.indices)
        return pc.binary_join_element_wise(ids[: len(words)], ids[len(words) :], NO_IDS)

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain, others = [], []
        for i, text in enumerate(texts):
            (plain if _is_plain(text) else others).append(i)
        found = [b""] * len(texts)
        for some, encode in ((plain, self._plain), (others, self._careful)):
            if some:
                for i, ids in zip(some, encode([texts[i] for i in some]), strict=True):
                    found[i] = ids
        return found

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Of plain texts: a stretch is each word with the space before it, or with the line breaks if there are some."""
        cut = pc.split_pattern(pa.array(map(_with_spaces, texts), pa.large_string()), " ")
        edges = cut.offsets.to_numpy()
        words = cut.flatten()
        coded = words.dictionary_encode()
        space = pc.if_else(pc.starts_with(coded.dictionary, "\n"), NOTHING, SPACE)
        heads = words.take(pa.array(edges[:-1]))
        stretches = pa.concat_arrays([pc.binary_join_element_wise(space, coded.dictionary, NOTHING), heads])
        order = coded.indices.to_numpy().astype(np.int64)
        order[edges[:-1]] = np.arange(len(stretches) - len(heads), len(stretches))
        return _joined(self._ids(stretches).take(pa.array(order)), edges)

    def _careful(self, texts: list[str]) -> list[bytes]:
        cut = [CUT.split(text) for text in texts]
        coded = pa.array([part for parts in cut for part in parts], pa.large_string()).dictionary_encode()
        edges = np.cumsum([0, *map(len, cut)])
        return _joined(self._ids(coded.dictionary).take(coded.indices), edges)


def _binary(ids: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The ids between every two edges."""
    offsets = pa.array(edges * ID_BYTES, pa.int64()).buffers()[1]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, offsets, pa.py_buffer(ids.tobytes())])


def _joined(ids: pa.Array, edges: np.ndarray) -> list[bytes]:
    """The ids of what stands between every two edges, as one."""
    whole = pa.LargeListArray.from_arrays(pa.array(edges, pa.int64()), ids)
    return pc.binary_join(whole, NO_IDS).to_pylist()


@lru_cache(maxsize=1)
def tokenizer_encoder(data: str) -> Encoder:
    """The encoder of a tokenizer given as the text of its file, without added special tokens; kept for further tasks."""
    from tokenizers import Tokenizer

    return Encoder(Tokenizer.from_str(data))


def cut_lengths(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document: whole ones, behind a shorter first one if need be."""
    start = 0
    while start < length:
        size = length % capacity or capacity if start == 0 else capacity
        yield start, size
        start += size


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and `_row`, a number of its own, of every piece of the documents."""
    with open(tokenizer_file, encoding="utf-8") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())
    kept = docs.select("doc_id", "text")
    numbers = [T.StructField(name, T.LongType()) for name in ("start", "length", "ids_crc32", "_row")]
    made = T.StructType([kept.schema["doc_id"], T.StructField("piece", T.IntegerType()), *numbers])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        encoder, schema = tokenizer_encoder(data.value), to_arrow_schema(made)
        row = TaskContext.get().partitionId() << TASK_BITS
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                texts = [text or "" for text in part.column(1).to_pylist()]
                for first, some in chunks(texts, CHARS):
                    owner, columns = [], [[] for _ in range(4)]
                    for i, ids in enumerate(encoder(some)):
                        ids = memoryview(ids + END.to_bytes(ID_BYTES, "little"))
                        for piece, (start, size) in enumerate(cut_lengths(len(ids) // ID_BYTES, capacity)):
                            owner.append(first + i)
                            crc = zlib.crc32(ids[start * ID_BYTES : (start + size) * ID_BYTES])
                            for column, value in zip(columns, (piece, start, size, crc), strict=True):
                                column.append(value)
                    numbers = np.arange(row, row + len(owner))
                    row += len(owner)
                    values = [part.column(0).take(pa.array(owner, pa.int64())), *columns, numbers]
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, schema)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return kept.mapInArrow(run, made)


class Counts:
    """A multiset of lengths."""

    def __init__(self, counts: dict[int, int]):
        self.n = {length: n for length, n in counts.items() if n}
        self.lengths = sorted(self.n)

    def take(self, length: int, n: int) -> None:
        self.n[length] -= n
        if not self.n[length]:
            del self.n[length]
            self.lengths.remove(length)

    def without(self, length: int) -> "Counts":
        rest = Counts({})
        rest.n, rest.lengths = dict(self.n), list(self.lengths)
        rest.take(length, 1)
        return rest

    def largest(self, room: int) -> int | None:
        """The greatest length that the room holds."""
        at = bisect_right(self.lengths, room)
        return self.lengths[at - 1] if at else None

    def lightest(self, n: int, above: int = 0) -> list[int]:
        """The n smallest lengths greater than `above`, repeated ones repeated; fewer, if there are no more."""
        found: list[int] = []
        for length in self.lengths[bisect_right(self.lengths, above) :]:
            found += [length] * min(self.n[length], n - len(found))
            if len(found) == n:
                break
        return found

    def best_pair(self, room: int) -> tuple[int, int] | None:
        """Two lengths, the greater first, with the greatest sum that the room holds."""
        best, low, high = None, 0, len(self.lengths) - 1
        while low <= high:
            a, b = self.lengths[high], self.lengths[low]
            if a + b > room or (low == high and self.n[a] < 2):
                high -= 1
            else:
                if best is None or a + b > sum(best):
                    best = (a, b)
                low += 1
        return best


def dominating(length: int, others: Counts, capacity: int) -> tuple[int, ...] | None:
    """What goes with the length in a sequence that no other sequence with it can better, if that can be told.

    With room r beside it: nothing, if nothing fits. The longest partner p, if
    no two pieces fit, if p fills r, or if at most two fit and no two are longer
    than p: whatever else could be put there fits into the place of p. The best
    pair (p, q), if at most two fit and no other two that fit are both longer than q.
    """
    room = capacity - length
    partner = others.largest(room)
    if partner is None:
        return ()
    few = others.lightest(3)
    fitting = sum(sum(few[: k + 1]) <= room for k in range(len(few)))
    if fitting < 2 or partner == room:
        return (partner,)
    if fitting > 2:
        return None
    pair = others.best_pair(room)
    if partner >= sum(pair):
        return (partner,)
    between = others.lightest(2, above=pair[1])
    if pair[0] == partner and (len(between) < 2 or sum(between) > room):
        return pair
    return None


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """Runs of sequences that dominance fixes, and what is left."""
    left = Counts(counts)
    fixed: list[Run] = []
    for length in sorted(counts, reverse=True):
        while left.n.get(length):
            partners = dominating(length, left.without(length), capacity)
            if partners is None:
                break
            held = (length, *partners)
            # The same holds for as many sequences as the lengths last for: what is left only gets less.
            many = min(left.n[part] // held.count(part) for part in held)
            for part in sorted(set(held)):
                left.take(part, many * held.count(part))
            fixed.append((many, held))
    return fixed, left.n


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Runs of sequences by best fit, longest pieces first.

    Sequences alike are one entry of `open`: each length splits off at most two
    entries, those filled in part, so there are a few per length.
    """
    opened: dict[int, list[Run]] = defaultdict(list)
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        at = bisect_left(rooms, length)
        ahead, changed = rooms[at:], []
        for room in ahead:
            while left and opened[room]:
                many, held = opened[room].pop()
                each = room // length
                full = min(many, left // each)
                left -= full * each
                if full:
                    changed.append((full, held + (length,) * each))
                rest = many - full
                if rest and left:
                    changed.append((1, held + (length,) * left))
                    rest, left = rest - 1, 0
                if rest:
                    opened[room].append((rest, held))
            if not left:
                break
        each = capacity // length
        if left // each:
            changed.append((left // each, (length,) * each))
        if left % each:
            changed.append((1, (length,) * (left % each)))
        for run in changed:
            opened[capacity - sum(run[1])].append(run)
        rooms = sorted(room for room, runs in opened.items() if runs)
    return [run for runs in opened.values() for run in runs]


def pack_counts(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


@dataclass(frozen=True)
class Plan:
    """Stretches of piece numbers, in order: from `first` on, `each` pieces of one length to a sequence."""

    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    length: np.ndarray

    def places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """sequence_id and offset of the pieces of these numbers."""
        at = np.searchsorted(self.first, numbers, side="right") - 1
        nth = numbers - self.first[at]
        each = self.each[at]
        return self.sequence[at] + nth // each, self.offset[at] + nth % each * self.length[at]


def plan_places(runs: list[Run], counts: dict[int, int]) -> Plan:
    """Where the n-th piece goes, pieces being numbered from 0 by rising length."""
    following, at = {}, 0
    for length in sorted(counts):
        following[length] = at
        at += counts[length]
    rows, sequence = [], 0
    for many, held in runs:
        offset = 0
        for length in sorted(set(held), reverse=True):
            each = held.count(length)
            rows.append((following[length], sequence, each, offset, length))
            following[length] += many * each
            offset += each * length
        sequence += many
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(*(np.ascontiguousarray(column) for column in table.T))


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of the documents.

    The ids of a document are the tokenizer's, without special tokens added,
    and END. A document of more than `capacity` ids is cut into pieces of that
    many, the first being shorter if need be; no other is cut. A NULL or empty
    text is END alone. Repeated rows are packed each by itself, whatever their
    doc_id, which may be NULL; an empty table gives no rows. Other columns are
    left out.
    """
    cut = stage(pieces(docs, tokenizer_file, capacity), "pieces")
    # At most `capacity` rows.
    counts = {row.length: row.n for row in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = cut.sparkSession.sparkContext.broadcast(plan_places(pack_counts(counts, capacity), counts))
    numbered = surrogate_id(cut, ["length", "_row"], start=0, id_column="_number").drop("_row")
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    numbered = numbered.select(*names, "_number")
    places = [T.StructField(name, T.LongType()) for name in ("sequence_id", "offset")]
    made = T.StructType([*numbered.select(*names).schema.fields, *places])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = plan.value.places(batch.column(len(names)).to_numpy())
            columns = [*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=made.names)

    return numbered.mapInArrow(place, made)
