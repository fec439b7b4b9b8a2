"""Spelling variants: words that one edit turns into one another, by k-d trees over letter counts.

One replaced letter takes one from the count of a letter and adds one to
another's; one inserted letter adds one. So the near words of a word lie within
L1 distance two of its letter counts, one up and one down among the words of
its own length, one up among those that are a letter longer.

The words of a length are cut into boxes by a k-d tree, fitted on a bounded
sample; every word lies in one box, and asks in all boxes that its distance
allows. In a box, a k-d tree of its own leads to few candidates, whose counts
and then letters are compared. Boxes and what asks in them are cut into chunks,
so that a task holds one chunk of each, whatever the words are.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import sample_rows
from postline.session import stage

# Letters are A-Z, which are lower-cased, a-z and U+00C0 to U+00FF: one byte each in Latin-1.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
LETTERS = re.compile(rb"[a-z\xc0-\xff]+")
LETTER = re.compile(r"[A-Za-zÀ-ÿ]")
# Characters of a text that are cut into words at once, and words that a task counts before it hands them on.
STRETCH = 1 << 22
COUNTED = 1 << 19
# Words that the boxes are fitted on, and that a box should hold.
SAMPLE = 1 << 16
BOX = 8192
# Words of a box, and words that ask in it, that a task holds; and words in a leaf of its own tree.
CHUNK = 1 << 14
LEAF = 64
# Bytes of letters, or pairs of words, that are compared at once.
BLOCK = 1 << 23
# How much more frequent the form of a word is.
RATIO = 2


def _stretches(text: str) -> Iterator[str]:
    """The text in runs of about STRETCH characters, cut where there is no letter."""
    start = 0
    while len(text) - start > STRETCH:
        end = start + STRETCH
        while end < len(text) and LETTER.match(text[end]):
            end += 1
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def count_words(doc_id: int | None, text: str, drop: int, counts: dict[bytes, int]) -> None:
    """Add the words of a text, in Latin-1, to the counts; one run of letters in `drop` loses a letter."""
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for stretch in _stretches(text):
        found = Counter(LETTERS.findall(stretch.encode("latin-1", "replace").translate(LOWER)))
        for word, n in found.items():
            h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), salt)
            if h % drop == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            counts[word] = counts.get(word, 0) + n


def word_counts(docs: DataFrame, least: int = 5, times: int = 3, drop: int = 97) -> DataFrame:
    """word and n of the words of at least `least` letters that occur `times` times in all.

    Words are the longest runs of letters, A-Z lower-cased. A run that a hash
    of the doc_id and itself decides for, one in `drop`, loses a letter, which
    that hash names too. A NULL text has no words; a NULL doc_id is hashed as
    the empty text. Repeated rows are all counted; an empty table gives no
    rows. Tasks count ahead of the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}

        def counted() -> pa.RecordBatch:
            words = [word for word in counts if len(word) >= least]
            columns = [[word.decode("latin-1") for word in words], [counts[word] for word in words]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], ["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                ids, texts = (column.to_pylist() for column in batch.slice(at, 64).columns)
                for doc_id, text in zip(ids, texts, strict=True):
                    if text:
                        count_words(doc_id, text, drop, counts)
                if len(counts) > COUNTED:
                    yield counted()
                    counts.clear()
        yield counted()

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# Letter counts and trees over them


def letters_of(words: list[str], length: int) -> np.ndarray:
    """(words, length): the letters of words of one length, a byte each."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """(words, 256): how often each letter occurs."""
    counts = np.zeros((len(letters), 256), np.int32)
    rows = np.arange(len(letters))
    for column in letters.T:
        np.add.at(counts, (rows, column), 1)
    return counts


@dataclass
class Node:
    """Words with at most `most` of the letter are on the left; a leaf has the numbers of its words."""

    letter: int = -1
    most: int = 0
    left: "Node | None" = None
    right: "Node | None" = None
    words: np.ndarray | None = None
    number: int = 0


def grow(counts: np.ndarray, leaf: int) -> list[Node]:
    """The nodes of a k-d tree, the root first; splits are the most even ones there are."""
    nodes = [Node(words=np.arange(len(counts)))]
    for node in nodes:
        if len(node.words) <= leaf:
            continue
        own = counts[node.words]
        best = (0, 0, 0)
        for most in range(int(own.max())):
            below = (own <= most).sum(axis=0)
            even = np.minimum(below, len(own) - below)
            letter = int(even.argmax())
            best = max(best, (int(even[letter]), letter, most))
        if not best[0]:
            continue
        _, node.letter, node.most = best
        low = own[:, node.letter] <= node.most
        node.left, node.right = Node(words=node.words[low]), Node(words=node.words[~low])
        node.words = None
        nodes += [node.left, node.right]
    for number, node in enumerate(n for n in nodes if n.left is None):
        node.number = number
    return nodes


def own_leaves(root: Node, counts: np.ndarray) -> np.ndarray:
    """The number of the leaf that each row lies in."""
    found = np.zeros(len(counts), np.int32)
    todo = [(root, np.arange(len(counts)))]
    while todo:
        node, rows = todo.pop()
        if node.left is None:
            found[rows] = node.number
            continue
        low = counts[rows, node.letter] <= node.most
        todo += [(node.left, rows[low]), (node.right, rows[~low])]
    return found


def leaves_in_reach(root: Node, counts: np.ndarray, down: bool) -> Iterator[tuple[Node, np.ndarray]]:
    """Leaves with the rows whose box around them, one letter up and with `down` one letter down, meets theirs."""
    all_rows = np.arange(len(counts))
    todo = [(root, all_rows, np.ones(len(counts), bool), np.full(len(counts), down))]
    while todo:
        node, rows, up, lower = todo.pop()
        if not len(rows):
            continue
        if node.left is None:
            yield node, rows
            continue
        value = counts[rows, node.letter]
        # A step over the border is taken once in each direction.
        step_down, step_up = (value == node.most + 1) & lower, (value == node.most) & up
        left, right = (value <= node.most) | step_down, (value > node.most) | step_up
        todo.append((node.left, rows[left], up[left], (lower & ~step_down)[left]))
        todo.append((node.right, rows[right], (up & ~step_up)[right], lower[right]))


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether the rows of `long` are those of `short` with a letter put in."""
    ahead = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return ahead + behind >= short.shape[1]


def _parities(counts: np.ndarray) -> np.ndarray:
    """(words, 4): a bit per letter, set if its count is odd."""
    return np.packbits((counts & 1).astype(np.uint8), axis=1).view(np.uint64)


def near_pairs(own: np.ndarray, asking: np.ndarray, inserted: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of `asking` and of `own`, letters of words, that are one edit apart.

    `own` has words of the same length or, with `inserted`, of one letter more.
    """
    counts, asked = letter_counts(own), letter_counts(asking)
    used = np.flatnonzero(counts.any(axis=0) | asked.any(axis=0))
    odd, asked_odd = _parities(counts), _parities(asked)
    some = np.flatnonzero(odd.any(axis=0) | asked_odd.any(axis=0))
    # Bytes hold the counts of words of up to 60 letters, and their differences.
    narrow = np.int8 if own.shape[1] <= 60 else np.int32
    counts, asked = (np.ascontiguousarray(side[:, used].astype(narrow)) for side in (counts, asked))
    distance, differs = (1, one_inserted) if inserted else (2, one_replaced)
    found = []
    for leaf, rows in leaves_in_reach(grow(counts, LEAF)[0], asked, not inserted):
        block = max(1, BLOCK // (8 * len(leaf.words)))
        for start in range(0, len(rows), block):
            part = rows[start : start + block]
            # Counts at this distance differ in the parity of as many letters.
            apart = np.zeros((len(part), len(leaf.words)), np.uint8)
            for k in some:
                apart += np.bitwise_count(asked_odd[part, k][:, None] ^ odd[leaf.words, k])
            q, p = np.nonzero(apart == distance)
            found.append((part[q], leaf.words[p]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int)
    q, p = (np.concatenate(side) for side in zip(*found, strict=True))
    near = np.zeros(len(q), bool)
    block = max(1, BLOCK // (own.shape[1] + len(used)))
    for start in range(0, len(q), block):
        at = np.arange(start, min(start + block, len(q)))
        at = at[np.abs(counts[p[at]] - asked[q[at]]).sum(axis=1) == distance]
        near[at] = differs(asking[q[at]], own[p[at]])
    return q[near], p[near]


# On the cluster


def fit_boxes(words: DataFrame, sample: int = SAMPLE, box: int = BOX) -> dict[int, Node]:
    """A tree per length, of boxes that hold about `box` words.

    Fitted on `sample` words at most, and with 16 of them in a box at least; a
    length without a tree is one box. Which boxes there are changes the work only.
    """
    total = words.count()
    drawn: dict[int, list[str]] = {}
    for row in sample_rows(words.select("word"), "word", sample).collect():
        drawn.setdefault(len(row.word), []).append(row.word)
    share = min(1.0, sample / max(1, total))
    trees = {}
    for length, found in drawn.items():
        trees[length] = grow(letter_counts(letters_of(found, length)), max(16, int(box * share)))[0]
        _forget(trees[length])
    return trees


def _forget(root: Node) -> None:
    todo = [root]
    while todo:
        node = todo.pop()
        node.words = None
        todo += [child for child in (node.left, node.right) if child is not None]


def _by_length(words: list[str]) -> dict[int, np.ndarray]:
    lengths = np.fromiter(map(len, words), int, len(words))
    return {int(length): np.flatnonzero(lengths == length) for length in np.unique(lengths)}


def _placed(words: DataFrame, trees: dict[int, Node], asking: bool) -> DataFrame:
    """length, box, word, n: each word in its box, or with `asking` in all that it asks in, also of the next length."""
    one = Node()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_pylist()
            for length, rows in _by_length(found).items():
                counts = letter_counts(letters_of([found[i] for i in rows], length))
                if asking:
                    reached = [
                        (target, leaf.number, at)
                        for target in (length, length + 1)
                        for leaf, at in leaves_in_reach(trees.get(target, one), counts, target == length)
                    ]
                else:
                    own = own_leaves(trees.get(length, one), counts)
                    reached = [(length, int(number), np.flatnonzero(own == number)) for number in np.unique(own)]
                for target, number, at in reached:
                    taken = batch.take(pa.array(rows[at]))
                    numbers = [pa.array(np.full(len(at), x, np.int32)) for x in (target, number)]
                    yield pa.RecordBatch.from_arrays([*numbers, *taken.columns], ["length", "box", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "length int, box int, word string, n bigint")


def _best(asked: np.ndarray, found: np.ndarray, words: list[str], n: np.ndarray, rank: np.ndarray, of: list[str]) -> dict:
    """Per asking row: how many were found, and the one of largest n, the smallest word of those."""
    order = np.lexsort((rank[found], -n[found], asked))
    asked, found = asked[order], found[order]
    heads = np.flatnonzero(np.r_[True, asked[1:] != asked[:-1]]) if len(asked) else np.zeros(0, int)
    return {
        "word": [of[i] for i in asked[heads]],
        "n_near": np.diff(np.r_[heads, len(asked)]),
        "best_n": n[found[heads]],
        "best": [words[i] for i in found[heads]],
    }


def meet(own: pa.Table, asking: pa.Table) -> pa.Table:
    """What the words that ask in a box find there, and the longer words that have been found: parts of `near_words`."""
    made = []
    words, n = own["word"].to_pylist(), own["n"].to_numpy()
    asked, asked_n = asking["word"].to_pylist(), asking["n"].to_numpy()
    if words and asked:
        length = len(words[0])
        letters = letters_of(words, length)
        rank, asked_rank = (np.argsort(np.argsort(np.array(side))) for side in (words, asked))
        for size, rows in _by_length(asked).items():
            q, p = near_pairs(letters, letters_of([asked[i] for i in rows], size), size < length)
            made.append(_best(rows[q], p, words, n, rank, asked))
            if size < length:
                made.append(_best(p, rows[q], asked, asked_n, asked_rank, words))
    kinds = {"word": pa.string(), "n_near": pa.int64(), "best_n": pa.int64(), "best": pa.string()}
    tables = [pa.table({name: pa.array(part[name], kind) for name, kind in kinds.items()}) for part in made]
    return pa.concat_tables(tables) if tables else pa.schema(list(kinds.items())).empty_table()


def near_words(words: DataFrame, sample: int = SAMPLE, box: int = BOX) -> DataFrame:
    """word, n_near, and best_n and best: the near word of largest n. Words without near words have no row.

    `words` has word and n, a row per word. Every pair of near words is found.
    """
    trees = fit_boxes(words, sample, box)
    own, asking = _placed(words, trees, False), _placed(words, trees, True)
    at = ["length", "box"]

    def chunks(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias(name))

    # Boxes that nobody asks in, and those that are empty, are left out.
    met = stage(chunks(own, "_own").join(chunks(asking, "_asking"), at), "boxes")

    def dealt(rows: DataFrame, kind: str, other: str) -> DataFrame:
        others: Column = F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)
        mine = F.pmod(F.xxhash64("word"), F.col(kind)).alias(f"{kind}_at")
        return rows.join(met, at).select(*at, "word", "n", mine, F.explode(others).alias(f"{other}_at"))

    keys = [*at, "_own_at", "_asking_at"]
    left = dealt(own, "_own", "_asking").groupBy(*keys)
    right = dealt(asking, "_asking", "_own").groupBy(*keys)
    found = left.cogroup(right).applyInArrow(meet, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("_best")
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return merged.select("word", "n_near", (-F.col("_best.less")).alias("best_n"), "_best.best")


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where following the forms ends. `forms` has word and form, and no circle.

    Each round follows twice as many forms as the one before.
    """
    at = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("_via"), F.col("root").alias("_root"))
        longer = at.join(further, at["root"] == further["_via"], "left")
        followed = stage(longer.select("word", F.coalesce("_root", "root").alias("root"), "_root"), "roots")
        at = followed.select("word", "root")
        if followed.filter("_root IS NOT NULL").isEmpty():
            return at


def variants(words: DataFrame, ratio: int = RATIO, sample: int = SAMPLE, box: int = BOX) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word.

    `words` has word and n, a row per word, of letters as in `word_counts`. A
    word's form is its near word of largest n, ties going to the smallest word,
    if that is `ratio` times the word's n or more; its root is where forms end,
    the word itself if it has none. An empty table gives no rows.
    """
    words = stage(words.select("word", "n"), "words")
    near = stage(near_words(words, sample, box), "near_words")
    has_form = F.col("best_n") >= ratio * F.col("n")
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("best")).alias("form"), F.when(has_form, F.col("best_n")).alias("form_n"),
    )
    told = stage(told, "forms")
    followed = roots(told.filter("form IS NOT NULL").select("word", "form"))
    root = F.coalesce("root", "word").alias("root")
    return told.join(followed, "word", "left").select("word", "form", root, "n", "n_near", "form_n")
