"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that adds to them.

The field tags the tokens of each line as begin, inside or outside of a secret.
A token's scores come from its shape, its word and first characters, the words
and signs next to it, and features of the whole text; the best tags of a line
are found by Viterbi. It is trained here, in numpy, on lines of the corpus that
the patterns label and on lines with made-up secrets and look-alikes put in.

Texts are tagged many at a time. A token whose score for outside exceeds the
others by more than any two transitions can make up is outside on every best
path, so Viterbi runs over what lies between such tokens; the tags are those of
the whole line.
"""

import hashlib
import random
import re
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.llm.batches import chunks, map_text, sample_rows, unused

# The patterns, and the least length of what counts (of the value, for an assignment).
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "crf")
MASK = "[secret]"

# Bounds of what is learned from: documents, characters of each, lines, tokens of a line.
TRAINING_DOCUMENTS = 300
TRAINING_CHARS = 4_000
TRAINING_LINES = 1_200
LINE_TOKENS = 40
STEPS = 120
RATE = 0.1
DECAY = 1e-4
SEED = 11
WORDS = 400

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
SPACE, LOWER, UPPER, DIGIT, SIGN, MARK = range(6)  # MARK: a token of its own
JOINED = "_-+/."
ASCII = np.array(
    [
        SPACE if chr(i).isspace() or i < 32 else LOWER if chr(i).islower() else UPPER if chr(i).isupper()
        else DIGIT if chr(i).isdigit() else SIGN if chr(i) in JOINED else MARK
        for i in range(128)
    ],
    np.uint8,
)
LENGTHS = np.array([1, 2, 3, 5, 8, 12, 16, 20, 32, 48])
POWERS = np.cumprod(np.full(64, 0x100000001B3, np.uint64))
PREFIX = 4


@dataclass
class Tokens:
    """The tokens of some lines, as arrays: places, features, and the line of each."""

    start: np.ndarray
    end: np.ndarray
    line: np.ndarray
    word: np.ndarray  # hash of the lower-cased token
    prefix: np.ndarray  # hash of its first characters
    features: list[np.ndarray]  # numbers below SIZES


SHAPES = (len(LENGTHS) + 1) * 16 * 4
#: Shape, share of digits and text features, sign before and after with spaces, as (name, size).
SIZES = (SHAPES, 5 * 9, 129 * 2, 129 * 2)


def tokenize(texts: list[str]) -> tuple[Tokens, np.ndarray]:
    """Tokens of the texts laid end to end with a line break after each, and where each text starts."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.where(points < 128, ASCII[np.minimum(points, 127)], LOWER)
    spaces = points > 127
    if spaces.any():
        wide = np.unique(points[spaces])
        blank = wide[[chr(c).isspace() for c in wide.tolist()]]
        if len(blank):
            kinds[np.isin(points, blank)] = SPACE
    solid = (kinds != SPACE) & (kinds != MARK)
    before = np.r_[False, solid[:-1]]
    begins = (solid & ~before) | (kinds == MARK)
    start = np.flatnonzero(begins)
    after = np.r_[solid[1:], False]
    end = np.flatnonzero((solid & ~after) | (kinds == MARK)) + 1
    breaks = np.cumsum(points == 10)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    if not len(start):
        nothing = np.zeros(0, np.int64)
        return Tokens(nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64), [nothing] * 4), offsets
    length = end - start
    owner = np.repeat(np.arange(len(start)), length)
    chars = np.flatnonzero(solid | (kinds == MARK))
    place = np.minimum(chars - np.repeat(start, length), len(POWERS) - 1)
    small = points[chars] + 32 * (kinds[chars] == UPPER)
    heads = np.r_[0, np.cumsum(length)[:-1]]
    weighed = small.astype(np.uint64) * POWERS[place]
    word = np.add.reduceat(weighed, heads)
    prefix = np.add.reduceat(np.where(place < PREFIX, points[chars] * POWERS[place], np.uint64(0)), heads)
    prefix[length < PREFIX] = 0
    counts = [np.add.reduceat((kinds[chars] == k).astype(np.int32), heads) for k in (LOWER, UPPER, DIGIT, SIGN)]
    turns = np.bincount(owner[1:], (kinds[chars][1:] != kinds[chars][:-1]) & (place[1:] > 0), len(start))
    bits = sum((c > 0).astype(np.int64) << k for k, c in enumerate(counts))
    shape = (np.searchsorted(LENGTHS, length, "right") * 16 + bits) * 4 + np.minimum(np.log2(1 + turns), 3).astype(int)
    digits = np.minimum(counts[2] * 5 // length, 4)
    # Of the whole text: how many of its tokens have digits, and how many are signs.
    text = np.searchsorted(offsets, start, "right") - 1
    of_text = np.maximum(1, np.bincount(text, minlength=len(texts)))
    share = np.minimum(2, np.bincount(text, counts[2] > 0, len(texts)) * 10 // of_text).astype(int)
    mark = kinds[start] == MARK
    marks = np.minimum(2, np.bincount(text, mark, len(texts)) * 5 // of_text).astype(int)
    sign = np.where(mark, points[start] + 1, 0).astype(np.int64)
    line = breaks[start]
    first = np.r_[True, line[1:] != line[:-1]]
    glued_before = np.r_[False, start[1:] == end[:-1]]
    before_sign = np.where(first, 0, np.r_[0, sign[:-1]])
    after_sign = np.where(np.r_[first[1:], True], 0, np.r_[sign[1:], 0])
    features = [
        shape,
        digits * 9 + share[text] * 3 + marks[text],
        before_sign * 2 + glued_before,
        after_sign * 2 + np.r_[glued_before[1:], False],
    ]
    return Tokens(start, end, line, word, prefix, features), offsets


def _at_lines(values: np.ndarray, line: np.ndarray, by: int) -> np.ndarray:
    """The value `by` tokens before (after, if negative) in the same line, else 0."""
    out = np.zeros_like(values)
    if 0 < by < len(values):
        out[by:] = np.where(line[by:] == line[:-by], values[:-by], 0)
    elif by < 0 and -by < len(values):
        out[:by] = np.where(line[:by] == line[-by:], values[-by:], 0)
    return out


NEIGHBOURS = (0, 1, 2, 3, 4, -1)


@dataclass
class Field:
    """A trained field. Unknown words and prefixes have number 0."""

    words: np.ndarray
    prefixes: np.ndarray
    tables: list[np.ndarray]
    transitions: np.ndarray
    start: np.ndarray

    @staticmethod
    def _number(known: np.ndarray, values: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(values), np.int64)
        at = np.minimum(np.searchsorted(known, values), len(known) - 1)
        return np.where(known[at] == values, at + 1, 0)

    def indices(self, tokens: Tokens) -> list[np.ndarray]:
        word = self._number(self.words, tokens.word)
        near = [word if by == 0 else _at_lines(word, tokens.line, by) for by in NEIGHBOURS]
        return [*tokens.features, self._number(self.prefixes, tokens.prefix), *near]

    def emissions(self, tokens: Tokens) -> np.ndarray:
        return sum(table[index] for table, index in zip(self.tables, self.indices(tokens), strict=True))

    def tags(self, tokens: Tokens) -> np.ndarray:
        """The best tag of every token."""
        n = len(tokens.start)
        tags = np.zeros(n, np.int8)
        if not n:
            return tags
        scores = self.emissions(tokens)
        swing = 2 * (max(self.transitions.max(), self.start.max()) - min(self.transitions.min(), self.start.min(), 0))
        open_ = scores[:, OUTSIDE] - scores[:, 1:].max(axis=1) <= swing
        places = np.flatnonzero(open_)
        if not len(places):
            return tags
        new = np.r_[True, (places[1:] != places[:-1] + 1) | (tokens.line[places[1:]] != tokens.line[places[:-1]])]
        runs = places[new]
        lengths = np.diff(np.r_[np.flatnonzero(new), len(places)])
        order = np.argsort(-lengths, kind="stable")
        runs, lengths = runs[order], lengths[order]
        fresh = np.r_[True, tokens.line[1:] != tokens.line[:-1]][runs]
        best = scores[runs] + np.where(fresh[:, None], self.start, self.transitions[OUTSIDE])
        last = np.r_[tokens.line[1:] != tokens.line[:-1], True][runs + lengths - 1]
        closing = np.where(last[:, None], 0.0, self.transitions[:, OUTSIDE])
        back = []
        final = np.zeros(len(runs), np.int8)
        for step in range(1, int(lengths[0]) + 1):
            ending = np.flatnonzero(lengths == step)
            final[ending] = (best[ending] + closing[ending]).argmax(axis=1)
            active = int((lengths > step).sum())
            if not active:
                break
            paths = best[:active, :, None] + self.transitions
            back.append(paths.argmax(axis=1).astype(np.int8))
            best = paths.max(axis=1) + scores[runs[:active] + step]
        for step in range(int(lengths[0]) - 1, -1, -1):
            active = int((lengths > step).sum())
            tags[runs[:active] + step] = final[:active]
            if step:
                final[:active] = back[step - 1][np.arange(active), final[:active]]
        return tags


def _spans(tags: np.ndarray, tokens: Tokens) -> list[tuple[int, int]]:
    """Runs of a begin and what is inside after it, in one line."""
    marked = np.flatnonzero(tags)
    spans: list[tuple[int, int]] = []
    before = -2
    for i in marked.tolist():
        if tags[i] == INSIDE and before == i - 1 and tokens.line[i] == tokens.line[before]:
            spans[-1] = (spans[-1][0], int(tokens.end[i]))
        else:
            spans.append((int(tokens.start[i]), int(tokens.end[i])))
        before = i
    return spans


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """(start, number of the kind, end, start of the value) of what the patterns match."""
    found = [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    small = text.lower()
    if any(word in small for word in ASSIGN_WORDS):
        matches = ASSIGN.finditer(text)
        found += [(m.start(), 0, m.end(), m.start(2)) for m in matches if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    return sorted(found)


def _covered(start: int, end: int, spans: list[tuple[int, int, int, int]]) -> bool:
    """Whether what the patterns match covers the whole of a span."""
    for first, kind, last, _ in sorted(spans):
        if kind < 3 and first <= start < last:
            start = last
    return start >= end


class Scanner:
    """Finds the spans of many texts: per text, (start, number of the kind, end, start of the value), in order."""

    def __init__(self, field: Field):
        self.field = field

    def __call__(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        whole = [text or "" for text in texts]
        found = [base_spans(text) for text in whole]
        for first, part in chunks(whole):
            tokens, offsets = tokenize(part)
            for start, end in _spans(self.field.tags(tokens), tokens):
                i = int(np.searchsorted(offsets, start, "right")) - 1
                start, end, spans = start - int(offsets[i]), end - int(offsets[i]), found[first + i]
                if not _covered(start, end, spans):
                    spans.append((start, 3, end, start))
        return [sorted(spans) for spans in found]


# What the field learns from.


def _secret(rng: random.Random) -> str:
    def some(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(low, high)))

    letters, mixed = string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/"
    return rng.choice(
        [
            lambda: some("0123456789abcdef", 16, 64),
            lambda: some(letters, 16, 48),
            lambda: some(mixed, 24, 64),
            lambda: "ghp_" + some(letters, 36, 36),
            lambda: "xoxb-" + some(string.digits, 10, 12) + "-" + some(letters, 20, 28),
            lambda: "sk-" + some(letters, 24, 48),
            lambda: "eyJh" + some(letters, 16, 40) + "." + some(mixed, 20, 60) + "." + some(letters, 20, 43),
            lambda: "AKIA" + some(string.ascii_uppercase + string.digits, 16, 16),
            lambda: some(string.ascii_letters, 3, 8) + rng.choice("!$#@%&*") + some(letters, 4, 10),
            lambda: some(letters, 10, 24) + rng.choice("!$#@%&*") + some(letters, 4, 16),
        ]
    )()


NAMED = (
    "password", "passwd", "pwd", "passphrase", "secret", "client_secret", "token", "auth_token", "access_token", "api_key",
    "apikey", "api-key", "private_key", "secret_key", "aws_secret_access_key", "credential", "Authorization: Bearer", "bearer",
)


def _with_secret(rng: random.Random) -> tuple[str, str]:
    """A phrase and the secret in it."""
    name, value, quote = rng.choice(NAMED), _secret(rng), rng.choice(["", "", '"', "'"])
    if rng.random() < 0.3:
        name = name.upper()
    if name.lower().endswith("bearer"):
        return f"{name} {value}", value
    form = rng.choice(["{n} = {q}{v}{q}", "{n}={q}{v}{q}", "{n}: {q}{v}{q}", '"{n}": "{v}"', "{n} is {v}", "{n} {v}", "--{n} {v}"])
    return form.format(n=name, q=quote, v=value), value


def _look_alike(rng: random.Random) -> str:
    digits = lambda n: "".join(rng.choices(string.digits, k=n))
    word = lambda: "".join(rng.choices(string.ascii_lowercase, k=rng.randint(3, 12)))
    return rng.choice(
        [
            lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"{digits(3)}-{digits(2)}-{digits(4)}",
            lambda: digits(rng.randint(4, 16)),
            lambda: f"{word()}.{digits(2)}@{word()}.example.com",
            lambda: f"https://{word()}.example.org/{word()}/{digits(3)}?{word()}={digits(2)}",
            lambda: f"{digits(3)}.{digits(2)}.{digits(3)}.{digits(1)}",
            lambda: f"{digits(4)}-{digits(2)}-{digits(2)}T{digits(2)}:{digits(2)}",
            lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}",
            lambda: word() + word() + word() + word(),
            lambda: f"{word()}_{word()}_{word()}",
            lambda: word().capitalize() + word().capitalize() + word().capitalize(),
            lambda: f"the {rng.choice(NAMED)} {word()} {word()}",
            lambda: f"{rng.choice(NAMED)} is required",
            lambda: f"{word()} = {word()}",
            lambda: f"{word().upper()}: {digits(5)}",
            lambda: f"$$${word()}*** {word()}### {word()}&&&",
        ]
    )()


#: What follows an assigned value behind a sign that the pattern stops at, as part of the value.
BEYOND = re.compile(r"(?:[!$#@%&*^~?]+[A-Za-z0-9+/_.=-]+)*", re.ASCII)


def training_lines(texts: list[str]) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with the places of the secrets in them, at most TRAINING_LINES."""
    rng = random.Random(SEED)
    lines = [" ".join(line.split()[:LINE_TOKENS]) for text in texts for line in text.split("\n") if line.strip()]
    rng.shuffle(lines)
    lines = lines[: TRAINING_LINES // 3] or ["of the and to in is"]
    told = lambda line: [(v, e if k else BEYOND.match(line, e).end(), k) for _, k, e, v in base_spans(line)]
    made = [(line, [span[:2] for span in told(line)]) for line in lines]
    while len(made) < TRAINING_LINES:
        words = rng.choice(lines).split()[: LINE_TOKENS // 2]
        at = rng.randint(0, len(words))
        if rng.random() < 0.5:
            phrase, value = _with_secret(rng)
        else:
            phrase, value = _look_alike(rng), ""
        line = " ".join([*words[:at], phrase, *words[at:]])
        spans = [(v, e) for v, e, k in told(line) if k < 2 or not value]
        if value:
            place = line.index(value, len(" ".join(words[:at])))
            spans = [s for s in spans if s[1] <= place or s[0] >= place + len(value)] + [(place, place + len(value))]
        made.append((line, spans))
    return made


def train(texts: list[str]) -> Field:
    """A field from texts; the same texts give the same field. Without any, it learns from made-up lines alone."""
    lines = training_lines(texts)
    tokens, offsets = tokenize([line for line, _ in lines])
    n = len(tokens.start)
    gold = np.zeros(n, np.int64)
    for (_, spans), offset in zip(lines, offsets[:-1].tolist(), strict=True):
        for start, end in spans:
            inside = np.flatnonzero((tokens.start >= offset + start) & (tokens.end <= offset + end))
            gold[inside] = INSIDE
            gold[inside[:1]] = BEGIN
    # Words near secrets and first characters of secrets, of those that occur several times.
    near = np.zeros(n, bool)
    for by in (0, -1, -2, -3, -4):
        near |= (gold == BEGIN) if by == 0 else _at_lines((gold == BEGIN).astype(int), tokens.line, by).astype(bool)

    def frequent(values: np.ndarray) -> np.ndarray:
        known, counts = np.unique(values[values != 0], return_counts=True)
        chosen = known[counts >= 4]
        return np.sort(chosen[np.argsort(-counts[counts >= 4], kind="stable")][:WORDS])

    words, prefixes = frequent(tokens.word[near]), frequent(tokens.prefix[gold == BEGIN])
    sizes = [*SIZES, len(prefixes) + 1, *[len(words) + 1] * len(NEIGHBOURS)]
    field = Field(words, prefixes, [np.zeros((s, 3)) for s in sizes], np.zeros((3, 3)), np.zeros(3))
    indices = field.indices(tokens)

    # One row per line, longest first, so that a step of the recursions is over the first rows only.
    heads = np.flatnonzero(np.r_[True, tokens.line[1:] != tokens.line[:-1]])
    lengths = np.diff(np.r_[heads, n])
    order = np.argsort(-lengths, kind="stable")
    heads, lengths = heads[order], lengths[order]
    active = [int((lengths > t).sum()) for t in range(int(lengths[0]))]
    follows = np.flatnonzero(np.r_[False, tokens.line[1:] == tokens.line[:-1]])
    told = np.zeros((3, 3))
    np.add.at(told, (gold[follows - 1], gold[follows]), 1)
    told_start = np.bincount(gold[heads], minlength=3)

    params = [*field.tables, field.transitions, field.start]
    mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        scores = sum(table[index] for table, index in zip(field.tables, indices, strict=True))
        potential, moves = np.exp(scores - scores.max(axis=1, keepdims=True)), np.exp(field.transitions)
        ahead, behind = np.zeros((n, 3)), np.ones((n, 3))
        ahead[heads] = potential[heads] * np.exp(field.start)
        ahead[heads] /= ahead[heads].sum(axis=1, keepdims=True)
        for t in range(1, len(active)):
            at = heads[: active[t]] + t
            value = (ahead[at - 1] @ moves) * potential[at]
            ahead[at] = value / value.sum(axis=1, keepdims=True)
        for t in range(len(active) - 1, 0, -1):
            at = heads[: active[t]] + t
            value = (potential[at] * behind[at]) @ moves.T
            behind[at - 1] = value / value.sum(axis=1, keepdims=True)
        marginal = ahead * behind
        marginal /= marginal.sum(axis=1, keepdims=True)
        pair = ahead[follows - 1][:, :, None] * moves * (potential[follows] * behind[follows])[:, None, :]
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        slope = marginal.copy()
        slope[np.arange(n), gold] -= 1
        grads = [
            np.stack([np.bincount(index, slope[:, s], len(table)) for s in range(3)], axis=1)
            for table, index in zip(field.tables, indices, strict=True)
        ]
        grads += [pair.sum(axis=0) - told, marginal[heads].sum(axis=0) - told_start]
        for p, g, m, v in zip(params, grads, mean, square, strict=True):
            g = g / len(heads) + DECAY * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    field.tables = [table.astype(np.float32) for table in field.tables]
    return field


def fit(docs: DataFrame) -> Field:
    """A field from pieces of at most TRAINING_DOCUMENTS texts, from places in them that their ids decide."""
    last = F.greatest(F.length("text") - TRAINING_CHARS, F.lit(0)) + 1
    piece = F.substr("text", (1 + F.pmod(F.xxhash64("doc_id"), last)).cast("int"), F.lit(TRAINING_CHARS))
    pieces = docs.filter(F.col("text").isNotNull()).select("doc_id", piece.alias("piece"))
    return train([row.piece for row in sample_rows(pieces, "doc_id", TRAINING_DOCUMENTS).collect()])


def listed(spans: list[tuple[int, int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def scan(docs: DataFrame, field: Field, keep: list[str]) -> DataFrame:
    """The kept columns, the count of each base kind, `base_sha256`, and `spans` of every whole text.

    Places are code points, ends exclusive. NULL and empty texts have no spans,
    and the checksum of an empty text. The field adds its spans but those that base
    spans cover wholly, so spans may overlap. Repeated rows are all returned;
    an empty table gives no rows.
    """

    def start():
        scanner = Scanner(field)

        def apply(texts: list[str | None]) -> list:
            found = scanner(texts)
            counts = [[sum(kind == k for _, kind, _, _ in spans) for spans in found] for k in range(3)]
            base = [listed([s for s in spans if s[1] < 3]) for spans in found]
            return [*counts, [hashlib.sha256(b.encode()).hexdigest() for b in base], [listed(spans) for spans in found]]

        return apply

    schema = "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return map_text(docs, "text", keep, schema, start)


def masked(text: str, spans: list[tuple[int, int, int, int]]) -> str:
    """The text with the values of the spans replaced by the mask; those that overlap get one."""
    out, at = [], 0
    for start, end in sorted((value, end) for _, _, end, value in spans):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, field: Field) -> DataFrame:
    """The documents with masked secrets; `n_chars` is that of the text as it then is. A NULL text stays NULL."""

    def start():
        scanner = Scanner(field)
        return lambda texts: [
            [None if t is None else masked(t, spans) for t, spans in zip(texts, scanner(texts), strict=True)]
        ]

    whole = unused(docs, "_whole")
    kept = docs.withColumnRenamed("text", whole)
    made = map_text(kept, whole, [c for c in kept.columns if c != whole], "text string", start)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made.select(*docs.columns)
