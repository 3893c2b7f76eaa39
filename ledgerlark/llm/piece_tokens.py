"""SentencePiece encoding and decoding in batches of numpy arrays.

Texts are cut into words where no piece can reach across (before a run of the space mark, and around characters that no longer piece
holds). The distinct words of a chunk are sorted by length, and words of one length advance together, one end position at a time: the
hashes of all substrings that end there probe the sorted hashes of the pieces, and the maximum over the admissible ones is stored with
its backpointer.

* Unigram models: admissible is every piece, and the maximum is that of the sum of scores.
* BPE models: a prefix has one segmentation, and the last token of a prefix is the one piece that BPE leaves alone next to the last
  token of the prefix before it. Whether BPE leaves two tokens alone follows from their merge history (``_Pairs``); of the pieces
  that pass, the longest is taken. The sum of scores would give other tokens than the model's own merges do.
  Words with a run of space marks hold merges of equal rank; they are merged step by step.

Characters without a piece become byte pieces, or the unknown piece where a model has none. Models must not rewrite the text
(normaliser ``identity``). Decoding an encoding gives the text back, but that the mark U+2581 comes back as a space and that models which
remove extra white space do so.

Null and empty texts have no tokens; a text of 100,000 characters without a space is one word. Repeated rows get equal results.
"""

from __future__ import annotations

import heapq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerlark.llm import common as C

MARK = 0x2581
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Words remembered by a task between chunks.
REMEMBERED = 1 << 20


def _fields(data: bytes):
    """(field number, value) of a protobuf message."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return out

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


class Pieces(NamedTuple):
    """A model: pieces by id, sorted hashes of those that match text, and what BPE needs to know of their merges."""

    text: list[str]
    kind: np.ndarray
    score: np.ndarray
    bpe: bool
    prefix: bool
    squeeze: bool
    unknown: int
    keys: np.ndarray
    ids: np.ndarray
    longest: int
    joining: np.ndarray
    hashes: np.ndarray
    lengths: np.ndarray
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    stable: np.ndarray
    byte_ids: np.ndarray


def _mixed(code_points: np.ndarray) -> np.ndarray:
    return C.mix(code_points.astype(np.uint64) + np.uint64(0x1F123BB5))


def _prefix_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of all prefixes of equally long words, one column per length."""
    mixed = _mixed(words)
    out = np.zeros((words.shape[0], words.shape[1] + 1), np.uint64)
    for j in range(words.shape[1]):
        out[:, j + 1] = out[:, j] * _B + mixed[:, j]
    return out


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hash(text: str) -> int:
    return int(_prefix_hashes(_code_points(text)[None, :])[0, -1])


def _merge_steps(symbols: list[str], rank: dict[str, float]) -> list[tuple[str, str, str]]:
    """BPE on a list of symbols: the best adjacent pair is joined until none is left. Returns (left, right, joined) of the end tokens;
    a symbol that was never joined has empty parts."""
    parts = [("", "", s) for s in symbols]
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    queue: list[tuple[float, int, int, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(symbols):
            joined = parts[i][2] + parts[j][2]
            if joined in rank:
                heapq.heappush(queue, (rank[joined], i, j, joined))

    for i in range(len(symbols) - 1):
        offer(i)
    gone = [False] * len(symbols)
    while queue:
        _, i, j, joined = heapq.heappop(queue)
        if gone[i] or j >= len(symbols) or gone[j] or after[i] != j or parts[i][2] + parts[j][2] != joined:
            continue
        parts[i] = (parts[i][2], parts[j][2], joined)
        gone[j] = True
        after[i] = after[j]
        if after[i] < len(symbols):
            before[after[i]] = i
        if before[i] >= 0:
            offer(before[i])
        offer(i)
    return [p for p, g in zip(parts, gone, strict=True) if not g]


def load(path: str) -> Pieces:
    """The model in a SentencePiece file on the driver."""
    text, score, kind = [], [], []
    trainer, normaliser = {}, {}
    with open(path, "rb") as f:
        model = f.read()
    for field, value in _fields(model):
        if field == 1:
            piece = dict(_fields(value))
            text.append(piece[1].decode())
            score.append(np.frombuffer(piece.get(2, b"\0\0\0\0"), np.float32)[0])
            kind.append(piece.get(3, NORMAL))
        elif field == 2:
            trainer = dict(_fields(value))
        elif field == 3:
            normaliser = dict(_fields(value))
    if normaliser.get(2) or not normaliser.get(5, 1) or trainer.get(24, 0):
        raise ValueError("only models that keep the text as it is and put the space mark in front of words")
    if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE) or USER in kind:
        raise ValueError("only unigram and BPE models without pieces defined by the user")
    return pieces_of(text, np.array(score, np.float64), np.array(kind), trainer.get(3, UNIGRAM) == BPE,
                     bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)))


def pieces_of(text: list[str], score: np.ndarray, kind: np.ndarray, bpe: bool, prefix: bool = True, squeeze: bool = False) -> Pieces:
    usual = np.flatnonzero(kind == NORMAL)
    hashes = np.zeros(len(text), np.uint64)
    lengths = np.array([len(t) for t in text])
    for i in usual:
        hashes[i] = _hash(text[i])
    order = usual[np.argsort(hashes[usual])]
    if len(np.unique(hashes[usual])) != len(usual):
        raise ValueError("two pieces share a hash")
    joining = np.unique(np.concatenate([np.zeros(0, np.uint32), *[_code_points(text[i]) for i in usual if lengths[i] > 1]]))
    rank = np.full(len(text), -1.0)
    left, right, stable = (np.full(len(text), -1) for _ in range(3))
    if bpe:
        known = {text[i]: -float(score[i]) for i in usual if lengths[i] > 1}
        number = {text[i]: int(i) for i in usual}
        rank[usual] = np.where(lengths[usual] > 1, -score[usual], -1.0)
        for i in usual:
            end = _merge_steps(list(text[i]), known)
            stable[i] = len(end) == 1
            if stable[i] and lengths[i] > 1:
                left[i], right[i] = number.get(end[0][0], -1), number.get(end[0][1], -1)
                stable[i] = left[i] >= 0 and right[i] >= 0
    byte_ids = np.full(256, -1)
    for i in np.flatnonzero(kind == BYTE):
        byte_ids[int(text[i][3:5], 16)] = i
    unknown = int(np.flatnonzero(kind == UNKNOWN)[0]) if (kind == UNKNOWN).any() else 0
    return Pieces(text, kind, score, bpe, prefix, squeeze, unknown, hashes[order], order, int(lengths[usual].max()), joining, hashes,
                  lengths, rank, left, right, stable > 0, byte_ids)


class _Pairs:
    """Whether BPE leaves two neighbouring tokens alone, for pairs of pieces, remembered.

    The history of the border is walked back: the token that was made last is taken apart again, which gives the pair of tokens that
    met there before. If at any time the two could be joined to a piece of better rank than what happened next to either, they were."""

    def __init__(self, p: Pieces):
        self.p, self.keys, self.fine = p, np.zeros(0, np.int64), np.zeros(0, bool)

    def check(self, u: np.ndarray, t: np.ndarray) -> np.ndarray:
        wanted = u * len(self.p.text) + t
        pairs, which = np.unique(wanted, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, pairs), max(len(self.keys) - 1, 0))
        known = self.keys[at] == pairs if len(self.keys) else np.zeros(len(pairs), bool)
        fine = np.zeros(len(pairs), bool)
        if known.any():
            fine[known] = self.fine[at[known]]
        new = pairs[~known]
        if len(new):
            fine[~known] = self._walk(*np.divmod(new, len(self.p.text)))
            place = np.searchsorted(self.keys, new)
            self.keys, self.fine = np.insert(self.keys, place, new), np.insert(self.fine, place, fine[~known])
        return fine[which]

    def _walk(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        p = self.p
        fine, active = np.ones(len(x), bool), np.arange(len(x))
        x, y = x.copy(), y.copy()
        end_x, end_y = np.full(len(x), np.inf), np.full(len(x), np.inf)
        power = C.powers(p.longest + 1, _B)
        while len(active):
            a, b = x[active], y[active]
            joined = find(p, p.hashes[a] * power[p.lengths[b]] + p.hashes[b])
            rank = np.where(joined >= 0, p.rank[joined], np.inf)
            # Of equal ranks the left one is joined first.
            bad = (joined >= 0) & (rank < end_x[active]) & (rank <= end_y[active])
            fine[active[bad]] = False
            undo_x = p.rank[a] > p.rank[b]
            more = ~bad & ((p.rank[a] >= 0) | (p.rank[b] >= 0))
            rows = active[more & undo_x]
            end_x[rows], x[rows] = p.rank[x[rows]], p.right[x[rows]]
            rows = active[more & ~undo_x]
            end_y[rows], y[rows] = p.rank[y[rows]], p.left[y[rows]]
            active = active[more]
        return fine


def find(p: Pieces, hashes: np.ndarray) -> np.ndarray:
    """The piece with each hash, or -1."""
    at = np.minimum(np.searchsorted(p.keys, hashes), len(p.keys) - 1)
    return np.where(p.keys[at] == hashes, p.ids[at], -1)


def segment(p: Pieces, words: np.ndarray, pairs: _Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of equally long words, as a matrix filled from the right, and how many each has. A character without a piece is
    -1 - its code point."""
    n, size = words.shape
    prefix, power = _prefix_hashes(words), C.powers(p.longest + 1, _B)
    last = np.full((n, size + 1), -1)
    back = np.ones((n, size + 1), np.int64)
    best = np.zeros((n, size + 1))
    worst = p.score[p.ids].min() - 10
    for end in range(1, size + 1):
        reach = min(end, p.longest)
        lengths = np.arange(1, reach + 1)
        starts = end - lengths
        piece = find(p, prefix[:, end, None] - prefix[:, starts] * power[lengths])
        if p.bpe:
            fits = (piece >= 0) & p.stable[piece]
            row, column = np.nonzero(fits & (last[:, starts] >= 0) & (starts > 0))
            fits[row, column] = pairs.check(last[row, starts[column]], piece[row, column])
            value = np.where(fits, lengths, 0)
        else:
            value = np.where(piece >= 0, best[:, starts] + p.score[piece], -np.inf)
            value[:, 0] = np.where(piece[:, 0] >= 0, value[:, 0], best[:, end - 1] + worst)
        # Of equal values the longer piece.
        column = reach - 1 - value[:, ::-1].argmax(axis=1)
        rows = np.arange(n)
        if p.bpe:
            column = np.where(value[rows, column] > 0, column, 0)
            chosen = np.where(value[rows, column] > 0, piece[rows, column], -1)
        else:
            best[:, end] = value[rows, column]
            chosen = piece[rows, column]
        last[:, end], back[:, end] = np.where(chosen >= 0, chosen, -1 - words[:, end - 1].astype(np.int64)), column + 1
    tokens, counts, place = np.zeros((n, size), np.int64), np.zeros(n, np.int64), np.full(n, size)
    while True:
        rows = np.flatnonzero(place > 0)
        if not len(rows):
            return tokens, counts
        counts[rows] += 1
        tokens[rows, size - counts[rows]] = last[rows, place[rows]]
        place[rows] -= back[rows, place[rows]]


def _utf8_bytes(code_point: int) -> list[int]:
    return list(chr(code_point).encode("utf-8", "surrogatepass"))


class Encoder:
    """Encodes chunks of texts and remembers the words it has seen."""

    def __init__(self, p: Pieces):
        self.p = p
        self.pairs = _Pairs(p)
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)

    def words(self, texts: C.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points with marks for spaces, where words begin, and each text's first word."""
        data = texts.data.tobytes()
        try:
            chars = _code_points(data.decode())
            heads = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
            offsets = heads[texts.offsets]
        except UnicodeDecodeError:  # bytes that are no text read as replacement characters
            parts = [_code_points(data[a:b].decode("utf-8", "replace")) for a, b in zip(texts.offsets[:-1], texts.offsets[1:], strict=True)]
            chars, offsets = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        if self.p.squeeze:
            owner = np.repeat(np.arange(texts.count), np.diff(offsets))
            blank = chars == 0x20
            keep = ~blank
            keep[:-1] |= blank[:-1] & ~blank[1:] & (owner[:-1] == owner[1:])  # one space before what follows
            first = np.ones(len(chars), bool)
            first[1:] = owner[1:] != owner[:-1]
            inked = np.cumsum(~blank)
            begun = inked - np.concatenate([[0], inked])[offsets[:-1]][owner] if len(owner) else inked
            keep &= ~(blank & (begun == 0))
            chars, offsets = chars[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]
        if self.p.prefix:
            some = offsets[:-1][np.diff(offsets) > 0]
            chars = np.insert(chars, some, 0x20)
            offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        chars = np.where(chars == 0x20, np.uint32(MARK), chars)
        mark = chars == MARK
        at = np.minimum(np.searchsorted(self.p.joining, chars), max(len(self.p.joining) - 1, 0))
        apart = self.p.joining[at] != chars if len(self.p.joining) else np.ones(len(chars), bool)
        new = np.ones(len(chars), bool)
        new[1:] = (mark[1:] & ~mark[:-1]) | apart[1:] | apart[:-1]
        new[offsets[:-1][offsets[:-1] < len(chars)]] = True
        begins = np.flatnonzero(new)
        return chars, begins, np.searchsorted(begins, offsets)

    def learn(self, hashes: np.ndarray, chars: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> None:
        """Encode words that are new, given by their places in ``chars``."""
        p = self.p
        tokens, sizes, order = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        marks = np.zeros(len(begins), bool)
        if p.bpe:
            long = lengths > 1
            marks[long] = (chars[begins[long]] == MARK) & (chars[begins[long] + 1] == MARK)
            rank = {p.text[j]: p.rank[j] for j in p.ids if p.lengths[j] > 1} if marks.any() else {}
            for i in np.flatnonzero(marks):
                steps = _merge_steps([chr(c) for c in chars[begins[i]:begins[i] + lengths[i]].tolist()], rank)
                number = find(p, np.array([_hash(s[2]) for s in steps], np.uint64))
                tokens.append(np.array([int(k) if k >= 0 else -1 - ord(s[2]) for k, s in zip(number, steps, strict=True)]))
                sizes.append(np.array([len(steps)]))
                order.append(np.array([i]))
        for size in np.unique(lengths[~marks]).tolist():
            rows = np.flatnonzero((lengths == size) & ~marks)
            step = max(1, 500_000 // (size * p.longest))
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                found, counts = segment(p, chars[begins[part][:, None] + np.arange(size)], self.pairs)
                tokens.append(found[np.arange(size) >= size - counts[:, None]])
                sizes.append(counts)
                order.append(part)
        flat, per_word = self._spelled(np.concatenate(tokens), np.concatenate(sizes))
        place = np.concatenate(order)
        begin = len(self.tokens) + np.cumsum(per_word) - per_word
        self.tokens = np.concatenate([self.tokens, flat.astype(np.int32)])
        by_hash = np.argsort(hashes[place])
        at = np.searchsorted(self.known, hashes[place][by_hash])
        self.known = np.insert(self.known, at, hashes[place][by_hash])
        self.begin = np.insert(self.begin, at, begin[by_hash])
        self.size = np.insert(self.size, at, per_word[by_hash])

    def _spelled(self, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece written as byte pieces, and the tokens per word after that."""
        lost = np.flatnonzero(tokens < 0)
        if not len(lost):
            return tokens, sizes
        code, which = np.unique(tokens[lost], return_inverse=True)
        spelled = []
        for c in code.tolist():
            ids = self.p.byte_ids[_utf8_bytes(-1 - c)].tolist()
            spelled.append(ids if min(ids) >= 0 else [self.p.unknown])
        table = np.array([t for x in spelled for t in x])
        width = np.array([len(x) for x in spelled])
        each = np.ones(len(tokens), np.int64)
        each[lost] = width[which]
        word = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.cumsum(each)
        out = np.repeat(tokens, each)
        place = np.repeat((ends - each)[lost], each[lost])
        nth = np.arange(len(place)) - np.repeat(np.cumsum(each[lost]) - each[lost], each[lost])
        out[place + nth] = table[np.repeat((np.cumsum(width) - width)[which], each[lost]) + nth]
        return out, np.bincount(word, each, len(sizes)).astype(np.int64)

    def __call__(self, texts: C.Texts) -> list[pa.Array]:
        chars, begins, offsets = self.words(texts)
        if not len(begins):
            return [C.ragged(np.zeros(0, np.int32), np.zeros(texts.count + 1, np.int64), pa.int32())]
        lengths = np.diff(np.append(begins, len(chars)))
        place = np.arange(len(chars)) - np.repeat(begins, lengths)
        hashes = np.add.reduceat(_mixed(chars) * C.powers(int(lengths.max()))[place], begins)
        hashes = C.mix(hashes + lengths.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))
        found, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.forget()
        at = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != found) if len(self.known) else np.arange(len(found))
        if len(new):
            self.learn(found[new], chars, begins[first[new]], lengths[first[new]])
            at = np.searchsorted(self.known, found)
        begin, size = self.begin[at][of], self.size[at][of]
        ends = np.cumsum(size)
        ids = self.tokens[np.arange(ends[-1]) + np.repeat(begin - (ends - size), size)]
        return [C.ragged(ids, np.concatenate([[0], ends])[offsets], pa.int32())]


class Decoder:
    def __init__(self, p: Pieces):
        spelled = []
        for text, kind in zip(p.text, p.kind.tolist(), strict=True):
            spelled.append(bytes([int(text[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                           else " ⁇ ".encode() if kind == UNKNOWN else text.replace("▁", " ").encode())
        self.data = np.frombuffer(b"".join(spelled), np.uint8)
        self.size = np.array([len(x) for x in spelled], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.led = np.array([t.startswith("▁") for t in p.text]) & p.prefix

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts from ids; ``offsets`` has one more entry than texts."""
        size, begin = self.size[ids], self.begin[ids].copy()
        heads = offsets[:-1][np.diff(offsets) > 0]
        heads = heads[self.led[ids[heads]]]
        size = size.copy()
        size[heads] -= 1  # the space in front of the text is not the text's
        begin[heads] += 1
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        data = self.data[np.arange(total) + np.repeat(begin - (ends - size), size)]
        borders = np.concatenate([[0], ends])[offsets]
        out = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                    [None, pa.py_buffer(borders.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        try:
            return out.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()])


class Checked:
    """Encodes, decodes again, and says of each text whether it came back."""

    def __init__(self, p: Pieces):
        self.encoder, self.decoder, self.squeeze = Encoder(p), Decoder(p), p.squeeze

    def __call__(self, texts: C.Texts) -> list[pa.Array]:
        ids = self.encoder(texts)[0]
        offsets = ids.offsets.to_numpy().astype(np.int64)
        back = self.decoder(ids.values.to_numpy().astype(np.int64), offsets).to_pylist()
        data, same = texts.data.tobytes(), []
        for a, b, text in zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), back, strict=True):
            given = data[a:b].decode("utf-8", "replace").replace("▁", " ")
            same.append(text == (" ".join(w for w in given.split(" ") if w) if self.squeeze else given))
        return [ids, pa.array(same, pa.bool_())]


def encode(df: DataFrame, path: str, carry: list[str], text: str = "text", ids: str = "ids", check: str | None = None) -> DataFrame:
    """``carry`` and ``ids``, an array of the text's piece ids; with ``check`` also whether decoding them gave the text back."""
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if check is None:
        return C.map_texts(df, carry, Encoder(load(path)), fields, text)
    return C.map_texts(df, carry, Checked(load(path)), [*fields, T.StructField(check, T.BooleanType())], text)


def decode(df: DataFrame, path: str, carry: list[str], ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``carry`` and ``text`` from an array of piece ids. Null ids read as none; ids outside the model end the job."""
    decoder, n = Decoder(load(path)), len(carry)
    source = df.select(*carry, df[ids].alias("__ids"))
    schema = T.StructType([*source.schema.fields[:n], T.StructField(text, T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                lists = part.column(n).fill_null([])
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
                texts = decoder(flat.astype(np.int64), offsets.astype(np.int64))
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip([*part.columns[:n], texts], arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)
