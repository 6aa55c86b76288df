"""Fuzzy line dedup: MinHash bands and SimHashes of the words find candidates, edit similarity decides, one line per group."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbgrid.llm.common import join_summary, packed, require_new, stored, unpacked
from orbgrid.llm.components import components
from orbgrid.llm.simhash import BUCKET_ROWS

#: Shorter lines (headings, answers) repeat by right and are left alone.
MIN_WORDS = 5
#: Lines link at this edit similarity, or more, of the lower-cased lines.
SIMILARITY = 0.8
#: Candidates share a band of ROWS MinHashes, one of BANDS, and differ in at most so many SimHash bits.
BANDS, ROWS, RADIUS = 16, 4, 20
#: Shorter words (bytes; mostly articles) are no features where MIN_WORDS others remain.
LONG_BYTES = 4
#: Lines of one group that a task compares at once; larger groups are cut into slices.
GROUP_LINES = 1024
#: Groups up to this size take all pairs at once; characters of pairs that are laid side by side.
SMALL_GROUP, TABLE_CHARS = 8, 1 << 20
#: Lines that a task compares at once, in whole groups.
BATCH_LINES = 16_384
#: Lines of a part of a band's keys, about; and keys held before those of hot runs go on.
PART_LINES, HELD_KEYS = 250_000, 1 << 22
#: Rows of keys (8 bytes and an id) up to which they are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 500_000

#: Characters of text that a task hashes at once (a longer text goes alone).
CHUNK_CHARS = 1 << 17

# ASCII marks, controls and white space (but the line end) as a space.
_PLAIN = bytes(b if b == 10 or 48 <= b < 58 or 97 <= b < 123 or b >= 128 else 32 for b in range(256))
_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


#: Multipliers of the MinHashes.
_MINS = np.random.default_rng(977).integers(0, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)


def normalise(line: str) -> str:
    """The words of a line: lower case; ASCII marks and white space only separate them."""
    return b" ".join(_lower(line).translate(_PLAIN).split()).decode("utf-8", "surrogatepass")


def _lower(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _powers(base: int, n: int) -> np.ndarray:
    """The powers of ``base`` from 0 to ``n``, modulo 2**64."""
    return _power_table(base, n.bit_length())[: n + 1]


@lru_cache(maxsize=8)
def _power_table(base: int, bits: int) -> np.ndarray:
    out = np.full((1 << bits) + 1, base, np.uint64)
    out[0] = 1
    return out.cumprod(dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _vote(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The majority bits of consecutive runs of 64-bit hashes."""
    # One byte a bit, eight bytes a lane: up to 255 words are added without a carry.
    parts = -(-sizes // 255)
    first = np.cumsum(parts) - parts
    nth = np.arange(int(parts.sum())) - np.repeat(first, parts)
    starts = np.repeat(np.cumsum(sizes) - sizes, parts) + 255 * nth
    lanes = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").view(np.uint64)
    sums = np.add.reduceat(lanes, starts, axis=0).view(np.uint8).astype(np.int32)
    votes = np.add.reduceat(sums, first, axis=0)
    return np.packbits(2 * votes > sizes[:, None], axis=1, bitorder="little").view("<i8").ravel()


def _words(raw: bytes) -> tuple[np.ndarray, ...]:
    """Of lower-cased lines: numbers of those that count; start, end and line of their words, hashes, distinct ones.

    Words are found and hashed in one pass over the bytes (a polynomial whose
    prefix sums give the hash of any stretch, then mixed).
    """
    data = np.frombuffer(raw.translate(_PLAIN), np.uint8)
    end = data == 10
    edge = np.diff(np.concatenate([[True], end | (data == 32), [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    line = np.concatenate([[0], np.cumsum(end)])[starts]
    counts = np.bincount(line, minlength=raw.count(b"\n") + 1)
    numbers = np.flatnonzero(counts >= MIN_WORDS)
    counted = (counts >= MIN_WORDS)[line]
    starts, ends, line = starts[counted], ends[counted], line[counted]

    sums = np.zeros(len(data) + 1, np.uint64)
    if len(numbers):
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(data) - 1), out=sums[1:])
    words = _mixed((sums[ends] - sums[starts]) * _powers(_ODD_INVERSE, len(data))[starts])
    order = np.argsort(_mixed(words + line.astype(np.uint64) * np.uint64(_ODD)))
    again = np.concatenate([[False], (words[order][1:] == words[order][:-1]) & (line[order][1:] == line[order][:-1])])
    return numbers, starts, ends, line, words, np.sort(order[~again] if len(order) else order)


def hash_lines(texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of the lines of all texts, one after another: numbers of those that count, digests of their words, SimHashes.

    Each distinct word of a line votes once: an article that fills half a
    line would otherwise decide all its bits, and unrelated lines would meet.
    """
    raw = _lower("\n".join(texts))
    numbers, starts, ends, line, words, once = _words(raw)
    if not len(numbers):
        return numbers, [], np.zeros(0, np.int64)
    sims = _vote(words[once], np.bincount(line[once])[numbers])
    own = np.split(np.arange(len(line)), np.flatnonzero(np.diff(line)) + 1)
    return numbers, [xxhash.xxh3_128_digest(b" ".join([raw[starts[w] : ends[w]] for w in ws])) for ws in own], sims


def describe_lines(texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """As ``hash_lines``, but digests of the lower-cased lines themselves, SimHashes of their features, and MinHash bands.

    Features are the distinct words; short ones only where few are long.
    """
    raw = _lower("\n".join(texts))
    numbers, starts, ends, line, words, once = _words(raw)
    if not len(numbers):
        return numbers, [], np.zeros(0, np.int64), np.zeros((0, BANDS), np.uint32)
    breaks = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10)
    begins = np.concatenate([[0], breaks + 1])[numbers].tolist()
    stops = np.concatenate([breaks, [len(raw)]])[numbers].tolist()
    digests = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(begins, stops, strict=True)]

    long = (ends - starts)[once] >= LONG_BYTES
    enough = np.bincount(line[once][long], minlength=numbers[-1] + 1) >= MIN_WORDS
    once = once[long | ~enough[line[once]]]
    sizes = np.bincount(line[once])[numbers]
    features, heads = (words[once] >> np.uint64(32)).astype(np.uint32), np.cumsum(sizes) - sizes
    bands = np.zeros((len(numbers), BANDS), np.uint32)
    for k in range(BANDS):
        key = np.zeros(len(numbers), np.uint64)
        for m in _MINS[k * ROWS : (k + 1) * ROWS]:
            key = key * np.uint64(_ODD) + np.minimum.reduceat(features * m, heads)
        bands[:, k] = _mixed(key) >> np.uint64(32)
    return numbers, digests, _vote(words[once], sizes), bands


def _binaries(rows: np.ndarray) -> pa.Array:
    """Each row's bytes."""
    kind = pa.binary(rows.shape[1] * rows.itemsize)
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the lines that count: row, line number, 128-bit hash, SimHash, bands."""

    def done(batch: pa.RecordBatch, at: list[int], texts: list[str]) -> pa.RecordBatch:
        numbers, digests, sims, bands = describe_lines(texts)
        own = np.array([t.count("\n") + 1 for t in texts])
        text_of = np.repeat(np.arange(len(texts)), own)[numbers]
        inside = numbers - (np.cumsum(own) - own)[text_of]
        where = pa.array(np.array(at, np.int64)[text_of])
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(where), batch.column("_row").take(where), pa.array(inside.astype(np.int32)),
                pa.array(digests, pa.binary()), pa.array(sims), _binaries(bands),
            ],
            ["doc_id", "_row", "line", "h", "sim", "bands"],
        )

    for batch in batches:
        at, texts, size = [], [], 0
        for k, value in enumerate(batch.column("text")):
            text = value.as_py()
            if not text:
                continue
            at.append(k)
            texts.append(text)
            size += len(text)
            if size > CHUNK_CHARS:
                yield done(batch, at, texts)
                at, texts, size = [], [], 0
        if texts:
            yield done(batch, at, texts)


def _blocks(parts: int):
    """Keys of all SimHashes and bands as blocks, one for each part of a band's keys and batch of lines.

    A block has the steps between its sorted keys, a plane for each of their
    bytes (the upper ones are nearly all zero), and the SimHashes.
    """
    width = -(-(1 << 32) // parts)
    edges = np.minimum(np.arange(parts + 1) * width, 1 << 32)

    def made(sims: np.ndarray, bands: np.ndarray) -> pa.RecordBatch:
        numbers, blocks = [], []
        for band in range(BANDS):
            order = np.argsort(bands[:, band], kind="stable")
            keys, fps = bands[order, band], sims[order]
            new = np.append(True, (keys[1:] != keys[:-1]) | (fps[1:] != fps[:-1]))
            keys, fps = keys[new], fps[new]
            cuts = np.searchsorted(keys, edges)
            for k in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                a, b = cuts[k], cuts[k + 1]
                steps = np.diff(keys[a:b], prepend=np.uint32(edges[k]))
                numbers.append(band * parts + k)
                blocks.append(steps.view(np.uint8).reshape(-1, 4).T.tobytes() + fps[a:b].tobytes())
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blocks, pa.binary())], ["part", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            sims = batch.column("sim").to_numpy(zero_copy_only=False)
            held.append((sims, np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.uint32).reshape(len(sims), BANDS)))
            size += len(sims)
            if size >= PART_LINES:
                yield made(*map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if size:
            yield made(*map(np.concatenate, zip(*held, strict=True)))

    return run


def _keys_of(block: bytes, first: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and SimHashes of a block."""
    n = len(block) // 12
    steps = np.frombuffer(block, np.uint8, 4 * n).reshape(4, n).T.copy().view(np.uint32).ravel()
    return (np.cumsum(steps, dtype=np.uint32) + np.uint32(first)), np.frombuffer(block, np.int64, n, 4 * n)


# -- edit similarity ------------------------------------------------------------------------------


def edit_distance(a: str, b: str, most: int | None = None) -> int:
    """Levenshtein distance, a column of the table at a time as bits of one integer (Myers).

    With ``most`` it ends once the distance must be more, and gives some number above.
    """
    if len(a) < len(b):
        a, b = b, a
    if not b:
        return len(a)
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, get, columns = (1 << len(a)) - 1, where.get, len(b)
    # The steps down a column, up by one or down by one; their sum is how far its end is from its top.
    up, down = full, 0
    for at in range(0, columns, 64):
        for c in b[at : at + 64]:
            match = get(c, 0)
            diagonal = (((match & up) + up ^ up) | match | down) & full
            plus = (down | full ^ (diagonal | up)) << 1 & full | 1
            up, down = (up & diagonal) << 1 & full | full ^ (diagonal | plus), plus & diagonal
        # Each column still to come takes one off the distance at best.
        done = min(at + 64, columns)
        distance = done + up.bit_count() - down.bit_count()
        if most is not None and distance > most + columns - done:
            return distance
    return distance


def most_edits(longer: int) -> int:
    """Edits up to which two lines are similar."""
    return int((1 - SIMILARITY) * longer + 1e-9)


def edits_by_word(a: list[str], b: list[str], most: int) -> int:
    """Edits of an alignment by words, so at least as many as needed; past ``most`` it ends.

    The lines are the words with a space between them.  Where they differ, the
    nearest pair of equal words some steps on is taken up again, and what lies
    between counts in full, or is compared by itself if that is too much.
    """
    i, j, cost, n, m = 0, 0, 0, len(a), len(b)
    parts, open_ = [], 0
    while i < n and j < m and cost - open_ <= most:
        if a[i] == b[j]:
            i, j = i + 1, j + 1
            continue
        di, dj = next(((x, y) for x, y in _AHEAD if i + x < n and j + y < m and a[i + x] == b[j + y]), (n - i, m - j))
        x, y = " ".join(a[i : i + di]), " ".join(b[j : j + dj])
        longer = max(len(x), len(y))
        cost += longer
        if not di or not dj:
            cost += 1  # and a space
        elif max(di, dj) < 6:
            parts.append((x, y, longer))
            open_ += longer
        i, j = i + di, j + dj
    cost += max(sum(map(len, a[i:])) + n - i, sum(map(len, b[j:])) + m - j)
    for x, y, longer in parts:
        if cost <= most or cost - open_ > most:
            break
        cost += edit_distance(x, y) - longer
        open_ -= longer
    return cost


_AHEAD = sorted(((x, y) for x in range(6) for y in range(6) if x + y), key=lambda p: (max(p), sum(p)))


class Line:
    """A lower-cased line with what comparisons need of it, made when asked for."""

    __slots__ = ("codes", "text", "_grams", "_words")

    def __init__(self, text: str):
        self.text = text
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        self._grams: np.ndarray | None = None
        self._words: list[str] | None = None

    @property
    def words(self) -> list[str]:
        if self._words is None:
            self._words = self.text.split(" ")
        return self._words

    @property
    def grams(self) -> np.ndarray:
        """How often each class of three characters in a row occurs."""
        if self._grams is None:
            c = self.codes
            self._grams = np.bincount((c[:-2] * 961 + c[1:-1] * 31 + c[2:]) & 1023, minlength=1024) if len(c) > 2 else np.zeros(1024, np.int64)
        return self._grams


def alike(a: Line, b: Line) -> bool:
    """Edit similarity ``1 - distance / longer length`` of at least SIMILARITY.

    Decided by what the lines begin and end with, by an alignment of their
    words (at least as many edits as needed), by the triples of characters
    they share (an edit takes away three at most), and else by the distance itself.
    """
    n, m = len(a.codes), len(b.codes)
    longer, shorter = max(n, m), min(n, m)
    most = most_edits(longer)
    if longer - shorter > most:
        return False
    if longer <= most:
        return True
    apart = np.flatnonzero(a.codes[:shorter] != b.codes[:shorter])
    head = int(apart[0]) if len(apart) else shorter
    back = np.flatnonzero(a.codes[n - shorter + head :][::-1] != b.codes[m - shorter + head :][::-1])
    tail = int(back[0]) if len(back) else shorter - head
    return longer - head - tail <= most or differ_little(a, b, head, tail)


def differ_little(a: Line, b: Line, head: int, tail: int) -> bool:
    """``alike`` for lines that begin and end with as many equal characters."""
    n, m = len(a.codes), len(b.codes)
    longer = max(n, m)
    most = most_edits(longer)
    if edits_by_word(a.words, b.words, most) <= most:
        return True
    if int(np.minimum(a.grams, b.grams).sum()) < longer - 2 - 3 * most:
        return False
    return edit_distance(a.text[head : n - tail], b.text[head : m - tail], most) <= most


def similar(a: str, b: str) -> bool:
    return alike(Line(a), Line(b))


def _aligned(codes: np.ndarray, at: np.ndarray, size: np.ndarray, width: int, pad: int, step: int = 1) -> np.ndarray:
    """A row for each stretch of ``codes`` from ``at`` on, filled up with ``pad``."""
    k = np.arange(width)
    inside = k < size[:, None]
    return np.where(inside, codes[np.where(inside, at[:, None] + step * k, 0)], np.uint32(pad))


class Lines:
    """Lower-cased lines as one array of characters, for comparisons of many pairs at once."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self._lines: dict[int, Line] = {}
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        self.sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum(self.sizes) - self.sizes
        of = np.repeat(np.arange(len(texts)), self.sizes)
        self.letters = np.bincount(of * 64 + (self.codes & 63), minlength=64 * len(texts)).reshape(-1, 64).astype(np.int32)

    def quick(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For pairs of lines: whether they are alike by what they begin and end with, whether that is open, and its lengths."""
        n, m = self.sizes[a], self.sizes[b]
        shorter, longer = np.minimum(n, m), np.maximum(n, m)
        most = ((1 - SIMILARITY) * longer + 1e-9).astype(np.int64)
        out, open_ = longer <= most, np.zeros(len(a), bool)
        head, tail = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
        for at in range(0, len(a), 1 << 14):
            own = slice(at, at + (1 << 14))
            more = self.letters[b[own]] - self.letters[a[own]]
            least = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
            open_[own] = ~out[own] & (longer - shorter <= most)[own] & (least <= most[own])
        some = np.flatnonzero(open_)
        some, at = some[np.argsort(longer[some], kind="stable")], 0
        while at < len(some):
            own = some[at : at + max(1, TABLE_CHARS // (int(longer[some[min(at + 1023, len(some) - 1)]]) + 1))][:1024]
            at += len(own)
            width = int(longer[own[-1]]) + 1
            x, y = self.starts[a[own]], self.starts[b[own]]
            head[own] = (_aligned(self.codes, x, n[own], width, 1 << 30) != _aligned(self.codes, y, m[own], width, 1 << 31)).argmax(axis=1)
            x, y = x + n[own] - 1, y + m[own] - 1
            back = (_aligned(self.codes, x, n[own], width, 1 << 30, -1) != _aligned(self.codes, y, m[own], width, 1 << 31, -1)).argmax(axis=1)
            tail[own] = np.minimum(back, shorter[own] - head[own])
        out[some] = (longer - head - tail)[some] <= most[some]
        return out, open_ & ~out, head, tail

    def line(self, x: int) -> Line:
        if x not in self._lines:
            self._lines[x] = Line(self.texts[x])
        return self._lines[x]

    def full(self, a: np.ndarray, b: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
        """For pairs that ``quick`` left open whether they are alike."""
        pairs = zip(*(x.tolist() for x in (a, b, head, tail)), strict=True)
        return np.array([differ_little(self.line(x), self.line(y), k, t) for x, y, k, t in pairs], bool)

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of lines whether ``alike`` holds."""
        out, open_, head, tail = self.quick(a, b)
        some = np.flatnonzero(open_)
        out[some] = self.full(a[some], b[some], head[some], tail[some])
        return out


def link_groups(sims: np.ndarray, texts: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (as row numbers) that connect whatever the links within each group connect; ``group`` is sorted.

    Pairs are compared by SimHash, then by letter counts (at least as many
    edits as letters that one has more), then in full: in small groups each
    pair not connected yet by what lines begin and end with, in others lines
    with those not reached yet, a step of all groups at once.
    """
    lines = Lines(texts)
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(starts, len(group)))
    small = np.repeat(sizes <= SMALL_GROUP, sizes)
    a, b = [], []
    for shift in range(1, SMALL_GROUP):
        i = np.flatnonzero((group[shift:] == group[:-shift]) & small[shift:])
        a.append(i)
        b.append(i + shift)
    a, b = np.concatenate(a), np.concatenate(b)
    near = np.bitwise_count((sims[a] ^ sims[b]).view(np.uint64)) <= RADIUS
    a, b = a[near], b[near]
    hit, open_, head, tail = lines.quick(a, b)
    left, right = [a[hit]], [b[hit]]
    joined = np.flatnonzero(hit)
    label, some = np.arange(len(group)), np.flatnonzero(open_)
    while True:
        before = None
        while before is None or (label != before).any():
            before = label.copy()
            np.minimum.at(label, a[joined], before[b[joined]])
            np.minimum.at(label, b[joined], label[a[joined]])
        some = some[label[a[some]] != label[b[some]]]
        if not len(some):
            break
        # One pair of each set that hangs together so far.
        first = np.unique(label[a[some]], return_index=True)[1]
        asked, some = some[first], np.delete(some, first)
        asked = asked[lines.full(a[asked], b[asked], head[asked], tail[asked])]
        left.append(a[asked])
        right.append(b[asked])
        joined = np.concatenate([joined, asked])
    large = [(np.arange(s + 1, s + n), [s]) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n > SMALL_GROUP]
    while large:
        asked, met = [], []
        for rest, reached in large:
            x = reached.pop()
            near = np.bitwise_count((sims[rest] ^ sims[x]).view(np.uint64)) <= RADIUS
            asked.append(np.full(int(near.sum()), x))
            met.append(rest[near])
        a, b = np.concatenate(asked), np.concatenate(met)
        hit = lines.alike(a, b)
        left.append(a[hit])
        right.append(b[hit])
        gone = np.zeros(len(group), bool)
        gone[b[hit]] = True
        again = []
        for (rest, reached), own in zip(large, met, strict=True):
            reached += own[gone[own]].tolist()
            rest = rest[~gone[rest]]
            if not reached and len(rest):
                reached, rest = [int(rest[0])], rest[1:]
            if len(rest):
                again.append((rest, reached))
        large = again
    return np.concatenate(left), np.concatenate(right)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal ``key``."""

    def links(table: pa.Table) -> pa.RecordBatch:
        key, sims = table["key"].to_numpy(), table["sim"].to_numpy()
        a, b = link_groups(sims, [t.lower() for t in table["text"].to_pylist()], key)
        h = table["h"].combine_chunks()
        return pa.RecordBatch.from_arrays([h.take(pa.array(a)), h.take(pa.array(b))], ["a", "b"])

    held, size = [], 0
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= BATCH_LINES:
            table = pa.concat_tables(held)
            key = table["key"].to_numpy()
            whole = int(np.searchsorted(key, key[-1], "left"))
            if whole:
                yield links(table.slice(0, whole))
            held, size = [table.slice(whole)], len(key) - whole
    if size:
        yield links(pa.concat_tables(held))


# -- candidates -----------------------------------------------------------------------------------


def near_sets(fps: np.ndarray) -> np.ndarray:
    """For distinct SimHashes the first one of those they hang together with, at RADIUS bits a step."""
    root, rest = np.arange(len(fps)), np.arange(len(fps))
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        first = reached[0]
        while reached and len(rest):
            near = np.bitwise_count((fps[rest] ^ fps[reached.pop()]).view(np.uint64)) <= RADIUS
            root[rest[near]] = first
            reached += rest[near].tolist()
            rest = rest[~near]
    return root


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Consecutive runs as lists."""
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values))


def _found(hot: bool, keys: np.ndarray, fps: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    key = keys[starts]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(key), hot)), pa.array((key >> 32).astype(np.int32)), pa.array(key), _lists(fps, starts)], ["hot", "band", "key", "fps"]
    )


def _teams(k: np.ndarray, f: np.ndarray, limit: int | None) -> Iterator[pa.RecordBatch]:
    """Sorted runs of equal keys as sets of near SimHashes (``fps``), two at least; runs over ``limit`` as they are, marked hot."""
    new = np.append(True, (k[1:] != k[:-1]) | (f[1:] != f[:-1]))[: len(k)]
    k, f = k[new], f[new]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])[: len(k)])
    sizes = np.diff(np.append(starts, len(k)))
    # Short runs, by distance within the run: who has company.
    short, near, shift = np.repeat(sizes <= 16, sizes), np.zeros(len(k), bool), 1
    while True:
        same = np.flatnonzero((k[shift:] == k[:-shift]) & short[shift:])
        if not len(same):
            break
        hit = same[np.bitwise_count((f[same] ^ f[same + shift]).view(np.uint64)) <= RADIUS]
        near[hit] = near[hit + shift] = True
        shift += 1
    if near.any():
        own = k[near]
        yield _found(False, own, f[near], np.flatnonzero(np.append(True, own[1:] != own[:-1])))
    for at, n in zip(starts[sizes > 16].tolist(), sizes[sizes > 16].tolist(), strict=True):
        own, fps = k[at : at + n], f[at : at + n]
        if limit is not None and n > limit:
            yield _found(True, own, fps, np.zeros(1, np.int64))
            continue
        root = near_sets(fps)
        some = np.flatnonzero(np.bincount(root, minlength=n)[root] > 1)
        if len(some):
            some = some[np.argsort(root[some], kind="stable")]
            sets = root[some]
            yield _found(False, own[some], fps[some], np.flatnonzero(np.append(True, sets[1:] != sets[:-1])))


def _met_in_blocks(parts: int, limit: int):
    """Teams of the runs of equal keys within each part (all its blocks follow each other)."""
    width = -(-(1 << 32) // parts)

    def sets(keys: list[np.ndarray], fps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted entries whose keys come more than once."""
        k, f = np.concatenate(keys), np.concatenate(fps)
        order = np.argsort(k, kind="stable")
        k, f = k[order], f[order]
        same = k[1:] == k[:-1]
        some = np.append(same, False) | np.append(False, same)
        k, f = k[some], f[some]
        order = np.lexsort((f, k))
        return k[order], f[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, fps, size, most, hot = None, [], [], 0, HELD_KEYS, np.zeros(0, np.uint32)

        def ended(part: int) -> Iterator[pa.RecordBatch]:
            k, f = sets(keys, fps)
            if not len(k):
                return
            wide = np.int64(part // parts << 32) | k.astype(np.int64)
            known = np.isin(k, hot)
            if known.any():
                own = wide[known]
                yield _found(True, own, f[known], np.flatnonzero(np.append(True, own[1:] != own[:-1])))
            yield from _teams(wide[~known], f[~known], limit)

        for batch in batches:
            for number, block in zip(batch.column("part").to_pylist(), batch.column("block"), strict=True):
                if number != part:
                    if size:
                        yield from ended(part)
                    part, keys, fps, size, most, hot = number, [], [], 0, HELD_KEYS, np.zeros(0, np.uint32)
                k, f = _keys_of(block.as_buffer().to_pybytes(), part % parts * width)
                keys.append(k)
                fps.append(f)
                size += len(k)
                if size > most:
                    # Runs that are hot already go on, so that what is held is bounded by the keys' number.
                    k, f = np.concatenate(keys), np.concatenate(fps)
                    order = np.lexsort((f, k))
                    k, f = k[order], f[order]
                    new = np.append(True, (k[1:] != k[:-1]) | (f[1:] != f[:-1]))
                    k, f = k[new], f[new]
                    values, counts = np.unique(k, return_counts=True)
                    hot = np.union1d(hot, values[counts > limit])
                    known = np.isin(k, hot)
                    if known.any():
                        own = np.int64(part // parts << 32) | k[known].astype(np.int64)
                        yield _found(True, own, f[known], np.flatnonzero(np.append(True, own[1:] != own[:-1])))
                    keys, fps, size = [k[~known]], [f[~known]], int((~known).sum())
                    most = max(HELD_KEYS, 2 * size)
        if size:
            yield from ended(part)

    return run


def _met_in_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Teams of the sorted runs of equal ``key``, one row an entry."""
    k = f = np.zeros(0, np.int64)
    for batch in batches:
        more = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
        k, f = (np.concatenate(x) for x in zip((k, f), more, strict=True))
        last = int(np.searchsorted(k, k[-1], "left")) if len(k) else 0
        if last:
            yield from _teams(k[:last], f[:last], None)
        k, f = k[last:], f[last:]
    if len(k):
        yield from _teams(k, f, None)


def near_teams(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """``band``, ``fps``: sets of SimHashes (of stored lines with ``sim``, ``bands``) that share a band and hang together there.

    Keys are shuffled once, in blocks of a part of a band's keys each.  A run over BUCKET_ROWS is
    cut into slices by hash, and every pair of slices is a run of its own.
    """
    ddl = "hot boolean, band int, key bigint, fps array<bigint>"
    parts = max(1, -(-lines.count() // PART_LINES))
    blocks = lines.select("sim", "bands").mapInArrow(_blocks(parts), "part int, block binary")
    met = blocks.repartition("part").sortWithinPartitions("part")
    found = stored(spark, met.mapInArrow(_met_in_blocks(parts, BUCKET_ROWS), ddl))
    hot = found.where("hot").select("key", F.explode("fps").alias("fp")).distinct()
    sizes = hot.groupBy("key").agg(F.ceil(F.count("*") / (BUCKET_ROWS / 2)).cast("int").alias("g"))
    # A key keeps its band in the upper half; the lower half names the pair of slices.
    pair = F.xxhash64("key", F.least("s", "t"), F.greatest("s", "t")).bitwiseAND(F.lit(0xFFFFFFFF))
    sliced = (
        join_summary(hot, sizes, "key")
        .withColumn("s", F.pmod(F.xxhash64("fp"), F.col("g")).cast("int"))
        .select("key", "fp", "s", F.explode(F.sequence(F.lit(0), F.col("g") - 1)).alias("t"))
        .select(F.shiftleft(F.shiftright("key", 32), 32).bitwiseOR(pair).alias("key"), "fp")
    )
    more = sliced.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(_met_in_rows, ddl)
    # Near lines share most bands: of equal sets the first is enough.
    return found.where(~F.col("hot")).unionByName(more).groupBy("fps").agg(F.min("band").alias("band"))


# -- jobs -----------------------------------------------------------------------------------------


def _with_row(docs: DataFrame) -> DataFrame:
    """Rows named by id and text, so that ids may repeat."""
    return docs.withColumn("_row", F.xxhash64("doc_id", "text"))


def line_classes(spark: SparkSession, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored lines that count, and for each hash that repeats or links: the occurrence that stays.

    Two lines link when their edit similarity, in lower case with all digits
    and marks, is SIMILARITY or more.  Candidates share one of BANDS bands of
    ROWS MinHashes of their words, and hang together among the lines of that
    band by steps of RADIUS SimHash bits at most.  Each such team is fetched
    (each line's text once) and compared by itself, so that chains of chance
    neighbours through different bands don't grow into one.  Teams over
    GROUP_LINES are cut into slices and each pair of slices is compared in a
    task of its own.
    """
    named = _with_row(docs.select("doc_id", "text"))
    lines = stored(
        spark,
        named.mapInArrow(_lines, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _row bigint, line int, h binary, sim bigint, bands binary"),
    )
    groups = stored(
        spark,
        lines.groupBy("h").agg(F.min(F.struct("doc_id", "_row", "line")).alias("first"), F.count("*").alias("n"), F.min("sim").alias("sim")),
    )
    near = stored(spark, near_teams(spark, lines))
    teams = near.select(F.xxhash64("band", "fps").alias("team"), F.explode("fps").alias("fp"))
    # Lines of one SimHash are a team of their own if they are in no other.
    twice = groups.groupBy(F.col("sim").alias("fp")).agg(F.count("*").alias("n")).where("n > 1").select("fp")
    alone = twice.join(teams, "fp", "left_anti").select(F.col("fp").alias("team"), "fp")
    teams = stored(spark, teams.unionByName(alone))
    wanted = groups.join(teams.select("fp").distinct(), F.col("sim") == F.col("fp"), "left_semi").select("h", "sim", "first")
    texts = stored(spark, _fetch(spark, named, stored(spark, wanted)))
    members = stored(spark, teams.join(texts.select("h", F.col("sim").alias("fp")), "fp").select("team", "h"))
    sizes = members.groupBy("team").agg(F.ceil(F.count("*") / (GROUP_LINES / 2)).cast("int").alias("_g"))
    mine = F.pmod(F.xxhash64("h"), F.col("_g")).cast("int")
    met = (
        join_summary(members, sizes, "team")
        .withColumn("_s", mine)
        .select("team", "h", "_s", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)).alias("_t"))
        .select(F.xxhash64("team", F.least("_s", "_t"), F.greatest("_s", "_t")).alias("key"), "h")
        .join(texts, "h")
        .select("key", "h", "sim", "text")
    )
    edges = met.repartition("key").sortWithinPartitions("key", "h").mapInArrow(_verified, "a binary, b binary")
    roots = components(spark, edges.distinct())
    placed = groups.join(roots, groups["h"] == roots["node"], "left").select(
        "h", "first", "n", F.coalesce("root", "h").alias("_class")
    )
    classes = placed.groupBy("_class").agg(F.min("first").alias("stays"), F.sum("n").alias("total")).where("total > 1")
    return lines, join_summary(placed.select("h", "_class"), classes, "_class").select("h", "stays")


def _fetch(spark: SparkSession, named: DataFrame, wanted: DataFrame) -> DataFrame:
    """``h, sim, text`` of the wanted lines, from the texts of their first occurrences, each cut up once."""
    at = wanted.select("h", "sim", F.struct(F.col("first._row"), F.col("first.doc_id"), F.col("first.line")).alias("_at"))
    if wanted.count() <= BROADCAST_KEYS:
        at = F.broadcast(at)
    own = named.select("_row", "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    own = own.select(F.struct("_row", "doc_id", "line").alias("_at"), "text")
    # Rows that repeat with id and text have the line more than once.
    return own.join(at, own["_at"].eqNullSafe(at["_at"])).groupBy("h").agg(F.first("sim").alias("sim"), F.first("text").alias("text"))


def dedup_lines(spark: SparkSession, docs: DataFrame, names: tuple[str, str] = ("n_lines", "n_removed")) -> DataFrame:
    """``docs`` without repeated lines, and how many lines it had and lost (``names``, which may not exist).

    Of each connected group of lines the occurrence with the smallest id (then
    line number) stays; all others are taken out of their texts, wherever they
    are.  Lines under MIN_WORDS words stay.  Null texts stay null; a text
    all of whose lines go becomes empty.  Rows that repeat with id and text
    share their fate, so each keeps the line that the id keeps.
    """
    require_new(docs, names)
    lines, classes = line_classes(spark, docs)
    gone = (
        lines.join(classes, "h")
        .where(~F.struct("doc_id", "_row", "line").eqNullSafe(F.col("stays")))
        .groupBy("_row", "doc_id")
        .agg(F.collect_set("line").alias("_gone"))
    )
    named = _with_row(packed(docs, "doc_id", "text"))
    gone = gone.withColumnRenamed("doc_id", "_gone_id").withColumnRenamed("_row", "_gone_row")
    same = (F.col("_row") == F.col("_gone_row")) & F.col("doc_id").eqNullSafe(F.col("_gone_id"))
    own = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size("_own") - 1), "_gone")
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("_own", i)), "\n")
    )
    rewritten = named.join(gone, same, "left").withColumn("_own", own).select(
        "doc_id",
        text.alias("text"),
        "_rest",
        F.when(F.col("text").isNull(), 0).otherwise(F.size("_own")).alias("_n"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("_g"),
    )
    return unpacked(
        rewritten, docs.columns, ("doc_id", "text"), F.col("_n").alias(names[0]), F.col("_g").alias(names[1])
    )


def without_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` after line dedup, columns unchanged; those with nothing but repeated lines go."""
    out = dedup_lines(spark, docs, ("_n_lines", "_n_removed"))
    return out.where((F.col("_n_removed") == 0) | (F.trim("text") != "")).select(*[f"`{c}`" for c in docs.columns])
