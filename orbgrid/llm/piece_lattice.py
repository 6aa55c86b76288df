"""N-best segmentation of texts into the pieces of a SentencePiece model, and decoding.

The pieces that match a text form a lattice; a segmentation's score is the
sum of its pieces' scores.  Forward Viterbi scores are the exact cost of
the rest of a backward search, so A-star over partial segmentations that
grow from the end takes complete ones from its queue best first.

No piece crosses the start of a run of spaces, nor a character that no piece
has (such as a line end).  The lattice of a text is therefore a chain of
small ones ("chunks", mostly words), whose forward scores add up.  Chunks
repeat; each worker solves one once.  For a text's N best, only the N-1 chunks that lose
least by their second-best path can differ from the best segmentation
(each of those gives a better text by itself), so the backward search runs
over the paths of these alone.

The model must have the identity normaliser and the dummy prefix, and keep
all white space; this is checked when it is read.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: What an unknown character costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0
#: Chunks a worker remembers, and the longest of them in characters.
MEMO_CHUNKS, MEMO_CHARS = 1_000_000, 64
#: Marks that end words.
_MARKS = ".,!?;:%$#&*|"
#: Ids in one output batch, about.
BATCH_IDS = 1 << 20

_RUNS = re.compile(r" *[^ \n]+| +|\n")


class PieceModel:
    """The pieces of a model and the lattices they make."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        if sp.normalize(" a  b ") != f"{SPACE}{SPACE}a{SPACE}{SPACE}b{SPACE}":
            raise ValueError("the model changes texts before it cuts them")
        n = sp.get_piece_size()
        self.unknown_id = sp.unk_id()
        self.bytes: dict[int, int] = {}
        self.text: list[bytes] = [b""] * n
        #: Piece, or the start of one, to its id (-1: no piece by itself) and score.
        self.pieces: dict[str, tuple[bytes | None, float]] = {}
        whole: dict[str, tuple[int, float]] = {}
        for k in range(n):
            piece = sp.id_to_piece(k)
            if sp.is_byte(k):
                value = int(piece[3:5], 16)
                self.bytes[value] = k
                self.text[k] = bytes([value])
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                whole[piece] = (k, sp.get_score(k))
                self.text[k] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in whole):
            raise ValueError("a piece goes on after a space or line end")
        for piece in whole:
            for end in range(1, len(piece)):
                self.pieces.setdefault(piece[:end], (None, 0.0))
        for piece, (k, score) in whole.items():
            self.pieces[piece] = (k.to_bytes(4, "little"), score)
        #: Neighbours that some piece holds together.
        self.joined = {a + b for p in whole for a, b in zip(p, p[1:], strict=False)}
        self.unknown_score = min((s for _, s in whole.values()), default=0.0) - UNKNOWN_PENALTY
        self._reset()

    def _reset(self) -> None:
        """Forget all chunks.  A number stands for one: its word, whether a space leads, ids, score, loss."""
        self._after_space: dict[str, int] = {}
        self._other: dict[str, int] = {}
        self._word: list[str] = []
        self._spaced = bytearray()
        self._ids: list[bytes] = []
        self._score, self._loss = array("d"), array("d")
        self._long: list[tuple[dict, str, int]] = []
        self._paths: dict[tuple[int, int], list[tuple[float, bytes]]] = {}

    # -- one chunk ------------------------------------------------------------------------------

    def _unknown(self, char: str) -> bytes:
        if len(self.bytes) == 256:
            return b"".join(self.bytes[b].to_bytes(4, "little") for b in char.encode("utf-8", "surrogatepass"))
        return self.unknown_id.to_bytes(4, "little")

    def edges(self, chunk: str) -> list[list[tuple[int, float, bytes]]]:
        """For each start, the pieces there: end, score, ids."""
        get, size, out = self.pieces.get, len(chunk), []
        for i in range(size):
            here = []
            for j in range(i + 1, size + 1):
                found = get(chunk[i:j])
                if found is None:
                    break
                if found[0] is not None:
                    here.append((j, found[1], found[0]))
            if not here or here[0][0] != i + 1:
                here.append((i + 1, self.unknown_score, self._unknown(chunk[i])))
            out.append(here)
        return out

    def viterbi(self, chunk: str) -> tuple[list[float], bytes, float]:
        """Forward scores of all places, ids of the best path, loss of the second best path."""
        get, size, none = self.pieces.get, len(chunk), -math.inf
        best, second = [none] * (size + 1), [none] * (size + 1)
        via: list = [None] * (size + 1)
        best[0] = 0.0
        for i in range(size):
            base, other, single = best[i], second[i], False
            for j in range(i + 1, size + 1):
                found = get(chunk[i:j])
                if found is None:
                    break
                ids, score = found
                if ids is None:
                    continue
                if j == i + 1:
                    single = True
                score += base
                if score > best[j]:
                    last = score - base + other
                    second[j] = last if last > best[j] else best[j]
                    best[j] = score
                    via[j] = i, ids
                elif score > second[j]:
                    second[j] = score
            if not single:  # an unknown character
                j, score = i + 1, base + self.unknown_score
                if score > best[j]:
                    last = other + self.unknown_score
                    second[j] = last if last > best[j] else best[j]
                    best[j] = score
                    via[j] = i, self._unknown(chunk[i])
                elif score > second[j]:
                    second[j] = score
        path, at = [], size
        while at:
            at, ids = via[at]
            path.append(ids)
        return best, b"".join(path[::-1]), best[size] - second[size]

    def paths(self, chunk: str, n: int) -> list[tuple[float, bytes]]:
        """The ``n`` best paths of a chunk as score and ids: backward A-star, forward scores as heuristic."""
        best, edges = self.viterbi(chunk)[0], self.edges(chunk)
        ending: list[list] = [[] for _ in range(len(chunk) + 1)]
        for i, here in enumerate(edges):
            for j, score, ids in here:
                ending[j].append((i, score, ids))
        queue: list = [(-best[-1], len(chunk), 0, 0.0, None)]
        out, count = [], 0
        while queue and len(out) < n:
            _, at, _, tail, link = heapq.heappop(queue)
            if not at:
                ids = []
                while link:
                    ids.append(link[0])
                    link = link[1]
                out.append((tail, b"".join(ids)))
                continue
            for i, score, piece in ending[at]:
                count += 1  # equal scores: nearer to the start first, then as found
                heapq.heappush(queue, (-(tail + score + best[i]), i, count, tail + score, (piece, link)))
        return out

    # -- whole texts ----------------------------------------------------------------------------

    def _chunk(self, word: str, spaced: bool) -> str:
        return (SPACE + word if spaced else word).replace(" ", SPACE)

    def _solved(self, word: str, spaced: bool) -> tuple[bytes, float, float]:
        """Ids, score and second-best loss of a chunk.

        Marks at its end that no piece joins to what comes before make a
        lattice of their own; the many words that differ by a comma share the rest.
        """
        stem = word.rstrip(_MARKS)
        if stem and stem != word and stem[-1] != " " and stem[-1] + word[len(stem)] not in self.joined:
            table, marks = self._after_space if spaced else self._other, word[len(stem) :]
            i, j = table.get(stem), self._other.get(marks)
            i = self._learn(stem, spaced) if i is None else i
            j = self._learn(marks, False) if j is None else j
            return self._ids[i] + self._ids[j], self._score[i] + self._score[j], min(self._loss[i], self._loss[j])
        best, ids, loss = self.viterbi(self._chunk(word, spaced))
        return ids, best[-1], loss

    def _learn(self, word: str, spaced: bool) -> int:
        ids, score, loss = self._solved(word, spaced)
        k = len(self._ids)
        self._ids.append(ids)
        self._word.append(word)
        self._spaced.append(spaced)
        self._score.append(score)
        self._loss.append(loss)
        table = self._after_space if spaced else self._other
        table[word] = k
        if len(word) > MEMO_CHARS:
            self._long.append((table, word, k))
        return k

    def _chunks(self, text: str) -> list[int]:
        """Numbers of the chunks of a text, in order."""
        spaced, other, out = self._after_space, self._other, []
        if "  " in text or text.startswith((" ", "\n")) or " \n" in text or text.endswith(" "):
            for run in _RUNS.findall(" " + text):
                table, word, lead = (spaced, run[1:], True) if run[0] == " " else (other, run, False)
                k = table.get(word)
                out.append(self._learn(word, lead) if k is None else k)
            return out
        lead = True
        for line in text.split("\n"):
            words = line.split(" ")
            if lead:
                lead = False
            else:
                k = other.get("\n")
                out.append(self._learn("\n", False) if k is None else k)
                first = words.pop(0)
                if first:
                    k = other.get(first)
                    out.append(self._learn(first, False) if k is None else k)
            got = [spaced.get(w) for w in words]
            if None in got:
                got = [self._learn(w, True) if (k := spaced.get(w)) is None else k for w in words]
            out += got
        return out

    def _alternatives(self, k: int, n: int) -> list[tuple[float, bytes]]:
        """Loss and ids of the ``n`` best paths of chunk ``k``, the best first."""
        if (k, n) not in self._paths:
            found = self.paths(self._chunk(self._word[k], bool(self._spaced[k])), n)
            # The first is the Viterbi path, also where others score the same.
            rest = [(self._score[k] - s, ids) for s, ids in found if ids != self._ids[k]]
            self._paths[k, n] = [(0.0, self._ids[k]), *rest][:n]
        return self._paths[k, n]

    def nbest(self, text: str, n: int) -> list[tuple[float, bytes]]:
        """Score and little-endian 32-bit ids of the ``n`` best segmentations, best first."""
        if not text:
            return [(0.0, b"")]
        if SPACE in text:
            text = text.replace(SPACE, " ")
        if len(self._ids) > MEMO_CHUNKS:
            self._reset()
        chunks = self._chunks(text)
        parts = [self._ids[k] for k in chunks]
        at = np.array(chunks)
        score = float(np.frombuffer(self._score)[at].sum())
        out = [(score, b"".join(parts))]
        if n > 1:
            loss = np.frombuffer(self._loss)[at]
            few = np.argpartition(loss, n - 2)[: n - 1] if len(loss) > n - 1 else np.arange(len(loss))
            few = sorted(int(p) for p in few if loss[p] < math.inf)
            queue: list = [(0.0, len(few), 0, ())]
            count = 0
            while queue and len(out) <= n:
                lost, left, _, choice = heapq.heappop(queue)
                if left:
                    for step, ids in self._alternatives(chunks[few[left - 1]], n):
                        count += 1
                        heapq.heappush(queue, (lost + step, left - 1, count, ((few[left - 1], ids), *choice)))
                    continue
                own = dict(choice)
                if all(parts[p] == ids for p, ids in choice):
                    continue  # the best one, which is there
                cut, pieces = 0, []
                for p in few:
                    pieces += [b"".join(parts[cut:p]), own[p]]
                    cut = p + 1
                out.append((score - lost, b"".join([*pieces, *parts[cut:]])))
        for table, word, k in self._long:  # not worth their memory
            del table[word]
            self._ids[k] = self._word[k] = None
            self._paths.pop((k, n), None)
        self._long = []
        return out[:n]

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids; byte pieces that aren't UTF-8 become U+FFFD."""
        raw = b"".join([self.text[k] for k in np.frombuffer(ids, "<u4").tolist()])
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def _model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _encoder(path: str, n: int, arrays: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            docs = batch.column("_id")
            for k in range(batch.num_rows):
                text = batch.column("_text")[k].as_py() or ""
                found = model.nbest(text, n)
                best = found[0][1]
                rows.append(
                    (
                        docs[k].as_py(), len(best) // 4, found[0][0], zlib.crc32(best), model.decode(best) == text,
                        [s for s, _ in found], [zlib.crc32(ids) for _, ids in found],
                        np.frombuffer(best, "<i4") if arrays else None,
                    )
                )
                size += len(best) // 4 if arrays else 16
                if size > BATCH_IDS:
                    yield _rows(rows, docs.type, arrays)
                    rows, size = [], 0
        if rows:
            yield _rows(rows, docs.type, arrays)

    return run


def _rows(rows: list[tuple], id_type: pa.DataType, arrays: bool) -> pa.RecordBatch:
    types = [id_type, pa.int64(), pa.float64(), pa.int64(), pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.int64())]
    names = ["doc_id", "n_pieces", "score", "ids_crc32", "round_trip", "scores", "crc32s"]
    columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
    if arrays:
        ends = np.cumsum([0, *(len(r[7]) for r in rows)])
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([r[7] for r in rows]))))
        names.append("ids")
    return pa.RecordBatch.from_arrays(columns, names)


def encode_pieces(
    docs: DataFrame, model: str, nbest: int = 4, ids: bool = True, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the best segmentation and the scores of up to ``nbest``.

    doc_id, n_pieces, score and ids_crc32 of the best; round_trip (its decoded
    ids give the text); scores and crc32s of the N best, best first (fewer
    where a text has fewer segmentations; at equal score, paths that
    differ earlier in the text come in the order they are found, which is the same each run); and ``ids``.
    Null texts count as empty: no pieces, score 0, one (empty) segmentation.
    Texts with U+2581 come back with spaces in their place.  No shuffle; memory is
    one text, its ids and a bounded set of known chunks.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ddl = f"doc_id {kind}, n_pieces bigint, score double, ids_crc32 bigint, round_trip boolean, "
    ddl += "scores array<double>, crc32s array<bigint>" + ", ids array<int>" * ids
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        _encoder(model, nbest, ids), ddl
    )


def decode_pieces(rows: DataFrame, model: str, ids_col: str = "ids", to: str = "text") -> DataFrame:
    """``rows`` with the text of their ids; null ids give null."""

    @F.pandas_udf("string")
    def decoded(ids):
        get = _model(model)
        return ids.map(lambda x: None if x is None else get.decode(np.asarray(x, "<u4").tobytes()))

    return rows.withColumn(to, decoded(F.col(ids_col)))
