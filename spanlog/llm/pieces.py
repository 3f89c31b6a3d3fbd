"""SentencePiece encoding and decoding with N-best segmentation (operator 5).

The pieces of a public model form a lattice over the text (a space becomes U+2581, one is put in front). Forward Viterbi gives
every position its best score; these scores are exact heuristics for an A-star search that walks the lattice backward, so
complete segmentations leave the queue in order of their scores. Scores are integers (millionths of a nat), so sums are exact.

No piece holds U+2581 after another character, so the lattice falls apart into independent chunks (a word with its spaces).
Different chunks are segmented once a task, but for rare ones that its cache has dropped: those of equal length together by a
numpy Viterbi of the two best, which also gives the gap between them. A text's N best segmentations change only chunks with the
N - 1 smallest gaps; these chunks' own N best come from the A-star search, and a second A-star search combines them.

A BPE model's scores are merge ranks, not log-probabilities; with ``scoring="zipf"`` (the default for such models) the piece of
rank r weighs 1/(r+2). Characters outside the vocabulary become UTF-8 byte pieces, each below every other piece.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 3
UNIT = 1_000_000
SPACE = "▁"
LONG = 48  # chunks longer than this are segmented one by one
CACHE = 250_000  # different chunks kept by a task
_LOW = -(1 << 60)


@dataclass
class Lexicon:
    """What encoding needs of a model; small (tens of thousands of pieces)."""
    score: dict[str, int]
    number: dict[str, int]
    raw: list[bytes]
    byte: list[int]  # number of each byte piece
    byte_score: int
    longest: int
    pattern: re.Pattern
    by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # sorted hashes of the pieces, scores, numbers


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def _hash(text: str) -> int:
    h = 0
    for c in text:
        h = (h * _MULTIPLIER + ord(c) + 1) & (1 << 64) - 1
    return h


def load(path: str = MODEL, scoring: str = "zipf") -> Lexicon:
    """Read the pieces and scores of a SentencePiece model file; ``scoring`` is "zipf" or "model"."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte, raw, plain = [0] * 256, [b""] * n, []
    for i in range(n):
        if sp.is_byte(i):
            byte[int(sp.id_to_piece(i)[1:-1], 16)] = i
            raw[i] = bytes([int(sp.id_to_piece(i)[1:-1], 16)])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            raw[i] = sp.id_to_piece(i).encode()
            plain.append(i)
    if scoring == "zipf":
        plain.sort(key=lambda i: (-sp.get_score(i), i))
        score = {sp.id_to_piece(i): -round(UNIT * float(np.log(r + 2))) for r, i in enumerate(plain)}
    else:
        score = {sp.id_to_piece(i): round(UNIT * sp.get_score(i)) for i in plain}
    number = {sp.id_to_piece(i): i for i in plain}
    if any(SPACE in p.lstrip(SPACE) for p in score):
        raise ValueError("a piece crosses a space; the lattice cannot be cut at spaces")
    apart = "" if any("\n" in p for p in score if len(p) > 1) else "\n"
    pattern = re.compile(f"{SPACE}*[^{SPACE}{apart}]+|{SPACE}+" + (f"|{apart}" if apart else ""))
    by_length = {}
    for length in sorted({len(p) for p in score}):
        names = sorted((p for p in score if len(p) == length), key=_hash)
        keys = np.array([_hash(p) for p in names], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("hash collision among pieces")
        by_length[length] = (keys, np.array([score[p] for p in names], np.int64), np.array([number[p] for p in names], np.int64))
    return Lexicon(score, number, raw, byte, min(score.values()) - 10 * UNIT, max(by_length), pattern, by_length)


def edges(chunk: str, lex: Lexicon) -> list[list[tuple[int, int]]]:
    """Per end position, the (start, score) of the pieces that end there, longest first."""
    out: list[list[tuple[int, int]]] = [[]]
    for e in range(1, len(chunk) + 1):
        own = [(s, lex.score[chunk[s:e]]) for s in range(max(0, e - lex.longest), e) if chunk[s:e] in lex.score]
        if not own or own[-1][0] != e - 1:
            own.append((e - 1, lex.byte_score * len(chunk[e - 1].encode())))
        out.append(own)
    return out


def forward(lattice: list[list[tuple[int, int]]]) -> list[int]:
    best = [0]
    for own in lattice[1:]:
        best.append(max(best[s] + w for s, w in own))
    return best


def nbest(lattice: list[list[tuple[int, int]]], n: int) -> list[tuple[int, list[int]]]:
    """The n best (score, piece ends) by A-star from the end to the start; equal scores in a fixed order."""
    best = forward(lattice)
    end, out = len(lattice) - 1, []
    queue = [(-best[end], end, 0, ())]
    while queue and len(out) < n:
        _, at, done, path = heapq.heappop(queue)
        if at == 0:
            ends = []
            while path:
                ends.append(path[0])
                path = path[1]
            out.append((done, ends))
            continue
        for s, w in lattice[at]:
            heapq.heappush(queue, (-(best[s] + w + done), s, done + w, (at, path)))
    return out


def numbers(chunk: str, ends: list[int], lex: Lexicon) -> list[int]:
    out, s = [], 0
    for e in ends:
        piece = chunk[s:e]
        if piece in lex.number:
            out.append(lex.number[piece])
        else:
            out += [lex.byte[b] for b in piece.encode()]
        s = e
    return out


def _equal_length(chunks: list[str], lex: Lexicon) -> list[tuple[int, int, list[int]]]:
    """(score, gap to the second best or -1 if there is none, numbers) of chunks of one length, by a joint Viterbi."""
    m, length = len(chunks), len(chunks[0])
    codes = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).reshape(m, length).astype(np.uint64)
    spread = np.uint64(_MULTIPLIER)
    width = min(length, lex.longest)
    arcs: list[list[tuple]] = [[] for _ in range(length + 1)]  # by end: (piece length, rows or None for all, scores, numbers)
    h = np.zeros((m, length), np.uint64)  # hash of the piece of the current length that starts at each position
    for p in range(1, width + 1):
        h = h[:, :length - p + 1] * spread + codes[:, p - 1:] + np.uint64(1)
        if p not in lex.by_length and p > 1:
            continue
        keys, scores, names = lex.by_length[p]
        flat = h.T.ravel()
        at = np.searchsorted(keys, flat)
        at[at == len(keys)] = 0
        hit = (keys[at] == flat).reshape(length - p + 1, m)
        at = at.reshape(length - p + 1, m)
        for s in range(length - p + 1):
            if p == 1:  # every character has an arc: its piece, or its bytes
                c = codes[:, s].astype(np.int64)
                size = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
                arcs[s + p].append((p, None, np.where(hit[s], scores[at[s]], lex.byte_score * size), np.where(hit[s], names[at[s]], -2 - c)))
            else:
                rows = np.nonzero(hit[s])[0]
                if len(rows):
                    arcs[s + p].append((p, rows, scores[at[s, rows]], names[at[s, rows]]))
    best = np.full((length + 1, m), _LOW, np.int64)
    second = np.full((length + 1, m), _LOW, np.int64)
    back = np.zeros((length + 1, m), np.int64)
    name = np.zeros((length + 1, m), np.int64)
    best[0] = 0
    for e in range(1, length + 1):
        for p, rows, w, ids in reversed(arcs[e]):  # the longest piece wins a tie
            r = slice(None) if rows is None else rows
            own, first, next_ = best[e][r], best[e - p][r] + w, second[e - p][r] + w
            better = first > own
            second[e, r] = np.where(better, np.maximum(own, next_), np.maximum(second[e][r], first))
            best[e, r] = np.maximum(own, first)
            back[e, r] = np.where(better, p, back[e][r])
            name[e, r] = np.where(better, ids, name[e][r])
    rows = np.arange(m)
    on = np.zeros((length + 1, m), bool)
    at = np.full(m, length)
    while (live := at > 0).any():
        r = rows[live]
        e = at[live]
        on[e, r] = True
        at[live] = e - back[e, r]
    flat = name.T[on.T].tolist()
    ends = np.cumsum(on.sum(axis=0)).tolist()
    gap = np.where(second[length] > _LOW // 2, best[length] - second[length], -1)
    odd = np.zeros(m, bool)
    np.logical_or.at(odd, np.repeat(rows, on.sum(axis=0)), np.array(flat) < 0)
    out, last = [], 0
    for b, g, end, strange in zip(best[length].tolist(), gap.tolist(), ends, odd.tolist(), strict=True):
        ids = flat[last:end]
        last = end
        if strange:
            ids = [x for v in ids for x in ([v] if v >= 0 else [lex.byte[y] for y in chr(-2 - v).encode()])]
        out.append((b, g, ids))
    return out


def segment(chunks: list[str], lex: Lexicon) -> list[tuple[int, int, list[int]]]:
    """(score, gap, numbers) of each chunk's best segmentation."""
    out: list = [None] * len(chunks)
    by: dict[int, list[int]] = {}
    for i, c in enumerate(chunks):
        by.setdefault(len(c), []).append(i)
    for length, group in by.items():
        if length > LONG:
            for i in group:
                two = nbest(edges(chunks[i], lex), 2)
                out[i] = (two[0][0], two[0][0] - two[1][0] if len(two) > 1 else -1, numbers(chunks[i], two[0][1], lex))
            continue
        for at in range(0, len(group), 8192):
            part = group[at:at + 8192]
            for i, v in zip(part, _equal_length([chunks[j] for j in part], lex), strict=True):
                out[i] = v
    return out


class _Numbered(dict):
    """Numbers new keys as they are looked up."""
    def __missing__(self, key):
        self[key] = v = len(self)
        return v


class Encoder:
    """Encodes texts one after another and keeps the segmentations of the chunks seen; of more than ``cache`` the most used half stay."""

    def __init__(self, lex: Lexicon, n: int = NBEST, cache: int = CACHE):
        self.lex, self.n, self.cache = lex, n, cache
        self._clear()

    def _clear(self) -> None:
        self.index, self.names, self.score, self.gap = _Numbered(), [], np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.start, self.more, self.uses = np.empty(0, np.int32), np.zeros(1, np.int64), {}, np.empty(0, np.int64)

    def _shrink(self) -> None:
        stay = np.sort(np.argsort(-self.uses, kind="stable")[:self.cache // 2])
        size = self.start[stay + 1] - self.start[stay]
        ends = np.cumsum(size)
        self.flat = self.flat[np.arange(ends[-1]) + np.repeat(self.start[stay] - ends + size, size)] if len(stay) else self.flat[:0]
        self.start = np.concatenate([[0], ends])
        self.score, self.gap, self.uses, self.more = self.score[stay], self.gap[stay], self.uses[stay] // 2, {}
        self.names = [self.names[i] for i in stay.tolist()]
        self.index = _Numbered(zip(self.names, range(len(self.names)), strict=True))

    def _learn(self, known: int) -> None:
        fresh = list(self.index)[known:] if known else list(self.index)
        got = segment(fresh, self.lex)
        self.names += fresh
        self.score = np.concatenate([self.score, np.array([g[0] for g in got], np.int64)])
        gap = np.array([g[1] for g in got], np.int64)
        self.gap = np.concatenate([self.gap, np.where(gap < 0, np.iinfo(np.int64).max, gap)])
        lengths = np.array([len(g[2]) for g in got], np.int64)
        self.flat = np.concatenate([self.flat, np.array([x for g in got for x in g[2]], np.int32)])
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])

    def _variants(self, c: int) -> list[tuple[int, list[int]]]:
        """(loss against the best, numbers) of a chunk's n best segmentations."""
        if c not in self.more:
            name = self.names[c]
            found = nbest(edges(name, self.lex), self.n)
            best = self.flat[self.start[c]:self.start[c + 1]].tolist()
            others = [(found[0][0] - s, numbers(name, ends, self.lex)) for s, ends in found]
            others = [v for v in others if v[1] != best]  # on a tie the search may list the best one later
            self.more[c] = [(0, best), *others][:self.n]
        return self.more[c]

    def _combine(self, chunks: list[int]) -> list[tuple[int, list[int]]]:
        """The n best (loss, variant per chunk): A-star over the chunks; what is left always takes its best, at no loss."""
        queue, out = [(0, 0, ())], []
        while queue and len(out) < self.n:
            loss, depth, picks = heapq.heappop(queue)
            if depth == -len(chunks):
                out.append((loss, list(picks)))
                continue
            for v, (more, _) in enumerate(self._variants(chunks[-depth])):
                heapq.heappush(queue, (loss + more, depth - 1, (*picks, v)))
        return out

    def encode(self, texts: list[str]) -> list[list[tuple[int, np.ndarray]]]:
        """Per text its n best (score, numbers), best first; an empty text has one segmentation, the empty one."""
        if len(self.index) > self.cache:
            self._shrink()
        known, find = len(self.index), self.index.__getitem__
        rows = [np.array(list(map(find, self.lex.pattern.findall(SPACE + t.replace(" ", SPACE)))), np.int64) if t else np.empty(0, np.int64)
                for t in texts]
        if len(self.index) > known:
            self._learn(known)
        self.uses = np.concatenate([self.uses, np.zeros(len(self.index) - len(self.uses), np.int64)])
        if rows:
            self.uses += np.bincount(np.concatenate(rows), minlength=len(self.uses))
        out = []
        for row in rows:
            if not len(row):
                out.append([(0, np.empty(0, np.int32))])
                continue
            score = int(self.score[row].sum())
            size = self.start[row + 1] - self.start[row]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(self.start[row] - ends + size, size)
            ids = self.flat[at]
            gaps = self.gap[row]
            few = min(self.n - 1, len(row))
            chosen = np.empty(0, np.int64)
            if few:
                chosen = np.sort(np.argpartition(gaps, few - 1)[:few]) if few < len(row) else np.arange(len(row))
                edge = gaps[chosen].max()  # ties at the edge: the first occurrences count
                below, same = np.nonzero(gaps < edge)[0], np.nonzero(gaps == edge)[0]
                chosen = np.sort(np.concatenate([below, same[:few - len(below)]]))
            result = [(score, ids)]
            for loss, picks in self._combine([int(row[c]) for c in chosen])[1:]:
                parts, last = [], 0
                for c, v in zip(chosen, picks, strict=True):
                    if v:
                        parts += [ids[last:ends[c] - size[c]], np.array(self._variants(int(row[c]))[v][1], np.int32)]
                        last = ends[c]
                result.append((score - loss, np.concatenate([*parts, ids[last:]])))
            out.append(result)
        return out


def decode_ids(ids: list[int], lex: Lexicon) -> str:
    """The text of piece numbers; bytes that are no UTF-8 become U+FFFD, numbers outside the model nothing."""
    if ids and not (0 <= min(ids) and max(ids) < len(lex.raw)):
        ids = [i for i in ids if 0 <= i < len(lex.raw)]
    text = b"".join(map(lex.raw.__getitem__, ids)).decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def encode(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text", model: str = MODEL, scoring: str = "zipf",
           n: int = NBEST, digests: bool = False) -> DataFrame:
    """The columns ``keep`` of every row and ``pieces``: its n best segmentations, best first, as (score, ids).

    With ``digests`` the ids come as (score, n_pieces, sha256 of the ids as little-endian 32-bit numbers), and ``exact`` tells
    whether the best one decodes to the text. A null text has null pieces, an empty one a single empty segmentation; a text with fewer than n
    segmentations has all of them; equal scores come in a fixed order. Repeated rows give repeated results; an empty table an
    empty result; columns outside ``keep`` are ignored, and a kept column named like a result is replaced. The model file is
    read once by the driver and broadcast (its size does not depend on the data).
    """
    keep = tuple(c for c in keep if c not in ("pieces", "exact"))
    src = df.select(*[F.col(c) for c in keep], F.col(text_col).cast("string").alias("_text"))
    one = "struct<score:long,n_pieces:int,sha256:string>" if digests else "struct<score:long,ids:array<int>>"
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.dtypes[:-1]), f"pieces array<{one}>", *["exact boolean"] * digests])
    shared = df.sparkSession.sparkContext.broadcast(load(model, scoring))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = shared.value
        encoder = Encoder(lex, n)
        for batch in batches:
            for part in text_slices(batch, "_text", 2 << 20):
                texts = part.column("_text").to_pylist()
                found = encoder.encode([t or "" for t in texts])
                sizes = [len(f) if t is not None else 0 for t, f in zip(texts, found, strict=True)]
                flat = [(t, *v) for t, f in zip(texts, found, strict=True) if t is not None for v in f]
                scores = pa.array([s for _, s, _ in flat], pa.int64())
                if digests:
                    fields = {"score": scores, "n_pieces": pa.array([len(i) for _, _, i in flat], pa.int32()),
                              "sha256": pa.array([hashlib.sha256(i.astype("<i4").tobytes()).hexdigest() for _, _, i in flat], pa.string())}
                else:
                    ends = np.cumsum([0, *(len(i) for _, _, i in flat)])
                    ids = np.concatenate([np.empty(0, np.int32), *(i for _, _, i in flat)])
                    fields = {"score": scores, "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))}
                each = pa.StructArray.from_arrays(list(fields.values()), list(fields))
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                null = pa.array([None if t is None else int(o) for t, o in zip(texts, offsets[:-1], strict=True)] + [int(offsets[-1])], pa.int32())
                arrays = [*[part.column(i) for i in range(part.num_columns - 1)], pa.ListArray.from_arrays(null, each)]
                if digests:
                    arrays.append(pa.array([None if t is None else decode_ids(f[0][1].tolist(), lex) == t
                                            for t, f in zip(texts, found, strict=True)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(arrays, [*part.schema.names[:-1], "pieces", *["exact"] * digests])
    return src.mapInArrow(run, schema)


def decode(df: DataFrame, ids_col: str, keep: tuple[str, ...] = (), model: str = MODEL) -> DataFrame:
    """The columns ``keep`` and ``text``: what the piece numbers in ``ids_col`` stand for (null for null)."""
    keep = tuple(c for c in keep if c != "text")
    src = df.select(*[F.col(c) for c in keep], F.col(ids_col).cast("array<int>").alias("_ids"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.dtypes[:-1]), "text string"])
    shared = df.sparkSession.sparkContext.broadcast(load(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = [None if v is None else decode_ids([i for i in v if i is not None], shared.value) for v in part.column("_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[part.column(i) for i in range(part.num_columns - 1)], pa.array(texts, pa.string())],
                                             [*part.schema.names[:-1], "text"])
    return src.mapInArrow(run, schema)
