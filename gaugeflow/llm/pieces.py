"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A merge agenda takes the best-scored pair of neighbouring pieces (leftmost of equals) until none is
left. Each candidate merge is skipped when a hash keyed by the seed, the document's id and the
candidate's place in the document falls below ``dropout``. So every occurrence of a word is drawn
anew, equal documents of different ids are segmented differently, and any executor that repeats a
task repeats its segmentation. With ``dropout`` 0 the result is the library's own.

No piece goes on past a space that follows another character, so a text is encoded in chunks that
begin at spaces, at characters that are in no longer piece and at those that need byte pieces. All
distinct chunks of a batch run their agendas without dropout, in step as rows of arrays; very long
chunks use a heap. An occurrence shares that result only if none of the candidates it offered is
skipped there; every other occurrence runs its own agenda.

Decoding joins the bytes of the pieces and is lossless for any text: the sign that stands for a
space in pieces is written as byte pieces where a text holds it itself.

Defined cases: a null text encodes like an empty one, to the one piece of the leading space; a null
doc_id is the smallest id; rows that repeat a doc_id are encoded each.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gaugeflow.llm.common import id_and_text, id_of, mix, run_hashes, slices

MARK = "▁"
DROPOUT = 0.1
LONGEST = 64  # characters of a chunk that still runs in step
ROWS = 1 << 14  # agendas in step at once
DRAWS = 1 << 16  # candidates drawn at once
SPREAD = np.uint64(0x9E3779B97F4A7C15)
PLACE = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


class Model:
    """Pieces, scores and merges of a BPE model with byte pieces, as arrays."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(self.size)]
        normal = {n: i for i, n in enumerate(names) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        raw = [bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace(MARK, " ").encode() if n in normal and normal[n] == i else b""
               for i, n in enumerate(names)]
        if any(MARK in n.lstrip(MARK) for n in normal):
            raise ValueError("a piece goes on past a space")
        self.scores = np.array([sp.get_score(i) for i in range(self.size)] + [-np.inf], np.float32)  # the last one is that of no piece
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.ends = np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        self.byte_ids = np.zeros(256, np.int32)
        for i, n in enumerate(names):
            if sp.is_byte(i):
                self.byte_ids[int(n[3:5], 16)] = i
        self.char_ids = np.full(0x110000, -1, np.int32)
        joins = set()
        for n, i in normal.items():
            if len(n) == 1:
                self.char_ids[ord(n)] = i
            else:
                joins.update(n)
        self.char_ids[ord(" ")], self.char_ids[ord(MARK)] = normal[MARK], -1
        self.joins = np.zeros(0x110000, bool)
        self.joins[[ord(c) for c in joins]] = True
        self.joins[ord(" ")], self.joins[ord(MARK)] = True, False
        merges = {}
        for n, i in normal.items():
            for k in range(1, len(n)):
                if n[:k] in normal and n[k:] in normal:
                    merges[normal[n[:k]] * self.size + normal[n[k:]]] = i
        self.keys, self.merged = _placed(np.array(list(merges), np.int64), np.array(list(merges.values()), np.int32))

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece that two pieces make, or -1."""
        key = left.astype(np.int64) * self.size + right
        key[(left < 0) | (right < 0)] = -2
        out = np.full(key.shape, -1, np.int32)
        at, slot = np.arange(len(key)), _slot(key, len(self.keys))
        while len(at):
            found = self.keys[slot]
            same = found == key
            out[at[same]] = self.merged[slot[same]]
            more = np.flatnonzero(~same & (found != -1))  # a free slot ends a search
            at, key, slot = at[more], key[more], (slot[more] + 1) & (len(self.keys) - 1)
        return out


def _slot(key: np.ndarray, slots: int) -> np.ndarray:
    return ((key.astype(np.uint64) * SPREAD) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _placed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open-addressed table of merges; at least three in four of its slots are free."""
    slots, rounds = 1 << (4 * len(keys) + 1).bit_length(), 0
    table, held = np.full(slots, -1, np.int64), np.full(slots, -1, np.int32)
    left, home = np.arange(len(keys)), _slot(keys, slots)
    while len(left):
        at = (home[left] + rounds) & (slots - 1)
        free = table[at] == -1
        _, first = np.unique(at, return_index=True)
        lead = np.zeros(len(at), bool)
        lead[first] = True
        put = free & lead
        table[at[put]], held[at[put]] = keys[left[put]], values[left[put]]
        left, rounds = left[~put], rounds + 1
    return table, held


def _place(start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
    return sum(x.astype(np.uint64) * m for x, m in zip((start, middle, end), PLACE))


class Encoder:
    def __init__(self, model: Model, seed: int = 0, dropout: float = DROPOUT):
        self.model, self.seed, self.dropout = model, seed, dropout

    def _skipped(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._below(key ^ _place(start, middle, end))

    def _below(self, drawn: np.ndarray) -> np.ndarray:
        return mix(drawn) >> np.uint64(11) < np.uint64(math.ceil(self.dropout * 2.0 ** 53))

    def _candidates(self, key, left, right, start, middle, end) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and score of pairs; -1 and -inf where there is none or it is skipped."""
        piece = self.model.pair(left, right)
        if self.dropout:
            found = np.flatnonzero(piece >= 0)
            piece[found[self._skipped(key[found], start[found], middle[found], end[found])]] = -1
        return piece, self.model.scores[piece]

    def _in_step(self, pieces: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Agendas of chunks of similar length: rows of pieces, -1 behind the end. Pieces and their number.

        A piece stays where its first character is and knows where the next and the last one begin,
        so a merge touches a few cells of its row.
        """
        rows, width = pieces.shape
        column = np.arange(width, dtype=np.int32)
        held, last = pieces.ravel().copy(), lengths.astype(np.int32)
        after, before = np.tile(column + 1, rows), np.tile(column - 1, rows)
        merged, score = np.full(rows * width, -1, np.int32), np.full((rows, width), -np.inf, np.float32)
        flat = score.ravel()
        lost = np.zeros(rows * width, bool)

        def offer(row: np.ndarray, left: np.ndarray, middle: np.ndarray, end: np.ndarray) -> None:
            at = row * width
            a = at + left
            merged[a], flat[a] = self._candidates(keys[row], held[a], held[at + middle], left, middle, end)

        row, left = np.nonzero(column + 1 < last[:, None])
        left = left.astype(np.int32)
        offer(row, left, left + 1, left + 2)
        row = np.arange(rows)
        while len(row):
            left = (score if len(row) == rows else score.take(row, axis=0)).argmax(axis=1).astype(np.int32)
            a = row * width + left
            alive = flat[a] > -np.inf
            if not alive.all():
                row, left, a = row[alive], left[alive], a[alive]
            start = a - left
            b = start + after[a]
            end = after[b]
            held[a], after[a] = merged[a], end
            lost[b], flat[b], flat[a] = True, -np.inf, -np.inf
            on = np.flatnonzero(end < last[row])
            e = start[on] + end[on]
            before[e] = left[on]
            offer(row[on], left[on], end[on], after[e])
            on = np.flatnonzero(left)
            offer(row[on], before[a[on]], left[on], end[on])
        left_over = (column < last[:, None]) & ~lost.reshape(rows, width)
        n = left_over.sum(axis=1)
        result = np.full((rows, width), -1, pieces.dtype)
        result[column < n[:, None]] = held[left_over.ravel()]
        return result, n

    def _by_heap(self, pieces: np.ndarray, key: np.uint64) -> np.ndarray:
        """The same agenda for one long chunk: each merge costs the logarithm of its length."""
        n = len(pieces)
        held, after, before = list(pieces), list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []

        def offer(lefts: list[int]) -> None:
            lefts = [a for a in lefts if a >= 0 and after[a] < n]
            if not lefts:
                return
            a = np.array(lefts)
            b = np.array([after[x] for x in lefts])
            e = np.array([after[x] for x in b])
            piece, score = self._candidates(np.full(len(a), key, np.uint64), np.array([held[x] for x in a]), np.array([held[x] for x in b]), a, b, e)
            for i in np.flatnonzero(piece >= 0):
                heapq.heappush(agenda, (-score[i], int(a[i]), int(b[i]), int(e[i]), int(piece[i])))

        offer(list(range(n)))
        while agenda:
            _, a, b, e, piece = heapq.heappop(agenda)
            if held[a] is None or after[a] != b or b >= n or held[b] is None or after[b] != e:
                continue
            held[a], held[b], after[a] = piece, None, e
            if e < n:
                before[e] = a
            offer([before[a], a])
        return np.array([x for x in held if x is not None], np.int32)

    def _agendas(self, pieces: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Final pieces of chunks in a row, and where each chunk's begin and their number."""
        n, offset, flat, total = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), [np.zeros(0, np.int32)], 0
        low = 0
        for high in (1, 3, 4, 6, 8, 10, 12, 16, 24, 32, 48, LONGEST):
            fitting = np.flatnonzero((sizes > low) & (sizes <= high))
            low = high
            for some in (fitting[i:i + ROWS] for i in range(0, len(fitting), ROWS)):
                column = np.arange(high)
                rows = np.where(column < sizes[some, None], pieces[np.minimum(starts[some, None] + column, len(pieces) - 1)], -1)
                if high == 1:
                    count = np.ones(len(some), np.int64)
                else:
                    rows, count = self._in_step(rows, sizes[some], keys[some])
                mask = column < count[:, None]
                offset[some] = total + np.concatenate(([0], np.cumsum(count[:-1])))
                n[some] = count
                flat.append(rows[mask])
                total += int(count.sum())
        for i in np.flatnonzero(sizes > LONGEST):
            found = self._by_heap(pieces[starts[i]:starts[i] + sizes[i]], keys[i])
            offset[i], n[i] = total, len(found)
            flat.append(found)
            total += len(found)
        return np.concatenate(flat), offset, n

    def _drawn(self, of: np.ndarray, keys: np.ndarray, offered: list[np.ndarray]) -> np.ndarray:
        """Occurrences (chunk, key) that skip a candidate which their chunk offers without dropout."""
        chunk, *places = offered
        order = np.argsort(chunk)
        places = _place(*places)[order] if len(chunk) else np.zeros(0, np.uint64)
        ends = np.searchsorted(chunk[order], np.arange(int(of.max()) + 1), side="right") if len(of) else np.zeros(0, np.int64)
        begins = np.concatenate(([0], ends[:-1]))
        n = (ends - begins)[of]
        upto = np.cumsum(n)
        own, first = np.zeros(len(of), bool), 0
        while first < len(of):
            done = upto[first - 1] if first else 0
            last = max(int(np.searchsorted(upto, done + DRAWS, side="right")), first + 1)
            k = n[first:last]
            at = np.arange(k.sum()) + np.repeat(begins[of[first:last]] + done + k - upto[first:last], k)
            skipped = np.flatnonzero(self._below(np.repeat(keys[first:last], k) ^ places[at]))
            own[np.searchsorted(upto, done + skipped, side="right")] = True
            first = last
        return np.flatnonzero(own)

    def encode(self, texts: list[str], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and where each text's begin."""
        model = self.model
        lengths = np.array([len(t) + 1 for t in texts], np.int64)
        chars = np.frombuffer("".join(" " + t for t in texts).encode("utf-32-le"), np.uint32)
        first = np.concatenate(([0], np.cumsum(lengths)))
        pieces, space = model.char_ids[chars], chars == 32
        alone = (pieces < 0) | ~model.joins[chars]
        begin = np.zeros(len(chars), bool)
        begin[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        begin[first[:-1]] = True
        starts = np.flatnonzero(begin)
        sizes = np.diff(np.concatenate((starts, [len(chars)])))
        text = np.searchsorted(first, starts, side="right") - 1
        _, at, of = np.unique(run_hashes(mix(chars.astype(np.uint64)), starts, starts + sizes), return_index=True, return_inverse=True)
        plain = Offers(model)
        flat, offset, n = plain._agendas(pieces, starts[at], sizes[at], np.arange(len(at), dtype=np.uint64))
        extra = [flat]
        total = len(flat)
        for i in np.flatnonzero((sizes[at] == 1) & (pieces[starts[at]] < 0)):
            found = model.byte_ids[list(chr(chars[starts[at[i]]]).encode())]
            offset[i], n[i] = total, len(found)
            extra.append(found)
            total += len(found)
        offset, n = offset[of], n[of]
        if self.dropout:
            seed = mix(np.array([self.seed], np.uint64) + SPREAD)
            keys = mix(mix(ids.view(np.uint64) ^ seed)[text] + (starts - first[text]).astype(np.uint64) * SPREAD)
            own = self._drawn(of, keys, plain.offered())
            flat, offset[own], n[own] = self._agendas(pieces, starts[own], sizes[own], keys[own])
            offset[own] += total
            extra.append(flat)
        flat = np.concatenate(extra)
        ends = np.cumsum(n)
        order = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n - offset, n)
        bounds = np.concatenate(([0], ends))[np.searchsorted(text, np.arange(len(texts) + 1))]
        return flat[order].astype(np.int32), bounds


class Offers(Encoder):
    """Agendas without dropout that note every candidate offered; a chunk's key is its number."""

    def __init__(self, model: Model):
        super().__init__(model, dropout=1.0)
        self.noted = []

    def _skipped(self, key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        self.noted.append([x.astype(np.int64) for x in (key, start, middle, end)])
        return np.zeros(len(key), bool)

    def offered(self) -> list[np.ndarray]:
        return [np.concatenate(x) for x in zip(*self.noted)] if self.noted else [np.zeros(0, np.int64)] * 4


def decode(model: Model, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Bytes of all texts in a row, each still behind its leading space, and where each begins."""
    size = (model.ends[1:] - model.ends[:-1])[ids]
    ends = np.concatenate(([0], np.cumsum(size)))
    order = np.arange(ends[-1]) - np.repeat(ends[:-1] - model.ends[:-1][ids], size)
    return model.blob[order].tobytes(), ends[bounds]


def encode_documents(docs: DataFrame, model_path: str, seed: int = 0, dropout: float = DROPOUT,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ids, n_tokens, ids_sha256 (little-endian 32-bit ids), lossless."""
    shared = docs.sparkSession.sparkContext.broadcast(Encoder(Model(model_path), seed, dropout))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared.value
        for batch, data, offsets in slices(batches):
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(offsets[:-1], offsets[1:])]
            ids, bounds = encoder.encode(texts, batch.column(0).to_numpy(zero_copy_only=False))
            back, at = decode(encoder.model, ids, bounds)
            same = [back[at[i] + 1:at[i + 1]] == raw[offsets[i]:offsets[i + 1]] for i in range(len(texts))]
            sha = [hashlib.sha256(ids[a:b].astype("<i4").tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)),
                 pa.array(np.diff(bounds)), pa.array(sha, pa.string()), pa.array(same, pa.bool_())],
                names=["_id", "ids", "n_tokens", "ids_sha256", "lossless"])

    out = id_and_text(docs, id_col, text_col).mapInArrow(run, "_id long, ids array<int>, n_tokens long, ids_sha256 string, lossless boolean")
    return out.select(id_of("_id").alias(id_col), "ids", "n_tokens", "ids_sha256", "lossless")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op6_pieces(spark, sf_dir: str) -> DataFrame:
    return encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_model())
