"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is normalised by the vocabulary's own rules and cut into characters.  An agenda
holds every adjacent pair whose concatenation is a piece, best score first and leftmost
first among equals; the best pair is merged and the two pairs it makes with its
neighbours are pushed, until the agenda is empty.  Characters that are no piece become
byte pieces (the unknown id where the vocabulary has none).

Two characters that stand side by side in no piece can never be merged, so texts are cut
there and the chunks encoded apart.  Chunks are kept in a bounded table of the worker, of
which the part used longest ago goes.  They are found there by a digest of their characters
and then compared character by character; one that isn't what its digest found is encoded
by itself.  The new short chunks of a batch run their agendas side by side in arrays, each
round merging the best pair of every chunk; long chunks run one heap each, in n log n steps
for n characters.

Each Arrow batch is then encoded and decoded by the sentencepiece library as well, and
``agrees`` says for each text whether both results are the same.  One scan, no shuffle: a
lost task is done again by itself.  Memory: a batch of ``ROWS`` texts and the table.

Edge cases: null is the empty text, which has the end id alone and decodes to ''.  Repeated
rows are encoded each; other columns pass through (an ``ids``, ``decoded`` or ``agrees`` of
the input is replaced).  Special pieces' strings in a text (``</s>``) are ordinary text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MARK = "▁"
#: Texts encoded at once; chunks kept by a worker (twice); characters of the longest chunk in arrays.
ROWS, KEPT, SHORT = 128, 300_000, 64
#: Characters that are told apart when texts are cut; the rank of what doesn't merge, as a key.
CLASSES, LAST, NONE = 255, 1 << 30, 1 << 62
#: Powers of the digests: their base, and after how many characters of a batch they start again.
BASE, PERIOD = 0x9E3779B97F4A7C15, 1 << 20


def _each_byte(e: UnicodeError) -> tuple[str, int]:
    return "�", e.start + 1


codecs.register_error("sillage.each_byte", _each_byte)


def _powers(base: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(PERIOD - 1, base, np.uint64)))


def _spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of spans that begin at ``first`` and are ``size`` long, span by span."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(int(size.sum()))


class Codec:
    """Encoder and decoder over a vocabulary given as the bytes of its model file."""

    def __init__(self, model: bytes, end: bool = True):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end = end
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(len(names))]
        if any(map(lib.is_unused, range(len(names)))):
            raise ValueError("unused pieces are not supported")
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(names) if lib.is_byte(i)}
        self._tables()
        self.powers, self.inverse = _powers(BASE), _powers(pow(BASE, -1, 1 << 64))
        # the table: row of each digest; per row its ids and characters, where they end, the batch that used it last
        self.rows: dict[int, int] = {}
        self.kept, self.chars, self.used, self.batch = array("i"), array("I"), array("q"), 0
        self.kept_ends, self.char_ends = array("q", [0]), array("q", [0])
        self.control = {i for i in range(len(names)) if lib.is_control(i)}
        self.out = [b"" if i in self.control else bytes([int(p[3:5], 16)]) if lib.is_byte(i) else p.replace(MARK, " ").encode()
                    for i, p in enumerate(names)]
        self.out[lib.unk_id()] = " ⁇ ".encode()
        self.starts = {i for p, i in self.ids.items() if p.startswith(MARK)}
        self.dummy = lib.normalize("a").startswith(MARK)
        # for whole batches: what each id stands for, then what it does as the first of a text
        self.strings = pa.array(self.out + [b[1:] if self.dummy and i in self.starts else b for i, b in enumerate(self.out)], pa.binary())

    def agenda(self, chunk: str) -> list[str]:
        """The pieces that score-ordered merging leaves of ``chunk``."""
        score, n = self.score, len(chunk)
        piece: list[str] = list(chunk)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(-score[p], i, 2, i + 1) for i in range(n - 1) if (p := chunk[i : i + 2]) in score]
        heapq.heapify(heap)
        while heap:
            _, i, size, j = heapq.heappop(heap)
            if not piece[i] or not piece[j] or right[i] != j or len(piece[i]) + len(piece[j]) != size:
                continue  # one of the two has been merged meanwhile
            piece[i] += piece[j]
            piece[j] = ""
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (p := piece[i] + piece[k]) in score:
                    heapq.heappush(heap, (-score[p], i, len(p), k))
            h = left[i]
            if h >= 0 and (p := piece[h] + piece[i]) in score:
                heapq.heappush(heap, (-score[p], h, len(p), i))
        return [p for p in piece if p]

    def _tables(self) -> None:
        """Which characters stand side by side in pieces; which symbols merge, to what."""
        beside = Counter(x for p in self.ids for x in zip(p, p[1:]))
        often = Counter(c for x, n in beside.items() for c in x * n)
        self.kind = np.zeros(0x110000, np.uint8)  # 0: any character but the CLASSES most frequent in pieces
        for k, (c, _) in enumerate(often.most_common(CLASSES), 1):
            self.kind[ord(c)] = k
        self.glue = np.zeros((CLASSES + 1, CLASSES + 1), bool)
        self.glue[0], self.glue[:, 0] = True, True
        for a, b in beside:
            self.glue[self.kind[ord(a)], self.kind[ord(b)]] = True
        size = self.library.get_piece_size()
        symbol = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p} - set(symbol)):
            symbol[c] = size + len(symbol)  # a character that is a part of pieces but none itself
        self.symbol = np.full(0x110000, -1, np.int64)
        for c, k in symbol.items():
            if len(c) == 1:
                self.symbol[ord(c)] = k
        merges = {(symbol[p[:k]], symbol[p[k:]]): p for p in self.ids for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol}
        key = np.array([a << 32 | b for a, b in merges], np.int64)
        order = np.argsort(key)
        self.pair = np.append(key[order], np.int64(1 << 62))
        self.merged = np.append(np.array([self.ids[p] for p in merges.values()], np.int64)[order], 0)
        self.rank = np.append(np.unique([-self.score[p] for p in merges.values()], return_inverse=True)[1][order], LAST)

    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair of symbols (LAST: they don't merge) and what it merges to."""
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -1)
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.rank[at], LAST).astype(np.int64), self.merged[at]

    def agendas(self, chunks: list[str]) -> list[bytes]:
        """Ids of every chunk as 32-bit numbers; all agendas go on at once, longest chunks
        first: after r merges only those of over r characters can have a pair left."""
        place = sorted(range(len(chunks)), key=lambda k: -len(chunks[k]))
        size = np.array([len(chunks[k]) for k in place])
        code = np.frombuffer("".join(chunks[k] for k in place).encode("utf-32-le"), np.uint32)
        n, first = len(code), np.append(0, np.cumsum(size))
        symbol = np.append(self.symbol[code], -1)  # the last slot stands before and behind every chunk
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        after[first[1:] - 1] = before[first[:-1]] = n
        alive = np.ones(n, bool)
        at = np.arange(n)
        rank, merged = self._pairs(symbol[:-1], symbol[after[:-1]])
        key, merged = np.append(rank << 32 | at, NONE), np.append(merged, 0)  # best score, then leftmost
        for merges in range(1, int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -merges))  # chunks of more characters than that
            best = np.minimum.reduceat(key[: first[live]], first[:live])
            i = best[best < NONE] & (1 << 32) - 1
            if not len(i):
                break
            j = after[i]
            k = after[j]
            symbol[i], after[i], before[k] = merged[i], k, i
            alive[j], key[j] = False, NONE
            for a, b in ((i, k), (before[i], i)):
                rank, merged[a] = self._pairs(symbol[a], symbol[b])
                key[a] = rank << 32 | a
            key[n] = NONE
        symbol, code = symbol[:-1][alive], code[alive]
        strange = (symbol < 0) | (symbol >= self.library.get_piece_size())
        ends = np.append(0, np.cumsum(alive))[first].tolist()
        packed = symbol.astype(np.int32).tobytes()
        out: list[bytes] = [b""] * len(chunks)
        for k, a, b in zip(place, ends, ends[1:]):
            out[k] = packed[4 * a : 4 * b]
        for k in set((np.searchsorted(ends, np.flatnonzero(strange), "right") - 1).tolist()):
            out[place[k]] = b"".join(self._single(chr(c)) if x else np.int32(i).tobytes()
                                     for i, c, x in zip(*(v[ends[k] : ends[k + 1]].tolist() for v in (symbol, code, strange))))
        return out

    def _single(self, c: str) -> bytes:
        """Ids of a character that is no piece."""
        return np.array([self.bytes[b] for b in c.encode()] if self.bytes else [self.library.unk_id()], np.int32).tobytes()

    def _heap(self, chunk: str) -> bytes:
        return b"".join(np.int32(self.ids[p]).tobytes() if p in self.ids else self._single(p) for p in self.agenda(chunk))

    def _found(self, whole: str, code: np.ndarray, starts: np.ndarray, long: np.ndarray) -> np.ndarray:
        """Rows of the table that the chunks' digests find, after adding new ones; -1: too long."""
        if len(self.rows) > 2 * KEPT:
            self._forget()
        # sums of characters times powers wrap around; a chunk's is a difference of two of them
        powers = self.powers[: len(code)] if len(code) <= PERIOD else np.resize(self.powers, len(code))
        sums = np.append(np.uint64(0), np.cumsum((code + np.uint64(1)) * powers))
        digest = (sums[starts + long] - sums[starts]) * self.inverse[starts % PERIOD]
        short = np.flatnonzero(long <= SHORT)
        coded = pa.array(digest[short]).dictionary_encode()  # by a hash table: no sort
        which, at = coded.indices.to_numpy(), np.zeros(len(coded.dictionary), np.int64)
        at[which] = short
        keys = coded.dictionary.to_numpy().tolist()
        found = np.fromiter(map(self.rows.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(found < 0)
        if len(new):
            first = starts[at[new]]
            chunks = [whole[a:b] for a, b in zip(first.tolist(), (first + long[at[new]]).tolist())]
            found[new] = np.arange(len(self.rows), len(self.rows) + len(new))
            self.rows.update(zip([keys[k] for k in new.tolist()], found[new].tolist()))
            parts = self.agendas(chunks)
            self.kept.frombytes(b"".join(parts))
            self.chars.frombytes("".join(chunks).encode("utf-32-le"))
            for ends, sizes in ((self.kept_ends, [len(p) // 4 for p in parts]), (self.char_ends, list(map(len, chunks)))):
                ends.frombytes((ends[-1] + np.cumsum(sizes, dtype=np.int64)).tobytes())
            self.used.frombytes(bytes(8 * len(new)))
        self.batch += 1
        np.frombuffer(self.used, np.int64)[found] = self.batch
        row = np.full(len(starts), -1, np.int64)
        row[short] = found[which]
        return row

    def _forget(self) -> None:
        """Leaves the ``KEPT`` rows used last."""
        used = np.frombuffer(self.used, np.int64)
        left = np.sort(np.argsort(used, kind="stable")[-KEPT:])
        keys = list(self.rows)
        self.rows = {keys[k]: row for row, k in enumerate(left.tolist())}
        self.used = array("q", used[left].tobytes())
        for values, ends in (("kept", "kept_ends"), ("chars", "char_ends")):
            old, at = getattr(self, values), np.frombuffer(getattr(self, ends), np.int64)
            size = at[left + 1] - at[left]
            setattr(self, values, array(old.typecode, np.frombuffer(old, old.typecode).take(_spans(at[left], size)).tobytes()))
            setattr(self, ends, array("q", np.append(0, np.cumsum(size)).tobytes()))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, and where each text's ids end (with a 0 before)."""
        texts = [self.library.normalize(t) for t in texts]
        whole = "".join(texts)
        ends = np.cumsum([0, *map(len, texts)])
        code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.kind[code]
        cut = np.append(True, ~self.glue[kind[:-1], kind[1:]]) if whole else np.zeros(0, bool)
        cut[ends[:-1][ends[:-1] < len(whole)]] = True
        starts = np.flatnonzero(cut)
        long = np.diff(np.append(starts, len(whole)))
        row = self._found(whole, code, starts, long)
        kept_ends, char_ends = (np.frombuffer(v, np.int64) for v in (self.kept_ends, self.char_ends))
        first, size = kept_ends[row], kept_ends[row + 1] - kept_ends[row]
        # not in the table: long chunks, and those that share the digest of another one
        apart = (row < 0) | (char_ends[row + 1] - char_ends[row] != long)
        if self.rows:
            chars = np.frombuffer(self.chars, np.uint32).take(_spans(char_ends[row], long), mode="clip")
            apart[np.searchsorted(starts, np.flatnonzero(chars != code), "right") - 1] = True
        apart = np.flatnonzero(apart).tolist()
        alone = [np.frombuffer(self._heap(whole[starts[k] : starts[k] + long[k]]), np.int32) for k in apart]
        size[apart] = [len(x) for x in alone]
        sizes = np.append(0, np.cumsum(size))
        ids = np.frombuffer(self.kept, np.int32).take(_spans(first, size), mode="clip") if self.rows else np.zeros(sizes[-1], np.int32)
        for k, x in zip(apart, alone):
            ids[sizes[k] : sizes[k + 1]] = x
        ends = sizes[np.searchsorted(starts, ends)]
        if self.end:
            ids = np.insert(ids, ends[1:], self.library.eos_id())
            ends = ends + np.arange(len(ends))
        return ids, ends

    def decode(self, ids: list[int]) -> str:
        if self.control.isdisjoint(ids[:-1]):
            data = self._join(ids)
        else:  # a control id ends a run of byte pieces
            cuts = [-1, *(k for k, i in enumerate(ids) if i in self.control), len(ids)]
            data = "".join(self._join(ids[a + 1 : b]) for a, b in zip(cuts, cuts[1:]))
        first = next((i for i in ids if i not in self.control), None)
        return data[1:] if self.dummy and first in self.starts else data

    def decode_all(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Decoded texts of what ``encode`` returns, where no control id but the last stands."""
        which = ids.astype(np.int64)
        which[ends[:-1][ends[:-1] < ends[1:]]] += len(self.out)
        data = self.strings.take(pa.array(which))
        if data.buffers()[2]:
            at = np.frombuffer(data.buffers()[1], np.int32)[ends]
            texts = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), data.buffers()[2])
            try:
                texts.validate(full=True)
                return texts
            except pa.ArrowInvalid:
                pass  # bytes that are no characters: one by one
        return pa.array([self.decode(ids[a:b].tolist()) for a, b in zip(ends, ends[1:])], pa.string())

    def _join(self, ids: list[int]) -> str:
        return b"".join(map(self.out.__getitem__, ids)).decode(errors="sillage.each_byte")


_codecs: dict[tuple, Codec] = {}


def codec(model: bytes, end: bool) -> Codec:
    """The worker's codec, kept from task to task."""
    key = (hashlib.sha256(model).digest(), end)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, end)
    return _codecs[key]


def round_trip(df: DataFrame, path: str, text: str = "text", end: bool = True) -> DataFrame:
    """``df`` with ``ids`` (array of int), ``decoded`` and ``agrees`` for the model file at
    ``path``, which the driver reads; its bytes (a vocabulary, bounded) go to the tasks."""
    with open(path, "rb") as f:
        model = f.read()
    given = [c for c in df.columns if c not in ("ids", "decoded", "agrees")]
    added = (("ids", T.ArrayType(T.IntegerType())), ("decoded", T.StringType()), ("agrees", T.BooleanType()))
    schema = T.StructType([df.schema[c] for c in given] + [T.StructField(*a) for a in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, end)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
                ids, ends = own.encode(texts)
                decoded = own.decode_all(ids, ends)
                theirs = own.library.encode(texts, add_eos=end, num_threads=1, out_type="numpy")
                back = pa.array([own.library.decode(x) for x in theirs], pa.string())
                equal = pa.array([np.array_equal(ids[a:b], x) for a, b, x in zip(ends, ends[1:], theirs)], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(batch.schema.get_field_index(c)) for c in given),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
                     decoded, pc.and_(equal, pc.equal(decoded, back))], [*given, "ids", "decoded", "agrees"])

    return df.mapInArrow(run, schema)
