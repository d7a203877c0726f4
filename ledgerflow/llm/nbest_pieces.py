"""N-best segmentations into a SentencePiece vocabulary, and their decoding.

A forward Viterbi pass over the lattice of pieces gives the best score up to
every place; it is an exact heuristic for a search from the end backwards
(A*), which so returns segmentations in order of their scores. No piece of the
vocabulary runs over the start of a word, so the lattice is cut there, words
are searched one by one, and a text's n best are the best sums over its
words: exact, since only the n - 1 words with the nearest second choice can differ.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N, CACHE = 3, 700_000
CACHED = 1000  # characters of the longest word that is cached
WIDE, TOGETHER = 48, 2_000_000  # characters of the longest word of a matrix, and of the texts whose words are learnt together
BLOCK = 1 << 16  # runs put together at a time
SPACE = "▁"
UNKNOWN = 10.0  # an unknown character scores so much less than the lowest piece


def _packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit words."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _runs(values: np.ndarray, first: np.ndarray, size: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of an array, one after the other; a run is known by its first place and its size."""
    out = []
    for k in range(0, max(1, len(which)), BLOCK):
        some = which[k:k + BLOCK]
        n = size[some]
        out.append(values[np.repeat(first[some] - np.cumsum(n) + n, n) + np.arange(n.sum())])
    return np.concatenate(out) if len(out) > 1 else out[0]


class Lattice:
    """The vocabulary of a model file, and a cache of words."""

    def __init__(self, path: str, n: int = N):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.n, self.normalize = n, sp.normalize
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        plain = [i for i in range(len(self.pieces)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.byte = {int(self.pieces[i][3:-1], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.unknown_id = sp.unk_id()
        score = {i: sp.get_score(i) for i in plain}
        self.score, self.longest = {self.pieces[i]: s for i, s in score.items()}, max((len(self.pieces[i]) for i in plain), default=1)
        self.lowest = min((s for s in score.values() if s > -1e8), default=0.0) - UNKNOWN
        #: the pieces as a tree of characters: character -> (children, score or None if no piece ends here, id)
        self.tree: dict[str, tuple] = {}
        self.id = {}
        for i in plain:
            self.id[self.pieces[i]] = i
            kids = self.tree
            for c in self.pieces[i][:-1]:
                kids = kids.setdefault(c, ({}, None, 0))[0]
            last = self.pieces[i][-1]
            kids[last] = (kids[last][0] if last in kids else {}, score[i], i)
        self._number()
        #: the bytes of each piece (a byte piece is its byte)
        utf8 = [bytes([self.byte_of[i]]) if i in self.byte_of else p.encode("utf-8", "surrogatepass") for i, p in enumerate(self.pieces)]
        self.utf8, self.n_bytes = np.frombuffer(b"".join(utf8), np.uint8), np.fromiter(map(len, utf8), np.int64, len(utf8))
        self.first = np.cumsum(self.n_bytes) - self.n_bytes
        #: whether the lattice can be cut before each run of spaces
        self.cuts = not any(a != SPACE and b == SPACE for p in self.id for a, b in zip(p, p[1:], strict=False))
        self.known: dict[str, tuple[bytes, int, float, float]] = {}
        self.chosen: dict[str, list[tuple[float, np.ndarray]]] = {}

    def _number(self) -> None:
        """The tree as arrays: sorted keys (node, character) with the child, the score (nan: no piece ends) and the id."""
        chars = {c: k for k, c in enumerate(sorted({c for p in self.id for c in p}))}
        self.char = np.full(0x110000, len(chars), np.int32)  # number of a character, the last one for those in no piece
        self.single = np.zeros(0x110000, bool)  # whether a character is a piece itself
        for c, k in chars.items():
            self.char[ord(c)], self.single[ord(c)] = k, c in self.id
        self.chars = len(chars) + 1
        rows, nodes, left = [], 1, [(0, self.tree)]
        while left:
            node, kids = left.pop()
            for c, (more, s, k) in kids.items():
                rows.append((node * self.chars + chars[c], nodes, np.nan if s is None else s, k))
                left.append((nodes, more))
                nodes += 1
        rows.sort()
        keys, child, score, ids = zip(*rows, strict=True) if rows else ((-1,), (0,), (np.nan,), (0,))
        self.keys, self.child, self.scores, self.ids_of = np.array(keys, np.int64), np.array(child, np.int64), np.array(score, np.float64), np.array(ids, np.int64)

    def learn(self, words: list[str]) -> None:
        """Puts words into the cache, thousands at a time: the pass of ``best`` over a matrix of words.

        Long words are left to ``best``."""
        distinct = {w for w in words if len(w) <= WIDE}
        new = sorted(distinct.difference(self.known), key=len)
        if len(self.known) + len(new) > CACHE:
            self.known.clear()
            new = sorted(distinct, key=len)
        for k in range(0, len(new), 4096):
            self._learn(new[k:k + 4096])

    def _learn(self, words: list[str]) -> None:
        size = np.fromiter(map(len, words), np.int64, len(words))
        n, wide = len(words), int(size[-1])
        inside = np.arange(wide) < size[:, None]
        code = np.zeros((n, wide), np.int64)
        code[inside] = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.ascontiguousarray(code.T)  # a row for each place
        matrix, bridged = self.char[code], ~self.single[code]
        ahead, second = np.full((wide + 1, n), -np.inf), np.full((wide + 1, n), -np.inf)
        back, last = np.zeros((wide + 1, n), np.int64), np.zeros((wide + 1, n), np.int64)
        ahead[0] = 0

        def step(r: np.ndarray, i: int, j: int, s: np.ndarray | float, ids: np.ndarray) -> None:
            v, rival = ahead[i][r] + s, ahead[j][r]
            win = v > rival
            second[j][r] = np.maximum(second[j][r], np.where(win, np.maximum(rival, second[i][r] + s), v))
            r = r[win]
            ahead[j][r], back[j][r], last[j][r] = v[win], i, ids[win]

        for i in range(wide):
            row = np.arange(np.searchsorted(size, i, "right"), n)  # sorted by length
            lone = row[bridged[i][row]]
            node = np.zeros(len(row), np.int64)
            for j in range(i, min(wide, i + self.longest)):
                if j > i:
                    here = size[row] > j
                    row, node = row[here], node[here]
                key = node * self.chars + matrix[j][row]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                hit = self.keys[at] == key
                row, at = row[hit], at[hit]
                if not len(row):
                    break
                node, s = self.child[at], self.scores[at]
                ends = ~np.isnan(s)
                step(row[ends], i, j + 1, s[ends], self.ids_of[at[ends]])
            if len(lone):
                step(lone, i, i + 1, self.lowest, -1 - code[i][lone])
        ids, count, at, every = np.zeros((n, wide), np.int64), np.zeros(n, np.int64), size.copy(), np.arange(n)
        while len(every):
            here = at[every]
            count[every] += 1
            ids[every, wide - count[every]] = last[here, every]
            at[every] = back[here, every]
            every = every[at[every] > 0]
        ids = ids[np.arange(wide) >= wide - count[:, None]]
        unknown = ids < 0
        if unknown.any():
            chars, which = np.unique(ids[unknown], return_inverse=True)
            spelt = [self.unknown(chr(-1 - c)) for c in chars.tolist()]
            many = np.ones(len(ids), np.int64)
            many[unknown] = np.array([len(x) for x in spelt])[which]
            count = np.add.reduceat(many, np.cumsum(count) - count)
            ids = np.repeat(ids, many)
            ids[np.repeat(unknown, many)] = [x for k in which.tolist() for x in spelt[k]]
        score, rival = ahead[size, np.arange(n)], second[size, np.arange(n)]
        packed, z = ids.astype("<u4").tobytes(), (4 * np.cumsum(count)).tolist()
        self.known.update(zip(words, zip([packed[a:b] for a, b in zip([0, *z[:-1]], z, strict=True)], count.tolist(), score.tolist(), (score - rival).tolist(), strict=True), strict=True))

    def edges(self, word: str) -> list[tuple[int, int, float]]:
        """(from, to, score) of all pieces that occur, in order of from; unknown characters are bridged."""
        return list(self._edges(word))

    def _edges(self, word: str) -> Iterator[tuple[int, int, float]]:
        for i in range(len(word)):
            kids = self.tree
            for j in range(i, len(word)):
                if word[j] not in kids:
                    break
                kids, s, _ = kids[word[j]]
                if s is not None:
                    yield i, j + 1, s
            if word[i] not in self.id:
                yield i, i + 1, self.lowest

    def _into(self, word: str, at: int) -> Iterator[tuple[int, float]]:
        """(from, score) of the pieces that end at a place."""
        for i in range(max(0, at - self.longest), at):
            s = self.score.get(word[i:at])
            if s is not None:
                yield i, s
        if word[at - 1] not in self.id:
            yield at - 1, self.lowest

    def best(self, word: str) -> tuple[list[int], float, float]:
        """Ids of the best segmentation, its score, and how far behind the second is.

        Each place keeps the scores of the two best ways to it: one pass forwards."""
        tree, single, n, low, lowest, longest = self.tree, self.id, len(word), float("-inf"), self.lowest, self.longest
        ahead, second, back, last = [0.0] + [low] * n, [low] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        for i, c in enumerate(word):
            top, next_, kids, j = ahead[i], second[i], tree, i
            for d in word[i:i + longest]:
                hit = kids.get(d)
                if hit is None:
                    break
                j += 1
                kids, s, k = hit
                if s is None:
                    continue
                v, rival = top + s, ahead[j]
                if v > rival:
                    ahead[j], back[j], last[j] = v, i, k
                    v = rival if rival > next_ + s else next_ + s
                if v > second[j]:
                    second[j] = v
            if c not in single:
                v, rival, j = top + lowest, ahead[i + 1], i + 1
                if v > rival:
                    ahead[j], back[j], last[j] = v, i, -1
                    v = rival if rival > next_ + lowest else next_ + lowest
                if v > second[j]:
                    second[j] = v
        ids, at = [], n
        while at:
            k, a = last[at], back[at]
            if k >= 0:
                ids.append(k)
            else:
                ids.extend(reversed(self.unknown(word[a:at])))
            at = a
        ids.reverse()
        return ids, ahead[n], ahead[n] - second[n]

    def n_best(self, word: str, n: int | None = None) -> list[tuple[float, list[int]]]:
        """(score, ends of pieces) of the n best segmentations, best first: Viterbi forwards, A* backwards.

        An entry points to the one it came from. No place is left more than n times: later ways from it are no
        better than n others. So time and memory grow with the length."""
        n = n or self.n
        size = len(word)
        ahead = [0.0] + [float("-inf")] * size
        for i, j, s in self._edges(word):
            ahead[j] = max(ahead[j], ahead[i] + s)
        agenda, out, count, left = [(-ahead[size], 0, size, 0.0, None)], [], 1, bytearray(size + 1) if n < 256 else [0] * (size + 1)
        while agenda and len(out) < n:
            _, _, at, done, ends = heapq.heappop(agenda)
            if not at:
                path = []
                while ends:
                    end, ends = ends
                    path.append(end)
                out.append((done, path))
                continue
            if left[at] == n:
                continue
            left[at] += 1
            ends = (at, ends)
            for i, s in self._into(word, at):
                heapq.heappush(agenda, (-(ahead[i] + done + s), count, i, done + s, ends))
                count += 1
        return out

    def ids(self, word: str, ends: list[int]) -> list[int]:
        out = []
        for i, j in zip([0, *ends[:-1]], ends, strict=True):
            p = word[i:j]
            if p in self.id:
                out.append(self.id[p])
            else:
                out.extend(self.unknown(p))
        return out

    def unknown(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode("utf-8", "surrogatepass")] if self.byte else [self.unknown_id]

    def decode(self, ids: list[int]) -> str:
        """The normalised text of some ids; runs of byte pieces are put together."""
        if self.byte_of.keys().isdisjoint(ids):
            return "".join([self.pieces[i] for i in ids])
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            out.append(self.pieces[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decoded(self, ids: np.ndarray) -> str:
        """``decode`` of an array of ids, by the pieces' bytes."""
        return _runs(self.utf8, self.first, self.n_bytes, ids).tobytes().decode("utf-8", "replace")

    def words(self, text: str) -> list[str]:
        return self._split([self.normalize(text) if text else ""])[0].to_pylist()

    def _split(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of normalised texts, and the number of each text's first word (at last, of all words)."""
        utf8 = [t.encode() for t in texts]
        data = np.frombuffer(b"".join(utf8), np.uint8)
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, utf8), np.int64, len(utf8)))])
        start = np.zeros(len(data) + 1, bool)
        if self.cuts:
            a, b, c = SPACE.encode()
            at = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
            start[at[np.diff(at, prepend=-3) != 3]] = True  # the first of each run
        start[begin] = True
        at = np.flatnonzero(start)
        return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data)), np.searchsorted(at, begin)

    def _entry(self, word: str) -> tuple[bytes, int, float, float]:
        if len(self.known) >= CACHE:
            self.known.clear()
        ids, score, gap = self.best(word)
        out = (_packed(ids), len(ids), score, gap)
        if len(word) <= CACHED:
            self.known[word] = out
        return out

    def _choices(self, word: str) -> list[tuple[float, np.ndarray]]:
        """(score, ids) of the n best segmentations of a word."""
        if word in self.chosen:
            return self.chosen[word]
        out = [(s, np.array(self.ids(word, ends), "<u4")) for s, ends in self.n_best(word)]
        if len(word) <= CACHED:
            if len(self.chosen) >= CACHE // 10:
                self.chosen.clear()
            self.chosen[word] = out
        return out

    def encode_all(self, texts: list[str | None]) -> Iterator[list[tuple[float, int, int, bool]]]:
        """``encode`` of each text, the words of about ``TOGETHER`` characters learnt at a time."""
        a = 0
        while a < len(texts):
            z, size = a, 0
            while z < len(texts) and (z == a or size < TOGETHER):
                size += len(texts[z] or "")
                z += 1
            yield from self._encode(texts[a:z], self.learn)
            a = z

    def encode(self, text: str) -> list[tuple[float, int, int, bool]]:
        """(score, number of ids, crc32 of the ids, whether they decode to the text) of the n best, best first."""
        return next(self._encode([text]))

    def _encode(self, texts: list[str | None], learn: Callable[[list[str]], None] = lambda words: None) -> Iterator[list[tuple[float, int, int, bool]]]:
        """``encode`` of texts; each distinct word is looked up once."""
        texts = [self.normalize(t) if t else "" for t in texts]
        words, begin = self._split(texts)
        words = words.dictionary_encode()
        which, words = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        learn(words)
        parts, counts, scores, gaps = zip(*[self.known.get(w) or self._entry(w) for w in words], strict=True) if words else ((), (), (), ())
        size = np.array(counts, np.int64)
        all_ids = _runs(np.frombuffer(b"".join(parts), "<u4"), np.cumsum(size) - size, size, which)
        place = np.concatenate([[0], np.cumsum(size[which])])
        score, gap = np.array(scores, np.float64)[which], np.array(gaps, np.float64)[which]
        for text, a, z in zip(texts, begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if not text:
                yield [(0.0, 0, zlib.crc32(b""), True)]
                continue
            near, left = [], gap[a:z].copy()
            while len(near) < min(self.n - 1, z - a):  # the words with the nearest second choice
                near.append(int(left.argmin()))
                left[near[-1]] = np.inf
            choices = {a + k: self._choices(words[which[a + k]]) for k in near if gap[a + k] < np.inf}
            # sums of choices, best first: (loss, choice of each word)
            sums: list[tuple[float, tuple]] = [(0.0, ())]
            for k, c in choices.items():
                sums = heapq.nsmallest(self.n, ((loss + c[0][0] - s, (*pick, (k, x))) for loss, pick in sums for x, (s, _) in enumerate(c)))
            # every segmentation is put together and decoded as a whole
            total, out = sum(score[a:z].tolist()), []
            for loss, pick in sums:
                own, at = [], place[a]
                for k, x in sorted(pick):
                    own += [all_ids[at:place[k]], choices[k][x][1]]
                    at = place[k + 1]
                ids = np.concatenate([*own, all_ids[at:place[z]]])
                out.append((total - loss, len(ids), zlib.crc32(ids), self.decoded(ids) == text))
            yield out


_lattices: dict[tuple[str, int], Lattice] = {}


def lattice(path: str, n: int = N) -> Lattice:
    if (path, n) not in _lattices:
        _lattices[path, n] = Lattice(path, n)
    return _lattices[path, n]


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts have at most ``TOGETHER`` bytes together, or one row."""
    size = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    a = 0
    while a < b.num_rows:
        z = max(a + 1, int(np.searchsorted(size, size[a] + TOGETHER, "right")) - 1)
        yield b.slice(a, z - a)
        a = z


def n_best_pieces(docs: DataFrame, model: str, n: int = N, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, rank, score, n_pieces, ids_crc32, decoded`` of the n best segmentations of each whole text.

    Rank 0 is the best; a text with fewer segmentations has fewer rows. A null or empty text has
    one, without pieces. Characters outside the vocabulary become byte pieces. ``decoded``
    says that the ids decode to the normalised text. Scores are sums of the model's: for a BPE model they are ranks
    of merges, so rank 0 need not be the model's own encoding. Segmentations of equal score come in the order in which
    the search finds them. Repeated rows give repeated results; a null id stays null. Other columns are not
    read; an empty table gives an empty result. ``model``: path of a model file, read on the executors.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = lattice(model, n)
        for b in chain.from_iterable(map(_slices, batches)):
            rows = [(i, r, *x) for i, best in zip(b.column(0).to_pylist(), pieces.encode_all(b.column(1).to_pylist()), strict=True) for r, x in enumerate(best)]
            types = [pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["id", "rank", "score", "n_pieces", "ids_crc32", "decoded"])

    out = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(run, "id long, rank int, score double, n_pieces long, ids_crc32 long, decoded boolean")
    return out.withColumnRenamed("id", id)
