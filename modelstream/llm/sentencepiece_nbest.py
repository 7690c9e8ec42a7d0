"""SentencePiece encoding and decoding with N-best segmentations.

The pieces and scores of a public vocabulary file span a lattice over the text: a segmentation is a path, its score the sum of its
pieces' scores. A forward Viterbi pass gives every position the best score from the start, which is the exact
heuristic of a backward A* search from the end: partial paths leave the queue in the order of the best whole path through
them, so the first N complete ones are the N best.

A blank begins a new word in these vocabularies, so no piece but runs of blanks crosses from a word's end to the next blank, and
the lattice is a chain of small ones. The search works on the chain: it enters only the words whose second-best path costs
least, N - 1 of them at most, since a path that leaves the best one anywhere else has N better ones before it.

Blanks are written as the sign for a blank. A character without a piece, and that sign itself in a text, become byte pieces, so
decoding gives back every text exactly.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelstream.llm import common

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
NBEST = 4
# Words, and their characters, whose best paths a worker remembers; the memory is emptied when either is full.
REMEMBERED = 150_000
REMEMBERED_CHARACTERS = 4_000_000

BLANK = "\u2581"
# A word with its leading blanks: the lattice is cut before a run of blanks and around line ends.
WORDS = re.compile(r"[^ \n\u2581]+|\n|\u2581| +[^ \n\u2581]*")

Segmentation = tuple[float, tuple[int, ...]]


class Pieces:
    """Pieces, scores and byte pieces of a vocabulary file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.ids: dict[str, tuple[int, float]] = {}
        self.bytes: list[tuple[int, float]] = [(0, 0.0)] * 256
        self.strings: list[bytes] = []
        scores = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.strings.append(piece.replace(BLANK, " ").encode())
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = (i, model.get_score(i))
                self.strings[-1] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                # The sign in a piece is a blank of the text.
                if len(WORDS.findall(piece.replace(BLANK, " "))) > 1:
                    raise ValueError(f"the piece {piece!r} goes beyond a word, so the chain of words would lack paths")
                self.ids[piece.replace(BLANK, " ")] = (i, model.get_score(i))
                scores.append(model.get_score(i))
        self.longest = max(map(len, self.ids))
        # A byte costs more than any piece, so bytes stand only where no piece does.
        self.byte_score = (min(scores) if scores else 0.0) - 10.0
        self.score = np.zeros(len(self.strings))
        for number, score in self.ids.values():
            self.score[number] = score
        self.byte_ids = np.array([number for number, _ in self.bytes], np.int64)
        self._index()
        self._forget()

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.strings.__getitem__, ids)).decode()

    def edges(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end position the edges (start, score, ids) of the lattice."""
        n, get = len(word), self.ids.get
        ends: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(n + 1)]
        for i in range(n):
            single = False
            for j in range(i + 1, min(n, i + self.longest) + 1):
                found = get(word[i:j])
                if found:
                    ends[j].append((i, found[1], (found[0],)))
                    single = single or j == i + 1
            if not single:
                code = word[i].encode()
                ends[i + 1].append((i, self.byte_score * len(code), tuple(self.bytes[b][0] for b in code)))
        return ends

    def solve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Forward Viterbi over many words at once: score of the best path of each, of the second best (minus infinity
        without one), sizes of the best paths and their ids one after the other.

        All words advance by the same character and edge length together, so a step is a few array passes. Of equal
        scores the edge that begins first wins.
        """
        size = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        end = np.cumsum(size)
        begin = end - size
        place = np.arange(len(codes)) - np.repeat(begin, size)
        room = np.repeat(size, size) - place
        # Edges of one length after the other; a start is given up when no piece begins like it.
        edges, alone = [], np.ones(len(codes), bool)
        active, value = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for length in range(1, self.longest + 1):
            value = value * np.uint64(common.BASE) + codes[active + (length - 1)] + np.uint64(1)
            known = self._entry(value)
            active, value, known = active[known >= 0], value[known >= 0], known[known >= 0]
            piece = self.entry_piece[known]
            whole = piece >= 0
            at, piece = active[whole], piece[whole]
            edges.append((at, piece, self.score[piece]))
            if length == 1:
                alone[at] = False
            longer = room[active] > length
            active, value = active[longer], value[longer]
            if not len(active):
                break
        spelled = np.flatnonzero(alone)
        n_bytes = 1 + (codes[spelled] >= 0x80) + (codes[spelled] >= 0x800) + (codes[spelled] >= 0x10000)
        at, piece, cost = edges[0]
        edges[0] = (np.append(at, spelled), np.append(piece, np.full(len(spelled), -1)), np.append(cost, self.byte_score * n_bytes))
        # Edges of each length by the place of their start. Node k + 1 of a word's own row stands behind its character k.
        ordered = []
        for at, piece, cost in edges:
            order = np.argsort(place[at], kind="stable")
            at = at[order]
            cuts = np.searchsorted(place[at], np.arange(int(size.max(initial=0)) + 1))
            ordered.append((at, piece[order], cost[order], cuts))
        node = np.arange(len(codes)) + np.repeat(np.arange(len(words)), size)
        nodes = len(codes) + len(words)
        first, second = np.full(nodes, -np.inf), np.full(nodes, -np.inf)
        step, taken = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        first[begin + np.arange(len(words))] = 0.0
        for k in range(int(size.max(initial=0))):
            for length, (at, piece, cost, cuts) in enumerate(ordered, 1):
                low, high = cuts[k], cuts[k + 1]
                if low == high:
                    continue
                start = node[at[low:high]]
                goal = start + length
                score, other = first[start] + cost[low:high], second[start] + cost[low:high]
                old = first[goal]
                better = score > old
                second[goal] = np.where(better, np.maximum(old, other), np.maximum(second[goal], score))
                hit = goal[better]
                first[hit], step[hit], taken[hit] = score[better], length, piece[low:high][better]
        last = end + np.arange(len(words))
        # Back from the ends, all words together; then into the order of the text.
        rows, starts, chosen = [], [], []
        word, at = np.arange(len(words)), last
        while len(word):
            rows.append(word)
            chosen.append(taken[at])
            at = at - step[at]
            starts.append(at - word)
            go = at > begin[word] + word
            word, at = word[go], at[go]
        row, start, piece = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, starts, chosen))
        order = np.argsort(start)
        row, start, piece = row[order], start[order], piece[order]
        spelled = piece < 0
        code = codes[start]
        times = np.where(spelled, 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000), 1)
        ids = np.repeat(piece, times)
        if spelled.any():
            raw = code[spelled].tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            ids[np.repeat(spelled, times)] = self.byte_ids[np.frombuffer(raw, np.uint8)]
        sizes = np.bincount(row, weights=times, minlength=len(words)).astype(np.int64)
        return first[last], second[last], sizes, ids.astype(np.int32)

    def _entry(self, value: np.ndarray) -> np.ndarray:
        """The entry of each hash among the beginnings of pieces, -1 without one."""
        slot = (common.mixed(value) >> np.uint64(64 - self.slot_bits)).astype(np.int64)
        found = self.slots[slot]
        open_ = np.flatnonzero((found >= 0) & (self.entry_hash[found] != value))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.slot_bits) - 1)
            found[open_] = self.slots[slot[open_]]
            open_ = open_[(found[open_] >= 0) & (self.entry_hash[found[open_]] != value[open_])]
        return found

    def _index(self) -> None:
        """A hash table of all beginnings of pieces, each with its piece or -1."""
        whole = {word: number for word, (number, _) in self.ids.items()}
        begins = list(dict.fromkeys(word[:k] for word in whole for k in range(1, len(word) + 1)))
        hashes = []
        for text in begins:
            h = 0
            for c in text:
                h = (h * common.BASE + ord(c) + 1) & ((1 << 64) - 1)
            hashes.append(h)
        if len(set(hashes)) < len(hashes):
            raise ValueError("two beginnings of pieces have one hash")
        self.entry_hash = np.array(hashes, np.uint64)
        self.entry_piece = np.array([whole.get(text, -1) for text in begins], np.int64)
        self.slot_bits = max(4, (4 * len(begins)).bit_length())
        self.slots = np.full(1 << self.slot_bits, -1, np.int64)
        wanted = (common.mixed(self.entry_hash) >> np.uint64(64 - self.slot_bits)).astype(np.int64)
        for entry, slot in enumerate(wanted.tolist()):
            while self.slots[slot] >= 0:
                slot = (slot + 1) & ((1 << self.slot_bits) - 1)
            self.slots[slot] = entry

    def slots_of(self, words: list[str]) -> np.ndarray:
        """Where the memory keeps each word; words that it lacks are solved together."""
        if len(self.words) >= REMEMBERED or self.characters >= REMEMBERED_CHARACTERS:
            self._forget()
        found = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        lacking = np.flatnonzero(found < 0).tolist()
        if lacking:
            lacked = [words[k] for k in lacking]
            fresh = list(dict.fromkeys(lacked))
            self.characters += sum(map(len, fresh))
            first, second, sizes, ids = self.solve(fresh)
            self.words.update(zip(fresh, range(len(self.words), len(self.words) + len(fresh))))
            self.first = np.append(self.first, first)
            self.gap = np.append(self.gap, first - second)
            self.offset = np.append(self.offset, self.offset[-1] + np.cumsum(sizes))
            self.flat = np.append(self.flat, ids)
            found[lacking] = np.fromiter(map(self.words.__getitem__, lacked), np.int64, len(lacked))
        return found

    def _forget(self) -> None:
        self.words: dict[str, int] = {}
        self.characters = 0
        self.first, self.gap = np.zeros(0), np.zeros(0)
        self.offset, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)
        self.ranked: dict[tuple[str, int], list[Segmentation]] = {}

    def ranks(self, word: str, most: int) -> list[Segmentation]:
        """`nbest`, remembered for short words."""
        known = self.ranked.get((word, most))
        if known is None:
            known = self.nbest(word, most)
            if len(word) <= 64:
                self.ranked[word, most] = known
        return known

    def nbest(self, word: str, most: int) -> list[Segmentation]:
        """The `most` best paths of a lattice: forward Viterbi scores, then A* from the end."""
        ends = self.edges(word)
        n = len(word)
        ahead = [float("-inf")] * (n + 1)
        ahead[0] = 0.0
        for j in range(1, n + 1):
            for i, score, _ in ends[j]:
                if ahead[i] + score > ahead[j]:
                    ahead[j] = ahead[i] + score
        out: list[Segmentation] = []
        # (minus the best whole score, order of insertion, position, score behind it, ids behind it as a chain)
        queue: list[tuple] = [(-ahead[n], 0, n, 0.0, None)]
        order = 1
        while queue and len(out) < most:
            _, _, at, behind, chain = heapq.heappop(queue)
            if at == 0:
                ids: list[int] = []
                while chain is not None:
                    ids.extend(chain[0])
                    chain = chain[1]
                out.append((behind, tuple(ids)))
                continue
            for i, score, own in ends[at]:
                if ahead[i] > float("-inf"):
                    heapq.heappush(queue, (-(ahead[i] + score + behind), order, i, behind + score, (own, chain)))
                    order += 1
        return out

    def encode(self, text: str, most: int) -> list[Segmentation]:
        """The `most` best segmentations of a text, the best first; of equal scores, in the order of the search."""
        return [(score, tuple(ids.tolist())) for score, ids in next(self.encode_all([text], most))]

    def encode_all(self, texts: list[str], most: int) -> Iterator[list[tuple[float, np.ndarray]]]:
        """`encode` of each text, ids as arrays. Texts are looked at together up to `common.PIECE_BYTES` characters, or one longer alone."""
        low = 0
        while low < len(texts):
            high, size = low + 1, len(texts[low])
            while high < len(texts) and size + len(texts[high]) <= common.PIECE_BYTES:
                size += len(texts[high])
                high += 1
            split = [WORDS.findall(text) for text in texts[low:high]]
            slots = self.slots_of([w for words in split for w in words])
            at = 0
            for words in split:
                yield self._chain(words, slots[at : at + len(words)], most)
                at += len(words)
            low = high

    def _chain(self, words: list[str], slots: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
        """The best paths of the chain of a text's lattices."""
        scores, gaps = self.first[slots], self.gap[slots]
        # Places where leaving the best path costs least, of equal ones the first; only these can matter.
        cheap = np.flatnonzero(gaps < np.inf)
        if len(cheap) >= most > 1:
            limit = np.partition(gaps[cheap], most - 2)[most - 2]
            less = cheap[gaps[cheap] < limit]
            cheap = np.sort(np.append(less, cheap[gaps[cheap] == limit][: most - 1 - len(less)]))
        places = cheap[: most - 1].tolist()
        choices = [self.ranks(words[k], most) for k in places]
        # Forward scores along the chain, then A* backwards over its words.
        ahead = [float(scores.sum()) - sum(float(scores[k]) for k in places)]
        for own in choices:
            ahead.append(ahead[-1] + own[0][0])
        queue: list[tuple] = [(-ahead[-1], 0, len(places), 0.0, ())]
        order, picks = 1, []
        while queue and len(picks) < most:
            _, _, at, behind, chosen = heapq.heappop(queue)
            if at == 0:
                picks.append((ahead[0] + behind, chosen))
                continue
            for c, (score, _) in enumerate(choices[at - 1]):
                heapq.heappush(queue, (-(ahead[at - 1] + score + behind), order, at - 1, behind + score, (c, *chosen)))
                order += 1
        # Ids of the best path, and where those of the places stand in them.
        size = self.offset[slots + 1] - self.offset[slots]
        stop = np.cumsum(size)
        ids = self.flat[np.repeat(self.offset[slots] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)]
        out = []
        for score, chosen in picks:
            parts, done = [], 0
            for k, own, c in zip(places, choices, chosen):
                parts += [ids[done : stop[k] - size[k]], np.array(own[c][1], np.int32)]
                done = stop[k]
            out.append((score, np.concatenate([*parts, ids[done:]])))
        return out


_loaded: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    """The vocabulary, read once a worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _encode(path: str, most: int):
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in common.batches(source, 256):
            scores, ids, sizes, counts = [], [], [], []
            for found in pieces.encode_all([text or "" for text in batch.column(1).to_pylist()], most):
                counts.append(len(found))
                for score, own in found:
                    scores.append(score)
                    ids.append(own)
                    sizes.append(len(own))
            flat = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), flat)
            structs = pa.StructArray.from_arrays([pa.array(scores, pa.float64()), lists], ["score", "ids"])
            nested = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), structs)
            yield pa.RecordBatch.from_arrays([batch.column(0), nested.cast(kind)], ["doc_id", "segmentations"])

    return run


def encode_nbest(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", nbest: int = NBEST, vocabulary: str = VOCABULARY
) -> DataFrame:
    """doc_id and segmentations (score, ids), the best first, of every row.

    Other columns are not looked at. A null or empty text has one segmentation without pieces. A text has fewer than
    `nbest` where fewer exist. Repeated rows get equal answers; rows without an id are encoded too. Empty input gives an empty result.
    """
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(
        _encode(vocabulary, nbest), "doc_id bigint, segmentations array<struct<score:double,ids:array<int>>>"
    )


def _decode(path: str):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in common.batches(source, 256):
            texts = [None if ids is None else pieces.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and the text of lists of ids; null stays null."""
    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids")).mapInArrow(
        _decode(vocabulary), "doc_id bigint, text string"
    )


def _digest(path: str, most: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        names = ["doc_id", "n_segmentations", "n_pieces", "score", "scores", "ids_sha256", "decoded"]
        for batch in common.batches(source, 256):
            out: list[list] = [[] for _ in names[1:]]
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for text, found in zip(texts, pieces.encode_all(texts, most)):
                joined = hashlib.sha256()
                for _, ids in found:
                    joined.update(len(ids).to_bytes(4, "little"))
                    joined.update(ids.astype("<i4").tobytes())
                ok = all(pieces.decode(ids.tolist()) == text for _, ids in found)
                for column, value in zip(out, (len(found), len(found[0][1]), found[0][0], [s for s, _ in found], joined.hexdigest(), ok)):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(out, kinds)]], names)

    return run


def nbest_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", nbest: int = NBEST, vocabulary: str = VOCABULARY) -> DataFrame:
    """Counts, scores and a digest of the segmentations of each row, and whether all of them decode to its text."""
    slim = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(
        _digest(vocabulary, nbest),
        "doc_id bigint, n_segmentations bigint, n_pieces bigint, score double, scores array<double>, ids_sha256 string, decoded boolean",
    )
