"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words (a run of blanks and what follows; no piece crosses their edges) that the worker
has not met are concatenated with all pieces, and put in suffix order to the depth of the longest piece.
A binary search finds each piece's range of suffixes, that is all its occurrences; these are edges, which are sorted
by position and relaxed: the model is a BPE one, so an edge is taken if its piece may follow the last
piece of what stands before it, which holds for exactly one edge at each place (no merge across
their joint would come before the merges that made them).  Of a run of blanks the last one belongs to the word;
the pieces of the others are the same wherever a run of that length stands.  Characters without a piece become bytes.

Cases: a null text is an empty one, without ids; a null doc_id and repeated rows are kept, a row each; an
empty table gives no rows; further columns are ignored; a text that holds U+2581 decodes with a blank in its
place.  A model in which another piece has a score as low as those of blanks is refused.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, frugal, kept, table
from .suffix_dedup import suffix_ranks
from .tokens import ChunkEncoder, ragged, slices

BLANK = "▁"
BLANK_BYTES = BLANK.encode()
#: Bytes of words that are indexed at once.
INDEXED_BYTES = 1_000_000
NEVER = 1 << 60


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder(ChunkEncoder):
    """Encodes as the sentencepiece library does with a BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str, entries: int = 1_500_000):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        self.size, self.entries = n, entries
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        normal = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        self.byte_id = np.zeros(256, np.int64)
        for i in range(n):
            if model.is_byte(i):
                self.byte_id[int(self.pieces[i][3:5], 16)] = i
        order = sorted((i for i in range(n) if normal[i]), key=lambda i: -model.get_score(i))
        self.rank = {self.pieces[i]: r for r, i in enumerate(order)}
        self.score = {self.pieces[i]: model.get_score(i) for i in order}
        self.id = {self.pieces[i]: i for i in order}
        runs = {x for x in self.score if not x.strip(BLANK)}
        if any(s <= max(self.score[x] for x in runs) for x, s in self.score.items() if x not in runs):
            raise ValueError("blanks must merge after all other pieces")
        self.runs: dict[int, list[int]] = {}
        self.rights, self.lefts = [[] for _ in range(n)], [[] for _ in range(n)]
        halves = {}
        usable = []
        for i in order:
            parts, last = self._merged(self.pieces[i])
            if len(parts) == 1:
                usable.append(i)
                halves[self.pieces[i]] = last
        for i in usable:
            for spine, side in ((self.rights, 1), (self.lefts, 0)):
                at = self.pieces[i]
                while at is not None:
                    spine[i].append(at)
                    at = halves[at][side] if halves.get(at) else None
        self.usable = np.array(usable, np.int64)
        raw = [self.pieces[i].encode() for i in usable]
        self.piece_sizes = np.array([len(x) for x in raw], np.int64)
        self.depth = int(self.piece_sizes.max()) + 1
        self.index_tail = b"".join(raw) * 2  # each piece, then each with a symbol above all bytes after it
        values = [model.id_to_piece(i).encode() if normal[i] else b"" for i in range(n)]
        for b, i in enumerate(self.byte_id.tolist()):
            values[i] = bytes([b])
        self.value_sizes = np.array([len(x) for x in values], np.int64)
        self.value_starts = np.cumsum(self.value_sizes) - self.value_sizes
        self.values = np.frombuffer(b"".join(values), np.uint8)
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        self._drop()

    def _merged(self, text: str) -> tuple[list[str], tuple[str, str] | None]:
        """The pieces of a text by merging the best pair (the first of equal ones) again and again, and the last pair merged.

        Pairs wait in a heap and neighbours in a linked list, so the time is that of sorting.
        """
        parts: list[str | None] = list(text)
        after, before = [*range(1, len(parts)), -1], list(range(-1, len(parts) - 1))
        waiting: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] >= 0 and (s := self.score.get(parts[i] + parts[after[i]])) is not None:
                heapq.heappush(waiting, (-s, i, parts[i], parts[after[i]]))

        for i in range(len(parts)):
            offer(i)
        last = None
        while waiting:
            _, i, a, b = heapq.heappop(waiting)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            last = (a, b)
            parts[i], parts[j], after[i] = a + b, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i]), offer(i)
        return [x for x in parts if x is not None], last

    def _blanks(self, n: int) -> list[int]:
        """Ids of n blanks: their pieces share the least score, so pairs merge from the left, halving the run again and again."""
        if n not in self.runs:
            self.runs[n] = [self.id[p] for p in self._merged(BLANK * n)[0]]
            if len(self.runs) > 1000:
                return self.runs.pop(n)
        return self.runs[n]

    def _fits(self, a: int, b: int) -> bool:
        """Whether piece b may follow piece a: no pair across the joint merges before it is gone."""
        if a >= self.size or b >= self.size:  # the beginning, or a character without a piece
            return True
        right, left = self.rights[a], self.lefts[b]
        i, j = len(right) - 1, len(left) - 1
        while True:
            e1 = self.rank[right[i - 1]] if i else NEVER
            e2 = self.rank[left[j - 1]] if j else NEVER
            m = self.rank.get(right[i] + left[j])
            if m is not None and m < e1 and m <= e2:
                return False
            if i == j == 0:
                return True
            if e1 <= e2:
                i -= 1
            else:
                j -= 1

    def _fitting(self, pairs: np.ndarray) -> np.ndarray:
        """_fits of pairs a * (size + 2) + b, each worked out once per worker."""
        place = np.minimum(np.searchsorted(self.pair_keys, pairs), max(len(self.pair_keys) - 1, 0))
        new = np.unique(pairs[self.pair_keys[place] != pairs]) if len(self.pair_keys) else np.unique(pairs)
        if len(new):
            if len(self.pair_keys) > 4_000_000:
                self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
                return self._fitting(pairs)
            width = self.size + 2
            fits = np.array([self._fits(x // width, x % width) for x in new.tolist()], bool)
            at = np.searchsorted(self.pair_keys, new)
            self.pair_keys, self.pair_fits = np.insert(self.pair_keys, at, new), np.insert(self.pair_fits, at, fits)
            place = np.searchsorted(self.pair_keys, pairs)
        return self.pair_fits[place]

    def _raw(self, text: str | None) -> bytes:
        return (BLANK + text.replace(" ", BLANK)).encode() if text else b""

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        blank = np.zeros(len(data), bool)
        blank[:-2] = (data[:-2] == BLANK_BYTES[0]) & (data[1:-1] == BLANK_BYTES[1]) & (data[2:] == BLANK_BYTES[2])
        cut = blank.copy()
        cut[3:] &= ~blank[:-3]
        return cut

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has.

        Of several blanks the last goes to the word, unless the word takes none; all pieces of blanks
        alone have the least score of the model, so they merge after everything else.
        """
        width = len(BLANK_BYTES)
        blanks = [(len(x) - len(x.lstrip(BLANK_BYTES))) // width if x.startswith(BLANK_BYTES * 2) else 1 for x in chunks]
        alone = [n > 1 and n * width == len(x) for n, x in zip(blanks, chunks)]
        words = [b"" if a else x[(n - 1) * width :] for n, x, a in zip(blanks, chunks, alone)]
        parts: list = [None] * len(chunks)
        plain = [i for i, a in enumerate(alone) if not a]
        sizes = np.cumsum([len(words[i]) for i in plain])
        start = 0
        while start < len(plain):
            stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + INDEXED_BYTES)))
            own = plain[start:stop]
            ids, counts = self._relaxed([words[i] for i in own])
            for i, x in zip(own, np.split(ids, np.cumsum(counts)[:-1])):
                parts[i] = x
            start = stop
        for i, n in enumerate(blanks):
            if alone[i]:
                parts[i] = np.array(self._blanks(n), np.int64)
            elif n > 1:
                taken = int(parts[i][0]) != self.id[BLANK]
                parts[i] = np.concatenate([self._blanks(n - 1), parts[i]] if taken else [self._blanks(n), parts[i][1:]])
        counts = np.array([len(x) for x in parts], np.int32)
        return (np.concatenate(parts).astype(np.uint32) if parts else np.zeros(0, np.uint32)), counts

    def _relaxed(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        text = b"".join(chunks)
        n, k = len(text), len(self.usable)
        data = np.frombuffer(text + self.index_tail, np.uint8).astype(np.uint16)
        sizes = np.concatenate([np.array([len(x) for x in chunks], np.int64), self.piece_sizes, self.piece_sizes])
        # the second copy of every piece ends with a symbol above all bytes
        spots = np.cumsum(sizes)[len(chunks) + k :]
        data = np.insert(data, spots, 257)
        sizes[len(chunks) + k :] += 1
        ends = np.cumsum(sizes)
        left = np.repeat(ends, sizes) - np.arange(len(data))
        rank = suffix_ranks(data, left, self.depth)
        order = np.argsort(rank[:n], kind="stable")
        ordered = rank[order]
        begins = ends - sizes
        low = np.searchsorted(ordered, rank[begins[len(chunks) : len(chunks) + k]])
        high = np.searchsorted(ordered, rank[begins[len(chunks) + k :]])
        found = high - low
        at = order[ragged(low, found)]
        piece = np.repeat(np.arange(k), found)
        # characters without a piece are edges too
        lead = np.flatnonzero((data[:n] & 0xC0) != 0x80)
        length = np.diff(np.append(lead, n))
        has = np.zeros(n, bool)
        single = np.array([len(self.pieces[i]) == 1 for i in self.usable.tolist()])
        has[at[single[piece]]] = True
        bare = ~has[lead]
        at = np.concatenate([at, lead[bare]])
        name = np.concatenate([self.usable[piece], np.full(int(bare.sum()), self.size)])
        span = np.concatenate([self.piece_sizes[piece], length[bare]])
        owner = np.repeat(np.arange(len(chunks)), sizes[: len(chunks)])
        base = begins[: len(chunks)]
        to = at + span - base[owner[at]]  # place in the word that the edge reaches
        by = np.lexsort((at, to))
        at, name, span, to = at[by], name[by], span[by], to[by]
        cuts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
        # slot of place p of word w: begins[w] + w + p
        last = np.full(n + len(chunks), -1, np.int64)
        back = np.zeros(n + len(chunks), np.int64)
        last[base + np.arange(len(chunks))] = self.size + 1
        slot = at + owner[at]
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(to)]):
            before = last[slot[a:b]]
            ok = before >= 0
            good = np.flatnonzero(ok)
            good = good[self._fitting(before[good] * (self.size + 2) + name[a:b][good])]
            target = slot[a:b][good] + span[a:b][good]
            last[target], back[target] = name[a:b][good], slot[a:b][good]
        # from the ends of the words back to their beginnings
        word = np.arange(len(chunks))
        here = base + word + sizes[: len(chunks)]
        words, steps, names, places = [], [], [], []
        step = 0
        while len(word):
            words.append(word)
            names.append(last[here])
            places.append(back[here] - word)
            steps.append(np.full(len(word), -step))
            here = back[here]
            step += 1
            go = here > base[word] + word
            word, here = word[go], here[go]
        words, steps, names, places = (np.concatenate(x) for x in (words, steps, names, places))
        by = np.lexsort((steps, words))
        words, names, places = words[by], names[by], places[by]
        unknown = names == self.size
        char = np.zeros(n, np.int64)
        char[lead] = length
        many = np.where(unknown, char[places], 1)
        out = np.repeat(names, many)
        where = np.repeat(unknown, many)
        out[where] = self.byte_id[data[:n][ragged(places[unknown], many[unknown])]]
        return out, np.bincount(words, many, len(chunks)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of consecutive runs of ids: blanks for U+2581, and without the first one."""
        ids = ids.astype(np.int64)
        sizes = self.value_sizes[ids]
        data = self.values[ragged(self.value_starts[ids], sizes)].tobytes()
        at = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [data[a:b].decode(errors="replace").replace(BLANK, " ")[1:] for a, b in zip(at[:-1], at[1:])]


def piece_encoder(path: str) -> PieceEncoder:
    return kept(("pieces", path), lambda: PieceEncoder(path))


def encoded_pieces(docs: DataFrame, model: str) -> DataFrame:
    """doc_id and ids (array<int>) of each row."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_encoder(model)
        for batch in batches(rows, 8_000_000):
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, 3_000_000):
                ids, counts = own.encode(texts[a:b])
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32), ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), lists], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(frugal(run), "doc_id long, ids array<int>")


def decoded_texts(rows: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids)."""

    def run(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_encoder(model)
        for batch in batches_:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                ids = part.column("ids")
                texts = own.decode(np.asarray(ids.flatten()), np.asarray(ids.value_lengths().fill_null(0)).astype(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(frugal(run), "doc_id long, text string")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (little-endian uint32), decoded_sha256, exact (the decoded text is the text)."""
    import hashlib

    model = default_model()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = piece_encoder(model)
        for batch in batches(rows, 8_000_000):
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts, 3_000_000):
                ids, counts = own.encode(texts[a:b])
                back = own.decode(ids, counts)
                at = np.concatenate([[0], np.cumsum(counts)]).tolist()
                raw = ids.astype("<u4")
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(at[:-1], at[1:])]
                sha = [hashlib.sha256(x.encode()).hexdigest() for x in back]
                same = [x == (y or "") for x, y in zip(back, texts[a:b])]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), pa.array(counts), pa.array(crc, pa.int64()), pa.array(sha), pa.array(same)], names=["doc_id", "n_tokens", "ids_crc32", "decoded_sha256", "exact"])

    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(frugal(run), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, exact boolean")
