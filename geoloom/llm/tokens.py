"""Encoding with the ``tokenizers`` library, each distinct chunk of text once per worker.

A pre-token of a byte-level BPE never holds white space after other characters, and a run of ASCII
letters ends before ASCII sentence marks, so a text may be cut at those places.  The chunks repeat a
lot; numpy cuts the texts of a slice into chunks, hashes them (64 bits, with their lengths), and only
chunks that the worker has not seen are encoded: many to a call, joined where the joint is such a
place, the ids dealt back by the byte lengths of the tokens.  The store has a fixed bound and is
dropped when full, which costs time, never results.
"""

from __future__ import annotations

import os

import numpy as np

from .common import kept

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
MARK = np.zeros(256, bool)
MARK[[ord(x) for x in ".,!?;:"]] = True
#: Bytes that lead characters some of which are white space; no cut is made right after those.
LEADS = np.zeros(256, bool)
LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
#: Chunks joined to one call's text; longest chunk, in bytes, that is kept.
TOGETHER, KEPT_BYTES = 256, 64
BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def default_tokenizer() -> str:
    """Path of the byte-level BPE file that the queries use; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


#: Powers that a process keeps; longer runs of them are worked out each time.
POWERS = 1 << 20


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, n at least."""
    if _powers and n <= POWERS:
        return _powers[0], _powers[1]
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    made = [np.cumprod(np.full(max(n, POWERS), x, np.uint64)) for x in (BASE, inverse)]
    if n <= POWERS:
        _powers[:] = made
    return made[0], made[1]


def byte_table() -> np.ndarray:
    """A fixed random odd 64-bit value for each byte."""
    return np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte values times powers: element i covers the bytes before i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_table()[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, the same wherever the span stands."""
    h = (prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts]
    h ^= h >> np.uint64(31)
    h = (h + (ends - starts).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indexes starts[i], starts[i]+1, ... (counts[i] of them), for all i in a row."""
    total = int(counts.sum())
    at = np.cumsum(counts) - counts
    return np.repeat(starts - at, counts) + np.arange(total)


class ChunkEncoder:
    """Encodes texts, keeping the ids of at most about ``entries`` chunks."""

    def __init__(self, path: str, entries: int = 2_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocab = self.tokenizer.get_vocab()
        self.lengths = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():  # byte-level tokens have one character for each byte
            self.lengths[i] = len(token)
        self.entries = entries
        self._drop()

    def _drop(self) -> None:
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts, self.ids = np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, np.uint32) for x in done]

    def _encode_chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and how many each has."""
        joins = [len(x) > 1 and SPACE[x[0]] and x[-1] < 128 and not SPACE[x[-1]] for x in chunks]
        counts = np.zeros(len(chunks), np.int32)
        parts: list[np.ndarray | None] = [None] * len(chunks)
        order = [i for i, x in enumerate(joins) if x]
        for a in range(0, len(order), 32 * TOGETHER):
            groups = [order[b : b + TOGETHER] for b in range(a, min(a + 32 * TOGETHER, len(order)), TOGETHER)]
            for group, ids in zip(groups, self._ids([b"".join([chunks[i] for i in g]).decode() for g in groups])):
                ends = np.cumsum([len(chunks[i]) for i in group])
                at = np.searchsorted(np.cumsum(self.lengths[ids]), ends, "right").tolist()
                for i, b, e in zip(group, [0, *at[:-1]], at):
                    parts[i] = ids[b:e]
        alone = [i for i, x in enumerate(joins) if not x]
        for a in range(0, len(alone), 4096):
            for i, ids in zip(alone[a : a + 4096], self._ids([chunks[i].decode() for i in alone[a : a + 4096]])):
                parts[i] = ids
        for i, x in enumerate(parts):
            counts[i] = len(x)
        return (np.concatenate(parts) if parts else np.zeros(0, np.uint32)), counts

    def _raw(self, text: str | None) -> bytes:
        return (text or "").encode()

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a chunk may begin at each byte."""
        space = SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = (space[1:] & ~space[:-1]) | (MARK[data[1:]] & LETTER[data[:-1]])
        for back in (2, 3):  # a character of two or three bytes that may be white space stands before
            cut[back:] &= ~(LEADS[data[:-back]] & (data[back - 1 : -1] >= 128))
        return cut

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (uint32), and how many each text has; null counts as empty."""
        raw = [self._raw(x) for x in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        sizes = np.array([len(x) for x in raw], np.int64)
        ends = np.cumsum(sizes)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cut = self._cuts(data)
        cut[(ends - sizes)[sizes > 0]] = True
        starts = np.flatnonzero(cut)
        stops = np.append(starts[1:], len(data))
        hashes = span_hashes(prefix_hashes(data), starts, stops)
        keys, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) > self.entries:
            self._drop()
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(place, len(self.keys) - 1)] == keys
        new = np.flatnonzero(~known)
        blob = data.tobytes()
        ids, counts = self._encode_chunks([blob[a:b] for a, b in zip(starts[first[new]].tolist(), stops[first[new]].tolist())])
        at, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        at[known], n[known] = self.at[place[known]], self.counts[place[known]]
        at[new], n[new] = len(self.ids) + np.cumsum(counts) - counts, counts
        pool = np.concatenate([self.ids, ids])
        short = (stops[first[new]] - starts[first[new]]) <= KEPT_BYTES
        self.keys = np.insert(self.keys, place[new[short]], keys[new[short]])
        self.at = np.insert(self.at, place[new[short]], at[new[short]])
        self.counts = np.insert(self.counts, place[new[short]], counts[short])
        out = pool[ragged(at[inverse], n[inverse])]
        long = int(counts[~short].sum())
        if long > 1_000_000:  # do not keep the ids of long chunks
            keep = np.repeat(short, counts)
            shift = np.cumsum(np.where(short, 0, counts)) - np.where(short, 0, counts)
            where = np.searchsorted(self.keys, keys[new[short]])
            self.at[where] -= shift[short]
            pool = np.concatenate([self.ids, ids[keep]])
        self.ids = pool
        total = np.concatenate([[0], np.cumsum(n[inverse])])
        bounds = total[np.searchsorted(starts, ends)]
        return out, np.diff(bounds, prepend=0)


def encoder(path: str, entries: int = 2_000_000) -> ChunkEncoder:
    """The encoder of this process for a file; Python workers are reused, and so is its store."""
    return kept(("chunks", path, entries), lambda: ChunkEncoder(path, entries))


def slices(texts: list[str | None], most: int = 4_000_000):
    """Index ranges of consecutive texts that hold about ``most`` characters each."""
    start = size = 0
    for i, x in enumerate(texts):
        size += len(x or "")
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
