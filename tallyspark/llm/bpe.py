"""Byte-level BPE encoding and decoding (operator 8) by corpus-level merge replay.

A task takes a block of documents as its corpus: the different pieces (pattern matches) of all its
texts, each once, as one line of byte tokens. An inverted index leads from the pairs of neighbouring
tokens of a band of ranks to the places where they stand; merges are replayed over the whole corpus in the order of
these bands, the lowest first, and inside a band in rounds: each piece that has places in the band
merges at its lowest rank, all pieces at once. A merge updates its two neighbours only, whose new pairs
join the index. Pieces above ``LONG`` bytes, for which rounds would be many, are replayed rank by rank instead. Texts are then put together from their pieces' ids. Pieces that a task has
replayed stay known to it (up to a bounded number); blocks share nothing else, so there is no
shuffle and no broadcast, and a lost task is simply run again.

A vocabulary may give a longer token a lower rank than one of its parts, so a merge can create a
pair of a lower rank than its own. It is then its piece's lowest in the next round; rank by rank, the rest of
the piece waits until the lower one is done, as it would in an encoder that looks at one piece at a time.

Defined results: null text is an empty text (no ids, no bytes); equal rows give equal ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import packed

#: Text replayed together (a corpus whose index stays in a core's cache), and the pieces a task remembers.
CORPUS_BYTES, REMEMBERED = 1 << 19, 400_000
#: Bytes of the longest piece that is replayed in rounds, and bits of a rank within its band.
LONG, BAND_BITS = 64, 12


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


#: More than any rank: a pair that does not merge.
NEVER = 1 << 30


class PairRanks(dict):
    """The token that a pair (left << 24 | right) merges into, which is also the merge's rank; NEVER without one."""

    def __init__(self, ranks: dict[bytes, int], token: dict[int, bytes]) -> None:
        self.ranks, self.token = ranks, token

    def __missing__(self, pair: int) -> int:
        rank = self[pair] = self.ranks.get(self.token[pair >> 24] + self.token[pair & 0xFFFFFF], NEVER)
        return rank

    def of(self, pairs: np.ndarray) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pairs.tolist()), np.int64, len(pairs))


class MergeReplay:
    """Replays the merges of one vocabulary over sets of pieces."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.decimal = {i: str(i).encode() for i in self.token}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.byte_pair = np.array([[ranks.get(bytes([a, b]), NEVER) for b in range(256)] for a in range(256)], dtype=np.int64)
        self.known = PairRanks(ranks, self.token)

    def pair_rank(self, a: int, b: int) -> int:
        return self.known[a << 24 | b]

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [p for p, w in zip(pieces, whole, strict=True) if w is None]
        short = iter(self.in_rounds([p for p in rest if len(p) <= LONG]))
        long = iter(self._replayed([p for p in rest if len(p) > LONG]))
        return [[w] if w is not None else next(short if len(p) <= LONG else long) for p, w in zip(pieces, whole, strict=True)]

    def _line(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One line of byte tokens for all pieces, where -1 stands before, between and behind them; where
        these borders are; and the rank at which the pair that begins at a place merges."""
        raw = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", dtype=np.uint8)
        border = np.concatenate([[0], np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)])
        tokens = self.byte[raw]
        tokens[border] = -1
        first = np.full(len(raw), NEVER, dtype=np.int64)
        first[:-1] = self.byte_pair[raw[:-1], raw[1:]]
        first[border] = NEVER
        first[border[1:] - 1] = NEVER
        return tokens, border, first

    @staticmethod
    def _ids(line: np.ndarray, border: np.ndarray) -> list[list[int]]:
        """The tokens that are left of each piece."""
        live = np.flatnonzero(line >= 0)
        flat, at = line[live].tolist(), np.searchsorted(live, border).tolist()
        return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]

    def in_rounds(self, pieces: list[bytes], band_bits: int = BAND_BITS) -> list[list[int]]:
        """The ids of pieces of at most 65,535 bytes: merges replayed by bands of ranks, in a round one of each piece."""
        if not pieces:
            return []
        line, border, rank_at = self._line(pieces)
        piece = np.cumsum(line == -1) - 1  # of each place
        after, before = np.arange(1, len(line) + 1), np.arange(-1, len(line) - 1)
        index: dict[int, list[np.ndarray]] = {}  # band: places
        queue: list[int] = []

        def add(places: np.ndarray) -> None:
            bands = rank_at[places] >> band_bits
            order = np.argsort(bands, kind="stable")
            places, bands = places[order], bands[order]
            cuts = np.flatnonzero(np.diff(bands, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(places)], strict=False):
                band = int(bands[a])
                if band not in index:
                    index[band] = []
                    heapq.heappush(queue, band)
                index[band].append(places[a:b])

        add(np.flatnonzero(rank_at < NEVER))
        while queue:
            band = heapq.heappop(queue)
            places = np.concatenate(index.pop(band))
            while True:
                places = places[rank_at[places] >> band_bits <= band]  # others were taken by a neighbour's merge
                if not len(places):
                    break
                # Of each piece the lowest rank, and its first place.
                of = piece[places]
                keys = np.sort(of << 40 | rank_at[places] << 16 | places - border[of])
                of = keys >> 40
                here = border[of] + (keys & 0xFFFF)
                lowest = np.diff(of, prepend=-1) != 0
                i, places = here[lowest], here[~lowest]
                rank, j, h = rank_at[i], after[i], before[i]
                k = after[j]
                line[i], line[j], after[i], before[k], rank_at[j] = rank, -2, k, i, NEVER
                right, left = line[k], line[h]
                r, l = right >= 0, left >= 0  # noqa: E741
                rank_at[i] = NEVER
                rank_at[i[r]] = self.known.of(rank[r] << 24 | right[r])
                rank_at[h[l]] = self.known.of(left[l] << 24 | rank[l])
                new = np.concatenate([i[r], h[l]])
                bands = rank_at[new]
                new, bands = new[bands < NEVER], bands[bands < NEVER] >> band_bits
                places = np.concatenate([places, new[bands <= band]])
                add(new[bands > band])
        return self._ids(line, border)

    def _replayed(self, pieces: list[bytes]) -> list[list[int]]:
        """The ids of each piece: merges replayed rank by rank, at all places of a rank in turn."""
        if not pieces:
            return []
        tokens, border, first = self._line(pieces)
        # The inverted index: where the pairs of a merge stand, by its rank.
        places = np.flatnonzero(first < NEVER)
        places = places[np.argsort(first[places], kind="stable")]
        cuts = np.flatnonzero(np.diff(first[places], prepend=-1)).tolist()
        index = {int(first[places[a]]): places[a:b].tolist() for a, b in zip(cuts, [*cuts[1:], len(places)], strict=False)}
        line, rank_at = tokens.tolist(), first.tolist()
        after, before = list(range(1, len(line) + 1)), list(range(-1, len(line) - 1))
        queue, known, pair_rank = list(index), self.known, self.pair_rank
        heapq.heapify(queue)
        while queue:
            rank = heapq.heappop(queue)
            here = sorted(index.pop(rank, ()))
            waits_until, held = -1, []
            for i in here:
                if rank_at[i] != rank:
                    continue  # a neighbour's merge has taken one of the two
                if i < waits_until:
                    held.append(i)
                    continue
                j = after[i]
                k, h = after[j], before[i]
                line[i], line[j] = rank, -2
                after[i], before[k] = k, i
                rank_at[j] = NEVER
                lower = False
                right = line[k]
                if right < 0:
                    rank_at[i] = NEVER
                else:
                    new = known.get(rank << 24 | right)
                    if new is None:
                        new = pair_rank(rank, right)
                    rank_at[i] = new
                    if new < NEVER:
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heapq.heappush(queue, new)
                        lower = new < rank
                left = line[h]
                if left >= 0:
                    new = known.get(left << 24 | rank)
                    if new is None:
                        new = pair_rank(left, rank)
                    rank_at[h] = new
                    if new < NEVER:
                        if new in index:
                            index[new].append(h)
                        else:
                            index[new] = [h]
                            heapq.heappush(queue, new)
                        lower = lower or new < rank
                if lower:  # the rest of this piece waits for the lower rank
                    waits_until = int(border[np.searchsorted(border, i)])
            if held:
                if rank in index:
                    index[rank].extend(held)
                else:
                    index[rank] = held
                    heapq.heappush(queue, rank)
        return self._ids(np.array(line, dtype=np.int64), border)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join([self.token[i] for i in ids])


def _corpora(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` characters, whole texts only."""
    i, total = 0, 0
    for j, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield i, j + 1
            i, total = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def encode(docs: DataFrame, vocabulary: str, pattern: str, with_ids: bool = True, corpus_bytes: int = CORPUS_BYTES) -> DataFrame:
    """Every row of ``docs`` without its text (struct ``_doc``), n_tokens, ids_sha256, decoded_sha256
    and, unless switched off, ``ids``.

    ids_sha256 is of the decimal ids joined by one space; decoded_sha256 of the bytes that the ids
    decode to. ``vocabulary`` is a path on every machine (an installed file).
    """
    rows = docs.select(packed(docs.drop("text")), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay, pieces_of = MergeReplay(load_ranks(vocabulary)), regex.compile(pattern).findall
        known: dict[str, tuple[bytes, bytes, bytes]] = {}  # decimal ids, decoded bytes, ids as 32-bit numbers
        for b in batches:
            texts = b["_text"].to_pylist()
            for i, j in _corpora(texts, corpus_bytes):
                cut = [pieces_of(t) for t in texts[i:j]]
                if len(known) > REMEMBERED:
                    known.clear()
                new = list(set().union(*cut).difference(known))
                for p, ids in zip(new, replay.encode([p.encode() for p in new]), strict=True):
                    spelled = b" ".join([replay.decimal[x] for x in ids])
                    known[p] = (spelled, replay.decode(ids), array("i", ids).tobytes() if with_ids else b"")
                n, id_hash, byte_hash, packed_ids = [], [], [], []
                for ps in cut:
                    got = [known[p] for p in ps]
                    spelled = b" ".join([g[0] for g in got])
                    n.append(spelled.count(b" ") + 1 if got else 0)
                    id_hash.append(hashlib.sha256(spelled).hexdigest())
                    byte_hash.append(hashlib.sha256(b"".join([g[1] for g in got])).hexdigest())
                    if with_ids:
                        packed_ids.append(b"".join([g[2] for g in got]))
                columns = [b["_doc"][i:j], pa.array(n, pa.int64()), pa.array(id_hash, pa.string()), pa.array(byte_hash, pa.string())]
                names = ["_doc", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    flat = pa.array(np.frombuffer(b"".join(packed_ids), dtype=np.int32))
                    columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), flat))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [rows.schema["_doc"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    return rows.mapInArrow(run, T.StructType(fields))


def decode(rows: DataFrame, vocabulary: str, column: str = "ids") -> DataFrame:
    """``rows`` with ``text``, what the ids decode to; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = MergeReplay(load_ranks(vocabulary))
        for b in batches:
            texts = [None if ids is None else replay.decode(ids).decode("utf-8", "replace") for ids in b[column].to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "text"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))
