"""Token counts (operator 12): overlap resynchronisation of huge documents.

Texts of at most ``CHUNK`` characters go to the tokenizer whole. A longer text is cut into chunks of
``CHUNK`` characters that overlap the next by ``OVERLAP``; chunks are rows of their own, so one document's work
spreads over tasks. Every chunk is encoded with offsets and reports, for both of its overlaps, the
places where a piece (pre-token) begins and the tokens before it.

Two neighbours are spliced at the first place where both begin a piece. That is enough, and proven: the
tokenizer cuts pieces by scanning to the right, what it cuts from a place on depends only on the text
from there on, and no token crosses a piece. A chunk's last pieces may look different without the text that
follows, so a left chunk only vouches for the start of a piece whose predecessors were settled by text inside the chunk
(``MARGIN`` characters, more than the longest special string or lookahead, before its end). A chunk's
first pieces may be wrong too, but a place that its left neighbour confirms is right.

Pieces are found in two steps. A space or line feed after a character that is no white space always begins a piece, because
white space only stands alone or leads a piece; the runs between such places (``RUN``) are therefore encoded apart, each different
run once a worker (at most ``REMEMBERED`` are kept). Runs of more than ``LONG`` characters are encoded with the library's offsets, which
give the pieces inside.

Documents with a seam where nothing is common (a piece longer than the overlap) are cut anew with
chunks and overlaps ``WIDEN`` times as long, until every seam is spliced or the chunk is the whole text.

The count is a function of the text alone, so chunks go by the text's SHA-256: equal huge texts are encoded once,
and a lost executor's chunks come out the same again. Short rows are never shuffled.

Defined results: null and empty texts have 0 bytes and 0 tokens; special strings inside a text count as one token, as is the
library's default; repeated rows and null ids keep a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm.common import staged

CHUNK, OVERLAP, WIDEN = 16_384, 512, 4
MARGIN = 32
LIMIT = 1024
#: Characters that are encoded at once.
AT_ONCE = 1 << 19
REMEMBERED, LONG = 1_000_000, 64

# All that any definition calls white space, so that no other character does; the first two may begin a run.
_SPACES = " \n\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
RUN = re.compile(f"[{_SPACES}]*[^{_SPACES}]*(?:[{_SPACES[2:]}][{_SPACES}]*[^{_SPACES}]*)*")
#: A run that is one piece, or two, whatever the Unicode version: letters of ASCII and Latin, perhaps after
#: a space, and perhaps marks (none that begins a contraction or a special string).
WORD = re.compile("([ ]?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f]+)([-.,;:!?)\"]+)?")

_CHUNKS = "key string, place int, chunk_text string"
_SEAMS = "key string, place int, tokens long, head_at array<int>, head_n array<int>, tail_at array<int>, tail_n array<int>"


def load(path: str):
    """The tokenizer of a file; offsets keep the spaces that belong to a token, and specials add nothing."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, processors

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.post_processor = processors.ByteLevel(trim_offsets=False)
    return tok


def chunks(text: str, size: int, overlap: int) -> Iterator[tuple[int, str]]:
    """(place, text) of the overlapping chunks; the last may be short, but none lies inside another."""
    for place, start in enumerate(range(0, max(1, len(text) - overlap), size)):
        yield place, text[start : start + size + overlap]


@cache
def runs_of(path: str) -> Runs:
    """A worker's ``Runs``, kept from task to task."""
    return Runs(path)


class Runs:
    """Token counts of the runs of texts, each different run encoded once."""

    def __init__(self, path: str) -> None:
        self.tok = load(path)
        self.known: dict[str, int] = {"": 0}
        to_letters = self.tok.pre_tokenizer.pre_tokenize_str
        self.spelled = {b: to_letters(chr(b))[0][0][-1] for b in range(192)}  # as the last byte of U+0000 to U+00BF
        self.spelled |= {b: to_letters(chr((b - 192) << 6))[0][0][0] for b in range(194, 224)}  # as the first of two bytes

    def cut(self, texts: list[str]) -> list[list[str]]:
        """The runs of each text; ``known`` has the tokens of all of them until the next call."""
        found = [RUN.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known = {"": 0}
        others = []
        for run in set().union(*found).difference(self.known):
            plain = WORD.fullmatch(run)
            if plain:
                word, marks = plain.groups()
                self.known[run] = self.piece(word) + (self.piece(marks) if marks else 0)
            else:
                others.append(run)
        for run, e in zip(others, self.tok.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.known[run] = len(e)
        return found

    def piece(self, text: str) -> int:
        """Tokens of one piece: the model alone, spelled in its letters for bytes."""
        n = self.known.get(text)
        if n is None:
            n = len(self.tok.model.tokenize(text.encode().decode("latin-1").translate(self.spelled)))
            if len(text) <= LONG:
                self.known[text] = n
        return n

    def forget(self, found: list[list[str]]) -> None:
        """Long runs are not kept: few come again."""
        for run in {r for runs in found for r in runs if len(r) > LONG}:
            del self.known[run]

    def count(self, texts: list[str]) -> list[int]:
        found = self.cut(texts)
        out = [sum(map(self.known.__getitem__, runs)) for runs in found]
        self.forget(found)
        return out

    def starts(self, text: str) -> tuple[list[int], list[int], int]:
        """Places where pieces begin, the tokens before each, and the text's tokens."""
        (runs,) = found = self.cut([text])
        counts = [self.known[r] for r in runs]
        at = list(accumulate(map(len, runs), initial=0))[:-1]
        before = list(accumulate(counts, initial=0))
        total = before.pop()
        self.forget(found)
        for run, start, n in [x for x in zip(runs, at, before, strict=True) if len(x[0]) > LONG]:
            inside, counted = pieces(self.tok.encode(run, add_special_tokens=False))
            at += [start + i for i in inside[1:]]
            before += [n + c for c in counted[1:]]
        return at, before, total


def pieces(encoding) -> tuple[list[int], list[int]]:
    """Where pieces begin in an encoded run, and the number of tokens before each."""
    at, before, last = [], [], object()
    for n, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word is None or word != last:
            at.append(start)
            before.append(n)
        last = word
    return at, before


def _groups(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    i, size = 0, 0
    for j, t in enumerate(texts):
        size += len(t)
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)


def _whole(texts: DataFrame, path: str) -> DataFrame:
    """n_tokens of every row from its runs."""
    kind = texts.schema["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(path)
        for b in batches:
            found = b["text"].to_pylist()
            for i, j in _groups(found, AT_ONCE):
                n = runs.count(found[i:j])
                yield pa.RecordBatch.from_arrays([b["doc_id"][i:j], b["n_bytes"][i:j], pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return texts.mapInArrow(run, T.StructType([kind, texts.schema["n_bytes"], T.StructField("n_tokens", T.LongType())]))


def _cut(texts: DataFrame, size: int, overlap: int) -> DataFrame:
    """Chunks of the distinct texts, a row each, spread by key and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(len(b)):
                text = b["text"][k].as_py()
                key = hashlib.sha256(text.encode()).hexdigest()
                held, length = [], 0
                for place, part in chunks(text, size, overlap):
                    held.append((place, part))
                    length += len(part)
                    if length > AT_ONCE:
                        yield _chunk_batch(key, held)
                        held, length = [], 0
                if held:
                    yield _chunk_batch(key, held)

    cut = texts.select("text").mapInArrow(run, _CHUNKS)
    return cut.groupBy("key", "place").agg(F.any_value("chunk_text").alias("chunk_text"))


def _chunk_batch(key: str, held: list[tuple[int, str]]) -> pa.RecordBatch:
    place, part = zip(*held, strict=True)
    return pa.RecordBatch.from_arrays([pa.array([key] * len(held)), pa.array(place, pa.int32()), pa.array(part)], names=["key", "place", "chunk_text"])


def _seams(cut: DataFrame, path: str, size: int, overlap: int) -> DataFrame:
    """Encodes every chunk: its tokens, and the starts of pieces in both overlaps (head: from the
    chunk's start; tail: from ``size``, counted from there)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = runs_of(path)
        for b in batches:
            for k in range(len(b)):
                text = b["chunk_text"][k].as_py()
                at, before, tokens = runs.starts(text)
                head = [i for i, x in enumerate(at) if x < overlap]
                tail = [i for i, x in enumerate(at) if size <= x < len(text) - MARGIN] if len(text) == size + overlap else []
                lists = [[at[i] for i in head], [before[i] for i in head], [at[i] - size for i in tail], [before[i] for i in tail]]
                columns = [b["key"][k : k + 1], b["place"][k : k + 1], pa.array([tokens], pa.int64())]
                columns += [pa.array([x], pa.list_(pa.int32())) for x in lists]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "place", "tokens", "head_at", "head_n", "tail_at", "tail_n"])

    return cut.mapInArrow(run, _SEAMS)


def _spliced(seams: DataFrame) -> DataFrame:
    """(key, n_tokens, whole): the tokens of each text, and whether every seam was spliced."""
    right = seams.select("key", (F.col("place") - 1).alias("place"), F.col("head_at").alias("r_at"), F.col("head_n").alias("r_n"))
    pairs = seams.join(right, ["key", "place"], "left")
    common = F.array_min(F.array_intersect("tail_at", "r_at"))
    x = pairs.withColumn("x", common)
    end = F.element_at("tail_n", F.array_position("tail_at", F.col("x")).cast("int"))
    skipped = F.element_at("r_n", F.array_position("r_at", F.col("x")).cast("int"))
    open_end = F.col("r_at").isNull()
    here = F.when(open_end, F.col("tokens")).otherwise(end - skipped)
    return x.groupBy("key").agg(
        F.sum(here).cast("long").alias("n_tokens"), F.every(open_end | F.col("x").isNotNull()).alias("whole")
    )


def count_tokens(
    docs: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP, widen: int = WIDEN, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    long = F.char_length("text") > chunk
    short = _whole(texts.where(~long), path)
    huge = texts.where(long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    rows, known, left = staged(huge.select("doc_id", "n_bytes", "key"), "op12-rows"), None, huge
    size, over = chunk, overlap
    while True:
        seams = staged(_seams(_cut(left, size, over), path, size, over), "op12-seams")
        found = staged(_spliced(seams), "op12-counts")
        done = found.where("whole").select("key", "n_tokens")
        known = done if known is None else known.unionByName(done)
        failed = found.where(~F.col("whole")).select("key")
        if failed.isEmpty():
            break
        left = huge.join(failed, "key", "left_semi")
        size, over = size * widen, over * widen
    counted = short.unionByName(rows.join(known, "key").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
