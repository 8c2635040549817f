"""Two tokenizers aligned over the same bytes, with corpus-wide counts of the ids that meet.

Each text is spelled by two vocabularies, A and B. Byte offsets where tokens of both end cut it into groups;
two tokens are linked where their byte ranges overlap. How often a pair of ids meets is counted over the
corpus by external counting with runs:

1. Documents are dealt into blocks. A block writes its documents' links and one *run*: its different id
   pairs in order of (A, B), each with the number of its documents that hold the pair. However many
   documents share a pair, it is one record of a run.
2. Runs are cut by a radix of the A id and shuffled as compressed pieces. For each radix a heap over the
   runs' next A ids merges them: as pairs come A by A, an A id's counts and their maximum are known
   together, and are at once streamed back into the places of the runs that asked.
3. What comes back to a block is as long as its run, and its documents sum over their links.

The number of radixes follows the number of records, so a merging task holds a bounded share whatever the
size; blocks are bounded in characters. Nothing passes through the driver but that number.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orelode.llm.common import STEP_CHARS, steps
from orelode.llm.words import mix
from orelode.sources.paths import materialise

#: Characters of a block, unless one text is longer, and its rows.
BLOCK_CHARS, BLOCK_ROWS = 6_000_000, 20_000
#: Words that a worker remembers, and their characters, beside those of the texts it is at.
KNOWN_WORDS, KNOWN_CHARS = 300_000, 4_000_000
#: Where a blank stands between two signs that are no white space, both tokenizers begin anew: A's pattern
#: takes the blank with what follows, and no piece of B runs from another sign into a blank.
WORDS = re.compile(r"(?<=\S) (?=\S)")
#: Records that the runs of one radix hold together, about.
RADIX_RECORDS = 2_000_000
#: Ids stay below this, so a pair is one number.
_BITS = np.uint64(24)
_LOW = np.uint64((1 << 24) - 1)
BLOCKS = (
    "block long, part int, ids binary, n_pairs long, pairs binary, counts binary, rows binary, "
    "links binary, times binary"
)
_COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def _pack(values: np.ndarray, dtype: str) -> bytes:
    """Numbers of one type as zstd; ascending ones are best given as differences."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values, dtype).tobytes())


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype)


class Aligner:
    """The two vocabularies and the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = _byte_level(self.a)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        self.sizes_a, self.sizes_b = (
            np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b)
        )
        self.forget()

    def align(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Per text the four numbers; all links as (text, pair); per text the digest of its groups.

        Tokens of both vocabularies end where words do, so a text's links and groups are those of its
        words. Each different word is aligned once and remembered.
        """
        words = [WORDS.split(t) if t else [] for t in texts]
        known = self.known
        new = list(dict.fromkeys(w for own in words for w in own if w not in known))
        if new:
            if len(known) + len(new) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
                self.forget()
                new = list(dict.fromkeys(w for own in words for w in own))
            self._learn(new)
        get, table = self.known.__getitem__, np.concatenate(self.numbers) if len(self.numbers) > 1 else self.numbers[0]
        self.numbers = [table]
        numbers, digests, links, owner = np.zeros((len(texts), 4), np.int64), [""] * len(texts), [], []
        for i, own in enumerate(words):
            slots = list(map(get, own))
            sums = table[slots].sum(0) if own else None
            if own and not sums[4]:
                numbers[i] = sums[:4]
                digests[i] = hashlib.sha256(";".join([self.groups[s] for s in slots]).encode()).hexdigest()
                links += [self.links[s] for s in slots]
                owner.append((i, sums[3]))
        rows = np.repeat(*np.array(owner, np.int64).reshape(-1, 2).T)
        pairs = np.frombuffer(b"".join(links), np.uint64)
        return numbers, np.column_stack([rows.astype(np.uint64), pairs]), digests

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.links: list[bytes] = []
        self.groups: list[str] = []
        self.numbers = [np.zeros((0, 5), np.int64)]
        self.chars = 0

    def _learn(self, words: list[str]) -> None:
        """Aligns words; the fifth number of each says whether a vocabulary does not spell it."""
        of_a = [e.ids for e in self.a.encode_batch_fast([f" {w}" for w in words], add_special_tokens=False)]
        of_b = self.b.encode(words, num_threads=1)
        numbers = np.zeros((len(words), 5), np.int64)
        links, groups = [b""] * len(words), [""] * len(words)
        whole = []
        for i, (word, a, b) in enumerate(zip(words, of_a, of_b)):
            data = b" " + word.encode()
            if b"".join(map(self.bytes_a.__getitem__, a)) == data == b"".join(map(self.bytes_b.__getitem__, b)):
                whole.append(i)
        numbers[:, 4] = 1
        rows = np.array(whole, np.int64)
        numbers[rows, 4] = 0
        if whole:
            n_a, n_b = (np.array([len(ids[i]) for i in whole]) for ids in (of_a, of_b))
            a, b = (np.array([x for i in whole for x in ids[i]], np.int64) for ids in (of_a, of_b))
            # Byte offsets over all words one after the other: the ends of words are ends of both.
            end_a, end_b = np.cumsum(self.sizes_a[a]), np.cumsum(self.sizes_b[b])
            word_end = end_a[np.cumsum(n_a) - 1]
            common = np.intersect1d(end_a, end_b, assume_unique=True)
            # Between two neighbouring ends lies exactly one overlap of an A and a B token.
            ends = np.union1d(end_a, end_b)
            n_links = np.bincount(np.searchsorted(word_end, ends), minlength=len(rows))
            n_groups = np.bincount(np.searchsorted(word_end, common), minlength=len(rows))
            numbers[rows, :4] = np.column_stack([n_a, n_b, n_groups, n_links])
            pair = a[np.searchsorted(end_a, ends)].astype(np.uint64) << _BITS
            flat = (pair | b[np.searchsorted(end_b, ends)].astype(np.uint64)).tobytes()
            stops = (np.cumsum(n_links) * 8).tolist()
            for i, begin, stop in zip(whole, [0, *stops], stops):
                links[i] = flat[begin:stop]
            last = (np.cumsum(n_a + n_b) - 1).tolist()
            for i, written in zip(whole, _written(a, b, end_a, end_b, common, last)):
                groups[i] = written
        first = len(self.links)
        self.known |= {w: first + i for i, w in enumerate(words)}
        self.links += links
        self.groups += groups
        self.numbers.append(numbers)
        self.chars += sum(map(len, words))


def _written(a, b, end_a, end_b, common, last: list[int]) -> list[str]:
    """The groups of each word as ``a1,a2|b1;a3|b2,b3``; ``last`` has the words' last tokens."""
    group = np.concatenate([np.searchsorted(common, end_a), np.searchsorted(common, end_b)])
    side, ids = np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a, b])
    order = np.lexsort((side, group))  # stable: ids stay in order within group and side
    group, side, ids = group[order], side[order], ids[order]
    same = group[1:] == group[:-1]
    signs = np.where(same, np.where(side[1:] == side[:-1], ",", "|"), ";").tolist()
    parts = [x for pair in zip(map(str, ids.tolist()), [*signs, ""]) for x in pair]
    out, begin = [], 0
    for k in last:
        out.append("".join(parts[begin : 2 * k + 1]))
        begin = 2 * k + 2
    return out


def _byte_level(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    # Bytes that stand for themselves; the others follow from 256 on, in order.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = dict(zip(plain, map(chr, plain)))
    signs |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in signs)}
    back = {sign: byte for byte, sign in signs.items()}
    added = tokenizer.get_added_tokens_decoder()
    out = []
    for i in range(tokenizer.get_vocab_size()):
        token = tokenizer.id_to_token(i) or ""
        known = i not in added and all(c in back for c in token)
        out.append(bytes(back[c] for c in token) if known else token.encode())
    return out


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _blocks(path_a: str, path_b: str):
    """Rows ``(id, text)`` to blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part = _aligner(path_a, path_b), TaskContext.get().partitionId()
        number, held, chars = 0, [], 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for step in steps(texts, STEP_CHARS):
                own = texts[step]
                size = sum(len(t) for t in own if t)
                rows = sum(len(h[0]) for h in held)
                if held and (chars + size > BLOCK_CHARS or rows + len(own) > BLOCK_ROWS):
                    yield _block(held, part, number)
                    number, held, chars = number + 1, [], 0
                held.append((ids[step.start : step.stop].to_pylist(), *aligner.align(own)))
                chars += size
        if held:
            yield _block(held, part, number)

    return run


def _block(held: list, part: int, number: int) -> pa.RecordBatch:
    """One block: its documents, its run, and which pairs of the run each document holds how often."""
    ids, digests, rows, links, times, begin = [], [], [], [], [], 0
    for own_ids, numbers, own_links, own_digests in held:
        ids += own_ids
        digests += own_digests
        rows.append(numbers)
        # Different (document, pair) in order, with how many links each stands for.
        order = np.lexsort((own_links[:, 1], own_links[:, 0]))
        ordered = own_links[order]
        new = np.ones(len(ordered), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(1)
        at = np.flatnonzero(new)
        links.append(ordered[at] + np.array([begin, 0], np.uint64))
        times.append(np.diff(np.append(at, len(ordered))))
        begin += len(own_ids)
    links, times = np.concatenate(links), np.concatenate(times)
    pairs, place, counts = np.unique(links[:, 1], return_inverse=True, return_counts=True)
    per_row = np.bincount(links[:, 0].astype(np.int64), minlength=len(ids))
    columns = pa.table({"id": pa.array(ids, pa.string()), "digest": pa.array(digests, pa.string())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, columns.schema) as out:
        out.write_table(columns)
    return pa.RecordBatch.from_pydict(
        {
            "block": pa.array([(part << 32) | number], pa.int64()),
            "part": pa.array([part], pa.int32()),
            "ids": [zstandard.ZstdCompressor(level=1).compress(sink.getvalue())],
            "n_pairs": pa.array([len(pairs)], pa.int64()),
            "pairs": [_pack(np.diff(pairs, prepend=np.uint64(0)), "<u8")],
            "counts": [_pack(counts, "<u4")],
            "rows": [_pack(np.column_stack([np.concatenate(rows), per_row]), "<i8")],
            "links": [_pack(place, "<u4")],
            "times": [_pack(times, "<u4")],
        }
    )


def _radix(pairs: np.ndarray, n: int) -> np.ndarray:
    """The radix of each pair: its A id spread over ``n``."""
    return (mix(pairs >> _BITS) % np.uint64(n)).astype(np.int64)


def _cut(radixes: int):
    """Runs to their pieces by radix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, counts in zip(*(c.to_pylist() for c in batch.columns)):
                pairs, counts = np.cumsum(_unpack(pairs, "<u8"), dtype=np.uint64), _unpack(counts, "<u4")
                radix = _radix(pairs, radixes)
                order = np.argsort(radix, kind="stable")
                edges = np.searchsorted(radix[order], np.arange(radixes + 1))
                out = []
                for r in np.flatnonzero(np.diff(edges)).tolist():
                    own = order[edges[r] : edges[r + 1]]
                    out.append({
                        "radix": r, "block": block, "counts": _pack(counts[own], "<u4"),
                        "pairs": _pack(np.diff(pairs[own], prepend=np.uint64(0)), "<u8"),
                    })
                if out:
                    yield pa.RecordBatch.from_pylist(out, _PIECES)

    return run


_PIECES = pa.schema([("radix", pa.int32()), ("block", pa.int64()), ("counts", pa.binary()), ("pairs", pa.binary())])


def _merge(radix: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pieces of one radix, merged A id by A id; each gets its pairs' counts and maxima back."""
    runs = []
    for batch in batches:
        for block, counts, pairs in zip(*(batch.column(c).to_pylist() for c in ("block", "counts", "pairs"))):
            pairs = np.cumsum(_unpack(pairs, "<u8"), dtype=np.uint64)
            edges = np.append(np.flatnonzero(np.diff(pairs >> _BITS, prepend=np.uint64(1 << 40))), len(pairs))
            runs.append((block, pairs, _unpack(counts, "<u4"), edges, np.empty((len(pairs), 2), np.int64)))
    heap = [(int(run[1][0] >> _BITS), i, 0) for i, run in enumerate(runs)]
    heapq.heapify(heap)
    while heap:
        first = heap[0][0]
        met = []
        while heap and heap[0][0] == first:
            _, i, k = heap[0]
            _, pairs, counts, edges, _ = runs[i]
            begin, end = edges[k], edges[k + 1]
            met.append((i, begin, end))
            if k + 2 < len(edges):
                heapq.heapreplace(heap, (int(pairs[end] >> _BITS), i, k + 1))
            else:
                heapq.heappop(heap)
        every = np.concatenate([runs[i][1][begin:end] for i, begin, end in met])
        _, place = np.unique(every, return_inverse=True)
        total = np.bincount(place, np.concatenate([runs[i][2][begin:end] for i, begin, end in met])).astype(np.int64)
        best, total, at = total == total.max(), total[place], 0
        best = best[place]
        for i, begin, end in met:
            size = end - begin
            runs[i][4][begin:end, 0], runs[i][4][begin:end, 1] = total[at : at + size], best[at : at + size]
            at += size
    for block, _, _, _, back in runs:
        yield pa.RecordBatch.from_pydict({
            "block": pa.array([block], pa.int64()),
            "piece": [pa.scalar({"radix": radix[0].as_py(), "data": _pack(back, "<i8")}, _BACK)],
        })


_BACK = pa.struct([("radix", pa.int32()), ("data", pa.binary())])


def _results(radixes: int):
    """Blocks joined with what came back, to one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                pairs = np.cumsum(_unpack(row["pairs"], "<u8"), dtype=np.uint64)
                order = np.argsort(_radix(pairs, radixes), kind="stable")
                back = np.zeros((len(pairs), 2), np.int64)
                pieces = sorted(row["pieces"] or [], key=lambda p: p["radix"])
                if pieces:
                    back[order] = np.concatenate([_unpack(p["data"], "<i8").reshape(-1, 2) for p in pieces])
                rows = _unpack(row["rows"], "<i8").reshape(-1, 5)
                owner = np.repeat(np.arange(len(rows)), rows[:, 4])
                links, times = _unpack(row["links"], "<u4"), _unpack(row["times"], "<u4").astype(np.int64)
                sums = np.zeros((len(rows), 2), np.int64)
                np.add.at(sums, owner, back[links] * times[:, None])
                with pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(row["ids"])) as own:
                    table = own.read_all().combine_chunks()
                columns = [pa.array(rows[:, k]) for k in range(4)] + [pa.array(sums[:, 1]), pa.array(sums[:, 0])]
                names = ["id", *_COUNTED, "n_best", "count_sum", "groups_sha256"]
                yield pa.RecordBatch.from_arrays(
                    [table.column(0).combine_chunks(), *columns, table.column(1).combine_chunks()], names
                )

    return run


def align(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: its id and what its tokens by A and by B have to do with each other.

    ``path_a`` is a byte-level vocabulary of ``tokenizers``, ``path_b`` a model of ``sentencepiece``. The
    columns are ``n_a`` and ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose pair is its A
    id's most frequent in the corpus, ties included), ``count_sum`` (over its links, the number of documents
    that hold their pair) and ``groups_sha256``. Texts that are NULL or empty, and texts that a vocabulary
    does not spell byte by byte, have no tokens: zeros and an empty digest. Repeated rows are documents of
    their own. Ids may be NULL. An empty table gives an empty one; other columns play no part.
    """
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    blocks = materialise(rows.mapInArrow(_blocks(path_a, path_b), BLOCKS), "alignment-blocks")
    records = blocks.agg(F.coalesce(F.sum("n_pairs"), F.lit(0))).first()[0]
    radixes = max(8, -(-records // RADIX_RECORDS))
    pieces = blocks.select("block", "pairs", "counts").mapInArrow(
        _cut(radixes), "radix int, block long, counts binary, pairs binary"
    )
    back = pieces.groupBy("radix").applyInArrow(_merge, "block long, piece struct<radix int, data binary>")
    # A block has a piece per radix at most, and as many entries in all as its run.
    back = back.groupBy("block").agg(F.collect_list("piece").alias("pieces"))
    joined = blocks.join(back, "block", "left").select("pairs", "rows", "links", "times", "ids", "pieces")
    out = joined.mapInArrow(
        _results(radixes),
        "id string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string",
    )
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", doc_id)
