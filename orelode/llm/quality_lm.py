"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model counts character n-grams of order 4; words of most languages are too many for the counts of
word n-grams to say much about a single document. Its tables stay Spark tables: counts, continuation
counts and context sums, each grouped by its own key.

Scoring joins them with what the corpus holds, not with every character of it: a block of documents
asks once for each different n-gram in it. All blocks' n-grams are joined with the tables, shard by
shard down the orders, and the answers go back to their blocks, where each document's sum is taken.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import forget_others, free_name, frugal, give_back, row_sums, steps
from orelode.sources.paths import materialise

ORDER = 4
#: Bits of a symbol, which is a UTF-16 unit: no two characters fall together. 0xffff stands before a text.
BITS = 16
SYMBOLS, _BEFORE = 1 << BITS, (1 << BITS) - 1
#: Characters of a block of documents, unless one text is longer.
BLOCK_CHARS = 8_000_000
#: Characters that are scored in one step, unless one text is longer.
SCORED_CHARS = 250_000
#: Bits of the map that sets aside most documents without a trusted id before the join: 16 MB.
MARK_BITS = 27
#: Bits of one row of Spark's bitmap aggregates.
_ROW_BITS = 32_768
#: Parts of the documents; one is judged by the counts of the trusted ones in the other parts.
PARTS = 3
#: Share of a language's trusted documents that may lie above its upper limit, and below its lower one.
QUANTILE = 0.995
#: A text is too far off beyond this many times the quantile.
MARGIN = 1.2
#: Documents that a language's limits are pulled towards those of all languages by, and these towards USUAL.
WEIGHT = 100
#: How far off texts lie at most where nothing is known of it.
USUAL = 5.0


def grams(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each character, and where each text's begin."""
    own = [(t or "").encode("utf-16-le", "surrogatepass") for t in texts]
    size = np.fromiter(map(len, own), np.int64, len(own)) // 2
    symbols = np.frombuffer(b"".join(own), "<u2").astype(np.uint64)
    begins = np.concatenate([[0], np.cumsum(size)])
    codes = np.zeros(len(symbols), np.uint64)
    at = np.arange(len(symbols)) - np.repeat(begins[:-1], size)
    for k in range(ORDER):
        shifted = np.full(len(symbols), _BEFORE, np.uint64)
        shifted[k:] = symbols[: len(symbols) - k]
        if k:
            shifted[at < k] = _BEFORE
        codes |= shifted << np.uint64(BITS * k)
    return codes.view(np.int64), begins


def _counted(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if times is None:
        codes = np.sort(codes)
        at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else codes
        return codes[at], np.diff(np.append(at, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, times = codes[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else codes
    return codes[at], np.add.reduceat(times, at) if len(at) else times


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, gram, c) from compressed texts and the part each is in."""
    open_ = zstandard.ZstdDecompressor().decompress
    sums = {k: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for k in range(PARTS)}
    for batch in batches:
        packed, where = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
        texts = [None if b is None else open_(b).decode("utf-8", "surrogatepass") for b in packed]
        for k, (codes, times) in sums.items():
            own = [texts[i] for i in np.flatnonzero(where == k)]
            for rows in steps(own):
                more, n = _counted(grams(own[rows])[0])
                codes, times = _counted(np.concatenate([codes, more]), np.concatenate([times, n]))
            sums[k] = codes, times
    for k, (codes, times) in sums.items():
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(codes), k, np.int32)), pa.array(codes),
            pa.array(times.astype(np.int64)),
        ], names=["part", "gram", "c"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = batch.column(0).to_pylist()
        packed = [None if t is None else squeeze(t.encode("utf-8", "surrogatepass")) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(packed, pa.binary()), *batch.columns[1:]], names=["packed", *batch.schema.names[1:]]
        )


def _discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of n-grams seen once to four times."""
    if not (ones and twos and threes):
        return 0.5, 0.5, 0.5
    y = ones / (ones + 2 * twos)
    found = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))


@dataclass(frozen=True)
class QualityModel:
    """One model or several, side by side in the columns of the same tables.

    For each order the n-grams with their discounted shares, and the contexts with what is left.
    """

    shares: tuple[DataFrame, ...]
    rests: tuple[DataFrame, ...]
    models: int = 1

    def log_probs(self, wanted: DataFrame) -> DataFrame:
        """``(gram, logp0, logp1, ...)`` for each row of ``wanted``, whose grams are all different."""
        each, lower = range(self.models), None
        for order in range(1, ORDER + 1):
            need = wanted if order == ORDER else wanted.select(
                F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")
            ).distinct()
            found = need.join(self.shares[order - 1], "gram", "left").withColumn(
                "context", F.shiftrightunsigned("gram", BITS)
            ).join(self.rests[order - 1], "context", "left")
            if lower is not None:
                suffix = F.col("gram").bitwiseAND((1 << BITS * (order - 1)) - 1)
                found = found.withColumn("suffix", suffix).join(lower, "suffix")
            back = [F.lit(1 / SYMBOLS) if lower is None else F.col(f"below{k}") for k in each]
            p = [F.coalesce(f"share{k}", F.lit(0.0)) + F.coalesce(f"rest{k}", F.lit(1.0)) * back[k] for k in each]
            lower = found.select(F.col("gram").alias("suffix"), *(p[k].alias(f"below{k}") for k in each))
        logs = (F.log(f"below{k}").cast("float").alias(f"logp{k}") for k in each)
        return lower.select(F.col("suffix").alias("gram"), *logs)


def fit(texts: DataFrame, text: str) -> QualityModel:
    """The model of all rows of ``texts``. Without any text every character is equally likely."""
    own = texts.select(F.col(text).cast("string").alias("text"), F.lit(0).alias("part"))
    packed = own.mapInArrow(frugal(_pack), "packed binary, part int")
    return _model(materialise(_counts(packed), "grams"))


def _counts(packed: DataFrame) -> DataFrame:
    top = packed.mapInArrow(frugal(_count), "part int, gram long, c long")
    return top.groupBy("part", "gram").agg(F.sum("c").alias("c"))


def _model(counts: DataFrame, without: Sequence[int | None] = (None,)) -> QualityModel:
    """A model for each of ``without``: of all ``(part, gram, c)``, or of those outside that part.

    A gram that one of the models lacks counts 0 in its column.
    """
    each = range(len(without))
    own = [F.col("c") if part is None else F.when(F.col("part") != part, F.col("c")) for part in without]
    top = counts.groupBy("gram").agg(*(F.coalesce(F.sum(own[k]), F.lit(0)).alias(f"c{k}") for k in each))
    tables = [materialise(top, "grams")]
    for order in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND((1 << BITS * order) - 1).alias("gram")
        tables.insert(0, tables[0].groupBy(suffix).agg(*(F.count_if(F.col(f"c{k}") > 0).alias(f"c{k}") for k in each)))
    shares, rests = [], []
    for table in tables:
        # Four numbers a model.
        seen = table.agg(*(F.count_if(F.col(f"c{k}") == n) for k in each for n in (1, 2, 3, 4))).first()
        d = []
        for k in each:
            c, (d1, d2, d3) = F.col(f"c{k}"), _discounts(*seen[4 * k : 4 * k + 4])
            d.append(F.when(c == 0, 0.0).when(c == 1, d1).when(c == 2, d2).otherwise(d3))
        context = F.shiftrightunsigned("gram", BITS)
        # A context that a model has not seen leaves it NULL.
        sums = table.groupBy(context.alias("context")).agg(
            *(F.nullif(F.sum(f"c{k}"), F.lit(0)).alias(f"s{k}") for k in each),
            *(F.sum(d[k]).alias(f"d{k}") for k in each),
        )
        rest = [(F.col(f"d{k}") / F.col(f"s{k}")).alias(f"rest{k}") for k in each]
        share = [((F.col(f"c{k}") - d[k]) / F.col(f"s{k}")).alias(f"share{k}") for k in each]
        joined = table.withColumn("context", context).join(sums, "context")
        shares.append(materialise(joined.select("gram", *share), "shares"))
        rests.append(materialise(sums.select("context", *rest), "rests"))
    return QualityModel(tuple(shares), tuple(rests), len(without))


def _blocks(texts: list[str | None], state: list[int]) -> Iterator[tuple[slice, int]]:
    """Slices of the texts with the number of the block each belongs to; ``state`` runs on."""
    begin = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if state[1] and state[1] + n > BLOCK_CHARS:
            if i > begin:
                yield slice(begin, i), state[0]
            begin, state[0], state[1] = i, state[0] + 1, 0
        state[1] += n
    if begin < len(texts):
        yield slice(begin, len(texts)), state[0]


def _ask(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(block, gram) for the different n-grams of each block."""
        state = [TaskContext.get().partitionId() << 20, 0]
        now, codes = state[0], np.zeros(0, np.int64)

        def asked() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(len(codes), now, np.int64)), pa.array(codes),
            ], names=["block", "gram"])

        for batch in batches:
            texts = batch.column(at).to_pylist()
            for rows, block in _blocks(texts, state):
                if block != now:
                    yield asked()
                    now, codes = block, np.zeros(0, np.int64)
                own = texts[rows]
                for part in steps(own):
                    codes = np.unique(np.concatenate([codes, _counted(grams(own[part])[0])[0]]))
        yield asked()

    return run


def _tag(at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows with their block, texts compressed for the way."""
        state = [TaskContext.get().partitionId() << 20, 0]
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for rows, block in _blocks(texts, state):
                part = batch.slice(rows.start, rows.stop - rows.start)
                columns = list(part.columns)
                columns[at] = pa.array(
                    [None if t is None else squeeze(t.encode()) for t in texts[rows]], pa.binary()
                )
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.full(part.num_rows, block, np.int64))], names=names
                )

    return run


def _score(at: int, keep_text: bool, names: list[str]):
    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The rows of a block with their perplexity under each model."""
        forget_others("")
        codes = answers["gram"].to_numpy()
        logs = np.stack([c.to_numpy() for c in answers.columns[2:]], 1)
        order = np.argsort(codes)
        codes, logs = codes[order], logs[order]
        open_ = zstandard.ZstdDecompressor().decompress
        texts = [None if b is None else open_(b).decode() for b in docs.column(at).to_pylist()]
        found = []
        for part in steps(texts, SCORED_CHARS):
            own, begins = grams(texts[part])
            place = np.searchsorted(codes, own)
            if len(own) and (place.max() >= len(codes) or (codes[place] != own).any()):
                raise ValueError("the documents were not read in the same order twice: write them first")
            n = np.fromiter((len(t) if t else 0 for t in texts[part]), np.int64)
            with np.errstate(invalid="ignore"):
                each = np.exp(-row_sums(logs[place], begins) / n[:, None])
            found.append(np.where(n[:, None] > 0, each, np.nan))
        ppl = np.concatenate(found) if found else np.zeros((0, logs.shape[1]))
        columns = list(docs.columns[:-1])
        columns[at] = pa.array(texts, pa.string())
        if not keep_text:
            del columns[at]
        values = [pa.array(v, mask=np.isnan(v)) for v in ppl.T]
        give_back()
        return pa.table([*columns, *values], names=names)

    return run


def perplexity(
    docs: DataFrame, text: str, model: QualityModel, column: str = "perplexity", keep_text: bool = True
) -> DataFrame:
    """Every row of ``docs`` with its perplexity per character, NULL for NULL and empty texts.

    ``docs`` must give the same rows in the same order whenever it is read, as tables do; the operator
    fails if it does not.
    """
    return _perplexities(docs, text, model, [column], keep_text)


def _perplexities(
    docs: DataFrame, text: str, model: QualityModel, named: Sequence[str], keep_text: bool
) -> DataFrame:
    """``perplexity`` under each of the models of ``model``, in the columns ``named``."""
    docs = docs.withColumn(text, F.col(text).cast("string"))
    at = docs.columns.index(text)
    block = free_name(docs, "_block")
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    ddl = [f"`{n}` {t}" for n, t in fields.items()]
    packed = [*ddl[:at], f"`{text}` binary", *ddl[at + 1 :], f"`{block}` long"]
    asked = docs.mapInArrow(frugal(_ask(at)), "block long, gram long")
    asked = materialise(asked, "asked")
    known = model.log_probs(asked.select("gram").distinct())
    answers = asked.join(known, "gram")
    answers = answers.select(F.col("block").alias(block), "gram", *(f"logp{k}" for k in range(len(named))))
    tagged = docs.mapInArrow(frugal(_tag(at, [*fields, block])), ", ".join(packed))
    out = [n for n in fields if keep_text or n != text]
    schema = ", ".join([*(f"`{n}` {fields[n]}" for n in out), *(f"`{n}` double" for n in named)])
    return tagged.groupBy(block).cogroup(answers.groupBy(block)).applyInArrow(
        _score(at, keep_text, [*out, *named]), schema
    )


@dataclass(frozen=True)
class Limits:
    """A language's usual log perplexity, and how far texts may lie off it on either side.

    The mean over a text varies with the root of its length, so distances are taken times that root:
    a long text has to lie near the centre, where a few words may be anything.
    """

    centre: float
    low: float
    high: float

    def holds(self, value: Column, size: Column) -> Column:
        off = (F.log(value) - self.centre) * F.sqrt(size)
        return off.between(self.low * MARGIN, self.high * MARGIN)


@dataclass(frozen=True)
class QualityFilter:
    model: QualityModel
    by_language: dict[str | None, Limits]

    def keeps(self, value: Column, language: Column, size: Column | None = None) -> Column:
        """As ``keeps``; without ``size`` the limits are those of a single character, the widest."""
        return keeps(self.by_language, value, language, F.lit(1) if size is None else size)


def keeps(limits: Mapping[str | None, Limits], value: Column, language: Column, size: Column) -> Column:
    """Whether a perplexity is within its language's limits for so many characters; NULL is not.

    A text in no trusted language, or in a NULL one, has to be within those of any language.
    """
    each = [(name, own.holds(value, size)) for name, own in limits.items()]
    within = reduce(Column.__or__, (c for _, c in each)) if each else value.isNotNull()
    for name, own in each:
        if name is not None:
            within = F.when(language == name, own).otherwise(within)
    return F.coalesce(within, F.lit(False))


def _part(doc_id: Column) -> Column:
    return F.coalesce((F.crc32(doc_id.cast("string")) % PARTS).cast("int"), F.lit(0))


def _spot(doc_id: Column) -> Column:
    """Where an id is marked, from 0."""
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(1 << MARK_BITS))


def _marked(ids: DataFrame) -> np.ndarray:
    """A map of ``1 << MARK_BITS`` bits, of which those of the ids are set: one size for any table."""
    at = _spot(F.col("id")) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(at).alias("row")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    found = np.zeros((max(1, (1 << MARK_BITS) // _ROW_BITS), _ROW_BITS // 8), np.uint8)
    # At most 4,096 rows of 4 KB.
    for row, bits in rows.collect():
        found[row - 1] = np.frombuffer(bits, np.uint8)
    return found.reshape(-1)


def _trusted_texts(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(packed, part)`` of every document whose id is among ``ids``.

    Few others get past the map of marks, so that the join, which decides, moves little text.
    """
    marks = docs.sparkSession.sparkContext.broadcast(_marked(ids))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spots = batch.column(2).to_numpy(zero_copy_only=False)
            hit = marks.value[spots >> 3] >> (spots & 7).astype(np.uint8) & 1
            part = batch.filter(pa.array(hit.astype(bool)))
            yield from _pack(iter([pa.RecordBatch.from_arrays(part.columns[:2], names=["text", "id"])]))

    part = docs.filter(F.col(doc_id).isNotNull()).select(
        F.col(text).cast("string").alias("text"), F.col(doc_id).alias("id"), _spot(F.col(doc_id)).alias("spot")
    )
    kind = docs.schema[doc_id].dataType.simpleString()
    part = part.mapInArrow(frugal(near), f"packed binary, id {kind}")
    return part.join(ids, "id", "left_semi").select("packed", _part(F.col("id")).alias("part"))


def _scored(
    docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, language: str, column: str, keep_text: bool
) -> tuple[DataFrame, DataFrame, dict[str | None, Limits], str]:
    """The counts, the documents with perplexity and length, the limits, and the length's column.

    All trusted documents are counted, and all set the limits. No document, trusted or not, meets
    counts of its own part, so that both kinds are judged alike.
    """
    ids = trusted.select(F.col(doc_id).alias("id")).filter("id is not null").distinct()
    counts = materialise(_counts(_trusted_texts(docs, ids, doc_id, text)), "counts")
    under = [free_name(docs, f"_under_{k}") for k in range(PARTS)]
    model = _model(counts, range(PARTS))
    size = free_name(docs, "_size")
    sized = docs.withColumn(size, F.length(F.col(text).cast("string")))
    found = _perplexities(sized, text, model, under, keep_text)
    own = F.element_at(F.array(*under), _part(F.col(doc_id)) + 1)
    scored = materialise(found.withColumn(column, own).drop(*under), "scored")
    known = scored.select(
        F.col(doc_id).alias("id"), F.col(language).cast("string").alias("lang"), F.log(column).alias("h"),
        F.col(size).alias("size"),
    ).filter("h is not null").join(ids, "id", "left_semi")
    return counts, scored, _limits(known), size


def _limits(known: DataFrame) -> dict[str | None, Limits]:
    """Each language's limits, which change little by little with its number of documents.

    Its centre is its own at any number. How far its texts may lie off it is what its own documents
    say, as if ``WEIGHT`` more said what those of all languages say about their own centres.
    """
    centres = known.groupBy("lang").agg(
        F.count("*").alias("n"), (F.sum(F.col("h") * F.col("size")) / F.sum("size")).alias("centre")
    )
    # One row per language.
    centres = {r["lang"]: (r["n"], r["centre"]) for r in centres.collect()}
    if not centres:
        return {}
    own = known.sparkSession.createDataFrame([(k, c) for k, (_, c) in centres.items()], "l string, centre double")
    off = known.join(own, F.col("lang").eqNullSafe(F.col("l"))).select(
        "lang", ((F.col("h") - F.col("centre")) * F.sqrt("size")).alias("off")
    )
    ends = F.percentile_approx("off", [1 - QUANTILE, QUANTILE], 10_000).alias("q")
    total = sum(n for n, _ in centres.values())

    def pulled(q: list[float], n: int, towards: list[float]) -> list[float]:
        return [(n * a + WEIGHT * b) / (n + WEIGHT) for a, b in zip(q, towards)]

    pooled = pulled(off.agg(ends).first()["q"], total, [-USUAL, USUAL])
    found = {r["lang"]: r["q"] for r in off.groupBy("lang").agg(ends).collect()}
    return {k: Limits(c, *pulled(found[k], n, pooled)) for k, (n, c) in sorted(centres.items(), key=str)}


def fit_filter(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, language: str) -> QualityFilter:
    """Model and thresholds from the documents whose ids are in ``trusted``, all of them.

    A language's limits are the ``QUANTILE`` of its trusted documents on either side; see ``_limits``
    for few. Without trusted documents there is no limit.
    """
    own = docs.select(doc_id, text, language)
    counts, _, limits, _ = _scored(own, trusted, doc_id, text, language, "perplexity", False)
    return QualityFilter(_model(counts), limits)


def judge(
    docs: DataFrame, trusted: DataFrame, doc_id: str, text: str, language: str,
    column: str = "perplexity", kept: str = "kept", keep_text: bool = True,
) -> DataFrame:
    """Every row of ``docs`` with its perplexity and whether it is within its language's limits.

    The perplexity is that under the trusted documents of the parts that this one is not in.
    """
    _, scored, limits, size = _scored(docs, trusted, doc_id, text, language, column, keep_text)
    within = keeps(limits, F.col(column), F.col(language), F.col(size))
    return scored.withColumn(kept, within).drop(size)
