"""Spelling variants: words one edit apart, found by walking a trie that is a table of edges.

Every word is walked through the trie of all words, as rows ``(word, position, node, edits)``: so much of
the word is read, that node is reached, and none or one edit is spent. A round joins the rows with the
edges of their nodes and reads one edge: with no edit, or with the one edit (a character replaced, left
out or put in) inside it. A row that has read its word, spent its edit and stands on a word's end has
found a neighbour; rows that fit no edge are gone.

Three things keep the frontier small and spread out:

* An edge reads all characters up to the next node where words part or end, so the number of rounds is
  that of the forks on a path, not that of the characters.
* An edit lies in the second half of a word or, read backwards, in the second half again. So each word
  is walked twice, forwards and backwards, and each walk starts at the node that its first half leads to
  without an edit. No row ever stands on the root, where all words would meet.
* Nodes are 64-bit hashes of what leads to them. Two nodes of one hash would give false candidates, never
  lose one; each pair found is checked in the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import free_name
from orelode.llm.words import mix
from orelode.sources.paths import materialise

#: Characters a word has at least, and its occurrences.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A word's form occurs at least so many times as often as the word.
TIMES = 10
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)
#: Characters hashed in one step, unless one word is longer.
STEP = 500_000
STEPS = "key string, side int, position int, node long, next int, starts boolean, ends boolean"


def occurrences(docs: DataFrame, doc_id: str, text: str, least: int = 1) -> DataFrame:
    """``(doc_id, run)``: each maximal run of ``least`` letters or more, only A-Z lower-cased. NULL texts have none."""
    # Greedy from the left, so a match is a whole run; shorter ones are never made into rows.
    pattern = f"{RUN.removesuffix('+')}{{{least},}}"
    run = F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(pattern), F.lit(0)))
    runs = docs.select(F.col(doc_id).cast("string").alias("doc_id"), run.alias("run"))
    return runs.withColumn("run", F.translate("run", _UPPER, _LOWER))


def misspelt(doc_id: Column, run: Column) -> Column:
    """``run`` less one character where the checksum of document and run says so.

    The code point at ``h % length`` goes if 31 divides ``h``, the CRC-32 of ``<doc_id>:<run>``. A NULL id
    counts as empty.
    """
    h = F.crc32(F.concat(F.coalesce(doc_id, F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substr(run, at + 2))
    return F.when(h % 31 == 0, less).otherwise(run)


def vocabulary(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(word, n)`` of all words long and frequent enough, over whole texts."""
    # A run of the least length may lose a character, so shorter ones cannot matter.
    runs = occurrences(docs, doc_id, text, LEAST_LENGTH)
    words = runs.select(misspelt(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each word and direction the nodes from its first half on, by hashes of what precedes them."""
    for batch in batches:
        words = [w for w in batch.column(0).to_pylist() if w]
        begin = total = 0
        for i, word in enumerate([*words, None]):
            if word is None or (total and total + len(word) > STEP):
                if i > begin:
                    yield from _nodes(words[begin:i])
                begin, total = i, 0
            total += len(word) if word else 0


def _nodes(words: list[str]) -> Iterator[pa.RecordBatch]:
    size = np.array([len(w) for w in words])
    first = np.cumsum(size) - size
    for side in (0, 1):
        spelled = "".join(w[::-1] if side else w for w in words)
        codes = np.frombuffer(spelled.encode("utf-32-le", "surrogatepass"), "<u4")
        # A word's hash after p characters is the sum over them of code times base to their position.
        own = np.arange(len(codes)) - np.repeat(first, size)
        powers = np.cumprod(np.full(size.max(), _BASE))
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(codes.astype(np.uint64)) * powers[own])])
        # Words that differ in one edit from one of this length start there or after.
        least, half = (size - 1) // 2, size // 2
        count = size - least + 1
        owner = np.repeat(np.arange(len(words)), count)
        position = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - least, count)
        sums = total[first[owner] + position] - total[first[owner]]
        node = mix(sums + _SEEDS[side] * (position.astype(np.uint64) + np.uint64(1)))
        ends = position == size[owner]
        follow = np.where(ends, -1, codes[np.minimum(first[owner] + position, len(codes) - 1)].astype(np.int64))
        keys = pa.array([_short(w) for w in words], pa.string())
        yield pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(owner)),
                pa.array(np.full(len(owner), side, np.int32)),
                pa.array(position.astype(np.int32)),
                pa.array(node.view(np.int64)),
                pa.array(follow.astype(np.int32)),
                pa.array(position == half[owner]),
                pa.array(ends),
            ],
            names=["key", "side", "position", "node", "next", "starts", "ends"],
        )


def _spelled(word: Column, side: Column) -> Column:
    return F.when(side == 1, F.reverse(word)).otherwise(word)


def _key(word: Column) -> Column:
    """A word's stand-in on rows that come once a character, so that long words stay linear."""
    return F.when(F.length(word) <= 32, word).otherwise(F.md5(word))


def _short(word: str) -> str:
    """What :func:`_key` gives."""
    return word if len(word) <= 32 else hashlib.md5(word.encode()).hexdigest()


def trie(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges ``(node, first, label, child, end_word, onward)`` and the starts ``(word, side, position, node)``."""
    spelled = words.select("word")
    steps = materialise(spelled.mapInArrow(_walked, STEPS), "trie-steps")
    # Where words part, end, or a walk starts.
    stops = (
        steps.groupBy("node")
        .agg(
            F.max("starts").alias("starts"), F.max("ends").alias("ends"),
            F.min("next").alias("least"), F.max("next").alias("most"),
        )
        .filter(F.col("starts") | F.col("ends") | (F.col("least") != F.col("most")))
        .select("node")
    )
    # An array per word and side: as long as the word at most.
    paths = (
        steps.join(stops, "node")
        .groupBy("key", "side")
        .agg(F.sort_array(F.collect_list(F.struct("position", "node", "starts", "ends"))).alias("path"))
    )
    whole = spelled.select(_key(F.col("word")).alias("key"), "word")
    paths = paths.join(whole, "key").drop("key")
    paths = materialise(paths.withColumn("spelled", _spelled(F.col("word"), F.col("side"))), "trie-paths")

    pairs = F.arrays_zip(
        F.slice("path", F.lit(1), F.size("path") - 1).alias("a"), F.slice("path", F.lit(2), F.size("path") - 1).alias("b")
    )
    edges = paths.select("word", "spelled", F.explode(pairs).alias("e")).select(
        F.col("e.a.node").alias("node"),
        F.substr("spelled", F.col("e.a.position") + 1, F.col("e.b.position") - F.col("e.a.position")).alias("label"),
        F.col("e.b.node").alias("child"),
        F.when(F.col("e.b.ends"), F.col("word")).alias("end_word"),
    )
    # Words that share an edge all spell it; the word that ends at its child is one of them.
    edges = edges.groupBy("node", "label", "child").agg(F.max("end_word").alias("end_word"))
    edges = materialise(edges.withColumn("first", F.substring("label", 1, 1)), "trie-edges")
    # What the edges of the child begin with: at most the alphabet.
    onward = edges.groupBy(F.col("node").alias("child")).agg(F.collect_set("first").alias("onward"))
    edges = materialise(edges.join(onward, "child", "left"), "trie-onward")
    starts = paths.select("word", "side", F.explode(F.filter("path", lambda p: p["starts"])).alias("p"))
    return edges, starts.select("word", "side", F.col("p.position").alias("position"), F.col("p.node").alias("node"))


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two strings are exactly one edit apart.

    Where they begin differently, the edit is there and the rest is equal. The built-in distance takes
    the square of the length even within a bound, so beyond 64 characters the first character that
    differs is looked up instead.
    """
    n, m = F.length(a), F.length(b)
    follows = F.substr(a, (n >= m).cast("int") + 1) == F.substr(b, (m >= n).cast("int") + 1)
    at_once = (F.abs(n - m) <= 1) & follows
    same = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.coalesce(x == y, F.lit(False)))
    at = F.array_position(same, False).cast("int")
    after = F.substr(a, at + (n >= m).cast("int")) == F.substr(b, at + (m >= n).cast("int"))
    long = (at > 0) & (F.abs(n - m) <= 1) & after
    later = F.when(F.least(n, m) <= 64, F.levenshtein(a, b, 1) == 1).otherwise(long)
    return F.when(F.substring(a, 1, 1) != F.substring(b, 1, 1), at_once).otherwise(later)


def _edited(rest: Column, label: Column) -> Column:
    """Ways to read ``label`` from ``rest`` with at most one edit: characters read, edits spent; some are NULL."""
    n = F.length(label)
    way = lambda more, spent: F.struct((n + more).alias("read"), F.lit(spent).alias("spent"))
    one_off = lambda more: (
        (F.length(rest) >= n + more) & _one_edit(label, F.substr(rest, F.lit(1), n + more))
    )
    # A label read without an edit needs no edit inside it: the next edge or the end takes that.
    with_edit = F.array(*(F.when(one_off(more), way(more, 1)) for more in (-1, 0, 1)))
    return F.when(F.startswith(rest, label), F.array(way(0, 0))).otherwise(with_edit)


def neighbours(words: DataFrame) -> DataFrame:
    """``(word, near)``: each ordered pair of different words that are one edit apart, once.

    ``words`` has a column ``word`` with different values. NULL and empty words take no part; so an empty
    table gives an empty one.
    """
    edges, starts = trie(words)
    frontier = starts.withColumn("edits", F.lit(0))
    found = []
    while True:
        spelled = _spelled(F.col("word"), F.col("side"))
        rest = F.substr(spelled, F.col("position") + 1)
        frontier = frontier.withColumn("rest", rest).withColumn("begin", F.substring("rest", 1, 1))
        # A row with its edit ahead tries all edges of its node; one that has spent it fits one at most.
        free = F.col("edits") == 0
        unspent = F.struct(F.length("label").alias("read"), F.lit(0).alias("spent"))
        ways = F.when(free, _edited(F.col("rest"), F.col("label"))).otherwise(
            F.when(F.startswith("rest", "label"), F.array(unspent))
        )
        # One join for both, so that the edges are dealt and sorted once a round.
        meets = (frontier["node"] == edges["node"]) & (free | (F.col("begin") == F.col("first")))
        tried = frontier.join(edges, meets).withColumn("way", F.explode(ways)).filter("way is not null")
        after = tried.select(
            "word", "side", (F.col("position") + F.col("way.read")).alias("position"),
            F.col("child").alias("node"), (F.col("edits") + F.col("way.spent")).alias("edits"),
            "end_word", "onward", F.substr("rest", F.col("way.read") + 1, F.lit(1)).alias("following"),
        )
        # A last character left over is the one edit of a row that has spent none.
        left = F.length("word") - F.col("position")
        near = F.when((left + F.col("edits") == 1) & (F.col("end_word") != F.col("word")), F.col("end_word"))
        fits = F.when(F.col("edits") == 1, F.array_contains("onward", F.col("following"))).otherwise(
            F.col("onward").isNotNull()
        )
        after = after.select(
            "word", "side", "position", "node", "edits", near.alias("near"), F.coalesce(fits, F.lit(False)).alias("walks")
        )
        after = materialise(after.filter("walks or near is not null"), "trie-frontier")
        found.append(after.filter("near is not null").select("word", "near"))
        frontier = after.filter("walks").drop("near", "walks")
        if frontier.isEmpty():
            break
    pairs = reduce(DataFrame.unionByName, found).distinct()
    return pairs.filter(_one_edit(F.col("word"), F.col("near")))


def group_words(words: DataFrame) -> DataFrame:
    """``words(word, n)`` with ``form``, ``root``, ``n_near`` and ``form_n``.

    A word's form is its near word of largest ``n``, the smallest in code-point order among equals, if that
    occurs at least ten times as often; else NULL. Its root is where the forms lead, itself if it has none.
    Each form occurs ten times as often as the one before, so the chain ends after few steps.
    """
    words = materialise(words, "words")
    near = neighbours(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # The largest n, then the smallest word: the smallest of (-n, word).
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"),
    )
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        (-F.col("best.less")).alias("best_n"), F.col("best.form").alias("best"),
    )
    fits = F.col("best_n") >= TIMES * F.col("n")
    out = joined.select(
        "word", "n", "n_near", F.when(fits, F.col("best")).alias("form"), F.when(fits, F.col("best_n")).alias("form_n")
    )
    out = materialise(out, "forms")
    forms = out.filter("form is not null").select(F.col("word").alias("at"), F.col("form").alias("onward"))
    moving = out.filter("form is not null").select("word", F.col("form").alias("root"))
    done = []
    while True:
        step = moving.join(forms, moving["root"] == forms["at"], "left")
        step = materialise(step.select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNull().alias("done")), "roots")
        done.append(step.filter("done").select("word", "root"))
        moving = step.filter("not done").select("word", "root")
        if moving.isEmpty():
            break
    roots = reduce(DataFrame.unionByName, done)
    out = out.join(roots, "word", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The words of ``docs`` with their spelling variants: see :func:`vocabulary`, :func:`group_words`.

    NULL and empty texts have no words, repeated rows count again, other columns play no part whatever
    their names, and an empty table has no words. A run of letters may be as long as its text.
    """
    return group_words(vocabulary(docs, doc_id, text))
