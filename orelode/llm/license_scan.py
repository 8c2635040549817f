"""License notices in documents: MinHash bands over windows of text, then exact containment.

DataFrame functions only. A document's words become hashes of five-word shingles; windows of twelve
shingles start at every fourth. Each window and each template window has 64 MinHash values, each a band
of its own. If a notice of one shingle lies in a window, their similarity is 1/12 and they collide in some
band with probability 0.996; and every notice lies in three windows or meets them with more shingles.
What collides is verified: the share of the template's shingles that stand around the window.

Documents without any word that four fifths of a template's shingles cannot do without are set aside
first; no document that contains a template lacks all of them.
"""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orelode.llm.notices import ROWS

SHINGLE = 5
CONTAINMENT = 0.8
#: Shingles of a window, and from one window to the next.
WINDOW, STRIDE = 12, 4
BANDS = 64

# The wording of common notices.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "CC-BY-4.0": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License."
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
}


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(own: Column) -> Column:
    """Hashes of all runs of five words, in order; none for fewer words."""
    last = F.size(own) - SHINGLE
    return F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(F.array_join(F.slice(own, i + 1, SHINGLE), " ")),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


#: Entries of the index up to which it is sent to all executors (about 30 MB there); more are joined by shuffles.
BROADCAST_ENTRIES = 1_000_000


def slots(window: Column) -> Column:
    """The hash of each band: which one, and the least of the window's values under it."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda b: F.xxhash64(b, F.array_min(F.transform(window, lambda x: F.xxhash64(x, b)))),
    )


def _split(template: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", template.lower()) if w]


def needed_words(template: str) -> set[str]:
    """Words such that any four fifths of the template's shingles hold one; longest first."""
    own = _split(template)
    parts = {tuple(own[i : i + SHINGLE]) for i in range(len(own) - SHINGLE + 1)}
    enough = math.ceil(CONTAINMENT * len(parts) - 1e-9)
    chosen: set[str] = set()
    for word in sorted(set(own), key=lambda w: (-len(w), w)):
        if sum(not chosen.intersection(p) for p in parts) < enough:
            break
        chosen.add(word)
    return chosen


def scan(
    docs: DataFrame, doc_id: str, text: str, templates: Mapping[str, str | Sequence[str]] | None = None
) -> DataFrame:
    """``(doc_id, license, containment, first_shingle, windows)`` for each notice in a document.

    ``containment`` is the largest share of the template's different shingles found around a window,
    0.8 or more; ``first_shingle`` is where the first such window starts, ``windows`` their number.
    NULL and empty texts, and texts of fewer than five words, have none. Rows that share an id, NULL
    included, are one document. Templates of fewer than five words are never found. The templates are
    a parameter held by the driver, one or several for a license; by default ``TEMPLATES`` and ``ROWS``.
    """
    spark = docs.sparkSession
    if templates is None:
        pairs = [*TEMPLATES.items(), *ROWS]
    else:
        pairs = [(k, t) for k, own in templates.items() for t in ([own] if isinstance(own, str) else own)]
    # One of each wording.
    pairs = [(k, " ".join(own)) for k, own in dict.fromkeys((k, tuple(_split(t))) for k, t in pairs)]
    numbered = [(n, *pair) for n, pair in enumerate(pairs)]
    given = spark.createDataFrame(numbered or [(0, "", "")], "wording int, license string, template string")
    known = given.select(
        "wording", "license", shingles(words(F.col("template"))).alias("all")
    ).filter(F.size("all") > 0)
    wanted = known.select("wording", "license", F.array_distinct("all").alias("wanted"))
    # Any four fifths of a wording's shingles hold one of these; the wordings bound their number.
    spare = F.size("wanted") - F.ceil(F.size("wanted") * F.lit(CONTAINMENT) - F.lit(1e-9)).cast("int") + 1
    telling = [str(r[0]) for r in wanted.select(F.explode(F.slice("wanted", F.lit(1), spare))).distinct().collect()]
    tells = F.split(F.lit(",".join(telling)), ",") if telling else F.array()
    tells = tells.cast("array<bigint>")
    reach = max((len(_split(t)) for _, t in pairs), default=0)
    index = known.select(
        "wording",
        F.explode(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("all") - WINDOW, F.lit(0))),
            lambda i: F.slice(F.col("all"), i + 1, WINDOW),
        )).alias("window"),
    ).select("wording", F.explode(slots(F.col("window"))).alias("slot")).distinct()

    # Each step leaves through a generator: else the optimizer would work its expression out anew for
    # every shingle that refers to it.
    needed = sorted(set().union(*(needed_words(t) for _, t in pairs)))
    hopeful = F.lower(F.col(text).cast("string")).rlike("|".join(needed) or "$^")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).filter(hopeful)
    # 128 bits for an id with its text: equal rows are one.
    name = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string"), F.lit("\n")), F.lit("-"))
    rows = rows.withColumn("key", F.substring(F.sha2(F.concat(name, "text").cast("binary"), 256), 1, 32))
    found = rows.select("key", F.explode(F.array(words(F.col("text")))).alias("words"))
    found = found.select("key", F.explode(F.array(shingles(F.col("words")))).alias("all"))
    found = found.filter(F.arrays_overlap("all", tells))
    starts = F.when(
        F.size("all") > 0, F.sequence(F.lit(0), F.greatest(F.size("all") - 1, F.lit(0)), F.lit(STRIDE))
    ).otherwise(F.array().cast("array<int>"))
    windows = found.select("key", F.explode(F.transform(starts, lambda s: F.struct(
        s.alias("start"), F.slice(F.col("all"), s + 1, WINDOW).alias("window"),
    ))).alias("w")).select("key", "w.*")
    # Twelve bytes an entry; the wordings are in the driver's hands, so their number is known.
    entries = BANDS * sum(max(len(_split(t)) - SHINGLE - WINDOW + 2, 1) for _, t in pairs)
    if entries <= BROADCAST_ENTRIES:
        index = F.broadcast(index)
    # Only places and band hashes meet the index; a text comes again for the few windows that do.
    banded = windows.select("key", "start", F.explode(slots(F.col("window"))).alias("slot"))
    met = banded.join(index, "slot").groupBy("key").agg(F.collect_set(F.struct("start", "wording")).alias("met"))
    again = rows.dropDuplicates(["key"]).join(met, "key")
    again = again.select("doc_id", "met", F.explode(F.array(words(F.col("text")))).alias("words"))
    again = again.select("doc_id", "met", F.explode(F.array(shingles(F.col("words")))).alias("all"))
    low = lambda s: F.greatest(s - reach, F.lit(0))
    checked = again.select("doc_id", F.explode(F.transform("met", lambda m: F.struct(
        m["wording"].alias("wording"), m["start"].alias("start"),
        F.slice(F.col("all"), low(m["start"]) + 1, m["start"] - low(m["start"]) + WINDOW + reach).alias("around"),
    ))).alias("m")).select("doc_id", "m.*")
    share = F.size(F.array_intersect("around", "wanted")) / F.size("wanted")
    return (
        checked.join(wanted, "wording")
        .select("doc_id", "license", "start", share.alias("containment"))
        .filter(F.col("containment") >= CONTAINMENT)
        .groupBy("doc_id", "license")
        .agg(
            F.max("containment").alias("containment"),
            F.min("start").cast("long").alias("first_shingle"),
            F.countDistinct("start").alias("windows"),
        )
    )
