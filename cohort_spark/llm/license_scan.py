"""Operator 1, licence scans: exact phrases, and an exact set-similarity join of text blocks with notices.

The join finds every block that holds at least ``threshold`` of a notice's distinct words. Notice words are
ordered by their document frequency over the whole corpus, rarest first. A block that holds ``c`` of the ``m``
words of a notice holds at least one of its ``m - c + 1`` rarest (prefix filter), has at least ``c`` words
(length filter), and from a shared word on, both sides still have enough words left (positional filter). Blocks
meet notices in an equi-join on prefix words; the pairs that pass are verified on the full sets.

Only DataFrame functions are used. The notices are a parameter, so their words, prefixes and postings are bounded.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_spark.llm.common import pick, stage

#: Phrases and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: The customary words of public licence notices, with labels.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("gpl-3", "licensed under the gnu general public license version 3"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("reserved", "all rights reserved"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPANS = (16, 64)  # a notice of at most so many words is sought in blocks of twice as many, one block every so many words


@dataclass(frozen=True)
class Notice:
    """A notice's words as corpus ranks (1 is rarest), the words needed, and its span."""

    label: str
    ranks: tuple[int, ...]
    need: int
    span: int


def span_of(n_words: int) -> int:
    return next((s for s in SPANS if n_words <= s), n_words)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased; other letters stay (``lower`` is used only where every character is ASCII)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """The words of a lower-cased text, in order."""
    return F.filter(F.split(F.regexp_replace(text, GAP, " "), " "), lambda w: w != "")


def order_notices(freq: dict[str, int], notices: Sequence[tuple[str, str]], threshold: float) -> tuple[list[str], list[Notice]]:
    """The notice words in global frequency order, and the notices in terms of it."""
    vocabulary = sorted({w for _, t in notices for w in t.split()}, key=lambda w: (freq.get(w, 0), w))
    rank = {w: i + 1 for i, w in enumerate(vocabulary)}
    out = []
    for label, text in notices:
        ranks = tuple(sorted({rank[w] for w in text.split()}))
        out.append(Notice(label, ranks, math.ceil(threshold * len(ranks) - 1e-9), span_of(len(text.split()))))
    return vocabulary, out


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _starts(phrase: str) -> Column:
    """Word positions where the phrase stands; evaluated only for texts that hold it."""
    parts = phrase.split()
    test = " AND ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(parts))
    held = F.expr(f"filter(sequence(0, size(words) - {len(parts)}), i -> {test})")
    return F.when(F.array_contains("words", parts[0]) & (F.size("words") >= len(parts)), held).otherwise(F.expr("array()").cast("array<int>"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Sequence[tuple[str, str]] = PHRASES,
                 notices: Sequence[tuple[str, str]] = NOTICES, threshold: float = 0.9) -> DataFrame:
    """One row per document: ``(id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks)``.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text, A-Z lower-cased. ``n_base`` counts all places of
    all phrases, ``first_word`` and ``last_word`` are the smallest and largest start (words from 0, null if none).
    ``labels`` adds the notices found; ``score`` is the largest containment of a notice (1 where a phrase stands, 0 if
    nothing is found), ``blocks`` the number of blocks that hold a notice. Null or empty text: no words, no labels,
    score 0. Rows may repeat, ids may be null: every input row gives one row. Columns besides the two named are ignored.
    """
    src = (pick(docs, id=id_col, text=text_col)
           .select("id", word_array(lower_ascii(F.coalesce("text", F.lit("")))).alias("words")))
    known = sorted({w for _, t in notices for w in t.split()})
    freq = {r["w"]: r["n"] for r in src.select(F.explode(F.array_intersect("words", _strings(known))).alias("w"))
            .groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per notice word
    vocabulary, rules = order_notices(freq, notices, threshold)
    prefix = {s: sorted({vocabulary[r - 1] for n in rules if n.span == s for r in n.ranks[:len(n.ranks) - n.need + 1]})
              for s in sorted({n.span for n in rules})}
    vocab = _strings(vocabulary)

    starts = F.concat(*[_starts(p) for p, _ in phrases])
    base = F.array_compact(F.array(*[F.when(F.size(_starts(p)) > 0, F.lit(label)) for p, label in phrases]))

    def blocks(span: int) -> Column:
        """Sorted ranks of the notice words of each block, with the block's distinct words; texts without a prefix word have none."""
        cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 1 - span, F.lit(0)), F.lit(span)),
                          lambda i: F.slice("words", i + 1, 2 * span))
        cut = F.transform(cut, lambda b: F.struct(
            F.lit(span).alias("span"), F.size(F.array_distinct(b)).alias("width"),
            F.array_sort(F.transform(F.array_intersect(b, vocab), lambda w: F.array_position(vocab, w).cast("int"))).alias("ranks")))
        return F.when(F.arrays_overlap("words", _strings(prefix[span])), F.filter(cut, lambda b: F.size(b["ranks"]) > 0))

    found = stage(src.select(
        F.monotonically_increasing_id().alias("uid"), "id", F.size("words").cast("long").alias("n_words"),
        starts.alias("starts"), F.array_distinct(base).alias("base"),
        F.concat(*[F.coalesce(blocks(s), F.expr("array()").cast("array<struct<span:int,width:int,ranks:array<int>>>")) for s in prefix]).alias("blocks")),
        "licenses")

    spark = docs.sparkSession
    postings = spark.createDataFrame(
        [(k, n.label, n.span, list(n.ranks), len(n.ranks), n.need, r, i) for k, n in enumerate(rules)
         for i, r in enumerate(n.ranks[:len(n.ranks) - n.need + 1])],
        "notice int, label string, n_span int, n_ranks array<int>, m int, need int, rank int, i int")
    tokens = (found.select("uid", F.posexplode("blocks").alias("block", "b"))
              .select("uid", "block", "b", F.posexplode("b.ranks").alias("j", "rank")))
    left = F.col("m") - F.col("i") - 1
    pairs = (tokens.join(F.broadcast(postings), "rank")  # as many rows as the notices have prefix words
             .where((F.col("b.span") == F.col("n_span")) & (F.col("b.width") >= F.col("need"))
                    & (F.least(left, F.size("b.ranks") - F.col("j") - 1) + 1 >= F.col("need")))
             .withColumn("held", F.size(F.array_intersect("b.ranks", "n_ranks"))).where("held >= need"))
    by_text = (pairs.groupBy("uid").agg(F.collect_set("label").alias("more"), F.max(F.col("held") / F.col("m")).alias("contained"),
                                        F.count_distinct("block").alias("n_blocks")))
    out = found.drop("blocks").join(by_text, "uid", "left")
    none = F.expr("array()").cast("array<string>")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("contained", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0).cast("long")).alias("blocks"))


def license_sql(phrases=PHRASES, notices=NOTICES, threshold: float = 0.9) -> str:
    """The same result without any filter: every block against every notice."""
    hits = " UNION ALL ".join(
        f"SELECT uid, i - 1 AS s, '{label}' AS label FROM places WHERE " +
        " AND ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(p.split())) for p, label in phrases)
    values = ", ".join(f"('{label}', {span_of(len(t.split()))}, {sorted(set(t.split()))!r})" for label, t in notices)
    spans = ", ".join(f"({s})" for s in sorted({span_of(len(t.split())) for _, t in notices}))
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), places AS (SELECT uid, words, unnest(range(1, len(words) + 1)) AS i FROM d),
hits AS ({hits}),
base AS (SELECT uid, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word, list(DISTINCT label) AS labels FROM hits GROUP BY uid),
notices(label, span, need_words) AS (VALUES {values}), spans(span) AS (VALUES {spans}),
blocks AS (SELECT uid, span, unnest(range(0, greatest(len(words) - 1 - span, 0) + 1, span)) AS o, words FROM d, spans),
held AS (
  SELECT uid, span, o, label, len(need_words) AS m, len(list_intersect(list_distinct(words[o + 1:o + 2 * span]), need_words)) AS k
  FROM blocks JOIN notices USING (span)
), more AS (
  SELECT uid, list(DISTINCT label) AS labels, max(k / m) AS contained, count(DISTINCT (span, o)) AS n FROM held
  WHERE k >= ceil({threshold} * m - 1e-9) GROUP BY uid
)
SELECT d.doc_id, len(d.words) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels,
       round(CASE WHEN b.n_base > 0 THEN 1.0 ELSE coalesce(m.contained, 0) END, 6)::DOUBLE AS score, coalesce(m.n, 0) AS blocks
FROM d LEFT JOIN base AS b ON b.uid = d.uid LEFT JOIN more AS m ON m.uid = d.uid
"""
