"""License scans by diagonal voting.

Every rolling word gram of a text is joined to the places where it stands in the templates:
grams of two words to the phrases, grams of four to the notices. A match of word ``i``
with template word ``j`` votes for the diagonal ``i - j``. The votes are added up before
they are shuffled. A phrase stands where all its grams vote for one diagonal and its words
are there. A notice is verified by alignment: the fewest words to put in, leave out or
change between it and the words around the diagonal's first vote. Neighbouring
diagonals are merged into one span with the best of their alignments. Notices whose
first vote is the same word compete, and only the best aligned give a label, so that
variants of one wording are told apart.

Texts are cut into blocks of words that overlap by a window, so a long text is many rows
and no row carries more than a block's windows. Grams are looked up in a table of bits
first; only hits become rows.

Notices are a table (``text``, ``label``), by default ``NOTICES``. Those of more than 48
words are looked for in sections, each of which gives the label; those of fewer than
four words have no gram and are not found.

Defined cases: a null text is empty and has no words; repeated rows are scanned each on its
own; an empty table gives no rows; very long texts are scanned whole; equally well aligned
notices of one place all give their labels; other columns are not looked at. A null text or
label among the notices counts as empty, and empty labels are left out of ``labels``.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemill.llm.common import whole_text

# fixed values: phrases to count, and well-known license notices, in lower case
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this "
    "software and associated documentation files": "mit",
    "released under the mit license": "mit",
    "licensed under the apache license version 2 0": "apache",
    "you may not use this file except in compliance with the license": "apache",
    "this program is free software you can redistribute it and or modify it under the terms "
    "of the gnu general public license as published by the free software foundation": "gpl",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met": "bsd",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl",
    "licensed under cc by 4 0": "cc-by",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "permission to use copy modify and or distribute this software for any purpose with or "
    "without fee is hereby granted": "isc",
}
NOT_IN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHORT, LONG = 2, 4
SECTION = 48  # words of a notice that are aligned at once
AROUND = 64  # words before and after a diagonal's first vote, a section and a third of it
BLOCK = 2048  # words of a text in one row
COVERED = 80  # percent of a notice's words that must be aligned for its label
NEIGHBOURS = 3  # diagonals this far apart are merged
SLOTS_PER_GRAM, MOST_SLOTS = 64, 1 << 23
BROADCAST_ROWS = 100_000


def words_of(text: Column) -> Column:
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, NOT_IN_WORDS), "")


def _short_grams(words: Column) -> Column:
    behind = F.slice(words, F.lit(2), F.size(words))
    return F.zip_with(words, behind, lambda a, b: F.xxhash64(a, b))


def _long_grams(short: Column) -> Column:
    """Of four words: two grams of two words, one behind the other."""
    behind = F.slice(short, F.lit(1 + SHORT), F.size(short))
    return F.zip_with(short, behind, lambda a, b: F.xxhash64(a, b))


def _broadcast(small: DataFrame) -> DataFrame:
    """With a hint where the rows are few, else as Spark chooses."""
    few = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return F.broadcast(small) if few else small


def default_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "text string, label string")


def templates(spark: SparkSession, notices: DataFrame | None = None) -> DataFrame:
    """template, label, width of its grams, its words: phrases, and sections of notices."""
    notices = default_notices(spark) if notices is None else notices
    split = notices.select(
        F.coalesce("label", F.lit("")).alias("label"), words_of(whole_text()).alias("all")
    ).where(F.size("all") >= LONG)
    n = F.size("all")
    sections = F.ceil(n / SECTION).cast("int")
    start = F.floor(F.col("section") * n / sections).cast("int")
    end = F.floor((F.col("section") + 1) * n / sections).cast("int")
    cut = split.select(
        "label", "all", F.explode(F.sequence(F.lit(0), sections - 1)).alias("section")
    ).select("label", F.lit(LONG).alias("width"), F.slice("all", start + 1, end - start).alias("words"))
    phrases = spark.createDataFrame(
        [(label, SHORT, phrase.split(" ")) for phrase, label in PHRASES.items()],
        "label string, width int, words array<string>",
    )
    every = phrases.unionByName(cut).distinct()
    return every.select(F.xxhash64("label", "width", "words").alias("template"), "*")


def template_places(found: DataFrame) -> DataFrame:
    """For each gram: where it stands in the templates, one row a gram and width."""
    short = _short_grams(F.col("words"))
    of_width = F.when(F.col("width") == SHORT, short).otherwise(_long_grams(short))
    placed = found.select(
        "template", "width", F.size("words").alias("n"), F.posexplode(of_width).alias("at", "gram")
    ).where("at <= n - width")
    return placed.groupBy("width", "gram").agg(
        F.collect_list(F.struct("template", "at")).alias("places")
    )


def _slot_table(places: DataFrame) -> tuple[Column, int]:
    """A byte for each slot of gram hashes, set where a template has a gram of it.

    It has 64 slots a gram, at most 8 million; with more templates it lets more words
    pass, and the join decides.
    """
    grams = places.count()
    slots = 1 << 12
    while slots < min(MOST_SLOTS, SLOTS_PER_GRAM * grams):
        slots *= 2
    used = places.select(F.pmod("gram", F.lit(slots)).cast("int").alias("slot")).distinct()
    table = bytearray(slots)
    for row in used.collect():  # at most as many as there are slots
        table[row["slot"]] = 1
    return F.lit(table), slots


def votes(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Votes by document, template and diagonal; of a document without any, one null row.

    ``window`` are the words around the first vote, from word ``window_at`` on.
    """
    places = template_places(found)
    table, slots = _slot_table(places)

    def known(gram: Column) -> Column:
        slot = F.pmod(gram, F.lit(slots)).cast("int")
        return F.substring(table, slot + 1, F.lit(1)) == F.lit(bytearray(b"\x01"))

    split = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words_of(whole_text()).alias("words")
    )
    block = F.col("block")
    start = F.greatest(F.lit(0), block * BLOCK - AROUND)
    size = F.lit(BLOCK + 2 * AROUND)
    last_block = F.floor(F.greatest(F.lit(0), F.size("words") - 1) / BLOCK).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), last_block),
        lambda b: F.struct(
            b.alias("block"),
            F.slice(F.col("words"), F.greatest(F.lit(0), b * BLOCK - AROUND) + 1, size).alias("words"),
        ),
    )
    cut = (
        # the blocks first: what an explode also uses elsewhere it would copy into each row
        split.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), blocks.alias("blocks"))
        .select("row", "doc_id", "n_words", F.inline_outer("blocks"))
        .select("row", "doc_id", "n_words", "block", start.alias("start"), "words")
    )
    hashed = cut.withColumn("short", _short_grams(F.col("words"))).withColumn(
        "long", _long_grams(F.col("short"))
    )
    begin = block * BLOCK - F.col("start")
    end = F.least(begin + BLOCK, F.size("words"))
    places_in = F.when(end > begin, F.sequence(begin, end - 1)).otherwise(F.array().cast("array<int>"))
    hits = F.filter(places_in, lambda i: known(F.col("short")[i]) | known(F.col("long")[i]))

    def with_window(i: Column) -> Column:
        first = F.greatest(F.lit(0), i - AROUND)
        return F.struct(
            (F.col("start") + i).alias("pos"),
            F.array(
                F.struct(F.lit(SHORT).alias("width"), F.col("short")[i].alias("gram")),
                F.struct(F.lit(LONG).alias("width"), F.col("long")[i].alias("gram")),
            ).alias("grams"),
            (F.col("start") + first).alias("window_at"),
            F.slice(F.col("words"), first + 1, i + AROUND - first).alias("window"),
        )

    base = ["row", "doc_id", "n_words"]
    kept = hashed.select(*base, "start", "words", "short", "long", hits.alias("hits"))
    seen = kept.select(*base, F.inline_outer(F.transform("hits", with_window)))
    grams = seen.select(*base, "pos", "window_at", "window", F.inline_outer("grams"))
    joined = grams.join(_broadcast(places), ["width", "gram"], "left")
    voted = joined.select(*base, "pos", "window_at", "window", F.inline_outer("places"))
    around = F.struct("pos", "window_at", "window")
    return voted.groupBy(*base, "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.count("template").alias("votes"),
        F.min(F.when(F.col("template").isNotNull(), around)).alias("around"),
        F.max("pos").alias("last"),
    )


def edits(words: Column, window: Column) -> Column:
    """The fewest words put in, left out or changed between ``words`` and a part of ``window``.

    Columns of differences are kept as bits of two numbers, a word of the window a step;
    ``words`` are at most ``SECTION``.
    """

    def bit(j: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), j)

    m = F.size(words)
    full = bit(m) - 1
    top = bit(m - 1)
    bit_of = F.transform(words, lambda w, j: F.struct(w.alias("word"), bit(j).alias("bit")))
    zero = F.lit(0).cast("long")

    def equal_bits(word: Column) -> Column:
        return F.aggregate(
            bit_of, zero, lambda bits, b: F.when(b["word"] == word, bits.bitwiseOR(b["bit"])).otherwise(bits)
        )

    def horizontal(s: Column, same: Column) -> Column:
        carried = (same.bitwiseAND(s["more"]) + s["more"]).bitwiseXOR(s["more"])
        across = carried.bitwiseOR(same).bitwiseAND(full)
        up = s["less"].bitwiseOR(full - across.bitwiseOR(s["more"]))
        down = s["more"].bitwiseAND(across)
        return F.struct(
            same.bitwiseOR(s["less"]).alias("diagonal"), up.alias("up"), down.alias("down"), s["now"], s["best"]
        )

    def vertical(h: Column) -> Column:
        now = (
            h["now"]
            + (h["up"].bitwiseAND(top) != 0).cast("int")
            - (h["down"].bitwiseAND(top) != 0).cast("int")
        )
        up = F.shiftleft(h["up"], 1).bitwiseAND(full)
        down = F.shiftleft(h["down"], 1).bitwiseAND(full)
        return F.struct(
            down.bitwiseOR(full - h["diagonal"].bitwiseOR(up).bitwiseAND(full)).alias("more"),
            up.bitwiseAND(h["diagonal"]).alias("less"),
            now.alias("now"),
            F.least(now, h["best"]).alias("best"),
        )

    def step(s: Column, same: Column) -> Column:
        # through an array of one, or each part would be computed wherever it is used
        return F.transform(F.array(horizontal(s, same)), vertical)[0]

    begin = F.struct(full.alias("more"), zero.alias("less"), m.alias("now"), m.alias("best"))
    return F.aggregate(F.transform(window, equal_bits), begin, step, lambda s: s["best"])


def license_spans(docs: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Merged diagonals: row, doc_id, n_words, template, label, diagonal, first, last, votes, share.

    A document without any vote has one row, whose template is null. ``whole`` says that
    a phrase stands there word by word, ``verified`` that or that a notice is aligned
    and none that begins at the same word is aligned better.
    """
    found = templates(docs.sparkSession, notices)
    width, words = F.col("width"), F.col("words")
    window, window_at = F.col("around.window"), F.col("around.window_at")
    there = F.slice(window, F.greatest(F.lit(0), F.col("diagonal") - window_at) + 1, F.size(words))
    whole = (F.col("votes") == F.size(words) - 1) & (there == words)
    aligned = 1 - edits(words, window) / F.size(words)
    by_diagonal = (
        votes(docs, found)
        .join(_broadcast(found), "template", "left")
        .select(
            *("row", "doc_id", "n_words", "template", "label", "width", "diagonal", "votes", "last"),
            F.col("around.pos").alias("first"),
            F.coalesce((width == SHORT) & whole, F.lit(False)).alias("whole"),
            F.when(width == LONG, aligned).otherwise(0.0).alias("aligned"),
        )
    )
    beside = Window.partitionBy("row", "width", "first")
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > NEIGHBOURS
    cut = ((F.col("width") == SHORT) | F.coalesce(apart, F.lit(True))).cast("int")
    best = F.col("aligned") == F.max("aligned").over(beside)
    enough = F.round(F.col("aligned") * 100, 6) >= COVERED
    share = F.when(F.col("whole"), 1.0).otherwise(F.col("aligned"))
    return (
        by_diagonal.withColumn("share", share)
        .withColumn("verified", F.col("whole") | ((F.col("width") == LONG) & best & enough))
        .withColumn("verified", F.coalesce("verified", F.lit(False)))
        .withColumn("cut", cut)
        .withColumn("span", F.sum("cut").over(along))
        .groupBy("row", "doc_id", "n_words", "template", "label", "span")
        .agg(
            F.min("diagonal").alias("diagonal"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.sum("votes").alias("votes"),
            F.max("share").alias("share"),
            F.max("whole").alias("whole"),
            F.max("verified").alias("verified"),
        )
        .drop("span")
    )


def scan_licenses(docs: DataFrame, notices: DataFrame | None = None) -> DataFrame:
    """Per document how often and where phrases stand, its labels and a score.

    The score is the best share of a template's words that a span verifies.
    """

    def joined(keep: Column) -> Column:
        label = F.when(keep & (F.col("label") != ""), F.col("label"))
        return F.array_join(F.sort_array(F.collect_set(label)), ",")

    start = F.when(F.col("whole"), F.col("diagonal").cast("long"))
    return (
        license_spans(docs, notices)
        .groupBy("row", "doc_id", "n_words")
        .agg(
            F.sum(F.col("whole").cast("long")).alias("n_base"),
            F.min(start).alias("first_word"),
            F.max(start).alias("last_word"),
            joined(F.col("whole")).alias("base_labels"),
            joined(F.col("verified")).alias("labels"),
            F.coalesce(F.max("share"), F.lit(0.0)).alias("score"),
        )
        .drop("row")
    )
