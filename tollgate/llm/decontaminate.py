"""Benchmark decontamination with a positional inverted index, in DataFrame functions alone.

The index holds (term, document, position) for every corpus token that is a benchmark term; it is
written once and read for term counts, for lists and for document lengths.  Of every benchmark window the two rarest terms' lists are shifted by the terms' places in
the item and intersected; what is left are alignments of an item with a document, which are checked word
by word.  Runs of at least a window's length are exact phrases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import plain, saved, texts


def words_of(df: DataFrame) -> DataFrame:
    """(id, words) of a frame (id, text)."""
    t = df.select("id", F.trim(plain(F.col("text"))).alias("t"))
    return t.select("id", F.when(F.col("t") == "", F.array().cast("array<string>")).otherwise(F.split("t", " +")).alias("words"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, id, pos) of all tokens that are in ``terms``, and for each document a null term at its length."""
    tokens = words_of(docs).select("id", F.posexplode(F.array_append("words", F.lit(None).cast("string"))).alias("pos", "token"))
    known = terms.select(F.col("term"))
    return tokens.join(known, F.col("token") == F.col("term"), "left").where("term is not null or token is null").select("term", "id", "pos")


def rarest_terms(items: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(item, one, two): the places of the two rarest terms of every window that can occur."""
    counts = index.where("term is not null").groupBy("term").agg(F.count("*").alias("n"))
    size = F.least(F.size("words"), F.lit(window))
    places = items.select("item", size.alias("len"), F.posexplode("words").alias("at", "term"), F.size("words").alias("m")).join(counts, "term")
    start = F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - F.col("len") + 1), F.least(F.col("at"), F.col("m") - F.col("len"))))
    wins = places.select("item", "len", "at", "n", start.alias("start")).groupBy("item", "len", "start")
    wins = wins.agg(F.slice(F.array_sort(F.collect_list(F.struct("n", "at"))), 1, 2).alias("rare"), F.count("*").alias("known")).where("known = len")
    return wins.select("item", F.col("rare")[0]["at"].alias("one"), F.coalesce(F.get("rare", F.lit(1))["at"], F.col("rare")[0]["at"]).alias("two")).distinct()


def alignments(index: DataFrame, items: DataFrame, rare: DataFrame) -> DataFrame:
    """(id, item, shift, at): the shifted lists of the rare terms."""
    anchors = rare.select("item", F.explode(F.array("one", "two")).alias("at")).distinct()
    anchors = anchors.join(items.select("item", "words"), "item").select("item", "at", F.get("words", F.col("at")).alias("term"))
    return index.join(anchors, "term").select("id", "item", (F.col("pos") - F.col("at")).alias("shift"), "at")


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 13, slop: int = 3, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lengths, phrases, near).

    lengths: (id, n_words) of every document; phrases: (id, item, start, end) of every run of words that
    holds a window of the item; near: (id, item) where two rare terms of one window stand in the
    document, at most ``slop`` words further apart or closer than in the item.
    """
    corpus = texts(docs, id_col, text_col)
    items = saved(words_of(texts(benchmark, item_col, text_col)).where(F.size("words") > 0).withColumnRenamed("id", "item"))
    terms = saved(items.select(F.explode("words").alias("term")).distinct())
    index = saved(postings(corpus, terms))
    rare = saved(rarest_terms(items, index, window))
    found = saved(alignments(index, items, rare))
    at_shift = found.groupBy("id", "item", "shift").agg(F.collect_set("at").alias("hits"))
    aligned = at_shift.join(rare, "item").where(F.array_contains("hits", F.col("one")) & F.array_contains("hits", F.col("two")))
    aligned = aligned.select("id", "item", "shift").distinct()

    expected = aligned.join(items, "item")
    # an alignment may start before or end after the document: get() gives null there
    same = "array_join(transform(words, (w, i) -> if(shift + i >= 0 and coalesce(get(said, cast(shift + i as int)), '') = w, '1', '0')), '')"
    text_of = corpus.join(aligned.select("id").distinct(), "id", "left_semi")
    runs = expected.join(words_of(text_of).withColumnRenamed("words", "said"), "id").select("id", "item", "shift", F.least(F.size("words"), F.lit(window)).alias("len"), F.expr(same).alias("bits"))
    pattern = F.concat(F.lit("1{"), F.col("len"), F.lit(",}"))
    runs = runs.withColumn("pattern", pattern).where("rlike(bits, pattern)")
    both = F.arrays_zip(F.expr("regexp_extract_all(bits, pattern, 0)").alias("hit"), F.split("bits", F.col("pattern"), -1).alias("gap"))
    runs = runs.select("id", "item", "shift", F.posexplode(both).alias("k", "one")).where("one.hit is not null")
    order = Window.partitionBy("id", "item", "shift").orderBy("k")
    end = F.sum(F.length("one.hit") + F.length("one.gap")).over(order)
    phrases = runs.select("id", "item", (F.col("shift") + end - F.length("one.hit")).alias("start"), (F.col("shift") + end).alias("end"))

    before = Window.partitionBy("id", "item").orderBy("shift", "at")
    apart = found.withColumns({"gap": F.col("shift") - F.lag("shift").over(before), "other": F.lag("at").over(before)})
    near = apart.where((F.col("gap") <= slop) & (F.col("other") != F.col("at"))).select("id", "item").distinct()
    lengths = index.where("term is null").select("id", F.col("pos").cast("long").alias("n_words"))
    return lengths, phrases, near


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20, **cols) -> DataFrame:
    """One row for each document: its words, the words hit, the items found and the verdict.

    Contaminated: some word is hit, and at least one in ``share`` of all.  Null texts have no words; an
    empty benchmark hits nothing; see ``frames.texts`` for null and repeated ids of either table.
    """
    lengths, phrases, near = matches(docs, benchmark, window, **cols)
    reach = Window.partitionBy("id").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = phrases.withColumn("reach", F.coalesce(F.max("end").over(reach), F.lit(0)))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest("start", "reach"))
    hits = spans.groupBy("id").agg(F.sum(fresh).alias("n_hit"), F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    close = near.groupBy("id").agg(F.count("*").alias("n_near"))
    out = lengths.join(hits, "id", "left").join(close, "id", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` but for contaminated documents."""
    gone = contamination(docs, benchmark).where("contaminated").select(F.col("id").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
