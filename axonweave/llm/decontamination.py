"""Operator 6, benchmark decontamination: a stored positional index of the words that test items use.

One pass over the texts stores the postings (text, position, term) of every test term. Each window of a test
item is then looked up from its rarest term: that term's postings, shifted by its offset, are the candidates;
the lists of the next two rarer terms are intersected with them, then those of all other terms in the texts
that are left. Only DataFrame
operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from axonweave.llm._tables import store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words; capital letters belong to words here, and are made small later.
PARTING = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Tables with more rows are not sent to every task.
BROADCAST_ROWS = 100_000

TEXT = ["doc_id", "text_key"]


def _small(df: DataFrame) -> DataFrame:
    """A stored table, marked for broadcast if its row count, which is checked, is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), PARTING), "")


def _small_letters(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def item_windows(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows of the items, (window_id, words), and (window_id, item_id). Items without words have none."""
    words = items.select("item_id", _words(_small_letters(F.col("text").cast("string"))).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    spans = words.select("item_id", "w", F.explode(starts).alias("at")).select("item_id", F.slice("w", F.col("at"), width).alias("words")).distinct()
    windows = store(spans.select("words").distinct().select(F.monotonically_increasing_id().alias("window_id"), "words"))
    return windows, store(spans.join(windows, "words").select("window_id", "item_id"))


def positional_index(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of terms(term_id, term, folded): doc_id, text_key, n_words, pos, term_id.

    Every text also has the row of its first word, with term_id null if that is no test term, or one row with
    pos null if it has no word. Rows of docs that repeat are told apart by nothing; their postings repeat.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_key"), _words(F.col("text")).alias("w"))
    placed = texts.select(*TEXT, F.size("w").alias("n_words"), F.posexplode_outer("w").alias("pos", "word"))
    # Lower case of all letters only finds the row; the words must be equal with A-Z made small.
    same = (F.col("word") == F.col("term")) | (_small_letters(F.col("word")) == F.col("term"))
    found = placed.join(terms, (F.lower("word") == F.col("folded")) & same, "left")
    return store(found.where("term_id is not null or pos is null or pos = 0").select(*TEXT, "n_words", "pos", "term_id"))


def matches(postings: DataFrame, windows: DataFrame, terms: DataFrame, slop: int = 0) -> DataFrame:
    """Where windows occur: doc_id, text_key, window_id, start, len.

    With slop 0 these are exact phrases; else proximity matches, in which every term of the window stands within
    slop words of its place relative to the window's rarest term.
    """
    counts = _small(store(postings.groupBy("term_id").agg(F.count("*").alias("n"))))
    placed = windows.select("window_id", F.size("words").alias("len"), F.posexplode("words").alias("off", "term")).join(terms.select("term", "term_id"), "term")
    placed = placed.join(counts, "term_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    by_window = Window.partitionBy("window_id")
    ranked = placed.withColumn("fewest", F.min("n").over(by_window)).where("fewest > 0").withColumn("rank", F.row_number().over(by_window.orderBy("n", "off")))
    ranked = store(ranked.select("window_id", "len", "off", "term_id", "rank"))

    rarest = _small(ranked.where("rank = 1").withColumnRenamed("off", "first_off"))
    found = store(postings.join(rarest, "term_id").select(*TEXT, "window_id", "len", (F.col("pos") - F.col("first_off")).alias("start")).where("start >= 0").distinct())
    for k in (2, 3, None):
        lists = store(ranked.where(f"rank = {k}" if k else "rank > 3").select("window_id", "off", "term_id"))
        if k:  # one list of each window, of its next rarer term
            near = postings.join(_small(store(lists.select("term_id").distinct())), "term_id", "left_semi")
        else:  # all other lists, of the few texts that are left
            texts = _small(store(found.select(*TEXT).distinct()))
            near = postings.join(texts, [postings.doc_id.eqNullSafe(texts.doc_id), postings.text_key == texts.text_key], "left_semi")
        per = lists.groupBy("window_id").agg(F.count("*").alias("k"))
        wanted = found.join(_small(lists), "window_id").select("*", F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("d")).withColumn("pos", F.col("start") + F.col("off") + F.col("d"))
        keys = [wanted.doc_id.eqNullSafe(near.doc_id), *(wanted[c] == near[c] for c in ("text_key", "pos", "term_id"))]
        met = wanted.join(near, keys, "left_semi").select(*TEXT, "window_id", "len", "start", "off").distinct()
        met = met.groupBy(*TEXT, "window_id", "len", "start").agg(F.count("*").alias("met"))
        # Windows without terms of these ranks stay as they are.
        short = found.join(per, "window_id", "left_anti")
        found = store(met.join(per, "window_id").where("met = k").select(*found.columns).unionByName(short))
    return found


def contamination(docs: DataFrame, items: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs(doc_id, text).

    items(item_id, text) are cut into windows of width words, shorter ones are one window; a word inside any
    occurrence of a window is hit. A text is contaminated if at least one word in twenty is hit. Null or empty
    texts have no words. Repeated rows get equal results; other columns are ignored; without items or docs
    nothing is hit.
    """
    windows, owners = item_windows(items, width)
    terms = windows.select(F.explode("words").alias("term")).distinct()
    terms = store(terms.select(F.monotonically_increasing_id().alias("term_id"), "term", F.lower("term").alias("folded")))
    index = positional_index(docs, _small(terms))
    found = matches(index.where("term_id is not null").select(*TEXT, "pos", "term_id"), windows, terms)

    hit = found.select(*TEXT, F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct().groupBy(*TEXT).agg(F.count("*").alias("n_hit"))
    named = found.select(*TEXT, "window_id").distinct().join(_small(owners), "window_id").select(*TEXT, F.col("item_id").cast("string").alias("item")).distinct()
    named = named.groupBy(*TEXT).agg(F.count("*").alias("n_items"), F.concat_ws(",", F.sort_array(F.collect_list("item"))).alias("names"))
    result = hit.join(named, [hit.doc_id.eqNullSafe(named.doc_id), hit.text_key == named.text_key]).select(hit.doc_id.alias("d"), hit.text_key.alias("t"), "n_hit", "n_items", "names")
    texts = index.where("pos is null or pos = 0")
    return texts.join(result, texts.doc_id.eqNullSafe(result.d) & (texts.text_key == result.t), "left").select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("names", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) * 20 >= F.greatest("n_words", F.lit(1))).alias("contaminated"),
    )
