"""Operator 10, personal data: fixed patterns as seeds, and bootstrapped contextual extraction beyond them.

The seeds are what the base patterns find. Words beside seeds are lexical patterns; the graph of patterns and
the identifier-like strings that stand beside them is scored in rounds: a pattern by the share of its strings
that are known, a string by the patterns that hold it. Strings that reach the threshold become known and raise
further patterns. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from axonweave.llm._tables import store

#: The kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: The base patterns, written so that no start within a run is tried again and no group recurses; a card has
#: 12 digits or more, so shorter numbers need not be found.
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_WORD = r"[^\x20\x09-\x0D]"
#: Numbers in groups that single spaces part, four numbers that signs part, else strings between white space with
#: three digits in a row or an at sign. No start within a string is tried again.
_CANDIDATE = rf"(?<!{_WORD})(?:(?:\(?[0-9][0-9().-]*+(?:\x20\(?[0-9][0-9().-]*+)++|[0-9]++(?:[.,:-][0-9]++){{3}})[.,;:!?]*+(?!{_WORD})|{_WORD}*?(?:[0-9]{{3}}|@){_WORD}*+)"
#: Sent to every task if there are no more of them.
BROADCAST_ROWS = 100_000
SPAN = "array<struct<kind:string,start:int,end:int,value:string,left:string,right:string>>"


def _spans(text: Column, hits: Column, pattern: str, kind: str) -> Column:
    """hits' places in text, found by adding up the lengths of what lies between and of the hits."""
    between = F.split(text, pattern, -1)
    # arrays are zipped, not indexed: an expression within a function of elements is computed for each of them
    rows = F.zip_with(hits, between, lambda h, b: F.struct(b.alias("before"), h.alias("hit")))
    rows = F.zip_with(rows, F.slice(between, 2, F.greatest(F.size(between) - 1, F.lit(0))), lambda r, a: F.struct(r["before"], r["hit"], a.alias("after")))
    rows = F.filter(rows, lambda r: r["hit"].isNotNull())
    none = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["before"])
        left = F.lower(F.regexp_extract(x["before"], rf"(?<!{_WORD})({_WORD}++)[\x20\x09-\x0D]*+$", 1))
        right = F.lower(F.regexp_extract(x["after"], rf"^[\x20\x09-\x0D]*+({_WORD}++)", 1))
        end = start + F.length(x["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["hit"].alias("value"), left.alias("left"), right.alias("right"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(F.size(hits) > 0, F.aggregate(rows, none, add, lambda acc: acc["out"])).otherwise(F.array().cast(SPAN))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int") * (i % 2 + 1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), part), F.lit(0), lambda a, b: a + b) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """Whether a base match is kept."""
    n = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(F.split(value, r"\."), lambda p: F.substring(F.concat(F.lit("000"), F.ltrim(p, F.lit("0"))), -3, 3) <= "255")
    return {"email": F.lit(True), "card": n.between(12, 19) & _luhn(_digits(value)), "phone": n.between(9, 15)}[kind]


def _kept(kind: str) -> Column:
    return F.filter(kind, lambda s: _holds(kind, s["value"]))


def found_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and others (arrays of spans) of each row of docs, in one pass over the texts."""
    text = F.col("text")
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    hint = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    every = BASE | {"other": _CANDIDATE}
    rows = rows.select("*", *(F.when(hint.get(k, F.lit(True)), F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(k) for k, p in every.items()))
    rows = rows.select("doc_id", "text_key", *(_spans(text, F.col(k), p, k).alias(k) for k, p in every.items()))
    kept = [_kept(k) for k in KINDS]
    rows = rows.select("doc_id", "text_key", F.concat(*kept).alias("base"), "other")
    free = F.filter("other", lambda o: ~F.exists("base", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])))
    return rows.select("doc_id", "text_key", "base", free.alias("other"))


def _fits(kind: str) -> Column:
    """Whether a string that no base pattern took could be of the kind."""
    digits, value = F.length(_digits(F.col("value"))), F.col("value")
    return {
        "email": F.contains(value, F.lit("@")) & (digits < 12),
        "ip": value.rlike(r"^[0-9]{1,3}([.:,-][0-9]{1,3}){3}$"),
        "card": digits.between(12, 19) & value.rlike(r"^[0-9\x20-]+$"),
        "phone": digits.between(7, 15) & value.rlike(r"^[0-9()\x20.-]+$"),
    }[kind]


def discovered(spans: DataFrame, support: int = 3, threshold: float = 0.7, doubt: float = 1.0) -> DataFrame:
    """Identifiers beyond the base patterns: doc_id, text_key and the array of spans added.

    A pattern counts from support known strings on; its score is known / (all + doubt) over the strings of a fitting
    form beside it, so that few strings prove less than many. A string's score is 1 - product(1 - score) over its
    patterns. Patterns and strings under threshold are not used. Rounds go on until one finds nothing; what is
    known only grows, so they end.
    """
    trim = F.regexp_extract("value", r"^([^0-9A-Za-z(]*+)(.*?)[^0-9A-Za-z)]*+$", 2)
    lead = F.length(F.regexp_extract("value", r"^([^0-9A-Za-z(]*+)", 1))
    other = spans.select("doc_id", "text_key", F.inline("other")).withColumns({"start": F.col("start") + lead, "value": trim})
    other = other.withColumn("end", F.col("start") + F.length("value")).withColumn("kind", F.explode(F.array(*(F.when(_fits(k), F.lit(k)) for k in KINDS)))).where("kind is not null")
    base = spans.select("doc_id", "text_key", F.inline("base"))
    mentions = store(base.withColumn("known", F.lit(True)).unionByName(other.withColumn("known", F.lit(False))))
    contexts = F.explode(F.array(F.concat(F.lit("l "), "left"), F.concat(F.lit("r "), "right"), F.concat_ws(" ", F.lit("b"), "left", "right")))
    edges = store(mentions.where("left <> '' or right <> ''").select("kind", "value", "known", contexts.alias("pattern")).groupBy("kind", "value", "pattern").agg(F.max("known").alias("known")))
    while True:
        scores = edges.groupBy("kind", "pattern").agg(F.count_if("known").alias("k"), F.count("*").alias("n")).where(f"k >= {support} AND k < n").withColumn("score", F.col("k") / (F.col("n") + doubt))
        scores = store(scores.where(F.col("score") >= threshold).select("kind", "pattern", "score"))
        scores = F.broadcast(scores) if scores.count() <= BROADCAST_ROWS else scores
        rest = edges.where(~F.col("known")).join(scores, ["kind", "pattern"])
        strings = rest.groupBy("kind", "value").agg((1 - F.exp(F.sum(F.log(1 - F.col("score") + 1e-12)))).alias("score")).where(F.col("score") >= threshold)
        new = store(strings.select("kind", "value", F.lit(True).alias("new")))
        if new.isEmpty():
            break
        edges = store(edges.join(new, ["kind", "value"], "left").select("kind", "value", "pattern", (F.col("known") | F.coalesce("new", F.lit(False))).alias("known")))
    accepted = edges.where("known").select("kind", "value").distinct()
    added = mentions.where(~F.col("known")).join(accepted, ["kind", "value"], "left_semi")
    one = F.struct(F.concat(F.lit("context_"), "kind").alias("kind"), "start", "end", "value", "left", "right")
    return added.distinct().groupBy("doc_id", "text_key").agg(F.collect_list(one).cast(SPAN).alias("added"))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    order = F.array(*(F.lit(k) for k in (*KINDS, *(f"context_{k}" for k in KINDS))))
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(order, s["kind"]).alias("b"), s["end"].alias("c"), s["kind"].alias("d"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["d"], s["a"].cast("string"), s["c"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and added spans, of each row of docs(doc_id, text).

    Null text is empty. Places count code points from 0, ends are exclusive. Strings that the context finds have
    kinds context_email and so on and never overlap base spans; spans that start at one place are listed by kind.
    Texts and the words beside a span are read whole. Repeated rows get equal results; other columns are ignored;
    an empty table gives no rows.
    """
    spans = store(found_spans(docs))
    added = discovered(spans).withColumnsRenamed({"doc_id": "d", "text_key": "t"})
    return spans.join(added, spans.doc_id.eqNullSafe(added.d) & (spans.text_key == added.t), "left").select("doc_id", "text_key", "base", F.coalesce("added", F.array().cast(SPAN)).alias("added"))


def digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one, by the kind that starts
    first (then the one that ends first).

    Rows are matched to their findings by doc_id (null too) and text. A null text stays null; repeated rows stay as
    often as they occur; all columns stay, whatever their names; texts are read whole; an empty table stays empty.
    """
    found = personal_data(docs).select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))).alias("s"))
    found = found.where(F.size("s") > 0).distinct()
    text = F.col("row.text").cast("string")

    def hide(acc: Column, s: Column) -> Column:
        """acc: what is written, and the place up to which text is used."""
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        word = F.concat(F.lit("["), F.upper(F.regexp_replace(s["kind"], "context_", "")), F.lit("]"))
        return F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(F.struct(F.concat(acc["out"], gap, word).alias("out"), s["end"].alias("at")))

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    joined = rows.join(found, F.col("row.doc_id").eqNullSafe(F.col("d")) & (F.xxhash64(text) == F.col("t")), "left")
    hidden = F.aggregate("s", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), hide, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    hidden = F.when(F.col("s").isNotNull(), hidden).otherwise(text)
    return joined.select(F.col("row").withField("text", hidden).alias("row")).select("row.*")
