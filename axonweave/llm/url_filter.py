"""Operator 11, URL filters: rules by host and path, and logistic regression for what no rule covers.

A URL's features are hashed character n-grams of its host and its path. The regression is trained from a small table of
labelled URLs by accelerated gradient steps, each one aggregation over that table. Everything is DataFrame functions; sums
are of whole numbers, so weights are the same however rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from axonweave.llm._tables import store

#: n-grams have so many characters; they are hashed into BUCKETS, the bias stands behind them.
GRAMS, BUCKETS = (3, 4, 5), 2**14
ROUNDS, STEP, DECAY = 24, 4.0, 3e-4
#: Residuals are rounded to multiples of 1 / UNIT before they are summed.
UNIT = 2**40
#: Of a labelled table, so many rows are fitted at most: those with the smallest md5 of url.
SAMPLE = 10_000
# The contract's rules.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: The small labelled table: names of hosts by label, dealt over the same subdomains, top domains and paths.
UNWANTED = (
    "casino onlinecasino royal-casino casinoslots slots-jackpot jackpot-winner winbig bigwin-poker poker-bonus freespins lucky-win freebet bestbets bets-bonus sportsbets bet-tips "
    "pills pillshop buypills cheapmeds cheap-viagra cheap-loans cheapdeals pharma-pills adult adultcams adult-dating adultvideo xxx-tube porn-x x-rated sexchat "
    "spam spammer spamlinks linkfarm link-farm clickfarm ads adserver ads-click bannerads adtrack tracker trackclicks click-tracking popup-ads free-money freegifts free-iphone payday-loan"
)
WANTED = (
    "news dailynews thetimes herald tribune gazette northernstar weather theweather library citylibrary university college education schools students teachers science nature physics "
    "chemistry biology history museum theatre concert orchestra literature poetry travel tourism hotels railway station airport mountain garden gardening recipes kitchen cooking restaurant health "
    "hospital clinic medicine doctors insurance finance economy market business industry company engineering software developer documentation opensource free-software open-data research institute "
    "foundation parliament government council community forum brother mother weatherstation together other another theory thermal earth north southern leather feathers nation national action "
    "motion fiction creation translation dictionary encyclopedia wiki archive zeitung nachrichten bibliothek universitaet schule wetter verein stadtwerke rathaus reisen gesundheit "
    "journal actualites bibliotheque universite ecole meteo cuisine voyages sante noticias biblioteca universidad escuela tiempo cocina viajes salud ciudad"
)
_BEFORE, _TOP, _PATHS = ("", "www.", "m.", "blog."), ("com", "org", "net", "info", "co.uk"), ("/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/index.html", "/", "", "/articles/{}", "/{}?page=2")


def labelled_rows() -> list[Row]:
    """url, label (1: unwanted): the small table, about 170 rows."""
    return [Row(url=f"https://{_BEFORE[i % 4]}{name}.{_TOP[i % 5]}{_PATHS[i % 9].format(137 * i % 9973)}", label=label) for label, names in ((1, UNWANTED), (0, WANTED)) for i, name in enumerate(names.split())]


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(labelled_rows(), "url string, label int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first `://`, A-Z lower-cased, and the path behind it; both empty if there is no `://`."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, of equally long ones the first; null if none does. Rules are
    (verdict, host/path), few enough for an expression."""
    if not rules:
        return F.lit(None).cast("struct<rule: string, verdict: string>")

    def fits(rule: str) -> Column:
        name, slash, rest = rule.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)

    longest = sorted(rules, key=lambda r: -len(r[1]))
    return F.coalesce(*(F.when(fits(rule), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, rule in longest))


def features(host: Column, path: Column) -> Column:
    """Sorted distinct buckets of the n-grams of `^host$` and of the path, and last the bias."""
    def grams(text: Column, mark: str) -> Column:
        def of(chars: Column, n: int) -> Column:
            at = F.when(F.size(chars) >= n, F.sequence(F.lit(0), F.size(chars) - n)).otherwise(F.array().cast("array<int>"))
            return F.transform(at, lambda i: F.concat(F.lit(mark), *(F.get(chars, i + k) for k in range(n))))

        # a variable of an outer function, so that the text is taken apart once and not for each n-gram
        chars = F.array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
        return F.flatten(F.transform(chars, lambda c: F.concat(*(of(c, n) for n in GRAMS))))

    every = F.concat(grams(F.concat(F.lit("^"), host, F.lit("$")), "h"), grams(path, "p"))
    hashed = F.transform(F.array_distinct(every), lambda g: F.conv(F.substring(F.md5(g.cast("binary")), 1, 4), 16, 10).cast("int") % BUCKETS)
    return F.concat(F.array_sort(F.array_distinct(hashed)), F.array(F.lit(BUCKETS)))


def margin(found: Column, weights: Column) -> Column:
    """The mean of the features' weights, scaled by the root of how many they are."""
    total = F.aggregate(found, F.lit(0.0), lambda a, f: a + F.get(weights, f))
    return total / F.sqrt(F.size(found).cast("double"))


def sampled(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """labelled(url, label) -> label and features of at most sample rows, those with the smallest md5 of url."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.where("url IS NOT NULL AND label IN (0, 1)").select("url", "label").distinct()
    return rows.orderBy(F.md5(F.col("url").cast("binary")), "url", "label").limit(sample).select("label", features(host, path).alias("found"))


def fit(labelled: DataFrame, sample: int = SAMPLE, rounds: int = ROUNDS, step: float = STEP, decay: float = DECAY) -> DataFrame:
    """labelled(url, label) -> one row with weights, an array of BUCKETS + 1 doubles; all 0 if there is no labelled URL.
    Both labels weigh the same, whatever their numbers.

    The sample is one partition, so that a round is one stage; the state between rounds is one row.
    """
    spark = labelled.sparkSession
    picked = store(sampled(labelled, sample).repartition(1))
    share = picked.groupBy("label").agg((0.5 / F.count("*")).alias("share"))  # two rows
    rows = store(picked.join(F.broadcast(share), "label").repartition(1)).coalesce(1)
    zeros = F.expr(f"transform(sequence(0, {BUCKETS}), f -> 0D)")
    state = store(spark.range(1).select(zeros.alias("weights"), zeros.alias("last")))
    slots = spark.range(0, BUCKETS + 1, 1, 1).select(F.lit(0).cast("long").alias("r"), F.col("id").cast("int").alias("f"))
    for t in range(rounds):
        ahead = F.zip_with("weights", "last", lambda w, v: w + F.lit(t / (t + 3)) * (w - v))
        state = state.select("weights", ahead.alias("look"))
        residual = F.col("label") - 1 / (1 + F.exp(-margin(F.col("found"), F.col("look"))))
        at = rows.crossJoin(F.broadcast(state.select("look"))).select("found", F.floor(F.col("share") * residual / F.sqrt(F.size("found").cast("double")) * UNIT).cast("long").alias("r"))  # one row
        sums = at.select("r", F.explode("found").alias("f")).unionByName(slots).coalesce(1).groupBy("f").agg(F.sum("r").alias("r"))
        slope = sums.agg(F.array_sort(F.collect_list(F.struct("f", "r"))).alias("slope"))  # BUCKETS + 1 of them
        moved = F.zip_with("look", "slope", lambda w, s: w + F.lit(step) * (s["r"].cast("double") / UNIT - F.lit(decay) * w))
        state = store(state.crossJoin(F.broadcast(slope)).select(moved.alias("moved"), "weights").select(F.col("moved").alias("weights"), F.col("weights").alias("last")))
    return state.select("weights")


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, labelled: DataFrame | None = None, sample: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """pages(page_id, url) -> page_id, host, path, rule, verdict, score; a row for each page.

    verdict is that of the longest rule that fits, else block if the regression's score is above 0, else allow; rows
    that a rule decides have a score too. The regression is fitted on labelled(url, label), by default `labelled_urls`. A
    null url, or one without `://`, has an empty host and path, no rule, and the score of an empty host. Without labelled
    URLs every score is 0 and allows; with URLs of one label only, all scores lean to it.
    Repeated rows get equal results, URLs of any length are read whole, further columns are ignored, and an empty table
    gives no rows.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", F.col("url").cast("string").alias("url")).withColumns({"host": host, "path": path})
    found = ruled(F.col("host"), F.col("path"), rules)
    urls = urls.withColumn("_r", found).select("page_id", "url", "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("verdict"))
    weights = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled, sample, rounds)
    urls = urls.drop("url").withColumn("found", features(F.col("host"), F.col("path")))
    scored = urls.crossJoin(F.broadcast(weights)).withColumn("score", margin(F.col("found"), F.col("weights")))  # one row
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), F.round("score", 6).alias("score"))
